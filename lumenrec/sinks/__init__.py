"""Sinks: table writes (SNK1-SNK4) and the key-value export (SNK5)."""

from lumenrec.sinks.files import new_folder, shared_folder
from lumenrec.sinks.kv import push_export, push_partitions, read_value, served_keys, store_values
from lumenrec.sinks.tables import (
    create_if_absent, exists, overwrite_table, read_slice, recover, replace_slice, replace_slices, text_export,
)

__all__ = ["create_if_absent", "exists", "new_folder", "overwrite_table", "push_export", "push_partitions", "read_slice",
           "read_value", "recover", "replace_slice", "replace_slices", "served_keys", "shared_folder", "store_values", "text_export"]
