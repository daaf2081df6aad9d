"""Column expressions: scalar functions (SC*), predicates (PF*), array helpers (NS*).

Everything here returns a ``pyspark.sql.Column`` built from built-in functions,
so it stays inside whole-stage codegen.  No Python UDF.
"""

from lumenrec.functions.text import (
    class_type_tag, group_key, level_tag, subject_code, subject_rule_name, token,
)
from lumenrec.functions.weights import price_weight, status_weight
from lumenrec.functions.time import day_range, intervals_overlap, millis_to_date, today
from lumenrec.functions.predicates import (
    date_between, first_not_blank, is_valid, is_valid_city_weak, not_empty_json,
)
from lumenrec.functions.arrays import java_split, pad

__all__ = [
    "class_type_tag", "group_key", "level_tag", "subject_code", "subject_rule_name",
    "token", "price_weight", "status_weight", "day_range", "intervals_overlap", "millis_to_date",
    "today", "date_between", "first_not_blank", "is_valid", "is_valid_city_weak", "not_empty_json",
    "java_split", "pad",
]
