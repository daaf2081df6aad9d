"""Scored packs and the key-value export (PL9-PL11, SNK5, SRC16).

The export is one record per key, section and class at every size: no key is
gathered, split or rendered when it is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenrec.functions import group_key
from lumenrec.operators import packs
from lumenrec.sinks.files import Folder
from lumenrec.sinks.tables import overwrite_table
from lumenrec.sources.tables import Tables

# ---- fixed values of the export ---------------------------------------------------------
STUDENT_KEY_PREFIX = "recommend_studentid_"
GROUP_KEY_PREFIX = "recommend_"
TTL_SECONDS = 2592000          # 30 days
# -------------------------------------------------------------------------------------------


def _of_city(df: DataFrame, city: str | None) -> DataFrame:
    return df if city is None else df.filter(F.col("city_id") == city)


def scored(t: Tables, recs: DataFrame, city: str | None = None) -> DataFrame:
    """JN12: recommendations with their class score row (same city)."""
    return recs.select("sid", "city_id", "cla_id").join(_of_city(t.score, city), ["cla_id", "city_id"])


def scored_classes(t: Tables, recs: DataFrame, city: str | None = None) -> DataFrame:
    """JN13, JN12: recommendations with the attributes of the class table and the score of the
    score table (same city)."""
    attrs = [c for c in packs.INFO_FIELDS if c not in ("cla_id", "city_id", "getScore")]
    k = _of_city(t.klass, city).select("cla_id", "city_id", *attrs)
    s = _of_city(t.score, city).select("cla_id", "city_id", "fin_score")
    return recs.select("sid", "city_id", "cla_id").join(k, ["cla_id", "city_id"]).join(s, ["cla_id", "city_id"])


def student_pack(t: Tables, recs: DataFrame, city: str | None = None) -> DataFrame:
    """PL9: the entries of ``{"online_recom": [...], "offine_recom": [...]}`` per student:
    ``(sid, city_id, section, cla_id, entry)``."""
    return packs.online_offline_entries(scored(t, recs, city), ["sid", "city_id"])


def student_pack_keyed(t: Tables, recs: DataFrame, city: str | None = None) -> DataFrame:
    """PL10: the same with one entry per class id, attributes from the class table."""
    return packs.online_offline_entries(scored_classes(t, recs, city), ["sid", "city_id"], keyed=True)


def fallback_pack(t: Tables, city: str | None = None) -> DataFrame:
    """PL11: every scored class under its ``city_grade_subject`` key (SC12):
    ``(key, city_id, section, cla_id, entry)``."""
    s = _of_city(t.score, city).withColumn("key", group_key("city_id", "cla_grade_id", "cla_subject_names"))
    return packs.list_entries(s, ["key", "city_id"])


def kv_records(entries: DataFrame, prefix: str, key_col: str, as_of: str, ttl_s: int = TTL_SECONDS) -> DataFrame:
    """SNK5 records ``(key, city_id, section, cla_id, value, ttl_s, expires_at)`` of a pack."""
    expires = (F.lit(as_of).cast("timestamp") + F.make_dt_interval(secs=F.lit(ttl_s))).cast("string")
    return entries.select(F.concat(F.lit(prefix), F.col(key_col)).alias("key"), "city_id", "section", "cla_id",
                          F.col("entry").alias("value"), F.lit(ttl_s).cast("bigint").alias("ttl_s"),
                          expires.alias("expires_at"))


def kv_export(student_packs: DataFrame, group_packs: DataFrame, as_of: str) -> DataFrame:
    """Both exports of the original jobs as one key-value table."""
    return kv_records(student_packs, STUDENT_KEY_PREFIX, "sid", as_of) \
        .unionByName(kv_records(group_packs, GROUP_KEY_PREFIX, "key", as_of))


def store_export(kv: DataFrame, path: str, row_group_bytes: int = 8 << 20) -> DataFrame:
    """Write a key-value table in order of key, section and class and return it as stored.

    Files hold ranges of the order and row groups parts of them, so the least and greatest keys in
    the files' statistics let a ``get`` or a prefix scan read the row groups it needs alone.  A key
    of very many entries lies over many files.

    Ranges are chosen from a first pass over the rows and dealt in a second one, so the rows are
    written as they come first: what they are made from runs once.
    """
    spark, order, loose = kv.sparkSession, ["key", "section", "cla_id"], f"{path}_loose"
    try:
        overwrite_table(kv, loose)
        rows = spark.read.schema(kv.schema).parquet(loose).repartitionByRange(*order).sortWithinPartitions(*order)
        overwrite_table(rows, path, **{"parquet.block.size": str(row_group_bytes)})
    finally:
        Folder(spark, loose).remove(loose)
    return spark.read.schema(kv.schema).parquet(path)


def upsert(kv: DataFrame, newer: DataFrame) -> DataFrame:
    """Last write per key wins: a key of ``newer`` is replaced as a whole, whatever it held."""
    return kv.join(newer.select("key").distinct(), "key", "left_anti").unionByName(newer)


def kv_get(kv: DataFrame, key: str, keyed: bool = False) -> DataFrame:
    """SRC16 ``get``: ``(key, value, n_entries, ttl_s, expires_at)`` of one key (zero or one row).

    The key filter reaches the entries before anything is gathered; the value
    is rendered for the requested key alone.
    """
    rows = kv.filter(F.col("key") == key)
    facts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n_entries"), F.max("ttl_s").alias("ttl_s"),
                                    F.max("expires_at").alias("expires_at"))
    value = packs.render(rows.select("key", "section", "cla_id", F.col("value").alias("entry")), "key", keyed)
    return value.join(facts, "key").select("key", "value", "n_entries", "ttl_s", "expires_at")


def kv_scan_prefix(kv: DataFrame, prefix: str, n: int = 10) -> DataFrame:
    """SRC16 ``keys(prefix*)`` then the first ``n`` keys (the limit is the feature), with all
    their entries.

    ``kv`` is a stored table: its keys with the prefix are looked up first, and the ``n`` found are
    a filter that reaches the scan of the entries.
    """
    found = kv.filter(F.col("key").startswith(prefix)).select("key").distinct().orderBy("key").limit(n)
    return kv.filter(F.col("key").isin([r.key for r in found.collect()]))
