"""Set and reshape helpers (PF4, ST4, ST5, WN3, NS9, SNK6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenrec.operators.ranking import top3_json
from lumenrec.operators.features import count_values


def dedupe_list(arr) -> F.Column:
    """ST4: set-dedupe inside a list (first occurrence kept)."""
    return F.array_distinct(arr)


def unnest(df: DataFrame, list_col: str, item: str) -> DataFrame:
    """ST5: one row per list element; an empty or null list gives no row."""
    return df.select(*[c for c in df.columns if c != list_col], F.explode(list_col).alias(item))


def sample_rows(df: DataFrame, n: int, order: list[str] | None = None) -> DataFrame:
    """WN3: the first ``n`` rows after a total order (deterministic sample)."""
    return df.orderBy(*(order or df.columns)).limit(n)


def json_property_top3(events: DataFrame, json_col: str, path: str, output_name: str,
                       dt: str, min_version: tuple[int, int] | None = None,
                       version_col: str | None = None) -> DataFrame:
    """NS9 (dead code in the original): count a JSON property per sid, top 3 as a JSON list.

    ``min_version`` gates rows on an app version text ``a.b.c`` (minor and patch
    compared as text, as the original did) when ``version_col`` is given.
    """
    rows = events.select("sid", F.get_json_object(json_col, path).alias("_prop"),
                         *( [version_col] if version_col else []))
    if version_col and min_version:
        parts = F.split(F.col(version_col), "\\.")
        rows = rows.filter((F.get(parts, 1) >= str(min_version[0])) & (F.get(parts, 2) >= str(min_version[1])))
    rows = rows.filter(F.col("sid") != "").filter(F.col("_prop").isNotNull())
    return top3_json(count_values(rows, "_prop"), output_name, dt)


def row_json(df: DataFrame, key_col: str, ttl_s: int) -> DataFrame:
    """SNK6 (dead code in the original): the whole row as JSON keyed by ``key_col``."""
    return df.select(F.col(key_col).alias("key"),
                     F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"),
                     F.lit(ttl_s).cast("bigint").alias("ttl_s"))
