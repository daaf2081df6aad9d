"""Per-key ranking (WN1, WN2).

Both are ``row_number`` windows with the rank filter directly above the
window, so Spark plans a ``WindowGroupLimit`` that keeps only the top rows per
key in each input partition before the shuffle.  Ties are broken by the value
text, ascending (SURVEY Q4), which makes results deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenrec.functions import pad

TOP_N = 3


def top_values(weights: DataFrame, n: int = TOP_N) -> DataFrame:
    """Rows ``(sid, rank, feature_name, value)`` for the ``n`` heaviest values per sid."""
    w = Window.partitionBy("sid").orderBy(F.desc("value"), F.asc("feature_name"))
    return weights.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def top3_json(weights: DataFrame, output_name: str, dt: str) -> DataFrame:
    """WN1 ``SortListOutput``: ``{"1": v1, "2": v2, "3": v3}`` padded with ``''``.

    The pivot uses ``max(when(rank == i))`` over at most three rows per sid.
    """
    top = top_values(weights)
    slots = [F.coalesce(F.max(F.when(F.col("rank") == i, F.col("feature_name"))), F.lit(""))
             .alias(str(i)) for i in range(1, TOP_N + 1)]
    packed = top.groupBy("sid").agg(*slots)
    return packed.select(
        "sid", F.lit(output_name).alias("feature_name"),
        F.to_json(F.struct(*[F.col(f"`{i}`") for i in range(1, TOP_N + 1)])).alias("value"),
        F.lit(dt).alias("dt"),
    )


def recent_distinct(rows: DataFrame, key: str, item: str, when: str, n: int = TOP_N) -> DataFrame:
    """WN2: the ``n`` most recent distinct items per key, long form ``(key, rank, item)``.

    Walking rows newest first and skipping repeats keeps each item at its latest
    date, so: latest date per (key, item), then rank by that date.
    """
    latest = latest_items(rows, key, item, when)
    return top_recent(latest, key, item, when, n).drop(when)


def latest_items(rows: DataFrame, key: str, item: str, when: str) -> DataFrame:
    """``(key, item, when)``: each item at its latest date."""
    return rows.groupBy(key, item).agg(F.max(when).alias(when))


def top_recent(latest: DataFrame, key: str, item: str, when: str, n: int = TOP_N) -> DataFrame:
    """The ``n`` latest rows per key with their ``rank``; equal dates go by the item's text."""
    w = Window.partitionBy(key).orderBy(F.desc(when), F.asc(item))
    return latest.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def as_padded_list(ranked: DataFrame, key: str, item: str, n: int = TOP_N) -> DataFrame:
    """Long ranked rows -> ``(key, list)`` in rank order, padded with ``''`` to ``n``."""
    lst = F.transform(F.array_sort(F.collect_list(F.struct("rank", item))), lambda x: x[item])
    out = ranked.groupBy(key).agg(lst.alias("list"))
    return out.withColumn("list", pad("list", n))
