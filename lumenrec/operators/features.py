"""Feature triples: unpivots (ST6-ST8) and weight sums (AG1-AG4, AG11).

A feature triple is ``(sid, feature_name, value: double)``; a stamped feature
adds ``dt``.  Sums group by ``(sid, feature_name)``; Spark combines partial
sums map-side before the shuffle, so the shuffle carries at most one row per
key and input partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenrec.functions import (
    class_type_tag, date_between, is_valid, level_tag, price_weight, status_weight, subject_code,
)
from lumenrec.functions._col import col

KEY = ["sid", "feature_name"]


def unpivot(df: DataFrame, id_col: str, entries: list[tuple[Column, Column]],
            name: str = "feature_name", value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """One input row -> ``len(entries)`` rows ``(id, *keep, name, value)``.

    Every entry must produce the same value type (ST6-ST8).
    """
    structs = [F.struct(n.alias(name), v.alias(value)) for n, v in entries]
    return df.select(col(id_col).alias("sid"), *keep, F.inline(F.array(*structs)))


def _with_subject(rows: DataFrame, subject: str, *more: tuple[str, Column]) -> DataFrame:
    """Rows with ``_subj`` and ``more`` columns, computed once below the unpivot."""
    return rows.select("*", subject_code(subject).alias("_subj"), *[c.alias(n) for n, c in more])


def sum_weights(triples: DataFrame, dt: str | None = None) -> DataFrame:
    """AG1: sum of ``value`` per ``(sid, feature_name)``; optional ``dt`` stamp."""
    out = triples.groupBy(*KEY).agg(F.sum("value").alias("value"))
    return out if dt is None else out.withColumn("dt", F.lit(dt))


def merge(a: DataFrame, b: DataFrame, dt: str | None = None) -> DataFrame:
    """AG2 ``MergeData``: bag union of two triple sets, summed per key, stamped."""
    return sum_weights(a.select(*KEY, "value").unionByName(b.select(*KEY, "value")), dt)


def count_values(rows: DataFrame, feature: str) -> DataFrame:
    """AG3: how often each value of ``feature`` occurs per sid, as a double weight."""
    return rows.groupBy("sid", F.col(feature).alias("feature_name")) \
        .agg(F.count(F.lit(1)).cast("double").alias("value"))


# ---- unpivots of the two behaviour sources ----------------------------------------

def order_triples(orders: DataFrame, *keep: str) -> DataFrame:
    """ST6: one order -> subject+level (status weight), subject (2.0), subject+price (price weight);
    each with the order's columns ``keep``."""
    subj = F.col("_subj")
    rows = _with_subject(orders, "subjectname", ("_lev", level_tag("classlevelname")))
    return unpivot(rows, "sid", [
        (F.concat(subj, "_lev"), status_weight("orderstatus")),
        (subj, F.lit(2.0)),
        (F.concat(subj, F.lit("price")), price_weight("orderstatus", "classprice")),
    ], keep=keep)


def event_triples(events: DataFrame, *keep: str) -> DataFrame:
    """ST7: one behaviour row -> subject+level, subject, subject+class type; weight 1.0 each, with
    the row's columns ``keep``."""
    return unpivot(_event_codes(events), "sid", [
        (F.concat("_subj", "_lev"), F.lit(1.0)),
        (F.col("_subj"), F.lit(1.0)),
        (F.concat("_subj", "_type"), F.lit(1.0)),
    ], keep=keep)


def _event_codes(events: DataFrame) -> DataFrame:
    return _with_subject(events, "cla_subject_names", ("_lev", level_tag("cla_level_name")),
                         ("_type", class_type_tag("cla_class_type")))


def order_recall_rows(orders: DataFrame, id_col: str = "distinctid") -> DataFrame:
    """ST8: one order -> (id, subject+level, status weight as text, startdate),
    (id, 'price', price as text, startdate); a null price counts as 0 (SURVEY Q2)."""
    price = F.coalesce(F.col("classprice"), F.lit(0.0))
    structs = [
        F.struct(F.concat("_subj", "_lev").alias("feature_name"),
                 status_weight("orderstatus").cast("string").alias("value")),
        F.struct(F.lit("price").alias("feature_name"), price.cast("string").alias("value")),
    ]
    rows = _with_subject(orders, "subjectname", ("_lev", level_tag("classlevelname")))
    return rows.select(id_col, F.col("startdate").cast("string").alias("dt"), F.inline(F.array(*structs))) \
        .select(id_col, "feature_name", "value", "dt")


def sum_text_values(rows: DataFrame, id_col: str = "distinctid") -> DataFrame:
    """AG11: text values -> double (bad text is null, not a failed job), summed per key;
    ``n_rejected`` counts the key's texts that are no number."""
    number = F.col("value").try_cast("double")
    return rows.groupBy(id_col, "feature_name").agg(
        F.sum(number).alias("value"), F.count_if(number.isNull() & F.col("value").isNotNull()).alias("n_rejected"))


# ---- source filters ---------------------------------------------------------------

def valid_orders(orders: DataFrame, begin: str | None, end: str | None, created_after: str) -> DataFrame:
    """Orders of a valid sid created after ``created_after`` with ``dt`` in [begin, end] (no bound if None)."""
    return orders.filter(is_valid("sid") & (F.col("finacreatedate") > F.lit(created_after).cast("date"))
                         & date_between("dt", begin, end))


def valid_events(events: DataFrame, begin: str | None = None, end: str | None = None) -> DataFrame:
    """Behaviour rows of a valid sid and class with ``day`` in [begin, end] (no bound if None)."""
    return events.filter(is_valid("cla_id") & is_valid("sid") & date_between("day", begin, end))
