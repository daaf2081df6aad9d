"""User feature weights and preference lists (PL1-PL4, PL12).

The original jobs loop over days in the driver, one job step and three
shuffles per day, merging as they go.  Sums are additive, so each range here
is one scan with ``BETWEEN`` and a single aggregation: equal up to float
rounding, and the day predicate reaches the scan (partition pruning on a
``dt``/``day`` partitioned table).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenrec.functions import date_between, is_valid
from lumenrec.functions.time import days_in_range
from lumenrec.operators import features as ft
from lumenrec.operators.ranking import top3_json
from lumenrec.sources.tables import Tables


def order_features(t: Tables, begin: str, end: str, dt: str, created_after: str) -> DataFrame:
    """PL1 ``cal_order_record`` over the closed day range."""
    return ft.sum_weights(ft.order_triples(ft.valid_orders(t.order, begin, end, created_after)), dt)


def event_features(t: Tables, begin: str, end: str, dt: str) -> DataFrame:
    """PL2 ``cal_event_record`` over the closed day range."""
    return ft.sum_weights(ft.event_triples(ft.valid_events(t.behavior, begin, end)), dt)


def merged_features(t: Tables, event_range: tuple[str, str], order_range: tuple[str, str],
                    dt: str, created_after: str) -> DataFrame:
    """PL3 third output: order and event weights merged (AG2), one aggregation.

    Summing the union of the raw triples equals summing the two sums.
    """
    ev = ft.event_triples(ft.valid_events(t.behavior, *event_range))
    od = ft.order_triples(ft.valid_orders(t.order, *order_range, created_after))
    return ft.sum_weights(ev.unionByName(od), dt)


# ---- PL4 preference lists -------------------------------------------------------------

# ---- fixed values: the three lists of the original job --------------------------------
FAVOR_LISTS = {
    "teacher_favor": "cla_teacher_ids",
    "class_location_favor": "cla_servicecenter_id",
    "class_time_favor": "cla_classtime_ids",
}
CLASS_TIME_TYPES = ["1", "3"]
# ----------------------------------------------------------------------------------------


def favor_counts(t: Tables, feature: str, begin: str, end: str,
                 condition: Column | None = None, literal_or: Column | None = None) -> DataFrame:
    """AG3 + AG4: occurrences of each ``feature`` value per sid over the range.

    ``condition`` is an extra predicate ANDed with the standard filters.
    ``literal_or`` reproduces the original text-appended ``... or <pred>`` (SURVEY
    Q3): rows matching it bypass every other filter and are counted once per day
    of the range.
    """
    b = t.behavior
    std = is_valid("sid") & date_between("day", begin, end) & is_valid(feature)
    if condition is not None:
        std = std & condition
    if literal_or is None:
        return ft.count_values(b.filter(std), feature)
    n_days = float(days_in_range(begin, end))
    weight = F.when(literal_or, F.lit(n_days)).otherwise(F.lit(1.0))
    rows = b.filter(std | literal_or)
    return rows.groupBy("sid", F.col(feature).alias("feature_name")).agg(F.sum(weight).alias("value"))


def favor_source(output_name: str) -> tuple[str, Column | None]:
    """The behaviour column of a list and the condition on its rows."""
    types = F.col("cla_class_type").isin(*CLASS_TIME_TYPES) if output_name == "class_time_favor" else None
    return FAVOR_LISTS[output_name], types


def favor_list(t: Tables, output_name: str, begin: str, end: str, dt: str,
               literal_quirk: bool = False) -> DataFrame:
    """PL4 ``CalListOutputFunc``: top-3 values per sid as a JSON list."""
    feature, cond = favor_source(output_name)
    lit_or = None
    if literal_quirk and output_name == "class_time_favor":
        cond = F.col("cla_class_type") == CLASS_TIME_TYPES[0]
        lit_or = F.col("cla_class_type") == CLASS_TIME_TYPES[1]
    return top3_json(favor_counts(t, feature, begin, end, cond, lit_or), output_name, dt)


# ---- PL12 order content recall -------------------------------------------------------

def order_recall_rows(t: Tables, begin: str, end: str) -> DataFrame:
    """ST8 rows of the orders whose ``dt`` lies in the range (text values)."""
    return ft.order_recall_rows(t.order.filter(date_between("dt", begin, end)))


def order_recall(t: Tables, begin: str, end: str) -> DataFrame:
    """PL12: ST8 rows summed per (id, feature) after text -> double (AG11)."""
    return ft.sum_text_values(order_recall_rows(t, begin, end))
