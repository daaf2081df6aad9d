"""Mergeable day partials of feature weights (AG4, PL3).

Weights are sums, and sums over days add up.  A state table keeps, per day, the
sum of each (sid, feature); a range then reads its days' partials, and only
days without one are computed from the source, all in one scan.  A partial is
smaller than its day by the repetitions it sums up, and a sliding range of 27
days scans one new day of the source instead of 27.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenrec.functions import date_between, is_valid
from lumenrec.operators import features as ft
from lumenrec.operators.ranking import top3_json
from lumenrec.plans import features as pf
from lumenrec.sinks.files import Folder
from lumenrec.sinks.tables import recover, replace_slices
from lumenrec.sources.tables import Tables

STATE = "sid string, feature_name string, value double, day string"


def days(begin: str, end: str) -> list[str]:
    """The days of a closed range as text."""
    a, b = dt.date.fromisoformat(begin), dt.date.fromisoformat(end)
    return [(a + dt.timedelta(i)).isoformat() for i in range((b - a).days + 1)]


def on_days(column: str, some: Iterable[str]) -> Column:
    """Rows of the given days: a closed range for each run of days, which reach the scan."""
    runs: list[list[str]] = []
    for d in sorted(some):
        if runs and days(runs[-1][1], d)[1:] == [d]:
            runs[-1][1] = d
        else:
            runs.append([d, d])
    cond = F.lit(False)
    for i, (a, b) in enumerate(runs):
        cond = date_between(column, a, b) if i == 0 else cond | date_between(column, a, b)
    return cond


def stored_days(spark: SparkSession, path: str) -> set[str]:
    recover(spark, path)
    return {n.removeprefix("day=") for n in Folder(spark, path).names(path) if n.startswith("day=")}


def fill_days(spark: SparkSession, path: str, of_days: Callable[[list[str]], DataFrame], wanted: list[str],
              again: Iterable[str] = ()) -> list[str]:
    """Compute the partials of the wanted days that are not stored, and of those in ``again``
    (late rows), in one scan; returns these days.

    ``of_days(days)`` gives rows ``(day, sid, feature_name, value)`` of the source.  A day without
    rows is stored as an empty one, so it is not asked again.
    """
    have = stored_days(spark, path)
    missing = [d for d in wanted if d not in have or d in set(again)]
    if missing:
        rows = of_days(missing).select("sid", "feature_name", "value", F.col("day").cast("string").alias("day"))
        sums = rows.groupBy("sid", "feature_name", "day").agg(F.sum("value").alias("value"))
        replace_slices(sums.select("sid", "feature_name", "value", "day"), path, "day", missing)
    return missing


def range_sums(spark: SparkSession, path: str, of_days: Callable[[list[str]], DataFrame], begin: str, end: str,
               stamp: str, again: Iterable[str] = ()) -> DataFrame:
    """AG4: the weights over a closed range of days, from partials alone:
    ``(sid, feature_name, value, dt)``."""
    fill_days(spark, path, of_days, days(begin, end), again)
    state = spark.read.schema(STATE).option("basePath", path).parquet(path)
    return ft.sum_weights(state.filter(F.col("day").between(begin, end)).drop("day"), stamp)


def event_days(t: Tables) -> Callable[[list[str]], DataFrame]:
    """PL2's triples of given days of behaviour."""
    return lambda some: ft.event_triples(ft.valid_events(t.behavior.filter(on_days("day", some))), "day")


def order_days(t: Tables, created_after: str) -> Callable[[list[str]], DataFrame]:
    """PL1's triples of given days of orders (``day``: the order's ``dt``)."""
    def rows(some: list[str]) -> DataFrame:
        valid = ft.valid_orders(t.order.filter(on_days("dt", some)), None, None, created_after)
        return ft.order_triples(valid, "dt").withColumnRenamed("dt", "day")
    return rows


def favor_days(t: Tables, feature: str, condition: Column | None = None) -> Callable[[list[str]], DataFrame]:
    """AG3's occurrences of a feature's values on given days of behaviour, one row each."""
    def rows(some: list[str]) -> DataFrame:
        keep = is_valid("sid") & is_valid(feature) & on_days("day", some)
        if condition is not None:
            keep = keep & condition
        return t.behavior.filter(keep).select("day", "sid", F.col(feature).alias("feature_name"), F.lit(1.0).alias("value"))
    return rows


def favor_list(spark: SparkSession, root: str, t: Tables, output_name: str, begin: str, end: str, stamp: str,
               again: Iterable[str] = ()) -> DataFrame:
    """PL4 from the partials of each day: the same list as ``features.favor_list``."""
    feature, condition = pf.favor_source(output_name)
    counts = range_sums(spark, f"{root}/{output_name}_days", favor_days(t, feature, condition), begin, end, stamp, again)
    return top3_json(counts.drop("dt"), output_name, stamp)


def merged_ranges(spark: SparkSession, root: str, t: Tables, event_range: tuple[str, str], order_range: tuple[str, str],
                  stamp: str, created_after: str) -> DataFrame:
    """PL3's third output from the partials of both sources."""
    a = range_sums(spark, f"{root}/event_days", event_days(t), *event_range, stamp)
    b = range_sums(spark, f"{root}/order_days", order_days(t, created_after), *order_range, stamp)
    return ft.merge(a, b, stamp)
