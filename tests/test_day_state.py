"""Day partials (AG4, PL3, PL4): equal to the one-scan results, scanning only days without a partial."""

import datetime as dt

import pytest

from lumenrec.plans import day_state as ds
from lumenrec.plans import features as pf
from tests.conftest import rows
from tests.helpers import tables

D = dt.date.fromisoformat


def _tables(spark):
    behavior = [(f"s{i % 5}", f"k{i % 3}", "启航" if i % 2 else "x", "数学" if i % 3 else "英语", str(i % 4), f"t{i % 4}", f"L{i % 2}", f"c{i % 3}",
                 f"2018-09-{1 + i % 9:02d}") for i in range(300) if i % 9 != 4]              # no row on the 5th
    order = [(f"s{i % 5}", f"d{i % 5}", i % 4, 10.1 * i, "勤思", "物理", None, "2018-01-01", f"2018-08-{1 + i % 20:02d}") for i in range(200)]
    return tables(spark, behavior=behavior, order=order)


def _rounded(df):
    return sorted((r.sid, r.feature_name, round(r.value, 6), r.dt) for r in df.collect())


class Watched:
    """Counts the days that are read of the source."""

    def __init__(self, of_days):
        self.of_days, self.asked = of_days, []

    def __call__(self, some):
        self.asked.append(list(some))
        return self.of_days(some)


def test_sliding_range_scans_only_new_days(spark, tmp_path):
    t = _tables(spark)
    path = str(tmp_path / "days")
    source = Watched(ds.event_days(t))
    for begin, end, new in (("2018-09-01", "2018-09-06", 6), ("2018-09-02", "2018-09-07", 1), ("2018-09-02", "2018-09-07", 0),
                            ("2018-09-03", "2018-09-09", 2)):
        source.asked.clear()
        got = _rounded(ds.range_sums(spark, path, source, begin, end, end))
        assert got == _rounded(pf.event_features(t, begin, end, end)) and got
        assert sum(map(len, source.asked)) == new and len(source.asked) <= 1
    assert ds.stored_days(spark, path) == {f"2018-09-{d:02d}" for d in range(1, 10)}        # the day without rows too


def test_the_range_reads_partials_alone(spark, tmp_path):
    t = _tables(spark)
    path = str(tmp_path / "days")
    out = ds.range_sums(spark, path, ds.event_days(t), "2018-09-01", "2018-09-06", "x")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(day" in plan and "Scan ExistingRDD" not in plan


def test_late_rows_are_computed_again(spark, tmp_path):
    t = _tables(spark)
    path = str(tmp_path / "days")
    ds.fill_days(spark, path, ds.event_days(t), ds.days("2018-09-01", "2018-09-03"))
    late = [("s9", "k", "x", "数学", "1", "t", "L", "c", D("2018-09-02"))]
    more = tables(spark, behavior=late)
    both = type(t)(spark, {"behavior": lambda: t.behavior.unionByName(more.behavior)})
    old = _rounded(ds.range_sums(spark, path, ds.event_days(both), "2018-09-01", "2018-09-03", "x"))
    assert old == _rounded(pf.event_features(t, "2018-09-01", "2018-09-03", "x"))
    new = _rounded(ds.range_sums(spark, path, ds.event_days(both), "2018-09-01", "2018-09-03", "x", again=["2018-09-02"]))
    assert new == _rounded(pf.event_features(both, "2018-09-01", "2018-09-03", "x")) != old


def test_merged_features_and_lists_from_partials(spark, tmp_path):
    t = _tables(spark)
    ev, od = ("2018-09-01", "2018-09-08"), ("2018-08-02", "2018-08-19")
    for _ in range(2):
        got = ds.merged_ranges(spark, str(tmp_path), t, ev, od, "x", "2017-12-31")
        assert _rounded(got) == _rounded(pf.merged_features(t, ev, od, "x", "2017-12-31"))
        for name in pf.FAVOR_LISTS:
            assert rows(ds.favor_list(spark, str(tmp_path), t, name, *ev, "x")) == rows(pf.favor_list(t, name, *ev, "x"))


def test_runs_of_days_reach_the_source_as_ranges(spark):
    some = ["2018-09-01", "2018-09-02", "2018-09-03", "2018-09-07", "2018-10-01"]
    df = spark.createDataFrame([(D(d),) for d in ds.days("2018-08-30", "2018-10-02")], "day date")
    assert [str(r.day) for r in df.filter(ds.on_days("day", some)).collect()] == some
    assert str(ds.on_days("day", some)).count(">=") == 3
    assert df.filter(ds.on_days("day", [])).count() == 0


def test_a_cut_off_fill_leaves_what_was_stored(spark, tmp_path):
    t = _tables(spark)
    path = str(tmp_path / "days")
    ds.fill_days(spark, path, ds.event_days(t), ["2018-09-01"])

    def broken(some):
        return ds.event_days(t)(some).selectExpr("sid", "feature_name", "day", "CAST(raise_error('killed') AS double) AS value")

    with pytest.raises(Exception, match="killed"):
        ds.fill_days(spark, path, broken, ["2018-09-01", "2018-09-02"], again=["2018-09-01"])
    assert ds.stored_days(spark, path) == {"2018-09-01"}
    got = ds.range_sums(spark, path, ds.event_days(t), "2018-09-01", "2018-09-01", "x")
    assert _rounded(got) == _rounded(pf.event_features(t, "2018-09-01", "2018-09-01", "x"))
