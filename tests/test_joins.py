"""Containment join against a plain loop, with a hot group and adaptive skew splitting on and off."""

import random

import pytest

from pyspark.sql import functions as F

from lumenrec.operators.joins import containment_join, set_key, subset_keys


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_containment_join_equals_loop(spark, adaptive):
    rnd = random.Random(3)
    tokens = ["a", "b", "c", "d", ""]
    items = [(f"s{i}", "hot" if i % 3 else f"g{i % 4}", rnd.sample(tokens, 3)) for i in range(200)]
    sets = [(r, g, left) for r, (g, left) in enumerate(
        (g, left) for g in ("hot", "g0", "g1") for left in ([], ["a"], ["a", "b"], ["b", "b", "c"], [""], None))]
    want = sorted((s, r) for s, g, have in items for r, h, left in sets
                  if g == h and left is not None and set(left) <= set(have))
    before = spark.conf.get("spark.sql.adaptive.skewJoin.enabled")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", adaptive)
    got = containment_join(spark.createDataFrame(items, "sid string, grp string, have array<string>"), ["sid"], "have",
                           spark.createDataFrame(sets, "rule int, grp string, need array<string>"), ["rule"], "need", ["grp"])
    assert sorted((r.sid, r.rule) for r in got.collect()) == want
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", before)


def test_subset_keys_are_all_subsets(spark):
    rows = [(["b", "a", ""],), (["x", "x"],), ([],), (None,), (["a", None],)]
    got = [r.k for r in spark.createDataFrame(rows, "t array<string>").select(subset_keys("t").alias("k")).collect()]
    assert sorted(map(tuple, got[0])) == [(), ("",), ("", "a"), ("", "a", "b"), ("", "b"), ("a",), ("a", "b"), ("b",)]
    assert [sorted(map(tuple, g)) if g is not None else None for g in got[1:]] == [[(), ("x",)], [()], None, [(), ("a",)]]


def test_set_keys(spark):
    rows = [(["b", "a", "b"],), ([],), (None,), (["a", None],)]
    got = [r.k for r in spark.createDataFrame(rows, "t array<string>").select(set_key("t").alias("k")).collect()]
    assert got == [["a", "b"], [], None, None]


def test_too_many_tokens_fail_instead_of_losing_subsets(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d"],)], "t array<string>")
    with pytest.raises(Exception, match="more than 3 tokens"):
        df.select(subset_keys("t")).collect()
    assert len(df.select(subset_keys("t", 4).alias("k")).first().k) == 16


def test_repeated_rows_pair_as_often_as_they_are_repeated(spark):
    items = spark.createDataFrame([("s", "g", ["a", ""])] * 2, "sid string, grp string, have array<string>")
    sets = spark.createDataFrame([(1, "g", ["a"]), (1, "g", ["a", "a"]), (2, "g", [""]), (3, "g", ["z"])], "rule int, grp string, need array<string>")
    got = containment_join(items, ["sid"], "have", sets, ["rule"], "need", ["grp"])
    assert sorted(r.rule for r in got.collect()) == [1, 1, 1, 1, 2, 2]


def test_hot_group_is_split(spark, tmp_path):
    """A group with nearly all items: adaptive execution splits its partition, the result stays whole."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        items = spark.range(60_000).select(F.concat(F.lit("s"), "id").alias("sid"), F.when(F.col("id") % 50 == 0, F.concat(F.lit("g"), F.col("id") % 7))
                                           .otherwise("hot").alias("grp"), F.array(F.lit("a"), F.lit("b"), F.lit("")).alias("have")).repartition(16)
        sets = spark.createDataFrame([(i, "hot", ["a"]) for i in range(3)], "rule int, grp string, need array<string>")
        out = containment_join(items, ["sid"], "have", sets, ["rule"], "need", ["grp"])
        out.write.format("noop").mode("overwrite").save()
        assert out.count() == 3 * (60_000 - 60_000 // 50)
        out.collect()
        assert "skewed" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
