"""Every registered query against its DuckDB oracle on the sf0.001 driver tables
(the same comparison the driver runs at sf0.01: columns, row count, value multiset)."""

import os

import pytest

import __spark_entry__ as E
from tools.check_oracle import duck, rows_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


from lumenrec.queries import REGISTRY  # noqa: E402
from lumenrec.stored_queries import STORED  # noqa: E402


def test_every_query_has_an_oracle():
    missing = sorted(set(REGISTRY) - set(E.oracle_sql()))
    assert missing == []


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    s_counts, s_cols = rows_of(sdf.columns, [tuple(r) for r in sdf.collect()])
    res = con.execute(E.oracle_sql()[name])
    o_counts, o_cols = rows_of([d[0] for d in res.description], res.fetchall())
    assert s_cols == o_cols
    assert sum(s_counts.values()) == sum(o_counts.values())
    assert s_counts == o_counts


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["sid", "section", "cla_id", "entry"]
    assert df.count() >= 0


def test_every_stored_query_has_an_oracle():
    assert sorted(set(STORED) - set(E.oracle_sql())) == [] and not set(STORED) & set(REGISTRY)


@pytest.mark.parametrize("name", sorted(STORED))
def test_stored_query_matches_oracle(spark, con, name):
    test_query_matches_oracle(spark, con, name)
