"""End-to-end jobs on the sf0.001 tables: written tables equal the registered queries."""

import json
import os

import pytest

import __spark_entry__ as E
from lumenrec import jobs
from lumenrec.sources import fixtures as fx
from tests.conftest import rows
from tests.helpers import tables

SF = "/root/testdata/sf0.001"
SF_CITIES = "/root/testdata/sf0.01"     # several cities
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


def test_flagship_job_matches_query_and_reruns_idempotently(spark, tmp_path):
    t = fx.bind_fixtures(spark, SF)
    out = str(tmp_path)
    p = jobs.flagship_job(t, out, fx.AS_OF, fx.PAY_AFTER)
    first = rows(spark.read.parquet(p["kv_student"]), "key", "cla_id", "value")
    jobs.flagship_job(fx.bind_fixtures(spark, SF), out, fx.AS_OF, fx.PAY_AFTER)   # same-day rerun
    again = rows(spark.read.parquet(p["kv_student"]), "key", "cla_id", "value")
    assert first == again
    want = rows(E.queries()["serve_pack"](spark, SF).selectExpr("concat('recommend_studentid_', sid)", "cla_id", "entry"))
    assert first == want
    free = spark.read.parquet(p["recommended_free"])
    assert free.filter("cla_id IS NULL OR cla_id = ''").count() == 0
    assert rows(free, "sid", "city_id", "cla_id") == rows(E.queries()["conflict_free"](spark, SF))


TABLES = ("recommended", "recommended_free", "class_schedule", "kv_student", "register_rejects")


def test_city_runs_share_a_folder(spark, tmp_path):
    """City 0, city 1, city 0 again in one folder: the rows of both cities of the all-city run."""
    t = fx.bind_fixtures(spark, SF_CITIES)
    whole = jobs.flagship_job(t, str(tmp_path / "all"), fx.AS_OF, fx.PAY_AFTER)
    for city in ("0", "1", "0"):
        one = jobs.flagship_job(t, str(tmp_path / "one"), fx.AS_OF, fx.PAY_AFTER, city=city)
    for name in TABLES:
        a = spark.read.parquet(whole[name]).filter("city_id IN ('0', '1')")
        b = spark.read.parquet(one[name])
        assert rows(a.select(*sorted(a.columns))) == rows(b.select(*sorted(a.columns))), name
        assert {r.city_id for r in b.select("city_id").distinct().collect()} == {"0", "1"}, name


def test_token_reuse_depends_on_day_and_pay_date(spark, tmp_path):
    t = fx.bind_fixtures(spark, SF)
    out = jobs.Output(spark, str(tmp_path))
    first = rows(jobs._tokens(t, out, fx.AS_OF, fx.PAY_AFTER).select("sid"))
    none = tables(spark, student=[], user=[], regist=[], klass=[])
    assert rows(jobs._tokens(none, out, fx.AS_OF, fx.PAY_AFTER).select("sid")) == first        # read back
    assert rows(jobs._tokens(none, out, fx.AS_OF, "1997-01-01").select("sid")) == []           # other pay date
    assert rows(jobs._tokens(none, out, "2001-01-02", fx.PAY_AFTER).select("sid")) == []       # other day


def test_keyed_and_fallback_jobs_into_a_catalog(spark, tmp_path):
    spark.sql("DROP DATABASE IF EXISTS served CASCADE")
    spark.sql(f"CREATE DATABASE served LOCATION '{tmp_path / 'db'}'")
    t = fx.bind_fixtures(spark, SF)
    jobs.keyed_job(t, str(tmp_path / "out"), fx.AS_OF, fx.PAY_AFTER, database="served")
    jobs.fallback_job(t, str(tmp_path / "out"), fx.AS_OF, database="served")
    want = rows(E.queries()["serve_pack_keyed"](spark, SF).selectExpr("concat('recommend_studentid_', sid)", "cla_id", "entry"))
    assert rows(spark.table("served.kv_student_keyed"), "key", "cla_id", "value") == want
    want = rows(E.queries()["fallback_pack"](spark, SF).selectExpr("concat('recommend_', key)", "cla_id", "entry"))
    assert rows(spark.table("served.kv_fallback"), "key", "cla_id", "value") == want
    spark.sql("DROP DATABASE served CASCADE")


def test_feature_and_list_jobs(spark, tmp_path):
    t = fx.bind_fixtures(spark, SF)
    p = jobs.feature_job(t, str(tmp_path), (fx.EVENT_BEGIN, fx.EVENT_END), (fx.ORDER_BEGIN, fx.ORDER_END),
                         fx.ORDER_END, fx.CREATED_AFTER)
    merged = rows(spark.read.parquet(p["orderevent_features"]), "sid", "feature_name", "value")
    want = rows(E.queries()["merge_features"](spark, SF), "sid", "feature_name", "value")
    assert [(s, f, round(v, 6)) for s, f, v in merged] == want
    lp = jobs.list_job(t, str(tmp_path), fx.EVENT_BEGIN, fx.EVENT_END, fx.EVENT_END)
    lists = spark.read.parquet(lp)
    assert {r.feature_name for r in lists.select("feature_name").distinct().collect()} == \
        {"teacher_favor", "class_location_favor", "class_time_favor"}
    assert all(len(json.loads(r.value)) == 3 for r in lists.collect())


def test_store_follows_the_runs(spark, tmp_path):
    """Two cities pushed by their own runs, then the first again with fewer students: the store holds
    what the last runs exported and nothing else."""
    from tests.test_sinks import _store
    folder = str(tmp_path / "store")
    store = _store(folder)
    t = fx.bind_fixtures(spark, SF_CITIES)
    out = str(tmp_path / "out")
    for city in ("0", "1"):
        p = jobs.flagship_job(t, out, fx.AS_OF, fx.PAY_AFTER, city=city, client_factory=store)
    keys = {r.key for r in spark.read.parquet(p["kv_student"]).select("key").distinct().collect()}
    assert set(os.listdir(folder)) == keys and keys
    fewer = type(t)(spark, {**t.loaders, "location": lambda: t.location.filter("sid % 2 = 0")})
    jobs.flagship_job(fewer, out, fx.AS_OF, fx.PAY_AFTER, city="0", client_factory=store)
    after = {r.key for r in spark.read.parquet(p["kv_student"]).select("key").distinct().collect()}
    assert set(os.listdir(folder)) == after and after < keys
    rejects = spark.read.parquet(f"{out}/rejects")
    assert {(r.source, r.reason) for r in rejects.collect()} == {
        ("rule", "bad_json"), ("rule", "null_left"), ("location", "null_depart_4"), ("register", "missing_time")}
    assert rejects.filter("reason = 'missing_time' AND n_rejected > 0").count() == 2        # of both cities


def test_jobs_from_states_write_the_same_tables(spark, tmp_path):
    """Features and lists from day partials, recommendations from the token state: the tables of the plain jobs."""
    t = fx.bind_fixtures(spark, SF)
    ranges = ((fx.EVENT_BEGIN, fx.EVENT_END), ("2000-06-01", "2000-06-20"))
    plain, kept = str(tmp_path / "plain"), str(tmp_path / "kept")
    a = jobs.feature_job(t, plain, *ranges, "d", fx.CREATED_AFTER)
    for _ in range(2):
        b = jobs.feature_job(t, kept, *ranges, "d", fx.CREATED_AFTER, state=str(tmp_path / "days"))
    for name in ("event_features", "order_features", "orderevent_features"):
        x, y = (sorted((r.sid, r.feature_name, round(r.value, 6)) for r in spark.read.parquet(p[name]).collect()) for p in (a, b))
        assert x == y and x, name
    la = jobs.list_job(t, plain, *ranges[0], "d")
    lb = jobs.list_job(t, kept, *ranges[0], "d", state=str(tmp_path / "days"))
    assert rows(spark.read.parquet(la)) == rows(spark.read.parquet(lb))
    state = jobs.token_state_job(t, str(tmp_path / "tokens"), fx.PAY_AFTER)
    none = t.regist.limit(0)
    assert jobs.token_state_job(t, state, fx.PAY_AFTER, none, t.regist.filter("reg_isdeleted = 1")) == state
    free = jobs.flagship_job(t, kept, fx.AS_OF, fx.PAY_AFTER, state=state)["recommended_free"]
    assert rows(spark.read.parquet(free), "sid", "city_id", "cla_id") == rows(E.queries()["conflict_free"](spark, SF))
