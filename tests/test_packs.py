"""Packs (NS7, NS8, AG8-AG10), the key-value export (SNK5, SRC16)."""

import json

from lumenrec.operators import packs
from lumenrec.plans import serve as psv
from tests.helpers import tables

SCORE = [
    # cla_id, city, type, subject, subject_ids, term, grade, level, times, dates, score
    ("101", "c1", 1, "数学", 2, "1", "g1", "启航班", "T1", "2017-1", 0.9),
    ("102", "c1", 2, "数学", 2, "1", "g1", "启航班", "T1", "2017-1", 1.25),
    ("103", "c1", None, "英语", 3, "2", "g1", None, "T2", "2017-2", 12345678.9),
    ("104", "c1", 1, "数学", 2, "1", "g2", "启航班", "T1", "2017-1", 1.0),
]


KLASS = [
    # cla_id, city, grade, term, subject, level, type, year, subject_ids, times, dates
    ("101", "c1", "g1", "1", "数学", "启航班", "1", "2017", 2, "C1", "2017/1"),
    ("102", "c1", "g1", "1", "数学", "启航班", "2", "2017", 2, "C1", "2017/1"),
    ("103", "c1", "g1", "2", "英语", None, None, "2017", 3, "C2", "2017/2"),
    ("104", "c1", "g2", "1", "数学", "启航班", "1", "2017", 2, "C1", "2017/1"),
]


def _recs(spark):
    return spark.createDataFrame([("s1", "c1", "103"), ("s1", "c1", "101"), ("s1", "c1", "102"), ("s2", "c1", "104")],
                                 "sid string, city_id string, cla_id string")


def _entries(df, key):
    out = {}
    for r in df.orderBy("cla_id").collect():
        out.setdefault((r[key], r.section), []).append(json.loads(r.entry))
    return out


def test_student_pack_online_offline(spark):
    t = tables(spark, score=SCORE)
    got = _entries(psv.student_pack(t, _recs(spark)), "sid")
    assert set(got) == {("s1", "online_recom"), ("s1", "offine_recom"), ("s2", "online_recom")}
    assert [e["cla_id"] for e in got["s1", "online_recom"]] == ["101"]
    assert [e["cla_id"] for e in got["s1", "offine_recom"]] == ["102", "103"]   # null type goes offline
    e = got["s1", "online_recom"][0]
    assert list(e) == packs.INFO_FIELDS
    assert e["getScore"] == "0.9" and e["cla_subject_ids"] == "2" and e["cla_class_type"] == "1"
    off = got["s1", "offine_recom"][1]
    assert off["cla_level_name"] is None and off["getScore"] == "1.2345679E7"   # Float.toString form


def test_rendered_values(spark):
    t = tables(spark, score=SCORE, klass=KLASS)
    got = {r.sid: r.value for r in packs.render(psv.student_pack(t, _recs(spark)), "sid").collect()}
    s1 = json.loads(got["s1"])
    assert list(s1) == ["online_recom", "offine_recom"]
    assert [e["cla_id"] for e in s1["offine_recom"]] == ["102", "103"]
    assert json.loads(got["s2"])["offine_recom"] == []
    keyed = {r.sid: json.loads(r.value)
             for r in packs.render(psv.student_pack_keyed(t, _recs(spark)), "sid", keyed=True).collect()}
    assert list(keyed["s1"]["online_recom"]) == ["101"]
    assert list(keyed["s1"]["offine_recom"]) == ["102", "103"]
    assert keyed["s2"]["offine_recom"] == {}


def test_keyed_pack_takes_attributes_from_the_class_table(spark):
    t = tables(spark, score=SCORE, klass=KLASS)
    got = _entries(psv.student_pack_keyed(t, _recs(spark)), "sid")
    e = got["s1", "offine_recom"][0]
    assert e["cla_id"] == "102" and e["cla_classtime_names"] == "C1" and e["cla_classdate_name"] == "2017/1"
    assert e["getScore"] == "1.25"
    assert _entries(psv.student_pack(t, _recs(spark)), "sid")["s1", "offine_recom"][0]["cla_classtime_names"] == "T1"


def test_keyed_pack_chooses_among_repeats(spark):
    twice = SCORE + [("101", "c1", 1, "数学", 2, "1", "g1", "启航班", "T1", "2017-1", 7.5)]
    for score in (twice, twice[::-1]):
        got = _entries(psv.student_pack_keyed(tables(spark, score=score, klass=KLASS), _recs(spark)), "sid")
        assert [e["getScore"] for e in got["s1", "online_recom"]] == ["7.5"]


def test_fallback_pack_groups(spark):
    t = tables(spark, score=SCORE)
    got = {k: [e["cla_id"] for e in v] for (k, _), v in _entries(psv.fallback_pack(t), "key").items()}
    assert got == {"c1_g1_数学": ["101", "102"], "c1_g1_英语": ["103"], "c1_g2_数学": ["104"]}


def test_large_key_is_whole_and_shrinks_whole(spark):
    def kv(n):
        many = [(str(1000 + i), "c1", 2, "数学", 2, "1", "g1", "x", "T1", "2017-1", 1.0) for i in range(n)]
        return psv.kv_records(psv.fallback_pack(tables(spark, score=many)), psv.GROUP_KEY_PREFIX, "key", "2001-01-01")

    key = "recommend_c1_g1_数学"
    big, small = kv(2500), kv(10)
    r = psv.kv_get(big, key).first()
    assert r.n_entries == 2500
    assert [e["cla_id"] for e in json.loads(r.value)] == sorted(str(1000 + i) for i in range(2500))
    after = psv.upsert(big, small)
    assert after.count() == 10 and psv.kv_get(after, key).first().n_entries == 10


def test_kv_export_lookup_and_upsert(spark):
    t = tables(spark, score=SCORE)
    kv = psv.kv_export(psv.student_pack(t, _recs(spark)), psv.fallback_pack(t), "2001-01-01")
    r = psv.kv_get(kv, "recommend_studentid_s1").first()
    assert r.ttl_s == 2592000 and r.expires_at == "2001-01-31 00:00:00" and r.n_entries == 3
    assert psv.kv_get(kv, "recommend_none").first() is None
    scan = psv.kv_scan_prefix(kv, "recommend_studentid_", 1)
    assert {x.key for x in scan.collect()} == {"recommend_studentid_s1"} and scan.count() == 3
    newer = kv.filter("key = 'recommend_studentid_s1' AND cla_id = '101'")
    up = psv.upsert(kv, newer)
    assert up.count() == kv.count() - 2
    assert psv.kv_get(up, "recommend_studentid_s1").first().n_entries == 1
