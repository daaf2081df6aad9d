"""DuckDB oracle texts: the fixture views of FIXTURES.md §2 as CTEs, plus one
independent SQL formulation per registered query.

The raw driver tables are pre-registered views (``part``, ``lineitem`` ...).
Values that are float sums are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

FIXTURE_VIEWS = r"""
fx_class AS (
 SELECT CAST(p_partkey AS VARCHAR) AS cla_id, CAST(CAST(floor(p_partkey/400.0) AS BIGINT) AS VARCHAR) AS city_id,
 CASE CAST(floor(p_partkey/5.0) AS BIGINT) % 5 WHEN 0 THEN 'BUILDING' WHEN 1 THEN 'FURNITURE' WHEN 2 THEN 'MACHINERY' WHEN 3 THEN 'HOUSEHOLD' ELSE 'AUTOMOBILE' END AS cla_grade_id,
 CAST(p_size % 6 AS VARCHAR) AS cla_term_id,
 CASE p_type WHEN 'MEDIUM' THEN '数学' WHEN 'STANDARD' THEN '语文' WHEN 'LARGE' THEN '英语' WHEN 'PROMO' THEN '物理' WHEN 'SMALL' THEN '化学' ELSE '生物' END AS cla_subject_names,
 CASE split_part(p_name,' ',2) WHEN 'widget' THEN '启航班' WHEN 'plate' THEN '勤思班' WHEN 'ring' THEN '敏学班' WHEN 'rod' THEN '博学班' WHEN 'bolt' THEN '创新班' WHEN 'gizmo' THEN '兴趣班' ELSE '-' END AS cla_level_name,
 CAST(p_partkey % 4 AS VARCHAR) AS cla_class_type, CAST(2016 + p_size % 3 AS VARCHAR) AS cla_year,
 CASE WHEN p_partkey % 4 = 1 THEN 'live-class-service-center' ELSE 'L' || CAST(p_partkey % 3 AS VARCHAR) END AS loc,
 p_brand AS cla_teacher_ids, CAST(p_size % 6 + 1 AS BIGINT) AS cla_subject_ids, 'C' || CAST(p_size % 6 AS VARCHAR) AS cla_classtime_names,
 CAST(2016 + p_size % 3 AS VARCHAR) || '/' || CAST(p_size % 6 AS VARCHAR) AS cla_classdate_name, p_retailprice/1000 AS fin_score FROM part),
fx_student AS (
 SELECT CAST(c_custkey AS VARCHAR) AS stu_id, CAST(c_custkey AS VARCHAR) AS stu_uid, CAST(CAST(floor(c_custkey/300.0) AS BIGINT) AS VARCHAR) AS city_id, c_mktsegment AS stu_grade_id
 FROM customer),
fx_user AS (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_acctbal > 0),
fx_regist AS (
 SELECT CAST(o_custkey AS VARCHAR) AS reg_student_id, CAST(l_partkey AS VARCHAR) AS reg_class_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS reg_pay_date,
 CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 0 END AS reg_ispay, CASE l_returnflag WHEN 'R' THEN 1 ELSE 0 END AS reg_isdeleted
 FROM lineitem JOIN orders ON l_orderkey=o_orderkey),
fx_order AS (
 SELECT CAST(o_custkey AS VARCHAR) AS sid, 'd' || CAST(o_custkey AS VARCHAR) AS distinctid, CASE WHEN l_returnflag='R' THEN 3 WHEN o_orderstatus='F' THEN 2 WHEN o_orderstatus='O' THEN 1 ELSE 0 END AS orderstatus,
 l_extendedprice*0.02 AS classprice, cla_level_name AS classlevelname, cla_subject_names AS subjectname,
 CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS startdate,
 CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS finacreatedate, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS dt
 FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN fx_class ON cla_id=CAST(l_partkey AS VARCHAR)),
fx_behavior AS (
 SELECT CAST(user_id AS VARCHAR) AS sid, c.cla_id, cla_level_name, cla_subject_names, cla_class_type, cla_teacher_ids, loc AS cla_servicecenter_id,
 event_type AS cla_classtime_ids, CAST(CAST(ts AS DATE) AS VARCHAR) AS day
 FROM events JOIN fx_class c ON c.cla_id = regexp_extract(props, '([0-9]+)', 1)),
fx_curriculum AS (
 SELECT CAST(l_partkey AS VARCHAR) AS cuc_class_id, CAST(l_shipdate AS DATE) AS cuc_class_date,
 lpad(CAST(8+l_linenumber AS VARCHAR),2,'0') || ':00' AS cuc_start_time, lpad(CAST(10+l_linenumber AS VARCHAR),2,'0') || ':00' AS cuc_end_time,
 CAST(CAST(floor(l_partkey/400.0) AS BIGINT) AS VARCHAR) AS city_id FROM lineitem),
fx_location AS (
 SELECT CAST(c_custkey AS VARCHAR) AS sid, CAST(CAST(floor(c_custkey/300.0) AS BIGINT) AS VARCHAR) AS city_id,
 'L' || CAST(c_custkey % 3 AS VARCHAR) || ',L' || CAST(c_custkey % 2 AS VARCHAR) AS depart_4
 FROM customer),
fx_rule_long AS (
 SELECT city_id, cla_grade_id AS grade_id, CASE WHEN cla_subject_names='生物' THEN '其他' ELSE cla_subject_names END || '_' || cla_term_id AS left_token, loc, cla_id FROM fx_class),
fx_registered AS (
 SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS sid, CAST(l_partkey AS VARCHAR) AS cla_id FROM lineitem JOIN orders ON l_orderkey=o_orderkey
 WHERE l_linestatus='F' AND l_returnflag='N'),
fx_score AS (
 SELECT cla_id, city_id, CAST(cla_class_type AS BIGINT) AS cla_class_type, cla_subject_names, CAST(cla_term_id AS BIGINT)+1 AS cla_subject_ids, cla_term_id, cla_grade_id,
 cla_level_name, 'T' || cla_term_id AS cla_classtime_names, cla_year || '-' || cla_term_id AS cla_classdate_name, fin_score FROM fx_class),
fx_session AS (
 SELECT cuc_class_id AS cla_id, cuc_class_date AS d, min(cuc_start_time) AS st, min(cuc_end_time) AS et FROM fx_curriculum
 WHERE cuc_class_date > DATE '2001-01-01' GROUP BY 1,2),
fx_packed AS (
 SELECT *, CAST(cla_id AS BIGINT) % 13 = 0 AND count(*) OVER (PARTITION BY cla_id) > 1 AND d = max(d) OVER (PARTITION BY cla_id) AS no_start
 FROM fx_session)
"""

# Column expressions of the scalar functions, written as SQL CASE chains.
def level_sql(x: str) -> str:
    return (f"CASE WHEN {x} LIKE '%启航%' THEN '_lev_1' WHEN {x} LIKE '%勤思%' THEN '_lev_2' "
            f"WHEN {x} LIKE '%勤学%' THEN '_lev_2' WHEN {x} LIKE '%敏学%' THEN '_lev_3' "
            f"WHEN {x} LIKE '%博学%' THEN '_lev_4' WHEN {x} LIKE '%创新%' THEN '_lev_5' "
            f"WHEN {x} LIKE '%兴趣%' THEN '_lev_6' ELSE '0' END")


def subject_sql(x: str) -> str:
    return (f"CASE WHEN {x} LIKE '%语文%' THEN 'chn' WHEN {x} LIKE '%数学%' THEN 'math' "
            f"WHEN {x} LIKE '%英语%' THEN 'eng' WHEN {x} LIKE '%物理%' THEN 'phy' "
            f"WHEN {x} LIKE '%化学%' THEN 'chem' WHEN {x} LIKE '%综合%' THEN 'comp' ELSE 'other' END")


def subject_rule_sql(x: str) -> str:
    return (f"CASE WHEN {x} LIKE '%语文%' THEN '语文' WHEN {x} LIKE '%数学%' THEN '数学' "
            f"WHEN {x} LIKE '%英语%' THEN '英语' WHEN {x} LIKE '%物理%' THEN '物理' "
            f"WHEN {x} LIKE '%化学%' THEN '化学' WHEN {x} LIKE '%综合%' THEN '综合' ELSE '其他' END")


def type_sql(x: str) -> str:
    return f"CASE WHEN {x} IN ('1','2','3') THEN '_tp_' || {x} ELSE '_tp_0' END"


def status_weight_sql(s: str) -> str:
    s = f"coalesce({s}, 0)"
    return f"CASE {s} WHEN 0 THEN 3.0 WHEN 1 THEN 5.0 WHEN 2 THEN 7.0 WHEN 3 THEN -2.0 ELSE 1.0 END"


def price_sql(s: str, p: str) -> str:
    s, p = f"coalesce({s}, 0)", f"coalesce({p}, 0.0)"
    return (f"CASE {s} WHEN 0 THEN (CASE WHEN {p} < 1000 THEN {p} ELSE {p}/10.0 END) "
            f"WHEN 1 THEN (CASE WHEN {p} < 1000 THEN {p} ELSE {p}/5.0 END) "
            f"WHEN 2 THEN (CASE WHEN {p} < 1000 THEN {p} ELSE {p}/2.0 END) "
            f"WHEN 3 THEN {p}/1000.0 ELSE 0.0 END")


def valid_sql(x: str) -> str:
    return f"({x} IS NOT NULL AND {x} <> '' AND {x} <> '-')"


def with_views(body: str) -> str:
    return "WITH " + FIXTURE_VIEWS.strip() + ",\n" + body


_EV = (f"SELECT * FROM fx_behavior WHERE {valid_sql('cla_id')} AND {valid_sql('sid')} "
       f"AND day BETWEEN '2024-01-10' AND '2024-01-20'")
_OD = (f"SELECT * FROM fx_order WHERE {valid_sql('sid')} AND finacreatedate > '1996-09-01' "
       f"AND dt BETWEEN '1995-01-01' AND '2001-08-01'")

_EV_TRIPLES = f"""
 SELECT sid, {subject_sql('cla_subject_names')} || {level_sql('cla_level_name')} AS feature_name, 1.0 AS value FROM ev
 UNION ALL SELECT sid, {subject_sql('cla_subject_names')}, 1.0 FROM ev
 UNION ALL SELECT sid, {subject_sql('cla_subject_names')} || {type_sql('cla_class_type')}, 1.0 FROM ev"""

_OD_TRIPLES = f"""
 SELECT sid, {subject_sql('subjectname')} || {level_sql('classlevelname')} AS feature_name, {status_weight_sql('orderstatus')} AS value FROM od
 UNION ALL SELECT sid, {subject_sql('subjectname')}, 2.0 FROM od
 UNION ALL SELECT sid, {subject_sql('subjectname')} || 'price', {price_sql('orderstatus', 'classprice')} FROM od"""


def _features(triples: str, dt: str) -> str:
    return (f"SELECT sid, feature_name, round(sum(value), 6) AS value, '{dt}' AS dt "
            f"FROM ({triples}) t GROUP BY sid, feature_name")


QUERIES: dict[str, str] = {}

QUERIES["event_features"] = with_views(
    f"ev AS ({_EV})\n" + _features(_EV_TRIPLES, "2024-01-20"))

QUERIES["order_features"] = with_views(
    f"od AS ({_OD})\n" + _features(_OD_TRIPLES, "2001-08-01"))

QUERIES["merge_features"] = with_views(
    f"ev AS ({_EV}), od AS ({_OD})\n" + _features(_EV_TRIPLES + "\n UNION ALL " + _OD_TRIPLES, "2001-08-01"))

# ---- PL4 preference lists ------------------------------------------------------------

def _favor(feature: str, output: str, extra: str = "") -> str:
    return with_views(f"""
cnt AS (SELECT sid, {feature} AS feature_name, CAST(count(*) AS DOUBLE) AS value FROM fx_behavior
  WHERE {valid_sql('sid')} AND day BETWEEN '2024-01-10' AND '2024-01-20' AND {valid_sql(feature)} {extra}
  GROUP BY 1, 2),
rk AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY value DESC, feature_name ASC) AS rn FROM cnt)
SELECT sid, '{output}' AS feature_name,
  CAST(json_object('1', coalesce(max(CASE WHEN rn = 1 THEN feature_name END), ''),
                   '2', coalesce(max(CASE WHEN rn = 2 THEN feature_name END), ''),
                   '3', coalesce(max(CASE WHEN rn = 3 THEN feature_name END), '')) AS VARCHAR) AS value,
  '2024-01-20' AS dt
FROM rk WHERE rn <= 3 GROUP BY sid""")


QUERIES["favor_teacher"] = _favor("cla_teacher_ids", "teacher_favor")
QUERIES["favor_location"] = _favor("cla_servicecenter_id", "class_location_favor")
QUERIES["favor_classtime"] = _favor("cla_classtime_ids", "class_time_favor", "AND cla_class_type IN ('1', '3')")

# ---- PL12 order content recall ---------------------------------------------------------

QUERIES["order_recall"] = with_views(f"""
od AS (SELECT * FROM fx_order WHERE dt BETWEEN '1995-01-01' AND '2001-08-01'),
r AS (SELECT distinctid, {subject_sql('subjectname')} || {level_sql('classlevelname')} AS feature_name,
             {status_weight_sql('orderstatus')} AS value FROM od
      UNION ALL SELECT distinctid, 'price', coalesce(classprice, 0.0) FROM od)
SELECT distinctid, feature_name, round(sum(value), 6) AS value, CAST(0 AS BIGINT) AS n_rejected
FROM r GROUP BY distinctid, feature_name""")

# ---- PL5 student tokens ----------------------------------------------------------------

_TOKENS = f"""
live AS (SELECT s.stu_id FROM fx_student s WHERE EXISTS (SELECT 1 FROM fx_user u WHERE u.id = s.stu_uid)),
regs AS (SELECT reg_student_id AS sid, reg_class_id AS cla_id, reg_pay_date FROM fx_regist
  WHERE reg_ispay IN (1, 2) AND reg_isdeleted = 0 AND reg_pay_date > '1996-09-01'
    AND {valid_sql('reg_student_id')} AND {valid_sql('reg_class_id')}
    AND reg_student_id IN (SELECT stu_id FROM live)),
cls AS (SELECT cla_id, cla_term_id, cla_subject_names FROM fx_class
  WHERE cla_year > '2016' AND {valid_sql('cla_id')} AND cla_term_id IN ('1','2','3','4','5')
    AND cla_subject_names IN ('语文','数学','英语','物理','化学','综合','生物')),
tok AS (SELECT r.sid, {subject_rule_sql('c.cla_subject_names')} || '_' || c.cla_term_id AS tok, max(r.reg_pay_date) AS latest
  FROM regs r JOIN cls c ON r.cla_id = c.cla_id GROUP BY 1, 2),
rk AS (SELECT sid, tok, row_number() OVER (PARTITION BY sid ORDER BY latest DESC, tok ASC) AS rn FROM tok),
lists AS (SELECT sid, coalesce(max(CASE WHEN rn = 1 THEN tok END), '') AS t1,
                 coalesce(max(CASE WHEN rn = 2 THEN tok END), '') AS t2,
                 coalesce(max(CASE WHEN rn = 3 THEN tok END), '') AS t3 FROM rk WHERE rn <= 3 GROUP BY sid),
tokens AS (SELECT l.sid, s.city_id, s.stu_grade_id AS grade_id, t1, t2, t3 FROM lists l JOIN fx_student s ON l.sid = s.stu_id
  WHERE s.city_id IS NOT NULL AND s.city_id <> '' AND {valid_sql('s.stu_grade_id')})"""

QUERIES["student_tokens"] = with_views(_TOKENS + """
SELECT sid, city_id, grade_id, t1 || ',' || t2 || ',' || t3 AS left_rule, '2001-01-01' AS dt FROM tokens""")

# ---- PL6 rule match (relational form of the rules) ----------------------------------

_MATCH = _TOKENS + """,
stok AS (SELECT sid, city_id, grade_id, t1 AS tok FROM tokens UNION SELECT sid, city_id, grade_id, t2 FROM tokens
         UNION SELECT sid, city_id, grade_id, t3 FROM tokens),
locs AS (SELECT sid, city_id, unnest(string_split(depart_4, ',')) AS loc FROM fx_location
         UNION SELECT sid, city_id, 'live-class-service-center' FROM fx_location),
matched AS (SELECT DISTINCT s.sid, s.city_id, r.cla_id FROM stok s
  JOIN fx_rule_long r ON s.city_id = r.city_id AND s.grade_id = r.grade_id AND s.tok = r.left_token
  JOIN locs l ON l.sid = s.sid AND l.city_id = s.city_id AND l.loc = r.loc
  WHERE r.cla_id <> '')"""

QUERIES["rule_match"] = with_views(_MATCH + "\nSELECT sid, city_id, cla_id FROM matched")

# ---- PL7 / PL8 schedule side --------------------------------------------------------------

_SCHED = """,
cur AS (SELECT cla_id, city_id, cla_term_id, cla_subject_names, cla_year AS year FROM fx_class
        WHERE cla_id IS NOT NULL AND cla_id <> '' AND cla_id <> '-'),
fut AS (SELECT cuc_class_id AS cla_id, city_id, CAST(cuc_class_date AS VARCHAR) AS d, cuc_start_time AS st, cuc_end_time AS et
        FROM fx_curriculum WHERE cuc_class_date > DATE '2001-01-01'),
ra AS (SELECT m.sid, m.city_id, m.cla_id, c.cla_term_id, c.cla_subject_names, c.year FROM matched m
       JOIN cur c ON c.cla_id = m.cla_id AND c.city_id = m.city_id
       WHERE EXISTS (SELECT 1 FROM fut f WHERE f.cla_id = m.cla_id AND f.city_id = m.city_id)),
reg AS (SELECT r.sid, r.cla_id, st.city_id, c.cla_term_id, c.cla_subject_names, c.cla_year AS year FROM fx_registered r
        JOIN fx_class c ON c.cla_id = r.cla_id JOIN fx_student st ON st.stu_id = r.sid),
reg_sess AS (SELECT reg.sid, reg.city_id, reg.cla_id, CAST(s.d AS VARCHAR) AS d, s.st, s.et FROM reg JOIN fx_packed s ON s.cla_id = reg.cla_id
             WHERE NOT s.no_start),
rec_first AS (SELECT cla_id, city_id, d, st, et FROM (SELECT *, row_number() OVER (PARTITION BY cla_id, city_id, d ORDER BY st, et) AS rn FROM fut) x WHERE rn = 1),
same_key AS (SELECT ra.* FROM ra WHERE NOT EXISTS (
       SELECT 1 FROM reg g WHERE g.sid = ra.sid AND g.city_id = ra.city_id
         AND g.cla_term_id IS NOT DISTINCT FROM ra.cla_term_id
         AND g.cla_subject_names IS NOT DISTINCT FROM ra.cla_subject_names
         AND g.year IS NOT DISTINCT FROM ra.year)),
conflicting AS (SELECT DISTINCT k.sid, k.city_id, k.cla_id FROM same_key k
       JOIN rec_first rf ON rf.cla_id = k.cla_id AND rf.city_id = k.city_id
       JOIN reg_sess f ON f.sid = k.sid AND f.city_id = k.city_id AND f.d = rf.d
       WHERE rf.st <= f.et AND f.st <= rf.et)"""

QUERIES["conflict_free"] = with_views(_MATCH + _SCHED + """
SELECT k.sid, k.city_id, k.cla_id FROM same_key k
WHERE NOT EXISTS (SELECT 1 FROM conflicting c WHERE c.sid = k.sid AND c.city_id = k.city_id AND c.cla_id = k.cla_id)""")

QUERIES["same_subject_exclusion"] = with_views(_MATCH + _SCHED + """
SELECT sid, city_id, cla_id, cla_term_id, cla_subject_names, year FROM same_key""")

QUERIES["time_conflict"] = with_views(_MATCH + _SCHED + """
SELECT sid, city_id, cla_id FROM conflicting""")

QUERIES["curriculum_arrays"] = with_views("""
fut AS (SELECT cuc_class_id AS cla_id, city_id, CAST(cuc_class_date AS VARCHAR) AS d, cuc_start_time AS st, cuc_end_time AS et
        FROM fx_curriculum WHERE cuc_class_date > DATE '2001-01-01')
SELECT cla_id AS cuc_id, city_id,
  string_agg(d, ',' ORDER BY d, st, et) AS date_arr,
  string_agg(st, ',' ORDER BY d, st, et) AS starttime_arr,
  string_agg(et, ',' ORDER BY d, st, et) AS endtime_arr,
  '2001-01-01' AS dt
FROM fut GROUP BY cla_id, city_id""")

QUERIES["packed_split"] = with_views("""
reg AS (SELECT r.sid, r.cla_id, st.city_id FROM fx_registered r JOIN fx_class c ON c.cla_id = r.cla_id
        JOIN fx_student st ON st.stu_id = r.sid)
SELECT reg.sid, reg.city_id, reg.cla_id, CAST(s.d AS VARCHAR) AS d, s.st, s.et FROM reg JOIN fx_packed s ON s.cla_id = reg.cla_id
WHERE NOT s.no_start""")

# ---- PL9-PL11 packs and the key-value export ---------------------------------------------

def _info_sql(a: str) -> str:
    return (f"json_object('cla_id', {a}.cla_id, 'city_id', {a}.city_id, "
            f"'cla_subject_ids', CAST({a}.cla_subject_ids AS VARCHAR), 'cla_class_type', CAST({a}.cla_class_type AS VARCHAR), "
            f"'cla_subject_names', {a}.cla_subject_names, 'cla_term_id', {a}.cla_term_id, 'cla_grade_id', {a}.cla_grade_id, "
            f"'cla_level_name', {a}.cla_level_name, 'cla_classtime_names', {a}.cla_classtime_names, "
            f"'cla_classdate_name', {a}.cla_classdate_name, 'getScore', CAST(CAST({a}.fin_score AS FLOAT) AS VARCHAR))")


def _section_sql(a: str) -> str:
    return f"CASE WHEN CAST({a}.cla_class_type AS BIGINT) = 1 THEN 'online_recom' ELSE 'offine_recom' END"


def _kv_sql(prefix: str, key: str, body: str) -> str:
    return (f"SELECT '{prefix}' || {key} AS key, city_id, section, cla_id, entry AS value, CAST(2592000 AS BIGINT) AS ttl_s, "
            f"CAST(TIMESTAMP '2001-01-01 00:00:00' + INTERVAL 2592000 SECOND AS VARCHAR) AS expires_at FROM {body}")


_FREE = """,
free AS (SELECT k.sid, k.city_id, k.cla_id FROM same_key k
  WHERE NOT EXISTS (SELECT 1 FROM conflicting c WHERE c.sid = k.sid AND c.city_id = k.city_id AND c.cla_id = k.cla_id)),
spack AS (SELECT f.sid, s.city_id, """ + _section_sql("s") + """ AS section, s.cla_id, CAST(""" + _info_sql("s") + """ AS VARCHAR) AS entry
  FROM free f JOIN fx_score s ON s.cla_id = f.cla_id AND s.city_id = f.city_id)"""

_GROUPS = """
gpack AS (SELECT coalesce(city_id, 'null') || '_' || coalesce(cla_grade_id, 'null') || '_' || coalesce(cla_subject_names, 'null') AS key,
  city_id, 'list' AS section, cla_id, CAST(""" + _info_sql("s") + """ AS VARCHAR) AS entry FROM fx_score s),
gkv AS (""" + _kv_sql("recommend_", "key", "gpack") + ")"

QUERIES["serve_pack"] = with_views(_MATCH + _SCHED + _FREE + "\nSELECT sid, section, cla_id, entry FROM spack")

QUERIES["serve_pack_keyed"] = with_views(_MATCH + _SCHED + _FREE + """,
attr AS (SELECT k.cla_id, k.city_id, k.cla_subject_ids, k.cla_class_type, k.cla_subject_names, k.cla_term_id, k.cla_grade_id,
  k.cla_level_name, k.cla_classtime_names, k.cla_classdate_name, s.fin_score
  FROM fx_class k JOIN fx_score s ON s.cla_id = k.cla_id AND s.city_id = k.city_id)
SELECT f.sid, """ + _section_sql("a") + """ AS section, a.cla_id, CAST(""" + _info_sql("a") + """ AS VARCHAR) AS entry
FROM free f JOIN attr a ON a.cla_id = f.cla_id AND a.city_id = f.city_id""")

QUERIES["fallback_pack"] = with_views(_GROUPS + "\nSELECT key, section, cla_id, entry FROM gpack")

QUERIES["kv_export"] = with_views(_MATCH + _SCHED + _FREE + "," + _GROUPS + """
SELECT * FROM gkv UNION ALL """ + _kv_sql("recommend_studentid_", "sid", "spack"))

_SCAN = """
SELECT * FROM {kv} WHERE key IN (SELECT DISTINCT key FROM {kv} WHERE starts_with(key, '{prefix}') ORDER BY key LIMIT 10)"""

QUERIES["kv_scan_prefix"] = with_views(_MATCH + _SCHED + _FREE + ",\nskv AS (" + _kv_sql("recommend_studentid_", "sid", "spack") + ")"
                                       + _SCAN.format(kv="skv", prefix="recommend_studentid_"))

QUERIES["kv_scan_group_prefix"] = with_views(_GROUPS + _SCAN.format(kv="gkv", prefix="recommend_1_"))

QUERIES["kv_get"] = with_views(_GROUPS + """
SELECT key, '[' || string_agg(value, ',' ORDER BY cla_id) || ']' AS value, count(*) AS n_entries, max(ttl_s) AS ttl_s,
  max(expires_at) AS expires_at FROM gkv WHERE key = 'recommend_0_BUILDING_数学' GROUP BY key""")

QUERIES["kv_values"] = with_views(_MATCH + _SCHED + _FREE + """
SELECT sid, '{"online_recom":[' || coalesce(string_agg(entry, ',' ORDER BY cla_id) FILTER (WHERE section = 'online_recom'), '')
  || '],"offine_recom":[' || coalesce(string_agg(entry, ',' ORDER BY cla_id) FILTER (WHERE section = 'offine_recom'), '')
  || ']}' AS value FROM spack GROUP BY sid""")

QUERIES["kv_store"] = with_views(_MATCH + _SCHED + _FREE + "," + _GROUPS + """
SELECT 'recommend_studentid_' || sid AS key,
  '{"online_recom":[' || coalesce(string_agg(entry, ',' ORDER BY cla_id) FILTER (WHERE section = 'online_recom'), '')
  || '],"offine_recom":[' || coalesce(string_agg(entry, ',' ORDER BY cla_id) FILTER (WHERE section = 'offine_recom'), '')
  || ']}' AS value, CAST(2592000 AS BIGINT) AS ttl_s FROM spack GROUP BY sid
UNION ALL SELECT key, '[' || string_agg(value, ',' ORDER BY cla_id) || ']', CAST(2592000 AS BIGINT) FROM gkv GROUP BY key""")

QUERIES["register_rejects"] = with_views("""
reg AS (SELECT r.sid, r.cla_id, st.city_id FROM fx_registered r JOIN fx_class c ON c.cla_id = r.cla_id
        JOIN fx_student st ON st.stu_id = r.sid)
SELECT reg.city_id, count(*) AS n_sessions, count(*) FILTER (WHERE s.no_start) AS n_rejected
FROM reg JOIN fx_packed s ON s.cla_id = reg.cla_id GROUP BY reg.city_id""")

# ---- per-row functions, filters and reshapes -------------------------------------------------

QUERIES["fn_level"] = with_views(f"x AS (SELECT 1)\nSELECT cla_id, cla_level_name, {level_sql('cla_level_name')} AS level FROM fx_class")
QUERIES["fn_subject"] = with_views(f"x AS (SELECT 1)\nSELECT cla_id, cla_subject_names, {subject_sql('cla_subject_names')} AS subject FROM fx_class")
QUERIES["fn_subject_rule"] = with_views(
    f"x AS (SELECT 1)\nSELECT cla_id, cla_term_id, {subject_rule_sql('cla_subject_names')} AS subject, "
    f"{subject_rule_sql('cla_subject_names')} || '_' || cla_term_id AS token FROM fx_class")
QUERIES["fn_class_type"] = with_views(f"x AS (SELECT 1)\nSELECT cla_id, cla_class_type, {type_sql('cla_class_type')} AS type_tag FROM fx_class")
QUERIES["fn_status_weight"] = with_views(
    f"x AS (SELECT 1)\nSELECT orderstatus, count(*) AS n_orders, {status_weight_sql('orderstatus')} AS weight FROM fx_order GROUP BY orderstatus")
QUERIES["fn_price"] = with_views(
    f"x AS (SELECT 1)\nSELECT sid, dt, orderstatus, round(classprice, 6) AS classprice, round({price_sql('orderstatus', 'classprice')}, 6) AS price_weight FROM fx_order")
QUERIES["fn_millis_date"] = "SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events"
QUERIES["fn_overlap"] = with_views("""x AS (SELECT 1)
SELECT cuc_class_id AS cla_id, CAST(cuc_class_date AS VARCHAR) AS d, cuc_start_time AS st, cuc_end_time AS et,
  ('10:00' <= cuc_end_time AND cuc_start_time <= '11:00') AS overlaps
FROM fx_curriculum WHERE cuc_class_date > DATE '2001-01-01'""")
QUERIES["fn_day_range"] = with_views("""
days AS (SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS day FROM generate_series(DATE '2024-01-10', DATE '2024-01-20', INTERVAL 1 DAY) g(d)),
per_day AS (SELECT day, count(*) AS n FROM fx_behavior GROUP BY day)
SELECT days.day, coalesce(per_day.n, 0) AS n_rows FROM days LEFT JOIN per_day ON per_day.day = days.day""")
QUERIES["valid_ids"] = with_views(
    f"x AS (SELECT 1)\nSELECT sid, cla_id, day FROM fx_behavior WHERE {valid_sql('sid')} AND {valid_sql('cla_id')} AND {valid_sql('cla_level_name')}")
QUERIES["date_range"] = with_views(
    "x AS (SELECT 1)\nSELECT sid, dt, orderstatus FROM fx_order WHERE dt >= '1996-01-01' AND dt <= '1996-12-31'")
QUERIES["tagged_union"] = with_views(_MATCH + _SCHED + """
SELECT sid, cla_id, cla_term_id, cla_subject_names, year, '-1' AS reg_ispay FROM ra
UNION ALL SELECT sid, cla_id, cla_term_id, cla_subject_names, year, '1' FROM reg""")
QUERIES["array_dedupe"] = with_views("""
x AS (SELECT sid, city_id, unnest(string_split(depart_4, ',')) AS loc FROM fx_location
      UNION SELECT sid, city_id, 'live-class-service-center' FROM fx_location)
SELECT sid, city_id, string_agg(loc, ',' ORDER BY loc) AS locs FROM x GROUP BY sid, city_id""")
QUERIES["unnest"] = QUERIES["rule_match"]
QUERIES["limit_sample"] = with_views("""x AS (SELECT 1)
SELECT sid, dt, orderstatus, subjectname, classlevelname, round(classprice, 6) AS classprice FROM fx_order
ORDER BY sid, dt, orderstatus, subjectname, classlevelname, classprice LIMIT 1000""")
QUERIES["json_property_top3"] = """
WITH cnt AS (SELECT CAST(user_id AS VARCHAR) AS sid, json_extract_string(props, '$.k') AS feature_name, CAST(count(*) AS DOUBLE) AS value
  FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL GROUP BY 1, 2),
rk AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY value DESC, feature_name ASC) AS rn FROM cnt)
SELECT sid, '班型偏好' AS feature_name,
  CAST(json_object('1', coalesce(max(CASE WHEN rn = 1 THEN feature_name END), ''),
                   '2', coalesce(max(CASE WHEN rn = 2 THEN feature_name END), ''),
                   '3', coalesce(max(CASE WHEN rn = 3 THEN feature_name END), '')) AS VARCHAR) AS value,
  '2024-01-20' AS dt
FROM rk WHERE rn <= 3 GROUP BY sid"""
QUERIES["row_json_export"] = with_views("""x AS (SELECT 1)
SELECT cla_id AS key, CAST(json_object('cla_id', cla_id, 'city_id', city_id, 'cla_grade_id', cla_grade_id, 'cla_term_id', cla_term_id,
  'cla_subject_names', cla_subject_names, 'cla_level_name', cla_level_name, 'cla_class_type', cla_class_type, 'cla_year', cla_year,
  'cla_subject_ids', cla_subject_ids, 'cla_classtime_names', cla_classtime_names, 'cla_classdate_name', cla_classdate_name) AS VARCHAR) AS value,
  CAST(600 AS BIGINT) AS ttl_s FROM fx_class""")

# ---- literal Q3, JSON parse, locations, unpivots ------------------------------------------

QUERIES["favor_classtime_literal"] = with_views(f"""
cnt AS (SELECT sid, cla_classtime_ids AS feature_name,
        sum(CASE WHEN cla_class_type = '3' THEN 11.0 ELSE 1.0 END) AS value FROM fx_behavior
  WHERE ({valid_sql('sid')} AND day BETWEEN '2024-01-10' AND '2024-01-20' AND {valid_sql('cla_classtime_ids')}
         AND cla_class_type = '1') OR cla_class_type = '3'
  GROUP BY 1, 2),
rk AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY value DESC, feature_name ASC) AS rn FROM cnt)
SELECT sid, 'class_time_favor' AS feature_name,
  CAST(json_object('1', coalesce(max(CASE WHEN rn = 1 THEN feature_name END), ''),
                   '2', coalesce(max(CASE WHEN rn = 2 THEN feature_name END), ''),
                   '3', coalesce(max(CASE WHEN rn = 3 THEN feature_name END), '')) AS VARCHAR) AS value,
  '2024-01-20' AS dt
FROM rk WHERE rn <= 3 GROUP BY sid""")

QUERIES["recall_parse"] = with_views("x AS (SELECT 1)\nSELECT city_id, grade_id, left_token, loc, cla_id FROM fx_rule_long")

QUERIES["student_locations"] = with_views("""
x AS (SELECT sid, city_id, unnest(string_split(depart_4, ',')) AS loc FROM fx_location
      UNION SELECT sid, city_id, 'live-class-service-center' FROM fx_location)
SELECT sid, city_id, loc FROM x""")

QUERIES["event_unpivot"] = with_views(f"ev AS ({_EV})\nSELECT sid, feature_name, value FROM ({_EV_TRIPLES}) t")

QUERIES["order_unpivot"] = with_views(
    f"od AS ({_OD})\nSELECT sid, feature_name, round(value, 6) AS value FROM ({_OD_TRIPLES}) t")

QUERIES["positional_rename"] = with_views("x AS (SELECT 1)\nSELECT sid AS student, city_id AS city, depart_4 AS centers FROM fx_location")

QUERIES["nonblank_lists"] = with_views(_TOKENS + "\nSELECT sid, t1 AS first_token FROM tokens WHERE t1 <> ''")

QUERIES["table_counts"] = with_views("""x AS (SELECT 1)
SELECT 'behavior' AS name, count(*) AS n_rows FROM fx_behavior UNION ALL SELECT 'order', count(*) FROM fx_order
UNION ALL SELECT 'regist', count(*) FROM fx_regist UNION ALL SELECT 'klass', count(*) FROM fx_class
UNION ALL SELECT 'curriculum', count(*) FROM fx_curriculum""")

QUERIES["fn_today"] = with_views("""x AS (SELECT 1)
SELECT cuc_class_date > DATE '2001-01-01' AS future, count(*) AS n_sessions FROM fx_curriculum GROUP BY 1""")

# ---- stored tables and states -----------------------------------------------------------------

_DAYS = ("2024-01-10", "2024-01-20")
QUERIES["append_slices"] = with_views(
    "ev AS (SELECT * FROM fx_behavior WHERE " + valid_sql("cla_id") + " AND " + valid_sql("sid") + f" AND day IN {_DAYS}),\n"
    + "tr AS (" + " UNION ALL ".join(f"SELECT sid, {f} AS feature_name, day FROM ev" for f in (
        subject_sql("cla_subject_names") + " || " + level_sql("cla_level_name"), subject_sql("cla_subject_names"),
        subject_sql("cla_subject_names") + " || " + type_sql("cla_class_type"))) + ")\n"
    + "SELECT sid, feature_name, CAST(count(*) AS DOUBLE) AS value, day AS dt FROM tr GROUP BY ALL")
QUERIES["overwrite_table"] = with_views(_TOKENS + """
SELECT sid, city_id, grade_id, t1 || ',' || t2 || ',' || t3 AS left_rule, '2001-01-01' AS dt FROM tokens WHERE t2 <> ''""")
QUERIES["create_if_absent"] = QUERIES["student_tokens"]
QUERIES["student_tokens_merged"] = QUERIES["student_tokens"]
QUERIES["event_features_by_day"] = QUERIES["event_features"]
QUERIES["favor_teacher_by_day"] = QUERIES["favor_teacher"]
QUERIES["text_export"] = with_views(f"""
od AS (SELECT * FROM fx_order WHERE dt BETWEEN '1995-01-01' AND '2001-08-01')
SELECT distinctid, {subject_sql('subjectname')} || {level_sql('classlevelname')} AS feature_name,
       CAST({status_weight_sql('orderstatus')} AS DOUBLE) AS value, startdate AS dt FROM od
UNION ALL SELECT distinctid, 'price', round(coalesce(classprice, 0.0), 6), startdate FROM od""")
QUERIES["reject_counts"] = with_views("""
rule AS (SELECT DISTINCT city_id, grade_id, left_token, CAST(string_split(left_token, '_')[2] AS INT) AS term FROM fx_rule_long),
reg AS (SELECT r.sid, r.cla_id FROM fx_registered r JOIN fx_class c ON c.cla_id = r.cla_id JOIN fx_student st ON st.stu_id = r.sid)
SELECT 'rule' AS source, 'bad_json' AS reason, count(*) AS n_rows, count(*) FILTER (WHERE term = 3) AS n_rejected FROM rule
UNION ALL SELECT 'rule', 'null_left', count(*), count(*) FILTER (WHERE term = 4) FROM rule
UNION ALL SELECT 'location', 'null_depart_4', count(*), count(*) FILTER (WHERE CAST(sid AS BIGINT) % 11 = 0) FROM fx_location
UNION ALL SELECT 'register', 'missing_time', count(*),
  count(*) FILTER (WHERE cla_id IN (SELECT cla_id FROM fx_packed WHERE no_start)) FROM reg""")
