"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each runs one plan of this package over the whole driver tables bound by
``lumenrec.sources.fixtures`` with the fixture parameters.  Float sums are
rounded to 6 decimals so the DuckDB oracle can compare values exactly.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenrec.plans import features as pf
from lumenrec.plans import rules as pr
from lumenrec.plans import recommend as prec
from lumenrec.plans import serve as psv
from lumenrec.operators import packs as pk
from lumenrec.operators import schedule as sched
from lumenrec.sources import fixtures as fx
from lumenrec.session import apply_core_conf
from lumenrec.sources.fixtures import bind_fixtures

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    """Register a query; it pins the session settings it relies on (UTC, ANSI,
    AQE) because the caller's session may have been built elsewhere."""
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_core_conf(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return fn
    return deco


def _round(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.round(c, digits))
    return df


def _text(c: str):
    """A date in its output form, yyyy-MM-dd."""
    return F.col(c).cast("string").alias(c)


@register("event_features")
def q_event_features(spark, sf_dir):
    t = bind_fixtures(spark, sf_dir)
    return _round(pf.event_features(t, fx.EVENT_BEGIN, fx.EVENT_END, fx.EVENT_END), "value")


@register("order_features")
def q_order_features(spark, sf_dir):
    t = bind_fixtures(spark, sf_dir)
    return _round(pf.order_features(t, fx.ORDER_BEGIN, fx.ORDER_END, fx.ORDER_END, fx.CREATED_AFTER), "value")


@register("merge_features")
def q_merge_features(spark, sf_dir):
    t = bind_fixtures(spark, sf_dir)
    return _round(pf.merged_features(t, (fx.EVENT_BEGIN, fx.EVENT_END), (fx.ORDER_BEGIN, fx.ORDER_END),
                                     fx.ORDER_END, fx.CREATED_AFTER), "value")


def _favor(name: str):
    def q(spark, sf_dir):
        t = bind_fixtures(spark, sf_dir)
        return pf.favor_list(t, name, fx.EVENT_BEGIN, fx.EVENT_END, fx.EVENT_END)
    return q


register("favor_teacher")(_favor("teacher_favor"))
register("favor_location")(_favor("class_location_favor"))
register("favor_classtime")(_favor("class_time_favor"))


@register("order_recall")
def q_order_recall(spark, sf_dir):
    t = bind_fixtures(spark, sf_dir)
    return _round(pf.order_recall(t, fx.ORDER_BEGIN, fx.ORDER_END), "value")


def tokens(t):
    return pr.student_tokens(t, fx.PAY_AFTER, fx.AS_OF)


@register("student_tokens")
def q_student_tokens(spark, sf_dir):
    t = bind_fixtures(spark, sf_dir)
    return tokens(t).withColumn("left_rule", F.array_join("left_rule", ","))


def _rule_match(t):
    return pr.rule_match(tokens(t), t.rule, t.location)


@register("rule_match")
def q_rule_match(spark, sf_dir):
    return _rule_match(bind_fixtures(spark, sf_dir))


def _conflict_free(t):
    return prec.conflict_free(t, _rule_match(t), fx.AS_OF)


@register("conflict_free")
def q_conflict_free(spark, sf_dir):
    return _conflict_free(bind_fixtures(spark, sf_dir))


def _rec_attrs(t):
    recs = _rule_match(t)
    sessions = sched.future_sessions(t.curriculum, fx.AS_OF)
    attrs = recs.join(prec.current_classes(t), ["cla_id", "city_id"])
    return attrs.join(sessions.select("cla_id", "city_id"), ["cla_id", "city_id"], "left_semi")


@register("same_subject_exclusion")
def q_same_subject_exclusion(spark, sf_dir):
    t = bind_fixtures(spark, sf_dir)
    kept = sched.same_subject_exclusion(_rec_attrs(t), prec.live_registrations(t))
    return kept.select("sid", "city_id", "cla_id", "cla_term_id", "cla_subject_names", "year")


@register("time_conflict")
def q_time_conflict(spark, sf_dir):
    t = bind_fixtures(spark, sf_dir)
    regs = prec.live_registrations(t)
    kept = sched.same_subject_exclusion(_rec_attrs(t), regs).select("sid", "city_id", "cla_id")
    sessions = sched.first_session_per_date(sched.future_sessions(t.curriculum, fx.AS_OF))
    flags = sched.conflict_flags(kept.join(sessions, ["cla_id", "city_id"]), sched.registered_sessions(regs))
    return flags.filter("conflict").select("sid", "city_id", "cla_id").distinct()


@register("curriculum_arrays")
def q_curriculum_arrays(spark, sf_dir):
    t = bind_fixtures(spark, sf_dir)
    out = prec.curriculum_table(t, fx.AS_OF)
    for c in ("date_arr", "starttime_arr", "endtime_arr"):
        out = out.withColumn(c, F.array_join(c, ","))
    return out


@register("packed_split")
def q_packed_split(spark, sf_dir):
    t = bind_fixtures(spark, sf_dir)
    s = sched.registered_sessions(prec.live_registrations(t))
    return s.filter("ok").select("sid", "city_id", "cla_id", "d", "st", "et")


@register("register_rejects")
def q_register_rejects(spark, sf_dir):
    return sched.rejected_sessions(prec.live_registrations(bind_fixtures(spark, sf_dir)))


@register("serve_pack")
def q_serve_pack(spark, sf_dir):
    t = bind_fixtures(spark, sf_dir)
    return psv.student_pack(t, _conflict_free(t)).drop("city_id")


@register("serve_pack_keyed")
def q_serve_pack_keyed(spark, sf_dir):
    t = bind_fixtures(spark, sf_dir)
    return psv.student_pack_keyed(t, _conflict_free(t)).drop("city_id")


@register("fallback_pack")
def q_fallback_pack(spark, sf_dir):
    return psv.fallback_pack(bind_fixtures(spark, sf_dir)).drop("city_id")


def kv_student(t):
    return psv.kv_records(psv.student_pack(t, _conflict_free(t)), psv.STUDENT_KEY_PREFIX, "sid", fx.AS_OF)


def kv_group(t):
    return psv.kv_records(psv.fallback_pack(t), psv.GROUP_KEY_PREFIX, "key", fx.AS_OF)


@register("kv_export")
def q_kv_export(spark, sf_dir):
    t = bind_fixtures(spark, sf_dir)
    return kv_student(t).unionByName(kv_group(t))


@register("kv_values")
def q_kv_values(spark, sf_dir):
    """The JSON value of every student key, as a reader renders it (AG8)."""
    t = bind_fixtures(spark, sf_dir)
    return pk.render(psv.student_pack(t, _conflict_free(t)), "sid")


# ---- per-row functions, filters and reshapes over whole driver-derived tables -------------
from lumenrec import functions as fn  # noqa: E402
from lumenrec.operators import reshape as rs  # noqa: E402
from lumenrec.plans import rules as _rules  # noqa: E402


@register("fn_level")
def q_fn_level(spark, sf_dir):
    k = bind_fixtures(spark, sf_dir).klass
    return k.select("cla_id", "cla_level_name", fn.level_tag("cla_level_name").alias("level"))


@register("fn_subject")
def q_fn_subject(spark, sf_dir):
    k = bind_fixtures(spark, sf_dir).klass
    return k.select("cla_id", "cla_subject_names", fn.subject_code("cla_subject_names").alias("subject"))


@register("fn_subject_rule")
def q_fn_subject_rule(spark, sf_dir):
    k = bind_fixtures(spark, sf_dir).klass
    return k.select("cla_id", "cla_term_id", fn.subject_rule_name("cla_subject_names").alias("subject"),
                    fn.token("cla_subject_names", "cla_term_id").alias("token"))


@register("fn_class_type")
def q_fn_class_type(spark, sf_dir):
    k = bind_fixtures(spark, sf_dir).klass
    return k.select("cla_id", "cla_class_type", fn.class_type_tag("cla_class_type").alias("type_tag"))


@register("fn_status_weight")
def q_fn_status_weight(spark, sf_dir):
    o = bind_fixtures(spark, sf_dir).order
    return o.groupBy("orderstatus").agg(F.count(F.lit(1)).alias("n_orders")) \
        .select("orderstatus", "n_orders", fn.status_weight("orderstatus").alias("weight"))


@register("fn_price")
def q_fn_price(spark, sf_dir):
    o = bind_fixtures(spark, sf_dir).order
    return o.select("sid", _text("dt"), "orderstatus", F.round("classprice", 6).alias("classprice"),
                    F.round(fn.price_weight("orderstatus", "classprice"), 6).alias("price_weight"))


@register("fn_millis_date")
def q_fn_millis_date(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    return e.select("event_id", fn.millis_to_date(ms).alias("day"))


@register("fn_overlap")
def q_fn_overlap(spark, sf_dir):
    s = sched.future_sessions(bind_fixtures(spark, sf_dir).curriculum, fx.AS_OF)
    return s.select("cla_id", "d", "st", "et",
                    fn.intervals_overlap("st", "et", F.lit("10:00"), F.lit("11:00")).alias("overlaps"))


@register("fn_day_range")
def q_fn_day_range(spark, sf_dir):
    t = bind_fixtures(spark, sf_dir)
    days = spark.range(1).select(F.explode(fn.day_range(fx.EVENT_BEGIN, fx.EVENT_END)).alias("day"))
    per_day = t.behavior.groupBy("day").agg(F.count(F.lit(1)).alias("n_rows"))
    return days.join(per_day, "day", "left").select(_text("day"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


@register("valid_ids")
def q_valid_ids(spark, sf_dir):
    b = bind_fixtures(spark, sf_dir).behavior
    return b.filter(fn.is_valid("sid") & fn.is_valid("cla_id") & fn.is_valid("cla_level_name")) \
        .select("sid", "cla_id", _text("day"))


@register("date_range")
def q_date_range(spark, sf_dir):
    o = bind_fixtures(spark, sf_dir).order
    return o.filter(fn.date_between("dt", "1996-01-01", "1996-12-31")).select("sid", _text("dt"), "orderstatus")


@register("tagged_union")
def q_tagged_union(spark, sf_dir):
    t = bind_fixtures(spark, sf_dir)
    return sched.tagged_union(_rec_attrs(t), prec.live_registrations(t))


@register("array_dedupe")
def q_array_dedupe(spark, sf_dir):
    loc = bind_fixtures(spark, sf_dir).location
    parts = F.array_append(fn.java_split("depart_4", ","), F.lit(_rules.LIVE_KEY))
    return loc.select("sid", "city_id", F.array_join(F.array_sort(rs.dedupe_list(parts)), ",").alias("locs"))


@register("unnest")
def q_unnest(spark, sf_dir):
    lists = pr.as_lists(_rule_match(bind_fixtures(spark, sf_dir)))
    return rs.unnest(lists, "rec_class_list", "cla_id")


@register("limit_sample")
def q_limit_sample(spark, sf_dir):
    o = bind_fixtures(spark, sf_dir).order
    return rs.sample_rows(o.select("sid", _text("dt"), "orderstatus", "subjectname", "classlevelname",
                                   F.round("classprice", 6).alias("classprice")), 1000)


@register("json_property_top3")
def q_json_property_top3(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet") \
        .select(F.col("user_id").cast("string").alias("sid"), "props")
    return rs.json_property_top3(e, "props", "$.k", "班型偏好", fx.EVENT_END)


@register("row_json_export")
def q_row_json_export(spark, sf_dir):
    return rs.row_json(bind_fixtures(spark, sf_dir).klass, "cla_id", 600)


@register("favor_classtime_literal")
def q_favor_classtime_literal(spark, sf_dir):
    t = bind_fixtures(spark, sf_dir)
    return pf.favor_list(t, "class_time_favor", fx.EVENT_BEGIN, fx.EVENT_END, fx.EVENT_END, literal_quirk=True)


@register("recall_parse")
def q_recall_parse(spark, sf_dir):
    t = bind_fixtures(spark, sf_dir)
    return pr.recall_entries(pr.rules_with_id(t.rule)) \
        .select("city_id", "grade_id", F.explode("left").alias("left_token"), "loc", "cla_id")


@register("student_locations")
def q_student_locations(spark, sf_dir):
    return pr.student_locations(bind_fixtures(spark, sf_dir).location)


@register("event_unpivot")
def q_event_unpivot(spark, sf_dir):
    from lumenrec.operators import features as ft
    t = bind_fixtures(spark, sf_dir)
    return ft.event_triples(ft.valid_events(t.behavior, fx.EVENT_BEGIN, fx.EVENT_END))


@register("order_unpivot")
def q_order_unpivot(spark, sf_dir):
    from lumenrec.operators import features as ft
    t = bind_fixtures(spark, sf_dir)
    tr = ft.order_triples(ft.valid_orders(t.order, fx.ORDER_BEGIN, fx.ORDER_END, fx.CREATED_AFTER))
    return _round(tr, "value")


@register("positional_rename")
def q_positional_rename(spark, sf_dir):
    """PF2: every column renamed by its place."""
    return bind_fixtures(spark, sf_dir).location.toDF("student", "city", "centers")


@register("nonblank_lists")
def q_nonblank_lists(spark, sf_dir):
    """PF12: token lists whose first element is not blank."""
    t = tokens(bind_fixtures(spark, sf_dir))
    return t.filter(fn.first_not_blank("left_rule")).select("sid", F.get("left_rule", F.lit(0)).alias("first_token"))


@register("table_counts")
def q_table_counts(spark, sf_dir):
    """AG12: the number of rows of each logical table."""
    t = bind_fixtures(spark, sf_dir)
    out = None
    for name in ("behavior", "order", "regist", "klass", "curriculum"):
        n = t.get(name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("name"), "n_rows")
        out = n if out is None else out.unionByName(n)
    return out


@register("fn_today")
def q_fn_today(spark, sf_dir):
    """SC9: sessions against a pinned today."""
    c = bind_fixtures(spark, sf_dir).curriculum
    return c.groupBy((F.col("cuc_class_date") > fn.today(fx.AS_OF)).alias("future")).agg(F.count(F.lit(1)).alias("n_sessions"))
