"""Registered queries that write tables to the shared folder and read them back.

Sinks (SNK1-SNK4), the stored key-ordered export and its readers (SNK5, SRC16),
and states that are built in steps (AG4, WN2).  Unlike those of ``queries``,
building one of these runs jobs.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenrec.operators.rejects import Rejects
from lumenrec.plans import day_state, token_state
from lumenrec.plans import features as pf
from lumenrec.plans import recommend as prec
from lumenrec.plans import rules as pr
from lumenrec.plans import serve as psv
from lumenrec.queries import kv_group, kv_student, tokens
from lumenrec.session import apply_core_conf
from lumenrec.sinks import (
    create_if_absent, new_folder, overwrite_table, read_slice, replace_slice, store_values, text_export,
)
from lumenrec.sources import fixtures as fx
from lumenrec.sources.fixtures import bind_fixtures
from lumenrec.sources.tables import Tables

STORED: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def stored(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_core_conf(spark)
        return fn(spark, bind_fixtures(spark, sf_dir))
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    STORED[fn.__name__.removeprefix("q_")] = run
    return fn


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("value", F.round("value", 6))


# ---- SNK1-SNK4 ----------------------------------------------------------------------------

@stored
def q_append_slices(spark, t):
    """SNK1: two days' slices, one of them written twice, read back as one table."""
    path = new_folder(spark, "append-slices")
    for day in (fx.EVENT_BEGIN, fx.EVENT_END, fx.EVENT_BEGIN):
        rows = pf.event_features(t, day, day, day)
        replace_slice(rows, path, dt=day)
    return _rounded(read_slice(spark, rows.schema, path))


@stored
def q_overwrite_table(spark, t):
    """SNK2: the token table replaced as a whole; the second table is made from the first."""
    path = new_folder(spark, "overwrite-table")
    overwrite_table(tokens(t), path)
    first = spark.read.parquet(path)
    overwrite_table(first.filter(F.get("left_rule", F.lit(1)) != ""), path)
    return spark.read.parquet(path).withColumn("left_rule", F.array_join("left_rule", ","))


@stored
def q_create_if_absent(spark, t):
    """SNK3: a catalog table with an array column over a written folder, created once, read by its name."""
    path, name = new_folder(spark, "created-table"), f"lumenrec_tokens_{uuid.uuid4().hex}"
    rows = tokens(t)
    replace_slice(rows, path, dt=fx.AS_OF)
    for _ in range(2):
        create_if_absent(spark, name, rows, path, ("dt", "city_id"))
    return spark.table(name).withColumn("left_rule", F.array_join("left_rule", ","))


@stored
def q_text_export(spark, t):
    """SNK4: the delimited text export, read back as text columns."""
    path = new_folder(spark, "text-export")
    text_export(pf.order_recall_rows(t, fx.ORDER_BEGIN, fx.ORDER_END).withColumn("value", F.round(F.col("value").cast("double"), 6).cast("string")), path)
    return spark.read.schema("distinctid string, feature_name string, value string, dt string").csv(path) \
        .withColumn("value", F.col("value").cast("double"))


# ---- SNK5, SRC16 ----------------------------------------------------------------------------

@stored
def q_kv_store(spark, t):
    """SNK5: what the store holds, one JSON value per student key and per group key."""
    path = new_folder(spark, "export")
    store = psv.store_export(kv_student(t).unionByName(kv_group(t)), path)
    return store_values(store, "g").select(F.col("store_key").alias("key"), "value", "ttl_s")


@stored
def q_kv_get(spark, t):
    """SRC16: one key of the stored export."""
    return psv.kv_get(psv.store_export(kv_group(t), new_folder(spark, "export")), "recommend_0_BUILDING_数学")


@stored
def q_kv_scan_prefix(spark, t):
    """SRC16: the first ten student keys of the stored export with their entries."""
    return psv.kv_scan_prefix(psv.store_export(kv_student(t), new_folder(spark, "export")), psv.STUDENT_KEY_PREFIX)


@stored
def q_kv_scan_group_prefix(spark, t):
    """SRC16: the first ten group keys of a city in the stored export with their entries."""
    return psv.kv_scan_prefix(psv.store_export(kv_group(t), new_folder(spark, "export")), psv.GROUP_KEY_PREFIX + "1_")


# ---- AG4, WN2: states built in steps -----------------------------------------------------------

@stored
def q_event_features_by_day(spark, t):
    """AG4: a range from day partials, of which an earlier range has stored the first half."""
    path, source = new_folder(spark, "event-days"), day_state.event_days(t)
    day_state.fill_days(spark, path, source, day_state.days(fx.EVENT_BEGIN, "2024-01-15"))
    return _rounded(day_state.range_sums(spark, path, source, fx.EVENT_BEGIN, fx.EVENT_END, fx.EVENT_END))


@stored
def q_favor_teacher_by_day(spark, t):
    """PL4 from day partials."""
    return day_state.favor_list(spark, new_folder(spark, "favor-days"), t, "teacher_favor", fx.EVENT_BEGIN, fx.EVENT_END, fx.EVENT_END)


@stored
def q_student_tokens_merged(spark, t):
    """PL5 from a state: the registrations up to a day, those after it merged in, those that were
    deleted taken out."""
    late = F.col("reg_pay_date") > F.lit("1999-06-30").cast("date")
    deleted = F.col("reg_isdeleted") == 1
    early = Tables(spark, {**t.loaders, "regist": lambda: t.regist.filter(~late).withColumn("reg_isdeleted", F.lit(0).cast("int"))})
    path = new_folder(spark, "token-state")
    overwrite_table(token_state.token_state(early, fx.PAY_AFTER), path)
    state = token_state.advance(t, spark.read.parquet(path), t.regist.filter(late), t.regist.filter(deleted), fx.PAY_AFTER)
    overwrite_table(state, path)
    return token_state.state_lists(t, spark.read.schema(token_state.STATE).parquet(path), fx.AS_OF) \
        .withColumn("left_rule", F.array_join("left_rule", ","))


# ---- Q9, Q11, Q20 ----------------------------------------------------------------------------------

@stored
def q_reject_counts(spark, t):
    """Counts of what a run leaves out, taken while its tables are written: rules with cut-off JSON or
    a null ``left``, null location lists, registrations with a session that lacks a time."""
    rules = fx.spoiled_rules(t.rule)
    location = fx.spoiled_locations(t.location)
    rejects = Rejects()
    path = new_folder(spark, "rejects")
    overwrite_table(pr.rule_match(tokens(t), rules, location, rejects=rejects), f"{path}/recommended")
    recs = spark.read.parquet(f"{path}/recommended")
    overwrite_table(prec.conflict_free(t, recs, fx.AS_OF, rejects=rejects), f"{path}/recommended_free")
    return rejects.table(spark)
