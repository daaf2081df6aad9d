"""End-to-end batch jobs: the original ``main`` programs as Spark jobs.

Each job writes its outputs under ``out_root`` (a shared folder on a cluster)
and later stages read the written tables back: the write is the lineage cut,
so a lost executor costs one stage, never the whole chain, and nothing is
computed twice.  Reruns replace their own slice, ``dt`` or ``dt`` and city (SNK1).

    python -m lumenrec.jobs flagship --sf-dir /root/testdata/sf0.01 --out /shared/out --master local[*]
    spark-submit --py-files lumenrec.zip lumenrec/jobs.py flagship \
        --catalog '{"behavior": "db.behavior", ...}' --out /shared/out --city 0

Dates default to the fixture parameters; pass ``--as-of``, ``--pay-after``,
``--event-range``, ``--order-range`` and ``--created-after`` for other data.
"""

from __future__ import annotations

import argparse
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenrec.operators import features as ft
from lumenrec.operators import schedule as sched
from lumenrec.operators.rejects import Rejects
from lumenrec.plans import day_state, token_state
from lumenrec.plans import features as pf
from lumenrec.plans import recommend as prec
from lumenrec.plans import rules as pr
from lumenrec.plans import serve as psv
from lumenrec.sinks import (
    create_if_absent, exists, overwrite_table, push_export, read_slice, recover, replace_slice, served_keys, text_export,
)
from lumenrec.sinks.kv import SERVED
from lumenrec.sources.tables import Tables, from_catalog


class Output:
    """The tables of a run: folders below ``root``, and catalog tables over them if ``database``
    is given (created once, partitions registered)."""

    def __init__(self, spark: SparkSession, root: str, database: str | None = None):
        self.spark, self.root, self.database = spark, root.rstrip("/"), database
        self.paths: dict[str, str] = {}

    def _publish(self, df: DataFrame, name: str, partitions: tuple[str, ...]) -> None:
        if self.database:
            create_if_absent(self.spark, f"{self.database}.{name}", df, self.paths[name], partitions)

    def replace(self, df: DataFrame, name: str, check=None, **slice_: str) -> DataFrame:
        """Replace the run's slice of a table and return it as written (the lineage cut).
        ``check`` runs between writing and replacing; if it fails, the old slice stays."""
        for k, v in slice_.items():
            df = df.withColumn(k, F.lit(v))
        path = self.paths[name] = f"{self.root}/{name}"
        replace_slice(df, path, check, **slice_)
        by = tuple(c for c in ("dt", "pay_after", "city_id") if c in df.columns and (c in slice_ or c == "city_id"))
        self._publish(df, name, by)
        return read_slice(self.spark, df.schema, path, **slice_)

    def overwrite(self, df: DataFrame, name: str) -> None:
        path = self.paths[name] = f"{self.root}/{name}"
        overwrite_table(df, path)
        self._publish(df, name, ())


def _slice(as_of: str, city: str | None) -> dict[str, str]:
    return {"dt": as_of} if city is None else {"dt": as_of, "city_id": city}


def feature_job(t: Tables, out_root: str, event_range: tuple[str, str], order_range: tuple[str, str],
                dt: str, created_after: str, database: str | None = None, state: str | None = None) -> dict[str, str]:
    """PL3: event weights, order weights, and their merge (three tables).

    With ``state`` (a folder kept from run to run, one for each ``created_after``) only days without
    a partial there are scanned.
    """
    out = Output(t.spark, out_root, database)
    if state is None:
        events, orders = pf.event_features(t, *event_range, dt), pf.order_features(t, *order_range, dt, created_after)
    else:
        events = day_state.range_sums(t.spark, f"{state}/event_days", day_state.event_days(t), *event_range, dt)
        orders = day_state.range_sums(t.spark, f"{state}/order_days", day_state.order_days(t, created_after), *order_range, dt)
    ev = out.replace(events, "event_features", dt=dt)
    od = out.replace(orders, "order_features", dt=dt)
    out.replace(ft.merge(ev, od, dt), "orderevent_features", dt=dt)
    return out.paths


def list_job(t: Tables, out_root: str, begin: str, end: str, dt: str, database: str | None = None,
             state: str | None = None) -> str:
    """PL4: the three preference lists into one table (one write per dt), from day partials with ``state``."""
    out = Output(t.spark, out_root, database)
    if state is None:
        lists = [pf.favor_list(t, name, begin, end, dt) for name in pf.FAVOR_LISTS]
    else:
        lists = [day_state.favor_list(t.spark, state, t, name, begin, end, dt) for name in pf.FAVOR_LISTS]
    out.replace(lists[0].unionByName(lists[1]).unionByName(lists[2]), "list_output", dt=dt)
    return out.paths["list_output"]


def token_state_job(t: Tables, state: str, pay_after: str, inserted: DataFrame | None = None,
                    deleted: DataFrame | None = None) -> str:
    """PL5's token state at the folder ``state``: built from all registrations if it is not there or
    no changes are given, else advanced by the day's ``inserted`` and ``deleted`` registrations."""
    recover(t.spark, state, whole=True)
    if inserted is None or deleted is None or not exists(t.spark, state):
        overwrite_table(token_state.token_state(t, pay_after), state)
    else:
        old = t.spark.read.schema(token_state.STATE).parquet(state)
        overwrite_table(token_state.advance(t, old, inserted, deleted, pay_after), state)
    return state


def _tokens(t: Tables, out: Output, as_of: str, pay_after: str, state: str | None = None) -> DataFrame:
    """PL5 with same-day reuse (Q10): a token table of this day and this pay date is read back.
    With ``state`` the lists come from the token state there instead of the registrations."""
    path = out.paths["rule_tokens"] = f"{out.root}/rule_tokens"
    cut = {"dt": as_of, "pay_after": pay_after}
    # the tokens of all cities are one slice, so the city is an ordinary column of it
    if state is None:
        lists = pr.student_tokens(t, pay_after, as_of)
    else:
        lists = token_state.state_lists(t, t.spark.read.schema(token_state.STATE).parquet(state), as_of)
    fresh = lists.withColumnRenamed("city_id", "student_city")
    if exists(t.spark, f"{path}/dt={as_of}/pay_after={pay_after}/_SUCCESS"):
        stored = fresh.withColumn("pay_after", F.lit(pay_after)).schema
        tokens = read_slice(t.spark, stored, path, **cut)
    else:
        tokens = out.replace(fresh, "rule_tokens", **cut)
    return tokens.withColumnRenamed("student_city", "city_id")


def _recommendations(t: Tables, out: Output, as_of: str, pay_after: str, city: str | None,
                     limits: dict[str, float] | None, state: str | None = None) -> DataFrame:
    """PL5 -> PL6 -> PL7 -> PL8, every table written once; returns the conflict-free set.

    Bad recall JSON fails the job as in the original, unless ``limits`` (reason: largest share of
    its rows) allows some of it; rejected rows are counted per reason into ``rejects``.
    """
    cut = _slice(as_of, city)
    rejects = Rejects({"bad_json": 0.0} | (limits or {}))
    tokens = _tokens(t, out, as_of, pay_after, state)
    # stored long (one row per student and class); the list shape of the original table is
    # ``rules.as_lists`` over this table
    recs = out.replace(pr.rule_match(tokens, t.rule, t.location, city, rejects=rejects), "recommended", rejects.check, **cut)
    out.replace(prec.curriculum_table(t, as_of, city), "class_schedule", **cut)
    free = out.replace(prec.conflict_free(t, recs, as_of, city, rejects=rejects), "recommended_free", rejects.check, **cut)
    out.replace(sched.rejected_sessions(prec.live_registrations(t, city)), "register_rejects", **cut)
    out.replace(rejects.table(t.spark), "rejects", **cut)
    return free


def _export(out: Output, kv: DataFrame, name: str, as_of: str, city: str | None, client_factory, keyed: bool = False) -> None:
    """Write the run's key-value records and make the store hold them.

    What earlier runs of this export and city left in the store is in ``<name>_served``, so keys
    and pages that are gone are deleted; the table is replaced when the push is done.
    """
    spark = out.spark
    written = out.replace(kv, name, **_slice(as_of, city))
    if client_factory is None:
        return
    path = out.paths[f"{name}_served"] = f"{out.root}/{name}_served"
    recover(spark, path, whole=True)
    served = spark.read.schema(SERVED).parquet(path) if exists(spark, path) else spark.createDataFrame([], SERVED)
    mine = served if city is None else served.filter(F.col("city_id") == city)
    generation = uuid.uuid4().hex
    push_export(written, client_factory, generation, mine, keyed)
    now = served_keys(written, generation)
    if city is not None:
        now = now.unionByName(served.filter(~F.col("city_id").eqNullSafe(F.lit(city))))
    overwrite_table(now, path)


def flagship_job(t: Tables, out_root: str, as_of: str, pay_after: str, city: str | None = None,
                 client_factory=None, database: str | None = None, limits: dict[str, float] | None = None,
                 state: str | None = None) -> dict[str, str]:
    """PL5 -> PL6 -> PL7 -> PL8 -> PL9 with every intermediate table written once; tokens from the
    token state at ``state`` if one is given."""
    out = Output(t.spark, out_root, database)
    free = _recommendations(t, out, as_of, pay_after, city, limits, state)
    kv = psv.kv_records(psv.student_pack(t, free, city), psv.STUDENT_KEY_PREFIX, "sid", as_of)
    _export(out, kv, "kv_student", as_of, city, client_factory)
    return out.paths


def keyed_job(t: Tables, out_root: str, as_of: str, pay_after: str, city: str | None = None,
              client_factory=None, database: str | None = None, limits: dict[str, float] | None = None,
              state: str | None = None) -> dict[str, str]:
    """PL10: the same chain into the class-id keyed packs."""
    out = Output(t.spark, out_root, database)
    free = _recommendations(t, out, as_of, pay_after, city, limits, state)
    kv = psv.kv_records(psv.student_pack_keyed(t, free, city), psv.STUDENT_KEY_PREFIX, "sid", as_of)
    _export(out, kv, "kv_student_keyed", as_of, city, client_factory, keyed=True)
    return out.paths


def fallback_job(t: Tables, out_root: str, as_of: str, city: str | None = None, client_factory=None,
                 database: str | None = None) -> str:
    """PL11: fallback packs per city/grade/subject -> key-value records."""
    out = Output(t.spark, out_root, database)
    kv = psv.kv_records(psv.fallback_pack(t, city), psv.GROUP_KEY_PREFIX, "key", as_of)
    _export(out, kv, "kv_fallback", as_of, city, client_factory)
    return out.paths["kv_fallback"]


def order_recall_job(t: Tables, out_root: str, begin: str, end: str, database: str | None = None) -> dict[str, str]:
    """PL12: the text rows as a delimited text export (SNK4) and the sums per (id, feature),
    with the number of texts that were no number (AG11)."""
    out = Output(t.spark, out_root, database)
    rows_path = f"{out.root}/order_recall_rows"
    text_export(pf.order_recall_rows(t, begin, end), rows_path)
    out.overwrite(pf.order_recall(t, begin, end), "order_recall_sums")
    return {"rows": rows_path, "sums": out.paths["order_recall_sums"]}


def main(argv=None) -> None:
    from lumenrec.session import build_session
    from lumenrec.sources import fixtures as fx
    ap = argparse.ArgumentParser(prog="lumenrec.jobs")
    ap.add_argument("job", choices=["features", "lists", "tokens", "flagship", "keyed", "fallback", "order_recall"])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--sf-dir", help="driver tables folder (fixture binding)")
    src.add_argument("--catalog", help='JSON map of logical inputs to tables, e.g. {"behavior": "db.behavior"}')
    ap.add_argument("--out", required=True, help="shared output folder")
    ap.add_argument("--database", default=None, help="catalog database for the output tables")
    ap.add_argument("--city", default=None)
    ap.add_argument("--master", default=None, help="local master for a run outside spark-submit")
    ap.add_argument("--as-of", default=fx.AS_OF, help="today: the dt stamp and the future-session bound")
    ap.add_argument("--pay-after", default=fx.PAY_AFTER)
    ap.add_argument("--created-after", default=fx.CREATED_AFTER)
    ap.add_argument("--state", default=None, help="folder of day partials (features, lists) or of the token state (tokens, flagship, keyed)")
    ap.add_argument("--inserted", default=None, help="Parquet of the day's new registrations (tokens)")
    ap.add_argument("--deleted", default=None, help="Parquet of the day's deleted registrations (tokens)")
    ap.add_argument("--reject-limits", type=json.loads, default=None,
                    help='largest share of rejected rows per reason, e.g. {"bad_json": 0.01, "null_left": 0.05}')
    ap.add_argument("--event-range", nargs=2, default=[fx.EVENT_BEGIN, fx.EVENT_END])
    ap.add_argument("--order-range", nargs=2, default=[fx.ORDER_BEGIN, fx.ORDER_END])
    a = ap.parse_args(argv)
    if a.master:
        spark = build_session(master=a.master)
    else:
        from pyspark.sql import SparkSession
        from lumenrec.session import apply_core_conf
        spark = SparkSession.builder.getOrCreate()   # spark-submit supplies master and resources
        apply_core_conf(spark)
    t = fx.bind_fixtures(spark, a.sf_dir) if a.sf_dir else from_catalog(spark, json.loads(a.catalog))
    ev, od = tuple(a.event_range), tuple(a.order_range)
    if a.job == "features":
        res = feature_job(t, a.out, ev, od, od[1], a.created_after, a.database, a.state)
    elif a.job == "lists":
        res = list_job(t, a.out, ev[0], ev[1], ev[1], a.database, a.state)
    elif a.job == "tokens":
        changes = [spark.read.parquet(p) if p else None for p in (a.inserted, a.deleted)]
        res = token_state_job(t, a.state or f"{a.out}/token_state", a.pay_after, *changes)
    elif a.job in ("flagship", "keyed"):
        job = flagship_job if a.job == "flagship" else keyed_job
        res = job(t, a.out, a.as_of, a.pay_after, a.city, database=a.database, limits=a.reject_limits,
                  state=a.state)
    elif a.job == "fallback":
        res = fallback_job(t, a.out, a.as_of, a.city, database=a.database)
    else:
        res = order_recall_job(t, a.out, *od, a.database)
    print(json.dumps(res))
    spark.stop()


if __name__ == "__main__":
    main()
