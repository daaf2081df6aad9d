"""Key-value export (SNK5): one value per key in a store, replaced as a whole.

The original issued ``SETEX key ttl value`` with the JSON of a key as its value,
and readers ``GET key``.  So does this: a key's entries become its one value, and
a later push replaces it, so entries that are gone from the export are gone
from the store; keys that are gone are deleted.

A key of very many entries would be one huge value made in one task.  Beyond
``page_entries`` its entries are dealt over pages by hash, each a value of its
own under ``key/generation/page``, and the key's value becomes a small list of
them, written when all pages are there.  ``read_value`` puts them together.

Pushes are idempotent: a retried task writes the same values again.
"""

from __future__ import annotations

import json
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenrec.operators import packs

PAGE_ENTRIES = 1000
SERVED = "key string, city_id string, n long, generation string, ttl_s long"


def _pages(n: Column, page_entries: int) -> Column:
    """Pages of a key of n entries: half full on average, so that chance does not overfill them."""
    return F.when(n <= page_entries, F.lit(0)).otherwise(F.ceil(2 * n / page_entries)).cast("int")


def served_keys(kv: DataFrame, generation: str) -> DataFrame:
    """What a push of ``kv`` leaves in the store: (key, city_id, n, generation, ttl_s)."""
    return kv.groupBy("key").agg(F.max("city_id").alias("city_id"), F.count(F.lit(1)).alias("n"), F.max("ttl_s").cast("long").alias("ttl_s")) \
        .select("key", "city_id", "n", F.lit(generation).alias("generation"), "ttl_s")


def _page_key(page: str) -> Column:
    return F.concat_ws("/", F.col("key"), F.col("generation"), F.col(page).cast("string"))


def store_values(kv: DataFrame, generation: str, keyed: bool = False, page_entries: int = PAGE_ENTRIES) -> DataFrame:
    """``(store_key, value, ttl_s)``: the value of each small key, and of each page of a large one.

    No value holds more than ``page_entries`` entries of different classes (up to chance),
    whatever the key; the pages of one key are made in different tasks.
    """
    sizes = served_keys(kv, generation).select("key", "n", "generation", F.col("ttl_s").alias("ttl"))
    j = kv.join(sizes, "key")
    page = F.pmod(F.xxhash64("section", "cla_id"), F.greatest(_pages(F.col("n"), page_entries), F.lit(1)))
    j = j.withColumn("page", page)
    j = j.withColumn("store_key", F.when(F.col("n") <= page_entries, F.col("key")).otherwise(_page_key("page")))
    values = packs.render(j.select("store_key", "section", "cla_id", F.col("value").alias("entry"), "ttl"), "store_key", keyed,
                          F.max("ttl").alias("ttl_s"))
    return values.select("store_key", "value", "ttl_s")


def manifests(kv: DataFrame, generation: str, page_entries: int = PAGE_ENTRIES) -> DataFrame:
    """``(store_key, value, ttl_s)``: the list of pages of each large key."""
    large = served_keys(kv, generation).filter(F.col("n") > page_entries)
    return large.select(F.col("key").alias("store_key"),
                        F.to_json(F.struct("generation", _pages(F.col("n"), page_entries).alias("pages"))).alias("value"), "ttl_s")


def gone_keys(kv: DataFrame, generation: str, previous: DataFrame, page_entries: int = PAGE_ENTRIES) -> DataFrame:
    """``store_key`` of what earlier pushes left and this one does not replace: keys without
    entries now, and the pages of earlier generations.  ``previous``: rows as :func:`served_keys`."""
    now = served_keys(kv, generation)
    keys = previous.join(now.select("key"), "key", "left_anti").select(F.col("key").alias("store_key"))
    old = previous.filter(F.col("n") > page_entries).join(now.select("key", "generation"), ["key", "generation"], "left_anti")
    old = old.select("key", "generation", F.explode(F.sequence(F.lit(0), _pages(F.col("n"), page_entries) - 1)).alias("page"))
    return keys.unionByName(old.select(_page_key("page").alias("store_key")))


def push_values(values: DataFrame, client_factory: Callable[[], object], batch: int = 500) -> None:
    """SETEX every ``(store_key, value, ttl_s)``, with one client per partition.

    ``client_factory()`` is called on the executor and must return an object with
    ``setex(key, ttl_s, value)``, ``delete(key)`` and ``close()``, or with ``pipeline()``.
    """
    _each(values.select("store_key", F.col("ttl_s").cast("long"), "value"), client_factory, batch, "setex")


def delete_keys(keys: DataFrame, client_factory: Callable[[], object], batch: int = 500) -> None:
    _each(keys.select("store_key"), client_factory, batch, "delete")


def push_export(kv: DataFrame, client_factory: Callable[[], object], generation: str, previous: DataFrame | None = None,
                keyed: bool = False, page_entries: int = PAGE_ENTRIES, batch: int = 500) -> None:
    """Make the store hold exactly the keys and entries of ``kv`` (a written key-value table).

    ``generation`` names this push; ``previous`` is what earlier pushes left (rows as
    :func:`served_keys`).  Pages come first, then the lists that name them, then what is gone
    is deleted, so a reader sees a key's old value or its new one.
    """
    push_values(store_values(kv, generation, keyed, page_entries), client_factory, batch)
    push_values(manifests(kv, generation, page_entries), client_factory, batch)
    if previous is not None:
        delete_keys(gone_keys(kv, generation, previous, page_entries), client_factory, batch)


def read_value(client, key: str) -> str | None:
    """A key's JSON value, from its pages if it has any."""
    value = client.get(key)
    head = json.loads(value) if value is not None else None
    if not (isinstance(head, dict) and set(head) == {"generation", "pages"}):
        return value
    found = [client.get(f"{key}/{head['generation']}/{i}") for i in range(head["pages"])]
    parts = [json.loads(v) for v in found if v is not None]
    if isinstance(parts[0], list):
        whole = sorted((e for p in parts for e in p), key=lambda e: e["cla_id"])
    else:
        whole = {}
        for section in parts[0]:
            some = [p[section] for p in parts]
            if isinstance(some[0], list):
                whole[section] = sorted((e for s in some for e in s), key=lambda e: e["cla_id"])
            else:
                whole[section] = dict(sorted(kv for s in some for kv in s.items()))
    return json.dumps(whole, ensure_ascii=False, separators=(",", ":"))


def _each(rows: DataFrame, client_factory: Callable[[], object], batch: int, call: str) -> None:
    """Call ``call`` of a client with every row's values, ``batch`` calls at a time."""
    def send(part):
        client = client_factory()
        try:
            pipe = getattr(client, "pipeline", None)
            buf = []
            for r in part:
                buf.append(tuple(r))
                if len(buf) >= batch:
                    flush(client, pipe, buf)
                    buf = []
            flush(client, pipe, buf)
        finally:
            close = getattr(client, "close", None)
            if close:
                close()

    def flush(client, pipe, buf):
        if not buf:
            return
        target = pipe() if pipe is not None else client
        for args in buf:
            getattr(target, call)(*args)
        if pipe is not None:
            target.execute()

    rows.foreachPartition(send)


def push_partitions(kv: DataFrame, client_factory: Callable[[], object], batch: int = 500) -> None:
    """One store record per entry, under ``<key>/<section>/<class id>``: for stores whose readers
    fetch single entries.  Entries that are gone expire by their TTL; use :func:`push_export`
    for one value per key, replaced as a whole."""
    push_values(kv.select(F.concat_ws("/", "key", "section", "cla_id").alias("store_key"), "value", "ttl_s"), client_factory, batch)
