"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from typing import ClassVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WS = " \t\n\x0b\x0c\r"                # the white space that separates words
WS_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z only; other letters stay as they are."""
    return F.translate(c, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """Words of a text (null: none) without leading or trailing empty pieces."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WS_CLASS + "+"))


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a one-machine master without that setting (tests, a laptop) gets a folder of its own,
    removed when the process ends; a cluster without it is an error.
    """
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the whole cluster shares")
    path = tempfile.mkdtemp(prefix="llm-scratch-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


_BROADCAST_ROWS = 500_000      # rows (of about 30 bytes) up to which a counted table is broadcast


def row_key(*columns: str) -> Column:
    """64-bit hash that tells rows with one id apart."""
    return F.xxhash64(*[F.col(c) for c in columns])


def without(docs: DataFrame, gone: DataFrame, id_col: str, key: Column) -> DataFrame:
    """The rows of ``docs`` whose id and ``key`` are not in the written table ``gone`` (g_id, g_key).

    ``gone`` is broadcast only if a count finds it small; else both sides are shuffled.
    """
    if gone.count() <= _BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return docs.join(gone, docs[id_col].eqNullSafe(gone["g_id"]) & (key == gone["g_key"]), "left_anti")


class Scratch:
    """Written intermediate tables of one run in the shared folder.

    A written table cuts the lineage: a lost executor costs a re-read, never the whole chain.
    Results read these tables when they are computed, so they stay until :func:`release`.
    """

    _made: ClassVar[list[Scratch]] = []

    def __init__(self, spark: SparkSession, what: str):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
        if not Scratch._made:
            atexit.register(release)
        Scratch._made.append(self)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def release() -> int:
    """Delete the intermediate tables of all runs so far; returns of how many.

    For when their results have been written or collected; the end of the process does it too.
    """
    some, Scratch._made[:] = list(Scratch._made), []
    done = 0
    for scratch in some:
        if scratch.spark.sparkContext._jsc is not None:        # a stopped session cannot delete
            scratch.remove()
            done += 1
    return done
