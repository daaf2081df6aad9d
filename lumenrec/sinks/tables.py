"""Table sinks (SNK1-SNK4).

Appends of the original jobs are re-runnable here: a run replaces exactly its
own slice of a table, ``dt`` or ``dt`` and ``city_id``, also when it has no
rows (SURVEY Q16).  Runs of other days or cities stay.

A replacement is written aside, checked, and then moved in.  Until the move the
old rows are readable; the move is two folder renames, and a marker written
before them lets whoever comes next finish a move that was cut off.  File
systems whose folder rename is one operation (HDFS and the like) are assumed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lumenrec.sinks.files import Folder

_STAGING = "_staging"          # readers skip folders with a leading underscore
_MARKER = "_COMMIT"


def _staging(path: str, whole: bool) -> str:
    """Where replacements of slices (inside the table) or of the whole table (beside it) wait."""
    if not whole:
        return f"{path}/{_STAGING}"
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/{_STAGING}_{name}"


def _finish(folder: Folder, run: str) -> None:
    """The renames of a replacement that is written in full, as its marker lists them; may be
    called again after a cut."""
    for i, (new, target) in enumerate(json.loads(folder.read_text(f"{run}/{_MARKER}"))):
        if folder.exists(new):
            if folder.exists(target):
                old = f"{run}/old-{i}"
                folder.move(target, old if not folder.exists(old) else f"{old}-{uuid.uuid4().hex}")
            folder.move(new, target)
    folder.remove(run)


def recover(spark: SparkSession, path: str, whole: bool = False) -> int:
    """Finish the replacements whose rows were all written but whose move was cut off.

    Runs without the marker have died while writing, or still write: they are left alone.
    Returns how many were finished.
    """
    folder, staging = Folder(spark, path), _staging(path, whole)
    runs = [f"{staging}/{name}" for name in folder.names(staging)]
    ready = [run for run in runs if folder.exists(f"{run}/{_MARKER}")]
    for run in ready:
        _finish(folder, run)
    return len(ready)


def _replace(spark: SparkSession, path: str, whole: bool, write: Callable[[str], list[tuple[str, str]]],
             check: Callable[[], None] | None = None) -> None:
    """``write(run)`` writes below the folder ``run`` and gives the pairs (written folder, target)."""
    recover(spark, path, whole)
    folder, run = Folder(spark, path), f"{_staging(path, whole)}/{uuid.uuid4().hex}"
    try:
        moves = write(run)
        if check is not None:
            check()
    except BaseException:
        folder.remove(run)
        raise
    folder.write_text(f"{run}/{_MARKER}.tmp", json.dumps(moves))
    folder.move(f"{run}/{_MARKER}.tmp", f"{run}/{_MARKER}")
    _finish(folder, run)


def replace_slice(df: DataFrame, path: str, check: Callable[[], None] | None = None, **slice_: str) -> None:
    """SNK1: replace the slice (``dt=...`` or ``dt=..., city_id=...``) of the table at ``path``.

    The folders are Hive partitions in the order of ``slice_``.  A run over all
    cities (``dt`` alone) of a table with a ``city_id`` replaces every city of
    that ``dt``.  ``check`` runs when the rows are written and before they
    replace anything; if it or the write fails, the old slice stays.
    """
    rows = df.drop(*slice_)

    def write(run: str) -> list[tuple[str, str]]:
        writer = rows.write.partitionBy("city_id") if "city_id" in rows.columns else rows.write
        writer.parquet(f"{run}/new")
        return [(f"{run}/new", "/".join([path, *(f"{k}={v}" for k, v in slice_.items())]))]

    _replace(df.sparkSession, path, False, write, check)


def replace_slices(df: DataFrame, path: str, column: str, values: list[str]) -> None:
    """SNK1 for many slices of one column in one write; ``df`` holds rows of these ``values`` alone.

    A value without rows becomes an empty slice.  Each slice is moved in by itself: a reader may
    see some of the new ones before the others.
    """
    folder = Folder(df.sparkSession, path)

    def write(run: str) -> list[tuple[str, str]]:
        df.write.partitionBy(column).parquet(f"{run}/new")
        moves = [(f"{run}/new/{column}={v}", f"{path}/{column}={v}") for v in values]
        for new, _ in moves:
            folder.make(new)
        return moves

    _replace(df.sparkSession, path, False, write)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there; any other failure is raised."""
    return Folder(spark, path).exists(path)


def read_slice(spark: SparkSession, schema, path: str, **slice_: str) -> DataFrame:
    """The slice's rows with the columns of ``schema`` (an empty slice has no files to ask)."""
    recover(spark, path)
    df = spark.read.schema(schema).option("basePath", path).parquet(path)
    for k, v in slice_.items():
        df = df.filter(df[k] == v)
    return df


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet", check: Callable[[], None] | None = None,
                    **options: str) -> None:
    """SNK2: replace the whole table, in the same way; it may be read by the rows that replace it."""
    def write(run: str) -> list[tuple[str, str]]:
        df.write.format(fmt).options(**options).save(f"{run}/new")
        return [(f"{run}/new", path)]

    _replace(df.sparkSession, path, True, write, check)


def create_if_absent(spark: SparkSession, name: str, df: DataFrame, location: str,
                     partitions: tuple[str, ...] = ()) -> None:
    """SNK3: ``CREATE TABLE IF NOT EXISTS`` over the written folder, with the columns of ``df``,
    and its partitions registered."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    by = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{by} LOCATION '{location}'")
    if partitions:
        spark.catalog.recoverPartitions(name)
    else:
        spark.catalog.refreshTable(name)


def text_export(df: DataFrame, path: str, sep: str = ",", records_per_file: int = 1_000_000) -> None:
    """SNK4 re-aimed: the original forced one file (``coalesce(1, shuffle=true)``),
    which funnels the whole export through one task.  Here every partition writes
    its own delimited text files, each at most ``records_per_file`` rows; the
    folder is the export (concatenate the parts if one file is required)."""
    (df.write.mode("overwrite").option("sep", sep)
     .option("maxRecordsPerFile", records_per_file).csv(path))
