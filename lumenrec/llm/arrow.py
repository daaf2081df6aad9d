"""Arrow helpers for the operators that run Python inside tasks."""

from __future__ import annotations

import contextlib
import gc
import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def in_tasks(rows: DataFrame, f: Callable, schema) -> DataFrame:
    """``mapInArrow`` with this package on the workers' path.

    Executors on other machines get the package as usual (``--py-files`` or installed); the
    path helps where they see the driver's folders, as with a local master.
    """
    env = rows.sparkSession.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])
    return rows.mapInArrow(f, schema)


def cuts(sizes, most: int) -> list[tuple[int, int]]:
    """Runs of rows whose sizes sum up to about ``most``, one row at least: (begin, end)."""
    import numpy as np

    if not len(sizes):
        return []
    block = np.cumsum(np.asarray(sizes, np.int64)) // most
    at = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(sizes)]
    return list(zip(at, at[1:]))


def parts(batches: Iterable[pa.RecordBatch], text: str = "text", chars: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about ``chars`` bytes of ``text`` each, one row at least.

    A batch that arrives is bounded by bytes too: Spark ends it at 64 MB or after one row
    (``spark.sql.execution.arrow.maxBytesPerBatch``).  A task's memory then depends on the
    longest text and not on the rows of a batch.
    """
    import pyarrow.compute as pc

    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        for a, b in cuts(size, chars):
            yield batch.slice(a, b - a)


@contextlib.contextmanager
def no_collector():
    """Cyclic garbage collection off: for code that makes millions of strings and no cycles, which
    reference counts free; the collector's passes over them take a tenth of the time."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return [t or "" for t in batch.column(name).to_pylist()]
