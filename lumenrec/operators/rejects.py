"""Reject channel: rows that a job leaves out are counted on their way.

A source's rows pass ``watch``, which counts per reason within the same pass
that computes the result (Spark observations: no second scan, no collected
rows).  After the action, ``counts`` has them, and ``check`` fails the job if a
reason's share of its source is above the limit -- before anything is replaced,
when it is given to a sink as its check.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SCHEMA = "source string, reason string, n_rows long, n_rejected long"


class TooManyRejects(RuntimeError):
    """A reason's share of its source's rows is above its limit."""


class Rejects:
    """Counts of rejected rows per source and reason.

    ``limits``: the largest share of a reason's rows, for those that have a limit (0: none may be
    rejected); others are only counted.
    """

    def __init__(self, limits: dict[str, float] | None = None):
        self.limits = dict(limits or {})
        self._watched: list[tuple[str, list[str], DataFrame, list[Column], Observation]] = []

    def watch(self, rows: DataFrame, source: str, **reasons: Column) -> DataFrame:
        """``rows`` unchanged; each reason's condition is counted when they are computed."""
        seen = Observation(f"rejects-{source}-{len(self._watched)}")
        sums = [F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(r) for r, c in reasons.items()]]
        self._watched.append((source, list(reasons), rows, sums, seen))
        return rows.observe(seen, *sums)

    def counts(self) -> list[tuple[str, str, int, int]]:
        """(source, reason, rows, rejected) of all watched sources; waits for the action that computes them.

        A source that adaptive execution left out, because its rows could not reach the result, is
        counted by itself.
        """
        out = []
        for source, reasons, rows, sums, seen in self._watched:
            try:
                got = seen.get
            except Py4JJavaError:           # no counts were taken
                got = rows.agg(*sums).first().asDict()
            out += [(source, r, got["n_rows"], got[r]) for r in reasons]
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.counts(), SCHEMA)

    def check(self) -> None:
        """Fail if a reason's share is above its limit."""
        over = [f"{n} of {total} rows of {source}: {reason} (limit {self.limits[reason]:g})"
                for source, reason, total, n in self.counts() if reason in self.limits and n > self.limits[reason] * total]
        if over:
            raise TooManyRejects("; ".join(over))
