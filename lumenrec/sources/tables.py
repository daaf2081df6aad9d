"""The bundle of input tables every plan reads (SRC1-SRC15).

A ``Tables`` holds one lazily built DataFrame per logical input.  Plans take a
``Tables`` and never name storage, so the same plan runs on catalog tables in
production (``from_catalog``) and on the driver's parquet files in tests
(``lumenrec.sources.fixtures.bind_fixtures``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from lumenrec import schemas

# logical name -> declared schema
SCHEMAS = {
    "behavior": schemas.BEHAVIOR,      # SRC2 / SRC3 user behaviour
    "order": schemas.ORDER,            # SRC1 orders
    "regist": schemas.REGIST,          # SRC4 registrations
    "user": schemas.USER,              # SRC5 live users
    "student": schemas.STUDENT,        # SRC6 students
    "klass": schemas.CLASS,            # SRC7 / SRC12 classes
    "curriculum": schemas.CURRICULUM,  # SRC8 sessions
    "rule": schemas.RULE,              # SRC10 association rules
    "location": schemas.LOCATION,      # SRC11 student locations
    "register": schemas.REGISTER,      # SRC13 packed registrations
    "score": schemas.SCORE,            # SRC14 class scores
}


@dataclass
class Tables:
    spark: SparkSession
    loaders: dict[str, Callable[[], DataFrame]] = field(default_factory=dict)
    _cache: dict[str, DataFrame] = field(default_factory=dict)

    def get(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name not in self.loaders:
                raise KeyError(f"no source bound for {name!r}")
            df = self.loaders[name]()
            if name in SCHEMAS:
                df = schemas.check(df, SCHEMAS[name], name)
            self._cache[name] = df
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name in ("spark", "loaders"):
            raise AttributeError(name)
        return self.get(name)


def from_catalog(spark: SparkSession, names: dict[str, str]) -> Tables:
    """Bind logical inputs to catalog tables, e.g. ``{"behavior": "source.behavior"}``."""
    return Tables(spark, {k: (lambda t=t: spark.table(t)) for k, t in names.items()})
