import datetime as dt

from pyspark.sql import types as T

from lumenrec import schemas
from lumenrec.sources.tables import Tables


def table(spark, schema, rows):
    return spark.createDataFrame(rows, schema)


def _padded(schema, row):
    """Row values with date texts as dates and missing last columns as nulls."""
    row = tuple(row) + (None,) * (len(schema.fields) - len(row))
    return tuple(dt.date.fromisoformat(v) if isinstance(f.dataType, T.DateType) and isinstance(v, str) else v
                 for f, v in zip(schema.fields, row))


def tables(spark, **named_rows):
    """A Tables bundle from in-memory rows: ``tables(spark, student=[...], ...)``."""
    from lumenrec.sources.tables import SCHEMAS
    loaders = {}
    for name, rows in named_rows.items():
        df = spark.createDataFrame([_padded(SCHEMAS[name], r) for r in rows], SCHEMAS[name])
        loaders[name] = (lambda d=df: d)
    return Tables(spark, loaders)


TOKENS = schemas.TOKENS
