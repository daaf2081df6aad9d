"""Array helpers (NS3, NS6)."""

from __future__ import annotations

import re as _re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumenrec.functions._col import col


def java_split(c, delimiter: str) -> Column:
    """NS3: split like ``String.split``: trailing empty parts are dropped.

    Spark's ``split`` keeps them, so trailing delimiters are stripped first.
    A null text stays null, an empty text gives ``['']``, a text of delimiters
    alone gives an empty array.
    """
    d = _re.escape(delimiter)
    stripped = F.regexp_replace(col(c), f"(?:{d})+$", "")
    return F.when((stripped == "") & (col(c) != ""), F.array().cast("array<string>")) \
        .otherwise(F.split(stripped, d))


def pad(arr, n: int = 3, filler: str = "") -> Column:
    """NS6: the first ``n`` elements, padded with ``filler`` to length ``n``."""
    return F.slice(F.concat(col(arr), F.array_repeat(F.lit(filler), n)), 1, n)
