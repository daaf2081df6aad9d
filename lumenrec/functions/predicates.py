"""Row predicates (PF5-PF14)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumenrec.functions._col import col

# ---- fixed values ------------------------------------------------------------
# Placeholder ids that count as missing.
INVALID_IDS = ["", "-"]
# -------------------------------------------------------------------------------


def is_valid(c) -> Column:
    """PF5: not null, not ``''`` and not ``'-'``."""
    c = col(c)
    return c.isNotNull() & ~c.isin(*INVALID_IDS)


def is_valid_city_weak(c) -> Column:
    """PF6: the weaker check used for a student's city: only ``''`` is rejected."""
    c = col(c)
    return c.isNotNull() & (c != "")


def date_between(c, begin: str | None = None, end: str | None = None) -> Column:
    """PF8: closed range on a date column; the bounds are date literals, which reach the scan."""
    c = col(c)
    cond = None
    if begin is not None:
        cond = c >= F.lit(begin).cast("date")
    if end is not None:
        upper = c <= F.lit(end).cast("date")
        cond = upper if cond is None else cond & upper
    return F.lit(True) if cond is None else cond


def not_empty_json(c) -> Column:
    """PF10: a JSON object text other than ``{}``."""
    c = col(c)
    return c.isNotNull() & (c != "{}")


def first_not_blank(arr) -> Column:
    """PF12: the list is not empty and its first element is not ``''``.

    ``get`` returns null past the end instead of failing under ANSI mode.
    """
    first = F.get(col(arr), F.lit(0))
    return first.isNotNull() & (first != "")
