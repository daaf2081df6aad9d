"""Order weights (SC4, SC5).

A null status or price counts as 0, the value an unboxed null takes in the
original jobs (SURVEY Q2).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumenrec.functions._col import col

# ---- fixed values ------------------------------------------------------------
# Order status -> preference weight: 0 cart, 1 submitted, 2 paid, 3 refunded.
STATUS_WEIGHTS = [(0, 3.0), (1, 5.0), (2, 7.0), (3, -2.0)]
STATUS_WEIGHT_OTHER = 1.0
# Price below this threshold is kept as is for statuses 0-2.
PRICE_THRESHOLD = 1000.0
# Divisors above the threshold for statuses 0, 1, 2; status 3 always divides by 1000.
PRICE_DIVISORS = [(0, 10.0), (1, 5.0), (2, 2.0)]
REFUND_DIVISOR = 1000.0
# -------------------------------------------------------------------------------


def status_weight(status) -> Column:
    """SC4 ``order_status2weight``."""
    s = F.coalesce(col(status).cast("int"), F.lit(0))
    expr = None
    for code, w in STATUS_WEIGHTS:
        expr = F.when(s == code, F.lit(w)) if expr is None else expr.when(s == code, F.lit(w))
    return expr.otherwise(F.lit(STATUS_WEIGHT_OTHER))


def price_weight(status, price) -> Column:
    """SC5 ``cal_price``."""
    s = F.coalesce(col(status).cast("int"), F.lit(0))
    p = F.coalesce(col(price).cast("double"), F.lit(0.0))
    expr = None
    for code, div in PRICE_DIVISORS:
        branch = F.when(p < PRICE_THRESHOLD, p).otherwise(p / F.lit(div))
        expr = F.when(s == code, branch) if expr is None else expr.when(s == code, branch)
    return expr.when(s == 3, p / F.lit(REFUND_DIVISOR)).otherwise(F.lit(0.0))
