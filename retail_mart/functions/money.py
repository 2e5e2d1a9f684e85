"""Exact money arithmetic.

Amounts are decimals (whole cents) while summed, so totals do not depend on
row order; they leave the mart as doubles (the reference's FLOAT columns).
Ratios are rounded HALF_UP to six places (the reference's NUMBER(38,6)) and
then exposed as doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RATIO = "decimal(38,6)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def amount(price, quantity) -> Column:
    """price * quantity; NULL when either side is NULL."""
    return _c(price) * _c(quantity)


def ratio6(numerator, denominator) -> Column:
    """numerator / denominator rounded HALF_UP to 6 places (decimal(38,6)).

    Both operands are exact (integers or decimals). The division runs in
    decimal so the rounding is exact; NULL when the denominator is 0.
    """
    n = _c(numerator).cast("decimal(38,6)")
    d = _c(denominator).cast("decimal(38,6)")
    q = F.try_divide(n, d)
    return F.round(q, 6).cast(RATIO)


def whole_units(x) -> Column:
    """NUMBER(38,0) money column: rounded HALF_UP to whole units."""
    return F.round(_c(x), 0).cast("bigint")
