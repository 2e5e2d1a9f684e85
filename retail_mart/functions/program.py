"""Customer programme rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference: yearly spend ceilings of the
# membership tiers (inclusive) and the monthly promotion threshold.
TIER_CEILINGS = [(25000, "Blue"), (50000, "Silver"), (100000, "Gold"), (200000, "Platinum")]
TIER_TOP = "Diamond"
PROMOTION_THRESHOLD = 100000


def membership_tier(yearly_amount: Column) -> Column:
    expr = None
    for ceiling, name in TIER_CEILINGS:
        cond = yearly_amount <= F.lit(ceiling)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(TIER_TOP))


def promotion_flag(monthly_amount: Column) -> Column:
    """True when the month's amount reaches the threshold; NULL input -> False."""
    return F.coalesce(monthly_amount >= F.lit(PROMOTION_THRESHOLD), F.lit(False))
