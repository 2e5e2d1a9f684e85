"""Column expressions shared by the operators (all built-in, JVM side)."""

from retail_mart.functions.money import (  # noqa: F401
    amount, ratio6, whole_units,
)
from retail_mart.functions.program import membership_tier, promotion_flag  # noqa: F401
from retail_mart.functions.compare import (  # noqa: F401
    CUSTOMER_COLUMNS, COALESCED_COLUMNS, PLAIN_COLUMNS,
    reference_match, reference_changed, strict_changed,
)
