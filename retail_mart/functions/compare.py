"""Row comparison for the type-2 customer history.

``reference`` semantics: string columns and the current address key are
compared with plain SQL equality (NULL never equals anything), the other
numeric columns through ``coalesce(x, 0)``. ``strict`` semantics compare all
columns null-safely and without the coalesce.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference: the 18 tracked customer
# columns in the source table's order, and which of them the merge compares
# through coalesce(x, 0).
CUSTOMER_COLUMNS = [
    "c_salutation", "c_preferred_cust_flag", "c_first_sales_date_sk", "c_customer_sk",
    "c_login", "c_current_cdemo_sk", "c_first_name", "c_current_hdemo_sk",
    "c_current_addr_sk", "c_last_name", "c_customer_id", "c_last_review_date_sk",
    "c_birth_month", "c_birth_country", "c_birth_year", "c_birth_day",
    "c_email_address", "c_first_shipto_date_sk",
]

COALESCED_COLUMNS = [
    "c_first_sales_date_sk", "c_current_cdemo_sk", "c_current_hdemo_sk",
    "c_last_review_date_sk", "c_birth_month", "c_birth_year", "c_birth_day",
    "c_first_shipto_date_sk",
]
# Compared with plain equality (includes the key itself).
PLAIN_COLUMNS = [c for c in CUSTOMER_COLUMNS if c not in COALESCED_COLUMNS]


def _get(side):
    """Column getter for one side: a table alias ("t") or a callable."""
    if callable(side):
        return side
    return lambda c: F.col(f"{side}.{c}")


def _v(side, c: str) -> Column:
    col = _get(side)(c)
    return F.coalesce(col, F.lit(0)) if c in COALESCED_COLUMNS else col


def reference_match(t, s) -> Column:
    """The 18-column insert-merge condition (all equal, NULL never equal);
    NULL results count as "no match"."""
    parts = [_v(t, c) == _v(s, c) for c in CUSTOMER_COLUMNS]
    return F.coalesce(reduce(lambda a, b: a & b, parts), F.lit(False))


def reference_changed(t, s) -> Column:
    """The update-merge condition: any column differs (three-valued OR,
    NULL counts as "unchanged")."""
    parts = [_v(t, c) != _v(s, c) for c in CUSTOMER_COLUMNS if c != "c_customer_sk"]
    return F.coalesce(reduce(lambda a, b: a | b, parts), F.lit(False))


def strict_changed(t, s) -> Column:
    """Any tracked column differs, NULL-safe (NULL equals NULL)."""
    gt, gs = _get(t), _get(s)
    parts = [~gt(c).eqNullSafe(gs(c)) for c in CUSTOMER_COLUMNS if c != "c_customer_sk"]
    return reduce(lambda a, b: a | b, parts)
