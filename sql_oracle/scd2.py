"""SCD-2 merge chain in SQL: one CTE group per customer batch."""

from __future__ import annotations

from sql_oracle.fragments import with_ctes

# Fixed values that must equal the reference: the customer columns, and those compared through coalesce(x, 0).
CUSTOMER_COLS = [
    "c_salutation", "c_preferred_cust_flag", "c_first_sales_date_sk", "c_customer_sk", "c_login",
    "c_current_cdemo_sk", "c_first_name", "c_current_hdemo_sk", "c_current_addr_sk", "c_last_name",
    "c_customer_id", "c_last_review_date_sk", "c_birth_month", "c_birth_country", "c_birth_year",
    "c_birth_day", "c_email_address", "c_first_shipto_date_sk",
]
COALESCED = {"c_first_sales_date_sk", "c_current_cdemo_sk", "c_current_hdemo_sk", "c_last_review_date_sk",
             "c_birth_month", "c_birth_year", "c_birth_day", "c_first_shipto_date_sk"}
DATES = ["2001-01-01", "2001-02-01", "2001-03-01"]


def _v(side: str, c: str) -> str:
    return f"coalesce({side}.{c}, 0)" if c in COALESCED else f"{side}.{c}"


MATCH = " AND ".join(f"{_v('t', c)} = {_v('s', c)}" for c in CUSTOMER_COLS)
CHANGED = " OR ".join(f"{_v('t', c)} != {_v('s', c)}" for c in CUSTOMER_COLS if c != "c_customer_sk")
STRICT_CHANGED = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in CUSTOMER_COLS if c != "c_customer_sk")
COLS_T = ", ".join(f"t.{c}" for c in CUSTOMER_COLS)


def chain(mode: str, batches: int) -> list[tuple[str, str]]:
    p = mode
    out = [(f"{p}_snap0", "SELECT *, CAST(NULL AS TIMESTAMP) AS start_date, CAST(NULL AS TIMESTAMP) AS end_date "
                          "FROM customer_b1 WHERE FALSE")]
    for b in range(1, batches + 1):
        ts = f"TIMESTAMP '{DATES[b - 1]} 00:00:00'"
        prev, src = f"{p}_snap{b - 1}", f"customer_b{b}"
        if mode == "reference":
            not_matched = f"NOT EXISTS (SELECT 1 FROM {prev} t WHERE {MATCH})"
            close = f"s.c_customer_sk IS NOT NULL AND ({CHANGED})"
        else:
            not_matched = (f"NOT EXISTS (SELECT 1 FROM {prev} t WHERE t.end_date IS NULL "
                           f"AND t.c_customer_sk = s.c_customer_sk AND NOT ({STRICT_CHANGED}))")
            close = f"s.c_customer_sk IS NOT NULL AND t.end_date IS NULL AND ({STRICT_CHANGED})"
        out.append((f"{p}_new{b}", f"SELECT s.*, {ts} AS start_date, CAST(NULL AS TIMESTAMP) AS end_date "
                                   f"FROM {src} s WHERE {not_matched}"))
        out.append((f"{p}_all{b}", f"SELECT * FROM {prev} UNION ALL SELECT * FROM {p}_new{b}"))
        out.append((f"{p}_snap{b}", f"SELECT {COLS_T}, t.start_date, CASE WHEN {close} THEN {ts} "
                                    f"ELSE t.end_date END AS end_date FROM {p}_all{b} t "
                                    f"LEFT JOIN {src} s ON t.c_customer_sk = s.c_customer_sk"))
    return out


def scd2_ctes(mode: str, batches: int, more: tuple[str, ...] = (), extra=None) -> str:
    names = [f"customer_b{b}" for b in range(1, batches + 1)] + list(more)
    return with_ctes(*names, extra=chain(mode, batches) + (extra or []))
