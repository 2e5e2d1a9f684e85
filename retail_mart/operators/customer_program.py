"""Customer sales feed (P11), monthly metrics (P12, W1-W6) and the customer
monthly programme (P13-P15).

Reference semantics (mode="reference"): the "monthly" totals are running
totals since the first purchase (window ordered by year, month) and the
"yearly" figures cover every month of every year up to and including the
target year (RANGE frame ordered by year only, so later months of the
target year are included) -- quirk Q3. Names come from *all* snapshot
versions (Q4). mode="documented" uses per-month / per-year totals and the
open snapshot versions.

Plan: the programme needs one (year, month), so the five windows collapse
into one conditional aggregation per customer -- a single shuffle with a
map-side partial aggregate, no sort, and a hot customer costs one partial
row per task. ``monthly_customer_metrics`` keeps the window form for all
months, over a (customer, year, month) pre-aggregate: RANGE frames make all
rows of a month peers, so windows over the pre-aggregate give the same values
with far less window input. The same pre-aggregate, stored and kept up to date
(``streaming.customer_months``), feeds the scheduled programme.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_mart.functions.money import amount, ratio6, whole_units
from retail_mart.functions.program import membership_tier, promotion_flag
from retail_mart.operators.common import calendar

# Column order of the customer monthly programme table.
PROGRAM_COLUMNS = ["customer_sk", "first_name", "last_name", "customer_id", "email_address",
                   "c_year", "c_month", "sum_qty_mth", "sum_amt_mth", "avg_qty_yr", "avg_amt_yr",
                   "membership_status", "prom_flg_mth"]


def customer_sales(catalog_sales: DataFrame, web_sales: DataFrame) -> DataFrame:
    """Catalog by *ship* customer, web by *bill* customer (Q15)."""
    def channel(df: DataFrame, p: str, cust: str) -> DataFrame:
        out = df.select(F.col(cust).alias("customer_sk"), F.col(f"{p}_sold_date_sk").alias("sold_date_sk"),
                        F.col(f"{p}_quantity").alias("quantity"),
                        amount(f"{p}_sales_price", f"{p}_quantity").alias("amount"))
        return out.filter(F.col("customer_sk").isNotNull() & F.col("quantity").isNotNull()
                          & F.col("amount").isNotNull())
    return (channel(catalog_sales, "cs", "cs_ship_customer_sk")
            .unionByName(channel(web_sales, "ws", "ws_bill_customer_sk")))


def _dated(catalog_sales: DataFrame, web_sales: DataFrame, date_dim: DataFrame) -> DataFrame:
    feed = customer_sales(catalog_sales, web_sales)
    cal = calendar(date_dim, F.col("d_date_sk"), F.col("yr_num").alias("c_year"),
                   F.col("mnth_num").alias("c_month"))
    return feed.join(cal, feed["sold_date_sk"] == cal["d_date_sk"], "inner")


def date_bounds(date_dim: DataFrame, year: int, mode: str = "reference") -> tuple[int, int]:
    """First and last day the programme of ``year`` reads, from the calendar:
    up to the end of the year, in documented mode from its start on."""
    day = F.col("d_date_sk")
    row = date_dim.filter(F.col("yr_num") <= F.lit(int(year))).agg(
        F.min(F.when(F.col("yr_num") == F.lit(int(year)), day)).alias("start"), F.min(day).alias("lo"), F.max(day).alias("hi")).first()
    lo = row.start if mode == "documented" else row.lo
    return (0, -1) if lo is None else (int(lo), int(row.hi))


def month_totals(catalog_sales: DataFrame, web_sales: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Quantity ``q``, amount ``a`` and rows ``n`` per (customer, year, month)."""
    return (_dated(catalog_sales, web_sales, date_dim).groupBy("customer_sk", "c_year", "c_month")
            .agg(F.sum("quantity").alias("q"), F.sum("amount").alias("a"), F.count(F.lit(1)).alias("n")))


def monthly_customer_metrics(catalog_sales: DataFrame, web_sales: DataFrame,
                             date_dim: DataFrame) -> DataFrame:
    """The reference's window metrics for every (customer, year, month)."""
    return metrics_of_months(month_totals(catalog_sales, web_sales, date_dim))


def metrics_of_months(m: DataFrame) -> DataFrame:
    """P12 from ``month_totals``."""
    by_month = Window.partitionBy("customer_sk").orderBy("c_year", "c_month")   # W1, W2
    by_year = Window.partitionBy("customer_sk").orderBy("c_year")                # W3-W5
    return m.select(
        "customer_sk", "c_year", "c_month",
        F.sum("q").over(by_month).alias("sum_qty_mth"),
        F.sum("a").over(by_month).alias("sum_amt_mth"),
        ratio6(F.sum("q").over(by_year), F.sum("n").over(by_year)).alias("avg_qty_yr"),
        ratio6(F.sum("a").over(by_year), F.sum("n").over(by_year)).alias("avg_amt_yr"),
        F.sum("a").over(by_year).alias("sum_amt_yr"),
    )


def snapshot_names(snapshot: DataFrame, mode: str = "reference") -> DataFrame:
    snap = snapshot if mode == "reference" else snapshot.filter(F.col("end_date").isNull())
    return snap.select("c_customer_sk", F.col("c_first_name").alias("first_name"),
                       F.col("c_last_name").alias("last_name"), F.col("c_customer_id").alias("customer_id"),
                       F.col("c_email_address").alias("email_address")).distinct()


def monthly_customer_program(catalog_sales: DataFrame, web_sales: DataFrame, date_dim: DataFrame,
                             snapshot: DataFrame, year: int, month: int,
                             mode: str = "reference") -> DataFrame:
    """Programme rows for the customers who bought in (year, month)."""
    # sales outside the bounds contribute to no metric; as literals they reach the fact scans
    lo, hi = date_bounds(date_dim, year, mode)
    catalog_sales = catalog_sales.filter(F.col("cs_sold_date_sk").between(lo, hi))
    web_sales = web_sales.filter(F.col("ws_sold_date_sk").between(lo, hi))
    rows = _dated(catalog_sales, web_sales, date_dim)
    return program_of_months(rows.select("customer_sk", "c_year", "c_month", F.col("quantity").alias("q"),
                                         F.col("amount").alias("a"), F.lit(1).cast("bigint").alias("n")),
                             snapshot, year, month, mode)


def program_of_months(months: DataFrame, snapshot: DataFrame, year: int, month: int,
                      mode: str = "reference") -> DataFrame:
    """P15 from ``month_totals`` (or from any finer rows of the same columns)."""
    yr, mth = F.lit(int(year)), F.lit(int(month))
    in_target = (F.col("c_year") == yr) & (F.col("c_month") == mth)
    if mode == "reference":
        rows = months.filter(F.col("c_year") <= yr)
        month_cond = (F.col("c_year") < yr) | ((F.col("c_year") == yr) & (F.col("c_month") <= mth))
    elif mode == "documented":
        rows = months.filter(F.col("c_year") == yr)
        month_cond = in_target
    else:
        raise ValueError(mode)
    per_customer = (rows.groupBy("customer_sk").agg(
        F.sum(F.when(month_cond, F.col("q"))).alias("sum_qty_mth"),
        F.sum(F.when(month_cond, F.col("a"))).alias("amt_mth"),
        F.sum("q").alias("qty_yr"), F.sum("a").alias("amt_yr"), F.sum("n").alias("n_yr"),
        F.max(in_target).alias("bought_in_target"))
        .filter(F.col("bought_in_target")))
    program = per_customer.select(
        "customer_sk", yr.cast("bigint").alias("c_year"), mth.cast("bigint").alias("c_month"),
        F.col("sum_qty_mth").cast("bigint").alias("sum_qty_mth"),
        "amt_mth",
        ratio6(F.col("qty_yr"), F.col("n_yr")).alias("avg_qty_yr"),
        ratio6(F.col("amt_yr"), F.col("n_yr")).alias("avg_amt_yr"),
        membership_tier(F.col("amt_yr")).alias("membership_status"),
        promotion_flag(F.col("amt_mth")).alias("prom_flg_mth"),
    )
    # rows are unique per customer, so joining distinct names yields the
    # reference's SELECT DISTINCT; the money total is rounded last (Q5)
    names = snapshot_names(snapshot, mode)
    out = program.join(names, program["customer_sk"] == names["c_customer_sk"], "left")
    return out.select(*PROGRAM_COLUMNS[:7], "sum_qty_mth", whole_units("amt_mth").alias("sum_amt_mth"),
                      *PROGRAM_COLUMNS[9:])
