"""Weekly sales & inventory fact.

Reference semantics reproduced exactly:
* weeks are (wk_num, yr_num) of the calendar; a week's key is the date of its
  day 0, and weeks without a day 0 are dropped (inner join, quirk Q10);
* the inventory rows of the week are joined *before* aggregating, so k
  inventory rows multiply the week's sales sums by k (Q11);
* NULL warehouses never match inventory (Q12).

Plan: the sales side is unique per (warehouse, item, week, year), so the
join-then-aggregate is rewritten as aggregate-then-join: inventory is reduced
to (count, sum) per key map-side before its shuffle, the join is 1:1, and the
k-fold multiplication is applied as ``sum * coalesce(k, 1)``. Same numbers,
no row explosion, no aggregation after the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_mart.functions.money import ratio6
from retail_mart.operators.common import calendar

WEEK_KEYS = ["warehouse_sk", "item_sk", "sold_wk_num", "sold_yr_num"]
# Column order of the weekly fact table.
WEEKLY_COLUMNS = ["warehouse_sk", "item_sk", "sold_wk_sk", "sold_wk_num", "sold_yr_num",
                  "sum_qty_wk", "sum_amt_wk", "sum_profit_wk", "avg_qty_dy", "inv_qty_wk",
                  "wks_sply", "low_stock_flg_wk"]


def week_bound(date_dim: DataFrame, since_wk_sk: int) -> int:
    """Smallest day of any (week, year) that has a day on or after the
    watermark: rows from it on hold those weeks whole, on any calendar. One
    value, from the calendar alone."""
    late = date_dim.filter(F.col("d_date_sk") >= F.lit(int(since_wk_sk))).select("wk_num", "yr_num").distinct()
    row = date_dim.join(late, ["wk_num", "yr_num"]).agg(F.min("d_date_sk").alias("sk")).first()
    return int(since_wk_sk if row.sk is None else min(row.sk, since_wk_sk))


def weekly_rollup(daily: DataFrame, since_wk_sk: int | None = None, bound: int | None = None) -> DataFrame:
    """P5: daily -> (warehouse, item, week, year); keep groups whose first
    sale is on/after the weekly watermark.

    The watermark filters finished groups. ``bound`` (``week_bound``) prunes
    the scan of the stored, date-partitioned daily table; it cuts no week in two.
    """
    wm = F.lit(int(since_wk_sk or 0))
    rows = daily.filter(F.col("sold_date_sk") >= F.lit(int(bound if bound is not None else 0)))
    g = rows.groupBy(*WEEK_KEYS).agg(
        F.min("sold_date_sk").alias("first_sold_date_sk"),
        F.sum("daily_qty").alias("qty"),
        F.sum("daily_sales_amt").alias("amt"),
        F.sum("daily_net_profit").alias("profit"),
    )
    return g.filter(F.col("first_sold_date_sk") >= wm)


def week_start(rollup: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Attach the date key of the week's day 0 (inner join; drops weeks
    that have no day 0)."""
    starts = calendar(date_dim, F.col("wk_num"), F.col("yr_num"), F.col("d_date_sk").alias("sold_wk_sk"),
                      where=F.col("day_of_wk_num") == 0)
    j = rollup.join(starts, (rollup["sold_wk_num"] == starts["wk_num"])
                    & (rollup["sold_yr_num"] == starts["yr_num"]), "inner")
    return j.drop("wk_num", "yr_num", "first_sold_date_sk")


def weeks_without_start(rollup: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Q10 report: rolled-up groups the week-start join drops (their week has
    no day 0 in the calendar), counted per (year, week)."""
    starts = calendar(date_dim, F.col("wk_num").alias("sold_wk_num"), F.col("yr_num").alias("sold_yr_num"),
                      where=F.col("day_of_wk_num") == 0)
    lost = rollup.join(starts, ["sold_wk_num", "sold_yr_num"], "left_anti")
    return lost.groupBy("sold_yr_num", "sold_wk_num").agg(
        F.count(F.lit(1)).alias("dropped_groups"), F.sum("qty").cast("bigint").alias("dropped_qty"))


def inventory_by_week(inventory: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Inventory rows with their calendar week and year (inner join)."""
    cal = calendar(date_dim, F.col("d_date_sk"), F.col("wk_num").alias("inv_wk_num"),
                   F.col("yr_num").alias("inv_yr_num"))
    return inventory.join(cal, inventory["inv_date_sk"] == cal["d_date_sk"], "inner").drop("d_date_sk")


def inventory_week_totals(inv_weeks: DataFrame) -> DataFrame:
    """Per (warehouse, item, week, year): number of inventory rows and the sum
    of on-hand quantity (NULL counted as 0)."""
    return (inv_weeks.groupBy(
        F.col("inv_warehouse_sk").cast("bigint").alias("warehouse_sk"),
        F.col("inv_item_sk").cast("bigint").alias("item_sk"),
        F.col("inv_wk_num").alias("sold_wk_num"),
        F.col("inv_yr_num").alias("sold_yr_num"))
        .agg(F.count(F.lit(1)).alias("inv_rows"),
             F.sum(F.coalesce(F.col("inv_quantity_on_hand"), F.lit(0))).cast("bigint").alias("inv_sum")))


def weekly_sales_inventory(daily: DataFrame, inventory: DataFrame, date_dim: DataFrame,
                           since_wk_sk: int | None = None, mode: str = "reference") -> DataFrame:
    """The weekly fact from the daily table, all weeks from the watermark on.

    mode="reference" keeps a group whose first sale is on or after the
    watermark, so on a calendar whose weeks begin before their day 0 a
    reloaded week that sold earlier is dropped; mode="strict" keeps every
    week whose day 0 is on or after it. Daily sales and inventory are read
    from the calendar-derived bound on, which holds those weeks whole."""
    if mode not in ("reference", "strict"):
        raise ValueError(mode)
    if not since_wk_sk:
        return _weekly_fact(weekly_rollup(daily, since_wk_sk), inventory, date_dim)
    bound = week_bound(date_dim, since_wk_sk)
    inventory = inventory.filter(F.col("inv_date_sk") >= F.lit(bound))
    fact = _weekly_fact(weekly_rollup(daily, since_wk_sk if mode == "reference" else None, bound), inventory, date_dim)
    return fact if mode == "reference" else fact.filter(F.col("sold_wk_sk") >= F.lit(int(since_wk_sk)))


def weekly_sales_inventory_from_feed(catalog_sales: DataFrame, web_sales: DataFrame, inventory: DataFrame,
                                     date_dim: DataFrame) -> DataFrame:
    """Full load of the weekly fact straight from the raw sales.

    Same numbers as daily -> weekly (sums of daily sums and the min of daily
    dates are the sums and min over the rows), but the feed is aggregated
    once, to the week, so the day-grain shuffle disappears.
    """
    from retail_mart.operators.daily_sales import unified_sales
    feed = unified_sales(catalog_sales, web_sales)
    cal = calendar(date_dim, F.col("d_date_sk"), F.col("wk_num").alias("sold_wk_num"),
                   F.col("yr_num").alias("sold_yr_num"))
    dated = feed.join(cal, feed["sold_date_sk"] == cal["d_date_sk"], "left").select(
        *WEEK_KEYS, "sold_date_sk", F.col("quantity").alias("daily_qty"),
        F.col("sales_amt").alias("daily_sales_amt"), F.col("net_profit").alias("daily_net_profit"))
    return _weekly_fact(weekly_rollup(dated), inventory, date_dim)


def _weekly_fact(rollup: DataFrame, inventory: DataFrame, date_dim: DataFrame) -> DataFrame:
    sales = week_start(rollup, date_dim)
    inv = inventory_week_totals(inventory_by_week(inventory, date_dim))
    j = sales.join(inv, WEEK_KEYS, "left")
    k = F.coalesce(F.col("inv_rows"), F.lit(1))
    qty = (F.col("qty") * k).cast("bigint")
    inv_qty = F.coalesce(F.col("inv_sum"), F.lit(0)).cast("bigint")
    avg = F.try_divide(qty.cast("decimal(38,0)"), F.lit(7).cast("decimal(38,0)")).cast("decimal(38,6)")
    out = j.select(
        *WEEK_KEYS[:2], "sold_wk_sk", *WEEK_KEYS[2:],
        qty.alias("sum_qty_wk"),
        (F.col("amt") * k).alias("sum_amt_wk"),
        (F.col("profit") * k).alias("sum_profit_wk"),
        avg.alias("avg_qty_dy"),
        inv_qty.alias("inv_qty_wk"),
    )
    out = out.filter(F.col("sum_qty_wk") > 0)
    return out.select(
        *WEEKLY_COLUMNS[:8],
        F.col("avg_qty_dy"),
        "inv_qty_wk",
        ratio6(F.col("inv_qty_wk"), F.col("sum_qty_wk")).alias("wks_sply"),
        F.coalesce((F.col("avg_qty_dy") > 0) & (F.col("avg_qty_dy") > F.col("inv_qty_wk")),
                   F.lit(False)).alias("low_stock_flg_wk"),
    )
