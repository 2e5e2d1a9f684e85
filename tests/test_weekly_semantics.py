"""Weekly fact semantics: Q10-Q12 and incremental cuts at awkward days."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from retail_mart.operators import daily_sales as ds
from retail_mart.operators import weekly_inventory as wi
from retail_mart.sources.fixtures import JULIAN_EPOCH
from retail_mart.streaming import incremental as inc
from tests.helpers import frame_rows

DAILY = ("warehouse_sk bigint, item_sk bigint, sold_date_sk bigint, sold_wk_num bigint, sold_yr_num bigint, "
         "daily_qty bigint, daily_sales_amt decimal(38,2), daily_net_profit decimal(38,2)")
INV = "inv_date_sk int, inv_item_sk int, inv_quantity_on_hand int, inv_warehouse_sk int"


def _sk(spark, day):
    return spark.sql(f"select {JULIAN_EPOCH} + unix_date(date'{day}')").first()[0]


def test_null_warehouse_and_double_inventory(spark, raw_small):
    dd = raw_small.date_dim()
    sun = _sk(spark, "1998-01-04")       # a Sunday: day 0 of its week
    wk = dd.filter(F.col("d_date_sk") == sun).first()
    rows = [(1, 7, sun + 1, wk.wk_num, wk.yr_num, 10, D(100), D(5)),
            (None, 7, sun + 2, wk.wk_num, wk.yr_num, 4, D(40), D(2))]
    daily = spark.createDataFrame(rows, DAILY)
    inv = spark.createDataFrame([(sun, 7, 3, 1), (sun + 3, 7, None, 1)], INV)
    out = {r.warehouse_sk: r for r in wi.weekly_sales_inventory(daily, inv, dd).collect()}
    # Q11: two inventory rows in the week double the sales sums
    assert out[1].sum_qty_wk == 20 and float(out[1].sum_amt_wk) == 200.0
    assert out[1].inv_qty_wk == 3 and out[1].sold_wk_sk == sun
    # Q12: NULL warehouse never matches inventory -> 0 on hand, flagged low
    assert out[None].inv_qty_wk == 0 and out[None].low_stock_flg_wk is True
    assert out[None].sum_qty_wk == 4


def test_week_without_day0_is_dropped(spark, raw_small):
    dd = raw_small.date_dim()
    jan1 = _sk(spark, "1998-01-01")      # a Thursday: week 1 of 1998 has no day 0
    wk = dd.filter(F.col("d_date_sk") == jan1).first()
    daily = spark.createDataFrame([(1, 3, jan1, wk.wk_num, wk.yr_num, 5, D(50), D(1))], DAILY)
    inv = spark.createDataFrame([], INV)
    assert wi.weekly_sales_inventory(daily, inv, dd).count() == 0
    assert wi.weeks_without_start(wi.weekly_rollup(daily), dd).first().dropped_groups == 1


@pytest.mark.parametrize("cut_day", ["1998-01-02", "1998-06-07", "1999-12-31", "2000-03-15"])
def test_weekly_incremental_equals_full_at_any_cut(spark, raw_small, cut_day):
    r = raw_small
    cut = _sk(spark, cut_day)
    cs1 = r.catalog_sales().filter(F.col("cs_sold_date_sk") <= cut)
    ws1 = r.web_sales().filter(F.col("ws_sold_date_sk") <= cut)
    existing = wi.weekly_sales_inventory(ds.daily_sales(cs1, ws1, r.date_dim()), r.inventory(), r.date_dim())
    daily = ds.daily_sales(r.catalog_sales(), r.web_sales(), r.date_dim())
    got = inc.weekly_incremental(existing, daily, r.inventory(), r.date_dim()).table
    assert frame_rows(got) == frame_rows(wi.weekly_sales_inventory(daily, r.inventory(), r.date_dim()))


@pytest.mark.parametrize("first_dow", [1, 6])   # ISO weeks begin on Monday, others on Saturday; day 0 stays Sunday
def test_reloaded_weeks_are_whole_on_any_calendar(spark, raw_small, first_dow):
    dd = raw_small.date_dim().withColumn("wk_num", F.expr(f"(d_date_sk + 1 - {first_dow}) div 7")).withColumn("yr_num", F.lit(1).cast("bigint"))
    sun = _sk(spark, "1998-06-07")
    weeks = {r.d_date_sk: r.wk_num for r in dd.filter(F.col("d_date_sk").between(sun - 20, sun + 20)).collect()}
    daily = spark.createDataFrame([(1, 7, sun + k, weeks[sun + k], 1, 10, D(100), D(5)) for k in range(-20, 21)], DAILY)
    inv = spark.createDataFrame([(sun + k, 7, 2, 1) for k in (-9, -2, 5)], INV)
    full = wi.weekly_sales_inventory(daily, inv, dd)
    got = wi.weekly_sales_inventory(daily, inv, dd, since_wk_sk=sun, mode="strict")
    assert frame_rows(got) == frame_rows(full.filter(F.col("sold_wk_sk") >= sun))
    # reference mode: the finished group counts, by its first sale
    kept = {w for k, w in weeks.items() if k < sun}
    ref = wi.weekly_sales_inventory(daily, inv, dd, since_wk_sk=sun)
    assert frame_rows(ref) == frame_rows(full.filter(~F.col("sold_wk_num").isin(*kept)))
