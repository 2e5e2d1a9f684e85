"""Physical plan properties: broadcast calendar, shuffles, pushed watermark."""

import tempfile

from pyspark.sql import functions as F

from retail_mart.operators import daily_sales as ds
from retail_mart.plans.registry import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_daily_joins_calendar_by_broadcast(spark):
    p = plan(QUERIES["daily_sales"](spark, "/root/testdata/sf0.001"))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_weekly_has_two_aggregate_shuffles(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(QUERIES["weekly_sales_inventory"](spark, "/root/testdata/sf0.001"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert p.count("Exchange hashpartitioning") <= 3
    assert "partial_sum" in p


def test_scd2_run_is_one_shuffle(spark, raw_small):
    """Sources of any size merge in one shuffle."""
    from retail_mart.operators import customer_scd2 as scd
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        snap = scd.scd2_apply(scd.empty_snapshot(spark), raw_small.customer(1), "2001-01-01")
        from retail_mart.session import checkpointed
        p = plan(scd.scd2_apply(checkpointed(snap), raw_small.customer(1), "2001-01-02"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert p.count("Exchange hashpartitioning(c_customer_sk") == 1
    assert "SortMergeJoin" not in p


def test_watermark_reaches_parquet_scan(spark, raw_small):
    """On stored raw tables the watermark literal is a pushed Parquet filter."""
    root = tempfile.mkdtemp(prefix="raw-")
    raw_small.catalog_sales().write.parquet(f"{root}/cs")
    raw_small.web_sales().write.parquet(f"{root}/ws")
    cs, ws = spark.read.parquet(f"{root}/cs"), spark.read.parquet(f"{root}/ws")
    df = ds.daily_sales(cs, ws, raw_small.date_dim(), since_sk=2450000)
    p = plan(df)
    # (the plan printer truncates long filter lists after the column name)
    assert "GreaterThanOrEqual(cs_sold_date_sk,245" in p
    assert "GreaterThanOrEqual(ws_sold_date_sk,245" in p


def test_program_is_one_aggregation_without_window(spark, raw_small):
    from retail_mart.operators import customer_program as cp
    from retail_mart.operators import customer_scd2 as scd
    r = raw_small
    prog = cp.monthly_customer_program(r.catalog_sales(with_customer=True), r.web_sales(with_customer=True),
                                       r.date_dim(), scd.empty_snapshot(spark), 1998, 7)
    assert "Window" not in plan(prog)
    q = QUERIES["monthly_customer_metrics"](spark, "/root/testdata/sf0.001")
    assert "Window" in plan(q)


def test_topk_limits_rows_before_the_shuffle(spark):
    """Per-group top-k: each map task keeps its first k rows per group
    (partial WindowGroupLimit below the exchange), so a hot group never
    ships all of its rows to one task."""
    for key in ("fk_sample", "top_items_by_amount"):
        p = plan(QUERIES[key](spark, "/root/testdata/sf0.001"))
        assert "WindowGroupLimit" in p and "Partial" in p, key


def test_calendar_broadcast_is_size_checked(spark, raw_small):
    from retail_mart.operators.common import CALENDAR_MAX_ROWS, calendar, checked_rows
    dd = raw_small.date_dim()
    assert checked_rows(dd, CALENDAR_MAX_ROWS) == 2557
    big = dd.select("*")
    big._retail_mart_rows = {CALENDAR_MAX_ROWS: CALENDAR_MAX_ROWS + 1}   # pretend it is too big
    fact = raw_small.catalog_sales()
    p = plan(fact.join(calendar(big, "d_date_sk"), fact["cs_sold_date_sk"] == F.col("d_date_sk")))
    p_small = plan(fact.join(calendar(dd, "d_date_sk"), fact["cs_sold_date_sk"] == F.col("d_date_sk")))
    assert "BroadcastHashJoin" in p_small
    assert p.count("BroadcastExchange") <= p_small.count("BroadcastExchange")


def test_weekly_incremental_prunes_daily_partitions(spark, raw_small):
    """On the stored, date-partitioned daily table the weekly watermark is a
    partition filter: only the last weeks' partitions are read."""
    from retail_mart.operators import daily_sales as ds
    from retail_mart.operators import weekly_inventory as wi
    from retail_mart.sources.periods import PeriodTable
    r = raw_small
    table = PeriodTable(spark, tempfile.mkdtemp(prefix="daily-") + "/daily", ["sold_date_sk"])
    table.replace(ds.daily_sales(r.catalog_sales(), r.web_sales(), r.date_dim()), spread=["item_sk"])
    daily = table.read()
    p = plan(wi.weekly_sales_inventory(daily, r.inventory(), r.date_dim(), since_wk_sk=2451900))
    scan = [ln for ln in p.split("\n") if "FileScan parquet" in ln and "daily" in ln][0]
    assert "PartitionFilters: [isnotnull(sold_date_sk" in scan and str(wi.week_bound(r.date_dim(), 2451900)) in scan


def test_programme_bounds_reach_the_fact_scans(spark, raw_small):
    """The target year arrives as literal days at the stored fact tables."""
    from retail_mart.operators import customer_program as cp
    from retail_mart.operators import customer_scd2 as scd
    r, root = raw_small, tempfile.mkdtemp(prefix="raw-")
    r.catalog_sales(with_customer=True).write.parquet(f"{root}/cs")
    r.web_sales(with_customer=True).write.parquet(f"{root}/ws")
    cs, ws = spark.read.parquet(f"{root}/cs"), spark.read.parquet(f"{root}/ws")
    lo, hi = cp.date_bounds(r.date_dim(), 1998, "documented")
    assert hi - lo == 364
    program = cp.monthly_customer_program(cs, ws, r.date_dim(), scd.empty_snapshot(spark), 1998, 3, "documented")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    p = program._jdf.queryExecution().explainString(mode)
    for c in ("cs_sold_date_sk", "ws_sold_date_sk"):
        assert f"GreaterThanOrEqual({c},{lo})" in p and f"LessThanOrEqual({c},{hi})" in p
