"""The stored customer months equal the aggregate of the whole history."""

import tempfile

import pytest
from pyspark.sql import functions as F

from retail_mart.operators import customer_program as cp
from retail_mart.operators import customer_scd2 as scd
from retail_mart.plans import pipeline as pl
from retail_mart.plans.registry import early_inputs, raw_inputs
from retail_mart.sources.periods import PeriodTable
from retail_mart.streaming import customer_months as cm
from tests.helpers import frame_rows


def plan(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.fixture()
def table(spark):
    return PeriodTable(spark, tempfile.mkdtemp(prefix="months-") + "/t", cm.MONTH)


def same(table, x):
    return frame_rows(table.read()) == frame_rows(cp.month_totals(x.catalog_sales, x.web_sales, x.date_dim).select(*table.read().columns))


def test_late_restated_and_vanished_days(spark, raw_small, table):
    early, full = early_inputs(raw_small), raw_inputs(raw_small, 1)
    assert cm.refresh(table, early.catalog_sales, early.web_sales, early.date_dim)
    assert same(table, early)
    cm.refresh(table, full.catalog_sales, full.web_sales, full.date_dim)
    assert same(table, full)
    assert cm.refresh(table, full.catalog_sales, full.web_sales, full.date_dim) == []  # nothing changed, nothing read
    # a sale moves to another customer (sums per day stay), a day vanishes
    day, other = sorted(r[0] for r in full.catalog_sales.filter("cs_sold_date_sk is not null and cs_ship_customer_sk is not null and cs_quantity is not null")
                        .select("cs_sold_date_sk").distinct().limit(40).collect())[::39]
    c = F.col("cs_sold_date_sk")
    moved = (full.catalog_sales.withColumn("cs_ship_customer_sk", F.when(c == day, F.col("cs_ship_customer_sk") + 1).otherwise(F.col("cs_ship_customer_sk")))
             .filter((c != other) | c.isNull()))
    web = full.web_sales.filter((F.col("ws_sold_date_sk") != other) | F.col("ws_sold_date_sk").isNull())
    again = cm.refresh(table, moved, web, full.date_dim)
    want = {tuple(r) for r in full.date_dim.filter(F.col("d_date_sk").isin(day, other)).select("yr_num", "mnth_num").collect()}
    assert set(again) == want
    full.catalog_sales, full.web_sales = moved, web
    assert same(table, full)


def test_a_renumbered_calendar_moves_a_day(spark, raw_small, table):
    full = raw_inputs(raw_small, 1)
    cm.refresh(table, full.catalog_sales, full.web_sales, full.date_dim)
    day = full.web_sales.agg(F.min("ws_sold_date_sk")).first()[0]
    full.date_dim = full.date_dim.withColumn("mnth_num", F.when(F.col("d_date_sk") == day, F.col("mnth_num") % 12 + 1).otherwise(F.col("mnth_num")))
    assert len(cm.refresh(table, full.catalog_sales, full.web_sales, full.date_dim)) == 2
    assert same(table, full)


def test_second_run_scans_the_changed_months_only(spark, raw_small, monkeypatch, table):
    """Sales stored by day: fingerprints read no column, the state reads the changed day's month."""
    full, root = raw_inputs(raw_small, 1), tempfile.mkdtemp(prefix="raw-")
    full.catalog_sales.repartition(4, "cs_sold_date_sk").write.partitionBy("cs_sold_date_sk").parquet(f"{root}/cs")
    full.web_sales.repartition(4, "ws_sold_date_sk").write.partitionBy("ws_sold_date_sk").parquet(f"{root}/ws")
    day = full.catalog_sales.agg(F.percentile("cs_sold_date_sk", 0.5).cast("bigint")).first()[0]

    def stored():
        full.catalog_sales, full.web_sales = spark.read.parquet(f"{root}/cs"), spark.read.parquet(f"{root}/ws")
        return full.catalog_sales, full.web_sales, full.date_dim, True
    cm.refresh(table, *stored())
    assert same(table, full) and cm.refresh(table, *stored()) == []
    late = full.catalog_sales.filter(F.col("cs_sold_date_sk") == day).limit(3)
    late.drop("cs_sold_date_sk").write.mode("append").parquet(f"{root}/late")
    spark.read.parquet(f"{root}/late").write.mode("append").parquet(f"{root}/cs/cs_sold_date_sk={day}")
    seen = []
    month_rows = cm.month_rows
    monkeypatch.setattr(cm, "month_rows", lambda *a: seen.append((month_rows(*a), a[3])) or seen[-1][0])
    args = stored()
    marks = plan(cm.fp.of_files(args[0], "cs_sold_date_sk"))
    assert "ReadSchema: struct<>" in marks
    month = cm.refresh(table, *args)
    first, last = full.date_dim.filter((F.col("yr_num") == month[0][0]) & (F.col("mnth_num") == month[0][1])).agg(F.min("d_date_sk"), F.max("d_date_sk")).first()
    assert len(month) == 1 and [s for _, s in seen] == [[(first, last)]]
    p = plan(seen[0][0])
    for c in ("cs_sold_date_sk", "ws_sold_date_sk"):
        assert any("PartitionFilters" in ln and f"({c}" in ln and f">= {first}" in ln and f"<= {last}" in ln for ln in p.split("\n")), p
    assert same(table, full)


@pytest.mark.parametrize("mode", ["reference", "documented"])
def test_programme_of_the_stored_months(spark, raw_small, mode):
    full, paths = raw_inputs(raw_small, 1), pl.MartPaths(tempfile.mkdtemp(prefix="mart-"))
    early = early_inputs(raw_small)
    for x in (early, full):
        pl.run_daily(spark, x, paths)
        wm = pl.run_monthly(spark, x, paths, mode)
    yr, mth = pl.target_period(full.date_dim, pl.daily_table(spark, paths).watermark())
    want = cp.monthly_customer_program(full.catalog_sales, full.web_sales, full.date_dim, scd.empty_snapshot(spark), yr, mth, mode)
    got = pl.read_monthly(spark, paths).filter((F.col("c_year") == yr) & (F.col("c_month") == mth))
    assert wm > 0 and want.count() > 0 and frame_rows(got.select(*want.columns)) == frame_rows(want)
