"""Jobs over a stored raw layer: ingest the inventory file, run all tasks, in every mode."""

import tempfile

import pytest
from pyspark.sql import functions as F

from retail_mart.operators import daily_sales as ds
from retail_mart.operators import weekly_inventory as wi
from retail_mart.plans import jobs
from retail_mart.operators.common import check_calendar
from retail_mart.plans import pipeline as pl
from retail_mart.plans.registry import raw_inputs
from retail_mart.sources import ingest, sinks
from tests.helpers import frame_rows


def test_modes_are_checked_before_the_first_write(spark, raw_small):
    root = tempfile.mkdtemp(prefix="mart-")
    with pytest.raises(ValueError, match="modes"):
        pl.run_pipeline(spark, raw_inputs(raw_small, 1), root, "2001-01-01", "strict", "strict")
    assert pl.read_daily(spark, pl.MartPaths(root)) is None


@pytest.mark.parametrize("scd_mode, program_mode", [("strict", "reference"), ("reference", "documented")])
def test_run_all_in_its_other_modes_after_an_empty_first_run(spark, raw_small, scd_mode, program_mode):
    """A first run without sales leaves tables that the next run can load."""
    root = tempfile.mkdtemp(prefix="mart-")
    paths = pl.MartPaths(root)
    pl.run_pipeline(spark, raw_inputs(raw_small, 1, cut=0), root, "2001-01-01", scd_mode, program_mode)
    first = int(raw_small.catalog_sales().agg(F.min("cs_sold_date_sk")).first()[0])
    pl.run_pipeline(spark, raw_inputs(raw_small, 2, cut=first + 30), root, "2001-02-01", scd_mode, program_mode)
    assert pl.read_daily(spark, paths).count() > 0 and pl.read_weekly(spark, paths).count() > 0
    assert pl.read_monthly(spark, paths).count() > 0 and pl.read_customer_dim(spark, paths).count() > 0


def test_money_is_exact_from_the_raw_boundary_on(spark):
    root = tempfile.mkdtemp(prefix="raw-")
    spark.sql("select 1L as ws_quantity, 0.1d as ws_sales_price, -2.35d as ws_net_profit").write.json(f"{root}/web_sales")
    t = jobs.raw_table(spark, root, "web_sales", fmt="json")
    assert t.schema["ws_sales_price"].dataType.simpleString() == "decimal(12,2)"
    assert [str(x) for x in t.select("ws_sales_price", "ws_net_profit").first()] == ["0.10", "-2.35"]


def test_two_writers_take_different_versions(spark):
    root = tempfile.mkdtemp(prefix="versions-")
    one, two = sinks.claim_version(spark, root), sinks.claim_version(spark, root)
    assert one != two
    for n in range(3):
        sinks.write_version(spark.range(n), root, keep=2)
    assert sinks.read_current(spark, root).count() == 2 and len(sinks.versions(spark, root)) == 2


def test_calendar_guard(spark, raw_small):
    dd = raw_small.date_dim()
    check_calendar(dd)
    with pytest.raises(ValueError, match="1 repeated days"):
        check_calendar(dd.union(dd.filter(F.col("day_of_wk_num") == 3).limit(1)))


def test_stored_raw_layer_end_to_end(spark, raw_small):
    r = raw_small
    raw_root = tempfile.mkdtemp(prefix="raw-")
    mart_root = tempfile.mkdtemp(prefix="mart-")
    tables = {"catalog_sales": r.catalog_sales(extra_keys=True), "web_sales": r.web_sales(extra_keys=True),
              "date_dim": r.date_dim(), "customer": r.customer(1), "customer_address": r.customer_address(),
              "customer_demographics": r.customer_demographics(),
              "household_demographics": r.household_demographics(), "income_band": r.income_band(),
              "item": r.item(), "warehouse": r.warehouse()}
    for name, df in tables.items():
        df.write.parquet(f"{raw_root}/{name}")
    csv = ingest.write_inventory_csv(r.inventory(), f"{raw_root}/_landing/inventory.csv")
    out = jobs.ingest_inventory(spark, raw_root, csv)
    assert out["inventory"].endswith("v=000001")
    inv = jobs.raw_table(spark, raw_root, "inventory")
    assert inv.count() + spark.read.parquet(out["rejects"]).count() == r.inventory().count()

    jobs.main(["run-all", "--raw-root", raw_root, "--mart-root", mart_root, "--as-of", "2001-01-01"])
    jobs.main(["copy-dims", "--raw-root", raw_root, "--mart-root", mart_root])
    paths = pl.MartPaths(mart_root)
    full_daily = ds.daily_sales(r.catalog_sales(), r.web_sales(), r.date_dim())
    daily = pl.read_daily(spark, paths)
    assert frame_rows(daily.select(*full_daily.columns)) == frame_rows(full_daily)
    weekly = pl.read_weekly(spark, paths)
    expect = wi.weekly_sales_inventory(full_daily, inv, r.date_dim())
    assert frame_rows(weekly.select(*expect.columns)) == frame_rows(expect)
    assert sinks.read_current(spark, f"{mart_root}/analytics/item_dim").count() == r.item().count()
    assert pl.read_customer_dim(spark, paths).filter(F.col("end_date").isNull()).count() > 0


def test_each_step_has_its_mode_and_tables_their_formats(spark, raw_small):
    """The corrected weekly load by the command line; sales as JSON; strict history with the documented programme."""
    r, raw_root, mart_root = raw_small, tempfile.mkdtemp(prefix="raw-"), tempfile.mkdtemp(prefix="mart-")
    # a calendar whose weeks begin a day before their day 0
    dd = r.date_dim().withColumn("wk_num", F.col("wk_num")).withColumn("day_of_wk_num", (F.col("day_of_wk_num") + 6) % 7)
    last = int(r.catalog_sales().agg(F.max("cs_sold_date_sk")).first()[0])
    tables = {"catalog_sales": r.catalog_sales(with_customer=True).filter(F.col("cs_sold_date_sk") > last - 40),
              "web_sales": r.web_sales(with_customer=True).filter(F.col("ws_sold_date_sk") > last - 40), "date_dim": dd, "customer": r.customer(1),
              "customer_address": r.customer_address(), "customer_demographics": r.customer_demographics(),
              "household_demographics": r.household_demographics(), "income_band": r.income_band()}
    for name, df in tables.items():
        if name == "web_sales":
            df.write.json(f"{raw_root}/{name}")
        elif name == "income_band":
            df.write.option("sep", "|").option("header", True).csv(f"{raw_root}/{name}")
        else:
            df.write.parquet(f"{raw_root}/{name}")
    sinks.write_version(r.inventory(), f"{raw_root}/inventory")
    args = ["--raw-root", raw_root, "--mart-root", mart_root, "--as-of", "2001-01-01", "--scd-mode", "strict", "--program-mode", "documented",
            "--weekly-mode", "strict", "--repair", "--source", "web_sales=json", "--source", "income_band=csv", "--source-option", "income_band.sep=|",
            "--source-option", "income_band.header=true", "--source-option", "income_band.inferSchema=true"]
    for _ in range(2):
        jobs.main(["run-all", *args])
    paths = pl.MartPaths(mart_root)
    daily = ds.daily_sales(tables["catalog_sales"], tables["web_sales"], dd)
    weekly = wi.weekly_sales_inventory(daily, r.inventory(), dd)
    assert frame_rows(pl.read_daily(spark, paths).select(*daily.columns)) == frame_rows(daily)
    assert frame_rows(pl.read_weekly(spark, paths).select(*weekly.columns)) == frame_rows(weekly)
    with pytest.raises(ValueError, match="unknown raw tables"):
        jobs.parse_sources(["websales=json"], [])
