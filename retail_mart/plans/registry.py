"""Registered queries: (spark, sf_dir) -> DataFrame, one per operator.

Each builds the raw layer from the driver's tables (sources.fixtures) and
runs the operator over all of it. Result sets expose money and ratios as
double and dates as timestamp (see operators.common.for_report).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_mart.operators import customer_program as cp
from retail_mart.operators import customer_scd2 as scd
from retail_mart.operators import daily_sales as ds
from retail_mart.operators import profiling as pf
from retail_mart.operators import reports as rp
from retail_mart.operators import weekly_inventory as wi
from retail_mart.operators.common import for_report
from retail_mart.plans import pipeline as pl
from retail_mart.session import checkpointed, new_run_dir
from retail_mart.sources import ingest
from retail_mart.sources.fixtures import CUSTOMER_BATCH_DATES, RawTables
from retail_mart.sources.periods import PeriodTable
from retail_mart.streaming import customer_months as cm
from retail_mart.streaming import incremental as inc
from retail_mart.streaming.watermark import (
    period_watermark, target_period, target_period_frame, watermark_frame,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def raw(spark: SparkSession, sf_dir: str) -> RawTables:
    return RawTables(spark, sf_dir)


def daily_table(r: RawTables, since_sk: int | None = None) -> DataFrame:
    return ds.daily_sales(r.catalog_sales(), r.web_sales(), r.date_dim(), since_sk)


def weekly_table(r: RawTables) -> DataFrame:
    """Full load of the weekly fact (one aggregation from the raw feed)."""
    return wi.weekly_sales_inventory_from_feed(r.catalog_sales(), r.web_sales(), r.inventory(), r.date_dim())


@register("unified_sales")
def q_unified_sales(spark, sf_dir):
    r = raw(spark, sf_dir)
    return for_report(ds.unified_sales(r.catalog_sales(), r.web_sales()))


@register("daily_sales")
def q_daily_sales(spark, sf_dir):
    return for_report(daily_table(raw(spark, sf_dir)))


@register("weekly_rollup")
def q_weekly_rollup(spark, sf_dir):
    return for_report(wi.weekly_rollup(daily_table(raw(spark, sf_dir))))


@register("weekly_week_start")
def q_weekly_week_start(spark, sf_dir):
    r = raw(spark, sf_dir)
    return for_report(wi.week_start(wi.weekly_rollup(daily_table(r)), r.date_dim()))


@register("weekly_dropped_weeks")
def q_weekly_dropped_weeks(spark, sf_dir):
    r = raw(spark, sf_dir)
    return wi.weeks_without_start(wi.weekly_rollup(daily_table(r)), r.date_dim())


@register("inventory_by_week")
def q_inventory_by_week(spark, sf_dir):
    r = raw(spark, sf_dir)
    return wi.inventory_by_week(r.inventory(), r.date_dim())


@register("weekly_sales_inventory")
def q_weekly_sales_inventory(spark, sf_dir):
    return for_report(weekly_table(raw(spark, sf_dir)))


# ------------------------------------------------------------------ reports


@register("top_items_by_amount")
def q_top_items_by_amount(spark, sf_dir):
    return for_report(rp.ranked_items(weekly_table(raw(spark, sf_dir)), "sales_amt", top=True))


@register("top_items_by_quantity")
def q_top_items_by_quantity(spark, sf_dir):
    return for_report(rp.ranked_items(weekly_table(raw(spark, sf_dir)), "sales_qty", top=True))


@register("bottom_items_by_amount")
def q_bottom_items_by_amount(spark, sf_dir):
    return for_report(rp.ranked_items(weekly_table(raw(spark, sf_dir)), "sales_amt", top=False))


@register("bottom_items_by_quantity")
def q_bottom_items_by_quantity(spark, sf_dir):
    return for_report(rp.ranked_items(weekly_table(raw(spark, sf_dir)), "sales_qty", top=False))


@register("low_inventory_items")
def q_low_inventory_items(spark, sf_dir):
    return for_report(rp.low_inventory_items(weekly_table(raw(spark, sf_dir))))


@register("low_stock_by_warehouse")
def q_low_stock_by_warehouse(spark, sf_dir):
    return for_report(rp.low_stock_by_warehouse(weekly_table(raw(spark, sf_dir))))


# -------------------------------------------------------------- incremental


def sales_span(r: RawTables) -> tuple[int, int]:
    """(min, max) sold date over both channels; one row to the driver."""
    cs = r.catalog_sales().select(F.col("cs_sold_date_sk").alias("d"))
    ws = r.web_sales().select(F.col("ws_sold_date_sk").alias("d"))
    row = cs.unionByName(ws).agg(F.min("d"), F.max("d")).first()
    return int(row[0]), int(row[1])


def split_day(r: RawTables) -> int:
    """A first batch holds the sales up to the middle of the sold-date span."""
    lo, hi = sales_span(r)
    return (lo + hi) // 2


def raw_until(r: RawTables, cut: int):
    return (r.catalog_sales().filter(F.col("cs_sold_date_sk") <= cut),
            r.web_sales().filter(F.col("ws_sold_date_sk") <= cut))


@register("daily_watermark")
def q_daily_watermark(spark, sf_dir):
    return watermark_frame(daily_table(raw(spark, sf_dir)), "sold_date_sk", "last_sold_date_sk")


@register("daily_sales_incremental")
def q_daily_sales_incremental(spark, sf_dir):
    r = raw(spark, sf_dir)
    cs1, ws1 = raw_until(r, split_day(r))
    existing = checkpointed(ds.daily_sales(cs1, ws1, r.date_dim()))
    return for_report(inc.daily_incremental(existing, r.catalog_sales(), r.web_sales(), r.date_dim()).table)


@register("weekly_sales_inventory_incremental")
def q_weekly_sales_inventory_incremental(spark, sf_dir):
    r = raw(spark, sf_dir)
    cs1, ws1 = raw_until(r, split_day(r))
    existing = checkpointed(wi.weekly_sales_inventory_from_feed(cs1, ws1, r.inventory(), r.date_dim()))
    return for_report(inc.weekly_incremental(existing, daily_table(r), r.inventory(), r.date_dim()).table)


# ------------------------------------------------------------------ monthly


def snapshot_after(r: RawTables, batches: int = 3, mode: str = "reference"):
    """Snapshot after ``batches`` daily runs. Each run's snapshot feeds the
    next one twice (anti join and union), so lineage is cut after every run
    by a checkpoint to the shared folder, as the pipeline does by writing a
    version -- the plan stays linear in the number of runs."""
    key = ("snapshot", batches, mode)
    if key not in r._cache:
        snap = scd.empty_snapshot(r.spark)
        for b in range(1, batches + 1):
            snap = scd.scd2_apply(snap, r.customer(b), CUSTOMER_BATCH_DATES[b - 1], mode)
            if b < batches:
                snap = checkpointed(snap)
        r._cache[key] = snap
    return r._cache[key]


def program(r: RawTables, cut: int | None = None, mode: str = "reference"):
    """The monthly run as of the data up to ``cut`` (all data when None)."""
    cs, ws = r.catalog_sales(), r.web_sales()
    ccs, cws = r.catalog_sales(with_customer=True), r.web_sales(with_customer=True)
    if cut is not None:
        cs, ws = cs.filter(F.col("cs_sold_date_sk") <= cut), ws.filter(F.col("ws_sold_date_sk") <= cut)
        ccs, cws = ccs.filter(F.col("cs_sold_date_sk") <= cut), cws.filter(F.col("ws_sold_date_sk") <= cut)
    # max(sold_date_sk) of the daily table built from this feed: every day
    # that passes the feed filter forms a daily group, so the feed's max is
    # the same value without aggregating the daily table first
    wm = period_watermark(ds.unified_sales(cs, ws), "sold_date_sk")
    yr, mth = target_period(r.date_dim(), wm)
    return cp.monthly_customer_program(ccs, cws, r.date_dim(), snapshot_after(r), yr, mth, mode)


@register("monthly_target_period")
def q_monthly_target_period(spark, sf_dir):
    r = raw(spark, sf_dir)
    feed = ds.unified_sales(r.catalog_sales(), r.web_sales())  # its last day is the daily table's
    return target_period_frame(r.date_dim(), period_watermark(feed, "sold_date_sk"))


@register("customer_sales")
def q_customer_sales(spark, sf_dir):
    r = raw(spark, sf_dir)
    return for_report(cp.customer_sales(r.catalog_sales(with_customer=True), r.web_sales(with_customer=True)))


@register("monthly_customer_metrics")
def q_monthly_customer_metrics(spark, sf_dir):
    r = raw(spark, sf_dir)
    return for_report(cp.monthly_customer_metrics(
        r.catalog_sales(with_customer=True), r.web_sales(with_customer=True), r.date_dim()))


@register("membership_tiers")
def q_membership_tiers(spark, sf_dir):
    """Tier of every customer in every year they bought (running yearly spend)."""
    from retail_mart.functions.program import membership_tier
    r = raw(spark, sf_dir)
    m = cp.monthly_customer_metrics(r.catalog_sales(with_customer=True), r.web_sales(with_customer=True),
                                    r.date_dim())
    return (m.select("customer_sk", "c_year", membership_tier(F.col("sum_amt_yr")).alias("membership_status"))
            .distinct())


@register("monthly_customer_program")
def q_monthly_customer_program(spark, sf_dir):
    r = raw(spark, sf_dir)
    return for_report(program(r))


@register("monthly_customer_program_documented")
def q_monthly_customer_program_documented(spark, sf_dir):
    r = raw(spark, sf_dir)
    return for_report(program(r, mode="documented"))


MONTHLY_LAG_DAYS = 60


@register("monthly_customer_program_incremental")
def q_monthly_customer_program_incremental(spark, sf_dir):
    """Programme as loaded by a run 60 days before the last sale, then the
    latest run applied on top (delete target month, insert)."""
    r = raw(spark, sf_dir)
    existing = program(r, cut=sales_span(r)[1] - MONTHLY_LAG_DAYS)
    cs, ws = r.catalog_sales(with_customer=True), r.web_sales(with_customer=True)
    feed = ds.unified_sales(r.catalog_sales(), r.web_sales())  # its last day is the daily table's
    res = inc.monthly_incremental(existing, feed, cs, ws, r.date_dim(), snapshot_after(r))
    return for_report(res.table)


# ------------------------------------------------------------------- SCD-2
@register("scd2_new_versions")
def q_scd2_new_versions(spark, sf_dir):
    r = raw(spark, sf_dir)
    return for_report(scd.scd2_new_versions(snapshot_after(r, 2), r.customer(3), CUSTOMER_BATCH_DATES[2]))


@register("scd2_closed")
def q_scd2_closed(spark, sf_dir):
    r = raw(spark, sf_dir)
    snap = snapshot_after(r, 3)
    return for_report(snap.filter(F.col("end_date") == F.lit(CUSTOMER_BATCH_DATES[2]).cast("timestamp_ntz")))


@register("scd2_snapshot")
def q_scd2_snapshot(spark, sf_dir):
    return for_report(snapshot_after(raw(spark, sf_dir), 3, "reference"))


@register("scd2_snapshot_strict")
def q_scd2_snapshot_strict(spark, sf_dir):
    return for_report(snapshot_after(raw(spark, sf_dir), 3, "strict"))


def customer_dim_table(r: RawTables):
    return scd.customer_dim(snapshot_after(r, 3), r.customer_address(), r.customer_demographics(),
                            r.household_demographics(), r.income_band())


@register("customer_dim")
def q_customer_dim(spark, sf_dir):
    return for_report(customer_dim_table(raw(spark, sf_dir)))


@register("customer_demographics")
def q_customer_demographics(spark, sf_dir):
    return rp.demographics_summary(customer_dim_table(raw(spark, sf_dir)))


# ------------------------------------------------- scheduled runs with real writes
def raw_inputs(r: RawTables, batch: int, cut: int | None = None, steps: tuple[str, ...] = ()) -> pl.RawInputs:
    """The raw layer as one run sees it: sales up to ``cut`` and a customer batch.

    What ``steps`` read again and again is stored once per ``r``, as a raw
    layer is: their runs scan it, and its joins are not repeated by each pass."""
    def feed(name: str, build, *readers: str) -> DataFrame:
        return r._memo(f"stored {name}", lambda: checkpointed(build())) if set(readers) & set(steps) else build()

    cs = feed("catalog_sales", lambda: r.catalog_sales(with_customer=True), "daily", "monthly")
    ws = feed("web_sales", lambda: r.web_sales(with_customer=True), "daily", "monthly")
    if cut is not None:
        cs, ws = cs.filter(F.col("cs_sold_date_sk") <= cut), ws.filter(F.col("ws_sold_date_sk") <= cut)
    return pl.RawInputs(cs, ws, feed("inventory", r.inventory, "weekly"), r.date_dim(), r.customer(batch), r.customer_address(),
                        r.customer_demographics(), r.household_demographics(), r.income_band())


def mart_runs(spark, sf_dir, *steps: str) -> pl.MartPaths:
    """The named steps of two scheduled runs in a fresh folder: half of the
    sales span, then all of it with the next customer batch."""
    r, paths = raw(spark, sf_dir), pl.MartPaths(new_run_dir(spark, "mart"))
    for batch, cut in ((1, split_day(r)), (2, None)):
        inputs = raw_inputs(r, batch, cut, steps)
        for step in steps:
            args = [CUSTOMER_BATCH_DATES[batch - 1]] if step == "customer" else []
            getattr(pl, f"run_{step}")(spark, inputs, paths, *args)
    return paths


@register("mart_runs_weekly")
def q_mart_runs_weekly(spark, sf_dir):
    """Two runs of the daily and the weekly task; the stored weekly fact."""
    paths = mart_runs(spark, sf_dir, "daily", "weekly")
    return for_report(pl.read_weekly(spark, paths).select(*wi.WEEKLY_COLUMNS))


@register("mart_runs_customer_dim")
def q_mart_runs_customer_dim(spark, sf_dir):
    """Two runs of the customer task; the current version of the dimension."""
    return for_report(pl.read_customer_dim(spark, mart_runs(spark, sf_dir, "customer")))


def stored_history(spark, sf_dir, mode: str = "reference", batches: int = 3) -> tuple[RawTables, pl.MartPaths]:
    """The history in buckets after the runs of all customer batches; the
    dimension refreshed after each, from joined tables that still differ before the last."""
    r, paths = raw(spark, sf_dir), pl.MartPaths(new_run_dir(spark, "mart"))
    for b in range(1, batches + 1):
        pl.customer_history(spark, paths).merge(r.customer(b), CUSTOMER_BATCH_DATES[b - 1], mode)
        early = b < batches
        edit = lambda df, col, key: df.withColumn(col, F.when(F.col(key) % 50 == 7, F.concat(F.lit("old "), col)).otherwise(F.col(col))) if early else df  # noqa: B023,E731
        pl.customer_dimension(spark, paths).refresh(
            pl.customer_history(spark, paths), edit(r.customer_address(), "ca_city", "ca_address_sk"),
            edit(r.customer_demographics(), "cd_credit_rating", "cd_demo_sk"), r.household_demographics(), r.income_band())
    return r, paths


@register("customer_history_in_buckets")
def q_customer_history_in_buckets(spark, sf_dir):
    return for_report(pl.read_snapshot(spark, stored_history(spark, sf_dir)[1]))


@register("customer_history_in_buckets_strict")
def q_customer_history_in_buckets_strict(spark, sf_dir):
    return for_report(pl.read_snapshot(spark, stored_history(spark, sf_dir, "strict")[1]))


@register("customer_dim_by_delta")
def q_customer_dim_by_delta(spark, sf_dir):
    return for_report(pl.read_customer_dim(spark, stored_history(spark, sf_dir)[1]))


@register("mart_runs_monthly")
def q_mart_runs_monthly(spark, sf_dir):
    """Two runs of the daily, customer and monthly tasks; the stored programme."""
    paths = mart_runs(spark, sf_dir, "daily", "customer", "monthly")
    return for_report(pl.read_monthly(spark, paths).select(*cp.PROGRAM_COLUMNS))


@register("stored_daily_watermark")
def q_stored_daily_watermark(spark, sf_dir):
    """P1 as the scheduled tasks take it: from the stored daily table's periods, without reading rows."""
    wm = pl.daily_table(spark, mart_runs(spark, sf_dir, "daily")).watermark()
    return spark.range(1).select(F.lit(wm).cast("bigint").alias("last_sold_date_sk"))


def early_inputs(r: RawTables, steps: tuple[str, ...] = ()) -> pl.RawInputs:
    """The raw layer before half of the sales span is over, when some sales
    have yet to arrive and some stock counts will be restated."""
    full = raw_inputs(r, 1, split_day(r), steps)
    n = F.col("inv_quantity_on_hand")
    stock = full.inventory.withColumn("inv_quantity_on_hand", F.when(F.col("inv_item_sk") % 5 == 0, n + 3).otherwise(n).cast("int"))
    return pl.RawInputs(full.catalog_sales.filter(F.col("cs_item_sk") % 7 != 3), full.web_sales.filter(F.col("ws_item_sk") % 7 != 4),
                        stock, *[getattr(full, f) for f in list(pl.RawInputs.__dataclass_fields__)[3:]])


def repaired_runs(spark, sf_dir, *steps: str) -> pl.MartPaths:
    """An early run, a scheduled run and a repairing run of the named steps."""
    r, paths = raw(spark, sf_dir), pl.MartPaths(new_run_dir(spark, "mart"))
    late = raw_inputs(r, 1, steps=steps)
    for inputs, repair in ((early_inputs(r, steps), False), (late, False), (late, True)):
        for step in steps:
            getattr(pl, f"run_{step}")(spark, inputs, paths, repair=repair)
    return paths


@register("mart_runs_repaired_daily")
def q_mart_runs_repaired_daily(spark, sf_dir):
    """Late sales reach the stored daily table by a repairing run."""
    return for_report(pl.read_daily(spark, repaired_runs(spark, sf_dir, "daily")).select(*ds.DAILY_COLUMNS))


@register("mart_runs_repaired_weekly")
def q_mart_runs_repaired_weekly(spark, sf_dir):
    """Late sales and restated stock reach the stored weekly fact by a repairing run."""
    return for_report(pl.read_weekly(spark, repaired_runs(spark, sf_dir, "daily", "weekly")).select(*wi.WEEKLY_COLUMNS))


def customer_months_table(spark, sf_dir) -> tuple[RawTables, PeriodTable]:
    """The stored customer months after an early run and one with all sales."""
    r = raw(spark, sf_dir)
    table = pl.months_table(spark, pl.MartPaths(new_run_dir(spark, "mart")))
    for x in (early_inputs(r, ("monthly",)), raw_inputs(r, 1, steps=("monthly",))):
        cm.refresh(table, x.catalog_sales, x.web_sales, x.date_dim)
    return r, table


@register("monthly_customer_metrics_from_state")
def q_monthly_customer_metrics_from_state(spark, sf_dir):
    return for_report(cp.metrics_of_months(customer_months_table(spark, sf_dir)[1].read()))


def program_from_state(spark, sf_dir, mode: str = "reference"):
    r, table = customer_months_table(spark, sf_dir)
    yr, mth = target_period(r.date_dim(), period_watermark(ds.unified_sales(r.catalog_sales(), r.web_sales()), "sold_date_sk"))
    return cp.program_of_months(table.read(), snapshot_after(r), yr, mth, mode)


@register("monthly_customer_program_from_state")
def q_monthly_customer_program_from_state(spark, sf_dir):
    return for_report(program_from_state(spark, sf_dir))


@register("monthly_customer_program_documented_from_state")
def q_monthly_customer_program_documented_from_state(spark, sf_dir):
    return for_report(program_from_state(spark, sf_dir, "documented"))


# --------------------------------------------------------------- profiling

LOOKUP_DAY = "1998-01-01"


@register("calendar_head")
def q_calendar_head(spark, sf_dir):
    return for_report(pf.calendar_head(raw(spark, sf_dir).date_dim()))


@register("calendar_lookup")
def q_calendar_lookup(spark, sf_dir):
    return for_report(pf.calendar_lookup(raw(spark, sf_dir).date_dim(), LOOKUP_DAY))


@register("date_range_catalog")
def q_date_range_catalog(spark, sf_dir):
    r = raw(spark, sf_dir)
    return for_report(pf.date_range(r.catalog_sales(), "cs_sold_date_sk", r.date_dim()))


@register("date_range_web")
def q_date_range_web(spark, sf_dir):
    r = raw(spark, sf_dir)
    return for_report(pf.date_range(r.web_sales(), "ws_sold_date_sk", r.date_dim()))


@register("date_range_inventory")
def q_date_range_inventory(spark, sf_dir):
    r = raw(spark, sf_dir)
    return for_report(pf.date_range(r.inventory(), "inv_date_sk", r.date_dim()))


@register("arrival_rate_catalog")
def q_arrival_rate_catalog(spark, sf_dir):
    r = raw(spark, sf_dir)
    return for_report(pf.arrival_rate(r.catalog_sales(), "cs_sold_date_sk", r.date_dim()))


@register("arrival_rate_web")
def q_arrival_rate_web(spark, sf_dir):
    r = raw(spark, sf_dir)
    return for_report(pf.arrival_rate(r.web_sales(), "ws_sold_date_sk", r.date_dim()))


@register("sample_catalog")
def q_sample_catalog(spark, sf_dir):
    return for_report(pf.ordered_sample(raw(spark, sf_dir).catalog_sales(extra_keys=True)))


@register("sample_web")
def q_sample_web(spark, sf_dir):
    return for_report(pf.ordered_sample(raw(spark, sf_dir).web_sales(extra_keys=True)))


def fk_inputs(r: RawTables):
    facts = {"catalog_sales": r.catalog_sales(extra_keys=True), "web_sales": r.web_sales(extra_keys=True)}
    dims = {"date_dim": r.date_dim(), "customer": r.customer(1),
            "customer_demographics": r.customer_demographics(),
            "household_demographics": r.household_demographics(),
            "customer_address": r.customer_address(), "warehouse": r.warehouse(), "item": r.item()}
    for name in ("time_dim", "call_center", "catalog_page", "ship_mode", "promotion", "web_page", "web_site"):
        dims[name] = r.key_dim(name)
    return facts, dims


@register("fk_coverage")
def q_fk_coverage(spark, sf_dir):
    return pf.fk_coverage(*fk_inputs(raw(spark, sf_dir)))


@register("fk_sample")
def q_fk_sample(spark, sf_dir):
    return pf.fk_sample(*fk_inputs(raw(spark, sf_dir)))


@register("inventory_recurrence")
def q_inventory_recurrence(spark, sf_dir):
    return pf.inventory_recurrence(raw(spark, sf_dir).inventory())


@register("item_inventory_dates")
def q_item_inventory_dates(spark, sf_dir):
    r = raw(spark, sf_dir)
    return for_report(pf.item_dates(r.inventory(), "inv_item_sk", "inv_date_sk", r.date_dim()))


@register("item_web_dates")
def q_item_web_dates(spark, sf_dir):
    r = raw(spark, sf_dir)
    return for_report(pf.item_dates(r.web_sales(), "ws_item_sk", "ws_sold_date_sk", r.date_dim(), r.item()))


@register("item_catalog_dates")
def q_item_catalog_dates(spark, sf_dir):
    r = raw(spark, sf_dir)
    return for_report(pf.item_dates(r.catalog_sales(), "cs_item_sk", "cs_sold_date_sk", r.date_dim(), r.item()))


@register("distinct_items")
def q_distinct_items(spark, sf_dir):
    return pf.distinct_items(raw(spark, sf_dir).item())


@register("count_items")
def q_count_items(spark, sf_dir):
    return pf.count_distinct(raw(spark, sf_dir).item(), "i_item_sk", "items")


@register("distinct_customers")
def q_distinct_customers(spark, sf_dir):
    return pf.distinct_customers(raw(spark, sf_dir).customer(1))


@register("count_customers")
def q_count_customers(spark, sf_dir):
    return pf.count_distinct(raw(spark, sf_dir).customer(1), "c_customer_sk", "customers")


@register("null_profile")
def q_null_profile(spark, sf_dir):
    r = raw(spark, sf_dir)
    out = pf.null_profile(r.catalog_sales(extra_keys=True), "catalog_sales")
    for df, name in [(r.web_sales(extra_keys=True), "web_sales"), (r.customer(1), "customer"),
                     (r.inventory(), "inventory")]:
        out = out.unionByName(pf.null_profile(df, name))
    return out


# --------------------------------------------------------------- ingestion
def _inventory_file(spark, sf_dir) -> str:
    return ingest.write_inventory_csv(raw(spark, sf_dir).inventory(), new_run_dir(spark, "inventory-csv"))


@register("ingest_inventory")
def q_ingest_inventory(spark, sf_dir):
    return ingest.load_inventory(spark, _inventory_file(spark, sf_dir))[0]


@register("ingest_inventory_rejects")
def q_ingest_inventory_rejects(spark, sf_dir):
    return ingest.load_inventory(spark, _inventory_file(spark, sf_dir))[1]


def _copied(spark, df, name):
    path = ingest.copy_table(df, new_run_dir(spark, name))
    return spark.read.parquet(path)


@register("item_dim")
def q_item_dim(spark, sf_dir):
    return _copied(spark, raw(spark, sf_dir).item(), "item_dim")


@register("warehouse_dim")
def q_warehouse_dim(spark, sf_dir):
    return _copied(spark, raw(spark, sf_dir).warehouse(), "warehouse_dim")


@register("date_dim")
def q_date_dim(spark, sf_dir):
    return for_report(_copied(spark, raw(spark, sf_dir).date_dim(), "date_dim"))
