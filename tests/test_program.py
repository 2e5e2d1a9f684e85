"""Monthly programme: tiers on real data, window form = aggregate form."""

from pyspark.sql import functions as F

from retail_mart.operators import customer_program as cp
from retail_mart.operators import customer_scd2 as scd
from retail_mart.sources.fixtures import RawTables
from tests.conftest import SF_MID
from tests.helpers import frame_rows


def test_diamond_month_matches_fixture_notes(spark):
    """FIXTURES: all sales, month 2000-06 -> 229 Diamond customers (of 511
    buyers that month; both counts also from the DuckDB oracle)."""
    r = RawTables(spark, SF_MID)
    snap = scd.scd2_apply(scd.empty_snapshot(spark), r.customer(1), "2001-01-01")
    out = cp.monthly_customer_program(r.catalog_sales(with_customer=True), r.web_sales(with_customer=True),
                                      r.date_dim(), snap, 2000, 6)
    assert out.count() == 511
    assert out.filter(F.col("membership_status") == "Diamond").count() == 229


def test_program_equals_window_metrics_at_target(spark, raw_small):
    """The one-pass conditional aggregation equals the reference's windows
    read at the target month."""
    r = raw_small
    cs, ws = r.catalog_sales(with_customer=True), r.web_sales(with_customer=True)
    snap = scd.empty_snapshot(spark)
    m = cp.monthly_customer_metrics(cs, ws, r.date_dim()).filter("c_year = 1998 AND c_month = 7")
    p = cp.monthly_customer_program(cs, ws, r.date_dim(), snap, 1998, 7)
    cols = ["customer_sk", "sum_qty_mth", "avg_qty_yr", "avg_amt_yr"]
    assert frame_rows(p.select(*cols)) == frame_rows(m.select(*cols))
    assert p.count() > 0
