"""Stored customer-month state of the monthly programme.

The reference's monthly task reads the whole sales history on every run,
because its totals run since the first purchase. Here the totals per
(customer, year, month) are a stored table, kept by month, with a fingerprint
of each sold day beside it. A run reads again only the months with a day
that came, went or changed -- late rows and restated days included -- and
takes the running totals from the table, which then equals the aggregate of
the whole history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_mart.operators import customer_program as cp
from retail_mart.sources.periods import PeriodTable
from retail_mart.streaming import fingerprints as fp

MONTH = ["c_year", "c_month"]


def day_marks(catalog_sales: DataFrame, web_sales: DataFrame, by_files: bool = False) -> dict[int, str]:
    """Fingerprint of each sold day of the customer feed."""
    if by_files:
        return fp.marks(fp.of_files(catalog_sales, "cs_sold_date_sk"), fp.of_files(web_sales, "ws_sold_date_sk"))
    return fp.marks(fp.of_rows(cp.customer_sales(catalog_sales, web_sales), "sold_date_sk"))


def refresh(table: PeriodTable, catalog_sales: DataFrame, web_sales: DataFrame, date_dim: DataFrame,
            by_files: bool = False) -> list[tuple[int, int]]:
    """Bring the stored totals up to date; the months that were read again.

    A day counts for the month the calendar gives it, so a renumbered day
    changes its old and its new month; days outside the calendar count for
    none, as in the programme."""
    base = table.state()
    days = {r.d: (r.y, r.m) for r in date_dim.select(F.col("d_date_sk").alias("d"), F.col("yr_num").alias("y"), F.col("mnth_num").alias("m")).collect()}
    now = {d: f"{days[d][0]}-{days[d][1]}|{mark}" for d, mark in day_marks(catalog_sales, web_sales, by_files).items() if d in days}
    before = base.notes.get("days", {})
    month = lambda text: tuple(int(x) for x in text.partition("|")[0].split("-"))
    dirty = {month(m) for d in fp.changed(now, before) for m in (now.get(d), before.get(str(d))) if m}
    if not dirty and base.schema is not None:
        return []
    again = [d for d, m in days.items() if m in dirty]
    spans = fp.ranges(set(again), list(days))
    fresh = month_rows(catalog_sales, web_sales, date_dim, spans)
    table.replace(fresh, [dict(zip(MONTH, m, strict=True)) for m in dirty], ["customer_sk"], {"days": {str(d): m for d, m in now.items()}}, base)
    return sorted(dirty)


def month_rows(catalog_sales: DataFrame, web_sales: DataFrame, date_dim: DataFrame, spans: list[tuple[int, int]]) -> DataFrame:
    """``month_totals`` of the days in ``spans``; the ranges reach the fact scans."""
    return cp.month_totals(catalog_sales.filter(fp.within("cs_sold_date_sk", spans)),
                           web_sales.filter(fp.within("ws_sold_date_sk", spans)), date_dim)
