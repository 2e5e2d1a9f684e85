"""Incremental loads as pure functions: (existing target, raw) -> new state.

Each returns the target's new contents and the replaced slice, so a sink can
either rewrite the whole table or replace only the touched periods
(sources.periods). Equals a full recompute when no row arrives late; late
rows (before the watermark) are ignored, as in the reference. A caller whose
target is stored passes the watermark its periods give; else it is the
maximum over the target.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_mart.operators import customer_program as cp
from retail_mart.operators import daily_sales as ds
from retail_mart.operators import weekly_inventory as wi
from retail_mart.streaming.watermark import period_watermark, target_period


@dataclass
class Increment:
    table: DataFrame      # full new contents of the target
    fresh: DataFrame      # recomputed slice (to append / overwrite)
    watermark: int        # period that was deleted and recomputed
    kept: DataFrame       # existing rows that stay
    deleted: dict         # partition (column -> value) deleted before the insert


def _delete(existing: DataFrame, cond) -> DataFrame:
    """DELETE ... WHERE cond keeps rows where cond is false or NULL."""
    return existing.filter(~F.coalesce(cond, F.lit(False)))


def daily_incremental(existing: DataFrame, catalog_sales: DataFrame, web_sales: DataFrame,
                      date_dim: DataFrame, watermark: int | None = None) -> Increment:
    """Delete the last loaded day, recompute from it on."""
    wm = period_watermark(existing, "sold_date_sk") if watermark is None else watermark
    kept = _delete(existing, F.col("sold_date_sk") == F.lit(wm))
    fresh = ds.daily_sales(catalog_sales, web_sales, date_dim, since_sk=wm)
    return Increment(kept.unionByName(fresh), fresh, wm, kept, {"sold_date_sk": wm})


def weekly_incremental(existing: DataFrame, daily: DataFrame, inventory: DataFrame,
                       date_dim: DataFrame, mode: str = "reference", watermark: int | None = None) -> Increment:
    """Delete the last loaded week, recompute weeks whose first sale
    (mode="strict": whose day 0) is on/after its start."""
    wm = period_watermark(existing, "sold_wk_sk") if watermark is None else watermark
    kept = _delete(existing, F.col("sold_wk_sk") == F.lit(wm))
    fresh = wi.weekly_sales_inventory(daily, inventory, date_dim, since_wk_sk=wm, mode=mode)
    return Increment(kept.unionByName(fresh), fresh, wm, kept, {"sold_wk_sk": wm})


def monthly_incremental(existing: DataFrame, daily: DataFrame, catalog_sales: DataFrame,
                        web_sales: DataFrame, date_dim: DataFrame, snapshot: DataFrame,
                        mode: str = "reference") -> Increment:
    """The target month follows the daily table's watermark; delete that
    month from the programme, then insert it recomputed."""
    wm = period_watermark(daily, "sold_date_sk")
    yr, mth = target_period(date_dim, wm)
    kept = _delete(existing, (F.col("c_year") == F.lit(yr)) & (F.col("c_month") == F.lit(mth)))
    fresh = cp.monthly_customer_program(catalog_sales, web_sales, date_dim, snapshot, yr, mth, mode)
    return Increment(kept.unionByName(fresh), fresh, wm, kept, {"c_year": yr, "c_month": mth})
