"""Period watermarks (P1) and the monthly target period (P10).

A watermark is one value aggregated on the executors and collected to the
driver, then used as a literal so it can prune files on stored tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def watermark_frame(table: DataFrame, col: str, alias: str = "watermark") -> DataFrame:
    """max(col) of the target table, 0 when the table is empty (NVL)."""
    return table.agg(F.coalesce(F.max(col), F.lit(0)).cast("bigint").alias(alias))


def period_watermark(table: DataFrame, col: str) -> int:
    return int(watermark_frame(table, col).first()[0])


def target_period_frame(date_dim: DataFrame, watermark: int) -> DataFrame:
    """(year, month) of the first calendar day on/after the watermark.

    Year first, then the smallest month of that year on/after the watermark;
    NULL (no such day) becomes 0, which selects nothing downstream.
    """
    # min over (year, month) structs = smallest year, then its smallest month
    first = (date_dim.filter(F.col("d_date_sk") >= F.lit(int(watermark)))
             .agg(F.min(F.struct("yr_num", "mnth_num")).alias("p")))
    return first.select(F.coalesce(F.col("p.yr_num"), F.lit(0)).cast("bigint").alias("last_yr"),
                        F.coalesce(F.col("p.mnth_num"), F.lit(0)).cast("bigint").alias("last_mth"))


def target_period(date_dim: DataFrame, watermark: int) -> tuple[int, int]:
    row = target_period_frame(date_dim, watermark).first()
    return int(row[0]), int(row[1])
