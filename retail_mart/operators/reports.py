"""BI result sets over the weekly fact (B1-B6) and the customer dimension.

Top/bottom lists: items summed over warehouses per (year, week), ranked by
the metric with item_sk as tie-breaker, first N kept. The per-week ranking is
a window over at most (#items) rows per week; Spark inserts a per-partition
group limit below the shuffle for ``row_number() <= N`` filters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TOP_N = 10
WEEK = ["sold_yr_num", "sold_wk_num"]


def item_weeks(weekly: DataFrame) -> DataFrame:
    return weekly.groupBy(*WEEK, "item_sk").agg(
        F.sum("sum_amt_wk").alias("sales_amt"), F.sum("sum_qty_wk").alias("sales_qty"))


def ranked_items(weekly: DataFrame, metric: str, top: bool = True, n: int = TOP_N) -> DataFrame:
    """Top (or bottom) ``n`` items per week by ``metric`` ('sales_amt' or 'sales_qty')."""
    order = F.col(metric).desc() if top else F.col(metric).asc()
    w = Window.partitionBy(*WEEK).orderBy(order, F.col("item_sk").asc())
    return (item_weeks(weekly).withColumn("item_rank", F.row_number().over(w))
            .filter(F.col("item_rank") <= n)
            .select(*WEEK, F.col("item_rank").cast("bigint").alias("item_rank"), "item_sk", F.col(metric)))


def low_inventory_items(weekly: DataFrame) -> DataFrame:
    """Items flagged low on stock in a week, with how many warehouses."""
    return (weekly.filter(F.col("low_stock_flg_wk"))
            .groupBy(*WEEK, "item_sk")
            .agg(F.count(F.lit(1)).alias("low_stock_warehouses"),
                 F.sum("sum_qty_wk").alias("sum_qty_wk"),
                 F.sum("inv_qty_wk").alias("inv_qty_wk")))


def low_stock_by_warehouse(weekly: DataFrame) -> DataFrame:
    """Every low-stock (week, warehouse, item) with its stock figures."""
    return (weekly.filter(F.col("low_stock_flg_wk"))
            .select(*WEEK, "sold_wk_sk", "warehouse_sk", "item_sk", "avg_qty_dy",
                    "inv_qty_wk", "wks_sply"))


def demographics_summary(customer_dim: DataFrame, by=("cd_gender", "cd_marital_status")) -> DataFrame:
    """Number of current customers per demographic group."""
    return customer_dim.groupBy(*by).agg(F.count(F.lit(1)).alias("customers"))
