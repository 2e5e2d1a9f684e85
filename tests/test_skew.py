"""Hot keys: a third of the rows sharing one key must not land on one task."""

from pyspark.sql import functions as F

from retail_mart.operators.common import left_join_spread_nulls


def test_null_join_keys_spread_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        n = 30000
        left = spark.range(n).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(None))
                                     .otherwise(F.col("id") % 100).alias("k"))
        right = spark.range(100).select(F.col("id").alias("pk"), (F.col("id") * 2).alias("v"))
        j = left_join_spread_nulls(left, right, "k", "pk")
        p = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [__jk" in p        # one composite key, NULL rows salted
        per_part = (j.filter(F.col("k").isNull()).groupBy(F.spark_partition_id().alias("p")).count()
                    .collect())
        assert len(per_part) > 1                       # NULL keys are not on one task
        assert max(r["count"] for r in per_part) < n / 3
        assert j.count() == n
        assert j.filter(F.col("k").isNull() & F.col("v").isNotNull()).count() == 0
        assert j.filter(F.col("k").isNotNull() & (F.col("v") != F.col("k") * 2)).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_key_aggregates_partially_before_the_shuffle(spark, raw_small):
    """Daily aggregate: the partial aggregate sits below the exchange, so a
    hot (warehouse, item, day) leaves each map task as one row."""
    from retail_mart.operators import daily_sales as ds
    r = raw_small
    hot = r.catalog_sales().withColumn("cs_item_sk", F.lit(1).cast("bigint"))
    df = ds.daily_sales(hot, r.web_sales(), r.date_dim())
    p = df._jdf.queryExecution().executedPlan().toString()
    below = p.split("Exchange hashpartitioning(warehouse_sk")[1]
    assert "partial_sum" in below
