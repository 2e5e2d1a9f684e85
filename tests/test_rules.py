"""Programme rules and money arithmetic at their boundaries."""

from decimal import Decimal

from pyspark.sql import functions as F

from retail_mart.functions.money import ratio6, whole_units
from retail_mart.functions.program import membership_tier, promotion_flag


def test_tier_boundaries(spark):
    vals = ["25000", "25000.01", "50000", "50000.01", "100000", "100000.01", "200000", "200000.01", "0"]
    df = spark.createDataFrame([(Decimal(v),) for v in vals], "a decimal(38,2)")
    got = [r[0] for r in df.select(membership_tier(F.col("a"))).collect()]
    assert got == ["Blue", "Silver", "Silver", "Gold", "Gold", "Platinum", "Platinum", "Diamond", "Blue"]


def test_promotion_boundary(spark):
    df = spark.createDataFrame([(Decimal("99999.99"),), (Decimal("100000"),), (None,)], "a decimal(38,2)")
    assert [r[0] for r in df.select(promotion_flag(F.col("a"))).collect()] == [False, True, False]


def test_ratio_half_up_and_zero_division(spark):
    df = spark.createDataFrame([(1, 8), (5, 7), (2, 3), (1, 0), (-1, 8)], "n long, d long")
    got = [r[0] for r in df.select(ratio6(F.col("n"), F.col("d"))).collect()]
    assert got == [Decimal("0.125000"), Decimal("0.714286"), Decimal("0.666667"), None, Decimal("-0.125000")]


def test_whole_units_half_up(spark):
    df = spark.createDataFrame([(Decimal("10.49"),), (Decimal("10.50"),), (Decimal("0.50"),)], "a decimal(38,2)")
    assert [r[0] for r in df.select(whole_units(F.col("a"))).collect()] == [10, 11, 1]


def test_cluster_conf_scales_with_input():
    from retail_mart.session import cluster_conf
    small = cluster_conf(40 << 20, 8)
    big = cluster_conf(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    known = cluster_conf(100 << 40, 8000, shuffle_bytes=5 << 40)
    assert int(known["spark.sql.shuffle.partitions"]) == (5 << 40) // (256 << 20)
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 256 << 20
