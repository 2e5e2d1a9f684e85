"""Inventory CSV ingestion (S1), relational reads (S3) and table copies.

S1 follows the reference loader's contract: a positional 4-column CSV, rows
that do not parse are skipped (``on_error='continue'``), and the three key
columns are NOT NULL. Here the skipped rows are not lost: they come back as a
rejects DataFrame with the raw line and the reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column order of the inventory file (= the raw table's DDL order).
INVENTORY_SCHEMA = T.StructType([
    T.StructField("inv_date_sk", T.IntegerType()),
    T.StructField("inv_item_sk", T.IntegerType()),
    T.StructField("inv_quantity_on_hand", T.IntegerType()),
    T.StructField("inv_warehouse_sk", T.IntegerType()),
])
INVENTORY_KEYS = ["inv_date_sk", "inv_item_sk", "inv_warehouse_sk"]
_BAD = "_corrupt_record"


def inventory_read_schema() -> T.StructType:
    """The file's columns plus the corrupt-record column PERMISSIVE fills."""
    return T.StructType(INVENTORY_SCHEMA.fields + [T.StructField(_BAD, T.StringType())])


CSV_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD, "header": "false",
               "enforceSchema": "true"}


def split_inventory(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows) of a parsed inventory file."""
    keys_ok = F.col(INVENTORY_KEYS[0]).isNotNull()
    for k in INVENTORY_KEYS[1:]:
        keys_ok = keys_ok & F.col(k).isNotNull()
    ok = F.col(_BAD).isNull() & keys_ok
    good = parsed.filter(ok).select(*INVENTORY_SCHEMA.names)
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in INVENTORY_SCHEMA.names])
    rejects = parsed.filter(~ok).select(
        F.coalesce(F.col(_BAD), line).alias("raw_line"),
        F.when(F.col(_BAD).isNotNull(), F.lit("malformed")).otherwise(F.lit("null key")).alias("reason"))
    return good, rejects


def load_inventory(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Read the inventory CSV; return (good rows, rejected rows).

    Short, long and mistyped lines are caught by PERMISSIVE parsing into the
    corrupt-record column; rows with a NULL key violate the NOT NULL columns.
    """
    parsed = spark.read.schema(inventory_read_schema()).options(**CSV_OPTIONS).csv(path)
    return split_inventory(parsed)


def inventory_csv_lines(inventory: DataFrame) -> DataFrame:
    """Render inventory rows as CSV lines, with a data-derived share of
    faulty lines (short, long, non-numeric, empty key) so the loader's
    reject path is exercised at every scale."""
    h = (F.col("inv_date_sk") + F.col("inv_item_sk") * 7 + F.col("inv_warehouse_sk") * 3) % 1000
    d, i, q, w = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in INVENTORY_SCHEMA.names]
    line = (F.when(h == 1, F.concat_ws(",", d, i, q))
            .when(h == 2, F.concat_ws(",", d, i, q, w, F.lit("9")))
            .when(h == 3, F.concat_ws(",", d, F.concat(F.lit("x"), i), q, w))
            .when(h == 4, F.concat_ws(",", F.lit(""), i, q, w))
            .otherwise(F.concat_ws(",", d, i, q, w)))
    return inventory.select(line.alias("value"))


def write_inventory_csv(inventory: DataFrame, path: str) -> str:
    inventory_csv_lines(inventory).write.mode("errorifexists").text(path)
    return path


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """S3: relational source read. Parquet here; ``fmt='jdbc'`` with
    partitionColumn/lowerBound/upperBound/numPartitions in production."""
    return spark.read.format(fmt).options(**options).load(path) if fmt != "jdbc" else \
        spark.read.format("jdbc").options(**options).load()


def copy_table(df: DataFrame, path: str) -> str:
    """Materialise a copy of a dimension (the reference's clone)."""
    df.write.mode("errorifexists").parquet(path)
    return path
