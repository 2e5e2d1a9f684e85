"""Data profiling (E1-E19), re-aimed from the exploration script.

The script's unordered ``LIMIT`` samples become deterministic: ordered
samples, or counts over the whole table.

Foreign-key coverage reads each fact table once for all of its checks: every
row is turned into (check, key) pairs by ``explode`` and reduced map-side to
(check, key, rows) before the shuffle, so the shuffle carries distinct keys,
not rows, and a hot key costs one partial row per task. The distinct keys are
then left-joined to the dimension keys (size-checked planner: broadcast when
small, sort-merge otherwise).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_mart.operators.common import calendar


# ----------------------------------------------------------------- calendar
def calendar_head(date_dim: DataFrame, n: int = 100) -> DataFrame:
    """First ``n`` calendar days with their key."""
    return date_dim.select("cal_dt", "d_date_sk").orderBy("cal_dt").limit(n)


def calendar_lookup(date_dim: DataFrame, day: str) -> DataFrame:
    """The calendar row of one date."""
    return date_dim.filter(F.col("cal_dt") == F.lit(day).cast("date"))


def date_range(fact: DataFrame, date_key: str, date_dim: DataFrame) -> DataFrame:
    """First and last calendar date a fact table covers."""
    span = fact.agg(F.min(date_key).alias("lo"), F.max(date_key).alias("hi"))
    lo = calendar(date_dim, F.col("d_date_sk").alias("lo_sk"), F.col("cal_dt").alias("first_date"))
    hi = calendar(date_dim, F.col("d_date_sk").alias("hi_sk"), F.col("cal_dt").alias("last_date"))
    return (span.join(lo, span["lo"] == lo["lo_sk"], "left")
            .join(hi, span["hi"] == hi["hi_sk"], "left")
            .select("first_date", "last_date"))


def arrival_rate(fact: DataFrame, date_key: str, date_dim: DataFrame, latest: int = 10) -> DataFrame:
    """Rows per sold day, the ``latest`` days (a top-k report)."""
    cal = calendar(date_dim, "d_date_sk", "cal_dt")
    daily = (fact.select(F.col(date_key).alias("sold_date_sk"))
             .join(cal, F.col("sold_date_sk") == F.col("d_date_sk"), "inner")
             .groupBy("cal_dt", "sold_date_sk").agg(F.count(F.lit(1)).alias("rows")))
    return daily.orderBy(F.col("cal_dt").desc()).limit(latest)


def ordered_sample(fact: DataFrame, n: int = 100) -> DataFrame:
    """The first ``n`` rows in the order of all columns (deterministic)."""
    return fact.orderBy(*[F.col(c).asc_nulls_last() for c in fact.columns]).limit(n)


# --------------------------------------------------------- foreign keys
@dataclass(frozen=True)
class FkCheck:
    fact: str
    fk: str
    dim: str
    pk: str


# Fixed values that must equal the reference: the (fact column -> dimension
# key) pairs checked by the exploration script, in its order. Two of the
# script's checks join a different column than their label; the labelled
# column is checked here.
FK_CHECKS = [
    FkCheck("catalog_sales", "cs_sold_date_sk", "date_dim", "d_date_sk"),
    FkCheck("catalog_sales", "cs_sold_time_sk", "time_dim", "t_time_sk"),
    FkCheck("catalog_sales", "cs_ship_date_sk", "date_dim", "d_date_sk"),
    FkCheck("catalog_sales", "cs_bill_customer_sk", "customer", "c_customer_sk"),
    FkCheck("catalog_sales", "cs_bill_cdemo_sk", "customer_demographics", "cd_demo_sk"),
    FkCheck("catalog_sales", "cs_bill_hdemo_sk", "household_demographics", "hd_demo_sk"),
    FkCheck("catalog_sales", "cs_bill_addr_sk", "customer_address", "ca_address_sk"),
    FkCheck("catalog_sales", "cs_ship_customer_sk", "customer", "c_customer_sk"),
    FkCheck("catalog_sales", "cs_ship_cdemo_sk", "customer_demographics", "cd_demo_sk"),
    FkCheck("catalog_sales", "cs_ship_hdemo_sk", "household_demographics", "hd_demo_sk"),
    FkCheck("catalog_sales", "cs_call_center_sk", "call_center", "cc_call_center_sk"),
    FkCheck("catalog_sales", "cs_catalog_page_sk", "catalog_page", "cp_catalog_page_sk"),
    FkCheck("catalog_sales", "cs_ship_mode_sk", "ship_mode", "sm_ship_mode_sk"),
    FkCheck("catalog_sales", "cs_warehouse_sk", "warehouse", "w_warehouse_sk"),
    FkCheck("catalog_sales", "cs_item_sk", "item", "i_item_sk"),
    FkCheck("catalog_sales", "cs_promo_sk", "promotion", "p_promo_sk"),
    FkCheck("web_sales", "ws_web_page_sk", "web_page", "wp_web_page_sk"),
    FkCheck("web_sales", "ws_web_site_sk", "web_site", "web_site_sk"),
]


def _key_counts(facts: dict[str, DataFrame], checks: list[FkCheck]) -> DataFrame:
    """(check_id, k, rows) per distinct foreign-key value, one scan per fact."""
    parts = []
    for fact_name in dict.fromkeys(c.fact for c in checks):
        mine = [(i, c) for i, c in enumerate(checks) if c.fact == fact_name]
        pairs = F.array(*[F.struct(F.lit(i).alias("check_id"), F.col(c.fk).cast("bigint").alias("k"))
                          for i, c in mine])
        parts.append(facts[fact_name].select(F.inline(pairs))
                     .groupBy("check_id", "k").agg(F.count(F.lit(1)).alias("rows")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _dim_keys(dims: dict[str, DataFrame], checks: list[FkCheck]) -> DataFrame:
    parts = [dims[c.dim].select(F.lit(i).alias("check_id"), F.col(c.pk).cast("bigint").alias("k"))
             for i, c in enumerate(checks)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct().withColumn("hit", F.lit(True))


def _labels(spark, checks: list[FkCheck]) -> DataFrame:
    rows = [(i, c.fact, c.fk, c.dim, c.pk) for i, c in enumerate(checks)]
    return spark.createDataFrame(rows, "check_id int, fact string, fk_column string, dimension string, "
                                       "key_column string")


# Words of 64 keys up to which a dimension's keys are kept as one bitmap (8 MB, a span of 64 million keys).
BITMAP_WORDS = 1 << 20


def _key_bitmap(dim: DataFrame, pk: str, max_words: int) -> tuple[int, Column] | None:
    """(first word, bitmap of the keys as an array of 64-bit words), the bitmap
    being a scalar subquery; None if the keys span more than ``max_words`` words.

    The words are built by a partial aggregate, so each task ships at most
    one row a word."""
    k = F.col(pk).cast("bigint")
    words = (dim.filter(k.isNotNull()).groupBy(F.shiftright(k, 6).alias("w"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), k.bitwiseAND(63).cast("int"))).alias("bits")))
    lo, hi = words.agg(F.min("w"), F.max("w")).first()
    if lo is None:
        return 0, F.array().cast("array<bigint>")
    if hi - lo >= max_words:
        return None
    spark = dim.sparkSession
    dense = spark.range(lo, hi + 1).join(words, F.col("id") == F.col("w"), "left").select("id", F.coalesce("bits", F.lit(0)).alias("bits"))
    one = dense.agg(F.sort_array(F.collect_list(F.struct("id", "bits"))).alias("all"))
    return lo, one.select(F.col("all.bits").alias("words")).scalar()


def _held(k: Column, bitmap: tuple[int, Column]) -> Column:
    """Whether the bitmap holds key ``k`` (null: no)."""
    lo, words = bitmap
    word = F.shiftright(k, 6) - lo
    inside = (word >= 0) & (word < F.size(words))
    return F.coalesce(F.when(inside, F.bit_get(F.get(words, word.cast("int")), k.bitwiseAND(63).cast("int")) == 1), F.lit(False))


def _probed_counts(fact: DataFrame, mine: list[tuple[int, str, tuple[int, Column]]]) -> DataFrame:
    """Coverage counts of one fact's checks against bitmaps: one scan, each task leaves one row."""
    aggs = []
    for i, fk, bitmap in mine:
        k = F.col(fk).cast("bigint")
        held = _held(k, bitmap)
        aggs.append(F.struct(F.lit(i).alias("check_id"), F.count(F.lit(1)).alias("fact_rows"), F.count_if(k.isNull()).alias("null_fk"),
                             F.count_if(held).alias("matched"), F.count_if(k.isNotNull() & ~held).alias("dangling")))
    return fact.agg(F.array(*aggs).alias("c")).select(F.inline("c"))


def fk_coverage(facts: dict[str, DataFrame], dims: dict[str, DataFrame],
                checks: list[FkCheck] = FK_CHECKS, max_words: int = BITMAP_WORDS) -> DataFrame:
    """Per check -- fact rows, NULL keys, rows whose key is in the
    dimension, and dangling rows (key present but not in the dimension).

    Dimensions whose keys span at most ``max_words`` words of 64 are probed as
    bitmaps while the fact is scanned, without a shuffle of its keys; the
    others by a join of the distinct keys."""
    bitmaps = {x: _key_bitmap(dims[x[0]], x[1], max_words) for x in dict.fromkeys((c.dim, c.pk) for c in checks)}
    wide = [i for i, c in enumerate(checks) if bitmaps[c.dim, c.pk] is None]
    parts = []
    for name in dict.fromkeys(c.fact for c in checks):
        mine = [(i, c.fk, bitmaps[c.dim, c.pk]) for i, c in enumerate(checks) if c.fact == name and i not in wide]
        if mine:
            parts.append(_probed_counts(facts[name], mine))
    if wide:
        chosen = [checks[i] for i in wide]
        joined = _key_counts(facts, chosen).join(_dim_keys(dims, chosen), ["check_id", "k"], "left")
        parts.append(joined.groupBy("check_id").agg(
            F.sum("rows").alias("fact_rows"),
            F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("rows"))), F.lit(0)).alias("null_fk"),
            F.coalesce(F.sum(F.when(F.col("hit"), F.col("rows"))), F.lit(0)).alias("matched"),
            F.coalesce(F.sum(F.when(F.col("k").isNotNull() & F.col("hit").isNull(), F.col("rows"))),
                       F.lit(0)).alias("dangling"))
            .withColumn("check_id", F.element_at(F.array(*[F.lit(i) for i in wide]), F.col("check_id") + 1)))
    cov = parts[0]
    for part in parts[1:]:
        cov = cov.unionByName(part)
    spark = next(iter(facts.values())).sparkSession
    # the 18-row label table is a literal of the check list
    return (cov.filter(F.col("fact_rows") > 0).join(F.broadcast(_labels(spark, checks)), "check_id")
            .select("fact", "fk_column", "dimension", "key_column", "fact_rows", "null_fk", "matched",
                    "dangling"))


def fk_sample(facts: dict[str, DataFrame], dims: dict[str, DataFrame],
              checks: list[FkCheck] = FK_CHECKS, n: int = 5) -> DataFrame:
    """E9 sample: per check, the ``n`` smallest matching key values and how
    many fact rows carry each."""
    keys = _key_counts(facts, checks).filter(F.col("k").isNotNull())
    matched = keys.join(_dim_keys(dims, checks).drop("hit"), ["check_id", "k"], "left_semi")
    w = Window.partitionBy("check_id").orderBy("k")
    top = matched.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= n)
    spark = next(iter(facts.values())).sparkSession
    return (top.join(F.broadcast(_labels(spark, checks)), "check_id")
            .select("fact", "fk_column", "dimension", F.col("k").alias("fk_value"),
                    F.col("rows").alias("fact_rows")))


# ------------------------------------------------------------ recurrence
def inventory_recurrence(inventory: DataFrame) -> DataFrame:
    """Inventory rows per (date, item), ordered by item then date."""
    return (inventory.groupBy("inv_date_sk", "inv_item_sk").agg(F.count(F.lit(1)).alias("rows"))
            .orderBy("inv_item_sk", "inv_date_sk"))


def item_dates(fact: DataFrame, item_key: str, date_key: str, date_dim: DataFrame,
               item: DataFrame | None = None, item_sk: int | None = None) -> DataFrame:
    """The distinct (date, week) on which each item occurs in a fact
    table (all items, or one when ``item_sk`` is given). With ``item`` the
    fact is first matched to the item dimension, as in the script."""
    f = fact.select(F.col(item_key).cast("bigint").alias("item_sk"), F.col(date_key).alias("date_sk"))
    if item_sk is not None:
        f = f.filter(F.col("item_sk") == F.lit(item_sk))
    if item is not None:
        f = f.join(item.select(F.col("i_item_sk").alias("item_sk")), "item_sk", "left_semi")
    cal = calendar(date_dim, "d_date_sk", "cal_dt", "wk_num")
    return (f.join(cal, f["date_sk"] == cal["d_date_sk"], "inner")
            .select("item_sk", "cal_dt", "wk_num").distinct())


# ------------------------------------------------------------ entities
def distinct_items(item: DataFrame) -> DataFrame:
    """E14."""
    return item.select("i_item_sk", "i_product_name").distinct().orderBy("i_item_sk")


def count_distinct(df: DataFrame, col: str, alias: str) -> DataFrame:
    """Exact distinct count."""
    return df.agg(F.countDistinct(col).alias(alias))


def distinct_customers(customer: DataFrame) -> DataFrame:
    """E16."""
    return customer.select("c_customer_sk", "c_first_name", "c_last_name").distinct().orderBy("c_customer_sk")


# ------------------------------------------------------------ null profile
def null_profile(df: DataFrame, table: str) -> DataFrame:
    """Rows, non-NULL and NULL count of every column, one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("__rows"),
                    *[F.count(F.col(c)).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("non_null"))
                      for c in df.columns])
    return (counts.select(F.col("__rows").alias("rows"), F.inline(pairs))
            .select(F.lit(table).alias("table_name"), "column_name", "rows", "non_null",
                    (F.col("rows") - F.col("non_null")).alias("nulls")))
