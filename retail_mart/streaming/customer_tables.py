"""Stored customer history (S8, S9, P17) and dimension (P18), kept by bucket of the customer key.

History. Open and closed versions are stored apart, in buckets of the key's
hash, each row with two marks: ``row_mark`` over all tracked columns, null-safe
(strict mode), and ``match_mark`` under the reference's comparison, null where
a column that must not be null to match is. A run first compares marks: one
aggregation of (key, marks) of history and source, no other column is read.
Only buckets with a customer that may change are merged and rewritten. A
customer cannot change if its only version is open and equal to its source
row; in reference mode, where every run also re-stamps closed versions (Q8) and
inserts customers with null strings again (Q6), all others count as touched.

Dimension. It is stored in the same buckets. Its manifest notes the run that
wrote each bucket of open versions and the folder with the marks of the rows
of the joined tables it was built from. A refresh rebuilds the buckets whose
open versions were rewritten, and those with a customer that a changed row
reaches: an income band through its households, the others directly. What
the notes say is published with the rows, so a run that broke off between
history and dimension is made up for by the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_mart.functions.compare import COALESCED_COLUMNS, CUSTOMER_COLUMNS, PLAIN_COLUMNS
from retail_mart.operators import customer_scd2 as scd
from retail_mart.sources import files, sinks
from retail_mart.sources.periods import PeriodTable, State

# Customers of a bucket, and the least and greatest number of buckets; fixed at the first run.
PER_BUCKET = 20_000
FEWEST, MOST = 16, 8192
KEY = "c_customer_sk"


def _mark(values: list[Column]) -> Column:
    return F.unhex(F.md5(F.to_json(F.struct(*values), {"ignoreNullFields": "false"}).cast("binary")))


def with_marks(customers: DataFrame) -> DataFrame:
    plain = F.lit(True)
    for c in PLAIN_COLUMNS:
        plain = plain & F.col(c).isNotNull()
    same = [F.coalesce(F.col(c), F.lit(0)).alias(c) if c in COALESCED_COLUMNS else F.col(c) for c in CUSTOMER_COLUMNS]
    return customers.withColumns({"match_mark": F.when(plain, _mark(same)), "row_mark": _mark([F.col(c) for c in CUSTOMER_COLUMNS])})


def bucket_of(buckets: int) -> Column:
    """Bucket of a customer; null keys have one of their own."""
    return F.when(F.col(KEY).isNull(), F.lit(buckets)).otherwise(F.pmod(F.xxhash64(KEY), F.lit(buckets))).cast("int")


class CustomerHistory:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.table = PeriodTable(spark, root, ["part", "bucket"])

    def read(self, state: State | None = None) -> DataFrame:
        rows = self.table.read(state)
        return rows.select(*scd.SNAPSHOT_COLUMNS) if rows is not None else scd.empty_snapshot(self.spark)

    def marks(self, state: State, source: DataFrame, mode: str) -> DataFrame:
        """Per customer key: rows of the source, versions, open versions and their marks."""
        mark = "match_mark" if mode == "reference" else "row_mark"
        rows = self.table.read(state)
        if mode == "strict":
            rows = rows.filter(F.col("part") == "open")
        none = F.lit(None).cast("binary")
        old = rows.select(KEY, F.lit(0).alias("src"), F.lit(1).alias("version"), (F.col("part") == "open").cast("int").alias("open"),
                          F.col(mark).alias("old"), none.alias("new"))
        new = with_marks(source).select(KEY, F.lit(1).alias("src"), F.lit(0).alias("version"), F.lit(0).alias("open"),
                                        none.alias("old"), F.col(mark).alias("new"))
        return (old.unionByName(new).filter(F.col(KEY).isNotNull()).groupBy(KEY)
                .agg(*[F.sum(c).alias(c) for c in ("src", "version", "open")], F.max("old").alias("old"), F.max("new").alias("new")))

    def touched(self, state: State, source: DataFrame, mode: str) -> list[int]:
        """Buckets with a customer that the source may change (at most as many numbers as buckets)."""
        buckets = state.notes["buckets"]
        unique = F.when(F.col("src") > 1, F.raise_error(F.concat(F.lit("customer source has duplicate c_customer_sk "), F.col(KEY).cast("string"))))
        same = (F.col("version") == 1) & (F.col("open") == 1) & F.coalesce(F.col("old") == F.col("new"), F.lit(False))
        m = self.marks(state, source, mode).filter(F.coalesce(unique.cast("boolean"), F.lit(True)) & (F.col("src") > 0) & ~same)
        found = {r.b for r in m.select(bucket_of(buckets).alias("b")).distinct().collect()}
        if source.filter(F.col(KEY).isNull()).limit(1).count():
            found.add(buckets)
        return sorted(found)

    def merge(self, source: DataFrame, as_of: str, mode: str = "reference") -> list[int]:
        """One run of both merges; the buckets that were rewritten."""
        if mode not in ("reference", "strict"):
            raise ValueError(mode)
        state = self.table.state()
        if state.schema is None:
            buckets = FEWEST
            customers = source.count()
            while buckets < MOST and buckets * PER_BUCKET < customers:
                buckets *= 2
            chosen, old, new = None, scd.empty_snapshot(self.spark), source
        else:
            buckets = state.notes["buckets"]
            chosen = self.touched(state, source, mode)
            if not chosen:
                return []
            old = self.table.read(state).filter(F.col("bucket").isin(chosen)).select(*scd.SNAPSHOT_COLUMNS)
            new = source.filter(bucket_of(buckets).isin(chosen))
        part = F.when(F.col("end_date").isNull(), "open").otherwise("closed")
        merged = with_marks(scd.scd2_apply(old, new, as_of, mode)).withColumns({"part": part, "bucket": bucket_of(buckets)})
        after = self.table.replace(merged, [{"part": p, "bucket": b} for p in ("open", "closed") for b in chosen or []], [KEY], {"buckets": buckets}, state)
        return chosen if chosen is not None else sorted({int(self.table.values(p)[1]) for p in after.periods})

    def open_runs(self, state: State) -> dict[str, str]:
        """The run that wrote each bucket of open versions."""
        named = ((self.table.values(p), r) for p, r in state.periods.items())
        return {b: r for (part, b), r in named if part == "open"}


def input_marks(address: DataFrame, demographics: DataFrame, household: DataFrame, income_band: DataFrame) -> DataFrame:
    """(name, k, mark) of every row the dimension joins, over the columns it takes."""
    parts = [("address", address, "ca_address_sk", scd.DIM_ADDRESS), ("demographics", demographics, "cd_demo_sk", scd.DIM_CDEMO),
             ("household", household, "hd_demo_sk", scd.DIM_HDEMO), ("income", income_band, "ib_income_band_sk", scd.DIM_INCOME)]
    out = None
    for name, df, key, cols in parts:
        rows = df.filter(F.col(key).isNotNull()).select(F.lit(name).alias("name"), F.col(key).cast("long").alias("k"), _mark([F.col(c) for c in cols]).alias("mark"))
        out = rows if out is None else out.unionByName(rows)
    return out


def changed_rows(now: DataFrame, before: DataFrame) -> DataFrame:
    """(name, k) of rows that came, went or differ (repeated keys by all their marks)."""
    both = now.withColumn("side", F.lit(1)).unionByName(before.withColumn("side", F.lit(0)))
    side = lambda k: F.sort_array(F.collect_list(F.when(F.col("side") == k, F.col("mark"))))
    return both.groupBy("name", "k").agg((~side(0).eqNullSafe(side(1))).alias("differs")).filter("differs").select("name", "k")


class CustomerDimension:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.table = PeriodTable(spark, root, ["bucket"])
        self.inputs = f"{self.table.root}/_inputs"

    def read(self) -> DataFrame | None:
        rows = self.table.read()
        return rows.select(*scd.CUSTOMER_DIM_COLUMNS) if rows is not None else None

    def reached(self, changed: DataFrame, open_versions: DataFrame, household: DataFrame) -> list[int]:
        """Buckets of the customers that changed rows of the joined tables reach."""
        of = lambda name: changed.filter(F.col("name") == name).select("k")
        through = (household.select("hd_demo_sk", "hd_income_band_sk").join(of("income"), F.col("hd_income_band_sk") == F.col("k"), "left_semi")
                   .select(F.col("hd_demo_sk").cast("long").alias("k")))
        found: set[int] = set()
        for column, keys in (("c_current_addr_sk", of("address")), ("c_current_cdemo_sk", of("demographics")),
                             ("c_current_hdemo_sk", of("household").union(through))):
            hit = open_versions.select(column, "bucket").join(keys, F.col(column) == F.col("k"), "left_semi")
            found |= {r.bucket for r in hit.select("bucket").distinct().collect()}
        return sorted(found)

    def refresh(self, history: CustomerHistory, address: DataFrame, demographics: DataFrame, household: DataFrame,
                income_band: DataFrame) -> list[int]:
        """Bring the dimension up to date; the buckets that were rebuilt."""
        state, source = self.table.state(), history.table.state()
        runs = history.open_runs(source)
        rows = history.table.read(source)
        open_versions = rows.filter(F.col("part") == "open")
        path = sinks.write_version(input_marks(address, demographics, household, income_band), self.inputs, sinks.KEEP_VERSIONS)
        before = state.notes.get("inputs")
        if state.schema is None:
            chosen = None
        elif not files.exists(self.spark, f"{before}/_SUCCESS"):  # many refreshes broke off since
            chosen = sorted(map(int, runs.keys() | state.notes["history"].keys()))
        else:
            noted = state.notes["history"]
            stale = {int(b) for b in runs.keys() | noted.keys() if runs.get(b) != noted.get(b)}
            changed = changed_rows(self.spark.read.parquet(path), self.spark.read.parquet(before)).persist()
            try:
                if changed.limit(1).count():
                    stale |= set(self.reached(changed, open_versions, household))
            finally:
                changed.unpersist()
            chosen = sorted(stale)
        part = open_versions if chosen is None else open_versions.filter(F.col("bucket").isin(chosen))
        dim = scd.customer_dim(part.select(*scd.SNAPSHOT_COLUMNS), address, demographics, household, income_band)
        dim = dim.withColumn("bucket", bucket_of(source.notes["buckets"]))
        self.table.replace(dim, [{"bucket": b} for b in chosen or []], [KEY], {"history": runs, "inputs": path}, state)
        return chosen if chosen is not None else sorted(map(int, runs))
