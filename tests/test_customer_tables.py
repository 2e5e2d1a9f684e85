"""History and dimension in buckets equal the full merge and the full build, and touch what changed only."""

import tempfile

import pytest
from pyspark.sql import functions as F

from retail_mart.functions.compare import CUSTOMER_COLUMNS
from retail_mart.operators import customer_scd2 as scd
from retail_mart.plans import pipeline as pl
from retail_mart.sources.fixtures import CUSTOMER_BATCH_DATES
from retail_mart.streaming import customer_tables as ct
from tests.helpers import frame_rows


@pytest.fixture()
def paths():
    return pl.MartPaths(tempfile.mkdtemp(prefix="mart-"))


@pytest.mark.parametrize("mode", ["reference", "strict"])
def test_runs_equal_the_full_merge(spark, raw_small, paths, mode):
    """With null keys, which never match, and back-and-forth changes."""
    odd = raw_small.customer(1).limit(2).withColumn("c_customer_sk", F.lit(None).cast("bigint"))
    sources = [raw_small.customer(1), raw_small.customer(2).unionByName(odd), raw_small.customer(3), raw_small.customer(1)]
    want, history = scd.empty_snapshot(spark), pl.customer_history(spark, paths)
    for k, source in enumerate(sources):
        day = f"2001-0{k + 1}-01"
        want = spark.createDataFrame(scd.scd2_apply(want, source, day, mode).collect(), scd.SNAPSHOT_SCHEMA)
        history.merge(source, day, mode)
        assert frame_rows(history.read()) == frame_rows(want)
    assert {r.part for r in history.table.read().select("part").distinct().collect()} == {"open", "closed"}


def settled(r):
    """Customers without nulls in compared columns."""
    full = r.customer(1)
    for c in CUSTOMER_COLUMNS:
        full = full.filter(F.col(c).isNotNull())
    return full


@pytest.mark.parametrize("mode", ["reference", "strict"])
def test_only_touched_buckets_are_rewritten_and_only_marks_are_scanned(spark, raw_small, paths, mode):
    source, history = settled(raw_small), pl.customer_history(spark, paths)
    history.merge(source, "2001-01-01", mode)
    before = history.table.state()
    assert history.merge(source, "2001-01-02", mode) == [] and history.table.state().number == before.number
    one = source.agg(F.min("c_customer_sk")).first()[0]
    moved = source.withColumn("c_email_address", F.when(F.col("c_customer_sk") == one, "new@x.org").otherwise(F.col("c_email_address")))
    p = history.marks(before, moved, mode)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    mark = "match_mark" if mode == "reference" else "row_mark"
    schemas = [ln for ln in p.split("\n") if "ReadSchema" in ln and "_mark" in ln]
    assert schemas and all(f"struct<c_customer_sk:bigint,{mark}:binary>" in ln for ln in schemas)
    assert len(history.merge(moved, "2001-01-03", mode)) == 1
    after = history.table.state()
    changed = {k for k in after.periods.keys() | before.periods.keys() if after.periods.get(k) != before.periods.get(k)}
    assert len({k.split("bucket=")[1] for k in changed}) == 1 and len(before.periods) > 1
    assert history.read().filter(F.col("c_customer_sk") == one).count() == 2


def test_a_key_that_arrives_twice_fails_the_run(spark, raw_small, paths):
    history, source = pl.customer_history(spark, paths), settled(raw_small)
    history.merge(source, "2001-01-01")
    with pytest.raises(Exception, match="duplicate c_customer_sk"):
        history.merge(source.union(source.limit(1)), "2001-01-02")
    with pytest.raises(ValueError):
        history.merge(source, "2001-01-02", "other")


def parts(r):
    return {"address": r.customer_address(), "demographics": r.customer_demographics(), "household": r.household_demographics(), "income_band": r.income_band()}


def test_dimension_follows_each_joined_table(spark, raw_small, paths):
    """An address, a demographic row, an income band and a customer change; only the buckets they reach are rebuilt."""
    r, history, dim = raw_small, pl.customer_history(spark, paths), pl.customer_dimension(spark, paths)
    history.merge(r.customer(1), CUSTOMER_BATCH_DATES[0], "strict")
    now = parts(r)
    all_buckets = dim.refresh(history, **now)

    def same():
        return frame_rows(dim.read()) == frame_rows(scd.customer_dim(history.read(), *now.values()))
    assert same() and dim.refresh(history, **now) == []
    live = history.read().filter("end_date is null")
    for name, key, column, value, via in (("address", "ca_address_sk", "ca_city", "Elsewhere", "c_current_addr_sk"),
                                          ("demographics", "cd_demo_sk", "cd_gender", "X", "c_current_cdemo_sk")):
        k = live.filter(F.col(via).isNotNull()).agg(F.min(via)).first()[0]
        now[name] = now[name].withColumn(column, F.when(F.col(key) == k, value).otherwise(F.col(column)))
        hit = live.filter(F.col(via) == k).count()
        assert 0 < len(dim.refresh(history, **now)) <= hit and same()
    band = now["household"].agg(F.min("hd_income_band_sk")).first()[0]
    now["income_band"] = now["income_band"].withColumn("ib_lower_bound", F.when(F.col("ib_income_band_sk") == band, F.lit(-1).cast("bigint")).otherwise(F.col("ib_lower_bound")))
    assert dim.refresh(history, **now) and same()
    now["address"] = now["address"].union(now["address"].limit(1).withColumn("ca_address_sk", F.lit(10**9).cast("bigint")))
    assert dim.refresh(history, **now) == [] and same()  # nobody lives there
    touched = history.merge(r.customer(2), CUSTOMER_BATCH_DATES[1], "strict")
    assert set(dim.refresh(history, **now)) <= set(touched) <= set(all_buckets) | set(touched) and same()


def test_a_run_killed_between_history_and_dimension_is_made_up_for(spark, raw_small, paths):
    r, history, dim = raw_small, pl.customer_history(spark, paths), pl.customer_dimension(spark, paths)
    history.merge(r.customer(1), CUSTOMER_BATCH_DATES[0])
    dim.refresh(history, **parts(r))
    history.merge(r.customer(2), CUSTOMER_BATCH_DATES[1])  # the dimension's refresh never ran
    history.merge(r.customer(3), CUSTOMER_BATCH_DATES[2])
    dim.refresh(history, **parts(r))
    assert frame_rows(dim.read()) == frame_rows(scd.customer_dim(history.read(), *parts(r).values()))


def test_marks_tell_nulls_from_values(spark):
    row = {c: ("x" if c in scd._STRINGS else 1) for c in CUSTOMER_COLUMNS}
    rows = [row, {**row, "c_login": None}, {**row, "c_birth_day": None}, {**row, "c_birth_day": 0}, {**row, "c_login": ""}]
    got = ct.with_marks(spark.createDataFrame([tuple(x[c] for c in CUSTOMER_COLUMNS) for x in rows], scd.SNAPSHOT_SCHEMA[:18])).collect()
    assert len({bytes(r.row_mark) for r in got}) == 5
    assert got[1].match_mark is None and got[2].match_mark == got[3].match_mark != got[0].match_mark
