"""Period tables: one rename is the only step readers notice."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from retail_mart.plans import pipeline as pl
from retail_mart.plans.registry import early_inputs, raw_inputs
from retail_mart.operators import daily_sales as ds
from retail_mart.operators import weekly_inventory as wi
from retail_mart.sources import files, periods
from retail_mart.sources.periods import PeriodTable
from retail_mart.streaming import fingerprints as fp
from tests.helpers import frame_rows

SCHEMA = "v string, a int, b string"


def table_of(spark, rows=None):
    t = PeriodTable(spark, tempfile.mkdtemp(prefix="periods-") + "/t", ["a", "b"])
    if rows is not None:
        t.replace(spark.createDataFrame(rows, SCHEMA))
    return t


def rows_of(t):
    return sorted((tuple(r) for r in t.read().collect()), key=str)


OLD = [("x", 1, "p"), ("y", 2, "p/q %=")]
NEW = [("z", 2, "p/q %="), ("w", 3, None), ("n", None, "k")]
BOTH = sorted([("x", 1, "p"), *NEW], key=str)


def test_replace_delete_and_read(spark):
    t = table_of(spark)
    assert t.read() is None and t.watermark() == 0
    t.replace(spark.createDataFrame([], SCHEMA), notes={"k": 1})
    assert t.read().count() == 0 and t.read().schema.simpleString() == "struct<v:string,a:int,b:string>"
    t.replace(spark.createDataFrame(OLD, SCHEMA), spread=["v"])
    assert rows_of(t) == sorted(OLD, key=str)
    state = t.replace(spark.createDataFrame(NEW, SCHEMA), notes={"m": 2})
    assert rows_of(t) == BOTH and state.notes == {"k": 1, "m": 2} and t.watermark() == 3
    t.replace(spark.createDataFrame([], SCHEMA), deleted=[{"a": 3, "b": None}, {"a": 9, "b": "none"}])
    assert rows_of(t) == [r for r in BOTH if r[1] != 3] and t.watermark() == 2


@pytest.mark.parametrize("step, done", [("_stage", False), ("_staged", False), ("_publish", True), ("_clean", True)])
@pytest.mark.parametrize("before", [True, False])
def test_a_run_killed_between_any_two_steps_leaves_old_or_new(spark, monkeypatch, step, done, before):
    t = table_of(spark, OLD)
    t.replace(spark.createDataFrame(OLD[:1], SCHEMA))
    whole = getattr(PeriodTable, step)

    def dying(self, *a):
        if not before:
            whole(self, *a)
        raise RuntimeError("killed")
    with monkeypatch.context() as m:
        m.setattr(PeriodTable, step, dying)
        with pytest.raises(RuntimeError):
            t.replace(spark.createDataFrame(NEW, SCHEMA))
    new = done and (step == "_clean" or not before)
    assert rows_of(t) == (BOTH if new else sorted(OLD, key=str))
    t.replace(spark.createDataFrame(NEW, SCHEMA))  # the repeated run
    assert rows_of(t) == BOTH
    for _ in range(3):
        t.replace(spark.createDataFrame(NEW, SCHEMA))
        assert rows_of(t) == BOTH


def test_killed_inside_the_publication(spark, monkeypatch):
    t = table_of(spark, OLD)
    for name in ("write_text", "rename_new"):
        with monkeypatch.context() as m:
            m.setattr(files, name, lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
            with pytest.raises(RuntimeError):
                t.replace(spark.createDataFrame(NEW, SCHEMA))
        assert rows_of(t) == sorted(OLD, key=str)


def test_two_runs_from_one_state_do_not_undo_each_other(spark):
    t = table_of(spark, OLD)
    base = t.state()
    t.replace(spark.createDataFrame([("first", 7, "p")], SCHEMA), base=base)
    with pytest.raises(RuntimeError, match="another run"):
        t.replace(spark.createDataFrame([("second", 8, "p")], SCHEMA), base=base)
    assert rows_of(t) == sorted([*OLD, ("first", 7, "p")], key=str)


def test_replaced_files_go_after_some_manifests(spark):
    t = table_of(spark, OLD)
    reader = t.read()  # of the first state
    for k in range(5):
        t.replace(spark.createDataFrame([(f"v{k}", 1, "p")], SCHEMA))
        if k == 0:
            assert reader.count() == 2
    assert rows_of(t) == sorted([("v4", 1, "p"), OLD[1]], key=str)
    assert len(t.numbers()) == periods.KEEP
    held = [d for d, _, names in os.walk(f"{t.root}/runs") if any(n.endswith(".parquet") for n in names)]
    assert len(held) <= 2 + periods.KEEP


def test_watermark_reads_no_rows_and_skips_empty_periods(spark):
    t = table_of(spark, OLD)
    os.makedirs(f"{t.root}/runs/run={t.state().periods['a=1/b=p']}/a=99/b=p")  # a folder without rows
    base = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    assert t.watermark() == 2
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == base  # no Spark job


def test_ranges():
    assert fp.ranges({1, 2, 3, 7, 9}, [1, 2, 3, 4, 7, 8, 9]) == [(1, 3), (7, 7), (9, 9)]
    assert fp.ranges({1, 5}, [1, 5]) == [(1, 5)] and fp.ranges(set(), [1]) == []


def test_repair_reads_changed_periods_only(spark, raw_small, monkeypatch):
    """Late sales and restated stock reach the facts; unchanged days and weeks are not read."""
    r, paths = raw_small, pl.MartPaths(tempfile.mkdtemp(prefix="mart-"))
    full = raw_inputs(r, 1)
    pl.run_daily(spark, full, paths)
    pl.run_weekly(spark, full, paths)
    assert pl.daily_table(spark, paths).watermark() > 0
    day = full.catalog_sales.agg(F.percentile("cs_sold_date_sk", 0.5).cast("bigint")).first()[0]
    late = full.catalog_sales.filter(F.col("cs_sold_date_sk") == day).withColumn("cs_quantity", F.col("cs_quantity") + 5)
    changed = pl.RawInputs(full.catalog_sales.union(late), *[getattr(full, f) for f in list(pl.RawInputs.__dataclass_fields__)[1:]])
    before = pl.daily_table(spark, paths).state().periods
    spans = []
    within = fp.within
    monkeypatch.setattr(fp, "within", lambda c, s: spans.append((c, s)) or within(c, s))
    pl.run_daily(spark, changed, paths, repair=True)
    after = pl.daily_table(spark, paths).state().periods
    wm = pl.daily_table(spark, paths).watermark()
    assert {p for p in after if after[p] != before[p]} == {f"sold_date_sk={day}", f"sold_date_sk={wm}"}
    assert {s for _, ss in spans for s in ss} == {(day, day)}
    pl.run_weekly(spark, changed, paths, repair=True)
    assert max(b - a for c, ss in spans if c in ("sold_date_sk", "inv_date_sk") for a, b in ss) <= 6
    daily = ds.daily_sales(changed.catalog_sales, changed.web_sales, changed.date_dim)
    assert frame_rows(pl.read_daily(spark, paths).select(*daily.columns)) == frame_rows(daily)
    weekly = wi.weekly_sales_inventory(daily, changed.inventory, changed.date_dim)
    assert frame_rows(pl.read_weekly(spark, paths).select(*weekly.columns)) == frame_rows(weekly)


def test_a_scheduled_run_still_ignores_late_rows(spark, raw_small):
    paths = pl.MartPaths(tempfile.mkdtemp(prefix="mart-"))
    early, full = early_inputs(raw_small), raw_inputs(raw_small, 1)
    pl.run_daily(spark, early, paths)
    wm = pl.daily_table(spark, paths).watermark()
    old = F.col("sold_date_sk") < wm
    first = frame_rows(pl.read_daily(spark, paths).filter(old))
    pl.run_daily(spark, full, paths)
    assert frame_rows(pl.read_daily(spark, paths).filter(old)) == first


def test_rows_are_computed_once_for_a_write(spark):
    """Dealing rows out by period takes no sample of them first."""
    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x % 5

    day = F.udf(count, "int").asNondeterministic()
    fresh = spark.range(200).repartition(4).select(day("id").alias("day"), F.col("id").alias("item"))
    t = PeriodTable(spark, tempfile.mkdtemp(prefix="periods-") + "/t", ["day"])
    t.replace(fresh, spread=["item"])
    assert seen.value == 200
    assert frame_rows(t.read()) == frame_rows(spark.range(200).select((F.col("id") % 5).cast("int").alias("day"), F.col("id").alias("item")))


def test_runs_read_a_stored_raw_layer(spark, raw_small):
    """What the steps of several runs read is derived and joined once, with the same rows."""
    from retail_mart.plans import registry
    from retail_mart.sources.fixtures import RawTables
    r = RawTables(spark, raw_small.sf_dir)
    runs = [raw_inputs(r, b, c, ("daily", "weekly")) for b, c in ((1, registry.split_day(r)), (2, None))]
    for x in runs:
        for df in (x.catalog_sales, x.web_sales, x.inventory):
            p = df._jdf.queryExecution().executedPlan().toString()
            assert "Join" not in p and "Exchange" not in p and "lineitem" not in p
    plain = raw_inputs(r, 2)
    for name in ("catalog_sales", "web_sales", "inventory"):
        assert frame_rows(getattr(runs[1], name)) == frame_rows(getattr(plain, name))
