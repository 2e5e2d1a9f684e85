"""SCD-2 merge semantics: the reduced scenario of SURVEY 5.3 and invariants."""

import pytest
from pyspark.sql import functions as F

from retail_mart.functions.compare import CUSTOMER_COLUMNS
from retail_mart.operators import customer_scd2 as scd

# scenario: key, a string column (c_last_name), a numeric column (c_birth_month)
RUNS = [
    [(1, "A", 1), (2, None, 1), (3, "A", 1), (4, "A", None)],
    [(1, "B", 1), (2, None, 1), (3, "A", 1), (4, "A", 0)],
    [(1, "A", 1), (2, None, 1), (3, None, 1), (4, "A", None)],
    [(1, "A", 1), (2, "Z", 1), (4, "A", None)],
]
DAYS = ["2001-01-01", "2001-01-02", "2001-01-03", "2001-01-04"]


def source(spark, rows):
    data = []
    for key, s, n in rows:
        rec = {c: None for c in CUSTOMER_COLUMNS}
        for c in CUSTOMER_COLUMNS:
            f = scd.SNAPSHOT_SCHEMA[c].dataType.simpleString()
            rec[c] = "x" if f == "string" else 7
        rec.update(c_customer_sk=key, c_last_name=s, c_birth_month=n)
        data.append(tuple(rec[c] for c in CUSTOMER_COLUMNS))
    schema = scd.SNAPSHOT_SCHEMA.fields[:len(CUSTOMER_COLUMNS)]
    from pyspark.sql.types import StructType
    return spark.createDataFrame(data, StructType(schema))


def run(spark, mode, n_runs):
    snap = scd.empty_snapshot(spark)
    for i in range(n_runs):
        snap = scd.scd2_apply(snap, source(spark, RUNS[i]), DAYS[i], mode)
    return [(r.c_customer_sk, r.c_last_name, r.c_birth_month, str(r.start_date)[:10],
             None if r.end_date is None else str(r.end_date)[:10])
            for r in snap.orderBy("c_customer_sk", "start_date", "c_last_name").collect()]


def open_rows(rows, key):
    return [r for r in rows if r[0] == key and r[4] is None]


def test_run1_four_open_rows(spark):
    rows = run(spark, "reference", 1)
    assert len(rows) == 4 and all(r[4] is None for r in rows)


def test_run2_reference_quirks(spark):
    rows = run(spark, "reference", 2)
    # 1: A closed on day 2, B opens
    assert ("A" , "2001-01-02") in [(r[1], r[4]) for r in rows if r[0] == 1]
    assert [r[1] for r in open_rows(rows, 1)] == ["B"]
    # 2: NULL string never matches -> a second open duplicate (Q6)
    assert len(open_rows(rows, 2)) == 2
    # 4: NULL -> 0 is no change through coalesce (Q9)
    assert len([r for r in rows if r[0] == 4]) == 1


def test_run3_and_4_reference_quirks(spark):
    rows = run(spark, "reference", 3)
    assert open_rows(rows, 1) == []            # A->B->A: no open row (Q7)
    assert len(open_rows(rows, 2)) == 3        # third duplicate
    assert len(open_rows(rows, 3)) == 2        # NULL row opens, A stays open (Q6)
    rows4 = run(spark, "reference", 4)
    b = [r for r in rows4 if r[0] == 1 and r[1] == "B"]
    assert b[0][4] == "2001-01-04"             # closed row re-stamped (Q8)
    assert len(open_rows(rows4, 3)) == 2       # absent customer stays open (Q19)
    assert "Z" in [r[1] for r in open_rows(rows4, 2)]


def test_strict_has_one_open_row_per_live_key(spark):
    rows = run(spark, "strict", 4)
    for key in (1, 2, 4):
        assert len(open_rows(rows, key)) == 1
    assert open_rows(rows, 1)[0][1] == "A"
    assert open_rows(rows, 2)[0][1] == "Z"


def test_rerun_same_day_reference_is_not_idempotent_for_nulls(spark):
    src = source(spark, RUNS[0])
    snap = scd.scd2_apply(scd.empty_snapshot(spark), src, DAYS[0])
    again = scd.scd2_apply(snap, src, DAYS[0])
    assert again.count() == snap.count() + 1   # key 2 (NULL string) re-inserted (Q18)
    strict = scd.scd2_apply(scd.scd2_apply(scd.empty_snapshot(spark), src, DAYS[0], "strict"), src, DAYS[0], "strict")
    assert strict.count() == 4


def test_fixture_batches_match_survey(spark):
    """SURVEY 5.3 figures at sf0.01: 1,500 / 1,726 / 1,819 snapshot rows."""
    from retail_mart.sources.fixtures import CUSTOMER_BATCH_DATES, RawTables
    from tests.conftest import SF_MID
    r = RawTables(spark, SF_MID)
    snap = scd.empty_snapshot(spark)
    counts = []
    for b in (1, 2, 3):
        snap = scd.scd2_apply(snap, r.customer(b), CUSTOMER_BATCH_DATES[b - 1])
        counts.append((snap.count(), snap.filter(F.col("end_date").isNull()).count()))
    assert counts == [(1500, 1500), (1726, 1585), (1819, 1607)]


def test_duplicate_source_key_fails_like_merge(spark):
    src = source(spark, [(1, "A", 1), (1, "B", 1), (2, "A", 1)])
    snap = scd.scd2_apply(scd.empty_snapshot(spark), source(spark, RUNS[0]), DAYS[0])
    with pytest.raises(Exception, match="duplicate c_customer_sk"):
        scd.scd2_apply(snap, src, DAYS[1]).collect()     # at planning (small) or run time (large)


def test_strict_one_open_version_per_live_customer(spark):
    from retail_mart.sources.fixtures import CUSTOMER_BATCH_DATES, RawTables
    from tests.conftest import SF_MID
    r = RawTables(spark, SF_MID)
    snap = scd.empty_snapshot(spark)
    for b in (1, 2, 3):
        snap = scd.scd2_apply(snap, r.customer(b), CUSTOMER_BATCH_DATES[b - 1], "strict")
    live = r.customer(3).select("c_customer_sk")
    open_counts = (snap.filter(F.col("end_date").isNull()).groupBy("c_customer_sk").count()
                   .join(live, "c_customer_sk", "right"))
    assert open_counts.filter(F.col("count").isNull() | (F.col("count") != 1)).count() == 0


def test_close_and_new_versions_compose_to_apply(spark):
    """S9 (close) and S8 (new versions) are the two halves of one run."""
    snap = scd.scd2_apply(scd.empty_snapshot(spark), source(spark, RUNS[0]), DAYS[0])
    src = source(spark, RUNS[1])
    applied = scd.scd2_apply(snap, src, DAYS[1])
    halves = scd.scd2_close(snap, src, DAYS[1]).unionByName(scd.scd2_new_versions(snap, src, DAYS[1]))
    key = lambda r: (r.c_customer_sk, str(r.c_last_name), str(r.start_date), str(r.end_date))
    assert sorted(map(key, applied.collect())) == sorted(map(key, halves.collect()))
    closed = scd.scd2_close(snap, src, DAYS[1]).filter(F.col("end_date").isNotNull()).collect()
    assert [(r.c_customer_sk, r.c_last_name) for r in closed] == [(1, "A")]
