"""Foreign-key coverage: bitmaps, joins and a plain count agree."""

import random
import re

import pytest

from retail_mart.operators import profiling as pf
from tests.helpers import frame_rows

CHECKS = [pf.FkCheck("f", "a", "d", "k"), pf.FkCheck("f", "b", "d", "k"), pf.FkCheck("f", "b", "e", "k"), pf.FkCheck("g", "a", "wide", "k"),
          pf.FkCheck("g", "a", "none", "k")]


@pytest.fixture(scope="module")
def tables(spark):
    rnd = random.Random(1)
    pick = lambda: rnd.choice([None, -1, 0, 63, 64, -64, -65, 200, rnd.randrange(-300, 300)])
    f = [(pick(), pick()) for _ in range(2000)]
    g = [(rnd.choice([None, 5, 10**12, 7, -(10**12)]),) for _ in range(300)]
    dims = {"d": [(k,) for k in range(-70, 90) if k % 3] + [(None,), (1,), (1,)], "e": [(63,), (64,), (-64,)],
            "wide": [(5,), (10**12,), (None,)], "none": []}
    facts = {"f": spark.createDataFrame(f, "a int, b bigint"), "g": spark.createDataFrame(g, "a bigint")}
    want = []
    for c in CHECKS:
        keys = [r[0 if c.fk == "a" else 1] for r in (f if c.fact == "f" else g)]
        held = {k for k, in dims[c.dim]} - {None}
        want.append((sum(k is not None and k not in held for k in keys), c.dim, c.fact, len(keys), c.fk, "k",
                     sum(k in held for k in keys if k is not None), keys.count(None)))
    return facts, {n: spark.createDataFrame(r, "k bigint") for n, r in dims.items()}, sorted(want, key=str)


@pytest.mark.parametrize("max_words", [1 << 20, 3, 1])
def test_coverage_is_a_plain_count(tables, max_words):
    facts, dims, want = tables
    got = pf.fk_coverage(facts, dims, CHECKS, max_words)
    assert sorted((tuple(r[c] for c in sorted(got.columns)) for r in got.collect()), key=str) == want


def test_small_dimensions_are_probed_without_a_shuffle_of_the_fact_keys(spark, tables):
    facts, dims, _ = tables
    by_key = re.compile(r"hashpartitioning\(check_id#\w+, k#\w+")
    plan = lambda words: pf.fk_coverage(facts, dims, CHECKS[:3], words)._jdf.queryExecution().executedPlan().toString()
    assert not by_key.search(plan(1 << 20)) and by_key.search(plan(1))
    assert frame_rows(pf.fk_coverage({"f": facts["f"].limit(0)}, dims, CHECKS[:3])) == []
