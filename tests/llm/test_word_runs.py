"""Runs of words against their definition."""

import hashlib
import random
import re
import zlib

import numpy as np

from retail_mart.llm import queries, word_runs
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w):
    """By definition: maximal stretches of each period, none of a smaller one."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(6, 4 * q) and not any(all(w[k] == w[k + p] for k in range(i, i + n - p)) for p in range(1, q)):
                out.append((i, n, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(words):
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(words) if i not in gone)))


def test_lyndon_lengths():
    rnd = random.Random(3)
    for _ in range(1500):
        s = [rnd.randrange(3) for _ in range(rnd.randrange(1, 13))]
        lyndon = lambda x: all(x < x[k:] for k in range(1, len(x)))
        want = [max(j - i for j in range(i + 1, len(s) + 1) if lyndon(s[i:j])) for i in range(len(s))]
        values = sorted(set(s))
        assert word_runs.lyndon_lengths([values.index(x) for x in s], len(values)) == want


def test_runs_of_random_words():
    rnd = random.Random(4)
    for _ in range(4000):
        n, k = rnd.randrange(80), rnd.choice([1, 1, 2, 3, 5, 9])
        w = [rnd.randint(0, k) for _ in range(n)]
        for _ in range(rnd.randrange(4) if n else 0):
            a, p = rnd.randrange(n), rnd.randint(1, 9)
            for i in range(a + p, min(n, a + p * rnd.randint(2, 9) + rnd.randrange(p))):
                w[i] = w[i - p]
        assert word_runs.word_runs(np.array(w, np.int32)) == brute_runs(w), w


def test_nested_and_long_runs():
    for w, least in (([0, 0, 0, 0, 0, 0, 1] * 5, 6), ([0, 1] * 4 + [2, 0, 1, 0, 1, 0, 1, 0, 1] * 6, 8), (list(range(700)) * 4 + [0, 1], 1)):
        got = word_runs.word_runs(np.array(w, np.int32))
        assert got == (brute_runs(w) if len(w) < 200 else [(0, 2802, 700)]) and len(got) >= least
    one, many = np.zeros(200_000, np.int32), np.arange(90_000, dtype=np.int32) % 70_001
    assert word_runs.word_runs(one) == [(0, 200_000, 1)] and word_runs.word_runs(many) == []


def test_query_is_the_definition(spark):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op11_periodic_runs(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs:
        w, h = WORD.findall(r.text or ""), zlib.crc32(str(r.doc_id).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if n < 3000:  # the definition's cost
            assert got[r.doc_id] == brute_row(w), r.doc_id
    assert sum(v[0] for v in got.values()) > 10


def test_edge_cases(spark, edge, none):
    assert word_runs.periodic_runs(none).count() == 0
    out = word_runs.periodic_runs(edge)
    got = sorted(out.collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    assert len(got) == edge.count() and got[-1].doc_id is None
    for r in got:
        if r.doc_id in (4, 5, 6):
            assert (r.n_words, r.runs, r.densest, r.collapsed) == (0, [], None, "")
    rows = [(1, "x y " * 40_000 + "z", 7), (1, "x y " * 40_000 + "z", 7), (2, "a\x0ba\u00a0 a a a a a a", 8)]
    got = word_runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string, RUNS long")).collect()
    assert [(r.collapsed, [tuple(x) for x in r.runs]) for r in got[:2]] == [("x y z", [(0, 80_000, 2)])] * 2
    assert got[2].collapsed == "a a\u00a0 a" and tuple(got[2].densest) == (2, 6, 1)  # no-break space is part of a word
    assert queries.periodic_texts(spark.createDataFrame([(None, "b  b")], "doc_id long, text string")).first().text == "b  b"
