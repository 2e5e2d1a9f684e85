"""The audit against its definition (the registered query is also held against SQL)."""

import collections
import random
import re

import numpy as np

from retail_mart.llm import divergence

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs, top=50):
    """rows: (text, lang, source)."""
    n, docs, groups = collections.Counter(), collections.Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall((text or "").translate(UPPER))
        for t in terms:
            n[lang, source, t] += 1
            n[lang, t] += 1
        for t in set(terms):
            docs[lang, t] += 1
    out = set()
    for lang, source in groups:
        kept = [t for (lg, t), k in docs.items() if lg == lang and k >= min_docs]
        share = lambda key, kept=kept: {t: 1 + 10**9 * (n[*key, t] + 5) // (sum(n[*key, u] for u in kept) + 5 * len(kept)) for t in kept}
        p, q = share((lang, source)), share((lang,))
        pairs = []
        for lg, other in groups:
            if lg == lang and other != source:
                h = share((lang, other))
                pairs.append((sum(abs(p[t] - h[t]) for t in kept), other))
        over = [(p[t] - q[t], t) for t in kept if n[lang, source, t] and p[t] > q[t]]
        for part, found in (("pair", pairs), ("term", over)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out |= {(lang, source, part, item, value, k) for k, (value, item) in enumerate(found, 1) if part == "pair" or k <= top}
    return out


def rows_of(report):
    got = report.collect()
    assert len({tuple(r) for r in got}) == len(got)
    return {tuple(r) for r in got}


def corpus(rnd, docs, groups, words):
    weight = [1 / (k + 1) for k in range(words)]
    return [(" ".join(rnd.choices([f"w{chr(97 + k % 26) * (k // 26 + 1)}" for k in range(words)], weight, k=rnd.randrange(30))),
             rnd.choice(["a", "b", None]), f"s{rnd.randrange(groups)}") for _ in range(docs)]


def test_share_is_exact():
    rnd = random.Random(1)
    for _ in range(2000):
        total = rnd.randrange(1, rnd.choice([10, 10**6, 10**15, 10**16]))
        n = rnd.randrange(-divergence.SMOOTH, total + 1)
        n = max(0, n)
        assert divergence.share(np.array([n]), np.array([total]))[0] == 1 + 10**9 * (n + 5) // total


def test_tile_sums_are_those_of_the_whole_matrix():
    rnd = np.random.default_rng(2)
    for rows, terms, fill, split in [(1, 1, 1, 0), (5, 40, 0.2, 0), (33, 17, 0.02, 0), (70, 300, 0.01, 0), (40, 600, 0.3, 0), (20, 100, 0, 0), (90, 50, 0.1, 64), (300, 90, 0.05, 256)]:
        m = rnd.integers(1, 1000, (rows, terms)) * (rnd.random((rows, terms)) < fill)
        totals = m.sum(1) + divergence.SMOOTH * (terms + 3)
        row, col = np.nonzero(m)
        got = divergence.tile_sums(row, col, m[row, col], totals, terms, split)
        p = np.stack([divergence.share(m[r], np.full(terms, totals[r])) for r in range(rows)])
        for a in range(rows):
            for b in range(a + 1, rows):
                if not split or a < split <= b:
                    assert got[a, b] == np.abs(p[a] - p[b]).sum()


def test_empty_quadrants_are_not_entered():
    tree = divergence.Quadtree(np.array([0, 40]), np.array([0, 900]), 1024)
    assert tree.leaves == 2 and sum(map(len, tree.masks)) <= 2 * len(tree.masks)


def test_report_is_the_definition(spark, monkeypatch):
    rows = corpus(random.Random(3), 400, 7, 60) + [("É É straße Straße ÄB äb", "a", "only"), ("12 -- _", "z", "x"), (None, "z", None), ("w", "q", "y")]
    frame = spark.createDataFrame([(*r, "extra") for r in rows], "text string, lang string, source string, TERM string").repartition(6)
    want = brute(rows, 3)
    assert rows_of(divergence.Audit(frame, min_docs=3).report()) == want
    monkeypatch.setattr(divergence, "HELD", 50)
    monkeypatch.setattr(divergence, "TILE", 8)
    monkeypatch.setattr(divergence, "BLOCK", 2)
    assert {r for r in rows_of(divergence.Audit(frame, min_docs=3).report(top=5))} == brute(rows, 3, 5)


def test_edge_cases(spark, edge, none):
    assert divergence.Audit(none).report().count() == 0
    rows = [(r.text, r.lang, r.source) for r in edge.collect()]
    assert rows_of(divergence.Audit(edge, min_docs=1).report()) == brute(rows, 1)
    assert {r[4] for r in rows_of(divergence.Audit(edge).report())} == {0}
