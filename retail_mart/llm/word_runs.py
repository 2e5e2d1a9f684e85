"""Periodic runs of words, and texts with each run collapsed to its first period.

A run is a stretch of words with smallest period q and at least
max(MIN_WORDS, MIN_PERIODS * q) words that no neighbouring word extends
keeping period q. Every run holds a Lyndon word of q words that is, under one
of two opposite orders of the words, the longest Lyndon word at its place. So

1. ``lyndon_lengths`` groups the suffixes as the first phase of Baier's
   suffix sorter does; the final context of a suffix is the longest Lyndon
   word there. It runs once under each order.
2. A run of four periods holds its root at least three times in a row, so
   three equal neighbouring lengths tell a candidate root.
3. The common extension of the root's two copies to the left and right
   gives the run.

Grouping is skipped where no run can be: within a run of period q, the next
use of every word but the last q lies at most q words ahead, so a stretch of
words whose next uses are that near must exist (``repetitive_spans``; it
looks at all periods and loses none).

Edge cases: a null or empty text has no words and no runs and collapses to
the empty text; a null id stays null; repeated rows and equal ids are texts
of their own; a text is handled whole, whatever its length, in memory in
proportion to its words; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 6
MIN_PERIODS = 4
# Bytes of text in a returned batch.
BATCH_BYTES = 16 << 20
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SQL_RUN = "struct<start: long, length: long, period: long>"


def lyndon_lengths(ranks: list[int], n_ranks: int) -> list[int]:
    """Length of the longest Lyndon word at each place of ``ranks`` (numbers below ``n_ranks``).

    Groups hold the suffixes known to begin with the same context and are
    taken from the highest down. A suffix of the taken group leaves the list
    of open suffixes; its nearest open suffix to the left is of a lower group
    and takes the context over: with c neighbours of the group behind it, c
    contexts. Suffixes that grew alike form a new group right above their old
    one, the higher the more contexts they took.
    """
    n = len(ranks)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    length, group = [1] * n, list(ranks)
    members: list[list[int]] = [[] for _ in range(n_ranks)]
    for i, r in enumerate(ranks):
        members[r].append(i)
    below, above = list(range(-1, n_ranks - 1)), list(range(1, n_ranks + 1))
    g = n_ranks - 1
    while g >= 0:
        grown: dict[tuple[int, int], list[int]] = {}
        for i in members[g]:
            if group[i] != g:
                continue  # has left for another group
            j = left[i]
            if j >= 0 and group[j] == g:
                continue  # counted with the first of its neighbours
            count, r = 1, right[i]
            while r < n and group[r] == g:
                count += 1
                r = right[r]
            if r < n:
                left[r] = j
            if j >= 0:
                right[j] = r
                length[j] += count * length[i]
                grown.setdefault((count, group[j]), []).append(j)
        for key in sorted(grown, reverse=True) if len(grown) > 1 else grown:
            old, new = key[1], len(members)
            members.append(grown[key])
            for j in grown[key]:
                group[j] = new
            up = above[old]  # g at the highest, as old is below g
            below.append(old)
            above.append(up)
            below[up] = above[old] = new
        g = below[g]
    return length


def repetitive_spans(w: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint spans of the word numbers ``w`` such that every run lies in one of them with its neighbouring words."""
    n = len(w)
    if n < MIN_WORDS:
        return []
    order = np.argsort(w.astype(np.uint16) if w.max() < 1 << 16 else w, kind="stable")
    ahead = np.full(n, n)
    again = w[order[1:]] == w[order[:-1]]
    ahead[order[:-1][again]] = np.diff(order)[again]
    spans, low = [], 1
    while MIN_PERIODS * low <= n:
        high = 2 * low - 1  # periods low to high
        need = max(MIN_WORDS - high, (MIN_PERIODS - 1) * low)
        far = np.concatenate([[-1], np.flatnonzero(ahead > high), [n]])
        for k in np.flatnonzero(np.diff(far) > need).tolist():
            spans.append((max(0, int(far[k])), min(n, int(far[k + 1]) + high + 1)))
        low *= 2
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def _same(x: np.ndarray, y: np.ndarray) -> int:
    """Length of the longest common prefix of two arrays of one length."""
    at, step = 0, 64
    while at < len(x):
        differ = x[at:at + step] != y[at:at + step]
        k = int(differ.argmax())
        if differ[k]:
            return at + k
        at, step = at + step, 2 * step
    return len(x)


def word_runs(w: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs of the word numbers ``w`` as (start, length, period), by start, then period."""
    n, found = len(w), set()
    for a, b in repetitive_spans(w):
        values, rank = np.unique(w[a:b], return_inverse=True)
        places = np.arange(b - a)
        for ranks in (rank, len(values) - 1 - rank):
            q = np.array(lyndon_lengths(ranks.tolist(), len(values)))
            held = places + 2 * q < len(q)
            at, p = places[held], q[held]
            alike = (q[at + p] == p) & (q[at + 2 * p] == p) & (rank[at] == rank[at + p]) & (rank[at] == rank[at + 2 * p])
            ends: dict[int, int] = {}  # end of the last run of each period
            for i, p in zip((at[alike] + a).tolist(), p[alike].tolist(), strict=True):
                if i + p <= ends.get(p, 0):
                    continue  # a root of that run
                end = i + p + _same(w[i:n - p], w[i + p:])
                start = i - _same(w[p:i + p][::-1], w[:i][::-1])
                if end - start >= max(MIN_WORDS, MIN_PERIODS * p):
                    found.add((start, end - start, p))
                    ends[p] = end
    return sorted(found, key=lambda r: (r[0], r[2]))


def densest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of most periods (ties: smallest start, then period)."""
    best = None
    for r in runs:  # by start, then period
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def analysed(text: bytes | None) -> tuple[int, list[tuple[int, int, int]], bytes]:
    """(words, runs, words left joined by one blank) of a text in UTF-8."""
    words = (text or b"").split()  # at 0x20 and 0x09 to 0x0D
    number = {x: k for k, x in enumerate(dict.fromkeys(words))}
    w = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
    runs = word_runs(w)
    if runs:
        keep = np.ones(len(w), bool)
        for start, length, period in runs:
            keep[start + period:start + length] = False
        words = compress(words, keep.tolist())
    return len(w), runs, b" ".join(words)


def periodic_runs(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: (doc_id, n_words, runs, densest, collapsed); ``runs``
    is an array of (start, length, period) by start, then period, ``densest``
    the run of most periods or null, ``collapsed`` the text without what each
    run repeats."""

    def block(ids: list, rows: list) -> pa.RecordBatch:
        as_run = lambda r: dict(zip(("start", "length", "period"), r, strict=True)) if r else None
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array([r[0] for r in rows], pa.int64()),
            pa.array([[as_run(x) for x in r[1]] for r in rows], pa.list_(_RUN)),
            pa.array([as_run(densest(r[1])) for r in rows], _RUN),
            pa.array([r[2] for r in rows], pa.string())], ["doc_id", "n_words", "runs", "densest", "collapsed"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, rows, held = [], [], 0
            for d, body in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids.append(d)
                rows.append(analysed(body.as_py()))
                held += len(rows[-1][2])
                if held > BATCH_BYTES:
                    yield block(ids, rows)
                    ids, rows, held = [], [], 0
            if ids:
                yield block(ids, rows)

    d = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.encode(F.col(text).cast("string"), "UTF-8").alias("text"))
    return d.mapInArrow(each, f"doc_id long, n_words long, runs array<{_SQL_RUN}>, densest {_SQL_RUN}, collapsed string")
