"""Exact top-k inner-product search over an impact-ordered index, score at a time.

Components become integers floor(scale * x). The index is cut into blocks of
vectors. A posting's impact is its component's distance from the lowest
component of its dimension (for positive query weights) or from the highest
(for negative ones), so impacts are never negative; a block's postings are
cut into segments of equal quantised impact. Segments are processed by
descending impact, for a group of queries at once: a vector's accumulator
holds the weighted impacts seen so far, and what it may still gain is at most
the query's weights times the largest unprocessed impacts. A query stops only
when at most a small part of the block can still reach the k-th best
accumulator; those possible members are rescored with exact integer products.
Without such a proof all segments are processed, and the bound is exact.

Edge cases: vectors that are null, empty or hold null or non-finite
components, and rows with a null id, take no part; vectors of different
lengths are not compared; ties go to the smaller id; equal rows are
candidates of their own, but rows with one id are one query (its smallest
vector), and a query does not find rows with its own id; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_mart.llm.common import cut

BLOCK_ROWS = 4096
QUERY_BLOCK = 2048
LEVELS = 8
# Queries whose accumulators are held at once.
GROUP = 256
# Fewer possible members than this part of a block are rescored.
SMALL_PART = 1 / 16


class ImpactIndex:
    """The postings of one block of vectors, in LEVELS segments of equal quantised impact."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.v = ids, vectors.astype(np.int64)
        self.low, self.high = self.v.min(0), self.v.max(0)
        span = np.concatenate([self.high - self.low] * 2)
        step = np.maximum(1, -(-(span + 1) // LEVELS))
        # impacts for positive weights, then for negative ones
        impact = np.concatenate([self.v - self.low, self.high - self.v], axis=1)
        level = impact // step
        # sums stay below 2^53, so doubles are exact
        self.segments = [np.where(level == x, impact, 0).astype(np.float64).T for x in range(LEVELS)]
        self.reach = [np.minimum((x + 1) * step - 1, span).astype(np.float64) for x in range(LEVELS)]

    def top(self, q: np.ndarray, k: int, own: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query (row of q): ids and exact scores of the k best rows but its own, ties to smaller ids."""
        out = []
        for at in range(0, len(q), GROUP):
            out += self._group(q[at:at + GROUP], k, own[at:at + GROUP])
        return out

    def _group(self, q: np.ndarray, k: int, own: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        weights = np.concatenate([np.maximum(q, 0), np.maximum(-q, 0)], axis=1).astype(np.float64)
        worst = np.maximum(q, 0) @ self.low - np.maximum(-q, 0) @ self.high
        acc = np.repeat(worst.astype(np.float64)[:, None], len(self.ids), axis=1)
        acc[self.ids == own[:, None]] = -np.inf
        found: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64),) * 2] * len(q)
        left = np.arange(len(q))
        for x in reversed(range(LEVELS)):
            acc[left] += weights[left] @ self.segments[x]
            more = weights[left] @ self.reach[x - 1] if x else np.zeros(len(left))
            going = []
            for i, gain in zip(left, more, strict=True):
                others = int(np.isfinite(acc[i]).sum())
                n = min(k, others)
                if not n:
                    continue
                bar = np.partition(acc[i], len(self.ids) - n)[len(self.ids) - n]
                possible = np.flatnonzero(acc[i] + gain >= bar)
                possible = possible[np.isfinite(acc[i, possible])]
                if x and len(possible) > max(n, SMALL_PART * len(self.ids)):
                    going.append(i)
                    continue
                score = self.v[possible] @ q[i]
                best = np.lexsort((self.ids[possible], -score))[:n]
                found[i] = self.ids[possible][best], score[best]
            left = np.array(going, np.int64)
            if not len(left):
                break
        return found


def quantised(embedding: Column, scale: int) -> Column:
    """floor(scale * x) of every component as a double; null where the vector takes no part."""
    x = F.transform(embedding, lambda c: c.cast("double"))
    fine = embedding.isNotNull() & ~F.exists(embedding, lambda c: c.isNull()) & ~F.exists(
        x, lambda c: F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(F.coalesce(fine, F.lit(False)), F.transform(x, lambda c: F.floor(c * F.lit(float(scale)))))


def top_k(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 5,
          scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best other rows for each row where ``is_query``.

    Blocks of queries meet every block of the index; a task holds one index
    block and one block of queries, and passes on k rows a query.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), quantised(F.col(embedding), scale).alias("v"),
                          F.coalesce(is_query, F.lit(False)).alias("query"))
    rows = cut(rows.filter((F.size("v") > 0) & F.col("vec_id").isNotNull()))
    counts = rows.agg(F.count("*").alias("n"), F.sum(F.col("query").cast("long")).alias("q")).first()
    out = "query_id long, rank int, vec_id long, score long"
    if not counts.n or not counts.q:
        return spark.createDataFrame([], out)
    blocks, groups = -(-counts.n // BLOCK_ROWS), -(-counts.q // QUERY_BLOCK)

    def dealt(df: DataFrame, n: int) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")

    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    index = rows.select(dealt(rows, blocks).alias("block"), F.size("v").alias("dims"), "vec_id", "v").withColumn("group", each(groups))
    asked = rows.filter("query").groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = asked.select(dealt(rows, groups).alias("group"), F.size("v").alias("dims"), "vec_id", "v").withColumn("block", each(blocks))
    keys = ["block", "group", "dims"]
    pairs = "query_id long, vec_id long, score long"

    def search(key: tuple, table: pa.Table, queries: pa.Table) -> pa.Table:
        q, v, s = [], [], []
        if table.num_rows and queries.num_rows:
            flat = lambda t: np.asarray(t.column("v").combine_chunks().flatten()).reshape(t.num_rows, -1)
            order = np.argsort(np.asarray(table.column("vec_id")), kind="stable")
            ix = ImpactIndex(np.asarray(table.column("vec_id"))[order], flat(table)[order])
            own = np.asarray(queries.column("vec_id"))
            for one, (ids, score) in zip(own.tolist(), ix.top(flat(queries), k, own), strict=True):
                q += [one] * len(ids)
                v.append(ids)
                s.append(score)
        none = np.empty(0, np.int64)
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": np.concatenate([none, *v]), "score": np.concatenate([none, *s])})

    found = index.groupBy(keys).cogroup(asked.groupBy(keys)).applyInArrow(search, pairs)
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
