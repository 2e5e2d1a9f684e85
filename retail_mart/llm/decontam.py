"""Benchmark decontamination: size-partitioned MinHash containment search.

Short test items are looked for inside long documents. Items are partitioned
by size (powers of two of their distinct five-word shingles). A partition has
one sketch size: with at most u shingles an item may miss
u - ceil(0.8 u) of them and still be contained, so the
u - ceil(0.8 u) + 1 smallest min-wise hashes of the item are its sketch and
every document that contains the item holds at least one of them (pigeonhole:
no false negatives, unlike a banded signature of the whole long document,
whose Jaccard similarity with a short item is near zero). A document that
holds a sketch hash is a candidate; exact shingle containment decides.

Edge cases: null or empty texts and items or documents with fewer than five
words have no shingle and never match; repeated rows each give their own
result; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_mart.llm.common import SIMILARITY, mix, normal, shingles, word_hashes

# Distinct (item, shingle) rows held by a worker at once; a larger benchmark is searched block by block.
BLOCK_SHINGLES = 2_000_000
_SEED = np.uint64(0x5DEECE66D)


def sketch_size(u: int, threshold: float = SIMILARITY) -> int:
    return u - math.ceil(threshold * u - 1e-9) + 1


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        items, sets = [], []
        for i, text in zip(b.column("item").to_pylist(), b.column("text").to_pylist(), strict=True):
            s = np.unique(shingles(word_hashes(normal(text))))
            if len(s):
                items.append(i)
                sets.append(s.view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(items, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
             pa.array(sets, pa.list_(pa.int64()))], ["item", "size", "shingles"])


class ItemIndex:
    """Sorted shingle -> items lists of one block of items, and their sketches."""

    def __init__(self, rows: list[tuple[int, np.ndarray]], threshold: float):
        self.ids = np.array([r[0] for r in rows], np.int64)
        self.sizes = np.array([len(r[1]) for r in rows], np.int64)
        h = np.concatenate([r[1] for r in rows])
        item = np.repeat(np.arange(len(rows)), self.sizes)
        sketch = []
        for _, s in rows:
            top = (1 << int(len(s)).bit_length()) - 1  # largest size of this size partition
            sketch.append(np.isin(s, s[np.argsort(mix(s ^ _SEED), kind="stable")[:min(len(s), sketch_size(top, threshold))]]))
        order = np.argsort(h, kind="stable")
        self.h, self.item, self.sketch = h[order], item[order], np.concatenate(sketch)[order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.h >> np.uint64(44)).astype(np.int64)] = True
        self.threshold = threshold

    def search(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items contained in a document with shingles ``s``, and how many of their shingles it has."""
        s = np.unique(s[self.maybe[(s >> np.uint64(44)).astype(np.int64)]])
        lo, hi = np.searchsorted(self.h, s, "left"), np.searchsorted(self.h, s, "right")
        n = hi - lo
        if not n.sum():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        found = self.item[at]
        candidates = np.unique(found[self.sketch[at]])
        both = np.bincount(found, minlength=len(self.ids))[candidates]
        keep = both >= self.threshold * self.sizes[candidates] - 1e-9
        return candidates[keep], both[keep]


def _blocks(items: DataFrame, threshold: float) -> Iterator[ItemIndex]:
    """Indexes of at most BLOCK_SHINGLES shingles (one item at least); the driver holds one block."""
    block: list[tuple[int, np.ndarray]] = []
    held = 0
    for r in items.select("item", "shingles").toLocalIterator():
        if block and held + len(r.shingles) > BLOCK_SHINGLES:
            yield ItemIndex(block, threshold)
            block, held = [], 0
        block.append((r.item, np.array(r.shingles, np.int64).view(np.uint64)))
        held += len(r.shingles)
    if block:
        yield ItemIndex(block, threshold)


def contained_items(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    item_id: str = "item_id", item_text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """One row (doc_id, item_id, shared, shingles, containment) for each
    document and each item whose shingles it contains at least to ``threshold``.

    ``items`` is indexed in blocks of bounded size, each broadcast and
    compared with all documents; documents are never shuffled.
    """
    spark = documents.sparkSession
    sets = items.select(F.col(item_id).cast("long").alias("item"), F.col(item_text).alias("text")).mapInArrow(
        _item_rows, "item long, size long, shingles array<long>")
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    schema = "doc_id long, item_id long, shared long, shingles long, containment double"
    out = spark.createDataFrame([], schema)
    for k, index in enumerate(_blocks(sets, threshold)):
        held = spark.sparkContext.broadcast(index)

        def search(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            ix = held.value
            for b in batches:
                d, it, n = [], [], []
                for doc, body in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                    got, both = ix.search(shingles(word_hashes(normal(body.as_py()))))
                    d += [doc] * len(got)
                    it.append(got)
                    n.append(both)
                i = np.concatenate([np.empty(0, np.int64), *it])
                c = np.concatenate([np.empty(0, np.int64), *n])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(d, pa.int64()), pa.array(ix.ids[i], pa.int64()), pa.array(c, pa.int64()),
                     pa.array(ix.sizes[i], pa.int64()), pa.array(c / ix.sizes[i], pa.float64())],
                    ["doc_id", "item_id", "shared", "shingles", "containment"])

        found = docs.mapInArrow(search, schema)
        out = found if k == 0 else out.union(found)
    return out


def decontaminate(documents: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """``documents`` without the rows that contain an item; all columns and all other rows stay."""
    spark = documents.sparkSession
    sets = items.select(F.col(item_id).cast("long").alias("item"), F.col(item_text).alias("text")).mapInArrow(
        _item_rows, "item long, size long, shingles array<long>")
    out, at = documents, documents.columns.index(text)
    for index in _blocks(sets, threshold):
        held = spark.sparkContext.broadcast(index)

        def clean(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ok = [not len(held.value.search(shingles(word_hashes(normal(t.as_py()))))[0]) for t in b.column(at)]
                yield b.filter(pa.array(ok, pa.bool_()))

        out = out.mapInArrow(clean, documents.schema)
    return out
