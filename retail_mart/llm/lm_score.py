"""Cross-entropy difference: how much more a document looks like the target texts than like the corpus.

Two n-gram models over one closed vocabulary, the 256 bytes of lower-cased
UTF-8: the target's from the rows marked as target, the background's from all
rows. Both have order ORDER and Witten-Bell interpolation down to the uniform
distribution, and both are counted over whole texts of all rows. A token's
(byte's) loss is -log2 of its probability; a document's score is the mean of
target loss minus background loss over its tokens (lower: nearer the target).

Scale: rows are packed into stored blocks of about BLOCK_BYTES by position,
whatever their ids, so no key is hot. Counting passes on each block's distinct
n-grams, not its tokens; the models are tables built by Spark; scoring joins a
block's n-grams with their losses and sends each block the slice of the models
that it needs. The models are neither collected nor broadcast.

Edge cases: a null or empty text has 0 tokens and null losses; without target
rows the target model is uniform; repeated ids in the target table count
once, repeated rows of the corpus each count; rows with a null id are never
target; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_mart.llm.common import cut

ORDER = 4
BLOCK_BYTES = 6 << 20
# Text bytes of a piece of a very long text; a piece carries the bytes before it as context.
PIECE = 2 << 20
# Tokens of a block counted or scored at a time.
CHUNK = 1 << 20
_LEAD = b"\n" * (ORDER - 1)


def _pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks: the rows' ids and the texts' pieces, each piece with its context in front."""
    rows: list[int] = []
    ids: list[int | None] = []
    sizes: list[int] = []
    pieces: list[bytes] = []
    held = 0

    def block() -> pa.RecordBatch:
        body = zstandard.ZstdCompressor(level=1).compress(b"".join(pieces))
        return pa.RecordBatch.from_arrays(
            [pa.array([uuid.uuid4().hex]), pa.array([rows], pa.list_(pa.string())), pa.array([ids], pa.list_(pa.int64())),
             pa.array([sizes], pa.list_(pa.int32())), pa.array([body], pa.binary())], ["block", "rows", "ids", "sizes", "body"])

    for b in batches:
        for d, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            row, raw = uuid.uuid4().hex, (t.as_py() or "").lower().encode()
            for at in range(0, max(1, len(raw)), PIECE):
                piece = raw[max(0, at - ORDER + 1):at].rjust(ORDER - 1, b"\n") + raw[at:at + PIECE]
                rows.append(row)
                ids.append(d)
                sizes.append(len(piece))
                pieces.append(piece)
                held += len(piece)
                if held >= BLOCK_BYTES:
                    yield block()
                    rows, ids, sizes, pieces, held = [], [], [], [], 0
    if rows:
        yield block()


def _grams(body: bytes, sizes: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The n-grams that end at the tokens of a block's pieces, and their piece, CHUNK at a time."""
    s = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    n = len(s) - ORDER + 1
    for lo in range(0, n, CHUNK):
        hi = min(n, lo + CHUNK)
        g = s[lo:hi].astype(np.uint32)
        for k in range(1, ORDER):
            g <<= np.uint32(8)
            g |= s[lo + k:hi + k]
        piece = np.repeat(np.arange(len(sizes), dtype=np.int32), np.diff(np.clip(bounds, lo, hi)))
        # drop those that run over the end of a piece
        inside = np.ones(hi - lo, bool)
        for k in range(1, ORDER):
            over = bounds[1:] - k - lo
            inside[over[(over >= 0) & (over < hi - lo)]] = False
        yield g[inside], piece[inside]


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            block, sizes, body, marked = (b.column(c)[i].as_py() for c in ("block", "sizes", "body", "marked"))
            target = np.zeros(len(sizes), bool)
            target[np.array(marked or [], np.int64)] = True
            own, t, n = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)
            for g, piece in _grams(body, sizes):
                new, m = np.unique(g, return_counts=True)
                mine, k = np.unique(g[target[piece]], return_counts=True)
                both = np.union1d(own, new)
                seen = [np.zeros(len(both), np.int64) for _ in range(2)]
                for total, grams, counts in ((seen[0], own, t), (seen[0], mine, k), (seen[1], own, n), (seen[1], new, m)):
                    total[np.searchsorted(both, grams)] += counts
                own, (t, n) = both, seen
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(own), pa.string()), pa.array(own.astype(np.int64)), pa.array(t), pa.array(n)],
                                             ["block", "gram", "target", "background"])


def _score_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            rows, ids, sizes, body = (b.column(c)[i].as_py() for c in ("rows", "ids", "sizes", "body"))
            cols = b.column("slice")[i].values
            known, loss_t, loss_b = (np.asarray(cols.field(k)) if cols is not None else np.empty(0) for k in range(3))
            order = np.argsort(known)
            ranked = known[order]
            many = len(sizes)
            n, t, back = np.zeros(many, np.int64), np.zeros(many), np.zeros(many)
            for g, piece in _grams(body, sizes):
                at = order[np.searchsorted(ranked, g)]
                n += np.bincount(piece, minlength=many)
                t += np.bincount(piece, loss_t[at], many)
                back += np.bincount(piece, loss_b[at], many)
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(ids, pa.int64()), pa.array(n), pa.array(t), pa.array(back)],
                                             ["row", "doc_id", "n", "t", "b"])


def losses(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, target_loss, background_loss) from n-gram counts (gram, target, background)."""
    lower = None
    for k in range(1, order + 1):
        c = counts.groupBy(F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("g")).agg(*[F.sum(m).alias(m) for m in ("target", "background")])
        c = c.withColumn("ctx", F.shiftright("g", 8))
        seen = c.groupBy("ctx").agg(*[e for m in ("target", "background") for e in
                                      (F.sum(m).alias(f"n_{m}"), F.sum((F.col(m) > 0).cast("long")).alias(f"d_{m}"))])
        j = c.join(seen, "ctx")
        if lower is None:
            j = j.withColumn("l_target", F.lit(1 / 256)).withColumn("l_background", F.lit(1 / 256))
        else:
            j = j.withColumn("short", F.col("g").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1))).join(
                lower.select(F.col("g").alias("short"), F.col("p_target").alias("l_target"), F.col("p_background").alias("l_background")), "short")
        p = lambda m: F.when(F.col(f"n_{m}") > 0, (F.col(m) + F.col(f"d_{m}") * F.col(f"l_{m}")) / (F.col(f"n_{m}") + F.col(f"d_{m}"))).otherwise(F.col(f"l_{m}"))
        lower = j.select("g", p("target").alias("p_target"), p("background").alias("p_background"))
    return lower.select(F.col("g").alias("gram"), (-F.log2("p_target")).alias("target_loss"), (-F.log2("p_background")).alias("background_loss"))


def score(documents: DataFrame, target_ids: DataFrame, doc_id: str = "doc_id", text: str = "text", target_id: str | Column = "doc_id") -> DataFrame:
    """Per row: doc_id, n_tokens, target_loss, background_loss, score. target_ids: ids of the target's rows."""
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    blocks = cut(docs.mapInArrow(_pack_rows, "block string, rows array<string>, ids array<long>, sizes array<int>, body binary"))
    places = blocks.select("block", F.posexplode("ids").alias("place", "id")).filter("id is not null")
    wanted = target_ids.select(F.col(target_id) if isinstance(target_id, str) else target_id).toDF("id").distinct()
    marked = places.join(wanted, "id", "left_semi").groupBy("block").agg(F.collect_list("place").alias("marked"))
    grams = cut(blocks.select("block", "sizes", "body").join(marked, "block", "left")
                .mapInArrow(_count_rows, "block string, gram long, target long, background long"))
    table = cut(losses(grams.groupBy("gram").agg(F.sum("target").alias("target"), F.sum("background").alias("background"))))
    # a block's slice holds the distinct n-grams of at most its bytes
    slices = grams.select("block", "gram").join(table, "gram").groupBy("block").agg(
        F.collect_list(F.struct("gram", F.col("target_loss").cast("float").alias("t"), F.col("background_loss").cast("float").alias("b"))).alias("slice"))
    pieces = blocks.join(slices, "block", "left").mapInArrow(_score_rows, "row string, doc_id long, n long, t double, b double")
    # a text is several pieces only if it is longer than PIECE or runs over the end of a block
    rows = pieces.groupBy("row").agg(F.first("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in ("n", "t", "b")])
    mean = lambda c: F.when(F.col("n") > 0, F.col(c) / F.col("n"))
    return rows.select("doc_id", F.col("n").alias("n_tokens"), mean("t").alias("target_loss"), mean("b").alias("background_loss"),
                       (mean("t") - mean("b")).alias("score"))
