"""Near-duplicate classes by Order MinHash and banded alignment.

A text's k-mers are its runs of five words, labelled with their occurrence
number so that repeats differ. Each of SKETCHES hash orders picks the
PICKED smallest labelled k-mers; read in text order they give one key, so two
texts agree on a key when they share the picked passages in the same order,
which grows with edit similarity rather than with set overlap. Texts that
share a key are compared with the key's leader (its smallest digest) by a
banded alignment of their words: similar at 1 - distance / longer length of
0.8 or more. Classes are the connected components of equal and similar texts.

Few words have few k-mers, and an edit spoils five of them. So a text of fewer
than SHORT words has each of its runs of SHORT_RUN words as a key, too: two
such texts of 0.8 or more always share one. A text of 5 to 9 words, where 0.8
allows one edit, has its words without each one, with the place, as keys, and
one of 4 to 9 words all its words with each place: all texts of such a key are
similar to each other. Longer texts meet by chance: of pairs of 300 words,
that of 64 sketches is about 1 at a similarity of 0.85 and 0.9 at 0.80.

A text that fails against a leader shares some passage with it, often one
that very many texts share. Its k-mers that no such leader has are sketched
again, once a round, and the next round compares the texts that share such a key, until no
keys are shared any more: texts that are similar beyond the
common passage still meet, those that only share the passage don't. Each
round has one pair per text and key, so hot passages and large groups of
copies stay linear; copies are one text (their md5) before any pair is
formed, and no cap is set on any group.

Edge cases: a null text is a class of its own row; texts without a word are
similar to equal texts only; texts with fewer than five words have one k-mer,
all their words; equal rows are one text, and exactly one row of a class is
kept; null ids count as larger than any other; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_mart.llm.common import (
    SHINGLE_WORDS, SIMILARITY, components, cut, free_name, mix, normal, shingles, word_hashes,
)

SKETCHES, PICKED = 64, 2
# Words below which a text's short runs are keys.
SHORT, SHORT_RUN = 40, 3
_SEEDS = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
# k-mers of a text that are ordered at a time
_PIECE = 1 << 16


def kmers(body: bytes) -> np.ndarray:
    """Hashes of the k-mers of a ``normal`` text, in text order."""
    hs = word_hashes(body)
    return shingles(hs, min(SHINGLE_WORDS, len(hs))) if len(hs) else hs


def sketch_keys(mers: np.ndarray) -> np.ndarray:
    """The Order-MinHash keys of a sequence of k-mers (none: no keys)."""
    if not len(mers):
        return np.empty(0, np.uint64)
    order = np.argsort(mers, kind="stable")
    s = mers[order]
    at = np.arange(len(s))
    label = np.empty(len(s), np.uint64)
    label[order] = at - np.maximum.accumulate(np.where(np.concatenate([[True], s[1:] != s[:-1]]), at, 0))
    repeats = label > 0
    labelled = mers.copy()
    labelled[repeats] = mix(labelled[repeats] + label[repeats])
    every, n = np.arange(SKETCHES), min(PICKED, len(mers))
    best = np.zeros((SKETCHES, 0), np.int64)
    for p in range(0, len(mers), _PIECE):
        piece = labelled[p:p + _PIECE]
        # an order of the (already mixed) k-mers for each odd multiplier
        h = np.concatenate([labelled[best] * _SEEDS[:, None], piece * _SEEDS[:, None]], axis=1)
        picks = []
        for _ in range(min(n, h.shape[1])):
            picks.append(h.argmin(1))
            h[every, picks[-1]] = np.uint64(0xFFFFFFFFFFFFFFFF)
        pick, old = np.stack(picks, axis=1), best.shape[1]
        known = np.take_along_axis(best, np.minimum(pick, old - 1), axis=1) if old else pick
        best = np.where(pick < old, known, pick - old + p)
    best.sort(axis=1)
    key = _SEEDS.copy()
    for j in range(best.shape[1]):
        key = mix(key ^ mers[best[:, j]])
    return key


def short_keys(hs: np.ndarray) -> np.ndarray:
    """Further keys of a text of few words (their hashes)."""
    n = len(hs)
    out = [np.empty(0, np.uint64)]
    if 2 * SHORT_RUN < n < SHORT:
        out.append(mix(np.unique(shingles(hs, SHORT_RUN)) ^ _SEEDS[0]))
    if SHINGLE_WORDS - 1 <= n < 2 * SHINGLE_WORDS:
        # the words without that at i, or all as those of a longer text without its word at i
        gaps = [(i, np.delete(hs, i)) for i in range(n) if n >= SHINGLE_WORDS] + [(i, hs) for i in range(n + 1)]
        out.append(np.array([shingles(np.append(w, np.uint64(i)), len(w) + 1)[0] for i, w in gaps], np.uint64))
    return np.concatenate(out)


def text_keys(body: bytes) -> np.ndarray:
    """All keys of a ``normal`` text in the first round."""
    return np.concatenate([sketch_keys(kmers(body)), short_keys(word_hashes(body))])


def _parts(body: bytes) -> list[np.ndarray]:
    """The k-mers of a text, and its short runs if it has few words."""
    hs = word_hashes(body)
    return [kmers(body), *([shingles(hs, SHORT_RUN)] if 2 * SHORT_RUN < len(hs) < SHORT else [])]


def shared_parts(own: bytes, leader: bytes) -> np.ndarray:
    """The k-mers and short runs of ``own`` that ``leader`` has, too."""
    hs = word_hashes(leader)
    theirs = np.concatenate([kmers(leader), shingles(hs, SHORT_RUN)] if len(hs) < 2 * SHORT else [kmers(leader)])
    return np.unique(np.concatenate([p[np.isin(p, theirs)] for p in _parts(own)]))


def rest_keys(own: bytes, gone: np.ndarray) -> np.ndarray:
    """The keys of ``own`` without the k-mers and short runs in ``gone``."""
    return np.concatenate([sketch_keys(p[~np.isin(p, gone)]) for p in _parts(own)])


def edit_distance(a: list[bytes], b: list[bytes], most: int) -> int | None:
    """Edit distance of two word lists if it is at most ``most``, else None.

    Common ends are dropped; the alignment is confined to a band of diagonals
    that is widened until the distance lies within it. A column's vertical
    differences in the band are two bit vectors (Hyyrö's band that moves
    along the diagonal).
    """
    if abs(len(a) - len(b)) > most:
        return None
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    a, b = a[i:], b[i:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not a or not b:
        return len(a) + len(b)
    where: dict[bytes, int] = defaultdict(int)
    for r, w in enumerate(a):
        where[w] |= 1 << r
    band = max(8, abs(len(a) - len(b)))
    while True:
        t = min(band, most)
        d = _in_band(where, len(a), b, t)
        if d <= t:
            return d
        if t == most:
            return None
        band *= 4


def _in_band(where: dict[bytes, int], m: int, b: list[bytes], t: int) -> int:
    """Distance along paths within ``t`` diagonals; right if it is at most ``t``."""
    ones = (1 << (2 * t + 1)) - 1
    vp, vn, top, score = (ones >> t) << t, 0, 2 * t, t
    for j, w in enumerate(b, 1):
        x = where.get(w, 0)
        shift = j - t - 1
        x = (x >> shift if shift >= 0 else x << -shift) & ones
        d0 = (((x & vp) + vp) ^ vp | x | vn) & ones
        hp = (vn | ~(d0 | vp)) & ones
        hn = vp & d0
        score += 1 - (d0 >> top & 1)
        d1 = d0 >> 1
        vp = (hn | ~(d1 | hp)) & ones
        vn = d1 & hp
    # from row len(b) + t up to row m of the last column
    rows = ones >> 1 & ~((1 << max(0, m - len(b) + t)) - 1)
    return score - (vp & rows).bit_count() + (vn & rows).bit_count()


def similarity(a: list[bytes], b: list[bytes], threshold: float = SIMILARITY) -> float | None:
    """Edit similarity of two word lists if it reaches ``threshold``."""
    longer = max(len(a), len(b))
    if not longer:
        return 1.0
    d = edit_distance(a, b, int((1 - threshold) * longer + 1e-9))
    return None if d is None else 1 - d / longer


def _sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys = [text_keys(normal(t.as_py())).view(np.int64) for t in b.column("text")]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("digest"), pa.array(keys, pa.list_(pa.int64()))],
                                         ["doc_id", "digest", "keys"])


def _verify_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Similarity of each pair; where it is too low, what a shares with b."""
    last: tuple[bytes | None, bytes] = (None, b"")
    for b in batches:
        got, shared = [], []
        for i in range(b.num_rows):
            leader = b.column("b")[i].as_py()
            if last[0] != leader:
                last = (leader, normal(b.column("text_b")[i].as_py()))
            own = normal(b.column("text_a")[i].as_py())
            got.append(similarity(own.split(), last[1].split()))
            shared.append(shared_parts(own, last[1]).view(np.int64) if got[-1] is None else None)
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(got, pa.float64()), pa.array(shared, pa.list_(pa.int64()))],
                                         ["a", "b", "similarity", "shared"])


def _rest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys = [rest_keys(normal(t.as_py()), g.values.to_numpy(zero_copy_only=False).view(np.uint64)).view(np.int64)
                for t, g in zip(b.column("text"), b.column("gone"), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(keys, pa.list_(pa.int64()))], ["digest", "keys"])


def _verified(pairs: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``pairs`` (a, b) of digests with their similarity, and what they share where it is below 0.8; the texts of their digests."""
    need = pairs.select(F.col("a").alias("digest")).union(pairs.select("b")).distinct()
    some = cut(texts.join(need, "digest", "left_semi").dropDuplicates(["digest"]))
    wide = (pairs.join(some.select(F.col("digest").alias("a"), F.col("text").alias("text_a")), "a")
            .join(some.select(F.col("digest").alias("b"), F.col("text").alias("text_b")), "b"))
    return cut(wide.select("a", "b", "text_a", "text_b").mapInArrow(
        _verify_rows, "a binary, b binary, similarity double, shared array<long>")), some


def _classes(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, digest, label) of the rows with a text; equal labels: one class."""
    spark = documents.sparkSession
    t = F.col(text).cast("string")
    texts = documents.filter(t.isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"),
                                                   F.unhex(F.md5(t.cast("binary"))).alias("digest"), t.alias("text"))
    rows = cut(texts.mapInArrow(_sketch_rows, "doc_id long, digest binary, keys array<long>"))
    keys = rows.groupBy("digest").agg(F.first("keys").alias("keys")).select("digest", F.explode("keys").alias("key"))
    links = done = gone = None
    while True:
        leaders = keys.groupBy("key").agg(F.min("digest").alias("b"), F.max("digest").alias("most")).filter("b != most").drop("most")
        pairs = keys.join(leaders, "key").filter(F.col("digest") != F.col("b")).select(F.col("digest").alias("a"), "b").distinct()
        pairs = cut(pairs if links is None else pairs.join(done, ["a", "b"], "left_anti"))
        if links is not None and not pairs.limit(1).count():
            break
        tried, some = _verified(pairs, texts.select("digest", "text"))
        found = tried.filter(F.col("similarity").isNotNull()).select("a", "b")
        links = found if links is None else links.union(found)
        done = tried.select("a", "b") if done is None else done.union(tried.select("a", "b"))
        # a text's rest is what no leader that it failed against has; it shrinks each round
        lost = tried.filter(F.col("similarity").isNull()).select(F.col("a").alias("digest"), "shared")
        again = lost.select("digest").distinct()
        lost = lost if gone is None else lost.union(gone.join(again, "digest", "left_semi"))
        gone = cut(lost.groupBy("digest").agg(F.array_distinct(F.flatten(F.collect_list("shared"))).alias("shared")))
        rest = some.join(gone.withColumnRenamed("shared", "gone"), "digest").select("digest", "text", "gone")
        keys = cut(rest.mapInArrow(_rest_rows, "digest binary, keys array<long>")).select("digest", F.explode("keys").alias("key"))
    labels = components(links, spark)
    out = rows.select("doc_id", "digest").join(labels.withColumnRenamed("node", "digest"), "digest", "left")
    return out.select("doc_id", "digest", F.coalesce("label", "digest").alias("label"))


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, class_id (the smallest id of its class), class_size, kept (its id is the class's)."""
    c = cut(_classes(documents, doc_id, text))
    of = c.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    out = c.join(of, "label").select("doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))
    alone = documents.filter(F.col(text).isNull()).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(doc_id).cast("long").alias("class_id"),
                                                          F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept"))
    return out.union(alone)


def deduplicated(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` with exactly one row of each class, the one with the smallest id; null texts stay."""
    c = cut(_classes(documents, doc_id, text))
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("digest"))
    kept = c.groupBy("label").agg(F.min(first).alias("k")).select("k.doc_id", "k.digest")
    same = c.groupBy("digest", "doc_id").agg(F.count("*").alias("n"))
    kept = kept.join(same, kept["digest"].eqNullSafe(same["digest"]) & kept["doc_id"].eqNullSafe(same["doc_id"])).select(kept["digest"], kept["doc_id"], "n")
    d, i, n = (free_name(documents, x) for x in ("digest", "kept_id", "n"))
    kept = kept.select(F.col("digest").alias(d + "_"), F.col("doc_id").alias(i), F.col("n").alias(n))
    t = F.col(text).cast("string")
    own = documents.filter(t.isNotNull()).withColumn(d, F.unhex(F.md5(t.cast("binary"))))
    found = own.join(kept, (own[d] == kept[d + "_"]) & own[doc_id].cast("long").eqNullSafe(kept[i]))
    single = found.filter(F.col(n) == 1).select(*documents.columns)
    repeated = found.filter(F.col(n) > 1).dropDuplicates([d]).select(*documents.columns)
    return single.union(repeated).union(documents.filter(t.isNull()))
