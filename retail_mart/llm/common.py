"""Helpers shared by the operators of this package."""

from __future__ import annotations

import re
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_mart.session import shared_dir

SHINGLE_WORDS = 5
SIMILARITY = 0.8
_WORD = re.compile(r"\w+")
_MULT = np.uint64(0x9E3779B97F4A7C15)
# Bytes of ASCII word characters stay, other ASCII becomes a blank.
_BLANKED = bytes(b if b >= 128 or chr(b).isalnum() or b == 95 else 32 for b in range(256))
# Text of ASCII and U+00C0 to U+017F: all of its non-ASCII characters but two are letters.
_LATIN = bytes([*range(128), 0xC3, 0xC4, 0xC5, *range(0x80, 0xC0)])
# Bytes hashed at a time; a longer text is cut at a blank.
_PIECE = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_dir(spark: SparkSession, prefix: str) -> str:
    """A fresh sub-folder of the shared folder."""
    return shared_dir(spark, f"{prefix}-{uuid.uuid4().hex[:12]}")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage
    ends there and an executor's loss costs only its running tasks."""
    path = run_dir(df.sparkSession, "llm-cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def normal(text: str | None) -> bytes:
    """The lower-cased word runs of the whole text in UTF-8, with blanks between (null: none)."""
    if not text:
        return b""
    raw = text.lower().encode("utf-8", "replace")
    if not raw.translate(None, _LATIN) and b"\xc3\x97" not in raw and b"\xc3\xb7" not in raw:
        return raw.translate(_BLANKED)
    return " ".join(_WORD.findall(text.lower())).encode("utf-8", "replace")


def words(text: str | None) -> list[bytes]:
    """Lower-cased word runs of the whole text (null: none)."""
    return normal(text).split()


_powers: list[np.ndarray] = []


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        base, size = int(_MULT), max(n, _PIECE + 1)
        _powers[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, x, np.uint64)]))
                      for x in (base, pow(base, -1, 1 << 64))]
    return _powers[0][:n], _powers[1]


def word_hashes(body: bytes) -> np.ndarray:
    """A stable 64-bit hash of each word of a ``normal`` text."""
    out, at = [np.empty(0, np.uint64)], 0
    while at < len(body):
        end = min(len(body), at + _PIECE)
        if end < len(body):
            blank = body.rfind(b" ", at, end)
            blank = blank if blank > at else body.find(b" ", end)
            end = blank if blank > 0 else len(body)
        out.append(_piece_hashes(np.frombuffer(body, np.uint8, end - at, at)))
        at = end
    return out[1] if len(out) == 2 else np.concatenate(out)


def _piece_hashes(b: np.ndarray) -> np.ndarray:
    inside = np.concatenate([[False], b != 32, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    power, inverse = _power(len(b))
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[b] * power)])
    return mix((run[ends] - run[starts]) * inverse[starts])


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: a bijection that spreads all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _MULT)


def shingles(hs: np.ndarray, k: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of all runs of ``k`` words, in text order, repeats kept; fewer
    than ``k`` words give none."""
    n = len(hs) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hs[:n].copy()
    for j in range(1, k):
        out *= _MULT
        out += hs[j:j + n]
    return mix(out)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have (names clash ignoring case)."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = f"_{stem}"
    return stem


def components(edges: DataFrame, spark: SparkSession) -> DataFrame:
    """Connected components of ``edges`` (a, b): one row (node, label) per
    node, label = the smallest node.

    Each round takes the smallest label among the neighbours, then jumps to
    that label's own label, and is written to the shared folder; the number
    of rounds grows with the logarithm of a component's diameter. Only a
    count of changed labels reaches the driver.
    """
    both = cut(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    label = both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label"))
    label = cut(label)
    while True:
        near = (both.join(label.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        step = label.join(near, "node").select("node", F.col("label").alias("was"),
                                               F.least("label", "near").alias("label"))
        jump = label.select(F.col("node").alias("label"), F.col("label").alias("far"))
        step = cut(step.join(jump, "label", "left")
                   .select("node", "was", F.least("label", "far").alias("label")))
        changed = step.filter(F.col("was") != F.col("label")).limit(1).count()
        label = step.select("node", "label")
        if not changed:
            return label
