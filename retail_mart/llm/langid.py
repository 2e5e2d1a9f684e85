"""Language ID by prediction by partial matching (PPM).

One byte context tree per language holds the counts of every context of 0 to
``ORDER`` bytes in a sample of that language. The statistics are frozen, so
the code length of a byte depends on its context alone: in the longest known
context the byte costs -log2(c / (n + d)) when it was seen there, else the
escape -log2(d / (n + d)) is paid and the next shorter context decides
(n: bytes, d: distinct bytes seen in the context; method C, no exclusions);
below the empty context all 256 bytes are equally likely. Text is lower-cased
UTF-8. The language with the shortest exact code length of the whole text
wins; ties go to the first name.

Since statistics are frozen, the escape chains are folded once into tables
indexed by (context node, byte), and a whole batch is scored by array look-ups.

Training rows: whole texts of each language in the order of their hashes,
until DOCS_PER_LANG texts or LANG_CHARS characters are reached, one text at
least. Languages are all names in the rows to learn from; trees are built and
scored for LANGS_AT_ONCE of them at a time, each group a pass over the rows
that keeps the best language so far, so their number has no limit and a
task holds the trees of one group.

Edge cases: a null text, or one without a letter, is ``und`` with score 0;
rows without a language are not learned from; with nothing to learn from all
rows are ``und``; other columns pass through unread.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_mart.llm.common import free_name

ORDER = 3
DOCS_PER_LANG = 400
LANG_CHARS = 2_000_000
LANGS_AT_ONCE = 16
# Leading bits of a hash by which texts are counted before they are ranked.
PREFIX_BITS = 12
# Text bytes scored at a time; a longer text is scored in pieces that overlap by the context length.
CHUNK = 1 << 20
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


class PPM:
    """Folded tables: cost[l, node, byte], the nodes being the order-2 contexts
    and the order-3 contexts seen in any language."""

    def __init__(self, samples: dict[str, list[bytes]]):
        self.langs = sorted(samples)
        used = np.unique(np.frombuffer(b"".join(b for bs in samples.values() for b in bs) + b"\n", np.uint8))
        self.code = np.zeros(256, np.int32)  # bytes never seen share code 0
        self.code[used] = np.arange(1, len(used) + 1)
        a = self.a = len(used) + 1
        seqs = {lang: [self.code[np.frombuffer(b"\n" * ORDER + b, np.uint8)].astype(np.int64) for b in samples[lang]]
                for lang in self.langs}
        grams3 = {lang: [(s[:-3] * a + s[1:-2]) * a + s[2:-1] for s in ss] for lang, ss in seqs.items()}
        seen = np.unique(np.concatenate([g for gs in grams3.values() for g in gs] or [np.empty(0, np.int64)]))
        self.node3 = np.zeros(a ** 3, np.int32)  # 0: no language knows this context
        self.node3[seen] = np.arange(1, len(seen) + 1)
        self.low, self.high = [], []
        for lang in self.langs:
            s = np.concatenate(seqs[lang])
            ctx = np.concatenate(grams3[lang])
            sym = np.concatenate([x[3:] for x in seqs[lang]])
            cost = np.full((1, a), 8.0)  # one of 256 bytes
            cost = self._fold(np.zeros(len(sym), np.int64), sym, 1, cost)
            cost = self._fold(ctx % a, sym, a, np.repeat(cost, a, axis=0))
            # order 2: its order-1 suffix is the last byte of the context
            cost = self._fold(ctx % (a * a), sym, a * a, np.tile(cost, (a, 1)))
            low = cost
            below = low[seen % (a * a)] if len(seen) else np.empty((0, a))
            high = self._fold(self.node3[ctx] - 1, sym, len(seen), below)
            self.low.append(low.astype(np.float32).ravel())
            self.high.append(np.concatenate([np.zeros((1, a)), high]).astype(np.float32).ravel())
            del s

    @staticmethod
    def _fold(ctx: np.ndarray, sym: np.ndarray, nodes: int, below: np.ndarray) -> np.ndarray:
        """Costs of all bytes in each of ``nodes`` contexts; ``below``: those in the next shorter one."""
        a = below.shape[1]
        c = np.bincount(ctx * a + sym, minlength=nodes * a).reshape(nodes, a).astype(float)
        n, d = c.sum(1, keepdims=True), (c > 0).sum(1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            own, escape = -np.log2(c / (n + d)), -np.log2(d / (n + d))
        return np.where(n == 0, below, np.where(c > 0, own, escape + below))

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Exact code length of each text under each language: texts x languages."""
        out = np.zeros((len(texts), len(self.langs)))
        group, held = [], 0
        for i, b in enumerate(texts):
            for at in range(0, len(b), CHUNK):
                lead = b[max(0, at - ORDER):at].rjust(ORDER, b"\n")
                group.append((i, lead + b[at:at + CHUNK]))
                held += len(group[-1][1])
                if held > CHUNK:
                    self._add(out, group)
                    group, held = [], 0
        if group:
            self._add(out, group)
        return out

    def _add(self, out: np.ndarray, group: list[tuple[int, bytes]]) -> None:
        s = self.code[np.frombuffer(b"".join(g[1] for g in group), np.uint8)]
        ends = np.cumsum([len(g[1]) for g in group])
        a, sym = self.a, s[ORDER:]
        two = s[1:-2] * a + s[2:-1]
        node = self.node3[s[:-3].astype(np.int64) * (a * a) + two]
        at_high, at_low = node.astype(np.int64) * a + sym, two.astype(np.int64) * a + sym
        rare = np.flatnonzero(node == 0)
        starts = np.concatenate([[0], ends[:-1]])
        who = [g[0] for g in group]
        for k in range(len(self.langs)):
            cost = self.high[k][at_high].astype(np.float64)
            cost[rare] = self.low[k][at_low[rare]]
            run = np.concatenate([[0.0], np.cumsum(cost)])
            # a piece's bytes are those after its lead of ORDER bytes
            np.add.at(out[:, k], who, run[ends - ORDER] - run[starts])

    def best(self, texts: list[str | None]) -> tuple[list[str | None], list[float], list[float]]:
        """Language, its bits, and the sum over the languages of 2^(its bits - bits); None without a letter."""
        known = [i for i, t in enumerate(texts) if t and _LETTER.search(t)] if self.langs else []
        lang, least, total = [None] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
        bits = self.bits([texts[i].lower().encode("utf-8", "replace") for i in known])
        for i, row in zip(known, bits, strict=True):
            k = int(np.argmin(row))
            lang[i], least[i], total[i] = self.langs[k], float(row[k]), float(np.exp2(np.maximum(row[k] - row, -1000)).sum())
        return lang, least, total


def _training_rows(learnable: DataFrame) -> DataFrame:
    """(lang, h): per language the largest hash of a text that is learned from.

    Texts are counted by language and leading bits of the hash first, so only
    those up to the bits that hold the last chosen text are ranked."""
    d = learnable.select("lang", F.xxhash64("text").alias("h"), F.length("text").alias("n")).distinct()
    bucket = F.shiftright("h", 64 - PREFIX_BITS)
    b = d.groupBy("lang", bucket.alias("bucket")).agg(F.count("*").alias("docs"), F.sum("n").alias("chars"))
    before = Window.partitionBy("lang").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    full = (F.coalesce(F.sum("docs").over(before), F.lit(0)) >= DOCS_PER_LANG) | (F.coalesce(F.sum("chars").over(before), F.lit(0)) >= LANG_CHARS)
    until = b.withColumn("full", full).filter(~F.col("full")).groupBy(F.col("lang").alias("_lang")).agg(F.max("bucket").alias("until"))
    near = d.join(until, F.col("lang") == F.col("_lang")).filter(bucket <= F.col("until"))
    before = Window.partitionBy("lang").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    return (near.withColumns({"docs": F.count("*").over(before), "chars": F.coalesce(F.sum("n").over(before), F.lit(0))})
            .filter((F.col("docs") < DOCS_PER_LANG) & (F.col("chars") < LANG_CHARS)).groupBy("lang").agg(F.max("h").alias("h")))


def fit(documents: DataFrame, learn: Column, text: str = "text", lang: str = "lang") -> list[PPM]:
    """Context trees from the rows where ``learn`` holds (bounded sample, see above), in groups of languages by name."""
    d = (documents.filter(learn & F.col(lang).isNotNull() & F.col(text).isNotNull())
         .select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")))
    # only hashes are ranked and shuffled; the chosen rows' texts are read in a second pass
    ends = sorted(_training_rows(d).collect())
    models = []
    for at in range(0, len(ends), LANGS_AT_ONCE):
        take = F.lit(False)
        for r in ends[at:at + LANGS_AT_ONCE]:
            take = take | ((F.col("lang") == r.lang) & (F.xxhash64("text") <= r.h))
        samples: dict[str, list[bytes]] = {}
        for r in sorted(d.filter(take).distinct().collect(), key=lambda r: (r.lang, r.text)):
            samples.setdefault(r.lang, []).append(r.text.lower().encode("utf-8", "replace"))
        models.append(PPM(samples))
    return models


def predict(documents: DataFrame, models: list[PPM], text: str = "text", lang_pred: str = "lang_pred",
            score: str = "score") -> DataFrame:
    """``documents`` with the predicted language and its score, the language's
    share of 2^-bits over all of them; no shuffle, one pass a group of languages."""
    at, n = documents.columns.index(text), len(documents.columns)
    state = [free_name(documents, x) for x in ("lang_so_far", "bits_so_far", "total_so_far")]

    def passing(held, first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                lang, bits, total = held.value.best(b.column(at).to_pylist())
                if not first:
                    for i, (was, x, s) in enumerate(zip(*(b.column(n + k).to_pylist() for k in range(3)), strict=True)):
                        if was is not None and x <= bits[i]:
                            lang[i], bits[i], total[i] = was, x, s + total[i] * 2.0 ** max(x - bits[i], -1000)
                        elif was is not None:
                            total[i] += s * 2.0 ** max(bits[i] - x, -1000)
                yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(lang, pa.string()), pa.array(bits, pa.float64()), pa.array(total, pa.float64())],
                                                 [*b.schema.names[:n], *state])
        return run

    fields = [T.StructField(x, t) for x, t in zip(state, (T.StringType(), T.DoubleType(), T.DoubleType()), strict=True)]
    out = documents
    for k, model in enumerate(models or [PPM({})]):
        held = documents.sparkSession.sparkContext.broadcast(model)
        out = out.mapInArrow(passing(held, k == 0), T.StructType([*documents.schema.fields, *fields]))
    own = [F.col(f"`{c}`") for c in documents.columns]
    return out.select(*own, F.coalesce(state[0], F.lit(UNKNOWN)).alias(lang_pred),
                      F.when(F.col(state[0]).isNull(), F.lit(0.0)).otherwise(1 / F.col(state[2])).alias(score))


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4, is 2 (null id: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def keep_identified(documents: DataFrame, models: list[PPM], text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows whose language is found with a score of ``least`` or more, with their own columns."""
    p, s = free_name(documents, "lang_pred"), free_name(documents, "score")
    out = predict(documents, models, text, p, s)
    return out.filter((F.col(p) != UNKNOWN) & (F.col(s) >= least)).select(*documents.columns)
