"""Source divergence audit: how far the word use of a language's sources lies apart.

Terms are runs of letters (A-Z lower-cased) and non-ASCII characters. A
language keeps the terms that at least MIN_DOCS of its documents use. A group
is a (lang, source) pair; with V kept terms of the language and N of their
uses in the group, a term used c times has the share

    p = 1 + floor(SCALE * (c + SMOOTH) / (N + SMOOTH * V)),

and likewise for the whole language. All numbers are integers and exact while
a group uses fewer than 10^16 terms.

1. Tasks count terms and documents per group for a bounded number of entries
   at a time. The sums per (lang, source, term) are shuffled once more by
   (lang, term), one row a source, to find the kept terms and their uses in
   the language.
2. The group-term count matrix of a language is dealt into tiles of terms and
   pairs of blocks of groups. A tile's task builds a K-squared quadtree
   (``Quadtree``) over its groups and terms, common terms first, and goes
   down it for two ranges of groups at once: where both have an empty
   quadrant, every term of it costs the same difference of two zero shares,
   so the quadrant is priced in one step; leaves with counts are compared
   term by term. The tiles' sums are added up.
3. Terms over-used by a group are ranked per group; each task sends its best
   TOP only.

Edge cases: null text, lang and source are the empty string; a group without
terms (or without kept terms) still takes part in all its language's pairs; a
language without kept terms has pairs of value 0; a language of one source
has no pairs; repeated rows count again; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_mart.llm.common import cut

MIN_DOCS = 30
TOP = 50
SCALE = 1_000_000_000
SMOOTH = 5
# Entries a task holds before it sends its counts on.
HELD = 500_000
# Groups of a block, terms of a tile, and rows and columns of a leaf of the tree.
BLOCK = 256
TILE = 4096
LEAF = 16
# Letters are lower-cased, other ASCII becomes a blank, bytes of other characters stay.
_TERM = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))


def term_counts(documents: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Partial sums (lang, source, term, n, docs), a null term for each group seen."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses: dict[tuple, Counter] = defaultdict(Counter)
        docs: dict[tuple, Counter] = defaultdict(Counter)

        def block() -> Iterator[pa.RecordBatch]:
            for (lg, src), c in uses.items():
                d = docs[lg, src]
                terms = list(c)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lg] * (len(terms) + 1), pa.string()), pa.array([src] * (len(terms) + 1), pa.string()),
                    pa.array([*terms, None], pa.string()), pa.array([*c.values(), 0], pa.int64()),
                    pa.array([*(d[t] for t in terms), 0], pa.int64())], ["lang", "source", "term", "n", "docs"])
            uses.clear()
            docs.clear()

        held = 0
        for b in batches:
            for lg, src, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                words = body.as_py().translate(_TERM).split()
                c, d = uses[lg, src], docs[lg, src]
                held -= len(c)
                c.update(words)
                d.update(set(words))
                held += len(c)
                if held > HELD:
                    yield from block()
                    held = 0
        yield from block()

    empty = lambda x: F.coalesce(F.col(x).cast("string"), F.lit(""))
    d = documents.select(empty(lang).alias("lang"), empty(source).alias("source"), F.encode(empty(text), "UTF-8").alias("text"))
    return d.mapInArrow(count, "lang string, source string, term string, n long, docs long")


def share(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (n + SMOOTH) / total), exact: SCALE is taken in three steps of 1000."""
    total = total.astype(np.uint64)
    whole, rest = np.divmod(n.astype(np.uint64) + np.uint64(SMOOTH), total)
    for _ in range(3):
        digit, rest = np.divmod(rest * np.uint64(1000), total)
        whole = whole * np.uint64(1000) + digit
    return whole.astype(np.int64) + 1


def sql_share(n, total):
    """``share`` as a column."""
    return F.lit(1) + F.expr(f"(cast({SCALE} as decimal(10, 0)) * cast({n} + {SMOOTH} as decimal(19, 0))) div cast({total} as decimal(19, 0))")


class Quadtree:
    """K-squared tree of the non-empty cells (row, column): per level, each
    node's mask of non-empty quadrants (bit 2 * lower + right) and the number
    of its first child on the next level; the last level numbers the leaves."""

    def __init__(self, row: np.ndarray, col: np.ndarray, side: int):
        self.side = side
        levels = (side // LEAF).bit_length() - 1
        code = np.zeros(len(row), np.int64)
        for bit in range(levels):
            code |= ((col // LEAF >> bit) & 1) << 2 * bit | ((row // LEAF >> bit) & 1) << 2 * bit + 1
        codes, self.leaf_of = np.unique(code, return_inverse=True)
        self.leaves = len(codes)
        self.masks, self.first = [], []
        for _ in range(levels):
            up, parent = np.unique(codes >> 2, return_inverse=True)
            mask = np.zeros(len(up), np.int64)
            np.bitwise_or.at(mask, parent, 1 << (codes & 3))
            self.masks.insert(0, mask.tolist())
            self.first.insert(0, np.searchsorted(parent, np.arange(len(up))).tolist())
            codes = up

    def child(self, level: int, node: int, quadrant: int) -> int:
        """Number of the child on the next level, or -1 for an empty quadrant."""
        if node < 0:
            return -1
        mask = self.masks[level][node]
        return self.first[level][node] + (mask & ((1 << quadrant) - 1)).bit_count() if mask >> quadrant & 1 else -1


def tile_sums(row: np.ndarray, col: np.ndarray, n: np.ndarray, totals: np.ndarray, terms: int, split: int = 0) -> np.ndarray:
    """For every two rows, the sum over ``terms`` columns of their shares'
    differences; ``totals`` are the rows' denominators. Filled where the
    first row is not the larger; with ``split``, rows below it are not
    compared with one another, nor those from it on. The cells (row, col)
    with counts n > 0 are distinct."""
    rows = len(totals)
    side = LEAF
    while side < max(rows, terms):
        side *= 2
    zero = share(np.zeros(rows, np.int64), totals)
    padded = -(-rows // LEAF) * LEAF
    zeros = np.zeros(padded, np.int64)
    zeros[:rows] = zero
    tree = Quadtree(row, col, side)
    # leaves hold how much a cell's share exceeds its row's zero share
    over = np.zeros((tree.leaves + 1, LEAF, LEAF), np.int64)
    over[tree.leaf_of, row % LEAF, col % LEAF] = share(n, totals[row]) - zero[row]
    out = np.zeros((padded, padded), np.int64)
    empty = defaultdict(int)  # terms priced at once, by ranges of rows
    pairs: dict[tuple[int, int], list[tuple[int, int, int]]] = defaultdict(list)
    # two nodes over the same columns: (level, first row and number of each, first column)
    todo = [(0, 0, 0 if tree.leaves else -1, 0, 0 if tree.leaves else -1, 0)]
    while todo:
        level, ra, a, rb, b, c = todo.pop()
        if ra >= rows or rb >= rows or c >= terms:
            continue
        width = side >> level
        if rb + width <= split or split and ra >= split:
            continue
        if a < 0 and b < 0:
            empty[ra, rb, width] += min(width, terms - c)
        elif width == LEAF:
            pairs[ra, rb].append((a, b, min(LEAF, terms - c)))
        else:
            half = width // 2
            for right in (0, 1):
                kids = [(r + half * low, tree.child(level, x, 2 * low + right)) for r, x in ((ra, a), (rb, b)) for low in (0, 1)]
                for x in kids[:2]:
                    for y in kids[2:]:
                        if x[0] <= y[0]:
                            todo.append((level + 1, *x, *y, c + half * right))
    for (ra, rb, width), k in empty.items():
        ea, eb = min(ra + width, padded), min(rb + width, padded)
        out[ra:ea, rb:eb] += k * np.abs(zeros[ra:ea, None] - zeros[None, rb:eb])
    inside = np.arange(LEAF)
    for (ra, rb), leaves in pairs.items():
        a, b, k = np.array(leaves).T
        apart = zeros[ra:ra + LEAF, None] - zeros[None, rb:rb + LEAF]
        real = inside < k[:, None]  # padding columns cost nothing
        for at in range(0, len(a), 256):
            x, y, m = over[a[at:at + 256]], over[b[at:at + 256]], real[at:at + 256]
            for g in range(LEAF):
                d = np.abs(x[:, g, None, :] - y + apart[g][None, :, None])
                out[ra + g, rb:rb + LEAF] += (d * m[:, None, :]).sum((0, 2))
    return out[:rows, :rows]


def _pair_tile(block: int):
    """Sums of one (lang, tile, x, y): header rows (col null) name the groups
    of the blocks x and y, the others are counts."""

    def sums(part: pa.Table) -> pa.Table:
        lang, x, y = part["lang"][0].as_py(), part["x"][0].as_py(), part["y"][0].as_py()
        group = part["g"].to_numpy()
        head = part["col"].is_null().to_numpy()
        ids, first = np.unique(group[head], return_index=True)
        totals = part["total"].to_numpy()[head][first]
        cells = part.filter(pa.array(~head))
        row = np.searchsorted(ids, cells["g"].to_numpy())
        # pairs within a block are another part's
        split = int(np.searchsorted(ids, y * block)) if x != y else 0
        value = tile_sums(row, cells["col"].to_numpy(), cells["n"].to_numpy(), totals, int(part["terms"][0].as_py()), split)
        a, b = np.triu_indices(len(ids), 1)
        if split:
            a, b = a[(a < split) & (b >= split)], b[(a < split) & (b >= split)]
        return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "g": ids[a], "h": ids[b], "value": value[a, b]})

    return sums


class Audit:
    """The counts of a corpus, stored once; ``pairs`` and ``terms`` are read off them."""

    def __init__(self, documents: DataFrame, min_docs: int = MIN_DOCS, text: str = "text", lang: str = "lang", source: str = "source"):
        counted = term_counts(documents, text, lang, source)
        cells = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        word = Window.partitionBy("lang", "term")
        # a null term marks a group and stays whatever its documents
        self.cells = cut(cells.select("*", F.sum("n").over(word).alias("lang_n"), F.sum("docs").over(word).alias("lang_docs"),
                                      (F.row_number().over(word.orderBy("source")) == 1).alias("first"))
                         .filter(F.col("term").isNull() | (F.col("lang_docs") >= min_docs)).drop("docs", "lang_docs"))
        self.counts = self.cells.filter("term is not null")
        of_lang = self.counts.filter("first").groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_uses"))
        groups = (self.cells.groupBy("lang", "source").agg(F.sum("n").alias("uses"))
                  .join(of_lang, "lang", "left").na.fill(0, ["terms", "lang_uses"]))
        # one row per (lang, source)
        g = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
        self.groups = cut(groups.select("lang", "source", "terms", "lang_uses", g.cast("long").alias("g"),
                                        (F.col("uses") + SMOOTH * F.col("terms")).alias("total")))

    def pairs(self) -> DataFrame:
        """(lang, source, item, value) for any two sources of a language, both ways."""
        g = self.groups
        of_lang = g.groupBy("lang").agg(F.max("terms").alias("terms"), F.count("*").alias("sources"))
        blocks = F.ceil(F.col("sources") / BLOCK)
        langs = of_lang.select("lang", blocks.alias("blocks"), F.greatest(F.lit(1), F.ceil(F.col("terms") / TILE)).alias("tiles"))
        tile = F.pmod(F.xxhash64("term"), F.col("tiles"))
        cells = (self.counts.join(langs, "lang").join(g.select("lang", "source", "g", "total"), ["lang", "source"])
                 .select("lang", tile.alias("tile"), "term", "lang_n", "g", "n", "total", "blocks"))
        in_tile = Window.partitionBy("lang", "tile")
        col = F.dense_rank().over(in_tile.orderBy(F.desc("lang_n"), "term")) - 1
        cells = cut(cells.select("lang", "tile", "g", "n", "total", "blocks", col.cast("long").alias("col")))
        width = cells.groupBy("lang", "tile").agg((F.max("col") + 1).alias("terms"))
        heads = (g.drop("terms").join(langs, "lang").join(width, "lang")
                 .select("lang", "tile", "g", F.lit(0).cast("long").alias("n"), "total", "blocks", F.lit(None).cast("long").alias("col"), "terms"))
        rows = cells.join(width, ["lang", "tile"]).unionByName(heads)
        own = F.floor(F.col("g") / BLOCK)
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
        rows = rows.withColumn("other", other).select("lang", "tile", "g", "n", "total", "col", "terms",
                                                      F.least(own, "other").alias("x"), F.greatest(own, "other").alias("y"))
        sums = rows.groupBy("lang", "tile", "x", "y").applyInArrow(_pair_tile(BLOCK), "lang string, g long, h long, value long")
        sums = sums.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))
        name = lambda k, n: g.select("lang", F.col("g").alias(k), F.col("source").alias(n))
        found = sums.join(name("g", "source"), ["lang", "g"]).join(name("h", "item"), ["lang", "h"])
        # languages without kept terms have no tile
        none = g.filter("terms = 0")
        free = (none.select("lang", "source").join(none.select("lang", F.col("source").alias("item")), "lang")
                .filter(F.col("source") != F.col("item")).select("lang", "source", "item", F.lit(0).cast("long").alias("value")))
        both = found.select("lang", "source", "item", "value").union(found.select("lang", "item", "source", "value"))
        return both.union(free)

    def terms(self) -> DataFrame:
        """(lang, source, item, value): terms a group uses more than its language does."""
        j = self.counts.join(self.groups, ["lang", "source"])
        whole = F.col("lang_uses") + SMOOTH * F.col("terms")
        p = sql_share("n", "total") - sql_share("lang_n", "whole")
        j = j.withColumn("whole", whole).select("lang", "source", F.col("term").alias("item"), p.cast("long").alias("value"))
        return j.filter("value > 0")

    def report(self, top: int = TOP) -> DataFrame:
        """(lang, source, part, item, value, rank): all of ``pairs``, the first ``top`` of ``terms``."""
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        ranked = lambda d, part: d.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
        return ranked(self.pairs(), "pair").union(ranked(self.terms(), "term").filter(F.col("rank") <= top))
