"""Mixing sources to target weights by entropy balancing (DataFrame functions only).

Each document gets a rate (expected copies) r. Among all rates with
sum(size * r) = target for every source and r at most MOST_REPEATS, the
balanced ones are closest in relative entropy to taking each document once:
tilted exponentially by size, r = min(MOST_REPEATS, exp(lambda * size / mean)),
with one multiplier lambda per source and ``mean`` the source's mean size.

1. Newton iterations solve the dual for all sources at once. Each is one
   grouped sum over the (source, size) counts of all documents; the step is
   taken on the logarithm of the constraint and kept within a bracket.
2. A rate is rounded down, and up for the documents whose hash, as a number
   from 0 to 1, exceeds the rate's fraction least: their words are added in
   the order of that key up to the target, by sums per bucket of the key and
   then within one bucket.
3. What is missing then is less than one document that did not fit. It is
   filled from the documents that got no copy more, the largest sizes that
   fit first, by counts of all sizes left; if these are used up, every
   document below MOST_REPEATS may get a further copy, and so on. Where going
   beyond the target then comes nearer to it, one more is taken.

The corpus is read once into a stored table of (source, size, hash). A hot
source never meets in one task: sizes are pre-aggregated by source and size,
or source and bucket, and rows are ordered within one bucket only. A source's
distinct sizes (no more than its longest text has words) do meet in one row.

Edge cases: a null or empty text has size 0 and takes nothing; null is a
source of its own, last in order; equal rows (same id and text) share a hash
and are taken alike; a source whose size is 0 has target 0; an empty table
gives an empty result; columns of other names are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_mart.llm.common import cut, free_name

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
# Newton's iteration ends when every source is this near its target, relatively, or after so many steps.
NEAR = 1e-9
NEWTON_STEPS = 60
# Buckets of the rounding key.
BUCKETS = 4096


def text_size(text: Column) -> Column:
    """Number of runs of other characters than blanks and ASCII controls 9 to 13."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def row_hash(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id, text)


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST_REPEATS) -> DataFrame:
    """``sources`` (source, size) with ``target``: shares by weight of the total
    size, none above ``most`` times its source; the excess is reshared by weight.

    Capping in the order of cap / weight gives the end of that resharing
    directly. One row per source meets in one task, no rows of documents.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    s = sources.withColumn("w", w).withColumn("cap", F.col("size") * F.lit(float(most)))
    by = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
         .withColumn("open", F.sum("w").over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
         .withColumn("level", (F.sum("size").over(everything) - F.col("capped")) / F.col("open"))
         .withColumn("free", F.col("level") * F.col("w") <= F.col("cap")))
    level = F.min_by("level", F.when(F.col("free"), F.col("cap") / F.col("w"))).over(everything)
    s = s.withColumn("final", level)
    return s.select("source", "size", F.when(F.col("final").isNull(), F.col("cap"))
                    .otherwise(F.least("cap", F.col("final") * F.col("w"))).alias("target"))


def _with_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    r = right.withColumnRenamed("source", "_source")
    return left.join(r, left["source"].eqNullSafe(r["_source"]), how).drop("_source")


def rate(size: Column, most: float = MOST_REPEATS) -> Column:
    """Expected copies under the columns ``lam`` (null: as many as allowed) and ``mean``."""
    tilted = F.exp(F.col("lam") * size / F.col("mean"))
    return F.when(F.col("target") <= 0, 0.0).when(F.col("lam").isNull(), float(most)).otherwise(F.least(tilted, F.lit(float(most))))


def multipliers(cells: DataFrame, goals: DataFrame) -> DataFrame:
    """``goals`` (source, size, target) with ``mean``, ``lam`` and the ``least`` size above 0.

    cells: (source, size, n), a stored table. With f(lam) = sum(n * size *
    rate), a step goes to lam - log(f / target) * f / f'; where that leaves
    the bracket (lo, hi) of the root, to its middle.
    """
    most = float(MOST_REPEATS)
    mean = F.greatest(F.lit(1.0), F.sum(F.col("n") * F.col("size")) / F.greatest(F.lit(1), F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(0))))
    least = F.min(F.when(F.col("size") > 0, F.col("size")))
    of = cells.groupBy("source").agg(mean.alias("mean"), least.alias("least"))
    full = F.col("target") >= most * F.col("size") * (1 - NEAR)
    s = _with_source(goals, of).select("source", F.col("size").alias("source_size"), "target", "mean",
                                       F.when(~full, F.lit(0.0)).alias("lam"), F.lit(None).cast("double").alias("lo"),
                                       "least",  # and where every rate is at its bound
                                       (F.log(F.lit(most)) * F.col("mean") / F.col("least")).alias("hi"), (full | (F.col("target") <= 0)).alias("done"))
    s = cut(s)
    for _ in range(NEWTON_STEPS):
        open_ = s.filter(~F.col("done"))
        if open_.limit(1).count() == 0:
            break
        j = _with_source(cells, open_.select("source", "target", "lam", "mean"))
        w, r = F.col("n") * F.col("size"), rate(F.col("size"))
        slope = F.when(r < most, w * r * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = j.groupBy("source").agg(F.sum(w * r).alias("f"), F.sum(slope).alias("df"))
        t = _with_source(s, sums, "left").withColumn("over", F.col("f") - F.col("target"))
        lo = F.when(F.col("over") <= 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(F.col("over") >= 0, F.col("lam")).otherwise(F.col("hi"))
        t = t.withColumns({"lo": lo, "hi": hi})
        newton = F.when(F.col("df") > 0, F.col("lam") - F.log(F.col("f") / F.col("target")) * F.col("f") / F.col("df"))
        # below zero the rates are under no bound and no step goes too far
        middle = F.when(F.col("lo").isNull(), F.least(2 * F.col("lam"), F.lit(-1.0))).otherwise((F.col("lo") + F.col("hi")) / 2)
        step = F.when((newton < F.col("hi")) & (F.col("lo").isNull() | (newton > F.col("lo"))), newton).otherwise(middle)
        near = F.abs(F.col("over")) <= F.lit(NEAR) * F.col("target")
        going = ~F.col("done") & ~near
        s = cut(t.select("source", "source_size", "target", "mean", F.when(going, step).otherwise(F.col("lam")).alias("lam"), "least", "lo", "hi", (~going).alias("done")))
    return s.select("source", "source_size", "target", "mean", "lam", "least")


def _keyed(rows: DataFrame) -> DataFrame:
    """``rows`` with source's columns: ``base`` copies of all, and the key and its bucket by which some get one more."""
    r = rate(F.col("size").cast("double"))
    d = rows.withColumn("base", F.floor(r).cast("long"))
    unit = F.shiftrightunsigned("h", 11).cast("double") / F.lit(float(1 << 53))
    d = d.withColumn("key", unit - (r - F.col("base")))
    return d.withColumn("bucket", F.least(F.lit(BUCKETS - 1), F.floor((F.col("key") + 1) * (BUCKETS // 2))).cast("int"))


def plan(rows: DataFrame, goals: DataFrame | None = None) -> DataFrame:
    """Per source, how its documents are copied.

    rows: (source, size, h), a stored table. Result: source, source_size,
    target, mean, lam, last (the last bucket that gets one more whole), upto
    (the largest key that does), picks (rounds in which keys of a size up to
    some key get one more).
    """
    cells = cut(rows.groupBy("source", "size").agg(F.count("*").alias("n")))
    if goals is None:
        goals = targets(cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("size")))
    s = multipliers(cells, goals)
    taken = _with_source(cells, s).groupBy("source").agg(F.sum(F.col("n") * F.col("size") * F.floor(rate(F.col("size").cast("double")))).alias("base_words"))
    s = cut(_with_source(s, taken).withColumn("room", F.greatest(F.lit(0.0), F.col("target") - F.col("base_words"))).drop("base_words"))

    def more_of(frame: DataFrame) -> DataFrame:
        return _keyed(_with_source(rows, frame)).filter((F.col("size") > 0) & (F.col("base") < MOST_REPEATS))

    # the bucket of keys in which the room ends
    b = more_of(s).groupBy("source", "room", "bucket").agg(F.sum("size").alias("n"))
    b = b.withColumn("end", F.sum("n").over(Window.partitionBy("source").orderBy("bucket"))).withColumn("start", F.col("end") - F.col("n"))
    edge = (b.groupBy("source").agg(
        F.max(F.when(F.col("end") <= F.col("room"), F.col("bucket"))).alias("last"),
        F.max(F.when(F.col("end") <= F.col("room"), F.col("end"))).alias("whole"),
        F.min_by(F.struct("bucket", "start"), F.when(F.col("end") > F.col("room"), F.col("bucket"))).alias("edge"))
        .select("source", F.coalesce("last", F.lit(-1)).alias("last"), F.coalesce("whole", F.lit(0)).alias("whole"),
                F.col("edge.bucket").alias("at"), F.col("edge.start").alias("start")))
    s = cut(_with_source(s, edge, "left").na.fill({"last": -1, "whole": 0}))
    # rows of that bucket, in the order of their keys
    inside = more_of(s).filter(F.col("bucket") == F.col("at"))
    inside = (inside.withColumn("end", F.col("start") + F.sum("size").over(Window.partitionBy("source").orderBy("key")))
              .filter(F.col("end") <= F.col("room")).groupBy("source").agg(F.max("key").alias("upto"), F.max("end").alias("inside")))
    s = cut(_with_source(s, inside, "left").withColumn("left", F.floor(F.col("room") - F.coalesce("inside", "whole")).cast("long"))
            .drop("room", "whole", "at", "start", "inside"))
    s = s.withColumn("picks", F.array().cast(_PICKS))
    for turn in range(1, MOST_REPEATS + 2):
        last = turn > MOST_REPEATS
        short = s.filter((F.col("left") > 0) if last else (F.col("left") >= F.col("least")))
        if short.limit(1).count() == 0:
            continue
        rest = _keyed(_with_source(rows, short)).filter((F.col("size") > 0) & (copies() < MOST_REPEATS))
        if turn == 1:
            rest = rest.filter(~_first())
        rest = rest.filter(F.col("size") < 2 * F.col("left") if last else F.col("size") <= F.col("left"))
        found = _fill(rest, turn, last)
        s = cut(_with_source(s, found, "left").withColumn("picks", F.concat("picks", F.coalesce("new", F.array().cast(_PICKS))))
                .withColumn("left", F.col("left") - F.coalesce("words", F.lit(0))).drop("new", "words"))
    return s.drop("left", "least")


_PICKS = "array<struct<turn:int,size:bigint,upto:double>>"


def _fill(rest: DataFrame, turn: int, beyond: bool) -> DataFrame:
    """(source, new, words): picks that fill each source's ``left`` words from
    the rows ``rest``, the largest sizes first; with ``beyond``, one of the smallest size."""
    cells = rest.groupBy("source", "left", "size").agg(F.count("*").alias("n"))

    def take(acc: Column, c: Column) -> Column:
        k = F.least(c["n"], F.floor(acc["left"] / c["size"]).cast("long"))
        more = F.when(k > 0, F.concat(acc["picks"], F.array(F.struct(c["size"].alias("size"), k.alias("k"))))).otherwise(acc["picks"])
        return F.struct((acc["left"] - k * c["size"]).alias("left"), more.alias("picks"))

    if beyond:
        want = cells.groupBy("source").agg(F.min("size").alias("size")).withColumn("k", F.lit(1).cast("long"))
    else:
        cells = cells.groupBy("source", "left").agg(F.sort_array(F.collect_list(F.struct("size", "n")), asc=False).alias("cells"))
        start = F.struct(F.col("left").alias("left"), F.array().cast("array<struct<size:bigint,k:bigint>>").alias("picks"))
        want = (cells.select("source", F.explode(F.aggregate("cells", start, take, lambda acc: acc["picks"])).alias("p"))
                .select("source", F.col("p.size").alias("size"), F.col("p.k").alias("k")))
    want = cut(want)

    def wanted(frame: DataFrame, w: DataFrame) -> DataFrame:
        w = w.select(F.col("source").alias("_source"), F.col("size").alias("_size"), *[c for c in w.columns if c not in ("source", "size")])
        return frame.join(w, frame["source"].eqNullSafe(w["_source"]) & (frame["size"] == w["_size"])).drop("_source", "_size")

    # the buckets that hold the first k keys of a size, then those keys
    b = wanted(rest, want).groupBy("source", "size", "k", "bucket").agg(F.count("*").alias("n"))
    b = b.withColumn("before", F.sum("n").over(Window.partitionBy("source", "size").orderBy("bucket")) - F.col("n")).filter(F.col("before") < F.col("k"))
    near = wanted(rest, b.groupBy("source", "size", "k").agg(F.max("bucket").alias("until"))).filter(F.col("bucket") <= F.col("until"))
    first = F.row_number().over(Window.partitionBy("source", "size").orderBy("key"))
    ends = near.withColumn("place", first).filter(F.col("place") <= F.col("k")).groupBy("source", "size").agg(F.max("key").alias("upto"), F.max("k").alias("k"))
    return ends.groupBy("source").agg(F.collect_list(F.struct(F.lit(turn).alias("turn"), "size", "upto")).alias("new"), F.sum(F.col("size") * F.col("k")).alias("words"))


def _picked(p: Column) -> Column:
    return (p["size"] == F.col("size")) & (F.col("key") <= p["upto"])


def _first() -> Column:
    """Whether a keyed row got one copy more up to the first turn, under the columns of ``plan``."""
    more = (F.col("bucket") <= F.col("last")) | (F.col("key") <= F.col("upto")) | F.exists("picks", lambda p: (p["turn"] == 1) & _picked(p))
    return F.coalesce(more, F.lit(False))


def copies() -> Column:
    """Copies of a keyed row under the columns of ``plan``."""
    later = F.size(F.filter("picks", lambda p: (p["turn"] > 1) & _picked(p)))
    more = F.when(F.col("size") > 0, _first().cast("int") + later).otherwise(0)
    return F.least(F.lit(MOST_REPEATS).cast("long"), F.col("base") + more)


def _rows_columns(doc_id: str, text: str, source: str) -> list[Column]:
    t, d = F.col(text).cast("string"), F.col(doc_id).cast("long")
    return [F.col(source).cast("string").alias("source"), text_size(t).alias("size"), row_hash(d, t).alias("h")]


def _rows(documents: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    return documents.select(F.col(doc_id).cast("long").alias("doc_id"), *_rows_columns(doc_id, text, source))


def mix(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per row of ``documents``: doc_id, source, size, source_size, target, copies, taken."""
    rows = cut(_rows(documents, doc_id, text, source))
    out = _keyed(_with_source(rows, plan(rows.select("source", "size", "h")))).withColumn("copies", copies())
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``documents``, each row as often as the mix takes it; whole rows meet their source's plan only."""
    p = plan(cut(_rows(documents, doc_id, text, source).select("source", "size", "h")))
    whole = free_name(documents, "row")
    d = documents.select(F.struct(*documents.columns).alias(whole), *[c for c in _rows_columns(doc_id, text, source)])
    j = _keyed(_with_source(d, p)).withColumn("times", copies().cast("int"))
    return j.withColumn("times", F.explode(F.array_repeat(F.lit(1), F.col("times")))).select(f"{whole}.*")
