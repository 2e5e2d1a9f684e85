"""Best-fit packing of token ids into sequences of a fixed size.

A document is its ids and the end id; one longer than ``size`` is cut into
pieces of ``size`` ids, the last may be shorter. Each task encodes its
documents and packs the pieces as they come (``OpenBins``): a piece goes into
the open sequence with the least free space that takes it; where none does, a
new one is opened, and if that is one too many, the fullest is closed first.
Open sequences are found by a bitset over their free space.

What is still open when a task ends is packed again, without the ids: fewer
tasks, each of a bounded number of ids and pieces, take these pieces longest
first; sequences with little free space are settled, the others' pieces go
into the next round until one task suffices or rounds no longer get smaller.
The settled places are joined back to the pieces by their number.

Each round is stored in the shared folder; a repeated task reads the same
rows in the same order, so it repeats its result.

Edge cases: a null or empty text is its end id alone; repeated rows and equal
or null ids are documents of their own; a document of any length is cut; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_mart.llm.common import cut
from retail_mart.llm.tokens import encoder

SIZE = 4096
# Open sequences of a task that encodes, and of one that packs what was left open.
OPEN_BINS = 512
LATE_OPEN_BINS = 8192
# Ids and pieces of a later task.
LATE_IDS = 16 << 20
LATE_PIECES = 1 << 20
# A later round settles sequences with at most this share of free space.
LITTLE = 1 / 64
# Bytes of ids in a returned batch.
BATCH_BYTES = 16 << 20


class OpenBins:
    """At most ``limit`` open bins of ``size``; bit f of ``free`` is set if one has f free."""

    def __init__(self, size: int, limit: int):
        self.size, self.limit = size, limit
        self.free, self.count, self.opened = 0, 0, 0
        self.bins: dict[int, list[tuple[int, list]]] = {}

    def _take(self, free: int) -> tuple[int, list]:
        same = self.bins[free]
        found = same.pop()
        if not same:
            del self.bins[free]
            self.free ^= 1 << free
        self.count -= 1
        return found

    def _lowest(self, above: int) -> int | None:
        """The least free space of at least ``above``."""
        x = self.free >> above
        return above + (x & -x).bit_length() - 1 if x else None

    def put(self, length: int, item) -> Iterator[tuple[int, list]]:
        """Place ``item``; the bins this closes, as (bin, [(item, offset)])."""
        free = self._lowest(length)
        if free is None:
            if self.count == self.limit:
                yield self._take(self._lowest(0))
            free, bin_ = self.size, (self.opened, [])
            self.opened += 1
        else:
            bin_ = self._take(free)
        bin_[1].append((item, self.size - free))
        if free == length:
            yield bin_
            return
        left = free - length
        self.bins.setdefault(left, []).append(bin_)
        self.free |= 1 << left
        self.count += 1

    def rest(self) -> Iterator[tuple[int, int, list]]:
        """The open bins, as (free, bin, items)."""
        for free in sorted(self.bins):
            for number, items in self.bins[free]:
                yield free, number, items


_PIECE = "key long, doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long, open boolean"


def _first_pass(tokenizer: str, size: int, limit: int):
    """mapInArrow: (doc_id, text) -> pieces with their places."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        base = TaskContext.get().partitionId() << 40
        bins, key, rows, held = OpenBins(size, limit), base, [], 0
        names = [c.split()[0] for c in _PIECE.split(", ")]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.bool_()]

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        def closed(number: int, items: list, still_open: bool) -> None:
            nonlocal held
            for piece, offset in items:
                rows.append((*piece, base + number, offset, still_open))
                held += len(piece[-1])

        for b in batches:
            for d, body in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = encoder(tokenizer).ids(body.as_py())
                for k, at in enumerate(range(0, len(ids), size)):
                    part = ids[at:at + size]
                    key += 1
                    for number, items in bins.put(len(part), (key, d, k, at, len(part), part.tobytes())):
                        closed(number, items, False)
                if held > BATCH_BYTES:
                    yield block()
                    rows, held = [], 0
        for _, number, items in bins.rest():
            closed(number, items, True)
            if held > BATCH_BYTES:
                yield block()
                rows, held = [], 0
        if rows:
            yield block()

    return pack


_PLACED = "key long, length long, sequence_id long, offset long, open boolean"


def _late_pass(round_: int, size: int, limit: int, last: bool):
    """mapInArrow: (key, length), longest first -> places."""
    little = int(size * LITTLE)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = (round_ << 58) + (TaskContext.get().partitionId() << 32)
        bins, rows = OpenBins(size, limit), []

        def settle(number: int, items: Iterable, still_open: bool) -> None:
            rows.extend((key, length, base + number, offset, still_open) for (key, length), offset in items)

        for b in batches:
            for key, length in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for number, items in bins.put(length, (key, length)):
                    settle(number, items, False)
        for free, number, items in bins.rest():
            settle(number, items, not last and free > little)
        if rows:
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)],
                                             [c.split()[0] for c in _PLACED.split(", ")])

    return pack


def _settled(left: DataFrame, size: int) -> DataFrame:
    """Final places (key, sequence_id, offset) of the pieces (key, length) that were left open."""
    done, before, round_ = None, None, 0
    while True:
        round_ += 1
        ids, pieces = left.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
        tasks = max(1, -(-ids // LATE_IDS), -(-pieces // LATE_PIECES))
        last = tasks == 1 or (before is not None and 2 * tasks > before)
        dealt = left.repartition(tasks, "key").sortWithinPartitions(F.desc("length"), "key")
        placed = cut(dealt.mapInArrow(_late_pass(round_, size, LATE_OPEN_BINS, last), _PLACED))
        settled = placed.filter(~F.col("open")).select("key", "sequence_id", "offset")
        done = settled if done is None else done.union(settled)
        if last:
            return done
        left, before = placed.filter("open").select("key", "length"), tasks


def pack(documents: DataFrame, tokenizer: str, size: int = SIZE, open_bins: int = OPEN_BINS,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids, sequence_id,
    offset); ``ids`` are little-endian unsigned 32-bit numbers. A sequence's
    pieces stand one after the other from offset 0."""
    d = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    pieces = cut(d.mapInArrow(_first_pass(tokenizer, size, open_bins), _PIECE))
    columns = ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"]
    left = pieces.filter("open")
    again = left.drop("sequence_id", "offset").join(_settled(left.select("key", "length"), size), "key")
    return pieces.filter(~F.col("open")).select(columns).union(again.select(columns))
