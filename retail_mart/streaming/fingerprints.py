"""Fingerprints of a fact's input per period, kept beside what was made from it.

A period whose fingerprint is unchanged need not be read again. Two kinds:

* of rows: their number and order-free sums of the columns used, one pass
  over those columns that leaves each task as one row a period;
* of files (``by_files``), for tables stored in folders by day: number, size
  and a hash of names and modification times, for which no column is read.

A fingerprint is text; there is one per period, so the driver holds as many
as the calendar has days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WIDE = "decimal(38,0)"


def of_rows(rows: DataFrame, period: str) -> DataFrame:
    """(period, mark): rows and the sums of two independent hashes of all columns."""
    cols = sorted(rows.columns)
    hashes = [F.sum(h.cast(_WIDE)).cast("string") for h in (F.xxhash64(*cols), F.hash(*cols).cast("bigint"))]
    return (rows.filter(F.col(period).isNotNull()).groupBy(F.col(period).cast("bigint").alias("period"))
            .agg(F.concat_ws("/", F.count(F.lit(1)).cast("string"), *hashes).alias("mark")))


def of_files(table: DataFrame, period: str) -> DataFrame:
    """(period, mark) of a table stored in folders by ``period``."""
    name, size, time = (F.col(f"_metadata.file_{x}") for x in ("path", "size", "modification_time"))
    one = table.select(F.col(period).cast("bigint").alias("period"), name.alias("name"), size.alias("size"), time.alias("time"))
    one = one.filter(F.col("period").isNotNull()).distinct()
    return one.groupBy("period").agg(F.concat_ws("/", F.count(F.lit(1)).cast("string"), F.sum("size").cast("string"),
                                                 F.sum(F.xxhash64("name", "size", "time").cast(_WIDE)).cast("string")).alias("mark"))


def marks(*parts: DataFrame) -> dict[int, str]:
    """The fingerprints of several inputs, joined per period; to the driver."""
    out: dict[int, str] = {}
    for k, part in enumerate(parts):
        for r in part.collect():
            out[r.period] = f"{out.get(r.period, '')}{k}:{r.mark};"
    return out


def changed(now: dict[int, str], before: dict[str, str]) -> list[int]:
    """Periods that came, went or differ; ``before`` as a manifest holds them (text keys)."""
    return sorted(d for d in now.keys() | {int(k) for k in before} if now.get(d) != before.get(str(d)))


def ranges(periods: set[int], known: list[int]) -> list[tuple[int, int]]:
    """``periods`` as the fewest closed ranges that hold no other of the ``known`` periods."""
    out: list[list[int]] = []
    inside = False
    for d in sorted({*known, *periods}):
        if d not in periods:
            inside = False
        elif inside:
            out[-1][1] = d
        else:
            out.append([d, d])
            inside = True
    return [(a, b) for a, b in out]


def within(col: str, spans: list[tuple[int, int]]):
    """Column condition: ``col`` lies in one of the ranges; literals, so it reaches the scan."""
    cond = F.lit(False)
    for a, b in spans:
        cond = cond | F.col(col).between(a, b)
    return cond
