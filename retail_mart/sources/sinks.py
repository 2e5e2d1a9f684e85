"""Table writes by version: full refresh.

Spark must never overwrite a path it is reading (the job fails and the input
is gone), so a full refresh writes a new version folder and readers take the
newest *complete* one (it has the committer's _SUCCESS marker). A failed load
leaves the previous version current (quirk Q17). Several tables loaded
together share one number, and one of them carries the marker of all.

Period replacement (S5) is in ``sources.periods``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from retail_mart.sources import files

# Versions kept by the scheduled jobs.
KEEP_VERSIONS = 7
_VERSION = re.compile(r"^v=(\d+)$")


def _at(root: str, n: int) -> str:
    return f"{root.rstrip('/')}/v={n:06d}"


def versions(spark: SparkSession, root: str, marker: str | None = None) -> list[int]:
    """Complete versions under ``root`` (ascending): those with the _SUCCESS
    marker, which is the one of the table at ``marker`` if the two are
    loaded together."""
    found = [int(m.group(1)) for n in files.names(spark, root) if (m := _VERSION.match(n))]
    return [n for n in found if files.exists(spark, f"{_at(marker or root, n)}/_SUCCESS")]


def current_path(spark: SparkSession, root: str, marker: str | None = None) -> str | None:
    vs = versions(spark, root, marker)
    return _at(root, vs[-1]) if vs else None


def read_current(spark: SparkSession, root: str, marker: str | None = None) -> DataFrame | None:
    path = current_path(spark, root, marker)
    return spark.read.parquet(path) if path else None


def claim_version(spark: SparkSession, root: str, batch: str | None = None) -> int:
    """The next version number nobody has claimed; the claim is a file that
    one writer alone can create (on file systems with atomic creation). A
    ``batch`` that has a claim gets its own number again."""
    root = root.rstrip("/")
    claims = [n for n in files.names(spark, root) if n.startswith("_claim-")]
    if batch:
        for name in reversed(claims):
            if files.read_text(spark, f"{root}/{name}") == batch:
                return int(name[7:])
    vs = versions(spark, root)
    n = (vs[-1] + 1) if vs else 1
    while not files.create_new(spark, f"{root}/_claim-{n:06d}", batch or ""):
        n += 1
    return n


def write_version(df: DataFrame, root: str, keep: int | None = None, batch: str | None = None) -> str:
    """Write ``df`` as the next version of the table at ``root``."""
    return write_together([(df, root)], keep, batch)[0]


def write_together(tables: list[tuple[DataFrame, str]], keep: int | None = None, batch: str | None = None) -> list[str]:
    """Write several tables as one version; their paths. The last one is
    written last and its marker makes all of them current (readers of the
    others name it as ``marker``).

    A failed attempt keeps its number, so no writer touches another's files;
    of two writers at once, the one with the larger number becomes current.
    A ``batch`` that is repeated takes its number again: what it left
    unfinished is written anew, and once it is complete nothing is written.
    With ``keep``, all complete versions but the newest ``keep`` are dropped
    afterwards, with their claims."""
    marker = tables[-1][1]
    spark = tables[-1][0].sparkSession
    n = claim_version(spark, marker, batch)
    if n not in versions(spark, marker):
        for df, root in tables:
            files.delete(spark, _at(root, n))  # an unfinished attempt of this batch, or a folder without a claim
            df.write.mode("errorifexists").parquet(_at(root, n))
    if keep:
        for old in versions(spark, marker)[:-keep]:
            for _, root in reversed(tables):
                files.delete(spark, _at(root, old))
            files.delete(spark, f"{marker.rstrip('/')}/_claim-{old:06d}")
    return [_at(root, n) for _, root in tables]
