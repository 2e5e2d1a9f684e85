"""Inventory files landing in a folder are loaded once each, in order."""

import os
import tempfile

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrameWriter

from retail_mart.plans import jobs
from retail_mart.sources import sinks
from retail_mart.streaming.inventory_files import load_landed_inventory


def _write(path, lines):
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_each_landed_file_becomes_a_version_once(spark):
    base = tempfile.mkdtemp(prefix="stream-")
    landing, raw_root, ck = f"{base}/landing", f"{base}/raw", f"{base}/_checkpoint"
    os.makedirs(landing)
    _write(f"{landing}/inv-001.csv", ["2450000,1,10,0", "2450000,2,5", "2450000,3,7,1"])
    load_landed_inventory(spark, landing, raw_root, ck)
    assert sinks.versions(spark, f"{raw_root}/inventory") == [1]
    assert sinks.read_current(spark, f"{raw_root}/inventory").count() == 2
    assert sinks.read_current(spark, f"{raw_root}/inventory_rejects").count() == 1

    _write(f"{landing}/inv-002.csv", ["2450007,1,11,0", ",9,9,9"])
    load_landed_inventory(spark, landing, raw_root, ck)        # only the new file
    assert sinks.versions(spark, f"{raw_root}/inventory") == [1, 2]
    cur = sinks.read_current(spark, f"{raw_root}/inventory").collect()
    assert [tuple(r) for r in cur] == [(2450007, 1, 11, 0)]    # truncate + load semantics

    load_landed_inventory(spark, landing, raw_root, ck)        # nothing new: no new version
    assert sinks.versions(spark, f"{raw_root}/inventory") == [1, 2]


def test_the_job_started_twice_loads_a_file_once(spark):
    base = tempfile.mkdtemp(prefix="stream-")
    os.makedirs(f"{base}/landing")
    _write(f"{base}/landing/inv-001.csv", ["2450000,1,10,0"])
    for _ in range(2):
        jobs.main(["watch-inventory", "--raw-root", f"{base}/raw", "--landing", f"{base}/landing"])
    assert sinks.versions(spark, f"{base}/raw/inventory") == [1]


def _crash(monkeypatch, after: int):
    """The load dies after that many written tables of a version."""
    write, calls = DataFrameWriter.parquet, []

    def dying(self, path, *a, **k):
        write(self, path, *a, **k)
        if "/inventory" in path:
            calls.append(path)
            if len(calls) == after:
                raise RuntimeError("lost driver")
    monkeypatch.setattr(DataFrameWriter, "parquet", dying)


@pytest.mark.parametrize("after", [1, 2])
def test_a_batch_repeated_after_a_crash_gives_one_version(spark, monkeypatch, after):
    base = tempfile.mkdtemp(prefix="stream-")
    landing, raw_root, ck = f"{base}/landing", f"{base}/raw", f"{base}/_checkpoint"
    inv, rej = f"{raw_root}/inventory", f"{raw_root}/inventory_rejects"
    os.makedirs(landing)
    _write(f"{landing}/inv-001.csv", ["2450000,1,10,0", "2450000,2,5"])
    load_landed_inventory(spark, landing, raw_root, ck)
    _write(f"{landing}/inv-002.csv", ["2450007,1,11,0", ",9,9,9", "2450007,2"])
    with monkeypatch.context() as m:
        _crash(m, after)
        with pytest.raises(StreamingQueryException):
            load_landed_inventory(spark, landing, raw_root, ck)
    # neither table or both are new
    assert sinks.read_current(spark, inv).count() == 1 and sinks.versions(spark, inv) == [1, 2][:after]
    assert sinks.read_current(spark, rej, marker=inv).count() == after
    load_landed_inventory(spark, landing, raw_root, ck)
    assert sinks.versions(spark, inv) == [1, 2] == sinks.versions(spark, rej)
    assert [tuple(r) for r in sinks.read_current(spark, inv).collect()] == [(2450007, 1, 11, 0)]
    assert sinks.read_current(spark, rej, marker=inv).count() == 2


def test_versions_beyond_those_kept_are_dropped(spark, monkeypatch):
    base = tempfile.mkdtemp(prefix="stream-")
    os.makedirs(f"{base}/landing")
    monkeypatch.setattr(sinks, "KEEP_VERSIONS", 2)
    for k in range(4):
        _write(f"{base}/landing/inv-{k:03d}.csv", [f"24500{k:02d},1,10,0", "bad"])
        load_landed_inventory(spark, f"{base}/landing", f"{base}/raw", f"{base}/_checkpoint")
    for name in ("inventory", "inventory_rejects"):
        assert sinks.versions(spark, f"{base}/raw/{name}") == [3, 4]
