"""Inventory CSV loader: bad lines are skipped into rejects, NOT NULL keys enforced."""

import tempfile

from retail_mart.sources import ingest


def test_rejects(spark):
    d = tempfile.mkdtemp(prefix="inv-csv-")
    lines = ["2450000,1,10,0", "2450000,2,,1", "2450000,3,5", "2450000,4,5,1,9", "2450000,x5,5,1",
             ",6,5,1", "2450000,7,5,"]
    with open(f"{d}/part-0.csv", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    good, rejects = ingest.load_inventory(spark, d)
    assert sorted(tuple(r) for r in good.collect()) == [(2450000, 1, 10, 0), (2450000, 2, None, 1)]
    got = sorted((r.raw_line, r.reason) for r in rejects.collect())
    assert got == sorted([("2450000,3,5", "malformed"), ("2450000,4,5,1,9", "malformed"),
                          ("2450000,x5,5,1", "malformed"), (",6,5,1", "null key"), ("2450000,7,5,", "null key")])


def test_render_then_load_roundtrip(spark, raw_small):
    inv = raw_small.inventory()
    d = tempfile.mkdtemp(prefix="inv-rt-") + "/csv"
    ingest.write_inventory_csv(inv, d)
    good, rejects = ingest.load_inventory(spark, d)
    assert good.count() + rejects.count() == inv.count()
    assert good.subtract(inv).count() == 0
