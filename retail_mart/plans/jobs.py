"""Scheduled jobs over stored tables, and the command line.

The reference runs four scheduled tasks (daily sales, customer dimension,
weekly fact, monthly programme), a file loader for inventory, and one-off
dimension copies. Here each is a function over a raw layer of Parquet tables
(``{raw_root}/{table}``) and a mart root, callable from any job runner:

    python -m retail_mart ingest-inventory --raw-root R --csv PATH
    python -m retail_mart watch-inventory --raw-root R --landing DIR [--checkpoint C]
    python -m retail_mart daily|weekly|monthly --raw-root R --mart-root M
    python -m retail_mart customer --raw-root R --mart-root M --as-of 2024-01-31
    python -m retail_mart run-all --raw-root R --mart-root M --as-of 2024-01-31
    python -m retail_mart copy-dims --raw-root R --mart-root M

Each step has a mode of its own (``--scd-mode``, ``--weekly-mode``,
``--program-mode``); ``--repair`` also recomputes older days and weeks whose
input changed; ``--by-day`` says that the sales are stored in folders by sold
day. Raw tables are Parquet unless ``--source name=format`` says otherwise,
with reader options from ``--source-option name.key=value``.

The inventory raw table is full-refreshed by version (a failed load keeps
the previous version); all other raw tables are read as they are.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_mart.plans import pipeline as pl
from retail_mart.sources import ingest, sinks

RAW_TABLES = ["catalog_sales", "web_sales", "date_dim", "customer", "customer_address",
              "customer_demographics", "household_demographics", "income_band", "item", "warehouse"]


def raw_table(spark: SparkSession, raw_root: str, name: str, fmt: str = "parquet", **options) -> DataFrame:
    """S3: a raw table as it is stored, or from another format or a relational
    source; money becomes exact (whole cents) here."""
    root = f"{raw_root.rstrip('/')}/{name}"
    if name == "inventory":
        cur = sinks.read_current(spark, root)
        if cur is None:
            raise FileNotFoundError(f"no complete inventory version under {root}")
        return cur
    df = ingest.read_table(spark, root, fmt, **options)
    money = [c for c in df.columns if c.endswith(("_sales_price", "_net_profit"))]
    return df.withColumns({c: F.col(c).cast("decimal(12,2)") for c in money})


def raw_inputs(spark: SparkSession, raw_root: str, sources: dict[str, tuple[str, dict]] | None = None, by_day: bool = False) -> pl.RawInputs:
    """``sources`` maps a table's name to its (format, reader options)."""
    def t(name: str) -> DataFrame:
        fmt, options = (sources or {}).get(name, ("parquet", {}))
        return raw_table(spark, raw_root, name, fmt, **options)
    return pl.RawInputs(t("catalog_sales"), t("web_sales"), t("inventory"), t("date_dim"), t("customer"),
                        t("customer_address"), t("customer_demographics"), t("household_demographics"),
                        t("income_band"), by_day)


def parse_sources(formats: list[str], options: list[str]) -> dict[str, tuple[str, dict]]:
    """``name=format`` and ``name.key=value`` arguments; unknown tables are an error."""
    out: dict[str, tuple[str, dict]] = {}
    for arg in formats:
        name, _, fmt = arg.partition("=")
        out[name] = (fmt, {})
    for arg in options:
        path, _, value = arg.partition("=")
        name, _, key = path.partition(".")
        out.setdefault(name, ("parquet", {}))[1][key] = value
    if unknown := set(out) - set(RAW_TABLES):
        raise ValueError(f"unknown raw tables: {sorted(unknown)}")
    return out


def ingest_inventory(spark: SparkSession, raw_root: str, csv_path: str) -> dict:
    """S1 + S2: load the inventory file as the next version of the raw table;
    rejected lines go to the same version of ``inventory_rejects``."""
    good, rejects = ingest.load_inventory(spark, csv_path)
    root = raw_root.rstrip("/")
    rej, path = sinks.write_together([(rejects, f"{root}/inventory_rejects"), (good, f"{root}/inventory")], sinks.KEEP_VERSIONS)
    return {"inventory": path, "rejects": rej}


def copy_dims(spark: SparkSession, raw_root: str, mart_root: str, sources: dict[str, tuple[str, dict]] | None = None) -> dict:
    """The item, warehouse and date dimensions copied into the mart."""
    out = {}
    for name in ("item", "warehouse", "date_dim"):
        target = f"{mart_root.rstrip('/')}/analytics/{'date_dim' if name == 'date_dim' else name + '_dim'}"
        fmt, options = (sources or {}).get(name, ("parquet", {}))
        out[name] = sinks.write_version(raw_table(spark, raw_root, name, fmt, **options), target, sinks.KEEP_VERSIONS)
    return out


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="retail_mart")
    ap.add_argument("job", choices=["ingest-inventory", "watch-inventory", "daily", "customer", "weekly",
                                    "monthly", "run-all", "copy-dims"])
    ap.add_argument("--raw-root", required=True)
    ap.add_argument("--mart-root")
    ap.add_argument("--csv")
    ap.add_argument("--landing")
    ap.add_argument("--checkpoint")
    ap.add_argument("--as-of")
    ap.add_argument("--mode", choices=["reference", "strict", "documented"],
                    help="short for --scd-mode strict or --program-mode documented")
    ap.add_argument("--scd-mode", choices=["reference", "strict"])
    ap.add_argument("--weekly-mode", default="reference", choices=["reference", "strict"])
    ap.add_argument("--program-mode", choices=["reference", "documented"])
    ap.add_argument("--repair", action="store_true")
    ap.add_argument("--by-day", action="store_true")
    ap.add_argument("--source", action="append", default=[], metavar="NAME=FORMAT")
    ap.add_argument("--source-option", action="append", default=[], metavar="NAME.KEY=VALUE")
    a = ap.parse_args(argv)
    sources = parse_sources(a.source, a.source_option)
    spark = SparkSession.builder.appName(f"retail_mart {a.job}").getOrCreate()
    if a.job == "ingest-inventory":
        res = ingest_inventory(spark, a.raw_root, a.csv)
    elif a.job == "watch-inventory":
        from retail_mart.streaming.inventory_files import load_landed_inventory
        # beside the table, so that the next start knows what is loaded
        ck = a.checkpoint or f"{a.raw_root.rstrip('/')}/_inventory_stream"
        load_landed_inventory(spark, a.landing, a.raw_root, ck)
        res = {"inventory": sinks.current_path(spark, f"{a.raw_root.rstrip('/')}/inventory")}
    elif a.job == "copy-dims":
        res = copy_dims(spark, a.raw_root, a.mart_root, sources)
    else:
        raw, paths = raw_inputs(spark, a.raw_root, sources, a.by_day), pl.MartPaths(a.mart_root)
        scd_mode = a.scd_mode or ("strict" if a.mode == "strict" else "reference")
        prog_mode = a.program_mode or ("documented" if a.mode == "documented" else "reference")
        if a.job == "daily":
            res = {"daily_watermark": pl.run_daily(spark, raw, paths, a.repair)}
        elif a.job == "customer":
            res = {"customer_buckets": pl.run_customer(spark, raw, paths, a.as_of, scd_mode)}
        elif a.job == "weekly":
            res = {"weekly_watermark": pl.run_weekly(spark, raw, paths, a.weekly_mode, a.repair)}
        elif a.job == "monthly":
            res = {"monthly_watermark": pl.run_monthly(spark, raw, paths, prog_mode)}
        else:
            res = pl.run_pipeline(spark, raw, a.mart_root, a.as_of, scd_mode, prog_mode, a.weekly_mode, a.repair)
    print(json.dumps(res, default=str))


if __name__ == "__main__":
    main()
