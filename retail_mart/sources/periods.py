"""Tables kept by period (S5): one step replaces periods, readers see old or new.

    {root}/runs/run=r<id>/{column}={value}/.../part-*.parquet   what a run wrote
    {root}/_manifest/m-000000001.json                           which run holds each period

A run writes its periods to a folder of its own, which no reader looks at,
and then renames a small manifest to the next number; that rename is the only
step that changes what readers see. A run that breaks off before it leaves
the old state, afterwards the new one. Of two runs that start from the same
manifest the second one fails at the rename instead of undoing the first.

The manifest names the current run of every period, the schema, and notes
that belong to this state (such as fingerprints of what it was made from).
It grows with the number of periods (days, weeks, months or buckets), not
with rows. Replaced periods stay on disk for ``KEEP`` manifests, so readers of
an older state can finish; then their folders are removed.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_mart.sources import files

# Manifests whose files are kept.
KEEP = 2
_NULL = "__HIVE_DEFAULT_PARTITION__"


@dataclass
class State:
    """One manifest: ``periods`` maps a period's folder name to its run,
    ``replaced`` lists (run, period, number of the manifest that replaced it)."""

    number: int = 0
    schema: T.StructType | None = None
    periods: dict[str, str] = field(default_factory=dict)
    replaced: list[list] = field(default_factory=list)
    notes: dict = field(default_factory=dict)


class PeriodTable:
    def __init__(self, spark: SparkSession, root: str, columns: list[str]):
        self.spark, self.root, self.columns = spark, root.rstrip("/"), columns

    # ------------------------------------------------------------- reading
    def _path(self, number: int) -> str:
        return f"{self.root}/_manifest/m-{number:09d}.json"

    def numbers(self) -> list[int]:
        return [int(n[2:-5]) for n in files.names(self.spark, f"{self.root}/_manifest") if n.startswith("m-") and n.endswith(".json")]

    def state(self) -> State:
        """The current manifest; an empty state if there is none."""
        found = self.numbers()
        if not found:
            return State()
        raw = json.loads(files.read_text(self.spark, self._path(found[-1])))
        return State(found[-1], T.StructType.fromJson(raw["schema"]), raw["periods"], raw["replaced"], raw["notes"])

    def name(self, period: dict) -> str:
        """A period's folder name, from its values by column."""
        return "/".join(f"{c}={_NULL if period[c] is None else period[c]}" for c in self.columns)

    def values(self, name: str) -> tuple:
        """A period's values as text, None for null."""
        parts = [unquote(p.partition("=")[2]) for p in name.split("/")]
        return tuple(None if p == _NULL else p for p in parts)

    def read(self, state: State | None = None) -> DataFrame | None:
        """The rows of the current periods (None before the first run). The
        period columns are partition columns, so filters on them prune files."""
        state = state or self.state()
        if state.schema is None:
            return None
        runs = sorted(set(state.periods.values()))
        if not runs:
            return self.spark.createDataFrame([], state.schema)
        df = (self.spark.read.schema(state.schema).option("basePath", f"{self.root}/runs")
              .parquet(*[f"{self.root}/runs/run={r}" for r in runs]))
        gone = sorted("/".join([r, *(v or _NULL for v in self.values(p))]) for r, p, _ in state.replaced if r in runs)
        if gone:
            key = F.concat_ws("/", "run", *[F.coalesce(F.col(c).cast("string"), F.lit(_NULL)) for c in self.columns])
            df = df.filter(~key.isin(gone))
        return df.select(*state.schema.names)

    def watermark(self, state: State | None = None) -> int:
        """The newest period that holds rows, by the first period column
        (0 if there is none), from the manifest alone."""
        found = [int(v) for p in (state or self.state()).periods if (v := self.values(p)[0]) is not None]
        return max(found, default=0)

    # ------------------------------------------------------------- writing
    def _stage(self, fresh: DataFrame, spread: list[str]) -> str:
        """Write ``fresh`` to a folder of its own; its run id.

        With ``spread``, a period's rows go to one task (files ~ periods), and
        Spark's adaptive execution joins small tasks and splits large ones, one
        large period included. That needs no sample of the rows, for which a
        range partitioning would compute ``fresh`` twice. Without adaptive
        execution they are range-partitioned on the period and ``spread`` columns."""
        run = f"r{uuid.uuid4().hex}"
        adaptive = self.spark.conf.get("spark.sql.adaptive.enabled") == "true"
        out = fresh if not spread else fresh.hint("rebalance", *self.columns) if adaptive else fresh.repartitionByRange(*self.columns, *spread)
        out.write.mode("errorifexists").partitionBy(*self.columns).parquet(f"{self.root}/runs/run={run}")
        return run

    def _staged(self, run: str, schema: T.StructType) -> list[str]:
        """Periods that ``run`` wrote rows of (a writer makes no folder without rows)."""
        return files.data_folders(self.spark, f"{self.root}/runs/run={run}", schema)

    def _publish(self, state: State) -> None:
        draft = f"{self.root}/_manifest/.draft-{uuid.uuid4().hex}"
        files.write_text(self.spark, draft, json.dumps({
            "schema": state.schema.jsonValue(), "periods": state.periods, "replaced": state.replaced, "notes": state.notes}))
        if not files.rename_new(self.spark, draft, self._path(state.number)):
            files.delete(self.spark, draft)
            raise RuntimeError(f"{self.root}: another run published manifest {state.number} meanwhile; nothing was changed")

    def _clean(self, state: State) -> None:
        """Remove what was replaced more than KEEP manifests ago, and older manifests."""
        for run, period, number in state.replaced:
            if number <= state.number - KEEP:
                files.delete(self.spark, f"{self.root}/runs/run={run}/{period}")
                if not any(n.partition("=")[0] == self.columns[0] for n in files.names(self.spark, f"{self.root}/runs/run={run}")):
                    files.delete(self.spark, f"{self.root}/runs/run={run}")
        for n in self.numbers():
            if n <= state.number - KEEP:
                files.delete(self.spark, self._path(n))

    def replace(self, fresh: DataFrame, deleted: list[dict] = (), spread: list[str] = (), notes: dict | None = None,
                base: State | None = None) -> State:
        """The periods in ``fresh`` take the place of their old rows, the
        ``deleted`` ones (values by column) go, and ``notes`` are updated --
        all with one rename. ``base`` is the state the caller worked from."""
        base = base or self.state()
        run = self._stage(fresh, list(spread))
        new = {p: run for p in self._staged(run, fresh.schema)}
        if not new:
            files.delete(self.spark, f"{self.root}/runs/run={run}")
        gone = {self.name(d) for d in deleted} | set(new)
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in fresh.schema])
        state = State(base.number + 1, schema, {p: r for p, r in base.periods.items() if p not in gone} | new,
                      [x for x in base.replaced if x[2] > base.number - KEEP or files.exists(self.spark, f"{self.root}/runs/run={x[0]}/{x[1]}")]
                      + [[r, p, base.number + 1] for p, r in base.periods.items() if p in gone],
                      {**base.notes, **(notes or {})})
        self._publish(state)
        self._clean(state)
        return state
