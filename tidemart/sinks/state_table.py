"""Current-state tables on plain Parquet (K5, K8, T1): runs of changed rows, folded as they gather.

``put`` writes the last state of each key in a batch as a run, one file per hash
bucket of the key. A pointer file names the runs that make up the table, oldest
first, and the last batch in it. Beyond ``max_runs`` neighbouring runs are folded,
the smallest first, so the number of files that a read opens does not grow with
the number of batches. A reader that knows its keys opens their buckets only.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemart.operators.envelope import latest_per_key
from tidemart.operators.tasks import dealt


class Pointer:
    """Numbered JSON files in a folder, of which the highest counts; a file appears as a whole or not at all."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path.rstrip("/")
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def versions(self) -> list[int]:
        if not self.fs.exists(self._path("")):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(self._path(""))]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def read(self, version: int | None = None) -> dict | None:
        known = self.versions()
        if not known:
            return None
        stream = self.fs.open(self._path(f"{known[-1] if version is None else version:012d}.json"))
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, content: dict) -> int:
        """Write the next version; raises if another writer took its number."""
        version = max(self.versions(), default=-1) + 1
        draft = self._path(f".{uuid.uuid4().hex}")
        out = self.fs.create(draft, False)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        if not self.fs.rename(draft, self._path(f"{version:012d}.json")):
            raise RuntimeError(f"version {version} of {self.path} was written by somebody else")
        return version


class StateTable:
    """One row per key. ``cells`` names a map column whose entries are merged one by one; other columns are replaced."""

    def __init__(
        self, spark: SparkSession, path: str, keys: list[str], buckets: int = 32, cells: str | None = None, max_runs: int = 4
    ):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys
        self.buckets, self.cells, self.max_runs = buckets, cells, max_runs
        self.pointer = Pointer(spark, f"{self.path}/_pointer")

    def current(self) -> dict:
        return self.pointer.read() or {"batch": -1, "runs": [], "schema": None, "buckets": self.buckets}

    def applied(self, batch_id: int) -> bool:
        """Whether a batch is in the table already: a replay must leave it alone."""
        return batch_id <= self.current()["batch"]

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")

    def _last(self, rows: DataFrame, order: list[str]) -> DataFrame:
        """The last row of each key, its cells merged in order; a hot key is reduced before the exchange.

        Rows are dealt by key and order first, which spreads a hot key.
        """
        rows = dealt(rows, [*self.keys, *(c for c in order if c not in self.keys)])
        last = latest_per_key(rows, self.keys, order)
        if not self.cells:
            return last
        found = rows.select(*self.keys, F.struct(*order).alias("_at"), F.explode(self.cells).alias("_cell", "_value"))
        newest = found.groupBy(*self.keys, "_cell").agg(F.max_by(F.struct("_value"), "_at").alias("_v"))
        merged = newest.groupBy(*self.keys).agg(
            F.map_from_entries(F.collect_list(F.struct("_cell", F.col("_v._value")))).alias("_cells")
        )
        same = [F.col(f"l.{k}").eqNullSafe(F.col(f"m.{k}")) for k in self.keys]
        on = same[0]
        for s in same[1:]:
            on = on & s
        joined = last.alias("l").join(merged.alias("m"), on, "left")
        cells = F.coalesce(F.col("m._cells"), F.col(f"l.{self.cells}")).alias(self.cells)
        return joined.select(*[cells if c == self.cells else F.col(f"l.{c}") for c in last.columns])

    def _write(self, rows: DataFrame) -> dict:
        name = f"run-{uuid.uuid4().hex}"
        placed = rows.withColumn("_b", self._bucket(self.buckets)).repartition(self.buckets, "_b")
        path = f"{self.path}/{name}"
        placed.sortWithinPartitions("_b", *self.keys).write.partitionBy("_b").parquet(path)
        schema = rows.withColumn("_b", F.lit(0)).schema
        return {"name": name, "rows": self.spark.read.schema(schema).parquet(path).count()}

    def _runs(self, state: dict, runs: list[dict]) -> DataFrame | None:
        from pyspark.sql.types import StructType

        if state["schema"] is None:
            return None
        kind, rows = StructType.fromJson(state["schema"]), None
        for i, run in enumerate(runs):
            part = self.spark.read.schema(kind).parquet(f"{self.path}/{run['name']}").withColumn("_run", F.lit(i))
            rows = part if rows is None else rows.unionByName(part)
        return self.spark.createDataFrame([], kind).withColumn("_run", F.lit(0)) if rows is None else rows

    def _folded(self, rows: DataFrame) -> DataFrame:
        """Rows of several runs (``_run``, ascending) to one row per key; a key has one row in a run at most."""
        if not self.cells:
            return latest_per_key(rows, self.keys, ["_run"]).drop("_run")
        others = [c for c in rows.columns if c not in (*self.keys, self.cells, "_run")]
        seen = F.array_sort(F.collect_list(F.struct("_run", F.col(self.cells).alias("_c"))), lambda a, b: a["_run"] - b["_run"])
        none = F.create_map().cast(dict(rows.dtypes)[self.cells])

        def put(old: Column, new: Column) -> Column:
            cells = F.coalesce(new["_c"], none)
            return F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key(cells, k)), cells)

        merged = rows.groupBy(*self.keys).agg(
            F.max_by(F.struct(*others), "_run").alias("_o") if others else F.max("_run").alias("_o"),
            F.aggregate(seen, none, put).alias(self.cells),
        )
        named = {c: F.col(f"_o.{c}").alias(c) for c in others}
        return merged.select(*[named.get(c, F.col(c)) for c in rows.columns if c != "_run"])

    def put(self, rows: DataFrame, batch_id: int, order: list[str]) -> bool:
        """Add a batch; False, and nothing happens, if it or a later one is in the table."""
        state = self.current()
        if batch_id <= state["batch"]:
            return False
        self.buckets = state["buckets"]
        last = self._last(rows, order)
        run = self._write(last)
        runs = [*state["runs"], run] if run["rows"] else list(state["runs"])
        state["schema"] = state["schema"] or last.withColumn("_b", F.lit(0)).schema.jsonValue()
        while len(runs) > self.max_runs:
            at = min(range(len(runs) - 1), key=lambda i: runs[i]["rows"] + runs[i + 1]["rows"])
            folded = self._folded(self._runs(state, runs[at : at + 2])).drop("_b")
            runs[at : at + 2] = [self._write(folded)]
        self.pointer.write({**state, "batch": batch_id, "runs": runs})
        return True

    def read(self, of: DataFrame | None = None, deleted: str | None = None) -> DataFrame | None:
        """The current rows, or those in the buckets of the keys in ``of`` (its rows and some more); None before the first batch.

        Rows for which the ``deleted`` condition holds are gone.
        """
        state = self.current()
        rows = self._runs(state, state["runs"])
        if rows is None:
            return None
        if of is not None:
            some = of.select(self._bucket(state["buckets"]).alias("b")).distinct().collect()
            rows = rows.filter(F.col("_b").isin([r["b"] for r in some]))
        rows = self._folded(rows).drop("_b")
        return rows.filter(~F.coalesce(F.expr(deleted), F.lit(False))) if deleted else rows

    def get(self, *key: object) -> DataFrame | None:
        """The row of one key: one bucket is read, and the test of the key reaches its scan."""
        state = self.current()
        rows = self._runs(state, state["runs"])
        if rows is None:
            return None
        kinds = [rows.schema[k].dataType for k in self.keys]
        values = [F.lit(v).cast(t) for v, t in zip(key, kinds)]
        bucket = self.spark.range(1).select(F.pmod(F.xxhash64(*values), F.lit(state["buckets"])).cast("int")).first()[0]
        rows = rows.filter(F.col("_b") == bucket)
        for k, v in zip(self.keys, values):
            rows = rows.filter(F.col(k) == v)
        return self._folded(rows).drop("_b")

    def vacuum(self, versions: int = 2) -> int:
        """Delete runs that none of the last pointer versions names: those of folded batches and of failed ones."""
        kept = {r["name"] for v in self.pointer.versions()[-versions:] for r in self.pointer.read(v)["runs"]}
        gone = 0
        for s in self.pointer.fs.listStatus(self.pointer.jvm.org.apache.hadoop.fs.Path(self.path)):
            name = s.getPath().getName()
            if name.startswith("run-") and name not in kept:
                gone += bool(self.pointer.fs.delete(s.getPath(), True))
        return gone
