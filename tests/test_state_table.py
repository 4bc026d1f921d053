"""State tables: folding, replays, cells, buckets."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemart.sinks import state_table
from tidemart.sinks.state_table import StateTable
from tidemart.sources.files import pick_up
from tidemart.streaming.live_tables import LiveTables, epochs, route_intervals


def test_reads_do_not_grow_with_batches(spark, tmp_path):
    """Fifty batches against a dictionary, each sent twice, one that was lost in between, files counted."""
    rng, want, files = random.Random(1), {}, {}
    path = str(tmp_path / "t")
    for batch in range(50):
        table = StateTable(spark, path, ["k"], buckets=2)
        rows = [(rng.choice([f"k{rng.randint(0, 30)}", f"only{batch}", None]), rng.randint(0, 99), i) for i in range(20)]
        df = spark.createDataFrame(rows, "k string, v int, seq int")
        if batch == 7:  # written, but the pointer was never moved
            table._write(table._last(df, ["seq"]))
        assert table.put(df, batch, ["seq"])
        if batch % 10 == 0:
            assert not table.put(df.withColumn("v", F.lit(-1)), batch, ["seq"])
        for k, v, _ in rows:
            want[k] = v
        if batch in (4, 49):
            files[batch] = len(table.read().inputFiles())
            assert {r.k: r.v for r in table.read().collect()} == want
    assert files[49] <= files[4] <= 4 * 2
    one = table.read(of=spark.createDataFrame([("k1",)], "k string"))
    assert len(one.inputFiles()) <= len(table.read().inputFiles())
    assert "PartitionFilters: [" in one._jdf.queryExecution().executedPlan().toString()
    assert table.vacuum(1) > 40
    assert {r.k: r.v for r in table.read(deleted="v > 50").collect()} == {k: v for k, v in want.items() if v <= 50}


def test_cells_are_merged(spark, tmp_path):
    path, want = str(tmp_path / "c"), {}
    rng = random.Random(2)
    for batch in range(7):
        table = StateTable(spark, path, ["t", "k"], buckets=3, cells="info", max_runs=2)
        rows = []
        for i in range(12):
            cells = {c: rng.choice(["x", "y", None]) for c in rng.sample("abcd", rng.randint(0, 3))}
            rows.append((rng.choice("st"), rng.choice("mn"), cells, batch, i))
        table.put(spark.createDataFrame(rows, "t string, k string, info map<string,string>, batch int, seq int"), batch, ["seq"])
        for t, k, cells, _, _ in rows:
            want.setdefault((t, k), {}).update(cells)
        want_batch = {**(want_batch if batch else {}), **{(t, k): batch for t, k, *_ in rows}}  # noqa: F821
    got = table.read().collect()
    assert {(r.t, r.k): r.info for r in got} == want and {(r.t, r.k): r.batch for r in got} == want_batch


@pytest.mark.parametrize("cells", [None, "info"])
def test_tasks_of_a_batch_are_bounded(spark, tmp_path, monkeypatch, cells):
    """One split with all rows, half of them of one key: what a task sorts does not follow the split."""
    monkeypatch.setattr(state_table.dealt, "__defaults__", (50,))
    rows = [("hot" if i % 2 else f"k{i % 30}", {f"c{i % 3}": str(i)}, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "k string, info map<string,string>, seq int").coalesce(1)
    sizes = state_table.dealt(df, ["k", "seq"]).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 15 and max(r["count"] for r in sizes) < 100
    table, want = StateTable(spark, str(tmp_path / "d"), ["k"], 2, cells=cells), {}
    table.put(df, 0, ["seq"])
    for k, info, _ in rows:
        want[k] = {**(want.get(k, {}) if cells else {}), **info}
    assert {r.k: r.info for r in table.read().collect()} == want


def test_point_get_reads_one_bucket(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "g"), ["k"], buckets=8)
    for batch in range(2):
        table.put(spark.range(500).selectExpr("string(id) AS k", f"id + {batch} AS v", "id AS seq"), batch, ["seq"])
    one = table.get("42")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k,42)" in plan and re.search(r"PartitionFilters: \[isnotnull\(_b#\d+\), \(_b#\d+ = \d\)\]", plan)
    assert [r.v for r in one.collect()] == [43] and table.get("none").count() == 0


def test_pick_up_from_a_saved_position(spark, tmp_path):
    folder, position, sent = tmp_path / "in", str(tmp_path / "position"), []

    def send(rows):
        sent.append(sorted(r.value for r in rows.collect()))

    def add(name, at):
        folder.mkdir(exist_ok=True)
        (folder / name).write_text(f"{name}\n")
        os.utime(folder / name, (at, at))

    add("b", 1000), add("c", 1000)
    assert pick_up(spark, str(folder), position, send) == 2
    add("a", 1000), add("d", 999)  # the same time stamp, and one that is older than what was seen
    assert pick_up(spark, str(folder), position, send) == 1
    assert pick_up(spark, str(folder), position, send) == 0
    add("e", 1001)

    def fails(rows):
        raise ValueError("sink")

    with pytest.raises(ValueError):
        pick_up(spark, str(folder), position, fails)
    assert pick_up(spark, str(folder), position, send) == 1
    assert sent == [["b", "c"], ["a"], ["e"]]


CHANGES = [  # arrival, op, old table, new table
    (1, "c", None, "x"), (2, "c", None, "y"), (4, "u", "x", "z"), (6, "d", "y", None), (8, "c", None, "y"), (9, "c", None, "y"),
]


def test_epochs_and_routes_by_arrival(spark):
    def image(t):
        return t and {"source_table": f"of_{t[0]}" if t != "z" else "of_x", "sink_table": t, "sink_row_key": "id"}

    kind = "seq long, op string, before map<string,string>, after map<string,string>"
    changes = spark.createDataFrame([(s, op, image(a), image(b)) for s, op, a, b in CHANGES], kind)
    got = {tuple(r) for r in epochs(changes, "n").collect()}
    assert got == {("n:x", 1, 4), ("n:z", 4, None), ("n:y", 2, 6), ("n:y", 8, None)}
    routes = {(r.source_table, r.sink_table, r.since, r.until) for r in route_intervals(changes, "n").collect()}
    assert routes == {("of_x", "n:x", 1, 4), ("of_x", "n:z", 4, None), ("of_y", "n:y", 2, 6), ("of_y", "n:y", 8, 9), ("of_y", "n:y", 9, None)}


def test_live_tables_merge_cells_and_lose_dropped_rows(spark, tmp_path):
    live = LiveTables(spark, str(tmp_path / "live"), "live_ns", "cfg", buckets=2)
    kind = "seq long, op string, db string, before map<string,string>, after map<string,string>, source map<string,string>, ts_ms long"

    def config(seq, op, before, after):
        def image(t):
            return t and {"source_table": "s", "sink_table": t, "sink_row_key": "id"}

        return (seq, op, "cfg", image(before), image(after), {"db": "cfg", "table": "t"}, 0)

    def row(seq, op="u", **cells):
        return (seq, op, "shop", None, cells, {"db": "shop", "table": "s"}, 0)

    def now(name):
        return {r.row_key: r.info for r in spark.table(f"live_ns.{name}").collect()}

    first = [config(1, "c", None, "a"), row(0, id="0", v="too early"), row(2, id="1", v="1", w="1"), row(3, id="2", v="1")]
    for _ in range(2):  # the second time is a replay
        live.write(spark.createDataFrame(first, kind), 0)
        assert now("a") == {"1": {"id": "1", "v": "1", "w": "1"}, "2": {"id": "2", "v": "1"}}
    live.write(spark.createDataFrame([row(5, id="1", v="2"), row(6, "d", id="2")], kind), 1)
    assert now("a") == {"1": {"id": "1", "v": "2", "w": "1"}, "2": {"id": "2", "v": "1"}}
    assert {r.row_key: r.info for r in live.table("a").collect()} == now("a")
    live.write(spark.createDataFrame([config(7, "d", "a", None), row(8, id="3", v="lost")], kind), 2)
    assert not spark.catalog.tableExists("live_ns.a")
    live.write(spark.createDataFrame([config(9, "c", None, "a"), row(10, id="4", v="new")], kind), 3)
    assert now("a") == {"4": {"id": "4", "v": "new"}}
    spark.sql("DROP DATABASE live_ns CASCADE")
