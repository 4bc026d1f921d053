"""The visitor-flag repair in all its forms against a plain state machine."""

import json
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemart.operators.applog import record_text
from tidemart.operators.parse import log_rows
from tidemart.operators.visitor import CHUNK_MS, _prepared, event_cuts, repair_log, repair_visitors, visitor_states
from tidemart.sinks.state_table import StateTable
from tidemart.streaming.runs import run_available
from tidemart.streaming.visitor import repair_visitor_stream, visitor_batches

DAY = 86_400_000
BASE = 1_704_153_600_000  # 2024-01-02
SCHEMA = "seq bigint, mid string, is_new string, ts bigint"


def date_of(ms):
    return dt.datetime.fromtimestamp(ms / 1000, dt.UTC).strftime("%Y-%m-%d")


def machine(rows, rule, state=None):
    """Flags by walking the records of one device."""
    out = []
    for is_new, ts in rows:
        day, eve = date_of(ts), date_of(ts - DAY)
        flag = is_new
        if is_new == "1":
            if not state:
                state = day
            elif state != day:
                flag = "0"
        elif bool(state) == (rule == "as_coded"):
            state = eve
        out.append(flag)
    return out, state


# (is_new, day offset), out as_coded, out as_documented: late rows are in steps 6 and 8
STEPS = [
    ("0", 0, "0", "0"), ("1", 0, "1", "0"), ("1", 0, "1", "0"), ("1", 1, "0", "0"),
    ("0", 1, "0", "0"), ("1", 0, "1", "0"), ("0", 3, "0", "0"), ("1", 0, "0", "0"),
]


def random_rows(n, seed=3):
    """One device has a third of all rows; some rows lack a device or a time."""
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        mid = "hot" if rng.random() < 0.35 else f"m{rng.randrange(40)}"
        if rng.random() < 0.02:
            mid = None
        ts = None if rng.random() < 0.02 else BASE + rng.randrange(5 * DAY)
        rows.append((seq, mid, rng.choice(["0", "1", "1", None]), ts))
    return rows


def expected(rows, rule, key=lambda r: r[0]):
    out = {r[0]: r[2] for r in rows}
    states = {}
    for mid in {r[1] for r in rows if r[1]}:
        mine = sorted((r for r in rows if r[1] == mid and r[3] is not None), key=key)
        flags, states[mid] = machine([(r[2], r[3]) for r in mine], rule)
        out.update({r[0]: f for r, f in zip(mine, flags)})
    return out, {m: s for m, s in states.items() if s}


@pytest.mark.parametrize("rule, column", [("as_coded", 2), ("as_documented", 3)])
def test_steps(spark, rule, column):
    rows = [(i, "m", s[0], BASE + s[1] * DAY) for i, s in enumerate(STEPS)]
    got = repair_visitors(spark.createDataFrame(rows, SCHEMA), rule=rule).orderBy("seq").collect()
    assert [r.is_new for r in got] == [s[column] for s in STEPS]


@pytest.mark.parametrize("rule", ["as_coded", "as_documented"])
@pytest.mark.parametrize("chunk", [1, 7, 100, None])
def test_chunks(spark, rule, chunk):
    rows = random_rows(1500)
    df = spark.createDataFrame(rows, SCHEMA)
    want, states = expected(rows, rule)
    got = repair_visitors(df, rule=rule, chunk_size=chunk)
    assert {r.seq: r.is_new for r in got.collect()} == want
    left = visitor_states(df, rule=rule, chunk_size=chunk)
    assert {r.mid: r.d.isoformat() for r in left.collect()} == states


@pytest.mark.parametrize("chunk", [DAY // 4, None])
def test_event_time(spark, chunk):
    rows = random_rows(800, seed=5)
    want, _ = expected(rows, "as_coded", key=lambda r: (r[3], r[0]))
    got = repair_visitors(spark.createDataFrame(rows, SCHEMA), order="event_time", chunk_size=chunk)
    assert {r.seq: r.is_new for r in got.collect()} == want


def test_repair_log_keeps_the_record(spark):
    lines = spark.sql(
        f"""SELECT id AS seq, to_json(named_struct('ts', {BASE} + id * {DAY}, 'tag', 'g', 'common',
            if(id = 2, null, named_struct('mid', 'm', 'is_new', '1', 'os', 'x', 'net', '5g')))) AS value FROM range(3)"""
    )
    got = {r.seq: json.loads(r.v) for r in repair_log(log_rows(lines)).select("seq", record_text(F.col("record")).alias("v")).collect()}
    assert [got[i]["common"]["is_new"] for i in (0, 1)] == ["1", "0"]
    assert got[1]["common"]["os"] == "x" and got[1]["common"]["net"] == "5g" and got[1]["tag"] == "g"
    assert "common" not in got[2] and got[2]["tag"] == "g"


def write_parts(spark, rows, path, parts):
    size = -(-len(rows) // parts)
    for i in range(parts):
        part = spark.createDataFrame(rows[i * size : (i + 1) * size], SCHEMA)
        part.coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("rule", ["as_coded", "as_documented"])
def test_stream_over_batches(spark, tmp_path, rule):
    """Keyed state over several batches, with a restart from the checkpoint."""
    rows = random_rows(600, seed=9)
    want, _ = expected(rows, rule)
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def run():
        stream = (
            spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        ).withColumn("value", F.lit("v"))
        writer = repair_visitor_stream(stream, rule).writeStream.format("parquet")
        run_available(writer.option("path", out).option("checkpointLocation", checkpoint))

    write_parts(spark, rows[:400], source, 2)
    run()
    write_parts(spark, rows[400:], source, 1)
    run()
    assert {r.seq: r.is_new for r in spark.read.parquet(out).collect()} == want


@pytest.mark.parametrize("rule", ["as_coded", "as_documented"])
def test_state_table_over_batches(spark, tmp_path, rule):
    rows = random_rows(900, seed=11)
    want, states = expected(rows, rule)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    write = visitor_batches(out, state, rule=rule, chunk_size=50)
    for batch_id in (0, 1, 1, 2):  # batch 1 is replayed
        part = rows[batch_id * 300 : (batch_id + 1) * 300]
        write(spark.createDataFrame(part, SCHEMA), batch_id)
    assert {r.seq: r.is_new for r in spark.read.parquet(out).collect()} == want
    left = StateTable(spark, state, ["mid"]).read()
    assert {r.mid: r.d.isoformat() for r in left.collect()} == states


@pytest.mark.parametrize("rule", ["as_coded", "as_documented"])
def test_event_time_chunks_are_bounded(spark, rule):
    """Nine tenths of the rows are one device's, in ten minutes, a third of those in one millisecond."""
    rng, rows, bound = random.Random(11), [], 40
    for seq in range(1500):
        hot = rng.random() < 0.9
        ts = BASE + DAY - 300_000 + (rng.randrange(600_000) if rng.random() < 0.67 else 299_999)
        rows.append((seq, "hot" if hot else f"m{seq % 7}", rng.choice(["0", "1", None]), ts if hot else BASE + rng.randrange(5 * DAY)))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want, states = expected(rows, rule, key=lambda r: (r[3], r[0]))
    got = repair_visitors(df, rule=rule, order="event_time", bound=bound)
    assert {r.seq: r.is_new for r in got.collect()} == want
    known = visitor_states(df, rule=rule, order="event_time", bound=bound)
    assert {r.mid: str(r.d) for r in known.collect()} == states
    chunks = _prepared(df, "event_time", "UTC", None, event_cuts(df, CHUNK_MS, bound), bound).groupBy("mid", "_chunk").count()
    assert chunks.agg(F.max("count")).first()[0] <= 2 * bound


def test_event_time_reads_its_source_once(spark, tmp_path):
    """The plan of the repair reads what was kept, and no table that follows the rows is broadcast."""
    rows = random_rows(400, seed=5)
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "source"))
    got = repair_visitors(spark.read.parquet(str(tmp_path / "source")), order="event_time", chunk_size=180 * DAY, bound=3)
    assert got.inputFiles() and not any(f"{tmp_path}/source" in f for f in got.inputFiles())
    assert "ResolvedHint" not in got._jdf.queryExecution().analyzed().toString()
    want, _ = expected(rows, "as_coded", key=lambda r: (r[3], r[0]))
    assert {r.seq: r.is_new for r in got.collect()} == want
