"""Stream runs over the tables, read back and checked like their batch twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.operators.parse import app_log_rows, fail_on_bad
from tidemart.plans import adapters as ad, oracle_parts as sql
from tidemart.plans.log_queries import lines
from tidemart.plans.registry import query
from tidemart.plans.table_queries import UPSERTED, flat_table
from tidemart.schemas import CONFIG_DIM_COLUMNS, CONFIG_DWD_COLUMNS, envelope
from tidemart.session import work_path
from tidemart.sinks.topics import as_message, json_line_batches, topic_sink
from tidemart.sinks.state_table import StateTable
from tidemart.sources.changefeed import bootstrap_batches, snapshot_to_envelope
from tidemart.sources.files import json_lines, new_files_stream
from tidemart.operators.tasks import dealt, kept
from tidemart.operators.applog import field
from tidemart.sources.topics import append_segment, change_table, topic_stream
from tidemart.streaming import watermarks
from tidemart.streaming.jobs import (
    KEY_FIELDS, audit_batches, audit_table, dim_batches, dim_table, fact_batches, log_batches, repaired_log, sink_all, split_log,
)
from tidemart.streaming.runs import ends_after_write, file_run, run_available, run_with_restarts, table_stream
from tidemart.streaming.visitor import visitor_batches


def stream_to_table(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    spark = df.sparkSession
    return file_run(df, work_path(spark, name), work_path(spark, f"{name}-checkpoint"), *partition_by)


def streamed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.app_log_lines(table_stream(spark, sf_dir, "events"))


def config_feed(config: DataFrame, names: list[str], table: str):
    """A configuration table as the snapshot of its change feed."""
    feed = snapshot_to_envelope(config.select(*names), ad.CONFIG_DB, table)
    return lambda: feed.withColumn("seq", F.lit(0))


@query("S1_topic_stream", sql.LOG + "SELECT mid, count(*) AS n FROM al GROUP BY mid")
def topic_text_stream(spark, sf_dir):
    """Log lines sent to a topic folder and consumed from it."""
    topic = work_path(spark, "topic")
    lines(spark, sf_dir).select("value").write.text(topic)
    rows = app_log_rows(topic_stream(spark, "log", format="text", path=topic), KEY_FIELDS)
    seen = stream_to_table(rows.select(F.col("common.mid").alias("mid")), "s1")
    return seen.groupBy("mid").agg(F.count("*").alias("n"))


@query("S8_new_files", sql.EVENTS_K + "SELECT count(*) AS n FROM ev")
def new_files(spark, sf_dir):
    """Two pick-ups with one checkpoint: a file is sent once."""
    folder, out, checkpoint = (work_path(spark, f"s8-{n}") for n in ("in", "out", "checkpoint"))
    both = lines(spark, sf_dir)
    for part in (both.filter("seq % 2 = 0"), both.filter("seq % 2 = 1")):
        part.select("value").write.mode("append").text(folder)
        sent = file_run(new_files_stream(spark, folder), out, checkpoint)
    return sent.agg(F.count("*").alias("n"))


def orders_of(schema) -> dict[str, str]:
    """The columns of the orders as they are in the files."""
    return {f.name: f.dataType.simpleString() for f in schema.fields}


@query("K1_topic_sink", "SELECT * FROM orders")
def json_topic(spark, sf_dir):
    """Whole rows as messages, read back from the topic."""
    path, orders = work_path(spark, "k1"), table_stream(spark, sf_dir, "orders")
    run_available(topic_sink(as_message(orders), work_path(spark, "k1-checkpoint"), format="text", path=path))
    return json_lines(spark, path, orders_of(orders.schema))


@query("T1_stream_visitor", sql.visitor("seq"))
def stream_visitor(spark, sf_dir):
    rows = repaired_log(streamed_lines(spark, sf_dir)).select(
        "seq", *[field(F.col("record")["common"], f"$.{n}").alias(n) for n in ("mid", "is_new")]
    )
    return stream_to_table(rows, "t1")


@query("T1_stream_visitor_documented", sql.visitor("seq", documented=True))
def stream_visitor_documented(spark, sf_dir):
    rows = repaired_log(streamed_lines(spark, sf_dir), rule="as_documented").select(
        "seq", *[field(F.col("record")["common"], f"$.{n}").alias(n) for n in ("mid", "is_new")]
    )
    return stream_to_table(rows, "t1")


@query("T1_stream_visitor_table", sql.visitor("seq"))
def stream_visitor_table(spark, sf_dir):
    """The same with states in a table and the chunked repair in each batch."""
    out, states, checkpoint = (work_path(spark, f"t1-{n}") for n in ("out", "states", "checkpoint"))
    rows = app_log_rows(streamed_lines(spark, sf_dir), KEY_FIELDS).select(
        "seq", "ts", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new")
    )
    run_available(sink_all(rows, checkpoint, visitor_batches(out, states)))
    return spark.read.parquet(out).select("seq", "mid", "is_new")


_REPAIRED = sql.visitor("seq").replace(
    "SELECT seq, mid, CASE WHEN one AND coalesce(mark, seed)",
    ", r AS (SELECT seq, CASE WHEN one AND coalesce(mark, seed)",
) + ")"


_SENT = _REPAIRED + """
, x AS (SELECT al.*, 'sid_' || al.seq AS sid, r.is_new AS flag FROM al JOIN r ON al.seq = r.seq)
SELECT 'log_err' AS topic, NULL AS sid, NULL AS is_new, 'msg_' || k AS what FROM x WHERE event_type = 'error'
UNION ALL SELECT 'log_start', sid, flag, 'icon' FROM x WHERE event_type = 'signup'
UNION ALL SELECT 'log_page', sid, flag, event_type FROM x WHERE event_type <> 'signup'
UNION ALL SELECT 'log_display', sid, flag, CAST(k + i AS VARCHAR) FROM (SELECT *, unnest(range(nd)) AS i FROM x WHERE nd > 0)
UNION ALL SELECT 'log_action', sid, flag, CAST(k + i AS VARCHAR) FROM (SELECT *, unnest(range(na)) AS i FROM x WHERE na > 0)"""


def in_three_segments(spark: SparkSession, sf_dir: str, name: str, start) -> None:
    """Log lines added to a topic folder in three segments, each read by a run ``start(ordered lines)`` of its own.

    The lines are made once: each segment would make all of them twice, for its ranges and for its files.
    """
    topic, sent = work_path(spark, name), kept(ad.app_log_lines(dealt(ad.table(spark, sf_dir, "events"), ["event_id"])), "lines")
    cuts = sent.agg(F.percentile_approx("seq", [0.3, 0.6], 1000)).first()[0]
    part = F.when(F.col("seq") <= cuts[0], 0).when(F.col("seq") <= cuts[1], 1).otherwise(2)
    for number in range(3):
        append_segment(sent.filter(part == number), topic, number)
        run_available(start(topic_stream(spark, "log", format="text", path=f"{topic}/*", ordered=True)))


def sent_messages(spark: SparkSession, path: str) -> DataFrame:
    text = F.col("value")
    what = [F.get_json_object(text, f"$.{p}") for p in ("display.item", "action.item", "start.entry", "page.page_id", "msg")]
    return spark.read.text(path).select(
        "topic", F.get_json_object(text, "$.common.sid").alias("sid"), F.get_json_object(text, "$.common.is_new").alias("is_new"),
        F.coalesce(*what).alias("what"),
    )


@query("K3_stream_fanout", _SENT)
def stream_fanout(spark, sf_dir):
    """The log job on a topic folder: order of arrival, parse, repair with keyed state, split, one folder per topic.

    Three micro-batches, each from the checkpoint of the one before.
    """
    path, checkpoint = work_path(spark, "k3s"), work_path(spark, "k3s-checkpoint")
    in_three_segments(spark, sf_dir, "k3s-topic", lambda found: topic_sink(split_log(found), checkpoint, format="text", path=path))
    return sent_messages(spark, path)


@query("K3_stream_fanout_table", _SENT)
def stream_fanout_table(spark, sf_dir):
    """The same with the dates in a state table and the chunked repair in each batch, all on the JVM side."""
    path, states, checkpoint = (work_path(spark, f"k3t-{n}") for n in ("out", "states", "checkpoint"))
    write = log_batches(path, states)
    in_three_segments(spark, sf_dir, "k3t-topic", lambda found: sink_all(found, checkpoint, write))
    return sent_messages(spark, path)


@query("T2_stream_dim_load", UPSERTED)
def stream_dim_load(spark, sf_dir):
    """The dimension job: each batch meets the live configuration and is upserted."""
    path = work_path(spark, "t2")
    config = config_feed(ad.dim_config(spark), CONFIG_DIM_COLUMNS, "table_process_dim")
    changes = None
    for name in ad.DIM_KEYS:
        feed = ad.dim_changes(table_stream(spark, sf_dir, name), name)
        changes = feed if changes is None else changes.unionByName(feed)
    write = dim_batches(path, ad.NAMESPACE, config)
    run_available(sink_all(changes, work_path(spark, "t2-checkpoint"), write))
    return flat_table(dim_table(spark, path).read())


@query(
    "K5_stream_upsert",
    sql.DIM + """
SELECT 'retail_dim:dim_customer' AS sink_table, CAST(k AS VARCHAR) AS row_key, max(after_name) AS name
FROM dim WHERE tbl = 'customer' AND op <> 'd' GROUP BY k""",
)
def stream_upsert(spark, sf_dir):
    path = work_path(spark, "k5s")
    config = config_feed(ad.dim_config(spark), CONFIG_DIM_COLUMNS, "table_process_dim")
    changes = ad.dim_changes(table_stream(spark, sf_dir, "customer"), "customer")
    checkpoint = work_path(spark, "k5s-checkpoint")
    run_available(sink_all(changes, checkpoint, dim_batches(path, ad.NAMESPACE, config)))
    return flat_table(dim_table(spark, path).read())


@query(
    "J2_stream_fact_load",
    sql.CART + sql.FACT_CONFIG + """
SELECT sink_table AS topic, count(*) AS n, CAST(sum(num) AS BIGINT) AS total FROM cart JOIN cfg ON tbl = source_table
AND source_type = CASE op WHEN 'u' THEN 'update' ELSE 'insert' END GROUP BY 1""",
)
def stream_fact_load(spark, sf_dir):
    path = work_path(spark, "j2s")
    config = fact_config_feed(spark)
    changes = ad.cart_envelopes(table_stream(spark, sf_dir, "lineitem"))
    write = fact_batches(path, config, format="text", match_source_type=True)
    run_available(sink_all(changes, work_path(spark, "j2s-checkpoint"), write))
    num = F.get_json_object("value", "$.sku_num").cast("bigint")
    return spark.read.text(path).groupBy("topic").agg(F.count("*").alias("n"), F.sum(num).alias("total"))


def fact_config_feed(spark: SparkSession):
    return config_feed(ad.fact_config(spark), CONFIG_DWD_COLUMNS, "table_process_dwd")


@query("K7_json_load", "SELECT * FROM orders")
def json_load(spark, sf_dir):
    path, rows = work_path(spark, "k7"), table_stream(spark, sf_dir, "orders")
    run_available(sink_all(rows, work_path(spark, "k7-checkpoint"), json_line_batches(path)))
    return spark.read.schema(rows.schema).json(path).select(*rows.columns)


@query(
    "K8_stream_audit",
    sql.DIM + f"""
SELECT CAST(k AS VARCHAR) || '_' || CAST({sql.BASE_MS} + step * 1000 AS VARCHAR) AS id, op, before_name
FROM dim WHERE tbl = 'customer'""",
)
def stream_audit(spark, sf_dir):
    path = work_path(spark, "k8s")
    changes = ad.dim_changes(table_stream(spark, sf_dir, "customer"), "customer")
    write = audit_batches(path, "c_custkey")
    run_available(sink_all(changes, work_path(spark, "k8s-checkpoint"), write))
    return audit_table(spark, path).read().select(
        "id", "op", F.get_json_object("log_before", "$.c_name").alias("before_name")
    )


@query("T3_watermark", sql.CART + "SELECT seq, op, ts_ms AS row_ms FROM cart")
def cart_watermark(spark, sf_dir):
    changes = ad.envelope_lines(ad.cart_envelopes(table_stream(spark, sf_dir, "lineitem")))
    rows = change_table(changes).select("seq", "op", F.unix_millis("row_time").alias("row_ms"))
    return stream_to_table(rows, "t3")


@query(
    "T4_watermark",
    """SELECT event_id, epoch_us(ts) // 1000000 + CASE WHEN event_id % 2 = 0 THEN 0 ELSE 60 END AS event_s FROM events""",
)
def block_watermark(spark, sf_dir):
    seconds = F.floor(ad.event_ms(F.col("ts")) / 1000)
    rows = table_stream(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 2 == 0, seconds).alias("block_timestamp"),
        (seconds + 60).alias("timestamp"),
    )
    timed = watermarks.block_time(rows, 30)
    return stream_to_table(timed.select("event_id", F.unix_seconds("event_time").alias("event_s")), "t4")


@query(
    "T5_watermark",
    "SELECT event_id, CASE WHEN event_id % 7 > 0 THEN epoch_us(ts) // 1000 END AS event_ms FROM events",
)
def list_watermark(spark, sf_dir):
    ms = ad.event_ms(F.col("ts"))
    one = F.struct(ms.alias("window_start_time"))
    two = F.struct((ms + 1000).alias("window_start_time"))
    rows = table_stream(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 7 > 0, F.array(one, two)).otherwise(F.array().cast("array<struct<window_start_time:bigint>>")).alias("items")
    )
    timed = watermarks.batch_time(rows, 30)
    return stream_to_table(timed.select("event_id", F.unix_millis("event_time").alias("event_ms")), "t5")


@query("T8_restart", sql.visitor("seq"))
def restart(spark, sf_dir):
    """Each batch is ended once between its write and its commit and taken up again from the checkpoint."""
    topic, out, states, checkpoint = (work_path(spark, f"t8-{n}") for n in ("topic", "out", "states", "checkpoint"))
    sent = lines(spark, sf_dir)
    middle = sent.agg(F.percentile_approx("seq", 0.5, 1000)).first()[0]
    write = ends_after_write(visitor_batches(out, states))

    def start():
        rows = topic_stream(spark, "log", format="text", path=f"{topic}/*", ordered=True).withColumnRenamed("seq", "place")
        rows = app_log_rows(rows, {**KEY_FIELDS, "common": "struct<is_new:string,mid:string,sid:string>"})
        # the number in the session id is the arrival number
        seq = F.substring_index("common.sid", "_", -1).cast("bigint")
        rows = rows.select(seq.alias("seq"), "ts", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"))
        return sink_all(rows, checkpoint, write)

    for number, part in enumerate((sent.filter(F.col("seq") <= middle), sent.filter(F.col("seq") > middle))):
        append_segment(part, topic, number)
        run_with_restarts(start)
    return spark.read.parquet(out).select("seq", "mid", "is_new")


@query(
    "S4_stream_initial",
    """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name || CASE WHEN c_custkey % 3 = 0 THEN '_v2' ELSE '' END AS name
FROM customer WHERE c_custkey % 7 <> 0""",
)
def stream_initial(spark, sf_dir):
    """Snapshot and log of the customers at once: rows change while the table is read in three chunks.

    A chunk is read as the table was before the batch's own changes, so rows of the log have to win.
    """
    topic, path, position, checkpoint = (work_path(spark, f"s4-{n}") for n in ("topic", "table", "position", "checkpoint"))
    customers = ad.table(spark, sf_dir, "customer")
    changes = ad.dim_changes(customers, "customer")
    key = F.coalesce("after", "before")["c_custkey"].cast("bigint")
    # updates come in the first two batches, deletes in the third
    when = F.when(F.col("op") == "u", key % 2).when(F.col("op") == "d", 2)
    log = changes.withColumn("batch", when).filter("batch IS NOT NULL")
    table = StateTable(spark, path, ["id"], 8)

    def read_chunk(i: int) -> DataFrame:
        """The rows of a chunk as the log of earlier batches left them."""
        changed = (F.col("c_custkey") % 3 == 0) & (F.col("c_custkey") % 2 < i)
        name = F.when(changed, F.concat("c_name", F.lit("_v2"))).otherwise(F.col("c_name"))
        now = customers.filter(F.floor(F.col("c_custkey") / 2) % 3 == i).withColumn("c_name", name)
        return snapshot_to_envelope(now, ad.SHOP_DB, "customer")

    def send(rows: DataFrame, batch_id: int) -> None:
        found = rows.select(
            F.coalesce("after", "before")["c_custkey"].alias("id"), F.col("after")["c_name"].alias("name"), "op", "ts_ms"
        )
        table.put(found, batch_id, ["ts_ms"])

    write = bootstrap_batches(read_chunk, 3, "c_custkey", position, send)
    for number in range(3):
        append_segment(ad.envelope_lines(log.filter(F.col("batch") == number)), topic, number)
        found = topic_stream(spark, "changes", format="text", path=f"{topic}/*")
        run_available(sink_all(fail_on_bad(found, envelope()).drop("value"), checkpoint, write))
    return table.read(deleted="op = 'd'").select("id", "name")
