"""The stream jobs end to end: log split, dimension load, fact routing, audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemart.operators.applog import fan_out, set_flag
from tidemart.operators.envelope import audit_rows
from tidemart.operators.parse import app_log_rows, log_rows
from tidemart.operators.visitor import repair_log, visitor_states
from tidemart.operators.routing import config_columns, dim_route, fact_route, live_config
from tidemart.schemas import CONFIG_DIM_COLUMNS, CONFIG_DWD_COLUMNS
from tidemart.sinks.topics import send_batch
from tidemart.sinks.state_table import StateTable
from tidemart.streaming.visitor import repair_visitor_stream

KEY_FIELDS = {"common": "struct<is_new:string,mid:string>", "ts": "string"}


def repaired_log(lines: DataFrame, rule: str = "as_coded", tz: str = "UTC") -> DataFrame:
    """Log lines ``(seq, value)`` to whole records with repaired flags.

    Only the key fields and the raw text pass through the stateful operator; the
    whole record is parsed behind it, on the JVM side.
    """
    keyed = app_log_rows(lines.select("seq", "value"), KEY_FIELDS).select(
        F.col("common.mid").alias("mid"), "seq", "ts",
        F.col("common.is_new").alias("is_new"), "value",
    )
    fixed = repair_visitor_stream(keyed, rule, tz).withColumnRenamed("is_new", "_flag")
    rows = log_rows(fixed.select("seq", "value", "_flag")).drop("value")
    return rows.withColumn("record", set_flag(F.col("record"), F.col("_flag"))).drop("_flag")


def split_log(
    lines: DataFrame, topics: dict[str, str] | None = None, rule: str = "as_coded", tz: str = "UTC"
) -> DataFrame:
    """Log lines to (topic, value) messages for all five outputs."""
    return fan_out(repaired_log(lines, rule, tz), topics)


def log_batches(path: str, state_path: str, topics: dict[str, str] | None = None, buckets: int = 32, **options):
    """A ``foreachBatch`` function for log lines ``(seq, value)``: the whole log job on the JVM side.

    The flag repair runs in its chunked form, with the dates of the devices in a
    state table of which a batch reads its own buckets, so a device that fills a
    batch is spread over many tasks. A batch has its own folder of messages, one
    folder per topic; it writes them, then the states, and a replay after that
    does nothing. ``options`` go to ``repair_visitors``.
    """
    options = {"order": "arrival", **options}

    def write(batch: DataFrame, batch_id: int) -> None:
        table = StateTable(batch.sparkSession, state_path, ["mid"], buckets)
        if table.applied(batch_id):
            return
        lines = batch.select("seq", "value").persist()
        try:
            keyed = app_log_rows(lines, KEY_FIELDS).select(
                "seq", "ts", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new")
            )
            initial = table.read(of=keyed.select("mid").filter("mid IS NOT NULL"))
            fixed = repair_log(log_rows(lines).drop("value"), narrow=keyed, initial=initial, **options)
            send_batch(fan_out(fixed, topics), format="text", path=f"{path}/batch_id={batch_id}", mode="overwrite")
            table.put(visitor_states(keyed, initial=initial, **options), batch_id, ["d"])
        finally:
            lines.unpersist()

    return write


def dim_table(spark: SparkSession, path: str) -> StateTable:
    """The dimension rows of all sink tables; cells are put one by one."""
    return StateTable(spark, path, ["sink_table", "row_key"], cells="info")


def dim_batches(path: str, namespace: str, config_changes):
    """A ``foreachBatch`` function that routes changes and puts dimension rows into ``dim_table(path)``.

    ``config_changes()`` returns the configuration envelopes known now, so every
    batch sees the configuration in force when it starts. ``LiveTables`` takes the
    configuration from the stream itself and follows the lifecycle of the tables.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        config = config_columns(live_config(config_changes()), CONFIG_DIM_COLUMNS)
        routed = dim_route(batch, config, namespace, keep=("ts_ms", "seq"))
        dim_table(batch.sparkSession, path).put(routed, batch_id, ["ts_ms", "seq"])

    return write


def fact_batches(path: str, config_changes, format: str = "json", sink: dict[str, str] | None = None, **route):
    """A ``foreachBatch`` function that sends fact rows to the topic of their table.

    ``sink`` holds what the sink needs, as ``servers`` of a message bus.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        live = live_config(config_changes(), keys=("source_table", "source_type"))
        config = config_columns(live, CONFIG_DWD_COLUMNS)
        routed = fact_route(batch, config, **route)
        messages = routed.select("topic", F.to_json("after").alias("value"))
        target = {"path": f"{path}/batch_id={batch_id}", "mode": "overwrite"} if format != "kafka" else {}
        send_batch(messages, format=format, **target, **(sink or {}))

    return write


def audit_table(spark: SparkSession, path: str) -> StateTable:
    return StateTable(spark, path, ["id"])


def audit_batches(path: str, key: str = "id"):
    """K8: a ``foreachBatch`` function that puts audit rows by id into ``audit_table(path)``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = audit_rows(batch, key).withColumn("_ts", F.col("ts").cast("bigint"))
        audit_table(batch.sparkSession, path).put(rows, batch_id, ["_ts", "op"])

    return write


def sink_all(df: DataFrame, checkpoint: str, write) -> DataStreamWriter:
    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
