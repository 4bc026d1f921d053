"""Topic and line sinks (K1-K4, K7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

MAX_REQUEST_BYTES = 10 * 1024 * 1024  # Fixed value: producer request limit.


def as_message(df: DataFrame, topic: Column | None = None) -> DataFrame:
    """Rows as ``value`` JSON text, with the ``topic`` each goes to if given."""
    value = F.to_json(F.struct(*df.columns)).alias("value")
    return df.select(value) if topic is None else df.select(topic.alias("topic"), value)


def topic_sink(
    df: DataFrame,
    checkpoint: str,
    servers: str = "",
    topic: str | None = None,
    format: str = "kafka",
    path: str = "",
) -> DataStreamWriter:
    """K1, K3, K4 on streams: write ``value`` (and ``topic``) rows.

    The message bus gets all-replica acknowledgement and at-least-once delivery.
    The file form keeps one folder per topic and is exactly-once.
    """
    writer = df.writeStream.option("checkpointLocation", checkpoint)
    if format == "kafka":
        writer = (
            writer.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("kafka.acks", "all")
            .option("kafka.enable.idempotence", "true")
        )
        return writer.option("topic", topic) if topic else writer
    writer = writer.format(format).option("path", path)
    return writer.partitionBy("topic") if "topic" in df.columns else writer


def send_batch(
    df: DataFrame,
    servers: str = "",
    topic: str | None = None,
    format: str = "kafka",
    path: str = "",
    mode: str = "append",
) -> None:
    """K2 and the batch form of K3 and K4; a failed write raises."""
    if format == "kafka":
        writer = (
            df.write.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("kafka.acks", "all")
            .option("kafka.max.request.size", str(MAX_REQUEST_BYTES))
        )
        (writer.option("topic", topic) if topic else writer).save()
        return
    writer = df.write.format(format).mode(mode)
    if "topic" in df.columns:
        writer = writer.partitionBy("topic")
    writer.save(path)


def json_line_batches(path: str, max_rows_per_file: int = 1_000_000):
    """K7: a ``foreachBatch`` function that loads each batch as JSON lines.

    A batch owns the folder named by its id and replaces it, so a replay leaves
    the same lines.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.write.mode("overwrite")
            .option("maxRecordsPerFile", max_rows_per_file)
            .json(f"{path}/batch_id={batch_id}")
        )

    return write
