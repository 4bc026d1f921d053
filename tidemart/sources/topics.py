"""Topic sources (S1, S3). ``format`` lets files stand in for the message bus."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemart.functions.dates import event_timestamp
from tidemart.operators.parse import fail_on_bad
from tidemart.schemas import envelope


def topic_stream(
    spark: SparkSession,
    topic: str,
    servers: str = "",
    offsets: str = "earliest",
    max_per_trigger: int | None = None,
    format: str = "kafka",
    path: str = "",
    ordered: bool = False,
) -> DataFrame:
    """An unbounded frame with one text column ``value``, and with ``ordered`` the arrival order ``seq``.

    ``seq`` is a text that sorts like the arrival. On the message bus it is the
    offset, then the partition: records of one partition keep their order, and of
    two partitions the one with the smaller offset comes first. In files it is the
    path, the position of the split and the row in it: files have to be named in
    the order in which they are added, as segments of a log are, and keep it
    whatever the number of tasks that read them. Micro-batches follow each other
    in the same order as long as a partition or a later name is not overtaken.

    ``max_per_trigger`` bounds a micro-batch (offsets of a topic, files of a
    folder), and what is over waits for the next trigger; by default a trigger
    takes all there is.
    """
    if format == "kafka":
        return (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", offsets)
            .options(**({"maxOffsetsPerTrigger": max_per_trigger} if max_per_trigger else {}))
            .load()
            .select(*([bus_order().alias("seq")] if ordered else []), F.col("value").cast("string").alias("value"))
        )
    rows = (
        spark.readStream.format(format)
        .schema("value string")
        .options(**({"maxFilesPerTrigger": max_per_trigger} if max_per_trigger else {}))
        .load(path or topic)
    )
    return with_file_order(rows).select("seq", "value") if ordered else rows


def _digits(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def bus_order() -> Column:
    """Offset, then partition, of a message bus record."""
    return F.concat_ws("/", _digits(F.col("offset"), 19), _digits(F.col("partition"), 10))


def with_file_order(rows: DataFrame, name: str = "seq") -> DataFrame:
    """``value`` lines of text files with their place: path, position of the split, row in the split.

    No column function numbers the rows of a stream, so an Arrow function counts
    them; a split is read by one task, in order, whichever task that is.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, row = None, 0
        for batch in batches:
            values, paths, starts = (batch.column(i) for i in range(3))
            places = []
            for place in zip(paths.to_pylist(), starts.to_pylist()):
                here, row = (here, row + 1) if place == here else (place, 0)
                places.append(f"{place[0]}\x01{place[1]:019d}\x01{row:010d}")
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.string()), values], names=[name, "value"])

    told = rows.select("value", "_metadata.file_path", "_metadata.file_block_start")
    return told.mapInArrow(number, f"{name} string, value string")


def append_segment(lines: DataFrame, topic: str, number: int, order: str = "seq") -> None:
    """Add ``value`` lines to a topic folder as the next segment, in order, from as many files as there are tasks."""
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lines.repartitionByRange(parts, order).sortWithinPartitions(order)
    dealt.select("value").write.text(f"{topic.rstrip('/')}/segment={number:012d}")


def change_table(df: DataFrame, delay: str = "5 seconds", value: str = "value") -> DataFrame:
    """S3: envelopes with the computed event time ``row_time`` and its watermark."""
    rows = fail_on_bad(df, envelope(), value).drop(value)
    timed = rows.withColumn("row_time", event_timestamp(F.col("ts_ms")))
    return timed.withWatermark("row_time", delay) if df.isStreaming else timed
