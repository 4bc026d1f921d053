"""JSON-lines files: whole reads and pick-up of new ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.operators.parse import fail_on_bad
from tidemart.sinks.state_table import Pointer


def json_lines(spark: SparkSession, path: str, fields: dict[str, str]) -> DataFrame:
    """Parsed rows of a file; a malformed line raises, as a reader should."""
    return fail_on_bad(spark.read.text(path), fields).drop("value")


def new_files_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Text lines of files not seen before; the checkpoint keeps the position."""
    return (
        spark.readStream.format("text")
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(path)
    )


def files_modified_after(spark: SparkSession, path: str, since: str) -> DataFrame:
    """S8, batch: lines of files changed after ``since``, with the new position.

    ``since`` is ``yyyy-MM-ddTHH:mm:ss``; the greatest ``modified`` is the next one.
    """
    return (
        spark.read.option("modifiedAfter", since)
        .text(path)
        .select("value", F.col("_metadata.file_modification_time").alias("modified"))
    )


def pick_up(spark: SparkSession, path: str, position: str, send) -> int:
    """S8 with a saved position: hand the lines of files that were not sent before to ``send``; returns their number.

    The position is the latest modification time seen and the files that have it,
    so files that come later with the same time are not lost. It is written when
    ``send`` has returned: after a failure the same files are sent again.
    """
    pointer = Pointer(spark, position)
    seen = pointer.read() or {"time": -1, "paths": []}
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    # a listing only: no content is read
    time = F.unix_micros("modificationTime")
    new = found.select("path", time.alias("time")).filter(
        (F.col("time") > seen["time"]) | ((F.col("time") == seen["time"]) & ~F.col("path").isin(seen["paths"]))
    ).collect()
    if not new:
        return 0
    send(spark.read.text([r["path"] for r in new]))
    last = max(r["time"] for r in new)
    paths = [r["path"] for r in new if r["time"] == last] + (seen["paths"] if last == seen["time"] else [])
    pointer.write({"time": last, "paths": sorted(paths)})
    return len(new)
