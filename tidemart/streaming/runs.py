"""Running queries with a checkpoint (T8) and reading back what they wrote."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

CHECKPOINT_INTERVAL = "30 seconds"  # Fixed value: interval of the stream jobs.


def run_continuously(
    writer: DataStreamWriter, name: str, interval: str = CHECKPOINT_INTERVAL
) -> StreamingQuery:
    return writer.queryName(name).trigger(processingTime=interval).start()


def run_available(writer: DataStreamWriter) -> None:
    """Everything that is there now, in as many batches as the source limits ask for."""
    writer.trigger(availableNow=True).start().awaitTermination()


def file_run(df: DataFrame, path: str, checkpoint: str, *partition_by: str) -> DataFrame:
    """Run ``df`` to the end into Parquet files and read them as a table."""
    writer = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    run_available(writer.partitionBy(*partition_by) if partition_by else writer)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of a folder, one file or many, as a stream; the schema is that of its files."""
    files = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    # a pattern may name a file as well as a folder, a plain path only a folder
    return spark.readStream.schema(files.schema).parquet(f"{sf_dir}/{table}.parque[t]")


class EndedRun(RuntimeError):
    """A run that was ended on purpose."""


def ends_after_write(write):
    """``write`` for a recovery drill: the first attempt of each batch ends between the sink's write and the commit."""
    tried: set[int] = set()

    def drill(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        if batch_id not in tried:
            tried.add(batch_id)
            raise EndedRun(f"batch {batch_id} ended before its commit")

    return drill


def run_with_restarts(start, most: int = 100) -> int:
    """Run ``start()`` (a fresh writer on the same checkpoint) to the end, over runs that were ended; their number."""
    for ended in range(most):
        try:
            run_available(start())
            return ended
        except StreamingQueryException as fault:
            if EndedRun.__name__ not in str(fault):
                raise
    raise RuntimeError(f"not through after {most} runs")
