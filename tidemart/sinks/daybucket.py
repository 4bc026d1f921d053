"""Text lines in folders by the day of an epoch field inside them (K6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.functions.dates import normalise_epoch, ts_to_partition
from tidemart.operators.parse import is_bad

ERROR_BUCKET = "error_bucket"


def bucket_of(value: Column, field: str, tz: str = "UTC") -> Column:
    """The day, 19700101 if the field is missing, or the error bucket."""
    text = F.get_json_object(value, f"$.{field}")
    # a number with a fraction counts by its whole part
    epoch = F.coalesce(text.try_cast("bigint"), text.try_cast("decimal(38,6)").try_cast("bigint"))
    unreadable = is_bad(value) | (text.isNotNull() & epoch.isNull())
    return F.when(unreadable, F.lit(ERROR_BUCKET)).otherwise(
        ts_to_partition(normalise_epoch(epoch), tz)
    )


def day_rows(df: DataFrame, field: str, tz: str = "UTC", value: str = "value") -> DataFrame:
    return df.select(bucket_of(F.col(value), field, tz).alias("day"), F.col(value).alias("value"))


def write_day_buckets(
    df: DataFrame,
    path: str,
    field: str | None,
    tz: str = "UTC",
    max_rows_per_file: int = 1_000_000,
    batch_id: int | None = None,
) -> None:
    """Add lines to the folders of their days; what is there stays.

    Rebalancing by day keeps files few, and splits a day that holds too much.
    Without a ``field`` all lines go to one folder. With a ``batch_id`` the batch
    has a folder of its own below each day, and a replay replaces just that.
    """
    if field is None:
        rows, keys = df.select("value"), []
    else:
        rows, keys = day_rows(df, field, tz).hint("rebalance", F.col("day")), ["day"]
    writer = rows.write.mode("append")
    if batch_id is not None:
        rows, keys = rows.withColumn("batch", F.lit(batch_id)), [*keys, "batch"]
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    (writer.partitionBy(*keys) if keys else writer).text(path)


def day_bucket_stream(
    df: DataFrame, path: str, field: str, checkpoint: str, tz: str = "UTC", every: str = "10 minutes"
):
    """The streaming form: the trigger interval takes the place of file rolling, batches are balanced as above."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_day_buckets(batch, path, field, tz, batch_id=batch_id)

    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(processingTime=every)
