"""Upsert tables on plain Parquet (K5, K8).

Each batch writes its last row per key into a folder named by the batch id; the
current table is the row of the highest batch per key. A micro-batch therefore
costs as much as it brings, never a rewrite of the table, and a replayed batch
replaces its own folder. ``compact_to`` folds the folders into a new table now
and then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.operators.envelope import latest_per_key


def upsert_batch(
    df: DataFrame,
    path: str,
    batch_id: int,
    keys: list[str],
    order: list[str],
    partition_by: tuple[str, ...] = (),
) -> None:
    """Write one batch. Reading some values of a ``partition_by`` key skips the other folders."""
    writer = latest_per_key(df, keys, order).write.mode("overwrite").partitionBy(*partition_by)
    writer.parquet(f"{path}/batch_id={batch_id}")


def read_upsert(
    spark: SparkSession,
    path: str,
    keys: list[str],
    deleted: str | None = None,
    schema: str | None = None,
    before: int | None = None,
) -> DataFrame:
    """The current rows; those for which the ``deleted`` condition holds are gone.

    ``before`` reads the table as it was before a batch.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    rows = reader.parquet(path)
    if before is not None:
        rows = rows.filter(F.col("batch_id") < before)
    rows = latest_per_key(rows, keys, ["batch_id"])
    if deleted:
        rows = rows.filter(~F.coalesce(F.expr(deleted), F.lit(False)))
    return rows.drop("batch_id")


def compact_to(
    spark: SparkSession,
    path: str,
    new_path: str,
    keys: list[str],
    deleted: str | None = None,
    partition_by: tuple[str, ...] = (),
) -> None:
    """Write the current rows as batch -1 of ``new_path``; new batches go there."""
    rows = read_upsert(spark, path, keys, deleted)
    rows.write.partitionBy(*partition_by).parquet(f"{new_path}/batch_id=-1")
