"""Operators on change envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def clean_envelope(df: DataFrame, *keep: str) -> DataFrame:
    """Keep ``before`` of deletes and ``after`` of everything else."""
    is_delete = F.col("op").eqNullSafe("d")
    return df.select(
        *keep,
        "op",
        F.when(is_delete, F.col("before")).alias("before"),
        F.when(~is_delete, F.col("after")).alias("after"),
    )


def of_table(df: DataFrame, table: str, db: str | None = None) -> DataFrame:
    """P5: rows of one source table."""
    rows = df.filter(F.col("source")["table"] == table)
    return rows if db is None else rows.filter(F.col("source")["db"] == db)


def no_deletes(df: DataFrame) -> DataFrame:
    """P14."""
    return df.filter(F.col("op") != "d")


def prune_payload(payload: Column, sink_columns: Column) -> Column:
    """Only the payload columns named in the comma list."""
    wanted = F.transform(F.split(sink_columns, ","), lambda c: F.trim(c))
    return F.map_filter(payload, lambda k, v: F.array_contains(wanted, k))


def text_payload(payload: Column, null_text: bool = True) -> Column:
    """Every payload value as text; nulls become the word ``null``."""
    if not null_text:
        return payload
    return F.transform_values(payload, lambda k, v: F.coalesce(v, F.lit("null")))


def audit_rows(df: DataFrame, key: str = "id") -> DataFrame:
    """Seven text columns describing one change.

    The key is taken from ``after``, or from ``before`` on deletes; payloads are
    JSON text.
    """
    row_id = F.coalesce(F.col("after")[key], F.col("before")[key])
    return df.select(
        F.concat_ws("_", row_id, F.col("ts_ms").cast("string")).alias("id"),
        "op",
        F.col("source")["db"].alias("db_name"),
        F.to_json("before").alias("log_before"),
        F.to_json("after").alias("log_after"),
        F.col("source")["table"].alias("t_name"),
        F.col("ts_ms").cast("string").alias("ts"),
    )


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` of each key.

    Spark turns ``row_number() = 1`` into a group limit that also runs before
    the exchange, so a hot key sends at most one row per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
