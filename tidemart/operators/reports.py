"""Table jobs built from the column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart.functions.amount import chinese_amount
from tidemart.functions.dates import day_range
from tidemart.functions.hashing import HOT_KEYS, hot_hash_mod
from tidemart.functions.hexa import payload_words
from tidemart.functions.identity import validate_id_card
from tidemart.functions.versions import latest_version


def id_quality(df: DataFrame, id_number: str, group: str) -> DataFrame:
    """Rows and share per label in each group."""
    counts = df.groupBy(group, validate_id_card(F.col(id_number)).alias("label")).agg(
        F.count("*").alias("n")
    )
    # The window sees at most one row per label and group.
    total = F.sum("n").over(Window.partitionBy(group))
    return counts.withColumn("share", F.round(F.col("n") / total, 6))


def bucket_report(df: DataFrame, key: str, hot: dict[str, str] | None = None) -> DataFrame:
    """R2: rows per hash bucket, whether it is a hot key's own, and its weight."""
    counts = df.groupBy(hot_hash_mod(F.col(key), hot).alias("bucket")).agg(F.count("*").alias("n"))
    # One row per bucket is left, so the mean is taken over a few rows.
    mean = F.avg("n").over(Window.partitionBy(F.lit(0)))
    own = list((HOT_KEYS if hot is None else hot).values())
    return counts.withColumns(
        {"hot": F.col("bucket").isin(own), "ratio": F.round(F.col("n") / mean, 6)}
    )


def word_table(df: DataFrame, payload: str, *keep: str) -> DataFrame:
    """One row per 64-digit word with its position."""
    return df.select(*keep, F.posexplode(payload_words(F.col(payload))).alias("pos", "word"))


def latest_version_per_key(df: DataFrame, key: str, version: str) -> DataFrame:
    """The greatest dotted version of each key."""
    return df.groupBy(key).agg(latest_version(F.col(version)).alias("version"))


def day_spine(df: DataFrame, day: Column) -> DataFrame:
    """Rows per day between the first and the last day, with zeros for empty days."""
    daily = df.groupBy(day.alias("_d")).agg(F.count("*").alias("n"))
    counts = daily.select(
        (F.year("_d") * 10000 + F.month("_d") * 100 + F.dayofmonth("_d")).alias("day"), "n"
    )
    ends = daily.agg(F.min("_d").alias("a"), F.max("_d").alias("b"))
    spine = ends.select(F.explode(day_range(F.col("a"), F.col("b"))).alias("day"))
    return spine.join(counts, "day", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def daily_statement(df: DataFrame, day: Column, amount: Column) -> DataFrame:
    """The sum per day, as a number and as financial text."""
    daily = df.groupBy(day.alias("day")).agg(F.sum(amount.cast("decimal(18,2)")).alias("total"))
    return daily.withColumn("total_text", chinese_amount(F.col("total")))
