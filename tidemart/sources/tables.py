"""Database queries and key-value tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F


def camel(name: str) -> str:
    """``source_table`` -> ``sourceTable``."""
    return re.sub(r"_+([a-z0-9]?)", lambda m: m.group(1).upper(), name.lower())


def with_camel_names(df: DataFrame) -> DataFrame:
    return df.toDF(*map(camel, df.columns))


def jdbc_query(
    spark: SparkSession,
    url: str,
    sql: str,
    user: str,
    password: str,
    underline_to_camel: bool = False,
    split_on: tuple[str, int, int, int] | None = None,
    **options: str,
) -> DataFrame:
    """The result of a database query.

    ``split_on = (column, lower, upper, parts)`` reads a numeric column's range in
    parallel; without it one task reads everything, which suits small tables only.
    """
    reader = spark.read.format("jdbc").options(url=url, user=user, password=password, **options)
    if split_on is None:
        reader = reader.option("query", sql)
    else:
        column, lower, upper, parts = split_on
        reader = reader.option("dbtable", f"({sql}) q").options(
            partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts
        )
    df = reader.load()
    return with_camel_names(df) if underline_to_camel else df


def scan(df: DataFrame, limit: int, ordered: bool = True) -> DataFrame:
    """The first ``limit`` rows in key order, as a key-value scan gives them."""
    return (df.orderBy("row_key") if ordered else df).limit(limit)


def get(df: DataFrame, row_key: str) -> DataFrame:
    """One row by key; on a Parquet table the test reaches the scan."""
    return df.filter(F.col("row_key") == row_key)


def wide_row(df: DataFrame, columns: list[str], info: str = "info") -> DataFrame:
    """A key and the named ``info`` cells as columns."""
    return df.select("row_key", *[F.col(info)[c].alias(c) for c in columns])


def without_keys(df: DataFrame, keys: DataFrame, key: str = "row_key") -> DataFrame:
    """The table without the listed keys.

    A key is in the table once, so nothing is skewed; Spark broadcasts the list if
    its measured size allows and shuffles both sides otherwise.
    """
    return df.join(keys.select(key), key, "left_anti")
