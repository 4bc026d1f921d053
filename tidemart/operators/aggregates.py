"""Averages, medians and counts (A1-A3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemart.operators.joins import join_small

ACCURACY = 100_000
MARGIN = 10 / ACCURACY


def median_compat(x: Column) -> Column:
    """A1: named a median by its users, computed as the average."""
    return F.avg(x)


def row_count(df: DataFrame) -> DataFrame:
    """A3: the number of rows as a one-row frame; counted in partial steps."""
    return df.agg(F.count("*").alias("row_count"))


def exact_median(df: DataFrame, keys: list[str], value: str, name: str = "median") -> DataFrame:
    """A2: the exact median of each group, without holding a group in one task.

    Mergeable sketches bound a narrow band around the middle. A second pass counts
    what lies below the band and how often each value inside it occurs; only that
    band is ranked. The sketch error is a tenth of the margin, so both middle rows
    are inside; should one not be, the query fails and does not guess.
    """
    # One struct key, because a join on plain columns would lose null groups.
    rows = df.filter(F.col(value).isNotNull()).select(
        F.struct(*keys).alias("_k"), F.col(value).alias("_v")
    )
    # The sketch works in doubles; values are told apart from its edges in doubles too, and ranked as they are.
    as_double = F.col("_v").cast("double")
    edges = F.percentile_approx(as_double, [0.5 - MARGIN, 0.5 + MARGIN], ACCURACY)
    bands = rows.groupBy("_k").agg(edges.alias("_e"), F.count("*").alias("_n")).select(
        "_k", "_n", F.col("_e")[0].alias("_lo"), F.col("_e")[1].alias("_hi")
    )
    near = join_small(rows, bands, ["_k"]).filter(as_double <= F.col("_hi"))
    # Everything below the band folds into one entry ahead of it.
    slot = F.when(as_double >= F.col("_lo"), F.col("_v"))
    counts = near.groupBy("_k", "_n", slot.alias("_v")).agg(F.count("*").alias("_c"))
    w = Window.partitionBy("_k").orderBy(F.col("_v").asc_nulls_first())
    upto = counts.withColumn("_end", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))

    def at(rank: Column) -> Column:
        hit = (F.col("_end") - F.col("_c") < rank) & (F.col("_end") >= rank)
        return F.max(F.when(hit, F.col("_v")))

    low, high = F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1
    middle = upto.groupBy("_k").agg(at(low).alias("_a"), at(high).alias("_b"))
    missed = F.raise_error(F.lit("median outside its band"))
    exact, kind = _middle_types(df.schema[value].dataType)
    if kind == "double":
        half = (F.col("_a").cast(kind) + F.col("_b").cast(kind)) / 2
    else:
        half = (F.col("_a").cast(exact) + F.col("_b").cast(exact)) * F.lit(0.5).cast("decimal(1,1)")
    return middle.select(
        *[F.col(f"_k.{k}").alias(k) for k in keys],
        F.when(F.col("_a").isNull() | F.col("_b").isNull(), missed.cast(kind)).otherwise(half.cast(kind))
        .alias(name),
    )


def _middle_types(kind: T.DataType) -> tuple[str, str]:
    """Types for the two middle values and for their mean, which has one more decimal, so that no half is rounded.

    The sum and the half take three digits of the 38: a value with more than 35 raises an overflow.
    """
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return "double", "double"
    precision, scale = (kind.precision, kind.scale) if isinstance(kind, T.DecimalType) else (20, 0)
    precision, scale = min(precision, 35), min(scale, 35)
    return f"decimal({precision},{scale})", f"decimal({precision + 1},{scale + 1})"
