"""Contiguous ranges of an ordered key, each sorted in one task, without one global sort."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_KEY = -(1 << 63)
MASK = (1 << 22) - 1
SAMPLED = 200


def order_key(key: str) -> Column:
    """The key as a long; null comes before all others."""
    return F.coalesce(F.col(key).cast("long"), F.lit(NULL_KEY))


def cut_points(rows: DataFrame, key: str, n: int) -> list[int]:
    """At most n - 1 values that cut the key into ranges of about equal row counts.

    They come from about ``SAMPLED`` keys for each range (20,000 at least), chosen by the keys' hashes,
    or from all where there are fewer; the ranks among these are exact to a fortieth
    of a range, whatever ``n``. So the sketches that one task merges grow with the
    number of ranges and not with the rows. Only the key column is read, and only
    the cuts reach the driver. Cuts say where a row is worked on, not what comes out.
    """
    if n < 2:
        return []
    every = rows.count() // max(SAMPLED * n, 20_000)
    if every > 1:
        rows = rows.where(F.pmod(F.xxhash64(order_key(key)), F.lit(every)) == 0)
    cuts = rows.select(order_key(key).alias("k")).agg(
        F.percentile_approx("k", [i / n for i in range(1, n)], max(500, 40 * n)).alias("cuts")
    )
    found = cuts.first()["cuts"] or []
    return sorted(set(found))


def bucket_of(key: Column, cuts: list[int]) -> Column:
    """The number of cuts below the key: ascending ranges from 0.

    Two steps, over every r-th cut and then over r of them, for r the root of their number.
    """
    if not cuts:
        return F.lit(0)
    step = math.isqrt(len(cuts) - 1) + 1
    groups = [cuts[i : i + step] for i in range(0, len(cuts), step)]

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda c: c < key))

    passed = below(F.array(*[F.lit(g[-1]) for g in groups]))
    rest = F.get(F.array(*[F.array(*[F.lit(c) for c in g]) for g in groups]), passed)
    return (passed * step + F.coalesce(below(rest), F.lit(0))).cast("int")


def default_ranges(rows: DataFrame) -> int:
    return max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def whole_key(keys):
    """Arrow keys as they were: the stand-in of null becomes null again."""
    import pyarrow as pa
    import pyarrow.compute as pc

    return pc.if_else(pc.equal(keys, NULL_KEY), pa.scalar(None, pa.int64()), keys)


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared work folder and read it again: later steps do not repeat what made it."""
    from tidemart.session import work_path

    path = work_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def low_bits_mask(values: DataFrame, column: str, bits: int = MASK.bit_length()):
    """A mask over the low ``bits`` bits of a long column: it misses no value, and lets some others pass."""
    import numpy as np

    low = F.coalesce(F.col(column), F.lit(0)).bitwiseAND((1 << bits) - 1) + 1
    cells = values.select(F.bitmap_bucket_number(low).alias("b"), F.bitmap_bit_position(low).alias("p"))
    mask = np.zeros(1 << bits, bool)
    for r in cells.groupBy("b").agg(F.bitmap_construct_agg("p").alias("m")).collect():
        start = (r["b"] - 1) << 15
        mask[start : start + (1 << 15)] = np.unpackbits(np.frombuffer(bytes(r["m"]), np.uint8), bitorder="little")
    return mask
