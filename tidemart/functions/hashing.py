"""Hash buckets with hot keys set apart."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

BUCKETS = 128

# Keys known to be hot, and the bucket each has to itself.
HOT_KEYS = {
    "0x0000000000000000000000000000000000000000": "9001",
    "0xdac17f958d2ee523a2206206994597c13d831ec7": "9002",
    "0x7a250d5630b4cf539739df2c5dacb4c659f2488d": "9003",
    "0xea674fdde714fd979de3edf0f56aa9716b898ec8": "9004",
    "0xc02aaa39b223fe8d0a0e5c4f27ead9083c756cc2": "9005",
    "0x0000000000000000000000000000000000000001": "9006",
    "0xa0b86991c6218b36c1d19d4a2e9eb0ce3606eb48": "9007",
}


def hash_mod(x: Column, buckets: int = BUCKETS) -> Column:
    """last three hex digits of the MD5, modulo ``buckets``, as four digits."""
    tail = F.conv(F.right(F.md5(x.cast("string")), F.lit(3)), 16, 10).cast("int")
    return F.lpad((tail % buckets).cast("string"), 4, "0")


def hot_hash_mod(
    x: Column, hot: dict[str, str] | None = None, buckets: int = BUCKETS
) -> Column:
    """hot keys go to buckets of their own, whatever their case."""
    table = HOT_KEYS if hot is None else hot
    if not table:
        return hash_mod(x, buckets)
    key = F.lower(x.cast("string"))
    isolated = None
    for name, bucket in table.items():
        isolated = (F if isolated is None else isolated).when(key == name, F.lit(bucket))
    return isolated.otherwise(hash_mod(x, buckets))
