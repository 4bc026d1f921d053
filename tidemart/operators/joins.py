"""A join with a side that is expected, but not known, to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

MAX_BROADCAST_ROWS = 100_000
SALTS = 32


def join_small(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    how: str = "inner",
    max_rows: int = MAX_BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``big`` to ``small`` on ``keys`` (``inner`` or ``left``).

    ``small`` is counted up to the bound and broadcast only within it. Beyond it
    both sides are shuffled with a salt next to the keys, so a key that holds a
    large part of ``big`` is spread over ``salts`` tasks. The salt is a hash of the
    row and not a random number: a task that runs again must place rows as before.
    What stays uneven (many equal rows) is left to the adaptive skew join.
    """
    if small.limit(max_rows + 1).count() <= max_rows:
        return big.join(F.broadcast(small), keys, how)
    salt = F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in _scalar_columns(big)]), F.lit(salts))
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    joined = big.withColumn("_salt", salt.cast("int")).join(salted, [*keys, "_salt"], how)
    return joined.drop("_salt")


def _scalar_columns(df: DataFrame) -> list[str]:
    nested = ("map", "array", "struct", "variant", "binary")
    return [name for name, kind in df.dtypes if not kind.startswith(nested)]
