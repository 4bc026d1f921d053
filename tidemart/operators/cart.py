"""Cart-add fact and its change-log text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.operators.envelope import of_table

# Payload columns of the fact, in output order.
LEADING = ["id", "user_id", "sku_id", "cart_price"]
TRAILING = [
    "img_url", "sku_name", "is_checked", "create_time", "operate_time",
    "is_ordered", "order_time",
]


def cart_add(
    df: DataFrame,
    db: str,
    table: str = "cart_info",
    include_inserts: bool = False,
) -> DataFrame:
    """Rows that put something into a cart.

    By default snapshot rows are kept with a null quantity (they carry no
    ``before``) and inserts are left out. ``include_inserts`` keeps both with
    the quantity after the change.
    """
    after_num = F.col("after")["sku_num"].try_cast("bigint")
    before_num = F.col("before")["sku_num"].try_cast("bigint")
    grew = (
        (F.col("op") == "u")
        & F.col("before")["sku_num"].isNotNull()
        & (after_num > before_num)
    )
    whole = F.col("op").isin("r", "c") if include_inserts else F.col("op") == "c"
    kept = F.col("op").isin("r", "c") if include_inserts else F.col("op") == "r"

    def payload(name: str) -> Column:
        return F.col("after")[name].alias(name)

    return of_table(df, table, db).filter(kept | grew).select(
        *map(payload, LEADING),
        F.when(whole, after_num).otherwise(after_num - before_num).alias("sku_num"),
        *map(payload, TRAILING),
        "ts_ms",
    )


def changelog_text(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Each row as ``+I[a, b, ...]``; nulls print as ``null``."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns or df.columns]
    text = F.concat(F.lit("+I["), F.concat_ws(", ", *cells), F.lit("]"))
    return df.select(text.alias("value"))
