"""Financial Chinese amounts (F2)."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from tidemart.functions.binding import let

# Digits, and units from the ones position upwards.
DIGITS = "零壹贰叁肆伍陆柒捌玖"
UNITS = ["", "拾", "佰", "仟", "万", "拾", "佰", "仟", "亿", "拾", "佰", "仟", "万", "拾", "佰", "仟", "元"]
YUAN, JIAO, FEN, WHOLE = "元", "角", "分", "整"

CENTS = Decimal("0.01")


@F.pandas_udf(T.DecimalType(36, 2))
def _exact_cents(x: pd.Series) -> pd.Series:
    # Decimal(float) is the exact binary value, so 1.005 rounds to 1.00.
    def one(v):
        if v is None or v != v or abs(v) >= 1e30:
            return None
        return Decimal(v).quantize(CENTS, ROUND_HALF_UP)

    return x.map(one)


def _digit(d: Column) -> Column:
    return F.lit(DIGITS).substr(d.cast("int") + 1, F.lit(1))


def _whole_text(whole: Column) -> Column:
    """The digits of an integer text with their units."""
    units = F.array(*[F.lit(u) for u in UNITS])

    def place(i: Column) -> Column:
        digit = F.substr(whole, i, F.lit(1))
        unit = F.get(units, (F.length(whole) - i).cast("int"))
        gap = F.when(F.substr(whole, i + 1, F.lit(1)) == "0", F.lit(DIGITS[0])).otherwise(F.lit(""))
        return F.when(digit == "0", F.lit("")).otherwise(F.concat(_digit(digit), unit, gap))

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(whole)), lambda i: place(i)), "")


def _cents_text(cents: Column) -> Column:
    """What follows ``元``."""

    def part(place: int, unit: str) -> Column:
        d = F.substring(cents, place, 1)
        return F.when(d == "0", F.lit("")).otherwise(F.concat(_digit(d), F.lit(unit)))

    return F.when(cents == "00", F.lit(WHOLE)).otherwise(F.concat(part(1, JIAO), part(2, FEN)))


def chinese_amount(x: Column, rounding: str = "decimal") -> Column:
    """an amount as text. Zero and negative amounts have no digits before ``元``.

    A digit other than zero prints itself, its unit, and ``零`` if the digit to its
    right is zero; zeros print nothing, and neither do the units they would carry.
    Amounts of 10**17 and more are out of the unit table and give null.

    ``rounding="decimal"`` rounds the decimal form of the number; ``"exact"``
    rounds the exact binary value of a double, which differs only where the
    decimal form is a tie at the third place; it sends all rows through Arrow.
    """
    if rounding == "exact":
        amount = _exact_cents(x.cast("double"))
    elif rounding == "decimal":
        amount = x.try_cast("decimal(36,2)")
    else:
        raise ValueError(f"unknown rounding {rounding!r}")
    positive = F.greatest(amount, F.lit(0).cast("decimal(36,2)"))
    whole = F.floor(positive).cast("string")
    cents = F.right(positive.cast("string"), F.lit(2))
    text = F.concat(let(whole, _whole_text), F.lit(YUAN), let(cents, _cents_text))
    return F.when(amount.isNotNull() & (amount < F.lit(10**17)), text)
