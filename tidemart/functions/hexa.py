"""Hexadecimal payloads and big numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemart.functions.binding import let

WORD = 64  # Fixed value: hex digits of one payload word.
UNIT_DIGITS = 18  # Fixed value: one unit is 10**18 of the smallest part.
NATIVE_HEX_DIGITS = 31  # 124 bits, the most a decimal(38,0) is sure to hold.
LIMB = 16
LIMB_DIGITS = 9
LIMB_BASE = 10**LIMB_DIGITS
CHUNK = 7  # hex digits: a limb times 2**28 fits 64 bits


def _hex_to_decimal(digits: Column, plus: int = 0) -> Column:
    """Up to 31 hex digits as decimal text, put together from two 64-bit halves; ``plus`` is added to the number."""
    padded = F.lpad(digits, 2 * LIMB, "0")
    high, low = (
        F.conv(F.substring(padded, start, LIMB), 16, 10).cast("decimal(20,0)")
        for start in (1, LIMB + 1)
    )
    number = high * F.lit(str(2**64)).cast("decimal(20,0)") + low
    return (number + plus if plus else number).cast("decimal(38,0)").cast("string")


def _hex_fold(digits: Column, plus: int = 0) -> Column:
    """Any number of hex digits as decimal text: limbs of nine decimal digits, multiplied and added to by 28 bits at a time.

    ``plus`` is added to the number.
    """
    return let(digits, lambda d: _fold_limbs(d, plus))


def _fold_limbs(digits: Column, plus: int) -> Column:
    count = F.ceil(F.length(digits) / CHUNK).cast("int")
    padded = F.lpad(digits, count * CHUNK, F.lit("0"))

    def chunk_at(i: Column) -> Column:
        part = F.conv(F.substr(padded, i * CHUNK + 1, F.lit(CHUNK)), 16, 10).cast("bigint")
        return part + F.when(i == count - 1, plus).otherwise(0) if plus else part

    chunks = F.transform(F.sequence(F.lit(0), count - 1), chunk_at)
    none = F.array().cast("array<bigint>")

    def push(limbs: Column, chunk: Column) -> Column:
        def add(state: Column, limb: Column) -> Column:
            sum_ = limb * (1 << 4 * CHUNK) + state["carry"]
            rest = sum_ % LIMB_BASE
            return let(rest, lambda r: F.struct(F.call_function("div", sum_ - r, F.lit(LIMB_BASE)).alias("carry"), F.concat(state["out"], F.array(r)).alias("out")))

        start = F.struct(chunk.alias("carry"), none.alias("out"))
        return F.aggregate(
            limbs, start, add, lambda s: F.when(s["carry"] > 0, F.concat(s["out"], F.array(s["carry"]))).otherwise(s["out"])
        )

    limbs = F.aggregate(chunks, none, push)
    text = F.array_join(F.transform(F.reverse(limbs), lambda v: F.lpad(v.cast("string"), LIMB_DIGITS, "0")), "")
    return let(text, _no_zeros)


def _no_zeros(digits: Column) -> Column:
    bare = F.ltrim(digits, F.lit("0"))
    return F.when(bare == "", F.lit("0")).otherwise(bare)


def _plain(number: Column) -> Column:
    """``digits`` times ten to the minus ``scale``, with a sign if ``minus``; ``keep`` decimals stay, zeros behind them go."""
    digits, scale = number["digits"], number["scale"]
    whole = F.concat(digits, F.repeat(F.lit("0"), -scale))
    padded = F.lpad(digits, F.greatest(F.length(digits), scale + 1), F.lit("0"))
    left = _no_zeros(F.left(padded, F.length(padded) - scale))
    kept = F.concat(
        F.substr(F.right(padded, scale), F.lit(1), number["keep"]),
        F.rtrim(F.substr(F.right(padded, scale), number["keep"] + 1), F.lit("0")),
    )
    split = F.concat(left, F.when(kept == "", F.lit("")).otherwise(F.concat(F.lit("."), kept)))
    text = F.when(scale <= 0, _no_zeros(whole)).otherwise(split)
    return F.concat(F.when(number["minus"] & digits.rlike("[1-9]"), F.lit("-")).otherwise(F.lit("")), text)


def _number(digits: Column, scale: Column, minus: Column, divide: bool) -> Column:
    return F.struct(
        digits.alias("digits"), (scale + (UNIT_DIGITS if divide else 0)).cast("int").alias("scale"), minus.alias("minus"),
        F.greatest(scale, F.lit(0)).cast("int").alias("keep"),
    )


HEX = r"\A0x[+-]?[0-9a-fA-F]+\z"
INTEGER = r"\A[+-]?[0-9]+\z"
DECIMAL = r"\A([+-]?)(?=\.?[0-9])([0-9]*)(?:\.([0-9]*))?(?:[eE]([+-]?[0-9]{1,9}))?\z"


def to_decimal_text(x: Column, divide: bool = False, wide: bool = True, malformed: str = "error") -> Column:
    """``0x`` hex or decimal text as plain decimal text; null gives ``0``.

    ``divide`` gives units of 10**18. All of it is column functions; hex numbers
    beyond 124 bits are folded limb by limb. A text that is no number raises, or
    gives null with ``malformed="null"``. ``wide=False`` gives null for longer hex
    numbers, fractions and exponents.
    """
    if malformed not in ("error", "null"):
        raise ValueError("malformed is 'error' or 'null'")
    hex_digits = F.regexp_replace(x, r"\A0x[+-]?0*", "")
    zero, minus = F.lit(0), F.substr(x, F.lit(3), F.lit(1)) == "-"
    short = F.length(hex_digits) <= NATIVE_HEX_DIGITS
    part = lambda i: F.regexp_extract(x, DECIMAL, i)
    exponent = F.coalesce(F.nullif(part(4), F.lit("")).try_cast("int"), zero)
    small = F.when(x.rlike(HEX) & short, _number(_hex_to_decimal(hex_digits), zero, minus, divide)).when(
        x.rlike(INTEGER), _number(_no_zeros(F.ltrim(x, F.lit("+-"))), zero, x.startswith("-"), divide)
    )
    large = F.when(x.rlike(HEX), _number(_hex_fold(hex_digits), zero, minus, divide)).when(
        x.rlike(DECIMAL), _number(F.concat(part(2), part(3)), F.length(part(3)) - exponent, part(1) == "-", divide)
    )
    bad = F.raise_error(F.concat(F.lit("not a number: "), F.left(x, F.lit(200)))).cast("string")
    text = let(F.coalesce(small, large) if wide else small, lambda n: F.when(n.isNotNull(), _plain(n)))
    known = x.rlike(HEX) | x.rlike(DECIMAL)
    found = F.when(x.isNull(), F.lit("0")).when(known, text)
    return found.otherwise(bad) if malformed == "error" else found


def decode_cdc_decimal(x: Column, scale: int) -> Column:
    """The plain text, with ``scale`` decimals, of a change feed's decimal: base 64 of a big-endian two's complement number.

    Numbers of any width, negative ones too; those of up to 124 bits are put together natively, wider ones folded
    limb by limb. Null and empty texts give null.
    """
    raw = F.hex(F.unbase64(x))

    def sized(digits: Column) -> Column:
        minus = F.substr(digits, F.lit(1), F.lit(1)) >= "8"
        flipped = F.translate(digits, "0123456789ABCDEF", "FEDCBA9876543210")
        size = F.ltrim(F.when(minus, flipped).otherwise(digits), F.lit("0"))
        return F.when(digits != "", F.struct(size.alias("hex"), minus.alias("minus")))

    def number(found: Column) -> Column:
        digits, minus = found["hex"], found["minus"]
        short = F.length(digits) <= NATIVE_HEX_DIGITS
        native = F.when(minus, _hex_to_decimal(digits, 1)).otherwise(_hex_to_decimal(digits))
        folded = F.when(minus, _hex_fold(digits, 1)).otherwise(_hex_fold(digits))
        return F.struct(
            F.when(short, native).otherwise(folded).alias("digits"), F.lit(scale).alias("scale"), minus.alias("minus"),
            F.lit(scale).alias("keep"),
        )

    # each step is bound, so that none is evaluated again for the uses of the next
    told = let(let(raw, sized), lambda f: F.when(f.isNotNull(), number(f)))
    return let(told, lambda n: F.when(n.isNotNull(), _plain(n)))


def payload_words(x: Column) -> Column:
    """the 64-digit words of a ``0x`` payload; null and empty give no words."""
    count = F.floor(F.coalesce(F.length(x), F.lit(0)) / WORD).cast("int")
    words = F.transform(
        F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
        lambda i: F.concat(F.lit("0x"), F.substr(x, i * WORD - (WORD - 3), F.lit(WORD))),
    )
    return F.when(count > 0, words).otherwise(F.array().cast("array<string>"))
