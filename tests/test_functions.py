"""Golden values of the column functions."""

import random
from decimal import ROUND_HALF_UP, Decimal

import base64

import pytest
from pyspark.sql import functions as F

from tidemart.functions import amount, dates, hashing, hexa, identity, registry, text, versions


def values(spark, cases, kind, *columns):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], f"i int, x {kind}")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def x():
    return F.col("x")

IDS = [
    ("110101190001010014", "有效身份证"),
    ("\t110101190001010014 ", "有效身份证"),
    ("11010119000101009X", "有效身份证"),
    ("11010119000101009x", "校验码错误"),
    ("110101190001010015", "校验码错误"),
    ("110101190001000019", "格式错误"),
    ("110101190001320012", "格式错误"),
    ("11010119000101001", "无效长度"),
    ("", "无效长度"),
    ("1101011900010100\n4", "格式错误"),
    ("110101190001010😀", "无效长度"),
    ("1101011900010100😀", "格式错误"),
    (None, None),
]


def test_id_card(spark):
    registry.register(spark)
    got = values(
        spark, [c for c, _ in IDS], "string",
        identity.validate_id_card(x()), F.expr("validate_id_card(x)"),
    )
    assert got == [(want, want) for _, want in IDS]


AMOUNTS = [
    (0.0, "元整"), (0.05, "元伍分"), (0.5, "元伍角"), (1.05, "壹元伍分"), (10.0, "壹拾零元整"),
    (100.0, "壹佰零元整"), (1005.0, "壹仟零伍元整"), (10000.0, "壹万零元整"), (100000.0, "壹拾零元整"),
    (1000000.0, "壹佰零元整"), (123456.78, "壹拾贰万叁仟肆佰伍拾陆元柒角捌分"),
    (144449.04, "壹拾肆万肆仟肆佰肆拾玖元肆分"),
    (71667572899.576, "柒佰壹拾陆亿陆仟柒佰伍拾柒万贰仟捌佰玖拾玖元伍角捌分"),
    (-5.5, "元整"), (1e16, "壹元零元整"), (1e17, None), (None, None),
]


def test_amount_golden(spark):
    registry.register(spark)
    got = values(
        spark, [c for c, _ in AMOUNTS], "double", amount.chinese_amount(x()),
        amount.chinese_amount(x(), "exact"), F.expr("convert_number_chinese_amount(x)"),
    )
    assert got == [(want,) * 3 for _, want in AMOUNTS]


def test_amount_ties(spark):
    got = values(
        spark, [1.005, 1.0049996], "double", amount.chinese_amount(x()), amount.chinese_amount(x(), "exact")
    )
    assert got == [("壹元壹分", "壹元整"), ("壹元整", "壹元整")]


def digit_walk(x: Decimal) -> str:
    """The amount rule by walking the digits from the right."""
    x = max(x.quantize(Decimal("0.01"), ROUND_HALF_UP), Decimal(0))
    whole, cents, out, gap = int(x), int(x % 1 * 100), "", False
    for power, digit in enumerate(reversed(str(whole))):
        if digit == "0":
            gap = True
            continue
        out = amount.DIGITS[int(digit)] + amount.UNITS[power] + ("零" if gap else "") + out
        gap = False
    tail = "".join(
        amount.DIGITS[d] + unit for d, unit in ((cents // 10, "角"), (cents % 10, "分")) if d
    )
    return out + "元" + (tail or "整")


def test_amount_random(spark):
    rng = random.Random(7)
    cases = [
        Decimal(rng.randrange(10 ** rng.randrange(1, 18))).scaleb(-2).quantize(Decimal("0.01"))
        for _ in range(2000)
    ]
    got = values(spark, cases, "decimal(20,2)", amount.chinese_amount(x()))
    assert [g for (g,) in got] == [digit_walk(c) for c in cases]


def test_hash(spark):
    hot = "0xA0B86991C6218B36C1D19D4A2E9EB0CE3606EB48"
    got = values(
        spark, ["abc", "1", "mid_279", hot], "string", hashing.hash_mod(x()), hashing.hot_hash_mod(x()),
        hashing.hot_hash_mod(x(), {"abc": "9100"}),
    )
    assert [g[0] for g in got[:3]] == ["0114", "0027", "0029"]
    assert [g[1] for g in got] == ["0114", "0027", "0029", "9007"]
    assert got[0][2] == "9100" and got[3][2] == got[3][0]


def test_hex(spark):
    cases = [
        ("0xde0b6b3a7640000", "1000000000000000000", "1"), (None, "0", "0"), ("0x0", "0", "0"),
        ("0x" + "0" * 40 + "ff", "255", "0.000000000000000255"), ("007", "7", "0.000000000000000007"),
        ("1500000000000000000", "1500000000000000000", "1.5"), ("-5", "-5", "-0.000000000000000005"),
        ("0x", None, None), ("zz", None, None), ("-0", "0", "0"), ("0x" + "f" * 31, str(16**31 - 1), None),
    ]
    got = values(
        spark, [c for c, _, _ in cases], "string",
        *[hexa.to_decimal_text(x(), d, w, malformed="null") for w in (False, True) for d in (False, True)],
    )
    for (case, plain, units), row in zip(cases, got):
        assert row[0] == row[2] == plain, case
        assert row[1] == row[3], case
        assert units is None or row[1] == units, case


def test_hex_wide(spark):
    cases = ["0x" + "f" * 64, "1.50", "1000000000000000000.00", "1e3"]
    got = values(
        spark, cases, "string", hexa.to_decimal_text(x(), wide=True),
        hexa.to_decimal_text(x(), divide=True, wide=True), hexa.to_decimal_text(x(), wide=False),
    )
    whole = str(16**64 - 1)
    assert got == [
        (whole, f"{whole[:-18]}.{whole[-18:]}", None),
        ("1.50", "0.0000000000000000015", None),
        ("1000000000000000000.00", "1.00", None),
        ("1000", "0.000000000000001", None),
    ]


def plain_number(text, divide):
    """The rule in plain Python: exact quotient, no fewer decimals than the number had."""
    sign = "-" if text.lstrip("0x").startswith("-") or text.startswith("-") else ""
    if text.startswith("0x"):
        digits, scale = str(abs(int(text[2:], 16))), 0
    else:
        body, _, exp = text.lstrip("+-").lower().partition("e")
        whole, _, frac = body.partition(".")
        digits, scale = whole + frac, len(frac) - int(exp or 0)
    keep = max(scale, 0)
    scale += 18 if divide else 0
    digits = digits + "0" * max(0, -scale)
    scale = max(scale, 0)
    digits = digits.rjust(scale + 1, "0")
    left, right = (digits[:-scale], digits[-scale:]) if scale else (digits, "")
    while len(right) > keep and right.endswith("0"):
        right = right[:-1]
    sign = sign if digits.strip("0") else ""
    return sign + (left.lstrip("0") or "0") + ("." + right if right else "")


def test_wide_numbers_equal_plain_python(spark):
    rng = random.Random(5)
    cases = ["0x" + "".join(rng.choice("0123456789abcdefABCDEF") for _ in range(rng.randint(1, 130))) for _ in range(60)]
    cases += ["0x-ff", "0x+0", "0x" + "f" * 64, "0x1" + "0" * 70, "5.", ".5", "-.50e2", "0.00", "0e5", "1e-30", "-1.230E+20", "+7", "00.10"]
    cases += [f"{rng.choice(['', '-'])}{rng.randint(0, 10**rng.randint(1, 40))}.{rng.randint(0, 999)}e{rng.randint(-25, 25)}" for _ in range(60)]
    got = values(spark, cases, "string", hexa.to_decimal_text(x()), hexa.to_decimal_text(x(), divide=True))
    assert got == [(plain_number(c, False), plain_number(c, True)) for c in cases]


@pytest.mark.parametrize("text", ["0xf_f", "1_000", " 12 ", "0x", "", "1e", "--1", "0xg", "1.2.3", "NaN"])
def test_malformed_numbers_raise(spark, text):
    assert values(spark, [text], "string", hexa.to_decimal_text(x(), malformed="null")) == [(None,)]
    with pytest.raises(Exception, match="not a number"):
        values(spark, [text], "string", hexa.to_decimal_text(x()))


def test_cdc_decimals(spark):
    def encoded(v, size):
        return base64.b64encode(v.to_bytes(size, "big", signed=True)).decode()

    rng = random.Random(3)
    numbers = [(v, n) for n in (1, 3, 8, 9, 17, 40) for v in (0, 1, -1, 127, -128, rng.randrange(-(1 << 8 * n - 1), 1 << 8 * n - 1))]
    cases = [encoded(v, n) for v, n in numbers] + ["", None]
    want = []
    for v, _ in numbers:
        digits = str(abs(v)).rjust(3, "0")
        want.append(("-" if v < 0 else "") + digits[:-2] + "." + digits[-2:])
    got = values(spark, cases, "string", hexa.decode_cdc_decimal(x(), 2))
    assert [g for (g,) in got] == [*want, None, None]


def test_cdc_decimals_are_not_folded_again_for_each_use(spark):
    """The plan held 528 folds where the steps were not bound."""
    texts = spark.createDataFrame([("AQ==",)], "x string").select(hexa.decode_cdc_decimal(x(), 2))
    plan = texts._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("aggregate(") <= 8


def test_words(spark):
    word = "0123456789abcdef" * 4
    cases = ["0x" + word * 3, "", None, "0x" + word[:40], "0x" + word + "12"]
    got = values(spark, cases, "string", hexa.payload_words(x()))
    assert [g for (g,) in got] == [["0x" + word] * 3, [], [], [], ["0x" + word]]


@pytest.mark.parametrize(
    "a, b, want",
    [("1.0.0", "1.0.1", "1.0.1"), ("1.0", "1.0.0", "1.0"), ("1.0.0", "1.0", "1.0.0"), ("1.0.10", "1.0.9", "1.0.10")],
)
def test_versions(spark, a, b, want):
    row = spark.range(1).select(versions.larger_version(F.lit(a), F.lit(b)).alias("v")).first()
    assert row.v == want


def test_dates(spark):
    row = spark.sql("SELECT date'2024-02-28' a, date'2024-03-01' b").select(
        dates.day_range(F.col("a"), F.col("b")), dates.day_range(F.col("b"), F.col("a")),
        dates.datetime_to_ts(F.lit("2023-07-05 01:01:01")), dates.ts_to_date(F.lit(1704067199000)),
        dates.ts_to_date(F.lit(1704067199000), "+08:00"), dates.day_bucket(F.lit(1704067200)),
        dates.day_bucket(F.lit(1704067200000)), dates.day_bucket(F.lit(None).cast("bigint")),
        dates.date_to_ts(F.lit("2024-01-01")), dates.yesterday(F.lit(1704067200000)),
    ).first()
    assert list(row) == [
        [20240228, 20240229, 20240301], [], 1688490061000, "2023-12-31", "2024-01-01",
        "day=20240101", "day=20240101", "day=19700101", 1704038400000, "2023-12-31",
    ]


def test_text(spark):
    got = values(
        spark, ["fooBar", "", " \t", None, "a"], "string", text.capitalise_first(x()), text.is_empty(x()), text.is_blank(x())
    )
    assert got == [
        ("FooBar", False, False), ("", True, True), (" \t", False, True), (None, True, True), ("A", False, False),
    ]
    assert values(spark, ["FooBar"], "string", text.lowercase_first(x())) == [("fooBar",)]
    assert values(spark, ['["a"]', None], "string", text.append_to_list(x(), F.lit("b"))) == [("[a, b]",), ("[b]",)]
    assert values(spark, [["a", None], None], "array<string>", text.to_csv(x())) == [("a, null",), (None,)]
    assert values(spark, ["中文abc_1", "a b", "a.b", "abc\n", "【x】"], "string", text.is_plain_text(x())) == [
        (True,), (False,), (False,), (False,), (True,),
    ]


def test_plain_text_marks(spark):
    """Every listed mark by itself, and some that are not listed."""
    marks = list("[]-_+{}:：“<>`?!——+·~@#$%^&*()、，。；‘【】！￥……（）") + ['"', "a)b", "龥", "0"]
    assert [r[0] for r in values(spark, marks, "string", text.is_plain_text(x()))] == [True] * len(marks)
    assert [r[0] for r in values(spark, ["a b", "a.b", "", "é", ";"], "string", text.is_plain_text(x()))] == [False] * 5


def test_append_to_broken_list(spark):
    for broken in ('["a","b"', "x", '{"a":1}', '["a"] y'):
        with pytest.raises(Exception, match="not a JSON list"):
            values(spark, [broken], "string", text.append_to_list(x(), F.lit("b")))


def test_versions_of_any_length(spark):
    rows = [("a", "1.2"), ("a", "1.2.0.0.0.0.0.0.0.0"), ("b", "1.2.0.0.0.0.0.0.0.1"), ("b", "1.2"), ("c", "0.0"), ("c", "0.1")]
    got = spark.createDataFrame(rows, "k string, v string").groupBy("k").agg(versions.latest_version(F.col("v")).alias("v"))
    found = {r.k: r.v for r in got.collect()}
    assert found["a"] in ("1.2", "1.2.0.0.0.0.0.0.0.0") and found["b"] == "1.2.0.0.0.0.0.0.0.1" and found["c"] == "0.1"


def test_missing_key_parts_keep_their_place(spark):
    rows = spark.createDataFrame([("a", None), (None, "a")], "p string, q string")
    keys = rows.select(text.row_key([(F.col("p"), False), (F.col("q"), False)]).alias("k")).collect()
    assert len({r.k for r in keys}) == 2
