"""JSON text to typed columns: drop, route or fail on bad rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.functions.binding import let


def _looks_like_object(value: Column) -> Column:
    return value.rlike(r"\A\s*\{") & value.rlike(r"\}\s*\z")


def _only(parsed: Column, value: Column) -> Column:
    """Whether the text held one object and nothing else."""
    return (F.size(parsed) == 1) & F.get(parsed, F.lit(0)).isNotNull() & _looks_like_object(value)


def _parse(value: Column, kind: str, **options: str) -> Column:
    """The text as the items of an array: text behind the first object shows as a fault or a second item."""
    return F.from_json(F.concat(F.lit("["), value, F.lit("]")), f"array<{kind}>", options)


def _struct(fields: dict[str, str]) -> str:
    return "struct<" + ", ".join(f"`{name}`: {kind}" for name, kind in fields.items()) + ">"


def _good(value: Column, kind: str) -> Column:
    """The object as a one-item array, empty where the text is bad; it holds the only use of ``from_json``."""
    return F.flatten(F.filter(F.array(_parse(value, kind)), lambda p: _only(p, value)))


def drop_bad(df: DataFrame, fields: dict[str, str], value: str = "value") -> DataFrame:
    """Keep rows whose ``value`` is a JSON object and expand its ``fields``.

    The generator holds the only use of ``from_json``. A plain filter over a
    parsed column would be pushed below the projection and parse twice.
    """
    return df.select("*", F.inline(_good(F.col(value), _struct(fields))))


# A number that a parser would print in another form travels as a text that starts with this character (U+FDD0, which no
# text in interchange should hold); where a line holds it all the same, it is doubled.
MARK = "\ufdd0"
_STRING = r'"(?:[^"\\]++|\\.)*+"'
_NUMBER = r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+-]?+[0-9]++)?+"
# Numbers outside of strings, one after the other from the start of the line.
_NEXT_NUMBER = rf'\G((?:[^"0-9\-]++|{_STRING})*+)({_NUMBER})(?=[\s,\]}}])'
_INEXACT = r"[:,\[]\s*-?[0-9]+(?:[.eE]|[0-9]{37})"


def _with_marks(value: Column) -> Column:
    doubled = F.when(value.contains(MARK), F.replace(value, F.lit(MARK), F.lit(MARK * 2))).otherwise(value)
    marked = F.regexp_replace(doubled, F.lit(_NEXT_NUMBER), F.lit(f'$1"{MARK}$2"'))
    return F.when(value.rlike(_INEXACT), marked).otherwise(doubled)


def as_written(text: Column) -> Column:
    """JSON text of parsed values with the numbers of the line and without null members."""

    def tidy(t: Column) -> Column:
        kept = F.regexp_replace(t, F.lit(f"{_STRING}:null,?+|({_STRING})"), F.lit("$1"))
        kept = F.regexp_replace(kept, F.lit(f"({_STRING})|,(?=}})"), F.lit("$1"))
        kept = F.when(t.contains(":null"), kept).otherwise(t)
        numbers = F.regexp_replace(kept, F.lit(f'"{MARK}({_NUMBER})"'), F.lit("$1"))
        return F.when(t.contains(MARK), F.replace(numbers, F.lit(MARK * 2), F.lit(MARK))).otherwise(kept)

    return let(text, lambda t: F.when(t.contains(":null") | t.contains(MARK), tidy(t)).otherwise(t))


def as_value(text: Column) -> Column:
    """A plain text read from a parsed value, without marks."""
    one = F.regexp_replace(text, F.lit(f"^{MARK}(?!{MARK})"), F.lit(""))
    return F.when(text.contains(MARK), F.replace(one, F.lit(MARK * 2), F.lit(MARK))).otherwise(text)


def _last_of_each(members: Column) -> Column:
    """The map; of a name that comes twice the last member counts."""
    names = F.map_keys(members)
    last = F.transform(
        F.array_distinct(names),
        lambda k: F.element_at(F.filter(F.map_entries(members), lambda e: e["key"] == k), F.lit(-1))["value"],
    )
    return F.when(F.size(F.array_distinct(names)) < F.size(names), F.map_from_arrays(F.array_distinct(names), last)).otherwise(members)


def log_records(df: DataFrame, value: str = "value", name: str = "record") -> DataFrame:
    """Keep rows whose ``value`` is a JSON object; all its fields, known or not, as parsed values in a map column.

    Of a repeated name the last member counts, at the top as inside. Numbers that a
    parser would print in another form are marked texts until ``as_written`` puts
    them back; ``applog.field`` reads them. One parse: the generator holds it.
    """
    text = F.col(value)
    parsed = F.from_json(F.concat(F.lit("["), _with_marks(text), F.lit("]")), "array<map<string,variant>>")
    good = F.flatten(F.filter(F.array(parsed), lambda p: _only(p, text)))
    return df.select("*", F.explode(F.transform(good, _last_of_each)).alias(name))


def is_bad(value: Column) -> Column:
    """True where ``value`` is not a JSON object."""
    return F.coalesce(F.size(_good(value, "struct<_none: string>")) != 1, F.lit(True))


def route_bad(
    df: DataFrame, fields: dict[str, str], value: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """(parsed good rows, raw bad rows)."""
    return drop_bad(df, fields, value), df.filter(is_bad(F.col(value)))


def fail_on_bad(
    df: DataFrame, fields: dict[str, str], value: str = "value", skip_null: bool = True
) -> DataFrame:
    """Expand ``fields`` and raise on the first malformed row.

    The generator keeps later filters from copying the parse into themselves.
    """
    rows = df.filter(F.col(value).isNotNull()) if skip_null else df
    kind, text = _struct(fields), F.col(value)
    fault = F.raise_error(F.concat(F.lit("Malformed record: "), F.coalesce(F.left(text, F.lit(200)), F.lit("null"))))
    checked = F.transform(
        F.array(_parse(text, kind, mode="FAILFAST")), lambda p: F.when(_only(p, text), p).otherwise(fault.cast(f"array<{kind}>"))
    )
    return rows.select("*", F.inline(F.flatten(checked)))


def app_log_rows(df: DataFrame, fields: dict[str, str], value: str = "value") -> DataFrame:
    """``drop_bad`` for the app log, with a numeric ``ts``."""
    rows = drop_bad(df, fields, value)
    return rows.withColumn("ts", F.col("ts").try_cast("bigint")) if "ts" in fields else rows


def log_rows(df: DataFrame, value: str = "value") -> DataFrame:
    """``log_records`` with a numeric ``ts`` next to ``record``."""
    return log_records(df, value).withColumn("ts", whole_number(F.try_variant_get(F.col("record")["ts"], "$", "string")))


def whole_number(text: Column) -> Column:
    """The whole part of a number in text, marked or not; null for anything else."""
    number = as_value(text)
    return F.coalesce(text.try_cast("bigint"), number.try_cast("decimal(38,6)").try_cast("bigint"))
