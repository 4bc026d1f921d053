"""String, list and JSON text columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemart.functions.binding import let

# Fixed value: the characters a plain text may consist of.
PLAIN_TEXT = (
    r"\A[一-龥a-zA-Z0-9\[\]\-_+{}:：“<>`?!——+·~@#$%^&*()、，。；‘【】！@#￥%……&*（）" + r'"]+\z'
)
BLANK = r"\A[\x00-\x20]*\z"


def join_list(items: Column, delimiter: str) -> Column:
    """null items print as ``null``; a null list stays null."""
    return F.array_join(F.transform(items, lambda x: F.coalesce(x, F.lit("null"))), delimiter)


def to_csv(items: Column) -> Column:
    """F12."""
    return join_list(items, ", ")


def capitalise_first(s: Column) -> Column:
    """the rest keeps its case."""
    return F.concat(F.upper(F.left(s, F.lit(1))), F.substr(s, F.lit(2)))


def lowercase_first(s: Column) -> Column:
    """F13."""
    return F.concat(F.lower(F.left(s, F.lit(1))), F.substr(s, F.lit(2)))


def repeat_char(char: str, n: Column) -> Column:
    """F14."""
    return F.repeat(F.lit(char), n)


def zeros(n: Column) -> Column:
    """F14."""
    return repeat_char("0", n)


def is_empty(s: Column) -> Column:
    """null counts as empty."""
    return s.isNull() | (s == "")


def is_blank(s: Column) -> Column:
    """null, empty, or only characters up to the space."""
    return s.isNull() | s.rlike(BLANK)


def is_plain_text(s: Column) -> Column:
    """F16: the whole string is made of allowed characters."""
    return s.rlike(PLAIN_TEXT)


def append_to_list(json_list: Column, item: Column) -> Column:
    """a JSON list of texts plus one item, printed as ``[a, b]``.

    A null list is empty; a text that is no list raises.
    """
    listed = F.from_json(json_list, "array<string>")
    sound = json_list.rlike(r"\A\s*\[") & json_list.rlike(r"\]\s*\z")
    fault = F.raise_error(F.concat(F.lit("not a JSON list: "), json_list)).cast("array<string>")

    def checked(items: Column) -> Column:
        none = F.array().cast("array<string>")
        kept = F.when(json_list.isNull(), none).when(items.isNotNull() & sound, items).otherwise(fault)
        return F.concat(F.lit("["), to_csv(F.array_append(kept, item)), F.lit("]"))

    return let(listed, checked)


def row_key(items: list[tuple[Column, bool]], separator: str = "", whole_md5: bool = False) -> Column:
    """key items, hashed where asked, joined, and hashed as a whole if asked.

    A missing item is printed as ``null``, so that it keeps its place in the key.
    """
    texts = [(F.coalesce(c.cast("string"), F.lit("null")), hashed) for c, hashed in items]
    parts = [F.md5(c) if hashed else c for c, hashed in texts]
    key = F.concat_ws(separator, *parts)
    return F.md5(key) if whole_md5 else key


def to_json_text(row: Column) -> Column:
    """JSON text; null fields are left out."""
    return F.to_json(row)
