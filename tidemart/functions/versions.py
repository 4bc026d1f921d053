"""Dotted versions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def version_parts(v: Column, width: int | Column | None = None) -> Column:
    """The numbers of a version, right-padded with zeros to ``width``."""
    parts = F.transform(F.split(v, r"\."), lambda p: p.cast("int"))
    if width is None:
        return parts
    width = F.lit(width) if isinstance(width, int) else width
    missing = F.greatest(width - F.size(parts), F.lit(0)).cast("int")
    return F.concat(parts, F.array_repeat(F.lit(0), missing))


def larger_version(a: Column, b: Column) -> Column:
    """the greater version, ``a`` if they are equal."""
    width = F.greatest(F.size(F.split(a, r"\.")), F.size(F.split(b, r"\.")))
    return F.when(version_parts(a, width) >= version_parts(b, width), a).otherwise(b)


def latest_version(v: Column) -> Column:
    """Aggregate form: zeros at the end say nothing, and without them a longer list is greater.

    Of several spellings of the greatest version the greatest text counts.
    """
    bare = F.regexp_replace(v, r"(\.0+)+\z", "")
    return F.max_by(v, F.struct(version_parts(bare), v))
