"""Evaluate an expression once and use it several times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` bound, not copied into each of its uses."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))
