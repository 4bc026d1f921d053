"""Table lifecycle driven by configuration changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _action(action: str, image: str) -> Column:
    return F.struct(
        F.lit(action).alias("action"), F.col(image)["sink_table"].alias("table")
    )


def lifecycle_actions(changes: DataFrame, namespace: str) -> DataFrame:
    """(seq, step, action, table): what each configuration change asks for.

    A delete drops its table, a new row creates one unless it is there, an update
    drops the old table and creates the new one.
    """
    drop = _action("drop", "before")
    create = _action("create", "after")
    steps = (
        F.when(F.col("op") == "d", F.array(drop))
        .when(F.col("op").isin("r", "c"), F.array(create))
        .otherwise(F.array(drop, create))
    )
    return changes.select("seq", F.posexplode(steps).alias("step", "act")).select(
        "seq",
        "step",
        "act.action",
        F.concat(F.lit(f"{namespace}:"), F.col("act.table")).alias("table"),
    )


def final_actions(actions: DataFrame) -> DataFrame:
    """Per table, only the last action matters for whether it exists."""
    last = F.max_by("action", F.struct("seq", "step"))
    dropped = F.max((F.col("action") == "drop").cast("int")) == 1
    return actions.groupBy("table").agg(last.alias("action"), dropped.alias("recreate"))
