"""Configuration-driven routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.operators.envelope import latest_per_key, no_deletes, prune_payload, text_payload
from tidemart.operators.joins import join_small


def live_config(
    changes: DataFrame,
    keys: tuple[str, ...] = ("source_table",),
    order: tuple[str, ...] = ("ts_ms", "seq"),
) -> DataFrame:
    """The configuration in force after a list of changes.

    ``changes`` are envelopes of the configuration table and ``keys`` the payload
    columns that name one of its rows. The last change of each key counts; a key
    whose last change is a delete is gone.
    """
    image = F.coalesce(F.col("after"), F.col("before"))
    keyed = changes.withColumns({f"_key{i}": image[k] for i, k in enumerate(keys)})
    last = latest_per_key(keyed, [f"_key{i}" for i in range(len(keys))], list(order))
    return last.filter(F.col("op") != "d").select("after")


def config_columns(live: DataFrame, names: list[str]) -> DataFrame:
    return live.select(*[F.col("after")[n].alias(n) for n in names])


def dim_route(
    cdc: DataFrame,
    config: DataFrame,
    namespace: str,
    keep: tuple[str, ...] = (),
    prune: bool = False,
    null_text: bool = True,
) -> DataFrame:
    """Rows of configured tables as (sink_table, row_key, info).

    Deletes are skipped and rows of other tables vanish. ``prune`` keeps only the
    columns listed in the configuration.
    """
    rows = no_deletes(cdc).withColumn("source_table", F.col("source")["table"])
    routed = join_small(rows, config, ["source_table"])
    payload = F.col("after")
    if prune:
        payload = prune_payload(payload, F.col("sink_columns"))
    return routed.select(
        *keep,
        F.concat(F.lit(f"{namespace}:"), F.col("sink_table")).alias("sink_table"),
        F.element_at("after", F.col("sink_row_key")).alias("row_key"),
        text_payload(payload, null_text).alias("info"),
    )


def fact_route(
    cdc: DataFrame,
    config: DataFrame,
    destination: str = "sink_table",
    match_source_type: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Rows of configured tables as (source_table, sink_table, topic, after).

    ``destination`` names the column the topic is taken from. With
    ``match_source_type`` a configuration row only takes changes of its type:
    inserts and snapshot rows count as ``insert``, updates as ``update``.
    """
    rows = no_deletes(cdc).withColumn("source_table", F.col("source")["table"])
    keys = ["source_table"]
    if match_source_type:
        rows = rows.withColumn("source_type", _source_type())
        keys.append("source_type")
    routed = join_small(rows, config, keys)
    return routed.select(
        *keep, "source_table", "sink_table", F.col(destination).alias("topic"), "after"
    )


def _source_type() -> Column:
    return F.when(F.col("op").isin("r", "c"), "insert").when(F.col("op") == "u", "update")


def lookup_dictionary(facts: DataFrame, dictionary: DataFrame, code: str) -> DataFrame:
    """Facts with the name their code has in ``dictionary(rk, info)``."""
    names = dictionary.select(
        F.col("rk").alias(code),
        F.col("info.dic_name").alias("dic_name"),
        F.col("info.parent_code").alias("parent_code"),
    )
    return join_small(facts, names, [code], "left")
