"""Split of app-log records into five kinds (P9-P13) and the fan-out (K3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.functions.binding import let
from tidemart.operators.parse import as_value, as_written, whole_number

# Output name -> topic.
DEFAULT_TOPICS = {
    "err": "log_err",
    "start": "log_start",
    "display": "log_display",
    "action": "log_action",
    "page": "log_page",
}


def field(item: Column, path: str, kind: str = "string") -> Column:
    """A typed value inside a record's item; null where it is missing or does not fit."""
    if kind == "string":
        return as_value(F.try_variant_get(item, path, kind))
    if kind == "bigint":
        return whole_number(F.try_variant_get(item, path, "string"))
    return F.coalesce(F.try_variant_get(item, path, kind), as_value(F.try_variant_get(item, path, "string")).try_cast(kind))


def text_of(item: Column) -> Column:
    """The JSON text of a parsed value, with numbers as the line had them and without null members."""
    return as_written(F.to_json(item))


def record_text(record: Column) -> Column:
    """The JSON text of a whole record."""
    return as_written(F.to_json(record))


def items(record: Column, name: str) -> Column:
    """The items of an array field; null if it is missing or no array."""
    return F.try_variant_get(record[name], "$", "array<variant>")


def has(record: Column, name: str) -> Column:
    return record[name].isNotNull() & ~F.is_variant_null(record[name])


def err_rows(df: DataFrame, *keep: str) -> DataFrame:
    """The ``err`` object alone; its record goes on to the other outputs."""
    record = F.col("record")
    return df.filter(has(record, "err")).select(*keep, record["err"].alias("err"))


def start_rows(df: DataFrame, *keep: str) -> DataFrame:
    """P10: records with ``start`` go here and nowhere else, without ``err``."""
    record = F.col("record")
    return df.filter(has(record, "start")).select(*keep, without_err(record).alias("record"))


def display_rows(df: DataFrame, *keep: str) -> DataFrame:
    """One row per display of a non-start record."""
    record = F.col("record")
    return df.filter(~has(record, "start")).select(
        *keep, record["common"].alias("common"), record["page"].alias("page"),
        F.explode(items(record, "displays")).alias("display"), record["ts"].alias("ts"),
    )


def action_rows(df: DataFrame, *keep: str) -> DataFrame:
    """One row per action of a non-start record; no record time."""
    record = F.col("record")
    return df.filter(~has(record, "start")).select(
        *keep, record["common"].alias("common"), record["page"].alias("page"),
        F.explode(items(record, "actions")).alias("action"),
    )


def page_rows(df: DataFrame, *keep: str) -> DataFrame:
    """Every non-start record without ``err`` and without filled arrays."""
    record = F.col("record")
    return df.filter(~has(record, "start")).select(*keep, page_record(record).alias("record"))


def without_err(record: Column) -> Column:
    return F.map_filter(record, lambda name, _: name != "err")


def _lists(record: Column) -> Column:
    return F.struct(*[items(record, n).alias(n) for n in ("displays", "actions")])


def _page_record(record: Column, lists: Column) -> Column:
    filled = {n: F.coalesce(F.size(lists[n]), F.lit(0)) > 0 for n in ("displays", "actions")}
    stays = lambda name: (name != "err") & ~((name == "displays") & filled["displays"]) & ~((name == "actions") & filled["actions"])
    return F.map_filter(record, lambda name, _: stays(name))


def page_record(record: Column) -> Column:
    """A record without ``err`` and without the arrays whose items are messages of their own."""
    return let(_lists(record), lambda lists: _page_record(record, lists))


def set_flag(record: Column, flag: Column) -> Column:
    """The record with another ``common.is_new``; all else, and a flag that does not change, stays as it is."""
    common = F.try_variant_get(record["common"], "$", "map<string,variant>")

    def changed(members: Column) -> Column:
        other = F.map_filter(members, lambda name, _: name != "is_new")
        return F.to_variant_object(F.map_concat(other, F.create_map(F.lit("is_new"), flag.cast("variant"))))

    rest = F.map_filter(record, lambda name, _: name != "common")
    new = F.map_concat(F.create_map(F.lit("common"), let(common, changed)), rest)
    # a ``common`` that is no object, and a flag that is missing, stay as they are
    stays = flag.isNull() | flag.eqNullSafe(field(record["common"], "$.is_new")) | common.isNull()
    return F.when(stays, record).otherwise(new)


def fan_out(
    df: DataFrame, topics: dict[str, str] | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """K3: (topic, value) rows for all five outputs from one pass over ``df``.

    One generator lists the messages of a record, so nothing is cached or scanned
    again and a topic-aware sink sends them in one job. Messages hold whatever
    fields the record had, numbers as they were written, and no null members.
    """
    names = {**DEFAULT_TOPICS, **(topics or {})}
    record = F.col("record")
    none = F.array().cast("array<struct<topic:string,value:string>>")

    def message(kind: str, value: Column) -> Column:
        return F.struct(F.lit(names[kind]).alias("topic"), value.alias("value"))

    def item_messages(kind: str, found: Column, *last: Column) -> Column:
        context = [record["common"].alias("common"), record["page"].alias("page")]
        return F.coalesce(
            F.transform(found, lambda item: message(kind, F.to_json(F.struct(*context, item.alias(kind), *last)))), none
        )

    def with_lists(lists: Column) -> Column:
        return F.concat(
            item_messages("display", lists["displays"], record["ts"].alias("ts")),
            item_messages("action", lists["actions"]),
            F.array(message("page", F.to_json(_page_record(record, lists)))),
        )

    messages = F.concat(
        F.when(has(record, "err"), F.array(message("err", F.to_json(record["err"])))).otherwise(none),
        F.when(has(record, "start"), F.array(message("start", F.to_json(without_err(record))))).otherwise(
            let(_lists(record), with_lists)
        ),
    )
    texts = F.transform(messages, lambda m: F.struct(m["topic"].alias("topic"), as_written(m["value"]).alias("value")))
    return df.select(*keep, F.inline(texts))
