"""Queries of the log layer: parsing, split, flag repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.operators import applog
from tidemart.operators.applog import field
from tidemart.operators.parse import app_log_rows, log_rows, route_bad
from tidemart.operators.tasks import dealt
from tidemart.operators.visitor import repair_log, repair_visitors
from tidemart.plans import oracle_parts as sql
from tidemart.plans.adapters import app_log_lines, exact_lines, table
from tidemart.plans.registry import query
from tidemart.schemas import app_log
from tidemart.streaming.jobs import KEY_FIELDS


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return app_log_lines(table(spark, sf_dir, "events"))


def parsed(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    return app_log_rows(lines(spark, sf_dir), app_log(*names)).drop("value")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_rows(lines(spark, sf_dir)).drop("value")


def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys_of(lines(spark, sf_dir))


def keys_of(text: DataFrame) -> DataFrame:
    rows = app_log_rows(text, KEY_FIELDS)
    return rows.select("seq", "ts", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"))


@query(
    "P1_drop_bad",
    sql.LOG + """
SELECT seq, mid, is_new, ts, page_id, CASE WHEN nd > 0 THEN nd END AS n_displays,
       CASE WHEN na > 0 THEN na END AS n_actions FROM al""",
)
def drop_bad(spark, sf_dir):
    return parsed(spark, sf_dir).select(
        "seq", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"), "ts",
        F.col("page.page_id").alias("page_id"),
        F.size("displays").cast("bigint").alias("n_displays"),
        F.size("actions").cast("bigint").alias("n_actions"),
    )


@query("P2_invalid_rows", "SELECT event_id AS seq FROM events WHERE event_id % 50 = 7")
def invalid_rows(spark, sf_dir):
    return route_bad(lines(spark, sf_dir), KEY_FIELDS)[1].select("seq")


@query("P2_valid_rows", sql.LOG + "SELECT seq, mid FROM al")
def valid_rows(spark, sf_dir):
    good = route_bad(lines(spark, sf_dir), KEY_FIELDS)[0]
    return good.select("seq", F.col("common.mid").alias("mid"))


_CODE = "CASE WHEN k % 5 = 0 THEN 'E' || k ELSE CAST(k + 1000 AS VARCHAR) END"
_DURING = "CASE WHEN k % 13 = 0 THEN 'x' || k ELSE CAST(k * 100 AS VARCHAR) END"


def texts(item, *names: str) -> list:
    """Text fields of an object column, by name."""
    return [field(F.col(item), f"$.{n}").alias(n) for n in names]


@query(
    "P9_err",
    sql.LOG + f"""
SELECT seq, {_CODE} AS error_code, 'msg_' || k AS msg, 'at ' || k % 8 AS stack FROM al WHERE event_type = 'error'""",
)
def err(spark, sf_dir):
    return applog.err_rows(records(spark, sf_dir), "seq").select("seq", *texts("err", "error_code", "msg", "stack"))


@query(
    "P10_start",
    sql.LOG + """
SELECT seq, mid, 'icon' AS entry, k AS loading_time, ts, 'net_' || k % 3 AS net, 'tag_' || k % 9 AS tag
FROM al WHERE event_type = 'signup'""",
)
def start(spark, sf_dir):
    rows = applog.start_rows(records(spark, sf_dir), "seq", "ts")
    record = F.col("record")
    return rows.select(
        "seq", field(record["common"], "$.mid").alias("mid"), field(record["start"], "$.entry").alias("entry"),
        field(record["start"], "$.loading_time", "bigint").alias("loading_time"), "ts",
        field(record["common"], "$.net").alias("net"), field(record["tag"], "$").alias("tag"),
    )


@query(
    "P11_displays",
    sql.LOG + """
SELECT seq, mid, page_id, 'ref_' || k % 6 AS refer_id, CAST(k + i AS VARCHAR) AS item, CAST(k % 6 AS VARCHAR) AS pos_id,
  CAST(i AS VARCHAR) AS pos_seq, CAST(k % 4 AS VARCHAR) AS rank, ts
FROM (SELECT *, unnest(range(nd)) AS i FROM al WHERE nd > 0)""",
)
def displays(spark, sf_dir):
    return applog.display_rows(records(spark, sf_dir), "seq").select(
        "seq", *texts("common", "mid"), *texts("page", "page_id", "refer_id"),
        *texts("display", "item", "pos_id", "pos_seq", "rank"), field(F.col("ts"), "$", "bigint").alias("ts"),
    )


@query(
    "P12_actions",
    sql.LOG + """
SELECT seq, mid, page_id, 'net_' || k % 3 AS net, event_type AS action_id, CAST(k + i AS VARCHAR) AS item,
  'way_' || k % 2 AS way, ts + i AS action_ts
FROM (SELECT *, unnest(range(na)) AS i FROM al WHERE na > 0)""",
)
def actions(spark, sf_dir):
    return applog.action_rows(records(spark, sf_dir), "seq").select(
        "seq", *texts("common", "mid", "net"), *texts("page", "page_id"), *texts("action", "action_id", "item", "way"),
        field(F.col("action"), "$.ts", "bigint").alias("action_ts"),
    )


@query(
    "P13_page",
    sql.LOG + f"""
SELECT seq, mid, page_id, {_DURING} AS during_time, 'ref_' || k % 6 AS refer_id, 'tag_' || k % 9 AS tag, ts, 0 AS left_over
FROM al WHERE event_type <> 'signup'""",
)
def page(spark, sf_dir):
    record = F.col("record")
    left_over = [F.coalesce(F.size(applog.items(record, n)), F.lit(0)) for n in ("displays", "actions")]
    left_over.append(record["err"].isNotNull().cast("int"))
    return applog.page_rows(records(spark, sf_dir), "seq", "ts").select(
        "seq", field(record["common"], "$.mid").alias("mid"),
        *[field(record["page"], f"$.{n}").alias(n) for n in ("page_id", "during_time", "refer_id")],
        field(record["tag"], "$").alias("tag"), "ts", sum(left_over[1:], left_over[0]).alias("left_over"),
    )


MESSAGES = """
, m AS (
  SELECT seq, 'log_err' AS topic, NULL AS mid, NULL AS net, NULL AS refer_id, NULL AS item, """ + _CODE + """ AS error_code,
    NULL AS tag FROM al WHERE event_type = 'error'
  UNION ALL SELECT seq, 'log_start', mid, 'net_' || k % 3, NULL, NULL, NULL, 'tag_' || k % 9 FROM al WHERE event_type = 'signup'
  UNION ALL SELECT seq, 'log_page', mid, 'net_' || k % 3, 'ref_' || k % 6, NULL, NULL, 'tag_' || k % 9
    FROM al WHERE event_type <> 'signup'
  UNION ALL SELECT seq, 'log_display', mid, 'net_' || k % 3, 'ref_' || k % 6, CAST(k + i AS VARCHAR), NULL, NULL
    FROM (SELECT *, unnest(range(nd)) AS i FROM al WHERE nd > 0)
  UNION ALL SELECT seq, 'log_action', mid, 'net_' || k % 3, 'ref_' || k % 6, CAST(k + i AS VARCHAR), NULL, NULL
    FROM (SELECT *, unnest(range(na)) AS i FROM al WHERE na > 0)
)
"""


@query("K3_fanout", sql.LOG + MESSAGES + "SELECT * FROM m")
def fanout(spark, sf_dir):
    return flat_messages(applog.fan_out(records(spark, sf_dir), keep=("seq",)), "seq")


@query(
    "K3_exact_text",
    sql.LOG + MESSAGES + """
SELECT seq, topic, item, CASE WHEN topic <> 'log_err' THEN seq || '.500' END AS lat,
  CASE WHEN whole THEN seq || '.' || seq % 10 || '0' END AS amt, CASE WHEN whole THEN (seq % 9 + 1) || 'e' || seq % 5 END AS exp,
  CASE WHEN whole THEN '9' || lpad(CAST(seq AS VARCHAR), 49, '0') END AS big, CASE WHEN whole THEN CAST(seq AS VARCHAR) END AS twice,
  CASE WHEN whole THEN '{"b":' || seq || '.0}' END AS deep, false AS has_null
FROM (SELECT *, topic IN ('log_page', 'log_start') AS whole FROM m)""",
)
def exact_text(spark, sf_dir):
    """Numbers reach the messages as they were written, null members do not, of a repeated name the last one counts."""
    rows = log_rows(exact_lines(lines(spark, sf_dir))).drop("value")
    found = {
        "lat": r'"lat":([0-9.]+)', "amt": r'"amt":([0-9.]+)', "exp": r'"exp":([0-9e]+)', "big": r'"big":([0-9]+)',
        "twice": r'"twice":([0-9]+)', "deep": r'"deep":(\{[^}]*\})',
    }
    text, sent = F.col("value"), applog.fan_out(rows, keep=("seq",))
    item = F.coalesce(F.get_json_object(text, "$.display.item"), F.get_json_object(text, "$.action.item"))
    texts = [F.nullif(F.regexp_extract(text, p, 1), F.lit("")).alias(n) for n, p in found.items()]
    return sent.select("seq", "topic", item.alias("item"), *texts, text.contains("null").alias("has_null"))


def flat_messages(messages: DataFrame, *keep: str) -> DataFrame:
    fields = (
        "common struct<mid:string,net:string>, page struct<refer_id:string>, display struct<item:string>, "
        "action struct<item:string>, error_code string, tag string"
    )
    m = messages.withColumn("m", F.from_json("value", fields))
    return m.select(
        *keep, "topic", F.col("m.common.mid").alias("mid"), F.col("m.common.net").alias("net"),
        F.col("m.page.refer_id").alias("refer_id"),
        F.coalesce("m.display.item", "m.action.item").alias("item"),
        F.col("m.error_code").alias("error_code"), F.col("m.tag").alias("tag"),
    )


@query("N1_new_visitor", sql.visitor("seq"))
def new_visitor(spark, sf_dir):
    return repair_visitors(keyed(spark, sf_dir)).select("seq", "mid", "is_new")


@query("N1_new_visitor_chunked", sql.visitor("seq"))
def new_visitor_chunked(spark, sf_dir):
    """The same with small chunks, so that states are carried between them."""
    return repair_visitors(keyed(spark, sf_dir), chunk_size=1000).select("seq", "mid", "is_new")


@query("N1_new_visitor_documented", sql.visitor("seq", documented=True))
def new_visitor_documented(spark, sf_dir):
    return repair_visitors(keyed(spark, sf_dir), rule="as_documented").select("seq", "mid", "is_new")


@query("N1_new_visitor_event_time", sql.visitor("ts, seq"))
def new_visitor_event_time(spark, sf_dir):
    return repair_visitors(keyed(spark, sf_dir), order="event_time").select("seq", "mid", "is_new")


@query("N1_new_visitor_event_cuts", sql.visitor("ts, seq"))
def new_visitor_event_cuts(spark, sf_dir):
    """The same with windows of half a year that are cut where a device has more than three rows."""
    rows = keyed(spark, sf_dir)
    return repair_visitors(rows, order="event_time", chunk_size=180 * 86_400_000, bound=3).select("seq", "mid", "is_new")


@query(
    "N1_log_split",
    sql.visitor("seq").replace(
        "SELECT seq, mid, CASE WHEN one AND coalesce(mark, seed)",
        ", r AS (SELECT seq, mid, CASE WHEN one AND coalesce(mark, seed)",
    )
    + """)
SELECT r.is_new, count(*) AS n, CAST(sum(al.nd) AS BIGINT) AS n_displays
FROM r JOIN al ON r.seq = al.seq WHERE al.event_type <> 'signup' GROUP BY r.is_new""",
)
def log_split(spark, sf_dir):
    """Repaired records through the page split, profiled by flag.

    Events are dealt before they become records, which are many times as large and wait in their task for the exchange.
    """
    record, text = F.col("record"), app_log_lines(dealt(table(spark, sf_dir, "events"), ["event_id"]))
    fixed = repair_log(log_rows(text).drop("value"), narrow=keys_of(text)).filter(~applog.has(record, "start"))
    return fixed.groupBy(field(record["common"], "$.is_new").alias("is_new")).agg(
        F.count("*").alias("n"),
        F.sum(F.coalesce(F.size(applog.items(record, "displays")), F.lit(0))).alias("n_displays"),
    )
