"""Queries that write and read back: files, key-value tables, batch sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.functions.hexa import decode_cdc_decimal
from tidemart.operators import routing
from tidemart.operators.applog import fan_out
from tidemart.operators.envelope import audit_rows
from tidemart.operators.parse import fail_on_bad
from tidemart.plans import adapters as ad, oracle_parts as sql
from tidemart.plans.change_queries import cart_lines, cart_rows, customer_rows
from tidemart.plans.log_queries import MESSAGES, flat_messages, lines, parsed, records
from tidemart.plans.registry import query
from tidemart.schemas import envelope
from tidemart.session import work_path
from tidemart.sinks.daybucket import write_day_buckets
from tidemart.sinks.state_table import StateTable
from tidemart.sinks.topics import as_message, send_batch
from tidemart.sinks.upsert import compact_to, read_upsert, upsert_batch
from tidemart.sources import files, tables
from tidemart.sources.changefeed import snapshot_to_envelope


@query(
    "S5_camel_names",
    """SELECT o_orderkey AS "oOrderkey", o_orderpriority AS "oOrderpriority" FROM orders""",
)
def camel_names(spark, sf_dir):
    """The renaming of a query result; no database can be reached from here."""
    rows = spark.sql(
        "SELECT o_orderkey, o_orderpriority FROM {o}",
        o=spark.read.parquet(f"{sf_dir}/orders.parquet"),
    )
    return tables.with_camel_names(rows)


@query("S7_json_lines", sql.CART + "SELECT op, tbl, ts_ms, count(*) AS n FROM cart GROUP BY ALL")
def json_lines(spark, sf_dir):
    path = work_path(spark, "s7")
    cart_lines(spark, sf_dir).select("value").write.text(path)
    rows = files.json_lines(spark, path, envelope("op", "source", "ts_ms"))
    return rows.groupBy("op", F.col("source")["table"].alias("tbl"), "ts_ms").agg(F.count("*").alias("n"))


@query("S8_modified_after", sql.EVENTS_K + "SELECT CAST(seq % 2 AS INT) AS pickup, count(*) AS n FROM ev GROUP BY 1")
def modified_after(spark, sf_dir):
    """Three pick-ups from one saved position; the files of the second have the time stamps of the first."""
    folder, out, position = (work_path(spark, f"s8-{n}") for n in ("in", "out", "position"))
    both, path = lines(spark, sf_dir), spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for number in range(3):
        if number < 2:
            both.filter(F.col("seq") % 2 == number).select("value").write.mode("append").text(folder)
            for f in fs.listStatus(path):
                fs.setTimes(f.getPath(), ad.BASE_MS, -1)
        files.pick_up(spark, folder, position, lambda rows: rows.write.text(f"{out}/pickup={number}"))  # noqa: B023
    return spark.read.schema("value string, pickup int").text(out).groupBy("pickup").agg(F.count("*").alias("n"))


def customer_table(spark: SparkSession, sf_dir: str) -> StateTable:
    """The customer dimension as a key-value table: all changes in arrival order, cells put one by one."""
    routed = routing.dim_route(customer_rows(spark, sf_dir), ad.dim_config(spark), ad.NAMESPACE, keep=("ts_ms", "seq"))
    table = StateTable(spark, work_path(spark, "kv"), ["row_key"], 8, cells="info")
    for batch_id, part in enumerate(("seq % 10 = 0", "seq % 10 > 0")):
        table.put(routed.filter(part), batch_id, ["ts_ms", "seq"])
    return table


_CUSTOMERS = """
WITH kv AS (SELECT CAST(c_custkey AS VARCHAR) AS row_key, c_custkey, c_acctbal, c_mktsegment,
  c_name || CASE WHEN c_custkey % 3 = 0 THEN '_v2' ELSE '' END AS c_name FROM customer)
"""


@query("S9_scan_limit", _CUSTOMERS + "SELECT row_key, c_name FROM kv ORDER BY row_key LIMIT 100")
def scan_limit(spark, sf_dir):
    return tables.wide_row(tables.scan(customer_table(spark, sf_dir).read(), 100), ["c_name"])


@query("S10_point_get", _CUSTOMERS + "SELECT row_key, c_name, c_mktsegment FROM kv WHERE c_custkey = 42")
def point_get(spark, sf_dir):
    return tables.wide_row(customer_table(spark, sf_dir).get("42"), ["c_name", "c_mktsegment"])


@query("C5_delete_keys", _CUSTOMERS + "SELECT row_key, c_name FROM kv WHERE c_acctbal >= 0")
def delete_keys(spark, sf_dir):
    gone = ad.table(spark, sf_dir, "customer").filter("c_acctbal < 0")
    keys = gone.select(F.col("c_custkey").cast("string").alias("row_key"))
    return tables.wide_row(tables.without_keys(customer_table(spark, sf_dir).read(), keys), ["c_name"])


@query(
    "S4_cdc_decimal",
    """
WITH v AS (
  SELECT o_orderkey, CAST(round(o_totalprice * 100) AS HUGEINT) * CASE WHEN o_orderkey % 3 = 1 THEN -1 ELSE 1 END AS cents,
    o_custkey FROM orders
), w AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 1 THEN cents * 18446744073709551616 + o_custkey ELSE cents END AS n FROM v
), t AS (SELECT o_orderkey, n < 0 AS minus, lpad(CAST(abs(n) AS VARCHAR), CAST(greatest(3, length(CAST(abs(n) AS VARCHAR))) AS INT), '0') AS d FROM w)
SELECT o_orderkey, CASE WHEN minus THEN '-' ELSE '' END || left(d, length(d) - 2) || '.' || right(d, 2) AS amount FROM t""",
)
def cdc_decimal(spark, sf_dir):
    """Encoded amounts of a change feed: negative ones, and some wider than eight bytes."""
    encoded = """base64(unhex(concat(lpad(hex(cents), 16, '0'), if(o_orderkey % 2 = 1, lpad(hex(bigint(o_custkey)), 16, '0'), ''))))"""
    rows = ad.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", "bigint(round(o_totalprice * 100)) * if(o_orderkey % 3 = 1, -1, 1) AS cents"
    ).selectExpr("bigint(o_orderkey) AS o_orderkey", f"{encoded} AS total_amount")
    feed = ad.envelope_lines(snapshot_to_envelope(rows, ad.SHOP_DB, "order_info").withColumn("seq", F.lit(0)))
    after = F.col("after")
    return fail_on_bad(feed, envelope("after")).select(
        after["o_orderkey"].cast("bigint").alias("o_orderkey"), decode_cdc_decimal(after["total_amount"], 2).alias("amount")
    )


@query(
    "K2_send_batch",
    "SELECT o_orderkey, o_orderstatus FROM orders",
)
def send_json(spark, sf_dir):
    path = work_path(spark, "k2")
    send_batch(as_message(ad.table(spark, sf_dir, "orders")), format="text", path=path)
    rows = files.json_lines(spark, path, {"o_orderkey": "bigint", "o_orderstatus": "string"})
    return rows


@query(
    "K3_send_fanout",
    sql.LOG + """
SELECT topic, count(*) AS n, count(DISTINCT mid) AS n_mids FROM (
  SELECT 'log_err' AS topic, NULL AS mid FROM al WHERE event_type = 'error'
  UNION ALL SELECT 'log_start', mid FROM al WHERE event_type = 'signup'
  UNION ALL SELECT 'log_page', mid FROM al WHERE event_type <> 'signup'
  UNION ALL SELECT 'log_display', mid FROM (SELECT mid, unnest(range(nd)) FROM al WHERE nd > 0)
  UNION ALL SELECT 'log_action', mid FROM (SELECT mid, unnest(range(na)) FROM al WHERE na > 0)
) GROUP BY topic""",
)
def send_fanout(spark, sf_dir):
    """All five outputs through one write, one folder per topic."""
    path = work_path(spark, "k3")
    send_batch(fan_out(records(spark, sf_dir)), format="text", path=path)
    back = flat_messages(spark.read.text(path))
    return back.groupBy("topic").agg(F.count("*").alias("n"), F.count_distinct("mid").alias("n_mids"))


@query(
    "K4_dynamic_topic",
    sql.CART + sql.FACT_CONFIG + """
SELECT sink_table AS topic, count(*) AS n, CAST(sum(num) AS BIGINT) AS total FROM cart JOIN cfg ON tbl = source_table
AND source_type = CASE op WHEN 'u' THEN 'update' ELSE 'insert' END GROUP BY 1""",
)
def dynamic_topic(spark, sf_dir):
    path = work_path(spark, "k4")
    routed = routing.fact_route(cart_rows(spark, sf_dir), ad.fact_config(spark), match_source_type=True)
    send_batch(routed.select("topic", F.to_json("after").alias("value")), format="text", path=path)
    num = F.get_json_object("value", "$.sku_num").cast("bigint")
    return spark.read.text(path).groupBy("topic").agg(F.count("*").alias("n"), F.sum(num).alias("total"))


UPSERTED = sql.DIM + sql.DIM_CONFIG + """
SELECT 'retail_dim:' || sink_table AS sink_table, CAST(k AS VARCHAR) AS row_key, max(after_name) AS name
FROM dim JOIN cfg ON tbl = source_table WHERE op <> 'd' GROUP BY 1, 2"""


def flat_table(df: DataFrame) -> DataFrame:
    info = F.col("info")
    name = F.coalesce(info["n_name"], info["s_name"], info["c_name"])
    return df.select("sink_table", "row_key", name.alias("name"))


@query("K5_upsert", UPSERTED)
def upsert(spark, sf_dir):
    """Snapshot rows as one batch, later changes as the next, then the current table."""
    path, keys, order = work_path(spark, "k5"), ["sink_table", "row_key"], ["ts_ms", "seq"]
    config = ad.dim_config(spark)
    changes = ad.all_dim_changes(spark, sf_dir)
    for batch_id, part in enumerate([changes.filter("op = 'r'"), changes.filter("op <> 'r'")]):
        routed = routing.dim_route(part, config, ad.NAMESPACE, keep=("ts_ms", "seq"))
        upsert_batch(routed, path, batch_id, keys, order, ("sink_table",))
    return flat_table(read_upsert(spark, path, keys))


@query("K5_compacted", UPSERTED)
def upsert_compacted(spark, sf_dir):
    """The snapshot folded into a new table, and the later changes on top of it."""
    path, new_path = work_path(spark, "k5"), work_path(spark, "k5")
    keys, order = ["sink_table", "row_key"], ["ts_ms", "seq"]
    config, changes = ad.dim_config(spark), ad.all_dim_changes(spark, sf_dir)

    def routed(part: DataFrame) -> DataFrame:
        return routing.dim_route(part, config, ad.NAMESPACE, keep=("ts_ms", "seq"))

    upsert_batch(routed(changes.filter("op = 'r'")), path, 0, keys, order)
    compact_to(spark, path, new_path, keys)
    upsert_batch(routed(changes.filter("op <> 'r'")), new_path, 1, keys, order)
    return flat_table(read_upsert(spark, new_path, keys))


@query(
    "K6_day_buckets",
    sql.EVENTS_K + """
SELECT CASE WHEN seq % 50 = 7 THEN 'error_bucket' ELSE strftime(make_timestamp(ts * 1000), '%Y%m%d') END AS day,
  count(*) AS n FROM ev GROUP BY 1""",
)
def day_buckets(spark, sf_dir):
    path = work_path(spark, "k6")
    write_day_buckets(lines(spark, sf_dir), path, "ts")
    back = spark.read.schema("value string, day string").text(path)
    return back.groupBy("day").agg(F.count("*").alias("n"))


@query(
    "K8_audit_upsert",
    sql.DIM + f"""
SELECT CAST(k AS VARCHAR) || '_' || CAST({sql.BASE_MS} + step * 1000 AS VARCHAR) AS id, op, after_name
FROM dim WHERE tbl = 'customer'""",
)
def audit_upsert(spark, sf_dir):
    """The same audit rows twice: replays and repeats leave one row per id."""
    path = work_path(spark, "k8")
    rows = audit_rows(customer_rows(spark, sf_dir), "c_custkey")
    for batch_id in (0, 0, 1):
        upsert_batch(rows, path, batch_id, ["id"], ["ts", "op"])
    return read_upsert(spark, path, ["id"]).select(
        "id", "op", F.get_json_object("log_after", "$.c_name").alias("after_name")
    )
