"""Queries of the change feed: envelopes, cart facts, routing, configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.operators import cart, envelope as env, routing
from tidemart.operators.lifecycle import final_actions, lifecycle_actions
from tidemart.operators.parse import fail_on_bad
from tidemart.plans import adapters as ad, oracle_parts as sql
from tidemart.plans.registry import query
from tidemart.schemas import CONFIG_DIM_COLUMNS, envelope
from tidemart.sources.changefeed import change_feed, snapshot_to_envelope
from tidemart.sources.topics import change_table


def cart_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.envelope_lines(ad.cart_envelopes(ad.table(spark, sf_dir, "lineitem")))


def cart_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cart envelopes as they come off a topic: written as JSON, read strictly."""
    return fail_on_bad(cart_lines(spark, sf_dir), envelope()).drop("value")


def customer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = ad.dim_changes(ad.table(spark, sf_dir, "customer"), "customer")
    return fail_on_bad(ad.envelope_lines(changes), envelope()).drop("value")


@query("P3_fail_on_bad", sql.CART + "SELECT seq, op, tbl, num, ts_ms FROM cart")
def fail_on_bad_rows(spark, sf_dir):
    return cart_rows(spark, sf_dir).select(
        "seq", "op", F.col("source")["table"].alias("tbl"),
        F.col("after")["sku_num"].cast("bigint").alias("num"), "ts_ms",
    )


@query("S3_change_table", sql.CART + "SELECT seq, op, ts_ms AS row_ms FROM cart")
def json_change_table(spark, sf_dir):
    return change_table(cart_lines(spark, sf_dir)).select(
        "seq", "op", F.unix_millis("row_time").alias("row_ms")
    )


@query(
    "P4_clean_envelope",
    sql.DIM + """
SELECT seq, op, CASE WHEN op = 'd' THEN before_name END AS before_name, after_name
FROM dim WHERE tbl = 'customer'""",
)
def clean_envelope(spark, sf_dir):
    return env.clean_envelope(customer_rows(spark, sf_dir), "seq").select(
        "seq", "op", F.col("before")["c_name"].alias("before_name"),
        F.col("after")["c_name"].alias("after_name"),
    )


@query("P5_table_filter", sql.CART + "SELECT seq, op, num FROM cart WHERE tbl = 'cart_info'")
def table_filter(spark, sf_dir):
    return env.of_table(cart_rows(spark, sf_dir), "cart_info").select(
        "seq", "op", F.col("after")["sku_num"].cast("bigint").alias("num")
    )


_CART_COLUMNS = """id, user_id, sku_id, cart_price, {num} AS sku_num,
  CAST(NULL AS VARCHAR) AS img_url, CAST(NULL AS VARCHAR) AS sku_name, CAST(NULL AS VARCHAR) AS is_checked,
  CAST(NULL AS VARCHAR) AS create_time, CAST(NULL AS VARCHAR) AS operate_time,
  CAST(NULL AS VARCHAR) AS is_ordered, CAST(NULL AS VARCHAR) AS order_time, ts_ms"""
_CART_ADD = (
    sql.CART + "SELECT " + _CART_COLUMNS.format(num="num - old_num")
    + " FROM cart WHERE tbl = 'cart_info' AND (op = 'r' OR (op = 'u' AND num > old_num))"
)


@query("P6_cart_add", _CART_ADD)
def cart_add(spark, sf_dir):
    return cart.cart_add(cart_rows(spark, sf_dir), ad.SHOP_DB)


@query(
    "P6_cart_add_inserts",
    sql.CART + "SELECT " + _CART_COLUMNS.format(num="CASE WHEN op = 'u' THEN num - old_num ELSE num END")
    + " FROM cart WHERE tbl = 'cart_info' AND (op <> 'u' OR num > old_num)",
)
def cart_add_inserts(spark, sf_dir):
    return cart.cart_add(cart_rows(spark, sf_dir), ad.SHOP_DB, include_inserts=True)


@query(
    "P7_changelog_text",
    "WITH f AS (" + _CART_ADD + """)
SELECT '+I[' || concat_ws(', ', id, user_id, sku_id, cart_price, coalesce(CAST(sku_num AS VARCHAR), 'null'),
  'null', 'null', 'null', 'null', 'null', 'null', 'null', CAST(ts_ms AS VARCHAR)) || ']' AS value FROM f""",
)
def changelog_text(spark, sf_dir):
    return cart.changelog_text(cart_add(spark, sf_dir))


@query(
    "P8_audit",
    sql.DIM + f"""
SELECT CAST(k AS VARCHAR) || '_' || CAST({sql.BASE_MS} + step * 1000 AS VARCHAR) AS id, op, 'shop' AS db_name,
  'customer' AS t_name, CAST({sql.BASE_MS} + step * 1000 AS VARCHAR) AS ts,
  before_name IS NOT NULL AS has_before, after_name AS after_name
FROM dim WHERE tbl = 'customer'""",
)
def audit(spark, sf_dir):
    return env.audit_rows(customer_rows(spark, sf_dir), "c_custkey").select(
        "id", "op", "db_name", "t_name", "ts", F.col("log_before").isNotNull().alias("has_before"),
        F.get_json_object("log_after", "$.c_name").alias("after_name"),
    )


@query("P14_no_deletes", sql.DIM + "SELECT tbl, seq, op FROM dim WHERE op <> 'd'")
def no_deletes(spark, sf_dir):
    return env.no_deletes(ad.all_dim_changes(spark, sf_dir)).select(
        F.col("source")["table"].alias("tbl"), "seq", "op"
    )


@query(
    "P15_pruned",
    sql.DIM + """
SELECT seq, 3 AS n_cols, after_name AS name, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS balance
FROM dim JOIN customer ON c_custkey = k WHERE tbl = 'customer' AND op <> 'd'""",
)
def pruned(spark, sf_dir):
    columns = F.lit("c_custkey, c_name, c_mktsegment")
    info = env.prune_payload(F.col("after"), columns)
    return env.no_deletes(customer_rows(spark, sf_dir)).withColumn("info", info).select(
        "seq", F.size("info").alias("n_cols"), F.col("info")["c_name"].alias("name"),
        F.col("info")["c_mktsegment"].alias("segment"), F.col("info")["c_acctbal"].alias("balance"),
    )


@query(
    "P16_null_text",
    sql.CART + """
SELECT seq, num, CASE WHEN op = 'u' THEN coalesce(CAST(old_num AS VARCHAR), 'null') END AS old_num FROM cart""",
)
def null_text(spark, sf_dir):
    rows = ad.cart_envelopes(ad.table(spark, sf_dir, "lineitem"))
    return rows.select(
        "seq", F.col("after")["sku_num"].cast("bigint").alias("num"),
        env.text_payload(F.col("before"))["sku_num"].alias("old_num"),
    )


@query(
    "N2_latest",
    sql.DIM + f"""
SELECT tbl, k, op, coalesce(after_name, before_name) AS name, {sql.BASE_MS} + step * 1000 AS ts_ms
FROM (SELECT *, row_number() OVER (PARTITION BY tbl, k ORDER BY step DESC) AS rn FROM dim) WHERE rn = 1""",
)
def latest(spark, sf_dir):
    rows = ad.all_dim_changes(spark, sf_dir).withColumns(
        {"tbl": F.col("source")["table"], "k": F.floor(F.col("seq") / 10)}
    )
    image = F.coalesce("after", "before")
    name = F.coalesce(*[image[f"{t[0]}_name"] for t in ad.DIM_KEYS])
    return env.latest_per_key(rows, ["tbl", "k"], ["ts_ms", "seq"]).select(
        "tbl", "k", "op", name.alias("name"), "ts_ms"
    )


@query(
    "S4_initial",
    sql.DIM + """
SELECT k, 'r' AS op, after_name AS name, 0 AS ts_ms FROM dim WHERE tbl = 'customer' AND step = 0
UNION ALL
SELECT k, op, after_name, 1704067200000 + step * 1000 FROM dim WHERE tbl = 'customer' AND step > 0""",
)
def initial_feed(spark, sf_dir):
    customers = ad.table(spark, sf_dir, "customer")
    snapshot = snapshot_to_envelope(customers, ad.SHOP_DB, "customer")
    log = ad.dim_changes(customers, "customer").filter("op <> 'r'").drop("seq")
    image = F.coalesce("after", "before")
    return change_feed(log, snapshot).select(
        image["c_custkey"].cast("bigint").alias("k"), "op",
        F.col("after")["c_name"].alias("name"), "ts_ms",
    )


@query(
    "S4_latest",
    sql.DIM + "SELECT k, op, after_name AS name FROM dim WHERE tbl = 'customer' AND step > 0",
)
def latest_feed(spark, sf_dir):
    customers = ad.table(spark, sf_dir, "customer")
    log = ad.dim_changes(customers, "customer").filter("op <> 'r'").drop("seq")
    image = F.coalesce("after", "before")
    return change_feed(log, startup="latest").select(
        image["c_custkey"].cast("bigint").alias("k"), "op", F.col("after")["c_name"].alias("name")
    )


_ROUTED = sql.DIM + sql.DIM_CONFIG + """
SELECT 'retail_dim:' || sink_table AS sink_table, CAST(k AS VARCHAR) AS row_key, seq, after_name AS name, {cells} AS n_cells
FROM dim JOIN cfg ON tbl = source_table WHERE op <> 'd'"""


def flat_dim(routed: DataFrame) -> DataFrame:
    info = F.col("info")
    name = F.coalesce(info["n_name"], info["s_name"], info["c_name"])
    return routed.select(
        "sink_table", "row_key", "seq", name.alias("name"), F.size("info").alias("n_cells")
    )


@query(
    "J1_dim_route",
    _ROUTED.format(cells="CASE tbl WHEN 'nation' THEN 3 WHEN 'supplier' THEN 4 ELSE 5 END"),
)
def dim_route(spark, sf_dir):
    changes, config = ad.all_dim_changes(spark, sf_dir), ad.dim_config(spark)
    return flat_dim(routing.dim_route(changes, config, ad.NAMESPACE, keep=("seq",)))


@query("J1_dim_route_pruned", _ROUTED.format(cells="n_cols"))
def dim_route_pruned(spark, sf_dir):
    changes, config = ad.all_dim_changes(spark, sf_dir), ad.dim_config(spark)
    return flat_dim(routing.dim_route(changes, config, ad.NAMESPACE, keep=("seq",), prune=True))


def flat_fact(routed: DataFrame) -> DataFrame:
    return routed.select(
        "seq", "source_table", "sink_table", "topic",
        F.col("after")["sku_num"].cast("bigint").alias("num"),
    )


@query(
    "J2_fact_route",
    sql.CART + sql.FACT_CONFIG + """
SELECT seq, source_table, sink_table, sink_table AS topic, num FROM cart JOIN cfg ON tbl = source_table""",
)
def fact_route(spark, sf_dir):
    return flat_fact(routing.fact_route(cart_rows(spark, sf_dir), ad.fact_config(spark), keep=("seq",)))


@query(
    "J2_fact_route_source",
    sql.CART + sql.FACT_CONFIG + """
SELECT seq, source_table, sink_table, source_table AS topic, num FROM cart JOIN cfg ON tbl = source_table""",
)
def fact_route_source(spark, sf_dir):
    return flat_fact(
        routing.fact_route(
            cart_rows(spark, sf_dir), ad.fact_config(spark), destination="source_table", keep=("seq",)
        )
    )


@query(
    "J2_fact_route_typed",
    sql.CART + sql.FACT_CONFIG + """
SELECT seq, source_table, sink_table, sink_table AS topic, num FROM cart JOIN cfg
ON tbl = source_table AND source_type = CASE op WHEN 'u' THEN 'update' ELSE 'insert' END""",
)
def fact_route_typed(spark, sf_dir):
    return flat_fact(
        routing.fact_route(
            cart_rows(spark, sf_dir), ad.fact_config(spark), match_source_type=True, keep=("seq",)
        )
    )


@query(
    "J3_live_config",
    """
SELECT l_orderkey * 10 + l_linenumber AS seq, 'retail_dim:sup_' || l_suppkey ||
  CASE WHEN l_suppkey % 3 = 0 THEN '_v2' ELSE '' END AS sink_table,
  l_orderkey || '-' || l_linenumber AS row_key
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_suppkey % 7 <> 0""",
)
def live_config(spark, sf_dir):
    changes = ad.shard_config_changes(ad.table(spark, sf_dir, "supplier"))
    config = routing.config_columns(routing.live_config(changes), CONFIG_DIM_COLUMNS)
    cdc = ad.shard_envelopes(ad.table(spark, sf_dir, "lineitem"))
    return routing.dim_route(cdc, config, ad.NAMESPACE, keep=("seq",)).select(
        "seq", "sink_table", "row_key"
    )


@query(
    "J4_dictionary_lookup",
    """
SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS appraise, n_name AS dic_name,
  CAST(n_regionkey AS VARCHAR) AS parent_code
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) ON c_nationkey = n_nationkey""",
)
def dictionary_lookup(spark, sf_dir):
    """Codes of one region are missing in the dictionary and stay without a name."""
    customers = ad.table(spark, sf_dir, "customer")
    feed = snapshot_to_envelope(customers, ad.SHOP_DB, "comment_info")
    comments = env.of_table(feed, "comment_info").select(
        F.col("after")["c_custkey"].cast("bigint").alias("c_custkey"),
        F.col("after")["c_nationkey"].alias("appraise"),
    )
    dictionary = ad.table(spark, sf_dir, "nation").filter("n_regionkey <> 0").select(
        F.col("n_nationkey").cast("string").alias("rk"),
        F.struct(
            F.col("n_name").alias("dic_name"), F.col("n_regionkey").cast("string").alias("parent_code")
        ).alias("info"),
    )
    return routing.lookup_dictionary(comments, dictionary, "appraise").select(
        "c_custkey", "appraise", "dic_name", "parent_code"
    )


_LIFECYCLE = """
WITH s AS (SELECT s_suppkey AS k, 'retail_dim:sup_' || s_suppkey AS t FROM supplier), a AS (
  SELECT k * 10 AS seq, 0 AS step, 'create' AS action, t AS "table" FROM s
  UNION ALL SELECT k * 10 + 1, 0, 'drop', t FROM s WHERE k % 3 = 0
  UNION ALL SELECT k * 10 + 1, 1, 'create', t || '_v2' FROM s WHERE k % 3 = 0
  UNION ALL SELECT k * 10 + 2, 0, 'drop', CASE WHEN k % 3 = 0 THEN t || '_v2' ELSE t END FROM s WHERE k % 7 = 0
)
"""


@query("C1_lifecycle", _LIFECYCLE + 'SELECT seq, step, action, "table" FROM a')
def lifecycle(spark, sf_dir):
    return lifecycle_actions(
        ad.shard_config_changes(ad.table(spark, sf_dir, "supplier")), ad.NAMESPACE
    )


@query(
    "C1_final_tables",
    _LIFECYCLE + """
SELECT "table", arg_max(action, seq * 10 + step) AS action, bool_or(action = 'drop') AS recreate
FROM a GROUP BY "table" """,
)
def final_tables(spark, sf_dir):
    return final_actions(lifecycle(spark, sf_dir))
