"""Feeds derived from the star-schema tables, row by row and repeatable.

The tables hold typed columns; the operators want log lines and change envelopes.
Every adapter is a narrow projection (or a per-row generator) over its table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SHOP_DB = "shop"
CONFIG_DB = "shop_config"
NAMESPACE = "retail_dim"

BASE_MS = 1_704_067_200_000
DIM_KEYS = {
    "nation": "n_nationkey",
    "region": "r_regionkey",
    "supplier": "s_suppkey",
    "customer": "c_custkey",
    "part": "p_partkey",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def as_topic(df: DataFrame) -> DataFrame:
    """``df(seq, value)`` as a source would give it.

    The generator makes the text a real column; otherwise the optimizer builds it
    again for each of its uses.
    """
    return df.select(F.inline(F.array(F.struct("seq", "value"))))


APP_LOG_LINE = """
to_json(named_struct(
  'common', named_struct(
    'ar', string(user_id % 34), 'ba', concat('brand_', k % 7), 'ch', concat('ch_', k % 4),
    'is_new', if(k % 3 = 0, '0', '1'), 'md', concat('model_', k % 11),
    'mid', concat('mid_', user_id), 'net', concat('net_', k % 3), 'os', concat('os_', k % 2), 'sid', concat('sid_', event_id),
    'uid', string(user_id), 'vc', concat('v2.', k % 10, '.0')),
  'page', if(event_type <> 'signup', named_struct(
    'during_time', if(k % 13 = 0, concat('x', k), string(k * 100)), 'from_pos_id', k % 9, 'from_pos_seq', k % 5, 'item', string(k),
    'item_type', 'sku_id', 'last_page_id', 'home', 'page_id', event_type,
    'refer_id', concat('ref_', k % 6)), null),
  'displays', if(event_type = 'view' and k % 5 > 0, transform(sequence(0L, k % 5 - 1), i -> named_struct(
    'item', string(k + i), 'item_type', 'sku_id', 'pos_id', k % 6, 'pos_seq', i,
    'rank', k % 4)), null),
  'actions', if(event_type in ('click', 'purchase'), transform(sequence(0L, k % 2), i -> named_struct(
    'action_id', event_type, 'item', string(k + i), 'item_type', 'sku_id', 'ts', ms + i,
    'way', concat('way_', k % 2))), null),
  'start', if(event_type = 'signup', named_struct('entry', 'icon', 'loading_time', k), null),
  'err', if(event_type = 'error', named_struct('error_code', if(k % 5 = 0, concat('E', k), string(k + 1000)),
    'msg', concat('msg_', k), 'stack', concat('at ', k % 8)), null),
  'tag', concat('tag_', k % 9), 'ts', ms))
"""


def app_log_lines(events: DataFrame) -> DataFrame:
    """(seq, value): one JSON log line per event; every 50th is cut short.

    The lines hold fields that no schema names, and texts where a number is usual.
    """
    rows = events.selectExpr(
        "event_id", "user_id", "event_type",
        "unix_millis(cast(ts AS timestamp)) AS ms",
        "cast(get_json_object(props, '$.k') AS bigint) AS k",
    )
    whole = as_topic(rows.selectExpr("event_id AS seq", f"{APP_LOG_LINE} AS value"))
    return whole.selectExpr(
        "seq", "if(seq % 50 = 7, left(value, length(value) - 1), value) AS value"
    )


def exact_lines(lines: DataFrame) -> DataFrame:
    """Log lines with numbers that a parser would print anew, null members and repeated names, at the top and inside."""
    inside = """replace(value, '"common":{', concat('"common":{"lat":1,"gone":null,"lat":', seq, '.500,'))"""
    more = """concat(',"amt":', seq, '.', seq % 10, '0,"exp":', seq % 9 + 1, 'e', seq % 5, ',"big":9', lpad(seq, 49, '0'),
        ',"none":null,"twice":1,"twice":', seq, ',"deep":{"a":null,"b":1,"b":', seq, '.0}}')"""
    return as_topic(
        lines.selectExpr("seq", f"if(value LIKE '%}}', concat(left({inside}, length({inside}) - 1), {more}), value) AS value")
    )


def cart_envelopes(lineitem: DataFrame) -> DataFrame:
    """Cart changes, one per line item, as envelope columns next to ``seq``."""
    return lineitem.selectExpr(
        "l_orderkey * 10 + l_linenumber AS seq",
        "CASE l_returnflag WHEN 'R' THEN 'r' WHEN 'N' THEN 'u' ELSE 'c' END AS op",
        f"'{SHOP_DB}' AS db",
        "if(l_returnflag = 'N', map('sku_num', "
        "if(l_linenumber <> 7, string(bigint(l_quantity) + l_linenumber - 3), null)), null) AS before",
        "map('id', string(l_orderkey * 10 + l_linenumber), 'user_id', string(l_suppkey), "
        "'sku_id', string(l_partkey), 'cart_price', string(cast(l_extendedprice AS decimal(18,2))), "
        "'sku_num', string(bigint(l_quantity))) AS after",
        f"map('db', '{SHOP_DB}', 'table', if(l_linenumber = 6, 'other', 'cart_info')) AS source",
        "unix_millis(cast(l_shipdate AS timestamp)) AS ts_ms",
    )


def envelope_lines(df: DataFrame) -> DataFrame:
    """(seq, value): envelopes as JSON text, as they travel on a topic."""
    text = F.to_json(F.struct("op", "db", "before", "after", "source", "ts_ms"))
    return as_topic(df.select("seq", text.alias("value")))


def _map_sql(cells: dict[str, str]) -> str:
    return "map(" + ", ".join(f"'{name}', {value}" for name, value in cells.items()) + ")"


def _change_rows(df: DataFrame, key: str, old: str, new: str, first: str, db: str, table: str) -> DataFrame:
    """Up to three changes per row: it appears, keys divisible by 3 change, those by 7 go."""
    none = "cast(null AS map<string,string>)"

    def change(step: int, op: str, before: str, after: str) -> str:
        return f"named_struct('step', {step}, 'op', '{op}', 'before', {before}, 'after', {after})"

    changes = ", ".join(
        [
            change(0, first, none, old),
            f"if({key} % 3 = 0, {change(1, 'u', old, new)}, null)",
            f"if({key} % 7 = 0, {change(2, 'd', f'if({key} % 3 = 0, {new}, {old})', none)}, null)",
        ]
    )
    return df.selectExpr(f"bigint({key}) AS _key", f"inline(array_compact(array({changes})))").selectExpr(
        "_key * 10 + step AS seq", "op", f"'{db}' AS db", "before", "after",
        f"map('db', '{db}', 'table', '{table}') AS source", f"{BASE_MS} + step * 1000L AS ts_ms",
    )


def dim_changes(df: DataFrame, name: str, db: str = SHOP_DB) -> DataFrame:
    """Snapshot, update and delete envelopes of a dimension table; updates change its name."""
    label = f"{name[0]}_name"
    cells = {column: f"string({column})" for column in df.columns}
    old, new = _map_sql(cells), _map_sql({**cells, label: f"concat({label}, '_v2')"})
    return _change_rows(df, DIM_KEYS[name], old, new, "r", db, name)


def all_dim_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds = [dim_changes(table(spark, sf_dir, name), name) for name in DIM_KEYS]
    merged = feeds[0]
    for feed in feeds[1:]:
        merged = merged.unionByName(feed)
    return merged


def dim_config(spark: SparkSession) -> DataFrame:
    """Three configured dimensions; region and part have no route."""
    return spark.sql(
        """
        SELECT * FROM VALUES
          ('nation', 'dim_nation', 'n_nationkey,n_name', 'info', 'n_nationkey'),
          ('supplier', 'dim_supplier', 's_suppkey,s_name', 'info', 's_suppkey'),
          ('customer', 'dim_customer', 'c_custkey,c_name,c_mktsegment', 'info', 'c_custkey')
        AS t(source_table, sink_table, sink_columns, sink_family, sink_row_key)
        """
    )


def fact_config(spark: SparkSession) -> DataFrame:
    """Two routes for one table, told apart by the type of change."""
    return spark.sql(
        """
        SELECT * FROM VALUES
          ('cart_info', 'insert', 'dwd_cart_add', 'id,user_id,sku_id'),
          ('cart_info', 'update', 'dwd_cart_update', 'id,sku_num')
        AS t(source_table, source_type, sink_table, sink_columns)
        """
    )


def shard_config_changes(suppliers: DataFrame) -> DataFrame:
    """Configuration changes, one route per supplier shard ``shard_<key>``.

    Keys divisible by 3 get another destination later, those by 7 lose theirs.
    """

    def row(suffix: str) -> str:
        return _map_sql(
            {
                "source_table": "concat('shard_', s_suppkey)",
                "sink_table": f"concat('sup_', s_suppkey, '{suffix}')",
                "sink_columns": "'l_orderkey,l_partkey'",
                "sink_family": "'info'",
                "sink_row_key": "'row_id'",
            }
        )

    return _change_rows(suppliers, "s_suppkey", row(""), row("_v2"), "c", CONFIG_DB, "table_process_dim")


def shard_envelopes(lineitem: DataFrame) -> DataFrame:
    """Line items as snapshot rows of a table per supplier."""
    return lineitem.selectExpr(
        "l_orderkey * 10 + l_linenumber AS seq", "'r' AS op", f"'{SHOP_DB}' AS db",
        "cast(null AS map<string,string>) AS before",
        "map('row_id', concat_ws('-', l_orderkey, l_linenumber), 'l_orderkey', string(l_orderkey), "
        "'l_partkey', string(l_partkey)) AS after",
        f"map('db', '{SHOP_DB}', 'table', concat('shard_', l_suppkey)) AS source",
        "unix_millis(cast(l_shipdate AS timestamp)) AS ts_ms",
    )
