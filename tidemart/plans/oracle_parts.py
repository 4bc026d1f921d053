"""SQL pieces shared by the oracle statements: the adapters, written again in SQL."""

from __future__ import annotations

EVENTS_K = """
WITH ev AS (
  SELECT event_id AS seq, user_id, event_type, epoch_us(ts) // 1000 AS ts,
         CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k
  FROM events
)
"""

# Log records that survive parsing.
LOG = EVENTS_K + """
, al AS (
  SELECT *, 'mid_' || user_id AS mid, CASE WHEN k % 3 = 0 THEN '0' ELSE '1' END AS is_new,
         CASE WHEN event_type <> 'signup' THEN event_type END AS page_id,
         CASE WHEN event_type = 'view' THEN k % 5 ELSE 0 END AS nd,
         CASE WHEN event_type IN ('click', 'purchase') THEN k % 2 + 1 ELSE 0 END AS na
  FROM ev WHERE seq % 50 <> 7
)
"""

CART = """
WITH cart AS (
  SELECT l_orderkey * 10 + l_linenumber AS seq,
         CASE l_returnflag WHEN 'R' THEN 'r' WHEN 'N' THEN 'u' ELSE 'c' END AS op,
         CASE WHEN l_linenumber = 6 THEN 'other' ELSE 'cart_info' END AS tbl,
         CAST(l_quantity AS BIGINT) AS num,
         CASE WHEN l_returnflag = 'N' AND l_linenumber <> 7
              THEN CAST(l_quantity AS BIGINT) + l_linenumber - 3 END AS old_num,
         CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS id,
         CAST(l_suppkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS sku_id,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS cart_price,
         epoch_us(l_shipdate) // 1000 AS ts_ms
  FROM lineitem
)
"""

_DIM = """
  SELECT '{t}' AS tbl, CAST({k} AS BIGINT) AS k, {n} AS name FROM {t}
"""

# Snapshot, update and delete changes of the five dimension tables.
DIM = (
    "WITH base AS ("
    + " UNION ALL ".join(
        _DIM.format(t=t, k=k, n=n)
        for t, k, n in [
            ("nation", "n_nationkey", "n_name"),
            ("region", "r_regionkey", "r_name"),
            ("supplier", "s_suppkey", "s_name"),
            ("customer", "c_custkey", "c_name"),
            ("part", "p_partkey", "p_name"),
        ]
    )
    + """), dim AS (
  SELECT tbl, k, k * 10 AS seq, 0 AS step, 'r' AS op, NULL AS before_name, name AS after_name FROM base
  UNION ALL
  SELECT tbl, k, k * 10 + 1, 1, 'u', name, name || '_v2' FROM base WHERE k % 3 = 0
  UNION ALL
  SELECT tbl, k, k * 10 + 2, 2, 'd', CASE WHEN k % 3 = 0 THEN name || '_v2' ELSE name END, NULL
  FROM base WHERE k % 7 = 0
)
"""
)

DIM_CONFIG = """
, cfg AS (
  SELECT * FROM (VALUES ('nation', 'dim_nation', 2), ('supplier', 'dim_supplier', 2), ('customer', 'dim_customer', 3))
  AS t(source_table, sink_table, n_cols)
)
"""

FACT_CONFIG = """
, cfg AS (
  SELECT * FROM (VALUES ('cart_info', 'insert', 'dwd_cart_add'), ('cart_info', 'update', 'dwd_cart_update'))
  AS t(source_table, source_type, sink_table)
)
"""

BASE_MS = 1704067200000


def visitor(order: str, documented: bool = False) -> str:
    """The flag repair as window SQL."""
    days = LOG + f"""
, d AS (
  SELECT seq, ts, mid, is_new, is_new = '1' AS one,
         strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS day,
         strftime(make_timestamp((ts - 86400000) * 1000), '%Y-%m-%d') AS eve
  FROM al
)
"""
    frame = f"OVER (PARTITION BY mid ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    if documented:
        return days + f"""
, s AS (SELECT *, first_value(CASE WHEN one THEN day ELSE eve END) {frame} AS st FROM d)
SELECT seq, mid, CASE WHEN one AND st <> day THEN '0' ELSE is_new END AS is_new FROM s
"""
    return days + f"""
, p1 AS (
  SELECT *, coalesce(bool_or(one) {frame}, false) AS seen,
         first_value(CASE WHEN one THEN day END IGNORE NULLS) {frame} AS seed FROM d
), p2 AS (
  SELECT *, last_value(CASE WHEN NOT one AND seen THEN eve END IGNORE NULLS) {frame} AS mark FROM p1
)
SELECT seq, mid, CASE WHEN one AND coalesce(mark, seed) <> day THEN '0' ELSE is_new END AS is_new FROM p2
"""
