"""One query per column function, over whole columns of the tables, and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.functions import amount, dates, hashing, hexa, identity, registry, text, versions
from tidemart.operators import aggregates, reports
from tidemart.plans import adapters as ad, oracle_parts as sql
from tidemart.plans.log_queries import parsed
from tidemart.plans.registry import query

# --- F1, U1, R1 -------------------------------------------------------------

_ID = """
WITH b AS (
  SELECT c_custkey AS k, c_mktsegment,
    '110101' || CAST(1900 + c_custkey % 100 AS VARCHAR) || lpad(CAST(1 + c_custkey % 14 AS VARCHAR), 2, '0') ||
    lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') AS body
  FROM customer
), c AS (
  SELECT k, c_mktsegment, body, list_sum(list_transform(range(1, 18), lambda i:
    CAST(substr(body, CAST(i AS INT), 1) AS INT) * ([7,9,10,5,8,4,2,1,6,3,7,9,10,5,8,4,2])[i])) AS w
  FROM b
), d AS (
  SELECT k, c_mktsegment, w, CASE WHEN k % 17 = 0 THEN body
    ELSE body || substr('10X98765432', CAST((w + CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END) % 11 + 1 AS INT), 1) END AS t
  FROM c
), e AS (
  SELECT *, CASE WHEN length(t) <> 18 THEN '无效长度'
    WHEN NOT regexp_full_match(t, '[1-9][0-9]{5}(18|19|20)[0-9]{2}(0[1-9]|10|11|12)([0-2][1-9]|10|20|30|31)[0-9]{3}[0-9Xx]')
      THEN '格式错误'
    WHEN substr(t, 18, 1) <> substr('10X98765432', CAST(w % 11 + 1 AS INT), 1) THEN '校验码错误'
    ELSE '有效身份证' END AS label
  FROM d
)
"""


def id_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ID numbers made from customer keys: some short, some with a wrong check digit."""
    body = (
        "concat('110101', 1900 + c_custkey % 100, lpad(string(1 + c_custkey % 14), 2, '0'), "
        "lpad(string(1 + c_custkey % 28), 2, '0'), lpad(string(c_custkey % 1000), 3, '0'))"
    )
    weights = ", ".join(map(str, identity.WEIGHTS))
    rows = ad.table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_mktsegment", f"{body} AS body")
    rows = rows.selectExpr(
        "*",
        "aggregate(sequence(1, 17), 0, (a, i) -> "
        f"a + int(substring(body, i, 1)) * array({weights})[i - 1]) AS w",
    )
    return rows.selectExpr(
        "c_custkey", "c_mktsegment",
        "concat(if(c_custkey % 3 = 0, '\t', ''), body, if(c_custkey % 17 = 0, '', "
        f"substring('{identity.CHECK_DIGITS}', (w + if(c_custkey % 5 = 0, 1, 0)) % 11 + 1, 1)), ' ') AS id_number",
    )


@query("F1_validate_id_card", _ID + "SELECT k AS c_custkey, label FROM e")
def f1(spark, sf_dir):
    return id_numbers(spark, sf_dir).select(
        "c_custkey", identity.validate_id_card(F.col("id_number")).alias("label")
    )


@query("U1_sql_validate_id_card", _ID + "SELECT label, count(*) AS n FROM e GROUP BY label")
def u1(spark, sf_dir):
    registry.register(spark)
    return spark.sql(
        "SELECT validate_id_card(id_number) AS label, count(*) AS n FROM {ids} GROUP BY 1",
        ids=id_numbers(spark, sf_dir),
    )


@query(
    "R1_id_quality",
    _ID + """
SELECT c_mktsegment, label, n, round(n / sum(n) OVER (PARTITION BY c_mktsegment), 6) AS share
FROM (SELECT c_mktsegment, label, count(*) AS n FROM e GROUP BY ALL)""",
)
def r1(spark, sf_dir):
    return reports.id_quality(id_numbers(spark, sf_dir), "id_number", "c_mktsegment")


# --- F2, U2, R6 -------------------------------------------------------------


def amount_sql(v: str) -> str:
    """The amount rule in SQL, for a decimal ``v`` with two places."""
    return f"""
  CASE WHEN {v} < 1 THEN '' ELSE list_aggregate(list_transform(range(1, length(CAST(floor({v}) AS BIGINT)::VARCHAR) + 1),
    lambda i: CASE WHEN substr(CAST(floor({v}) AS BIGINT)::VARCHAR, CAST(i AS INT), 1) = '0' THEN '' ELSE
      substr('零壹贰叁肆伍陆柒捌玖', CAST(substr(CAST(floor({v}) AS BIGINT)::VARCHAR, CAST(i AS INT), 1) AS INT) + 1, 1) ||
      (['', '拾', '佰', '仟', '万', '拾', '佰', '仟', '亿', '拾', '佰', '仟', '万', '拾', '佰', '仟', '元'])
        [length(CAST(floor({v}) AS BIGINT)::VARCHAR) - i + 1] ||
      CASE WHEN substr(CAST(floor({v}) AS BIGINT)::VARCHAR, CAST(i AS INT) + 1, 1) = '0' THEN '零' ELSE '' END
    END), 'string_agg', '') END
  || '元' || CASE WHEN {v} % 1 = 0 THEN '整' ELSE
    CASE WHEN CAST({v} % 1 * 100 AS INT) >= 10 THEN
      substr('零壹贰叁肆伍陆柒捌玖', CAST({v} % 1 * 100 AS INT) // 10 + 1, 1) || '角' ELSE '' END ||
    CASE WHEN CAST({v} % 1 * 100 AS INT) % 10 > 0 THEN
      substr('零壹贰叁肆伍陆柒捌玖', CAST({v} % 1 * 100 AS INT) % 10 + 1, 1) || '分' ELSE '' END END"""


_AMOUNT = (
    "SELECT o_orderkey, " + amount_sql("v")
    + " AS amount_text FROM (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM orders)"
)


@query("F2_chinese_amount", _AMOUNT)
def f2(spark, sf_dir):
    return ad.table(spark, sf_dir, "orders").select(
        "o_orderkey", amount.chinese_amount(F.col("o_totalprice")).alias("amount_text")
    )


@query("F2_chinese_amount_exact", _AMOUNT)
def f2_exact(spark, sf_dir):
    return ad.table(spark, sf_dir, "orders").select(
        "o_orderkey", amount.chinese_amount(F.col("o_totalprice"), "exact").alias("amount_text")
    )


@query("U2_sql_chinese_amount", _AMOUNT)
def u2(spark, sf_dir):
    registry.register(spark)
    return spark.sql(
        "SELECT o_orderkey, convert_number_chinese_amount(o_totalprice) AS amount_text FROM {o}",
        o=ad.table(spark, sf_dir, "orders"),
    )


@query(
    "R6_daily_statement",
    "SELECT day, CAST(total AS DOUBLE) AS total, " + amount_sql("total") + """ AS total_text FROM (
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
  FROM orders GROUP BY 1)""",
)
def r6(spark, sf_dir):
    orders = ad.table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date").cast("string")
    return reports.daily_statement(orders, day, F.col("o_totalprice")).withColumn(
        "total", F.col("total").cast("double")
    )


# --- dates ------------------------------------------------------------------


def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.table(spark, sf_dir, "events").select(
        "event_id", ad.event_ms(F.col("ts")).alias("ms"), F.col("ts").cast("timestamp").alias("ts")
    )


@query(
    "F3_datetime_to_ts",
    "SELECT event_id, (epoch_us(ts) // 1000000 - 28800) * 1000 AS ms FROM events",
)
def f3(spark, sf_dir):
    shown = dates.ts_to_datetime(F.col("ms"))
    return event_times(spark, sf_dir).select("event_id", dates.datetime_to_ts(shown).alias("ms"))


@query(
    "F4_ts_to_date",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS d_utc,
  strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS d_east FROM events""",
)
def f4(spark, sf_dir):
    return event_times(spark, sf_dir).select(
        "event_id", dates.ts_to_date(F.col("ms")).alias("d_utc"),
        dates.ts_to_date(F.col("ms"), "+08:00").alias("d_east"),
    )


@query("F5_ts_to_datetime", "SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS dt FROM events")
def f5(spark, sf_dir):
    return event_times(spark, sf_dir).select(
        "event_id", dates.ts_to_datetime(F.col("ms"), "+08:00").alias("dt")
    )


@query("F6_ts_to_partition", "SELECT event_id, strftime(ts, '%Y%m%d') AS dt FROM events")
def f6(spark, sf_dir):
    return event_times(spark, sf_dir).select("event_id", dates.ts_to_partition(F.col("ms")).alias("dt"))


@query(
    "F7_date_to_ts",
    "SELECT o_orderkey, epoch_us(date_trunc('day', o_orderdate)) // 1000 - 28800000 AS ms FROM orders",
)
def f7(spark, sf_dir):
    day = F.col("o_orderdate").cast("date").cast("string")
    return ad.table(spark, sf_dir, "orders").select("o_orderkey", dates.date_to_ts(day).alias("ms"))


@query(
    "F8_format",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS standard, strftime(ts, '%d/%m/%Y %H') AS custom
FROM events""",
)
def f8(spark, sf_dir):
    return event_times(spark, sf_dir).select(
        "event_id", dates.format_date(F.col("ts")).alias("standard"),
        dates.format_date(F.col("ts"), "dd/MM/yyyy HH").alias("custom"),
    )


@query(
    "F9_day_range",
    """
SELECT o_orderkey, CAST(strftime(o_orderdate + INTERVAL 1 DAY * i, '%Y%m%d') AS INT) AS day
FROM (SELECT o_orderkey, o_orderdate, unnest(range(o_orderkey % 5)) AS i FROM orders)""",
)
def f9(spark, sf_dir):
    # Every fifth order has its end before its start, and so no days.
    return ad.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("a")
    ).select(
        "o_orderkey",
        F.explode(
            dates.day_range(F.col("a"), F.date_add("a", (F.col("o_orderkey") % 5 - 1).cast("int")))
        ).alias("day"),
    )


@query("F10_event_timestamp", sql.CART + "SELECT seq, ts_ms, strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d') AS day FROM cart")
def f10(spark, sf_dir):
    rows = ad.cart_envelopes(ad.table(spark, sf_dir, "lineitem"))
    event_time = dates.event_timestamp(F.col("ts_ms"))
    return rows.select(
        "seq", F.unix_millis(event_time).alias("ts_ms"), event_time.cast("date").cast("string").alias("day")
    )


@query(
    "F11_sql_map_ops",
    sql.CART + """
SELECT seq, CASE WHEN op = 'c' THEN num ELSE num - old_num END AS delta, user_id,
  coalesce(num > old_num, false) AS grew FROM cart WHERE tbl = 'cart_info' AND (op <> 'u' OR old_num IS NOT NULL)""",
)
def f11(spark, sf_dir):
    return spark.sql(
        """
        SELECT seq, if(op = 'c', try_cast(after['sku_num'] AS bigint),
                       try_cast(after['sku_num'] AS bigint) - try_cast(before['sku_num'] AS bigint)) AS delta,
               after['user_id'] AS user_id,
               coalesce(try_cast(after['sku_num'] AS bigint) > try_cast(before['sku_num'] AS bigint), false) AS grew
        FROM {cart}
        WHERE source['table'] = 'cart_info' AND (op <> 'u' OR before['sku_num'] IS NOT NULL)
        """,
        cart=ad.cart_envelopes(ad.table(spark, sf_dir, "lineitem")),
    )


# --- text -------------------------------------------------------------------


@query(
    "F12_to_csv",
    """SELECT p_partkey, replace(p_name, ' ', ', ') || ', null' AS csv, replace(p_name, ' ', '|') || '|null' AS joined
FROM part""",
)
def f12(spark, sf_dir):
    words = F.concat(F.split("p_name", " "), F.array(F.lit(None).cast("string")))
    return ad.table(spark, sf_dir, "part").select(
        "p_partkey", text.to_csv(words).alias("csv"), text.join_list(words, "|").alias("joined")
    )


@query(
    "F13_first_letter",
    """SELECT p_partkey, upper(p_name[1]) || p_name[2:] AS upper_first, lower(p_type[1]) || p_type[2:] AS lower_first
FROM part""",
)
def f13(spark, sf_dir):
    return ad.table(spark, sf_dir, "part").select(
        "p_partkey", text.capitalise_first(F.col("p_name")).alias("upper_first"),
        text.lowercase_first(F.col("p_type")).alias("lower_first"),
    )


@query("F14_zeros", "SELECT p_partkey, repeat('0', p_size) AS zeros, repeat('x', p_size % 4) AS crosses FROM part")
def f14(spark, sf_dir):
    return ad.table(spark, sf_dir, "part").select(
        "p_partkey", text.zeros(F.col("p_size")).alias("zeros"),
        text.repeat_char("x", F.col("p_size") % 4).alias("crosses"),
    )


_PADDED = "CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN {tab} ELSE text END"


@query(
    "F15_blank",
    f"""SELECT doc_id, t IS NULL OR t = '' AS is_empty, t IS NULL OR regexp_full_match(t, '[\\x00-\\x20]*') AS is_blank,
  text IS NULL OR regexp_full_match(text, '[\\x00-\\x20]*') AS text_blank
FROM (SELECT doc_id, text, {_PADDED.format(tab="' ' || chr(9)")} AS t FROM documents)""",
)
def f15(spark, sf_dir):
    docs = ad.table(spark, sf_dir, "documents")
    t = F.expr(_PADDED.format(tab="' \t'"))
    return docs.select("doc_id", "text", t.alias("t")).select(
        "doc_id", text.is_empty(F.col("t")).alias("is_empty"), text.is_blank(F.col("t")).alias("is_blank"),
        text.is_blank(F.col("text")).alias("text_blank"),
    )


# The class once more, by itself: letters and digits, ASCII marks, full-width marks.
_PLAIN = "[一-龥a-zA-Z0-9" + r"\[\]\-_+{}<>`?!~@#$%^&*():" + '"' + "：“——·、，。；‘【】！￥……（）" + "]+"


@query(
    "F16_plain_text",
    f"""SELECT doc_id, regexp_full_match(text, '{_PLAIN}') AS plain_text,
  regexp_full_match(source, '{_PLAIN}') AS plain_source,
  regexp_full_match(regexp_replace(text, '[\\s.,]', '', 'g'), '{_PLAIN}') AS plain_letters FROM documents""",
)
def f16(spark, sf_dir):
    return ad.table(spark, sf_dir, "documents").select(
        "doc_id", text.is_plain_text(F.col("text")).alias("plain_text"),
        text.is_plain_text(F.col("source")).alias("plain_source"),
        text.is_plain_text(F.regexp_replace("text", r"[\s.,]", "")).alias("plain_letters"),
    )


@query("F16_plain_brand", f"SELECT p_partkey, regexp_full_match(p_brand, '{_PLAIN}') AS brand, regexp_full_match(p_name, '{_PLAIN}') AS name FROM part")
def f16_brand(spark, sf_dir):
    return ad.table(spark, sf_dir, "part").select(
        "p_partkey", text.is_plain_text(F.col("p_brand")).alias("brand"),
        text.is_plain_text(F.col("p_name")).alias("name"),
    )


def hash_sql(x: str, buckets: int = 128) -> str:
    return f"lpad(CAST(CAST('0x' || right(md5({x}), 3) AS INT) % {buckets} AS VARCHAR), 4, '0')"


@query(
    "F17_hash_mod",
    f"SELECT c_custkey, {hash_sql('c_name')} AS bucket, {hash_sql('c_name', 1000)} AS fine FROM customer",
)
def f17(spark, sf_dir):
    return ad.table(spark, sf_dir, "customer").select(
        "c_custkey", hashing.hash_mod(F.col("c_name")).alias("bucket"),
        hashing.hash_mod(F.col("c_name"), 1000).alias("fine"),
    )


_HOT_SHARE = "CASE c_custkey % 3 WHEN 0 THEN '0xDAC17F958D2EE523A2206206994597C13D831EC7' ELSE c_name END"


@query(
    "F18_hot_hash_mod",
    f"SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '9002' ELSE {hash_sql('c_name')} END AS bucket FROM customer",
)
def f18(spark, sf_dir):
    key = F.expr(_HOT_SHARE)
    return ad.table(spark, sf_dir, "customer").select("c_custkey", hashing.hot_hash_mod(key).alias("bucket"))


@query(
    "R2_bucket_report",
    f"""
SELECT bucket, n, bucket >= '9000' AS hot, round(n / avg(n) OVER (), 6) AS ratio FROM (
  SELECT CASE WHEN c_custkey % 3 = 0 THEN '9002' ELSE {hash_sql('c_name')} END AS bucket, count(*) AS n
  FROM customer GROUP BY 1)""",
)
def r2(spark, sf_dir):
    keyed = ad.table(spark, sf_dir, "customer").withColumn("address", F.expr(_HOT_SHARE))
    return reports.bucket_report(keyed, "address")


# Sixteen hex digits of the key, then sixteen of the customer: more than a bigint holds.
_HEX = (
    "CASE o_orderkey % 10 WHEN 0 THEN NULL WHEN 1 THEN string(o_orderkey * 1000000007) "
    "WHEN 2 THEN concat('0x', repeat('f', 64)) WHEN 3 THEN concat(o_custkey, '.5') WHEN 4 THEN concat('-', o_custkey, 'e3') "
    "ELSE concat('0x', lower(lpad(hex(o_orderkey), 12, '0')), lower(lpad(hex(o_custkey + 1), 16, '0'))) END"
)
_HEX_SQL = """
WITH n AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 1 THEN CAST(o_orderkey AS HUGEINT) * 1000000007
    WHEN o_orderkey % 10 = 4 THEN CAST(o_custkey AS HUGEINT) * 1000
    ELSE CAST(o_orderkey AS HUGEINT) * 18446744073709551616 + o_custkey + 1 END AS v FROM orders
), p AS (
  SELECT o_orderkey, o_custkey, CAST(v AS VARCHAR) AS t, lpad(CAST(v AS VARCHAR), CAST(greatest(19, length(CAST(v AS VARCHAR))) AS INT), '0') AS p FROM n
)
SELECT o_orderkey, CASE o_orderkey % 10 WHEN 0 THEN '0'
    WHEN 2 THEN '115792089237316195423570985008687907853269984665640564039457584007913129639935'
    WHEN 3 THEN o_custkey || '.5' WHEN 4 THEN '-' || t ELSE t END AS plain,
  CASE o_orderkey % 10 WHEN 0 THEN '0'
    WHEN 2 THEN '115792089237316195423570985008687907853269984665640564039457.584007913129639935'
    WHEN 3 THEN '0.' || lpad(CAST(o_custkey AS VARCHAR), 18, '0') || '5'
    ELSE CASE WHEN o_orderkey % 10 = 4 THEN '-' ELSE '' END
      || rtrim(rtrim(left(p, length(p) - 18) || '.' || right(p, 18), '0'), '.') END AS units
FROM p"""


def hex_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{_HEX} AS x")
    return rows.select(
        "o_orderkey", hexa.to_decimal_text(F.col("x")).alias("plain"),
        hexa.to_decimal_text(F.col("x"), divide=True).alias("units"),
    )


@query("F19_hex_amount", _HEX_SQL)
def f19(spark, sf_dir):
    return hex_amounts(spark, sf_dir)


@query("F19_hex_amount_wide", _HEX_SQL)
def f19_wide(spark, sf_dir):
    return hex_amounts(spark, sf_dir)


@query(
    "F20_append_list",
    """SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN '[' || p_type || ']'
  ELSE '[' || p_brand || ', ' || p_name || ', ' || p_type || ']' END AS list FROM part""",
)
def f20(spark, sf_dir):
    listed = F.when(F.col("p_partkey") % 4 != 0, F.to_json(F.array("p_brand", "p_name")))
    return ad.table(spark, sf_dir, "part").select(
        "p_partkey", text.append_to_list(listed, F.col("p_type")).alias("list")
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.concat(F.md5("c_name"), F.md5("c_mktsegment"))
    data = F.concat(F.lit("0x"), F.repeat(word, (F.col("c_custkey") % 4).cast("int")))
    return ad.table(spark, sf_dir, "customer").select("c_custkey", data.alias("data"))


@query("F21_payload_words", "SELECT c_custkey, c_custkey % 4 AS n_words, CASE WHEN c_custkey % 4 > 0 THEN '0x' || md5(c_name) || md5(c_mktsegment) END AS last_word FROM customer")
def f21(spark, sf_dir):
    words = hexa.payload_words(F.col("data"))
    return payloads(spark, sf_dir).select(
        "c_custkey", F.size(words).cast("bigint").alias("n_words"), F.try_element_at(words, F.lit(-1)).alias("last_word")
    )


@query(
    "R3_word_table",
    """SELECT c_custkey, i AS pos, '0x' || md5(c_name) || md5(c_mktsegment) AS word
FROM (SELECT *, unnest(range(c_custkey % 4)) AS i FROM customer)""",
)
def r3(spark, sf_dir):
    words = reports.word_table(payloads(spark, sf_dir), "data", "c_custkey")
    return words.withColumn("pos", F.col("pos").cast("bigint"))


_VERSIONS_SQL = """
WITH v AS (
  SELECT p_partkey, p_brand, '1.' || p_size % 12 AS a, '1.' || p_partkey % 12 || '.' || p_partkey % 3 AS b,
    [1, p_size % 12, 0] AS la, [1, p_partkey % 12, p_partkey % 3] AS lb FROM part
)
"""


def version_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_brand", "concat('1.', p_size % 12) AS a",
        "concat('1.', p_partkey % 12, '.', p_partkey % 3) AS b",
    )


@query("F22_larger_version", _VERSIONS_SQL + "SELECT p_partkey, CASE WHEN la >= lb THEN a ELSE b END AS version FROM v")
def f22(spark, sf_dir):
    return version_pairs(spark, sf_dir).select(
        "p_partkey", versions.larger_version(F.col("a"), F.col("b")).alias("version")
    )


@query("R4_latest_version", _VERSIONS_SQL + "SELECT p_brand, arg_max(b, lb) AS version FROM v GROUP BY p_brand")
def r4(spark, sf_dir):
    return reports.latest_version_per_key(version_pairs(spark, sf_dir), "p_brand", "b")


@query(
    "F24_row_key",
    """SELECT c_custkey, md5(CAST(c_custkey AS VARCHAR)) || '_' || c_name AS key1,
  md5(c_custkey || '|' || c_mktsegment) AS key2 FROM customer""",
)
def f24(spark, sf_dir):
    key, name, segment = F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment")
    return ad.table(spark, sf_dir, "customer").select(
        "c_custkey", text.row_key([(key, True), (name, False)], "_").alias("key1"),
        text.row_key([(key, False), (segment, False)], "|", whole_md5=True).alias("key2"),
    )


@query(
    "F25_day_bucket",
    """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 0 ELSE epoch_us(ts) // 1000 // CASE WHEN event_id % 2 = 0 THEN 1000 ELSE 1 END
    * CASE WHEN event_id % 2 = 0 THEN 1000 ELSE 1 END END AS ms,
  CASE WHEN event_id % 5 = 0 THEN 'day=19700101' ELSE 'day=' || strftime(ts, '%Y%m%d') END AS bucket FROM events""",
)
def f25(spark, sf_dir):
    mixed = F.expr("CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 2 = 0 THEN ms div 1000 ELSE ms END")
    return event_times(spark, sf_dir).select(
        "event_id", dates.normalise_epoch(mixed).alias("ms"), dates.day_bucket(mixed).alias("bucket")
    )


@query("F26_yesterday", "SELECT event_id, strftime(ts - INTERVAL 1 DAY, '%Y-%m-%d') AS eve FROM events")
def f26(spark, sf_dir):
    return event_times(spark, sf_dir).select("event_id", dates.yesterday(F.col("ms")).alias("eve"))


@query(
    "F27_json_edit",
    sql.LOG + "SELECT seq, mid, '0' AS is_new, CAST(NULL AS VARCHAR) AS area, page_id FROM al",
)
def f27(spark, sf_dir):
    """Put a key, remove one, serialise, and read the text with typed getters."""
    edited = F.col("common").withField("is_new", F.lit("0")).dropFields("ar")
    rows = parsed(spark, sf_dir, "common", "page").select(
        "seq", text.to_json_text(F.struct(edited.alias("common"), "page")).alias("j")
    )
    names = {"mid": "common.mid", "is_new": "common.is_new", "area": "common.ar", "page_id": "page.page_id"}
    return rows.select("seq", *[F.get_json_object("j", f"$.{p}").alias(n) for n, p in names.items()])


# --- aggregates -------------------------------------------------------------


@query(
    "A1_median_compat",
    "SELECT l_returnflag, round(avg(l_extendedprice), 4) AS median_compat FROM lineitem GROUP BY 1",
)
def a1(spark, sf_dir):
    return ad.table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.round(aggregates.median_compat(F.col("l_extendedprice")), 4).alias("median_compat")
    )


@query(
    "A2_median",
    "SELECT l_returnflag, round(median(l_extendedprice), 4) AS median FROM lineitem GROUP BY 1",
)
def a2(spark, sf_dir):
    rows = ad.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    return aggregates.exact_median(rows, ["l_returnflag"], "l_extendedprice").withColumn(
        "median", F.round("median", 4)
    )


@query("A3_row_count", "SELECT count(*) AS row_count FROM lineitem")
def a3(spark, sf_dir):
    return aggregates.row_count(ad.table(spark, sf_dir, "lineitem"))


@query(
    "R5_day_spine",
    """
WITH d AS (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1),
s AS (SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS day FROM d)
SELECT CAST(strftime(day, '%Y%m%d') AS INT) AS day, coalesce(n, 0) AS n FROM s LEFT JOIN d ON day = d""",
)
def r5(spark, sf_dir):
    return reports.day_spine(ad.table(spark, sf_dir, "events"), F.col("ts").cast("date"))
