"""Change feed, routing, sinks, catalog and aggregates on small fixtures."""

import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemart import catalog
from tidemart.operators.aggregates import exact_median
from tidemart.operators.cart import cart_add, changelog_text
from tidemart.operators.envelope import latest_per_key
from tidemart.operators.joins import join_small
from tidemart.operators.lifecycle import final_actions, lifecycle_actions
from tidemart.operators.reports import latest_version_per_key
from tidemart.operators.routing import dim_route, fact_route, live_config
from tidemart.sinks.daybucket import day_bucket_stream, write_day_buckets
from tidemart.sinks.upsert import compact_to, read_upsert, upsert_batch
from tidemart.sinks.topics import topic_sink
from tidemart.sources.files import new_files_stream
from tidemart.sources.tables import camel
from tidemart.sources.topics import change_table
from tidemart.streaming.runs import run_continuously

ENVELOPE = (
    "seq bigint, op string, before map<string,string>, after map<string,string>, "
    "source map<string,string>, ts_ms bigint"
)

CART = [
    ("r", None, 3, "cart_info"), ("c", None, 3, "cart_info"), ("u", 1, 4, "cart_info"),
    ("u", 4, 1, "cart_info"), ("u", 2, 2, "cart_info"), ("u", None, 4, "cart_info"),
    ("d", 4, None, "cart_info"), ("u", 1, 4, "other"),
]


def envelopes(spark, rows):
    def image(n):
        return None if n is None else {"id": "7", "sku_num": str(n)}

    data = [
        (i, op, image(b), image(a), {"db": "shop", "table": t}, i) for i, (op, b, a, t) in enumerate(rows)
    ]
    return spark.createDataFrame(data, ENVELOPE)


def test_cart_add(spark):
    df = envelopes(spark, CART)
    kept = {r.ts_ms: r.sku_num for r in cart_add(df, "shop").collect()}
    assert kept == {0: None, 2: 3}
    kept = {r.ts_ms: r.sku_num for r in cart_add(df, "shop", include_inserts=True).collect()}
    assert kept == {0: 3, 1: 3, 2: 3}
    assert cart_add(df, "elsewhere").count() == 0
    text = [r.value for r in changelog_text(cart_add(df, "shop")).collect()]
    assert "+I[7, null, null, null, 3, null, null, null, null, null, null, null, 2]" in text


def test_change_table_mixed_types(spark):
    line = '{"op":"u","before":null,"after":{"id":1,"ok":true,"o":{"a":1}},"source":{"table":"t"},"ts_ms":5}'
    row = change_table(spark.createDataFrame([(line,)], "value string")).first()
    assert row.after == {"id": "1", "ok": "true", "o": '{"a":1}'} and row.before is None


CONFIG = [
    (1, "c", None, {"source_table": "a", "sink_table": "x", "sink_row_key": "id"}),
    (2, "c", None, {"source_table": "b", "sink_table": "y", "sink_row_key": "id"}),
    (3, "u", {"source_table": "a", "sink_table": "x"}, {"source_table": "a", "sink_table": "x2", "sink_row_key": "id"}),
    (4, "d", {"source_table": "b", "sink_table": "y"}, None),
]


def config_changes(spark):
    return spark.createDataFrame([(s, op, b, a, {}, s) for s, op, b, a in CONFIG], ENVELOPE)


def test_live_config_and_routes(spark):
    live = live_config(config_changes(spark)).select(
        *[F.col("after")[c].alias(c) for c in ("source_table", "sink_table", "sink_row_key")]
    )
    assert [tuple(r) for r in live.collect()] == [("a", "x2", "id")]
    df = envelopes(spark, [("r", None, 1, "a"), ("r", None, 1, "b"), ("d", 1, None, "a")])
    rows = dim_route(df, live, "ns").collect()
    assert [(r.sink_table, r.row_key, r.info) for r in rows] == [("ns:x2", "7", {"id": "7", "sku_num": "1"})]
    routed = fact_route(df, live, destination="source_table").collect()
    assert [(r.topic, r.sink_table) for r in routed] == [("a", "x2")]


def test_lifecycle(spark):
    actions = lifecycle_actions(config_changes(spark), "life_ns")
    assert [tuple(r) for r in actions.orderBy("seq", "step").collect()] == [
        (1, 0, "create", "life_ns:x"), (2, 0, "create", "life_ns:y"), (3, 0, "drop", "life_ns:x"),
        (3, 1, "create", "life_ns:x2"), (4, 0, "drop", "life_ns:y"),
    ]
    catalog.create_table(spark, "life_ns", "y")
    catalog.apply_lifecycle(spark, final_actions(actions), "life_ns")
    assert [t.name for t in spark.catalog.listTables("life_ns")] == ["x2"]
    catalog.create_dictionary(spark, "life_ns")
    assert spark.table("life_ns.dim_base_dic").schema["info"].dataType.names == ["dic_name", "parent_code"]
    assert sorted(catalog.drop_all_tables(spark, "life_ns")) == ["dim_base_dic", "x2"]
    assert not catalog.drop_table(spark, "life_ns", "x2")
    spark.sql("DROP DATABASE life_ns")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_broadcast(spark, how):
    big = spark.range(2000).selectExpr("id AS seq", "if(id % 3 = 0, 0, id % 50) AS k")
    small = spark.range(40).selectExpr("id AS k", "id * 2 AS v")
    one = join_small(big, small, ["k"], how).select("seq", "k", "v")
    salted = join_small(big, small, ["k"], how, max_rows=5, salts=8).select("seq", "k", "v")
    plan = salted._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, salted.collect()), key=str)


def test_latest_per_key_limits_before_the_exchange(spark):
    df = spark.range(1000).selectExpr("id AS seq", "id % 3 AS k")
    last = latest_per_key(df, ["k"], ["seq"])
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert {r.k: r.seq for r in last.collect()} == {0: 999, 1: 997, 2: 998}


def test_upsert_replay_and_compaction(spark, tmp_path):
    path, folded = str(tmp_path / "t"), str(tmp_path / "t2")

    def batch(rows):
        return spark.createDataFrame(rows, "k string, v int, seq int, op string")

    first, second = [("a", 1, 1, "r"), ("a", 2, 2, "u"), ("b", 1, 1, "r")], [("b", 9, 1, "u"), ("a", 0, 3, "d")]
    for batch_id, rows in ((0, first), (1, second), (0, first), (1, second)):
        upsert_batch(batch(rows), path, batch_id, ["k"], ["seq"])
    assert {r.k: r.v for r in read_upsert(spark, path, ["k"]).collect()} == {"a": 0, "b": 9}
    assert {r.k: r.v for r in read_upsert(spark, path, ["k"], deleted="op = 'd'").collect()} == {"b": 9}
    assert {r.k: r.v for r in read_upsert(spark, path, ["k"], before=1).collect()} == {"a": 2, "b": 1}
    compact_to(spark, path, folded, ["k"])
    upsert_batch(batch([("c", 5, 1, "r")]), folded, 2, ["k"], ["seq"])
    assert {r.k: r.v for r in read_upsert(spark, folded, ["k"]).collect()} == {"a": 0, "b": 9, "c": 5}


BUCKETS = {
    '{"t":1704067200}': "20240101", '{"t":1704067200000}': "20240101", '{"x":1}': "19700101",
    '{"t":"soon"}': "error_bucket", '{"t":': "error_bucket",
}


def test_day_buckets(spark, tmp_path):
    df = spark.createDataFrame([(v,) for v in BUCKETS], "value string")
    write_day_buckets(df, str(tmp_path / "batch"), "t")
    df.write.text(str(tmp_path / "in"))
    stream = spark.readStream.text(str(tmp_path / "in"))
    day_bucket_stream(
        stream, str(tmp_path / "stream"), "t", str(tmp_path / "cp")
    ).trigger(availableNow=True).start().awaitTermination()
    for name in ("batch", "stream"):
        back = spark.read.schema("value string, day string").text(str(tmp_path / name))
        assert {r.value: r.day for r in back.collect()} == BUCKETS


def test_day_buckets_keep_earlier_days(spark, tmp_path):
    path = str(tmp_path / "days")
    days = ['{"t":1704067200.5}', '{"t":1704153600}']
    for batch, line in enumerate([*days, days[1]]):
        write_day_buckets(spark.createDataFrame([(line,)], "value string"), path, "t", batch_id=min(batch, 1))
    back = spark.read.schema("value string, day string, batch int").text(path).collect()
    assert sorted((r.day, r.value) for r in back) == [("20240101", days[0]), ("20240102", days[1])]
    flat = str(tmp_path / "plain")
    for line in days:
        write_day_buckets(spark.createDataFrame([(line,)], "value string"), flat, "t")
    assert spark.read.text(flat).count() == 2


def test_median_keeps_the_type(spark):
    big = 9007199254740993
    df = spark.sql(f"SELECT * FROM VALUES ('a', {big}L), ('b', {big}L), ('b', {big + 1}L) AS t(g, x)")
    got = {r.g: r.median for r in exact_median(df, ["g"], "x").collect()}
    assert got["a"] == big and got["b"] == Decimal(f"{big}.5")
    exact = df.selectExpr("g", "cast(x as decimal(38,2)) + 0.01BD AS x")
    assert {r.g: r.median for r in exact_median(exact, ["g"], "x").collect()}["a"] == Decimal(f"{big}.01")


def test_median_keeps_the_half(spark):
    for kind in ("decimal(38,2)", "decimal(38,10)", "decimal(20,2)", "decimal(5,0)"):
        df = spark.sql(f"SELECT * FROM VALUES ('a', 1.01), ('a', 1.02), ('b', 2), ('b', 3) AS t(g, x)").selectExpr("g", f"cast(x AS {kind}) AS x")
        got = {r.g: r.median for r in exact_median(df, ["g"], "x").collect()}
        assert got == {"a": Decimal("1") if kind.endswith(",0)") else Decimal("1.015"), "b": Decimal("2.5")}
    wide = spark.sql("SELECT 'a' AS g, cast(repeat('9', 36) AS decimal(38,0)) AS x")
    with pytest.raises(Exception, match="(?i)out_of_range|overflow"):
        exact_median(wide, ["g"], "x").collect()


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_latest_version_does_not_depend_on_partitions(spark, parts):
    df = spark.createDataFrame([("k", v) for v in ("1.0", "1", "1.0.0", "0.9")], "k string, v string").repartition(parts, "v")
    assert latest_version_per_key(df, "k", "v").first().version == "1.0.0"


def test_lines_without_buckets(spark, tmp_path):
    df = spark.createDataFrame([(v,) for v in BUCKETS], "value string")
    write_day_buckets(df, str(tmp_path / "flat"), None)
    assert {r.value for r in spark.read.text(str(tmp_path / "flat")).collect()} == set(BUCKETS)


def test_one_table_of_an_upsert_folder(spark, tmp_path):
    """Reading one sink table prunes the folders of the others."""
    path = str(tmp_path / "dims")
    df = spark.range(30).selectExpr("concat('ns:t', id % 3) AS sink_table", "id % 10 AS row_key", "id AS seq")
    upsert_batch(df, path, 0, ["sink_table", "row_key"], ["seq"], ("sink_table",))
    one = read_upsert(spark, path, ["sink_table", "row_key"]).filter("sink_table = 'ns:t1'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sink_table" in plan
    assert one.count() == 10


def test_continuous_run(spark, tmp_path):
    spark.range(5).selectExpr("string(id) AS value").write.text(str(tmp_path / "in"))
    writer = topic_sink(
        new_files_stream(spark, str(tmp_path / "in")), str(tmp_path / "cp"), format="text", path=str(tmp_path / "out")
    )
    running = run_continuously(writer, "lines", "1 second")
    running.processAllAvailable()
    running.stop()
    assert spark.read.text(str(tmp_path / "out")).count() == 5


def test_median_of_skewed_groups(spark):
    rng = random.Random(1)
    groups = {
        "hot": [rng.choice([1.0, 2.0, rng.random()]) for _ in range(3000)], "one": [5.0],
        "two": [1.0, 2.0], None: [3.0, 9.0, 4.0], "same": [7.0] * 500, "neg": [-1.5, 0.0, 8.25, 3.0],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("one", None)]
    got = exact_median(spark.createDataFrame(rows, "g string, x double"), ["g"], "x")
    assert {r.g: r.median for r in got.collect()} == {k: statistics.median(v) for k, v in groups.items()}


@pytest.mark.parametrize("name, want", [("source_table", "sourceTable"), ("SINK_ROW_KEY", "sinkRowKey"), ("op", "op")])
def test_camel(name, want):
    assert camel(name) == want
