"""Queries of the catalog: tables that a configuration creates, fills and drops."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart import catalog
from tidemart.operators.lifecycle import final_actions, lifecycle_actions
from tidemart.operators.parse import fail_on_bad
from tidemart.operators.routing import config_columns, dim_route, live_config
from tidemart.plans import adapters as ad
from tidemart.plans.registry import query
from tidemart.schemas import CONFIG_DIM_COLUMNS, envelope
from tidemart.session import work_path
from tidemart.sources.changefeed import payload_of, source_of
from tidemart.sources.topics import append_segment, topic_stream
from tidemart.streaming.jobs import sink_all
from tidemart.streaming.live_tables import LiveTables
from tidemart.streaming.runs import run_available


def namespace(name: str) -> str:
    """A database of its own for each run."""
    return f"{name}_{uuid.uuid4().hex}"


def config_changes(regions: DataFrame) -> DataFrame:
    """Three steps of a dimension configuration: a route per region appears, odd ones move, region 4 goes."""

    def image(suffix: str):
        return payload_of(
            CONFIG_DIM_COLUMNS,
            source_table=F.concat(F.lit("nation_"), F.col("r_regionkey")),
            sink_table=F.concat(F.lit("dim_"), F.col("r_regionkey"), F.lit(suffix)),
            sink_columns=F.lit("n_nationkey,n_name"), sink_family=F.lit("info"), sink_row_key=F.lit("n_nationkey"),
        )

    none = F.lit(None).cast("map<string,string>")

    def change(step: int, op: str, before, after):
        return F.struct(F.lit(step).alias("step"), F.lit(op).alias("op"), before.alias("before"), after.alias("after"))

    moved, gone = F.col("r_regionkey") % 2 == 1, F.col("r_regionkey") == 4
    steps = F.array(
        change(0, "c", none, image("")),
        F.when(moved, change(1, "u", image(""), image("_v2"))),
        F.when(gone, change(2, "d", image(""), none)),
    )
    rows = regions.select("r_regionkey", F.inline(F.array_compact(steps)))
    return rows.select(
        (F.col("step") * 100 + F.col("r_regionkey")).cast("bigint").alias("seq"), "op", F.lit(ad.CONFIG_DB).alias("db"),
        "before", "after", source_of(ad.CONFIG_DB, F.lit("table_process_dim")).alias("source"),
        (F.lit(ad.BASE_MS) + F.col("step")).cast("bigint").alias("ts_ms"),
    )


def nation_changes(nations: DataFrame) -> DataFrame:
    """Nations as snapshot rows of a source table per region."""
    return nations.select(
        F.col("n_nationkey").cast("bigint").alias("seq"), F.lit("r").alias("op"), F.lit(ad.SHOP_DB).alias("db"),
        F.lit(None).cast("map<string,string>").alias("before"),
        payload_of(["n_nationkey", "n_name"]).alias("after"),
        source_of(ad.SHOP_DB, F.concat(F.lit("nation_"), F.col("n_regionkey"))).alias("source"),
        F.lit(ad.BASE_MS).cast("bigint").alias("ts_ms"),
    )


def rows_of_tables(spark: SparkSession, db: str) -> DataFrame:
    """All rows of all tables of a database, with the table's name."""
    out = spark.createDataFrame([], "tbl string, row_key string, name string")
    for t in sorted(t.name for t in spark.catalog.listTables(db) if not t.isTemporary):
        rows = spark.table(f"`{db}`.`{t}`").select(F.lit(t).alias("tbl"), "row_key", F.col("info")["n_name"].alias("name"))
        out = out.unionByName(rows)
    return out


TABLE_NAME = """'dim_' || n_regionkey || CASE WHEN n_regionkey % 2 = 1 THEN '_v2' ELSE '' END"""


@query(
    "C2_tables",
    f"""SELECT {TABLE_NAME} AS tbl, CAST(n_nationkey AS VARCHAR) AS row_key, n_name AS name FROM nation WHERE n_regionkey <> 4""",
)
def created_tables(spark, sf_dir):
    """The lifecycle of a configuration creates the tables, and routed rows fill them."""
    db = namespace("c2")
    changes = config_changes(ad.table(spark, sf_dir, "region"))
    catalog.apply_lifecycle(spark, final_actions(lifecycle_actions(changes, db)), db)
    config = config_columns(live_config(changes), CONFIG_DIM_COLUMNS)
    catalog.fill_tables(dim_route(nation_changes(ad.table(spark, sf_dir, "nation")), config, db), db)
    return rows_of_tables(spark, db)


@query(
    "C3_drop_all",
    "SELECT 'dim_' || r_regionkey AS dropped, 0 AS left_over FROM region",
)
def dropped_tables(spark, sf_dir):
    """Every table of a database goes; the database stays."""
    db = namespace("c3")
    for r in ad.table(spark, sf_dir, "region").select("r_regionkey").toLocalIterator():
        catalog.create_table(spark, db, f"dim_{r[0]}")
    names = catalog.drop_all_tables(spark, db)
    left = len(spark.catalog.listTables(db)) if spark.catalog.databaseExists(db) else -1
    return spark.createDataFrame([(n,) for n in names], "dropped string").withColumn("left_over", F.lit(left))


@query(
    "C4_dictionary",
    "SELECT CAST(n_nationkey AS VARCHAR) AS rk, n_name AS dic_name, CAST(n_regionkey AS VARCHAR) AS parent_code FROM nation",
)
def dictionary(spark, sf_dir):
    """The dictionary table with its nested row, filled from the nations."""
    db = namespace("c4")
    catalog.create_dictionary(spark, db)
    rows = ad.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("rk"),
        F.struct(F.col("n_name").alias("dic_name"), F.col("n_regionkey").cast("string").alias("parent_code")).alias("info"),
    )
    rows.write.insertInto(f"`{db}`.`dim_base_dic`")
    return spark.table(f"`{db}`.`dim_base_dic`").select("rk", "info.dic_name", "info.parent_code")


def arrival(step, key):
    """The place in the feed: the configuration changes of a step, then its data."""
    return (step * 1000 + key).cast("bigint")


@query(
    "T2_live_tables",
    """
WITH b AS (SELECT n_nationkey, n_name, n_regionkey, n_nationkey % 3 AS batch FROM nation), put AS (
  SELECT *, 'dim_' || n_regionkey || CASE WHEN n_regionkey % 2 = 1 THEN '_v2' ELSE '' END AS tbl FROM b
  WHERE n_regionkey <> 4 AND (n_regionkey % 2 = 0 OR batch >= 1)
)
SELECT tbl, CAST(n_nationkey AS VARCHAR) AS row_key, n_name AS name FROM put""",
)
def live_tables(spark, sf_dir):
    """Configuration and data in one topic: tables appear, move and go while rows arrive, and are read from the catalog.

    Region 4 loses its table in the last step, and odd regions get a new one in the second: what these tables held
    before is gone, as it is with a dropped table. Each step is a run of its own from the same checkpoint.
    """
    db, topic, checkpoint, path = namespace("t2"), *(work_path(spark, f"t2-{n}") for n in ("topic", "checkpoint", "tables"))
    step = F.floor(F.col("seq") / 100)
    changes = config_changes(ad.table(spark, sf_dir, "region")).withColumn("seq", arrival(step, F.col("seq") % 100))
    nations = nation_changes(ad.table(spark, sf_dir, "nation")).withColumn("seq", arrival(F.col("seq") % 3, F.col("seq") + 500))
    feed = ad.envelope_lines(changes.unionByName(nations))
    live = LiveTables(spark, path, db, ad.CONFIG_DB)
    for number in range(3):
        append_segment(feed.filter(F.floor(F.col("seq") / 1000) == number), topic, number)
        found = topic_stream(spark, "changes", format="text", path=f"{topic}/*", ordered=True)
        run_available(sink_all(fail_on_bad(found, envelope()), checkpoint, live.write))
    return rows_of_tables(spark, db)
