"""Dimension tables that a stream of configuration changes creates, fills and drops.

Configuration and data come in one stream, in order of arrival. Everything that
depends on this order is an interval join: a data row meets the route that was in
force when it arrived, and the epoch of its table, which begins when the table is
created and ends when it is dropped. Rows of ended epochs are never read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemart.operators.envelope import no_deletes, text_payload
from tidemart.operators.lifecycle import lifecycle_actions
from tidemart.sinks.state_table import StateTable

ROUTE = ("source_table", "sink_table", "sink_row_key")


def route_intervals(changes: DataFrame, namespace: str) -> DataFrame:
    """(source_table, sink_table, sink_row_key, since, until) of the routes; ``until`` is null for those in force."""
    image = F.coalesce("after", "before")
    own = Window.partitionBy(image["source_table"]).orderBy("seq")
    rows = changes.withColumn("until", F.lead("seq").over(own)).filter(F.col("op") != "d")
    return rows.select(
        F.col("after")["source_table"].alias("source_table"),
        F.concat(F.lit(f"{namespace}:"), F.col("after")["sink_table"]).alias("sink_table"),
        F.col("after")["sink_row_key"].alias("sink_row_key"), F.col("seq").alias("since"), "until",
    )


def epochs(changes: DataFrame, namespace: str) -> DataFrame:
    """(sink_table, since, until): the times in which a table exists.

    A table that exists is not created again; a drop of none does nothing.
    """
    actions = lifecycle_actions(changes, namespace)
    own = Window.partitionBy("table").orderBy("seq", "step")
    before = actions.withColumn("last", F.lag("action").over(own))
    turns = before.filter(F.when(F.col("last").isNull(), F.col("action") == "create").otherwise(F.col("action") != F.col("last")))
    own = Window.partitionBy("table").orderBy("seq", "step")
    ends = turns.withColumn("until", F.lead("seq").over(own))
    return ends.filter("action = 'create'").select(F.col("table").alias("sink_table"), F.col("seq").alias("since"), "until")


def _at(seq: str, since: str, until: str):
    return (F.col(since) <= F.col(seq)) & (F.col(until).isNull() | (F.col(seq) < F.col(until)))


class LiveTables:
    """``write`` is a ``foreachBatch`` function for envelopes of both kinds, with ``seq`` in order of arrival.

    ``config_db`` names the database of the configuration changes. They are kept in
    a state table of their own; their number, not that of the data, bounds the two
    interval tables. All rows of a batch are put in one job, whatever the number
    of tables. After a batch each table stands in the catalog as a view of its
    current epoch (``publish``), and views of dropped tables are gone.
    """

    def __init__(self, spark: SparkSession, path: str, namespace: str, config_db: str, buckets: int = 32):
        self.spark, self.namespace, self.config_db = spark, namespace, config_db
        self.config = StateTable(spark, f"{path}/config", ["seq"], 1)
        self.rows = StateTable(spark, f"{path}/rows", ["sink_table", "since", "row_key"], buckets, cells="info")

    def write(self, batch: DataFrame, batch_id: int) -> None:
        if not self.rows.applied(batch_id):
            batch = batch.persist()
            try:
                is_config = F.col("source")["db"] == self.config_db
                news = batch.filter(is_config).select("seq", "op", "before", "after")
                self.config.put(news, batch_id, ["seq"])
                self.rows.put(self._routed(batch.filter(~is_config)), batch_id, ["seq"])
            finally:
                batch.unpersist()
        self.publish()

    def _routed(self, data: DataFrame) -> DataFrame:
        changes = self.config.read()
        routes = route_intervals(changes, self.namespace).alias("r")
        alive = epochs(changes, self.namespace).alias("e")
        rows = no_deletes(data).select("seq", F.col("source")["table"].alias("of"), "after").alias("d")
        met = rows.join(routes, (F.col("of") == F.col("r.source_table")) & _at("seq", "r.since", "r.until"))
        met = met.join(alive, (F.col("r.sink_table") == F.col("e.sink_table")) & _at("seq", "e.since", "e.until"))
        return met.select(
            F.col("e.sink_table").alias("sink_table"), F.col("e.since").alias("since"),
            F.element_at("after", F.col("r.sink_row_key")).alias("row_key"), text_payload(F.col("after")).alias("info"), "seq",
        ).filter("row_key IS NOT NULL")

    def names(self) -> dict[str, object]:
        """Tables that exist now, without the namespace, and when their epochs began."""
        changes = self.config.read()
        if changes is None:
            return {}
        now = epochs(changes, self.namespace).filter("until IS NULL")
        return {r["sink_table"].split(":", 1)[1]: r["since"] for r in now.toLocalIterator()}

    def table(self, name: str) -> DataFrame:
        """(row_key, info) of one table; raises if it does not exist."""
        since = self.names()[name]
        rows = self.rows.read()
        own = (F.col("sink_table") == f"{self.namespace}:{name}") & (F.col("since") == F.lit(since))
        return rows.filter(own).select("row_key", "info")

    def publish(self) -> None:
        """Put the views of the tables that exist into the catalog, and take out the others; one statement each."""
        spark, db = self.spark, self.namespace
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
        live = self.names()
        for t in spark.catalog.listTables(db):
            if not t.isTemporary and t.tableType == "VIEW" and t.name not in {n.lower() for n in live}:
                spark.sql(f"DROP VIEW `{db}`.`{t.name}`")
        runs = [f"{self.rows.path}/{r['name']}" for r in self.rows.current()["runs"]]
        for name, since in live.items():
            since = f"'{since}'" if isinstance(since, str) else since
            parts = " UNION ALL ".join(
                f"SELECT row_key, info, {i} AS run FROM parquet.`{r}` WHERE sink_table = '{db}:{name}' AND since = {since}"
                for i, r in enumerate(runs)
            ) or "SELECT '' AS row_key, cast(map() AS map<string, string>) AS info, 0 AS run WHERE false"
            spark.sql(
                f"""CREATE OR REPLACE VIEW `{db}`.`{name}` AS
                SELECT row_key, aggregate(array_sort(collect_list(struct(run, info)), (a, b) -> a.run - b.run), cast(map() AS map<string, string>),
                    (old, new) -> map_concat(map_filter(old, (k, v) -> NOT map_contains_key(new.info, k)), new.info)) AS info
                FROM ({parts}) GROUP BY row_key"""
            )
