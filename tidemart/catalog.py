"""Tables in the session catalog: create, drop, apply a lifecycle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

def table_exists(spark: SparkSession, namespace: str, table: str) -> bool:
    return spark.catalog.tableExists(f"`{namespace}`.`{table}`")


def create_table(
    spark: SparkSession, namespace: str, table: str, families: tuple[str, ...] = ("info",)
) -> bool:
    """A key and one map per column family, compressed. True if it is there."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}`")
    cells = ", ".join(f"`{f}` MAP<STRING, STRING>" for f in families)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{namespace}`.`{table}` (row_key STRING, {cells}) "
        "USING parquet OPTIONS (compression 'snappy')"
    )
    return table_exists(spark, namespace, table)


def drop_table(spark: SparkSession, namespace: str, table: str) -> bool:
    """False if there was nothing to drop."""
    if not table_exists(spark, namespace, table):
        return False
    spark.sql(f"DROP TABLE `{namespace}`.`{table}`")
    return True


def fill_tables(rows: DataFrame, namespace: str, family: str = "info") -> int:
    """Replace the rows of each created table by those of a routed frame (sink_table, row_key, family map).

    The tables are named by the configuration, and one job fills each of them.
    """
    spark = rows.sparkSession
    names = [r[0] for r in rows.select("sink_table").distinct().toLocalIterator()]
    filled = 0
    for name in names:
        table = name.split(":", 1)[-1]
        if table_exists(spark, namespace, table):
            own = rows.filter(F.col("sink_table") == name).select("row_key", F.col(family).alias(family))
            own.write.mode("overwrite").insertInto(f"`{namespace}`.`{table}`")
            filled += 1
    return filled


def drop_all_tables(spark: SparkSession, namespace: str) -> list[str]:
    """Drop every table of a namespace and keep the namespace."""
    names = [t.name for t in spark.catalog.listTables(namespace) if not t.isTemporary]
    for name in names:
        drop_table(spark, namespace, name)
    return names


def create_dictionary(spark: SparkSession, namespace: str, table: str = "dim_base_dic") -> None:
    """C4: the dictionary dimension with its nested row."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}`")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{namespace}`.`{table}` "
        "(rk STRING, info STRUCT<dic_name: STRING, parent_code: STRING>) USING parquet"
    )


def apply_lifecycle(spark: SparkSession, actions: DataFrame, namespace: str) -> int:
    """Run the final action of each table, one after the other; the driver holds one partition of them at a time.

    ``actions`` are those of the changes not applied before: a table that an
    earlier change had dropped and created again is left alone.
    """
    done = 0
    for row in actions.toLocalIterator():
        done += 1
        table = row["table"].split(":", 1)[-1]
        if row["recreate"]:
            drop_table(spark, namespace, table)
        if row["action"] == "create":
            create_table(spark, namespace, table)
    return done
