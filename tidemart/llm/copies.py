"""Exact copies: rows grouped by a 128-bit hash of their content, bytes compared inside the groups.

Texts move only where a hash occurs more than once, and of those one copy per
task at most: equal texts are folded before the exchange, so that a group with a
third of all rows sends no more than any other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.ranges import stored

BLANKS = r"[\x20\x09-\x0D]+"
# What is broadcast of a set of hashes has at most so many rows, whatever the set.
CELLS = 1 << 20


def without_blanks(text: Column) -> Column:
    """The text without blanks, tabs and line ends; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, "")


def content_hash(content: Column) -> Column:
    """128 bits of the content."""
    return F.unhex(F.md5(content))


def _cell(hashed: Column) -> Column:
    return F.pmod(F.xxhash64(hashed), F.lit(CELLS)).cast("int")


def near_hashes(rows: DataFrame, hashes: DataFrame) -> DataFrame:
    """Rows whose hash may be one of ``hashes``: all that are, and few others while the hashes are few.

    Only the cells that hashes fall into are broadcast, ``CELLS`` integers at most.
    """
    cells = hashes.select(_cell(F.col("h")).alias("cell")).distinct()
    return rows.withColumn("cell", _cell(F.col("h"))).join(F.broadcast(cells), "cell", "left_semi").drop("cell")


def find_copies(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    content: Callable[[Column], Column] = without_blanks,
    hashed: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """Per row: ``key``, ``keep_id`` (of the row that stays), ``group_size``, ``kept``, ``text_sha256`` of the content.

    ``content`` says what of a text counts, ``hashed`` gives its hash. Rows are
    alike if their contents are the same bytes. Of a group stays the row with the
    most code points in its original text, then the smallest key.

    The small rows of keys, lengths and hashes are written once. Contents of
    repeated hashes are folded per task and meet by hash and bytes; a hash that is
    left with two contents is a collision, and its rows get their bytes as second
    part of the group's key. Groups are then formed from small rows with a partial
    aggregate, and joined back to their rows.

    A null text counts as empty. A null key counts as larger than all others. Of
    rows with the same key, length and content exactly one stays. An empty table
    gives an empty result. Very long texts are taken whole. Other columns are not
    read, so their names do not matter.
    """
    rows = docs.select(
        F.col(key).cast("long").alias("id"),
        F.length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n"),
        content(F.col(text)).alias("c"),
    )
    rows = rows.withColumn("h", hashed(F.col("c"))).withColumn("sha", F.sha2("c", 256))
    # written, so that the number of a row does not change when a task runs again
    signs = stored(rows.select("id", "n", "h", "sha", F.monotonically_increasing_id().alias("row")), "signs")
    repeated = signs.groupBy("h").count().where("count > 1").select("h")

    contents = near_hashes(rows.select("h", "c"), repeated).groupBy("h", "c").agg(F.count(F.lit(1)).alias("rows"))
    collided = stored(contents.groupBy("h").count().where("count > 1").select("h"), "collided")
    apart = near_hashes(rows, collided).join(collided, "h", "left_semi")
    apart = stored(
        apart.select("id", "n", "h", "sha", F.monotonically_increasing_id().alias("row"), F.col("c").alias("v")), "apart"
    )
    keyed = signs.join(collided, "h", "left_anti").withColumn("v", F.lit("")).unionByName(apart)

    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("id").isNull().alias("none"), "id", "row"))
    groups = keyed.groupBy("h", "v").agg(F.count(F.lit(1)).alias("size"), best.alias("best"))
    groups = stored(groups.where("size > 1"), "groups")
    alone = F.col("size").isNull()
    return keyed.join(groups, ["h", "v"], "left").select(
        F.col("id").alias(key),
        F.when(alone, F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce(F.col("size"), F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("best.row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns.

    Rows that share key and content, of which one stays, are ordered by length,
    text and a hash of all columns; rows that are the same in all of them are
    interchangeable.
    """
    stay = find_copies(docs, key, text).where("kept").select(F.col(key).cast("long").alias("__id"), F.col("text_sha256").alias("__sha"))
    own = docs.withColumns(
        {
            "__id": F.col(key).cast("long"),
            "__sha": F.sha2(without_blanks(F.col(text)), 256),
            "__n": F.length(F.coalesce(F.col(text), F.lit(""))),
            "__all": F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns]))),
        }
    )
    first = Window.partitionBy("__id", "__sha").orderBy(F.desc("__n"), F.col(text), "__all")
    own = own.withColumn("__first", F.row_number().over(first)).where("__first = 1")
    met = own.alias("o").join(stay.alias("s"), F.expr("o.__id <=> s.__id AND o.__sha = s.__sha"), "left_semi")
    return met.select(*[F.col(f"o.`{c}`") for c in docs.columns])
