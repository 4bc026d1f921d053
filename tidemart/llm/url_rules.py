"""URL filters: host-suffix and path-prefix expressions against a rule table."""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclasses.dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, UPPER.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def short_hash(digest: Column) -> Column:
    """The first four bytes of a hex digest."""
    return F.substring(digest, 1, 8)


def rule_table(spark, rules: Sequence[Rule]) -> DataFrame:
    """Rules with their full digest and its short prefix.

    Rules with the same host and path: ``block`` wins.
    """
    rows = [(r.verdict, r.host, r.path) for r in rules]
    table = spark.createDataFrame(rows, "verdict string, host string, path string")
    table = table.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block > allow
    table = table.withColumn("rule", F.concat("host", "path"))
    digest = F.sha2(F.concat_ws("\n", "host", "path"), 256)
    return table.select(
        F.col("rule"),
        F.col("verdict").alias("rule_verdict"),
        F.length("rule").alias("rule_length"),
        F.length("host").alias("rule_host_length"),
        digest.alias("rule_digest"),
        short_hash(digest).alias("short"),
    )


def judge_urls(
    urls: DataFrame,
    rules: Sequence[Rule],
    key: str = "page_id",
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """One row per row of ``urls``: key, host, path, rule and verdict.

    Each URL is expanded into the suffixes of its host, at the numbers of labels that
    rule hosts have, times the prefixes of its path at the lengths that rule paths have. The expressions
    meet the rules by an equality join on four digest bytes; the full digest then
    confirms, and the longest rule wins (among equal ones the longer host, then
    ``block``). Without a rule the verdict is ``default``. The join side of the
    rules is left to the optimizer, which broadcasts by its known size and splits
    a hot rule otherwise.

    A null URL or one without ``://`` has an empty host and path, and fits no
    rule. Repeated rows come out as often as they came in; rows with a null key
    are kept. Other columns, whatever their names, are not looked at. No rules:
    every row gets ``default``.
    """
    spark = urls.sparkSession
    table = rule_table(spark, rules)
    lengths = sorted({len(r.path) for r in rules})
    # repeated rows are folded first and unfolded at the end
    rows = urls.select(F.col(key).alias("k"), F.col(url).alias("u")).groupBy("k", "u").agg(F.count(F.lit(1)).alias("times"))
    rows = rows.select("k", "u", "times", url_host(F.col("u")).alias("host"), url_path(F.col("u")).alias("path"))
    # only suffixes with as many labels as some rule's host: the work does not grow with the number of labels of a url
    labels = sorted({len(r.host.split(".")) for r in rules})
    suffixes = F.array(*[F.substring_index("host", ".", -n) for n in labels]).cast("array<string>")
    whole = F.array(*[F.lit(n) for n in lengths]).cast("array<int>")
    prefixes = F.transform(
        F.filter(whole, lambda n: n <= F.length("path")),
        lambda n: F.substring(F.col("path"), F.lit(1), n),
    )
    expressions = F.flatten(
        F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.sha2(F.concat_ws("\n", h, p), 256)))
    )
    spread = rows.withColumn("expressions", F.when(F.col("host") != "", F.array_distinct(expressions)))
    spread = spread.select("k", "u", "times", "host", "path", F.explode_outer("expressions").alias("digest"))
    spread = spread.withColumn("short", short_hash(F.col("digest")))
    met = spread.join(table, "short", "left")
    fits = F.col("rule_digest") == F.col("digest")
    best = F.max(
        F.when(
            fits,
            F.struct("rule_length", "rule_host_length", (F.col("rule_verdict") == "block").alias("blocks"), "rule", "rule_verdict"),
        )
    )
    judged = met.groupBy("k", "u").agg(
        F.first("host").alias("host"), F.first("path").alias("path"), F.first("times").alias("times"), best.alias("best")
    )
    judged = judged.select(
        "*", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy")
    )
    return judged.select(
        F.col("k").alias(key),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.rule_verdict"), F.lit(default)).alias("verdict"),
    )
