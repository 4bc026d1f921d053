"""License scans by diagonal voting, with DataFrame functions only."""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

GRAM = 3
MAX_BROADCAST_GRAMS = 100_000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclasses.dataclass(frozen=True)
class Template:
    """A license text as words. ``exact``: it counts only where all words stand in a row."""

    label: str
    words: str
    exact: bool = False


# The phrases that must be found word by word.
BASE = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
)

# Openings and bodies of public license texts and the ways they are named.
KNOWN = (
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
    ),
    Template(
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
        "with the license you may obtain a copy of the license at",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    ),
    Template(
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ),
    Template(
        "mit",
        "the software is provided as is without warranty of any kind express or implied including but not limited to the "
        "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or "
        "copyright holders be liable for any claim damages or other liability whether in an action of contract tort or "
        "otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    ),
    Template(
        "apache-2",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an "
        "as is basis without warranties or conditions of any kind either express or implied see the license for the specific "
        "language governing permissions and limitations under the license",
    ),
    Template(
        "bsd",
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties "
        "including but not limited to the implied warranties of merchantability and fitness for a particular purpose are "
        "disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special "
        "exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of "
        "use data or profits or business interruption however caused and on any theory of liability whether in contract strict "
        "liability or tort including negligence or otherwise arising in any way out of the use of this software even if "
        "advised of the possibility of such damage",
    ),
    Template(
        "gpl",
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied "
        "warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details",
    ),
    Template(
        "isc",
        "the software is provided as is and the author disclaims all warranties with regard to this software including all "
        "implied warranties of merchantability and fitness in no event shall the author be liable for any special direct "
        "indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an "
        "action of contract negligence or other tortious action arising out of or in connection with the use or performance "
        "of this software",
    ),
    Template("gpl", "under the gnu general public license"),
    Template("cc-by-nc", "creative commons attribution noncommercial"),
    Template("cc-by", "creative commons attribution 4 0 international license"),
    Template("proprietary", "all rights reserved do not distribute"),
)


def license_words(text: Column) -> Column:
    """Words of digits, letters and everything beyond ASCII, after lower-casing A-Z.

    ``lower`` is the quick way; it turns two signs into ASCII letters, and texts
    with these take the exact way.
    """
    text = F.coalesce(text, F.lit(""))
    odd = F.contains(text, F.lit("İ")) | F.contains(text, F.lit("K"))
    low = F.when(odd, F.translate(text, UPPER, UPPER.lower())).otherwise(F.lower(text))
    return F.array_remove(F.split(low, BETWEEN_WORDS), "")


def gram_hashes(words: Column, size: int = GRAM) -> Column:
    """One hash for each run of ``size`` words."""
    n = F.size(words)
    runs = F.transform(
        F.slice(words, 1, F.greatest(n - size + 1, F.lit(0))),
        lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, size)]),
    )
    return runs


MARK = -1


def template_grams(spark, templates: Sequence[Template]) -> DataFrame:
    """Rows (gram, template, at, label, exact, runs, words); template -1 is the mark each document carries."""
    rows = [(MARK, "", False, [])]
    for i, t in enumerate(templates):
        words = t.words.split()
        if len(words) < GRAM:
            raise ValueError(f"a template has {GRAM} words at least: {t.label}")
        rows.append((i, t.label, t.exact, words))
    table = spark.createDataFrame(rows, "template int, label string, exact boolean, template_words array<string>")
    table = table.withColumn("runs", F.greatest(F.size("template_words") - GRAM + 1, F.lit(1)))
    grams = F.when(F.col("template") == MARK, F.array(F.lit(0).cast("long"))).otherwise(gram_hashes(F.col("template_words")))
    return table.withColumn("grams", grams).select(
        "template", "label", "exact", "runs", "template_words", F.posexplode_outer("grams").alias("at", "gram")
    )


def scan_licenses(
    docs: DataFrame,
    templates: Sequence[Template] = BASE + KNOWN,
    key: str = "doc_id",
    text: str = "text",
    least: float = 0.6,
    shift: int = 3,
) -> DataFrame:
    """One row per row of ``docs``: key, counts of the exact places, labels and a score.

    All runs of three words of a document are joined to the positions they have in
    the templates. A hit votes for the diagonal (position in the text minus
    position in the template); its words are compared, so equal hashes of
    different words do not count. An exact template stands where one diagonal
    has every run. For the others, diagonals at most ``shift`` apart are merged
    (words were put in or left out between them), and the label counts if at
    least ``least`` of the runs were met. The score is the largest share met,
    1 for an exact place.

    Null and empty texts have no words and score 0. Repeated rows come out as
    often as they came in. Keys may repeat with different texts: each text is
    scanned for itself. Other columns are not looked at. Without templates
    nothing is found.
    """
    spark = docs.sparkSession
    table = template_grams(spark, templates)
    if sum(len(t.words.split()) for t in templates) <= MAX_BROADCAST_GRAMS:
        table = F.broadcast(table)
    rows = docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("t"), license_words(F.col(text)).alias("words"))
    # The outer form keeps the optimizer from guessing a filter on the array, which would split the text once per word.
    # the mark in front makes each document meet one row of the table at least
    rows = rows.withColumn("grams", F.concat(F.array(F.lit(0).cast("long")), gram_hashes(F.col("words"))))
    runs = rows.select("k", "t", "words", F.posexplode_outer("grams").alias("place", "gram"))
    met = runs.join(table, "gram")
    place, mark = F.col("place") - 1, F.col("template") == MARK
    same = F.slice("words", F.greatest(place + 1, F.lit(1)), GRAM) == F.slice("template_words", F.col("at") + 1, GRAM)
    hits = met.where((mark & (F.col("place") == 0)) | (~mark & (F.col("place") > 0) & same)).select(
        "k", "t", "template", "label", "exact", "runs",
        F.size("words").alias("n_words"),
        (place - F.col("at")).alias("diagonal"),
        # positions met, 64 to a row
        F.floor(F.col("at") / 64).alias("slot"),
        F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at") % 64).alias("met"),
    )
    # few rows are left: one exchange by document serves all that follows
    hits = hits.repartition("k", "t")
    diagonals = hits.groupBy("k", "t", "template", "label", "exact", "runs", "diagonal", "slot").agg(
        F.bit_or("met").alias("met"), F.count(F.lit(1)).alias("rows"), F.max("n_words").alias("n_words")
    )
    order = W.partitionBy("k", "t", "template").orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(order)
    apart = step > F.when(F.col("exact"), 0).otherwise(shift)
    diagonals = diagonals.withColumn("chain", F.sum(F.when(apart, 1).otherwise(0)).over(order))
    slots = diagonals.groupBy("k", "t", "template", "label", "exact", "runs", "chain", "slot").agg(
        F.bit_or("met").alias("met"), F.min("diagonal").alias("start"), F.max("rows").alias("rows"),
        F.max("n_words").alias("n_words"),
    )
    spans = slots.groupBy("k", "t", "template", "label", "exact", "runs", "chain").agg(
        F.sum(F.bit_count("met")).alias("met"), F.min("start").alias("start"), F.max("rows").alias("rows"),
        F.max("n_words").alias("n_words"),
    )
    share = F.col("met") / F.col("runs")
    mark = F.col("template") == MARK
    spans = spans.withColumn("share", F.when(mark, 0.0).otherwise(share))
    exact = F.col("exact") & (F.col("share") == 1) & ~mark
    found = ~mark & F.when(F.col("exact"), F.col("share") == 1).otherwise(F.col("share") >= least)
    listed = lambda cond: F.array_join(F.array_sort(F.collect_set(F.when(cond, F.col("label")))), ",")
    per_doc = spans.groupBy("k", "t").agg(
        F.max(F.when(mark, F.col("n_words"))).cast("long").alias("n_words"),
        F.count(F.when(exact, 1)).alias("n_base"),
        F.min(F.when(exact, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(exact, F.col("start"))).cast("long").alias("last_word"),
        listed(exact).alias("base_labels"),
        listed(found).alias("labels"),
        F.max(F.when(found, F.least(F.col("share"), F.lit(1.0))).otherwise(0.0)).alias("score"),
        F.max(F.when(mark, F.col("rows"))).cast("int").alias("times"),
    )
    per_doc = per_doc.select("*", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"))
    return per_doc.select(
        F.col("k").alias(key), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )
