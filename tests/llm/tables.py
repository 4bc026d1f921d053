"""Small tables with the hard cases: nulls, empty and long texts, repeated rows, clashing names."""

import random

LICENSE = "Released under the MIT License. apache LICENSE, version 2; CC-BY-NC cc by nc"


def words(rng, n):
    return " ".join(rng.choice(["the", "and", "tion", "word", "Ére", "straße", "mañana", "x1", "no,", "end."]) + str(rng.randint(0, 99)) for _ in range(n))


def odd_documents(spark):
    rng = random.Random(8)
    long = "\n".join(words(rng, 60) for _ in range(60))
    rows = [
        (1, words(rng, 40), "en"),
        (2, None, "en"),
        (3, "", None),
        (4, " \n\t ", "de"),
        (5, "One", "fr"),
        (6, long, "en"),
        (7, long, "en"),
        (8, long.replace("the", "thy", 20), "es"),
        (9, LICENSE, "en"),
        (9, LICENSE, "en"),
        (9, "other text under the same key", "de"),
        (None, "a key is missing here " + LICENSE, "fr"),
        (11, "中文 текст\u0301 😀 İK", None),
        (12, "12 34 !!", "en"),
    ]
    # extra columns, some with names that operators use for their own
    rows = [(a, b, c, "x", 1, None, 7, "k", True) for a, b, c in rows]
    kind = "doc_id long, text string, lang string, source string, n long, score double, t long, k string, kept boolean"
    return spark.createDataFrame(rows, kind)


def texts_of(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]
