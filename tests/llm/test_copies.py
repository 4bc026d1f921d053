"""Exact copies against a plain dictionary, with sound and with colliding hashes."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemart.llm.copies import drop_copies, find_copies
from tidemart.llm.queries import ORACLES, QUERIES
from tests.compare import connect, difference
from tests.llm.tables import odd_documents

SF_DIR = "/root/testdata/sf0.001"
BLANKS = re.compile(r"[\x20\x09-\x0D]")


def plain_copies(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[BLANKS.sub("", text or "")].append((-len(text or ""), key is None, key))
    out = []
    for content, own in groups.items():
        best = min(own, key=lambda r: (r[0], r[1], r[2] or 0))
        sha, stayed = hashlib.sha256(content.encode()).hexdigest(), False
        for r in own:
            kept = r == best and not stayed
            stayed |= kept
            out.append((r[2], best[2], len(own), kept, sha))
    return sorted(out, key=str)


def found(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def spaced(spark):
    rows = [(i, t) for i, t in enumerate(["a b", "ab", "a\tb ", None, "", " \n", "ab ", "AB", "x" * 300_000, "x " * 300_000])]
    rows += [(i, "hot group of one text" + " " * (i % 3)) for i in range(100, 300)]
    rows += [(7, "twice"), (7, "twice"), (None, "twice"), (None, "only null key")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


WEAK = {
    "sound": lambda c: F.unhex(F.md5(c)),
    "by length": lambda c: F.unhex(F.lpad(F.hex(F.length(c) % 3), 2, "0")),
    "one": lambda c: F.when(c.isNotNull(), F.unhex(F.lit("00"))),
}


@pytest.mark.parametrize("hashed", WEAK)
@pytest.mark.parametrize("table", [spaced, odd_documents])
def test_copies_whatever_the_hash(spark, table, hashed):
    docs = table(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(find_copies(docs, hashed=WEAK[hashed])) == plain_copies(rows)


def test_one_row_of_each_content_stays(spark):
    docs = odd_documents(spark)
    left = drop_copies(docs)
    assert left.columns == docs.columns
    assert left.count() == len({BLANKS.sub("", r.text or "") for r in docs.collect()})
    assert sorted(r.doc_id for r in drop_copies(spaced(spark)).where("doc_id between 100 and 300").collect()) == [101]
    assert find_copies(docs.where("false")).count() == drop_copies(docs.where("false")).count() == 0


def test_query_equals_sql(spark):
    df = QUERIES["op12_copies"](spark, SF_DIR)
    assert difference(df, connect(SF_DIR), ORACLES["op12_copies"]) is None
    assert df.where("not kept").count() > 0
