"""Spelling groups against all pairs of words in memory."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemart.llm.queries import QUERIES
from tidemart.llm.spelling import Trie, follow, group_spellings, in_trie_order
from tests.llm.tables import odd_documents

SF_DIR = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def words_of(rows, every):
    counts = Counter()
    for key, text in rows:
        for run in RUN.findall(text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if every and h % every == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_groups(rows, every):
    words = words_of(rows, every)
    near = {w: [u for u in words if one_edit(w, u)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda u: (-words[u], u), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()), key=str)


def found(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted([tuple(r) for r in df.collect()], key=str)


def variants(spark):
    rng = random.Random(6)
    pool = ["aabba", "aaabb", "aaaaa", "aaaa", "aaaaaa", "ababa", "babab", "Übung", "übung", "naïve", "naive", "straße", "strase", "x" * 400]
    rows = []
    for i in range(400):
        words = []
        for _ in range(rng.randint(0, 30)):
            w = rng.choice(pool)
            for _ in range(rng.choice([0, 0, 0, 1, 2])):
                at, how = rng.randrange(len(w) + 1), rng.randrange(3)
                w = w[:at] + (rng.choice("abè") if how else "") + w[at + (how != 1) :]
            words.append(w)
        rows.append((rng.choice([i, i, None]), rng.choice([" ", "1", "\n×"]).join(words) if i % 17 else None))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(6)


@pytest.mark.parametrize("every", [0, 3, 97])
@pytest.mark.parametrize("table", [variants, odd_documents])
def test_groups_equal_all_pairs(spark, table, every):
    docs = table(spark)
    want = plain_groups([(r.doc_id, r.text) for r in docs.collect()], every)
    assert found(group_spellings(docs, drop_every=every)) == want
    if table is variants:
        assert any(r[2] != r[1] and r[1] for r in want) or every


def test_query_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    want = plain_groups([(r.doc_id, r.text) for r in docs.collect()], 97)
    assert found(QUERIES["op13_spelling"](spark, SF_DIR)) == want
    assert group_spellings(docs.where("false")).collect() == []


def test_parts_are_numbered_as_one_trie():
    rng = random.Random(2)
    for _ in range(300):
        words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(2, 25))})
        whole, want = Trie(), []
        for w in words:
            whole.add(w)
            want.append(whole.nodes())
        cuts = sorted(rng.sample(range(1, len(words)), min(len(words) - 1, rng.randint(1, 4))))
        met, got = Trie(), []
        for low, high in zip([0, *cuts], [*cuts, len(words)]):
            again, alone = Trie(met.word, met.path, met.following), Trie()
            for w in words[low:high]:
                again.add(w)
                alone.add(w)
                got.append(again.nodes())
            met = follow(met, words[low], alone)
            assert (met.word, met.nodes(), met.following) == (again.word, again.nodes(), again.following)
        assert got == want
        # one number for each prefix
        nodes = {(w[:i], n) for w, path in zip(words, got) for i, n in enumerate(path)}
        assert len(nodes) == len({p for p, _ in nodes}) == len({n for _, n in nodes})


def test_nodes_in_spark(spark):
    words = spark.createDataFrame([("".join(chr(97 + d) for d in divmod(i, 26)) + "é" * (i % 3),) for i in range(600)], "word string")
    rows = in_trie_order(words.repartition(5), F.col("word"), lambda rank, nodes, row: [(rank, row[0], nodes)], "rank long, word string, nodes array<long>")
    rows = sorted(rows.collect())
    assert [r.rank for r in rows] == list(range(600)) and [r.word for r in rows] == sorted(r.word for r in rows)
    number = {}
    for r in rows:
        for i, node in enumerate(r.nodes):
            assert number.setdefault(r.word[:i], node) == node
    assert sorted(number.values()) == list(range(len(number)))
