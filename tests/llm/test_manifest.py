"""The manifest against a plain recursive tree in memory."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemart.llm.manifest import manifest_roots, prove_rows
from tidemart.llm.queries import QUERIES
from tests.llm.tables import odd_documents

SF_DIR = "/root/testdata/sf0.001"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(digests):
    """The root, and per digest its (left, right) siblings from the bottom up."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        runs = [digests[i : i + 16] for i in range(0, len(digests), 16)]
        for k, i in enumerate(at):
            run = runs[i // 16]
            paths[k].append(("".join(run[: i % 16]), "".join(run[i % 16 + 1 :])))
            at[k] = i // 16
        digests = [sha("".join(r)) for r in runs]
    return digests[0], paths


def plain_proofs(rows, change):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0] is not None, r[0] or 0, leaf(r), leaf((*r[:4], change(r))), r[0]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    root, upper = tree([trees[g][0] for g in names])
    out = []
    for g, above in zip(names, upper):
        for x, path in zip(sorted(groups[g], key=lambda x: x[:3]), trees[g][1]):
            folded = x[3]
            for left, right in path + above:
                folded = sha(left + folded + right)
            proof = sha("".join(a + b for a, b in path + above))
            out.append((x[4], x[2], trees[g][0], root, proof, folded, folded == root))
    return sorted(out, key=str), {g: (len(groups[g]), trees[g][0], root) for g in names}


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def tampered(r):
    hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
    return lower(r[4]) if hit else r[4]


def copy_of():
    changed = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    abc = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return {"text": F.when(changed, F.translate(F.col("text"), abc, abc.lower())).otherwise(F.col("text"))}


def made(spark, sizes):
    rng = random.Random(4)
    rows, key = [], 0
    for name, n in sizes.items():
        for _ in range(n):
            key += 1
            text = rng.choice(["Text", "ÄB c", "", None, "low"])
            rows.append((key * 7 % 100_003, name, rng.choice(["en", None]), key % 5, text and text + str(key % 3)))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)


SIZES = {
    "one": {"a": 1},
    "lone leaves": {"a": 1, "b": 1, None: 1},
    "bounds": {"a": 15, "b": 16, "c": 17, "é": 255, "z": 256, "Z": 257, None: 40, "": 2},
    "many groups": {f"s{i}": 1 + i % 3 for i in range(300)},
    "hot": {"hot": 4500, "x": 3},
}


CASES = [(s, 3) for s in SIZES] + [("bounds", 1), ("hot", 2)]


@pytest.mark.parametrize("sizes,levels", CASES)
def test_proofs_equal_a_plain_tree(spark, sizes, levels):
    docs = made(spark, SIZES[sizes])
    want, roots = plain_proofs([tuple(r) for r in docs.collect()], tampered)
    got = prove_rows(docs, copy=copy_of(), levels=levels)
    assert sorted([tuple(r) for r in got.collect()], key=str) == want
    if levels == 3:
        assert {r.source: (r.leaves, r.subroot, r.root) for r in manifest_roots(docs).collect()} == roots


def test_odd_rows_and_kept_proofs(spark):
    docs = odd_documents(spark).withColumn("n_chars", F.length("text").cast("long")).withColumn("g", F.lit(1)).withColumn("pos", F.lit(1))
    want, _ = plain_proofs([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()], tampered)
    got = prove_rows(docs, copy=copy_of(), keep_proofs=True).collect()
    assert sorted([tuple(r)[:7] for r in got], key=str) == want
    for r in got:
        assert sha("".join(p.left + p.right for p in r.proof)) == r.proof_sha256
    assert prove_rows(docs.where("false")).collect() == manifest_roots(docs.where("false")).collect() == []


def test_query_equals_a_plain_tree(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select(*FIELDS)
    want, _ = plain_proofs([tuple(r) for r in docs.collect()], tampered)
    got = QUERIES["op11_manifest"](spark, SF_DIR)
    assert sorted([tuple(r) for r in got.collect()], key=str) == want
    assert 0 < got.where("not verified").count() < got.count() / 3
