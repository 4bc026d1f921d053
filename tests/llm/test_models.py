"""Quality, language, the Jaccard join and the pipeline."""

import collections
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemart.llm import jaccard, language, quality, ranges
from tidemart.llm.components import smallest_reachable
from tidemart.llm.jaccard import Lists, _overlaps, cross_links, link_components
from tidemart.llm.queries import QUERIES
from tests.llm.tables import odd_documents, texts_of

SF_DIR = "/root/testdata/sf0.001"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            both = len(a & b)
            if a and b and 100 * both >= 75 * (len(a) + len(b) - both):
                root[find(i)] = find(j)
    low = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            low[find(i)] = min(low.get(find(i), k), k)
    return [(k, len(sets[i]), low.get(find(i))) for i, (k, _) in enumerate(rows)]


def near_copies(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    rows = []
    for base in range(4):
        text = [rng.choice(vocabulary) for _ in range(rng.choice([30, 60, 120]))]
        for _ in range(n):
            copy = list(text)
            for _ in range(rng.randint(0, len(copy) // 14)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(copy + (passage if rng.random() < 0.2 else []))
    rows += [[rng.choice(vocabulary) for _ in range(50)] + passage for _ in range(n)]
    rng.shuffle(rows)
    return [(i, " ".join(r)) for i, r in enumerate(rows)]


@pytest.mark.parametrize(("block", "hot"), [(512, 50_000), (4, 4)])
def test_components(spark, monkeypatch, block, hot):
    """Small blocks and short hot lists send the work through the paths of large groups."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "HOT_LIST", hot)
    rows = near_copies(25, 5)
    got = jaccard.link_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(components(rows))


def test_components_of_odd_rows(spark):
    docs = odd_documents(spark)
    got = jaccard.link_components(docs).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = components(texts_of(docs))
    # an empty set reaches only itself
    want = [(k, n, k if n == 0 else c) for k, n, c in want]
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=key) == sorted(want, key=key)
    assert jaccard.link_components(docs.where("false")).count() == 0
    kept = jaccard.keep_one_each(docs)
    assert kept.columns == docs.columns
    # the row without a key goes if it is linked to one with a key; of the repeated row one stays
    stay = {k for k, n, c in want if k == c} - {None}
    got = collections.Counter(r.doc_id for r in kept.collect())
    assert got == collections.Counter({**dict.fromkeys(stay, 1), 9: 2, **({None: 1} if any(k is None and c is None for k, _, c in want) else {})})


def test_smallest_reachable(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, 200 + i) for i in range(50)] + [(rng.randint(300, 330), rng.randint(300, 330)) for _ in range(20)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in smallest_reachable(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for a, b in edges for i in (a, b) if a != b}


def test_sets_are_sent_again_for_large_families_only(spark, monkeypatch):
    """Sets go to their family rows at once; of the others no set is sent when one family is large."""
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rng = random.Random(6)
    base = [f"w{rng.randint(0, 10**9)}" for _ in range(60)]
    texts = [" ".join(base[:i] + [f"c{i}"] + base[i + 1 :]) for i in range(30)]  # one large family of near copies
    for _ in range(20):  # and many of two
        own = [f"v{rng.randint(0, 10**9)}" for _ in range(60)]
        texts += [" ".join(own), " ".join(own[:30] + ["x"] + own[31:])]
    asked, plain = [], jaccard.sets_of

    def seen(docs, wanted, *more):
        asked.append((set(wanted.columns), {r.k for r in wanted.select("k").collect()}))
        return plain(docs, wanted, *more)

    monkeypatch.setattr(jaccard, "sets_of", seen)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in link_components(docs).collect()}
    assert got == {i: 0 if i < 30 else i - i % 2 for i in range(len(texts))}
    assert len(asked) == 2 and "leads" in asked[0][0] and asked[0][1] >= set(range(30, 70))
    assert asked[1][1] <= set(range(30)) and asked[1][1]


def test_kneser_ney_sums_to_one(spark):
    texts = ["The old house stood at the end.", "A new house, and the old one!", "zzz 123"] * 3
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    counts = quality.gram_counts(docs)
    plain = collections.Counter()
    for t in texts:
        c = quality.CLASS_OF[np.frombuffer(t.encode(), np.uint8)].tolist()
        plain.update(tuple(c[i : i + 4]) for i in range(len(c) - 3))
    size = quality.SIZE
    assert {r.g: r.c for r in counts.collect()} == {((a * size + b) * size + c) * size + d: n for (a, b, c, d), n in plain.items()}
    table = quality.log_table(quality.smoothed(counts))
    np.testing.assert_allclose((2.0 ** -table.reshape(-1, size)).sum(1), 1, atol=1e-3)
    # one run by hand: discounted count, and the rest from the shorter run
    bits = quality.add_bits(docs.limit(1), table).first()
    codes, _ = quality.gram_codes(np.frombuffer(texts[0].encode(), np.uint8), np.array([0, len(texts[0])]))
    assert math.isclose(bits.bits, float(table[codes].sum(dtype=np.float64)), abs_tol=1e-3) and bits.bits_n == len(codes)


def plain_chances(texts):
    """Chance of the last of four characters after the others, by interpolated modified Kneser-Ney over ``texts``."""
    levels = []
    counts = collections.Counter(t[i : i + 4] for t in texts for i in range(len(t) - 3))
    for _ in range(4):
        taken = quality.discounts(*[sum(c == i for c in counts.values()) for i in (1, 2, 3, 4)])
        total, left = collections.Counter(), collections.Counter()
        for g, c in counts.items():
            total[g[:-1]] += c
            left[g[:-1]] += taken[min(c, 3) - 1]
        levels.append((counts, taken, total, left))
        counts = collections.Counter(g[1:] for g in counts)

    def chance(run):
        if not run:
            return 1 / 0x110000
        counts, taken, total, left = levels[4 - len(run)]
        h, c = run[:-1], counts[run]
        if not total[h]:
            return chance(run[1:])
        return (c - taken[min(c, 3) - 1] if c else 0) / total[h] + left[h] / total[h] * chance(run[1:])

    return chance


def test_quality_equals_plain_character_model(spark, monkeypatch):
    """Runs of real characters, joined with the terms: letters of one class differ, in blocks of any size."""
    monkeypatch.setattr(quality, "BLOCK_BYTES", 300)
    rng = random.Random(3)
    some = ["привет мир", "ПРИВЕТ МИР", "the house", "THE HOUSE", "中文字符 😀", "a\x00b,c.d"]
    texts = [" ".join(rng.choice(some) for _ in range(rng.randint(1, 9))) for _ in range(40)] + ["abc", "", None, "τὰ πάντα ῥεῖ"]
    rows = [(i if i != 7 else None, "xy"[i % 2] if i % 5 else None, t) for i, t in enumerate(texts)] + [(3, "y", texts[3])] * 2
    docs = spark.createDataFrame(rows, "k long, l string, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 30, 2)] + [(30, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    fold = {r.text: r.f for r in docs.select("text", (F.pmod(F.xxhash64("text"), F.lit(quality.FOLDS)) + 1).alias("f")).collect()}
    trusted = [t for k, _, t in rows if k is not None and k < 30 and k % 2 == 0]
    models = [plain_chances([t for t in trusted if fold[t] != m]) for m in range(quality.FOLDS + 1)]

    def bits(t, m):
        return -sum(math.log2(models[m](t[i : i + 4])) for i in range(len(t) - 3))

    want = sorted((str(k), str(lang), t, len(t) - 3) for k, lang, t in rows if t and len(t) > 3)
    text = {r.t: r.text for r in docs.select("text", F.xxhash64("text").alias("t")).collect()}
    got = quality.run_scores(docs, labels).collect()
    assert sorted((str(r.k), str(r.l), text[r.t], int(r.bits_n)) for r in got) == want
    for r in got:
        t = text[r.t]
        assert math.isclose(r.bits, bits(t, 0), abs_tol=1e-3) and math.isclose(r.bits_out, bits(t, fold[t]), abs_tol=1e-3)
    # Cyrillic letters fell into two classes of bytes and could not be told apart
    assert bits("привет мир", 0) < 0.5 * bits("рпивте мри", 0)


def test_keys_of_wide_rows():
    """Numbers stay exact where the columns have too many values for one product."""
    rng = np.random.default_rng(4)
    columns = [rng.integers(0, 0x110000, 30_000) for _ in range(5)]
    columns = [np.concatenate([c, c[:100]]) for c in columns]
    found, n = quality.distinct_rows(columns)
    plain = collections.Counter(zip(*[c.tolist() for c in columns]))
    assert dict(zip(zip(*[c.tolist() for c in found]), n.tolist())) == plain
    keys = quality.Keys(columns)
    assert any(r is not None for r in keys.ranks) and (keys.of([c[50:70] for c in columns]) == keys.met[50:70]).all()


def test_files_of_the_model(spark, monkeypatch):
    """The terms of all orders are written by as many tasks as those of one."""
    files = {}

    def counted(rows, name):
        out = ranges.stored(rows, name)
        files[name] = len(out.inputFiles())
        return out

    monkeypatch.setattr(quality, "stored", counted)
    docs = spark.createDataFrame([(i, "x", f"some text {i} of ours") for i in range(40)], "k long, l string, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    assert quality.run_scores(docs, labels).count() == 40
    assert files["model"] <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_memory_of_gathered_runs(monkeypatch):
    """What a task holds for each run does not follow the length of its texts, and no run is lost between slices."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnop", k=5)) for _ in range(300)]
    texts = [" ".join(rng.choices(words, k=350_000)) for _ in range(2)]
    slices = [(pa.array([t]), np.array([i])) for i, t in enumerate(texts)]
    tracemalloc.start()
    parts = list(quality._gathered(iter(slices)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6  # bytes; 178 MB before
    few = [(pa.array([t[:5_000], None, "abc", t[:9]]), np.array([i, i, 7, 8])) for i, t in enumerate(texts)]
    want = collections.Counter((g, t[i : i + 4]) for a, group in few for t, g in zip(a.to_pylist(), group.tolist()) for i in range(len(t or "") - 3))
    for at_once, held in ((1 << 18, 1_000_000), (7, 100)):
        monkeypatch.setattr(quality, "RUNS_AT_ONCE", at_once)
        monkeypatch.setattr(quality, "HELD_RUNS", held)
        got = collections.Counter()
        for rows, n in quality._gathered(iter(few)):
            for g, run, c in zip(rows[0].tolist(), quality.run_texts(rows[1:]).to_pylist(), n.tolist()):
                got[g, run] += c
        assert got == want
    assert sum(int(n.sum()) for _, n in parts) == sum(len(t) - 3 for t in texts)


def test_quality(spark):
    judged = {r.doc_id: r for r in QUERIES["op7_quality"](spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    good = [judged[r.doc_id].kept for r in labels if r.quality == 1 and r.toxic == 0]
    bad = [judged[r.doc_id].kept for r in labels if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.2 * len(bad)


def test_quality_of_rare_languages(spark):
    """A language with few trusted rows, one with none and a missing one are not judged by the others' limit."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    rows = labels.collect()
    clean = {r.doc_id for r in rows if r.quality == 1 and r.toxic == 0}
    junk = {r.doc_id for r in rows if r.quality == 0} - clean
    some = set(sorted(k for k in clean if lang[k] == "fr")[:10])
    gone = [k for k in clean if lang[k] in ("es", "de") or lang[k] == "fr" and k not in some]
    docs = docs.withColumn("lang", F.when(F.col("lang") != "de", F.col("lang")))
    judged = {r.doc_id: r for r in quality.judge_quality(docs, labels.where(~F.col("doc_id").isin(gone))).collect()}
    for name in ("fr", "es", "de"):
        assert sum(judged[k].kept for k in clean if lang[k] == name) >= 0.97 * sum(lang[k] == name for k in clean), name
    for name in ("fr", "es"):
        assert sum(judged[k].kept for k in junk if lang[k] == name) <= 0.5 * sum(lang[k] == name for k in junk), name


def test_quality_of_odd_rows(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (6, 1, 0), (6, 1, 0), (8, None, None), (None, 1, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    judged = quality.judge_quality(docs, labels, prefix="_q_")
    assert judged.columns[: len(docs.columns)] == docs.columns and judged.count() == docs.count()
    assert all(r["_q_kept"] for r in judged.where("text IS NULL OR text = ''").collect())
    none = quality.judge_quality(docs, labels.where("false"), prefix="_q_")
    assert none.where("_q_kept").count() == docs.count()
    assert quality.judge_quality(docs.where("false"), labels, prefix="_q_").count() == 0


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    got = QUERIES["op8_language"](spark, "/root/testdata/sf0.01").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert sum(r.accepted for r in got) >= 0.97 * len(got)


@pytest.mark.parametrize("out", ["en", "de", "es", "fr"])
def test_language_left_out(spark, out):
    """A language that was not learned is rejected, and the learned ones are not."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    model = language.fit_centroids(docs.where(~language.is_held_out(F.col("doc_id"))), F.col("lang") != out)
    foreign = "Suomen kesä on lyhyt mutta valoisa, ja ihmiset viettävät paljon aikaa mökillä järven rannalla."
    rows = docs.unionByName(spark.createDataFrame([(-1, "fi", foreign)], "doc_id long, lang string, text string"))
    rows = rows.where(language.is_held_out(F.col("doc_id")) | F.col("lang").isin(out, "fi"))
    got = language.predict_language(rows, model).collect()
    strange = [r.accepted for r in got if r.lang == out]
    own = [r.accepted for r in got if r.lang not in (out, "fi")]
    assert sum(strange) <= 0.1 * len(strange) and sum(own) >= 0.95 * len(own)
    assert not any(r.accepted for r in got if r.lang == "fi")


def test_language_of_odd_rows(spark):
    docs = odd_documents(spark)
    model = language.fit_centroids(docs, F.lit(True))
    found = language.predict_language(docs, model, prefix="_l_")
    got = {(r.doc_id, r.text): r["_l_lang_pred"] for r in found.collect()}
    assert found.count() == docs.count() and found.columns[: len(docs.columns)] == docs.columns
    for (_, text), lang in got.items():
        assert (lang == "und") == (not any(c.isalpha() for c in text or ""))
    nothing = language.predict_language(docs, language.fit_centroids(docs.where("false"), F.lit(True)), prefix="_l_")
    assert {r[0] for r in nothing.select("_l_lang_pred").collect()} == {"und"}


def test_counts_of_runs():
    data, offsets = language.utf8(pa.array(["ab a", None, "1 2", "B"]))
    c = language.counts(data, offsets)
    assert c.sum(1).tolist() == [12, 0, 0, 1] or (c.sum(1) > 0).tolist() == [True, False, False, True]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == columns, name
        kept = kept.cache()
        assert kept.join(docs, "doc_id", "left_anti").count() == 0, name
        docs = kept
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    left = docs.collect()
    assert not any(b in (r.text or "") for r in left for b in items)
    rows = [(r.doc_id, r.text) for r in left]
    assert all(k == c or n == 0 for k, n, c in components(rows))
    done = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(r.doc_id for r in done.collect()) == sorted(r.doc_id for r in left)


def test_list_entries_of_other_sizes_are_skipped():
    rng = np.random.default_rng(3)
    common = np.arange(3, dtype=np.uint64)
    base = rng.integers(10, 1 << 40, 400, dtype=np.uint64)
    sets = []
    for _ in range(300):
        n = int(rng.integers(10, 3000))
        own = rng.integers(1 << 41, 1 << 60, n, dtype=np.uint64) if rng.random() < 0.6 else base[: n % 400 + 5]
        sets.append(np.unique(np.concatenate([common, own])))
    sets.sort(key=len)
    lists, fitting = Lists(sets), 0
    sizes = [len(s) for s in sets]
    for i, overlap, lo in _overlaps(lists):
        for j, got in enumerate(overlap.tolist(), lo):
            assert got == len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        hi = lo + len(overlap)
        assert all(4 * sizes[i] < 3 * sizes[j] for j in range(hi, len(sets)))
        fitting += int(overlap.sum())
    assert lists.touched <= 1.2 * fitting
    left, right = sets[::2], sets[1::2]
    want = {(i, j) for i, a in enumerate(left) for j, b in enumerate(right)
            if 4 * len(np.intersect1d(a, b)) >= 3 * len(np.union1d(a, b))}
    got = cross_links(left, right)
    assert len(got) == len(set(got)) and set(got) == want and want


def test_regular_texts_do_not_link(spark):
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, one), (2, other), (3, one + " x"), (4, other)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in link_components(docs).collect()} == {1: 1, 2: 2, 3: 3, 4: 2}
