"""Licenses, URL rules, templates and fingerprints against brute force."""

import hashlib
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemart.llm import fingerprints as fp, texts
from tidemart.llm.decontaminate import drop_leaks, find_leaks
from tidemart.llm.licenses import BASE, KNOWN, Template, scan_licenses
from tidemart.llm.queries import ORACLES, QUERIES
from tidemart.llm.texts import Words, mix, utf8
from tidemart.llm.url_rules import Rule, judge_urls
from tests.compare import connect, difference
from tests.llm.tables import odd_documents, texts_of

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def license_row(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    at = [(i, t.label) for t in BASE for i in range(len(words)) if words[i : i + len(t.words.split())] == t.words.split()]
    places = [i for i, _ in at]
    return len(words), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({n for _, n in at}))


def test_license_places(spark):
    docs = odd_documents(spark)
    got = sorted(
        (str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in scan_licenses(docs).collect()
    )
    assert got == sorted((str(i), *license_row(t)) for i, t in texts_of(docs))
    assert scan_licenses(docs.where("false")).count() == 0
    assert scan_licenses(docs, ()).agg(F.sum("n_base"), F.count("*")).first() == (0, docs.count())


def test_license_spans_survive_edits(spark):
    text = (
        "foo Permission is hereby granted, free of charge, to any nice person obtaining a copy of this software and its "
        "associated documentation files (the Software), to deal in the Software without restriction"
    )
    docs = spark.createDataFrame([(1, text), (2, "permission is hereby withheld from any person")], "doc_id int, text string")
    got = {r.doc_id: r for r in scan_licenses(docs).collect()}
    assert got[1].labels == "mit" and got[1].base_labels == "" and 0.6 <= got[1].score < 1
    assert got[2].labels == "" and got[2].score == 0
    own = scan_licenses(docs, (Template("x", "hereby withheld from", True),)).where("n_base = 1").collect()
    assert [(r.doc_id, r.first_word, r.labels) for r in own] == [(2, 2, "x")]


def plain_scan(words, template, least=0.6, shift=3):
    """Largest share of one chain of diagonals, and the exact places, of one template."""
    own, diagonals = template.words.split(), {}
    for at in range(len(own) - 2):
        for i in range(len(words) - 2):
            if words[i : i + 3] == own[at : at + 3]:
                diagonals.setdefault(i - at, set()).add(at)
    runs, chains, last = len(own) - 2, [], None
    for d in sorted(diagonals):
        if last is None or template.exact or d - last > shift:
            chains.append(set())
        chains[-1] |= diagonals[d]
        last = d
    shares = [len(c) / runs for c in chains]
    return [s for s in shares if s == 1 or (s >= least and not template.exact)]


def test_license_bodies_of_any_length(spark):
    rng, rows = random.Random(4), [(0, None), (1, "")]
    long = [t for t in KNOWN if len(t.words.split()) > 64]
    assert len(long) >= 2
    for i, t in enumerate([*KNOWN, *long, Template("x", " ".join(f"w{n % 90}" for n in range(300)))]):
        for changes in (0, 2, 9):
            words = t.words.split()
            for _ in range(changes):
                at = rng.randrange(len(words))
                words[at : at + rng.randint(0, 1)] = ["changed"] * rng.randint(0, 2)
            rows.append((len(rows), " ".join(["Some", "text."] * rng.randint(0, 3) + words).title()))
    templates = (*BASE, *KNOWN, Template("x", " ".join(f"w{n % 90}" for n in range(300))))
    got = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id int, text string"), templates).collect()}
    for key, text in rows:
        words = WORD.findall((text or "").lower())
        shares = {t: plain_scan(words, t) for t in templates}
        assert got[key].labels == ",".join(sorted({t.label for t, s in shares.items() if s}))
        assert got[key].score == pytest.approx(max((x for s in shares.values() for x in s), default=0.0))


def test_license_plan_is_native(spark):
    plan = QUERIES["op5_license_scan"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "BroadcastHashJoin" in plan


URLS = [
    (1, "http://a.Example.NET/en/x?q"), (2, "https://example.net/de/"), (3, "http://net/"), (4, "http://badnet/x"),
    (5, "ftp://x.example.com/de/y#z"), (6, "http://q.org/fr/1"), (7, "http://q.org/en/"), (8, None), (9, "no scheme"),
    (10, "http://example.net"), (11, "x://://net/"), (12, "http://example.net/en"), (12, "http://example.net/en"),
    (None, "http://net/a"), (14, "http://"), (15, "http://b.net?x=/en/"), (16, "line\nbreak://a.net/\n"),
]
RULES = (Rule("block", "net"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def url_row(url):
    scheme, sep, rest = (url or "").partition("://")
    host = re.split("[/?#]", rest)[0] if sep else ""
    path = re.split("[?#]", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return host, path, best and best.host + best.path, best.verdict if best else "allow"


def test_urls(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u in URLS], "page_id int, url string, host string")
    got = sorted(map(repr, (tuple(r) for r in judge_urls(pages, RULES).collect())))
    assert got == sorted(repr((i, *url_row(u))) for i, u in URLS)
    assert judge_urls(pages.where("false"), RULES).count() == 0
    assert {r.verdict for r in judge_urls(pages, (), default="block").collect()} == {"block"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_twins(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) is None


ITEM = "Alice has 12 apples and gives Bob 5 kg of them every Monday. How many are left after 12 days of this?"


def test_leaks(spark):
    other = ITEM.replace("12", "31").replace("5 kg", "8 lb").replace("Alice", "Zoe").replace("Bob", "Max")
    mixed = "Alice has 12 apples and gives Bob 5 kg of them every Monday. How many are left after 77 days of this?"
    rows = [
        (1, "intro text\n" + ITEM + " and more"), (2, "so " + other), (3, mixed), (4, "Nothing of this kind is here at all, no."),
        (5, ITEM.upper()), (6, None), (7, ""), (8, "12 34 56 78 90 12"), (1, "intro text\n" + ITEM + " and more"), (1, "clean text"),
    ]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, item string, at int")
    bench = spark.createDataFrame([(7, ITEM), (8, "short one"), (9, None), (7, ITEM)], "item_id long, text string")
    found = find_leaks(docs, bench).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert {(1, 7), (2, 7), (5, 7)} <= got and not {i for i, _ in got} & {4, 6, 7, 8}
    assert (3, 7) not in got  # one value of the item has become two
    kept = drop_leaks(docs, bench)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 6, 7, 8] and kept.columns == docs.columns
    assert find_leaks(docs, bench.where("false")).count() == 0 and find_leaks(docs.where("false"), bench).count() == 0


def test_leaks_of_changed_copies(spark):
    """One or two changed words, a half quote and an inserted word; a few words of an item are none."""
    rng = random.Random(4)
    item = lambda n: ["".join(rng.choice("abdefgiklmnoprstu") for _ in range(6)) for _ in range(n)]
    short, long = item(16), item(40)
    change = lambda words, *at: " ".join("other" if i in at else w for i, w in enumerate(words))
    rows = [
        (1, "so it is " + change(short, 7)), (2, change(short, 4, 11)), (3, change(long, 10, 20)), (4, "x " + " ".join(long[:20]) + " and on"),
        (5, " ".join(short[:8] + ["more"] + short[8:])), (6, "x " + " ".join(long[:8]) + " and on"), (7, " ".join(item(40))), (8, "a few words " + " ".join(short[:4])),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(short)), (2, " ".join(long))], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in find_leaks(docs, bench).collect()}
    assert got == {(1, 1), (2, 1), (3, 2), (4, 2), (5, 1)}


def test_leaks_with_other_numbers(spark):
    """Grouped, decimal and unit-suffixed numbers are one token, and a value that became two costs only its words."""
    item = "He paid 1,200 for a rope of 3.5 m that holds 5kg and is -7 cold with 12 knots for each of 12 boats"
    other = item.replace("1,200", "900").replace("3.5 m", "4 m").replace("5kg", "7 kg").replace("-7", "8").replace("12", "15")
    split = item.replace("12 boats", "77 boats")
    docs = spark.createDataFrame([(1, "so " + other), (2, split), (3, "He paid 1,200 for it")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {(r.doc_id, r.share) for r in find_leaks(docs, bench).collect()} == {(1, 1.0)}
    assert {r.doc_id for r in find_leaks(docs, bench, consistent=False).collect()} == {1, 2}
    assert [r.doc_id for r in drop_leaks(docs, bench, consistent=False).collect()] == [3]


def test_leaks_of_the_tables(spark):
    got = {(r.doc_id, r.item_id) for r in QUERIES["op2_decontamination"](spark, SF_DIR).collect()}
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert got == {(d.doc_id, b.item_id) for d in docs for b in items if b.text in (d.text or "")}


def test_fingerprints(spark):
    docs = odd_documents(spark)
    got = sorted(((r.doc_id or 0, r.n_chars, r.edited_sha256) for r in fp.fingerprint_edits(docs, ranges=3).collect()))
    rows = sorted(texts_of(docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want = []
    for i, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[i - 1][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        want.append((doc_id or 0, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert got == sorted(want)
    assert fp.fingerprint_edits(docs.where("false")).count() == 0
    one = fp.fingerprint_edits(docs.where("doc_id = 1")).first()
    assert one.near_next == 1.0 and 0.5 < one.near_edited <= 1.0


def test_fingerprints_add_up():
    paragraphs = ["first one here", "", "second paragraph, longer than others", "x"]
    prints = lambda texts: fp.pack(*fp.text_vectors(texts))
    whole, turned, less, last = prints(
        ["\n".join(paragraphs), "\n".join(reversed(paragraphs)), "\n".join(paragraphs[:3]), paragraphs[3]]
    )
    assert whole == turned != less and fp.add(less, last) == whole and fp.add(whole, last, -1) == less
    _, like = fp.text_vectors(["a b c d e f g h i j k l m n o p"] * 2)
    assert np.array_equal(fp.likeness(like[:1], like[1:]), [1.0])


def thue_morse(bits):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(1 << bits))


@pytest.mark.parametrize("bits", [10, 11, 12, 13])
def test_hashes_tell_regular_texts_apart(bits):
    one = thue_morse(bits)
    other = one.translate(str.maketrans("ab", "ba"))
    words = Words(*utf8(pa.array([one, other, one + " " + other])))
    assert words.hashes().tolist() == [*words.hashes()[:2].tolist()] * 2 and len(set(words.hashes().tolist())) == 2
    equal, _ = fp.text_vectors([one, other, one])
    assert (equal[0] == equal[2]).all() and (equal[0] != equal[1]).all()


def chained(word):
    """The hash of a word, eight bytes after the other."""
    raw, full = word.encode(), (1 << 64) - 1
    if len(raw) > texts.LONG_STRETCH:
        return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")
    h = len(raw) * int(texts._FACTOR) & full
    for i in range(0, len(raw), 8):
        h = ((h ^ int.from_bytes(raw[i : i + 8], "little")) + int(texts._FACTOR)) & full
        h = int(mix(np.array([h], np.uint64))[0])
    return h


def test_word_hashes_equal_a_plain_chain():
    rng = random.Random(9)
    for lengths in ([1, 2, 7, 8, 9, 16, 17, 64], [3, 1024, 1025, 5000, 8, 1], [2000]):
        words = ["".join(rng.choice("abcé9") for _ in range(n)) for n in lengths]
        got = Words(*utf8(pa.array([" ".join(words), None, "", words[0].upper().replace("É", "é")]))).hashes().tolist()
        assert got == [chained(w) for w in [*words, words[0]]]


def test_hosts_of_many_labels(spark):
    host = "a." * 20_000 + "example.net"
    urls = spark.createDataFrame([(1, f"http://{host}/en/x"), (2, "http://x..net/"), (3, f"http://{host}x/")], "page_id int, url string")
    rules = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "a.example.net", "/en/x")]
    start = time.perf_counter()
    got = {r.page_id: (r.rule, r.verdict) for r in judge_urls(urls, rules).collect()}
    assert got == {1: ("a.example.net/en/x", "block"), 2: ("net/", "block"), 3: (None, "allow")}
    assert time.perf_counter() - start < 30


@pytest.mark.parametrize("consistent", [True, False])
def test_items_without_a_window(spark, consistent):
    items = ["Paris forever", "Photosynthesis", "12 kg 15 m", "", None, "1 2 3 4 5 6 7", "three plain words here"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts_ = [
        "paris, FOREVER!", "Photosynthesis.", "12 kg; 15 m", "13 kg 15 m", "Paris", "forever paris", "Photosynthesis is more", "", None,
        "(1) 2 3 4 5 6 7", "1 2 3 4 5 6", "three plain words here", "... Paris ... forever ...", " ",
    ]
    docs = spark.createDataFrame(list(enumerate(texts_)), "doc_id long, text string")
    got = {(r.doc_id, r.item_id, r.share) for r in find_leaks(docs, bench, consistent=consistent).collect()}
    assert got == {(0, 0, 1.0), (1, 1, 1.0), (2, 2, 1.0), (9, 5, 1.0), (11, 6, 1.0), (12, 0, 1.0)}


def test_very_long_texts_hold_items(spark):
    rng = random.Random(12)
    item = " ".join(f"word{rng.randint(0, 10**6)}" for _ in range(30))
    filler = " ".join(f"x{rng.randint(0, 10**6)}" for _ in range(150_000))
    docs = spark.createDataFrame([(1, f"{filler} {item} {filler}"), (2, filler)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in find_leaks(docs, bench).collect()] == [(1, 7)]
    assert [r.doc_id for r in drop_leaks(docs, bench).collect()] == [2]
