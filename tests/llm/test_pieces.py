"""Pieces, token counts and token files against the tokenizers themselves."""

import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from tidemart.llm.pieces import PieceModel, encode_pieces
from tidemart.llm.ranges import bucket_of, cut_points
from tidemart.llm.token_counts import UnigramCounter, count_tokens, vocabulary
from tidemart.llm.token_files import ChunkEncoder, TokenPart, qualified, read_token_files, write_token_files
from tests.llm.tables import odd_documents, texts_of

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SCRAPS = [
    "a", "B", "th", "e", " ", "  ", "▁", "\n", "\t", "é", "ß", "😀", "<s>", "<0x0A>", "in", "tion", "\x00", "中", "Ω", "İ",
    "    ", "qqqq", "...", "1", "23", "É", "</s>", "'s", "'ll", "<|endoftext|>", "\u0301", "\u0338", "<", "Σ", "\x1c", "\u3000",
    "²", "×", "_", "-", "!!", "|", "word", "д",
]


def scraps(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(SCRAPS) for _ in range(rng.randint(0, 20))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_pieces_equal_the_library(library):
    model = PieceModel(PIECES)
    for text in [*scraps(3000, 1), "x" * 5000, "ab" * 3000, " " * 999]:
        ids = model.encode(text).tolist()
        assert ids == library.encode(text), repr(text)
        assert model.decode(ids) == library.decode(ids), repr(text)


def test_any_ids_decode_as_in_the_library(library):
    model, rng = PieceModel(PIECES), random.Random(2)
    for _ in range(2000):
        ids = [rng.choice([rng.randint(3, 258), rng.randint(0, 31_999)]) for _ in range(rng.randint(0, 8))]
        assert model.decode(ids) == library.decode(ids), ids


def test_pieces_query(spark, library):
    docs = odd_documents(spark)
    got = encode_pieces(docs, PIECES).collect()
    want = []
    for doc_id, text in texts_of(docs):
        ids = library.encode(text or "")
        back = library.decode(ids) if ids else ""
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), back)]
        want.append((doc_id, len(ids), *sha, ids, back))
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_counts_equal_the_unigram_tokenizer(spark):
    pieces = vocabulary(PIECES)
    known, counter = {p for p, _ in pieces}, UnigramCounter(pieces)
    plain = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], unk_id=0, byte_fallback=False))

    def count(text):
        return sum(1 if t in known else len(t.encode()) for t in plain.encode("▁" + text.replace(" ", "▁")).tokens)

    for text in filter(None, scraps(1500, 3)):
        assert counter.measure(text)[1] == count(text), repr(text)
    docs = odd_documents(spark)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in count_tokens(docs, PIECES).collect())
    assert got == sorted((i is None, i or 0, count(t) if t else 0) for i, t in texts_of(docs))


def test_ties_take_the_longer_last_piece():
    counter = UnigramCounter([("▁", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁ab", -2.0)])
    assert counter.measure("ab") == (-2.0, 1)
    assert UnigramCounter([("▁", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0)]).measure("ab") == (-2.0, 2)


def test_chunks_equal_whole_texts():
    whole, cut = Tokenizer.from_file(WORDS), ChunkEncoder(WORDS, "<u2")
    for text in scraps(4000, 4):
        ids = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(cut.encode([text])[0], "<u2").tolist() == ids, repr(text)


def test_token_files(spark, tmp_path):
    docs = odd_documents(spark)
    tokenizer = Tokenizer.from_file(WORDS)
    parts = write_token_files(docs, f"file://{tmp_path}/t", WORDS, end_id=1, parts=3)
    got = sorted(map(tuple, read_token_files(parts).collect()), key=lambda r: r[1])
    start, want = 0, []
    for doc_id, text in sorted(texts_of(docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    assert got == want
    rows = sorted(parts.collect())
    assert [r.base for r in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(len(rows))]
    first = TokenPart(rows[0].path, rows[0].part, rows[0].dtype)
    assert isinstance(first.ids, np.memmap) and len(first) == rows[0].n_docs and first[0][-1] == 1


def test_empty_tables(spark, tmp_path):
    none = odd_documents(spark).where(F.lit(False))
    assert encode_pieces(none, PIECES).count() == 0
    assert count_tokens(none, PIECES).count() == 0
    assert read_token_files(write_token_files(none, str(tmp_path / "e"), WORDS, end_id=1)).count() == 0


def test_ranges_follow_their_number(spark):
    rows = spark.range(60_000).selectExpr("cast(id * 7 % 60000 AS long) AS k")
    for n in (2, 7, 100, 600):
        cuts = cut_points(rows, "k", n)
        assert len(cuts) == n - 1
        placed = rows.select(bucket_of(F.col("k"), cuts).alias("b")).groupBy("b").count().collect()
        assert len(placed) == n == len(cuts) + 1
        assert max(r["count"] for r in placed) <= 1.3 * 60_000 / n
    values = [-5, 0, 3, 4, 9, 10, 11, None]
    some = spark.createDataFrame([(v,) for v in values], "k long")
    for cuts in ([], [3], [0, 3, 9, 10], list(range(-4, 12))):
        got = [r.b for r in some.select(bucket_of(F.coalesce("k", F.lit(-(1 << 63))), cuts).alias("b")).collect()]
        assert got == [sum(c < (-(1 << 63) if v is None else v) for c in cuts) for v in values]


def test_plain_paths_get_the_default_file_system(spark, tmp_path):
    assert qualified(spark, str(tmp_path)).startswith("file:/")
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(5)], "doc_id long, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    parts = write_token_files(docs, str(tmp_path / "t"), path, parts=2)
    assert {r.path for r in parts.collect()} == {qualified(spark, str(tmp_path / "t"))}
    assert read_token_files(parts).count() == 5
