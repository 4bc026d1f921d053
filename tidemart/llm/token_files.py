"""Token ids as flat unsigned integer files with 64-bit document offsets.

A data set is a folder of parts in ascending key order. Part i has three files:
``part-i.bin`` holds the ids of its documents, one after the other, as unsigned
little-endian integers of two or four bytes; ``part-i.idx`` holds n + 1 unsigned
64-bit offsets (in ids) of its n documents; ``part-i.key`` holds their keys as
64-bit integers. A part's base, the number of ids before it, is the prefix sum of
the part lengths; it is kept in the table of parts, so no part waits for another.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.ranges import bucket_of, cut_points, default_ranges, order_key, whole_key
from tidemart.llm.texts import kept_in_worker, pieces_of

CACHE_ENTRIES = 400_000
CACHE_LONGEST = 48
BATCH = 4_000
# Only blanks that both the tokenizer and this pattern take as white space may cut a text.
LATIN = "A-Za-zÀ-ÖØ-öø-įı-ɏ"  # without the one letter that is lower-cased to a letter and a mark
SIGNS = r"!-&(-/:-@\[-`{-~"
BLANKS = r" \n\t\r"
CHUNK = re.compile(f"[^{BLANKS}]+")
# A run of Latin letters ends before a sign or a blank, a run of signs before a letter or a blank; else the rest up to
# the blank stays together. The apostrophe is no such sign, as the tokenizer joins it with what follows.
LATIN_RUN = re.compile(f"[{LATIN}]+")
FINE_CHUNK = re.compile(f"[{LATIN}]+(?=['{SIGNS}{BLANKS}]|$)|[{SIGNS}]+(?=[{LATIN}{BLANKS}]|$)|[^{BLANKS}]+")
PARTS = "part int, n_docs long, n_tokens long, path string"


class ChunkEncoder:
    """Ids of whole texts, through a bounded memory of their chunks.

    ``cuts`` says what the tokenizer allows: ``letters`` if neither its
    normaliser nor its split joins signs over a blank or over the border between
    Latin letters and ASCII signs, ``blanks`` if only the first holds, else whole
    texts are encoded. Texts that may hold a special token are cut at blanks.
    """

    def __init__(self, path: str, dtype: str, cuts: str = "letters"):
        from tokenizers import Tokenizer

        # a worker has one core; the library's own threads would only add memory
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.dtype, self.cuts = np.dtype(dtype), cuts
        self.lower = '"Lowercase"' in str(json.loads(self.tokenizer.to_str())["normalizer"]).replace("'", '"')
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = Remembered(CACHE_ENTRIES)
        # a suffix that marks the last piece of each word lets words be encoded in one row
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix") or ""
        self.ends = None
        if suffix and cuts == "letters":
            self.ends = np.zeros(1 << 8 * self.dtype.itemsize if self.dtype.itemsize < 4 else self.tokenizer.get_vocab_size(), bool)
            self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True

    def raw(self, texts: list[str]) -> list[bytes]:
        out = []
        for start in range(0, len(texts), BATCH):
            found = self.tokenizer.encode_batch_fast(texts[start : start + BATCH], add_special_tokens=False)
            out += [np.array(e.ids, self.dtype).tobytes() for e in found]
        return out

    def words(self, words: list[str]) -> list[bytes]:
        """Runs of Latin letters, a hundred in a row, told apart by their last pieces."""
        rows = [words[i : i + 100] for i in range(0, len(words), 100)]
        out: list[bytes] = []
        for row, raw in zip(rows, self.raw([" ".join(r) for r in rows])):
            cuts = (np.flatnonzero(self.ends[np.frombuffer(raw, self.dtype)]) + 1) * self.dtype.itemsize
            if len(cuts) != len(row):
                out += self.raw(row)
                continue
            out += [raw[a:b] for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist())]
        return out

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        if self.ends is None:
            return self.raw(chunks)
        # the case of Latin letters makes no difference to a tokenizer that lower-cases them
        words = {c: c.lower() if self.lower else c for c in chunks if LATIN_RUN.fullmatch(c)}
        distinct = list(set(words.values()))
        ids = dict(zip(distinct, self.words(distinct)))
        rest = [c for c in chunks if c not in words]
        other = dict(zip(rest, self.raw(rest)))
        return [ids[words[c]] if c in words else other[c] for c in chunks]

    def split(self, text: str | None) -> list[str]:
        if not text:
            return []
        fine = self.cuts == "letters" and not any(s in text for s in self.special)
        return (FINE_CHUNK if fine else CHUNK).findall(text)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if self.cuts not in ("letters", "blanks"):
            return self.raw([t or "" for t in texts])
        chunks = [self.split(t) for t in texts]
        self.known.add(set(itertools.chain.from_iterable(chunks)), self.encode_chunks)
        return [self.known.joined(c) for c in chunks]


class Remembered:
    """Ids of chunks, in two generations: a full one replaces the one before."""

    def __init__(self, entries: int):
        self.entries = entries
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.long: dict[str, bytes] = {}

    def add(self, chunks: set[str], encode) -> None:
        """Make all ``chunks`` known until the next call."""
        self.long = {}
        if len(self.known) > self.entries:
            self.before, self.known = self.known, {}
        known, before, new = self.known, self.before, []
        for chunk in chunks.difference(known):
            ids = before.get(chunk)
            if ids is None:
                new.append(chunk)
            else:
                known[chunk] = ids
        for chunk, ids in zip(new, encode(new)):
            (known if len(chunk) <= CACHE_LONGEST else self.long)[chunk] = ids

    def joined(self, chunks: list[str]) -> bytes:
        if not self.long:
            return b"".join(map(self.known.__getitem__, chunks))
        return b"".join([self.known[c] if c in self.known else self.long[c] for c in chunks])


def chunk_encoder(*how) -> ChunkEncoder:
    """One encoder for each worker process, with what it remembers."""
    encoders = kept_in_worker("encoders")
    if how not in encoders:
        encoders[how] = ChunkEncoder(*how)
    return encoders[how]


def token_dtype(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the file system that Spark itself writes it to."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(found).toString()


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The store of a path: an URI names it, a plain path is the shared folder's."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return pafs.LocalFileSystem(), path


def _join(rows: Iterator[tuple[int, bytes]], path: str, part: int, width: int) -> tuple[int, int]:
    """Write one part under names of this attempt, then give them their own; a repeated attempt replaces itself."""
    store, root = filesystem(path)
    attempt = uuid.uuid4().hex
    keys, offsets, total = [], [0], 0
    with store.open_output_stream(f"{root}/.{attempt}.bin") as out:
        for key, ids in rows:
            out.write(ids)
            total += len(ids) // width
            keys.append(key)
            offsets.append(total)
    for name, values in (("idx", np.array(offsets, "<u8")), ("key", np.array(keys, "<i8"))):
        with store.open_output_stream(f"{root}/.{attempt}.{name}") as out:
            out.write(values.tobytes())
    for name in ("bin", "idx", "key"):
        store.move(f"{root}/.{attempt}.{name}", f"{root}/part-{part:06d}.{name}")
    return len(keys), total


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int | None = None,
    key: str = "doc_id",
    text: str = "text",
    parts: int | None = None,
    cuts: str = "letters",
) -> DataFrame:
    """Encode every text and write the parts below ``path``; returns the table of parts with their bases.

    The key is cut into ``parts`` ranges (default: the session's shuffle
    partitions) by approximate quantiles of the key alone. One exchange brings a
    range together, sorted by key and text; its task encodes and appends row by
    row, so that memory holds one slice of texts. Rows of a null key come first,
    and the smallest long stands for it in the files. A null or empty text has no ids but the end
    id. Repeated rows are written as often as they come. An empty table writes no
    part. Other columns are not read.
    """
    from tokenizers import Tokenizer

    dtype = token_dtype(max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), (end_id or 0) + 1))
    width = np.dtype(dtype).itemsize
    end = b"" if end_id is None else np.array([end_id], dtype).tobytes()
    path = qualified(docs.sparkSession, path)
    store, root = filesystem(path)
    store.create_dir(root, recursive=True)
    parts = parts or default_ranges(docs)
    bounds = cut_points(docs, key, parts)
    rows = docs.select(order_key(key).alias("k"), F.col(text).alias("text"))
    rows = rows.withColumn("part", bucket_of(F.col("k"), bounds))
    rows = rows.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "k", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(tokenizer_path, dtype, cuts)

        def stream():
            for batch in batches:
                for piece in pieces_of(batch, "text"):
                    ids = encoder.encode(piece.column("text").to_pylist())
                    yield from zip(piece.column("part").to_pylist(), piece.column("k").to_pylist(), ids)

        for part, own in itertools.groupby(stream(), key=lambda r: r[0]):
            n, total = _join(((k, ids + end) for _, k, ids in own), path, part, width)
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "n_docs": [n], "n_tokens": [total], "path": [path]}
            )

    written = rows.mapInArrow(write, PARTS)
    # one small row per part, whatever the number of documents
    lengths = sorted(written.collect())
    bases = [0, *itertools.accumulate(r.n_tokens for r in lengths)]
    table = [(r.part, r.n_docs, r.n_tokens, r.path, base, dtype) for r, base in zip(lengths, bases)]
    return docs.sparkSession.createDataFrame(table, PARTS + ", base long, dtype string")


class TokenPart:
    """One part, mapped into memory where the store is a folder, read otherwise."""

    def __init__(self, path: str, part: int, dtype: str):
        self.store, self.root = filesystem(path)
        name = f"{self.root}/part-{part:06d}"
        self.ids = self._map(f"{name}.bin", dtype)
        self.offsets = self._map(f"{name}.idx", "<u8")
        self.keys = self._map(f"{name}.key", "<i8")

    def _map(self, name: str, dtype: str) -> np.ndarray:
        if isinstance(self.store, pafs.LocalFileSystem):
            size = self.store.get_file_info(name).size
            return np.memmap(name, dtype, "r") if size else np.zeros(0, dtype)
        with self.store.open_input_file(name) as f:
            return np.frombuffer(f.read(), dtype)

    def __len__(self) -> int:
        return len(self.keys)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.ids[int(self.offsets[i]) : int(self.offsets[i + 1])]


def read_token_files(parts: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document of the written files: key, start, n_tokens and the crc32 of its ids as 32-bit integers.

    One task for each part, mapped into memory and read in slices of documents. Null
    keys come back as null, repeated rows as often as they were written, texts without
    ids with the end id alone or with none. A table of no parts gives an empty result.
    """
    n = max(1, parts.count())

    def read(batches):
        for batch in batches:
            for r in batch.to_pylist():
                part = TokenPart(r["path"], r["part"], r["dtype"])
                for low in range(0, len(part), 4096):
                    at = part.offsets[low : low + 4097].astype(np.int64)
                    crc = [
                        zlib.crc32(part.ids[a:b].astype("<u4").tobytes()) for a, b in zip(at[:-1].tolist(), at[1:].tolist())
                    ]
                    yield pa.RecordBatch.from_pydict(
                        {
                            key: whole_key(pa.array(np.array(part.keys[low : low + 4096]))),
                            "start": at[:-1] + r["base"],
                            "n_tokens": np.diff(at),
                            "ids_crc32": pa.array(crc, pa.int64()),
                        }
                    )

    spread = parts.repartition(n)
    return spread.mapInArrow(read, f"{key} long, start long, n_tokens long, ids_crc32 long")
