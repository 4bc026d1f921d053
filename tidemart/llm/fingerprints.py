"""Order-independent document fingerprints that add and subtract.

A paragraph is hashed to a wide vector; a document's fingerprint is the sum of
its paragraphs' vectors, lane by lane. The first lanes are uniform 64-bit values
of the whole paragraph modulo 2^64: equal sums mean the same paragraphs, in any
order. The other lanes hold, modulo 2^32, signed counts of the paragraph's byte
runs, so that the cosine of two fingerprints follows the text they share.
Paragraphs are put in or taken out by adding or subtracting their vectors.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.ranges import bucket_of, cut_points, default_ranges, order_key, whole_key
from tidemart.llm.texts import _BYTE_HASH, _power, mix, pieces_of, utf8

EQUAL_LANES = 8
LIKE_LANES = 128
RUN = 9


def vectors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row: EQUAL_LANES sums modulo 2^64, and LIKE_LANES sums modulo 2^32."""
    rows, n = len(offsets) - 1, len(data)
    breaks = np.flatnonzero(data == 10)
    # paragraphs lie between row bounds and line ends; a row has one at least, maybe empty
    row_of_break = np.searchsorted(offsets, breaks, "right") - 1
    starts = np.concatenate([offsets[:-1], breaks + 1])
    ends_row = np.concatenate([np.arange(rows), row_of_break])
    order = np.lexsort((starts, ends_row))
    starts, row = starts[order], ends_row[order]
    stops = np.concatenate([starts[1:] - 1, [n]])
    last = np.concatenate([row[1:] != row[:-1], [True]])
    stops[last] = offsets[1:][row[last]]
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_HASH[data] * _power(max(n, 1), False)[:n], out=total[1:])
    undo = _power(n + 1, True)

    # the lanes are eight separate parts of a 512-bit digest
    view = memoryview(np.ascontiguousarray(data))
    digests = b"".join([blake2b(view[a:b]).digest() for a, b in zip(starts.tolist(), stops.tolist())])
    per_row = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))])
    sums = np.zeros((len(row) + 1, EQUAL_LANES), np.uint64)
    np.cumsum(np.frombuffer(digests, "<u8").reshape(-1, EQUAL_LANES), axis=0, out=sums[1:])
    equal = sums[per_row[1:]] - sums[per_row[:-1]]

    # runs of RUN bytes inside a paragraph; a shorter paragraph is one run
    lengths = stops - starts
    full = np.zeros(n + 1, bool)
    long = lengths >= RUN
    marks = np.zeros(n + 2, np.int32)
    np.add.at(marks, starts[long], 1)
    np.add.at(marks, stops[long] - RUN + 1, -1)
    full = np.cumsum(marks[: n + 1]) > 0
    at = np.flatnonzero(full)
    short = (lengths > 0) & ~long
    h = np.concatenate([(total[at + RUN] - total[at]) * undo[at], (total[stops[short]] - total[starts[short]]) * undo[starts[short]]])
    h = mix(h)
    of = np.concatenate([np.searchsorted(offsets, at, "right") - 1, row[short]])
    lane = (h & np.uint64(LIKE_LANES - 1)).astype(np.int64)
    sign = ((h >> np.uint64(40)) & np.uint64(1)).astype(np.float64) * 2 - 1
    like = np.bincount(of * LIKE_LANES + lane, sign, rows * LIKE_LANES)
    return equal, like.astype(np.int64).astype(np.int32).reshape(rows, LIKE_LANES)


def text_vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return vectors(*utf8(pa.array(texts, pa.large_string())))


def pack(equal: np.ndarray, like: np.ndarray) -> list[str]:
    """Fingerprints as text, base 64 of the lanes in little-endian order."""
    raw = [a.tobytes() + b.tobytes() for a, b in zip(equal.astype("<u8"), like.astype("<i4"))]
    return [base64.b64encode(r).decode() for r in raw]


def unpack(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    raw = base64.b64decode(fingerprint)
    return np.frombuffer(raw, "<u8", EQUAL_LANES), np.frombuffer(raw, "<i4", LIKE_LANES, EQUAL_LANES * 8)


def add(a: str, b: str, sign: int = 1) -> str:
    """The fingerprint of both paragraph sets together, or with ``sign=-1`` of ``a`` without ``b``."""
    (ea, la), (eb, lb) = unpack(a), unpack(b)
    equal = ea + eb if sign > 0 else ea - eb
    like = (la.astype(np.int64) + sign * lb.astype(np.int64)).astype(np.int32)
    return pack(equal[None], like[None])[0]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of the likeness lanes, row by row, cut to 0..1; equal vectors give 1."""
    x, y = a.astype(np.float64), b.astype(np.float64)
    size = np.sqrt((x * x).sum(1) * (y * y).sum(1))
    cosine = np.divide((x * y).sum(1), size, out=np.zeros(len(x)), where=size > 0)
    return np.where((a == b).all(1), 1.0, np.clip(cosine, 0.0, 1.0))


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """Per document: fingerprints of its text and of its edited text, and their likeness.

    The edited text has the last third of the code points replaced by the first
    as many of the next document in descending key order; after the last comes
    the first. The key is cut into ranges of about equal counts; a range is
    sorted in one task that keeps only the row before. The last row of a range
    is also sent to the following one, so that each range is complete. One
    exchange of the texts, no sort of the whole.

    Null texts count as empty. Rows with the same key stand in the order of
    their texts; rows with a null key come last, and keep a null key. A single
    row is its own next document. Other columns are not read. An empty text has
    one empty paragraph and no runs: it is like nothing but an empty text. Very long
    texts are taken whole; an empty table gives an empty result.
    """
    n = ranges or default_ranges(docs)
    cuts = cut_points(docs, key, n)
    keyed = docs.select(order_key(key).alias("k"), F.col(text).alias("text"))
    keyed = keyed.withColumn("range", bucket_of(F.col("k"), cuts))
    # one row per range reaches the driver
    tops = {r["range"]: r["k"] for r in keyed.groupBy("range").agg(F.max("k").alias("k")).collect()}
    filled = sorted(tops)
    follows = [(r, tops[r], filled[(i + 1) % len(filled)]) for i, r in enumerate(filled)]
    bounds = docs.sparkSession.createDataFrame(follows, "range int, top long, following int")
    rows = keyed.join(F.broadcast(bounds), "range")
    own = F.struct(F.col("range").alias("r"), F.lit(False).alias("head"))
    copy = F.struct(F.col("following").alias("r"), F.lit(True).alias("head"))
    to = F.when(F.col("k") == F.col("top"), F.array(own, copy)).otherwise(F.array(own))
    rows = rows.select("k", "text", F.explode_outer(to).alias("to")).select("k", "text", "to.r", "to.head")
    rows = rows.repartitionById(n, F.col("r")).sortWithinPartitions("r", F.desc("head"), "k", "text")
    schema = (
        f"{key} long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, before, before_like = None, "", np.zeros((1, LIKE_LANES), np.int32)
        for batch in batches:
            for piece in pieces_of(batch, "text"):
                texts = [t or "" for t in piece.column("text").to_pylist()]
                ranges, heads = piece.column("r").to_pylist(), piece.column("head").to_pylist()
                edited = []
                for t, r, head in zip(texts, ranges, heads):
                    if not head:
                        if r != here:
                            raise ValueError("a range has lost its head row")
                        third = len(t) // 3
                        edited.append(t[: len(t) - third] + before[:third])
                    here, before = r, t
                equal, like = text_vectors(texts)
                following = np.concatenate([before_like, like[:-1]])
                before_like = like[-1:]
                keep = ~np.array(heads)
                if not edited:
                    continue
                edited_equal, edited_like = text_vectors(edited)
                own = like[keep]
                yield pa.RecordBatch.from_arrays(
                    [
                        whole_key(piece.column("k").filter(pa.array(keep))),
                        pa.array([len(t) for t, head in zip(texts, heads) if not head], pa.int64()),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                        pa.array(pack(equal[keep], own)),
                        pa.array(pack(edited_equal, edited_like)),
                        pa.array(likeness(own, edited_like)),
                        pa.array(likeness(own, following[keep])),
                    ],
                    names=[key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    return rows.mapInArrow(run, schema)
