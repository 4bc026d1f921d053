"""Benchmark decontamination by templates.

Texts become rows of tokens in which numbers, units behind numbers, and names are
typed placeholders. Windows of the benchmark's templates meet windows of the
documents' templates by hash; along each alignment of an item in a document, what
stands in the placeholders must be a consistent renaming (one value of the item
always becomes the same value of the document). So a question with other numbers
or names is found, and a text that only has the same shape is not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemart.llm.ranges import MASK, low_bits_mask, stored
from tidemart.llm.texts import Words, mix, pieces_of, separators, utf8, windows

WINDOW = 3
SHARE = 0.75
STRETCH = 12  # words in a row
SEEN = 5  # words in a row that stand for themselves, wherever they are in the document
WHOLE = 2  # the variant of items without a window
NEAR = 8  # words put in or left out between two parts of a copy
BETWEEN = separators((0, 47), (58, 64), (91, 96), (123, 127))
# Names and signs of units that may follow a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t lb lbs oz pound pounds ounce ounces "
    "ml cl l litre litres liter liters gallon gallons s sec second seconds min minute minutes h hour hours day days "
    "week weeks month months year years percent dollar dollars euro euros cent cents usd eur gbp w kw kwh v a hz khz "
    "mhz ghz b kb mb gb tb c f k degrees meter meters metre metres gram grams kilogram kilograms people"
).split()
NUMBER, UNIT, NAME = (np.uint64(x) for x in (0x6E756D62, 0x756E6974, 0x6E616D65))
_units: list[np.ndarray] = []


def _unit_hashes() -> np.ndarray:
    if not _units:
        data, offsets = utf8(pa.array(UNITS))
        _units.append(np.sort(Words(data, offsets, BETWEEN).hashes()))
    return _units[0]


def _split_numbers(words: Words) -> None:
    """Numbers with points or commas inside become one word, and a unit at the end of a number a word of its own."""
    data = words.data
    is_digit = (data >= 48) & (data <= 57)
    other = np.append(np.flatnonzero(~is_digit), len(data))
    mid = other[np.searchsorted(other, words.starts)]
    cut = (mid > words.starts) & (mid < words.ends)
    if cut.any():
        rest = Words(data, words.offsets, BETWEEN)
        rest.starts, rest.ends = mid[cut], words.ends[cut]
        cuts = rest.starts[np.isin(rest.hashes(), _unit_hashes())]
        words.starts, words.ends = np.sort(np.append(words.starts, cuts)), np.sort(np.append(words.ends, cuts))
    digits = np.concatenate([[0], np.cumsum(is_digit)])
    number = digits[words.ends] - digits[words.starts] == words.ends - words.starts
    gap = data[np.minimum(words.ends, len(data) - 1)]
    close = (words.starts[1:] == words.ends[:-1] + 1) & ((gap[:-1] == 46) | (gap[:-1] == 44)) & number[1:] & number[:-1]
    rows = np.searchsorted(words.offsets, words.starts, "right")
    close &= rows[1:] == rows[:-1]
    words.starts = words.starts[np.concatenate([[True], ~close])]
    words.ends = words.ends[np.concatenate([~close, [True]])]
    words.bounds = np.searchsorted(words.starts, words.offsets)
    words.counts = np.diff(words.bounds)


def canonical(data: np.ndarray, offsets: np.ndarray, names: bool) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, their values (hashes of what stands there), and their tokens (the type where there is one).

    A name is a word with a large first letter and a small second one that does
    not follow the end of a sentence.
    """
    words = Words(data, offsets, BETWEEN)
    if len(words.starts):
        _split_numbers(words)
    values = words.hashes()
    tokens = values.copy()
    if not len(values):
        return words, values, tokens
    digits = np.concatenate([[0], np.cumsum(((data >= 48) & (data <= 57)) | (data == 46) | (data == 44))])
    number = digits[words.ends] - digits[words.starts] == words.ends - words.starts
    first = np.zeros(len(values), bool)
    starts = words.bounds[:-1][words.counts > 0]
    first[starts] = True
    after_number = np.concatenate([[False], number[:-1]]) & ~first
    units = _unit_hashes()
    unit = after_number & ~number & (units[np.minimum(np.searchsorted(units, values), len(units) - 1)] == values)
    tokens[number], tokens[unit] = NUMBER, UNIT
    if names:
        padded = np.concatenate([data, np.zeros(2, np.uint8)])
        a, b, c = (padded[np.minimum(words.starts + k, len(padded) - 1)] for k in range(3))
        big = ((a >= 65) & (a <= 90)) | ((a == 0xC3) & (b >= 0x80) & (b <= 0x9E))
        second = np.where(a == 0xC3, c, b)
        small = ((second >= 97) & (second <= 122)) | (second >= 0x80)
        ends = np.concatenate([[0], np.cumsum(np.isin(data, np.frombuffer(b".!?:\n", np.uint8)))])
        gap = np.concatenate([[0], words.ends[:-1]])
        fresh = first | (ends[words.starts] > ends[gap])
        tokens[big & small & ~fresh & ~number] = NAME
    return words, values, tokens


def template_windows(data: np.ndarray, offsets: np.ndarray):
    """Per variant (names kept, names typed): row, position, start, hash, values and tokens of each window.

    The last variant has one hash of all words of a row, as they stand there, and no start.
    """
    for variant, names in enumerate((False, True)):
        words, values, tokens = canonical(data, offsets, names)
        if not names:
            whole = np.flatnonzero(words.counts)
            last = WHOLE, whole, np.zeros(len(whole), np.int64), None, whole_hashes(words, values)[whole], values, tokens
        h, bounds = windows(tokens, words.bounds, WINDOW, short=False)
        h = h ^ np.uint64(variant)
        row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        at = np.arange(len(h)) - bounds[:-1][row]
        start = words.bounds[:-1][row] + at
        yield variant, row, at, start, h, values, tokens
    yield last


def whole_hashes(words: Words, values: np.ndarray) -> np.ndarray:
    """One hash for each row's sequence of words."""
    place = np.arange(len(values)) - np.repeat(words.bounds[:-1], words.counts)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mix(values ^ mix(place.astype(np.uint64) + np.uint64(1))), out=total[1:])
    sums = total[words.bounds[1:]] - total[words.bounds[:-1]]
    return mix(sums + words.counts.astype(np.uint64)) ^ np.uint64(WHOLE)


def _slots(start: np.ndarray | None, n: int, values: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if start is None:
        return np.zeros((n, WINDOW), np.int64), np.zeros((n, WINDOW), bool)
    where = start[:, None] + np.arange(WINDOW)
    typed = tokens[where] != values[where]
    return np.where(typed, values[where], np.uint64(0)).view(np.int64), typed


def _lists(a: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, a.size + 1, WINDOW, dtype=np.int32), pa.array(a.ravel()))


def item_windows(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """(h, item, variant, at, slots, n): the windows of each item, and how many words of the variant are in one."""

    def run(batches):
        for batch in batches:
            for piece in pieces_of(batch, 1):
                found = np.zeros(piece.num_rows, bool)
                for variant, row, at, start, h, values, tokens in template_windows(*utf8(piece.column(1))):
                    slots, typed = _slots(start, len(row), values, tokens)
                    some = ~typed.all(1)
                    if start is None:
                        # only items without a window stand as a whole
                        some, n = ~found[row], np.full(piece.num_rows, WINDOW)
                    else:
                        found[row[some]] = True
                        used = np.unique((start[some][:, None] + np.arange(WINDOW)).ravel())
                        owner = np.zeros(len(values), np.int64)
                        owner[(start[:, None] + np.arange(WINDOW)).ravel()] = np.repeat(row, WINDOW)
                        n = np.bincount(owner[used], minlength=piece.num_rows)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(h[some].view(np.int64)),
                            piece.column(0).take(pa.array(row[some])),
                            pa.array(np.full(some.sum(), variant, np.int32)),
                            pa.array(at[some].astype(np.int64)),
                            _lists(slots[some]),
                            pa.array(n[row[some]].astype(np.int64)),
                        ],
                        names=["h", "item", "variant", "at", "slots", "n"],
                    )

    rows = benchmark.select(F.col(item).cast("long").alias("item"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "h long, item long, variant int, at long, slots array<long>, n long")


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    share: float = SHARE,
    stretch: int = STRETCH,
    consistent: bool = True,
) -> DataFrame:
    """(key, text_hash, item, share) for each document that holds enough of an item.

    That is at least ``share`` of the item's words, or ``stretch`` of them in a
    row. A word is held if it is in a met window; windows have three tokens, so
    a changed word takes four others with it at most, and one with placeholders
    only is not used. The documents' windows pass a filter of fixed size first,
    and then meet the items' windows by an equality join; hits are grouped by
    alignment, and an alignment counts if its slots are consistent. Without
    ``consistent`` only the words go whose value became several. Alignments
    within ``NEAR`` words of each other add up, and so do, anywhere in the
    document, those with ``SEEN`` words in a row. Items without a window, of fewer
    than three words or of placeholders only, are held by documents that have the
    same words and no others. Null and empty texts, and an
    empty benchmark, find nothing. Items may repeat: each pair comes once. Rows
    with equal key and text come once. Other columns are not read.
    """
    templates = stored(item_windows(benchmark, item, item_text), "templates")
    mask = docs.sparkSession.sparkContext.broadcast(low_bits_mask(templates, "h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces_of(batch, 1):
                for variant, row, at, start, h, values, tokens in template_windows(*utf8(piece.column(1))):
                    hit = np.flatnonzero(mask.value[(h & np.uint64(MASK)).astype(np.int64)])
                    slots, _ = _slots(None if start is None else start[hit], len(hit), values, tokens)
                    yield pa.RecordBatch.from_arrays(
                        [
                            piece.column(0).take(pa.array(row[hit])),
                            piece.column(2).take(pa.array(row[hit])),
                            pa.array(h[hit].view(np.int64)),
                            pa.array(at[hit].astype(np.int64)),
                            _lists(slots),
                        ],
                        names=["k", "t", "h", "place", "filled"],
                    )

    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("text"), F.xxhash64(text).alias("t"))
    kind = docs.schema[key].dataType.simpleString()
    found = rows.mapInArrow(run, f"k {kind}, t long, h long, place long, filled array<long>")
    hits = found.join(templates, "h").select(
        "k", "t", "item", "variant", "n", "at", (F.col("place") - F.col("at")).alias("line"),
        F.filter(F.arrays_zip("slots", "filled"), lambda s: s["slots"] != 0).alias("pairs"),
        *([] if consistent else [F.expr("""
            filter(transform(slots, (s, i) -> struct(s AS slots, filled[i] AS filled, at + i AS word)), s -> s.slots <> 0)""").alias("places")]),
    )
    lines = hits.groupBy("k", "t", "item", "variant", "n", "line").agg(
        F.collect_set("at").alias("met"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
        *([] if consistent else [F.array_distinct(F.flatten(F.collect_set("places"))).alias("places")]),
    )
    if not consistent:
        lines = lines.withColumn("split", F.expr("""
            transform(filter(places, a -> exists(places, b -> a.slots = b.slots AND a.filled <> b.filled)), a -> a.word)"""))
    renamed = F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda s: s["slots"])))
    words, run = words_of(F.col("met")), longest_run(F.col("met"))
    if consistent:
        lines = lines.where(renamed)
    else:
        words, run = F.array_except(words, "split"), F.when(renamed, run).otherwise(0)
    lines = lines.withColumn("words", words).withColumn("run", run)
    same = ["k", "t", "item", "variant", "n"]
    in_order = W.partitionBy(*same).orderBy("line")
    lines = lines.withColumn("far", (F.col("line") - F.lag("line").over(in_order) > NEAR).cast("int"))
    lines = lines.withColumn("band", F.sum(F.coalesce("far", F.lit(0))).over(in_order))
    held = lambda words: F.size(F.array_distinct(F.flatten(F.collect_list(words))))
    bands = lines.groupBy(*same, "band").agg(
        held("words").alias("near"), F.max("run").alias("run"), F.flatten(F.collect_list(F.when(F.col("run") >= SEEN, F.col("words")))).alias("seen")
    )
    spans = bands.groupBy(*same).agg(F.greatest(F.max("near"), held("seen")).alias("met"), F.max("run").alias("run"))
    shares = spans.groupBy("k", "t", "item").agg(F.max(F.col("met") / F.col("n")).alias("share"), F.max("run").alias("run"))
    return shares.where((F.col("share") >= share) | (F.col("run") >= stretch)).select(
        F.col("k").alias(key), F.col("t").alias("text_hash"), F.col("item").alias("item_id"), "share"
    )


def words_of(met: Column) -> Column:
    """Positions of the words in the windows that start at the positions in ``met``."""
    return F.array_distinct(F.flatten(F.transform(met, lambda a: F.sequence(a, a + (WINDOW - 1)))))


def longest_run(met: Column) -> Column:
    """Words in the longest row of windows whose starts follow one another."""
    zero = F.struct(F.lit(-9).cast("long").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(so_far, a):
        run = F.when(a == so_far["last"] + 1, so_far["run"] + 1).otherwise(WINDOW)
        return F.struct(a.alias("last"), run.alias("run"), F.greatest(so_far["best"], run).alias("best"))

    return F.aggregate(F.array_sort(met), zero, step, lambda so_far: so_far["best"])


def drop_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", consistent: bool = True) -> DataFrame:
    """``docs`` without the documents that hold an item."""
    leaks = find_leaks(docs, benchmark, key, text, consistent=consistent).select(F.col(key).alias("k"), F.col("text_hash").alias("t")).distinct()
    leaks = stored(leaks, "leaks")
    same = docs[key].eqNullSafe(leaks["k"]) & (F.xxhash64(docs[text]) == leaks["t"])
    return docs.join(leaks, same, "left_anti")
