"""Quality by a Kneser-Ney model of character runs, trained on trusted text.

The counts of all runs of four characters in trusted text, the smoothed terms
made from them, and the chances of the runs that documents ask for are Spark
tables of any size, joined by run and by context. Documents are dealt into
blocks of one language; a block's distinct runs are joined with the terms once,
and come back to the block's texts, whose sums they give. A document's perplexity
is compared with a quantile of the trusted documents of its language, or where
they are too few, with the quartiles of all documents of its language. The
limits come from scores by models that have not seen the scored document.

The same smoothing over four byte classes fits one dense table (``gram_counts``,
``log_table``, ``add_bits``). ``judge_quality`` does not use that table.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType

from tidemart.llm.ranges import default_ranges, low_bits_mask, stored
from tidemart.llm.texts import pieces_of, utf8

ORDER = 4
PRIOR = 200
BINS = 256  # per bit
RUN = 4  # characters
CODE_POINTS = 0x110000
FOLDS = 2
BLOCK_BYTES = 64 << 20
PACK_BYTES = 32 << 20
PIECE_BYTES = 1 << 20
RUNS_AT_ONCE = 1 << 18
HELD_RUNS = 1_000_000
MODELS = tuple(str(m) for m in range(FOLDS + 1))  # of all folds, and without each of them


def _classes() -> np.ndarray:
    """a-z, A-Z as one, digits, blank, line end, full stop, comma, ! and ?, other signs, controls, and beyond ASCII five."""
    c = np.full(256, 33, np.int64)
    c[97:123] = np.arange(26)
    c[65:91] = 26
    c[48:58] = 27
    c[32], c[10], c[46], c[44], c[33], c[63] = 28, 29, 30, 31, 32, 32
    c[:9], c[9], c[11:32], c[127] = 34, 28, 34, 34
    c[0x80:0xC0] = 35 + (np.arange(64) >> 4)
    c[0xC0:] = 39
    return c


CLASS_OF = _classes()
SIZE = 40


def gram_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code of the run of ORDER classes at each byte that starts one inside its row, and the row bounds in them."""
    c = CLASS_OF[data]
    m = max(len(c) - ORDER + 1, 0)
    code = np.zeros(m, np.int64)
    for k in range(ORDER):
        code = code * SIZE + c[k : k + m]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = row[:m] == row[len(row) - m :] if m else np.zeros(0, bool)
    per_row = np.maximum(np.diff(offsets) - ORDER + 1, 0)
    return code[inside], np.concatenate([[0], np.cumsum(per_row)])


def gram_counts(trusted: DataFrame, text: str = "text") -> DataFrame:
    """(g, c): how often each run of classes occurs in all texts; one row per run and task is shuffled."""

    def run(batches):
        total = np.zeros(SIZE**ORDER, np.int64)
        for batch in batches:
            for piece in pieces_of(batch, 0):
                codes, _ = gram_codes(*utf8(piece.column(0)))
                total += np.bincount(codes, minlength=len(total))
        there = np.flatnonzero(total)
        for low in range(0, len(there), 50_000):
            g = there[low : low + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(total[g])], ["g", "c"])

    found = trusted.select(text).mapInArrow(run, "g long, c long")
    return found.groupBy("g").agg(F.sum("c").alias("c"))


def class_head(order: int) -> Column:
    return F.expr(f"g div {SIZE}")


def class_tail(order: int) -> Column:
    return F.col("g") % SIZE ** (order - 1)


def run_head(order: int) -> Column:
    return F.substring("g", 1, order - 1)


def run_tail(order: int) -> Column:
    return F.substring("g", 2, order - 1)


def smoothed(
    counts: DataFrame,
    longest: int = ORDER,
    head: Callable[[int], Column] = class_head,
    tail: Callable[[int], Column] = class_tail,
    models: tuple[str, ...] = ("",),
) -> DataFrame:
    """Interpolated modified Kneser-Ney terms: rows (order, code, value), with a column ``value`` for each model's ``c``.

    ``value`` of a run is its discounted share in its context; of a context (its
    order is negative) the weight that its discounts leave to the shorter run. The
    longest runs use their counts, shorter ones the number of different classes or
    characters before them. Discounts come from the counts of runs seen once to
    four times. ``head`` and ``tail`` are a run of some order without its last and
    without its first place. ``models`` are the endings of the columns.
    """
    levels = []
    grams = counts.select("g", *["c" + m for m in models])
    for order in range(longest, 0, -1):
        seen = [(m, i) for m in models for i in (1, 2, 3, 4)]
        ones = grams.agg(*[F.count(F.when(F.col("c" + m) == i, 1)) for m, i in seen]).first()
        taken = []
        for at, m in enumerate(models):
            once, twice, thrice = discounts(*ones[4 * at : 4 * at + 4])
            c = F.col("c" + m)
            d = F.when(c == 0, 0.0).when(c == 1, once).when(c == 2, twice).otherwise(thrice)
            taken.append(d.alias("d" + m))
        rows = grams.select("*", *taken, head(order).alias("h"))
        sums = [F.sum(x + m).alias(y + m) for m in models for x, y in (("c", "total"), ("d", "left"))]
        contexts = rows.groupBy("h").agg(*sums)
        # a model that has not seen a context gives its runs nothing, and all to the shorter ones
        shares = [
            F.when(F.col("total" + m) > 0, (F.col("c" + m) - F.col("d" + m)) / F.col("total" + m)).otherwise(0.0).alias("value" + m)
            for m in models
        ]
        weights = [
            F.when(F.col("total" + m) > 0, F.col("left" + m) / F.col("total" + m)).otherwise(1.0).alias("value" + m) for m in models
        ]
        levels.append(rows.join(contexts, "h").select(F.lit(order).alias("order"), F.col("g").alias("code"), *shares))
        levels.append(contexts.select(F.lit(-order).alias("order"), F.col("h").alias("code"), *weights))
        # the shorter run's count: how many different places stand before it
        before = [F.count(F.when(F.col("c" + m) > 0, 1)).alias("c" + m) for m in models]
        grams = grams.select(tail(order).alias("g"), *["c" + m for m in models]).groupBy("g").agg(*before)
        if order == longest > 1 and models != ("",):
            grams = stored(grams, "shorter")
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """What is taken from counts of one, two, and three or more; half where the corpus is too small to tell."""
    n = (n1, n2, n3, n4)
    y = n1 / max(n1 + 2 * n2, 1)
    return [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.1), float(i)) if n[i - 1] else 0.5 for i in (1, 2, 3)]


def log_table(model: DataFrame) -> np.ndarray:
    """Bits of each class after each context, as one table of SIZE ** ORDER cells (10 MB), whatever the corpus."""
    found = model.toArrow()
    order, code, value = (found.column(i).to_numpy() for i in range(3))
    lower = np.full((1, SIZE), 1.0 / SIZE)
    for n in range(1, ORDER + 1):
        alpha = np.zeros(SIZE**n)
        alpha[code[order == n]] = value[order == n]
        gamma = np.ones(SIZE ** (n - 1))  # a context never seen leaves all to the shorter one
        gamma[code[order == -n]] = value[order == -n]
        shorter = np.tile(lower, (max(SIZE ** (n - 1) // len(lower), 1), 1))
        lower = alpha.reshape(-1, SIZE) + gamma[:, None] * shorter
    return -np.log2(lower).astype(np.float32).ravel()


def add_bits(docs: DataFrame, table: np.ndarray, text: str = "text", name: str = "bits") -> DataFrame:
    """``docs`` with the sum of bits and the number of scored bytes of each whole text (``<name>``, ``<name>_n``)."""
    schema = StructType(docs.schema.fields + [StructField(name, DoubleType()), StructField(name + "_n", DoubleType())])
    at = docs.columns.index(text)
    names = schema.names
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits_of = shared.value
        for batch in batches:
            for piece in pieces_of(batch, at):
                codes, bounds = gram_codes(*utf8(piece.column(at)))
                total = np.concatenate([[0.0], np.cumsum(bits_of[codes], dtype=np.float64)])
                bits = np.round(total[bounds[1:]] - total[bounds[:-1]], 4)
                n = np.diff(bounds).astype(np.float64)
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(bits), pa.array(n)], names=names)

    return docs.mapInArrow(run, schema)


def characters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points and row offsets of a text column; a null row is empty."""
    data, offsets = utf8(column)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.int32)
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return points, before[offsets]


def run_slices(texts: pa.Array) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """(row, code points by place) of the runs of RUN characters inside each text, at most RUNS_AT_ONCE at a time.

    A text's runs may go over several slices, so that what is made for each run does not follow the text's length.
    """
    points, bounds = characters(texts)
    runs = np.maximum(np.diff(bounds) - RUN + 1, 0)
    upto = np.concatenate([[0], np.cumsum(runs)])
    shift = bounds[:-1] - upto[:-1]
    for low in range(0, int(upto[-1]), RUNS_AT_ONCE):
        high = min(low + RUNS_AT_ONCE, int(upto[-1]))
        row = np.repeat(np.arange(len(runs)), np.diff(np.clip(upto, low, high)))
        at = np.arange(low, high) + shift[row]
        yield row, [points[at + k] for k in range(RUN)]


class Keys:
    """One whole number for each row of some columns of whole numbers: exact, and the same for equal rows.

    Where the numbers would leave 62 bits, the ranks of those met so far stand for
    them. ``of`` numbers rows whose values and beginnings have all been met before.
    """

    def __init__(self, columns: list[np.ndarray]):
        seen = np.zeros(max([CODE_POINTS, *(int(c.max(initial=0)) + 1 for c in columns)]), bool)
        for c in columns:
            seen[c] = True
        self.values = np.flatnonzero(seen).astype(np.int32)
        self.ids = np.cumsum(seen) - 1
        self.ranks: list[np.ndarray | None] = []
        self.met = self._number(columns, True)

    def _number(self, columns: list[np.ndarray], new: bool) -> np.ndarray:
        n = max(len(self.values), 1)
        key, bound = self.ids[columns[0]], n
        for at, c in enumerate(columns[1:]):
            if new:
                self.ranks.append(np.unique(key) if bound * n >= 1 << 62 else None)
            table = self.ranks[at]
            if table is not None:
                key, bound = np.searchsorted(table, key), len(table)
            key, bound = key * n + self.ids[c], bound * n
        return key

    def of(self, columns: list[np.ndarray]) -> np.ndarray:
        return self._number(columns, False)

    def columns(self, key: np.ndarray) -> list[np.ndarray]:
        """The rows that have these numbers."""
        n = max(len(self.values), 1)
        out = []
        for table in reversed(self.ranks):
            key, last = np.divmod(key, n)
            out.append(self.values[last])
            key = key if table is None else table[key]
        return [self.values[key], *reversed(out)]


def distinct_rows(columns: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """The different rows of some columns, and how often each occurs, or the sum of its ``counts``."""
    keys = Keys(columns)
    if counts is None:
        found, n = np.unique(keys.met, return_counts=True)
    else:
        by = np.argsort(keys.met)
        found = keys.met[by]
        first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])[: len(found)])
        found, n = found[first], np.add.reduceat(counts[by], first) if len(first) else counts
    return keys.columns(found), n


def run_texts(columns: list[np.ndarray]) -> pa.Array:
    """Runs given by their code points, as texts."""
    points = np.stack(columns, 1).astype(np.uint32)
    size = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
    ends = np.concatenate([[0], np.cumsum(size.sum(1))]).astype(np.int32)
    data = points.tobytes().decode("utf-32-le").encode()
    return pa.StringArray.from_buffers(len(points), pa.py_buffer(ends), pa.py_buffer(data))


def _gathered(slices: Iterator[tuple[pa.Array, np.ndarray]]) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Distinct (group, run) rows and their counts from slices of (texts, group of each), in parts of some millions."""
    held: list[tuple[list[np.ndarray], np.ndarray]] = []
    size = merged = 0

    def all_held():
        columns = [np.concatenate(c) for c in zip(*[h[0] for h in held])]
        counts = np.concatenate([h[1] for h in held])
        held.clear()
        return distinct_rows(columns, counts)

    for texts, group in slices:
        for row, columns in run_slices(texts):
            held.append(distinct_rows([group[row], *columns]))
            size += len(held[-1][1])
            if size > merged + HELD_RUNS // 2:
                held.append(all_held())
                size = merged = len(held[0][1])
                if merged > HELD_RUNS:
                    yield held.pop()
                    size = merged = 0
    if held:
        yield all_held()


def _batches(columns: list[np.ndarray], *others: tuple[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Batches of some named columns, each followed by the runs given by their code points (g)."""
    for low in range(0, len(columns[0]), 50_000):
        part = slice(low, low + 50_000)
        arrays = [pa.array(values[part]) for _, values in others]
        yield pa.RecordBatch.from_arrays([*arrays, run_texts([c[part] for c in columns])], [*[name for name, _ in others], "g"])


def _text_pieces(rows: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """(text, fold) of some rows (fold, z: a packed text), unpacked until they have ``limit`` bytes."""
    held, start, size = [], 0, 0
    for i, z in enumerate(rows.column(1), 1):
        held.append(unpacked(z.as_py()).column(0))
        size += held[-1].nbytes
        if size >= limit or i == rows.num_rows:
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(held), rows.column(0).slice(start, i - start)], ["text", "fold"])
            held, start, size = [], i, 0


def run_counts(trusted: DataFrame) -> DataFrame:
    """(fold, g, c): how often each run occurs in the texts of each fold of ``trusted`` (fold, z: packed text), by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def slices():
            for batch in batches:
                for piece in _text_pieces(batch, PIECE_BYTES):
                    yield piece.column(0), piece.column(1).to_numpy()

        for rows, n in _gathered(slices()):
            yield from _batches(rows[1:], ("fold", rows[0]), ("c", n))

    return trusted.select("fold", "z").mapInArrow(run, "fold int, c long, g string")


def fold_models(counts: DataFrame) -> DataFrame:
    """(g, c0, c1, ...): column 0 counts the runs of all folds, column m those of all folds but m."""
    without = [F.sum(F.when(F.col("fold") != m, F.col("c")).otherwise(0)).alias(f"c{m}") for m in range(1, FOLDS + 1)]
    return counts.groupBy("g").agg(F.sum("c").alias("c0"), *without)


def chances(asked: DataFrame, model: DataFrame, order: int = RUN) -> DataFrame:
    """(g, p0, p1, ...): the chance of the last character of each run of ``asked`` (g) after the others, in each model.

    A run's share is joined by the run, its context's weight by the context, and the
    chance of the shorter run by that one. Below single characters all code points
    are alike.
    """
    shares = model.where(F.col("order") == order).select(F.col("code").alias("g"), *[F.col("value" + m).alias("share" + m) for m in MODELS])
    weights = model.where(F.col("order") == -order).select(F.col("code").alias("h"), *[F.col("value" + m).alias("weight" + m) for m in MODELS])
    rows = asked.select("g", run_head(order).alias("h"), run_tail(order).alias("s"))
    rows = rows.join(shares, "g", "left").join(weights, "h", "left")
    below = {m: F.lit(1.0 / CODE_POINTS) for m in MODELS}
    if order > 1:
        shorter = chances(asked.select(run_tail(order).alias("g")).distinct(), model, order - 1)
        rows = rows.join(shorter.withColumnRenamed("g", "s"), "s")
        below = {m: F.col("p" + m) for m in MODELS}
    p = [(F.coalesce("share" + m, F.lit(0.0)) + F.coalesce("weight" + m, F.lit(1.0)) * below[m]).alias("p" + m) for m in MODELS]
    return rows.select("g", *p)


def packed(rows: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))
    with pa.ipc.new_stream(sink, rows.schema, options=options) as writer:
        writer.write_batch(rows)
    return sink.getvalue().to_pybytes()


def unpacked(blob: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(blob).read_next_batch()


def _by_block(rows: pa.RecordBatch, block: np.ndarray) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(block, rows) of the blocks in some rows."""
    by = np.argsort(block, kind="stable")
    cuts = np.flatnonzero(np.concatenate([[True], np.diff(block[by]) != 0])).tolist() if len(by) else []
    ordered = rows.take(pa.array(by))
    for low, high in zip(cuts, [*cuts[1:], len(by)]):
        yield int(block[by[low]]), ordered.slice(low, high - low)


def asked_runs(docs: DataFrame) -> DataFrame:
    """(block, g): the distinct runs of each block of ``docs`` (block, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: dict[int, int] = {}

        def slices():
            for batch in batches:
                for piece in pieces_of(batch, 1, PIECE_BYTES):
                    blocks, at = np.unique(piece.column(0).to_numpy(), return_inverse=True)
                    own = [places.setdefault(b, len(places)) for b in blocks.tolist()]
                    yield piece.column(1), np.array(own, np.int64)[at]

        for rows, _ in _gathered(slices()):
            yield from _batches(rows[1:], ("block", np.array(list(places))[rows[0]]))

    return docs.select("block", "text").mapInArrow(run, "block long, g string").distinct()


def block_terms(asked: DataFrame, model: DataFrame) -> DataFrame:
    """(block, kind 0, z): packs of the runs of each block with their bits in each model."""
    bits = chances(asked.select("g").distinct(), model).select("g", *[(-F.log2("p" + m)).alias("bits" + m) for m in MODELS])
    rows = asked.join(stored(bits, "chances"), "g").select("block", "g", *["bits" + m for m in MODELS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.RecordBatch.from_arrays(batch.columns[1:], names=batch.schema.names[1:])
            yield _packs([(b, packed(rows)) for b, rows in _by_block(own, batch.column(0).to_numpy())], 0)

    return rows.mapInArrow(run, "block long, kind int, z binary")


def _packs(packs: list[tuple[int, bytes]], kind: int) -> pa.RecordBatch:
    arrays = [pa.array([b for b, _ in packs], pa.int64()), pa.array([kind] * len(packs), pa.int32()), pa.array([z for _, z in packs], pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, ["block", "kind", "z"])


def _sorted_terms(table: pa.Table) -> tuple[Keys, np.ndarray, list[np.ndarray]]:
    """The numbering of a block's runs, their numbers in order, and the bits of each model in that order."""
    points = np.concatenate([characters(chunk)[0] for chunk in table.column(0).chunks])
    keys = Keys(list(points.reshape(-1, RUN).T))
    by = np.argsort(keys.met)
    sorted_keys, keys.met = keys.met[by], None
    return keys, sorted_keys, [table.column(i).to_numpy()[by] for i in range(1, FOLDS + 2)]


def block_scores(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(k, t, l, bits, bits_out, bits_n) of each row of ``docs`` (block, k, t, l, fold, text): sums over all runs of its text."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces_of(batch, 5, PACK_BYTES):
                own = pa.RecordBatch.from_arrays(piece.columns[1:], names=["k", "t", "l", "fold", "text"])
                yield _packs([(b, packed(rows)) for b, rows in _by_block(own, piece.column(0).to_numpy())], 1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, keys = None, [], None
        for batch in batches:
            for b, kind, z in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if b != block:
                    block, held, keys = b, [], None
                rows = unpacked(z.as_py())
                if kind == 0:
                    held.append(rows)
                    continue
                if keys is None:  # all terms of a block come before its texts
                    table = pa.Table.from_batches(held)
                    held = []
                    keys, sorted_keys, terms = _sorted_terms(table)
                    del table
                for piece in pieces_of(rows, 4, PIECE_BYTES):
                    m = piece.num_rows
                    totals = [np.zeros(m) for _ in terms]
                    n = np.zeros(m)
                    for row, columns in run_slices(piece.column(4)):
                        found = np.searchsorted(sorted_keys, keys.of(columns))
                        for total, bits in zip(totals, terms):
                            total += np.bincount(row, bits[found], m)
                        n += np.bincount(row, minlength=m)
                    sums = [np.round(total, 4) for total in totals]
                    out = np.choose(piece.column(3).to_numpy(), sums)
                    arrays = [*piece.columns[:3], pa.array(sums[0]), pa.array(out), pa.array(n)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["k", "t", "l", "bits", "bits_out", "bits_n"])

    n_tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = StructType([docs.schema[c] for c in ("k", "t", "l")] + [StructField(c, DoubleType()) for c in ("bits", "bits_out", "bits_n")])
    texts = docs.select("block", "k", "t", "l", "fold", "text").mapInArrow(pack, "block long, kind int, z binary")
    rows = terms.unionByName(texts).repartition(n_tasks, "block").sortWithinPartitions("block", "kind")
    return rows.select("block", "kind", "z").mapInArrow(score, schema)


def packed_trusted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(fold, z) of the trusted rows of ``docs`` (k, fold, text): packed texts.

    A filter over the ids' hashes, eight bits for each trusted id, lets few others pass, so that the texts
    of others are not sent. The join that follows is exact.
    """
    good = stored(trusted_ids(labels).select(F.col("doc_id").alias("k"), F.xxhash64("doc_id").alias("hash")), "good")
    bits = min(max(22, math.ceil(math.log2(8 * good.count() + 1))), 28)
    mask = docs.sparkSession.sparkContext.broadcast(np.packbits(low_bits_mask(good, "hash", bits)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = batch.column(1).to_numpy() & ((1 << bits) - 1)
            some = batch.filter(pa.array((mask.value[low >> 3] >> (7 - (low & 7)) & 1).astype(bool)))
            for piece in pieces_of(some, 3):
                texts = pa.RecordBatch.from_arrays([piece.column(3)], ["text"])
                z = pa.array([packed(texts.slice(i, 1)) for i in range(piece.num_rows)], pa.binary())
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(2), z], names=["k", "fold", "z"])

    schema = StructType([docs.schema["k"], docs.schema["fold"], StructField("z", BinaryType())])
    rows = docs.select("k", F.xxhash64("k").alias("hash"), "fold", "text").mapInArrow(run, schema)
    return rows.join(good.select("k").hint("shuffle_hash"), "k", "left_semi").select("fold", "z")


def run_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(k, t, l, bits, bits_out, bits_n) of the rows of ``docs`` (k, l, text) with one run at least.

    ``bits`` are those of the model of all trusted texts, ``bits_out`` those of the
    model of the trusted texts outside the row's fold. Equal texts are in one fold.
    """
    docs = docs.where(F.char_length("text") >= RUN)
    size = docs.groupBy("l").agg(F.ceil(F.sum(F.octet_length("text")) / BLOCK_BYTES).alias("parts"))
    size = stored(size.withColumnRenamed("l", "of"), "parts")
    t = F.xxhash64("text")
    rows = docs.join(F.broadcast(size), F.col("l").eqNullSafe(F.col("of"))).select(
        "k", "l", "text", t.alias("t"), (F.pmod(t, F.lit(FOLDS)) + 1).cast("int").alias("fold"), "parts"
    )
    part = F.pmod(F.xxhash64("k", "text", F.lit(1)), F.col("parts"))
    rows = rows.select("*", F.xxhash64("l", F.col("l").isNull(), part).alias("block"))
    counts = run_counts(packed_trusted(rows.select("k", "fold", "text"), labels))
    model = smoothed(stored(fold_models(counts), "models"), RUN, run_head, run_tail, MODELS)
    # its levels would be written by as many tasks each: small files, and a process for each to set its mode
    model = stored(model.coalesce(default_ranges(model)), "model")
    asked = stored(asked_runs(rows), "asked")
    return block_scores(rows, block_terms(asked, model))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The ids whose labels all say good quality and not toxic."""
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    return good.where((F.col("q") == 1) & (F.col("t") == 0)).select("doc_id")


def trusted_rows(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows whose labels all say good quality and not toxic. The labels are the side that is hashed."""
    good = trusted_ids(labels).select(F.col("doc_id").alias(key))
    return docs.join(good.hint("shuffle_hash"), key, "left_semi")


def perplexity(bits: Column, n: Column, usual: Column) -> Column:
    """Bits per character, drawn to the language's usual value by PRIOR characters: short texts differ by chance."""
    return (bits + usual * PRIOR) / (n + PRIOR)


def quantiles(scored: DataFrame, usual: DataFrame, q: float, margin: float, middle: float = 0.5) -> DataFrame:
    """Per language: exact quantile of the binned score, plus ``margin`` of its distance from the ``middle`` quantile."""
    bins = scored.join(usual, scored["l"] == usual["ul"])
    bins = bins.select("l", F.floor(perplexity(F.col("bits"), F.col("bits_n"), F.col("usual")) * BINS).alias("b"))
    bins = bins.groupBy("l", "b").agg(F.count(F.lit(1)).alias("n"))
    upto = W.partitionBy("l").orderBy("b").rowsBetween(W.unboundedPreceding, 0)
    whole = W.partitionBy("l")
    bins = bins.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(whole))
    cut = bins.groupBy("l").agg(
        F.min(F.when(F.col("upto") >= F.col("all") * q, F.col("b"))).alias("high"),
        F.min(F.when(F.col("upto") >= F.col("all") * middle, F.col("b"))).alias("mid"),
    )
    return cut.select("l", ((F.col("high") + 1 + margin * (F.col("high") - F.col("mid"))) / BINS).alias("threshold"))


def limits_of(scored: DataFrame, least: int, *cut: float) -> DataFrame:
    """(l, usual, threshold) of each language with at least ``least`` rows."""
    usual = scored.groupBy("l").agg((F.sum("bits") / F.sum("bits_n")).alias("usual"), F.count(F.lit(1)).alias("n"))
    usual = usual.where(F.col("n") >= least).select(F.col("l").alias("ul"), "usual")
    cuts = quantiles(scored, usual, *cut)
    return cuts.join(usual, cuts["l"] == usual["ul"]).select("l", "usual", "threshold")


def judge_quality(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    quantile: float = 0.98,
    margin: float = 0.5,
    least_trusted: int = 30,
    fence: float = 3.0,
    prefix: str = "",
) -> DataFrame:
    """``docs`` with bits, bits_n (scored characters), perplexity (bits per character), threshold and kept, each after ``prefix``.

    A document goes if its perplexity is over its language's threshold: the
    ``quantile`` of the trusted documents of that language, plus ``margin`` times
    its distance from the median. A language with fewer than ``least_trusted``
    trusted documents is judged by all its own documents: those over their upper
    quartile by more than ``fence`` times the distance of the quartiles go. No
    language takes the threshold of another: a null language, and one with fewer
    than ``least_trusted`` documents in all, cannot be judged, so its documents
    are kept, with a null threshold.

    Texts with fewer than four characters, null ones among them, have no run: their
    perplexity is the language's usual one and they are kept. Without any trusted
    document everything is kept, with null perplexity. Rows repeat as they came.
    ``prefix`` keeps the new names apart from those of ``docs``.
    """
    every = run_scores(docs.select(F.col(key).alias("k"), F.col(lang).alias("l"), F.col(text).alias("text")), labels)
    every = stored(every, "scored")
    seen = trusted_rows(every, labels, "k").select("l", F.col("bits_out").alias("bits"), "bits_n")
    scored = stored(seen, "trusted")
    usual_all = scored.agg((F.sum("bits") / F.sum("bits_n")).alias("usual")).first()["usual"]
    limits = stored(limits_of(scored, least_trusted, quantile, margin), "limits")
    # without any trusted document there is no model to judge by
    rare = every.where(F.lit(usual_all is not None)).join(limits.select("l"), "l", "left_anti")
    limits = limits.unionByName(stored(limits_of(rare, least_trusted, 0.75, fence, 0.25), "rare"))
    own = limits.select(F.col("l").alias("own_l"), F.col("usual").alias("usual_own"), F.col("threshold").alias("threshold_own"))
    names = [prefix + c for c in ("bits", "perplexity", "threshold", "kept")]
    found = every.groupBy("k", "t").agg(F.min("bits").alias("b"), F.min("bits_n").alias("n"))
    same = docs[key].eqNullSafe(found["k"]) & (F.xxhash64(docs[text]) == found["t"])
    out = docs.join(found, same, "left").join(own, docs[lang] == own["own_l"], "left")
    bits, n = F.coalesce(found["b"], F.lit(0.0)), F.coalesce(found["n"], F.lit(0.0))
    score = perplexity(bits, n, F.coalesce(own["usual_own"], F.lit(usual_all).cast("double")))
    limit = own["threshold_own"]
    kept = F.coalesce(score <= limit, F.lit(True))
    added = [bits.alias(names[0]), n.alias(names[0] + "_n"), score.alias(names[1]), limit.alias(names[2]), kept.alias(names[3])]
    return out.select(*[docs[c] for c in docs.columns], *added)
