"""Exact self-join of word-shingle sets by Jaccard similarity, as links and components.

Sets are ordered by shingle rarity and indexed by prefix: two sets that reach the
threshold share some shingles in their prefixes, and a set that shares too few
with all others is out. Every index list has a leader, and the sets of all lists
of one leader form a family; each pair that shares a list is in a family together. Families of any size are cut into blocks. In a block,
sets stand in order of size, so that the index lists hold positions and whole
ranges of them are skipped for being too small or too large; the answers of a set
come from those of the set before it where the two are alike, by adding and
taking off only the lists of the shingles in which they differ. Equal sets are
one class from the start.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemart.llm.components import smallest_reachable
from tidemart.llm.ranges import MASK, low_bits_mask, stored
from tidemart.llm.texts import SPACES, Words, mix, pieces_of, utf8, windows

WORDS = 5
NUMERATOR, DENOMINATOR = 3, 4
RANK_BITS = 4
SURPLUS = 12
SIZE_STEPS = 8
HOT_LIST = 50_000
FLUSH = 500_000
ENTRIES = 1 << 15
FREQUENT = 1 << 16
FREQUENT_WORDS = 1 << 16
BLOCK = 512
ANCHORS = 8
SUPPORT_ROUNDS = 2


def needed(n: int) -> int:
    """The least overlap of a set of n with any set it links to."""
    return -(-NUMERATOR * n // DENOMINATOR)


def surplus(n: int) -> int:
    """How many shingles more than one two linked prefixes share, for the smaller set's n."""
    return max(1, n // SURPLUS)


def prefix_length(n: int) -> int:
    """How many of the rarest shingles are indexed for a set of n.

    With so many, two linked sets share ``surplus`` of the smaller one's size in
    their prefixes, and not only one: the last of that many shared shingles has
    the rest of the needed overlap behind it.
    """
    return min(n, n - needed(n) + surplus(n))


def rarity_order(docs: DataFrame, text: str) -> tuple:
    """What makes an ``Order`` of shingles by how often they are to be expected, from counts over all rows.

    Each task reports the words that are frequent in it, and the shingles that
    several of its rows hold; sums of these decide. The tables are of bounded
    size. They only say what comes late in the order: any fixed choice gives the
    same links, a good one makes the index lists short.
    """

    def run(batches):
        shingle_runs: list[np.ndarray] = []
        word_runs: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for piece in pieces_of(batch, 0):
                h, bounds, words, hashes = shingles(*utf8(piece.column(0)))
                shingle_runs += [np.unique(h[a:b]) for a, b in itertools.pairwise(bounds.tolist()) if b > a]
                word_runs.append(hashes)
                held += len(h)
                if held > 1_000_000:
                    yield from reports(shingle_runs, word_runs)
                    shingle_runs, word_runs, held = [], [], 0
        if held:
            yield from reports(shingle_runs, word_runs)

    def reports(shingle_runs, word_runs):
        words = np.concatenate(word_runs)
        yield _often(np.concatenate(shingle_runs), 4, 0)
        yield _often(words, max(4, len(words) // 200_000), 1)
        yield pa.RecordBatch.from_arrays([pa.array([2], pa.int32()), pa.array([0]), pa.array([len(words)])], ["kind", "h", "n"])

    found = docs.select(text).mapInArrow(run, "kind int, h long, n long").groupBy("kind", "h").agg(F.sum("n").alias("n"))
    found = stored(found, "frequent")
    total = (found.where("kind = 2").agg(F.sum("n")).first()[0] or 0) + 1
    h, n = _most(found.where("kind = 0"), FREQUENT)
    words, times = _most(found.where("kind = 1"), FREQUENT_WORDS)
    bits = np.round(4 * np.log2(total / np.maximum(times, 1))).astype(np.int64)
    return h, n, words, bits, int(np.round(4 * np.log2(total)))


def _often(values: np.ndarray, least: int, kind: int) -> pa.RecordBatch:
    values, n = np.unique(values, return_counts=True)
    some = n >= least
    kinds = pa.array(np.full(some.sum(), kind, np.int32))
    return pa.RecordBatch.from_arrays([kinds, pa.array(values[some].view(np.int64)), pa.array(n[some].astype(np.int64))], ["kind", "h", "n"])


def _most(found: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent values, at most ``size``, in ascending order, and their counts."""
    level = F.floor(F.log2("n")).cast("int")
    least, held = 64, 0
    for r in sorted(found.groupBy(level.alias("level")).count().collect(), reverse=True):
        if held + r["count"] > size:
            break
        held, least = held + r["count"], r["level"]
    top = found.where(level >= least).toArrow()
    h, n = top.column("h").to_numpy().view(np.uint64), top.column("n").to_numpy()
    order = np.argsort(h)
    return h[order], n[order]


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, Words, np.ndarray]:
    """Hashes of all word shingles (60 bits), repeated ones included, the row bounds in them, the words and theirs."""
    words = Words(data, offsets, SPACES)
    hashes = words.hashes()
    h, bounds = windows(hashes, words.bounds, WORDS, short=True)
    return h >> np.uint64(RANK_BITS), bounds, words, hashes


def _find(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of values in a sorted table, and whether they are there."""
    if not len(table):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


class Order:
    """Sort keys of shingles: rank above, hash below; the rarest come first.

    A shingle's rank follows its count if that is known to be large, and else the
    product of its words' shares. All sums are of whole numbers, so a shingle has
    the same key wherever it stands.
    """

    def __init__(self, h=None, n=None, words=None, bits=None, total: int = 0):
        none = np.zeros(0, np.uint64)
        self.h, self.words = (none if h is None else h), (none if words is None else words)
        self.n = 4 * np.log2(np.maximum(n, 1)) if n is not None else np.zeros(0)
        self.bits, self.total = bits, total
        # hashes of shingles whose index lists are too long for one task
        self.hot = self.h[n >= HOT_LIST] if n is not None else none

    def keys(self, h: np.ndarray, bounds: np.ndarray, words: Words, hashes: np.ndarray) -> np.ndarray:
        if not self.total:
            return h
        at, there = _find(self.words, hashes)
        bits = np.where(there, self.bits[at], self.total) if len(self.words) else np.full(len(hashes), self.total)
        upto = np.concatenate([[0], np.cumsum(bits)])
        row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        start = words.bounds[:-1][row] + np.arange(len(h)) - bounds[:-1][row]
        stop = np.minimum(start + WORDS, words.bounds[1:][row])
        expected = self.total - (upto[stop] - upto[start])
        at, there = _find(self.h, h)
        if len(self.h):
            expected = np.where(there, np.maximum(expected, self.n[at].astype(np.int64)), expected)
        # quarters of a doubling: 2^-100 to 2^28 in sixteen steps
        rank = np.clip((expected + 400) // 32, 0, (1 << RANK_BITS) - 1).astype(np.uint64)
        return h | (rank << np.uint64(64 - RANK_BITS))


def whole(shared) -> Order:
    """The order whose parts are broadcast, made once in each process: a worker needs no copy of this package."""
    if not hasattr(shared, "_order"):
        shared._order = Order(*shared.value)
    return shared._order


def row_sets(data: np.ndarray, offsets: np.ndarray, order: Order) -> list[np.ndarray]:
    h, bounds, words, hashes = shingles(data, offsets)
    keys = order.keys(h, bounds, words, hashes)
    return [np.unique(keys[a:b]) for a, b in itertools.pairwise(bounds.tolist())]


class Lists:
    """Index lists of the shingles of some sets, which come sorted by size: per shingle the ascending places of its sets.

    ``counts`` looks at a range of places only: in each list the entries before
    and behind the range are skipped by a search. ``touched`` counts the entries read.
    """

    def __init__(self, sets: list[np.ndarray]):
        self.n = max(len(sets), 1)
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.tokens, self.inverse = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        # a list's entries stand together, in the order of the places
        self.entries = np.sort(self.inverse * self.n + owner)
        self.cuts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.touched = 0

    def own(self, i: int) -> np.ndarray:
        """The lists that set ``i`` is in, in ascending order."""
        return np.sort(self.inverse[self.cuts[i] : self.cuts[i + 1]])

    def of(self, other: np.ndarray) -> np.ndarray:
        """The lists of another set's shingles, in ascending order."""
        at = np.minimum(np.searchsorted(self.tokens, other), len(self.tokens) - 1)
        return np.sort(at[self.tokens[at] == other])

    def counts(self, lists: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """For each place from ``lo`` up to ``hi`` the number of ``lists`` it is in."""
        if hi <= lo or not len(lists):
            return np.zeros(max(hi - lo, 0), np.int64)
        first = np.searchsorted(self.entries, lists * self.n + lo)
        lengths = np.searchsorted(self.entries, lists * self.n + hi) - first
        at = np.repeat(first - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        self.touched += len(at)
        return np.bincount(self.entries[at] % self.n - lo, minlength=hi - lo)

    def fitting(self, size: int) -> tuple[int, int]:
        """The range of places whose sets are of a size that can link to one of ``size``."""
        lo = int(np.searchsorted(self.sizes * DENOMINATOR, size * NUMERATOR, "left"))
        return lo, int(np.searchsorted(self.sizes * NUMERATOR, size * DENOMINATOR, "right"))


class Answers:
    """Overlaps of one set after the other with a range of places, each derived from the answers before it.

    Ranges move on and never back. Where the set is much like the one before, only the lists in which the two
    differ are read for the places that both look at, and all lists only for the places that are new.
    """

    def __init__(self, lists: Lists):
        self.lists, self.before = lists, None

    def next(self, mine: np.ndarray, lo: int, hi: int) -> np.ndarray:
        if self.before is not None:
            known, start, answers = self.before
            stop = start + len(answers)
            gone, new = np.setdiff1d(known, mine, assume_unique=True), np.setdiff1d(mine, known, assume_unique=True)
            if len(gone) + len(new) <= len(mine) and start <= lo <= stop <= hi:
                kept = answers[lo - start :] - self.lists.counts(gone, lo, stop) + self.lists.counts(new, lo, stop)
                answers = np.concatenate([kept, self.lists.counts(mine, stop, hi)])
                self.before = mine, lo, answers
                return answers
        answers = self.lists.counts(mine, lo, hi)
        self.before = mine, lo, answers
        return answers


def _overlaps(lists: Lists) -> Iterator[tuple[int, np.ndarray, int]]:
    """For each set in order of size: its place, its overlaps with later ones of fitting sizes, and the first of them."""
    answers = Answers(lists)
    for i in range(len(lists.sizes)):
        hi = lists.fitting(int(lists.sizes[i]))[1]
        yield i, answers.next(lists.own(i), i + 1, max(hi, i + 1)), i + 1


def _roots(n: int, pairs: Iterator[tuple[int, int]]) -> list[int]:
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def block_links(sets: list[np.ndarray]) -> list[int]:
    """For each set of a block the first one it is tied to by links inside the block.

    Sets are visited in an order of size and of first shingles, which puts copies
    with small changes next to each other.
    """
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), sets[i][:1].tobytes()))
    ranked = [sets[i] for i in order]
    sizes = np.array([len(s) for s in ranked])

    def pairs():
        for i, overlap, lo in _overlaps(Lists(ranked)):
            union = sizes[i] + sizes[lo : lo + len(overlap)] - overlap
            for j in (np.flatnonzero(overlap * DENOMINATOR >= union * NUMERATOR) + lo).tolist():
                yield order[i], order[j]

    return _roots(len(sets), pairs())


def cross_links(left: list[np.ndarray], right: list[np.ndarray]) -> list[tuple[int, int]]:
    """All links between two lists of sets; both sides go by size, see ``Lists`` and ``Answers``."""
    out = []
    if not left or not right:
        return out
    rank = [sorted(range(len(side)), key=lambda i: (len(side[i]), side[i][:1].tobytes())) for side in (left, right)]
    lists = Lists([left[i] for i in rank[0]])
    answers = Answers(lists)
    for j in rank[1]:
        lo, hi = lists.fitting(len(right[j]))
        overlap = answers.next(lists.of(right[j]), lo, hi)
        union = lists.sizes[lo:hi] + len(right[j]) - overlap
        hit = np.flatnonzero(overlap * DENOMINATOR >= union * NUMERATOR) + lo
        out += [(rank[0][i], j) for i in hit.tolist()]
    return out


def document_sets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(k, t, n, sig) of every row: hash of its text, size and signature of its set."""
    plain = Order()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces_of(batch, 1):
                sets = row_sets(*utf8(piece.column(1)), plain)
                n = pa.array([len(s) for s in sets], pa.int64())
                sig = pa.array([signature(s) for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(2), n, sig], names=["k", "t", "n", "sig"])

    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("text"), F.xxhash64(text).alias("t"))
    return rows.mapInArrow(run, "k long, t long, n long, sig long")


def signature(keys: np.ndarray) -> int:
    """One signed 64-bit value of a whole set, whatever the ranks in its keys."""
    if not len(keys):
        return 0
    h = keys & np.uint64((1 << (64 - RANK_BITS)) - 1)
    total = mix(h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(len(h))).sum(dtype=np.uint64)
    return int(mix(np.array([total + np.uint64(len(h))]))[0].astype(np.int64))


def size_code(n: int) -> int:
    """Sizes that two linked sets can have differ by at most SIZE_STEPS + 1 here."""
    return int(SIZE_STEPS * math.log(n) / math.log(DENOMINATOR / NUMERATOR) + 1e-9)


def _prefixes(batches: Iterator[pa.RecordBatch], order: Order, hot: bool) -> Iterator[tuple[np.ndarray, ...]]:
    """(tokens, size codes, signatures) of the indexed shingles, in runs of some millions; equal sets of a run count once."""
    tokens: list[np.ndarray] = []
    codes: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    seen: set[int] = set()
    held = 0

    def taken():
        return np.concatenate(tokens), np.concatenate(codes), np.concatenate(owners)

    for batch in batches:
        for piece in pieces_of(batch, 0):
            for s in row_sets(*utf8(piece.column(0)), order):
                sig = signature(s)
                if len(s) and sig not in seen:
                    seen.add(sig)
                    own = s[: prefix_length(len(s))]
                    if len(order.hot):
                        own = own[_find(order.hot, own & np.uint64((1 << (64 - RANK_BITS)) - 1))[1] == hot]
                    tokens.append(own)
                    codes.append(np.full(len(own), size_code(len(s)), np.uint16))
                    owners.append(np.full(len(own), sig, np.int64))
                    held += len(own)
            if held > FLUSH:
                yield taken()
                tokens, codes, owners, held = [], [], [], 0
                seen.clear()
    if tokens:
        yield taken()


def shared_lists(docs: DataFrame, order, text: str, buckets: int) -> DataFrame:
    """(lead, sig, m): in the lists led by ``lead`` that hold a set of a size it can link to, ``sig`` stands m times.

    Nearly all indexed shingles stand in one set only. So each task packs its
    entries by bucket of the shingle, 14 bytes each, and the bucket's task keeps
    what occurs in several sets of like size. Shingles are told apart by 32 bits and the
    bucket there: a list with strangers costs a comparison, no more. Lists that
    may outgrow a task go another way (``hot_lists``). Signatures are random, so
    the smallest one of a list is a leader chosen by lot.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, codes, owners in _prefixes(batches, whole(order), False):
            h = mix(tokens)
            bucket = (h % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            short, codes, owners = (h >> np.uint64(32)).astype(np.uint32)[by], codes[by], owners[by]
            cuts = np.searchsorted(bucket[by], np.arange(buckets + 1))
            there = np.flatnonzero(np.diff(cuts))
            for low in range(0, len(there), 256):
                part = there[low : low + 256]
                blobs = [b"".join(x[cuts[i] : cuts[i + 1]].tobytes() for x in (short, codes, owners)) for i in part]
                yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(blobs, pa.binary())], ["bucket", "blob"])

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(bucket, []).append(blob)
        for blobs in held.values():
            counts = [len(b) // 14 for b in blobs]
            token = np.concatenate([np.frombuffer(b, np.uint32, m) for b, m in zip(blobs, counts)])
            code = np.concatenate([np.frombuffer(b, np.uint16, m, 4 * m) for b, m in zip(blobs, counts)]).astype(np.int64)
            owner = np.concatenate([np.frombuffer(b, np.int64, m, 6 * m) for b, m in zip(blobs, counts)])
            by = np.lexsort((owner, code, token))
            token, code, owner = token[by], code[by], owner[by]
            same = token[1:] == token[:-1]
            new = np.concatenate([[True], ~same | (owner[1:] != owner[:-1])])
            token, code, owner = token[new], code[new], owner[new]
            # the nearest sizes of a list stand next to each other
            near = (token[1:] == token[:-1]) & (np.diff(code) <= SIZE_STEPS + 1)
            some = np.concatenate([[False], near]) | np.concatenate([near, [False]])
            token, owner = token[some], owner[some]
            starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))[: len(token)]
            lead = np.repeat(np.minimum.reduceat(owner, starts), np.diff(np.append(starts, len(token)))) if len(token) else owner
            # one row for each entry: what is folded must not depend on how many buckets there are
            for at in range(0, len(lead), ENTRIES):
                yield pa.RecordBatch.from_arrays([pa.array(lead[at : at + ENTRIES]), pa.array(owner[at : at + ENTRIES])], ["lead", "sig"])

    packed = docs.select(text).mapInArrow(pack, "bucket int, blob binary")
    found = packed.repartitionById(buckets, F.col("bucket")).mapInArrow(lists, "lead long, sig long")
    found = found.groupBy("lead", "sig").agg(F.count(F.lit(1)).alias("m"))
    if len(whole(order).hot):
        found = found.unionByName(hot_lists(docs, order, text))
    return found


def hot_lists(docs: DataFrame, order, text: str) -> DataFrame:
    """The same for the shingles of very many sets, by a partial minimum and a join whose large keys can be split."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, _, owners in _prefixes(batches, whole(order), True):
            yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(owners)], ["token", "sig"])

    entries = stored(docs.select(text).mapInArrow(rows, "token long, sig long").distinct(), "hot")
    leads = entries.groupBy("token").agg(F.min("sig").alias("lead"), F.max("sig").alias("last")).where("lead < last")
    return entries.join(leads, "token").groupBy("lead", "sig").agg(F.count(F.lit(1)).alias("m"))


def sets_of(docs: DataFrame, wanted: DataFrame, order, key: str, text: str) -> DataFrame:
    """``wanted`` (sig, k and others) with ``keys`` for ``k``: each class's set, made again from the text of row ``k``.

    The sets are sent once, to the rows that want them.
    """
    spark = docs.sparkSession
    mask = spark.sparkContext.broadcast(low_bits_mask(wanted, "k"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = np.array(batch.column(0).fill_null(0), np.int64)
            some = batch.filter(pa.array(mask.value[k & (MASK)]))
            for piece in pieces_of(some, 1):
                sets = row_sets(*utf8(piece.column(1)), whole(order))
                full = pa.array([len(s) > 0 for s in sets])
                out = pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array([signature(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["k", "sig", "keys"],
                )
                yield out.filter(full)

    found = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("text")).mapInArrow(run, "k long, sig long, keys binary")
    same = (found["sig"] == wanted["sig"]) & found["k"].eqNullSafe(wanted["k"])
    return found.join(wanted, same).select(*[wanted[c] for c in wanted.columns if c != "k"], found["keys"])


def _groups(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal first ``width`` columns, of rows that come sorted by them."""

    def rows():
        for batch in batches:
            yield from zip(*[c.to_pylist() for c in batch.columns])

    for name, group in itertools.groupby(rows(), key=lambda r: r[:width]):
        yield name, [r[width:] for r in group]


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64())], ["a", "b"]
    )


def supported(rows: DataFrame, least) -> DataFrame:
    """The rows (lead, sig, n, k, m) of sets that may still share ``least`` entries with one other set, with ``c``.

    Two sets share no more entries in a family than the one with fewer has there.
    So ``c`` is a set's m or the largest m of the others, and a set whose sum over
    its families is below ``least`` links to nothing. Strangers, who meet a set in
    one list each, do not add up in the family that it leads.
    """
    rows = rows.select("lead", "sig", "n", "k", "m")
    top = rows.groupBy("lead").agg(F.max(F.struct("m", "sig")).alias("top"))
    rows = rows.join(top, "lead")
    second = rows.where(F.col("sig") != F.col("top.sig")).groupBy("lead").agg(F.max("m").alias("second"))
    others = F.when(F.col("sig") == F.col("top.sig"), F.col("second")).otherwise(F.col("top.m"))
    rows = rows.join(second, "lead").select("lead", "sig", "n", "k", "m", F.least("m", others).alias("c"))
    enough = rows.groupBy("sig").agg(F.sum("c").alias("all"), F.first("n").alias("n")).where(F.col("all") >= least)
    return rows.join(enough.select("sig"), "sig", "left_semi")


def class_links(docs: DataFrame, classes: DataFrame, order, key: str, text: str) -> DataFrame:
    """Edges (a, b) between class signatures that tie together whatever links tie together."""
    n_tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = shared_lists(docs, order, text, n_tasks)
    if len(whole(order).hot):
        lists = lists.groupBy("lead", "sig").agg(F.sum("m").alias("m"))
    lists = stored(lists, "lists")
    shared = lists.groupBy("sig").agg(F.sum("m").alias("m"))
    # a set that links to another shares that many indexed shingles, whatever the other's size
    least = F.greatest(F.floor(F.ceil(F.col("n") * NUMERATOR / DENOMINATOR) / SURPLUS), F.lit(1))
    alive = shared.join(classes, "sig").where(F.col("m") >= least).select("sig", "n", F.col("low").alias("k"))
    alive = stored(alive, "alive")
    rows = lists.join(alive, "sig")
    for _ in range(SUPPORT_ROUNDS):
        rows = stored(supported(rows, least), "supported")
    # Of all the entries that two linked sets share, each of the two may leave out fewer than half, so that one list at
    # least is left to both: a set leaves the families it can share the fewest entries in.
    upto = F.sum("c").over(W.partitionBy("sig").orderBy("c", "lead").rowsBetween(W.unboundedPreceding, W.currentRow))
    members = rows.withColumn("upto", upto).where(F.col("upto") > F.floor((least - 1) / 2))
    members = stored(members.select("lead", "sig", "n"), "families")
    counts = members.groupBy("lead").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = members.join(counts, "lead")
    # large families: sizes that cannot link are told apart, the rest is dealt into blocks by lot
    zone = F.floor(F.log(F.col("n").cast("double")) / math.log(DENOMINATOR / NUMERATOR) + 1e-9).cast("int")
    members = members.select("lead", "sig", F.when(F.col("size") <= BLOCK, F.lit(-1)).otherwise(zone).alias("zone"))
    parts = members.groupBy("lead", "zone").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    members = members.join(parts, ["lead", "zone"])
    own = members.select("lead", "zone", F.pmod(F.xxhash64("sig", "lead"), "parts").cast("int").alias("block"), "sig", "parts")
    own = stored(own, "blocks")
    large = own.where("parts > 1")
    first = W.partitionBy("lead", "zone").orderBy("sig")
    anchors = large.withColumn("at", F.row_number().over(first)).where(F.col("at") <= ANCHORS)
    anchors = anchors.select("lead", "zone", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("block"), "sig")
    dealt = own.where("zone >= 0").select("lead", "zone", "block", "sig").unionByName(anchors).distinct()

    wanted = stored(alive.join(own.select("sig").distinct(), "sig", "left_semi").select("sig", "k"), "wanted")
    sent = stored(family_parts(own.where("zone < 0"), own).join(wanted, "sig"), "sent")
    edges = stored(family_links(sets_of(docs, sent, order, key, text), n_tasks), "links")
    members = own.where("zone >= 0").select("sig").distinct()
    if not members.limit(1).count():
        return edges
    # only the sets of large families are sent again, whatever the number of the others
    nodes = stored(sets_of(docs, stored(wanted.join(members, "sig", "left_semi"), "large"), order, key, text), "nodes")

    def inside(batches):
        for _, rows in _groups(batches, 3):
            if len(rows) > 1:
                yield _rooted([r[0] for r in rows], [np.frombuffer(r[1], np.uint64) for r in rows])

    blocks = dealt.join(nodes, "sig").select("lead", "zone", "block", "sig", "keys")
    blocks = blocks.repartition(n_tasks, "lead", "zone", "block").sortWithinPartitions("lead", "zone", "block")
    edges = edges.unionByName(stored(blocks.mapInArrow(inside, "a long, b long"), "links"))
    return edges.unionByName(far_links(own, nodes, smallest_reachable(edges), n_tasks))


def _rooted(names: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
    """Edges from the sets of a block to the first ones they are tied to."""
    return _edges([(names[i], names[r]) for i, r in enumerate(block_links(sets)) if i != r])


def family_parts(small: DataFrame, members: DataFrame) -> DataFrame:
    """(home, part, sig, leads): the families of one block, with one row for each set and home.

    The home of a family is the smallest lead among the families that its lead is a
    member of: sets that are alike are in each other's families, which so come
    together. A home is cut by lead into parts of a bounded number of rows.
    """
    homes = members.groupBy(F.col("sig").alias("lead")).agg(F.min("lead").alias("home"))
    rows = small.select("lead", "sig").join(homes, "lead", "left").withColumn("home", F.coalesce("home", "lead"))
    parts = rows.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / (2 * BLOCK)).alias("parts"))
    rows = rows.join(parts, "home").withColumn("part", F.pmod(F.xxhash64("lead"), "parts").cast("int"))
    # the families of one set in one part are no more than the rows of the part
    return rows.groupBy("home", "part", "sig").agg(F.collect_list("lead").alias("leads"))


def family_links(sent: DataFrame, n_tasks: int) -> DataFrame:
    """Links inside the families of ``sent`` (home, part, sig, leads, keys).

    A family that lies within another one of its part has no link of its own.
    """

    def inside(batches):
        for _, own in _groups(batches, 2):
            sets = {name: np.frombuffer(keys, np.uint64) for name, _, keys in own}
            families: dict[int, set[int]] = {}
            for name, leads, _ in own:
                for lead in leads:
                    families.setdefault(lead, set()).add(name)
            done: dict[int, list[set[int]]] = {}
            for family in sorted(families.values(), key=len, reverse=True):
                some = min(family, key=lambda name: len(done.get(name, ())))
                if len(family) < 2 or any(family <= other for other in done.get(some, ())):
                    continue
                for name in family:
                    done.setdefault(name, []).append(family)
                names = sorted(family)
                yield _rooted(names, [sets[name] for name in names])

    sent = sent.select("home", "part", "sig", "leads", "keys").repartition(n_tasks, "home", "part")
    return sent.sortWithinPartitions("home", "part").mapInArrow(inside, "a long, b long")


def far_links(own: DataFrame, nodes: DataFrame, roots: DataFrame, n_tasks: int) -> DataFrame:
    """Links between the blocks of large families, where their members are not tied together yet.

    The members outside the largest component of their family are compared with
    all blocks of the sizes they can link to; pairs already tied need no look.
    """
    members = own.where("zone >= 0").select("lead", "zone", "block", "sig")
    members = members.join(roots, members["sig"] == roots["node"], "left")
    members = members.select("lead", "zone", "block", "sig", F.coalesce("root", "sig").alias("root"))
    per_root = members.groupBy("lead", "root").agg(F.count(F.lit(1)).alias("n"))
    main = per_root.groupBy("lead").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count(F.lit(1)).alias("roots"))
    open_ = members.join(main.where("roots > 1"), "lead")
    minor = open_.where("root <> main").select("lead", F.col("zone").alias("from"), "sig")
    chunks = minor.groupBy("lead").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("chunks"))
    minor = minor.join(chunks, "lead").withColumn("chunk", F.pmod(F.xxhash64("sig"), "chunks").cast("int"))
    near = F.explode(F.array(F.col("from") - 1, F.col("from"), F.col("from") + 1)).alias("zone")
    minor = minor.select("lead", near, "chunk", "sig")
    places = open_.select("lead", "zone", "block").distinct()
    right = minor.join(places, ["lead", "zone"]).select("lead", "zone", "block", "chunk", "sig", F.lit(1).alias("side"))
    tasks = right.select("lead", "zone", "block", "chunk").distinct()
    left = open_.select("lead", "zone", "block", "sig").join(tasks, ["lead", "zone", "block"])
    left = left.select("lead", "zone", "block", "chunk", "sig", F.lit(0).alias("side"))

    def between(batches):
        for _, rows in _groups(batches, 4):
            sides: tuple[list, list] = ([], [])
            for name, side, keys in rows:
                sides[side].append((name, np.frombuffer(keys, np.uint64)))
            pairs = cross_links([s for _, s in sides[0]], [s for _, s in sides[1]])
            yield _edges([(sides[0][i][0], sides[1][j][0]) for i, j in pairs])

    both = left.unionByName(right).join(nodes, "sig").select("lead", "zone", "block", "chunk", "sig", "side", "keys")
    both = both.repartition(n_tasks, "lead", "zone", "block", "chunk").sortWithinPartitions("lead", "zone", "block", "chunk")
    return stored(both.mapInArrow(between, "a long, b long"), "far")


def link_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, component_id (the smallest key reachable by links), text_hash.

    Words are runs without ASCII blanks, A-Z lower-cased. A set has the distinct
    five-word shingles; with one to four words the whole sequence is the only
    one. Two rows link if their sets' intersection is at least three quarters of
    their union; sets are compared by 60-bit hashes of their shingles. Null texts
    and texts without words have an empty set and only reach themselves. Rows
    with equal sets link, whatever their keys. A row with a null key takes part,
    and shows the smallest key of its component, null if there is none. Repeated
    rows come out as often as they came in. Very long texts are taken whole. An
    empty table gives an empty result. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(rarity_order(docs, text))
    sets = stored(document_sets(docs, key, text), "sets")
    classes = stored(sets.where("n > 0").groupBy("sig", "n").agg(F.min("k").alias("low")), "classes")
    roots = smallest_reachable(class_links(docs, classes, shared, key, text))
    labelled = classes.join(roots, classes["sig"] == roots["node"], "left").select(
        "sig", "n", "low", F.coalesce("root", "sig").alias("root")
    )
    lowest = labelled.groupBy("root").agg(F.min("low").alias("component"))
    labelled = labelled.join(lowest, "root").select(F.col("sig").alias("s"), F.col("n").alias("m"), "component")
    out = sets.select("k", "t", "n", "sig").join(labelled, (F.col("sig") == F.col("s")) & (F.col("n") == F.col("m")), "left")
    return out.select(F.col("k").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "k").alias("component_id"), F.col("t").alias("text_hash"))


def keep_one_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that link, through others or not, to a row with a smaller key.

    Of repeated rows (same key and text) one stays. Rows with empty sets all stay.
    """
    found = link_components(docs, key, text)
    stay = found.where(F.col(key).eqNullSafe(F.col("component_id"))).groupBy(F.col(key).alias("k"), F.col("text_hash").alias("t"))
    stay = stored(stay.agg(F.count(F.lit(1)).alias("rows"), F.max("n_shingles").alias("n")), "stay")
    same = docs[key].eqNullSafe(stay["k"]) & (F.xxhash64(docs[text]) == stay["t"])
    kept = docs.join(stay, same, "left_semi")
    # keys are unique as a rule; only if some are not, repeated rows are looked for
    if stay.where("n > 0").groupBy("k").agg(F.sum("rows").alias("rows")).where("rows > 1").limit(1).count():
        whole = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])))
        first = W.partitionBy(key, F.xxhash64(text)).orderBy(whole)
        blank = ~F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
        kept = kept.withColumn("__at", F.row_number().over(first)).where((F.col("__at") == 1) | blank).drop("__at")
    return kept
