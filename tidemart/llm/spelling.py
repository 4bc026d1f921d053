"""Words one edit apart, by pairs of trie nodes, and the most frequent form each belongs to.

Nodes of the trie of all words, and of the trie of all reversed words, get
integers. A word split between two letters is a pair (prefix node, suffix node);
a word with one letter skipped is such a pair too. Two words that share the pair
of a skipped place differ by a replaced letter; a skipped pair that equals a split
pair is a letter more or less. Equal integers mean equal strings, so that no
candidate needs a check.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemart.llm.ranges import default_ranges, stored
from tidemart.llm.texts import pieces_of

RUNS = "[A-Za-zÀ-ÿ]+"
ABC = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(ABC, ABC.lower())
# A task gives its counts on when it holds so many different words.
HELD_WORDS = 200_000
HELD_PAIRS = 50_000
PAIRS = "a long, b long, split boolean, first boolean, rank long, n long"


def misspell(key: int | str | None, word: str, every: int) -> str:
    """The word, without one letter where ``every`` divides the crc32 of ``key:word`` (no key: of ``:word``)."""
    h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def count_words(
    docs: DataFrame, key: str = "doc_id", text: str = "text", pattern: str = RUNS, least_length: int = 5, drop_every: int = 97
) -> DataFrame:
    """Words (``word``) and how often they come (``n``), over all whole texts.

    A word is a run of letters with A-Z lower-cased. ``drop_every`` takes a letter
    out of a known share of them (0: out of none). Counts are summed per document
    and per task before the exchange, in bounded memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, counts = re.compile(pattern).findall, Counter()

        def flush():
            words, sums = pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())
            counts.clear()
            return pa.RecordBatch.from_arrays([words, sums], names=["word", "n"])

        for batch in batches:
            for piece in pieces_of(batch, "text"):
                for id_, body in zip(piece.column("k").to_pylist(), piece.column("text").to_pylist()):
                    for run_, n in Counter(find(body or "")).items():
                        # a run that is too short stays so
                        if len(run_) < least_length:
                            continue
                        word = run_.lower() if run_.isascii() else run_.translate(LOWER)
                        if drop_every:
                            word = misspell(id_, word, drop_every)
                        if len(word) >= least_length:
                            counts[word] += n
                    if len(counts) > HELD_WORDS:
                        yield flush()
        yield flush()

    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Trie:
    """Numbers of trie nodes, met in the order of the words: the root is 0, a node gets the next number when first met.

    ``path`` has the nodes of the last word as runs (depth of the first, its
    number); numbers of a run follow each other.
    """

    def __init__(self, word: str = "", path: list[tuple[int, int]] | None = None, following: int = 1):
        self.word, self.path, self.following = word, list(path or [(0, 0)]), following

    def add(self, word: str) -> None:
        shared = len(commonprefix((self.word, word)))
        while self.path[-1][0] > shared:
            self.path.pop()
        if len(word) > shared:
            self.path.append((shared + 1, self.following))
            self.following += len(word) - shared
        self.word = word

    def nodes(self) -> list[int]:
        """The node of each prefix of the last word, from none to all of its letters."""
        out: list[int] = []
        ends = [depth for depth, _ in self.path[1:]] + [len(self.word) + 1]
        for (depth, number), end in zip(self.path, ends):
            out.extend(range(number, number + end - depth))
        return out


def follow(before: Trie, first: str, part: Trie) -> Trie:
    """The trie after a part that began with ``first`` and was numbered alone, if it comes after ``before``."""
    known = len(commonprefix((before.word, first)))
    shift = before.following - 1 - known
    met = Trie(before.word, before.path, before.following)
    # what the part's last word shares with its first one and with the word before was numbered earlier
    same = min(known, len(commonprefix((first, part.word))))
    while met.path[-1][0] > same:
        met.path.pop()
    ends = [depth for depth, _ in part.path[1:]] + [len(part.word) + 1]
    for (depth, number), end in zip(part.path, ends):
        start = max(depth, same + 1)
        if start < end:
            met.path.append((start, number + start - depth + shift))
    met.word, met.following = part.word, part.following + shift
    return met


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple]]]:
    rows = (r for b in batches for r in zip(*[c.to_pylist() for c in b.columns]))
    return itertools.groupby(rows, key=lambda r: r[0])


def in_trie_order(words: DataFrame, spelled: Column, give, schema: str) -> DataFrame:
    """``give(rank, nodes, row)`` for each row, in the order of ``spelled``, with the nodes of its trie.

    Ranges of the order are sorted and numbered alone, one row of each comes to the
    driver (its size, first and last word and the last one's path), and each range is
    then numbered again from where the one before ended.
    """
    n = default_ranges(words)
    dealt = words.select(spelled.alias("s"), *words.columns).repartitionByRange(n, "s")
    dealt = stored(dealt.select(F.spark_partition_id().alias("part"), "*"), "ordered")
    ordered = dealt.repartitionById(n, F.col("part")).sortWithinPartitions("part", "s")

    def summarise(batches):
        for part, own in _parts(batches):
            trie, rows, first = Trie(), 0, None
            for row in own:
                first = row[1] if first is None else first
                trie.add(row[1])
                rows += 1
            path = [x for run in trie.path for x in run]
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "rows": [rows], "first": [first], "last": [trie.word], "path": [path],
                 "following": [trie.following]}
            )

    kind = "part int, rows long, first string, last string, path array<long>, following long"
    starts: dict[int, tuple] = {}
    met, rank = Trie(), 0
    for r in sorted(ordered.select("part", "s").mapInArrow(summarise, kind).collect()):
        starts[r.part] = (rank, met.word, met.path, met.following)
        met = follow(met, r.first, Trie(r.last, list(zip(r.path[::2], r.path[1::2])), r.following))
        rank += r.rows

    def number(batches):
        for part, own in _parts(batches):
            at, *start = starts[part]
            trie = Trie(*start)

            def rows():
                for i, row in enumerate(own):
                    trie.add(row[1])
                    yield from give(at + i, trie.nodes(), row[2:])

            made = rows()
            while some := list(itertools.islice(made, HELD_PAIRS)):
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*some), types)], names=names)

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    names, types = arrow.names, arrow.types
    return ordered.mapInArrow(number, schema)


def node_pairs(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Words with their ``rank`` in code-point order, and the pairs of all places of each word.

    A pair has ``a`` (node before the place), ``b`` (node of the reversed rest),
    ``split`` (between two letters; else one is skipped) and ``first`` (the skipped
    letter is the first of a run of the same letter, so that each shorter word has
    one pair). 2 l + 1 pairs for a word of l letters.
    """

    def forward(rank, nodes, row):
        yield (row[0], row[1], rank, nodes)

    ranked = stored(
        in_trie_order(words.select("word", "n"), F.col("word"), forward, "word string, n long, rank long, nodes array<long>"), "ranked"
    )

    def backward(_, ends, row):
        word, n, rank, nodes = row
        size = len(word)
        for i in range(size):
            yield nodes[i], ends[size - i - 1], False, i == 0 or word[i] != word[i - 1], rank, n
        for i in range(size + 1):
            yield nodes[i], ends[size - i], True, False, rank, n

    return ranked.select("word", "n", "rank"), in_trie_order(ranked, F.reverse("word"), backward, PAIRS)


def near_words(pairs: DataFrame) -> DataFrame:
    """Per word (``rank``) with near words: their number ``n_near``, and of the best its count and rank, ``best``.

    Rows of one pair are a split word, if any, and words that differ in the one
    skipped letter: no more than there are letters. Each row looks at its group's
    two best ones and the group's counts; no list of all near pairs is made.
    """
    skip, member = ~F.col("split"), F.struct("n", (-F.col("rank")).alias("back"))
    own = Window.partitionBy("a", "b")
    ranked = own.orderBy("split", F.desc("n"), "rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = pairs.select(
        "rank", "split", "first",
        F.count(F.lit(1)).over(ranked).alias("members"),
        F.sum(skip.cast("long")).over(ranked).alias("skips"),
        F.sum(F.col("first").cast("long")).over(ranked).alias("firsts"),
        F.nth_value(member, 1).over(ranked).alias("top"),
        F.nth_value(member, 2).over(ranked).alias("next"),
        F.max(F.when(F.col("split"), member)).over(ranked).alias("shorter"),
        F.max(F.when(F.col("first"), member)).over(ranked).alias("longer"),
    ).where("members > 1")
    other = F.when(F.col("skips") > 1, F.when(F.col("top.back") == -F.col("rank"), F.col("next")).otherwise(F.col("top")))
    below = F.when(F.col("first"), F.col("shorter"))
    rows = rows.select(
        "rank",
        F.when(F.col("split"), F.col("firsts"))
        .otherwise(F.col("skips") - 1 + F.when(below.isNotNull(), 1).otherwise(0)).alias("near"),
        F.when(F.col("split"), F.col("longer")).otherwise(F.greatest(other, below)).alias("best"),
    )
    return rows.where("near > 0").groupBy("rank").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))


def last_forms(links: DataFrame) -> DataFrame:
    """Per ``rank`` with a form, the last one on the way, ``to``: each round doubles how far a row looks.

    A form is at least twice as frequent as its word, so a way has at most 63 steps: seven rounds.
    """
    links = stored(links, "links")
    while True:
        far = links.select(F.col("rank").alias("to"), F.col("to").alias("beyond"))
        links = links.join(far, "to", "left").select(
            "rank", F.coalesce("beyond", "to").alias("to"), F.col("beyond").isNotNull().alias("moved")
        )
        links = stored(links, "links")
        if links.where("moved").isEmpty():
            return links.select("rank", "to")


def group_spellings(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    pattern: str = RUNS,
    least_length: int = 5,
    least_count: int = 3,
    times: int = 2,
    drop_every: int = 0,
) -> DataFrame:
    """Per word: ``n``, its form and root, ``n_near`` and ``form_n``.

    Words are the runs of letters of at least ``least_length`` code points that come
    ``least_count`` times or more over all texts. Near words differ by exactly one
    inserted, deleted or replaced code point. A form is the near word with the
    largest count (then the smallest in code-point order) if that is ``times`` the
    word's own or more; the root is the last form on the way, or the word itself.

    Null and empty texts have no words; texts and words of any length are taken
    whole, at a cost in proportion to their length. Repeated rows count again. A null
    key counts as an empty one for ``drop_every``. An empty table gives an empty
    result. Other columns are not read.
    """
    words = count_words(docs, key, text, pattern, least_length, drop_every)
    words = stored(words.where(F.col("n") >= least_count), "words")
    words, pairs = node_pairs(words)
    near = stored(near_words(pairs), "near")
    met = words.join(near, "rank", "left").select(
        "word", "n", "rank", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("best.n") >= times * F.col("n"), F.col("best")).alias("form"),
    )
    met = stored(met.select("word", "n", "rank", "n_near", F.col("form.n").alias("form_n"), (-F.col("form.back")).alias("to")), "met")
    roots = last_forms(met.where("to is not null").select("rank", "to"))
    named = met.select(F.col("rank").alias("to"), F.col("word").alias("form"))
    last = roots.join(met.select(F.col("rank").alias("to"), F.col("word").alias("root")), "to").select("rank", "root")
    found = met.join(named, "to", "left").join(last, "rank", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
