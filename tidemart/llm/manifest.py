"""A Merkle manifest of a table: leaves, one tree per group, one tree over the groups' roots, proofs.

Time-forward processing. A node's label is (level, place in its level), so that
digests only go to higher labels and proofs only to lower ones. The queue ordered
by label has two tiers. Within a block of ``RUN ** LEVELS`` neighbouring nodes a
heap delivers digests to parents, and in the reversed sweep proof suffixes to
children. Between blocks the queue is external: messages are exchanged and sorted
by (group, block, place), and a block's task reads its messages in that order.
So a round climbs ``LEVELS`` levels, a tree of n leaves takes log(n) / log(4096)
rounds, and a task never holds more than one block. The hot group is many blocks.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemart.llm.ranges import default_ranges, stored

RUN = 16
LEVELS = 3
BLOCK = RUN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
GROUP = ("known", "g")
NODE = "known boolean, g string, pos long, total long, digest binary"


def leaf_digest(fields: Iterable[Column]) -> Column:
    """sha256 of the fields: ``-`` for null, else the length in bytes, ``:`` and the text."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def heights(total: int, levels: int = LEVELS) -> tuple[int, int]:
    """Levels that a group of ``total`` nodes climbs in one round, and its nodes after it."""
    climbed = 0
    while total > 1 and climbed < levels:
        total, climbed = -(-total // RUN), climbed + 1
    return climbed, total


def rise(digests: list[str], climbed: int) -> list[list[str]]:
    """Forward sweep in a block: the digests of each level, the block's own first."""
    levels = [digests] + [[] for _ in range(climbed)]
    queue = [(1, i // RUN, i % RUN, d) for i, d in enumerate(digests)] if climbed else []
    heapq.heapify(queue)
    while queue:
        level, place = queue[0][:2]
        children = []
        while queue and queue[0][:2] == (level, place):
            children.append(heapq.heappop(queue)[3])
        digest = _hash("".join(children))
        levels[level].append(digest)
        if level < climbed:
            heapq.heappush(queue, (level + 1, place // RUN, place % RUN, digest))
    return levels


def sink(levels: list[list[str]], suffix: list[tuple[str, str]]) -> Iterator[tuple[int, str, str, list[tuple[str, str]]]]:
    """Reversed sweep in a block: per bottom node its place, left and right siblings, and the pairs above them.

    Pairs go from the lowest level to the root; all nodes of a run share the list
    above them.
    """
    top = len(levels) - 1
    if top == 0:  # a lone node, which has no siblings in its group
        yield 0, "", "", suffix
        return
    queue: list[tuple[int, int, list]] = [(-top, 0, suffix)]
    while queue:
        level, place, above = heapq.heappop(queue)
        low, start = -level - 1, -place * RUN
        run = levels[low][start : start + RUN]
        for i in range(len(run)):
            left, right = "".join(run[:i]), "".join(run[i + 1 :])
            if low == 0:
                yield start + i, left, right, above
            else:
                heapq.heappush(queue, (-low, -(start + i), [(left, right), *above]))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while some := list(itertools.islice(rows, BLOCK)):
        columns = [pa.array(list(c), f.type) for c, f in zip(zip(*some), schema)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` (with ``known`` and ``g``) and each row's place in its group, ``pos``, and the group's size, ``total``.

    Ranges of (group, order) are cut by a sample, counted, and numbered one by one;
    a prefix sum over the ranges of a group gives their bases.
    """
    n = default_ranges(rows)
    dealt = rows.repartitionByRange(n, *[F.col(c) for c in GROUP], *order)
    dealt = stored(dealt.withColumn("part", F.spark_partition_id()), "ranges")
    parts = Window.partitionBy(*GROUP)
    counts = dealt.groupBy("part", *GROUP).count().select(
        "part",
        *GROUP,
        F.coalesce(F.sum("count").over(parts.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"),
        F.sum("count").over(parts).alias("total"),
    )
    own = Window.partitionBy("part", *GROUP).orderBy(*order)
    placed = dealt.join(counts, ["part", *GROUP])
    return placed.withColumn("pos", F.row_number().over(own) - 1 + F.col("base")).drop("part", "base")


def _by_label(messages: DataFrame) -> DataFrame:
    """The external queue: messages of a block come to one task, sorted by label."""
    return messages.repartition(*GROUP, "block").sortWithinPartitions(*GROUP, "block", "slot")


def climb(nodes: DataFrame, levels: int = LEVELS) -> tuple[list[DataFrame], DataFrame]:
    """Nodes at the start of each round, and the root (``known``, ``g``, ``digest``, ``total`` leaves) of each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tops():
            for (known, g, block), own in itertools.groupby(_rows(batches), key=lambda r: r[:3]):
                own = list(own)
                climbed, after = heights(own[0][4], levels)
                yield known, g, block, after, bytes.fromhex(rise([r[5].hex() for r in own], climbed)[-1][0])

        yield from _batches(tops(), pa.schema([("known", pa.bool_()), ("g", pa.string()), ("pos", pa.int64()), ("total", pa.int64()), ("digest", pa.binary())]))

    rounds, size = [nodes], RUN**levels
    most = nodes.agg(F.max("total")).first()[0] or 0
    while most > 1:
        up = rounds[-1].where("total > 1").withColumn("block", F.floor(F.col("pos") / size)).withColumn("slot", F.col("pos"))
        up = _by_label(up.select(*GROUP, "block", "slot", "total", "digest"))
        rounds.append(stored(up.mapInArrow(run, NODE), "nodes"))
        most = heights(most, levels)[1]
    sizes = nodes.where("pos = 0").select(*GROUP, F.col("total").alias("leaves"))
    roots = [r.where("total = 1").select(*GROUP, "digest") for r in rounds]
    done = roots[0]
    for r in roots[1:]:
        done = done.unionByName(r)
    return rounds, done.join(sizes, list(GROUP))


def descend(rounds: list[DataFrame], tops: DataFrame, finish, schema: str, levels: int = LEVELS) -> DataFrame:
    """Reversed sweep from the groups' roots to the nodes of the first round.

    ``tops`` has ``known``, ``g``, ``leaves`` and the message of each root:
    ``suffix`` (left and right siblings from there to the last root, raw bytes) and
    ``heads`` (what is handed down as it is). ``finish`` gets a row of the first
    round, its left and right siblings, the pairs above them and ``heads``.
    """
    size = RUN**levels
    # a group's root is made in this round
    last = F.lit(0)
    for r in range(1, len(rounds)):
        last = F.when(F.col("leaves") > size**r, r).otherwise(last)
    tops = tops.withColumn("last", last)
    message = "known boolean, g string, pos long, suffix array<binary>, heads array<binary>"
    arrow = pa.schema([("known", pa.bool_()), ("g", pa.string()), ("pos", pa.int64()), ("suffix", pa.list_(pa.binary())), ("heads", pa.list_(pa.binary()))])

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (known, g, _), own in itertools.groupby(_rows(batches), key=lambda r: r[:3]):
            _, _, _, _, _, _, suffix, heads, *_ = next(own)
            nodes = list(own)
            pairs = [(a.hex(), b.hex()) for a, b in zip(suffix[::2], suffix[1::2])]
            found = rise([r[5].hex() for r in nodes], heights(nodes[0][4], levels)[0])
            for i, left, right, above in sink(found, pairs):
                yield known, g, nodes[i], left, right, above, heads

    def hand_down(batches):
        def rows():
            for known, g, node, left, right, above, heads in sweep(batches):
                raw = [bytes.fromhex(x) for pair in [(left, right), *above] for x in pair]
                yield known, g, node[3], raw, heads

        yield from _batches(rows(), arrow)

    def end(batches):
        yield from _batches(finish(sweep(batches)), out)

    out = to_arrow_schema(StructType.fromDDL(schema))
    below = None
    for r in range(len(rounds) - 1, -1, -1):
        nodes = rounds[r] if r == 0 else rounds[r].where("total > 1")
        if r and r == len(rounds) - 1:
            continue  # only roots are left there
        own = tops.where(F.col("last") == r).select(*GROUP, F.lit(0).cast("long").alias("pos"), "suffix", "heads")
        told = own if below is None else own.unionByName(below)
        extra = [c for c in nodes.columns if c not in ("known", "g", "pos", "total", "digest")]
        nothing = [F.lit(None).cast(t).alias(c) for c, t in nodes.dtypes if c in extra]
        queue = nodes.select(
            *GROUP, F.floor(F.col("pos") / size).alias("block"), F.col("pos").alias("slot"), "total", "digest",
            F.lit(None).cast("array<binary>").alias("suffix"), F.lit(None).cast("array<binary>").alias("heads"), *extra,
        ).unionByName(told.select(
            *GROUP, F.col("pos").alias("block"), F.lit(-1).cast("long").alias("slot"), F.lit(None).cast("long").alias("total"),
            F.lit(None).cast("binary").alias("digest"), "suffix", "heads", *nothing,
        ))
        if r:
            below = stored(_by_label(queue).mapInArrow(hand_down, message), "suffixes")
        else:
            below = _by_label(queue).mapInArrow(end, schema)
    return below


def _leaves(docs: DataFrame, group: str, key: str, fields: tuple[str, ...], copy: dict[str, Column]) -> DataFrame:
    source = F.col(group).cast("string")
    rows = docs.select(
        F.col(key).alias("id"),
        source.isNotNull().alias("known"),
        F.coalesce(source, F.lit("")).alias("g"),
        leaf_digest(F.col(f) for f in fields).alias("digest"),
        leaf_digest(copy.get(f, F.col(f)) for f in fields).alias("copied"),
    )
    placed = ranked(stored(rows, "leaves"), [F.asc_nulls_first("id"), F.asc("digest")])
    return stored(placed.select(*GROUP, "pos", "total", "digest", "id", "copied"), "placed")


def _over_groups(roots: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The tree over the groups' roots, in the order of the groups; a node keeps its group as ``of``."""
    one = roots.select(
        F.lit(True).alias("known"), F.lit("").alias("g"), "digest", F.col("known").alias("of_known"), F.col("g").alias("of"), "leaves"
    )
    placed = ranked(stored(one, "subroots"), [F.col("of_known"), F.col("of")])
    return climb(stored(placed.select(*GROUP, "pos", "total", "digest", "of_known", "of", "leaves"), "groups"), levels)


def manifest_roots(
    docs: DataFrame, group: str = "source", key: str = "doc_id", fields: tuple[str, ...] = FIELDS, levels: int = LEVELS
) -> DataFrame:
    """Per group: its name, number of leaves, subroot and the root over all groups, as lowercase hex.

    See ``prove_rows`` for the rules.
    """
    _, roots = climb(_leaves(docs, group, key, fields, {}), levels)
    rounds, top = _over_groups(roots, levels)
    root = top.first()
    return rounds[0].select(
        F.when(F.col("of_known"), F.col("of")).alias(group), "leaves",
        F.lower(F.hex("digest")).alias("subroot"), F.lit(root["digest"].hex() if root else None).alias("root"),
    )


def prove_rows(
    docs: DataFrame,
    group: str = "source",
    key: str = "doc_id",
    fields: tuple[str, ...] = FIELDS,
    copy: dict[str, Column] | None = None,
    keep_proofs: bool = False,
    levels: int = LEVELS,
) -> DataFrame:
    """Per row: key, leaf, subroot, root, proof_sha256, folded_root, verified, and with ``keep_proofs`` the proof.

    A leaf is the sha256 of the row's ``fields``. Leaves of a group ascend by key,
    then by digest; every 16 neighbours (the last run may have fewer) become the
    sha256 of their digests in hex, until one is left: the subroot, which for a lone
    leaf is the leaf. The subroots, in the order of the groups' names by bytes, null
    first, give the root in the same way. A proof lists the siblings in each run on
    the way to the root; ``proof`` has one (left, right) of joined hex per level.
    ``copy`` has expressions for fields as another copy of the data holds them: its
    leaf is folded with the proof of the original, and ``verified`` tells whether
    that gives the root.

    Nulls count as ``-`` in a leaf; null keys come first, a null group is a group of
    its own. Repeated rows are leaves of their own; equal leaves of one key are
    interchangeable. An empty text is a field of no bytes, a long one is hashed
    whole where it lies: only digests move. An empty table gives an empty result.
    Columns that are neither key, group nor fields are not read.
    """
    leaves = _leaves(docs, group, key, fields, copy or {})
    rounds, roots = climb(leaves, levels)
    upper, top = _over_groups(roots, levels)
    none = F.array().cast("array<binary>")
    start = top.select(*GROUP, "leaves", none.alias("suffix"), F.array("digest").alias("heads"))

    def to_groups(found):
        for _, _, node, left, right, above, heads in found:
            of_known, of, n = node[8:11]
            pairs = [(left, right), *above] if node[4] > 1 else above
            yield of_known, of, n, [bytes.fromhex(x) for p in pairs for x in p], [node[5], heads[0]]

    tops = descend(
        upper, start, to_groups, "known boolean, g string, leaves long, suffix array<binary>, heads array<binary>", levels
    )
    tops = stored(tops, "tops")

    def prove(found):
        above, joined = None, ""
        for _, _, node, left, right, pairs, heads in found:
            if pairs is not above:
                above, joined = pairs, "".join(a + b for a, b in pairs)
            folded = _hash(left + node[9].hex() + right) if left or right or node[4] > 1 else node[9].hex()
            for a, b in pairs:
                folded = _hash(a + folded + b)
            root = heads[1].hex()
            row = (node[8], node[5].hex(), heads[0].hex(), root, _hash(left + right + joined), folded, folded == root)
            own = [(left, right)] if node[4] > 1 else []
            yield (*row, [{"left": a, "right": b} for a, b in own + pairs]) if keep_proofs else row

    kind = dict(docs.select(F.col(key).alias("id")).dtypes)["id"]
    schema = (
        f"`{key}` {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        + (", proof array<struct<left: string, right: string>>" if keep_proofs else "")
    )
    return descend(rounds, tops, prove, schema, levels)
