"""Token counts of a unigram vocabulary by a count-only Viterbi search.

An automaton lists the pieces that end at each sign; for each place only the best
score and the number of pieces of the best way are kept, no way back. Of equal
scores the longer last piece wins, as the tokenizer takes a later way only if it
is strictly better.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.pieces import BLANK, NORMAL, cut_pattern
from tidemart.llm.texts import pieces_of

UNKNOWN_PENALTY = 10.0
CACHE_ENTRIES = 300_000
CACHE_LONGEST = 48


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a model file, without control signs and bytes."""
    from sentencepiece import sentencepiece_model_pb2 as model_pb

    model = model_pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    return [(p.piece, p.score) for p in model.pieces if p.type == NORMAL]


class UnigramCounter:
    """Counts pieces; a sign outside the vocabulary counts as its bytes."""

    def __init__(self, pieces: Sequence[tuple[str, float]]):
        import ahocorasick

        self.unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        for p, s in pieces:
            self.automaton.add_word(p, (len(p), s))
        self.automaton.make_automaton()
        cuts, self.segment = cut_pattern([p for p, _ in pieces])
        # sums of whole numbers are exact, so segments can be searched for themselves
        self.cuts = cuts and all(s == int(s) for _, s in pieces)
        self.known: dict[str, tuple[float, int]] = {}

    def search(self, text: str) -> tuple[float, int]:
        n = len(text)
        best, count = [0.0] + [float("-inf")] * n, [0] * (n + 1)
        done = 0

        def unknown(upto: int) -> None:
            # in order of ends; a single sign is the shortest, so it comes after the pieces
            nonlocal done
            for i in range(done, upto):
                if text[i] not in self.single:
                    score = best[i] + self.unknown
                    if score > best[i + 1]:
                        best[i + 1], count[i + 1] = score, count[i] + len(text[i].encode("utf-8", "surrogatepass"))
            done = max(done, upto)

        for at, (length, s) in self.automaton.iter(text):
            unknown(at)
            score = best[at + 1 - length] + s
            if score > best[at + 1]:
                best[at + 1], count[at + 1] = score, count[at + 1 - length] + 1
        unknown(n)
        return best[n], count[n]

    def measure(self, text: str | None) -> tuple[float, int]:
        """(score, number of pieces) of a whole text; nothing for an empty one."""
        if not text:
            return 0.0, 0
        text = BLANK + text.replace(" ", BLANK)
        if not self.cuts:
            return self.search(text)
        score, n, known = 0.0, 0, self.known
        for segment in self.segment.findall(text):
            found = known.get(segment)
            if found is None:
                found = self.search(segment)
                if len(segment) <= CACHE_LONGEST:
                    if len(known) >= CACHE_ENTRIES:
                        known.clear()
                    known[segment] = found
            score += found[0]
            n += found[1]
        return score, n


_counters: dict[str, UnigramCounter] = {}


def count_tokens(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, n_tokens and the score of the best split of each whole text, blanks taken as in the pieces.

    No exchange; memory per worker is bounded. Null and empty texts count 0.
    Repeated rows come out as often as they came in; other columns are not read.
    Very long texts are counted whole. An empty table gives an empty result.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model_path not in _counters:
            _counters[model_path] = UnigramCounter(vocabulary(model_path))
        counter = _counters[model_path]
        for batch in batches:
            for piece in pieces_of(batch, 1):
                found = [counter.measure(t) for t in piece.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array([n for _, n in found], pa.int64()), pa.array([s for s, _ in found], pa.float64())],
                    names=[key, "n_tokens", "score"],
                )

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, n_tokens long, score double")
