"""Merge-type piece encoding by a prefix table, and decoding.

The tokenizer starts from single signs and keeps merging the neighbours whose
joined piece has the best score (the leftmost first). Two facts make a linear
table out of it: the encoding of a text contains no neighbours that would be
encoded otherwise if they stood alone, and a row of pieces in which all
neighbours pass this test is the encoding. So each prefix of a text has exactly
one last piece; it is the one piece ending there that is compatible with the last
piece of the prefix before it. The ids come from the table by going back from
the end.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.texts import pieces_of

BLANK = "▁"
CACHE_ENTRIES = 300_000
CACHE_LONGEST = 48
PAIR_ENTRIES = 1_000_000
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def cut_pattern(pieces: Iterable[str]) -> tuple[bool, re.Pattern]:
    """Where a text may be cut because no piece reaches over: the segments are encoded, and remembered, one by one.

    That is before a blank that follows another sign, between a letter and what
    is no letter, and around line ends, each as far as the vocabulary bears it
    out.
    """
    follows = {(a, b) for p in pieces for a, b in itertools.pairwise(p)}
    if any(b == BLANK != a for a, b in follows):
        return False, re.compile("(?s).+")
    letters = {c for c in map(chr, [*range(48, 58), *range(65, 123), *range(0xC0, 0x250)]) if c.isalnum()}
    while bad := {a for a, b in follows if a in letters and b not in letters}:
        letters -= bad
    lone = "" if any("\n" in pair for pair in follows) else "\n"
    word, other = re.escape("".join(sorted(letters))), f"{BLANK}{lone}"
    signs = f"[^{word}{other}]"
    pattern = f"{BLANK}+{signs}*[{word}]*|{signs}+[{word}]*|[{word}]+" + (f"|{lone}" if lone else "")
    return True, re.compile(pattern)


class PieceModel:
    """Encoder and decoder of a merge-type model with byte fallback."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as model_pb

        model = model_pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        normal, trainer = model.normalizer_spec, model.trainer_spec
        if trainer.model_type != 2 or not trainer.byte_fallback or normal.name != "identity":
            raise ValueError("a merge-type model with byte fallback and without normalisation is needed")
        if any(p.type in (USER_DEFINED, UNUSED) for p in model.pieces) or len(model.pieces) > 1 << 16:
            raise ValueError("models with user-defined or unused pieces, or over 65536 pieces, are not supported")
        self.dummy_prefix, self.trims = normal.add_dummy_prefix, normal.remove_extra_whitespaces
        if self.trims or not normal.escape_whitespaces:
            raise ValueError("models that drop or keep blanks as they are, are not supported")
        self.pieces = [p.piece for p in model.pieces]
        self.id_of = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.score = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.byte_id = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.control = {i for i, p in enumerate(model.pieces) if p.type == CONTROL}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        self.cuts, self.segment = cut_pattern(self.id_of)
        self._derive()
        self.automaton = ahocorasick.Automaton()
        for p in self.id_of:
            if p not in self.never:
                self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        # two generations of remembered segments: a full one replaces the one before
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        # decoding: the bytes of each id; blanks are put back, control signs vanish
        self.out_bytes = [p.replace(BLANK, " ").encode() for p in self.pieces]
        for i, b in self.byte_of.items():
            self.out_bytes[i] = bytes([b])
        for i in self.control:
            self.out_bytes[i] = b""
        self.out_bytes[self.unknown] = " ⁇ ".encode()
        self.decimal = [str(i) for i in range(len(self.pieces))]

    def merged(self, signs: list[str]) -> list[list[str]]:
        """The merge rule itself, for the few signs of one or two pieces; the states it runs through."""
        states = [signs]
        while True:
            best, at = None, -1
            for i in range(len(signs) - 1):
                s = self.score.get(signs[i] + signs[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return states
            signs = [*signs[:at], signs[at] + signs[at + 1], *signs[at + 2 :]]
            states.append(signs)

    def _derive(self) -> None:
        """The last merge of each piece, its rank, and which pieces need the plain rule.

        ``never`` holds pieces that their own text is not encoded to. ``plain``
        holds those whose rank is shared, or that are made of later ones.
        """
        order = sorted(self.score, key=lambda p: -self.score[p])
        self.rank = {p: i for i, p in enumerate(order)}
        shared = {a for a, b in itertools.pairwise(order) if self.score[a] == self.score[b]}
        shared |= {b for a, b in itertools.pairwise(order) if self.score[a] == self.score[b]}
        self.parts: dict[str, tuple[str, str]] = {}
        self.never, self.plain = set(), set(shared)
        for p in sorted(order, key=len):
            if len(p) == 1:
                continue
            states = self.merged(list(p))
            if states[-1] != [p]:
                self.never.add(p)
                continue
            a, b = self.parts[p] = tuple(states[-2])
            late = any(len(x) > 1 and self.rank[x] > self.rank[p] for x in (a, b))
            if late or a in self.plain or b in self.plain:
                self.plain.add(p)

    def compatible(self, a: str, b: str) -> bool:
        """Whether the text of ``a`` and ``b`` alone is encoded to just these two."""
        key = (a, b)
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= PAIR_ENTRIES:
                self.pairs.clear()
            if a in self.plain or b in self.plain:
                found = self.merged(list(a + b))[-1] == [a, b]
            else:
                found = self._apart(a, b)
            self.pairs[key] = found
        return found

    def _apart(self, a: str, b: str) -> bool:
        """Undo the merges of both from the last to the first; none over the border may come before the one undone."""
        rank, parts = self.rank, self.parts
        limit = len(rank)
        while True:
            over = rank.get(a + b)
            if over is not None and over < limit:
                return False
            made_a = rank[a] if len(a) > 1 else -1
            made_b = rank[b] if len(b) > 1 else -1
            if made_a > made_b:
                limit, a = made_a, parts[a][1]
            elif made_b >= 0:
                limit, b = made_b + 1, parts[b][0]
            else:
                return True

    def split(self, text: str) -> list[str]:
        """The pieces of a text: fill the table of last pieces, then go back."""
        n = len(text)
        # a sign outside the vocabulary is its own last piece; bytes will stand for it
        last = ["", *text]
        done, pairs = 0, self.pairs
        for at, piece in self.automaton.iter(text):
            if at < done:
                continue
            start = at + 1 - len(piece)
            fits = True
            if start:
                before = last[start]
                fits = pairs.get((before, piece))
                if fits is None:
                    fits = self.compatible(before, piece)
            if fits:
                last[at + 1] = piece
                done = at + 1
        out = []
        while n:
            out.append(last[n])
            n -= len(last[n])
        return out[::-1]

    def segment_ids(self, text: str) -> bytes:
        ids: list[int] = []
        for piece in self.split(text):
            i = self.id_of.get(piece)
            if i is not None:
                ids.append(i)
            else:
                ids.extend(self.byte_id[b] for b in piece.encode("utf-8", "surrogatepass"))
        return np.array(ids, "<u2").tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text, no begin or end ids."""
        if not text:
            return np.zeros(0, "<u2")
        text = text.replace(" ", BLANK)
        if self.dummy_prefix:
            text = BLANK + text
        known = self.known
        segments = self.segment.findall(text) if self.cuts else [text]
        try:
            raw = b"".join(map(known.__getitem__, segments))
        except KeyError:
            parts = []
            for s in segments:
                ids = known.get(s)
                if ids is None:
                    ids = self.before.get(s)
                    if ids is None:
                        ids = self.segment_ids(s)
                    if len(s) <= CACHE_LONGEST:
                        if len(known) >= CACHE_ENTRIES:
                            self.before, self.known = known, {}
                            known = self.known
                        known[s] = ids
                parts.append(ids)
            raw = b"".join(parts)
        return np.frombuffer(raw, "<u2")

    def decode(self, ids) -> str:
        """The text of some ids; bytes that are no text become the replacement sign, one each."""
        raw = b"".join(map(self.out_bytes.__getitem__, ids))
        if self.dummy_prefix and raw[:1] == b" " and len(ids) and ids[0] not in self.byte_of:
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return self._decode_broken(list(ids))

    def _decode_broken(self, ids: list[int]) -> str:
        out = []
        for is_byte, run in itertools.groupby(ids, key=lambda i: i in self.byte_of):
            raw = b"".join(self.out_bytes[i] for i in run)
            while is_byte and raw:
                try:
                    out.append(raw.decode())
                    raw = b""
                except UnicodeDecodeError as e:
                    out.append(raw[: e.start].decode() + "�")
                    raw = raw[e.start + 1 :]
            if raw:
                out.append(raw.decode())
        text = "".join(out)
        if self.dummy_prefix and text[:1] == " " and ids[0] not in self.byte_of:
            text = text[1:]
        return text


_models: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """One model for each worker process."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def encode_pieces(
    docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", keep_ids: bool = True
) -> DataFrame:
    """Encode each whole text and decode it again: key, ids, n_tokens, ids_sha256, decoded, decoded_sha256.

    ``keep_ids=False`` leaves out ``ids`` and ``decoded``. No exchange: each row
    is encoded where it is read. Memory per worker is bounded by a few megabytes
    of text, and by fixed numbers of remembered segments and pairs. Null and
    empty texts have no ids and decode to an empty text. Repeated rows come out
    as often as they came in; a null key stays null; other columns are not read.
    A very long text is encoded whole, in segments. An empty table gives an empty
    result.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" if keep_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        decimal = model.decimal
        for batch in batches:
            for piece in pieces_of(batch, 1):
                sizes, shas, texts, all_ids, decoded = [], [], [], [], []
                for text in piece.column(1).to_pylist():
                    ids = model.encode(text).tolist()
                    back = model.decode(ids)
                    sizes.append(len(ids))
                    shas.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                    texts.append(hashlib.sha256(back.encode()).hexdigest())
                    if keep_ids:
                        all_ids.append(ids)
                        decoded.append(back)
                out = [piece.column(0), pa.array(sizes, pa.int64()), pa.array(shas, pa.string()), pa.array(texts, pa.string())]
                names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    out += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(out, names=names)

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, schema)
