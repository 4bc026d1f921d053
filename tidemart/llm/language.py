"""Language identification by the nearest of several centroids per language.

A text's vector counts byte runs of one to four letters, hashed to a fixed number
of cells, weighted by inverse document frequency and normalised. Each language
has some centroids, found by k-means on a bounded sample of its rows; the text
gets the language of the centroid with the largest cosine. A text whose cosine
is, for its length, under what nearly all sample rows of that language reach is
rejected.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemart.llm.texts import LOWER, pieces_of, utf8

CELLS = 4096
RUNS = (1, 2, 3, 4)
ROWS = 128
HALF_CELLS = 800
FEW_ROWS = 100
UNDETERMINED = "und"
_FACTORS = {n: np.random.default_rng(n).integers(1, 1 << 31, size=n, dtype=np.uint32) | np.uint32(1) for n in RUNS}
# letters keep their byte, everything else of ASCII is one blank
FOLD = LOWER.copy()
FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 32


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows by CELLS counts of letter runs."""
    rows = len(offsets) - 1
    folded = FOLD[data]
    row = np.repeat(np.arange(rows, dtype=np.int64), np.diff(offsets))
    blank = folded == 32
    out = np.zeros(rows * CELLS)
    wide = folded.astype(np.uint32)
    for n in RUNS:
        if len(folded) < n:
            continue
        m = len(folded) - n + 1
        h = np.full(m, n, np.uint32)
        empty = np.ones(m, bool)
        for k in range(n):
            h = h * np.uint32(0x01000193) + wide[k : k + m] * _FACTORS[n][k]
            empty &= blank[k : k + m]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(13)
        use = (row[:m] == row[n - 1 :]) & ~empty
        cell = row[:m][use] * CELLS + (h[use] % np.uint32(CELLS)).astype(np.int64)
        out += np.bincount(cell, minlength=rows * CELLS)
    return out.reshape(rows, CELLS)


def weigh(c: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vectors of damped counts times idf; a row without letters stays zero."""
    v = (np.log1p(c) * idf).astype(np.float32)
    size = np.sqrt((v * v).sum(1, keepdims=True))
    return np.divide(v, size, out=np.zeros_like(v), where=size > 0)


def has_letter(texts: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum((FOLD[data] != 32) & (data < 128))])
    found = total[offsets[1:]] > total[offsets[:-1]]
    for i in np.flatnonzero(~found).tolist():
        found[i] = any(ch.isalpha() for ch in texts[i].as_py() or "")
    return found


def slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    for piece in pieces_of(batch, text):
        for low in range(0, piece.num_rows, ROWS):
            yield piece.slice(low, ROWS)


@dataclasses.dataclass(frozen=True)
class Centroids:
    languages: list[str]
    vectors: np.ndarray
    least: np.ndarray
    idf: np.ndarray


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[int, np.ndarray]:
    """Number of non-null texts, and in how many of them each cell occurs, over all rows.

    Each task adds up its rows, so one row per cell and task is shuffled.
    """

    def run(batches):
        total, n = np.zeros(CELLS, np.int64), 0
        for batch in batches:
            for piece in slices(batch, 0):
                total += (counts(*utf8(piece.column(0))) > 0).sum(0)
                n += piece.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, CELLS)), pa.array(np.concatenate([[n], total]))], ["cell", "n"])

    found = docs.where(F.col(text).isNotNull()).select(text).mapInArrow(run, "cell long, n long")
    sums = np.zeros(CELLS + 1, np.int64)
    for r in found.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        sums[r["cell"] + 1] = r["n"]
    return int(sums[0]), sums[1:]


def length_share(v: np.ndarray) -> np.ndarray:
    """How much of its cosine a text of this many filled cells can show: short texts' is smaller for that alone."""
    filled = (v != 0).sum(1)
    return np.sqrt(filled / (filled + HALF_CELLS))


def k_means(v: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from the row farthest from the centres so far; returns centres and each row's cosine."""
    centre = v.mean(0)
    centres = [centre / max(np.linalg.norm(centre), 1e-9)]
    while len(centres) < min(k, len(v)):
        centres.append(v[np.argmin((v @ np.array(centres).T).max(1))])
    c = np.array(centres)
    for _ in range(rounds):
        near = (v @ c.T).argmax(1)
        for i in range(len(c)):
            if (near == i).any():
                mean = v[near == i].mean(0)
                c[i] = mean / max(np.linalg.norm(mean), 1e-9)
    return c, v @ c.T


def left_out(v: np.ndarray, c: np.ndarray, cosines: np.ndarray) -> np.ndarray:
    """Each row's largest cosine, with its own centroid taken as it would be without the row."""
    near = cosines.argmax(1)
    rows = np.arange(len(v))
    size = np.linalg.norm([v[near == i].sum(0) for i in range(len(c))], axis=1)[near]
    own = cosines[rows, near]
    rest = np.sqrt(np.maximum(size**2 - 2 * own * size + 1, 0))
    out = cosines.copy()
    out[rows, near] = np.where(rest > 1e-3, (own * size - 1) / np.maximum(rest, 1e-3), 0)
    return np.maximum(out.max(1), 0)


RANKED_PARTS = 64


def fit_centroids(
    docs: DataFrame,
    learns: Column,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_language: int = 400,
    clusters: int = 3,
    margin: float = 0.25,
) -> Centroids:
    """Learn from the rows where ``learns`` holds and language and text are not null.

    Document frequencies cover all of these rows. The centroids are fitted on at
    most ``per_language`` rows of each language, those with the smallest hash of
    key and text. ``least`` of a language is the first percentile of its sample
    rows' cosines over what their lengths allow, less ``margin`` of its distance
    from the median; a sample of few rows shows its low end badly, so there the
    margin is wider. A row's cosine is taken without the row itself.
    """
    rows = docs.where(learns & F.col(lang).isNotNull() & F.col(text).isNotNull())
    n, df = document_frequencies(rows, text)
    idf = np.log((1 + n) / (1 + df)) + 0.1
    # only keys and hashes are ranked: first in each part of a language, so that the last step has a bounded number of rows
    picked = rows.select(F.col(lang).alias("lang"), F.col(key).alias("k"), F.xxhash64(key, text).alias("h"))
    picked = picked.withColumn("part", F.pmod("h", F.lit(RANKED_PARTS)))
    for by in (("lang", "part"), ("lang",)):
        first = W.partitionBy(*by).orderBy("h", "k")
        picked = picked.withColumn("at", F.row_number().over(first)).where(F.col("at") <= per_language)
    picked = picked.select("lang", "h").distinct()
    sample = rows.select(F.col(lang).alias("lang"), F.xxhash64(key, text).alias("h"), F.col(text).alias("text"))
    sample = sample.join(picked, ["lang", "h"], "left_semi")

    def train(pdf):
        import pandas as pd

        texts = sorted(pdf["text"])
        parts = [weigh(counts(*utf8(pa.array(texts[i : i + ROWS]))), idf) for i in range(0, len(texts), ROWS)]
        v = np.concatenate(parts)
        v = v[(v != 0).any(1)]
        if not len(v):
            return pd.DataFrame({"lang": [], "at": [], "vector": [], "least": []})
        c, cosines = k_means(v, clusters)
        low, middle = np.quantile(left_out(v, c, cosines) / length_share(v), [0.01, 0.5])
        least = float(low - margin * (1 + FEW_ROWS / len(v)) * (middle - low))
        return pd.DataFrame(
            {"lang": pdf["lang"].iloc[0], "at": range(len(c)), "vector": [x.astype("<f4").tobytes() for x in c], "least": least}
        )

    found = sample.groupBy("lang").applyInPandas(train, "lang string, at int, vector binary, least double")
    trained = sorted(found.collect(), key=lambda r: (r["lang"], r["at"]))
    return Centroids(
        [r["lang"] for r in trained],
        np.array([np.frombuffer(bytes(r["vector"]), "<f4") for r in trained]).reshape(-1, CELLS),
        np.array([r["least"] for r in trained]),
        idf,
    )


def predict_language(docs: DataFrame, model: Centroids, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with lang_pred, score (the cosine) and accepted (each name after ``prefix``).

    Only the text is looked at, all of it. A null text, or one without a letter,
    is ``und`` with score 0 and not accepted; so is every text if nothing was
    learned. Of equal cosines the first language by name wins. Repeated rows come
    out as often as they came in; an empty table gives an empty result; ``prefix``
    keeps the new names apart from those of ``docs``. No exchange; the model's size
    is fixed by the numbers of languages, clusters and cells.
    """
    from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

    schema = StructType(
        docs.schema.fields
        + [
            StructField(prefix + "lang_pred", StringType()),
            StructField(prefix + "score", DoubleType()),
            StructField(prefix + "accepted", BooleanType()),
        ]
    )
    at = docs.columns.index(text)
    names = schema.names
    languages, centres = np.array(model.languages, object), model.vectors.T.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, at):
                data, offsets = utf8(piece.column(at))
                known = has_letter(piece.column(at), data, offsets) & (len(languages) > 0)
                lang = np.full(len(known), UNDETERMINED, object)
                score = np.zeros(len(known))
                accepted = np.zeros(len(known), bool)
                if known.any():
                    v = weigh(counts(data, offsets), model.idf)
                    cosines = v @ centres
                    best = cosines.argmax(1)
                    lang[known] = languages[best[known]]
                    score[known] = np.clip(cosines.max(1)[known], 0, 1)
                    accepted = known & (cosines.max(1) >= model.least[best] * length_share(v))
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, pa.array(lang, pa.string()), pa.array(score), pa.array(accepted)], names=names
                )

    return docs.mapInArrow(run, schema)


def is_held_out(key: Column) -> Column:
    """The fold of a key: crc32 of its decimal text modulo 4 is 2."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))
