"""Language identification: multinomial naive Bayes over hashed character n-grams.

The text is lower-cased, every run of characters that are no letters becomes one space, and the n-grams of
one to three characters are hashed to a fixed number of buckets. Training counts (language, bucket) pairs on
Spark; the matrix of log-probabilities is broadcast, and each text is scored as a sparse sum of its rows.

Defined cases: null text or no letter gives ``und`` and score 0; rows with a null language teach nothing;
with no labelled row every text is ``und``; ties go to the language first in alphabetical order; repeated
rows count as often as they occur; columns other than the named ones pass through untouched.
"""

from __future__ import annotations

from collections import defaultdict
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.shared import arrow_schema, batch, mix, tidied

BUCKET_BITS = 16
LENGTHS = 3
SMOOTHING = 0.1
#: Bound of the training sample: about so many labelled rows of each language, by hash.
ROWS_PER_LANGUAGE = 5_000
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    for i in range(len(table)):
        table[i] = not 0xD800 <= i < 0xE000 and chr(i).isalpha()
    return table


def buckets(text: str | None) -> np.ndarray:
    """Bucket of every n-gram of the whole text; empty without a letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, np.int64)
    points = np.where(letter, points, 32)
    points = points[letter | np.append(True, letter[:-1])]
    points = np.concatenate([[32], points, [32]]).astype(np.uint64)
    gram, found = points + np.uint64(1), []
    for length in range(1, LENGTHS + 1):
        if length > 1:
            gram = gram[:-1] * np.uint64(0x1000193) + points[length - 1 :] + np.uint64(1)
        found.append(mix(gram + np.uint64(length << 56)) >> np.uint64(64 - BUCKET_BITS))
    return np.concatenate(found).astype(np.int64)


class Model:
    """Languages in order, log-priors, and log-probabilities by (bucket, language)."""

    def __init__(self, languages: list[str], prior: np.ndarray, weights: np.ndarray):
        self.languages, self.prior, self.weights = languages, prior, weights

    def predict(self, text: str | None) -> tuple[str, float]:
        rows = buckets(text)
        if not len(rows) or not self.languages:
            return UNKNOWN, 0.0
        total = self.weights[rows].sum(axis=0, dtype=np.float64)
        # n-grams of one text depend on each other: the evidence counts as that of sqrt(n) of them
        logits = self.prior + total / np.sqrt(len(rows))
        best = int(np.argmax(logits))
        return self.languages[best], float(1 / np.exp(logits - logits[best]).sum())


def train(rows: DataFrame, text: str = "text", language: str = "lang", key: str = "doc_id") -> Model:
    """Learn from a hash sample of ``ROWS_PER_LANGUAGE`` rows for each language."""
    rows = rows.filter(F.col(language).isNotNull()).select(
        F.col(key).alias("k"), F.col(text).alias("t"), F.col(language).cast("string").alias("l")
    )
    sizes = {r.l: r.n for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.empty(0), np.empty((0, 0)))
    share = F.coalesce(*[F.when(F.col("l") == l, F.lit(min(1.0, ROWS_PER_LANGUAGE / n))) for l, n in sizes.items()])
    sample = rows.filter(F.pmod(F.xxhash64("k", F.lit(6)), F.lit(1 << 20)) < share * (1 << 20))
    schema = arrow_schema(T.StructType.fromDDL("l string, b int, n bigint"))

    def count(parts):
        counts = defaultdict(lambda: np.zeros(1 << BUCKET_BITS, np.int64))
        for part in parts:
            for t, l in zip(part.column("t").to_pylist(), part.column("l").to_pylist()):
                counts[l] += np.bincount(buckets(t), minlength=1 << BUCKET_BITS)
        for l, n in counts.items():
            seen = np.flatnonzero(n)
            yield batch(schema, [l] * len(seen), seen, n[seen])

    # at most 2**BUCKET_BITS rows for each language reach the driver
    found = sample.select("t", "l").mapInArrow(tidied(count), "l string, b int, n bigint")
    found = found.groupBy("l", "b").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(sizes)
    matrix = np.zeros((1 << BUCKET_BITS, len(languages)))
    column = np.array([languages.index(l) for l in found.column("l").to_pylist()], dtype=np.int64)
    matrix[found.column("b").to_numpy(), column] = found.column("n").to_numpy()
    matrix = np.log((matrix + SMOOTHING) / (matrix.sum(axis=0) + SMOOTHING * len(matrix)))
    prior = np.log(np.array([sizes[l] for l in languages]) / sum(sizes.values()))
    return Model(languages, prior, matrix.astype(np.float32))


def identify(docs: DataFrame, model: Model, text: str = "text", out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All rows and columns, with the predicted language and its probability; columns of these names are replaced."""
    docs = docs.drop(*out)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BUCKET_BITS floats for each language
    schema = T.StructType([*docs.schema, T.StructField(out[0], T.StringType()), T.StructField(out[1], T.DoubleType())])

    def predict(parts):
        for part in parts:
            found = [shared.value.predict(t) for t in part.column(text).to_pylist()]
            names, scores = pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())
            yield part.append_column(out[0], names).append_column(out[1], scores)

    return docs.mapInArrow(tidied(predict), schema)


def certain(found: DataFrame, least: float = 0.5) -> Column:
    """Whether a prediction is good enough to keep a document."""
    return (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)
