"""Quality score from compression: one zstandard dictionary from good and one from bad labelled text.

A text that resembles the good examples gets smaller with their dictionary. The difference of both compressed
sizes, divided by their sum, is mapped to a probability by a logistic curve that is fitted to labelled rows
which neither dictionary has seen.

Defined cases: null and empty texts get the score of difference zero; without examples of both labels every score
is the share of good labels (0.5 without any label); labels other than 0 and 1, and labels without a
document, teach nothing; a document labelled twice with different labels counts once with each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.shared import keep

#: Bound of the training sample: about so many labelled rows of each label, by hash.
ROWS_PER_LABEL = 4_000
#: Bytes of text that the sample may hold at most; longer texts make it fewer rows.
SAMPLE_BYTES = 64 << 20
DICTIONARY_BYTES = 32 << 10
LEVEL = 3
#: Long training texts are cut into pieces of this size, so that each is one example; none is dropped.
PIECE_BYTES = 4_000


def _dictionary(texts: list[str]) -> bytes:
    raw = [t.encode("utf-8", "replace") for t in texts]
    pieces = [r[i : i + PIECE_BYTES] for r in raw for i in range(0, len(r), PIECE_BYTES)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few examples to count common parts
        return b"".join(pieces)[-DICTIONARY_BYTES:]


class Model:
    def __init__(self, good: bytes, bad: bytes, base: float):
        self.good, self.bad, self.base, self.curve = good, bad, base, np.zeros(2)
        self._sizes = None

    def __getstate__(self):
        return {**self.__dict__, "_sizes": None}

    def difference(self, text: str | None) -> float:
        """Above zero: smaller with the good dictionary."""
        if self._sizes is None:
            self._sizes = []
            for raw in (self.good, self.bad):
                made = zstandard.ZstdCompressionDict(raw)
                made.precompute_compress(level=LEVEL)
                self._sizes.append(zstandard.ZstdCompressor(dict_data=made, write_content_size=False, write_dict_id=False))
        raw = (text or "").encode("utf-8", "replace")
        good, bad = (len(c.compress(raw)) for c in self._sizes)
        return (bad - good) / (bad + good)

    def score(self, text: str | None) -> float:
        if not self.good or not self.bad:
            return self.base
        if not text:
            return float(1 / (1 + np.exp(-self.curve[0])))
        return float(1 / (1 + np.exp(-np.clip(self.curve[0] + self.curve[1] * self.difference(text), -40, 40))))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Intercept and slope, by Newton's method with a small ridge."""
    design, found = np.stack([np.ones_like(x), x], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ found, -40, 40)))
        slope = design.T @ (y - p) - 1e-3 * found * [0, 1]
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        found += step
        if np.abs(step).max() < 1e-9:
            break
    return found


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality") -> Model:
    """Learn from a bounded hash sample of the labelled documents; half makes the dictionaries, half the curve."""
    marks = labels.filter(F.col(label).isin(0, 1)).select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).distinct()
    sizes = {r.y: r.n for r in marks.groupBy("y").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    base = sizes.get(1, 0) / total if total else 0.5
    if len(sizes) < 2:
        return Model(b"", b"", base)
    share = F.coalesce(*[F.when(F.col("y") == y, F.lit(min(1.0, ROWS_PER_LABEL / n))) for y, n in sizes.items()])
    place = F.pmod(F.xxhash64("k", F.lit(8)), F.lit(1 << 20))
    marks = marks.filter(place < share * (1 << 20))
    # the same test on the documents, with the larger share: no more than the sample moves
    largest = max(min(1.0, ROWS_PER_LABEL / n) for n in sizes.values())
    texts = docs.select(F.col(key).cast(marks.schema["k"].dataType).alias("k"), F.col(text).alias("t"))
    picked = keep(texts.filter("t <> ''").filter(place < largest * (1 << 20)).join(marks, "k").withColumn("place", place), "labelled-sample")
    held = picked.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    if held > SAMPLE_BYTES:  # long texts: fewer of both labels
        part = share * (SAMPLE_BYTES / held)
        picked = picked.filter(F.col("place") < part * (1 << 20))
    rows = sorted(picked.select("k", "t", "y", F.pmod(F.xxhash64("k", F.lit(9)), F.lit(2)).alias("h")).collect())
    halves = {(y, h): [r.t for r in rows if (r.y, r.h) == (y, h)] for y in (0, 1) for h in (0, 1)}
    if not all(halves[y, h] for y in (0, 1) for h in (0, 1)):
        return Model(b"", b"", base)
    model = Model(_dictionary(halves[1, 0]), _dictionary(halves[0, 0]), base)
    x = np.array([model.difference(t) for y in (0, 1) for t in halves[y, 1]])
    y = np.array([y for y in (0, 1) for _ in halves[y, 1]], dtype=float)
    model.curve = _logistic(x, y)
    # the sample is even-handed where labels are not: shift the curve to the labels' real odds
    kept = {y: min(1.0, ROWS_PER_LABEL / n) for y, n in sizes.items()}
    model.curve[0] += np.log(kept[0] / kept[1])
    return model


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """All rows and columns, with the probability of a good label; a column of that name is replaced."""
    docs = docs.drop(out)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of DICTIONARY_BYTES
    schema = T.StructType([*docs.schema, T.StructField(out, T.DoubleType())])

    def judge(parts):
        for part in parts:
            yield part.append_column(out, pa.array([shared.value.score(t) for t in part.column(text).to_pylist()], pa.float64()))

    return docs.mapInArrow(judge, schema)
