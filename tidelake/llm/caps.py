"""Near-duplicate embeddings: spherical-cap filters from a structured random product code.

Vectors are linked if their labels are equal and their cosine, in double precision, reaches a threshold.

1. Equal vectors of a label form a class with the smallest id as representative; only representatives go on.
2. The space is rotated at random, ``TURNS`` times, and split into ``PARTS`` parts, each with ``CODE`` random directions.
   A filter is one direction for each part, so there are CODE ** PARTS filters. A vector is listed under every filter
   whose inner product exceeds ``HEIGHT`` standard deviations, or comes within ``REACH`` of its best one; the list is decoded
   by combining parts and cutting off partial sums that cannot reach the height.
3. Vectors that share (label, filter) meet and are checked. Filters with many vectors are dealt out in pairs of blocks.

The measured recall is in the README.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows with a null label or
id, link with nothing; vectors of unlike length are never linked; rows that repeat an id count as other vectors
with that id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.shared import arrow_schema, batch, components, keep, whole_groups

PARTS, CODE, HEIGHT = 2, 256, 3.6
#: A vector's height is lowered to so many standard deviations below its best filter, where that is less.
REACH = 0.4
#: Independent rotations, each with the same code; a pair meets if it shares a filter of any.
TURNS = 2
BLOCK = 256


class Code:
    """The filters for vectors of one length, the same on every machine."""

    def __init__(self, length: int):
        random = np.random.default_rng(length)
        self.width = -(-length // PARTS)
        size = self.width * PARTS
        self.turns = [np.linalg.qr(random.standard_normal((size, size)))[0][:length] for _ in range(TURNS)]
        code = random.standard_normal((PARTS, CODE, self.width))
        self.code = code / np.linalg.norm(code, axis=2, keepdims=True)
        self.deviation = np.sqrt(PARTS / size)

    def lists(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(row, filter)`` of all filters that the rows exceed."""
        found = [self._decoded(unit @ turn) for turn in self.turns]
        filters = [filter_ + i * CODE**PARTS for i, (_, filter_) in enumerate(found)]
        return np.concatenate([row for row, _ in found]), np.concatenate(filters)

    def _decoded(self, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = turned.reshape(len(turned), PARTS, self.width)
        inner = np.einsum("npw,pcw->npc", parts, self.code)
        half = PARTS // 2
        front, back = (self._sums(inner[:, s]) for s in (slice(0, half), slice(half, PARTS)))
        lift = back.max(axis=1)
        height = self.deviation * HEIGHT
        height = np.minimum(height, front.max(axis=1) + lift - REACH * self.deviation)
        # a front half goes on only if the best back half can lift it to the height
        row, left = np.nonzero(front >= (height - lift)[:, None])
        found, right = np.nonzero(front[row, left][:, None] + back[row] >= height[row][:, None])
        return row[found], left[found].astype(np.int64) * back.shape[1] + right

    @staticmethod
    def _sums(inner: np.ndarray) -> np.ndarray:
        total = inner[:, 0]
        for i in range(1, inner.shape[1]):
            total = (total[:, :, None] + inner[:, i, None, :]).reshape(len(inner), -1)
        return total


_CLASS = "id bigint, label string, digest binary, vector binary"


def _vectors(rows: DataFrame) -> DataFrame:
    """Rows with a usable vector as bytes (of single precision where that is exact), and a digest of label and vector."""
    schema = arrow_schema(T.StructType.fromDDL(_CLASS))

    def read(parts):
        for part in parts:
            out = [[], [], [], []]
            for id_, label, v in zip(*(part.column(c).to_pylist() for c in ("id", "label", "v"))):
                if id_ is None or label is None or not v or None in v:
                    continue
                raw = np.array(v, np.float64) + 0.0
                if not np.isfinite(raw).all() or not raw.any():
                    continue
                short = raw.astype(np.float32)
                raw = b"f" + short.tobytes() if (short == raw).all() else b"d" + raw.tobytes()
                for column, value in zip(out, (id_, label, xxhash.xxh3_128_digest(label.encode() + b"\0" + raw), raw)):
                    column.append(value)
            yield batch(schema, *out)

    return rows.mapInArrow(read, _CLASS)


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _by_length(blobs: list[bytes]):
    """Rows and matrix of the vectors of each length."""
    vectors = [np.frombuffer(b, "f4" if b[:1] == b"f" else "f8", offset=1) for b in blobs]
    sizes = np.fromiter(map(len, vectors), np.int64, len(vectors))
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, np.stack([vectors[r] for r in rows]).astype(np.float64)


_LISTED = "cell bigint, id bigint, vector binary"
_PAIR = "a bigint, b bigint"


def _listed(ones: DataFrame) -> DataFrame:
    schema, codes = arrow_schema(T.StructType.fromDDL(_LISTED)), {}

    def decode(parts):
        for part in parts:
            for k in range(0, part.num_rows, 512):
                some = part.slice(k, 512)
                labels, blobs = some.column("label").to_pylist(), some.column("vector").to_pylist()
                ids = some.column("id").to_numpy()
                salt = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in labels], np.uint64)
                for rows, vectors in _by_length(blobs):
                    length = vectors.shape[1]
                    if length not in codes:
                        codes[length] = Code(length)
                    row, filter_ = codes[length].lists(_unit(vectors))
                    row = rows[row]
                    cell = (salt[row] + filter_.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.int64)
                    yield batch(schema, cell, ids[row], [blobs[r] for r in row])

    return ones.mapInArrow(decode, _LISTED)


def _links(listed: DataFrame, least: float) -> DataFrame:
    """Verified pairs ``(a, b)`` of vectors that share a cell. Large cells become pairs of blocks."""
    counts = listed.groupBy("cell").agg(F.count("*").alias("m")).filter("m > 1")
    rows = listed.join(counts, "cell")
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    rows = rows.select("cell", "id", "vector", blocks.alias("blocks"), F.pmod(F.xxhash64("id"), blocks).cast("int").alias("own"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = rows.select(F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other")).alias("place"),
                       F.when(F.col("own") < F.col("other"), 0).when(F.col("own") == F.col("other"), 1).otherwise(2).alias("side"), "id", "vector")
    schema = arrow_schema(T.StructType.fromDDL(_PAIR))

    def check(parts):
        for table in whole_groups(parts, "place", 4_000):
            ids, sides, places = (table.column(c).to_numpy() for c in ("id", "side", "place"))
            found = []
            for rows, vectors in _by_length(table.column("vector").to_pylist()):
                unit, id_, side, place = _unit(vectors), ids[rows], sides[rows], places[rows]
                cuts = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
                sizes = np.diff(np.append(cuts, len(place)))
                for lo, size in zip(cuts[sizes > 16], sizes[sizes > 16]):  # large groups as one product
                    near = unit[lo : lo + size] @ unit[lo : lo + size].T >= least
                    i, j = np.nonzero(np.triu(near, 1))
                    found.append(_apart(id_, side, lo + i, lo + j))
                small = np.repeat(sizes <= 16, sizes)
                for step in range(1, 16):
                    i = np.flatnonzero(small[:-step] & (place[step:] == place[:-step])) if step < len(place) else ()
                    if not len(i):
                        break
                    i = i[np.einsum("nd,nd->n", unit[i], unit[i + step]) >= least]
                    found.append(_apart(id_, side, i, i + step))
            if found:
                pairs = np.unique(np.concatenate(found), axis=0)
                yield batch(schema, pairs[:, 0], pairs[:, 1])

    pairs = rows.repartition("place").sortWithinPartitions("place").mapInArrow(check, _PAIR)
    return pairs.distinct()


def _apart(ids, side, i, j) -> np.ndarray:
    """Pairs of different ids that this pair of blocks is to compare: both in one block, or one in each."""
    good = ((side[i] == 1) & (side[j] == 1) | (side[i] != side[j])) & (ids[i] != ids[j])
    a, b = ids[i[good]], ids[j[good]]
    return np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)


def near_duplicates(rows: DataFrame, cosine: float = 0.98, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """A row for each vector: ``id``, ``n_links``, ``component_id`` and ``kept``."""
    named = rows.select(F.col(key).cast("bigint").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("v"))
    vectors = keep(_vectors(named), "vectors")
    classes = keep(vectors.groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "classes")
    ones = vectors.join(classes.select("digest", F.col("rep").alias("id")), ["digest", "id"], "left_semi").dropDuplicates(["digest"])
    links = keep(_links(_listed(ones.select("id", "label", "vector")), cosine), "links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = classes.groupBy("rep").agg(F.sum("copies").alias("copies"))
    linked = both.join(sizes.withColumnRenamed("rep", "b"), "b").groupBy("a").agg(F.sum("copies").alias("n"))
    found = components(links).select(F.col("node").alias("rep"), F.col("component").alias("c"))
    members = (
        vectors.select("id", "digest").join(classes, "digest")
        .join(found, "rep", "left").join(linked.withColumnRenamed("a", "rep"), "rep", "left")
        .groupBy("id").agg(F.max(F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.min(F.coalesce("c", "rep")).alias("c"))
    )
    whole = rows.select(F.col(key).cast("bigint").alias("id")).join(members, "id", "left")
    component = F.coalesce("c", "id")
    return whole.select("id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
                        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
