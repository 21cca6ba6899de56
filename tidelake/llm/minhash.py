"""Near-duplicate documents: banded MinHash candidates, odd-sketch filter, exact check on full shingle sets.

A document's set holds its distinct shingles of ``words`` words; texts with fewer words have one shingle, the
whole sequence. Documents are linked if 100 * intersection >= percent * union.

1. Every text becomes a set digest, band keys of MinHash samples of 96 functions, and an odd sketch: the set's
   bottom MinHash samples folded into a parity bitmap, so that the population count of the XOR of two bitmaps
   tells how many samples differ, and with it a high similarity.
2. Equal sets form a class with the smallest id as representative; only representatives go on.
3. Each representative is paired with the smallest document of all its band buckets; pairs that the sketches do not
   rule out are checked on full sets. Links give components.
4. Buckets that still hold several components compare the members outside the largest component with all
   others, in blocks: in the first rounds only with the one member of another component whose sketch is the
   most similar, as components at least halve wherever such pairs link, then, for the components that
   remain, with all. So no bucket is capped, collected in one task or expanded inside one component.

The sketch filter lies five standard deviations below the threshold and is lossless for sets of up to
``SKETCH_SAMPLES`` shingles; bands miss a pair at the threshold with a probability of 3e-6.

Defined cases: null and empty texts and texts of white space have size 0 and link with nothing; rows with a null
id have a null component, are kept and link with nothing; rows that repeat an id are separate documents that
share it, and their ties go to the smallest id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.shared import arrow_schema, batch, components, keep, mix, small, tidied, whole_groups

BANDS, ROWS = 24, 4
SAMPLES = BANDS * ROWS
#: Bottom samples that are folded into a sketch; the whole set where it has no more.
SKETCH_SAMPLES = 1024
SKETCH_BITS = 2048
#: Standard deviations by which a sketch may miss the threshold.
SKETCH_MARGIN = 5.0
BLOCK = 256
#: Rounds in which each document outside its bucket's largest component is compared with one other.
CLOSEST_ROUNDS = 2

_random = np.random.default_rng(20240601)
_FACTORS = _random.integers(0, 1 << 31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_OFFSETS = _random.integers(0, 1 << 32, SAMPLES, dtype=np.uint64).astype(np.uint32)


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of the whole text."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    length = min(words, len(h))
    total = h[: len(h) - length + 1].copy()
    for i in range(1, length):
        total = mix(total) * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - length + 1 + i]
    return np.unique(mix(total + np.uint64(length)))


def samples(hashes: np.ndarray) -> np.ndarray:
    """MinHash samples of a non-empty set."""
    x, least = (hashes >> np.uint64(32)).astype(np.uint32), np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 8192):
        np.minimum(least, (x[i : i + 8192, None] * _FACTORS + _OFFSETS).min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    keys = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys.astype(np.int64)


def odd_sketch(hashes: np.ndarray) -> np.ndarray:
    """Parity bitmap of the bottom MinHash samples of a sorted set: each flips the bit that it hashes to."""
    bit = mix(hashes[:SKETCH_SAMPLES] + np.uint64(1)) % np.uint64(SKETCH_BITS)
    odd = (np.bincount(bit.astype(np.int64), minlength=SKETCH_BITS) & 1).astype(bool)
    return np.packbits(odd).view(np.int64)


def most_bits(n, m, percent: int, least=np.minimum, greatest=np.maximum, sqrt=np.sqrt):
    """Differing bits up to which the sketches of sets of sizes ``n`` and ``m`` may stand for this similarity.

    Each side's samples are drawn without replacement from its set, so the common ones are hypergeometric. Sets
    that were folded whole have no such error: the parity bits then never exceed the symmetric difference.
    The other way, two samples in one bit cancel; their number is close to a Poisson variable.
    """
    both = (n + m) * (percent / (100 + percent))

    def fewest(size):
        drawn, share = least(size, SKETCH_SAMPLES + 0 * size), least(both / size, 1 + 0 * size)
        return drawn * share - SKETCH_MARGIN * sqrt(drawn * share * (1 - share) * (1 - drawn / size))

    limit = SKETCH_SAMPLES + 0 * n
    differing = least(n, limit) + least(m, limit) - 2 * least(fewest(n), fewest(m))
    cancelled = differing * differing / (2 * SKETCH_BITS)
    return differing - 2 * greatest(cancelled - SKETCH_MARGIN * sqrt(cancelled), 0 * n) + 1e-6


_SIGNED = "id bigint, n bigint, digest binary, bands array<bigint>, sketch array<bigint>"


def signatures(docs: DataFrame, words: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    schema = arrow_schema(T.StructType.fromDDL(_SIGNED))

    def sign(parts):
        for part in parts:
            n, digest, bands, sketch = [], [], [], []
            for t in part.column("t").to_pylist():
                found = shingles(t, words)
                n.append(len(found))
                if not len(found):
                    for column in (digest, bands, sketch):
                        column.append(None)
                    continue
                least = samples(found)
                digest.append(xxhash.xxh3_128_digest(found.tobytes()))
                bands.append(band_keys(least))
                sketch.append(odd_sketch(found))
            yield batch(schema, part.column("id"), n, digest, bands, sketch)

    return docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("t")).mapInArrow(tidied(sign), _SIGNED)


def _blocks(n, size: int = BLOCK):
    return F.greatest(F.ceil(n / F.lit(size)), F.lit(1)).cast("int")


def _verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that are links. Each task streams a leader's text and then its members'.

    A leader is told by its class digest as well as its id, as rows may share an id.
    """
    sizes = pairs.groupBy("a", "da").agg(F.count("*").alias("m"))
    block = F.pmod(F.xxhash64("b"), _blocks(F.col("m"))).alias("block")
    pairs = pairs.join(sizes, ["a", "da"]).select("a", "da", "b", "db", block)
    wanted = (
        pairs.select("a", "da", "block", F.col("a").alias("id"), F.col("da").alias("digest"), F.lit(0).alias("role"))
        .distinct()
        .unionByName(pairs.select("a", "da", "block", F.col("b").alias("id"), F.col("db").alias("digest"), F.lit(1).alias("role")))
    )
    wanted = keep(wanted, "wanted-texts")
    rows = docs.join(small(keep(wanted.select("id").distinct(), "wanted-ids")), "id", "left_semi").join(wanted, "id").select("a", "da", "block", "role", "id", "digest", "t")
    rows = rows.repartition("a", "da", "block").sortWithinPartitions("a", "da", "block", "role")
    schema = arrow_schema(T.StructType.fromDDL("a bigint, b bigint"))

    def check(parts):
        leader, at = None, None
        for part in parts:
            linked = []
            for a, da, block, role, b, digest, t in zip(*(part.column(c).to_pylist() for c in ("a", "da", "block", "role", "id", "digest", "t"))):
                if role and (a, da, block) != at:
                    continue
                found = shingles(t, words)
                if xxhash.xxh3_128_digest(found.tobytes()) != digest:
                    continue
                if not role:
                    leader, at = found, (a, da, block)
                    continue
                place = np.minimum(np.searchsorted(leader, found), len(leader) - 1)
                both = int((leader[place] == found).sum())
                if 100 * both >= percent * (len(leader) + len(found) - both):
                    linked.append((a, b))
            yield batch(schema, [x[0] for x in linked], [x[1] for x in linked])

    return rows.mapInArrow(tidied(check), "a bigint, b bigint")


def _near(a, b, percent: int):
    """Sizes and sketches do not rule the pair out."""
    n, m = a.n.cast("double"), b.n.cast("double")
    bits = F.aggregate(F.zip_with(a.sketch, b.sketch, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    limit = most_bits(n, m, percent, F.least, F.greatest, F.sqrt)
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (bits <= limit)


def _cross_pairs(mixed: DataFrame, percent: int, closest: bool) -> DataFrame:
    """Pairs of unlike components in buckets ``(bucket, id, component, outside, n, sketch, members, outsiders)``.

    ``closest``: for each row that is outside, only the member of another component with the most similar sketch.
    """
    rows = mixed.select("*", F.pmod(F.xxhash64("id"), _blocks(F.col("members"))).alias("i"), F.pmod(F.xxhash64("id"), _blocks(F.col("outsiders"))).alias("o"))
    every = rows.select("*", F.lit(0).alias("side"), F.explode(F.sequence(F.lit(0), _blocks(F.col("outsiders")) - 1)).alias("p"), F.col("i").cast("int").alias("q"))
    outside = rows.filter("outside").select("*", F.lit(1).alias("side"), F.col("o").cast("int").alias("p"), F.explode(F.sequence(F.lit(0), _blocks(F.col("members")) - 1)).alias("q"))
    cells = every.unionByName(outside).select(F.xxhash64("bucket", "p", "q").alias("cell"), "side", "id", "component", "n", "sketch")
    cells = cells.repartition("cell").sortWithinPartitions("cell")
    found_schema = "id bigint, other bigint, bits int"
    schema = arrow_schema(T.StructType.fromDDL(found_schema))

    def compare(parts):
        for rows in whole_groups(parts, "cell", 5_000):
            cell, side, ids, comp, n = (rows.column(c).to_numpy() for c in ("cell", "side", "id", "component", "n"))
            sketch = rows.column("sketch").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(ids), -1)
            cuts = [0, *(np.flatnonzero(cell[1:] != cell[:-1]) + 1), len(cell)]
            left, right, differing = [], [], []
            for lo, hi in zip(cuts, cuts[1:]):
                x = lo + np.flatnonzero(side[lo:hi] == 1)
                y = lo + np.flatnonzero(side[lo:hi] == 0)
                for i in x:
                    near = y[comp[y] != comp[i]]
                    near = near[100 * np.minimum(n[near], n[i]) >= percent * np.maximum(n[near], n[i])]
                    bits = np.bitwise_count(sketch[near] ^ sketch[i]).sum(axis=1)
                    possible = bits <= most_bits(float(n[i]), n[near].astype(float), percent)
                    near, bits = near[possible], bits[possible]
                    if closest and len(near) > 1:
                        best = np.lexsort((ids[near], bits))[:1]
                        near, bits = near[best], bits[best]
                    left.append(np.full(len(near), ids[i]))
                    right.append(ids[near])
                    differing.append(bits)
            if left:
                yield batch(schema, np.concatenate(left), np.concatenate(right), np.concatenate(differing).astype(np.int32))

    found = cells.mapInArrow(tidied(compare), found_schema)
    if closest:
        found = found.groupBy("id").agg(F.min(F.struct("bits", "other")).alias("best")).select("id", "best.other")
    return found.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).filter("a < b").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document: ``id``, ``n_shingles``, ``component_id`` and ``kept``."""
    signed = keep(signatures(docs, words, key, text), "signatures")
    classes = signed.filter("digest IS NOT NULL AND id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("rep"))
    classes = keep(classes, "classes")
    ones = signed.join(classes.select("digest", F.col("rep").alias("id")), ["digest", "id"], "left_semi").dropDuplicates(["digest", "id"])
    texts = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("t"))
    buckets = ones.select("id", F.explode("bands").alias("bucket"))
    led = buckets.groupBy("bucket").agg(F.min("id").alias("a"), F.count("*").alias("members")).filter("members > 1")
    buckets = keep(buckets.join(led, "bucket"), "buckets")
    # sketches of those that share a bucket, which few do
    shared = ones.select("id", "digest", "n", "sketch").join(buckets.select("id").distinct(), "id", "left_semi")
    sketches = keep(shared, "sketches")

    def candidates(pairs: DataFrame) -> DataFrame:
        a = sketches.select(F.col("id").alias("a"), F.col("digest").alias("da"), F.struct("n", "sketch").alias("xa"))
        b = sketches.select(F.col("id").alias("b"), F.col("digest").alias("db"), F.struct("n", "sketch").alias("xb"))
        both = pairs.join(a, "a").join(b, "b")
        return both.filter(_near(F.col("xa"), F.col("xb"), percent)).select("a", "b", "da", "db")

    # one pair for each document: the smallest leader of its buckets
    tried = candidates(buckets.filter("id <> a").groupBy(F.col("id").alias("b")).agg(F.min("a").alias("a")))
    tried = keep(tried, "pairs")
    links = keep(_verified(tried, texts, words, percent), "links")
    joined = keep(components(links), "components")
    for closest in [True] * CLOSEST_ROUNDS + [False]:
        # what remains: buckets of several components
        marked = buckets.join(joined.withColumnRenamed("node", "id"), "id", "left").select(
            "bucket", "id", "members", F.coalesce("component", "id").alias("component")
        )
        several = marked.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y")
        marked = keep(marked.join(several.select("bucket"), "bucket", "left_semi"), "mixed")
        sizes = marked.groupBy("bucket", "component").agg(F.count("*").alias("m"))
        largest = sizes.groupBy("bucket").agg(F.max(F.struct("m", "component")).alias("top"), F.sum("m").alias("all"))
        mixed = marked.join(largest, "bucket").join(sketches.select("id", "n", "sketch"), "id").select(
            "bucket", "id", "component", "members", "n", "sketch",
            (F.col("component") != F.col("top.component")).alias("outside"), (F.col("all") - F.col("top.m")).alias("outsiders"),
        )
        if closest:
            # one bucket for each outsider, its largest
            home = mixed.filter("outside").groupBy("id").agg(F.max(F.struct("members", "bucket")).alias("home"))
            home = home.select("id", F.col("home.bucket").alias("home"))
            mixed = mixed.join(home, "id", "left").withColumn("outside", F.col("outside") & (F.col("home") == F.col("bucket")))
            mixed = mixed.join(home.select(F.col("home").alias("bucket")).distinct(), "bucket", "left_semi")
        pairs = _cross_pairs(mixed, percent, closest).join(tried.select("a", "b"), ["a", "b"], "left_anti")
        pairs = keep(candidates(pairs), "pairs")
        if pairs.isEmpty():
            continue
        more = keep(_verified(pairs, texts, words, percent), "links")
        tried, links = tried.unionByName(pairs), links.unionByName(more)
        joined = keep(components(links), "components")
    joined = joined.select(F.col("node").alias("rep"), F.col("component").alias("c"))
    rows = signed.select("id", "n", "digest").join(classes, "digest", "left").join(joined, "rep", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("c", "rep", "id"))
    return rows.select("id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                       F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without later members of a group. Rows that share an id stay or go together, except that a
    row stays if any row of its id is kept; of rows that share id and text one stays."""
    found = near_duplicates(docs, words, percent, key, text)
    marks = found.groupBy(F.col("id").alias("__id")).agg(F.bool_or("kept").alias("__kept"), F.count("*").alias("__rows"))
    marks = keep(marks.filter("__id IS NOT NULL AND (NOT __kept OR __rows > 1)"), "near-duplicates")
    marked = docs.join(small(marks), F.col(key) == F.col("__id"), "left").filter("coalesce(__kept, true)")
    once = marked.filter("__rows IS NULL OR __rows = 1").select(*docs.columns)
    return once.unionByName(marked.filter("__rows > 1").select(*docs.columns).dropDuplicates([key, text]))
