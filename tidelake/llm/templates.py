"""Benchmark decontamination by template windows.

Words lose their outer punctuation; numbers, capitalised words (names) and units after a number become typed
placeholders, all other words are compared in lower case. Other readings take successive names as one, take names as
words (for copies in another case), and take every word as it is. Windows of ``WINDOW`` words are hashed and joined with those
of the benchmark. Windows on one diagonal form a match; slots must be filled consistently within a run of windows: equal values of the
item stay equal in the document, so a re-parameterised question is caught and a chance agreement of placeholders is not.
Unlike values may become equal, and values that are apart may change independently of one another.

A window counts alone with ``LITERALS`` words that are no placeholder. Windows with ``FEW`` count as a consistent run of all the item's
windows, or of ``WINDOW`` of them. Items shorter than a window are one window of their own length; those under ``SHORTEST``
words match only as they are. A bitmap of ``FILTER_BITS`` bits, filled from all benchmark windows, keeps other
windows of the documents out of the join; its size does not depend on either table.

Defined cases: null, empty or punctuation-only texts and items match nothing; null ids of documents or items are ignored; rows that repeat an id count as one; an empty
table on either side gives an empty result; other columns pass through.
"""

from __future__ import annotations

import re
from itertools import product

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.shared import arrow_schema, batch, keep, mix, small, tidied

WINDOW, LITERALS, FEW, SHORTEST = 10, 6, 3, 5
FILTER_BITS = 22
CACHE_ENTRIES = 400_000
_NUMBER = re.compile(r"[-+−]?[$€£¥]?[0-9][0-9.,:/]*(?:%|st|nd|rd|th)?")
_EDGES = re.compile(r"^[^\w$€£¥+−-]+|[^\w%]+$")
# fixed values: units of measure that may follow a number
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds oz "
    "ounce ounces ml l liter liters litre litres s sec second seconds min minute minutes h hr hour hours day days week weeks month "
    "months year years percent degree degrees dollar dollars euro euros cent cents kmh mph w kw v hz".split()
)
_LITERAL, _NUM, _NAME, _UNIT, _NONE = range(5)
#: Added to the kind of a word that punctuation follows.
_STOP = 8


class Reader:
    """Words as codes: template hash, slot value and kind, looked up once for each distinct word."""

    def __init__(self):
        self.known: dict[str, int] = {}
        self.table = np.zeros((0, 3), np.uint64)

    @staticmethod
    def _describe(word: str) -> tuple[int, int, int]:
        core = _EDGES.sub("", word)
        if not core:
            return 0, 0, _NONE
        low = core.lower()
        own = xxhash.xxh3_64_intdigest(low.encode("utf-8", "surrogatepass")) | 1
        if _NUMBER.fullmatch(core):
            return 3, xxhash.xxh3_64_intdigest(core.replace(",", "").encode()) | 1, _NUM
        if core[0].isupper() and not (len(core) > 1 and core.isupper()):
            return 5, own, _NAME + _STOP * (not word[-1].isalnum())
        return own, own, _UNIT if low in UNITS else _LITERAL

    def read(self, text: str | None) -> list[tuple[np.ndarray, np.ndarray, bool]]:
        """``(template, slot, folded)`` of each word: with names as placeholders, with successive names as one, with names
        as words, and with every word as it is, so far as these differ; slot 0 marks a word that is no placeholder."""
        words = (text or "").split()
        new = set(words).difference(self.known)
        if new:
            if len(self.known) > CACHE_ENTRIES:
                self.known, self.table, new = {}, self.table[:0], set(words)
            at = len(self.table)
            self.table = self._grown(np.array([self._describe(w) for w in new], np.uint64))
            self.known.update(zip(new, range(at, at + len(new))))
        rows = self.table[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))]
        rows = rows[rows[:, 2] != _NONE]
        template, slot, kind = rows[:, 0].copy(), rows[:, 1].copy(), rows[:, 2] % _STOP
        unit = (kind == _UNIT) & np.append(False, kind[:-1] == _NUM) if len(kind) else np.zeros(0, bool)
        template[unit] = 7
        slot[(kind == _LITERAL) | ((kind == _UNIT) & ~unit)] = 0
        name = kind == _NAME
        plain = np.where(name, slot, template), np.where(name, np.uint64(0), slot), False
        found = [(template, slot, False)] if name.any() else []
        again = np.append(False, name[1:] & name[:-1] & (rows[:-1, 2] < _STOP)) if len(name) else name
        if again.any():
            begin = np.flatnonzero(~again)
            found.append((template[begin], np.add.reduceat(slot, begin), True))
        found.append(plain)
        if plain[1].any():
            found.append((np.where(slot != 0, rows[:, 1], template), np.zeros(len(rows), np.uint64), False))
        return found

    def _grown(self, more: np.ndarray) -> np.ndarray:
        """The table with more rows, in a buffer that doubles."""
        at = len(self.table)
        if not hasattr(self, "_buffer") or at + len(more) > len(self._buffer):
            self._buffer = np.zeros((2 * (at + len(more)) + 1024, 3), np.uint64)
            self._buffer[:at] = self.table
        self._buffer[at : at + len(more)] = more
        return self._buffer[: at + len(more)]


_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, which an odd base has."""
    if count > len(_POWERS[0]):
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            factors = np.full(2 * count, base, np.uint64)
            factors[0] = 1
            _POWERS[i] = np.cumprod(factors, dtype=np.uint64)
    return _POWERS[0][:count], _POWERS[1][:count]


def windows(template: np.ndarray, slot: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hash, place, alone)`` of the windows of ``length`` words with some literal words, and which have enough to count alone."""
    count = len(template) - length + 1
    if count < 1:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, bool)
    # a polynomial in an odd base, by prefix sums: all windows in a few operations
    power, inverse = _powers(len(template))
    prefix = np.append(np.uint64(0), np.cumsum(template * power, dtype=np.uint64))
    total = (prefix[length:] - prefix[:-length]) * inverse[:count] + np.uint64(length)
    literal = np.append(0, np.cumsum(slot == 0))
    literal = literal[length:] - literal[:-length]
    place = np.flatnonzero(literal >= (length if length < SHORTEST else -(-length * FEW // WINDOW)))
    return mix(total[place]), place, literal[place] >= min(LITERALS, -(-length * LITERALS // WINDOW))


_ROW = "h bigint, id bigint, place int, size int, slots array<bigint>, folded boolean, alone boolean"


def _rows(named: DataFrame, sizes, keep_hash=None) -> DataFrame:
    """Windows of ``(id, t)`` rows. ``sizes``: window lengths, or None for the whole text where it is shorter."""
    schema = arrow_schema(T.StructType.fromDDL(_ROW))

    def find(parts):
        reader = Reader()
        for part in parts:
            for k in range(0, part.num_rows, 1024):
                some, out = part.slice(k, 1024), [[] for _ in schema]
                for id_, text in zip(some.column("id").to_pylist(), some.column("t").to_pylist()):
                    if id_ is None:
                        continue
                    readings = reader.read(text)
                    for size, (template, slot, folded) in product(sizes or [None], readings):
                        size = size or min(WINDOW, len(template))
                        if not size:
                            continue
                        h, place, alone = windows(template, slot, size)
                        if keep_hash is not None:
                            near = keep_hash(h)
                            h, place, alone = h[near], place[near], alone[near]
                        for x, p, y in zip(h.astype(np.int64).tolist(), place.tolist(), alone.tolist()):
                            for column, value in zip(out, (x, id_, p, size, slot[p : p + size].astype(np.int64), folded, y)):
                                column.append(value)
                yield batch(schema, *out)

    return named.mapInArrow(tidied(find), _ROW)


def matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(doc, item, windows, of_windows, same_values)``: consistent matches, a row for each document and item."""
    items = benchmark.select(F.col(item).cast("bigint").alias("id"), F.col(item_text).alias("t"))
    asked = keep(_rows(items, None), "benchmark-windows")
    sizes = sorted(r.size for r in asked.select("size").distinct().collect())  # at most WINDOW lengths
    mask = (1 << FILTER_BITS) - 1
    # at most 2**FILTER_BITS / 32 words of the bitmap reach the driver
    bits = asked.selectExpr(f"shiftright(h & {mask}, 5) AS w", "shiftleft(1L, CAST(h & 31 AS INT)) AS b")
    bitmap = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    for r in bits.groupBy("w").agg(F.bit_or("b").alias("b")).collect():
        bitmap[r.w] = r.b
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def near(h: np.ndarray) -> np.ndarray:
        at = (h & np.uint64(mask)).astype(np.int64)
        return np.flatnonzero(shared.value[at >> 5] >> (at & 31).astype(np.uint32) & 1)

    named = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("t"))
    found = _rows(named, sizes or [WINDOW], near).withColumnsRenamed({"id": "doc", "folded": "doc_folded"}).drop("alone")
    asked_ = asked.select("h", "size", "folded", "alone", F.col("id").alias("item"), F.col("place").alias("item_place"), F.col("slots").alias("item_slots"))
    met = found.join(asked_, ["h", "size"])
    pairs = F.filter(F.arrays_zip(F.col("item_slots").alias("v"), F.col("slots").alias("u")), lambda p: p.v != 0)
    met = met.select("doc", "item", (F.col("place") - F.col("item_place")).alias("diagonal"), "folded", "doc_folded", "alone", "item_place", pairs.alias("pairs"))
    # a window that contradicts itself is none; an item's windows bound what one group collects
    met = met.filter(_consistent(F.col("pairs")))
    runs = met.groupBy("doc", "item", "folded", "doc_folded", "diagonal").agg(
        F.sort_array(F.collect_set(F.struct("item_place", "pairs"))).alias("windows"), F.max("alone").alias("alone")
    )
    of = asked.groupBy(F.col("id").alias("item"), "folded").agg(F.count_distinct("place").alias("of"))
    runs = runs.join(of, ["item", "folded"]).withColumn("need", F.least("of", F.lit(WINDOW)).cast("int"))
    begins = F.sequence(F.lit(1), F.size("windows") - F.col("need") + 1)
    some = F.exists(begins, lambda i: _consistent(F.flatten(F.transform(F.slice("windows", i, F.col("need")), lambda w: w.pairs))))
    runs = runs.filter(F.col("alone") | F.when(F.size("windows") >= F.col("need"), some).otherwise(False))
    runs = runs.withColumn("same", F.forall("windows", lambda w: F.forall(w.pairs, lambda p: p.v == p.u)))
    runs = runs.withColumn("places", F.transform("windows", lambda w: F.struct(F.col("folded").alias("folded"), w.item_place.alias("item_place"))))
    total = asked.groupBy(F.col("id").alias("item")).agg(F.count_distinct("folded", "place").alias("of_windows"))
    merged = runs.groupBy("doc", "item").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("places")))).alias("windows"), F.max("same").alias("same_values")
    )
    return merged.join(total, "item").select("doc", "item", "windows", "of_windows", "same_values")


def _consistent(pairs: Column) -> Column:
    """Whether equal values of the item stand for equal values of the document."""
    distinct = F.array_distinct(pairs)
    return F.size(distinct) == F.size(F.array_distinct(F.transform(distinct, lambda p: p.v)))


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without those that hold a passage of the benchmark."""
    found = keep(matches(docs, benchmark, key, text).select(F.col("doc").alias(key)).distinct(), "documents-with-items")
    return docs.join(small(found), key, "left_anti").select(*docs.columns)
