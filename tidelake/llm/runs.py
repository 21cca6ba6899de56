"""Periodic runs of words by internal pattern matching, and texts with the repetitions taken out.

A run is a stretch of consecutive words with smallest period q that is at least ``least`` words and two periods long and that
no neighbouring word extends keeping the period. For every run some dyadic block of its words recurs q words later:

* words are numbered within their document, and prefix doubling sorts all suffixes of a batch of documents; the ranks of every
  doubling stay, as they tell blocks of 2^k words apart;
* blocks of m = 2^k words start at every multiple of m/2. What recurs one period later in a run has at least
  ``max(q, least - q)`` words, so it holds a block with ``m + m/2 - 1`` no greater than that: each m serves the periods
  from ``3m/2 - 1`` up to where 2m takes over, the least m all smaller ones;
* the occurrences of a block in the neighbouring window of these distances are range successors in the suffix-array interval of the
  block: a wavelet matrix over the suffix array counts smaller positions and selects the next one. Occurrences that start
  within m words of one another are an arithmetic progression, so the first, the second and the count tell all;
* if a progression and its block lie in one stretch with the progression's difference as period, greater distances are no
  smallest periods; else each distance is a candidate, which the ranks extend in both directions to the whole run. Of
  candidates for one stretch the smallest period stays.

Documents are independent, so there is no shuffle and no group; batches hold about ``BATCH_WORDS`` words, or one longer document,
and need some forty integers a word.

Defined cases: a null, empty or blank text has no words, no runs and collapses to an empty text; rows that repeat an id are
treated each; an empty table gives no rows; only the key and the text column are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.shared import arrow_schema, batch

WORD = re.compile(r"[^ \t-\r]+")
BATCH_WORDS = 1 << 17
RUN = ("start", "length", "period")


class Runs(NamedTuple):
    """Runs of a batch in flat word positions, ordered by start and period; ``stop`` is exclusive."""

    start: np.ndarray
    stop: np.ndarray
    period: np.ndarray


class WaveletMatrix:
    """Order statistics of any interval of a sequence of distinct numbers below its length."""

    def __init__(self, values: np.ndarray):
        self.levels: list[tuple[int, np.ndarray, int]] = []
        for bit in range(max(1, int(len(values) - 1).bit_length()) - 1, -1, -1):
            ones = (values >> bit) & 1
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(1 - ones, out=before[1:])
            self.levels.append((bit, before, int(before[-1])))
            values = np.concatenate([values[ones == 0], values[ones == 1]])

    def below(self, left: np.ndarray, right: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many numbers of each interval are less than its bound."""
        count = np.zeros(len(left), np.int64)
        beyond = bound >> (self.levels[0][0] + 1) > 0
        all_ = right - left
        for bit, before, zeros in self.levels:
            a, b = before[left], before[right]
            one = (bound >> bit) & 1 == 1
            count += np.where(one, b - a, 0)
            left, right = np.where(one, zeros + left - a, a), np.where(one, zeros + right - b, b)
        return np.where(beyond, all_, count)

    def smallest(self, left: np.ndarray, right: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The number of each interval that has ``k`` smaller ones in it."""
        value = np.zeros(len(left), np.int64)
        k = k.copy()
        for bit, before, zeros in self.levels:
            a, b = before[left], before[right]
            one = k >= b - a
            k -= np.where(one, b - a, 0)
            value += one.astype(np.int64) << bit
            left, right = np.where(one, zeros + left - a, a), np.where(one, zeros + right - b, b)
        return value


class Suffixes:
    """Suffix order of a batch by prefix doubling; ``ranks[k]`` is equal where blocks of 2^k words are.

    A rank is the place in suffix order of the first suffix with that block. Blocks that the document's end cuts are unlike all.
    """

    def __init__(self, codes: np.ndarray, ends: np.ndarray, deepest: int):
        n = len(codes)
        self.codes, self.ends = codes, ends
        self.order = np.argsort(codes, kind="stable")
        rank = np.empty(n, np.int64)
        rank[self.order] = self._heads(codes[self.order])
        self.ranks = [rank.astype(np.int32)]
        for k in range(deepest):
            step = 1 << k
            slots = self.shared(k)
            if not len(slots):
                break
            at = self.order[slots]
            after = np.where(at + step < ends[at], rank[np.minimum(at + step, n - 1)] + 1, 0)
            sorted_ = np.argsort(key := rank[at] * (n + 1) + after, kind="stable")
            at, key = at[sorted_], key[sorted_]
            self.order[slots] = at
            rank[at] = slots[self._heads(key)]
            self.ranks.append(rank.astype(np.int32))

    @staticmethod
    def _heads(sorted_: np.ndarray) -> np.ndarray:
        """For each place of a sorted sequence the first place with an equal value."""
        place = np.arange(len(sorted_))
        return np.maximum.accumulate(np.where(np.diff(sorted_, prepend=-1) != 0, place, 0))

    def shared(self, k: int) -> np.ndarray:
        """Places in suffix order whose block of 2^k words occurs elsewhere in the document."""
        rank = self.ranks[k][self.order]
        equal = rank[1:] == rank[:-1]
        found = np.zeros(len(rank), bool)
        found[1:] |= equal
        found[:-1] |= equal
        return np.flatnonzero(found)

    def agree_after(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from ``i < j`` on are equal."""
        return self._agree(i, j, 1, self.ends[j] - j if len(j) else j)

    def agree_before(self, i: np.ndarray, j: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """How many words before ``i < j`` are equal, none of them before ``begin``."""
        return self._agree(i, j, -1, i - begin)

    def _agree(self, i: np.ndarray, j: np.ndarray, way: int, room: np.ndarray) -> np.ndarray:
        total = np.zeros(len(i), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            step, rank = 1 << k, self.ranks[k]
            active = np.flatnonzero(room - total >= step)
            while len(active):  # more than once at the top only
                shift = total[active] if way > 0 else -total[active] - step
                active = active[rank[i[active] + shift] == rank[j[active] + shift]]
                total[active] += step
                active = active[(room - total)[active] >= step] if k == len(self.ranks) - 1 else active[:0]
        return total


def find(codes: np.ndarray, begins: np.ndarray, ends: np.ndarray, least: int = 12) -> Runs:
    """All runs of a batch of documents. ``codes`` differ between documents; ``begins`` and ``ends`` give each word's document."""
    none = np.empty(0, np.int64)
    longest = int((ends - begins).max()) if len(codes) else 0
    if longest < max(least, 2):
        return Runs(none, none, none)

    def need(k: int) -> int:
        return (1 << k) + max(1, (1 << k) >> 1) - 1

    base = 0
    while need(base + 1) <= -(-least // 2):
        base += 1
    top = base
    while need(top + 1) <= longest // 2:
        top += 1
    suffixes = Suffixes(codes, ends, top)
    if len(suffixes.ranks) <= base:
        return Runs(none, none, none)
    slots = suffixes.shared(base)
    if not len(slots):
        return Runs(none, none, none)
    # the wavelet matrix holds what recurs at all, in suffix order, as places among these suffixes by position
    positions = np.sort(suffixes.order[slots])
    wavelet = WaveletMatrix(np.searchsorted(positions, suffixes.order[slots]))
    found = []
    for k in range(base, len(suffixes.ranks)):
        m, rank = 1 << k, suffixes.ranks[k]
        at = positions[((positions - begins[positions]) % max(1, m >> 1) == 0) & (positions + m <= ends[positions])]
        left = np.searchsorted(slots, rank[at])
        width = np.bincount(np.searchsorted(slots, rank[suffixes.order[slots]]), minlength=len(slots) + 1)[left]
        # a block that is alone has its own place as rank, or none here
        some = (width > 1) & (slots[np.minimum(left, len(slots) - 1)] == rank[at])
        at, left, width = at[some], left[some], width[some]
        low, high = (1 if k == base else need(k)), need(k + 1) - 1
        for near in range(low, high + 1, m):
            far = min(near + m - 1, high)
            found.append(_candidates(suffixes, wavelet, positions, at, left, left + width, near, far, m))
    p, q = (np.concatenate(x) for x in zip(*found))
    before = suffixes.agree_before(p, p + q, begins[p])
    start, stop = p - before, p + q + suffixes.agree_after(p, p + q)
    real = stop - start >= np.maximum(least, 2 * q)
    start, stop, q = start[real], stop[real], q[real]
    order = np.lexsort((q, stop, start))
    start, stop, q = start[order], stop[order], q[order]
    first = np.ones(len(q), bool)
    first[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    order = np.lexsort((q[first], start[first]))
    return Runs(start[first][order], stop[first][order], q[first][order])


def _candidates(suffixes, wavelet, positions, at, left, right, near, far, m) -> tuple[np.ndarray, np.ndarray]:
    """Blocks and distances from ``near`` to ``far``, fewer than m apart, at which they recur and which may be smallest periods."""
    skipped = wavelet.below(left, right, np.searchsorted(positions, at + near))
    count = wavelet.below(left, right, np.searchsorted(positions, at + far + 1)) - skipped
    some = count > 0
    at, left, right, skipped, count = at[some], left[some], right[some], skipped[some], count[some]
    first = positions[wavelet.smallest(left, right, skipped)]
    several = np.flatnonzero(count > 1)
    step = np.zeros(len(at), np.int64)
    step[several] = positions[wavelet.smallest(left[several], right[several], skipped[several] + 1)] - first[several]
    # three occurrences make their difference a period of the block; is it one of all up to the last?
    several = np.flatnonzero(count > 2)
    reach = first[several] + (count[several] - 1) * step[several] + m - at[several] - step[several]
    inner = suffixes.agree_after(at[several], at[several] + step[several]) >= reach
    same = several[inner]
    count[same] = first[same] - at[same] == step[same]
    nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(at, count), np.repeat(first - at, count) + nth * np.repeat(step, count)


def analyse(texts: list[str | None], least: int = 12):
    """For each text its words, its runs as rows ``(start, length, period)`` by start, then period, and which words stay (None: all)."""
    words = [WORD.findall(t) if t else [] for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    codes, known = np.empty(edges[-1], np.int64), 0
    for w, a, b in zip(words, edges.tolist(), edges[1:].tolist()):
        number: dict[str, int] = {}
        codes[a:b] = [number.setdefault(x, len(number)) for x in w]
        codes[a:b] += known
        known += len(number)
    begins = np.repeat(edges[:-1], sizes)
    found = find(codes, begins, np.repeat(edges[1:], sizes), least)
    change = np.zeros(edges[-1] + 1, np.int64)
    np.add.at(change, found.start + found.period, 1)
    np.add.at(change, found.stop, -1)
    stays = np.cumsum(change[:-1]) == 0
    cut = np.searchsorted(found.start, edges)
    rows = np.stack([found.start, found.stop - found.start, found.period], axis=1)
    for i, (w, a, b) in enumerate(zip(words, edges.tolist(), edges[1:].tolist())):
        own = rows[cut[i] : cut[i + 1]] - np.array([a, 0, 0])
        yield w, own, stays[a:b] if len(own) else None


def _per_document(docs: DataFrame, key: str, text: str, least: int, fields: str, row) -> DataFrame:
    """Apply ``row(words, runs, stays)``, which gives the values of ``fields``, to every document."""
    schema = T.StructType([T.StructField("id", docs.schema[key].dataType), *T.StructType.fromDDL(fields)])
    arrow = arrow_schema(schema)

    def run(batches):
        for part in batches:
            texts = part.column("t").to_pylist()
            sizes = np.array([len(t) // 4 + 1 if t else 1 for t in texts], np.int64)
            before = np.cumsum(sizes) - sizes
            cuts = np.flatnonzero(np.diff(before // BATCH_WORDS, prepend=-1)).tolist()
            for a, b in zip(cuts, [*cuts[1:], len(texts)]):
                made = [row(*x) for x in analyse(texts[a:b], least)]
                yield batch(arrow, part.column("id")[a:b], *zip(*made))

    return docs.select(F.col(key).alias("id"), F.col(text).alias("t")).mapInArrow(run, schema)


def kept_text(words: list[str], stays: np.ndarray | None) -> str:
    return " ".join(words if stays is None else [words[i] for i in np.flatnonzero(stays).tolist()])


def runs(docs: DataFrame, least: int = 12, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n, start, length, period)``: one row for each run, the ``n``-th of its document by start, then period."""
    kind = "found array<struct<start: bigint, length: bigint, period: bigint>>"
    found = _per_document(docs, key, text, least, kind, lambda w, r, s: ([dict(zip(RUN, x)) for x in r.tolist()],))
    return found.select("id", F.posexplode("found").alias("n", "run")).select("id", "n", "run.*")


def collapse(docs: DataFrame, least: int = 12, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, text, n_dropped)``: words that any run holds after its first period are dropped, others joined by one space."""
    return _per_document(docs, key, text, least, "text string, n_dropped bigint", lambda w, r, s: (kept_text(w, s), 0 if s is None else int((~s).sum())))


def digest(docs: DataFrame, least: int = 12, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document the number of runs, its longest one (ties: smallest start, then period) and digests of all runs and of the collapsed text."""
    fields = "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"

    def row(words, found, stays):
        best = (None,) * 4
        if len(found):
            start, length, period = min(found.tolist(), key=lambda x: (-x[1], x[0], x[2]))
            best = start, length, period, 1000 * length // period
        listed = "".join(f"{a},{b},{c}\n" for a, b, c in found.tolist())
        return len(found), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept_text(words, stays).encode()).hexdigest()

    return _per_document(docs, key, text, least, fields, row)


def planted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents of which about a tenth, by crc32 of the id, repeat a piece of their own words to the end; a test bed for runs.

    With h the checksum and g = floor(h / 10): if h % 10 = 0, word i >= a = g % n becomes word a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8)).
    """
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col(text), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    hit = F.coalesce(h % 10 == 0, F.lit(False))
    bare = docs.select(key, text, F.when(hit, words).alias("w"), F.floor(h / 10).alias("g"))
    n = F.size("w")
    first = (F.col("g") % n).cast("int")
    period = F.floor((n - first) / (3 + F.col("g") % 8)).cast("int") + 1
    piece = F.slice("w", first + 1, period)
    tail = F.slice(F.flatten(F.array_repeat(piece, F.ceil((n - first) / period).cast("int"))), 1, n - first)
    made = F.array_join(F.concat(F.slice("w", F.lit(1), first), tail), " ")
    return bare.select(key, F.when(F.size(F.coalesce("w", F.array().cast("array<string>"))) > 0, made).otherwise(F.col(text)).alias(text))
