"""Exact repeated substrings by longest-previous-factor arrays over grouped suffixes.

A byte is repeated if it lies in a string of ``length`` bytes that also starts elsewhere, in any document.

1. Each window of ``length`` bytes belongs to its minimizer: the leftmost smallest hash of its grams. Equal windows have
   equal minimizers at equal offsets, so windows are compared only within one minimizer's group. A run of windows with
   one minimizer is one row: the gram's hash, a digest of the bytes that the run spans, and its place.
2. Grams that occur once are done. Runs with equal digests are repeated as a whole.
3. Different runs of one gram are compared by suffix order: the suffixes at the gram are sorted, every step to the
   left prepends one byte by a stable sort, and previous and next smaller positions in that order give each suffix
   its longest previous factor. Grams with more than ``HOT`` different runs compare digests of all their windows
   instead, which spreads over all tasks.

With ``keep_first`` the earliest copy (by id, then place) stays; otherwise all copies count, as longest
previous and longest next factors.

Defined cases: null texts are empty; texts shorter than ``length`` have no repeats; overlapping repeats count; null
ids sort first; rows that repeat an id are told apart by a digest of their text, and equal rows are copies of each
other that are all treated alike; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.shared import arrow_schema, batch, keep, mix, tidied, whole_groups

GRAM = 32
#: So many different runs of one gram are compared in one task (about 20 MB).
HOT = 30_000


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = pick(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return pick(x[:-rest], x[rest:]) if rest else x


def _gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from every position, by doubling."""
    h, span = mix(raw.astype(np.uint64) + np.uint64(1)), 1
    while span < GRAM:
        h = h[:-span] * np.uint64(0x9E3779B97F4A7C15) + h[span:]
        h ^= h >> np.uint64(31)
        span *= 2
    return h * np.uint64(0xBF58476D1CE4E5B9)


def runs(raw: bytes, length: int) -> tuple[np.ndarray, ...]:
    """``(hash, first, place, last)``: windows that start at first..last have their minimizer at place."""
    if len(raw) < length:
        none = np.empty(0, np.int64)
        return none, none, none, none
    h = _gram_hashes(np.frombuffer(raw, np.uint8))
    width = length - GRAM + 1
    least = _sliding(h, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    chosen = _sliding(np.concatenate([edge, least, edge]), width, np.maximum) == h
    places = np.flatnonzero(chosen)
    # the minimizer can change only where the smallest hash does, or where the place drops out on the left
    changes = np.append(True, (least[1:] != least[:-1]) | chosen[: len(least) - 1])
    first = np.flatnonzero(changes)
    at = np.searchsorted(places, first)
    while True:
        off = np.flatnonzero(h[places[at]] != least[first])
        if not len(off):
            break
        at[off] += 1
    place = places[at]
    new = np.append(True, place[1:] != place[:-1])
    first, place = first[new], place[new]
    last = np.append(first[1:], len(least)) - 1
    return h[place].astype(np.int64), first, place, last


def factors(order: np.ndarray, lcp: np.ndarray, position: np.ndarray, least: int) -> np.ndarray:
    """Longest previous factor of each suffix, where it reaches ``least`` (else 0).

    ``order`` lists suffixes in suffix order, ``lcp[i]`` is the common prefix of order[i - 1] and order[i]. The previous
    and the next suffix in that order with a smaller text position hold the longest earlier match.
    """
    found = np.zeros(len(position), np.int64)
    for ahead in (False, True):
        rank = position[order][::-1] if ahead else position[order]
        common = np.append(0, lcp[1:][::-1]) if ahead else lcp.copy()
        smaller = np.arange(len(order)) - 1
        smaller[common < least] = -1
        while True:
            bad = np.flatnonzero((smaller >= 0) & (rank[smaller] > rank))
            if not len(bad):
                break
            step = smaller[bad]
            common[bad] = np.minimum(common[bad], common[step])
            smaller[bad] = np.where(common[bad] < least, -1, smaller[step])
        value = np.where(smaller >= 0, common, 0)
        suffix = order[::-1] if ahead else order
        found[suffix] = np.maximum(found[suffix], value)
    return found


def repeated_windows(group, position, before, after, context: list[bytes], length: int, keep_first: bool):
    """``(row, c)`` of windows that start ``c`` bytes before their gram and are repeated within their group.

    Row r has the windows with ``after[r] <= c <= before[r]``; its context starts ``before[r]`` bytes before the gram.
    """
    n, left = len(context), int(before.max())
    sizes = np.fromiter(map(len, context), np.int64, n)
    text = np.zeros((n, left + length), np.uint8)
    row = np.repeat(np.arange(n), sizes)
    column = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(left - before, sizes)
    text[row, column] = np.frombuffer(b"".join(context), np.uint8)
    order = np.argsort(np.ascontiguousarray(text[:, left:]).view(f"S{length}").ravel(), kind="stable")
    order = order[np.argsort(group[order], kind="stable")]
    rows, offsets = [], []
    for c in range(left + 1):
        if c:
            order = order[before[order] >= c]
            order = order[np.argsort(group[order].astype(np.int64) * 256 + text[order, left - c], kind="stable")]
        live = order[after[order] <= c]
        if len(live) < 2:
            continue
        window = text[live, left - c : left - c + length]
        differ = window[1:] != window[:-1]
        lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
        lcp = np.append(0, np.where(group[live[1:]] == group[live[:-1]], lcp, 0))
        if lcp.max() < length:
            continue
        longest = factors(live, lcp, position, length)
        if not keep_first:  # with places counted from the end, previous factors are next ones
            longest = np.maximum(longest, factors(live, lcp, n - position, length))
        hit = np.flatnonzero(longest >= length)
        rows.append(hit)
        offsets.append(np.full(len(hit), c))
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(rows), np.concatenate(offsets)


def _merged(starts, ends) -> list[tuple[int, int]]:
    found: list[tuple[int, int]] = []
    for lo, hi in sorted(zip(starts, ends)):
        if found and lo <= found[-1][1]:
            found[-1] = (found[-1][0], max(found[-1][1], hi))
        else:
            found.append((lo, hi))
    return found


_RUN = "h bigint, ctx bigint, id bigint, t int, lo int, at int, hi int"
_SPAN = "id bigint, t int, lo int, hi int"


def _runs(rows: DataFrame, length: int) -> DataFrame:
    schema = arrow_schema(T.StructType.fromDDL(_RUN))

    def find(parts):
        for part in parts:
            for k in range(0, part.num_rows, 256):
                some, out = part.slice(k, 256), [[] for _ in schema]
                for id_, mark, text in zip(*(some.column(c).to_pylist() for c in ("id", "t", "text"))):
                    raw = (text or "").encode("utf-8", "surrogatepass")
                    h, first, place, last = runs(raw, length)
                    if not len(h):
                        continue
                    digest = [
                        xxhash.xxh3_64_intdigest(raw[f : l + length], p - f)
                        for f, p, l in zip(first.tolist(), place.tolist(), last.tolist())
                    ]
                    columns = (h, np.array(digest, np.uint64).astype(np.int64), first, place, last)
                    for column, value in zip((out[0], out[1], out[4], out[5], out[6]), columns):
                        column.append(value)
                    out[2] += [id_] * len(h)
                    out[3] += [mark] * len(h)
                joined = [np.concatenate(o) if o and isinstance(o[0], np.ndarray) else o for o in out]
                yield batch(schema, *joined)

    return rows.mapInArrow(tidied(find), _RUN)


def repeated_spans(docs: DataFrame, length: int = 200, keep_first: bool = True, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The documents as ``(id, t, text, <all columns>)`` and the spans to remove as ``(id, t, lo, hi)`` in bytes."""
    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.hash(text).alias("t"), F.col(text).alias("text"), F.struct(*docs.columns).alias("row"))
    texts = rows.select("id", "t", "text")
    often = _runs(texts, length).select("h").groupBy("h").agg(F.count("*").alias("n")).filter("n > 1")
    found = keep(_runs(texts, length).join(often, "h", "left_semi"), "runs")
    kinds = found.groupBy("h", "ctx").agg(F.count("*").alias("n"), F.min(F.struct("id", "t", "lo", "at", "hi")).alias("one"))
    kinds = keep(kinds, "run-kinds")
    copies = found.join(kinds.filter("n > 1").select("h", "ctx", "one"), ["h", "ctx"])
    if keep_first:
        copies = copies.filter(~(F.col("one.id").eqNullSafe(F.col("id")) & (F.col("one.t") == F.col("t")) & (F.col("one.lo") == F.col("lo"))))
    whole = copies.select("id", "t", "lo", (F.col("hi") + length).alias("hi"))
    groups = kinds.groupBy("h").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    open_ = kinds.join(groups, "h").select("h", "kinds", "n", "one.*")
    wanted = open_.groupBy("id", "t").agg(F.collect_list(F.struct("h", "kinds", "lo", "at", "hi")).alias("runs"))
    # one exchange of the texts serves here and when the spans are cut out
    placed = _beside(texts, wanted)
    raw = F.encode("text", "utf-8")
    cut = F.transform("runs", lambda r: F.struct(r.h.alias("h"), r.kinds.alias("kinds"), r.lo.alias("lo"), r["at"].alias("at"), r.hi.alias("hi"),
                                                 F.substring(F.col("raw"), r.lo + 1, r.hi - r.lo + length).alias("bytes")))
    context = placed.withColumn("raw", raw).select("id", "t", F.explode_outer(cut).alias("r")).select("id", "t", "r.*").filter("h IS NOT NULL")
    spans = whole.unionByName(_by_suffixes(context.filter(F.col("kinds") <= HOT), length, keep_first))
    hot = groups.filter(F.col("kinds") > HOT)
    if not hot.isEmpty():
        spans = spans.unionByName(_by_windows(context.filter(F.col("kinds") > HOT), length, keep_first))
    return rows, spans


def _beside(texts: DataFrame, other: DataFrame) -> DataFrame:
    other = other.withColumnsRenamed({"id": "oid", "t": "ot"})
    return texts.join(other, F.col("id").eqNullSafe(F.col("oid")) & (F.col("t") == F.col("ot")), "left").drop("oid", "ot")


def _by_suffixes(context: DataFrame, length: int, keep_first: bool) -> DataFrame:
    schema = arrow_schema(T.StructType.fromDDL(_SPAN))

    def compare(parts):
        for rows in whole_groups(parts, "h", 8_000):
            h, at, lo, hi, t = (rows.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("h", "at", "lo", "hi", "t"))
            ids = rows.column("id")
            id_ = ids.fill_null(np.iinfo(np.int64).min).to_numpy()
            position = np.empty(len(h), np.int64)
            position[np.lexsort((lo, t, id_))] = np.arange(len(h))
            group = np.cumsum(np.append(0, h[1:] != h[:-1]))
            row, c = repeated_windows(group, position, at - lo, at - hi, rows.column("bytes").to_pylist(), length, keep_first)
            order = np.lexsort((-c, row))
            row, start = row[order], (at[row] - c)[order]
            new = np.append(True, (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1))[: len(row)]
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], len(row)) - 1 if len(begin) else begin
            yield batch(schema, ids.take(pa.array(row[begin])).combine_chunks(), t[row[begin]], start[begin], start[end] + length)

    return context.repartition("h").sortWithinPartitions("h").mapInArrow(tidied(compare), _SPAN)


def _by_windows(context: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """Every window of a hot gram's runs by its digest; counts combine before the shuffle."""
    windows = context.select("id", "t", F.explode(F.sequence("lo", "hi")).alias("s"), "lo", "bytes")
    piece = F.substring("bytes", F.col("s") - F.col("lo") + 1, F.lit(length))
    windows = windows.select("id", "t", F.col("s").alias("lo"), F.xxhash64(piece).alias("w1"), F.hash(piece).alias("w2"))
    often = windows.groupBy("w1", "w2").agg(F.count("*").alias("n"), F.min(F.struct("id", "t", "lo")).alias("one")).filter("n > 1")
    found = windows.join(often, ["w1", "w2"])
    if keep_first:
        found = found.filter(~F.struct("id", "t", "lo").eqNullSafe(F.col("one")))
    return found.select("id", "t", "lo", (F.col("lo") + length).alias("hi"))


def cut_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """Each row with its list of spans (null: none)."""
    lists = spans.groupBy("id", "t").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    return _beside(rows, lists)


def digest(docs: DataFrame, length: int = 200, keep_first: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: ``id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``."""
    rows, spans = repeated_spans(docs, length, keep_first, key, text)
    out = "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    schema = arrow_schema(T.StructType.fromDDL(out))

    def finish(parts):
        for part in parts:
            found = [[], [], [], []]
            for text_, list_ in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                raw = (text_ or "").encode("utf-8", "surrogatepass")
                merged = _merged([s["lo"] for s in list_ or ()], [s["hi"] for s in list_ or ()])
                kept, at = [], 0
                for lo, hi in merged:
                    kept.append(raw[at:lo])
                    at = hi
                kept = b"".join([*kept, raw[at:]])
                for column, value in zip(found, (len(raw), len(raw) - len(kept), len(merged), hashlib.sha256(kept).hexdigest())):
                    column.append(value)
            yield batch(schema, part.column("id"), *found)

    return cut_spans(rows.select("id", "t", "text"), spans).select("id", "text", "spans").mapInArrow(tidied(finish), out)


def remove_repeats(docs: DataFrame, length: int = 200, key: str = "doc_id", text: str = "text", size: str | None = None) -> DataFrame:
    """The documents, without later copies of repeated passages; characters cut in half go as a whole.

    ``size`` names a column that holds the number of characters and follows the text.
    """
    rows, spans = repeated_spans(docs, length, True, key, text)
    at, kind = docs.columns.index(text), docs.schema
    schema = arrow_schema(kind)

    def finish(parts):
        for part in parts:
            columns = dict(zip(docs_columns, part.column("row").flatten()))
            cut = []
            for old, list_ in zip(columns[text].to_pylist(), part.column("spans").to_pylist()):
                if list_:
                    raw, kept, begin = old.encode("utf-8", "surrogatepass"), [], 0
                    for lo, hi in _merged([s["lo"] for s in list_], [s["hi"] for s in list_]):
                        kept.append(raw[begin:lo].decode("utf-8", "ignore"))
                        begin = hi
                    old = "".join([*kept, raw[begin:].decode("utf-8", "ignore")])
                cut.append(old)
            if size:
                columns[size] = [None if c is None else len(c) for c in cut]
            columns[text] = cut
            yield batch(schema, *(columns[c] for c in docs_columns))

    docs_columns = docs.columns
    return cut_spans(rows.select("id", "t", "text", "row"), spans).select("row", "spans").mapInArrow(tidied(finish), kind)
