"""Byte-level BPE, encoded by batched merge rounds in numpy and decoded by table.

Rounds: the symbols of many words stand in one flat array. A round forms the key of every pair of neighbours, finds
it by binary search among the sorted keys of all merges, and joins lowest-rank pairs in all words at once. Within a word
a round may join every pair that ranks below ``limit`` and below both pairs beside it, where ``limit`` is the least rank
at which a symbol that any of the word's present pairs makes is itself merged: no joined symbol can then come back
at a lower rank, so the outcome is that of joining one lowest pair after the other. Equal neighbouring pairs
("aaaa") join from the left, every other one.

Splitting: texts are first cut at added tokens, then by the pattern of byte-level vocabularies. A space before a character
that is no space always starts a part, so texts are cut there, and a worker remembers the ids of cuts it has met.

Defined cases: a null text counts as empty and has no ids; rows that repeat an id are encoded each; an empty table
gives no rows; only the key and the text column are read, so other columns may have any name. Ids outside the vocabulary
decode to nothing, and bytes that are no UTF-8 to U+FFFD. Texts of any length are whole: memory follows the longest text.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.shared import arrow_schema

# Fixed values. Characters that became letters or digits after Unicode 16, the version of the tokenizer library.
NEWER = (
    "՘֋-֌࢏౜೜₏₝-₟꟎-꟏꟒꟔꟝-꟢꟱꭬-꭭"
    "\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb"
    "\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3"
    "\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191"
    "\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6-\U0001d6a7\U0001df1f-\U0001df24\U0001df2b-\U0001df81"
    "\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead"
    "\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
LETTER, DIGIT = rf"[\p{{L}}--[{NEWER}]]", rf"[\p{{N}}--[{NEWER}]]"
# Fixed value: how byte-level vocabularies split text.
PARTS = regex.compile(rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d| ?{LETTER}+| ?{DIGIT}+| ?(?:(?!{LETTER}|{DIGIT})\S)+|\s+(?!\S)|\s+")
#: Spaces that do not simply start a part.
AWKWARD = regex.compile(r" \s| $")

#: A worker forgets its cuts beyond so many bytes; they are encoded again when they come up.
CACHE_BYTES = 96 << 20
#: Symbols of one flat array and characters of one output batch, at least one text.
FLAT_SYMBOLS, BATCH_CHARS = 1 << 19, 1 << 20
NEVER = np.int64(1) << 40
_ENCODERS: dict[str, Encoder] = {}


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves, others from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(others)) for b in range(256)]


def _one_part(cut: str) -> bool:
    """ASCII letters behind a space or none, the usual case."""
    return cut.isascii() and cut[1:].isalpha() and (cut[0] == " " or cut[0].isalpha())


def _portions(sizes: np.ndarray, most: int) -> Iterable[slice]:
    """Consecutive rows of about ``most`` units."""
    before = np.cumsum(sizes) - sizes
    edges = np.flatnonzero(np.diff(before // most, prepend=-1)).tolist()
    for a, b in zip(edges, [*edges[1:], len(sizes)]):
        yield slice(a, b)


class Encoder:
    """The vocabulary's tables, and the ids of cuts met so far."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        model, split, added = made["model"], made.get("pre_tokenizer") or {}, made["added_tokens"]
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        plain &= model["type"] == "BPE" and made.get("normalizer") is None
        plain &= (split.get("type"), split.get("use_regex"), split.get("add_prefix_space")) == ("ByteLevel", True, False)
        plain &= (made.get("decoder") or {}).get("type") == "ByteLevel"
        plain &= not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added)
        if not plain:
            raise ValueError("only byte-level BPE without normaliser and with literal added tokens is supported")
        vocab = model["vocab"]
        letters = byte_characters()
        self.byte_ids = np.array([vocab[c] for c in letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right, new = (np.array([vocab[x] for x in xs], np.int64) for xs in (*zip(*pairs), [a + b for a, b in pairs]))
        self.base = np.int64(max(vocab.values()) + 1)
        rank = np.arange(len(new))
        first_use = np.full(self.base, NEVER)
        np.minimum.at(first_use, left, rank)
        np.minimum.at(first_use, right, rank)
        if (first_use[new] <= rank).any() or len(np.unique(new)) != len(new):
            raise ValueError("a merge uses a symbol before it is made, or makes one twice")
        order = np.argsort(left * self.base + right)
        self.keys = (left * self.base + right)[order]
        self.rank, self.new, self.limit = rank[order], new[order], first_use[new][order]

        bytes_of = {c: b for b, c in enumerate(letters)}
        names = {**{i: t for t, i in vocab.items()}, **{t["id"]: t["content"] for t in added}}
        self.pieces = {i: bytes(bytes_of[c] for c in t) if all(c in bytes_of for c in t) else t.encode() for i, t in names.items()}
        self.added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in added}
        marks = sorted(map(regex.escape, self.added), key=len, reverse=True)
        self.marks = regex.compile(f"({'|'.join(marks)})") if marks else None
        self.known: dict[str, bytes] = {}
        self.size = 0

    @staticmethod
    def of(path: str) -> Encoder:
        if path not in _ENCODERS:
            _ENCODERS[path] = Encoder(path)
        return _ENCODERS[path]

    def merge(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit integers."""
        text = "".join(words)
        raw = text.encode()
        sizes = np.fromiter(map(len, words) if len(raw) == len(text) else (len(w.encode()) for w in words), np.int64, len(words))
        flat = self.byte_ids[np.frombuffer(raw, np.uint8)]
        which, done = np.arange(len(words)), [b""] * len(words)
        while len(which):
            starts = np.cumsum(sizes) - sizes
            key = np.full(len(flat), -1, np.int64)
            key[:-1] = flat[:-1] * self.base + flat[1:]
            key[starts + sizes - 1] = -1
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            rank = np.where(hit, self.rank[at], NEVER)
            limit = np.minimum.reduceat(np.where(hit, self.limit[at], NEVER), starts)
            open_ = np.logical_or.reduceat(hit, starts)
            self._join(flat, rank, np.repeat(limit, sizes), starts, at, keep := np.ones(len(flat), bool))
            sizes = np.add.reduceat(keep, starts, dtype=np.int64)
            flat = flat[keep]
            if not open_.all():
                closed, ends = ~open_, 4 * np.cumsum(sizes)
                raw = flat.astype("<u4").tobytes()
                for w, a, b in zip(which[closed].tolist(), (ends - 4 * sizes)[closed].tolist(), ends[closed].tolist()):
                    done[w] = raw[a:b]
                flat, sizes, which = flat[np.repeat(open_, sizes)], sizes[open_], which[open_]
        return done

    def _join(self, flat, rank, limit, starts, at, keep) -> None:
        """Join the pairs that can go now: ``flat`` gets the new symbols, ``keep`` loses the right-hand ones."""
        low = (rank < limit) & (rank < NEVER)
        before, after = np.empty_like(rank), np.empty_like(rank)
        before[0], before[1:] = NEVER, rank[:-1]
        after[-1], after[:-1] = NEVER, rank[1:]
        before[starts] = NEVER
        # runs of equal pairs join from their first, unless the pair before the run goes earlier
        heads = low & (before != rank)
        run = np.maximum.accumulate(np.where(heads, np.arange(len(rank)), 0))
        chosen = np.flatnonzero(low & (after >= rank) & (before[run] > rank) & ((np.arange(len(rank)) - run) % 2 == 0))
        flat[chosen] = self.new[at[chosen]]
        keep[chosen + 1] = False

    def learn(self, cuts: Iterable[str]) -> None:
        """Encode cuts that are not known yet, as many words as fit in one flat array at a time."""
        parts = {c: [c] if _one_part(c) else PARTS.findall(c) for c in cuts}
        words = list({w for found in parts.values() for w in found})
        ids: dict[str, bytes] = {}
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for rows in _portions(sizes, FLAT_SYMBOLS):
            ids.update(zip(words[rows], self.merge(words[rows])))
        for c, found in parts.items():
            self.known[c] = made = ids[found[0]] if len(found) == 1 else b"".join([ids[w] for w in found])
            self.size += len(made) + len(c) + 200

    def cuts(self, text: str) -> list[str]:
        """Parts of a text that can be encoded by themselves; added tokens stand alone."""
        if self.marks is None or not self.marks.search(text):
            return self._plain(text)
        pieces = self.marks.split(text)
        return [c for i, p in enumerate(pieces) for c in ([p] if i % 2 else self._plain(p))]

    @staticmethod
    def _plain(text: str) -> list[str]:
        if AWKWARD.search(text):
            return PARTS.findall(text)
        head, *rest = text.split(" ")
        cuts = [" " + c for c in rest]
        return [head, *cuts] if head else cuts

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if self.size > CACHE_BYTES:
            self.known, self.size = {}, 0
        if not self.known:
            self.known.update(self.added)
        cut = [self.cuts(t) if t else [] for t in texts]
        self.learn({c for cs in cut for c in cs}.difference(self.known))
        get = self.known.__getitem__
        return [np.frombuffer(b"".join(map(get, cs)), "<u4") for cs in cut]

    def decode(self, ids: np.ndarray) -> str:
        get = self.pieces.get
        return b"".join([get(i, b"") for i in ids.tolist()]).decode("utf-8", "replace")


def encode(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, ids)`` of every text, without special tokens of the tokenizer's own."""
    schema = T.StructType([T.StructField("id", docs.schema[key].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    arrow = arrow_schema(schema)

    def run(batches):
        encoder = Encoder.of(tokenizer)
        for part in batches:
            texts = part.column("t")
            sizes = np.array([len(t) if t else 1 for t in texts.to_pylist()], np.int64)
            for rows in _portions(sizes, BATCH_CHARS):
                found = encoder.encode(texts[rows].to_pylist())
                offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("id")[rows], ids.cast(arrow.field("ids").type)], schema=arrow)

    return docs.select(F.col(key).alias("id"), F.col(text).alias("t")).mapInArrow(run, schema)


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``(id, ids, decoded)`` of every row of ``(id, ids)``; special tokens are spelled out. Null ids decode to an empty text."""
    schema = T.StructType([encoded.schema["id"], encoded.schema["ids"], T.StructField("decoded", T.StringType())])
    arrow = arrow_schema(schema)

    def run(batches):
        encoder = Encoder.of(tokenizer)
        for part in batches:
            ids = part.column("ids")
            sizes = np.diff(ids.offsets.to_numpy())
            for rows in _portions(sizes + 1, BATCH_CHARS):
                some = ids[rows]
                flat, at = some.values.to_numpy(zero_copy_only=False), some.offsets.to_numpy()
                texts = [encoder.decode(flat[a:b]) for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays([part.column("id")[rows], some, pa.array(texts, pa.string())], schema=arrow)

    return encoded.select("id", "ids").mapInArrow(run, schema)


def digests(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's number of ids, digest of its ids and digest of what they decode to."""
    found = decode(encode(docs, tokenizer, key, text), tokenizer)
    return found.select(
        "id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
