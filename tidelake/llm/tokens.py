"""Token files: byte-level BPE ids, ranked by frequency, in a byte-aligned variable-length coding.

Format: a folder ``shards`` of Parquet rows in ascending document order, one row for each document with
its ``start`` (ids of all documents before it), the number of ids, control bytes and data bytes; and a folder
``ranks`` with the id of every rank. Four ids share a control byte of four two-bit length codes, and the data
bytes hold each rank in one to four little-endian bytes, so frequent ids take one byte.

Encoding: a byte-level BPE splits text before it merges, and a single space before a character that is no space always
starts a new part. So the text is cut at spaces, every distinct cut is encoded once by the tokenizer and its ids are
looked up afterwards. Texts with white space after a space are encoded whole, as are all texts if the
tokenizer is of another kind.

Defined cases: a null text is empty and has the end id alone; a null id sorts first; rows that repeat an id
follow each other, ordered by the digest of their ids; an empty table gives empty files.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.shared import arrow_schema, batch, keep
from tidelake.session import scratch_folder

END_ID = 2
#: Beyond so many cuts a worker forgets those that did not come up since it last had so many.
CACHE_ENTRIES = 800_000
_ENCODERS: dict[str, "Encoder"] = {}


#: A space before another one or at the end.
_UNCUTTABLE = re.compile(r" (?:\s|\Z)")


class Encoder:
    """Ids of whole texts as little-endian 32-bit integers."""

    def __init__(self, path: str):
        # each task has one core, and distinct cuts gain nothing from the library's own cache
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        if hasattr(self.tokenizer.model, "resize_cache"):
            self.tokenizer.model.resize_cache(0)
        made = json.loads(self.tokenizer.to_str())
        split = made.get("pre_tokenizer") or {}
        self.cuttable = (split.get("type"), split.get("use_regex"), split.get("add_prefix_space")) == ("ByteLevel", True, False)
        self.cuttable &= made.get("normalizer") is None and made["model"]["type"] == "BPE"
        self.cuttable &= not any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] for t in made["added_tokens"])
        # bytes that a token stands for: the vocabulary writes each byte as one character
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False) if self.cuttable else {}
        self.sizes = np.zeros(self.tokenizer.get_vocab_size() + 1, np.int64)
        if set(ByteLevel.alphabet()) <= vocabulary.keys() and max(made_ids := [*vocabulary.values(), *(t["id"] for t in made["added_tokens"])]) < len(self.sizes):
            self.sizes[list(vocabulary.values())] = list(map(len, vocabulary))
            self.sizes[made_ids[len(vocabulary) :]] = [len(t["content"].encode()) for t in made["added_tokens"]]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def of(path: str) -> Encoder:
        if path not in _ENCODERS:
            _ENCODERS[path] = Encoder(path)
        return _ENCODERS[path]

    def _encode(self, text: str) -> list[int]:
        # the fast call leaves out the offsets, which are not needed
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _learn(self, cuts: list[str]) -> None:
        """Encode cuts with the space before them, many in one call: the bytes of the tokens tell where each ends."""
        for i in range(0, len(cuts), 256):
            some = cuts[i : i + 256]
            joined = " " + " ".join(some)
            ids = np.array(self._encode(joined), "<u4")
            until = np.cumsum(self.sizes[ids])
            raw = [len(c) for c in some] if joined.isascii() else [len(c.encode("utf-8", "surrogatepass")) for c in some]
            ends = np.cumsum(np.array(raw) + 1)
            last = np.searchsorted(until, ends)
            if len(until) and until[-1] == ends[-1] and (until[last] == ends).all():
                data, at = ids.tobytes(), 0
                for c, end in zip(some, (4 * (last + 1)).tolist()):
                    self.known[c] = data[at:end]
                    at = end
            else:
                self.known.update((c, np.array(self._encode(" " + c), "<u4").tobytes()) for c in some)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.known) > CACHE_ENTRIES:
            self.known, self.older = {}, self.known
        done = [t.split(" ") if t and self.cuttable and not _UNCUTTABLE.search(t) else [t or ""] for t in texts]
        # a small table of the cuts at hand answers faster than that of all
        ids = dict.fromkeys(chain.from_iterable(islice(cuts, 1, None) for cuts in done))
        known, older = self.known, self.older
        self._learn([c for c in ids if c not in known and c not in older])
        for c in ids:
            x = known.get(c)
            ids[c] = known.setdefault(c, older[c]) if x is None else x
        found, get = [], ids.__getitem__
        for cuts in done:
            first = np.array(self._encode(cuts[0]), "<u4").tobytes() if cuts[0] else b""
            found.append(first + b"".join(map(get, islice(cuts, 1, None))))
        return found


_SHIFTS = np.array([0, 2, 4, 6], np.uint8)
#: Byte lengths of the four values behind each control byte.
LENGTHS = (((np.arange(256)[:, None] >> _SHIFTS) & 3) + 1).astype(np.uint8)


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column of consecutive parts of the data, given the byte at which each ends."""
    offsets = np.append(0, ends).astype("<i4")
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _codes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The control bytes until the end of each row, and the place of each value's code: a row begins with a control byte."""
    quads = -(-counts // 4)
    until = np.cumsum(quads)
    return until, np.arange(counts.sum()) + np.repeat(4 * (until - quads) - np.cumsum(counts) + counts, counts)


def pack_rows(values: np.ndarray, counts: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Control and data bytes of rows of unsigned 32-bit values that follow each other."""
    values = np.ascontiguousarray(values, "<u4")
    code = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    until, place = _codes(counts)
    padded = np.zeros(4 * int(until[-1]) if len(until) else 0, np.uint8)
    padded[place] = code
    control = padded[::4] | padded[1::4] << 2 | padded[2::4] << 4 | padded[3::4] << 6
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) <= code[:, None]]
    ends = np.append(0, np.cumsum(code + np.int64(1)))[np.cumsum(counts)]
    return _binary(control, until), _binary(data, ends)


def unpack_rows(control: list[bytes], data: list[bytes], counts: np.ndarray) -> np.ndarray:
    """The values: the control bytes' table entries give each value's place and length."""
    lengths = LENGTHS[np.frombuffer(b"".join(control), np.uint8)].ravel()[_codes(counts)[1]]
    places = np.cumsum(lengths, dtype=np.int64) - lengths
    raw = np.frombuffer(b"".join([*data, b"\0\0\0"]), np.uint8)
    values = raw[places].astype(np.uint32)
    for i in (1, 2, 3):
        longer = np.flatnonzero(lengths > i)
        if len(longer):
            values[longer] |= raw[places[longer] + i].astype(np.uint32) << np.uint32(8 * i)
    return values


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    control, data = pack_rows(values, np.array([len(values)]))
    return control[0].as_py(), data[0].as_py()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    return unpack_rows([control], [data], np.array([count]))


def write(docs: DataFrame, tokenizer: str, path: str | None = None, key: str = "doc_id", text: str = "text") -> str:
    """Encode all documents with an end id each and write the files; returns their folder."""
    spark = docs.sparkSession
    path = path or scratch_folder(spark, "token-files")
    raw_schema = arrow_schema(T.StructType.fromDDL("id bigint, n bigint, ids binary"))
    end = np.array([END_ID], "<u4").tobytes()

    def tokenise(parts):
        encoder = Encoder.of(tokenizer)
        narrow = encoder.tokenizer.get_vocab_size() <= 1 << 16 and END_ID < 1 << 16
        for part in parts:
            for i in range(0, part.num_rows, 512):
                some = part.slice(i, 512)
                ids = [x + end for x in encoder.encode(some.column("t").to_pylist())]
                n = np.array([len(x) // 4 for x in ids])
                values = np.frombuffer(b"".join(ids), "<u4").astype("<u2" if narrow else "<u4")
                yield batch(raw_schema, some.column("id"), n, _binary(values.view(np.uint8), np.cumsum(n) * values.itemsize))

    named = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("t"))
    raw = keep(named.mapInArrow(tokenise, "id bigint, n bigint, ids binary"), "token-ids")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = np.unique(raw.approxQuantile("id", [i / parts for i in range(1, parts)], 0.1 / parts)) if parts > 1 else np.empty(0)
    count_schema = arrow_schema(T.StructType.fromDDL("kind int, value bigint, n bigint"))

    def values(ids: bytes, n: int) -> np.ndarray:
        return np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4")

    def place(part) -> np.ndarray:
        ids = part.column("id").to_numpy(zero_copy_only=False).astype(np.float64)
        return np.where(np.isnan(ids), 0, np.searchsorted(bounds, ids)).astype(np.int32)

    def count(batches):
        seen, sizes = np.zeros(0, np.int64), np.zeros(len(bounds) + 1, np.int64)
        for part in batches:
            n = part.column("n").to_numpy()
            np.add.at(sizes, place(part), n)
            found = np.bincount(values(b"".join(part.column("ids").to_pylist()), int(n.sum())), minlength=len(seen))
            found[: len(seen)] += seen
            seen = found
        for kind, all_ in ((0, seen), (1, sizes)):
            some = np.flatnonzero(all_)
            yield batch(count_schema, np.full(len(some), kind), some, all_[some])

    # a row for each id of the vocabulary and each part of the output
    counts = raw.mapInArrow(count, "kind int, value bigint, n bigint").groupBy("kind", "value").agg(F.sum("n").alias("n")).collect()
    order = np.array([v for _, v in sorted((-r.n, r.value) for r in counts if r.kind == 0)], np.uint32)
    rank = np.zeros(int(order.max()) + 1 if len(order) else 1, np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    sizes = np.zeros(len(bounds) + 1, np.int64)
    for r in counts:
        if r.kind == 1:
            sizes[r.value] = r.n
    starts = np.cumsum(sizes) - sizes
    spark.createDataFrame([(i, int(v)) for i, v in enumerate(order)], "rank bigint, id bigint").coalesce(1).write.parquet(f"{path}/ranks")
    packed = "part int, id bigint, digest bigint, n_tokens bigint, control binary, data binary"
    packed_schema = arrow_schema(T.StructType.fromDDL(packed))

    def encode(batches):
        for part in batches:
            n = part.column("n").to_numpy()
            found = values(b"".join(part.column("ids").to_pylist()), int(n.sum()))
            raw_bytes, ends = memoryview(found.astype("<u4").tobytes()), 4 * np.cumsum(n)
            digest = [zlib.crc32(raw_bytes[lo:hi]) for lo, hi in zip((ends - 4 * n).tolist(), ends.tolist())]
            yield batch(packed_schema, place(part), part.column("id"), digest, part.column("n"), *pack_rows(rank[found], n))

    filed = "id bigint, start bigint, n_tokens bigint, control binary, data binary"
    filed_schema = arrow_schema(T.StructType.fromDDL(filed))

    def number(batches):
        """Rows come by part and, within it, by id: the starts run on."""
        at: dict[int, int] = {}
        for part in batches:
            first = np.empty(part.num_rows, np.int64)
            for i, (p, n) in enumerate(zip(part.column("part").to_pylist(), part.column("n_tokens").to_pylist())):
                first[i] = at.get(p, int(starts[p]))
                at[p] = int(first[i]) + n
            yield batch(filed_schema, part.column("id"), first, *(part.column(c) for c in ("n_tokens", "control", "data")))

    ranged = raw.mapInArrow(encode, packed).repartitionById(len(bounds) + 1, F.col("part"))
    ranged.sortWithinPartitions("part", "id", "digest").mapInArrow(number, filed).write.parquet(f"{path}/shards")
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """``(id, start, n_tokens, ids)`` from the files, ``ids`` as little-endian 32-bit integers."""
    order = np.array([r.id for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()], "<u4")
    schema = arrow_schema(T.StructType.fromDDL("id bigint, start bigint, n_tokens bigint, ids binary"))

    def decode(batches):
        for part in batches:
            for i in range(0, part.num_rows, 1024):
                some = part.slice(i, 1024)
                n = some.column("n_tokens").to_numpy()
                ids = order[unpack_rows(some.column("control").to_pylist(), some.column("data").to_pylist(), n)]
                yield batch(schema, *(some.column(c) for c in ("id", "start", "n_tokens")), _binary(ids.view(np.uint8), 4 * np.cumsum(n)))

    return spark.read.parquet(f"{path}/shards").mapInArrow(decode, "id bigint, start bigint, n_tokens bigint, ids binary")
