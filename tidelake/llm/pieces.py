"""SentencePiece segmentations drawn without replacement: Gumbel top-k by perturbed A* search over the lattice.

The text is escaped as the model asks (a leading mark, marks for spaces) and cut before every run of marks, since a
piece may hold a run and what follows; a model with pieces that go on into the next run gets its texts uncut. The lattice of a cut has an edge for each piece of the model; characters without a piece fall back to bytes. A
merge model has ranks instead of probabilities, so a piece weighs 1 / (rank + 3), by Zipf's law. Backward sums
give the exact probability of every edge, so the lattice of a document is a tree whose regions have known mass.

The search draws the largest perturbed log-probability of the whole tree and the segmentation that has it. All others
fall into regions: same edges up to a step, another edge there. Each region gets its own maximum, a
Gumbel value truncated at the last one; the region with the largest is drawn next, and is split again. The k segmentations
are distinct, come in order of their perturbed values, and have the inclusion score 1 - exp(-exp(log p - t)), where t
is the largest value that was not drawn. Random numbers are hashes of seed, row key, sample, cut and step, so a row gives
the same samples on every machine and in every batch.

Defined cases: null and empty texts have the one empty segmentation with probability 1; a text with fewer
segmentations than asked for gives them all, with inclusion 1; rows that repeat a key and text give equal samples; a null
key seeds like the word "null"; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import chain, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.shared import arrow_schema, batch, mix, tidied

#: Texts of about so many characters are sampled together, and more of them where only summaries are held; a longer text alone.
BATCH_CHARS, SUMMARY_CHARS = 100_000, 300_000
#: A task goes on with the lattice of the cuts before, as most cuts come again, and begins anew beyond so many edges (about 30 MB).
HELD_EDGES = 800_000
MARK = "▁".encode()
_STEP = np.uint64(0x9E3779B97F4A7C15)
_VOCABULARIES: dict[str, "Vocabulary"] = {}


class _Numbers(dict):
    """Cuts and their numbers, in the order first asked for."""

    def __missing__(self, cut: bytes) -> int:
        self[cut] = number = len(self)
        return number


class Vocabulary:
    """Pieces of a model as a byte trie with log-weights."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        if model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models with the identity normalizer decode to the text they were given")
        self.prefix = model.normalizer_spec.add_dummy_prefix
        self.raw = [p.piece.encode() for p in model.pieces]
        normal = [i for i, p in enumerate(model.pieces) if p.type in (kinds.NORMAL, kinds.USER_DEFINED)]
        self.crossed = any("▁" in model.pieces[i].piece.lstrip("▁") for i in normal)
        normal.sort(key=lambda i: -model.pieces[i].score)
        self.weight = np.zeros(len(self.raw))
        self.weight[normal] = -np.log(np.arange(len(normal)) + 3.0)
        self.byte = np.full(256, -1, np.int64)
        for i, p in enumerate(model.pieces):
            if p.type == kinds.BYTE:
                value = int(p.piece[3:5], 16)
                self.byte[value], self.raw[i] = i, bytes([value])
                self.weight[i] = -np.log(len(normal) + 3.0) - 3.0
        self.joined = np.frombuffer(b"".join(self.raw), np.uint8)
        self.sizes = np.fromiter(map(len, self.raw), np.int64, len(self.raw))
        self.places = np.cumsum(self.sizes) - self.sizes
        nodes: dict[tuple[int, int], int] = {}
        piece = [-1]
        for i in normal:
            at = 0
            for b in self.raw[i]:
                key = at, b
                if key not in nodes:
                    nodes[key] = len(piece)
                    piece.append(-1)
                at = nodes[key]
            piece[at] = i
        self.piece = np.array(piece, np.int32)
        keys = np.array(list(nodes), np.int64).reshape(-1, 2)
        node, byte, to = keys[:, 0], keys[:, 1], np.fromiter(nodes.values(), np.int32, len(nodes))
        # most nodes have one way on at most; only the others have a row of all bytes, row 0 has no path
        forks = np.bincount(node, minlength=len(piece)) > 1
        self.row = np.where(forks, np.cumsum(forks), 0).astype(np.int32)
        self.table = np.zeros((int(forks.sum()) + 1, 256), np.int32)
        self.table[self.row[node[forks[node]]], byte[forks[node]]] = to[forks[node]]
        alone = ~forks[node]
        self.only, self.heir = np.full(len(piece), -1, np.int16), np.zeros(len(piece), np.int32)
        self.only[node[alone]], self.heir[node[alone]] = byte[alone], to[alone]
        self.numbers, self.lattice = _Numbers(), Lattice()

    @staticmethod
    def of(path: str) -> Vocabulary:
        if path not in _VOCABULARIES:
            _VOCABULARIES[path] = Vocabulary(path)
        return _VOCABULARIES[path]

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The nodes that a byte leads to; 0 if there is no such path."""
        return np.where(self.only[node] == byte, self.heir[node], self.table[self.row[node], byte])

    def cuts(self, text: str | None) -> list[bytes]:
        if not text:
            return []
        raw = text.encode("utf-8", "surrogatepass")
        if self.crossed:
            return [(MARK if self.prefix else b"") + raw.replace(b" ", MARK)]
        found = ((MARK if self.prefix else b"") + raw.replace(b" ", b" " + MARK)).split(b" ")
        if b"  " in raw or raw[:1] == b" " or raw[-1:] == b" " or MARK in raw:
            # a cut that ends with a mark goes on
            whole = [found[0]]
            for f in found[1:]:
                if whole[-1].endswith(MARK):
                    whole[-1] += f
                else:
                    whole.append(f)
            found = whole
        return found if found[0] else found[1:]

    def decode(self, ids) -> str:
        ids = np.asarray(ids, np.int64)
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        places = np.repeat(self.places[ids] + sizes - ends, sizes) + np.arange(sizes.sum())
        text = self.joined[places].tobytes().replace(MARK, b" ")
        if self.prefix:
            text = text[1:]
        return text.decode("utf-8", "surrogatepass")


class Lattice:
    """Edges of distinct cuts, ordered by their start, with exact probabilities. The arrays have room for more."""

    def __init__(self):
        self.cuts = self.nodes = self.edges = 0
        self.begin, self.start, self.end, self.piece, self.first, self.last = (np.empty(0, np.int32) for _ in range(6))
        self.log_p, self.cdf, self.final = np.empty(0), np.empty(0), np.empty(0, bool)

    def _put(self, at: int, **columns: np.ndarray) -> None:
        for name, values in columns.items():
            array, upto = getattr(self, name), at + len(values)
            if upto > len(array):
                wider = np.empty(max(upto, 2 * len(array)), array.dtype)
                wider[:at] = array[:at]
                setattr(self, name, array := wider)
            array[at:upto] = values

    def add(self, vocabulary: Vocabulary, cuts: list[bytes]) -> None:
        sizes = np.fromiter(map(len, cuts), np.int64, len(cuts))
        raw = np.frombuffer(b"".join(cuts), np.uint8)
        # every cut has a node before each byte and one after its last
        begin = np.cumsum(sizes + 1) - sizes - 1
        cut = np.repeat(np.arange(len(cuts)), sizes)
        node = np.arange(len(raw)) + cut
        text = np.zeros(len(raw) + len(cuts) + 1, np.uint8)
        text[node] = raw
        final = begin + sizes
        stop = np.repeat(final, sizes)
        start, end, piece = [], [], []
        at, state, last = node.astype(np.int32), np.zeros(len(node), np.int32), stop.astype(np.int32)
        at_byte = at
        while len(at):
            state = vocabulary.step(state, text[at_byte])
            live = np.flatnonzero(state)
            at, at_byte, state, last = at[live], at_byte[live] + np.int32(1), state[live], last[live]
            found = vocabulary.piece[state]
            hit = np.flatnonzero(found >= 0)
            start.append(at[hit])
            end.append(at_byte[hit])
            piece.append(found[hit])
            more = np.flatnonzero(at_byte < last)
            if len(more) < len(at):
                at, at_byte, state, last = at[more], at_byte[more], state[more], last[more]
        self._bytes(vocabulary, text, node, start, end, piece)
        # a node has one edge of each step at most
        count = np.zeros(len(text), np.int32)
        for s in start:
            count[s] += 1
        first = (np.cumsum(count) - count).astype(np.int32)
        place = first.copy()
        edges = np.empty((3, int(count.sum())), np.int32)
        for step in zip(start, end, piece):
            at = place[step[0]]
            for column, values in zip(edges, step):
                column[at] = values
            place[step[0]] += 1
        left = np.zeros(len(text), np.int32)
        left[node] = stop - node
        log_p, cdf = self._sums(vocabulary.weight[edges[2]], edges[0], edges[1], left, final, first, count)
        over = np.zeros(len(text), bool)
        over[final] = True
        self._put(self.cuts, begin=begin + self.nodes)
        self._put(self.edges, start=edges[0] + self.nodes, end=edges[1] + self.nodes, piece=edges[2], log_p=log_p, cdf=cdf)
        self._put(self.nodes, first=first + self.edges, last=first + self.edges + count - 1, final=over)
        self.cuts, self.nodes, self.edges = self.cuts + len(cuts), self.nodes + len(text), self.edges + len(log_p)

    @staticmethod
    def _bytes(vocabulary, text, node, start, end, piece) -> None:
        """Byte edges for the characters that have no piece of their own."""
        head = node[(text[node] & 0xC0) != 0x80]
        size = np.select([text[head] < 0x80, text[head] < 0xE0, text[head] < 0xF0], [1, 2, 3], 4)
        own = np.zeros(len(text) + 4, np.int8)
        for s, e in zip(start[:4], end[:4]):  # pieces of up to four bytes are found in the first four steps
            own[s] |= (1 << (e - s)).astype(np.int8)
        bare = (own[head] >> size) & 1 == 0
        covered = np.zeros(len(text) + 4, bool)
        covered[node] = True
        for i in range(4):
            some = head[bare & (size > i)] + i
            some = some[covered[some]]
            start.append(some.astype(np.int32))
            end.append((some + 1).astype(np.int32))
            piece.append(vocabulary.byte[text[some]].astype(np.int32))

    @staticmethod
    def _sums(weight, start, end, left, final, first, count) -> tuple[np.ndarray, np.ndarray]:
        """Each edge's log-probability, and the probability of it and those before it at its node, without end for the last."""
        beta = np.full(len(count), -np.inf)
        beta[final] = 0.0
        distance = left[start]
        if distance.max(initial=0) < 1 << 16:
            distance = distance.astype(np.uint16)  # sorted by digits
        order = np.argsort(distance, kind="stable")
        cuts = np.append(np.flatnonzero(np.append(True, np.diff(distance[order]) > 0)), len(order))
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            e = order[lo:hi]
            s = start[e]
            new = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
            beta[s[new]] = np.logaddexp.reduceat(weight[e] + beta[end[e]], new)
        log_p = weight + beta[end] - beta[start]
        # the sums begin anew at each node, so they do not depend on the cuts before
        cdf, some, at = np.exp(log_p), np.flatnonzero(count > 1), 1
        while len(some):
            edge = first[some] + at
            cdf[edge] += cdf[edge - 1]
            at += 1
            some = some[count[some] > at]
        some = np.flatnonzero(count)
        cdf[first[some] + count[some] - 1] = np.inf
        return log_p, cdf

    def choose(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge of each node by its probability."""
        edge = self.first[node]
        open_ = np.flatnonzero(u >= self.cdf[edge])
        while len(open_):
            edge[open_] += 1
            open_ = open_[u[open_] >= self.cdf[edge[open_]]]
        return edge

    def walk(self, node: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Edges from each node to the end of its cut, one walk after the other, and their numbers."""
        rows, edges, live, step = [], [], np.flatnonzero(~self.final[node]), 0
        at = node[live]
        while len(live):
            step += 1
            edge = self.choose(at, _uniform(seed[live] + np.uint64(step * int(_STEP) % 2**64)))
            rows.append(live)
            edges.append(edge)
            at = self.end[edge]
            more = np.flatnonzero(~self.final[at])
            if len(more) < len(at):
                live, at = live[more], at[more]
        count = np.zeros(len(node), np.int64)
        for r in rows:
            count[r] += 1
        place = np.cumsum(count) - count
        out = np.empty(count.sum(), np.int64)
        for i, (r, e) in enumerate(zip(rows, edges)):
            out[place[r] + i] = e
        return out, count


def _uniform(x: np.ndarray) -> np.ndarray:
    """Numbers above 0 and below 1 from 64-bit words."""
    return ((mix(x) >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


def _gumbels(mass: np.ndarray, bound, u: np.ndarray) -> np.ndarray:
    """Gumbel values with log-mass ``mass``, given that they lie below ``bound``."""
    with np.errstate(over="ignore", divide="ignore"):
        return -np.log(np.exp(-bound) - np.log(u) * np.exp(-np.maximum(mass, -700.0)))


def _rest(p: np.ndarray) -> np.ndarray:
    """log(1 - p), minus infinity where nothing is left."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(p < 1 - 1e-12, np.log1p(-np.minimum(p, 1.0)), -np.inf)


class _Path:
    """One drawn segmentation of each document that has another: edges in document order, and its regions."""

    def __init__(self, docs, edges, doc_first, cut_of, value, fresh_from, lattice, seed):
        self.docs, self.edges, self.first, self.cut, self.value = docs, edges, doc_first, cut_of, value
        count = np.diff(doc_first)
        log_p = lattice.log_p[edges]
        p = np.exp(log_p)
        total = np.append(0.0, np.cumsum(log_p))
        self.log_p = total[doc_first[1:]] - total[doc_first[:-1]]
        before = total[:-1] - np.repeat(total[doc_first[:-1]], count)
        self.mass = before + _rest(p)
        step = np.arange(len(edges)) - np.repeat(doc_first[:-1], count)
        u = _uniform(np.repeat(seed, count) + step.astype(np.uint64) * _STEP)
        self.region = np.where(np.isneginf(self.mass), -np.inf, _gumbels(self.mass, np.repeat(value, count), u))
        # regions up to the step at which this path left its parent belong to the parent
        self.region[step < np.repeat(fresh_from, count)] = -np.inf
        self.taken: dict[int, set[int]] = {}


def sample(vocabulary: Vocabulary, texts: list[str | None], keys: list[str], k: int, seed: int) -> list[list[tuple]]:
    """For each text, up to k of ``(ids, log_prob, perturbed, inclusion)`` in the order drawn."""
    if vocabulary.lattice.edges > HELD_EDGES:
        vocabulary.numbers, vocabulary.lattice = _Numbers(), Lattice()
    lattice, number = vocabulary.lattice, vocabulary.numbers.__getitem__
    cuts = [list(map(number, vocabulary.cuts(t))) for t in texts]
    counts = np.fromiter(map(len, cuts), np.int64, len(cuts))
    base = np.array([xxhash.xxh3_64_intdigest(key, seed) for key in keys], np.uint64)
    root = -np.log(-np.log(_uniform(base)))
    if not counts.any():
        return [[(np.empty(0, np.int32), 0.0, float(g), 1.0)] for g in root]
    if fresh := list(islice(vocabulary.numbers, lattice.cuts, None)):
        lattice.add(vocabulary, fresh)
    every = np.fromiter(chain.from_iterable(cuts), np.int64, counts.sum())
    cut_first = np.append(0, np.cumsum(counts))
    local = np.arange(len(every)) - np.repeat(cut_first[:-1], counts)

    def seeds(docs: np.ndarray, salt: int) -> np.ndarray:
        return mix(base[docs] + np.uint64(salt * 0xD1342543DE82EF95 % 2**64))

    docs = np.arange(len(texts))
    edges, steps = lattice.walk(lattice.begin[every], mix(np.repeat(seeds(docs, 1), counts) + local.astype(np.uint64)))
    doc_first = np.append(0, np.cumsum(steps))[cut_first]
    paths = [_Path(docs, edges, doc_first, np.repeat(local, steps), root, np.zeros(len(docs), np.int64), lattice, seeds(docs, 2))]
    drawn: list[list[tuple[int, int]]] = [[(0, d)] for d in docs]
    bound = np.full(len(docs), -np.inf)
    for turn in range(1, k + 1):
        top = np.full((len(paths), len(docs)), -np.inf)
        for i, path in enumerate(paths):
            some = np.diff(path.first) > 0
            if some.any():
                top[i, path.docs[some]] = np.maximum.reduceat(path.region, path.first[:-1][some])
        best, value = top.argmax(axis=0), top.max(axis=0)
        if turn == k:
            bound = value
            break
        chosen = np.flatnonzero(~np.isneginf(value))
        if not len(chosen):
            break
        paths.append(_branch(lattice, paths, chosen, best[chosen], value[chosen], every, cut_first, seeds, turn))
        for row, d in enumerate(chosen):
            drawn[d].append((turn, row))
    found = []
    for d, list_ in enumerate(drawn):
        out = []
        for i, row in list_:
            path = paths[i]
            ids = lattice.piece[path.edges[path.first[row] : path.first[row + 1]]]
            log_p = float(min(0.0, path.log_p[row]))
            with np.errstate(over="ignore"):
                inclusion = 1.0 if np.isneginf(bound[d]) else float(-np.expm1(-np.exp(log_p - bound[d])))
            out.append((ids, log_p, float(path.value[row]), inclusion))
        found.append(out)
    return found


def _branch(lattice, paths, chosen, best, value, every, cut_first, seeds, turn) -> _Path:
    """Draw the best region of each chosen document: its segmentation, and what is left of the region."""
    u = _uniform(seeds(chosen, 4 * turn + 1))
    left_u = _uniform(seeds(chosen, 4 * turn + 2))
    heads, tails, at_cut, new_edges, kept = [], [], [], np.empty(len(chosen), np.int64), np.empty(len(chosen), np.int64)
    for i, (d, which) in enumerate(zip(chosen, best)):
        path = paths[which]
        row = int(np.searchsorted(path.docs, d))
        lo, hi = path.first[row], path.first[row + 1]
        t = lo + int(path.region[lo:hi].argmax())
        taken = path.taken.setdefault(t, {int(path.edges[t])})
        node = lattice.start[path.edges[t]]
        options = [e for e in range(lattice.first[node], lattice.last[node] + 1) if e not in taken]
        weights = np.cumsum(np.exp(lattice.log_p[options]))
        edge = options[min(int(np.searchsorted(weights, u[i] * weights[-1], side="right")), len(options) - 1)]
        taken.add(edge)
        left = weights[-1] - np.exp(lattice.log_p[edge])
        if len(options) > 1 and left > 0:
            before = path.mass[t] - np.log(max(1e-300, 1 - np.exp(lattice.log_p[path.edges[t]])))
            path.region[t] = _gumbels(np.array(before + np.log(left)), value[i], left_u[i])
        else:
            path.region[t] = -np.inf
        new_edges[i], kept[i] = edge, t - lo
        heads.append(path.edges[lo:t])
        tails.append((path.cut[lo : t + 1]))
        at_cut.append(path.cut[t])
    # the rest of the cut, then all later cuts of the document, walk afresh
    at_cut = np.array(at_cut)
    later = cut_first[chosen + 1] - cut_first[chosen] - at_cut  # this cut and those after it
    owner = np.repeat(np.arange(len(chosen)), later)
    local = np.arange(later.sum()) - np.repeat(np.cumsum(later) - later, later) + at_cut[owner]
    node = lattice.begin[every[cut_first[chosen[owner]] + local]]
    node[np.cumsum(later) - later] = lattice.end[new_edges]
    edges, steps = lattice.walk(node, mix(seeds(chosen[owner], 4 * turn + 3) + local.astype(np.uint64)))
    cut = np.repeat(local, steps)
    per_doc = np.add.reduceat(steps, np.cumsum(later) - later)
    ends = np.cumsum(per_doc)
    sizes = kept + 1 + per_doc
    first = np.append(0, np.cumsum(sizes))
    all_edges, all_cuts = np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
    for i in range(len(chosen)):
        at, k, lo = first[i], kept[i], ends[i] - per_doc[i]
        all_edges[at : at + k], all_edges[at + k], all_edges[at + k + 1 : first[i + 1]] = heads[i], new_edges[i], edges[lo : ends[i]]
        all_cuts[at : at + k + 1], all_cuts[at + k + 1 : first[i + 1]] = tails[i], cut[lo : ends[i]]
    return _Path(chosen, all_edges, first, all_cuts, value, kept + 1, lattice, seeds(chosen, 4 * turn + 4))


_OUT = "id bigint, sample int, ids array<int>, log_prob double, perturbed double, inclusion double, decoded string"


def segmentations(docs: DataFrame, model: str, k: int = 2, seed: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document and sample: piece ids, scores, and the text that the ids decode to."""
    return _drawn(docs, model, k, seed, key, text, _OUT, lambda v, t, ids: (ids, v.decode(ids)), BATCH_CHARS)


def summaries(docs: DataFrame, model: str, k: int = 2, seed: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``segmentations``, with the number and the crc32 of the ids, and whether they decode to the text instead of what they decode to."""
    import zlib

    out = "id bigint, sample int, ids array<int>, n_pieces bigint, ids_crc32 bigint, log_prob double, perturbed double, inclusion double, round_trip boolean"

    def digest(v, t, ids):
        return ids, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), v.decode(ids) == (t or "")

    return _drawn(docs, model, k, seed, key, text, out, digest, SUMMARY_CHARS)


def _listed(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """Rows of numbers as one column, copied at once."""
    ends = np.append(0, np.cumsum([len(x) for x in rows])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *rows])), type=kind)


def _drawn(docs, model, k, seed, key, text, out, view, chars) -> DataFrame:
    schema = arrow_schema(T.StructType.fromDDL(out))

    def draw(parts):
        vocabulary = Vocabulary.of(model)
        for part in parts:
            at = 0
            texts_ = part.column("t").to_pylist()
            ids_ = part.column("id").to_pylist()
            while at < len(texts_):
                upto, size = at, 0
                while upto < len(texts_) and size < chars:
                    size += len(texts_[upto] or "") + 50
                    upto += 1
                some, keys = texts_[at:upto], ids_[at:upto]
                columns = [[] for _ in schema]
                for id_, t, list_ in zip(keys, some, sample(vocabulary, some, ["null" if x is None else str(x) for x in keys], k, seed)):
                    for i, (ids, log_p, value, inclusion) in enumerate(list_):
                        *front, back = view(vocabulary, t, ids)
                        for column, x in zip(columns, (id_, i, *front, log_p, value, inclusion, back)):
                            column.append(x)
                columns[2] = _listed(columns[2], schema.field("ids").type)
                yield batch(schema, *columns)
                at = upto
        _VOCABULARIES.clear()  # later stages need not carry it

    return docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("t")).mapInArrow(tidied(draw), out)
