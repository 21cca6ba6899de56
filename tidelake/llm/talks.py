"""Repair of conversation structure: cheapest edits that give every conversation the role pattern ``(s?(ua)+)?``.

Each turn is kept (0), given another role (1) or deleted (2); an empty user or assistant turn may be inserted anywhere (5). Blank turns
and copies of an earlier turn must be deleted; a truncated turn that stays costs 5 more. Among the cheapest repairs the one with the
ASCII-least audit, the initials of the edits in order, is taken.

Weights: one integer says it all. Its high digits are the cost, its low digits the audit, two for each turn in base five with
``D < I < K < R`` and zero for the end padding: D., IK, IR, K., R. (an insertion before a deleted turn never comes first, and two
in a row are never cheapest but at the very end). No such word begins another, so comparing them turn by turn is comparing audits,
and adding the weights of successive edits concatenates them: a plain integer minimum over the graph of turns and pattern states decides cost and ties.

Scale: turns are dealt out by ranges of (conversation, turn, role, digest), so that a conversation of any length spreads over
tasks, and cut into segments of at most ``SEGMENT_TURNS`` turns. Every segment is solved between any two states of the pattern on its own. One light
row for each segment then goes through its conversation in order, where the at most four best audits so far stand as their ranks above the
next segment's digits. Texts move twice: by range, and by conversation for the digest of the repaired text, which is taken as a stream.

Defined cases: a null text or role is one space; null turns come first; turns with equal numbers go by role, then by digest of the text; a null
conversation id is a conversation; identical rows are copies of one another; roles count by their first character; a conversation
without turns is empty and costs nothing; an empty table gives no rows; only the four named columns are read. Copies are told by SHA-256.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.shared import arrow_schema, batch, keep

SEGMENT_TURNS, SEGMENT_CHARS = 512, 1 << 20
#: States of the pattern: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
FINE, TRUNCATED, BLANK, COPY = range(4)
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 1, 2, 5, 5
#: Two digits of each word in base five.
DIGITS = {"D.": 5, "IK": 13, "IR": 14, "K.": 15, "R.": 20}
WORDS = {v: k for k, v in DIGITS.items()}
BASE = 25
#: What an end in each state still needs: cost, rank among ends, edits.
ENDS = {START: (0, 0, ""), ASSISTANT: (0, 0, ""), USER: (INSERT, 1, "I."), SYSTEM: (2 * INSERT, 2, "II")}
LEGAL = {"su", "ua", "au"}
SEEN = re.compile(r"[^ \t-\r]")
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damaged(talks: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The test bed: rows damaged by crc32 of ``conv:turn`` modulo 20, as ``(conv, turn, role, text, copies)``."""
    spoken = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn, role, text)]
    kind = F.crc32(F.concat_ws(":", *spoken[:2]).cast("binary")) % 20
    rows = talks.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), spoken[2].alias("role"), spoken[3].alias("text"), kind.alias("kind"))
    return rows.filter("kind <> 0").select(
        "conv",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).alias("copies"),
    )


def state_after(role: str) -> int | None:
    return {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(role[:1])


def needed(state: int) -> tuple[str, int]:
    """The role that an inserted or re-roled turn takes, and the state after it."""
    return ("assistant", ASSISTANT) if state == USER else ("user", USER)


def moves(kind: int, role: str) -> list[tuple[int, int, int, int]]:
    """``(state, next state, cost, digits)`` of all edits of one turn."""
    found = [(s, s, DELETE, DIGITS["D."]) for s in range(4)]
    if kind in (BLANK, COPY):
        return found
    more, own = UNFINISHED if kind == TRUNCATED else 0, state_after(role)
    for s in range(4):
        now = needed(s)[1]
        then = needed(now)[1]
        if own == now or (own, s) == (SYSTEM, START):
            found.append((s, own, KEEP + more, DIGITS["K."]))
        if own == then:
            found.append((s, own, INSERT + KEEP + more, DIGITS["IK"]))
        found.append((s, now, REROLE + more, DIGITS["R."]))
        found.append((s, then, INSERT + REROLE + more, DIGITS["IR"]))
    return found


def solve(kinds: bytes, initials: list[str]) -> list[list[int | None]]:
    """The least weight between any two states over a segment; costs stand above ``BASE ** turns``."""
    high = place = BASE ** len(kinds)
    best: list[list[int | None]] = [[0 if s == t else None for t in range(4)] for s in range(4)]
    edges: dict[tuple[int, str], list] = {}
    for kind, initial in zip(kinds, initials):
        if (kind, initial) not in edges:
            edges[kind, initial] = moves(kind, initial)
        place //= BASE
        steps = [(s, t, cost * high + digits * place) for s, t, cost, digits in edges[kind, initial]]
        for i, row in enumerate(best):
            new: list[int | None] = [None] * 4
            for s, t, weight in steps:
                if (w := row[s]) is not None and (new[t] is None or w + weight < new[t]):
                    new[t] = w + weight
            best[i] = new
    return best


def spell(digits: int, turns: int) -> str:
    """The words of a segment's audit, two characters for each turn."""
    found = []
    for _ in range(turns):
        digits, word = divmod(digits, BASE)
        found.append(WORDS[word])
    return "".join(reversed(found))


def replay(state: int, words: str, roles: list[str], texts: list[str]) -> tuple[list[tuple[str, str]], int]:
    """The turns that a segment's edits leave, and the state after them."""
    made = []
    for i in range(0, len(words), 2):
        for edit in words[i : i + 2]:
            if edit in "IR":
                role, state = needed(state)
                made.append((role, "" if edit == "I" else texts[i // 2]))
            elif edit == "K":
                made.append((roles[i // 2], texts[i // 2]))
                state = state_after(roles[i // 2])
    return made, state


def _segments(rows: DataFrame) -> DataFrame:
    """Turns in order, cut into segments whose numbers rise within a conversation; written once."""
    fields = "seg bigint, kinds binary, roles array<string>, texts array<string>, digests array<binary>, turns array<bigint>"
    schema = T.StructType([T.StructField("conv", rows.schema["conv"].dataType), *T.StructType.fromDDL(fields)])
    arrow = arrow_schema(schema)

    def cut(batches):
        conv, held, chars, number, part_id = None, [], 0, 0, 0
        ready: list[tuple] = []

        def close():
            nonlocal held, chars, number
            if held:
                kinds, roles, texts, digests, turns = zip(*held)
                ready.append((conv, (part_id << 33) + number, bytes(kinds), roles, texts, digests, turns))
                number += 1
            held, chars = [], 0

        for part in batches:
            for own, turn, role, text, copies, part_id in zip(*(c.to_pylist() for c in part.columns)):
                if own != conv:
                    close()
                    conv = own
                kind = BLANK if not SEEN.search(text) else FINE if text.rstrip(" \t\n\v\f\r")[-1] in ".!?" else TRUNCATED
                digest = hashlib.sha256(f"{own!r} {len(role)} {role}{text}".encode()).digest()
                for _ in range(copies):
                    held.append((kind, role, text, digest, turn))
                    chars += len(text)
                    if len(held) >= SEGMENT_TURNS or chars >= SEGMENT_CHARS:
                        close()
                if len(ready) >= 256 or sum(len(r[2]) for r in ready) > SEGMENT_TURNS * 8:
                    yield batch(arrow, *zip(*ready))
                    ready = []
        close()
        if ready:
            yield batch(arrow, *zip(*ready))

    named = rows.select("conv", F.col("turn").cast("bigint").alias("turn"), "role", "text", "copies")
    # the last key only spreads identical rows
    order = ["conv", "turn", "role", F.sha2("text", 256)]
    dealt = named.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
    return keep(dealt.withColumn("part", F.spark_partition_id()).mapInArrow(cut, schema), "talk-segments")


def _copies(segments: DataFrame) -> DataFrame:
    """``(seg, places)``: places of turns whose role and text come earlier in the conversation."""
    turns = segments.select("seg", F.posexplode("digests").alias("place", "digest"))
    first = turns.groupBy("digest").agg(F.min(F.struct("seg", "place")).alias("first"), F.count("*").alias("n"))
    later = turns.join(first.filter("n > 1"), "digest").filter(F.struct("seg", "place") > F.col("first"))
    return later.groupBy("seg").agg(F.sort_array(F.collect_list("place")).alias("places"))


def _solved(segments: DataFrame) -> DataFrame:
    """A light row for each segment: counts, edge values and the least weight between any two states."""
    counts = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, distinct bigint"
    fields = f"seg bigint, n int, {counts}, low bigint, high bigint, head string, tail string, weights array<binary>"
    schema = T.StructType([segments.schema["conv"], *T.StructType.fromDDL(fields)])
    arrow = arrow_schema(schema)

    def run(batches):
        for part in batches:
            made = []
            for conv, seg, kinds, initials, turns, places in zip(*(c.to_pylist() for c in part.columns)):
                kinds = bytearray(kinds)
                for p in places or ():
                    kinds[p] = kinds[p] if kinds[p] == BLANK else COPY
                known = [t for t in turns if t is not None]
                weights = [None if w is None else w.to_bytes(w.bit_length() // 8 + 1, "big") for row in solve(bytes(kinds), initials) for w in row]
                illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
                made.append(
                    (conv, seg, len(kinds), kinds.count(BLANK), kinds.count(COPY), kinds.count(TRUNCATED), illegal, len(set(known)))
                    + (min(known, default=None), max(known, default=None), initials[0], initials[-1], weights)
                )
            if made:
                yield batch(arrow, *zip(*made))

    light = segments.select("conv", "seg", "kinds", F.transform("roles", lambda r: F.left(r, F.lit(1))).alias("initials"), "turns")
    return light.join(_copies(segments), "seg", "left").select("conv", "seg", "kinds", "initials", "turns", "places").mapInArrow(run, schema)


class _Chain:
    """The segments of one conversation in order: totals, and the best way into each state."""

    def __init__(self):
        self.totals = dict.fromkeys(COUNTS, 0)
        self.best: dict[int, tuple[int, int]] = {START: (0, 0)}  # cost, and rank of the audit so far
        self.steps: list[tuple[int, dict[int, tuple[int, int]]]] = []
        self.low = self.high = self.tail = None
        self.distinct = 0

    def add(self, row: dict) -> None:
        for name in ("blank", "duplicate", "truncated", "illegal"):
            self.totals[name] += row[name]
        self.totals["illegal"] += self.tail is not None and self.tail + row["head"] not in LEGAL
        self.tail = row["tail"]
        if row["low"] is not None:
            self.distinct += row["distinct"] - (self.high == row["low"])
            self.low = row["low"] if self.low is None else self.low
            self.high = row["high"]
        high = BASE ** row["n"]
        reached: dict[int, tuple[int, int, int]] = {}
        for s, (cost, rank) in self.best.items():
            for t in range(4):
                if (raw := row["weights"][4 * s + t]) is not None:
                    more, digits = divmod(int.from_bytes(raw, "big"), high)
                    # the rank stands for the digits before: at most four differ
                    weight = ((cost + more) * 4 + rank) * high + digits
                    if t not in reached or weight < reached[t][0]:
                        reached[t] = (weight, s, digits)
        audits = sorted({weight % (4 * high) for weight, _, _ in reached.values()})
        self.best = {t: (weight // (4 * high), audits.index(weight % (4 * high))) for t, (weight, _, _) in reached.items()}
        self.steps.append((row["seg"], row["n"], {t: (s, digits) for t, (_, s, digits) in reached.items()}))

    def decide(self) -> Iterator[tuple]:
        """``(seg, state before, words, totals or None)`` from the last segment to the first."""
        state = min(self.best, key=lambda s: (self.best[s][0] + ENDS[s][0], self.best[s][1], ENDS[s][1]))
        self.totals["cost"] = self.best[state][0] + ENDS[state][0]
        if self.low is not None:
            self.totals["gaps"] = self.high - self.low + 1 - self.distinct
        end, totals = ENDS[state][2], self.totals
        for seg, n, ways in reversed(self.steps):
            state, digits = ways[state]
            yield seg, state, spell(digits, n) + end, totals
            end, totals = "", None


def _decided(solved: DataFrame) -> DataFrame:
    """For each segment the state before it and its edits; its conversation's counts stand at the last one."""
    counts = ", ".join(f"{c}: bigint" for c in COUNTS)
    schema = T.StructType([solved.schema["conv"], *T.StructType.fromDDL(f"seg bigint, before int, words string, totals struct<{counts}>")])
    arrow = arrow_schema(schema)

    def run(batches):
        conv, chain, made = None, None, []
        for part in batches:
            for row in part.to_pylist():
                if chain is None or row["conv"] != conv:
                    made += [(conv, *d) for d in chain.decide()] if chain else []
                    conv, chain = row["conv"], _Chain()
                chain.add(row)
                if len(made) > 4096:
                    yield batch(arrow, *zip(*made))
                    made = []
        made += [(conv, *d) for d in chain.decide()] if chain else []
        for i in range(0, len(made), 4096):
            yield batch(arrow, *zip(*made[i : i + 4096]))

    return solved.repartition("conv").sortWithinPartitions("conv", "seg").mapInArrow(run, schema)


def _plan(talks: DataFrame, rows: DataFrame, conv: str) -> DataFrame:
    """In order for each conversation: a row that it exists, then for each segment its decision and its turns."""
    segments = _segments(rows)
    decided = keep(_decided(_solved(segments)), "talk-edits")
    there = talks.select(F.col(conv).alias("conv")).distinct().withColumn("seg", F.lit(-1).cast("bigint"))
    every = there.unionByName(decided, True).unionByName(segments.select("conv", "seg", "roles", "texts"), True)
    return every.repartition("conv").sortWithinPartitions("conv", "seg", F.col("roles").isNotNull())


def _rows(talks: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    spoken = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))]
    return talks.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), *spoken, F.lit(1).alias("copies"))


def _one_row(part, i: int, *names: str) -> list:
    return [part.column(n)[i].as_py() for n in names]


def summaries(talks: DataFrame, damage: bool = False, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """For each conversation its faults, the cost of the repair, the audit and the digest of the repaired text."""
    rows = (damaged if damage else _rows)(talks, conv, turn, role, text)
    plan = _plan(talks, rows, conv)
    numbers = ", ".join(f"{c} bigint" for c in COUNTS)
    schema = T.StructType([plan.schema["conv"], *T.StructType.fromDDL(f"{numbers}, audit string, repaired_sha256 string")])
    arrow = arrow_schema(schema)

    def run(batches):
        open_ = None
        for part in batches:
            made = []
            for i in range(part.num_rows):
                conv_, seg, before, words, totals, roles = _one_row(part, i, "conv", "seg", "before", "words", "totals", "roles")
                if seg < 0:
                    made += [close(open_)] if open_ else []
                    open_ = [conv_, dict.fromkeys(COUNTS, 0), [], hashlib.sha256(), False]
                elif roles is None:
                    edits = before, words
                    open_[1] = totals or open_[1]
                    open_[2].append(words.replace(".", ""))
                else:
                    for r, t in replay(*edits, roles, part.column("texts")[i].as_py())[0]:
                        open_[3].update(f"{chr(10) * open_[4]}{r}:{t}".encode())
                        open_[4] = True
            if made:
                yield batch(arrow, *zip(*made))
        if open_:
            yield batch(arrow, *zip(close(open_)))

    def close(state):
        conv_, totals, audit, digest, _ = state
        return conv_, *(totals[c] for c in COUNTS), "".join(audit), digest.hexdigest()

    return plan.mapInArrow(run, schema).withColumnRenamed("conv", conv)


def repaired(talks: DataFrame, damage: bool = False, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired conversations: ``(conv, place, role, text)``, places from 0."""
    rows = (damaged if damage else _rows)(talks, conv, turn, role, text)
    plan = _plan(talks, rows, conv)
    schema = T.StructType([plan.schema["conv"], *T.StructType.fromDDL("place bigint, role string, text string")])
    arrow = arrow_schema(schema)

    def run(batches):
        place = 0
        for part in batches:
            for i in range(part.num_rows):
                conv_, seg, before, words, roles = _one_row(part, i, "conv", "seg", "before", "words", "roles")
                if seg < 0:
                    place = 0
                elif roles is None:
                    edits = before, words
                else:
                    made, _ = replay(*edits, roles, part.column("texts")[i].as_py())
                    if made:
                        yield batch(arrow, [conv_] * len(made), range(place, place + len(made)), *zip(*made))
                    place += len(made)

    return plan.mapInArrow(run, schema).withColumnRenamed("conv", conv)
