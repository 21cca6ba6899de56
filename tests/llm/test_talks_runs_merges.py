"""Conversation repair, periodic runs and BPE against brute force and the library."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import cache

import numpy as np
import pyarrow.parquet as pq
import pytest

from tidelake.llm import merges, queries, runs, talks

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TALKS = "conv_id bigint, turn bigint, role string, text string, conv string, seg int, kinds string, words string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# -- conversations


def hurt(rows):
    found = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind:
            x = {1: "", 2: re.sub("[.!?]", "", x)}.get(kind, x)
            found += [(t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    return found


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], sha(r[2])))


def brute(rows):
    """The same answers by plain search over whole audits."""
    rows = in_order(rows)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    kinds, seen = [], set()
    for _, r, x in rows:
        blank = not WORD.search(x)
        kinds.append("b" if blank else "d" if (r, x) in seen else "t" if re.sub(r"[\x20\x09-\x0D]", "", x)[-1] not in ".!?" else "")
        seen.add((r, x))
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @cache
    def best(i, state, room):
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if room:
            for role in ("user", "assistant"):
                if (now := step.get((state, role[0]))) and (rest := best(i, now, room - 1)):
                    found.append((rest[0] + 5, "I" + rest[1], (role + ":",) + rest[2]))
        if i < len(rows):
            _, role, text = rows[i]
            if rest := best(i + 1, state, 2):
                found.append((rest[0] + 2, "D" + rest[1], rest[2]))
            if kinds[i] in ("", "t"):
                for edit, cost, r in (("K", 0, role), ("R", 1, "user"), ("R", 1, "assistant")):
                    if (now := step.get((state, r[:1]))) and (rest := best(i + 1, now, 2)):
                        found.append((rest[0] + cost + 5 * (kinds[i] == "t"), edit + rest[1], (f"{r}:{text}",) + rest[2]))
        return min(found, default=None)

    for i in range(len(rows), 0, -20):  # fills the cache from the end
        best(i, "", 2), best(i, "s", 2), best(i, "u", 2), best(i, "a", 2)
    cost, audit, kept = best(0, "", 2)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return gaps, kinds.count("b"), kinds.count("d"), kinds.count("t"), illegal, cost, audit, sha("\n".join(kept))


def some_talks(seed, count, longest):
    pick, rows = random.Random(seed), []
    for c in range(count):
        for t in range(pick.randint(1, longest)):
            role = pick.choice(["user", "assistant", "user", "assistant", "system", None, "tool", ""])
            text = pick.choice(["Yes.", "No", "a b!", "", " \n", None, f"{t}?", f"t{t}.", "x\t"])
            rows.append((c if c else None, pick.choice([t, t, t, None, t + 3]), role, text))
    return rows


def frame(spark, rows, ddl=TALKS):
    return spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], ddl)


def answers(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def by_conv(rows):
    found = {}
    for r in rows:
        found.setdefault(r[0], []).append(r)
    return found


def test_talks_equal_brute_force(spark):
    rows = some_talks(1, 300, 9)
    got = answers(talks.summaries(frame(spark, rows), damage=True))
    assert got == {c: brute(hurt(rs)) for c, rs in by_conv(rows).items()}


@pytest.mark.parametrize("turns", [1, 2, 7])
def test_segments_of_any_size_give_the_same_repair(spark, monkeypatch, turns):
    monkeypatch.setattr(talks, "SEGMENT_TURNS", turns)
    rows = some_talks(2, 40, 30)
    got = answers(talks.summaries(frame(spark, rows)))
    plain = {c: brute([(t, " " if r is None else r, " " if x is None else x) for _, t, r, x in rs]) for c, rs in by_conv(rows).items()}
    assert got == plain


def test_one_conversation_spreads_over_tasks(spark):
    rows = [(7, i, ("user", "assistant")[i % 2 if i % 50 else 0], f"turn {i}." if i % 30 else "again.") for i in range(600)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        segments = talks._segments(talks._rows(frame(spark, rows).repartition(8), "conv_id", "turn", "role", "text"))
        assert segments.selectExpr("seg >> 33").distinct().count() > 1
        got = answers(talks.summaries(frame(spark, rows).repartition(8)))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {7: brute([r[1:] for r in rows])}


def test_talks_without_turns_and_repeated_rows(spark):
    dropped = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    same = [(1, 5, "user", "Hello."), (1, 5, "user", "Hello."), (1, 6, "assistant", "Yes."), (dropped, 0, "user", "Gone.")]
    got = answers(talks.summaries(frame(spark, same), damage=True))
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", sha(""))
    assert got[1] == brute(hurt(same[:3]))
    assert answers(talks.summaries(frame(spark, []), damage=True)) == {}


def test_repaired_turns_follow_the_pattern(spark):
    rows = some_talks(3, 60, 12)
    kept = {}
    for c, place, role, text in sorted(map(tuple, talks.repaired(frame(spark, rows)).collect()), key=lambda r: (str(r[0]), r[1])):
        kept.setdefault(c, []).append((role, text))
        assert place == len(kept[c]) - 1
    assert all(re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in turns)) for turns in kept.values())
    digests = {c: a[-1] for c, a in answers(talks.summaries(frame(spark, rows))).items()}
    assert digests == {c: sha("\n".join(f"{r}:{t}" for r, t in kept.get(c, []))) for c in digests}


def test_query_11_equals_brute_force(spark):
    rows = [tuple(r.values()) for r in pq.read_table(f"{SMALL}/conversations.parquet").to_pylist()]
    got = answers(queries.op11_talks(spark, SMALL))
    assert got == {c: brute(hurt(rs)) for c, rs in by_conv(rows).items()}


# -- runs


def all_runs(words, least=12):
    """Maximal repetitions by comparing the words with themselves at every distance."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1) if j == i else j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def run_digest(words, least=12):
    found = all_runs(words, least)
    found.sort(key=lambda r: (r[0], r[2]))
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return len(found), *shown, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(kept)


def some_words(pick):
    size = pick.randint(0, 150)
    words = [pick.choice("abcde"[: pick.choice([1, 2, 2, 3, 5])]) for _ in range(size)]
    for _ in range(pick.randint(0, 3) if size else 0):
        a = pick.randrange(size)
        p = 1 + pick.randrange(max(1, (size - a) // 2))
        for i in range(a, min(size, a + p * pick.randint(2, 6))):
            words[i] = words[a + (i - a) % p]
    return words


@pytest.mark.parametrize("least", [2, 3, 5, 12, 31])
def test_runs_equal_brute_force(least):
    pick = random.Random(least)
    texts = [some_words(pick) for _ in range(400)] + [["a"] * 300, ("a b " * 9 + "a ").split() * 4]
    a, b = "a", "ab"
    while len(b) < 900:
        a, b = b, b + a
    texts.append(list(b))
    for words, (seen, found, stays) in zip(texts, runs.analyse([" ".join(w) for w in texts], least)):
        expected = sorted(all_runs(words, least), key=lambda r: (r[0], r[2]))
        assert seen == words and [tuple(r) for r in found.tolist()] == expected
        dropped = {i for s, n, q in expected for i in range(s + q, s + n)}
        assert dropped == (set() if stays is None else set(np.flatnonzero(~stays).tolist()))


def test_wavelet_matrix_counts_and_selects():
    pick = np.random.default_rng(3)
    for n in (1, 2, 7, 64, 100):
        values = pick.permutation(n)
        matrix = runs.WaveletMatrix(values)
        left = pick.integers(0, n, 50)
        right = np.array([pick.integers(a, n) + 1 for a in left])
        bound = pick.integers(0, n + 1, 50)
        k = np.array([pick.integers(0, b - a) for a, b in zip(left, right)])
        assert matrix.below(left, right, bound).tolist() == [int((values[a:b] < x).sum()) for a, b, x in zip(left, right, bound)]
        assert matrix.smallest(left, right, k).tolist() == [int(np.sort(values[a:b])[i]) for a, b, i in zip(left, right, k)]


def test_run_frames_cover_odd_rows(spark, documents):
    ten = "a b c d e f g h i j "
    long_ = ten * 3000 + "end"
    rows = [(1, None, None), (2, "", "x"), (3, " \n\t", "x"), (4, long_, "x"), (5, ten * 2, "x"), (5, ten * 2, "x"), (None, "é " * 12, "x"), (6, "one two", "x")]
    got = runs.digest(documents(rows)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(i, *run_digest(WORD.findall(t or ""))) for i, t, _ in rows], key=repr)
    listed = sorted(map(tuple, runs.runs(documents(rows)).collect()), key=repr)
    assert listed == sorted([(4, 0, 0, 30_000, 10), (5, 0, 0, 20, 10), (5, 0, 0, 20, 10), (None, 0, 0, 12, 1)], key=repr)
    kept = {r.id: (r.text, r.n_dropped) for r in runs.collapse(documents(rows)).collect()}
    assert kept[4] == (ten + "end", 29_990) and kept[5] == (ten.strip(), 10) and kept[1] == ("", 0) and kept[6] == ("one two", 0)
    assert runs.digest(documents([])).count() == 0


def planted_words(i, text):
    words, h = WORD.findall(text or ""), zlib.crc32(str(i).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if j < a else words[a + (j - a) % p] for j, w in enumerate(words)]
    return words


def test_planted_repetitions_of_odd_texts(documents):
    hit = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = list(zip(hit, [None, "", " \n", "one", "one two three", "a b c d e f g h i j k l m n o p q r s t u v w x y z"], ["x"] * 6)) + [(None, "a b", "x")]
    got = {r.doc_id: r.text for r in runs.planted(documents(rows)).collect()}
    assert {i: WORD.findall(t or "") for i, t in got.items()} == {i: planted_words(i, t) if i is not None else ["a", "b"] for i, t, _ in rows}


def test_query_12_equals_brute_force(spark):
    docs = pq.read_table(f"{SMALL}/documents.parquet").to_pylist()
    got = {r.doc_id: tuple(r)[1:] for r in queries.op12_runs(spark, SMALL).collect()}
    assert len(got) == len(docs)
    for d in docs:
        words = planted_words(d["doc_id"], d["text"])
        if len(words) < 1500:
            assert got[d["doc_id"]] == run_digest(words)


# -- BPE


@pytest.fixture(scope="module")
def vocabulary():
    public = pytest.importorskip("public_tokenizers")
    return public.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library(vocabulary):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(vocabulary)
    made.no_truncation()
    made.no_padding()
    return made


def test_merge_rounds_equal_the_library(vocabulary, library):
    own, pick = merges.Encoder(vocabulary), random.Random(4)
    letters = "aaab \n\t 's'll1290.,!éüß日本語  ՘\U0001df1f\x1c\x85😀\0"
    texts = ["", " ", "a", "  a  b ", "<|endoftext|>", "x<|endoftext|> <|endoftext|><|endof", "a" * 5000, "ab" * 999, "   " * 400 + "x", " 's don't I'LL"]
    texts += ["".join(pick.choice(letters) for _ in range(pick.randint(0, 60))) for _ in range(1500)]
    texts += ["".join(pick.choice("ethaniosr") for _ in range(pick.choice([40, 400, 20_000]))) for _ in range(40)]
    for text, ids in zip(texts, own.encode(texts)):
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == expected, text
        assert own.decode(ids) == library.decode(expected, skip_special_tokens=False), text


def test_every_character_has_the_library_s_class(library):
    split = library.pre_tokenizer.pre_tokenize_str
    for code in [*range(1, 0xD800), *range(0xE000, 0x110000)]:
        text = "a{0}1{0}!{0}".format(chr(code))
        assert [text[a:b] for _, (a, b) in split(text)] == merges.PARTS.findall(text), hex(code)


def test_bpe_frames_cover_odd_rows(spark, documents, vocabulary, library):
    rows = [(1, None, None), (2, "", "x"), (3, "word " * 60_000, "x"), (None, "no id", "x"), (4, "twice", "x"), (4, "twice", "x")]
    found = merges.decode(merges.encode(documents(rows), vocabulary), vocabulary).collect()
    expected = [(i, library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t, _ in rows]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    odd = spark.createDataFrame([(1, [999_999, 64]), (2, None), (3, [])], "id bigint, ids array<int>")
    assert [r.decoded for r in merges.decode(odd, vocabulary).orderBy("id").collect()] == [library.decode([64]), "", ""]
    assert merges.digests(documents([]), vocabulary).count() == 0


def test_another_kind_of_vocabulary_is_refused(vocabulary):
    import public_tokenizers

    with pytest.raises(ValueError, match="byte-level"):
        merges.Encoder(public_tokenizers.path("word_bpe_49k.json"))


def test_query_13_equals_the_library(spark, library):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_merges(spark, SMALL).collect()}
    for d in pq.read_table(f"{SMALL}/documents.parquet").to_pylist():
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids
        assert got[d["doc_id"]] == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
