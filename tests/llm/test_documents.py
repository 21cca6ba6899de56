"""Document operators against brute force, on texts with copies, nulls, empties, ties and long documents."""

from __future__ import annotations

import hashlib
import time
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelake.llm import chains, language, minhash, pieces, quality, queries, suffixes, templates, tokens

public_tokenizers = pytest.importorskip("public_tokenizers")


def edited(text, step):
    return " ".join("zz" if i % step == step - 1 else w for i, w in enumerate(text.split(" ")))


@pytest.fixture
def corpus(words):
    base = words(300, 1)
    rows = [(i, words(120 + 10 * i, i), "en") for i in range(2, 12)]
    rows += [(20, base, "en"), (21, base, "en"), (22, edited(base, 60), "en"), (23, edited(base, 25), None)]
    rows += [(24, "A  " + base[:400].upper() + "\n x", "de"), (25, base + " " + words(40, 77), "de"), (26, words(50, 5) + " " + base, "de")]
    rows += [(30, None, None), (31, "", "en"), (32, "   ", "en"), (33, "one", "en"), (34, "One", "en"), (35, "é" * 300, "fr"), (36, "é" * 301, "fr")]
    rows += [(40, "ab " * 3000, "en"), (41, words(6000, 9), "en"), (41, words(6000, 9), "en"), (None, base, "en"), (None, None, None)]
    return rows


def brute_components(rows, size, percent):
    sets = []
    for i, text, _ in rows:
        w = (text or "").encode().lower().split()
        sets.append((i, {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()))
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, a), (j, b) in combinations(sets, 2):
        if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
            i, j = root(i), root(j)
            parent[max(i, j)] = min(i, j)
    return sorted(((i, len(s), root(i)) for i, s in sets), key=repr)


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_brute_force(documents, corpus, size):
    found = minhash.near_duplicates(documents(corpus), words=size).collect()
    assert sorted(((r.id, r.n_shingles, r.component_id) for r in found), key=repr) == brute_components(corpus, size, 80)
    assert all(r.kept == (r.id is None or r.id == r.component_id) for r in found)


def test_near_duplicate_groups_and_chains_of_links(documents, words):
    """A large group of near copies, and texts linked only through others."""
    base = words(200, 3).split(" ")
    rows = [(i, " ".join(w if (k * 31 + i) % 97 else f"q{i}" for k, w in enumerate(base)), "en") for i in range(60)]
    drift, text = [], words(100, 4).split(" ")
    for i in range(12):
        text[8 * i : 8 * i + 4] = [f"d{i}{k}" for k in range(4)]
        drift.append((100 + i, " ".join(text), "en"))
    rows += drift
    found = minhash.near_duplicates(documents(rows), words=2).collect()
    assert sorted(((r.id, r.n_shingles, r.component_id) for r in found), key=repr) == brute_components(rows, 2, 80)


def test_rows_that_share_an_id_keep_their_links(documents, words):
    a, b = words(100, 501), words(100, 502)

    def other(text, i):
        w = text.split(" ")
        return " ".join([*w[:i], "zz", *w[i + 1 :]])

    rows = [(1, a), (1, b), (2, other(a, 20)), (3, other(b, 30)), (4, other(a, 60)), (5, other(b, 70))]
    rows = [(i, t, "en") for i, t in rows]
    found = minhash.near_duplicates(documents(rows), words=5).collect()
    assert sorted((r.id, r.n_shingles, r.component_id) for r in found) == brute_components(rows, 5, 80)
    assert {r.component_id for r in found} == {1}


def test_copies_under_one_id_go(documents, words):
    a, b = words(80, 601), words(80, 602)
    rows = [(1, a, "en"), (1, a, "en"), (2, a, "en"), (3, b, "en"), (3, b, "en"), (3, words(80, 603), "en"), (None, b, "en"), (4, None, "en"), (4, None, "en")]
    kept = sorted(((r.doc_id, r.text) for r in minhash.deduplicate(documents(rows)).collect()), key=repr)
    assert kept == sorted([(1, a), (3, b), (3, words(80, 603)), (None, b), (4, None)], key=repr)


def test_deduplicate_keeps_columns(documents, corpus):
    docs = documents(corpus)
    kept = minhash.deduplicate(docs, words=5)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert 20 in ids and 21 not in ids and {30, 31, 40} <= ids


def repeated(rows, length, keep_first):
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    raw = [(rows[k][1] or "").encode() for k in range(len(rows))]
    starts = {}
    for k in order:
        for s in range(len(raw[k]) - length + 1):
            starts.setdefault(raw[k][s : s + length], []).append((k, s))
    cover = [bytearray(len(r)) for r in raw]
    for places in starts.values():
        for k, s in places[1:] if keep_first else places if len(places) > 1 else []:
            cover[k][s : s + length] = b"\1" * length
    return raw, cover


@pytest.mark.parametrize("hot", [30_000, 1])
def test_repeated_bytes_equal_brute_force(documents, corpus, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    rows = [r for r in corpus if r[0] != 40] + [(40, "ab " * 200, "en")]
    raw, cover = repeated(rows, 200, False)
    want = []
    for (i, *_), r, c in zip(rows, raw, cover):
        kept = bytes(b for b, x in zip(r, c) if not x)
        spans = sum(x and not y for x, y in zip(c, b"\0" + c))
        want.append((i, len(r), len(r) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    found = [tuple(r) for r in suffixes.digest(documents(rows)).collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("hot", [30_000, 1])
def test_later_copies_go_and_the_first_stays(documents, words, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    passage = words(80, 8)
    rows = [(1, words(30, 1) + passage, "en"), (2, passage + words(50, 2), "en"), (3, "ü" + passage + "ü" + words(9, 3), "en"), (4, None, None)]
    raw, cover = repeated(rows, 200, True)
    docs = documents(rows)
    found = {r.doc_id: r for r in suffixes.remove_repeats(docs, size="n_chars").collect()}
    for (i, text, _), r, c in zip(rows, raw, cover):
        want = None if text is None else bytes(b for b, x in zip(r, c) if not x).decode()
        assert found[i].text == want and found[i].n_chars == (None if want is None else len(want))
    assert found[1].text == rows[0][1] and passage[10:-10] not in found[2].text


def test_longest_previous_factors():
    text = b"abracadabra_abra"
    order = np.array(sorted(range(len(text)), key=lambda i: text[i:]))
    lcp = np.zeros(len(text), np.int64)
    for k in range(1, len(order)):
        a, b = text[order[k - 1] :], text[order[k] :]
        lcp[k] = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    found = suffixes.factors(order, lcp, np.arange(len(text)), 1)
    for i in range(len(text)):
        want = max((n for j in range(i) for n in range(len(text) - i + 1) if text[j : j + n] == text[i : i + n]), default=0)
        assert found[i] == want


def test_token_files_round_trip(spark, documents, corpus):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = corpus + [(50, "a  b \n c\n d <|endoftext|> e it's 12", "en")]
    tokenizer, start, want = Tokenizer.from_file(path), 0, []
    encoded = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for i, t, _ in rows]
    raw = [(i, np.array(x, "<u4").tobytes()) for i, x in encoded]
    for i, b in sorted(raw, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32(r[1]))):
        want.append((i, start, len(b) // 4, b))
        start += len(b) // 4
    found = [tuple(r) for r in tokens.read(spark, tokens.write(documents(rows), path)).collect()]
    assert sorted(found, key=lambda r: r[1]) == want


def test_variable_length_codes():
    values = np.array([0, 1, 255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1, 7], np.uint32)
    for n in range(len(values) + 1):
        assert tokens.unpack(*tokens.pack(values[:n]), n).tolist() == values[:n].tolist()


def test_templates_catch_new_values_where_runs_of_windows_are_consistent(spark, documents):
    item = "If Alice buys 12 apples for 3 dollars and gives 12 of them to her brother Bob then how many apples does Alice still have left"
    items = spark.createDataFrame([(7, item, 1), (8, None, 1), (9, "too short", 1), (None, item, 1)], "item_id bigint, text string, h int")
    swap = item.replace("Alice", "Carla").replace("12", "40").replace("Bob", "Dan").replace("dollars", "euros")
    rows = [
        (1, "Intro. " + item + " End.", "en"), (2, item.upper(), "en"), (3, swap, "en"), (4, item.replace("gives 12", "gives 11"), "en"),
        (5, "apples and pears are what people buy on any ordinary day in town for their own use", "en"), (6, None, None), (None, item, "en"),
        (10, "1 2 3 4 5 6 7 8 9 10 11 12 13 14", "en"),
    ]
    found = {(r.doc, r.item): r for r in templates.matches(documents(rows), items).collect()}
    # one of two equal values changed: windows with either of them are consistent
    assert set(found) == {(1, 7), (2, 7), (3, 7), (4, 7)}
    assert found[1, 7].same_values and found[1, 7].windows == found[1, 7].of_windows and not found[3, 7].same_values
    kept = templates.decontaminate(documents(rows), items)
    assert {r.doc_id for r in kept.collect()} == {5, 6, 10, None}
    assert templates.matches(documents(rows), items.limit(0)).count() == 0


def test_templates_take_slots_by_runs_of_windows(spark, documents):
    """Equal values that are far apart change independently; within one window they must not."""
    far = "when 12 red boxes stand in a long row beside the old garden wall and later on 12 small birds come to sit there"
    near = "if 12 plus 12 apples are put on the big table near the door then how many are there now"
    items = spark.createDataFrame([(1, far), (2, near)], "item_id bigint, text string")
    rows = [
        (1, far.replace("12 red", "40 red").replace("12 small", "15 small"), "en"), (2, near.replace("12 plus 12", "9 plus 9"), "en"),
        (3, "if 12 plus 13 apples are put", "en"), (4, near.replace("12 plus 12", "9 plus 8"), "en"),
    ]
    found = {(r.doc, r.item) for r in templates.matches(documents(rows), items).collect()}
    # the windows of the last one that hold no number are copies as they are
    assert found == {(1, 1), (2, 2), (4, 2)}


def test_windows_are_told_apart_by_content_alone():
    words = np.random.default_rng(1).integers(1, 1 << 63, 40, dtype=np.uint64)
    none = np.zeros(120, np.uint64)
    h, place, _ = templates.windows(np.concatenate([words, words, words]), none, 10)
    assert (h[:30] == h[40:70]).all() and (h[:30] == h[80:110]).all() and len(set(h.tolist())) == 40 and place.tolist() == list(range(111))


def test_templates_catch_values_that_coincide_and_longer_names(spark, documents):
    """Unlike values that become equal, a name of two words; number-dense and short items as they are, and with other numbers."""
    fruit = "when anna has 3 apples and 5 pears in one basket then how many pieces of fruit are there"
    sum_ = "Evaluate 3 plus 14 minus 2 times 77 over 9 for 1 2 3"
    name = "yesterday Alice went to town with Bob and they saw Alice there"
    items = spark.createDataFrame([(1, fruit), (2, sum_), (3, name), (4, "Define 7 entropy now")], "item_id bigint, text string")
    other = sum_.replace("14", "15").replace("77", "8").replace("9", "4")
    rows = [
        (1, fruit.replace("3", "4").replace("5", "4"), "en"), (2, "so " + sum_ + " then", "en"), (3, other, "en"),
        (4, name.replace("Alice", "Mary Ann"), "en"), (5, "please define 7 entropy now", "en"), (6, "define 8 entropy now", "en"),
        (7, "Compute 3 over 14 plus 2 plus 77 over 9 for 1 2 3", "en"),
    ]
    found = {(r.doc, r.item) for r in templates.matches(documents(rows), items).collect()}
    assert found == {(1, 1), (2, 2), (3, 2), (4, 3), (5, 4)}


def test_chains_find_fuzzy_passages(documents, words):
    passage = words(90, 1)
    dropped = " ".join(w for k, w in enumerate(passage.split(" ")) if k != 45)
    rows = [(1, words(100, 2) + " " + passage + " " + words(100, 3), "en"), (2, words(70, 4) + " " + edited(passage, 30), "en"),
            (3, dropped + " " + words(60, 5), "en"), (4, words(300, 6), "en"), (5, words(300, 6), "en"), (6, None, None), (7, "", "en")]
    found = {(r.doc_id, r.other_id): r for r in chains.passages(documents(rows)).collect()}
    assert set(found) == {(2, 1), (3, 1), (5, 4)}
    assert (found[2, 1].start, found[2, 1].end) == (70, 160 - (90 % 30 == 0)) and found[2, 1].other_start == 100
    assert found[3, 1].start == 0 and found[3, 1].end == 89 and (found[3, 1].other_start, found[3, 1].other_end) == (100, 190)
    assert found[3, 1].agreeing == 89


def test_chains_meet_every_earlier_holder(documents, words):
    """The first holders of all seeds hold pieces shorter than a passage; the whole is only in two later documents."""
    passage = words(150, 50).split(" ")
    rows = [(i + 1, f"{words(60, i)} {' '.join(passage[25 * i : 25 * i + 45])} {words(60, 20 + i)}", "en") for i in range(5)]
    rows += [(8, f"{words(40, 31)} {' '.join(passage)} {words(30, 32)}", "en"), (9, f"{words(20, 33)} {' '.join(passage)} {words(70, 34)}", "en")]
    found = {(r.doc_id, r.other_id): r for r in chains.passages(documents(rows)).collect()}
    assert (found[9, 8].start, found[9, 8].end, found[9, 8].other_start, found[9, 8].agreeing) == (20, 170, 40, 150)


def test_chains_go_on_beyond_passages_of_other_holders(documents, words):
    """All triples that the third text shares with the second lie in its passage of the first, but the words after them do not."""
    passage = words(80, 60).split(" ")
    changed = [f"q{k}" if k >= 60 and k % 2 == 0 else w for k, w in enumerate(passage)]
    rows = [(1, f"{words(40, 61)} {' '.join(passage[:60])} {words(30, 62)}", "en"), (2, f"{words(50, 63)} {' '.join(changed[30:])} {words(30, 64)}", "en"),
            (9, f"{words(20, 65)} {' '.join(passage)} {words(70, 66)}", "en"), (10, f" {words(49, 67)}\n", "en"), (11, f" {words(49, 67)}\n", "en")]
    found = {(r.doc_id, r.other_id): (r.start, r.end, r.other_start, r.other_end, r.agreeing) for r in chains.passages(documents(rows)).collect()}
    assert found == {(9, 1): (20, 80, 40, 100, 60), (9, 2): (50, 100, 50, 100, 40)}


def test_chains_compare_in_waves_and_groups_as_at_once(documents, words, monkeypatch):
    passage = words(60, 70)
    rows = [(i, f"{words(30, 71 + i)} {passage} {words(9 + i, 91 + i)} {words(70, 111 + i // 2)}", "en") for i in range(12)]
    want = sorted(chains.passages(documents(rows)).collect())
    monkeypatch.setattr(chains, "GROUP_BYTES", 1500)
    monkeypatch.setattr(chains, "WAVE_BYTES", 1)
    assert sorted(chains.passages(documents(rows)).collect()) == want and len(want) >= 17


def test_chains_count_seeds_without_moving_each(documents, words, monkeypatch):
    """Chunks send packed counts; the k-mers kept are those that occur twice, wherever their copies lie."""
    plans, kept, keep = [], [], chains.keep

    def watched(df, purpose):
        if not kept:
            plans.append(df._jdf.queryExecution().toString())
        found = keep(df, purpose)
        if purpose == "seeds":
            kept.extend(found.collect())
        return found

    monkeypatch.setattr(chains, "keep", watched)
    monkeypatch.setattr(chains, "CHUNK_WORDS", 150)
    rows = [(i, f"{words(40, i)} {words(30, 900 + i // 3)} {words(5, 7)}", "en") for i in range(12)] + [(20, "a b", "en"), (21, "é " * 60, "fr")]
    chains.passages(documents(rows)).collect()
    assert plans and not any("hashpartitioning(h" in p for p in plans)
    triples = {(i, k): tuple(w[k : k + 3]) for i, text, _ in rows for w in [text.split()] for k in range(len(w) - 2)}
    often = {x for x, n in Counter(triples.values()).items() if n > 1}
    assert sorted((r.id, r.place) for r in kept) == sorted(k for k, x in triples.items() if x in often)


def test_cuts_that_come_again_are_encoded_once(monkeypatch, words):
    encoder = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    often, learnt, learn = words(50, 8), [], encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda cuts: (learnt.extend(cuts), learn(cuts)))
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 100)
    texts = [f"x {often} {' '.join(f'w{i}q{k}' for k in range(70))}" for i in range(6)]
    texts += ["a  b", "a ", " a", " ", "", None, "a \n b", "a\n b\n", "a \u3000b", "é ü\n"]
    want = [np.array(encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert [encoder.encode([t])[0] for t in texts] == want
    # words forgotten in between are learnt again, those that come up in every text are not
    assert Counter(learnt).most_common(1)[0][1] == 1


def test_rows_are_packed_together_as_alone():
    pick = np.random.default_rng(4)
    rows = [pick.integers(0, 1 << pick.integers(1, 33), n).astype(np.uint32) for n in (0, 1, 4, 5, 0, 333, 3, 0)]
    counts = np.array(list(map(len, rows)))
    control, data = tokens.pack_rows(np.concatenate(rows), counts)
    assert [(c.as_py(), d.as_py()) for c, d in zip(control, data)] == [tokens.pack(r) for r in rows]
    assert (tokens.unpack_rows(control.to_pylist(), data.to_pylist(), counts) == np.concatenate(rows)).all()
    assert all((tokens.unpack(*tokens.pack(r), len(r)) == r).all() for r in rows)


@pytest.mark.parametrize("step", [5, 6, 8, 10, 12, 20])
def test_chains_find_passages_with_many_edits(documents, words, step):
    """Fifty words with every ``step``-th changed, all of them."""
    rows = []
    for i in range(40):
        passage = words(50 if step > 5 else 51, 1000 + i)
        rows += [(2 * i, f"{words(60, 2000 + i)} {passage} {words(30, 3000 + i)}", "en"), (2 * i + 1, f"{words(40, 4000 + i)} {edited('qq ' + passage, step)[3:]} {words(50, 5000 + i)}", "en")]
    found = {(r.doc_id, r.other_id) for r in chains.passages(documents(rows)).collect()}
    want = set()
    for i in range(40):
        a, b = (rows[2 * i + k][1].split(" ") for k in (0, 1))
        equal = np.array([x == y for x, y in zip(a[60:111], b[40:91])])
        ends = np.append(0, np.cumsum(equal))
        if any(5 * (ends[e] - ends[s]) >= 4 * (e - s) for s in range(len(equal)) for e in range(s + 50, len(equal) + 1) if equal[s] and equal[e - 1]):
            want.add((2 * i + 1, 2 * i))
    assert found == want and (len(want) == 40 or step == 5)


def test_chains_find_shifted_passages_of_repetitive_texts(documents):
    """Nearly every word triple of two texts occurs many times in both, at other places and in another number."""
    pick = np.random.default_rng(7)
    passage, before, after = (" ".join(pick.choice(["to", "be", "or"], n)) for n in (60, 400, 500))
    rows = [(1, f"{before} {passage} first", "en"), (2, f"{passage} second {after}", "en")]
    found = [r for r in chains.passages(documents(rows)).collect() if (r.doc_id, r.other_id) == (2, 1)]
    assert any(r.start == 0 and r.other_start == 400 and r.end >= 60 and r.agreeing >= 60 for r in found)


@pytest.mark.parametrize("block", [1, 50, 1 << 18])
def test_runs_hold_all_matches_in_blocks_of_any_size(monkeypatch, block):
    monkeypatch.setattr(chains, "BLOCK", block)
    pick = np.random.default_rng(block)
    for size in (0, 2, 3, 40, 150):
        a, b = (pick.integers(0, 3, n).astype(np.uint64) for n in (size, 90))
        for other in (b, None):
            held = b if other is not None else a
            pairs = [(i, j) for i in range(size - 2) for j in range(len(held) - 2 if other is not None else i) if (a[i : i + 3] == held[j : j + 3]).all()]
            want = {}
            for i, j in pairs:  # by place
                on = want.setdefault(i - j, [])
                if on and i - on[-1][1] <= chains.JOIN_GAP:
                    on[-1][1:] = [i, on[-1][2] + 1]
                else:
                    on.append([i, i, 1])
            assert chains.runs(chains.shared(a, other)) == sorted((s, e + 1, d, n) for d, on in want.items() for s, e, n in on)


def test_fenwick_chains_equal_all_predecessors():
    pick = np.random.default_rng(4)
    for _ in range(60):
        parts = sorted((s, s + 6, int(pick.integers(-5, 6)), 1) for s in pick.integers(10, 200, 25).tolist())
        score = []
        for i, (s, e, d, n) in enumerate(parts):
            gains = [score[j] - chains.GAP_COST * ((s - parts[j][1]) + (s - d - parts[j][1] + parts[j][2]))
                     for j in range(i) if parts[j][1] <= s and parts[j][1] - parts[j][2] <= s - d]
            score.append(n * chains.KMER + max([0.0, *gains]))
        best = chains.chains(parts)[0]
        value = chains.KMER * len(best) - chains.GAP_COST * sum(2 * (b[0] - a[1]) - b[2] + a[2] for a, b in zip(best, best[1:]))
        assert value == pytest.approx(max(score))


def test_language_is_learned_from_text(documents, words):
    rows = [(i, words(30, i).translate(str.maketrans("abc", "xyz")) if i % 2 else words(30, i), "aa" if i % 2 == 0 else "bb") for i in range(80)]
    model = language.train(documents(rows[:60] + [(900, "no label", None), (901, None, "aa")]))
    asked = rows[60:] + [(100, None, "aa"), (101, "", "aa"), (102, "123 !?", "aa")]
    found = {r.doc_id: r for r in language.identify(documents(asked), model).collect()}
    assert all(found[i].lang_pred == l and 0 < found[i].score <= 1 for i, _, l in rows[60:])
    assert all((found[i].lang_pred, found[i].score) == ("und", 0.0) for i in (100, 101, 102))
    empty = language.train(documents(rows).limit(0))
    assert {r.lang_pred for r in language.identify(documents(rows), empty).collect()} == {"und"}


def test_quality_follows_labels(spark, documents, words):
    rows = [(i, words(80, i) if i % 3 else " ".join(w + "!!" for w in words(80, i).upper().split()), "en") for i in range(240)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(180)] + [(999, 1, 0), (1, None, 0)], "doc_id bigint, quality int, toxic int")
    model = quality.train(documents(rows), labels)
    found = {r.doc_id: r.score for r in quality.score(documents(rows[180:] + [(300, None, None), (301, "", None)]), model).collect()}
    good, bad = [found[i] for i in range(180, 240) if i % 3], [found[i] for i in range(180, 240) if not i % 3]
    assert min(good) > max(bad) and found[300] == found[301] and all(0 <= x <= 1 for x in found.values())
    one_sided = quality.train(documents(rows), labels.filter("quality = 1"))
    assert {r.score for r in quality.score(documents(rows[:3]), one_sided).collect()} == {1.0}
    none = quality.train(documents(rows), labels.limit(0))
    assert {r.score for r in quality.score(documents(rows[:3]), none).collect()} == {0.5}


def test_the_query_returns_the_segmentations_that_it_draws(spark, documents, tmp_path):
    """Ids, not only their number and checksum: they decode to the text and add up to both."""
    rows = [(i, t, "en") for i, t in enumerate(["over  the top", None, "", "é\n字 x"])]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op7_pieces(spark, str(tmp_path)).collect()
    vocabulary = pieces.Vocabulary.of(public_tokenizers.path("piece_bpe_32k.model"))
    assert {r.doc_id for r in found} == {0, 1, 2, 3}
    for r in found:
        assert len(r.ids) == r.n_pieces and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        assert (vocabulary.decode(r.ids) if r.ids else "") == (rows[r.doc_id][1] or "") and r.round_trip
    assert {(r.doc_id, r.sample, tuple(r.ids)) for r in pieces.segmentations(documents(rows), public_tokenizers.path("piece_bpe_32k.model"), k=2)
            .withColumnRenamed("id", "doc_id").collect()} == {(r.doc_id, r.sample, tuple(r.ids)) for r in found}


def test_segmentations_are_distinct_and_decode(documents, corpus):
    rows = [r for r in corpus if r[0] != 41] + [(60, "  two  spaces ", "en"), (61, "日本 \t\U0001f600", "en")]
    found = pieces.segmentations(documents(rows), public_tokenizers.path("piece_bpe_32k.model"), k=3).collect()
    by = {}
    for r in found:
        by.setdefault(r.id, []).append(r)
    texts = {i: t or "" for i, t, _ in rows if i is not None}
    for i, text in texts.items():
        got = sorted(by[i], key=lambda r: r.sample)
        assert all(r.decoded == text for r in got) and len({tuple(r.ids) for r in got}) == len(got)
        assert all(a.perturbed > b.perturbed for a, b in zip(got, got[1:])) and all(0 <= r.inclusion <= 1 for r in got)
    assert len(by[31]) == 1 and by[31][0].inclusion == 1.0 and len(by[20]) == 3


@pytest.mark.parametrize("text", ["a  b", "  a", "x   ", "▁ y", "q▁  z"])
def test_pieces_of_several_spaces_are_drawn(text):
    """All segmentations of a text with runs of spaces, and their probabilities."""
    vocabulary = pieces.Vocabulary.of(public_tokenizers.path("piece_bpe_32k.model"))
    raw = (" " * vocabulary.prefix + text).replace(" ", "▁").encode()
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        model.ParseFromString(file.read())
    known = {p.piece.encode(): i for i, p in enumerate(model.pieces) if p.type in (1, 4)}
    want, todo = {}, [(0, ())]
    while todo:
        at, ids = todo.pop()
        if at == len(raw):
            want[ids] = sum(vocabulary.weight[i] for i in ids)
        todo += [(e, (*ids, known[raw[at:e]])) for e in range(at + 1, len(raw) + 1) if raw[at:e] in known]
    total = np.logaddexp.reduce(list(want.values()))
    (drawn,) = pieces.sample(vocabulary, [text], ["1"], len(want) + 5, 1)
    found = {tuple(x[0]): x[1] for x in drawn}
    assert any("▁▁" in model.pieces[i].piece for ids in want for i in ids)
    assert set(found) == set(want) and all(v == pytest.approx(want[k] - total) for k, v in found.items())


def test_many_new_cuts_take_few_calls_without_marks():
    """The bytes of the tokens tell where cuts end; a special token after each cut doubled the text that is encoded."""
    encoder = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    words = [f"{a}{b}" for a in ("über", "日本", "x1", "\U0001f600", "don't", "<|endoftext|>", "a\nb", "\u0301") for b in range(40)]
    want = [np.array(encoder._encode(t), "<u4").tobytes() for t in (" ".join(words), "a  " + words[0], "", " ".join(words[::-1]))]
    encode, sent = encoder._encode, []
    encoder._encode = lambda text: sent.append(text) or encode(text)
    assert encoder.encode([" ".join(words), "a  " + words[0], None, " ".join(words[::-1])]) == want
    assert sum(map(len, sent)) < 1.5 * len(" ".join(words)) and len(sent) < 8


def test_stretches_equal_all_pairs():
    """The longest stretch by all pairs of words, on one diagonal and on several."""

    def slow(p, q, least, percent, lo, hi):
        good = [
            (i - j, i)
            for i in range(lo, hi)
            for j in range(i, hi)
            if p[j] - p[i] + 1 >= least and all(100 * (j - i + 1) >= percent * (x[j] - x[i] + 1) for x in (p, q))
        ]
        if not good:
            return []
        size, i = min(good)
        return [*slow(p, q, least, percent, lo, i), (i, i - size), *slow(p, q, least, percent, i - size + 1, hi)]

    draw = np.random.default_rng(1)
    for turn in range(200):
        size, rate = int(draw.integers(0, 50)), draw.choice([0.1, 0.3, 0.6])
        steps = [1 + (draw.random(size) < rate) * draw.integers(0, 4, size) for _ in range(2)]
        p, q = np.cumsum(steps[0]), np.cumsum(steps[turn % 2]) + 5
        least, percent = int(draw.choice([5, 12])), int(draw.choice([60, 80, 100]))
        assert sorted(chains.stretches(p, q, least, percent)) == slow(p, q, least, percent, 0, size)


def test_a_text_of_eight_words_in_blocks_is_compared_fast():
    """Every shift of such a text is a chain with some agreement; each took the square of its words."""
    words = np.repeat(np.arange(1, 9, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), 648)
    begin = time.process_time()
    assert chains.compared(words, None, 50, 80) == [(1, 5184, 0, 5183, 5176)]
    assert time.process_time() - begin < 40


def test_the_trie_is_small_and_leads_to_every_piece():
    """Every worker of an executor holds its own; a row of all bytes for each node took 57 MB."""
    vocabulary = pieces.Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    assert sum(x.nbytes for x in vars(vocabulary).values() if isinstance(x, np.ndarray)) < 16e6
    for i in np.flatnonzero(vocabulary.weight)[::97].tolist():
        node = np.zeros(1, np.int32)
        for b in vocabulary.raw[i]:
            node = vocabulary.step(node, np.array([b], np.uint8))
        assert vocabulary.piece[node[0]] == i or i in vocabulary.byte
    ends = np.flatnonzero((vocabulary.row == 0) & (vocabulary.only < 0))
    assert not vocabulary.step(ends, np.zeros(len(ends), np.uint8)).any()


def test_samples_do_not_depend_on_the_batch(corpus):
    rows = [r for r in corpus if r[1]][:40]
    vocabulary = pieces.Vocabulary.of(public_tokenizers.path("piece_bpe_32k.model"))
    keys = [str(r[0]) for r in rows]
    whole = pieces.sample(vocabulary, [r[1] for r in rows], keys, 2, 0)
    for r, key, want in zip(rows, keys, whole):
        (found,) = pieces.sample(vocabulary, [r[1]], [key], 2, 0)
        assert [x[0].tolist() for x in found] == [x[0].tolist() for x in want]


def test_cuts_that_come_again_are_not_built_again(words, monkeypatch):
    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = [words(200, i) for i in range(6)] + [None, "", "  a é\u4e00  ", "x" * 300]
    keys = list(map(str, range(len(texts))))

    def drawn(vocabulary, at):
        return [(ids.tolist(), p) for some in at for found in pieces.sample(vocabulary, texts[some], keys[some], 3, 5) for ids, p, *_ in found]

    held = pieces.Vocabulary(path)
    first, edges = drawn(held, [slice(None)]), held.lattice.edges
    one_by_one = [slice(i, i + 1) for i in range(len(texts))]
    again = drawn(held, one_by_one)
    assert held.lattice.edges == edges > 0 and held.lattice.cuts == len(held.numbers)
    monkeypatch.setattr(pieces, "HELD_EDGES", 0)
    anew = drawn(held, one_by_one)
    assert held.lattice.edges < edges
    for other in (again, anew):
        assert [x for x, _ in other] == [x for x, _ in first] and np.allclose([p for _, p in other], [p for _, p in first])


def test_samples_follow_the_lattice_without_replacement():
    """First draws have the lattice's probabilities, and inverse inclusion scores are unbiased."""
    vocabulary = pieces.Vocabulary.of(public_tokenizers.path("piece_bpe_32k.model"))
    n = 4000
    drawn = pieces.sample(vocabulary, ["the on"] * n, [str(i) for i in range(n)], 2, 1)
    first = {}
    for (ids, log_p, *_), _ in drawn:
        count, _ = first.get(tuple(ids), (0, 0))
        first[tuple(ids)] = count + 1, np.exp(log_p)
    assert all(abs(count / n - p) < 4 * np.sqrt(p / n) + 1e-3 for count, p in first.values())
    assert np.mean([sum(np.exp(log_p) / q for _, log_p, _, q in r) for r in drawn]) == pytest.approx(1, abs=0.02)


def test_empty_tables(spark, documents):
    none = documents([]).limit(0)
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert minhash.near_duplicates(none).count() == suffixes.digest(none).count() == chains.passages(none).count() == 0
    assert tokens.read(spark, tokens.write(none, path)).count() == 0
    assert pieces.segmentations(none, public_tokenizers.path("piece_bpe_32k.model")).count() == 0
