from __future__ import annotations

import math

import numpy as np
import pytest

from tidelake.llm import caps, pages


def test_blocks_survive_broken_markup():
    html = "<!DOCTYPE html><body><script>var a='</p>';</script><nav><li><a href='x'>Menu</a></nav><p>One &amp; <b>two<br>three<p>Four\n five<!-- x --><div class=\"a'b\">Six</di"
    assert [b.text for b in pages.blocks(html)] == ["Menu", "One & two three", "Four five", "Six"]
    assert [b.text for b in pages.blocks("a < b &am <")] == ["a < b &am <"]
    assert pages.blocks(None) == pages.blocks("") == pages.blocks("<script>x") == []


@pytest.mark.parametrize(
    "middle, said",
    [('<svg class="i"/>', []), ('<svg-icon name="x"></svg-icon>', []), ("<svg viewBox='0'><title>no</title></svg>", []), ("<iframe src=x>", []),
     ("<object-view/>", []), ("<script>a<b</script >", []), ("<script-x></script-x>", []), ("<select><option>no</select>", []), ('<svg d="a>b"><text>no</text></svg>', [])],
)
def test_text_goes_on_behind_skipped_elements(middle, said):
    assert [b.text for b in pages.blocks(f"<p>One</p>{middle}<p>Two</p><p>Three</p>")] == ["One", *said, "Two", "Three"]


def test_main_text_of_unseen_layouts(spark):
    prose = [f"Sentence number {i} of the article tells something, and it goes on for a good while longer." for i in range(12)]
    article = "".join(f"<p>{p}</p>" for p in prose[:4])
    rows = [
        (i, f"http://x/{i}", f"<html><head><title>T</title></head><body><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>"
         f"<div class=ad>{prose[5 + i % 6]}</div><article><h1>Title {i}</h1>{article}</article><footer>&copy; all rights</footer></body></html>")
        for i in range(40)
    ]
    other = (
        "<body><div id=masthead><h1>Site</h1></div><ul class=menu><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul>"
        f"<div class=content>{article}</div><div class=sidebar><h3>More</h3><li><a href=/q>Read this</a></li></div>"
        f"<section class=comments><h3>Comments</h3><div class=comment><p>{prose[7]}</p></div></section>"
        "<div class=cookie-notice><p>We use cookies to make this site work as it should.</p></div><form><label>Mail</label></form>"
        "<div class=footer><p>&copy; 2020 Site</p></div></body>"
    )
    rows += [(100, None, None), (101, "u", ""), (102, "u", other)]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r.page_id: r for r in pages.extract(table, pages.train(table)).collect()}
    assert all(found[i].text == "\n\n".join([f"Title {i}", *prose[:4]]) for i in range(40))
    assert found[100].text == found[101].text == ""
    assert found[102].text == "\n\n".join(prose[:4])
    assert pages.extract(table.limit(0), pages.train(table.limit(0))).count() == 0


def test_viterbi_equals_all_labellings():
    pick = np.random.default_rng(1)
    field = pages.Field()
    field.index = {"a": 0, "b": 1}
    field.moves, field.begin = pick.normal(size=(2, 2)), 0.3
    page = [pages.Block("x", (), 0.0) for _ in range(7)]
    weights = pick.normal(size=(7,))
    field.rows = lambda blocks, learn=False: [[i] for i in range(len(blocks))]
    field.weights = weights

    def value(labels):
        moves = sum(field.moves[a, b] for a, b in zip(labels, labels[1:]))
        return sum(w for w, l in zip(weights, labels) if l) + moves + field.begin * labels[0]

    best = max(((n >> np.arange(7)) & 1 for n in range(128)), key=lambda l: value(l.tolist()))
    assert field.decode([page])[0].tolist() == best.tolist()


@pytest.mark.parametrize("length", [64, 10])
def test_vector_links_equal_brute_force(spark, length):
    pick = np.random.default_rng(length)
    base = pick.normal(size=(60, length))
    near = np.repeat(base[:20], 4, axis=0) + pick.normal(size=(80, length)) * 0.1
    vectors = [*base.astype(np.float32).tolist(), *near.astype(np.float32).tolist(), *base[:3].astype(np.float32).tolist()]
    vectors += [(base[3] * 2.5).astype(np.float32).tolist()] * 40
    rows = [(i, v, i % 2 if i % 7 else None) for i, v in enumerate(vectors)]
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [0.0] * length, 1), (n + 2, [1.0, None] + [0.0] * (length - 2), 1), (n + 3, [math.inf] * length, 1), (n + 4, [], 1), (n + 5, [1.0, 2.0], 1), (n + 6, [1.0, 2.0], 1)]
    found = {r.id: r for r in caps.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")).collect()}
    good = [(i, np.array(v, float), l) for i, v, l in rows if v and l is not None and None not in v and np.isfinite(v).all() and any(v)]
    links = {i: set() for i, *_ in rows}
    for i, v, l in good:
        for j, w, m in good:
            if i != j and l == m and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.98:
                links[i].add(j)
    assert len(found) == len(rows) and sum(map(len, links.values())) > 300
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            todo += [x for x in links[todo.pop()] if x not in seen and not seen.add(x)]
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (len(links[i]), min(seen), i == min(seen))


def test_large_cells_are_split(spark, monkeypatch):
    monkeypatch.setattr(caps, "BLOCK", 8)
    pick = np.random.default_rng(3)
    base = pick.normal(size=64)
    rows = [(i, (base + pick.normal(size=64) * 0.02).tolist(), 1) for i in range(60)]
    found = caps.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()
    assert {r.n_links for r in found} == {59} and {r.component_id for r in found} == {0}
