"""Main text of web pages: a linear-chain conditional random field over leaf blocks, decoded by Viterbi.

A page becomes its leaf blocks in order. Each block has features of its ancestors (tags, words of class and id) and
of its text (length, links, punctuation). The field scores two labels, article and other, with weights for
features and for neighbouring labels. It is trained on labelled pages of two kinds: real pages whose own landmarks tell
the article from the rest, and pages composed from the real pages' texts in many layouts, where each block's label
is known because it was put there.

Character references are decoded, white space in a block becomes one space, and article blocks are joined by an empty line.

Defined cases: null or empty html, and pages without an article block, give an empty text; broken or cut-off markup
is closed where it ends; scripts, styles, templates and comments are never blocks; an empty table gives an empty
result; other columns pass through.
"""

from __future__ import annotations

import html as entities
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bound of the training sample: about so many pages, by hash, and so many composed ones.
SAMPLE_PAGES, COMPOSED_PAGES = 300, 500
_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)"
    r"|<(script|style)(?=[\s/>])[^>]*>.*?(?:</\1(?=[\s/>])[^>]*>|$)"
    r"|<svg(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+(?<=/)>"
    r"|<(?P<kind>noscript|template|textarea|select|svg|iframe|object)(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+>.*?</(?P=kind)(?=[\s/>])[^>]*>"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>?"
    r"|<[!?][^>]*>?",
    re.S | re.I,
)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
# fixed values: elements of HTML by their behaviour
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
_CLOSES = {  # an opening tag ends an open element of these kinds, up to the nearest of the others
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "body": ("head", "title"),
}
_SCOPES = frozenset("ul ol dl table tbody thead html body div section article".split())
# fixed values: stems of class and id words that name a part of a page
_STEMS = (
    "nav menu crumb header masthead head footer foot copyright side aside column widget related recommend notice cookie consent alert "
    "banner popup modal ad ads advert sponsor promo form search login subscri newsletter signup comment respond reply discuss disqus share "
    "social tag meta byline author date content article post entry story main body text page wrap container"
).split()


class Block:
    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: tuple, linked: float):
        self.text, self.path, self.linked = text, path, linked


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks of the whole page in order."""
    found: list[Block] = []
    stack: list[tuple[str, str]] = []
    pieces: list[str] = []
    links = 0

    def flush():
        nonlocal links
        text = " ".join(entities.unescape("".join(pieces)).split())
        if text:
            found.append(Block(text, tuple(stack), min(1.0, links / len(text))))
        pieces.clear()
        links = 0

    def close(depth: int):
        if any(tag not in _INLINE for tag, _ in stack[depth:]):
            flush()
        del stack[depth:]

    def say(text: str):
        nonlocal links
        pieces.append(text)
        if any(tag == "a" for tag, _ in stack):
            links += len(text.strip())

    page, at = page or "", 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            say(page[at : token.start()])
        at = token.end()
        tag = token[4]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _VOID:
            if tag == "hr":
                flush()
            pieces.append(" ")
        elif token[3]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    close(depth)
                    break
            else:
                if tag not in _INLINE:
                    flush()
        else:
            if tag not in _INLINE:
                flush()
                ends = _CLOSES.get(tag, ())
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] in ends or stack[depth][0] == "p":
                        close(depth)
                        if stack[depth - 1 :] and ends:
                            continue
                        break
                    if stack[depth][0] in _SCOPES and tag != "body":
                        break
            named = " ".join(a or b or c for a, b, c in _NAMED.findall(token[5])) if token[5] else ""
            stack.append((tag, named))
    if at < len(page):
        say(page[at:])
    flush()
    return found


def _path_features(path: tuple) -> list[str]:
    seen = {}
    for tag, named in path:
        if tag not in _INLINE:
            seen[f"in {tag}"] = None
        for word in _WORD.findall(named):
            word = word.lower()
            seen[f"named {word}"] = None
            for stem in _STEMS:
                if word == stem or len(stem) > 3 and word.startswith(stem):
                    seen[f"stem {stem}"] = None
    outer = [tag for tag, _ in path if tag not in _INLINE]
    seen[f"leaf {outer[-1] if outer else 'none'}"] = None
    seen[f"under {'>'.join(outer[-2:])}"] = None
    return ["always", *seen]


def _text_features(block: Block) -> list[str]:
    text = block.text
    return [
        f"chars {min(8, len(text).bit_length())}",
        f"words {min(7, text.count(' ').bit_length())}",
        f"linked {int(4 * block.linked)}",
        f"ends {text[-1] if text[-1] in '.!?:;,|' else 'other'}",
        f"sign {'©' in text or '|' in text or '»' in text}",
    ]


class Field:
    """Weights of the conditional random field; label 1 is article."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.weights = np.zeros(0)
        self.moves = np.zeros((2, 2))
        self.begin = 0.0
        self._paths: dict[tuple, list[int]] = {}

    def __getstate__(self):
        return {**self.__dict__, "_paths": {}}

    def rows(self, page: list[Block], learn: bool = False) -> list[list[int]]:
        found = []
        for block in page:
            path = self._paths.get(block.path)
            if path is None:
                if len(self._paths) > 50_000:
                    self._paths.clear()
                path = self._paths[block.path] = self._ids(_path_features(block.path), learn)
            found.append(path + self._ids(_text_features(block), learn))
        return found

    def _ids(self, names: list[str], learn: bool) -> list[int]:
        if learn:
            return [self.index.setdefault(n, len(self.index)) for n in names]
        return [self.index[n] for n in names if n in self.index]

    def _scores(self, pages: list[list[list[int]]]) -> tuple[np.ndarray, np.ndarray]:
        """Score of label 1 against label 0, padded to pages x blocks, and the pages' sizes."""
        sizes = np.array([len(p) for p in pages])
        scores = np.zeros((len(pages), max(1, sizes.max(initial=0))))
        for i, page in enumerate(pages):
            for j, row in enumerate(page):
                scores[i, j] = self.weights[row].sum()
        return scores, sizes

    def train(self, pages: list[list[Block]], labels: list[list[int]], rounds: int = 150, ridge: float = 1e-4) -> None:
        """Maximise the conditional likelihood by gradient steps with forward and backward sums."""
        rows = [self.rows(p, learn=True) for p in pages]
        flat = np.array([f for page in rows for row in page for f in row], np.int64)
        owner = np.repeat(np.arange(sum(map(len, rows))), [len(row) for page in rows for row in page])
        sizes = np.array([len(p) for p in rows])
        longest, count = sizes.max(), len(rows)
        page_of = np.repeat(np.arange(count), sizes)
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        truth = np.zeros((count, longest), np.int64)
        truth[page_of, place] = [l for page in labels for l in page]
        real = np.arange(longest) < sizes[:, None]
        parameters = np.zeros(len(self.index) + 5)
        first, second = np.zeros_like(parameters), np.zeros_like(parameters)
        pairs = real[:, 1:]
        seen = np.zeros((2, 2))
        np.add.at(seen, (truth[:, :-1][pairs], truth[:, 1:][pairs]), 1)
        for step in range(1, rounds + 1):
            weights, moves, begin = parameters[:-5], parameters[-5:-1].reshape(2, 2), parameters[-1]
            score = np.zeros((count, longest, 2))
            score[page_of, place, 1] = np.bincount(owner, weights[flat], minlength=len(page_of))
            ahead, back = np.zeros_like(score), np.zeros_like(score)
            ahead[:, 0] = score[:, 0] + [0, begin]
            for t in range(1, longest):
                ahead[:, t] = score[:, t] + np.logaddexp.reduce(ahead[:, t - 1, :, None] + moves, axis=1)
            total = np.logaddexp.reduce(ahead[np.arange(count), sizes - 1], axis=1)
            for t in range(longest - 2, -1, -1):
                some = np.logaddexp.reduce(moves + (score[:, t + 1] + back[:, t + 1])[:, None, :], axis=2)
                back[:, t] = np.where(real[:, t + 1, None], some, 0.0)
            chance = np.exp(ahead + back - total[:, None, None])
            both = np.exp(ahead[:, :-1, :, None] + moves + (score + back)[:, 1:, None, :] - total[:, None, None, None])
            miss = (truth - chance[:, :, 1])[page_of, place]
            slope = np.concatenate([
                np.bincount(flat, miss[owner], minlength=len(weights)),
                (seen - (both * pairs[:, :, None, None]).sum(axis=(0, 1))).ravel(),
                [(truth[:, 0] - chance[:, 0, 1]).sum()],
            ]) / len(page_of) - ridge * parameters
            first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
            parameters += 0.2 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        self.weights, self.moves, self.begin = parameters[:-5], parameters[-5:-1].reshape(2, 2), float(parameters[-1])

    def decode(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Most likely labels of each page."""
        scores, sizes = self._scores([self.rows(p) for p in pages])
        count, longest = scores.shape
        best = np.stack([np.zeros(count), scores[:, 0] + self.begin], axis=1)
        came = np.zeros((count, longest, 2), np.int8)
        for t in range(1, longest):
            reach = best[:, :, None] + self.moves
            came[:, t] = reach.argmax(axis=1)
            new = reach.max(axis=1)
            new[:, 1] += scores[:, t]
            best = np.where((t < sizes)[:, None], new, best)
        labels = np.zeros((count, longest), np.int8)
        label = best.argmax(axis=1)
        for t in range(longest - 1, -1, -1):
            label = np.where(t == sizes - 1, best.argmax(axis=1), label)
            labels[:, t] = label
            label = np.where((t < sizes) & (t > 0), came[np.arange(count), t, label], label)
        return [labels[i, :n] for i, n in enumerate(sizes)]


_OTHER_TAGS = frozenset("nav header footer aside form head title button".split())
_OTHER_STEMS = frozenset(_STEMS[: _STEMS.index("share")])


def landmarks(page: list[Block]) -> list[int] | None:
    """Labels of a page that marks its article itself, or None."""
    if not any(tag in ("article", "main") for b in page for tag, _ in b.path):
        return None
    found = []
    for block in page:
        tags = {tag for tag, _ in block.path}
        words = {w.lower() for _, named in block.path for w in _WORD.findall(named)}
        found.append(int(bool(tags & {"article", "main"}) and not tags & _OTHER_TAGS and not words & _OTHER_STEMS))
    return found


class _Composer:
    """Pages in made-up layouts from real texts; the first character of each block tells its label."""

    ARTICLE, OTHER = "", ""

    def __init__(self, long_texts: list[str], short_texts: list[str], seed: int):
        self.random, self.long, self.short = random.Random(seed), long_texts, short_texts

    def words(self, most: int) -> str:
        return " ".join(self.random.choice(self.long).split()[: self.random.randint(1, most)])

    def block(self, tag: str, label: str, text: str, inside: str = "{}") -> str:
        return f"<{tag}>" + inside.format(label + entities.escape(text)) + (f"</{tag}>" if self.random.random() < 0.95 else "")

    def box(self, choices: str, inner: str) -> str:
        opening = self.random.choice(choices.split(";"))
        tag = opening.split()[0]
        return f"<{opening}>{inner}</{tag}>"

    def paragraphs(self, label: str, least: int, most: int) -> str:
        out = []
        for _ in range(self.random.randint(least, most)):
            kind = self.random.random()
            if kind < 0.7:
                inside = "{}" if kind < 0.6 else '{} <a href="#">more</a>'
                out.append(self.block("p", label, self.random.choice(self.long), inside))
            elif kind < 0.8:
                out.append(self.block(self.random.choice(["h2", "h3"]), label, self.words(8)))
            elif kind < 0.87:
                out.append("<ul>" + "".join(self.block("li", label, self.words(12)) for _ in range(3)) + "</ul>")
            elif kind < 0.92:
                out.append(self.block(self.random.choice(["blockquote", "pre"]), label, self.random.choice(self.long)))
            elif kind < 0.96:
                out.append("<table><tr>" + "".join(self.block("td", label, self.words(5)) for _ in range(3)) + "</tr></table>")
            else:
                out.append(self.block("p", label, self.words(4)))
        return "".join(out)

    def links(self, tag: str) -> str:
        return "".join(self.block(tag, self.OTHER, self.random.choice(self.short), '<a href="/x">{}</a>') for _ in range(self.random.randint(2, 7)))

    def page(self) -> str:
        o, r = self.OTHER, self.random
        menu = lambda: self.box("nav;ul class=menu;div class='navbar top';div id=navigation;nav class=breadcrumbs;ul id=main-menu;div class=topnav", self.links("li"))
        head = lambda: self.box("header;div class=header;div id=masthead;header class=site-header;div class='page-header'", self.block(r.choice(["h1", "p", "div"]), o, self.words(6)))
        foot = lambda: self.box("footer;div class=footer;div id=footer;footer class=site-footer;div class='copyright'", self.block("p", o, r.choice(["© ", "&copy; ", ""]) + self.words(10)) + (self.links("span") if r.random() < 0.4 else ""))
        side = lambda: self.box("aside;div class=sidebar;div id=right-column;aside class=widget;div class='related-posts';section class=recommended", (self.block("h3", o, self.words(3)) + self.links("li") if r.random() < 0.6 else self.paragraphs(o, 1, 2)))
        note = lambda: self.box("div class=notice;div class=cookie-consent;div id=cookie-banner;div class='alert';div class=popup;section class=newsletter;div role=alert;aside class=notice", self.block(r.choice(["p", "div", "span"]), o, self.words(25)))
        ad = lambda: self.box("div class=ad;div class=advert;div class='ads';div id=ad-top;aside class=sponsored;div class=promo;ins class=ad;div class=advertisement", o + self.words(30))
        form = lambda: self.box("form;form class=search;form id=subscribe;div class=login-form;form action=/reply", self.block("label", o, self.words(3)) + "<input name=q>" + self.block("p", o, self.words(12)) + self.block("button", o, self.words(2)))
        said = lambda: self.box("div class=comments;section id=comments;ol class=comment-list;div class='reader-comments';div id=disqus_thread;section class=responses;section class=discussion", self.block("h3", o, self.words(2)) + "".join(self.box("div class=comment;li class=comment;article class=comment;div class=reply", self.block("p", o, r.choice(self.long))) for _ in range(r.randint(1, 4))))
        share = lambda: self.box("div class=share;ul class=social-links;div class=tags;div class='post-meta'", self.links("li"))
        some = lambda parts, chance: "".join(p() for p in parts if r.random() < chance)
        title = self.block("h1", self.ARTICLE, self.words(9)) if r.random() < 0.8 else ""
        text = title + self.paragraphs(self.ARTICLE, 1, 4) + some([ad, note, form], 0.25) + self.paragraphs(self.ARTICLE, 0, 8)
        body = self.box(
            "article;main;div class=content;div id=main-content;div class='post-body';div class=entry-content;section class=story;div class=article;"
            "td class=text;div class=x17;div;section;div id=b3;article class=post",
            text + some([share, said, side], 0.2),
        )
        if r.random() < 0.5:
            body = self.box("div class=container;div id=page;main;div class=wrap;div class=row;div", body + some([side, said], 0.3))
        before = some([menu, head, menu, note, ad, form], 0.5)
        after = some([side, said, share, ad, form, note], 0.4) + (foot() if r.random() < 0.9 else "")
        title = f"<head><title>{o}{self.words(8)}</title></head>"
        return f"<html>{title}<body>{before}{body}{after}</body></html>"

    def labelled(self) -> tuple[list[Block], list[int]]:
        page = blocks(self.page())
        labels = [int(b.text.startswith(self.ARTICLE)) for b in page]
        for b in page:
            b.text = b.text.replace(self.ARTICLE, "").replace(self.OTHER, "").strip() or "x"
        return page, labels


def train(pages: DataFrame, key: str = "page_id", html: str = "html") -> Field:
    """Learn from a bounded hash sample of the pages and from pages composed of their texts."""
    sample = pages.select(F.col(key).alias("k"), F.col(html).alias("h")).filter("h IS NOT NULL")
    count = sample.count()
    share = min(1.0, SAMPLE_PAGES / max(1, count))
    sample = sample.filter(F.pmod(F.xxhash64("k", F.lit(2)), F.lit(1 << 20)) < share * (1 << 20))
    read = [blocks(r.h) for r in sorted(sample.collect(), key=lambda r: (str(r.k), r.h))]
    known = [(p, landmarks(p)) for p in read if p]
    texts = sorted({b.text[:2000] for p in read for b in p})
    long_texts = [t for t in texts if len(t) > 60] or ["A sentence of plain words that says something, and then goes on to say more of it."]
    short_texts = [t for t in texts if len(t) <= 25] or ["Home", "About", "News"]
    composer = _Composer(long_texts, short_texts, seed=2)
    known = [(p, l) for p, l in known if l] + [composer.labelled() for _ in range(COMPOSED_PAGES)]
    field = Field()
    field.train([p for p, _ in known], [l for _, l in known])
    return field


def extract(pages: DataFrame, field: Field, html: str = "html", out: str = "text") -> DataFrame:
    """All rows and columns, with the main text; a column of that name is replaced."""
    pages = pages.drop(out)
    shared = pages.sparkSession.sparkContext.broadcast(field)  # a few thousand weights
    schema = T.StructType([*pages.schema, T.StructField(out, T.StringType())])

    def read(parts):
        for part in parts:
            texts = []
            column = part.column(html)
            for at in range(0, part.num_rows, 128):
                found = [blocks(h) for h in column.slice(at, 128).to_pylist()]
                for page, labels in zip(found, shared.value.decode(found)):
                    texts.append("\n\n".join(b.text for b, l in zip(page, labels) if l))
            yield part.append_column(out, pa.array(texts, pa.string()))

    return pages.mapInArrow(read, schema)
