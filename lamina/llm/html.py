"""Main text of web pages: a linear-chain conditional random field over a page's leaf blocks.

A page becomes the sequence of its blocks of text. Features of a block are the tags
around it, the words of their classes and ids, and properties of its text and
links. The field gives each block a state, article or not, with weights for features and
for neighbouring states; it is trained on labelled pages by gradient steps on the
log-likelihood (forward-backward) and decoded by Viterbi.

Labelled pages: a bounded sample of the given pages whose own markup says where the article is, and
a set of small pages made by rule here, in which containers of many names stand around
and inside articles. They teach the field names that the given pages may not have.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.texts import mix

#: Fixed: elements whose text is never shown as text of the page.
UNSEEN = frozenset("head title script style noscript template svg math iframe object canvas audio video select datalist textarea".split())
#: Fixed: elements that don't end a block.
INLINE = frozenset((
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark nobr picture q rp rt ruby s samp small "
    "source span strike strong sub sup time tt u var wbr").split())
#: Fixed: elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Fixed: elements that may stand in a head; any other ends an open one.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
#: Fixed: elements that end an open one of the same group.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
          "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
_BARRIER = frozenset("article aside body blockquote div dl fieldset figure footer form header html main nav ol section table ul".split())
_NAME = re.compile(r"[a-z]+")
_STOPS = frozenset(".!?…:;\"'”’»)")

Block = tuple[str, tuple[str, ...]]  # text, features


class _Reader(HTMLParser):
    """Cuts a page into blocks; unclosed and misplaced tags are taken as they come."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, frozenset[str]]] = []
        self.blocks: list[tuple[str, str, frozenset[str], int, int]] = []
        self.parts: list[str] = []
        self.linked = self.links = 0
        self.unseen = self.heads = 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                outer = [f for f in self.stack if f[0] not in INLINE]
                tag, around = outer[-1] if outer else ("", frozenset())
                self.blocks.append((text, tag, around, self.linked, self.links))
            self.parts = []
        self.linked = self.links = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.heads and tag not in IN_HEAD:
            self._end_head(tag == "body")
        if tag == "br":
            self.parts.append(" ")
        if tag not in INLINE:
            self.flush()
            if tag in CLOSES:
                self._close(CLOSES[tag])
            elif tag in _BARRIER or tag[:1] == "h" and tag[1:].isdigit():
                self._close({"p"})
        elif tag == "a":
            self.links += 1
        if tag in VOID:
            return
        around = self.stack[-1][1] if self.stack else frozenset()
        if tag not in INLINE:
            names = {f"in:{tag}"}
            for key, value in attrs:
                if key in ("class", "id", "role", "aria-label", "itemprop") and value:
                    names.update(f"name:{w}" for w in _NAME.findall(value.lower()) if len(w) > 1)
                elif key == "hidden" or key == "style" and value and "none" in value:
                    names.add("name:hidden")
            around = around | names
        self.stack.append((tag, around))
        self.unseen += tag in UNSEEN
        self.heads += tag == "head"

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _pop(self) -> None:
        tag = self.stack.pop()[0]
        self.unseen -= tag in UNSEEN
        self.heads -= tag == "head"

    def _close(self, tags: set[str]) -> None:
        """Ends open elements of these kinds up to the nearest container."""
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in tags:
                while len(self.stack) > i:
                    self._pop()
            elif self.stack[i][0] in _BARRIER:
                return

    def _end_head(self, always: bool = False) -> None:
        """Ends an open head with what is open in it; other tags than `body` may stand in some of its elements."""
        names = [t for t, _ in self.stack]
        inside = names[names.index("head") + 1:]
        if always or not any(t in ("noscript", "template", "title") for t in inside):
            while len(self.stack) > len(names) - len(inside) - 1:
                self._pop()

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                while len(self.stack) > i:
                    self._pop()
                return
            if tag in INLINE and self.stack[i][0] not in INLINE:
                return

    def handle_data(self, data: str) -> None:
        if not self.unseen:
            self.parts.append(data)
            if self.stack and any(t == "a" for t, _ in self.stack[-4:]):
                self.linked += len(data)


def _grade(value: float, steps: tuple[float, ...]) -> int:
    return sum(value >= s for s in steps)


def blocks(html: str | None) -> list[Block]:
    """Blocks of a page in order with their features; none for null."""
    if not html:
        return []
    reader = _Reader()
    reader.feed(html)
    reader.close()
    reader.flush()
    out, last = [], len(reader.blocks) - 1
    for k, (text, tag, around, linked, links) in enumerate(reader.blocks):
        words = text.count(" ") + 1
        size = len(text)
        found = [
            "bias", f"tag:{tag}", f"words:{_grade(words, (2, 4, 8, 16, 32, 64))}",
            f"linked:{_grade(linked / size, (0.05, 0.3, 0.7))}", f"stop:{text[-1] in _STOPS}",
            f"commas:{_grade(text.count(',') / words, (0.001, 0.05, 0.2))}", *around]
        if "©" in text[:200]:
            found.append("copyright")
        if k == 0:
            found.append("first")
        if k == last:
            found.append("last")
        out.append((text, tuple(found)))
    return out


@dataclass
class Field:
    """Weights of features by state, of neighbouring states, and of the first state."""

    weights: dict[str, tuple[float, float]] = field(default_factory=dict)
    moves: tuple[tuple[float, float], tuple[float, float]] = ((0.0, 0.0), (0.0, 0.0))
    begin: tuple[float, float] = (0.0, 0.0)

    def decode(self, page: list[Block]) -> list[int]:
        """Most probable states (Viterbi); ties go to article."""
        (m00, m01), (m10, m11) = self.moves
        get, back = self.weights.get, []
        a = b = 0.0
        for k, (_, names) in enumerate(page):
            e0 = e1 = 0.0
            for name in names:
                w = get(name)
                if w:
                    e0 += w[0]
                    e1 += w[1]
            if k == 0:
                a, b = self.begin[0] + e0, self.begin[1] + e1
                continue
            from0, from1 = (a + m00 > b + m10), (a + m01 > b + m11)
            back.append((from0, from1))
            a, b = (a + m00 if from0 else b + m10) + e0, (a + m01 if from1 else b + m11) + e1
        if not page:
            return []
        states = [int(b >= a)]
        for zero, one in reversed(back):
            states.append(0 if (one if states[-1] else zero) else 1)
        return states[::-1]


def fit(pages: list[tuple[list[tuple[str, ...]], list[int]]], rounds: int = 25, rate: float = 0.6, decay: float = 2e-3) -> Field:
    """Gradient ascent (AdaGrad) on the conditional log-likelihood of labelled block sequences."""
    names = sorted({n for page, _ in pages for features in page for n in features})
    number = {n: i for i, n in enumerate(names)}
    size = len(names)
    w, g = np.zeros((size + 3, 2)), np.full((size + 3, 2), 1e-6)  # the last three: moves from 0, from 1, begin
    coded = []
    for page, states in pages:
        if page:
            flat = np.array([number[n] for f in page for n in f])
            coded.append((flat, np.repeat(np.arange(len(page)), [len(f) for f in page]), np.array(states)))
    order = np.arange(len(coded))
    for round_ in range(rounds):
        order = order[np.argsort(mix(order.astype(np.uint64) + np.uint64(1000 * round_ + 1)), kind="stable")]
        for i in order.tolist():
            flat, at, states = coded[i]
            n = len(states)
            emit = np.zeros((n, 2))
            np.add.at(emit, at, w[flat])
            moves, begin = w[size: size + 2], w[size + 2]
            forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
            forward[0] = begin + emit[0]
            for t in range(1, n):
                forward[t] = np.logaddexp(forward[t - 1, 0] + moves[0], forward[t - 1, 1] + moves[1]) + emit[t]
            for t in range(n - 2, -1, -1):
                ahead = emit[t + 1] + backward[t + 1]
                backward[t] = np.logaddexp(moves[:, 0] + ahead[0], moves[:, 1] + ahead[1])
            whole = np.logaddexp(forward[-1, 0], forward[-1, 1])
            share = np.exp(forward + backward - whole)
            off = -share
            off[np.arange(n), states] += 1
            step = np.zeros_like(w)
            np.add.at(step, flat, off[at])
            if n > 1:
                pair = np.exp(forward[:-1, :, None] + moves[None] + (emit + backward)[1:, None, :] - whole)
                step[size: size + 2] -= pair.sum(axis=0)
                np.add.at(step, (size + states[:-1], states[1:]), 1)
            step[size + 2] = off[0]
            step -= decay * w * (step != 0)
            g += step * step
            w += rate * step / np.sqrt(g)
    return Field({n: (float(w[i, 0]), float(w[i, 1])) for n, i in number.items()},
                 tuple(tuple(map(float, r)) for r in w[size: size + 2]), tuple(map(float, w[size + 2])))


#: Fixed: names and elements that hold an article, and those that hold something else.
INSIDE = ("<article>", "<main>", '<div class="content">', '<div class="article-body">', '<div class="post entry">', '<div id="story">',
          '<section class="text">', '<div itemprop="articleBody">', '<div role="main">', "<div>")
OUTSIDE = (
    "nav menu navigation navbar breadcrumb breadcrumbs pagination toc sidebar side widget rail ad ads advert advertisement adslot banner promo "
    "promotion sponsor sponsored cookie cookies consent gdpr notice alert popup modal overlay hidden comment comments respond discussion replies "
    "disqus feedback footer foot copyright legal disclaimer header masthead topbar logo share sharing social follow related recommended trending "
    "popular more newsletter subscribe signup login register search form meta byline tags author bio skip utility toolbar tracking").split()
_MARK = "outside"  # on a made page's container; no feature
_OUTER = ("nav", "aside", "footer", "header", "form")


def _made_pages() -> list[tuple[list[tuple[str, ...]], list[int]]]:
    """Small labelled pages: an article, and around or inside it a container of each name."""
    long = "Words of a sentence that goes on for a while, with a comma or two, and then comes to its end. "
    out = []
    names = [*OUTSIDE, *(f"<{t}>" for t in _OUTER)]
    for k, (name, kind_of_text) in enumerate((n, j) for n in names for j in (0, 1, 2, 3, 0)):  # each with every kind of text
        opened = INSIDE[(k * 7 + k // len(INSIDE)) % len(INSIDE)]
        tag = opened[1:].split()[0].rstrip(">")
        other = (f'{name[:-1]} class="{_MARK}">' if name[0] == "<" else
                 f'<div class="{name} {_MARK}">' if k % 3 else f'<section id="{name}-{k}" class="{_MARK}">')
        kind = other[1:].split()[0].rstrip(">")
        inner = [f"<p>{long * (1 + k % 3)}</p>", f"<ul><li><a href='#'>{long[:8]}</a></li><li><a href='#'>{long[:12]}</a></li></ul>",
                 f"{long[: 20 + k % 40]}", f"<p>{long[:30]}</p><p>{long}</p>"][kind_of_text]
        box = f"{other}{inner}</{kind}>"
        body = f"<h1>{long[: 20 + k % 30]}</h1>" + "".join(f"<p>{long * (1 + (k + j) % 4)}</p>" for j in range(1 + k % 4)) + (
            f"<ul><li>{long}</li></ul>" if k % 5 == 0 else "") + (f"<p>{long[:9]}</p>" if k % 6 == 1 else "")
        page = [f"{box}{opened}{body}</{tag}>", f"{opened}{body}</{tag}>{box}", f"{opened}{body}{box}</{tag}>",
                f"{opened}{box}{body}</{tag}>"][(k // 3) % 4]
        if k % 7 == 3:
            page = f"<nav><ul><li><a href='#'>{long[:6]}</a></li></ul></nav>{page}<footer>&copy; {long[:30]}</footer>"
        found = [set(f) for _, f in blocks(f"<html><body>{page}</body></html>")]
        states = [int(not f & {f"name:{_MARK}", "in:nav", "in:footer"}) for f in found]
        out.append(([tuple(sorted(f - {f"name:{_MARK}"})) for f in found], states))
    return out


#: Fixed: containers that are no article text, also within an article's element.
_NOT_ARTICLE = frozenset(f"in:{t}" for t in _OUTER)


def _marked(page: list[Block]) -> list[int] | None:
    """States by a page's own markup, if it has an article element."""
    if not any("in:article" in f or "in:main" in f for _, f in page):
        return None
    never = {f"name:{n}" for n in OUTSIDE}
    return [int(("in:article" in f or "in:main" in f) and not _NOT_ARTICLE & set(f) and not never & set(f)) for _, f in page]


def train(pages: DataFrame, sample: int = 150, longest: int = 100_000) -> Field:
    """Fit on made pages and on at most `sample` of the given ones, of at most `longest` characters, chosen by hash."""
    rows = (pages.where(f"html is not null and length(html) <= {int(longest)}")
            .select("html", F.xxhash64("html").alias("place")).dropDuplicates(["place"]).orderBy("place").limit(sample).collect())
    labelled = _made_pages()
    for row in rows:
        page = blocks(row["html"])
        states = _marked(page)
        if states is not None and len(page) <= 500:
            labelled.append(([f for _, f in page], states))
    return fit(labelled)


def extract(pages: DataFrame, model: Field, columns: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """`columns`, `text` (article blocks joined by a blank line), `n_chars`, `n_blocks` for every page.

    References are decoded, white space in a block is one blank. Null, empty and
    textless pages give an empty text.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for low in range(0, batch.num_rows, 200):
                part = batch.slice(low, 200)
                texts, counts = [], []
                for html in part.column("html"):
                    page = blocks(html.as_py())
                    kept = [t for (t, _), s in zip(page, own.decode(page), strict=True) if s]
                    texts.append("\n\n".join(kept))
                    counts.append(len(kept))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in columns), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64()), pa.array(counts, pa.int64())],
                    [*columns, "text", "n_chars", "n_blocks"])

    kinds = dict(pages.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", text string, n_chars long, n_blocks long"
    return pages.select(*columns, F.col("html").cast("string").alias("html")).mapInArrow(run, schema)
