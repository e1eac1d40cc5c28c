"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is read as the sequence of its leaf blocks: runs of text between the
starts and ends of block elements, with the tags and class words of all
ancestors. Each block has features of its ancestors and of its text; the field
scores every block and every pair of neighbouring labels, and Viterbi decoding
picks the best labelling of the page. Blocks labelled 1 are the main text.

Training maximises the likelihood of labelled pages. Which blocks of a page
are main text is told by a rule given as parameter; the default takes pages
that mark their text with ``article`` or ``main``. As such pages share a
layout, each is also set again in random other layouts (other containers and
class words; headers, menus, side bars, notices, adverts, forms and reader
comments filled with texts of other pages), so that the field learns what these
look like. The pages are a bounded hash sample; training runs on the driver,
extraction is one pass over the pages without a shuffle.
"""

from __future__ import annotations

import html
import itertools
import random
import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlens.llm.sampling import drawn

SAMPLE = 250  # pages that train the field
LAYOUTS = 3  # random layouts of each

# HTML's element kinds.
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset("script style template title".split())  # what no page shows; of anything else the field decides


class Block(NamedTuple):
    text: str
    tags: tuple[str, ...]  # ancestors, outermost first
    words: tuple[tuple[str, ...], ...]  # class, id and role words of each ancestor
    linked: float  # share of the characters that lie in links


def _class_words(attributes: list[tuple[str, str | None]]) -> tuple[str, ...]:
    out = []
    for name, value in attributes:
        if name in ("class", "id", "role", "itemprop") and value:
            out += re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower())
    return tuple(dict.fromkeys(out))


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, tuple[str, ...]]] = []
        self.silent = self.links = 0
        self.parts: list[tuple[str, bool]] = []
        self.blocks: list[Block] = []

    def flush(self) -> None:
        text = " ".join("".join(p for p, _ in self.parts).split())
        if text:
            size = sum(len(p) for p, _ in self.parts)
            tags = [(t, w) for t, w in self.stack]
            self.blocks.append(Block(text, tuple(t for t, _ in tags), tuple(w for _, w in tags), sum(len(p) for p, link in self.parts if link) / size))
        self.parts = []

    def _pop(self, to: int) -> None:
        for tag, _ in self.stack[to:]:
            self.silent -= tag in _SILENT
            self.links -= tag == "a"
        del self.stack[to:]

    def handle_starttag(self, tag: str, attributes: list[tuple[str, str | None]], closed: bool = False) -> None:
        if tag in _BLOCKS:
            self.flush()
            for at in range(len(self.stack) - 1, -1, -1):  # a new block ends an open paragraph
                if self.stack[at][0] == "p":
                    self._pop(at)
                    break
                if self.stack[at][0] in _BLOCKS:
                    break
        if tag == "br":
            self.parts.append((" ", False))
        if tag not in _VOID and not closed:
            self.stack.append((tag, _class_words(attributes)))
            self.silent += tag in _SILENT
            self.links += tag == "a"

    def handle_startendtag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attributes, closed=True)  # nothing lies inside it

    def handle_endtag(self, tag: str) -> None:
        if tag in _BLOCKS:
            self.flush()
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == tag:
                self._pop(at)
                break

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.parts.append((data, self.links > 0))


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page, in order; broken or cut markup is read as far as it goes."""
    reader = _Reader()
    reader.feed(page or "")
    reader.close()
    reader.flush()
    return reader.blocks


def features(block: Block) -> list[str]:
    """Names of the features that a block has."""
    text, tags = block.text, block.tags
    words = text.split(" ")
    out = [f"in {t}" for t in set(tags)] + [f"leaf {tags[-1]}" if tags else "leaf"]
    out += [f"word {w}" for w in {w for own in block.words for w in own}]
    out += [f"{t} {w}" for t, own in zip(tags, block.words) for w in own]
    out.append(f"words {min(9, len(words).bit_length())}")
    out.append(f"linked {0 if block.linked == 0 else 1 + int(3 * block.linked)}")
    out.append(f"stops {min(3, sum(text.count(c) for c in '.?!;'))}")
    out.append(f"end {text[-1] if text[-1] in '.!?:' else 'other'}")
    if any(c in text for c in "©|»·"):
        out.append("sign")
    if text.isupper():
        out.append("upper")
    return out


_OUTSIDE = frozenset("nav aside footer header form".split())
_OUTSIDE_WORDS = frozenset("ad ads advert comment comments cookie footer menu nav notice promo related share sidebar sponsored".split())


def marked_main(block: Block) -> bool:
    """Whether a page's own markup puts a block into its text: inside ``article`` or ``main``, not in what surrounds it."""
    if not {"article", "main"} & set(block.tags):
        return False
    return not (_OUTSIDE & set(block.tags)) and not (_OUTSIDE_WORDS & {w for own in block.words for w in own})


# Class words for random layouts: containers of the text, then kinds of surroundings.
_MAIN = ["article", "main", "div.content", "div#content", "div.post-content", "div.entry-content", "section.article-body", "div.story", "div#main", "div.text", "main#main-content",
         "div.article", "section.post", "div.body-text", "article.post", "article.entry", "div.page-content", "div#article-text"]
_AROUND = {
    "header": ["header", "div.header", "div#header", "header.site-header", "div.masthead", "div.top-bar", "header#banner"],
    "menu": ["nav", "div.nav", "ul.menu", "div#menu", "nav.navigation", "div.breadcrumb", "div.breadcrumbs", "div.navbar", "ul.links", "nav.toc", "div.pagination", "div.tags"],
    "side": ["aside", "div.sidebar", "div#sidebar", "aside.widget", "div.widget", "div.related", "section.related-posts", "div.recommended", "div.popular", "div.author-bio", "div.trending"],
    "notice": ["div.notice", "div.cookie-notice", "div#cookie-banner", "div.alert", "div.banner", "div.consent", "div.gdpr", "div.popup", "div.modal", "div.paywall", "div.message", "div.disclaimer"],
    "advert": ["div.ad", "div.ads", "div.advert", "div.advertisement", "div.sponsored", "div.promo", "aside.ad", "div#ad-top", "div.promotion", "section.sponsor"],
    "form": ["form", "form.search", "div.newsletter", "form.subscribe", "div.signup", "form#login", "form.contact", "div.search-form"],
    "share": ["div.share", "div.social", "ul.social-links", "div.share-buttons"],
    "comments": ["section.comments", "div#comments", "div.comment-list", "ol.comments", "section#discussion", "div.replies", "div.responses", "div#disqus", "div.reader-comments"],
    "footer": ["footer", "div.footer", "div#footer", "footer.site-footer", "div.copyright", "div.legal", "div.colophon"],
}
_COMMENT = ["article.comment", "div.comment", "li.comment", "div.reply", "li", "div.comment-body", "blockquote.comment"]


def _wrap(kind: str, inner: str) -> str:
    tag, mark, word = re.fullmatch(r"(\w+)([.#]?)(.*)", kind).groups()
    attribute = f' class="{word}"' if mark == "." else f' id="{word}"' if mark else ""
    return f"<{tag}{attribute}>{inner}</{tag}>"


def relaid(rng: random.Random, text: list[str], other: list[str]) -> tuple[str, list[str]]:
    """A page of ``text`` in a random layout, surrounded by strings of ``other``; and the blocks that are its text."""
    esc = html.escape
    short = lambda: esc(" ".join(rng.choice(other).split()[: rng.randint(1, 5)]))
    long = lambda: esc(" ".join(rng.choice(other).split()[: rng.randint(5, 80)]))

    def around(kind: str) -> str:
        if kind in ("menu", "share"):
            inner = "".join(rng.choice(["<li><a href='#'>{}</a></li>", "<a href='#'>{}</a>"]).format(short()) for _ in range(rng.randint(2, 7)))
            inner = f"<ul>{inner}</ul>" if rng.random() < 0.5 else inner
        elif kind == "comments":
            one = rng.choice(_COMMENT)
            inner = (f"<h3>{short()}</h3>" if rng.random() < 0.6 else "") + "".join(
                _wrap(one, (f"<span class='user'>{short()}</span>" if rng.random() < 0.5 else "") + rng.choice(["<p>{}</p>", "{}", "<div>{}</div>"]).format(long())) for _ in range(rng.randint(1, 5)))
        elif kind == "form":
            inner = rng.choice(["<label>{}</label><input name='q'><button>{}</button>", "<p>{}</p><label>{}</label><input>", "<h4>{}</h4><p>{}</p><input type='submit'>"]).format(short(), long())
        elif kind in ("side", "header", "footer"):
            inner = "".join(rng.choice(["<h3>{}</h3>", "<p>{}</p>", "<li><a href='#'>{}</a></li>", "<div>{}</div>", "{}"]).format(rng.choice([short, long])()) for _ in range(rng.randint(1, 5)))
        else:
            inner = rng.choice(["{}", "<p>{}</p>", "<div>{}</div>", "<p>{}</p><a href='#'>" + short() + "</a>"]).format(rng.choice([short, long])())
        return _wrap(rng.choice(_AROUND[kind]), inner)

    body, kept = [], []
    for i, block in enumerate(text):
        tag = "h1" if i == 0 and rng.random() < 0.5 else rng.choices(["p", "h2", "li", "blockquote", "div"], [30, 1, 1, 1, 2])[0]
        body.append(f"<{tag}>{esc(block)}</{tag}>")
        kept.append(block)
        if rng.random() < 0.08:
            body.append(around(rng.choice(["advert", "side", "share", "form", "notice"])))
    container = rng.choice(_MAIN)
    main = _wrap(container, "".join(body))
    if rng.random() < 0.3:
        main = _wrap(rng.choice(["div.container", "div.wrapper", "div.row", "main", "section", "div#page"]), main)
    before = [around(k) for k in ("header", "menu", "notice", "advert", "form", "side") if rng.random() < 0.5]
    after = [around(k) for k in ("share", "comments", "side", "advert", "form", "notice", "menu", "footer") if rng.random() < 0.5]
    rng.shuffle(before)
    page = "".join(before) + main + "".join(after)
    return f"<html><head><title>{short()}</title></head><body>{page}</body></html>", kept


class Field(NamedTuple):
    """Weights: of each feature (for label 1), of neighbouring labels, of the first block's label."""

    index: dict[str, int]
    weight: np.ndarray
    bias: float
    pair: np.ndarray  # 2 x 2
    first: np.ndarray  # 2


def fit(pages: list[tuple[list[Block], list[int]]], *, steps: int = 150, rate: float = 0.1, decay: float = 1e-3, least: int = 3) -> Field:
    """Maximum likelihood by Adam; gradients from forward-backward sums over all labellings."""
    pages = [p for p in pages if p[0]]
    named = [[features(b) for b in page] for page, _ in pages]
    count: dict[str, int] = {}
    for page in named:
        for own in page:
            for f in own:
                count[f] = count.get(f, 0) + 1
    index = {f: i for i, f in enumerate(sorted(f for f, n in count.items() if n >= least))}
    if not pages:
        return Field({}, np.zeros(0), 0.0, np.zeros((2, 2)), np.zeros(2))
    sizes = np.array([len(p) for p in named])
    x = np.zeros((sizes.sum(), len(index) + 1), dtype=np.float32)
    x[:, -1] = 1
    for row, own in enumerate(f for page in named for f in page):
        x[row, [index[f] for f in own if f in index]] = 1
    many, length = len(pages), sizes.max()
    where = np.arange(length) < sizes[:, None]
    y = np.zeros((many, length), dtype=np.int64)
    y[where] = [v for _, labels in pages for v in labels]
    gold_pair = np.zeros((2, 2))
    both = where[:, 1:]
    np.add.at(gold_pair, (y[:, :-1][both], y[:, 1:][both]), 1)
    gold_first = np.bincount(y[:, 0], minlength=2)
    weights = [np.zeros(x.shape[1]), np.zeros((2, 2)), np.zeros(2)]
    moment, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    log_sum = lambda a, axis: np.logaddexp.reduce(a, axis=axis)
    for step in range(1, steps + 1):
        w, pair, first = weights
        emit = np.zeros((many, length, 2))
        emit[where, 1] = x @ w
        alpha, beta = np.zeros((many, length, 2)), np.zeros((many, length, 2))
        alpha[:, 0] = first + emit[:, 0]
        for t in range(1, length):
            new = emit[:, t] + log_sum(alpha[:, t - 1, :, None] + pair, 1)
            alpha[:, t] = np.where(where[:, t, None], new, alpha[:, t - 1])
        total = log_sum(alpha[:, -1], 1)
        for t in range(length - 2, -1, -1):
            new = log_sum(pair + (emit[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(where[:, t + 1, None], new, 0)
        prob = np.exp(alpha + beta - total[:, None, None])
        joint = alpha[:, :-1, :, None] + pair + (emit + beta)[:, 1:, None, :] - total[:, None, None, None]
        grads = [
            x.T @ (prob[..., 1] - y)[where].astype(np.float32) / many + decay * w,
            (np.exp(joint[both]).sum(0) - gold_pair) / many,
            (prob[:, 0].sum(0) - gold_first) / many,
        ]
        for i, g in enumerate(grads):
            moment[i] = 0.9 * moment[i] + 0.1 * g
            square[i] = 0.99 * square[i] + 0.01 * g * g
            weights[i] = weights[i] - rate * (moment[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.99**step)) + 1e-8)
    return Field(index, weights[0][:-1], float(weights[0][-1]), weights[1], weights[2])


def decode(field: Field, page: list[Block]) -> list[int]:
    """The best labelling of a page's blocks (Viterbi; of equals the one with more 1s, from the end)."""
    if not page:
        return []
    weight, index = field.weight.tolist(), field.index
    (p00, p01), (p10, p11) = field.pair.tolist()
    emit = [field.bias + sum(weight[index[f]] for f in features(b) if f in index) for b in page]
    zero, one, back = float(field.first[0]), float(field.first[1]) + emit[0], []
    for e in emit[1:]:
        z = (zero + p00, one + p10)
        o = (zero + p01, one + p11)
        back.append((int(z[1] >= z[0]), int(o[1] >= o[0])))
        zero, one = max(z), max(o) + e
    labels = [int(one >= zero)]
    for choice in reversed(back):
        labels.append(choice[labels[-1]])
    return labels[::-1]


def train(pages: DataFrame, *, key: str = "page_id", html_column: str = "html", main: Callable[[Block], bool] = marked_main,
          sample: int = SAMPLE, layouts: int = LAYOUTS, seed: int = 5) -> Field:
    """A field from about ``sample`` pages (at most twice as many), as they are and in random layouts.

    Pages are drawn by a hash of id and page, equal rows count once, and only
    drawn pages leave their task. Pages without a block that ``main`` takes teach
    nothing. Without any page the field takes every block.
    """
    known = pages.where(F.col(html_column).isNotNull()).select(F.col(key).cast("string").alias("k"), F.xxhash64(html_column).alias("hh"), F.col(html_column).alias("h"))
    rows = drawn(known, pages.count(), sample, "pages", "k", "hh", limit=False).dropDuplicates(["k", "hh"]).limit(2 * sample).collect()
    rows.sort(key=lambda r: (r["hh"], r["k"] or ""))
    read = [(page, [int(main(b)) for b in page]) for page in (blocks(r["h"]) for r in rows)]
    read = [p for p in read if any(p[1])]
    other = [b.text for page, _ in read for b in page] or ["-"]
    rng, examples = random.Random(seed), list(read)
    for page, labels in read:
        text = [b.text for b, y in zip(page, labels) if y]
        for _ in range(layouts):
            laid, kept = relaid(rng, text, other)
            own, at, marks = blocks(laid), 0, []
            for b in own:
                hit = at < len(kept) and b.text == kept[at]
                marks.append(int(hit))
                at += hit
            if at == len(kept):
                examples.append((own, marks))
    return fit(examples)


def extract(pages: DataFrame, field: Field, *, html_column: str = "html") -> DataFrame:
    """All columns of ``pages`` but the html, then ``text``, ``n_blocks`` and ``n_kept`` (existing ones are replaced).

    ``text`` is the blocks of the main text joined by two line ends, each block's
    white space turned into single spaces; it is empty for null, empty or
    blockless pages and where no block is main text. Rows are read each by
    itself: equal rows give equal results. Other columns may have any name.
    """
    names = [c for c in pages.columns if c not in (html_column, "text", "n_blocks", "n_kept")]
    page_column = next(n for i in itertools.count() if (n := f"_html{i}") not in names)
    source = pages.select(*names, F.col(html_column).alias(page_column))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_blocks, n_kept = [], [], []
            for page in batch.column(page_column):
                own = blocks(page.as_py())
                kept = [b.text for b, y in zip(own, decode(field, own)) if y]
                texts.append("\n\n".join(kept))
                n_blocks.append(len(own))
                n_kept.append(len(kept))
            more = [pa.array(texts, pa.string()), pa.array(n_blocks, pa.int64()), pa.array(n_kept, pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *more], [*names, "text", "n_blocks", "n_kept"])

    schema = T.StructType(source.select(*names).schema.fields[:]).add("text", T.StringType()).add("n_blocks", T.LongType()).add("n_kept", T.LongType())
    return source.mapInArrow(make, schema)
