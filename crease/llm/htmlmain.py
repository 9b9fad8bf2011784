"""Main text of web pages: a linear-chain conditional random field over the leaf
blocks of the page, trained on labelled pages and decoded by Viterbi.

A page is read as its leaf blocks in order.  A block's features are its own tag,
the tags and class/id words of its ancestors and a few traits of its text; the
chain's two labels are content and furniture.

Labelled pages come from the table itself: in a bounded sample, pages that mark
their article (``article``, ``main``, ``itemprop=articleBody``) label their own
blocks.  Each is also re-dressed: the same texts under other tags and class
names, with more furniture, so that the field does not hang on one template.
"""

from __future__ import annotations

import html as htmllib
import random
import re
from collections import Counter
from collections.abc import Container, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from crease.llm.common import bounded_sample, frugal, small_batches

#: Pages of the training sample, and the length up to which a page may be in it.
SAMPLE, SAMPLE_CHARS = 150, 60_000

_TOKEN = re.compile(r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_MARKS = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PARTS = re.compile(r"[a-z]+")
_INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike "
                    "strong sub sup time tt u var br wbr img param".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their text ends at their own end tag or with the page, whatever stands in it.
_RAW = frozenset("script style template textarea iframe".split())
_CONTROLS = frozenset("select button option optgroup".split())
#: Stand within a line as the inline tags do, but are features of their block.
_EMBEDDED = frozenset("math svg object noscript".split())
_FOREIGN = frozenset(["math", "svg"])
#: End the line within math and svg too; any other tag in them is theirs.
_BREAKS = frozenset("address article aside blockquote body center dd div dl dt fieldset figcaption figure footer form h1 h2 h3 "
                    "h4 h5 h6 head header hr li main nav ol p pre section table tbody td th thead tr ul".split())
_REGIONS = frozenset("article main section nav header footer aside form".split())
_UNSEEN = frozenset(["head", "title"])


class Block:
    __slots__ = ("text", "tags", "marks", "near", "links")

    def __init__(self, text, tags, marks, near, links):
        self.text, self.tags, self.marks, self.near, self.links = text, tags, marks, near, links


def _end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I)


def _edge(tag: str) -> re.Pattern:
    """Next end or start of the tag."""
    return re.compile(rf"<(/?){tag}\b[^>]*(?:>|\Z)", re.I)


def blocks(page: str, known: Container[str] | None = None) -> list[Block]:
    """Leaf blocks in page order: text with white space collapsed, the distinct
    tags (its own last) and class/id words above it, those (or the tag) of the
    innermost region, and the share of its characters in links.

    With ``known``, the names of the features that have weights, other tags and
    words above a block are left out.  Counts of open tags and words are kept as
    tags open and close, so a page of any depth takes time in proportion to its
    length.

    Text of scripts, styles, controls and comments never counts; of a control
    that is not closed only what stands right in it.  Math, drawings, objects and
    ``noscript`` are text like any other.  Open tags are closed by their
    ancestors' ends and the page's end; a ``p`` ends where the next block starts;
    a tag cut off by the page's end is dropped.
    """
    out: list[Block] = []
    # open elements: tag, class/id words, the block's own tag and the region's marks up to here
    stack: list[tuple[str, tuple, str, tuple]] = []
    open_: Counter[str] = Counter()
    above: dict[str, int] = {}  # open tags that are features, and words, with their numbers
    words_above: dict[str, int] = {}
    buffer: list[str] = []
    held: list[str] = []  # embedded tags of the line
    linked, links, foreign, at, size = 0, 0, 0, 0, len(page)

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = " ".join(htmllib.unescape("".join(buffer)).split())
            own = stack[-1][2] if stack else ""
            if text and not any(open_[t] for t in _UNSEEN) and own not in _CONTROLS:
                lines = [t for t in dict.fromkeys(held) if not open_[t]]
                tags = (*lines, *(t for t in above if t != own), *([own] if own else []))
                out.append(Block(text, tags, tuple(words_above), stack[-1][3] if stack else (), linked / max(1, len(text))))
            buffer.clear()
        held.clear()
        linked = 0

    def close(tag: str) -> None:
        nonlocal links, foreign
        while stack:
            top, marks, *_ = stack.pop()
            open_[top] -= 1
            for held_by, names in ((above, [top]), (words_above, marks)):
                for name in names:
                    if name in held_by:
                        held_by[name] -= 1
                        if not held_by[name]:
                            del held_by[name]
            links -= top == "a"
            foreign -= top in _FOREIGN
            if top == tag:
                break

    while at < size:
        m = _TOKEN.search(page, at)
        text = page[at:m.start() if m else size]
        if text:
            buffer.append(text)
            linked += len(text) if links else 0
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag == "br":
            buffer.append(" ")
        inline = tag in _INLINE or tag in _EMBEDDED or (foreign > 0 and tag not in _BREAKS)
        if m[1]:
            if open_[tag]:
                if not inline:
                    flush()
                close(tag)
            continue
        if tag in _RAW:
            end = _end(tag).search(page, at)
            at = end.end() if end else size
            continue
        if tag == "select" or tag == "button" or (foreign and tag == "title"):  # none holds another of its kind
            end = _edge(tag).search(page, at)
            if end and end[1]:
                at = end.end()
                continue
        if not inline:
            flush()
            if open_["p"]:
                close("p")
        if tag in _EMBEDDED:
            held.append(tag)
        elif foreign and tag == "text":  # labels of a drawing stand apart
            buffer.append(" ")
        if tag in _VOID or m[3].endswith("/"):
            continue
        words = _PARTS.findall(" ".join(x for g in _MARKS.findall(m[3]) for x in g).lower()) if "=" in m[3] else ()
        marks = tuple(dict.fromkeys(w.rstrip("s") for w in words if len(w) > 1))
        _, _, own, near = stack[-1] if stack else ("", (), "", ())
        if tag not in _INLINE:
            own = tag
            if known is None or f"in:{tag}" in known:
                above[tag] = above.get(tag, 0) + 1
        near = marks or ((tag,) if tag in _REGIONS else near)
        marks = tuple(w for w in marks if known is None or f"mark:{w}" in known)
        for w in marks:
            words_above[w] = words_above.get(w, 0) + 1
        stack.append((tag, marks, own, near))
        open_[tag] += 1
        links += tag == "a"
        foreign += tag in _FOREIGN
    flush()
    return out


def features(page: list[Block]) -> list[list[str]]:
    """Names of the features that each block of a page has."""
    out, n = [], len(page)
    for k, b in enumerate(page):
        words = len(b.text.split())
        out.append(["bias", f"own:{b.tags[-1] if b.tags else ''}", *{f"in:{t}" for t in b.tags},
                    *{f"mark:{m}" for m in b.marks}, *{f"near:{m}" for m in b.near},
                    f"words:{min(words.bit_length(), 7)}", f"links:{min(3, int(b.links * 4))}",
                    f"stop:{b.text[-1] in '.!?:”'}", f"sign:{'©' in b.text}",
                    f"place:{min(3, 4 * k // n)}"])
    return out


class Field:
    """Linear-chain CRF with labels 0 (furniture) and 1 (content)."""

    def __init__(self, weights: dict[str, tuple[float, float]], moves):
        self.weights, self.moves = weights, moves

    def decode(self, rows: list[list[str]]) -> list[int]:
        """Viterbi path."""
        (m00, m01), (m10, m11) = self.moves
        get, back, a, b = self.weights.get, [], 0.0, 0.0
        for k, names in enumerate(rows):
            e0 = e1 = 0.0
            for name in names:
                w = get(name)
                if w is not None:
                    e0 += w[0]
                    e1 += w[1]
            if k:
                to0, to1 = (0, a + m00) if a + m00 >= b + m10 else (1, b + m10), \
                    (0, a + m01) if a + m01 > b + m11 else (1, b + m11)
                back.append((to0[0], to1[0]))
                a, b = to0[1] + e0, to1[1] + e1
            else:
                a, b = e0, e1
        path = [int(b >= a)] if rows else []
        for step in reversed(back):
            path.append(step[path[-1]])
        return path[::-1]


def fit(pages: list[tuple[list[list[str]], list[int]]], rounds: int = 200, penalty: float = 1e-6) -> Field:
    """Weights of the largest penalised conditional likelihood, by full-batch
    descent with adaptive steps (exact forward-backward marginals)."""
    pages = [p for p in pages if p[0]]
    names = {n: i for i, n in enumerate(sorted({f for rows, _ in pages for row in rows for f in row}))}
    w, moves = np.zeros((len(names), 2)), np.zeros((2, 2))
    means = [(np.zeros_like(x), np.zeros_like(x)) for x in (w, moves)]
    flat = np.array([names[f] for rows, _ in pages for row in rows for f in row], np.int64)
    block = np.repeat(np.arange(sum(len(r) for r, _ in pages)), [len(row) for rows, _ in pages for row in rows])
    gold = np.array([y for _, ys in pages for y in ys], np.int64)
    lens = np.array([len(rows) for rows, _ in pages], np.int64)
    page = np.repeat(np.arange(len(pages)), lens)
    place = np.arange(len(gold)) - np.repeat(np.cumsum(lens) - lens, lens)
    steps = int(lens.max()) if pages else 0
    inside = np.arange(steps) < lens[:, None]
    follows = np.flatnonzero(page[1:] == page[:-1])
    for turn in range(1, rounds + 1 if pages else 1):
        score = np.column_stack([np.bincount(block, w[flat, y], len(gold)) for y in (0, 1)])
        s = np.zeros((len(pages), steps, 2))
        s[page, place] = score
        alpha, beta = np.empty_like(s), np.zeros_like(s)
        alpha[:, 0] = s[:, 0]
        for t in range(1, steps):
            go = s[:, t] + np.logaddexp(alpha[:, t - 1, :1] + moves[0], alpha[:, t - 1, 1:] + moves[1])
            alpha[:, t] = np.where(inside[:, t, None], go, alpha[:, t - 1])
        for t in range(steps - 2, -1, -1):
            ahead = s[:, t + 1] + beta[:, t + 1]
            go = np.logaddexp(ahead[:, :1] + moves[:, 0], ahead[:, 1:] + moves[:, 1])
            beta[:, t] = np.where(inside[:, t + 1, None], go, 0)
        z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
        given = np.exp(alpha + beta - z[:, None, None])[page, place]
        given[np.arange(len(gold)), gold] -= 1
        after = (s + beta)[:, 1:]
        pairs = np.exp(alpha[:, :-1, :, None] + moves + after[:, :, None, :] - z[:, None, None, None])
        walked = (pairs * inside[:, 1:, None, None]).sum(axis=(0, 1))
        np.add.at(walked, (gold[follows], gold[follows + 1]), -1.0)
        step = np.column_stack([np.bincount(flat, given[block, y], len(names)) for y in (0, 1)])
        for x, slope, (mean, square) in ((w, step, means[0]), (moves, walked, means[1])):
            slope = slope / len(gold) + penalty * x
            mean[:], square[:] = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope * slope
            x -= 0.1 * mean / (1 - 0.9 ** turn) / (np.sqrt(square / (1 - 0.99 ** turn)) + 1e-8)
    return Field({n: (float(w[i, 0]), float(w[i, 1])) for n, i in names.items()}, moves.tolist())


_CONTENT_TAGS, _OFF = frozenset(["article", "main"]), frozenset(["nav", "footer", "aside", "form"])
_OFF_MARKS = frozenset("ad advert advertisement banner comment cookie footer menu nav newsletter promo related share "
                       "sidebar social sponsor widget popup notice breadcrumb".split())


def self_labels(page: list[Block]) -> list[int] | None:
    """Labels that a page's own semantic marking gives; none where it has no article."""
    inside = [bool(_CONTENT_TAGS.intersection(b.tags) or "articlebody" in b.marks) for b in page]
    if not any(inside):
        return None
    return [int(x and not _OFF.intersection(b.tags) and not _OFF_MARKS.intersection(b.marks))
            for x, b in zip(inside, page)]


# How re-dressed pages name their regions.
_BODIES = ["article", "main", "section class='article-body'", "div class='content'", "div class='post-content'",
           "div id='main-content'", "div class='entry-content'", "div class='story body'", "div class='article-text'",
           "div class='post'", "div itemprop='articleBody'", "div id='content'", "section class='entry'",
           "div class='article'", "section id='main'", "div class='text'", "div class='story'", "div role='main'"]
_ABOVE = ["nav", "header", "header class='site-header'", "div class='menu'", "div class='navbar'", "div id='nav'",
          "div class='header top'", "ul class='menu'", "div class='breadcrumbs'", "div class='cookie-notice'",
          "div class='notice'", "div class='cookie banner'", "div class='ad'", "div class='advert'",
          "div class='advertisement'", "div role='banner'", "div class='popup overlay'", "div class='topbar'",
          "div role='navigation'", "div class='alert'", "div class='consent'", "div class='skip-link'"]
_WITHIN = ["aside", "div class='ad'", "div class='ads'", "div class='promo'", "div class='sponsored'", "figure class='ad'",
           "div class='related'", "div class='share'", "div class='social'", "div class='newsletter'", "form",
           "div class='advert'", "div class='notice'", "aside class='sidebar'", "nav class='toc'", "div class='widget'"]
_BELOW = ["footer", "div class='footer'", "div id='footer'", "aside", "aside class='sidebar'", "div class='sidebar'",
          "div class='comments'", "section class='comments'", "section id='comments'", "div class='comment-list'",
          "ol class='comments'", "div class='user-comment'", "div class='related'", "div class='widget'", "form",
          "form class='newsletter'", "div class='copyright'", "div class='pagination'", "div class='share'",
          "div class='login'", "div class='subscribe'", "div class='legal'", "div class='replies'",
          "div class='disqus thread'", "div role='contentinfo'", "div role='complementary'", "div class='sponsored'",
          "div class='signup'", "div class='tags'", "div class='discussion'", "div class='reader-comments'"]


def redress(texts: list[str], furniture: list[str], seed: int) -> tuple[list[Block], list[int]]:
    """The given article texts under a drawn template, with drawn furniture
    around and between; the labels come from the construction."""
    draw = random.Random(seed)
    out, labels = [], []

    def region(kind: str, lines: list[str], label: int, above: str = "") -> None:
        close = kind.split()[0]
        inner = draw.choice(["p", "p", "div", "li", "span"]) if not label else "p"
        title = draw.choice(["h1", "h2"]) if label and draw.random() < 0.8 else None
        body = "".join(f"<{title if title and k == 0 else inner}>{htmllib.escape(x)}</{title if title and k == 0 else inner}>"
                       for k, x in enumerate(lines))
        found = blocks(f"<html><body>{above}<{kind}>{body}</{close}>")
        out.extend(found)
        labels.extend([label] * len(found))

    def some(most: int) -> list[str]:
        return [draw.choice(furniture) if draw.random() < 0.5 else draw.choice(texts) for _ in range(draw.randint(1, most))]

    # what stands on either side is told by the markup: short content and long furniture are as common
    texts = [" ".join(t.split()[:draw.randint(1, 4)]) + draw.choice([".", ""]) if draw.random() < 0.35 else t for t in texts]

    wrap = draw.choice(["", "<div id='page'>", "<div class='wrapper'>", "<div class='container'>"])
    body = draw.choice(_BODIES)
    for kind in draw.sample(_ABOVE, draw.randint(1, 4)):
        region(kind, some(5), 0, wrap)
    cut = draw.randint(1, len(texts))
    region(body, texts[:cut], 1, wrap)
    if draw.random() < 0.5:
        region(draw.choice(_WITHIN), some(3), 0, f"{wrap}<{body}>")
    if texts[cut:]:
        region(body, texts[cut:], 1, wrap)
    if draw.random() < 0.3:
        region(draw.choice(["section class='comments'", "div class='comment'", "footer", "aside"]), some(4), 0,
               f"{wrap}<{body}>")
    for kind in draw.sample(_BELOW, draw.randint(1, 5)):
        region(kind, some(4), 0, wrap)
    return out, labels


_FURNITURE = ["Home", "About us", "Contact", "Log in", "Sign up", "Share", "Menu", "Search", "Privacy policy",
              "Terms of use", "Read more", "Next page", "© All rights reserved.", "Subscribe to our newsletter.",
              "This site uses cookies.", "Accept", "Related stories", "Advertisement", "Reply"]
_TEXTS = ["A report on the river", "The river rose again on Monday, and the town closed two bridges.",
          "Yes.", "Engineers measured the water each hour and told the council what they had found.",
          "By evening the rain had stopped, but the fields to the south were still under water."]


def train(sample: list[str], seed: int = 7, dressings: int = 4) -> Field:
    """Field of self-labelled ``sample`` pages and their re-dressed forms (and of
    a few built-in texts, so that an empty sample gives a usable field too)."""
    pages, number = [], seed
    sources = [(_TEXTS, _FURNITURE)] * 60
    for page in sample:
        found = blocks(page)
        labels = self_labels(found)
        if labels is None:
            continue
        pages.append((features(found), labels))
        texts = [b.text for b, y in zip(found, labels) if y]
        sources += [(texts, [b.text for b, y in zip(found, labels) if not y] + _FURNITURE)] * dressings if texts else []
    for texts, furniture in sources:
        number += 1
        found, labels = redress(texts, furniture, number)
        pages.append((features(found), labels))
    return fit(pages)


def main_text(page: str | None, field: Field) -> str:
    found = blocks(page, field.weights) if page else []
    return "\n".join(b.text for b, y in zip(found, field.decode(features(found))) if y)


def train_on(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE,
             sample_chars: int = SAMPLE_CHARS) -> Field:
    """Field of at most ``sample`` pages of at most ``sample_chars`` characters,
    the first in the order of a hash of page and id, so that runs agree."""
    short = pages.select(F.col(id_col).alias("i"), F.col(html_col).alias("h")) \
        .filter(F.col("h").isNotNull() & (F.length("h") <= sample_chars))
    rows = bounded_sample(short, sample, "i", "h").collect()
    return train([r["h"] for r in rows])


def extract(pages: DataFrame, field: Field, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with the main text as ``out_col`` instead of ``html_col`` (an equally named column gives way).

    Content blocks are joined by one newline; a null or empty page and one without
    content give the empty string; very long pages are read whole, whatever their
    nesting.  One row per row, repeated ones too; an empty table stays empty.
    """
    small_batches(pages.sparkSession)
    rest = [c for c in pages.columns if c.lower() not in (out_col.lower(), html_col.lower())]
    kept = pages.select(*rest, F.col(html_col).alias("__html"))
    out = StructType([*[f for f in kept.schema.fields if f.name != "__html"], StructField(out_col, StringType(), False)])
    shared = pages.sparkSession.sparkContext.broadcast((field.weights, field.moves))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Field(*shared.value)
        for batch in batches:
            texts = [main_text(h.as_py(), own) for h in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())],
                                             [*batch.schema.names[:-1], out_col])

    return kept.mapInArrow(frugal(run), out)
