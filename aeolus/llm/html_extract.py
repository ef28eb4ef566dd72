"""Main text of web pages as a maximum-scoring subsequence.

A page is a sequence of words and tags. Every word has a weight, positive where
it looks like main text, and every tag a negative one; one linear scan finds the
contiguous region of the highest sum. Inside it, elements whose own words and
tags sum below zero (adverts, forms) are left out, from the innermost outwards.

The weights are learnt from pages that label themselves: those with exactly one
``article`` or ``main`` element. A logistic regression tells the words inside
from the others by the elements and names around them, the block they stand in,
its length and its share of link words; some pages hide their element names
from it, so that length and links must do alone. Tags weigh by how much more
often they stand outside. A name that stands around nearly all words of a page
says nothing about a part of it and doesn't count there.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

#: Elements whose content is no text.
RAW = frozenset("script style noscript template textarea title iframe svg math object select button canvas audio video head".split())
#: Elements that can hold a part of a page, and so tell what it is.
CONTAINERS = frozenset(
    "nav header footer aside form article main section div ul ol table dl figure details dialog menu td body"
    " fieldset center".split()
)
#: Elements that begin and end a block of text.
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd tr th thead tbody tfoot caption blockquote pre hr address figcaption summary"
    " legend option html".split()
)
#: Elements that mean nothing by themselves.
PLAIN = frozenset("div body section center table td html tr th tbody thead span".split())
#: What the HTML standard calls a page's main part, and what is no part of it.
MAIN, ASIDE = ("article", "main"), ("nav", "aside", "footer", "form", "dialog", "menu")
#: ARIA landmark roles and the elements that they stand for.
ROLES = {
    "navigation": "nav", "banner": "header", "contentinfo": "footer", "complementary": "aside", "search": "form",
    "form": "form", "dialog": "dialog", "alertdialog": "dialog", "menu": "menu", "main": "main", "article": "article",
}

#: Self-labelled pages at most that the weights are fitted on, drawn by a hash.
FIT_PAGES = 400
#: Steps and rate of the fit, and how firmly it holds on to what the standard says.
STEPS, RATE, HOLD = 400, 0.5, 8.0
#: A name around so much of a page's words is not counted there.
EVERYWHERE = 0.9
#: What a tag costs, at least and at most.
LEAST, DEAREST = 0.05, 4.0
#: What a part that is left out costs the scan at most, in words.
BRIDGE = 10.0

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)[^>]*+>",
    re.DOTALL,
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""\bhidden\b(?!\s*=\s*["']?false)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.IGNORECASE)
_SPLIT = re.compile(r"[^a-z]+|(?<=[a-z])(?=[A-Z])")


# -- pages as tokens ------------------------------------------------------


def _keys(name: str, attributes: str) -> list[str]:
    """What an element is called: itself unless it is plain, its role, its names."""
    keys = [] if name in PLAIN else [f"e:{name}"]
    for match in _NAMES.finditer(attributes):
        value = match[2] or match[3] or match[4] or ""
        if match[1].lower() == "role":
            keys += [f"e:{ROLES[r]}" for r in value.lower().split() if r in ROLES]
        else:
            words = [w.lower() for w in _SPLIT.split(value) if len(w) > 1]
            keys += ["c:" + (w[:-1] if w.endswith("s") and len(w) > 3 else w) for w in words]
    return keys


@dataclass
class Page:
    """A page's tokens in order: text runs and tags.

    ``name``: the tag's, None for a text run. ``text``: of a shown run. ``keys``:
    what the containers around a token are called, None where it isn't shown.
    ``block``: number of the block a run stands in, ``kind`` the element that
    began it; ``link``: in a link. ``elements``: (first, after the last token) of
    the containers, inner ones first.
    """

    name: list[str | None] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    keys: list[tuple[str, ...] | None] = field(default_factory=list)
    block: list[int] = field(default_factory=list)
    kind: list[str] = field(default_factory=list)
    link: list[bool] = field(default_factory=list)
    elements: list[tuple[int, int]] = field(default_factory=list)


def read_page(page: str) -> Page:
    """One pass over the markup. Raw and hidden elements' text is left out."""
    out = Page()
    stack: list[tuple[str, tuple[str, ...] | None, int]] = []
    keys: tuple[str, ...] | None = ()
    at, end_of_tags, block, kind, link = 0, page.rfind(">") + 1, 0, "body", False
    unclosed: set[str] = set()

    def add(name, text):
        out.name.append(name)
        out.text.append(text if keys is not None else "")
        out.keys.append(keys)
        out.block.append(block)
        out.kind.append(kind)
        out.link.append(link)

    while True:
        match = _TOKEN.search(page, at, end_of_tags) if at < end_of_tags else None
        if not match:
            rest = page[at:].partition("<!--")[0]  # a comment that never ends
            if rest:
                add(None, rest)
            break
        if match.start() > at:
            add(None, page[at : match.start()])
        at = match.end()
        if not match[2]:
            continue
        name, end = match[2].lower(), bool(match[1])
        if name in BLOCKS:
            block, kind, link = block + 1, kind if end else name, False
        if name == "a":
            link = not end
        if name in CONTAINERS and not end:
            hidden = keys is None or bool(_HIDDEN.search(match[3]))
            stack.append((name, keys, len(out.name)))
            if hidden:
                keys = None
            else:
                own = _keys(name, match[3])
                # An article in an article is a comment on it, as the standard has it.
                own = ["e:comment" if k == "e:article" and k in keys else k for k in own]
                keys = (*keys, *(k for k in dict.fromkeys(own) if k not in keys))
        add(name, "")
        if name in RAW and not end and not match[3].rstrip().endswith("/"):
            close = None if name in unclosed else re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE).search(page, at)
            if not close:
                unclosed.add(name)
            if close or name in ("script", "style", "title", "textarea"):
                at = close.end() if close else len(page)
        elif name in CONTAINERS and end and any(open_ == name for open_, *_ in stack):
            while True:
                open_, keys, first = stack.pop()
                out.elements.append((first, len(out.name)))
                if open_ == name:
                    break
            kind = name
    while stack:
        out.elements.append((stack.pop()[2], len(out.name)))
    return out


def run_features(page: Page) -> list[tuple[int, int, list[str]]]:
    """(token, words, features) of each shown text run that has words."""
    words = [len(t.split()) if n is None else 0 for n, t in zip(page.name, page.text)]
    total, linked, around = Counter(), Counter(), Counter()
    for k, n in enumerate(words):
        if n:
            total[page.block[k]] += n
            linked[page.block[k]] += n * page.link[k]
            for key in page.keys[k]:
                around[key] += n
    whole = sum(words)
    common = {key for key, n in around.items() if n >= EVERYWHERE * whole}
    out = []
    for k, n in enumerate(words):
        if not n:
            continue
        size, share = total[page.block[k]], linked[page.block[k]] / total[page.block[k]]
        features = [key for key in page.keys[k] if key not in common]
        features += [f"n:{min(6, size.bit_length())}", f"l:{round(share * 3)}"]
        if page.kind[k] not in PLAIN:
            features.append(f"b:{page.kind[k]}")
        if page.link[k]:
            features.append("link")
        out.append((k, n, features))
    return out


# -- weights --------------------------------------------------------------


@dataclass
class Weights:
    """Log-odds of the features, the bias, and what each tag costs."""

    features: dict[str, float]
    bias: float
    tags: dict[str, float]

    def word(self, features: list[str]) -> float:
        """Between -1 and 1; above 0 where main text is likelier."""
        z = self.bias + sum(self.features.get(f, 0.0) for f in features)
        return float(np.tanh(z / 2))

    def tag(self, name: str) -> float:
        return -self.tags.get(name, LEAST)


#: Before any page is seen: words outside links count, and the standard's elements mean what it says.
PLAIN_WEIGHTS = Weights(
    {"link": -4.0, "l:3": -2.0} | {f"e:{n}": -6.0 for n in (*ASIDE, "comment")} | {f"e:{n}": 2.0 for n in MAIN}, 2.0, {}
)


def labelled_runs(markup: str) -> tuple[list[tuple[bool, int, list[str]]], list[tuple[bool, str]]] | None:
    """Runs (label, words, features) and tags (label, name) of a page that labels
    itself; None for other pages."""
    page = read_page(markup)
    names = [{k[2:] for k in keys or () if k.startswith("e:")} for keys in page.keys]
    opened = sum(n in MAIN for (a, _) in page.elements for n in [page.name[a]])
    inside = [bool(n.intersection(MAIN)) and not n.intersection((*ASIDE, "comment")) for n in names]
    runs = [(inside[k], n, features) for k, n, features in run_features(page)]
    if opened != 1 or len({label for label, *_ in runs}) < 2:
        return None
    return runs, [(inside[k], name) for k, name in enumerate(page.name) if name]


def fit_weights(pages: list[tuple[list, list]]) -> Weights:
    """Weights from labelled pages (``labelled_runs``).

    In turn a page shows all its names, hides its main element, or hides all
    names. The fit starts from ``PLAIN_WEIGHTS`` and pays for leaving them, so a
    few pages change little.
    """
    if not pages:
        return PLAIN_WEIGHTS
    index: dict[str, int] = {}
    rows, columns, label, weight = [], [], [], []

    def add(features, y, w):
        for f in features:
            rows.append(len(label))
            columns.append(index.setdefault(f, len(index)))
        label.append(y)
        weight.append(w)

    counts = {True: Counter(), False: Counter()}
    for number, (runs, tags) in enumerate(pages):
        for y, n, features in runs:
            if number % 3 == 1:
                features = [f for f in features if f not in ("e:article", "e:main")]
            elif number % 3 == 2:
                features = [f for f in features if f[0] in "nl"]
            add(features, y, np.sqrt(n))
        for y, name in tags:
            counts[y][name] += 1
    for name in PLAIN_WEIGHTS.features:
        index.setdefault(name, len(index))
    y, w = np.array(label, float), np.array(weight)
    # Both labels weigh alike.
    w *= np.where(y == 1, w.sum() / 2 / w[y == 1].sum(), w.sum() / 2 / w[y == 0].sum())
    rows, columns = np.array(rows), np.array(columns)
    start = np.array([PLAIN_WEIGHTS.features.get(f, 0.0) for f in index])
    theta, bias = start.copy(), PLAIN_WEIGHTS.bias
    seen, seen_bias = np.full(len(index), 1e-8), 1e-8
    for _ in range(STEPS):
        z = bias + np.bincount(rows, theta[columns], minlength=len(y))
        error = w * (1 / (1 + np.exp(-z)) - y)
        g = np.bincount(columns, error[rows], minlength=len(index)) + HOLD * (theta - start)
        g_bias = error.sum() + HOLD * (bias - PLAIN_WEIGHTS.bias)
        seen += g * g
        seen_bias += g_bias**2
        theta -= RATE * g / np.sqrt(seen)
        bias -= RATE * g_bias / np.sqrt(seen_bias)
    cost = {
        name: float(np.clip(np.log((counts[False][name] + 0.5) / (counts[True][name] + 0.5)), LEAST, DEAREST))
        for name in {*counts[False], *counts[True]} - PLAIN
    }
    return Weights({f: float(theta[k]) for f, k in index.items()}, float(bias), cost)


# -- the scan -------------------------------------------------------------


def best_region(scores: list[float]) -> tuple[int, int]:
    """Half-open range of the contiguous tokens of the highest sum; the first,
    shortest one of several; (0, 0) if no sum is above zero."""
    best = total = 0.0
    start, region = 0, (0, 0)
    for k, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += score
        if total > best:
            best, region = total, (start, k + 1)
    return region


def left_out(elements: list[tuple[int, int]], scores: list[float]) -> list[tuple[int, int]]:
    """Elements whose tokens sum below zero, not counting inner ones left out."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    out: list[tuple[int, int]] = []
    # Inner elements come first; those left out so far lie on top of the stack.
    for first, after in elements:
        inner = 0.0
        kept = len(out)
        while kept and out[kept - 1][0] >= first:
            kept -= 1
            inner += total[out[kept][1]] - total[out[kept][0]]
        if total[after] - total[first] - inner < 0:
            del out[kept:]
            out.append((first, after))
    return out


def scores_of(page: Page, weights: Weights) -> list[float]:
    scores = [weights.tag(n) if n and keys is not None else 0.0 for n, keys in zip(page.name, page.keys)]
    for k, n, features in run_features(page):
        scores[k] = n * weights.word(features)
    return scores


def main_text(markup: str | None, weights: Weights = PLAIN_WEIGHTS) -> str:
    """Main text: blocks in page order, two line feeds between them."""
    if not markup:
        return ""
    page = read_page(markup)
    scores = scores_of(page, weights)
    # What is left out anyway hardly parts what stands on both sides.
    outside = left_out(page.elements, scores)
    bridged = list(scores)
    for first, after in outside:
        total = sum(scores[first:after])
        if total < -BRIDGE and after - first > 1:
            bridged[first:after] = [x * BRIDGE / -total if x < 0 else x for x in scores[first:after]]
    first, last = best_region(bridged)
    gone = [False] * len(scores)
    for a, b in outside:
        if first <= a and b <= last:
            gone[a:b] = [True] * (b - a)
    blocks, open_, number = [], [], None
    for k in range(first, last):
        name = page.name[k]
        if name is None:
            if page.block[k] != number:
                blocks.append("".join(open_))
                open_, number = [], page.block[k]
            if not gone[k]:
                open_.append(page.text[k])
        elif name in ("br", "wbr", "img"):
            open_.append(" ")
    blocks.append("".join(open_))
    joined = (" ".join(html.unescape(b).split()) for b in blocks)
    return "\n\n".join(b for b in joined if b)


def fit(pages: DataFrame, most: int = FIT_PAGES) -> Weights:
    """Weights of at most ``most`` pages that label themselves, drawn by a hash
    of their markup; of equal pages one counts."""
    marked = pages.where(F.col("html").rlike(r"(?i)<(article|main)\b")).select(
        "html", F.xxhash64("html", F.lit(2)).alias("draw")
    )
    # The hashes alone tell which pages are drawn; only those are shuffled.
    last = marked.select("draw").distinct().orderBy("draw").limit(most).agg(F.max("draw")).first()[0]
    if last is None:
        return PLAIN_WEIGHTS
    drawn = marked.where(F.col("draw") <= last).groupBy("draw").agg(F.min("html").alias("html"))

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(d, labelled_runs(h)) for d, h in zip(batch["draw"], batch["html"])]
            found = [(d, f) for d, f in found if f]
            yield pd.DataFrame({
                "draw": [d for d, _ in found],
                "runs": [[(bool(y), n, fs) for y, n, fs in f[0]] for _, f in found],
                "tags": [[(bool(y), n) for y, n in f[1]] for _, f in found],
            })

    schema = (
        "draw long, runs array<struct<y:boolean,n:int,f:array<string>>>, tags array<struct<y:boolean,n:string>>"
    )
    rows = sorted(drawn.mapInPandas(label, schema).collect(), key=lambda r: r["draw"])
    return fit_weights([([(r.y, r.n, list(r.f)) for r in row.runs], [(t.y, t.n) for t in row.tags]) for row in rows])


def extract(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """Main text of every page, by weights learnt from ``pages`` themselves
    unless they are given.

    Null or empty html, and pages without words: empty text. Repeated rows give
    the same again. Columns: page_id, url, text, n_chars (code points)."""
    weights = weights or fit(pages)

    @pandas_udf("string")
    def text_of(markup: pd.Series) -> pd.Series:
        return pd.Series([main_text(m, weights) for m in markup], dtype=object)

    return pages.select(
        "page_id", "url", text_of(F.coalesce("html", F.lit(""))).alias("text")
    ).withColumn("n_chars", F.length("text").cast("long"))
