"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks of text with their place in the element tree. A
logistic classifier, trained on a bounded sample of pages whose own elements
name article and boilerplate, gives each block a cost for either label; these
are the capacities of the terminals. Links between neighbouring blocks and
between blocks and the elements they stand in make labels smooth. The minimum
cut parts content from boilerplate.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from tulha.llm.max_flow import content_side
from tulha.llm.tables import hash_share, with_columns

#: Pages that the classifier is trained on (about; copies count once), and blocks of each.
SAMPLE_PAGES, SAMPLE_BLOCKS = 1000, 60
#: Costs of parting two neighbours (of one element, of two), and a block or element from the element it is in.
NEIGHBOURS, STRANGERS, ELEMENT = 0.6, 0.2, 0.3
LARGEST_COST, SCALE = 8.0, 1000

# Elements by their meaning in HTML.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul caption".split()
)
SILENT_TAGS = frozenset("script style noscript template head title svg annotation annotation-xml iframe object canvas audio video select option datalist button textarea".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SPACE_TAGS = frozenset("br td th img input".split())
#: A start tag among these ends an open paragraph or item.
_CLOSED_BY_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "option": {"option"}}

# Words in element names, classes and ids.
CONTENT_WORDS = frozenset("article main content post entry story articlebody maincontent articletext bodytext prose".split())
OTHER_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager topbar masthead sitemap header footer copyright legal disclaimer colophon "
    "sidebar aside rail widget widgets related recommended recommendations trending popular teaser teasers share sharing social follow "
    "notice notices cookie cookies consent gdpr banner alert popup modal overlay paywall ad ads adv advert adverts advertisement advertising sponsor "
    "sponsored promo promotion form newsletter subscribe subscription signup login register search comment comments disqus respond reply replies "
    "discussion guestbook feedback hidden metadata byline tags taglist skip toolbar".split()
)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_RIGHTS = re.compile(r"©|\(c\)\s*\d{4}|all rights reserved|alle rechte|tous droits|todos los derechos", re.IGNORECASE)


_NAMING = frozenset(("class", "id", "role", "style", "hidden"))
#: Names of more letters than this are read each time instead of remembered.
REMEMBERED_LETTERS = 1000


def _names(tag: str, attrs: tuple[tuple[str, str | None], ...]) -> frozenset[str]:
    """The known words in an element's name, classes, id and role."""
    words = {tag}
    for name, value in attrs:
        if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value or ""):
            words.add("hidden")
        elif name != "style":
            words |= {w.lower() for w in _PARTS.findall(value or "")} | {w.lower() for w in (value or "").split()}
    return frozenset(words & (CONTENT_WORDS | OTHER_WORDS))


_names_remembered = lru_cache(maxsize=4096)(_names)


@dataclass
class Block:
    """Text between two block boundaries, and the elements around it."""

    text: str
    path: tuple[int, ...]  # numbers of the elements, the outermost first
    tags: tuple[str, ...]
    content: int  # elements around it whose names speak of content
    other: int  # and of anything else
    linked: int  # letters inside links


class _Blocks(HTMLParser):
    """Reads a page into blocks. Silent elements whose numbers are in `unended` end where the next block begins."""

    def __init__(self, unended: frozenset[int] = frozenset()) -> None:
        super().__init__(convert_charrefs=True)
        self.unended = unended
        self.left_open: set[int] = set()  # numbers of silent elements without an end tag of their own
        self.stack: list[tuple[str, int, int, int]] = []  # tag, number, content words, other words
        self.count = 0
        self.silent = 0
        self.links = 0
        self.parts: list[str] = []
        self.linked = 0
        self.blocks: list[Block] = []

    def cut(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            held = [s for s in self.stack if s[0] in BLOCK_TAGS]
            self.blocks.append(
                Block(text, tuple(s[1] for s in held), tuple(s[0] for s in held), sum(s[2] for s in self.stack), sum(s[3] for s in self.stack), min(self.linked, len(text)))
            )
        self.parts, self.linked = [], 0

    def pop_to(self, place: int, ended: bool = False) -> None:
        """Takes the elements from a place on off the stack; `ended`: the first by its own end tag."""
        if self.silent and not (ended and self.stack[place][0] in SILENT_TAGS):
            self.left_open |= {s[1] for s in self.stack[place:] if s[0] in SILENT_TAGS}
        for tag, *_ in self.stack[place:]:
            self.silent -= tag in SILENT_TAGS
            self.links -= tag == "a"
        del self.stack[place:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in SPACE_TAGS:
            self.parts.append(" ")
        if tag in BLOCK_TAGS:
            if self.silent and self.unended:
                self.pop_to(next((i for i, s in enumerate(self.stack) if s[1] in self.unended), len(self.stack)))
            self.cut()
            ends = _CLOSED_BY_SAME.get(tag, set()) | {"p"}
            for place in range(len(self.stack) - 1, -1, -1):
                open_tag = self.stack[place][0]
                if open_tag in ends:
                    self.pop_to(place)
                    break
                if open_tag in BLOCK_TAGS and open_tag != "p":
                    break
        if tag in VOID_TAGS:
            return
        content, other = self.meaning(tag, attrs)
        self.count += 1
        self.stack.append((tag, self.count, content, other))
        self.silent += tag in SILENT_TAGS
        self.links += tag == "a"

    def meaning(self, tag: str, attrs: list[tuple[str, str | None]]) -> tuple[int, int]:
        named = tuple((k, v) for k, v in attrs if k in _NAMING)
        short = len(named) < 10 and sum(len(v or "") for _, v in named) <= REMEMBERED_LETTERS
        words = _names_remembered(tag, named) if short else _names(tag, named)
        if not words:
            return 0, 0
        other = words & OTHER_WORDS
        if other and (any(s[2] for s in self.stack) or (words - {tag}) & CONTENT_WORDS):
            other -= {"header", "post"}  # an article's own heading
        content = words & CONTENT_WORDS
        return int(bool(content) and not other), int(bool(other) and tag not in ("html", "body"))

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK_TAGS:
            self.cut()
        elif tag in SPACE_TAGS:
            self.parts.append(" ")
        for place in range(len(self.stack) - 1, -1, -1):
            open_tag = self.stack[place][0]
            if open_tag == tag:
                self.pop_to(place, ended=True)
                return
            if open_tag in BLOCK_TAGS and tag not in BLOCK_TAGS and not (self.silent and tag in SILENT_TAGS):
                return

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.parts.append(data)
            if self.links:
                self.linked += len(data.strip())


def blocks_of(html: str | None) -> list[Block]:
    """The page's blocks in page order, character references decoded, white space made single.

    A silent element without an end tag silences no more than what comes before
    the next block, so a page with such elements is read a second time.
    """
    if not html:
        return []
    unended: frozenset[int] = frozenset()
    for _ in range(2):
        parser = _Blocks(unended)
        parser.feed(html)
        parser.close()
        parser.cut()
        parser.pop_to(0)
        if not parser.left_open:
            break
        unended = frozenset(parser.left_open)
    return parser.blocks


# --- classifier --------------------------------------------------------------

#: Weights before any page is seen: intercept, content names, other names, linked share, length, sentences, running text, heading, item, rights.
PRIOR = (0.8, 3.5, -7.0, -3.0, 0.5, 1.0, 0.7, 0.6, -0.3, -3.0)
PRIOR_STRENGTH, EFFECTIVE_BLOCKS = 30.0, 1000


def features(block: Block) -> list[float]:
    words = block.text.count(" ") + 1
    inner = block.tags[-1] if block.tags else ""
    return [
        1.0,
        float(block.content > 0),
        float(block.other > 0),
        block.linked / len(block.text),
        math.log1p(min(words, 200)) - 2,
        float(block.text[-1] in ".!?…:;\"”»"),
        float(inner in ("p", "blockquote", "pre")),
        float(inner in ("h1", "h2", "h3", "h4", "h5", "h6")),
        float(inner in ("li", "dd", "dt", "tr")),
        float(bool(_RIGHTS.search(block.text))),
    ]


def _named(block: Block) -> int | None:
    """What the page's own elements say: 1 in an article, 0 in navigation and the like, None where they say nothing."""
    if set(block.tags) & {"nav", "aside", "footer", "form"}:
        return 0
    return 1 if block.content and not block.other and set(block.tags) & {"article", "main"} else None


@dataclass
class Classifier:
    weights: list[float] = field(default_factory=lambda: list(PRIOR))

    def log_odds(self, block: Block) -> float:
        return sum(w * x for w, x in zip(self.weights, features(block), strict=True))


def learn(pages: DataFrame, rows: int = SAMPLE_PAGES) -> Classifier:
    """A classifier trained on about `rows` pages; the prior weights hold as far as these say nothing else."""
    added = StructType([StructField("vectors", StringType()), StructField("named", StringType())])

    def make(pages_html: pa.Array) -> list[pa.Array]:
        vectors, named = [], []
        for html in pages_html.to_pylist():
            known = [b for b in blocks_of(html) if _named(b) is not None]
            known = known[:: max(1, len(known) // SAMPLE_BLOCKS)]
            vectors.append(",".join(f"{x:.4g}" for b in known for x in features(b)))
            named.append("".join(str(_named(b)) for b in known))
        return [pa.array(vectors, pa.string()), pa.array(named, pa.string())]

    found = with_columns(hash_share(pages.select("html"), "html", rows), "html", added, make).select("vectors", "named").filter("named <> ''").distinct().collect()
    if not found:
        return Classifier()
    found.sort()
    x = np.array([float(v) for r in found for v in r["vectors"].split(",")]).reshape(-1, len(PRIOR))
    y = np.array([int(c) for r in found for c in r["named"]], float)
    # The elements' names are what the labels come from, so half of the blocks are shown without them.
    x[::2, 1:3] = 0
    # Both labels count alike, and together as so many blocks at most.
    share = y.mean()
    if share in (0, 1):
        return Classifier()
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)) * min(1.0, EFFECTIVE_BLOCKS / len(y))
    w, prior = np.array(PRIOR), np.array(PRIOR)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + PRIOR_STRENGTH * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (weight * (y - p)) - PRIOR_STRENGTH * (w - prior))
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return Classifier(w.tolist())


# --- labelling ---------------------------------------------------------------


def label(blocks: list[Block], classifier: Classifier) -> list[bool]:
    """Whether each block is content: the least-cost labelling of blocks and elements."""
    gains = [round(SCALE * max(-LARGEST_COST, min(LARGEST_COST, classifier.log_odds(b)))) for b in blocks]
    links: list[tuple[int, int, int]] = []
    elements: dict[int, int] = {}
    for i, block in enumerate(blocks):
        inner = i
        for number in reversed(block.path):
            known = number in elements
            node = elements.setdefault(number, len(blocks) + len(elements))
            links.append((inner, node, round(SCALE * ELEMENT)))
            inner = node
            if known:
                break
        if i:
            same = blocks[i - 1].path[:-1] == block.path[:-1]
            links.append((i - 1, i, round(SCALE * (NEIGHBOURS if same else STRANGERS))))
    return content_side(gains + [0] * len(elements), links)[: len(blocks)]


def main_text(html: str | None, classifier: Classifier) -> str:
    blocks = blocks_of(html)
    return "\n".join(b.text for b, keep in zip(blocks, label(blocks, classifier), strict=True) if keep)


def extract(pages: DataFrame, rows: int = SAMPLE_PAGES) -> DataFrame:
    """The pages with `text` (main text, blocks joined by newlines), n_chars and the labelled `blocks`; columns of these names are replaced.

    NULL and empty pages have the empty text; equal pages get equal texts; text
    outside any element is a block of its own. Very long pages are read whole,
    and an empty table gives no rows.
    """
    shared = pages.sparkSession.sparkContext.broadcast(learn(pages, rows))

    def make(pages_html: pa.Array) -> list[pa.Array]:
        texts, labelled = [], []
        for html in pages_html.to_pylist():
            blocks = blocks_of(html)
            keep = label(blocks, shared.value)
            texts.append("\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k))
            labelled.append([{"content": k, "text": b.text} for b, k in zip(blocks, keep, strict=True)])
        kind = pa.list_(pa.struct([("content", pa.bool_()), ("text", pa.string())]))
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(labelled, kind)]

    block = StructType([StructField("content", BooleanType()), StructField("text", StringType())])
    added = StructType([StructField("text", StringType()), StructField("n_chars", LongType()), StructField("blocks", ArrayType(block))])
    return with_columns(pages, "html", added, make)
