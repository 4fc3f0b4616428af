"""Main text of web pages from flat blocks and a decision tree.

A page is read once from left to right into flat blocks: the text between block-level tags. A block is described by its
words, its link density, the same of its neighbours, and what the open elements around it say. A small decision tree,
fitted on the labelled pages below, tells text from furniture.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.html_pages import PAGES
from ledgerline.llm.text import narrow

#: Fixed names of HTML elements.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table"
    " tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What stands in these is not text.
SILENT_TAGS = frozenset(
    "audio button canvas datalist head iframe map math noframes noscript object script select style svg template"
    " textarea title video".split()
)
#: Inside these, only their own end tag is markup.
RAW_TAGS = frozenset("iframe noframes noscript script style template textarea title".split())
FURNITURE_TAGS = frozenset("aside dialog footer form menu nav search".split())
MAIN_TAGS = frozenset("article main".split())
HEADINGS = {f"h{n}": n for n in range(1, 7)}
#: Elements that the start of one of the same group ends, and the elements inside which that holds.
SELF_CLOSING = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr",), ("table",)),
}

#: Words of class, id and role: such that mark furniture in any name, such that do so only alone or with words that say
#: nothing, these, such that mark the main text, and such that a name says the contrary with.
SURE_WORDS = frozenset(
    "ad ads adsense advert advertisement advertising adverts breadcrumb breadcrumbs comment commentlist comments"
    " complementary contentinfo cookie cookies disqus footer gdpr nav navbar navigation newsletter outbrain pager"
    " pagination popup promo related replies share sharing sidebar sponsored subscribe taboola toolbar widget"
    " widgets".split()
)
LIKELY_WORDS = frozenset(
    "alert banner consent copyright dialog disclaimer feedback legal login menu modal notice notices notification"
    " promoted promotion recommended reply respond responses search signin signup skip social sponsor"
    " subscription".split()
)
PLAIN_WORDS = frozenset(
    "area bar block bottom box buttons container form global group inner item items left link links list module outer"
    " page panel reader right section site slot the to top user wrap wrapper".split()
)
HEADER_WORDS = frozenset("header masthead topbar".split())
MAIN_WORDS = frozenset("article content entry main post story".split())
CONTRARY_WORDS = frozenset("has no not with without".split())
#: Words of headings above reader comments and the like.
HEADING_WORDS = frozenset(
    "advertisement comentarios comment commentaires comments kommentare newsletter related replies reply share sponsored"
    " subscribe".split()
)
HEADING_PLAIN = frozenset("a add all and articles leave more no our posts reader stories the this to your".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)|</(?:[^a-zA-Z>][^>]*)?(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Block:
    """A flat block: its text, where it starts in the page, words in links, and marks of the elements around it.

    ``furniture`` and ``main`` are 1 for a sure mark, 0.5 for a doubtful one, else 0. ``under`` tells whether the heading
    above, in the same element, is one of reader comments or the like.
    """

    text: str
    start: int
    words: int
    linked: int
    furniture: float
    main: float
    header: int
    heading: int
    item: int
    under: int


def _marks(tag: str, attributes: str, inside_main: bool) -> tuple[float, float, bool]:
    """What an element says of the text in it: furniture and main text (1, 0.5 or 0), page header."""
    sure, header = tag in FURNITURE_TAGS, tag == "header" and not inside_main
    names: list[set[str]] = []
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        value = next((v for v in values if v), "")
        name = name.lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            sure = True
        elif name == "style":
            sure |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
        elif name in ("class", "id", "role"):
            words = ([p.lower() for p in _PART.findall(n)] for n in value.split())
            names += [set(w) for w in words if w and w[0] not in CONTRARY_WORDS]
    if tag in ("html", "body"):
        return float(sure), 0.0, False
    if tag in MAIN_TAGS:
        # A comment may be an article; whatever else its names say, a main element is one.
        sure |= bool(names) and all(n & SURE_WORDS for n in names)
        return float(sure), float(not sure), False
    told = [bool(n & SURE_WORDS) or bool(n & LIKELY_WORDS) and n <= LIKELY_WORDS | PLAIN_WORDS for n in names]
    sure |= any(told)
    likely = any(n & LIKELY_WORDS for n in names)
    header |= any(n & HEADER_WORDS for n in names) and not inside_main
    main = tag in ("div", "section", "td") and not sure and not header and any(n & MAIN_WORDS for n in names)
    return 1.0 if sure else 0.5 * likely, (0.5 if likely else 1.0) if main else 0.0, header


class _Open:
    """The open elements. Every question about them takes the same time however deep they are."""

    def __init__(self) -> None:
        self.tags: list[str] = []
        self.marks: list[tuple[float, float, bool]] = []
        self.at: dict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []
        self.headings: list[int] = []
        self.silent = self.header = 0
        self.furniture, self.main = Counter(), Counter()
        # Forms around each open main element: a form around the whole page marks nothing in it.
        self.forms: list[int] = []
        # Where the heading of furniture stands that the next blocks are under, and its level.
        self.under: tuple[int, int] | None = None

    def enter(self, tag: str, marks: tuple[float, float, bool]) -> None:
        place = len(self.tags)
        self.tags.append(tag)
        self.marks.append(marks)
        self.at[tag].append(place)
        if tag in BLOCK_TAGS:
            self.blocks.append(place)
        if tag in HEADINGS:
            self.headings.append(place)
        if tag in MAIN_TAGS:
            self.forms.append(len(self.at["form"]))
        self.silent += tag in SILENT_TAGS
        self.furniture[marks[0]] += 1
        self.main[marks[1]] += 1
        self.header += marks[2]

    def leave(self, to: int) -> None:
        """Ends all elements from place ``to`` on."""
        while len(self.tags) > to:
            tag, marks = self.tags.pop(), self.marks.pop()
            self.at[tag].pop()
            if tag in BLOCK_TAGS:
                self.blocks.pop()
            if tag in HEADINGS:
                self.headings.pop()
            if tag in MAIN_TAGS:
                self.forms.pop()
            self.silent -= tag in SILENT_TAGS
            self.furniture[marks[0]] -= 1
            self.main[marks[1]] -= 1
            self.header -= marks[2]
        if self.under and to < self.under[0]:
            self.under = None

    def last(self, *tags: str) -> int:
        return max((self.at[t][-1] for t in tags if self.at[t]), default=-1)

    def furniture_level(self) -> float:
        if self.furniture[1.0] > (self.forms[-1] if self.forms else 0):
            return 1.0
        return 0.5 if self.furniture[0.5] else 0.0

    def main_level(self) -> float:
        return 1.0 if self.main[1.0] else 0.5 if self.main[0.5] else 0.0


def _furniture_heading(text: str) -> bool:
    words = set(_PART.findall(text.lower()))
    return bool(words & HEADING_WORDS) and words <= HEADING_WORDS | HEADING_PLAIN


def blocks(page: str | None) -> list[Block]:
    """The flat blocks of a page in order. White space in a block is one space; blocks without words are left out."""
    page = page or ""
    found: list[Block] = []
    around = _Open()
    parts: list[tuple[str, bool]] = []
    start = 0

    def close() -> None:
        text = " ".join("".join(html.unescape(p) for p, _ in parts).split())
        if text:
            linked = len(" ".join(html.unescape(p) for p, link in parts if link).split())
            words = len(text.split())
            if around.headings:
                place = around.headings[-1]
                level = HEADINGS[around.tags[place]]
                if level > 1 and _furniture_heading(text):
                    around.under = (place, level)
                elif around.under and level <= around.under[1]:
                    around.under = None
            found.append(
                Block(
                    text, start, words, min(linked, words), around.furniture_level(), around.main_level(),
                    int(around.header > 0), int(bool(around.headings)), int(bool(around.at["li"])),
                    int(around.under is not None),
                )
            )
        parts.clear()

    at = 0
    while at < len(page):
        match = _TAG.search(page, at)
        end = match.start() if match else len(page)
        if end > at and not around.silent:
            if not parts:
                start = at
            parts.append((page[at:end], bool(around.at["a"])))
        if not match:
            break
        at = match.end()
        tag = (match[2] or match[5] or "").lower()
        if not tag:
            continue
        attributes = match[3] or match[6] or ""
        if tag in BLOCK_TAGS:
            close()
        elif tag == "br":
            parts.append((" ", False))
        if match[1] or match[4]:
            if around.at[tag]:
                around.leave(around.at[tag][-1])
            continue
        if tag in VOID_TAGS or attributes.endswith("/") and tag not in BLOCK_TAGS:
            continue
        if tag in BLOCK_TAGS and around.blocks and around.tags[around.blocks[-1]] == "p":
            around.leave(around.blocks[-1])
        if tag in SELF_CLOSING:
            group, limits = SELF_CLOSING[tag]
            place = around.last(*group)
            if place > around.last(*limits):
                around.leave(place)
        elif tag == "body" and around.at["head"]:
            around.leave(around.at["head"][0])
        around.enter(tag, _marks(tag, attributes, around.main_level() > 0))
        if tag in RAW_TAGS:
            ending = re.compile(rf"</{tag}\b", re.I).search(page, at)
            at = ending.start() if ending else len(page)
    close()
    return found


#: The columns of :func:`describe`.
FEATURES = (
    "words density words_before density_before words_after density_after"
    " furniture main header heading item under page_main".split()
)


def describe(found: Sequence[Block]) -> np.ndarray:
    """A row of numbers per block: itself, the blocks before and after, its marks, and the page's best mark of main text."""
    if not found:
        return np.empty((0, len(FEATURES)))
    words = np.array([b.words for b in found], float)
    density = np.array([b.linked for b in found], float) / words
    before, after = np.concatenate([[0], words[:-1]]), np.concatenate([words[1:], [0]])
    dense_before, dense_after = np.concatenate([[0], density[:-1]]), np.concatenate([density[1:], [0]])
    marks = np.array([(b.furniture, b.main, b.header, b.heading, b.item, b.under) for b in found], float)
    page_main = np.full(len(found), max((b.main for b in found if b.furniture < 1), default=0.0))
    return np.column_stack([words, density, before, dense_before, after, dense_after, marks, page_main])


@dataclass(frozen=True)
class Tree:
    """A binary decision tree: a leaf has a verdict, a node a feature, a limit and two trees."""

    verdict: bool
    feature: int = -1
    limit: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def predict(self, rows: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(rows), self.verdict)
        low = rows[:, self.feature] <= self.limit
        result = np.empty(len(rows), bool)
        result[low], result[~low] = self.low.predict(rows[low]), self.high.predict(rows[~low])
        return result


def fit_tree(rows: np.ndarray, truth: np.ndarray, depth: int = 14) -> Tree:
    """Splits by Gini impurity until a leaf is pure. Ties go to the first feature and the lowest limit."""
    verdict = bool(truth.mean() >= 0.5) if len(truth) else False
    if not depth or truth.all() or not truth.any():
        return Tree(verdict)
    best = (len(truth) * 2 * truth.mean() * (1 - truth.mean()) - 1e-9, -1, 0.0)
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for limit in (values[1:] + values[:-1]) / 2:
            low = rows[:, feature] <= limit
            impurity = sum(2 * len(t) * t.mean() * (1 - t.mean()) for t in (truth[low], truth[~low]))
            if impurity < best[0] - 1e-9:
                best = (impurity, feature, float(limit))
    if best[1] < 0:
        return Tree(verdict)
    low = rows[:, best[1]] <= best[2]
    low_tree, high_tree = (fit_tree(rows[side], truth[side], depth - 1) for side in (low, ~low))
    return Tree(verdict, best[1], best[2], low_tree, high_tree)


def labelled_rows(pages: Sequence[Sequence[tuple[int, str]]] = PAGES) -> tuple[np.ndarray, np.ndarray]:
    """Rows and truth of pages given as fragments with a label each; a block has the label of where it starts."""
    rows, truth = [], []
    for fragments in pages:
        found = blocks("".join(f for _, f in fragments))
        ends = np.cumsum([len(f) for _, f in fragments])
        rows.append(describe(found))
        truth += [fragments[int(np.searchsorted(ends, b.start, "right"))][0] for b in found]
    return np.concatenate(rows), np.array(truth, bool)


def train() -> Tree:
    return fit_tree(*labelled_rows())


def main_text(page: str | None, tree: Tree) -> str:
    found = blocks(page)
    if not found:
        return ""
    return "\n".join(b.text for b, keep in zip(found, tree.predict(describe(found))) if keep)


def extract(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every page.

    ``pages`` needs ``page_id``, ``url`` and ``html``; other columns are ignored. A null or empty page, and one without main
    text, gives an empty text. Pages may be cut off anywhere; an unfinished tag is markup. Rows are read alone and whole;
    repeated rows are given back each. An empty table gives none.
    """
    tree = tree or train()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["page_id", "url"]].assign(text=[main_text(p, tree) for p in batch["html"]])

    rows = narrow(pages, "page_id", "url", "html")
    types = dict(rows.dtypes)
    texts = rows.mapInPandas(run, f"page_id {types['page_id']}, url string, text string")
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
