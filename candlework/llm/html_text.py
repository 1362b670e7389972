"""Main text of web pages: flat blocks, judged by a decision tree.

A page becomes a flat list of text blocks. Each has its number of words and its link
density, those of its neighbours, its share of words that notices are made of, and where
it stands. A tree grown from a small labelled table keeps or drops it.

Names of classes and ids are no proof: what they say of an element does not count if it
holds most of the words of the page, and where only a part of a name tells something, the
words decide.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Where a block stands: in a menu, notice, comment or the like; in an element that may be
#: one; outside the article of a page that has one; on a page without an article; inside
#: the article.
CHROME, DOUBTFUL, OUTSIDE, OPEN, ARTICLE = range(5)
#: What an element says of all inside: by its tag, role or as a list of comments; by a
#: whole name; by a part of a name, or as a form.
FIRM, NAMED, SOFT = range(3)

_RAW = frozenset("script style textarea title iframe noframes xmp".split())
_SKIPPED = frozenset("head noscript template svg math object select button datalist canvas audio video".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
_CONTAINER = _BLOCK - frozenset("p hr h1 h2 h3 h4 h5 h6".split())
_CHROME_TAGS = frozenset("nav aside footer menu dialog search".split())
_FORM_TAGS = frozenset(("form", "fieldset"))
_ARTICLE_TAGS = frozenset(("article", "main"))
_CHROME_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar".split())
#: Names of classes and ids that tell what an element is for.
_CHROME_NAMES = frozenset(
    "nav navbar navigation menu topbar header masthead footer sidebar aside ad ads advert adverts advertisement "
    "advertising adsense banner promo promotion sponsor sponsored sponsors cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup signin login register search social share "
    "sharing related recommended recommendations breadcrumb breadcrumbs pagination pager widget toolbar copyright "
    "legal paywall teaser outbrain taboola".split()
)
_COMMENT_NAMES = frozenset("comment comments reply replies respond discussion disqus".split())
#: Before another word of a name: it tells of something else, as in has-sidebar or no-ads.
_OTHERWISE = frozenset("has have no non not with without is can show hide".split())
#: Words that notices, offers and legal lines are made of.
_NOTICE_WORDS = frozenset(
    "cookie cookies consent privacy policy newsletter subscribe subscription advertisement sponsored copyright rights "
    "reserved accept login signup".split()
)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_WORD = re.compile(r"[a-z]+")
_OPEN_TAG = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|(!--)|[!?])")
_PLAIN = re.compile(r"[^>\"']*")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Block:
    text: str
    words: int
    linked: int
    #: The number and kind of each element around it that says something.
    marks: tuple[tuple[int, int], ...]
    article: bool

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0

    @property
    def notice(self) -> float:
        found = _WORD.findall(self.text.lower())
        return sum(w in _NOTICE_WORDS for w in found) / len(found) if found else 0.0


class _Quotes:
    """Ends of quoted values. Looks no further for a kind that has no more of it."""

    def __init__(self, page: str):
        self.page, self.over = page, {'"': False, "'": False}

    def tag_end(self, at: int) -> int:
        """Behind the ">" of the tag whose name ends at ``at``, -1 if the page ends before."""
        page = self.page
        while True:
            at = _PLAIN.match(page, at).end()
            if at >= len(page):
                return -1
            quote = page[at]
            if quote == ">":
                return at + 1
            close = -1 if self.over[quote] else page.find(quote, at + 1)
            if close < 0:
                self.over[quote] = True
            at = max(at, close) + 1


def _attributes(text: str) -> dict[str, str]:
    """The first value of each attribute, by its lower-cased name."""
    out: dict[str, str] = {}
    for key, a, b, c in _ATTRIBUTE.findall(text):
        out.setdefault(key.lower(), a or b or c)
    return out


def _named(names: list[str], in_article: bool) -> int | None:
    """What the names of an element say of it, the strongest first."""
    found = []
    for name in names:
        parts = [p.lower() for p in _PART.findall(name)]
        ends = {parts[0], parts[-1]} if parts and _OTHERWISE.isdisjoint(parts[:-1]) else set()
        if in_article:
            ends.discard("header")
        if not ends.isdisjoint(_COMMENT_NAMES):
            found.append(FIRM)
        elif not ends.isdisjoint(_CHROME_NAMES):
            found.append(NAMED if len(parts) == 1 else SOFT)
    return min(found, default=None)


def _mark(tag: str, attributes: str, in_article: bool) -> int | None:
    """What an element says of all that is inside."""
    if tag in _CHROME_TAGS or (tag == "header" and not in_article):
        return FIRM
    found = SOFT if tag in _FORM_TAGS else None
    if not attributes or tag in ("html", "body", "main"):
        return found
    own = _attributes(attributes)
    hidden = "hidden" in own or own.get("aria-hidden", "").lower() == "true" or _UNSEEN.search(own.get("style", ""))
    if hidden or not _CHROME_ROLES.isdisjoint(own.get("role", "").lower().split()):
        return FIRM
    named = _named([*own.get("class", "").split(), own.get("id", "")], in_article or tag == "article")
    return named if found is None else found if named is None else min(found, named)


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order, white space inside each as one space."""
    out: list[Block] = []
    pieces: list[tuple[str, bool]] = []
    # Name; marks, article and skipped with all above.
    stack: list[tuple[str, tuple[tuple[int, int], ...], bool, bool]] = []
    opened: dict[str, int] = {}
    link, paragraph, marked = False, (), 0
    quotes = _Quotes(page)
    size, at = len(page), 0

    def state():
        return stack[-1][1:] if stack else ((), False, False)

    def marks_of(tag, attributes, article):
        nonlocal marked
        kind = _mark(tag, attributes, article)
        marked += kind is not None
        return () if kind is None else ((marked, kind),)

    def flush():
        nonlocal pieces, paragraph
        if pieces:
            text = " ".join(entities.unescape("".join(t for t, _ in pieces)).split())
            if text:
                linked = sum(len(entities.unescape(t).split()) for t, inside in pieces if inside)
                words = len(text.split(" "))
                marks, article, _ = state()
                out.append(Block(text, words, min(linked, words), marks + paragraph, article))
            pieces = []

    def close(name):
        while True:
            top = stack.pop()[0]
            opened[top] -= 1
            if top == name:
                return

    while at < size:
        m = _OPEN_TAG.search(page, at)
        begin = m.start() if m else size
        if begin > at and not state()[2]:
            pieces.append((page[at:begin], link))
        if m is None:
            break
        if m[3]:
            end = page.find("-->", m.end())
            at = size if end < 0 else end + 3
            continue
        if not m[2]:
            end = page.find(">", m.end())
            at = size if end < 0 else end + 1
            continue
        at = quotes.tag_end(m.end())
        if at < 0:
            break
        ending, tag = bool(m[1]), m[2].lower()
        attributes = page[m.end() : at - 1]
        if tag == "a":
            link = not ending
        elif tag == "br":
            pieces.append((" ", link))
        if tag in _BLOCK:
            flush()
            paragraph = ()
        if ending:
            if opened.get(tag):
                close(tag)
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            at = size if end is None else end.start()
            continue
        if tag == "body" and opened.get("head"):
            close("head")
        if tag == "li" and stack and stack[-1][0] == "li":
            close("li")
        if tag in _CONTAINER or tag in _SKIPPED:
            if not attributes.endswith("/") or tag in _CONTAINER:
                marks, article, skipped = state()
                if tag in _ARTICLE_TAGS:
                    marks = tuple(m for m in marks if m[1] != SOFT)
                marks += marks_of(tag, attributes, article)
                article = article or (tag in _ARTICLE_TAGS and all(kind != FIRM for _, kind in marks))
                stack.append((tag, marks, article, skipped or tag in _SKIPPED))
                opened[tag] = opened.get(tag, 0) + 1
        elif tag in _BLOCK and attributes:
            paragraph = marks_of(tag, attributes, state()[1])
    flush()
    return out


#: Features: place, words, link density, then words and density of the block before and
#: after, and the share of notice words.
FEATURES = ("place", "words", "density", "words_before", "density_before", "words_after", "density_after", "notice")

#: Labelled blocks without notice words: features as above, then whether it is main text.
_LABELLED = [
    # Menus, notices and the like, short and long.
    (CHROME, 1, 1.0, 0, 0.0, 1, 1.0, 0),
    (CHROME, 6, 1.0, 6, 1.0, 9, 0.0, 0),
    (CHROME, 14, 0.0, 4, 1.0, 11, 0.0, 0),
    (CHROME, 45, 0.0, 30, 0.0, 52, 0.0, 0),
    (CHROME, 120, 0.0, 80, 0.0, 0, 0.0, 0),
    (CHROME, 9, 0.2, 60, 0.0, 0, 0.0, 0),
    (CHROME, 25, 0.4, 25, 0.4, 25, 0.4, 0),
    (CHROME, 3, 0.0, 40, 0.0, 55, 0.0, 0),
    (CHROME, 5, 0.0, 3, 1.0, 70, 0.0, 0),
    (CHROME, 2, 1.0, 2, 1.0, 90, 0.0, 0),
    (CHROME, 60, 0.0, 90, 0.0, 80, 0.0, 0),
    (CHROME, 22, 0.0, 60, 0.0, 40, 0.1, 0),
    # Around an article.
    (OUTSIDE, 5, 0.0, 2, 1.0, 60, 0.0, 0),
    (OUTSIDE, 33, 0.0, 20, 0.0, 70, 0.0, 0),
    (OUTSIDE, 3, 1.0, 80, 0.0, 3, 1.0, 0),
    (OUTSIDE, 2, 1.0, 2, 1.0, 2, 1.0, 0),
    (OUTSIDE, 12, 0.0, 3, 1.0, 8, 0.0, 0),
    (OUTSIDE, 40, 0.1, 90, 0.0, 10, 0.5, 0),
    (OUTSIDE, 7, 0.0, 70, 0.0, 0, 0.0, 0),
    (OUTSIDE, 70, 0.0, 50, 0.0, 20, 0.0, 0),
    # In an article: headings, short and long paragraphs, list items, single links.
    (ARTICLE, 7, 0.0, 10, 0.0, 60, 0.0, 1),
    (ARTICLE, 85, 0.0, 7, 0.0, 40, 0.0, 1),
    (ARTICLE, 1, 0.0, 50, 0.0, 64, 0.0, 1),
    (ARTICLE, 2, 0.0, 2, 0.0, 2, 0.0, 1),
    (ARTICLE, 30, 0.2, 44, 0.1, 38, 0.0, 1),
    (ARTICLE, 5, 1.0, 48, 0.0, 52, 0.0, 1),
    (ARTICLE, 12, 0.5, 30, 0.1, 30, 0.1, 1),
    (ARTICLE, 9, 0.0, 1, 1.0, 33, 0.0, 1),
    (ARTICLE, 61, 0.0, 55, 0.0, 12, 0.0, 1),
    (ARTICLE, 8, 1.0, 35, 0.0, 3, 1.0, 1),
    (ARTICLE, 5, 0.0, 3, 1.0, 4, 0.0, 1),
    (ARTICLE, 12, 0.0, 6, 1.0, 0, 0.0, 1),
    (ARTICLE, 3, 0.0, 2, 1.0, 2, 1.0, 1),
    (ARTICLE, 20, 0.0, 5, 1.0, 9, 1.0, 1),
    (ARTICLE, 40, 0.3, 5, 1.0, 9, 1.0, 1),
    (ARTICLE, 15, 0.8, 4, 1.0, 6, 1.0, 1),
    (ARTICLE, 3, 1.0, 2, 1.0, 45, 0.0, 1),
    (ARTICLE, 4, 1.0, 7, 0.0, 0, 0.0, 1),
    # Lists of links in an article.
    (ARTICLE, 2, 1.0, 2, 1.0, 2, 1.0, 0),
    (ARTICLE, 6, 1.0, 5, 1.0, 7, 1.0, 0),
    (ARTICLE, 3, 1.0, 4, 1.0, 1, 1.0, 0),
    (ARTICLE, 8, 1.0, 9, 1.0, 8, 1.0, 0),
    # Pages without any sign but the text.
    (OPEN, 60, 0.0, 8, 0.0, 55, 0.0, 1),
    (OPEN, 35, 0.1, 50, 0.0, 40, 0.0, 1),
    (OPEN, 25, 0.0, 2, 1.0, 45, 0.0, 1),
    (OPEN, 100, 0.05, 3, 1.0, 4, 1.0, 1),
    (OPEN, 18, 0.0, 30, 0.0, 6, 0.0, 1),
    (OPEN, 9, 0.0, 40, 0.0, 60, 0.0, 1),
    (OPEN, 6, 0.0, 2, 1.0, 70, 0.0, 1),
    (OPEN, 3, 0.0, 33, 0.0, 45, 0.0, 1),
    (OPEN, 2, 1.0, 2, 1.0, 2, 1.0, 0),
    (OPEN, 1, 1.0, 0, 0.0, 1, 1.0, 0),
    (OPEN, 12, 0.9, 8, 1.0, 10, 0.8, 0),
    (OPEN, 30, 0.7, 20, 0.6, 25, 0.8, 0),
    (OPEN, 4, 0.0, 3, 1.0, 2, 1.0, 0),
    (OPEN, 6, 0.0, 5, 0.8, 0, 0.0, 0),
    (OPEN, 10, 0.6, 60, 0.0, 2, 1.0, 0),
    (OPEN, 5, 0.0, 2, 1.0, 6, 0.0, 0),
    (OPEN, 8, 0.2, 4, 0.0, 3, 0.0, 0),
    # In forms and in elements of telling names: long text among its like, and the rest.
    (DOUBTFUL, 60, 0.0, 45, 0.0, 80, 0.0, 1),
    (DOUBTFUL, 35, 0.1, 50, 0.0, 30, 0.0, 1),
    (DOUBTFUL, 90, 0.0, 8, 0.0, 70, 0.0, 1),
    (DOUBTFUL, 26, 0.0, 70, 0.0, 28, 0.1, 1),
    (DOUBTFUL, 5, 0.0, 3, 0.0, 4, 0.0, 0),
    (DOUBTFUL, 12, 0.0, 6, 1.0, 7, 0.0, 0),
    (DOUBTFUL, 2, 1.0, 2, 1.0, 3, 1.0, 0),
    (DOUBTFUL, 9, 0.4, 60, 0.0, 2, 0.0, 0),
    (DOUBTFUL, 3, 0.0, 1, 0.0, 2, 0.0, 0),
    (DOUBTFUL, 28, 0.7, 30, 0.8, 26, 0.6, 0),
    (DOUBTFUL, 15, 0.0, 5, 0.0, 2, 0.0, 0),
    (DOUBTFUL, 7, 0.0, 2, 1.0, 60, 0.0, 1),
    (DOUBTFUL, 6, 0.0, 50, 0.0, 45, 0.0, 1),
    (DOUBTFUL, 1, 0.0, 55, 0.0, 1, 0.0, 0),
    (DOUBTFUL, 1, 0.0, 40, 0.0, 0, 0.0, 0),
    (DOUBTFUL, 4, 0.0, 70, 0.0, 3, 0.0, 0),
    (DOUBTFUL, 45, 0.0, 50, 0.0, 1, 0.0, 1),
    # The last words of a page without any sign.
    (OPEN, 40, 0.0, 42, 0.0, 0, 0.0, 1),
    (OPEN, 55, 0.0, 60, 0.0, 1, 0.0, 1),
    (OPEN, 45, 0.0, 50, 0.0, 5, 0.0, 1),
    (OPEN, 1, 0.0, 45, 0.0, 0, 0.0, 0),
    (OPEN, 2, 0.0, 60, 0.0, 1, 0.0, 0),
    (OPEN, 1, 0.0, 40, 0.0, 2, 0.0, 0),
]
#: Blocks with notice words, on pages that tell nothing else; text may speak of such things too.
_NOTICES = [
    (OPEN, 22, 0.1, 6, 1.0, 60, 0.0, 0.18, 0),
    (OPEN, 14, 0.2, 4, 1.0, 8, 0.0, 0.25, 0),
    (OPEN, 30, 0.0, 70, 0.0, 0, 0.0, 0.15, 0),
    (OPEN, 9, 0.0, 80, 0.0, 0, 0.0, 0.3, 0),
    (OPEN, 45, 0.1, 55, 0.0, 2, 1.0, 0.16, 0),
    (OPEN, 14, 0.0, 1, 1.0, 6, 0.0, 0.28, 0),
    (OPEN, 18, 0.0, 0, 0.0, 40, 0.0, 0.2, 0),
    (OPEN, 80, 0.0, 50, 0.0, 60, 0.0, 0.03, 1),
    (OPEN, 40, 0.0, 45, 0.0, 38, 0.0, 0.05, 1),
    (ARTICLE, 30, 0.1, 40, 0.0, 50, 0.0, 0.2, 1),
    (ARTICLE, 6, 0.0, 20, 0.0, 60, 0.0, 0.33, 1),
    (DOUBTFUL, 40, 0.0, 30, 0.0, 50, 0.0, 0.2, 0),
]
TABLE = [(*r[:-1], 0.0, r[-1]) for r in _LABELLED] + _NOTICES


def grow(rows, depth: int = 10):
    """A decision tree: the label of a leaf, or (feature, bound, at most, above) by Gini impurity."""
    labels = [r[-1] for r in rows]
    share = sum(labels) / len(labels)
    if depth == 0 or share in (0, 1):
        return int(share > 0.5)
    best = None
    for f in range(len(FEATURES)):
        values = sorted({r[f] for r in rows})
        for low, high in zip(values, values[1:], strict=False):
            bound = (low + high) / 2
            parts = [[r[-1] for r in rows if r[f] <= bound], [r[-1] for r in rows if r[f] > bound]]
            impurity = sum(2 * sum(p) * (1 - sum(p) / len(p)) for p in parts)
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, bound)
    if best is None:
        return int(share > 0.5)
    _, f, bound = best
    return (
        f, bound,
        grow([r for r in rows if r[f] <= bound], depth - 1),
        grow([r for r in rows if r[f] > bound], depth - 1),
    )


def decide(tree, row) -> bool:
    while not isinstance(tree, int):
        f, bound, low, high = tree
        tree = low if row[f] <= bound else high
    return bool(tree)


def places(blocks: list[Block]) -> list[int]:
    """Where each block stands. A name does not count for an element with most of the page's words."""
    words: dict[int, int] = {}
    for b in blocks:
        for number, _ in b.marks:
            words[number] = words.get(number, 0) + b.words
    half = sum(b.words for b in blocks) / 2
    out = []
    for b in blocks:
        kinds = {kind for number, kind in b.marks if kind == FIRM or words[number] <= half}
        chrome = FIRM in kinds or NAMED in kinds
        out.append(CHROME if chrome else DOUBTFUL if kinds else ARTICLE if b.article else OPEN)
    if ARTICLE in out:
        out = [OUTSIDE if place == OPEN else place for place in out]
    return out


def features(blocks: list[Block]) -> list[tuple]:
    rows = []
    for i, (b, place) in enumerate(zip(blocks, places(blocks), strict=True)):
        before = (blocks[i - 1].words, blocks[i - 1].density) if i else (0, 0.0)
        after = (blocks[i + 1].words, blocks[i + 1].density) if i + 1 < len(blocks) else (0, 0.0)
        rows.append((place, b.words, b.density, *before, *after, b.notice))
    return rows


def main_text(page: str | None, tree) -> str:
    """The kept blocks of a page, joined by line ends; empty for a null page."""
    blocks = blocks_of(page or "")
    return "\n".join(b.text for b, row in zip(blocks, features(blocks), strict=True) if decide(tree, row))


def _extract(tree, html: str, keep: list[str]):
    def run(batches):
        for batch in batches:
            texts = [main_text(p, tree) for p in batch.column(html).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(texts, pa.string())], names=[*keep, "text"]
            )

    return run


def extract_main_text(pages: DataFrame, html: str = "html", tree=None) -> DataFrame:
    """``pages`` without ``html`` (nor a column ``text``), with the main ``text`` of each row.

    Every row stays, also repeated ones and those with null ids; a null, empty or
    textless page gives the empty text. A page cut off in a tag loses that tag.
    """
    keep = [f for f in pages.schema if f.name not in (html, "text")]
    names = [f.name for f in keep]
    tree = grow(TABLE) if tree is None else tree
    return pages.select(*names, html).mapInArrow(
        _extract(tree, html, names), T.StructType([*keep, T.StructField("text", T.StringType())])
    )
