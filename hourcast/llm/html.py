"""Main text of web pages by minimum-cut labelling of their blocks.

A page is read once as tags and text. Every block (text between block-level tags) gets a
classifier cost from its ancestors' tags, classes and roles, and from its own words and
links; the cost is its capacity to the content or the boilerplate terminal. Neighbours in
page order and blocks of one parent are joined by smoothness edges, weaker where the
border of a section (nav, article, footer ...) lies between them. The minimum cut separates
content from boilerplate, so a short paragraph goes with its article and a long notice
with its sidebar.

Pages are independent rows; the graph of a page is as large as its blocks. Null or empty
html and pages without content give the empty text. Repeated rows are extracted one by
one, an empty table gives no rows, and columns but page_id, url and html are not read. Unclosed tags end with their parent, a cut-off tag at the end is dropped. What is not
shown (HIDDEN) goes with its contents, up to its closing tag or the end of the page; an
svg that closes itself has none. Formulas stay as text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.llm.mincut import Edges, cut

ADJACENT = 1.0
SIBLING = 0.6
BORDER = 0.05
# Gains: what speaks for content is above 0.
TAG_GAIN = {
    "article": 4.0, "main": 3.0, "p": 0.6, "pre": 0.6, "blockquote": 0.5, "h1": 0.6, "h2": 0.3,
    "nav": -8.0, "footer": -8.0, "aside": -6.0, "header": -5.0, "form": -6.0, "menu": -8.0,
    "button": -6.0, "select": -6.0, "dialog": -6.0,
}
NAME_GAIN = {
    "article": 2.0, "content": 2.0, "post": 1.5, "entry": 1.5, "story": 2.0, "body": 0.5, "main": 2.0,
    "ad": -8.0, "ads": -8.0, "advert": -8.0, "advertisement": -8.0, "banner": -7.0, "promo": -7.0,
    "sponsor": -7.0, "sponsored": -7.0, "nav": -7.0, "navigation": -7.0, "navbar": -7.0, "menu": -7.0,
    "breadcrumb": -7.0, "breadcrumbs": -7.0, "sidebar": -7.0, "widget": -6.0, "footer": -7.0,
    "header": -4.0, "masthead": -6.0, "cookie": -8.0, "cookies": -8.0, "consent": -8.0, "notice": -7.0,
    "alert": -6.0, "popup": -7.0, "modal": -7.0, "newsletter": -7.0, "subscribe": -7.0, "signup": -7.0,
    "login": -7.0, "search": -6.0, "share": -7.0, "social": -7.0, "related": -7.0, "recommended": -7.0,
    "comment": -8.0, "comments": -8.0, "respond": -7.0, "reply": -7.0, "disqus": -8.0, "form": -6.0,
    "copyright": -6.0, "legal": -5.0, "pagination": -7.0, "pager": -7.0, "toolbar": -6.0, "contentinfo": -7.0,
    "complementary": -6.0,
}
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main "
    "menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
SECTIONS = frozenset("article aside body dialog footer form header main menu nav section".split())
# What an open element of the first kind is ended by.
ENDS = {
    "p": BLOCKS - {"option"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"},
    "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"},
    "head": {"body"},
}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = "script|style|noscript|template|textarea|svg|iframe|object|canvas|annotation-xml|annotation|title|select"

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<svg(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?<=/)>|"
    rf"<({HIDDEN})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)"
    r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>|<[A-Za-z!?/][^>]*\Z",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
# What holds other blocks: a part of a class word before one of these is the word's meaning.
CONTAINERS = frozenset(
    "area bar block bottom box button buttons container group inner item items left link links list "
    "outer panel right section slot top unit wrap wrapper".split()
)
# No element's names say more than this against its blocks.
WORST_NAMES = -8.0
# Class words that start so tell what a page has or lacks, not what the block is.
_ABOUT = ("no-", "has-", "with-", "without-", "not-", "hide-", "show-")


def _attributes(text: str) -> dict[str, str]:
    """Lower-case names and values; of a repeated name the first counts."""
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), "".join(values))
    return found


def _meaning(word: str) -> str:
    """The last part of a class word, or the last before those that only name a container."""
    parts = [part for part in re.split("[_-]+", word) if part]
    while len(parts) > 1 and parts[-1] in CONTAINERS:
        parts.pop()
    return parts[-1] if parts else ""


def name_gain(attributes: dict[str, str]) -> float:
    """What class, id and role say of an element.

    Whole words count; only where none is known do the meanings of composed ones.
    """
    words = set(" ".join(attributes.get(key, "") for key in ("class", "id", "role")).lower().split())
    own = {word for word in words if not word.replace("_", "-").startswith(_ABOUT)}
    known = own & NAME_GAIN.keys() or {_meaning(word) for word in own}
    return max(WORST_NAMES, sum(NAME_GAIN.get(name, 0.0) for name in known))


def _invisible(attributes: dict[str, str]) -> bool:
    return (
        "hidden" in attributes
        or attributes.get("aria-hidden", "").strip().lower() == "true"
        or _NO_DISPLAY.search(attributes.get("style", "")) is not None
    )


class Element:
    """An open block-level element: its own gain joins its ancestors'."""

    __slots__ = ("depth", "gain", "parent", "section", "tag")

    def __init__(self, tag: str, attributes: str, parent: Element | None) -> None:
        self.tag, self.parent = tag, parent
        # The header of an article is part of it: its title stands there.
        within = tag == "header" and parent is not None and parent.inside("article")
        gain = 0.0 if within else TAG_GAIN.get(tag, 0.0)
        if attributes:
            found = _attributes(attributes)
            gain += name_gain(found)
            if _invisible(found):
                gain -= 20.0
        self.gain = gain + (parent.gain if parent else 0.0)
        self.depth = parent.depth + 1 if parent else 0
        self.section: Element | None = (
            self
            if (tag in SECTIONS and not within) or gain <= -4
            else parent.section
            if parent
            else None
        )

    def inside(self, tag: str) -> bool:
        """Whether this element or one around it has a tag."""
        here: Element | None = self
        while here is not None and here.tag != tag:
            here = here.parent
        return here is not None


class Block:
    """Text of one element between block-level tags."""

    __slots__ = ("element", "linked", "text")

    def __init__(self, element: Element | None, text: str, linked: int) -> None:
        self.element, self.text, self.linked = element, text, linked


def blocks(page: str) -> list[Block]:
    """Non-empty blocks in page order."""
    out: list[Block] = []
    here: Element | None = None
    pieces: list[str] = []
    linked = links = at = 0

    def flush() -> None:
        nonlocal pieces, linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                out.append(Block(here, text, linked))
            pieces, linked = [], 0

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            piece = page[at : m.start()]
            pieces.append(piece)
            if links:
                linked += len(piece)
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag, closing = tag.lower(), bool(m[2])
        if tag not in BLOCKS:
            if tag == "a":
                links = max(0, links + (-1 if closing else 1))
            elif tag == "br":
                pieces.append(" ")
            continue
        flush()
        links = 0
        if closing:
            match = here
            while match is not None and match.tag != tag:
                match = match.parent
            if match is not None:
                here = match.parent
        else:
            while here is not None and tag in ENDS.get(here.tag, ()):
                here = here.parent
            if tag not in VOID:
                here = Element(tag, m[4], here)
    if at < len(page):
        pieces.append(page[at:])
    flush()
    return out


def gain(block: Block) -> float:
    """Classifier: above 0 for content."""
    words = block.text.count(" ") + 1
    own = min(words, 40) / 20 - 0.5
    own -= 3.0 * min(1.0, block.linked / len(block.text))
    if block.text[-1] in ".!?":
        own += 0.3
    if block.text.startswith(("©", "(c) ", "Copyright")):
        own -= 4.0
    return own + (block.element.gain if block.element else 0.0)


def main_text(page: str | None) -> str:
    """Content blocks, one a line."""
    found = blocks(page or "")
    edges: Edges = {}
    last: dict[Element | None, int] = {}
    for k, block in enumerate(found):
        section = block.element.section if block.element else None
        if k:
            before = found[k - 1].element
            same = (before.section if before else None) is section
            edges[k - 1, k] = ADJACENT if same else BORDER
        parent = block.element.parent if block.element else None
        if parent in last and last[parent] != k - 1:
            edges[last[parent], k] = SIBLING
        last[parent] = k
    labels = cut([gain(block) for block in found], edges)
    return "\n".join(b.text for b, content in zip(found, labels, strict=True) if content)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page) for page in batch["html"].to_pylist()]
        yield pa.record_batch(
            {
                "page_id": batch["page_id"],
                "url": batch["url"],
                "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            }
        )


def extract(df: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each page (page_id, url, html)."""
    rows = df.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
