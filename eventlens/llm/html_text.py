"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into blocks at block-level tags.  Each block has its word
count and link density (share of words inside links), the same of its two
neighbours, whether it is a heading, and its place: in a container that is
never main text (by tag, or by a word of its class or id), beside the page's
main container, in a page without one, or inside it.  An article or main
element within a container that is never main text is no main container.  A
small decision tree, trained here by Gini impurity on ``LABELLED``, tells
main text from the rest; the chosen blocks are joined in page order.

Pages are streamed through one function per partition, without a shuffle;
a task holds one batch of pages.

Defined cases: null or empty html gives an empty text; unclosed tags end
with their container; a tag cut off by the page's end is dropped; character
references are decoded once, also without semicolon; ``<br>`` is white
space; repeated pages give equal rows; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import with_defaults

# fixed values: element names by role, and words of classes and ids
RAW = frozenset("script style noscript template textarea select iframe svg object title math canvas video audio".split())
CONTAINERS = frozenset("html body div section article main aside nav footer header form ul ol li dl table tbody thead tfoot tr "
                       "td th blockquote figure fieldset details dialog menu center".split())
BREAKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 pre hr dt dd figcaption caption address legend summary option head".split())
MAIN = frozenset(("article", "main"))
NEVER = frozenset("nav footer aside form menu dialog button fieldset".split())
NEVER_WORDS = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent "
                        "gdpr notice alert popup modal newsletter subscribe signup login sidebar side widget menu nav navbar navigation "
                        "breadcrumb breadcrumbs footer header masthead comment comments reply replies disqus share sharing social "
                        "related recommended recirc pagination pager toolbar skip".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
                   r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++)""", re.I)
BROKEN = re.compile(r"<(?=[a-zA-Z/])[^>]*+(>|\Z)")
WORD = re.compile(r"[^\s]+")

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "heading", "place")
#: place: inside a container that is never main text; beside the page's main
#: container; page without a main container; inside it
OUTSIDE, BESIDE, UNKNOWN, INSIDE = 0, 1, 2, 3

#: blocks of pages without a main container, labelled by hand: FEATURES but
#: for the place, then 1 for main text
FLAT = (
    (140, 0.00, 10, 0.00, 75, 0.03, 0, 1), (75, 0.03, 140, 0.00, 33, 0.00, 0, 1), (33, 0.00, 75, 0.03, 4, 1.00, 0, 1),
    (10, 0.00, 3, 1.00, 140, 0.00, 1, 1), (5, 0.00, 80, 0.00, 61, 0.00, 1, 1), (7, 0.00, 88, 0.00, 52, 0.00, 0, 1),
    (24, 0.10, 45, 0.00, 38, 0.00, 0, 1), (4, 0.00, 66, 0.00, 70, 0.00, 0, 1), (18, 0.00, 0, 0.00, 0, 0.00, 0, 1),
    (40, 0.00, 2, 1.00, 2, 1.00, 0, 1), (2, 1.00, 0, 0.00, 2, 1.00, 0, 0), (3, 1.00, 2, 1.00, 4, 0.90, 0, 0),
    (4, 0.90, 3, 1.00, 10, 0.00, 0, 0), (12, 0.80, 40, 0.00, 3, 1.00, 0, 0), (3, 0.00, 2, 1.00, 2, 1.00, 0, 0),
    (5, 0.00, 3, 1.00, 4, 1.00, 0, 0), (9, 0.20, 33, 0.00, 0, 0.00, 0, 0), (26, 0.70, 5, 1.00, 8, 1.00, 0, 0),
    (4, 0.00, 5, 1.00, 6, 1.00, 1, 0), (2, 0.00, 40, 0.00, 0, 0.00, 0, 0),
    (2, 1.00, 0, 0.00, 40, 0.00, 0, 0), (6, 1.00, 33, 0.00, 60, 0.00, 0, 0), (15, 0.90, 0, 0.00, 75, 0.00, 0, 0),
    (3, 0.70, 80, 0.00, 35, 0.00, 0, 0), (5, 1.00, 2, 0.00, 120, 0.00, 0, 0), (40, 0.80, 60, 0.00, 30, 0.00, 0, 0),
)
#: words from which a block with few links beside the main container is main text
BESIDE_WORDS = 30
#: the whole table: blocks of any such shape are main text inside the main
#: container, are not where text is never main, and must be longer beside it
LABELLED = (tuple((*r[:-1], UNKNOWN, r[-1]) for r in FLAT)
            + tuple((*r[:-1], BESIDE, int(r[-1] and r[0] >= BESIDE_WORDS)) for r in FLAT)
            + tuple((*r[:-1], place, int(place == INSIDE)) for r in FLAT for place in (OUTSIDE, INSIDE)))


def train_tree(table=LABELLED, depth: int = 8):
    """A tree as nested tuples (feature, bound, low, high), leaves 0 or 1."""
    rows = np.array(table, "f8")

    def gini(y: np.ndarray) -> float:
        p = y.mean() if len(y) else 0.0
        return len(y) * 2 * p * (1 - p)

    def grow(rows: np.ndarray, left: int):
        y = rows[:, -1]
        leaf = int(y.mean() >= 0.5)
        if left == 0 or len(set(y)) == 1:
            return leaf
        best = (gini(y) - 1e-9, None, None)
        for f in range(rows.shape[1] - 1):
            values = np.unique(rows[:, f])
            for bound in (values[1:] + values[:-1]) / 2:
                low = rows[:, f] <= bound
                best = min(best, (gini(y[low]) + gini(y[~low]), f, float(bound)), key=lambda x: x[0])
        if best[1] is None:
            return leaf
        low = rows[:, best[1]] <= best[2]
        return best[1], best[2], grow(rows[low], left - 1), grow(rows[~low], left - 1)

    return grow(rows, depth)


def decide(tree, features) -> int:
    while not isinstance(tree, int):
        tree = tree[2] if features[tree[0]] <= tree[1] else tree[3]
    return tree


def _never(tag: str, attributes: str, in_main: bool) -> bool:
    if tag in NEVER or tag == "header" and not in_main:
        return True
    if tag in ("body", "html") or not attributes:
        return False
    words = (w for _, v in ATTRIBUTE.findall(attributes) for w in re.split(r"[^a-z]+", v.lower()))
    return any(w in NEVER_WORDS for w in words)


def blocks_of(page: str) -> list[dict]:
    """The page's text blocks: text, words, link words and flags."""
    out: list[dict] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, in main, never main text
    buffer: list[tuple[str, bool]] = []
    at, link, heading = 0, False, False

    def flush() -> None:
        text = " ".join(entities.unescape("".join(t for t, _ in buffer)).split())
        if text:
            linked = sum(len(WORD.findall(t)) for t, in_link in buffer if in_link)
            n = len(text.split(" "))
            _, main, never = stack[-1] if stack else ("", False, False)
            out.append({"text": text, "words": n, "links": min(1.0, linked / n), "heading": heading, "in_main": main, "never": never})
        buffer.clear()

    n = len(page)
    while at < n:
        start = page.find("<", at)
        if start < 0:
            start = n
        if start > at:
            buffer.append((page[at:start], link))
        if start == n:
            break
        m = TOKEN.match(page, start)
        if not m:
            broken = BROKEN.match(page, start)
            if broken:
                at = broken.end()
            else:
                buffer.append(("<", link))
                at = start + 1
            continue
        at = m.end()
        if not m[2]:
            continue
        closing, tag, attributes = m[1], m[2].lower(), m[3]
        if tag in RAW:
            if not closing and not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}[^>]*+(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else n
            continue
        if tag == "a":
            link = not closing
        elif tag == "br":
            buffer.append((" ", link))
        elif tag in BREAKS:
            flush()
            link, heading = False, tag in HEADINGS and not closing
            if tag in CONTAINERS or tag == "button":
                if closing:
                    if any(s[0] == tag for s in stack):
                        while stack.pop()[0] != tag:
                            pass
                else:
                    _, main, never = stack[-1] if stack else ("", False, False)
                    stack.append((tag, main or tag in MAIN, never or _never(tag, attributes, main)))
    flush()
    return out


def main_text(page: str, tree) -> str:
    """The blocks that the tree takes for main text, one per line."""
    blocks = blocks_of(page)
    has_main = any(b["in_main"] and not b["never"] for b in blocks)
    edge = {"words": 0, "links": 0.0}
    chosen = []
    for before, b, after in zip([edge, *blocks], blocks, [*blocks[1:], edge]):
        features = (b["words"], b["links"], before["words"], before["links"], after["words"], after["links"],
                    b["heading"], OUTSIDE if b["never"] else INSIDE if b["in_main"] else BESIDE if has_main else UNKNOWN)
        if decide(tree, features):
            chosen.append(b["text"])
    return "\n".join(chosen)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    tree = train_tree()

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [main_text(h or "", tree) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"])

    rows = with_defaults(pages, page_id="bigint", url="string", html="string")
    return (rows.mapInArrow(texts, "page_id bigint, url string, text string")
            .select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars")))
