"""Main text of web pages: flat text blocks, their numbers and their neighbours', and a decision tree.

A page becomes a flat list of blocks. A block is described by its words and link density, those of
the blocks before and after it, and by where it stands; a decision tree trained on the labelled
blocks below tells article text from the rest.
"""

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from souk.llm.arrays import pieces

# Elements whose text is never shown as text, elements that break blocks, and elements that hold blocks.
HIDDEN = "script style noscript template svg title iframe textarea select option math object canvas audio video button".split()
BREAKING = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul legend caption label input".split()
)
HOLDING = frozenset(
    "article aside blockquote body center details dialog div dl fieldset figure footer form head header html li main menu nav ol "
    "section table td ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
FURNITURE = frozenset("aside dialog footer form head header menu nav fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Parts of class, id and role names of what stands beside an article.
FURNITURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments consent cookie cookies disclaimer "
    "disqus footer form gdpr header hidden legal login masthead menu modal nav navbar navigation newsletter notice notices popup promo promoted "
    "promotion related reply replies search share sharing sidebar signup skip social sponsor sponsored subscribe tags toolbar "
    "widget contentinfo complementary alert dialog respond discussion reader".split()
)

TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)"
    rf"|(?P<hidden>{'|'.join(HIDDEN)})(?=[\s>/])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=hidden)\s*>|\Z)"
    r"|(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>"
    r"|[!?/][^>]*>"
    r"|/?[a-zA-Z][^<>]*\Z)",
    re.S | re.I,
)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
CONCEALED = re.compile(r"\shidden(?=[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)

COLUMNS = ("words", "links", "before_words", "before_links", "after_words", "after_links", "furniture", "outside", "heading")

# The labelled table: the numbers of COLUMNS, then 1 for article text. Fixed values.
LABELLED = (
    # in the article: paragraphs of any length, headings, short lines between long ones
    (60, 0.0, 9, 0.0, 80, 0.0, 0, 0, 0, 1),
    (45, 0.05, 60, 0.0, 12, 0.0, 0, 0, 0, 1),
    (1, 0.0, 70, 0.0, 90, 0.0, 0, 0, 0, 1),
    (2, 0.0, 40, 0.0, 0, 0.0, 0, 0, 0, 1),
    (5, 0.0, 0, 0.0, 30, 0.0, 0, 0, 0, 1),
    (9, 0.0, 8, 0.0, 50, 0.0, 0, 0, 1, 1),
    (3, 0.0, 0, 0.0, 3, 0.0, 0, 0, 1, 1),
    (4, 0.0, 55, 0.0, 6, 0.1, 0, 0, 0, 1),
    (300, 0.02, 0, 0.0, 0, 0.0, 0, 0, 0, 1),
    (25, 0.3, 33, 0.0, 41, 0.0, 0, 0, 0, 1),
    (14, 0.2, 3, 1.0, 30, 0.0, 0, 0, 0, 1),
    (12, 0.0, 1, 1.0, 7, 0.3, 0, 0, 0, 1),
    (110, 0.1, 2, 1.0, 4, 1.0, 0, 0, 0, 1),
    (7, 0.0, 7, 0.0, 7, 0.0, 0, 0, 0, 1),
    (33, 0.4, 20, 0.1, 18, 0.0, 0, 0, 0, 1),
    (3, 0.33, 48, 0.0, 52, 0.0, 0, 0, 0, 1),
    # lists of links and single links
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 0, 0),
    (2, 1.0, 0, 0.0, 1, 1.0, 0, 0, 0, 0),
    (3, 1.0, 2, 1.0, 60, 0.0, 0, 0, 0, 0),
    (8, 0.9, 40, 0.0, 8, 1.0, 0, 0, 0, 0),
    (6, 1.0, 90, 0.0, 0, 0.0, 0, 0, 0, 0),
    (12, 0.75, 3, 1.0, 2, 1.0, 0, 0, 0, 0),
    (20, 0.8, 4, 1.0, 5, 1.0, 0, 0, 0, 0),
    # within menus, adverts, notices, forms, comments
    (1, 1.0, 0, 0.0, 1, 1.0, 1, 0, 0, 0),
    (12, 0.0, 1, 1.0, 9, 0.0, 1, 0, 0, 0),
    (9, 0.0, 1, 1.0, 60, 0.0, 1, 1, 0, 0),
    (80, 0.0, 70, 0.0, 90, 0.0, 1, 1, 0, 0),
    (55, 0.02, 60, 0.0, 44, 0.0, 1, 0, 0, 0),
    (14, 0.1, 75, 0.0, 0, 0.0, 1, 1, 0, 0),
    (4, 0.0, 20, 0.0, 30, 0.0, 1, 0, 1, 0),
    (3, 0.0, 60, 0.0, 25, 0.0, 1, 1, 1, 0),
    (200, 0.0, 0, 0.0, 0, 0.0, 1, 0, 0, 0),
    # beside the article of a page that has one
    (30, 0.0, 9, 0.0, 60, 0.0, 0, 1, 0, 0),
    (6, 0.0, 80, 0.0, 5, 0.0, 0, 1, 0, 0),
    (70, 0.0, 60, 0.0, 80, 0.0, 0, 1, 0, 0),
    (3, 0.0, 10, 0.0, 40, 0.0, 0, 1, 1, 0),
    (2, 1.0, 50, 0.0, 2, 1.0, 0, 1, 0, 0),
)


@dataclass
class Node:
    column: int = -1
    limit: float = 0.0
    low: "Node | None" = None
    high: "Node | None" = None
    main: bool = False


def train(rows: np.ndarray, least: int = 1) -> Node:
    """A tree that splits by Gini impurity until its leaves are pure; ties go to the first column and the lowest limit."""
    y = rows[:, -1]
    node = Node(main=bool(2 * y.sum() > len(y)))
    if y.min() == y.max():
        return node
    best = (1.0, -1, 0.0)
    for c in range(rows.shape[1] - 1):
        values = np.unique(rows[:, c])
        for limit in (values[1:] + values[:-1]) / 2:
            low = rows[:, c] <= limit
            impurity = sum(part.mean() * (1 - part.mean()) * len(part) for part in (y[low], y[~low])) / len(y)
            if min(low.sum(), (~low).sum()) >= least and impurity < best[0] - 1e-12:
                best = (impurity, c, limit)
    if best[1] < 0:
        return node
    node.column, node.limit = best[1], best[2]
    low = rows[:, node.column] <= node.limit
    node.low, node.high = train(rows[low], least), train(rows[~low], least)
    return node


@cache
def tree() -> Node:
    return train(np.array(LABELLED, float))


def decide(node: Node, values: list[float]) -> bool:
    while node.column >= 0:
        node = node.low if values[node.column] <= node.limit else node.high
    return node.main


@dataclass
class Block:
    text: str
    words: int
    links: float
    furniture: bool
    article: bool
    heading: bool


def _beside(name: str, rest: str, in_article: bool) -> bool:
    """Whether an element holds what stands beside an article."""
    if name in FURNITURE and not (name == "header" and in_article):
        return True
    if not rest or name in ("html", "body", "article", "main"):
        return False
    if CONCEALED.search(rest):
        return True
    parts = {p.lower() for m in NAMES.finditer(rest) for p in NAME_PARTS.findall(m[1] or m[2] or m[3] or "")}
    return not FURNITURE_NAMES.isdisjoint(parts)


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order. Markup that is broken off or not closed ends with the page."""
    out: list[Block] = []
    held: list[tuple[str, bool, bool]] = []  # name, beside, article
    parts: list[tuple[str, bool]] = []
    state = [False, False]  # beside, in an article
    in_link = heading = False

    def flush() -> None:
        if parts:
            raw = "".join(p for p, _ in parts)
            text = " ".join(html.unescape(raw).split())
            if text:
                words = text.count(" ") + 1
                linked = sum(len(html.unescape(p).split()) for p, link in parts if link)
                out.append(Block(text, words, min(1.0, linked / words), state[0], state[1], heading))
            parts.clear()

    def settle() -> None:
        state[0] = any(h[1] for h in held)
        state[1] = any(h[2] for h in held)

    pos = 0
    for m in TAG.finditer(page):
        if m.start() > pos:
            parts.append((page[pos : m.start()], in_link))
        pos = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        closing = bool(m["end"])
        if name == "a":
            in_link = not closing
            continue
        if name == "br":
            parts.append((" ", in_link))
            continue
        breaking = name in BREAKING
        if breaking:
            flush()
        if name in HEADINGS:
            heading = not closing
        if closing:
            if any(h[0] == name for h in held):
                flush()
                _close(held, name)
                settle()
            if breaking:
                in_link = False
            continue
        if name == "p" and any(h[0] == "p" for h in held):
            _close(held, "p")  # a paragraph ends where the next begins
            settle()
        beside = _beside(name, m["rest"], state[1])
        if (name in HOLDING or beside and name not in VOID) and not m["rest"].endswith("/"):
            flush()
            held.append((name, beside, name in ("article", "main")))
            settle()
    if pos < len(page):
        parts.append((page[pos:], in_link))
    flush()
    return out


def _close(held: list[tuple[str, bool, bool]], name: str) -> None:
    """Leaves the innermost open element of this name and all within it; a stray end tag does nothing."""
    for k in range(len(held) - 1, -1, -1):
        if held[k][0] == name:
            del held[k:]
            return


def main_text(page: str) -> str:
    """The article's blocks, one a line."""
    found = blocks(page)
    has_article = any(b.article for b in found)
    root = tree()
    kept = []
    for k, b in enumerate(found):
        before = found[k - 1] if k else None
        after = found[k + 1] if k + 1 < len(found) else None
        values = [b.words, b.links]
        for other in (before, after):
            values += [other.words, other.links] if other else [0, 0.0]
        if decide(root, [*values, b.furniture, has_article and not b.article, b.heading]):
            kept.append(b.text)
    return "\n".join(kept)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` without the html column, with ``text`` and ``n_chars`` of the main text; columns of these names are replaced.

    A null or empty page, or one without article text, has the empty text. All rows are kept; an empty table gives no rows.
    """
    rest = pages.drop("text", "n_chars") if html_col not in ("text", "n_chars") else pages
    names = [c for c in rest.columns if c != html_col]
    rest = rest.select(*names, html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = [main_text(page) if page else "" for page in batch.column(len(names)).to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(len(names))), pa.array(texts, pa.string()), sizes], [*names, "text", "n_chars"]
            )

    schema = StructType([f for f in rest.schema.fields if f.name != html_col]).add("text", "string").add("n_chars", "long")
    return rest.mapInArrow(run, schema)
