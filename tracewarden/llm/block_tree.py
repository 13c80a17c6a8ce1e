"""Main text of web pages from flat text blocks.

A page becomes a flat list of text blocks. Each block is described by word count and link density
of itself and its two neighbours and by the kind of container it stands in, and a decision tree
trained on the small labelled table below keeps or drops it.
"""

from __future__ import annotations

import html
import re

import numpy as np
from pyspark.sql import DataFrame

from tracewarden.llm.common import map_batches, strings

# HTML element names by their part in a page
BLOCK = set("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
            "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
SKIPPED = set("script style head noscript template iframe object svg math canvas select textarea button audio video title".split())
CONTAINERS = set("article aside body div dl fieldset figure footer form header main menu nav ol section table ul details dialog".split())
CONTENT = {"article", "main"}
FRAME = {"nav", "footer", "aside", "form", "menu", "dialog", "fieldset"}
# Words of class, id and role that mark what is not the article
HINTS = set("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
            "masthead menu modal nav navbar navigation newsletter notice pagination popup promo related replies reply share sharing "
            "sidebar signup skip social sponsor sponsored subscribe toolbar widget".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_NAMING = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_PART = re.compile(r"[a-z]+|[A-Z][a-z]*")
_SPACE = re.compile(r"\s+")

COLUMNS = ("words", "link_density", "words_before", "links_before", "words_after", "links_after", "in_content", "in_frame")
# words, link density, of the block, the one before and the one after; inside article or main;
# inside a menu, footer, advert or the like; 1 = main text
LABELLED = [
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 1, 0), (1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0), (2, 1.0, 1, 1.0, 5, 0.0, 0, 1, 0),
    (5, 0.0, 1, 1.0, 8, 0.0, 0, 1, 0), (9, 0.0, 30, 0.0, 0, 0.0, 0, 1, 0), (25, 0.0, 60, 0.0, 0, 0.0, 0, 1, 0),
    (40, 0.1, 50, 0.0, 12, 0.0, 0, 1, 0), (60, 0.0, 8, 0.0, 70, 0.0, 0, 1, 0), (12, 0.0, 90, 0.0, 40, 0.0, 1, 1, 0),
    (40, 0.0, 60, 0.0, 15, 0.0, 1, 1, 0), (3, 0.7, 20, 0.0, 4, 0.6, 1, 1, 0), (110, 0.0, 30, 0.0, 3, 0.0, 1, 1, 0),
    (8, 0.0, 5, 0.0, 30, 0.0, 1, 0, 1), (3, 0.0, 40, 0.0, 50, 0.0, 1, 0, 1), (60, 0.0, 8, 0.0, 3, 0.0, 1, 0, 1),
    (120, 0.1, 60, 0.0, 80, 0.0, 1, 0, 1), (1, 0.0, 60, 0.0, 9, 0.0, 1, 0, 1), (20, 0.4, 80, 0.0, 40, 0.0, 1, 0, 1),
    (5, 1.0, 40, 0.0, 30, 0.0, 1, 0, 1), (2, 1.0, 0, 0.0, 40, 0.0, 1, 0, 1), (35, 0.0, 2, 0.0, 0, 0.0, 1, 0, 1),
    (50, 0.0, 6, 0.0, 45, 0.0, 0, 0, 1), (80, 0.05, 50, 0.0, 60, 0.0, 0, 0, 1), (25, 0.1, 70, 0.0, 30, 0.0, 0, 0, 1),
    (6, 0.0, 2, 0.0, 55, 0.0, 0, 0, 1), (18, 0.2, 40, 0.0, 22, 0.0, 0, 0, 1), (4, 0.0, 60, 0.0, 70, 0.0, 0, 0, 1),
    (2, 1.0, 2, 1.0, 2, 1.0, 0, 0, 0), (4, 0.9, 30, 0.1, 3, 1.0, 0, 0, 0), (12, 0.8, 3, 1.0, 10, 0.9, 0, 0, 0),
    (3, 0.0, 2, 1.0, 2, 1.0, 0, 0, 0), (5, 0.6, 1, 1.0, 4, 0.8, 0, 0, 0), (30, 0.9, 20, 0.9, 25, 0.8, 0, 0, 0),
]


def train_tree(rows=LABELLED, depth: int = 6):
    """A decision tree by Gini impurity: (column, bound, low branch, high branch) or a label."""
    data = np.asarray(rows, float)
    x, y = data[:, :-1], data[:, -1]

    def gini(part):
        p = part.mean() if len(part) else 0.0
        return len(part) * p * (1 - p)

    def grow(index, left):
        label = int(y[index].mean() >= 0.5)
        best = (gini(y[index]) - 1e-9, None)
        if left:
            for c in range(x.shape[1]):
                values = np.unique(x[index, c])
                for bound in (values[1:] + values[:-1]) / 2:
                    low = x[index, c] <= bound
                    cost = gini(y[index][low]) + gini(y[index][~low])
                    if cost < best[0] - 1e-12:
                        best = (cost, (c, bound, index[low], index[~low]))
        if best[1] is None:
            return label
        c, bound, low, high = best[1]
        return c, bound, grow(low, left - 1), grow(high, left - 1)

    return grow(np.arange(len(y)), depth)


def classify(tree, features) -> int:
    while isinstance(tree, tuple):
        c, bound, low, high = tree
        tree = low if features[c] <= bound else high
    return tree


def _hinted(attributes: str) -> bool:
    return any(part.lower() in HINTS for value in _NAMING.findall(attributes) for part in _PART.findall(value))


def blocks(page: str) -> list[tuple[str, int, int, bool, bool]]:
    """(text, words, linked words, in content, in frame) of every text block, in page order."""
    out, stack = [], []
    parts: list[tuple[str, bool]] = []
    in_link, own_hint, at = False, False, 0

    def flush():
        nonlocal parts
        text = _SPACE.sub(" ", html.unescape("".join(p for p, _ in parts))).strip()
        if text:
            linked = sum(len(html.unescape(p).split()) for p, link in parts if link)
            content = any(tag in CONTENT for tag, _ in stack)
            frame = own_hint or any(flag for _, flag in stack)
            out.append((text, len(text.split()), linked, content, frame))
        parts = []

    end = len(page)
    while at < end:
        found = _TOKEN.search(page, at)
        if not found:
            # a tag cut off by the end of the page is markup, a lone < is text
            parts.append((page[at:], in_link))
            break
        if found.start() > at:
            parts.append((page[at:found.start()], in_link))
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        closing = bool(found[1])
        if tag in SKIPPED:
            if not closing and not found[3].endswith("/"):
                close = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
                at = close.end() if close else end
            continue
        if tag == "a":
            in_link = not closing
        elif tag == "br":
            parts.append((" ", in_link))
        if tag not in BLOCK:
            continue
        flush()
        in_link, own_hint = False, False
        if tag in CONTAINERS:
            if not closing:
                inside = any(t in CONTENT for t, _ in stack)
                frame = tag in FRAME or (tag == "header" and not inside) or (tag != "body" and tag not in CONTENT and _hinted(found[3]))
                stack.append((tag, frame))
            elif any(t == tag for t, _ in stack):
                while stack.pop()[0] != tag:
                    pass
        elif not closing:
            own_hint = _hinted(found[3])
    flush()
    return out


def main_text(page: str, tree) -> str:
    found = blocks(page)
    kept = []
    for i, (text, words, linked, content, frame) in enumerate(found):
        around = [(found[j][1], found[j][2] / found[j][1]) if 0 <= j < len(found) and found[j][1] else (0, 0.0) for j in (i - 1, i + 1)]
        if classify(tree, (words, linked / max(words, 1), *around[0], *around[1], content, frame)):
            kept.append(text)
    return "\n".join(kept)


def extract_pages(pages: DataFrame, labelled=None) -> DataFrame:
    """page_id, url, text, n_chars of every row.

    Null and empty pages and pages without main text give the empty text; pages cut off in a tag
    lose the cut tag only. Repeated rows and null ids or urls are kept; an empty table gives an
    empty result; other columns are not read.
    """
    tree = train_tree(labelled or LABELLED)

    def make():
        def step(batch):
            texts = [main_text(p, tree) for p in strings(batch, "html")]
            return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts, "n_chars": [len(t) for t in texts]}
        return step

    return map_batches(pages.select("page_id", "url", "html"), make, "page_id long, url string, text string, n_chars long")
