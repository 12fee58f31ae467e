"""Main text of web pages: flat text blocks, classified by a decision tree over their and their neighbours' features.

A page is cut at block-level tags into a flat list of text blocks. A block has its word count, its link density, the
same of the block before and after, and what its open elements and their class, id and role names say. An element that is
named or made like a menu, a form or the like but holds nearly all words of the page says nothing. A decision tree, grown
once on a table of blocks that rules make from page layouts and contents (`labelled_pages`), tells main text from the rest.

Defined cases: null html and pages without main text give an empty text; tags that never close end with the page;
a page cut anywhere keeps what stands before the cut; scripts, styles, comments and controls of forms never give text;
very long pages are read in one pass; `<br>`
is white space inside a block; white space of any kind becomes one space; equal rows are extracted one by one;
extra columns are ignored.
"""

from __future__ import annotations

import html
import random
import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trackloom.llm.common import ship, slices, strings

#: elements whose tags end a text block
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre search section select summary table tbody "
    "td template tfoot th thead title tr ul".split()
)
#: elements whose content is never text of the page
SILENT = frozenset("script style noscript template svg math iframe object canvas audio video select textarea button title label legend datalist".split())
#: of these the content is read up to the end tag, whatever it looks like
RAW = frozenset("script style textarea title iframe noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CHROME = frozenset("nav aside footer form header dialog menu search".split())
# fixed words of class, id and role names: what ends the name of a part that is not main text, what begins one, and what
# makes a name speak of the whole page instead
_PARTS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar side aside footer foot header masthead banner ad ads advert advertisement "
    "sponsor sponsored promo cookie cookies consent gdpr notice notices alert disclaimer popup modal overlay comments comment replies reply disqus "
    "respond share sharing social related recommended recommendations newsletter subscribe signup login search widget widgets toolbar pagination "
    "pager tags copyright legal skip".split()
)
_BEGINS = frozenset("ad ads advert cookie consent gdpr comment comments newsletter related share social sponsor promo popup sidebar nav menu footer breadcrumb".split())
_WHOLE = frozenset("has no with without is enabled disabled page layout open closed content body main site wrapper template".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|$)", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_CLOSES_P = BLOCKS - {"p"} | {"p"}

FEATURES = (
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "chrome", "named",
    "article", "heading", "list_item", "paragraph", "has_article",
)
#: an element with more than this share of the page's unlinked words is the page, whatever it is called
PAGE_SHARE = 0.8


def is_part(name: str) -> bool:
    """Whether one class, id or role names a part of the page that is not its text."""
    words = re.split(r"[-_]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower().strip("-_"))
    if words[0] in _WHOLE or words[-1] in _WHOLE:
        return False
    return words[-1] in _PARTS or words[0] in _BEGINS


class _Block:
    __slots__ = ("parts", "linked", "flags", "context", "marked")

    def __init__(self, flags, context, marked):
        self.parts, self.linked, self.flags, self.context, self.marked = [], [], flags, context, marked


def blocks(page: str) -> list[tuple[str, list[float], bool]]:
    """(text, features, carries the label attribute data-main) of every non-empty block in page order."""
    found: list[_Block] = []
    # per open element: tag, flags (number, by name) of it and those around it, (article, heading, list item, paragraph), silent, marked
    stack: list[tuple] = [("", (), (False,) * 4, False, False)]
    links = number = 0
    block = None

    def text(raw: str) -> None:
        nonlocal block
        top = stack[-1]
        if top[3] or not raw:
            return
        if block is None:
            block = _Block(top[1], top[2], top[4])
            found.append(block)
        (block.linked if links else block.parts).append(raw)
        if links:
            block.parts.append(raw)

    at = 0
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag == "br":
            text(" ")
            continue
        if tag in BLOCKS:
            block = None
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        if tag == "a":
            links += 1
        if tag in VOID:
            continue
        if tag in _CLOSES_P and stack[-1][0] == "p":
            stack.pop()
        if tag in ("li", "dt", "dd", "td", "th", "tr", "option") and stack[-1][0] == tag:
            stack.pop()
        _, flags, (article, heading, item, paragraph), silent, marked = stack[-1]
        attributes = {a.lower(): b or c or d for a, b, c, d in _ATTRIBUTE.findall(m[3])} if m[3].strip() else {}
        names = [n for a in ("class", "id", "role") for n in attributes.get(a, "").split()]
        hidden = "hidden" in attributes or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", "")) is not None
        chrome = tag in _CHROME and not (tag == "header" and article) or attributes.get("role") in ("navigation", "banner", "contentinfo", "search", "complementary")
        named = tag not in ("html", "body", "article", "main") and any(map(is_part, names))
        if chrome or named:
            number += 1
            flags = (*flags, (number, named and not chrome))
        stack.append((
            tag,
            flags,
            (
                (article or tag in ("article", "main") or attributes.get("role") == "main") and tag not in ("aside", "nav", "footer"),
                tag in ("h1", "h2", "h3", "h4", "h5", "h6") or heading,
                item or tag in ("li", "dd", "dt"),
                paragraph or tag in ("p", "blockquote", "pre"),
            ),
            silent or tag in SILENT or hidden and tag not in ("html", "body"),
            marked or "data-main" in attributes,
        ))
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)

    flat, held, total = [], {}, 0
    for b in found:
        words = html.unescape("".join(b.parts)).split()
        if words:
            linked = len(html.unescape("".join(b.linked)).split())
            own = max(0, len(words) - linked)
            total += own
            for k, _ in b.flags:
                held[k] = held.get(k, 0) + own
            flat.append((" ".join(words), len(words), min(1.0, linked / len(words)), b))
    page_wide = {k for k, n in held.items() if n > PAGE_SHARE * total}
    has_article = any(b.context[0] for *_, b in flat)
    out = []
    for i, (t, n, density, b) in enumerate(flat):
        before = flat[i - 1][1:3] if i else (0, 0.0)
        after = flat[i + 1][1:3] if i + 1 < len(flat) else (0, 0.0)
        flags = [by_name for k, by_name in b.flags if k not in page_wide]
        row = [n, density, *before, *after, not all(flags), any(flags), *b.context, has_article]
        out.append((t, list(map(float, row)), b.marked))
    return out


# Labelled pages: blocks under data-main are main text, all others are not. Own examples of common page layouts.
_W = "the garden was quiet that morning and nobody had yet opened the gate to the long road by the river".split()


def _say(n: int, shift: int = 0) -> str:
    return " ".join(_W[(i + shift) % len(_W)] for i in range(n)).capitalize() + "."


def _links(n: int) -> str:
    return "".join(f'<li><a href="/{i}">{_W[i % len(_W)]} {_W[(i + 3) % len(_W)]}</a></li>' for i in range(n))


def _paragraphs(*sizes: int) -> str:
    return "".join(f"<p>{_say(n, n)}</p>" for n in sizes)


def _own_pages() -> list[str]:
    nav, foot = f"<nav><ul>{_links(6)}</ul></nav>", "<footer>&copy; example &middot; " + _say(8) + "</footer>"
    return [
        f'<body>{nav}<div class="ad">{_say(12)}</div><article data-main><h1>{_say(8)}</h1>{_paragraphs(60, 4, 90, 1, 30)}</article>{foot}</body>',
        f'<body>{nav}<div class="ad">{_say(9)}</div><article data-main><h1>{_say(5)}</h1><p><b>{_say(40)}<br>{_paragraphs(80, 2)}</article>{foot}',
        f'<body><div class="ad">{_say(30)}</div><article data-main><p>{_say(1)}</p></article>{foot}</body>',
        f'<body><article data-main><h2>{_say(3)}</h2><ul>{"".join(f"<li>{_say(n)}</li>" for n in (9, 3, 14))}</ul></article>{foot}</body>',
        f'<body><header><h1>{_say(3)}</h1><p>{_say(9)}</p></header>{nav}<main><div data-main><h1>{_say(6)}</h1>{_paragraphs(45, 70)}</div>'
        f'<aside><h3>{_say(2)}</h3><p>{_say(35)}</p></aside></main>{foot}</body>',
        f'<body><div id="menu">{_say(4)}<ul>{_links(5)}</ul></div><div id="content"><div data-main><h1>{_say(6)}</h1>{_paragraphs(55, 25, 80)}</div>'
        f'<div class="comments"><h3>{_say(2)}</h3><p>{_say(40)}</p><p>{_say(18)}</p></div></div><div id="footer">{_say(12)}</div></body>',
        f'<body><div class="cookie-notice"><p>{_say(30)}</p></div><div><div data-main><h1>{_say(5)}</h1>{_paragraphs(40, 33, 70)}</div></div>'
        f"<div>{_say(4)} <a href=/x>{_say(3)}</a> <a href=/y>{_say(3)}</a></div></body>",
        f'<body><ul>{_links(8)}</ul><div data-main><h1>{_say(7)}</h1>{_paragraphs(66, 48)}<p>{_say(30)} <a href=/z>{_say(3)}</a> {_say(20)}</p></div>'
        f"<ul>{_links(9)}</ul><p><a href=/t>{_say(4)}</a></p></body>",
        f'<body>{nav}<form><label>{_say(3)}</label><p>{_say(22)}</p></form><article><div data-main>{_paragraphs(50, 61)}</div>'
        f'<section class="comments"><p>{_say(44)}</p><p>{_say(21)}</p></section><div class="share">{_say(4)}</div></article>{foot}</body>',
        f'<body><article><div data-main><h1>{_say(6)}</h1>{_paragraphs(40)}</div><aside><p>{_say(25)}</p></aside><div data-main>{_paragraphs(52, 7)}</div>'
        f'<div class="ad">{_say(20)}</div><div data-main>{_paragraphs(35)}</div><nav>{_links(4)}</nav></article>{foot}</body>',
        f'<body><table><tr><td><a href=/a>{_say(2)}</a></td><td><a href=/b>{_say(2)}</a></td></tr></table><div data-main>{_paragraphs(75, 58)}</div>'
        f"<div>{_say(5)}</div><div>{_say(3)}</div></body>",
        f'<body><div id="cookie-consent">{_say(15)}</div>{nav}<main data-main><h1>{_say(9)}</h1>{_paragraphs(3, 22, 5)}</main>'
        f'<div class="newsletter"><p>{_say(16)}</p></div><div class="sidebar"><p>{_say(50)}</p><ul>{_links(5)}</ul></div>{foot}</body>',
        f'<body>{nav}<article data-main><blockquote><p>{_say(28)}</p></blockquote><p>{_say(12)} <a href=/q>{_say(10)}</a></p>{_paragraphs(2, 2)}</article>'
        f'<div class="related"><h3>{_say(2)}</h3><ul>{_links(6)}</ul></div>{foot}</body>',
        f'<body>{nav}<article><header data-main><h1>{_say(5)}</h1></header><div data-main>{_paragraphs(44)}</div><form><p>{_say(3)}</p><p>{_say(18)}</p></form>'
        f"<div data-main>{_paragraphs(50, 9)}</div><form><label>{_say(2)}</label></form><dialog><p>{_say(33)}</p></dialog></article>{foot}</body>",
        f'<body>{nav}<main><div data-main>{_paragraphs(38, 6)}</div><form><p>{_say(60)}</p></form><div data-main>{_paragraphs(12)}</div></main>{foot}</body>',
    ]


def _contents() -> list[str]:
    """What the main text of a page can be made of."""
    items = lambda *sizes: "".join(f"<li>{_say(n, n)}</li>" for n in sizes)
    sizes = random.Random(7)
    mixed = [[round(sizes.choice((1, 3, 9, 27, 81, 243)) * sizes.uniform(1, 3)) for _ in range(7)] for _ in range(12)]
    return [
        *(f"<h1>{_say(4 + len(m) % 5)}</h1>{_paragraphs(*m)}" for m in mixed),
        f"<h1>{_say(8)}</h1>{_paragraphs(60, 4, 90, 1, 30)}",
        _paragraphs(20, 20, 20),
        f"<h2>{_say(3)}</h2><ul>{items(9, 13, 14)}</ul>{_paragraphs(25)}",
        f"<h1>{_say(5)}</h1><p>{_say(20)} <a href=/z>{_say(3)}</a> {_say(14)}</p><p><a href=/y>{_say(6)}</a> {_say(16)}</p>{_paragraphs(33)}",
        f"<h1>{_say(4)}</h1><blockquote>{_say(28)}</blockquote><pre>{_say(12)}</pre>{_paragraphs(45, 8, 12)}",
        _paragraphs(120),
        f"<h2>{_say(4)}</h2>{_paragraphs(18)}<h3>{_say(2)}</h3>{_paragraphs(31, 15)}<ol>{items(16, 11)}</ol>",
    ]


def _layouts(c: str) -> list[str]:
    """Pages of unlike make around the main text `c`."""
    nav, foot = f"<nav><ul>{_links(6)}</ul></nav>", f"<footer>&copy; example &middot; {_say(8)}</footer>"
    menu, teaser = f"<ul>{_links(7)}</ul>", f"<p><a href=/m>{_say(14)}</a></p>"
    main = f"<div data-main>{c}</div>"
    return [
        f'<body>{nav}<div class="ad">{_say(12)}</div><article data-main>{c}</article>{foot}</body>',
        f"<body>{menu}{main}{menu}<p><a href=/t>{_say(4)}</a></p></body>",
        f'<body><div class="has-sidebar">{menu}{main}<div class="sidebar"><h3>{_say(2)}</h3><p>{_say(25)}</p>{menu}</div></div></body>',
        f"<body><form action=/><label>{_say(3)}</label><input name=q><button>{_say(1)}</button>{menu}{main}</form></body>",
        f'<body>{nav}<article class="post share-enabled">{main}<div class="share">{_say(4)}</div><section id="comments"><p>{_say(24)}</p><p>{_say(11)}</p></section></article></body>',
        f'<body><div id="top" class="tags-page">{menu}{main}<div class="tags">{menu}</div></div><div id="site-footer">{_say(12)}</div></body>',
        f"<body><table><tr><td>{menu}</td><td>{main}</td></tr></table></body>",
        f'<body><header><h1>{_say(3)}</h1><p>{_say(9)}</p></header><main>{main}<aside><p>{_say(30)}</p></aside></main><dialog><p>{_say(22)}</p></dialog>{foot}</body>',
        f"<body data-main>{c}</body>",
        f"<body>{teaser}{main}{teaser}<p><a href=/l>{_say(40)}</a></p></body>",
        f'<body><div class="cookie-notice"><p>{_say(20)}</p></div>{main}<div class="related-posts"><h3>{_say(2)}</h3>{menu}</div></body>',
        f"<body>{nav}<article>{main}<p><a href=/l>{_say(40)}</a></p></article>{foot}</body>",
    ]


def labelled_pages() -> list[str]:
    """Blocks under data-main are main text, all others are not."""
    bare = [f"<div data-main>{_say(n)}</div>" for n in (30, 80, 200)]
    return [*_own_pages(), *(page for c in _contents() for page in _layouts(c)), *bare]


class Tree:
    """A binary decision tree grown by Gini impurity, kept as arrays."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 14, least: int = 1):
        self.feature, self.cut, self.low, self.high, self.value = [], [], [], [], []
        self._grow(x, y, depth, least)

    def _grow(self, x, y, depth, least) -> int:
        node = len(self.value)
        for store, v in ((self.feature, -1), (self.cut, 0.0), (self.low, -1), (self.high, -1), (self.value, float(y.mean()))):
            store.append(v)
        best = None
        if depth and 0 < y.sum() < len(y):
            for f in range(x.shape[1]):
                values = np.unique(x[:, f])
                for cut in (values[1:] + values[:-1]) / 2:
                    left = x[:, f] <= cut
                    a, b = y[left], y[~left]
                    if len(a) >= least and len(b) >= least:
                        gini = len(a) * a.mean() * (1 - a.mean()) + len(b) * b.mean() * (1 - b.mean())
                        if best is None or gini < best[0] - 1e-12:
                            best = (gini, f, cut)
        if best:
            _, f, cut = best
            left = x[:, f] <= cut
            self.feature[node], self.cut[node] = f, float(cut)
            self.low[node] = self._grow(x[left], y[left], depth - 1, least)
            self.high[node] = self._grow(x[~left], y[~left], depth - 1, least)
        return node

    def is_main(self, row: list[float]) -> bool:
        node = 0
        while self.feature[node] >= 0:
            node = self.low[node] if row[self.feature[node]] <= self.cut[node] else self.high[node]
        return self.value[node] > 0.5


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    """(features, is main text) of all blocks of the labelled pages."""
    rows = [(f, marked) for page in labelled_pages() for _, f, marked in blocks(page)]
    return np.array([f for f, _ in rows]), np.array([m for _, m in rows], float)


@cache
def tree() -> Tree:
    return Tree(*labelled_table())


def main_text(page: str, t: Tree) -> str:
    return "\n".join(text for text, f, _ in blocks(page) if t.is_main(f))


def extract(pages: DataFrame, keys: tuple[str, ...] = ("page_id", "url"), body: str = "html") -> DataFrame:
    """(keys, text STRING, n_chars LONG) of every page."""
    ship(pages.sparkSession)
    pages = pages.select(*keys, body)
    grown = tree()

    def run(batches):
        for batch in slices(batches, body):
            out = [main_text(s, grown) for s in strings(batch, body)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keys)], pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], [*keys, "text", "n_chars"]
            )

    kept = ", ".join(f"`{k}` {pages.schema[k].dataType.simpleString()}" for k in keys)
    return pages.mapInArrow(run, f"{kept}, text string, n_chars long")
