"""Main text of web pages by composite text density of the DOM nodes.

A node's density is its characters per tag, raised where few of them are links; the sum of its children's
densities is highest for the node that holds the article. The lowest density on the way from that node up to the
body is the threshold beyond which other parts of the page count as article, too.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from starwash.llm.common import text_bytes

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
HEAD_ONLY = frozenset("base basefont bgsound link meta noscript script style template title".split())
#: Never text of a page.
SILENT = frozenset(
    "audio button canvas datalist dialog embed head iframe input meter noframes noscript object option progress script "
    "select style svg template textarea title video".split()
)
#: Not the article, unless an article lies inside, as an unclosed one would have it.
ASIDE = frozenset("aside footer form menu nav".split())
ASIDE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
#: Words of a class or an id that name a part beside the article.
ASIDE_WORDS = frozenset(
    "ad ads adsense advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies copyright disclaimer disqus footer gdpr login masthead menu modal nav navbar "
    "navigation newsletter notice notices pager pagination paywall popup promo promotion recommended related replies "
    "reply respond search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget "
    "widgets".split()
)
#: A start tag that ends these open elements, up to the given ones.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("thead", "tbody"), ("table",)), "tfoot": (("thead", "tbody"), ("table",)),
    "option": (("option",), ("select",)), "a": (("a",), ("td", "th", "table")),
}
P_STAYS = ("button", "caption", "object", "table", "td", "th")


def _words(value: str) -> set[str]:
    return set(value.lower().replace("-", " ").replace("_", " ").split())


class Tree(HTMLParser):
    """The elements of a page in page order, and its text pieces.

    ``parent``, ``tag`` and ``beside`` (0: article or unknown, 1: beside the article, 2: never text) have an entry
    per element, element 0 is the page. ``pieces`` are (element, text), with a blank at every edge of a block.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.beside = [-1], ["html"], [0]
        self.pieces: list[tuple[int, str]] = []
        self.open = [0]

    def _close(self, names: tuple[str, ...], barrier: tuple[str, ...]) -> bool:
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.tag[self.open[depth]]
            if name in names:
                if name not in INLINE:
                    self.pieces.append((self.open[depth], " "))
                del self.open[depth:]
                return True
            if name in barrier:
                return False
        return False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("html", "body"):
            self._close(("head",), ())
            if tag == "html" or "body" in self.tag:
                return
        elif tag not in HEAD_ONLY and len(self.open) > 1 and self.tag[self.open[-1]] == "head":
            self.open.pop()
        if tag not in INLINE and tag not in ("br", "input", "script", "style", "template"):
            self._close(("p",), P_STAYS)
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        at = len(self.tag)
        self.parent.append(self.open[-1])
        self.tag.append(tag)
        self.beside.append(self._kind(tag, dict(attrs)))
        if tag not in INLINE:
            self.pieces.append((at, " "))
        if tag not in VOID:
            self.open.append(at)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # the slash has no meaning in HTML

    def handle_endtag(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        barrier = () if tag not in INLINE else ("article", "body", "div", "li", "main", "p", "section", "td", "th")
        self._close((tag,), barrier)

    def handle_data(self, data: str) -> None:
        self.pieces.append((self.open[-1], data))

    def _kind(self, tag: str, attrs: dict[str, str | None]) -> int:
        if tag in SILENT or "hidden" in attrs or attrs.get("aria-hidden") == "true":
            return 2
        if "display:none" in (attrs.get("style") or "").replace(" ", "").lower():
            return 2
        if tag in ("article", "body", "main"):
            return 0
        words = _words(f"{attrs.get('class') or ''} {attrs.get('id') or ''}")
        named = bool(words & ASIDE_WORDS) or (attrs.get("role") or "").lower() in ASIDE_ROLES
        own = any(self.tag[i] in ("article", "main") for i in self.open)  # an article's own header has its title
        return int(named or tag in ASIDE or ((tag == "header" or "header" in words) and not own))


def _read(html: str) -> Tree:
    tree = Tree()
    tree.feed(html)
    tree.close()
    return tree


def _kept(tree: Tree) -> list[bool]:
    """Whether an element's own text may be article text."""
    holds = [t in ("article", "main") for t in tree.tag]
    titled = [t == "h1" for t in tree.tag]
    for i in range(len(holds) - 1, 0, -1):
        holds[tree.parent[i]] |= holds[i]
        titled[tree.parent[i]] |= titled[i]
    whole = [h or (t == "form" and h1) for h, t, h1 in zip(holds, tree.tag, titled)]  # some pages lie in one form
    kept = [True]
    for i in range(1, len(holds)):
        kept.append(kept[tree.parent[i]] and (tree.beside[i] == 0 or (tree.beside[i] == 1 and whole[i])))
    return kept


def densities(parent: list[int], chars: list[int], links: list[bool], body: int) -> list[float]:
    """Composite density of every element from its own characters and whether it is a link.

    With C characters, T tags, LC characters and LT tags of links in a subtree, and b for those of the body:
    C/T times the logarithm of (C/LC)(T/LT) to the base ln((C/(C-LC)) LC + (LCb/Cb) C + e). LC, LT, T and
    C-LC are at least one, so that a text without links has a density.
    """
    n = len(parent)
    c, t = list(chars), [0] * n
    lc, lt = [0] * n, [0] * n
    inside = [False] * n
    for i in range(1, n):
        inside[i] = links[i] or inside[parent[i]]
        if inside[i]:
            lc[i] = chars[i]
    for i in range(n - 1, 0, -1):
        p = parent[i]
        c[p] += c[i]
        t[p] += t[i] + 1
        lc[p] += lc[i]
        lt[p] += lt[i] + links[i]
    linked = max(1, lc[body]) / max(1, c[body])
    out = []
    for i in range(n):
        if not c[i]:
            out.append(0.0)
            continue
        base = math.log(c[i] / max(1, c[i] - lc[i]) * max(1, lc[i]) + linked * c[i] + math.e)
        ratio = c[i] / max(1, lc[i]) * max(1, t[i]) / max(1, lt[i])
        out.append(c[i] / max(1, t[i]) * math.log(ratio) / math.log(base))
    return out


def _selected(tree: Tree, kept: list[bool]) -> list[bool]:
    """Whether an element belongs to a selected subtree."""
    n, parent = len(tree.tag), tree.parent
    body = tree.tag.index("body") if "body" in tree.tag else 0
    chars = [0] * n
    for i, text in tree.pieces:
        if kept[i]:
            chars[i] += len("".join(text.split()))
    # Elements that are left out, and blocks without any text, must not count as tags.
    alive = [k and c > 0 for k, c in zip(kept, chars)]
    for i in range(n - 1, 0, -1):
        if alive[i]:
            alive[parent[i]] = True
    index = [i for i in range(n) if alive[i] or i == 0 or i == body]
    place = {i: k for k, i in enumerate(index)}
    up = [place[parent[i]] if i else -1 for i in index]
    root = place[body]
    density = densities(up, [chars[i] for i in index], [tree.tag[i] == "a" for i in index], root)
    sums = [0.0] * len(index)
    for k in range(len(index) - 1, 0, -1):
        sums[up[k]] += density[k]
    in_body, best_below = [False] * len(index), list(range(len(index)))
    for k in range(len(index)):
        in_body[k] = k == root or (k > 0 and in_body[up[k]])
    for k in range(len(index) - 1, 0, -1):
        best_below[up[k]] = max(best_below[up[k]], best_below[k], key=lambda j: (sums[j], -j))  # a tie: the outer, the first
    best = best_below[root]
    path, k = [], best
    while k != root and k > 0:
        path.append(k)
        k = up[k]
    threshold = min([density[root], *(density[p] for p in path)])

    chosen = [False] * len(index)
    whole = _whole_article([tree.tag[i] for i in index], up, path, best)
    chosen[whole] = True
    for k in range(len(index)):
        if k and (chosen[up[k]]):
            chosen[k] = True
    onto = {whole, *path, root}
    if tree.tag[index[whole]] not in ("article", "main"):
        # Other parts as dense as the way to the article are more of it.
        wide = [False] * len(index)
        for k in range(1, len(index)):
            if in_body[k] and not chosen[k]:
                wide[k] = wide[up[k]] or (up[k] in onto and k not in onto and density[k] >= threshold > 0)
        chosen = [a or b for a, b in zip(chosen, wide)]
    return [i in place and chosen[place[i]] for i in range(n)]


def _whole_article(tag: list[str], up: list[int], path: list[int], best: int) -> int:
    """The outermost article, else main element around ``best``; or the only one inside it; else ``best``."""
    for name in ("article", "main"):
        around = [k for k in path if tag[k] == name]
        if around:
            return around[-1]
    inside = [False] * len(tag)
    for k in range(len(tag)):
        inside[k] = k == best or (k > 0 and inside[up[k]])
    for name in ("article", "main"):
        within = [k for k in range(len(tag)) if inside[k] and tag[k] == name]
        if len(within) == 1:
            return within[0]
    return best


def main_text(html: str) -> str:
    tree = _read(html)
    kept = _kept(tree)
    selected = _selected(tree, kept)
    return " ".join("".join(t for i, t in tree.pieces if t == " " or (kept[i] and selected[i])).split())


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    Null and empty html, and pages without an article, have an empty text. Repeated rows give equal rows, an empty
    table an empty result; other columns, whatever their names, are left out. Texts are read whole, a very long page
    costs its task memory for its elements. Bytes that are not UTF-8 become replacement characters.
    """

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages_bytes in batches:
            yield pd.Series([main_text(b.decode("utf-8", "replace")) for b in pages_bytes], dtype=object)

    texts = pages.select("page_id", "url", extract(text_bytes("html")).alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))
