"""Main text of web pages: boosted trees over DOM nodes and a consistent choice.

A page becomes a tree of its block elements. Every node is described by its tag,
attribute words, depth, siblings, and the text and link density of its subtree;
boosted trees give the chance that it belongs to the article. A choice from the
leaves up then keeps or drops whole subtrees: what is inside a kept part is kept and
what is inside a dropped part is dropped, and changing one's mind has a price.

There are no labels. The trees are fitted on a bounded sample of pages that mark
their article, and on rearrangements of these pages under other tags, class names
and surroundings, whose labels are known by construction.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm import boosting
from pitpanel.llm.common import at, first_by_hash, ship

#: Pages that the trees are fitted on, at most, and rearrangements of each.
TRAIN_PAGES, VARIANTS = 240, 5
#: Price of keeping one part and dropping another under the same parent.
PRICE = 1.5
#: Pages whose nodes are scored together.
PAGES = 64

# Element names of HTML by their part in a page, and attribute words.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary"
    " table tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset(
    "script style head title template noscript svg math iframe object embed applet canvas audio video map select"
    " datalist textarea button noframes xmp".split()
)
VOID = frozenset("area base basefont br col embed frame hr img input link meta param source track wbr".split())
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody", "tfoot"}, {"table"}),
    "thead": ({"tr", "td", "th", "thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "thead", "tbody", "tfoot"}, {"table"}),
}
SURROUNDING_TAGS = frozenset("nav footer aside header form menu dialog search".split())
ARTICLE_TAGS = frozenset(["article", "main"])
SURROUNDING_WORDS = frozenset(
    "nav navbar navigation menu menubar footer foot header masthead topbar sidebar side aside rail ad ads adv advert"
    " advertisement advertising adbox banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices"
    " notification alert popup modal overlay dialog comment comments commentlist discussion disqus reply replies respond"
    " response responses feedback review reviews form search login signin signup register subscribe subscription newsletter"
    " share sharing social related recommended recommendations more trending popular breadcrumb breadcrumbs pager pagination"
    " paging copyright legal disclaimer widget widgets toolbar hidden tags taglist author byline skip contentinfo complementary"
    " bio toc print tools".split()
)
ARTICLE_WORDS = frozenset(
    "article articlebody content contents main maincontent post postbody entry story storybody body text page blog"
    " detail prose richtext".split()
)

TOKEN = re.compile(
    r"<!--(?:(?!-->).)*+(?:-->|$)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*+)>"
    r"|<[!?/][^>]*+>?",
    re.S,
)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|aria-label|hidden|style|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SPACE = re.compile(r"\s+")

NAMES = (
    "depth place siblings same_tag chars links nodes chars_a_node paragraphs stops share surrounding article"
    " above_surrounding above_article below_surrounding below_article tag_surrounding tag_article tag_heading"
    " tag_paragraph tag_list tag_box above_tag_surrounding above_tag_article begins before after sibling_chars parent_links page_chars"
).split()
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
PARAGRAPHS = frozenset(["p", "blockquote", "pre", "figcaption", "td", "dd"])
LISTS = frozenset(["ul", "ol", "li", "dl", "dt", "dir", "table", "tr", "tbody"])


class Page(NamedTuple):
    """Block nodes in document order. own: per node its figures; blocks: (node, text)."""

    tags: list[str]
    parents: list[int]
    ends: list[int]
    own: list[list[float]]
    blocks: list[tuple[int, str]]


def attribute_words(attrs: str) -> tuple[int, int]:
    """Numbers of words of the surroundings and of the article in an element's attributes."""
    around = inside = 0
    for name, value in ATTRIBUTE.findall(attrs):
        name = name.lower()
        if name == "style":
            around += "display:none" in value.replace(" ", "").lower()
        elif name == "hidden" or name == "aria-hidden":
            around += name == "hidden" or "true" in value.lower()
        else:
            for word in WORD.findall(value):
                word = word.lower()
                around += word in SURROUNDING_WORDS
                inside += word in ARTICLE_WORDS
    return around, inside


def after(html: str, tag: str, start: int) -> int:
    """Where the content of a dropped element ends; what is never closed is raw text or nothing."""
    end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(html, start)
    return end.end() if end else len(html) if tag in ("script", "style") else start


def parse(html: str) -> Page:
    """Blocks of text and the tree of block elements; closing tags may be missing."""
    tags, parents, ends, own, blocks = ["#page"], [-1], [0], [[0.0] * 12], []
    stack = [0]
    open_at: dict[str, list[int]] = defaultdict(list)  # depths of open elements, by tag
    inline, anchors = [], 0
    linked = 0
    skip = ""

    def flush() -> None:
        nonlocal linked
        text = SPACE.sub(" ", entities.unescape("".join(inline))).strip() if inline else ""
        if text:
            node = stack[-1]
            figures = own[node]
            figures[0] += len(text)
            figures[1] += min(linked, len(text))
            figures[2] += len(text) if tags[node] in PARAGRAPHS else 0
            figures[3] += text.count(".") + text.count("!") + text.count("?")
            blocks.append((node, text))
        inline.clear()
        linked = 0

    def close_to(depth: int) -> None:
        while len(stack) > depth:
            node = stack.pop()
            ends[node] = len(tags)
            if open_at[tags[node]]:
                open_at[tags[node]].pop()

    def deepest(names: Iterable[str]) -> int:
        """Depth of the innermost open element of these tags; 0 where none is open."""
        return max((open_at[t][-1] for t in names if open_at[t]), default=0)

    last = 0
    while m := TOKEN.search(html, last):
        if not skip and m.start() > last:
            piece = html[last : m.start()]
            inline.append(piece)
            if anchors:
                linked += len(piece)
        last = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        closing = bool(m["close"] or m["close2"])
        if skip:
            if closing and tag == skip:
                skip = ""
            elif not closing and tag in BLOCKS and tag != "html":
                skip = ""  # a head that was never closed
            elif not closing and tag in DROPPED and tag != "head":
                last = after(html, tag, last)
            if skip or closing:
                continue
        if tag in DROPPED:
            inline.append(" ")
            if closing or (m["attrs"] or m["attrs2"] or "").endswith("/"):
                continue
            if tag == "head":
                skip = tag
            else:
                last = after(html, tag, last)
            continue
        if tag not in BLOCKS:
            if tag == "a":
                anchors = 0 if closing else 1
            elif tag == "br" or tag in VOID:
                inline.append(" ")
            continue
        flush()
        if closing:
            if depth := deepest([tag]):
                close_to(depth)
                anchors = 0
            continue
        if tag == "hr":
            continue
        if tag in ("html", "body") and deepest([tag]):
            continue
        if tags[stack[-1]] == "p":
            close_to(len(stack) - 1)
        if tag in CLOSED_BY:
            over, until = CLOSED_BY[tag]
            depth = deepest(over)
            if depth > deepest(until):
                close_to(depth)
        parent = stack[-1]
        around, inside = attribute_words(m["attrs"] or m["attrs2"] or "")
        above = own[parent]
        top = tag in ("html", "body")
        own.append([
            0.0, 0.0, 0.0, 0.0,  # characters, linked, in paragraphs, sentence ends
            0 if top else around, 0 if top else inside,
            above[4] + above[6], above[5] + above[7],  # words above
            above[8] + above[10], above[9] + above[11],  # tags above
            float(tag in SURROUNDING_TAGS), float(tag in ARTICLE_TAGS),
        ])
        node = own[-1]
        # 4, 5: own words; 6, 7: words above; 8, 9: tags above; 10, 11: own tag.
        tags.append(tag)
        parents.append(parent)
        ends.append(0)
        open_at[tag].append(len(stack))
        stack.append(len(tags) - 1)
        del node
    if not skip and last < len(html):
        inline.append(html[last:])
    flush()
    close_to(0)
    ends[0] = len(tags)
    return Page(tags, parents, ends, own, blocks)


def described(page: Page) -> np.ndarray:
    """Features of all nodes of a page, in the order of ``NAMES``."""
    n = len(page.tags)
    own, parent, end = np.array(page.own), np.array(page.parents), np.array(page.ends)
    first = np.arange(n)

    def below(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(values)])
        return sums[end] - sums[first]

    chars, links, paragraphs, stops = (below(own[:, i]) for i in range(4))
    nodes = (end - first).astype(float)
    depth, place, siblings, same, before, after, beside = (np.zeros(n) for _ in range(7))
    children: dict[int, list[int]] = {}
    for i in range(1, n):
        depth[i] = depth[parent[i]] + 1
        children.setdefault(parent[i], []).append(i)
    for group in children.values():
        g = np.array(group)
        size = len(g)
        place[g], siblings[g] = np.arange(size) / size, size
        names = [page.tags[i] for i in group]
        counts = {t: names.count(t) for t in set(names)} if size < 200 else dict(zip(*np.unique(names, return_counts=True), strict=True))
        same[g] = [counts[t] / size for t in names]
        before[g[1:]], after[g[:-1]] = chars[g[:-1]], chars[g[1:]]
        beside[g] = chars[g].mean()
    begins = np.concatenate([[0.0], np.cumsum(own[:, 0])])[:-1]
    whole = max(1.0, chars[0])
    tag = lambda names: np.array([t in names for t in page.tags], float)
    up = np.maximum(parent, 0)
    density = links / np.maximum(1, chars)
    return np.stack([
        depth, place, siblings, same, np.log1p(chars), density, np.log1p(nodes), np.log1p(chars / nodes),
        paragraphs / np.maximum(1, chars), stops / np.maximum(10, chars), chars / whole, own[:, 4], own[:, 5], own[:, 6], own[:, 7],
        below(own[:, 4]) - own[:, 4], below(own[:, 5]) - own[:, 5], own[:, 10], own[:, 11], tag(HEADINGS), tag(PARAGRAPHS), tag(LISTS),
        tag({"div", "section"}), own[:, 8], own[:, 9], begins / whole, np.log1p(before), np.log1p(after), np.log1p(beside), density[up],
        np.full(n, np.log1p(whole)),
    ], axis=1)


def chosen(page: Page, chance: np.ndarray, price: float = PRICE) -> list[str]:
    """Texts of the kept blocks, in order.

    From the leaves up, a subtree is kept whole, dropped whole, or, at a price,
    decided child by child; the outer elements of a page have no say.
    """
    n = len(page.tags)
    p = np.clip(chance, 1e-4, 1 - 1e-4)
    keep, drop = np.log(p), np.log1p(-p)
    for i, tag in enumerate(page.tags):
        if tag in ("#page", "html", "body"):
            keep[i] = drop[i] = 0.0
    own_keep, own_drop = keep.copy(), drop.copy()
    apart = np.zeros(n)
    for node in {b for b, _ in page.blocks}:
        apart[node] += max(own_keep[node], own_drop[node])
    for i in range(n - 1, 0, -1):
        parent = page.parents[i]
        keep[parent] += keep[i]
        drop[parent] += drop[i]
        apart[parent] += max(keep[i], drop[i], apart[i] - price if page.ends[i] > i + 1 else -np.inf)
    fate = [""] * n
    for i in range(n):
        above = fate[page.parents[i]] if i else "apart"
        if above != "apart":
            fate[i] = above
        elif page.ends[i] > i + 1 and (i == 0 or apart[i] - price > max(keep[i], drop[i])):
            fate[i] = "apart"
        else:
            fate[i] = "keep" if keep[i] > drop[i] else "drop"
    return [
        text for node, text in page.blocks
        if fate[node] == "keep" or (fate[node] == "apart" and own_keep[node] > own_drop[node])
    ]


def marked(page: Page) -> np.ndarray:
    """1 for nodes of the marked article, 0 for nodes outside it, -1 where neither is plain."""
    out = np.zeros(len(page.tags))
    for i, figures in enumerate(page.own):
        inside = figures[9] + figures[11] > 0
        around = figures[4] + figures[6] + figures[8] + figures[10] > 0
        out[i] = -1 if page.tags[i] in ("#page", "html", "body") else float(inside and not around)
        if not inside and not around:
            out[i] = -1
    return out


def rearranged(page: Page, spare: list[str], draw: random.Random) -> tuple[str, list[tuple[str, int]]]:
    """The page's article in other surroundings, as HTML; each element carries its label.

    Labels are put in an attribute ``y`` that no feature reads.
    """
    labels = marked(page)
    body = [(page.tags[node], text) for node, text in page.blocks if labels[node] == 1]
    esc = entities.escape

    def said(least: int, most: int) -> str:
        words = draw.choice(spare).split()
        size = draw.randint(least, most)
        start = draw.randint(0, max(0, len(words) - size))
        return esc(" ".join(words[start : start + size]))

    def box(names: str, tags: str, inner: str, y: int = 0) -> str:
        tag = draw.choice(tags.split())
        word = draw.choice(names.split())
        style = draw.random()
        attrs = "" if tag not in ("div", "section", "p") and style < 0.4 else (
            f' class="{word}"' if style < 0.6 else f' id="{word}"' if style < 0.8 else f' class="{word}-{draw.choice(["box", "wrap", "inner", "block"])} x{draw.randint(1, 99)}"'
        )
        return f'<{tag} y="{y}"{attrs}>{inner}</{tag}>'

    def links(least: int, most: int) -> str:
        items = [f'<li y="0"><a href="/{draw.randint(1, 99)}">{said(1, 4)}</a></li>' for _ in range(draw.randint(least, most))]
        return f'<ul y="0">{"".join(items)}</ul>' if draw.random() < 0.7 else " ".join(re.sub(r"</?li[^>]*>", "", x) for x in items)

    def paragraphs(least: int, most: int, short: int, long: int) -> str:
        return "".join(f'<p y="0">{said(short, long)}</p>' for _ in range(draw.randint(least, most)))

    inside = []
    for tag, text in body:
        tag = tag if tag in HEADINGS or tag in PARAGRAPHS else "p"
        if draw.random() < 0.1:
            tag = draw.choice(["p", "div", "blockquote", "h2", "li"])
        inside.append(f'<{tag} y="1">{esc(text)}</{tag}>')
        if draw.random() < 0.06:
            inside.append(box("ad ads advert sponsored related share promo newsletter", "div aside", said(3, 25) if draw.random() < 0.6 else links(2, 5)))
    article = "".join(inside)
    comment = lambda: box("comment reply response", "div li article section", (f'<p y="0">{said(1, 3)}</p>' if draw.random() < 0.5 else "") + paragraphs(1, 2, 3, 60))
    comments = box("comments discussion responses commentlist replies", "div section ul", ('<h3 y="0">Comments</h3>' if draw.random() < 0.5 else "") + "".join(comment() for _ in range(draw.randint(1, 5))))
    share = box("share social tags byline author related", "div ul p footer", said(1, 6) if draw.random() < 0.4 else links(2, 5))
    if draw.random() < 0.25:
        article += share
    if draw.random() < 0.3:
        article += comments
        comments = ""
    wrap = draw.random()
    if wrap < 0.35:
        article = f'<article y="1">{article}</article>'
    elif wrap < 0.5:
        article = f'<main y="1">{article}</main>'
    elif wrap < 0.9:
        article = box("content post entry story article main body text prose page", "div section", article, 1)
    else:
        article = f'<div y="1" class="x{draw.randint(1, 99)}">{article}</div>'
    parts = []
    for chance, part in (
        (0.3, box("cookie consent notice alert banner popup", "div aside section dialog", paragraphs(1, 2, 4, 40) if draw.random() < 0.6 else said(4, 40))),
        (0.4, box("header masthead topbar banner", "header div", (f'<h1 y="0">{said(1, 5)}</h1>' if draw.random() < 0.5 else said(1, 8)) + (links(2, 6) if draw.random() < 0.5 else ""))),
        (0.8, box("nav menu navigation navbar", "nav div", links(3, 10))),
        (0.2, box("breadcrumb breadcrumbs", "nav div ol", links(2, 4))),
        (0.4, box("ad ads advert sponsor promo banner", "div aside", said(2, 40))),
        (0.25, box("search login subscribe newsletter form", "form div", said(1, 10) + '<input type="text"><label>' + said(1, 3) + "</label>")),
        (0.3, box("sidebar side aside rail widget", "aside div", (f'<h3 y="0">{said(1, 4)}</h3>' if draw.random() < 0.6 else "") + (links(3, 8) if draw.random() < 0.5 else paragraphs(1, 4, 5, 60)))),
        (1.0, article),
        (0.3, box("sidebar side aside rail widget related popular", "aside div section", (f'<h3 y="0">{said(1, 4)}</h3>' if draw.random() < 0.6 else "") + (links(3, 8) if draw.random() < 0.5 else paragraphs(1, 4, 5, 60)))),
        (0.25, box("subscribe newsletter feedback respond form", "form div", paragraphs(1, 2, 3, 20))),
        (0.4, comments),
        (0.2, box("ad ads advert sponsor promo", "div aside", said(2, 40))),
        (0.85, box("footer foot copyright legal", "footer div", (said(2, 25) if draw.random() < 0.7 else paragraphs(1, 3, 3, 20)) + (links(2, 5) if draw.random() < 0.3 else ""))),
    ):
        if part and draw.random() < chance:
            parts.append(part)
    inner = "".join(parts)
    if draw.random() < 0.4:
        inner = f'<div class="{draw.choice(["container", "wrapper", "layout", "site", "page"])}">{inner}</div>'
    return f"<html><body>{inner}</body></html>", body


LABEL = re.compile(r"<([a-z0-9]+) y=\"([01])\"")


def training_nodes(htmls: list[str], seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the nodes of marked pages and of their rearrangements."""
    pages = [p for p in map(parse, htmls) if (marked(p) == 1).any()]
    spare = [text for p in pages for _, text in p.blocks if len(text) > 20]
    xs, ys = [np.zeros((0, len(NAMES)))], [np.zeros(0)]
    draw = random.Random(seed)
    for page in pages:
        y = marked(page)
        xs.append(described(page)[y >= 0])
        ys.append(y[y >= 0])
        for _ in range(VARIANTS if spare else 0):
            made, _ = rearranged(page, spare, draw)
            # Block elements come in the order of their opening tags.
            wanted = [(m[1], int(m[2])) for m in LABEL.finditer(made)]
            tree = parse(made)
            nodes, k, labels = described(tree), 0, np.full(len(tree.tags), -1.0)
            for i, tag in enumerate(tree.tags):
                if k < len(wanted) and tag == wanted[k][0]:
                    labels[i] = wanted[k][1]
                    k += 1
            xs.append(nodes[labels >= 0])
            ys.append(labels[labels >= 0])
    return np.concatenate(xs), np.concatenate(ys)


def fit(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", rows: int = TRAIN_PAGES) -> boosting.Trees | None:
    """Trees fitted on at most ``rows`` pages that mark their article, chosen by hash; None without such pages."""
    near = pages.where(F.lower(at(html_col)).rlike("<(article|main)[ >]") & (F.length(at(html_col)) < 1_000_000))
    ordered = near.select(
        at(html_col).alias("html"), F.xxhash64(at(id_col).cast("string"), F.lit("train")).alias("order")
    )
    chosen = first_by_hash(ordered, "order", rows, near.count())
    x, y = training_nodes([r.html for r in chosen.collect()])
    return boosting.fit(x, y) if len(set(y.tolist())) == 2 else None


def texts_of(htmls: list[str | None], trees: boosting.Trees | None) -> list[str]:
    """Main texts; without trees, all text that isn't script, style or the like."""
    pages = [parse(h or "") for h in htmls]
    if trees is None:
        return ["\n".join(text for _, text in p.blocks) for p in pages]
    nodes = [described(p) for p in pages]
    chance = trees.chance(np.concatenate(nodes)) if nodes else np.zeros(0)
    out, start = [], 0
    for page in pages:
        part = chance[start : start + len(page.tags)]
        start += len(page.tags)
        out.append("\n".join(chosen(page, part)))
    return out


def main_texts(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", rows: int = TRAIN_PAGES) -> DataFrame:
    """Every row of ``pages`` with main_text, replacing a column of that name.

    A null or empty page, and one without an article, gives an empty text. Whole
    pages are read. An empty table, or one without pages that mark their article,
    gives all text outside scripts and styles.
    """
    ship(pages.sparkSession)
    trees = pages.sparkSession.sparkContext.broadcast(fit(pages, html_col, id_col, rows))  # a few thousand numbers

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for htmls in batches:
            out: list[str] = []
            for i in range(0, len(htmls), PAGES):
                out += texts_of(list(htmls.iloc[i : i + PAGES]), trees.value)
            yield pd.Series(out, dtype=object)

    return pages.withColumn("main_text", extract(at(html_col).cast("string")))


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    return main_texts(pages.select("page_id", "url", "html")).select(
        "page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars")
    )
