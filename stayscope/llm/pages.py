"""Main text of web pages: boosted trees over nodes of the document tree, decoded from the root down.

Every block element with text is a node, described by its subtree's text and links, its depth, its
place among its siblings and the words in its own and its ancestors' attributes. Two sets of trees
tell how likely all of a node is article, or all of it is not. Decoding maximises the sum over the
tree in which a node is kept whole, dropped whole or mixed; only a mixed one lets its children
choose, so no child contradicts its ancestors.

The trees learn from a bounded sample of the pages. Its sections are labelled by what their
elements mean by themselves (article, nav, footer and so on), and rebuilt in other layouts, with the
meaning moved from elements to attribute words or left out, so that form counts too.
"""

from __future__ import annotations

import bisect
import html
import math
import re
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayscope.llm import boosting
from stayscope.llm.common import first_by_hash, map_texts, table

SAMPLE_PAGES = 250
LAYOUTS = 3

# Element kinds of HTML.
VOID = set("area base br col embed hr img input link meta source track wbr param".split())
BLOCK = set(
    """address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th
    thead tr ul br""".split()
)
UNSEEN = set("head script style noscript template title textarea select option button svg iframe object canvas audio video datalist annotation annotation-xml".split())
RAW = set("script style textarea title noscript template iframe".split())
FOREIGN = set("svg math".split())
# HTML inside svg or math is content of these; elsewhere such elements end the svg or math.
HOLDERS = set("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
BREAKOUT = set(
    """b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr
    ol p pre ruby s small span strong strike sub sup table tt u ul var article section main aside nav header footer
    figure form td th tr tbody""".split()
)
CLOSES = {
    "li": {"p", "li"}, "dt": {"p", "dt", "dd"}, "dd": {"p", "dt", "dd"}, "tr": {"p", "tr", "td", "th"},
    "td": {"p", "td", "th"}, "th": {"p", "td", "th"},
}
FENCES = set("table ul ol dl div section article main body aside nav td th li dd form blockquote header footer".split())
MARK = re.compile(r"<(?:(!--)|([!?])|(/?)([A-Za-z][^\s/>]*+))")
COMMENT_END = re.compile(r"--!?>")
ATTRIBUTE = re.compile(r"""(=?[^\s/>=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+)))?+""")
TAG_END = re.compile(rf"(?:[\s/=]++|{ATTRIBUTE.pattern})*+>")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

KINDS = ["text", "nav", "header", "footer", "side", "ad", "notice", "form", "comment"]
TOKENS = {
    "text": "article content post entry story text main body blog single page prose",
    "nav": "nav navigation navbar menu breadcrumb breadcrumbs crumbs pagination pager toc tabs links skip",
    "header": "header masthead banner logo top topbar branding tagline site",
    "footer": "footer foot bottom copyright legal colophon imprint credits",
    "side": "sidebar aside side widget related recommended recommendations popular trending share social sharing rail more tags",
    "ad": "ad ads advert adverts advertisement sponsor sponsored promo promoted promotion banner dfp teaser affiliate",
    "notice": "cookie cookies consent notice notices alert warning popup modal overlay newsletter subscribe gdpr paywall message toast info",
    "form": "form search login signup register contact input field signin",
    "comment": "comment comments reply replies respond disqus discussion feedback reviews responses commenter",
}
KIND_OF = {t: i for i in range(len(KINDS) - 1, -1, -1) for t in TOKENS[KINDS[i]].split()}
TAG_KINDS = ["article", "main", "section", "div", "p", "title", "h", "list", "table", "nav", "footer", "header", "aside", "form", "quote", "figure"]
TAG_KIND_OF = {
    **{t: t for t in ("article", "main", "section", "div", "p", "nav", "footer", "header", "aside", "form", "figure")},
    "h1": "title", "h2": "title", **{f"h{i}": "h" for i in range(3, 7)}, **dict.fromkeys("ul ol li dl dt dd menu".split(), "list"),
    **dict.fromkeys("table tbody thead tfoot tr td th".split(), "table"), "blockquote": "quote", "pre": "quote",
    "figcaption": "figure", "body": "div", "html": "div", "center": "div", "address": "footer", "fieldset": "form",
}


@dataclass
class Node:
    """A block element."""

    tag: str
    parent: int
    depth: int
    kinds: int
    label: int | None = None


@dataclass
class Page:
    """Nodes in page order, and runs of visible text: (node, block, in a link, text)."""

    nodes: list[Node]
    runs: list[tuple[int, int, bool, str]]


def attribute_kinds(attributes: str) -> int:
    """Bits of the kinds that the words of class, id and role tell, and a last one if it is hidden."""
    bits = 0
    for m in ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        value = m[2] or m[3] or m[4] or ""
        if name in ("class", "id", "role", "itemprop", "aria-label"):
            for t in PART.findall(value):
                kind = KIND_OF.get(t.lower())
                bits |= 0 if kind is None else 1 << kind
        elif name in ("hidden", "aria-hidden") or name == "style" and re.search(r"display\s*:\s*none", value):
            bits |= 1 << len(KINDS)
    return bits


class Tags:
    """The tags of a page, read once from its start to its end.

    A quote opens a value only right after an equals sign, and only if it is closed again. Where a tag
    would run to the end of the page, it and all later ones end at the next `>` whatever the quotes.
    """

    def __init__(self, source: str):
        self.source, self.pos, self.quotes = source, 0, True

    def next(self) -> tuple[int, bool, str, str] | None:
        """Start, whether it is an end tag, name ('' of a comment) and attributes; None after the last one."""
        m = MARK.search(self.source, self.pos)
        if not m:
            return None
        if m[4] is None:
            end = COMMENT_END.search(self.source, m.start() + 2) if m[1] else None
            self.pos = end.end() if end else 0 if m[1] else self.source.find(">", m.end()) + 1
            self.pos = self.pos or len(self.source)
            return m.start(), False, "", ""
        tail = TAG_END.match(self.source, m.end()) if self.quotes else None
        self.quotes = tail is not None
        self.pos = tail.end() if tail else self.source.find(">", m.end()) + 1
        if not self.pos:  # cut off; without attributes it may as well be text
            self.pos = len(self.source)
            return None if not m[3] and "=" not in self.source[m.end() :] else (m.start(), False, "", "")
        return m.start(), bool(m[3]), m[4].lower(), self.source[m.end() : self.pos - 1]

    def skip_past(self, tag: str) -> None:
        """Go on after the end tag of an element whose content is not markup, or at the end of the page."""
        close = re.compile(rf"</{tag}(?=[\s/>])[^>]*+>", re.I).search(self.source, self.pos)
        self.pos = close.end() if close else len(self.source)


class Open:
    """Open elements with the block node each is in, and where among them the ones of a name or kind are.

    Every question is answered from these places, so a page takes linear time however deep it nests.
    """

    def __init__(self):
        self.stack: list[tuple[str, int]] = [("html", 0)]
        self.places: dict[str, list[int]] = defaultdict(list)
        self.fences: list[int] = []
        self.holders: list[int] = []
        self.block = self.unseen = self.foreign = 0

    def push(self, tag: str, node: int) -> None:
        """Open an element."""
        place = len(self.stack)
        self.stack.append((tag, node))
        self.places[tag].append(place)
        if tag in FENCES or tag in FOREIGN:
            self.fences.append(place)
        if tag in HOLDERS:
            self.holders.append(place)
        self.unseen += tag in UNSEEN
        self.foreign += tag in FOREIGN

    def cut(self, place: int) -> None:
        """Close the element at a place and all in it."""
        while len(self.stack) > place:
            tag, _ = self.stack.pop()
            self.places[tag].pop()
            for kind in (self.fences, self.holders):
                if kind and kind[-1] == len(self.stack):
                    kind.pop()
            self.unseen -= tag in UNSEEN
            self.foreign -= tag in FOREIGN
            self.block += tag in BLOCK

    def close(self, tag: str) -> None:
        """An end tag: it closes the last element of its name, if any."""
        if self.places[tag]:
            self.cut(self.places[tag][-1])
        elif tag in BLOCK:
            self.block += 1

    def leave_foreign(self) -> None:
        """HTML in svg or math, outside of elements that hold it, ends these."""
        if not self.holders or self.holders[-1] < max(self.places[t][-1] for t in FOREIGN if self.places[t]):
            self.cut(min(self.places[t][0] for t in FOREIGN if self.places[t]))

    def make_room(self, tag: str) -> None:
        """A block ends paragraphs, and its own kind, up to the next element that these can't reach out of."""
        ended = CLOSES.get(tag, {"p"})
        if not any(self.places[t] for t in ended):
            return
        fence = next((i for i in reversed(self.fences) if self.stack[i][0] not in ended), 0)
        lowest = [bisect.bisect(self.places[t], fence) for t in ended]
        places = [self.places[t][i] for t, i in zip(ended, lowest, strict=True) if i < len(self.places[t])]
        if places:
            self.cut(min(places))


def closes_itself(attributes: str) -> bool:
    """Whether a tag ends in a slash that is not the end of a bare value."""
    if not attributes.endswith("/"):
        return False
    last = attributes.rsplit(None, 1)[-1]
    return "=" not in last or last[-2:-1] in ("'", '"')


def parse(source: str, label: Callable[[str, str], int | None] | None = None) -> Page:
    """Read a page as browsers do in the main: unclosed elements end where they must, nothing fails."""
    nodes = [Node("html", -1, 0, 0)]
    runs: list[tuple[int, int, bool, str]] = []
    tags, at = Tags(source), Open()
    start = 0
    while start < len(source):
        found = tags.next()
        end = found[0] if found else len(source)
        if end > start and not at.unseen:
            text = source[start:end]
            if not text.isspace():
                runs.append((at.stack[-1][1], at.block, bool(at.places["a"]), text))
            elif runs and runs[-1][1] == at.block and not runs[-1][3][-1].isspace():  # a gap between inline elements
                runs[-1] = (*runs[-1][:3], runs[-1][3] + " ")
        if not found:
            break
        _, closing, tag, attributes = found
        start = tags.pos
        if not tag:
            continue
        if closing:
            at.close(tag)
            continue
        alone = closes_itself(attributes)
        if at.foreign and alone and tag not in BREAKOUT:
            continue
        if at.foreign and tag in BREAKOUT:
            at.leave_foreign()
        if tag in BLOCK and tag != "br":
            at.make_room(tag)
        at.block += tag in BLOCK
        if tag in VOID:
            continue
        if tag in RAW:
            tags.skip_past(tag)
            start = tags.pos
            continue
        if tag in ("html", "body"):
            continue
        node = at.stack[-1][1]
        if tag in BLOCK:
            own = label(tag, attributes) if label else None
            nodes.append(Node(tag, node, nodes[node].depth + 1, attribute_kinds(attributes) if attributes else 0, own))
            node = len(nodes) - 1
        if not alone or tag in BLOCK:
            at.push(tag, node)
    return Page(nodes, [(a, b, c, html.unescape(t) if "&" in t else t) for a, b, c, t in runs])


FEATURES = 28 + 2 * (len(KINDS) + 1) + 2 * len(TAG_KINDS)


def features(page: Page) -> np.ndarray:
    """One row per node; rows of nodes without text are of no use."""
    nodes, n = page.nodes, len(page.nodes)
    chars, linked, marks, digits, upper, words = (np.zeros(n) for _ in range(6))
    first, last = np.full(n, np.inf), np.zeros(n)
    blocks = [set() for _ in range(n)]
    total = 0
    for node, block, link, text in page.runs:
        size = len(text)
        chars[node] += size
        linked[node] += size * link
        marks[node] += text.count(".") + text.count(",") + text.count("!") + text.count("?") + text.count(";")
        words[node] += text.count(" ") + 1
        digits[node] += sum(map(text.count, "0123456789")) if text.isascii() else sum(map(str.isdigit, text))
        upper[node] += "\xa9" in text
        first[node] = min(first[node], total)
        total += size
        last[node] = max(last[node], total)
        blocks[node].add(block)
    own = chars.copy()
    n_blocks = np.array([len(b) for b in blocks], dtype=float)
    below, paragraphs, in_p = np.ones(n), np.zeros(n), np.zeros(n)
    kinds = np.array([x.kinds for x in nodes])
    above = np.zeros(n, dtype=np.int64)
    names = [TAG_KIND_OF.get(x.tag, "div") for x in nodes]
    tag_at = np.array([TAG_KINDS.index(t) for t in names])
    above_tag = np.zeros(n, dtype=np.int64)
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(1, n):
        p = nodes[i].parent
        children[p].append(i)
        above[i] = above[p] | kinds[p]
        above_tag[i] = above_tag[p] | (1 << int(tag_at[p]))
    for i in range(n - 1, -1, -1):
        if names[i] in ("p", "h", "title"):
            paragraphs[i] += 1
            in_p[i] = chars[i]
        p = nodes[i].parent
        if p >= 0:
            for a in (chars, linked, marks, words, digits, upper, n_blocks, below, paragraphs, in_p):
                a[p] += a[i]
            first[p], last[p] = min(first[p], first[i]), max(last[p], last[i])
    x = np.zeros((n, FEATURES))
    whole = max(total, 1)
    size = np.maximum(chars, 1)
    x[:, 0], x[:, 1], x[:, 2] = np.log1p(chars), linked / size, marks / size
    x[:, 3], x[:, 4], x[:, 5] = np.log1p(words), digits / size, upper
    x[:, 6], x[:, 7] = chars / whole, np.log1p(chars / below)
    x[:, 8], x[:, 9], x[:, 10] = np.log1p(below), np.log1p(paragraphs), in_p / size
    x[:, 11] = np.log1p(chars / np.maximum(n_blocks, 1))
    x[:, 12] = [node.depth for node in nodes]
    x[:, 13], x[:, 14] = np.minimum(first, whole) / whole, last / whole
    x[:, 15] = own / size
    for group in children:
        if not group:
            continue
        sizes = chars[group]
        top, mean = sizes.max(), sizes.mean()
        same = {}
        for i in group:
            same[names[i]] = same.get(names[i], 0) + 1
        for k, i in enumerate(group):
            x[i, 16:22] = (
                k / len(group), math.log1p(len(group)), same[names[i]], chars[i] >= top, chars[i] / max(mean, 1), len(group) - k
            )
            if k + 1 < len(group):
                x[i, 24], x[i, 25] = x[group[k + 1], 0], x[group[k + 1], 2]
            if k:
                x[i, 26], x[i, 27] = x[group[k - 1], 0], x[group[k - 1], 2]
    parent = np.array([max(node.parent, 0) for node in nodes])
    x[:, 22], x[:, 23] = x[parent, 7], x[parent, 1]
    at = 28
    for bit in range(len(KINDS) + 1):
        x[:, at], x[:, at + 1] = (kinds >> bit) & 1, (above >> bit) & 1
        at += 2
    for bit in range(len(TAG_KINDS)):
        x[:, at], x[:, at + 1] = tag_at == bit, (above_tag >> bit) & 1
        at += 2
    return x


def node_labels(page: Page) -> np.ndarray:
    """0: all text is article, 1: none is, 2: mixed, -1: no text. A node's own label holds below it until another."""
    n = len(page.nodes)
    label = np.zeros(n, dtype=int)
    for i, node in enumerate(page.nodes):
        label[i] = node.label if node.label is not None else (label[node.parent] if i else 0)
    yes, no = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    for node, *_ in page.runs:
        (yes if label[node] else no)[node] = True
    for i in range(n - 1, 0, -1):
        p = page.nodes[i].parent
        yes[p] |= yes[i]
        no[p] |= no[i]
    return np.where(yes & no, 2, np.where(yes, 0, np.where(no, 1, -1)))


def decode(page: Page, keep: np.ndarray, drop: np.ndarray) -> np.ndarray:
    """Whether each node's own text is kept, from how likely all of a node is article, or none of it."""
    n = len(page.nodes)
    has = np.zeros(n, dtype=bool)
    for node, *_ in page.runs:
        has[node] = True
    own_text = has.copy()
    for i in range(n - 1, 0, -1):
        has[page.nodes[i].parent] |= has[i]
    both = np.clip(1 - keep - drop, 0.02, 1.0)
    scores = np.log(np.clip(np.column_stack([keep, drop, both]), 1e-4, 1.0))
    scores[~has] = 0.0
    own = np.zeros(n, dtype=bool)
    best = scores.copy()
    leaf = np.ones(n, dtype=bool)
    for i in range(n - 1, -1, -1):
        own[i] = best[i, 0] > best[i, 1] if leaf[i] else scores[i, 0] > scores[i, 1]
        if leaf[i]:
            best[i, 2] = -np.inf
        if i and has[i]:
            p = page.nodes[i].parent
            best[p, 0] += best[i, 0]
            best[p, 1] += best[i, 1]
            best[p, 2] += best[i].max()
            leaf[p] = False
    kept, state = np.zeros(n, dtype=bool), np.full(n, 2)
    for i in range(n):
        above = state[page.nodes[i].parent] if i else 2
        state[i] = above if above < 2 else int(np.argmax(best[i]))
        kept[i] = own_text[i] and (state[i] == 0 or state[i] == 2 and own[i])
    return kept


def joined(page: Page, kept: np.ndarray) -> str:
    """Kept blocks in page order, white space as one blank."""
    out, last = [], None
    for node, block, _, text in page.runs:
        if kept[node]:
            if block != last:
                out.append([])
                last = block
            out[-1].append(text)
    return " ".join(t for t in (" ".join("".join(b).split()) for b in out) if t)


def meaning(tag: str, attributes: str) -> int | None:
    """What an element tells by itself: 1 article, 0 something else."""
    if 'data-keep="' in attributes:
        return int(attributes.split('data-keep="')[1][0])
    bits = attribute_kinds(attributes)
    other = bits & 0b111111110 and not bits & 1
    if tag == "main" or tag == "article" and not other:
        return 1
    return 0 if tag in ("nav", "footer", "aside", "form") or other else None


def relaid(page: Page, pick: np.random.Generator) -> str | None:
    """The sections of a page in another layout, labelled by data-keep; None if it has no article."""
    label = node_labels(page)
    paragraphs, other, heading, last = [], [], "", None
    for node, block, link, text in page.runs:
        text = html.escape(" ".join(text.split()))
        if not text:
            continue
        good = label[node] == 0 or (label[node] == 2 and page.nodes[node].tag in ("article", "main"))
        if good and page.nodes[node].tag.startswith("h"):
            heading = heading or text
        elif good and block == last:
            paragraphs[-1].append(text)
        elif good:
            paragraphs.append([text])
            last = block
        else:
            other.append(text)
    if not paragraphs:
        return None
    paragraphs = [" ".join(p) for p in paragraphs]
    source = " ".join(other + paragraphs[-1:]).split()
    if pick.random() < 0.3:
        paragraphs = paragraphs[: pick.integers(1, 3)]
    if pick.random() < 0.2:
        paragraphs = [" ".join(t.split()[: pick.integers(3, 30)]) for t in paragraphs]
    some = lambda n: " ".join(pick.choice(source, min(n, 40)))
    one = lambda xs: xs[pick.integers(len(xs))]
    maybe = lambda p: pick.random() < p

    def named(kind: str, tags: list[str], body: str, keep: int = 0) -> str:
        tag = one(tags)
        words = TOKENS[kind].split()
        a, b = one(words), one(["", "", "-box", "-wrap", "_inner", " block", "-area", " col-4", "Section"])
        attribute = one([f' class="{a}{b}"', f' id="{a}{b}"', f' class="{a}{b} {one(words)}"', f' class="c{pick.integers(99)}"', ""])
        return f'<{tag}{attribute} data-keep="{keep}">{body}</{tag}>'

    def links(n: int) -> str:
        items = "".join(f'<li><a href="#">{some(pick.integers(1, 4))}</a></li>' for _ in range(n))
        flat = one([" ", " | ", ""]).join(f'<a href="#">{some(2)}</a>' for _ in range(n))
        return one([f"<ul>{items}</ul>", flat, f"<h3>{some(2)}</h3><ul>{items}</ul>"])

    def para(t: str) -> str:
        if maybe(0.15) and " " in t:
            cut = t.split(" ")
            i = pick.integers(len(cut))
            cut[i] = one([f'<a href="#">{cut[i]}</a>', f"<em>{cut[i]}</em>", f"<span>{cut[i]}</span>"])
            t = " ".join(cut)
        return one([f"<p>{t}</p>", f"<p>{t}</p>", f"<p>{t}</p>", f"<p>{t}", f"<div>{t}</div>", f"<blockquote><p>{t}</p></blockquote>", f"<ul><li>{t}</li><li>{one(paragraphs)[:80]}</li></ul>"])

    def short() -> str:
        cells = lambda t, n: "".join(f"<{t}>{some(pick.integers(1, 3))}</{t}>" for _ in range(n))
        rows = "".join(f"<tr>{cells('td', 2)}</tr>" for _ in range(pick.integers(1, 4)))
        return one([
            f"<pre>{some(pick.integers(1, 7))}</pre>", f"<pre><code>{some(pick.integers(1, 7))}</code></pre>",
            f"<table>{rows}</table>", f"<table><tbody><tr>{cells('th', 2)}</tr>{rows}</tbody></table>",
            f"<h{(h := pick.integers(2, 5))}>{some(pick.integers(1, 5))}</h{h}>", f"<p>{some(pick.integers(1, 4))}</p>",
            f"<ul>{cells('li', pick.integers(1, 5))}</ul>", f"<ol>{cells('li', pick.integers(1, 5))}</ol>",
            f"<dl><dt>{some(1)}</dt><dd>{some(pick.integers(1, 5))}</dd></dl>", f"<blockquote>{some(pick.integers(2, 9))}</blockquote>",
            f'<figure><img src="a.png"><figcaption>{some(pick.integers(2, 7))}</figcaption></figure>',
        ])

    def extra(kind: str) -> str:
        return {
            "nav": lambda: named("nav", ["nav", "div", "ul", "div"], links(pick.integers(3, 9))),
            "header": lambda: named("header", ["header", "div"], f'<div class="logo"><a href="/">{some(2)}</a></div><p>{some(5)}</p>' + (links(4) if maybe(0.5) else "")),
            "footer": lambda: named("footer", ["footer", "div"], one(["&copy; ", ""]) + some(pick.integers(2, 9)) + (links(4) if maybe(0.5) else "") + (f"<p>{some(12)}</p>" if maybe(0.5) else "")),
            "side": lambda: named("side", ["aside", "div", "section"], f"<h3>{some(2)}</h3>" + one([links(5), f"<p>{some(20)}</p>", f"<p>{some(9)}</p>" + links(3)])),
            "ad": lambda: named("ad", ["div", "aside", "section"], one([some(6), f"<p>{some(14)}</p>", f'<a href="#">{some(8)}</a>'])),
            "notice": lambda: named("notice", ["div", "section", "p"], f"{some(18)} <button>{some(1)}</button>"),
            "form": lambda: named("form", ["form", "div"], f"<label>{some(2)}</label><input><p>{some(7)}</p><button>{some(1)}</button>"),
            "comment": lambda: named("comment", ["section", "div", "ol"], f"<h3>{some(2)}</h3>" + "".join(
                named("comment", ["div", "li", "article"], f"<b>{some(1)}</b><p>{some(pick.integers(5, 40))}</p>") for _ in range(pick.integers(1, 6)))),
        }[kind]()

    body = [para(t) for t in paragraphs]
    for _ in range(pick.integers(1, 5) if maybe(0.4) else 0):
        body.insert(pick.integers(len(body) + 1), short())
    for kind in ("ad", "side", "notice", "form"):
        if maybe(0.15):
            body.insert(pick.integers(len(body) + 1), extra(kind))
    if maybe(0.15):
        body.append(extra("comment"))
    title = f"<h1>{heading or some(5)}</h1>"
    core = title + "".join(body)
    if maybe(0.3):
        core = f"<div>{title}</div><div>{''.join(body)}</div>"
    article = named("text", ["article", "main", "div", "div", "section", "td"], core, 1)
    before = [extra(k) for k in ("header", "nav", "notice", "ad", "form", "side") if maybe(0.4)]
    after = [extra(k) for k in ("comment", "side", "ad", "nav", "form", "footer") if maybe(0.4)]
    inner = "".join(before) + article + "".join(after)
    wrap = pick.integers(3)
    if wrap == 1:
        inner = f'<div id="wrapper">{inner}</div>'
    elif wrap == 2:
        inner = "".join(before) + f'<div class="row"><div>{article}</div>{"".join(after[:1])}</div>' + "".join(after[1:])
    return f"<html><head><title>{heading}</title></head><body>{inner}</body></html>"


@dataclass
class Extractor:
    """The two sets of trees."""

    whole: boosting.Trees
    none: boosting.Trees

    def texts(self, sources: list[str]) -> list[str]:
        """Main texts of pages."""
        pages = [parse(s) for s in sources]
        x = np.concatenate([features(p) for p in pages]) if pages else np.zeros((0, FEATURES))
        keep, drop = self.whole.probability(x), self.none.probability(x)
        out, at = [], 0
        for p in pages:
            end = at + len(p.nodes)
            out.append(joined(p, decode(p, keep[at:end], drop[at:end])))
            at = end
        return out


def fit(sources: list[str], layouts: int = LAYOUTS, seed: int = 3) -> Extractor:
    """Learn from pages: as they are, and in `layouts` other layouts each."""
    pick = np.random.default_rng(seed)
    xs, ys = [np.zeros((0, FEATURES))], [np.zeros(0, dtype=int)]

    def learn(page: Page) -> None:
        y = node_labels(page)
        if (y == 0).any():
            xs.append(features(page)[y >= 0])
            ys.append(y[y >= 0])

    for source in sources:
        page = parse(source, meaning)
        for _ in range(2):
            learn(page)
        for _ in range(layouts):
            other = relaid(page, pick)
            if other:
                learn(parse(other, meaning))
    x, y = np.concatenate(xs), np.concatenate(ys)
    if not len(x):  # no page tells an article: all text is kept
        x, y = np.zeros((2, FEATURES)), np.array([0, 0])
    weight = x[:, 0] + 1
    weight /= weight.mean()
    return Extractor(boosting.fit(x, (y == 0).astype(float), weight), boosting.fit(x, (y == 1).astype(float), weight))


def extract(pages: DataFrame, keep: list[str], sample: int = SAMPLE_PAGES) -> DataFrame:
    """Columns `keep` of every row with text and n_chars (code points); NULL and empty pages give empty texts.

    The fit looks at the `sample` first pages by a hash of their columns; every page is read whole.
    """
    known = pages.where(F.col("html").isNotNull()).select(*dict.fromkeys([*keep, "html"]))
    known = first_by_hash(known, known.columns, sample).select("html").toPandas()["html"].tolist()
    shared = pages.sparkSession.sparkContext.broadcast(fit(known))

    def read(sources: list[str]) -> list:
        texts = shared.value.texts(sources)
        return [texts, [len(t) for t in texts]]

    return map_texts(pages, "html", keep, read, [("text", pa.string()), ("n_chars", pa.int64())])


def op7_main_text(spark, sf_dir) -> DataFrame:
    """Main text of all pages."""
    return extract(table(spark, sf_dir, "pages"), ["page_id", "url"])
