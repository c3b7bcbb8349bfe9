"""HTML extraction: gradient-boosted trees over DOM nodes, decoded from the root down.

Every block element, and every inline one with a class, id or role, is a node.  Its features
are its tag, cue words in its attributes and its ancestors', depth, text and link density of
its subtree, and how it compares with its siblings.  Trees fitted in numpy on generated pages of
many layouts give each node the log-odds of being main text.  A node is then main, boilerplate
or mixed as a whole: below a main node all is main, below a boilerplate node nothing is, and
only a mixed node leaves the choice to its children.  The choice of highest total is found
exactly by dynamic programming, so no node contradicts another.
"""

from __future__ import annotations

import html
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.shared import batches

# Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg object canvas select button annotation annotation-xml".split())
BLOCK = frozenset("html body address article aside blockquote caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup p pre section summary table tbody td tfoot th thead tr ul search".split())
SCOPE = frozenset("html body table td th li div section article main aside nav header footer form ul ol dl blockquote figure details fieldset dialog".split())
TAGS = "div p h1 h2 h3 li ul table tr td article main section nav aside header footer form blockquote pre figure figcaption dl span a body".split()
TAG_GROUP = {t: i + 1 for i, t in enumerate(TAGS)}
#: Cue words looked for in class, id, role and label attributes.
CUES = {
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs toc pager pagination tabs toolbar topbar skip masthead",
    "foot": "footer foot bottom copyright legal colophon contentinfo imprint",
    "head": "header head banner top logo brand hero",
    "side": "sidebar side aside rail widget widgets complementary column secondary",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner dfp adsense adslot affiliate teaser",
    "reader": "comment comments commentlist discussion disqus reply replies respond thread responses feedback reviews guestbook",
    "notice": "notice cookie cookies consent gdpr alert warning banner popup modal overlay toast message notification announcement paywall",
    "form": "form login signin signup subscribe subscription newsletter search input contact register",
    "share": "share sharing social follow like tweet facebook twitter whatsapp print email tools",
    "related": "related recommended recommendations more popular trending latest also links readmore tags tag author bio meta byline",
    "content": "content article main post entry story text body copy prose page single articlebody maincontent reading blog",
}
CUE_OF = {w: i for i, ws in enumerate(CUES.values()) for w in ws.split()}
CUE_BITS: dict[str, int] = {}
for _i, _ws in enumerate(CUES.values()):
    for _w in _ws.split():
        CUE_BITS[_w] = CUE_BITS.get(_w, 0) | 1 << _i
#: Elements that speak for themselves, as cue bits for what is below them.
TAG_CUES = {"nav": 1 << 0, "menu": 1 << 0, "footer": 1 << 1, "header": 1 << 2, "aside": 1 << 3, "form": 1 << 7, "search": 1 << 7, "dialog": 1 << 6, "article": 1 << 10, "main": 1 << 10}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|</(?P<close>[a-zA-Z][^\s>/]*)[^>]*>|<(?P<open>[a-zA-Z][^\s>/]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<(?P<loose>[a-zA-Z][^\s>/]*)[^<>]*>?",
    re.S,
)
ATTR = re.compile(r"(?:^|[\s/])(?:class|id|role|aria-label|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: A slash that ends the tag; one at the end of an unquoted value belongs to the value.
SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/$")


#: What ``cue_bits`` has found, emptied when it holds this many.
CUES_SEEN: dict[str, tuple[int, bool]] = {}
MOST_CUES = 20_000


def cue_bits(attrs: str) -> tuple[int, bool]:
    """Cue groups named in the attributes, and whether class, id or role is there at all."""
    if attrs in CUES_SEEN:
        return CUES_SEEN[attrs]
    bits, some = 0, False
    for m in ATTR.finditer(attrs):
        value, some = m[1] or m[2] or m[3] or "", True
        words = [w.lower() for w in PART.findall(value)]
        for w in (*words, *(a + b for a, b in zip(words, words[1:]))):
            bits |= CUE_BITS.get(w, 0)
    if len(CUES_SEEN) >= MOST_CUES:
        CUES_SEEN.clear()
    CUES_SEEN[attrs] = bits | (1 << 11 if HIDDEN.search(attrs) else 0), some
    return CUES_SEEN[attrs]


class Page:
    """Nodes in page order (parents first) and the pieces of text with the block they are in."""

    __slots__ = ("tag", "cues", "parent", "end", "depth", "chars", "linked", "words", "marks", "pieces", "controls")

    def __init__(self, source: str | None):
        self.tag, self.cues, self.parent, self.end, self.depth = [0], [0], [-1], [0], [0]
        self.chars, self.linked, self.words, self.marks, self.controls = [0], [0], [0], [0], [0]
        self.pieces: list[tuple[int, int, str]] = []
        self._read(source or "")

    def _read(self, s: str) -> None:
        stack: list[tuple[str, int]] = []  # open elements and the node they are in
        node, block, links, pos, n = 0, 0, 0, 0, len(s)
        tags, cues, parents, ends, depths = self.tag, self.cues, self.parent, self.end, self.depth
        chars, linked, words, marks, controls, pieces = self.chars, self.linked, self.words, self.marks, self.controls, self.pieces

        def text(t: str) -> None:
            pieces.append((block, node, t))
            bare = t.strip()
            if bare:
                size = len(bare)
                chars[node] += size
                words[node] += bare.count(" ") + 1
                marks[node] += bare.count(".") + bare.count(",") + bare.count("!") + bare.count("?")
                if links:
                    linked[node] += size

        def leave(to: int) -> None:
            nonlocal node, links
            while len(stack) > to:
                name, before = stack.pop()
                if name == "a":
                    links -= 1
                if before != node:
                    ends[node] = len(tags)
                    node = before

        match = TOKEN.search
        while pos < n:
            m = match(s, pos)
            if m is None:
                text(s[pos:])
                break
            if m.start() > pos:
                text(s[pos : m.start()])
            pos = m.end()
            kind = m.lastgroup
            if kind is None:
                continue
            if kind == "cdata":
                text(html.escape(m["cdata"]))
                continue
            if kind == "close":
                name = m["close"].lower()
                inline = name not in BLOCK
                if not inline:
                    block += 1
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == name:
                        leave(i)
                        break
                    if inline and stack[i][0] in BLOCK or stack[i][0] in ("td", "table") and name not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html"):
                        break
                continue
            name, attrs = (m["open"] or m["loose"]).lower(), m["attrs"] or ""
            if name in RAW:
                if not SELF_CLOSED.search(attrs):
                    close = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(s, pos)
                    pos = close.end() if close else (n if name in ("script", "style", "textarea", "title") else pos)
                if name in ("button", "select", "textarea"):
                    controls[node] += 1
                text(" ") if name not in ("script", "style", "template") else None
                continue
            if name == "head":
                close = re.compile(r"</head\s*>|<body\b", re.I).search(s, pos)
                if close:
                    pos = close.start() if close[0][1] != "/" else close.end()
                continue
            if name == "br":
                text(" ")
                continue
            if name in VOID:
                if name == "input":
                    controls[node] += 1
                elif name == "hr":
                    block += 1
                continue
            bits, some = cue_bits(attrs) if attrs else (0, False)
            is_block = name in BLOCK
            if is_block:
                block += 1
                # what this element closes unsaid
                shut = "li" if name == "li" else "p" if name not in ("html", "body") else ""
                for i in range(len(stack) - 1, -1, -1):
                    open_ = stack[i][0]
                    if open_ == shut or name in ("dt", "dd") and open_ in ("dt", "dd") or name in ("td", "th") and open_ in ("td", "th") or name == "tr" and open_ in ("tr", "td", "th") or name == "option" and open_ == "option":
                        if name == "tr" and i and stack[i - 1][0] == "tr":
                            i -= 1
                        leave(i)
                        break
                    if open_ in SCOPE and not (name == "tr" and open_ in ("td", "th")):
                        break
            stack.append((name, node))
            if name == "a":
                links += 1
            if is_block or some:
                tags.append(TAG_GROUP.get(name, 0))
                cues.append(bits | TAG_CUES.get(name, 0))
                parents.append(node)
                depths.append(depths[node] + 1)
                ends.append(0)
                for column in (chars, linked, words, marks, controls):
                    column.append(0)
                node = len(tags) - 1
        leave(0)
        ends[:] = [e or len(tags) for e in ends]


N_CUES = len(CUES) + 1


def features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A row for each node of all pages; its parent (-1 for a page's root), the end of its subtree and its own text length."""
    sizes = np.array([len(p.tag) for p in pages])
    base = np.cumsum(sizes) - sizes
    flat = lambda name: np.array([x for p in pages for x in getattr(p, name)], np.int64)
    root = np.repeat(base, sizes)
    tag, cues, depth = flat("tag"), flat("cues"), flat("depth")
    parent = flat("parent")
    parent = np.where(parent < 0, -1, parent + root)
    end = flat("end") + root
    n = len(tag)
    at = np.arange(n)
    own = {k: flat(k) for k in ("chars", "linked", "words", "marks", "controls")}
    below = {}
    for k, v in own.items():
        total = np.concatenate(([0], np.cumsum(v)))
        below[k] = (total[end] - total[at]).astype(np.float64)
        if k == "chars":
            ahead = (total[at] - total[root]).astype(np.float64)
    nodes = (end - at).astype(np.float64)
    all_chars = below["chars"][root]
    up = np.maximum(parent, 0)
    above = np.where(parent < 0, 0, cues[up])
    for _ in range(int(depth.max(initial=0))):
        more = np.where(parent < 0, 0, above[up] | cues[up])
        if (more == above).all():
            break
        above = more
    group = lambda values: np.array([((values >> i) & 1) for i in range(N_CUES)], np.float64)
    of_tag = lambda t: np.concatenate(([0], np.cumsum(tag == TAG_GROUP[t])))
    paragraphs, items, titles = of_tag("p"), of_tag("li"), of_tag("h1")
    kids = np.bincount(parent[parent >= 0], minlength=n).astype(np.float64)
    same = np.zeros(n)
    pair = up * 64 + tag
    _, back, counts = np.unique(pair, return_inverse=True, return_counts=True)
    same = counts[back].astype(np.float64)
    # place among the parent's children
    order = np.lexsort((at, up))
    first = np.concatenate(([True], up[order][1:] != up[order][:-1])) if n else np.zeros(0, bool)
    place = np.zeros(n)
    place[order] = np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0))
    chars = below["chars"]
    ratio = lambda a, b: a / np.maximum(b, 1)
    siblings = np.maximum(kids[up], 1)
    most = np.zeros(n)
    np.maximum.at(most, up, np.where(parent < 0, 0, chars))
    columns = [
        tag, tag[up], depth, np.log1p(chars), np.log1p(own["chars"]), ratio(below["linked"], chars), ratio(below["linked"][up], chars[up]),
        ratio(below["marks"], below["words"]), ratio(chars, below["words"]), ratio(chars, nodes), np.log1p(below["words"] / nodes), np.log1p(nodes), kids,
        below["controls"], below["controls"][up], ratio(chars, all_chars), ratio(ahead, all_chars), ratio(chars, chars[up]), ratio(chars, most[up]),
        place / siblings, siblings, same / siblings, paragraphs[end] - paragraphs[at], items[end] - items[at], titles[end] - titles[at],
        titles[end[up]] - titles[up], ratio(own["chars"], chars), np.log1p(chars[up]),
    ]
    return np.column_stack([*columns, *group(cues), *group(above), *group(cues[up])]).astype(np.float32), parent, end, own["chars"]


class Forest:
    """Boosted trees of fixed depth, as arrays: feature and threshold of each inner node, value of each leaf."""

    def __init__(self, bias: float, feature: np.ndarray, threshold: np.ndarray, value: np.ndarray):
        self.bias, self.feature, self.threshold, self.value = bias, feature, threshold, value

    def odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        levels = int(np.log2(self.value.shape[1]))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(levels):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            out += value[at - (len(value) - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.25, bins: int = 32, reg: float = 2.0) -> Forest:
    """Gradient boosting of the logistic loss by second-order gains over histograms."""
    n, f = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(f)]
    binned = np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
    cell = (binned + np.arange(f) * bins).ravel()
    mean = np.average(y, weights=weight)
    bias = float(np.log(mean / (1 - mean)))
    odds, found = np.full(n, bias), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-odds))
        g, h = (p - y) * weight, np.maximum(p * (1 - p), 1e-6) * weight
        at = np.zeros(n, np.int64)
        feature, threshold = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf, np.float32)
        for level in range(depth):
            lo, width = 2**level - 1, 2**level
            key = ((at - lo)[:, None] * (f * bins) + cell.reshape(n, f)).ravel()
            hist = [np.bincount(key, np.repeat(v, f), width * f * bins).reshape(width, f, bins) for v in (g, h)]
            left_g, left_h = (np.cumsum(v, axis=2) for v in hist)
            all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
            gain = left_g**2 / (left_h + reg) + (all_g - left_g) ** 2 / (all_h - left_h + reg) - all_g**2 / (all_h + reg)
            gain[(left_h < 1) | (all_h - left_h < 1)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            top = gain.reshape(width, -1).max(axis=1)
            for k in range(width):
                j, b = divmod(int(best[k]), bins)
                if top[k] > 1e-6 and b < len(cuts[j]):
                    feature[lo + k], threshold[lo + k] = j, cuts[j][b]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > threshold[at])
        leaf = at - (2**depth - 1)
        value = -rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + reg)
        odds += value[leaf]
        found.append((feature, threshold, value))
    return Forest(bias, *(np.array(v) for v in zip(*found)))


MIXED_COST = 1.5


def decode(odds: np.ndarray, parent: np.ndarray, end: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Main or not for every node, of the highest total under the rules above."""
    score = np.clip(odds, -6, 6) * np.where(own > 0, 1 + np.log1p(own), 0.5)
    total = np.concatenate(([0.0], np.cumsum(score)))
    whole = total[end] - total[: len(score)]
    sure = np.abs(whole)
    mixed = np.where(own > 0, np.abs(score), 0) - MIXED_COST
    for i in range(len(score) - 1, 0, -1):
        if parent[i] >= 0:
            mixed[parent[i]] += max(sure[i], mixed[i])
    keep = np.zeros(len(score), bool)
    fixed = np.zeros(len(score), bool)
    for i in range(len(score)):
        p = parent[i]
        if p >= 0 and fixed[p]:
            keep[i], fixed[i] = keep[p], True
        elif sure[i] >= mixed[i]:
            keep[i], fixed[i] = whole[i] > 0, True
        else:
            keep[i] = score[i] > 0
    return keep


def main_text(page: Page, keep: np.ndarray) -> str:
    blocks: list[str] = []
    current, bits = -1, []
    for block, node, text in page.pieces:
        if block != current:
            if bits:
                blocks.append("".join(bits))
            current, bits = block, []
        if keep[node]:
            bits.append(text)
    if bits:
        blocks.append("".join(bits))
    lines = (" ".join(html.unescape(b).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


#: Cue groups that speak against main text, and the mark of hidden elements.
AGAINST = sum(1 << i for i, name in enumerate(CUES) if name != "content") | 1 << len(CUES)


def unnamed(page: Page) -> np.ndarray:
    """For a page of which nothing is kept: what neither is nor stands in anything named as
    boilerplate, and is not mostly links."""
    keep = np.zeros(len(page.tag), bool)
    against = np.zeros(len(page.tag), bool)
    for i, parent in enumerate(page.parent):
        against[i] = bool(page.cues[i] & AGAINST and not page.cues[i] & 1 << 10) or parent >= 0 and against[parent]
        keep[i] = not against[i] and 2 * page.linked[i] <= page.chars[i]
    return keep


def extract_texts(sources: list[str | None], model: Forest) -> list[str]:
    out: list[str] = []
    lo = 0
    while lo < len(sources):
        hi, size = lo, 0
        while hi < len(sources) and (hi == lo or size + len(sources[hi] or "") < 2_000_000):
            size += len(sources[hi] or "")
            hi += 1
        pages = [Page(s) for s in sources[lo:hi]]
        x, parent, end, own = features(pages)
        keep = decode(model.odds(x), parent, end, own)
        at = 0
        for p in pages:
            text = main_text(p, keep[at : at + len(p.tag)])
            out.append(text or main_text(p, unnamed(p)))
            at += len(p.tag)
        lo = hi
    return out


# ------------------------------------------------------------- generated pages to learn from


#: Shares of pages without a frame, and of <article> and <main> elements that list links.
BARE, LISTS = 0.08, 0.1


class Maker:
    """Pages of many layouts; a private-use sign marks main text, so labels need no rules."""

    MARK = "\ue000"

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, lo: int, hi: int) -> str:
        r = self.r
        return " ".join("".join(r.choice(("an", "er", "the", "ti", "on", "re", "st", "ou", "de", "la")) for _ in range(r.randint(1, 3))) for _ in range(r.randint(lo, hi)))

    def sentence(self, lo: int = 4, hi: int = 22) -> str:
        t = self.words(lo, hi)
        return t[0].upper() + t[1:] + self.r.choice((".", ".", ".", "!", "?", ", &amp; more."))

    def named(self, tag: str, cue: str | None, often: float = 0.8) -> str:
        r = self.r
        if cue and r.random() < often:
            word = r.choice(CUES[cue].split())
            if r.random() < 0.4:
                word = r.choice((f"{word}-{r.choice(('wrap', 'box', 'inner', 'block', 'list', 'x1'))}", f"site-{word}", f"{word}_{r.randint(1, 9)}", f"col {word}"))
            return f'<{tag} {r.choice(("class", "id", "class", "role"))}="{word}">'
        if r.random() < 0.2:
            return f'<{tag} class="{self.words(1, 1)}{r.randint(1, 99)}">'
        return f"<{tag}>"

    def links(self, n: int) -> str:
        r, style = self.r, self.r.random()
        rows = [f'<a href="/{self.words(1, 1)}">{self.words(1, 3)}</a>' for _ in range(n)]
        if style < 0.6:
            return "<ul>" + "".join(f"<li>{x}</li>" if r.random() < 0.95 else f"<li>{x}" for x in rows) + "</ul>"
        return (" | " if style < 0.8 else " ").join(rows)

    def junk(self) -> str:
        r = self.r
        kind = r.choice(("menu", "foot", "head", "side", "advert", "reader", "notice", "form", "share", "related"))
        tag = r.choice({"menu": ("nav", "div", "ul"), "foot": ("footer", "div"), "head": ("header", "div"), "side": ("aside", "div")}.get(kind, ("div", "section", "aside", "div")))
        if kind == "reader":
            return self.reader(tag)
        if kind in ("menu", "share"):
            body = self.links(r.randint(2, 9))
        elif kind == "related":
            body = f"<h3>{self.words(1, 3)}</h3>" + self.links(r.randint(2, 6)) + (f"<p>{self.sentence(3, 9)}</p>" if r.random() < 0.3 else "")
        elif kind == "form":
            tag, body = r.choice(("form", "div")), f'<label>{self.words(1, 3)}</label><input name="q"><button>{self.words(1, 2)}</button>' + (f"<p>{self.sentence(4, 12)}</p>" if r.random() < 0.5 else "")
        elif kind == "foot":
            body = f"&copy; {self.words(1, 2)} &middot; " + self.sentence() + (self.links(3) if r.random() < 0.5 else "") + (f"<p>{self.sentence()} {self.sentence()}</p>" if r.random() < 0.3 else "")
        elif kind == "head":
            body = r.choice((f"<a href='/'>{self.words(1, 2)}</a>", f"<h1>{self.words(1, 3)}</h1>", f"<div>{self.words(1, 4)}</div>")) + (f"<p>{self.sentence(3, 8)}</p>" if r.random() < 0.4 else "")
        else:
            body = " ".join(self.sentence() for _ in range(r.randint(1, 3)))
            if r.random() < 0.5:
                body = f"<p>{body}</p>" + (f"<p>{self.sentence()}</p>" if r.random() < 0.4 else "")
            if r.random() < 0.3:
                body = f"<h3>{self.words(1, 3)}</h3>" + body
            if kind == "side" and r.random() < 0.6:
                body += self.links(r.randint(2, 6))
        own = 0.97 if kind in ("advert", "notice") else 0.5 if tag in ("nav", "footer", "header", "aside", "form") else 0.92
        return self.named(tag, kind, own) + body + ("" if tag == "p" else f"</{tag}>")

    def reader(self, tag: str = "div") -> str:
        r = self.r
        inner = r.choice(("div", "li", "article", "div"))
        rows = "".join(self.named(inner, "reader", 0.7) + f"<b>{self.words(1, 2)}</b> <p>{' '.join(self.sentence() for _ in range(r.randint(1, 4)))}</p></{inner}>" for _ in range(r.randint(1, 5)))
        return self.named(tag, "reader", 0.97) + (f"<h3>{self.words(1, 2)}</h3>" if r.random() < 0.6 else "") + rows + f"</{tag}>"

    def good(self, text: str) -> str:
        return self.MARK + text

    def paragraph(self) -> str:
        r, n = self.r, self.r.choice((1, 1, 2, 3, 5, 9))
        if r.random() < 0.14:
            return self.good(self.words(1, 6) + r.choice((".", ".", "", ":", "!")))
        text = " ".join(self.sentence() for _ in range(n))
        if r.random() < 0.25:
            text += f' <a href="/x">{self.words(1, 4)}</a> {self.sentence()}'
        if r.random() < 0.2:
            text = f"<b>{self.words(1, 4)}</b> " + text
        return self.good(text)

    def body(self, lists: float = 0) -> str:
        r, out = self.r, []
        if r.random() < 0.85:
            out.append(f"<h1>{self.good(self.words(2, 9))}</h1>")
            if r.random() < 0.2:
                out[-1] = f"<header>{out[-1]}</header>"
        if r.random() < lists:
            return "".join(out) + (f"<p>{self.paragraph()}</p>" if r.random() < 0.5 else "") + self.reading(r.randint(3, 14))
        broken = r.random() < 0.3
        for _ in range(r.choice((1, 2, 3, 5, 8, 14, 30))):
            kind = r.random()
            if kind < 0.72:
                if broken and r.random() < 0.3:
                    out.append(f"<p><b>{self.paragraph()}<br>")
                elif r.random() < 0.12:
                    out.append(f"<p>{self.paragraph()}<br>{self.words(2, 9)}</p>")
                else:
                    out.append(f"<p>{self.paragraph()}" + ("</p>" if r.random() < 0.9 else ""))
            elif kind < 0.80:
                out.append(f"<h{r.choice((2, 3))}>{self.good(self.words(1, 6))}</h2>".replace("</h2>", "</h3>") if r.random() < 0.3 else f"<h2>{self.good(self.words(1, 6))}</h2>")
            elif kind < 0.87:
                out.append("<ul>" + "".join(f"<li>{self.good(self.sentence(2, 12))}</li>" for _ in range(r.randint(2, 6))) + "</ul>")
            elif kind < 0.90:
                out.append(f"<blockquote><p>{self.paragraph()}</p></blockquote>")
            elif kind < 0.93:
                out.append("<table>" + "".join("<tr>" + "".join(f"<td>{self.good(self.words(1, 4))}</td>" for _ in range(3)) + "</tr>" for _ in range(r.randint(1, 4))) + "</table>")
            elif kind < 0.95:
                out.append(f"<figure><img src=x><figcaption>{self.good(self.sentence())}</figcaption></figure>")
            elif kind < 0.96:
                out.append(f"<div>{self.paragraph()}</div>")
            elif len(out) > 1:
                out.append(self.junk())
        return "".join(out)

    def reading(self, n: int) -> str:
        """A list of links that is the content: titles of some words, some with a remark."""
        r, remarks = self.r, self.r.random() < 0.4
        rows = [f'<a href="/{self.words(1, 1)}">{self.good(self.words(1, 9))}</a>' + (f" {self.sentence(2, 9)}" if remarks and r.random() < 0.7 else "") for _ in range(n)]
        tag = r.choice(("ul", "ul", "ol"))
        return f"<{tag}>" + "".join(f"<li>{x}</li>" for x in rows) + f"</{tag}>"

    def bare(self) -> str:
        """Text without a frame: a fragment, or a body that holds its blocks itself."""
        r = self.r
        kind = r.random()
        if kind < 0.2:
            return self.paragraph()
        if kind < 0.4:
            inner = "".join(f"<p>{self.paragraph()}</p>" for _ in range(r.choice((1, 1, 2, 3))))
        elif kind < 0.6:
            inner = f"<h1>{self.good(self.words(1, 6))}</h1>{self.paragraph()}"
        else:
            inner = (self.junk() if r.random() < 0.4 else "") + self.body() + (self.junk() if r.random() < 0.4 else "")
        return inner if r.random() < 0.3 else f"<html><head><title>{self.words(2, 6)}</title></head><body>{inner}</body></html>"

    def page(self) -> str:
        r = self.r
        if r.random() < BARE:
            return self.bare()
        main = r.choice(("article", "article", "main", "div", "div", "section", "td"))
        content = self.named(main, "content", 0.5 if main in ("article", "main") else 0.85) + self.body(LISTS if main in ("article", "main") else 0)
        content += (self.reader(r.choice(("div", "section"))) if r.random() < 0.15 else "") + f"</{main}>"
        if main == "td":
            content = f"<table><tr><td>{self.links(5)}</td>{content}</tr></table>"
        if r.random() < 0.35:
            content = self.named(r.choice(("div", "main", "section")), r.choice(("content", None)), 0.6) + content + (self.junk() if r.random() < 0.4 else "") + "</div>"
        before = [self.junk() for _ in range(r.choice((0, 1, 2, 2, 3, 4)))]
        after = [self.junk() for _ in range(r.choice((0, 1, 1, 2, 3, 4)))]
        if r.random() < 0.4:
            before.insert(0, self.named("nav", "menu", 0.4) + self.links(r.randint(3, 8)) + "</nav>")
        if r.random() < 0.5:
            after.append(self.named("footer", "foot", 0.3) + f"&copy; {self.words(1, 3)} {self.sentence()}</footer>")
        if r.random() < 0.3:
            after.append(self.reader())
        return f"<html><head><title>{self.words(2, 6)}</title></head><body>{''.join(before)}{content}{''.join(after)}</body></html>"


TRAIN_PAGES = 1600
MODELS: dict[tuple[int, int], Forest] = {}


def labelled(pages: list[Page]) -> tuple[np.ndarray, np.ndarray]:
    """Of every node the share of its subtree's text that is main, and that text's length."""
    main, chars = [], []
    for p in pages:
        own, good = np.zeros(len(p.tag)), np.zeros(len(p.tag))
        block, marked = -1, False
        for b, node, text in p.pieces:
            if b != block:
                block, marked = b, False
            marked = marked or Maker.MARK in text
            size = len(text.strip())
            own[node] += size
            good[node] += size * marked
        for values, out in ((own, chars), (good, main)):
            total = np.concatenate(([0], np.cumsum(values)))
            out.append(total[np.array(p.end)] - total[: len(values)])
    main, chars = np.concatenate(main), np.concatenate(chars)
    return main / np.maximum(chars, 1), chars


def fit(pages: int = TRAIN_PAGES, seed: int = 5) -> Forest:
    """The model for generated pages; the same on every run, and kept by the process.

    Nodes with both kinds of text below them teach nothing: decoding handles them."""
    if (pages, seed) not in MODELS:
        maker = Maker(seed)
        made = [Page(maker.page()) for _ in range(pages)]
        share, chars = labelled(made)
        for p in made:  # the marks must not be seen in the features
            p.chars = [max(0, c - 1) if c else 0 for c in p.chars]
        x, *_ = features(made)
        pure = (chars > 0) & ((share > 0.99) | (share < 0.01))
        MODELS[pages, seed] = boost(x[pure], (share[pure] > 0.5).astype(float), 1 + np.log1p(chars[pure]) / 4)
        CUES_SEEN.clear()  # it goes to the workers with the functions that use it
    return MODELS[pages, seed]


def extract(pages: DataFrame, model: Forest | None = None) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row; null or empty html gives ''.

    Pages of any length are read whole; repeated rows, null ids and null urls come out as they are,
    each row for itself, so there are no ties; an empty table gives no rows, and further columns are
    left out.  The model, under 1 MB, is fitted on the driver and sent to the workers."""
    model = model or fit()
    # arrays only: a broadcast names classes instead of carrying them
    shared = pages.sparkSession.sparkContext.broadcast((model.bias, model.feature, model.threshold, model.value))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = extract_texts(batch.column(2).to_pylist(), Forest(*shared.value))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return batches(pages.select("page_id", "url", F.col("html")), work, f"page_id {kind}, url string, text string, n_chars long")
