"""Main text of web pages by gradient-boosted trees over DOM nodes.

A page becomes a tree of its block-level elements (inline elements only add to the counts
of the block that holds them). Each node has features of its subtree (text, density of text,
links, punctuation, list items, form controls), its attribute tokens and those above it, its
depth and its siblings. Boosted trees, trained in numpy, give each node a logit for being main
text. Decoding then finds the best labelling of the whole tree in which every path from the root runs
outside, then inside, then cut out: nothing below a cut is kept, and nothing kept lies
beside its own exclusion.

The table has no labels, so the trees learn from TRAIN_PAGES pages that a seeded generator
lays out in many ways (``training_page``); scripts, styles, comments, markup and the
elements in DROPPED are removed by the parser, not learned. Of an element in DROPPED all text up to
its end tag goes. Where it has none, it ends as in browsers (a second button ends the first, a
paragraph an svg) or where a block around it ends, and only what comes before its first
block-level start tag goes. The text of math stays.

Defined results: null and empty pages have empty text; a page without any tag is one block of
text; unclosed, crossed and stray tags are repaired as browsers do for the common cases; unknown and custom
elements are inline; a page is parsed in time linear in its length, whatever its markup. Rows
come back one for one, their columns inside ``row``, the text and its length inside ``found``.
"""

from __future__ import annotations

import bisect
import html
import math
import random
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtrend.llm.common import slices, whole_row

TRAIN_PAGES = 500
TREES, DEPTH, BINS, SHRINKAGE = 60, 4, 32, 0.2
#: What a change between outside, inside and cut out costs, in units of a logit.
SWITCH = 0.5

#: Elements of HTML.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "plaintext"}
DROPPED = {"head", "noscript", "template", "svg", "select", "button", "object", "canvas", "audio", "video", "datalist", "dialog"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
MATH = set("math mi mo mn ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mmultiscripts mprescripts none mtable mtr mlabeledtr mtd mstyle merror mpadded mphantom mspace mfenced menclose maction semantics annotation annotation-xml".split())
CLOSES_P = set("address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
#: Block-level start tags; where an element without text of the page never ends, the page goes on at the first one.
BLOCKS = CLOSES_P | {"li", "dt", "dd", "caption", "thead", "tbody", "tfoot", "tr", "td", "th"}
#: All elements that are blocks of their own; every other one, unknown and custom ones too, is inline.
BLOCK_LEVEL = BLOCKS | {"html", "body", "legend", "optgroup", "option", "colgroup", "search", "listing"}
#: Start tags that end an open svg, except in the elements of SVG_HTML.
LEAVES_SVG = BLOCKS | set("b big code em embed i img nobr ruby s small span strong strike sub sup tt u var br".split())
SVG_HTML = ("foreignobject", "desc", "title")
#: What a head can hold; everything else ends it.
HEAD = set("head html base basefont bgsound link meta title script style noscript noframes template".split())
#: A button inside one of these does not end the button outside.
SCOPES = ("object", "template", "caption", "table", "td", "th")
#: Start tags that end an open element of the first set, unless one of the second set lies between.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
TAG_GROUPS = [
    {"nav", "menu"}, {"header", "hgroup"}, {"footer"}, {"aside"}, {"article", "main"}, {"section"}, {"div", "center"}, {"p"},
    {"h1", "h2", "h3", "h4", "h5", "h6"}, {"ul", "ol", "dl"}, {"li", "dt", "dd"}, {"form", "fieldset"}, {"table", "tbody", "tr", "td", "th"}, {"blockquote", "pre"}, {"figure", "figcaption"},
]
TOKEN_GROUPS = [
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc", "header masthead banner topbar logo branding", "footer foot copyright colophon legal",
    "sidebar side aside widget rail related recommended more trending popular tags", "ad ads adsbygoogle advert advertisement sponsor sponsored promo promotion",
    "cookie cookies consent gdpr notice alert popup modal overlay", "comment comments reply replies respond disqus discussion", "share sharing social follow",
    "form login signup subscribe newsletter search", "content article post entry main story body text page",
]
_GROUP_OF = {word: k for k, words in enumerate(TOKEN_GROUPS) for word in words.split()}
_TAG_OF = {tag: k for k, tags in enumerate(TAG_GROUPS) for tag in tags}
HASHED = 4

_TAG = r"<(/?)([A-Za-z][^\s/>]*+)"
_PARTS = r"<!--(?:-?>|.*?(?:--!?>|\Z))|{quoted}|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+(?:>|\Z)|([^<]++)|<"
_TOKEN = re.compile(_PARTS.format(quoted=_TAG + r"((?>[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"), re.S)
#: The same for tags whose quotes do not end.
_LOOSE = re.compile(_PARTS.format(quoted=r"(?!)()()()"), re.S)
_LESS = re.compile("<" + "()" * 7)
_TAG_NAME = re.compile(_TAG)
_SPECIAL = re.compile("[\"'>]")
_TOKENS_IN = re.compile(r"(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|[0-9]+")
_PUNCTUATION = re.compile(r"[.,;:!?]")


class Tokens:
    """The tags, comments and texts of a page, each found in constant time on average, whatever the markup."""

    def __init__(self, source: str):
        self.source = source
        self.last = source.rfind(">")
        self.ends: tuple[list[int], list[bool]] | None = None

    def at(self, place: int) -> re.Match:
        source = self.source
        if source[place] != "<" or source.startswith(("<!", "<?"), place):
            return _TOKEN.match(source, place)
        if place > self.last:  # no tag can end
            return (_LOOSE if source.startswith("</", place) else _LESS).match(source, place)
        if self.ends is None:
            m = _TOKEN.match(source, place)
            if m[2] is None and m[5] is not None:  # a quote does not end: find out once where that is so
                self._find_ends()
            return m
        name = _TAG_NAME.match(source, place)
        if name is None:
            return _TOKEN.match(source, place)
        places, ends = self.ends
        k = bisect.bisect_left(places, name.end())
        return (_TOKEN if k < len(places) and ends[k] else _LOOSE).match(source, place)

    def _find_ends(self) -> None:
        """For each quote and ``>``: whether a tag that gets there outside quotes finds its end."""
        places = [m.start() for m in _SPECIAL.finditer(self.source)]
        ends = [False] * (len(places) + 1)
        following = {'"': len(places), "'": len(places)}
        for k in range(len(places) - 1, -1, -1):
            c = self.source[places[k]]
            if c == ">":
                ends[k] = True
            else:
                other = following[c]
                ends[k] = other < len(places) and ends[other + 1]
                following[c] = k
        self.ends = places, ends


class Page:
    """The block tree of a page, and its text in page order."""

    def __init__(self, source: str):
        self.tag: list[str] = ["#root"]
        self.parent = [-1]
        self.groups: list[set[int]] = [set()]
        self.hashed: list[set[int]] = [set()]
        self.depth, self.place = [0], [0]
        self.children = [0]
        self.counts: list[list[float]] = [[0.0] * 6]  # own: characters, in links, punctuation, words, links, controls
        self.flow: list[tuple[int, str | None]] = []  # text of a node, or the edge of a block
        self.open: Counter[str] = Counter()  # names of the open elements
        self.behind: dict[int, int] = {}  # where the page goes on after the dropped element that begins at a place
        self.tokens = Tokens(source)
        self._parse(source)

    def _open(self, parent: int, tag: str, attributes: str) -> int:
        node = len(self.tag)
        self.tag.append(tag)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.place.append(self.children[parent])
        self.children[parent] += 1
        self.children.append(0)
        self.counts.append([0.0] * 6)
        groups, hashed = set(), set()
        if "=" in attributes:
            for m in _TOKENS_IN.finditer(attributes):
                for word in _WORD.findall(m[1] or m[2] or m[3] or ""):
                    word = word.lower()
                    if word in _GROUP_OF:
                        groups.add(_GROUP_OF[word])
                    hashed.add(sum(word.encode()) % HASHED)
        self.groups.append(groups)
        self.hashed.append(hashed)
        return node

    def _parse(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("#root", 0)]  # open elements with the block that holds their text
        at: dict[str, list[int]] = defaultdict(list)  # for each name the places in the stack
        blocks = [0]  # the places of blocks
        place, links, end = 0, 0, len(source)
        tokens = self.tokens
        edge = lambda: self.flow.append((stack[-1][1], None))

        def pop_to(k: int) -> None:
            nonlocal links
            block = blocks[-1] >= k
            if block:
                edge()
            for name, _ in stack[k:]:
                links -= name == "a"
                self.open[name] -= 1
                at[name].pop()
                if name in BLOCK_LEVEL:
                    blocks.pop()
            del stack[k:]

        def push(name: str, node: int) -> None:
            at[name].append(len(stack))
            if name in BLOCK_LEVEL:
                blocks.append(len(stack))
            stack.append((name, node))
            self.open[name] += 1

        while place < end:
            m = tokens.at(place)
            begin, place = place, m.end()
            name = m[2] or m[5]
            if not name:
                if m[7] or m[0] == "<":
                    node = stack[-1][1]
                    text = html.unescape(m[0]) if "&" in m[0] else m[0]
                    self.flow.append((node, text))
                    n = len(text) - text.count(" ") if not text.isspace() else 0
                    if n:
                        own = self.counts[node]
                        own[0] += n
                        own[1] += n if links else 0
                        own[2] += len(_PUNCTUATION.findall(text))
                        own[3] += len(text.split())
                continue
            name, closing, attributes = name.lower(), m[1] or m[4], m[3] or m[6] or ""
            if closing:
                if at[name]:
                    if name in BLOCK_LEVEL or at[name][-1] > blocks[-1]:
                        pop_to(at[name][-1])
                elif name == "p":
                    edge()
                continue
            if name in RAW:
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(source, place)
                place = (source.find(">", close.end()) + 1 or end) if close else end
                continue
            if name in DROPPED:
                if not attributes.rstrip().endswith("/"):
                    if begin not in self.behind:
                        self._skip(source, begin, place, name)
                    place = self.behind[begin]
                continue
            if name == "body" or name == "html":
                edge()
                continue
            if name in CLOSES_P and stack[blocks[-1]][0] == "p":
                pop_to(blocks[-1])
            if name in SIBLINGS:
                ends, stops = SIBLINGS[name]
                stop = max((at[x][-1] for x in stops if at[x]), default=0)
                inside = [at[x][k] for x in ends if (k := bisect.bisect(at[x], stop)) < len(at[x])]
                if inside:
                    pop_to(min(inside))
            node = stack[-1][1]
            if name not in BLOCK_LEVEL:
                if name == "a":
                    self.counts[node][4] += 1
                    links += 1
                elif name == "input":
                    self.counts[node][5] += 1
                elif name in ("br", "mtd"):
                    self.flow.append((node, " "))
                if name not in VOID and not (name in MATH and attributes.rstrip().endswith("/")):
                    push(name, node)
                continue
            edge()
            if name not in VOID:
                push(name, self._open(node, name, attributes))

    def _skip(self, source: str, begin: int, place: int, dropped: str) -> None:
        """Notes in ``behind`` where the page goes on after a dropped element, and after those met inside it.

        Behind its end tag; without one, at its first block-level start tag, or else where it is ended.
        What is met inside is noted too, so no part of a page is read for this more than once.
        """
        stack: list[tuple[str, int]] = []  # open elements in here with the place of their start tags
        at: dict[str, list[int]] = defaultdict(list)  # for each name the places in the stack
        inner: list[int] = []  # places in the stack of dropped elements
        block: dict[int, int] = {}  # for these the first block inside, not counting what is in others with an end tag

        def push(name: str, begin: int) -> None:
            at[name].append(len(stack))
            if name in DROPPED:
                inner.append(len(stack))
            stack.append((name, begin))

        def pop_to(k: int, end: int, closed: int | None = None) -> bool:
            """Ends the elements from k on at a place; the first one has an end tag up to ``closed``."""
            while len(stack) > k:
                name, begin = stack.pop()
                n = len(stack)
                at[name].pop()
                if name in DROPPED:
                    inner.pop()
                    first = block.pop(n, None)
                    if closed is not None and n == k:
                        self.behind[begin] = closed
                    else:
                        self.behind[begin] = end if first is None else first
                        if first is not None and inner:
                            block.setdefault(inner[-1], first)
            return not stack

        def top(*names: str) -> int:
            return max((at[x][-1] for x in names if at[x]), default=-1)

        push(dropped, begin)
        while place < len(source):
            m = self.tokens.at(place)
            begin, place = place, m.end()
            name = m[2] or m[5]
            if not name:
                if stack[-1][0] == "head" and (m[7] or m[0]) and not m[0].startswith(("<!", "<?", "</")) and not m[0].isspace():
                    pop_to(0, begin)  # text ends a head
                    return
                continue
            name, closing, attributes = name.lower(), m[1] or m[4], m[3] or m[6] or ""
            foreign = top("svg") > top(*SVG_HTML)
            if closing:
                if at[name]:
                    if pop_to(at[name][-1], begin, place):
                        return
                elif name in ("body", "html") or (self.open[name] > 0 and (name in BLOCK_LEVEL or stack[0][0] == "svg")):
                    pop_to(0, begin)
                    return
                continue
            if name == "body" and at["head"] or stack[-1][0] == "head" and name not in HEAD:
                pop_to(0, begin)
                return
            if foreign and name in LEAVES_SVG:
                while at["svg"] and top("svg") > top(*SVG_HTML):
                    if pop_to(at["svg"][-1], begin):
                        return
            if name in BLOCKS:
                block.setdefault(inner[-1], begin)
            ends = top("select") if name in ("select", "input", "textarea") else top(name) if name == "noscript" or (name == "button" and top(name) > top(*SCOPES)) else -1
            if ends >= 0 and pop_to(ends, begin):
                return
            if name in VOID or name in ("head", "html", "body") or (attributes.rstrip().endswith("/") and (name in DROPPED or foreign)):
                continue
            if name in RAW and not at["svg"] and not at["noscript"]:
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(source, place)
                place = (source.find(">", close.end()) + 1 or len(source)) if close else len(source)
                continue
            push(name, begin)
        pop_to(0, len(source))

    def features(self) -> np.ndarray:
        """A row a node."""
        n = len(self.tag)
        own = np.array(self.counts)
        parent, depth = np.array(self.parent), np.array(self.depth)
        tag = np.array([_TAG_OF.get(t, -1) for t in self.tag])
        groups = np.zeros((n, len(TOKEN_GROUPS)))
        for k, g in enumerate(self.groups):
            for x in g:
                groups[k, x] = 1
        hashed = np.zeros((n, HASHED))
        for k, g in enumerate(self.hashed):
            for x in g:
                hashed[k, x] = 1
        kinds = np.zeros((n, len(TAG_GROUPS)))
        kinds[tag >= 0, tag[tag >= 0]] = 1
        sums = np.concatenate([own, np.ones((n, 1)), kinds[:, [7, 10]]], axis=1)
        for k in range(n - 1, 0, -1):  # a parent comes before its children
            sums[parent[k]] += sums[k]
        above = np.concatenate([groups, kinds[:, [0, 1, 2, 3, 4, 11]]], axis=1)
        for k in range(1, n):
            np.maximum(above[k], above[parent[k]], out=above[k])
        before = np.concatenate([[0], np.cumsum(own[:, 0])])[:-1]
        total = max(float(own[:, 0].sum()), 1.0)
        chars, up = sums[:, 0], np.maximum(parent, 0)
        siblings = np.array(self.children)[up]
        safe = np.maximum(chars, 1)
        shape = np.stack(
            [
                np.log1p(chars), np.log1p(own[:, 0]), sums[:, 1] / safe, sums[:, 2] / safe, chars / sums[:, 6], chars / np.maximum(sums[:, 3], 1), np.log1p(sums[:, 4]), np.log1p(sums[:, 5]),
                chars / total, before / total, depth, np.array(self.place), siblings, np.array(self.place) / np.maximum(siblings, 1), np.log1p(sums[:, 7]), np.log1p(sums[:, 8]),
                (sums[:, 1] / safe)[up], np.log1p(chars[up]), np.log1p(sums[up, 7]),
            ],
            axis=1,
        )
        return np.concatenate([shape, kinds, groups, above, hashed], axis=1).astype(np.float32)

    def decode(self, logits: np.ndarray) -> np.ndarray:
        """Which nodes are inside, in the best labelling without contradictions."""
        n = len(self.tag)
        inside, outside = logits.tolist(), [0.0] * n
        for k in range(n):
            inside[k] *= 1 + 0.2 * math.log1p(self.counts[k][0])
        for k in range(n - 1, 0, -1):
            up = self.parent[k]
            inside[up] += max(inside[k], -SWITCH)
            outside[up] += max(outside[k], inside[k] - SWITCH)
        state = np.zeros(n, np.int8)  # 0 outside, 1 inside, 2 cut out
        state[0] = inside[0] - SWITCH > outside[0]
        for k in range(1, n):
            above = state[self.parent[k]]
            state[k] = 2 if above == 2 else (1 if inside[k] >= -SWITCH else 2) if above else inside[k] - SWITCH > outside[k]
        return state == 1

    def text(self, keep: np.ndarray) -> str:
        blocks, now = [], []
        for node, part in self.flow:
            if part is None:
                blocks.append(" ".join("".join(now).split()))
                now = []
            elif keep[node]:
                now.append(part)
        blocks.append(" ".join("".join(now).split()))
        return "\n".join(x for x in blocks if x)


class Trees:
    """Boosted regression trees for the logistic loss, of equal depth, over binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
        self.base = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
        z = np.full(len(y), self.base)
        self.feature, self.cut, self.leaf = [], [], []
        columns = np.arange(x.shape[1]) * BINS
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-z))
            g, h = y - p, p * (1 - p)
            at = np.zeros(len(y), np.int64)
            feature, cut = np.zeros((1 << DEPTH) - 1, np.int64), np.full((1 << DEPTH) - 1, np.inf, np.float32)
            for level in range(DEPTH):
                wide = 1 << level
                slot = (at[:, None] * (x.shape[1] * BINS) + columns + binned).ravel()
                size = wide * x.shape[1] * BINS
                sum_g, sum_h = (np.bincount(slot, np.repeat(v, x.shape[1]), size).reshape(wide, x.shape[1], BINS) for v in (g, h))
                left_g, left_h = sum_g.cumsum(axis=2)[:, :, :-1], sum_h.cumsum(axis=2)[:, :, :-1]
                all_g, all_h = sum_g.sum(axis=2)[:, :, None], sum_h.sum(axis=2)[:, :, None]
                gain = left_g**2 / (left_h + 1) + (all_g - left_g) ** 2 / (all_h - left_h + 1) - all_g**2 / (all_h + 1)
                gain[(left_h < 1e-3) | (all_h - left_h < 1e-3)] = 0
                best = gain.reshape(wide, -1).argmax(axis=1)
                right = np.zeros(len(y), np.int64)
                for k in range(wide):
                    j, b = divmod(int(best[k]), BINS - 1)
                    if gain[k, j, b] > 1e-6 and b < len(cuts[j]):
                        feature[wide - 1 + k], cut[wide - 1 + k] = j, cuts[j][b]
                        own = at == k
                        right[own] = binned[own, j] > b
                at = at * 2 + right
            leaf = SHRINKAGE * np.bincount(at, g, 1 << DEPTH) / (np.bincount(at, h, 1 << DEPTH) + 1)
            z += leaf[at]
            self.feature.append(feature)
            self.cut.append(cut)
            self.leaf.append(leaf)

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            z += leaf[at - (1 << DEPTH) + 1]
        return z


_IN, _OUT = "\x01", "\x02"  # mark main text and the rest in generated pages


def training_page(rng: random.Random) -> str:
    """A page whose main text begins each block with one mark and all other text with another."""

    def words(n: int, end: str = ".") -> str:
        found = ["".join(rng.choice("aeinorstdlum") for _ in range(rng.randint(1, 11))) for _ in range(n)]
        for i in range(rng.randint(6, 12), n, rng.randint(6, 12)):
            found[i] += rng.choice([",", ".", ";", "?"])
        return " ".join(found).capitalize() + end

    def links(n: int, item: str = "li") -> str:
        found = [f'<{item}><a href="/{i}">{_OUT}{words(rng.randint(1, 3), "")}</a></{item}>' for i in range(n)]
        return f"<ul>{''.join(found)}</ul>" if item == "li" else "".join(found)

    def named(tags: list[str], names: list[str], body: str) -> str:
        tag = rng.choice(tags)
        if tag in ("div", "section") or rng.random() < 0.4:
            kind = rng.choice(["class", "class", "id"])
            return f'<{tag} {kind}="{rng.choice(names)}">{body}</{tag}>'
        return f"<{tag}>{body}</{tag}>"

    out = lambda a, b: f"{_OUT}{words(rng.randint(a, b))}"
    nav = lambda: named(["nav", "nav", "div", "ul"], ["nav", "menu", "main-nav", "navbar", "breadcrumb"], links(rng.randint(1, 9)) if rng.random() < 0.8 else links(5, "span"))
    header = lambda: named(["header", "div"], ["header", "masthead", "site-header", "top-banner"], f"<h1>{out(1, 4)}</h1>" * rng.randint(0, 1) + (nav() if rng.random() < 0.5 else f"<p>{out(2, 9)}</p>"))
    advert = lambda: named(["div", "div", "aside", "section"], ["ad", "ads", "advert", "sponsored", "promo box"], f"{out(2, 40)}" if rng.random() < 0.6 else f"<p>{out(3, 30)}</p>" * rng.randint(1, 2))
    notice = lambda: named(["div", "section"], ["cookie-notice", "consent", "gdpr", "alert notice", "popup"], f"<p>{out(5, 40)}</p><button>{words(1)}</button>")
    side = lambda: named(["aside", "div"], ["sidebar", "related", "widget", "right-rail", "recommended"], f"<h3>{out(1, 4)}</h3>" + (links(rng.randint(2, 8)) if rng.random() < 0.6 else f"<p>{out(4, 60)}</p>"))
    form = lambda: rng.choice(['<form class="newsletter">', "<form>", '<form id="search">']) + f"<p>{out(2, 12)}</p><label>{out(1, 3)}</label><input><input type=submit></form>"
    comment = lambda: f'<{(t := rng.choice(["div", "li", "p", "article"]))} class="{rng.choice(["comment", "reply", "comment-body", "c"])}">{out(3, 80)}</{t}>'
    comments = lambda: named(["section", "div", "ol"], ["comments", "discussion", "respond", "comment-list"], f"<h3>{out(1, 3)}</h3>" * rng.randint(0, 1) + "".join(comment() for _ in range(rng.randint(1, 7))))
    footer = lambda: named(["footer", "footer", "div"], ["footer", "site-footer", "copyright"], f"&copy; {out(2, 40)}" if rng.random() < 0.6 else f"<p>{out(3, 50)}</p>" + links(3))
    share = lambda: named(["div", "ul"], ["share", "social", "follow-us"], links(rng.randint(2, 4), "span"))

    def block() -> str:
        kind, text = rng.random(), f"{_IN}{words(rng.choice([rng.randint(1, 6), rng.randint(8, 60), rng.randint(40, 220)]))}"
        if kind < 0.55:
            return f"<p>{text}</p>"
        if kind < 0.68:
            return f"<p><b>{text}<br>"
        if kind < 0.74:
            return f"<h{(k := rng.randint(2, 4))}>{text[:50]}</h{k}>"
        if kind < 0.8:
            return "<ul>" + "".join(f"<li>{_IN}{words(rng.randint(2, 25))}</li>" for _ in range(rng.randint(2, 6))) + "</ul>"
        if kind < 0.84:
            return f"<blockquote><p>{text}</p></blockquote>"
        if kind < 0.88:
            return f"<table><tr><td>{_IN}{words(3)}</td><td>{_IN}{words(2)}</td></tr></table>"
        if kind < 0.92:
            return f"<div>{text}</div>"
        if kind < 0.96:
            return f'<p>{text} <a href="/x">{words(3, "")}</a> {words(9)}</p>'
        return f"<figure><img src=x><figcaption>{_IN}{words(6)}</figcaption></figure>"

    title = f"<h1>{_IN}{words(rng.randint(2, 12))}</h1>" if rng.random() < 0.85 else ""
    if title and rng.random() < 0.2:
        title = f"<header>{title}</header>"
    body = [block() for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 14]))]
    for extra in (advert, share, form, side):
        if rng.random() < 0.12:
            body.insert(rng.randint(0, len(body)), extra())
    main = named(["article", "article", "main", "div"], ["content", "article-body", "post", "entry-content", "story", "main"], title + "".join(body) + (comments() if rng.random() < 0.12 else ""))
    for _ in range(rng.choice([0, 0, 1, 2])):
        main = named(["div", "main", "section"], ["wrapper", "container", "page", "content", "row"], (side() if rng.random() < 0.2 else "") + main + (comments() if rng.random() < 0.15 else ""))
    top = [f() for f, p in ((header, 0.5), (nav, 0.8), (notice, 0.25), (advert, 0.5), (form, 0.15), (side, 0.15)) if rng.random() < p]
    low = [f() for f, p in ((side, 0.35), (comments, 0.4), (form, 0.2), (advert, 0.25), (nav, 0.2), (notice, 0.15), (footer, 0.9)) if rng.random() < p]
    rng.shuffle(top)
    return f"<!DOCTYPE html><html><head><title>{words(5)}</title><style>p{{margin:0}}</style></head><body>{''.join(top)}{main}{''.join(low)}" + ("</body></html>" if rng.random() < 0.9 else "")


def train(pages: int = TRAIN_PAGES, seed: int = 11) -> Trees:
    """Trees that tell nodes whose text is mostly main text from the others."""
    rng = random.Random(seed)
    x, y = [], []
    for _ in range(pages):
        page = Page(training_page(rng))
        main, other = np.zeros(len(page.tag)), np.zeros(len(page.tag))
        inside = False
        for node, text in page.flow:
            if text:
                if _IN in text or _OUT in text:
                    inside = text.rfind(_IN) > text.rfind(_OUT)
                (main if inside else other)[node] += len(text.strip())
        for k in range(len(page.tag) - 1, 0, -1):
            main[page.parent[k]] += main[k]
            other[page.parent[k]] += other[k]
        some = main + other > 0
        x.append(page.features()[some])
        # a node that holds both is outside: its inner nodes tell them apart
        y.append((main > 9 * other)[some])
    return Trees(np.concatenate(x), np.concatenate(y).astype(float))


def extract(pages: DataFrame, source: str = "html", keep: list[str] | None = None, model: Trees | None = None) -> DataFrame:
    """``row`` (the columns to keep) and ``found`` (text, n_chars)."""
    held = pages.sparkSession.sparkContext.broadcast(model or train())
    given = pages.select(whole_row(pages, keep).alias("row"), F.col(source).cast("string").alias("html"))
    schema = given.select("row", F.lit(None).cast("struct<text:string,n_chars:bigint>").alias("found")).schema

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, lambda x: x.column("html"), 128):
            parsed = [Page(x) if x else None for x in batch.column("html").to_pylist()]
            own = [p.features() for p in parsed if p]
            logits = held.value.logits(np.concatenate(own)) if own else None
            texts, at = [], 0
            for p in parsed:
                if p is None:
                    texts.append("")
                    continue
                n = len(p.tag)
                # text without any block around it has nothing to be told apart from
                keep = p.decode(logits[at : at + n]) if n > 1 else np.ones(1, bool)
                texts.append(p.text(keep))
                at += n
            text = pa.array(texts, pa.string())
            found = pa.StructArray.from_arrays([text, pc.utf8_length(text).cast(pa.int64())], names=["text", "n_chars"])
            yield pa.RecordBatch.from_arrays([batch.column("row"), found], names=["row", "found"])

    return given.mapInArrow(task, schema)
