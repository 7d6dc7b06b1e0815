"""Main text of web pages by a tree-structured graphical model over the DOM.

A page is read into a tree of block elements whose leaves are runs of text. Each node is content or
not: an element if it holds content text, a leaf if it is such text. A node's potential is a linear
function of its features (class and id words, rare ones as one unknown word; for elements that make a zone also the tag, the length
of their text, the share of links, of the page's text and of sentences, and whether they lie in an article), and each
kind of parent-child edge has a table of potentials. Sum-product messages go up and down the tree
(all pages of a batch at once, level by level) and give every leaf's exact marginal; leaves at a
half or more are the text. Weights are fitted on labelled pages by the exact gradient of the
likelihood, which takes the same messages. ``labelled_pages`` composes these pages from layouts in
which every part is marked as content or not. Two models are fitted: one on common names and tags, and one on
layouts whose names and tags do not tell the article, which looks at the shape of the text instead; a page in
which no zone's names or tag speak for content goes to the second. They are kept for the driver's next calls.

Defined cases: a null or empty page has no text; whitespace in a block becomes one blank; ``<br>``
is whitespace; tags that are never closed, closed twice or cut off are read as browsers do; what
scripts, styles, templates, heads, buttons and selections hold is never text; pages of any length
and depth are read whole; repeated pages are read alike; an empty table gives an empty result. Only
page_id, url and html are read, so other columns may have any name.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ready

# Element names of the HTML standard.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul "
    "button noscript template select svg object audio video canvas".split()
)
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
HIDDEN = frozenset("head button noscript template select svg object audio video canvas".split())
VOID = frozenset("hr".split())
HEAD_PARTS = frozenset("base link meta noscript template script style title basefont bgsound".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An opening tag ends an open element of these names on top of the stack.
ENDS = {"li": {"li", "p"}, "dd": {"dd", "dt", "p"}, "dt": {"dd", "dt", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}

MARKUP = re.compile(r"<(?:!--|[!?/]|[a-zA-Z])")
QUOTES_OR_END = re.compile(r"""[>"']""")
NAME_END = re.compile(r"[\s/>]")
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
KEPT = re.compile(r"""\bdata-kept\s*=""", re.I)
WORD = re.compile(r"[a-z]+")
#: Elements that carry a zone's text rather than make a zone, unless a class or id names them.
TEXT_LEVEL = frozenset("address blockquote caption dd dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup li ol p pre table tbody td tfoot th thead tr ul".split())
CELLS = frozenset("td th".split())
SENTENCE_ENDS = frozenset(". ! ? … 。 ！ ？ ؟ ।".split())
#: A class or id word that fewer training pages hold counts as unknown.
KNOWN_PAGES = 4
UNKNOWN = "unknown names"
#: Tags that say what a zone is for. Zones that neither such a tag nor a known word tells are judged by the shape of their text too.
TOLD = frozenset("tag=" + t for t in "article main nav aside header footer dialog form".split())
#: Kinds of edges, by the child: an element that makes a zone, one that carries text, a leaf.
ZONE, CARRIER, LEAF = 0, 1, 2
#: Depth of a page's tree below which one numpy step handles a level of all pages.
PAGES_AT_ONCE = 256


class Markup:
    """The tags of a text, each found in time that sums to the text's length (and its logarithm) over all of them."""

    def __init__(self, html: str) -> None:
        self.html, self.marks = html, [m.start() for m in QUOTES_OR_END.finditer(html)]
        self.after: dict[int, int] = {}  # of a quote: the > that ends a tag around it, the text's length, or -1 if it never closes
        self.stop = -1  # the last name's end

    def close(self, at: int) -> int:
        """The first > from ``at`` on outside quotes; the text's length if nothing follows; -1 if a quote stays open."""
        html, passed = self.html, []
        while True:
            i = bisect_left(self.marks, at)
            if i == len(self.marks):
                found = len(html)
                break
            mark = self.marks[i]
            if html[mark] == ">":
                found = mark
                break
            if mark in self.after:
                found = self.after[mark]
                break
            passed.append(mark)
            other = html.find(html[mark], mark + 1)
            if other < 0:
                found = -1
                break
            at = other + 1
        self.after.update((mark, found) for mark in passed)
        return found

    def next(self, at: int) -> tuple[int, int, bool, str | None, str] | None:
        """(start, end, whether it closes, name, attributes) of the first tag or comment (no name) from ``at`` on."""
        html, n = self.html, len(self.html)
        while m := MARKUP.search(html, at):
            start, at = m.start(), m.start() + 1
            if m.group() == "<!--":
                end = html.find("-->", start + 4)
                return start, n if end < 0 else end + 3, False, None, ""
            closing = html.startswith("/", at)
            name_at = at + closing
            if html[name_at : name_at + 1].isascii() and html[name_at : name_at + 1].isalpha():
                if self.stop < name_at:
                    m = NAME_END.search(html, name_at)
                    self.stop = m.start() if m else n
                end = self.close(self.stop)
                if end >= 0:
                    return start, min(end + 1, n), closing, html[name_at : self.stop], html[self.stop : end]
            if html[start + 1] in "!?/":
                end = html.find(">", start + 2)
                return start, n if end < 0 else end + 1, False, None, ""
        return None


class Page:
    """A page's nodes in page order: parent, kind, features; texts and marks of the leaves."""

    def __init__(self, html: str) -> None:
        self.parent, self.kind, self.depth, self.features, self.texts, self.hidden, self.marks = [-1], [ZONE], [0], [["tag=root"]], [None], [False], [False]
        self.names = ["root"]
        self.linked: dict[int, int] = {}
        self.read(html)
        self.describe()

    def describe(self) -> None:
        """Features that need the finished tree: what a zone holds and what it lies in."""
        n = len(self.parent)
        size, links, prose, blocks = [0] * n, [0] * n, [0] * n, [0] * n
        for i in range(n - 1, 0, -1):
            up = self.parent[i]
            if self.kind[i] == LEAF and not self.hidden[i]:
                size[i], links[i] = len(self.texts[i]), self.linked.get(i, 0)
                prose[i] = size[i] if ends_sentence(self.texts[i]) and 2 * links[i] < size[i] else 0
            elif self.kind[i] != LEAF:
                blocks[up] += 1
            size[up] += size[i]
            links[up] += links[i]
            prose[up] += prose[i]
        for i in range(1, n):
            if self.kind[i] == CARRIER and self.names[i] in CELLS and blocks[i]:  # a cell that holds blocks lays a page out
                self.kind[i] = ZONE
                self.features[i] += [f"tag={self.names[i]}", "bare"]
        inside = ["no"] * n
        for i in range(1, n):
            up = self.parent[i]
            inside[i] = self.names[up] if self.names[up] in ("article", "main") else inside[up]
            if self.kind[i] == ZONE:
                self.features[i] += [f"size={size_class(size[i])}", f"links={link_class(size[i], links[i])}", f"{self.names[i]} within={inside[i]}"]
                of_page, of_zone = share_class(size[i], size[0]), share_class(prose[i], size[i])
                self.features[i] += [f"shape: page share={of_page}", f"shape: prose={of_zone}", f"shape: page share={of_page} prose={of_zone}"]
            elif self.kind[i] == LEAF:
                self.features[i] += ["leaf in links"] if link_class(size[i], links[i]) == "all" else []

    def add(self, parent: int, kind: int, features: list[str], text: str | None, hidden: bool, mark: bool, name: str = "") -> int:
        self.parent.append(parent)
        self.kind.append(kind)
        self.depth.append(self.depth[parent] + 1)
        self.features.append(features)
        self.names.append(name)
        self.texts.append(text)
        self.hidden.append(hidden)
        self.marks.append(mark)
        return len(self.parent) - 1

    def read(self, html: str) -> None:
        names, nodes, open_ = ["root"], [0], Counter({"root": 1})
        pieces: list[str] = []  # raw text of the running block
        link_chars, links = 0, []  # characters of it in links; stack heights at which links are open
        at, end, lower = 0, len(html), None

        def flush() -> None:
            nonlocal link_chars
            if pieces:
                text = " ".join(unescape("".join(pieces)).split())
                if text:
                    top = nodes[-1]
                    self.add(top, LEAF, [], text, self.hidden[top], self.marks[top])
                    self.linked[len(self.parent) - 1] = min(link_chars, len(text))
                pieces.clear()
            link_chars = 0

        def pop() -> None:
            open_[names.pop()] -= 1
            nodes.pop()
            while links and links[-1] > len(names):
                links.pop()

        def put(raw: str) -> None:
            nonlocal link_chars
            pieces.append(raw)
            if links:
                link_chars += len(raw)

        markup = Markup(html)
        while tag := markup.next(at):
            s, after, closing, name, attributes = tag
            if s > at:
                put(html[at:s])
            at = after
            if name is None:
                continue
            name = name.lower()
            if closing:
                if name == "a":
                    if links:
                        links.pop()
                elif name in BLOCKS and open_[name]:
                    if name == "p" and names[-1] != "p":
                        continue
                    flush()
                    while names[-1] != name:
                        pop()
                    pop()
                continue
            if name == "br":
                put(" ")
                continue
            if name in RAW:
                lower = html.lower() if lower is None else lower
                close = lower.find("</" + name, at)
                at = end if close < 0 else close
                if name in ("textarea", "iframe"):
                    put(" ")
                continue
            if name == "a":
                links.append(len(names))
                continue
            if name not in BLOCKS:
                continue
            flush()
            if open_["head"] and name not in HEAD_PARTS and name != "head":
                while names[-1] != "head":
                    pop()
                pop()
            if names[-1] == "p" or (names[-1] in HEADINGS and name in HEADINGS):
                pop()
            while names[-1] in ENDS.get(name, ()):
                pop()
            if name in VOID or (name in ("html", "body") and open_[name]):
                continue
            top = nodes[-1]
            words = {w for v in NAMES.findall(attributes) for w in WORD.findall(v.lower())} if attributes else ()
            features = [f"name={w}" for w in sorted(words)] + ([] if name in TEXT_LEVEL else [f"tag={name}"] + ([] if words else ["bare"]))
            node = self.add(top, CARRIER if name in TEXT_LEVEL and not words else ZONE, features, None, self.hidden[top] or name in HIDDEN, self.marks[top], name)
            if attributes and KEPT.search(attributes):
                self.marks[node] = 'data-kept="1"' in attributes
            if attributes.endswith("/") and name == "svg":
                continue
            names.append(name)
            nodes.append(node)
            open_[name] += 1
        if at < end:
            put(html[at:])
        flush()

    def labels(self) -> np.ndarray:
        """1 for leaves marked as content and the elements around them."""
        y = np.array([k == LEAF and m and not h for k, m, h in zip(self.kind, self.marks, self.hidden, strict=True)], np.int64)
        for i in range(len(y) - 1, 0, -1):
            if y[i]:
                y[self.parent[i]] = 1
        return y


def size_class(n: int) -> str:
    return "none" if n == 0 else "line" if n < 80 else "some" if n < 400 else "long"


def share_class(part: int, whole: int) -> str:
    share = part / whole if whole else 0.0
    return "none" if share == 0 else "little" if share < 0.1 else "some" if share < 0.35 else "half" if share < 0.7 else "most"


def ends_sentence(text: str) -> bool:
    return text.rstrip("\"'»”’)]")[-1:] in SENTENCE_ENDS


def link_class(n: int, in_links: int) -> str:
    share = in_links / n if n else 0.0
    return "all" if share > 0.8 else "half" if share > 0.4 else "few" if share > 0 else "no"


class Forest:
    """The trees of many pages as flat arrays, levels from the roots down."""

    def __init__(self, pages: list[Page], columns: dict[str, int]) -> None:
        sizes = [len(p.parent) for p in pages]
        self.first = np.cumsum([0, *sizes])
        self.parent = np.concatenate([np.array(p.parent) + s for p, s in zip(pages, self.first, strict=False)])
        self.kind = np.concatenate([np.array(p.kind) for p in pages])
        depth = np.concatenate([np.array(p.depth) for p in pages])
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
        owner, column = [], []
        node = 0
        for p in pages:
            for f in p.features:
                known = [x for x in f if x in columns]
                if any(x.startswith("name=") or x in TOLD for x in known):  # names or tag say what the zone is
                    known = [x for x in known if not x.startswith("shape:")]
                elif UNKNOWN in columns and any(x.startswith("name=") for x in f):
                    known.append(UNKNOWN)
                for x in known:
                    owner.append(node)
                    column.append(columns[x])
                node += 1
        self.owner, self.column = np.array(owner, np.int64), np.array(column, np.int64)

    def unary(self, weights: np.ndarray) -> np.ndarray:
        """(nodes, 2) log potentials."""
        total = np.bincount(self.owner, weights[self.column], len(self.parent))
        return np.stack([np.zeros(len(total)), total], axis=1)

    def marginals(self, weights: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Node marginals of content, edge marginals (node with its parent: 2 x 2), log partition sum."""
        u = self.unary(weights)
        up = np.zeros_like(u)  # sum of messages from children
        sent = np.zeros_like(u)  # message to the parent
        for level in self.levels[:0:-1]:
            m = edges[self.kind[level]] + (u[level] + up[level])[:, None, :]  # (node, parent's state, own state)
            sent[level] = np.logaddexp(m[:, :, 0], m[:, :, 1])
            np.add.at(up, self.parent[level], sent[level])
        roots = self.levels[0]
        belief = u + up
        z = float(np.logaddexp(belief[roots, 0], belief[roots, 1]).sum())
        pair = np.zeros((len(u), 2, 2))
        for level in self.levels[1:]:
            outside = belief[self.parent[level]] - sent[level]  # the parent's belief without this child
            joint = outside[:, :, None] + edges[self.kind[level]] + (u[level] + up[level])[:, None, :]
            joint -= joint.max((1, 2), keepdims=True)
            joint = np.exp(joint)
            joint /= joint.sum((1, 2), keepdims=True)
            pair[level] = joint
            down = np.logaddexp(*np.moveaxis(outside[:, :, None] + edges[self.kind[level]], 1, 0))
            belief[level] += down
        odds = belief[:, 1] - belief[:, 0]
        return 1 / (1 + np.exp(-np.clip(odds, -60, 60))), pair, z


class Model:
    """Feature weights and edge tables."""

    def __init__(self, columns: dict[str, int], weights: np.ndarray, edges: np.ndarray) -> None:
        self.columns, self.weights, self.edges = columns, weights, edges

    @staticmethod
    def fit(htmls: list[str], steps: int = 450, decay: float = 0.0001, shapes: bool = False) -> Model:
        """With ``shapes`` zones that neither names nor tags tell have features of their text's shape."""
        pages = [Page(h) for h in htmls]
        held = Counter(x for p in pages for x in {x for f in p.features for x in f})
        if shapes:
            kept = {x for x, n in held.items() if n >= KNOWN_PAGES or not x.startswith("name=")} | {UNKNOWN}
        else:
            kept = {x for x in held if not x.startswith("shape:")}
        columns = {f: i for i, f in enumerate(sorted(kept))}
        forest = Forest(pages, columns)
        y = np.concatenate([p.labels() for p in pages])
        weights, edges = np.zeros(len(columns)), np.zeros((3, 2, 2))
        child = np.concatenate(forest.levels[1:])
        seen = np.zeros_like(edges)
        np.add.at(seen, (forest.kind[child], y[forest.parent[child]], y[child]), 1)
        true = np.bincount(forest.column, y[forest.owner], len(columns))
        moments = [np.zeros(weights.size + edges.size), np.zeros(weights.size + edges.size)]
        for step in range(1, steps + 1):
            p, pair, _ = forest.marginals(weights, edges)
            expected = np.bincount(forest.column, p[forest.owner], len(columns))
            paired = np.zeros_like(edges)
            np.add.at(paired, forest.kind[child], pair[child])
            edge_g = seen - paired - decay * edges * len(pages)
            # Carriers and leaves only agree with their parent or not: their number must not speak for either state.
            edge_g[CARRIER:] = (edge_g[CARRIER:] + edge_g[CARRIER:, ::-1, ::-1]) / 2
            g = np.concatenate([true - expected - decay * weights * len(pages), edge_g.ravel()])
            m, s = moments
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            move = 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
            weights, edges = weights + move[: weights.size], edges + move[weights.size :].reshape(edges.shape)
        return Model(columns, weights, edges)

    def texts(self, htmls: list[str]) -> list[str]:
        """The main text of each page."""
        return self.texts_of([Page(h) for h in htmls])

    def named(self, page: Page) -> bool:
        """Whether the names or tag of some zone speak for content."""
        for kind, f in zip(page.kind, page.features, strict=True):
            known = [x for x in f if x in self.columns] if kind == ZONE else []
            if any(x.startswith("name=") or x in TOLD for x in known) and sum(self.weights[self.columns[x]] for x in known) > 0:
                return True
        return False

    def texts_of(self, pages: list[Page]) -> list[str]:
        if not pages:
            return []
        forest = Forest(pages, self.columns)
        p, _, _ = forest.marginals(self.weights, self.edges)
        out = []
        for page, at in zip(pages, forest.first, strict=False):
            keep = p[at : at + len(page.parent)] >= 0.5
            out.append("\n".join(t for t, k, h in zip(page.texts, keep, page.hidden, strict=True) if t is not None and k and not h))
        return out


class Layouts:
    """Two models: ``named`` for pages in which names or tags speak for content, ``shaped`` for all others."""

    def __init__(self, named: Model, shaped: Model) -> None:
        self.named, self.shaped = named, shaped

    @staticmethod
    def fit(named: int = 600, shaped: int = 500, steps: tuple[int, int] = (450, 300)) -> Layouts:
        return Layouts(Model.fit(labelled_pages(named), steps[0]), Model.fit(labelled_pages(shaped, styles="opaque plain table half"), steps[1], shapes=True))

    def texts(self, htmls: list[str]) -> list[str]:
        """The main text of each page."""
        pages = [Page(h) for h in htmls]
        told = [self.named.named(p) for p in pages]
        found = {t: iter(m.texts_of([p for p, x in zip(pages, told, strict=True) if x is t])) for t, m in ((True, self.named), (False, self.shaped))}
        return [next(found[t]) for t in told]


# Words that class names use for parts of pages.
PARTS = {
    "content": "content article post entry story main body text page prose markdown",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs links",
    "header": "header masthead topbar site logo branding hero top",
    "footer": "footer foot bottom copyright legal colophon credits",
    "side": "sidebar side rail widget related recommended popular trending more secondary",
    "ad": "ad ads advert advertisement sponsor sponsored promo promotion banner adsense partner",
    "notice": "cookie cookies consent notice alert gdpr privacy popup modal newsletter subscribe overlay warning message",
    "form": "form login signup search contact feedback register",
    "comments": "comments comment replies reply discussion disqus respond responses",
    "share": "share social sharing follow tools toolbar tags meta",
}
_SYLLABLES = "ka lo mi ter on su ve ra del ni pa cho ing est or".split()


#: Elements whose tag tells what they are for; plain layouts have others in their places.
TELLING = re.compile(r"(</?)(?:article|main|section|nav|aside|header|footer|dialog)\b")
GIVEN_NAMES = re.compile(r"""\s(?:class|id)="([^"]*)\"""")


def disguised(html: str, rng: random.Random, how: str) -> str:
    """The page without telling tags, its class and id words replaced by made-up ones (opaque) or left out (plain)."""
    made: dict[str, str] = {}

    def renamed(m: re.Match) -> str:
        if how == "plain":
            return ""
        return ' class="' + " ".join(made.setdefault(w, "x" + "".join(rng.choices("bcdfghjkmpqrtvwz", k=5))) for w in WORD.findall(m.group(1))) + '"'

    return GIVEN_NAMES.sub(renamed, TELLING.sub(r"\1div", html))


def labelled_pages(n: int = 600, seed: int = 5, styles: str = "named") -> list[str]:
    """Pages of varied layouts; ``data-kept="1"`` marks content, ``data-kept="0"`` the rest.

    Each page has one of ``styles``: named (common class names and tags), opaque and plain (see :func:`disguised`), table
    (plain, its parts in the cells of a layout table) or half (the article alone is opaque).
    """
    rng, style_rng = random.Random(seed), random.Random(seed + 1)

    def words(lo: int, hi: int) -> str:
        return " ".join("".join(rng.choices(_SYLLABLES, k=rng.randint(1, 4))) for _ in range(rng.randint(lo, hi)))

    def sentence() -> str:
        said = words(1, rng.choice((3, 15, 45, 120))).capitalize() + rng.choice((".", ".", "!", "?", "", "", " |"))
        return said if rng.random() < 0.9 else rng.choice(("Copyright ", "All rights reserved. ", "© ")) + said

    def name(part: str) -> str:
        picked = rng.sample(PARTS[part].split(), rng.choice((1, 1, 2)))
        return rng.choice(("class", "class", "id")) + '="' + rng.choice(("-", " ", "_")).join(picked) + '"'

    def links(lo: int, hi: int) -> str:
        return "".join(f'<li><a href="/{i}">{words(1, 3)}</a></li>' for i in range(rng.randint(lo, hi)))

    def block() -> str:
        kind = rng.random()
        if kind < 0.62:
            return f"<p>{sentence()} {rng.choice(('', sentence(), f'<a href=x>{words(1, 3)}</a> {sentence()}'))}" + rng.choice(("</p>", "</p>", "", "<br>"))
        if kind < 0.72:
            return f"<h{(k := rng.randint(2, 4))}>{words(1, 6)}</h{k}>"
        if kind < 0.80:
            return "<ul>" + "".join(f"<li>{sentence()}</li>" for _ in range(rng.randint(2, 5))) + "</ul>"
        if kind < 0.86:
            return f"<blockquote><p>{sentence()}</p></blockquote>"
        if kind < 0.91:
            return "<table>" + "".join(f"<tr><td>{words(1, 3)}</td><td>{words(1, 3)}</td></tr>" for _ in range(3)) + "</table>"
        if kind < 0.95:
            return f"<pre>{words(3, 20)}</pre>"
        return f"<figure><img src=x><figcaption>{words(2, 8)}</figcaption></figure>" if kind < 0.98 else f"<div>{sentence()}</div>"

    def other(part: str) -> str:
        text = rng.choice((sentence(), sentence(), f"<p>{sentence()}</p><p>{sentence()}</p>", f"<h3>{words(1, 3)}</h3><p>{sentence()}</p>"))
        inner = {
            "menu": f"<ul>{links(2, 9)}</ul>", "side": rng.choice((f"<h3>{words(1, 3)}</h3><ul>{links(2, 6)}</ul>", text)),
            "header": rng.choice((f"<a href=/>{words(1, 3)}</a>", f"<h1>{words(1, 3)}</h1><p>{words(2, 6)}</p>", f"<h1>{words(1, 3)}</h1>", f"<ul>{links(2, 5)}</ul>")),
            "footer": rng.choice((f"&copy; {words(1, 4)} &middot; {sentence()}", f"<p>© {words(1, 5)}</p><ul>{links(1, 4)}</ul>", text)),
            "form": f"<label>{words(1, 3)}</label><input name=q><button>{words(1, 2)}</button>" + rng.choice(("", f"<p>{sentence()}</p>")),
            "comments": f"<h3>{words(1, 2)}</h3>" + "".join(f"<{t}><b>{words(1, 2)}</b><p>{sentence()}</p></{t}>" for t in [rng.choice(("div", "div", "li", "li", "section", "article"))] * rng.randint(1, 5)),
            "share": f"<ul>{links(1, 4)}</ul>" if rng.random() < 0.5 else words(1, 5),
        }.get(part, text)
        own = {"menu": "nav", "side": "aside", "header": "header", "footer": "footer", "form": "form", "notice": "dialog"}.get(part)
        if own and rng.random() < 0.55:
            return f'<{own} data-kept="0"{rng.choice(("", " " + name(part)))}>{inner}</{own}>'
        tag = rng.choice(("div", "div", "section", "p" if part in ("ad", "notice") and "<" not in inner else "div"))
        return f'<{tag} data-kept="0" {name(part)}>{inner}</{tag}>'

    def page() -> str:
        body = "".join(block() for _ in range(rng.choice((1, 2, 3, 5, 9, 14))))
        if rng.random() < 0.35:  # parts that interrupt the article
            body += other(rng.choice(("ad", "share", "side", "form"))) + "".join(block() for _ in range(rng.randint(0, 3)))
        title = f"<h1>{words(1, 9)}</h1>"
        shell = rng.choice(("article", "article", "article", "main", "div", "div", "div", "section"))
        if shell in ("article", "main") and rng.random() < 0.4:
            title = f"<header>{title}</header>"
        article = f'<{shell} data-kept="1"{"" if shell in ("article", "main") and rng.random() < 0.7 else " " + name("content")}>{title}{body}'
        if rng.random() < 0.3:
            article += other("comments")
        article += f"</{shell}>"
        if rng.random() < 0.3:
            article = rng.choice(("<main>{}</main>", '<div class="container">{}</div>', '<div id="page"><div>{}</div></div>')).format(article)
        before = "".join(other(p) for p in ("header", "menu", "ad", "notice", "form") if rng.random() < (0.8 if p == "menu" else 0.5))
        after = "".join(other(p) for p in ("side", "comments", "share", "ad", "form", "notice", "footer") if rng.random() < (0.85 if p == "footer" else 0.25))
        if rng.random() < 0.15:
            before += other("side")
        style = style_rng.choice(styles.split())
        if style == "half":
            article = disguised(article, style_rng, "opaque")
        if style == "table":
            cells = [c for c in (before, article, after) if c]
            between = rng.choice(("</td><td>", "</td></tr><tr><td>"))
            whole = f"<table><tr><td>{between.join(cells)}</td></tr></table>"
        else:
            whole = before + article + after
        if style in ("opaque", "plain", "table"):
            whole = disguised(whole, style_rng, "opaque" if style == "opaque" else "plain")
        return f"<html><head><title>{words(1, 5)}</title><script>var a='<p>';</script></head><body>{whole}</body></html>"

    return [page() for _ in range(n)]


@cache
def fitted() -> Layouts:
    """The models that :func:`extract` uses unless it is given one."""
    return Layouts.fit()


def extract(pages: DataFrame, model: Model | Layouts | None = None) -> DataFrame:
    """page_id, url, text (empty if none)."""
    spark = ready(pages.sparkSession)
    given = spark.sparkContext.broadcast(model or fitted())
    shape = T.StructType([pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html = batch.column(2)
            for at in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = [h or "" for h in html.slice(at, PAGES_AT_ONCE).to_pylist()]
                text = pa.array(given.value.texts(part), pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), batch.column(1).slice(at, len(part)), text], names=shape.names)

    return pages.select("page_id", "url", F.col("html")).mapInArrow(run, shape)
