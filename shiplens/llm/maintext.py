"""Main text of web pages by a tree-structured graphical model.

A page is parsed to its element tree. Each element is in one of three states: it surrounds the main
text, it is main text, or it stands beside it (menus, notices, comments and so on). A table of parent
and child states, and what an element looks like in each state (its tag, the words of its class, id
and role, its share of link text, its length and punctuation), are counted on labelled pages. Text that
stands between the blocks of an element, or in the body or in no element at all, is a leaf of its own,
so it can be main text where what is around it is not. Messages
are summed from the leaves up and from the root down, which gives each element's exact probability of
being main text. The texts of elements above one half are the page's main text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.llm.common import slices

#: Element kinds of the language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr br img input".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hr main menu nav ol p pre section table ul".split()
)
#: A start tag ends an open element of these, unless one of the second set stands between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

#: What stands in these is never taken for one piece with the blocks beside it.
PAGE_TAGS = frozenset(("#page", "html", "body"))

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*(?:>|\Z)""",
    re.S,
)
_MARKS = re.compile(r"""\b(class|id|role|data-main|data-text)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_STOPS = re.compile(r"[.!?;:,]")

#: States: around the main text, main text, beside it.
AROUND, MAIN, BESIDE = range(3)
SMOOTH = 0.3
#: Pseudo-count of each step from a parent's state to a child's.
RARE = 0.05
#: Length, share, links and punctuation say much the same, so each counts for less.
TEXT_WEIGHT = 0.5
#: A single element's evidence is bounded, in log-odds.
MOST_EVIDENCE = 8.0


@dataclass
class Page:
    """The modelled elements in page order (parents first) and the pieces of text."""

    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    words: list[tuple[str, ...]] = field(default_factory=list)
    labels: list[int | None] = field(default_factory=list)
    chunks: list[tuple[int, int, str, bool]] = field(default_factory=list)  # block, element, text, in a link
    bare: dict[int, int] = field(default_factory=dict)  # labels of the text that stands in an element itself


def parse(html: str) -> Page:
    """The tree of a page. Inline elements without class, id and role belong to the element around."""
    page = Page(["#page"], [-1], [()], [None])
    # Open elements: name, modelled element, link. The name is counted to find end tags without a start.
    stack: list[tuple[str, int, bool]] = [("#page", 0, False)]
    open_names: Counter[str] = Counter()
    block = at = 0

    def pop() -> None:
        nonlocal block
        name, _, _ = stack.pop()
        open_names[name] -= 1
        if name not in INLINE:
            block += 1

    def add_text(text: str) -> None:
        if text:
            _, element, link = stack[-1]
            page.chunks.append((block, element, text, link))

    n = len(html)
    while at < n:
        m = _TAG.search(html, at)
        if m is None:
            add_text(html[at:])
            break
        add_text(html[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:
            if open_names[name] > 0:
                while stack[-1][0] != name:
                    pop()
                pop()
            elif name not in INLINE:
                block += 1
            continue
        if name in RAW:
            end = re.compile(rf"</{name}[^>]*>", re.I).search(html, at)
            at = end.end() if end else n
            continue
        if name in CLOSES_P and open_names["p"] > 0:
            while stack[-1][0] != "p":
                pop()
            pop()
        if name in ENDS:
            ended, bounds = ENDS[name]
            if any(open_names[x] > 0 for x in ended):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in bounds:
                        break
                    if stack[k][0] in ended:
                        while len(stack) > k:
                            pop()
                        break
        if name == "br":
            add_text(" ")
        if name not in INLINE:
            block += 1
        if name in VOID:
            continue
        above = stack[-1]
        given = m[3] or m[6] or ""
        words, label, bare = (), None, None
        if "=" in given:
            found = []
            for key, *values in _MARKS.findall(given):
                value = values[0] or values[1] or values[2]
                if key.lower() == "data-main":
                    label = int(value == "1")
                elif key.lower() == "data-text":
                    bare = int(value == "1")
                else:
                    found += [w.lower() for w in _WORDS.findall(unescape(value))]
            words = tuple(dict.fromkeys(found))
        element = above[1]
        if name not in INLINE or words or label is not None:
            element = len(page.tags)
            page.tags.append(name)
            page.parents.append(above[1])
            page.words.append(words)
            page.labels.append(label)
            if bare is not None:
                page.bare[element] = bare
        if not given.endswith("/") or name not in INLINE:
            stack.append((name, element, above[2] or name == "a"))
            open_names[name] += 1
    _add_leaves(page)
    return page


def _add_leaves(page: Page) -> None:
    """A leaf for each run of text among the blocks of an element, or directly in the page."""
    mixed = {page.parents[v] for v in range(1, len(page.tags)) if page.tags[v] not in INLINE}
    mixed |= {v for v, tag in enumerate(page.tags) if tag in PAGE_TAGS}
    last = leaf = None
    for k, (block, element, text, link) in enumerate(page.chunks):
        if element not in mixed or not text.strip() and (block, element) != last:
            continue
        if (block, element) != last:
            last, leaf = (block, element), len(page.tags)
            page.tags.append("#text")
            page.parents.append(element)
            page.words.append(())
            page.labels.append(page.bare.get(element))
        page.chunks[k] = (block, leaf, text, link)


def features(page: Page) -> list[list[str]]:
    """What each element looks like, over all text below it."""
    n = len(page.tags)
    size, link, stops = [0] * n, [0] * n, [0] * n
    for _, element, text, in_link in page.chunks:
        text = text.strip()
        size[element] += len(text)
        stops[element] += len(_STOPS.findall(text))
        if in_link:
            link[element] += len(text)
    for v in range(n - 1, 0, -1):
        p = page.parents[v]
        size[p] += size[v]
        link[p] += link[v]
        stops[p] += stops[v]
    out = []
    for v in range(n):
        s = size[v]
        mine = ["t:" + page.tags[v]]
        mine += ["w:" + w for w in page.words[v]]
        if s:
            mine.append(f"l:{min(3, 4 * link[v] // s)}")
            mine.append(f"n:{min(5, int(math.log(s, 4)))}")
            mine.append(f"s:{min(3, 100 * stops[v] // s)}")
            if page.tags[v] != "#text":
                mine.append(f"p:{4 * s // size[0]}")  # its share of the page
            if page.tags[v] == "#text" and s == size[0]:
                mine.append("a:all")  # the page has no other text
        out.append(mine)
    return out


def _normal(x: list[float]) -> list[float]:
    total = x[0] + x[1] + x[2]
    return [x[0] / total, x[1] / total, x[2] / total]


@dataclass
class TreeModel:
    given: list[list[float]]  # P(child state | parent state)
    weight: dict[str, tuple[float, float, float]]  # log P(feature | state), up to a constant

    def _look(self, mine: list[str]) -> list[float]:
        """Likelihoods of what an element looks like, the largest 1."""
        a = b = c = 0.0
        get = self.weight.get
        for f in mine:
            w = get(f)
            if w is not None:
                a += w[0]
                b += w[1]
                c += w[2]
        top = max(a, b, c)
        return [math.exp(max(x - top, -MOST_EVIDENCE)) for x in (a, b, c)]

    def marginals(self, page: Page) -> list[float]:
        """Probability of main text of each element, by messages up and down the tree."""
        up = [self._look(mine) for mine in features(page)]
        n = len(up)
        parents = page.parents
        g = self.given
        sent: list[list[float]] = [[1.0] * 3] * n
        for v in range(n - 1, 0, -1):
            x, y, z = up[v] = _normal(up[v])
            m = sent[v] = [r[0] * x + r[1] * y + r[2] * z for r in g]
            above = up[parents[v]]
            above[0] *= m[0]
            above[1] *= m[1]
            above[2] *= m[2]
            if above[0] + above[1] + above[2] < 1e-100:
                up[parents[v]] = _normal(above)
        belief = [[1.0, 0.0, 0.0]] * n  # the page itself is around its main text
        for v in range(1, n):
            b, m, u = belief[parents[v]], sent[v], up[v]
            # The parent's belief without what this child has told it.
            q0, q1, q2 = b[0] / m[0], b[1] / m[1], b[2] / m[2]
            belief[v] = _normal([(q0 * g[0][k] + q1 * g[1][k] + q2 * g[2][k]) * u[k] for k in range(3)])
        return [b[MAIN] for b in belief]

    def main_text(self, html: str) -> str:
        """Blocks of main text in page order, white space collapsed, joined by two line ends."""
        page = parse(html)
        if not page.chunks:
            return ""
        inside = self.marginals(page)
        blocks: list[list[str]] = []
        last = None
        for block, element, text, _ in page.chunks:
            if inside[element] > 0.5:
                if block != last:
                    blocks.append([])
                    last = block
                blocks[-1].append(text)
        texts = (" ".join(unescape("".join(b)).split()) for b in blocks)
        return "\n\n".join(t for t in texts if t)


def _states(page: Page) -> list[int]:
    """The states of a labelled page's elements: what has no mark, but main text within, is around it."""
    n = len(page.tags)
    state = [BESIDE] * n
    for v in range(1, n):
        label = page.labels[v]
        state[v] = state[page.parents[v]] if label is None else MAIN if label else BESIDE
    for v in range(n - 1, 0, -1):
        p = page.parents[v]
        if state[v] != BESIDE and state[p] == BESIDE:
            state[p] = AROUND
    return state


def train(pages: Iterable[str], smooth: float = SMOOTH) -> TreeModel:
    """Counts over labelled pages (``data-main``), smoothed."""
    steps = [[RARE] * 3 for _ in range(3)]
    seen = [Counter(), Counter(), Counter()]
    total = [0, 0, 0]
    for html in pages:
        page = parse(html)
        states = _states(page)
        for v, mine in enumerate(features(page)):
            total[states[v]] += 1
            seen[states[v]].update(mine)
            if v:
                steps[states[page.parents[v]]][states[v]] += 1
    weight = {}
    for f in set().union(*seen):
        scale = TEXT_WEIGHT if f[:2] in ("l:", "n:", "s:", "p:") else 1.0
        weight[f] = tuple(scale * math.log((seen[k][f] + smooth) / (total[k] + 2 * smooth)) for k in range(3))
    return TreeModel([_normal(r) for r in steps], weight)


def extract_main_text(pages: DataFrame, model: TreeModel, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` (code points) of each row of ``pages``.

    Nulls in the html count as an empty page, which has an empty text; a null id or url is passed
    on. Repeated rows are returned as often as given; further columns are ignored. Nothing is cut,
    however long the page: the work is linear in it. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [model.main_text(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    slim = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html")
    )
    return slim.mapInArrow(run, "page_id long, url string, text string, n_chars long")
