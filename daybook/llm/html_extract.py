"""Main text of web pages by a tree-structured graphical model.

A page becomes its tree of block elements. Every block is content, furniture
(menus, adverts, forms, comments ...) or a wrapper (a hidden state); its features (tag, class and id words, role, length of its own
text, share of linked text) depend on its state, and its state on that of its
parent. Sum-product messages, upward and then downward, give each block's
marginal probability of being content. The potentials are counted on labelled
pages: pages whose markup names the article itself.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tags that don't break a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp "
    "small span strike strong sub sup time tt u var wbr".split())
#: Tags whose content is never page text.
HIDDEN = frozenset("script style template title textarea select iframe noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Open elements that the start of another one ends, and what stops the search.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
        "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
ROOTS = frozenset(["#page", "html", "body"])
#: Prior knowledge, as imagined counts (see Model.prior).
FURNITURE_TAGS = "nav header footer aside form button dialog head".split()
CONTENT_TAGS = "article main p h1 h2 h3 h4 h5 h6 blockquote pre #text".split()
FURNITURE_WORDS = ("ad ads advert advertisement banner breadcrumb comment commentlist comments consent cookie cookies "
                   "discussion disqus footer form header login menu modal nav navbar navigation newsletter notice popup "
                   "promo related reply replies respond share sidebar signup social sponsor sponsored subscribe toolbar "
                   "widget").split()
#: Evidence that an article's own blocks may carry too: not enough alone against an article around it.
SOFT = {"link:2": 2.0, "word:social": 3.0, "word:related": 3.0, "word:discussion": 3.0, "word:form": 3.0}
CONTENT_WORDS = "article content entry main post story".split()
ROLES = "navigation banner contentinfo complementary form search dialog".split()

_TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)(?:>|\Z))""", re.S)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)")
_ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-zA-Z]+")


@dataclass
class Page:
    """Blocks in page order: ``parent`` (index, -1 at the top), ``tag``,
    ``marks`` (class, id and role features), ``chars`` and ``linked`` (of
    their own text); ``parts``: (block, text) of each run of text."""
    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["#page"])
    marks: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    chars: list[int] = field(default_factory=lambda: [0])
    linked: list[int] = field(default_factory=lambda: [0])
    parts: list[tuple[int, str]] = field(default_factory=list)


def _marks(attributes: str) -> tuple[str, ...]:
    out = []
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        kind = "role" if name.lower() == "role" else "word"
        out += [f"{kind}:{w.lower()}" for w in _WORD.findall(a or b or c)]
    return tuple(dict.fromkeys(out))


def parse(source: str) -> Page:
    """The block tree of a page. Unclosed and misplaced tags are mended as
    browsers do in the common cases (paragraphs, list items, table cells)."""
    page = Page()
    stack = [0]
    depths: dict[str, list[int]] = {}  # of the open elements by tag, so that no search walks the stack
    held: list[str] = []
    links = linked = 0

    def add(tag: str, marks: tuple[str, ...]) -> int:
        page.parent.append(stack[-1])
        page.tag.append(tag)
        page.marks.append(marks)
        page.chars.append(0)
        page.linked.append(0)
        return len(page.tag) - 1

    def flush() -> None:
        nonlocal linked
        if held:
            text = "".join(held)
            held.clear()
            if "&" in text:
                text = html.unescape(text)
            text = " ".join(text.split())
            if text:
                at = stack[-1]
                if page.tag[at] in ROOTS:  # text between the blocks of a body is a block of its own
                    at = add("#text", ())
                page.parts.append((at, text))
                page.chars[at] += len(text)
                page.linked[at] += linked
        linked = 0

    def end(depth: int) -> None:
        """Close the element at this depth and all in it."""
        for i in stack[depth:]:
            depths[page.tag[i]].pop()
        del stack[depth:]

    def last(tags: Iterable[str]) -> int:
        return max((depths[t][-1] for t in tags if depths.get(t)), default=0)

    at, n = 0, len(source)
    while at < n:
        lt = source.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            text = source[at:lt]
            held.append(text)
            if links:
                linked += len(text)
        if lt == n:
            break
        m = _TAG.match(source, lt) or _LOOSE.match(source, lt)
        if m is None:
            held.append("<")
            at = lt + 1
            continue
        at = m.end()
        if m.group(2) is None:
            continue
        tag = m.group(2).lower()
        closing = m.group(1)
        if tag in HIDDEN:
            if not closing and not m.group(3).endswith("/"):
                shut = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(source, at)
                at = shut.start() if shut else n
            continue
        if tag in INLINE:
            if tag == "a":
                links = 0 if closing else 1
            elif tag == "br":
                held.append(" ")
            continue
        flush()
        links = 0
        if closing:
            if depths.get(tag):
                end(depths[tag][-1])
            continue
        if page.tag[stack[-1]] == "p":
            end(len(stack) - 1)
        if tag in ENDS:
            ended, stop = ENDS[tag]
            while (depth := last(ended)) > last(stop):
                end(depth)
        if tag in VOID or m.group(3).endswith("/"):
            continue
        depths.setdefault(tag, []).append(len(stack))
        stack.append(add(tag, _marks(m.group(3)) if m.group(3) else ()))
    flush()
    return page


def features(page: Page, i: int) -> list[str]:
    chars = page.chars[i]
    size = 0 if not chars else 1 if chars < 25 else 2 if chars < 100 else 3
    out = [f"tag:{page.tag[i]}", f"size:{size}"]
    if chars:
        share = page.linked[i] / chars
        out.append("link:0" if share < 0.25 else "link:1" if share < 0.75 else "link:2")
    out += page.marks[i]
    return out


#: Hidden states: neither (wrappers), content, furniture.
WRAPPER, CONTENT, FURNITURE = range(3)
STATES = (WRAPPER, CONTENT, FURNITURE)


def labels(page: Page) -> list[int] | None:
    """States as the page's own markup names them: content inside ``article``
    or ``main``, furniture inside elements that say so (anywhere), wrappers
    else. None if it names no article."""
    if "article" not in page.tag and "main" not in page.tag:
        return None
    out = [WRAPPER] * len(page.tag)
    furniture = {f"tag:{t}" for t in FURNITURE_TAGS} | {f"word:{w}" for w in FURNITURE_WORDS} | {f"role:{r}" for r in ROLES}
    for i in range(1, len(page.tag)):
        up = out[page.parent[i]]
        if up == FURNITURE or furniture & {f"tag:{page.tag[i]}", *page.marks[i]}:
            out[i] = FURNITURE
        elif up == CONTENT or page.tag[i] in ("article", "main"):
            out[i] = CONTENT
    return out


class Model:
    """Counts of (state, feature) and of (parent's state, state), turned into
    potentials. ``weight``: imagined counts behind each item of prior
    knowledge; ``most``: bound of the logarithm of one feature's potential
    (more for the marks of furniture and the tags that name an article).

    Tags, sizes and lack of links tell text from wrappers, but not content from
    furniture: a comment is a paragraph too, and many of them must not outvote
    the mark on their parent. For those features the two states are tied."""

    def __init__(self, counts: dict[str, int], weight: float = 20.0, most: float = 6.0):
        seen: Counter = Counter(self.prior(weight))
        for k, n in counts.items():
            seen[k] += n
        self.edge = []
        for a in STATES:
            row = [seen[f"edge:{a}:{b}"] + 1e-3 for b in STATES]
            if a == WRAPPER:  # the sample's furniture is marked; unmarked text is rather content
                row[CONTENT] = max(row[CONTENT], 1.5 * row[FURNITURE])
            if a == CONTENT:  # an article may hold furniture though the sample's don't
                row[FURNITURE] = max(row[FURNITURE], 0.02 * sum(row))
            self.edge.append([x / sum(row) for x in row])
        blocks = [seen[f"state:{s}"] + 2 for s in STATES]
        self.own: dict[str, tuple[float, ...]] = {}
        marks = {f"tag:{t}" for t in FURNITURE_TAGS} | {f"word:{w}" for w in FURNITURE_WORDS} | {f"role:{r}" for r in ROLES}
        named = {"tag:article", "tag:main"}
        good = {f"word:{w}" for w in CONTENT_WORDS}
        for name in {k[4:] for k in seen if k[:2] == "f:"}:
            # rate per block of a state; a part of a count for what was never seen
            unseen, bound = (1e-6, 14.0) if name in named else (0.02, 2 * most) if name in marks \
                else (0.02 if name in good else 0.5, most)
            rate = [math.log((seen[f"f:{s}:{name}"] + unseen) / blocks[s]) for s in STATES]
            if name not in marks and name not in named and (name[:4] in ("tag:", "size") or name == "link:0"):
                rate[CONTENT] = rate[FURNITURE] = max(rate[CONTENT], rate[FURNITURE])
            if name in SOFT:
                rate[CONTENT] = max(rate[CONTENT], rate[FURNITURE] - SOFT[name])
            elif name in marks:  # as strong where the sample holds many other furniture blocks
                rate[CONTENT] = min(rate[CONTENT], rate[FURNITURE] - 2 * most + 2)
            self.own[name] = tuple(max(-bound, x - max(rate)) for x in rate)

    @staticmethod
    def prior(weight: float) -> dict[str, float]:
        out: dict[str, float] = {f"state:{s}": 10 * weight for s in STATES}
        for state, names in ((FURNITURE, [f"tag:{t}" for t in FURNITURE_TAGS] + [f"word:{w}" for w in FURNITURE_WORDS]
                              + [f"role:{r}" for r in ROLES] + ["link:2"]),
                             (CONTENT, [f"tag:{t}" for t in CONTENT_TAGS] + [f"word:{w}" for w in CONTENT_WORDS] + ["size:3"])):
            out |= {f"f:{state}:{n}": weight for n in names}
        # furniture stays furniture below, content mostly stays content
        for a, row in ((WRAPPER, (20, 6, 4)), (CONTENT, (0.1, 50, 1)), (FURNITURE, (0.05, 0, 500))):
            out |= {f"edge:{a}:{b}": x * weight for b, x in zip(STATES, row)}
        return out

    def potential(self, page: Page, i: int) -> list[float]:
        """Of a block's features, for each state; the largest is 1."""
        sums = [0.0, 0.0, 0.0]
        for x in features(page, i):
            known = self.own.get(x)
            if known:
                for s in STATES:
                    sums[s] += known[s]
        top = max(sums)
        return [math.exp(x - top) for x in sums]

    def marginals(self, page: Page) -> list[float]:
        """Probability of content of every block: messages from the leaves to
        the top, then from the top to the leaves. The page, html and body are
        wrappers."""
        n = len(page.tag)
        edge = self.edge
        below = [self.potential(page, i) for i in range(n)]  # with the messages of the children
        for i in range(n):
            if page.tag[i] in ROOTS:
                below[i] = [1.0, 0.0, 0.0]
        up = [(1.0, 1.0, 1.0)] * n  # message to the parent, by its state
        for i in range(n - 1, 0, -1):
            x, y, z = below[i]
            m = [a * x + b * y + c * z for a, b, c in edge]
            top = max(m)
            up[i] = m[0] / top, m[1] / top, m[2] / top
            mine = below[page.parent[i]]
            for s in STATES:
                mine[s] = mine[s] * up[i][s]
            top = max(mine)
            if top < 1e-100:
                below[page.parent[i]] = [v / top for v in mine]
        out = [0.0] * n
        belief: list[list[float]] = [[1.0, 0.0, 0.0]] * n
        for i in range(1, n):
            above = belief[page.parent[i]]
            # the parent's belief without what this block told it
            rest = [above[s] / up[i][s] if above[s] else 0.0 for s in STATES]
            down = [rest[0] * edge[0][s] + rest[1] * edge[1][s] + rest[2] * edge[2][s] for s in STATES]
            own = [below[i][s] * down[s] for s in STATES]
            total = sum(own)
            belief[i] = [v / total for v in own]
            out[i] = belief[i][CONTENT]
        return out


def main_text(source: str, model: Model) -> str:
    """Blocks of content in page order, joined by line ends."""
    page = parse(source)
    likely = model.marginals(page)
    return "\n".join(text for i, text in page.parts if likely[i] >= 0.5)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    for batch in batches:
        for source in batch.column(0).to_pylist():
            page = parse(source or "")
            state = labels(page)
            if state is None:
                continue
            for i in range(1, len(state)):
                seen[f"state:{state[i]}"] += 1
                seen[f"edge:{state[page.parent[i]]}:{state[i]}"] += 1
                seen.update(f"f:{state[i]}:{x}" for x in features(page, i))
    yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                     names=["name", "n"])


def train(pages: DataFrame, html_col: str = "html", sample: int = 2_000, least: int = 3) -> Model:
    """Potentials from at most ``sample`` pages drawn at random; those that
    name their article are the labelled ones. Class words seen fewer than
    ``least`` times are left out. Without labelled pages the prior decides."""
    source = pages.select(F.col(html_col).alias("html"))
    n = source.count()
    drawn = source if n <= sample else source.sample(False, sample / n, 5)
    counted = drawn.mapInArrow(_count, "name string, n long").groupBy("name").agg(F.sum("n").alias("n"))
    return Model({r.name: r.n for r in counted.filter(F.col("n") >= least).collect()})


def _extract(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = max(1, batch.num_rows // (1 + batch.nbytes // (8 << 20)))
        for at in range(0, batch.num_rows, size):
            some = batch.slice(at, size)
            texts = [main_text(x or "", model) for x in some.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [some.column(0), some.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["id", "url", "text", "n_chars"])


def extract_text(pages: DataFrame, model: Model | None = None, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """``(id, url, text, n_chars)`` per row of ``pages``.

    Character references are decoded, white space inside a block becomes one
    space, blocks are joined by one line end; a line break (``br``) is white
    space. Text directly under the body is a block of its own. Null html counts as empty; its text is the empty string. Null and
    repeated ids are kept, one row per input row. An empty table gives an
    empty result. One pass without a shuffle, after training on a sample.
    """
    known = model or train(pages, html_col)
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(lambda it: _extract(known, it), "id long, url string, text string, n_chars long")
