"""Wrapper induction: what pages of one host have in common is template, what varies is content.

Pages become trees. A first pass counts on how many of a host's pages each subtree stands with the same text; what most pages have are the
candidates, and the pages that hold them first become the host's wrapper: a tree of the candidates and the elements around them, other
pages' candidates inserted where an alignment puts them. A second pass aligns every page with the wrapper by simple tree
matching (the order-preserving alignment of children that matches the most nodes, from the root down; equal texts weigh more) and counts
for each place of the wrapper how often it was matched, how often with the wrapper's text, and how much text that varies lies before it.

A place is template if it was matched on enough pages, with one text on all but a few of them, and doesn't lie within the content, that is, between
parts of the varying text. What is in any other place, or in none, is content. All counts are exact and taken over all pages. The size of a wrapper
is bounded by the size of a host's pages: of the texts of a page, on average, at most 1 / share can be candidates.
"""

from __future__ import annotations

import json
import re
import sys
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b
from html import unescape
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.runtime import materialize, release

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][\w:-]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
_CLASS = re.compile(r"\bclass\s*=\s*[\"']?([\w-]+)", re.I)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr b big br cite code dfn em font i img ins kbd o:p q s samp small span strike strong sub sup tt u var".split())
RAW = frozenset("script style textarea title xmp listing plaintext".split())
BLOCK = frozenset("address article aside blockquote center dir div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: What an opening tag closes, and the elements in which it stops looking.
CLOSES = {"li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("table", "tr")), "th": (("td", "th"), ("table", "tr"))}
_BARRIER = ("table", "td", "th", "ul", "ol", "dl", "li")
_ACROSS = BLOCK | {*_BARRIER, "tr", "tbody", "thead"}


class Node:
    """An element, or a text with tag "#". flat: holds running text alone; mark: of its form and text, 0 if that is blank; size: of its text."""

    __slots__ = ("children", "cls", "flat", "mark", "size", "tag", "text")

    def __init__(self, tag: str, cls: str = "", text: str = ""):
        self.tag, self.cls, self.text, self.children, self.flat, self.mark, self.size = tag, cls, text, [], True, 0, 0

    def full_text(self) -> str:
        if self.tag == "#":
            return self.text
        out: list[str] = []
        stack = [self]
        while stack:
            n = stack.pop()
            if n.tag == "#":
                out.append(n.text)
            else:
                if n.tag == "br":
                    out.append("\n")
                stack.extend(reversed(n.children))
        return "".join(out)


class _Open:
    """The open elements, with the places of each tag among them, so that no tag is looked for one by one."""

    def __init__(self, root: Node):
        self.stack, self.at = [root], defaultdict(list)

    def last(self, tags: tuple[str, ...]) -> int:
        return max((self.at[t][-1] for t in tags if self.at[t]), default=0)

    def first_after(self, tags: tuple[str, ...], place: int) -> int:
        return min((own[k] for t in tags if (k := bisect_right(own := self.at[t], place)) < len(own)), default=0)

    def push(self, node: Node) -> None:
        self.at[node.tag].append(len(self.stack))
        self.stack.append(node)

    def close(self, place: int) -> None:
        for n in self.stack[place:]:
            self.at[n.tag].pop()
        del self.stack[place:]


def parse_html(html: str | None) -> Node:
    """The tree of a page, of any depth; tolerant of unclosed and stray tags. Comments and declarations are dropped."""
    root = Node("root")
    root.flat = False
    open_, at, text = _Open(root), 0, html or ""
    while True:
        m = _TOKEN.search(text, at)
        piece = text[at : m.start()] if m else text[at:]
        if piece:
            open_.stack[-1].children.append(Node("#", text=unescape(piece)))
        if not m:
            return root
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if m["end"]:
            own = open_.at[tag]
            if own and (tag in _ACROSS or open_.last(_BARRIER) <= own[-1]):
                open_.close(own[-1])
            continue
        if tag in CLOSES:
            ends, stop = CLOSES[tag]
            k = open_.first_after(ends, open_.last(stop))
            if k:
                open_.close(k)
        elif tag in BLOCK and open_.at["p"] and open_.at["p"][-1] > open_.last((*_BARRIER, "div")):
            open_.close(open_.at["p"][-1])
        cls = _CLASS.search(m["attrs"]) if m["attrs"] else None
        node = Node(tag, cls[1] if cls else "")
        open_.stack[-1].children.append(node)
        if tag not in INLINE:
            for n in reversed(open_.stack):
                if not n.flat:
                    break
                n.flat = False
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(text, at)
            if tag in ("xmp", "listing", "plaintext"):
                node.children.append(Node("#", text=text[at : end.start() if end else len(text)]))
            at = end.end() if end else len(text)
        elif tag not in VOID and not m["attrs"].endswith("/"):
            open_.push(node)


def _mark(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True) or 1


def marked(root: Node) -> list[Node]:
    """Sets marks and sizes; the page's nodes from the root down, without what is within flat ones."""
    order, stack = [], [root]
    while stack:
        n = stack.pop()
        order.append(n)
        if not n.flat:
            stack.extend(n.children)
    for n in reversed(order):
        if n.flat:
            words = " ".join(n.full_text().split())
            n.size = len(words)
            n.mark = _mark(f"{n.tag}.{n.cls} {words}") if words else 0
        else:
            below = [c for c in n.children if c.mark]
            n.size = sum(c.size for c in below)
            n.mark = _mark(f"{n.tag}.{n.cls}>{[c.mark for c in below]}") if below else 0
    return order


def units(node: Node) -> list[Node]:
    """Children that hold text: what an alignment is about."""
    return [] if node.flat else [c for c in node.children if c.mark]


# --- wrappers ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Induction:
    """share and least: pages that must have a place for it to be template. noise: share of these whose text may be another. within: share of the varying text that on both sides makes a place lie within the content."""

    share: float = 0.5
    least: int = 5
    noise: float = 0.02
    within: float = 0.1

    def enough(self, pages: int) -> float:
        return max(self.least, self.share * pages)


class Slot:
    """A place of a wrapper: a text (mark) or, with mark 0, an element around others. no: its number among the texts, in page order."""

    __slots__ = ("children", "cls", "mark", "no", "tag")

    def __init__(self, tag: str, cls: str, mark: int, children: list["Slot"]):
        self.tag, self.cls, self.mark, self.children, self.no = tag, cls, mark, children, -1


def _below(n: Slot | Node) -> list:
    return units(n) if isinstance(n, Node) else n.children


class Alignment:
    """Places of a wrapper beside the nodes of a page, or of another wrapper.

    Texts that stand once on either side, under elements of the same forms, are anchors, and so are the elements around them. What lies between two
    anchors is aligned by simple tree matching, whatever its size. Subtrees of which no text agrees weigh by their shapes alone, once for each
    two shapes; only those that share a text are compared one by one.
    """

    def __init__(self, slots: list[Slot], nodes: list):
        self.roots = slots, nodes
        self.memo: dict[tuple[int, int], int] = {}
        self.hint: dict[int, Slot | Node] = {}
        self.shapes: _Shapes | None = None
        own, there = self._texts(slots), self._texts(nodes)
        for mark, chain in own.items():
            if chain and there.get(mark):
                self._climb(chain, there[mark])

    @staticmethod
    def _texts(roots: list) -> dict[int, tuple | None]:
        """By mark what holds it, as (node, (parent, ...)); None if it stands more than once."""
        out: dict[int, tuple | None] = {}
        stack: list[tuple] = [(n, None) for n in roots]
        while stack:
            link = stack.pop()
            n = link[0]
            if n.mark:
                out[n.mark] = None if n.mark in out else link
            stack.extend((c, link) for c in _below(n))
        return out

    def _climb(self, own: tuple | None, there: tuple | None) -> None:
        """Matches two texts and what is around them, if the forms agree up to the root or up to what is matched already."""
        pairs, agreed = [], False
        while own and there and (own[0].tag, own[0].cls) == (there[0].tag, there[0].cls):
            known = self.hint.get(id(own[0]))
            if known is not None:
                agreed = known is there[0]
                break
            pairs.append((own[0], there[0]))
            own, there = own[1], there[1]
            agreed = own is None and there is None
        if agreed:
            for s, n in pairs:
                self.hint[id(s)] = n

    def _alike(self, s: Slot, n: Slot | Node) -> int:
        """Nodes matched by the best alignment of two subtrees, a place with its own text counting for three."""
        if s.tag != n.tag or s.cls != n.cls:
            return 0
        if s.mark:
            return 3 if n.mark == s.mark else 1
        key = (id(s), id(n))
        got = self.memo.get(key)
        if got is None:
            got = 1
            for _, _, w in self.pairs(s.children, _below(n)):
                got += w
            self.memo[key] = got
        return got

    def pairs(self, slots: list[Slot], nodes: list) -> list[tuple[int, int, int]]:
        """(slot, node, weight) in order, from lists whose parents are matched."""
        if not slots or not nodes:
            return []
        at = {id(n): j for j, n in enumerate(nodes)} if self.hint else {}
        sure = [(i, j) for i, s in enumerate(slots) if (j := at.get(id(self.hint.get(id(s))))) is not None]
        out: list[tuple[int, int, int]] = []
        a = b = 0
        for i, j in [*_chain(sure), (len(slots), len(nodes))]:
            if a < i and b < j:
                out += self._between(slots, a, i, nodes, b, j)
            if i < len(slots):
                out.append((i, j, self._alike(slots[i], nodes[j])))
            a, b = i + 1, j + 1
        return out

    def _between(self, slots: list[Slot], a: int, i: int, nodes: list, b: int, j: int) -> list[tuple[int, int, int]]:
        forms = {(s.tag, s.cls) for s in slots[a:i]}
        there = [k for k in range(b, j) if (nodes[k].tag, nodes[k].cls) in forms]
        if not there:
            return []
        if self.shapes is None:
            self.shapes = _Shapes(*self.roots)
        own, beside = slots[a:i], [nodes[k] for k in there]
        plain = self.shapes.gains([self.shapes.own[id(s)] for s in own], [self.shapes.there[id(n)] for n in beside])
        shared: dict[int, tuple[list[int], list[int]]] = defaultdict(lambda: ([], []))
        for x, y in self.shapes.sharing(own, beside):
            shared[x][0].append(y)
            shared[x][1].append(self._alike(own[x], beside[y]))

        def gain(x: int) -> np.ndarray:
            g = plain(x)
            if x in shared:
                g[shared[x][0]] = shared[x][1]
            return g

        return [(a + x, there[y], w) for x, y, w in _matched(gain, len(own), len(beside))]


class _Shapes:
    """Both sides of an alignment without their texts, and where the texts are that stand on both.

    A shape is a number: of the form of a place that is a text, or of the form and the shapes below. Nodes are numbered from the root down, so
    that what is within a node has the numbers of one range.
    """

    def __init__(self, slots: list[Slot], nodes: list):
        self.known: dict[tuple, int] = {}
        self.parts: list[tuple] = []
        self.weight: dict[tuple[int, int], int] = {}
        self.own, self.own_span, marks = self._read(slots, True)
        self.there, self.span, texts = self._read(nodes, False)
        self.places: dict[int, list[int]] = defaultdict(list)
        for at, mark in marks:
            self.places[mark].append(at)
        both = [(at, mark) for at, mark in texts if mark in self.places]
        self.at, self.mark = [at for at, _ in both], [mark for _, mark in both]

    def _read(self, roots: list, places: bool) -> tuple[dict[int, int], dict[int, tuple[int, int]], list[tuple[int, int]]]:
        """Shapes, ranges of numbers, and (number, mark) of all texts."""
        order, stack = [], list(reversed(roots))
        while stack:
            n = stack.pop()
            order.append(n)
            stack.extend(reversed(_below(n)))
        shape: dict[int, int] = {}
        span: dict[int, tuple[int, int]] = {}
        for at in range(len(order) - 1, -1, -1):
            n = order[at]
            below = _below(n)
            key = (n.tag, n.cls, None if places and n.mark else tuple([shape[id(c)] for c in below]))
            shape[id(n)] = self.known.setdefault(key, len(self.known))
            if len(self.parts) < len(self.known):
                self.parts.append(key)
            span[id(n)] = at, span[id(below[-1])][1] if below else at + 1
        return shape, span, [(at, n.mark) for at, n in enumerate(order) if n.mark]

    def sharing(self, slots: list[Slot], nodes: list) -> list[tuple[int, int]]:
        """Which of these places and nodes have a text in common, somewhere within."""
        begins = [self.own_span[id(s)][0] for s in slots]
        out: set[tuple[int, int]] = set()
        for y, n in enumerate(nodes):
            first, end = self.span[id(n)]
            for k in range(bisect_left(self.at, first), bisect_left(self.at, end)):
                for place in self.places[self.mark[k]]:
                    x = bisect_right(begins, place) - 1
                    if x >= 0 and place < self.own_span[id(slots[x])][1]:
                        out.add((x, y))
        return sorted(out)

    def gains(self, own: list[int], there: list[int]) -> Callable[[int], np.ndarray]:
        """For each of the first its weights beside all of the second."""
        kinds: dict[int, int] = {}
        of = np.array([kinds.setdefault(t, len(kinds)) for t in there])
        rows: dict[int, np.ndarray] = {}

        def gain(x: int) -> np.ndarray:
            s = own[x]
            if s not in rows:
                rows[s] = np.array([self._alike(s, t) for t in kinds], np.int32)
            return rows[s].take(of)

        return gain

    def _alike(self, own: int, there: int) -> int:
        """Nodes matched by the best alignment of two shapes."""
        (tag, cls, slots), (tag_, cls_, nodes) = self.parts[own], self.parts[there]
        if tag != tag_ or cls != cls_:
            return 0
        if not slots or not nodes:
            return 1
        got = self.weight.get((own, there))
        if got is None:
            gain, row = self.gains(slots, nodes), np.zeros(len(nodes) + 1, np.int32)
            for x in range(len(slots) - 1, -1, -1):
                row = _row(row, gain(x))
            got = self.weight[own, there] = 1 + int(row[0])
        return got


def _row(low: np.ndarray, gain: np.ndarray) -> np.ndarray:
    """Greatest weights from each node on, with one place more than in ``low``."""
    row = np.zeros_like(low)
    np.maximum.accumulate(np.maximum(low[:-1], low[1:] + gain)[::-1], out=row[-2::-1])
    return row


def _matched(gain: Callable[[int], np.ndarray], m: int, n: int) -> list[tuple[int, int, int]]:
    """(place, node, weight) of the order-preserving matching of the greatest weight; of equal ones that which matches first.

    Of the table's m rows one in each sqrt(m) is kept, those between are made again when the way goes through them.
    """
    step = isqrt(m) + 1
    kept, row = {}, np.zeros(n + 1, np.int32)
    for x in range(m - 1, -1, -1):
        if x == m - 1 or (x + 1) % step == 0:
            kept[x + 1] = row
        if x >= step:
            row = _row(row, gain(x))
    out, y = [], 0
    for first in range(0, m, step):
        if y == n:
            break
        end, begin = min(first + step, m), y
        rows, gains = [kept.pop(end)[begin:]], []
        for x in range(end - 1, first - 1, -1):
            gains.append(gain(x)[begin:])
            rows.append(_row(rows[-1], gains[-1]))
        for x in range(first, end):
            now, low, g = rows.pop(), rows[-1], gains.pop()
            while y < n and now[y - begin]:
                k = y - begin
                if g[k] and now[k] == low[k + 1] + g[k]:
                    out.append((x, y, int(g[k])))
                    y += 1
                    break
                if now[k] != now[k + 1]:
                    break
                y += 1
    return out


def _chain(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest chain of pairs that rises on both sides; the pairs come by their first member."""
    tails: list[int] = []
    ends: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tails, j)
        tails[at : at + 1] = [j]
        ends[at : at + 1] = [k]
        back[k] = ends[at - 1] if at else -1
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


class Wrapper:
    """The wrapper of a host. fixed: for each of its texts whether it is template, once that is known."""

    def __init__(self, slots: list[Slot] | None = None, fixed: list[bool] | None = None):
        self.slots, self.fixed = slots or [], fixed or []
        self.texts = self._number()

    def _number(self) -> int:
        n, depth, stack = 0, 0, [(s, 1) for s in reversed(self.slots)]
        while stack:
            s, d = stack.pop()
            depth = max(depth, d)
            if s.mark:
                s.no = n
                n += 1
            stack.extend((c, d + 1) for c in reversed(s.children))
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 8 * depth + 1000))  # alignments go as deep as the wrapper
        return n

    def learn(self, page: Node, counts: dict[int, int], how: Induction) -> None:
        """Adds the candidates of a page; counts: pages by mark, of candidates alone.

        An element whose text is a candidate is one place unless something within it stands on more pages. What a page has more than once
        is a matter of repetition and no place by itself.
        """
        order = marked(page)
        times: dict[int, int] = defaultdict(int)
        for n in order:
            times[n.mark] += 1
        made: dict[int, Slot | None] = {}
        most: dict[int, int] = {}
        for n in reversed(order):
            own = counts.get(n.mark, 0) if n is not page else 0
            kids = [s for c in units(n) if (s := made.get(id(c)))]
            below = max((most.get(id(c), 0) for c in units(n)), default=0)
            most[id(n)] = max(own, below)
            if own and times[n.mark] == 1 and below <= own * (1 + how.noise):
                made[id(n)] = Slot(n.tag, n.cls, n.mark, [])
            elif kids:
                made[id(n)] = Slot(n.tag, n.cls, 0, kids)
        new = made.get(id(page))
        if new is not None:
            self.slots = self._join(self.slots, new.children, Alignment(self.slots, new.children), self._marks())
            self.texts = self._number()

    def _marks(self) -> set[int]:
        out, stack = set(), list(self.slots)
        while stack:
            s = stack.pop()
            out.add(s.mark)
            stack.extend(s.children)
        return out - {0}

    def _join(self, slots: list[Slot], more: list[Slot], how: Alignment, known: set[int]) -> list[Slot]:
        """Places of both, in an order that agrees with either; of ``more`` only those that hold texts which aren't known."""
        out, at = [], 0
        pairs = {j: i for i, j, _ in how.pairs(slots, more)}
        for j, s in enumerate(more):
            i = pairs.get(j)
            if i is not None:
                out += slots[at : i + 1]
                at = i + 1
                if not slots[i].mark and not s.mark:
                    slots[i].children = self._join(slots[i].children, s.children, how, known)
                    continue
            new = self._unknown(s, known)
            if new is not None:
                out.append(new)
        return out + slots[at:]

    @staticmethod
    def _unknown(s: Slot, known: set[int]) -> Slot | None:
        """A place without the texts that are known; None if nothing is left."""
        done: dict[int, Slot | None] = {}
        order, stack = [], [s]
        while stack:
            x = stack.pop()
            order.append(x)
            stack.extend(x.children)
        for x in reversed(order):
            kids = [k for c in x.children if (k := done[id(c)])]
            done[id(x)] = (None if x.mark in known else x) if x.mark else (Slot(x.tag, x.cls, 0, kids) if kids else None)
        return done[id(s)]

    def visit(self, page: Node) -> Iterator[tuple[Slot | None, Node]]:
        """The page's texts in order, each with the place that it was matched with."""
        how = Alignment(self.slots, units(page))
        stack = [(self.slots, units(page), 0, None)]
        while stack:
            slots, nodes, at, pairs = stack.pop()
            if pairs is None:
                pairs = {j: i for i, j, _ in how.pairs(slots, nodes)}
            while at < len(nodes):
                n, i = nodes[at], pairs.get(at)
                at += 1
                if i is None or slots[i].mark:
                    yield None if i is None else slots[i], n
                elif not n.flat:
                    stack.append((slots, nodes, at, pairs))
                    stack.append((slots[i].children, units(n), 0, None))
                    break
                else:
                    yield None, n

    def content(self, page: Node) -> Node:
        """The page without its template, nor elements of which nothing else is left. Blanks between what stays are kept."""
        if not any(self.fixed):
            return page
        order = marked(page)
        gone = {id(n) for s, n in self.visit(page) if s is not None and self.fixed[s.no] and n.mark == s.mark}
        for n in reversed(order if gone else []):
            below = units(n)
            if below and n is not page and all(id(c) in gone for c in below):
                gone.add(id(n))
        for n in order if gone else []:
            n.children = [c for c in n.children if id(c) not in gone]
        return page

    def settle(self, pages: int, n: list[int], same: list[int], before: list[int], how: Induction) -> None:
        """Which texts are template. n, same: pages matched, and matched with its text; before: varying text before each text and, last, after all."""
        total, so_far, self.fixed = sum(before), 0, []
        for k in range(self.texts):
            so_far += before[k]
            inside = min(so_far, total - so_far) >= how.within * total > 0
            self.fixed.append(not inside and n[k] >= how.enough(pages) and same[k] >= (1 - how.noise) * n[k])

    def dumps(self) -> str:
        """Places from the root down, each with its depth."""
        out, stack = [], [(s, 0) for s in reversed(self.slots)]
        while stack:
            s, d = stack.pop()
            out.append([d, s.tag, s.cls, s.mark])
            stack.extend((c, d + 1) for c in reversed(s.children))
        return json.dumps([out, [int(x) for x in self.fixed]], separators=(",", ":"))

    @classmethod
    def loads(cls, text: str) -> "Wrapper":
        rows, fixed = json.loads(text)
        lists: list[list[Slot]] = [[]]
        for d, tag, form, mark in rows:
            s = Slot(tag, form, mark, [])
            del lists[d + 1 :]
            lists[d].append(s)
            lists.append(s.children)
        return cls(lists[0], [bool(x) for x in fixed])


def _host_rows(schema: dict[str, pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.values(), strict=True)], list(schema))


def induce(pages: DataFrame, key: str, host: str, html: str, how: Induction = Induction()) -> DataFrame:
    """(host, wrapper): one row for each host that has a template; null pages count for nothing, a null host is the host "".

    pages: one row per page, ``key`` unique. Hosts whose pages have nothing in common cost one pass over their pages.
    """
    spark = pages.sparkSession
    kind = dict(pages.dtypes)[key]
    p = pages.select(F.coalesce(F.col(host), F.lit("")).alias("host"), F.col(key).alias("page"), F.col(html).alias("html")).where("html is not null")
    made: list[DataFrame] = []

    def kept(df: DataFrame, label: str) -> DataFrame:
        made.append(materialize(df, label))
        return made[-1]

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = []
            for x in b.column("html").to_pylist():
                own.append([0, *{n.mark for n in marked(parse_html(x))[1:]} - {0}])
            yield pa.RecordBatch.from_arrays([b.column("host"), b.column("page"), pa.array(own, pa.list_(pa.int64()))], ["host", "page", "marks"])

    each = p.mapInArrow(marks, f"host string, page {kind}, marks array<long>").select("host", "page", F.explode("marks").alias("mark"))
    counts = kept(each.groupBy("host", "mark").agg(F.count(F.lit(1)).alias("n"), F.min("page").alias("page")).where((F.col("n") >= how.least) | (F.col("mark") == 0)), "marks")
    hosts = counts.where("mark = 0").select("host", F.col("n").alias("pages"))
    # within the noise a place may have its text on somewhat fewer pages than must have the place
    often = kept(counts.where("mark <> 0").join(hosts, "host").where((F.col("n") >= how.least) & (F.col("n") >= (1 - how.noise) * how.share * F.col("pages"))), "often")
    schema = {"host": pa.string(), "wrapper": pa.string()}
    if often.isEmpty():
        return spark.createDataFrame([], "host string, wrapper string")
    first = p.join(often.select("host", "page").distinct(), ["host", "page"], "left_semi").select("host", "page", "html")
    known = often.groupBy("host").agg(F.collect_list("mark").alias("marks"), F.collect_list("n").alias("counts"))  # bounded: see the module
    grown = first.join(known, "host").repartition("host").sortWithinPartitions("host", "page")

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, w, counts_ = None, Wrapper(), {}
        for b in batches:
            for h, x, m, n in zip(*(b.column(c).to_pylist() for c in ("host", "html", "marks", "counts")), strict=True):
                if h != now:
                    if now is not None:
                        yield _host_rows(schema, [(now, w.dumps())])
                    now, w, counts_ = h, Wrapper(), dict(zip(m, n, strict=True))
                w.learn(parse_html(x), counts_, how)
        if now is not None:
            yield _host_rows(schema, [(now, w.dumps())])

    wrappers = kept(grown.select("host", "page", "html", "marks", "counts").mapInArrow(grow, "host string, wrapper string"), "wrappers")
    tally = {"host": pa.string(), "what": pa.int32(), "at": pa.int32(), "x": pa.int64()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Wrapper | None] = {}
        sums: dict[tuple[str, int, int], int] = defaultdict(int)
        for b in batches:
            for h, x, packed in zip(*(b.column(c).to_pylist() for c in ("host", "html", "wrapper")), strict=True):
                w = wrapper_of(h, packed, sent, known)
                if w is None:
                    continue
                page, at = parse_html(x), 0
                marked(page)
                for s, n in w.visit(page):
                    if s is not None:
                        sums[h, 0, s.no] += 1
                        if n.mark == s.mark:
                            sums[h, 1, s.no] += 1
                            at = s.no + 1
                            continue
                        sums[h, 2, s.no] += n.size
                        at = s.no + 1
                        continue
                    sums[h, 2, at] += n.size
            if len(sums) > 100_000:
                yield _host_rows(tally, [(*k, x) for k, x in sums.items()])
                sums.clear()
        yield _host_rows(tally, [(*k, x) for k, x in sums.items()])

    beside, sent = with_wrapper(p, wrappers)
    seen = beside.select("host", "html", "wrapper").mapInArrow(count, "host string, what int, at int, x long")
    seen = seen.groupBy("host", "what", "at").agg(F.sum("x").alias("x")).groupBy("host").agg(F.collect_list(F.struct("what", "at", "x")).alias("sums"))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for h, packed, pages_, sums in zip(*(b.column(c).to_pylist() for c in ("host", "wrapper", "pages", "sums")), strict=True):
                w = Wrapper.loads(packed)
                by = [[0] * (w.texts + 1) for _ in range(3)]
                for s in sums:
                    by[s["what"]][s["at"]] = s["x"]
                w.settle(pages_, *by, how)
                if any(w.fixed):
                    out.append((h, w.dumps()))
            yield _host_rows(schema, out)

    done = materialize(wrappers.join(hosts, "host").join(seen, "host").select("host", "wrapper", "pages", "sums").mapInArrow(settle, "host string, wrapper string"), "settled")
    for t in made:
        release(t) if t.inputFiles() else None
    return done


#: Wrappers go to the tasks as they are if they are no more and no larger together than this; else they are joined. Either way has all of them.
SENT_HOSTS, SENT_BYTES = 200, 4_000_000


def with_wrapper(pages: DataFrame, wrappers: DataFrame) -> tuple[DataFrame, dict[str, str] | None]:
    """Pages with a column ``wrapper``, null where the host has none or where all are in the second part of the result."""
    n, size = wrappers.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("wrapper")), F.lit(0))).first()
    if n <= SENT_HOSTS and size <= SENT_BYTES:
        return pages.withColumn("wrapper", F.lit(None).cast("string")), dict(tuple(r) for r in wrappers.select("host", "wrapper").collect())
    return pages.join(wrappers, "host", "left"), None


def wrapper_of(host: str, packed: str | None, sent: dict[str, str] | None, known: dict[str, Wrapper | None]) -> Wrapper | None:
    """A page's wrapper, read once for some hundred hosts."""
    if host not in known:
        if len(known) > SENT_HOSTS:
            known.clear()
        own = packed if sent is None else sent.get(host)
        known[host] = Wrapper.loads(own) if own else None
    return known[host]
