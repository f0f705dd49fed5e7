"""Several values packed in one field: EM segmentation with Viterbi decoding.

The whole column teaches the model how often each value shape and each separator occurs
(expectation-maximisation over all segmentations that a line allows); a Viterbi lattice then
picks the likeliest segmentation of every line. Quoted and bracketed spans are atoms, so
nothing inside them can part two values.

Model. A line is a list of atoms with gaps between them. A gap is a candidate cut if it holds a
separator sign. P(line) = product of theta(shape of value) for its values, and of pi(kind) for each
gap that is a cut, 1 - pi(kind) for each that is not.
A value's shape is its text with digit runs folded, and quoted or bracketed spans folded; theta mixes
the shape's frequency with how often values begin and end with the atoms it has at its ends, for
shapes seen too seldom to count. Shapes, ends and gap kinds are hashed into a fixed number of
buckets, so that the parameters sent to the tasks have a size that doesn't grow with the data.

Where the caller gives an ``anchor`` pattern, every value holds exactly one anchor (as a law
citation does). Without anchors in a line the line is one value.

Without such a pattern how many values a line holds is learned too. A value then has its shape's frequency, mixed with a base probability that is the
product of its atoms' own (so longer values are less probable), and the odds of each kind of gap decide with it. A separator within
values is told from one between them by what stands around it going together throughout the column.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.runtime import materialize, release, slots

_ATOM = re.compile(
    r'"(?:""|[^"])*"(?!")'
    r"|“[^”]*”"
    r"|\((?:[^()]|\([^()]*\))*\)"
    r"|(?P<gap>(?:[\s,;|/&\[\]]|\band\b)+)"
    r"|(?:(?!\band\b)[^\s,;|/&\[\]\"“()])+"
    r"|."
)
_SIGN = re.compile(r"[,;|/&\[\]\t\n\r]|and")
_DIGITS = re.compile(r"\d+")
_BLANK = re.compile(r"\s+")
#: Signs that part a shape's atoms and gaps; in an atom, which a shape has folded anyway, they are one other sign. A gap can't hold them.
ATOM_END, GAP_BEGIN = "\x01", "\x02"
_KEPT = {1: "\x03", 2: "\x03"}
GAP_BUCKETS = 256
END_BUCKETS = 1024
#: Weight of the ends' part in theta, and what an unseen bucket counts.
END_WEIGHT, UNSEEN = 1e-3, 1e-9
#: Cuts and gaps within values that each kind of gap counts before any is seen.
GAP_PRIOR = 0.1
#: Arcs between two anchors' cuts beyond which a lattice isn't held as lists but walked end by end; either way has all of them.
DENSE = 64 * 64


@dataclass(frozen=True)
class Packing:
    """anchor: pattern of which each value holds one match; None if there is no such sign. buckets: size of the shape table."""

    anchor: str | None = None
    buckets: int = 1 << 14
    rounds: int = 4


class _Line:
    """Atoms of a line: spans, folded forms, anchors, and the gaps after each atom."""

    __slots__ = ("text", "spans", "folds", "anchors", "gaps")

    def __init__(self, text: str, anchor: re.Pattern[str] | None):
        self.text, self.spans, self.folds, self.gaps = text, [], [], []
        for m in _ATOM.finditer(text):
            if m.lastgroup == "gap":
                if self.spans:
                    self.gaps[-1] = m.group()
                continue
            a = m.group()
            self.spans.append(m.span())
            self.gaps.append("")
            c = a[0]
            self.folds.append(("Q" if anchor and anchor.search(a) else "q") if c in '"“' and len(a) > 1 else "()" if c == "(" else _DIGITS.sub("9", a).translate(_KEPT))
        if self.gaps:
            self.gaps[-1] = ""
        starts = {s: i for i, (s, _) in enumerate(self.spans)}
        self.anchors = sorted({i for i, f in enumerate(self.folds) if f == "Q"} | {starts[m.start()] for m in anchor.finditer(text) if m.start() in starts}) if anchor else []

    def shape(self) -> str:
        """The line with its values folded: equal for lines whose lattices are equal."""
        return ATOM_END.join(f + GAP_BEGIN + g for f, g in zip(self.folds, self.gaps, strict=True))

    def cuts(self) -> list[list[int]]:
        """For each pair of neighbouring anchors, the atoms after which a value may end.

        Where no gap between two anchors holds a separator, the gap before the second one's
        neighbours is all there is, so every gap counts.
        """
        out = []
        for a, b in zip(self.anchors, self.anchors[1:], strict=False):
            all_ = range(a, b)
            out.append([i for i in all_ if _SIGN.search(self.gaps[i])] or list(all_))
        return out


def _kind(gap: str) -> str:
    return _BLANK.sub("", gap.replace("\n", "N").replace("\t", "T").replace("\r", "N")) or "_"


class _Folded(_Line):
    """A line rebuilt from its shape."""

    def __init__(self, shape: str, anchor_at: list[int]):
        parts = [p.split(GAP_BEGIN) for p in shape.split(ATOM_END)]
        self.text, self.spans = "", []
        self.folds, self.gaps, self.anchors = [p[0] for p in parts], [p[1] for p in parts], anchor_at


def _prefix(line: _Line) -> list[str]:
    return [f + ("~" + _kind(g) + "~" if g else "") for f, g in zip(line.folds, line.gaps, strict=True)]


def _hash(text: str, buckets: int) -> int:
    return zlib.crc32(text.encode()) % buckets


@dataclass(frozen=True)
class Weights:
    """By bucket: frequencies of shapes, first and last atoms; odds that a gap parts values."""

    shape: list[float]
    first: list[float]
    last: list[float]
    gap: list[float]

    @classmethod
    def of(cls, counts: np.ndarray, buckets: int, free: bool = False) -> "Weights":
        at = np.cumsum([buckets, END_BUCKETS, END_BUCKETS, GAP_BUCKETS])
        *values, cut, seen = np.split(counts, at)
        odds = (cut + GAP_PRIOR) / (np.maximum(seen - cut, 0) + GAP_PRIOR)
        if free:  # a shape counts as often as it was seen elsewhere: no line can vouch for itself
            again = np.maximum(values[0] - 1, 0)
            return cls((again / (again.sum() + BASE_WEIGHT)).tolist(), ((values[1] + UNSEEN) / (values[1] + UNSEEN).sum()).tolist(), [], odds.tolist())
        return cls(*(((p + UNSEEN) / (p + UNSEEN).sum()).tolist() for p in values), odds.tolist())


#: A way from one cut to the next: what it weighs, and the buckets that it counts for.
_Arc = tuple[float, tuple[int, int, int]]


def _lattice(line: _Line, w: Weights, buckets: int) -> tuple[list[list[int]], list[list[list[_Arc | None]]], list[list[int]]]:
    """Cut candidates; arcs by segment, from and to; the bucket of each cut's gap."""
    cuts, last, pre = line.cuts(), len(line.folds) - 1, _prefix(line)
    ends, begins = [*cuts, [last]], [[-1], *cuts]
    arcs = []
    for k in range(len(ends)):
        tails = [_hash(line.folds[e], END_BUCKETS) for e in ends[k]]
        rows: list[list[_Arc | None]] = []
        for b in begins[k]:
            head, row = _hash(line.folds[b + 1], END_BUCKETS) if b < last else 0, []
            for e, tail in zip(ends[k], tails, strict=True):
                if b >= e:
                    row.append(None)
                    continue
                v = _hash("".join(pre[b + 1 : e]) + line.folds[e], buckets)
                row.append((w.shape[v] + END_WEIGHT * w.first[head] * w.last[tail], (v, buckets + head, buckets + END_BUCKETS + tail)))
            rows.append(row)
        arcs.append(rows)
    return cuts, arcs, [[_hash(_kind(line.gaps[e]), GAP_BUCKETS) for e in c] for c in cuts]


_CRC = np.array([zlib.crc32(bytes([i])) ^ zlib.crc32(b"\0") for i in range(256)], np.uint32)
_CRC_BACK = np.zeros(256, np.uint32)
_CRC_BACK[_CRC >> 24] = np.arange(256, dtype=np.uint32)


def _times(basis: np.ndarray, x: int) -> int:
    """The linear map whose values at the single bits are ``basis``."""
    return int(np.bitwise_xor.reduce(basis[[i for i in range(32) if x >> i & 1]], initial=np.uint32(0)))


class _Walk:
    """A lattice whose arcs are weighed end by end, in memory that grows with the cuts, not the arcs.

    The CRC of a part is that of the text up to its end less that of the text before it, moved on by the part's length. The latter are kept
    moved back to the line's start, so one map for each end gives the hashes of all parts that end there.
    """

    def __init__(self, line: _Line, w: Weights, buckets: int):
        self.w, self.buckets, self.cuts, last = w, buckets, line.cuts(), len(line.folds) - 1
        self.shape, first, lasts, gap = np.array(w.shape), np.array(w.first), np.array(w.last), np.array(w.gap)
        self.ends, begins = [*self.cuts, [last]], [[-1], *self.cuts]
        starts, stops = {b + 1 for x in begins for b in x}, {e for x in self.ends for e in x}
        on = back = np.uint32(1) << np.arange(32, dtype=np.uint32)
        crc, before, self.whole, self.maps = 0, {}, {}, {}
        for i, (f, p) in enumerate(zip(line.folds, _prefix(line), strict=True)):
            fold, rest = f.encode(), p[len(f) :].encode()
            if i in starts:
                before[i] = _times(back, crc)
            for part in (fold, rest):
                crc = zlib.crc32(part, crc)
                for _ in part:
                    on, k = (on >> 8) ^ _CRC[on & 255], _CRC_BACK[back >> 24]
                    back = ((back ^ _CRC[k]) << 8) | k
                if part is fold and i in stops:
                    self.whole[i], self.maps[i] = crc, on
        self.bytes = [[(np.array([before[b + 1] for b in x], np.uint32) >> s & 255).astype(np.intp) for s in (0, 8, 16, 24)] for x in begins]
        self.heads = [np.array([_hash(line.folds[b + 1], END_BUCKETS) for b in x]) for x in begins]
        self.tails = [np.array([_hash(line.folds[e], END_BUCKETS) for e in x]) for x in self.ends]
        self.gaps = [np.array([_hash(_kind(line.gaps[e]), GAP_BUCKETS) for e in x]) for x in self.cuts]
        self.first, self.last = [first[h] for h in self.heads], [END_WEIGHT * lasts[t] for t in self.tails]
        self.odds = [*(gap[g] for g in self.gaps), np.ones(1)]

    def arcs(self, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each end of segment k: its place, and of the arcs from all begins the shape's bucket and the weight."""
        for j, e in enumerate(self.ends[k]):
            table = np.zeros((4, 256), np.uint32)
            for i, m in enumerate(self.maps[e].reshape(4, 8).T):
                table[:, 1 << i : 2 << i] = table[:, : 1 << i] ^ m[:, None]
            v = np.full(len(self.heads[k]), self.whole[e], np.uint32)
            for part, at in zip(table, self.bytes[k], strict=True):
                v ^= part[at]
            v = (v % np.uint32(self.buckets)).astype(np.intp)
            yield j, v, self.shape[v] + self.first[k] * self.last[k][j]


def _is_wide(line: _Line) -> bool:
    n = [1, *map(len, line.cuts()), 1]
    return any(a * b > DENSE for a, b in zip(n, n[1:], strict=False))


def _expect_wide(line: _Line, n: float, w: Weights, buckets: int, into: dict[int, float]) -> None:
    """What ``_expect`` adds but for the gaps seen."""
    walk, gap_at = _Walk(line, w, buckets), buckets + 2 * END_BUCKETS
    fore, scales, counts = [np.ones(1)], [], np.zeros(gap_at + GAP_BUCKETS)
    for k, odds in enumerate(walk.odds):
        f = np.zeros(len(odds))
        for j, _, x in walk.arcs(k):
            f[j] = fore[-1] @ x * odds[j]
        scales.append(f.sum() or 1.0)
        fore.append(f / scales[-1])
    back = np.ones(1)
    for k in range(len(walk.odds) - 1, -1, -1):
        new, gone, by_head = np.zeros(len(fore[k])), np.zeros(len(back)), np.zeros(len(fore[k]))
        for j, v, x in walk.arcs(k):
            p = x * (walk.odds[k][j] * back[j] / scales[k])
            c = fore[k] * p * n
            new += p
            by_head += c
            gone[j] = c.sum()
            np.add.at(counts, v, c)
        np.add.at(counts, buckets + walk.heads[k], by_head)
        np.add.at(counts, buckets + END_BUCKETS + walk.tails[k], gone)
        if k < len(walk.gaps):
            np.add.at(counts, gap_at + walk.gaps[k], gone)
        back = new
    for at in np.flatnonzero(counts).tolist():
        into[at] += float(counts[at])


def _best_wide(line: _Line, w: Weights, buckets: int) -> list[int]:
    """The last atom of each value, as ``_best`` finds them."""
    walk = _Walk(line, w, buckets)
    score, trace = np.ones(1), []
    for k, odds in enumerate(walk.odds):
        new, at = np.zeros(len(odds)), []
        for j, _, x in walk.arcs(k):
            x = score * x
            at.append(int(x.argmax()))
            new[j] = x[at[-1]] * odds[j]
        score, trace = new / (new.max() or 1.0), [*trace, at]
    e, ends = 0, [walk.ends[-1][0]]
    for k in range(len(trace) - 1, 0, -1):
        e = trace[k][e]
        ends.append(walk.cuts[k - 1][e])
    return ends[::-1]


def _expect(line: _Line, n: float, w: Weights, buckets: int, into: dict[int, float]) -> None:
    """Forward-backward; adds the expected counts to the buckets."""
    gap_at = buckets + 2 * END_BUCKETS
    for g in line.gaps:
        if g and _SIGN.search(g):
            into[gap_at + GAP_BUCKETS + _hash(_kind(g), GAP_BUCKETS)] += n
    if _is_wide(line):
        return _expect_wide(line, n, w, buckets, into)
    _, arcs, gaps = _lattice(line, w, buckets)
    fore, scales, weighs = [[1.0]], [], []
    for k, arc in enumerate(arcs):
        by = [w.gap[g] for g in gaps[k]] if k < len(gaps) else [1.0]
        weigh = [[a[0] * p if a else 0.0 for a, p in zip(row, by, strict=True)] for row in arc]
        f = [sum(x * row[e] for x, row in zip(fore[-1], weigh, strict=True)) for e in range(len(by))]
        s = sum(f) or 1.0
        scales.append(s)
        weighs.append(weigh)
        fore.append([x / s for x in f])
    back = [1.0]
    for k in range(len(arcs) - 1, -1, -1):
        new, gone = [0.0] * len(arcs[k]), [0.0] * len(back)
        for b, row in enumerate(weighs[k]):
            for e, x in enumerate(row):
                if x:
                    p = x * back[e] / scales[k]
                    new[b] += p
                    c = fore[k][b] * p * n
                    for at in arcs[k][b][e][1]:
                        into[at] += c
                    gone[e] += c
        if k < len(gaps):
            for g, c in zip(gaps[k], gone, strict=True):
                into[gap_at + g] += c
        back = new


def _best(line: _Line, w: Weights, buckets: int) -> list[tuple[int, int]]:
    """Viterbi: the likeliest values as (first atom, last atom); of equal ones the earliest cuts."""
    if len(line.anchors) < 2:
        return [(0, len(line.folds) - 1)]
    if _is_wide(line):
        ends = _best_wide(line, w, buckets)
        return list(zip([0, *(x + 1 for x in ends[:-1])], ends, strict=True))
    cuts, arcs, gaps = _lattice(line, w, buckets)
    score, trace = [1.0], []
    for k, arc in enumerate(arcs):
        new, at = [], []
        for e in range(len(arc[0])):
            top, arg = 0.0, 0
            for b, row in enumerate(arc):
                if row[e] and score[b] * row[e][0] > top:
                    top, arg = score[b] * row[e][0], b
            new.append(top * w.gap[gaps[k][e]] if k < len(gaps) else top)
            at.append(arg)
        most = max(new) or 1.0  # only the ratios matter; scaled so that long lines don't underflow
        score, trace = [x / most for x in new], [*trace, at]
    e, ends = 0, [len(line.folds) - 1]
    for k in range(len(arcs) - 1, 0, -1):
        e = trace[k][e]
        ends.append(cuts[k - 1][e])
    ends.reverse()
    return list(zip([0, *(x + 1 for x in ends[:-1])], ends, strict=True))


# --- lines of which no sign tells how many values they hold ---------------------------------------

#: Probability that a value ends after an atom, and the weight of the base probability against the shapes seen.
STOP, BASE_WEIGHT = 0.5, 1.0


class _Free:
    """All segmentations of a line: arcs from the start of a value to its possible ends.

    An arc's weight is the value's probability, times the odds of the gap after it. A value grows until its base probability is zero in
    floating point: with a separator within and no base, no round can ever have counted it.
    """

    def __init__(self, line: _Line, w: Weights, buckets: int):
        self.line, last = line, len(line.folds) - 1
        self.ends = [i for i in range(last) if _SIGN.search(line.gaps[i])] + [last]
        pre = _prefix(line)
        self.atoms = [_hash(f, END_BUCKETS) for f in line.folds]
        self.gaps = [_hash(_kind(line.gaps[e]), GAP_BUCKETS) for e in self.ends]
        odds = [w.gap[g] for g in self.gaps[:-1]] + [1.0]
        begins = [0, *(e + 1 for e in self.ends[:-1])]
        self.arcs: list[list[tuple[int, float, int]]] = []
        for k, b in enumerate(begins):
            out, crc, base, i = [], 0, STOP, b
            for j in range(k, len(self.ends)):
                e = self.ends[j]
                while i <= e:
                    base *= w.first[self.atoms[i]] * ((1 - STOP) if i > b else 1.0)
                    if i < e:
                        crc = zlib.crc32(pre[i].encode("utf-8", "surrogatepass"), crc)
                    i += 1
                v = zlib.crc32(line.folds[e].encode("utf-8", "surrogatepass"), crc) % buckets
                if j > k and base == 0.0:
                    break
                out.append((j, (w.shape[v] + BASE_WEIGHT * base + 1e-300) * odds[j], v))
                crc = zlib.crc32(pre[e].encode("utf-8", "surrogatepass"), crc)
            self.arcs.append(out)


def _expect_free(line: _Line, w: Weights, buckets: int, into: dict[int, float]) -> None:
    """Forward-backward over all segmentations, in logs; adds the expected counts of shapes, cuts and gaps seen, and the atoms. Equal lines count once."""
    f, atom_at, gap_at = _Free(line, w, buckets), buckets, buckets + 2 * END_BUCKETS
    for a in f.atoms:
        into[atom_at + a] += 1.0
    for g in f.gaps[:-1]:
        into[gap_at + GAP_BUCKETS + g] += 1.0
    m = len(f.ends)
    lf = [-np.inf] * (m + 1)
    lf[0] = 0.0
    for k in range(m):
        for j, x, _ in f.arcs[k]:
            lf[j + 1] = np.logaddexp(lf[j + 1], lf[k] + np.log(x))
    lb = [-np.inf] * (m + 1)
    lb[m] = 0.0
    for k in range(m - 1, -1, -1):
        for j, x, v in f.arcs[k]:
            lb[k] = np.logaddexp(lb[k], np.log(x) + lb[j + 1])
    for k in range(m):
        for j, x, v in f.arcs[k]:
            c = float(np.exp(lf[k] + np.log(x) + lb[j + 1] - lf[m]))
            if c:
                into[v] += c
                if j < m - 1:
                    into[gap_at + f.gaps[j]] += c


def _best_free(line: _Line, w: Weights, buckets: int) -> list[tuple[int, int]]:
    """Viterbi over all segmentations; of equal ones the longest first values."""
    f = _Free(line, w, buckets)
    m = len(f.ends)
    best, to = [-np.inf] * m + [0.0], [0] * m
    for k in range(m - 1, -1, -1):
        for j, x, _ in f.arcs[k]:
            s = float(np.log(x)) + best[j + 1]
            if s >= best[k]:
                best[k], to[k] = s, j
    out, k = [], 0
    while k < m:
        out.append((0 if k == 0 else f.ends[k - 1] + 1, f.ends[to[k]]))
        k = to[k] + 1
    return out


def entry_text(line: _Line, i: int, j: int) -> str:
    """A value's text: outer quotes gone if they hold all of it, doubled quotes single, blanks single."""
    t = line.text[line.spans[i][0] : line.spans[j][1]]
    if i == j and len(t) > 1 and t[0] in '"“' and t[-1] in '"”':
        t = t[1:-1]
    return _BLANK.sub(" ", t.replace('""', '"')).strip()


def learn(df: DataFrame, col: str, how: Packing) -> Weights:
    """Expectation-maximisation over the whole column.

    Lines with equal lattices are counted together first. The first round looks at lines of one value alone (of one anchor, or without separators), where
    there is nothing to guess; the rest start from what it saw. Each round is one job whose result
    has at most one row per bucket.
    """
    anchor, buckets = re.compile(how.anchor) if how.anchor else None, how.buckets
    free = anchor is None

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n: Counter[tuple[str, tuple[int, ...]]] = Counter()
            for t in b.column(0).to_pylist():
                line = _Line(t, anchor)
                if line.folds and (free or line.anchors):
                    n[line.shape(), tuple(line.anchors)] += 1
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in n], pa.string()), pa.array([list(a) for _, a in n], pa.list_(pa.int32())), pa.array(n.values(), pa.int64())], ["shape", "anchors", "n"])

    seen = df.select(col).where(F.col(col).isNotNull()).mapInArrow(shapes, "shape string, anchors array<int>, n long")
    seen = seen.groupBy("shape", "anchors").agg(F.sum("n").alias("n"))
    # few bytes but much work in each round: dealt out over files, of which a task reads one or two
    seen = materialize(seen.repartition(slots(df.sparkSession)), "shapes")
    size = buckets + 2 * END_BUCKETS + 2 * GAP_BUCKETS
    w = Weights.of(np.zeros(size), buckets, free)
    for k in range(how.rounds):
        alone = ~F.col("shape").rlike(f"{GAP_BEGIN}[^{ATOM_END}]*(?:[,;|/&\\[\\]\\t\\n\\r]|and)") if free else F.size("anchors") == 1
        lines = seen.where(alone) if k == 0 else seen

        def expect(batches: Iterator[pa.RecordBatch], w: Weights = w) -> Iterator[pa.RecordBatch]:
            got: dict[int, float] = defaultdict(float)
            for b in batches:
                for shape, a, n in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                    line = _Folded(shape, a)
                    if free:
                        _expect_free(line, w, buckets, got)
                    else:
                        _expect(line, n, w, buckets, got)
            yield pa.RecordBatch.from_arrays([pa.array(got.keys(), pa.int32()), pa.array(got.values(), pa.float64())], ["k", "c"])

        counts = np.zeros(size)
        for at, c in lines.mapInArrow(expect, "k int, c double").groupBy("k").agg(F.sum("c")).collect():
            counts[at] = c
        if counts.any():
            w = Weights.of(counts, buckets, free)
    release(seen)
    return w


def split_packed(df: DataFrame, key: str, col: str, how: Packing) -> DataFrame:
    """One row (key, pos, entry) per value of ``col``; pos counts from 1 in the order of the line.

    Null, empty and blank fields, and fields of separators only, give no row. Where there are anchors, a field without
    any gives one row with its whole text. Equal values of a line all come out, each
    with its own position. An unbalanced quote or bracket is an ordinary sign. Other columns,
    whatever their names, don't matter.
    """
    w = learn(df, col, how)
    anchor, buckets = re.compile(how.anchor) if how.anchor else None, how.buckets
    best = _best if anchor else _best_free

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at: list[int] = []
            pos: list[int] = []
            out: list[str] = []
            for r, t in enumerate(b.column(1).to_pylist()):
                line = _Line(t, anchor)
                if not line.folds:
                    continue
                texts = [x for x in (entry_text(line, i, j) for i, j in best(line, w, buckets)) if x]
                at += [r] * len(texts)
                pos += range(1, len(texts) + 1)
                out += texts
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(pos, pa.int64()), pa.array(out, pa.string())], [key, "pos", "entry"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, col).where(F.col(col).isNotNull()).mapInArrow(cut, f"`{key}` {kind}, pos long, entry string")


#: Laws that an enactment clause may name (fixed values).
LAWS = ("L Sp", "L", "RL", "HRS", "CC", "PC")
LAW_ANCHOR = r"(?<!\w)(?:" + "|".join(x.replace(" ", r"\s+") for x in LAWS) + r")\s+(?=[§\d])"


def enactment_clauses(parsed: DataFrame) -> DataFrame:
    """Clauses of ``history``, each naming one law."""
    return split_packed(parsed, "record_id", "history", Packing(LAW_ANCHOR))
