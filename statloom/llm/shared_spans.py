"""Long exact spans shared between records: seed by winnowed anchors, extend both ways.

Of every ``length`` consecutive characters at least one ``gram`` is kept as an anchor (winnowing,
window ``length - gram + 1``), chosen by its hash alone. Two texts with a span of ``length``
characters in common therefore have an anchor in common inside it. Anchors that only one text
has are dropped; the others are joined, one candidate per pair of texts and diagonal, and each
candidate is extended on the texts themselves in both directions as far as they agree.

Equal texts are one class, which takes part once. Anchors of very many classes are not joined
as they are: their texts' surroundings of nearly ``length`` characters, at fixed steps to the left, take
their place as keys, so that such a group yields pairs only where nearly the whole span agrees.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statloom.runtime import materialize


@dataclass(frozen=True)
class Spans:
    """length: shortest span in code points. hot: rows of an anchor from which it is refined."""

    length: int = 400
    gram: int = 200
    step: int = 25
    hot: int = 200
    chunk: int = 1 << 19

    @property
    def window(self) -> int:
        return self.length - self.gram + 1


_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    size = 1 << (n - 1).bit_length()
    if size not in _powers:
        _powers.clear()
        _powers[size] = (np.cumprod(np.full(size, _BASE, np.uint64)), np.cumprod(np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)))
    return _powers[size]


def _mix(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(29)
    return h


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(x: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of each ``gram`` consecutive code points; equal grams have equal hashes."""
    up, down = _power_tables(len(x))
    sums = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x * up[: len(x)], out=sums[1:])
    return _mix((sums[gram:] - sums[:-gram]) * down[: len(x) - gram + 1])


def _sliding(a: np.ndarray, w: int, f: np.ufunc) -> np.ndarray:
    """f over each ``w`` consecutive elements, by block prefixes and suffixes."""
    n = len(a) - w + 1
    full = np.concatenate([a, np.full(-len(a) % w, a[-1], a.dtype)]).reshape(-1, w)
    before = f.accumulate(full, axis=1).ravel()
    after = np.ascontiguousarray(f.accumulate(full[:, ::-1], axis=1)[:, ::-1]).ravel()
    return f(after[:n], before[w - 1 : w - 1 + n])


def anchors(x: np.ndarray, owner: np.ndarray, how: Spans, spaced: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors in texts that lie one after the other.

    owner: number of each code point's text. An anchor is the smallest hash of some window that lies in
    one text. In a run of equal neighbouring hashes only the ends are kept, or if ``spaced`` some between as well, so that every stretch of ``length`` still has one.
    """
    w = how.window
    if len(x) < how.length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = gram_hashes(x, how.gram)
    low = _sliding(h, w, np.minimum)
    low[owner[: len(low)] != owner[how.length - 1 :]] = 0
    pad = np.zeros(w - 1, np.uint64)
    top = _sliding(np.concatenate([pad, low, pad]), w, np.maximum)
    keep = (top == h) & (h != 0)
    inner = np.zeros(len(h), bool)
    inner[1:-1] = (h[1:-1] == h[:-2]) & (h[1:-1] == h[2:]) & keep[:-2] & keep[2:]
    if spaced:
        inner[:: how.length - how.gram] = False
    at = np.flatnonzero(keep & ~inner)
    return at, h[at]


def _pieces(texts: list[str], how: Spans) -> Iterator[tuple[list[tuple[int, int]], np.ndarray, np.ndarray]]:
    """Groups of (text number, offset) with their code points; long texts in overlapping parts."""
    group: list[tuple[int, int]] = []
    parts: list[np.ndarray] = []
    size = 0

    def flush() -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray]:
        return group, np.concatenate(parts).astype(np.uint64), np.repeat(np.arange(len(parts)), [len(p) for p in parts])

    for i, t in enumerate(texts):
        if len(t) < how.length:
            continue
        x = codes(t)
        for o in range(0, max(1, len(x) - how.length + 1), how.chunk):
            part = x[o : o + how.chunk + how.length - 1]
            if size and size + len(part) > 2 * how.chunk:
                yield flush()
                group, parts, size = [], [], 0
            group.append((i, o))
            parts.append(part)
            size += len(part)
    if parts:
        yield flush()


def anchor_rows(docs: DataFrame, how: Spans, spaced: bool = False) -> DataFrame:
    """(h, cls, pos): anchors of the texts, those of equal texts once in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            cls, texts = [], []
            for c, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if c not in seen:
                    seen.add(c)
                    cls.append(c)
                    texts.append(t)
            of = np.array(cls, np.int64)
            for group, x, owner in _pieces(texts, how):
                at, h = anchors(x, owner, how, spaced)
                own = owner[at]
                start = np.searchsorted(owner, np.arange(len(group)))
                pos = at - start[own] + np.array([o for _, o in group], np.int64)[own]
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(of[np.array([i for i, _ in group], np.int64)[own]]), pa.array(pos)], ["h", "cls", "pos"])

    return docs.select("cls", "text").where(F.length("text") >= how.length).mapInArrow(run, "h long, cls long, pos long")


def _refined(rows: DataFrame, texts: DataFrame, how: Spans) -> DataFrame:
    """Hot anchors with longer keys: the text around them, ``step`` characters further left each time.

    A shared span of ``length`` around an anchor holds at least one of these surroundings whole.
    """
    size = how.length - how.step

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys: list[int] = []
            cls: list[int] = []
            pos: list[int] = []
            for h, c, p, t in zip(*(b.column(n).to_pylist() for n in ("h", "cls", "pos", "text")), strict=True):
                for left in range(0, how.length - how.gram, how.step):
                    if left <= p and p - left + size <= len(t):
                        x = codes(t[p - left : p - left + size]).astype(np.uint64)
                        keys.append(hash((h, left, int(gram_hashes(x, size)[0]))))
                        cls.append(c)
                        pos.append(p)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(cls, pa.int64()), pa.array(pos, pa.int64())], ["h", "cls", "pos"])

    return rows.join(texts, "cls").select("h", "cls", "pos", "text").mapInArrow(run, "h long, cls long, pos long")


def _agree(a: str, i: int, b: str, j: int) -> int:
    """Number of equal characters from a[i:] and b[j:] on."""
    n, step = 0, 256
    most = min(len(a) - i, len(b) - j)
    while n < most:
        k = min(step, most - n)
        if a[i + n : i + n + k] == b[j + n : j + n + k]:
            n += k
            step *= 2
        elif k == 1:
            break
        else:
            step = k // 2
            most = min(most, n + k)
    return n


def _agree_back(a: str, i: int, b: str, j: int) -> int:
    """Number of equal characters that end before a[i] and b[j]."""
    n, step = 0, 256
    most = min(i, j)
    while n < most:
        k = min(step, most - n)
        if a[i - n - k : i - n] == b[j - n - k : j - n]:
            n += k
            step *= 2
        elif k == 1:
            break
        else:
            step = k // 2
            most = min(most, n + k)
    return n


def with_class(docs: DataFrame) -> DataFrame:
    """Adds ``cls``: a 64-bit hash that equal texts share."""
    return docs.where(F.col("text").isNotNull()).select("doc_id", "text", F.xxhash64("text").alias("cls"))


def shared_repeats(docs: DataFrame, how: Spans = Spans()) -> DataFrame:
    """(cls_a, cls_b, start_a, start_b, n): maximal repeats of at least ``length`` code points.

    Between different texts, each with cls_a < cls_b. Nulls and texts shorter than ``length`` share
    nothing. A repeat comes out once, whatever number of anchors lie in it.
    """
    d = with_class(docs)
    all_ = materialize(anchor_rows(d, how).distinct(), "anchors")
    shared = all_.groupBy("h").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi"), F.count(F.lit(1)).alias("rows")).where("lo <> hi").select("h", "rows")
    seeds = materialize(all_.join(shared, "h"), "seeds")
    needed = seeds.select("cls").distinct()
    first = d.select("doc_id", "cls").join(needed, "cls", "left_semi").groupBy("cls").agg(F.min("doc_id").alias("doc_id"))
    texts = materialize(docs.select("doc_id", "text").join(first, "doc_id").select("cls", "text"), "texts")
    keyed = seeds.where(F.col("rows") <= how.hot).drop("rows").unionByName(_refined(seeds.where(F.col("rows") > how.hot).drop("rows"), texts, how))
    a, b = (keyed.select("h", F.col("cls").alias(f"cls_{s}"), F.col("pos").alias(f"pos_{s}")) for s in "ab")
    pairs = a.join(b, "h").where("cls_a < cls_b").groupBy("cls_a", "cls_b", (F.col("pos_a") - F.col("pos_b")).alias("lead")).agg(F.collect_set("pos_a").alias("at"))
    pairs = pairs.groupBy("cls_a", "cls_b").agg(F.collect_list(F.struct("lead", "at")).alias("ways"))
    t = [texts.select(F.col("cls").alias(f"cls_{s}"), F.col("text").alias(f"text_{s}")) for s in "ab"]

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            out: list[tuple[int, int, int, int, int]] = []
            for ca, cb, ways, ta, tb in zip(*(x.column(n).to_pylist() for n in ("cls_a", "cls_b", "ways", "text_a", "text_b")), strict=True):
                for way in ways:
                    end = -1
                    for i in sorted(way["at"]):
                        if i < end:
                            continue
                        j = i - way["lead"]
                        left, right = _agree_back(ta, i, tb, j), _agree(ta, i, tb, j)
                        end = i + right
                        if left + right >= how.length:
                            out.append((ca, cb, i - left, j - left, left + right))
            cols = [pa.array([r[k] for r in out], pa.int64()) for k in range(5)]
            yield pa.RecordBatch.from_arrays(cols, ["cls_a", "cls_b", "start_a", "start_b", "n"])

    return pairs.join(t[0], "cls_a").join(t[1], "cls_b").select("cls_a", "cls_b", "ways", "text_a", "text_b").mapInArrow(extend, "cls_a long, cls_b long, start_a long, start_b long, n long").distinct()


def sharing_pairs(docs: DataFrame, how: Spans = Spans()) -> DataFrame:
    """(doc_id_a, doc_id_b), the smaller first: documents with a span in common, copies included."""
    repeats = shared_repeats(docs, how).select("cls_a", "cls_b").distinct()
    members = docs.where(F.length("text") >= how.length).select("doc_id", F.xxhash64("text").alias("cls"))
    a, b = (members.select(F.col("doc_id").alias(f"d{s}"), F.col("cls").alias(f"cls_{s}")) for s in "ab")
    across = repeats.join(a, "cls_a").join(b, "cls_b").select(F.least("da", "db").alias("doc_id_a"), F.greatest("da", "db").alias("doc_id_b"))
    within = a.join(b, a["cls_a"] == b["cls_b"]).where("da < db").select(F.col("da").alias("doc_id_a"), F.col("db").alias("doc_id_b"))
    return across.unionByName(within)


def _pieces_of(text: str, at: np.ndarray, how: Spans) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """(code points, offset, places) of the parts of a text that lie around sorted places, ``length`` and more on either side; a very long one in pieces."""
    for o in range(0, len(text), how.chunk):
        own = at[np.searchsorted(at, o) : np.searchsorted(at, o + how.chunk)]
        if len(own):
            low = max(0, int(own[0]) - how.length)
            yield codes(text[low : int(own[-1]) + how.length + how.step]).astype(np.uint64), low, own


class _Hashes:
    """Hashes of any stretch of a text; equal stretches have equal ones."""

    def __init__(self, x: np.ndarray):
        up, self.down = _power_tables(max(1, len(x)))
        self.sums = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(x * up[: len(x)], out=self.sums[1:])

    def of(self, start: np.ndarray, size: int) -> np.ndarray:
        return _mix((self.sums[start + size] - self.sums[start]) * self.down[start]).view(np.int64)


def _blocks(cls: int, at: list[int], text: str, how: Spans) -> Iterator[tuple]:
    """(cls, block, inner, outer) for each ``step`` of starts of stretches of ``length`` that hold an anchor: hashes of what all these have in common and of all that they reach over.

    ``block`` is the last of the starts. outer is None where the text ends before.
    """
    w = how.step
    p = np.array(sorted(at), np.int64)
    starts = np.unique(np.concatenate([p - k for k in range(0, how.length - how.gram + w, w)]))
    inner, outer = how.length - w + 1, how.length + w - 1
    starts = starts[(starts >= 0) & (starts + inner <= len(text))]
    for x, low, own in _pieces_of(text, starts, how):
        h, s = _Hashes(x), own - low
        keys, wide = h.of(s, inner), s - (w - 1)
        fits = (wide >= 0) & (s + how.length <= len(x))
        around = np.zeros(len(s), np.int64)
        around[fits] = h.of(wide[fits], outer)
        yield from zip([cls] * len(s), own.tolist(), keys.tolist(), [v if f else None for v, f in zip(around.tolist(), fits.tolist(), strict=True)], strict=True)


def _stretches(cls: int, at: list[int], text: str, how: Spans) -> Iterator[tuple]:
    """(cls, start, key) of all stretches of ``length`` of blocks."""
    p = np.array(sorted(at), np.int64)
    starts = np.unique(np.concatenate([p - k for k in range(how.step)]))
    starts = starts[(starts >= 0) & (starts + how.length <= len(text))]
    for x, low, own in _pieces_of(text, starts, how):
        yield from zip([cls] * len(own), own.tolist(), _Hashes(x).of(own - low, how.length).tolist(), strict=True)


def _each_text(df: DataFrame, make, columns: list[str], how: Spans) -> DataFrame:
    """Rows that ``make`` gives for each (cls, at, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c, at, t in zip(*(b.column(n).to_pylist() for n in ("cls", "at", "text")), strict=True):
                out = list(make(c, at, t, how))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(col, pa.int64()) for col in zip(*out, strict=True)], columns)

    return df.select("cls", "at", "text").mapInArrow(run, ", ".join(f"{c} long" for c in columns))


def shared_coverage(docs: DataFrame, how: Spans = Spans()) -> DataFrame:
    """One row per document: (doc_id, class_id, copies, n_chars, shared_chars).

    class_id is the smallest doc_id with that text, shared_chars the number of its characters in spans of at least ``length`` that stand
    elsewhere too: all of them where it has copies and at least ``length`` characters. Null texts have class_id = doc_id and zeros.

    No pair of texts is made, so the work grows with the texts alone, however many share a passage. Anchors that several classes have are the seeds, and
    each is extended both ways in blocks of ``step``: where several classes have what a block's stretches have in common, and all of
    these have the same around it, the block is shared as a whole; only else are its stretches compared one by one. Keys are counted before they meet, so
    a key of very many texts is no group anywhere.
    """
    d = with_class(docs)
    all_ = materialize(anchor_rows(d, how, True).distinct(), "anchors")
    several = lambda rows, key: rows.groupBy(key).agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo <> hi").select(key)
    seeds = materialize(all_.join(several(all_, "h"), "h", "left_semi").groupBy("cls").agg(F.collect_set("pos").alias("at")), "seeds")  # as many as a text holds
    first = d.select("doc_id", "cls").join(seeds.select("cls"), "cls", "left_semi").groupBy("cls").agg(F.min("doc_id").alias("doc_id"))
    texts = materialize(docs.select("doc_id", "text").join(first, "doc_id").select("cls", "text"), "texts")
    blocks = materialize(_each_text(seeds.join(texts, "cls"), _blocks, ["cls", "block", "inner", "outer"], how), "blocks")
    one = (F.min("outer") == F.max("outer")) & ~F.bool_or(F.col("outer").isNull())
    state = blocks.groupBy("inner").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi"), F.coalesce(one, F.lit(False)).alias("whole")).where("lo <> hi").select("inner", "whole")
    held = materialize(blocks.join(state, "inner").select("cls", "block", "whole"), "held")
    open_ = held.where("not whole").groupBy("cls").agg(F.collect_list("block").alias("at"))
    stretches = materialize(_each_text(open_.join(texts, "cls"), _stretches, ["cls", "start", "key"], how), "stretches")
    ends = stretches.join(several(stretches, "key"), "key", "left_semi").select("cls", "start", (F.col("start") + how.length).alias("end"))
    sides = held.where("whole").select("cls", (F.col("block") - (how.step - 1)).alias("start"), (F.col("block") + how.length).alias("end")).unionByName(ends)
    by = Window.partitionBy("cls").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)  # one text's
    part = F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("start"), F.coalesce(F.max("end").over(by), F.lit(0))))
    covered = sides.withColumn("new", part).groupBy("cls").agg(F.sum("new").alias("covered"))
    members = docs.select("doc_id", F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("cls"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"))
    classes = members.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("copies")).join(covered, "cls", "left")
    whole = (F.col("copies") > 1) & (F.col("n_chars") >= how.length)
    return members.join(classes, "cls", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("copies", F.lit(1)).alias("copies"), "n_chars", F.when(whole, F.col("n_chars")).otherwise(F.coalesce("covered", F.lit(0)).cast("long")).alias("shared_chars"))
