"""Filling windows of fixed capacity with texts: hierarchical multi-length packing.

Texts are routed to the smallest context size that holds them. Sizes are whole numbers up to
the largest capacity, so what there is to pack is a histogram with at most that many entries,
whatever the number of texts: it is packed on the driver, longest tier first, best fit
decreasing; gaps of long windows are filled from shorter tiers. The result is a
list of patterns (sizes side by side, and how many windows look so), of bounded size too. Each text
gets its place by its rank among the texts of its size, without any sort of all texts.
"""

from __future__ import annotations

import base64
import bisect
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statloom.runtime import materialize, slots


def token_counts(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens) by a byte-level vocabulary in rank form, a file that every task can open; null and empty texts have 0.

    pattern: what the vocabulary's texts are split by before its merges; it comes with the vocabulary.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        enc = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long")


@dataclass
class Pattern:
    """Windows of one look: the sizes in them from left to right, and how many such windows there are."""

    capacity: int
    sizes: list[int]
    count: int

    @property
    def used(self) -> int:
        return sum(self.sizes)


class _Tier:
    """Windows of one capacity that are being filled: patterns by the room left in them."""

    def __init__(self, capacity: int):
        self.capacity, self.open, self.rooms = capacity, defaultdict(list), []

    def put(self, sizes: list[int], count: int, room: int) -> None:
        if not self.open[room]:
            bisect.insort(self.rooms, room)
        self.open[room].append(Pattern(self.capacity, sizes, count))

    def place(self, size: int, n: int, new: bool) -> int:
        """Put n texts where the least room is left over, in new windows only if allowed; the number that found no place."""
        while n:
            at = bisect.bisect_left(self.rooms, size)
            if at == len(self.rooms):
                if not new:
                    break
                fit = min(self.capacity // size, n)
                self.put([size] * fit, n // fit, self.capacity - size * fit)
                n %= fit
                continue
            room = self.rooms[at]
            p = self.open[room].pop()
            if not self.open[room]:
                self.rooms.pop(at)
            fit = min(room // size, n)
            take = min(p.count, n // fit)
            if take < p.count:
                self.put(p.sizes, p.count - take, room)
            self.put(p.sizes + [size] * fit, take, room - size * fit)
            n -= take * fit
        return n

    def patterns(self) -> list[Pattern]:
        return [p for ps in self.open.values() for p in ps]


def pack_histogram(counts: dict[int, int], capacities: Sequence[int], spare: float = 0.02) -> list[Pattern]:
    """Patterns that hold each size as often as it occurs.

    Tiers from the largest capacity down: the tier's own sizes are placed best fit decreasing, then shorter
    sizes fill the gaps, the longest first. What has gone into a gap is not packed again. Last, from the
    smallest tier up, texts of windows with more than ``spare`` of their room unused move to windows of the next
    tier, where they fit together better.
    """
    left = Counter({s: n for s, n in counts.items() if n > 0 and s > 0})
    caps = sorted(set(capacities))
    done: dict[int, list[Pattern]] = {}
    for k in range(len(caps) - 1, -1, -1):
        least, tier = caps[k - 1] if k else 0, _Tier(caps[k])
        for size in sorted((s for s in left if s > least), reverse=True):
            tier.place(size, left.pop(size), True)
        for size in sorted(left, reverse=True):
            left[size] = tier.place(size, left[size], False)
            if not left[size]:
                del left[size]
        done[caps[k]] = tier.patterns()
    for low, high in zip(caps, caps[1:], strict=False):
        loose = [p for p in done[low] if p.used < (1 - spare) * low]
        moved: Counter[int] = Counter()
        for p in loose:
            for size in p.sizes:
                moved[size] += p.count
        done[low] = [p for p in done[low] if p.used >= (1 - spare) * low]
        tier = _Tier(high)
        for p in done[high]:
            tier.put(p.sizes, p.count, high - p.used)
        for size in sorted(moved, reverse=True):
            tier.place(size, moved[size], True)
        done[high] = tier.patterns()
    return [p for ps in done.values() for p in ps]


def _placed(patterns: list[Pattern], per_step: int) -> tuple[list[tuple], dict[int, tuple[int, int]]]:
    """Rows (size, rank_from, rank_to, capacity, window_from, times, slot) and (windows, step groups) per capacity.

    Windows of a capacity are numbered from 0, the fullest first.
    """
    rank: Counter[int] = Counter()
    rows, start = [], Counter()
    for p in sorted(patterns, key=lambda p: (p.capacity, -p.used, p.sizes)):
        offset = 0
        for size, times in Counter(p.sizes).items():
            rows.append((size, rank[size], rank[size] + times * p.count, p.capacity, start[p.capacity], times, offset))
            rank[size] += times * p.count
            offset += times * size
        start[p.capacity] += p.count
    return rows, {c: (n, max(1, -(-n // per_step))) for c, n in start.items()}


def _ranked(pieces: DataFrame) -> DataFrame:
    """Adds ``rank`` from 0 among the pieces of equal size; a size that very many share is split by salt."""
    salt = slots(pieces.sparkSession, 8)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salt)))
    before = salted.groupBy("size", "salt").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select("size", "salt", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("size", "salt").orderBy("doc_id", "piece")) - 1
    return salted.withColumn("within", within).join(before, ["size", "salt"]).withColumn("rank", F.col("before") + F.col("within")).drop("salt", "within", "before")


def _looked_up(ranked: DataFrame, rows: list[tuple]) -> DataFrame:
    """(doc_id, piece, size, capacity, window_no, start) by binary search for (size, rank) in the places.

    The places are as many as the patterns have different sizes: their number depends on the capacities, not on the texts.
    """
    size, lo, _, cap, window, times, slot = (np.array(c, np.int64) for c in zip(*sorted(rows), strict=True)) if rows else [np.empty(0, np.int64)] * 7
    first = {int(s): int(k) for k, s in reversed(list(enumerate(size)))}
    last = {int(s): k + 1 for k, s in enumerate(size)}
    kind = dict(ranked.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s, rank = b.column("size").to_numpy(), b.column("rank").to_numpy()
            at = np.empty(len(s), np.int64)
            for v in np.unique(s):
                own = s == v
                f = first[int(v)]
                at[own] = f + np.searchsorted(lo[f : last[int(v)]], rank[own], "right") - 1
            k = rank - lo[at]
            cols = [pa.array(x) for x in (s.astype(np.int64), cap[at], window[at] + k // times[at], slot[at] + k % times[at] * s)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("piece"), *cols], ["doc_id", "piece", "size", "capacity", "window_no", "start"])

    return ranked.select("doc_id", "piece", "size", "rank").mapInArrow(run, f"doc_id {kind}, piece long, size long, capacity long, window_no long, start long")


def pack_windows(sizes: DataFrame, capacities: Sequence[int], per_step: int = 32) -> DataFrame:
    """(doc_id, piece, capacity, window_no, start, n_tokens, step_group): each text's place.

    sizes: (doc_id unique, n_tokens). A text longer than the largest capacity is cut into full windows and a rest;
    no other is split. Texts of 0 tokens stand at the start of window 0 of the smallest capacity. Windows of a
    capacity are dealt to step groups of about ``per_step`` windows in turns there and back, fullest first, so that
    groups hold about equally many tokens. Repeated sizes are ordered by doc_id within hash groups. An empty table gives no row.
    """
    caps = sorted({int(c) for c in capacities if c and c > 0})
    if not caps:
        raise ValueError("no capacity")
    top = caps[-1]
    n = F.coalesce(F.col("n_tokens"), F.lit(0))
    cut = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(n / top) - 1).cast("int")), lambda i: F.struct(i.cast("long").alias("piece"), F.least(n - i * top, F.lit(top)).cast("int").alias("size")))
    pieces = sizes.select("doc_id", F.explode(cut).alias("p")).select("doc_id", "p.piece", "p.size")
    counts = {r[0]: r[1] for r in pieces.groupBy("size").count().collect()}  # at most one row per size up to the largest capacity
    rows, windows = _placed(pack_histogram(counts, caps), per_step)
    if 0 in counts:
        rows.append((0, 0, counts[0], caps[0], 0, counts[0], 0))
    at = _looked_up(_ranked(pieces), rows)
    groups = F.create_map(*(F.lit(x) for c, (_, g) in sorted(windows.items()) for x in (c, g))) if windows else F.create_map(F.lit(0), F.lit(1))
    g = F.coalesce(groups[F.col("capacity").cast("int")], F.lit(1)).cast("long")
    turn = F.col("window_no") % (2 * g)
    step = F.when(turn < g, turn).otherwise(2 * g - 1 - turn)
    return at.select("doc_id", "piece", "capacity", "window_no", "start", F.col("size").alias("n_tokens"), step.alias("step_group"))


def measured(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Token counts, written once."""
    return materialize(token_counts(docs, vocabulary, pattern), "tokens")
