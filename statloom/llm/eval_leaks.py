"""Evaluation texts leaking into training text: BM25 over the test items, block-max WAND.

The test items are indexed; every passage of the training text is a query. A passage that
holds ``run`` consecutive words of an item holds all their terms, so its score for the item is at
least the smallest that any ``run`` words of the item reach. Each item's scores are divided by
that value: everything from 1 on is retrieved, and nothing that has to be found stays below. What
is retrieved is verified word by word.

Passages are the ``run``-word windows of a text; windows with a word that no item has, or whose
terms can't reach 1 for any item, are passed over by their summed upper bounds; neighbouring ones
that can are one query. Items are
split into blocks of bounded size; each block's index is sent to the tasks by itself.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """Runs of letters or digits after lower-casing."""
    return _WORD.findall((text or "").lower())


@dataclass(frozen=True)
class Leaks:
    """run: consecutive words that make a leak. block_items: items of one index, the bound of what is sent to a task."""

    run: int = 13
    block_items: int = 20_000
    postings_block: int = 64
    k1: float = 1.2
    b: float = 0.75


class Index:
    """Postings of a block of items: per term the items in order, their contributions, and the largest per block."""

    def __init__(self, items: list[tuple[int, str | None, str | None]], how: Leaks):
        self.how, self.ids, self.term = how, [], {}
        self.answers: list[list[str]] = []
        self.grams: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        self.texts: list[list[int]] = []
        for item, passage, answer in sorted(items, key=lambda x: x[0]):
            w = words(passage)
            if len(w) >= how.run:
                self.ids.append(item)
                self.texts.append([self.term.setdefault(x, len(self.term)) for x in w])
                self.answers.append(words(answer))
        n, df = len(self.ids), Counter(t for x in self.texts for t in set(x))
        mean = sum(map(len, self.texts)) / max(n, 1)
        lists: list[list[tuple[int, float]]] = [[] for _ in self.term]
        for i, x in enumerate(self.texts):
            norm = how.k1 * (1 - how.b + how.b * len(x) / mean)
            part = {t: math.log1p((n - df[t] + 0.5) / (df[t] + 0.5)) * f * (how.k1 + 1) / (f + norm) for t, f in Counter(x).items()}
            least = min(sum(part[t] for t in sorted(set(x[s : s + how.run]))) for s in range(len(x) - how.run + 1)) * (1 - 1e-9)
            for t, c in part.items():
                lists[t].append((i, c / least))
            for s in range(len(x) - how.run + 1):
                self.grams.setdefault(tuple(x[s : s + how.run]), []).append((i, s))
        self.items = [[i for i, _ in p] for p in lists]
        self.parts = [[c for _, c in p] for p in lists]
        size = how.postings_block
        self.tops = [[max(p[k : k + size]) for k in range(0, len(p), size)] for p in self.parts]
        self.most = np.array([max(p) for p in self.parts] or [0.0])

    def retrieve(self, query: list[int]) -> list[int]:
        """Items with a score of 1 or more for the terms, by block-max WAND."""
        size, end = self.how.postings_block, len(self.ids)
        at = {t: 0 for t in query}
        live = [(self.items[t][0], t) for t in query]
        found = []
        while live:
            live.sort()
            bound, pivot = 0.0, -1
            for k, (_, t) in enumerate(live):
                bound += self.most[t]
                if bound >= 1:
                    pivot = k
                    break
            if pivot < 0:
                break
            doc = live[pivot][0]
            while pivot + 1 < len(live) and live[pivot + 1][0] == doc:
                pivot += 1
            head = live[: pivot + 1]
            block, until = 0.0, live[pivot + 1][0] if pivot + 1 < len(live) else end
            for _, t in head:  # blocks that hold the pivot, whose ends bound how far a skip may go
                k = bisect_left(self.items[t], doc, at[t])
                if k < len(self.items[t]):
                    block += self.tops[t][k // size]
                    last = min((k // size + 1) * size, len(self.items[t])) - 1
                    until = min(until, self.items[t][last] + 1)
            to = doc
            if block < 1:
                to = max(until, doc + 1)
            elif live[0][0] == doc:
                if sum(self.parts[t][at[t]] for _, t in head) >= 1:
                    found.append(doc)
                to = doc + 1
            moved = []
            for d, t in head:
                if d < to:
                    at[t] = bisect_left(self.items[t], to, at[t])
                    if at[t] >= len(self.items[t]):
                        continue
                    d = self.items[t][at[t]]
                moved.append((d, t))
            live = moved + live[pivot + 1 :]
        return found

    def passages(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """(from, to) of the stretches of words whose windows can reach 1 for some item."""
        run = self.how.run
        if len(ids) < run or not self.ids:
            return
        unknown = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(ids < 0, out=unknown[1:])  # a word that no item has ends every run
        can = np.flatnonzero(unknown[run:] == unknown[:-run])
        bound = np.zeros(len(can))
        for k in range(run):  # each window summed by itself: the error doesn't grow with the text
            bound += self.most[ids[can + k]]
        can = can[bound >= 1 - 1e-6]
        if len(can):
            breaks = np.flatnonzero(np.diff(can) > 1)
            for s, e in zip(np.r_[0, breaks + 1], np.r_[breaks, len(can) - 1], strict=True):
                yield int(can[s]), int(can[e]) + run

    def leaks(self, text: list[str]) -> dict[int, tuple[int, bool]]:
        """Leaked item -> (longest run of its words in the text, whether the answer's words follow each other in it)."""
        run, get = self.how.run, self.term.get
        ids = np.array([get(w, -1) for w in text], np.int64)
        out: dict[int, int] = {}
        for s, e in self.passages(ids):
            stretch = ids[s:e].tolist()
            terms = set(stretch) - {-1}
            got = set(self.retrieve(sorted(terms)))
            if not got:
                continue
            ways: dict[tuple[int, int], tuple[int, int]] = {}  # by item and alignment: where the run goes on, its words
            for p in range(len(stretch) - run + 1):
                for i, q in self.grams.get(tuple(stretch[p : p + run]), ()):
                    if i in got:
                        at, n = ways.get((i, p - q), (-1, 0))
                        ways[i, p - q] = (p + 1, n := n + 1 if at == p else run)
                        out[i] = max(out.get(i, 0), n)
        spaced = " " + " ".join(text) + " "
        return {self.ids[i]: (n, bool(self.answers[i]) and " " + " ".join(self.answers[i]) + " " in spaced) for i, n in out.items()}


def leaked_items(docs: DataFrame, items: DataFrame, how: Leaks = Leaks()) -> DataFrame:
    """(item_id, doc_id, n_words, answer_found) of every document that holds ``run`` words of an item in a row.

    n_words: the longest run of the item's words in the document.
    answer_found: the document has the answer's words in a row; false if there is no answer. Items with fewer than ``run`` words
    can't leak. Null or empty passages and texts give no row; equal documents and equal items each give their own rows. No shuffle:
    documents stay where they were read.
    """
    blocks = max(1, -(-items.count() // how.block_items))
    kind = dict(items.dtypes)["item_id"], dict(docs.dtypes)["doc_id"]

    def scan(k: int) -> DataFrame:
        mine = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k) if blocks > 1 else items
        index = Index([tuple(r) for r in mine.select("item_id", "passage", "answer").where("item_id is not null").collect()], how)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = [(i, d, *x) for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for i, x in index.leaks(words(t)).items()]
                cols = list(zip(*rows, strict=True)) or [[]] * 4
                yield pa.RecordBatch.from_pydict(dict(zip(("item_id", "doc_id", "n_words", "answer_found"), cols, strict=True)), schema=pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("answer_found", pa.bool_())]))

        return docs.select(F.col("doc_id").cast("long"), "text").where("text is not null").mapInArrow(run, "item_id long, doc_id long, n_words long, answer_found boolean")

    out = reduce(DataFrame.unionByName, (scan(k) for k in range(blocks)))
    return out.withColumns({"item_id": F.col("item_id").cast(kind[0]), "doc_id": F.col("doc_id").cast(kind[1])})
