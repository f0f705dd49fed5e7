"""Near-duplicate records with small edits, by Golay-code fuzzy hashing.

A record's fingerprint has ``bands`` segments of 23 bits, each bit the lowest bit of another
minimum hash of its word shingles: at similarity s a bit differs with probability (1 - s) / 2. A segment with its
parity bit is a word of 24 bits; its keys are the indices of all codewords of the extended
Golay code within distance 4, one if it lies within 2 of a codeword, else six. Any two words with at most two differing bits of
the 23 have a key in common, and most with three or four. Wrong bits spread over the segments, so some segment
has few of them (pigeonhole) and one common key is enough. An index has 12 bits, which alone would join too many;
each key also holds ``anchors`` whole minimum hashes of its band.

What the keys join is first held against the whole fingerprints (their distance estimates the similarity,
with a margin of ``sigmas`` standard deviations), then verified on the shingles themselves.
Records with equal words are one class, which takes part once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.runtime import materialize, release

_WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Alike:
    """Similarity of the sets of ``words``-word runs from which two records are alike, for records of ``least_words`` words or more.

    bands and anchors: see the module. With the defaults a pair at 0.8 is missed with a probability of about 1e-7, one at 0.7 with about 3e-4.
    """

    threshold: float = 0.8
    words: int = 5
    least_words: int = 1
    bands: int = 24
    anchors: int = 2
    sigmas: float = 6.0
    seed: int = 20250101

    @property
    def bits(self) -> int:
        return 23 * self.bands

    @property
    def farthest(self) -> int:
        """Largest distance of fingerprints that is verified."""
        p = (1 - self.threshold) / 2
        return int(self.bits * p + self.sigmas * (self.bits * p * (1 - p)) ** 0.5) + 1


def words_of(title: str | None, body: str | None) -> list[str]:
    """Runs of letters or digits of the lower-cased title, a space, and the body; null counts as empty."""
    return _WORD.findall(f"{title or ''} {body or ''}".lower())


# --- the extended binary Golay code -----------------------------------------------------------

#: Generator polynomial of the cyclic code of length 23 (fixed value): x^11+x^10+x^6+x^5+x^4+x^2+1.
GOLAY_POLYNOMIAL = 0xC75


def _remainder(word: int) -> int:
    """Remainder of a 23-bit word by the polynomial: its syndrome of 11 bits."""
    for i in range(22, 10, -1):
        if word >> i & 1:
            word ^= GOLAY_POLYNOMIAL << (i - 11)
    return word


@cache
def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """(syndrome of each low 12 and each high 11 bits, errors of weight <= 4 by syndrome).

    Words of 24 bits with even parity: the 23 bits, and their parity as bit 23. Errors are of even weight too; a
    syndrome has one of weight 0 or 2, or six of weight 4. Unused places hold -1.
    """
    low, high = np.array([_remainder(x) for x in range(1 << 12)], np.int32), np.array([_remainder(x << 12) for x in range(1 << 11)], np.int32)
    single = [_remainder(1 << i) for i in range(23)] + [0]
    errors = np.full((1 << 11, 6), -1, np.int32)
    errors[0, 0] = 0
    filled = np.zeros(1 << 11, np.int32)
    filled[0] = 6
    for weight in (2, 4):
        done = filled >= (1 if weight == 4 else 6)
        for at in combinations(range(24), weight):
            s = reduce(lambda a, b: a ^ b, (single[i] for i in at))
            if not done[s]:
                errors[s, filled[s]] = sum(1 << i for i in at)
                filled[s] += 1
    return np.stack([low[: 1 << 12], np.resize(high, 1 << 12)]), errors


def codeword_indices(segments: np.ndarray) -> np.ndarray:
    """For 23-bit words, the 12-bit indices of all codewords within distance 4 of word and parity; -1 fills up to six."""
    parts, errors = golay_tables()
    parity = segments.copy()
    for k in (16, 8, 4, 2, 1):
        parity ^= parity >> k
    word = segments | (parity & 1) << 23
    e = errors[parts[0][segments & 0xFFF] ^ parts[1][segments >> 12]]
    code = (word[..., None] ^ e) >> 11 & 0xFFF  # the code is systematic in its 12 high bits of 23
    return np.where(e >= 0, code, -1)


# --- fingerprints ------------------------------------------------------------------------------


@cache
def _functions(how: Alike) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(how.seed)
    n = how.bands * (23 + how.anchors)
    return rng.integers(1, 1 << 63, n, np.int64).astype(np.uint64) << np.uint64(1) | np.uint64(1), rng.integers(0, 1 << 63, n, np.int64).astype(np.uint64)


def _word_hash(word: str, known: dict[str, int]) -> int:
    h = known.get(word)
    if h is None:
        if len(known) > 1 << 18:
            known.clear()
        h = known[word] = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
    return h


def shingle_hashes(words: list[str], size: int, known: dict[str, int]) -> np.ndarray:
    """Distinct 64-bit hashes of the runs of ``size`` words."""
    w = np.array([_word_hash(x, known) for x in words], np.uint64)
    n = len(w) - size + 1
    if n < 1:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = (h ^ w[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return np.unique(h)


def minima(shingles: np.ndarray, how: Alike) -> np.ndarray:
    """The minimum of each hash function over the shingles; long records in parts."""
    a, b = _functions(how)
    out = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for s in range(0, len(shingles), 512):
        x = shingles[s : s + 512, None] * a + b
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        np.minimum(out, x.min(axis=0), out=out)
    return out


def fingerprints(minima_: np.ndarray, how: Alike) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint as rows of int64, keys with 0 where there is none) of records' minima."""
    n, m = len(minima_), minima_.reshape(len(minima_), how.bands, 23 + how.anchors)
    mixed = m ^ m >> np.uint64(33)
    bits = (mixed[:, :, :23] >> np.uint64(17) & np.uint64(1)).astype(np.uint8)
    segments = (bits.astype(np.int64) << np.arange(23)).sum(axis=2).astype(np.int32)
    packed = np.packbits(bits.reshape(n, -1), axis=1)
    packed = np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.int64)
    index = codeword_indices(segments)
    key = np.broadcast_to(np.arange(1, how.bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93), (n, how.bands)).copy()
    for k in range(how.anchors):
        key = (key ^ m[:, :, 23 + k]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(32)
    keys = (key[:, :, None] ^ index.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    keys ^= keys >> np.uint64(29)
    return packed, np.where(index >= 0, keys.view(np.int64), 0).reshape(n, -1)


def fingerprinted(records: DataFrame, how: Alike) -> DataFrame:
    """(record_id, cls, print, keys) of records with enough words.

    cls is a hash that records with equal words share. Keys stand only at the first record of a class in a task; at others they are null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        seen: set[int] = set()
        for b in batches:
            ids, cls, new, low = [], [], [], []
            for i, t, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                w = words_of(t, x)
                if len(w) < max(how.least_words, how.words):
                    continue
                c = int.from_bytes(hashlib.blake2b(" ".join(w).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)
                ids.append(i)
                cls.append(c)
                new.append(c not in seen)
                if c not in seen:
                    seen.add(c)
                    low.append(minima(shingle_hashes(w, how.words, known), how))
            if not ids:
                continue
            prints: list[list[int] | None] = [None] * len(ids)
            keys: list[np.ndarray | None] = [None] * len(ids)
            if low:
                p, k = fingerprints(np.stack(low), how)
                for at, row in zip(np.flatnonzero(new), range(len(low)), strict=True):
                    prints[at], keys[at] = p[row], k[row][k[row] != 0]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(cls, pa.int64()), pa.array(prints, pa.list_(pa.int64())), pa.array(keys, pa.list_(pa.int64()))], ["record_id", "cls", "print", "keys"])

    return records.select(F.col("record_id").cast("long"), "title", "bodyText").mapInArrow(run, "record_id long, cls long, print array<long>, keys array<long>")


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the distinct shingles of either that are in both."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def class_pairs(records: DataFrame, prints: DataFrame, how: Alike) -> DataFrame:
    """(cls_a, cls_b, similarity), cls_a < cls_b: pairs of different classes that are alike.

    prints: what ``fingerprinted`` made, written. Keys of two classes give their pair at once; only keys of more are joined.
    """
    keyed = prints.where("keys is not null").select("cls", F.explode("keys").alias("key"))
    groups = keyed.groupBy("key").agg(F.min("cls").alias("cls_a"), F.max("cls").alias("cls_b"), F.count(F.lit(1)).alias("n")).where("cls_a < cls_b")
    groups = materialize(groups, "keys")
    two = groups.where("n = 2").select("cls_a", "cls_b")
    many = materialize(keyed.join(groups.where("n > 2").select("key"), "key", "left_semi").distinct(), "crowded")
    a, b = (many.select("key", F.col("cls").alias(f"cls_{s}")) for s in "ab")
    found = two.unionByName(a.join(b, "key").where("cls_a < cls_b").select("cls_a", "cls_b")).distinct()
    one = prints.where("print is not null").groupBy("cls").agg(F.first("print").alias("print"))
    near = found.join(one.select(F.col("cls").alias("cls_a"), F.col("print").alias("pa")), "cls_a").join(one.select(F.col("cls").alias("cls_b"), F.col("print").alias("pb")), "cls_b")
    apart = F.aggregate(F.zip_with("pa", "pb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    near = materialize(near.where(apart <= how.farthest).select("cls_a", "cls_b"), "near")
    for t in (groups, many):
        release(t) if t.inputFiles() else None
    needed = near.select(F.explode(F.array("cls_a", "cls_b")).alias("cls")).distinct()
    reps = prints.select("record_id", "cls").join(needed, "cls", "left_semi").groupBy("cls").agg(F.min("record_id").alias("record_id"))
    texts = records.select(F.col("record_id").cast("long"), F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("bodyText", F.lit(""))).alias("text")).join(reps, "record_id").select("cls", "text")
    texts = materialize(texts, "texts")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for x in batches:
            out = []
            for ca, cb, ta, tb in zip(*(x.column(n).to_pylist() for n in ("cls_a", "cls_b", "ta", "tb")), strict=True):
                s = similarity(shingle_hashes(words_of(None, ta), how.words, known), shingle_hashes(words_of(None, tb), how.words, known))
                if s >= how.threshold:
                    out.append((ca, cb, s))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.float64())], ["cls_a", "cls_b", "similarity"])

    pairs = near.join(texts.select(F.col("cls").alias("cls_a"), F.col("text").alias("ta")), "cls_a").join(texts.select(F.col("cls").alias("cls_b"), F.col("text").alias("tb")), "cls_b")
    return pairs.select("cls_a", "cls_b", "ta", "tb").mapInArrow(verify, "cls_a long, cls_b long, similarity double")


def alike_pairs(records: DataFrame, how: Alike = Alike()) -> DataFrame:
    """(record_id_a, record_id_b), the smaller first: all alike pairs, those of equal records included.

    Null titles and bodies count as empty; records with fewer words than ``least_words``, or than a shingle has, have no partner.
    Rows are distinct if record_id is unique. An empty table gives no row. Other columns don't matter.
    """
    prints = materialize(fingerprinted(records, how), "prints")
    pairs = class_pairs(records, prints, how)
    a, b = (prints.select(F.col("record_id").alias(f"r{s}"), F.col("cls").alias(f"cls_{s}")) for s in "ab")
    across = pairs.join(a, "cls_a").join(b, "cls_b").select(F.least("ra", "rb").alias("record_id_a"), F.greatest("ra", "rb").alias("record_id_b"))
    within = a.join(b, a["cls_a"] == b["cls_b"]).where("ra < rb").select(F.col("ra").alias("record_id_a"), F.col("rb").alias("record_id_b"))
    return across.unionByName(within)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each node's component; edges (a, b) either way.

    Labels take their neighbours' minimum, then their label's label, until none changes. Each round is written, so its lineage is short.
    """
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    labels = materialize(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("low"))
        new = labels.join(near, labels["node"] == near["a"]).select("node", F.col("root").alias("old"), F.least("root", "low").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("up"))
        new = materialize(new.join(jump, "root", "left").select("node", "old", F.least("root", F.coalesce("up", "root")).alias("root")), "labels")
        changed = new.where("old <> root").limit(1).count()
        release(labels)
        labels = new.select("node", "root")
        if not changed:
            return labels


def alike_groups(records: DataFrame, how: Alike = Alike()) -> DataFrame:
    """One row per record: (record_id, class_id, copies, n_links, group_id).

    class_id is the smallest record_id with the same words, n_links the number of other classes that are alike, group_id the smallest
    record_id of all that are linked through such pairs. Records with too few words stand alone.
    """
    prints = materialize(fingerprinted(records, how), "prints")
    pairs = materialize(class_pairs(records, prints, how), "pairs")
    classes = prints.groupBy("cls").agg(F.min("record_id").alias("class_id"), F.count(F.lit(1)).alias("copies"))
    links = pairs.select(F.explode(F.array("cls_a", "cls_b")).alias("cls")).groupBy("cls").agg(F.count(F.lit(1)).alias("n_links"))
    ids = classes.select("cls", "class_id")
    edges = pairs.join(ids.select(F.col("cls").alias("cls_a"), F.col("class_id").alias("a")), "cls_a").join(ids.select(F.col("cls").alias("cls_b"), F.col("class_id").alias("b")), "cls_b")
    roots = components(edges.select("a", "b"))
    of = classes.join(links, "cls", "left").join(roots, classes["class_id"] == roots["node"], "left").select("cls", "class_id", "copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "class_id").alias("group_id"))
    all_ = records.select(F.col("record_id").cast("long").alias("record_id")).join(prints.select("record_id", "cls"), "record_id", "left").join(of, "cls", "left")
    return all_.select("record_id", F.coalesce("class_id", "record_id").alias("class_id"), F.coalesce("copies", F.lit(1)).alias("copies"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("group_id", "record_id").alias("group_id"))
