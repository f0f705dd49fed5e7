import random

import pytest
from statloom.llm.shared_spans import Spans, _agree, _agree_back, anchors, codes, shared_coverage, shared_repeats, sharing_pairs
from statloom.runtime import table

HOW = Spans(length=40, gram=20, step=5, hot=3, chunk=64)
SCHEMA = "doc_id long, text string, cls string, h string, pos int, rows int"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", None, 1, 2) for i, t in enumerate(texts)], SCHEMA)


def made(seed, n=60):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abcdefgh ōé😀") for _ in range(k))
    spans = [word(k) for k in (38, 39, 40, 41, 60, 200, 25, 30)]
    texts = [None, "", "a", "x" * 300, "x" * 90, "xy" * 100, "yx" * 60]
    for _ in range(n):
        parts = [word(rng.randint(0, 60)) for _ in range(4)]
        for _ in range(rng.randint(0, 3)):
            parts.insert(rng.randint(0, len(parts)), rng.choice(spans))
        texts.append("".join(parts))
    texts += [rng.choice(texts) for _ in range(6)]
    return texts


def share(a, b, n):
    grams = {a[i : i + n] for i in range(len(a) - n + 1)}
    return any(b[i : i + n] in grams for i in range(len(b) - n + 1))


def brute(texts, n):
    return {(i, j) for j in range(len(texts)) for i in range(j) if texts[i] and texts[j] and share(texts[i], texts[j], n)}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pairs_against_brute_force(spark, seed):
    texts = made(seed)
    got = [tuple(r) for r in sharing_pairs(frame(spark, texts), HOW).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(texts, HOW.length)


def test_repeats_are_maximal(spark):
    texts = made(5)
    of = {}
    from pyspark.sql import functions as F

    for r in frame(spark, texts).where("text is not null").select(F.xxhash64("text").alias("c"), "text").collect():
        of[r.c] = r.text
    for r in shared_repeats(frame(spark, texts), HOW).collect():
        a, b = of[r.cls_a], of[r.cls_b]
        assert a[r.start_a : r.start_a + r.n] == b[r.start_b : r.start_b + r.n] and r.n >= HOW.length
        assert not (r.start_a and r.start_b and a[r.start_a - 1] == b[r.start_b - 1])
        ea, eb = r.start_a + r.n, r.start_b + r.n
        assert ea == len(a) or eb == len(b) or a[ea] != b[eb]


def covered(texts, n):
    """Characters in stretches that stand in another text too, all where there are copies."""
    where = {}
    for i, t in enumerate(texts):
        for k in range(len(t or "") - n + 1):
            where.setdefault(t[k : k + n], set()).add(t)
    out = []
    for t in texts:
        own = set()
        for k in range(len(t or "") - n + 1):
            if len(where[t[k : k + n]]) > 1 or texts.count(t) > 1:
                own.update(range(k, k + n))
        out.append(len(own))
    return out


def test_coverage(spark):
    x, y = "q" * 3 + "abcdefghij" * 5, "abcdefghij" * 5 + "r" * 9
    texts = [x, y, y, "short", None, "z" * 30]
    got = {r.doc_id: (r.class_id, r.copies, r.n_chars, r.shared_chars) for r in shared_coverage(frame(spark, texts), HOW).collect()}
    assert got == {0: (0, 1, 53, 50), 1: (1, 2, 59, 59), 2: (1, 2, 59, 59), 3: (3, 1, 5, 0), 4: (4, 1, 0, 0), 5: (5, 1, 30, 0)}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_coverage_against_brute_force(spark, seed):
    texts = made(seed, 120)
    got = {r.doc_id: r.shared_chars for r in shared_coverage(frame(spark, texts), HOW).collect()}
    assert [got[i] for i in range(len(texts))] == covered(texts, HOW.length)


def test_a_passage_in_very_many_texts_makes_no_pairs(spark):
    rng = random.Random(9)
    word = lambda k: "".join(rng.choice("abcdefghijklmnop ") for _ in range(k))
    passage = word(500)
    texts = [word(rng.randint(20, 200)) + passage + word(rng.randint(20, 200)) for _ in range(4000)] + [passage + "x"] * 4000
    got = {r.doc_id: r.shared_chars for r in shared_coverage(frame(spark, texts)).collect()}
    assert all(500 <= got[i] <= 512 for i in range(4000)) and all(got[i] == 501 for i in range(4000, 8000))


def test_empty_table(spark):
    assert sharing_pairs(frame(spark, ["a"]).limit(0), HOW).collect() == []
    assert shared_coverage(frame(spark, ["a"]).limit(0), HOW).collect() == []


def test_every_window_has_an_anchor():
    import numpy as np

    rng = random.Random(3)
    t = "".join(rng.choice("abc") for _ in range(3000)) + "z" * 500
    x = codes(t).astype(np.uint64)
    at, _ = anchors(x, np.zeros(len(x), np.int64), HOW)
    runs = np.diff(at)
    assert all(g <= HOW.window or set(t[a : a + g]) == {"z"} for a, g in zip(at, runs, strict=False))


def test_extension():
    a, b = "xx" + "abc" * 700 + "y", "w" + "abc" * 700 + "z"
    assert _agree(a, 2, b, 1) == 2100 and _agree_back(a, 2102, b, 2101) == 2100 and _agree(a, 0, b, 0) == 0 and _agree("ab", 0, "ab", 0) == 2


def test_project_documents(spark, data):
    d = table(spark, data, "documents")
    texts = {r.doc_id: r.text for r in d.select("doc_id", "text").collect()}
    ids = sorted(texts)
    where = {}
    for i in ids:
        for g in {texts[i][k : k + 400] for k in range(len(texts[i]) - 399)}:
            where.setdefault(g, []).append(i)
    want = {(a, b) for v in where.values() for k, b in enumerate(v) for a in v[:k]}
    assert {tuple(r) for r in sharing_pairs(d).collect()} == want
