import random

import numpy as np
import pytest
from statloom.llm.near_duplicates import Alike, alike_groups, alike_pairs, codeword_indices, components, golay_tables, words_of
from statloom.runtime import table

SCHEMA = "record_id long, title string, bodyText string, cls string, keys int, `key` string"


def brute(records, how):
    sets = {}
    for i, t, b in records:
        w = words_of(t, b)
        if len(w) >= max(how.least_words, how.words):
            sets[i] = {tuple(w[k : k + how.words]) for k in range(len(w) - how.words + 1)}
    ids = sorted(sets)
    return {(a, b) for k, b in enumerate(ids) for a in ids[:k] if len(sets[a] & sets[b]) >= how.threshold * len(sets[a] | sets[b])}


def made(seed, how, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = [(1, None, None), (2, "", ""), (3, "one", "word"), (4, "x " * 100, None)]
    for _ in range(n):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(30, 160))]
        for _ in range(rng.randint(1, 4)):
            v = list(w)
            for _ in range(rng.randint(0, 6)):
                k = rng.randrange(len(v))
                rng.choice([lambda: v.__setitem__(k, rng.choice(vocabulary)), lambda: v.insert(k, rng.choice(vocabulary)), lambda: v.pop(k), lambda: v.__setitem__(slice(0, 0), [v.pop(k)])])()
            out.append((len(out) + 1, " ".join(v[:4]).upper(), ", ".join(v[4:])))
    return out


def frame(spark, records):
    return spark.createDataFrame([(*r, "x", 1, None) for r in records], SCHEMA)


@pytest.mark.parametrize("seed,how", [(1, Alike(0.7, 3, 40)), (2, Alike()), (3, Alike(0.7, 3, 40))])
def test_against_brute_force(spark, seed, how):
    records = made(seed, how)
    got = [tuple(r) for r in alike_pairs(frame(spark, records), how).collect()]
    want = brute(records, how)
    assert len(got) == len(set(got)) and len(want) > 5
    assert set(got) == want


def test_groups(spark):
    how = Alike(0.7, 3, 40)
    records = made(4, how)
    pairs, root = brute(records, how), {i: i for i, *_ in records}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {r.record_id: r for r in alike_groups(frame(spark, records), how).collect()}
    assert {i: r.group_id for i, r in got.items()} == {i: find(i) for i in root}
    text = {i: words_of(t, b) for i, t, b in records}
    for i, r in got.items():
        same = [j for j in text if text[j] == text[i]] if len(text[i]) >= 40 else [i]
        assert (r.class_id, r.copies) == (min(same), len(same))
        assert r.n_links == len({tuple(text[j]) for p in pairs if i in p for j in p if text[j] != text[i]})


def test_empty_table_and_very_long_records(spark):
    assert alike_pairs(frame(spark, [(1, "a", "b")]).limit(0)).collect() == []
    rng = random.Random(1)
    w = [f"w{rng.randrange(10**6)}" for _ in range(60_000)]
    v = list(w)
    for k in range(0, 60_000, 200):
        v[k] = "changed"
    assert [tuple(r) for r in alike_pairs(frame(spark, [(1, None, " ".join(w)), (2, "t", " ".join(v))])).collect()] == [(1, 2)]


def test_golay_code():
    parts, errors = golay_tables()
    assert sorted({int((row >= 0).sum()) for row in errors}) == [1, 6]
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 23, 400).astype(np.int32)
    mine = [set(r[r >= 0]) for r in codeword_indices(x)]
    for flips in (1, 2):
        y = x.copy()
        for k in range(len(y)):
            for b in rng.choice(23, flips, replace=False):
                y[k] ^= 1 << int(b)
        assert all(a & set(b[b >= 0]) for a, b in zip(mine, codeword_indices(y), strict=True))


def test_components_of_a_long_chain(spark):
    n = 200
    e = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 999)], "a long, b long")
    got = {r.node: r.root for r in components(e).collect()}
    assert got == dict.fromkeys(range(n + 1), 0) | {999: 999, 1000: 999}


def test_project_records(spark, data):
    how = Alike(0.7, 3, 40)
    p = table(spark, data, "parsed")
    assert {tuple(r) for r in alike_pairs(p, how).collect()} == brute([tuple(r) for r in p.select("record_id", "title", "bodyText").collect()], how)
