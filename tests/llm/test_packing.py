import random
from collections import Counter

import pytest
from statloom.llm.packing import pack_histogram, pack_windows, token_counts
from statloom.llm.queries import SPLIT, TOKENIZERS, VOCABULARY


def placed(df):
    """Windows by (capacity, number): intervals that neither overlap nor pass the end."""
    w = {}
    for r in df.collect():
        w.setdefault((r.capacity, r.window_no), []).append((r.start, r.start + r.n_tokens, r.doc_id, r.piece, r.step_group))
    for (cap, _), v in w.items():
        v.sort()
        assert v[0][0] == 0 and v[-1][1] <= cap and all(a[1] == b[0] or a[1] <= b[0] for a, b in zip(v, v[1:], strict=False)) and len({x[4] for x in v}) == 1
    return w


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_hold_every_text_once(spark, seed):
    rng = random.Random(seed)
    sizes = [0, 0, 1, 64, 128, 129, 1000, 640, None] + [min(127, int(rng.expovariate(1 / 30))) for _ in range(800)] + [40] * 300
    df = spark.createDataFrame(list(enumerate(sizes)), "doc_id long, n_tokens long")
    w = placed(pack_windows(df, [32, 64, 128], per_step=8))
    got = Counter()
    for v in w.values():
        for s, e, d, _, _ in v:
            got[d] += e - s
    assert dict(got) == {d: n or 0 for d, n in enumerate(sizes)}
    pieces = Counter(d for v in w.values() for _, _, d, _, _ in v)
    assert all(n == max(1, -(-(sizes[d] or 0) // 128)) for d, n in pieces.items())
    used, room = sum(n or 0 for n in sizes), sum(c for c, _ in w)
    assert used / room > 0.98
    for cap in (64, 128):
        groups = Counter()
        for (c, _), v in w.items():
            if c == cap:
                groups[v[0][4]] += sum(e - s for s, e, *_ in v)
        assert max(groups.values()) <= 1.3 * (sum(groups.values()) / len(groups)) + cap


def test_histogram_is_packed_whatever_its_counts():
    counts = {5: 10**12, 7: 3 * 10**11, 10: 1, 3: 17}
    got = Counter()
    for p in pack_histogram(counts, [10]):
        assert p.used <= 10
        for s in p.sizes:
            got[s] += p.count
    assert got == Counter(counts)
    assert pack_histogram({}, [10]) == []


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, n_tokens long")
    assert pack_windows(empty, [10]).collect() == []
    with pytest.raises(ValueError):
        pack_windows(empty, [])
    only = spark.createDataFrame([(1, 0), (2, None)], "doc_id long, n_tokens long")
    assert sorted((r.doc_id, r.capacity, r.window_no, r.start) for r in pack_windows(only, [10, 20]).collect()) == [(1, 10, 0, 0), (2, 10, 0, 0)]


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "Hello world"), (2, ""), (3, None), (4, "<|endoftext|>"), (5, "word " * 50000)], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts(df, f"{TOKENIZERS}/{VOCABULARY}", SPLIT).collect()}
    assert got[1] == 2 and got[2] == got[3] == 0 and got[4] > 1 and got[5] >= 50000
