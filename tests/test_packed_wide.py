"""Lines with many places to cut between two anchors."""

import re
from collections import defaultdict

import numpy as np
import pytest
from statloom.operators import packed_values as V

ANCHOR = re.compile(V.LAW_ANCHOR)
BUCKETS = 1 << 14
LINES = ["am L 1990, c 1" + ", x; y" * 5 + "; am L 1991, c 2" + ", 7" * 9 + "; RL 1955, §1-2", "L 1990, c 1, §1 „é“, 2, am L 1991, c 2", "L 1990, c 1", "L 1990 L 1991; c 2 and CC 1859, §1"]


@pytest.mark.parametrize("text", LINES)
def test_walk_is_the_lattice(text, monkeypatch):
    size = BUCKETS + 2 * V.END_BUCKETS + 2 * V.GAP_BUCKETS
    w = V.Weights.of(np.random.default_rng(7).random(size), BUCKETS)
    line, a, b = V._Line(text, ANCHOR), defaultdict(float), defaultdict(float)
    V._expect(line, 2.0, w, BUCKETS, a)
    best = V._best(line, w, BUCKETS)
    monkeypatch.setattr(V, "DENSE", 0)
    V._expect(line, 2.0, w, BUCKETS, b)
    assert V._best(line, w, BUCKETS) == best
    assert {k: x for k, x in a.items() if x} == pytest.approx(dict(b))


def test_the_last_of_many_cuts(spark):
    numbers = ", ".join(str(i) for i in range(2, 81))
    long = ["am L 1990, c 1, §1, " + numbers, "am L 1991, c 2"]
    common = ["L 1990, c 5, §1", "am L 1991, c 2", "am L 1992, c 7", "am L 1990, c 5, §1; am L 1991, c 6", "am L 1990, c 5, §1, am L 1991, c 6", "L 1990, c 5, §1, 2, am L 1991, c 6"] * 5
    lines = [", ".join(long), *common]
    df = spark.createDataFrame(list(enumerate(lines)), "record_id long, history string")
    got = sorted(tuple(r) for r in V.enactment_clauses(df).where("record_id = 0").collect())
    assert [e for _, _, e in got] == long
