import random
import re

import pytest
from statloom.operators.packed_values import LAW_ANCHOR, Packing, enactment_clauses, split_packed
from statloom.runtime import table

from tests.conftest import rows

_ATOM = re.compile(r'"(?:""|[^"])*"|“[^”]*”|\((?:[^()]|\([^()]*\))*\)')


def by_rule(line):
    """Clauses by where laws are named, with quoted and bracketed spans covered up."""
    cover = _ATOM.sub(lambda x: ("Q" if x.group()[0] != "(" and re.search(LAW_ANCHOR, x.group()) else "p") * len(x.group()), line)
    at = [x.start() for x in re.finditer(r"(?<![A-Za-z])(?:(?:am imp|am|ren|ree|sup|gen)\s+)?(?:L Sp|L|RL|HRS|CC|PC)\s+(?=[§\d])|Q+", cover)]
    out = []
    for s, e in zip(at, [*at[1:], len(line)], strict=True):
        c = cover[s:e]
        n = len(re.sub(r"(?:[\s,;|/\[\]]|\band\b)+$", "", c))
        t = line[s : s + n]
        out.append(" ".join((t[1:-1] if set(c[:n]) == {"Q"} else t).replace('""', '"').split()))
    return out


def test_agrees_with_a_rule_on_the_whole_column(spark, data):
    p = table(spark, data, "parsed")
    got = {}
    for k, pos, e in enactment_clauses(p).collect():
        got.setdefault(k, {})[pos] = e
    for k, h in p.select("record_id", "history").collect():
        have = got.get(k, {})
        assert sorted(have) == list(range(1, len(have) + 1))
        assert [have[i] for i in sorted(have)] == (by_rule(h) if h and h.strip() else [])


CASES = [
    ("[L 1990, c 5, §§1, 2; am L 1991, c 6, §3]", ["L 1990, c 5, §§1, 2", "am L 1991, c 6, §3"]),
    ("L 1990, c 5, §1, am L 1991, c 7 & c 9, §2", ["L 1990, c 5, §1", "am L 1991, c 7 & c 9, §2"]),
    ('["am L 1990, c 5, §1 (the ""a; b and RL 1955 act"")";\nRL 1955, §1-2]', ['am L 1990, c 5, §1 (the "a; b and RL 1955 act")', "RL 1955, §1-2"]),
    ("[CC 1859, §1] [am L  1990,\tc 5, §1 (eff. Jan 1, 1990; see note)]", ["CC 1859, §1", "am L 1990, c 5, §1 (eff. Jan 1, 1990; see note)"]),
    ("PC 1869, c 2, §3; and am L Sp 1990 1st, c 5, pt of §1 |", ["PC 1869, c 2, §3", "am L Sp 1990 1st, c 5, pt of §1"]),
    ("", []),
    ("  ", []),
    ("[; ,]", []),
    (None, []),
    ("no law here; none", ["no law here; none"]),
    ("L 1990, c 5\x01; am L\x02 1991, c 6; am L 1992, c 7", ["L 1990, c 5\x01; am L\x02 1991, c 6", "am L 1992, c 7"]),
    ('"am L 1990, c 5', ['"am L 1990, c 5']),
]


def test_cases_with_nulls_and_clashing_columns(spark):
    common = [("[L 1990, c 5, §1; am L 1991, c 6, §3]",), ("[L 1990, c 5, §§1, 2]",), ("RL 1955, §1-2",), ("[am L 1991, c 7 & c 9, §2]",), ("CC 1859, §1; PC 1869, c 2, §3",)] * 5
    lines = [c[0] for c in CASES] + [c[0] for c in common]
    df = spark.createDataFrame([(i, t, "x", None) for i, t in enumerate(lines)], "record_id long, history string, pos string, shape string")
    got = {}
    for k, pos, e in sorted(tuple(r) for r in enactment_clauses(df).collect()):
        got.setdefault(k, []).append(e)
    for i, (_, want) in enumerate(CASES):
        assert got.get(i, []) == want


def test_empty_table_and_other_anchor(spark):
    empty = spark.createDataFrame([], "record_id long, history string")
    assert enactment_clauses(empty).collect() == []
    df = spark.createDataFrame([("a", "x=1; y=2; z=3"), ("b", "x=1")], "id string, v string")
    assert rows(split_packed(df, "id", "v", Packing(r"[xyz](?==)"))) == [("a", 1, "x=1"), ("a", 2, "y=2"), ("a", 3, "z=3"), ("b", 1, "x=1")]


@pytest.mark.parametrize("n", [3000])
def test_very_long_line(spark, n):
    df = spark.createDataFrame([(1, "; ".join(f"am L 1990, c {i}, §1" for i in range(n)))], "record_id long, history string")
    assert enactment_clauses(df).count() == n


def test_lines_that_are_mostly_separators(spark):
    line = "am L 1990, c 1" + ", x; y" * 3000 + "; am L 1991, c 2" + ", 7" * 3000 + "; RL 1955, §1-2"
    df = spark.createDataFrame([(1, line), (2, "L 1990, c 1; am L 1991, c 2"), (3, "," * 20000)], "record_id long, history string")
    got = [tuple(r) for r in enactment_clauses(df).collect()]
    assert sorted((k, p) for k, p, _ in got) == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2)]


def test_colours_without_anchors(spark):
    rng = random.Random(4)
    colours = ["red", "green", "teal", "dark blue", "light green", "off-white", "black and white"]
    lines = [("red",), ("dark blue",), ("off-white",), ("teal",)] * 3
    want = [[c] for (c,) in lines]
    for _ in range(150):
        own = [rng.choice(colours) for _ in range(rng.randint(1, 5))]
        want.append(own)
        lines.append((rng.choice(["; ", " / ", ", ", " | "]).join(own),))
    lines += [('red; green / "blue, dark" | teal',), ("black and white; red",), (None,), (" ; ",), ("red; red",)]
    want += [["red", "green", "blue, dark", "teal"], ["black and white", "red"], [], [], ["red", "red"]]
    df = spark.createDataFrame([(i, t) for i, (t,) in enumerate(lines)], "id long, colours string")
    got = {}
    for k, pos, e in sorted(tuple(r) for r in split_packed(df, "id", "colours", Packing()).collect()):
        got.setdefault(k, []).append(e)
    wrong = [(w, got.get(i, [])) for i, w in enumerate(want) if got.get(i, []) != w]
    assert len(wrong) <= 2, wrong
    assert all(got.get(i, []) == want[i] for i in range(len(want) - 5, len(want)))


def test_names_that_hold_a_separator(spark):
    rng = random.Random(5)
    names = [f"{a}, {b}" for a, b in zip("Smith Doe Kealoha Ng Ito Silva Kim Akana Lopez Wong".split(), "Ann Bob Lei Kai Mele Noa Ian Joy Ken Lani".split(), strict=True)]
    want = [[rng.choice(names) for _ in range(rng.choice([1, 1, 2, 3, 4]))] for _ in range(200)]
    df = spark.createDataFrame([(i, "; ".join(w)) for i, w in enumerate(want)], "id long, names string")
    got = {}
    for k, pos, e in sorted(tuple(r) for r in split_packed(df, "id", "names", Packing()).collect()):
        got.setdefault(k, []).append(e)
    wrong = [(w, got.get(i)) for i, w in enumerate(want) if got.get(i) != w]
    assert not wrong, wrong[:3]
