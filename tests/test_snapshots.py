"""Chains and differences against plain versions over dictionaries."""

import os
import random
import unicodedata
from datetime import datetime, timedelta

import pytest
from statloom.operators.history_chains import ChainStore, build_chains, section_versions
from statloom.operators.snapshot_diff import diff_snapshots, section_changes
from statloom.runtime import table

START = datetime(2025, 1, 1)
SCHEMA = "row_id long, batch_id int, sectionNumber string, chapterNumber string, title string, bodyText string, history string, isRepealed boolean, loaded_at timestamp, snapshot_no string, h1 string, section_key int, next_at string"
BATCHES = "batch_id int, snapshot_no int, status string, taken_at timestamp"


def key(s):
    if s is None:
        return None
    for c in "‐‑‒–−":
        s = s.replace(c, "-")
    s = "".join(c for c in s if c not in "§[]\xad" and not c.isspace()).upper()
    while len(s) > 1 and s[0] == "0" and s[1].isdigit():
        s = s[1:]
    return s or None


def norm(t):
    return None if t is None else unicodedata.normalize("NFC", " ".join(t.replace("\xad", "").replace("‑", "-").split()))


def current(snapshots, batches):
    good = {b[0]: b[1] for b in batches if b[2] == "complete"}
    best = {}
    for r in snapshots:
        if r["batch_id"] in good and key(r["sectionNumber"]):
            k = key(r["sectionNumber"]), good[r["batch_id"]]
            if k not in best or (r["loaded_at"], r["row_id"]) > (best[k]["loaded_at"], best[k]["row_id"]):
                best[k] = r
    return best


def versions(best):
    out, of = set(), {}
    for (k, n), r in best.items():
        of.setdefault(k, {})[n] = (norm(r["title"]), norm(r["bodyText"]), r["isRepealed"])
    for k, v in of.items():
        for n in sorted(v):
            if n - 1 in v and v[n - 1] == v[n]:
                continue
            e = n
            while e + 1 in v and v[e + 1] == v[n]:
                e += 1
            out.add((k, n, e))
    return out


def changes(best, last):
    of = {}
    for (k, n), r in best.items():
        of.setdefault(k, {})[n] = (norm(r["bodyText"]), norm(r["history"]))
    out = set()
    for k, v in of.items():
        for n in range(2, last + 1):
            if (n in v) != (n - 1 in v):
                out.add((k, n, "added" if n in v else "removed"))
            elif n in v and v[n] != v[n - 1]:
                out.add((k, n, "changed"))
    return out


def made(seed):
    rng = random.Random(seed)
    batches = [(100 + i, n, s, START + timedelta(days=30 * n)) for i, (n, s) in enumerate([(1, "complete"), (2, "aborted"), (2, "complete"), (3, "complete"), (4, "complete")])]
    texts = ["a b", " a\xa0 b ", "a\xad b", "ā", "ā", None, "", "x‑y", "x-y", "long " * 2000]
    numbers = ["§1-2", "§ 1‑2", "[§1-2]", "§001-2", "§1-3", "§2a-4", "§2A-4 ", None, "", "§3-1"]
    rows = []
    for i in range(120):
        b = rng.choice(batches)
        at = b[3] + timedelta(days=rng.choice([0, 0, 0, 1, 45, 90]))
        rows.append(dict(row_id=i, batch_id=b[0], sectionNumber=rng.choice(numbers), chapterNumber=None, title=rng.choice(texts), bodyText=rng.choice(texts), history=rng.choice(texts[:4]), isRepealed=rng.choice([True, False, None]), loaded_at=at, snapshot_no="x", h1=None, section_key=1, next_at=None))
    return rows, batches


@pytest.mark.parametrize("seed", [1, 2])
def test_random_deliveries(spark, seed):
    data, batches = made(seed)
    s, b = spark.createDataFrame([tuple(r.values()) for r in data], SCHEMA), spark.createDataFrame(batches, BATCHES)
    best = current(data, batches)
    assert {tuple(r) for r in section_versions(s, b).collect()} == versions(best)
    got = [tuple(r) for r in section_changes(s, b).collect()]
    assert len(got) == len(set(got))
    assert set(got) == changes(best, 4)


def test_project_tables(spark, data):
    s, b = table(spark, data, "parsed_snapshots"), table(spark, data, "load_batches")
    best = current([r.asDict() for r in s.collect()], [tuple(r) for r in b.collect()])
    assert {tuple(r) for r in section_versions(s, b).collect()} == versions(best)
    assert {tuple(r) for r in section_changes(s, b).collect()} == changes(best, 8)


def test_empty_tables(spark):
    s, b = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], BATCHES)
    assert section_versions(s, b).collect() == []
    assert section_changes(s, b).collect() == []


def test_chains_end_where_a_snapshot_is_missing(spark):
    df = spark.createDataFrame([("a", 1, 1, "x"), ("a", 2, 1, "x"), ("a", 4, 1, "x"), ("a", 5, 1, "y"), ("a", 5, 2, "x"), ("b", 3, 1, None), ("b", 4, 1, None)], "e string, n int, t int, v string")
    got = {tuple(r) for r in build_chains(df, "e", "n", ["t"], ["v"]).select("e", "first_n", "last_n").collect()}
    assert got == {("a", 1, 2), ("a", 4, 5), ("b", 3, 4)}


def test_diff_of_many_keys_discards_equal_chunks(spark):
    rows = [(f"k{i:04d}", n, i if (i, n) != (700, 2) else -1, 0) for n in (1, 2) for i in range(1000) if (i, n) not in {(5, 1), (999, 2)}]
    df = spark.createDataFrame(rows, "k string, n int, a long, b long")
    assert {tuple(r) for r in diff_snapshots(df, "k", "n", ("a", "b")).collect()} == {("k0005", 2, "added"), ("k0700", 2, "changed"), ("k0999", 2, "removed")}


STORED, HOW = "e string, n int, t int, v string", ("n", ["t"], ["v"])


def stored(df):
    return sorted(tuple(r) for r in df.select("e", "first_n", "last_n", "v").collect())


def files(root):
    return {f for _, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def test_store_rewrites_the_parts_of_touched_chains_alone(spark, tmp_path):
    first = [("a", 1, 1, "x"), ("a", 2, 1, "x"), ("b", 1, 1, "y"), ("b", 2, 1, "z"), *((f"k{i}", 1, 1, "k") for i in range(40))]
    late = [("a", 2, 2, "w"), ("c", 2, 2, "n")]
    store = ChainStore(spark, f"file://{tmp_path}/chains", "e", 16)
    assert store.read() is None
    df, all_, touched = (spark.createDataFrame(x, STORED) for x in (first, first + late, late))
    assert store.apply_late(df, df, *HOW) == 1
    before, parts = files(tmp_path), store._current()[1]["parts"]
    assert store.apply_late(all_, touched, *HOW) == 2
    now = store._current()[1]["parts"]
    assert stored(store.read()) == stored(build_chains(all_, "e", *HOW)) and before < files(tmp_path)
    assert 1 <= sum(parts.get(k) != v for k, v in now.items()) <= 2
    assert store.apply_late(all_, touched.limit(0), *HOW) == 2
    assert store.replace(store.read()) == 3 and len(stored(store.read())) == 45


def test_of_two_writers_the_second_fails_and_the_first_stays(spark, tmp_path):
    a, b = (ChainStore(spark, f"file://{tmp_path}/chains", "e", 4) for _ in range(2))
    x, y, z = (build_chains(spark.createDataFrame([(k, 1, 1, "v")], STORED), "e", *HOW) for k in "xyz")
    assert a.replace(x) == 1
    seen, old = b._current()
    assert a.replace(y) == 2
    with pytest.raises(RuntimeError, match="another writer"):
        b._write(seen, old, z, range(4))
    assert [r[0] for r in stored(a.read())] == ["y"] and b.version() == 2
    assert b.replace(z) == 3 and [r[0] for r in stored(a.read())] == ["z"]


def test_a_writer_that_is_lost_leaves_the_old_version(spark, tmp_path, monkeypatch):
    store = ChainStore(spark, f"file://{tmp_path}/chains", "e", 4)
    x, y = (build_chains(spark.createDataFrame([(k, 1, 1, "v")], STORED), "e", *HOW) for k in "xy")
    store.replace(x)
    with monkeypatch.context() as m:
        m.setattr(ChainStore, "_commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            store.replace(y)
    assert store.version() == 1 and [r[0] for r in stored(store.read())] == ["x"]
    assert store.replace(y) == 2


@pytest.mark.parametrize("deliveries", [2, 3])
def test_late_rows_in_several_deliveries(spark, deliveries):
    data, batches = made(3)
    s, b = spark.createDataFrame([tuple(r.values()) for r in data], SCHEMA), spark.createDataFrame(batches, BATCHES)
    assert {tuple(r) for r in section_versions(s, b, deliveries).collect()} == versions(current(data, batches))
