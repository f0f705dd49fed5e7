import random

import pytest
from statloom.llm.eval_leaks import Index, Leaks, leaked_items, words
from statloom.runtime import table

DOCS, ITEMS = "doc_id long, text string, item_id string, n_words int", "item_id long, passage string, answer string, doc_id int"


def brute(docs, items, run):
    out = set()
    for d, t in docs:
        w = words(t)
        have = {tuple(w[i : i + run]) for i in range(len(w) - run + 1)}
        out |= {(k, d) for k, p, _ in items for v in [words(p)] if any(tuple(v[i : i + run]) in have for i in range(len(v) - run + 1))}
    return out


def made(seed, run):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "a"] * 6 + [f"w{i}" for i in range(40)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randint(run - 2, 30)), rng.choice([None, "yes", "w1 w2"])) for i in range(90)] + [(900, None, None), (901, "", "x"), (902, "the " * 20, "the the")]
    docs = [(0, None), (1, ""), (2, "the " * 50), (3, "_".join(words(items[5][1])).upper())]
    for d in range(4, 80):
        parts = [text(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 2)):
            v = words(rng.choice(items[:90])[1])
            s = rng.randint(0, max(0, len(v) - run))
            parts += [",".join(v[s : s + run + rng.choice([-1, 0, 0, 3])]), text(rng.randint(0, 20))]
        docs.append((d, "; ".join(parts)))
    return docs, items


@pytest.mark.parametrize("seed,block", [(1, 20_000), (2, 20_000), (3, 25)])
def test_against_brute_force(spark, seed, block):
    how = Leaks(run=5, block_items=block, postings_block=4)
    docs, items = made(seed, how.run)
    d = spark.createDataFrame([(i, t, "x", 0) for i, t in docs], DOCS)
    i = spark.createDataFrame([(*x, 7) for x in items], ITEMS)
    got = [(r.item_id, r.doc_id) for r in leaked_items(d, i, how).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(docs, items, how.run)


def test_wand_finds_all_above_the_threshold():
    how = Leaks(run=5, postings_block=3)
    _, items = made(4, 5)
    ix, rng = Index(items, how), random.Random(9)
    for _ in range(300):
        q = sorted(rng.sample(range(len(ix.term)), rng.randint(1, 12)))
        want = [k for k in range(len(ix.ids)) if sum(c for t in q for i, c in zip(ix.items[t], ix.parts[t], strict=True) if i == k) >= 1 + 1e-9]
        got = ix.retrieve(q)
        assert set(want) <= set(got) and all(sum(c for t in q for i, c in zip(ix.items[t], ix.parts[t], strict=True) if i == k) >= 1 - 1e-9 for k in got)


def test_runs_and_answers(spark):
    passage = "one two three four five six seven"
    d = spark.createDataFrame([(1, "x One-two, three FOUR five six yes", "", 0), (2, "one two three four; nothing", "", 0)], DOCS)
    i = spark.createDataFrame([(1, passage, "Yes", 0), (2, passage, None, 0)], ITEMS)
    got = {(r.item_id, r.doc_id): (r.n_words, r.answer_found) for r in leaked_items(d, i, Leaks(run=5)).collect()}
    assert got == {(1, 1): (6, True), (2, 1): (6, False)}
    assert leaked_items(d.limit(0), i).collect() == [] and leaked_items(d, i.limit(0)).collect() == []


def test_project_tables(spark, data):
    d, i = table(spark, data, "documents"), table(spark, data, "eval_items")
    docs, items = [(r.doc_id, r.text) for r in d.collect()], [(r.item_id, r.passage, r.answer) for r in i.collect()]
    assert {(r.item_id, r.doc_id) for r in leaked_items(d, i).collect()} == brute(docs, items, 13)
