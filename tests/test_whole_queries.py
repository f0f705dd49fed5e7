"""Queries over whole tables against brute force."""

import re

import __spark_entry__ as entry
from statloom.operators import search as S
from statloom.runtime import table

from tests.conftest import rows
from tests.test_layout_search import PAGES

QUERIES = entry.queries()

NOTE = "array<struct<heading:string,text:string>>"
VOCABULARY = "statute statues liberty planted plantes planter garden gardens".split()
RARE = "statxxe plantxx planteq gardenss gardeen libetry lbierty zzzzzzz statuets".split()


def nearest(word):
    """By brute force over all pairs."""
    ranks = {0: 0, -1: 1, 1: 2, -2: 3, 2: 4}
    near = [(d, ranks[len(v) - len(word)], v) for v in VOCABULARY if (d := S.osa(word, v)) <= 2]
    return (word, min(near)[2], min(near)[0]) if near else None


def test_suggestions_at_all_distances(spark, tmp_path):
    lines = [(" ".join(VOCABULARY), " ".join(VOCABULARY), [("x", " ".join(VOCABULARY))]), (" ".join(RARE), None, None)]
    spark.createDataFrame(lines, f"title string, bodyText string, annotations {NOTE}").write.parquet(f"{tmp_path}/parsed.parquet")
    want = [x for x in map(nearest, RARE) if x]
    assert {d for _, _, d in want} == {1, 2}
    assert rows(QUERIES["x6_suggestions"](spark, str(tmp_path))) == sorted(want, key=repr)
    assert rows(QUERIES["x7_fixed_queries"](spark, str(tmp_path))) == sorted(((f"asked {w} law", f"asked {s} law") for w, s, _ in want), key=repr)


def test_all_pages_with_all_fields(spark, tmp_path):
    lines = [(i, f, h, None, None) for i, (f, h) in enumerate(PAGES.items())]
    spark.createDataFrame(lines, "record_id long, filename string, bodyHtml string, sectionNumber string, title string").write.parquet(f"{tmp_path}/parsed.parquet")
    got = {r.filename: r for r in QUERIES["d16_all_sections"](spark, str(tmp_path)).collect()}
    assert set(got) == set(PAGES) and len(got["HRS_0001-0100.htm"]) == 17
    a, d = got["HRS_0026-0012.htm"], got["HRS_0515-0011.htm"]
    assert (a.sectionNumber, a.partHeading, a.bodyText, a.history, a.chapterNumber, a.docType) == ("§26-12", "[PART IV. SUPPLIED]", "(a) The department", "[L 1990, c 1; am L 1991, c 2]", "26", "hrs")
    assert (len(a.annotations), a.crossReferences, a.caseNotes) == (2, ["See chapter 5.", "More."], "Case.")
    assert (d.covers.end, d.isRepealed, d.numberSource) == ("§515-12", True, "page-range")


def split(body, history):
    t = " ".join(x for x in (body, history) if x is not None)
    found = re.findall(r"\[[^\[\]]*\b(?:1[6-9][0-9]{2}|20[0-9]{2})\b[^\[\]]*\]", t)
    if not found:
        return "", t
    at = t.rindex(found[-1])
    rest = (t[:at] + t[at + len(found[-1]) :]).strip(" ")
    return found[-1], rest or t


def test_all_histories(spark, tmp_path, data):
    lines = [("A [see 1990] b", "[L 1991, c 2]"), ("A [see 1990] b", "L 1991, c 2"), ("A [x 1990] b [x 1990] c", ""), (None, "[L 1990]"), (None, None), ("b", None), ("a\n\nb [1]", "[L 90] | [am L 2001, c 3]; CC")]
    spark.createDataFrame([(i, *x) for i, x in enumerate(lines)], "record_id long, bodyText string, history string").write.parquet(f"{tmp_path}/parsed.parquet")
    for d in (str(tmp_path), data):
        want = [(r.record_id, *split(r.bodyText, r.history)) for r in table(spark, d, "parsed").collect()]
        assert rows(QUERIES["f24_history_split"](spark, d)) == sorted(want, key=repr)


def test_changes_of_all_deliveries(spark, tmp_path, data):
    batches = [(1, 1, "complete"), (2, 2, "aborted"), (3, 2, "complete"), (4, 3, "complete")]
    spark.createDataFrame(batches, "batch_id int, snapshot_no int, status string").write.parquet(f"{tmp_path}/load_batches.parquet")
    lines = [(1, "a", "x"), (1, "b", "x"), (1, None, "x"), (2, "a", "lost"), (2, "c", "lost"), (3, "a", "old"), (3, "a", "x"), (3, "b", None), (3, "c", "x"), (4, "b", None), (4, "c", "y"), (4, None, "x")]
    spark.createDataFrame([(i, b, k, "t", x, "") for i, (b, k, x) in enumerate(lines)], "row_id long, batch_id int, sectionNumber string, title string, bodyText string, history string").write.parquet(f"{tmp_path}/parsed_snapshots.parquet")
    got = rows(QUERIES["k9_changed_rows"](spark, str(tmp_path)))
    assert got == sorted([(2, "a", "unchanged"), (2, "b", "changed"), (2, "c", "created"), (3, "b", "unchanged"), (3, "c", "changed"), (3, None, "created")], key=repr)
    assert rows(QUERIES["a16_run_counters"](spark, str(tmp_path))) == sorted([(2, "unchanged", 1), (2, "changed", 1), (2, "created", 1), (3, "unchanged", 1), (3, "changed", 1), (3, "created", 1)], key=repr)
