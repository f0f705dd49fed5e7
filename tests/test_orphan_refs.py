from datetime import datetime

import pytest
from pyspark.sql import functions as F
from statloom.operators.orphan_refs import law_orphans, orphan_references, text_references

from tests.conftest import rows

T = [datetime(2024, m, 1) for m in range(1, 13)]


def refs(spark, data):
    return spark.createDataFrame(data, "id long, a string, b string, at timestamp, __added string, reason string").drop("reason")


PARENTS = "a string, b string, added_at timestamp, dropped_at timestamp, id long"


@pytest.mark.parametrize("match", ["partial", "simple", "full"])
def test_masks_and_match_semantics(spark, match):
    r = refs(spark, [(1, "x", "1", T[5], None, None), (2, "x", None, T[5], None, None), (3, None, "9", T[5], None, None), (4, None, None, T[5], None, None), (5, "x", "2", T[5], None, None), (6, "y", "1", T[5], None, None), (7, "x", "1", T[0], None, None), (8, "z", "1", None, None, None)])
    p = spark.createDataFrame([("x", "1", T[2], None, 1), ("x", "1", T[2], None, 1), ("x", "2", T[1], T[3], 2), ("z", "1", T[1], None, 3), (None, "7", T[1], None, 4)], PARENTS)
    got = {(i, why) for i, why in orphan_references(r, p, ["a", "b"], "at", match).select("id", "reason").collect()}
    want = {(5, "deleted"), (6, "missing"), (7, "late"), (8, "late")}
    want |= {"partial": {(3, "missing")}, "simple": set(), "full": {(2, "partial_null"), (3, "partial_null")}}[match]
    assert got == want


def test_periods_touch_and_repeat(spark):
    p = spark.createDataFrame([("x", "1", T[1], T[2], 1), ("x", "1", T[2], T[4], 1), ("x", "1", T[6], None, 1)], PARENTS)
    r = refs(spark, [(m, "x", "1", T[m], None, None) for m in range(9)] + [(4, "x", "1", T[4], None, None)])
    got = sorted((x.id, x.reason) for x in orphan_references(r, p, ["a", "b"], "at").collect())
    assert got == [(0, "late"), (4, "deleted"), (4, "deleted"), (5, "deleted")]


def test_empty_sides(spark):
    r, p = refs(spark, [(1, "x", "1", T[5], None, None)]), spark.createDataFrame([], PARENTS)
    assert [x.reason for x in orphan_references(r, p, ["a", "b"], "at").collect()] == ["missing"]
    assert orphan_references(r.limit(0), p, ["a", "b"], "at").collect() == []
    with pytest.raises(ValueError):
        orphan_references(r, p, ["a", "b"], "at", "other")


TEXTS = [
    ("under section 12-3(a)(1) and sections 5A-6, [7-8.5](b), or 9:10A-11.", {"12-3", "5A-6", "7-8.5", "9:10A-11"}, set()),
    ("§§ 12\xad-3, 4‑5; SECTION\xa0[066-7] applies. Chapters 1, 22B, and 003", {"12-3", "4-5", "66-7"}, {"1", "22B", "3"}),
    ("26 U.S.C. §337-74; 42 United States Code section 1-2; administrative rules section 3-4; Revised Ordinances section 5-6; RL 1955, §7-8", set(), set()),
    ("section 4-298 of the Uniform Commercial Code, and section 4-299", {"4-299"}, set()),
    ("L 1996, c 329, §12. subsection 3-4; chapter 12-3; chapter upland; section 5", set(), set()),
    ("sections 1-2 and\n3-4 of this chapter", {"1-2", "3-4"}, set()),
    (None, set(), set()),
    ("", set(), set()),
]


def test_references_in_text(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(TEXTS)], "i int, t string")
    got = {r.i: r.r for r in df.select("i", text_references(F.col("t")).alias("r")).collect()}
    for i, (_, sections, chapters) in enumerate(TEXTS):
        assert {x.key for x in got[i] if x.kind == "section"} == sections
        assert {x.key for x in got[i] if x.kind == "chapter"} == chapters


def test_law_orphans_with_nulls_and_extra_columns(spark):
    parsed = spark.createDataFrame([(1, "§1-2", "1", "see §1-2 and §1-3, chapter 9", T[5], "x"), (2, None, None, None, T[5], "x"), (3, " [§0001‑2] ", "01", "", None, "x")], "record_id long, sectionNumber string, chapterNumber string, bodyText string, crawled_at timestamp, chapter string")
    targets = spark.createDataFrame([("1-2", T[0], None, "x")], "target_key string, added_at timestamp, dropped_at timestamp, k string")
    chapters = spark.createDataFrame([("1", T[7], None), (None, T[0], None)], "chapter_key string, added_at timestamp, dropped_at timestamp")
    assert rows(law_orphans(parsed, targets, chapters)) == [
        (1, "bodyText", "chapter", "9", "missing", "2024-06"),
        (1, "bodyText", "section", "1-3", "missing", "2024-06"),
        (1, "chapterNumber", "chapter", "1", "late", "2024-06"),
        (3, "chapterNumber", "chapter", "1", "late", None),
        (3, "sectionNumber", "section", "1-2", "late", None),
    ]
    assert law_orphans(parsed.limit(0), targets, chapters).collect() == []
