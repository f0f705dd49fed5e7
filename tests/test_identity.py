from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from statloom.functions import identity as I
from statloom.functions import text as X

NAMES = [
    ("HRS_0001-0002.htm", "§1-2", "1", "hrs"),
    ("HRS_0001-0004_0005.htm", "§1-4.5", "1", "hrs"),
    ("HRS_0431-0001-0100.htm", "§431:1-100", "431", "hrs"),
    ("HRS_0431-0010A-0100_0005.htm", "§431:10A-100.5", "431", "hrs"),
    ("HRS_0011-0001_0005_0002.htm", "§11-1.52", "11", "hrs"),
    ("HRS_0006D-0001.htm", "§6D-1", "6D", "hrs"),
    ("HRS_0039a-0112.htm", "§39A-112", "39A", "hrs"),
    ("HRS_0291-0024\xad_0004.docx.htm", "§291-24.4", "291", "hrs"),
    ("HRS_0327-0001_[OLD].htm", "§327-1 [OLD]", "327", "hrs"),
    ("HRS_0001-.htm", "§1", "1", "hrs"),
    ("CONST_0001-0005.htm", "CONST §1-5", "CONST", "const"),
    ("HHCA_0220_0005.htm", "HHCA §220.5", "HHCA", "hhca"),
    ("0001-0002.html", "§1-2", "1", "hrs"),
]


def one(spark, values, *columns):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def test_file_names(spark):
    v = F.col("v")
    got = one(spark, [n[0] for n in NAMES], I.number_of_file(v), I.chapter_of_file(v), I.doc_type(v))
    assert got == [n[1:] for n in NAMES]
    assert one(spark, ["HRS_0001-.htm", "HRS_0001_.htm", "HRS_.htm", "HRS_0001-0002.htm"], I.is_index_file(v)) == [(True,), (True,), (True,), (False,)]
    assert one(spark, ["HRS0001", "HRS0431K", "05-CONST", "hrs0012a"], I.chapter_of_directory(v)) == [("1",), ("431K",), ("05-CONST",), ("12A",)]


def test_slugs_and_keys(spark):
    v = F.col("v")
    assert one(spark, ["§431:1-100", "CONST §1-5", "§327-1 [OLD]", "§ 1-2"], I.slug(v), I.citation_key(v)) == [("431-1-100", "431:1-100"), ("CONST-1-5", "CONST §1-5"), ("327-1-old", "327-1"), ("1-2", " 1-2")]


RANGES = [
    ("to 131 REPEALED.", "§39-125", "§39-131", "to 131", "REPEALED."),
    ("to 515-12. REPEALED.", "§515-10", "§515-12", "to 515-12.", "REPEALED."),
    ("to 602-24, 602-31 to 602-34, 602-36, and 602-37 REPEALED", "§602-20", "§602-37", "to 602-24, 602-31 to 602-34, 602-36, and 602-37", "REPEALED"),
    ("to 349-14 Renumbered as §§349-21 to 349-23.", "§349-11", "§349-14", "to 349-14", "Renumbered as §§349-21 to 349-23."),
    ("to 431:10A-531 X", "§431:10A-521", "§431:10A-531", "to 431:10A-531", "X"),
    ("To heirs.", "§1-2", None, None, None),
    ("Title to 5", "§1-2", None, None, None),
]


def test_ranges(spark):
    df = spark.createDataFrame([(i, r[0], r[1]) for i, r in enumerate(RANGES)], "i int, v string, s string")
    got = [r.r for r in df.select("i", I.range_of_title(F.col("v"), F.col("s")).alias("r")).orderBy("i").collect()]
    assert [(r and r.end, r and r.raw, r and r.title) for r in got] == [r[2:] for r in RANGES]


DISPLAY = [
    ("const", "CONST §12-7", "Haw. Const. art. XII, §7"), ("const", "CONST §AM-1", "Haw. Const. amend. I"), ("uscon", "USCON §AM-14-1", "U.S. Const. amend. XIV, §1"), ("uscon", "USCON §4", "U.S. Const. art. IV"),
    ("org", "ORG §73", "Organic Act §73"), ("adm", "ADM §5", "Admission Act §5"), ("hhca", "HHCA §203", "HHCA §203"), ("hnp", "HNP §1", "Hawaii National Park Act §1"), ("hrs", "§1-2", "§1-2"),
]


def test_display_citations(spark):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(DISPLAY)], "i int, d string, n string, w string")
    assert df.where(I.proper_citation(F.col("d"), F.col("n")) != F.col("w")).count() == 0


def test_numbers(spark):
    got = one(spark, ["7", "XIV", "xxvii", "xxviii", "Twenty first", "fourteenth", "zeroth", ""], I.number_of(F.col("v")))
    assert [g[0] for g in got] == [7, 14, 27, None, 21, 14, None, None]


def test_natural_order(spark):
    df = spark.createDataFrame([("1-10",), ("1-2",), ("10-1",), ("2A-1",), ("2-1",)], "v string")
    assert [r.v for r in df.orderBy(I.natural_key(F.col("v"))).collect()] == ["1-2", "1-10", "2-1", "2A-1", "10-1"]


REPEALS = [("REPEALED.", "x", True), ("a", "Repealed. L 1", True), ("a", "[Section repealed by L 1]", True), ("a", "§§15-7, 15-8 REPEALED. L 2019", True), ("a", "the repealed law", False), (None, None, False)]


def test_repealed(spark):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(REPEALS)], "i int, t string, b string, w boolean")
    assert df.where(X.is_repealed(F.col("t"), F.col("b")) != F.col("w")).count() == 0


def test_history(spark):
    v = F.col("v")
    texts = ["Body. [L 1990, c 5] more [am L 1991, c 6]", "[Repealed. L 1990]", "no [brackets] year", "a [1999] b [1999]"]
    assert one(spark, texts, X.history_of(v), X.without_history(v)) == [("[am L 1991, c 6]", "Body. [L 1990, c 5] more"), ("[Repealed. L 1990]", "[Repealed. L 1990]"), ("", "no [brackets] year"), ("[1999]", "a [1999] b")]


def test_words_numbers_labels(spark):
    v = F.col("v")
    assert one(spark, ["The Court's riparian- rights, l'eau"], X.words(v)) == [(["court's", "riparian", "rights", "l'eau"],)]
    assert [x[0] for x in one(spark, [" § 26-34 ", "431:10c-301", "26", "abc-1"], X.query_number(v))] == ["26-34", "431:10C-301", None, None]
    assert [x[0] for x in one(spark, ["DUE PROCESS", "Due process", "ARTICLE IV", "X" * 91, "", None], X.is_catchline(v))] == [True, False, False, False, False, False]
    assert [x[0] for x in one(spark, ["/x/access.log.2025-01-01", "/x/access.log", "/x/error.log-20250101.gz"], X.is_rotated_log(v))] == [True, False, True]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9999), st.sampled_from(["", "A", "K"]), st.integers(1, 9999), st.integers(0, 99)), min_size=1, max_size=8))
def test_names_and_numbers_agree(spark, parts):
    names = [(f"HRS_{c:04d}{a}-{s:04d}" + (f"_{x:04d}" if x else "") + ".htm", f"§{c}{a}-{s}" + (f".{x}" if x else "")) for c, a, s, x in parts]
    assert [g[0] for g in one(spark, [n for n, _ in names], I.number_of_file(F.col("v")))] == [w for _, w in names]
