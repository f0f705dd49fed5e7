import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from statloom.operators import citations as C
from statloom.operators import corrections as K
from statloom.operators import layout as L
from statloom.operators import pages as P
from statloom.operators import search as S

from tests.conftest import rows
from tests.test_citations import inventory

OUTLINES = [
    (["(a) x", "(1) y", "(A) z", "(i) w", "(ii) v", "(2) u", "(b) t"], [1, 2, 3, 4, 4, 2, 1]),
    (["(1) x", "(2) y", "(A) z"], [1, 1, 2]),
    (["(h) x", "(i) y", "(j) z"], [1, 1, 1]),
    (["(a) x", "(i) y", "(ii) z", "(b) w"], [1, 2, 2, 1]),
    (["plain", "(a) x", "more", "(1) y", "rest"], [0, 1, 1, 2, 2]),
    ([], []),
]


@pytest.mark.parametrize("paragraphs,want", OUTLINES)
def test_depths(paragraphs, want):
    assert L.depths(paragraphs) == want


def test_groups_and_pager(spark):
    df = spark.createDataFrame([("1", "1-1", None), ("1", "1-2", "PART I"), ("1", "1-10", None), ("1", "1-3", "PART I"), ("1", "1-11", "PART II"), ("2", "2-1", "PART I")], "chapter string, number string, part string")
    got = {r.number: (r.open_part, r.group_no, r.previous, r.next, r.position) for r in L.display_rows(df, "chapter", "number", "part").collect()}
    assert got == {"1-1": (None, 1, None, "1-2", 1), "1-2": ("PART I", 2, "1-1", "1-3", 2), "1-3": ("PART I", 2, "1-2", "1-10", 3), "1-10": ("PART I", 2, "1-3", "1-11", 4), "1-11": ("PART II", 3, "1-10", None, 5), "2-1": ("PART I", 1, None, None, 1)}
    with pytest.raises(ValueError):
        L.require_carried(L.carry_forward(df, "part", L.ordered("number"), "chapter"), "open_part", "number")


def test_links(spark):
    t = spark.createDataFrame([(1, 'A & "b" section 26-34, then §26-99 & chapter 91.'), (2, "none <b>"), (3, "")], "i int, text string")
    r = C.resolve(C.detect(t, ["i"], "text"), *inventory(spark))
    got = {x.i: x.html for x in L.linked(t, r, ["i"], "text").collect()}
    assert got[1] == (
        'A &amp; &quot;b&quot; <a href="/hrs/26-34" aria-label="section 26-34, Title 26-34">section 26-34</a>, then <span class="absent">§26-99<span class="sr-only"> (not in the current code)</span></span>'
        ' &amp; <a href="/hrs/chapter/91" aria-label="chapter 91, Chapter 91">chapter 91</a>.'
    )
    assert got[2] == "none &lt;b&gt;" and got[3] == ""


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=7), st.text("abc", max_size=7))
def test_distance_laws(a, b):
    d = S.osa(a, b, 9)
    assert d == S.osa(b, a, 9) and (d == 0) == (a == b) and d >= abs(len(a) - len(b)) and S.osa(a, b, 2) == min(d, 3)


def test_distances():
    assert [S.osa(a, b, 5) for a, b in (("marijauna", "marijuana"), ("ca", "abc"), ("kitten", "sitting"), ("", "ab"))] == [1, 3, 3, 2]


def test_spelling(spark):
    v = spark.createDataFrame([(w,) for w in "marijuana mariana riparian statute statutes cannabis court".split()], "word string")
    queries = ["marijauna law", "riparian rights statute", "stat", "statut", "cannabus ", "26-34", "the zzzzzz", "court statues riparian"]
    q = spark.createDataFrame([(x,) for x in queries], "query string")
    got = {r.query: (r.unknown, r.suggestion, r.state) for r in S.check_spelling(q, v).collect()}
    assert got == {
        "marijauna law": ("marijauna", "marijuana", "absent"), "riparian rights statute": ("rights", None, "absent"), "stat": (None, None, "ok"), "statut": ("statut", None, "typing"),
        "cannabus ": ("cannabus", "cannabis", "absent"), "26-34": (None, None, "ok"), "the zzzzzz": ("zzzzzz", None, "absent"), "court statues riparian": ("statues", "statutes", "absent"),
    }
    assert {r.query: r.fixed for r in S.apply_fix(S.check_spelling(q, v)).collect()}["marijauna law"] == "marijuana law"
    pages = spark.createDataFrame([("/hrs/431-10C-301",)], "href string")
    assert [tuple(r) for r in S.jumps(spark.createDataFrame([("431:10c-301",), ("1-2",), ("x",)], "query string"), pages).collect()] == [("431:10c-301", "431:10C-301", "/hrs/431-10C-301")]


def test_search(spark, tmp_path):
    s = spark.createDataFrame([("a", "Fire alarm", "fire"), ("b", "x", "the fire alarm rang; alarm"), ("c", "alarm", "no"), ("d", None, None), ("e", "fire alarm", "repealed")], "sectionNumber string, title string, bodyText string")
    assert [r.sectionNumber for r in S.search(s, "fire alarm").collect()] == ["a", "e", "b"]
    assert [r.sectionNumber for r in S.search(s, '"fire alarm" -repealed').collect()] == ["a", "b"]
    assert S.search(s, "").count() == 0
    path = str(tmp_path / "index")
    S.write_index(S.posting_rows(s), path)
    for q in ("fire alarm", '"fire alarm" -repealed', "rang fire", "fire fire", "fire -alarm", "nothing", "ALARM"):
        assert rows(S.search(s, q, index=path)) == rows(S.search(s, q)), q
    assert rows(S.search(s, "fire alarm", k=1, offset=1, index=path)) == rows(S.search(s, "fire alarm", k=1, offset=1))
    plan = S.postings_of(spark, path, ["fire", "alarm"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [part" in plan and "In(term" in plan
    assert "<mark>fire</mark>" in S.search(s, "rang fire").first().snippet


LEDGER = [("f1", "sectionNumber", "§643G-2", "§634G-2", "conclusive", "seen", "2026-01-01"), ("f2", "sectionNumber", "§1-1", None, "flagged", "seen", "2026-01-01"), ("f3", "sectionNumber", "§9-9", "§9-8", "conclusive", "seen", "2026-01-01")]


def test_corrections(spark):
    ledger = spark.createDataFrame(LEDGER, K.SCHEMA)
    anomalies = "array<struct<field:string,observed:string,corrected:string,confidence:string,evidence:string>>"
    s = spark.createDataFrame([("f1", "§643G-2", "page", []), ("f2", "§1-1", "page", None), ("f3", "§9-7", "page", []), ("f4", "§1-2", "page", [])], f"filename string, sectionNumber string, numberSource string, sourceAnomalies {anomalies}")
    got = {r.filename: (r.sectionNumber, r.numberSource, [tuple(a)[1:4] for a in r.sourceAnomalies], r.warning) for r in K.apply_corrections(s, K.check_ledger(ledger)).collect()}
    assert got == {
        "f1": ("§634G-2", "correction", [("§643G-2", "§634G-2", "conclusive")], None),
        "f2": ("§1-1", "page", [("§1-1", None, "flagged")], None),
        "f3": ("§9-7", "page", [], "not applied: observed §9-9, found §9-7"),
        "f4": ("§1-2", "page", [], None),
    }
    assert [tuple(r) for r in K.number_aliases(ledger).orderBy("observed").collect()] == [("§643G-2", "§634G-2"), ("§9-9", "§9-8")]


@pytest.mark.parametrize("bad,say", [((3, None), "needs"), ((4, "flagged"), "must not carry"), ((4, "probably"), "conclusive"), ((1, "bodyText"), "not correctable"), ((5, ""), "required")])
def test_ledger_rules(spark, bad, say):
    row = list(LEDGER[0])
    row[bad[0]] = bad[1]
    with pytest.raises(ValueError, match=say):
        K.check_ledger(spark.createDataFrame([tuple(row)], K.SCHEMA))
    with pytest.raises(ValueError, match="duplicate entry"):
        K.check_ledger(spark.createDataFrame([LEDGER[0], LEDGER[0]], K.SCHEMA))


# --- pages -------------------------------------------------------------------------------------

PAGES = {
    "HRS_0026-0012.htm": '<div class="WordSection1"><p class=RegularParagraphs>[PART IV. SUPPLIED]</p><p><b>§26</b>-<b>12 Department of education. </b>(a)<b> </b>The department [L 1990, c 1; am L 1991, c 2]</p><p class="XNotesHeading">Cross References</p><p class=XNotes>See chapter 5.<p class=XNotes> More. <p class=XNotesHeading>Case Notes</p><p class="XNotes">Case.</p></div>',
    "HRS_0440G-0016.htm": "<body><p><b>[§440G&#8209;16&nbsp; Rules.]</b> The body.</p></body>",
    "HRS_0604-0013.htm": "<body><p><b>§604-13 [Arrest under warrant.]</b> The body.</p></body>",
    "HRS_0515-0011.htm": "<body><p><b>§515-10 to 515-12. REPEALED.</b> L 1990, c 5.</p></body>",
    "HRS_0327-0031.htm": "<body><p><b>§327-21 Other.</b> One.</p><p><b>§327-31 Own.</b> Two.</p></body>",
    "CONST_0001-0005.htm": '<body><p align=center>ARTICLE I</p><p align=center>BILL OF RIGHTS</p><p>&nbsp;</p><p align="center">DUE PROCESS AND</p><p align="center">EQUAL PROTECTION</p><p><b>Section 5.</b> No person shall.</p></body>',
    "ORG_0073.htm": "<body><p><b>§73. Commissioner of public lands.</b> (a) Text.</p></body>",
    "HRS_0001-0099.htm": "<body><div id=pageLinks><p>Previous</p></div><p>Only text.</p><script>x</script></body>",
    "HRS_0001-0100.htm": None,
}


def test_sections_of_pages(spark):
    df = spark.createDataFrame(list(PAGES.items()), "filename string, html string")
    got = {r.filename: r for r in P.parse_sections(df).collect()}
    a = got["HRS_0026-0012.htm"]
    assert (a.sectionNumber, a.title, a.partHeading, a.bodyText, a.history) == ("§26-12", "Department of education.", "[PART IV. SUPPLIED]", "(a) The department", "[L 1990, c 1; am L 1991, c 2]")
    assert (a.crossReferences, a.caseNotes, len(a.annotations), a.numberSource) == (["See chapter 5.", "More."], "Case.", 2, "page")
    b = got["HRS_0440G-0016.htm"]
    assert (b.sectionNumber, b.title, b.headingIsSupplied, b.titleIsSupplied) == ("§440G-16", "Rules.", True, False)
    c = got["HRS_0604-0013.htm"]
    assert (c.title, c.headingIsSupplied, c.titleIsSupplied) == ("Arrest under warrant.", False, True)
    d = got["HRS_0515-0011.htm"]
    assert (d.sectionNumber, d.title, d.numberSource, d.isRepealed, d.covers.end) == ("§515-11", "REPEALED.", "page-range", True, "§515-12")
    assert got["HRS_0327-0031.htm"].sectionNumber == "§327-31" and got["HRS_0327-0031.htm"].title == "Own."
    e = got["CONST_0001-0005.htm"]
    assert (e.sectionNumber, e.title, e.partHeading, e.bodyText, e.numberSource) == ("CONST §1-5", "DUE PROCESS AND EQUAL PROTECTION", "ARTICLE I — BILL OF RIGHTS", "No person shall.", "filename")
    assert (got["ORG_0073.htm"].sectionNumber, got["ORG_0073.htm"].title, got["ORG_0073.htm"].docType) == ("ORG §73", "Commissioner of public lands.", "org")
    assert (got["HRS_0001-0099.htm"].bodyText, got["HRS_0001-0099.htm"].numberSource) == ("Only text.", "filename")
    assert got["HRS_0001-0100.htm"].bodyText == ""


TITLE_PAGE = """<body><p class=RegularParagraphs>DIVISION 1. GOVERNMENT</p><p class=RegularParagraphs>TITLE 6. COUNTY</p><p class=RegularParagraphs>ORGANIZATION</p><p class=XNotes>A note.</p>
<p class=RegularParagraphs>Chapter</p><p class=RegularParagraphs>47C Indebtedness, Exclusions from</p><p class=RegularParagraphs>the Funded Debt</p><p class=RegularParagraphs>Subtitle 2. Land</p><p class=RegularParagraphs>48 Roads</p>
<p class=RegularParagraphs>CHAPTER 46</p><p class=RegularParagraphs>GENERAL PROVISIONS</p><p class=XNotesHeading>Note</p><p class=XNotes>Text.</p><p>Section</p><p>46-1 Definitions of</p><p>terms</p><p>46-2 Powers</p><p>PART II</p><p>46-3 More</p></body>"""


def test_index_pages(spark):
    df = spark.createDataFrame([("46", TITLE_PAGE), ("7", "<p>CHAPTER 7 [OLD]</p><p>CHAPTER 7</p><p>911 SERVICES</p>"), ("8", None)], "chapter string, html string")
    assert [(r.chapter, r.number, r.row_title) for r in P.parse_listings(df).orderBy("chapter", "pos").collect()] == [("46", "46-1", "Definitions of terms"), ("46", "46-2", "Powers"), ("46", "46-3", "More")]
    c = {r.chapter: (r.title, len(r.annotations)) for r in P.parse_chapter_indexes(df, "chapter").collect()}
    assert c == {"46": ("GENERAL PROVISIONS", 1), "7": ("911 SERVICES", 0), "8": ("", 0)}
    (t,) = P.parse_title_banners(df, "chapter").collect()
    assert (t.number, t.name, t.division_number, t.notes) == ("6", "COUNTY ORGANIZATION", 1, "A note.")
    assert [(g.subtitle, [(x.number, x.name) for x in g.chapters]) for g in t.listing] == [(None, [("47C", "Indebtedness, Exclusions from the Funded Debt")]), ("Subtitle 2. Land", [("48", "Roads")])]
    d = spark.createDataFrame([("https://x.org/a/", '<a href="/">up</a><a href="b/">b</a><a HREF="c%20d.htm">c</a><a href="b/e.htm">e</a><a>n</a>')], "base string, html string")
    assert sorted((r.name, r.is_dir) for r in P.directory_entries(d, "base").collect()) == [("b", True), ("c d.htm", False)]


