import json

from pyspark.sql import functions as F
from statloom.operators import render as R
from statloom.sources import writers as W

SECTIONS = "number string, chapter string, title string, docType string, partHeading string, history string, isRepealed boolean, headingIsSupplied boolean, titleIsSupplied boolean, url string, filename string, covers struct<start:string,end:string,raw:string>, annotations array<struct<heading:string,text:string>>, sourceAnomalies array<struct<field:string,observed:string,corrected:string,confidence:string,evidence:string>>"


def test_section_and_chapter_pages(spark):
    s = spark.createDataFrame(
        [
            ("§1-2", "1", "A & B", "hrs", "[PART I.] START", "[L 1990, §1-1]", False, True, False, "https://x.org/a", "a.htm", None, [("Case Notes", "one\ntwo <b>")], [("sectionNumber", "§1-20", "§1-2", "conclusive", "Digits.")]),
            ("§1-10", "1", None, "hrs", None, None, True, False, False, None, "b.htm", ("§1-10", "§1-12", "to 12"), [], []),
            ("§9-1", "9", "X", "hrs", None, "", False, False, False, None, None, None, None, None),
        ],
        SECTIONS,
    )
    chapters = spark.createDataFrame([("1", "One"), ("2", None)], "chapter string, title string")
    bodies = spark.createDataFrame([("§1-2", None, "<p>text</p>")], "number string, title_html string, body_html string")
    cited = spark.createDataFrame([("§1-2", "Cited by", 1, 2, True, [("§9-1", "§9-1", None, False)]), ("§1-2", "Cited by", 0, 2, True, [("§1-10", "§1-10", "T <", True)])], "node string, list string, part long, n long, folded boolean, rows array<struct<number:string,label:string,title:string,in_range:boolean>>")
    got = {r.path: r.html for r in R.section_pages(s, bodies, cited, chapters).collect()}
    assert set(got) == {"/hrs/1-2", "/hrs/1-10", "/hrs/9-1"}
    a = got["/hrs/1-2"]
    for part in ("<h1>§1-20 A &amp; B</h1>", "heading supplied by the revisor", "the source reads §1-20, corrected to §1-2. Digits.", "<p>text</p>", '<p class="history">[L 1990, §1-1]</p>', "<p>two &lt;b&gt;</p>", "<details><summary>2 sections</summary>", "T &lt; (within a cited range)", 'rel="next" href="/hrs/1-10"', 'data-status="in force"', '<a href="https://x.org/a">a.htm</a>', '<a href="/hrs/chapter/1">Chapter 1 — One</a>'):
        assert part in a, part
    assert a.index("§1-10</a> T") < a.index("§9-1</a>")
    assert 'rel="prev"' not in a and "covers §1-10 to §1-12 · repealed" in got["/hrs/1-10"] and "<footer>" not in got["/hrs/9-1"]
    pages = {r.path: r.html for r in R.chapter_pages(s, chapters).collect()}
    assert '<p class="part">PART I. START (supplied by the revisor)</p><ol>' in pages["/hrs/chapter/1"] and "2 sections" in pages["/hrs/chapter/1"] and "<ol>" not in pages["/hrs/chapter/2"]


def test_volume_title_tree_home(spark):
    c = spark.createDataFrame([(1, "10", "Ten"), (1, "2A", "Two"), (2, "46", None)], "volume int, chapter string, title string")
    v = {r.path: r.html for r in R.volume_pages(c).collect()}
    assert v["/hrs/volume/1"].index("Chapter 2A") < v["/hrs/volume/1"].index("Chapter 10") and "1 chapter<" in v["/hrs/volume/2"]
    t = spark.createDataFrame([("6", "COUNTY", 1, [("Subtitle 1. X", [("46", "General")])])], "number string, name string, division_number int, listing array<struct<subtitle:string,chapters:array<struct<number:string,name:string>>>>")
    d = spark.createDataFrame([(1, "GOVERNMENT")], "division_number int, division_name string")
    (p,) = R.title_pages(t, d).collect()
    assert p.path == "/hrs/title/6" and "<h2>Subtitle 1. X</h2>" in p.html and "Division 1. GOVERNMENT" in p.html
    o = spark.createDataFrame([("05-CONST", "Constitution")], "chapter string, title string")
    assert [r.title for r in R.tree_rows(t, d, o).collect()] == ["6", "05-CONST"]
    assert '<a href="/hrs/volume/2">Volume 2</a>' in R.home_page(c, c).first().html
    assert set(R.fixed_pages()) == {"/search", "/404"}
    j = json.loads(W.hierarchy_json(d.select(F.col("division_number").alias("number"), F.col("division_name").alias("name")), t).first().json)
    assert j["divisions"] == [{"number": 1, "name": "GOVERNMENT"}] and j["titles"][0]["number"] == "6"


def test_pages_are_files_and_a_full_build_owns_its_folders(spark, tmp_path):
    p = lambda rows: spark.createDataFrame(rows, "path string, html string")
    out = tmp_path / "site"
    there = lambda: {str(f.relative_to(out)): f.read_text() for f in out.rglob("*") if f.is_file()}
    assert {tuple(r) for r in W.write_pages(p([("/hrs/1", "ā"), ("/", "home"), ("/robots.txt", "x"), (None, "y"), ("/hrs/5", None)]), str(out)).collect()} == {("/hrs/1", 2), ("/", 4), ("/robots.txt", 1), ("/hrs/5", 0)}
    W.write_pages(p([("/hrs/2", "c")]), f"file://{out}")
    assert there() == {"hrs/1/index.html": "ā", "index.html": "home", "robots.txt": "x", "hrs/2/index.html": "c", "hrs/5/index.html": ""}
    W.write_pages(p([("/hrs/3", "d")]), str(out), owned=["hrs", "none"])
    assert there() == {"hrs/3/index.html": "d", "index.html": "home", "robots.txt": "x"}


def test_migration_may_run_again(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS side LOCATION 'file://{tmp_path}/side'")
    try:
        assert W.migrate(spark, "side") == W.migrate(spark, "side") == ["chapters", "sections", "volumes"]
        assert spark.table("side.sections").count() == 0
    finally:
        spark.sql("DROP DATABASE side CASCADE")
