import json

import pytest
from pyspark.sql import functions as F
from statloom.operators import inventory as V
from statloom.schema import SECTION_FIELDS
from statloom.sources import readers as R
from statloom.sources import writers as W
from statloom.streaming.ingest import ingest, page_stream

from tests.conftest import rows

RECORD = dict.fromkeys(SECTION_FIELDS, "")
RECORD |= {"sectionNumber": "§1-2", "title": "A “title”", "partHeading": None, "crossReferences": ["x"], "annotations": [{"heading": "h", "text": "t\nu"}], "headingIsSupplied": False, "isRepealed": True, "covers": None, "titleIsSupplied": False, "sourceAnomalies": [], "filename": "HRS_0001-0002.htm"}


def test_records_round_trip(spark, tmp_path):
    text = json.dumps(RECORD, ensure_ascii=False, indent=2) + "\n"
    (tmp_path / "a.json").write_text(text)
    df = R.json_records(spark, str(tmp_path), keep_html=True)
    assert W.pretty_json(df, "filename").first().json == text
    assert "bodyHtml" not in R.json_records(spark, str(tmp_path)).columns
    extra = df.withColumn("added", F.lit(1))
    assert list(json.loads(W.pretty_json(extra, "filename").first().json))[-1] == "added"


def test_missing_files_are_empty(spark, tmp_path):
    assert R.ledger(spark, str(tmp_path / "none.json")).count() == 0
    good = {"version": 1, "corrections": [{"filename": "f", "field": "sectionNumber", "observed": "§1-1", "corrected": "§1-2", "confidence": "conclusive", "evidence": "e", "reviewedOn": "2026-01-01"}]}
    (tmp_path / "l.json").write_text(json.dumps(good))
    assert R.ledger(spark, str(tmp_path / "l.json")).count() == 1
    good["corrections"][0]["confidence"] = "maybe"
    (tmp_path / "b.json").write_text(json.dumps(good))
    with pytest.raises(ValueError):
        R.ledger(spark, str(tmp_path / "b.json"))


def test_manifest(spark, tmp_path):
    files = spark.createDataFrame([(1, "1", "One", "a.htm", "u/a", False), (1, "1", "One", "b.htm", "u/b", True), (2, "6D", "Six", "c.htm", "u/c", False)], "volume int, chapter string, title string, filename string, url string, is_index boolean")
    m = V.nest_manifest(files)
    assert rows(V.flatten_manifest(m)) == rows(files)
    assert tuple(V.manifest_totals(m).first()) == (2, 2, 3)


def test_cached_pages_and_stream(spark, tmp_path):
    src, out, ck = tmp_path / "in", tmp_path / "out", tmp_path / "ck"
    src.mkdir()
    (src / "a.htm").write_text("<p>one</p>\n<p>two</p>")
    jobs = spark.createDataFrame([("a.htm",), ("b.htm",)], "filename string")
    assert {r.filename: r.html for r in R.cached_pages(spark, str(src), jobs).collect()} == {"a.htm": "<p>one</p>\n<p>two</p>", "b.htm": None}
    for name in (None, "b.htm", None):
        if name:
            (src / name).write_text("x")
        ingest(page_stream(spark, str(src)), str(out), str(ck)).awaitTermination()
    assert sorted(r.filename for r in spark.read.parquet(str(out)).collect()) == ["a.htm", "b.htm"]


def test_conditional_writes(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(f"k{i}", "v") for i in range(50)], "k string, v string")
    assert {r.state: r.n for r in W.write_changed(old, path, "k").collect()} == {"created": 50}
    new = old.withColumn("v", F.when(F.col("k") == "k7", "w").otherwise(F.col("v"))).unionByName(spark.createDataFrame([("n", "v")], "k string, v string"))
    assert {r.state: r.n for r in W.write_changed(new, path, "k").collect()} == {"created": 1, "changed": 1, "unchanged": 49}
    got = {r.k: r.v for r in spark.read.parquet(path).collect()}
    assert len(got) == 51 and got["k7"] == "w"


def test_texts(spark, tmp_path):
    v = spark.createDataFrame([("b",), ("a",)], "word string")
    W.write_words(v, str(tmp_path / "w"))
    assert [r.word for r in R.word_list(spark, str(tmp_path / "w")).collect()] == ["a", "b"]
    ((name, xml),) = W.sitemap_files("https://x.org/", spark.createDataFrame([("/b&c",), ("/a",), ("/a",), (None,)], "path string")).collect()
    assert name == "sitemap.xml"
    assert xml == '<?xml version="1.0" encoding="UTF-8"?>\n<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">\n  <url><loc>https://x.org/a</loc></url>\n  <url><loc>https://x.org/b&amp;c</loc></url>\n</urlset>\n'
    many = {r.name: r.xml for r in W.sitemap_files("https://x.org", spark.range(1003).selectExpr("concat('/p', id) AS path"), most=100).collect()}
    assert max(x.count("<url>") for x in many.values()) <= 100 and sum(x.count("<url>") for x in many.values()) == 1003
    assert all(f"<loc>https://x.org/{n}</loc>" in many["sitemap.xml"] for n in many if n != "sitemap.xml") and many["sitemap.xml"].count("<sitemap>") == len(many) - 1 >= 11
    none = W.sitemap_files("https://x.org", spark.range(0).selectExpr("cast(id AS string) AS path")).collect()
    assert len(none) <= 1
    assert W.robots("https://x.org").endswith("\nSitemap: https://x.org/sitemap.xml\n") and "Sitemap" not in W.robots()
    (tmp_path / "logs" / "x.org").mkdir(parents=True)
    for day in ("2025-01-01", "2025-01-03"):
        (tmp_path / "logs" / "x.org" / f"access.log-{day}.gz").write_bytes(b"12345")
    assert tuple(R.log_summary(R.log_files(spark, str(tmp_path / "logs"))).first()) == ("x.org", 2, "2025-01-01", "2025-01-03", 10)
    c = spark.createDataFrame([("10", "Ten", 2, "", []), ("9", "Nine", 1, "n", [("h", "t")])], "chapter string, title string, volume int, notes string, annotations array<struct<heading:string,text:string>>")
    assert [tuple(r) for r in W.chapter_map(c).collect()] == [("9", '{"title":"Nine","volume":1,"notes":"n","annotations":[{"heading":"h","text":"t"}]}'), ("10", '{"title":"Ten","volume":2}')]


def test_checks(spark):
    s = spark.createDataFrame([("§1:2-3",), ("§1-2-3",)], "sectionNumber string")
    with pytest.raises(ValueError):
        V.check_slugs(s)
    req = spark.createDataFrame([("a",), ("b",)], "path string")
    assert [r.path for r in V.missing_required(req, req.where("path = 'a'")).collect()] == ["b"]
    old = spark.createDataFrame([("§1-2 [OLD]", "old", "hrs"), ("§1-2", "live", "hrs"), ("CONST §1-2", "c", "const")], "sectionNumber string, title string, docType string")
    assert [tuple(r) for r in V.section_targets(old).collect()] == [("1-2", "§1-2", "live", "/hrs/1-2")]
