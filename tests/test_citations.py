from pyspark.sql import functions as F
from statloom.operators import citations as C
from statloom.operators import crossdoc as D
from statloom.operators import graph as G
from statloom.operators import layout as L

SECTIONS = ["26-34", "26-35", "11-1", "11-2", "11-5", "11-9", "431:1-100", "1-4.5", "634G-2"]
CHAPTERS = ["26", "11", "91", "431", "1"]


def inventory(spark):
    s = spark.createDataFrame([(k, f"§{k}", f"Title {k}.", f"/hrs/{k.replace(':', '-')}") for k in SECTIONS], "key string, number string, title string, href string")
    c = spark.createDataFrame([(k, k, f"Chapter {k}", f"/hrs/chapter/{k}") for k in CHAPTERS], "key string, number string, title string, href string")
    return s, c


CASES = [
    ("see section 26-34.", [("26-34", None)]),
    ("section 1-4.5. Next", [("1-4.5", None)]),
    ("section 26-34 and 26-35, or 431:1-100", [("26-34", None), ("26-35", None), ("431:1-100", None)]),
    ("sections [26-34] and §11-1", [("26-34", None), ("11-1", None), ("11-1", None)]),
    ("[§11-1]", [("11-1", None)]),
    ("chapter 91", [("91", None)]),
    ("chapters 91, 26, and 999", [("91", None), ("26", None), ("999", "unresolved")]),
    ("section 2 of the act", [("2", "bare-number")]),
    ("42 United States Code chapter 103", [("103", "foreign-law")]),
    ("chapter 7 of the Uniform Commercial Code", [("7", "foreign-law")]),
    ("section 11-200-3", [("11-200", "admin-rules")]),
    ("chapter 11-200", [("11-200", "admin-rules")]),
    ("H.R.S. §26-34", [("26-34", "superseded")]),
    ("R.L.H. 1955, §26-34; Id. §11-1", [("26-34", "superseded"), ("11-1", "superseded")]),
    ("Id. §11-1", [("11-1", None)]),
    ("section 26-99", [("26-99", "absent-section")]),
    ("section 77-99", [("77-99", "unresolved")]),
    ("section 643G-2", [("643G-2", None)]),
    ("no numbers", []),
    ("", []),
    (None, []),
]


def test_detection_and_resolution(spark):
    b = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, text string")
    aliases = spark.createDataFrame([("§643G-2", "§634G-2")], "observed string, corrected string")
    r = C.resolve(C.detect(b, ["i"], "text"), *inventory(spark), aliases)
    got = {}
    for x in r.orderBy("i", "seq").collect():
        got.setdefault(x.i, []).append((x.number, x.reason))
        assert (x.target is None) == (x.reason is not None)
    for i, (_, want) in enumerate(CASES):
        assert got.get(i, []) == want, CASES[i]
    t = {x.reason: x.n for x in C.tally(r).collect()}
    assert t["linked"] == sum(why is None for _, w in CASES for _, why in w) and set(t) == {"linked", *C.REASONS}


def test_spans_and_brackets():
    assert [("see section [26-34]"[s:e]) for s, e, *_ in C.candidates("see section [26-34]")] == ["section [26-34]"]
    assert [("[§11-1.52]"[s:e]) for s, e, *_ in C.candidates("[§11-1.52]")] == ["§11-1.52"]


def test_ranges(spark):
    b = spark.createDataFrame([(1, "sections 11-1 to 11-9"), (2, "sections 11-1, 11-9"), (3, "sections 11-1 to 26-35"), (4, "sections 11-9 to 11-1"), (5, "sections 11-1 to 11-2")], "i int, text string")
    got = sorted((x.i, x.number) for x in C.range_members(C.detect(b, ["i"], "text"), inventory(spark)[0], ["i"]).collect())
    assert got == [(1, "§11-2"), (1, "§11-5")]


CORPUS = "sectionNumber string, bodyText string, history string, docType string, title string, annotations array<struct<heading:string,text:string>>"


def test_graph(spark):
    s = spark.createDataFrame(
        [
            ("§26-34", "see section 26-35 and section 26-35; §26-34", "section 11-1", "hrs", "", [("Case Notes", "section 26-35; chapter 91")]),
            ("§26-35", "sections 11-1 to 11-9", None, "hrs", "", []),
            ("§11-1", "article XII, §7 of the Hawaii constitution", None, "hrs", "", None),
            ("CONST §12-7", "none", None, "const", "Rights", []),
            ("§11-2", None, None, "hrs", "", []),
        ],
        CORPUS,
    )
    e = G.build_graph(s, *inventory(spark))
    assert {tuple(r) for r in e.collect()} == {
        ("§26-34", "§26-35", "section", "body"), ("§26-34", "§26-35", "section", "annotation"), ("§26-34", "91", "chapter", "annotation"),
        ("§26-35", "§11-1", "section", "body"), ("§26-35", "§11-9", "section", "body"), ("§26-35", "§11-2", "section", "range"), ("§26-35", "§11-5", "section", "range"), ("§11-1", "CONST §12-7", "section", "body"),
    }
    lines = {r.node: r.json for r in G.graph_json(e).collect()}
    assert lines["91"] == '{"citedBy":[{"from":"§26-34","kind":"chapter","block":"annotation"}]}'
    assert [r.node for r in G.most_cited(e, 2).collect()] == ["§11-1", "§11-2"]


INDEX = {("const", "1-5"): "c15", ("const", "1-10"): "c110", ("const", "12-7"): "c127", ("uscon", "AM-5"): "u5", ("uscon", "AM-14"): "u14", ("org", "73"): "o73", ("hhca", "203"): "h203", ("adm", "4"): "a4", ("adm", "5"): "a5", ("org", "17"): "o17"}
CROSS = [
    ("article I, §5 of the Hawaii constitution", ["c15"]),
    ("Haw. Const. art. XII, §7", ["c127"]),
    ("the Fifth Amendment to the U.S. Constitution and by Article I, Section 10, of the Constitution of the State of Hawaii", ["u5", "c110"]),
    ("section 203 of the Hawaiian Homes Commission Act, 1920", ["h203"]),
    ("see notes to Organic Act §73. Legislative approval, see §171-64.7.", ["o73"]),
    ("§4 of the Admission Act; §5", ["a4"]),
    ("amendment XIV of the United States Constitution", ["u14"]),
    ("section 203 alone, and article I, §5", []),
    ("the Hawaii State Constitution", []),
    ("section 999 of the Organic Act", []),
    ("", []),
]


def test_other_documents(spark):
    t = spark.createDataFrame([(d, k, n, n) for (d, k), n in INDEX.items()], "doc_type string, key string, number string, label string")
    b = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(CROSS)] + [(-1, None)], "i int, text string")
    got = {}
    for r in D.detect_cross(b, ["i"], "text", t).orderBy("i", "start").collect():
        got.setdefault(r.i, []).append(r.number)
        assert CROSS[r.i][0][r.start : r.end] == r.cited
    assert got == {i: want for i, (_, want) in enumerate(CROSS) if want}


def test_only_documents_of_the_inventory_are_named(spark):
    t = spark.createDataFrame([("org", "5", "o5", "o5")], "doc_type string, key string, number string, label string")
    b = spark.createDataFrame([(1, "§5 of the Admission Act and the Organic Act")], "i int, text string")
    assert [r.number for r in D.detect_cross(b, ["i"], "text", t).collect()] == ["o5"]
    assert D.detect_cross(b, ["i"], "text", t.limit(0)).collect() == []


def test_an_inventory_of_any_size(spark):
    t = spark.range(50_000).selectExpr("'org' AS doc_type", "cast(id AS string) AS key", "concat('o', id) AS number", "concat('o', id) AS label")
    b = spark.createDataFrame([(i, f"see Organic Act §{i * 999}.") for i in range(60)], "i int, text string")
    assert {(r.i, r.number) for r in D.detect_cross(b, ["i"], "text", t).collect()} == {(i, f"o{i * 999}") for i in range(51)}


def test_a_node_that_very_many_cite(spark):
    e = spark.range(3000).selectExpr("concat('§1-', id) AS `from`", "'§9-9' AS `to`", "'section' AS kind", "'body' AS block").unionByName(spark.createDataFrame([("§9-9", "§1-1", "section", "body")], "`from` string, `to` string, kind string, block string"))
    at = [(r["from"], r.at) for r in G.numbered(e, "to", [F.length("from"), "from"]).where("to = '§9-9'").orderBy("at").collect()]
    assert [a for _, a in at] == list(range(3000)) and [f for f, _ in at] == [f"§1-{i}" for i in range(3000)]
    parts = {r.part: [x["from"] for x in r.citedBy] for r in G.adjacency(e, 1000).where("node = '§9-9' and citedBy is not null").collect()}
    assert sorted(parts) == [0, 1, 2] and parts[0] + parts[1] + parts[2] == [f"§1-{i}" for i in range(3000)]
    rows = L.cited_by(e, e.selectExpr("`from` AS number", "`from` AS label", "'' AS title"), 25, 1000).where("node = '§9-9'").orderBy("part").collect()
    assert [(r.part, r.n, r.folded, len(r.rows)) for r in rows] == [(k, 3000, True, 1000) for k in range(3)] and rows[1].rows[0].number == "§1-1000"
