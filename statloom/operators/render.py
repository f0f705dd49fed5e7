"""Pages as HTML, put together by expressions from the data behind them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions import text as X
from statloom.functions.identity import href, natural_key, proper_citation
from statloom.operators.layout import display_rows

_esc = X.escape_html


def _cat(*parts: Column | str) -> Column:
    """Concatenation in which a missing part is nothing."""
    return F.concat(*(F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("")) for p in parts))


def _if(value: Column, *parts: Column | str) -> Column:
    """The parts where the value is neither null nor empty."""
    return F.when(F.coalesce(value, F.lit("")) != "", _cat(*parts)).otherwise("")


def _trail(*steps: tuple[Column | str | None, Column | str]) -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.array(*(F.struct(lit(h).cast("string").alias("href"), lit(label).alias("label")) for h, label in steps))


def page(title: Column, crumbs: Column, body: Column, footer: Column | None = None, facets: dict[str, Column] | None = None) -> Column:
    """The shell of a page. crumbs: array<struct<href, label>>; facets go to the text index as attributes."""
    trail = F.array_join(F.transform(crumbs, lambda c: F.when(c["href"].isNotNull(), F.concat(F.lit('<a href="'), c["href"], F.lit('">'), _esc(c["label"]), F.lit("</a>"))).otherwise(_esc(c["label"]))), " › ")
    marks = _cat(*(x for k, v in (facets or {}).items() for x in (f' data-{k}="', _esc(v), '"')))
    return _cat('<!doctype html>\n<html lang="en"><head><meta charset="utf-8"><title>', _esc(title), "</title></head>\n<body><nav>", trail, "</nav>\n<main", marks, ">\n", body, "\n</main>\n", footer if footer is not None else F.lit(""), "</body></html>\n")


def source_footer(url: Column, filename: Column) -> Column:
    return _if(filename, '<footer>Source: ', F.when(F.coalesce(url, F.lit("")) != "", F.concat(F.lit('<a href="'), _esc(url), F.lit('">'), _esc(filename), F.lit("</a>"))).otherwise(_esc(filename)), "</footer>\n")


def anomaly_note(anomalies: Column) -> Column:
    """What the source says and what it was corrected to, one line each."""
    line = lambda a: _cat("<li>", _esc(a["field"]), ": the source reads ", _esc(a["observed"]), F.when(a["corrected"].isNotNull(), F.concat(F.lit(", corrected to "), _esc(a["corrected"]))), ". ", _esc(a["evidence"]), "</li>")
    return F.when(F.size(anomalies) > 0, _cat('<ul class="note">', F.array_join(F.transform(anomalies, line), ""), "</ul>\n")).otherwise("")


def note_blocks(annotations: Column, weight: float = 0.4) -> Column:
    """Annotations under their headings, marked to count less in the text index."""
    para = lambda t: F.array_join(F.transform(F.split(t, "\n"), lambda p: _cat("<p>", _esc(p), "</p>")), "\n")
    block = lambda a: _cat("<h2>", _esc(a["heading"]), "</h2>\n", para(a["text"]), "\n")
    return F.when(F.size(annotations) > 0, _cat(f'<aside data-weight="{weight}">\n', F.array_join(F.transform(annotations, block), ""), "</aside>\n")).otherwise("")


def _cited(rows: DataFrame) -> DataFrame:
    """(node, html) of the lists of what cites each node; long ones folded. A page is one text, so all parts of its lists come together here."""
    item = lambda r: _cat('<li><a href="', href("section", r["number"]), '">', _esc(r["label"]), "</a> ", _esc(r["title"]), F.when(r["in_range"], " (within a cited range)"), "</li>")
    parts = rows.select("node", "list", "n", "folded", F.struct("part", F.array_join(F.transform("rows", item), "").alias("h")).alias("p"))
    whole = parts.groupBy("node", "list", "n", "folded").agg(F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda x: x["h"]), "").alias("items"))
    many = X.count_label(F.col("n"), "section", "sections")
    body = _cat("<ul>", F.col("items"), "</ul>")
    html = _cat("<h2>", F.col("list"), "</h2>\n", F.when(F.col("folded"), F.concat(F.lit("<details><summary>"), many, F.lit("</summary>"), body, F.lit("</details>"))).otherwise(F.concat(F.lit("<p>"), many, F.lit("</p>"), body)), "\n")
    return whole.select("node", "list", html.alias("h")).groupBy("node").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("list", "h"))), lambda x: x["h"]), "").alias("cited_html"))


def section_pages(sections: DataFrame, bodies: DataFrame, cited_by: DataFrame, chapters: DataFrame) -> DataFrame:
    """(path, html) of section pages.

    sections: records with ``number`` and ``chapter``; bodies: (number, title_html, body_html) with links in; cited_by: what ``layout.cited_by`` gives;
    chapters: (chapter, title). The history is escaped and never linked.
    """
    s = display_rows(sections, "chapter", "number", "partHeading")
    s = s.join(bodies, "number", "left").join(_cited(cited_by), F.col("number") == F.col("node"), "left").join(chapters.select("chapter", F.col("title").alias("chapter_title")), "chapter", "left")
    shown = X.shown_number(F.col("docType"), F.col("number"), F.col("sourceAnomalies"))
    marks = X.flags(F.col("covers"), F.col("isRepealed"), F.col("headingIsSupplied"), F.col("titleIsSupplied"))
    step = lambda c, word: F.when(F.col(c).isNotNull(), _cat('<a rel="', word, '" href="', href("section", F.col(c)), '">', _esc(F.col(c)), "</a> "))
    body = _cat(
        "<h1>", _esc(shown), " ", F.coalesce("title_html", _esc(F.col("title"))), "</h1>\n", _if(marks, '<p class="meta">', _esc(marks), "</p>\n"), anomaly_note(F.col("sourceAnomalies")),
        F.col("body_html"), _if(F.col("history"), '\n<p class="history">', _esc(F.col("history")), "</p>\n"), note_blocks(F.col("annotations")), F.col("cited_html"), "<nav>", step("previous", "prev"), step("next", "next"), "</nav>",
    )
    crumbs = _trail(("/", "Home"), (href("chapter", F.col("chapter")), X.chapter_label(F.col("chapter"), F.col("chapter_title"))), (None, shown))
    facets = {"chapter": F.col("chapter"), "document": F.col("docType"), "status": X.status(F.col("isRepealed"))}
    return s.select(href("section", F.col("number")).alias("path"), page(F.concat_ws(" ", shown, "title"), crumbs, body, source_footer(F.col("url"), F.col("filename")), facets).alias("html"))


def chapter_pages(sections: DataFrame, chapters: DataFrame) -> DataFrame:
    """(path, html) of chapter pages: sections in natural order under the parts they belong to; chapters without sections too."""
    s = display_rows(sections, "chapter", "number", "partHeading")
    item = _cat('<li><a href="', href("section", F.col("number")), '">', _esc(proper_citation(F.col("docType"), F.col("number"))), " ", _esc(F.col("title")), "</a></li>")
    banner = F.when(F.col("open_partHeading").isNotNull(), _cat('<p class="part">', _esc(X.part_label(F.col("open_partHeading"))), F.when(X.part_supplied(F.col("open_partHeading")), " (supplied by the revisor)"), "</p>"))
    groups = s.groupBy("chapter", "group_no").agg(F.first(banner).alias("banner"), F.sort_array(F.collect_list(F.struct("position", item.alias("li")))).alias("l"), F.count(F.lit(1)).alias("n"))
    html = _cat(F.col("banner"), "<ol>", F.array_join(F.transform("l", lambda x: x["li"]), "\n"), "</ol>\n")
    lists = groups.groupBy("chapter").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("group_no", html.alias("h")))), lambda x: x["h"]), "").alias("list_html"), F.sum("n").alias("n"))
    c = chapters.select("chapter", "title").join(lists, "chapter", "left")
    label, n = X.chapter_label(F.col("chapter"), F.col("title")), F.coalesce("n", F.lit(0))
    body = _cat("<h1>", _esc(label), "</h1>\n", _if(X.count_label(n, "section", "sections"), '<p class="meta">', X.count_label(n, "section", "sections"), "</p>\n"), F.col("list_html"))
    crumbs = _trail(("/", "Home"), (None, label))
    return c.select(href("chapter", F.col("chapter")).alias("path"), page(label, crumbs, body, None, {"chapter": F.col("chapter")}).alias("html"))


def volume_pages(chapters: DataFrame) -> DataFrame:
    """(path, html) of volume pages with their chapters in natural order. chapters: (volume, chapter, title)."""
    li = _cat('<li><a href="', href("chapter", F.col("chapter")), '">', _esc(X.chapter_label(F.col("chapter"), F.col("title"))), "</a></li>")
    v = chapters.groupBy("volume").agg(F.sort_array(F.collect_list(F.struct(natural_key(F.col("chapter")).alias("k"), F.col("chapter"), li.alias("li")))).alias("l"))
    label = F.concat(F.lit("Volume "), F.col("volume").cast("string"))
    body = _cat("<h1>", label, "</h1>\n<p>", X.count_label(F.size("l"), "chapter", "chapters", "no chapters"), "</p>\n<ol>", F.array_join(F.transform("l", lambda x: x["li"]), "\n"), "</ol>")
    crumbs = _trail(("/", "Home"), (None, label))
    return v.select(href("volume", F.col("volume")).alias("path"), page(label, crumbs, body).alias("html"))


def title_pages(titles: DataFrame, divisions: DataFrame) -> DataFrame:
    """(path, html) of title pages. titles: (number, name, division_number, listing); divisions: (division_number, division_name)."""
    chapter = lambda c: _cat('<li><a href="', href("chapter", c["number"]), '">', _esc(c["number"]), " ", _esc(c["name"]), "</a></li>")
    group = lambda g: _cat(F.when(g["subtitle"].isNotNull(), _cat("<h2>", _esc(g["subtitle"]), "</h2>")), "<ol>", F.array_join(F.transform(g["chapters"], chapter), "\n"), "</ol>\n")
    label = F.concat(F.lit("Title "), "number", F.lit(". "), "name")
    t = titles.drop("division_name").join(divisions, "division_number", "left")
    crumbs = _trail(("/", "Home"), ("/hrs/tree", F.concat_ws(". ", F.concat(F.lit("Division "), F.col("division_number").cast("string")), "division_name")), (None, label))
    return t.select(href("title", F.col("number")).alias("path"), page(label, crumbs, _cat("<h1>", _esc(label), "</h1>\n", F.array_join(F.transform("listing", group), ""))).alias("html"))


def tree_rows(titles: DataFrame, divisions: DataFrame, others: DataFrame) -> DataFrame:
    """(ord, division, title, name): the tree of divisions and titles in order, other documents at its end."""
    t = titles.join(divisions, "division_number", "left").select(F.col("division_number").cast("long").alias("ord"), "division_name", natural_key(F.col("number")).alias("k"), F.col("number").alias("title"), "name")
    o = others.select(F.lit(1 << 40).alias("ord"), F.lit("Other documents").alias("division_name"), F.col("chapter").alias("k"), F.col("chapter").alias("title"), F.col("title").alias("name"))
    return t.unionByName(o).orderBy("ord", "k", "title").select("ord", F.col("division_name").alias("division"), "title", "name")


def home_page(corpus: DataFrame, volumes: DataFrame) -> DataFrame:
    """One row (path, html) with the number of sections and the volumes."""
    n = corpus.agg(F.count(F.lit(1)).alias("n"))
    v = volumes.groupBy().agg(F.array_join(F.transform(F.sort_array(F.collect_set("volume")), lambda x: _cat('<li><a href="/hrs/volume/', x.cast("string"), '">Volume ', x.cast("string"), "</a></li>")), "\n").alias("l"))
    both = n.withColumn("one", F.lit(1)).join(v.withColumn("one", F.lit(1)), "one")  # one row each
    return both.select(F.lit("/").alias("path"), page(F.lit("Home"), F.array().cast("array<struct<href:string,label:string>>"), _cat("<h1>Home</h1>\n<p>", X.count_label(F.col("n"), "section", "sections", "no sections"), "</p>\n<ul>", F.col("l"), "</ul>")).alias("html"))


def fixed_pages() -> dict[str, str]:
    """Pages that hold no data."""
    shell = lambda t, b: f'<!doctype html>\n<html lang="en"><head><meta charset="utf-8"><title>{t}</title></head>\n<body><main>\n{b}\n</main></body></html>\n'
    return {"/search": shell("Search", '<h1>Search</h1>\n<form><input name="q" type="search"></form>'), "/404": shell("Not found", "<h1>Not found</h1>")}
