"""Order and structure for display: pagers, carried-forward headings, outlines, linked text, page data."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.identity import natural_key
from statloom.functions.text import escape_html


def ordered(number: str | Column) -> list[Column]:
    """Natural order with the raw number to break ties."""
    c = F.col(number) if isinstance(number, str) else number
    return [natural_key(c), c]


def pager(sections: DataFrame, group: str, number: str) -> DataFrame:
    """Adds ``previous`` and ``next`` number within the group in natural order."""
    by = Window.partitionBy(group).orderBy(*ordered(number))
    return sections.withColumns({"previous": F.lag(number).over(by), "next": F.lead(number).over(by)})


def carry_forward(rows: DataFrame, value: str, order: Sequence[Column | str], group: str | None = None, out: str | None = None) -> DataFrame:
    """Adds the last value that isn't null at or before each row."""
    by = (Window.partitionBy(group) if group else Window.partitionBy(F.lit(0))).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(out or f"open_{value}", F.last(value, ignorenulls=True).over(by))


def open_groups(rows: DataFrame, value: str, order: Sequence[Column | str], group: str) -> DataFrame:
    """Adds ``open_<value>`` and ``group_no``: a group begins at the first row and where a value differs from the open one.

    A repeated value goes on with its group; a null doesn't end it.
    """
    w = Window.partitionBy(group).orderBy(*order)
    filled = carry_forward(rows, value, order, group)
    o = f"open_{value}"
    begins = F.when(F.row_number().over(w) == 1, 1).when(F.lag(o).over(w).eqNullSafe(F.col(o)), 0).otherwise(1)
    return filled.withColumn("__begins", begins).withColumn("group_no", F.sum("__begins").over(w)).drop("__begins")


def require_carried(rows: DataFrame, carried: str, name: str) -> DataFrame:
    """The rows, or an error if one comes before any value that it could carry on."""
    bad = rows.where(F.col(carried).isNull()).limit(1).collect()
    if bad:
        raise ValueError(f"{name} {bad[0][name]} comes before any {carried}")
    return rows


def display_rows(sections: DataFrame, group: str, number: str, part: str) -> DataFrame:
    """Sections of each chapter in natural order with position, part group and neighbours: the data of a chapter page."""
    grouped = open_groups(pager(sections, group, number), part, ordered(number), group)
    return grouped.withColumn("position", F.row_number().over(Window.partitionBy(group).orderBy(*ordered(number))))


# --- outline -----------------------------------------------------------------------------------

_MARK = re.compile(r"\(([0-9]{1,3}|[A-Za-z]{1,4})\)")
#: Letters that are roman numerals too, with the letter that comes before (fixed values).
AMBIGUOUS = {"i": "h", "v": "u", "x": "w"}


def depths(paragraphs: Sequence[str]) -> list[int]:
    """Depth of each paragraph by its enumerator.

    Kinds of enumerator nest in the order in which each first comes up; a kind that is open closes all within. A single letter
    that is a roman numeral too is a letter only right after the one before it. Paragraphs without one keep the depth.
    """
    open_: list[list[str]] = []  # [kind, last enumerator], outermost first
    out = []
    for p in paragraphs:
        m = _MARK.match(p)
        if m:
            mark = m[1]
            if mark.isdigit():
                kind = "digit"
            elif len(mark) > 1:
                kind = "roman"
            elif mark.isupper():
                kind = "upper"
            elif mark in AMBIGUOUS and AMBIGUOUS[mark] != next((last for k, last in open_ if k == "lower"), None):
                kind = "roman"
            else:
                kind = "lower"
            at = next((i for i, (k, _) in enumerate(open_) if k == kind), len(open_))
            open_[at:] = [[kind, mark]]
        out.append(len(open_))
    return out


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def outline_depths(paragraphs: pd.Series) -> pd.Series:
    """Depths of arrays of paragraphs; null stays null."""
    return paragraphs.map(lambda p: None if p is None else depths([x or "" for x in p]))


def outline(sections: DataFrame, key: str, body: str) -> DataFrame:
    """(key, pos, depth, text) of the paragraphs of a body."""
    from statloom.functions.text import paragraphs

    p = sections.select(key, paragraphs(F.col(body)).alias("__p")).withColumn("__d", outline_depths("__p"))
    both = F.arrays_zip(F.col("__p").alias("text"), F.col("__d").alias("depth"))
    return p.select(key, F.posexplode(both).alias("at", "x")).select(key, (F.col("at") + 1).alias("pos"), F.col("x.depth").alias("depth"), F.col("x.text").alias("text"))


# --- linked text -------------------------------------------------------------------------------


def linked(texts: DataFrame, resolved: DataFrame, keys: Sequence[str], text: str, cross: DataFrame | None = None) -> DataFrame:
    """(keys, html): each text with what it cites as links, all else escaped.

    Links carry the cited words and, for those who hear the page, the target's title. Sections that no longer exist are marked as
    such; other rejected candidates stay plain. Of overlapping spans the one that begins first counts, then the one found first.
    """
    span = lambda df, label: df.select(*keys, F.struct(F.col("start").alias("start"), F.col("seq").alias("seq"), F.col("end").alias("end"), F.col("target_href").alias("href"), label.alias("label")).alias("__s"))
    titled = lambda name: F.concat_ws(", ", name, F.nullif(F.regexp_replace("target_title", r"\.\z", ""), F.lit("")))
    good = resolved.where("target is not null or reason = 'absent-section'")
    spans = span(good, titled(F.col("cited")))
    if cross is not None:
        spans = spans.unionByName(span(cross.withColumn("seq", F.lit(1 << 20)), titled(F.col("label"))))
    per = spans.groupBy(*keys).agg(F.sort_array(F.collect_list("__s")).alias("__spans"))  # as many as a text holds
    t = texts.select(*keys, text).join(per, list(keys), "left")
    esc = lambda c: escape_html(c)
    part = lambda a, n: F.substr(F.col(text), a + 1, n)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        shown = esc(part(s["start"], s["end"] - s["start"]))
        link = F.when(s["href"].isNotNull(), F.concat(F.lit('<a href="'), s["href"], F.lit('" aria-label="'), esc(s["label"]), F.lit('">'), shown, F.lit("</a>"))).otherwise(F.concat(F.lit('<span class="absent">'), shown, F.lit('<span class="sr-only"> (not in the current code)</span></span>')))
        new = F.struct(s["end"].alias("at"), F.concat(acc["out"], esc(part(acc["at"], s["start"] - acc["at"])), link).alias("out"))
        return F.when(s["start"] < acc["at"], acc).otherwise(new)

    none = F.array().cast(per.schema["__spans"].dataType)
    html = F.aggregate(F.coalesce("__spans", none), start, step, lambda acc: F.concat(acc["out"], esc(part(acc["at"], F.length(text) - acc["at"]))))
    return t.select(*keys, html.alias("html"))


def cited_by(edges: DataFrame, labels: DataFrame, over: int = 25, part_size: int = 10_000) -> DataFrame:
    """(node, list, part, n, folded, rows): what cites each node, with labels and titles in natural order.

    labels: (number, label, title) of every node, the code's own first. Lists longer than ``over`` are marked to be folded; of lists
    longer than ``part_size`` each row holds a part, numbered from 0, and n counts the whole.
    """
    from statloom.operators.graph import numbered

    kind = F.when(F.col("block") == "annotation", "Mentioned in annotations").otherwise("Cited by")
    e = edges.select(F.col("to").alias("node"), kind.alias("list"), "from", (F.col("block") == "range").alias("in_range")).withColumn("__g", F.concat_ws("\n", "node", "list"))
    e = numbered(e, "__g", [natural_key(F.col("from")), "from", "in_range"]).withColumn("part", F.floor(F.col("at") / part_size))
    e = e.join(labels.select(F.col("number").alias("__n"), "label", "title"), F.col("from") == F.col("__n"), "left")
    row = F.struct("at", F.col("from").alias("number"), F.coalesce("label", "from").alias("label"), "title", "in_range")
    parts = e.groupBy("node", "list", "part").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    n = e.groupBy("node", "list").agg(F.count(F.lit(1)).alias("n"))
    rows = F.transform("rows", lambda x: x.dropFields("at"))
    return parts.join(n, ["node", "list"]).select("node", "list", "part", "n", (F.col("n") > over).alias("folded"), rows.alias("rows"))
