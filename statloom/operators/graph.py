"""The citation graph: a table of edges, which either end may be grouped by."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.functions.identity import natural_key
from statloom.operators.citations import detect, range_members, resolve
from statloom.operators.crossdoc import cross_targets, detect_cross
from statloom.runtime import materialize, slots


def text_blocks(sections: DataFrame) -> DataFrame:
    """(source, ord, block, text): the body as block 0, each annotation after it. The history is none of them."""
    notes = F.transform(F.coalesce("annotations", F.array().cast("array<struct<heading:string,text:string>>")), lambda a, i: F.struct((i + 1).alias("ord"), F.lit("annotation").alias("block"), a["text"].alias("text")))
    body = F.array(F.struct(F.lit(0).alias("ord"), F.lit("body").alias("block"), F.col("bodyText").alias("text")))
    return sections.select(F.col("sectionNumber").alias("source"), F.explode(F.concat(body, notes)).alias("b")).select("source", "b.ord", "b.block", "b.text").where("text <> ''")


def edges_of(resolved: DataFrame, members: DataFrame | None = None, cross: DataFrame | None = None) -> DataFrame:
    """(from, to, kind, block), distinct, without edges from a section to itself.

    resolved: citations with source, block and target; members: sections within cited ranges; cross: citations into other documents.
    """
    e = resolved.where("target is not null").select(F.col("source").alias("from"), F.col("target").alias("to"), "kind", "block")
    if members is not None:
        e = e.unionByName(members.select(F.col("source").alias("from"), F.col("number").alias("to"), F.lit("section").alias("kind"), F.lit("range").alias("block")))
    if cross is not None:
        e = e.unionByName(cross.select(F.col("source").alias("from"), F.col("number").alias("to"), F.lit("section").alias("kind"), "block"))
    return e.where(F.col("from") != F.col("to")).groupBy("from", "to", "block").agg(F.min("kind").alias("kind")).select("from", "to", "kind", "block")


def build_graph(sections: DataFrame, targets: DataFrame, chapters: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Edges of a corpus: what bodies and annotations cite, members of cited ranges, other documents."""
    blocks = text_blocks(sections)
    unit = ["source", "ord", "block"]
    found = materialize(detect(blocks, unit, "text").drop("start", "end", "cited"), "citations")  # read twice; detected once
    others = cross_targets(sections)
    cross = detect_cross(blocks, unit, "text", others) if not others.isEmpty() else None
    return edges_of(resolve(found, targets, chapters, aliases), range_members(found, targets, unit), cross)


def degrees(edges: DataFrame, end: str = "to") -> DataFrame:
    """Distinct citing nodes of each node by kind of block: (node, statutory, annotations, total)."""
    note = F.col("block") == "annotation"
    return edges.groupBy(F.col(end).alias("node")).agg(F.count_if(~note).alias("statutory"), F.count_if(note).alias("annotations"), F.count(F.lit(1)).alias("total"))


def most_cited(edges: DataFrame, k: int = 20) -> DataFrame:
    """The k nodes that most other nodes cite; ties by natural order."""
    n = edges.groupBy(F.col("to").alias("node")).agg(F.count_distinct("from").alias("n"))
    return n.orderBy(F.desc("n"), natural_key(F.col("node")), "node").limit(k)


def numbered(rows: DataFrame, group: str, order: Sequence[Column | str]) -> DataFrame:
    """Adds ``at``, a row's place in its group's order from 0, where a group may hold a large share of all rows.

    Rows are sorted by ranges of (group, order), so a hot group spreads over many tasks; each counts its own rows, and the counts of
    the ranges before are added.
    """
    n = slots(rows.sparkSession)
    keyed = rows.withColumns({f"__o{i}": F.col(c) if isinstance(c, str) else c for i, c in enumerate(order)})
    by = [f"__o{i}" for i in range(len(order))]
    placed = materialize(keyed.repartitionByRange(n, group, *by).withColumn("__range", F.spark_partition_id()), "ranges")
    own = placed.withColumn("__nth", F.row_number().over(Window.partitionBy(group, "__range").orderBy(*by)))
    counts = placed.groupBy(group, "__range").agg(F.count(F.lit(1)).alias("__rows"))
    before = counts.withColumn("__before", F.coalesce(F.sum("__rows").over(Window.partitionBy(group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # a row per range
    return own.join(before, [group, "__range"]).withColumn("at", F.col("__nth") - 1 + F.col("__before")).drop("__range", "__nth", "__rows", "__before", *by)


def adjacency(edges: DataFrame, part_size: int = 10_000) -> DataFrame:
    """(node, part, cites, citedBy): sorted lists by natural order, null where a side is empty; a sink's form.

    A row holds ``part_size`` edges of a side at most: nodes that very many others cite take several parts, numbered from 0.
    """

    def side(own: str, other: str, name: str) -> DataFrame:
        e = F.struct("at", F.col(other).alias("n"), F.col("block"), F.col("kind"))
        g = numbered(edges, own, [natural_key(F.col(other)), other, "block"]).groupBy(F.col(own).alias("node"), F.floor(F.col("at") / part_size).alias("part")).agg(F.sort_array(F.collect_list(e)).alias("l"))
        return g.select("node", "part", F.transform("l", lambda x: F.struct(x["n"].alias("from" if other == "from" else "to"), x["kind"].alias("kind"), x["block"].alias("block"))).alias(name))

    return side("from", "to", "cites").join(side("to", "from", "citedBy"), ["node", "part"], "full")


def graph_json(edges: DataFrame) -> DataFrame:
    """(node, part, json) lines of the graph in natural order of nodes; the empty side of a node is left out."""
    a = adjacency(edges)
    return a.select("node", "part", natural_key(F.col("node")).alias("k"), F.to_json(F.struct("cites", "citedBy"), {"ignoreNullFields": "true"}).alias("json")).orderBy("k", "node", "part").select("node", "part", "json")


def nodes(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("from").alias("node")).union(edges.select(F.col("to"))).distinct()


def broken_links(hrefs: DataFrame, pages: DataFrame, href: str = "href", page: str = "href") -> DataFrame:
    """Links to which there is no page."""
    return hrefs.join(pages.select(F.col(page).alias("__page")), F.col(href) == F.col("__page"), "left_anti")


def collapsed(edges: DataFrame, over: int = 25) -> DataFrame:
    """Lists of citing sections longer than ``over``, which a page folds."""
    note: Column = F.when(F.col("block") == "annotation", "annotations").otherwise("statutory")
    return edges.groupBy(F.col("to").alias("node"), note.alias("list")).agg(F.count(F.lit(1)).alias("n")).withColumn("folded", F.col("n") > over)
