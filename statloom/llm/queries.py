"""Queries of the problems over texts."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statloom.llm.eval_leaks import leaked_items
from statloom.llm.markup import cleaned, markup_found
from statloom.llm.near_duplicates import Alike, alike_groups, alike_pairs
from statloom.llm.packing import measured, pack_windows
from statloom.llm.shared_spans import shared_coverage, sharing_pairs
from statloom.runtime import materialize, table

Query = Callable[[SparkSession, str], DataFrame]

#: Where the public tokenizers' files are; a parameter, they are never copied.
TOKENIZERS = os.environ.get("STATLOOM_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
#: What byte-level vocabularies of this kind split texts by (fixed value).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return markup_found(table(spark, d, "parsed"))


def p2_clean(spark: SparkSession, d: str) -> DataFrame:
    """Clean text of both fields."""
    return cleaned(table(spark, d, "parsed")).select("record_id", "field_name", "clean_text")


def p2_frames(spark: SparkSession, d: str) -> DataFrame:
    """All pages with the frame of a site around them: (record_id, frame_lines, same), lines of the frame left in the clean text, and whether that is the bare page's."""
    p = table(spark, d, "parsed").where("bodyHtml is not null").select("record_id", F.lit(None).cast("string").alias("bodyText"), "bodyHtml", F.lit(None).cast("string").alias("url"))
    menu = "".join(f"<li><a href=/{i}>Frame entry {i}</a>" for i in range(40))
    top, end = F.lit(f"<div class=head><h1>Frame of the site</h1><ul>{menu}</ul></div><div class=page>"), F.lit("</div><div class=foot><table><tr><td>Frame imprint<td>Frame contact</table></div>")
    framed = p.withColumns({"bodyHtml": F.concat(top, "bodyHtml", end), "url": F.lit("https://framed.example/")})
    lines = F.size(F.filter(F.split("clean_text", "\n"), lambda x: x.contains("Frame "))).cast("long")
    a = cleaned(framed).select("record_id", lines.alias("frame_lines"), F.md5("clean_text").alias("a"))
    b = cleaned(p).select("record_id", F.md5("clean_text").alias("b"))
    return a.join(b, "record_id").select("record_id", "frame_lines", (F.col("a") == F.col("b")).alias("same"))


#: Likeness of records as TESTDATA.md has it.
RECORDS = Alike(threshold=0.7, words=3, least_words=40)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return alike_pairs(table(spark, d, "parsed"), RECORDS)


def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    """The class, number of links and group of each record."""
    return alike_groups(table(spark, d, "parsed"), RECORDS)


def _capacities(spark: SparkSession, d: str) -> list[int]:
    return [r[0] for r in table(spark, d, "context_windows").select("capacity_tokens").distinct().orderBy("capacity_tokens").collect()]  # a fixed table


def _named(spark: SparkSession, d: str, packed: DataFrame) -> DataFrame:
    w = table(spark, d, "context_windows").select(F.col("window_id").cast("long").alias("window_id"), F.col("capacity_tokens").cast("long").alias("capacity"))
    return packed.join(F.broadcast(w), "capacity")


def p7_windows(spark: SparkSession, d: str) -> DataFrame:
    """Every document in a window of one of the capacities, by tiers."""
    sizes = measured(table(spark, d, "documents"), f"{TOKENIZERS}/{VOCABULARY}", SPLIT)
    return _named(spark, d, pack_windows(sizes, _capacities(spark, d)))


def p7_by_capacity(spark: SparkSession, d: str) -> DataFrame:
    """Every document in windows of each capacity by itself."""
    sizes = measured(table(spark, d, "documents"), f"{TOKENIZERS}/{VOCABULARY}", SPLIT)
    out = None
    for c in _capacities(spark, d):
        one = pack_windows(sizes, [c])
        out = one if out is None else out.unionByName(one)
    return _named(spark, d, out)


def p7_checked(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of each document in the packing by tiers: whole (all of its tokens have one place), split only if no window could hold it, in no window that is too full, and over no other's place."""
    docs, caps = table(spark, d, "documents"), _capacities(spark, d)
    sizes = measured(docs, f"{TOKENIZERS}/{VOCABULARY}", SPLIT)
    w = materialize(pack_windows(sizes, caps), "windows")
    own = Window.partitionBy("capacity", "window_no")  # a window's pieces, each of one token at least
    end = F.col("start") + F.col("n_tokens")
    held = w.where("n_tokens > 0").withColumns({"full": F.sum("n_tokens").over(own) > F.col("capacity"), "over": (F.coalesce(F.lead("start").over(own.orderBy("start", "n_tokens")), F.col("capacity")) < end)})
    held = held.select("doc_id", "piece", "n_tokens", "full", "over").unionByName(w.where("n_tokens = 0").select("doc_id", "piece", "n_tokens", F.lit(False).alias("full"), F.lit(False).alias("over")))
    per = held.groupBy("doc_id").agg(F.sum("n_tokens").alias("placed"), F.count(F.lit(1)).alias("pieces"), F.count_distinct("piece").alias("kinds"), F.bool_or("full").alias("too_full"), F.bool_or("over").alias("overlaps"))
    r = docs.select("doc_id").join(sizes, "doc_id").join(per, "doc_id", "left")
    whole = F.coalesce((F.col("placed") == F.col("n_tokens")) & (F.col("pieces") == F.col("kinds")), F.lit(False))
    return r.select("doc_id", whole.alias("whole"), F.coalesce((F.col("pieces") > 1) & (F.col("n_tokens") <= max(caps)), F.lit(False)).alias("split_in_vain"), F.coalesce("too_full", F.lit(True)).alias("too_full"), F.coalesce("overlaps", F.lit(True)).alias("overlaps"))


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    """Windows and share of unused space per capacity, packed by tiers and by itself."""
    parts = []
    for how, q in (("tiers", p7_windows), ("alone", p7_by_capacity)):
        w = q(spark, d).groupBy("capacity", "window_no").agg(F.sum("n_tokens").alias("used"))
        parts.append(w.groupBy("capacity").agg(F.lit(how).alias("how"), F.count(F.lit(1)).alias("windows"), F.sum("used").alias("tokens"), F.round(1 - F.sum("used") / (F.count(F.lit(1)) * F.first("capacity")), 6).alias("unused_share")))
    return parts[0].unionByName(parts[1])


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items")).select("item_id", "doc_id")


def p8_by_item(spark: SparkSession, d: str) -> DataFrame:
    """Which items leaked: into how many documents, the longest run of words, and beside the answer or not."""
    found = leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items"))
    return found.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_docs"), F.max("n_words").alias("longest_run"), F.count_if("answer_found").alias("n_docs_with_answer"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return sharing_pairs(table(spark, d, "documents"))


def p9_coverage(spark: SparkSession, d: str) -> DataFrame:
    """How much of each document stands elsewhere too."""
    return shared_coverage(table(spark, d, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (p2_found, p2_clean, p2_frames, p5_found, p5_groups, p7_windows, p7_by_capacity, p7_checked, p7_fill, p8_found, p8_by_item, p9_found, p9_coverage)}

_PASSAGE = "regexp_extract_all(lower(coalesce({c}, '')), '[\\p{{L}}\\p{{N}}]+')"
_RECORDS = f"""w AS (SELECT record_id, {_PASSAGE.format(c="coalesce(title, '') || ' ' || coalesce(bodyText, '')")} AS w FROM parsed),
s AS (SELECT DISTINCT record_id, unnest(list_transform(range(1, len(w) - 1), lambda k: array_to_string(w[k:k + 2], ' '))) AS s FROM w WHERE len(w) >= 40),
n AS (SELECT record_id, count(*) AS n FROM s GROUP BY 1), p AS (SELECT a.record_id AS a, b.record_id AS b, count(*) AS m FROM s a JOIN s b ON a.s = b.s AND a.record_id < b.record_id GROUP BY ALL),
f AS (SELECT a AS record_id_a, b AS record_id_b FROM p JOIN n x ON x.record_id = a JOIN n y ON y.record_id = b WHERE m >= 0.7 * (x.n + y.n - m))"""
_GRAMS = "s AS (SELECT doc_id, k, hash(text[k:k + 399]) AS h FROM (SELECT doc_id, text, unnest(range(1, length(text) - 398)) AS k FROM documents WHERE length(text) >= 400)), m AS (SELECT h FROM s GROUP BY h HAVING count(DISTINCT doc_id) > 1), t AS (SELECT s.* FROM s JOIN m USING (h))"
SQL: dict[str, str] = {
    "p7_checked": "SELECT doc_id, true AS whole, false AS split_in_vain, false AS too_full, false AS overlaps FROM documents",
    "p2_frames": "SELECT record_id, 0::BIGINT AS frame_lines, true AS same FROM parsed WHERE bodyHtml IS NOT NULL",
    "p5_found": f"WITH {_RECORDS} SELECT * FROM f",
    "p5_groups": f"""WITH RECURSIVE {_RECORDS}, c AS (SELECT record_id, CASE WHEN len(w) >= 40 THEN min(record_id) OVER (PARTITION BY w) ELSE record_id END AS class_id, CASE WHEN len(w) >= 40 THEN count(*) OVER (PARTITION BY w) ELSE 1 END AS copies FROM w),
l AS (SELECT DISTINCT x.class_id AS a, y.class_id AS b FROM (SELECT * FROM f UNION ALL SELECT record_id_b, record_id_a FROM f) f JOIN c x ON x.record_id = f.record_id_a JOIN c y ON y.record_id = f.record_id_b WHERE x.class_id <> y.class_id),
g AS (SELECT class_id AS a, class_id AS b FROM c UNION SELECT g.a, l.b FROM g JOIN l ON g.b = l.a)
SELECT record_id, class_id, copies, (SELECT count(*) FROM l WHERE l.a = class_id) AS n_links, (SELECT min(b) FROM g WHERE g.a = class_id) AS group_id FROM c""",
    "p8_found": f"""WITH d AS (SELECT doc_id, {_PASSAGE.format(c="text")} AS w FROM documents), i AS (SELECT item_id, {_PASSAGE.format(c="passage")} AS w FROM eval_items),
g AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 11), lambda k: array_to_string(w[k:k + 12], ' '))) AS s FROM i WHERE len(w) >= 13),
h AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 11), lambda k: array_to_string(w[k:k + 12], ' '))) AS s FROM d WHERE len(w) >= 13)
SELECT DISTINCT item_id, doc_id FROM g JOIN h USING (s)""",
    "p8_by_item": f"""WITH d AS (SELECT doc_id, {_PASSAGE.format(c="text")} AS w FROM documents), i AS (SELECT item_id, {_PASSAGE.format(c="passage")} AS w, array_to_string({_PASSAGE.format(c="answer")}, ' ') AS a FROM eval_items),
g AS (SELECT item_id, k AS ik, array_to_string(w[k:k + 12], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS k FROM i WHERE len(w) >= 13)),
h AS (SELECT doc_id, k AS dk, array_to_string(w[k:k + 12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM d WHERE len(w) >= 13)),
j AS (SELECT item_id, doc_id, dk - ik AS way, dk - row_number() OVER (PARTITION BY item_id, doc_id, dk - ik ORDER BY dk) AS island FROM g JOIN h USING (s)),
r AS (SELECT item_id, doc_id, max(n) AS n FROM (SELECT item_id, doc_id, way, island, count(*) + 12 AS n FROM j GROUP BY ALL) GROUP BY ALL)
SELECT item_id, count(*) AS n_docs, max(n) AS longest_run, count_if(a <> '' AND contains(' ' || array_to_string(d.w, ' ') || ' ', ' ' || a || ' ')) AS n_docs_with_answer FROM r JOIN d USING (doc_id) JOIN i USING (item_id) GROUP BY item_id""",
    "p9_found": f"WITH {_GRAMS} SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM t a JOIN t b ON a.h = b.h AND a.doc_id < b.doc_id",
    "p9_coverage": f"""WITH {_GRAMS}, c AS (SELECT doc_id, text, CASE WHEN text IS NULL THEN doc_id ELSE min(doc_id) OVER (PARTITION BY text) END AS class_id, CASE WHEN text IS NULL THEN 1 ELSE count(*) OVER (PARTITION BY text) END AS copies FROM documents),
v AS (SELECT doc_id, sum(least(400, coalesce(e - k, 400)))::BIGINT AS n FROM (SELECT doc_id, k, lead(k) OVER (PARTITION BY doc_id ORDER BY k) AS e FROM t) GROUP BY 1)
SELECT c.doc_id, class_id, copies, coalesce(length(text), 0) AS n_chars, coalesce(v.n, 0) AS shared_chars FROM c LEFT JOIN v USING (doc_id)""",
}
