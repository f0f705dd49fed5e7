"""Queries of the engine's operators over the project's tables, each with the SQL that must give the same rows.

Names begin with the operator's id. ``SQL`` has no entry where SQL can't express the operator; the tests hold those against fixtures.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statloom.functions import identity as I
from statloom.functions import text as X
from statloom.functions.norm import section_key
from statloom.operators import citations as C
from statloom.operators import corrections as K
from statloom.operators import graph as G
from statloom.operators import inventory as V
from statloom.operators import layout as L
from statloom.operators import pages as P
from statloom.operators import search as S
from statloom.runtime import scratch, table
from statloom.sources import writers as W

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# --- shared parts ------------------------------------------------------------------------------


def sql_key(c: str) -> str:
    """``section_key`` in SQL."""
    return f"nullif(upper(regexp_replace(regexp_replace(translate({c}, '‐‑‒–−﹣－[]§­', '-------'), '[\\s\\x{{a0}}]+', '', 'g'), '^0+([0-9])', '\\1')), '')"


def sql_natural(c: str, width: int = 8) -> str:
    return f"array_to_string(list_transform(regexp_extract_all({c}, '[0-9]+|[A-Za-z]+'), lambda r: CASE WHEN regexp_matches(r, '^[0-9]') THEN lpad(r, greatest(length(r), {width})::INT, '0') ELSE r END), '')"


def sections(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """One record per section, the last one fetched, with the columns asked for or all. ``number`` is its key with the sign."""
    p = table(spark, d, "parsed").drop("bodyHtml").withColumn("key", section_key(F.col("sectionNumber"))).where("key is not null")
    cols = list(columns or (c for c in p.columns if c != "key"))
    one = p.groupBy("key").agg(F.max_by(F.struct(*cols), F.struct("crawled_at", "record_id")).alias("s")).select("key", "s.*")
    return one.withColumns({"number": F.concat(F.lit("§"), F.col("key")), "chapter": F.regexp_extract("key", "^([^-:]*)", 1)})


SECTIONS = f"s AS (SELECT *, '§' || key AS number, regexp_extract(key, '^([^-:]*)', 1) AS chapter FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY crawled_at DESC, record_id DESC) AS rn FROM (SELECT *, {sql_key('sectionNumber')} AS key FROM parsed) WHERE key IS NOT NULL) WHERE rn = 1)"


def live_targets(spark: SparkSession, d: str) -> DataFrame:
    """(key, number, title, href), one per key of the inventory."""
    t = table(spark, d, "targets").groupBy(F.col("target_key").alias("key")).agg(F.max_by(F.struct("title", "href"), F.struct("added_at", "title", "href")).alias("t"))
    return t.select("key", F.concat(F.lit("§"), "key").alias("number"), "t.title", "t.href")


def chapter_targets(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chapters").groupBy(F.col("chapter_key").alias("chapter")).agg(F.max_by("title", F.struct("added_at", "title")).alias("title"))
    return V.chapter_targets(c)


# --- identity ----------------------------------------------------------------------------------


@query(r"SELECT record_id, trim(regexp_replace(translate(title, chr(160) || '‐‑‒', ' ---'), '[\s\x{85}\x{2028}\x{3000}]+', ' ', 'g')) AS title_clean FROM parsed")
def f1_clean(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "parsed").select("record_id", I.clean(F.col("title")).alias("title_clean"))


_FILE = r"""f AS (SELECT record_id, filename, regexp_replace(regexp_replace(replace(filename, chr(173), ''), '(?i)\.html?$', ''), '(?i)\.docx$', '') AS stem FROM parsed),
g AS (SELECT *, upper(regexp_extract(stem, '^([A-Za-z]+)_', 1)) AS prefix, string_split(regexp_replace(stem, '^[A-Za-z]+_', ''), '-') AS parts FROM f),
h AS (SELECT *, list_transform(parts, lambda p: regexp_replace(string_split(p, '_')[1], '^0+([0-9])', '\1')) AS nums, list_transform(string_split(list_last(parts), '_')[2:], lambda p: regexp_replace(p, '^0+([0-9])', '\1')) AS decs FROM g)"""


@query(
    f"WITH {_FILE} SELECT record_id, '§' || upper(nums[1]) || CASE WHEN len(nums) = 3 THEN ':' || upper(nums[2]) || '-' || upper(nums[3]) WHEN len(nums) = 2 THEN '-' || upper(nums[2]) ELSE '' END || CASE WHEN len(decs) > 0 THEN '.' || array_to_string(decs, '') ELSE '' END AS number, upper(nums[1]) AS chapter, lower(prefix) AS doc_type, list_last(parts) = '' AS is_index FROM h"
)
def f5_filename_number(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("filename")
    return table(spark, d, "parsed").select("record_id", I.number_of_file(n).alias("number"), I.chapter_of_file(n).alias("chapter"), I.doc_type(n).alias("doc_type"), I.is_index_file(n).alias("is_index"))


@query("SELECT dir_name, chapter_key AS chapter FROM chapters")
def f7_chapter_directories(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chapters").select("dir_name", I.chapter_of_directory(F.col("dir_name")).alias("chapter"))


@query("SELECT DISTINCT number, replace(target_key, ':', '-') AS slug, href, target_key AS key FROM targets")
def f10_slug(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("number")
    return table(spark, d, "targets").select("number", I.slug(n).alias("slug"), I.href("section", n).alias("href"), I.citation_key(n).alias("key")).distinct()


@query(
    """SELECT o_orderkey, '§' || c || '-' || a AS start_number, '§' || c || '-' || b AS end_number, CASE o_orderkey % 3 WHEN 0 THEN 'to ' || b || '.' WHEN 1 THEN 'to ' || c || '-' || b ELSE 'to ' || a || ', and ' || b END AS raw, 'REPEALED' AS title
FROM (SELECT o_orderkey, o_orderkey % 90 + 1 AS c, o_orderkey % 500 + 1 AS a, o_orderkey % 500 + 9 AS b FROM orders)"""
)
def f14_range_titles(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 90 + 1).cast("string").alias("c"), (F.col("o_orderkey") % 500 + 1).cast("string").alias("a"), (F.col("o_orderkey") % 500 + 9).cast("string").alias("b"))
    k = F.col("o_orderkey") % 3
    rest = F.when(k == 0, F.concat(F.lit("to "), "b", F.lit(". REPEALED"))).when(k == 1, F.concat(F.lit("to "), "c", F.lit("-"), "b", F.lit(" REPEALED"))).otherwise(F.concat(F.lit("to "), "a", F.lit(", and "), "b", F.lit(" REPEALED")))
    r = o.withColumn("r", I.range_of_title(rest, F.concat(F.lit("§"), "c", F.lit("-"), "a")))
    return r.select("o_orderkey", F.col("r.start").alias("start_number"), F.col("r.end").alias("end_number"), "r.raw", "r.title")


_ROMAN = "['I','II','III','IV','V','VI','VII','VIII','IX','X','XI','XII','XIII','XIV','XV','XVI','XVII','XVIII','XIX','XX','XXI','XXII','XXIII','XXIV','XXV','XXVI','XXVII']"


@query(
    f"""SELECT n_nationkey, CASE n_nationkey % 6 WHEN 0 THEN 'Haw. Const. art. ' || r || ', §' || n_regionkey WHEN 1 THEN 'U.S. Const. amend. ' || r || ', §' || n_regionkey WHEN 2 THEN 'Organic Act §' || n WHEN 3 THEN 'Admission Act §' || n WHEN 4 THEN 'HHCA §' || n ELSE '§' || n || '-' || n_regionkey END AS label
FROM (SELECT *, n_nationkey + 1 AS n, {_ROMAN}[n_nationkey + 1] AS r FROM nation)"""
)
def f15_proper_citation(spark: SparkSession, d: str) -> DataFrame:
    n, r, k = (F.col("n_nationkey") + 1).cast("string"), F.col("n_regionkey").cast("string"), F.col("n_nationkey") % 6
    doc = F.element_at(F.array(*(F.lit(x) for x in ("const", "uscon", "org", "adm", "hhca", "hrs"))), k + 1)
    number = F.when(k == 0, F.concat(F.lit("CONST §"), n, F.lit("-"), r)).when(k == 1, F.concat(F.lit("USCON §AM-"), n, F.lit("-"), r)).when(k == 5, F.concat(F.lit("§"), n, F.lit("-"), r)).otherwise(F.concat(F.upper(doc), F.lit(" §"), n))
    return table(spark, d, "nation").select("n_nationkey", I.proper_citation(doc, number).alias("label"))


@query(f"SELECT n_nationkey, n_nationkey + 1 AS from_digits, n_nationkey + 1 AS from_roman, ['first','second','third','fourth','fifth','sixth','seventh','eighth','ninth','tenth','eleventh','twelfth','thirteenth','fourteenth','fifteenth','sixteenth','seventeenth','eighteenth','nineteenth','twentieth','twenty-first','twenty-second','twenty-third','twenty-fourth','twenty-fifth'][n_nationkey + 1] AS word, n_nationkey + 1 AS from_word, {_ROMAN}[n_nationkey + 1] AS numeral FROM nation")
def f16_number_words(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("n_nationkey") + 1
    word = F.create_map(*(F.lit(x) for kv in I.ORDINALS.items() for x in kv))[n]
    numeral = F.create_map(*(F.lit(x) for r, k in I.NUMERALS.items() for x in (k, r.upper())))[n]
    return table(spark, d, "nation").select("n_nationkey", I.number_of(n.cast("string")).alias("from_digits"), I.number_of(numeral).alias("from_roman"), word.alias("word"), I.number_of(F.replace(word, F.lit("-"), F.lit(" "))).alias("from_word"), numeral.alias("numeral"))


@query(f"SELECT DISTINCT target_key, {sql_natural('target_key')} AS natural_key, {sql_natural('target_key', 6)} AS short_key FROM targets")
def o1_natural_key(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("target_key")
    return table(spark, d, "targets").select("target_key", I.natural_key(k).alias("natural_key"), I.natural_key(k, 6).alias("short_key")).distinct()


@query(f"SELECT chapter, key, row_number() OVER (PARTITION BY chapter ORDER BY {sql_natural('key')}, key) AS position FROM (SELECT DISTINCT target_key AS key, regexp_extract(target_key, '^([^-:]*)', 1) AS chapter FROM targets)")
def a1_chapter_order(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "targets").select(F.col("target_key").alias("key"), F.regexp_extract("target_key", "^([^-:]*)", 1).alias("chapter")).distinct()
    return t.withColumn("position", F.row_number().over(Window.partitionBy("chapter").orderBy(*L.ordered("key")))).select("chapter", "key", "position")


@query("SELECT record_id, md5(replace(replace(replace(replace(bodyText, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')) AS escaped FROM parsed WHERE bodyText IS NOT NULL")
def f17_escape(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "parsed").where("bodyText is not null").select("record_id", F.md5(X.escape_html(F.col("bodyText"))).alias("escaped"))


@query(r"SELECT record_id, trim(regexp_replace(replace(replace(partHeading, '[', ''), ']', ''), '\s+', ' ', 'g')) AS label, contains(partHeading, '[') AS supplied, regexp_matches(partHeading, '(?i)^\[?\s*(PART|SUBPART|ARTICLE|DIVISION|TITLE|CHAPTER)\s+[IVXLCDM0-9]') AS structural FROM parsed WHERE partHeading IS NOT NULL")
def f18_part_banner(spark: SparkSession, d: str) -> DataFrame:
    h = F.col("partHeading")
    return table(spark, d, "parsed").where("partHeading is not null").select("record_id", X.part_label(h).alias("label"), X.part_supplied(h).alias("supplied"), X.is_structural(h).alias("structural"))


@query(r"SELECT record_id, CASE WHEN regexp_matches(t, '^[0-9][0-9A-Z:.\-]*$') AND contains(t, '-') THEN t END AS number FROM (SELECT record_id, upper(regexp_replace(regexp_replace(trim(sectionNumber), '^§+\s*', ''), '\s+', '', 'g')) AS t FROM parsed)")
def f20_query_number(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "parsed").select("record_id", X.query_number(F.col("sectionNumber")).alias("number"))


@query(
    """SELECT CASE WHEN regexp_matches(h, '(?i)^case notes?$') THEN 'Case Notes' WHEN regexp_matches(h, '(?i)^cross references?$') THEN 'Cross References' WHEN regexp_matches(h, '(?i)^attorney general') THEN 'Attorney General Opinions' WHEN regexp_matches(h, '(?i)^law journals') THEN 'Law Journals and Reviews' WHEN regexp_matches(h, '(?i)commentary') THEN 'Commentary' ELSE 'other' END AS note_kind, count(*) AS n
FROM (SELECT a.heading AS h FROM (SELECT unnest(annotations) AS a FROM parsed)) GROUP BY 1"""
)
def f22_note_kinds(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "parsed").select(F.explode("annotations").alias("a"))
    return a.groupBy(X.note_kind(F.col("a.heading")).alias("note_kind")).agg(F.count(F.lit(1)).alias("n"))


_YEARED = r"'\[[^\[\]]*\b(?:1[6-9][0-9]{2}|20[0-9]{2})\b[^\[\]]*\]'"


@query(
    f"""WITH t AS (SELECT record_id, concat_ws(' ', bodyText, history) AS t FROM parsed), h AS (SELECT *, coalesce(list_last(regexp_extract_all(t, {_YEARED})), '') AS h FROM t),
r AS (SELECT *, CASE WHEN h = '' THEN t ELSE trim(t[:length(t) - strpos(reverse(t), reverse(h)) + 1 - length(h)] || t[length(t) - strpos(reverse(t), reverse(h)) + 2:]) END AS r FROM h)
SELECT record_id, h AS history, CASE WHEN r = '' THEN t ELSE r END AS body FROM r"""
)
def f24_history_split(spark: SparkSession, d: str) -> DataFrame:
    """Each body followed by its history, in whatever form, split again."""
    t = F.concat_ws(" ", "bodyText", "history")
    return table(spark, d, "parsed").select("record_id", X.history_of(t).alias("history"), X.without_history(t).alias("body"))


@query("SELECT record_id, len(l) AS paragraphs, list_sum(list_transform(l, lambda x: length(x)))::BIGINT AS characters FROM (SELECT record_id, list_filter(list_transform(string_split_regex(bodyText, '\\n{2,}'), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') AS l FROM parsed WHERE bodyText IS NOT NULL AND bodyText <> '')")
def f30_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "parsed").where("bodyText <> ''").select("record_id", X.paragraphs(F.col("bodyText")).alias("l"))
    return p.select("record_id", F.size("l").cast("long").alias("paragraphs"), F.aggregate("l", F.lit(0).cast("long"), lambda s, x: s + F.length(x)).alias("characters"))


@query(r"SELECT record_id, list_filter(list_transform(string_split(coalesce(list_filter(annotations, lambda a: regexp_matches(a.heading, '(?i)^cross\s+references?$'))[1].text, ''), chr(10)), lambda x: trim(x)), lambda x: x <> '') AS lines, coalesce(list_filter(annotations, lambda a: regexp_matches(a.heading, '(?i)^case\s+notes?$'))[1].text, '') AS case_notes FROM parsed WHERE annotations IS NOT NULL")
def f25_note_fields(spark: SparkSession, d: str) -> DataFrame:
    a = F.col("annotations")
    return table(spark, d, "parsed").where("annotations is not null").select("record_id", X.cross_reference_lines(a).alias("lines"), X.case_notes(a).alias("case_notes"))


# --- projections and predicates ----------------------------------------------------------------


@query("SELECT docType, chapterNumber, count(*) AS n FROM parsed WHERE docType = 'hrs' AND chapterNumber = '431' GROUP BY ALL")
def sel2_document_and_chapter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "parsed").where("docType = 'hrs' and chapterNumber = '431'").groupBy("docType", "chapterNumber").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT chapter_key, regexp_matches(chapter_key, '^[0-9]+[A-Z]*$') AS chapter_plain, regexp_matches(dir_name, '^[0-9]+[A-Z]*$') AS dir_plain FROM chapters")
def sel5_plain_chapter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chapters").select("chapter_key", X.is_plain_chapter(F.col("chapter_key")).alias("chapter_plain"), X.is_plain_chapter(F.col("dir_name")).alias("dir_plain"))


@query("SELECT record_id, starts_with(url, 'https://code.example.org/current/') AND length(url) - length(replace(url, '/', '')) = 4 AS below_root, starts_with(url, 'https://code.example.org/current/HRS0431/') AS in_431 FROM parsed WHERE url IS NOT NULL")
def sel6_direct_child(spark: SparkSession, d: str) -> DataFrame:
    u, base = F.col("url"), "https://code.example.org/current/"
    return table(spark, d, "parsed").where("url is not null").select("record_id", X.is_direct_child(u, F.lit(base)).alias("below_root"), X.is_direct_child(u, F.lit(f"{base}HRS0431/")).alias("in_431"))


_REPEALED = r"(regexp_matches(coalesce(title, ''), '(?i)\brepealed\b') OR regexp_matches(coalesce(bodyText, ''), '(?i)\A\s*\[?\s*repealed\b') OR regexp_matches(coalesce(bodyText, ''), '(?i)\A\s*\[[^\]]*\brepealed\b[^\]]*\]\s*\z') OR regexp_matches(coalesce(bodyText, ''), '(?i)\A\s*\[?§§?[\d\w:.\-]+(?:(?:,| to| and) ?[\d\w:.\-]+)*\s+repealed\b'))"


@query(f"SELECT record_id, {_REPEALED} AS repealed, CASE WHEN {_REPEALED} THEN 'repealed' ELSE 'in force' END AS status FROM parsed")
def sel8_repealed(spark: SparkSession, d: str) -> DataFrame:
    r = X.is_repealed(F.col("title"), F.col("bodyText"))
    return table(spark, d, "parsed").select("record_id", r.alias("repealed"), X.status(r).alias("status"))


@query("SELECT record_id, coalesce(list_filter(sourceAnomalies, lambda a: a.field = 'sectionNumber')[1].observed, sectionNumber) AS shown, concat_ws(' · ', CASE WHEN covers IS NOT NULL THEN 'covers ' || covers.start || ' to ' || covers.end END, CASE WHEN isRepealed THEN 'repealed' END, CASE WHEN headingIsSupplied THEN 'heading supplied by the revisor' END, CASE WHEN titleIsSupplied THEN 'catchline supplied by the revisor' END) AS flags FROM parsed")
def sel11_identity_and_flags(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "parsed")
    return p.select("record_id", X.shown_number(F.col("docType"), F.col("sectionNumber"), F.col("sourceAnomalies")).alias("shown"), X.flags(F.col("covers"), F.col("isRepealed"), F.col("headingIsSupplied"), F.col("titleIsSupplied")).alias("flags"))


@query("SELECT volume, regexp_replace(lpad(min(chapter_key), 4, '0') || '-' || lpad(max(chapter_key), 4, '0'), '^0+', '') AS untrimmed, regexp_replace(regexp_replace(lpad(min(chapter_key), 4, '0') || '-' || lpad(max(chapter_key), 4, '0'), '^0+', ''), '-0*', '–') AS shown, CASE count(*) WHEN 1 THEN '1 chapter' ELSE count(*) || ' chapters' END AS label FROM chapters GROUP BY volume")
def sel12_volume_ranges(spark: SparkSession, d: str) -> DataFrame:
    pad = lambda c: F.lpad(c, 4, "0")
    g = table(spark, d, "chapters").groupBy("volume").agg(F.concat(pad(F.min("chapter_key")), F.lit("-"), pad(F.max("chapter_key"))).alias("r"), F.count(F.lit(1)).alias("n"))
    return g.select("volume", F.regexp_replace("r", "^0+", "").alias("untrimmed"), X.trim_range(F.col("r")).alias("shown"), X.count_label(F.col("n"), "chapter", "chapters").alias("label"))


@query("SELECT chapter_key, CASE WHEN coalesce(title, '') = '' THEN 'Chapter ' || chapter_key ELSE 'Chapter ' || chapter_key || ' — ' || title END AS label FROM chapters")
def sel14_chapter_labels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chapters").select("chapter_key", X.chapter_label(F.col("chapter_key"), F.col("title")).alias("label"))


# --- aggregations ------------------------------------------------------------------------------


@query(f"SELECT key, count(DISTINCT filename) AS n, min(filename) AS first, max(filename) AS last FROM (SELECT {sql_key('sectionNumber')} AS key, filename FROM parsed) WHERE key IS NOT NULL GROUP BY key HAVING count(DISTINCT filename) > 1")
def a4_duplicate_numbers(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "parsed").select(section_key(F.col("sectionNumber")).alias("key"), "filename").where("key is not null")
    return V.duplicates(p, "key", "filename")


@query("SELECT slug, count(DISTINCT n) AS n, min(n) AS first, max(n) AS last FROM (SELECT sectionNumber AS n, regexp_replace(regexp_replace(replace(regexp_replace(regexp_replace(sectionNumber, '^§', ''), '^([A-Z]+) §', '\\1-'), ':', '-'), ' \\[OLD\\]$', '-old'), '\\s+', '', 'g') AS slug FROM parsed) WHERE slug IS NOT NULL GROUP BY slug HAVING count(DISTINCT n) > 1")
def a5_slug_collisions(spark: SparkSession, d: str) -> DataFrame:
    return V.slug_collisions(table(spark, d, "parsed"))


_WORDS = "w AS (SELECT regexp_replace(unnest(regexp_extract_all(lower(coalesce(title, '') || ' ' || coalesce(bodyText, '') || ' ' || coalesce(array_to_string(list_transform(annotations, lambda a: a.text), ' '), '')), '[a-z][a-z''’-]{3,}')), '[''’-]+$', '') AS word FROM parsed), counts AS (SELECT word, count(*) AS freq FROM w WHERE length(word) >= 5 GROUP BY word)"


@query(f"WITH {_WORDS} SELECT word, freq FROM counts")
def a6_word_counts(spark: SparkSession, d: str) -> DataFrame:
    return S.word_counts(table(spark, d, "parsed"))


@query(f"WITH {_WORDS} SELECT word FROM counts WHERE freq >= 3")
def a7_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return S.vocabulary(S.word_counts(table(spark, d, "parsed"))).select("word")


@query("SELECT chapterNumber, record_id, title, filename FROM (SELECT *, row_number() OVER (PARTITION BY chapterNumber ORDER BY coalesce(title, '') = '', filename, record_id) AS n FROM parsed WHERE chapterNumber IS NOT NULL) WHERE n = 1")
def a13_pick_record(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "parsed").where("chapterNumber is not null").withColumn("name", F.struct("filename", "record_id"))
    return V.pick_record(p, "chapterNumber", "title", "name").select("chapterNumber", "record_id", "title", "filename")


@query("SELECT volume, count(*) AS chapters, count(title) AS titled, count(dropped_at) AS dropped FROM chapters GROUP BY volume")
def a17_volume_stats(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chapters").groupBy("volume").agg(F.count(F.lit(1)).alias("chapters"), F.count("title").alias("titled"), F.count("dropped_at").alias("dropped"))


@query("SELECT event_type AS domain, count(DISTINCT day) AS days, min(day) AS first_day, max(day) AS last_day, sum(length)::BIGINT AS bytes FROM (SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, user_id AS length FROM events) GROUP BY event_type")
def s12_log_summary(spark: SparkSession, d: str) -> DataFrame:
    from statloom.sources.readers import log_summary

    return log_summary(table(spark, d, "events").select(F.col("event_type").alias("domain"), F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("user_id").alias("length")))


@query("SELECT count_if(len(annotations) > 0) AS with_annotations, count_if(coalesce(caseNotes, '') <> '') AS with_notes, count(*) AS n FROM parsed")
def a19_note_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "parsed").agg(F.count_if(F.size("annotations") > 0).alias("with_annotations"), F.count_if(F.coalesce("caseNotes", F.lit("")) != "").alias("with_notes"), F.count(F.lit(1)).alias("n"))


# --- windows and order -------------------------------------------------------------------------


@query(f"WITH {SECTIONS} SELECT number, lag(number) OVER w AS previous, lead(number) OVER w AS next FROM s WINDOW w AS (PARTITION BY chapter ORDER BY {sql_natural('number')}, number)")
def w1_pager(spark: SparkSession, d: str) -> DataFrame:
    return L.pager(sections(spark, d, "record_id"), "chapter", "number").select("number", "previous", "next")


@query(f"WITH {SECTIONS} SELECT number, last_value(partHeading IGNORE NULLS) OVER (PARTITION BY chapter ORDER BY {sql_natural('number')}, number ROWS UNBOUNDED PRECEDING) AS open_part FROM s")
def w2_carry_forward(spark: SparkSession, d: str) -> DataFrame:
    return L.carry_forward(sections(spark, d, "partHeading"), "partHeading", L.ordered("number"), "chapter", "open_part").select("number", "open_part")


@query(
    f"""WITH {SECTIONS}, o AS (SELECT number, chapter, {sql_natural('number')} AS k, last_value(partHeading IGNORE NULLS) OVER (PARTITION BY chapter ORDER BY {sql_natural('number')}, number ROWS UNBOUNDED PRECEDING) AS part FROM s),
b AS (SELECT *, CASE WHEN row_number() OVER w = 1 THEN 1 WHEN lag(part) OVER w IS NOT DISTINCT FROM part THEN 0 ELSE 1 END AS b FROM o WINDOW w AS (PARTITION BY chapter ORDER BY k, number))
SELECT chapter, number, part AS open_part, (sum(b) OVER (PARTITION BY chapter ORDER BY k, number ROWS UNBOUNDED PRECEDING))::BIGINT AS group_no FROM b"""
)
def w3_part_groups(spark: SparkSession, d: str) -> DataFrame:
    g = L.open_groups(sections(spark, d, "partHeading"), "partHeading", L.ordered("number"), "chapter")
    return g.select("chapter", "number", F.col("open_partHeading").alias("open_part"), "group_no")


@query("SELECT sectionNumber, title, isRepealed, partHeading FROM parsed WHERE chapterNumber = '431'")
def x3_chapter_sections(spark: SparkSession, d: str) -> DataFrame:
    return S.chapter_sections(table(spark, d, "parsed"), "431")


@query("SELECT facet, value, count(*) AS n FROM (SELECT 'chapter' AS facet, chapterNumber AS value FROM parsed UNION ALL SELECT 'document', docType FROM parsed UNION ALL SELECT 'status', CASE WHEN isRepealed THEN 'repealed' ELSE 'in force' END FROM parsed) GROUP BY ALL")
def x8_facets(spark: SparkSession, d: str) -> DataFrame:
    return S.facets(table(spark, d, "parsed"))


# --- joins, set operations, merges -------------------------------------------------------------


@query(f"SELECT record_id, sectionNumber FROM (SELECT record_id, sectionNumber, {sql_key('sectionNumber')} AS k FROM parsed) WHERE k IS NULL OR k NOT IN (SELECT target_key FROM targets WHERE target_key IS NOT NULL)")
def j11_pending(spark: SparkSession, d: str) -> DataFrame:
    jobs = table(spark, d, "parsed").select("record_id", "sectionNumber", section_key(F.col("sectionNumber")).alias("url"))
    return V.pending(jobs, table(spark, d, "targets").select(F.col("target_key").alias("url"))).select("record_id", "sectionNumber")


_COVER = f"l AS (SELECT DISTINCT regexp_extract(target_key, '^([^-:]*)', 1) AS chapter, target_key AS number FROM targets), {SECTIONS}, c AS (SELECT coalesce(l.chapter, s.chapter) AS chapter, coalesce(l.number, s.key) AS number, CASE WHEN l.number IS NULL THEN 'unlisted' WHEN s.key IS NULL THEN 'absent' ELSE 'matched' END AS state, s.isRepealed AS r FROM l FULL JOIN s ON l.number = s.key AND l.chapter = s.chapter)"


def _listed(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "targets").select(F.regexp_extract("target_key", "^([^-:]*)", 1).alias("chapter"), F.col("target_key").alias("number")).distinct()


def _corpus(spark: SparkSession, d: str) -> DataFrame:
    return sections(spark, d, "isRepealed").select("chapter", F.col("key").alias("number"), "isRepealed")


@query(f"WITH {_COVER} SELECT chapter, number, state FROM c")
def j12_coverage(spark: SparkSession, d: str) -> DataFrame:
    return V.coverage(_listed(spark, d), _corpus(spark, d))


@query(f"WITH {_COVER} SELECT count_if(state <> 'unlisted') AS listed, count_if(state = 'matched') AS matched, count_if(state = 'absent') AS absent, count_if(state = 'unlisted') AS unlisted, count_if(state = 'unlisted' AND coalesce(r, false)) AS unlisted_repealed, count_if(state = 'unlisted' AND NOT coalesce(r, false)) AS unlisted_live, round(100.0 * count_if(state = 'matched') / count_if(state <> 'unlisted'), 2)::DOUBLE AS matched_pct FROM c")
def a15_coverage_summary(spark: SparkSession, d: str) -> DataFrame:
    return V.coverage_summary(j12_coverage(spark, d), _corpus(spark, d))


@query(f"WITH {_COVER} SELECT chapter, number, state, nth FROM (SELECT *, row_number() OVER (PARTITION BY state ORDER BY {sql_natural('number')}, number) AS nth FROM c WHERE state <> 'matched') WHERE nth <= 15")
def o9_gap_samples(spark: SparkSession, d: str) -> DataFrame:
    return V.gaps(j12_coverage(spark, d))


@query("SELECT record_id, title, CASE WHEN record_id % 3 = 0 THEN 'corrected ' || record_id ELSE sectionNumber END AS sectionNumber, CASE WHEN record_id % 3 = 0 THEN 'correction' ELSE numberSource END AS numberSource, CASE WHEN record_id % 3 IN (0, 1) THEN 1 ELSE 0 END + len(sourceAnomalies) AS anomalies, CASE WHEN record_id % 3 = 2 THEN 'not applied: observed something else, found ' || sectionNumber END AS warning FROM parsed WHERE sectionNumber IS NOT NULL")
def j13_corrections(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "parsed").where("sectionNumber is not null").withColumn("filename", F.col("record_id").cast("string"))
    k = F.col("record_id") % 3
    ledger = p.select("filename", F.lit("sectionNumber").alias("field"), F.when(k == 2, "something else").otherwise(F.col("sectionNumber")).alias("observed"), F.when(k != 1, F.concat(F.lit("corrected "), F.col("record_id").cast("string"))).alias("corrected"), F.when(k == 1, "flagged").otherwise("conclusive").alias("confidence"), F.lit("checked").alias("evidence"))
    return K.apply_corrections(p, ledger).select("record_id", "title", "sectionNumber", "numberSource", F.size("sourceAnomalies").cast("long").alias("anomalies"), "warning")


@query("SELECT record_id::VARCHAR AS filename, 'sectionNumber' AS field, unnest(CASE record_id % 5 WHEN 0 THEN ['confidence is conclusive or flagged'] WHEN 1 THEN ['a conclusive entry needs \"corrected\"'] WHEN 2 THEN ['a flagged entry must not carry \"corrected\"'] WHEN 3 THEN ['\"evidence\" is required'] ELSE [] END) AS problem FROM parsed")
def s10_ledger_problems(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("record_id") % 5
    e = table(spark, d, "parsed").select(
        F.col("record_id").cast("string").alias("filename"), F.lit("sectionNumber").alias("field"), F.col("sectionNumber").alias("observed"), F.when(k != 1, "x").alias("corrected"),
        F.when(k == 0, "probable").when(k == 2, "flagged").otherwise("conclusive").alias("confidence"), F.when(k == 3, " ").otherwise("seen").alias("evidence"), F.lit("2025-01-01").alias("reviewedOn"),
    )
    return K.ledger_problems(e)


@query(f"WITH c AS (SELECT chapter_key, {sql_natural('chapter_key', 6)} AS k, row_number() OVER (ORDER BY {sql_natural('chapter_key', 6)}, chapter_key) AS n FROM chapters), f AS (SELECT *, (n - 1) // 30 AS title, n % 30 = 1 OR n % 3 <> 0 AS is_listed FROM c) SELECT chapter_key AS chapter, 'T' || title AS title, CASE WHEN n % 30 = 21 THEN 1 ELSE ((n - 1) % 30) // 10 END AS group_pos FROM f WHERE NOT is_listed")
def j14_placement(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chapters").select(F.col("chapter_key").alias("chapter"))
    n = c.withColumn("n", F.row_number().over(Window.orderBy(I.natural_key(F.col("chapter"), 6), "chapter")))
    t = F.floor((F.col("n") - 1) / 30)
    listed = n.where("n % 30 = 1 or n % 3 <> 0 ").select(F.concat(F.lit("T"), t.cast("string")).alias("title"), t.alias("title_pos"), F.floor(((F.col("n") - 1) % 30) / 10).alias("group_pos"), F.col("n").alias("chapter_pos"), "chapter")
    return V.place_unlisted(c, listed)


@query("SELECT dir_name AS chapter FROM chapters WHERE NOT regexp_matches(dir_name, '^[0-9]+[A-Z]*$') AND volume <> 1")
def u5_outside_hierarchy(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chapters")
    return V.outside_hierarchy(c.select(F.col("dir_name").alias("chapter")), c.where("volume = 1").select(F.col("dir_name").alias("chapter")))


@query(f"SELECT record_id, chapterNumber FROM parsed WHERE {sql_key('chapterNumber')} IS NOT NULL AND {sql_key('chapterNumber')} NOT IN (SELECT chapter_key FROM chapters)")
def j23_missing_parents(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "parsed").withColumn("__chapter", section_key(F.col("chapterNumber")))
    return V.missing_parents(p, table(spark, d, "chapters"), "__chapter", "chapter_key").select("record_id", "chapterNumber")


_STATES = """b AS (SELECT batch_id, snapshot_no, lag(snapshot_no) OVER (ORDER BY snapshot_no) AS before FROM load_batches WHERE status = 'complete'),
t AS (SELECT snapshot_no, before, sectionNumber AS key, max_by(coalesce(title, '~') || chr(1) || coalesce(bodyText, '~') || chr(1) || coalesce(history, '~'), row_id) AS t FROM parsed_snapshots JOIN b USING (batch_id) GROUP BY ALL),
states AS (SELECT n.snapshot_no, n.key, CASE WHEN o.snapshot_no IS NULL THEN 'created' WHEN n.t = o.t THEN 'unchanged' ELSE 'changed' END AS state FROM t n LEFT JOIN t o ON n.key = o.key AND n.before = o.snapshot_no WHERE n.before IS NOT NULL)"""


@query(f"WITH {_STATES} SELECT * FROM states")
def k9_changed_rows(spark: SparkSession, d: str) -> DataFrame:
    """(snapshot_no, key, state) of every complete delivery against the complete one before it; the first has none before it."""
    b = table(spark, d, "load_batches").where("status = 'complete'")
    b = b.select("batch_id", "snapshot_no", F.lead("snapshot_no").over(Window.orderBy("snapshot_no")).alias("next"), F.lag("snapshot_no").over(Window.orderBy("snapshot_no")).alias("before"))
    s = table(spark, d, "parsed_snapshots").select("batch_id", F.col("sectionNumber").alias("key"), "row_id", F.struct("title", "bodyText", "history").alias("t"))
    s = s.groupBy("batch_id", "key").agg(F.max_by("t", "row_id").alias("t")).join(b, "batch_id")
    old = s.where("next is not null").select(F.col("next").alias("snapshot_no"), "key", "t")
    return V.changed_rows(s.where("before is not null").select("snapshot_no", "key", "t"), old, ["snapshot_no", "key"], F.xxhash64(F.to_json("t", {"ignoreNullFields": "false"})))


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'kept ' || c_custkey WHEN c_custkey % 4 = 1 THEN c_name ELSE 'new ' || c_custkey END AS c_name, CASE WHEN c_custkey % 4 = 0 THEN c_nationkey WHEN c_custkey % 4 = 1 THEN c_nationkey + 1 ELSE c_nationkey + 1 END AS c_nationkey FROM (SELECT c_custkey, c_nationkey, c_name FROM customer) WHERE true")
def k11_upsert(spark: SparkSession, d: str) -> DataFrame:
    c, k = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey"), F.col("c_custkey") % 4
    stored = c.where(k != 2).withColumn("c_name", F.when(k == 0, F.concat(F.lit("kept "), F.col("c_custkey").cast("string"))).otherwise(F.col("c_name")))
    new = c.where(k != 0).select("c_custkey", F.when(k == 1, "").otherwise(F.concat(F.lit("new "), F.col("c_custkey").cast("string"))).alias("c_name"), (F.col("c_nationkey") + 1).alias("c_nationkey"))
    return V.upsert(stored, new, "c_custkey", ["c_name"])


@query("SELECT DISTINCT href FROM targets WHERE target_key NOT IN (SELECT key FROM (" + f"SELECT {sql_key('sectionNumber')} AS key FROM parsed" + ") WHERE key IS NOT NULL)")
def g8_broken_links(spark: SparkSession, d: str) -> DataFrame:
    pages = sections(spark, d, "record_id").select(I.href("section", F.col("number")).alias("href"))
    return G.broken_links(table(spark, d, "targets").select("href").distinct(), pages)


# --- manifest and serialization ----------------------------------------------------------------


def _manifest(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chapters").select(F.col("chapter_key").alias("chapter"), "volume", "title")
    t = table(spark, d, "targets").select(F.regexp_extract("target_key", "^([^-:]*)", 1).alias("chapter"), "target_key", "href").distinct()
    files = t.join(c, "chapter").select("volume", "chapter", "title", F.col("target_key").alias("filename"), F.col("href").alias("url"), F.lit(False).alias("is_index"))
    return V.nest_manifest(files)


_FILES = "SELECT DISTINCT c.volume, c.chapter_key AS chapter, c.title, t.target_key AS filename, t.href AS url FROM chapters c JOIN targets t ON regexp_extract(t.target_key, '^([^-:]*)', 1) = c.chapter_key"


@query(f"SELECT *, false AS is_index FROM ({_FILES})")
def s3_manifest_files(spark: SparkSession, d: str) -> DataFrame:
    return V.flatten_manifest(_manifest(spark, d))


@query(f"SELECT count(DISTINCT volume) AS volumes, count(DISTINCT chapter) AS chapters, count(*) AS files FROM ({_FILES})")
def a14_manifest_totals(spark: SparkSession, d: str) -> DataFrame:
    return V.manifest_totals(_manifest(spark, d))


@query("SELECT n_nationkey, '{\"n_name\":\"' || n_name || '\",\"n_nationkey\":' || n_nationkey || ',\"n_regionkey\":' || n_regionkey || ',\"none\":null}' AS json FROM nation")
def k1_canonical_json(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").withColumn("none", F.lit(None).cast("string"))
    return n.select("n_nationkey", W.canonical_json(n, ["n_name"]).alias("json"))


@query("SELECT DISTINCT href AS path, '  <url><loc>https://code.example.org' || replace(href, '&', '&amp;') || '</loc></url>' AS line FROM targets")
def k7_sitemap(spark: SparkSession, d: str) -> DataFrame:
    return W.sitemap("https://code.example.org/", table(spark, d, "targets").select(F.col("href").alias("path")).distinct())


# --- pages -------------------------------------------------------------------------------------


@query(f"WITH {_FILE} SELECT p.record_id, '§' || coalesce({sql_key('p.sectionNumber')}, upper(nums[1]) || CASE WHEN len(nums) = 3 THEN ':' || upper(nums[2]) || '-' || upper(nums[3]) ELSE '-' || upper(nums[2]) END || CASE WHEN len(decs) > 0 THEN '.' || array_to_string(decs, '') ELSE '' END) AS number, docType, headingIsSupplied, titleIsSupplied, isRepealed, CASE WHEN title <> '' THEN 'true' END AS title_as_recorded FROM parsed p JOIN h ON h.record_id = p.record_id")
def d16_parse_sections(spark: SparkSession, d: str) -> DataFrame:
    """All raw pages read again: numbers and flags must be the recorded ones, and titles where one is recorded."""
    p = table(spark, d, "parsed")
    r = P.parse_sections(p.select("record_id", "filename", F.col("bodyHtml").alias("html")), key="record_id")
    r = r.join(p.select("record_id", X.unwrap_title(F.lit(""), I.clean(F.replace("title", F.lit("\u00ad"), F.lit(""))))["title"].alias("recorded")), "record_id")
    return r.select("record_id", F.concat(F.lit("§"), section_key(F.col("sectionNumber"))).alias("number"), "docType", "headingIsSupplied", "titleIsSupplied", "isRepealed", F.when(F.col("recorded") != "", (F.col("title") == F.col("recorded")).cast("string")).alias("title_as_recorded"))


@query()
def d16_all_sections(spark: SparkSession, d: str) -> DataFrame:
    """All raw pages read again, with all fields."""
    return P.parse_sections(table(spark, d, "parsed").select("record_id", "filename", F.col("bodyHtml").alias("html")), key="record_id")


@query("SELECT chapter_key AS chapter, pos::BIGINT AS pos, CASE pos WHEN 1 THEN 'CHAPTER ' || chapter_key WHEN 2 THEN title ELSE chapter_key || '-' || (pos - 2) || ' & more' END AS text, CASE pos WHEN 1 THEN 'XHead Big' WHEN 2 THEN '' ELSE 'XRow' END AS classes FROM chapters, (SELECT unnest([1, 2, 3, 4]) AS pos)")
def d25_html_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs of index pages written from the inventory, with entities, odd blanks, comments and unclosed tags."""
    k = F.col("chapter_key")
    html = F.concat(F.lit("<!-- <p>no</p> --><P class='XHead Big'>CHAPTER&nbsp;"), k, F.lit("<p>\n "), "title", F.lit("</p><p>&nbsp;</p><p class=XRow><b>"), k, F.lit("-1</b> &amp;&#160;more<p class=XRow>"), k, F.lit("\u2011<i>2</i> &amp; more</body>"))
    r = P.html_paragraphs(table(spark, d, "chapters").select(k.alias("chapter"), html.alias("html")), "chapter")
    return r.select("chapter", "pos", "text", F.array_join("classes", " ").alias("classes"))


@query()
def d25_page_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return P.html_paragraphs(table(spark, d, "parsed").select("record_id", F.col("bodyHtml").alias("html")), "record_id")


@query()
def d15_outline(spark: SparkSession, d: str) -> DataFrame:
    return L.outline(table(spark, d, "parsed").where("bodyText <> ''"), "record_id", "bodyText")


# --- citations: a corpus written from rows, read back by the detector --------------------------

CHAPTERS = 200


def citing_corpus(spark: SparkSession, d: str) -> DataFrame:
    """(sectionNumber, bodyText, annotations): one section per order, citing one thing per kind of line item.

    Section o is §(o % 200 + 1)-o. What an item cites follows from its line number, part and supplier.
    """
    n = table(spark, d, "orders").agg(F.max("o_orderkey") + 1).first()[0]
    i = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").distinct()
    t = (F.col("l_partkey") * 7 + F.col("l_suppkey")) % n
    number = lambda t: F.concat((t % CHAPTERS + 1).cast("string"), F.lit("-"), t.cast("string"))
    k, lit = (F.col("l_linenumber") * 3 + F.col("l_partkey")) % 11, F.lit
    text = (
        F.when(k == 0, F.concat(lit("section "), number(t)))
        .when(k == 1, F.concat(lit("sections "), number(t), lit(" and ["), number((t + 1) % n), lit("]")))
        .when(k == 2, F.concat(lit("section "), (t % 97 + 1).cast("string")))
        .when(k == 3, F.concat(lit("chapter "), (t % CHAPTERS + 1).cast("string"), lit(" of the Internal Revenue Code")))
        .when(k == 4, F.concat(lit("§"), (t % CHAPTERS + 1).cast("string"), lit("-"), (t + 10_000_000).cast("string")))
        .when(k == 5, F.concat(lit("H.R.S. §"), number(t)))
        .when(k == 6, F.concat(lit("sections "), number(t), lit(" to "), (t % CHAPTERS + 1).cast("string"), lit("-"), (t + 2 * CHAPTERS).cast("string")))
        .when(k == 7, F.concat(lit("section "), number(t), lit("-3")))
        .when(k == 8, F.concat(lit("chapter "), number(t)))
        .when(k == 9, F.concat(lit("Section  900-"), t.cast("string")))
        .otherwise(F.concat(lit("R.L.H. 1955, §"), number(t), lit("\n\nId. at §"), number((t + 1) % n)))
    )
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", text.alias("t")))), lambda x: x["t"]), "; see ")
    return i.groupBy("l_orderkey").agg(body.alias("bodyText")).select(F.concat(F.lit("§"), number(F.col("l_orderkey"))).alias("sectionNumber"), "bodyText", F.array().cast("array<struct<heading:string,text:string>>").alias("annotations"), F.lit("hrs").alias("docType"), F.lit("").alias("title"))


def order_targets(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, d, "orders").select(F.concat((F.col("o_orderkey") % CHAPTERS + 1).cast("string"), F.lit("-"), F.col("o_orderkey").cast("string")).alias("key"))
    sec = o.select("key", F.concat(F.lit("§"), "key").alias("number"), F.lit("").alias("title"), I.href("section", F.col("key")).alias("href"))
    ch = o.select(F.regexp_extract("key", "^([^-]*)", 1).alias("chapter")).distinct().withColumn("title", F.lit(""))
    return sec, V.chapter_targets(ch)


def _resolved(spark: SparkSession, d: str) -> DataFrame:
    b = G.text_blocks(citing_corpus(spark, d))
    return C.resolve(C.detect(b, ["source", "ord", "block"], "text"), *order_targets(spark, d))


_CITES = f"""n AS (SELECT max(o_orderkey) + 1 AS n FROM orders), i AS (SELECT DISTINCT l_orderkey AS o, (l_linenumber * 3 + l_partkey) % 11 AS k, l_linenumber AS l, l_partkey AS p, l_suppkey AS q, (l_partkey * 7 + l_suppkey) % n AS t, n FROM lineitem, n),
c AS (SELECT o, k, 0 AS j, CASE WHEN k = 2 THEN (t % 97 + 1)::VARCHAR WHEN k = 3 THEN (t % {CHAPTERS} + 1)::VARCHAR WHEN k = 4 THEN (t % {CHAPTERS} + 1) || '-' || (t + 10000000) WHEN k = 9 THEN '900-' || t ELSE (t % {CHAPTERS} + 1) || '-' || t END AS number,
CASE k WHEN 2 THEN 'bare-number' WHEN 3 THEN 'foreign-law' WHEN 4 THEN 'absent-section' WHEN 5 THEN 'superseded' WHEN 7 THEN 'admin-rules' WHEN 8 THEN 'admin-rules' WHEN 9 THEN 'unresolved' WHEN 10 THEN 'superseded' ELSE 'linked' END AS reason FROM i
UNION ALL SELECT o, k, 1, ((t + 1) % n) % {CHAPTERS} + 1 || '-' || ((t + 1) % n), CASE k WHEN 1 THEN 'linked' ELSE 'superseded' END FROM i WHERE k IN (1, 10)
UNION ALL SELECT o, k, 1, (t % {CHAPTERS} + 1) || '-' || (t + {2 * CHAPTERS}), CASE WHEN t + {2 * CHAPTERS} < n THEN 'linked' ELSE 'absent-section' END FROM i WHERE k = 6)"""
# The same with their texts: w what an item says, h that as linked text.
_SAID = f"""z AS (SELECT *, (t % {CHAPTERS} + 1) || '-' || t AS a, ((t + 1) % n) % {CHAPTERS} + 1 || '-' || ((t + 1) % n) AS b, (t % {CHAPTERS} + 1) || '-' || (t + {2 * CHAPTERS}) AS e FROM i),
y AS (SELECT *, CASE k WHEN 0 THEN 'section ' || a WHEN 1 THEN 'sections ' || a || ' and [' || b || ']' WHEN 2 THEN 'section ' || (t % 97 + 1) WHEN 3 THEN 'chapter ' || (t % {CHAPTERS} + 1) || ' of the Internal Revenue Code' WHEN 4 THEN '§' || (t % {CHAPTERS} + 1) || '-' || (t + 10000000) WHEN 5 THEN 'H.R.S. §' || a
WHEN 6 THEN 'sections ' || a || ' to ' || e WHEN 7 THEN 'section ' || a || '-3' WHEN 8 THEN 'chapter ' || a WHEN 9 THEN 'Section  900-' || t ELSE 'R.L.H. 1955, §' || a || chr(10) || chr(10) || 'Id. at §' || b END AS w FROM z),
x AS (SELECT *, CASE k WHEN 0 THEN link('section ' || a, a) WHEN 1 THEN link('sections ' || a, a) || ' and ' || link('[' || b || ']', b) WHEN 4 THEN gone(w) WHEN 6 THEN link('sections ' || a, a) || ' to ' || CASE WHEN t + {2 * CHAPTERS} < n THEN link(e, e) ELSE gone(e) END ELSE w END AS h FROM y)"""
_LINK = """'<a href="/hrs/' || {1} || '" aria-label="' || {0} || '">' || {0} || '</a>'"""
_GONE = """'<span class="absent">' || {0} || '<span class="sr-only"> (not in the current code)</span></span>'"""


def _spoken(sql: str) -> str:
    """Links and remarks written out."""
    import re

    sql = re.sub(r"link\((.*?), (a|b|e)\)", lambda m: _LINK.format(m[1] if "||" not in m[1] else f"({m[1]})", m[2]), sql)
    return re.sub(r"gone\((w|e)\)", lambda m: _GONE.format(m[1]), sql)


_SOURCE = f"'§' || (o % {CHAPTERS} + 1) || '-' || o"


@query(f"WITH {_CITES} SELECT {_SOURCE} AS source, number, reason, count(*) AS n FROM c GROUP BY ALL")
def d1_detect_and_resolve(spark: SparkSession, d: str) -> DataFrame:
    return _resolved(spark, d).groupBy("source", "number", F.coalesce("reason", F.lit("linked")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_CITES} SELECT r.reason, coalesce(n, 0) AS n FROM (VALUES ('linked'), ('bare-number'), ('foreign-law'), ('admin-rules'), ('superseded'), ('absent-section'), ('unresolved')) r(reason) LEFT JOIN (SELECT reason, count(*) AS n FROM c GROUP BY 1) x USING (reason)")
def a2_reject_tally(spark: SparkSession, d: str) -> DataFrame:
    return C.tally(_resolved(spark, d))


@query(f"WITH {_CITES} SELECT 'body' AS block, count(*) AS total, round(100.0 * count_if(reason = 'linked') / count(*), 2)::DOUBLE AS linked_pct, round(100.0 * count_if(reason = 'unresolved') / count(*), 2)::DOUBLE AS unresolved_pct FROM c")
def a10_rates(spark: SparkSession, d: str) -> DataFrame:
    return C.rates(C.tally(_resolved(spark, d), "block"), "block")


_RANGED = f"SELECT DISTINCT {_SOURCE} AS source, '§' || (t % {CHAPTERS} + 1) || '-' || (t + {CHAPTERS}) AS number FROM i WHERE k = 6 AND t + {CHAPTERS} < n"


@query(f"WITH {_CITES} {_RANGED}")
def d9_range_members(spark: SparkSession, d: str) -> DataFrame:
    b = G.text_blocks(citing_corpus(spark, d))
    unit = ["source", "ord", "block"]
    return C.range_members(C.detect(b, unit, "text"), order_targets(spark, d)[0], unit).select("source", "number").distinct()


_EDGES = f"e AS (SELECT DISTINCT {_SOURCE} AS \"from\", '§' || number AS \"to\", 'body' AS block FROM c WHERE reason = 'linked' UNION SELECT source, number, 'range' FROM ({_RANGED})), edges AS (SELECT \"from\", \"to\", 'section' AS kind, block FROM e WHERE \"from\" <> \"to\")"


def _edges(spark: SparkSession, d: str) -> DataFrame:
    return G.build_graph(citing_corpus(spark, d), *order_targets(spark, d))


@query(f"WITH {_CITES}, {_EDGES} SELECT * FROM edges")
def g3_edges(spark: SparkSession, d: str) -> DataFrame:
    return _edges(spark, d)


@query(f"WITH {_CITES}, {_EDGES} SELECT \"to\" AS node, count(DISTINCT \"from\") AS n FROM edges GROUP BY 1 ORDER BY n DESC, {sql_natural('node')}, node LIMIT 20")
def g7_most_cited(spark: SparkSession, d: str) -> DataFrame:
    return G.most_cited(_edges(spark, d))


@query(f"WITH {_CITES}, {_EDGES} SELECT \"to\" AS node, count_if(block <> 'annotation') AS statutory, count_if(block = 'annotation') AS annotations, count(*) AS total FROM edges GROUP BY 1")
def a12_degrees(spark: SparkSession, d: str) -> DataFrame:
    return G.degrees(_edges(spark, d))


@query(f"WITH {_CITES}, {_EDGES} SELECT \"from\" AS node FROM edges UNION SELECT \"to\" FROM edges")
def u1_nodes(spark: SparkSession, d: str) -> DataFrame:
    return G.nodes(_edges(spark, d))


@query(f"WITH {_CITES}, {_EDGES} SELECT \"to\" AS node, 'statutory' AS list, count(*) AS n, count(*) > 5 AS folded FROM edges GROUP BY 1")
def w5_folded_lists(spark: SparkSession, d: str) -> DataFrame:
    return G.collapsed(_edges(spark, d), 5)


@query(f"WITH {_CITES}, {_EDGES} SELECT node, max(cites)::BIGINT AS cites, max(cited_by)::BIGINT AS cited_by FROM (SELECT \"from\" AS node, count(*) AS cites, 0 AS cited_by FROM edges GROUP BY 1 UNION ALL SELECT \"to\", 0, count(*) FROM edges GROUP BY 1) GROUP BY node")
def g6_adjacency(spark: SparkSession, d: str) -> DataFrame:
    size = lambda c: F.coalesce(F.when(F.col(c).isNotNull(), F.size(c)), F.lit(0)).cast("long")
    return G.adjacency(_edges(spark, d)).groupBy("node").agg(F.sum(size("cites")).alias("cites"), F.sum(size("citedBy")).alias("cited_by"))


@query(_spoken(f"WITH {_CITES}, {_SAID} SELECT {_SOURCE} AS source, string_agg(h, '; see ' ORDER BY l, p, q) AS html FROM x GROUP BY o"))
def d10_linked_text(spark: SparkSession, d: str) -> DataFrame:
    b = G.text_blocks(citing_corpus(spark, d))
    found = C.resolve(C.detect(b, ["source"], "text"), *order_targets(spark, d))
    return L.linked(b, found, ["source"], "text")


@query()
def d10_law_text(spark: SparkSession, d: str) -> DataFrame:
    """The crawled sections' bodies as linked text."""
    b = G.text_blocks(sections(spark, d).drop("sectionNumber").withColumnRenamed("number", "sectionNumber")).where("block = 'body'")
    found = C.resolve(C.detect(b, ["source"], "text"), live_targets(spark, d), chapter_targets(spark, d))
    return L.linked(b, found, ["source"], "text")


@query()
def g1_law_edges(spark: SparkSession, d: str) -> DataFrame:
    """The citation graph of the crawled sections themselves."""
    s = sections(spark, d).drop("sectionNumber").withColumnRenamed("number", "sectionNumber")
    return G.build_graph(s, live_targets(spark, d), chapter_targets(spark, d))


def _unresolved(blocks: DataFrame, targets: tuple[DataFrame, DataFrame]) -> DataFrame:
    keys = ["source", "ord", "block"]
    return C.unresolved_report(C.resolve(C.detect(blocks, keys, "text"), *targets).join(blocks, keys), F.col("text"), ["source", "ord", "seq"])


@query(
    _spoken(
        f"""WITH {_CITES}, {_SAID}, g AS (SELECT *, {_SOURCE} AS source, string_agg(w, '; see ') OVER v AS said, string_agg(w, '; see ') OVER (PARTITION BY o ORDER BY l, p, q ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS body FROM x WINDOW v AS (PARTITION BY o ORDER BY l, p, q ROWS UNBOUNDED PRECEDING)),
u AS (SELECT '900-' || t AS number, source, length(said) - length(w) AS s, length(said) AS e, body FROM g WHERE k = 9)
SELECT number, count(*) AS n, arg_min(regexp_replace(substring(body, greatest(0, s - 40) + 1, e + 40 - greatest(0, s - 40)), '\\s+', ' ', 'g'), (source, s)) AS sample FROM u GROUP BY number ORDER BY n DESC, min((source, s)) LIMIT 20"""
    )
)
def a9_unresolved_report(spark: SparkSession, d: str) -> DataFrame:
    return _unresolved(G.text_blocks(citing_corpus(spark, d)), order_targets(spark, d))


@query()
def a9_law_report(spark: SparkSession, d: str) -> DataFrame:
    """The same report over the crawled sections."""
    b = G.text_blocks(sections(spark, d).drop("sectionNumber").withColumnRenamed("number", "sectionNumber"))
    return _unresolved(b, (live_targets(spark, d), chapter_targets(spark, d)))


@query("SELECT CASE n_nationkey % 5 WHEN 0 THEN 'uscon' WHEN 1 THEN 'const' WHEN 2 THEN 'org' WHEN 3 THEN 'adm' ELSE 'hhca' END AS doc_type, count(*) AS n FROM nation GROUP BY 1")
def a8_cross_document_counts(spark: SparkSession, d: str) -> DataFrame:
    """Citations into other documents by document, from texts written by rule."""
    from statloom.operators.crossdoc import cross_targets, detect_cross

    k, n = F.col("n_nationkey") % 5, (F.col("n_nationkey") + 1).cast("string")
    pick = lambda *x: F.element_at(F.array(*(F.lit(v) if isinstance(v, str) else v for v in x)), k + 1)
    text = pick(
        F.concat(F.lit("under Article "), n, F.lit(", section 2, of the Constitution of the United States.")), F.concat(F.lit("see article "), n, F.lit(", §2 of the Hawaii constitution.")),
        F.concat(F.lit("by the Organic Act §"), n, F.lit(", and section 1-2.")), F.concat(F.lit("section "), n, F.lit(" of the Admission Act; section 9 applies.")), F.concat(F.lit("under section "), n, F.lit(" of the Hawaiian Homes Commission Act, 1920.")),
    )
    doc = pick("uscon", "const", "org", "adm", "hhca")
    number = F.concat(F.upper(doc), F.lit(" §"), n, F.when(k < 2, "-2").otherwise(""))
    s = table(spark, d, "nation").select("n_nationkey", text.alias("text"), doc.alias("docType"), number.alias("sectionNumber"), F.lit("").alias("title"))
    found = detect_cross(s.select("n_nationkey", "text"), ["n_nationkey"], "text", cross_targets(s))
    return found.groupBy("doc_type").agg(F.count(F.lit(1)).alias("n"))


# --- search ------------------------------------------------------------------------------------


@query("SELECT t.target_key AS query, t.target_key AS number, t.href FROM (SELECT DISTINCT target_key, href FROM targets) t JOIN (SELECT DISTINCT key FROM (SELECT " + sql_key("sectionNumber") + " AS key FROM parsed)) s ON s.key = t.target_key")
def x4_jumps(spark: SparkSession, d: str) -> DataFrame:
    pages = sections(spark, d, "record_id").select(I.href("section", F.col("number")).alias("href"))
    return S.jumps(table(spark, d, "targets").select(F.col("target_key").alias("query")), pages)


# Two edits at most, each place edited once: plain edits, or a swap of neighbours with one edit at most before or after it together.
_NEAREST = f"""{_WORDS}, v AS (SELECT word FROM counts WHERE freq >= 3), q AS (SELECT word AS q FROM counts WHERE freq < 3),
m AS (SELECT q, word AS s, levenshtein(q, word) AS d FROM q JOIN v ON abs(length(word) - length(q)) <= 2 AND damerau_levenshtein(q, word) <= 2),
o AS (SELECT q, s, i, j FROM (SELECT q, s, i, unnest([i - 1, i, i + 1]) AS j FROM (SELECT q, s, unnest(range(1, length(q))) AS i FROM m)) WHERE j >= 1 AND j < length(s) AND q[i] = s[j + 1] AND q[i + 1] = s[j]),
swapped AS (SELECT q, s, min(1 + damerau_levenshtein(q[:i - 1], s[:j - 1]) + damerau_levenshtein(q[i + 2:], s[j + 2:])) AS d FROM o GROUP BY ALL),
f AS (SELECT m.q, m.s, least(m.d, coalesce(swapped.d, 9)) AS d, CASE length(m.s) - length(m.q) WHEN 0 THEN 0 WHEN -1 THEN 1 WHEN 1 THEN 2 WHEN -2 THEN 3 ELSE 4 END AS r FROM m LEFT JOIN swapped ON m.q = swapped.q AND m.s = swapped.s),
nearest AS (SELECT q AS word, arg_min(s, (d, r, s)) AS suggestion, min(d)::INTEGER AS distance FROM f WHERE d <= 2 GROUP BY q)"""


@query(f"WITH {_NEAREST} SELECT * FROM nearest")
def x6_suggestions(spark: SparkSession, d: str) -> DataFrame:
    """The nearest vocabulary word of every rare word that has one within two edits."""
    counts = S.word_counts(table(spark, d, "parsed"))
    vocab = S.vocabulary(counts).select("word")
    return S.suggestions(counts.where("freq < 3").select("word"), vocab)


@query(
    f"""WITH {_NEAREST}, t AS (SELECT DISTINCT q FROM q JOIN v ON starts_with(v.word, q) AND length(v.word) <= length(q) + 12)
SELECT 'section about ' || q.q AS query, q.q AS unknown, CASE WHEN t.q IS NULL THEN suggestion END AS suggestion, CASE WHEN t.q IS NULL THEN 'absent' ELSE 'typing' END AS state FROM q LEFT JOIN t ON t.q = q.q LEFT JOIN nearest ON nearest.word = q.q"""
)
def x5_spelling(spark: SparkSession, d: str) -> DataFrame:
    counts = S.word_counts(table(spark, d, "parsed"))
    known = S.vocabulary(counts).select("word").unionByName(spark.createDataFrame([("section",), ("about",)], "word string")).distinct()
    return S.check_spelling(counts.where("freq < 3").select(F.concat(F.lit("section about "), "word").alias("query")), known)


@query(
    r"""WITH h AS (SELECT record_id, coalesce(title, '') AS t, coalesce(bodyText, '') AS b FROM parsed), n AS (SELECT record_id, len(regexp_extract_all(lower(t), '\bfire\b')) AS t1, len(regexp_extract_all(lower(b), '\bfire\b')) AS b1, len(regexp_extract_all(lower(t), '\balarm\b')) AS t2, len(regexp_extract_all(lower(b), '\balarm\b')) AS b2 FROM h)
SELECT record_id, round(ln(1 + t1) + 0.4 * ln(1 + b1) + ln(1 + t2) + 0.4 * ln(1 + b2), 6) AS rank FROM n WHERE t1 + b1 > 0 AND t2 + b2 > 0 ORDER BY rank DESC, record_id LIMIT 20"""
)
def x1_search(spark: SparkSession, d: str) -> DataFrame:
    """Ranked search by the inverted index, which is built first."""
    p = table(spark, d, "parsed")
    S.write_index(S.posting_rows(p, "record_id"), path := scratch(spark, "index"))
    return S.search(p, "fire alarm", key="record_id", index=path).select("record_id", "rank")


@query(
    r"""WITH w AS (SELECT record_id, coalesce(title, '') AS t, coalesce(bodyText, '') AS b, coalesce(array_to_string(list_transform(annotations, lambda a: a.text), ' '), '') AS n FROM parsed),
c AS (SELECT record_id, b, len(regexp_extract_all(lower(t), '\bfire\s+alarm\b')) AS x, len(regexp_extract_all(lower(b), '\bfire\s+alarm\b')) AS y, len(regexp_extract_all(lower(n), '\bfire\s+alarm\b')) AS z, greatest(1, CASE WHEN regexp_matches(b, '(?i)\bfire\s+alarm\b') THEN length(regexp_extract(b, '(?is)^(.*?)\bfire\s+alarm\b', 1)) + 1 ELSE 0 END - 80) AS p FROM w WHERE NOT regexp_matches(lower(t || ' ' || b || ' ' || n), '\brepealed\b'))
SELECT record_id, round(ln(1 + x) + 0.4 * ln(1 + y) + 0.4 * ln(1 + z), 6) AS rank, regexp_replace(substring(b, p, 240), '(?i)\b(fire\s+alarm)\b', '<mark>\1</mark>', 'g') AS snippet FROM c WHERE x + y + z > 0 ORDER BY rank DESC, record_id LIMIT 20"""
)
def x2_snippets(spark: SparkSession, d: str) -> DataFrame:
    return S.search(table(spark, d, "parsed"), '"fire alarm" -repealed', key="record_id", annotations="annotations")


# --- more of citations, aggregates and pages ----------------------------------------------------


def _noted(spark: SparkSession, d: str) -> DataFrame:
    """The citing corpus with its bodies as annotations under headings of several kinds."""
    c = citing_corpus(spark, d)
    k = F.regexp_extract("sectionNumber", "-([0-9]+)", 1).cast("long") % 3
    head = F.when(k == 0, "Case Notes").when(k == 1, "Attorney General Opinions").otherwise("Revision Note")
    return c.withColumn("annotations", F.array(F.struct(head.alias("heading"), F.col("bodyText").alias("text"))))


@query(f"WITH {_CITES} SELECT bucket, reason, count(*) AS n FROM (SELECT 'body' AS bucket, reason FROM c UNION ALL SELECT CASE o % 3 WHEN 0 THEN 'Case Notes' WHEN 1 THEN 'Attorney General Opinions' ELSE 'other' END, reason FROM c) GROUP BY ALL")
def a3_tally_by_bucket(spark: SparkSession, d: str) -> DataFrame:
    """Counts by bucket (body, or the kind of annotation) and reason."""
    s = _noted(spark, d)
    notes = s.select(F.col("sectionNumber").alias("source"), X.note_kind(F.col("annotations")[0]["heading"]).alias("bucket"), F.col("annotations")[0]["text"].alias("text"))
    blocks = notes.unionByName(s.select(F.col("sectionNumber").alias("source"), F.lit("body").alias("bucket"), F.col("bodyText").alias("text")))
    return C.tally(C.resolve(C.detect(blocks, ["source", "bucket"], "text"), *order_targets(spark, d)), "bucket")


@query("SELECT o_orderkey, (o_orderkey % 200 + 1) || '-' || (CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey + 50000000 ELSE o_orderkey END) AS number, '§' || (o_orderkey % 200 + 1) || '-' || o_orderkey AS target FROM orders")
def j3_alias_resolution(spark: SparkSession, d: str) -> DataFrame:
    """Half of the numbers are wrong ones that the ledger corrects."""
    sec, ch = order_targets(spark, d)
    k = F.col("o_orderkey")
    c = F.concat((k % CHAPTERS + 1).cast("string"), F.lit("-"))
    o = table(spark, d, "orders").select("o_orderkey", F.concat(c, F.when(k % 2 == 0, k + 50_000_000).otherwise(k).cast("string")).alias("n"), F.concat(c, k.cast("string")).alias("right"))
    aliases = K.number_aliases(o.where("o_orderkey % 2 = 0").select(F.concat(F.lit("§"), "n").alias("observed"), F.concat(F.lit("§"), "right").alias("corrected"), F.lit("sectionNumber").alias("field"), F.lit("conclusive").alias("confidence")))
    found = C.detect(o.select("o_orderkey", F.concat(F.lit("see section "), "n", F.lit(".")).alias("text")), ["o_orderkey"], "text")
    return C.resolve(found, sec, ch, aliases).select("o_orderkey", "number", "target")


@query(f"WITH {_STATES} SELECT snapshot_no, state, count(*) AS n FROM states GROUP BY ALL")
def a16_run_counters(spark: SparkSession, d: str) -> DataFrame:
    return k9_changed_rows(spark, d).groupBy("snapshot_no", "state").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT record_id, regexp_replace(substring(bodyText, greatest(0, p - 41) + 1, (p + 4 + 40) - greatest(0, p - 41)), '[ \\t\\n\\x{0b}\\f\\r]+', ' ', 'g') AS sample FROM (SELECT record_id, bodyText, strpos(bodyText, 'shall') AS p FROM parsed) WHERE p > 0")
def f23_samples(spark: SparkSession, d: str) -> DataFrame:
    p = F.instr(F.col("bodyText"), "shall")
    return table(spark, d, "parsed").where(p > 0).select("record_id", X.sample(F.col("bodyText"), p - 1, p + 4).alias("sample"))


@query("SELECT record_id, CASE WHEN regexp_matches(title, '^\\[[^\\[\\]]+\\]$') THEN trim(title[2:-2]) ELSE title END AS title, starts_with(sectionNumber, '[') AS heading_supplied, regexp_matches(title, '^\\[[^\\[\\]]+\\]$') AS title_supplied FROM parsed WHERE title IS NOT NULL AND sectionNumber IS NOT NULL")
def f27_unwrapped_titles(spark: SparkSession, d: str) -> DataFrame:
    t = X.unwrap_title(F.col("sectionNumber"), F.col("title"))
    return table(spark, d, "parsed").where("title is not null and sectionNumber is not null").select("record_id", t.alias("t")).select("record_id", "t.title", "t.heading_supplied", "t.title_supplied")


@query("SELECT record_id, coalesce(trim(partHeading) <> '' AND length(trim(partHeading)) <= 90 AND NOT regexp_matches(partHeading, '[a-z]') AND NOT regexp_matches(trim(partHeading), '(?i)^\\[?\\s*(PART|SUBPART|ARTICLE|DIVISION|TITLE|CHAPTER)\\s+[IVXLCDM0-9]'), false) AS part_is_catchline, coalesce(trim(upper(title)) <> '' AND length(trim(title)) <= 90 AND NOT regexp_matches(trim(upper(title)), '(?i)^\\[?\\s*(PART|SUBPART|ARTICLE|DIVISION|TITLE|CHAPTER)\\s+[IVXLCDM0-9]') AND NOT regexp_matches(upper(title), '[a-z]'), false) AS title_is_catchline FROM parsed")
def f28_catchlines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "parsed").select("record_id", X.is_catchline(F.col("partHeading")).alias("part_is_catchline"), X.is_catchline(F.upper("title")).alias("title_is_catchline"))


@query("SELECT chapter_key, volume, last_value(CASE WHEN n % 40 = 1 THEN 'Division ' || n END IGNORE NULLS) OVER (ORDER BY n ROWS UNBOUNDED PRECEDING) AS division FROM (SELECT *, row_number() OVER (ORDER BY " + sql_natural("chapter_key", 6) + ", chapter_key) AS n FROM chapters)")
def w4_divisions(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chapters").select("chapter_key", "volume", F.row_number().over(Window.orderBy(I.natural_key(F.col("chapter_key"), 6), "chapter_key")).alias("n"))
    c = c.withColumn("d", F.when(F.col("n") % 40 == 1, F.concat(F.lit("Division "), F.col("n").cast("string"))))
    return L.require_carried(L.carry_forward(c, "d", ["n"], None, "division"), "division", "chapter_key").select("chapter_key", "volume", "division")


@query(f"WITH {_WORDS}, v AS (SELECT word FROM counts WHERE freq >= 3) SELECT DISTINCT q AS word FROM (SELECT substring(word, 1, 5) AS q FROM counts) JOIN v ON starts_with(v.word, q) AND length(v.word) <= length(q) + 12")
def j21_prefixes(spark: SparkSession, d: str) -> DataFrame:
    counts = S.word_counts(table(spark, d, "parsed"))
    return S.being_typed(counts.select(F.substring("word", 1, 5).alias("word")).distinct(), S.vocabulary(counts))


@query(f"WITH {_NEAREST} SELECT 'asked ' || word || ' law' AS query, 'asked ' || suggestion || ' law' AS fixed FROM nearest")
def x7_fixed_queries(spark: SparkSession, d: str) -> DataFrame:
    s = x6_suggestions(spark, d)
    return S.apply_fix(s.select(F.concat(F.lit("asked "), "word", F.lit(" law")).alias("query"), F.col("word").alias("unknown"), "suggestion"))


@query("SELECT chapter_key AS chapter, '{\"title\":\"' || title || '\",\"volume\":' || volume || '}' AS json FROM chapters")
def k2_chapter_map(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chapters").select(F.col("chapter_key").alias("chapter"), "title", "volume", F.lit("").alias("notes"), F.array().cast("array<struct<heading:string,text:string>>").alias("annotations"))
    return W.chapter_map(c)


@query("SELECT c.volume, c.chapter_key AS chapter, 'HRS_' || lpad(c.chapter_key, 4, '0') || '-.htm' AS filename, 'https://code.example.org/Vol' || c.volume || '/' || c.dir_name || '/HRS_' || lpad(c.chapter_key, 4, '0') || '-.htm' AS url, true AS is_index FROM chapters c")
def s9_discovery(spark: SparkSession, d: str) -> DataFrame:
    """Directory pages written from the inventory, crawled again."""
    root = "https://code.example.org/"
    c = table(spark, d, "chapters").select("volume", "dir_name", F.concat(F.lit("HRS_"), F.lpad("chapter_key", 4, "0"), F.lit("-.htm")).alias("f"))
    up, link = F.lit('<a href="../">[To Parent Directory]</a>'), lambda x: F.concat(F.lit('<br><A HREF="'), x, F.lit('">x</A>'))
    vol = F.concat(F.lit(root + "Vol"), F.col("volume").cast("string"), F.lit("/"))
    files = c.select(F.concat(vol, "dir_name", F.lit("/")).alias("base"), F.concat(up, link(F.col("f"))).alias("html"))
    dirs = c.groupBy("volume").agg(F.array_join(F.sort_array(F.collect_list(link(F.concat("dir_name", F.lit("/"))))), "").alias("h")).select(vol.alias("base"), F.concat(up, "h").alias("html"))
    top = c.agg(F.array_join(F.sort_array(F.collect_set(link(F.concat(F.lit("/Vol"), F.col("volume").cast("string"), F.lit("/"))))), "").alias("html")).select(F.lit(root).alias("base"), "html")
    return V.discover(files.unionByName(dirs).unionByName(top), root)


@query()
def r2_section_pages(spark: SparkSession, d: str) -> DataFrame:
    from statloom.operators.render import section_pages

    s = sections(spark, d).drop("sectionNumber").withColumn("history", F.coalesce("history", F.lit("")))
    named = s.withColumn("sectionNumber", F.col("number"))
    b = named.select(F.col("number").alias("section"), F.explode(F.array(F.struct(F.lit("title").alias("part"), F.col("title").alias("text")), F.struct(F.lit("body").alias("part"), F.col("bodyText").alias("text")))).alias("x")).select("section", "x.part", "x.text").where("text <> ''")
    t, c = live_targets(spark, d), chapter_targets(spark, d)
    html = L.linked(b, C.resolve(C.detect(b, ["section", "part"], "text"), t, c), ["section", "part"], "text")
    bodies = html.groupBy(F.col("section").alias("number")).agg(F.max(F.when(F.col("part") == "title", F.col("html"))).alias("title_html"), F.max(F.when(F.col("part") == "body", F.col("html"))).alias("body_html"))
    cited = L.cited_by(G.build_graph(named, t, c), t.select("number", F.col("number").alias("label"), "title"))
    return section_pages(s, bodies, cited, c.select(F.col("key").alias("chapter"), "title"))


@query()
def r3_chapter_pages(spark: SparkSession, d: str) -> DataFrame:
    from statloom.operators.render import chapter_pages

    return chapter_pages(sections(spark, d), chapter_targets(spark, d).select(F.col("key").alias("chapter"), "title"))


@query("SELECT '/hrs/volume/' || volume AS path, count(*) AS links FROM chapters GROUP BY volume")
def r4_volume_pages(spark: SparkSession, d: str) -> DataFrame:
    from statloom.operators.render import volume_pages

    v = volume_pages(table(spark, d, "chapters").select("volume", F.col("chapter_key").alias("chapter"), "title"))
    return v.select("path", F.size(F.regexp_extract_all("html", F.lit('href="/hrs/chapter/[^"]+"'), F.lit(0))).cast("long").alias("links"))


@query("SELECT '/' AS path, count(DISTINCT volume) AS volumes FROM chapters")
def r7_home_page(spark: SparkSession, d: str) -> DataFrame:
    from statloom.operators.render import home_page

    h = home_page(table(spark, d, "parsed"), table(spark, d, "chapters"))
    return h.select("path", F.size(F.regexp_extract_all("html", F.lit('href="/hrs/volume/[0-9]+"'), F.lit(0))).cast("long").alias("volumes"))


@query(f"WITH {_CITES}, {_EDGES} SELECT \"to\" AS node, 'Cited by' AS list, count(*) AS n, count(*) > 5 AS folded, string_agg(\"from\" || CASE WHEN block = 'range' THEN ' (range)' ELSE '' END, '|' ORDER BY {sql_natural('\"from\"')}, \"from\", block = 'range') AS shown FROM edges GROUP BY 1")
def r8_cited_by(spark: SparkSession, d: str) -> DataFrame:
    e = _edges(spark, d)
    sec, _ = order_targets(spark, d)
    shown = F.array_join(F.transform("rows", lambda x: F.concat(x["label"], F.when(x["in_range"], " (range)").otherwise(""))), "|")
    return L.cited_by(e, sec.select("number", F.col("number").alias("label"), "title"), 5).select("node", "list", "n", "folded", shown.alias("shown"))


@query()
def d22_title_banners(spark: SparkSession, d: str) -> DataFrame:
    """Title pages written from the inventory, read again."""
    c = table(spark, d, "chapters")
    row = F.concat(F.lit("<p class=RegularParagraphs>"), "chapter_key", F.lit(" "), "title", F.lit("</p>"))
    rows = c.groupBy("volume").agg(F.array_join(F.sort_array(F.collect_list(row)), "").alias("h"))
    v = F.col("volume").cast("string")
    html = F.concat(F.lit("<body><p class=RegularParagraphs>DIVISION "), v, F.lit(". NAME</p><p class=RegularParagraphs>TITLE "), v, F.lit(". FIRST</p><p class=RegularParagraphs>AND SECOND LINE</p><p class=RegularParagraphs>Chapter</p>"), "h", F.lit("</body>"))
    t = P.parse_title_banners(rows.select("volume", html.alias("html")), "volume")
    return t.select("volume", "number", "name", "division_number", F.aggregate("listing", F.lit(0), lambda s, g: s + F.size(g["chapters"])).cast("long").alias("chapters"))


SQL["d22_title_banners"] = "SELECT volume, volume::VARCHAR AS number, 'FIRST AND SECOND LINE' AS name, volume AS division_number, count(*) AS chapters FROM chapters GROUP BY volume"


@query("SELECT chapter_key AS chapter, chapter_key || '-' || n AS number, 'Row ' || n || ' of ' || title AS row_title, n AS pos FROM chapters, (SELECT unnest(range(1, 4)) AS n)")
def d23_section_listings(spark: SparkSession, d: str) -> DataFrame:
    """Chapter index pages written from the inventory, their listings read again; rows are wrapped over two paragraphs."""
    k = F.col("chapter_key")
    row = lambda n: F.concat(F.lit("<p>"), k, F.lit(f"-{n} Row {n} of</p><p>"), "title", F.lit("</p>"))
    html = F.concat(F.lit("<p>CHAPTER "), k, F.lit("</p><p>NAME</p><p>Section</p>"), row(1), F.lit("<p class=XNotes>Note</p><p>PART II</p>"), row(2), row(3))
    return P.parse_listings(table(spark, d, "chapters").select(k.alias("chapter"), html.alias("html")))


@query()
def d21_chapter_indexes(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("chapter_key")
    html = F.concat(F.lit("<p>CHAPTER "), k, F.lit("</p><p>"), "title", F.lit("</p><p>A note.</p><p class=XNotesHeading>Note</p><p class=XNotes>Text</p><p>Section</p><p>"), k, F.lit("-1 Row</p>"))
    c = P.parse_chapter_indexes(table(spark, d, "chapters").select(k.alias("chapter"), html.alias("html")), "chapter")
    return c.select("chapter", "title", "notes", F.size("annotations").cast("long").alias("annotations"))


SQL["d21_chapter_indexes"] = "SELECT chapter_key AS chapter, title, 'A note.' AS notes, 1 AS annotations FROM chapters"
