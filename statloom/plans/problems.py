"""Queries of the general problems over the project's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.operators.history_chains import section_versions
from statloom.operators.orphan_refs import count_orphans, law_orphans
from statloom.operators.packed_values import enactment_clauses
from statloom.operators.snapshot_diff import section_changes
from statloom.runtime import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return enactment_clauses(table(spark, d, "parsed"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return law_orphans(table(spark, d, "parsed"), table(spark, d, "targets"), table(spark, d, "chapters"))


def p3_by_table_and_month(spark: SparkSession, d: str) -> DataFrame:
    ref_table = F.when(F.col("ref_kind") == "section", "targets").otherwise("chapters")
    return count_orphans(p3_found(spark, d).withColumn("ref_table", ref_table), "ref_table", "ref_month")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return section_versions(table(spark, d, "parsed_snapshots"), table(spark, d, "load_batches"))


def p4_two_late_deliveries(spark: SparkSession, d: str) -> DataFrame:
    """The same versions where late rows come in two deliveries, each applied to the stored chains."""
    return section_versions(table(spark, d, "parsed_snapshots"), table(spark, d, "load_batches"), 2)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return section_changes(table(spark, d, "parsed_snapshots"), table(spark, d, "load_batches"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (p1_found, p3_found, p3_by_table_and_month, p4_found, p4_two_late_deliveries, p6_found)}


def _sql_text(c: str) -> str:
    """``same_text`` in SQL."""
    return f"nfc_normalize(trim(regexp_replace(translate({c}, '‑­', '-'), '[\\s\\x{{0b}}\\x{{1c}}-\\x{{1f}}\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]+', ' ', 'g')))"


def _sql_key(c: str) -> str:
    """``section_key`` in SQL."""
    return f"nullif(upper(regexp_replace(regexp_replace(translate({c}, '‐‑‒–−﹣－[]§­', '-------'), '[\\s\\x{{a0}}]+', '', 'g'), '^0+([0-9])', '\\1')), '')"


_CURRENT = f"c AS (SELECT * FROM (SELECT {_sql_key('sectionNumber')} AS section_key, snapshot_no::BIGINT AS n, {_sql_text('title')} AS t, {_sql_text('bodyText')} AS b, {_sql_text('history')} AS h, isRepealed AS r, row_number() OVER (PARTITION BY {_sql_key('sectionNumber')}, snapshot_no ORDER BY loaded_at DESC, row_id DESC) AS rn FROM parsed_snapshots JOIN load_batches USING (batch_id) WHERE status = 'complete') WHERE rn = 1 AND section_key IS NOT NULL)"

# Clauses by their grammar: quoted ones whole, others by law, year, chapter, section and remark.
_ACT = r"(?:L\s+Sp\s+\d+\s+\w+|L\s+\d+|PC\s+\d+)(?:,\s+c\s+\d+(?:\s+&\s+c\s+\d+)*)?(?:,\s+(?:pt\s+of\s+)?§+\d+(?:-\d+)?(?:,\s+\d+)*(?:\(\d+\))?)?"
_CLAUSE = rf'"(?:""|[^"])*"|“[^”]*”|(?:(?:am imp|am|ren|ree|sup|gen)\s+)?(?:{_ACT}|(?:RL|CC)\s+\d+,\s+§\d+(?:-\d+)?|HRS\s+§\d+-\d+)(?:\s+\([^()]*\))?'

# References by their grammar: the names of other bodies of law are part of the match, and such matches are left out.
_W = r"[\s\x{a0}]"
_SEC = r"\d+[A-Za-z]{0,2}(?::\d+[A-Za-z]{0,2})?\x{ad}?[-‐‑‒–−]\x{ad}?\d+(?:\.\d+)?"
_CH = r"\d+[A-Za-z]{0,2}"
_OTHER_LAW = rf"(?:United{_W}+States{_W}+Code|U\.S\.C\.|administrative{_W}+rules|Revised{_W}+Ordinances|RL{_W}+\d{{4}},)"


def _sql_list(number: str) -> str:
    item = rf"(?:\[{_W}*)?{number}(?:{_W}*\(\w{{1,5}}\))*(?:{_W}*\])?(?:\(\w{{1,5}}\))*"
    return rf"{item}(?:{_W}*(?:,{_W}*(?:and|or)?|and|or|to){_W}*{item})*"


def _sql_refs(kind: str, word: str, number: str, end: str = "") -> str:
    whole = rf"(?i)(?:{_OTHER_LAW}{_W}+)?(?:{word}){_sql_list(number)}{end}(?:{_W}+of{_W}+the{_W}+Uniform)?"
    return f"""SELECT record_id, crawled_at, 'bodyText', '{kind}', unnest(regexp_extract_all(regexp_replace(m, '\\([A-Za-z0-9]{{1,5}}\\)', ' ', 'g'), '{number}'))
FROM (SELECT record_id, crawled_at, unnest(regexp_extract_all(bodyText, '{whole}')) AS m FROM parsed) WHERE regexp_matches(m, '(?i)^(section|chapter|§)') AND NOT regexp_matches(m, 'of{_W}+the{_W}+Uniform$')"""


_ORPHANS = f"""r(record_id, crawled_at, ref_field, ref_kind, raw) AS (SELECT record_id, crawled_at, 'sectionNumber', 'section', sectionNumber FROM parsed UNION ALL SELECT record_id, crawled_at, 'chapterNumber', 'chapter', chapterNumber FROM parsed
UNION ALL {_sql_refs('section', rf'\bsections?\b{_W}*|§+{_W}*', _SEC)} UNION ALL {_sql_refs('chapter', rf'\bchapters?\b{_W}*', _CH, r'\b')}),
k AS (SELECT DISTINCT record_id, crawled_at, ref_field, ref_kind, {_sql_key('raw')} AS ref_key FROM r WHERE {_sql_key('raw')} IS NOT NULL),
t AS (SELECT 'section' AS ref_kind, {_sql_key('target_key')} AS ref_key, added_at, dropped_at FROM targets UNION ALL SELECT 'chapter', {_sql_key('chapter_key')}, added_at, dropped_at FROM chapters),
j AS (SELECT k.*, bool_or(coalesce(t.added_at <= k.crawled_at AND (t.dropped_at IS NULL OR t.dropped_at > k.crawled_at), false)) AS holds, bool_or(coalesce(t.added_at <= k.crawled_at, false)) AS was, count(t.ref_key) AS n FROM k LEFT JOIN t USING (ref_kind, ref_key) GROUP BY ALL),
o AS (SELECT record_id, ref_field, ref_kind, ref_key, CASE WHEN n = 0 THEN 'missing' WHEN was THEN 'deleted' ELSE 'late' END AS reason, strftime(crawled_at, '%Y-%m') AS ref_month FROM j WHERE NOT holds)"""

SQL: dict[str, str] = {
    "p1_found": f"""SELECT record_id, pos::BIGINT AS pos, regexp_replace(replace(CASE WHEN starts_with(e, '"') OR starts_with(e, '“') THEN e[2:-2] ELSE e END, '""', '"'), '\\s+', ' ', 'g') AS entry
FROM (SELECT record_id, unnest(l) AS e, generate_subscripts(l, 1) AS pos FROM (SELECT record_id, regexp_extract_all(history, '{_CLAUSE}') AS l FROM parsed WHERE history IS NOT NULL))""",
    "p3_found": f"WITH {_ORPHANS} SELECT * FROM o",
    "p3_by_table_and_month": f"WITH {_ORPHANS} SELECT CASE ref_kind WHEN 'section' THEN 'targets' ELSE 'chapters' END AS ref_table, ref_month, reason, count(*) AS n FROM o GROUP BY ALL",
    "p4_found": f"""WITH {_CURRENT}, m AS (SELECT *, CASE WHEN lag(n) OVER w = n - 1 AND lag(t) OVER w IS NOT DISTINCT FROM t AND lag(b) OVER w IS NOT DISTINCT FROM b AND lag(r) OVER w IS NOT DISTINCT FROM r THEN 0 ELSE 1 END AS begins FROM c WINDOW w AS (PARTITION BY section_key ORDER BY n)),
g AS (SELECT *, sum(begins) OVER (PARTITION BY section_key ORDER BY n ROWS UNBOUNDED PRECEDING) AS run FROM m)
SELECT section_key, min(n) AS first_snapshot, max(n) AS last_snapshot FROM g GROUP BY section_key, run""",
    "p6_found": f"""WITH {_CURRENT}
SELECT coalesce(x.section_key, y.section_key) AS section_key, coalesce(x.n, y.n + 1) AS snapshot_no, CASE WHEN y.n IS NULL THEN 'added' WHEN x.n IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
FROM (SELECT * FROM c WHERE n >= 2) x FULL JOIN (SELECT * FROM c WHERE n <= 7) y ON x.section_key = y.section_key AND x.n = y.n + 1
WHERE y.n IS NULL OR x.n IS NULL OR x.b IS DISTINCT FROM y.b OR x.h IS DISTINCT FROM y.h""",
}
SQL["p4_two_late_deliveries"] = SQL["p4_found"]
