"""Search over the corpus: vocabulary, spelling, jumps by number, ranked text search."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.identity import slug
from statloom.functions.text import query_number, words

MIN_LENGTH, MIN_FREQUENCY, MAX_EDITS = 5, 3, 2
TITLE_WEIGHT, BODY_WEIGHT, NOTE_WEIGHT = 1.0, 0.4, 0.4


def word_counts(sections: DataFrame, title: str = "title", body: str = "bodyText", annotations: str | None = "annotations") -> DataFrame:
    """(word, freq) over titles, bodies and annotation texts; histories are no part."""
    texts = [F.coalesce(title, F.lit("")), F.coalesce(body, F.lit(""))]
    if annotations:
        texts.append(F.concat_ws(" ", F.transform(annotations, lambda a: a["text"])))
    return sections.select(F.explode(words(F.concat_ws(" ", *texts), MIN_LENGTH)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("freq"))


def vocabulary(counts: DataFrame, least: int = MIN_FREQUENCY) -> DataFrame:
    return counts.where((F.length("word") >= MIN_LENGTH) & (F.col("freq") >= least))


# --- spelling ----------------------------------------------------------------------------------


def osa(a: str, b: str, most: int = MAX_EDITS) -> int:
    """Edit distance with neighbouring swaps as one edit, each place edited once (optimal string alignment); most + 1 beyond ``most``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            d = min(new[j - 1] + 1, row[j] + 1, row[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            new.append(d)
        if min(new) > most:
            return most + 1
        before, row = row, new
    return min(row[-1], most + 1)


@F.pandas_udf(T.IntegerType())
def _osa_columns(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(np.fromiter((osa(x, y) for x, y in zip(a, b, strict=True)), np.int32, len(a)))


def _deletions(word: str, depth: int) -> list[str]:
    out, last = {word}, {word}
    for _ in range(depth):
        last = {w[:i] + w[i + 1 :] for w in last for i in range(len(w))}
        out |= last
    return sorted(out)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _deleted(w: pd.Series) -> pd.Series:
    return w.map(lambda x: _deletions(x, MAX_EDITS))


def suggestions(queries: DataFrame, vocab: DataFrame) -> DataFrame:
    """(word, suggestion, distance): the vocabulary word nearest to each query word, within two edits; queries distinct.

    Ties: same length first, then one shorter, one longer, two shorter, two longer, then the order of words. Words within two edits
    have a form with at most two letters left out in common, so an equi join on these forms finds all; no pair of all words is made.
    """
    q = queries.select("word").distinct()
    a = q.select("word", F.explode(_deleted("word")).alias("form"))
    b = vocab.select(F.col("word").alias("suggestion")).distinct().select("suggestion", F.explode(_deleted("suggestion")).alias("form"))
    near = a.join(b, "form").where(F.abs(F.length("word") - F.length("suggestion")) <= MAX_EDITS).select("word", "suggestion").distinct()
    near = near.withColumn("distance", _osa_columns("word", "suggestion")).where(F.col("distance") <= MAX_EDITS)
    gap = F.length("suggestion") - F.length("word")
    rank = F.when(gap == 0, 0).when(gap == -1, 1).when(gap == 1, 2).when(gap == -2, 3).otherwise(4)
    best = F.min_by(F.struct("suggestion", "distance"), F.struct("distance", rank, "suggestion"))
    return near.groupBy("word").agg(best.alias("b")).select("word", "b.*")


def being_typed(queries: DataFrame, vocab: DataFrame, more: int = 12) -> DataFrame:
    """Query words with which some vocabulary word of at most ``more`` further letters begins."""
    n = F.explode(F.sequence(F.greatest(F.lit(1), F.length("word") - more), F.length("word"))).alias("n")
    heads = vocab.select("word", n).where("n > 0").select(F.expr("substring(word, 1, n)").alias("word")).distinct()
    return queries.join(heads, "word", "left_semi")


def check_spelling(queries: DataFrame, vocab: DataFrame) -> DataFrame:
    """(query, unknown, suggestion, state) of queries (column ``query``): the first unknown word of each.

    state: ok, absent or typing (the last word, unfinished, begins a known one). Queries in the form of a number are ok.
    """
    found = F.regexp_extract_all(F.lower("query"), F.lit("([a-z][a-z'’-]{4,})"), F.lit(1))
    q = queries.select("query").distinct().withColumn("__w", F.transform(found, lambda w: F.regexp_replace(w, r"['’-]+\z", "")))
    q = q.withColumn("__w", F.when(query_number(F.col("query")).isNull(), F.col("__w")).otherwise(F.array().cast("array<string>")))
    each = q.select("query", F.size("__w").alias("n"), F.posexplode("__w").alias("at", "word")).where(F.length("word") >= MIN_LENGTH)
    unknown = each.join(vocab.select("word"), "word", "left_anti")
    first = unknown.groupBy("query").agg(F.min_by(F.struct("word", "at", "n"), "at").alias("f")).select("query", "f.*")
    typing = being_typed(first.select("word").distinct(), vocab).select("word", F.lit(True).alias("__typing"))
    fixes = suggestions(first, vocab)
    r = first.join(typing, "word", "left").join(fixes, "word", "left")
    still = F.coalesce("__typing", F.lit(False)) & (F.col("at") == F.col("n") - 1) & ~F.col("query").rlike(r"[\s.,;:]\z")
    r = r.select("query", F.col("word").alias("unknown"), F.when(~still, F.col("suggestion")).alias("suggestion"), F.when(still, "typing").otherwise("absent").alias("state"))
    return queries.select("query").distinct().join(r, "query", "left").select("query", "unknown", "suggestion", F.coalesce("state", F.lit("ok")).alias("state"))


def apply_fix(checked: DataFrame) -> DataFrame:
    """(query, fixed): the first unknown word replaced by its suggestion."""
    quoted = F.concat(F.lit(r"(?i)(?<![a-z'’-])\Q"), F.col("unknown"), F.lit(r"\E['’-]*(?![a-z'’-])"))
    at = F.regexp_instr("query", quoted)
    found = F.coalesce(F.regexp_substr("query", quoted), F.lit(""))
    fixed = F.concat(F.substr("query", F.lit(1), at - 1), F.col("suggestion"), F.substr(F.col("query"), at + F.length(found)))
    return checked.select("query", F.when(F.col("suggestion").isNotNull() & (at > 0), fixed).otherwise(F.col("query")).alias("fixed"))


def jumps(queries: DataFrame, pages: DataFrame) -> DataFrame:
    """(query, number, href) of queries in the form of a section number whose page exists."""
    q = queries.select("query").distinct().withColumn("number", query_number(F.col("query"))).where("number is not null")
    q = q.withColumn("href", F.concat(F.lit("/hrs/"), slug(F.col("number"))))
    return q.join(pages.select("href").distinct(), "href", "left_semi").select("query", "number", "href")


# --- ranked search -----------------------------------------------------------------------------


_TERM = "[a-z0-9]+"
INDEX_PARTS = 64


def posting_rows(sections: DataFrame, key: str = "sectionNumber", title: str = "title", body: str = "bodyText", annotations: str | None = None) -> DataFrame:
    """(term, key, in_title, in_body, in_notes): how often each word stands in each field of each section; null fields hold none."""
    note = F.concat_ws(" ", F.transform(annotations, lambda a: a["text"])) if annotations else F.lit("")
    said = lambda n, c: F.transform(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(_TERM), F.lit(0)), lambda t: F.struct(F.lit(n).alias("field"), t.alias("term")))
    each = sections.select(F.col(key).alias("key"), F.explode(F.concat(said(0, F.col(title)), said(1, F.col(body)), said(2, note))).alias("t"))
    n = lambda k: F.count_if(F.col("t.field") == k)
    return each.groupBy(F.col("t.term").alias("term"), "key").agg(n(0).alias("in_title"), n(1).alias("in_body"), n(2).alias("in_notes"))


def _index_part(term) -> object:
    return F.pmod(F.xxhash64(term), F.lit(INDEX_PARTS)).cast("int")


def write_index(postings: DataFrame, path: str) -> None:
    """The inverted index: postings in parts by their term's hash, sorted by term within, so that a lookup reads a part's matching row groups alone.

    A term of very many sections takes several files of its part, by key.
    """
    p = postings.withColumn("part", _index_part(F.col("term")))
    p.repartition("part", F.pmod(F.xxhash64("key"), F.lit(8))).sortWithinPartitions("part", "term", "key").write.partitionBy("part").parquet(path)


def postings_of(spark: SparkSession, path: str, terms: Sequence[str]) -> DataFrame:
    """The postings of some terms, read by part and term."""
    terms = sorted(set(terms))
    parts = [r[0] for r in spark.createDataFrame([(t,) for t in terms], "term string").select(_index_part(F.col("term"))).distinct().collect()]  # one row per word of a query
    return spark.read.parquet(path).where(F.col("part").isin(parts) & F.col("term").isin(terms)).drop("part")


def parsed_query(query: str) -> tuple[list[str], list[str]]:
    """(wanted, barred): words and quoted phrases, in lower case, their words parted by one blank; a minus before one bars it."""
    wanted, barred = [], []
    for minus, phrase, word in re.findall(r"(-?)(?:\"([^\"]+)\"|([^\s\"]+))", query.lower()):
        t = " ".join(re.findall(_TERM, phrase or word))
        if t:
            (barred if minus else wanted).append(t)
    return wanted, barred


def _hits(c: str, terms: list[str]) -> list:
    return [F.size(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(rf"(?<![a-z0-9])({t})(?![a-z0-9])"), F.lit(1))) for t in terms]


def search(sections: DataFrame, query: str, k: int = 20, offset: int = 0, key: str = "sectionNumber", title: str = "title", body: str = "bodyText", annotations: str | None = None, index: str | None = None) -> DataFrame:
    """The k best sections that hold every word of the query: (key, rank, snippet), rank by weighted counts, log-damped.

    Words in quotes go together, a word after a minus must not occur. Ties in key order. The snippet is the text around the first hit
    with the words marked. No stemming is done. index: path of the sections' inverted index; with it only sections that hold all words are read, and where
    the query has single words alone, only the k that are shown.
    """
    said, unsaid = parsed_query(query)
    if not said:
        return sections.select(key, F.lit(0.0).alias("rank"), F.lit("").alias("snippet")).limit(0)
    ranked = None
    if index is not None:
        terms = sorted({w for t in said for w in t.split()})
        p = postings_of(sections.sparkSession, index, terms).groupBy(F.col("key").alias(key))
        damped = lambda c: F.log1p(F.col(c).cast("double"))
        times = F.element_at(F.create_map(*(F.lit(x) for t in terms for x in (t, float(said.count(t))))), F.col("term"))
        weighed = times * (TITLE_WEIGHT * damped("in_title") + BODY_WEIGHT * damped("in_body") + (NOTE_WEIGHT * damped("in_notes") if annotations else F.lit(0.0)))
        held = p.agg(F.count(F.lit(1)).alias("__n"), F.sum(weighed).alias("rank")).where(F.col("__n") == len(terms))
        if unsaid or any(" " in t for t in said):
            sections = sections.join(held.select(key), key, "left_semi")
        else:
            ranked = held.select(key, F.round("rank", 6).alias("rank")).orderBy(F.desc("rank"), key).offset(offset).limit(k)
            sections = sections.join(ranked, key)
    wanted, barred = ([t.replace(" ", r"\s+") for t in ts] for ts in (said, unsaid))
    pattern = rf"(?i)(?<![a-z0-9])({'|'.join(wanted)})(?![a-z0-9])"
    at = F.greatest(F.lit(1), F.regexp_instr(F.coalesce(body, F.lit("")), F.lit(pattern)) - 80)
    snippet = F.regexp_replace(F.substr(F.coalesce(body, F.lit("")), at, F.lit(240)), pattern, "<mark>$1</mark>").alias("snippet")
    if ranked is not None:
        return sections.select(key, "rank", snippet).orderBy(F.desc("rank"), key)
    fields = [(title, TITLE_WEIGHT), (body, BODY_WEIGHT)]
    s = sections
    if annotations:
        s = s.withColumn("__notes", F.concat_ws(" ", F.transform(annotations, lambda a: a["text"])))
        fields.append(("__notes", NOTE_WEIGHT))
    hits = [_hits(f, wanted) for f, _ in fields]
    rule = reduce(lambda a, b: a & b, (sum((col[i] for col in hits[1:]), hits[0][i]) > 0 for i in range(len(wanted))))
    for f, _ in fields:
        for h in _hits(f, barred):
            rule &= h == 0
    rank = sum((w * F.log1p(h.cast("double")) for (_, w), col in zip(fields, hits, strict=True) for h in col), F.lit(0.0))
    return s.where(rule).select(key, F.round(rank, 6).alias("rank"), snippet).orderBy(F.desc("rank"), key).offset(offset).limit(k)


def chapter_sections(sections: DataFrame, chapter: str) -> DataFrame:
    """Sections of one chapter in text order, which is not natural order."""
    return sections.where(F.col("chapterNumber") == chapter).select("sectionNumber", "title", "isRepealed", "partHeading").orderBy("sectionNumber")


def facets(sections: DataFrame) -> DataFrame:
    """(facet, value, n) of chapter, document and status."""
    pairs = F.array(*(F.struct(F.lit(n).alias("facet"), c.cast("string").alias("value")) for n, c in (("chapter", F.col("chapterNumber")), ("document", F.col("docType")), ("status", F.when(F.col("isRepealed"), "repealed").otherwise("in force")))))
    return sections.select(F.explode(pairs).alias("p")).groupBy("p.facet", "p.value").agg(F.count(F.lit(1)).alias("n"))


