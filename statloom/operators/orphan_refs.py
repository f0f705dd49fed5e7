"""References to records that do not exist: composite keys with partial nulls, valid in time.

References are grouped by their null mask; each mask is anti-joined with the parents on the
columns that are not null, under the declared match semantics. What is left is classified as
missing (no such key), deleted (there was one before) or late (there is one only afterwards).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.norm import HYPHENS, SOFT, SPACE, section_key
from statloom.runtime import materialize

MATCH = ("partial", "simple", "full")


def orphan_references(
    refs: DataFrame,
    parents: Mapping[tuple[str, ...], DataFrame] | DataFrame,
    keys: Sequence[str],
    at: str,
    match: str = "partial",
    added: str = "added_at",
    dropped: str = "dropped_at",
) -> DataFrame:
    """The rows of ``refs`` that hold for no parent at time ``at``, with their ``reason``.

    parents: rows with the key columns, ``added`` and ``dropped`` (null = still there); one
    frame for every mask, or a mapping from the non-null columns of a mask to its own frame.

    match, as in SQL's referential constraints:
    partial: the non-null columns have to match; a reference with no key at all holds.
    simple: any null column makes the reference hold.
    full: a reference with some but not all columns null never holds (reason "partial_null").

    A parent holds at t if added <= t and (dropped is null or dropped > t). A null ``at`` or a
    null ``added`` never holds: such a reference is "late" if its key is known. Repeated parents
    count once, repeated references stay. An empty frame on either side is no error. Other columns may
    have any names; a column ``reason`` of the references is replaced.
    """
    if match not in MATCH:
        raise ValueError(f"match is one of {MATCH}")
    # the references' own columns travel in one struct, so that none of their names can clash
    own_columns = [c for c in refs.columns if c != "reason"]
    r = refs.select(*(refs[k].alias(f"__k{i}") for i, k in enumerate(keys)), refs[at].alias("__at"), F.struct(*(refs[c] for c in own_columns)).alias("__row"))
    out: list[DataFrame] = []
    for mask in product((True, False), repeat=len(keys)):
        have = [i for i, m in enumerate(mask) if m]
        named = tuple(keys[i] for i in have)
        if not have or (len(have) < len(keys) and match == "simple"):
            continue
        some = r.where(reduce(lambda a, b: a & b, (F.col(f"__k{i}").isNotNull() if m else F.col(f"__k{i}").isNull() for i, m in enumerate(mask))))
        if len(have) < len(keys) and match == "full":
            out.append(some.select("__row", F.lit("partial_null").alias("reason")))
            continue
        if isinstance(parents, DataFrame):
            of = parents
        elif named in parents:
            of = parents[named]
        else:
            continue
        p = of.select(*(of[keys[i]].alias(f"__p{i}") for i in have), of[added].alias("__added"), of[dropped].alias("__dropped")).dropna(subset=[f"__p{i}" for i in have]).distinct()
        same = [F.col(f"__k{i}") == F.col(f"__p{i}") for i in have]
        holds = (F.col("__added") <= F.col("__at")) & (F.col("__dropped").isNull() | (F.col("__dropped") > F.col("__at")))
        gone = some.join(p, reduce(lambda a, b: a & b, [*same, holds]), "left_anti")
        first = p.groupBy(*(f"__p{i}" for i in have)).agg(F.min("__added").alias("__first"), F.lit(True).alias("__known"))
        gone = gone.join(first, reduce(lambda a, b: a & b, same), "left")
        reason = F.when(F.col("__known").isNull(), "missing").when(F.col("__first") <= F.col("__at"), "deleted").otherwise("late")
        out.append(gone.select("__row", reason.alias("reason")))
    if not out:
        return refs.limit(0).select(*own_columns, F.lit("").alias("reason"))
    return reduce(DataFrame.unionByName, out).select("__row.*", "reason")


def count_orphans(orphans: DataFrame, table: str, period: str) -> DataFrame:
    """Orphans per referenced table, period and reason."""
    return orphans.groupBy(table, period, "reason").agg(F.count(F.lit(1)).alias("n"))


# --- references in the text of a law ---------------------------------------------------------

_S = SPACE
_HY = f"{SOFT}*[-{HYPHENS}]{SOFT}*"
_PART = rf"\d+{SOFT}*[A-Za-z]{{0,2}}"
_SECTION = rf"{_PART}(?::{_PART})?{_HY}\d+[A-Za-z]{{0,2}}(?:\.\d+[A-Za-z]?)?(?![A-Za-z0-9])"
_CHAPTER = rf"\d+[A-Za-z]{{0,2}}(?![A-Za-z0-9:]|{_HY}\d|\.\d)"
_SUBS = rf"(?:{_S}*\([A-Za-z0-9]{{1,5}}\))*"
_SEP = rf"{_S}*(?:,{_S}*(?:and|or|to|through|&)?|;{_S}*(?:and|or)?|and|or|to|through|&){_S}*"
_MARK = rf"(?:§+{_S}*)?"

#: Names of other bodies of law before or after a number (fixed values).
FOREIGN_BEFORE = (
    r"United\s+States\s+Code(?:\s+Annotated)?,?",
    r"U\.?\s*S\.?\s*C\.?(?:\s*A\.?)?,?",
    r"Code\s+of\s+Federal\s+Regulations,?",
    r"C\.?\s*F\.?\s*R\.?,?",
    r"(?:Public|Federal)\s+Law,?",
    r"Internal\s+Revenue\s+Code(?:\s+of\s+\d{4})?,?",
    r"Uniform\s+(?:[A-Z][a-z]+\s+){0,4}(?:Code|Act),?",
    r"administrative\s+rules?,?",
    r"(?:Revised\s+)?Ordinances?,?",
    r"Revised\s+Laws(?:\s+of)?(?:\s+[A-Z][a-z]+)?(?:\s+\d{4})?,?",
    r"RL(?:\s+\d{4})?,?",
)
FOREIGN_AFTER = (
    r"(?:title\s+\d+,?\s+)?United\s+States\s+Code",
    r"(?:title\s+\d+,?\s+)?(?:of\s+)?U\.?\s*S\.?\s*C",
    r"Code\s+of\s+Federal\s+Regulations",
    r"Internal\s+Revenue\s+Code",
    r"federal\s+\w+",
    r"Uniform\s+(?:[A-Z][a-z]+\s+){0,4}(?:Code|Act)",
    r"administrative\s+rules?",
    r"(?:Revised\s+)?Ordinances?",
    r"Revised\s+Laws",
    r"RL\s+\d{4}",
)


def _spaced(patterns: Sequence[str]) -> str:
    return "|".join(patterns).replace(r"\s", _S)


def _found(text: Column, word: str, number: str) -> Column:
    """Numbers named after ``word``, lists taken whole, other bodies of law left out."""
    sign = rf"|§+{_S}*" if word == "section" else ""  # a sign alone names sections
    item = rf"(?:\[{_S}*)?{number}{_SUBS}(?:{_S}*\])?{_SUBS}"
    whole = rf"(?i)(?:(?<!\w)(?:{_spaced(FOREIGN_BEFORE)}){_S}*)?(?:\b{word}s?\b{_S}*{_MARK}{sign}){item}(?:{_SEP}{_MARK}{item})*(?:,?{_S}+(?:of|in){_S}+(?:the{_S}+)?(?:{_spaced(FOREIGN_AFTER)}))?"
    out_of = rf"(?is)^(?!{word}|§).*|.*(?:of|in){_S}+(?:the{_S}+)?(?:{_spaced(FOREIGN_AFTER)})$"
    own = F.filter(F.regexp_extract_all(text, F.lit(whole), F.lit(0)), lambda m: ~m.rlike(out_of))
    return F.flatten(F.transform(own, lambda m: F.regexp_extract_all(F.regexp_replace(m, r"\([A-Za-z0-9]{1,5}\)", " "), F.lit(rf"(?<![\w.:-]){number}"), F.lit(0))))


def text_references(text: Column) -> Column:
    """array<struct<kind, key>> of the sections and chapters that a text names, each once.

    A section number holds a hyphen. The word (in any case) or sign may be followed by a list;
    subsections in round brackets are no part of a number. Null text gives an empty array.
    """
    sections = F.transform(_found(text, "section", _SECTION), lambda n: F.struct(F.lit("section").alias("kind"), section_key(n).alias("key")))
    chapters = F.transform(_found(text, "chapter", _CHAPTER), lambda n: F.struct(F.lit("chapter").alias("kind"), section_key(n).alias("key")))
    none = F.array().cast("array<struct<kind:string,key:string>>")
    return F.coalesce(F.array_distinct(F.concat(F.when(text.rlike(r"(?i)section|§"), sections).otherwise(none), F.when(text.rlike("(?i)chapter"), chapters).otherwise(none))), none)


def law_references(parsed: DataFrame) -> DataFrame:
    """(record_id, ref_field, ref_kind, ref_key, chapter, rest, crawled_at) of every reference.

    The composite key is (chapter, rest): a reference to a chapter has a null rest. ``rest``
    starts with the sign that parts it from the chapter.
    """
    own = lambda f, kind: F.struct(F.lit(f).alias("field"), F.lit(kind).alias("kind"), section_key(F.col(f)).alias("key"))
    body = F.transform(text_references(F.col("bodyText")), lambda r: F.struct(F.lit("bodyText").alias("field"), r["kind"].alias("kind"), r["key"].alias("key")))
    r = parsed.select("record_id", "crawled_at", F.explode(F.concat(F.array(own("sectionNumber", "section"), own("chapterNumber", "chapter")), body)).alias("r"))
    r = r.where("r.key is not null").select("record_id", "crawled_at", F.col("r.field").alias("ref_field"), F.col("r.kind").alias("ref_kind"), F.col("r.key").alias("ref_key"))
    return with_parts(r, "ref_key", "ref_kind")


def with_parts(df: DataFrame, key: str, kind: str) -> DataFrame:
    """Adds (chapter, rest) of a key; the whole key is the chapter where the kind says so."""
    section = F.col(kind) == "section"
    head = F.regexp_extract(key, r"^([^-:]*)", 1)
    return df.withColumns({"chapter": F.when(section, head).otherwise(F.col(key)), "rest": F.when(section, F.expr(f"substring(`{key}`, length(regexp_extract(`{key}`, '^([^-:]*)', 1)) + 1)"))})


def law_orphans(parsed: DataFrame, targets: DataFrame, chapters: DataFrame) -> DataFrame:
    """(record_id, ref_field, ref_kind, ref_key, reason, ref_month) of references that do not hold."""
    of = lambda df, key, kind: with_parts(df.select(section_key(F.col(key)).alias("k"), F.lit(kind).alias("kind"), "added_at", "dropped_at").dropna(subset=["k"]), "k", "kind")
    parents = {("chapter", "rest"): of(targets, "target_key", "section"), ("chapter",): of(chapters, "chapter_key", "chapter")}
    refs = materialize(law_references(parsed), "references")  # each mask reads them; the texts are searched once
    o = orphan_references(refs, parents, ["chapter", "rest"], "crawled_at")
    return o.select("record_id", "ref_field", "ref_kind", "ref_key", "reason", F.date_format("crawled_at", "yyyy-MM").alias("ref_month"))
