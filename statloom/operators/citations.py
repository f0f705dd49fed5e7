"""Citations in running text: detect generously, resolve by joins against the inventory, count what is rejected.

Detection starts from a text's numbers. What stands between two numbers says what the second one is: the head of a citation where a
keyword ends there, a further member of a list where nothing but a connector is there, else nothing. Names of other bodies of law are
marks with a place; whether one rules a number out depends on the nearest mark and what is in between. All this needs the text
alone and is an Arrow function from a text to rows. What depends on the inventory is joins.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How keywords, numbers, lists and other bodies of law are written, how far the guards look, and the reasons.
KEYWORDS = r"sections?|chapters?|§§?"
NUMBER = r"[0-9]+[A-Z]?(?::[0-9]+[A-Z]?)?-[0-9]+[A-Z]?(?:\.[0-9]+)*"
BARE = r"[0-9]+[A-Z]?"
LIST_WORDS, RANGE_WORD = ("and", "or"), "to"
OLD_NAMES = r"H\.R\.S\.|R\.L\.H\.|\bRLH\b|Revised Laws of Hawaii"
FOREIGN_NAMES = r"United States Code|U\.S\.C\.|C\.F\.R\.|Code of Federal Regulations|Internal Revenue Code|Social Security Act|Public Law|P\.L\.|Hawaii Administrative Rules|Stat\."
FOREIGN_PLACES = rf"Title\s+[0-9]+|{FOREIGN_NAMES}|[A-Z][A-Za-z'’ ]{{2,45}}?(?:Act|Code)"
BEFORE, AFTER = 60, 70
REASONS = ("bare-number", "foreign-law", "admin-rules", "superseded", "absent-section", "unresolved")

#: For the JVM: holds wherever a keyword is followed by a number. The blanks are those of Python's \\s.
MAY_CITE = r"(?iu)(?:sections?|chapters?|§)B*+(?:\[B*+)?[0-9]".replace("B", r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]")
#: Widths, in bits, of the blocks by which sections within a range are looked up.
BLOCK_BITS = (3, 6, 9, 12, 16, 20)

#: A suffix letter isn't the first of a keyword.
_NUMBERS = re.compile(f"{NUMBER}|{BARE}".replace("[A-Z]?", "(?:(?!section|chapter)[A-Z])?"), re.I)
_KEYWORD_END = re.compile(rf"(?:{KEYWORDS})\Z", re.I)
_KEYWORD_LAST, _LONGEST_KEYWORD = frozenset("nNrRsSſ§"), len("sections")
_CLOSING = re.compile(r"\s*\]")
_MARKS = re.compile(rf"(?P<old>{OLD_NAMES})|(?P<again>\bId\.)|(?P<foreign>{FOREIGN_NAMES})", re.I)
#: What may stand between a mark and the citation after it.
_OLD_GAP, _AGAIN_GAP, _FOREIGN_GAP = re.compile(r"\s*(?:[0-9]{4})?[\s,;§]*"), re.compile(r"\s*(?:at\s+)?§*\s*", re.I), re.compile(r"[\s,]*")
_OF_PLACE = re.compile(rf"(?:(?:or|and)\s+{BARE}[\s,]*)*(?:of\s+)?(?:subtitle\s+\w+[\s,]*)?of\s+(?:the\s+)?(?:{FOREIGN_PLACES})\b", re.I)
_SUBDIVISION = re.compile(r"(?:subchapter|subtitle)\b", re.I)


@dataclass(slots=True)
class _Number:
    """A number with its brackets, and what the gap before it says: where its keyword begins, if any, and how it goes on with a list."""

    text: str
    start: int
    end: int
    keyword_at: int | None
    kind: str
    listed: bool
    range_end: bool


def _gap_link(gap: str) -> str | None:
    """The connector that a gap consists of: a comma, a word with blanks around it, or a comma and a word with a blank after it."""
    comma = gap.lstrip().startswith(",")
    rest = gap.lstrip()[1:] if comma else gap
    word = rest.strip().lower()
    if not word:
        return "," if comma else None
    if word not in LIST_WORDS and (word != RANGE_WORD or comma):
        return None
    return word if rest[-1].isspace() and (comma or rest[0].isspace()) else None


def _numbers(text: str) -> list[_Number]:
    """The numbers of citations: those with a keyword, and what is listed after them."""
    at, live, out = 0, False, []
    for m in _NUMBERS.finditer(text):
        start, end = m.span()
        gap = text[at:start]
        bare = gap.rstrip()
        if bare.endswith("["):
            gap = bare[:-1]
            start = at + len(gap)
            bare = gap.rstrip()
            close = _CLOSING.match(text, end)
            end = close.end() if close else end
        keyword = _KEYWORD_END.search(bare[-_LONGEST_KEYWORD:]) if bare[-1:] in _KEYWORD_LAST else None
        link = _gap_link(bare.rstrip("§") if bare.endswith("§") else gap) if live else None
        live = keyword is not None or link is not None
        if live:
            out.append(_Number(m.group(), start, end, at + len(bare) - len(keyword.group()) if keyword else None, "chapter" if keyword and keyword.group()[0] in "cC" else "section", link is not None, link == RANGE_WORD))
        at = end
    return out


class _Marks:
    """Where other bodies of law are named."""

    def __init__(self, text: str):
        self.text = text
        self.of: dict[str, list[tuple[int, int]]] = {"old": [], "again": [], "foreign": []}
        for m in _MARKS.finditer(text):
            self.of[m.lastgroup].append((m.end(), m.start()))

    def before(self, kind: str, at: int, gap: re.Pattern[str]) -> bool:
        """Whether the last mark of a kind leads up to ``at``."""
        k = bisect_right(self.of[kind], (at, at)) - 1
        if k < 0:
            return False
        end, start = self.of[kind][k]
        return start >= at - BEFORE and gap.fullmatch(self.text, end, at) is not None

    def any_before(self, kind: str, at: int) -> bool:
        return bool(self.of[kind]) and self.of[kind][0][1] < at


@dataclass(slots=True)
class _Found:
    kind: str
    number: str
    start: int
    after: str
    marks: _Marks

    def is_old(self) -> bool:
        return self.marks.before("old", self.start, _OLD_GAP) or (self.marks.any_before("old", self.start) and self.marks.before("again", self.start, _AGAIN_GAP))

    def is_rule(self) -> bool:
        return (self.after[:1] == "-" and "0" <= self.after[1:2] <= "9") or (self.kind == "chapter" and "-" in self.number)

    def is_bare(self) -> bool:
        return self.kind == "section" and "-" not in self.number

    def is_foreign(self) -> bool:
        if self.kind != "chapter":
            return False
        rest = self.after.lstrip(", \t\n\r\f\v\xa0")
        return self.marks.before("foreign", self.start, _FOREIGN_GAP) or bool(_SUBDIVISION.match(rest) or _OF_PLACE.match(rest))


#: Why a candidate can't be a citation, whatever the inventory holds. The first rule that applies counts.
RULES: tuple[tuple[str, Callable[[_Found], bool]], ...] = (("superseded", _Found.is_old), ("admin-rules", _Found.is_rule), ("bare-number", _Found.is_bare), ("foreign-law", _Found.is_foreign))


def candidates(text: str) -> list[tuple[int, int, str, str, bool, str | None]]:
    """(start, end, number, kind, range_endpoint, guard), list by list; spans in code points, half open.

    Every number with a keyword opens a list, of which the numbers after it are members as long as connectors lead from one to the next.
    So a number that stands in a list and has a sign of its own comes out in both lists. A closing bracket belongs to a span only if the
    opening one does.
    """
    numbers = _numbers(text)
    heads = [i for i, n in enumerate(numbers) if n.keyword_at is not None]
    marks, out = _Marks(text) if heads else None, []
    for i in heads:
        kind, k = numbers[i].kind, i
        while k < len(numbers) and (k == i or numbers[k].listed):
            n = numbers[k]
            start = n.keyword_at if k == i else n.start
            found = _Found(kind, n.text, start, text[n.end : n.end + AFTER], marks)
            out.append((start, n.end, n.text, kind, k > i and n.range_end, next((reason for reason, holds in RULES if holds(found)), None)))
            k += 1
    return out


def detect(blocks: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """Rows (keys, seq, start, end, cited, number, kind, range_endpoint, guard, before), one per candidate.

    blocks: one row per block of text, told apart by ``keys``. ``before`` is the number found right before in the same block. Null texts and texts without a keyword or sign and a digit give none.
    """
    clash = set(keys) & {"seq", "start", "end", "cited", "number", "kind", "range_endpoint", "guard", "before"}
    if clash:
        raise ValueError(f"keys may not be named {', '.join(sorted(clash))}")
    fields = {f.name: f.dataType for f in blocks.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at: list[int] = []
            rows: list[tuple] = []
            for r, t in enumerate(b.column(len(keys)).to_pylist()):
                last = None
                for seq, c in enumerate(candidates(t)):
                    at.append(r)
                    rows.append((seq, c[0], c[1], t[c[0] : c[1]], *c[2:], last))
                    last = c[2]
            types = (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.string(), pa.string())
            cols = list(zip(*rows, strict=True)) or [()] * len(types)
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(i).take(take) for i in range(len(keys))), *(pa.array(c, k) for c, k in zip(cols, types, strict=True))], [*keys, "seq", "start", "end", "cited", "number", "kind", "range_endpoint", "guard", "before"])

    schema = ", ".join(f"`{k}` {fields[k].simpleString()}" for k in keys) + ", seq int, start int, end int, cited string, number string, kind string, range_endpoint boolean, guard string, before string"
    return blocks.select(*keys, text).where(F.col(text).rlike(MAY_CITE)).mapInArrow(run, schema)


def resolve(found: DataFrame, sections: DataFrame, chapters: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Adds target, target_title, target_href and reason (null = linked) to candidates.

    sections and chapters: (key, number, title, href), keys unique. aliases: (observed, corrected) numbers, tried where the number itself is unknown.
    Rejected candidates don't take part in the lookup. A section whose chapter exists is absent, anything else unresolved.
    """
    keyed = lambda df, kind: df.select(F.lit(kind).alias("__kind"), F.col("key").alias("__key"), F.col("number").alias("target"), F.col("title").alias("target_title"), F.col("href").alias("target_href"))
    all_ = keyed(sections, "section").unionByName(keyed(chapters, "chapter"))
    guarded, open_ = found.where("guard is not null"), found.where("guard is null")
    look = F.col("number")
    if aliases is not None:
        a = aliases.select(F.regexp_replace("observed", "^§", "").alias("__observed"), F.regexp_replace("corrected", "^§", "").alias("__corrected"))
        known = sections.select(F.col("key").alias("__own"), F.lit(True).alias("__direct"))
        open_ = open_.join(a, (open_["number"] == a["__observed"]) & (open_["kind"] == "section"), "left").join(known, F.col("number") == F.col("__own"), "left")
        look = F.when(F.col("__direct").isNull() & F.col("__corrected").isNotNull(), F.col("__corrected")).otherwise(F.col("number"))
    hit = open_.withColumn("__look", look).join(all_, (F.col("__look") == F.col("__key")) & (F.col("kind") == F.col("__kind")), "left")
    there = chapters.select(F.col("key").alias("__chapter"), F.lit(True).alias("__has"))
    hit = hit.withColumn("__head", F.when(F.col("target").isNull() & (F.col("kind") == "section"), F.regexp_extract("number", "^([^-:]*)", 1)))
    hit = hit.join(there, F.col("__head") == F.col("__chapter"), "left")
    reason = F.when(F.col("target").isNotNull(), F.lit(None).cast("string")).when(F.col("__has"), "absent-section").otherwise("unresolved")
    cols = [*found.columns, "target", "target_title", "target_href"]
    hit = hit.withColumn("reason", reason).select(*cols, "reason")
    none = F.lit(None).cast("string")
    return hit.unionByName(guarded.select(*found.columns, none.alias("target"), none.alias("target_title"), none.alias("target_href"), F.col("guard").alias("reason")))


def tally(resolved: DataFrame, *by: str) -> DataFrame:
    """Counts by reason; "linked" for what was; each reason has a row even at 0 if nothing else groups the rows."""
    n = resolved.groupBy(*by, F.coalesce("reason", F.lit("linked")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    if by:
        return n
    names = resolved.sparkSession.createDataFrame([(r,) for r in ("linked", *REASONS)], "reason string")
    return names.join(n, "reason", "left").select("reason", F.coalesce("n", F.lit(0)).alias("n"))


def rates(tallied: DataFrame, *by: str) -> DataFrame:
    """Total, linked and unresolved share in per cent, two places, 0 where there is nothing."""
    share = lambda r: F.coalesce(F.round(100 * F.sum(F.when(F.col("reason") == r, F.col("n")).otherwise(0)) / F.nullif(F.sum("n"), F.lit(0)), 2), F.lit(0.0))
    return tallied.groupBy(*by).agg(F.sum("n").alias("total"), share("linked").alias("linked_pct"), share("unresolved").alias("unresolved_pct"))


def range_members(found: DataFrame, sections: DataFrame, unit: Sequence[str]) -> DataFrame:
    """Sections strictly between the ends of a range that exist: (unit, seq, number).

    A range is a candidate marked as its end and the one right before it in the same unit; both plain numbers of one chapter.
    """
    simple = r"^([0-9]+[A-Z]?)-([0-9]+)\z"
    part = lambda c, g: F.regexp_extract(c, simple, g)
    ends = found.where("range_endpoint and kind = 'section' and before is not null").select(*unit, "seq", "number", F.col("before").alias("__from"))
    lo, hi = part("__from", 2).try_cast("long"), part("number", 2).try_cast("long")
    ends = ends.withColumns({"__c": part("number", 1), "__lo": lo, "__hi": hi}).where((F.col("__c") != "") & (F.col("__c") == part("__from", 1)) & (F.col("__hi") - F.col("__lo") > 1))
    known = sections.select(F.col("key"), F.col("number").alias("target")).withColumns({"__k": part("key", 1), "__n": part("key", 2).try_cast("long")}).where("__k <> '' and __n is not null")
    # an interval join by blocks of the number line: a range takes the smallest blocks at least as wide as itself, one or two of them
    width = F.col("__hi") - F.col("__lo")
    bits = F.coalesce(*(F.when(width <= (1 << w), w) for w in BLOCK_BITS), F.lit(63))
    block = lambda n, w: F.when(w >= 63, F.lit(0)).otherwise(F.floor(n / F.pow(F.lit(2.0), w))).cast("long")
    ends = ends.withColumn("__w", bits).withColumn("__b", F.explode(F.array_distinct(F.array(block(F.col("__lo"), F.col("__w")), block(F.col("__hi"), F.col("__w"))))))
    known = known.withColumn("__v", F.explode(F.array(*(F.lit(w) for w in (*BLOCK_BITS, 63))))).withColumn("__d", block(F.col("__n"), F.col("__v")))
    hit = ends.join(known, (F.col("__c") == F.col("__k")) & (F.col("__w") == F.col("__v")) & (F.col("__b") == F.col("__d")) & (F.col("__n") > F.col("__lo")) & (F.col("__n") < F.col("__hi")))
    return hit.where(F.concat_ws("-", "__c", F.col("__n").cast("string")) == F.col("key")).select(*unit, "seq", F.col("target").alias("number"))


def unresolved_report(resolved: DataFrame, text: Column, order: Sequence[str], k: int = 20) -> DataFrame:
    """The k unresolved numbers found most: (number, n, sample), the sample from where each stands first; ties in that order too."""
    from statloom.functions.text import sample

    seen = resolved.where("reason = 'unresolved'").withColumn("__sample", sample(text, F.col("start"), F.col("end")))
    by = seen.groupBy("number").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*order)).alias("__first"), F.min_by("__sample", F.struct(*order)).alias("sample"))
    return by.orderBy(F.desc("n"), "__first").limit(k).select("number", "n", "sample")
