"""Identity of records as Column expressions: file names, numbers, keys, slugs, citations in display form.

All of it stays in the JVM. Patterns spell white space out and end with \\z, so that they mean the same
whatever engine reads them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: File-name prefixes and the document types that they stand for (fixed values).
DOC_TYPES = {"HRS": "hrs", "CONST": "const", "USCON": "uscon", "HHCA": "hhca", "ADM": "adm", "ORG": "org", "HNP": "hnp"}
#: Largest article or amendment number that is read from a numeral or a word.
MOST = 27
SOFT_HYPHEN = "­"


def roman(n: int) -> str:
    out = ""
    for value, sign in ((10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        out += sign * (n // value)
        n %= value
    return out


_UNITS = "first second third fourth fifth sixth seventh eighth ninth".split()
_TEENS = "tenth eleventh twelfth thirteenth fourteenth fifteenth sixteenth seventeenth eighteenth nineteenth".split()
#: Ordinal words by number.
ORDINALS = dict(enumerate([*_UNITS, *_TEENS, "twentieth", *(f"twenty-{u}" for u in _UNITS)], 1))
NUMERALS = {roman(n): n for n in range(1, MOST + 1)}
WORDS = NUMERALS | {w: n for n, w in ORDINALS.items() if n <= MOST}


def clean(c: Column) -> Column:
    """No-break spaces to blanks, U+2010 to U+2012 to "-", white space runs to one blank, ends trimmed; en dashes stay."""
    t = F.translate(c, " ‐‑‒", " ---")
    return F.trim(F.regexp_replace(t, r"[\s\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]+", " "))


def normalize_component(c: Column) -> Column:
    """Leading zeros of a number go (one stays), letters in upper case."""
    return F.upper(F.regexp_replace(c, r"^0+(?=[0-9])", ""))


def _stem(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.replace(name, F.lit(SOFT_HYPHEN), F.lit("")), r"(?i)\.html?\z", ""), r"(?i)\.docx\z", "")


def file_suffix(name: Column) -> Column:
    """" [X]" of a name that ends with _[X], else empty."""
    mark = F.regexp_extract(_stem(name), r"_\[([^\]]+)\]\z", 1)
    return F.when(mark != "", F.concat(F.lit(" ["), mark, F.lit("]"))).otherwise("")


def _unmarked(name: Column) -> Column:
    return F.regexp_replace(_stem(name), r"_\[[^\]]+\]\z", "")


def file_prefix(name: Column) -> Column:
    p = F.regexp_extract(_unmarked(name), r"^([A-Za-z]+)_", 1)
    return F.when(p == "", "HRS").otherwise(F.upper(p))


def file_rest(name: Column) -> Column:
    return F.regexp_replace(_unmarked(name), r"^[A-Za-z]+_", "")


def doc_type(name: Column) -> Column:
    return F.coalesce(F.create_map(*(F.lit(x) for kv in DOC_TYPES.items() for x in kv))[file_prefix(name)], F.lit("hrs"))


def is_index_file(name: Column) -> Column:
    """Index pages of chapters: nothing after the prefix, or a separator at the end."""
    return file_rest(name).rlike(r"\A\z|[-_]\z")


def number_of_file(name: Column) -> Column:
    """Section number of a file name.

    A second hyphen opens an article, underscores hold the digits of one decimal. Names of other documents keep their parts in order.
    """
    rest = file_rest(name)
    parts = F.regexp_extract_all(rest, F.lit(r"(?:^|-)([^-_]*)"), F.lit(1))
    head = normalize_component(F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit("")))
    tail = F.transform(F.filter(F.slice(parts, 2, 1 << 20), lambda x: x != ""), normalize_component)
    first, second = F.try_element_at(tail, F.lit(1)), F.try_element_at(tail, F.lit(2))
    decimals = F.concat_ws("", F.transform(F.regexp_extract_all(rest, F.lit(r"_([^-_]*)"), F.lit(1)), normalize_component))
    point = F.when(decimals != "", F.concat(F.lit("."), decimals)).otherwise("")
    own = F.when(F.size(tail) == 0, head).when(F.size(tail) == 1, F.concat_ws("-", head, first)).otherwise(F.concat(head, F.lit(":"), first, F.lit("-"), second))
    other = F.concat_ws("-", F.transform(F.filter(parts, lambda x: x != ""), normalize_component))
    prefix = file_prefix(name)
    return F.concat(F.when(prefix == "HRS", F.concat(F.lit("§"), own)).otherwise(F.concat(prefix, F.lit(" §"), other)), point, file_suffix(name))


def chapter_of_file(name: Column) -> Column:
    prefix = file_prefix(name)
    return F.when(prefix != "HRS", prefix).otherwise(normalize_component(F.regexp_extract(file_rest(name), r"^([^-_]*)", 1)))


def chapter_of_directory(name: Column) -> Column:
    """HRS0431K is 431K; names of another form stay as they are."""
    number = F.regexp_extract(name, r"(?i)^HRS([0-9]+[A-Za-z]*)\z", 1)
    return F.when(number != "", normalize_component(number)).otherwise(name)


def slug(number: Column) -> Column:
    t = F.regexp_replace(F.regexp_replace(number, "^§", ""), "^([A-Z]+) §", "$1-")
    return F.regexp_replace(F.regexp_replace(F.replace(t, F.lit(":"), F.lit("-")), r" \[OLD\]\z", "-old"), r"\s+", "")


def href(kind: str, value: Column) -> Column:
    """Address of a section, chapter, volume or title, or of the whole tree."""
    paths = {"section": "/hrs/", "chapter": "/hrs/chapter/", "volume": "/hrs/volume/", "title": "/hrs/title/"}
    if kind == "tree":
        return F.lit("/hrs/tree")
    return F.concat(F.lit(paths[kind]), slug(value) if kind == "section" else value.cast("string"))


def citation_key(number: Column) -> Column:
    """The bare number that running text uses."""
    return F.regexp_replace(F.regexp_replace(number, "^§", ""), r" \[OLD\]\z", "")


def natural_key(c: Column, width: int = 8) -> Column:
    """Sort key: digit runs padded to ``width``, letter runs as they are, all else dropped."""
    runs = F.regexp_extract_all(c, F.lit("([0-9]+|[A-Za-z]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.when(r.rlike("^[0-9]"), F.when(F.length(r) >= width, r).otherwise(F.lpad(r, width, "0"))).otherwise(r)), "")


# --- ranges in headings ------------------------------------------------------------------------

_NUM = r"[0-9](?:[0-9A-Za-z:.\-]*[0-9A-Za-z])?"
_SPAN = rf"(?i)^to\s+{_NUM}(?:(?:\s*,\s*(?:and\s+|or\s+)?|\s+and\s+|\s+or\s+)(?:§+\s*)?{_NUM}(?:\s+to\s+{_NUM})?)*"


def range_end(start: Column, end: Column) -> Column:
    """An abbreviated end takes the start's sign and chapter; one with - or : only the sign."""
    lead = F.regexp_extract(start, r"^(.*?§+\s*)", 1)
    core = F.regexp_replace(F.regexp_replace(start, r"^.*?§+\s*", ""), r"\s*\[[^\]]*\]\s*\z", "")
    chapter = F.regexp_extract(core, "^(.*-)", 1)
    return F.when(end.rlike("[-:]"), F.concat(lead, end)).otherwise(F.concat(lead, chapter, end))


def range_of_title(rest: Column, start: Column) -> Column:
    """struct<start, end, raw, title> of a heading that covers several sections, else null.

    The range stands at the very start; its last number is the end, a full stop right after belongs to it.
    """
    whole = F.regexp_extract(rest, _SPAN, 0)
    raw = F.regexp_extract(rest, _SPAN + r"(?:\s*\.)?", 0)
    last = F.regexp_extract(whole, rf"(?:^|[\s,§])({_NUM})\z", 1)
    return F.when(whole != "", F.struct(start.alias("start"), range_end(start, last).alias("end"), F.trim(raw).alias("raw"), F.trim(F.substr(rest, F.length(raw) + 1)).alias("title")))


# --- other documents ---------------------------------------------------------------------------


def number_of(token: Column) -> Column:
    """A number in digits, roman numerals or as an ordinal word, up to 27 for the latter two; else null."""
    t = F.regexp_replace(F.lower(token), r"\s+", "-")
    return F.when(t.rlike(r"^[0-9]+\z"), t.try_cast("int")).otherwise(F.create_map(*(F.lit(x) for kv in WORDS.items() for x in kv))[t])


def _upper_roman(n: Column) -> Column:
    return F.coalesce(F.create_map(*(F.lit(x) for r, k in NUMERALS.items() for x in (k, r.upper())))[n.try_cast("int")], n.try_cast("int").cast("string"))


#: Names before a number in display form (fixed values).
ACT_NAMES = {"org": "Organic Act", "adm": "Admission Act", "hhca": "HHCA", "hnp": "Hawaii National Park Act"}
CONSTITUTIONS = {"const": "Haw. Const.", "uscon": "U.S. Const."}


def proper_citation(doc: Column, number: Column) -> Column:
    """How a section of another document is cited; a number of the code itself stays as it is."""
    bare = F.regexp_replace(number, "^[A-Z]+ §", "")
    amendment, part = F.regexp_extract(bare, r"^AM-([0-9]+)(?:-(.+))?\z", 1), F.regexp_extract(bare, r"^AM-([0-9]+)-(.+)\z", 2)
    article, section = F.regexp_extract(bare, r"^([0-9]+)-(.+)\z", 1), F.regexp_extract(bare, r"^([0-9]+)-(.+)\z", 2)
    name = F.when(doc == "const", CONSTITUTIONS["const"]).otherwise(CONSTITUTIONS["uscon"])
    whole = (
        F.when(amendment != "", F.concat(name, F.lit(" amend. "), _upper_roman(amendment), F.when(part != "", F.concat(F.lit(", §"), part)).otherwise("")))
        .when(article != "", F.concat(name, F.lit(" art. "), _upper_roman(article), F.lit(", §"), section))
        .otherwise(F.concat(name, F.lit(" art. "), _upper_roman(bare)))
    )
    out = F.when(doc.isin(*CONSTITUTIONS), whole)
    for k, v in ACT_NAMES.items():
        out = out.when(doc == k, F.concat(F.lit(f"{v} §"), bare))
    return out.otherwise(number)
