"""Pages to records: sections, chapter indexes, title banners and listings.

Pages are read one at a time in Arrow functions; what they give is typed columns. The grammar of headings and banners is
written as patterns, everything between them as state over the paragraphs of one page.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions import identity as I
from statloom.functions import text as X
from statloom.functions.htmltree import Element, page_root

# How headings and banners are written.
SECTION_HEAD = re.compile(r"\[?\s*§+\s*([0-9][0-9A-Za-z:.\-]*[0-9A-Za-z])\s*\]?\s+(.*)\Z", re.S)
ACT_HEAD = re.compile(r"§+\s*([0-9](?:[0-9A-Za-z.\-]*[0-9A-Za-z])?)\s*\.\s*(.*)\Z", re.S)
ARTICLE_HEAD = re.compile(r"Section\s+([0-9]+[A-Za-z]?)\s*\.\s*(.*)\Z", re.I | re.S)
CHAPTER_BANNER = re.compile(r"\[?\s*chapter\s+([0-9][0-9A-Za-z]*)\s*(.*?)\s*\]?\Z", re.I)
TITLE_BANNER = re.compile(r"(\[?)\s*TITLE\s+([0-9]+[A-Z]?)\.\s*(.*?)\s*\]?\Z")
DIVISION_BANNER = re.compile(r"\[?\s*DIVISION\s+([0-9]+)\.\s*(.*?)\s*\]?\Z")
SUBTITLE = re.compile(r"Subtitle\s+([0-9]+)\.\s*(.*)\Z")
CHAPTER_ROW = re.compile(r"([0-9]+[A-Z]*)\s+(\S.*)\Z")
OLD, OLD_OR_NEW = re.compile(r"\[?old\]?\Z", re.I), re.compile(r"\[?(?:old|new)\]?\Z", re.I)
MARKER = re.compile(r"\([0-9a-z]+\)\Z", re.I)
LAST_MARKER = re.compile(r"\s*\((?:[0-9]{1,3}|[a-z]{1,3})\)\s*\Z", re.I)
STRUCTURE, CATCHLINE = re.compile(X.BANNER, re.I), re.compile(X.CATCHLINE)
#: Word processors' signs: blanks and hyphens in one form, no soft hyphens (they would end a number).
_TYPO = {0xA0: " ", 0xAD: None, 0x2010: "-", 0x2011: "-", 0x2012: "-"}


def tidy(text: str) -> str:
    return " ".join(text.translate(_TYPO).split())


def heading_of(p: Element) -> str:
    """The bold text that opens a paragraph, with the short pieces between bold ones, without a subsection marker at its end."""
    runs, last = p.runs(), -1
    for i, (text, bold) in enumerate(runs):
        if bold:
            last = i
        else:
            t = tidy(text)
            if MARKER.match(t) or len(t) > 3:
                break
    return LAST_MARKER.sub("", tidy("".join(t for t, _ in runs[: last + 1])))


def is_catchline(text: str | None) -> bool:
    return CATCHLINE.fullmatch((text or "").strip()) is not None


@dataclass
class Part:
    """A stretch of the page: of the body (heading None), or an annotation."""

    heading: str | None = None
    lines: list[str] = field(default_factory=list)
    nodes: list[Element] = field(default_factory=list)


def _head(text: str, own: bool) -> tuple[str, str, str] | None:
    """(form, number, rest) of a heading; the forms of acts and constitutions only outside the code itself."""
    for form, pattern in (("section", SECTION_HEAD), *(() if own else (("act", ACT_HEAD), ("article", ARTICLE_HEAD)))):
        m = pattern.match(text)
        if m:
            return form, m[1], m[2].strip()
    return None


def parts_of(root: Element, own: bool) -> list[Part]:
    """Body and annotations in page order.

    A heading of notes opens an annotation; a section's heading opens the body again, and outside the code takes a catchline that
    stands right above with it. Two centred catchlines with no blank paragraph between are one.
    """
    parts, gap = [Part()], True
    for p in root.find("p"):
        classes, text = p.classes(), tidy(p.text())
        if "XNotesHeading" in classes:
            if text:
                parts.append(Part(text))
            gap = True
            continue
        if not text:
            gap = True
            continue
        part = parts[-1]
        if part.heading is not None and "XNotes" not in classes and _head(heading_of(p), own):
            moved = Part()
            if not own and part.lines and is_catchline(part.lines[-1]):
                moved = Part(None, [part.lines.pop()], [part.nodes.pop()])
            parts.append(part := moved)
        centred = lambda e: e.attrs.get("align", "").lower() == "center"
        if not own and not gap and part.nodes and centred(p) and centred(part.nodes[-1]) and is_catchline(text) and is_catchline(part.lines[-1]):
            part.lines[-1] += " " + text
            continue
        part.lines.append(text)
        part.nodes.append(p)
        gap = False
    return parts


def read_section(html: str | None, number: str, prefix: str, suffix: str) -> dict:
    """Fields of a section page that come from its text; number is the file name's.

    The heading that agrees with the file name counts, else the first. A heading over several sections only confirms the file
    name's number (``range`` holds its text). A constitution's heading has its title in the line above.
    """
    own = prefix == "HRS"
    root = page_root(html)
    parts = parts_of(root, own)
    lines = [t for p in parts if p.heading is None for t in p.lines]
    nodes = [n for p in parts if p.heading is None for n in p.nodes]
    heads = []
    for i, n in enumerate(nodes):
        h = heading_of(n)
        got = _head(h, own) if h else None
        if got:
            form, raw, rest = got
            heads.append((i, h, number if form == "article" else (f"§{raw}{suffix}" if own else f"{prefix} §{raw}{suffix}"), rest, form))
    out = {"number": number, "source": "filename", "title": "", "heading": "", "part": None, "rest": None, "page_number": None}
    at = -1
    if heads:
        at, heading, page, rest, form = next((h for h in heads if h[2] == number), heads[0])
        title = rest
        if form == "article" and not title and at and is_catchline(lines[at - 1]):
            title, lines[at - 1] = lines[at - 1].strip(), ""
        out |= {"title": title, "heading": heading, "rest": rest, "page_number": page, "source": "filename" if form == "article" else "page"}
        if lines[at].startswith(heading):
            lines[at] = lines[at][len(heading) :].strip()
    for i in range(min(1 if at < 0 else at, len(lines))):
        if STRUCTURE.match(lines[i]):
            out["part"], lines[i] = lines[i], ""
            if not own and i + 1 < len(lines) and is_catchline(lines[i + 1]):
                out["part"] += " — " + lines[i + 1].strip()
                lines[i + 1] = ""
            break
    out["body"] = "\n\n".join(t for t in lines if t)
    out["annotations"] = [{"heading": p.heading, "text": "\n".join(p.lines)} for p in parts if p.heading is not None]
    return out


_READ = pa.schema([("title", pa.string()), ("heading", pa.string()), ("part", pa.string()), ("rest", pa.string()), ("page_number", pa.string()), ("source", pa.string()), ("body", pa.string()), ("annotations", pa.list_(pa.struct([("heading", pa.string()), ("text", pa.string())])))])


def _mapped(df: DataFrame, keys: list[str], args: list[str], read: Callable[..., list[dict]], schema: pa.Schema, ddl: str) -> DataFrame:
    """Rows of ``read(*args)`` beside the keys."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, rows = [], []
            for r, a in enumerate(zip(*(b.column(len(keys) + i).to_pylist() for i in range(len(args))), strict=True)):
                got = read(*a)
                at += [r] * len(got)
                rows += got
            take = pa.array(at, pa.int64())
            cols = [pa.array([x.get(f.name) for x in rows], f.type) for f in schema]
            yield pa.RecordBatch.from_arrays([*(b.column(i).take(take) for i in range(len(keys))), *cols], [*keys, *schema.names])

    return df.select(*keys, *args).mapInArrow(run, ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", " + ddl)


def parse_sections(pages: DataFrame, html: str = "html", name: str = "filename", key: str = "filename") -> DataFrame:
    """Section records of pages: the fields of the record schema that a page gives, beside ``key``.

    A null page gives a record with the file name's number and empty texts.
    """
    p = pages.select(*dict.fromkeys([key, name]), html)
    p = p.withColumns({"__number": I.number_of_file(F.col(name)), "__prefix": I.file_prefix(F.col(name)), "__suffix": I.file_suffix(F.col(name))})
    ddl = "title string, heading string, part string, rest string, page_number string, source string, body string, annotations array<struct<heading:string,text:string>>"
    keys = [*dict.fromkeys([key, name]), "__number"]
    r = _mapped(p, keys, [html, "__number", "__prefix", "__suffix"], lambda *a: [read_section(*a)], _READ, ddl)
    covers = I.range_of_title(F.col("rest"), F.col("page_number"))
    r = r.withColumn("__covers", covers)
    ranged = F.col("__covers").isNotNull()
    title = F.when(ranged, F.col("__covers.title")).otherwise(F.col("title"))
    r = r.withColumn("__t", X.unwrap_title(F.col("heading"), title))
    body, notes = F.col("body"), F.col("annotations")
    number = F.when(ranged | (F.col("source") == "filename"), F.col("__number")).otherwise(F.col("page_number"))
    text = X.without_history(body)
    return r.select(
        *dict.fromkeys([key, name]),
        number.alias("sectionNumber"),
        F.col("__t.title").alias("title"),
        I.chapter_of_file(F.col(name)).alias("chapterNumber"),
        I.doc_type(F.col(name)).alias("docType"),
        F.col("part").alias("partHeading"),
        text.alias("bodyText"),
        X.history_of(body).alias("history"),
        X.cross_reference_lines(notes).alias("crossReferences"),
        X.case_notes(notes).alias("caseNotes"),
        notes.alias("annotations"),
        F.col("__t.heading_supplied").alias("headingIsSupplied"),
        X.is_repealed(F.col("__t.title"), text).alias("isRepealed"),
        F.when(ranged, F.struct(F.col("__covers.start"), F.col("__covers.end"), F.col("__covers.raw"))).alias("covers"),
        F.col("__t.title_supplied").alias("titleIsSupplied"),
        F.when(ranged, "page-range").otherwise(F.col("source")).alias("numberSource"),
    )


# --- index pages -------------------------------------------------------------------------------


def entries(html: str | None) -> list[tuple[str, list[str]]]:
    """(text, classes) of the paragraphs that hold text."""
    return [(t, p.classes()) for p in page_root(html).find("p") if (t := tidy(p.text()))]


def _banner(rows: list[tuple[str, list[str]]]) -> int:
    """The first chapter banner that isn't marked as old, else the first; -1 if there is none."""
    at = [i for i, (t, _) in enumerate(rows) if CHAPTER_BANNER.match(t)]
    live = [i for i in at if not OLD.match(CHAPTER_BANNER.match(rows[i][0])[2].strip())]
    return (live or at or [-1])[0]


def read_listing(html: str | None, chapter: str | None) -> list[dict]:
    """Rows (pos, number, row_title) of a chapter's listing; wrapped titles joined, notes and banners passed over."""
    rows, out, open_ = entries(html), [], False
    start = _banner(rows)
    if start < 0 or not chapter:
        return out
    own = re.compile(rf"\[?({re.escape(chapter)}[-:][0-9A-Z:.\-]*[0-9A-Z])\]?\s+(.*)\Z")
    for text, classes in rows[start + 1 :]:
        m = own.match(text)
        if {"XNotes", "XNotesHeading"} & set(classes):
            open_ = False
        elif m:
            out.append({"pos": len(out) + 1, "number": m[1], "row_title": m[2].strip()})
            open_ = True
        elif re.match(r"section|part\b|article\b|\[?chapter\b", text, re.I) or text == text.upper():
            open_ = False
        elif open_:
            out[-1]["row_title"] += " " + text
    return out


def read_chapter(html: str | None) -> list[dict]:
    """(title, notes, annotations) of a chapter's index page."""
    rows = entries(html)
    at = _banner(rows)
    if at < 0:
        return [{"title": "", "notes": "", "annotations": []}]
    m = CHAPTER_BANNER.match(rows[at][0])
    inline, number, title, title_at = m[2].strip(), m[1], "", -1
    if inline and not OLD_OR_NEW.match(inline):
        title = inline
    else:
        nxt = next((i for i in range(at + 1, len(rows)) if not re.match(r"section\Z", rows[i][0], re.I) and not CHAPTER_BANNER.match(rows[i][0])), None)
        if nxt is not None and not re.match(rf"\[?{re.escape(number)}-", rows[nxt][0], re.I):
            title, title_at = rows[nxt][0], nxt
    opens = re.compile(rf"section\Z|(?:part|article)\b|\[?{re.escape(number)}[-:]", re.I)
    notes, annotations, open_, listing = [], [], False, False
    for i in range(at + 1, len(rows)):
        text, classes = rows[i]
        if i == title_at:
            continue
        if "XNotesHeading" in classes:
            annotations.append({"heading": text, "text": ""})
            open_ = True
        elif open_ and "XNotes" in classes:
            a = annotations[-1]
            a["text"] = a["text"] + "\n" + text if a["text"] else text
        else:
            open_ = False
            if listing:
                continue
            listing = bool(opens.match(text))
            if not listing:
                notes.append(text)
    return [{"title": re.sub(r"\A\[|\]\Z", "", title).strip(), "notes": "\n\n".join(notes), "annotations": [a for a in annotations if a["text"]]}]


def read_title(html: str | None) -> list[dict]:
    """The banner of a title on a page, if any: its division, name, listing of chapters by subtitle, notes.

    The name goes on in plain paragraphs up to anything structural; so do names of subtitles and chapters in the listing.
    """
    rows = entries(html)
    stop = next((i for i, (t, _) in enumerate(rows) if CHAPTER_BANNER.match(t)), len(rows))
    head = rows[:stop]
    at = next((i for i, (t, _) in enumerate(head) if TITLE_BANNER.match(t)), None)
    if at is None:
        return []
    m = TITLE_BANNER.match(head[at][0])
    plain = lambda c: "RegularParagraphs" in c
    name = [m[3]]
    for text, classes in head[at + 1 :]:
        if not plain(classes) or text == "Chapter" or SUBTITLE.match(text) or CHAPTER_ROW.match(text):
            break
        name.append(text)
    division = next((DIVISION_BANNER.match(t) for t, _ in head if DIVISION_BANNER.match(t)), None)
    listing: list[dict] = []
    notes: list[str] = []
    annotations: list[dict] = []
    grows: tuple[dict, str] | None = None  # what a plain paragraph goes on with
    inside = noted = False
    for text, classes in head[at + 1 :]:
        if "XNotesHeading" in classes:
            annotations.append({"heading": text, "text": ""})
            grows, inside, noted = None, False, True
        elif "XNotes" in classes:
            if noted:
                a = annotations[-1]
                a["text"] = a["text"] + "\n" + text if a["text"] else text
            else:
                notes.append(text)
            grows, inside = None, False
        else:
            noted = False
            if not plain(classes):
                continue
            sub, row = SUBTITLE.match(text), CHAPTER_ROW.match(text)
            if text == "Chapter":
                inside = True
            elif sub:
                listing.append({"subtitle": f"Subtitle {sub[1]}. {sub[2].strip()}", "chapters": []})
                grows, inside = (listing[-1], "subtitle"), True
            elif row and inside:
                if not listing:
                    listing.append({"subtitle": None, "chapters": []})
                listing[-1]["chapters"].append({"number": row[1], "name": row[2].strip()})
                grows = (listing[-1]["chapters"][-1], "name")
            elif re.match(r"appendix\b", text, re.I):
                grows, inside = None, False
            elif grows:
                grows[0][grows[1]] += " " + text
    return [{"division_number": int(division[1]) if division else None, "division_name": division[2] if division else None, "number": m[2], "name": re.sub(r"\]\Z", "", " ".join(name)).strip(), "supplied": m[1] == "[", "listing": [g for g in listing if g["chapters"]], "notes": "\n\n".join(notes), "annotations": [a for a in annotations if a["text"]]}]


_NOTES = pa.list_(pa.struct([("heading", pa.string()), ("text", pa.string())]))
_NOTES_DDL = "array<struct<heading:string,text:string>>"


def parse_listings(pages: DataFrame, chapter: str = "chapter", html: str = "html") -> DataFrame:
    """(chapter, pos, number, row_title)."""
    p = pages.withColumn("__of", F.col(chapter))
    return _mapped(p, [chapter], [html, "__of"], read_listing, pa.schema([("pos", pa.int64()), ("number", pa.string()), ("row_title", pa.string())]), "pos long, number string, row_title string")


def parse_chapter_indexes(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    return _mapped(pages, [key], [html], read_chapter, pa.schema([("title", pa.string()), ("notes", pa.string()), ("annotations", _NOTES)]), f"title string, notes string, annotations {_NOTES_DDL}")


def parse_title_banners(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    chapters = pa.list_(pa.struct([("number", pa.string()), ("name", pa.string())]))
    schema = pa.schema([("division_number", pa.int32()), ("division_name", pa.string()), ("number", pa.string()), ("name", pa.string()), ("supplied", pa.bool_()), ("listing", pa.list_(pa.struct([("subtitle", pa.string()), ("chapters", chapters)]))), ("notes", pa.string()), ("annotations", _NOTES)])
    ddl = f"division_number int, division_name string, number string, name string, supplied boolean, listing array<struct<subtitle:string,chapters:array<struct<number:string,name:string>>>>, notes string, annotations {_NOTES_DDL}"
    return _mapped(pages, [key], [html], read_title, schema, ddl)


def html_paragraphs(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, pos, text, classes) of paragraphs with text."""
    read = lambda h: [{"pos": i, "text": t, "classes": c} for i, (t, c) in enumerate(entries(h), 1)]
    return _mapped(pages, [key], [html], read, pa.schema([("pos", pa.int64()), ("text", pa.string()), ("classes", pa.list_(pa.string()))]), "pos long, text string, classes array<string>")


def directory_entries(pages: DataFrame, base: str, html: str = "html") -> DataFrame:
    """(base, name, url, is_dir): direct children that a directory page links to.

    Addresses are resolved against the page's; those outside it, the page itself and deeper ones are left out.
    """
    from urllib.parse import unquote, urljoin

    def read(page: str | None, url: str | None) -> list[dict]:
        out = []
        for a in page_root(page).find("a"):
            full = urljoin(url or "", a.attrs["href"]) if "href" in a.attrs else ""
            if not url or not full.startswith(url) or full == url:
                continue
            below = unquote(full[len(url) :])
            name = below.removesuffix("/")
            if name and "/" not in name:
                out.append({"name": name, "url": full, "is_dir": below.endswith("/")})
        return out

    p = pages.withColumn("__of", F.col(base))
    return _mapped(p, [base], [html, "__of"], read, pa.schema([("name", pa.string()), ("url", pa.string()), ("is_dir", pa.bool_())]), "name string, url string, is_dir boolean")


