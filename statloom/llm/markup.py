"""Markup residue in texts: HTML, Markdown, wiki and LaTeX to clean text, structure kept.

Clean text writes structure in one plain way: headings as "# ...", list items as "- ...", table rows with cells
parted by " | ", code between lines of ```, formulas between dollar signs. All other markup goes, its text stays.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape
from html.entities import html5

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.wrappers import Node, Wrapper, induce, parse_html, with_wrapper, wrapper_of

_I, _M, _S, _X = re.I, re.M, re.S, re.X

#: Regions that own all that is in them; where several begin at one place the first counts.
_OWNED = r"""
      (?P<comment> <!--.*?(?:-->|\Z) )
    | (?P<pre> <(?P<pretag>pre|xmp|listing)\b[^>]*> (?P<prebody>.*?) (?:</(?P=pretag)\s*>|\Z) )
    | (?P<wcode> <(?P<wtag>syntaxhighlight|source)\b[^>]*> (?P<wbody>.*?) (?:</(?P=wtag)\s*>|\Z) )
    | (?P<wmath> <math\b[^>]*> (?P<wmbody>.*?) (?:</math\s*>|\Z) )
    | (?P<hcode> <(?P<ctag>code|tt|kbd|samp)\b[^>]*> (?P<cbody>.*?) </(?P=ctag)\s*> )
    | (?P<fence> ^[ \t]{0,3}(?P<mark>`{3,}|~{3,})[^\n`]*\n (?P<fbody>.*?) (?:^[ \t]{0,3}(?P=mark)[`~]*[ \t]*$|\Z) )
    | (?P<verbatim> \\begin\{(?P<venv>verbatim|Verbatim|lstlisting|minted|alltt)\*?\}(?:\[[^\]]*\]|\{[^}]*\})* (?P<vbody>.*?) (?:\\end\{(?P=venv)\*?\}|\Z) )
    | (?P<verb> \\(?:verb|lstinline)\*?(?P<vsign>[^\sA-Za-z*{]) (?P<vtext>[^\n]+?) (?P=vsign) | \\texttt\{(?P<tttext>[^{}]*)\} )
    | (?P<tick> (?<![`\\])`(?!`) (?P<ticktext>[^`\n]+) `(?!`) )
    | (?P<htable> <table\b[^>]*> (?P<htbody>.*?) (?:</table\s*>|\Z) )
    | (?P<wtable> ^[ \t]*\{\| (?P<wtbody>.*?) (?:^[ \t]*\|\}|\Z) )
    | (?P<ltable> \\begin\{(?P<tenv>tabular|tabularx|longtable|array|tabbing|table)\*?\} (?P<ltbody>.*?) (?:\\end\{(?P=tenv)\*?\}|\Z) )
    | (?P<lmath> \\begin\{(?P<menv>equation|align|displaymath|gather|multline|eqnarray|math)\*?\} .*? (?:\\end\{(?P=menv)\*?\}|\Z)
      | \$\$ [^$]+ \$\$ | \\\[ .+? \\\] | \\\( .+? \\\)
      | (?<![\\$\w])\$ (?=[^\s$]) (?=[^$\n]*[\\^_{=<>+]) (?:(?!\.\s)[^$\n])*? (?<=[^\s$\\]) \$ (?![\d$]) )
    | (?P<script> <(?P<stag>sub|sup)\b[^>]*> (?P<sbody>.*?) </(?P=stag)\s*> )
    """
_PIPES = r"""
      (?P<mtable> ^[ \t]*\|?[^\n|]+\|[^\n]*\n[ \t]*\|?[ \t]*:?-{2,}:?[ \t]*(?:\|[ \t]*:?-{2,}:?[ \t]*)+\|?[ \t]*$ (?:\n[^\n|]*\|[^\n]*$)*
      | ^[ \t]*\|[^\n|]+\|[ \t]*\n[ \t]*\|[ \t]*:?-{2,}:?[ \t]*\|[ \t]*$ (?:\n[^\n|]*\|[^\n]*$)* )
    """
#: Most texts hold no bar: they are searched only where a sign can begin a region.
_REGION = re.compile(rf"(?=[<`~$\\]|[ \t]{{1,3}}[`~])(?:{_OWNED})", _I | _M | _S | _X)
_REGION_OR_PIPES = re.compile(rf"{_OWNED} | {_PIPES}", _I | _M | _S | _X)
_TAG = re.compile(r"</?[a-zA-Z][a-zA-Z0-9:]*(?:\s(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)?\s*/?>", _S)
_ENTITY = re.compile(r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|([a-zA-Z][a-zA-Z0-9]{1,31}));")
#: What any markup holds at least; amounts and bracketed numbers don't count.
_HINT = re.compile(r"[<&*_`#{|\\^~]|\$(?!\d)|\]\(|\[(?=\[|\^|https?:|ftp:)|''|^[ \t]*(?:[-+=:;>]|\d+[.)][ \t])", _M)

_HTML_HEAD = re.compile(r"<h([1-6])\b[^>]*>(.*?)(?:</h[1-6]\s*>|(?=<h[1-6]\b)|\Z)", _I | _S)
_TEX_HEAD = re.compile(r"\\(part|chapter|section|subsection|subsubsection|paragraph|subparagraph)\*?(?:\[[^\]]*\])?\{([^{}]*)\}")
_TEX_LEVEL = {"part": 1, "chapter": 1, "section": 2, "subsection": 3, "subsubsection": 4, "paragraph": 5, "subparagraph": 6}
_WIKI_HEAD = re.compile(r"^[ \t]*(={1,6})[ \t]*([^=\s](?:[^\n]*[^=\s])?)[ \t]*\1[ \t]*$", _M)
_ATX = re.compile(r"^[ \t]{0,3}(#{1,6})[ \t]+(\S[^\n]*?)[ \t]*#*[ \t]*$", _M)
_UNDERLINE = re.compile(r"\n(={3,}|-{3,})[ \t]*(?=\n|\Z)")
_RULE = re.compile(r"^[ \t]*(?:-{3,}|\*{3,}|(?:- ){2,}-)[ \t]*$", _M)
_STRAY_CELL = re.compile(r"</?(?:table|tr|td|th|tbody|thead|tfoot|caption)\b[^<>]*>", _I)
_HTML_ITEM = re.compile(r"<(?:li|dt|dd)\b[^<>]*>\s*", _I)
_HTML_LIST = re.compile(r"</?(?:ul|ol|dl|li|dt|dd|menu)\b[^<>]*>", _I)
_TEX_LIST = re.compile(r"\\(?:begin|end)\{(?:itemize|enumerate|description|compactitem|compactenum)\}(?:\[[^\]]*\])?[ \t]*\n?")
_TEX_ITEM = re.compile(r"\\item\b[ \t]*(?:\[([^\]]*)\])?[ \t]*")
_STAR = re.compile(r"^[ \t]?(\*+[#*:;]*)[ \t]*(?=\S)")
_HASH = re.compile(r"^(#+[#*:;]*)[ \t]*(?=\S)")
_INDENT = re.compile(r"^([:;]+)[ \t]*(?=\S)")
_DASH = re.compile(r"^([ \t]*)[-+][ \t]+(?=\S)")
_NUMBER = re.compile(r"^([ \t]*)(\d{1,3})[.)][ \t]+(?=\S)")

_IMAGE = re.compile(r"!\[([^\[\]\n]*)\]\(([^()\n]*)\)")
_LINK = re.compile(r"(?<![!\]])\[([^\[\]]+)\]\(\s*<?([^()\s<>]*)>?(?:\s+[\"'][^\"'\n]*[\"'])?\s*\)")
_SUBSECTION = re.compile(r"[A-Za-z0-9]{1,5}\Z")
_MD_INLINE = (
    re.compile(r"(?<![\w*\\])\*\*(?=[^\s*])([^*\n]+?)(?<=[^\s*])\*\*(?![\w*])"),
    re.compile(r"(?<![\w_])__(?=[^\s_])([^_\n]+?)(?<=[^\s_])__(?![\w_])"),
    re.compile(r"(?<!~)~~(?=[^\s~])([^~\n]+?)(?<=[^\s~])~~(?!~)"),
    re.compile(r"(?<![\w*\\])\*(?=[^\s*])([^*\n]+?)(?<=[^\s*])\*(?![\w*])"),
    re.compile(r"(?<![\w_\\])_(?=[^\s_])([^_\n]+?)(?<=[^\s_])_(?![\w_])"),
)
_AUTOLINK = re.compile(r"<((?:https?|ftp|mailto):[^<>\s]+)>", _I)
_NOTE = re.compile(r"\[\^[\w-]+\]:?[ \t]*")
_QUOTE = re.compile(r"^[ \t]{0,3}>[ \t]+(?=\S)", _M)
_WIKI_REF = re.compile(r"<ref\b[^>]*/>|<ref\b[^>]*>.*?</ref\s*>|</?references\b[^>]*>|</?nowiki\s*/?>", _I | _S)
_WIKI_LINK = re.compile(r"\[\[([^\[\]]+)\]\]")
_WIKI_NAMESPACE = re.compile(r"\s*:?(?:Category|File|Image|Template)\s*:", _I)
_WIKI_TEMPLATE = re.compile(r"\{\{[^{}]*\}\}")
_WIKI_OUT = re.compile(r"\[(?:https?|ftp)://[^\s\[\]]+(?:\s+([^\[\]]*))?\]")
_WIKI_QUOTES = re.compile(r"(?<!')('{5}|'{3}|'{2})(?=[^'\s])([^\n]+?)(?<=[^'\s])\1(?!')")
_WIKI_MAGIC = re.compile(r"__(?:NO)?(?:TOC|EDITSECTION|INDEX)__|~{3,5}(?=\s|$)")
_TEX_COMMAND = re.compile(r"(?<![\\:])\\([a-zA-Z]+)\*?(?:\[[^\]]*\])*\{([^{}]*)\}")
_TEX_BARE = re.compile(r"(?<![\\:])\\(?:noindent|newline|par|ldots|dots|quad|qquad|centering|maketitle|pagebreak|newpage|clearpage|hline|medskip|bigskip|smallskip|LaTeX|TeX|textbackslash|S|P)(?![A-Za-z])")
_TEX_BREAK = re.compile(r"\\\\(?=\s|$)", _M)
_TEX_ESCAPE = re.compile(r"(?<![\\:])\\([%&$])")
#: Commands whose argument is no part of the text.
_TEX_MUTE = frozenset("cite citep citet ref eqref pageref label vspace hspace bibliography bibliographystyle usepackage documentclass includegraphics input begin end".split())

Kinds = set[tuple[str, str]]


def _rows(cells: list[list[str]]) -> str:
    return "\n".join(" | ".join(" ".join(c.split()) for c in r) for r in cells if any(c.strip() for c in r))


def _html_rows(table: Node) -> list[list[str]]:
    out: list[list[str]] = []
    stack = table.children[::-1]
    while stack:
        c = stack.pop()
        if c.tag == "tr":
            out.append([x.full_text() for x in c.children if x.tag in ("td", "th")])
        elif c.tag in ("td", "th"):
            out.append([c.full_text()])
        elif c.tag != "#":
            stack.extend(reversed(c.children))
    return out


def _wiki_rows(body: str) -> list[list[str]]:
    out: list[list[str]] = [[]]
    for line in body.split("\n")[1:]:
        line = line.strip()
        if line.startswith("|-"):
            out.append([])
        elif line.startswith("|+"):
            out.append([line[2:]])
            out.append([])
        elif line[:1] in ("|", "!"):
            for cell in re.split(r"\|\||!!", line[1:]):
                out[-1].append(cell.rpartition("|")[2] if re.match(r"\s*\w+\s*=", cell) else cell)
        elif out[-1]:
            out[-1][-1] += " " + line
    return out


def _tex_rows(body: str) -> list[list[str]]:
    body = re.sub(r"^(?:\[[^\]]*\]|\{[^{}]*\})+", "", body.strip())
    return [[re.sub(r"\\[a-zA-Z]+\*?|[{}]", "", c) for c in re.split(r"(?<!\\)&", r)] for r in re.split(r"\\\\", re.sub(r"\\(?:hline|toprule|midrule|bottomrule)\b", "", body))]


def _pipe_rows(text: str) -> list[list[str]]:
    return [line.strip().strip("|").split("|") for k, line in enumerate(text.split("\n")) if k != 1]


def _formula(t: str) -> str:
    t = re.sub(r"\A(?:\$\$|\\\[|\\\(|\$)|(?:\$\$|\\\]|\\\)|\$)\Z", "", t.strip())
    return "$" + " ".join(re.sub(r"\\(?:begin|end)\{\w+\*?\}", "", t).split()) + "$"


def _list_lines(text: str, found: Kinds) -> str:
    """Lines of wiki and Markdown lists. A lone line that begins with a star and no blank is the law's own footnote."""
    lines = text.split("\n")
    out = list(lines)
    at = 0
    while at < len(lines):
        for sign, kind in ((_STAR, "wiki"), (_HASH, "wiki"), (_INDENT, "wiki"), (_DASH, "markdown"), (_NUMBER, "markdown")):
            end = at
            while end < len(lines) and sign.match(lines[end]):
                end += 1
            n = end - at
            if not n:
                continue
            alone = (at == 0 or not lines[at - 1].strip()) and (end == len(lines) or not lines[end].strip())
            if sign is _STAR:
                good = n > 1 or re.match(r"[ \t]?\*+(?:[ \t]+|\[\[)", lines[at])
            elif sign is _DASH:
                good = n > 1 or alone
            elif sign is _NUMBER:
                numbers = [int(_NUMBER.match(x)[2]) for x in lines[at:end]]
                good = n > 1 and all(b in (a, a + 1, 1) for a, b in zip(numbers, numbers[1:], strict=False)) or (alone and numbers == [1])
            else:
                good = n > 1
            if good:
                found.add((kind, "list"))
                for k in range(at, end):
                    m = sign.match(lines[k])
                    depth = len(m[1]) - 1 if kind == "wiki" else len(m[1].expandtabs(4)) // 2
                    out[k] = "  " * max(0, depth) + (f"{m[2]}. " if sign is _NUMBER else "- ") + lines[k][m.end() :]
                at = end - 1
                break
        at += 1
    return "\n".join(out)


def convert_text(text: str | None) -> tuple[Kinds, str]:
    """(kinds of markup with what they mark, clean text) of a text that may hold any of the four kinds.

    Signs of the law's own text are kept and no markup: a footnote star, comparisons, dollar amounts, blanks to fill
    in, a bracketed number followed by a subsection. Null gives no kinds and an empty text.
    """
    found: Kinds = set()
    if not text or not _HINT.search(text):
        return found, (text or "").strip()
    free = [chr(c) for c in range(0xE000, 0xE100) if chr(c) not in text][:2] or ["\ue000", "\ue001"]
    left, right = free[0], free[-1]
    held: list[str] = []

    def hold(piece: str) -> str:
        held.append(piece)
        return f"{left}{len(held) - 1}{right}"

    def say(markup: str, construct: str, put: Callable[[re.Match], str] | str = "") -> Callable[[re.Match], str]:
        def run(m: re.Match) -> str:
            found.add((markup, construct))
            return put(m) if callable(put) else put

        return run

    def region(m: re.Match) -> str:
        g = m.lastgroup if m.lastgroup in _OWNERS else next(k for k in _OWNERS if m[k] is not None)
        markup, construct = _OWNERS[g]
        found.add((markup, construct))
        if g == "comment":
            return ""
        if construct == "code":
            body = next(m[k] for k in ("prebody", "wbody", "cbody", "fbody", "vbody", "vtext", "tttext", "ticktext") if m[k] is not None)
            body = unescape(_TAG.sub("", body)) if g in ("pre", "hcode") else body
            return hold("`" + body + "`" if g in ("hcode", "verb", "tick") else "```\n" + body.strip("\n") + "\n```")
        if construct == "table":
            rows = _html_rows(parse_html(m.group())) if g == "htable" else _wiki_rows(m["wtbody"]) if g == "wtable" else _tex_rows(m["ltbody"]) if g == "ltable" else _pipe_rows(m.group())
            return hold(_rows(rows))
        if g == "script":
            return hold(("_" if m["stag"].lower() == "sub" else "^") + unescape(_TAG.sub("", m["sbody"])))
        return hold(_formula(m["wmbody"] if g == "wmath" else m.group()))

    t = (_REGION_OR_PIPES if "|" in text else _REGION).sub(region, text)
    head = lambda level, title: f"\n{hold('#' * level)} {title.strip()}\n"
    t = _HTML_HEAD.sub(say("html", "heading", lambda m: head(int(m[1]), m[2])), t)
    t = _TEX_HEAD.sub(say("latex", "heading", lambda m: head(_TEX_LEVEL[m[1]], m[2])), t)
    t = _WIKI_HEAD.sub(say("wiki", "heading", lambda m: head(len(m[1]), m[2])), t)

    def atx(m: re.Match) -> str:
        around = m.string[: m.start()].rstrip(" \t")[-1:] == "\n" and re.search(r"(?m)^#[^\n]*\n\Z", m.string[: m.start()]), re.match(r"\n#", m.string[m.end() :])
        if len(m[1]) == 1 and any(around):
            return m.group()  # one of several lines: a wiki list
        found.add(("markdown", "heading"))
        return head(len(m[1]), m[2])

    t = _ATX.sub(atx, t)
    at = 0
    while (m := _UNDERLINE.search(t, at)) is not None:  # a line with text above makes it a heading's underline
        begin = t.rfind("\n", 0, m.start()) + 1
        title, at = t[begin : m.start()], m.end()
        if title.strip() and "|" not in title:
            found.add(("markdown", "heading"))
            line = head(1 if m[1][0] == "=" else 2, title)
            t = t[:begin] + line + t[m.end() :]
            at = begin + len(line)
    t = _STRAY_CELL.sub(say("html", "table", " "), t)
    t = _HTML_ITEM.sub(say("html", "list", lambda m: "\n" + hold("-") + " "), t)
    t = _HTML_LIST.sub(say("html", "list"), t)
    t = _TEX_LIST.sub(say("latex", "list"), t)
    t = _TEX_ITEM.sub(say("latex", "list", lambda m: hold("-") + " " + (m[1] + " " if m[1] else "")), t)
    t = _list_lines(t, found)
    t = _RULE.sub(say("markdown", "inline"), t)
    t = _AUTOLINK.sub(say("markdown", "inline", lambda m: m[1]), t)
    t = _IMAGE.sub(say("markdown", "inline", lambda m: m[1]), t)

    def link(m: re.Match) -> str:
        if _SUBSECTION.match(m[2]):
            return m.group()
        found.add(("markdown", "inline"))
        return m[1]

    t = _LINK.sub(link, t)
    t = _NOTE.sub(say("markdown", "inline"), t)
    t = _QUOTE.sub(say("markdown", "inline"), t)
    t = _WIKI_REF.sub(say("wiki", "inline"), t)
    t = _WIKI_LINK.sub(say("wiki", "inline", lambda m: "" if _WIKI_NAMESPACE.match(m[1]) else m[1].rpartition("|")[2]), t)
    while True:
        new = _WIKI_TEMPLATE.sub(say("wiki", "inline"), t)
        if new == t:
            break
        t = new
    t = _WIKI_OUT.sub(say("wiki", "inline", lambda m: m[1] or ""), t)
    t = _WIKI_QUOTES.sub(say("wiki", "inline", lambda m: m[2]), t)
    t = _WIKI_MAGIC.sub(say("wiki", "inline"), t)
    for sign in _MD_INLINE:
        t = sign.sub(say("markdown", "inline", lambda m: m[1]), t)
    while True:
        new = _TEX_COMMAND.sub(say("latex", "inline", lambda m: "" if m[1] in _TEX_MUTE else m[2]), t)
        if new == t:
            break
        t = new
    t = _TEX_BARE.sub(say("latex", "inline", " "), t)
    t = _TEX_BREAK.sub(say("latex", "inline", "\n"), t)
    t = _TEX_ESCAPE.sub(say("latex", "inline", lambda m: m[1]), t)
    t = _TAG.sub(say("html", "inline", lambda m: "\n" if re.match(r"</?(?:p|br|div|tr)\b", m.group(), _I) else ""), t)

    def entity(m: re.Match) -> str:
        if m[1] and m[1] + ";" not in html5:
            return m.group()
        found.add(("html", "inline"))
        return unescape(m.group())

    t = _ENTITY.sub(entity, t)
    if held:
        t = re.sub(f"{left}(\\d+){right}", lambda m: held[int(m[1])] if int(m[1]) < len(held) else m.group(), t)
    return found, re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+\n", "\n", t)).strip()


_OWNERS = {
    "comment": ("html", "inline"), "pre": ("html", "code"), "wcode": ("wiki", "code"), "wmath": ("wiki", "formula"), "hcode": ("html", "code"), "fence": ("markdown", "code"), "verbatim": ("latex", "code"), "verb": ("latex", "code"), "tick": ("markdown", "code"),
    "htable": ("html", "table"), "wtable": ("wiki", "table"), "ltable": ("latex", "table"), "mtable": ("markdown", "table"), "lmath": ("latex", "formula"), "script": ("html", "formula"),
}

# --- pages -------------------------------------------------------------------------------------

_CODE = frozenset("pre code tt kbd samp xmp listing plaintext".split())
_OWN_LINES = frozenset("pre xmp listing plaintext".split())
_SCRIPTS = {"sub": "_", "sup": "^", "math": ""}
_LISTS = frozenset("ul ol dl menu dir".split())
_ITEMS = frozenset("li dt dd".split())
_BLOCKS = frozenset("p div blockquote tr center".split())
_HEADS = {f"h{n}": "\n\n" + "#" * n + " " for n in range(1, 7)}
_BLANKS, _BREAK, _MANY = re.compile(r"[ \t\r\n\xa0]+"), re.compile(r" *\n *(?=[^\s-])"), re.compile(r"\n{3,}")


def convert_nodes(nodes: list[Node]) -> tuple[Kinds, str]:
    """(kinds of html structure, clean text) of a page's nodes.

    A table, code or formula owns what is in it. Comments and escaped tags are no elements and don't count.
    """
    found: Kinds = set()
    out: list[str] = []
    stack: list[tuple[Node | str, int]] = [(n, 0) for n in reversed(nodes)]
    while stack:
        n, depth = stack.pop()
        if isinstance(n, str):
            out.append(n)
        elif n.tag == "#":
            out.append(_BLANKS.sub(" ", n.text))
        elif n.tag == "table":
            found.add(("html", "table"))
            out.append("\n" + _rows(_html_rows(n)) + "\n")
        elif n.tag in _CODE:
            found.add(("html", "code"))
            body = n.full_text().strip("\n")
            out.append(f"\n```\n{body}\n```\n" if n.tag in _OWN_LINES else f"`{body}`")
        elif n.tag in _SCRIPTS:
            found.add(("html", "formula"))
            out.append(_SCRIPTS[n.tag] + n.full_text())
        else:
            block = False
            if n.tag in _ITEMS:
                found.add(("html", "list"))
                out.append("\n" + "  " * max(0, depth - 1) + "- ")
            elif n.tag in _LISTS:
                found.add(("html", "list"))
                depth += 1
            elif n.tag in _HEADS:
                out.append(_HEADS[n.tag])
                block = True
            elif n.tag == "br":
                out.append("\n")
            elif n.tag in _BLOCKS:
                out.append("\n\n")
                block = True
            if block:
                stack.append(("\n\n", 0))
            stack.extend((c, depth) for c in reversed(n.children))
    return found, _MANY.sub("\n\n", _BREAK.sub("\n", "".join(out))).strip()


HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)"


def cleaned(parsed: DataFrame, key: str = "record_id") -> DataFrame:
    """(key, field_name, kinds, clean_text) of bodyText and bodyHtml; ``key`` unique.

    Pages of a host (null: those without an address) share a wrapper, learned from all of them; what is its template is no part of a
    page's content. A null field gives no row; an empty one an empty text. kinds is array<struct<markup, construct>>, sorted.
    """
    pages = parsed.select(key, "bodyText", "bodyHtml", F.coalesce(F.regexp_extract("url", HOST, 1), F.lit("")).alias("host"))
    pages, sent = with_wrapper(pages, induce(pages, key, "host", "bodyHtml"))
    kind = dict(parsed.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Wrapper | None] = {}
        for b in batches:
            at: list[int] = []
            name: list[str] = []
            kinds: list[list[dict[str, str]]] = []
            clean: list[str] = []
            for r, (text, html, host, packed) in enumerate(zip(*(b.column(c).to_pylist() for c in ("bodyText", "bodyHtml", "host", "wrapper")), strict=True)):
                for field, value in (("bodyText", text), ("bodyHtml", html)):
                    if value is None:
                        continue
                    if field == "bodyText":
                        k, c = convert_text(value)
                    else:
                        page, w = parse_html(value), wrapper_of(host, packed, sent, known)
                        k, c = convert_nodes((w.content(page) if w else page).children)
                    at.append(r)
                    name.append(field)
                    kinds.append([{"markup": m, "construct": x} for m, x in sorted(k)])
                    clean.append(c)
            yield pa.RecordBatch.from_arrays([b.column(key).take(pa.array(at, pa.int64())), pa.array(name, pa.string()), pa.array(kinds, pa.list_(pa.struct([("markup", pa.string()), ("construct", pa.string())]))), pa.array(clean, pa.string())], [key, "field_name", "kinds", "clean_text"])

    return pages.select(key, "bodyText", "bodyHtml", "host", "wrapper").mapInArrow(run, f"`{key}` {kind}, field_name string, kinds array<struct<markup:string,construct:string>>, clean_text string")


def markup_found(parsed: DataFrame) -> DataFrame:
    """(record_id, field_name, markup, construct): the kinds of markup in a field, each once."""
    return cleaned(parsed).select("record_id", "field_name", F.explode("kinds").alias("k")).select("record_id", "field_name", "k.markup", "k.construct")
