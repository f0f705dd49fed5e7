"""A small tolerant HTML tree for pages written by word processors."""

from __future__ import annotations

import re
from html import unescape

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][\w:-]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
_ATTR = re.compile(r"([\w:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
DROPPED = frozenset("script style".split())
BLOCK = frozenset("address blockquote center dir div dl fieldset form h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul".split())


class Element:
    """tag, attributes, and children that are elements or texts."""

    __slots__ = ("attrs", "children", "tag")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []

    def text(self) -> str:
        out, stack = [], [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                out.append(n)
            else:
                stack.extend(reversed(n.children))
        return "".join(out)

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def find(self, tag: str) -> list["Element"]:
        """Elements of a tag below this one, in the order of the page."""
        out, stack = [], [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                continue
            if n.tag == tag and n is not self:
                out.append(n)
            stack.extend(reversed(n.children))
        return out

    def runs(self, bold: bool = False) -> list[tuple[str, bool]]:
        """Texts in order, each with whether it is bold."""
        out = []
        for c in self.children:
            if isinstance(c, str):
                out.append((c, bold))
            else:
                out += c.runs(bold or c.tag in ("b", "strong"))
        return out


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(text)}


def parse(html: str | None) -> Element:
    """The page as a tree; unclosed paragraphs end where the next block begins, stray ends are passed over."""
    root = Element("root")
    stack, at, text = [root], 0, html or ""
    for m in _TOKEN.finditer(text):
        if m.start() < at:
            continue
        if m.start() > at:
            stack[-1].children.append(unescape(text[at : m.start()]))
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if m["end"]:
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)
            if k:
                del stack[k:]
            continue
        if tag in DROPPED:
            end = re.compile(rf"</{tag}\s*>", re.I).search(text, at)
            at = end.end() if end else len(text)
            continue
        if tag in BLOCK:
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag in ("p", "td", "th", "li", "div")), 0)
            if k and stack[k].tag == "p":
                del stack[k:]
        node = Element(tag, attributes(m["attrs"]))
        stack[-1].children.append(node)
        if tag not in VOID and not m["attrs"].endswith("/") and len(stack) < 300:
            stack.append(node)
    if at < len(text):
        stack[-1].children.append(unescape(text[at:]))
    return root


def page_root(html: str | None, drop_id: str = "pageLinks", inner: str = "WordSection1") -> Element:
    """The part of a page that holds its text: the named division if there is one, else the body; navigation dropped."""
    root = parse(html)
    stack = [root]
    while stack:
        n = stack.pop()
        n.children = [c for c in n.children if isinstance(c, str) or c.attrs.get("id") != drop_id]
        stack += [c for c in n.children if not isinstance(c, str)]
    own = [d for d in root.find("div") if inner in d.classes()]
    if own:
        return own[0]
    body = root.find("body")
    return body[0] if body else root
