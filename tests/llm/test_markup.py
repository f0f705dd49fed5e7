import pytest
from statloom.llm.markup import cleaned, convert_text, markup_found
from statloom.llm.wrappers import parse_html

H, M, W, L = "html", "markdown", "wiki", "latex"
CASES = [
    ("plain law text, §1-2.", [], "plain law text, §1-2."),
    ("<h2 class='x'\n>Title</h2> body", [(H, "heading")], "## Title\n body"),
    ("<ul><li>a<li>b</ul>", [(H, "list")], "- a\n- b"),
    ("<TABLE border=1><tr><td>a<td><b>c</b></tr><tr><th>1<th>2</table>", [(H, "table")], "a | c\n1 | 2"),
    ("<pre>F = 2 * x</pre> and <code>y</code>", [(H, "code")], "```\nF = 2 * x\n``` and `y`"),
    ("x<sub>2</sub> + y<SUP>3</SUP>", [(H, "formula")], "x_2 + y^3"),
    ("a&nbsp;b <!-- c --> <br>d <o:p></o:p>&#167; AT&T &unknown;", [(H, "inline")], None),
    ("# Title\n\ntext", [(M, "heading")], "# Title\n\ntext"),
    ("Title\n=====\ntext", [(M, "heading")], None),
    ("- a\n- b\n  - c", [(M, "list")], None),
    ("1. a\n2. b", [(M, "list")], "1. a\n2. b"),
    ("| a | b |\n|---|:--:|\n| 1 | **2** |", [(M, "table")], "a | b\n1 | **2**"),
    ("~~~text\n* x\n<b>\n~~~", [(M, "code")], "```\n* x\n<b>\n```"),
    ("use `f(x)` here", [(M, "code")], "use `f(x)` here"),
    ("**bold** __too__ ~~gone~~ [a](https://x.org/1) ![m](/img/1.png)", [(M, "inline")], "bold too gone a m"),
    ("== Title ==\n\ntext", [(W, "heading")], "## Title\n\ntext"),
    ("*a\n**b\n* [[c|d]]", [(W, "list"), (W, "inline")], "- a\n  - b\n- d"),
    ("{| class=x\n|-\n| a || b\n|}", [(W, "table")], "a | b"),
    ("'''bold''' ''it'' {{note|x}} [[Category:Y]]", [(W, "inline")], "bold it"),
    ("\\section{Title}\n\nx", [(L, "heading")], "## Title\n\nx"),
    ("\\begin{itemize}\n\\item a\n\\item b\n\\end{itemize}", [(L, "list")], "- a\n- b"),
    ("\\begin{tabular}{lr}\na & b \\\\\nc & d \\\\\n\\end{tabular}", [(L, "table")], "a | b\nc | d"),
    ("\\begin{verbatim}\nx = 1\n\\end{verbatim}", [(L, "code")], "```\nx = 1\n```"),
    ("is $x = 4b^{2}$ and \\(\\frac{a}{b}\\) $$c_1$$", [(L, "formula")], "is $x = 4b^{2}$ and $\\frac{a}{b}$ $c_1$"),
    ("Costs\\footnote{not} \\emph{so} \\textbf{b}", [(L, "inline")], "Costsnot so b"),
    ("*Effective until the deed is repealed. The text", [], None),
    ("The reading was < 0.17 and later > 0.48; ratio of 3*4 or 9^2 {reserved}", [], None),
    ("from $500 to $1,000 or $6,000 in all; section [293-2](b)(2); [12-3](a)", [], None),
    ("Signed: ____________ this ______ day. C:\\FORMS\\12 #74 -- if any -- & Sons [sic]", [], None),
    ("", [], ""),
    (None, [], ""),
    ("<table", [], None),
    ("<pre>open", [(H, "code")], None),
]


@pytest.mark.parametrize("text,kinds,clean", CASES)
def test_texts(text, kinds, clean):
    got, out = convert_text(text)
    assert got == set(kinds)
    assert clean is None or out == clean


def test_hostile_texts():
    for t in ("<" * 50_000, "[" * 50_000, "*" * 50_000, "{{" * 20_000, "\\begin{tabular}" * 500, "|" * 20_000, "a\n" * 50_000 + "---", "\ue000" + "1\ue001 `x`", "$" * 5000, "<p " * 5000, "`" * 9999, "=" * 30_000 + "\n", "- a\n" * 20_000):
        convert_text(t)
        parse_html(t)


def page(body, n):
    return f'<div class=nav><ul><li>Home</li></ul></div><p class="R"><b>§1-{n} Title {n}.</b> Text {n} of its own.</p>{body}<p class="R">&nbsp;</p>'


def test_pages_without_their_template(spark):
    rows = [(i, None, page("", i), f"https://h.org/{i}", "x") for i in range(30)]
    rows += [
        (100, None, page("<ul><li>a<li>b</ul>", 100), "https://h.org/100", "x"),
        (101, None, page("<!-- <ul><li>old</li></ul> --><p>&lt;table&gt; is shown as typed", 101), "https://h.org/101", "x"),
        (102, None, page("<table><tr><td><ul><li>in</ul><sub>1</sub></table><pre>x<sup>2</sup></pre>", 102), "https://h.org/102", "x"),
        (103, "a `b`", None, None, "x"),
        (104, None, "<ul><li>only page of its host</ul>", "https://other.org/1", "x"),
        (105, "", "", "https://h.org/105", "x"),
    ]
    df = spark.createDataFrame(rows, "record_id long, bodyText string, bodyHtml string, url string, host string")
    assert sorted(tuple(r) for r in markup_found(df).collect()) == [(100, "bodyHtml", "html", "list"), (102, "bodyHtml", "html", "code"), (102, "bodyHtml", "html", "table"), (103, "bodyText", "markdown", "code"), (104, "bodyHtml", "html", "list")]
    clean = {(r.record_id, r.field_name): r.clean_text for r in cleaned(df).collect()}
    assert clean[100, "bodyHtml"] == "§1-100 Title 100. Text 100 of its own.\n\n- a\n- b" and "Home" not in clean[3, "bodyHtml"]
    assert clean[105, "bodyText"] == "" and (103, "bodyHtml") not in clean
    assert markup_found(df.limit(0)).collect() == []
