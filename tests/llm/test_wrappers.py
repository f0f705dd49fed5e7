import time

import pytest
from statloom.llm.markup import cleaned, convert_nodes
from statloom.llm.wrappers import Alignment, Induction, Wrapper, induce, marked, parse_html, units

SCHEMA = "record_id long, bodyText string, bodyHtml string, url string"


def clean_texts(spark, pages, host="https://h.org/"):
    df = spark.createDataFrame([(i, None, x, f"{host}{i}") for i, x in enumerate(pages)], SCHEMA)
    return {r.record_id: r.clean_text for r in cleaned(df).collect()}


def test_constant_siblings_go_whatever_their_number(spark):
    notes = "".join(f"<p>Notice {i} of this site.</p>" for i in range(40))
    pages = [f"{notes}<p>Text {k} of its own, {'long ' * (k % 7)}.</p><p>Footer</p><ul><li>Imprint</li></ul>" for k in range(100)]
    got = clean_texts(spark, pages)
    assert all(got[k] == f"Text {k} of its own, {'long ' * (k % 7)}." for k in got) and len(got) == 100


def test_what_most_pages_say_in_a_varying_place_is_content(spark):
    pages = [f"<div class=top>Site</div><p><b>§1-{k} Title {k}.</b></p><p>{'Repealed.' if k % 3 else f'Text {k}.'}</p>" for k in range(90)]
    got = clean_texts(spark, pages)
    assert all(got[k] == f"§1-{k} Title {k}.\n\n{'Repealed.' if k % 3 else f'Text {k}.'}" for k in got)


def test_headings_within_the_content_stay(spark):
    head = "<p class=note>Cross References</p>"
    pages = [f"<nav><a>Home</a> <a>Search</a></nav><p>Body {k} says this.</p>{head if k % 3 else ''}<p class=x>See {k}.</p><footer>Imprint</footer>" for k in range(60)]
    got = clean_texts(spark, pages)
    assert all(got[k] == f"Body {k} says this.\n\n{'Cross References' if k % 3 else ''}".strip() + f"\n\nSee {k}." for k in got)


def test_lists_of_which_a_part_varies(spark):
    nav = "".join(f"<li class=n>Item {i}</li>" for i in range(6))
    pages = [f"<ul class=nav>{nav}<li class=here>You are at {k}</li></ul><div class=main><table><tr><td>{k}</td></tr></table></div>" for k in range(30)]
    got = clean_texts(spark, pages)
    assert got[7] == "- You are at 7\n\n7"


def test_template_in_a_layout_table(spark):
    pages = [f"<table><tr><td class=left><p>Menu</p></td><td><p>Text {k} <b>and</b> <i>more</i></p></td></tr></table>" for k in range(30)]
    assert clean_texts(spark, pages)[3] == "Text 3 and more"


def test_words_are_not_joined(spark):
    pages = [f"<div class=nav>Home</div><div><b>See</b> <i>section {k}</i></div> <b>x</b> <i>y{k}</i>" for k in range(20)]
    got = clean_texts(spark, pages)
    assert got[4].split("\n")[0] == "See section 4" and got[4].endswith("x y4")
    assert convert_nodes(parse_html("<p><b>See</b> <i>section</i></p>").children)[1] == "See section"


def test_hosts_have_wrappers_of_their_own_and_nulls_count_for_nothing(spark):
    rows = [(i, None, f"<p>Top {i % 2}</p><div>Text {i}</div>" if i < 40 else None, f"https://h{i % 2}.org/{i}") for i in range(50)]
    rows += [(100 + i, None, f"<p>Top 0</p><div>Text {i}</div>", None) for i in range(3)]
    got = {r.record_id: r.clean_text for r in cleaned(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[0] == "Text 0" and got[1] == "Text 1" and got[100] == "Top 0\n\nText 0" and 45 not in got


def test_few_pages_have_no_template(spark):
    df = spark.createDataFrame([(i, "h", "<p>same</p>") for i in range(4)], "id long, host string, html string")
    assert induce(df, "id", "host", "html").collect() == []
    assert induce(df.limit(0), "id", "host", "html").collect() == []


def test_many_hosts_are_joined(spark, monkeypatch):
    from statloom.llm import wrappers as W

    monkeypatch.setattr(W, "SENT_HOSTS", 1)
    rows = [(i, None, f"<p>Top {i % 3}</p><div>Text {i}</div>", f"https://h{i % 3}.org/{i}") for i in range(60)]
    got = {r.record_id: r.clean_text for r in cleaned(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: f"Text {i}" for i in range(60)}


def test_a_table_of_ten_thousand_rows():
    table = lambda k: "<div>top</div><table>" + "".join(f"<tr><td>{i * k}</td><td>x</td></tr>" for i in range(10_000)) + "</table><p>end</p>"
    a, b = parse_html(table(1)), parse_html(table(3))
    w, counts = Wrapper(), {}
    for n in marked(a):
        counts[n.mark] = 9
    for page in (b, parse_html(table(7)), a):
        began = time.process_time()
        w.learn(page, counts, Induction())
        w.fixed = [True] * w.texts
        assert time.process_time() - began < 2
        began = time.process_time()
        w.content(page)
        assert time.process_time() - began < 1


def test_depth_and_stray_tags():
    deep = "<div>" * 20_000 + "x" + "</p>" * 20_000 + "</div>" * 20_000
    page = parse_html(deep)
    assert page.children[0].full_text() == "x" and len(marked(page)) == 20_001
    w = Wrapper()
    w.learn(page, {n.mark: 5 for n in marked(page)[-1:]}, Induction())
    w = Wrapper.loads(w.dumps())
    w.fixed = [True] * w.texts
    assert w.texts == 1 and w.content(parse_html(deep)).full_text() == ""
    parse_html("<td>" + "<div>" * 20_000 + "<i>x" + "</b></i>" * 20_000)


def brute(slots, nodes):
    """Weight of the best order-preserving matching, by trying all."""
    if not slots or not nodes:
        return 0.0
    s, n = slots[0], nodes[0]
    own = 0.0
    if (s.tag, s.cls) == (n.tag, n.cls):
        own = (3.0 if s.mark == n.mark else 1.0) if s.mark else 1.0 + brute(s.children, units(n))
    return max(brute(slots[1:], nodes), brute(slots, nodes[1:]), own + brute(slots[1:], nodes[1:]) if own else 0.0)


@pytest.mark.parametrize("left,right", [("<p>a</p><div><p>b</p><p>c</p></div><p>d</p>", "<p>x</p><div><p>c</p></div><p>d</p><p>a</p>"), ("<p>a</p><p>b</p>", "<p>b</p><p>a</p><p>b</p>"), ("<div><i>a</i><p>b</p></div><div><p>c</p></div>", "<div><p>c</p></div><p>q</p><div><p>b</p><p>r</p></div>")])
def test_alignment_has_the_greatest_weight(left, right):
    a, b = parse_html(left), parse_html(right)
    w = Wrapper()
    w.learn(a, {n.mark: 5 for n in marked(a) if n.flat}, Induction())
    marked(b)
    pairs = Alignment(w.slots, units(b)).pairs(w.slots, units(b))
    assert sum(x for _, _, x in pairs) == brute(w.slots, units(b))
    assert [p[:2] for p in pairs] == sorted(p[:2] for p in pairs)


@pytest.mark.parametrize("n", [40, 400])
@pytest.mark.parametrize("sent", [200, 0])
def test_a_page_that_says_all_twice_loses_it_once_whatever_its_size(spark, monkeypatch, n, sent):
    from statloom.llm import wrappers as W

    monkeypatch.setattr(W, "SENT_HOSTS", sent)
    notes = [f"<p>Notice {i}.</p>" for i in range(n)]
    own = lambda k: f"Text {k} of its own, {'long ' * 300}end."
    pages = [f"{''.join(x * (2 if k == 7 else 1) for x in notes)}<div>{own(k)}</div>" for k in range(60)]
    got = clean_texts(spark, pages)
    assert got.pop(7) == "\n\n".join(f"Notice {i}." for i in range(n)) + "\n\n" + own(7)
    assert got == {k: own(k) for k in range(60) if k != 7}


def whole_table(slots, nodes):
    """Weight of the best order-preserving matching, by the table of all pairs."""
    low = [0] * (len(nodes) + 1)
    for s in reversed(slots):
        row = [0] * (len(nodes) + 1)
        for y in range(len(nodes) - 1, -1, -1):
            n, own = nodes[y], 0
            if (s.tag, s.cls) == (n.tag, n.cls):
                own = (3 if s.mark == n.mark else 1) if s.mark else 1 + whole_table(s.children, units(n))
            row[y] = max(low[y], row[y + 1], low[y + 1] + own if own else 0)
        low = row
    return low[0]


@pytest.mark.parametrize("n", [30, 270])
def test_alignment_has_the_greatest_weight_whatever_its_size(n):
    left = "".join(f"<li><i>n{i}</i><p>Name {i}</p></li>" if i % 3 else f"<p>Name {i}</p>" for i in range(n))
    right = "".join(f"<li><p>Name {i}</p><p>Name {i + 1}</p></li><p>Name {i}</p>" for i in range(n))
    a, b = parse_html(left), parse_html(right)
    w = Wrapper()
    w.learn(a, {x.mark: 5 for x in marked(a) if x.flat}, Induction())
    marked(b)
    pairs = Alignment(w.slots, units(b)).pairs(w.slots, units(b))
    assert sum(x for _, _, x in pairs) == whole_table(w.slots, units(b))
    assert [p[:2] for p in pairs] == sorted(p[:2] for p in pairs)
