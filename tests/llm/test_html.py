import random
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings, strategies as st

from termflow.llm.html import extract_pages, op1_html_extraction, page_text

SF = "/root/testdata/sf0.001"

CASES = [
    ("", ""),
    ("plain", "plain"),
    ("a  b\n c", "a b c"),
    ("<p>one<p>two", "one\n\ntwo"),
    ("<div>one</div><div>two</div>three", "one\ntwo\nthree"),
    ("x<br>y<br><br>z", "x\ny\n\nz"),
    ("<b>x</b> <i>y</i>z", "x yz"),
    ("<p><b>bold<p>still", "bold\n\nstill"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    ("<ol start=3><li>x<li value=9>y<li>z</ol>", "3. x\n9. y\n10. z"),
    ("<ol type=a><li>x<li>y</ol><ol type=I><li>p<li>q", "a. x\nb. y\n\nI. p\nII. q"),
    ("<ul><li></li><li>x</ul>", "- x"),
    ("<ul><li><p>a<p>b</ul>", "- a\n\n  b"),
    ("<dl><dt>t<dd>d1<dd>d2<dt>u</dl>", "t\n  d1\n  d2\nu"),
    ("<blockquote>q<div>r</div></blockquote>s", "  q\n  r\n\ns"),
    ("<pre>\n a\n\tb\n\n c</pre>d", " a\n\tb\n\n c\n\nd"),
    ("<textarea>\n<b>&amp;\n x</textarea>", "<b>&\n x"),
    ("<table><tr><td>a<td>b<tr><td>long cell<td>c</table>", "a          b\nlong cell  c"),
    ("<table><td>a</td><td>b</td></table>", "a  b"),
    ("<table><caption>C<thead><tr><th>h<tbody><tr><td>x</table>y", "C\nh\nx\n\ny"),
    ("<table><tr><td rowspan=2>r<td>1<tr><td>2</table>", "r  1\n   2"),
    ("<table><tr><td colspan=2>both<td>z<tr><td>a<td>b<td>c</table>", "both  z\na  b  c"),
    ("<table><tr><td>a<table><tr><td>in<td>ner</table><td>b</table>", "a        b\n\nin  ner"),
    ("<table>out<tr><td>in</table>", "out\n\nin"),
    ("<table><tr><p>out</p><td>in</table>", "out\n\nin"),
    ("<td>no table</td>", "no table"),
    ("<p hidden>x</p><p style='display: none'>y</p><p style='visibility:hidden'>z<i style='visibility:visible'>v</i></p>", "v"),
    ("<style>.ad, #x {display:none} p{margin:0}</style><div class='a ad'>no</div><div id=x>no</div>yes", "yes"),
    ("<style>@media print{p{display:none}}</style><p>yes", "yes"),
    ("<head><title>t</title></head><script>if (a < b) '</p>'</script><noscript>n</noscript><template>t</template>x", "x"),
    ("<details><summary>s</summary>no</details><details open><summary>t</summary>yes</details>", "s\nt\nyes"),
    ("<select><option>a<option selected>b<option>c</select>!<dialog>no</dialog>", "b !"),
    ("<input type=submit value=Go><input value=no>", "Go"),
    ("&lt;b&gt; &copy; &#233; &notit; &amp;amp;", "<b> © é ¬it; &amp;"),
    ("a<!-- <p>no</p> -->b<!doctype x>c<?php no ?>d</>e", "abcde"),
    ("a < b <3 <é", "a < b <3 <é"),
    ("<a title='x > y' href=\"z>\">link</a><a title=it's>ok</a>", "linkok"),
    ("x<a title='never ends>y", "x"),
    ("x<div class=", "x"),
    ("<q>said</q>", '"said"'),
    ("</p>x</b></div>y", "xy"),
    ("<span style='display:block'>a</span>b<div style='display:inline'>c</div>", "a\nbc"),
    ("<ruby>k<rp>(</rp><rt>r</rt></ruby>", "kr"),
    ("<svg><title>no</title><text>yes</text></svg>", "yes"),
    ("A\0B<plaintext><p>", "AB<p>"),
]


@pytest.mark.parametrize("page, text", CASES)
def test_layout(page, text):
    assert page_text(page) == text


class Plain(HTMLParser):
    """All words outside of elements that are never shown."""

    def __init__(self):
        super().__init__()
        self.words, self.off = [], 0

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("script", "style", "title", "template")

    def handle_endtag(self, tag):
        self.off -= tag in ("script", "style", "title", "template")

    def handle_data(self, data):
        if not self.off:
            self.words.append(data)


def test_no_word_of_a_page_is_lost(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect()
    texts = {r.page_id: r.text for r in op1_html_extraction(spark, SF).collect()}
    assert len(rows) == len(texts)
    for r in rows:
        plain = Plain()
        plain.feed(r.html)
        want = " ".join(plain.words).split()
        got = [w for w in texts[r.page_id].replace("\n- ", "\n").removeprefix("- ").split()]
        assert "".join(want) == "".join(got)


@pytest.mark.parametrize("sheet, shown", [
    (".x{display:none} @media print{p{color:red}}", False),
    ("@font-face{font-family:a} @media print{p{display:none} b{color:red}} .x{display:none}", False),
    ("@import 'a{b'; .x{display:none}", False),
    (".x{background:url(a@2x.png);display:none}", False),
    ("@media print{.x{display:none}}", True),
    ("@media print{b{color:red} .x{display:none}", True),
    (".x{color:red; @media print{.x{display:none}}}", True)])
def test_plain_rules_beside_at_blocks(sheet, shown):
    assert page_text(f"<style>{sheet}</style><p class=x>some</p><p>yes") == ("some\n\nyes" if shown else "yes")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("a b <p> </p> <div> </div> <ul> <li> </ul> <table> <tr> <td> </table> </td> <b> </b> <br> <pre> </pre> "
                                "<ol> </ol> <dl> <dd> <th> <thead> <caption> </tr> <span> </span> <select> <option> </select>".split()
                                + [" ", "\n"]), max_size=40))
def test_any_nesting_keeps_each_word_once(parts):
    """Random tag soup without hiding elements: the visible letters are all there.
    A select shows one of its options, so soup with one is only run."""
    got = page_text("".join(parts))
    if "<select>" not in parts:
        assert sum(c in "ab" for c in got) == sum(p in ("a", "b") for p in parts)


SOUP = ("a b <p> </p> <div> </div> <ul> <li> </ul> <table> <tr> <td> </table> </td> <b> </b> <br> <pre> </pre> <ol> </ol> <dl> <dd> "
        "<th> <thead> <tfoot> <caption> </caption> </tr> <span> </span> <h1> </h2> <center> <object> <col> <tbody> </tbody>").split() + [" ", "\n"]


def test_twenty_thousand_soups_lose_no_letter():
    rng = random.Random(20_000)
    for _ in range(20_000):
        parts = rng.choices(SOUP, k=rng.randrange(1, 40))
        got = page_text("".join(parts))
        assert sum(c in "ab" for c in got) == sum(p in ("a", "b") for p in parts), "".join(parts)


@pytest.mark.parametrize("page, text", [
    ("<table><table>a", "a"),
    ("<table><tr><td>x</td></tr><table><tr><td>y", "x\n\ny"),
    ("<table><tr><td>x</td></tr><table><p>lost</p><tr><td>y", "x\n\nlost\n\ny"),
    ("<table><tr><td>x<table><tr><td>in", "x\n\nin"),
    ("<select><option>one<table><tr><td>cell", "one\n\ncell"),
    ("<style media=print>.x{display:none}</style><p class=x>seen", "seen"),
    ("<style media='only screen and (min-width:1px)'>.x{display:none}</style><p class=x>hid<p>seen", "seen"),
    ("<style media='print, screen'>.x{display:none}</style><p class=x>hid<p>seen", "seen"),
    ("<style media='not screen'>.x{display:none}</style><p class=x>seen", "seen"),
    ("<object>fallback</object>", "fallback"), ("<object data=a.swf>fallback</object>yes", "yes")])
def test_found_in_browsers(page, text):
    assert page_text(page) == text


def cell_places(page):
    """Line and place of each cell's first word, by an independent rule: the words are unique."""
    return {w: (i, line.index(w)) for i, line in enumerate(page_text(page).split("\n")) for w in line.split()}


def test_columns_are_aligned_at_any_width():
    rng = random.Random(8)
    for _ in range(60):
        columns, n = rng.randrange(2, 5), 0
        rows = []
        for r in range(rng.randrange(2, 6)):
            rows.append([" ".join(f"w{r}x{c}x{k}{'y' * rng.choice((0, 0, 5))}" for k in range(rng.choice((1, 1, 3, 40, 90)))) for c in range(columns)])
        page = "<table>" + "".join("<tr>" + "".join(f"<td>{t}" for t in row) for row in rows) + "</table>"
        places = cell_places(page)
        words = [w for row in rows for t in row for w in t.split()]
        assert sorted(places) == sorted(words)
        for c in range(columns):
            starts = {places[row[c].split()[0]][1] for row in rows}
            assert len(starts) == 1, page  # all cells of a column begin at one place
        for row in rows:
            assert len({places[t.split()[0]][0] for t in row}) == 1  # and those of a row on one line
        n += 1


def test_long_and_deep_pages():
    assert page_text("<div>" * 50_000 + "deep" + "</div>" * 50_000) == "deep"
    assert page_text("<table><tr><td>" * 300 + "deep").split() == ["deep"]
    assert len(page_text("<p>word</p>" * 50_000)) == 50_000 * 6 - 2
    assert page_text("<" * 20_000) == "<" * 20_000
    rows = "".join(f"<tr><td>{'x' * 10_000 if i == 0 else 'y'}<td>z" for i in range(2000))
    assert len(page_text(f"<table>{rows}</table>")) < 300_000
    assert page_text(f"<table>{rows}</table>").count("x") == 10_000


def test_rows(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 6), (3, "<p>x", 7), (3, "<p>x", 7)], "page_id long, html string, n_chars int")
    got = extract_pages(df).collect()
    assert [(r.page_id, r.text, r.n_chars) for r in got] == [(1, "", 5), (2, "", 6), (3, "x", 7), (3, "x", 7)]
    assert extract_pages(df.limit(0)).collect() == []
