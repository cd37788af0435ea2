import time

import pytest

from sensorgrid.llm.html import extract_text, render

CASES = [
    ("<p>a<p>b", "a\n\nb"),
    ("plain &lt;text&gt; <unfinished", "plain <text> <unfinished"),
    ("<ul><li>x<li>y<ol start=3><li>q<li>r</ol></ul>tail", "- x\n- y\n  3. q\n  4. r\n\ntail"),
    ("<table><tr><th>Name<th>Qty<tr><td>apple<td>3<tr><td colspan=2>wide</table>end", "Name  | Qty\napple | 3\nwide\n\nend"),
    ("<table><tr><td rowspan=2>A<td>b<tr><td>c</table>", "A | b\n  | c"),
    ("<div style='display: none'>no</div>yes<script>if(a<b){'</p>'}</script><!-- <p>c</p> --> <i hidden>h</i>ok", "yes ok"),
    ("a <b>bold</b> <i> it</i>.<pre>\n x\n  y</pre>", "a bold it.\n\n x\n  y"),
    ("one<br>two<hr>three", "one\ntwo\n\nthree"),
    ("<h1>T</h1>text<div>in</div>out", "T\n\ntext\nin\nout"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\nd\nu\ne"),
    ("<a href='x>y'>link</a> <img alt='a picture'>", "link a picture"),
    ("x</p>y</div>z<!-- open", "x\n\ny z".replace(" ", "")),
    ("<table><tr><td>1<table><tr><td>in</table><td>2</table>", "1  | 2\nin |"),
    ("<textarea>a <b>\n c</textarea>", "a <b>\n c"),
    ("<nav>menu</nav><footer>&copy; foot</footer>", "menu\n© foot"),
    ("", ""),
    ("<svg><title>t</title><desc>d</desc><text>drawn</text></svg><math><mi>x</mi><annotation>tex</annotation></math>", "drawnx"),
    ("<input type=submit value=Send><input type=text value=typed>", "Send"),
    ("<p style='visibility:hidden'>no <b style='visibility: visible'>yes</b> no", "yes"),
    ("<style>.h, #i, p.k{display:none} @media print{.x{display:none}} .y{color:red}</style>"
     "<p class='a h'>no<p id=i>no<p class=k>no<div class=k>k</div><p class=x>x<p class=y>y", "k\n\nx\n\ny"),
    ("<details><summary>more</summary>inside</details><details open><summary>s</summary>in</details>", "more\ns\nin"),
    ("<div style='white-space: pre'> a\n  b</div>", " a\n  b"),
    ("<table><tr><td colspan=2>a long heading here<td>x<tr><td>1<td>2<td>3</table>", "a long heading here | x\n1 | 2               | 3"),
    ("<a title='x <b>bold</b> <i>end", "bold end"),
]


@pytest.mark.parametrize(("html", "text"), CASES)
def test_render(html, text):
    assert render(html)[1] == text


def test_title_and_depth():
    assert render("<head><title> A &amp;\n B </title></head><body>x")[:2] == ("A & B", "x")
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    assert render(deep)[1] == "deep"
    assert render("<ul><li>" * 3000 + "deep")[1].endswith("deep")
    inside = "<p hidden>SECRET</p><textarea>kept</textarea><table><tr><td>a<td>b<tr><td>cc<td>d</table>"
    assert render("<div>" * 10_000 + inside)[1] == render(inside)[1] == "kept\n\na  | b\ncc | d"
    assert render("<table><tr><td>" * 2000 + "deep")[1] == "deep"


@pytest.mark.parametrize("piece", ["<a ", "<a '", "<a x='", "<a x='\"", "<a '\">", "</a ", "<p", "<!-", "<b><i>", "</b>", "<li>", "<table>", "<td>", "&", "<style>", "<a x=''"])
def test_any_megabyte_in_linear_time(piece):
    """Twice the text takes about twice the time, and no text of a megabyte takes long."""
    many = 1_000_000 // len(piece) if len(piece) > 1 and piece[-1] != ">" else 20_000
    times = []
    for n in (many // 4, many):
        start = time.perf_counter()
        render(piece * n + "end")
        times.append(time.perf_counter() - start)
    assert times[1] < 8 and times[1] < 8 * times[0] + 0.3


def test_query_form(spark):
    rows = [(1, "<p>a", "t"), (1, "<p>a", "t"), (None, None, "t"), (2, "w " * 100_000, "t")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    out = sorted(((r.page_id, r.title, len(r.text), r.n_blocks) for r in extract_text(df).collect()), key=str)
    assert out == [(1, "", 1, 1), (1, "", 1, 1), (2, "", 199_999, 1), (None, "", 0, 0)]
    assert extract_text(df.limit(0)).collect() == []
