import pytest

from tieout.llm.html import extract_text, visible_text

CASES = {
    "": "", "plain text": "plain text", "a &amp; b &lt;c&gt; &nbsp;d": "a & b <c> \xa0d",
    "<p>one<p>two": "one\n\ntwo", "<div>a</div><div>b</div>c": "a\nb\nc", "a<br>b": "a\nb",
    "<b>bo</b>ld  and\n <i>it</i>": "bold and it",
    "<head><title>t</title><style>x</style></head><body>y<script>'</p>'</script>z</body>": "yz",
    "<p hidden>x</p><p style='DISPLAY : none'>x</p><div style='visibility:hidden'>x</div>y": "y",
    "<!-- a > b --><!doctype html>c": "c", "<ul><li>a<li>b<ul><li>c</ul></ul>d": "- a\n- b\n  - c\n\nd",
    "<ol start=9><li>a<li>b</ol>": "9. a\n10. b", "<pre>a\n  b\n\nc</pre>": "a\n  b\n\nc",
    "<table><tr><td>a<td>bbb<tr><td>cccc<td>d</table>": "a     bbb\ncccc  d",
    "<table><caption>t</caption><thead><tr><th colspan=2>wide<tbody><tr><td>a</td><td>b</td></tr></table>": "t\nwide\na  b",
    "<table><tr><td><table><tr><td>in<td>ner</table><td>out</table>": "in  ner  out",
    "<table><tr><td>a<br>b<td>c</table>": "a  c\nb", "<dl><dt>t<dd>d</dl>": "t\n  d",
    "x<img alt='pic'>y<input value=v><input type=hidden value=w>": "xpicyv", "a<unknown>b</unknown>": "ab",
    "<p>a<div>b": "a\n\nb", "</div></p>x": "x", "a < b <3": "a < b <3", "<a href='x>y'>l</a>": "l",
    "<p>unclosed <b": "unclosed", "<textarea> a\n<b></textarea>": " a\n<b>",
    "<table>note<tr><td>a</table>": "note\n\na", "<table><div>text</div><tr><td>a</table>b": "text\n\na\n\nb",
    "<table><tr>text<td>a<tr><td>b</table>": "text\n\na\nb", "<table><div>text<tr><td>a</table>": "text\n\na",
    "<table><tr><td>x</td></tr><table><tr><td>a</table>": "x\n\na", "<table><tbody><table><tr><td>a</table>": "a",
    "<table hidden>shown<tr><td>not</table>": "shown", "<table><tr><td>a<table>in<tr><td>b</table>c</table>": "ain\n\nb\n\nc",
    "<table><form><tr><td>a<td>b</form></table>": "a  b", "<table><template><tr><td>x</template><tr><td>a</table>": "a",
    "<table><colgroup>t<col><caption>c<td>a</table>": "t\n\nc\na",
    "<head><title>t</title>Hello<p>you": "Hello\n\nyou", "<head> <title>t</title> <canvas>x</canvas>y": "y",
    "<head><object>x</object>": "x", "a<head>b</head>": "ab",
    "a<svg><title>t</title><defs/><text>x</text><text>y</text><path d='M0'/></svg> b": "a x y b",
    "<svg><defs><text>x</text></defs></svg>a": "a", "<svg><defs><p>a": "a",
    "<math><mi>a</mi><mo>+</mo><mi>b</mi></math>": "a+b",
    "<select><option>a<option selected>b</select>c": "a\nb\nc",
    "<select><optgroup label=g><option>a<option label=b></select>": "g\na\nb",
    "<map>a<area></map>": "a", "<xmp><b>&amp;</xmp>": "<b>&amp;", "<object data=u>x</object>": "",
}


@pytest.mark.parametrize("html", CASES)
def test_rendering(html):
    assert visible_text(html) == CASES[html]


def test_deep_and_long_pages():
    assert visible_text("<div>" * 20_000 + "x") == "x"
    assert visible_text("<b>" * 20_000 + "x" + "</b>" * 20_000) == "x"
    assert "x" in visible_text("<table><tr><td>" * 300 + "x")
    assert len(visible_text("<p>word</p>" * 50_000).split()) == 50_000
    assert visible_text("<" * 5_000).count("<") == 5_000


def test_table_of_pages(spark):
    rows = [(1, "u", "<p>a"), (None, None, None), (2, "u", ""), (2, "u", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "url as text", "url as tag")
    got = sorted(map(tuple, extract_text(df).collect()), key=repr)
    assert got == sorted([(1, "u", "a"), (None, None, ""), (2, "u", ""), (2, "u", "")], key=repr)
    assert extract_text(df.limit(0)).count() == 0


def test_every_visible_word_of_the_given_pages(spark, folder):
    import re
    from html import unescape

    for r in spark.read.parquet(f"{folder}/pages.parquet").collect():
        bare = re.sub(r"(?s)<(script|style|head)\b.*?</\1>|<!--.*?-->", " ", r.html)
        text = visible_text(r.html)
        for word in unescape(re.sub(r"<[^>]*>", " ", bare)).split():
            assert word in text


TABLES = {
    "<table><tr><td rowspan=2>A<td>B1<td>C1<tr><td>B2<td>C2</table>": "A  B1  C1\n   B2  C2",
    "<table><tr><td>a<td rowspan=0>b<tr><td>cc<tr><td>d<td>e</table>": "a   b\ncc\nd      e",
    "<table><tbody><tr><td rowspan=9>a<td>b</tbody><tbody><tr><td>c<td>d</table>": "a  b\nc  d",
    "<table><tr><td rowspan=2 colspan=2>ab<td>c<tr><td>d<tr><td>e<td>f<td>g</table>": "ab    c\n      d\ne  f  g",
    "<table><tr><td>a<td>b<td rowspan=3>r<tr><td colspan=2>cd<tr><td>e<td>f<td>g</table>": "a  b  r\ncd\ne  f     g",
    f"<table><tr><td colspan={'9' * 5000}>a<td>b</table>": "a  b", "<table><tr><td colspan=2px>a<tr><td>b<td>c</table>": "a\nb  c",
    "<table><tr><td colspan=-1 rowspan=x>a<td colspan=''>b</table>": "a  b", "<table><tr><td colspan=0>a<td>b</table>": "a  b",
    "<table><tr><td rowspan=2>a<br>a2<td>b<tr><td>c</table>": "a   b\na2\n    c",
}


@pytest.mark.parametrize("html", TABLES)
def test_tables_with_spans(html):
    assert visible_text(html) == TABLES[html]


def plain_grid(groups):
    """The table model cell by cell."""
    out = []
    for rows in groups:
        taken = set()
        for y, cells in enumerate(rows):
            places, x = [], 0
            for across, down in cells:
                while (x, y) in taken:
                    x += 1
                places.append(x)
                taken |= {(x + i, y + j) for i in range(across) for j in range(down)}
                x += across
            out.append(places)
    return out


def test_grid_against_cell_by_cell():
    import random

    from tieout.llm.html import grid

    rng = random.Random(3)
    for _ in range(400):
        groups = []
        for _ in range(rng.randrange(3)):
            n = rng.randrange(1, 7)
            rows = [[(rng.choice([1, 1, 2, 3]), min(rng.choice([1, 1, 2, 4]), n - y)) for _ in range(rng.randrange(5))] for y in range(n)]
            groups.append(rows)
        assert grid(groups) == plain_grid(groups)


def test_hostile_attributes_and_nesting():
    import random

    rng = random.Random(5)
    values = ["1", "0", "-3", "9" * 4400, "1e9", "٣", "", " 7 ", "x", "65535", "&#57;", "+2", "2.5", "\x00"]
    for _ in range(300):
        cells = "".join(
            f"<{rng.choice(['td', 'th', 'tr', 'td', 'tbody', 'ol', 'li'])} {rng.choice(['colspan', 'rowspan', 'start', 'value'])}='{rng.choice(values)}'>w{i}"
            for i in range(12)
        )
        text = visible_text(f"<table>{cells}</table>")
        assert all(f"w{i}" in text for i in range(12))
    deep = visible_text("<table><tr><td>x" * 3_000 + "<td>y")
    assert deep.count("x") == 3_000 and deep.count("y") == 1
    wide = "<table><tr>" + "<td colspan=1000 rowspan=60000>c" * 3_000 + "<tr><td>e" * 500 + "</table>"
    text = visible_text(wide)
    assert text.count("c") == 3_000 and text.count("e") == 500 and len(text) < 5_000_000
