"""HTML rendering: cases typed in, and visible words against an independent walk."""

import random
import time
from html.parser import HTMLParser

import pytest

from conftest import SF_SMALL
from kestrel.llm import html as H
from kestrel.llm import queries


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("plain", "plain"), ("a &amp; b &copy; &nope;", "a & b © &nope;"),
    ("<p>one<p>two", "one\n\ntwo"), ("<div>a</div><div>b</div>c", "a\nb\nc"), ("a<br>b<br/>c</br>d", "a\nb\nc\nd"),
    ("<p>a  <b> b</b>\n c</p>", "a b c"), ("x<!-- no --><![CDATA[no]]><?no?>y", "xy"),
    ("<title>no</title><style>no</style><script>if (a<b) '</p>'</script>yes", "yes"),
    ("<head><title>no</title></head><body>yes</body>", "yes"), ("<div hidden>no</div>yes", "yes"),
    ("<p style='color: red; DISPLAY : none'>no</p>yes", "yes"), ('<p data-x="hidden">yes', "yes"),
    ("<p title='a > b'>yes", "yes"), ("<template>no<p>no</template>yes", "yes"), ("<noscript>no</noscript>yes", "yes"),
    ("<details><summary>s</summary>no</details>", "s"), ("<details open><summary>s</summary>yes</details>", "s\nyes"),
    ("<dialog>no</dialog><dialog open>yes</dialog>", "yes"),
    ("<ul><li>a<li>b</ul>c", "- a\n- b\n\nc"), ("<ol start=9><li>a<li>b</ol>", "9. a\n10. b"),
    ("<ul><li>a<ol><li>x<li>y</ol><li>b</ul>", "- a\n  1. x\n  2. y\n- b"), ("<ul><li>a<br>b</ul>", "- a\n  b"),
    ("<dl><dt>t<dd>d<dt>u</dl>", "t\n  d\nu"), ("<blockquote>a<br>b</blockquote>c", "> a\n> b\n\nc"),
    ("<pre>\n a  b\n\tc\n</pre>d", " a  b\n        c\n\nd"), ("a<hr>b", "a\n\n---\n\nb"),
    ("<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>", "a   | bb\nccc | d"),
    ("<table><tr><th colspan=2>wide<tr><td>a<td>b</table>", "wide\na | b"),
    ("<table><tr><td rowspan=2>r<td>1<tr><td>2</table>", "r | 1\n  | 2"),
    ("<table><td>a<table><tr><td>x<td>y</table></table>", "a\n\nx | y"), ("<table><caption>t</caption><tr><td>a</table>b", "t\n\na\n\nb"),
    ("</p></div></b>x</table>", "x"), ("<b><p>a</b>b</p>", "ab"), ("<p>a<table><tr><td>b</table>", "a\n\nb"),
    ("<h1>a<h2>b", "a\n\nb"), ("<textarea>a &lt; b</textarea>", "a < b"), ("<select><option>one<option>no</select>yes", "one yes"),
    ("a &lt;p&gt; b", "a <p> b"), ("a < b > c", "a < b > c"), ("<p", "<p"), ("<unknown-tag x=1>y</unknown-tag>z", "yz"),
    ("a&nbsp; b", "a  b"), ("<p>a</p>\n\n<p>b</p>", "a\n\nb"), ("<li>alone", "- alone"), ("<td>alone</td>x", "alone\nx")])
def test_cases(page, want):
    assert H.to_text(page) == want


@pytest.mark.parametrize("page, want", [
    ("a <math><mi>x</mi><mo>=</mo><mn>2</mn></math> b", "a x=2 b"),
    ("<math><semantics><mi>y</mi><annotation encoding='TeX'>no</annotation></semantics></math>", "y"),
    ("<math><semantics><mi>y</mi><annotation-xml>no<mi>no</mi></annotation-xml></semantics></math>z", "yz"),
    ("<svg><title>no</title><desc>no</desc><defs><text>no</text></defs><metadata>no</metadata><text>one</text></svg>two", "one\ntwo"),
    ("<svg><text>one</text><text>two</text></svg>", "one\ntwo"), ("<svg><style>no</style><g><text>a<tspan>b</tspan></text></g></svg>c", "ab\nc"),
    ("<svg><path d='M0'/><circle r=1 /><text>t</text></svg>u", "t\nu"), ("<svg/>x", "x"),
    ("<svg><defs/><text>t</text></svg>u", "t\nu"), ("<math><mspace/><mi>k</mi></math>", "k"), ("<desc>yes</desc>", "yes"),
    ("<svg><title/><text>t</text></svg>u", "t\nu"), ("<svg><g display=none><text>no</text></g></svg>u", "u"),
    ("<p display=none>yes <svg><path d='M0'/></svg> <text>here</text> too", "yes here too")])
def test_formulas_and_diagrams(page, want):
    assert H.to_text(page) == want


@pytest.mark.parametrize("page, want", [
    ('<p>a</p><p class=x">Hello</p>', "a\n\nHello"), ("<a title=it's>Hello</a>", "Hello"), ('<a title="it\'s > b" x>Hello</a>', "Hello"),
    ('<p "quoted" name>x', "x"), ("<p a='1'b=\"2\">x", "x"), ('<p a=">" b = \'>\' c>x', "x"), ("<p a= 'x>y' =z>x", "x"), ("<p =>x", "x"),
    ('<p a="never closed>x</p>', "x"), ("<br/class='>'>x", "x"), ("<p / a / b=c/>x", "x"), ("<p a=b'c>x", "x"), ("<p\n\ta\n=\n'>'\n>x", "x"),
    ("<!--> visible -->", "visible -->"), ("<!---> visible", "visible"), ("a<!-- no --!>b", "ab"), ("a<!-- no -- no > no -->b", "ab"),
    ("a<!--->b<!-- -->c", "abc"), ("a<!>b", "ab"), ("a</>b", "ab"), ("a</ no>b", "ab"),
    ("<div style='visibility:hidden'>no<p style='visibility: visible'>yes<b style='visibility:hidden'>no<i>no</i></b></p>no</div>z", "yes\n\nz"),
    ("<ul style='visibility:hidden'><li>no<li style='visibility:visible'>yes</ul>", "- yes"),
    ("<pre style='visibility:hidden'>no<b style='visibility:visible'>yes</b></pre>", "yes"), ("<p style='display:none;display:block'>yes", "yes"),
    ("<p style='display:none'><b style='visibility:visible'>no</b></p>yes", "yes"), ("<hr style='visibility:collapse'>yes", "yes"),
    ("<ol><li>a<li value=7>b<li>c</ol>", "1. a\n7. b\n8. c"), ("<ol start=3><li value=x>a<li value=-2>b<li>c</ol>", "3. a\n-2. b\n-1. c"),
    ("a<select><option>x<option selected>y<option>z</select>b", "a y b"), ("<select><option disabled>x<option>y</select>", "y"),
    ("<select><optgroup label=g><option>x<optgroup><option selected>y</select>", "y"), ("a<select></select>b", "a b"),
    ("a<select multiple><option>x<option>y</select>b", "a\nx\ny\nb"), ("<select size=3><option hidden>x<option>y<option label=l>z</select>", "y\nl"),
    ("<datalist><option>no</datalist>yes", "yes"), ("<select><option selected>x</option><option selected>y</select>", "y")])
def test_broken_and_rare_markup(page, want):
    assert H.to_text(page) == want


def test_random_broken_markup_shows_all_words_and_no_markup():
    rng = random.Random(8)
    silent = ["<!-->", "<!--->", "<!-- <p>q</p> -->", "<!-- a -- b --!>", "<!x>", "</>", "</ q>", "<?q ?>", "</b>", "</table>", "<br>", "<hr hidden>",
              "<script>q<p>'\"</script>", "<style>q</style>", "<p hidden>q</p>", "<div style='display:none'>q<b>q</b></div>", "<textarea></textarea>",
              "<template>q</template>", "<b style='visibility:hidden'>q</b>", "<input value='q'>", "<img alt=\"q>q\">"]
    attributes = ["", " a", " a=b", " a='b'", ' a="b"', " a=b'", ' a=b"', " a='\">'", ' a="\'>"', " 'a", ' "', " =", " = x", "/", " a =\n'q>'", " a='1'b=2"]
    tags = ["p", "b", "i", "div", "span", "a", "ul", "li", "h2", "td", "tr", "table", "em", "section", "dd", "font", "x-y"]
    for _ in range(400):
        page, words = [], []
        for k in range(rng.randrange(1, 25)):
            kind = rng.random()
            if kind < 0.4:
                words.append(f"w{k}")
                page.append(f" w{k} ")
            elif kind < 0.6:
                page.append(rng.choice(silent))
            elif kind < 0.85:
                page.append(f"<{rng.choice(tags)}{rng.choice(attributes)}{rng.choice(attributes)}>")
            else:
                page.append(f"</{rng.choice(tags)}{rng.choice(['', ' ', ' a=b', '/'])}>")
        shown = [w for w in H.to_text("".join(page)).replace("|", " ").split() if w not in ("-", "---")]
        # a table's cells come out by rows, all else in order
        assert sorted(shown) == sorted(words), "".join(page)
        if "table" not in "".join(page):
            assert shown == words, "".join(page)


def test_tags_are_found_in_linear_time():
    for page in ("<p " * 60_000, "<p a=" * 60_000, "<p a='" * 60_000, "<a " + "b = " * 90_000 + ">x", "<p " + "a" * 400_000, "<!--" * 60_000, "<" * 200_000, "<p a='>' " * 40_000):
        began = time.time()
        H.to_text(page)
        assert time.time() - began < 10


def test_deep_and_long_pages():
    assert H.to_text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert H.to_text("<ul><li>" * 200 + "deep").endswith("deep")
    assert len(H.to_text("<p>word " * 50_000).split()) == 50_000


class Words(HTMLParser):
    """All words outside of head, scripts and styles."""

    def __init__(self):
        super().__init__()
        self.skip, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("head", "script", "style")
        if tag in ("p", "div", "li", "td", "br", "h1", "nav", "article", "footer"):
            self.out.append(" ")

    def handle_endtag(self, tag):
        self.skip -= tag in ("head", "script", "style")
        if tag in ("p", "div", "li", "td", "h1", "nav", "article", "footer"):
            self.out.append(" ")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


def test_pages_keep_every_visible_word(spark):
    got = {r["page_id"]: r for r in queries.op8_html(spark, SF_SMALL).collect()}
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    assert len(got) == len(pages)
    for r in pages:
        walk = Words()
        walk.feed(r["html"])
        shown = [w for w in got[r["page_id"]]["text"].split() if w != "-"]
        assert shown == [w for w in "".join(walk.out).split() if w != "-"]
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])


def test_awkward_rows(spark):
    df = spark.createDataFrame([(None, None, "u"), (1, "", "u"), (1, "<p>x", "u"), (1, "<p>x", "u")],
                               "page_id long, html string, text string")
    got = H.extract(df)
    assert got.columns == ["page_id", "text"]
    assert sorted(r["text"] for r in got.collect()) == ["", "", "x", "x"]
    assert H.page_texts(df.limit(0)).count() == 0
