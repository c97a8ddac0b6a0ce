import pytest

from issuewatch.llm import html
from issuewatch.llm.queries import QUERIES

CASES = [
    ("", ""),
    ("just text", "just text"),
    ("<p>a<p>b<div>c", "a\nb\nc"),
    ("<table><tr><td>x<td>y<tr><td>z</table>", "x\ny\nz"),
    ("<ul><li>one<li>two</ul>", "one\ntwo"),
    ("<body><p>a &lt;b&gt; &nbsp; c</p><!-- x <p>y --><script>if(a<b){\"</p>\"}</script><p>d &am; &eacute;</p></body>", "a <b> c\nd &am; é"),
    ("<article><header><h1>T</h1></header><p>body <i>it</i>al<br>x</p><footer>f</footer></article><p", "T\nbody ital x"),
    ("<body><header>H</header><nav>n</nav><main><p>x</p><div class='ad'>a</div></main><footer>f</footer></body>", "x"),
    ("<div class=post><p>The main text of this page.</p></div><div id=comments><p>a reader wrote this long comment below it</p></div>", "The main text of this page."),
    ("<div class='layout has-sidebar'><article><p>inside the frame</p></article></div><form><label>q</label></form>", "inside the frame"),
    ("<body><p>cut off <b", "cut off"),
    ("</div></p><p>stray</p></b>", "stray"),
    # heading, lead and second part beside the body's container
    ("<div class=post><h1>Head</h1><p>The lead.</p><div class=body><p>" + "long text " * 30 + "</p></div></div>", "Head\nThe lead.\n" + ("long text " * 30).strip()),
    ("<main><div class=lead>A lead of some words.</div><article><p>" + "long text " * 9 + "</p></article></main>", "A lead of some words.\n" + ("long text " * 9).strip()),
    ("<body><h1>Head</h1>direct <i>words</i><div class=body><p>" + "long text " * 30 + "</p></div><ul><li><a href=x>more</a></ul></body>", "Head\ndirect words\n" + ("long text " * 30).strip()),
    ("<div class=page><div class=t><h1>Head</h1></div><div class=body><p>" + "long text " * 30 + "</p></div><div class=box>unmarked</div></div>", "Head\n" + ("long text " * 30).strip()),
    ("<body><div class=body><p>" + "long text " * 30 + "</p></div><div class=sidebar><h2>side</h2></div><p class=ad>buy</p></body>", ("long text " * 30).strip()),
]


@pytest.mark.parametrize(("source", "expected"), CASES)
def test_single_pages(source, expected):
    assert html.extract(html.parse(source), []) == expected


def test_host_consensus_wins_over_a_page_of_its_own(spark):
    good = "<body><div class='story-{0}'><p>{1}</p></div><div class='box'>unmarked junk</div></body>"
    rows = [(i, "http://www.Site.example/a", good.format(i, "a long and proper story text " * 5)) for i in range(9)]
    rows.append((9, "https://site.example:80/b?x", good.format(9, "short")))
    rows += [(10, None, None), (11, None, ""), (12, "nonsense", "<p>alone</p>")]
    rows.append(rows[0])
    pages = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "page_id long, url string, html string, host string, path string, n int")
    got = {r["page_id"]: r for r in html.extract_main_text(pages).collect()}
    assert got[9]["text"] == "short" and got[9]["n_chars"] == 5
    assert got[0]["text"] == ("a long and proper story text " * 5).strip()
    assert got[10]["text"] == "" and got[11]["text"] == "" and got[12]["text"] == "alone"
    assert html.extract_main_text(pages).count() == 14
    assert html.extract_main_text(pages.limit(0)).count() == 0


def test_query_returns_every_page(spark):
    found = QUERIES["op7_html_extract"](spark, "/root/testdata/sf0.001")
    rows = found.collect()
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count()
    assert all(r["n_chars"] == len(r["text"]) > 0 and "<p>" not in r["text"] for r in rows)


def test_long_page_and_quotes():
    source = "<article>" + "<p>para > one \"x\"</p>" * 20_000 + "<a title='a>b'>link</a></article>"
    text = html.extract(html.parse(source), [])
    assert text.count("\n") == 20_000 and text.endswith("link")


def test_very_deep_pages():
    """Memory and time in proportion to the depth: paths are hashes, built as text for one element only."""
    text = html.extract(html.parse("<div class=a>" * 200_000 + "deep"), [])
    assert text == "deep"
    source = "<article><p>x" + "<span>" * 100_000 + "y"
    assert html.extract(html.parse(source), ["#root/article"]) == "xy"
