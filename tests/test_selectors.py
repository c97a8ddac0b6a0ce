"""Selectors on hand-made pages of the four sites, and on broken ones."""

import pytest
from pyspark.sql import functions as F

from issuewatch.operators import normalise, selectors

PAGES = {
    "dc": """<article>x</article><article><header><div><h3><span>[a]</span><span>T &amp; t</span></h3><div><div><span><em>me</em></span><span>2024.01.02 03:04:05</span></div>
      <div><span>조회 12</span><span>추천 3</span><span><a>댓글 2</a></span></div></div></div></header><div class="write_div">line<br>two</div></article>
      <ul class="cmt_list"><li class="ub-content"><div data-rcnt="1"><div class="cmt_nickbox"><span class="nickname"><em>c1</em></span></div><div class="cmt_txtbox"><img src=x></div>
      <div class="fr"><span class="date_time">01.02 04:00:00</span></div></div></li><li><ul><li class="ub-content"><div class="cmt_nickbox"><span class="nickname"><em>r1</em></span></div>
      <div class="cmt_txtbox"><p>re</p></div><div class="fr"><span class="date_time">01.02 05:00:00</span></div></li></ul></li>
      <li class="ub-content"><div><p>gone</p></div></li><li class="notice">not a comment</li></ul>""",
    "naver": """<div class="ArticleContentBox"><div class="article_header"><div><h3> N </h3></div></div><div class="article_container"><div class="profile_info"><i class="nickname">me</i></div>
      <div class="article_info"><span class="date">2024.07.05. 21:54</span><span class="count">조회 2,394</span></div><div class="article_viewer">body</div></div>
      <div class="ArticleTool"><b class="num">2</b></div><div class="like_article"><em class="u_cnt _count">1.2천</em></div>
      <ul class="comment_list"><li class="CommentItem"><div class="comment_box"><i class="comment_nickname">a</i><i class="comment_text_view">x</i><i class="comment_info_date">2024.07.05. 22:00</i></div></li>
      <li class="CommentItem CommentItem--reply"><div class="comment_box"><i class="comment_nickname">b</i><i class="comment_text_view">y</i><i class="comment_info_date">2024.07.05. 22:01</i></div></li></ul></div>""",
    "bobae": """<header class="article-tit"><div class="title">B (1)</div><div class="util"><time>24.08.20  13:05</time><span class="data3">추천 7</span><span class="data4">조회 99</span></div>
      <div class="util2"><div class="info"><span>me</span></div></div></header><div class="article-body">body</div><div class="commentListArea"><div class="cmtList">
      <dl><dt><span class="cmt_nickname">a</span><span class="date">24.08.20 14:00</span></dt><dd><p>x</p><div class="replyList"><dl><dt><span class="cmt_nickname">b</span>
      <span class="date">24.08.20 15:00</span></dt><dd><p>y</p></dd></dl></div></dd></dl></div></div>""",
    "clien": """<h3 class="post_subject">C</h3><span class="nickname">me</span><span class="view_count">1,234</span><a class="symph_count">2,001명</a>
      <div class="post_author"><span>2024-08-20 13:05:09 수정일 : 2024-08-20 14:00:00</span></div><div class="post_content">body</div>
      <div class="comment_row"><span class="nickname">a</span><i class="comment_symph">1,005</i><div class="comment_content">x</div><span class="timestamp">2024-08-20 13:06:00 / 수정일: 2024-08-20 13:07:00</span></div>
      <div class="comment_row blocked"><span class="nickname">b</span></div>""",
}


def post(name, html=None):
    return selectors.read_page(PAGES[name] if html is None else html, name, selectors._selectors())


def test_posts_of_the_four_sites():
    want = {
        "dc": ("T & t", "linetwo", "me", "2024.01.02 03:04:05", None, "12", "3", "2"),
        "naver": ("N", "body", "me", "2024.07.05. 21:54", None, "조회 2,394", "1.2천", "2"),
        "bobae": ("B (1)", "body", "me", "24.08.20 13:05", None, "99", "7", None),
        "clien": ("C", "body", "me", "2024-08-20 13:05:09", "2024-08-20 14:00:00", "1,234", "2,001명", None),
    }
    for name, fields in want.items():
        assert tuple(post(name).get(f) for f in selectors.POST_FIELDS) == fields


def test_comments_of_the_four_sites():
    got = {name: [(c["author"], c["content"], c["created_at"], [(r["author"], r["content"]) for r in c["children"]]) for c in post(name)["comments"]] for name in PAGES}
    assert got["dc"] == [("c1", " ", "01.02 04:00:00", [("r1", "re")]), (" ", "해당 댓글은 삭제되었습니다.", " ", [])]
    assert got["naver"] == [("a", "x", "2024.07.05. 22:00", [("b", "y")])]
    assert got["bobae"] == [("a", "x", "24.08.20 14:00", [("b", "y")])]
    assert got["clien"] == [("a", "x", "2024-08-20 13:06:00", [])]
    clien = post("clien")["comments"][0]
    assert (clien["modified_at"], clien["liked"]) == ("2024-08-20 13:07:00", "1005")


@pytest.mark.parametrize("html", ["", "<", "</div></p>", "<article>" * 3000, "<div class=write_div>", "<script>" + "<p>" * 50, "<!-- <h3 class='post_subject'>", "a" * 100_000])
def test_broken_pages_are_no_posts(html):
    for name in selectors.SITES:
        assert post(name, html) is None


def test_steps():
    page = selectors.Page('<div class="a b"><p>1<i>2</i></p><p class="c">3</p></div><p>4</p>')
    find = lambda s: [page.text(i) for i in page.all(selectors.compiled(s))]
    assert find("p") == ["12", "3", "4"] and find("div > p") == ["12", "3"] and find("div.b.a i") == ["2"] and find("div > i") == []
    assert find("p:2") == ["3"] and find(".a .c") == ["3"] and find("> p") == ["4"] and find("p i") == ["2"]


def test_pages_to_formatted_posts(spark):
    """Select, then the formatter: the crawled texts are what it takes."""
    rows = [(i, name, html) for i, (name, html) in enumerate(PAGES.items())] + [(8, "reddit", "<p>"), (9, "dc", None), (10, "naver", "<p>x")]
    pages = spark.createDataFrame(rows, "page_id long, data_source string, html string")
    selected = selectors.select_posts(pages)
    assert {r.page_id for r in selected.where("post is null").collect()} == {8, 9, 10}
    good, bad = normalise.normalise_posts(selectors.raw_posts(selected), F.lit("2024-09-01 00:00:00").cast("timestamp"))
    assert bad.count() == 0
    got = {r.data_source: r for r in good.collect()}
    assert {s: (r.viewed, r.liked, r.num_of_comments) for s, r in got.items()} == {"dc": (12, 3, 2), "naver": (2394, 1200, 2), "bobae": (99, 7, 1), "clien": (1234, 2001, 1)}
    assert got["clien"].comments[0].liked == "1005" and got["dc"].comments[0].children[0].content == "re"
    assert got["naver"].created_at == "2024-07-05 21:54:00"


def test_pages_of_a_batch_are_read_in_slices():
    import pyarrow as pa

    html = ["x" * n for n in (3, 4, 0, 20, 5, 5, 1)]
    batch = pa.record_batch([pa.array(html)], ["html"])
    cut = [[len(x) for x in some.column("html").to_pylist()] for some in selectors.slices(batch, "html", 10)]
    assert cut == [[3, 4, 0], [20], [5, 5], [1]]
    assert list(selectors.slices(batch.slice(0, 0), "html", 10)) == []
    assert [x.num_rows for x in selectors.slices(batch.slice(3), "html", 10)] == [1, 2, 1]
