"""Posts and comments of a page by its site's selectors.

A page is read once, tag by tag, into flat lists: each element's tag, classes, parent and
the range of text below it. A selector is a path of `tag.class` steps, joined by a blank
(below) or `>` (directly below); `:n` takes the n-th child of its tag. The rules of the
four sites are data; the work is done in Arrow batches, one row a page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .pages import BLOCKED_CLASS, DELETED_CONTENT, EMOTICON_CONTENT

_DC = "article header > div > div"
# Where each site keeps what. A list holds alternatives, the first that is
# found counts. `rows` are the comments; `reply` marks rows that are replies, `children`
# finds them inside a row, `next_children` inside the row behind it.
SITES: dict[str, dict] = {
    "dc": {
        "post": {
            "title": "article header > div > h3 > span:2",
            "content": "div.write_div",
            "author": f"{_DC} > div:1 > span:1 > em",
            "created_at": [f"{_DC} > div:1 > span:3", f"{_DC} > div:1 > span:2"],
            "viewed": f"{_DC} > div:2 > span:1",
            "liked": f"{_DC} > div:2 > span:2",
            "num_of_comments": f"{_DC} > div:2 > span:3 > a",
        },
        "labelled": ["viewed", "liked", "num_of_comments"],  # a label and a number
        "rows": "ul.cmt_list > li.ub-content",
        "comment": {"author": ".cmt_nickbox .nickname em", "content": ".cmt_txtbox p", "created_at": ".fr .date_time"},
        "count": ("div", "data-rcnt"),
        "next_children": "li",
    },
    "naver": {
        "post": {
            "title": ".ArticleContentBox > .article_header h3",
            "content": ".article_container .article_viewer",
            "author": ".profile_info .nickname",
            "created_at": ".article_info .date",
            "viewed": ".article_info .count",
            "liked": ".like_article .u_cnt._count",
            "num_of_comments": ".ArticleTool .num",
        },
        "rows": ".comment_list li",
        "comment": {"author": ".comment_box .comment_nickname", "content": ".comment_box .comment_text_view", "created_at": ".comment_box .comment_info_date"},
        "reply": "CommentItem--reply",
    },
    "bobae": {
        "post": {
            "title": "header.article-tit > div.title",
            "content": "div.article-body",
            "author": "header.article-tit > div.util2 > div.info > span",
            "created_at": "header.article-tit > div.util > time",
            "viewed": "header.article-tit > div.util > span.data4",
            "liked": "header.article-tit > div.util > span.data3",
        },
        "labelled": ["viewed", "liked"],
        "rows": "div.commentListArea > div.cmtList > dl",
        "comment": {"author": "dt > span.cmt_nickname", "content": "dd > p", "created_at": "dt > span.date"},
        "children": "dd > div.replyList > dl",
    },
    "clien": {
        "post": {
            "title": ".post_subject",
            "content": ".post_content",
            "author": ".nickname",
            "created_at": ".post_author > span",
            "viewed": ".view_count",
            "liked": ".symph_count",
        },
        "modified": ("수정일 :", "/ 수정일:"),  # between the times of a post, of a comment
        "rows": ".comment_row",
        "comment": {"author": ".nickname", "content": ".comment_content", "liked": ".comment_symph", "created_at": "span.timestamp"},
    },
}
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())  # fixed value: tags without an end
POST_FIELDS = ("title", "content", "author", "created_at", "modified_at", "viewed", "liked", "num_of_comments")
COMMENT_FIELDS = ("author", "content", "created_at", "modified_at", "liked", "num_of_comments")

_STEP = re.compile(r"(>)?\s*([a-z0-9]+)?((?:\.[\w-]+)*)(?::(\d+))?")
_REPLY = pa.struct([(f, pa.string()) for f in ("author", "content", "created_at")])
_COMMENT = pa.struct([*((f, pa.string()) for f in COMMENT_FIELDS), ("children", pa.list_(_REPLY))])
_POST = pa.struct([*((f, pa.string()) for f in POST_FIELDS), ("comments", pa.list_(_COMMENT))])
_REPLY_DDL = "struct<author:string,content:string,created_at:string>"
_COMMENT_DDL = f"struct<{','.join(f'{f}:string' for f in COMMENT_FIELDS)},children:array<{_REPLY_DDL}>>"
POST_DDL = f"struct<{','.join(f'{f}:string' for f in POST_FIELDS)},comments:array<{_COMMENT_DDL}>>"


class Page(HTMLParser):
    """The elements of a page in order; number 0 is the page itself."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.tags, self.classes, self.attrs = [""], [frozenset()], [{}]
        self.parent, self.last = [-1], [0]  # the element's parent, the last element below it
        self.begin, self.end = [0], [0]  # its pieces of text
        self.nth = [0]  # its place among its parent's children of the same tag
        self.pieces: list[str] = []
        self._open, self._seen = [0], [{}]
        self.feed(html)
        self.close()
        while self._open:
            self._leave()

    def _leave(self) -> None:
        at = self._open.pop()
        self._seen.pop()
        self.last[at], self.end[at] = len(self.tags) - 1, len(self.pieces)

    def handle_starttag(self, tag, attrs):
        seen = self._seen[-1]
        seen[tag] = seen.get(tag, 0) + 1
        values = {k: v or "" for k, v in attrs}
        self.tags.append(tag)
        self.classes.append(frozenset(values.get("class", "").split()))
        self.attrs.append(values)
        self.parent.append(self._open[-1])
        self.nth.append(seen[tag])
        self.begin.append(len(self.pieces))
        self.last.append(len(self.tags) - 1)
        self.end.append(len(self.pieces))
        if tag not in VOID:
            self._open.append(len(self.tags) - 1)
            self._seen.append({})

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._leave()

    def handle_endtag(self, tag):
        if tag in VOID or all(self.tags[i] != tag for i in self._open[-64:]):
            return  # an end without a start
        while self.tags[self._open[-1]] != tag:
            self._leave()
        self._leave()

    def handle_data(self, data):
        if self.tags[self._open[-1]] not in ("script", "style"):
            self.pieces.append(data)

    def text(self, at: int) -> str:
        return " ".join("".join(self.pieces[self.begin[at] : self.end[at]]).split())

    def _fits(self, at: int, step: tuple) -> bool:
        _, tag, classes, nth = step
        return (not tag or self.tags[at] == tag) and classes <= self.classes[at] and (not nth or self.nth[at] == nth)

    def _matches(self, at: int, steps: tuple, scope: int) -> bool:
        if not self._fits(at, steps[-1]):
            return False
        if len(steps) == 1:
            return not steps[0][0] or self.parent[at] == scope
        up = self.parent[at]
        while up > scope:
            if self._matches(up, steps[:-1], scope):
                return True
            if steps[-1][0]:
                return False
            up = self.parent[up]
        return False

    def all(self, steps: tuple, scope: int = 0) -> list[int]:
        """The elements below `scope` that a path fits, in page order."""
        return [i for i in range(scope + 1, self.last[scope] + 1) if self._matches(i, steps, scope)]

    def first(self, steps: tuple, scope: int = 0) -> int | None:
        return next((i for i in range(scope + 1, self.last[scope] + 1) if self._matches(i, steps, scope)), None)


def compiled(selector: str) -> tuple:
    """The steps of a selector: (directly below, tag, classes, n-th)."""
    found = [m for m in _STEP.finditer(selector) if m.group(2) or m.group(3)]
    return tuple((bool(m.group(1)), m.group(2) or "", frozenset(m.group(3).split(".")[1:]), int(m.group(4) or 0)) for m in found)


def _field(page: Page, rule: str | list[str], paths: dict, scope: int = 0) -> str | None:
    for selector in [rule] if isinstance(rule, str) else rule:
        at = page.first(paths[selector], scope)
        if at is not None:
            return page.text(at)
    return None


def _comment(page: Page, at: int, site: dict, paths: dict) -> dict | None:
    """H3: a comment without author or time is a deleted one, one without content an emoticon."""
    found = {f: _field(page, rule, paths, at) for f, rule in site["comment"].items()}
    if found["author"] is None or found["created_at"] is None:
        return {"author": " ", "content": DELETED_CONTENT, "created_at": " "}
    return found | {"content": found["content"] if found["content"] is not None else EMOTICON_CONTENT}


def _comments(page: Page, site: dict, paths: dict) -> list[dict]:
    out: list[dict] = []
    for at in page.all(paths[site["rows"]]):
        if BLOCKED_CLASS in page.classes[at]:
            continue
        found = _comment(page, at, site, paths)
        if "reply" in site and site["reply"] in page.classes[at] and out:
            out[-1]["children"].append(found)
            continue
        children: list[dict] = []
        if "children" in site:
            children = [_comment(page, i, site, paths) for i in page.all(paths[site["children"]], at)]
        if "count" in site:
            tag, attr = site["count"]
            box = page.first(paths[tag], at)
            count = page.attrs[box].get(attr, "0") if box is not None else "0"
            behind = page.last[at] + 1
            if count.isdigit() and int(count) > 0 and behind < len(page.tags) and page.tags[behind] == "li":
                children = [_comment(page, i, site, paths) for i in page.all(paths[site["next_children"]], behind)]
        if "modified" in site:
            created, _, modified = found["created_at"].partition(site["modified"][1])
            found |= {"created_at": created.strip(), "modified_at": modified.strip() or created.strip(), "liked": (found.get("liked") or "0").replace(",", "")}
        out.append(found | {"children": children})
    for c in out:
        c["num_of_comments"] = str(len(c["children"]))
    return out


def read_page(html: str, name: str, paths: dict[str, tuple]) -> dict | None:
    """The post of a page, or None if a required field (title, content, author) is missing."""
    site, page = SITES[name], Page(html)
    post = {f: _field(page, rule, paths) for f, rule in site["post"].items()}
    if any(post[f] is None for f in ("title", "content", "author")):
        return None
    for f in site.get("labelled", ()):
        parts = (post[f] or "").split()
        post[f] = parts[1] if len(parts) > 1 else None
    if "modified" in site and post["created_at"] is not None:
        created, _, modified = post["created_at"].partition(site["modified"][0])
        post |= {"created_at": created.strip(), "modified_at": modified.strip() or created.strip()}
    return post | {"comments": _comments(page, site, paths)}


def _selectors() -> dict[str, tuple]:
    rules = [r for s in SITES.values() for r in (*s["post"].values(), *s["comment"].values(), s["rows"], s.get("children"), s.get("next_children"), s.get("count", (None,))[0])]
    flat = [x for r in rules if r for x in ([r] if isinstance(r, str) else r)]
    return {x: compiled(x) for x in flat}


#: Bytes of html whose posts are held as Python objects at once; a longer page is alone.
SLICE_BYTES = 1 << 20


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, cut where the texts of `column` would pass `most` bytes."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy().astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def select_posts(pages: DataFrame, html: str | Column = "html", source: str = "data_source") -> DataFrame:
    """`pages` without the html and with `post`: the fields of `POST_FIELDS` as their site's
    text and the nested comments, in page order. `post` is null for a page of an unknown
    site or one that lacks title, content or author; those rows are the quarantine. A null
    page counts as empty."""
    column = F.col(html) if isinstance(html, str) else html
    rest = [c for c in pages.columns if c != html]
    rows = pages.select(F.struct(*rest).alias("row"), F.coalesce(column, F.lit("")).alias("html"), F.col(source).alias("site"))
    paths = _selectors()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "html", SLICE_BYTES):
                sites = some.column("site").to_pylist()
                posts = [read_page(h.as_py(), s, paths) if s in SITES else None for h, s in zip(some.column("html"), sites, strict=True)]
                yield pa.RecordBatch.from_arrays([some.column("row"), pa.array(posts, _POST)], ["row", "post"])

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, post {POST_DDL}").select("row.*", "post")


def raw_posts(selected: DataFrame) -> DataFrame:
    """The posts of `select_posts` as the crawlers write them: flat text columns, comments as JSON
    text, so `normalise_posts` takes them."""
    rest = [c for c in selected.columns if c != "post"]
    good = selected.where(F.col("post").isNotNull())
    return good.select(*rest, *[f"post.{f}" for f in POST_FIELDS], F.to_json("post.comments").alias("comments"))
