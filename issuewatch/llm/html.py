"""Main text of web pages by consensus of a host's pages.

Every page's containers are scored by the share of the page's text that they hold, menus
and other side matter left out; the deepest container with most of it gets the page's
vote, under its generalised path of tags and classes. Spark adds the votes up per host,
and each page is extracted again from the containers on its host's winning paths, so
that a short or odd page follows the layout that its host's pages agree on. What belongs
to the article but stands beside the winning container, such as a heading or a lead
above it, is taken from the containers around it (`beside`).
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

# HTML's element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup"
    " time tt u var wbr".split()
)
#: Elements that never hold main text.
SIDE_TAGS = frozenset(
    "script style noscript template svg math iframe object embed applet head title nav footer aside form button input select textarea option"
    " datalist menu dialog audio video canvas map xmp noembed noframes".split()
)
#: Words of a class, an id or a role that mark side matter.
SIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion sidebar rail menu nav navbar navigation"
    " breadcrumb breadcrumbs footer masthead comment comments commentlist disqus reply replies respond discussion cookie cookies consent gdpr notice"
    " notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations"
    " toolbar widget widgets pagination pager skip hidden contentinfo complementary search paywall feedback topbar toc".split()
)
#: Opening one of these closes an open element of the second kind.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: Elements that hold text of their own, other than boxes that hold such elements.
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure figcaption address hr details summary center hgroup".split())
#: A container that holds this share of the page's text, in percent, is the page's choice.
COVER = 75
#: An article or main element of at least this share is preferred.
ARTICLE_COVER = 25
#: Of nested ones the innermost with this share of the outer one, in percent.
NARROW = 60
#: A path wins on a host if it has this share of its pages' votes, in percent.
WIN = 20

#: Hosts up to this count have their paths broadcast (some hundred bytes each), so that no
#: page is shuffled; more are joined by a shuffle, where AQE splits a hot host.
MAX_BROADCAST_HOSTS = 100_000

_TOKEN = re.compile(r"""<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|$)""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_NUMBERS = re.compile(r"[0-9a-f]{8,}|\d+")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def path_key(steps: list[str], key: int = 0) -> int:
    """The hash of a path, from the hash of its beginning."""
    for step in steps:
        key = xxhash.xxh64_intdigest(step.encode("utf-8", "surrogatepass"), key)
    return key


@dataclass
class Page:
    """A page as parallel arrays of its elements, and its text pieces in page order."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    step: list[str] = field(default_factory=list)  # tag and generalised classes
    key: list[int] = field(default_factory=list)  # hash of the path, the steps from the root on
    side: list[bool] = field(default_factory=list)  # by its tag or names
    by_name: list[bool] = field(default_factory=list)
    pieces: list[tuple[int, int, str]] = field(default_factory=list)  # (element, block, text)

    def open(self, tag: str, parent: int, attributes: str) -> int:
        names = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)} if "=" in attributes else {}
        words = {w.lower() for k in ("class", "id", "role") for w in _NAME_PARTS.findall(names.get(k, ""))}
        marked = bool(words & SIDE_WORDS) or names.get("aria-hidden") == "true"
        inside = tag == "header" and not any(self.tag[e] in ("article", "main") for e in self.up(parent))
        first = _NUMBERS.sub("#", " ".join(sorted(names.get("class", "").split()))).replace("/", "#")
        self.tag.append(tag)
        self.parent.append(parent)
        self.step.append(tag + ("." + first if first else ""))
        self.key.append(path_key(self.step[-1:], self.key[parent] if parent >= 0 else 0))
        self.side.append(tag in SIDE_TAGS or inside)
        self.by_name.append(marked and tag not in ("html", "body"))
        return len(self.tag) - 1

    def path(self, element: int) -> str:
        """The path as text; only built for chosen elements, as it grows with the depth."""
        return "/".join(self.step[e] for e in [*self.up(element)][::-1])

    def up(self, element: int) -> Iterator[int]:
        while element >= 0:
            yield element
            element = self.parent[element]


def parse(source: str) -> Page:
    """The elements and text pieces of a page, with unclosed, stray and cut-off tags."""
    page = Page()
    at = page.open("#root", -1, "")
    block, pos, size = 0, 0, len(source)
    while pos < size:
        m = _TOKEN.search(source, pos)
        text = source[pos : m.start()] if m else source[pos:]
        if text:
            page.pieces.append((at, block, entities.unescape(text)))
        if not m:
            break
        pos = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if tag not in INLINE:
            block += 1
        elif tag == "br":
            page.pieces.append((at, block, " "))
        if m[1]:
            up = at
            while up > 0 and page.tag[up] != tag:
                up = page.parent[up]
            if up > 0:
                at = page.parent[up]
            continue
        if tag in VOID or m[3].endswith("/") and tag not in RAW:
            continue
        if tag not in INLINE:
            at = _close_paragraph(page, at)
        for kinds in (CLOSES.get(tag),):
            if kinds:
                at = _close(page, at, kinds)
        new = page.open(tag, at, m[3])
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, pos)
            pos = end.end() if end else size
            continue
        at = new
    return page


def _close_paragraph(page: Page, at: int) -> int:
    """Where a block element opens: out of an open p, through inline elements only."""
    for up in page.up(at):
        if page.tag[up] == "p":
            return page.parent[up]
        if page.tag[up] not in INLINE:
            break
    return at


def _close(page: Page, at: int, kinds: tuple[str, ...]) -> int:
    """Out of an open element of `kinds` within the same list, table row or so."""
    for up in page.up(at):
        if page.tag[up] in kinds:
            return page.parent[up]
        if page.tag[up] in ("ul", "ol", "dl", "table", "select", "div", "section", "article", "body"):
            break
    return at


def side_matter(page: Page) -> list[bool]:
    """For each element whether it, or one around it, is side matter.

    Names mark side matter, but for a frame that holds nearly all text, the article or the
    main heading ("layout with-sidebar").
    """
    size = [0] * len(page.tag)
    body = [False] * len(page.tag)
    for element, _, text in page.pieces:
        size[element] += len(text.strip())
    for e in range(len(page.tag) - 1, 0, -1):
        up = page.parent[e]
        size[up] += size[e] * (not page.side[e])
        body[up] |= body[e] or page.tag[e] in ("main", "h1") or page.tag[e] == "article" and not page.by_name[e]
    out = []
    for e in range(len(page.tag)):
        named = page.by_name[e] and not body[e] and 100 * size[e] < 95 * size[0]
        out.append(page.side[e] or named or (page.parent[e] >= 0 and out[page.parent[e]]))
    return out


def weights(page: Page, side: list[bool]) -> tuple[list[int], list[int]]:
    """For each element the characters of text below it, and those of them in links, without side matter."""
    size, links = [0] * len(page.tag), [0] * len(page.tag)
    linked: list[bool] = []
    for e, tag in enumerate(page.tag):
        linked.append(tag == "a" or (page.parent[e] >= 0 and linked[page.parent[e]]))
    for element, _, text in page.pieces:
        if not side[element]:
            n = len(text.strip())
            size[element] += n
            links[element] += n * linked[element]
    for e in range(len(page.tag) - 1, 0, -1):
        size[page.parent[e]] += size[e]
        links[page.parent[e]] += links[e]
    return size, links


def vote(page: Page) -> str | None:
    """The path of the page's main container; None for a page without main text."""
    side = side_matter(page)
    score = [s - x for s, x in zip(*weights(page, side), strict=True)]
    if score[0] <= 0:
        return None
    boxes = [e for e in range(1, len(page.tag)) if not side[e] and page.tag[e] not in INLINE and page.tag[e] not in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li")]
    named = [e for e in boxes if page.tag[e] in ("article", "main") and 100 * score[e] >= ARTICLE_COVER * score[0]]
    if named:
        most = max(score[e] for e in named)
        return page.path(max(e for e in named if 100 * score[e] >= NARROW * most))
    wide = [e for e in boxes if 100 * score[e] >= COVER * score[0]]
    return page.path(wide[-1] if wide else 0)


def beside(page: Page, side: list[bool], chosen: list[int]) -> tuple[set[int], set[int]]:
    """The elements around, and those beside the chosen containers that belong to the article.

    Going up from a container to the body, an element beside it belongs to the article if it
    is no side matter, its text is not mostly links, and it holds text of its own (a heading,
    a paragraph, a list), or a heading of first rank, or stands in an article or main
    element. Other boxes are left out: nothing tells them from unmarked side matter. The
    elements passed on the way up count for the text that stands in them directly."""
    children: dict[int, list[int]] = {}
    around, tops = set(), set(chosen)
    for e in chosen:
        up = page.parent[e]
        while up > 0 and page.tag[up] != "html" and up not in around:
            around.add(up)
            up = page.parent[up]
    if not around:
        return around, set()
    size, links = weights(page, side)
    headed = [False] * len(page.tag)
    for e in range(len(page.tag) - 1, 0, -1):
        headed[e] |= page.tag[e] == "h1" and not side[e]
        headed[page.parent[e]] |= headed[e]
        if page.parent[e] in around and e not in around and e not in tops:
            children.setdefault(page.parent[e], []).append(e)
    found = set()
    for up, some in children.items():
        wide = page.tag[up] in ("article", "main")
        for e in some:
            fits = wide or headed[e] or page.tag[e] in TEXT_TAGS or page.tag[e] in INLINE
            if fits and not side[e] and 2 * links[e] <= size[e]:
                found.add(e)
    return around, found


def extract(page: Page, paths: list[str]) -> str:
    """The text of the containers on the first of `paths` that the page has, else of its own
    main container, with what stands beside them; one line a block."""
    side = side_matter(page)
    here = {k for k, s in zip(page.key, side, strict=True) if not s}
    keys = (path_key(p.split("/")) for p in paths)
    chosen = next((k for k in keys if k in here), None)
    if chosen is None:
        own = vote(page)
        if own is None:
            return ""
        chosen = path_key(own.split("/"))
    inside: list[bool] = []
    tops = []
    for e in range(len(page.tag)):
        within = page.parent[e] >= 0 and inside[page.parent[e]]
        inside.append(not side[e] and (page.key[e] == chosen or within))
        if inside[e] and not within:
            tops.append(e)
    around, more = beside(page, side, tops)
    for e in range(len(page.tag)):  # parents come first
        up = page.parent[e]
        inside[e] = inside[e] or e in around or e in more or (not side[e] and up >= 0 and inside[up] and up not in around)
    blocks: dict[int, list[str]] = {}
    for element, block, text in page.pieces:
        if inside[element]:
            blocks.setdefault(block, []).append(text)
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(x for x in lines if x)


def host_of(url: Column) -> Column:
    """The lower-cased host of a URL without user, port and a leading www; null urls share ''."""
    host = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?(?:www\.)?([^/?#:]*)", 1)
    return F.coalesce(host, F.lit(""))


def winning_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, paths): each host's winning paths, most votes first; at most 100 / `WIN` of them."""
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = [vote(parse(t.as_py() or "")) for t in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(paths, pa.string())], ["host", "path"])

    votes = rows.mapInArrow(run, "host string, path string").where("path is not null").groupBy("host", "path").agg(F.count("*").alias("n"))
    votes = materialise(votes, "votes")
    totals = votes.groupBy("host").agg(F.sum("n").alias("total"))
    won = votes.join(totals, "host").where(100 * F.col("n") >= WIN * F.col("total"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "path")))
    return won.groupBy("host").agg(F.transform(ranked, lambda x: x["path"]).alias("paths"))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: (`id_col`, `url_col`, text, n_chars).

    `text` has one line a block, white space within a block as one space; `n_chars` counts
    its code points. Null, empty and textless pages have an empty text. A null URL counts
    as the empty host; ties between paths go to the one that sorts first. Repeated rows
    each vote and each give a row; an empty table gives an empty result; other columns
    are ignored.
    """
    paths = materialise(winning_paths(pages, url_col, html_col).withColumnRenamed("host", "k"), "paths")
    few = paths.count() <= MAX_BROADCAST_HOSTS
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("host"))
    rows = rows.join(F.broadcast(paths) if few else paths, F.col("host") == F.col("k"), "left").select("id", "url", "html", "paths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.column("paths").to_pylist()
            texts = [extract(parse(t.as_py() or ""), p or []) for t, p in zip(batch.column("html"), known, strict=True)]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), sizes], ["id", "url", "text", "n_chars"])

    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"id {kind}, url string, text string, n_chars long")
    return found.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
