"""Edge rows from FIXTURES.md section 1 for the column functions."""

import datetime as dt

from pyspark.sql import functions as F

from issuewatch.functions import dates, numbers, text


def col1(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_korean_numbers(spark):
    got = col1(spark, ["1.2천", "4.3만", "3백만", "14", "0.29백", "조회 2,394"], lambda c: numbers.korean_number(text.strip_view_prefix(c)))
    assert got == [1200, 43000, 3000000, 14, 28, 2394]


def test_url_strip(spark):
    got = col1(spark, ["안녕.하세요 ok", "price 1.2 now", "end. Next", "end.Next", "see http://www.a.com/x?y=1#z now"], text.strip_urls)
    assert got == [" ok", "price  now", "end. Next", "", "see  now"]


def test_image_numbering(spark):
    assert col1(spark, ["2024 8 20 img 1 2 3"], text.drop_image_numbering) == ["2020 img "]


def test_emoticon_and_only_text(spark):
    assert col1(spark, ["ㅋㅋㅋㅋㅋ 좋아요!!  ~~ ㅠㅠ"], text.normalise_text) == ["ㅋㅋ 좋아요!! ㅠㅠ"]


def test_titles(spark):
    assert col1(spark, ["제목 입니다 (12) 이미지"], text.clean_title_bobae) == ["제목 입니다 "]
    assert col1(spark, ["제목 입니다 12"], text.clean_title_clien) == ["제목 입니다"]


def test_dc_chain(spark):
    s = "글 이미지 순서 ON 내용 2024 8 20 img 1 2 3 dc official App"
    out = col1(spark, [s], lambda c: text.clean_content(c, "dc", unescape=False))
    assert out == ["글 내용 2020 img"]


def test_html_unescape(spark):
    assert col1(spark, ["a &amp; b &lt;c&gt; &#39;d&#39; &amp;lt;"], text.html_unescape) == ["a & b <c> 'd' &lt;"]


def test_split_modified_and_label(spark):
    df = spark.createDataFrame([("2024-08-20 13:05:09 수정일 : 2024-08-21 10:00:00",), ("2024-08-20 13:05:09",)], "x string")
    c, m = text.split_created_modified(F.col("x"))
    rows = df.select(c, m).collect()
    assert [tuple(r) for r in rows] == [("2024-08-20 13:05:09", "2024-08-21 10:00:00"), ("2024-08-20 13:05:09", "2024-08-20 13:05:09")]
    assert col1(spark, ["조회 15", "조회"], text.second_token) == [15, None]


def test_dates(spark):
    snap = F.lit("2024-09-01 00:00:00").cast("timestamp")
    df = spark.createDataFrame(
        [
            ("dc", "2024.08.13 15:40:00"),
            ("dc", "08.13 15:40:00"),
            ("dc", "12.13 15:40:00"),
            ("naver", "2024.07.05. 21:54"),
            ("bobae", "24.08.20  13:05"),
            ("bobae", "98.10.03 00:00"),
            ("clien", "2024-08-20  13:05:09"),
            ("other", "2024-08-20 13:05:09"),
            ("dc", " "),
        ],
        "s string, x string",
    )
    got = [r[0] for r in df.select(dates.parse_post_date(F.col("x"), F.col("s"), snap)).collect()]
    assert got == [
        dt.datetime(2024, 8, 13, 15, 40),
        dt.datetime(2024, 8, 13, 15, 40),
        dt.datetime(2023, 12, 13, 15, 40),  # after the snapshot -> previous year
        dt.datetime(2024, 7, 5, 21, 54),
        dt.datetime(2024, 8, 20, 13, 5),
        dt.datetime(1998, 10, 3, 0, 0),  # two-digit pivot
        dt.datetime(2024, 8, 20, 13, 5, 9),
        None,  # unknown source -> quarantine
        None,  # blank date
    ]


def test_listing_window(spark):
    start = F.lit("2024-08-20 10:00:00").cast("timestamp")
    df = spark.createDataFrame([("bobae", "24. 08. 17"), ("bobae", "24. 08. 16"), ("clien", "2024-08-20 09:00:00"), ("naver", "15:40"), ("naver", "2024.08.21.")], "s string, x string")
    d = dates.parse_listing_date(F.col("x"), F.col("s"), start)
    got = [r[0] for r in df.select(dates.in_listing_window(d, start, 2)).collect()]
    assert got == [True, False, True, True, False]


def test_mixed_unescape_equals_python(spark):
    import html as _html

    cases = [
        "plain text",
        "a &amp; b &lt;c&gt; &quot;q&quot; &#39;s&#39; &apos;t&apos;",
        "&amp;lt; stays one level: &amp;amp;",
        "&copy; 2024 &middot; x&nbsp;y",
        "unknown &hellip; and numeric &#233; and hex &#x41;",
        "no semicolon &amp here &copy and & alone",
        None,
    ]
    got = col1(spark, cases, text.html_unescape_mixed)
    assert got == [None if c is None else _html.unescape(c) for c in cases]


def test_url_strip_needs_no_stack(spark):
    """One token of 200,000 dotted or slashed segments."""
    cases = ["x " + "a." * 200_000 + "b y", "x a.b" + "/c" * 200_000 + " y", "1" + " 1" * 200_000, "www.com ok", "a.b.c. d"]
    assert col1(spark, cases, text.strip_urls) == ["x  y", "x  y", cases[2], " ok", ". d"]
    assert col1(spark, cases[2:3], text.drop_image_numbering) == [""]


def test_leap_day_without_a_year(spark):
    snap = F.lit("2025-03-01 00:00:00").cast("timestamp")
    got = col1(spark, ["02.29 10:00:00", "02.28 10:00:00", "13.40 10:00:00"], lambda c: dates.parse_dc(c, snap))
    assert got == [dt.datetime(2024, 2, 29, 10), dt.datetime(2025, 2, 28, 10), None]


def test_listing_garbage_is_null(spark):
    snap = F.lit("2024-08-20 10:00:00").cast("timestamp")
    got = col1(spark, ["15:40", "garbage", None, "25:99", "2024.08.19."], lambda c: dates.parse_listing_date(c, F.lit("naver"), snap))
    assert got == [dt.date(2024, 8, 20), None, None, None, dt.date(2024, 8, 19)]


def test_clien_liked(spark):
    assert col1(spark, ["12명", "", "7", "x1명", None], text.clien_liked) == [12, 0, 7, None, None]
