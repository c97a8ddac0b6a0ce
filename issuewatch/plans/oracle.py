"""DuckDB SQL for each registered query (the correctness oracle).

Each string runs on the driver tables registered as views. Fixture views from
`fixtures.py` are repeated here as CTEs. Doubles are rounded to 6 digits, as in the
Spark plans.
"""

from __future__ import annotations

# --- fixture CTEs -----------------------------------------------------------------

KW_POSTS = """
kw_posts AS (
  SELECT event_id,
         'u/' || CAST(event_id % 500 AS VARCHAR) AS url,
         date_trunc('hour', ts) AS file_create_time,
         ts AS created_at,
         ['dc','naver','bobae','clien'][CAST(event_id % 4 AS INTEGER) + 1] AS data_source,
         [event_type, 'u' || CAST(user_id % 20 AS VARCHAR)] AS keywords,
         CAST(floor(value) AS BIGINT) AS viewed,
         CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS liked,
         event_id % 7 AS num_of_comments,
         CAST((event_id % 100) / 100.0 AS DOUBLE) AS sentiment,
         event_type, user_id, value
  FROM events
)"""

SNAP = """
snap AS (SELECT max(file_create_time) AS end_ts,
                CAST(CAST(max(file_create_time) AS DATE) - 62 AS TIMESTAMP) AS start_ts FROM kw_posts)"""

CUR_KW = """
cur_kw AS (
  SELECT DISTINCT unnest(keywords) AS current_keyword
  FROM kw_posts, snap WHERE created_at >= end_ts - INTERVAL 2 DAY
)"""

FACTS = """
facts AS (
  SELECT created_at, current_keyword,
         CAST(sum(num_of_comments) AS BIGINT) AS num_of_comments,
         CAST(sum(viewed) AS BIGINT) AS viewed,
         CAST(sum(liked) AS BIGINT) AS liked,
         CAST(sum(sentiment) AS DOUBLE) AS sentiment
  FROM (SELECT unnest(keywords) AS current_keyword, file_create_time AS created_at,
               num_of_comments, viewed, liked, sentiment
        FROM kw_posts, snap WHERE file_create_time BETWEEN start_ts AND end_ts)
  GROUP BY ALL
)"""

CURRENT_ISSUE = """
current_issue AS (
  SELECT g.created_at, g.current_keyword,
         CAST(coalesce(f.viewed,0) AS DOUBLE) + ln(1 + coalesce(f.liked,0)) + ln(1 + coalesce(f.num_of_comments,0)) AS current_issueization,
         coalesce(f.num_of_comments,0) AS num_of_comments,
         coalesce(f.viewed,0) AS viewed,
         coalesce(f.liked,0) AS liked,
         coalesce(f.sentiment,0) AS sentiment
  FROM (SELECT current_keyword, unnest(generate_series(start_ts, end_ts, INTERVAL 1 HOUR)) AS created_at
        FROM cur_kw, snap) g
  LEFT JOIN facts f USING (created_at, current_keyword)
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


ISSUE_CTES = (KW_POSTS, SNAP, CUR_KW, FACTS, CURRENT_ISSUE)

SQL: dict[str, str] = {}

SQL["keyword_hour_issue"] = with_(KW_POSTS) + """
SELECT created_at, current_keyword,
       round(CAST(viewed AS DOUBLE) + ln(1 + liked) + ln(1 + num_of_comments), 6) AS current_issueization,
       num_of_comments, viewed, liked, round(sentiment, 6) AS sentiment
FROM (
  SELECT file_create_time AS created_at, current_keyword,
         CAST(sum(num_of_comments) AS BIGINT) AS num_of_comments,
         CAST(sum(viewed) AS BIGINT) AS viewed, CAST(sum(liked) AS BIGINT) AS liked,
         CAST(sum(sentiment) AS DOUBLE) AS sentiment
  FROM (SELECT unnest(keywords) AS current_keyword, * FROM kw_posts)
  GROUP BY ALL
)"""

SQL["dense_keyword_issue"] = with_(*ISSUE_CTES) + """
SELECT created_at, current_keyword, round(current_issueization, 6) AS current_issueization,
       num_of_comments, viewed, liked, round(sentiment, 6) AS sentiment
FROM current_issue"""

KW_POSTS_OFFHOUR = KW_POSTS.replace("date_trunc('hour', ts) AS file_create_time", "date_trunc('hour', ts) + INTERVAL 7 MINUTE AS file_create_time")
FACTS_OFFHOUR = FACTS.replace("file_create_time AS created_at", "date_trunc('hour', file_create_time) AS created_at")

SQL["dense_keyword_issue_offhour"] = with_(KW_POSTS_OFFHOUR, SNAP, CUR_KW, FACTS_OFFHOUR, CURRENT_ISSUE) + """
SELECT created_at, current_keyword, round(current_issueization, 6) AS current_issueization,
       num_of_comments, viewed, liked, round(sentiment, 6) AS sentiment
FROM current_issue"""

SQL["keyword_frequency"] = with_(*ISSUE_CTES) + """
SELECT current_keyword, round(sum(current_issueization), 6) AS frequency
FROM current_issue GROUP BY current_keyword"""

SQL["keyword_frequency_log"] = with_(*ISSUE_CTES) + """
SELECT current_keyword, round(ln(sum(current_issueization) + 1), 6) AS total_frequency
FROM current_issue GROUP BY current_keyword"""

PAST_ISSUE = """
past_issue AS (
  WITH t AS (SELECT start_ts AS t0, end_ts AS t1 FROM snap),
  pf AS (SELECT event_type AS past_issue_name, file_create_time AS created_at,
                sum(viewed) AS v, sum(liked) AS l, sum(num_of_comments) AS c, sum(sentiment) AS s
         FROM kw_posts, t WHERE event_type IN ('error', 'purchase') AND file_create_time BETWEEN t0 AND t1 GROUP BY ALL),
  g AS (SELECT n.past_issue_name, unnest(generate_series(t0, t1, INTERVAL 1 HOUR)) AS created_at
        FROM (SELECT DISTINCT past_issue_name FROM pf) n, t)
  SELECT g.past_issue_name, g.created_at,
         CAST(coalesce(v, 0) AS DOUBLE) + ln(1 + coalesce(l, 0)) + ln(1 + coalesce(c, 0)) AS past_issueization,
         CAST(coalesce(s, 0) AS DOUBLE) AS past_sentiment
  FROM g LEFT JOIN pf USING (past_issue_name, created_at)
)"""

SQL["series_per_keyword"] = with_(*ISSUE_CTES) + """,
stats AS (
  SELECT current_keyword, min(created_at) AS t0,
         avg(current_issueization) FILTER (WHERE current_issueization != 0) AS mu,
         stddev_pop(current_issueization) FILTER (WHERE current_issueization != 0) AS sd
  FROM current_issue GROUP BY current_keyword
)
SELECT c.current_keyword,
       count(*) FILTER (WHERE current_issueization != 0) AS n_points,
       coalesce(list(CAST(date_diff('hour', s.t0, c.created_at) AS INTEGER) ORDER BY c.created_at)
                FILTER (WHERE current_issueization != 0), []) AS idx,
       coalesce(list(round(CASE WHEN sd > 0 THEN (current_issueization - mu) / sd ELSE 0.0 END, 6) ORDER BY c.created_at)
                FILTER (WHERE current_issueization != 0), []) AS z
FROM current_issue c JOIN stats s USING (current_keyword)
GROUP BY c.current_keyword"""

SQL["issue_graph"] = with_(*ISSUE_CTES, PAST_ISSUE) + """,
anchor AS (SELECT date_trunc('hour', end_ts - INTERVAL 2 MONTH) AS a FROM snap),
p AS (
  SELECT created_at + to_seconds(date_diff('second',
             (SELECT min(created_at) FROM past_issue WHERE past_issue_name = 'error'), a)) AS created_at,
         past_issue_name, past_issueization, past_sentiment
  FROM past_issue, anchor
),
c AS (
  SELECT created_at + to_seconds(date_diff('second', (SELECT min(created_at) FROM current_issue), a)) AS created_at,
         current_keyword, current_issueization, num_of_comments, viewed, liked, sentiment
  FROM current_issue, anchor
)
SELECT created_at, past_issue_name, round(past_issueization, 6) AS past_issueization,
       round(past_sentiment, 6) AS past_sentiment, current_keyword,
       round(current_issueization, 6) AS current_issueization, num_of_comments, viewed, liked,
       round(sentiment, 6) AS sentiment
FROM p JOIN c USING (created_at)"""

# Exact warp distances of all pairs, diagonal after diagonal: `d1` holds the diagonal
# i + j = k - 1 (by i), `d0` the one before it.
DTW = """
cs AS (SELECT current_keyword, min(created_at) AS t0, avg(current_issueization) FILTER (WHERE current_issueization != 0) AS mu,
         stddev_pop(current_issueization) FILTER (WHERE current_issueization != 0) AS sd FROM current_issue GROUP BY current_keyword),
cp AS (SELECT current_keyword, list(CAST(date_diff('hour', t0, created_at) AS DOUBLE) ORDER BY created_at) AS x,
         list(CASE WHEN sd > 0 THEN (current_issueization - mu) / sd ELSE 0.0 END ORDER BY created_at) AS z
       FROM current_issue JOIN cs USING (current_keyword) WHERE current_issueization != 0 GROUP BY current_keyword),
ps AS (SELECT past_issue_name, min(created_at) AS t0, avg(past_issueization) FILTER (WHERE past_issueization != 0) AS mu,
         stddev_pop(past_issueization) FILTER (WHERE past_issueization != 0) AS sd FROM past_issue GROUP BY past_issue_name),
pp AS (SELECT past_issue_name, list(CAST(date_diff('hour', t0, created_at) AS DOUBLE) ORDER BY created_at) AS px,
         list(CASE WHEN sd > 0 THEN (past_issueization - mu) / sd ELSE 0.0 END ORDER BY created_at) AS pz
       FROM past_issue JOIN ps USING (past_issue_name) WHERE past_issueization != 0 GROUP BY past_issue_name),
dtw_pairs AS MATERIALIZED (SELECT current_keyword, past_issue_name, x, z, px, pz, len(x) AS n, len(px) AS m FROM cp, pp),
walk AS (
  SELECT current_keyword, past_issue_name, 2 AS k,
         [sqrt((x[1] - px[1]) ** 2 + (z[1] - pz[1]) ** 2)] || list_transform(range(1, n), lambda i: CAST('inf' AS DOUBLE)) AS d1,
         list_transform(range(0, n), lambda i: CAST('inf' AS DOUBLE)) AS d0
  FROM dtw_pairs
  UNION ALL
  SELECT p.current_keyword, p.past_issue_name, w.k + 1,
         list_transform(range(1, p.n + 1), lambda i: CASE WHEN w.k + 1 - i BETWEEN 1 AND p.m THEN
             least(w.d1[i], CASE WHEN i > 1 THEN least(w.d1[i - 1], w.d0[i - 1]) ELSE CAST('inf' AS DOUBLE) END)
             + sqrt((p.x[i] - p.px[w.k + 1 - i]) ** 2 + (p.z[i] - p.pz[w.k + 1 - i]) ** 2)
           ELSE CAST('inf' AS DOUBLE) END),
         w.d1
  FROM walk w JOIN dtw_pairs p ON p.current_keyword = w.current_keyword AND p.past_issue_name = w.past_issue_name WHERE w.k < p.n + p.m
),
dtw AS (SELECT current_keyword, past_issue_name, w.d1[p.n] AS d FROM walk w JOIN dtw_pairs p USING (current_keyword, past_issue_name) WHERE w.k = p.n + p.m),
sim AS (
  SELECT k.current_keyword, i.past_issue_name, d, coalesce(exp(-d / 50), 0) AS s
  FROM (SELECT DISTINCT current_keyword FROM current_issue) k CROSS JOIN (SELECT DISTINCT past_issue_name FROM past_issue) i
  LEFT JOIN dtw USING (current_keyword, past_issue_name)
)"""

_SIM = with_(*ISSUE_CTES, PAST_ISSUE, DTW).replace("WITH", "WITH RECURSIVE", 1)

SQL["series_similarity_exact"] = _SIM + """
SELECT current_keyword, past_issue_name, round(s, 6) AS similarity_degree, round(d, 6) AS dtw_distance FROM sim"""

SQL["top_alerts_exact"] = _SIM + """,
f AS (SELECT current_keyword, ln(sum(current_issueization) + 1) AS tf FROM current_issue GROUP BY current_keyword)
SELECT current_keyword, past_issue_name, round(tf, 6) AS total_frequency, round(-ln(s) * 50, 6) AS dtw_distance
FROM f JOIN sim USING (current_keyword) ORDER BY s * tf DESC, current_keyword, past_issue_name LIMIT 8"""

# --- text cleaning in DuckDB SQL ------------------------------------------------------

# The cleaning patterns and phrases, written out here a second time so that a
# wrong constant in the engine cannot agree with itself.
URL_PATTERN = (
    r"(https?://)?(?:www\.)?(?:[\p{L}\p{N}_-]+\.)+[\p{L}\p{N}_-]+(?:/[\p{L}\p{N}_.-]*)*/?"
    r"(?:\?[\p{L}\p{N}_=&]*)?(?:#[\p{L}\p{N}_-]*)?"
)
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
DISALLOWED_CHARS = r"[^ㄱ-ㅎ가-힣a-zA-Z0-9 !?.,]"
IMAGE_NUMBER_PATTERN = r"\d(\s\d)+"
DC_IMAGE_PHRASES = ["이미지 순서 ON", "마우스 커서를 올리면 이미지 순서를 ON OFF 할 수 있습니다."]
DC_APP_SIGNATURES = [" dc App", " dc official App", " dc official app"]
BOBAE_TITLE_SUFFIX = r"\(\d+\)( 이미지)?( 휴대전화)?$"
CLIEN_TITLE_SUFFIX = r" \d+$"
ONLY_TEXT_DROP = r"[^ㄱ-ㅎㅏ-ㅣ가-힣a-zA-Z0-9\s.,?!()]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def s_urls(x):
    return f"regexp_replace({x}, {q(URL_PATTERN)}, '', 'g')"


def s_emails(x):
    return f"regexp_replace({x}, {q(EMAIL_PATTERN)}, '', 'g')"


# F3 in SQL covers the entities present in the driver tables plus the XML five and
# &nbsp;; '&amp;' goes last so that one pass of unescaping is modelled.
HTML_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
                 ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]


def s_unescape(x):
    for a, b in HTML_ENTITIES:
        x = f"replace({x}, {q(a)}, {q(b)})"
    return x


def s_allowed(x):
    return f"regexp_replace({x}, {q(DISALLOWED_CHARS)}, ' ', 'g')"


def s_spaces(x):
    return f"regexp_replace({x}, '\\s+', ' ', 'g')"


def s_phrases(x, phrases):
    for p in phrases:
        x = f"replace({x}, {q(p)}, '')"
    return x


def s_imgnum(x):
    return f"regexp_replace({x}, {q(IMAGE_NUMBER_PATTERN)}, '', 'g')"


def s_only_text(x):
    return f"trim(regexp_replace(regexp_replace({x}, {q(ONLY_TEXT_DROP)}, ' ', 'g'), '\\s+', ' ', 'g'))"


def s_jamo_runs(x):
    """Runs of 3+ equal jamo -> 2, without back-references (RE2 has none): a jamo is
    dropped when the two characters before it are the same jamo."""
    return (
        f"(SELECT CASE WHEN regexp_matches(_s, '[ㄱ-ㅎㅏ-ㅣ]') THEN array_to_string(list_transform(range(1, length(_s) + 1), "
        f"lambda i: CASE WHEN i > 2 AND substr(_s, i, 1) = substr(_s, i - 1, 1) AND substr(_s, i, 1) = substr(_s, i - 2, 1) "
        f"AND regexp_matches(substr(_s, i, 1), '[ㄱ-ㅎㅏ-ㅣ]') THEN '' ELSE substr(_s, i, 1) END), '') ELSE _s END "
        f"FROM (SELECT {x} AS _s))"
    )


def s_normalise(x):
    return s_jamo_runs(s_only_text(x))


def s_chain(x, source, unescape=True, normalise=True):
    y = s_emails(s_urls(x))
    if unescape:
        y = s_unescape(y)
    y = s_allowed(y)
    if source == "dc":
        y = s_phrases(s_imgnum(s_spaces(s_phrases(y, DC_IMAGE_PHRASES))), DC_APP_SIGNATURES)
    else:
        y = s_spaces(y)
    return s_normalise(y) if normalise else y


RAW_DOCS = """
raw_docs AS (SELECT doc_id, ['dc','naver','bobae','clien'][CAST(doc_id % 4 AS INTEGER) + 1] AS data_source,
                    text AS content, lang FROM documents)"""

RAW_PAGES = """
raw_pages AS (SELECT page_id, url, html, ['dc','naver','bobae','clien'][CAST(page_id % 4 AS INTEGER) + 1] AS data_source FROM pages)"""

SQL["clean_text"] = with_(RAW_DOCS) + f"SELECT doc_id, {s_chain('content', 'naver', False, False)} AS content FROM raw_docs"
SQL["clean_text_dc"] = with_(RAW_DOCS) + f"SELECT doc_id, {s_chain('content', 'dc', False, False)} AS content FROM raw_docs"
SQL["clean_text_full"] = with_(RAW_DOCS) + (
    "SELECT doc_id, data_source, CASE WHEN data_source IN ('dc', 'dcinside') "
    f"THEN {s_chain('content', 'dc')} ELSE {s_chain('content', 'naver')} END AS content FROM raw_docs"
)
_TITLE_B = f"{s_spaces('regexp_replace(' + s_normalise('title') + ', ' + q(BOBAE_TITLE_SUFFIX) + ", '')")}"
_TITLE_C = f"{s_spaces('regexp_replace(' + s_normalise('title') + ', ' + q(CLIEN_TITLE_SUFFIX) + ", '')")}"
SQL["clean_titles"] = with_(RAW_PAGES) + f"""
SELECT page_id, data_source,
       CASE WHEN data_source = 'bobae' THEN {_TITLE_B} WHEN data_source = 'clien' THEN {_TITLE_C} ELSE title END AS title
FROM (SELECT page_id, data_source, regexp_extract(html, '<title>(.*?)</title>', 1) AS title FROM raw_pages)"""

SITE_COUNTS = """
site_counts AS (
  SELECT p_partkey,
         CASE WHEN p_partkey % 4 = 0 THEN '조회 ' || p_size || ',345'
              WHEN p_partkey % 4 = 1 THEN p_size || '.' || (p_partkey % 10) || '천'
              WHEN p_partkey % 4 = 2 THEN p_size || '백만'
              ELSE CAST(p_size AS VARCHAR) END AS count_text
  FROM part)"""

SQL["parse_counts"] = with_(SITE_COUNTS) + """
SELECT p_partkey, count_text,
       CAST(trunc(TRY_CAST(trim(regexp_replace(x, '[십백천]만|[십백천만]', '', 'g')) AS DOUBLE)
            * (CASE WHEN contains(tok, '십') THEN 10 ELSE 1 END) * (CASE WHEN contains(tok, '백') THEN 100 ELSE 1 END)
            * (CASE WHEN contains(tok, '천') THEN 1000 ELSE 1 END) * (CASE WHEN contains(tok, '만') THEN 10000 ELSE 1 END)) AS BIGINT) AS n
FROM (SELECT *, regexp_extract(x, '[십백천]만|[십백천만]') AS tok
      FROM (SELECT *, trim(replace(replace(count_text, '조회', ''), ',', '')) AS x FROM site_counts))"""

SITE_DATES = """
site_dates AS (
  SELECT o_orderkey, ['dc','naver','bobae','clien'][CAST(o_orderkey % 4 AS INTEGER) + 1] AS data_source,
         CASE WHEN o_orderkey % 8 = 0 THEN strftime(o_orderdate, '%m.%d %H:%M:%S')
              WHEN o_orderkey % 8 = 1 THEN strftime(o_orderdate, '%m.%d. %H:%M')
              WHEN o_orderkey % 4 = 0 THEN strftime(o_orderdate, '%Y.%m.%d %H:%M:%S')
              WHEN o_orderkey % 4 = 1 THEN strftime(o_orderdate, '%Y.%m.%d. %H:%M')
              WHEN o_orderkey % 4 = 2 THEN strftime(o_orderdate, '%y.%m.%d  %H:%M')
              ELSE strftime(o_orderdate, '%Y-%m-%d  %H:%M:%S') END AS date_text,
         o_orderdate
  FROM orders)"""


def _yearless(layout):
    def back(k):
        t = f"try_strptime(CAST(year(s) - {k} AS VARCHAR) || '.' || x, '{layout}')"
        return f"CASE WHEN {t} <= s THEN {t} END"

    leap = ", ".join(back(k) for k in range(2, 9))
    return f"coalesce(try_strptime(x, '{layout}'), {back(0)}, {back(1)}, CASE WHEN x LIKE '02.29%' THEN coalesce({leap}) END)"


SQL["parse_dates"] = with_(SITE_DATES) + f"""
SELECT o_orderkey, data_source, date_text, created_at, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_text
FROM (
  SELECT *, CASE data_source
      WHEN 'dc' THEN {_yearless('%Y.%m.%d %H:%M:%S')}
      WHEN 'naver' THEN {_yearless('%Y.%m.%d. %H:%M')}
      WHEN 'bobae' THEN make_timestamp(
          CASE WHEN CAST(split_part(x, '.', 1) AS INTEGER) >= 69 THEN 1900 ELSE 2000 END + CAST(split_part(x, '.', 1) AS INTEGER),
          CAST(split_part(x, '.', 2) AS INTEGER), CAST(split_part(split_part(x, '.', 3), ' ', 1) AS INTEGER),
          CAST(split_part(split_part(x, ' ', 2), ':', 1) AS INTEGER), CAST(split_part(split_part(x, ' ', 2), ':', 2) AS INTEGER), 0)
      WHEN 'clien' THEN try_strptime(x, '%Y-%m-%d %H:%M:%S')
    END AS created_at
  FROM (SELECT *, trim(regexp_replace(date_text, '\\s+', ' ', 'g')) AS x FROM site_dates),
       (SELECT CAST(max(o_orderdate) AS TIMESTAMP) AS s FROM orders)
)"""

SQL["split_modified"] = """
SELECT o_orderkey, trim(string_split(raw, '수정일 :')[1]) AS created_at,
       CASE WHEN len(string_split(raw, '수정일 :')) > 1 THEN trim(string_split(raw, '수정일 :')[2])
            ELSE trim(string_split(raw, '수정일 :')[1]) END AS modified_at
FROM (SELECT o_orderkey,
             CASE WHEN o_orderkey % 3 = 0
                  THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ' 수정일 : ' || strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S')
                  ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS raw
      FROM orders)"""

SQL["label_value"] = """
SELECT o_orderkey, label_text, TRY_CAST(split_part(label_text, ' ', 2) AS INTEGER) AS value
FROM (SELECT o_orderkey, '조회 ' || CAST(o_custkey AS VARCHAR) AS label_text FROM orders)"""

SQL["shift_zone"] = """
SELECT event_id, ts, timezone('Asia/Seoul', CAST(ts AS TIMESTAMPTZ)) AS local_ts FROM events"""

SQL["text_concat"] = """
SELECT conv_id, turn, replace(coalesce(role, '') || ' ' || coalesce(text, ''), chr(10), ' ') AS scoring_text
FROM conversations"""

# --- comments and threads ------------------------------------------------------------

SQL["comment_threads"] = """
WITH it AS (
  SELECT conv_id, turn, role, role = 'assistant' AS is_reply,
         max(CASE WHEN role <> 'assistant' OR turn = 0 THEN turn END)
           OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS thread_pos
  FROM conversations
)
SELECT p.conv_id, p.turn AS thread_pos, p.role,
       (SELECT count(*) FROM it r WHERE r.conv_id = p.conv_id AND r.thread_pos = p.turn AND r.turn <> p.turn) AS reply_count
FROM it p WHERE p.thread_pos = p.turn"""

SQL["nested_threads"] = """
WITH t AS (SELECT *, coalesce(max(CASE WHEN role <> 'assistant' THEN turn END) OVER w, min(turn) OVER (PARTITION BY conv_id)) AS thread_pos
           FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
r AS (SELECT conv_id, thread_pos, (turn - thread_pos - 1) // 2 AS chunk_no, list(turn || ':' || role || ':' || length(text) ORDER BY turn) AS children
      FROM t WHERE turn <> thread_pos GROUP BY ALL)
SELECT p.conv_id, p.turn AS thread_pos, coalesce(chunk_no, 0) AS chunk_no, greatest(count(chunk_no) OVER (PARTITION BY p.conv_id, p.turn), 1) AS n_chunks, p.role, coalesce(children, []) AS children
FROM t p LEFT JOIN r ON r.conv_id = p.conv_id AND r.thread_pos = p.turn WHERE p.turn = p.thread_pos"""

SQL["threads_by_count"] = """
WITH it AS (
  SELECT conv_id, turn, role, text,
         CASE WHEN role = 'user' THEN length(text) % 3 ELSE 0 END AS num_of_comments,
         lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS nxt_turn,
         lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS nxt_text
  FROM conversations
)
SELECT conv_id, turn, role, num_of_comments,
       CASE WHEN num_of_comments > 0 THEN nxt_turn END AS reply_pos,
       CASE WHEN num_of_comments > 0 THEN nxt_text END AS replies
FROM it WHERE role <> 'assistant'"""

RAW_THREADS = """
rt AS (
  SELECT doc_id, string_split(text, chr(10)) AS lines, n_chars,
         TIMESTAMP '2024-01-01 00:00:00' + to_hours(doc_id) AS created_at
  FROM documents
),
cmt AS (
  SELECT doc_id, k, lines[k + 1] AS content, length(lines[k + 1]) >= 20 AS valid,
         created_at + to_minutes(k * 97) AS t
  FROM (SELECT doc_id, lines, created_at, unnest(range(1, len(lines))) AS k FROM rt)
),
posts AS (
  SELECT rt.doc_id, lines[1] AS content, rt.created_at, n_chars % 1000 AS viewed, doc_id % 17 AS liked,
         len(lines) - 1 AS n, (SELECT max(k) FROM cmt WHERE cmt.doc_id = rt.doc_id AND valid) AS k_last
  FROM rt
)"""

_SRC = "['dc','naver','bobae','clien'][CAST(doc_id % 4 AS INTEGER) + 1]"
_CHAIN = f"CASE WHEN {_SRC} = 'dc' THEN {s_chain('content', 'dc')} ELSE {s_chain('content', 'naver')} END"

SQL["post_comment_rows"] = with_(RAW_THREADS) + f"""
SELECT doc_id, CAST(k - 1 AS INTEGER) AS item_order, {_CHAIN} AS content, t AS created_at, 0 AS viewed, 0 AS liked,
       1 AS post_type, 0 AS num_of_comments, 0.0 AS seconds_per_comment
FROM cmt WHERE valid
UNION ALL
SELECT doc_id, 2147483647 AS item_order, {_CHAIN} AS content, created_at, CAST(viewed AS INTEGER), CAST(liked AS INTEGER), 0 AS post_type,
       CAST(own AS INTEGER) AS num_of_comments,
       CASE WHEN own = 0 THEN 0.0 ELSE round(CAST(((k_last * 97 * 60) % 86400) AS DOUBLE) / own, 6) END AS seconds_per_comment
FROM (SELECT * REPLACE ('제목 ' || doc_id || ' ' || content AS content),
             CASE WHEN doc_id % 4 < 2 THEN doc_id % 11 ELSE n END AS own FROM posts)"""

SQL["post_comment_csv"] = f"""
SELECT nullif(content, '') AS content, created_at, viewed, liked, post_type, num_of_comments, seconds_per_comment
FROM ({SQL["post_comment_rows"]})"""

SQL["seconds_per_comment"] = with_(RAW_THREADS) + """
SELECT doc_id, CAST(n AS INTEGER) AS num_of_comments,
       CASE WHEN k_last IS NOT NULL THEN created_at + to_minutes(k_last * 97) END AS last_comment_at,
       CASE WHEN n = 0 THEN 0.0 ELSE round(CAST(((k_last * 97 * 60) % 86400) AS DOUBLE) / n, 6) END AS seconds_per_comment
FROM posts"""

# --- sources, sinks, projections -------------------------------------------------------

FILE_LIST = """
file_list AS (
  SELECT replace('keywords/' || strftime(file_create_time, '%Y-%m-%dT%H:%M:%S') || '/' || data_source || '_' || keywords[1]
                 || '_' || strftime(file_create_time, '%Y-%m-%dT%H:%M:%S') || '.jsonl', ':', '%3A') AS key,
         CAST(max(created_at) AS TIMESTAMP) AS file_mtime
  FROM kw_posts GROUP BY 1
),
files AS (
  SELECT key, file_mtime, regexp_extract(url_decode(key), '([^/]+)$', 1) AS file_name,
         split_part(regexp_extract(url_decode(key), '([^/]+)$', 1), '_', 1) AS data_source,
         split_part(regexp_extract(url_decode(key), '([^/]+)$', 1), '_', 2) AS model,
         strptime(regexp_extract(url_decode(key), '(\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2})\\.jsonl$', 1), '%Y-%m-%dT%H:%M:%S') AS snapshot
  FROM file_list
)"""

SQL["file_meta"] = with_(KW_POSTS, FILE_LIST) + "SELECT key, file_name, data_source, model, snapshot FROM files"

SQL["newest_files"] = with_(KW_POSTS, FILE_LIST) + """
SELECT snapshot, file_name, file_mtime FROM files
QUALIFY row_number() OVER (PARTITION BY snapshot ORDER BY file_mtime DESC, file_name ASC) <= 4"""

SQL["latest_complete_snapshot"] = with_(KW_POSTS, FILE_LIST) + """
SELECT snapshot, count(DISTINCT data_source) AS n_sources, count(DISTINCT data_source) >= 4 AS is_complete,
       snapshot = (SELECT snapshot FROM files ORDER BY file_mtime DESC, snapshot DESC LIMIT 1) AS is_latest
FROM files GROUP BY snapshot"""

SQL["dedupe_snapshot"] = with_(KW_POSTS) + """
SELECT file_create_time, data_source, url, event_id, viewed FROM kw_posts
QUALIFY row_number() OVER (PARTITION BY file_create_time, data_source, url ORDER BY viewed DESC, event_id DESC) = 1"""

SQL["union_sources"] = with_(KW_POSTS) + """
SELECT event_id, url, created_at, data_source, keywords, viewed, liked, num_of_comments,
       CASE WHEN data_source = 'naver' THEN NULL ELSE round(sentiment, 6) END AS sentiment FROM kw_posts"""

RAW_POSTS = """
rp AS (
  SELECT doc_id, data_source, lines, created_at, n_chars,
         list_transform(lines[2:], lambda line, i: struct_pack(
             author := 'a' || CAST(i AS VARCHAR), content := line,
             created_at := CASE WHEN length(line) < 20 THEN ' '
                 WHEN data_source = 'dc' THEN strftime(created_at + to_minutes(i * 97), '%Y.%m.%d %H:%M:%S')
                 WHEN data_source = 'naver' THEN strftime(created_at + to_minutes(i * 97), '%Y.%m.%d. %H:%M')
                 WHEN data_source = 'bobae' THEN strftime(created_at + to_minutes(i * 97), '%y.%m.%d  %H:%M')
                 ELSE strftime(created_at + to_minutes(i * 97), '%Y-%m-%d  %H:%M:%S') END,
             num_of_comments := '0',
             children := CAST([] AS STRUCT(author VARCHAR, content VARCHAR, created_at VARCHAR)[]))) AS comments
  FROM (SELECT doc_id, ['dc','naver','bobae','clien'][CAST(doc_id % 4 AS INTEGER) + 1] AS data_source,
               string_split(text, chr(10)) AS lines, n_chars,
               TIMESTAMP '2024-01-01 00:00:00' + to_hours(doc_id) AS created_at FROM documents)
),
raw AS (
  SELECT data_source || ' ' || CAST(doc_id AS VARCHAR) AS title, lines[1] AS content, data_source AS author,
         created_at, CAST(n_chars % 1000 AS INTEGER) AS viewed, CAST(doc_id % 17 AS INTEGER) AS liked,
         CAST(len(comments) AS INTEGER) AS num_of_comments, CAST(to_json(comments) AS VARCHAR) AS comments,
         'doc' AS model, data_source, [data_source, 'k' || CAST(doc_id % 7 AS VARCHAR)] AS keywords,
         TIMESTAMP '2024-02-01 00:00:00' AS file_create_time,
         round(CAST(CAST((doc_id % 100) / 100.0 AS FLOAT) AS DOUBLE), 6) AS sentiment,
         'd/' || CAST(doc_id AS VARCHAR) AS url
  FROM rp
)"""

SQL["raw_data_projection"] = with_(RAW_POSTS) + "SELECT * FROM raw"

SQL["raw_data_view"] = with_(RAW_POSTS) + """
SELECT url, unnest(keywords) AS current_keyword, substring(content, 1, 255) AS content,
       substring(comments, 1, 255) AS comments, sentiment
FROM raw"""

SQL["failed_post_filter"] = with_(SITE_DATES) + """
SELECT o_orderkey, data_source, date_text FROM (
  SELECT o_orderkey, data_source,
         CASE WHEN o_orderkey % 13 = 0 THEN ' ' WHEN o_orderkey % 17 = 0 THEN NULL ELSE date_text END AS date_text
  FROM site_dates)
WHERE length(trim(date_text)) > 0"""

SQL["listing_window"] = """
WITH s AS (SELECT CAST(max(o_orderdate) AS DATE) AS d FROM orders),
items AS (
  SELECT o_orderkey, ['bobae','clien','naver'][CAST(o_orderkey % 3 AS INTEGER) + 1] AS data_source,
         CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%y. %m. %d')
              WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
              WHEN o_orderkey % 5 = 0 THEN '15:40'
              ELSE strftime(o_orderdate, '%Y.%m.%d.') END AS listing_text
  FROM orders
),
parsed AS (
  SELECT items.*, CASE data_source
      WHEN 'bobae' THEN make_date(CASE WHEN CAST(split_part(listing_text, '.', 1) AS INTEGER) >= 69 THEN 1900 ELSE 2000 END
                                  + CAST(split_part(listing_text, '.', 1) AS INTEGER),
                                  CAST(trim(split_part(listing_text, '.', 2)) AS INTEGER), CAST(trim(split_part(listing_text, '.', 3)) AS INTEGER))
      WHEN 'clien' THEN CAST(strptime(listing_text, '%Y-%m-%d %H:%M:%S') AS DATE)
      ELSE CASE WHEN regexp_matches(listing_text, '^\\d{4}.\\d{2}.\\d{2}.$') THEN CAST(strptime(listing_text, '%Y.%m.%d.') AS DATE) ELSE s.d END
    END AS posted_date, s.d AS d
  FROM items, s
)
SELECT o_orderkey, data_source, listing_text, posted_date, CAST(d - 30 AS DATE) AS look_back
FROM parsed WHERE posted_date >= d - 31 AND posted_date <= d"""

SQL["keywords_json_roundtrip"] = with_(KW_POSTS) + """
SELECT event_id, CAST(to_json(keywords) AS VARCHAR) AS keywords_json, keywords FROM kw_posts"""

SQL["tolerant_json"] = """
SELECT conv_id, turn, role, text FROM conversations WHERE NOT (turn % 9 = 4) AND NOT (turn % 11 = 7) AND NOT (turn % 13 = 6)"""

SQL["snapshot_read"] = with_(KW_POSTS) + """
SELECT strftime(file_create_time, '%Y-%m-%dT%H-%M-%S') AS snapshot_key, data_source, url,
       strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at, viewed, event_type AS title
FROM kw_posts
WHERE file_create_time = (SELECT max(file_create_time) FROM kw_posts)
QUALIFY row_number() OVER (PARTITION BY data_source, url ORDER BY created_at DESC) = 1"""

SQL["roundtrip_tables"] = with_(KW_POSTS) + """
SELECT CAST(file_create_time AS DATE) AS snapshot_date, count(*) AS n_rows, sum(viewed) AS sum_viewed,
       count(*) AS n_csv_rows
FROM kw_posts GROUP BY 1"""

# --- page extraction -------------------------------------------------------------------


def s_strip_tags(x):
    return ("trim(regexp_replace(regexp_replace(regexp_replace(" + x + ", '(?s)<h1>.*?</h1>', ' ', 'g'), "
            "'<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))")


SQL["page_posts"] = with_(RAW_PAGES) + f"""
SELECT page_id, data_source, title, content, author,
       length(title) > 0 AND length(content) > 0 AND length(author) > 0 AS ok
FROM (
  SELECT page_id, data_source,
         {s_unescape("regexp_extract(html, '<title>(.*?)</title>', 1)")} AS title,
         {s_unescape(s_strip_tags("regexp_extract(html, '(?s)<article>(.*?)</article>', 1)"))} AS content,
         regexp_extract(html, '<footer>&copy; ([^ <]+)', 1) AS author
  FROM raw_pages)"""

SQL["page_links"] = """
SELECT page_id, CAST(i - 1 AS INTEGER) AS link_pos, hrefs[i] AS href,
       CASE WHEN starts_with(hrefs[i], '/') THEN regexp_extract(url, '^(https?://[^/?#]+)', 1) || hrefs[i] ELSE hrefs[i] END AS link_url
FROM (SELECT page_id, url, hrefs, unnest(range(1, len(hrefs) + 1)) AS i
      FROM (SELECT page_id, url, regexp_extract_all(html, 'href="([^"]*)"', 1) AS hrefs FROM pages))"""

SQL["comment_defaults"] = """
SELECT conv_id, turn,
       CASE WHEN author IS NULL OR created_at IS NULL THEN ' ' ELSE author END AS author,
       CASE WHEN author IS NULL OR created_at IS NULL THEN '해당 댓글은 삭제되었습니다.' ELSE coalesce(content, ' ') END AS content,
       CASE WHEN author IS NULL OR created_at IS NULL THEN ' ' ELSE created_at END AS created_at
FROM (
  SELECT conv_id, turn,
         CASE WHEN turn % 10 = 3 THEN 'ub-content us-post blocked' WHEN role = 'system' THEN 'ub-content notice' ELSE 'ub-content us-post' END AS class,
         CASE WHEN turn % 7 <> 5 THEN 'n' || CAST(conv_id AS VARCHAR) END AS author,
         CASE WHEN length(text) >= 40 THEN text END AS content,
         strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(conv_id * 60 + turn), '%Y.%m.%d %H:%M:%S') AS created_at
  FROM conversations)
WHERE contains(class, 'ub-content us-post') AND NOT contains(class, 'blocked')"""

_SPACES = "trim(regexp_replace({}, '[\\x20\\x09-\\x0d]+', ' ', 'g'))"


def _site_time(t: str) -> str:
    layouts = {"dc": "%Y.%m.%d %H:%M:%S", "naver": "%Y.%m.%d. %H:%M", "bobae": "%y.%m.%d %H:%M", "clien": "%Y-%m-%d %H:%M:%S"}
    return "CASE src " + " ".join(f"WHEN '{s}' THEN strftime({t}, '{x}')" for s, x in layouts.items()) + " END"


_SITE_PAGES = """
pg AS (SELECT doc_id, ['dc','naver','bobae','clien'][CAST(doc_id % 4 AS INTEGER) + 1] AS src, string_split(text, chr(10)) AS ls,
         TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(doc_id AS INTEGER)) AS base, n_chars FROM documents WHERE text IS NOT NULL)"""

_PAGE_LINES = _SITE_PAGES + f""",
cm AS (SELECT doc_id, src, k, 'a' || k AS author, {_SPACES.format('ls[k + 1]')} AS content, {_site_time('base + to_minutes(k * 97)')} AS wrote,
         src = 'dc' AND length(ls[k + 1]) < 20 AS gone, len(ls) - 1 AS n
       FROM (SELECT *, unnest(range(1, len(ls))) AS k FROM pg)),
shown AS (SELECT doc_id, src, k, n, CASE WHEN gone THEN ' ' ELSE author END AS author, CASE WHEN gone THEN '해당 댓글은 삭제되었습니다.' ELSE content END AS content,
            CASE WHEN gone THEN ' ' ELSE wrote END AS wrote FROM cm),
top AS (SELECT * FROM shown WHERE CASE WHEN src = 'clien' THEN k % 5 <> 0 ELSE k % 3 <> 0 END)"""

SQL["site_page_comments"] = with_(_PAGE_LINES) + """
SELECT t.doc_id, CAST(row_number() OVER (PARTITION BY t.doc_id ORDER BY t.k) - 1 AS INTEGER) AS pos, t.author, t.content, t.wrote AS created_at,
       CASE WHEN t.src = 'clien' THEN t.wrote END AS modified_at, CASE WHEN t.src = 'clien' THEN '1' || lpad(CAST(t.k % 100 AS VARCHAR), 3, '0') END AS liked,
       CASE WHEN r.k IS NULL THEN '0' ELSE '1' END AS num_of_comments, coalesce(r.author || '/' || r.wrote || '/' || r.content, '') AS answers
FROM top t LEFT JOIN shown r ON t.src <> 'clien' AND t.k % 3 = 2 AND r.doc_id = t.doc_id AND r.k = t.k + 1"""

SQL["site_page_posts"] = with_(_PAGE_LINES) + f""",
per AS (SELECT doc_id, count(*) AS c FROM top GROUP BY doc_id)
SELECT doc_id, src AS data_source, '제목 & ' || doc_id AS title, {_SPACES.format('ls[1]')} AS content, 'u' || doc_id AS author, {_site_time('base')} AS created_at,
       CASE WHEN src = 'clien' THEN {_site_time('base')} END AS modified_at,
       CASE WHEN src = 'naver' THEN '조회 ' ELSE '' END || (n_chars % 1000) AS viewed,
       (doc_id % 17) || CASE WHEN src = 'clien' THEN '명' ELSE '' END AS liked,
       CASE WHEN src IN ('dc', 'naver') THEN CAST(len(ls) - 1 AS VARCHAR) END AS num_of_comments, CAST(coalesce(c, 0) AS INTEGER) AS n_rows
FROM pg LEFT JOIN per USING (doc_id)"""

# --- keywords (MMR unrolled in SQL) -------------------------------------------------------


def _cos(a, b):
    return f"(list_dot_product({a}, {b}) / (sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b}))))"


def mmr_sql(cands_cte: str, top_n: int = 5, d: float = 0.2) -> str:
    """cands_cte defines c(doc, item, v DOUBLE[], sd DOUBLE). Returns CTE text + final SELECT."""
    parts = [cands_cte]
    prev_state = "c"
    parts.append("s1 AS MATERIALIZED (SELECT doc, item, v, sd, CAST(NULL AS DOUBLE) AS m, true AS lft FROM c)")
    selects = []
    for k in range(1, top_n + 1):
        st = f"s{k}"
        score = "sd" if k == 1 else f"({1.0 - d!r} * sd - {d!r} * m)"
        parts.append(
            f"p{k} AS MATERIALIZED (SELECT doc, item AS pick, v AS pv FROM {st} WHERE lft "
            f"QUALIFY row_number() OVER (PARTITION BY doc ORDER BY {score} DESC, item ASC) = 1)"
        )
        selects.append(f"SELECT doc, {k} AS rank, pick AS item FROM p{k}")
        if k < top_n:
            parts.append(
                f"s{k + 1} AS MATERIALIZED (SELECT s.doc, s.item, s.v, s.sd, "
                f"CASE WHEN p.pick IS NULL THEN s.m ELSE greatest(coalesce(s.m, -2.0), {_cos('s.v', 'p.pv')}) END AS m, "
                f"s.lft AND (p.pick IS NULL OR s.item <> p.pick) AS lft "
                f"FROM {st} s LEFT JOIN p{k} p USING (doc))"
            )
        prev_state = st
    return "WITH " + ",\n".join(parts) + "\n" + "\nUNION ALL\n".join(selects)


_MMR_EMB = """
e AS (SELECT label AS doc, vec_id AS item, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
dv AS (SELECT doc, list(m ORDER BY pos) AS dvec
       FROM (SELECT doc, pos, avg(x) AS m
             FROM (SELECT doc, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS pos FROM e) GROUP BY doc, pos)
       GROUP BY doc),
c AS MATERIALIZED (SELECT e.doc, e.item, e.v, """ + _cos("e.v", "dv.dvec") + """ AS sd FROM e JOIN dv USING (doc))"""

SQL["mmr_keywords"] = "SELECT doc, CAST(rank AS INTEGER) AS rank, item AS vec_id FROM (" + mmr_sql(_MMR_EMB) + ")"


def _hashed(src: str, key: str, text: str) -> str:
    """Signed hashed character-trigram counts (64 buckets) per key, as DOUBLE[64]."""
    return f"""(
  SELECT {key}, list(coalesce(val, 0.0) ORDER BY b) AS vec
  FROM (SELECT k.{key}, r.b, cnt.val
        FROM (SELECT DISTINCT {key} FROM {src}) k CROSS JOIN (SELECT unnest(range(0, 64)) AS b) r
        LEFT JOIN (
          SELECT {key}, (961 * cd[i] + 31 * cd[i + 1] + cd[i + 2]) % 64 AS b,
                 sum(CASE WHEN (cd[i] + 7 * cd[i + 1] + 13 * cd[i + 2]) % 2 = 0 THEN 1.0 ELSE -1.0 END) AS val
          FROM (SELECT {key}, cd, unnest(range(1, len(cd) - 1)) AS i
                FROM (SELECT {key}, list_transform(regexp_extract_all(' ' || {text} || ' ', '(?s).'), lambda ch: CAST(unicode(ch) AS BIGINT)) AS cd
                      FROM {src}))
          GROUP BY ALL) cnt USING ({key}, b))
  GROUP BY {key})"""


# The words' vectors are held once a word, not once a (document, word), and the state of the
# selection is two numbers a candidate; the cosine of two vectors is taken where it is needed.
_DOC_KW = f"""
w AS MATERIALIZED (SELECT DISTINCT doc_id AS doc, unnest(regexp_extract_all(lower(text), '\\p{{L}}{{2,}}')) AS item FROM documents),
vocab AS (SELECT DISTINCT item FROM w),
wv AS MATERIALIZED (SELECT item, CAST(vec AS DOUBLE[64]) AS v, sqrt(list_dot_product(vec, vec)) AS n FROM {_hashed('vocab', 'item', 'item')}),
ld AS (SELECT doc_id AS doc, lower(text) AS t FROM documents),
dv AS MATERIALIZED (SELECT doc, CAST(vec AS DOUBLE[64]) AS v, sqrt(list_dot_product(vec, vec)) AS n FROM {_hashed('ld', 'doc', 't')}),
s1 AS MATERIALIZED (SELECT w.doc, w.item, array_inner_product(wv.v, dv.v) / (wv.n * dv.n) AS sd, CAST(NULL AS DOUBLE) AS m
  FROM w JOIN wv USING (item) JOIN dv USING (doc))"""


def _keyword_steps(top_n: int = 5, d: float = 0.2) -> str:
    parts, picks = [], []
    for k in range(1, top_n + 1):
        score = "sd" if k == 1 else f"({1.0 - d!r} * sd - {d!r} * m)"
        parts.append(f"p{k} AS MATERIALIZED (SELECT doc, item AS pick FROM s{k} QUALIFY row_number() OVER (PARTITION BY doc ORDER BY {score} DESC, item) = 1)")
        picks.append(f"SELECT doc AS doc_id, CAST({k} AS INTEGER) AS rank, pick AS keyword FROM p{k}")
        if k < top_n:
            parts.append(
                f"s{k + 1} AS MATERIALIZED (SELECT s.doc, s.item, s.sd, greatest(coalesce(s.m, -2.0), array_inner_product(a.v, b.v) / (a.n * b.n)) AS m "
                f"FROM s{k} s JOIN p{k} p ON p.doc = s.doc AND p.pick <> s.item JOIN wv a ON a.item = s.item JOIN wv b ON b.item = p.pick)"
            )
    return ",\n".join(parts) + "\n" + "\nUNION ALL\n".join(picks)


SQL["document_keywords"] = "WITH" + _DOC_KW + ",\n" + _keyword_steps()

# --- sentiment (naive-Bayes lexicon) -----------------------------------------------------

_NB = """
tok AS (SELECT doc_id, token, count(*) AS n
        FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS token FROM documents) GROUP BY ALL),
tr AS (SELECT t.*, l.toxic FROM tok t JOIN labels l USING (doc_id)),
pt AS (SELECT token, sum(CASE WHEN toxic = 1 THEN n ELSE 0 END) AS n1, sum(CASE WHEN toxic = 0 THEN n ELSE 0 END) AS n0
       FROM tr GROUP BY token),
tot AS (SELECT sum(n1) AS tot1, sum(n0) AS tot0, count(*) AS V FROM pt),
wt AS (SELECT token, ln((n1 + 1) / (tot1 + V)) - ln((n0 + 1) / (tot0 + V)) AS weight FROM pt, tot),
pr AS (SELECT ln(CAST(sum(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS DOUBLE)) - ln(CAST(sum(CASE WHEN toxic = 0 THEN 1 ELSE 0 END) AS DOUBLE)) AS prior
       FROM documents d JOIN labels l USING (doc_id)),
sc AS (SELECT d.doc_id, d.source, 1.0 / (1.0 + exp(prior + coalesce(s, 0.0))) AS p_clean
       FROM documents d LEFT JOIN (SELECT doc_id, sum(n * weight) AS s FROM tok JOIN wt USING (token) GROUP BY doc_id) x USING (doc_id), pr)"""

SQL["sentiment_score"] = with_(_NB) + "SELECT doc_id, round(p_clean, 6) AS p_clean, round(1.0 - p_clean, 6) AS sentiment FROM sc"

SQL["keyword_sentiment"] = with_(_NB) + """
SELECT source AS current_keyword, round(sum(1.0 - p_clean), 6) AS sentiment, count(*) AS n_docs FROM sc GROUP BY source"""

# --- streaming (compared with the batch definitions) -------------------------------------

SQL["stream_hour_issue"] = with_(KW_POSTS) + """
SELECT created_at, current_keyword,
       round(CAST(viewed AS DOUBLE) + ln(1 + liked) + ln(1 + num_of_comments), 6) AS current_issueization,
       num_of_comments, viewed, liked, round(sentiment, 6) AS sentiment,
       created_at + INTERVAL 1 HOUR <= (SELECT max(created_at) FROM kw_posts) - INTERVAL 1 HOUR AS closed
FROM (
  SELECT file_create_time AS created_at, current_keyword,
         CAST(sum(num_of_comments) AS BIGINT) AS num_of_comments,
         CAST(sum(viewed) AS BIGINT) AS viewed, CAST(sum(liked) AS BIGINT) AS liked,
         CAST(sum(sentiment) AS DOUBLE) AS sentiment
  FROM (SELECT unnest(keywords) AS current_keyword, * FROM kw_posts)
  GROUP BY ALL
)"""

SQL["stream_dedupe"] = with_(KW_POSTS) + """
SELECT DISTINCT file_create_time AS snapshot, data_source, url, 1 AS n_rows FROM kw_posts"""

SQL["stream_snapshot_gate"] = with_(KW_POSTS) + """
SELECT file_create_time AS snapshot, count(DISTINCT data_source) AS n_sources
FROM kw_posts GROUP BY file_create_time HAVING count(DISTINCT data_source) >= 4"""

SQL["stream_stages"] = with_(KW_POSTS) + """
SELECT event_id, unnest(keywords) AS current_keyword, file_create_time,
       round(CAST(viewed AS DOUBLE) + ln(1 + liked) + ln(1 + num_of_comments), 6) AS current_issueization
FROM kw_posts"""

SQL["stream_compact"] = with_(KW_POSTS) + """
SELECT strftime(file_create_time, '%Y-%m-%dT%H-%M-%S') AS snapshot_key, data_source, url,
       strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at, viewed, event_type AS title
FROM kw_posts WHERE event_id % 17 <> 3"""

SQL["stream_compact_quarantine"] = """
SELECT '{"broken":"' || CAST(event_id AS VARCHAR) AS value FROM events WHERE event_id % 17 = 3"""

SQL["raw_data_two_snapshots"] = with_(KW_POSTS) + """
SELECT CAST(file_create_time AS DATE) AS snapshot_date, CAST(hour(file_create_time) AS INTEGER) AS snapshot_hour,
       count(*) AS n_rows, sum(viewed) AS sum_viewed
FROM kw_posts GROUP BY ALL"""

SQL["tolerant_json_quarantine"] = """
SELECT CASE WHEN turn % 9 = 4 THEN substr(j, 1, length(j) - 3)
            ELSE hex(encode(substr(j, 1, length(j) - 1) || ',"x":"')) || 'FFFE' || hex(encode('"}')) END AS line
FROM (SELECT '{"conv_id":' || conv_id || ',"turn":' || turn || ',"role":"' || role || '","n":' || length(text) || '}' AS j, turn FROM conversations)
WHERE turn % 9 = 4 OR (turn % 13 = 6 AND turn % 11 <> 7)"""

SITE_POSTS = RAW_THREADS + """,
site_posts AS (
  SELECT p.doc_id, src, CASE WHEN p.doc_id % 23 = 0 THEN 'reddit' ELSE src END AS data_source, p.content, p.created_at,
         p.viewed, p.liked, p.n, p.k_last, '제목 ' || p.doc_id AS title,
         CASE src WHEN 'dc' THEN strftime(p.created_at, '%Y.%m.%d %H:%M:%S') WHEN 'naver' THEN strftime(p.created_at, '%Y.%m.%d. %H:%M')
                  WHEN 'bobae' THEN strftime(p.created_at, '%y.%m.%d  %H:%M') ELSE strftime(p.created_at, '%Y-%m-%d  %H:%M:%S') END AS created_text
  FROM (SELECT *, ['dc','naver','bobae','clien'][CAST(doc_id % 4 AS INTEGER) + 1] AS src FROM posts) p
)"""

SQL["normalise_posts"] = with_(SITE_POSTS) + f"""
SELECT doc_id, data_source, CASE src WHEN 'bobae' THEN title || ' ' ELSE title END AS title,
       CASE WHEN src = 'dc' THEN {s_chain('content', 'dc')} ELSE {s_chain('content', 'naver')} END AS content,
       strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, viewed,
       CASE WHEN src = 'naver' THEN CAST(trunc((liked + 0.5) * 1000) AS BIGINT) WHEN src = 'clien' AND doc_id % 5 = 2 THEN 1000 + liked ELSE liked END AS liked,
       CASE WHEN src IN ('dc', 'naver') THEN doc_id % 11 ELSE n END AS num_of_comments,
       CASE WHEN k_last IS NOT NULL THEN created_at + to_minutes(k_last * 97) END AS last_comment_at
FROM site_posts WHERE doc_id % 23 <> 0 AND doc_id % 29 <> 0 AND doc_id % 31 <> 0"""

SQL["stream_normalise"] = SQL["normalise_posts"]

SQL["normalise_quarantine"] = with_(SITE_POSTS) + """
SELECT doc_id, data_source, CASE WHEN doc_id % 29 = 0 THEN 'garbage' ELSE created_text END AS created_at,
       CASE WHEN doc_id % 31 = 0 THEN 'many' WHEN src = 'naver' THEN '조회 ' || viewed ELSE CAST(viewed AS VARCHAR) END AS viewed,
       CASE WHEN doc_id % 23 = 0 THEN 'unknown source' WHEN doc_id % 29 = 0 THEN 'failed date' ELSE 'failed number' END AS reason
FROM site_posts WHERE doc_id % 23 = 0 OR doc_id % 29 = 0 OR doc_id % 31 = 0"""

SQL["issue_pipeline"] = SQL["dense_keyword_issue"]
SQL["dense_keyword_issue_from_sums"] = SQL["dense_keyword_issue"]

SQL["stream_sentiment"] = SQL["sentiment_score"]

SQL["stream_keywords"] = SQL["document_keywords"]

SQL["raw_snapshot_pipeline"] = f"""
SELECT 'd/' || doc_id AS url, data_source, title, content, created_at, viewed, liked, num_of_comments, 'm' AS model
FROM ({SQL["normalise_posts"]})"""

# the posts up to the newest snapshot of all sources, and of them those that the gate keeps: of
# one snapshot, source and url the newest
_GATED = KW_POSTS.replace("kw_posts AS (", "every_post AS (", 1) + """,
arrived AS (SELECT * FROM every_post WHERE file_create_time <= (
  SELECT max(file_create_time) FROM (SELECT file_create_time FROM every_post GROUP BY file_create_time HAVING count(DISTINCT data_source) = 4))),
kw_posts AS (SELECT * FROM arrived QUALIFY row_number() OVER (PARTITION BY file_create_time, data_source, url ORDER BY created_at DESC, event_id DESC) = 1)"""

SQL["stream_alert"] = _SIM.replace(KW_POSTS, _GATED, 1).replace(PAST_ISSUE, PAST_ISSUE.replace("FROM kw_posts", "FROM arrived")) + """,
f AS (SELECT current_keyword, ln(sum(current_issueization) + 1) AS tf FROM current_issue GROUP BY current_keyword)
SELECT current_keyword, past_issue_name, round(s * tf, 6) AS alert_value
FROM f JOIN sim USING (current_keyword) ORDER BY s * tf DESC, current_keyword, past_issue_name LIMIT 1"""
