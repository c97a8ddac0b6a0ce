"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

from .params import MIX_BUDGET_PERCENT, MIX_MAX_EPOCHS, MIX_SEED, MIX_WEIGHTS

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _weight(level: str) -> str:
    cases = " ".join(f"WHEN {level} = '{name}' THEN {w}" for name, w in MIX_WEIGHTS[level].items())
    return f"CASE {cases} ELSE 1 END" if cases else "1"


def _share(level: str, parents: str, given: str, out: str) -> str:
    """Water-filling of `given` (nodes with cap, w and b) among siblings."""
    part = f"PARTITION BY {parents}" if parents else ""
    order = f"{part} ORDER BY CASE WHEN w > 0 THEN cap / w ELSE 1e300 END, {level} NULLS FIRST"
    return f"""
{out}_a AS (SELECT *, coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
    sum(w) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_rest FROM {given}),
{out}_b AS (SELECT *, (w = 0 OR cap * w_rest <= (b - used) * w) AS is_full FROM {out}_a),
{out}_c AS (SELECT *, sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({part}) AS full_cap,
    sum(CASE WHEN is_full THEN 0 ELSE w END) OVER ({part}) AS open_w FROM {out}_b),
{out} AS (SELECT *, CASE WHEN is_full THEN cap ELSE ((b - full_cap) * w) // open_w END AS got FROM {out}_c)"""


MIXING = f"""
WITH docs AS (
  SELECT doc_id, CASE WHEN n <= 9 THEN 'web' WHEN n <= 14 THEN 'reference' WHEN n IS NOT NULL THEN 'forum' ELSE 'other' END AS domain,
    lang, source, n_tokens
  FROM (SELECT *, try_cast(substr(source, 4) AS INTEGER) AS n, CAST(len({_WORDS}) AS BIGINT) AS n_tokens FROM documents)),
leaf AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens, {_weight('source')} AS w,
    sum(n_tokens) * {MIX_MAX_EPOCHS} AS cap FROM docs GROUP BY ALL),
lang_in AS (SELECT domain, lang, sum(cap) AS cap, {_weight('lang')} AS w FROM leaf GROUP BY domain, lang),
domain_in AS (SELECT domain, sum(cap) AS cap, {_weight('domain')} AS w,
    (SELECT sum(tokens) FROM leaf) * {MIX_BUDGET_PERCENT} // 100 AS b FROM leaf GROUP BY domain),
{_share('domain', '', 'domain_in', 'by_domain')},
lang_b AS (SELECT l.*, d.got AS b FROM lang_in l JOIN by_domain d ON l.domain IS NOT DISTINCT FROM d.domain),
{_share('lang', 'domain', 'lang_b', 'by_lang')},
leaf_b AS (SELECT f.*, l.got AS b FROM leaf f JOIN by_lang l
    ON f.domain IS NOT DISTINCT FROM l.domain AND f.lang IS NOT DISTINCT FROM l.lang),
{_share('source', 'domain, lang', 'leaf_b', 'by_leaf')},
quota AS (SELECT domain, lang, source, tokens, got, CASE WHEN tokens = 0 THEN 0 ELSE least(got // tokens, {MIX_MAX_EPOCHS}) END AS epochs FROM by_leaf),
ranked AS (
  SELECT d.*, q.epochs, CASE WHEN q.got = 0 OR q.epochs = {MIX_MAX_EPOCHS} THEN -1 ELSE q.got - q.epochs * q.tokens END AS rest,
    sum(d.n_tokens) OVER (PARTITION BY d.domain, d.lang, d.source
      ORDER BY md5('{MIX_SEED}:' || CAST(q.epochs AS BIGINT) || ':' || coalesce(CAST(d.doc_id AS VARCHAR), '')) RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM docs d JOIN quota q ON d.domain IS NOT DISTINCT FROM q.domain AND d.lang IS NOT DISTINCT FROM q.lang AND d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, domain, lang, source, n_tokens, CAST(epochs + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies FROM ranked
"""

_RATIOS = (
    ("word_length", "word_chars", "n_words", 1000),
    ("symbols", "n_symbols", "word_chars", 10000),
    ("dup_lines", "n_dup_lines", "n_lines", 10000),
    ("repeats", "n_repeat_words", "n_words", 10000),
)
_each = " UNION ALL ".join(
    f"SELECT lang, source, {k} AS ratio, CASE WHEN {d} = 0 THEN 0 ELSE {scale} * {n} // {d} END AS v FROM judged WHERE NOT base_failed"
    for k, (_, n, d, scale) in enumerate(_RATIOS)
)


def _quartiles(keys: str) -> str:
    """Quartiles and spread of the values with all but their leading 7 bits cleared."""
    by = f"{keys}, ratio" if keys else "ratio"
    return f"""SELECT *, CASE WHEN ratio = 0 THEN q3 - q1 ELSE usual * least(size, 50 * n_some) // size END AS spread
  FROM (SELECT {by}, max(size) AS size, max(n_some) AS n_some, min(CASE WHEN 4 * upto >= size THEN v END) AS q1,
      min(CASE WHEN 4 * upto >= 3 * size THEN v END) AS q3, coalesce(min(CASE WHEN v > 0 AND 4 * (upto - size + n_some) >= n_some THEN v END), 0) AS usual
    FROM (SELECT *, count(*) OVER (PARTITION BY {by}) AS size, count(*) OVER (PARTITION BY {by} ORDER BY v) AS upto,
        count(*) FILTER (v > 0) OVER (PARTITION BY {by}) AS n_some FROM binned) GROUP BY {by})"""


QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents),
win AS (SELECT rid, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS w
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM d WHERE len(ws) >= 8)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS c FROM win) WHERE c >= 2),
cov AS (SELECT rid, sum(least(8, coalesce(nxt - i, 8))) AS n FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM rep) GROUP BY rid),
lines AS (SELECT rid, count(*) AS n, count(DISTINCT l) AS u FROM (SELECT rid, unnest(string_split(text, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid),
base AS (SELECT doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(lines.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(lines.n - lines.u, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN cov USING (rid) LEFT JOIN lines USING (rid)),
judged AS (SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed FROM base),
vals AS ({_each}),
binned AS (SELECT lang, source, ratio, CASE WHEN v < 128 THEN v ELSE (v >> (length(bin(v)) - 7)) << (length(bin(v)) - 7) END AS v FROM vals),
own AS ({_quartiles('lang, source')}),
bylang AS ({_quartiles('lang')}),
everything AS ({_quartiles('')}),
picked AS (SELECT o.lang, o.source, o.ratio,
    CASE WHEN o.size >= 100 THEN o.q1 WHEN l.size >= 100 THEN l.q1 ELSE e.q1 END AS q1,
    CASE WHEN o.size >= 100 THEN o.q3 WHEN l.size >= 100 THEN l.q3 ELSE e.q3 END AS q3,
    o.size, o.spread AS own, CASE WHEN l.size >= 100 THEN l.spread ELSE e.spread END AS typical, e.spread AS overall
  FROM own o JOIN bylang l ON o.lang IS NOT DISTINCT FROM l.lang AND o.ratio = l.ratio JOIN everything e ON o.ratio = e.ratio),
drawn AS (SELECT *, (size * own + 50 * typical) // (size + 50) AS d FROM picked),
spread AS (SELECT *, CASE WHEN ratio = 0 THEN 4 * greatest(d, typical, overall) ELSE 3 * d END AS s FROM drawn),
fence AS (SELECT lang, source, max(CASE WHEN ratio = 0 THEN q1 - s END) AS lo0,
    {', '.join(f'max(CASE WHEN ratio = {k} THEN q3 + s END) AS hi{k}' for k in range(4))} FROM spread GROUP BY lang, source)
SELECT j.doc_id, j.n_words, j.word_chars, j.n_symbols, j.n_dup_lines, j.n_repeat_words, j.base_failed,
  coalesce(NOT j.base_failed AND 1000 * word_chars // n_words >= lo0
    AND {' AND '.join(f'(CASE WHEN {d} = 0 THEN 0 ELSE {scale} * {n} // {d} END) <= hi{k}' for k, (_, n, d, scale) in enumerate(_RATIOS))}, false) AS kept
FROM judged j LEFT JOIN fence f ON j.lang IS NOT DISTINCT FROM f.lang AND j.source IS NOT DISTINCT FROM f.source
"""

SQL: dict[str, str] = {"op5_source_mixing": MIXING, "op6_quality_rules": QUALITY}
