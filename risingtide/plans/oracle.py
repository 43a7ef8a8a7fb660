"""Independent SQL statements of the registered queries, for DuckDB.

Each statement recomputes a query from the raw driver tables (views named
after them), written directly in SQL and not generated from the Spark plan.
Column names and types are the ones the Spark query returns.
"""

from __future__ import annotations

import datetime as _dt
import re

from risingtide.params import DRIVER_PARAMS, MISSING_TEXT, ScreenParams

P = DRIVER_PARAMS


def _d(x) -> str:
    return f"DATE '{x.isoformat()}'"


def _inf_by_sign(x: str) -> str:
    return (f"CASE WHEN {x} > 0 THEN CAST('Infinity' AS DOUBLE) "
            f"WHEN {x} < 0 THEN CAST('-Infinity' AS DOUBLE) ELSE NULL END")


def bars_cte(p: ScreenParams = P, windowed: bool = True) -> str:
    where = "user_id IS NOT NULL"
    if windowed:
        hi = p.end_date.toordinal() + 1
        hi_d = _dt.date.fromordinal(hi)
        where += (f" AND ts >= TIMESTAMP '{p.start_date.isoformat()} 00:00:00'"
                  f" AND ts < TIMESTAMP '{hi_d.isoformat()} 00:00:00'")
    return f"""bars AS (
  SELECT symbol, date, CASE WHEN isnan(c) THEN NULL ELSE c END AS close
  FROM (SELECT user_id AS symbol, CAST(ts AS DATE) AS date, max_by(value, (ts, event_id)) AS c
        FROM events WHERE {where}
        GROUP BY user_id, CAST(ts AS DATE)) g)"""


def scored_cte(p: ScreenParams = P, source: str = "bars") -> str:
    return f"""pct AS (
  SELECT symbol, date, close,
         CASE WHEN close IS NULL OR prev IS NULL THEN NULL
              WHEN prev <> 0 THEN (close / prev - 1) * 100
              ELSE {_inf_by_sign('close')} END AS percent
  FROM (SELECT symbol, date, close,
               lag(close) OVER (PARTITION BY symbol ORDER BY date) AS prev
        FROM {source}) l),
scored AS (
  SELECT symbol, date, close, percent, last_price, last_percent, up_days,
         CASE WHEN first_close IS NULL OR last_price IS NULL THEN NULL
              WHEN first_close <> 0 THEN (last_price - first_close) / first_close * 100
              ELSE {_inf_by_sign('last_price - first_close')} END AS start_end_percent
  FROM (SELECT *, first_value(close) OVER w AS first_close,
               last_value(close) OVER w AS last_price,
               last_value(percent) OVER w AS last_percent,
               CAST(count_if(percent > {p.up_day_percent}) OVER w AS BIGINT) AS up_days
        FROM pct
        WINDOW w AS (PARTITION BY symbol ORDER BY date
                     ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) s)"""


def screen_cte(p: ScreenParams = P) -> str:
    return f"""screen AS (
  SELECT symbol, last_price, last_percent, start_end_percent FROM scored
  WHERE percent > {p.up_day_percent} AND up_days >= {p.min_up_days}
    AND start_end_percent > {p.min_period_gain})"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SQL: dict[str, str] = {}

SQL["momentum_screen"] = with_(bars_cte(), scored_cte(), screen_cte()) + "SELECT * FROM screen"

# ------------------------------------------------------------------ sources

NEWS = """news AS (
  SELECT CAST(floor(page_id / 6) AS BIGINT) AS symbol, page_id AS article_id,
         CAST(DATE '2024-01-15' + CAST((page_id % 6) * 3 AS INTEGER) AS DATE) AS published,
         nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title,
         url AS article_url
  FROM pages)"""


def top_cte(p: ScreenParams = P, symbols: str | None = None) -> str:
    semi = f" AND symbol IN (SELECT symbol FROM {symbols})" if symbols else ""
    return f"""top3 AS (
  SELECT symbol, article_id, published, news_rank, title AS news_data,
         article_url AS news_source
  FROM (SELECT *, CAST(row_number() OVER (PARTITION BY symbol
                     ORDER BY published DESC, article_id) AS INTEGER) AS news_rank
        FROM news
        WHERE published BETWEEN {_d(p.start_date)} AND {_d(p.end_date)}{semi}) r
  WHERE news_rank <= {p.news_per_symbol})"""


FUND = """fund AS (
  SELECT c_custkey AS symbol, coalesce(c_name, '') AS company_overview,
         CAST(round_even(coalesce(c_acctbal, 0.0), 0) AS BIGINT) AS marketCap
  FROM customer)"""

SQL["universe_scan"] = "SELECT c_custkey AS symbol FROM customer WHERE c_nationkey < 15"
SQL["universe_union"] = ("SELECT c_custkey AS symbol FROM customer WHERE c_nationkey < 15 "
                         "UNION ALL SELECT c_custkey AS symbol FROM customer WHERE c_nationkey >= 10")
SQL["price_window_scan"] = with_(bars_cte()) + "SELECT * FROM bars"
SQL["price_scan_for_universe"] = with_(bars_cte()) + """SELECT * FROM bars
WHERE symbol IN (SELECT c_custkey FROM customer WHERE c_nationkey < 15
                 UNION ALL SELECT c_custkey FROM customer WHERE c_nationkey >= 10)"""
SQL["bars_union"] = """SELECT symbol, date, CASE WHEN isnan(c) THEN NULL ELSE c END AS close,
       CASE WHEN date >= DATE '2024-01-26' THEN n END AS n_ticks
FROM (SELECT user_id AS symbol, CAST(ts AS DATE) AS date, max_by(value, (ts, event_id)) AS c, count(*) AS n
      FROM events WHERE user_id IS NOT NULL AND ts >= TIMESTAMP '2024-01-20 00:00:00'
        AND ts < TIMESTAMP '2024-01-31 00:00:00'
      GROUP BY 1, 2) g"""
SQL["parse_date"] = ("SELECT event_id, TRY_CAST(substr(CAST(ts AS VARCHAR), 1, 10) AS DATE) AS date "
                     "FROM events")
SQL["cap_filter"] = with_(FUND) + f"SELECT * FROM fund WHERE coalesce(marketCap, 0) > {P.min_market_cap}"
SQL["json_defaults"] = """SELECT event_id,
  coalesce(json_extract_string(props, '$.results.description'), '') AS company_overview,
  CAST(round_even(coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0), 0) AS BIGINT)
    AS marketCap
FROM events"""
SQL["news_top3"] = with_(NEWS, top_cte()) + "SELECT * FROM top3"

# ------------------------------------------------------------------ momentum

_M = with_(bars_cte(), scored_cte())
SQL["pct_change"] = _M + "SELECT symbol, date, close, percent FROM pct"
SQL["start_end_percent"] = _M + "SELECT symbol, date, close, start_end_percent FROM scored"
SQL["last_values"] = _M + "SELECT symbol, date, last_price, last_percent FROM scored"
SQL["up_days"] = _M + f"SELECT symbol, date, close, percent FROM pct WHERE percent > {P.up_day_percent}"
SQL["upside_counts"] = _M + f"""SELECT symbol, count(*) AS up_days FROM pct
WHERE percent > {P.up_day_percent} GROUP BY symbol HAVING count(*) >= {P.min_up_days}"""
SQL["repetitive_up_days"] = _M + f"""SELECT symbol, date, close, percent, up_days FROM scored
WHERE percent > {P.up_day_percent} AND up_days >= {P.min_up_days}"""
SQL["latest_day_screen"] = _M + f"""SELECT symbol, date, close, percent, last_price, last_percent,
       start_end_percent FROM scored WHERE last_percent > {P.up_day_percent}"""
SQL["distinct_symbols"] = with_(bars_cte(), scored_cte(), screen_cte()) + \
    "SELECT DISTINCT symbol FROM screen"

# ------------------------------------------------------------------ sectors / joins

SURVIVORS = [bars_cte(), scored_cte(), screen_cte(), FUND,
             "per_symbol AS (SELECT DISTINCT * FROM screen)",
             f"""ov AS (SELECT * FROM fund WHERE symbol IN (SELECT symbol FROM per_symbol)
                 AND coalesce(marketCap, 0) > {P.min_market_cap})""",
             """sec AS (SELECT DISTINCT c_custkey AS symbol, c_mktsegment AS core_focus FROM customer
                  WHERE c_custkey IN (SELECT symbol FROM ov))""",
             """shared AS (SELECT core_focus FROM sec
                  WHERE symbol IS NOT NULL AND core_focus IS NOT NULL
                  GROUP BY core_focus HAVING count(DISTINCT symbol) >= 2)"""]


def facts_cte(source: str = "shared") -> str:
    return f"""facts AS (
  SELECT core_focus,
         'Companies selling mainly to the ' || lower(core_focus) || ' segment' AS core_focus_overview,
         core_focus <> 'HOUSEHOLD' AS is_core_focus_future_potential,
         'Demand in the ' || lower(core_focus) || ' segment keeps growing'
           AS core_focus_future_potential_overview
  FROM {source})"""


ROWS = """rows AS (
  SELECT sec.symbol, sec.core_focus, f.core_focus_overview, f.is_core_focus_future_potential,
         f.core_focus_future_potential_overview, ov.company_overview, ov.marketCap,
         p.last_price, p.last_percent, p.start_end_percent
  FROM sec JOIN facts f ON sec.core_focus = f.core_focus
  JOIN ov ON ov.symbol = sec.symbol JOIN per_symbol p ON p.symbol = sec.symbol
  WHERE f.is_core_focus_future_potential = TRUE)"""

NEWS_AGG = """news_agg AS (
  SELECT symbol, string_agg(d, '***' ORDER BY r) AS news_data,
         string_agg(s, '***' ORDER BY r) AS news_source
  FROM (SELECT symbol, coalesce(news_data, 'no data') AS d,
               coalesce(news_source, 'no data') AS s, min(news_rank) AS r
        FROM top3 GROUP BY 1, 2, 3) q
  GROUP BY symbol)"""

SQL["sector_nunique"] = """SELECT s.core_focus, s.symbol, c.core_focus_count
FROM (SELECT c_custkey AS symbol, c_mktsegment AS core_focus FROM customer) s
JOIN (SELECT c_mktsegment AS core_focus, count(DISTINCT c_custkey) AS core_focus_count FROM customer
      WHERE c_custkey IS NOT NULL AND c_mktsegment IS NOT NULL GROUP BY 1) c
  ON s.core_focus = c.core_focus"""
SQL["shared_sectors"] = with_(*SURVIVORS) + "SELECT core_focus FROM shared"
SQL["future_sectors"] = with_("segs AS (SELECT DISTINCT c_mktsegment AS core_focus FROM customer)",
                              facts_cte("segs")) + \
    "SELECT * FROM facts WHERE is_core_focus_future_potential = TRUE"
SQL["sector_join"] = with_(*SURVIVORS, facts_cte()) + """SELECT sec.core_focus, sec.symbol,
  f.core_focus_overview, f.is_core_focus_future_potential, f.core_focus_future_potential_overview
FROM sec JOIN facts f ON sec.core_focus = f.core_focus WHERE f.is_core_focus_future_potential = TRUE"""
SQL["news_left_join"] = with_(*SURVIVORS, NEWS, top_cte(symbols="ov")) + f"""
SELECT ov.symbol, coalesce(ov.company_overview, '{MISSING_TEXT}') AS company_overview, ov.marketCap,
       t.news_rank, coalesce(t.news_data, '{MISSING_TEXT}') AS news_data,
       coalesce(t.news_source, '{MISSING_TEXT}') AS news_source
FROM ov LEFT JOIN top3 t ON ov.symbol = t.symbol"""
SQL["enriched_rows"] = with_(*SURVIVORS, facts_cte(), ROWS) + "SELECT * FROM rows"
SQL["news_concat"] = with_(NEWS, top_cte(), NEWS_AGG) + "SELECT * FROM news_agg"
SQL["alert_report"] = with_(*SURVIVORS, facts_cte(), ROWS, NEWS, top_cte(symbols="ov"), NEWS_AGG) + f"""
SELECT r.symbol, coalesce(n.news_source, '{MISSING_TEXT}') AS news_source,
       coalesce(n.news_data, '{MISSING_TEXT}') AS news_data, r.core_focus,
       r.core_focus_overview, r.is_core_focus_future_potential,
       r.core_focus_future_potential_overview, r.company_overview, r.marketCap,
       r.last_price, r.last_percent, r.start_end_percent
FROM rows r LEFT JOIN news_agg n ON r.symbol = n.symbol"""
SQL["fundamentals_lookup"] = with_(*SURVIVORS) + "SELECT * FROM ov"

# ------------------------------------------------------------------ text, labels, report

SQL["bad_record_split"] = """
SELECT 'events' AS source, event_id AS record_id, CAST(0 AS BIGINT) AS part,
       CASE WHEN json_valid(props) AND json_type(props) = 'OBJECT' THEN 'ok' ELSE 'rejected' END AS status
FROM events
UNION ALL
SELECT 'conversations', conv_id, turn,
       CASE WHEN json_valid(text) AND json_type(text) = 'OBJECT' THEN 'ok' ELSE 'rejected' END
FROM conversations"""
SQL["prompt_batches"] = with_(FUND) + f"""
SELECT TRUE AS within_bound, symbol, company_overview FROM fund WHERE coalesce(marketCap, 0) > {P.min_market_cap}"""
# Replies around the sector labels (good, with text after the array, two
# arrays, cut off, a key of another type) and conversation turns, built here
# as text and parsed from that text.
_REPLIES = r"""replies AS (
  SELECT CAST(batch_id AS VARCHAR) AS batch_key, n AS n_records,
         CASE batch_id % 6
           WHEN 0 THEN 'Sure. Here are the labels:' || chr(10) || arr || chr(10) || 'Anything else?'
           WHEN 1 THEN arr || ' Let me know [if] you need more.'
           WHEN 2 THEN arr || ' and then ' || arr
           WHEN 3 THEN 'Labels: ' || substr(arr, 1, CAST(length(arr) / 2 AS BIGINT))
           WHEN 4 THEN 'Labels: ' || replace(arr, '"symbol":', '"symbol":"no. ","id":')
           ELSE arr END AS reply
  FROM (SELECT CAST(floor(c_custkey / 100) AS BIGINT) AS batch_id, count(*) AS n,
               '[' || string_agg('{"symbol":' || c_custkey || ',"core_focus":"' || c_mktsegment || '"}', ','
                                 ORDER BY c_custkey) || ']' AS arr
        FROM customer GROUP BY 1) b
  UNION ALL
  SELECT conv_id || ':' || turn, 1, text FROM conversations),
spans AS (
  SELECT batch_key, n_records, reply,
         CASE WHEN strpos(reply, '[') > 0
                   AND length(reply) - strpos(reverse(reply), ']') + 1 >= strpos(reply, '[') AND strpos(reply, ']') > 0
              THEN substr(reply, strpos(reply, '['),
                          length(reply) - strpos(reverse(reply), ']') + 2 - strpos(reply, '[')) END AS span
  FROM replies),
checked AS (
  SELECT batch_key, n_records,
         CASE WHEN span IS NOT NULL AND json_valid(span) AND json_type(CASE WHEN json_valid(span) THEN span END) = 'ARRAY'
              THEN span END AS arr
  FROM spans),
items AS (
  SELECT batch_key, TRY_CAST(json_extract(x, '$.symbol') AS BIGINT) AS sym, json_type(json_extract(x, '$.symbol')) AS kind,
         json_extract_string(x, '$.core_focus') AS core_focus
  FROM (SELECT batch_key, unnest(CAST(json_extract(arr, '$[*]') AS JSON[])) AS x FROM checked WHERE arr IS NOT NULL) u)
"""
SQL["extract_json_array"] = "WITH " + _REPLIES + """
SELECT sym AS symbol, core_focus FROM items WHERE kind IN ('UBIGINT', 'BIGINT')"""
SQL["reply_rejects"] = "WITH " + _REPLIES + """
SELECT batch_key, CAST(n_records AS INTEGER) AS n_records, 'no JSON array of objects' AS reason, CAST(n_records AS INTEGER) AS n_lost
FROM checked WHERE arr IS NULL
UNION ALL
SELECT c.batch_key, CAST(c.n_records AS INTEGER), 'element without a valid key', CAST(count(*) AS INTEGER)
FROM checked c JOIN items i ON c.batch_key = i.batch_key
WHERE i.kind IS NULL OR i.kind NOT IN ('UBIGINT', 'BIGINT') GROUP BY 1, 2"""
SQL["canonical_labels"] = r"""WITH words AS (
  SELECT regexp_replace(w, '[.,;:!?()"]', '', 'g') AS label
  FROM (SELECT unnest(regexp_split_to_array(text, '\s+')) AS w FROM documents) t),
per_label AS (
  SELECT label, count(*) AS label_count,
         lower(regexp_replace(regexp_replace(trim(label), '\s*-\s*', '-', 'g'), '\s+', ' ', 'g')) AS k
  FROM words WHERE label <> '' GROUP BY label),
canon AS (SELECT k, arg_min(label, (-label_count, label)) AS canonical_label FROM per_label GROUP BY k)
SELECT p.label, c.canonical_label, p.label_count FROM per_label p JOIN canon c ON p.k = c.k"""
SQL["fuzzy_labels"] = r"""WITH RECURSIVE words AS (
  SELECT regexp_replace(w, '[.,;:!?()"]', '', 'g') AS label
  FROM (SELECT unnest(regexp_split_to_array(text, '\s+')) AS w FROM documents) t),
per_label AS (
  SELECT label, count(*) AS label_count,
         lower(regexp_replace(regexp_replace(trim(label), '\s*-\s*', '-', 'g'), '\s+', ' ', 'g')) AS k
  FROM words WHERE label <> '' GROUP BY label),
keys AS (SELECT DISTINCT k FROM per_label),
rests AS (
  SELECT k, i, k[:i - 1] || k[i + 1:] AS rest
  FROM (SELECT k, unnest(range(1, length(k) + 1)) AS i FROM keys WHERE length(k) >= 12)),
near AS (
  SELECT a.k AS u, b.k AS v FROM rests a JOIN rests b ON a.i = b.i AND a.rest = b.rest AND a.k <> b.k
  UNION SELECT r.k, keys.k FROM rests r JOIN keys ON keys.k = r.rest AND length(keys.k) >= 12
  UNION SELECT keys.k, r.k FROM rests r JOIN keys ON keys.k = r.rest AND length(keys.k) >= 12),
near1 AS (SELECT u, v FROM near WHERE levenshtein(u, v) <= 1 OR length(u) <> strlen(u) OR length(v) <> strlen(v)),
reach AS (SELECT k AS u, k AS v FROM keys UNION SELECT reach.u, near1.v FROM reach JOIN near1 ON reach.v = near1.u),
root AS (SELECT u AS k, min(v) AS root FROM reach GROUP BY u),
canon AS (SELECT root, arg_min(label, (-label_count, label)) AS canonical_label
          FROM per_label JOIN root USING (k) GROUP BY root)
SELECT label, canonical_label, label_count FROM per_label JOIN root USING (k) JOIN canon USING (root)"""
SQL["label_quality"] = r"""SELECT conv_id, turn, n_words, n_words <= 3 AS within_limit
FROM (SELECT conv_id, turn,
             CAST(CASE WHEN trim(text) = '' THEN 0
                       ELSE len(regexp_split_to_array(trim(text), '\s+')) END AS INTEGER) AS n_words
      FROM conversations) t"""

_ALERT = with_(*SURVIVORS, facts_cte(), ROWS, NEWS, top_cte(symbols="ov"), NEWS_AGG) + \
    f""", alert AS (
SELECT r.symbol, coalesce(n.news_source, '{MISSING_TEXT}') AS news_source,
       coalesce(n.news_data, '{MISSING_TEXT}') AS news_data, r.core_focus,
       r.core_focus_overview, r.is_core_focus_future_potential,
       r.core_focus_future_potential_overview, r.company_overview, r.marketCap,
       r.last_price, r.last_percent, r.start_end_percent
FROM rows r LEFT JOIN news_agg n ON r.symbol = n.symbol)
"""
_WORDS = {"AUTOMOBILE": "רכב", "BUILDING": "בנייה", "FURNITURE": "ריהוט",
          "HOUSEHOLD": "משק בית", "MACHINERY": "מכונות", "no data": "אין נתונים"}


def _translated(col: str) -> str:
    """Each piece of a joined value by the dictionary."""
    case = "CASE x " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _WORDS.items()) + " ELSE x END"
    return f"array_to_string(list_transform(string_split({col}, '***'), lambda x: {case}), '***')"


_LOCAL = ["core_focus", "core_focus_overview", "core_focus_future_potential_overview", "company_overview", "news_data"]
SQL["localize_report"] = _ALERT + f"""
SELECT symbol, news_source, {", ".join(_LOCAL)},
       {", ".join(f"{_translated(c)} AS {c}_local" for c in _LOCAL)}
FROM alert"""
SQL["report_sections"] = _ALERT + f"""
SELECT core_focus, arg_min(core_focus_overview, symbol) AS core_focus_overview,
       arg_min(is_core_focus_future_potential, symbol) AS is_core_focus_future_potential,
       arg_min(core_focus_future_potential_overview, symbol) AS core_focus_future_potential_overview,
       count(*) AS n_stocks, '{P.end_date.isoformat()}' AS report_date
FROM alert GROUP BY core_focus"""
_ITEMS = """, parts AS (
  SELECT symbol, string_split(news_data, '***') AS ds, string_split(news_source, '***') AS ss FROM alert),
pairs AS (
  SELECT symbol, i, trim(ds[i]) AS d, trim(ss[i]) AS s
  FROM parts, LATERAL (SELECT unnest(range(1, least(len(ds), len(ss)) + 1)) AS i) r),
dedup AS (SELECT symbol, d, s, min(i) AS i FROM pairs GROUP BY symbol, d, s),
news_html AS (
  SELECT symbol, count(*) AS n_news,
         string_agg('<li><a href="' || esc(s) || '">' || esc(d) || '</a></li>', '' ORDER BY i) AS news_html
  FROM dedup GROUP BY symbol),
items AS (
  SELECT a.symbol, a.core_focus, a.company_overview, format('{:,}', a.marketCap) AS market_cap_text,
         a.last_price, round(a.last_percent, 2) AS last_percent_2,
         round(a.start_end_percent, 2) AS start_end_percent_2,
         CAST(coalesce(h.n_news, 0) AS INTEGER) AS n_news, coalesce(h.news_html, '') AS news_html
  FROM alert a LEFT JOIN news_html h ON a.symbol = h.symbol)
"""


def _num(x: str) -> str:
    return f"coalesce(format('{{:,.2f}}', {x}), '{MISSING_TEXT}')"


def _term(name: str, value: str) -> str:
    return f"'<dt>{name}</dt><dd>' || {value} || '</dd>'"


def _cell(name: str, value: str) -> str:
    return f"'<tr><th>{name}</th><td>' || {value} || '</td></tr>'"


def _escape(sql: str) -> str:
    """``esc(x)`` written out: the five characters HTML gives a meaning."""
    def one(m):
        x = m[1]
        for ch, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#39;")):
            x = f"replace({x}, '{ch}', '{entity}')"
        return x
    return re.sub(r"esc\(((?:[^()]|\([^()]*\))*)\)", one, sql)


_ITEMS = _escape(_ITEMS)
SQL["report_items"] = _ALERT + _ITEMS + "SELECT * FROM items"
_BODY = _escape(f"""
SELECT core_focus, 0 AS part, CAST(NULL AS BIGINT) AS symbol,
       '<section><h2>' || esc(core_focus) || '</h2><dl>' ||
       {_term("Stocks", "CAST(count(*) AS VARCHAR)")} ||
       {_term("Why it may grow", "esc(arg_min(core_focus_future_potential_overview, symbol))")} ||
       {_term("What it is", "esc(arg_min(core_focus_overview, symbol))")} || '</dl></section>' AS html
FROM alert GROUP BY core_focus
UNION ALL
SELECT core_focus, 1, symbol,
       '<article><table><caption>' || CAST(symbol AS VARCHAR) || '</caption>' ||
       {_cell("Gain in window, %", _num("start_end_percent_2"))} ||
       {_cell("Last day, %", _num("last_percent_2"))} ||
       {_cell("Last close, USD", _num("last_price"))} ||
       {_cell("Market value, USD", "market_cap_text")} ||
       '</table><ol>' || news_html || '</ol><blockquote>' || esc(company_overview) || '</blockquote></article>'
FROM items""")
SQL["report_html"] = _ALERT + _ITEMS + _BODY
SQL["report_document"] = _ALERT + _ITEMS + f""", body AS ({_BODY})
SELECT 0 AS block, CAST(NULL AS VARCHAR) AS core_focus, 0 AS part, CAST(NULL AS BIGINT) AS symbol,
       '<h1>Momentum digest, {P.end_date.isoformat()}</h1>' AS html
FROM alert HAVING count(*) > 0
UNION ALL
SELECT 1, core_focus, 0, CAST(NULL AS BIGINT), '<li>' || core_focus || '</li>' FROM alert GROUP BY core_focus
UNION ALL
SELECT 2, core_focus, part, symbol, html FROM body"""
# The streaming queries produce the same rows as their batch counterparts.
SQL["stream_daily_bars"] = SQL["price_window_scan"]
SQL["stream_daily_screen"] = SQL["momentum_screen"]
SQL["stateful_screen"] = SQL["momentum_screen"]
SQL["screen_from_store"] = SQL["momentum_screen"]
SQL["html_document"] = f"""WITH doc AS ({SQL["report_document"]})
SELECT html FROM doc
UNION ALL SELECT unnest(['<!DOCTYPE html><html><head><meta charset="utf-8"></head><body>', '<ul>', '</ul><main>',
                         '</main></body></html>']) FROM doc WHERE block = 0"""

# ------------------------------------------------------------------ inference, sinks, status

# The default keyword classifier: the most frequent run of 4+ letters of the
# whole text, lower-cased, ties to the smallest; "other" when there is none.
KEYWORD_SECTOR = r"""kw_words AS (
  SELECT doc_id, lower(w) AS word
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '\pL{4,}')) AS w
        FROM kw_input) t),
kw_best AS (
  SELECT doc_id, arg_min(word, (-n, word)) AS core_focus
  FROM (SELECT doc_id, word, count(*) AS n FROM kw_words GROUP BY 1, 2) c GROUP BY doc_id),
kw_labels AS (
  SELECT i.doc_id AS symbol, coalesce(b.core_focus, 'other') AS core_focus
  FROM kw_input i LEFT JOIN kw_best b ON i.doc_id = b.doc_id)"""

SQL["classify_batches"] = with_("kw_input AS (SELECT doc_id, text FROM documents)",
                                KEYWORD_SECTOR) + "SELECT * FROM kw_labels"
SQL["translate_groups"] = _ALERT + f"""
SELECT symbol, core_focus, {_translated("core_focus")} AS core_focus_local,
       {_translated("news_data")} AS news_data_local
FROM alert"""
SQL["report_write"] = f"""SELECT *, '{P.end_date.isoformat()}' AS run_date
FROM ({SQL["report_html"]}) h"""
SQL["run_status"] = _ALERT + f"""
SELECT '{P.end_date.isoformat()}' AS run_date,
       CASE WHEN count(*) = 0 THEN 'error' ELSE 'ok' END AS status,
       CASE WHEN count(*) = 0 THEN 'no relevant sectors' ELSE 'report written' END AS message,
       count(*) AS n_rows
FROM alert"""
SQL["daily_job_status"] = SQL["run_status"]

# The model-driven flow with the default predictors: the survivor's company
# text is the document with its id; sectors come from the keyword
# classifier, are canonicalised (T2), and shared ones get the describer's
# fixed facts (always future potential).
_INFERRED = [bars_cte(), scored_cte(), screen_cte(),
             """fund AS (
  SELECT c.c_custkey AS symbol, coalesce(d.text, '') AS company_overview,
         CAST(round_even(coalesce(c.c_acctbal, 0.0), 0) AS BIGINT) AS marketCap
  FROM customer c LEFT JOIN documents d ON d.doc_id = c.c_custkey)""",
             SURVIVORS[4], SURVIVORS[5],
             "kw_input AS (SELECT symbol AS doc_id, company_overview AS text FROM ov)",
             KEYWORD_SECTOR,
             r"""kw_canon AS (
  SELECT label, arg_min(label, (-n, label)) OVER (PARTITION BY k) AS canonical_label
  FROM (SELECT core_focus AS label, count(*) AS n,
               lower(regexp_replace(regexp_replace(trim(core_focus), '\s*-\s*', '-', 'g'),
                                    '\s+', ' ', 'g')) AS k
        FROM kw_labels WHERE core_focus IS NOT NULL GROUP BY core_focus) p)""",
             """sec AS (SELECT DISTINCT l.symbol, coalesce(c.canonical_label, l.core_focus) AS core_focus
  FROM kw_labels l LEFT JOIN kw_canon c ON l.core_focus = c.label)""",
             SURVIVORS[7],
             """facts AS (
  SELECT core_focus, 'Companies whose main business is ' || core_focus AS core_focus_overview,
         TRUE AS is_core_focus_future_potential,
         core_focus || ' keeps growing' AS core_focus_future_potential_overview
  FROM shared)""",
             ROWS, NEWS, top_cte(symbols="ov"), NEWS_AGG]
SQL["alert_report_inferred"] = with_(*_INFERRED) + f"""
SELECT r.symbol, coalesce(n.news_source, '{MISSING_TEXT}') AS news_source,
       coalesce(n.news_data, '{MISSING_TEXT}') AS news_data, r.core_focus,
       r.core_focus_overview, r.is_core_focus_future_potential,
       r.core_focus_future_potential_overview, r.company_overview, r.marketCap,
       r.last_price, r.last_percent, r.start_end_percent
FROM rows r LEFT JOIN news_agg n ON r.symbol = n.symbol"""


# ------------------------------------------------------------------ error paths, raw inputs

_DAY = f"'{P.end_date.isoformat()}'"
SQL["status_no_shared_sector"] = with_(*SURVIVORS) + f"""
SELECT {_DAY} AS run_date, 'error' AS status,
       CASE WHEN count(*) = 0 THEN 'no stock passed the screen' ELSE 'no sector is shared by two stocks' END AS message,
       CAST(0 AS BIGINT) AS n_rows FROM ov"""
SQL["status_no_future_sector"] = with_(*SURVIVORS) + f"""
SELECT {_DAY} AS run_date, 'error' AS status,
       CASE WHEN (SELECT count(*) FROM ov) = 0 THEN 'no stock passed the screen'
            WHEN count(*) = 0 THEN 'no sector is shared by two stocks'
            ELSE 'no shared sector has future potential' END AS message,
       CAST(0 AS BIGINT) AS n_rows FROM shared"""
SQL["status_after_failure"] = f"""
SELECT unnest([{_DAY}, '{(P.end_date + _dt.timedelta(days=1)).isoformat()}']) AS run_date, 'error' AS status,
       'ValueError: the describer is not available' AS message, CAST(0 AS BIGINT) AS n_rows,
       CAST(0 AS BIGINT) AS report_rows"""
SQL["status_after_attempts"] = _ALERT + f"""
SELECT {_DAY} AS run_date, 'ok' AS status, 'report written, attempt 3' AS message, count(*) AS n_rows, count(*) AS stocks FROM alert"""
SQL["model_rejects"] = with_("kw_input AS (SELECT item_id AS doc_id, text FROM benchmark)", KEYWORD_SECTOR) + """
SELECT symbol, CASE WHEN symbol % 6 IN (1, 2, 3, 4) THEN 'rejected' ELSE core_focus END AS core_focus,
       CAST((SELECT count(*) FROM kw_input WHERE doc_id % 6 IN (1, 2, 3, 4)) AS BIGINT) AS records_lost
FROM kw_labels"""
SQL["bars_from_replies"] = with_(bars_cte()) + f"""
SELECT symbol, date, close FROM bars
WHERE symbol % 5 <> 0 AND date BETWEEN {_d(P.start_date + _dt.timedelta(days=2))} AND {_d(P.end_date)}"""
SQL["news_from_replies"] = with_(NEWS) + f"""
SELECT symbol, article_id, published, news_rank, news_data, news_source FROM (
  SELECT symbol, pos - 1 AS article_id, published, title AS news_data, article_url AS news_source,
         CAST(row_number() OVER (PARTITION BY symbol ORDER BY published DESC, pos) AS INTEGER) AS news_rank
  FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY article_id) AS pos FROM news) n
  WHERE published BETWEEN {_d(P.start_date)} AND {_d(P.end_date)}) r
WHERE news_rank <= {P.news_per_symbol}"""
SQL["listing_scan"] = SQL["universe_union"]
SQL["good_and_bad_records"] = """
SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
       CASE WHEN event_id % 9 = 0 THEN '!' || props END AS raw_record
FROM events"""
SQL["canonical_sectors"] = r"""WITH spelled AS (
  SELECT c_custkey AS symbol, CASE c_custkey % 5 WHEN 0 THEN lower(c_mktsegment)
           WHEN 1 THEN '  ' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) ELSE c_mktsegment END AS label FROM customer),
per AS (SELECT label, count(*) AS n, lower(trim(label)) AS k FROM spelled GROUP BY label),
canon AS (SELECT k, arg_min(label, (-n, label)) AS core_focus FROM per GROUP BY k)
SELECT s.symbol, c.core_focus FROM spelled s JOIN canon c ON c.k = lower(trim(s.label))"""
SQL["localize_by_table"] = f"""
SELECT c_custkey AS symbol, c_mktsegment AS core_focus, {_translated("c_mktsegment")} AS core_focus_local FROM customer"""
SQL["report_from_lookups"] = SQL["alert_report"]

# ------------------------------------------------------------------ further signals

_HISTORY = """bars AS (
  SELECT symbol, date, CASE WHEN isnan(c) THEN NULL ELSE c END AS close, n AS n_ticks
  FROM (SELECT user_id AS symbol, CAST(ts AS DATE) AS date, max_by(value, (ts, event_id)) AS c, count(*) AS n
        FROM events WHERE user_id IS NOT NULL GROUP BY 1, 2) g)"""
SQL["volume_spike"] = with_(_HISTORY) + """SELECT symbol, date, n_ticks, avg_ticks, n_ticks / nullif(avg_ticks, 0) AS volume_ratio,
       coalesce(n_ticks / nullif(avg_ticks, 0) >= 2, false) AS is_spike
FROM (SELECT *, avg(n_ticks) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS avg_ticks
      FROM bars) t"""
SQL["volatility"] = with_(_HISTORY, scored_cte()) + """, frames AS (
  SELECT symbol, date, percent, list_filter(list(percent) OVER (PARTITION BY symbol ORDER BY date
           ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), lambda x: x IS NOT NULL AND isfinite(x)) AS f
  FROM pct),
means AS (SELECT *, len(f)::INT AS n_returns, list_reduce(list_prepend(0.0::DOUBLE, f), lambda a, x: a + x) / len(f) AS m FROM frames)
SELECT symbol, date, percent, n_returns,
       CASE WHEN n_returns > 1 THEN
         sqrt(list_reduce(list_prepend(0.0::DOUBLE, f), lambda a, x: a + (x - m) * (x - m)) / (n_returns - 1)) END AS volatility
FROM means"""
SQL["relative_strength"] = with_(_HISTORY) + f"""
, ends AS (SELECT {_d(P.end_date)} - (5 * k)::INT AS window_end FROM range(4) r(k)),
member AS (SELECT window_end, symbol, date, close FROM ends JOIN bars ON date BETWEEN window_end - {P.window_days} AND window_end),
gains AS (
  SELECT window_end, symbol, CASE WHEN o IS NULL OR c IS NULL THEN NULL WHEN o <> 0 THEN (c - o) / o * 100
           ELSE {_inf_by_sign("c - o")} END AS g
  FROM (SELECT DISTINCT window_end, symbol, first_value(close) OVER w AS o, last_value(close) OVER w AS c FROM member
        WINDOW w AS (PARTITION BY window_end, symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) t),
means AS (
  SELECT window_end, sum(floor(g * 1000000)::BIGINT)::DOUBLE / count(*) / 1000000 AS universe_mean
  FROM gains WHERE abs(g) < 1e12 GROUP BY window_end)
SELECT window_end, symbol, g AS start_end_percent, universe_mean, g - universe_mean AS relative_strength
FROM gains LEFT JOIN means USING (window_end)"""
SQL["bars_from_archive"] = with_(bars_cte(windowed=False)) + f""", listed AS (
  SELECT * FROM bars WHERE symbol IN (SELECT c_custkey FROM customer WHERE c_nationkey < 15))
SELECT symbol, date, close, NULL AS reason FROM listed
WHERE symbol % 5 <> 0 AND date BETWEEN {_d(P.start_date + _dt.timedelta(days=2))} AND {_d(P.end_date)}
UNION ALL
SELECT DISTINCT symbol, NULL::DATE, NULL::DOUBLE, CASE WHEN symbol % 5 = 0 THEN 'no list of bars' ELSE 'no date' END
FROM listed WHERE (symbol % 5 = 0 OR symbol % 7 = 0) AND date_trunc('month', date) BETWEEN
  date_trunc('month', {_d(P.start_date + _dt.timedelta(days=2))}) AND date_trunc('month', {_d(P.end_date)})"""
