"""The SQL counterpart of each query, over the same tables."""

from functools import reduce

from marketpulse.catalog.inputs import BROKEN, DAY, ENTITIES, NOT_TEXT, PRODUCTS, WHITE


def _half_up(value, digits):
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def _with(*parts, then):
    return "WITH " + ",\n".join(parts) + "\n" + then


# --- inputs ----------------------------------------------------------------------------

TICKS = """ticks AS (
  SELECT event_type AS symbol, value AS price, CAST(user_id AS DOUBLE) AS volume,
         value + 5.0 AS high, greatest(value - 5.0, 0.0) AS low, ts AS event_time,
         event_id AS seq, 0 AS part
  FROM events)"""
# What can be read of each tick message, and which of these are valid ticks.
MESSAGES = """messages AS (
  SELECT CASE WHEN cut THEN '{"symbol": "cut' END AS value, CASE WHEN NOT cut THEN event_type END AS symbol,
         CASE WHEN cut THEN NULL WHEN user_id % 47 = 11 THEN -1.0 ELSE value END AS price,
         CASE WHEN NOT cut THEN CAST(user_id AS DOUBLE) END AS volume,
         CASE WHEN NOT cut THEN value + 5.0 END AS high,
         CASE WHEN NOT cut THEN greatest(value - 5.0, 0.0) END AS low,
         CASE WHEN NOT cut AND user_id % 41 <> 7 THEN ts END AS event_time, event_id AS seq, 0 AS part, ts
  FROM (SELECT *, user_id % 37 = 3 AS cut FROM events))"""
VALID_MESSAGES = MESSAGES + """,
valid AS (SELECT * FROM messages WHERE price > 0 AND symbol IS NOT NULL AND event_time IS NOT NULL)"""
# The valid ticks, as silver keeps them.
VALID = TICKS + ",\nvalid AS (SELECT * FROM ticks WHERE price > 0)"

ITEMS = """numbered AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CAST(event_id % 500 + 1 AS INTEGER) AS feed_pos
  FROM events),
items AS (
  SELECT ts AS fetched_at, feed_pos, k AS id, event_type <> 'error' AS is_story,
         CASE WHEN k % 25 = 7 THEN '   '
              ELSE '  Story ' || k || ' by user ' || user_id || ' ' END AS title,
         CASE WHEN k % 10 IN (3, 4) THEN ''
              ELSE ' https://news.example.com/item/' || k END AS url,
         CASE WHEN user_id % 50 <> 0 THEN CAST(floor(value) AS INTEGER) ELSE 0 END AS score,
         CASE WHEN user_id % 40 <> 9 THEN 'user' || user_id ELSE 'unknown' END AS author,
         epoch_us(ts) // 1000000 AS seconds,
         user_id % 97 = 5 AS broken, event_id
  FROM numbered)"""

_BROKEN = f"list_extract([{', '.join(repr(b) for b in BROKEN)}], event_id % {len(BROKEN)} + 1)"
_BARE = reduce(lambda t, part: f"regexp_replace({t}, '{part}', ' ', 'g')", NOT_TEXT, "html")
_PLAIN = reduce(
    lambda t, e: f"replace({t}, '{e}', '{ENTITIES[e].replace(chr(39), chr(39) * 2)}')", ENTITIES, _BARE
)
PAGE_TEXT = f"trim(regexp_replace({_PLAIN}, '{WHITE}', ' ', 'g'))"

ITEMS_BY_DAY = ITEMS.replace("ts AS fetched_at", "date_trunc('day', ts) AS fetched_at")

EDITIONS = """articles AS (
  SELECT page_id, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(page_id * 13 AS INTEGER)) AS fetched_at,
         regexp_extract(url, '^https?://([^/?#]+)', 1) AS publisher,
         CASE WHEN page_id % 13 = 5 THEN '  '
              ELSE regexp_extract(html, '<title>([^<]*)</title>', 1) || ' - '
                   || regexp_extract(url, '^https?://([^/?#]+)', 1) END AS title,
         CASE WHEN page_id % 11 = 4 THEN '' ELSE ' ' || url END AS url,
         """ + PAGE_TEXT + """ AS description
  FROM pages),
editions AS (
  SELECT fetched_at, 1 AS feed_pos, title, description, url, publisher,
         strftime(fetched_at - INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS edition,
         fetched_at - INTERVAL 1 HOUR AS published_at
  FROM articles
  UNION ALL
  SELECT fetched_at, 2, 'Update: ' || title, description, url, publisher,
         CASE WHEN page_id % 7 = 2 THEN 'unknown'
              ELSE strftime(fetched_at, '%Y-%m-%dT%H:%M:%SZ') END,
         CASE WHEN page_id % 7 = 2 THEN NULL ELSE fetched_at END
  FROM articles)"""


def _story_versions(extra="TRUE"):
    return f"""story_versions AS (
  SELECT CAST(id AS VARCHAR) AS post_id, 'hackernews' AS source, trim(title) AS title,
         trim(url) AS url, score, author, CAST(NULL AS VARCHAR) AS description,
         make_timestamp(seconds * 1000000) AS published_at,
         CAST(fetched_at AS DATE) AS run_date, fetched_at,
         'HN_' || id || '_' || strftime(fetched_at, '%Y%m%d%H%M') AS load_id
  FROM items
  WHERE is_story AND NOT broken AND trim(url) <> '' AND trim(title) <> '' AND {extra})"""


STORIES = """stories AS (
  SELECT * FROM story_versions
  QUALIFY row_number() OVER (
    PARTITION BY run_date, post_id
    ORDER BY score DESC NULLS LAST, fetched_at DESC, load_id, title, url, author, published_at) = 1)"""


def _article_versions(extra="TRUE"):
    return f"""article_versions AS (
  SELECT 'NEWS_' || sha256(url) || '_' || strftime(fetched_at, '%Y%m%d%H%M') AS post_id,
         'news_api' AS source, trim(regexp_replace(title, ' - [^-]+$', '')) AS title,
         trim(url) AS url, 0 AS score, trim(publisher) AS author,
         trim(description) AS description, published_at,
         CAST(fetched_at AS DATE) AS run_date, fetched_at, edition
  FROM editions
  WHERE trim(url) <> '' AND trim(regexp_replace(title, ' - [^-]+$', '')) <> '' AND {extra})"""


def _fetched():
    return """fetched AS (
  SELECT CAST(fetched_at AS DATE) AS run_date, 'hackernews' AS source, url, title, score, fetched_at AS published_at
  FROM items WHERE is_story AND NOT broken
  UNION ALL
  SELECT CAST(fetched_at AS DATE), 'news_api', url, regexp_replace(title, ' - [^-]+$', ''), 0, published_at
  FROM editions)"""


NEWS = """news AS (
  SELECT * FROM article_versions
  QUALIFY row_number() OVER (
    PARTITION BY run_date, url
    ORDER BY edition DESC NULLS LAST, fetched_at DESC, post_id, title, author, description) = 1)"""

POST = "post_id, source, title, url, score, author, description, published_at, run_date"
POSTS = f"posts AS (SELECT {POST} FROM stories UNION ALL SELECT {POST} FROM news)"
ALL_POSTS = [ITEMS, EDITIONS, _story_versions(), STORIES, _article_versions(), NEWS, POSTS]


def _summary(where="TRUE"):
    return f"""summary AS (
  SELECT run_date AS report_date, source, count(*) AS total_articles,
         {_half_up("avg(score)", 1)} AS avg_score, max(score) AS max_score,
         arg_max(title, (score, coalesce(published_at, TIMESTAMP '0001-01-01'), post_id)) AS top_story
  FROM posts WHERE {where} GROUP BY 1, 2)"""


# --- shared results --------------------------------------------------------------------

_BARS = f"""SELECT symbol, date_trunc('minute', event_time) AS minute_bucket,
       arg_min(price, (event_time, seq)) AS open_price, max(price) AS high_price,
       min(price) AS low_price, arg_max(price, (event_time, seq)) AS close_price,
       {_half_up("avg(price)", 2)} AS avg_price, count(price) AS trade_count
FROM valid GROUP BY 1, 2"""

_AVERAGES = ", ".join(
    f"avg(price) FILTER (WHERE symbol = '{symbol}') AS {name}_avg_price"
    for name, symbol in PRODUCTS.items()
)
DAILY = f"daily AS (SELECT CAST(event_time AS DATE) AS report_date, {_AVERAGES} FROM valid GROUP BY 1)"
_CHANGE = _half_up(
    "(d.btc_avg_price - p.btc_avg_price) / nullif(p.btc_avg_price, 0) * 100", 2
)
PRICES = f"""prices AS (
  SELECT d.*, {_CHANGE} AS btc_price_change
  FROM daily d LEFT JOIN daily p ON p.report_date = d.report_date - 1)"""
HEADLINES = """headlines AS (
  SELECT report_date,
         max(top_story) FILTER (WHERE source = 'hackernews') AS top_hn_story,
         max(max_score) FILTER (WHERE source = 'hackernews') AS hn_max_score,
         CAST(sum(total_articles) FILTER (WHERE source = 'hackernews') AS BIGINT) AS total_articles,
         CAST(sum(total_articles) AS BIGINT) AS all_articles
  FROM summary GROUP BY 1)"""
_ROUNDED = ", ".join(
    f"{_half_up(f'{name}_avg_price', 6)} AS {name}_avg_price" for name in PRODUCTS
)
_INSIGHT = f"""top_hn_story, hn_max_score, total_articles, all_articles,
       {_ROUNDED}, btc_price_change"""


def _insights(*post_parts, where="TRUE"):
    return [*post_parts, _summary(where), VALID, DAILY, PRICES, HEADLINES]


def _one_day(parts):
    return _with(*parts, then=f"""SELECT DATE '{DAY}' AS report_date, {_INSIGHT}
FROM (SELECT 1) AS one
LEFT JOIN headlines h ON h.report_date = DATE '{DAY}'
LEFT JOIN prices p ON p.report_date = DATE '{DAY}'""")


def _money(column):
    return f"coalesce('$' || format('{{:,.2f}}', {_half_up(column, 2)}), 'N/A')"


# The labels of the report.
_REPORT = "\n       || ".join([
    "repeat('=', 60)",
    "chr(10) || 'Date          : ' || coalesce(h.report_date, p.report_date)",
    "chr(10) || 'Top HN Story  : ' || coalesce(top_hn_story, 'None')",
    "chr(10) || 'HN Score      : ' || coalesce(CAST(hn_max_score AS VARCHAR), 'None')",
    "chr(10) || 'Total Articles: ' || coalesce(CAST(total_articles AS VARCHAR), 'None')",
    f"chr(10) || 'BTC Avg Price : ' || {_money('btc_avg_price')}",
    f"chr(10) || 'ETH Avg Price : ' || {_money('eth_avg_price')}",
    f"chr(10) || 'SOL Avg Price : ' || {_money('sol_avg_price')}",
    "chr(10) || 'BTC Change    : ' || coalesce(regexp_replace(printf('%.2f', btc_price_change),"
    " '0$', '') || '%', 'N/A (need 2 days of data)')",
    "chr(10) || repeat('=', 60)",
])

_RANK = "score DESC NULLS LAST, published_at DESC NULLS LAST, post_id DESC"

# Prices, volumes and times of the frames that hold a usable ticker.
FRAMES = """frames AS (
  SELECT event_type AS symbol, value AS price,
         CAST(CASE WHEN user_id % 3 = 0 THEN user_id * 100 ELSE user_id * 10 END AS DOUBLE) AS volume,
         CASE WHEN user_id % 3 = 0 THEN value + 7.0 ELSE value + 5.0 END AS high,
         CASE WHEN user_id % 3 = 0 THEN value ELSE 0.0 END AS low,
         ts, event_id AS seq
  FROM events
  WHERE event_type <> 'error' AND user_id % 31 <> 4 AND user_id % 29 <> 6 AND value > 0)"""

# The messages that are not valid ticks.
_BAD = """SELECT CASE WHEN symbol IS NULL THEN 'unreadable' WHEN event_time IS NULL THEN 'no time'
            ELSE 'no price' END AS reason, seq
FROM messages WHERE symbol IS NULL OR event_time IS NULL OR price <= 0"""

# Late messages of the first part, which a stream of bars does not count.
_ON_TIME = "NOT (seq % 53 = 9 AND ts < TIMESTAMP '2024-01-10 00:00:30')"

ORACLE = {
    "shape_stories": _with(ITEMS, then="""SELECT date_trunc('day', fetched_at) AS fetched_at, feed_pos, id, title, url, score, author AS "by", seconds AS "time"
FROM items WHERE feed_pos <= 30 AND is_story AND NOT broken"""),
    "shape_articles": _with(EDITIONS, then="""SELECT fetched_at, feed_pos, title, description, url,
       publisher AS source, edition AS published_at FROM editions"""),
    "shape_article_page": f"""SELECT TIMESTAMP '2024-01-01 00:00:00' + to_seconds(page_id // 40 * 900) AS fetched_at,
       CAST(page_id % 40 + 1 AS INTEGER) AS feed_pos,
       regexp_extract(html, '<title>([^<]*)</title>', 1) || ' - ' || regexp_extract(url, '^https?://([^/?#]+)', 1) AS title,
       {PAGE_TEXT} AS description, url, regexp_extract(url, '^https?://([^/?#]+)', 1) AS source,
       strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(page_id * 13 AS INTEGER)), '%Y-%m-%dT%H:%M:%SZ') AS published_at
FROM pages WHERE page_id % 40 < 30""",
    "quarantine": _with(ITEMS, then=f"SELECT fetched_at, {_BROKEN} AS bad_text FROM items WHERE broken"),
    "normalize_frames": _with(FRAMES, then="""SELECT symbol, price, volume, high, low,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", seq FROM frames
WHERE symbol IN ('purchase', 'view', 'signup')"""),
    "parse_ticks": _with(MESSAGES, then="SELECT * EXCLUDE (ts) FROM messages"),
    "tick_quarantine": _with(MESSAGES, then=_BAD),
    "bronze_scan": _with(ITEMS, then=f"""SELECT 'HN_' || id || '_' || strftime(fetched_at, '%Y%m%d%H%M') AS load_id,
       'hackernews' AS source, 'story' AS content_type, fetched_at
FROM items WHERE is_story AND NOT broken AND CAST(fetched_at AS DATE) = DATE '{DAY}'"""),
    "silver_scan": _with(*ALL_POSTS, then=f"SELECT * FROM posts WHERE run_date = DATE '{DAY}'"),
    "prices_by_day": _with(VALID, then=f"""SELECT *, CAST(event_time AS DATE) AS event_date
FROM valid WHERE CAST(event_time AS DATE) = DATE '{DAY}'"""),
    "json_extract": """SELECT event_id, json_extract_string(props, '$.k') AS k_text,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_int, CAST(NULL AS VARCHAR) AS absent,
       CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k') END AS k_cut, CAST(NULL AS VARCHAR) AS id_null,
       CASE WHEN event_type <> 'error' THEN 7 END AS k_mixed, value AS v_double FROM events""",
    "to_json_roundtrip": """SELECT event_id,
       '{"id":"' || event_id || '","title":"it''s a \\"quoted\\" title","url":"' || event_type
       || '","score":"' || value || '"}' AS json,
       CAST(event_id AS VARCHAR) AS id, 'it''s a "quoted" title' AS title, event_type AS url,
       value AS score FROM events""",
    "clean_titles": """SELECT page_id, trim(regexp_replace('  '
       || regexp_extract(html, '<title>([^<]*)</title>', 1) || ' - '
       || regexp_extract(url, '^https?://([^/?#]+)', 1), ' - [^-]+$', '')) AS title FROM pages""",
    "epoch_to_timestamp": "SELECT event_id, date_trunc('second', ts) AS published_at FROM events",
    "try_ts": """SELECT event_id,
       CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS published_at FROM events""",
    "load_keys": _with(EDITIONS, then="""SELECT p.page_id,
       'HN_' || p.page_id || '_' || strftime(a.fetched_at, '%Y%m%d%H%M') AS story_key,
       'NEWS_' || sha256(p.url) || '_' || strftime(a.fetched_at, '%Y%m%d%H%M') AS article_key
FROM pages p JOIN articles a ON a.page_id = p.page_id"""),
    "dedup_stories": _with(ITEMS, _story_versions(), STORIES, then="""SELECT run_date, post_id, score,
       load_id, fetched_at FROM stories"""),
    "dedup_articles": _with(EDITIONS, _article_versions(), NEWS, then="""SELECT run_date, url, edition,
       post_id AS load_id, title FROM news"""),
    "silver_stories": _with(ITEMS, _story_versions(), STORIES, then=f"SELECT {POST} FROM stories"),
    "silver_articles": _with(EDITIONS, _article_versions(), NEWS, then=f"SELECT {POST} FROM news"),
    "silver_posts": _with(*ALL_POSTS, then="SELECT * FROM posts"),
    "source_counts": _with(*ALL_POSTS, then="SELECT run_date, source, count(*) AS total FROM posts GROUP BY 1, 2"),
    "quality_profile": _with(ITEMS, EDITIONS, _fetched(), then=f"""SELECT run_date, source, count(*) AS total_records,
       count(*) FILTER (WHERE trim(url) = '') AS missing_url,
       count(*) FILTER (WHERE trim(title) = '') AS missing_title,
       count(*) FILTER (WHERE published_at IS NULL) AS missing_date,
       {_half_up("avg(score)", 1)} AS avg_score, max(score) AS max_score
FROM fetched GROUP BY 1, 2"""),
    "top_stories": _with(*ALL_POSTS, then=f"""SELECT run_date AS report_date, source, title, url, score, author,
       CAST(published_at AS DATE) AS published_date,
       CAST(row_number() OVER (PARTITION BY run_date, source ORDER BY {_RANK}) AS INTEGER) AS rank
FROM posts QUALIFY rank <= 10"""),
    "source_summary": _with(*ALL_POSTS, _summary(), then="SELECT * FROM summary"),
    "top_orders": """SELECT o_orderpriority, o_orderkey, o_totalprice,
       CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey DESC) AS INTEGER) AS rank
FROM orders QUALIFY rank <= 10""",
    "run_audit": _with(*ALL_POSTS, then="""SELECT coalesce(f.run_date, l.run_date) AS run_date,
       coalesce(records_fetched, 0) AS records_fetched, coalesce(records_loaded, 0) AS records_loaded
FROM (SELECT run_date, count(*) AS records_fetched FROM (
        SELECT CAST(fetched_at AS DATE) AS run_date FROM items WHERE is_story AND NOT broken
        UNION ALL SELECT CAST(fetched_at AS DATE) FROM editions) GROUP BY 1) f
FULL JOIN (SELECT run_date, count(*) AS records_loaded FROM posts GROUP BY 1) l ON l.run_date = f.run_date"""),
    "ohlc_1m": _with(VALID, then=_BARS),
    "ohlc_latest": """SELECT event_type AS symbol, date_trunc('hour', ts) AS minute_bucket,
       arg_max(value, event_id) AS close_price FROM events GROUP BY 1, 2""",
    "symbol_daily_avg": _with(VALID, DAILY, then=f"SELECT report_date, {_ROUNDED} FROM daily"),
    "day_over_day": _with(VALID, DAILY, PRICES, then=f"""SELECT report_date,
       {_half_up("btc_avg_price", 6)} AS avg_price, btc_price_change AS price_change
FROM prices WHERE btc_avg_price IS NOT NULL"""),
    "daily_insights_all": _with(*_insights(*ALL_POSTS), then=f"""SELECT
       coalesce(h.report_date, p.report_date) AS report_date, {_INSIGHT}
FROM headlines h FULL JOIN prices p ON p.report_date = h.report_date"""),
    "daily_insights": _one_day(_insights(*ALL_POSTS)),
    "insight_empty_news": _one_day(_insights(*ALL_POSTS, where=f"run_date <> DATE '{DAY}'")),
    "insight_report": _with(*_insights(*ALL_POSTS), then=f"""SELECT
       coalesce(h.report_date, p.report_date) AS report_date,
       {_REPORT} AS report
FROM headlines h FULL JOIN prices p ON p.report_date = h.report_date"""),
    "daily_document": _with(ITEMS, EDITIONS, then="""SELECT coalesce(s.ds, a.ds) AS ds,
       '{"hackernews":[' || coalesce(s.texts, '') || '],"news":[' || coalesce(a.texts, '') || ']}' AS document
FROM (SELECT CAST(fetched_at AS DATE) AS ds,
             string_agg('{"id":' || id || ',"title":' || to_json(title) || ',"score":' || score || '}',
                        ',' ORDER BY feed_pos) AS texts
      FROM items WHERE feed_pos <= 10 AND NOT broken
      GROUP BY 1) s
FULL JOIN (SELECT ds, string_agg('{"title":' || to_json(title) || ',"source":' || to_json(publisher) || '}',
                                 ',' ORDER BY feed_pos) AS texts
           FROM (SELECT *, CAST(fetched_at AS DATE) AS ds,
                        max(fetched_at) OVER (PARTITION BY CAST(fetched_at AS DATE)) AS last_fetch
                 FROM editions)
           WHERE fetched_at = last_fetch GROUP BY 1) a ON a.ds = s.ds"""),
    "replace_day": _with(VALID, DAILY, then=f"SELECT report_date, {_ROUNDED} FROM daily"),
    "batch_day": _one_day([
        ITEMS_BY_DAY, EDITIONS,
        *_insights(_story_versions(), STORIES, _article_versions(), NEWS, POSTS),
    ]),
    "batch_quarantine": _with(ITEMS, then=f"""SELECT 'hackernews' AS feed, {_BROKEN} AS bad_text,
       date_trunc('day', fetched_at) AS fetched_at, DATE '{DAY}' AS run_date, 'run-1' AS run_id
FROM items WHERE broken AND CAST(fetched_at AS DATE) = DATE '{DAY}'"""),
    "audit_row": _with(ITEMS_BY_DAY, EDITIONS, _story_versions(), STORIES, _article_versions(), NEWS, POSTS, then=f"""
SELECT 'audited' AS run_id, TIMESTAMP '{DAY} 00:00:00' AS execution_date,
       (SELECT count(*) FROM items WHERE is_story AND NOT broken AND CAST(fetched_at AS DATE) = DATE '{DAY}')
       + (SELECT count(*) FROM editions WHERE CAST(fetched_at AS DATE) = DATE '{DAY}') AS records_fetched,
       (SELECT count(*) FROM posts WHERE run_date = DATE '{DAY}') AS records_loaded,
       'SUCCESS' AS status, TRUE AS in_order"""),
    "stream_bronze_ticks": _with(MESSAGES, then="""SELECT * EXCLUDE (ts), CAST(ts AS DATE) AS arrived_date
FROM messages"""),
    "stream_quarantine": _with(MESSAGES, then=_BAD),
    "stream_silver_prices": _with(FRAMES, then="""SELECT symbol, price, volume, high, low,
       ts AS event_time, CAST(ts AS DATE) AS event_date FROM frames"""),
    "stream_ohlc": _with(VALID_MESSAGES, then=_BARS),
    "stream_ohlc_final": _with(VALID_MESSAGES, then=_BARS),
    "stream_late": _with(
        VALID_MESSAGES.replace("valid AS (", "all_valid AS (") + f""",
valid AS (SELECT * FROM all_valid WHERE {_ON_TIME})""", then=_BARS),
    "bars_rebuilt": _with(VALID_MESSAGES, then=f"""SELECT * FROM ({_BARS})
WHERE CAST(minute_bucket AS DATE) = DATE '2024-01-05'"""),
}

# The bars that late messages belong to, with all their ticks and those in time.
_LATE = f"""SELECT symbol, date_trunc('minute', event_time) AS minute_bucket, count(*) AS in_silver,
       count(*) FILTER ({_ON_TIME}) AS in_bars, count(*) FILTER (NOT ({_ON_TIME})) AS missing
FROM valid GROUP BY 1, 2 HAVING count(*) FILTER (NOT ({_ON_TIME})) > 0"""
# The part of the messages that each arrival brings, late ones with the last.
_ARRIVAL = f"""CASE WHEN NOT ({_ON_TIME}) THEN 3 WHEN ts < TIMESTAMP '2024-01-10 00:00:30' THEN 1
         WHEN ts < TIMESTAMP '2024-01-20 12:00:15' THEN 2 ELSE 3 END"""

ORACLE |= {
    "bars_merged": ORACLE["stream_ohlc"],
    "bars_healed": ORACLE["stream_ohlc"],
    "documents_stored": ORACLE["daily_document"],
    "silver_merged": ORACLE["silver_posts"],
    "silver_variant": ORACLE["silver_posts"],
    "insights_caught_up": f"""SELECT * FROM ({ORACLE["daily_insights_all"]}) WHERE all_articles IS NOT NULL""",
    "silver_compacted": _with(VALID_MESSAGES, then="""SELECT symbol, price, volume, high, low, event_time,
       CAST(seq AS BIGINT) AS seq, part, CAST(event_time AS DATE) AS event_date FROM valid"""),
    "late_minutes": _with(VALID_MESSAGES, then=_LATE),
    "stream_audit": _with(
        VALID_MESSAGES, f"late AS ({_LATE})",
        f"""changed AS (SELECT DISTINCT {_ARRIVAL} AS arrival, symbol, date_trunc('minute', event_time) AS m
  FROM valid WHERE {_ON_TIME})""",
        then="""SELECT (SELECT count(*) FROM events) AS rows_in, (SELECT count(*) FROM changed) AS rows_out,
       (SELECT count(*) FROM late) AS rows_dropped"""),
}
