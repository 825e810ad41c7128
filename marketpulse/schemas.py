"""Schemas of the landed inputs and of the tables in each layer."""

from pyspark.sql import types as T

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_TS, _DATE = T.TimestampType(), T.DateType()


def _schema(**fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# --- landed JSON. Scalars are read as text and converted with try_cast afterwards, so that a
# field of the wrong type becomes NULL instead of failing the row.
STORY_ITEM = _schema(id=_S, type=_S, title=_S, url=_S, score=_S, by=_S, time=_S)

ARTICLE_PAGE = _schema(
    articles=T.ArrayType(
        _schema(title=_S, description=_S, url=_S, publishedAt=_S, source=_schema(name=_S))
    )
)

_TICKER = dict(
    product_id=_S, symbol=_S, price=_S, last_trade_price=_S,
    volume_24_h=_S, volume_24h=_S, high_24_h=_S, high_24h=_S, low_24_h=_S, low_24h=_S,
    time=_S,
)
TICKER = _schema(**_TICKER)
FRAME = _schema(
    type=_S, **_TICKER, events=T.ArrayType(_schema(tickers=T.ArrayType(TICKER)))
)

TICK_MESSAGE = _schema(symbol=_S, price=_S, volume=_S, high=_S, low=_S, timestamp=_S)

# --- the JSON kept in bronze, one shape per feed
STORY_RECORD = _schema(id=_S, title=_S, url=_S, score=_S, by=_S, time=_S)
ARTICLE_RECORD = _schema(title=_S, description=_S, url=_S, source=_S, published_at=_S)

# --- tables
# `record` is the JSON of a post as VARIANT, stored in columns per field; `raw_data` the text of
# what is not JSON, else NULL.
BRONZE_POSTS = _schema(
    load_id=_S, content_type=_S, record=T.VariantType(), raw_data=_S, fetched_at=_TS,
    fetch_date=_DATE, source=_S, run_id=_S,
)
TICKS = _schema(
    symbol=_S, price=_D, volume=_D, high=_D, low=_D, event_time=_TS, seq=_L, part=_I, loaded_at=_TS
)
TICKS_BY_DAY = T.StructType(TICKS.fields + [T.StructField("event_date", _DATE)])
# Every message as it came, with what could be read of it.
BRONZE_TICKS = _schema(
    value=_S, symbol=_S, price=_D, volume=_D, high=_D, low=_D, event_time=_TS, seq=_L, part=_I,
    arrived_at=_TS, loaded_at=_TS, arrived_date=_DATE,
)
BAD_TICKS = _schema(value=_S, reason=_S, seq=_L, part=_I, arrived_at=_TS, loaded_at=_TS)
SILVER_POSTS = _schema(
    post_id=_S, source=_S, title=_S, url=_S, score=_I, author=_S, description=_S,
    published_at=_TS, loaded_at=_TS, run_date=_DATE,
)
# Silver posts with what decides between their versions, and the runs they come from.
WINNERS = _schema(
    post_id=_S, source=_S, title=_S, url=_S, score=_I, author=_S, description=_S,
    published_at=_TS, load_id=_S, fetched_at=_TS, edition=_S, run_date=_DATE,
)
TOP_STORIES = _schema(
    source=_S, title=_S, url=_S, score=_I, author=_S, published_date=_DATE, rank=_I,
    loaded_at=_TS, report_date=_DATE,
)
SOURCE_SUMMARY = _schema(
    source=_S, total_articles=_L, avg_score=_D, max_score=_I, top_story=_S,
    loaded_at=_TS, report_date=_DATE,
)
BARS = _schema(
    symbol=_S, minute_bucket=_TS, open_price=_D, high_price=_D, low_price=_D, close_price=_D,
    avg_price=_D, trade_count=_L,
)
BAR_UPDATES = T.StructType(
    BARS.fields + [T.StructField("bar_date", _DATE), T.StructField("batch_id", _L)]
)
INSIGHTS = _schema(
    top_hn_story=_S, hn_max_score=_I, total_articles=_L, all_articles=_L,
    btc_avg_price=_D, eth_avg_price=_D, sol_avg_price=_D, btc_price_change=_D,
    loaded_at=_TS, report_date=_DATE,
)
RUN_AUDIT = _schema(
    run_id=_S, dag_id=_S, execution_date=_TS, records_fetched=_L, records_loaded=_L,
    status=_S, started_at=_TS, completed_at=_TS,
)
QUARANTINE = _schema(feed=_S, bad_text=_S, fetched_at=_TS, run_date=_DATE, run_id=_S)
SOURCE_COUNTS = _schema(source=_S, total=_L, loaded_at=_TS, run_date=_DATE)
REPORTS = _schema(report=_S, loaded_at=_TS, report_date=_DATE)
# The day document: the first entries of both feeds.
DOCUMENTS = _schema(
    hackernews=T.ArrayType(_schema(id=_L, title=_S, score=_I)),
    news=T.ArrayType(_schema(title=_S, source=_S)), ds=_DATE,
)
# What the micro-batches of the streams did. `rows_dropped` counts rows of the state's
# operator, bars in part, that came after the watermark.
STREAM_AUDIT = _schema(
    stream=_S, run_id=_S, batch_id=_L, rows_in=_L, rows_out=_L, rows_dropped=_L, rows_in_state=_L, started_at=_TS,
)
