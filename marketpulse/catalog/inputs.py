"""The library's inputs, derived row by row from the test tables.

`events` gives ticks, tick messages, market frames and story items; `pages` gives article
responses. The SQL counterpart of each is in `oracle.py`.
"""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from marketpulse.functions import parse_records
from marketpulse.plans import article_rows, story_rows
from marketpulse.schemas import STORY_ITEM
from marketpulse.sources.feeds import article_records, story_records
from marketpulse.sources.frames import ISO_MICROS

# The event types that stand for the three tracked products.
PRODUCTS = {"btc": "purchase", "eth": "view", "sol": "click"}
# Item texts that cannot be parsed.
BROKEN = ['{"id": 1, "title": "cut o', "plain words", '[{"id": 1}, {', '{"id": 1, "title": }']
# The day on which the one-day operators run.
DAY = "2024-01-15"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _event_time(column="ts"):
    return F.col(column).cast("timestamp")


def ticks(events):
    """Typed ticks, one per event."""
    return events.select(*ticks_of())


def ticks_of():
    return [
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.col("user_id").cast("double").alias("volume"),
        (F.col("value") + 5.0).alias("high"),
        F.greatest(F.col("value") - 5.0, F.lit(0.0)).alias("low"),
        _event_time().alias("event_time"),
        F.col("event_id").alias("seq"),
        F.lit(0).alias("part"),
    ]


def tick_messages(events):
    """Ticks as message text, with naive ISO timestamps. Some texts break off, some times
    cannot be read, some prices are written as text or are not a number."""
    user = F.col("user_id")
    named = events.select(
        *ticks_of(), (user % 37 == 3).alias("cut_off"), (user % 41 == 7).alias("undated"),
        (user % 43 == 5).alias("quoted"), (user % 47 == 11).alias("no_number"),
    )
    price = F.when(F.col("no_number"), F.lit("NaN")).when(F.col("quoted"), F.col("price").cast("string"))
    time = F.when(F.col("undated"), "soon").otherwise(F.date_format("event_time", ISO_MICROS))
    rest = ["volume", "high", "low", time.alias("timestamp")]
    as_number = F.to_json(F.struct("symbol", "price", *rest))
    as_text = F.to_json(F.struct("symbol", price.alias("price"), *rest))
    text = (
        F.when(F.col("cut_off"), F.lit('{"symbol": "cut'))
        .when(F.col("no_number") | F.col("quoted"), as_text).otherwise(as_number)
    )
    return named.select(text.alias("value"), "seq", "part", F.col("event_time").alias("arrived_at"))


def frames(events):
    """Market frames: `error` events are subscription replies, `signup` events carry their
    ticker in a nested list, all others at the top. Some tickers use the second field
    names, some have no price, no symbol or zero volume."""
    user, value = F.col("user_id"), F.col("value")
    text = value.cast("string")
    symbol = F.when(user % 31 != 4, F.col("event_type"))
    old = user % 3 == 0
    ticker = [
        F.when(~old, symbol).alias("product_id"),
        F.when(old, symbol).alias("symbol"),
        F.when(user % 29 == 6, F.lit("")).when(~old, text).alias("price"),
        F.when(old & (user % 29 != 6), text).alias("last_trade_price"),
        F.when(~old, (user * 10).cast("string")).alias("volume_24_h"),
        F.when(old, (user * 100).cast("string")).alias("volume_24h"),
        F.when(~old, (value + 5.0).cast("string")).otherwise(F.lit("")).alias("high_24_h"),
        F.when(old, (value + 7.0).cast("string")).alias("high_24h"),
        F.when(old, text).alias("low_24h"),
        F.when(F.col("event_type") == "view", F.date_format(_event_time(), ISO_MICROS)).alias("time"),
    ]
    top = F.to_json(F.struct(F.lit("ticker").alias("type"), *ticker))
    nested = F.to_json(
        F.struct(
            F.lit("l1").alias("channel"),
            F.array(F.struct(F.array(F.struct(*ticker)).alias("tickers"))).alias("events"),
        )
    )
    reply = F.to_json(F.struct(F.lit("subscriptions").alias("type"), *ticker))
    kind = F.col("event_type")
    return events.select(
        F.when(kind == "error", reply).when(kind == "signup", nested).otherwise(top).alias("value"),
        _event_time().alias("received_at"),
        F.col("event_id").alias("seq"),
    )


def _keyed(events):
    """Events with `k` read from their JSON once."""
    return parse_records(events, "props", StructType([StructField("k", LongType())]), ["*"])


def story_fields(events):
    """Story items, one per event: repeated ids, other types, blank titles, empty and
    missing links, missing scores and authors. `broken` numbers those whose text cannot be
    parsed. A feed has 500 places; each event lands with its own."""
    events, k, user = _keyed(events), F.col("k"), F.col("user_id")
    title = F.concat(
        F.lit("  Story "), k.cast("string"), F.lit(" by user "), user.cast("string"), F.lit(" ")
    )
    link = F.concat(F.lit(" https://news.example.com/item/"), k.cast("string"))
    return events.select(
        _event_time().alias("fetched_at"),
        (F.col("event_id") % 500 + 1).cast("int").alias("feed_pos"),
        F.when(user % 97 == 5, F.col("event_id") % len(BROKEN)).alias("broken"),
        k.alias("id"),
        F.when(F.col("event_type") == "error", "job").otherwise("story").alias("type"),
        F.when(k % 25 == 7, "   ").otherwise(title).alias("title"),
        F.when(k % 10 == 3, "").when(k % 10 != 4, link).alias("url"),
        F.when(user % 50 != 0, F.floor("value").cast("int")).alias("score"),
        F.when(user % 40 != 9, F.concat(F.lit("user"), user.cast("string"))).alias("by"),
        F.unix_seconds(_event_time()).alias("time"),
    )


def story_items(events):
    """The items as landed text."""
    item = F.to_json(F.struct(*STORY_ITEM.fieldNames()))
    return story_fields(events).select(
        "fetched_at", "feed_pos",
        reduce(lambda a, i: a.when(F.col("broken") == i, BROKEN[i]), range(1, len(BROKEN)), F.when(F.col("broken") == 0, BROKEN[0]))
        .otherwise(item).alias("value"),
    )


def daily_feed(events):
    """The same items with one fetch time per day."""
    return story_items(events).withColumn("fetched_at", F.date_trunc("day", "fetched_at"))


def headline():
    """The page title with the host as publisher."""
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return F.concat(title, F.lit(" - "), host())


def host():
    return F.regexp_extract("url", "^https?://([^/?#]+)", 1)


def page_time():
    """Pages are fetched 13 minutes apart."""
    return F.timestamp_seconds(F.lit(1704067200) + F.col("page_id") * 780)


# Parts of a page that are not its text, and the entities in it; `&amp;` comes last.
NOT_TEXT = ["(?s)<head.*?</head>", "(?s)<script.*?</script>", "(?s)<style.*?</style>", "(?s)<!--.*?-->", "<[^>]*>"]
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}
WHITE = "[ \\t\\n\\r]+"


def page_text():
    """The whole text of a page without its markup."""
    text = reduce(lambda t, part: F.regexp_replace(t, part, " "), NOT_TEXT, F.col("html"))
    text = reduce(lambda t, e: F.replace(t, F.lit(e), F.lit(ENTITIES[e])), ENTITIES, text)
    return F.trim(F.regexp_replace(text, WHITE, " "))


def article_lists(pages):
    """One response per page row with two editions of its article. Some second editions
    have an unreadable date; some articles have a blank title or an empty link."""
    page = F.col("page_id")
    title = F.when(page % 13 == 5, "  ").otherwise(headline())
    link = F.when(page % 11 == 4, "").otherwise(F.concat(F.lit(" "), F.col("url")))
    body = page_text()
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    first_date = F.date_format(page_time() - F.expr("INTERVAL 1 HOUR"), iso)
    second_date = F.when(page % 7 == 2, "unknown").otherwise(F.date_format(page_time(), iso))

    def edition(title, published):
        return F.struct(
            title.alias("title"), body.alias("description"), link.alias("url"),
            published.alias("publishedAt"), F.struct(host().alias("name")).alias("source"),
        )

    editions = F.array(
        edition(title, first_date), edition(F.concat(F.lit("Update: "), title), second_date)
    )
    return pages.select(page_time().alias("fetched_at"), editions.alias("articles"))


def article_pages(pages):
    """The responses as landed text."""
    return article_lists(pages).select("fetched_at", F.to_json(F.struct("articles")).alias("value"))


def long_pages(pages, articles=40):
    """Responses of `articles` pages each, one article per page, in the order of page_id."""
    page = F.col("page_id")
    article = F.struct(
        page.alias("place"),
        F.struct(
            headline().alias("title"), page_text().alias("description"), F.col("url").alias("url"),
            F.date_format(page_time(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
            F.struct(host().alias("name")).alias("source"),
        ).alias("article"),
    )
    response = F.floor(page / articles)
    listed = pages.groupBy(response.alias("response")).agg(F.sort_array(F.collect_list(article)).alias("listed"))
    return listed.select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("response") * 900).alias("fetched_at"),
        F.to_json(F.struct(F.col("listed.article").alias("articles"))).alias("value"),
    )


def bronze_posts(spark, sf_dir):
    """Bronze rows of both feeds over all events and pages, without a cut by feed place."""
    items = story_fields(table(spark, sf_dir, "events")).where(F.col("broken").isNull())
    lists = article_lists(table(spark, sf_dir, "pages"))
    return story_rows(story_records(items)).unionByName(article_rows(article_records(lists)))
