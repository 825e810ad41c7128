"""One named query per operator. Each reads the test tables whole; the operators that are
about one day (`bronze_scan`, `daily_insights` and the like) take `inputs.DAY`.

The gold queries and the price queries of one day read tables that an earlier step has
stored, as the chain does: silver posts, and valid ticks in date folders. The first query of
a session that needs such a table writes it to the scratch folder.
"""

from datetime import date, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketpulse import operators, plans, schemas, sinks, sources, streaming
from marketpulse.catalog import inputs
from marketpulse.catalog.inputs import DAY, PRODUCTS, table
from marketpulse.functions import (
    clean_headline, epoch_to_ts, json_fields, load_key, malformed, parse_records,
    round_half_up, safe_ts, text_key,
)
from marketpulse.plans.batch import table_paths
from marketpulse.plans.silver import (
    article_versions, best_stories, fetched_posts, latest_articles, story_versions,
)
from marketpulse.sources.messages import valid_ticks
from marketpulse.workspace import scratch_dir

QUERIES = {}
STORED = {}  # paths of stored tables by application, input folder and name
ZONE = "spark.sql.session.timeZone"


def query(build):
    """Register under the function's name. The library works in UTC, and results carry
    timestamps without a zone, as the SQL side does. Expressions take their zone when a
    query is built; afterwards the session gets its own back."""

    def run(spark, sf_dir):
        before = spark.conf.get(ZONE)
        spark.conf.set(ZONE, "UTC")
        try:
            return without_zone(build(spark, sf_dir))
        finally:
            spark.conf.set(ZONE, before)

    QUERIES[build.__name__] = run
    return run


def without_zone(df):
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def events(spark, sf_dir):
    return table(spark, sf_dir, "events")


def pages(spark, sf_dir):
    return table(spark, sf_dir, "pages")


def stored(spark, sf_dir, name, rows, folder, codec="snappy"):
    """A table written once per session and input, with one folder per value of `folder`."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in STORED:
        path = scratch_dir(spark, name)
        rows().write.partitionBy(folder).parquet(path, compression=codec)
        STORED[key] = path
    return spark.read.parquet(STORED[key])


def prices(spark, sf_dir):
    """The valid ticks, as silver keeps them."""
    return valid_ticks(inputs.ticks(events(spark, sf_dir)))


def stored_prices(spark, sf_dir):
    def rows():
        return prices(spark, sf_dir).withColumn("event_date", F.to_date("event_time")).repartition("event_date")

    return stored(spark, sf_dir, "silver-prices", rows, "event_date")


def posts(spark, sf_dir):
    """Silver posts, stored."""
    def rows():
        return plans.silver_posts(inputs.bronze_posts(spark, sf_dir)).hint("rebalance", "run_date")

    return stored(spark, sf_dir, "silver-posts", rows, "run_date")


def rounded(df, *columns, digits=6):
    """Averages to six decimals: beyond them the order of a distributed sum shows."""
    return df.withColumns({c: round_half_up(F.col(c), digits) for c in columns})


AVERAGES = [f"{name}_avg_price" for name in PRODUCTS]


# --- sources ---------------------------------------------------------------------------


@query
def shape_stories(spark, sf_dir):
    return sources.shape_stories(inputs.daily_feed(events(spark, sf_dir)), 30)


@query
def shape_articles(spark, sf_dir):
    return sources.shape_articles(inputs.article_pages(pages(spark, sf_dir)))


@query
def shape_article_page(spark, sf_dir):
    """Responses of 40 articles, of which the first 30 count."""
    return sources.shape_articles(inputs.long_pages(pages(spark, sf_dir)), 30)


@query
def quarantine(spark, sf_dir):
    items = inputs.story_items(events(spark, sf_dir))
    return malformed(items, "value", schemas.STORY_ITEM, ["fetched_at"])


@query
def normalize_frames(spark, sf_dir):
    return sources.normalize_frames(inputs.frames(events(spark, sf_dir)), ["purchase", "view", "signup"])


@query
def parse_ticks(spark, sf_dir):
    """Messages as bytes; NaN is shown as -1."""
    messages = inputs.tick_messages(events(spark, sf_dir))
    parsed = sources.parse_ticks(messages.withColumn("value", F.col("value").cast("binary")))
    return readable(parsed).drop("arrived_at")


def readable(ticks):
    """The text only of what could not be read, and a price that compares."""
    return ticks.withColumns({
        "value": F.when(F.col("symbol").isNull(), F.col("value")),
        "price": F.nanvl("price", F.lit(-1.0)),
    })


@query
def tick_quarantine(spark, sf_dir):
    bad = sources.bad_ticks(sources.parse_ticks(inputs.tick_messages(events(spark, sf_dir))))
    return bad.select("reason", "seq")


@query
def bronze_scan(spark, sf_dir):
    bronze = inputs.bronze_posts(spark, sf_dir)
    return sources.scan_day(bronze, "fetch_date", DAY, source="hackernews").select(
        "load_id", "source", "content_type", "fetched_at"
    )


@query
def silver_scan(spark, sf_dir):
    return sources.scan_day(posts(spark, sf_dir), "run_date", DAY)


@query
def prices_by_day(spark, sf_dir):
    return operators.by_day(stored_prices(spark, sf_dir), DAY)


# --- scalar functions ------------------------------------------------------------------


@query
def json_extract(spark, sf_dir):
    whole = F.col("props")
    cut = F.when(F.col("event_type") == "error", F.substring("props", 1, 4)).otherwise(whole)
    number = F.when(F.col("event_type") == "error", '"n/a"').otherwise("7")
    odd = F.concat(
        F.lit('{"k": '), number, F.lit(', "id": null, "v": '), F.col("value").cast("string"), F.lit("}")
    )
    return events(spark, sf_dir).select(
        "event_id",
        *json_fields(whole, k_text=("$.k", "string"), k_int=("$.k", "int"), absent=("$.nope", "string")),
        *json_fields(cut, k_cut=("$.k", "string")),
        *json_fields(odd, id_null=("$.id", "string"), k_mixed=("$.k", "int"), v_double=("$.v", "double")),
    )


@query
def to_json_roundtrip(spark, sf_dir):
    record = F.struct(
        F.col("event_id").cast("string").alias("id"), F.lit("it's a \"quoted\" title").alias("title"),
        F.col("event_type").alias("url"), F.col("value").cast("string").alias("score"),
    )
    written = events(spark, sf_dir).select("event_id", F.to_json(record).alias("json"))
    return parse_records(written, "json", schemas.STORY_RECORD, ["event_id", "json"]).select(
        "event_id", "json", "id", "title", "url", F.col("score").try_cast("double").alias("score")
    )


@query
def clean_titles(spark, sf_dir):
    title = F.concat(F.lit("  "), inputs.headline())
    return pages(spark, sf_dir).select("page_id", clean_headline(title).alias("title"))


@query
def epoch_to_timestamp(spark, sf_dir):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")
    return events(spark, sf_dir).select("event_id", epoch_to_ts(seconds).alias("published_at"))


@query
def try_ts(spark, sf_dir):
    iso = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    text = F.when(F.col("event_type") == "error", "garbage").otherwise(iso)
    return events(spark, sf_dir).select("event_id", safe_ts(text).alias("published_at"))


@query
def load_keys(spark, sf_dir):
    return pages(spark, sf_dir).select(
        "page_id",
        load_key("HN", F.col("page_id"), inputs.page_time()).alias("story_key"),
        load_key("NEWS", text_key(F.col("url")), inputs.page_time()).alias("article_key"),
    )


# --- silver ----------------------------------------------------------------------------


@query
def dedup_stories(spark, sf_dir):
    versions = story_versions(inputs.bronze_posts(spark, sf_dir))
    return best_stories(versions).select("run_date", "post_id", "score", "load_id", "fetched_at")


@query
def dedup_articles(spark, sf_dir):
    versions = article_versions(inputs.bronze_posts(spark, sf_dir))
    return latest_articles(versions).select("run_date", "url", "edition", "load_id", "title")


@query
def silver_stories(spark, sf_dir):
    return plans.silver_stories(inputs.bronze_posts(spark, sf_dir))


@query
def silver_articles(spark, sf_dir):
    return plans.silver_articles(inputs.bronze_posts(spark, sf_dir))


@query
def silver_posts(spark, sf_dir):
    return plans.silver_posts(inputs.bronze_posts(spark, sf_dir))


# --- gold ------------------------------------------------------------------------------


@query
def source_counts(spark, sf_dir):
    return plans.source_counts(posts(spark, sf_dir))


@query
def quality_profile(spark, sf_dir):
    """Over all that was fetched, before unusable rows go."""
    return plans.quality_profile(fetched_posts(inputs.bronze_posts(spark, sf_dir)))


@query
def top_stories(spark, sf_dir):
    return plans.top_stories(posts(spark, sf_dir))


@query
def source_summary(spark, sf_dir):
    return plans.source_summary(posts(spark, sf_dir))


@query
def top_orders(spark, sf_dir):
    order = [F.desc("o_totalprice"), F.desc("o_orderkey")]
    return operators.top_per_group(
        table(spark, sf_dir, "orders"), ["o_orderpriority"], order, 10
    ).select("o_orderpriority", "o_orderkey", "o_totalprice", "rank")


@query
def run_audit(spark, sf_dir):
    return sinks.audit_by_day(inputs.bronze_posts(spark, sf_dir), posts(spark, sf_dir))


# --- prices ----------------------------------------------------------------------------


@query
def ohlc_1m(spark, sf_dir):
    return operators.bars(prices(spark, sf_dir))


@query
def ohlc_latest(spark, sf_dir):
    """Every tick as a changed hourly row of its symbol; the last change is current."""
    changes = events(spark, sf_dir).select(
        F.col("event_type").alias("symbol"),
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("minute_bucket"),
        F.col("value").alias("close_price"),
        F.col("event_id").alias("batch_id"),
    )
    return operators.latest_versions(changes, ["symbol", "minute_bucket"])


@query
def symbol_daily_avg(spark, sf_dir):
    return rounded(operators.symbol_daily_avg(prices(spark, sf_dir), PRODUCTS), *AVERAGES)


@query
def day_over_day(spark, sf_dir):
    return rounded(operators.day_over_day(prices(spark, sf_dir), PRODUCTS["btc"]), "avg_price")


# --- insights --------------------------------------------------------------------------


@query
def daily_insights_all(spark, sf_dir):
    summary = plans.source_summary(posts(spark, sf_dir))
    return rounded(plans.insights_all(summary, prices(spark, sf_dir), PRODUCTS), *AVERAGES)


@query
def daily_insights(spark, sf_dir):
    summary = plans.source_summary(posts(spark, sf_dir))
    return rounded(plans.daily_insights(summary, stored_prices(spark, sf_dir), DAY, PRODUCTS), *AVERAGES)


@query
def insight_empty_news(spark, sf_dir):
    """The feeds failed on that day: the stored summary has all other days."""
    def rows():
        other = posts(spark, sf_dir).where(F.col("run_date") != F.lit(DAY).cast("date"))
        return plans.source_summary(other)

    summary = stored(spark, sf_dir, "summary-without-a-day", rows, "report_date")
    return rounded(plans.daily_insights(summary, stored_prices(spark, sf_dir), DAY, PRODUCTS), *AVERAGES)


@query
def insight_report(spark, sf_dir):
    summary = plans.source_summary(posts(spark, sf_dir))
    return plans.insight_report(plans.insights_all(summary, prices(spark, sf_dir), PRODUCTS))


@query
def daily_document(spark, sf_dir):
    stories = sources.shape_stories(inputs.daily_feed(events(spark, sf_dir)), 10, None)
    articles = sources.shape_articles(inputs.article_pages(pages(spark, sf_dir)), 10)
    documents = plans.daily_document(stories, articles)
    return documents.select("ds", F.to_json(F.struct("hackernews", "news")).alias("document"))


# --- tables and streams ----------------------------------------------------------------


@query
def replace_day(spark, sf_dir):
    """All days written as zeros, emptied, and replaced by their averages."""
    where = scratch_dir(spark, "replace-day")
    daily = operators.symbol_daily_avg(prices(spark, sf_dir), PRODUCTS)
    sinks.replace_days(daily.withColumns({c: F.lit(0.0) for c in AVERAGES}), where)
    sinks.replace_days(daily.limit(0), where, [DAY])
    sinks.replace_days(daily, where)
    return rounded(sinks.read_days(spark, where, daily.schema), *AVERAGES)


def one_batch(spark, sf_dir, run_id="run-1"):
    """The chain for one day over its whole feeds: (insight, table paths)."""
    root, first = scratch_dir(spark, "batch-day"), date.fromisoformat(DAY)
    since, until = (F.lit(str(d)).cast("timestamp_ntz") for d in (first, first + timedelta(days=1)))
    feed = inputs.daily_feed(events(spark, sf_dir).where((F.col("ts") >= since) & (F.col("ts") < until)))
    articles = inputs.article_pages(pages(spark, sf_dir)).where(F.to_date("fetched_at") == F.lit(first))
    insight = plans.run_batch(
        spark, root, DAY, feed, articles, stored_prices(spark, sf_dir), run_id, products=PRODUCTS,
    )
    return insight, table_paths(root)


@query
def batch_day(spark, sf_dir):
    """All tables written and read back."""
    insight, _ = one_batch(spark, sf_dir)
    return rounded(insight.drop("loaded_at"), *AVERAGES)


@query
def batch_quarantine(spark, sf_dir):
    _, paths = one_batch(spark, sf_dir)
    return spark.read.schema(schemas.QUARANTINE).parquet(paths["quarantine"])


@query
def audit_row(spark, sf_dir):
    """The audit of a run, read back."""
    _, paths = one_batch(spark, sf_dir, "audited")
    return spark.read.schema(schemas.RUN_AUDIT).parquet(paths["run_audit"]).select(
        "run_id", "execution_date", "records_fetched", "records_loaded", "status",
        (F.col("completed_at") >= F.col("started_at")).alias("in_order"),
    )


def caught_up(spark, sf_dir):
    """Both feeds landed by three runs, and the tables brought up to date after each of them;
    once per session and input. The rows are stored by run, so that a run reads its own."""
    key = (spark.sparkContext.applicationId, sf_dir, "caught-up")
    if key in STORED:
        return STORED[key]
    paths = table_paths(scratch_dir(spark, "caught-up"))
    def rows():
        run = F.pmod(F.xxhash64("load_id", "raw_data"), F.lit(3))
        return inputs.bronze_posts(spark, sf_dir).withColumn("run", run)

    bronze = stored(spark, sf_dir, "bronze-posts", rows, "run", "zstd")
    root = paths["bronze_posts"].rpartition("/")[0]
    for n in (0, 1, 2):
        sinks.land_bronze(bronze.where(F.col("run") == n).drop("run"), paths["bronze_posts"], f"run-{n}")
        plans.catch_up(spark, root, stored_prices(spark, sf_dir), PRODUCTS)
    STORED[key] = paths
    return paths


@query
def silver_variant(spark, sf_dir):
    """Silver posts from bronze records that are stored as VARIANT."""
    where = scratch_dir(spark, "bronze-variant")
    sinks.land_bronze(inputs.bronze_posts(spark, sf_dir), where, "run-1")
    return plans.silver_posts(spark.read.schema(schemas.BRONZE_POSTS).parquet(where))


@query
def silver_merged(spark, sf_dir):
    """Silver posts merged from run to run."""
    paths = caught_up(spark, sf_dir)
    return sinks.read_days(spark, paths["silver_posts"], schemas.SILVER_POSTS, "run_date").drop("loaded_at")


@query
def insights_caught_up(spark, sf_dir):
    """The insights of all days with landed runs."""
    paths = caught_up(spark, sf_dir)
    stored = sinks.read_days(spark, paths["insights"], schemas.INSIGHTS)
    return rounded(stored.drop("loaded_at"), *AVERAGES)


# Between two minutes' bounds, so that bars of both arrivals meet.
CUTS = ["2024-01-10T00:00:30", "2024-01-20T12:00:15"]


def arrivals(column):
    """Conditions for three arrivals of rows, by a timestamp."""
    cuts = [F.lit(c).cast("timestamp") for c in CUTS]
    at = F.col(column)
    return [at < cuts[0], (at >= cuts[0]) & (at < cuts[1]), at >= cuts[1]]


def arriving(spark, rows, conditions, start, last=None, after=None):
    """Rows arrive in parts; after each the stream starts again from its checkpoint, takes
    what is there and ends. `last` arrives at the end. `after` is called with the paths of
    the result and the checkpoint after each part. Gives the path of the result."""
    where = scratch_dir(spark, "stream")
    parts = [rows.where(c) for c in conditions] + ([last] if last is not None else [])
    for part in parts:
        part.write.mode("append").parquet(f"{where}/landing")
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1000)
        start(stream.parquet(f"{where}/landing"), f"{where}/t", f"{where}/c", every=None).awaitTermination()
        if after:
            after(f"{where}/t", f"{where}/c")
    return f"{where}/t"


def tick_arrivals(spark, sf_dir, start, last=None, late=None, after=None):
    """The messages in the order of their time. Those that are `late` come with the last part."""
    rows = inputs.tick_messages(events(spark, sf_dir))
    conditions = arrivals("arrived_at")
    if late is not None:
        conditions = [c & ~late for c in conditions[:-1]] + [conditions[-1] | late]
    return arriving(spark, rows, conditions, start, last, after)


def parsed(start):
    return lambda values, *places, **options: start(sources.parse_ticks(values), *places, **options)


@query
def stream_bronze_ticks(spark, sf_dir):
    path = tick_arrivals(spark, sf_dir, streaming.start_bronze)
    return readable(spark.read.schema(schemas.BRONZE_TICKS).parquet(path)).drop("loaded_at", "arrived_at")


@query
def stream_quarantine(spark, sf_dir):
    path = tick_arrivals(spark, sf_dir, parsed(streaming.start_quarantine))
    return spark.read.schema(schemas.BAD_TICKS).parquet(path).select("reason", "seq")


@query
def stream_silver_prices(spark, sf_dir):
    def start(values, *places, **options):
        typed = sources.normalize_frames(values).withColumn("event_time", safe_ts(F.col("timestamp")))
        return streaming.start_silver(typed.drop("timestamp"), *places, **options)

    path = arriving(spark, inputs.frames(events(spark, sf_dir)), arrivals("received_at"), start)
    return spark.read.schema(schemas.TICKS_BY_DAY).parquet(path).drop("loaded_at", "seq", "part")


@query
def silver_compacted(spark, sf_dir):
    """The ticks of a silver stream whose days are compacted after each arrival; a part of the
    first days' messages comes at the end."""
    def compact(path, checkpoint):
        streaming.compact_days(spark, path, schemas.TICKS_BY_DAY, "event_date")

    path = tick_arrivals(spark, sf_dir, parsed(streaming.start_silver), late=late(), after=compact)
    table = streaming.read_compacted(spark, path, schemas.TICKS_BY_DAY, "event_date")
    return table.drop("loaded_at")


@query
def stream_ohlc(spark, sf_dir):
    path = tick_arrivals(spark, sf_dir, parsed(streaming.start_bars))
    return streaming.latest_bars(spark, path)


@query
def stream_ohlc_final(spark, sf_dir):
    """Each bar once; a marker at the end closes the last ones."""
    path = tick_arrivals(spark, sf_dir, parsed(streaming.start_bars_final), streaming.end_marker(spark))
    return spark.read.schema(schemas.BARS).parquet(path).drop("bar_date")


def late():
    """Messages of the first part that come with the last one."""
    return (F.col("seq") % 53 == 9) & arrivals("arrived_at")[0]


@query
def stream_late(spark, sf_dir):
    """Bars without the ticks that came after the watermark."""
    path = tick_arrivals(spark, sf_dir, parsed(streaming.start_bars), late=late())
    return streaming.latest_bars(spark, path)


@query
def bars_rebuilt(spark, sf_dir):
    """The same with one day rebuilt from the valid ticks."""
    path = tick_arrivals(spark, sf_dir, parsed(streaming.start_bars), late=late())
    silver = valid_ticks(sources.parse_ticks(inputs.tick_messages(events(spark, sf_dir))))
    streaming.rebuild_bars(silver, path, REBUILT)
    return streaming.latest_bars(spark, path, REBUILT, REBUILT)


REBUILT = "2024-01-05"
AFTER_ALL = "2024-02-01"  # no tick is from here on


@query
def bars_merged(spark, sf_dir):
    """The stream's bars with the changes merged into bases after each arrival."""
    def merge(path, checkpoint):
        streaming.merge_bars(spark, path, checkpoint, least=1)

    path = tick_arrivals(spark, sf_dir, parsed(streaming.start_bars), after=merge)
    return streaming.latest_bars(spark, path)


def all_valid(spark, sf_dir):
    return valid_ticks(sources.parse_ticks(inputs.tick_messages(events(spark, sf_dir))))


@query
def late_minutes(spark, sf_dir):
    """The bars that lack ticks which came after the watermark."""
    path = tick_arrivals(spark, sf_dir, parsed(streaming.start_bars), late=late())
    return streaming.bar_differences(all_valid(spark, sf_dir), streaming.latest_bars(spark, path))


@query
def bars_healed(spark, sf_dir):
    """Bars without the late ticks, after the days that lack some have been rebuilt."""
    path = tick_arrivals(spark, sf_dir, parsed(streaming.start_bars), late=late())
    streaming.heal_bars(spark, all_valid(spark, sf_dir), path, AFTER_ALL)
    return streaming.latest_bars(spark, path)


@query
def stream_audit(spark, sf_dir):
    """What the micro-batches of the late ticks' stream read, wrote and dropped."""
    audit = scratch_dir(spark, "stream-audit")
    with streaming.StreamAudit(spark, audit):
        tick_arrivals(spark, sf_dir, parsed(streaming.start_bars), late=late())
    totals = [F.sum(c).alias(c) for c in ("rows_in", "rows_out", "rows_dropped")]
    return spark.read.schema(schemas.STREAM_AUDIT).parquet(audit).groupBy("stream").agg(*totals).drop("stream")


@query
def documents_stored(spark, sf_dir):
    """The documents of all days, written in two parts and read back."""
    stories = sources.shape_stories(inputs.daily_feed(events(spark, sf_dir)), 10, None)
    articles = sources.shape_articles(inputs.article_pages(pages(spark, sf_dir)), 10)
    documents, where = plans.daily_document(stories, articles), scratch_dir(spark, "documents")
    for part in (F.col("ds") >= DAY, F.col("ds") < DAY):
        plans.write_documents(documents.where(part), where)
    stored = plans.read_documents(spark, where)
    return stored.select("ds", F.to_json(F.struct("hackernews", "news")).alias("document"))
