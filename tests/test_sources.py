import json

from pyspark.sql import functions as F

from conftest import plan, utc, values
from marketpulse.sources import kafka_values, normalize_frames, parse_ticks, scan_day, shape_articles, shape_stories
from marketpulse.sources.feeds import article_records
from marketpulse.sources.messages import bad_ticks, valid_ticks

AT = utc("2026-02-19T10:00:00")


def feed(spark, items):
    rows = [(AT, i + 1, t if isinstance(t, str) else json.dumps(t)) for i, t in enumerate(items)]
    return spark.createDataFrame(rows, "fetched_at timestamp, feed_pos int, value string")


def story(n, **changes):
    return {"id": n, "type": "story", "title": f"t{n}", "url": f"u{n}", "score": n, "by": "me", "time": 5, **changes}


def test_cut_by_place_comes_before_the_type_filter(spark):
    items = [story(n, type="job" if n == 3 else "story") for n in range(1, 41)]
    kept = shape_stories(feed(spark, items), 30)
    assert shape_stories(feed(spark, items)).count() == 39
    assert [r.id for r in kept.orderBy("feed_pos").collect()] == [n for n in range(1, 31) if n != 3]


def test_story_defaults_and_broken_items(spark):
    items = [{"id": 1, "type": "story"}, '{"id": 2, "type": "st', "null", story(4, score="high")]
    rows = shape_stories(feed(spark, items)).drop("fetched_at")
    assert values(rows) == [
        (1, 1, "", "", 0, "unknown", 0), (4, 4, "t4", "u4", 0, "me", 5),
    ]


def test_short_feed_without_type_filter(spark):
    items = [story(n, type="job" if n % 2 else "story") for n in range(1, 15)]
    rows = shape_stories(feed(spark, items), limit=10, only_type=None, fields=["id", "title", "score"])
    assert rows.columns == ["fetched_at", "feed_pos", "id", "title", "score"]
    assert rows.count() == 10


def test_articles(spark):
    page = {
        "articles": [
            {"title": f"T{n}", "description": None, "url": f"http://x/{n}",
             "publishedAt": "2026-02-19T01:02:03Z", "source": {"id": None, "name": "Paper"}}
            for n in range(35)
        ]
    }
    raw = spark.createDataFrame([(AT, json.dumps(page)), (AT, '{"articles": [')], "fetched_at timestamp, value string")
    rows = shape_articles(raw)
    assert rows.count() == 35
    assert shape_articles(raw, 30).count() == 30
    assert values(rows.where("feed_pos = 1").drop("fetched_at")) == [
        (1, "T0", "", "http://x/0", "Paper", "2026-02-19T01:02:03Z")
    ]
    assert shape_articles(raw, 10, ["title", "source"]).count() == 10


def test_lists_of_articles_are_derived_once(spark):
    """Catalyst does not repeat their expressions in a filter on the size of the list."""
    raw = spark.createDataFrame([(AT, "a,b"), (AT, ""), (AT, None)], "fetched_at timestamp, text string")
    entry = F.struct(*(F.col("text").alias(n) for n in ("title", "description", "url", "publishedAt")), F.struct(F.lit("s").alias("name")).alias("source"))
    listed = F.when(F.col("text") == "", F.array().cast("array<struct<title:string,description:string,url:string,publishedAt:string,source:struct<name:string>>>"))
    rows = article_records(raw.select("fetched_at", listed.when(F.col("text").isNotNull(), F.array(entry, entry)).alias("articles")))
    assert values(rows, "feed_pos", "title") == [(1, "a,b"), (2, "a,b")]
    assert "size(" not in plan(rows)


def frames(spark, *texts):
    rows = [(json.dumps(t) if not isinstance(t, str) else t, AT, n) for n, t in enumerate(texts)]
    return spark.createDataFrame(rows, "value string, received_at timestamp, seq int")


def test_frame_shapes(spark):
    top = {"type": "ticker", "product_id": "BTC-USD", "price": "66837.87", "volume_24_h": "10", "high_24_h": "", "high_24h": "7"}
    nested = {"channel": "ticker", "events": [
        {"tickers": [{"symbol": "ETH-USD", "last_trade_price": "1945.92", "low_24h": "3"}]},
        {"tickers": [{"product_id": "SOL-USD", "price": 82.27, "time": "2026-02-19T09:00:00Z"},
                     {"product_id": "DOGE-USD", "price": "1"}]},
    ]}
    reply = {"type": "subscriptions", "events": [{"tickers": [{"product_id": "BTC-USD", "price": "1"}]}]}
    ticks = normalize_frames(frames(spark, top, nested, reply, "{oops"), ["BTC-USD", "ETH-USD", "SOL-USD"])
    here = "2026-02-19T10:00:00.000000"
    assert values(ticks.drop("seq")) == [
        ("BTC-USD", 66837.87, 10.0, 7.0, 0.0, here),
        ("ETH-USD", 1945.92, 0.0, 0.0, 3.0, here),
        ("SOL-USD", 82.27, 0.0, 0.0, 0.0, "2026-02-19T09:00:00Z"),
    ]
    assert normalize_frames(frames(spark, nested)).count() == 3


def test_frames_without_price_or_symbol_are_dropped(spark):
    bad = [
        {"type": "ticker", "product_id": "BTC-USD", "price": ""},
        {"type": "ticker", "product_id": "BTC-USD", "price": "0"},
        {"type": "ticker", "product_id": "BTC-USD", "price": "-1"},
        {"type": "ticker", "product_id": "", "price": "5"},
        {"type": "ticker", "price": "5"},
        {"type": "ticker", "product_id": "BTC-USD"},
        {"type": "heartbeat"},
    ]
    assert normalize_frames(frames(spark, *bad)).count() == 0


def test_messages(spark):
    good = {"symbol": "BTC-USD", "price": 66837.87, "volume": 1.5, "high": 2, "low": 0.5, "timestamp": "2026-02-19T10:00:00.000001"}
    whole_second = {**good, "timestamp": "2026-02-19T10:00:00"}
    bad = ["{", json.dumps({**good, "timestamp": "later"}), json.dumps({**good, "symbol": None})]
    texts = [json.dumps(good), json.dumps(whole_second), *bad]
    texts += [json.dumps({**good, "price": "2.5", "volume": "many"}), json.dumps({**good, "price": "NaN"})]
    raw = spark.createDataFrame([(t.encode(), n) for n, t in enumerate(texts)], "value binary, seq long")
    ticks = parse_ticks(raw)
    assert [r.value for r in ticks.orderBy("seq").collect()] == texts  # nothing is lost
    assert values(valid_ticks(ticks), "price", "volume", "event_time", "seq") == [
        (2.5, None, "2026-02-19 10:00:00.000001", 5),
        (66837.87, 1.5, "2026-02-19 10:00:00", 1), (66837.87, 1.5, "2026-02-19 10:00:00.000001", 0),
    ]
    assert values(bad_ticks(ticks), "seq", "reason") == [
        (2, "unreadable"), (3, "no time"), (4, "no symbol"), (6, "no price")
    ]


def test_valid_ticks(spark):
    nan, infinite = float("nan"), float("inf")
    prices = [1.0, 0.0, -1.0, None, nan, infinite]
    rows = [("A", p, AT) for p in prices] + [(None, 1.0, AT), ("A", 1.0, None)]
    ticks = spark.createDataFrame(rows, "symbol string, price double, event_time timestamp")
    assert values(valid_ticks(ticks), "symbol", "price") == [("A", 1.0)]


def test_frames_with_a_price_that_is_no_number(spark):
    odd = [{"type": "ticker", "product_id": "BTC-USD", "price": p} for p in ("NaN", "Infinity", "-Infinity", "1e9")]
    assert values(normalize_frames(frames(spark, *odd)), "price") == [(1e9,)]


class Recorder:
    """Stands in for the stream reader and keeps what it is told."""

    def __init__(self, frame):
        self.frame, self.told = frame, {}

    readStream = property(lambda self: self)

    def format(self, name):
        self.told["format"] = name
        return self

    def option(self, key, value):
        self.told[key] = value
        return self

    def load(self):
        return self.frame


def test_kafka_source(spark):
    topic = spark.createDataFrame(
        [(b"x", 2**33 + 7, 4, AT)], "value binary, offset long, partition int, timestamp timestamp"
    )
    reader = Recorder(topic)
    messages = kafka_values(reader, "broker:9092", "prices", max_per_trigger=1000)
    assert reader.told == {
        "format": "kafka", "kafka.bootstrap.servers": "broker:9092", "subscribe": "prices",
        "startingOffsets": "latest", "maxOffsetsPerTrigger": 1000,
    }
    assert values(messages, "seq", "part", "arrived_at") == [(2**33 + 7, 4, "2026-02-19 10:00:00")]


def test_day_scan_reads_one_folder(spark, tmp_path):
    from conftest import plan

    rows = spark.createDataFrame([("a", "2026-02-19"), ("b", "2026-02-20")], "x string, d string")
    rows.select("x", F.col("d").cast("date").alias("d")).write.partitionBy("d").parquet(f"{tmp_path}/t")
    day = scan_day(spark.read.parquet(f"{tmp_path}/t"), "d", "2026-02-20")
    assert values(day, "x") == [("b",)]
    assert "PartitionFilters: [isnotnull(d" in plan(day)
