import json

from pyspark.sql import functions as F

from conftest import plan, utc, values
from marketpulse import plans, schemas

COLUMNS = "load_id string, content_type string, raw_data string, fetched_at timestamp, fetch_date date, source string"


def bronze(spark, *rows):
    made = []
    for n, (source, at, record) in enumerate(rows):
        text = record if isinstance(record, str) else json.dumps(record)
        made.append((f"L{n}", "x", text, utc(at), utc(at).date(), source))
    return spark.createDataFrame(made, COLUMNS)


def hn(at="2026-02-19T10:00:00", **record):
    return "hackernews", at, {"id": 1, "title": "T", "url": "http://x", "score": 5, "by": " me ", "time": 0, **record}


def news(at="2026-02-19T10:00:00", **record):
    return "news_api", at, {
        "title": "T - Site", "description": " d ", "url": "http://x", "source": "Site",
        "published_at": "2026-02-19T08:00:00Z", **record,
    }


def test_story_with_best_score_wins(spark):
    rows = plans.silver_stories(bronze(spark, hn(score=5), hn(score=9, title="best"), hn(score=7)))
    assert values(rows, "post_id", "title", "score", "author", "description", "published_at") == [
        ("1", "best", 9, "me", None, "1970-01-01 00:00:00")
    ]


def test_equal_scores_have_a_fixed_winner(spark):
    b = bronze(
        spark, hn(title="early"), hn(at="2026-02-19T11:00:00", title="late"),
        hn(at="2026-02-19T11:00:00", title="late too"), hn(score=None, title="unknown score"),
    )
    for n in (1, 3, 5):
        assert values(plans.silver_stories(b.repartition(n)), "title") == [("late",)]


def test_same_story_on_two_days_stays_twice(spark):
    rows = plans.silver_stories(bronze(spark, hn(), hn(at="2026-02-20T00:00:00")))
    assert values(rows, "run_date") == [("2026-02-19",), ("2026-02-20",)]


def test_unusable_stories_are_dropped(spark):
    b = bronze(
        spark, hn(id=1, url=""), hn(id=2, url=None), hn(id=3, url="  "), hn(id=4, title="   "),
        hn(id=5, title=None), ("hackernews", "2026-02-19T10:00:00", '{"id": 6, "ti'), hn(id=7, title=" it's ok "),
        hn(id=8, score="n/a"),
    )
    assert values(plans.silver_stories(b), "post_id", "title", "score") == [("7", "it's ok", 5), ("8", "T", None)]


def test_latest_edition_of_an_article_wins(spark):
    b = bronze(
        spark, news(title="old - Site"), news(title="new - Site", published_at="2026-02-19T09:00:00Z"),
        news(url="http://y", title="A - B - Coca-Cola"), news(url="http://z", published_at="soon"),
        news(url="  "), news(url="http://w", title=" - CNN"), news(url="http://v", title=None),
    )
    rows = plans.silver_articles(b)
    assert values(rows, "title", "score", "author", "description", "published_at") == [
        ("A - B - Coca-Cola", 0, "Site", "d", "2026-02-19 08:00:00"),
        ("T", 0, "Site", "d", None),
        ("new", 0, "Site", "d", "2026-02-19 09:00:00"),
    ]
    assert values(rows.where("title = 'new'"), "post_id") == [("L1",)]


def test_both_feeds_in_one_table(spark):
    rows = plans.silver_posts(bronze(spark, hn(), news()))
    assert values(plans.source_counts(rows)) == [("2026-02-19", "hackernews", 1), ("2026-02-19", "news_api", 1)]
    assert values(plans.total_count(rows)) == [(2,)]
    wanted = [f.name for f in schemas.SILVER_POSTS if f.name != "loaded_at"]
    assert sorted(rows.columns) == sorted(wanted)


def posts(spark, *rows):
    made = [
        (f"p{n:03}", source, title, f"u{n}", score, "me", None, utc("2026-02-18T12:00:00"), utc(day + "T00:00:00").date())
        for n, (source, title, score, day) in enumerate(rows)
    ]
    fields = [f for f in schemas.SILVER_POSTS if f.name != "loaded_at"]
    return spark.createDataFrame(made, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields))


def test_top_ten_per_source_and_run_date(spark):
    rows = [("hackernews", f"h{n}", n, "2026-02-19") for n in range(42)]
    rows += [("news_api", f"a{n}", 0, "2026-02-19") for n in range(30)]
    rows += [("hackernews", "next day", 1, "2026-02-20")]
    top = plans.top_stories(posts(spark, *rows))
    assert top.where("report_date = '2026-02-19'").count() == 20
    assert values(top.where("rank = 1"), "report_date", "source", "title", "published_date") == [
        ("2026-02-19", "hackernews", "h41", "2026-02-18"), ("2026-02-19", "news_api", "a29", "2026-02-18"),
        ("2026-02-20", "hackernews", "next day", "2026-02-18"),
    ]


def test_summary(spark):
    rows = [("hackernews", f"h{n}", n * 3 % 7, "2026-02-19") for n in range(20)]
    rows += [("hackernews", "no score", None, "2026-02-19")]
    rows += [("news_api", f"a{n}", 0, "2026-02-19") for n in range(30)]
    rows += [("hackernews", "only one", None, "2026-02-20")]
    summary = plans.source_summary(posts(spark, *rows))
    assert values(summary) == [
        ("2026-02-19", "hackernews", 21, 3.0, 6, "h16"), ("2026-02-19", "news_api", 30, 0.0, 0, "a29"),
        ("2026-02-20", "hackernews", 1, None, None, "only one"),
    ]
    assert "SortAggregate" not in plan(summary)


def test_quality_profile(spark):
    p = posts(spark, ("hackernews", None, 4, "2026-02-19"), ("hackernews", "t", 5, "2026-02-19"))
    p = p.withColumn("url", F.when(F.col("title").isNotNull(), F.col("url")))
    assert values(plans.quality_profile(p)) == [("2026-02-19", "hackernews", 2, 1, 1, 0, 4.5, 5)]


SUMMARY = "report_date date, source string, total_articles long, avg_score double, max_score int, top_story string"


def day(text):
    return utc(text + "T00:00:00").date()


def summary(spark):
    return spark.createDataFrame(
        [(day("2026-02-19"), "hackernews", 47, 128.1, 572, "A quiet release"),
         (day("2026-02-19"), "news_api", 46, 0.0, 0, "Article"),
         (day("2026-02-25"), "hackernews", 1, None, None, "Lonely")], SUMMARY,
    )


def prices(spark):
    rows = [("BTC-USD", 66888.005, "19"), ("ETH-USD", 1945.92, "19"), ("SOL-USD", 82.27, "19"),
            ("BTC-USD", 66954.91, "20"), ("ETH-USD", 1948.97, "20"), ("SOL-USD", 82.37, "20")]
    return spark.createDataFrame(
        [(s, p, utc(f"2026-02-{d}T12:00:00")) for s, p, d in rows], "symbol string, price double, event_time timestamp"
    )


def test_report_without_a_day_before(spark):
    insight = plans.daily_insights(summary(spark), prices(spark), "2026-02-19")
    assert plans.insight_report(insight).first().report.split("\n") == [
        "=" * 60,
        "Date          : 2026-02-19",
        "Top HN Story  : A quiet release",
        "HN Score      : 572",
        "Total Articles: 47",
        "BTC Avg Price : $66,888.01",
        "ETH Avg Price : $1,945.92",
        "SOL Avg Price : $82.27",
        "BTC Change    : N/A (need 2 days of data)",
        "=" * 60,
    ]
    assert insight.first().all_articles == 93


def test_day_without_news_still_has_its_row(spark):
    insight = plans.daily_insights(summary(spark), prices(spark), "2026-02-20")
    row = insight.first()
    assert (row.top_hn_story, row.hn_max_score, row.total_articles) == (None, None, None)
    assert row.btc_price_change == 0.1
    lines = plans.insight_report(insight).first().report.split("\n")
    assert lines[2] == "Top HN Story  : None" and lines[-2] == "BTC Change    : 0.1%"


def test_a_leader_without_a_score_keeps_its_title(spark):
    row = plans.daily_insights(summary(spark), prices(spark), "2026-02-25").first()
    assert (row.top_hn_story, row.hn_max_score) == ("Lonely", None)


def test_profile_counts_what_silver_leaves_out(spark):
    b = bronze(spark, hn(url=""), hn(title="  "), hn(url=None, score=None), news(published_at="soon"), news(title=None))
    from marketpulse.plans.silver import fetched_posts

    assert values(plans.quality_profile(fetched_posts(b))) == [
        ("2026-02-19", "hackernews", 3, 2, 1, 0, 5.0, 5), ("2026-02-19", "news_api", 2, 0, 1, 1, 0.0, 0),
    ]


def test_empty_day_is_one_row_of_nulls(spark):
    rows = plans.daily_insights(summary(spark), prices(spark), "2030-01-01")
    assert values(rows.drop("report_date")) == [(None,) * 8]
    assert "NestedLoop" not in plan(rows) and "Cartesian" not in plan(rows)


def test_all_days_match_each_day(spark):
    everything = plans.insights_all(summary(spark), prices(spark))
    assert values(everything, "report_date") == [("2026-02-19",), ("2026-02-20",), ("2026-02-25",)]
    for d in ("2026-02-19", "2026-02-20", "2026-02-25"):
        alone = plans.daily_insights(summary(spark), prices(spark), d)
        assert values(alone) == values(everything.where(F.col("report_date") == d), *alone.columns)


def test_document_holds_the_last_fetch_in_feed_order(spark, tmp_path):
    from marketpulse.plans.document import write_documents

    early, late = utc("2026-02-18T10:00:00"), utc("2026-02-18T11:00:00")
    stories = [(early, n, 100 + n, f"early {n}", 1) for n in range(1, 13)]
    stories += [(late, n, n, f"s{n}", n) for n in (2, 1, 11)]
    s = spark.createDataFrame(stories, "fetched_at timestamp, feed_pos int, id long, title string, score int")
    a = spark.createDataFrame([(utc("2026-02-19T10:00:00"), 1, "a1", "Paper")],
                              "fetched_at timestamp, feed_pos int, title string, source string")
    documents = plans.daily_document(s, a)
    write_documents(documents, f"{tmp_path}/docs")
    first = json.loads(spark.read.text(f"{tmp_path}/docs/ds=2026-02-18").first().value)
    assert first == {"hackernews": [{"id": 1, "title": "s1", "score": 1}, {"id": 2, "title": "s2", "score": 2}], "news": []}
    second = json.loads(spark.read.text(f"{tmp_path}/docs/ds=2026-02-19").first().value)
    assert second == {"hackernews": [], "news": [{"title": "a1", "source": "Paper"}]}


def test_bronze_keys(spark):
    at = utc("2026-02-19T20:22:00")
    stories = spark.createDataFrame([(at, 1, 42, "Ireland's", "u", 1, "me", 0)],
        "fetched_at timestamp, feed_pos int, id long, title string, url string, score int, by string, time long")
    row = plans.story_rows(stories).first()
    assert row.load_id == "HN_42_202602192022"
    assert json.loads(row.raw_data) == {"id": 42, "title": "Ireland's", "url": "u", "score": 1, "by": "me", "time": 0}
    assert (row.source, row.content_type, str(row.fetch_date)) == ("hackernews", "story", "2026-02-19")
