"""Records of both feeds as bronze rows: a load key and the record as JSON text."""

from pyspark.sql import functions as F

from marketpulse.functions import load_key, text_key

# Source tags, content types and load-key prefixes of the two feeds.
STORIES, ARTICLES = "hackernews", "news_api"
STORY_TYPE, ARTICLE_TYPE = "story", "article"
STORY_PREFIX, ARTICLE_PREFIX = "HN", "NEWS"


def _rows(records, source, content_type, prefix, item_id, fields):
    return records.select(
        load_key(prefix, item_id, F.col("fetched_at")).alias("load_id"),
        F.lit(content_type).alias("content_type"),
        F.to_json(F.struct(*fields)).alias("raw_data"),
        "fetched_at",
        F.to_date("fetched_at").alias("fetch_date"),
        F.lit(source).alias("source"),
    )


def story_rows(stories):
    fields = ["id", "title", "url", "score", "by", "time"]
    return _rows(stories, STORIES, STORY_TYPE, STORY_PREFIX, F.col("id"), fields)


def article_rows(articles):
    fields = ["title", "description", "url", "source", "published_at"]
    return _rows(
        articles, ARTICLES, ARTICLE_TYPE, ARTICLE_PREFIX, text_key(F.col("url")), fields
    )
