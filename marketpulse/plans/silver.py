"""Bronze records, as VARIANT or as JSON text, to clean posts, one row per post and run date.

The run date is the date a record was fetched for. All functions take any number of days
at once; give them one day's scan to rebuild that day.
"""

from pyspark.sql import functions as F

from marketpulse.functions import (
    clean_headline, epoch_to_ts, is_blank, record_fields, safe_ts,
)
from marketpulse.operators import keep_best
from marketpulse.plans.bronze import ARTICLES, STORIES
from marketpulse.schemas import ARTICLE_RECORD, STORY_RECORD

POST = [
    "post_id", "source", "title", "url", "score", "author", "description", "published_at",
    "run_date",
]


def usable(versions):
    """Linked, with a title."""
    return versions.where(~is_blank(F.col("url")) & ~is_blank(F.col("title")))


def story_versions(bronze):
    return usable(fetched_stories(bronze))


def article_versions(bronze):
    return usable(fetched_articles(bronze))


def fetched_posts(bronze):
    """Every fetch of both feeds, usable or not, with cleaned fields."""
    return fetched_stories(bronze).select(*POST).unionByName(fetched_articles(bronze).select(*POST))


def fetched_stories(bronze):
    """Every fetch of every story."""
    rows = bronze.where(F.col("source") == STORIES)
    return (
        record_fields(rows, "raw_data", "record", STORY_RECORD, _keep())
        .select(
            F.col("id").alias("post_id"),
            F.lit(STORIES).alias("source"),
            F.trim("title").alias("title"),
            F.trim("url").alias("url"),
            F.col("score").try_cast("int").alias("score"),
            F.trim("by").alias("author"),
            F.lit(None).cast("string").alias("description"),
            epoch_to_ts(F.col("time")).alias("published_at"),
            "run_date", "load_id", "fetched_at",
        )
    )


def fetched_articles(bronze):
    """Every fetch of every article; `edition` is its publication text."""
    rows = bronze.where(F.col("source") == ARTICLES)
    return (
        record_fields(rows, "raw_data", "record", ARTICLE_RECORD, _keep())
        .select(
            F.col("load_id").alias("post_id"),
            F.lit(ARTICLES).alias("source"),
            clean_headline(F.col("title")).alias("title"),
            F.trim("url").alias("url"),
            F.lit(0).alias("score"),
            F.trim("source").alias("author"),
            F.trim("description").alias("description"),
            safe_ts(F.col("published_at")).alias("published_at"),
            "run_date", "load_id", "fetched_at",
            F.col("published_at").alias("edition"),
        )
    )


def _keep():
    return ["load_id", "fetched_at", F.col("fetch_date").alias("run_date")]


def best_stories(versions):
    """Highest score per story and run date; then the latest fetch, then a fixed order."""
    order = [
        F.desc_nulls_last("score"), F.desc("fetched_at"), "load_id",
        "title", "url", "author", "published_at",
    ]
    return keep_best(versions, ["run_date", "post_id"], order)


def latest_articles(versions):
    """Latest edition per url and run date, editions compared as text. Bodies do not take
    part in the order; rows alike in all else follow their hash."""
    order = [
        F.desc_nulls_last("edition"), F.desc("fetched_at"), "load_id", "title", "author",
        F.xxhash64("description"),
    ]
    return keep_best(versions, ["run_date", "url"], order)


def silver_stories(bronze):
    return best_stories(story_versions(bronze)).select(*POST)


def silver_articles(bronze):
    return latest_articles(article_versions(bronze)).select(*POST)


def silver_posts(bronze):
    return silver_stories(bronze).unionByName(silver_articles(bronze))
