"""Landed feed responses to story and article records.

Stories land as one JSON item per row with the item's place in the feed (`feed_pos`, from 1);
articles land as one JSON response page per row. Both carry `fetched_at`.
"""

from pyspark.sql import functions as F

from marketpulse.functions import parse_records
from marketpulse.schemas import ARTICLE_PAGE, STORY_ITEM


def shape_stories(raw, limit=None, only_type="story", fields=None):
    """Story records from raw items.

    The cut by feed place comes first and the type filter second, so fewer than `limit`
    may remain. Items that do not parse have no type and drop out; `malformed` lists them.
    Without a `limit` the whole feed stays; `only_type=None` keeps every parsed item.
    """
    if limit is not None:
        raw = raw.where(F.col("feed_pos") <= limit)
    items = parse_records(raw, "value", STORY_ITEM, ["fetched_at", "feed_pos"])
    return _pick(story_records(items, only_type), fields)


def story_records(items, only_type="story"):
    """Parsed items of the wanted type, with defaults for missing fields."""
    wanted = F.col("id").isNotNull() if only_type is None else F.col("type") == only_type
    return items.where(wanted).select(
        "fetched_at", "feed_pos",
        F.col("id").try_cast("bigint").alias("id"),
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce(F.col("score").try_cast("int"), F.lit(0)).alias("score"),
        F.coalesce("by", F.lit("unknown")).alias("by"),
        F.coalesce(F.col("time").try_cast("bigint"), F.lit(0)).alias("time"),
    )


def shape_articles(raw, limit=None, fields=None):
    """Article records from response pages, the first `limit` of each page if there is one;
    `feed_pos` is the place on the page, from 1."""
    pages = parse_records(raw, "value", ARTICLE_PAGE, ["fetched_at"])
    return _pick(article_records(pages, limit), fields)


def article_records(pages, limit=None):
    """The articles of parsed pages, with the nested publisher name flattened.

    The outer generator keeps Catalyst from checking the size of the list below it, which would
    make all of the list once more where it is derived; what it adds for an empty list goes.
    """
    listed = pages.select("fetched_at", F.posexplode_outer("articles").alias("place", "article"))
    listed = listed.where(F.col("place").isNotNull())
    if limit is not None:
        listed = listed.where(F.col("place") < limit)
    return listed.select(
        "fetched_at",
        (F.col("place") + 1).alias("feed_pos"),
        F.coalesce("article.title", F.lit("")).alias("title"),
        F.coalesce("article.description", F.lit("")).alias("description"),
        F.coalesce("article.url", F.lit("")).alias("url"),
        F.col("article.source.name").alias("source"),
        F.coalesce("article.publishedAt", F.lit("")).alias("published_at"),
    )


def _pick(records, fields):
    return records if fields is None else records.select("fetched_at", "feed_pos", *fields)
