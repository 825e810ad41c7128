"""One nested JSON document per day from both feeds."""

from pyspark.sql import functions as F

from marketpulse.operators import top_per_group
from marketpulse.schemas import DOCUMENTS
from marketpulse.sinks import read_days, replace_days


def _listed(records, limit, name, fields):
    """The first `limit` records of each day's last fetch, as an array in feed order.

    Rows are cut to `limit` per day before they are grouped, so no array outgrows it.
    """
    dated = records.where(F.col("feed_pos") <= limit).withColumn("ds", F.to_date("fetched_at"))
    newest_first = [F.desc("fetched_at"), "feed_pos", *fields]
    kept = top_per_group(dated, ["ds"], newest_first, limit, "_position")
    entry = F.struct("fetched_at", "feed_pos", F.struct(*fields).alias("record"))
    grouped = kept.groupBy("ds").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    last_fetch = F.filter(
        "entries", lambda e: e["fetched_at"] == F.array_max("entries")["fetched_at"]
    )
    return grouped.select("ds", F.transform(last_fetch, lambda e: e["record"]).alias(name))


def daily_document(stories, articles, limit=10):
    """`ds`, `hackernews` and `news`; a feed missing on a day gives an empty list."""
    s = _listed(stories, limit, "hackernews", ["id", "title", "score"])
    a = _listed(articles, limit, "news", ["title", "source"])
    both = s.join(a, "ds", "full_outer")
    return both.select("ds", *[F.coalesce(c, F.array()).alias(c) for c in ("hackernews", "news")])


def write_documents(documents, path, days=None):
    """One folder per day, one JSON line each. Other days stay; listed days without a
    document become empty."""
    replace_days(documents, path, days, "ds", kind="json")


def read_documents(spark, path, day=None):
    """The documents of all days, or of one."""
    return read_days(spark, path, DOCUMENTS, "ds", day, kind="json")
