"""Posts to the per-day tables."""

from pyspark.sql import functions as F

from marketpulse.functions import is_blank, round_half_up
from marketpulse.operators import top_per_group

# The total order of posts: score, then publication, then id, all from high to low and
# unknown values last.
RANK_KEY = ["score", "published_at", "post_id"]


def top_stories(posts, n=10):
    """The n best posts per run date and source, ranked from 1."""
    order = [F.desc_nulls_last(c) for c in RANK_KEY]
    return top_per_group(posts, ["run_date", "source"], order, n).select(
        F.col("run_date").alias("report_date"),
        "source", "title", "url", "score", "author",
        F.to_date("published_at").alias("published_date"),
        "rank",
    )


def source_summary(posts):
    """Posts, average, best score and best title per run date and source.

    The figures go through hash aggregation; the title is that of the first post in rank,
    which every task finds before the shuffle. An aggregate that returns text would sort all
    posts instead.
    """
    figures = posts.groupBy(F.col("run_date").alias("report_date"), "source").agg(
        F.count("*").alias("total_articles"),
        round_half_up(F.avg("score"), 1).alias("avg_score"),
        F.max("score").alias("max_score"),
    )
    leaders = top_stories(posts, 1).select("report_date", "source", F.col("title").alias("top_story"))
    return figures.join(leaders, ["report_date", "source"], "left")


def source_counts(posts):
    return posts.groupBy("run_date", "source").agg(F.count("*").alias("total"))


def total_count(posts):
    return posts.agg(F.count("*").alias("total"))


def quality_profile(posts):
    """Missing values and score figures per run date and source, of posts or of all that was
    fetched. Blank text counts as missing."""

    def missing(column):
        return F.count(F.when(is_blank(F.col(column).cast("string")), 1))

    return posts.groupBy("run_date", "source").agg(
        F.count("*").alias("total_records"),
        missing("url").alias("missing_url"),
        missing("title").alias("missing_title"),
        missing("published_at").alias("missing_date"),
        round_half_up(F.avg("score"), 1).alias("avg_score"),
        F.max("score").alias("max_score"),
    )
