"""The batch chain for one logical date, with a table after each step, and the catch-up of all
days that runs have landed for since."""

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Observation
from pyspark.sql import functions as F

from marketpulse import schemas
from marketpulse.functions import malformed
from marketpulse.operators.prices import PRODUCTS, of_days
from marketpulse.plans.bronze import ARTICLES, STORIES, article_rows, story_rows
from marketpulse.plans.gold import source_counts, source_summary, top_stories
from marketpulse.plans.insights import daily_insights, insight_report, insights_all
from marketpulse.plans.winners import (
    changed_days, digest, landed_runs, merge_days, posts_of, read_winners,
)
from marketpulse.sinks import append_audit, land_bronze, land_quarantine, read_days, replace_days
from marketpulse.sources import shape_articles, shape_stories

JOB = "news_to_gold"


def table_paths(root):
    names = [
        "bronze_posts", "quarantine", "run_audit", "winners", "silver_posts", "top_stories",
        "source_summary", "source_counts", "insights", "reports",
    ]
    return {name: f"{root}/{name}" for name in names}


def unparsed(raw_stories, raw_articles):
    """The landed texts of both feeds that are not JSON of their shape."""
    kinds = ((raw_stories, schemas.STORY_ITEM, STORIES), (raw_articles, schemas.ARTICLE_PAGE, ARTICLES))
    stories, articles = (
        malformed(raw, "value", schema, ["fetched_at"]).withColumn("feed", F.lit(feed))
        for raw, schema, feed in kinds
    )
    return stories.unionByName(articles)


class _Days:
    """Rebuilds the tables of some days from their landed runs."""

    def __init__(self, spark, paths, days, landed, stamp):
        self.spark, self.paths, self.days, self.landed, self.stamp = spark, paths, days, landed, stamp

    def publish(self, rows, name, day_column="report_date", few=True, notes=None, gathered=False):
        rows = rows.withColumn("loaded_at", F.lit(self.stamp))
        replace_days(rows, self.paths[name], self.days, day_column, notes=notes, few=few, gathered=gathered)

    def published(self, name, schema, day_column="report_date"):
        return read_days(self.spark, self.paths[name], schema, day_column, days=self.days)

    def silver(self, seen=None):
        """The posts; `seen` observes them as they are written."""
        bronze, table = self.paths["bronze_posts"], self.paths["winners"]
        stale = set(changed_days(self.spark, {d: self.landed[d] for d in self.days}, table))
        if stale:
            merge_days(self.spark, bronze, table, self.landed, sorted(stale))
        posts = posts_of(read_winners(self.spark, table, self.days))
        if seen is not None:
            posts = posts.observe(seen, F.count("*").alias("rows"))
        self.publish(posts, "silver_posts", "run_date", few=False, gathered=True)  # as the winners are
        return self.published("silver_posts", schemas.SILVER_POSTS, "run_date")

    def gold(self, posts, insight_of):
        """The gold tables; gives the insights. The reports are the last table, and their
        versions carry the digest of the runs in them."""
        self.publish(top_stories(posts), "top_stories")
        self.publish(source_counts(posts), "source_counts", "run_date")
        self.publish(source_summary(posts), "source_summary")
        self.publish(insight_of(self.published("source_summary", schemas.SOURCE_SUMMARY)), "insights")
        insight = self.published("insights", schemas.INSIGHTS)
        self.publish(insight_report(insight), "reports", notes={d: digest(self.landed[d]) for d in self.days})
        return insight


def run_batch(spark, root, logical_time, raw_stories, raw_articles, ticks, run_id=None,
              limit=None, products=PRODUCTS, change_of="btc"):
    """Land both feeds, merge them into the winners of their day, then rebuild its silver, gold
    and insight rows. Of the day's earlier runs only the winners are read.

    The rows belong to the date of `logical_time` (UTC), whenever the run takes place.
    The raw feeds hold what was fetched for this run, all of which is landed unless a `limit`
    cuts each feed; texts that do not parse go to the quarantine table. `ticks` is the silver
    price table. `run_id` names the run in bronze, quarantine and audit; a repeat under the
    same id replaces what it landed. By default it follows from the logical time.
    """
    logical = datetime.fromisoformat(str(logical_time))
    logical = logical if logical.tzinfo else logical.replace(tzinfo=timezone.utc)
    logical = logical.astimezone(timezone.utc)
    run_id = run_id or f"{logical:%Y%m%dT%H%M%S}"
    paths = table_paths(root)
    day = logical.date()
    started = datetime.now(timezone.utc)
    measured = {"fetched": 0, "loaded": 0}

    def close(status):
        append_audit(
            spark, paths["run_audit"], run_id, JOB, logical,
            measured["fetched"], measured["loaded"], status, started, datetime.now(timezone.utc),
        )

    try:
        stories, articles = shape_stories(raw_stories, limit), shape_articles(raw_articles, limit)
        at = F.lit(logical)
        landed = story_rows(stories.withColumn("fetched_at", at)).unionByName(
            article_rows(articles.withColumn("fetched_at", at))
        )
        seen = Observation(f"fetched-{run_id}")
        land_bronze(landed.observe(seen, F.count("*").alias("rows")), paths["bronze_posts"], run_id)
        measured["fetched"] = seen.get["rows"]
        land_quarantine(unparsed(raw_stories, raw_articles), paths["quarantine"], run_id, day)

        own, seen = str(day), Observation(f"loaded-{run_id}")
        landed = {own: landed_runs(spark, paths["bronze_posts"], own).get(own, {})}
        tables = _Days(spark, paths, [own], landed, started)
        posts = tables.silver(seen)
        measured["loaded"] = seen.get["rows"]
        insight = tables.gold(posts, lambda summary: daily_insights(summary, ticks, day, products, change_of))
    except Exception:
        close("FAILED")
        raise
    close("SUCCESS")
    return insight


def catch_up(spark, root, ticks, products=PRODUCTS, change_of="btc"):
    """Rebuild all days with landed runs that their tables do not hold, in one go; gives these
    days.

    Found by comparing names and times of folders: feeds that were landed without the rest of
    the chain, runs that failed on the way, and runs that landed again. No file of another day
    is opened. `ticks` is the silver price table; of it these days and those before are read.
    """
    paths, started = table_paths(root), datetime.now(timezone.utc)
    landed = landed_runs(spark, paths["bronze_posts"])
    days = changed_days(spark, landed, paths["reports"])

    def insight_of(summary):
        own = [date.fromisoformat(d) for d in days]
        prices = of_days(ticks, *map(F.lit, sorted({d - timedelta(n) for d in own for n in (0, 1)})))
        every = spark.createDataFrame([(d,) for d in days], "day string")
        every = every.select(F.col("day").cast("date").alias("report_date"))
        return every.join(insights_all(summary, prices, products, change_of), "report_date", "left")

    if days:
        tables = _Days(spark, paths, days, landed, started)
        tables.gold(tables.silver(), insight_of)
    return days
