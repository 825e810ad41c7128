"""The winners of each day: the versions of posts that silver has chosen so far, as a state
that new runs are merged into.

Choosing the best is associative, so the winners of a day and the rows of a new run give the
same winners as all runs together. The day's folder also lists the runs in it, one row each
with the time at which their folder was landed; both change in one switch. A day is up to date
if the digest of its landed runs is the one its version carries, which takes two listings and
opens no file.
"""

import hashlib

from pyspark.sql import functions as F

from marketpulse import schemas
from marketpulse.plans.bronze import ARTICLES, STORIES
from marketpulse.plans.silver import (
    POST, article_versions, best_stories, latest_articles, story_versions,
)
from marketpulse.sinks import pointers, read_days, read_folders, replace_days

DAY = "run_date"
RUN = "(run)"  # source of the rows that list the runs


def versions(bronze):
    """Every usable version of both feeds, with what decides between versions."""
    stories = story_versions(bronze).withColumn("edition", F.lit(None).cast("string"))
    return stories.unionByName(article_versions(bronze))


def best(rows):
    """The winners among versions of both feeds."""
    stories = best_stories(rows.where(F.col("source") == STORIES))
    return stories.unionByName(latest_articles(rows.where(F.col("source") == ARTICLES)))


def landed_runs(spark, bronze, day="*"):
    """{day: {run: stamp}} of the run folders in the bronze table, or of one day; a run that
    lands again gets another stamp."""
    found = {}
    for (day, _, run), stamp in pointers.stamped(spark, f"{bronze}/fetch_date={day}/source=*/run_id=*", 3):
        runs = found.setdefault(day.split("=", 1)[1], {})
        run = run.split("=", 1)[1]
        runs[run] = max(stamp, runs.get(run, stamp))
    return found


def digest(runs):
    return hashlib.md5(repr(sorted(runs.items())).encode()).hexdigest()[:16]


def changed_days(spark, landed, table):
    """The days whose landed runs are not those that the table has merged."""
    now = pointers.current(spark, table)
    return sorted(d for d, runs in landed.items() if now.get(d, "").rpartition("-")[2] != digest(runs))


def merged_runs(spark, table, days):
    """{day: {run: stamp}} of the runs in the winners of these days."""
    found = {day: {} for day in days}
    rows = read_days(spark, table, schemas.WINNERS, DAY, days=days).where(F.col("source") == RUN)
    for row in rows.select("post_id", "title", F.col(DAY).cast("string").alias("day")).collect():  # one per run
        found[row.day][row.post_id] = int(row.title)
    return found


def merge_days(spark, bronze, table, landed, days):
    """Bring the winners of these days up to date with the `landed` runs.

    Days that only have new runs read these and their winners. A day with a run that has
    landed again, whose earlier rows may have won, reads all of its runs. Folders of other
    days and runs stay closed.
    """
    merged = merged_runs(spark, table, days)
    paths, kept = [], []
    for day in days:
        again = any(merged[day].get(run, stamp) != stamp for run, stamp in landed[day].items())
        again = again or not set(merged[day]) <= set(landed[day])
        new = [run for run in landed[day] if again or run not in merged[day]]
        paths += [f"{bronze}/fetch_date={day}/source=*/run_id={run}" for run in new]
        if not again:
            kept.append(day)
    rows = read_winners(spark, table, kept)
    if paths:
        found = read_folders(spark, schemas.BRONZE_POSTS, bronze, paths)
        rows = rows.unionByName(versions(found).select(*rows.columns))
    marks = [(RUN, run, str(stamp), day) for day in days for run, stamp in landed[day].items()]
    marks = spark.createDataFrame(marks, "source string, post_id string, title string, day string")
    marks = marks.select("source", "post_id", "title", F.col("day").cast("date").alias(DAY))
    state = best(rows).unionByName(marks, allowMissingColumns=True)
    replace_days(state, table, days, DAY, notes={day: digest(landed[day]) for day in days})


def read_winners(spark, table, days):
    return read_days(spark, table, schemas.WINNERS, DAY, days=days).where(F.col("source") != RUN)


def posts_of(winners):
    """The winners as silver posts."""
    return winners.select(*POST)
