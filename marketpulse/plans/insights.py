"""News next to prices, one row per day."""

from pyspark.sql import functions as F

from marketpulse.functions import money, or_text, percent
from marketpulse.operators import change_of_day, day_prices, symbol_daily_avg
from marketpulse.operators.prices import PRODUCTS
from marketpulse.plans.bronze import STORIES

NEWS = ["top_hn_story", "hn_max_score", "total_articles", "all_articles"]


def _news_figures():
    """Leading story, its score and the story count of one feed, and the count of all."""
    of_stories = F.col("source") == STORIES
    return [
        F.max(F.when(of_stories, F.col("top_story"))).alias("top_hn_story"),
        F.max(F.when(of_stories, F.col("max_score"))).alias("hn_max_score"),
        F.sum(F.when(of_stories, F.col("total_articles"))).alias("total_articles"),
        F.sum("total_articles").alias("all_articles"),
    ]


def insights_all(summary, ticks, products=PRODUCTS, change_of="btc"):
    """All days at once. A day with only news or only prices keeps its row."""
    news = summary.groupBy("report_date").agg(*_news_figures())
    prices = change_of_day(symbol_daily_avg(ticks, products), change_of)
    return news.join(prices, "report_date", "full_outer")


def daily_insights(summary, ticks, day, products=PRODUCTS, change_of="btc"):
    """One day, always exactly one row; a side without data is NULL.

    Both sides are aggregates without a key, so each is one row even on empty input. They
    are stacked and folded into one row instead of being joined.
    """
    day = F.lit(day).cast("date")
    news = summary.where(F.col("report_date") == day).agg(*_news_figures())
    prices = day_prices(ticks, day, products, change_of)
    both = news.unionByName(prices, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).select(
        day.alias("report_date"), *both.columns
    )


def insight_report(insights):
    """Each insight row as report text."""
    # The labels of the report and what stands for a missing value.
    lines = [
        ("Date          : ", F.col("report_date"), "None"),
        ("Top HN Story  : ", F.col("top_hn_story"), "None"),
        ("HN Score      : ", F.col("hn_max_score"), "None"),
        ("Total Articles: ", F.col("total_articles"), "None"),
        ("BTC Avg Price : ", money(F.col("btc_avg_price")), "N/A"),
        ("ETH Avg Price : ", money(F.col("eth_avg_price")), "N/A"),
        ("SOL Avg Price : ", money(F.col("sol_avg_price")), "N/A"),
        ("BTC Change    : ", percent(F.col("btc_price_change")), "N/A (need 2 days of data)"),
    ]
    rule = F.lit("=" * 60)
    body = [F.concat(F.lit(label), or_text(value, missing)) for label, value, missing in lines]
    return insights.select("report_date", F.concat_ws("\n", rule, *body, rule).alias("report"))
