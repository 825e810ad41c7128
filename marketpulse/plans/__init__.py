from marketpulse.plans.batch import catch_up, run_batch
from marketpulse.plans.bronze import article_rows, story_rows
from marketpulse.plans.document import daily_document, read_documents, write_documents
from marketpulse.plans.gold import (
    quality_profile, source_counts, source_summary, top_stories, total_count,
)
from marketpulse.plans.insights import daily_insights, insight_report, insights_all
from marketpulse.plans.silver import silver_articles, silver_posts, silver_stories

__all__ = [
    "article_rows", "catch_up", "daily_document", "daily_insights", "insight_report", "insights_all",
    "quality_profile", "read_documents", "run_batch", "silver_articles", "silver_posts", "silver_stories",
    "source_counts", "source_summary", "story_rows", "top_stories", "total_count",
    "write_documents",
]
