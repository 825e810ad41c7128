"""Text and numbers to timestamps, NULL when they do not convert."""

from pyspark.sql import functions as F


def epoch_to_ts(seconds):
    return F.timestamp_seconds(seconds.try_cast("bigint"))


def safe_ts(text):
    return F.try_to_timestamp(text)
