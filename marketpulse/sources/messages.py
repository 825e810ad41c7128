"""Tick messages: where they come from and how one is read.

A source gives `value` (message text or bytes), `seq` (a long that grows with arrival within
one partition of the topic), `part` (that partition) and `arrived_at` (when the topic got it).
"""

from pyspark.sql import functions as F

from marketpulse.functions import parse_records, safe_ts
from marketpulse.schemas import TICK_MESSAGE

MESSAGE = "value string, seq long, part int, arrived_at timestamp"


def kafka_values(spark, servers, topic, starting="latest", max_per_trigger=None):
    """A topic as a stream of messages. Needs Spark's Kafka package."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select(
        "value", F.col("offset").alias("seq"), F.col("partition").alias("part"),
        F.col("timestamp").alias("arrived_at"),
    )


def file_values(spark, path, max_files=None):
    """Files of messages as a stream; columns that a file lacks are NULL."""
    reader = spark.readStream.schema(MESSAGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def parse_ticks(values):
    """Every message with what can be read of it; what cannot is NULL.

    Numbers may be written as JSON numbers or as text. `value` stays, as text.
    """
    missing = {"part": "int", "arrived_at": "timestamp"}
    values = values.withColumns(
        {c: F.lit(None).cast(kind) for c, kind in missing.items() if c not in values.columns}
        | {"value": F.col("value").cast("string")}
    )
    kept = ["value", "seq", "part", "arrived_at"]
    numbers = [F.col(c).try_cast("double").alias(c) for c in ("price", "volume", "high", "low")]
    return parse_records(values, "value", TICK_MESSAGE, kept).select(
        "value", "symbol", *numbers, safe_ts(F.col("timestamp")).alias("event_time"),
        "seq", "part", "arrived_at",
    )


def usable_price(price):
    """Positive and finite. In Spark NaN is above every number, so the second bound keeps
    out both NaN and infinity."""
    return (price > 0) & (price < float("inf"))


def is_valid():
    """A symbol, a time and a usable price; never NULL."""
    dated = F.col("symbol").isNotNull() & F.col("event_time").isNotNull()
    return dated & F.coalesce(usable_price(F.col("price")), F.lit(False))


def valid_ticks(ticks):
    return ticks.where(is_valid())


def bad_ticks(ticks):
    """The messages that are not valid ticks, with the first reason that applies."""
    nothing = F.coalesce("symbol", F.col("price").cast("string"), F.col("event_time").cast("string")).isNull()
    reason = (
        F.when(nothing, "unreadable").when(F.col("symbol").isNull(), "no symbol")
        .when(F.col("event_time").isNull(), "no time").otherwise("no price")
    )
    return ticks.where(~is_valid()).select("value", reason.alias("reason"), "seq", "part", "arrived_at")
