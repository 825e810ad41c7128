"""Open/high/low/close bars, alike for batch and stream."""

from datetime import timedelta

from pyspark.sql import functions as F

from marketpulse.functions import round_half_up

MICROSECOND = timedelta(microseconds=1)
MINUTE = timedelta(minutes=1)


def _arrival_order(ticks):
    """A number that grows with (event_time, part, seq) inside one bar.

    min_by/max_by over a struct makes Spark sort all ticks before the shuffle (struct
    buffers do not fit hash aggregation); over a plain number it aggregates by hash. A wide
    decimal holds the time inside a bar of up to a day (37 bits), the topic partition (20)
    and the whole offset (63).
    """
    inside = (F.unix_micros("event_time") - F.unix_micros("bar.start")).cast("decimal(12,0)")
    part = F.coalesce(F.col("part"), F.lit(0)) if "part" in ticks.columns else F.lit(0)
    seq = F.coalesce(F.col("seq"), F.lit(0)).cast("decimal(19,0)")
    place = (inside * F.lit(2**20)).cast("decimal(19,0)") + part
    return place.cast("decimal(19,0)") * F.lit(str(2**63)).cast("decimal(19,0)") + seq


def bars(ticks, every=MINUTE):
    """One row per symbol and bar. Open and close follow (event_time, part, seq); `part` may
    be missing. Offsets of two partitions do not compare, so ticks of one microsecond from
    several partitions follow the partition's number."""
    width = f"{every // MICROSECOND} microseconds"
    placed = ticks.select(
        F.window("event_time", width).alias("bar"), "symbol", "price", "event_time", "seq",
        *[c for c in ticks.columns if c == "part"],
    )
    order = F.when(F.col("price").isNotNull(), _arrival_order(ticks))
    return (
        placed.groupBy("bar", "symbol")
        .agg(
            F.min_by("price", order).alias("open_price"),
            F.max("price").alias("high_price"),
            F.min("price").alias("low_price"),
            F.max_by("price", order).alias("close_price"),
            F.avg("price").alias("mean_price"),
            F.count("price").alias("trade_count"),
        )
        .select(
            "symbol",
            F.col("bar.start").alias("minute_bucket"),
            "open_price", "high_price", "low_price", "close_price",
            round_half_up(F.col("mean_price"), 2).alias("avg_price"),
            "trade_count",
        )
    )


def latest_versions(updates, keys, version="batch_id"):
    """The last version of each key, for tables that receive changed rows as new rows.

    A key has each version once, so taking every column by itself gives one and the same
    row, and plain numbers then aggregate by hash where a struct would be sorted.
    """
    rest = [c for c in updates.columns if c not in keys and c != version]
    return updates.groupBy(*keys).agg(*[F.max_by(c, version).alias(c) for c in rest])
