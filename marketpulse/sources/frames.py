"""Raw market-feed frames to tick records."""

from pyspark.sql import functions as F

from marketpulse.functions import first_usable_number, first_usable_text, parse_records
from marketpulse.schemas import FRAME, TICKER
from marketpulse.sources.messages import usable_price

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def normalize_frames(raw, symbols=None):
    """One record per ticker in a frame.

    Input: `value` (frame text), `received_at`, `seq`. A ticker stands either at the top of
    the frame or in `events[].tickers[]`; subscription replies hold none. Tickers without a
    symbol or a usable price are dropped. The exchange's own time is taken when the
    ticker carries one, else the time of receipt.
    """
    frames = parse_records(raw, "value", FRAME, ["received_at", "seq"])
    top_level = F.struct(*[F.col(name) for name in TICKER.fieldNames()])
    tickers = (
        F.when(F.col("type") == "subscriptions", F.lit(None))
        .when(F.col("type") == "ticker", F.array(top_level))
        .otherwise(F.flatten("events.tickers"))
    )
    t = frames.select("received_at", "seq", F.explode(tickers).alias("t"))
    ticks = t.select(
        first_usable_text(F.col("t.product_id"), F.col("t.symbol")).alias("symbol"),
        first_usable_number(F.col("t.price"), F.col("t.last_trade_price")).alias("price"),
        _or_zero("volume_24_h", "volume_24h").alias("volume"),
        _or_zero("high_24_h", "high_24h").alias("high"),
        _or_zero("low_24_h", "low_24h").alias("low"),
        F.coalesce(
            first_usable_text(F.col("t.time")), F.date_format("received_at", ISO_MICROS)
        ).alias("timestamp"),
        "seq",
    ).where(F.col("symbol").isNotNull() & usable_price(F.col("price")))
    return ticks if symbols is None else ticks.where(F.col("symbol").isin(list(symbols)))


def _or_zero(*names):
    return F.coalesce(first_usable_number(*[F.col(f"t.{n}") for n in names]), F.lit(0.0))
