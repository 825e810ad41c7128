"""The tick streams: bronze, quarantine, silver and bars.

Every query has its own checkpoint. File sinks are exactly-once. The changed-bars sink
writes one folder per day and micro-batch and overwrites it when Spark repeats the batch, so
a table belongs to one checkpoint.
"""

import json

from pyspark.sql import functions as F

from marketpulse.operators import bars
from marketpulse.operators.bars import MINUTE
from marketpulse.schemas import BRONZE_TICKS
from marketpulse.sinks import replace_folders
from marketpulse.sources.messages import MESSAGE, bad_ticks, parse_ticks, valid_ticks

LATENESS = "30 seconds"
END = "(end)"  # symbol of the message that closes all bars
WRITTEN = "written"  # what a micro-batch gives its sink, as its progress shows it
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def counted(rows):
    """The rows, counted as they pass: sinks do not tell how many they get."""
    return rows.observe(WRITTEN, F.count(F.lit(1)).alias("rows"))


def _start(writer, checkpoint, every):
    """Run on a fixed rhythm, or once over what is there when `every` is None."""
    writer = writer.option("checkpointLocation", checkpoint)
    if every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()


def _to_files(rows, path, checkpoint, every, *folders):
    stamped = counted(rows.withColumn("loaded_at", F.current_timestamp()))
    writer = stamped.writeStream.format("parquet").outputMode("append").option("path", path)
    return _start(writer.partitionBy(*folders) if folders else writer, checkpoint, every)


def start_bronze(values, path, checkpoint, every="10 seconds"):
    """Every message, as it came and as far as it could be read."""
    arrived = F.to_date(F.coalesce("arrived_at", F.current_timestamp()))
    return _to_files(parse_ticks(values).withColumn("arrived_date", arrived), path, checkpoint, every, "arrived_date")


def tick_stream(spark, bronze_path, max_files=None):
    """The bronze table as a stream; only what its sink has committed is read."""
    reader = spark.readStream.schema(BRONZE_TICKS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(bronze_path).drop("arrived_date", "loaded_at")


def start_silver(ticks, path, checkpoint, every="10 seconds"):
    """Valid ticks, appended. No state: late ticks are kept."""
    kept = valid_ticks(ticks).drop("value", "arrived_at")
    return _to_files(
        kept.withColumn("event_date", F.to_date("event_time")), path, checkpoint, every, "event_date"
    )


def start_quarantine(ticks, path, checkpoint, every="10 seconds"):
    """The messages that silver leaves out, with the reason."""
    return _to_files(bad_ticks(ticks), path, checkpoint, every)


def stream_bars(ticks, width=MINUTE, lateness=LATENESS):
    """Bars over a stream. A tick later than the watermark no longer changes its bar."""
    return bars(valid_ticks(ticks).withWatermark("event_time", lateness), width)


def with_day(rows):
    return rows.withColumn("bar_date", F.to_date("minute_bucket"))


def start_bars_final(ticks, path, checkpoint, every="60 seconds", width=MINUTE):
    """Each bar once, when the watermark has passed its end. The last bars wait for later
    ticks; `end_marker` is a message that closes them."""
    writer = (
        counted(with_day(stream_bars(ticks, width))).writeStream.format("parquet").outputMode("append")
        .partitionBy("bar_date").option("path", path)
    )
    return _start(writer, checkpoint, every)


def end_marker(spark, at="9000-01-01T00:00:00"):
    """One message whose time is after all others."""
    text = json.dumps({"symbol": END, "price": 1, "timestamp": at})
    return spark.createDataFrame([(text, 0, 0, None)], MESSAGE)


def start_bars(ticks, path, checkpoint, every="60 seconds", width=MINUTE):
    """Each bar again whenever it changed; `bar_table` reads and merges the changes."""

    def write_changes(batch, batch_id):
        rows = with_day(batch).withColumn("batch_id", F.lit(batch_id).cast("long"))
        replace_folders(rows, path, "bar_date", "batch_id")

    changed = counted(stream_bars(ticks, width))
    writer = changed.writeStream.outputMode("update").foreachBatch(write_changes)
    return _start(writer, checkpoint, every)


def start_streams(spark, values, root, silver_every="10 seconds", bars_every="60 seconds",
                  max_files=1000, state_store=ROCKSDB):
    """Messages to bronze, and from bronze to silver, to quarantine and to changed bars.

    Bronze is the record all else derives from. With `None` as rhythm each query runs over
    what is there and ends; bronze then finishes before the others start. A micro-batch takes
    at most `max_files` bronze files; what the source gives bronze is bounded by the source.
    Open bars are kept by `state_store`, by default on the executors' disks and not in their
    heap; a checkpoint keeps the one it was started with. `service.watch` waits for them.
    """
    def places(name):
        return f"{root}/{name}", f"{root}/checkpoints/{name}"

    def ticks():
        return tick_stream(spark, f"{root}/bronze_ticks", max_files)

    bronze = start_bronze(values, *places("bronze_ticks"), every=silver_every)
    if silver_every is None:
        bronze.awaitTermination()
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, state_store)  # a query keeps the setting it starts with
    try:
        return {
            "bronze": bronze,
            "silver": start_silver(ticks(), *places("silver_prices"), every=silver_every),
            "quarantine": start_quarantine(ticks(), *places("quarantine"), every=silver_every),
            "bars": start_bars(ticks(), *places("bars"), every=bars_every),
        }
    finally:
        spark.conf.set(STATE_STORE, before)


def open_bars(spark, checkpoint):
    """The bars that the stream still holds in its state, by symbol and minute_bucket: those
    that the watermark has not passed. Read from the checkpoint of its last commit, while
    the stream may run."""
    key = spark.read.format("statestore").load(checkpoint).select("key.*")
    return key.select("symbol", F.col("bar.start").alias("minute_bucket"))
