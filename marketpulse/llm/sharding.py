"""Sharding by jump consistent hashing: a key and the number of shards give the shard, with
no ring or table. Appending a shard moves only the rows that go into it."""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketpulse.llm.common import documents, stored

MULTIPLIER = np.uint64(2862933555777941757)  # fixed value of the published algorithm


def jump_hash(keys, shards):
    """The shard of each 64-bit key. Every round moves a key ahead to the next shard count
    at which it would change place; it ends before the count that was asked for."""
    state = np.asarray(keys).astype(np.int64).view(np.uint64).copy()
    place = np.zeros(len(state), dtype=np.int64)
    target = np.zeros(len(state), dtype=np.int64)
    moving = np.arange(len(state))
    with np.errstate(over="ignore"):
        while len(moving):
            place[moving] = target[moving]
            state[moving] = state[moving] * MULTIPLIER + np.uint64(1)
            draw = (state[moving] >> np.uint64(33)).astype(np.float64) + 1.0
            target[moving] = ((place[moving] + 1) * (float(1 << 31) / draw)).astype(np.int64)
            moving = moving[target[moving] < shards]
    return place


def jump_shard(shards):
    """A column function: long key to shard number. A null key counts as key 0."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    @F.pandas_udf(T.IntegerType())
    def place(key):
        import pandas as pd

        return pd.Series(jump_hash(key.fillna(0).to_numpy(dtype="int64"), shards), dtype="int32")

    return place


def assign_shards(docs, shards=16, rows_per_range=200_000):
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    `size` is the text's UTF-8 bytes plus one (a null text has none), `text_crc32` the
    unsigned checksum of those bytes. The law is `key`: doc_id and the shard count alone
    decide; `grown_shard` is the shard with one shard more. Null ids count as key 0.
    `slot` numbers each shard's rows from 0 in the order of doc_id without gaps; rows of
    one id follow each other. An empty table gives no rows; texts of any length count by their
    size and checksum.

    Slots come from ranges: rows are sorted into ranges of ids, numbered inside each range
    and shard, and moved up by the rows of the earlier ranges. A repeated id is spread over
    ranges by the file split it was read from.
    """
    text = F.col("text").cast("binary")
    placed = documents(docs).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        F.spark_partition_id().alias("split"),
    )
    placed = stored(placed, "shard-rows")
    ranges = max(1, -(-placed.count() // rows_per_range))
    key = F.coalesce(F.col("doc_id"), F.lit(0))
    placed = (
        placed.repartitionByRange(ranges, F.col("doc_id"), F.col("split"))
        .withColumn("part", F.spark_partition_id())
        .withColumn("shard", jump_shard(shards)(key))
        .withColumn("grown_shard", jump_shard(shards + 1)(key))
    )
    placed = stored(placed, "shard-ranges")

    sizes = placed.groupBy("part", "shard").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "part", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("part", "shard").orderBy("doc_id", "split", "text_crc32", "size")
    numbered = placed.withColumn("place", F.row_number().over(inside))
    return numbered.join(offsets, ["part", "shard"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("offset") + F.col("place") - 1).cast("long").alias("slot"), "grown_shard",
    )
