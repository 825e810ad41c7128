"""Helpers that several operators share."""

from functools import reduce

from pyspark.sql import functions as F

from marketpulse.workspace import scratch_dir

DOC_COLUMNS = ("doc_id", "text")
KEY = ["row", "check"]  # the columns of `row_keys`
BITMAP_BITS = 8 * 4096  # bits that one bitmap row of Spark's bitmap functions holds
MAX_FILTER_BITS = 1 << 30  # 128 MB: the largest filter that is ever broadcast


def stored(df, label):
    """`df` written to the shared scratch folder and read again. Later jobs read the files,
    so a lost executor costs no recomputation and results cannot change between reads."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(batches, most=4 << 20):
    """Arrow batches in slices of some `most` bytes (one row at least), so that a task holds
    only so much text as Python objects at a time. What Arrow has put by goes at the end: the
    worker stays for other tasks."""
    import pyarrow as pa

    for batch in batches:
        step = max(1, batch.num_rows * most // max(1, batch.nbytes))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)
    pa.default_memory_pool().release_unused()


def documents(docs, *extra):
    """Only the columns an operator needs, so that other columns cannot clash with its own."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *extra,
    )


def row_keys():
    """Identify a row by id and text, in two columns of 64 bits each: rows alike in both are one
    row to the operators that join back, and rows that share only the id stay apart."""
    return [F.xxhash64("doc_id", "text").alias("row"), F.xxhash64(F.lit(1), "text", "doc_id").alias("check")]


def replace_columns(docs, *names):
    """`docs` without the columns an operator is about to add."""
    return docs.drop(*names)


def filter_bits(rows, bits_per_row=16):
    """Size of a filter over so many rows: a power of two, never above MAX_FILTER_BITS.
    A filter too small for its rows only lets more rows through; results do not change."""
    bits = BITMAP_BITS
    while bits < rows * bits_per_row and bits < MAX_FILTER_BITS:
        bits *= 2
    return bits


def cells(key, bits, hashes=2):
    """The positions that a key sets in a filter of so many bits."""
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(hashes)]


def bitmap_of(positions, column="cell"):
    """One row per 32,768 positions: number and bitmap of those present."""
    place = F.col(column) + 1  # the bitmap functions count from one
    return positions.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )


def bit_is_set(bits, cell):
    """Whether the bit of `cell` is set in its bitmap (null: no bitmap, so it is not)."""
    position = F.bitmap_bit_position(cell + 1)
    byte = F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    bit = F.pmod(position, F.lit(8)).cast("int")
    return F.coalesce(F.getbit(value, bit) == 1, F.lit(False))


def mark_possible(df, key, bitmaps, bits, name, hashes=2):
    """Adds `name`: false only if `key` is surely not in the filter. The bitmaps are broadcast;
    their size is bounded by MAX_FILTER_BITS through `filter_bits`."""
    flags = []
    for i, cell in enumerate(cells(key, bits, hashes)):
        side = bitmaps.select(F.col("bucket").alias(f"_b{i}"), F.col("bits").alias(f"_m{i}"))
        df = df.withColumn(f"_c{i}", cell)
        df = df.join(F.broadcast(side), F.bitmap_bucket_number(F.col(f"_c{i}") + 1) == F.col(f"_b{i}"), "left")
        flags.append(bit_is_set(F.col(f"_m{i}"), F.col(f"_c{i}")))
    drop = [f"_{x}{i}" for i in range(hashes) for x in "bmc"]
    return df.withColumn(name, reduce(lambda a, b: a & b, flags)).drop(*drop)

