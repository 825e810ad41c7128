"""Exact dedup: a Bloom filter of hashes met twice decides which rows need a shuffle.

Pass one hashes every normalised text and counts, per filter cell, how many rows set it.
Cells set at least twice form a bitmap. Pass two probes it: a row with a cell that only it
has set cannot have a twin and goes straight to the result. The rest, the possible twins,
are grouped by their hash. Only Spark SQL functions are used.
"""

from pyspark.sql import functions as F

from marketpulse.llm.common import (
    bitmap_of, cells, documents, filter_bits, mark_possible, replace_columns, stored,
)

SPACES = r"[\x20\x09-\x0D]+"
DECISIONS = ("keep_id", "group_size", "kept", "text_sha256")


def normalised(text):
    return F.regexp_replace(text, SPACES, " ")


def text_hashes(docs):
    """doc_id and the SHA-256 (32 bytes) of the normalised text; a null text counts as empty."""
    return documents(docs).select("doc_id", F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("sha"))


def repeated_cells(hashes, bits):
    """Bitmaps of the filter cells that at least two rows set."""
    counted = (
        hashes.select(F.explode(F.array(*cells(F.col("sha"), bits))).alias("cell"))
        .groupBy("cell").count().where("count > 1")
    )
    return bitmap_of(counted)


def dedup_decisions(docs, bits_per_row=16):
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the smallest doc_id stays; a null doc_id comes after all
    others. Empty and null texts form one group. Rows that share both text and doc_id: each
    is a row of its own in `group_size`, and each carries the smallest id, so all of them
    count as kept. An empty table gives no rows; texts of any length count by their hash.

    The filter takes `bits_per_row` bits a row up to 128 MB. Beyond some 67 million rows it
    fills up and more rows take the shuffle (40 bytes each); the result stays the same.
    """
    hashes = stored(text_hashes(docs), "exact-hashes")
    bits = filter_bits(hashes.count(), bits_per_row)
    bitmaps = stored(repeated_cells(hashes, bits), "exact-filter")
    probed = mark_possible(hashes, F.col("sha"), bitmaps, bits, "possible")

    alone = probed.where(~F.col("possible")).select(
        "doc_id", "sha", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
    )
    # Counted before the shuffle and stored, so that the join below is between two plain
    # shuffles, of which Spark splits an oversized partition.
    groups = stored(
        probed.where("possible").groupBy("sha").agg(
            F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
        ),
        "exact-groups",
    )
    twins = probed.where("possible").join(groups, "sha").select("doc_id", "sha", "keep_id", "group_size")
    return alone.unionAll(twins).select(
        "doc_id", "keep_id", "group_size",
        F.equal_null("doc_id", "keep_id").alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def exact_dedup(docs, bits_per_row=16):
    """`docs` with one row per distinct normalised text, all columns included.

    Rows alike in text and doc_id count as one row; one of them stays. Input columns named
    like a decision are replaced.
    """
    dropped = dedup_decisions(docs, bits_per_row).where(~F.col("kept")).select("doc_id", "text_sha256")
    sha = F.lower(F.hex(F.unhex(F.sha2(normalised(F.coalesce(F.col("text"), F.lit(""))), 256))))
    marked = replace_columns(docs, *DECISIONS).withColumn("text_sha256", sha)
    same = F.equal_null(marked.doc_id, dropped.doc_id) & (marked.text_sha256 == dropped.text_sha256)
    return marked.join(dropped, same, "left_anti").dropDuplicates(["doc_id", "text_sha256"])
