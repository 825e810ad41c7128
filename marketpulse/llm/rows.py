"""Leaving out rows that an operator has decided against, without shuffling the others."""

from pyspark.sql import functions as F

from marketpulse.llm.common import (
    KEY, bitmap_of, cells, filter_bits, mark_possible, stored,
)


def keyed(docs):
    """`_doc`, the whole row, and `_row` and `_check`, its key by id and text (null text:
    empty), 128 bits in two columns. In a struct no column of the input can clash with those
    that an operator adds."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"),
        F.xxhash64(doc_id, text).alias("_row"), F.xxhash64(F.lit(1), text, doc_id).alias("_check"),
    )


def same_row():
    """The condition that joins rows of `keyed` with a table that has `row_keys`."""
    return (F.col("_row") == F.col("row")) & (F.col("_check") == F.col("check"))


def filter_of(rows, label):
    """(bitmaps, bits) of a Bloom filter over the one column of `rows`, a stored table."""
    bits = filter_bits(rows.count())
    name = rows.columns[0]
    positions = rows.select(F.explode(F.array(*cells(F.col(name), bits))).alias("cell"))
    return stored(bitmap_of(positions), label), bits


def without_rows(docs, dropped, repeated):
    """`docs` without the rows whose key is in `dropped`, and with only one of the rows that
    share a key in `repeated` (both have row and check). Rows that a Bloom filter of both clears are not shuffled."""
    dropped = stored(dropped, "rows-dropped")
    touched = stored(dropped.unionAll(repeated), "rows-touched")
    bitmaps, bits = filter_of(touched.select("row"), "rows-filter")
    marked = mark_possible(keyed(docs), F.col("_row"), bitmaps, bits, "_possible")
    clear = marked.where(~F.col("_possible"))
    # One row per key leaves each task, however often a row is repeated.
    judged = marked.where("_possible").dropDuplicates(["_row", "_check"])
    return clear.unionAll(judged.join(dropped, same_row(), "left_anti")).select("_doc.*")
