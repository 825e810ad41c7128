"""Keys that come out the same in every run."""

from pyspark.sql import functions as F


def text_key(text):
    return F.sha2(text, 256)


def load_key(prefix, item_id, fetched_at):
    """`PREFIX_id_yyyyMMddHHmm`."""
    return F.concat_ws(
        "_", F.lit(prefix), item_id.cast("string"), F.date_format(fetched_at, "yyyyMMddHHmm")
    )
