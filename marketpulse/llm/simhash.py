"""SimHash near-dedup. Fingerprints at most two bits apart are linked; a Golay code finds the
pairs: of three segments of a fingerprint one has no differing bit, and the next one has at
most two, so that the lists of codewords near it share an entry. That segment and a codeword
index make a join key; the pairs that meet are verified."""

from itertools import accumulate

import numpy as np
from pyspark.sql import functions as F

from marketpulse.llm.common import KEY, documents, row_keys, small, stored
from marketpulse.llm.components import connected
from marketpulse.llm.golay import DATA, near_indices
from marketpulse.llm.rows import without_rows

MAX_BITS = 2  # fixed by the code: its lists meet for values at most two bits apart
SEGMENTS = ((0, 21), (21, 21), (42, 22))  # first bit and length
PAIRED = 16  # fingerprints per key up to which pairs are compared one by one


def fingerprint(text, width=3, block=8192):
    """The unsigned 64-bit SimHash of a text: a bit is set where more than half of the
    shingles' hashes have it. No words: zero."""
    import xxhash

    words = text.encode().lower().split()  # bytes: A-Z only, and ASCII white space
    if not words:
        return 0
    width = min(width, len(words))
    joined = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    ends = [s - 1 for s in starts[width:]]
    n, ones, digest = len(ends), np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for first in range(0, n, block):
        part = zip(starts[first:first + block], ends[first:first + block])
        hashes = np.array([digest(joined[a:b], 42) for a, b in part], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(docs, width=3):
    """doc_id, row and check (key of the row) and fp, the fingerprint as a signed long."""

    def run(batches):
        import pyarrow as pa

        for batch in small(batches):
            prints = np.array([fingerprint(t, width) for t in batch.column(3).to_pylist()], dtype=np.uint64)
            columns = [*batch.columns[:3], pa.array(prints.view(np.int64))]
            yield pa.record_batch(columns, ["doc_id", *KEY, "fp"])

    picked = documents(docs).select("doc_id", *row_keys(), "text")
    return picked.mapInArrow(run, "doc_id long, row long, check long, fp long")


def search_keys(prints):
    """key and fp: for each segment taken as exact, one key per codeword near the next."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            bits = fp.view(np.uint64)
            parts = [((bits >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in SEGMENTS]
            for i, exact in enumerate(parts):
                index = near_indices(parts[(i + 1) % len(parts)])
                keys = (((i << 22) | exact)[:, None] << DATA) | index
                use = index >= 0
                owner = np.repeat(fp, use.sum(axis=1))
                yield pa.record_batch([pa.array(keys[use]), pa.array(owner)], ["key", "fp"])

    return prints.select("fp").mapInArrow(run, "key long, fp long")


def links_between(prints):
    """Links (a, b) between distinct fingerprints such that all fingerprints at most two bits
    apart are connected by links, and no others.

    Keys that few fingerprints share give pairs to verify. Fingerprints that crowd a key are
    linked without pairs: each is put at itself and at the 64 values one bit away; two are
    at most two bits apart exactly if they meet at a value, and there all link to the
    smallest.
    """
    keys = search_keys(prints)
    sizes = stored(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-keys")
    shared = stored(keys.join(sizes, "key"), "simhash-shared")

    few = shared.where(F.col("n") <= PAIRED)
    one, other = few.select("key", F.col("fp").alias("a")), few.select("key", F.col("fp").alias("b"))
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = one.join(other, "key").where((F.col("a") < F.col("b")) & (apart <= MAX_BITS)).select("a", "b")

    crowd = stored(shared.where(F.col("n") > PAIRED).select("fp").distinct(), "simhash-crowd")
    flips = [F.lit(0), *(F.lit(1 << i if i < 63 else -(1 << 63)) for i in range(64))]
    points = crowd.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(f) for f in flips])).alias("point"))
    meets = points.groupBy("point").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    meets = stored(meets.select("point", "a"), "simhash-points")
    stars = points.join(meets, "point").where("fp <> a").select("a", F.col("fp").alias("b"))
    return pairs.unionAll(stars).distinct()


def classes(docs, width=3):
    """doc_id, row, check, fp and component_id of every row, from stored tables."""
    prints = stored(fingerprints(docs, width), "simhash-prints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    roots = stored(connected(links_between(nodes)), "simhash-roots")
    linked = nodes.join(roots.withColumnRenamed("node", "fp"), "fp")
    smallest = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = stored(roots.join(smallest, "root").select(F.col("node").alias("fp"), "component_id"), "simhash-labels")
    members = stored(
        nodes.join(labels, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id")),
        "simhash-members",
    )
    return prints.join(members, "fp").select("doc_id", *KEY, "fp", "component_id")


def near_duplicates(docs, width=3):
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Words are what ASCII white space separates, lower-cased in A-Z only; shingles are `width`
    words joined by spaces, repeats included; a shorter text is one shingle, a text without
    words (null, empty, blank) has the fingerprint zero and is linked like any other.
    `component_id` is the smallest doc_id that links lead to, null if none of them has an id.
    Repeated rows give repeated results, whole texts of any length one
    fingerprint. An empty table gives no rows.
    """
    return classes(docs, width).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def near_dedup(docs, width=3):
    """`docs` with one document per group of linked fingerprints, the one with the smallest
    doc_id, all columns included. Rows without an id go if their group has an id, and stay
    otherwise. Of rows alike in id and text one stays."""
    found = stored(classes(docs, width), "simhash-classes")
    dropped = found.where(~F.equal_null("doc_id", "component_id")).select(*KEY).distinct()
    repeated = found.groupBy(*KEY).count().where("count > 1").select(*KEY)
    return without_rows(docs, dropped, repeated)
