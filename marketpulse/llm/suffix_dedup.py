"""Suffix-array dedup by bucket-pointer refinement: find every string of 200 bytes that
starts more than once in the corpus.

Positions are sorted into buckets by what follows them, and buckets are refined by the bucket
identifiers of later offsets. An identifier of depth 2d at a position is made from those of
depth d there and d bytes on, so each depth reuses the one before (identifiers are 64-bit
hashes of content, hence the same in every task without a global count). Three refinements
cross the corpus, each only over what the one before left undecided:

1. Depth 64, at sampled positions. Of the 64-byte strings inside each 200 bytes the one with
   the smallest identifier is its anchor, so equal 200 bytes have equal anchors at equal
   offsets. An anchor alone in its bucket decides all starts that it stands for.
2. The surroundings of an anchor: everything its starts cover. Anchors that share a bucket of
   depth 64 and that of their surroundings: all their starts repeat.
3. Depth 200, from the identifiers at offsets 0, 64, 128 and 136, for the starts of anchors
   whose bucket holds different surroundings. Eight neighbouring starts have 193 bytes in
   common; only where these repeat are the eight looked at, together first and then one by one.
"""

import numpy as np
from pyspark.sql import functions as F

from marketpulse.llm.common import KEY, documents, mark_possible, row_keys, small, stored
from marketpulse.llm.rows import filter_of, keyed, same_row

LENGTH, GRAM = 200, 64  # bytes of a repeated string, and of an anchor
WINDOW = LENGTH - GRAM + 1  # anchors to choose from
GROUP = 8  # neighbouring starts whose common bytes are looked at first
PIECE = 1 << 20  # starts of one document that are worked on at a time
CHUNK = 1 << 18  # bytes of short documents that are worked on together
ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))  # odd multipliers


def mixed(a, b):
    """An identifier of the pair of two identifiers."""
    with np.errstate(over="ignore"):
        x = a * ODD[0] + b
        x ^= x >> np.uint64(31)
        x *= ODD[1]
        x ^= x >> np.uint64(29)
    return x


def identifiers(raw):
    """Bucket identifiers of depth 64 for each position of a byte array that has so many
    bytes after it."""
    ids = mixed(np.arange(256, dtype=np.uint64) + np.uint64(1), ODD[1])[raw]
    depth = 1
    while depth < GRAM:
        ids = mixed(ids[:-depth], ids[depth:])
        depth *= 2
    return ids


def sliding_least(values, width):
    """The least of each `width` neighbouring values."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:len(values) - (width - size)], values[width - size:]) if size < width else values


def at_depth(ids, starts, depth):
    """Bucket identifiers of a depth from 129 to 256 at the given positions."""
    pair = mixed(ids[starts], ids[starts + GRAM])
    return mixed(pair, mixed(ids[starts + min(2 * GRAM, depth - GRAM)], ids[starts + depth - GRAM]))


def anchors(raw, ends):
    """Of the starts in a byte array that holds several texts, which end at `ends`: anchor
    position, its identifier, first and last start, and an identifier of its surroundings."""
    if len(raw) < LENGTH:
        return None
    ids = identifiers(raw)
    place = np.arange(len(ids), dtype=np.uint64)
    least = sliding_least((ids >> np.uint64(32) << np.uint64(32)) | place, WINDOW)
    sizes = np.diff(ends, prepend=0)
    limit = np.repeat(ends, sizes)[:len(least)]
    starts = np.flatnonzero(np.arange(len(least)) + LENGTH <= limit)
    if not len(starts):
        return None
    anchor = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.diff(anchor, prepend=-1))
    last = np.append(first[1:], len(anchor)) - 1
    anchor, low, high = anchor[first], starts[first], starts[last]
    around = mixed((anchor - low).astype(np.uint64), (high - low).astype(np.uint64))
    for offset in range(0, LENGTH + WINDOW, GRAM):
        around = mixed(around, ids[np.minimum(low + offset, high + LENGTH - GRAM)])
    return anchor, ids[anchor], low, high, around


def chunks(rows):
    """(raw, ends, owners, offsets): texts put together up to CHUNK bytes; a long text comes
    in pieces of PIECE starts that overlap by LENGTH - 1 bytes."""
    parts, owners, offsets, size = [], [], [], 0

    def chunk():
        return np.concatenate(parts), np.cumsum([len(p) for p in parts]), owners, offsets

    for owner, text in rows:
        whole = np.frombuffer(text, dtype=np.uint8)
        for start in range(0, max(1, len(whole) - LENGTH + 1), PIECE):
            piece = whole[start:start + PIECE + LENGTH - 1]
            if size and size + len(piece) > CHUNK:
                yield chunk()
                parts, owners, offsets, size = [], [], [], 0
            parts.append(piece)
            owners.append(owner)
            offsets.append(start)
            size += len(piece)
    if size:
        yield chunk()


ANCHORS = "gram long, around long, row long, check long, low int, span short, place short"


def sampled_buckets(docs):
    """gram (bucket of depth 64), around, row and check (key of the row), low (first start), span
    (last start less the first) and place (the anchor less the first start) of every anchor."""

    def run(batches):
        import pyarrow as pa

        names = [field.split()[0] for field in ANCHORS.split(", ")]
        for batch in small(batches):
            keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)]
            rows = enumerate(batch.column(2).to_pylist())
            for raw, ends, owners, offsets in chunks((r, t) for r, t in rows if len(t) >= LENGTH):
                found = anchors(raw, ends)
                if found is None:
                    continue
                anchor, gram, low, high, around = found
                part = np.searchsorted(ends, low, side="right")
                begins = np.append(0, ends[:-1]) - np.array(offsets)
                owner = np.array(owners, dtype=np.int64)[part]
                columns = [
                    pa.array(gram.view(np.int64)), pa.array(around.view(np.int64)),
                    *(pa.array(key[owner]) for key in keys),
                    pa.array((low - begins[part]).astype(np.int32)), pa.array((high - low).astype(np.int16)),
                    pa.array((anchor - low).astype(np.int16)),
                ]
                yield pa.record_batch(columns, names)

    texts = documents(docs).select(*row_keys(), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, ANCHORS)


def suspects(docs, rows, label):
    """The documents with their key and `_possible`, false where a Bloom filter of the column
    `row` clears one."""
    bitmaps, bits = filter_of(rows, label)
    marked = mark_possible(keyed(documents(docs)), F.col("_row"), bitmaps, bits, "_possible")
    return marked.select("_doc.*", "_row", "_check", "_possible")


def list_column(column, *fields):
    """Bounds of each row's entries in a column of arrays of structs, and the fields of all
    entries as flat arrays. A null is an array without entries."""
    entries = column.flatten()
    names = [entries.type.field(i).name for i in range(entries.type.num_fields)]
    by_name = dict(zip(names, entries.flatten()))
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = [by_name[f].to_numpy(zero_copy_only=False) for f in fields]
    return np.append(0, np.cumsum(sizes)), flat


def start_groups(low, span, place):
    """(owner, first start, end of starts, start of the common bytes) of the groups of starts
    of some anchors. Groups are aligned to the anchor, so equal strings are in equal groups."""
    nearest = (place - span) // GROUP
    counts = place // GROUP - nearest + 1
    owner = np.repeat(np.arange(len(low)), counts)
    number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    common = (low + place)[owner] - GROUP * (nearest[owner] + number)
    first = np.maximum(common - GROUP + 1, low[owner])
    return owner, first, np.minimum(common, (low + span)[owner]) + 1, common


DEEP = "gram long, core long, row long, check long, start int, alone boolean, deep array<long>"


def deep_buckets(docs, undecided):
    """For each group of starts of the anchors in `undecided` (row, check, gram, low, span,
    place, alone): gram, core (bucket of the common bytes), row, check, start, alone and deep,
    the buckets of depth 200 of its starts."""
    anchor = F.struct("gram", "low", "span", "place", "alone")
    wanted = stored(undecided.groupBy(*KEY).agg(F.collect_list(anchor).alias("wanted")), "suffix-wanted")
    texts = suspects(docs, wanted.select("row"), "suffix-filter").where("_possible")
    # Rows alike in id and text may each give the same groups: they are not `alone`, and what
    # others have in common with them repeats however often they come.
    texts = texts.join(wanted, same_row())

    def run(batches):
        import pyarrow as pa

        names = [field.split()[0] for field in DEEP.split(", ")]
        for batch in small(batches):
            bounds, anchors_of = list_column(batch.column(3), "low", "span", "place", "gram", "alone")
            keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)]
            for i, text in enumerate(batch.column(2)):
                raw = np.frombuffer(text.as_buffer(), dtype=np.uint8)
                found = [field[bounds[i]:bounds[i + 1]] for field in anchors_of]
                order = np.argsort(found[0], kind="stable")
                low, span, place, gram, alone = (field[order] for field in found)
                low, span, place = (x.astype(np.int64) for x in (low, span, place))
                at = 0
                while at < len(low):
                    base, stop = low[at], np.searchsorted(low, low[at] + PIECE)
                    some = slice(at, stop)
                    at = stop
                    # The common bytes of a group may begin after its last start.
                    ids = identifiers(raw[base:(low + span)[some].max() + LENGTH])
                    owner, first, end, common = start_groups(low[some], span[some], place[some])
                    sizes = end - first
                    offsets = np.append(0, np.cumsum(sizes))
                    starts = np.repeat(first - offsets[:-1], sizes) + np.arange(offsets[-1])
                    deep = pa.array(at_depth(ids, starts - base, LENGTH).view(np.int64))
                    columns = [
                        pa.array(gram[some][owner]),
                        pa.array(at_depth(ids, common - base, LENGTH - GROUP + 1).view(np.int64)),
                        *(pa.array(np.full(len(owner), key[i])) for key in keys),
                        pa.array(first.astype(np.int32)),
                        pa.array(alone[some][owner]),
                        pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), deep),
                    ]
                    yield pa.record_batch(columns, names)

    return texts.select(*KEY, "text", "wanted").mapInArrow(run, DEEP)


def repeated_only(rows, *key, label):
    """Rows whose key another row has too. A Bloom filter of the repeated keys comes first, so
    that the join shuffles few others. The rows are read twice."""
    keys = stored(rows.groupBy(*key).count().where("count > 1").select(*key), f"{label}-keys")
    bitmaps, bits = filter_of(keys.select(F.xxhash64(*key).alias("key")), f"{label}-filter")
    marked = mark_possible(rows, F.xxhash64(*key), bitmaps, bits, "_possible")
    return marked.where("_possible").drop("_possible").join(keys, list(key))


def single_starts(groups):
    """row, check, low and high of the single anchors' starts whose string of 200 bytes repeats."""
    groups = stored(groups, "suffix-groups")
    common = repeated_only(groups, "gram", "core", label="suffix-core")
    common = stored(common.withColumn("whole", F.xxhash64("deep")), "suffix-common")
    # Groups that agree in all their starts are decided; of those one takes part in the rest.
    key = ["gram", "core", "whole"]
    kinds = stored(
        common.groupBy(*key).agg(
            F.count(F.lit(1)).alias("rows"),
            *(F.first(c).alias(c) for c in ("deep", *KEY, "start", "alone")),
        ), "suffix-kinds",
    )
    agreed = common.where("alone").join(kinds.where("rows > 1").select(*key), key)
    agreed = agreed.select(*KEY, F.col("start").alias("low"), (F.col("start") + F.size("deep") - 1).alias("high"))

    open_cores = stored(kinds.groupBy("gram", "core").count().where("count > 1").select("gram", "core"), "suffix-open")
    open_kinds = kinds.join(open_cores, ["gram", "core"]).withColumn("alone", F.col("alone") & (F.col("rows") == 1))
    deep = open_kinds.select("gram", *KEY, "start", "alone", F.posexplode("deep").alias("step", "deep"))
    deep = deep.select("gram", "deep", *KEY, (F.col("start") + F.col("step")).alias("start"), "alone")
    deep = stored(deep, "suffix-deep")
    twice = stored(deep.groupBy("gram", "deep").count().where("count > 1").select("gram", "deep"), "suffix-twice")
    single = deep.where("alone").join(twice, ["gram", "deep"])
    return agreed.unionAll(single.select(*KEY, F.col("start").alias("low"), F.col("start").alias("high")))


def repeated_starts(docs):
    """row, check, low and high: ranges of starts at which a string of 200 bytes begins that also
    begins somewhere else."""
    # All anchors together take as much room as the corpus: they are made twice and not stored.
    shared = stored(repeated_only(sampled_buckets(docs), "gram", label="suffix-gram"), "suffix-shared")

    one = F.min(F.struct(*KEY, "low", "span", "place")).alias("one")
    around = stored(
        shared.groupBy("gram", "around").agg(F.count(F.lit(1)).alias("rows"), one), "suffix-around"
    )
    same = shared.join(around.where("rows > 1").select("gram", "around"), ["gram", "around"])
    whole = same.select(*KEY, "low", (F.col("low") + F.col("span")).alias("high"))

    mixed_grams = stored(around.groupBy("gram").count().where("count > 1").select("gram"), "suffix-mixed")
    undecided = around.join(mixed_grams, "gram").select("gram", "one.*", (F.col("rows") == 1).alias("alone"))
    return whole.unionAll(single_starts(deep_buckets(docs, undecided)))


def remove_repeats(docs):
    """One row per document: doc_id, n_bytes, spans (array of start and stop, the maximal
    runs of bytes that go) and kept (the remaining bytes).

    A byte goes if a string of 200 bytes that covers it also starts elsewhere, in the same
    document or another; all are judged on the input. Texts are UTF-8 bytes, a null text is
    empty, and texts under 200 bytes keep everything. Rows alike in id and text are separate
    documents: their texts repeat. An empty table gives no rows, and a text of any length is
    worked on in pieces. `kept` is binary, since a run may end inside a character.
    """
    # Rows alike in id and text share a key: as a set their ranges are no more than one text has.
    starts = repeated_starts(docs)
    ranges = stored(
        starts.groupBy(*KEY).agg(F.collect_set(F.struct("low", "high")).alias("ranges")), "suffix-ranges"
    )
    marked = suspects(docs, ranges.select("row"), "suffix-rows")
    spans = "array<struct<start:int,stop:int>>"
    raw = F.col("text").cast("binary")
    clear = marked.where(~F.col("_possible")).select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
        F.array().cast(spans).alias("spans"), raw.alias("kept"),
    )
    touched = marked.where("_possible").join(ranges, same_row(), "left")

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        for batch in small(batches):
            sizes, runs, kept = [], [], []
            bounds, (low, high) = list_column(batch.column(2), "low", "high")
            for i, text in enumerate(batch.column(1)):
                text = np.frombuffer(text.as_buffer(), dtype=np.uint8)
                own = slice(bounds[i], bounds[i + 1])
                step = np.zeros(len(text) + 1, dtype=np.int32)
                np.add.at(step, low[own], 1)
                np.add.at(step, high[own] + LENGTH, -1)
                gone = np.cumsum(step[:-1]) > 0
                edges = np.flatnonzero(np.diff(gone, prepend=False, append=False)).reshape(-1, 2)
                sizes.append(len(text))
                runs.append([{"start": int(a), "stop": int(b)} for a, b in edges])
                kept.append(text[~gone].tobytes())
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(runs, kind), pa.array(kept, pa.binary())]
            yield pa.record_batch(columns, ["doc_id", "n_bytes", "spans", "kept"])

    touched = touched.select("doc_id", raw.alias("text"), "ranges")
    return clear.unionAll(touched.mapInArrow(run, f"doc_id long, n_bytes long, spans {spans}, kept binary"))
