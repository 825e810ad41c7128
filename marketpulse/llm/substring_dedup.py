"""Substring dedup by seed and extend: find every passage of 50 words that a document with a
smaller id holds too.

Seeds are winnowed anchors. Of the 8-word strings inside each 50 words the one with the
smallest identifier is the anchor, so equal passages have equal anchors at equal offsets;
neighbouring starts mostly share theirs, and each start belongs to one anchor. Documents meet
where their anchors do, and matches are extended both ways from there:

1. As far as all starts of the anchor reach. Of the occurrences that agree so far the smallest
   document stays, and all others have found their partner.
2. What stays and has company of other surroundings is extended by every split of the rest
   over left and right: one start each, known by the identifier of its 50 words. The smallest
   document with the same extension is the partner.

Each occurrence meets one partner and not all of them, so a passage that very many documents
share costs as much for each of them as one that two share. Matches that touch or overlap make
up the maximal repeats. Identifiers have 64 bits and count only among those of one anchor,
which has 64 bits of its own.
"""

import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from marketpulse.llm.common import documents, mark_possible, small, stored
from marketpulse.llm.rows import filter_of
from marketpulse.llm.suffix_dedup import list_column, mixed, sliding_least

LENGTH = 50  # words of a repeated passage
PIECE = 1 << 18  # starts of one document that are worked on at a time
CHUNK = 1 << 16  # words of short documents that are worked on together
SLICE = 1 << 22  # bytes of a text that are split into words at a time
WHITE = re.compile(rb"[\x20\x09-\x0D]")
ROW = ["doc_id", "row"]  # one text of a document; rows alike in both have the same passages


class WordIds(dict):
    """The identifier of a word, remembered for the words seen last."""

    def __init__(self, most=1 << 18):
        super().__init__()
        self.most = most

    def __missing__(self, word):
        if len(self) >= self.most:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def word_slices(raw):
    """The words of a text, some at a time, so that a long text is never split at once."""
    start = 0
    while start < len(raw):
        gap = WHITE.search(raw, start + SLICE)
        stop = gap.start() if gap else len(raw)
        yield raw[start:stop].split()
        start = stop


def word_ids(raw, known):
    parts = [np.fromiter(map(known.__getitem__, words), np.uint64, len(words)) for words in word_slices(raw)]
    return parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, np.uint64), *parts])


def deeper(ids, depth, wanted):
    """Identifiers of `wanted` words in a row, from those of `depth` words. Both are powers of two."""
    while depth < wanted:
        ids = mixed(ids[:-depth], ids[depth:])
        depth *= 2
    return ids


def largest_power(most):
    return 1 << (most.bit_length() - 1)


def passages(ids, length):
    """The identifiers of `length` words from each start, and those of the strings that
    anchors are chosen from, with their length."""
    gram, depth = largest_power(max(1, length // 4)), largest_power(length)
    grams = deeper(ids, 1, gram)
    wide = deeper(grams, gram, depth)
    rest = length - depth
    return mixed(wide[:len(wide) - rest], wide[rest:]), grams, gram


def anchors(ids, ends, length):
    """Of the starts in an array of words that holds several texts, which end at `ends`:
    identifier of the anchor, first and last start, and an identifier of all they cover."""
    whole, grams, gram = passages(ids, length)
    window = length - gram + 1
    place = np.arange(len(grams), dtype=np.uint64)
    least = sliding_least((grams >> np.uint64(32) << np.uint64(32)) | place, window)
    limit = np.repeat(ends, np.diff(ends, prepend=0))[:len(least)]
    starts = np.flatnonzero(np.arange(len(least)) + length <= limit)
    anchor = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.diff(anchor, prepend=-1))
    last = np.append(first[1:], len(anchor)) - 1
    low, high = starts[first], starts[last]
    around = mixed(mixed(whole[low], whole[high]), (high - low).astype(np.uint64))
    return grams[anchor[first]], low, high, around


def chunks(rows, length):
    """(words, ends, owners, offsets): short texts put together up to CHUNK words; a long one
    comes in pieces of PIECE starts that overlap. Texts of fewer words than `length` are left out."""
    parts, owners, offsets, size = [], [], [], 0
    for owner, ids in rows:
        for start in range(0, len(ids) - length + 1, PIECE):
            piece = ids[start:start + PIECE + length - 1]
            if size and size + len(piece) > CHUNK:
                yield np.concatenate(parts), np.cumsum([len(p) for p in parts]), owners, offsets
                parts, owners, offsets, size = [], [], [], 0
            parts.append(piece)
            owners.append(owner)
            offsets.append(start)
            size += len(piece)
    if size:
        yield np.concatenate(parts), np.cumsum([len(p) for p in parts]), owners, offsets


SEEDS = "gram long, around long, doc_id long, row long, low int, span int"


def seeds(docs, length):
    """gram (the anchor), around (all that its starts cover), doc_id, row, low (first start)
    and span (last start less the first) of every anchor."""

    def run(batches):
        import pyarrow as pa

        known, names = WordIds(), [field.split()[0] for field in SEEDS.split(", ")]
        for batch in small(batches):
            ids, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            texts = enumerate(batch.column(2).to_pylist())
            for words, ends, owners, offsets in chunks(((i, word_ids(t, known)) for i, t in texts), length):
                gram, low, high, around = anchors(words, ends, length)
                part = np.searchsorted(ends, low, side="right")
                begins = np.append(0, ends[:-1]) - np.array(offsets)
                owner = np.array(owners)[part]
                columns = [
                    gram.view(np.int64), around.view(np.int64), ids[owner], keys[owner],
                    (low - begins[part]).astype(np.int32), (high - low).astype(np.int32),
                ]
                yield pa.record_batch([pa.array(c) for c in columns], names)

    return texts_of(docs).where("doc_id IS NOT NULL").mapInArrow(run, SEEDS)


def texts_of(docs):
    return documents(docs).select(
        "doc_id", F.xxhash64("text").alias("row"), F.col("text").cast("binary").alias("text")
    )


def shared(rows, key, label):
    """Rows of a stored table whose key another document has too, with `first`, the smallest
    of these. A Bloom filter of the shared keys keeps most others out of the join."""
    both = rows.groupBy(*key).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    both = stored(both.where("first < last").drop("last"), f"{label}-shared")
    bitmaps, bits = filter_of(both.select(F.xxhash64(*key).alias("key")), f"{label}-filter")
    marked = mark_possible(rows, F.xxhash64(*key), bitmaps, bits, "_possible")
    return marked.where("_possible").drop("_possible").join(both, key)


def with_entries(docs, rows, entry, label):
    """(documents that may have entries, with them as an array; the others). `rows` are
    grouped by text: a text has no more of them than words."""
    grouped = stored(rows.groupBy(*ROW).agg(F.collect_set(entry).alias("entries")), label)
    bitmaps, bits = filter_of(grouped.select(F.xxhash64(*ROW).alias("key")), f"{label}-filter")
    marked = mark_possible(texts_of(docs), F.xxhash64(*ROW), bitmaps, bits, "_possible")
    held = marked.where("_possible").drop("_possible").join(grouped, ROW, "left")
    return held, marked.where(~F.col("_possible")).drop("_possible")


EXTENSIONS = "gram long, doc_id long, row long, low int, deep array<long>"


def extensions(docs, undecided, length):
    """gram, doc_id, row, low and deep (the identifiers of the passages from low on) of the
    anchors in `undecided`."""
    held, _ = with_entries(docs, undecided, F.struct("gram", "low", "span"), "substring-open")

    def run(batches):
        import pyarrow as pa

        known, names = WordIds(), [field.split()[0] for field in EXTENSIONS.split(", ")]
        for batch in small(batches):
            ids, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            bounds, fields = list_column(batch.column(3), "low", "span", "gram")
            for i, text in enumerate(batch.column(2)):
                words = word_ids(text.as_py(), known)
                low, span, gram = (field[bounds[i]:bounds[i + 1]] for field in fields)
                order = np.argsort(low, kind="stable")
                low, span, gram = low[order].astype(np.int64), span[order].astype(np.int64), gram[order]
                at = 0
                while at < len(low):
                    base, stop = low[at], np.searchsorted(low, low[at] + PIECE)
                    some = slice(at, stop)
                    at = stop
                    whole, _, _ = passages(words[base:(low + span)[some].max() + length], length)
                    sizes = span[some] + 1
                    offsets = np.append(0, np.cumsum(sizes))
                    starts = np.repeat(low[some] - base - offsets[:-1], sizes) + np.arange(offsets[-1])
                    columns = [
                        pa.array(gram[some]), pa.array(np.full(len(sizes), ids[i])), pa.array(np.full(len(sizes), keys[i])),
                        pa.array(low[some].astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(whole[starts].view(np.int64))),
                    ]
                    yield pa.record_batch(columns, names)

    return held.where("entries IS NOT NULL").select(*ROW, "text", "entries").mapInArrow(run, EXTENSIONS)


def matches(docs, length=LENGTH):
    """doc_id, row, low and high: ranges of starts whose passage of `length` words also starts
    in a document with a smaller id."""
    found = stored(seeds(docs, length), "substring-seeds")
    found = stored(shared(found, ["gram"], "substring-gram").drop("first"), "substring-found")

    kinds = stored(found.groupBy("gram", "around").agg(F.min("doc_id").alias("first")), "substring-kinds")
    several = stored(kinds.groupBy("gram").count().where("count > 1").select("gram"), "substring-several")
    kinds = kinds.join(several.withColumn("open", F.lit(True)), "gram", "left")
    judged = found.join(kinds, ["gram", "around"]).where("doc_id > first OR open")
    judged = stored(judged, "substring-judged")
    whole = judged.where("doc_id > first").select(*ROW, "low", (F.col("low") + F.col("span")).alias("high"))

    deep = extensions(docs, judged.where("doc_id = first"), length)
    each = deep.select("gram", *ROW, "low", F.posexplode("deep").alias("step", "passage"))
    each = stored(each.select("gram", "passage", *ROW, (F.col("low") + F.col("step")).alias("low")), "substring-deep")
    single = shared(each, ["gram", "passage"], "substring-passage").where("doc_id > first")
    return whole.unionAll(single.select(*ROW, "low", F.col("low").alias("high")))


RESULT = "doc_id long, n_words long, spans array<struct<start:int,stop:int>>, kept string"


def remove_shared(docs, length=LENGTH):
    """One row per document: doc_id, n_words, spans (array of start and stop, the maximal
    runs of words that go) and kept (the other words, joined by one space).

    A word goes if a passage of `length` words that covers it also starts in a document with
    a smaller id; all are judged on the input. Words stand between white space and are
    compared as they are. Null and empty texts have none. Repeats inside a document and rows
    of one id do not count against each other. A row without an id is neither smaller nor
    larger than others: it keeps everything and removes nothing. Documents under `length`
    words keep everything, long ones are worked on in pieces. An empty table gives no rows.
    """
    entry = F.struct("low", "high")
    held, others = with_entries(docs, matches(docs, length), entry, "substring-ranges")
    empty = F.lit(None).cast("array<struct<low:int,high:int>>")
    texts = held.select("doc_id", "text", F.col("entries").cast("array<struct<low:int,high:int>>").alias("entries"))
    texts = texts.unionAll(others.select("doc_id", "text", empty))

    def kept_words(text, low, high):
        """(number of words, runs that go, words that stay) of one text."""
        parts, total = [], 0
        if not len(low):
            for words in word_slices(text):
                total += len(words)
                parts.append(b" ".join(words))
            return total, [], b" ".join(p for p in parts if p)
        step = np.zeros(int(high.max()) + length + 1, dtype=np.int32)
        np.add.at(step, low, 1)
        np.add.at(step, high + length, -1)
        gone = np.cumsum(step[:-1]) > 0
        edges = np.flatnonzero(np.diff(gone, prepend=False, append=False)).reshape(-1, 2)
        for words in word_slices(text):
            away = gone[total:total + len(words)]
            parts.append(b" ".join([w for w, g in zip(words, away) if not g] + words[len(away):]))
            total += len(words)
        return total, [{"start": int(a), "stop": int(b)} for a, b in edges], b" ".join(p for p in parts if p)

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        for batch in small(batches):
            bounds, (low, high) = list_column(batch.column(2), "low", "high")
            done = [
                kept_words(text.as_py(), low[bounds[i]:bounds[i + 1]], high[bounds[i]:bounds[i + 1]])
                for i, text in enumerate(batch.column(1))
            ]
            totals, runs, kept = zip(*done)
            columns = [
                batch.column(0), pa.array(totals, pa.int64()), pa.array(runs, kind),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ]
            yield pa.record_batch(columns, ["doc_id", "n_words", "spans", "kept"])

    return texts.mapInArrow(run, RESULT)
