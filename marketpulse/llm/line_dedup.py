"""Line dedup: a line goes if an earlier one, anywhere, equals it or, for lines that are not
short, is one edit away.

A pair within `threshold` edits that is split into threshold + 1 segments has a segment in
common: the segments of each line, with the line's length, form an index, and the substrings
at the places where a longer line could hold them probe it. Pairs that meet are verified by
banded bit-parallel edit distance. Where very many lines share a segment, the rest of the
line is split again, until few share all but a short stretch, or until the stretch is one
character: lines equal but for one character are one edit apart without a further look.
"""

from functools import reduce

import numpy as np
from pyspark.sql import functions as F

from marketpulse.llm.common import KEY, documents, row_keys, small, stored
from marketpulse.llm.edit_distance import within
from marketpulse.llm.rows import filter_of, keyed, mark_possible, same_row

THRESHOLD = 1  # edits; two segments
LEAST_CHARACTERS = 20
PAIRED = 16  # lines per segment up to which pairs are compared one by one
LAST_ID = (1 << 63) - 1  # the place of rows without an id in the order

LINES = "id long, row long, check long, line int, high long, low long, n int, keys array<long>"


def plain(line):
    """A line as it is compared: runs of white space are one space, none at the ends."""
    return " ".join(line.split())


def digest(*parts):
    import xxhash

    return np.uint64(xxhash.xxh3_64_intdigest("\n".join(map(str, parts)).encode())).view(np.int64).item()


def identity(line):
    """128 bits that stand for a line's text, as two longs."""
    import xxhash

    return np.frombuffer(xxhash.xxh3_128_digest(line.encode()), dtype=">i8").tolist()


def index_key(line, start, stop):
    """All of a line but the characters from `start` to `stop`, with its length."""
    return digest(len(line), start, stop, line[:start], line[stop:])


def probe_key(line, start, stop):
    """The key of a line that has one character less, inside the stretch."""
    return digest(len(line) - 1, start, stop, line[:start], line[stop + 1:])


def halves(start, stop):
    """The parts of a stretch in one of which the only edit is. A stretch of one character
    leaves the places before and after it, where a longer line can have one more."""
    if stop - start == 1:
        return (start, start), (stop, stop)
    middle = (start + stop) // 2
    return (start, middle), (middle, stop)


def line_keys(line):
    """Two index keys of a line and the two that it probes for lines one character shorter:
    either half may be the common segment."""
    n = len(line)
    index = [index_key(line, a, b) for a, b in halves(0, n)]
    return index + [probe_key(line, a, b) for a, b in halves(0, n - 1)]


def lines_of(docs, least, near_least):
    """Every line of at least `least` characters: id (null ids come last), row and check (key
    of its row), line (from 0), its identity, length and keys (none under `near_least` characters)."""

    def run(batches):
        import pyarrow as pa

        kinds = [*[pa.int64()] * 3, pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64())]
        names = [field.split()[0] for field in LINES.split(", ")]
        for batch in small(batches):
            rows = []
            for doc_id, row, check, text in zip(*(c.to_pylist() for c in batch.columns)):
                for number, line in enumerate(text.split("\n")):
                    line = plain(line)
                    if len(line) >= least:
                        keys = line_keys(line) if len(line) >= near_least else []
                        rows.append((doc_id, row, check, number, *identity(line), len(line), keys))
                if len(rows) >= 10_000:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                    rows = []
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    order = F.coalesce(F.col("doc_id"), F.lit(LAST_ID)).alias("doc_id")
    return documents(docs).select("doc_id", *row_keys(), "text").select(order, *KEY, "text").mapInArrow(run, LINES)


def distinct_lines(lines):
    """One row per text of a line: its first place (the smallest id, row and line) and keys."""
    first = F.min(F.struct("id", *KEY, "line")).alias("first")
    return lines.groupBy("high", "low").agg(first, F.first("n").alias("n"), F.first("keys").alias("keys"))


def first_keys(lines):
    """key, role (0 index, 1 probe), stretch and line, for the two segments of each line."""
    n = F.col("n")
    shorter = n - 1
    stretches = [
        (0, F.lit(0), F.floor(n / 2)), (0, F.floor(n / 2), n),
        (1, F.lit(0), F.floor(shorter / 2)), (1, F.floor(shorter / 2), shorter),
    ]
    each = F.array(*[
        F.struct(
            F.col("keys")[i].alias("key"), F.lit(role).alias("role"),
            a.cast("int").alias("start"), b.cast("int").alias("stop"),
        )
        for i, (role, a, b) in enumerate(stretches)
    ])
    return lines.select("high", "low", "first", F.explode(each).alias("k")).select("high", "low", "first", "k.*")


def met(keys, label):
    """The rows whose key an index row and another row share, with how many do."""
    sizes = keys.groupBy("key").agg(
        F.sum(1 - F.col("role")).alias("index_rows"), F.count(F.lit(1)).alias("together")
    )
    sizes = stored(sizes.where("index_rows > 0 AND together > 1"), f"{label}-sizes")
    return stored(keys.join(sizes, "key"), f"{label}-met")


def line_texts(docs, wanted):
    """high, low and text of the lines that stand first at the places in `wanted`."""
    places = wanted.groupBy("first.row", "first.check").agg(F.collect_list(F.struct("first.line", "high", "low")).alias("places"))
    places = stored(places, "lines-places")
    bitmaps, bits = filter_of(places.select("row"), "lines-filter")
    rows = mark_possible(keyed(docs.select("doc_id", "text")), F.col("_row"), bitmaps, bits, "_possible")
    # One row per key leaves each task, however often a row is repeated.
    found = rows.where("_possible").dropDuplicates(["_row", "_check"]).join(places, same_row())

    def run(batches):
        import pyarrow as pa

        for batch in small(batches):
            high, low, texts = [], [], []
            for text, places in zip(*(c.to_pylist() for c in batch.columns)):
                split = (text or "").split("\n")
                for place in places:
                    high.append(place["high"])
                    low.append(place["low"])
                    texts.append(plain(split[place["line"]]))
            columns = [pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(texts, pa.string())]
            yield pa.record_batch(columns, ["high", "low", "line_text"])

    one = found.select("_doc.text", "places")
    return stored(one.mapInArrow(run, "high long, low long, line_text string"), "lines-texts")


def verified_pairs(rows, texts):
    """Links (later, earlier) between the lines of a key, verified by edit distance."""
    few = rows.where(F.col("together") <= PAIRED)
    one = few.where("role = 0").select("key", F.struct("high", "low").alias("a"), F.col("first").alias("fa"))
    other = few.select("key", F.struct("high", "low").alias("b"), F.col("first").alias("fb"), "role")
    pairs = one.join(other, "key").where("(role = 1 OR fa < fb) AND a <> b")
    earlier = F.col("fa") < F.col("fb")
    pairs = pairs.select(
        F.when(earlier, F.col("a")).otherwise(F.col("b")).alias("early"), F.least("fa", "fb").alias("first"),
        F.when(earlier, F.col("b")).otherwise(F.col("a")).alias("late"),
    ).distinct()
    for side in ("early", "late"):
        found = texts.select(F.struct("high", "low").alias(side), F.col("line_text").alias(f"{side}_text"))
        pairs = pairs.join(found, side)

    @F.pandas_udf("boolean")
    def close(a, b):
        import pandas as pd

        return pd.Series([within(x, y, THRESHOLD) is not None for x, y in zip(a, b)], dtype=bool)

    return pairs.where(close("early_text", "late_text")).select("late", "first")


def certain_links(rows):
    """Links of a crowded key that need no look. Stretch of one character: the index lines
    differ there alone. Empty stretch: each longer line is the index line and a character."""
    rows = rows.where((F.col("together") > PAIRED) & (F.col("stop") - F.col("start") <= 1))
    of_role = [F.min(F.when(F.col("role") == r, F.col("first"))).alias(f"first_{r}") for r in (0, 1)]
    firsts = stored(rows.groupBy("key").agg(*of_role), "lines-firsts")
    empty = F.col("start") == F.col("stop")
    nearest = (
        F.when((F.col("role") == 0) & ~empty, F.col("first_0"))
        .when((F.col("role") == 0) & empty, F.col("first_1"))
        .when((F.col("role") == 1) & empty, F.col("first_0"))
    )
    linked = rows.join(firsts, "key").withColumn("nearest", nearest).where("nearest < first")
    return linked.select(F.struct("high", "low").alias("late"), F.col("nearest").alias("first"))


def narrowed(rows, texts):
    """Keys of the crowded lines with each half of the stretch that was left open."""
    crowd = rows.where((F.col("together") > PAIRED) & (F.col("stop") > F.col("start")))
    crowd = crowd.join(texts, ["high", "low"]).select("high", "low", "first", "role", "start", "stop", "line_text")

    def run(batches):
        import pyarrow as pa

        for batch in small(batches):
            owner, keys, starts, stops = [], [], [], []
            columns = (batch.column(i).to_pylist() for i in (3, 4, 5, 6))
            for i, (role, start, stop, line) in enumerate(zip(*columns)):
                for a, b in halves(start, stop):
                    owner.append(i)
                    keys.append(probe_key(line, a, b) if role else index_key(line, a, b))
                    starts.append(a)
                    stops.append(b)
            kept = [batch.column(i).take(pa.array(owner, pa.int64())) for i in (0, 1, 2, 3)]
            new = [pa.array(keys, pa.int64()), pa.array(starts, pa.int32()), pa.array(stops, pa.int32())]
            names = ["high", "low", "first", "role", "key", "start", "stop"]
            yield pa.record_batch([*kept, *new], names)

    first = "first struct<id:long,row:long,check:long,line:int>"
    return crowd.mapInArrow(run, f"high long, low long, {first}, role int, key long, start int, stop int")


def near_links(docs, lines):
    """high, low and `earlier`, the place of the first line that is one edit away and stands
    before, for each distinct line that has one."""
    rows = met(first_keys(lines.where("size(keys) > 0")), "lines")
    wanted = stored(rows.select("high", "low", "first").distinct(), "lines-wanted")
    texts = line_texts(docs, wanted)
    links = []
    while not rows.isEmpty():
        links += [verified_pairs(rows, texts), certain_links(rows)]
        rows = met(stored(narrowed(rows, texts), "lines-narrowed"), "lines")
    if not links:
        return wanted.select("high", "low", F.col("first").alias("earlier"))
    found = stored(reduce(lambda a, b: a.unionAll(b), links), "lines-links")
    return found.groupBy("late.high", "late.low").agg(F.min("first").alias("earlier"))


def dropped_lines(docs, least=LEAST_CHARACTERS, near_least=LEAST_CHARACTERS):
    """row, check, repeated and near: the numbers of the lines that go, per row of `docs` that loses
    any. A line that both repeats and resembles an earlier one counts as repeated."""
    lines = stored(lines_of(docs, least, near_least), "lines")
    distinct = stored(distinct_lines(lines), "lines-distinct")
    near = stored(near_links(docs, distinct), "lines-near")
    judged = distinct.select("high", "low", "first").join(near, ["high", "low"], "left")
    # Only texts that repeat or resemble another have anything to say about their places.
    often = stored(lines.groupBy("high", "low").count().where("count > 1").select("high", "low"), "lines-often")
    judged = stored(
        judged.join(often.withColumn("often", F.lit(True)), ["high", "low"], "left")
        .where("often OR earlier IS NOT NULL"), "lines-judged",
    )
    places = lines.select("high", "low", *KEY, "line", F.struct("id", *KEY, "line").alias("place"))
    places = places.join(judged, ["high", "low"]).withColumn("repeats", F.col("place") != F.col("first"))
    places = places.where("repeats OR earlier IS NOT NULL")
    return stored(
        places.groupBy(*KEY).agg(
            F.collect_set(F.when(F.col("repeats"), F.col("line"))).alias("repeated"),
            F.collect_set(F.when(~F.col("repeats"), F.col("line"))).alias("near"),
        ), "lines-dropped",
    )


def dedup_lines(docs, least=LEAST_CHARACTERS, near_least=LEAST_CHARACTERS, counts=True):
    """`docs` with repeated and near-repeated lines taken out of `text`, all other columns
    included, and n_repeated and n_near, the numbers of lines that went (none with `counts`
    false, when columns of these names stay as they are).

    Lines are what line feeds separate; they are compared with runs of white space as one
    space, and only lines of at least `least` characters are (1: all but blank ones). Of equal
    lines the first stays, by doc_id, then row, then line number; of lines of at least
    `near_least` characters, one that is one edit (a character more, less or other) from a
    line that comes earlier goes too, whether or not that one stays. Rows without an id come
    last. A null text stays null; a text may become empty; documents never go. Rows
    alike in id and text are one row in the order and keep the same lines. `n_chars`, where
    there is such a column, becomes the length of the new text.

    Rows that lose no line are not shuffled. Lines of any length are compared whole. An empty
    table stays empty.
    """
    dropped = dropped_lines(docs, least, near_least)
    bitmaps, bits = filter_of(dropped.select("row"), "lines-rows")
    if counts:
        docs = docs.drop("n_repeated", "n_near")
    marked = mark_possible(keyed(docs), F.col("_row"), bitmaps, bits, "_possible")
    names, zero = ("repeated", "near") if counts else (), F.lit(0).cast("long")
    clear = marked.where(~F.col("_possible")).select("_doc.*", *(zero.alias(f"n_{c}") for c in names))

    @F.arrow_udf("string")
    def without(texts, repeated, near):
        import pyarrow as pa

        def rest(text, *gone):
            text, first, second = text.as_py(), *(g.as_py() for g in gone)
            if text is None or first is None:
                return text
            gone = {*first, *second}
            return "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)

        return pa.array([rest(*x) for x in zip(texts, repeated, near)], pa.string())

    judged = marked.where("_possible").join(dropped, same_row(), "left")
    judged = judged.withColumn("left", without(F.col("_doc.text").cast("string"), "repeated", "near"))
    values = {c: F.col(f"_doc.`{c}`") for c in docs.columns} | {"text": F.col("left")}
    if "n_chars" in values:
        length = F.char_length("left").cast(docs.schema["n_chars"].dataType)
        values["n_chars"] = F.when(F.col("row").isNotNull(), length).otherwise(values["n_chars"])
    sizes = [F.coalesce(F.size(c), F.lit(0)).cast("long").alias(f"n_{c}") for c in names]
    return clear.unionAll(judged.select(*(value.alias(c) for c, value in values.items()), *sizes))
