"""Benchmark decontamination: rare word n-grams seed the search for test items in documents,
and Smith-Waterman alignment scores the passages around the seeds, so that edited and
paraphrased copies are found as well.

Seeds are two neighbouring words. With the share 0.5 that an alignment must reach, words
changed at any rhythm leave two neighbours unchanged somewhere. The documents are read once
per block of items: what is kept of one is its words as numbers, and that only if it has
enough words of an item.
"""

import re

import numpy as np
from pyspark.sql import functions as F

from marketpulse.llm.common import documents, row_keys, small, stored
from marketpulse.llm.rows import keyed

WORD = re.compile(r"[^\W_]+")
MAX_BLOCK_BYTES = 8 << 20  # test items that are broadcast at a time
MATCH, MISMATCH, GAP = 2, -1, -1
NUMBER = 2  # words of a seed
SCORE_BIT, MATCH_BIT = 42, 22  # of an alignment's score, matches and start in one number
HITS = (
    "doc_id long, item_id long, score double, matched int, item_words int, "
    "start_word int, end_word int, seeds int"
)


def words_of(text):
    return WORD.findall(text.lower())


class WordNumbers(dict):
    """Numbers of known words; every other word has the number -1."""

    def __missing__(self, word):
        return -1


def spread(bounds, keys):
    """The places of all entries of some keys, whose entries stand from bounds[key] to
    bounds[key + 1], and for each entry which of the keys it belongs to."""
    low = bounds[keys]
    sizes = bounds[keys + 1] - low
    which = np.repeat(np.arange(len(keys)), sizes)
    return which, np.arange(len(which)) + (low - np.cumsum(sizes) + sizes)[which]


def best_stretches(words, bounds, items, count):
    """For each of `count` items the most that a stretch of a text gains, MATCH for a word that
    the item has and GAP for any other. The items of each word stand from bounds[word] to
    bounds[word + 1].

    Only the places of an item's words matter: from the i-th to the j-th of them a stretch
    gains what each adds over a gap, and loses a gap per word.
    """
    at, entry = spread(bounds, words)
    item = items[entry]
    small_numbers = item.astype(np.int16) if count < 1 << 15 else item  # sorted by digits
    order = np.argsort(small_numbers, kind="stable")
    item, at = item[order], at[order]
    first = np.searchsorted(item, np.arange(count))
    nth = np.arange(len(item)) - first[item]
    gained = (MATCH - GAP) * nth + GAP * at  # up to here, without this word
    apart = item * ((MATCH - 2 * GAP) * (len(words) + 1))  # keeps one item's values below the next one's
    lowest = np.maximum.accumulate(apart - gained) - apart
    return np.maximum.reduceat(gained + MATCH + lowest, first)


class Items:
    """The words of some test items, numbered, and the n-grams that point back to the items."""

    def __init__(self, rows, n=NUMBER):
        self.n, self.words, self.items = n, WordNumbers(), {}
        for item_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1])):
            known = [self.words.setdefault(w, len(self.words)) for w in words_of(text)]
            self.items[len(self.items)] = (item_id, np.array(known, dtype=np.int64))
        self.sizes = sorted({min(n, len(known)) for _, known in self.items.values()} - {0})
        grams = [self.grams(known) for _, known in self.items.values()]
        self.all_grams = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *grams]))
        self.seeds = None
        # The items of each n-gram, as pairs in the order of `all_grams`.
        held = [np.unique(np.searchsorted(self.all_grams, own)) for own in grams]
        pairs = np.concatenate([np.zeros(0, np.int64), *held])
        owner = np.repeat(np.arange(len(held)), [len(own) for own in held])
        self.holder = owner[np.argsort(pairs, kind="stable")]
        self.held = np.searchsorted(np.sort(pairs), np.arange(len(self.all_grams) + 1))
        # The items of each word, with how often they have it.
        held = [np.unique(known, return_counts=True) for _, known in self.items.values()]
        words, times = (np.concatenate([np.zeros(0, np.int64), *(h[i] for h in held)]) for i in (0, 1))
        owner = np.repeat(np.arange(len(held)), [len(h[0]) for h in held])
        order = np.argsort(words, kind="stable")
        self.owner, self.times = owner[order], times[order]
        self.bounds = np.searchsorted(words[order], np.arange(len(self.words) + 1))
        self.lengths = np.array([len(known) for _, known in self.items.values()], dtype=np.int64)

    def likely(self, known, least, grams=None):
        """Whether a text may hold each item with the share `least`, whatever the order of the
        words. It must have one of the item's n-grams (`grams`: the numbers of those it has). An alignment has at least that share of the item's words; and each word of its
        passage gains MATCH if the item has it and else costs as much as a gap, so no
        alignment scores more than the stretch of the text that gains most."""
        words, place, counts = np.unique(known, return_inverse=True, return_counts=True)
        own = np.flatnonzero(words >= 0)
        which, at = spread(self.bounds, words[own])
        column, owner = own[which], self.owner[at]
        matched = np.bincount(owner, weights=np.minimum(counts[column], self.times[at]), minlength=len(self.lengths))
        possible = (matched >= least * self.lengths) & (self.lengths > 0)
        if grams is None:
            grams = np.unique(self.found(known, self.all_grams)[1])
        holds = np.zeros(len(self.lengths), dtype=bool)
        holds[self.holder[spread(self.held, grams)[1]]] = True
        wanted = np.flatnonzero(possible & holds)
        row = np.full(len(self.lengths), -1)
        row[wanted] = np.arange(len(wanted))
        row = row[owner]
        column, row = column[row >= 0], row[row >= 0]
        possible[:] = False
        if len(wanted):
            best = best_stretches(place, np.searchsorted(column, np.arange(len(words) + 1)), row, len(wanted))
            possible[wanted] = best >= MATCH * least * self.lengths[wanted]
        return possible

    def grams(self, known, size=None):
        """One number per run of `size` words (n by default, or all words if they are fewer)."""
        size = size or min(self.n, len(known))
        if not size or len(known) < size:
            return np.zeros(0, dtype=np.uint64)
        value = np.zeros(len(known) - size + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for k in range(size):
                part = (known[k:len(known) - size + 1 + k] + 2).astype(np.uint64)
                value = (value + part) * np.uint64(0x9E3779B97F4A7C15)
                value ^= value >> np.uint64(29)
        return value

    def numbered(self, text):
        return np.array(list(map(self.words.__getitem__, words_of(text))), dtype=np.int64)

    def present(self, known, wanted):
        """(place, index in `wanted`) of the n-grams of a text that are among `wanted`. Items
        shorter than n words are looked up by their own length."""
        return list(zip(*(x.tolist() for x in self.found(known, wanted))))

    def found(self, known, wanted):
        """The same as two arrays."""
        places, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for size in self.sizes if len(wanted) else ():
            grams = self.grams(known, size)
            at = np.searchsorted(wanted, grams)
            at[at == len(wanted)] = 0
            hits = np.flatnonzero(wanted[at] == grams)
            places.append(hits)
            found.append(at[hits])
        return np.concatenate(places), np.concatenate(found)

    def choose_seeds(self, document_counts, common=4):
        """An item's n-grams that documents hold become seeds. The common ones, those in more
        than `common` times as many documents as its middle n-gram, count only where enough of
        the item's words are around them (`second` marks them by number and place): an edited
        copy may have kept no rarer one, however often it is copied."""
        seeds, self.second = {}, set()
        for number, (_, known) in self.items.items():
            grams = self.grams(known).tolist()
            held = sorted(n for g in set(grams) if (n := document_counts.get(g, 0)))
            most = common * held[len(held) // 2] if held else 0
            for place, gram in enumerate(grams):
                if document_counts.get(gram, 0):
                    seeds.setdefault(gram, []).append((number, place))
                    if document_counts[gram] > most:
                        self.second.add((number, place))
        self.seeds = np.array(sorted(seeds), dtype=np.uint64)
        places = [seeds[g] for g in self.seeds.tolist()]
        self.starts = np.cumsum([0, *map(len, places)])
        self.seeded = np.array([p for own in places for p in own], dtype=np.int64).reshape(-1, 2)
        return self

    def hits(self, known, likely):
        """{item number: [(place in the text, place in the item)]} of the seeds of likely items."""
        at, seed = self.found(known, self.seeds)
        which, place = spread(self.starts, seed)
        number, inside = self.seeded[place].T
        at = at[which]
        kept = np.flatnonzero(likely[number])
        order = kept[np.lexsort((inside[kept], at[kept], number[kept]))]
        out = {}
        for number, *hit in zip(number[order].tolist(), at[order].tolist(), inside[order].tolist()):
            out.setdefault(number, []).append(tuple(hit))
        return out


def local_alignment(item, passage):
    """Best Smith-Waterman score of two arrays of word numbers: (score, matches, start, end)
    with the place in the passage. Numbers below zero match nothing.

    Each cell holds its score, its matches and where it started in one number, which gains
    and gaps move together, so two rows are all that is kept. Rows are computed whole: a gap
    along a row costs the same per word, so the best value carried from the left is a running
    maximum of the values plus their distance.
    """
    width = len(passage)
    fresh = np.arange(width + 1, dtype=np.int64)  # score 0, started here
    slope = fresh * -GAP << SCORE_BIT
    match, gap = (MATCH << SCORE_BIT) + (1 << MATCH_BIT), GAP * (1 << SCORE_BIT)
    above, best, end = fresh, 0, 0
    for word in item:
        gain = np.where((passage == word) & (word >= 0), match, MISMATCH * (1 << SCORE_BIT))
        here = np.maximum(fresh, above + gap)
        here[1:] = np.maximum(here[1:], above[:-1] + gain)
        here = np.maximum.accumulate(here + slope) - slope
        here = np.where(here >> SCORE_BIT > 0, here, fresh)
        top = int(here.argmax())
        if here[top] >> SCORE_BIT > best >> SCORE_BIT:
            best, end = int(here[top]), top
        above = here
    if not best:
        return 0, 0, 0, 0
    low = best & (1 << SCORE_BIT) - 1
    return best >> SCORE_BIT, low >> MATCH_BIT, low & (1 << MATCH_BIT) - 1, end


def passages(hits, item_words, doc_words):
    """Stretches of the document around seeds of one item: (first word, end, seeds). A seed's
    stretch reaches as far as the whole item could, half as much again for insertions;
    stretches that overlap are one."""
    reach = item_words // 2 + 2
    out = []
    for at, place in sorted(hits):
        a, b = max(0, at - place - reach), min(doc_words, at - place + item_words + reach)
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]), out[-1][2] + 1)
        else:
            out.append((a, b, 1))
    return out


def best_passage(item, known, hits, block=4096):
    """The best alignment of an item in a document. Long stretches are cut into blocks that
    overlap by twice the longest possible match, so memory stays bounded."""
    best = None
    overlap = 3 * len(item) + 4
    for a, b, seeds in passages(hits, len(item), len(known)):
        start = a
        while True:
            stop = min(b, start + block + overlap)
            score, matches, i, j = local_alignment(item, known[start:stop])
            if best is None or score > best[0]:
                best = (score, matches, start + i, start + j, seeds)
            if stop == b:
                break
            start = stop - overlap
    return best


WORDS = "gram long, documents long, row long, check long, doc_id long, words array<int>"


def read_once(docs, items, least):
    """(documents per n-gram of the items over all documents, rows of the documents that have
    words enough of an item: row, check, doc_id and words, their numbers). As many n-grams as
    the items have; each task adds up its own documents first."""
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches):
        import pyarrow as pa

        known = shared.value
        names = [field.split()[0] for field in WORDS.split(", ")]
        counts = np.zeros(len(known.all_grams), dtype=np.int64)
        for batch in small(batches):
            kept, words = [], []
            for i, text in enumerate(batch.column(3).to_pylist()):
                numbers = known.numbered(text)
                held = np.unique(known.found(numbers, known.all_grams)[1])
                counts[held] += 1
                if len(held) and known.likely(numbers, least, held).any():
                    kept.append(i)
                    words.append(numbers.astype(np.int32))
            if kept:
                own = [batch.column(i).take(pa.array(kept, pa.int64())) for i in range(3)]
                none = pa.nulls(len(kept), pa.int64())
                yield pa.record_batch([none, none, *own, pa.array(words, pa.list_(pa.int32()))], names)
        held = np.flatnonzero(counts)
        rest = [pa.nulls(len(held), pa.int64())] * 3 + [pa.nulls(len(held), pa.list_(pa.int32()))]
        yield pa.record_batch([pa.array(held), pa.array(counts[held]), *rest], names)

    texts = documents(docs).select(*row_keys(), "doc_id", "text")
    found = stored(texts.mapInArrow(run, WORDS), "decontamination-words")
    rows = found.where("gram IS NOT NULL").groupBy("gram").agg(F.sum("documents").alias("documents")).collect()
    counts = {int(items.all_grams[r.gram]): r.documents for r in rows}
    return counts, found.where("gram IS NULL").select("row", "check", "doc_id", "words")


def item_blocks(benchmark, n):
    """The items in blocks whose texts have a bounded size, as (block number, Items)."""
    rows = benchmark.where("text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text")
    block, size = [], 0
    for item_id, text in rows.toLocalIterator():
        if block and size + len(text) > MAX_BLOCK_BYTES:
            yield Items(block, n)
            block, size = [], 0
        block.append((item_id, text))
        size += len(text)
    if block:
        yield Items(block, n)


def contaminated(docs, benchmark, **options):
    """One row per document and test item whose alignment reaches the share `least` of a
    perfect one: doc_id, item_id, score (that share), matched (words), item_words, start_word
    and end_word of the passage, seeds (seed hits in it). Of equal alignments the one that
    ends first in the item is reported, of these the one with the most matches.

    Words are runs of letters and digits, compared without case. Matches count 2, other
    words and gaps -1. An alignment needs one seed: two neighbouring words of the item next
    to each other (a copy with a word put in after every single word has none). Null and
    empty texts and items without words give no row, and so do empty tables. Repeated
    rows give repeated results; items with equal text are separate items. Texts and items
    may be long: an alignment keeps two rows of at most 4,100 words and three items. The
    benchmark is read in blocks of at most 8 MB of text, and for each block the documents once.
    """
    return keyed_hits(docs, benchmark, **options).drop("row", "check")


def keyed_hits(docs, benchmark, n=NUMBER, common=4, least=0.5):
    """The rows of `contaminated` and row and check, the key of their document by id and text."""
    found = None
    for items in item_blocks(benchmark, n):
        counts, texts = read_once(docs, items, least)
        part = _aligned(texts, items.choose_seeds(counts, common), least)
        found = part if found is None else found.unionAll(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], f"row long, check long, {HITS}")
    return found


def _aligned(texts, items, least):
    shared = texts.sparkSession.sparkContext.broadcast(items)

    def run(batches):
        import pyarrow as pa

        kinds = [pa.int64()] * 4 + [pa.float64(), *[pa.int32()] * 5]
        names = ["row", "check", *(field.split()[0] for field in HITS.split(", "))]
        for batch in small(batches):
            rows = []
            keys = zip(*(batch.column(i).to_pylist() for i in range(3)))
            for (row, check, doc_id), words in zip(keys, batch.column(3)):
                known = words.values.to_numpy().astype(np.int64)
                rows += [(row, check, doc_id, *hit) for hit in known_hits(shared.value, known, least)]
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return texts.mapInArrow(run, f"row long, check long, {HITS}")


def item_hits(items, text, least):
    """(item_id, score, matched, item_words, start, end, seeds) of the items that a text holds."""
    return known_hits(items, items.numbered(text), least)


def known_hits(items, known, least):
    """The same for a text given as word numbers."""
    by_item = items.hits(known, items.likely(known, least))
    for number in sorted(by_item):
        item_id, item = items.items[number]
        common = [h for h in by_item[number] if (number, h[1]) in items.second]
        hits = [h for h in by_item[number] if (number, h[1]) not in items.second]
        hits += enough_hits(common, item, known, least)
        if not hits:
            continue
        score, matches, start, end, seeds = best_passage(item, known, hits)
        share = score / (MATCH * len(item))
        if share >= least:
            yield item_id, round(share, 6), matches, len(item), start, end, seeds


def enough_hits(hits, item, known, least):
    """The hits around which a document has words enough in common with the item to reach the
    share `least`. The words of the item are counted around each hit first, then with their
    number in the item in the stretches that remain."""
    if not hits:
        return []
    reach = len(item) // 2 + 2
    of_item = np.append(0, np.cumsum(np.isin(known, item)))
    at = np.array(hits, dtype=np.int64)
    first = at[:, 0] - at[:, 1]
    ends = [np.clip(x, 0, len(known)) for x in (first - reach, first + len(item) + reach)]
    near = of_item[ends[1]] - of_item[ends[0]] >= least * len(item)
    hits = [h for h, some in zip(hits, near.tolist()) if some]
    out, own = [], {w: int(n) for w, n in zip(*np.unique(item, return_counts=True))}
    for a, b, _ in passages(hits, len(item), len(known)):
        words, counts = np.unique(known[a:b], return_counts=True)
        matches = sum(min(own.get(w, 0), n) for w, n in zip(words.tolist(), counts.tolist()))
        if matches >= least * len(item):
            out += [h for h in hits if a <= max(0, h[0] - h[1] - reach) < b]
    return out


def without_contaminated(docs, benchmark, **options):
    """The rows of `docs` that hold no test item, all columns. A row with a text is judged by
    that text, with or without an id: a clean one stays beside a contaminated one of the same
    id, and repeated rows go or stay together; an empty table stays empty. Rows whose text is null go with a contaminated one of their id (or without an id)."""
    of_id = lambda doc_id: F.xxhash64(F.lit("id"), doc_id.cast("long"))
    hits = keyed_hits(docs, benchmark, **options)
    same = F.struct(F.col("row").alias("hit"), F.col("check").alias("hit_check"))
    id_alone = F.struct(of_id(F.col("doc_id")).alias("hit"), F.lit(0).cast("long").alias("hit_check"))
    hits = hits.select(F.inline(F.array(same, id_alone))).distinct()
    null = F.col("_doc.text").isNull()
    own = F.when(null, of_id(F.col("_doc.doc_id"))).otherwise(F.col("_row"))
    check = F.when(null, 0).otherwise(F.col("_check"))
    return keyed(docs).join(hits, (own == F.col("hit")) & (check == F.col("hit_check")), "left_anti").select("_doc.*")
