"""The trie of conversation prefixes: which beginnings conversations have in common, and what
is saved if each is kept once.

A node is a distinct sequence of first turns, known by a digest of 128 bits: the exclusive or of
the digests of its turns, each taken with its depth. The work on nodes is done in shards, each
some conversations with all their prefixes, in flat numpy arrays:

1. The distinct prefix digests of a shard get slots from a minimal perfect hash, which keeps
   each slot's digest and thus tells collisions; members are counted and the smallest is
   found per slot. The nodes of all shards are then put together by digest.
2. A node belongs to its smallest member. What it adds to its ancestors is scattered into the
   shard of that conversation, which passes through all of them, and accumulated through the
   parents' slots, deepest nodes first. The sums of all shards are added by digest.

Any division of the conversations into shards gives the same sums, so neither a beginning
that very many share nor a long conversation has to be in one place: the turns of a long one
are divided into bands of BAND turns. A band starts at the last node of the band before, and
what lies deeper reaches an earlier band as one number, carried to its last turn.
"""

import hashlib

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketpulse.llm.common import stored
from marketpulse.llm.perfect_hash import PerfectHash

BAND = 1 << 16  # turns of one conversation that are worked on together
CHUNK = 1 << 17  # rows of a shard, a little more where a band does not end there
PIECE_BITS = 8  # ids that differ in these alone are put together
PART_BITS = 33  # below them, monotonically_increasing_id counts the rows of a partition
DIGEST = ["a", "b"]


def ordered_turns(conversations):
    """(turns, lengths): the turns as conv_id, place (from 0), a and b (digest of role and text)
    and n_bytes (of the text in UTF-8); and conv_id, own (turns) of each conversation.

    Turns follow `turn`, null first, equal ones role and text. Null roles and texts are empty;
    rows without a conv_id belong to no conversation. Rows are sorted by ranges, and a
    conversation that spans several is numbered on from range to range.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), text.alias("text"),
    ).where("conv_id IS NOT NULL")
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("role")]
    rows = rows.repartitionByRange(*order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
    rows = stored(rows.select(
        "conv_id", F.monotonically_increasing_id().alias("at"),
        *(F.xxhash64(F.lit(i), "role", "text").alias(name) for i, name in enumerate(DIGEST)),
        F.octet_length("text").cast("long").alias("n_bytes"),
    ), "trie-rows")

    part = F.shiftright("at", PART_BITS).alias("part")
    parts = rows.groupBy("conv_id", part).agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = stored(parts.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0))), "trie-parts")
    turns = rows.withColumn("part", part).join(parts, ["conv_id", "part"]).select(
        "conv_id", (F.col("at") - F.col("start") + F.col("before")).alias("place"), *DIGEST, "n_bytes",
    )
    return turns, parts.groupBy("conv_id").agg(F.sum("rows").alias("own"))


def with_borrowed_starts(turns, lengths, family=5, most=9):
    """(turns, lengths) of conversations rebuilt: the first h turns of the first conversation
    of the family (c - c % family), then c's own turns after its first h, where h is the
    checksum of the decimal id modulo `most`. A rebuilt conversation may have no turns."""
    c = F.col("conv_id")
    known = stored(lengths.select(
        "conv_id", "own", (c - c % family).alias("leader"), (F.crc32(c.cast("string").cast("binary")) % most).alias("h"),
    ), "trie-own")
    leaders = known.select(c.alias("leader"), F.col("own").alias("lent"))
    borrowed = F.least("h", F.coalesce("lent", F.lit(0)))
    known = stored(known.join(leaders, "leader", "left").select(
        "conv_id", "h", borrowed.alias("borrowed"),
        (borrowed + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("own"),
    ), "trie-rebuilt")
    turns = stored(turns, "trie-turns")
    keys = ["conv_id", "h", "borrowed"]
    rest = turns.join(known.select(*keys), "conv_id").where("place >= h")
    rest = rest.withColumn("place", F.col("place") - F.col("h") + F.col("borrowed"))
    starts = turns.where((c % family == 0) & (F.col("place") < most - 1)).withColumn(
        "conv_id", F.explode(F.array(*(c + F.lit(i).cast("long") for i in range(family))))
    )
    starts = starts.join(known.select(*keys), "conv_id").where("place < h")
    return rest.unionByName(starts).drop("h", "borrowed"), known.select("conv_id", "own")


ROWS = ["family", "band", "conv_id", "depth", "kind", "a", "b", "n", "m"]
PREFIX, VALUE = 0, 1


def rows_of(conv_id, band, depth, kind, a, b, n, m):
    """One row of a shard. A PREFIX carries the digest of one turn, its bytes and whether the
    conversation ends there; a VALUE what is added at the prefix before it."""
    family = F.col("conv_id") - F.col("conv_id") % 5  # these often begin alike
    kinds = dict(band="int", depth="long", kind="int", a="long", b="long", n="long", m="long")
    given = dict(band=band, depth=depth, kind=F.lit(kind), a=a, b=b, n=n, m=m)
    return [family.alias("family"), conv_id.alias("conv_id")] + [given[k].cast(t).alias(k) for k, t in kinds.items()]


def band_of(depth):
    return F.floor(F.greatest(depth - 1, F.lit(0)) / BAND)


def prefix_rows(turns, lengths):
    """The rows of all prefixes. Each conversation has one at depth 0, and one more before each
    later band with the digest reached there."""
    zero, depth = F.lit(0), F.col("depth")
    salted = [F.xxhash64(F.lit(i), "depth", *DIGEST).alias(name) for i, name in enumerate(DIGEST)]
    turns = turns.join(lengths, "conv_id").withColumn("depth", F.col("place") + 1)
    turns = stored(turns.select("conv_id", "depth", "own", *salted, "n_bytes"), "trie-prefixes")
    ends = (depth == F.col("own")).cast("long")
    plain = turns.select(*rows_of(F.col("conv_id"), band_of(depth), depth, PREFIX, F.col("a"), F.col("b"), F.col("n_bytes"), ends))
    roots = lengths.select(*rows_of(F.col("conv_id"), zero, zero, PREFIX, zero, zero, zero, (F.col("own") == 0).cast("long")))

    bands = turns.where(F.col("own") > BAND).groupBy("conv_id", band_of(depth).alias("band"))
    bands = bands.agg(*(F.bit_xor(c).alias(c) for c in DIGEST))
    earlier = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = stored(bands.select("conv_id", "band", *(F.bit_xor(c).over(earlier).alias(c) for c in DIGEST)), "trie-bands")
    begun = bands.where("band > 0").select(
        *rows_of(F.col("conv_id"), F.col("band"), F.col("band") * BAND, PREFIX, F.col("a"), F.col("b"), zero, zero)
    )
    return plain.unionByName(roots).unionByName(begun), bands


def sharded(rows):
    """The rows dealt out by family and band; a conversation's rows of a band are together, in order."""
    keys = ["family", "band"]
    return rows.select(*ROWS).repartition(*keys).sortWithinPartitions(*keys, "conv_id", "depth", "kind")


def shards(batches):
    """The rows of a task as dicts of arrays, some CHUNK at a time, whole bands only."""
    parts, size = [], 0
    for batch in batches:
        parts.append([batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(ROWS))])
        size += batch.num_rows
        if size >= CHUNK:
            columns = [np.concatenate(c) for c in zip(*parts)]
            bounds = band_starts(dict(zip(ROWS, columns)))
            cut = bounds[-1]
            if cut:
                yield dict(zip(ROWS, (c[:cut] for c in columns)))
            parts, size = [[c[cut:] for c in columns]], size - cut
    if size:
        yield dict(zip(ROWS, (np.concatenate(c) for c in zip(*parts))))


def band_starts(rows):
    conv, band = rows["conv_id"], rows["band"]
    return np.flatnonzero(np.append(True, (conv[1:] != conv[:-1]) | (band[1:] != band[:-1])))


class Shard:
    """The nodes of some conversations in flat arrays, one entry per slot."""

    def __init__(self, rows):
        prefix = rows["kind"] == PREFIX
        self.row = np.cumsum(prefix) - 1  # the prefix that each row belongs to
        own = {name: values[prefix] for name, values in rows.items()}
        starts = band_starts(own)
        sizes = np.diff(np.append(starts, len(own["depth"])))
        self.a, self.b = (self._digests(own[c].view(np.uint64), starts, sizes) for c in DIGEST)
        # The first row of a later band stands for the last node of the band before, which is
        # counted there: it gets a slot of its own.
        first = np.zeros(len(self.a), dtype=bool)
        first[starts] = True
        self.counted = ~first | (own["band"] == 0)
        key = np.where(self.counted, self.a, ~self.a)

        order = np.lexsort((self.b, key))
        x, y = key[order], self.b[order]
        new = np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1]))
        table = PerfectHash(x[new], y[new])
        self.slot, self.size = table.slots(key, self.b), table.size
        if (self.slot < 0).any():
            raise ValueError("a prefix is not in its shard's table")
        self.own, self.first = own, first
        self.parent = np.full(self.size, -1, dtype=np.int64)
        inner = np.flatnonzero(~first)
        self.parent[self.slot[inner]] = self.slot[inner - 1]
        self.row_of = np.empty(self.size, dtype=np.int64)  # a prefix of each node
        self.row_of[self.slot] = np.arange(len(self.slot))

    @staticmethod
    def _digests(turns, starts, sizes):
        """The exclusive or of each band's turns up to every row."""
        run = np.bitwise_xor.accumulate(turns)
        return run ^ np.repeat(np.append(np.uint64(0), run[starts[1:] - 1]), sizes)

    def nodes(self):
        """Members, smallest member and whether it is counted here, of each slot."""
        counted = self.slot[self.counted]
        members = np.bincount(counted, minlength=self.size)
        least = np.full(self.size, np.iinfo(np.int64).max)
        np.minimum.at(least, counted, self.own["conv_id"][self.counted])
        return members, least

    def sums(self, rows):
        """What the VALUE rows add to each node's subtree: [n, m] per slot."""
        value = rows["kind"] == VALUE
        at = self.slot[self.row[value]]
        depth = self.own["depth"][self.row_of]
        order = np.argsort(-depth, kind="stable")
        levels = np.flatnonzero(np.diff(depth[order], prepend=-1))
        sums = []
        for name in ("n", "m"):
            total = np.zeros(self.size, dtype=np.int64)
            np.add.at(total, at, rows[name][value])
            for start, stop in zip(levels, np.append(levels[1:], self.size)):
                some = order[start:stop]
                some = some[self.parent[some] >= 0]
                np.add.at(total, self.parent[some], total[some])
            sums.append(total)
        return sums


PARTS = "a long, b long, pa long, pb long, depth long, n_bytes long, n_convs long, conv_id long, ended long"


def shard_nodes(rows):
    """The nodes of each shard; and with `ended`, the node where that conversation ends."""

    def run(batches):
        import pyarrow as pa

        names = [field.split()[0] for field in PARTS.split(", ")]
        for rows in shards(batches):
            shard = Shard(rows)
            members, least = shard.nodes()
            kept = np.flatnonzero(members)
            row = shard.row_of[kept]
            before = np.where(shard.first[row], row, row - 1)
            columns = [
                shard.a[row].view(np.int64), shard.b[row].view(np.int64),
                shard.a[before].view(np.int64), shard.b[before].view(np.int64),
                shard.own["depth"][row], shard.own["n"][row], members[kept], least[kept],
            ]
            yield pa.record_batch([*map(pa.array, columns), pa.nulls(len(kept), pa.int64())], names)
            last = np.flatnonzero((shard.own["m"] > 0) & shard.counted)
            digests = [pa.array(x[last].view(np.int64)) for x in (shard.a, shard.b)]
            rest = [pa.nulls(len(last), pa.int64())] * 6
            yield pa.record_batch([*digests, *rest, pa.array(shard.own["conv_id"][last])], names)

    return sharded(rows).mapInArrow(run, PARTS)


def shard_sums(rows):
    """a, b, saved and leaves: what the nodes of each shard add to their ancestors."""

    def run(batches):
        import pyarrow as pa

        for rows in shards(batches):
            shard = Shard(rows)
            saved, leaves = shard.sums(rows)
            row = shard.row_of
            kept = np.flatnonzero(((saved != 0) | (leaves != 0)) & shard.counted[row])
            digests = [x[row[kept]].view(np.int64) for x in (shard.a, shard.b)]
            yield pa.record_batch([pa.array(x) for x in (*digests, saved[kept], leaves[kept])], ["a", "b", "saved", "leaves"])

    return sharded(rows).mapInArrow(run, "a long, b long, saved long, leaves long")


def ends(ended):
    """a, b and ends_sha256: the ids of the conversations that end at a node, ascending, as
    decimals between commas, hashed. Neighbouring ids are put together in pieces; the pieces
    of a node that has several are hashed one after the other, without holding them."""
    ids = F.transform(F.sort_array(F.collect_list("ended")), lambda c: c.cast("string"))
    pieces = ended.groupBy(*DIGEST, F.shiftright("ended", PIECE_BITS).alias("piece")).agg(F.array_join(ids, ",").alias("ids"))
    pieces = stored(pieces, "trie-ends")
    several = stored(pieces.groupBy(*DIGEST).count().where("count > 1").select(*DIGEST), "trie-many-ends")
    single = pieces.join(several, DIGEST, "left_anti").select(*DIGEST, F.sha2(F.col("ids").cast("binary"), 256).alias("ends_sha256"))

    def run(batches):
        import pyarrow as pa

        node, state = None, None

        def done():
            columns = [pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.int64()), pa.array([state.hexdigest()])]
            return pa.record_batch(columns, [*DIGEST, "ends_sha256"])

        for batch in batches:
            for a, b, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (a, b) == node:
                    state.update(b",")
                else:
                    if node:
                        yield done()
                    node, state = (a, b), hashlib.sha256()
                state.update(ids.encode())
        if node:
            yield done()

    long = pieces.join(several, DIGEST).repartition(*DIGEST).sortWithinPartitions(*DIGEST, "piece")
    return single.unionByName(long.select(*DIGEST, "ids").mapInArrow(run, "a long, b long, ends_sha256 string"))


def trie_of(turns, lengths):
    """The node table of the given (turns, lengths), as `prefix_trie` describes it."""
    lengths = stored(lengths, "trie-lengths")
    rows, bands = prefix_rows(turns, lengths)
    parts = stored(shard_nodes(rows), "trie-shards")
    facts = [F.min(c).alias(c) for c in ("pa", "pb", "depth", "n_bytes", "conv_id")]
    nodes = parts.where("ended IS NULL").groupBy(*DIGEST).agg(*facts, F.sum("n_convs").alias("n_convs"))
    nodes = stored(nodes, "trie-nodes")
    children = nodes.where("depth > 0").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    nodes = stored(nodes.join(children, DIGEST, "left").fillna(0, ["n_children"]), "trie-family")

    depth, zero = F.col("depth"), F.lit(0)
    saved, leaf = (F.col("n_convs") - 1) * F.col("n_bytes"), (F.col("n_children") == 0).cast("long")
    values = nodes.select(*rows_of(F.col("conv_id"), band_of(depth), depth, VALUE, zero, zero, saved, leaf))
    deeper = values.where("band > 0").groupBy("conv_id", "band").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    later = Window.partitionBy("conv_id").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    carried = bands.select("conv_id", "band").join(deeper, ["conv_id", "band"], "left")
    carried = carried.select("conv_id", "band", *(F.coalesce(F.sum(c).over(later), zero).alias(c) for c in ("n", "m")))
    carried = carried.where("n <> 0 OR m <> 0").select(
        *rows_of(F.col("conv_id"), F.col("band"), (F.col("band") + 1) * BAND, VALUE, zero, zero, F.col("n"), F.col("m"))
    )
    sums = shard_sums(rows.unionByName(values).unionByName(carried))
    sums = sums.groupBy(*DIGEST).agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))

    above = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    ended = ends(parts.where("ended IS NOT NULL").select(*DIGEST, "ended"))
    named = nodes.join(above, ["pa", "pb"], "left").join(sums, DIGEST, "left").join(ended, DIGEST, "left")
    return named.select(
        "conv_id", "depth", F.when(depth > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs", "n_children", F.coalesce("leaves", zero.cast("long")).alias("n_leaves"),
        F.coalesce("saved", zero.cast("long")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def prefix_trie(conversations):
    """One row per node, the distinct sequences of first d turns (role and text), from the
    root with d = 0: conv_id (the smallest conversation that begins so; with depth it names
    the node), depth, parent_conv_id (null for the root), n_convs (conversations that begin
    so), n_children, n_leaves (nodes without children in its subtree, itself included),
    saved_tokens (for all nodes of the subtree, the bytes of the last turn's text times the
    conversations but one) and ends_sha256 (of the ids of those that end there, ascending,
    between commas).

    Turns are ordered by `turn`, null first, and equal ones by role and text, so repeated rows
    are turns of their own. Null and empty roles and texts are alike. Rows without a
    conv_id are left out. Texts of any length count by their digest. Other columns are not
    read. An empty table gives no rows, not even a root.
    """
    return trie_of(*ordered_turns(conversations))
