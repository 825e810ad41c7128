import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marketpulse.llm import prefix_trie as trie
from marketpulse.llm.perfect_hash import PerfectHash

SCHEMA = "conv_id long, turn long, role string, text string"


def conversations(rows):
    """Each conversation's turns in order."""
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            turns[conv_id].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    return {c: [t[2:] for t in sorted(own)] for c, own in turns.items()}


def borrowed(turns):
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = turns.get(c - c % 5, [])[:h] + own[h:]
    return out


def nodes_of(turns):
    """The trie as a dictionary of prefixes."""
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(turns):
        own = tuple(turns[c])
        for d in range(len(own) + 1):
            members[own[:d]].append(c)
        ends[own].append(c)
    children = defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    leaves, saved = defaultdict(int), defaultdict(int)
    for k in members:
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(members[k]) - 1) * len(k[-1][1]) if k else 0
    return sorted((
        members[k][0], len(k), members[k[:-1]][0] if k else None, len(members[k]), len(children[k]), leaves[k], saved[k],
        hashlib.sha256(",".join(map(str, ends[k])).encode()).hexdigest(),
    ) for k in members)


def found(table):
    return sorted(tuple(r) for r in table.collect())


def corpus(seed):
    draw = random.Random(seed)
    starts = [[(draw.choice("ua"), f"é{draw.randrange(3)}" * draw.randrange(3)) for _ in range(12)] for _ in range(3)]
    rows = []
    for c in draw.sample(range(400), 120):
        turns = draw.choice(starts)[:draw.randrange(13)] + [(draw.choice("ua"), draw.choice("xy")) for _ in range(draw.randrange(4))]
        rows += [(c, draw.choice([i, i, i * 10]), role, text) for i, (role, text) in enumerate(turns)]
    for c in (1000, 1001, 1002, 1003, 1005):  # long ones that agree for long
        rows += [(c, i, "user", f"turn {i if i < 50 + c % 3 * 7 else c + i}") for i in range(70 + c % 5 * 9)]
    rows += [(2000 + c, i, "user", "the same") for c in range(60) for i in range(5)]  # copies
    return rows + EDGES


# Nulls in every column, repeated rows, ties, an odd id, a very long text.
EDGES = [
    (3000, None, "user", "first"), (3000, 0, None, None), (3000, 0, "", ""), (3000, 1, "user", "again"),
    (3000, 1, "user", "again"), (3000, 1, "assistant", "tie"), (None, 0, "user", "nobody's"), (None, None, None, None),
    (3001, -5, "user", "long " * 50_000), (9_007_199_254_740_995, 0, "user", "first"), (9_007_199_254_740_994, 0, "user", "first"),
]


@pytest.mark.parametrize("band, chunk", [(1 << 16, 1 << 17), (4, 50), (1, 7)])
def test_by_brute_force(spark, monkeypatch, band, chunk):
    monkeypatch.setattr(trie, "BAND", band)
    monkeypatch.setattr(trie, "CHUNK", chunk)
    rows = corpus(band)
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(trie.prefix_trie(table)) == nodes_of(conversations(rows))
    rebuilt = trie.trie_of(*trie.with_borrowed_starts(*trie.ordered_turns(table)))
    assert found(rebuilt) == nodes_of(borrowed(conversations(rows)))


def test_edges(spark):
    table = spark.createDataFrame(EDGES, SCHEMA)
    odd = table.selectExpr("*", "1 AS a", "2 AS b", "3 AS place", "4 AS depth", "5 AS family", "6 AS kind", "7 AS at")
    assert found(trie.prefix_trie(odd)) == nodes_of(conversations(EDGES))
    assert found(trie.prefix_trie(table.limit(0))) == []
    nobody = spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)
    assert found(trie.prefix_trie(nobody)) == []


def test_conversations_without_turns(spark):
    """Rebuilt conversations that have no turns end at the root."""
    short = [c for c in range(1, 300) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1][:20]
    rows = [(c, 0, "user", f"own {c}") for c in short]
    table = trie.trie_of(*trie.with_borrowed_starts(*trie.ordered_turns(spark.createDataFrame(rows, SCHEMA))))
    digest = hashlib.sha256(",".join(map(str, short)).encode()).hexdigest()
    assert found(table) == [(short[0], 0, None, len(short), 0, 1, 0, digest)]


def test_one_beginning_in_all_conversations(spark):
    """Many conversations that end at one node, whose ids fill many pieces."""
    rows = [(c * 3, i, "user", "same" if i < 2 else f"{c}") for c in range(3000) for i in range(2 + c % 3 // 2)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(trie.prefix_trie(table)) == nodes_of(conversations(rows))


@given(st.sets(st.tuples(st.integers(0, 2**64 - 1), st.integers(0, 3)), max_size=300))
@settings(max_examples=60, deadline=None)
def test_perfect_hash(keys):
    first, second = np.array(sorted(keys), dtype=np.uint64).reshape(-1, 2).T
    table = PerfectHash(first, second)
    assert sorted(table.slots(first, second).tolist()) == list(range(len(keys)))
    assert (table.slots(first, second + np.uint64(4)) == -1).all()


def test_repeated_keys_are_refused():
    twice = np.array([5, 5], dtype=np.uint64)
    with pytest.raises(ValueError):
        PerfectHash(twice, twice)
