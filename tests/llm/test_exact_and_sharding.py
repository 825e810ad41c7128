import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.conftest import EDGES, clashing, rows_of

from marketpulse.llm.common import bit_is_set, bitmap_of, filter_bits, MAX_FILTER_BITS
from marketpulse.llm.exact_dedup import dedup_decisions, exact_dedup
from marketpulse.llm.sharding import assign_shards, jump_hash


def decisions(rows):
    """What one pass over all rows gives."""
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()].append(doc_id)
    out = []
    for sha, ids in groups.items():
        first = min((i for i in ids if i is not None), default=None)
        out += [(i, first, len(ids), i == first, sha) for i in ids]
    return sorted(out, key=repr)


def test_decisions_of_edges(edges):
    assert rows_of(dedup_decisions(edges)) == decisions(EDGES)


def test_clashing_columns_and_empty_table(edges, none):
    odd = clashing(edges, "keep_id", "kept", "sha", "cell", "possible", "bucket", "bits")
    assert rows_of(dedup_decisions(odd)) == decisions(EDGES)
    assert rows_of(dedup_decisions(none)) == []
    assert exact_dedup(none).count() == 0


def test_a_full_filter_changes_nothing(make, monkeypatch):
    rows = [(i, f"text {i % 700}") for i in range(1000)]
    monkeypatch.setattr("marketpulse.llm.common.MAX_FILTER_BITS", 1 << 15)
    assert rows_of(dedup_decisions(make(rows), bits_per_row=1)) == decisions(rows)


def test_a_third_of_all_rows_alike(make):
    rows = [(i, "same  text" if i % 3 == 0 else f"text {i}") for i in range(900)]
    assert rows_of(dedup_decisions(make(rows))) == decisions(rows)


def test_kept_rows(edges):
    kept = rows_of(exact_dedup(clashing(edges, "kept")), "doc_id", "source")
    assert kept == sorted([(1, "a"), (2, None), (4, None), (7, "b"), (7, "b"), (8, "c")], key=repr)


def test_no_python_in_the_plan(edges):
    from conftest import plan

    assert not re.search("Python|Pandas|Arrow", plan(dedup_decisions(edges)))


def test_filter_size_is_bounded():
    assert filter_bits(0) == 8 * 4096
    assert filter_bits(10**12) == MAX_FILTER_BITS


def test_bitmaps(spark):
    from pyspark.sql import functions as F

    cells = [0, 1, 7, 8, 32767, 32768, 99_999]
    bitmaps = bitmap_of(spark.createDataFrame([(c,) for c in cells], "cell long"))
    probes = spark.range(0, 100_100).withColumn("bucket", F.bitmap_bucket_number(F.col("id") + 1))
    found = probes.join(bitmaps, "bucket", "left").where(bit_is_set(F.col("bits"), F.col("id")))
    assert sorted(r.id for r in found.collect()) == cells


def jump(key, shards):
    """The published loop, one key at a time."""
    state, place, target = key % 2**64, -1, 0
    while target < shards:
        place = target
        state = (state * 2862933555777941757 + 1) % 2**64
        target = int((place + 1) * (2**31 / ((state >> 33) + 1)))
    return place


@settings(max_examples=200, deadline=None)
@given(st.integers(-2**63, 2**63 - 1), st.integers(1, 200))
def test_jump_hash(key, shards):
    assert jump_hash(np.array([key]), shards).tolist() == [jump(key, shards)]


def test_one_more_shard_takes_rows_only_into_itself():
    keys = np.arange(20_000)
    old, new = jump_hash(keys, 16), jump_hash(keys, 17)
    assert set(new[old != new]) == {16}
    assert 0.04 < (old != new).mean() < 0.08
    assert max(Counter(old.tolist()).values()) < 1400


def test_shards_of_edges(edges):
    rows = assign_shards(clashing(edges, "shard", "slot", "part", "split"), 16, rows_per_range=2).collect()
    assert len(rows) == len(EDGES)
    expected = Counter()
    for doc_id, text, *_ in EDGES:
        raw = (text or "").encode()
        expected[doc_id, len(raw) + 1, zlib.crc32(raw), "key", jump(doc_id or 0, 16), jump(doc_id or 0, 17)] += 1
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in rows) == expected
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_slots_follow_ids(make):
    rows = assign_shards(make([(i * 7, "x") for i in range(500)]), 4, rows_per_range=40).collect()
    for shard in range(4):
        own = sorted((r.slot, r.doc_id) for r in rows if r.shard == shard)
        assert [s for s, _ in own] == list(range(len(own)))
        assert [d for _, d in own] == sorted(d for _, d in own)


def test_an_id_with_a_third_of_all_rows(make):
    rows = assign_shards(make([(5 if i % 3 == 0 else i, "x") for i in range(600)]), 4, rows_per_range=50).collect()
    for shard in range(4):
        own = [r.slot for r in rows if r.shard == shard]
        assert sorted(own) == list(range(len(own)))


def test_no_documents_no_shards(none):
    assert assign_shards(none).count() == 0
