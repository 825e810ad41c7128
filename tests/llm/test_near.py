import random
import re

import numpy as np
import pytest
import xxhash
from llm.conftest import EDGES, clashing, rows_of

from marketpulse.llm import simhash
from marketpulse.llm.components import connected
from marketpulse.llm.golay import near_indices, patterns_by_syndrome
from marketpulse.llm.simhash import fingerprint, links_between, near_dedup, near_duplicates


def slow_fingerprint(text, width=3):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))
    shingles = [b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)]
    shingles = shingles or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def groups(prints):
    """The group of each position, by comparing all fingerprints."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if bin(a ^ prints[j]).count("1") <= 2:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(prints))]


def component_ids(rows):
    prints = [slow_fingerprint(text or "") for _, text, *_ in rows]
    roots = groups(prints)
    smallest = {}
    for (doc_id, *_), root in zip(rows, roots):
        known = [x for x in (doc_id, smallest.get(root)) if x is not None]
        smallest[root] = min(known, default=None)
    return sorted(
        ((r[0], f"{p:016x}", smallest[g]) for r, p, g in zip(rows, prints, roots)), key=repr
    )


def test_code_covers_all_values():
    sizes = (patterns_by_syndrome() >= 0).sum(axis=1)
    assert sorted(np.unique(sizes)) == [1, 6]
    assert (sizes == 6).sum() == 1771  # the values three bits from their codeword


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_values_two_bits_apart_share_a_codeword(bits):
    draw = np.random.default_rng(bits)
    values = draw.integers(0, 1 << 23, 4000)
    others = values.copy()
    for k in range(bits):
        others ^= 1 << draw.integers(0, 23, len(values))
    for a, b in zip(near_indices(values).tolist(), near_indices(others).tolist()):
        assert (set(a) & set(b)) - {-1}


@pytest.mark.parametrize("text", ["", " \n", "One", "one TWO", "a b c d A B", "É é\x0bß\x1cx y", "x " * 30_000])
def test_fingerprints(text):
    assert fingerprint(text, block=7) == fingerprint(text) == slow_fingerprint(text)


def test_edges(edges, none):
    odd = clashing(edges, "fp", "row", "key", "component_id", "fingerprint")
    assert rows_of(near_duplicates(odd)) == component_ids(EDGES)
    assert near_duplicates(none).count() == 0
    assert near_dedup(none).count() == 0


def test_one_document_of_each_group_stays(edges):
    kept = rows_of(near_dedup(clashing(edges, "row", "_row", "_doc", "_possible"), 3), "doc_id", "source")
    assert kept == sorted([(1, "a"), (2, None), (7, "b"), (7, "b"), (8, "c")], key=repr)


def near_prints(n, draw):
    """Crowded and lonely fingerprints, with chains of near ones."""
    out = []
    for _ in range(n):
        value = draw.getrandbits(64)
        for _ in range(draw.choice([1, 1, 2, 5, 60])):
            out.append(value)
            for _ in range(draw.randrange(4)):
                value ^= 1 << draw.randrange(64)
            if draw.random() < 0.5:
                value = out[-1] ^ (1 << draw.randrange(64))
    return sorted(set(out))


@pytest.mark.parametrize("paired", [2, 16, 10_000])
def test_links_connect_what_is_near(spark, paired, monkeypatch):
    monkeypatch.setattr(simhash, "PAIRED", paired)
    prints = near_prints(14, random.Random(paired))
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    links = links_between(spark.createDataFrame([(p,) for p in signed], "fp long"))
    found = links.collect()
    assert all(bin((a ^ b) % 2**64).count("1") <= 2 for a, b in found)
    got = {r.node: r.root for r in connected(links).collect()}
    together = {}
    for p, g in zip(signed, groups(prints)):
        together.setdefault(g, set()).add(got.get(p, p))
    assert all(len(roots) == 1 for roots in together.values())
    assert len(set().union(*together.values())) == len(together)


def test_many_copies(make):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    base = [draw.choice(words) for _ in range(150)]
    rows = []
    for i in range(300):
        text = list(base)
        if i % 3 == 1:
            text[draw.randrange(150)] = draw.choice(words)
        if i % 3 == 2:
            text = [draw.choice(words) for _ in range(40)]
        rows.append((i, " ".join(text)))
    assert rows_of(near_duplicates(make(rows))) == component_ids(rows)


def test_components(spark):
    draw = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 600)]
    loops = [(1, 1), (7, 8), (8, 7), (7, 8)]
    links = chain + star + loops
    draw.shuffle(links)
    got = {r.node: r.root for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 600)} | {7: 7, 8: 7}
    assert got == expected
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0
