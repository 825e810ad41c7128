import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm.conftest import EDGES, LONG, clashing
from pyspark.sql import functions as F

from marketpulse.llm import suffix_dedup
from marketpulse.llm.suffix_dedup import remove_repeats, sliding_least


def expected(rows):
    """All strings of 200 bytes counted."""
    counts = Counter()
    raws = [(doc_id, (text or "").encode()) for doc_id, text in rows]
    for _, raw in raws:
        counts.update(hashlib.blake2b(raw[i:i + 200], digest_size=12).digest() for i in range(len(raw) - 199))
    out = []
    for doc_id, raw in raws:
        gone = np.zeros(len(raw), dtype=bool)
        for i in range(len(raw) - 199):
            if counts[hashlib.blake2b(raw[i:i + 200], digest_size=12).digest()] > 1:
                gone[i:i + 200] = True
        edges = np.flatnonzero(np.diff(gone, prepend=False, append=False)).reshape(-1, 2)
        kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
        out.append((doc_id, len(raw), [tuple(e) for e in edges.tolist()], kept))
    return sorted(out, key=repr)


def found(docs):
    rows = remove_repeats(docs).collect()
    return sorted(((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in rows), key=repr)


def corpus(seed):
    draw = random.Random(seed)

    def text(n):
        return " ".join("".join(draw.choice("abcdeé日") for _ in range(draw.randrange(1, 7))) for _ in range(n))

    shared = [text(draw.randrange(40, 120)) for _ in range(5)]
    rows = []
    for i in range(80):
        parts = []
        for _ in range(draw.randrange(1, 4)):
            kind = draw.random()
            if kind < 0.4:
                a = draw.randrange(60)
                parts.append(draw.choice(shared)[a:a + draw.randrange(100, 400)])
            elif kind < 0.5:
                parts.append("ab" * draw.randrange(20, 300))
            else:
                parts.append(text(draw.randrange(60)))
        rows.append((i, " ".join(parts)))
    copies = [(300, rows[3][1]), (300, rows[3][1]), (301, rows[7][1]), (None, rows[7][1])]
    return rows + copies + [(400, None), (401, ""), (402, "a" * 199), (403, "b" * 200), (404, "c" * 201)]


@pytest.mark.parametrize("piece, chunk", [(1 << 20, 1 << 18), (130, 1000)])
def test_repeats_by_brute_force(make, piece, chunk, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    rows = corpus(piece)
    assert found(make(rows)) == expected(rows)


def test_edges(edges, none):
    docs = clashing(edges, "gram", "row", "low", "kept", "spans", "ranges", "_keep")
    assert found(docs) == expected([(d, t) for d, t, *_ in EDGES])
    assert remove_repeats(none).count() == 0


def test_one_passage_in_a_third_of_all_documents(make):
    draw = random.Random(2)
    passage = " ".join(f"p{draw.randrange(10**6)}" for _ in range(60))
    rows = []
    for i in range(150):
        own = " ".join(f"{draw.randrange(10**9)}" for _ in range(30))
        rows.append((i, f"{own} {passage} {own[::-1]}" if i % 3 == 0 else own))
    rows.append((999, LONG))
    assert found(make(rows)) == expected(rows)


@pytest.mark.parametrize("width", [1, 2, 3, 8, 137])
def test_sliding_least(width):
    values = np.random.default_rng(width).integers(0, 1000, 500)
    assert sliding_least(values, width).tolist() == [min(values[i:i + width]) for i in range(501 - width)]


def test_columns(edges):
    assert remove_repeats(edges).select(F.size("spans")).where("size(spans) < 0").count() == 0


def test_one_repeated_row_in_a_third_of_all_rows(make, monkeypatch):
    draw = random.Random(3)
    text = " ".join(f"r{draw.randrange(10**6)}" for _ in range(300))
    rows = [(i, " ".join(f"{draw.randrange(10**9)}" for _ in range(30))) for i in range(100)]
    rows += [(700, text)] * 25 + [(None, text)] * 25
    sizes = {}

    def kept(df, label, stored=suffix_dedup.stored):
        out = stored(df, label)
        if label == "suffix-ranges":
            sizes.update({r.row: r.n for r in out.select("row", F.size("ranges").alias("n")).collect()})
        return out

    monkeypatch.setattr(suffix_dedup, "stored", kept)
    assert found(make(rows)) == expected(rows)
    assert len(sizes) == 2 and max(sizes.values()) <= len(text) // 10
