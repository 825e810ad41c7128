import random

import numpy as np
import pytest
from llm.conftest import EDGES, LONG, clashing

from marketpulse.llm import substring_dedup
from marketpulse.llm.substring_dedup import remove_shared, word_slices


def expected(rows, length=50):
    """Every passage of every document looked up among those of all others."""
    texts = [(doc_id, (text or "").encode().split()) for doc_id, text in rows]
    first = {}
    for doc_id, words in texts:
        if doc_id is not None:
            for i in range(len(words) - length + 1):
                passage = tuple(words[i:i + length])
                first[passage] = min(doc_id, first.get(passage, doc_id))
    out = []
    for doc_id, words in texts:
        gone = np.zeros(len(words), dtype=bool)
        if doc_id is not None:
            for i in range(len(words) - length + 1):
                if first[tuple(words[i:i + length])] < doc_id:
                    gone[i:i + length] = True
        edges = np.flatnonzero(np.diff(gone, prepend=False, append=False)).reshape(-1, 2)
        kept = b" ".join(w for w, g in zip(words, gone) if not g).decode()
        out.append((doc_id, len(words), [tuple(e) for e in edges.tolist()], kept))
    return sorted(out, key=repr)


def found(docs, length=50):
    rows = remove_shared(docs, length).collect()
    return sorted(((r.doc_id, r.n_words, [tuple(s) for s in r.spans], r.kept) for r in rows), key=repr)


def corpus(seed, length):
    """Pieces of a few sources put together, so that passages agree in part, with several
    partners for one passage, inner repeats, copies and repeated rows."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["é日", "\U0001f600", "a\x1cb"]
    sources = [[draw.choice(vocabulary) for _ in range(draw.randrange(4 * length))] for _ in range(6)]
    rows = []
    for i in draw.sample(range(1000), 90):
        words = []
        for _ in range(draw.randrange(1, 5)):
            source = draw.choice(sources)
            a = draw.randrange(len(source) + 1)
            words += source[a:a + draw.randrange(3 * length)]
            words += [draw.choice(vocabulary) for _ in range(draw.randrange(4))]
        if draw.random() < 0.1:
            words = words * 3
        if draw.random() < 0.1:
            words = ["same"] * draw.randrange(3 * length)
        rows.append((i, "".join(w + draw.choice([" ", "  ", "\n", "\t\x0b"]) for w in words)))
    return rows + [rows[3], rows[3], (rows[4][0], rows[5][1]), (2000, rows[6][1]), (None, rows[6][1]), (None, None)]


@pytest.mark.parametrize("length, piece, chunk, cut", [(50, 1 << 18, 1 << 16, 1 << 22), (50, 60, 300, 40), (7, 5, 1 << 16, 9)])
def test_repeats_by_brute_force(make, monkeypatch, length, piece, chunk, cut):
    monkeypatch.setattr(substring_dedup, "PIECE", piece)
    monkeypatch.setattr(substring_dedup, "CHUNK", chunk)
    monkeypatch.setattr(substring_dedup, "SLICE", cut)
    rows = corpus(length + piece, length)
    assert found(make(rows), length) == expected(rows, length)


def test_edges(edges, none):
    docs = clashing(edges, "gram", "row", "low", "kept", "spans", "entries", "first", "_possible")
    assert found(docs) == expected([(d, t) for d, t, *_ in EDGES])
    assert found(none) == []


def test_one_passage_in_a_third_of_all_documents(make):
    draw = random.Random(2)
    passage = " ".join(f"p{draw.randrange(10**6)}" for _ in range(80))
    rows = [(999, LONG), (998, LONG)]
    for i in range(150):
        own = " ".join(f"{draw.randrange(10**9)}" for _ in range(60))
        rows.append((i, f"{own} {passage} {own[::-1]}" if i % 3 == 0 else own))
    assert found(make(rows)) == expected(rows)


def test_a_passage_that_differs_in_the_smallest_document(make):
    """The smallest document that has the anchor does not have the passage."""
    draw = random.Random(4)
    words = [f"p{draw.randrange(10**6)}" for _ in range(70)]
    rows = [(i, " ".join(words[:10 + i] + [f"odd{i}"] + words[11 + i:])) for i in range(60)]
    rows += [(100, " ".join(words)), (101, "before " + " ".join(words) + " after"), (102, " ".join(words[5:57]))]
    assert found(make(rows)) == expected(rows)


def test_words_are_split_in_slices(monkeypatch):
    monkeypatch.setattr(substring_dedup, "SLICE", 3)
    raw = "a bb  ccc\x0bdddd eeeee\x1c \x85 f ".encode()
    assert [w for words in word_slices(raw) for w in words] == raw.split()
