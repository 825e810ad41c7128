import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.conftest import EDGES, LONG, clashing
from pyspark.sql import functions as F

from marketpulse.llm.fill_in_middle import Tokens, fill_in_middle, restored
from marketpulse.llm.wavelet import WaveletMatrix

TOKEN = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def expected(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    tokens = TOKEN.findall(text)
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, text, text
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if h[3] % 100 < 80:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


def found(docs):
    rows = fill_in_middle(docs).withColumn("restored", restored(F.col("output"), F.col("form"))).collect()
    return sorted((tuple(r) for r in rows), key=repr)


@given(st.lists(st.integers(0, 3), max_size=1500))
@settings(max_examples=60, deadline=None)
def test_ranks(symbols):
    matrix = WaveletMatrix(np.array(symbols, dtype=np.uint8), 2)
    for place in {0, 1, len(symbols) // 3, len(symbols) * 2 // 3, len(symbols)} & set(range(len(symbols) + 1)):
        assert [matrix.rank(s, place) for s in range(4)] == [symbols[:place].count(s) for s in range(4)]
    ends = [i + 1 for i, s in enumerate(symbols) if s >= 2]
    for nth in {1, len(ends) // 2, len(ends)} & set(range(1, len(ends) + 1)):
        assert matrix.place_of((2, 3), nth) == ends[nth - 1]


@given(st.text("a é\t\n\x0b\x1c　\U0001f600", max_size=80))
@settings(max_examples=200, deadline=None)
def test_token_bounds(text):
    tokens = Tokens(text)
    parts = TOKEN.findall(text)
    assert tokens.count == len(parts)
    assert [tokens.end_of(i) for i in range(len(parts) + 1)] == [len("".join(parts[:i])) for i in range(len(parts) + 1)]


def test_by_brute_force(make):
    pieces = ["word", " ", "\n\n", "é<", "P>", "<P", "<S", "S>", "M>", "\U0001f600", "\t", "<", ">", "x"]
    draw = np.random.default_rng(5)
    rows = [(i, "".join(draw.choice(pieces, draw.integers(0, 40)))) for i in range(600)]
    rows += [(1000 + i, f"<{c}>marked text") for i, c in enumerate("PSM" * 8)] + [(7, "again"), (7, "again"), (-3, "a b c d")]
    results = found(make(rows))
    assert results == sorted((expected(*r) for r in rows), key=repr)
    assert {r[2] for r in results} == {"plain", "psm", "spm"}


def test_edges(edges, none):
    docs = clashing(edges, "n", "form", "output", "prefix_chars")
    assert found(docs) == sorted((expected(d, t) for d, t, *_ in EDGES), key=repr)
    assert found(none) == []


@pytest.mark.parametrize("percent, forms", [(0, {"plain"}), (100, {"psm", "spm"})])
def test_shares(make, percent, forms):
    docs = make([(i, f"some words {i}") for i in range(100)] + [(500, LONG)])
    assert {r.form for r in fill_in_middle(docs, percent=percent).collect()} == forms
