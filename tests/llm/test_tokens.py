import json
import random

import numpy as np
import public_tokenizers
import pytest
from llm.conftest import EDGES, LONG, clashing, rows_of
from tokenizers import Tokenizer

from marketpulse.llm.bpe import BytePairModel, decode_documents, encode_documents, round_trip
from marketpulse.llm.token_counts import attribute, line_spans, token_counts, token_spans

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def model():
    return BytePairModel(PATH, known_words=50)


def ids(model, text):
    return np.frombuffer(model.encode(text), dtype="<u4").tolist()


def texts(n=1500):
    draw = random.Random(7)
    parts = [
        "<|endoftext|>", "<|endo", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", "a", "the", "Begin", "9", "42",
        "é", "é", "日本語", "\U0001f600", "'s", "'LL", "'ll", "!", "...", "_", "ß", "ſ", "½", "٣", "straße",
    ]
    for _ in range(n):
        yield "".join(draw.choice(parts) for _ in range(draw.randrange(30)))


def test_same_ids_as_the_library(model, library):
    for text in texts():
        assert ids(model, text) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_every_character(model, library):
    letters = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(letters), 97):
        text = "a" + "b ".join(letters[start:start + 97]) + "  c"
        assert ids(model, text) == library.encode(text, add_special_tokens=False).ids


def test_same_decoding_as_the_library(model, library):
    for text in texts(500):
        encoded = library.encode(text, add_special_tokens=False).ids
        cut = encoded[1:]  # may start inside a character
        packed = np.array(cut, dtype="<u4").tobytes()
        assert model.decode(packed) == library.decode(cut, skip_special_tokens=False)


def test_very_long_word(model):
    word = "ab" * 100_000
    assert model.decode(model.encode(word)) == word


def test_documents_of_edges(edges, library):
    both = rows_of(round_trip(clashing(edges, "ids", "decoded"), PATH), "doc_id", "ids", "decoded")
    expected = []
    for doc_id, text, *_ in EDGES:
        encoded = library.encode(text or "", add_special_tokens=False).ids
        expected.append((doc_id, bytearray(np.array(encoded, dtype="<u4").tobytes()), text or ""))
    assert both == sorted(expected, key=repr)
    encoded = encode_documents(edges, PATH)
    assert rows_of(decode_documents(encoded, PATH)) == sorted(((d, t or "") for d, t, *_ in EDGES), key=repr)


def test_empty_tables(none):
    assert round_trip(none, PATH).count() == 0
    assert token_counts(none, PATH).count() == 0


def test_file_size_is_checked(tmp_path, monkeypatch):
    monkeypatch.setattr("marketpulse.llm.bpe.MAX_FILE_BYTES", 10)
    with pytest.raises(ValueError):
        BytePairModel(PATH)


def counted(library, text, spans, rule):
    """Tokens per span from the library's own offsets, one token at a time."""
    counts, beyond = [0] * len(spans), [0] * len(spans)
    for a, b in library.encode(text, add_special_tokens=False).offsets:
        met = [k for k, (s, e) in enumerate(spans) if s < b and a < e]
        if met:
            share = {k: min(b, spans[k][1]) - max(a, spans[k][0]) for k in met}
            k = {"first": met[0], "last": met[-1], "most": max(met, key=lambda k: (share[k], -k))}[rule]
            counts[k] += 1
            beyond[k] += a < spans[k][0] or b > spans[k][1]
    return counts, beyond


@pytest.mark.parametrize("rule", ["most", "first", "last"])
def test_spans_by_brute_force(model, library, rule):
    lengths = np.zeros(max(model.strings) + 1, dtype=np.int64)
    for i, string in model.strings.items():
        lengths[i] = len(string)
    draw = random.Random(3)
    for text in texts(400):
        text = text.replace("<|endo", "\n \n")
        cuts = sorted({0, len(text), *(draw.randrange(len(text) + 1) for _ in range(draw.randrange(5)))})
        spans = list(zip(cuts, cuts[1:]))[draw.randrange(2):]
        if not spans:
            continue
        encoded = np.array(ids(model, text), dtype=np.int64)
        got = attribute(*token_spans(text, lengths[encoded]), spans, rule)
        assert tuple(x.tolist() for x in got) == counted(library, text, spans, rule), (text, spans)


def test_lines():
    assert line_spans("") == [(0, 0)]
    assert line_spans("a\n\nb") == [(0, 2), (2, 3), (3, 4)]
    assert line_spans("a\n") == [(0, 2)]


def test_counts_of_edges(edges, library):
    rows = token_counts(clashing(edges, "section", "name", "sections", "start"), PATH).collect()
    expected = []
    for doc_id, text, *_ in EDGES:
        spans = line_spans(text or "")
        for k, (n, crossing) in enumerate(zip(*counted(library, text or "", spans, "most"))):
            expected.append((doc_id, k, None, *spans[k], n, crossing))
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)
    assert sum(r.n_tokens for r in rows if r.doc_id == 7) == len(
        library.encode(LONG, add_special_tokens=False).ids) + 6


def test_named_sections(make):
    docs = make(
        [(1, "title body text", [("title", 0, 6), ("body", 6, 15)]), (2, "x", None), (3, None, [("all", 0, 0)]), (4, "y", [])],
        "doc_id long, text string, fields array<struct<name:string,start:int,end:int>>",
    )
    rows = rows_of(token_counts(docs, PATH, sections="fields"), "doc_id", "name", "n_tokens", "n_crossing")
    assert rows == [(1, "body", 2, 1), (1, "title", 1, 0), (3, "all", 0, 0)]
    with pytest.raises(ValueError):
        token_counts(docs, PATH, rule="half")


@pytest.mark.parametrize("change", [
    lambda c: c.update(normalizer={"type": "NFC"}), lambda c: c["model"].update(ignore_merges=True),
    lambda c: c["pre_tokenizer"].update(add_prefix_space=True), lambda c: c["added_tokens"][0].update(lstrip=True),
    lambda c: c["model"].update(type="Unigram"),
])
def test_other_tokenizers_are_refused(tmp_path, change):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        content = json.load(file)
    change(content)
    path = tmp_path / "odd.json"
    path.write_text(json.dumps(content), encoding="utf-8")
    with pytest.raises(ValueError, match="not supported"):
        BytePairModel(str(path))
