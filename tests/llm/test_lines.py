import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.conftest import EDGES, clashing

from marketpulse.llm import line_dedup
from marketpulse.llm.edit_distance import within
from marketpulse.llm.line_dedup import dedup_lines, plain
from marketpulse.llm.queries import QUERIES

TEXTS = st.text("abc", max_size=12)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=500, deadline=None)
@given(TEXTS, TEXTS, st.integers(0, 4))
def test_banded_distance(a, b, bound):
    exact = distance(a, b)
    assert within(a, b, bound) == (exact if exact <= bound else None)


def expected(rows, least=20):
    """Each line compared with all earlier distinct lines."""
    first = {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for number, line in enumerate((text or "").split("\n")):
            if len(plain(line)) >= least:
                first.setdefault(plain(line), (doc_id, number))
    by_length, near = defaultdict(list), set()
    for line in first:
        for n in (len(line) - 1, len(line), len(line) + 1):
            if any(within(line, other, 1) is not None for other in by_length[n]):
                near.add(line)
        by_length[len(line)].append(line)
    out = []
    for doc_id, text in rows:
        left, repeats, close = [], 0, 0
        for number, line in enumerate((text or "").split("\n")):
            known = plain(line)
            if len(known) >= least and first[known] != (doc_id, number):
                repeats += 1
            elif len(known) >= least and known in near:
                close += 1
            else:
                left.append(line)
        out.append((doc_id, None if text is None else "\n".join(left), repeats, close))
    return sorted(out, key=repr)


def found(docs):
    rows = dedup_lines(docs).select("doc_id", "text", "n_repeated", "n_near").collect()
    return sorted(map(tuple, rows), key=repr)


def edited(line, draw):
    k, kind = draw.randrange(len(line)), draw.random()
    new = draw.choice("abxyé日")
    return line[:k] + (new if kind < 0.6 else "") + line[k + (kind < 0.3 or kind >= 0.6):]


@pytest.mark.parametrize("paired", [2, 16])
def test_lines_by_brute_force(make, paired, monkeypatch):
    monkeypatch.setattr(line_dedup, "PAIRED", paired)
    draw = random.Random(paired)
    bases = ["the quick brown fox jumps over it", "élan vital et toute la suite à voir", "x" * 25]
    rows = []
    for i in range(120):
        lines = []
        for _ in range(draw.randrange(1, 5)):
            line = draw.choice(bases)
            for _ in range(draw.randrange(3)):
                line = edited(line, draw)
            lines.append(draw.choice(["", "  ", "short"]) if draw.random() < 0.2 else line)
        rows.append((i, "\n".join(lines)))
    rows += [(900, None), (901, ""), (902, "\n\n")]
    assert found(make(rows)) == expected(rows)


def test_edges(edges, none):
    docs = clashing(edges, "row", "line", "left", "near", "n_near", "_doc", "_row")
    rows = dedup_lines(docs).collect()
    assert len(rows) == len(EDGES)
    assert {r.row for r in rows} == {"taken"}
    assert sum(r.n_repeated + r.n_near for r in rows) == 0  # no line but one is long, and that one is alone
    assert [r.n_chars for r in rows if r.doc_id == 2] == [None]
    assert dedup_lines(none).count() == 0


def test_ties_and_repeated_rows(make):
    line = "a line that is long enough to count"
    rows = [(1, line), (1, line), (2, f"{line}\n{line}"), (None, line), (3, f" {line.replace(' ', '  ')} ")]
    assert found(make(rows)) == sorted(
        [(1, line, 0, 0), (1, line, 0, 0), (2, "", 2, 0), (None, "", 1, 0), (3, "", 1, 0)], key=repr
    )


def test_one_id_two_texts(make):
    one, other = "a line that is long enough", "quite another line, longer"
    rows = [(1, one), (1, f"{other}\nx"), (2, one), (3, other)]
    assert found(make(rows)) == [(1, one, 0, 0), (1, f"{other}\nx", 0, 0), (2, "", 1, 0), (3, "", 1, 0)]


def test_very_long_line(make):
    line = "abcdefghij" * 20_000
    rows = [(1, line), (2, line[:150_000] + line[150_001:]), (3, "z" + line[2:])]
    assert [r[2:] for r in found(make(rows))] == [(0, 0), (0, 1), (0, 0)]


def test_a_third_of_all_lines_alike(make):
    hot = "this line stands in very many documents"
    rows = [(i, f"{hot}\nand a line of its own, number {i * 1001 % 7919:09d}{i}") for i in range(300)]
    assert found(make(rows)) == expected(rows)


def test_repeats_of_short_lines_by_brute_force(make):
    draw = random.Random(5)
    short = ["Les.", "Lea.", "And ornd.", "x", "é", " y  z ", "", "  ", "nineteen characters"]
    long = ["the quick brown fox jumps over it", "the quick brown fox jumps over i"]
    rows = [(i, "\n".join(draw.choice(short + long) for _ in range(draw.randrange(6)))) for i in range(60)]
    first, left = {}, {}
    for doc_id, text in rows:
        for number, line in enumerate(text.split("\n")):
            first.setdefault(plain(line), (doc_id, number))
    near = max(long, key=first.get)
    for doc_id, text in rows:
        lines = [(plain(line), line, (doc_id, n)) for n, line in enumerate(text.split("\n"))]
        repeats = [bool(known) and first[known] != place for known, _, place in lines]
        close = [known == near and not gone for (known, _, _), gone in zip(lines, repeats)]
        text = "\n".join(line for (_, line, _), a, b in zip(lines, repeats, close) if not a and not b)
        left[doc_id] = (doc_id, text, sum(repeats), sum(close))
    got = dedup_lines(make(rows), least=1).select("doc_id", "text", "n_repeated", "n_near").collect()
    assert sorted(map(tuple, got)) == sorted(left.values())


def test_the_query_drops_repeats_of_short_lines(spark, make, tmp_path):
    make([(1, "Les.\nx"), (2, "Les."), (3, "\n")]).write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op10_line_dedup"](spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.n_repeated, r.n_near) for r in rows) == [(1, 0, 0), (2, 1, 0), (3, 0, 0)]
