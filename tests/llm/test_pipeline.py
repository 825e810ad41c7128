"""The pipeline on a small corpus, stage by stage and as a whole."""

import hashlib
import os
import random

import numpy as np
import public_tokenizers
import pytest
from llm.conftest import EDGES, clashing
from llm.test_lines import expected as expected_lines
from llm.test_near import component_ids
from tokenizers import Tokenizer

import corpus_pipeline
from marketpulse.llm.common import stored

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
BAD = ["wretch", "villain", "scoundrel"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw = random.Random(8)
    words = [f"w{i}" for i in range(500)]
    line = lambda n: " ".join(draw.choice(words) for _ in range(n))
    text = lambda lines: "\n".join(line(draw.randrange(8, 20)) for _ in range(lines))
    boilerplate = "please read the terms of use before you go on"
    item = line(30)
    texts = [text(draw.randrange(1, 6)) for _ in range(120)]
    toxic = set(range(0, 120, 6))
    for i in toxic:
        texts[i] = texts[i].replace(" ", f" {BAD[i % 3]} {BAD[(i + 1) % 3]} ", 2)
    for i in range(1, 120, 7):
        texts[i] += f"\n{boilerplate}"
    for i in range(2, 120, 15):
        texts[i] += f" {item} {line(9)}"
    texts += [texts[5], texts[5].replace(" ", "  ", 3), None, "", " ", texts[1].replace("\n", " ")]
    rows = [(i, t, "en", "a", None if t is None else len(t)) for i, t in enumerate(texts)]
    path = str(tmp_path_factory.mktemp("corpus"))
    save = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    save(rows, COLUMNS, "documents")
    save([(i, 1, int(i in toxic)) for i in range(0, 120)], "doc_id long, quality int, toxic int", "labels")
    save([(1, item), (2, line(25))], "item_id long, text string", "benchmark")
    return path, rows, toxic, item


def test_stages_have_their_names_and_order():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "simhash_near_dedup", "decontamination", "bpe"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_each_stage_by_brute_force(spark, folder):
    path, rows, toxic, item = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        before = sorted((r.doc_id, r.text) for r in docs.collect())
        docs = stored(stage(spark, docs, path), "test-stage")
        if name != "bpe":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        after = docs.collect()
        results[name] = (before, after)
    kept = lambda name: sorted((r.doc_id, r.text) for r in results[name][1])

    assert kept("toxicity") == [(d, t) for d, t, *_ in rows if d not in toxic]
    before, after = results["line_dedup"]
    assert kept("line_dedup") == sorted((d, t) for d, t, _, _ in expected_lines(before))
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in after)
    before, _ = results["simhash_near_dedup"]
    first = {d for d, _, component in component_ids(before) if d == component}
    assert kept("simhash_near_dedup") == [(d, t) for d, t in before if d in first]
    before, _ = results["decontamination"]
    assert kept("decontamination") == [(d, t) for d, t in before if item not in (t or "")]
    before, after = results["bpe"]
    for row, (doc_id, text) in zip(sorted(after), before, strict=True):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids, dtype="<u4")
        assert (row.doc_id, row.n_tokens, bytes(row.ids)) == (doc_id, len(ids), ids.tobytes())
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()

    whole = sorted(corpus_pipeline.run(spark, path).collect())
    assert whole == sorted(results["bpe"][1])


def test_empty_documents(spark, folder, tmp_path):
    path, *_ = folder
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        os.symlink(f"{path}/{name}.parquet", f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_on_odd_rows(spark, folder, edges):
    """Nulls in every column, repeated rows, rows without an id, a very long text, and columns
    named like those that the operators add."""
    path, *_ = folder
    names = ["n_near", "n_repeated", "row", "check", "_doc", "_row", "toxic", "score", "fp", "hit", "line", "gram"]
    docs = stored(clashing(edges, *names), "odd-rows")
    whole = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, docs, path)
        assert result.columns == docs.columns
        rows = result.collect()
        assert all(getattr(r, "n_near") == "taken" and r["row"] == "taken" for r in rows)
        if name in ("toxicity", "decontamination"):
            assert sorted((r.doc_id, r.text) for r in rows if r.doc_id is not None) == whole
        if name == "line_dedup":
            assert len(rows) == len(EDGES)
        if name == "simhash_near_dedup":
            assert [r.doc_id for r in rows].count(5) == 0 and {1, 2, 8} <= {r.doc_id for r in rows}
        empty = stage(spark, docs.limit(0), path)
        assert empty.columns == docs.columns and empty.count() == 0
    name, last = corpus_pipeline.STAGES[-1]
    assert last(spark, docs, path).count() == len(EDGES)
    assert last(spark, docs.limit(0), path).count() == 0
