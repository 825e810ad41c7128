"""The registered queries against their SQL, and what every result must hold."""

import os

import pytest
from tools.check import compare, open_oracle

import __spark_entry__ as entry
from marketpulse.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n in QUERIES) == list(range(1, 14))
    assert "pipeline" in names and set(QUERIES) <= set(names)


@pytest.mark.parametrize("name", list(ORACLE))
def test_same_as_sql(spark, name):
    assert compare(spark, open_oracle(SF_DIR), name, SF_DIR) is None


@pytest.mark.parametrize("name", ["op4_token_counts", "op5_simhash", "op6_toxicity", "op8_bpe", "op9_suffix_dedup", "op10_line_dedup"])
def test_every_document_has_its_rows(spark, name):
    result = entry.queries()[name](spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert result.select("doc_id").distinct().count() == docs.count()
