"""From documents to token ids: toxic documents go, repeated lines go, one document of each
group of near duplicates stays, documents with benchmark passages go, the rest is encoded.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; all
but the last return the columns of `documents`, which they also expect.
"""

from marketpulse.llm.bpe import token_digests
from marketpulse.llm.common import stored
from marketpulse.llm.decontaminate import without_contaminated
from marketpulse.llm.line_dedup import dedup_lines
from marketpulse.llm.queries import read, tokenizer_path
from marketpulse.llm.simhash import near_dedup
from marketpulse.llm.toxicity import fit, without_toxic


def toxicity(spark, docs, sf_dir):
    """Documents that the ordinal model does not call toxic. It is fitted on the labelled
    documents among those given."""
    return without_toxic(docs, fit(docs, read(spark, sf_dir, "labels")))


def line_dedup(spark, docs, sf_dir):
    """All documents, without lines that repeat or nearly repeat an earlier one."""
    return dedup_lines(docs, least=1, counts=False)


def simhash_near_dedup(spark, docs, sf_dir):
    """The document with the smallest id of each group of linked fingerprints."""
    return near_dedup(docs, width=3)


def decontamination(spark, docs, sf_dir):
    """Documents that hold no benchmark item."""
    return without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def bpe(spark, docs, sf_dir):
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) and the digests of the
    ids and of the text that they decode to."""
    return token_digests(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination),
    ("bpe", bpe),
]
ORACLE_SQL = None  # fitted models, edit distances and merges are beyond SQL


def run(spark, sf_dir):
    """The stages applied to `documents`; each result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    *filters, (_, last) = STAGES
    for name, stage in filters:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return last(spark, docs, sf_dir)
