"""Token counts per section: a document is encoded once, whole, and the character spans of
its tokens are joined with the spans of its sections."""

import numpy as np
from pyspark.sql import functions as F

from marketpulse.llm.bpe import broadcast_model
from marketpulse.llm.common import documents, small

RULES = ("most", "first", "last")
COUNTS = "doc_id long, section int, name string, start long, end long, n_tokens long, n_crossing long"


def line_spans(text):
    """Character spans of the lines, each with its line feed: together the whole text. An
    empty text is one empty line."""
    spans, start = [], 0
    while True:
        stop = text.find("\n", start) + 1
        if not stop or stop == len(text):
            spans.append((start, len(text)))
            return spans
        spans.append((start, stop))
        start = stop


def token_spans(text, lengths):
    """First character and end of each token, from the tokens' byte lengths. A character
    that several tokens share belongs to the span of each of them."""
    ends = np.cumsum(lengths)
    starts = ends - lengths
    raw = text.encode()
    if len(raw) == len(text) or not len(ends):
        return starts, ends
    leads = (np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80
    character = np.cumsum(leads) - 1
    return character[starts], character[ends - 1] + 1


def attribute(starts, ends, spans, rule):
    """Tokens per section and how many of them reach beyond it.

    Sections are sorted and do not overlap. A token inside one section belongs to it. One
    that meets several goes to the section with most of its characters, the earlier of equals
    (`most`), or to the first or last that it meets. A token outside all sections counts
    nowhere.
    """
    a, b = np.array(spans, dtype=np.int64).reshape(-1, 2).T
    first = np.searchsorted(b, starts, side="right")
    last = np.searchsorted(a, ends, side="left") - 1
    met = first <= last
    first, last, starts, ends = first[met], last[met], starts[met], ends[met]
    owner = (last if rule == "last" else first).copy()
    if rule == "most":
        for t in np.flatnonzero(first < last):
            own = np.arange(first[t], last[t] + 1)
            shares = np.minimum(ends[t], b[own]) - np.maximum(starts[t], a[own])
            owner[t] = own[int(np.argmax(shares))]
    beyond = (starts < a[owner]) | (ends > b[owner])
    return np.bincount(owner, minlength=len(a)), np.bincount(owner[beyond], minlength=len(a))


def token_counts(docs, path, sections=None, rule="most"):
    """One row per section: doc_id, section (from 0), name, start, end, n_tokens, n_crossing.

    `sections` names a column of array<struct<name,start,end>> with character offsets, sorted
    and without overlap; without it the sections are the lines and `name` is null. A null or
    empty text has one empty line; a null or empty array gives no row. Every input row is
    counted by itself, repeated rows too. `n_crossing` are the tokens counted in a section
    that reach beyond it. Texts of any length are encoded whole; an empty table gives no rows.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    given = F.lit(None).cast("array<struct<name:string,start:long,end:long>>")
    if sections:
        given = F.col(sections).cast("array<struct<name:string,start:long,end:long>>")
    shared = broadcast_model(docs.sparkSession, path)
    by_line = sections is None

    def run(batches):
        import pyarrow as pa

        model = shared.value
        lengths = np.zeros(max(model.strings) + 1, dtype=np.int64)
        for i, string in model.strings.items():
            lengths[i] = len(string)
        kinds = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        names = ["doc_id", "section", "name", "start", "end", "n_tokens", "n_crossing"]
        for batch in small(batches):
            rows = []
            for doc_id, text, given in zip(*(c.to_pylist() for c in batch.columns)):
                if by_line:
                    spans, labels = line_spans(text), None
                else:
                    spans = [(s["start"], s["end"]) for s in given or ()]
                    labels = [s["name"] for s in given or ()]
                if not spans:
                    continue
                ids = np.frombuffer(model.encode(text), dtype="<u4")
                counts = attribute(*token_spans(text, lengths[ids]), spans, rule)
                for k, ((start, stop), n, crossing) in enumerate(zip(spans, *map(np.ndarray.tolist, counts))):
                    rows.append((doc_id, k, labels[k] if labels else None, start, stop, n, crossing))
                if len(rows) >= 50_000:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                    rows = []
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return documents(docs, given.alias("sections")).mapInArrow(run, COUNTS)
