"""Byte-pair encoding and decoding with the file of a public byte-level tokenizer.

A text is cut at special tokens and then into words by the tokenizer's pattern. In a word,
a heap holds the mergeable neighbours by merge rank over a doubly linked list of symbols;
entries whose symbols have changed meanwhile are skipped when they surface. Decoding joins
the vocabulary's byte strings.
"""

import json
import os
from array import array
from heapq import heapify, heappop, heappush

import regex
from pyspark.sql import functions as F

from marketpulse.llm.common import documents, small

# Fixed value: the word pattern of the byte-level tokenizer format.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PAIR, PLACE = 24, 40  # bits: a token id, and a place in a word
PLACE_MASK = (1 << PLACE) - 1
MAX_FILE_BYTES = 64 << 20  # the tokenizer is broadcast; a larger file is refused


def byte_letters():
    """The letter that stands for each byte in the file: printable Latin-1 characters stand
    for themselves, the other bytes take the characters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in set(plain))
    return {chr(256 + i): b for i, b in enumerate(others)} | {chr(b): b for b in plain}


class WordIds(dict):
    """Ids of words met before, as little-endian bytes. It is emptied when full."""

    def __init__(self, encode, limit):
        super().__init__()
        self.encode, self.limit = encode, limit

    def __missing__(self, word):
        ids = self.encode(word.encode())
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[word] = ids
        return ids


def refuse_unknown(content):
    """An error for a tokenizer file that asks for more than byte-level pairs and added tokens."""
    model, words = content["model"], content.get("pre_tokenizer") or {}
    asked = {name: model.get(name) for name in (
        "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")}
    asked |= {"normalizer": content.get("normalizer"), "add_prefix_space": words.get("add_prefix_space")}
    for token in content["added_tokens"]:
        asked |= {f"{flag} of {token['content']}": token.get(flag) for flag in ("single_word", "lstrip", "rstrip")}
    odd = [name for name, value in asked.items() if value]
    if model.get("type", "BPE") != "BPE" or words.get("type") != "ByteLevel" or not words.get("use_regex", True):
        odd.append("the kind of model or of words")
    if odd:
        raise ValueError(f"not supported: {', '.join(odd)}")


class BytePairModel:
    """A vocabulary with its merges. Instances reach tasks as a broadcast; the words that a
    Python worker has encoded stay with its copy."""

    def __init__(self, path, known_words=250_000):
        size = os.path.getsize(path)
        if size > MAX_FILE_BYTES:
            raise ValueError(f"{path} has {size} bytes; at most {MAX_FILE_BYTES} are broadcast")
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        refuse_unknown(content)
        letters, model = byte_letters(), content["model"]
        self.strings = {i: bytes(letters[x] for x in token) for token, i in model["vocab"].items()}
        self.special = {x["content"]: x["id"] for x in content["added_tokens"]}
        self.strings |= {i: token.encode() for token, i in self.special.items()}
        ids = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.ranks = {ids[a] << PAIR | ids[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.merged = [ids[a + b] for a, b in pairs]
        self.byte_ids = [ids[letter] for letter, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.known_words = known_words
        self._prepare()

    def _prepare(self):
        self.words = regex.compile(WORD_PATTERN)
        ordered = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, ordered)) + ")") if ordered else None
        self.known = WordIds(self.encode_word, self.known_words)

    def __getstate__(self):
        return {k: v for k, v in vars(self).items() if k not in ("words", "cut", "known")}

    def __setstate__(self, state):
        vars(self).update(state)
        self._prepare()

    def encode_word(self, word):
        """The ids of one word (bytes), lowest merge rank first, the leftmost of equals."""
        symbols = [self.byte_ids[b] for b in word]
        end = len(symbols)
        before, after = list(range(-1, end - 1)), list(range(1, end + 1))
        rank_of, merged = self.ranks.get, self.merged
        heap = []  # rank and place in one number: the order is by rank, then from the left
        for i in range(end - 1):
            rank = rank_of(symbols[i] << PAIR | symbols[i + 1])
            if rank is not None:
                heap.append(rank << PLACE | i)
        heapify(heap)
        while heap:
            entry = heappop(heap)
            rank, i = entry >> PLACE, entry & PLACE_MASK
            j = after[i]
            if symbols[i] < 0 or j == end or rank_of(symbols[i] << PAIR | symbols[j]) != rank:
                continue  # stale: one of the two has been merged since
            new = symbols[i] = merged[rank]
            symbols[j] = -1
            after[i] = k = after[j]
            if k < end:
                before[k] = i
                rank = rank_of(new << PAIR | symbols[k])
                if rank is not None:
                    heappush(heap, rank << PLACE | i)
            h = before[i]
            if h >= 0:
                rank = rank_of(symbols[h] << PAIR | new)
                if rank is not None:
                    heappush(heap, rank << PLACE | h)
        return packed([s for s in symbols if s >= 0])

    def encode(self, text):
        """The ids of a text as little-endian unsigned 32-bit integers."""
        ids = self.known.__getitem__
        if not self.cut or not any(token in text for token in self.special):
            return b"".join(map(ids, self.words.findall(text)))
        parts = []
        for part in self.cut.split(text):
            if part in self.special:
                parts.append(packed([self.special[part]]))
            else:
                parts.extend(map(ids, self.words.findall(part)))
        return b"".join(parts)

    def decode(self, ids):
        """The text of packed ids; bytes that are not UTF-8 become replacement characters."""
        return b"".join(map(self.strings.__getitem__, unpacked(ids))).decode("utf-8", "replace")


def packed(ids):
    values = array("I", ids)
    if values.itemsize != 4 or not LITTLE_ENDIAN:
        return b"".join(int(i).to_bytes(4, "little") for i in values)
    return values.tobytes()


def unpacked(ids):
    if not LITTLE_ENDIAN:
        return [int.from_bytes(ids[i:i + 4], "little") for i in range(0, len(ids), 4)]
    values = array("I")
    values.frombytes(ids)
    return values


LITTLE_ENDIAN = array("H", [1]).tobytes() == b"\x01\x00"


def broadcast_model(spark, path):
    return spark.sparkContext.broadcast(BytePairModel(path))


def encode_documents(docs, path):
    """doc_id and `ids`, the token ids as little-endian unsigned 32-bit integers.

    Null texts count as empty and have no ids. A special token's string in a text becomes
    that token. Every row of the input gives one row, repeated rows too; an empty table gives
    none. Texts of any length are encoded whole. A tokenizer file that asks for more than
    byte-level pairs is refused.
    """
    return _mapped(docs, path, "doc_id long, ids binary", lambda model, text: (model.encode(text),))


def round_trip(docs, path):
    """As `encode_documents`, with `decoded`, the text that the ids give back (null text: empty)."""

    def both(model, text):
        ids = model.encode(text)
        return ids, model.decode(ids)

    return _mapped(docs, path, "doc_id long, ids binary, decoded string", both)


def token_digests(docs, path):
    """As `round_trip`: doc_id, n_tokens, ids, and the SHA-256 of the ids and of the decoded text."""
    return round_trip(docs, path).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def decode_documents(encoded, path):
    """doc_id and `decoded` from doc_id and `ids`; null ids give an empty text."""
    shared = broadcast_model(encoded.sparkSession, path)

    def run(batches):
        import pyarrow as pa

        for batch in small(batches):
            texts = [shared.value.decode(i or b"") for i in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "decoded"])

    picked = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids")
    return picked.mapInArrow(run, "doc_id long, decoded string")


def _mapped(docs, path, schema, each):
    shared = broadcast_model(docs.sparkSession, path)
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches):
        import pyarrow as pa

        model = shared.value
        kinds = {"ids": pa.binary(), "decoded": pa.string()}
        for batch in small(batches):
            rows = [each(model, text) for text in batch.column(1).to_pylist()]
            columns = [pa.array(c, kinds[n]) for n, c in zip(names[1:], zip(*rows))]
            yield pa.record_batch([batch.column(0), *columns], names)

    return documents(docs).mapInArrow(run, schema)
