"""Fill-in-the-middle: texts cut into prefix, middle and suffix at token bounds, with the
middle moved to the end behind markers.

Each character of a text gets one of four classes; those that end a token are two of them.
A wavelet matrix over the classes counts them: the ranks of both classes add up to the tokens
that end in a prefix of the text, and bisection on these counts finds both cuts.
"""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from marketpulse.llm.common import documents, small
from marketpulse.llm.wavelet import WaveletMatrix

# The markers, and the forms (prefix or suffix first, the middle at the end).
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
# Character classes. A token is a word with the white space before it, or white space at the
# end of the text.
IN_WORD, WHITE, END_OF_WORD, END_OF_WHITE = range(4)
ENDS = (END_OF_WORD, END_OF_WHITE)


def classes(text):
    """The class of each code point."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    white = (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))
    ends = np.append(white[1:], True) & ~white
    if len(white):
        ends[-1] = True
    return white.astype(np.uint8) * WHITE + ends * np.uint8(END_OF_WORD)


class Tokens:
    """The tokens of a text: how many there are, and where a number of them ends."""

    def __init__(self, text):
        self.matrix = WaveletMatrix(classes(text), 2)
        self.count = self.ended_by(len(text))

    def ended_by(self, place):
        return sum(self.matrix.rank(end, place) for end in ENDS)

    def end_of(self, count):
        return self.matrix.place_of(ENDS, count) if count else 0


def draws(seed, doc_id):
    """Four numbers that the seed and the id decide; a null id counts as an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def rearranged(doc_id, text, seed=42, percent=50, suffix_first=80):
    """(tokens, form, characters of prefix and of middle, output) of one text."""
    tokens = Tokens(text)
    first, second, whether, which = draws(seed, doc_id)
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or whether % 100 >= percent:
        return tokens.count, PLAIN, None, None, text
    start, stop = (tokens.end_of(n) for n in sorted(x % (tokens.count + 1) for x in (first, second)))
    prefix, middle, suffix = text[:start], text[start:stop], text[stop:]
    if which % 100 < suffix_first:
        form, output = SPM, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    else:
        form, output = PSM, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle
    return tokens.count, form, start, stop - start, output


RESULT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def fill_in_middle(docs, seed=42, percent=50, suffix_first=80):
    """One row per document: doc_id, n (tokens of the text), form (`plain`, `psm` or `spm`),
    prefix_chars and middle_chars (code points; null if plain) and output, the training text.

    `percent` of the documents are cut, `suffix_first` percent of these with the suffix in
    front. `seed` and doc_id alone decide, so repeated rows and texts of one id are cut at the
    same draws; a null id draws as an empty one. Null and empty texts give an empty plain
    output; texts that hold a marker stay plain too. A text of white space is one token. Texts are worked on whole, with some ten bytes a character; an empty table gives
    no rows. Rows stay in their tasks: nothing is shuffled.
    """

    def run(batches):
        import pyarrow as pa

        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        names = [field.split()[0] for field in RESULT.split(", ")]
        for batch in small(batches):
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            out = [(d, *rearranged(d, t, seed, percent, suffix_first)) for d, t in rows]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return documents(docs).mapInArrow(run, RESULT)


def restored(output, form):
    """The text from its output and form. Only the markers put in can match: those texts
    that hold one stay plain."""
    head, middle = F.substring_index(output, MIDDLE, 1), F.substring_index(output, MIDDLE, -1)

    def parted(by):
        first = F.substring_index(head, by, 1)
        return F.substr(first, F.lit(len(PREFIX) + 1)), F.substring_index(head, by, -1)

    prefix, suffix = parted(SUFFIX)
    late_suffix, late_prefix = parted(PREFIX)
    return (
        F.when(form == PSM, F.concat(prefix, middle, suffix))
        .when(form == SPM, F.concat(late_prefix, middle, late_suffix)).otherwise(output)
    )
