"""License scans by conditional compression: a block that repeats a template's wording needs
few bytes once the compressor has the template as its dictionary.

Templates are the customary notices, file headers, permission texts and one-line tags of
public licenses. A notice of the right wording in another version is reported without a name.
"""

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections import Counter

import zstandard
from pyspark.sql import functions as F

from marketpulse.llm.common import documents, small

# The customary short notices of public licenses, by SPDX identifier.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files, to deal in the Software without restriction."
    ),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license.",
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, "
        "are permitted provided that the following conditions are met."
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright to this work.",
    "all-rights-reserved": "All rights reserved.",
    # File headers.
    "GPL-2.0-or-later-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."
    ),
    "GPL-3.0-or-later-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "LGPL-2.1-or-later-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version."
    ),
    "LGPL-3.0-or-later-header": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."
    ),
    "AGPL-3.0-or-later-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."
    ),
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at"
    ),
    # Permission texts.
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "ISC-permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "BSD-2-Clause-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution."
    ),
    "BSD-3-Clause-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of "
        "its contributors may be used to endorse or promote products derived from this software without specific "
        "prior written permission."
    ),
    "Zlib-permission": (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and "
        "to alter it and redistribute it freely, subject to the following restrictions:"
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC0-1.0-waiver": (
        "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and "
        "related or neighboring rights to this work."
    ),
    # Short notices in words.
    "ISC": "Licensed under the ISC License.",
    "BSD-2-Clause": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause-name": "Licensed under the BSD 3-Clause License.",
    "Zlib": "Licensed under the zlib License.",
    "CC-BY-4.0-name": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-name": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    ),
}
# Identifiers that stand in one-line tags.
TAGGED = (
    "MIT ISC Apache-2.0 BSD-2-Clause BSD-3-Clause GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only "
    "GPL-3.0-or-later LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0 "
    "AGPL-3.0-only AGPL-3.0-or-later MPL-2.0 CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0 CC-BY-ND-4.0 Zlib Unlicense"
).split()
TEMPLATES |= {f"{name}-tag": f"SPDX-License-Identifier: {name}" for name in TAGGED}
# Words of which every notice has one.
CUES = r"(?i)licen[cs]|copyright|copyleft|permission|redistribut|all rights|public domain|\bcc[ -]?(?:by|0)"
# Words that name a license; a notice with other ones is not a changed copy.
NAMES = frozenset(
    "mit apache gnu gpl lgpl agpl lesser affero mozilla mpl bsd bsd-style cc by-sa by-nc by-nd by-nc-sa by-nc-nd "
    "documentation isc zlib attribution attribution-sharealike attribution-noncommercial attribution-noderivatives "
    "attribution-noncommercial-sharealike attribution-noncommercial-noderivatives cc0 2-clause 3-clause 4-clause".split()
) | frozenset(name.lower() for name in TAGGED)
# Numbers that name a version; those behind a full stop of a list are none.
VERSION = re.compile(r"v?(\d+(?:\.\d+)*)")
LISTED = frozenset("123")  # numbers of the conditions in a text
CACHED_BYTES = 8 << 20  # of blocks whose notices a worker remembers
LENGTHS = (28, 70)  # words of short and of middling templates; each kind has its own windows

WORDS = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")
CUE = re.compile(CUES)
RESULT = (
    "doc_id long, block int, license string, saved double, differences int, exact boolean, "
    "wording string, runner_up string"
)


def wording(text):
    """The words that count when notices are compared: case and punctuation do not."""
    return [w.lower() for w in WORDS.findall(text)]


def versions(words):
    """The version numbers among some words."""
    found = (VERSION.fullmatch(w) for w in words)
    numbers = [re.sub(r"(\.0)+$", "", f.group(1)) for f in found if f]
    return set(numbers) if len(numbers) < 2 else set(numbers) - LISTED


class Templates:
    """Compressors that have one template each as raw dictionary."""

    def __init__(self, texts, level=3):
        self.words = {name: wording(text) for name, text in texts.items()}
        self.counts = {name: Counter(words) for name, words in self.words.items()}
        forms = {name: " ".join(words).encode() for name, words in self.words.items()}
        self.plain = zstandard.ZstdCompressor(level=level, write_content_size=False)
        self.alone = {name: len(self.plain.compress(form)) for name, form in forms.items()}
        self.primed = {
            name: zstandard.ZstdCompressor(
                level=level, write_content_size=False,
                dict_data=zstandard.ZstdCompressionDict(form, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            )
            for name, form in forms.items()
        }
        kinds = {}
        for name, words in self.words.items():
            kinds.setdefault(sum(len(words) > most for most in LENGTHS), []).append(name)
        self.kinds = [names for _, names in sorted(kinds.items())]

    def reach(self, kind, most_differences):
        """Words that the longest notice of a kind can have, and one."""
        return 1 + int(max(len(self.words[n]) for n in self.kinds[kind]) * (1 + most_differences))

    def ranked(self, words, names=None):
        """(bytes saved by the template, the same as a share of the template's own compressed
        size, name), largest share first; of the named templates if names are given."""
        form = " ".join(words).encode()
        plain = len(self.plain.compress(form))
        gains = ((plain - len(self.primed[name].compress(form)), name) for name in names or self.primed)
        ordered = sorted(gains, key=lambda g: (-g[0] / self.alone[g[1]], g[1]))
        return [(saved, saved / self.alone[name], name) for saved, name in ordered]

    def same_names(self, words, name):
        """Whether the words have the license names of a template and no others."""
        return NAMES & set(words) == NAMES & set(self.words[name])

    def same_version(self, words, name):
        """Whether the words have the version numbers of a template, 2 and 2.0 being the same.
        A text with numbered conditions has none."""
        return versions(words) == versions(self.words[name])

    def differences(self, words, name):
        """(words to add, remove or change so that the block holds the template word for word,
        start and stop of the stretch that is closest to it). Words around it do not count."""
        template = self.words[name]
        above = [(0, j) for j in range(len(words) + 1)]  # (differences, start of the stretch)
        for i, expected in enumerate(template, 1):
            here = [(i, 0)]
            for j, word in enumerate(words, 1):
                (same, start), (skipped, before), (added, own) = above[j - 1], above[j], here[j - 1]
                here.append(min((same + (word != expected), -start), (skipped + 1, -before), (added + 1, -own)))
                here[j] = (here[j][0], -here[j][1])
            above = here
        stop = min(range(len(above)), key=lambda j: above[j][0])
        return above[stop][0], above[stop][1], stop


def blocks_of(text, window=30):
    """The words around each cue, `window` before and after, as (words, line of each word).
    Surroundings that overlap are one block; line breaks do not end one."""
    cues = [c.start() for c in CUE.finditer(text)]
    if not cues:
        return
    found = list(WORDS.finditer(text))
    starts = [w.start() for w in found]
    breaks = [i for i, letter in enumerate(text) if letter == "\n"]
    spans = []
    for cue in cues:
        at = bisect_right(starts, cue)
        a, b = max(0, at - window), min(len(found), at + window)
        if spans and a <= spans[-1][1]:
            spans[-1] = (spans[-1][0], b)
        else:
            spans.append((a, b))
    for a, b in spans:
        yield [w.group().lower() for w in found[a:b]], [bisect_left(breaks, s) for s in starts[a:b]]


def license_scan(docs, templates=None, least_saved=0.1, most_differences=0.4, tries=5):
    """One row per notice found: doc_id, block (line of its first word, from 0), license,
    saved, differences, exact, wording, runner_up.

    Candidate blocks are the words around cue words, in whole texts. They are searched in
    windows of bounded size: each is compressed alone and with every template as dictionary;
    all templates that save at least the share `least_saved` of their own compressed size are
    compared word by word, `tries` at a time until some confirm exactly. `saved` is that
    share. The one with the fewest differing words wins if these are at most
    `most_differences` of its words and none of them names a license; ties go to the longer
    template, then to the larger saving, then to the name. A notice with another version
    number, or without the template's, has a null `license`: `runner_up` is the template it is
    closest to. The words before and after a winner's stretch are searched again, so a block
    may hold several notices. `exact` means no difference. Null and empty texts and blocks
    without a winner give no row, and so does an empty table; repeated rows give repeated
    results. Texts of any length are searched in full.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dict(templates or TEMPLATES))

    def run(batches):
        import pyarrow as pa

        known = Templates(shared.value)
        judged, remembered = {}, 0
        kinds = [pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.int32(), pa.bool_(), pa.string(), pa.string()]
        names = [field.split()[0] for field in RESULT.split(", ")]
        for batch in small(batches):
            rows = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                for words, lines in blocks_of(text):
                    block = " ".join(words).encode()
                    key = hashlib.blake2b(block, digest_size=16).digest()
                    if key not in judged:
                        remembered += len(block)  # the wordings found are no longer than that
                        if remembered > CACHED_BYTES:
                            judged, remembered = {}, len(block)
                        judged[key] = list(notices(known, words, least_saved, most_differences, tries))
                    rows += [(doc_id, lines[start], *notice) for start, *notice in judged[key]]
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return cue_rows(docs).mapInArrow(run, RESULT)


def best_notice(known, words, kind, least_saved, most_differences, tries):
    """(differences, template's length and saved with a minus, license, start, stop,
    runner-up) of the best notice of a kind in some words, or None."""
    if not CUE.search(" ".join(words)):
        return None
    ranked = known.ranked(words, known.kinds[kind])
    best, other, held = None, None, Counter(words)
    for tried, (_, saved, name) in enumerate(ranked):
        if tried % tries == 0 and best and not best[0] and saved < 0.5:
            break
        size = len(known.words[name])
        most = most_differences * size
        if saved < least_saved or (known.counts[name] - held).total() > most:
            continue  # each word that is nowhere in the block is a difference
        differing, start, stop = known.differences(words, name)
        if differing > most or start >= stop or not known.same_names(words[start:stop], name):
            continue
        found = (differing, -size, -saved, name, start, stop)
        if any(known.same_version(words[start:end], name) for end in (stop, stop + 1)):
            best = min(best or (differing + 1,), found)
        else:
            other = min(other or (differing + 1,), found)
    if best:
        return *best, next((n for _, _, n in ranked if n != best[3]), None)
    if other:
        return *other[:3], "", *other[4:], other[3]


def in_window(known, words, low, high, kind, *rules):
    """The notices of a kind in a stretch of a block: the best one, and those in the words
    before and after it."""
    stretches = [(low, high)]
    while stretches:
        low, high = stretches.pop()
        best = best_notice(known, words[low:high], kind, *rules)
        if best:
            *rank, start, stop, second = best
            yield *rank, low + start, low + stop, second
            stretches += [(low, low + start), (low + stop, high)]


def notices(known, words, least_saved, most_differences, tries):
    """(first word, license, saved, differences, exact, wording, runner-up) of each notice in
    a block, in their order.

    A block is searched in windows twice as long as the longest notice of a kind can be, each
    half in the next window too, so that a notice is whole in one of them and what a template
    saves does not drown in the rest of a long block. Of notices that overlap the better one stays;
    what that leaves of the other's surroundings is searched again.
    """
    rules = (least_saved, most_differences, tries)
    reaches = [known.reach(kind, most_differences) for kind in range(len(known.kinds))]
    ranges = {
        (a, min(a + 2 * reach, len(words)), kind)
        for kind, reach in enumerate(reaches) for a in range(0, max(1, len(words) - reach), reach)
    }
    taken = []  # (start, stop, notice), in order
    while ranges:
        found = sorted({n[:6]: n for r in sorted(ranges) for n in in_window(known, words, *r, *rules)}.values())
        ranges, lost = set(), []
        for notice in found:
            start, stop = notice[4:6]
            at = bisect_left(taken, (start,))
            before, after = taken[at - 1][1] if at else 0, taken[at][0] if at < len(taken) else len(words)
            if before <= start and stop <= after:
                taken.insert(at, (start, stop, notice))
            elif not (at < len(taken) and taken[at][:2] == (start, stop)):
                lost.append((start, stop))
        for start, stop in lost:
            at = max(0, bisect_left(taken, (start,)) - 1)
            before = taken[at - 1][1] if at else 0
            while before < stop:
                after = taken[at][0] if at < len(taken) else len(words)
                if max(before, start) < min(after, stop):
                    ranges |= {
                        (max(before, start - reach), min(after, stop + reach), kind) for kind, reach in enumerate(reaches)
                    }
                if at == len(taken):
                    break
                before, at = taken[at][1], at + 1
    for start, stop, (differing, _, saved, name, _, _, second) in taken:
        exact = differing == 0 and bool(name)
        yield start, name or None, round(-saved, 6), differing, exact, " ".join(words[start:stop]), second


def cue_rows(docs):
    """Documents with a cue word anywhere; Spark drops the others before Python sees them."""
    return documents(docs).where(F.col("text").rlike(CUES))
