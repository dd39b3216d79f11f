"""License notices in texts, found by patience alignment with templates."""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.license_texts import TEXTS

#: Notices as their licenses ask for them; a template is any text, by any name.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "Apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'
        " You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in"
        ' writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,'
        " either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "GPL-3.0-or-later header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published"
        " by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in"
        " the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A"
        " PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the"
        ' "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,'
        " distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to"
        " the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions"
        " of the Software."
    ),
    "ISC text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the"
        " above copyright notice and this permission notice appear in all copies."
    ),
    "MIT notice": "Licensed under the MIT License.",
    "MIT tag": "SPDX-License-Identifier: MIT",
    "Apache-2.0 tag": "SPDX-License-Identifier: Apache-2.0",
    "GPL-3.0 tag": "SPDX-License-Identifier: GPL-3.0",
    "Apache-2.0 short": "Licensed under Apache 2.0.",
    "GPL-3.0 short": "Licensed under the GPLv3.",
    "Apache-2.0 notice": "Released under the Apache License 2.0.",
    "GPL-2.0 notice": "Licensed under the GNU General Public License, version 2.",
    "GPL-3.0 notice": "Licensed under the GNU GPL v3.",
    "LGPL-2.1 notice": "Licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0 notice": "Licensed under the GNU Lesser General Public License, version 3.",
    "BSD-2-Clause notice": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause notice": "Licensed under the BSD 3-Clause License.",
    "MPL-2.0 notice": "Licensed under the Mozilla Public License, version 2.0.",
    "CC0-1.0 notice": "Licensed under CC0 1.0 Universal.",
    "Unlicense notice": "Released into the public domain under the Unlicense.",
    **{
        f"CC-{short}-4.0 {kind}": f"{start} {short if 'CC' in start else long} 4.0{end}"
        for short, long in (
            ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC", "Attribution-NonCommercial"),
            ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        )
        for kind, start, end in (
            ("name", "Creative Commons", ""), ("code", "CC", ""), ("notice", "Licensed under CC", ""),
            ("sentence", "This work is licensed under a Creative Commons", " International License."),
        )
        if (short, kind) not in (("BY-NC", "notice"), ("BY", "sentence"), ("BY-SA", "sentence"))
    },
    **TEXTS,
}
#: A template of fewer words is a short notice: one word may be missing or changed, but none that is not listed here.
SHORT = 20
#: After a failed alignment a whole text is tried again half of its spare words further on, so that texts alike cost linear time.
LONG = 500
COMMON = frozenset(b"a and code distributed in international into is licence licensed license of released software terms the this under universal version work".split())
#: Bytes that belong to words: A-Z as a-z, digits, and all of non-ASCII letters.
_WORD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def license_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD).split()


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest chain of pairs, ascending in the first, that ascends in the second: patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        pile = bisect.bisect_left(tops, b)
        back.append(piles[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(b)
            piles.append(i)
        else:
            tops[pile], piles[pile] = b, i
    chain, i = [], piles[-1] if piles else -1
    while i >= 0:
        chain.append(pairs[i])
        i = back[i]
    return chain[::-1]


def align(text: Sequence[bytes], template: Sequence[bytes]) -> list[tuple[int, int]]:
    """Matched places (in text, in template), ascending in both.

    Words that occur once in either are anchors; the longest rising chain of anchors
    holds, and every gap between them, where other words may be unique, is aligned in
    the same way. A gap without anchors matches its common beginning and end.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        if a >= b or c >= d:
            continue
        here, there = Counter(text[a:b]), Counter(template[c:d])
        place = {w: i for i, w in enumerate(template[c:d], c) if there[w] == 1}
        chain = _rising([(i, place[w]) for i, w in enumerate(text[a:b], a) if w in place and here[w] == 1])
        if chain:
            out += chain
            edges = [(a - 1, c - 1), *chain, (b, d)]
            todo += [(x + 1, z, y + 1, w) for (x, y), (z, w) in zip(edges, edges[1:])]
            continue
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
    return sorted(out)


class Scanner:
    """Finds notices of which at least ``coverage`` of the words stand in a text, in order and close together.

    In a short notice one word may be missing or changed in any case, if its distinctive
    words, all but the ``COMMON`` ones, are there.
    """

    def __init__(self, templates: Mapping[str, str], coverage: float = 0.9) -> None:
        if len(templates) > 63:
            raise ValueError("a scanner holds 63 templates; use several for more")
        self.names = list(templates)
        self.words = [license_words(t) for t in templates.values()]
        short = [len(w) < SHORT for w in self.words]
        self.needed = [set(w) - COMMON if s else set() for w, s in zip(self.words, short)]
        self.least = [min(int(np.ceil(coverage * len(w) - 1e-9)), max(len(w) - s, 1)) for w, s in zip(self.words, short)]
        self.counts = [Counter(w) for w in self.words]
        self.reach = [len(w) + len(w) // 2 + 2 for w in self.words]
        self.of_word: dict[bytes, int] = {}
        for i, words in enumerate(self.words):
            for w in words:
                self.of_word[w] = self.of_word.get(w, 0) | 1 << i

    def _shared(self, k: int, have: Counter[bytes]) -> int:
        """How many words of a template an alignment can match at most."""
        return sum(min(n, have[w]) for w, n in self.counts[k].items() if w in have)

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """(template, coverage, first word, last word) of each notice; of two that overlap the one with more words.

        A stretch can hold a notice only if enough of its words are the template's, so
        stretches with fewer are passed over without loss.
        """
        words = license_words(text)
        get = self.of_word.get
        masks = np.fromiter((get(w, 0) for w in words), dtype=np.int64, count=len(words))
        found: list[tuple[int, str, float, int, int]] = []
        have = Counter(words)
        for k, template in enumerate(self.words):
            if len(words) < self.least[k] or not self.needed[k] <= have.keys() or self._shared(k, have) < self.least[k]:
                continue
            sums = np.r_[0, np.cumsum(masks >> k & 1)]
            stop = np.minimum(np.arange(len(words)) + self.reach[k], len(words))
            starts = np.flatnonzero((sums[stop] - sums[:-1] >= self.least[k]) & (masks >> k & 1 == 1))
            at = 0
            for start in starts.tolist():
                if start < at:
                    continue
                stretch = words[start : start + self.reach[k]]
                lacking = self.least[k] - self._shared(k, Counter(stretch))
                if lacking > 0:  # each later word brings one more at most
                    at = start + lacking
                    continue
                pairs = align(stretch, template)
                if len(pairs) < self.least[k] and len(stretch) > len(template):
                    # a second copy behind the first hides words that are unique in one
                    pairs = align(stretch[: len(template)], template)
                if len(pairs) >= self.least[k] and self.needed[k] <= {template[j] for _, j in pairs}:
                    first, last = start + pairs[0][0], start + pairs[-1][0]
                    found.append((len(pairs), self.names[k], len(pairs) / len(template), first, last))
                    at = last + 1
                elif len(template) >= LONG:
                    at = start + max(1, (len(template) - self.least[k]) // 2)
        kept: list[tuple[int, str, float, int, int]] = []
        for match in sorted(found, key=lambda m: (-m[0], m[3], m[1])):
            if all(match[3] > other[4] or match[4] < other[3] for other in kept):
                kept.append(match)
        return [m[1:] for m in sorted(kept, key=lambda m: m[3])]


def scanned(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, coverage: float = 0.9, text: str = "text", carry: Sequence[str] = ("*",)) -> DataFrame:
    """Columns ``carry`` of every row as struct ``row``, with ``found``: the notices in its whole text, in order.

    Each comes with the words that match (``matched``) and their share of the template.
    Null, empty and wordless texts hold none; repeated notices are found each. Words are
    runs of letters and digits, A-Z lower-cased, so punctuation and line breaks do not
    matter. No shuffle.
    """
    kind = "array<struct<license: string, coverage: double, first_word: long, last_word: long, matched: long>>"

    @F.pandas_udf(kind)
    def scan(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(templates, coverage)
        fields, sizes = ("license", "coverage", "first_word", "last_word"), dict(zip(scanner.names, map(len, scanner.words)))
        for texts in parts:
            found = [[dict(zip(fields, match), matched=round(match[1] * sizes[match[0]])) for match in scanner.scan(t or "")] for t in texts]
            yield pd.Series(found, dtype=object)

    return docs.select(F.struct(*carry).alias("row"), F.col(text).alias("body")).select("row", scan("body").alias("found"))
