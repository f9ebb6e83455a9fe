"""Finds license notices in texts by patience alignment with templates.

Words are lower-cased and stripped of punctuation. In a stretch of text and a template,
the words that occur once in both are anchors; the longest sequence of anchors in the
order of both is kept, and the gaps between them are aligned in the same way, down to
gaps without such words, where equal words at both ends count. Coverage is the share of
the template's words that are aligned; a match has at least ``COVERAGE``.

A text may hold a notice anywhere, more than once, and very long text around it, so words
would not be unique in the whole. Stretches are a little longer than the template and are
where most of its words meet: one pass over the text keeps, for each template, the number
of its words (each as often as it has it) in the last stretch. An alignment can't cover
more than that number. Between the matches so found, a second pass takes stretches of
``WIDE`` times the template, for notices that insertions spread; a match is no wider. One pass over the table,
no shuffle; every text is read whole.

Most words of a short notice do not name the license ('released under the ... license'), so
a template can have *names*: phrases that tell it from others and must stand in the text word
by word. The first stands once in the template; around each place of it in the text, what the
template has before and after it is aligned. Marks without a letter or digit (the ``#`` or
``//`` of a comment) are no words.

Defined cases: null and empty texts match nothing; ties between stretches go to the first;
repeated rows give repeated rows; a null id stays null; an empty table gives none; an empty template is an
error; other columns take no part.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import utf8

COVERAGE = 0.75
PUNCTUATION = b".,;:!?\"'()[]{}<>*_"
MARKS = PUNCTUATION + b"#/\\-=+|~`&%$@^"
REMEMBERED = 500_000
#: Words of a stretch of text whose matches are compared with each other.
CELL = 128
#: A match is looked for within so many times the template's words, in the text or on a side of a name.
WIDE = 4
#: Words of a template that is a text, not a notice.
LONG = 20

# The wording of common notices, headers and texts, by SPDX identifier. A suffix
# tells several of one license apart. Without one it is the short notice.
NOTICES = {
    "0BSD": ("Released under the {}.", "Zero-Clause BSD License"),
    "AGPL-3.0": ("This work is licensed under the {}.", "GNU Affero General Public License, version 3"),
    "Apache-1.1": ("Licensed under the {}.", "Apache License, Version 1.1"),
    "Apache-2.0": ("Licensed under the {}.", "Apache License, Version 2.0"),
    "Artistic-2.0": ("Licensed under the {}.", "Artistic License 2.0"),
    "BSD": ("Released under the {}.", "BSD License"),
    "BSD-2-Clause": ("Released under the {}.", "BSD 2-Clause License"),
    "BSD-2-Clause-named": ("Released under the {}.", "2-Clause BSD License"),
    "BSD-3-Clause": ("Released under the {}.", "BSD 3-Clause License"),
    "BSD-3-Clause-named": ("Released under the {}.", "3-Clause BSD License"),
    "BSL-1.0": ("Distributed under the {}.", "Boost Software License, Version 1.0"),
    "CC0-1.0": ("Released under {}.", "CC0 1.0"),
    "EPL-2.0": ("Made available under the terms of the {}.", "Eclipse Public License 2.0"),
    "GPL-2.0": ("This work is licensed under the {}.", "GNU General Public License, version 2"),
    "GPL-3.0": ("This work is licensed under the {}.", "GNU General Public License, version 3"),
    "ISC": ("Released under the {}.", "ISC License"),
    "LGPL-2.0": ("This work is licensed under the {}.", "GNU Library General Public License, version 2"),
    "LGPL-2.1": ("This work is licensed under the {}.", "GNU Lesser General Public License, version 2.1"),
    "LGPL-3.0": ("This work is licensed under the {}.", "GNU Lesser General Public License, version 3"),
    "MIT": ("Released under the {}.", "MIT License"),
    "MIT-0": ("Released under the {}.", "MIT No Attribution License"),
    "MPL-1.1": ("Subject to the {}.", "Mozilla Public License, Version 1.1"),
    "MPL-2.0": ("Subject to the terms of the {}.", "Mozilla Public License, Version 2.0"),
    "MPL-2.0-v": ("Subject to the terms of the {}.", "Mozilla Public License, v. 2.0"),
    "Unlicense": ("Released under {}.", "the Unlicense"),
    "WTFPL": ("Released under the {}.", "Do What The Fuck You Want To Public License"),
    "Zlib": ("Released under the {}.", "zlib License"),
}
GNU = {
    "GPL-2.0": ("GNU General Public License", "GPL", "2"),
    "GPL-3.0": ("GNU General Public License", "GPL", "3"),
    "LGPL-2.1": ("GNU Lesser General Public License", "LGPL", "2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License", "LGPL", "3"),
    "AGPL-3.0": ("GNU Affero General Public License", "AGPL", "3"),
}
for _id, (_title, _short, _v) in GNU.items():
    NOTICES[f"{_id}-named"] = ("Licensed under the {}.", f"{_title} v{_v if '.' in _v else _v + '.0'}")
    if "." not in _v:
        NOTICES[f"{_id}-v"] = ("Licensed under the {}.", f"{_title} v{_v}")
    NOTICES[f"{_id}-short"] = ("Licensed under the {}.", f"{_short} v{_v}")
    NOTICES[f"{_id}-joined"] = ("Licensed under the {}.", f"{_short}v{_v}")
CREATIVE = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC": "Attribution-NonCommercial",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
for _id, _title in CREATIVE.items():
    for _v in ("2.0", "2.5", "3.0", "4.0"):
        NOTICES[f"CC-{_id}-{_v}"] = ("Licensed under {}.", f"CC {_id} {_v}")
        NOTICES[f"CC-{_id}-{_v}-named"] = ("Licensed under a {} License.", f"Creative Commons {_title} {_v}")
TAGGED = (
    "0BSD AFL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSD-4-Clause "
    "BSL-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC-BY-NC-4.0 CC-BY-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-NC-ND-4.0 "
    "CC0-1.0 CDDL-1.0 EPL-1.0 EPL-2.0 EUPL-1.2 GPL-2.0 GPL-2.0+ GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0+ GPL-3.0-only "
    "GPL-3.0-or-later ISC LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later MIT MIT-0 "
    "MPL-1.1 MPL-2.0 OFL-1.1 PSF-2.0 Unlicense WTFPL Zlib"
).split()
MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without '
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
    "the Software, and to permit persons to whom the Software is furnished to do so"
)
BSD_TWO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution."
)
GNU_HEADER = (
    "This {it} is free software; you can redistribute it and/or modify it under the terms of the {title} as "
    "published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version. "
    "This {it} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {title} for more details."
)
ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
)
TEXTS = {
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "Apache-2.0-text": (
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
        "REPRODUCTION, AND DISTRIBUTION"
    ),
    "BSD-2-Clause-text": BSD_TWO,
    "BSD-3-Clause-text": (
        f"{BSD_TWO} Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission."
    ),
    "BSL-1.0-text": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        'accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, '
        "execute, and transmit the Software, and to prepare derivative works of the Software"
    ),
    "CC0-1.0-header": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights "
        "to this software to the public domain worldwide. This software is distributed without any warranty."
    ),
    "ISC-text": (
        f"{ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "0BSD-text": f'{ISC_GRANT}. THE SOFTWARE IS PROVIDED "AS IS"',
    "MIT-text": (
        f"{MIT_GRANT}, subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software."
    ),
    "MIT-0-text": f'{MIT_GRANT}. THE SOFTWARE IS PROVIDED "AS IS"',
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "MPL-2.0-text": "Mozilla Public License Version 2.0 1. Definitions 1.1.",
    "Unlicense-text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means."
    ),
    "Zlib-text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely"
    ),
}
# What tells a template from others; one without names needs coverage alone.
NAMES = {
    "Apache-2.0-header": ("Apache License, Version 2.0",),
    "Apache-2.0-text": ("Version 2.0, January 2004",),
    "BSD-3-Clause-text": ("Neither the name of",),
    "CC0-1.0-header": ("to the public domain worldwide",),
    "ISC-text": ("provided that the above copyright notice", "with or without fee"),
    "0BSD-text": ("is hereby granted the software is provided",),
    "MIT-0-text": ("to do so the software is provided",),
    "MPL-2.0-header": ("Mozilla Public License, v. 2.0",),
    "MPL-2.0-text": ("Mozilla Public License Version 2.0",),
}
for _id, (_title, _, _v) in GNU.items():
    for _k, _it in enumerate(("program", "library", "file"), 1):
        TEXTS[f"{_id}-header-{_k}"] = GNU_HEADER.format(it=_it, title=_title, v=_v)
        NAMES[f"{_id}-header-{_k}"] = (f"version {_v} of the License", _title)
    _year = {"2": "June 1991", "2.1": "February 1999", "3": "2007"}[_v]
    _day = {"GPL-3.0": "29 June ", "LGPL-3.0": "29 June ", "AGPL-3.0": "19 November "}.get(_id, "")
    TEXTS[f"{_id}-text"] = f"{_title} Version {_v}, {_day}{_year} Copyright (C) Free Software Foundation, Inc."
    NAMES[f"{_id}-text"] = (f"{_title} Version {_v}", f"Version {_v}, {_day}{_year}")
TEMPLATES = TEXTS | {name: notice.format(title) for name, (notice, title) in NOTICES.items()}
NAMES |= {name: (title,) for name, (_, title) in NOTICES.items()}
for _id in TAGGED:
    TEMPLATES[f"{_id}-tag"] = f"SPDX-License-Identifier: {_id}"
    NAMES[f"{_id}-tag"] = (f"SPDX-License-Identifier: {_id}",)


def words_of(text: bytes) -> list[bytes]:
    return [w.strip(PUNCTUATION) for w in text.lower().split() if w.strip(MARKS)]


def longest_increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence, by patience sorting."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, v in enumerate(values):
        pile = bisect_left(tops, v)
        back.append(at[pile - 1] if pile else -1)
        tops[pile : pile + 1] = [v]
        at[pile : pile + 1] = [k]
    chain = []
    k = at[-1] if at else -1
    while k >= 0:
        chain.append(k)
        k = back[k]
    return chain[::-1]


def align(text: list, template: list) -> list[tuple[int, int]]:
    """Aligned pairs (place in text, place in template), in order."""
    pairs: list[tuple[int, int]] = []
    work = [(0, len(text), 0, len(template))]
    while work:
        a, b, c, d = work.pop()
        while a < b and c < d and text[a] == template[c]:
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
        if a == b or c == d:
            continue
        here, there = Counter(text[a:b]), Counter(template[c:d])
        place = {w: k for k, w in enumerate(template[c:d], c) if there[w] == 1}
        once = [(k, place[w]) for k, w in enumerate(text[a:b], a) if here[w] == 1 and w in place]
        anchors = [once[k] for k in longest_increasing([t for _, t in once])]
        if not anchors:
            continue
        pairs += anchors
        for (i, j), (k, m) in zip([(a - 1, c - 1), *anchors], [*anchors, (b, d)], strict=True):
            work.append((i + 1, k, j + 1, m))
    return sorted(pairs)


def places_of(phrase: list, words: list) -> list[int]:
    return [k for k in range(len(words) - len(phrase) + 1) if words[k : k + len(phrase)] == phrase]


class Scanner:
    """Templates as numbers of words; 0 is any word that no template has, -1 a mark."""

    def __init__(self, templates: dict[str, str], coverage: float, names: dict[str, tuple[str, ...]] | None = None):
        texts = {name: words_of(t.encode()) for name, t in sorted(templates.items())}
        if not all(texts.values()):
            raise ValueError("a template has no words")
        vocabulary = {w: k for k, w in enumerate(sorted({w for t in texts.values() for w in t}), 1)}
        self.vocabulary, self.memo = vocabulary, {}
        self.templates = [
            (name, [vocabulary[w] for w in t], Counter(vocabulary[w] for w in t), -(-len(t) * round(coverage * 1000) // 1000))
            for name, t in texts.items()
        ]
        self.names, self.pivots = {}, {}
        for name, template, *_ in self.templates:
            phrases = [[vocabulary.get(w, 0) for w in words_of(p.encode())] for p in (names or {}).get(name, ())]
            if not all(p and places_of(p, template) for p in phrases) or len(phrases and places_of(phrases[0], template)) > 1:
                raise ValueError(f"names of {name} are not in its template, or the first is there twice")
            if phrases:
                self.names[name] = phrases
                self.pivots.setdefault(phrases[0][0], {}).setdefault(tuple(phrases[0]), []).append(name)

    def numbers(self, text: bytes) -> list[int]:
        memo, out = self.memo, []
        for w in text.lower().split():
            n = memo.get(w)
            if n is None:
                if len(memo) > REMEMBERED:
                    memo.clear()
                n = memo[w] = self.vocabulary.get(w.strip(PUNCTUATION), 0 if w.strip(MARKS) else -1)
            out.append(n)
        return out

    def stretches(self, hits: list[tuple[int, int]], counts: Counter, need: int, width: int) -> Iterator[int]:
        """Ends of stretches of ``width`` words where at least ``need`` of the template's meet.

        Of overlapping ones the first with most; the next begins after its end.
        """
        inside: deque[tuple[int, int]] = deque()
        have: Counter = Counter()
        score, best, best_k, k = 0, 0, -1, 0
        while k < len(hits) or best:
            if best and (k == len(hits) or hits[k][0] - hits[best_k][0] >= width):
                yield hits[best_k][0]
                # On from the word after the stretch, with nothing counted yet.
                inside.clear()
                have.clear()
                k, score, best = best_k + 1, 0, 0
                continue
            at, word = hits[k]
            while inside and at - inside[0][0] >= width:
                gone = inside.popleft()[1]
                have[gone] -= 1
                score -= have[gone] < counts[gone]
            inside.append((at, word))
            have[word] += 1
            score += have[word] <= counts[word]
            if score >= need and score > best:
                best, best_k = score, k
            k += 1

    def pivoted(self, numbers: list[int], hits: list[tuple[int, int]]) -> dict[str, list[int]]:
        """Places of the first names of templates."""
        found: dict[str, list[int]] = {}
        for k, n in hits:
            for phrase, names in self.pivots.get(n, {}).items():
                if tuple(numbers[k : k + len(phrase)]) == phrase:
                    for name in names:
                        found.setdefault(name, []).append(k)
        return found

    def around(self, numbers: list[int], template: list, names: list[list], places: list[int], need: int) -> Iterator[list]:
        """Alignments of a template with names, around the places of the first."""
        size = len(names[0])
        before = places_of(names[0], template)[0]
        after = before + size
        extra = len(template) // 4 + 4
        left, right = WIDE * before + extra, WIDE * (len(template) - after) + extra
        free = 0
        for at, prior, then in zip(places, [-size, *places], [*places[1:], len(numbers)], strict=False):
            low, high = max(free, at - left), at + size + right
            # Other places of the name most often belong to other notices.
            for a, b in ((max(low, prior + size), min(high, then)), (low, high)):
                pairs = align(numbers[a:at], template[:before])
                pairs = [(a + k, c) for k, c in pairs] + [(at + k, before + k) for k in range(size)]
                pairs += [(at + size + k, after + c) for k, c in align(numbers[at + size : b], template[after:])]
                if len(pairs) >= need and self.named(pairs, template, names):
                    yield pairs
                    free = pairs[-1][0] + 1
                    break

    def named(self, pairs: list[tuple[int, int]], template: list, names: list[list]) -> bool:
        """Whether each name is aligned word by word."""
        place = {c: k for k, c in pairs}
        return all(
            any(all(place.get(c + k, -1) == place.get(c, -2) + k for k in range(len(p))) for c in places_of(p, template))
            for p in names
        )

    def stretched(self, numbers: list[int], hits: list[tuple[int, int]], template: list, counts: Counter, need: int) -> Iterator[list]:
        """Alignments of a template in the stretches where its words meet."""
        own = [(k, n) for k, n in hits if n in counts]
        found: list[list] = []
        for width in (len(template) + len(template) // 4 + 4, WIDE * len(template) + 4):
            # What insertions spread is looked for between the matches that are not.
            ends = [0, *(k for m in found for k in (m[0][0], m[-1][0] + 1)), len(numbers)]
            for first, stop in zip(ends[::2], ends[1::2], strict=True):
                free, inside = first, [h for h in own if first <= h[0] < stop]
                for end in self.stretches(inside, counts, need, width):
                    # Words from before the notice may stand in for its last ones in the count.
                    low, high = max(free, end - width + 1), min(stop, end + 1 + 2 * width // 5)
                    for start in (low, max(low, self.tightest(inside, counts, low, end))):
                        pairs = align(numbers[start:high], template)
                        if len(pairs) >= need:
                            found.append([(start + k, c) for k, c in pairs])
                            free = start + pairs[-1][0] + 1
                            break
            found.sort()
        yield from found

    @staticmethod
    def tightest(hits: list[tuple[int, int]], counts: Counter, low: int, end: int) -> int:
        """Last start from which the words up to ``end`` still count as many as from ``low``."""
        have: Counter = Counter()
        start = end
        for k, n in reversed(hits[bisect_left(hits, (low, 0)) : bisect_left(hits, (end + 1, 0))]):
            have[n] += 1
            if have[n] <= counts[n]:
                start = k
        return start

    def scan(self, text: bytes) -> list[tuple[str, int, int, int, int]]:
        """(template, first word, last word, aligned words, template's words) of each match."""
        numbers = self.numbers(text)
        places = [k for k, n in enumerate(numbers) if n >= 0]
        numbers = [numbers[k] for k in places]
        hits = [(k, n) for k, n in enumerate(numbers) if n]
        total = Counter(n for _, n in hits)
        pivots = self.pivoted(numbers, hits)
        found = []
        for name, template, counts, need in self.templates:
            if name in self.names and name not in pivots:
                continue
            if sum(min(n, total[w]) for w, n in counts.items()) < need:
                continue
            if name in self.names:
                matches = self.around(numbers, template, self.names[name], pivots[name], need)
            else:
                matches = self.stretched(numbers, hits, template, counts, need)
            found += [(name, places[m[0][0]], places[m[-1][0]], len(m), len(template)) for m in matches]
        return self.fullest(found)

    @staticmethod
    def fullest(found: list[tuple[str, int, int, int, int]]) -> list[tuple[str, int, int, int, int]]:
        """Of matches with one wording the one with most words aligned: texts in one place, notices with one end."""

        def covers(o: tuple, m: tuple) -> bool:
            return 2 * (min(m[2], o[2]) - max(m[1], o[1]) + 1) > m[2] - m[1] + 1

        kept: set[tuple[str, int, int, int, int]] = set()
        ends: set[int] = set()
        # What covers more than half of a text covers its middle: the texts kept so far by place.
        cells: dict[int, list[tuple[str, int, int, int, int]]] = {}
        for m in sorted(found, key=lambda m: (-m[3], m[2] - m[1])):
            if m[4] < LONG:
                if m[2] in ends:
                    continue
                ends.add(m[2])
            else:
                middle = m[1] + (m[2] - m[1]) // 2
                if any(covers(o, m) for o in cells.get(middle // CELL, ())):
                    continue
                for cell in range(m[1] // CELL, m[2] // CELL + 1):
                    cells.setdefault(cell, []).append(m)
            kept.add(m)
        return [m for m in found if m in kept]


def license_scan(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    coverage: float = COVERAGE,
    names_of: dict[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """One row per match: doc_id, license, first_word, last_word, n_aligned, n_template."""
    given, phrases = (templates, names_of) if templates else (TEMPLATES, NAMES)
    names = ("doc_id", "license", "first_word", "last_word", "n_aligned", "n_template")
    schema = pa.schema([(n, pa.string() if n == "license" else pa.int64()) for n in names])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(given, coverage, phrases)
        for b in batches:
            rows = [
                (doc, *match)
                for doc, text in zip(b.column(0).to_pylist(), utf8(b.column(1)), strict=True)
                for match in scanner.scan(text)
            ]
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        scan, "doc_id long, license string, first_word long, last_word long, n_aligned long, n_template long"
    )
