"""License scans by patience alignment.

A text region and a license template are aligned on the words that are unique
in both: the longest increasing run of these anchors is taken, and the gaps
between them are aligned the same way after their common ends are matched.
The share of template words aligned is the coverage.

A match is a span in which the aligned words reach the least coverage, with at
most ``GAP`` other words between two neighbours, with every deciding word of the
template aligned and none of its barred words inside.  Deciding words tell a
template from its likes (the "3" of a GPL version), barred ones name another
license that holds the same words ("lesser").

The regions to align are found first.  A document is passed over for a template
if it lacks a deciding word, or so many distinct words that no alignment could
reach the least coverage.  Then, left to right: windows of about the template's
length that hold enough of its words, drawn out where the words they miss stand
further off; between the matches of those, the whole stretches over which the template's words follow each other without a larger
gap, however much longer than the template they are; and where a stretch gives
no match, as words that stand in it twice anchor nothing, its pieces around each
place of a word that a match cannot lack.  The scan is one pass over the
documents without a shuffle; the templates are a small parameter.

Defined results: null and empty texts match nothing; a license that stands
several times in a text matches several times; repeated rows each get a row;
templates without words are left out; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.text import small_slices, words_of

LEAST_COVERAGE = 0.8
SLACK = 1.25  # windows tried first are so much longer than their template
GAP = 16  # most other words between two aligned words of a match

#: Notices by which texts name their license (SPDX identifiers).
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied.""",
    "MIT": "Released under the MIT License.",
    "MIT-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions
        of the Software.""",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": """This program is free software: you can redistribute it and/or modify it under the terms of the
        GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at""",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}

#: Words that must be aligned, by license.
DECIDING = {
    "Apache-2.0": "apache 2",
    "Apache-2.0-header": "apache 2",
    "MIT": "mit",
    "GPL-3.0": "gnu 3",
    "GPL-3.0-header": "gnu 3",
    "MPL-2.0": "mozilla 2",
    "CC-BY-NC-4.0": "cc nc 4",
    "CC-BY-4.0": "attribution 4",
    "CC-BY-SA-4.0": "attribution sharealike 4",
}

#: Words that stand in the notices of another license with the same words.
BARRED = {
    "GPL-3.0": "lesser affero",
    "GPL-3.0-header": "lesser affero",
    "CC-BY-NC-4.0": "sa nd",
    "CC-BY-4.0": "sharealike noncommercial noderivatives noderivs",
    "CC-BY-SA-4.0": "noncommercial",
}


def longest_increasing(values: list[int]) -> list[int]:
    """Positions of a longest increasing subsequence (patience piles)."""
    tops: list[int] = []
    pile_of: list[int] = []
    before: list[int] = []
    for i, x in enumerate(values):
        k = bisect_left(tops, x)
        before.append(pile_of[k - 1] if k else -1)
        if k == len(tops):
            tops.append(x)
            pile_of.append(i)
        else:
            tops[k], pile_of[k] = x, i
    out, at = [], pile_of[-1] if pile_of else -1
    while at >= 0:
        out.append(at)
        at = before[at]
    return out[::-1]


def patience(text: list[int], template: list[int]) -> list[tuple[int, int]]:
    """Aligned position pairs of two code sequences; negative text codes match
    nothing.  Gaps are worked off a list, so long texts need no deep recursion."""
    pairs: list[tuple[int, int]] = []
    gaps = [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
        if a >= b or c >= d:
            continue
        here, there = Counter(text[a:b]), Counter(template[c:d])
        at = {template[k]: k for k in range(c, d) if there[template[k]] == 1}
        anchors = [(k, at[text[k]]) for k in range(a, b) if here[text[k]] == 1 and text[k] in at]
        chain = [anchors[k] for k in longest_increasing([y for _, y in anchors])]
        if not chain:
            continue
        pairs += chain
        edges = [(a - 1, c - 1), *chain, (b, d)]
        gaps += [(x + 1, x2, y + 1, y2) for (x, y), (x2, y2) in zip(edges, edges[1:], strict=False)]
    return sorted(pairs)


class LicenseScanner:
    def __init__(self, templates: Mapping[str, str], least: float = LEAST_COVERAGE, gap: int = GAP,
                 deciding: Mapping[str, str] = DECIDING, barred: Mapping[str, str] = BARRED):
        names = sorted(templates)
        words = words_of(pa.array([templates[n] for n in names] + [deciding.get(n, "") for n in names] + [barred.get(n, "") for n in names]))
        h = words.hashes()
        self.vocab = np.unique(h)
        codes = np.searchsorted(self.vocab, h)
        sets = [codes[words.first[i]:words.first[i + 1]].tolist() for i in range(3 * len(names))]
        chosen = [i for i in range(len(names)) if sets[i]]
        self.templates = [(names[i], sets[i]) for i in chosen]
        self.deciding = [set(sets[len(names) + i]) for i in chosen]
        self.barred = [set(sets[2 * len(names) + i]) for i in chosen]
        for (name, own), must in zip(self.templates, self.deciding, strict=True):
            if not must <= set(own):
                raise ValueError(f"a deciding word of {name} does not stand in its template")
        self.has = np.zeros((len(self.vocab), len(self.templates)), np.float32)
        self.must = np.zeros((len(self.vocab), len(self.templates)), np.float32)
        self.least, self.gap = least, gap
        self.spare = []
        for t, (_, own) in enumerate(self.templates):
            self.has[own, t] = 1
            self.must[list(self.deciding[t]), t] = 1
            # a missing distinct word costs its fewest uses, one: so many may be missing at most
            self.spare.append(int(np.floor((1 - least) * len(own) + 1e-9)))
        self.enough = self.has.sum(0) - np.array(self.spare)

    def scan(self, batch_words) -> list[list[tuple[str, float, int, int]]]:
        """Per text: ``(license, coverage, first word, last word + 1)``."""
        found: list[list[tuple[str, float, int, int]]] = [[] for _ in range(len(batch_words.first) - 1)]
        if not self.templates or not len(batch_words.start):
            return found
        h = batch_words.hashes()
        code = np.minimum(np.searchsorted(self.vocab, h), len(self.vocab) - 1)
        code = np.where(self.vocab[code] == h, code, -1)
        known = np.flatnonzero(code >= 0)
        text = np.searchsorted(batch_words.first, known, side="right") - 1
        present = np.zeros((len(found), len(self.vocab)), np.float32)
        present[text, code[known]] = 1
        able = (present @ self.has >= self.enough) & (present @ self.must >= self.must.sum(0))
        for i, t in np.argwhere(able).tolist():
            lo, hi = int(batch_words.first[i]), int(batch_words.first[i + 1])
            own = known[(known >= lo) & (known < hi)]
            own = own[self.has[code[own], t] > 0]
            found[i] += self.matches(code, own, lo, hi, t)
        return found

    def matches(self, code: np.ndarray, at: np.ndarray, lo: int, hi: int, t: int) -> list[tuple[str, float, int, int]]:
        """Matches of one template in one text, left to right; ``at`` are the
        positions of its words."""
        name, template = self.templates[t]
        spans = self.extended(code, at, list(self.regions(code, at, hi, t)), t)
        # what lies between them, cut where the template's words stop following each other
        edges = [(lo, lo), *[(a, b) for a, b, _ in spans], (hi, hi)]
        for (_, a), (b, _) in zip(edges, edges[1:], strict=False):
            part = at[np.searchsorted(at, a):np.searchsorted(at, b)]
            for stretch in np.split(part, np.flatnonzero(np.diff(part) > self.gap + 1) + 1):
                spans += self.stretch(code, stretch, t)
        return [(name, n / len(template), a - lo, b - lo) for a, b, n in sorted(spans)]

    def extended(self, code: np.ndarray, at: np.ndarray, spans: list[tuple[int, int, int]], t: int) -> list[tuple[int, int, int]]:
        """Matches of windows that miss words, with those that stand further off: as
        far as the template's words follow each other, up to the next matches."""
        whole, cuts = len(self.templates[t][1]), np.flatnonzero(np.diff(at) > self.gap + 1)
        starts, ends = at[np.r_[0, cuts + 1]] if len(at) else at, at[np.r_[cuts, -1]] + 1 if len(at) else at
        reach = whole * (self.gap + 1)  # no match is longer
        out, after = [], -1
        for k, (first, last, n) in enumerate(spans):
            if n < whole:
                own = np.searchsorted(starts, first, side="right") - 1
                before = spans[k + 1][0] if k + 1 < len(spans) else first + reach
                a, b = max(after, int(starts[own]), last - reach), min(before, int(ends[own]), first + reach)
                for x, y, m in self.aligned(code, a, b, t):
                    if x <= first and last <= y and m > n:
                        first, last, n = x, y, m
            out.append((first, last, n))
            after = last
        return out

    def aligned(self, code: np.ndarray, a: int, b: int, t: int) -> Iterator[tuple[int, int, int]]:
        """Spans ``(first, last + 1, aligned words)`` that fulfil all conditions in
        the alignment of the words from ``a`` to ``b``."""
        template = self.templates[t][1]
        own = set(template)
        pairs = patience([c if c in own else -1 for c in code[a:b].tolist()], template)
        start = 0
        for k in range(1, len(pairs) + 1):
            if k == len(pairs) or pairs[k][0] - pairs[k - 1][0] > self.gap + 1:
                run, start = pairs[start:k], k
                first, last = a + run[0][0], a + run[-1][0] + 1
                if (len(run) >= self.least * len(template) - 1e-9 and self.deciding[t] <= {template[y] for _, y in run}
                        and self.barred[t].isdisjoint(code[first:last].tolist())):
                    yield first, last, len(run)

    def stretch(self, code: np.ndarray, at: np.ndarray, t: int) -> list[tuple[int, int, int]]:
        """Matches in one stretch, given the positions of the template's words."""
        done, todo = [], [at]
        while todo:
            at = todo.pop()
            own, counts = np.unique(code[at], return_counts=True)
            if len(own) < self.enough[t] or not self.deciding[t] <= set(own.tolist()):
                continue
            a, b = int(at[0]), int(at[-1]) + 1
            spans = list(self.aligned(code, a, b, t)) or self.pieces(code, at, dict(zip(own.tolist(), counts.tolist(), strict=True)), t)
            done += spans
            if spans:
                edges = [(a, a), *[(x, y) for x, y, _ in spans], (b, b)]
                todo += [at[np.searchsorted(at, x):np.searchsorted(at, y)] for (_, x), (y, _) in zip(edges, edges[1:], strict=False)]
        return done

    def pieces(self, code: np.ndarray, at: np.ndarray, counts: dict[int, int], t: int) -> list[tuple[int, int, int]]:
        """Matches around single places of a word: a deciding one, or one of so many
        that a match holds at least one of them; the rarest are taken."""
        need = 1 if self.deciding[t] else self.spare[t] + 1
        rarest = sorted(self.deciding[t] or set(self.templates[t][1]), key=lambda c: (counts.get(c, 0), c))[:need]
        for word in rarest:
            if counts.get(word, 0) < 2:
                continue
            places = at[code[at] == word].tolist()
            spans, after = [], int(at[0])
            for before, here, behind in zip([after - 1, *places], places, [*places[1:], int(at[-1]) + 1], strict=False):
                if here >= after:
                    own = at[np.searchsorted(at, max(after, before + 1)):np.searchsorted(at, behind)]
                    found = list(self.aligned(code, int(own[0]), int(own[-1]) + 1, t))
                    spans += found
                    after = found[-1][1] if found else after
            if spans:
                return spans
        return []

    def regions(self, code: np.ndarray, at: np.ndarray, hi: int, t: int) -> Iterator[tuple[int, int, int]]:
        """Matches of one template in windows of about its length, left to right."""
        template = self.templates[t][1]
        length = int(np.ceil(SLACK * len(template))) + 2
        at, codes = at.tolist(), code[at].tolist()
        inside: Counter[int] = Counter()
        k, stop = 0, 0
        while k < len(at):
            while stop < len(at) and at[stop] < at[k] + length:
                inside[codes[stop]] += 1
                stop += 1
            step = k + 1
            if len(inside) >= self.enough[t]:
                # the best start is one where no later start of the same window aligns more
                for first, last, n in self.aligned(code, at[k], min(hi, at[k] + length), t):
                    if first == at[k]:
                        yield first, last, n
                        step = bisect_left(at, last)
                        break
            for j in range(k, min(step, stop)):
                inside[codes[j]] -= 1
                if not inside[codes[j]]:
                    del inside[codes[j]]
            k, stop = step, max(stop, step)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 templates: Mapping[str, str] = TEMPLATES, least: float = LEAST_COVERAGE, gap: int = GAP,
                 deciding: Mapping[str, str] = DECIDING, barred: Mapping[str, str] = BARRED) -> DataFrame:
    """``(id, n_matches, licenses, best_coverage, matches)`` per document;
    matches give the license, its coverage and the character span."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    match = "struct<license:string,coverage:double,start:bigint,end:bigint>"
    match_type = pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])
    templates, deciding, barred = dict(templates), dict(deciding), dict(barred)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = LicenseScanner(templates, least, gap, deciding, barred)
        for batch in small_slices(batches, "text", 1 << 20):
            words, out = words_of(batch.column("text")), []
            for i, own in enumerate(scanner.scan(words)):
                row = []
                if own:
                    raw, base, at = words.buf[words.at[i]:words.at[i + 1]].tobytes(), words.first[i], words.at[i]
                    for name, share, a, b in own:
                        s, e = int(words.start[base + a] - at), int(words.end[base + b - 1] - at)
                        start = len(raw[:s].decode())
                        row.append({"license": name, "coverage": share, "start": start, "end": start + len(raw[s:e].decode())})
                out.append(sorted(row, key=lambda m: (m["start"], m["license"])))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.list_(match_type))], ["id", "matches"])

    found = rows.mapInArrow(read, f"id {kind}, matches array<{match}>")
    return found.select(F.col("id").alias(id_col), F.size("matches").cast("long").alias("n_matches"),
                        F.array_join(F.array_sort(F.array_distinct(F.col("matches.license"))), ",").alias("licenses"),
                        F.coalesce(F.array_max(F.col("matches.coverage")), F.lit(0.0)).alias("best_coverage"), "matches")
