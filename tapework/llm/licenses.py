"""License scans with a generalised suffix automaton of license texts.

The automaton holds every run of words of every template. A file's words are streamed through it; at each word it
knows the longest run ending there that some template holds (matching statistics). Long runs are chained,
in template order, into spans that cover a template.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tapework.llm.common import made_from, worker_memo

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Phrases that give a label wherever their words stand together.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: The notices of well-known licenses, by label.
TEMPLATES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "apache": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program.",
    "lgpl": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}
#: Words of a run that counts as long; words that may lie between chained runs; share of a template that must be covered.
LONG, GAP, COVERED = 5, 12, 0.5


def words(text: str | None) -> list[str]:
    """Words of a text with A-Z lower-cased."""
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))


class Automaton:
    """Suffix automaton of several word sequences; every state knows where in the templates its runs end."""

    def __init__(self, sequences: list[list[str]]):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length, self.ends = [-1], [0], [set()]
        for k, sequence in enumerate(sequences):
            last = 0
            for i, word in enumerate(sequence):
                last = self._extend(last, word)
                self.ends[last].add((k, i + 1))
        # What ends a state's runs also ends the shorter runs behind its suffix link.
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            self.ends[self.link[state]] |= self.ends[state]
        self.words = {w for state in self.next for w in state}

    def _new(self, length: int, link: int, following: dict[str, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.next) - 1

    def _split(self, p: int, q: int, word: str) -> int:
        copy = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, word: str) -> int:
        if word in self.next[last]:
            q = self.next[last][word]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, word)
        new, p = self._new(self.length[last] + 1, 0, {}), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
        return new

    def statistics(self, run: list[str]) -> Iterator[tuple[int, int]]:
        """For each word: the state and length of the longest run ending there that a template holds."""
        state = matched = 0
        for word in run:
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state, matched = self.next[state][word], matched + 1
            yield state, matched


class Scanner:
    def __init__(self, templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES, long: int = LONG, gap: int = GAP, covered: float = COVERED):
        texts = [(label, words(text), False) for label, text in templates.items()] + [(label, words(text), True) for text, label in phrases.items()]
        self.labels, self.sequences, self.is_phrase = zip(*texts, strict=True)
        self.automaton = Automaton(list(self.sequences))
        self.long, self.gap, self.covered = long, gap, covered
        #: For each state: the phrases that a run ending there ends with.
        self.phrase_ends = [[k for k, i in ends if self.is_phrase[k] and i == len(self.sequences[k])] for ends in self.automaton.ends]

    def _phrases(self, state: int, matched: int) -> Iterator[int]:
        while state > 0:
            # A shorter run behind the link may be a phrase that no longer template contains.
            yield from (k for k in self.phrase_ends[state] if len(self.sequences[k]) <= matched and len(self.sequences[k]) > self.automaton.length[self.automaton.link[state]])
            state = self.automaton.link[state]
            matched = min(matched, self.automaton.length[state])

    def scan(self, text: str | None) -> dict:
        """n_words, places [(start, label)] of phrases, spans [(label, first word, last word, coverage)] of templates."""
        found, known = words(text), self.automaton.words
        places, runs = [], []
        inside = [w in known for w in found]
        at, n = 0, len(found)
        while at < n:
            try:
                at = inside.index(True, at)
            except ValueError:
                break
            try:
                end = inside.index(False, at)
            except ValueError:
                end = n
            if end - at > 1:
                before = (0, 0)
                for i, (state, matched) in enumerate(self.automaton.statistics(found[at:end])):
                    if matched > 1:
                        places += [(at + i + 1 - len(self.sequences[k]), self.labels[k]) for k in self._phrases(state, matched)]
                    if matched <= before[1] and before[1] >= self.long:
                        runs.append((at + i, *before))
                    before = (state, matched)
                if before[1] >= self.long:
                    runs.append((end, *before))
            at = end
        return {"n_words": n, "places": sorted(set(places)), "spans": self._chained(runs)}

    def _chained(self, runs: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
        """Runs (end, state, length) chained for each template in order of both texts, at most gap words apart.

        Of each template, every chain of the wanted coverage that overlaps no better one; where none has it, the best.
        """
        chains: dict[int, list[tuple[int, int, int, int]]] = {}  # template: (text end, template end, text start, covered)
        for end, state, length in runs:
            for k, template_end in sorted(self.automaton.ends[state]):
                if self.is_phrase[k]:
                    continue
                start, covered, own = end - length, length, chains.setdefault(k, [])
                # Ends ascend, so all runs that end inside the gap are the last ones.
                for at in range(len(own) - 1, -1, -1):
                    e, t, s, c = own[at]
                    if end - length - e > self.gap:
                        break
                    ahead, moved = end - e, template_end - t
                    if ahead > 0 and moved > 0 and c + min(length, ahead, moved) > covered:
                        start, covered = s, c + min(length, ahead, moved)
                own.append((end, template_end, start, covered))
        spans = []
        for k, own in chains.items():
            taken: list[tuple[int, int]] = []
            for end, _, start, covered in sorted(own, key=lambda x: (-x[3], x[0])):
                share = covered / len(self.sequences[k])
                if taken and share < self.covered:
                    break
                at = bisect_left(taken, (start, end))
                if (at == 0 or taken[at - 1][1] <= start) and (at == len(taken) or taken[at][0] >= end):
                    taken.insert(at, (start, end))
                    spans.append((self.labels[k], start, end - 1, min(share, 1.0)))
        return sorted(spans)


def scanned(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """docs' rows with places of phrases, template spans and labels.

    Null text is empty. A label is given for each phrase and each template covered by at least half; score is the largest coverage, 1 where a
    phrase stands. Repeated rows stay, other columns are ignored, an empty table gives none.
    """
    schema = "n_words long, places array<struct<start:long,label:string>>, spans array<struct<label:string,first:long,last:long,coverage:double>>, base_labels string, labels string, score double"
    place = pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))
    span = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("coverage", pa.float64())]))
    kinds = {"n_words": pa.int64(), "places": place, "spans": span, "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64()}

    def make(texts: list[str | None]) -> dict[str, pa.Array]:
        memo = worker_memo()
        known = ("licenses", tuple(sorted(templates.items())))
        scanner = memo.get(known) or memo.setdefault(known, Scanner(templates))
        rows = []
        for text in texts:
            x = scanner.scan(text)
            base = {label for _, label in x["places"]}
            more = {s[0] for s in x["spans"] if s[3] >= scanner.covered}
            score = 1.0 if base else max([0.0, *(s[3] for s in x["spans"])])
            rows.append((x["n_words"], [{"start": a, "label": b} for a, b in x["places"]], [dict(zip(("label", "first", "last", "coverage"), s, strict=True)) for s in x["spans"]], ",".join(sorted(base)), ",".join(sorted(base | more)), score))
        return {c: pa.array([r[k] for r in rows], kind) for k, (c, kind) in enumerate(kinds.items())}

    return made_from(docs.select(docs["doc_id"].cast("long"), "text"), "text", make, schema, keep=["doc_id"])


def license_report(docs: DataFrame) -> DataFrame:
    """The columns of op8 for documents (doc_id, text); null places where no phrase stands. Nulls, repeated rows and empty tables as in scanned."""
    from pyspark.sql import functions as F

    starts = F.transform("places", lambda p: p["start"])
    return scanned(docs).select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"), "base_labels", "labels", "score")
