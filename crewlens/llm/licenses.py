"""License scans: template markup compiled to token automata.

A template is license wording with optional and replaceable regions:

    <<optional>> ... <</optional>>   words that may be left out (may be nested)
    <<any:n>>                        any up to n words, such as a holder's name

Compiling gives an automaton over words. It accepts a stretch of text only if all mandatory words
stand there, in order and exactly; nothing is fuzzy. Every template is tried at every place of a
text where it can begin, and the longest accepted stretch counts. TEMPLATES are phrases and grants by
which texts name a license; WHOLE_LICENSES, under labels of their own, are met only by a text that has
every clause and the disclaimer unchanged.

Defined cases: a null or empty text has no words and no matches; repeated rows are scanned alike;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewlens.llm.shared import whole

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: The same words in a text that is not lower-cased yet, as a Java pattern.
WORD_ANY_CASE = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_MARK = re.compile(r"<<(optional|/optional|any:(\d+))>>")

# Base phrases and their labels.
BASE_PHRASES = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]

# License notices and grants in common use.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 <<optional>>(the \"License\")<</optional>>"),
    ("apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("mit", "Released under the <<optional>>terms of the<</optional>> MIT License"),
    ("mit", "Licensed under the <<optional>>terms of the<</optional>> MIT License"),
    ("mit", "SPDX-License-Identifier: MIT"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
        " and associated documentation files (the \"Software\"), to deal in the Software without"
        " restriction, including without limitation the rights to use, copy, modify, merge, publish,"
        " distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom"
        " the Software is furnished to do so, subject to the following conditions"
        " <<optional>>The above copyright notice and this permission notice"
        " <<optional>>(including the next paragraph)<</optional>> shall be included in all copies or"
        " substantial portions of the Software<</optional>>",
    ),
    (
        "gpl-3.0",
        "licensed under the <<optional>>terms of the<</optional>> GNU General Public License"
        " <<optional>>as published by the Free Software Foundation<</optional>> version 3"
        " <<optional>>or any later version<</optional>>",
    ),
    (
        "gpl-2.0",
        "licensed under the <<optional>>terms of the<</optional>> GNU General Public License"
        " <<optional>>as published by the Free Software Foundation<</optional>> version 2"
        " <<optional>>or any later version<</optional>>",
    ),
    (
        "gpl-or-later",
        "redistribute it and/or modify it under the terms of the GNU <<any:1>> General Public License"
        " as published by the Free Software Foundation, either version <<any:1>> of the License, or"
        " (at your option) any later version",
    ),
    ("cc-by-4.0", "Licensed under <<optional>>a<</optional>> CC BY 4.0 <<optional>>license<</optional>>"),
    ("cc-by-nc-4.0", "Licensed under <<optional>>a<</optional>> CC BY-NC 4.0 <<optional>>license<</optional>>"),
    ("cc-by-sa-4.0", "Licensed under <<optional>>a<</optional>> CC BY-SA 4.0 <<optional>>license<</optional>>"),
    (
        "cc-by-4.0",
        "licensed under a Creative Commons Attribution 4.0 <<optional>>International<</optional>> License",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted"
        " provided that the following conditions are met",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without"
        " fee is hereby granted, provided that the above copyright notice and this permission notice"
        " appear in all copies",
    ),
    ("all-rights-reserved", "Copyright <<optional>>c<</optional>> <<any:12>> All rights reserved"),
]

# Whole licenses and notices in common use, with what their users may leave out or replace.
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted"
    " provided that the following conditions are met:"
    " <<optional>>1.<</optional>> Redistributions of source code must retain the above copyright notice,"
    " this list of conditions and the following disclaimer."
    " <<optional>>2.<</optional>> Redistributions in binary form must reproduce the above copyright notice,"
    " this list of conditions and the following disclaimer in the documentation and/or other materials"
    " provided with the distribution."
)
_BSD_NO_ENDORSEMENT = (
    " <<optional>>3.<</optional>> Neither the name of <<any:20>> nor the names of its contributors may be used"
    " to endorse or promote products derived from this software without specific prior written permission."
)
_BSD_DISCLAIMER = (
    " THIS SOFTWARE IS PROVIDED BY <<any:12>> \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT"
    " NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE"
    " DISCLAIMED. IN NO EVENT SHALL <<any:12>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,"
    " EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR"
    " SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF"
    " LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN"
    " ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE"
)
_GPL_NOTICE = (
    "free software: you can redistribute it and/or modify it under the terms"
    " of the GNU General Public License as published by the Free Software Foundation,"
    " either version {version} of the License, or (at your option) any later version."
    " <<any:8>> is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the"
    " implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License"
    " for more details. <<optional>>You should have received a copy of the GNU General Public License along with"
    " <<any:8>> if not, see <<any:1>> www.gnu.org/licenses<</optional>>"
)
WHOLE_LICENSES = [
    (
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the \"Software\"), to deal in the Software without restriction,"
        " including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,"
        " and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,"
        " subject to the following conditions: The above copyright notice and this permission notice"
        " <<optional>>(including the next paragraph)<</optional>> shall be included in all copies or substantial"
        " portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR"
        " IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE"
        " AND NONINFRINGEMENT. IN NO EVENT SHALL <<any:12>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,"
        " WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE"
        " SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    ),
    ("bsd-2-clause", _BSD_HEAD + _BSD_DISCLAIMER),
    ("bsd-3-clause", _BSD_HEAD + _BSD_NO_ENDORSEMENT + _BSD_DISCLAIMER),
    (
        "isc-text",
        "Permission to use, copy, modify, and<<optional>>/or<</optional>> distribute this software for any purpose"
        " with or without fee is hereby granted, provided that the above copyright notice and this permission notice"
        " appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND <<any:12>> DISCLAIMS ALL WARRANTIES WITH"
        " REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL"
        " <<any:12>> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER"
        " RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS"
        " ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE",
    ),
    (
        "apache-2.0-notice",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use <<any:2>> except in"
        " compliance with the License. You may obtain a copy of the License at <<any:1>> www.apache.org/licenses/LICENSE-2.0"
        " <<optional>>.html<</optional>> Unless required by applicable law or agreed to in writing, software distributed"
        " under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either"
        " express or implied. See the License for the specific language governing permissions and limitations under"
        " the License",
    ),
    ("gpl-3.0-or-later-notice", _GPL_NOTICE.format(version=3)),
    ("gpl-2.0-or-later-notice", _GPL_NOTICE.format(version=2)),
]


def words_of(text: str | None) -> list[str]:
    """The words of a whole text, with A-Z lower-cased."""
    return WORD.findall((text or "").translate(_TO_LOWER))


@dataclass(frozen=True)
class Automaton:
    """A template as states; state `accept` is the last. A skip needs no word, `any` takes any."""

    label: str
    kind: str
    steps: tuple[dict[str, int], ...]
    any_step: tuple[int, ...]
    skips: tuple[tuple[int, ...], ...]
    accept: int
    mandatory: tuple[str, ...]

    def closure(self, states: set[int]) -> set[int]:
        todo, found = list(states), set(states)
        while todo:
            for to in self.skips[todo.pop()]:
                if to not in found:
                    found.add(to)
                    todo.append(to)
        return found

    def first_words(self) -> set[str]:
        return {word for state in self.closure({0}) for word in self.steps[state]}

    def longest(self, words: list[str], at: int) -> int:
        """Words of the longest accepted stretch from `at`; 0 if there is none."""
        states, best, place = self.closure({0}), 0, at
        while states and place < len(words):
            word = words[place]
            reached = {self.steps[s][word] for s in states if word in self.steps[s]}
            reached |= {self.any_step[s] for s in states if self.any_step[s] >= 0}
            states = self.closure(reached)
            place += 1
            if self.accept in states:
                best = place - at
        return best


def compile_template(label: str, markup: str, kind: str = "template") -> Automaton:
    steps: list[dict[str, int]] = [{}]
    any_step, skips, open_at, mandatory = [-1], [[]], [], []

    def add_state() -> int:
        steps.append({})
        any_step.append(-1)
        skips.append([])
        return len(steps) - 1

    def add_words(text: str) -> None:
        for word in words_of(text):
            steps[-1][word] = len(steps)
            add_state()
            if not open_at:
                mandatory.append(word)

    place = 0
    for mark in _MARK.finditer(markup):
        add_words(markup[place : mark.start()])
        place = mark.end()
        if mark[1] == "optional":
            skips[-1].append(add_state())  # a state of its own, so that nothing else shares the skip
            open_at.append(len(steps) - 2)
        elif mark[1] == "/optional":
            start, end = open_at.pop(), len(steps) - 1
            skips[end].append(add_state())
            skips[start].append(len(steps) - 1)
        else:
            start = len(steps) - 1
            inner = [start]
            for _ in range(int(mark[2])):
                any_step[-1] = len(steps)
                inner.append(add_state())
            end = add_state()
            for state in inner:
                skips[state].append(end)
    add_words(markup[place:])
    if open_at or not mandatory:
        raise ValueError(f"template of {label}: open optional region or no mandatory word")
    return Automaton(
        label, kind, tuple(steps), tuple(any_step), tuple(map(tuple, skips)), len(steps) - 1, tuple(mandatory)
    )


class Scanner:
    """All templates at once. A text is split into words only if it holds some template's anchor,
    the longest mandatory word."""

    def __init__(self, automata: list[Automaton]):
        self.by_first: dict[str, list[Automaton]] = {}
        for automaton in automata:
            for word in automaton.first_words():
                self.by_first.setdefault(word, []).append(automaton)
        longest = {max(a.mandatory, key=lambda w: (len(w), w)) for a in automata}
        self.anchors = [w for w in longest if not any(v != w and v in w for v in longest)]
        self.rare = [re.compile(rf"(?<![^\x00-\x2F\x3A-\x60\x7B-\x7F]){re.escape(w)}(?![^\x00-\x2F\x3A-\x60\x7B-\x7F])") for w in self.anchors if len(w) < 4]
        self.anchors = [w for w in self.anchors if len(w) >= 4]

    def scan(self, text: str | None) -> list[tuple[str, str, int, int, int]]:
        """(label, kind, first word, words, mandatory words) of every match, by place."""
        text = text or ""
        low = text.lower() if text.isascii() else text.translate(_TO_LOWER)
        if not any(w in low for w in self.anchors) and not any(r.search(low) for r in self.rare):
            return []
        words, found = WORD.findall(low), []
        by_first = self.by_first
        for at, word in enumerate(words):
            if word in by_first:
                for automaton in by_first[word]:
                    if n := automaton.longest(words, at):
                        found.append((automaton.label, automaton.kind, at, n, len(automaton.mandatory)))
        return found


def scanner(
    templates: list[tuple[str, str]] | None = None, phrases: list[tuple[str, str]] | None = None
) -> Scanner:
    """Phrases are templates without optional regions, told apart by their kind."""
    templates = TEMPLATES + WHOLE_LICENSES if templates is None else templates
    phrases = BASE_PHRASES if phrases is None else phrases
    return Scanner(
        [compile_template(label, markup) for label, markup in templates]
        + [compile_template(label, markup, "phrase") for label, markup in phrases]
    )


MATCH = "struct<label:string,kind:string,first:int,n_words:int,mandatory:int>"
_ARROW_MATCH = pa.struct(
    [("label", pa.string()), ("kind", pa.string()), ("first", pa.int32()), ("n_words", pa.int32()), ("mandatory", pa.int32())]
)


def scan_licenses(
    docs: DataFrame,
    templates: list[tuple[str, str]] | None = None,
    phrases: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """doc_id, n_words and every match of a template or phrase, in order of place."""
    names = ("label", "kind", "first", "n_words", "mandatory")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(templates, phrases).scan
        for batch in batches:
            found = [[dict(zip(names, m)) for m in scan(t.as_py())] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), pa.array(found, pa.list_(_ARROW_MATCH))],
                ["doc_id", "n_words", "matches"],
            )

    words = F.regexp_count(whole(F.col("text")), F.lit(WORD_ANY_CASE)).cast("long")
    rows = docs.select("doc_id", words.alias("n_words"), "text")
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, matches array<{MATCH}>")


def summarise(matches: DataFrame) -> DataFrame:
    """Counts, places and labels of each document's matches, with a score.

    The score grows with the longest mandatory wording that was met: m words give 1 - 1 / (1 + m).
    """
    base = F.filter("matches", lambda m: m["kind"] == "phrase")

    def labels(of: Column) -> Column:
        return F.array_join(F.sort_array(F.array_distinct(F.transform(of, lambda m: m["label"]))), ",")

    most = F.array_max(F.transform("matches", lambda m: m["mandatory"]))
    return matches.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda m: m["first"])).cast("long").alias("first_word"),
        F.array_max(F.transform(base, lambda m: m["first"])).cast("long").alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("matches")).alias("labels"),
        F.coalesce(1 - 1 / (1 + most), F.lit(0.0)).alias("score"),
    )
