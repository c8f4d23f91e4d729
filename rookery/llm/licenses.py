"""License scan by templates with optional and replaceable regions.

A template is wording with markup: ``[[ ... ]]`` may be absent, ``{a-b}``
stands for a to b words of any kind (a holder's name, a year).  All else must
stand word for word, in order.  Templates compile into one automaton over words.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.llm.tables import map_batches, quoted, row_of, utf8, with_row

#: Words are runs of digits, letters a-z and characters beyond ASCII, after A-Z are lowered.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256))


@dataclass(frozen=True)
class Template:
    """``weight`` says how surely the wording grants the license: a mention, an opening, a grant by name, the whole text.

    A ``grant`` by name is none where it is denied in the words before it.
    """

    label: str
    text: str
    weight: float
    base: bool = False
    grant: bool = False


MENTION, OPENING, NAMED, GRANT, WHOLE = 0.5, 0.6, 0.7, 0.8, 1.0

# Wording of public licenses and their notices, to the end of what is mandatory.
_MIT_GRANT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this {1-1} [[and associated "
    "documentation files]] [[the {1-1}]] to deal in the {1-1} without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the {1-1}"
)
_MIT_REST = (
    "and to permit persons to whom the {1-1} is furnished to do so subject to the following conditions the above "
    "copyright notice and this permission notice [[including the next paragraph]] shall be included in all copies or "
    "substantial portions of the {1-1} the {1-1} is provided as is without warranty of any kind express or implied "
    "including but not limited to the warranties of merchantability fitness for a particular purpose and "
    "noninfringement in no event shall the {1-8} be liable for any claim damages or other liability whether in an action of "
    "contract tort or otherwise arising from out of or in connection with the {1-1} or the use or other dealings in the {1-1} "
)
_BSD_GRANT = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met"
)
_BSD_TWO = (
    "[[1]] redistributions of source code must retain the above copyright notice this "
    "list of conditions and the following disclaimer [[2]] redistributions in binary form must reproduce the above "
    "copyright notice this list of conditions and the following disclaimer in the documentation and or other "
    "materials provided with the distribution"
)
_BSD_THREE = (
    "[[3]] neither the name of {1-12} nor the names of [[its]] {0-2} contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission"
)
_BSD_REST = (
    "this software is provided by {1-10} as is and any express or implied warranties including but not limited to the "
    "implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall {1-10} be "
    "liable for any direct indirect incidental special exemplary or consequential damages including but not limited to "
    "procurement of substitute goods or services loss of use data or profits or business interruption however caused and "
    "on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising "
    "in any way out of the use of this software even if advised of the possibility of such damage"
)
_ISC_GRANT = (
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted provided that the above copyright notice and this permission notice appear in all copies"
)
_ISC_REST = (
    "the software is provided as is and the {1-4} disclaims all warranties with regard to this software including all "
    "implied warranties of merchantability and fitness in no event shall the {1-4} be liable for any special direct "
    "indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an "
    "action of contract negligence or other tortious action arising out of or in connection with the use or performance "
    "of this software"
)
_APACHE_NOTICE = (
    "licensed under the apache license version 2 0 the license you may not use this {1-2} except in compliance with "
    "the license you may obtain a copy of the license at {1-10} unless required by applicable law or agreed to in writing "
    "software distributed under the license is distributed on an as is basis without warranties or conditions of any kind "
    "either express or implied see the license for the specific language governing permissions and limitations under the "
    "license"
)
_GPL_NOTICE = (
    "free software you can redistribute it and or modify it under the terms of the gnu {kind}general public license as "
    "published by the free software foundation either version {version} of the license or at your option any later version "
    "this {1-4} is distributed in the hope that it will be useful but without any warranty without even the implied "
    "warranty of merchantability or fitness for a particular purpose see the gnu {kind}general public license for more details"
)
_GPL_KINDS = (("gpl-2.0", "", "2"), ("gpl-3.0", "", "3"), ("lgpl-2.1", "lesser ", "2 1"), ("lgpl-3.0", "lesser ", "3"),
              ("agpl-3.0", "affero ", "3"))
_MPL_NOTICE = (
    "source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
    "distributed with this file you can obtain one at [[http]] [[https]] mozilla org mpl 2 0"
)
_UNLICENSE = (
    "free and unencumbered software released into the public domain anyone is free to copy modify publish use compile "
    "sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or "
    "non commercial and by any means"
)
_CC_NAMES = (
    ("cc-by-4.0", "creative commons attribution 4 0"),
    ("cc-by-sa-4.0", "creative commons attribution sharealike 4 0"),
    ("cc-by-sa-4.0", "creative commons attribution share alike 4 0"),
    ("cc-by-nc-4.0", "creative commons attribution noncommercial 4 0"),
    ("cc-by-nc-4.0", "creative commons attribution non commercial 4 0"),
    ("cc-by-nd-4.0", "creative commons attribution noderivatives 4 0"),
    ("cc-by-nd-4.0", "creative commons attribution no derivatives 4 0"),
    ("cc-by-nc-sa-4.0", "creative commons attribution noncommercial sharealike 4 0"),
    ("cc-by-nc-nd-4.0", "creative commons attribution noncommercial noderivatives 4 0"),
    ("cc0-1.0", "creative commons zero [[v]] 1 0"),
    ("cc0-1.0", "cc0 1 0 universal"),
)
_CC_GRANTS = ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd")
_GNU = "the gnu general public license [[as published by the free software foundation]] [[either]] [[version]]"
TEMPLATES = (
    Template("mit", "mit license", MENTION, base=True),
    Template("apache", "apache license", MENTION, base=True),
    Template("gpl", "general public license", MENTION, base=True),
    *(
        Template("mit", f"{verb} under [[the terms of]] the mit license", GRANT, grant=True)
        for verb in ("released", "licensed", "distributed")
    ),
    Template("apache-2.0", "licensed under [[the terms of]] the apache license [[version]] 2 0", GRANT, grant=True),
    *(Template(f"gpl-{n}.0", f"licensed under [[the terms of]] {_GNU} {n}", GRANT, grant=True) for n in (2, 3)),
    *(
        Template(
            f"cc-{kind.replace(' ', '-')}-4.0",
            f"licensed under [[the terms of]] [[a]] [[the]] [[creative commons]] cc {kind} 4 0",
            GRANT,
            grant=True,
        )
        for kind in _CC_GRANTS
    ),
    *(Template(label, name, NAMED) for label, name in _CC_NAMES),
    Template("mit-opening", _MIT_GRANT, OPENING),
    Template("bsd-opening", _BSD_GRANT, OPENING),
    Template("isc-opening", _ISC_GRANT, OPENING),
    Template("mit-text", f"{_MIT_GRANT} {_MIT_REST}", WHOLE),
    Template("isc-text", f"{_ISC_GRANT} {_ISC_REST}", WHOLE),
    Template("bsd-2-clause-text", f"{_BSD_GRANT} {_BSD_TWO} {_BSD_REST}", WHOLE),
    Template("bsd-3-clause-text", f"{_BSD_GRANT} {_BSD_TWO} {_BSD_THREE} {_BSD_REST}", WHOLE),
    Template("apache-2.0-notice", _APACHE_NOTICE, WHOLE),
    *(
        Template(f"{label}-notice", _GPL_NOTICE.replace("{kind}", kind).replace("{version}", version), WHOLE)
        for label, kind, version in _GPL_KINDS
    ),
    Template("mpl-2.0-notice", _MPL_NOTICE, WHOLE),
    Template("unlicense-text", _UNLICENSE, WHOLE),
)

#: Words that deny a grant, and how many words before it they may stand.
DENIALS = (b"not", b"never")
DENIED_BEFORE = 3

_MARKUP = re.compile(r"\[\[|\]\]|\{(\d+)-(\d+)\}|[^\s\[\]{}]+")


def parsed(text: str) -> list:
    """Parts of a template: words, (a, b) for replaceable words, lists for optional regions."""
    stack: list[list] = [[]]
    for found in _MARKUP.finditer(text):
        token = found[0]
        if token == "[[":
            stack.append([])
        elif token == "]]":
            region = stack.pop()
            stack[-1].append(region)
        elif found[1]:
            stack[-1].append((int(found[1]), int(found[2])))
        else:
            stack[-1].extend(w.decode() for w in token.encode().translate(FOLD).split())
    if len(stack) != 1:
        raise ValueError(f"unbalanced optional region in {text!r}")
    return stack[0]


class Automaton:
    """All templates at once: a nondeterministic automaton over words, made deterministic as texts need it."""

    def __init__(self, templates: tuple[Template, ...]):
        self.templates = templates
        # For each state: word (or None for any) and the state behind it; states reached without a word; template accepted.
        self.steps: list[list[tuple[str | None, int]]] = []
        self.free: list[list[int]] = []
        self.accepts: dict[int, int] = {}
        starts = []
        for number, template in enumerate(templates):
            first = self._state()
            self.accepts[self._chain(parsed(template.text), first)] = number
            starts.append(first)
        self.words = {w.encode(): w for steps in self.steps for w, _ in steps if w is not None}
        self.start = self._closed(starts)
        self.known: dict[tuple[frozenset, str | None], frozenset] = {}
        self.first_words = {w.encode() for s in self.start for w, _ in self.steps[s] if w is not None}
        if any(w is None for s in self.start for w, _ in self.steps[s]) or self.start & self.accepts.keys():
            raise ValueError("a template must start with a mandatory word or an optional region before one")

    def _state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def _chain(self, parts: list, state: int) -> int:
        for part in parts:
            if isinstance(part, str):
                after = self._state()
                self.steps[state].append((part, after))
            elif isinstance(part, tuple):
                least, most = part
                after = self._state()
                for k in range(most + 1):
                    if k >= least:
                        self.free[state].append(after)
                    if k < most:
                        nearer = self._state()
                        self.steps[state].append((None, nearer))
                        state = nearer
            else:
                after = self._chain(part, state)
                joined = self._state()
                self.free[after].append(joined)
                self.free[state].append(joined)
                after = joined
            state = after
        return state

    def _closed(self, states: Iterable[int]) -> frozenset[int]:
        found, waiting = set(), list(states)
        while waiting:
            state = waiting.pop()
            if state not in found:
                found.add(state)
                waiting.extend(self.free[state])
        return frozenset(found)

    def _next(self, states: frozenset[int], word: str | None) -> frozenset[int]:
        key = states, word
        if key not in self.known:
            self.known[key] = self._closed(
                after for s in states for w, after in self.steps[s] if w is None or w == word
            )
        return self.known[key]

    def matches(self, words: list[bytes]) -> list[tuple[int, int, int]]:
        """(template, start, end) of every accepted run of words, the shortest for each start; no denied grants."""
        found = []
        first = self.first_words
        known = self.words
        for start in [i for i, w in enumerate(words) if w in first]:
            states, at, seen = self.start, start, set()
            while states and at < len(words):
                states = self._next(states, known.get(words[at]))
                at += 1
                for number in {self.accepts[s] for s in states if s in self.accepts} - seen:
                    seen.add(number)
                    denied = self.templates[number].grant and not set(DENIALS).isdisjoint(
                        words[max(start - DENIED_BEFORE, 0) : start]
                    )
                    if not denied:
                        found.append((number, start, at))
        return found


@lru_cache(maxsize=4)
def automaton(templates: tuple[Template, ...]) -> Automaton:
    return Automaton(templates)


RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "matches array<struct<label: string, start: long, end: long, weight: double>>"
)


def scan_licenses(
    docs: DataFrame,
    templates: tuple[Template, ...] = TEMPLATES,
    keep: tuple[str, ...] | None = None,
    text_column: str = "text",
) -> DataFrame:
    """Licenses of every document: row (the columns of ``keep``, or all), counts, labels, score, matches.

    ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` tell of base
    phrases alone, all places; ``labels`` of all templates.  The score is the
    largest weight found, 0 for none.  A whole text has its label only if all its mandatory words stand; with
    a changed or limited grant no more than its opening is found.  Null text counts as empty.  Texts are scanned whole, at any length.
    """
    carried = docs.select(row_of(docs, keep or docs.columns), F.col(quoted(text_column)).alias("text"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        machine = automaton(templates)
        rows = []
        for data in utf8(batch.column(1)):
            words = data.translate(FOLD).split()
            found = machine.matches(words)
            places = sorted(start for number, start, _ in found if templates[number].base)
            base = sorted({templates[n].label for n, _, _ in found if templates[n].base})
            labels = sorted({templates[n].label for n, _, _ in found})
            weights = [templates[n].weight for n, _, _ in found]
            ends = (places[0], places[-1]) if places else (None, None)
            spans = [
                {"label": templates[n].label, "start": a, "end": b, "weight": templates[n].weight} for n, a, b in found
            ]
            rows.append(
                (len(words), len(places), *ends, ",".join(base), ",".join(labels), max(weights, default=0.0), spans)
            )
        span = pa.struct(
            [("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("weight", pa.float64())]
        )
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(span)]
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"]
        columns = list(zip(*rows)) or [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["row", *names]
        )

    return map_batches(carried, run, with_row(carried, RESULT))


def _pattern(parts: list) -> str:
    """The same wording as a regular expression over words that each end in a space."""
    out = ""
    for part in parts:
        if isinstance(part, str):
            out += re.escape(part) + " "
        elif isinstance(part, tuple):
            out += "(?:[^ ]+ ){%d,%d}" % part
        else:
            out += f"(?:{_pattern(part)})?"
    return out


def license_sql(templates: tuple[Template, ...] = TEMPLATES) -> str:
    """DuckDB SQL for the scan of ``documents``, with regular expressions in place of the automaton."""
    plain = [t for t in templates if t.base]
    places = " || ".join(
        "list_transform(list_filter(range(n_words), lambda i: "
        + " AND ".join(f"w[i + {k + 1}] = '{word}'" for k, word in enumerate(parsed(t.text)))
        + f"), lambda i: {{'at': i, 'label': '{t.label}'}})"
        for t in plain
    )
    hits = ", ".join(
        f"CASE WHEN regexp_matches({'granted' if t.grant else 'joined'}, ' {_pattern(parsed(t.text))}') THEN {{'label': '{t.label}', 'weight': {t.weight}::DOUBLE}} END"
        for t in templates
    )
    verbs = "|".join(sorted({t.text.split()[0] for t in templates if t.grant}))
    denials = "|".join(w.decode() for w in DENIALS)
    return rf"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
joint AS (SELECT doc_id, w, len(w) AS n_words, ' ' || array_to_string(w, ' ') || ' ' AS joined FROM split),
counted AS (
  SELECT *, regexp_replace(joined, ' (?:{denials}) (?:[^ ]+ ){{0,{DENIED_BEFORE - 1}}}(?:{verbs}) under', ' denied', 'g') AS granted
  FROM joint),
found AS (
  SELECT doc_id, n_words, {places} AS base, list_filter([{hits}], lambda h: h IS NOT NULL) AS hit FROM counted)
SELECT doc_id, n_words::BIGINT AS n_words, len(base)::BIGINT AS n_base,
  list_min(list_transform(base, lambda b: b.at))::BIGINT AS first_word,
  list_max(list_transform(base, lambda b: b.at))::BIGINT AS last_word,
  array_to_string(list_sort(list_distinct(list_transform(base, lambda b: b.label))), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_transform(hit, lambda h: h.label))), ',') AS labels,
  coalesce(list_max(list_transform(hit, lambda h: h.weight)), 0)::DOUBLE AS score
FROM found
"""
