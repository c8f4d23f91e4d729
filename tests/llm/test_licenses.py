from __future__ import annotations

import random
import re

import pytest

from rookery.llm import licenses
from rookery.llm.licenses import Automaton, Template, parsed, scan_licenses

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD_CONDITIONS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
   disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
   disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_THIRD = """3. Neither the name of the ACME Corp. nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
"""
BSD_DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF
USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED
OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD2, BSD3 = BSD_CONDITIONS + BSD_DISCLAIMER, BSD_CONDITIONS + BSD_THIRD + BSD_DISCLAIMER
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS
IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""
GPL3 = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty
of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
WHOLE = {
    "mit-text": MIT, "bsd-2-clause-text": BSD2, "bsd-3-clause-text": BSD3, "isc-text": ISC, "apache-2.0-notice": APACHE,
    "gpl-3.0-notice": GPL3, "gpl-2.0-notice": GPL3.replace("version 3", "version 2"), "mpl-2.0-notice": MPL,
    "lgpl-3.0-notice": GPL3.replace("GNU General", "GNU Lesser General"),
}


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_automaton_equals_regular_expressions():
    rng = random.Random(2)
    texts = ["a [[b c]] d", "a {1-2} b", "a [[b [[c]] {0-1}]] a", "[[a]] b {0-2} [[c]]", "b b", "c [[a]] [[a]] [[b]] d"]
    templates = tuple(Template(str(i), t, 1.0) for i, t in enumerate(texts))
    machine = Automaton(templates)
    for _ in range(500):
        words = [rng.choice("abcdx") for _ in range(rng.randrange(12))]
        got = machine.matches([w.encode() for w in words])
        want = set()
        for number, t in enumerate(templates):
            pattern = re.compile(licenses._pattern(parsed(t.text)))
            for start in range(len(words)):
                for end in range(start + 1, len(words) + 1):
                    if pattern.fullmatch("".join(w + " " for w in words[start:end])):
                        want.add((number, start, end))
                        break
        assert set(got) == want and len(got) == len(want)


def labels_of(text):
    machine = licenses.automaton(licenses.TEMPLATES)
    return {licenses.TEMPLATES[n].label for n, _, _ in machine.matches(text.translate(FOLDED).encode().translate(licenses.FOLD).split())}


FOLDED = {c: c + 32 for c in range(65, 91)}


@pytest.mark.parametrize("label", list(WHOLE))
def test_changed_wording_anywhere_loses_the_whole_text(label):
    text = WHOLE[label]
    assert label in labels_of(text)
    words = text.split()
    replaceable = limited_all_the_same = 0
    for place in range(len(words)):
        changed = " ".join([*words[:place], "otherwise" if words[place] != "otherwise" else "else", *words[place + 1 :]])
        replaceable += label in labels_of(changed)
        limited = " ".join([*words[:place], "for non-commercial use only", *words[place:]])
        limited_all_the_same += label in labels_of(limited)
    # Only names, an address, numbers of the conditions, and words before the template may differ.
    assert replaceable <= 8 + 0.08 * len(words)
    assert limited_all_the_same <= 8 + 0.05 * len(words)
    assert label not in labels_of(" ".join(words[: len(words) - 4])) and label not in labels_of(" ".join(words[6:]))


def test_labels_of_full_texts_grants_and_mentions(spark, make_docs):
    limited = MIT.replace("copies of the Software, and", "copies of the Software for non-commercial use only, and")
    texts = {
        MIT: ("", "mit-opening,mit-text", 1.0),
        MIT.replace('software and associated\ndocumentation files (the "Software")', "program").replace("SOFTWARE", "PROGRAM"):
            ("", "mit-opening,mit-text", 1.0),
        limited: ("", "mit-opening", 0.6),
        MIT.replace("without restriction", "with restriction"): ("", "", 0.0),
        BSD2: ("", "bsd-2-clause-text,bsd-opening", 1.0),
        BSD3: ("", "bsd-3-clause-text,bsd-opening", 1.0),
        BSD_CONDITIONS + "Commercial use is forbidden.": ("", "bsd-opening", 0.6),
        ISC: ("", "isc-opening,isc-text", 1.0),
        "The MIT License and the mit-LICENSE": ("mit", "mit", 0.5),
        "É This work is licensed under the GNU General Public License, version 3.": ("gpl", "gpl,gpl-3.0", 0.8),
        "Licensed under CC BY-NC 4.0.": ("", "cc-by-nc-4.0", 0.8),
        "Creative Commons Attribution 4.0 International": ("", "cc-by-4.0", 0.7),
        "Creative Commons Attribution-ShareAlike 4.0": ("", "cc-by-sa-4.0", 0.7),
        "licensed under the terms of the Apache License, Version 2.0": ("apache", "apache,apache-2.0", 0.8),
        "This is released under the MIT license.": ("mit", "mit", 0.8),
        "This is not released under the MIT license.": ("mit", "mit", 0.5),
        "It was never to be released under the MIT license.": ("mit", "mit", 0.5),
        "This is not mine. It is released under the MIT license.": ("mit", "mit", 0.8),
        "not released under x, not licensed under the mit license": ("mit", "mit", 0.5),
        "not released under not released under the mit license": ("mit", "mit", 0.5),
        "not licensed under cc by 4.0, released under the mit license": ("mit", "mit", 0.8),
        "mit licenses": ("", "", 0.0),
        "émit license": ("", "", 0.0),
        "": ("", "", 0.0),
    }
    docs = make_docs([*texts, None]).selectExpr("*", "1 as labels", "2 as score", "3 as row")
    found = {r.row.text: r for r in scan_licenses(docs).collect()}
    for text, want in texts.items():
        r = found[text]
        assert (r.base_labels, r.labels, r.score) == want, text
        assert r.n_words == len(plain_words(text))
    r = found["The MIT License and the mit-LICENSE"]
    assert (r.n_base, r.first_word, r.last_word) == (2, 1, 5)
    r = found[None]
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.labels) == (0, 0, None, None, "")
    assert scan_licenses(docs.filter("false")).collect() == []


def test_sql_finds_the_same_in_changed_texts(spark, make_docs, tmp_path):
    import duckdb

    rng = random.Random(6)
    rows = [*WHOLE.values()]
    for text in WHOLE.values():
        for _ in range(12):
            words = text.split()
            place = rng.randrange(len(words))
            words[place : place + rng.randrange(2)] = rng.choice([["not"], ["only", "here"], ["the"], []])
            rows.append(" ".join(words))
    pool = "not never released licensed under the terms of mit license cc by nc 4.0 gnu general public version 3 x".split()
    rows += [" ".join(rng.choice(pool) for _ in range(rng.randrange(4, 60))) for _ in range(300)]
    docs = make_docs(rows)
    docs.write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    want = sorted(con.execute(f"SELECT {', '.join(names)} FROM ({licenses.license_sql()})").fetchall())
    found = scan_licenses(docs).select("row.doc_id", *names[1:]).collect()
    assert sorted(map(tuple, found)) == want


def test_very_long_text(spark, make_docs):
    text = "permission is " * 50000 + MIT
    (r,) = scan_licenses(make_docs([text])).collect()
    assert r.labels == "mit-opening,mit-text" and r.n_words == len(plain_words(text))


def test_markup_errors():
    with pytest.raises(ValueError):
        parsed("a [[b")
    with pytest.raises(ValueError):
        Automaton((Template("x", "[[a]]", 1.0),))
