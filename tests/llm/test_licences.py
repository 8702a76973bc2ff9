import pytest
from pyspark.sql import functions as F

from vacantia.llm import licences as L

MIT = "MIT License\n\nCopyright (c) 2020 A. Nyone\n\n" + "\n".join(" ".join(L.SENTENCES[k]) for k in ("mit-grant", "mit-condition", "as-is-software"))
GPL = ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\n"
       "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.\n")
CASES = [("Some prose. Released under the MIT License. More.", ["MIT"]), ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"]),
         ("x\nLicensed under the Apache License, Version 2.0.\ny", ["Apache-2.0"]), ("LICENSED UNDER CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
         (MIT, ["MIT"]), (GPL, ["GPL-3.0-or-later"]), ("", []), (None, []), ("licence questions are not licences.", []),
         ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a "
          "copy of the License at\n http://x\n", ["Apache-2.0"]),
         ("Licensed under CC BY 4.0. Licensed under CC BY-SA 4.0.", ["CC-BY-4.0", "CC-BY-SA-4.0"]), ("mit der Zeit " * 2000, [])]


def plain(text):
    """Rules tried in order on the identifiers alone, each taking the leftmost free places."""
    found = L.sentences(text)
    names, out = [f[2] for f in found], []
    for licence, rule in L.RULES:
        i = 0
        while i <= len(names) - len(rule):
            if tuple(names[i:i + len(rule)]) == rule:
                names[i:i + len(rule)] = [None] * len(rule)
                out.append(licence)
            i += 1
    return sorted(out), sum(n is not None for n in names)


@pytest.mark.parametrize("text,want", CASES)
def test_cases(text, want):
    spans = L.match_rules(L.sentences(text or ""))
    assert sorted({s["licence"] for s in spans if s["licence"]}) == want
    assert all((text or "")[s["at"]:s["at"] + s["length"]].strip() for s in spans)
    assert (sorted(s["licence"] for s in spans if s["licence"]), sum(s["licence"] is None for s in spans)) == plain(text or "")


def test_every_sentence_is_found_and_triggers():
    for name, forms in L.SENTENCES.items():
        for form in forms:
            assert any(t in form.lower() for t in L.TRIGGERS)
            text = "Words before.\n" + form + "\nwords after"
            (at, end, found), = L.sentences(text)
            assert found == name and text[at:end] == form


def test_rules_use_known_sentences_and_longer_ones_come_first():
    order = {}
    for i, (_, rule) in enumerate(L.RULES):
        assert set(rule) <= set(L.SENTENCES)
        for earlier, at in order.items():
            assert not (len(earlier) < len(rule) and earlier == rule[:len(earlier)]), (earlier, rule)
        order[rule] = i


def test_left_over_sentences_are_reported():
    text = "See the License for the specific language governing permissions and limitations under the License."
    assert L.match_rules(L.sentences(text)) == [{"licence": None, "at": 0, "length": len(text), "sentences": ["apache2-see"]}]


def test_order_matters():
    parts = [L.SENTENCES[k][0] for k in ("bsd-grant", "bsd-source", "bsd-binary")]
    assert [s["licence"] for s in L.match_rules(L.sentences("\n".join(parts)))] == ["BSD-2-Clause"]
    assert all(s["licence"] is None for s in L.match_rules(L.sentences("\n".join(reversed(parts)))))


def test_table(spark, documents):
    rows = [(i, t) for i, (t, _) in enumerate(CASES)] + [(0, CASES[0][0]), (None, CASES[1][0]), (99, "word " * 100_000 + "\nLicensed under CC BY 4.0.")]
    docs = documents(rows).withColumn("licences", F.lit("clash"))
    out = L.scan_licences(docs).collect()
    assert [r.doc_id for r in out] == [r[0] for r in rows]
    for r, (_, text) in zip(out, rows):
        names, left = plain(text or "")
        assert (r.licences, r.n_notices, r.n_unmatched) == (sorted(set(names)), len(names), left)
    assert L.scan_licences(docs.limit(0)).count() == 0


#: The notices as their publishers print them, and the licence of each.
WRAPPED = [("""Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
""", "MIT", 3), ("""Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS.
""", "ISC", 1), ("""Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
""", "BSD-2-Clause", 3), ("""Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
""", "Apache-2.0", 5), ("""This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
""", "GPL-3.0-or-later", 4)]


@pytest.mark.parametrize("text,want,size", WRAPPED, ids=[w for _, w, _ in WRAPPED])
@pytest.mark.parametrize("before", ["", "# ", " * ", "-- "])
def test_wrapped_as_published(text, want, size, before):
    text = "".join(before + line + "\n" for line in text.splitlines())
    assert [(s["licence"], len(s["sentences"])) for s in L.match_rules(L.sentences(text))] == [(want, size)]


def test_any_width():
    for name, forms in L.SENTENCES.items():
        for form in forms:
            assert [f[2] for f in L.sentences("Words before.\n" + form.replace(" ", "\n") + "\nwords after")] == [name]


def test_wrapped_in_a_table(spark, documents):
    rows = [(i, t) for i, (t, _, _) in enumerate(WRAPPED)] + [(10, "This work is in the public\ndomain."), (11, "Released\nunder MIT.")]
    got = [r.licences for r in L.scan_licences(documents(rows)).collect()]
    assert got == [[w] for _, w, _ in WRAPPED] + [["public-domain"], ["MIT"]]


BSD2 = next(t for t, w, _ in WRAPPED if w == "BSD-2-Clause")
NAMES = ["the copyright holder", "the University of California, Berkeley", "Example\n   Research Inc."]
LATER = [("program", "GNU Lesser General Public License", "3", "LGPL-3.0-or-later"), ("library", "GNU Lesser General Public License", "2.1", "LGPL-2.1-or-later"),
         ("library", "GNU Library General Public License", "2", "LGPL-2.0-or-later"), ("program", "GNU Affero General Public License", "3", "AGPL-3.0-or-later"),
         ("program", "GNU General Public License", "2", "GPL-2.0-or-later")]


def named(text):
    return [(s["licence"], len(s["sentences"])) for s in L.match_rules(L.sentences(text))]


@pytest.mark.parametrize("owner", NAMES)
def test_bsd_by_clauses(owner):
    third = (f"3. Neither the name of {owner} nor the names of its\n   contributors may be used to endorse or promote products derived from\n"
             "   this software without specific prior written permission.\n")
    advertising = ("3. All advertising materials mentioning features or use of this software\n   must display the following acknowledgement:\n"
                   "   This product includes software developed by someone.\n")
    rest = "\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\".\n"
    assert named(BSD2 + rest) == [("BSD-2-Clause", 3)]
    assert named(BSD2 + "\n" + third + rest) == [("BSD-3-Clause", 4)]
    assert named(BSD2 + "\n" + advertising + third + rest) == [("BSD-4-Clause", 5)]
    twice = L.sentences((BSD2 + third + rest) * 2)
    assert [s["licence"] for s in L.match_rules(twice)] == ["BSD-3-Clause"] * 2


def test_a_name_is_no_longer_than_it_must():
    clause = "Neither the name of A. Nyone nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    text = "Neither the name of the rose.\n" + clause + "\n" + clause[len("Neither the name of "):] + "\n" + "Neither the name of\n" * 20_000
    assert [(text[a:e], n) for a, e, n in L.sentences(text)] == [(clause, "bsd-name")]


@pytest.mark.parametrize("work,name,version,want", LATER, ids=[x[-1] for x in LATER])
def test_later_versions(work, name, version, want):
    grant = (f"This {work} is free software; you can redistribute it and/or\nmodify it under the terms of the {name}\nas published by the Free Software Foundation; "
             f"either\nversion {version} of the License, or (at your option) any later version.\n")
    rest = (f"\nThis {work} is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\n"
            f"MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the {name}\nfor more details.\n")
    assert named(grant + rest) == [(want, 4)] and named(grant) == [(want, 2)]
