"""Licence notices by sentences and rules.

A text's sentences are normalised and looked up among the sentences that licence notices are made of. The identifiers found,
in order, are then matched against ordered rules: a rule is a sequence of identifiers, longer rules stand before shorter
ones, and what a rule has matched is taken by it. Unknown sentences are skipped, whatever stands between two known ones;
known sentences that no rule takes are reported as such.

Only texts that hold one of a few words, without which no known sentence does, go to the sentence reader.

Null and empty texts have no sentences and so no licences. Repeated rows are read each for itself, and further columns
stay out of the result.
"""

from __future__ import annotations

import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

OWNER = "NAME_OF_OWNER"  # in a sentence: any words, one at least, up to those that follow it there

# Sentences of public licence notices, by identifier. They are compared as ``normal`` gives them.
SENTENCES = {
    "mit-released": ("Released under the MIT License.", "Released under MIT.", "This project is released under the MIT License."),
    "mit-licensed": ("Licensed under the MIT License.", "This software is licensed under the MIT License.", "MIT Licensed.",
                     "This project is licensed under the MIT License."),
    "mit-name": ("The MIT License", "The MIT License (MIT)", "MIT License"),
    "mit-grant": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                  "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
                  "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
                  "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",),
    "mit-condition": ("The above copyright notice and this permission notice shall be included in all copies or substantial "
                      "portions of the Software.",),
    "as-is-software": ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
                       "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",),
    "apache2-licensed": ("Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\");",
                         "Licensed under the Apache License 2.0.", "This project is licensed under the Apache License, Version 2.0."),
    "apache2-comply": ("you may not use this file except in compliance with the License.",),
    "apache2-obtain": ("You may obtain a copy of the License at",),
    "apache2-name": ("Apache License, Version 2.0", "Apache License 2.0"),
    "apache2-as-is": ("Unless required by applicable law or agreed to in writing, software distributed under the License is "
                      "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",),
    "apache2-see": ("See the License for the specific language governing permissions and limitations under the License.",),
    "gpl3-licensed": ("This work is licensed under the GNU General Public License, version 3.",
                      "This program is licensed under the GNU General Public License, version 3.",
                      "Licensed under the GNU General Public License, version 3.", "Licensed under the GPLv3 license."),
    "gpl2-licensed": ("This work is licensed under the GNU General Public License, version 2.",
                      "This program is licensed under the GNU General Public License, version 2.",
                      "Licensed under the GNU General Public License, version 2.", "Licensed under the GPLv2 license."),
    "gpl-free": ("This program is free software:", "This program is free software;", "This library is free software:",
                 "This library is free software;"),
    "gpl3-later": ("you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                   "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",),
    "gpl2-later": ("you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                   "the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",),
    "gpl-no-warranty": ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
                        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
                        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
                        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    "gpl-see": ("See the GNU General Public License for more details.",),
    "lgpl3-later": ("you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
                    "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",),
    "lgpl21-later": ("you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
                     "by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",),
    "lgpl2-later": ("you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published "
                    "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",),
    "lgpl-see": ("See the GNU Lesser General Public License for more details.",
                 "See the GNU Library General Public License for more details."),
    "agpl3-later": ("you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published "
                    "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",),
    "agpl-see": ("See the GNU Affero General Public License for more details.",),
    "lgpl3-licensed": ("Licensed under the GNU Lesser General Public License, version 3.",),
    "lgpl21-licensed": ("Licensed under the GNU Lesser General Public License, version 2.1.",),
    "agpl3-licensed": ("Licensed under the GNU Affero General Public License, version 3.",),
    "bsd-grant": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                  "the following conditions are met:",),
    "bsd-source": ("Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                   "following disclaimer.",),
    "bsd-binary": ("Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                   "following disclaimer in the documentation and/or other materials provided with the distribution.",),
    "bsd-advertising": ("All advertising materials mentioning features or use of this software must display the following acknowledgement:",),
    "bsd-name": tuple(f"{start} may {verb}be used to endorse or promote products derived from this software without specific prior "
                      "written permission." for start, verb in (
                          *((f"Neither the {name} of {OWNER} nor the names of {whose}contributors", "")
                            for name in ("name", "names") for whose in ("", "its ", "their ", "his ", "her ", "any ", "other ")),
                          ("The name of the author", "not "), ("The names of the authors", "not "),
                          ("The name of the copyright holder", "not "), ("The names of the copyright holders", "not "),
                          ("The names of its contributors", "not "), ("The names of the contributors", "not "))),
    "bsd3-licensed": ("Licensed under the BSD 3-Clause License.",),
    "bsd2-licensed": ("Licensed under the BSD 2-Clause License.",),
    "isc-licensed": ("Licensed under the ISC License.",),
    "isc-grant": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                  "granted, provided that the above copyright notice and this permission notice appear in all copies.",),
    "mpl2-licensed": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                      "Licensed under the Mozilla Public License, Version 2.0."),
    "epl2-licensed": ("Licensed under the Eclipse Public License, Version 2.0.",),
    "cc0": ("This work is dedicated to the public domain under CC0 1.0 Universal, without any copyright.", "Licensed under CC0 1.0."),
    "cc-by-4": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-sa-4": ("Licensed under CC BY-SA 4.0.",
                   "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc-by-nc-4": ("Licensed under CC BY-NC 4.0.",
                   "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by-nd-4": ("Licensed under CC BY-ND 4.0.",),
    "cc-by-nc-sa-4": ("Licensed under CC BY-NC-SA 4.0.",),
    "cc-by-nc-nd-4": ("Licensed under CC BY-NC-ND 4.0.",),
    "public-domain": ("This work is in the public domain.", "This software is released into the public domain."),
    "all-rights": ("All rights reserved, no licence is granted.",),
}

# A licence and the identifiers it takes, in the order in which the rules are tried.
RULES = (
    ("MIT", ("mit-name", "mit-grant", "mit-condition", "as-is-software")),
    ("MIT", ("mit-grant", "mit-condition", "as-is-software")),
    ("Apache-2.0", ("apache2-licensed", "apache2-comply", "apache2-obtain", "apache2-as-is", "apache2-see")),
    ("Apache-2.0", ("apache2-licensed", "apache2-comply", "apache2-obtain")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl3-later", "gpl-no-warranty", "gpl-see")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl2-later", "gpl-no-warranty", "gpl-see")),
    ("LGPL-3.0-or-later", ("gpl-free", "lgpl3-later", "gpl-no-warranty", "lgpl-see")),
    ("LGPL-2.1-or-later", ("gpl-free", "lgpl21-later", "gpl-no-warranty", "lgpl-see")),
    ("LGPL-2.0-or-later", ("gpl-free", "lgpl2-later", "gpl-no-warranty", "lgpl-see")),
    ("AGPL-3.0-or-later", ("gpl-free", "agpl3-later", "gpl-no-warranty", "agpl-see")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl3-later")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl2-later")),
    ("LGPL-3.0-or-later", ("gpl-free", "lgpl3-later")), ("LGPL-2.1-or-later", ("gpl-free", "lgpl21-later")),
    ("LGPL-2.0-or-later", ("gpl-free", "lgpl2-later")), ("AGPL-3.0-or-later", ("gpl-free", "agpl3-later")),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-name")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("MIT", ("mit-grant", "mit-condition")),
    ("MIT", ("mit-released",)), ("MIT", ("mit-licensed",)), ("MIT", ("mit-name",)),
    ("Apache-2.0", ("apache2-licensed",)), ("Apache-2.0", ("apache2-name",)),
    ("GPL-3.0", ("gpl3-licensed",)), ("GPL-2.0", ("gpl2-licensed",)),
    ("LGPL-3.0", ("lgpl3-licensed",)), ("LGPL-2.1", ("lgpl21-licensed",)), ("AGPL-3.0", ("agpl3-licensed",)),
    ("BSD-3-Clause", ("bsd3-licensed",)), ("BSD-2-Clause", ("bsd2-licensed",)),
    ("ISC", ("isc-grant", "as-is-software")), ("ISC", ("isc-licensed",)), ("ISC", ("isc-grant",)),
    ("MPL-2.0", ("mpl2-licensed",)), ("EPL-2.0", ("epl2-licensed",)), ("CC0-1.0", ("cc0",)),
    ("CC-BY-4.0", ("cc-by-4",)), ("CC-BY-SA-4.0", ("cc-by-sa-4",)), ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-4",)), ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-4",)), ("CC-BY-NC-ND-4.0", ("cc-by-nc-nd-4",)),
    ("public-domain", ("public-domain",)), ("none-granted", ("all-rights",)),
)

# Parts of single words, so that no line break can stand inside one.
TRIGGERS = ("licen", "permi", "redistribut", "warrant", "copyright", "domain", "software", "released")
SENTENCE = re.compile(r"[^\n]*?(?:[.;:](?=\s|$)|(?=\n)|$)")
FOUND = "array<struct<licence: string, at: int, length: int, sentences: array<string>>>"


def normal(sentence: str) -> str:
    """Lower case; runs of anything but letters, digits and inner dots and hyphens become one blank."""
    return " ".join(w.strip(".-") for w in re.split(r"[^\w.\-]+", sentence.lower()) if w.strip(".-"))


SLOT = "*"  # no word
NEITHER = "neither"  # the sentences with an owner start so; the name ends at the latest where another one may start


def word_trie(known: dict[str, str]) -> dict:
    """Words to nodes; a node at which a sentence ends holds its identifier under None. A node that an owner's name leads to
    holds itself under ``SLOT``, so that the name may have further words."""
    root: dict = {}
    for sentence, name in known.items():
        node = root
        for word in sentence.split():
            if word == normal(OWNER):
                node = node.setdefault(SLOT, {})
                node[SLOT] = node
            else:
                node = node.setdefault(word, {})
        node[None] = name
    return root


KNOWN = word_trie({normal(s): name for name, forms in SENTENCES.items() for s in forms})


def step(nodes: list[dict], word: str) -> list[dict]:
    """The nodes a word leads to."""
    out = [n[word] for n in nodes if word in n]
    return out + [n[SLOT] for n in nodes if SLOT in n and word != NEITHER]


def sentences(text: str) -> list[tuple[int, int, str]]:
    """(at, end, identifier) of the known sentences, in order.

    A notice may be wrapped, so the pieces that follow are joined for as long as they go on as some known sentence does,
    over however many lines. Of the sentences that start at a piece the longest counts.
    """
    pieces = [(m.start(), m.end(), words) for m in SENTENCE.finditer(text) if (words := normal(m.group()).split())]
    out, i = [], 0
    while i < len(pieces):
        nodes, found = [KNOWN], None
        for n in range(i, len(pieces)):
            for word in pieces[n][2]:
                if not (nodes := step(nodes, word)):
                    break
            if not nodes:
                break
            if name := next((k[None] for k in nodes if None in k), None):
                found = n, name
                nodes = [k for k in nodes if k.get(SLOT) is not k]  # a slot takes no more than it must
        if found is None:
            i += 1
            continue
        (at, _, _), (_, end, _) = pieces[i], pieces[found[0]]
        out.append((at + len(text[at:end]) - len(text[at:end].lstrip()), end, found[1]))
        i = found[0] + 1
    return out


def match_rules(found: list[tuple[int, int, str]]) -> list[dict]:
    """What the rules take, in the order of the text; known sentences left over have no licence."""
    taken, out, names = [False] * len(found), [], [f[2] for f in found]
    for licence, rule in RULES:
        n = len(rule)
        for i in range(len(found) - n + 1):
            if names[i] == rule[0] and tuple(names[i:i + n]) == rule and not any(taken[i:i + n]):
                taken[i:i + n] = [True] * n
                out.append({"licence": licence, "at": found[i][0], "length": found[i + n - 1][1] - found[i][0], "sentences": list(rule)})
    out += [{"licence": None, "at": a, "length": e - a, "sentences": [x]} for (a, e, x), t in zip(found, taken) if not t]
    return sorted(out, key=lambda r: r["at"])


def licence_spans(text: Column) -> Column:
    """The notices of a text: licence (null if no rule fits), where it starts and its length in characters, its sentences."""
    lowered = F.lower(text)
    may = reduce(lambda a, b: a | b, [lowered.contains(t) for t in TRIGGERS])

    @F.arrow_udf(FOUND)
    def scan(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("licence", pa.string()), ("at", pa.int32()), ("length", pa.int32()), ("sentences", pa.list_(pa.string()))]))
        return pa.array([match_rules(sentences(t)) if t else [] for t in texts.to_pylist()], kind)

    return scan(F.when(may, text))


def scan_licences(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, notices, licences (distinct names, sorted), n_notices, n_unmatched for each row."""
    found = docs.select(doc, licence_spans(F.col(text)).alias("notices"))
    names = F.array_sort(F.array_distinct(F.array_compact(F.col("notices.licence"))))
    unmatched = F.size(F.filter("notices", lambda n: n["licence"].isNull()))
    return found.select(doc, "notices", names.alias("licences"), (F.size("notices") - unmatched).alias("n_notices"),
                        unmatched.alias("n_unmatched"))
