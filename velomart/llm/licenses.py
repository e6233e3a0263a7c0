"""License scan by sentence rules.

Sentences are normalised (lower case, letters and digits only) and mapped to the identifiers of
known license sentences. A document is then its sequence of identifiers, and a rule is an
ordered list of identifiers that must follow each other in that sequence, whatever unknown
sentences stand between. Rules are tried in order, longer ones before the short notices they
contain, and a match uses up its sentences.

A sentence may be wrapped: marks that begin a line (comment leaders) are dropped, and a known
sentence is found from the beginning of a line or sentence to the end of a line or sentence,
across single line feeds. A blank line ends a sentence, also one that holds only marks. So a
one-line notice between other lines is found as well, and of two that begin alike the longer.

A text is cut into sentences and these into lines, and whole runs of lines are looked up in the
map. A run is only put together where its first line begins a known sentence, which one lookup in
a hash set tells, so the cost does not grow with the number of known sentences.

Terms of an SPDX expression count one by one: ``A OR B`` and ``A AND B`` as an identifier line for
each, ``A WITH exception`` as ``A``.

All of it happens inside the row that holds the text, with expressions: no shuffle, no limit.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A sentence ends at a blank line, or at . ! ? ; or : before white space or the end.
SENTENCE_END = r"\n\n+|[.!?;:]+(?=[ \t\n\x0B\f\r]|$)"
LEADER = r"(^|\n)[^\p{L}\p{N}\n]+"
#: Stands for a sentence end until all else but letters, digits and line feeds is folded.
END = "\x02"

#: Known license sentences; fixed values, the public wording of each license or notice.
SENTENCES = {
    1: "Released under the MIT License",
    2: "Licensed under the MIT License",
    3: "This project is licensed under the MIT License",
    4: "Licensed under the Apache License, Version 2.0",
    5: "Licensed under the Apache License, Version 2.0 (the \"License\")",
    6: "you may not use this file except in compliance with the License",
    7: "You may obtain a copy of the License at",
    8: "See the License for the specific language governing permissions and limitations under the License",
    9: "This work is licensed under the GNU General Public License, version 3",
    10: "This program is free software",
    11: "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by"
    " the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    12: "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    13: "See the GNU General Public License for more details",
    14: "Licensed under CC BY-NC 4.0",
    15: "Licensed under CC BY 4.0",
    16: "Licensed under CC BY-SA 4.0",
    17: "This work is licensed under a Creative Commons Attribution 4.0 International License",
    18: "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    19: "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    20: "All rights reserved",
    21: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
    " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
    " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
    " Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    22: "The above copyright notice and this permission notice shall be included in all copies or substantial"
    " portions of the Software",
    23: "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT"
    " LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    24: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
    " the following conditions are met",
    25: "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
    " products derived from this software without specific prior written permission",
    26: "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
    " granted, provided that the above copyright notice and this permission notice appear in all copies",
    27: "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    28: "This work is dedicated to the public domain",
    29: "SPDX-License-Identifier",
    30: "MIT",
    31: "Apache-2.0",
    32: "GPL-3.0-or-later",
    33: "CC-BY-4.0",
    34: "Redistributions of source code must retain the above copyright notice, this list of conditions and the"
    " following disclaimer",
    35: "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the"
    " following disclaimer in the documentation and/or other materials provided with the distribution",
    36: "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by"
    " the Free Software Foundation",
    37: "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as"
    " published by the Free Software Foundation",
    38: "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as"
    " published by the Free Software Foundation",
    39: "either version 2 of the License, or (at your option) any later version",
    40: "either version 2.1 of the License, or (at your option) any later version",
    41: "either version 3 of the License, or (at your option) any later version",
    42: "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by"
    " the Free Software Foundation, either version 2 of the License, or (at your option) any later version",
    43: "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as"
    " published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version",
    44: "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as"
    " published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    45: "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as"
    " published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    46: "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as"
    " published by the Free Software Foundation",
    47: "This program and the accompanying materials are made available under the terms of the Eclipse Public License"
    " 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    48: "This program and the accompanying materials are made available under the terms of the Eclipse Public License"
    " v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    49: "This is free and unencumbered software released into the public domain",
    50: "GPL-2.0-only",
    51: "GPL-2.0-or-later",
    52: "LGPL-2.1-or-later",
    53: "LGPL-3.0-or-later",
    54: "AGPL-3.0-or-later",
    55: "EPL-2.0",
    56: "Unlicense",
    57: "BSD-2-Clause",
    58: "BSD-3-Clause",
    59: "ISC",
    60: "MPL-2.0",
    61: "GPL-3.0-only",
    62: "The MIT License (MIT)",
}

SPDX_TAG = 29

#: Further identifiers of the SPDX list, and the license that each stands for; fixed values.
SPDX_NAMES = {
    "0BSD": "0BSD", "AGPL-3.0-only": "AGPL-3.0-only", "Artistic-2.0": "Artistic-2.0", "BSL-1.0": "BSL-1.0",
    "CC0-1.0": "CC0-1.0", "CC-BY-NC-4.0": "CC-BY-NC-4.0", "CC-BY-ND-4.0": "CC-BY-ND-4.0", "CC-BY-SA-4.0": "CC-BY-SA-4.0",
    "CDDL-1.0": "CDDL-1.0", "EPL-1.0": "EPL-1.0", "EUPL-1.2": "EUPL-1.2", "GPL-2.0": "GPL-2.0-only",
    "GPL-3.0": "GPL-3.0-only", "LGPL-2.1": "LGPL-2.1-only", "LGPL-2.1-only": "LGPL-2.1-only", "LGPL-3.0": "LGPL-3.0-only",
    "LGPL-3.0-only": "LGPL-3.0-only", "AGPL-3.0": "AGPL-3.0-only", "MIT-0": "MIT-0", "MS-PL": "MS-PL", "NCSA": "NCSA",
    "OFL-1.1": "OFL-1.1", "PostgreSQL": "PostgreSQL", "Python-2.0": "Python-2.0", "WTFPL": "WTFPL", "X11": "X11", "Zlib": "Zlib",
}

#: Names under which notices cite a license; fixed values.
TITLES = {
    "MIT": ("MIT License",),
    "MIT-0": ("MIT No Attribution License",),
    "Apache-2.0": ("Apache License 2.0", "Apache 2.0 License", "Apache License, Version 2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License", "Modified BSD License"),
    "BSL-1.0": ("Boost Software License", "Boost Software License, Version 1.0"),
    "ISC": ("ISC License",),
    "Zlib": ("zlib License",),
    "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License, Version 2.0"),
    "GPL-2.0-only": ("GNU General Public License v2.0", "GNU General Public License, version 2", "GPLv2"),
    "GPL-3.0-only": ("GNU General Public License v3.0", "GNU General Public License, version 3", "GPLv3"),
    "LGPL-2.1-only": ("GNU Lesser General Public License v2.1", "LGPLv2.1"),
    "LGPL-3.0-only": ("GNU Lesser General Public License v3.0", "LGPLv3"),
    "AGPL-3.0-only": ("GNU Affero General Public License v3.0", "AGPLv3"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License v2.0"),
    "CDDL-1.0": ("Common Development and Distribution License 1.0",),
    "Artistic-2.0": ("Artistic License 2.0",),
    "OFL-1.1": ("SIL Open Font License 1.1", "SIL Open Font License, Version 1.1"),
    "Unlicense": ("Unlicense",),
    "WTFPL": ("Do What The F*ck You Want To Public License",),
    "CC0-1.0": ("CC0 1.0 Universal License",),
    "CC-BY-4.0": ("Creative Commons Attribution 4.0 International License",),
    "CC-BY-SA-4.0": ("Creative Commons Attribution-ShareAlike 4.0 International License",),
    "CC-BY-NC-4.0": ("Creative Commons Attribution-NonCommercial 4.0 International License",),
}
SHORT_TITLES = {
    "CC0-1.0": "CC0 1.0", "CC-BY-4.0": "CC BY 4.0", "CC-BY-SA-4.0": "CC BY-SA 4.0", "CC-BY-NC-4.0": "CC BY-NC 4.0",
    "CC-BY-ND-4.0": "CC BY-ND 4.0",
}
#: What a notice says before the name; fixed values.
SAID = (
    "Released under", "Licensed under", "Distributed under", "Published under", "Available under",
    "This project is licensed under", "This project is released under", "This software is licensed under",
    "This software is released under", "This software is distributed under", "This work is licensed under",
    "This code is licensed under", "This library is licensed under", "This file is licensed under",
)


@dataclass(frozen=True)
class LicenseRule:
    license: str
    sentences: tuple[int, ...]


#: Ordered rules; fixed values.
RULES = (
    LicenseRule("MIT", (21, 22, 23)),
    LicenseRule("Apache-2.0", (5, 6, 7, 8)),
    LicenseRule("GPL-3.0-or-later", (10, 11, 12, 13)),
    LicenseRule("BSD-3-Clause", (24, 34, 35, 25)),
    LicenseRule("BSD-2-Clause", (24, 34, 35)),
    LicenseRule("BSD-3-Clause", (24, 34, 25)),
    LicenseRule("BSD-3-Clause", (24, 35, 25)),
    LicenseRule("BSD-3-Clause", (24, 25)),
    LicenseRule("Apache-2.0", (5, 6)),
    LicenseRule("GPL-3.0-or-later", (10, 11)),
    LicenseRule("BSD-2-Clause", (24,)),
    LicenseRule("MIT", (21,)),
    LicenseRule("ISC", (26,)),
    LicenseRule("MPL-2.0", (27,)),
    LicenseRule("MIT", (1,)),
    LicenseRule("MIT", (2,)),
    LicenseRule("MIT", (3,)),
    LicenseRule("MIT", (29, 30)),
    LicenseRule("Apache-2.0", (4,)),
    LicenseRule("Apache-2.0", (5,)),
    LicenseRule("Apache-2.0", (29, 31)),
    LicenseRule("GPL-3.0-only", (9,)),
    LicenseRule("GPL-3.0-or-later", (29, 32)),
    LicenseRule("CC-BY-NC-4.0", (14,)),
    LicenseRule("CC-BY-NC-4.0", (19,)),
    LicenseRule("CC-BY-SA-4.0", (16,)),
    LicenseRule("CC-BY-SA-4.0", (18,)),
    LicenseRule("CC-BY-4.0", (15,)),
    LicenseRule("CC-BY-4.0", (17,)),
    LicenseRule("CC-BY-4.0", (29, 33)),
    LicenseRule("CC0-1.0", (28,)),
    LicenseRule("GPL-2.0-or-later", (36, 39)),
    LicenseRule("GPL-2.0-or-later", (42,)),
    LicenseRule("GPL-2.0-only", (46,)),
    LicenseRule("GPL-3.0-or-later", (36, 41)),
    LicenseRule("LGPL-2.1-or-later", (37, 40)),
    LicenseRule("LGPL-2.1-or-later", (43,)),
    LicenseRule("LGPL-3.0-or-later", (37, 41)),
    LicenseRule("LGPL-3.0-or-later", (44,)),
    LicenseRule("AGPL-3.0-or-later", (38, 41)),
    LicenseRule("AGPL-3.0-or-later", (45,)),
    LicenseRule("EPL-2.0", (47,)),
    LicenseRule("EPL-1.0", (48,)),
    LicenseRule("Unlicense", (49,)),
    LicenseRule("GPL-2.0-only", (29, 50)),
    LicenseRule("GPL-2.0-or-later", (29, 51)),
    LicenseRule("LGPL-2.1-or-later", (29, 52)),
    LicenseRule("LGPL-3.0-or-later", (29, 53)),
    LicenseRule("AGPL-3.0-or-later", (29, 54)),
    LicenseRule("EPL-2.0", (29, 55)),
    LicenseRule("Unlicense", (29, 56)),
    LicenseRule("BSD-2-Clause", (29, 57)),
    LicenseRule("BSD-3-Clause", (29, 58)),
    LicenseRule("ISC", (29, 59)),
    LicenseRule("MPL-2.0", (29, 60)),
    LicenseRule("GPL-3.0-only", (29, 61)),
    LicenseRule("LicenseRef-All-rights-reserved", (20,)),
)


def _by_rule() -> tuple[dict[int, str], tuple[LicenseRule, ...]]:
    """All sentences and rules: the listed ones, SPDX names, and notices made of their parts."""
    sentences, rules = dict(SENTENCES), list(RULES)
    known = {_folded(s) for s in sentences.values()}

    def add(number: int, sentence: str, license_: str, *before: int) -> None:
        if _folded(sentence) not in known:
            known.add(_folded(sentence))
            sentences[number] = sentence
            rules.append(LicenseRule(license_, (*before, number)))

    rules.append(LicenseRule("MIT", (62,)))
    for k, (name, license_) in enumerate(SPDX_NAMES.items()):
        add(100 + k, name, license_, SPDX_TAG)
    cited = [(f"the {title}", license_) for license_, titles in TITLES.items() for title in titles]
    cited += [(f"a {title}", license_) for license_, titles in TITLES.items() for title in titles if title[:2] == "Cr"]
    cited += [(title, license_) for license_, title in SHORT_TITLES.items()]
    for k, (title, license_) in enumerate(cited):
        for j, said in enumerate(SAID):
            add(1000 + 20 * k + j, f"{said} {title}", license_)
    return sentences, tuple(rules)


def _folded(text: str) -> str:
    return " ".join("".join(c if unicodedata.category(c)[0] in "LN" else " " for c in text.lower()).split())


def _spelled(text: Column) -> Column:
    """Lower-case words between single blanks, line feeds (``\\n``) and sentence ends (``.``)."""
    marked = F.translate(F.lower(text), END, " ")
    marked = F.regexp_replace(marked, LEADER, "$1")
    marked = F.regexp_replace(marked, SENTENCE_END, END)
    marked = F.regexp_replace(marked, rf"[^\p{{L}}\p{{N}}\n{END}]+", " ")
    marked = F.regexp_replace(marked, rf" ?{END}[ \n{END}]*", ".")
    return F.trim(F.regexp_replace(marked, r" ?\n ?", "\n"))


ALL_SENTENCES, ALL_RULES = _by_rule()


def _terms_apart(text: Column) -> Column:
    """Every term of an SPDX expression behind a tag of its own; exceptions go."""
    tag = "SPDX-License-Identifier:"
    behind = rf"(?<={tag}[^\n]{{0,400}})[ \t)]+"
    single = F.regexp_replace(text, rf"{behind}WITH[ \t(]+[A-Za-z0-9.+-]+", "")
    single = F.regexp_replace(single, rf"{behind}(?:OR|AND)[ \t(]+", f". {tag} ")
    return F.when(F.contains(text, F.lit(tag)), single).otherwise(text)


def _identifiers(text: Column, sentences: dict[int, str]) -> Column:
    """The identifiers of the known sentences of a text, in order."""
    folded = {f: k for k, s in sentences.items() if (f := _folded(s))}
    words = [f.split() for f in folded]
    begins = sorted({" ".join(w[:n]) for w in words for n in range(1, len(w) + 1)})
    most = max(map(len, words), default=1)
    known = F.create_map(*[F.lit(x) for pair in folded.items() for x in pair])
    nothing = F.struct(F.lit(0).alias("free"), F.expr("cast(array() as array<int>)").alias("found"))

    def in_sentence(sentence: Column) -> Column:
        lines = F.split(sentence, "\n")

        def step(state: Column, i: Column) -> Column:
            run = lambda n: F.array_join(F.slice(lines, i + 1, n), " ")
            sizes = F.sequence(F.least(F.size(lines) - i, F.lit(most)), F.lit(1), F.lit(-1))
            fits = F.filter(sizes, lambda n: run(n).isin(list(folded)))
            longest = F.get(fits, F.lit(0))
            taken = F.struct(
                (i + longest).alias("free"),
                F.array_append(state["found"], F.element_at(known, run(longest))).alias("found"),
            )
            begun = (i >= state["free"]) & F.get(lines, i).isin(begins)
            return F.when(begun, F.when(F.size(fits) > 0, taken).otherwise(state)).otherwise(state)

        return F.aggregate(F.sequence(F.lit(0), F.size(lines) - 1), nothing, step, lambda state: state["found"])

    pieces = F.split(_spelled(_terms_apart(text)), "[.]")
    some = F.filter(pieces, lambda p: F.exists(F.split(p, "\n"), lambda line: line.isin(begins)))
    return F.flatten(F.transform(some, in_sentence))


def pattern(rule: LicenseRule) -> str:
    return "".join(f" {k} " for k in rule.sentences)


def _matched(identifiers: Column, rules: tuple[LicenseRule, ...]) -> Column:
    """(left, matches, licenses) after all rules; a match becomes a comma, which no rule crosses."""
    spelled = F.array_join(F.transform(identifiers, lambda k: F.concat(F.lit(" "), k.cast("string"), F.lit(" "))), "")
    listed = F.array(
        *[
            F.struct(
                F.lit(pattern(r)).alias("pattern"), F.lit(r.license).alias("license"), F.lit(r.sentences[0]).alias("first")
            )
            for r in rules
        ]
    )
    listed = F.filter(listed, lambda rule: F.array_contains(identifiers, rule["first"]))
    start = F.struct(
        spelled.alias("left"),
        F.lit(0).alias("matches"),
        F.expr("cast(array() as array<string>)").alias("licenses"),
    )

    def apply(state: Column, rule: Column) -> Column:
        after = F.replace(state["left"], rule["pattern"], F.lit(","))
        hits = ((F.length(state["left"]) - F.length(after)) / (F.length(rule["pattern"]) - 1)).cast("int")
        return F.struct(
            after.alias("left"),
            (state["matches"] + hits).alias("matches"),
            F.when(hits > 0, F.array_append(state["licenses"], rule["license"]))
            .otherwise(state["licenses"])
            .alias("licenses"),
        )

    return F.aggregate(listed, start, apply)


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sentences: dict[int, str] = ALL_SENTENCES,
    rules: tuple[LicenseRule, ...] = ALL_RULES,
) -> DataFrame:
    """(id, sentences, matches, licenses) of every row.

    ``sentences`` are the recognised identifiers in order, ``matches`` the number of rule matches,
    ``licenses`` the distinct licenses in order of name; empty lists for null, empty and
    unlicensed texts. Sentences of the list that no rule uses up count as recognised only. Rows
    are independent: null ids and repeated rows are kept. An empty table gives no rows; other
    columns are not read.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("id", _identifiers(F.col("text"), sentences).alias("sentences"))
    found = F.when(F.size("sentences") > 0, _matched(F.col("sentences"), rules))
    none = F.expr("cast(array() as array<string>)")
    return rows.select(
        F.col("id").alias(id_col),
        "sentences",
        F.coalesce(found["matches"], F.lit(0)).cast("long").alias("matches"),
        F.coalesce(F.array_sort(F.array_distinct(found["licenses"])), none).alias("licenses"),
    )
