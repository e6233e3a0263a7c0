from velomart.llm import licenses

MIT = """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
See the License for the specific language governing permissions and limitations under the License."""
CASES = [
    ("Some text. Released under the MIT License.\nMore", [1], 1, ["MIT"]),
    ("released  under the mit-license", [1], 1, ["MIT"]),
    ("Released under the MIT License later", [], 0, []),
    ("All rights reserved. All rights reserved.", [20, 20], 2, ["LicenseRef-All-rights-reserved"]),
    ("Licensed under CC BY-NC 4.0. Licensed under the Apache License, Version 2.0.", [14, 4], 2, ["Apache-2.0", "CC-BY-NC-4.0"]),
    ("# SPDX-License-Identifier: MIT\ncode", [29, 30], 1, ["MIT"]),
    ("MIT. SPDX-License-Identifier", [30, 29], 0, []),
    (MIT, [21, 22, 23], 1, ["MIT"]),
    (APACHE, [5, 6, 8], 1, ["Apache-2.0"]),
    ("This program is free software: you can redistribute it", [10], 0, []),
    (None, [], 0, []),
    ("", [], 0, []),
    ("word. " * 50_000 + "All rights reserved", [20], 1, ["LicenseRef-All-rights-reserved"]),
]


def test_cases(spark):
    df = spark.createDataFrame([(k, c[0], "x") for k, c in enumerate(CASES)], "doc_id long, text string, sentences string")
    for r in licenses.scan(df).collect():
        assert (r.sentences, r.matches, r.licenses) == CASES[r.doc_id][1:], CASES[r.doc_id][0]


def test_repeated_rows_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "All rights reserved"), (None, "All rights reserved")], "doc_id long, text string")
    assert [r.matches for r in licenses.scan(df).collect()] == [1, 1]
    assert licenses.scan(df.limit(0)).collect() == []


def test_rules_name_known_sentences_that_are_one_sentence():
    import re

    assert all(k in licenses.SENTENCES for rule in licenses.RULES for k in rule.sentences)
    for text in licenses.SENTENCES.values():
        assert len([p for p in re.split(licenses.SENTENCE_END, text) if p.strip()]) == 1, text


GPL_2 = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
GPL_3 = GPL_2.replace("software;", "software:").replace("Foundation;", "Foundation,").replace("version 2", "version 3")
LGPL = GPL_2.replace("program", "library").replace("GNU General", "GNU Lesser General").replace("version 2", "version 2.1")
AGPL = GPL_3.replace("GNU General", "GNU Affero General")
APACHE_HEADER = """Copyright 2020 Somebody

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
BSD = """Copyright (c) 2020, Somebody
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
BSD_3 = """

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
EPL = """This program and the accompanying materials are made
available under the terms of the Eclipse Public License 2.0
which is available at https://www.eclipse.org/legal/epl-2.0/

SPDX-License-Identifier: EPL-2.0"""
UNLICENSE = """This is free and unencumbered software released into the
public domain."""


def wrapped(text, width):
    import textwrap

    return "\n".join(textwrap.fill(line, width) for line in text.split("\n"))


LONG = [
    *[(wrapped(MIT, width), [21, 22, 23], 1, ["MIT"]) for width in (40, 72, 80)],
    (APACHE_HEADER, [5, 6, 7, 8], 1, ["Apache-2.0"]),
    (GPL_2, [10, 36, 39, 12, 13], 1, ["GPL-2.0-or-later"]),
    (GPL_3, [10, 11, 12, 13], 1, ["GPL-3.0-or-later"]),
    (LGPL, [37, 40], 1, ["LGPL-2.1-or-later"]),
    (AGPL, [10, 45, 12], 1, ["AGPL-3.0-or-later"]),
    (BSD, [20, 24, 34, 35], 2, ["BSD-2-Clause", "LicenseRef-All-rights-reserved"]),
    (BSD + BSD_3, [20, 24, 34, 35, 25], 2, ["BSD-3-Clause", "LicenseRef-All-rights-reserved"]),
    (ISC, [26], 1, ["ISC"]),
    (MPL, [27], 1, ["MPL-2.0"]),
    (EPL, [47, 29, 55], 2, ["EPL-2.0"]),
    (UNLICENSE, [49], 1, ["Unlicense"]),
]
LEADERS = ("", "# ", " * ", "// ", ";; ", "-- ", "   ")


def wrapped_cases():
    cases = [
        ("\n".join((lead + line).rstrip() if lead.strip() else lead + line for line in text.split("\n")), *expected)
        for text, *expected in LONG
        for lead in LEADERS
    ]
    cases += [(case[0].replace("\n", "\r\n"), *case[1:]) for case in cases]
    return [(f"/*\n{text}\n*/\nint main;", *expected) for text, *expected in cases]


def test_wrapped_texts_with_and_without_comment_leaders(spark):
    cases = wrapped_cases()
    df = spark.createDataFrame([(k, c[0]) for k, c in enumerate(cases)], "doc_id long, text string")
    got = licenses.scan(df).collect()
    assert len(got) == len(cases)
    for r in got:
        assert (r.sentences, r.matches, r.licenses) == cases[r.doc_id][1:], cases[r.doc_id][0]


def test_lines_between_other_lines_and_blank_lines(spark):
    cases = [
        ("a line\nLicensed under CC BY 4.0\nanother line", [15]),
        ("Licensed under\nCC BY 4.0\nLicensed under CC BY 4.0", [15, 15]),
        ("Licensed under\n\nCC BY 4.0", [33]),
        ("Not licensed under\nCC BY 4.0", [33]),
        ("Licensed under the Apache License, Version 2.0\n(the \"License\")", [5]),
        ("Licensed under the Apache License, Version 2.0\nand more", [4]),
        ("x\x02All rights reserved", []),
    ]
    df = spark.createDataFrame([(k, c[0]) for k, c in enumerate(cases)], "doc_id long, text string")
    for r in licenses.scan(df).collect():
        assert r.sentences == cases[r.doc_id][1], cases[r.doc_id][0]


NAMED = [
    ("// SPDX-License-Identifier: GPL-2.0\nint x;", ["GPL-2.0-only"]),
    ("SPDX-License-Identifier: BSL-1.0", ["BSL-1.0"]),
    ("# SPDX-License-Identifier: Apache-2.0 OR MIT", ["Apache-2.0", "MIT"]),
    ("/* SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) OR BSD-3-Clause */", ["BSD-3-Clause", "GPL-2.0-only"]),
    ("SPDX-License-Identifier: MIT AND Zlib AND ISC\nMore", ["ISC", "MIT", "Zlib"]),
    ("SPDX-License-Identifier: Nobody-1.0 OR MIT", ["MIT"]),
    ("Cats OR MIT", []),
    ("Released under the BSD 3-Clause License.", ["BSD-3-Clause"]),
    ("The MIT License (MIT)\n\nCopyright", ["MIT"]),
    ("This work is licensed under CC BY 4.0", ["CC-BY-4.0"]),
    ("Distributed under the Boost\nSoftware License,\nVersion 1.0.", ["BSL-1.0"]),
    ("This software is released under the zlib License", ["Zlib"]),
    ("Licensed under CC0 1.0", ["CC0-1.0"]),
]


def test_spdx_expressions_and_cited_names(spark):
    df = spark.createDataFrame([(k, c[0]) for k, c in enumerate(NAMED)], "doc_id long, text string")
    for r in licenses.scan(df).collect():
        assert r.licenses == NAMED[r.doc_id][1], NAMED[r.doc_id][0]


def test_every_known_sentence_is_found_alone_and_in_a_text(spark):
    assert len(licenses.ALL_SENTENCES) >= 300
    rows = [(k, s) for k, s in licenses.ALL_SENTENCES.items()]
    rows += [(k, f"Before this.\n# {wrapped(s, 50).replace(chr(10), chr(10) + '# ')}\n# and after") for k, s in rows]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows) and all(r.sentences == [r.doc_id] for r in found)


def test_the_twin_on_wrapped_and_odd_texts(spark):
    import duckdb

    from velomart.llm import sql

    texts = [c[0] for c in [*CASES, *NAMED, *wrapped_cases()]]
    texts += ["a\n\nb", "\n\n", "MIT\n.\nMIT", "Licensed under\nthe\nMIT\nLicense\nAll rights\nreserved", "x:\nSPDX-License-Identifier:\nMIT"]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = licenses.scan(df).collect()
    spelled = sorted((r.doc_id, ",".join(map(str, r.sentences)), r.matches, ",".join(r.licenses)) for r in got)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert sorted(con.execute(sql.LICENSES).fetchall()) == spelled
