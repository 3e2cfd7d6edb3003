import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from morphloom.llm import licenses as li

MIT = "Released under the MIT License."
GPL = "This work is licensed under the GNU General Public License, version 3."


def test_inheritance_and_edges(spark):
    rows = [
        ("LICENSE", "some words\n" + MIT),
        ("a/x.txt", "nothing here"),
        ("a/b/COPYING", GPL),
        ("a/b/c/d/y.txt", None),
        ("a/b/z.txt", "text\nLicensed under CC BY-NC 4.0.\nmore"),
        ("ab/y.txt", ""),
        ("a/license.md", "a licence of no known kind at all"),
        (None, MIT),
        ("a/x.txt", "nothing here"),
        ("a/plain.txt", "my licence to fish in this river was lost"),
    ]
    df = spark.createDataFrame(rows, "path string, text string").withColumn("license", F.lit("clash"))
    got = [(r.path, r.license, r.origin, r.from_dir) for r in li.scan(df).collect()]
    want = [
        ("LICENSE", "MIT", "own", None),
        ("a/x.txt", "MIT", "inherited", ""),
        ("a/b/COPYING", "GPL-3.0", "own", None),
        ("a/b/c/d/y.txt", "GPL-3.0", "inherited", "a/b"),
        ("a/b/z.txt", "CC-BY-NC-4.0", "own", None),
        ("ab/y.txt", "MIT", "inherited", ""),
        ("a/license.md", "MIT", "inherited", ""),
        (None, None, None, None),
        ("a/x.txt", "MIT", "inherited", ""),
        ("a/plain.txt", "MIT", "inherited", ""),
    ]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert li.scan(df.limit(0)).collect() == []


HEADERS = {
    "Apache-2.0": """Copyright 2020 Some Body

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS.""",
    "MIT": """The MIT License (MIT)

Copyright (c) 2026 Some Body. All rights reserved.

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.""",
    "GPL-3.0": """This file is part of a tool

This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "BSD-2-Clause": """Copyright (c) The Body.
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:
1. Redistributions of source code must retain the above copyright
   notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
""",
}
HEADERS["BSD-3-Clause"] = HEADERS["BSD-2-Clause"] + """3. Neither the name of the University nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.
"""
HEADERS |= {
    "GPL-2.0": HEADERS["GPL-3.0"].replace("version 3", "version 2"),
    "AGPL-3.0": HEADERS["GPL-3.0"].replace("GNU General", "GNU Affero General"),
    "LGPL-2.1": HEADERS["GPL-3.0"].replace("GNU General", "GNU Lesser General").replace("version 3", "version 2.1"),
}
REST = "\n\n" + "Some prose of the file that says nothing of the kind, at some length. " * 20


def test_headers_and_whole_texts(spark):
    rows, want = [], {}

    def add(name, text, license):
        rows.append((name, text))
        want[name] = license

    for name, text in HEADERS.items():
        for mark, close in (("", ""), ("# ", ""), ("// ", ""), (" * ", "\n */")):
            marked = "\n".join(mark + line for line in text.split("\n")) + close
            add(f"{name}{mark.strip().replace('/', 's')}.c", marked + REST, name)
        add(f"{name}/LICENSE", text, name)
    for said, name in (
        ("// SPDX-License-Identifier: MIT", "MIT"),
        ("# SPDX-License-Identifier: apache-2.0", "Apache-2.0"),
        ("/* SPDX-License-Identifier: GPL-2.0-or-later */", "GPL-2.0"),
        ("# SPDX-License-Identifier: Zlib", "Zlib"),
        ("# SPDX-License-Identifier: (MIT OR Apache-2.0)", "(MIT OR Apache-2.0)"),
        ("words before.\nAll rights reserved.\nand after", li.RESERVED),
        ("Copyright (c) 2024 Some Body, all rights reserved.", li.RESERVED),
        ("Copyright 2024 Some Body. All rights\nreserved.", li.RESERVED),
        ("All rights reserved.\n" + MIT, "MIT"),
        ("They said that all rights reserved for the crown were lost in the long war of that time.", None),
        ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
    ):
        add(f"spdx/{len(rows)}.c", said + REST, name)
    rows += [(f"filler/{i}", "Some prose that says nothing of the kind.") for i in range(200)]
    df = spark.createDataFrame(rows, "path string, text string")
    got = {r.path: r.license for r in li.scan(df).where("origin = 'own'").collect()}
    assert got == {k: v for k, v in want.items() if v}


def test_reserved_rights_give_way(spark):
    rows = [("LICENSE", "All rights reserved."), ("LICENSE-2", MIT + " indeed"), ("a/x", "y"), ("b/LICENSE", "All rights reserved."), ("b/x", "")]
    got = {r.path: r.license for r in li.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert got["a/x"] == "MIT" and got["b/x"] == got["LICENSE"] == li.RESERVED


def test_cosine_against_plain_arithmetic(spark):
    texts = [MIT, GPL + " indeed", "the license", None, "the", "version version"]
    files = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "path string, text string")
    n, frequency = li.document_frequencies(files)
    assert n == 6 and frequency["the"] == 4 and frequency["version"] == 2 and frequency["mit"] == 1
    passage = GPL + " indeed"

    def weights(text):
        found = {}
        for t in li.terms(text):
            found[t] = found.get(t, 0) + np.log(7 / (1 + frequency.get(t, 0))) + 1
        return found

    def cosine(a, b):
        dot = sum(x * b.get(t, 0) for t, x in a.items())
        return dot / np.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))

    want = max((cosine(weights(passage), weights(t)), name) for name, t in li.TEMPLATES)
    name, score = li.Matcher(n, frequency).best([passage])
    assert name == want[1] and abs(score - want[0]) < 1e-9


def by_patterns(text):
    """Comment marks and notices taken off by one pattern each, of unbounded cost."""
    marks = re.compile(
        r"(?m)^(?:[ \t]*(?:/\*+|\*+/?|//+|#+|--+|;+|%+|<!--|\"{3}|'{3}|\.\.[ ]|dnl\b|rem\b))*[ \t]*"
        r"|[ \t]*(?:\*+/|-->|\*+)?[ \t\r]*$"
    )
    notice = re.compile(r"(?is)^.*?(?:copyright|\(c\)|©)[^.]*?(?=\ball\W+rights\W+reserved)")
    return marks.sub("", text), notice.sub("", text)


def test_marks_and_notices_as_by_patterns():
    rng = random.Random(1)
    marks = ["/*", "*/", "**", "//", "#", "--", ";", "%", "<!--", "-->", " ", "  ", "\t", "\r", "\n", "a", "dnl", "rem", ".. ", "word", "'" * 3]
    words = ["Copyright", "(c)", "©", " ", ". ", "all rights reserved", "All  Rights\nReserved", "x", "all", "tall rights reserved"]
    for _ in range(3000):
        text = "".join(rng.choice(marks) for _ in range(rng.randint(0, 14)))
        assert li.bare(text) == by_patterns(text)[0], repr(text)
        text = "".join(rng.choice(words) for _ in range(rng.randint(0, 10)))
        assert li.without_notice(text) == by_patterns(text)[1], repr(text)


def matcher():
    return li.Matcher(100, dict.fromkeys(li.VOCABULARY, 5))


@pytest.mark.parametrize(
    "text",
    [
        "license" + " " * 100_000 + "x",
        "license " + "(c) " * 100_000,
        "all rights reserved " * 50_000,
        "license " + "x" * 5_000_000,
        "license\n" * 20_000,
        "license." + "\n" * 100_000 + "y",
    ],
    ids=["blanks", "notices", "reserved", "line", "lines", "breaks"],
)
def test_odd_texts_in_linear_time(text):
    own = matcher()
    start = time.time()
    own.licence(text, False, li.THRESHOLD)
    assert time.time() - start < 3


def test_clause_far_behind_its_statement():
    """A clause that tells licences apart counts wherever it follows."""
    text = li.TEMPLATES[4][1] + " Nothing here." + " One more sentence." * 40 + " "
    assert matcher().licence(text + li.CLAUSES[1][1], False, li.THRESHOLD)[0] == "BSD-3-Clause"
    assert matcher().licence(text + li.CLAUSES[0][1], False, li.THRESHOLD)[0] == "BSD-2-Clause"
