"""Licences of files: found in their headers and licence files, or inherited by directory.

Comment marks are taken off and wrapped lines joined. Lines and windows of sentences that
speak of a licence, and licence files as a whole, are compared with templates by the
cosine of sparse TF-IDF vectors over the words of the templates; a word's weight comes
from the number of files that have it, counted over all files. The best template above a
threshold is the file's own licence. An SPDX identifier is taken as it stands, before any
template; a notice that reserves all rights counts if a file states nothing else. A file
without an own licence inherits from the nearest directory above it that has a licence
file: the directories, not the files, are joined with all directories above them by path.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from morphloom.llm.common import keep

THRESHOLD = 0.75
KNOWN = 4096  # passages whose score a task remembers
LONGEST = 4000  # characters of such a passage

# Usual statements of public licences.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *(
        (name, form.format(kind, version))
        for name, kind, version, date in (
            ("GPL-2.0", "General", "2", "June 1991"),
            ("GPL-3.0", "General", "3", "29 June 2007"),
            ("LGPL-2.1", "Lesser General", "2.1", "February 1999"),
            ("LGPL-3.0", "Lesser General", "3", "29 June 2007"),
            ("AGPL-3.0", "Affero General", "3", "19 November 2007"),
        )
        for form in (
            "GNU {} Public License Version {}, " + date,
            "This work is licensed under the GNU {} Public License, version {}.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version.",
            "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {} Public License version {} as published by the Free Software Foundation.",
        )
    ),
    *(
        (f"CC-BY{short}-4.0", form.format(short, long))
        for short, long in (
            ("", ""),
            ("-SA", "-ShareAlike"),
            ("-NC", "-NonCommercial"),
            ("-ND", "-NoDerivatives"),
            ("-NC-SA", "-NonCommercial-ShareAlike"),
            ("-NC-ND", "-NonCommercial-NoDerivatives"),
        )
        for form in (
            "Licensed under CC BY{0} 4.0.",
            "This work is licensed under a Creative Commons Attribution{1} 4.0 International License.",
        )
    ),
]

# Licences that begin with the same statement: the last of these clauses that follows
# tells them apart.
CLAUSES = [
    ("BSD-2-Clause", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-4-Clause", "All advertising materials mentioning features or use of this software must display the following acknowledgement."),
]
ALIKE = [name for name, _ in CLAUSES]

RESERVED = "All-Rights-Reserved"

_OF_LICENCE = r"licen[sc]e|permission\W+is\W+hereby\W+granted|redistribution\W+and\W+use"
CUE = rf"(?i){_OF_LICENCE}|permission\W+to\W+use|public\W+domain|all\W+rights\W+reserved"
LICENSE_FILE = r"(?i)(^|/)(licen[sc]e|copying)[^/]*$"

_CUE = re.compile(CUE)
_SPDX = re.compile(r"(?i)SPDX-License-Identifier:[ \t]*([\w.+:-]+(?:[ \t]+(?:AND|OR|WITH)[ \t]+[\w.+:-]+)*|\([^)\n]*\)[^\n*]*)")
_LATER = re.compile(r"(?i)(-only|-or-later|\+)$")
_OPENING = re.compile(r"(?:[ \t]*+(?:/\*+|\*+/?|//+|#+|--+|;+|%+|<!--|\"{3}|'{3}|\.\.[ ]|dnl\b|rem\b))*+[ \t]*+")
_ENDS = re.compile(r"\n\s*\n\s*|(?<=[.!?])\s+(?=[A-Z\"(])|(?<=:)\s*\n\s*|\n\s*(?:\d{1,2}[.)]|\(?[a-z]\))\s+")
_NOTICE = re.compile(r"(?i)(\.)|(copyright|\(c\)|©)|\ball(?=\W+rights\W+reserved)")
LINES = 12  # of a sentence, from which it is also read without what is before

_TERM = re.compile(r"[^\W_]+(?:\.\d+)*")


def terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


VOCABULARY = sorted({t for _, text in TEMPLATES + CLAUSES for t in terms(text)} | {"all", "rights", "reserved"})
_IDENTIFIERS = {name.lower(): name for name, _ in TEMPLATES + CLAUSES}


def identifier(text: str) -> str | None:
    """The SPDX identifier or expression that a text declares; the names of the templates
    stand for their ``only`` and ``or later`` forms."""
    found = _SPDX.search(text)
    if not found:
        return None
    parts = []
    for part in found.group(1).replace("(", "( ").replace(")", " )").split():
        known = _IDENTIFIERS.get(_LATER.sub("", part).lower())
        parts.append(known or (part.upper() if part.upper() in ("AND", "OR", "WITH") else part))
    return " ".join(parts).replace("( ", "(").replace(" )", ")")


def bare(text: str) -> str:
    """A text without comment marks and blanks at the ends of its lines."""
    out = []
    for line in text.split("\n"):
        line = line[_OPENING.match(line).end() :].rstrip(" \t\r")
        if line.endswith("*/"):
            line = line[:-1].rstrip("*")
        elif line.endswith("-->"):
            line = line[:-3]
        else:
            line = line.rstrip("*")
        out.append(line.rstrip(" \t"))
    return "\n".join(out)


def without_notice(sentence: str) -> str:
    """A sentence from where it reserves all rights on, if a copyright notice goes before
    without a full stop between them; else as it is. One pass."""
    noticed = False
    for m in _NOTICE.finditer(sentence):
        if m.lastindex is None and noticed:
            return sentence[m.start() :]
        if m.lastindex is not None:
            noticed = m.lastindex == 2
    return sentence


def passages(text: str, most_lines: int = LINES) -> tuple[list[str], list[str], list[str]]:
    """Of a text without comment marks: what may state a licence; the sentences that
    follow; and those that may reserve all rights, without the copyright notice."""
    sentences = [x for x in _ENDS.split(text) if x.strip()]
    short = {line: None for line in text.split("\n") if _CUE.search(line)}
    after: list[str] = []
    reserved = []
    for i, sentence in enumerate(sentences):
        if not _CUE.search(sentence):
            continue
        for first in range(max(0, i - 1), i + 1):
            for last in range(i, min(i + 3, len(sentences))):
                short[" ".join(sentences[first : last + 1])] = None
        lines = sentence.split("\n")
        for k in range(1, min(len(lines), most_lines)):
            short["\n".join(lines[k:])] = None
        after = after or sentences[i + 1 :]
        reserved.append(without_notice(sentence))
        reserved += [line for line in lines if _CUE.search(line)]
    return list(short), after, reserved


def document_frequencies(files: DataFrame) -> tuple[int, dict[str, int]]:
    """Number of files, and for each word of the templates how many files have it."""
    known = frozenset(VOCABULARY)

    def run(batches):
        place, n = {t: i for i, t in enumerate(VOCABULARY)}, np.zeros(len(VOCABULARY) + 1, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                n[-1] += 1
                for t in known.intersection(terms(text or "")):
                    n[place[t]] += 1
        yield pa.RecordBatch.from_pydict({"term": pa.array(range(len(n)), pa.int32()), "n": pa.array(n)})

    counts = files.select(F.col("text").cast("string")).mapInArrow(run, "term int, n long")
    found = dict(counts.groupBy("term").agg(F.sum("n")).collect())  # a row per word of the templates
    return found.get(len(VOCABULARY), 0), {t: found.get(i, 0) for i, t in enumerate(VOCABULARY)}


class Matcher:
    def __init__(self, n_files: int, frequency: dict[str, int], lines: int = LINES):
        self.lines = lines
        self.place = {t: i for i, t in enumerate(VOCABULARY)}
        self.idf = np.array([np.log((1 + n_files) / (1 + frequency[t])) + 1 for t in VOCABULARY])
        self.other = float(np.log(1 + n_files) + 1)  # of a word that no template has
        self.known: dict[tuple[int, str], tuple[str | None, float]] = {}
        self.groups = [
            self.group(texts) for texts in (TEMPLATES, CLAUSES, [(RESERVED, "All rights reserved.")])
        ]

    def group(self, texts: list[tuple[str, str]]) -> tuple[list[str], np.ndarray]:
        rows = np.array([self.vector(terms(text))[0] for _, text in texts])
        return [name for name, _ in texts], rows / np.sqrt((rows**2).sum(axis=1, keepdims=True))

    def vector(self, words: list[str]) -> tuple[np.ndarray, float]:
        """TF-IDF over the words of the templates, and the squared length with the others."""
        v, rest = np.zeros(len(self.idf)), {}
        for w in words:
            if w in self.place:
                v[self.place[w]] += 1
            else:
                rest[w] = rest.get(w, 0) + 1
        v = v * self.idf
        return v, float((v * v).sum() + sum((n * self.other) ** 2 for n in rest.values()))

    def nearest(self, passage: str, group: int) -> tuple[str | None, float]:
        """Template nearest to a passage; the first one of equals."""
        key = (group, passage)
        if key not in self.known:
            (names, rows), (v, squared) = self.groups[group], self.vector(terms(passage))
            near = rows @ v / np.sqrt(squared) if squared and v.any() else np.zeros(1)
            best = int((near >= near.max() - 1e-12).argmax())
            found = (names[best], float(near.max())) if near.max() > 0 else (None, 0.0)
            if len(passage) > LONGEST:
                return found
            if len(self.known) >= KNOWN:
                self.known.clear()
            self.known[key] = found
        return self.known[key]

    def best(self, passages: list[str], group: int = 0) -> tuple[str | None, float]:
        """Template nearest to any of the passages; ties go to the first passage."""
        name, score = None, 0.0
        for passage in passages:
            found, near = self.nearest(passage, group)
            if near > score + 1e-12:
                name, score = found, near
        return name, min(score, 1.0)

    def licence(self, text: str, whole: bool, threshold: float) -> tuple[str | None, float]:
        """What a text states, and its score; ``whole``: also as one passage."""
        declared = identifier(text)
        if declared:
            return declared, 1.0
        text = bare(text)
        short, after, reserved = passages(text, self.lines)
        name, score = self.best(short + [text] * whole)
        if score >= threshold:
            if name in ALIKE:
                clauses = [c for c, near in (self.nearest(x, 1) for x in after) if near >= threshold]
                name = max(clauses, key=ALIKE.index, default=name)
            return name, score
        name, score = self.best(reserved, 2)
        return (name, score) if score >= threshold else (None, 0.0)


def directory(path: Column) -> Column:
    """Path of the directory of a file, "" at the top."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def own_licenses(
    files: DataFrame, threshold: float = THRESHOLD, lines: int = LINES
) -> DataFrame:
    """(path, license, score) of files (path, text) that state a licence themselves."""
    matcher_args = document_frequencies(files)
    named = F.col("path").rlike(LICENSE_FILE)
    stated = files.where(F.col("text").rlike(CUE) | named).select("path", named.alias("named"), "text")
    schema = pa.schema([("path", pa.string()), ("license", pa.string()), ("score", pa.float64())])

    def run(batches):
        matcher = Matcher(*matcher_args, lines)
        for batch in batches:
            found = [
                (path, *matcher.licence(text or "", named, threshold))
                for path, named, text in zip(*(c.to_pylist() for c in batch.columns))
            ]
            found = [f for f in found if f[1] is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*found), schema.types)] if found
                else [pa.array([], t) for t in schema.types],
                schema=schema,
            )

    return stated.mapInArrow(run, "path string, license string, score double")


def inherited(directories: DataFrame, stated: DataFrame) -> DataFrame:
    """(dir, license, from_dir): for each directory the licence of the nearest directory
    that states one, itself or above it. ``stated`` is (dir, license)."""
    parts = F.split("dir", "/")
    above = F.transform(
        F.sequence(F.lit(0), F.when(F.col("dir") == "", 0).otherwise(F.size(parts))),
        lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("from_dir")),
    )
    steps = directories.select("dir", F.explode(above).alias("a")).select("dir", "a.depth", "a.from_dir")
    near = steps.join(stated.withColumnRenamed("dir", "from_dir"), "from_dir")
    best = near.groupBy("dir").agg(F.max(F.struct("depth", "from_dir", "license")).alias("best"))
    return best.select("dir", "best.license", "best.from_dir")


def scan(files: DataFrame, threshold: float = THRESHOLD, lines: int = LINES) -> DataFrame:
    """Per row of ``files`` (path, text): path, license, score, origin, from_dir.

    ``origin`` is ``own``, ``inherited`` or NULL with a NULL licence; ``score`` is the
    cosine of an own licence (1 for an SPDX identifier); ``from_dir`` the directory that an
    inherited one is from. A statement that is wrapped is read whole and from each of its
    first ``lines`` lines on, as what stands before it may belong to another sentence; the
    clauses that tell licences apart are looked for in all that follows the first statement.

    Several licence files in a directory: the best score counts, then the first name, and
    reserved rights only if none states a licence. A NULL text states nothing and inherits;
    a NULL path neither. Rows that repeat a path are one file's parts: the best statement
    of all of them counts for each. An empty table gives an empty result; other columns are
    ignored.
    """
    files = files.select(F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    own = own_licenses(files.where("path is not null"), threshold, lines)
    best = F.struct((F.col("license") == RESERVED).alias("r"), (-F.col("score")).alias("s"), "license")
    own = keep(
        own.groupBy("path")
        .agg(F.min(best).alias("b"))
        .select("path", F.col("b.license").alias("license"), (-F.col("b.s")).alias("score"))
    )
    stating = own.where(F.col("path").rlike(LICENSE_FILE)).withColumn("dir", directory(F.col("path")))
    stated = stating.groupBy("dir").agg(
        F.min(best).alias("b")
    ).select("dir", F.col("b.license").alias("license"))
    paths = files.select("path", directory(F.col("path")).alias("dir"))
    from_above = inherited(paths.select("dir").where("dir is not null").distinct(), stated)
    from_above = from_above.select("dir", F.col("license").alias("above"), "from_dir")
    joined = paths.join(own, "path", "left").join(from_above, "dir", "left")
    mine = F.col("license").isNotNull()
    return joined.select(
        "path",
        F.coalesce("license", "above").alias("license"),
        "score",
        F.when(mine, "own").when(F.col("above").isNotNull(), "inherited").alias("origin"),
        F.when(~mine, F.col("from_dir")).alias("from_dir"),
    )


def document_paths(docs: DataFrame) -> DataFrame:
    """Documents as files of a source tree: (doc_id, path, text).

    A source is a directory, a hundred thousand and a hundred ids are one below it. A
    document of up to 60 words that speaks of a licence is named as a licence file.
    """
    ids = F.col("doc_id").cast("long")
    group = [F.floor(ids / n).cast("string") for n in (100_000, 100)]
    short = F.col("text").rlike(f"(?i){_OF_LICENCE}") & (F.length("text") < 1000) & (F.size(F.split("text", r"\s+")) <= 60)
    name = F.when(short, F.concat(F.lit("LICENSE-"), ids.cast("string"))).otherwise(
        F.concat(ids.cast("string"), F.lit(".txt"))
    )
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), *group, name)
    return docs.select(ids.alias("doc_id"), F.when(ids.isNotNull(), path).alias("path"), "text")
