"""License scan: TF-IDF cosine to templates, and inheritance from the nearest directory.

A header line with an SPDX identifier says what the licence is. Headers: every run of as many words as a template has is a candidate; its sparse TF-IDF
vector is compared to the template's. Words that tell licences of a family apart and version
numbers weigh little in a cosine, so they must be the same. Only runs around words that a template cannot do
without are looked at: the other words together cannot reach the threshold (Cauchy-Schwarz).
A file with a licence file's name is compared as a whole as well.

Paths: licence files give their directory a licence. Every directory that holds files looks
up all its ancestors by an equality join and takes the nearest one with a licence; files
without a header of their own take their directory's.

Edge cases: null and empty texts match nothing and still inherit. A file without a path is in
no directory. Several licence files in one directory: the highest score, then the smallest
name of a licence. Repeated rows give repeated rows; paths may repeat. An empty table gives an empty result. Other columns
are kept whatever their names, but for those of the result, which are replaced. Very long texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldergrid.llm.common import small_batches, texts_of
from foldergrid.session import cut_lineage

# fixed values: SPDX identifiers and the notices that stand for them, versions and members of a family side by side; of
# full texts the openings or the sections that tell them apart
GNU = [
    ("GPL-2.0", "General Public License", "2", "June 1991"), ("GPL-3.0", "General Public License", "3", "29 June 2007"),
    ("LGPL-2.0", "Library General Public License", "2", "June 1991"), ("LGPL-2.1", "Lesser General Public License", "2.1", "February 1999"),
    ("LGPL-3.0", "Lesser General Public License", "3", "29 June 2007"), ("AGPL-3.0", "Affero General Public License", "3", "19 November 2007"),
]
_GNU_HEADER = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, "
CREATIVE_COMMONS = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES"
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
TEMPLATES = [
    *[(f"{name}-or-later", _GNU_HEADER.format(family) + f"either version {version} of the License, or (at your option) any later version.") for name, family, version, _ in GNU],
    *[(f"{name}-only", _GNU_HEADER.format(family) + f"version {version} of the License.") for name, family, version, _ in GNU],
    *[(f"{name}-only", f"This work is licensed under the GNU {family}, version {version}") for name, family, version, _ in GNU],
    *[(f"{name}-or-later", f"This work is licensed under the GNU {family}, version {version} or later") for name, family, version, _ in GNU],
    *[(f"{name}-only", f"GNU {family} Version {version}, {date} Copyright (C) Free Software Foundation, Inc.") for name, family, version, date in GNU],
    *[(f"CC-{kind}-{version}", f"Licensed under CC {kind} {version}") for kind in CREATIVE_COMMONS for version in ("4.0", "3.0")],
    *[(f"CC-{kind}-4.0", f"This work is licensed under a Creative Commons {name} 4.0 International License") for kind, name in CREATIVE_COMMONS.items()],
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("BSD-2-Clause", _BSD + _BSD_END),
    ("BSD-3-Clause", _BSD + _BSD_NAMES + _BSD_END),
    ("ISC", _ISC + ", provided that the above copyright notice and this permission notice appear in all copies."),
    ("0BSD", _ISC + ". THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
]
# what tells the members of a family apart: words, and version numbers after a word that names a version or a licence
MARKS = frozenset(b"affero appear endorse later lesser nc nd noncommercial noderivatives sa sharealike".split())
VERSION_AFTER = frozenset(b"version v license licence by nc nd sa attribution noncommercial noderivatives sharealike".split())
# function words, which stand in every text: anchors only where nothing else is left
FUNCTION_WORDS = frozenset(
    b"a all an and any are as at be by can for from have i if in is it its may no not of on or that the this to was with you your".split()
)
LICENSE_NAMES = ("license", "licence", "copying", "notice", "unlicense")
THRESHOLD = 0.85
# a line of the kind `SPDX-License-Identifier: MIT`: identifiers, joined by operators, maybe in parentheses
TAG = "SPDX-License-Identifier:"
_NAME = r"\(?[A-Za-z0-9][A-Za-z0-9.+-]*\)?"
_EXPRESSION = re.compile(rf"[ \t]*({_NAME}(?:[ \t]+(?:AND|OR|WITH)[ \t]+{_NAME})*)")
_BLANK = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_BLANK).split()


def tag_of(text: str | None) -> tuple[str, float, int, int] | None:
    """The licence that a header line names by its identifier, as `best` gives it. The first such line
    counts, and the expression as it stands there (MIT OR Apache-2.0)."""
    at = (text or "").find(TAG)
    if at < 0:
        return None
    found = _EXPRESSION.match(text, at + len(TAG))
    if found is None:
        return None
    first = len(words_of(text[:at]))
    return " ".join(found[1].split()), 1.0, first, first + len(words_of(text[at : found.end(1)]))


def marks_of(words: list[bytes]) -> set[bytes]:
    """The distinguishing words of a run, and its version numbers without zeros after the point."""
    marks = set(MARKS.intersection(words))
    for i, word in enumerate(words[1:], 1):
        if word == b"general" and words[i - 1] == b"library":
            marks.add(b"library general")
        elif len(word) == 1 and word.isdigit() and words[i - 1] in VERSION_AFTER:
            minor = words[i + 1] if i + 1 < len(words) else b"0"
            marks.add(word + b"." + minor if len(minor) == 1 and minor.isdigit() and minor != b"0" else word)
    return marks


class Vector(dict):
    """word -> weight, and the marks that a run must share."""

    marks: set[bytes] = set()


class Matcher:
    """Sparse unit vectors of the templates."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float = THRESHOLD):
        split = [(name, words_of(text)) for name, text in templates]
        split = [(name, words) for name, words in split if words]
        df = Counter(word for _, words in split for word in set(words))
        self.threshold = threshold
        self.unseen = math.log(1 + len(split)) + 1
        self.idf = {word: math.log((1 + len(split)) / (1 + n)) + 1 for word, n in df.items()}
        self.items = []
        for name, words in split:
            vector = {w: c * self.idf[w] for w, c in Counter(words).items()}
            norm = math.sqrt(sum(v * v for v in vector.values()))
            unit = Vector({w: v / norm for w, v in vector.items()})
            unit.marks = marks_of(words)
            # a template's anchors: words of weight, of equal ones the longest, until the others stay
            # below the threshold together
            anchors, rest = set(), 1.0
            for word in sorted(unit, key=lambda w: (w in FUNCTION_WORDS, -unit[w], -len(w), w)):
                if rest < threshold**2 - 1e-9:
                    break
                anchors.add(word)
                rest -= unit[word] ** 2
            self.items.append((name, len(words), unit, anchors))
        self.anchors = set().union(*(anchors for *_, anchors in self.items))

    def cosine(self, words: list[bytes], vector: Vector) -> float:
        """0 if the marks differ: another version or another member of the family."""
        if marks_of(words) != vector.marks:
            return 0.0
        dot, square = 0.0, 0.0
        for word, count in Counter(words).items():
            value = count * self.idf.get(word, self.unseen)
            square += value * value
            dot += value * vector.get(word, 0.0)
        return dot / math.sqrt(square) if square else 0.0

    def best(self, text: str | None, whole: bool = False) -> tuple[str, float, int, int] | None:
        """(license, score, first word, end) of the best match at or above the threshold; of
        equal scores the longer template, then the earlier place."""
        tagged = tag_of(text)
        if tagged is not None:
            return tagged
        words, found = words_of(text), None
        hits = [i for i, w in enumerate(words) if w in self.anchors] if not self.anchors.isdisjoint(words) else []
        if not hits:
            return None
        present = set(words)
        for name, size, vector, anchors in self.items:
            # the words of the whole text bound what any run can reach
            if sum(vector[w] ** 2 for w in vector.keys() & present) < self.threshold**2 - 1e-9:
                continue
            starts = sorted({s for i in hits if words[i] in anchors for s in range(max(i - size + 1, 0), i + 1)})
            for start in starts:
                run = words[start : start + size]
                if len(run) < size and start:
                    continue  # a shorter end of the text is part of the run before it
                score = self.cosine(run, vector)
                rank = (round(score, 9), size, -start)
                if score >= self.threshold and (found is None or rank > found[0]):
                    found = (rank, (name, score, start, start + len(run)))
            if whole:
                score = self.cosine(words, vector)
                if score >= self.threshold and (found is None or (round(score, 9), size, 0) > found[0]):
                    found = ((round(score, 9), size, 0), (name, score, 0, len(words)))
        return found and found[1]


def match(text: Column, whole: Column, matcher: Matcher) -> Column:
    """struct<license, score, first_word, end_word> of a text, or null."""
    kind = pa.struct([("license", pa.string()), ("score", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64())])

    @F.arrow_udf("struct<license: string, score: double, first_word: bigint, end_word: bigint>")
    def matched(texts: pa.Array, wholes: pa.Array) -> pa.Array:
        names = [f.name for f in kind]
        hits = (matcher.best(t, w) for t, w in zip(texts_of(texts), wholes.to_pylist()))
        return pa.array([hit and dict(zip(names, hit)) for hit in hits], kind)

    return matched(text, whole)


def directory_of(path: Column) -> Column:
    """The path without its last segment; null for a null path."""
    return F.regexp_replace(path, r"/?[^/]*\z", "")


def is_license_file(path: Column) -> Column:
    """A name that is one of the words before its first dot, or starts or ends with one of them at
    - _ . (LICENSE-MIT, MIT-LICENSE.txt) and has no other extension than a text's."""
    name = F.lower(F.regexp_extract(path, r"[^/]*\z", 0))
    words, stem = "|".join(LICENSE_NAMES), r"\.(txt|text|md|rst|html?)\z"
    bare = F.regexp_replace(name, stem, "")
    code = bare.rlike(r"\.[a-z]+\z") & ~bare.rlike(rf"\.({words})\z")
    part = bare.rlike(rf"\A({words})([-_.]|\z)") | bare.rlike(rf"[-_.]({words})\z")
    return F.coalesce(name.rlike(rf"\A({words})(\.|\z)") | (part & ~code), F.lit(False))


def scan(
    files: DataFrame, path: str = "path", text: str = "text", templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD,
) -> DataFrame:
    """`files` with `own_license`, `own_score`, `license` (its own or the inherited one) and
    `license_from` (the directory it was inherited from). The text column is left out."""
    small_batches(files.sparkSession)
    matcher = Matcher(templates or TEMPLATES, threshold)
    names = [c for c in files.columns if c not in (text, "own_license", "own_score", "license", "license_from")]
    own_path = F.col(f"`{path}`")
    # the input's own columns travel in one struct, so none of their names matters; texts are read once
    judged = cut_lineage(files.select(
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]).alias("_file"),
        own_path.alias("_path"), directory_of(own_path).alias("_dir"),
        match(F.col(f"`{text}`"), is_license_file(own_path), matcher).alias("_m"),
    ))
    given = (
        judged.where(is_license_file(F.col("_path")) & F.col("_m").isNotNull())
        .groupBy("_dir").agg(F.min(F.struct((-F.col("_m.score")).alias("s"), F.col("_m.license").alias("license"))).alias("_best"))
        .select(F.col("_dir").alias("_from"), F.col("_best.license").alias("_inherited"))
    )
    # each directory with files looks for its ancestors: itself, every parent, and the root ""
    parents = judged.where(F.col("_dir").isNotNull()).select("_dir").distinct().select(
        F.col("_dir").alias("_of"),
        F.explode(F.expr("transform(sequence(0, if(_dir = '', 0, size(split(_dir, '/')))), n -> array_join(slice(split(_dir, '/'), 1, n), '/'))")).alias("_up"),
    )
    nearest = (
        parents.join(given, F.col("_up") == F.col("_from"))
        .groupBy("_of").agg(F.max(F.struct(F.length("_from").alias("n"), "_from", "_inherited")).alias("_near"))
        .select("_of", F.col("_near._from").alias("_from"), F.col("_near._inherited").alias("_inherited"))
    )
    return judged.join(nearest, F.col("_dir") == F.col("_of"), "left").select(
        *[F.col(f"_file.c{i}").alias(c) for i, c in enumerate(names)],
        F.col("_m.license").alias("own_license"), F.col("_m.score").alias("own_score"),
        F.coalesce("_m.license", "_inherited").alias("license"),
        F.when(F.col("_m").isNull(), F.col("_from")).alias("license_from"),
    )
