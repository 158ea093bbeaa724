"""Licences of files: cosine to notices, then what the nearest directory above says.

Every line of a text, and the text as a whole, is compared with the notices below by the cosine of
TF-IDF vectors. Document frequencies of the templates' terms are counted over all documents; a
term that no template has counts as one that no document has. A line is skipped without a sum only
if the terms it has could not reach the threshold for any notice (see ``Notices``).

Licence bodies and headers (``license_texts``) are compared with every run of as many terms, wherever
lines end; so are the notices, with runs that go over a line end. Such a block must have the terms
that tell its licence and version from others, and of blocks that overlap the best counts.

A file has the licence of its best line or block; a file without one inherits that of the nearest
directory above it that holds a licence file (by its name), found by joins on paths. Of several
licence files in a directory the one with the highest score counts, then the first path.

Null text counts as empty, a null path as a file outside all directories; null ``doc_id`` and repeated rows
are kept. Equal scores go to the notice that comes first, then to the first line. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import map_texts, pa_schema, slices
from postmill.llm.license_texts import BODIES, TITLES
from postmill.operators.joins import lookup
from postmill.session import stage

# SPDX ids and the notices by which files name them.
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License. See LICENSE in the project root for license information."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and dedicated this work to the public domain under CC0 1.0."),
    ("ISC", "Released under the ISC License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *[(x, f"SPDX-License-Identifier: {x}") for x in ("MIT", "Apache-2.0", "GPL-2.0", "GPL-3.0", "BSD-3-Clause", "MPL-2.0")],
    *TITLES,
]
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|unlicense|notice)([._-].*)?$"
THRESHOLD = 0.75
TERM = re.compile(r"[a-z0-9](?:[a-z0-9.+-]*[a-z0-9+])?")
NAMES = set(
    "mit apache gnu general lesser library affero bsd-style 2-clause 3-clause mozilla cc by by-sa by-nc creative commons cc0 "
    "isc unencumbered domain person charge granted".split()
)
TERMS = [TERM.findall(text.lower()) for *_, text in [*NOTICES, *BODIES]]
VOCABULARY = {t: i for i, t in enumerate(sorted({t for terms in TERMS for t in terms}))}


def _blocks() -> list[tuple[int, set[str], set[str]]]:
    """Number, terms it must have and must not have of every template of blocks; SPDX lines are none."""
    out = []
    for number, (_, text) in enumerate(NOTICES):
        if "SPDX" not in text:
            out.append((number, {t for t in TERMS[number] if t in NAMES or "attribution" in t or t[0].isdigit()}, set()))
    return out + [(len(NOTICES) + i, set(must.split()), set(never.split())) for i, (_, must, never, _) in enumerate(BODIES)]


LICENCES = [x[0] for x in [*NOTICES, *BODIES]]
BLOCKS = _blocks()


class Notices:
    """The notices, and the templates of blocks, as weighted vectors.

    ``telling`` holds the terms of which a line must have one: those with the highest weights,
    down to where what is left of every notice is too short for a cosine of ``threshold``.
    """

    def __init__(self, frequencies: list[int], documents: int, threshold: float = THRESHOLD):
        self.threshold = threshold
        self.weight = {t: math.log((1 + documents) / (1 + frequencies[i])) + 1 for t, i in VOCABULARY.items()}
        self.unknown = math.log(1 + documents) + 1
        vectors = []
        for licence, terms in zip(LICENCES, TERMS, strict=True):
            vector = {t: n * self.weight[t] for t, n in Counter(terms).items()}
            length = math.sqrt(sum(w * w for w in vector.values()))
            vectors.append((licence, {t: w / length for t, w in vector.items()}))
        self.vectors = vectors[: len(NOTICES)]
        # by the number of a term: its weight, and its part in the sum of each template; terms that are in none come last
        self.weights = np.array([self.weight[t] for t in VOCABULARY] + [self.unknown])
        self.parts = np.zeros((len(vectors), len(self.weights)))
        for part, (_, vector) in zip(self.parts, vectors, strict=True):
            for t, w in vector.items():
                part[VOCABULARY[t]] = w * self.weight[t]
        common = sorted({t for terms in TERMS[: len(NOTICES)] for t in terms}, key=lambda t: (self.weight[t], t))
        self.telling = set(common)
        for term in common:
            rest = self.telling - {term}
            if any(sum(w * w for t, w in v.items() if t not in rest) >= threshold**2 for _, v in self.vectors):
                break
            self.telling = rest

    def best(self, terms: list[str]) -> tuple[float, int]:
        """Highest cosine to a notice and its number."""
        counts = Counter(terms)
        own = {t: n * self.weight.get(t, self.unknown) for t, n in counts.items()}
        length = math.sqrt(sum(w * w for w in own.values()))
        scores = [sum(w * own[t] for t, w in v.items() if t in own) / length for _, v in self.vectors]
        number = max(range(len(scores)), key=lambda i: (round(scores[i], 9), -i))
        return round(scores[number], 9), number

    def blocks(self, terms: list[str], sizes: list[int]) -> list[tuple[float, int]]:
        """Score and number of the blocks in a text's terms; ``sizes`` has the terms of every line."""
        present = set(terms)
        able = [(i, must, never) for i, must, never in BLOCKS if must <= present]
        if not able:
            return []
        ids = np.fromiter((VOCABULARY.get(t, len(VOCABULARY)) for t in terms), np.intp, len(terms))
        lines = np.repeat(np.arange(len(sizes)), sizes)
        squares = np.concatenate([[0.0], np.cumsum(self.weights[ids] ** 2)])
        found = []
        for number, must, never in able:
            n = min(len(TERMS[number]), len(terms))
            sums = np.concatenate([[0.0], np.cumsum(self.parts[number][ids])])
            # of a run with repeated terms the cosine is lower than this
            most = (sums[n:] - sums[:-n]) / np.sqrt(squares[n:] - squares[:-n])
            reach = most >= self.threshold - 1e-9
            if number < len(NOTICES):
                reach &= lines[n - 1 :] != lines[: len(lines) - n + 1]
            starts = np.flatnonzero(reach)
            for group in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
                best = (0.0, 0)
                for at in sorted(group.tolist(), key=lambda at: -most[at]):
                    if most[at] <= best[0]:
                        break
                    counts = Counter(terms[at : at + n])
                    if must <= counts.keys() and never.isdisjoint(counts):
                        length = math.sqrt(sum((k * self.weight.get(t, self.unknown)) ** 2 for t, k in counts.items()))
                        best = max(best, (round(float(sums[at + n] - sums[at]) / length, 9), -at))
                if best[0] >= self.threshold:
                    found.append((best[0], number, -best[1], n - best[1]))
        # of those that overlap the best, then the first template
        taken: list[tuple[float, int, int, int]] = []
        for block in sorted(found, key=lambda f: (-f[0], f[1], f[2])):
            if all(block[3] <= other[2] or other[3] <= block[2] for other in taken):
                taken.append(block)
        return [block[:2] for block in taken]

    def read(self, text: str) -> tuple[str | None, float, list[str]]:
        """Licence and score of the best line, block or the whole text, and all licences its lines and blocks name."""
        found: list[tuple[float, int]] = []
        lines = text.lower().split("\n")
        every: list[str] = []
        sizes: list[int] = []
        for line in lines:
            terms = TERM.findall(line)
            every += terms
            sizes.append(len(terms))
            if not self.telling.isdisjoint(terms):
                found.append(self.best(terms))
        if len(lines) > 1 and found:
            found.append(self.best(every))
        found += self.blocks(every, sizes)
        good = [f for f in found if f[0] >= self.threshold]
        if not good:
            return None, max((f[0] for f in found), default=0.0), []
        score, number = max(good, key=lambda f: (f[0], -f[1]))
        return LICENCES[number], score, sorted({LICENCES[n] for _, n in good})


def term_frequencies(files: DataFrame) -> tuple[list[int], int]:
    """In how many texts each of the templates' terms is, and the number of texts."""
    types = pa_schema(files.sparkSession, "term int, texts long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(len(VOCABULARY) + 1, np.int64)
        known = VOCABULARY.keys()
        for batch in batches:
            for _, texts in slices(batch):
                for text in texts:
                    for term in known & set(TERM.findall(text.lower())):
                        totals[VOCABULARY[term]] += 1
                    totals[-1] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(totals)), pa.int32()), pa.array(totals)], schema=types)

    # one row per term of the templates
    rows = files.select("text").mapInArrow(count, "term int, texts long").groupBy("term").agg(F.sum("texts")).collect()
    totals = dict(map(tuple, rows))
    return [totals.get(i, 0) for i in range(len(VOCABULARY))], totals.get(len(VOCABULARY), 0)


def scan_files(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, path, own_license, own_score, named (all licences its lines and blocks name) of each file."""
    files = files.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("path").cast("string").alias("path"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    frequencies, documents = term_frequencies(files)
    made: dict[str, Notices] = {}  # once per task

    def work(batch, texts):
        if not made:
            made["here"] = Notices(frequencies, documents, threshold)
        notices = made["here"]
        own, score, named = zip(*map(notices.read, texts), strict=True)
        return {
            "doc_id": batch.column("doc_id").to_pylist(),
            "path": batch.column("path").to_pylist(),
            "own_license": list(own),
            "own_score": list(score),
            "named": [",".join(n) for n in named],
        }

    return map_texts(files, work, "doc_id long, path string, own_license string, own_score double, named string")


def directory_of(path: Column) -> Column:
    return F.when(F.contains(path, F.lit("/")), F.regexp_extract(path, "^(.*)/[^/]*$", 1)).otherwise(F.lit(""))


def inherited(files: DataFrame) -> DataFrame:
    """Scanned files with license, license_path (whose licence it is) and levels (directories up)."""
    files = files.withColumn("dir", F.when(F.col("path").isNotNull(), directory_of(F.col("path"))))
    name = F.regexp_extract("path", "([^/]*)$", 1)
    holders = files.filter(F.col("own_license").isNotNull() & F.col("path").isNotNull() & name.rlike(LICENCE_FILE))
    # per directory, the highest score, then the first path
    best = F.min_by(F.struct("own_license", "path"), F.struct(-F.col("own_score"), "path", "own_license"))
    holders = holders.groupBy(F.col("dir").alias("above")).agg(best.alias("holder"))
    # every directory once, with all directories above it
    dirs = files.select("dir").filter("dir is not null").distinct()
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(
        F.array_join(F.slice(parts, F.lit(1), F.size(parts) - n), "/").alias("above"), n.alias("levels")
    ))
    chain = dirs.select("dir", F.inline(above)).join(holders, "above")
    nearest = chain.groupBy("dir").agg(F.min_by(F.struct("holder", "levels"), "levels").alias("near"))
    rows = lookup(files, nearest, ["dir"])
    own = F.col("own_license").isNotNull()
    return rows.select(
        "doc_id",
        "path",
        "own_license",
        "own_score",
        "named",
        F.coalesce("own_license", "near.holder.own_license").alias("license"),
        F.when(own, F.col("path")).otherwise(F.col("near.holder.path")).alias("license_path"),
        F.when(own, 0).otherwise(F.col("near.levels")).alias("levels"),
    )


def licenses(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Own and inherited licences of files (doc_id, path, text)."""
    return inherited(stage(scan_files(files, threshold), "licenses"))
