"""Licences against cosines summed in full, and inheritance by walking up."""

import math
import random
import textwrap
from collections import Counter

import pytest
from pyspark.sql import functions as F

from postmill.llm import license_scan as scan
from postmill.llm import license_texts as texts
from postmill.llm.queries import QUERIES
from tests.llm.conftest import SF


def plain_best(line, frequencies, documents):
    def vector(text):
        return {
            t: n * (math.log((1 + documents) / (1 + frequencies[scan.VOCABULARY[t]])) + 1 if t in scan.VOCABULARY else math.log(1 + documents) + 1)
            for t, n in Counter(scan.TERM.findall(text.lower())).items()
        }

    own, best = vector(line), (0.0, None)
    for licence, text in scan.NOTICES:
        other = vector(text)
        lengths = math.sqrt(sum(w * w for w in own.values()) * sum(w * w for w in other.values()))
        score = round(sum(w * other.get(t, 0) for t, w in own.items()) / lengths, 9) if lengths else 0.0
        if score > best[0]:
            best = (score, licence)
    return best


def test_no_line_is_skipped_that_would_count():
    r = random.Random(6)
    documents = 500
    frequencies = [r.choice([0, 2, 40, 400]) for _ in scan.VOCABULARY]
    notices = scan.Notices(frequencies, documents)
    terms = sorted(scan.VOCABULARY)
    for _ in range(3000):
        words = r.choice(scan.NOTICES)[1].split()
        line = " ".join(w if r.random() > 0.25 else r.choice([*terms, "zebra"]) for w in words)
        score, licence = plain_best(line, frequencies, documents)
        own, got, _ = notices.read(line)
        if score >= scan.THRESHOLD:
            assert (own, got) == (licence, pytest.approx(score, abs=2e-9))
        else:
            assert own is None


def walk(files, path):
    """Nearest licence file above a path."""
    holders = {}
    for p, own in files.items():
        if own and p.rsplit("/", 1)[-1].upper().startswith(("LICENSE", "LICENCE", "COPYING")):
            holders.setdefault(p.rsplit("/", 1)[0] if "/" in p else "", (p, own))
    where, levels = path.rsplit("/", 1)[0] if "/" in path else "", 0
    while True:
        if where in holders:
            return (*holders[where][::-1], levels)
        if not where:
            return None, None, None
        where, levels = where.rsplit("/", 1)[0] if "/" in where else "", levels + 1


def test_inheritance(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    texts = {
        "a/LICENSE": mit, "a/b/COPYING.txt": "intro\n" + gpl, "a/b/c/x.py": "code", "a/y.py": "code", "a/b/z.py": mit, "q/r.py": "code",
        "top.py": "code", "ab/w.py": "code", "q/s/LICENSE": "no notice here", "q/s/t.py": "code",
    }
    rows = [(i, p, t) for i, (p, t) in enumerate(texts.items())]
    rows += [(90, None, "code"), (None, "a/n.py", None), (91, "a/y.py", ""), (92, None, gpl)]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string").withColumns({"dir": F.lit("x"), "license": F.lit("y")})
    got = {(r.doc_id, r.path): r for r in scan.licenses(df).collect()}
    own = {"a/LICENSE": "MIT", "a/b/COPYING.txt": "GPL-3.0", "a/b/z.py": "MIT"}
    for i, path in enumerate(texts):
        r = got[i, path]
        assert r.own_license == own.get(path)
        if path not in own:
            want = walk({p: own.get(p) for p in texts}, path)
            assert (r.license, r.license_path, r.levels) == want, path
        else:
            assert (r.license, r.license_path, r.levels) == (own[path], path, 0)
    assert got[90, None].license is None and got[92, None].license == "GPL-3.0"
    assert got[None, "a/n.py"].license == "MIT" == got[91, "a/y.py"].license
    assert scan.licenses(df.limit(0)).count() == 0


def test_long_texts_are_read_whole(spark):
    df = spark.createDataFrame([(1, "x", "plain words\n" * 60_000 + "Licensed under CC BY-NC 4.0.")], "doc_id long, path string, text string")
    assert scan.licenses(df).first().license == "CC-BY-NC-4.0"


def test_query_agrees_with_plain_cosines(spark):
    rows = QUERIES["op9_license_scan"](spark, SF).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    totals = Counter(t for d in docs.values() for t in scan.VOCABULARY.keys() & set(scan.TERM.findall(d.text.lower())))
    frequencies = [totals[t] for t in sorted(scan.VOCABULARY)]
    for r in rows:
        lines = docs[r.doc_id].text.split("\n")
        best = max((plain_best(x, frequencies, len(docs)) for x in [*lines, docs[r.doc_id].text]), key=lambda b: b[0])
        assert r.own_license == (best[1] if best[0] >= scan.THRESHOLD else None)


def wrapped(text, lead="", width=60):
    return "\n".join(lead + x for x in textwrap.wrap(text, width))


def gnu(name, version, what="program"):
    return (
        f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} Public License as "
        f"published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
    )


BSD_3 = f"{texts.CLAUSES_BSD} {texts.ENDORSE_BSD} {texts.REST_BSD}".replace("the copyright holder nor", "Acme nor")
OPENING = """                  GNU {} PUBLIC LICENSE
                       Version {}, {}

 Copyright (C) Free Software Foundation, Inc.
 Everyone is permitted to copy and distribute verbatim copies
 of this license document, but changing it is not allowed.
"""
BLOCKS = [
    ("BSD-3-Clause", "// Copyright 2009 The Go Authors. All rights reserved.\n// Use of this source code is governed by a BSD-style\n// license that can be found in the LICENSE file."),
    ("BSD-3-Clause", wrapped(f"Copyright (c) 2020 Acme. All rights reserved. {BSD_3}")),
    ("BSD-2-Clause", wrapped(f"Copyright (c) 2020 Acme. {texts.CLAUSES_BSD} {texts.REST_BSD}", " * ")),
    ("MIT", f"Copyright (c) 2020 Acme\n\n{texts.GRANT_MIT}\n\n{wrapped(texts.REST_MIT)}"),
    ("MIT", wrapped(texts.GRANT_MIT, "# ", 30)),
    ("ISC", wrapped(f"Copyright (c) 2020 Acme {texts.ISC} {texts.REST_ISC}")),
    ("Apache-2.0", wrapped("Copyright 2020 Acme " + texts.APACHE_HEADER, "# ", 40)),
    ("Apache-2.0", "        Apache License\n   Version 2.0, January 2004\n  http://www.apache.org/licenses/\n\nTERMS AND CONDITIONS"),
    ("GPL-2.0", wrapped(gnu("General", "2"), "# ")),
    ("GPL-3.0", wrapped(gnu("General", "3"), "// ")),
    ("GPL-3.0", gnu("General", "3")),
    ("LGPL-2.1", wrapped(gnu("Lesser General", "2.1", "library"), " * ")),
    ("LGPL-3.0", wrapped(gnu("Lesser General", "3"), " * ")),
    ("AGPL-3.0", wrapped(gnu("Affero General", "3"), " * ")),
    ("GPL-2.0", OPENING.format("GENERAL", "2", "June 1991")),
    ("LGPL-2.1", OPENING.format("LESSER GENERAL", "2.1", "February 1999")),
    ("AGPL-3.0", OPENING.format("AFFERO GENERAL", "3", "29 June 2007")),
    ("MPL-2.0", wrapped(texts.MPL_HEADER, " * ", 40)),
    ("CC-BY-4.0", "Attribution 4.0 International\n\nCreative Commons Attribution 4.0 International Public\nLicense\n\nBy exercising the Licensed Rights"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License."),
]


@pytest.mark.parametrize(("licence", "block"), BLOCKS)
def test_blocks_are_found_wherever_lines_end(licence, block):
    notices = scan.Notices([30 if len(t) < 4 else 0 for t in sorted(scan.VOCABULARY)], 10_000)
    for text in (block, f"{block}\n\n" + "plain words of a program\n" * 500, "plain words of a program\n" * 5000 + block):
        assert notices.read(text)[0] == licence


def test_blocks_without_their_names_or_versions_are_none():
    notices = scan.Notices([30 if len(t) < 4 else 0 for t in sorted(scan.VOCABULARY)], 10_000)
    for text in (wrapped(gnu("General", "9")), wrapped(gnu("Strange", "3")), "This program is free software\nand that is all."):
        assert notices.read(text)[0] is None


def test_whole_licence_files_are_inherited(spark):
    files = [(1, "a/LICENSE", wrapped(BSD_3)), (2, "a/b/x.go", "code"), (3, "c/COPYING", OPENING.format("LESSER GENERAL", "2.1", "February 1999")), (4, "c/y.c", "code")]
    got = scan.licenses(spark.createDataFrame(files, "doc_id long, path string, text string")).collect()
    assert {r.doc_id: r.license for r in got} == {1: "BSD-3-Clause", 2: "BSD-3-Clause", 3: "LGPL-2.1", 4: "LGPL-2.1"}
