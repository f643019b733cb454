from __future__ import annotations

import math
from collections import Counter

import pytest

from quayside.llm import licenses as L

ROWS = [
    ("a/LICENSE", "Released under the MIT License."),
    ("a/x.py", "code\n  Licensed under the Apache License, Version 2.0.\nmore"),
    ("a/y.py", "no licence here"),
    ("a/b/c/z.py", None),
    ("a/b/LICENSE.txt", "This work is licensed under the GNU General Public License, version 3."),
    ("a/b/c/d/w.py", ""),
    ("q/r.py", "the license of the version under general terms of this work"),
    ("q/s.py", "RELEASED under the mit license"),
    ("q/s.py", "RELEASED under the mit license"),
    ("top.py", "nothing"),
    (None, "Licensed under CC BY-NC 4.0."),
    (None, "nothing"),
    ("m/COPYING", "Licensed under CC BY 4.0.\nReleased under the MIT License."),
    ("m/n.py", "x " * 50000 + "\nLicensed under CC BY-NC 4.0."),
    ("m/o.py", "x " * 50000),
]


@pytest.fixture(scope="module")
def files(spark):
    return spark.createDataFrame([(p, t, "clash") for p, t in ROWS], "path string, text string, How string").repartition(3)


def brute(rows, bound=L.MIN_SIMILARITY):
    """Best own licence of each text, every line and text against every template."""
    terms = {t for x in L.TEMPLATES.values() for t in L._terms(x)}
    df = Counter(t for _, x in rows for t in set(L._terms(x or "")) & terms)
    idf = {t: math.log((1 + len(rows)) / (1 + df[t])) + 1 for t in terms}

    def vector(text):
        w = {t: n * idf.get(t, math.log(1 + len(rows)) + 1) for t, n in Counter(L._terms(text)).items()}
        norm = math.sqrt(sum(x * x for x in w.values())) or 1.0
        return {t: x / norm for t, x in w.items()}

    templates = {n: vector(x) for n, x in L.TEMPLATES.items()}
    out = []
    for _, text in rows:
        best = (None, None, None)
        units = [] if text is None else [(0, text), *enumerate(text.split("\n"), 1)]
        found = []
        for line, unit in units:
            own = vector(unit)
            for name, v in templates.items():
                s = round(sum(x * v.get(t, 0.0) for t, x in own.items()), 6)
                if s >= bound:
                    found.append((-s, line, name))
        if found:
            s, line, name = min(found)
            best = (name, "header" if line else "file", -s)
        out.append(best)
    return out


def test_own_and_inherited(files):
    own = brute(ROWS)
    inherited = {("a/y.py"): ("MIT", "a"), "a/b/c/z.py": ("GPL-3.0", "a/b"), "a/b/c/d/w.py": ("GPL-3.0", "a/b"), "m/o.py": ("CC-BY-4.0", "m")}
    want = Counter()
    for (path, _), (name, how, s) in zip(ROWS, own, strict=True):
        if name is None and path in inherited:
            want[path, inherited[path][0], "inherited", None, inherited[path][1]] += 1
        else:
            want[path, name, how, s, None] += 1
    got = L.scan_licenses(files)
    assert Counter((r.path, r.license, r.how, r.similarity, r.directory) for r in got.collect()) == want
    assert own[0][0] == "MIT" and own[1] == ("Apache-2.0", "header", 1.0) and own[6][0] is None and own[13][0] == "CC-BY-NC-4.0"


def test_documents(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: (r.license, r.how, r.similarity) for r in L.scan_licenses(docs.selectExpr("doc_id", "text", "cast(null as string) path")).collect()}
    assert got == {d: x for (d, _), x in zip(rows, brute(rows), strict=True)}
    assert sum(x[0] is not None for x in got.values()) > 0


def test_directory_that_speaks(spark):
    rows = [("a/1", "Released under the MIT License."), ("a/2", "Released under the MIT License."), ("a/3", "Licensed under CC BY 4.0."), ("a/b/4", "x")]
    df = spark.createDataFrame(rows, "path string, text string")
    from pyspark.sql import functions as F

    got = {r.path: (r.license, r.directory) for r in L.scan_licenses(df, speaks=F.lit(True)).collect()}
    assert got["a/b/4"] == ("MIT", "a") and got["a/3"] == ("CC-BY-4.0", None)


def test_edge_rows(edge, none):
    from pyspark.sql import functions as F

    got = L.scan_licenses(edge.withColumn("path", F.concat_ws("/", "source", "lang")))
    assert got.count() == edge.count() and got.where("license is not null").count() == 0
    assert L.scan_licenses(none.withColumn("path", F.lit("x"))).count() == 0


def test_same_files_many_times(spark):
    """A notice stays one however often the same files are there: weights are of shares of the files, for all terms."""
    fill = [(f"f/{k}", f"this program is a work of its own, a document of {k} words under the version here") for k in range(40)]
    notices = [("n/1", "This program is licensed under the GNU General Public License, version 3."), ("n/2", "code\nThis document is licensed under CC BY 4.0.\ncode")]
    # Words of the notices that no template holds are common; those of the templates are there too.
    rest = [(f"r/{k}", f"{x} with more words that are {'different ' * 30}") for k, x in enumerate(L.TEMPLATES.values())]
    few = spark.createDataFrame([*fill, *notices, *rest], "path string, text string")
    from pyspark.sql import functions as F

    def own(df):
        got = L.scan_licenses(df).where("path like 'n/%'").distinct().collect()
        return {r.path: (r.license, r.how, r.similarity) for r in got}

    once, often = own(few), own(few.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(400)))).drop("k"))
    assert {p: x[:2] for p, x in once.items()} == {p: x[:2] for p, x in often.items()} == {"n/1": ("GPL-3.0", "file"), "n/2": ("CC-BY-4.0", "header")}
    assert all(abs(once[p][2] - often[p][2]) < 0.05 for p in once)


def test_texts_headers_and_identifiers(spark):
    texts = {p.stem: p.read_text() for p in L.TEXTS.glob("*.txt")}
    apache = L.all_templates()["Apache-2.0"][3]
    words = apache.split()
    wrapped = "\n".join("# " + " ".join(words[k : k + 9]) for k in range(0, len(words), 9))
    cases = [(f"{name}/LICENSE", f"Some Title\n\nCopyright (c) 2024 Jane Doe\n\n{text}", name) for name, text in texts.items()]
    cases += [
        ("h/a.py", f"#!/usr/bin/python\n# Copyright 2024 Jane Doe\n#\n{wrapped}\n\nimport os\n" + "x = os.y(z)\n" * 99, "Apache-2.0"),
        ("h/b.py", "# Licensed under the Apache\n# License, Version 2.0.\ncode = 1\n", "Apache-2.0"),
        ("h/c.c", "/*\n" + texts["MIT"] + "*/\nint main;\n" + "call(x);\n" * 99, "MIT"),
        ("h/d.py", "# Copyright 2024 Jane Doe. Released under the MIT License.\ncode = 1", "MIT"),
        ("h/e.rs", "// SPDX-License-Identifier: MIT\ncode", "MIT"), ("h/f.c", "/* SPDX-License-Identifier: GPL-2.0-or-later */\ncode", "GPL-2.0"),
        ("h/g.rs", "// SPDX-License-Identifier: Zlib\ncode", None),
        ("h/h.py", "# This program is free software: you can redistribute it and/or modify it under\n# the terms of the GNU Affero General Public License as published by the\n# Free Software Foundation, either version 3 of the License, or (at your\n# option) any later version.\nx", "AGPL-3.0"),
        ("h/i.md", "Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"), ("h/j.py", "x = 1\n" * 50, None),
    ]
    assert len(texts) == 16
    got = {r.path: r.license for r in L.scan_licenses(spark.createDataFrame([c[:2] for c in cases], "path string, text string")).where("coalesce(how, '') != 'inherited'").collect()}
    assert got == {p: name for p, _, name in cases}
