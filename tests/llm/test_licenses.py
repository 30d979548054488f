"""Licence headers that are no templates, statements against a plain TF-IDF, ties, very long texts."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from modelmon.llm import licenses

AGPL = next(t for n, t in licenses.TEMPLATES if n == "AGPL-3.0" and len(t) > 100)
APACHE = "Licensed under the Apache License, Version 2.0."
HEADERS = [
    ("// SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
    ("# SPDX-License-Identifier: MIT", "MIT"),
    ("/* SPDX-License-Identifier: GPL-2.0-only */", "GPL-2.0"),
    ("SPDX-License-Identifier: AGPL-3.0-or-later", "AGPL-3.0"),
    ("Copyright 2020 The Authors. All rights reserved. " + APACHE, "Apache-2.0"),
    ("lorem ipsum dolor sit amet over under " * 3 + APACHE[:-1] + " zebra quark" * 10, "Apache-2.0"),
    ("Released under the GPL license.", "GPL"),
    (AGPL, "AGPL-3.0"),
    ("This is not released under the MIT License.", None),
    ("This code is no longer available under the Apache License, Version 2.0.", None),
    ("we took out a license to thrill and a driving licence", None),
    ("SPDX-License-Identifier: Unheard-9.0", None),
    ("x\n" * 20000 + "word " * 50000 + "\n" + APACHE + "\n" + "y " * 50000, "Apache-2.0"),
    ("license " * 3000, None),
]


def test_headers(spark):
    rows = [(i, f"d{i}/f.py", t) for i, (t, _) in enumerate(HEADERS)]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string").withColumn("row", F.lit("clash")).withColumn("lines", F.lit(1))
    found = {r.doc_id: r.license for r in licenses.licences(files).collect()}
    assert {i: found[i] for i in found} == {i: want for i, (_, want) in enumerate(HEADERS)}


def terms(text):
    for t in re.findall(licenses.TERM, text.lower()):
        yield t
        if "-" in t:
            yield from t.split("-")


def plain_scores(texts):
    """Text -> (licence, score) by dense loops over all templates."""
    every = [Counter(terms(t)) for t in texts] + [Counter(terms(t)) for _, t in licenses.TEMPLATES]
    df = Counter(t for v in every for t in v)
    n = len(every)
    vectors = [{t: (1 + math.log(c)) * math.log(1 + n / df[t]) for t, c in v.items()} for v in every]
    size = [math.sqrt(sum(x * x for x in v.values())) for v in vectors]
    out = {}
    for i, text in enumerate(texts):
        best = defaultdict(float)
        for j, (name, template) in enumerate(licenses.TEMPLATES, len(texts)):
            dot = sum(x * vectors[j].get(t, 0) for t, x in vectors[i].items())
            score = round(dot / (size[i] * size[j]), 6)
            if score >= (licenses.SPDX_THRESHOLD if template.startswith("SPDX") else licenses.THRESHOLD):
                best[name] = max(best[name], score)
        ranked = sorted(((s, n) for n, s in best.items()), reverse=True)
        if ranked and (len(ranked) == 1 or ranked[0][0] - ranked[1][0] > licenses.MARGIN):
            out[text] = ranked[0]
    return out


def test_scores_equal_plain_cosines(spark):
    texts = sorted({t for t, _ in HEADERS if len(t) < 2000} | {t[:60] for _, t in licenses.TEMPLATES} | {"", "the MIT or the ISC license", "GNU license version 2"})
    rows = [(hashlib.sha256(t.encode()).hexdigest(), t) for t in texts]
    made = spark.createDataFrame(rows + rows[:3], "key string, text string")
    found = {r.key: (r.score, r.license) for r in licenses.scored(made).collect()}
    want = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in plain_scores([t for t in texts if list(terms(t))]).items()}
    assert found.keys() == want.keys()
    for key, (score, name) in want.items():
        assert found[key][1] == name and found[key][0] == pytest.approx(score, abs=2e-6)
