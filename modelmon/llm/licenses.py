"""Licence scans: TF-IDF cosine of licence statements to templates, then inheritance from the nearest directory above.

Statements are the lines, the sentences of lines and the blank-line blocks of a text with a licence word in them, windows
of the lengths of the short templates around each licence word of a line, and the whole text of a file named as a licence.
Short statements that deny a licence are none. Each different statement is scored once, however many files hold it. A
statement whose two best licences score alike within MARGIN names neither. A file takes the licence of its best statement;
a file without one takes that of the nearest directory above it that has one.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from modelmon.llm.common import fixed

# Headers and first clauses of common licences.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("LGPL-3.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License version 3 as published by the Free Software Foundation."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0. This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0. This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright to the public domain. CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("GPL", "Released under the GPL license."),
    ("GPL", "Licensed under the GNU General Public License."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Licensed under the MIT license."),
    ("ISC", "Licensed under the ISC license."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("EPL-2.0", "Licensed under the Eclipse Public License, version 2.0."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
]
# SPDX identifiers by licence; each gives a template of its own.
SPDX = {
    "MIT": ["MIT"], "Apache-2.0": ["Apache-2.0"], "ISC": ["ISC"], "BSD-2-Clause": ["BSD-2-Clause"], "BSD-3-Clause": ["BSD-3-Clause"],
    "GPL-2.0": ["GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later"], "GPL-3.0": ["GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"],
    "LGPL-2.1": ["LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later"], "LGPL-3.0": ["LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"],
    "AGPL-3.0": ["AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"], "MPL-2.0": ["MPL-2.0"], "EPL-2.0": ["EPL-2.0"], "BSL-1.0": ["BSL-1.0"],
    "CC0-1.0": ["CC0-1.0"], "CC-BY-4.0": ["CC-BY-4.0"], "CC-BY-SA-4.0": ["CC-BY-SA-4.0"], "CC-BY-NC-4.0": ["CC-BY-NC-4.0"], "Unlicense": ["Unlicense"],
}
TEMPLATES += [(name, f"SPDX-License-Identifier: {i}") for name, ids in SPDX.items() for i in ids]
# A statement holds one of these; every template does.
CUE = r"(?i)licen[cs]e|public domain|redistribut|permission is hereby|creative commons|spdx"
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense)([._-][^/]*)?$"
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
SENTENCE_END = r"(?<=[.;!?])\s+"
# A denied licence, in statements of fewer than LONG words and up to AHEAD words in front of a window.
DENIED = r"(?i)\b(?:not|never|no longer|isn't|wasn't|aren't)\s+(?:\w+\s+){0,2}?(?:released|licen[cs]ed|distributed|available|covered)\b"
LONG, AHEAD = 60, 8
THRESHOLD = 0.6
# An identifier is one term among four that all SPDX templates share, so those need more.
SPDX_THRESHOLD = 0.9
# A statement's best licence beats every other by more than this.
MARGIN = 0.02
# Templates of up to so many words give windows.
SHORT = 12


def _shapes() -> list[tuple[int, int]]:
    """(words before, words after) of each licence word of the short templates."""
    found = set()
    for _, text in TEMPLATES:
        parts = text.split()
        if len(parts) <= SHORT:
            found |= {(i, len(parts) - i - 1) for i, w in enumerate(parts) if re.search(CUE, w)}
    return sorted(found)


def _terms(text: Column) -> Column:
    """The terms of a text; a hyphenated one counts whole and by its parts."""
    terms = F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))
    return F.flatten(F.transform(terms, lambda t: F.when(t.contains("-"), F.concat(F.array(t), F.split(t, "-"))).otherwise(F.array(t))))


def _vectors(texts: DataFrame) -> DataFrame:
    """(key, term, tf) for distinct (key, text): only the key goes along with the terms."""
    return texts.select("key", F.explode(_terms(F.col("text"))).alias("term")).groupBy("key", "term").agg(F.count("*").alias("tf"))


def least(template: str) -> float:
    """The cosine that a template asks for."""
    return SPDX_THRESHOLD if template.startswith("SPDX") else THRESHOLD


def scored(statements: DataFrame) -> DataFrame:
    """(key, license, score) for the distinct statements (key, text) whose best template reaches its threshold.

    Inverse document frequencies are over all distinct statements and the templates. A statement whose second licence comes
    within MARGIN of its first, ties included, has none.
    """
    templates = statements.sparkSession.createDataFrame([(f"t{i}", *t, least(t[1])) for i, t in enumerate(TEMPLATES)], "key string, license string, text string, least double")
    vectors = fixed(_vectors(statements.dropDuplicates(["key"])), "statements")
    known = _vectors(templates)
    n = vectors.select("key").distinct().count() + len(TEMPLATES)
    df = vectors.unionByName(known).groupBy("term").agg(F.count("*").alias("df"))
    weight = (1 + F.log("tf")) * F.log(1 + F.lit(float(n)) / F.col("df"))
    theirs = fixed(known.join(df, "term").select(F.col("key").alias("template"), "term", weight.alias("y")), "templates")
    mine = fixed(vectors.join(df, "term").select("key", "term", weight.alias("x")), "weights")
    norm = mine.groupBy("key").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    template_norm = theirs.groupBy("template").agg(F.sqrt(F.sum(F.col("y") * F.col("y"))).alias("template_norm"))
    dots = mine.join(theirs, "term").groupBy("key", "template").agg(F.sum(F.col("x") * F.col("y")).alias("dot"))
    cosine = F.round(F.col("dot") / (F.col("norm") * F.col("template_norm")), 6)
    best = (
        dots.join(template_norm, "template").join(norm, "key").join(templates.select(F.col("key").alias("template"), "license", "least"), "template")
        .select("key", "license", "least", cosine.alias("score")).where(F.col("score") >= F.col("least"))
        .groupBy("key", "license").agg(F.max("score").alias("score"))
        .groupBy("key").agg(F.sort_array(F.collect_list(F.struct("score", "license")), asc=False).alias("b"))
        .where((F.size("b") == 1) | (F.col("b")[0]["score"] - F.get("b", F.lit(1))["score"] > MARGIN))
    )
    return best.select("key", F.col("b")[0]["license"].alias("license"), F.col("b")[0]["score"].alias("score"))


def _windows(lines: DataFrame) -> DataFrame:
    """(row, text) of the windows around the licence words of (row, line): one row at a time, however long a line is."""
    shapes = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(a).alias("a")) for b, a in _shapes()])
    words = F.split("line", r"\s+")
    at = F.filter(F.transform("w", lambda w, i: F.when(w.rlike(CUE), i)), lambda i: i.isNotNull())
    # Indexes are from 0, slices from 1.
    first = F.greatest(F.col("i") - F.col("s.b"), F.lit(0))
    ahead = F.greatest(first - AHEAD, F.lit(0))
    stop = F.col("i") + F.col("s.a") + 1
    return (
        lines.select("row", words.alias("w")).select("row", "w", F.explode(at).alias("i")).select("row", "w", "i", F.explode(shapes).alias("s"))
        .select("row", F.concat_ws(" ", F.slice("w", first + 1, stop - first)).alias("text"), F.concat_ws(" ", F.slice("w", ahead + 1, stop - ahead)).alias("seen"))
        .where(~F.col("seen").rlike(DENIED)).select("row", "text")
    )


def _directory(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def _best(score: str = "score") -> Column:
    return F.min(F.struct((-F.col(score)).alias("s"), "license"))


def licences(files: DataFrame, named_only: bool = True) -> DataFrame:
    """Per row of ``files`` (doc_id, path, text): license, score, origin and from_directory. Texts are read whole.

    origin is "own" for the file's best statement, "inherited" with the directory it comes from, null without any. A
    directory's licence is that of its licence files; with ``named_only=False`` that of most of its files with one of
    their own (ties: better score, then name). Null texts and paths are empty (the root directory); repeated rows come out
    repeated; an empty table gives an empty one; further columns are ignored. Of a file's equally good statements the
    first licence by name counts.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    path = F.coalesce(F.col("path").cast("string"), F.lit(""))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(CUE))
    sentences = F.filter(F.flatten(F.transform(lines, lambda x: F.split(x, SENTENCE_END))), lambda x: x.rlike(CUE))
    blocks = F.filter(F.split("t", r"\n\s*\n"), lambda x: x.rlike(CUE) & x.contains("\n"))
    denied = lambda x: (F.size(F.split(x, r"\s+", LONG)) < LONG) & x.rlike(DENIED)
    named = F.col("path").rlike(LICENCE_FILE)
    found = F.array_distinct(F.concat(F.filter(F.concat(lines, sentences, blocks), lambda x: ~denied(x)), F.when(named, F.array("t")).otherwise(F.array().cast("array<string>"))))
    none = F.array().cast("array<string>")
    read = files.select("doc_id", path.alias("path"), text.alias("t"))
    table = fixed(
        read.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "path", _directory(F.col("path")).alias("dir"), named.alias("named"),
            F.when(F.col("t").rlike(CUE) | named, found).otherwise(none).alias("statements"),
            F.when(F.col("t").rlike(CUE), F.array_distinct(lines)).otherwise(none).alias("lines"),
        ),
        "files",
    )
    stated = table.select("row", F.explode("statements").alias("text")).unionByName(_windows(table.select("row", F.explode("lines").alias("line"))))
    held = stated.withColumn("key", F.sha2("text", 256))
    own = fixed(
        held.select("row", "key").distinct().join(scored(held.select("key", "text")), "key").groupBy("row").agg(_best().alias("b")).select("row", F.col("b.license").alias("license"), (-F.col("b.s")).alias("score")),
        "own",
    )
    files_now = table.select("row", "doc_id", "path", "dir", "named").join(own, "row", "left")
    # Directories with a licence: one row each, summed per directory and licence first.
    voters = files_now.where(F.col("license").isNotNull() & (F.col("named") | F.lit(not named_only)))
    votes = voters.groupBy("dir", "license").agg(F.count("*").alias("n"), F.max("score").alias("score"))
    licensed = votes.groupBy("dir").agg(F.min(F.struct((-F.col("n")).alias("n"), (-F.col("score")).alias("s"), "license")).alias("b")).select(
        F.col("dir").alias("above"), F.col("b.license").alias("above_license"), (-F.col("b.s")).alias("above_score")
    )
    # Each different directory asks for itself and those above it, whatever the number of its files.
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    asked = table.select("dir").distinct().select("dir", F.explode(F.array_distinct(above)).alias("above"))
    nearest = asked.join(licensed, "above").groupBy("dir").agg(
        F.max(F.struct(F.length("above").alias("n"), "above", "above_license", "above_score")).alias("b")
    ).select("dir", F.col("b.above").alias("above"), F.col("b.above_license").alias("above_license"), F.col("b.above_score").alias("above_score"))
    mine = F.col("license").isNotNull()
    return files_now.join(nearest, "dir", "left").select(
        "doc_id", "path",
        F.coalesce("license", "above_license").alias("license"),
        F.coalesce("score", "above_score").alias("score"),
        F.when(mine, "own").when(F.col("above_license").isNotNull(), "inherited").alias("origin"),
        F.when(~mine, F.col("above")).alias("from_directory"),
    )
