"""Licences of files by sparse TF-IDF cosine and inheritance between folders.

A file's lines are its possible headers; the first line with a word is also what
a licence file starts with. Each line is compared with the licence templates as
sparse TF-IDF vectors: a word the line holds weighs its idf over the templates, and
a word no template holds the idf of an unseen word, so it only lowers the cosine. A line
matches when its best cosine reaches `THRESHOLD`; the best template wins, ties go
to its name.

Headers wrap over lines and licence files are long, so two more texts of a file are
compared, with term counts: its header block (the first comment, else the first paragraph)
and, where the file is named as a licence, all of it. `LONG` holds their templates, the
usual file headers and the full licences. The whole text says more than the block, the block
more than a line. Where none of them matches, the lines of the block are compared with
`SHORT`: titles, SPDX tags and the reservation of rights.

A text that matches also holds a word that names licences (`NAMING`) and two words of the
template, or its only one, that say more than `COMMON` ones: "The." is not the MIT licence,
nor is the German "mit".

A file whose first line matches, or that is named as a licence and matches at all,
is a licence file for its folder: the licence of a
folder is that of most of its licence files (ties: by name). A file without a match
takes the licence of the nearest folder above it that has one, found by one join
on every ancestor path.

Templates are constants, so what is sent to tasks is fixed. All whole texts are read; only
those that hold one of the words that name licences are taken apart, and of their lines only
those whose known and unknown words do not bound the cosine below the threshold.

Null or empty text has no own licence but can inherit. Null paths have no folder.
Repeated rows give repeated rows, an empty table gives none. Only doc_id, path and text are
read, so further columns may have any name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable
from functools import reduce
from operator import or_
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.llm.text import NOT_ALPHANUMERIC, lower_ascii, settled, split_words, stored, whole_text

THRESHOLD = 0.7
# Sentences that name a licence in one line.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, "
    "are permitted provided that the following conditions are met",
    "CC-BY-4.0": "Licensed under the Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "GPL": "This work is licensed under the GNU General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "Proprietary": "All rights reserved",
}

_GNU = """This {what} is free software: you can redistribute it and/or modify it under the
terms of the GNU {kind}General Public License as published by the Free Software Foundation{version}.
This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
{kind}General Public License for more details. You should have received a copy of the GNU
{kind}General Public License along with this {what}. If not, see <https://www.gnu.org/licenses/>."""
_LATER = ", either version {n} of the License, or (at your option) any later version"
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice
and this permission notice shall be included in all copies or substantial portions of the
Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
# The licence is the name's first word. The full texts are Debian's copies.
LONG: dict[str, str] = {
    "Apache-2.0 header": """Licensed under the Apache License, Version 2.0 (the "License"); you may
not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""",
    "Apache-2.0 foundation": """Licensed to the Apache Software Foundation (ASF) under one or more
contributor license agreements. See the NOTICE file distributed with this work for additional
information regarding copyright ownership. The ASF licenses this file to You under the Apache
License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0""",
    "BSD reference": """Use of this source code is governed by a BSD-style license that can be found
in the LICENSE file.""",
    "MIT whole": _MIT,
    "MPL-2.0 header": """This Source Code Form is subject to the terms of the Mozilla Public License,
v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at
https://mozilla.org/MPL/2.0/.""",
    "CC-BY-4.0 header": """This work is licensed under the Creative Commons Attribution 4.0
International License. To view a copy of this license, visit
http://creativecommons.org/licenses/by/4.0/ or send a letter to Creative Commons, PO Box 1866,
Mountain View, CA 94042, USA.""",
    "CC-BY-NC-4.0 header": """This work is licensed under the Creative Commons
Attribution-NonCommercial 4.0 International License. To view a copy of this license, visit
http://creativecommons.org/licenses/by-nc/4.0/ or send a letter to Creative Commons, PO Box 1866,
Mountain View, CA 94042, USA.""",
} | {
    f"{name} {what} header {n}": _GNU.format(what=what, kind=kind, version=_LATER.format(n=n))
    for name, kind, n in (
        ("GPL", "", 2), ("GPL", "", 3), ("LGPL", "Lesser ", 2.1), ("LGPL", "Lesser ", 3), ("AGPL", "Affero ", 3)
    )
    for what in ("program", "library")
} | {
    f"{re.sub('GPL-.*', 'GPL', file.stem)} text {file.stem}": file.read_text(encoding="utf-8")
    for file in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))
}
SHORT: dict[str, str] = {
    f"{name} {title}": title
    for name, titles in {
        "Apache-2.0": ("Apache License", "Apache License, Version 2.0", "SPDX-License-Identifier: Apache-2.0"),
        "BSD": ("BSD 3-Clause License", "BSD 2-Clause License", "SPDX-License-Identifier: BSD-3-Clause",
                "SPDX-License-Identifier: BSD-2-Clause"),
        "CC-BY-4.0": ("Creative Commons Attribution 4.0 International", "SPDX-License-Identifier: CC-BY-4.0"),
        "CC-BY-NC-4.0": ("Creative Commons Attribution-NonCommercial 4.0 International",
                         "SPDX-License-Identifier: CC-BY-NC-4.0"),
        "AGPL": ("GNU Affero General Public License", "SPDX-License-Identifier: AGPL-3.0-or-later"),
        "GPL": ("GNU General Public License", "SPDX-License-Identifier: GPL-2.0-only",
                "SPDX-License-Identifier: GPL-2.0-or-later", "SPDX-License-Identifier: GPL-3.0-only",
                "SPDX-License-Identifier: GPL-3.0-or-later"),
        "LGPL": ("GNU Lesser General Public License", "SPDX-License-Identifier: LGPL-2.1-or-later",
                 "SPDX-License-Identifier: LGPL-3.0-or-later"),
        "MIT": ("MIT License", "The MIT License (MIT)", "SPDX-License-Identifier: MIT"),
        "MPL-2.0": ("Mozilla Public License Version 2.0", "SPDX-License-Identifier: MPL-2.0"),
        "Proprietary": ("Copyright (c) All rights reserved",),
    }.items()
    for title in titles
}
# English words that say nothing on licences.
COMMON = set(
    "a all an and any are as at be but by can for from has have if in is it its may more no not of on "
    "one only or other see such that the their this to under use was which will with you your".split()
)
# Words that name licences; every template has one of them.
NAMING = (
    "license", "licensed", "licenses", "licence", "rights", "copyright", "redistribution", "commons", "permission"
)
# Names of licence files, with or without an ending.
LICENSE_FILE = r"(?i)(^|/)(un)?(licen[cs]e|copying|copyright)([-_.][^/]*)?$"


def template_words(text: str) -> set[str]:
    return {w for w in re.split(NOT_ALPHANUMERIC, text.lower()) if w}


def template_idf(templates: dict[str, str] = TEMPLATES) -> tuple[dict[str, float], float]:
    """idf of every template word, ln((1 + N) / (1 + templates with it)) + 1, and of unknown words."""
    n = len(templates)
    frequency = Counter(w for text in templates.values() for w in template_words(text))
    idf = {w: math.log((1 + n) / (1 + df)) + 1 for w, df in sorted(frequency.items())}
    return idf, math.log(1 + n) + 1


def telling_words(text: str) -> set[str]:
    return template_words(text) - COMMON


def least_telling(text: str) -> int:
    """Words of a template, other than common ones, that a match has at least."""
    return min(2, len(telling_words(text)))


def _speaking(texts: DataFrame) -> DataFrame:
    """The texts that hold a word that names licences: a contained word is found fast."""
    lower = texts.withColumn("_lower", F.lower("text"))
    names = [F.contains("_lower", F.lit(name)) for name in NAMING]
    return settled(lower, reduce(or_, names)).drop("_lower")


def _terms(spark, weights: list[tuple[str, str, float]], templates: dict[str, str]) -> DataFrame:
    """word, template, license, weight of every template word; whether it is a telling one,
    and how many of these the template asks for."""
    rows = [
        (word, name, name.split(" ")[0], weight, word not in COMMON, least_telling(templates[name]))
        for word, name, weight in weights
    ]
    return spark.createDataFrame(
        rows, "word string, template string, license string, weight double, telling boolean, least int"
    )


def _matched(counted: DataFrame, terms: DataFrame, idf: DataFrame, unknown: float) -> DataFrame:
    """file, line, license, cosine of the texts that match, from their words and counts `n`."""
    norms = (
        counted.join(F.broadcast(idf), "word", "left")
        .groupBy("file", "line")
        .agg(
            F.sqrt(F.sum(F.pow(F.col("n") * F.coalesce("idf", F.lit(unknown)), 2))).alias("norm"),
            F.max(F.col("word").isin(*NAMING)).alias("names"),
        )
        .filter("names")
    )
    dots = (
        counted.join(F.broadcast(terms), "word")
        .groupBy("file", "line", "template", "license", "least")
        .agg(F.sum(F.col("n") * F.col("weight")).alias("dot"), F.count_if("telling").alias("told"))
        .filter(F.col("told") >= F.col("least"))
    )
    cosine = F.round(F.col("dot") / F.col("norm"), 6)
    return (
        dots.join(norms, ["file", "line"])
        .select("file", "line", "license", cosine.alias("cosine"))
        .filter(F.col("cosine") >= THRESHOLD)
    )


def _words(text: Column) -> Column:
    return split_words(lower_ascii(text), NOT_ALPHANUMERIC)


def ancestors(path: Column) -> Column:
    """Folders above a path, nearest first; the last is the root, ''."""
    parts = F.split(path, "/")
    depth = F.size(parts) - 1
    return F.transform(
        F.sequence(F.lit(0), depth),
        lambda up: F.concat_ws("/", F.slice(parts, 1, F.greatest(depth - up, F.lit(0)))),
    )


def _first_lines(text: Column, stays: Callable[[Column], Column]) -> Column:
    """The lines before the first one that does not stay, joined."""
    lines = F.split(text, "\n")
    end = F.array_position(F.transform(lines, lambda x: ~stays(x)), True)
    return F.array_join(F.when(end > 0, F.slice(lines, 1, (end - 1).cast("int"))).otherwise(lines), "\n")


def header_block(text: Column) -> Column:
    """The first comment, else the first paragraph, after a script's interpreter line."""
    body = F.ltrim(text, F.lit("\ufeff \t\r\n"))
    body = F.ltrim(F.regexp_replace(body, r"\A#![^\n]*", ""), F.lit(" \t\r\n"))
    mark = r"^[ \t]*(#|//|;|--|%)"
    block = F.when(body.startswith("/*"), F.substring_index(body, "*/", 1))
    block = block.when(body.startswith("<!--"), F.substring_index(body, "-->", 1))
    block = block.when(body.rlike(r"\A(#|//|;|--|%)"), _first_lines(body, lambda x: x.rlike(mark)))
    return block.otherwise(_first_lines(body, lambda x: x.rlike(r"[^\s]")))


def template_weights(templates: dict[str, str]) -> dict[str, dict[str, float]]:
    """Each template as a vector of length 1 over its words, (ln(count) + 1) * idf."""
    idf, _ = template_idf(templates)
    vectors = {}
    for name, text in templates.items():
        counts = Counter(w for w in re.split(NOT_ALPHANUMERIC, text.lower()) if w)
        weights = {w: (math.log(n) + 1) * idf[w] for w, n in counts.items()}
        size = math.sqrt(sum(v * v for v in weights.values()))
        vectors[name] = {w: v / size for w, v in weights.items()}
    return vectors


def may_match(words: Column, templates: dict[str, str]) -> Column:
    """Whether words hold enough of a template's telling words to reach the threshold.

    The cosine is at most the length of the template's part that the words hold, so
    even with all of its COMMON words a text needs `least` others.
    """
    telling = template_words(" ".join(templates.values())) - COMMON
    least = len(telling)
    for weights in template_weights(templates).values():
        mass = sum(v * v for w, v in weights.items() if w in COMMON)
        needed = 0
        for v in sorted((v for w, v in weights.items() if w not in COMMON), reverse=True):
            if mass >= THRESHOLD**2 - 1e-5:
                break
            mass, needed = mass + v * v, needed + 1
        least = min(least, needed)
    return F.size(F.array_distinct(F.filter(words, lambda w: w.isin(sorted(telling))))) >= least


def text_matches(texts: DataFrame, templates: dict[str, str] = LONG) -> DataFrame:
    """file, line, license, cosine of the texts that match, by term counts."""
    spark = texts.sparkSession
    idf, unknown = template_idf(templates)
    weights = [
        (word, name, v * idf[word])
        for name, own in template_weights(templates).items()
        for word, v in sorted(own.items())
    ]
    table = spark.createDataFrame(sorted(idf.items()), "word string, idf double")
    counted = (
        texts.select("file", "line", _words(F.col("text")).alias("words"))
        .filter(may_match(F.col("words"), templates))
        .select("file", "line", F.explode("words").alias("word"))
        .groupBy("file", "line", "word")
        .agg((F.log(F.count("*")) + 1).alias("n"))
    )
    return _matched(counted, _terms(spark, weights, templates), table, unknown)


def set_weights(templates: dict[str, str]) -> list[tuple[str, str, float]]:
    """word, template and weight of the words of each template, counted once."""
    idf, _ = template_idf(templates)
    return [
        (word, name, idf[word] ** 2 / math.sqrt(sum(idf[w] ** 2 for w in template_words(text))))
        for name, text in templates.items()
        for word in sorted(template_words(text))
    ]


def header_matches(files: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """file, line, license, cosine of each line that matches."""
    spark = files.sparkSession
    idf, unknown = template_idf(templates)
    lines = files.select(
        "file",
        F.posexplode(
            F.filter(
                F.split("text", "\n"), lambda x: F.length(F.translate(x, " \t\x0b\x0c\r", "")) > 0
            )
        ).alias("line", "header"),
    )
    lower = lines.withColumn("_lower", F.lower("header"))
    names = [F.contains("_lower", F.lit(name)) for name in NAMING]
    lines = settled(lower, reduce(or_, names)).select("file", "line", _words(F.col("header")).alias("words"))
    # Every unknown word of a line adds unknown ** 2 to its squared norm, a known one
    # at most max(idf) ** 2, so cosine ** 2 <= known / (known + unknown).
    known = F.size(F.array_intersect("words", F.array(*(F.lit(w) for w in idf))))
    most = known * max(idf.values()) ** 2
    all_squares = most + (F.size(F.array_distinct("words")) - known) * unknown**2
    terms_of = (
        settled(lines, (known > 0) & (most >= THRESHOLD**2 * all_squares))
        .select("file", "line", F.explode("words").alias("word"))
        .distinct()
        .withColumn("n", F.lit(1.0))
    )
    table = spark.createDataFrame(sorted(idf.items()), "word string, idf double")
    return _matched(terms_of, _terms(spark, set_weights(templates), templates), table, unknown)


def scan(df: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, path, own_license, cosine, folder_license, folder, license.

    df: doc_id, path and text. `license` is the own one, else the inherited one.
    """
    files = df.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("path").cast("string").alias("path"),
        whole_text().alias("text"),
    )
    keyed = files.withColumn("file", F.concat_ws("-", "doc_id", F.xxhash64("path", "text")))
    speaking = stored(_speaking(keyed).select("path", "file", "text").distinct(), "speaking")
    named = speaking.filter(F.col("path").rlike(LICENSE_FILE))
    blocks = speaking.select("file", header_block(F.col("text")).alias("text"))
    # By rank: all of a licence file, header blocks, lines, short forms.
    whole, block, line, short = range(4)
    several = blocks.filter(F.col("text").contains("\n"))
    texts = named.select("file", F.lit(whole).alias("line"), "text").union(
        several.select("file", F.lit(block), "text")
    )
    found = text_matches(texts)
    columns = ("file", "rank", "line", "license", "cosine")
    matches = stored(
        found.select("file", F.col("line").alias("rank"), F.lit(-1).alias("line"), "license", "cosine")
        .union(
            header_matches(speaking.select("file", "text"), templates)
            .withColumn("rank", F.lit(line))
            .select(*columns)
        )
        .union(header_matches(blocks, SHORT).withColumn("rank", F.lit(short)).select(*columns)),
        "headers",
    ).join(named.select("file", F.lit(True).alias("named")), "file", "left")
    # A first line speaks for its folder in any file, the other forms in licence files.
    declares = ((F.col("rank") == line) & (F.col("line") == 0)) | F.coalesce("named", F.lit(False))
    order = F.struct("rank", (-F.col("cosine")).alias("c"), "license", "line")
    own = (
        matches.groupBy("file")
        .agg(F.min(order).alias("best"), F.min(F.when(declares, order)).alias("first"))
        .select(
            "file",
            F.col("best.license").alias("own_license"),
            (-F.col("best.c")).alias("cosine"),
            F.col("first.license").alias("declares"),
        )
    )
    marked = stored(
        keyed.select("doc_id", "path", "file").join(own, "file", "left"), "marked"
    )
    votes = (
        marked.filter(F.col("declares").isNotNull() & F.col("path").isNotNull())
        .groupBy(ancestors(F.col("path"))[0].alias("folder"), "declares")
        .agg(F.count("*").alias("n"))
    )
    folders = votes.groupBy("folder").agg(
        F.min(F.struct((-F.col("n")).alias("n"), "declares"))["declares"].alias("folder_license")
    )
    # Each folder once, however many files it has.
    homes = marked.select(ancestors(F.col("path"))[0].alias("home")).filter("home is not null").distinct()
    nearest = (
        homes.select("home", F.posexplode(ancestors(F.concat(F.col("home"), F.lit("/")))).alias("up", "folder"))
        .join(folders, "folder")
        .groupBy("home")
        .agg(F.min(F.struct("up", "folder", "folder_license")).alias("near"))
    )
    return (
        marked.withColumn("home", ancestors(F.col("path"))[0])
        .join(nearest, "home", "left")
        .select(
            "doc_id",
            "path",
            "own_license",
            "cosine",
            F.col("near.folder").alias("folder"),
            F.col("near.folder_license").alias("folder_license"),
            F.coalesce("own_license", "near.folder_license").alias("license"),
        )
    )
