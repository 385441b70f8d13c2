"""Licence scan: sparse TF-IDF cosine to templates, then inheritance from
the nearest ancestor directory.

Segments of a file are its whole text, its blocks (runs of lines that are
not empty without their comment marks) and every window of up to
``MAX_LINES`` joined lines of a block, so a wrapped header is one segment.
A segment is scored if its telling terms (all but ``PLAIN``) are near those
of some template: the share of common terms, over the geometric mean of both
counts, reaches ``MIN_NEAR``. A file with such a segment has its whole text
scored too. Equal segments are scored once. Weights are TF-IDF, the term
frequency by its logarithm and document frequencies over the templates alone,
so that a file's licence does not depend on the other files; vectors stay
sparse rows (segment, term), and only terms that a template has meet a
template. The template vectors are a broadcast bounded by
``TEMPLATES`` and the licence texts.

A file is a licence file if its name says so, or if its name has no
extension and its whole text is like a template; it then licenses its
directory. A file without a licence of its
own takes that of the nearest ancestor directory with one, found by joining
the distinct directories, with their ancestors, to the licensed ones.

``licence`` is that of the best segment; ``licences`` has it and every other
licence that some segment of the file matches with ``ALSO_SCORE`` or more, in
order of names.

Defined results: null text has no segments; a null path has no directory
and inherits nothing; a tie between templates or segments goes to the smaller
licence name, between licence files of one directory to the better score, then the
smaller licence and path; rows that repeat path and text are scanned alike;
an empty table gives an empty result; extra columns are kept, but for those
named as a column of ``RESERVED``, which the scan's own replace.
"""

from __future__ import annotations

import re
from collections import Counter
from math import log, sqrt
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LICENCE_FILE = "(?i)^(un)?licen[sc]e|^copying|^copyright|^notice(\\.|$)"
MIN_SCORE = 0.5
ALSO_SCORE = 0.8
MIN_NEAR = 0.3
MAX_LINES = 16
LONG = 200  # a template of more telling terms meets blocks over MAX_LINES and whole texts only
# Terms that tell nothing of a licence (fixed values).
PLAIN = frozenset("""a an and any are as at be been by can for from has have if in is it its not of on or such that the
this to was were which with you your""".split())
TERM = re.compile("[^\\W_]+(?:[.-][^\\W_]+)*")
MARKS = re.compile("^\\s*(?:/\\*+|\\*+/|\\*+|//+|#+|--+|;+|%+|<!--|\"\"\"|'''|rem\\b|dnl\\b)?\\s*|\\s*(?:\\*+/|-->|\"\"\"|''')?\\s*$", re.I)
# Columns the scan works with or returns.
RESERVED = {"path_key", "no_path", "text", "content", "text_key", "own_licence", "own_score", "whole", "directory",
            "from_directory", "from_licence", "licence", "licences", "own_licences", "score", "origin", "licence_directory"}

# Short notices and headers by SPDX name (fixed values).
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except "
                   "in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0, Creative Commons Attribution ShareAlike."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, all copyright is waived, dedicated to the public domain, CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "Copyright. All rights reserved."),
    # headers as they stand wrapped in files
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                   "writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT "
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
                   "language governing permissions and limitations under the License."),
    *[(name, f"This {thing} is free software; you can redistribute it and/or modify it under the terms of the GNU "
             f"{kind}General Public License as published by the Free Software Foundation; either version {version} "
             "of the License, or (at your option) any later version.")
      for name, thing, kind, version in [
          ("GPL-2.0", "program", "", "2"), ("GPL-3.0", "program", "", "3"), ("AGPL-3.0", "program", "Affero ", "3"),
          ("LGPL-2.1", "library", "Lesser ", "2.1"), ("LGPL-3.0", "library", "Lesser ", "3")]],
]
# Whole licences (fixed values).
WHOLE_TEXTS = [
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    *[(name, """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. """ + clause + """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS
OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER
IN CONTRACT, STRICT LIABILITY, OR TORT ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE.""")
      for name, clause in [("BSD-2-Clause", ""), ("BSD-3-Clause", "Neither the name of the copyright holder nor the names "
                            "of its contributors may be used to endorse or promote products derived from this software "
                            "without specific prior written permission. ")]],
    # licences of many pages, one file each
    *[(path.stem, path.read_text()) for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))],
]
# Headers that only name the licence.
IDENTIFIERS = [(name, f"SPDX-License-Identifier: {name}")
               for name in sorted({name for name, _ in NOTICES + WHOLE_TEXTS} - {"Proprietary"})]
TEMPLATES = NOTICES + IDENTIFIERS + WHOLE_TEXTS


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[\\p{L}\\p{N}]+(?:[.-][\\p{L}\\p{N}]+)*"), F.lit(0))


def finder(templates: list[tuple[str, str]], min_near: float = MIN_NEAR):
    """A function from a text to its (kind, segment) near a template."""
    telling = lambda text: set(TERM.findall(text.lower())) - PLAIN
    sets = sorted({tuple(sorted(telling(t))) for _, t in templates})
    having: dict[str, list[int]] = {}  # the short templates of a term
    all_having: dict[str, list[int]] = {}
    for n, terms in enumerate(sets):
        for term in terms:
            all_having.setdefault(term, []).append(n)
            if len(terms) <= LONG:
                having.setdefault(term, []).append(n)

    def near(terms: set[str], index: dict[str, list[int]] = having) -> bool:
        common = Counter(n for term in terms & index.keys() for n in index[term])
        return any(k >= min_near * sqrt(len(terms) * len(sets[n])) for n, k in common.items())

    def found(text: str | None) -> set[tuple[str, str]]:
        whole = telling(text or "")
        if whole.isdisjoint(all_having):
            return set()
        out = {("whole", text)} if near(whole, all_having) else set()
        block: list[tuple[str, set[str]]] = []
        for line in [*text.split("\n"), ""]:
            line = MARKS.sub("", line)
            if line:
                block.append((line, telling(line)))
                continue
            # a window starts and ends at a line with a term of a template
            hits = [not terms.isdisjoint(having) for _, terms in block]
            for at in (n for n, hit in enumerate(hits) if hit):
                terms: set[str] = set()
                for end in range(at, min(at + MAX_LINES, len(block))):
                    terms |= block[end][1]
                    if hits[end] and near(terms):
                        out.add(("lines", " ".join(x for x, _ in block[at:end + 1])))
            if len(block) > MAX_LINES and near(set().union(*[terms for _, terms in block]), all_having):
                out.add(("lines", " ".join(x for x, _ in block)))
            block = []
        return out | {("whole", text)} if out else out

    return found


def segments(files: DataFrame, templates: list[tuple[str, str]], min_near: float = MIN_NEAR) -> DataFrame:
    """(row key, kind, segment) of every segment near a template."""
    def search(batches):
        found = finder(templates, min_near)
        names = ["path_key", "text_key", "kind", "segment"]
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows = [(path, key, *x) for path, key, text in zip(*[part.column(c).to_pylist() for c in (
                    "path_key", "text_key", "text")]) for x in sorted(found(text))]
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kind) for n, kind in enumerate(
                    (pa.string(), pa.int64(), pa.string(), pa.string()))], names=names)

    return files.select("path_key", "text_key", "text").mapInArrow(
        search, "path_key string, text_key long, kind string, segment string")


def scores(distinct: DataFrame, templates: list[tuple[str, str]]) -> DataFrame:
    """Best template of every distinct segment: segment_key, licence, score."""
    spark = distinct.sparkSession
    known = spark.createDataFrame([(f"t{n}", name, text) for n, (name, text) in enumerate(templates)],
                                  "segment_key string, licence string, segment string")
    counted = lambda rows: (rows.select("segment_key", F.explode(terms_of(F.col("segment"))).alias("term"))
                            .groupBy("segment_key", "term").agg((1 + F.log(F.count(F.lit(1)))).alias("tf")))
    found, given = counted(distinct), counted(known)
    rare = log(1 + len(templates)) + 1  # of a term that no template has
    idf = given.groupBy("term").agg((F.lit(rare) - F.log(1 + F.count(F.lit(1)))).alias("idf"))
    weight = lambda rows: rows.join(F.broadcast(idf), "term", "left").withColumn(
        "w", F.col("tf") * F.coalesce("idf", F.lit(rare)))
    norm = lambda rows: rows.groupBy("segment_key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    given = weight(given)
    given = (given.join(norm(given), "segment_key").join(known.select("segment_key", "licence"), "segment_key")
             .select("term", "licence", F.col("segment_key").alias("template"), (F.col("w") / F.col("norm")).alias("t")))
    found = weight(found)
    dots = (found.join(F.broadcast(given), "term").groupBy("segment_key", "template", "licence")
            .agg(F.sum(F.col("w") * F.col("t")).alias("dot")))
    best = F.max_by(F.struct("licence", "score"), F.struct("score", F.col("rank")))
    ranks = spark.createDataFrame([(name, -n) for n, name in enumerate(sorted({t[0] for t in templates}))],
                                  "licence string, rank int")
    return (dots.join(norm(found), "segment_key").withColumn("score", F.round(F.col("dot") / F.col("norm"), 6))
            .join(F.broadcast(ranks), "licence").groupBy("segment_key").agg(best.alias("b")).select("segment_key", "b.*"))


def directory_of(path: Column) -> Column:
    """Path up to its last slash, without it; the root is the empty string."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def ancestors_of(directory: Column) -> Column:
    """The directory itself and every directory above it, with their depth."""
    parts = F.when(directory == "", F.array().cast("array<string>")).otherwise(F.split(directory, "/"))
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(
        n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("above")))


def scan(files: DataFrame, path: Column, text: Column, min_score: float = MIN_SCORE,
         templates: list[tuple[str, str]] | None = None, also_score: float = ALSO_SCORE,
         min_near: float = MIN_NEAR) -> DataFrame:
    """One row per file: its columns, ``licence`` (null: none), ``score`` of
    its own match, ``licences`` of its own text (else the inherited one), ``origin`` ('own', 'inherited', 'none') and
    ``licence_directory`` it inherits from."""
    keyed = files.select(*[f"`{c}`" for c in files.columns if c.lower() not in RESERVED],
                         F.coalesce(path.cast("string"), F.lit("")).alias("path_key"),
                         path.isNull().alias("no_path"), text.cast("string").alias("text"))
    keyed = keyed.withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    # the texts are searched once; all that follows reads the segments found
    named = (segments(keyed.select("path_key", "text_key", "text"), templates or TEMPLATES, min_near)
             .withColumn("segment_key", F.sha2("segment", 256)).checkpoint())
    best = scores(named.select("segment_key", "segment").dropDuplicates(["segment_key"]),
                  templates or TEMPLATES).filter(F.col("score") >= min_score)
    own = (named.select("path_key", "text_key", "kind", "segment_key").join(best, "segment_key")
           .groupBy("path_key", "text_key").agg(
               F.min(F.struct((-F.col("score")).alias("s"), "licence", "score")).alias("own"),
               F.array_sort(F.collect_set(F.when(F.col("score") >= also_score, F.col("licence")))).alias("also"),
               F.coalesce(F.max(F.col("kind") == "whole"), F.lit(False)).alias("whole")))
    own = own.select("path_key", "text_key", F.col("own.licence").alias("own_licence"),
                     F.col("own.score").alias("own_score"), "whole",
                     F.array_sort(F.array_union("also", F.array("own.licence"))).alias("own_licences"))
    matched = (keyed.drop("text").join(own, ["path_key", "text_key"], "left")
               .withColumn("directory", F.when(~F.col("no_path"), directory_of(F.col("path_key")))).checkpoint())
    name = F.regexp_extract("path_key", "[^/]*$", 0)
    licence_file = (F.col("whole") & ~F.contains(name, F.lit("."))) | name.rlike(LICENCE_FILE)
    licensed = (matched.filter(F.col("own_licence").isNotNull() & F.col("directory").isNotNull() & licence_file)
                .groupBy(F.col("directory").alias("above"))
                .agg(F.min(F.struct((-F.col("own_score")).alias("s"), "own_licence", "path_key")).alias("best"))
                .select("above", F.col("best.own_licence").alias("above_licence")))
    nearest = (matched.select("directory").filter("directory is not null").distinct()
               .select("directory", F.explode(ancestors_of(F.col("directory"))).alias("a")).select("directory", "a.*")
               .join(licensed, "above").groupBy("directory")
               .agg(F.max_by(F.struct("above", "above_licence"), "depth").alias("n"))
               .select("directory", F.col("n.above").alias("from_directory"), F.col("n.above_licence").alias("from_licence")))
    has = F.col("own_licence").isNotNull()
    return (matched.join(nearest, "directory", "left")
            .withColumns({
                "licence": F.coalesce("own_licence", "from_licence"),
                "licences": F.coalesce("own_licences", F.array_compact(F.array("from_licence"))), "score": F.col("own_score"),
                "origin": F.when(has, "own").when(F.col("from_licence").isNotNull(), "inherited").otherwise("none"),
                "licence_directory": F.when(~has, F.col("from_directory"))}))


def scan_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents as files ``source/lang/doc_id`` of a tree."""
    rows = docs.select("doc_id", F.concat_ws("/", F.coalesce("source", F.lit("unknown")),
                                             F.coalesce("lang", F.lit("unknown")),
                                             F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).alias("path"),
                       F.col("text").alias("content"))
    return scan(rows, F.col("path"), F.col("content"), **options).select(
        "doc_id", "path", "licence", "licences", "score", "origin", "licence_directory")
