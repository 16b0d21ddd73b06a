"""Licence scans: sparse TF-IDF cosine to templates, then inheritance from the nearest directory with a licence file.

1. Templates are short notices, whole licence texts and titles of long licences. A file's units are its lines, its paragraphs
   (lines up to a blank one), its runs of lines that consist of template words for the most part (wrapped headers inside code),
   and its whole text. Units become sparse vectors over the words of the templates: term frequency times inverse document
   frequency, which is counted over all files; a unit's other words count in its length with the greatest weight.
2. Only units that share a *leading* word with a template are compared. The leading words of a template are its rarest, so
   many that what remains of its vector is shorter than ``NEAR``: a unit without any of them cannot reach that cosine, so
   nothing is lost. Files without such a word are left out by the words that were counted for the frequencies.
3. Units meet the templates on shared words; the cosine decides: ``NEAR`` or more is a match. A file's best match is its
   header; a file that matches as a whole, whose matching units hold half of its words, or that begins with the title of a
   licence is a licence file.
4. A licence file gives its licence to its directory. Every directory takes the licence of its nearest ancestor that has
   one, itself first, by a join of directory prefixes; files without a licence of their own inherit it.

Defined results: a null or empty text has no licence of its own and may inherit; a null path inherits nothing; a null file
key is a key like others; rows are told apart by key and text, so repeated rows are kept and have the same result; very long
texts are read whole; ties go to the alphabetically first licence, in a directory to the best score and then the first
licence; an empty table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import materialise

NEAR = 0.75
WORD = r"[^a-z0-9.+\-]+"
LINE = r"\r\n|\r|\n"
#: Lines, not counting blank ones, in which a title stands.
TOP = 3
#: Files that may be named in a broadcast; of more, every text is read again.
MAX_BROADCAST_FILES = 500_000
#: Directories that may be broadcast; more are joined by a shuffle.
MAX_BROADCAST_DIRS = 200_000

# The customary short notices of common licences, and the whole texts of short ones.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("BSD-2-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("BSD-3-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("Unlicense", 'This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.'),
    ("Proprietary", "All rights reserved"),
    ("Proprietary", "Copyright. All rights reserved"),
)

# How the texts of long licences begin. A file with such a paragraph at its top is that licence's text.
TITLES = (
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
)


def _words(text: Column) -> Column:
    """Lower-case words without the stops at their ends."""
    return F.filter(F.transform(F.split(F.lower(text), WORD), lambda w: F.trim(w, F.lit(".-+"))), lambda w: w != "")


def split_words(text: str) -> list[str]:
    """``_words`` of a template, on the driver."""
    return [w for w in (x.strip(".-+") for x in re.split(WORD, text.lower())) if w]


class Index:
    """Unit vectors of the templates under the files' document frequencies, and their leading words. Its size is the templates'."""

    def __init__(self, n: int, df: dict[str, int], near: float, notices=TEMPLATES, titles=TITLES) -> None:
        self.most = math.log(1 + n) + 1
        self.idf = {w: math.log((1 + n) / (1 + k)) + 1 for w, k in df.items()}
        self.rows, self.leading = [], set()  # template, licence, is a title, term, weight
        for k, (licence, text) in enumerate((*notices, *titles)):
            weights = {w: tf * self.idf[w] for w, tf in Counter(split_words(text)).items()}
            norm = math.sqrt(sum(v * v for v in weights.values()))
            rest = 1.0
            for w in sorted(weights, key=lambda w: (df[w], -weights[w], w)):
                self.rows.append((k, licence, k >= len(notices), w, weights[w] / norm))
                if rest >= (near - 1e-9) ** 2:
                    self.leading.add(w)
                rest -= (weights[w] / norm) ** 2


def vocabulary(templates=(*TEMPLATES, *TITLES)) -> list[str]:
    return sorted({w for _, text in templates for w in split_words(text)})


def keyed(files: DataFrame) -> DataFrame:
    """key (of file and text, 96 bits), file, path, text."""
    key = F.concat_ws(":", F.xxhash64("file", "text").cast("string"), F.hash("text").cast("string"))
    return files.select(key.alias("key"), "file", "path", "text")


def held_words(files: DataFrame, words: list[str]) -> DataFrame:
    """key and the words of the templates in each whole text."""
    held = F.array_intersect(_words(F.coalesce(F.col("text"), F.lit(""))), _literal(words))
    return files.select("key", held.alias("held"))  # without a filter, which would work the words out twice


def document_frequencies(held: DataFrame, words: list[str]) -> dict[str, int]:
    """Files that hold each of the words."""
    counts = held.select(F.explode("held").alias("term")).groupBy("term").agg(F.count("*").alias("n")).collect()  # the templates' words
    return dict.fromkeys(words, 0) | {r["term"]: r["n"] for r in counts}


def _numbers(values) -> Column:
    return F.from_json(F.lit(json.dumps(list(values))), "array<double>")


def _literal(words) -> Column:
    return F.from_json(F.lit(json.dumps(sorted(words))), "array<string>")


def units_of(files: DataFrame, index: Index, near: float, leading: set[str] | None = None) -> DataFrame:
    """key, unit, kind, top and words of the units that have a leading word and may reach ``near``.

    What a unit's other words weigh at least, and what its known words weigh, bound its cosine from above; so prose around a
    notice is left out before words are counted one by one.
    """
    known, lead = _literal(index.idf), _literal(index.leading if leading is None else leading)
    every = files.select("key", F.posexplode(F.split("text", LINE)).alias("place", "line")).select("key", "place", _words(F.col("line")).alias("words"))
    order = Window.partitionBy("key").orderBy("place")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    every = every.withColumn("first", F.coalesce(F.size(F.lag("words").over(order)), F.lit(0)) == 0).where(F.size("words") > 0)
    # A paragraph begins after a blank line or at the start; runs, of lines that are alike in this, leave blank lines out.
    like = 2 * F.size(F.array_intersect("words", known)) >= F.size(F.array_distinct("words"))
    line = every.select("key", "place", "words", "first", like.alias("like"))
    line = line.withColumn("turn", (F.col("like") != F.coalesce(F.lag("like").over(order), F.lit(False))).cast("int"))
    line = line.select("key", "words", "like", (F.row_number().over(order) - 1).alias("at"), F.sum(F.col("first").cast("int")).over(upto).alias("paragraph"), F.sum("turn").over(upto).alias("run"))
    line = materialise(line, "licence-lines")

    def together(by: str, of: DataFrame) -> DataFrame:
        grouped = of.groupBy("key", F.col(by).cast("int").alias("unit")).agg(F.array_sort(F.collect_list(F.struct("at", "words"))).alias("parts"))
        many = grouped.where(F.size("parts") > 1)  # lines of one text
        return many.select("key", "unit", F.lit(by).alias("kind"), (F.element_at("parts.at", 1) < TOP).alias("top"), F.flatten("parts.words").alias("words"))

    single = line.select("key", F.col("at").alias("unit"), F.lit("line").alias("kind"), (F.col("at") < TOP).alias("top"), "words")
    whole = files.select("key", F.lit(0).alias("unit"), F.lit("whole").alias("kind"), F.lit(True).alias("top"), _words(F.col("text")).alias("words"))
    found = single.union(together("paragraph", line)).union(together("run", line.where("like"))).union(whole)
    found = found.where(F.size(F.array_intersect("words", lead)) > 0)
    weights = _numbers(index.idf[w] for w in sorted(index.idf))
    shared = F.array_intersect("words", known)
    # Terms are few; each is counted in the unit.
    heavy = F.aggregate(shared, F.lit(0.0), lambda total, w: total + F.pow(F.get(weights, F.array_position(known, w).cast("int") - 1) * F.size(F.filter("words", lambda x: x == w)), F.lit(2.0)))
    others = (F.size(F.array_distinct("words")) - F.size(shared)) * index.most**2
    return found.where((1 - near**2) * heavy * (1 + 1e-9) >= near**2 * others)


def match_units(units: DataFrame, index: Index) -> DataFrame:
    """key, unit, kind and n_words with the best licence, its cosine and whether it is a title, of units that share a word with a template."""
    spark = units.sparkSession
    idf = spark.createDataFrame(list(index.idf.items()), "term string, idf double")
    lists = spark.createDataFrame(index.rows, "template int, licence string, title boolean, term string, w double")
    lists = lists.groupBy("term").agg(F.collect_list(F.struct("template", "licence", "title", "w")).alias("list"))
    own = ("key", "kind", "unit")
    counted = units.select(*own, "top", F.explode("words").alias("term")).groupBy(*own, "top", "term").agg(F.count("*").alias("tf"))
    # Both sides are bounded by the templates' words.
    joined = counted.join(F.broadcast(idf), "term", "left").join(F.broadcast(lists), "term", "left")
    joined = joined.withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(index.most)))
    lengths = joined.groupBy(*own).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"), F.sum("tf").alias("n_words"))
    dots = joined.where("list IS NOT NULL").select(*own, "top", "w", F.explode("list").alias("t")).where("top OR NOT t.title")
    dots = dots.groupBy(*own, F.col("t.template").alias("template"), F.col("t.licence").alias("licence"), F.col("t.title").alias("title")).agg(F.sum(F.col("w") * F.col("t.w")).alias("dot"))
    scored = dots.join(lengths, list(own)).withColumn("cosine", F.round(F.col("dot") / F.col("length"), 6))
    best = F.min(F.struct((-F.col("cosine")).alias("minus"), "licence", (~F.col("title")).alias("plain")))
    out = scored.groupBy(*own, "n_words").agg(best.alias("best"))
    return out.select(*own, "n_words", F.col("best.licence").alias("licence"), (-F.col("best.minus")).alias("cosine"), (~F.col("best.plain")).alias("title"))


def own_licences(files: DataFrame, near: float = NEAR) -> DataFrame:
    """key, licence, score and is_licence_file of the ``keyed`` files that have a licence of their own."""
    words = vocabulary()
    held = materialise(held_words(files, words), "licence-words")
    index = Index(held.count(), document_frequencies(held, words), near)
    named = materialise(held.where(F.size(F.array_intersect("held", _literal(index.leading))) > 0).select("key").distinct(), "licence-files", narrow=True)
    if named.count() <= MAX_BROADCAST_FILES:
        some = files.join(F.broadcast(named), "key", "left_semi")
    else:
        some = files.where(F.size(F.array_intersect(_words(F.coalesce(F.col("text"), F.lit(""))), _literal(index.leading))) > 0)
    some = materialise(some.select("key", "text").dropDuplicates(["key"]), "licence-texts")
    units = materialise(units_of(some, index, near), "licence-units")
    matched = match_units(units, index).where(F.col("cosine") >= near)
    best = F.min(F.struct((-F.col("cosine")).alias("minus"), "licence"))
    held_by = lambda kind: F.col("kind") == kind
    totals = some.select("key", F.size(_words(F.col("text"))).alias("total"))
    own = matched.groupBy("key").agg(
        best.alias("best"), F.bool_or(held_by("whole") | F.col("title")).alias("as_whole"),
        F.greatest(F.sum(F.when(held_by("line"), F.col("n_words")).otherwise(0)), F.max("n_words")).alias("held"),
    )
    licence_file = F.col("as_whole") | (2 * F.col("held") >= F.col("total"))
    return own.join(totals, "key").select("key", F.col("best.licence").alias("licence"), (-F.col("best.minus")).alias("score"), licence_file.alias("is_licence_file"))


def _parent(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def directory_licences(dirs: DataFrame, given: DataFrame) -> DataFrame:
    """dir, inherited licence and origin: the nearest of ``given`` (dir, licence, score) at or above each of ``dirs``."""
    parts = F.split("dir", "/")
    up = dirs.select("dir", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth")).withColumn("above", F.array_join(F.slice(F.split("dir", "/"), F.lit(1), F.col("depth")), "/"))
    best = given.groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("minus"), "licence"))["licence"].alias("inherited"))
    met = up.join(best.withColumnRenamed("dir", "above"), "above")
    return met.groupBy("dir").agg(F.max_by("inherited", "depth").alias("inherited"), F.max_by("above", "depth").alias("origin"))


def scan(files: DataFrame, near: float = NEAR) -> DataFrame:
    """file, path, licence, score, basis (file, header, inherited, none) and origin for every row of ``files``.

    ``files``: file (a key), path (with / between names) and text.
    """
    files = keyed(files)
    own = materialise(own_licences(files, near), "licences")
    placed = files.select("key", "file", "path", _parent(F.col("path")).alias("dir"))
    given = placed.join(own.where("is_licence_file"), "key").where("dir IS NOT NULL").select("dir", "licence", "score")
    dirs = materialise(directory_licences(placed.where("dir IS NOT NULL").select("dir").distinct(), given), "licence-dirs")
    small = dirs.count() <= MAX_BROADCAST_DIRS
    joined = placed.join(F.broadcast(dirs) if small else dirs, "dir", "left").join(own, "key", "left")
    basis = F.when(F.col("is_licence_file"), "file").when(F.col("licence").isNotNull(), "header").when(F.col("inherited").isNotNull(), "inherited").otherwise("none")
    return joined.select(
        "file", "path", F.coalesce("licence", "inherited").alias("licence"), F.coalesce("score", F.lit(0.0)).alias("score"), basis.alias("basis"),
        F.when(basis == "inherited", F.col("origin")).alias("origin"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: the source is the top directory, thousands of ids the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = F.concat_ws("/", "source", F.floor(F.col("doc_id") / 1000).cast("string"), F.col("doc_id").cast("string"))
    return scan(docs.select(F.col("doc_id").alias("file"), path.alias("path"), "text")).withColumnRenamed("file", "doc_id")
