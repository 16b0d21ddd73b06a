import math
from collections import Counter

import pytest

from deidflow.llm import license as lic


def words(text):
    import re

    return [w for w in (x.strip(".-+") for x in re.split(r"[^a-z0-9.+\-]+", text.lower())) if w]


def cosine(text, template, n, df):
    idf = lambda w: math.log((1 + n) / (1 + df[w])) + 1 if w in df else math.log(1 + n) + 1
    a, b = Counter(words(text)), Counter(words(template))
    va, vb = {w: k * idf(w) for w, k in a.items()}, {w: k * idf(w) for w, k in b.items()}
    return sum(v * vb.get(w, 0) for w, v in va.items()) / math.sqrt(sum(v * v for v in va.values())) / math.sqrt(sum(v * v for v in vb.values()))


ROWS = [
    (1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/x.py", "code"), (3, "a/b/c/LICENSE", "Licensed under the Apache License, Version 2.0."), (4, "a/b/c/d/y", "foo"), (5, "z/q", None),
    (6, None, "t"), (7, "a/b/c/h", "GNU General Public License, version 3 this work is licensed under the\n" + "w " * 100), (8, "top", ""), (9, "a/w", "All rights reserved.\n" + "w " * 30),
    (10, "z/r", "this license of mine says something else entirely"), (10, "z/r", "this license of mine says something else entirely"),
]


def test_inheritance(spark):
    df = spark.createDataFrame([(*r, "mine") for r in ROWS], "file long, path string, text string, licence string")
    got = {r.file: (r.licence, r.basis, r.origin) for r in lic.scan(df).collect()}
    assert got == {
        1: ("MIT", "file", None), 2: ("MIT", "inherited", "a"), 3: ("Apache-2.0", "file", None), 4: ("Apache-2.0", "inherited", "a/b/c"), 5: (None, "none", None), 6: (None, "none", None),
        7: ("GPL-3.0", "header", None), 8: (None, "none", None), 9: ("Proprietary", "header", None), 10: (None, "none", None),
    }
    assert lic.scan(df).count() == len(ROWS)


def test_cosines_equal_brute_force(spark):
    files = lic.keyed(spark.createDataFrame(ROWS, "file long, path string, text string"))
    words_ = lic.vocabulary()
    counts = lic.document_frequencies(lic.held_words(files, words_), words_)
    assert counts["license"] == 5
    own = {r.file: r for r in lic.own_licences(files).join(files, "key").collect()}
    for file, text in ((1, ROWS[0][2]), (3, ROWS[2][2]), (7, ROWS[6][2].split("\n")[0])):
        best = min((-round(cosine(text, t, len(ROWS), counts), 6), name) for name, t in (*lic.TEMPLATES, *lic.TITLES))
        assert (own[file].licence, own[file].score) == (best[1], pytest.approx(-best[0], abs=2e-6))


def full(name):
    return max((t for n, t in lic.TEMPLATES if n == name), key=len)


def wrap(text, width, mark):
    import textwrap

    return "\n".join(mark + line for line in textwrap.wrap(text, width))


GPL = next(t for n, t in lic.TEMPLATES if n == "GPL-3.0" and "free software" in t)
CODE = "\n".join(f"x{k} = call_{k}(alpha{k}, beta{k})" for k in range(60))
WRAPPED = [
    (1, "p/a.py", wrap("Frobnicate 1.0", 60, "# ") + "\n#\n" + wrap(GPL, 40, "# ") + "\n#\n# more to come\n" + CODE, "GPL-3.0", "header"),
    (2, "p/b.c", "/*\n" + wrap(full("MIT"), 50, " * ") + "\n */\n" + CODE, "MIT", "header"), (3, "q/LICENSE", "Copyright 2020 Somebody Else\n\n" + wrap(full("MIT"), 70, ""), "MIT", "file"),
    (4, "q/x.py", CODE, "MIT", "inherited"), (5, "r/LICENSE", wrap(full("ISC"), 60, ""), "ISC", "file"), (6, "r/one", next(t for n, t in lic.TEMPLATES if n == "ISC"), "ISC", "file"),
    (7, "s/COPYING", wrap(full("BSD-3-Clause"), 72, ""), "BSD-3-Clause", "file"), (8, "s/t/COPYING", wrap(full("BSD-2-Clause"), 72, ""), "BSD-2-Clause", "file"),
    (9, "u/LICENSE", "   Apache License\n  Version 2.0, January 2004\n http://www.apache.org/licenses/\n\n TERMS AND CONDITIONS\n\n" + "\n".join(f"clause {k} of some legal matter" for k in range(300)), "Apache-2.0", "file"),
    (10, "u/v/w/y.py", CODE, "Apache-2.0", "inherited"), (11, "z/prose", "the software of the author is free and the use of it is good\n" * 50, None, "none"), (12, "z/long", CODE * 200 + "\nReleased under the MIT License\n", "MIT", "header"),
    (13, "z/mid", "word " * 50_000, None, "none"),
]


def test_wrapped_headers_and_licence_files(spark):
    df = spark.createDataFrame([(*r[:3], "own", 1, "k") for r in WRAPPED], "file long, path string, text string, licence string, key int, unit string")
    got = {r.file: (r.licence, r.basis) for r in lic.scan(df).collect()}
    assert got == {r[0]: r[3:] for r in WRAPPED}


def test_leading_words_lose_nothing(spark):
    files = lic.keyed(spark.createDataFrame([r[:3] for r in WRAPPED], "file long, path string, text string"))
    words_ = lic.vocabulary()
    counts = lic.document_frequencies(lic.held_words(files, words_), words_)
    index = lic.Index(len(WRAPPED), counts, lic.NEAR)
    every = lic.units_of(files, index, 0.0, set(words_))
    lead = {(r.key, r.kind, r.unit) for r in lic.units_of(files, index, lic.NEAR).collect()}
    near = {(r.key, r.kind, r.unit) for r in lic.match_units(every, index).where(f"cosine >= {lic.NEAR}").collect()}
    assert near <= lead and len(near) > 10 and len(lead) < every.count()


def test_repeated_keys_and_nulls(spark):
    rows = [(1, "a/x", "Released under the MIT License"), (1, "a/y", "code"), (None, "b/x", "Released under the MIT License"), (None, "b/x", "Released under the MIT License"), (None, None, None)]
    got = sorted(((r.file, r.path, r.licence, r.basis) for r in lic.scan(spark.createDataFrame(rows, "file long, path string, text string")).collect()), key=str)
    assert got == sorted([(1, "a/x", "MIT", "file"), (1, "a/y", "MIT", "inherited"), (None, "b/x", "MIT", "file"), (None, "b/x", "MIT", "file"), (None, None, None, "none")], key=str)


def test_empty_table(spark):
    assert lic.scan(spark.createDataFrame([], "file long, path string, text string")).count() == 0


def test_clashing_columns_and_very_long_texts(spark):
    notice = "Released under the MIT License"
    long = "\n".join(["x = 1  # code"] * 100_000 + [notice] + ["y = 2"] * 100_000)
    rows = [(1, "a/LICENSE", notice), (2, "a/b/c", long), (3, "a/b/d", "code")]
    names = "licence string, score string, basis string, origin string, key string, dir string, unit string, word string, inherited string"
    plain = lic.scan(spark.createDataFrame(rows, "file long, path string, text string"))
    clash = lic.scan(spark.createDataFrame([(*r, *"abcdefghi") for r in rows], f"file long, path string, text string, {names}"))
    got = sorted(map(tuple, clash.collect()))
    assert clash.columns == plain.columns and got == sorted(map(tuple, plain.collect()))
    assert [(r[2], r[4]) for r in got] == [("MIT", "file"), ("MIT", "header"), ("MIT", "inherited")]
