import random

import pytest
from pyspark.sql import functions as F

from deidflow.llm import neardup


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets, parent = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_components_equal_brute_force(docs, prose):
    rng = random.Random(2)
    base, rows = prose(150), []
    rows += [(k, edited(rng, base, rng.randrange(12))) for k in range(60, 160)]  # a dense group around the threshold
    chain = prose(120)
    for k in range(200, 215):  # neighbours are near, ends are not
        chain = edited(rng, chain, 1)
        rows.append((k, chain))
    rows += [(k, prose(60)) for k in range(300, 340)] + [(500, base.upper()), (501, base)] + [(7, None), (8, ""), (9, " "), (10, "one two"), (11, "ONE\ttwo"), (12, "one two three")]
    passage = prose(30)
    rows += [(k, prose(40) + " " + passage) for k in range(600, 640)]
    want = brute(rows)
    got = {r.doc_id: r for r in neardup.near_duplicates(docs([(i, t, "s") for i, t in rows])).collect()}
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_large_nodes_compare_in_blocks(docs, prose, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL", 4)
    monkeypatch.setattr(neardup, "IN_BLOCK", 8)
    monkeypatch.setattr(neardup, "COLUMNS", 50)
    rng, base = random.Random(4), prose(150)
    rows = [(k, edited(rng, base, rng.randrange(3, 9))) for k in range(70)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs([(i, t, "s") for i, t in rows])).collect()}
    assert got == brute(rows)


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(10, 40)] + [(100, k) for k in range(101, 130)]
    found = {r.id: r.component for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(found.values()) == {10, 100} and found[40] == 10 and found[129] == 100
    assert neardup.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("rows", [[], [(None, "a b c d e f", "s")], [(1, "a b c d e f", "s")] * 3])
def test_edges(docs, rows):
    assert neardup.near_duplicates(docs(rows)).count() == len(rows)
    assert neardup.keep(docs(rows)).count() == min(len(rows), 1)


def test_keep_leaves_one_of_a_group(docs, prose):
    base = prose(80)
    rows = [(5, base, "a"), (3, base + " tail", "b"), (9, prose(80), "c"), (None, base, "d")]
    kept = neardup.keep(docs(rows))
    assert {r.doc_id for r in kept.collect()} == {3, 9, None} and kept.where(F.col("n_words") == "x").count() == 3


def test_similarity_is_a_parameter_of_every_step(spark, docs, prose):
    import corpus_pipeline

    rng, rows = random.Random(6), []
    for k in range(0, 120, 2):  # three edits of 150 words leave a similarity of 0.81, most of the time
        text = prose(150)
        rows += [(k, text), (k + 1, edited(rng, text, 3))]
    sets = {i: shingles(t) for i, t in rows}
    near = [len(sets[k] & sets[k + 1]) / len(sets[k] | sets[k + 1]) for k in range(0, 120, 2)]
    assert sum(0.8 <= x < 0.85 for x in near) >= 20
    table = docs([(i, t, "s") for i, t in rows])
    for similarity in (0.85, 0.8):
        want = {i: i - 1 if i % 2 and near[i // 2] >= similarity else i for i in sets}
        assert {r.doc_id: r.component_id for r in neardup.near_duplicates(table, similarity).collect()} == want
    assert {r.doc_id for r in corpus_pipeline.neardup_stage(spark, table, "").collect()} == set(want.values())


def test_bound():
    old, low = neardup.Bound.of(0.85), neardup.Bound.of(0.8)
    assert (old.matches, old.second, old.second_below) == (88, 0.35, 0.18) and (low.matches, low.second_below) == (79, 0.25) and low.second > 0.5


@pytest.mark.parametrize("broadcast", [0, 10**6])
def test_heavy_keys_are_spread(docs, prose, monkeypatch, broadcast):
    for name, value in {"HEAVY": 3, "PARTS": 3, "SMALL": 4, "IN_BLOCK": 8, "MAX_BROADCAST_IDS": broadcast, "MAX_BROADCAST_GROUPS": broadcast}.items():
        monkeypatch.setattr(neardup, name, value)
    rng, base = random.Random(6), prose(120)
    rows = [(k, edited(rng, base, rng.randrange(2, 9))) for k in range(40)] + [(100 + k, base) for k in range(30)] + [(200 + k, None) for k in range(20)]
    rows += [(300 + k, prose(40)) for k in range(10)]
    want = brute(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs([(i, t, "s") for i, t in rows])).collect()}
    assert got == want


def test_a_forest_joins_what_all_links_join():
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(20):
        near = rng.random((12, 9)) < 0.12
        names = np.arange(21)
        i, j = neardup._forest(near, names)

        def parts(links):
            label = list(range(21))
            for _ in range(21):
                for a, b in links:
                    label[a] = label[12 + b] = min(label[a], label[12 + b])
            return label

        assert near[i, j].all() and parts(list(zip(i, j))) == parts(list(zip(*np.nonzero(near)))) and len(i) < 21
