import numpy as np
import pytest
from pyspark.sql import functions as F

from deidflow.llm import mixing


def corpus(spark, n=1200):
    rng = np.random.default_rng(2)
    pools = {"high": "river stone cloud forest", "low": "BUY NOW!! CASH$$$", "toxic": "idiot moron river stone"}
    rows = [(k, " ".join(rng.choice(pools[d].split(), rng.integers(20, 60))), d) for k in range(n) for d in [["high", "high", "low", "toxic"][k % 4]]]
    df = spark.createDataFrame(rows, "doc_id long, text string, d string")
    return df.drop("d").withColumn("rate", F.lit("mine")), df.select("doc_id", F.col("d").alias("domain"))


def test_expected_tokens_meet_the_targets(spark):
    docs, labels = corpus(spark)
    targets = {"high": 0.8, "low": 0.15, "toxic": 0.05}
    got = mixing.mix(docs, labels.where("doc_id % 8 < 7"), targets).collect()
    r, n, p = np.array([x.rate for x in got]), np.array([x.n_tokens for x in got]), np.array([x.posterior for x in got])
    total = (r * n) @ p
    assert np.allclose(total / total.sum(), [0.8, 0.15, 0.05], atol=1e-4) and (r >= 0).all() and np.allclose(p.sum(axis=1), 1)
    true = {x.doc_id: x.domain for x in labels.collect()}
    assert np.mean([x.domain == true[x.doc_id] for x in got]) > 0.95


def test_rates_equal_a_plain_projected_gradient(spark):
    rng = np.random.default_rng(3)
    p, n = rng.dirichlet([0.3, 0.3, 0.3], 200), rng.integers(1, 500, 200)
    members = spark.createDataFrame([(int(a), [float(v) for v in b]) for a, b in zip(n, p)], "n_tokens long, posterior array<double>")
    targets = {"a": 0.6, "b": 0.25, "c": 0.15}
    steps = mixing.fit_rates(members, ["a", "b", "c"], targets, anchor="a", epochs=1.2)
    r = np.ones(200)
    for s in steps:
        r = np.maximum(0, r - p @ s)
    goal = np.array([0.6, 0.25, 0.15]) * 1.2 * (n @ p)[0] / 0.6
    assert np.allclose((r * n) @ p, goal, rtol=1e-4)
    far = mixing.fit_rates(members, ["a", "b", "c"], {"a": 0.9, "b": 0.09, "c": 0.01}, anchor="a", epochs=1.5)
    goal, gaps, r = np.array([0.9, 0.09, 0.01]) * 1.5 * (n @ p)[0] / 0.9, [], np.ones(200)
    for s in far:  # most rates are 0 here, and the distance still falls round by round
        gaps.append(np.abs((r * n) @ p - goal).max())
        r = np.maximum(0, r - p @ s)
    assert gaps[-1] < 0.1 * gaps[0]
    r = np.ones(200)
    for s in steps:
        r = np.maximum(0, r - p @ s)
    assert np.allclose([x[0] for x in members.select(mixing._rate(steps)).collect()], r)


def test_far_targets_are_met(spark):
    rng = np.random.default_rng(3)
    p, n = rng.dirichlet([0.3, 0.3, 0.3], 200), rng.integers(1, 500, 200)
    members = spark.createDataFrame([(int(a), [float(v) for v in b]) for a, b in zip(n, p)], "n_tokens long, posterior array<double>")
    r = np.ones(200)
    for s in mixing.fit_rates(members, ["a", "b", "c"], {"a": 0.9, "b": 0.09, "c": 0.01}, anchor="a", epochs=1.5):
        r = np.maximum(0, r - p @ s)
    goal = np.array([0.9, 0.09, 0.01]) * 1.5 * (n @ p)[0] / 0.9
    assert np.allclose((r * n) @ p, goal, rtol=1e-4)


def test_targets_out_of_reach_are_reported(spark, caplog):
    members = spark.createDataFrame([(10, [0.5, 0.5]), (20, [0.6, 0.4])], "n_tokens long, posterior array<double>")
    mixing.fit_rates(members, ["a", "b"], {"a": 0.99, "b": 0.01}, anchor="a")
    assert "off by" in caplog.text
    caplog.clear()
    mixing.fit_rates(members, ["a", "b"], {"a": 0.55, "b": 0.45}, anchor="a")
    assert "off by" not in caplog.text


def test_a_small_labelled_share_is_enough(spark):
    docs, labels = corpus(spark, 240)
    targets = {"high": 0.8, "low": 0.15, "toxic": 0.05}
    got = mixing.mix(docs, labels.where("doc_id % 3 = 0"), targets).collect()
    r, n, p = np.array([x.rate for x in got]), np.array([x.n_tokens for x in got]), np.array([x.posterior for x in got])
    total = (r * n) @ p
    assert np.allclose(total / total.sum(), [0.8, 0.15, 0.05], atol=1e-4)
    true = {x.doc_id: x.domain for x in labels.collect()}
    assert np.mean([x.domain == true[x.doc_id] for x in got]) > 0.95


def test_query_targets():
    assert mixing.TARGETS == {"high": 0.95, "low": 0.03, "toxic": 0.02}


def test_copies_follow_rates(spark):
    docs, labels = corpus(spark)
    out = mixing.resample(docs.withColumn("copies", F.lit(7)), labels, {"high": 0.5, "low": 0.5})
    n = out.groupBy("doc_id").count().collect()
    assert out.columns == ["doc_id", "text", "rate", "copies"] and {(r.rate, r.copies) for r in out.collect()} == {("mine", 7)}
    assert len(n) < 1200 and max(r["count"] for r in n) >= 2


@pytest.mark.parametrize("labelled", [0, 1])
def test_edges(spark, labelled):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (3, "word " * 30000), (3, "word " * 30000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, "high"), (2, None), (None, "low")][: labelled * 3], "doc_id long, domain string")
    got = mixing.mix(docs, labels).collect()
    assert len(got) == 5 and all(r.rate == 1 for r in got) and sorted(r.n_tokens for r in got) == [0, 0, 2, 30000, 30000]
    full, lab = corpus(spark, 400)
    assert mixing.mix(full.limit(0), lab.limit(0)).count() == 0
    wide = mixing.mix(full.drop("rate").unionByName(docs), lab)
    assert wide.count() == 405


def test_columns_of_result_names(spark):
    docs, labels = corpus(spark, 240)
    clash = docs
    for name in ("domain", "copies", "n_tokens", "posterior", "residual", "_all", "_rate", "_c0", "_draw", "word", "n0"):
        clash = clash.withColumn(name, F.lit(f"own {name}"))
    targets = {"high": 0.8, "low": 0.15, "toxic": 0.05}
    out = mixing.resample(clash, labels, targets)
    assert out.columns == clash.columns and out.first()["domain"] == "own domain" and out.first()["_c0"] == "own _c0"
    plain = {r.doc_id: r.rate for r in mixing.mix(docs, labels, targets).collect()}
    mixed = mixing.mix(clash, labels, targets)
    assert {r.doc_id: r.rate for r in mixed.collect()} == plain and mixed.first()["_all"] == "own _all" and sorted(mixed.columns) == sorted(clash.columns)


def brute_posterior(model, text):
    """Bernoulli naive Bayes and the bins, word by word."""
    import re

    words = [w for w in re.split(r"[^A-Za-z]+", text.lower()) if w]
    shout = min(1, 2 * sum(c in mixing.SHOUT for c in text) / len(text)) if text else 0
    fresh = len(set(words)) / len(words) if words else 1
    score = np.array(model.start) + model.shout[:, int(shout * (mixing.BINS - 1))] + model.fresh[:, int(fresh * (mixing.BINS - 1))]
    score += sum((model.odds[:, model.words.index(w)] for w in set(words) & set(model.words)), np.zeros(len(score)))
    e = np.exp(score - score.max())
    return e / e.sum()


def test_posteriors_equal_brute_force(spark):
    docs, labels = corpus(spark, 240)
    model = mixing.fit(docs, labels)
    assert set(model.words) == {"idiot", "moron", "cash", "buy", "now"}
    for r in mixing._features(docs).select("text", model.posterior().alias("p")).limit(60).collect():
        assert np.allclose(r.p, brute_posterior(model, r.text), atol=2.1 / mixing.GRID) and abs(sum(r.p) - 1) < 1e-9


def test_residual_of_the_result(spark):
    docs, labels = corpus(spark, 240)
    assert mixing.mix(docs, labels, {"high": 0.8, "low": 0.15, "toxic": 0.05}).first()["residual"] <= mixing.CLOSE


@pytest.mark.skipif(not __import__("os").path.exists("/root/testdata/sf0.01"), reason="needs the given tables")
def test_given_tables_reach_their_targets(spark):
    got = mixing.query(spark, "/root/testdata/sf0.01").collect()
    r, n, p = np.array([x.rate for x in got]), np.array([x.n_tokens for x in got]), np.array([x.posterior for x in got])
    total = (r * n) @ p
    assert np.allclose(total / total.sum(), [0.95, 0.03, 0.02], atol=1e-5) and got[0].residual <= mixing.CLOSE
