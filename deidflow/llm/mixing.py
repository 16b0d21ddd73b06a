"""Soft-membership mixing of documents to target domain weights, in Spark expressions only.

1. A classifier fitted on the labelled table gives every document a posterior over domains: Bernoulli naive Bayes on the
   words that mark a domain against the largest one (a word that is absent counts as well) and on two binned shares of the whole text
   (characters that shout, words that are new). Posteriors lie on a grid of 1 / ``GRID``.
2. Document rates r >= 0 are fitted by distributed projected gradient least squares: each round sums the expected tokens of
   each domain, sum r_i n_i p_id, takes the gradient of the squared distance to the targets, scales it by the inverse of the
   Gram matrix of the documents whose rates are positive, steps and projects to r >= 0. A step that does not lessen the
   distance is damped and tried again. A rate follows from the posterior and the rounds' directions alone, so documents of
   one posterior are summed once and for all before the rounds, into at most (GRID + 1)(GRID + 2) / 2 cells for three domains;
   only the sums of a round leave the cluster. Rounds end when all sums are within ``CLOSE`` of the budget. What is still off
   after ``PASSES`` (targets that no rates reach) is the ``residual`` of the result and logged as a warning.
3. The budget is ``EPOCHS`` times what the anchor domain has, over its weight: documents of the anchor keep rates over 1.

A rate becomes floor(rate) copies and one more with the rest as its chance, drawn by a hash of the document.

Defined results: a null or empty text has no tokens, the posterior of a text without words, and the rate of that posterior; a
null doc_id is kept and drawn by its text's hash; very long texts are read whole; labels with null are unlabelled, repeated
labels and repeated labelled texts count once; a document labelled twice counts for both; without labels, or with one
domain, all rates are 1; a domain without tokens has no part in the targets; repeated rows are kept and equal rows get equal
rates; ties between domains go to the alphabetically first; empty tables give an empty result. Other columns may have any
names: ``resample`` keeps them all, in ``mix`` a result column takes the place of one with its name.
"""

from __future__ import annotations

import json
import logging

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import drop_table, materialise

log = logging.getLogger(__name__)

#: Domain by label row, and the share of tokens that each domain should have.
DOMAIN = "CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'high' WHEN quality = 0 THEN 'low' END"
TARGETS = {"high": 0.95, "low": 0.03, "toxic": 0.02}
ANCHOR = "high"
EPOCHS = 1.15
#: Labelled rows that the classifier is fitted on, at most about, and the words that it knows, at most.
SAMPLE = 20_000
FEATURES = 4096
SMOOTH = 0.2
#: A word is known if it marks a domain against the largest one: its log odds are this much greater there, its shares of the
#: texts differ by this many standard errors (some hundred thousand words are looked at, so smaller differences come by chance),
#: and at most this share of the largest domain's texts has it (whether a text has a common word follows from its length).
LEAST_ODDS, LEAST_ERRORS, MOST_SHARE = 1.0, 6.0, 0.1
BINS = 10
GRID = 1000
#: Passes over the cells at most, and the greatest distance from a target, as a share of the budget, that ends them.
PASSES, CLOSE = 60, 1e-6
SHOUT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ!#*$%&|<>=+{}"
WORDS = r"[^\p{L}]+"


def _features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with _all (words), _n_tokens and the two binned shares."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    # Only the first and the last piece of a split can be empty; they cost less here than a look at every word.
    rows = docs.withColumn("_all", F.split(F.lower(whole), WORDS))
    blank = F.when(F.get("_all", F.lit(0)) == "", 1).otherwise(0) + F.when((F.size("_all") > 1) & (F.element_at("_all", -1) == ""), 1).otherwise(0)
    n, size = F.length(whole), F.size("_all") - blank
    shout = F.floor(F.least(F.lit(1.0), F.coalesce(F.try_divide(n - F.length(F.translate(whole, SHOUT, "")), n), F.lit(0.0)) * 2) * (BINS - 1)).cast("int")
    fresh = F.floor(F.least(F.lit(1.0), F.coalesce(F.try_divide(F.size(F.array_distinct("_all")), size), F.lit(1.0))) * (BINS - 1)).cast("int")
    return rows.withColumns({"_n_tokens": size.cast("long"), "_shout": shout, "_fresh": fresh})


class Classifier:
    """Domains with known words, their odds, and a start of each domain: its prior and that all known words are absent."""

    def __init__(self, domains: list[str], docs: np.ndarray, words: list[str], counts: np.ndarray, shout: np.ndarray, fresh: np.ndarray) -> None:
        self.domains, self.words = domains, words
        share = (counts + SMOOTH) / (docs + 2 * SMOOTH)[:, None]  # domains x words
        self.odds = np.log(share) - np.log1p(-share)
        self.start = np.log(docs / docs.sum()) + np.log1p(-share).sum(axis=1)
        bins = lambda c: np.log((c + SMOOTH) / (c + SMOOTH).sum(axis=1, keepdims=True))
        self.shout, self.fresh = bins(shout), bins(fresh)

    def posterior(self) -> Column:
        """An array of the domains' posteriors, over the columns of ``_features``."""
        lit = lambda v, kind: F.from_json(F.lit(json.dumps(v)), f"array<{kind}>")
        numbers = lambda v: lit([round(float(x), 6) for x in v], "double")
        known = lit(self.words, "string")
        places = F.transform(F.array_intersect("_all", known), lambda w: F.array_position(known, w).cast("int") - 1)

        def adds(table: Column):
            return lambda total, i: total + F.get(table, i)

        def scored(at: Column) -> Column:
            out = []
            for k in range(len(self.domains)):
                own = F.lit(float(self.start[k])) + F.get(numbers(self.shout[k]), F.col("_shout")) + F.get(numbers(self.fresh[k]), F.col("_fresh"))
                out.append(own + F.aggregate(at, F.lit(0.0), adds(numbers(self.odds[k]))))
            return F.array(*out)

        scores = F.transform(F.array(places), scored) if self.words else F.array(scored(F.array().cast("array<int>")))
        powers = F.transform(scores, lambda s: F.transform(s, lambda x: F.exp(F.greatest(x - F.array_max(s), F.lit(-700.0)))))
        # On the grid: shares are rounded down, and the likeliest domain has the rest.
        parts = F.transform(powers, lambda e: F.transform(e, lambda x: F.floor(x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b) * GRID).cast("int")))
        rest = lambda q: F.lit(GRID) - F.aggregate(q, F.lit(0), lambda a, b: a + b)
        full = F.transform(parts, lambda q: F.transform(q, lambda x, i: (x + F.when(i + 1 == F.array_position(q, F.array_max(q)), rest(q)).otherwise(0)) / F.lit(float(GRID))))
        return F.element_at(full, 1)


def known_words(rows: DataFrame, docs: dict[str, int], most: int = FEATURES) -> list[tuple]:
    """(word, texts of each domain with it) of the words that mark a domain against the largest; the clearest ``most`` of them."""
    domains = sorted(docs)
    n = [F.sum(F.when(F.col("domain") == d, 1).otherwise(0)).alias(f"n{k}") for k, d in enumerate(domains)]
    counts = rows.select("domain", F.explode(F.array_distinct("_all")).alias("word")).where("word <> ''").groupBy("word").agg(*n)
    largest = max(domains, key=lambda d: (docs[d], -domains.index(d)))
    b, outside, errors = F.col(f"n{domains.index(largest)}"), float(docs[largest]), [F.lit(0.0)]
    logit = lambda x, size: F.log((x + SMOOTH) / (size + SMOOTH - x))
    for k, d in enumerate(domains):
        if d != largest:
            a, inside = F.col(f"n{k}"), float(docs[d])
            share = (a + b) / (inside + outside)
            spread = F.sqrt(F.greatest(share * (1 - share), F.lit(1e-12)) * (1 / inside + 1 / outside))
            errors.append(F.when(logit(a, inside) - logit(b, outside) >= LEAST_ODDS, (a / inside - b / outside) / spread).otherwise(0.0))
    clear = counts.withColumn("clear", F.greatest(*errors)).where((F.col("clear") >= LEAST_ERRORS) & (b <= MOST_SHARE * outside))
    found = clear.orderBy(F.desc("clear"), "word").limit(most).collect()  # the model's size
    return [(r["word"], [r[f"n{k}"] for k in range(len(domains))]) for r in found]


def fit(docs: DataFrame, labelled: DataFrame, sample: int = SAMPLE) -> Classifier | None:
    """A classifier of the rows (doc_id, domain) of ``labelled``; about ``sample`` of them, by a hash of the id, are read."""
    labelled = labelled.where("doc_id IS NOT NULL AND domain IS NOT NULL").select("doc_id", "domain").distinct()
    n = labelled.count()
    if n > sample:
        labelled = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * sample / n))
    # The sample is bounded, so this side may be broadcast.
    rows = _features(docs.select("doc_id", "text").join(F.broadcast(labelled), "doc_id").dropDuplicates(["text", "domain"]))
    rows = materialise(rows.select("domain", "_all", "_shout", "_fresh"), "mixing-sample")
    totals = rows.groupBy("domain", "_shout", "_fresh").agg(F.count("*").alias("n")).collect()  # domains x bins x bins at most
    domains = sorted({r["domain"] for r in totals})
    if len(domains) < 2:
        return None
    at = {d: k for k, d in enumerate(domains)}
    docs_n, shout, fresh = np.zeros(len(domains)), np.zeros((len(domains), BINS)), np.zeros((len(domains), BINS))
    for r in totals:
        docs_n[at[r["domain"]]] += r["n"]
        shout[at[r["domain"]], r["_shout"]] += r["n"]
        fresh[at[r["domain"]], r["_fresh"]] += r["n"]
    found = known_words(rows, {d: int(docs_n[k]) for d, k in at.items()})
    drop_table(docs.sparkSession, rows)
    counts = np.array([c for _, c in found], float).reshape(len(found), len(domains)).T
    return Classifier(domains, docs_n, [w for w, _ in found], counts, shout, fresh)


class Rates(list):
    """The directions of the rounds; ``residual``: how far a domain is from its target at most, as a share of the budget."""

    residual = 0.0


def _rate(directions: list[np.ndarray]) -> Column:
    """The rate after these rounds: r <- max(0, r - sum_d p_d * direction_d), from 1."""
    r = F.lit(1.0)
    for step in directions:
        r = F.greatest(F.lit(0.0), r - sum((F.get("posterior", F.lit(d)) * float(v) for d, v in enumerate(step)), F.lit(0.0)))
    return r


def fit_rates(members: DataFrame, domains: list[str], targets: dict[str, float], anchor: str = ANCHOR, epochs: float = EPOCHS) -> Rates:
    """Directions of the rounds for ``members`` (n_tokens, posterior)."""
    size = len(domains)
    p = [F.get("posterior", F.lit(d)) for d in range(size)]
    pairs = [(a, b) for a in range(size) for b in range(a, size)]

    def measure(steps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Each domain's expected tokens, and the Gram matrix of the documents with positive rates."""
        rows = members.select("n_tokens", "posterior", _rate(steps).alias("r"))
        gram = [F.sum(F.when(F.col("r") > 0, F.col("n_tokens") * p[a] * p[b]).otherwise(0.0)).alias(f"g{a}_{b}") for a, b in pairs]
        sums = rows.agg(*(F.sum(F.col("r") * F.col("n_tokens") * p[d]).alias(f"s{d}") for d in range(size)), *gram).first()
        g = np.zeros((size, size))
        for a, b in pairs:
            g[a, b] = g[b, a] = sums[f"g{a}_{b}"] or 0.0
        return np.array([sums[f"s{d}"] or 0.0 for d in range(size)]), g

    directions = Rates()
    have, gram = measure(directions)
    weight = np.array([targets.get(d, 0.0) if h > 0 else 0.0 for d, h in zip(domains, have)])
    if not weight.sum():
        return directions
    weight /= weight.sum()
    k = domains.index(anchor) if anchor in domains and weight[domains.index(anchor)] > 0 else int(weight.argmax())
    goal = weight * epochs * have[k] / weight[k]
    damping, passes = 0.0, 1
    while np.abs(have - goal).max() > CLOSE * goal.sum() and passes < PASSES:
        unit = np.eye(size) * max(gram.trace(), 1e-9) / size
        step = np.linalg.solve(gram + unit * max(damping, 1e-9), have - goal)
        then, its_gram = measure([*directions, step])
        passes += 1
        if np.square(then - goal).sum() < np.square(have - goal).sum():
            directions.append(step)
            have, gram, damping = then, its_gram, damping / 8 if damping > 1e-4 else 0.0
        else:
            damping = max(damping * 8, 1e-3)
    directions.residual = off = float(np.abs(have - goal).max() / goal.sum())
    if off > CLOSE:
        log.warning("rates are not exact after %d passes: a domain is off by %.2e of the budget (%s)", passes, off, dict(zip(domains, have.round().tolist())))
    return directions


def _mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None, carry: bool) -> DataFrame:
    """The columns of ``docs`` as _c0, _c1, ... (only doc_id without ``carry``) with _n_tokens, _posterior, _domain, _rate, _copies, _residual."""
    model = fit(docs, labelled)
    own = docs.columns
    rows = docs.toDF(*(f"_c{k}" for k in range(len(own))))
    key, text = f"_c{own.index('doc_id')}", f"_c{own.index('text')}"
    kept = [f"_c{k}" for k in range(len(own))] if carry else [key]
    draw = F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.col(text), F.lit("")), F.lit("mix")), F.lit(1 << 40)) / float(1 << 40)
    members = _features(rows, text)
    if model is None:
        fixed = {"_posterior": F.array().cast("array<double>"), "_domain": F.lit(None).cast("string"), "_rate": F.lit(1.0), "_copies": F.lit(1), "_residual": F.lit(0.0)}
        return members.select(*kept, "_n_tokens", *(c.alias(n) for n, c in fixed.items()))
    members = members.select(*kept, "_n_tokens", model.posterior().alias("posterior"), draw.alias("_draw"))
    members = materialise(members, "mixing-members")
    cells = materialise(members.groupBy("posterior").agg(F.sum("_n_tokens").alias("n_tokens")), "mixing-cells", narrow=True)
    directions = fit_rates(cells, model.domains, targets or TARGETS)
    drop_table(docs.sparkSession, cells)
    names = F.array(*(F.lit(d) for d in model.domains))
    likeliest = F.get(names, F.array_position("posterior", F.array_max("posterior")).cast("int") - 1)
    rated = members.withColumn("_rate", _rate(directions))
    copies = (F.floor("_rate") + F.when(F.col("_draw") < F.col("_rate") - F.floor("_rate"), 1).otherwise(0)).cast("int")
    return rated.select(*kept, "_n_tokens", F.col("posterior").alias("_posterior"), likeliest.alias("_domain"), "_rate", copies.alias("_copies"), F.lit(directions.residual).alias("_residual"))


RESULT = ("n_tokens", "posterior", "domain", "rate", "copies", "residual")


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, carry: bool = True) -> DataFrame:
    """``docs`` (or only doc_id, without ``carry``) with n_tokens, posterior, domain (the likeliest), rate, copies and residual."""
    own = docs.columns if carry else ["doc_id"]
    place = {c: f"_c{docs.columns.index(c)}" for c in own}
    out = _mixed(docs, labelled, targets, carry)
    return out.select(*(F.col(place[c]).alias(c) for c in own if c not in RESULT), *(F.col(f"_{c}").alias(c) for c in RESULT))


def resample(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as its copies."""
    mixed = _mixed(docs, labelled, targets, True).where("_copies > 0")
    repeated = mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return repeated.select(*(F.col(f"_c{k}").alias(c) for k, c in enumerate(docs.columns)))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.expr(DOMAIN).alias("domain"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    mixed = mix(docs, labels(spark, sf_dir), carry=False)
    shown = F.transform("posterior", lambda x: F.round(x, 6)).alias("posterior")
    return mixed.select("doc_id", "n_tokens", shown, "domain", F.round("rate", 6).alias("rate"), "copies", F.round("residual", 9).alias("residual"))
