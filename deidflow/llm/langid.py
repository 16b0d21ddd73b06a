"""Language identification by error-correcting output codes.

Each language has a codeword of +1/-1; bit b has one binary classifier over hashed byte trigrams (naive Bayes log odds of
the languages coded +1 against those coded -1, each language weighing the same), whose mean per trigram is shifted and
scaled so that typical texts of the two sides score +1 and -1. Decoding takes the codeword of least loss
sum_b weight_b * exp(-code_b * margin_b), where a bit weighs what separates its sides; the score is the softmax share of
the winner, and a text whose two best codewords lie close is flagged as ambiguous.

Codes: all 2^(k-1) - 1 distinct splits for up to seven languages; for more, 10 * ceil(log2 k) columns, the best of 200
drawn matrices by least distance between codewords.

Training reads texts and languages of about ``SAMPLE`` labelled rows, chosen by a hash of their id (the documented bound);
prediction reads whole texts.

Defined results: a null text or one without letters is ``und`` with score 0, as is every text if nothing was learned; a
text too short for a trigram, or with none known, goes to the tie rule: the alphabetically first language of least loss;
repeated rows are kept and get equal values; a null doc_id is not learned from and not held out; an empty table gives an
empty result; columns of other names are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textvec as tv

BUCKETS = 1 << 14
SAMPLE = 40_000
SMOOTH = 0.5
AMBIGUOUS = 0.6  # a winner's share under this is ambiguous
SHARPNESS = 4.0
BLANK = 0

#: ASCII letters and all bytes of longer characters stand for themselves, all else is a blank.
_FOLD = np.where((np.arange(256) >= 0x80) | ((np.arange(256) >= 0x61) & (np.arange(256) <= 0x7A)), np.arange(256), BLANK).astype(np.uint8)


def trigrams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, bounds) of the trigrams of each row; those around a blank are left out."""
    x = _FOLD[raw]
    if len(x) < 3:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    ok = x[1:-1] != BLANK
    ends = offsets[1:-1]  # a trigram must not reach over the end of a row
    for back in (1, 2):
        cut = ends - back
        ok[cut[(cut >= 0) & (cut < len(ok))]] = False
    at = np.flatnonzero(ok)
    h = x[at].astype(np.uint32) * np.uint32(0x9E3779B1) + x[at + 1].astype(np.uint32) * np.uint32(0x85EBCA77) + x[at + 2].astype(np.uint32) * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(32 - 14)).astype(np.int64), np.searchsorted(at, offsets)


def codewords(k: int) -> np.ndarray:
    """k rows of +1/-1."""
    if k < 2:
        return np.ones((k, 1), np.int8)
    if k <= 7:
        bits = [[1 if (c >> i) & 1 else -1 for i in range(k)] for c in range(1, 2 ** (k - 1))]
        return np.array([[1 if i == k - 1 else -b[i] for b in bits] for i in range(k)], np.int8)
    rng, best, width = np.random.default_rng(k), None, 10 * math.ceil(math.log2(k))
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (k, width))
        if (abs(code.sum(axis=0)) == k).any():
            continue
        product = code.astype(int) @ code.T
        np.fill_diagonal(product, -width)
        if best is None or product.max() < best[0]:
            best = (product.max(), code)
    return best[1]


class Model:
    """Languages, codewords, bit classifiers."""

    def __init__(self, languages: list[str], counts: np.ndarray) -> None:
        self.languages, self.code = languages, codewords(len(languages))
        share = (counts + SMOOTH) / (counts + SMOOTH).sum(axis=1, keepdims=True)
        tables, weights = [], []
        for bit in self.code.T:
            plus, minus = share[bit > 0].mean(axis=0), share[bit < 0].mean(axis=0) if (bit < 0).any() else np.full(share.shape[1], 1 / share.shape[1])
            odds = np.log(plus) - np.log(minus)
            typical = share @ odds
            high = typical[bit > 0].mean()
            low = typical[bit < 0].mean() if (bit < 0).any() else 0.0
            half = max((high - low) / 2, 1e-9)
            tables.append((odds - (high + low) / 2) / half)
            weights.append(half)
        self.table = np.stack(tables, axis=1).astype(np.float32)
        self.weight = np.array(weights) / max(sum(weights), 1e-12)

    def margins(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows x bits; a row without trigrams has zeros."""
        bucket, bounds = trigrams(raw, offsets)
        out = np.zeros((len(offsets) - 1, self.table.shape[1]))
        filled = np.flatnonzero(np.diff(bounds))
        if len(filled):
            total = np.stack([np.add.reduceat(self.table[:, b][bucket], bounds[:-1][filled], dtype=np.float64) for b in range(self.table.shape[1])], axis=1)
            out[filled] = total / np.diff(bounds)[filled][:, None]
        return out

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language number, score)"""
        m = np.clip(margins, -8, 8)
        loss = np.stack([(self.weight * np.exp(-c * m)).sum(axis=1) for c in self.code], axis=1)
        best = loss.argmin(axis=1)
        share = np.exp(-SHARPNESS * (loss - loss.min(axis=1, keepdims=True)))
        return best, 1 / share.sum(axis=1)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        for i, j, raw, offsets in tv.blocks(pc.utf8_lower(batch.column("text"))):
            bucket, bounds = trigrams(raw, offsets)
            owner = np.repeat(np.arange(j - i), np.diff(bounds))
            for lang in set(langs[i:j]):
                rows = langs[i:j] == lang
                total[lang] = total.get(lang, 0) + np.bincount(bucket[rows[owner]], minlength=BUCKETS)
    for lang, n in total.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], ["lang", "bucket", "n"])


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model of the rows (doc_id, text, lang) of ``labelled``; at most about ``sample`` of them are read."""
    usable = labelled.where("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text", "lang")
    n = labelled.where("lang IS NOT NULL").select("lang").count()
    if n > sample:
        usable = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * sample / n))
    sums = usable.mapInArrow(_counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = sums.toArrow()  # languages x buckets at most
    if not found.num_rows:
        return None
    languages = sorted(set(found.column("lang").to_pylist()))
    counts = np.zeros((len(languages), BUCKETS))
    place = {x: i for i, x in enumerate(languages)}
    counts[[place[x] for x in found.column("lang").to_pylist()], found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return Model(languages, counts)


def predict(docs: DataFrame, model: Model | None, *keep: str) -> DataFrame:
    """The columns ``keep`` with lang_pred, score and ambiguous of every whole text."""
    rows = docs.select(*keep, "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letters"))
    if model is None:
        return rows.select(*keep, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("ambiguous"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = np.array([*known.languages, "und"], object)
        for batch in found:
            for i, j, raw, offsets in tv.blocks(pc.utf8_lower(batch.column("text"))):
                best, score = known.decode(known.margins(raw, offsets))
                letters = batch.column("_letters").slice(i, j - i).to_numpy(zero_copy_only=False)
                best = np.where(letters, best, len(known.languages))
                score = np.where(letters, score, 0.0)
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).slice(i, j - i) for c in keep), pa.array(names[best], pa.string()),
                    pa.array(score, pa.float64()), pa.array(letters & (score < AMBIGUOUS), pa.bool_()),
                ], [*keep, "lang_pred", "score", "ambiguous"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema)
    return rows.mapInArrow(batches, f"{kinds}, lang_pred string, score double, ambiguous boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = fit(docs.select("doc_id", "text", "lang").where(~held_out))
    return predict(docs.select("doc_id", "text", held_out.alias("held_out")), model, "doc_id", "held_out")
