"""Host-level quality rules.

Every text gets rule counts (one pass, bounded blocks). Failures are summed by host, each host's failure rate
is shrunk towards the corpus with an empirical beta prior (moments of the hosts' rates), and a host whose shrunk
rate of any rule passes ``max_rate`` is rejected with all its documents.

Defined results: a null, empty or white-space text has no words and fails; a null host gets no host verdict (only
the document's own rules count); hosts of a few documents stay near the corpus rate; repeated rows count once
each; an empty table gives an empty result; columns of other names are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textvec as tv
from .shared import materialise, tidy, without

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_HOST_RATE = 0.5
#: Host verdicts that may be broadcast; more are joined by a shuffle.
MAX_BROADCAST_HOSTS = 200_000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Rules by host: a name and the SQL of a failure.
RULES = {
    "base": "base_failed",
    "symbols": "n_symbols > n_words",
    "dup_lines": "2 * n_dup_lines > n_lines",
}


def block_counts(raw: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The rule counts of the texts of one block."""
    n = len(offsets) - 1
    inside = ~tv.SPACE[raw]
    start, end, row = tv.pieces(inside, offsets)
    first, last, line_row = tv.lines(raw, offsets)
    seen = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(inside, out=seen[1:])
    worded = seen[last] > seen[first]
    first, last, line_row = first[worded], last[worded], line_row[worded]
    salt = tv.mix(np.arange(1, n + 1, dtype=np.uint64))
    distinct = np.unique(tv.mix(tv.hashes(raw, first, last) ^ salt[line_row]), return_index=True)[1]
    n_lines = np.bincount(line_row, minlength=n)
    at, window = tv.windows(tv.hashes(raw, start, end), row, WINDOW)
    order = np.argsort(key := tv.mix(window ^ salt[row[at]]), kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(start) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + WINDOW, -1)
    covered = np.cumsum(cover[:-1]) > 0
    return {
        "n_words": np.bincount(row, minlength=n),
        "word_chars": tv.count_by_row(inside & ((raw & 0xC0) != 0x80), offsets),
        "n_symbols": tv.count_by_row(SYMBOLS[raw], offsets),
        "n_dup_lines": n_lines - np.bincount(line_row[distinct], minlength=n),
        "n_repeat_words": np.bincount(row[covered], minlength=n),
        "n_lines": n_lines,
    }


@tidy
def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, own = [*COUNTS, "n_lines"], ("doc_id", "host", "row_hash")
    for batch in batches:
        parts = [block_counts(raw, offsets) for _, _, raw, offsets in tv.blocks(batch.column("text"))]
        counts = [pa.array(np.concatenate([p[c] for p in parts]) if parts else [], pa.int64()) for c in names]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *counts], [*own, *names])


def rule_counts(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host, a hash of the row's text and host, and the counts of every whole text."""
    rows = docs.select("doc_id", F.col(host).cast("string").alias("host"), F.xxhash64("text", host).alias("row_hash"), "text")
    schema = "doc_id long, host string, row_hash long, " + ", ".join(f"{c} long" for c in (*COUNTS, "n_lines"))
    counted = rows.mapInArrow(_batches, schema)
    failed = f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"
    return counted.withColumn("base_failed", F.expr(failed))


def host_verdicts(counts: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """host, n_docs, the shrunk rate of each rule and host_ok.

    Prior of a rule: mean m and variance v of the hosts' rates (each host once) give a beta with
    a + b = m (1 - m) / v - 1, not below 1; a rule on which all hosts agree takes a + b = 1e6.
    """
    sums = counts.where("host IS NOT NULL").groupBy("host").agg(
        F.count("*").alias("n_docs"), *(F.sum(F.expr(f"IF({sql}, 1, 0)")).alias(f"f_{r}") for r, sql in RULES.items())
    )
    prior = sums.agg(
        *(F.avg(F.col(f"f_{r}") / F.col("n_docs")).alias(f"m_{r}") for r in RULES),
        *(F.var_pop(F.col(f"f_{r}") / F.col("n_docs")).alias(f"v_{r}") for r in RULES),
    )
    joined = sums.crossJoin(F.broadcast(prior))  # one row
    for r in RULES:
        m, v = F.col(f"m_{r}"), F.col(f"v_{r}")
        weight = F.when(v > 1e-12, F.greatest(F.lit(1.0), m * (1 - m) / v - 1)).otherwise(F.lit(1e6))
        joined = joined.withColumn(f"rate_{r}", (F.col(f"f_{r}") + m * weight) / (F.col("n_docs") + weight))
    ok = F.greatest(*(F.col(f"rate_{r}") for r in RULES)) <= max_rate
    return joined.select("host", "n_docs", *(f"rate_{r}" for r in RULES), ok.alias("host_ok"))


def judge(docs: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """doc_id, host, the counts, base_failed, host_ok and kept for every row of ``docs``.

    The counts are written once to the shared folder, as hosts and documents both read them.
    """
    counts = materialise(rule_counts(docs, host), "quality")
    hosts = materialise(host_verdicts(counts, max_rate).select("host", "host_ok"), "hosts")
    small = hosts.count() <= MAX_BROADCAST_HOSTS
    return counts.join(F.broadcast(hosts) if small else hosts, "host", "left").select(
        "doc_id", "host", "row_hash", *COUNTS, "base_failed", F.coalesce("host_ok", F.lit(True)).alias("host_ok"),
        (~F.col("base_failed") & F.coalesce("host_ok", F.lit(True))).alias("kept"),
    )


def keep(docs: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns."""
    lost = judge(docs, host, max_rate).where("NOT kept").select("doc_id", "row_hash").distinct()
    rows = docs.withColumn("_row_hash", F.xxhash64("text", host))
    return without(rows, lost, ("doc_id", "_row_hash")).drop("_row_hash")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judge(docs).select("doc_id", *COUNTS, "base_failed", "kept")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source AS host, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i+4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM win) WHERE n > 1
), rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM twice, (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id
), c AS (
  SELECT d.doc_id, host, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rep USING (doc_id)
), f AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c
), r AS (
  SELECT host, rule, count(*) AS n, sum(CASE WHEN bad THEN 1 ELSE 0 END) AS x FROM (
    SELECT host, 'base' AS rule, base_failed AS bad FROM f UNION ALL
    SELECT host, 'symbols', n_symbols > n_words FROM f UNION ALL
    SELECT host, 'dup_lines', 2 * n_dup_lines > n_lines FROM f) WHERE host IS NOT NULL GROUP BY host, rule
), p AS (
  SELECT rule, avg(x / n) AS m, var_pop(x / n) AS v FROM r GROUP BY rule
), q AS (
  SELECT rule, m, CASE WHEN v > 1e-12 THEN greatest(1.0, m * (1 - m) / v - 1) ELSE 1e6 END AS s FROM p
), h AS (
  SELECT host, bool_and((x + m * s) / (n + s) <= 0.5) AS host_ok FROM r JOIN q USING (rule) GROUP BY host
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(host_ok, true) AS kept
FROM f LEFT JOIN h USING (host)
"""
