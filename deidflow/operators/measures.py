"""Quality and run-time measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deidflow.functions.geometry import iou


def phi_quality(detected: Column, truth: Column) -> dict[str, Column]:
    """Counts and rates of detections against truth; a rate without base is 0."""
    tp = F.least(detected, truth)
    p, r = F.coalesce(F.try_divide(tp, detected), F.lit(0.0)), F.coalesce(F.try_divide(tp, truth), F.lit(0.0))
    return {
        "tp": tp, "fp": F.greatest(detected - truth, F.lit(0)), "fn": F.greatest(truth - detected, F.lit(0)), "precision": F.round(p, 4), "recall": F.round(r, 4),
        "f1": F.round(F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)), 4),
    }


def collisions(tokens: DataFrame, token: str = "token", source: str = "source") -> DataFrame:
    """Tokens of more than one source value."""
    return tokens.groupBy(token).agg(F.countDistinct(source).alias("n_sources")).where("n_sources > 1")


def bench_summary(runs: DataFrame, seconds: str = "seconds", ok: str = "ok") -> DataFrame:
    """Mean, population deviation, least, most and sum of the run times of successes."""
    t = F.when(F.col(ok), F.col(seconds))
    return runs.agg(
        F.count("*").alias("n_runs"), F.count(t).alias("n_ok"), F.round(F.avg(t), 4).alias("mean"), F.round(F.stddev_pop(t), 4).alias("std"), F.min(t).alias("least"),
        F.max(t).alias("most"), F.round(F.sum(t), 4).alias("total"),
    )


def bench_quality(files: DataFrame, f1: str = "f1", truth: str = "truth", before: str = "bytes_in", after: str = "bytes_out") -> DataFrame:
    """Mean and population deviation of F1 over files with a truth, and bytes out by bytes in (1 at least)."""
    scored = F.when(F.col(truth) > 0, F.col(f1))
    ratio = F.coalesce(F.sum(after), F.lit(0)) / F.greatest(F.coalesce(F.sum(before), F.lit(0)), F.lit(1))
    return files.agg(F.count(scored).alias("n_scored"), F.round(F.avg(scored), 4).alias("f1_mean"), F.round(F.stddev_pop(scored), 4).alias("f1_std"), F.round(ratio, 4).alias("bytes_ratio"))


def ground_truth_join(detections: DataFrame, truth: DataFrame, on: list[str], least: float = 0.5) -> DataFrame:
    """Pairs of the same frame whose rectangles (x, y, w, h) overlap by ``least`` or more: equal keys first, overlap as the rest."""
    t = truth.select(*on, *(F.col(c).alias(f"t_{c}") for c in ("x", "y", "w", "h")), F.col("id").alias("truth_id"))
    overlap = iou(tuple(F.col(c) for c in ("x", "y", "w", "h")), tuple(F.col(f"t_{c}") for c in ("x", "y", "w", "h")))
    return detections.join(t, on).withColumn("iou", overlap).where(F.col("iou") >= least)
