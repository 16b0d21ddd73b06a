"""Audit relations, run summaries, envelopes and review queues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deidflow import rules
from deidflow.functions.identity import token


def phi_free(detections: DataFrame, salt: str, text: str = "ocr_text") -> DataFrame:
    """``detections`` with text_token and text_len instead of the text."""
    length = F.length(F.coalesce(F.col(text), F.lit("")))
    return detections.withColumn("text_token", token(text, salt)).withColumn("text_len", length).drop(text)


def pixel_report(detections: DataFrame) -> DataFrame:
    """Exactly the report's columns; text may not be among the input's."""
    if "ocr_text" in detections.columns:
        raise rules.RuleError("the report may not see text")
    return detections.select(*rules.PIXEL_COLUMNS)


def attribute(detections: DataFrame, slices: DataFrame, keys: tuple[str, ...] = ("series_key", "frame_index")) -> DataFrame:
    """``detections`` with the UIDs and path of their slice; without a frame of their own, those of the series' first slice."""
    first = slices.groupBy(keys[0]).agg(F.min_by(F.struct("source_path", "original_sop_uid", "deid_sop_uid"), keys[1]).alias("_first"))
    own = slices.select(*keys, F.struct("source_path", "original_sop_uid", "deid_sop_uid").alias("_own"))
    met = detections.join(own, list(keys), "left").join(first, keys[0], "left").withColumn("_s", F.coalesce("_own", "_first"))
    return met.withColumns({c: F.col(f"_s.{c}") for c in ("source_path", "original_sop_uid", "deid_sop_uid")}).drop("_own", "_first", "_s")


def merge(old: DataFrame, new: DataFrame, sources: DataFrame | None = None, key: str = "source_path") -> DataFrame:
    """``old`` without the sources of this run, and ``new``; a source that ran again without rows loses its old ones."""
    ran = new.select(key) if sources is None else sources.select(key).union(new.select(key))
    return old.join(ran.distinct(), key, "left_anti").unionByName(new)


def run_summary(detections: DataFrame) -> DataFrame:
    """One row: distinct sources, regions, and regions by decision."""
    by = [F.count_if(F.col("decision") == d).alias(d) for d in rules.DECISIONS]
    return detections.agg(F.countDistinct("source_path").alias("files_with_detections"), F.count("*").alias("regions"), *by)


def tags_by_action(tags: DataFrame) -> DataFrame:
    """Audit rows by action, and of how many files."""
    return tags.groupBy("action").agg(F.count("*").alias("n_tags"), F.countDistinct("source_path").alias("n_files"))


def header_audit(tags: DataFrame, limit: int = 30) -> DataFrame:
    """The first ``limit`` audit rows in the order of path and tag."""
    return tags.orderBy("source_path", "tag", "action").limit(limit)


def job_summary(files: DataFrame, key: str = "source_path") -> DataFrame:
    """path and the JSON entry of each file of a job; files of one name in two folders stay apart."""
    return files.select(F.col(key).alias("path"), F.to_json(F.struct(F.col(key).alias("path"), *(c for c in files.columns if c != key))).alias("entry"))


def artifacts(paths: DataFrame, path: str = "path") -> DataFrame:
    """Distinct paths in order, with the extension in lower case."""
    return paths.select(path).distinct().withColumn("kind", F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))).orderBy(path)


def by_source_name(rows: DataFrame, name: str, key: str = "source_path") -> DataFrame:
    return rows.where(F.col(key).endswith(name))


def file_entries(detections: DataFrame, tags: DataFrame, key: str = "source_path") -> DataFrame:
    """Per file: regions, decisions, scrubbed tags and whether it needs a review."""
    pixel = detections.groupBy(key).agg(F.count("*").alias("pixel_regions_detected"), *(F.count_if(F.col("decision") == d).alias(d) for d in rules.DECISIONS))
    header = tags.groupBy(key).agg(F.count_if("redacted").alias("header_tags_scrubbed"))
    both = pixel.join(header, key, "full_outer").fillna(0)
    return both.withColumn("needs_manual_review", F.col("low_confidence") > 0)


def totals(files: DataFrame) -> DataFrame:
    """One row of totals over files (status processed or failed) and the run's status; sums and the review flag are null where no file was processed."""
    ok, bad = F.count_if(F.col("status") == "processed"), F.count_if(F.col("status") == "failed")
    done = lambda c: F.when(F.col("status") == "processed", F.col(c))
    return files.agg(
        F.count("*").alias("files_discovered"), ok.alias("files_processed"), bad.alias("files_failed"),
        *(F.sum(done(c)).alias(c) for c in ("pixel_regions_detected", *rules.DECISIONS, "header_tags_scrubbed")),
        F.bool_or(done("needs_manual_review")).alias("needs_manual_review"),
        F.when((bad > 0) & (ok == 0), "error").when(bad > 0, "partial").otherwise("success").alias("status"),
    )


def envelope(files: DataFrame) -> DataFrame:
    """``totals`` with zeros and no review where no file was processed."""
    return totals(files).fillna(0).fillna(False)


def route(low_confidence: Column, error: Column | None = None) -> Column:
    """error and review go to people; the rest is written."""
    out = F.when(low_confidence > 0, "review").otherwise("ok")
    return out if error is None else F.when(error.isNotNull(), "error").otherwise(out)


def review_queue(names: DataFrame, limit: int = 50, name: str = "name") -> tuple[DataFrame, DataFrame]:
    """The first ``limit`` names in order (hidden ones are none) and one row with the true count and whether it was cut."""
    seen = names.where(~F.col(name).startswith("."))
    return seen.orderBy(name).limit(limit), seen.agg(F.count("*").alias("total")).withColumn("truncated", F.col("total") > limit)
