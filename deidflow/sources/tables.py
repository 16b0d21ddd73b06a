"""CSV and JSON tables that runs leave or that people annotate, read with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deidflow import rules
from deidflow.functions.paths import normalised

TRUTH = "file_path string, text string, x_min int, y_min int, x_max int, y_max int, is_phi string, phi_type string"
_KINDS = {"frame_index": "int", "bbox_x": "int", "bbox_y": "int", "bbox_w": "int", "bbox_h": "int", "text_len": "int", "confidence": "double", "redacted": "boolean"}
PIXEL = ", ".join(f"{c} {_KINDS.get(c, 'string')}" for c in rules.PIXEL_COLUMNS)
TAGS = ", ".join(f"{c} {_KINDS.get(c, 'string')}" for c in rules.TAG_COLUMNS)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV with a header; a path that is not there has no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", "true").option("enforceSchema", "false").csv(path)


def ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """Annotations by normalised path as rectangles x, y, w, h; is_phi only where the text says true."""
    rows = csv(spark, path, TRUTH)
    return annotations(rows)


def annotations(rows: DataFrame) -> DataFrame:
    """``ground_truth`` of rows that were read already."""
    return rows.select(
        normalised(F.col("file_path")).alias("file_path"), "text", F.col("x_min").alias("x"), F.col("y_min").alias("y"), (F.col("x_max") - F.col("x_min")).alias("w"), (F.col("y_max") - F.col("y_min")).alias("h"),
        (F.lower(F.trim(F.coalesce("is_phi", F.lit("")))) == "true").alias("is_phi"), "phi_type",
    )


def pixel_report(spark: SparkSession, path: str) -> DataFrame:
    return csv(spark, path, PIXEL)


def tag_report(spark: SparkSession, path: str) -> DataFrame:
    return csv(spark, path, TAGS)


def distinct_values(report: DataFrame, column: str) -> DataFrame:
    return report.select(column).distinct()


def latest_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The JSON text of the newest job summary below ``folder``: one row, or none."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "job-*.json").load(folder)
    newest = found.agg(F.max_by(F.struct("path", "content"), F.struct("modificationTime", "path")).alias("s")).where("s IS NOT NULL")
    return newest.select(F.col("s.path").alias("path"), F.col("s.content").cast("string").alias("summary"))
