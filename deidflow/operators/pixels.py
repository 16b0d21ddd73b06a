"""Masks of rectangles, as stretches of scan lines; no image is held in a row and no pixel is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deidflow.functions.geometry import clamp


def clamped(boxes: DataFrame, width: int, height: int) -> DataFrame:
    """x0, y0, x1, y1 (end exclusive) of boxes x, y, w, h inside the frame, and their area."""
    return (
        boxes.withColumn("x0", clamp(F.col("x"), 0, width)).withColumn("y0", clamp(F.col("y"), 0, height))
        .withColumn("x1", clamp(F.col("x") + F.col("w"), 0, width)).withColumn("y1", clamp(F.col("y") + F.col("h"), 0, height))
        .withColumn("area", F.greatest(F.lit(0), F.col("x1") - F.col("x0")) * F.greatest(F.lit(0), F.col("y1") - F.col("y0")))
    )


def scan_lines(boxes: DataFrame, key: str) -> DataFrame:
    """key, row, x0 and x1 of the rectangles' lines: the longest of those that begin at one place, so a line has no more rows than pixels."""
    solid = boxes.where("x1 > x0 AND y1 > y0").select(key, "x0", "y0", "x1", "y1").distinct()
    lines = solid.select(key, "x0", "x1", F.explode(F.sequence("y0", F.col("y1") - 1)).alias("row"))
    return lines.groupBy(key, "row", "x0").agg(F.max("x1").alias("x1"))


def union_area(boxes: DataFrame, key: str, width: int | None = None) -> DataFrame:
    """key and the number of distinct pixels: on each line, what a stretch adds to those that begin before it."""
    before = Window.partitionBy(key, "row").orderBy("x0").rowsBetween(Window.unboundedPreceding, -1)
    lines = scan_lines(boxes, key).withColumn("_from", F.greatest(F.col("x0"), F.coalesce(F.max("x1").over(before), F.col("x0"))))
    return lines.groupBy(key).agg(F.sum(F.greatest(F.lit(0), F.col("x1") - F.col("_from"))).cast("long").alias("pixels"))


def union_with(boxes: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """``union_area`` of the rectangles and those of a mask that stands already."""
    columns = [key, "x0", "y0", "x1", "y1"]
    return union_area(boxes.select(*columns).unionByName(existing.select(*columns)), key)


def phi_area(regions: DataFrame, key: str, width: int, height: int) -> DataFrame:
    """Pixels outside the diagnostic rectangles; a frame without a valid rectangle has no such mask and no row."""
    inside = union_area(clamped(regions, width, height), key, width)
    return inside.select(key, F.col("pixels").alias("diagnostic_pixels"), (F.lit(width * height) - F.col("pixels")).alias("phi_pixels"))


def keyframe_stats(boxes: DataFrame, frames: DataFrame, key: str, width: int) -> DataFrame:
    """Per volume: frames scanned, pixels by keyframe, pixels of the union, and the share scanned in percent."""
    each = union_area(boxes.withColumn("_frame", F.struct(key, "frame_index")), "_frame", width).select(F.col(f"_frame.{key}").alias(key), F.col("_frame.frame_index").alias("frame_index"), "pixels")
    per = each.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("frame_index", "pixels")))).alias("per_keyframe_phi_pixels"))
    union = union_area(boxes, key, width).withColumnRenamed("pixels", "union_phi_pixels")
    joined = frames.join(per, key, "left").join(union, key, "left")
    share = F.round(100 * F.try_divide(F.size("keyframes"), F.col("n_frames")), 1)
    return joined.withColumns({"keyframes_scanned": F.size("keyframes"), "union_phi_pixels": F.coalesce("union_phi_pixels", F.lit(0)), "pct_frames_scanned": share})
