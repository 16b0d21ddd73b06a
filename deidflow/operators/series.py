"""Series of slices: grouping, splitting by geometry, ordering, keyframes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deidflow import rules
from deidflow.functions.geometry import keyframes

SERIES = ("study_instance_uid", "series_instance_uid")
GEOMETRY = ("rows", "columns", "pixel_spacing", "slice_thickness", "image_orientation_patient")


def group(slices: DataFrame, keys: Sequence[str] = SERIES, geometry: Sequence[str] = GEOMETRY) -> DataFrame:
    """One row per sub-series: the keys, the geometry (nulls are equal) and the number of slices."""
    return slices.groupBy(*keys, *geometry).agg(F.count("*").alias("n_slices"))


def accepted(slices: DataFrame, modalities: Sequence[str] = rules.MODALITIES) -> DataFrame:
    return slices.where(F.upper("modality").isin(*modalities))


def order(slices: DataFrame, keys: Sequence[str], z: str = "z", instance: str = "instance_number", uri: str = "uri") -> DataFrame:
    """``slices`` with frame_index: by z if all slices of the series have it, else by instance if all have that, else by uri."""
    whole = Window.partitionBy(*keys)
    all_z, all_i = F.bool_and(F.col(z).isNotNull()).over(whole), F.bool_and(F.col(instance).isNotNull()).over(whole)
    ranked = slices.withColumn("_z", F.when(all_z, F.col(z))).withColumn("_i", F.when(~all_z & all_i, F.col(instance)))
    place = F.row_number().over(whole.orderBy("_z", "_i", uri)) - 1
    return ranked.withColumn("frame_index", place).drop("_z", "_i")


def singletons(slices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``slices`` with whether each is alone in its series; counted before the join, so a large series is no large task."""
    sizes = slices.groupBy(*keys).agg(F.count("*").alias("n_slices"))
    return slices.join(sizes, list(keys)).withColumn("singleton", F.col("n_slices") == 1)


def ragged(frames: DataFrame, keys: Sequence[str], shape: Sequence[str] = ("rows", "columns")) -> DataFrame:
    """The series whose frames are of several shapes, with their number and an error; such a series is no volume."""
    shapes = frames.groupBy(*keys).agg(F.countDistinct(F.struct(*shape)).alias("n_shapes"))
    return shapes.where("n_shapes > 1").withColumn("error", F.lit("SeriesLoadError"))


def miscounted(frames: DataFrame, uris: DataFrame, key: str) -> DataFrame:
    """The volumes whose number of frames is not that of the files they are to be saved to."""
    n, m = frames.groupBy(key).agg(F.count("*").alias("n_frames")), uris.groupBy(key).agg(F.count("*").alias("n_uris"))
    both = n.join(m, key, "full_outer").fillna(0, ["n_frames", "n_uris"])
    return both.where("n_frames <> n_uris")


def folders(images: DataFrame, root: str, path: str = "path") -> DataFrame:
    """``images`` with the key of their group: the parent folder, or for files of the root their own path."""
    parent = F.regexp_replace(path, "/[^/]*$", "")
    return images.withColumn("series_key", F.when(parent == root, F.col(path)).otherwise(parent))


def volume_keyframes(frames: DataFrame, key: str, **sampling) -> DataFrame:
    """One row per volume: its number of frames and the keyframe indices."""
    return frames.groupBy(key).agg(F.count("*").cast("int").alias("n_frames")).withColumn("keyframes", keyframes(F.col("n_frames"), **sampling))


def only_keyframes(frames: DataFrame, key: str, **sampling) -> DataFrame:
    """The rows of ``frames`` (key, frame_index, ...) that are keyframes, by a semi-join before any costly step."""
    chosen = volume_keyframes(frames, key, **sampling).select(key, F.explode("keyframes").alias("frame_index"))
    return frames.join(chosen, [key, "frame_index"], "left_semi")
