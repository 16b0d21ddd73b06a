"""Discovery of a folder's inputs by mode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deidflow.sources import dicom, images

MODES = ("auto", "dicom", "image")


class InputError(ValueError):
    """An input folder or mode that cannot be used."""


def discover_inputs(spark: SparkSession, folder: str, mode: str = "auto") -> DataFrame:
    """uri and kind (dicom, image) of the inputs below ``folder``, DICOM files first, each kind in the order of its paths.

    ``auto`` takes both kinds. Contents are looked at where a name may be DICOM, and are not kept.
    """
    if mode not in MODES:
        raise InputError(f"mode {mode!r} is none of {', '.join(MODES)}")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        raise InputError("no such input folder")
    kinds = []
    if mode != "image":
        kinds.append(dicom.files(spark, folder).select("uri", F.lit("dicom").alias("kind")))
    if mode != "dicom":
        kinds.append(images.list_images(spark, folder).select("uri", F.lit("image").alias("kind")))
    found = kinds[0] if len(kinds) == 1 else kinds[0].unionByName(kinds[1])
    return found.orderBy("kind", "uri")
