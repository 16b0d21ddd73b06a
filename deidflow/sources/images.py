"""PNG out, and images in by Spark's own ``image`` source."""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deidflow import rules
from deidflow.functions.paths import extension


def png(pixels: np.ndarray) -> bytes:
    """A PNG of 8-bit samples, H x W or H x W x 3; values are clipped to 0..255, and a range up to 1.1 is stretched."""
    values = pixels.astype(np.float64)
    if np.issubdtype(pixels.dtype, np.floating) and values.size and values.max() <= 1.1:
        values = values * 255
    out = np.clip(values, 0, 255).astype(np.uint8)
    rows = out.reshape(out.shape[0], -1)
    raw = np.concatenate((np.zeros((len(rows), 1), np.uint8), rows), axis=1).tobytes()
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", out.shape[1], out.shape[0], 8, 0 if out.ndim == 2 else 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


def list_images(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of images below ``folder``; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return found.where(extension(F.col("path")).isin(*rules.IMAGE_EXTENSIONS)).select(F.col("path").alias("uri"), "length")


def read_images(spark: SparkSession, folder: str) -> DataFrame:
    """uri, rows, cols, channels, pixels (RGB or grey) and an error for what cannot be decoded."""
    found = spark.read.format("image").option("recursiveFileLookup", "true").option("dropInvalid", "false").option("pathGlobFilter", "*.{png,jpg,jpeg,PNG,JPG,JPEG}").load(folder)
    ok = F.col("image.height") > 0
    return found.select(
        F.col("image.origin").alias("uri"), F.col("image.height").alias("rows"), F.col("image.width").alias("cols"), F.col("image.nChannels").alias("channels"),
        F.col("image.data").alias("bgr"), F.when(~ok, "ImageError").alias("error"),
    )


def rgb(bgr: bytes, rows: int, cols: int, channels: int) -> np.ndarray:
    """The source's bytes (blue first, alpha last) as grey or RGB samples."""
    a = np.frombuffer(bgr, np.uint8).reshape(rows, cols, channels)
    return a[:, :, 0] if channels == 1 else a[:, :, 2::-1]
