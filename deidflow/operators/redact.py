"""Pixels out of frames: detection by an injected reader, decisions in expressions, zeroing by rectangles.

A reader is a callable ``frame (H x W [x 3] uint8) -> [(four corners, text, probability)]``; it lives once per Python worker.
A model is a callable ``[text] -> [bool]``; if it fails, its texts count as personal data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deidflow import rules
from deidflow.functions.fragments import cascade, decision, safelist_decision
from deidflow.functions.geometry import corners_to_box

Reader = Callable[[np.ndarray], list[tuple]]
DETECTION = "uri string, frame_index int, corners array<array<double>>, ocr_text string, confidence double, error string"


def to_bytes(frame: np.ndarray) -> np.ndarray:
    """8-bit samples: as they are, or stretched between least and most."""
    if frame.dtype == np.uint8:
        return frame
    low, high = float(frame.min()), float(frame.max())
    return np.zeros(frame.shape, np.uint8) if high <= low else ((frame - low) / (high - low) * 255).astype(np.uint8)


def unpack(pixels: bytes, dtype: str, rows: int, cols: int, channels: int) -> np.ndarray:
    rows, cols, channels = int(rows), int(cols), int(channels)  # a batch with nulls hands over floats
    return np.frombuffer(pixels, np.dtype(dtype)).reshape((rows, cols) if channels == 1 else (rows, cols, channels))


def blank(frame: np.ndarray, boxes: list[tuple[int, int, int, int]]) -> np.ndarray:
    """A copy with the rectangles (x, y, w, h), clamped to the frame, set to zero in all channels."""
    out = frame.copy()
    h, w = out.shape[:2]
    for x, y, bw, bh in boxes:
        out[max(0, y) : min(h, max(0, y + bh)), max(0, x) : min(w, max(0, x + bw))] = 0
    return out


def union_mask(frames: list[np.ndarray], boxes: list[dict], regions: list[dict] | None, mask_mode: str = "box") -> np.ndarray:
    """The pixels to zero on every frame of a file: those of its rectangles, without ultrasound regions.

    ``diff``: of each rectangle only what is not zero on the frame on which it was found (frame_index of this file).
    """
    h, w = frames[0].shape[:2]
    mask = np.zeros((h, w), bool)
    for b in boxes:
        part = np.s_[max(0, b["y"]) : min(h, max(0, b["y"] + b["h"])), max(0, b["x"]) : min(w, max(0, b["x"] + b["w"]))]
        if mask_mode == "box":
            mask[part] = True
        else:
            there = frames[b["frame_index"]][part] != 0
            mask[part] |= there if there.ndim == 2 else there.any(axis=2)
    for g in regions if regions is not None else ():
        mask[g["y0"] : g["y1"], g["x0"] : g["x1"]] = False
    return mask


def redacted(frames: list[np.ndarray], boxes: list[dict] | None, regions: list[dict] | None, mask_mode: str = "box") -> list[np.ndarray]:
    """A file's frames with the same pixels zeroed on all of them."""
    if not frames or boxes is None or not len(boxes):
        return frames
    mask, out = union_mask(frames, boxes, regions, mask_mode), [f.copy() for f in frames]
    for f in out:
        f[mask] = 0
    return out


def detect(frames: DataFrame, reader: Callable[[], Reader]) -> DataFrame:
    """Raw detections of ``frames``; ``us_regions`` (array of x0, y0, x1, y1), if there, are hidden from the reader.

    ``reader`` makes the reader, once per worker. An error of the reader fails the frame: one row with its class name.
    """
    regions = "us_regions" in frames.columns

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = reader()
        names = [c.split()[0] for c in DETECTION.split(", ")]
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                try:
                    image = to_bytes(unpack(r.pixels, r.dtype, r.rows, r.cols, r.channels))
                    if regions and r.us_regions is not None:
                        image = blank(image, [(g["x0"], g["y0"], g["x1"] - g["x0"], g["y1"] - g["y0"]) for g in r.us_regions])
                    out += [(r.uri, r.frame_index, [list(map(float, p)) for p in corners], text, float(prob), None) for corners, text, prob in read(image)]
                except Exception as e:  # noqa: BLE001  the frame fails, not the run; the message might hold content
                    out.append((r.uri, r.frame_index, None, None, None, type(e).__name__))
            yield pd.DataFrame(out, columns=names)

    columns = ["uri", "frame_index", "pixels", "dtype", "rows", "cols", "channels"] + ["us_regions"] * regions
    return frames.where("pixels IS NOT NULL").select(*columns).mapInPandas(rows, DETECTION)


def decide(detections: DataFrame, model: Callable[[list[str]], list[bool]] | None = None, threshold: float = rules.CONFIDENCE, strict: bool = False) -> DataFrame:
    """``detections`` with bbox and decision. Only texts that the rules leave open reach the model."""
    boxed = detections.where("error IS NULL").withColumn("bbox", corners_to_box(F.col("corners")))
    if model is None:
        return boxed.withColumn("decision", safelist_decision(F.col("ocr_text"), F.col("confidence"), threshold=threshold))
    rest = (F.col("confidence") >= threshold) & (cascade(F.col("ocr_text"), strict) == "ner")

    @F.pandas_udf("boolean")
    def is_phi(texts: pd.Series) -> pd.Series:
        asked = texts.notna()
        out = pd.Series([None] * len(texts), index=texts.index, dtype=object)
        if asked.any():
            try:
                out[asked] = model(list(texts[asked]))
            except Exception:  # noqa: BLE001  unknown texts are taken for personal data
                out[asked] = True
        return out

    asked = boxed.withColumn("_phi", is_phi(F.when(rest, F.col("ocr_text"))))
    return asked.withColumn("decision", decision(F.col("ocr_text"), F.col("confidence"), F.col("_phi"), threshold, strict)).drop("_phi")


def volume_boxes(decided: DataFrame, key: str = "uri") -> DataFrame:
    """The rectangles to zero on every frame of a volume: the union over its keyframes."""
    hit = decided.where("decision = 'redacted'")
    return hit.groupBy(key).agg(F.collect_set("bbox").alias("boxes"), F.count("*").alias("redacted_regions"))


def file_boxes(decided: DataFrame, key: str = "uri") -> DataFrame:
    """Per volume the rectangles to zero, with the frame of each, and the number of uncertain detections."""
    box = F.struct("frame_index", *(F.col(f"bbox.{k}").alias(k) for k in "xywh"))
    return decided.groupBy(key).agg(F.collect_set(F.when(F.col("decision") == "redacted", box)).alias("boxes"), F.count_if(F.col("decision") == "low_confidence").cast("int").alias("low"))


def frame_boxes(decided: DataFrame) -> DataFrame:
    hit = decided.where("decision = 'redacted'")
    return hit.groupBy("uri", "frame_index").agg(F.collect_set("bbox").alias("boxes"), F.count("*").alias("redacted_regions"))


def apply(frames: DataFrame, boxes: DataFrame, on: list[str], mask_mode: str = "box") -> DataFrame:
    """``frames`` with zeroed pixels. ``us_regions`` keep their pixels.

    ``mask_mode``: box zeroes the rectangles; diff zeroes, on every frame, only pixels that are not zero on the first
    frame given by ``reference`` (a column of bytes), which leaves what moves inside a rectangle.
    """
    if mask_mode not in ("box", "diff"):
        raise rules.RuleError(f"unknown mask mode {mask_mode!r}")
    joined = frames.join(boxes, on, "left")
    regions, schema = "us_regions" in joined.columns, joined.schema

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.to_dict("records"):
                if r["pixels"] is not None and r["boxes"] is not None and len(r["boxes"]):
                    image = unpack(r["pixels"], r["dtype"], r["rows"], r["cols"], r["channels"])
                    done = blank(image, [(b["x"], b["y"], b["w"], b["h"]) for b in r["boxes"]])
                    if mask_mode == "diff" and r.get("reference") is not None:
                        still = unpack(r["reference"], r["dtype"], r["rows"], r["cols"], r["channels"]) == 0
                        done[still] = image[still]
                    for g in r["us_regions"] if regions and r["us_regions"] is not None else ():
                        done[g["y0"] : g["y1"], g["x0"] : g["x1"]] = image[g["y0"] : g["y1"], g["x0"] : g["x1"]]
                    r["pixels"] = done.tobytes()
                out.append(r)
            yield pd.DataFrame(out, columns=schema.names)

    return joined.mapInPandas(rows, schema).drop("boxes")
