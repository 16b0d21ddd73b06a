"""Queries over files that are made of table rows, so that there are as many as rows, and what the file operators make of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deidflow import rules
from deidflow.functions.paths import below
from deidflow.operators import redact
from deidflow.plans import pipelines
from deidflow.plans.tables import keep, shared_folder
from deidflow.sources import dicom, images, writers

ROWS, COLUMNS = 24, 32


def _mapped(df: DataFrame, schema: str, one: Callable) -> DataFrame:
    """The rows that ``one`` yields for each row of ``df``."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in schema.split(", ")]
        for batch in batches:
            yield pd.DataFrame([x for r in batch.itertuples(index=False) for x in one(r)], columns=names)

    return df.mapInPandas(rows, schema)


def _spread(keys: DataFrame) -> DataFrame:
    """A small table's rows over the cluster, as each becomes a file."""
    return keys.repartition(keys.sparkSession.sparkContext.defaultParallelism, keys.columns[0])


# --- volumes -------------------------------------------------------------------------------------------------------


def _volume(s: int) -> bytes:
    """A volume of 4 to 33 frames with a bright rectangle that moves; every third is an ultrasound with a diagnostic region."""
    n = 4 + s % 30
    frames = np.full((n, ROWS, COLUMNS), 10, np.uint8)
    for k in range(n):
        x, y, w, h = (s * 7 + k * 5) % 20, (s * 3 + k * 2) % 16, 4 + (s + k) % 6, 3 + s % 4
        frames[k, y : y + h, x : x + w] = 255
    e = dicom.element
    body = [
        e("SOPClassUID", "1.2.840.10008.5.1.4.1.1.7"), e("SOPInstanceUID", f"1.2.3.5.{s}"), e("Modality", "US" if s % 3 == 0 else "OT"), e("SamplesPerPixel", 1), e("PhotometricInterpretation", "MONOCHROME2"),
        e("NumberOfFrames", n), e("Rows", ROWS), e("Columns", COLUMNS), e("BitsAllocated", 8), e("BitsStored", 8), e("HighBit", 7), e("PixelRepresentation", 0), e("PixelData", frames.tobytes()),
    ]
    if s % 3 == 0:
        corners = ("RegionLocationMinX0", "RegionLocationMinY0", "RegionLocationMaxX1", "RegionLocationMaxY1")
        body.append(e("SequenceOfUltrasoundRegions", [[e(k, v) for k, v in zip(corners, (0, 0, 16, 12))]] * 2))
    return dicom.build(body)


def _volumes(suppliers: DataFrame) -> DataFrame:
    return _mapped(_spread(suppliers.select("s_suppkey")), "uri string, content binary", lambda r: [(str(r.s_suppkey), _volume(r.s_suppkey))])


def bright_reader() -> redact.Reader:
    """A reader that takes the rectangle around bright pixels for text: personal data if its width is even."""

    def read(frame: np.ndarray) -> list[tuple]:
        y, x = np.nonzero(frame > 200)
        if not len(x):
            return []
        x0, x1, y0, y1 = int(x.min()), int(x.max()) + 1, int(y.min()), int(y.max()) + 1
        return [([[x0, y0], [x1, y0], [x1, y1], [x0, y1]], "FR 12" if (x1 - x0) % 2 else "MRN: 12345", 0.9)]

    return read


def _decided(placed: DataFrame) -> DataFrame:
    return redact.decide(redact.detect(dicom.frame_rows(placed.where(F.size("wanted") > 0)), bright_reader))


def volume_detections(suppliers: DataFrame) -> DataFrame:
    """What is found on the keyframes, and the decision on it."""
    found = _decided(pipelines.placed_files(_volumes(suppliers)))
    return found.select(F.col("uri").cast("long").alias("s_suppkey"), "frame_index", "bbox.*", "decision")


def redacted_volumes(suppliers: DataFrame) -> DataFrame:
    """The bright pixels left on each frame after a volume's keyframes were read and all its frames zeroed."""
    placed = pipelines.placed_files(_volumes(suppliers))
    ready = placed.join(redact.file_boxes(_decided(placed)), "uri", "left")

    def one(r) -> list[tuple]:
        frames = redact.redacted(dicom.frames(dicom.parse(r.content)), r.boxes, r.us_regions)
        return [(int(r.uri), k, int((f > 200).sum())) for k, f in enumerate(frames)]

    return _mapped(ready.select("uri", "content", "boxes", "us_regions"), "s_suppkey long, frame_index int, bright_pixels long", one)


def slices_of_files(suppliers: DataFrame) -> DataFrame:
    """The slice table of the volumes, their distinct regions and the frames that decode."""
    files = _volumes(suppliers)
    regions = files.select("uri", F.coalesce(F.size(dicom.facts(F.col("content"))["us_regions"]), F.lit(0)).alias("n_regions"))
    read = dicom.frame_rows(files).groupBy("uri").agg(F.count("pixels").cast("int").alias("n_read"))
    joined = dicom.slices(files).join(regions, "uri").join(read, "uri")
    return joined.select(F.col("uri").cast("long").alias("s_suppkey"), "sop_instance_uid", "modality", "rows", "columns", "number_of_frames", F.greatest("n_regions", F.lit(0)).alias("n_regions"), "n_read")


# --- files in folders ----------------------------------------------------------------------------------------------


def run_files(suppliers: DataFrame, salt: str) -> DataFrame:
    """A whole run over a folder with the volumes, cut files (every tenth) and files of other kinds: where each goes and why."""
    spark = suppliers.sparkSession
    source, out = shared_folder(spark, "run-in"), shared_folder(spark, "run-out")

    def one(r) -> list[tuple]:
        s, data = r.s_suppkey, _volume(r.s_suppkey)
        return [(f"{source}/P{s % 7}/s/f{s}.dcm", data if s % 10 else data[:-40]), (f"{source}/P{s % 7}/n{s}.txt", data), (f"{source}/P{s % 7}/s/m{s}", b"no magic")]

    _done(writers.write_files(_mapped(_spread(suppliers.select("s_suppkey")), "path string, content binary", one)))
    run = pipelines.run_dicom(spark, source, out, bright_reader, salt=salt)
    saved = keep(pipelines.write(run), "saved")
    hits = run.detections.groupBy(F.col("source_path").alias("uri")).agg(F.count("*").alias("detections"), F.count_if(F.col("decision") == "redacted").alias("redacted"))
    joined = run.outputs.join(hits, "uri", "left").join(saved.select("path", "saved"), "path", "left").fillna({"detections": 0, "redacted": 0, "saved": False})
    key = F.regexp_extract("uri", r"f([0-9]+)\.dcm$", 1).cast("long")
    return joined.select(key.alias("s_suppkey"), below(F.col("path"), out).alias("path"), "route", "error_stage", "detections", "redacted", "saved")


def run_series(suppliers: DataFrame, salt: str) -> DataFrame:
    """Files of one frame that are volumes together, by series: the bright pixels left in each and its place in the series."""
    spark = suppliers.sparkSession
    source = shared_folder(spark, "series-in")

    def one(r) -> list[tuple]:
        s, frame = r.s_suppkey, np.full((ROWS, COLUMNS), 10, np.uint8)
        frame[5:9, s % 20 : s % 20 + 4] = 255
        e, group = dicom.element, s % 7
        body = [
            e("SOPClassUID", "1.2.840.10008.5.1.4.1.1.7"), e("SOPInstanceUID", f"1.2.3.6.{s}"), e("StudyInstanceUID", f"1.2.4.{group}"), e("SeriesInstanceUID", f"1.2.5.{group}"), e("Modality", "CT"),
            e("ImagePositionPatient", f"0\\0\\{-s}"), e("InstanceNumber", s), e("SamplesPerPixel", 1), e("PhotometricInterpretation", "MONOCHROME2"), e("Rows", ROWS), e("Columns", COLUMNS),
            e("BitsAllocated", 8), e("BitsStored", 8), e("HighBit", 7), e("PixelRepresentation", 0), e("PixelData", frame.tobytes()),
        ]
        return [(f"{source}/{s:09d}.dcm", dicom.build(body))]

    _done(writers.write_files(_mapped(_spread(suppliers.select("s_suppkey")), "path string, content binary", one)))
    run = pipelines.run_dicom(spark, source, "out", bright_reader, salt=salt, series=True)
    place = pipelines.volumes_of(dicom.slices(dicom.files(spark, source))).select("uri", "ordinal", "n_slices")

    def left(r) -> list[tuple]:
        (frame,) = dicom.frames(dicom.parse(r.content))
        return [(int(r.uri.rsplit("/", 1)[1][:9]), r.ordinal, r.n_slices, int((frame > 200).sum()))]

    return _mapped(run.outputs.join(place, "uri").select("uri", "content", "ordinal", "n_slices"), "s_suppkey long, ordinal int, n_slices int, bright_pixels long", left)


def images_roundtrip(suppliers: DataFrame) -> DataFrame:
    """Images (grey, or colours for odd numbers; every tenth is none) written and read: sizes, sum of samples, first sample."""
    spark = suppliers.sparkSession
    source = shared_folder(spark, "images")

    def one(r) -> list[tuple]:
        s = r.s_suppkey
        shape = (3 + s % 4, 5, 3) if s % 2 else (3 + s % 4, 5)
        pixels = ((s * 3 + np.arange(int(np.prod(shape)))) % 256).astype(np.uint8).reshape(shape)
        return [(f"{source}/Q{s % 5}/i{s}.png", images.png(pixels) if s % 10 else b"no image")]

    def sums(r) -> list[tuple]:
        a = None if r.error else images.rgb(r.bgr, int(r.rows), int(r.cols), int(r.channels))
        return [(int(r.uri.rsplit("/i", 1)[1][:-4]), *((0,) * 5 if a is None else (*a.shape[:2], a.size // a[..., 0].size if a.ndim == 3 else 1, int(a.sum()), int(a.flat[0]))), r.error)]

    _done(writers.write_files(_mapped(_spread(suppliers.select("s_suppkey")), "path string, content binary", one)))
    names = "s_suppkey long, rows int, cols int, channels int, total long, first int, error string"
    return _mapped(images.read_images(spark, source), names, sums)


def _done(written: DataFrame) -> None:
    """Write now, as what follows lists the folder; a file that was not saved is an error."""
    if not keep(written, "written").where("NOT saved").isEmpty():
        raise OSError("files were not saved")


# --- headers -------------------------------------------------------------------------------------------------------


def _file(key: int, name: str) -> bytes:
    """A file of six 16-bit samples with a customer's name in its header, one sequence and a private element."""
    e, samples = dicom.element, np.arange(6, dtype="<u2") * 7 + key % 100
    return dicom.build([
        e("SOPClassUID", "1.2.840.10008.5.1.4.1.1.7"), e("SOPInstanceUID", f"1.2.3.4.{key}"), e("StudyDate", "20240101"), e("AccessionNumber", f"ACC{key}"), e("Modality", "OT"), e("InstitutionName", name),
        dicom.Element(0x00091001, "LO", "private note"), e("PatientName", name), e("PatientID", key), e("RequestAttributesSequence", [[e("PatientName", name)]]), e("SamplesPerPixel", 1),
        e("PhotometricInterpretation", "MONOCHROME2"), e("Rows", 2), e("Columns", 3), e("BitsAllocated", 16), e("BitsStored", 12), e("HighBit", 11), e("PixelRepresentation", 0), e("PixelData", samples.tobytes()),
    ])


def _scrubbed(key: int, name: str, salt: str) -> tuple[bytes, list[tuple]]:
    """The file with its first sample blanked and its header scrubbed, and the audit."""
    data = _file(key, name)
    samples = np.concatenate([f.reshape(-1) for f in dicom.frames(dicom.parse(data))])
    samples[0] = 0
    return pipelines.scrubbed_file(data, samples, str(key), salt, rules.PII_ACTIONS, False)


_HEADER = "c_custkey long, path string, tag string, vr string, value string"


def _rows(key: int, data: bytes) -> list[tuple]:
    return [(key, path, tag, vr, value) for _, path, tag, _, vr, value, _ in dicom.header_rows("", data) if not tag.startswith("(0002")]


def roundtrip(customers: DataFrame) -> DataFrame:
    """The long-form headers of written files, read back."""
    return _mapped(_spread(customers.select("c_custkey", "c_name")), _HEADER, lambda r: _rows(r.c_custkey, _file(r.c_custkey, r.c_name)))


def scrubbed(customers: DataFrame, salt: str) -> DataFrame:
    """The long-form headers of scrubbed files, without UIDs."""
    return _mapped(_spread(customers.select("c_custkey", "c_name")), _HEADER, lambda r: _rows(r.c_custkey, _scrubbed(r.c_custkey, r.c_name, salt)[0])).where("vr <> 'UI'")


def scrub_audit(customers: DataFrame, salt: str) -> DataFrame:
    """The audit of the scrub by action."""
    one = lambda r: [(r.c_custkey, action, done) for _, _, action, done in _scrubbed(r.c_custkey, r.c_name, salt)[1]]
    audit = _mapped(_spread(customers.select("c_custkey", "c_name")), "c_custkey long, action string, redacted boolean", one)
    return audit.groupBy("c_custkey", "action").agg(F.count("*").alias("n"), F.count_if("redacted").alias("n_redacted"))
