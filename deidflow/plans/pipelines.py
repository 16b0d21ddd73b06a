"""De-identification runs over DICOM files and images, as composed tables.

discover -> detect (keyframes of volumes only) -> decide -> redact and scrub -> route -> write. Audit tables are
views of the plan; detections are written once, as pixels, reports and routes all read them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deidflow import rules
from deidflow.functions.geometry import keyframes
from deidflow.functions.identity import token
from deidflow.functions.paths import below, output_path
from deidflow.operators import redact, reports
from deidflow.operators import series as series_ops
from deidflow.plans.tables import keep
from deidflow.sources import dicom, images, writers


@dataclass
class Run:
    """Outputs (uri, path, content, route, error) and the audit tables of a run."""

    outputs: DataFrame
    detections: DataFrame
    tag_actions: DataFrame | None


def scrubbed_file(data: bytes, pixels: np.ndarray | None, uri: str, salt: str, actions: dict[str, str], keep_geometry: bool) -> tuple[bytes, list[tuple]]:
    """A file's new bytes and its audit rows, in the order actions, private drop, pixels, UIDs, attestation."""
    from deidflow.operators.headers import CODES, METHOD, PIXEL_CODE

    audit: list[tuple] = []

    def tokenised(text: str, vr: str) -> str:
        import hashlib

        made = "" if not text else "TOKEN_" + hashlib.sha256((text + salt).encode()).hexdigest()[:16]
        return made[:16] if vr in rules.SHORT_VRS else made

    def uid(value: str) -> str:
        return value if not value.strip() or value.startswith(rules.STANDARD_UID_ROOT) else dicom.exact_uid(value.strip(), salt)

    def level(elements: list[dicom.Element]) -> list[dicom.Element]:
        out = []
        for e in elements:
            if e.tag >> 16 & 1:
                continue
            keyword = dicom.TAGS.get(e.tag, (None, ""))[1]
            value = [level(item) for item in e.value] if isinstance(e.value, list) else e.value
            action = actions.get(dicom.name(e.tag))
            if keep_geometry and keyword in rules.GEOMETRY_KEYWORDS:
                action = None
            if action:
                audit.append((dicom.name(e.tag), keyword, action, action != "KEEP"))
            if action == "REMOVE":
                continue
            if action == "ZERO":
                value = b"" if e.vr in ("OB", "OW", "UN") else ""
            elif action == "DUMMY":
                value = tokenised(dicom.shown(e), e.vr)
            if e.vr == "UI" and keyword not in rules.CLASS_UID_KEYWORDS and not isinstance(value, list):
                old = value if isinstance(value, str) else dicom.text(value)
                new = "\\".join(map(uid, old.split("\\")))
                if new != old:
                    audit.append((dicom.name(e.tag), keyword, "REMAP", True))
                value = new
            out.append(e._replace(value=value))
        return out

    body = level([e for e in dicom.parse(data) if e.tag >> 16 != 2])  # the file's own group follows the data set when it is built

    def put(*made: dicom.Element) -> None:
        tags = {m.tag for m in made}
        body[:] = [e for e in body if e.tag not in tags] + list(made)

    if pixels is not None:
        low, high = float(pixels.min()), float(pixels.max())
        put(
            *dicom.pixel_elements(body, pixels), dicom.element("WindowCenter", f"{(low + high) / 2:g}"), dicom.element("WindowWidth", f"{max(high - low, 1):g}"),
            dicom.element("BurnedInAnnotation", "NO"),
        )
        audit.append(("(0028,0301)", "BurnedInAnnotation", "ATTEST", False))
    if not (dicom.value_of(body, "SOPInstanceUID") or "").strip():
        put(dicom.element("SOPInstanceUID", dicom.exact_uid(uri, salt)))
    codes = [[dicom.Element(0x00080100, "SH", c), dicom.Element(0x00080102, "SH", "DCM")] for c in (*CODES, *([PIXEL_CODE] if pixels is not None else []))]
    put(dicom.element("PatientIdentityRemoved", "YES"), dicom.element("DeidentificationMethod", METHOD), dicom.element("DeidentificationMethodCodeSequence", codes))
    audit += [(dicom.name(dicom.NUMBERS[k]), k, "ATTEST", False) for k in ("PatientIdentityRemoved", "DeidentificationMethod", "DeidentificationMethodCodeSequence")]
    return dicom.build(body), audit


def volumes_of(slices: DataFrame) -> DataFrame:
    """uri, series_key, ordinal and n_slices of slices; a series of several geometries is as many volumes."""
    shape = F.concat_ws("|", "study_instance_uid", "series_instance_uid", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in series_ops.GEOMETRY))
    keyed = slices.withColumn("series_key", F.sha2(shape, 256)).withColumn("z", F.get("image_position_patient", F.lit(2)))
    ordered = series_ops.order(keyed, ("series_key",)).select("uri", "series_key", F.col("frame_index").alias("ordinal"))
    return ordered.join(keyed.groupBy("series_key").agg(F.count("*").cast("int").alias("n_slices")), "series_key")


def placed_files(found: DataFrame, series: bool = False, us: bool = True, sampling: dict | None = None) -> DataFrame:
    """uri, content, volume, us_regions and ``wanted`` (the frames to read) of files; without ``series`` no row is shuffled."""
    said = found.withColumn("_f", dicom.facts("content")).select("uri", "content", F.col("_f.n_frames").alias("n_frames"), F.col("_f.us_regions").alias("us_regions"))
    if not us:
        said = said.withColumn("us_regions", F.lit(None).cast(dicom.REGIONS))
    sampling = sampling or {}
    own = keyframes(F.col("n_frames"), **sampling)
    if not series:
        return said.select("uri", "content", F.col("uri").alias("volume"), "us_regions", own.alias("wanted"))
    one = F.col("series_key").isNotNull() & (F.col("n_frames") == 1)
    read = F.when(F.array_contains(keyframes(F.col("n_slices"), **sampling), F.col("ordinal")), F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    joined = said.drop("content").join(volumes_of(dicom.slices(found)), "uri", "left")
    places = keep(joined.select("uri", F.when(one, F.col("series_key")).otherwise(F.col("uri")).alias("volume"), "us_regions", F.when(one, read).otherwise(own).alias("wanted")), "places")
    shared = places.where("us_regions IS NOT NULL").groupBy("volume").agg(F.array_distinct(F.flatten(F.collect_list("us_regions"))).alias("us_regions"))
    return found.join(places.drop("us_regions").join(shared, "volume", "left"), "uri")


def run_dicom(
    spark: SparkSession, folder: str, out: str, reader: Callable[[], redact.Reader], model=None, salt: str | None = None, actions: dict[str, str] | None = None,
    mask_mode: str = "box", to_review: bool = True, series: bool = False, us: bool = True, sampling: dict | None = None,
) -> Run:
    """A run over the DICOM files below ``folder``; nothing is written until ``write`` is asked for.

    Volumes are read on their keyframes (``sampling``: sample_pct, floor, ceiling), and what is found there is zeroed on all
    frames. ``series``: single-frame files of one series and geometry are a volume together, in slice order, and share their
    route and their ultrasound regions, which ``us`` switches. Only rectangles are joined to files, and each file is read,
    redacted and scrubbed by one task. Detections and scrubbed files are written once to the shared folder, as several
    results read them.
    """
    if mask_mode not in ("box", "diff") or (series and mask_mode == "diff"):
        raise rules.RuleError(f"mask mode {mask_mode!r} does not fit")  # diff looks at the frame of the detection, which lies in another file
    salt, table = salt or rules.salt(), rules.actions(rules.PII_ACTIONS if actions is None else actions)
    found = dicom.files(spark, folder)
    placed = placed_files(found, series, us, sampling)
    raw = keep(redact.detect(dicom.frame_rows(placed.where(F.size("wanted") > 0)), reader), "detections")
    decided = redact.decide(raw, model)
    decided = decided.join(placed.select("uri", "volume"), "uri") if series else decided.withColumn("volume", F.col("uri"))
    bad = raw.where("error IS NOT NULL").groupBy("uri").agg(F.max("error").alias("reader_error"))
    ready = placed.join(redact.file_boxes(decided, "volume"), "volume", "left").join(bad, "uri", "left").fillna({"low": 0})

    def scrub(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                error, stage = r.reader_error or None, "detect" if r.reader_error else None
                data = audit = uid = new = None
                if not error:
                    try:
                        stage = "read"
                        frames = dicom.frames(dicom.parse(r.content))
                        stage = "redact"
                        frames = redact.redacted(frames, r.boxes, r.us_regions, mask_mode)
                        stage = "scrub"
                        data, found_audit = scrubbed_file(r.content, np.concatenate([f.reshape(-1) for f in frames]) if frames else None, r.uri, salt, table, series)
                        audit = [dict(zip(("tag", "keyword", "action", "redacted"), a)) for a in found_audit]
                        uid, new = (dicom.value_of(dicom.parse(x, pixels=False), "SOPInstanceUID") for x in (r.content, data))
                        stage = None
                    except dicom.DicomError as e:
                        data, error = None, str(e)
                    except Exception as e:  # noqa: BLE001  the file fails, not the run
                        data, error = None, type(e).__name__
                rows.append((r.uri, data, uid, new, audit, error, stage, int(r.low)))
            yield pd.DataFrame(rows, columns=["uri", "content", "original_sop_uid", "deid_sop_uid", "audit", "error", "error_stage", "low"])

    schema = "uri string, content binary, original_sop_uid string, deid_sop_uid string, audit array<struct<tag:string,keyword:string,action:string,redacted:boolean>>, error string, error_stage string, low int"
    scrubbed = keep(ready.select("uri", "content", "boxes", "us_regions", "reader_error", "low").mapInPandas(scrub, schema), "scrubbed")
    outputs = scrubbed.withColumn("path", output_path(below(F.col("uri"), folder), salt, out, F.lit(".dcm"))).withColumn("route", reports.route(F.when(F.lit(to_review), F.col("low")).otherwise(0), F.col("error")))
    uids = scrubbed.select(F.col("uri").alias("source_path"), "original_sop_uid", "deid_sop_uid")
    shown = decided.select(
        F.col("uri").alias("source_path"), "frame_index", F.col("bbox.x").alias("bbox_x"), F.col("bbox.y").alias("bbox_y"), F.col("bbox.w").alias("bbox_w"), F.col("bbox.h").alias("bbox_h"),
        token("ocr_text", salt).alias("text_token"), F.length("ocr_text").alias("text_len"), F.round("confidence", 4).alias("confidence"), "decision",
    ).join(uids, "source_path", "left")
    tags = scrubbed.select(F.col("uri").alias("source_path"), "original_sop_uid", "deid_sop_uid", F.explode("audit").alias("a")).select("source_path", "original_sop_uid", "deid_sop_uid", "a.*")
    return Run(outputs, reports.pixel_report(shown), tags.select(*rules.TAG_COLUMNS))


def run_images(
    spark: SparkSession, folder: str, out: str, reader: Callable[[], redact.Reader], model=None, salt: str | None = None, to_review: bool = True, series: bool = False,
) -> Run:
    """A run over the PNG and JPEG files below ``folder``; outputs are PNGs.

    ``series``: the images of a folder of one shape are a volume together, in path order; files of the root stand alone.
    """
    salt = salt or rules.salt()
    read = images.read_images(spark, folder)

    def grey(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["uri", "frame_index", "n_frames", "rows", "cols", "channels", "dtype", "pixels", "error"]
        for batch in batches:
            out_rows = []
            for r in batch.itertuples(index=False):
                if r.error:
                    out_rows.append((r.uri, 0, 1, None, None, None, None, None, r.error))
                    continue
                a = images.rgb(r.bgr, r.rows, r.cols, r.channels)
                out_rows.append((r.uri, 0, 1, r.rows, r.cols, 1 if a.ndim == 2 else 3, a.dtype.str, np.ascontiguousarray(a).tobytes(), None))
            yield pd.DataFrame(out_rows, columns=names)

    frames = read.select("uri", "rows", "cols", "channels", "bgr", "error").mapInPandas(grey, dicom.FRAMES)
    key = F.col("uri")
    if series:
        root = F.lit("/" + folder.removeprefix("file:").strip("/"))
        parent = F.regexp_replace(F.regexp_replace("uri", "^file:(//)?", ""), "/[^/]*$", "")
        key = F.when(F.col("error").isNotNull() | (parent == root), F.col("uri")).otherwise(F.concat_ws("|", parent, "rows", "cols", "channels"))
    keyed = frames.select("uri", "error", key.alias("volume"))
    placed = series_ops.order(keyed.withColumns({"z": F.lit(None).cast("double"), "instance_number": F.lit(None).cast("int")}), ("volume",)).select("uri", "volume", F.col("frame_index").alias("volume_index"))
    placed = keep(placed.join(placed.groupBy("volume").agg(F.count("*").cast("int").alias("volume_size")), "volume"), "volumes")
    frames = frames.join(placed, "uri")
    picked = frames.where((F.col("volume_size") == 1) | F.array_contains(keyframes(F.col("volume_size")), F.col("volume_index")))
    raw = keep(redact.detect(picked, reader), "detections")
    decided = redact.decide(raw, model).join(placed.select("uri", "volume"), "uri")
    done = redact.apply(frames.drop("volume_index", "volume_size"), redact.volume_boxes(decided, "volume"), ["volume"])
    bad = raw.groupBy("uri").agg(F.max("error").alias("reader_error"))
    low = decided.groupBy("volume").agg(F.count_if(F.col("decision") == "low_confidence").cast("int").alias("low"))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (r.uri, None if r.pixels is None or r.reader_error else images.png(redact.unpack(r.pixels, r.dtype, int(r.rows), int(r.cols), int(r.channels))), r.error or r.reader_error, int(r.low or 0))
                for r in batch.itertuples(index=False)
            ]
            yield pd.DataFrame(rows, columns=["uri", "content", "error", "low"])

    joined = done.join(bad, "uri", "left").join(low, "volume", "left").fillna({"low": 0})
    outputs = joined.select("uri", "rows", "cols", "channels", "dtype", "pixels", "error", "reader_error", "low").mapInPandas(encode, "uri string, content binary, error string, low int")
    outputs = outputs.withColumn("path", output_path(below(F.col("uri"), folder), salt, out, F.lit(".png"))).withColumn("route", reports.route(F.when(F.lit(to_review), F.col("low")).otherwise(0), F.col("error")))
    none = F.lit(None).cast("string")
    shown = decided.select(
        F.col("uri").alias("source_path"), none.alias("original_sop_uid"), none.alias("deid_sop_uid"), F.lit(None).cast("int").alias("frame_index"), F.col("bbox.x").alias("bbox_x"), F.col("bbox.y").alias("bbox_y"),
        F.col("bbox.w").alias("bbox_w"), F.col("bbox.h").alias("bbox_h"), token("ocr_text", salt).alias("text_token"), F.length("ocr_text").alias("text_len"), F.round("confidence", 4).alias("confidence"), "decision",
    )
    return Run(outputs, reports.pixel_report(shown), None)


def write(run: Run) -> DataFrame:
    """Write what is routed ok; the route is decided before, so nothing has to be deleted."""
    return writers.write_files(run.outputs.where("route = 'ok'"))
