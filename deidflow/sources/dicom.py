"""DICOM Part 10 in and out: explicit and implicit little endian and deflated headers, nested sequences, native and run-length pixels.

Files come from Spark's ``binaryFile`` source and become long-form headers or frames in bounded batches; other compressed
pixel syntaxes are refused for the file, which then carries an error instead of rows.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
import zlib
from collections.abc import Iterator
from typing import Any, NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deidflow import rules
from deidflow.functions.paths import may_be_dicom

IMPLICIT, EXPLICIT, DEFLATED, RUN_LENGTH = "1.2.840.10008.1.2", "1.2.840.10008.1.2.1", "1.2.840.10008.1.2.1.99", "1.2.840.10008.1.2.5"
LONG_VRS = frozenset("OB OD OF OL OV OW SQ SV UC UN UR UT UV".split())
TEXT_VRS = frozenset("AE AS CS DA DS DT IS LO LT PN SH ST TM UC UI UR UT".split())
UNDEFINED = 0xFFFFFFFF
ITEM, ITEM_END, SEQUENCE_END = 0xFFFEE000, 0xFFFEE00D, 0xFFFEE0DD
PIXELS = 0x7FE00010

# Tags by number with representation and keyword, as the standard names them.
TAGS = {
    0x00020002: ("UI", "MediaStorageSOPClassUID"), 0x00020003: ("UI", "MediaStorageSOPInstanceUID"), 0x00020010: ("UI", "TransferSyntaxUID"), 0x00020012: ("UI", "ImplementationClassUID"),
    0x00080016: ("UI", "SOPClassUID"), 0x00080018: ("UI", "SOPInstanceUID"), 0x00080020: ("DA", "StudyDate"), 0x00080021: ("DA", "SeriesDate"), 0x00080023: ("DA", "ContentDate"),
    0x00080030: ("TM", "StudyTime"), 0x00080031: ("TM", "SeriesTime"), 0x00080050: ("SH", "AccessionNumber"), 0x00080060: ("CS", "Modality"), 0x00080080: ("LO", "InstitutionName"),
    0x00080081: ("ST", "InstitutionAddress"), 0x00080090: ("PN", "ReferringPhysicianName"), 0x00081030: ("LO", "StudyDescription"), 0x0008103E: ("LO", "SeriesDescription"),
    0x00081155: ("UI", "ReferencedSOPInstanceUID"), 0x00081150: ("UI", "ReferencedSOPClassUID"), 0x00081199: ("SQ", "ReferencedSOPSequence"), 0x00100010: ("PN", "PatientName"),
    0x00100020: ("LO", "PatientID"), 0x00100030: ("DA", "PatientBirthDate"), 0x00100040: ("CS", "PatientSex"), 0x00101010: ("AS", "PatientAge"), 0x00120062: ("CS", "PatientIdentityRemoved"),
    0x00120063: ("LO", "DeidentificationMethod"), 0x00120064: ("SQ", "DeidentificationMethodCodeSequence"), 0x00180050: ("DS", "SliceThickness"), 0x00186011: ("SQ", "SequenceOfUltrasoundRegions"),
    0x00186018: ("UL", "RegionLocationMinX0"), 0x0018601A: ("UL", "RegionLocationMinY0"), 0x0018601C: ("UL", "RegionLocationMaxX1"), 0x0018601E: ("UL", "RegionLocationMaxY1"),
    0x0020000D: ("UI", "StudyInstanceUID"), 0x0020000E: ("UI", "SeriesInstanceUID"), 0x00200010: ("SH", "StudyID"), 0x00200013: ("IS", "InstanceNumber"), 0x00200032: ("DS", "ImagePositionPatient"),
    0x00200037: ("DS", "ImageOrientationPatient"), 0x00200052: ("UI", "FrameOfReferenceUID"), 0x00280002: ("US", "SamplesPerPixel"), 0x00280004: ("CS", "PhotometricInterpretation"),
    0x00280006: ("US", "PlanarConfiguration"), 0x00280008: ("IS", "NumberOfFrames"), 0x00280010: ("US", "Rows"), 0x00280011: ("US", "Columns"), 0x00280030: ("DS", "PixelSpacing"), 0x00280100: ("US", "BitsAllocated"), 0x00280101: ("US", "BitsStored"),
    0x00280102: ("US", "HighBit"), 0x00280103: ("US", "PixelRepresentation"), 0x00280301: ("CS", "BurnedInAnnotation"), 0x00281050: ("DS", "WindowCenter"), 0x00281051: ("DS", "WindowWidth"),
    0x00400275: ("SQ", "RequestAttributesSequence"), 0x0040A124: ("UI", "UID"), 0x7FE00010: ("OW", "PixelData"),
}
NUMBERS = {name: number for number, (_, name) in TAGS.items()}
#: UIDs of the roots in use, with the padding that they may have.
_UID = re.compile(rb"(?:1\.[23]|2\.25)(?:\.[0-9]+)+(?:\\(?:1\.[23]|2\.25)(?:\.[0-9]+)+)*\0?")
_FORMATS = {"US": "H", "SS": "h", "UL": "I", "SL": "i", "FL": "f", "FD": "d"}


class DicomError(ValueError):
    """A file that cannot be read; its message names no content."""


class Element(NamedTuple):
    tag: int
    vr: str
    value: Any  # bytes, a list of items (lists of elements) for sequences, or a tuple of fragments for run-length pixels


def name(tag: int) -> str:
    return f"({tag >> 16:04X},{tag & 0xFFFF:04X})"


def has_magic(data: bytes) -> bool:
    return data[128:132] == b"DICM"


# --- reading -------------------------------------------------------------------------------------------------------


def _elements(data: bytes, at: int, end: int, explicit: bool, stop_at: int | None, depth: int = 0) -> tuple[list[Element], int]:
    out: list[Element] = []
    if depth > 32:
        raise DicomError("nested too deep")
    while at + 8 <= end:
        group, number = struct.unpack_from("<HH", data, at)
        tag = group << 16 | number
        if tag in (ITEM_END, SEQUENCE_END):
            return out, at + 8
        if stop_at is not None and tag >= stop_at:
            return out, at
        if explicit and tag != ITEM:
            vr = data[at + 4 : at + 6].decode("latin-1")
            if vr in LONG_VRS:
                length, at = struct.unpack_from("<I", data, at + 8)[0], at + 12
            else:
                length, at = struct.unpack_from("<H", data, at + 6)[0], at + 8
        else:
            vr = TAGS.get(tag, ("UN",))[0]
            length, at = struct.unpack_from("<I", data, at + 4)[0], at + 8
        if length == UNDEFINED and tag == PIXELS:
            fragments, at = _fragments(data, at, end)
            out.append(Element(tag, vr, fragments))
            continue
        if vr == "SQ" or length == UNDEFINED:
            items, at = _items(data, at, end if length == UNDEFINED else at + length, explicit and vr == "SQ", depth)
            out.append(Element(tag, "SQ", items))
            continue
        if at + length > end:
            raise DicomError("cut file")
        if vr == "UN":
            out.append(_unlisted(tag, data, at, at + length, depth))
        else:
            out.append(Element(tag, vr, data[at : at + length]))
        at += length
    return out, at


def _unlisted(tag: int, data: bytes, at: int, end: int, depth: int) -> Element:
    """An element of unknown representation: a sequence if it is made of items to its end, a UID if it reads like one."""
    value = data[at:end]
    if value[:4] == struct.pack("<HH", ITEM >> 16, ITEM & 0xFFFF):
        try:
            items, stop = _items(data, at, end, False, depth)
            if stop == end:
                return Element(tag, "SQ", items)
        except (DicomError, struct.error):
            pass
    return Element(tag, "UI" if _UID.fullmatch(value) else "UN", value)


def _fragments(data: bytes, at: int, end: int) -> tuple[tuple[bytes, ...], int]:
    """The items of encapsulated pixels, without the table of offsets that comes first."""
    parts = []
    while at + 8 <= end:
        group, number, length = struct.unpack_from("<HHI", data, at)
        at += 8
        if group << 16 | number == SEQUENCE_END:
            return tuple(parts[1:]), at
        if group << 16 | number != ITEM or at + length > end:
            break
        parts.append(data[at : at + length])
        at += length
    raise DicomError("cut file")


def _run_length(fragment: bytes, rows: int, cols: int, samples: int, size: int) -> np.ndarray:
    """A frame's samples, pixel by pixel, of one fragment: a segment for each byte of each colour, high bytes first."""
    n, *starts = struct.unpack_from("<16I", fragment)
    if n != samples * size:
        raise DicomError("damaged pixels")
    planes = np.empty((samples, size, rows * cols), np.uint8)
    for k in range(n):
        planes[k // size, size - 1 - k % size] = _unpacked(fragment[starts[k] : starts[k + 1] if k + 1 < n else len(fragment)], rows * cols)
    return np.ascontiguousarray(planes.transpose(2, 0, 1)).reshape(-1)


def _unpacked(segment: bytes, wanted: int) -> np.ndarray:
    """The first ``wanted`` bytes of a segment of copied stretches (0 to 127: one more byte) and repeats (129 to 255: 257 less)."""
    out, at = bytearray(), 0
    while len(out) < wanted and at + 1 < len(segment):
        code, at = segment[at], at + 1
        if code < 128:
            out += segment[at : at + code + 1]
            at += code + 1
        elif code > 128:
            out += segment[at : at + 1] * (257 - code)
            at += 1
    if len(out) < wanted:
        raise DicomError("cut pixels")
    return np.frombuffer(out, np.uint8, wanted)


def _items(data: bytes, at: int, end: int, explicit: bool, depth: int) -> tuple[list[list[Element]], int]:
    items = []
    while at + 8 <= end:
        group, number, length = struct.unpack_from("<HHI", data, at)
        tag, at = group << 16 | number, at + 8
        if tag == SEQUENCE_END:
            break
        if tag != ITEM:
            raise DicomError("damaged sequence")
        found, at = _elements(data, at, end if length == UNDEFINED else at + length, explicit, None, depth + 1)
        items.append(found)
    return items, at


def parse(data: bytes, pixels: bool = True) -> list[Element]:
    """All elements of a file, meta first; without ``pixels`` it stops before them."""
    if not has_magic(data):
        raise DicomError("no DICOM magic")
    try:
        meta, at = _elements(data, 132, len(data), True, 0x00030000)
        syntax = next((text(e.value) for e in meta if e.tag == NUMBERS["TransferSyntaxUID"]), IMPLICIT)
        if syntax == DEFLATED:
            data, at = zlib.decompress(data[at:], -zlib.MAX_WBITS), 0
        elif syntax not in (IMPLICIT, EXPLICIT, RUN_LENGTH) and pixels:
            raise DicomError("compressed pixels")
        body, _ = _elements(data, at, len(data), syntax != IMPLICIT, None if pixels else PIXELS)
    except (struct.error, zlib.error, IndexError) as e:
        raise DicomError("damaged file") from e
    return meta + body


def text(value: bytes | str) -> str:
    return value if isinstance(value, str) else bytes(value).decode("utf-8", "replace").rstrip("\0 ")


def shown(e: Element) -> str:
    """An element's value as text; several values are parted by backslashes."""
    if isinstance(e.value, str):
        return e.value
    if isinstance(e.value, tuple):
        return b"".join(e.value).hex()
    if e.vr in _FORMATS:
        size = struct.calcsize(_FORMATS[e.vr])
        return "\\".join(f"{v:g}" if e.vr in ("FL", "FD") else str(v) for v in struct.unpack(f"<{len(e.value) // size}{_FORMATS[e.vr]}", e.value[: len(e.value) // size * size]))
    return text(e.value) if e.vr in TEXT_VRS else e.value.hex()


def walk(elements: list[Element], path: str = "") -> Iterator[tuple[str, Element]]:
    """(path, element) of every element at every level; sequences come before what they hold."""
    for e in elements:
        yield path, e
        if isinstance(e.value, list):
            for k, item in enumerate(e.value):
                yield from walk(item, f"{path}/{name(e.tag)}[{k}]".lstrip("/"))


def value_of(elements: list[Element], keyword: str) -> str | None:
    return next((shown(e) for e in elements if e.tag == NUMBERS[keyword] and not isinstance(e.value, list)), None)


def frame_count(elements: list[Element]) -> int:
    return int(float(value_of(elements, "NumberOfFrames") or 1))


def frames(elements: list[Element]) -> list[np.ndarray]:
    """Frames of H x W or H x W x C samples in the file's own integer type; colours that come plane by plane are put pixel by pixel."""
    number = lambda k, default: int(float(value_of(elements, k) or default))
    rows, cols, samples, bits, signed = (number(k, v) for k, v in (("Rows", 0), ("Columns", 0), ("SamplesPerPixel", 1), ("BitsAllocated", 8), ("PixelRepresentation", 0)))
    n = frame_count(elements)
    raw = next((e.value for e in elements if e.tag == PIXELS), None)
    if raw is None or bits not in (8, 16):
        raise DicomError("no native pixels")
    kind = np.dtype(("i" if signed else "u") + str(bits // 8)).newbyteorder("<")
    size = rows * cols * samples
    planar = number("PlanarConfiguration", 0) == 1
    if isinstance(raw, tuple):
        if len(raw) != n:
            raise DicomError("damaged pixels")
        try:
            raw, planar = b"".join(_run_length(f, rows, cols, samples, kind.itemsize).tobytes() for f in raw), False
        except struct.error as e:
            raise DicomError("damaged pixels") from e
    if len(raw) < size * n * kind.itemsize:
        raise DicomError("cut pixels")
    all_samples = np.frombuffer(raw, kind, size * n)
    parts = [all_samples[k * size : (k + 1) * size] for k in range(n)]
    if samples == 1:
        return [p.reshape(rows, cols) for p in parts]
    if planar:
        return [np.ascontiguousarray(p.reshape(samples, rows, cols).transpose(1, 2, 0)) for p in parts]
    return [p.reshape(rows, cols, samples) for p in parts]


def pixel_elements(elements: list[Element], pixels: np.ndarray) -> list[Element]:
    """What the file says about new samples (those of ``frames``, one after another): type, bits, frames and order of colours."""
    size = math.prod(int(float(value_of(elements, k) or 1)) for k in ("Rows", "Columns", "SamplesPerPixel"))
    bits, before = 8 * pixels.dtype.itemsize, value_of(elements, "BitsAllocated")
    made = [element("PixelData", pixels.tobytes()), element("BitsAllocated", bits), element("PixelRepresentation", int(pixels.dtype.kind == "i"))]
    if str(bits) != before:  # else the file's own bits stored hold
        made += [element("BitsStored", bits), element("HighBit", bits - 1)]
    if int(float(value_of(elements, "SamplesPerPixel") or 1)) > 1:
        made.append(element("PlanarConfiguration", 0))
    if pixels.size != size:
        made.append(element("NumberOfFrames", pixels.size // size))
    return made


# --- writing -------------------------------------------------------------------------------------------------------


def encode(vr: str, value: Any) -> bytes:
    """A value's bytes, padded to even length."""
    if isinstance(value, (bytes, bytearray)):
        raw = bytes(value)
    elif vr in _FORMATS:
        parts = [p for p in str(value).split("\\") if p != ""]
        raw = struct.pack(f"<{len(parts)}{_FORMATS[vr]}", *(float(p) if vr in ("FL", "FD") else int(p) for p in parts))
    elif vr in TEXT_VRS:
        raw = str(value).encode()
    else:
        raw = bytes.fromhex(str(value))
    return raw + (b"\0" if vr in ("UI", "OB", "OW", "UN") else b" ") * (len(raw) % 2)


def _written(elements: list[Element]) -> bytes:
    out = []
    for e in sorted(elements, key=lambda e: e.tag):
        if isinstance(e.value, list):
            body = b"".join(struct.pack("<HHI", 0xFFFE, 0xE000, len(i)) + i for i in map(_written, e.value))
        else:
            body = encode(e.vr, e.value)
        head = struct.pack("<HH", e.tag >> 16, e.tag & 0xFFFF) + e.vr.encode()
        out.append(head + (b"\0\0" + struct.pack("<I", len(body)) if e.vr in LONG_VRS else struct.pack("<H", len(body))) + body)
    return b"".join(out)


def build(elements: list[Element]) -> bytes:
    """A Part 10 file in explicit little endian; the media's instance UID follows the data set's."""
    body = [e for e in elements if e.tag >> 16 != 2]
    uid = lambda k: next((e.value if isinstance(e.value, str) else text(e.value) for e in body if e.tag == NUMBERS[k]), "")
    meta = [
        Element(NUMBERS["MediaStorageSOPClassUID"], "UI", uid("SOPClassUID")), Element(NUMBERS["MediaStorageSOPInstanceUID"], "UI", uid("SOPInstanceUID")),
        Element(NUMBERS["TransferSyntaxUID"], "UI", EXPLICIT), Element(NUMBERS["ImplementationClassUID"], "UI", rules.UID_ROOT + "1"),
    ]
    head = _written(meta)
    return b"\0" * 128 + b"DICM" + _written([Element(0x00020000, "UL", str(len(head)))]) + head + _written(body)


def element(keyword: str, value: Any) -> Element:
    return Element(NUMBERS[keyword], TAGS[NUMBERS[keyword]][0], value)


def exact_uid(uid: str, salt: str) -> str:
    """The remap by sha-512: the root and the leading decimal digits of the digest, 64 characters in all."""
    digits = str(int(hashlib.sha512((salt + uid).encode()).hexdigest(), 16))
    return (rules.UID_ROOT + digits)[:64]


def exact_uids(uids: DataFrame, salt: str) -> DataFrame:
    """uid and deid_uid; each distinct UID is worked out once."""

    @F.pandas_udf("string")
    def remap(s: pd.Series) -> pd.Series:
        return s.map(lambda u: u if not u.strip() or u.startswith(rules.STANDARD_UID_ROOT) else exact_uid(u.strip(), salt))

    return uids.select("uid").distinct().withColumn("deid_uid", remap("uid"))


# --- tables --------------------------------------------------------------------------------------------------------

HEADER = "uri string, path string, tag string, keyword string, vr string, value string, error string"
FRAMES = "uri string, frame_index int, n_frames int, rows int, cols int, channels int, dtype string, pixels binary, error string"
SLICE = (
    "uri string, sop_instance_uid string, study_instance_uid string, series_instance_uid string, instance_number int, image_position_patient array<double>, modality string, rows int, "
    "columns int, pixel_spacing array<double>, slice_thickness double, image_orientation_patient array<double>, number_of_frames int"
)


def files(spark: SparkSession, folder: str) -> DataFrame:
    """uri and content of what may be DICOM below ``folder``: by name first, then by the magic."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    named = found.where(may_be_dicom(F.col("path")))
    return named.select(F.col("path").alias("uri"), "content").where(F.substring("content", 129, 4) == F.lit(b"DICM"))


def header_rows(uri: str, data: bytes) -> list[tuple]:
    try:
        found = parse(data, pixels=False)
    except DicomError as e:
        return [(uri, None, None, None, None, None, str(e))]
    return [(uri, path, name(e.tag), TAGS.get(e.tag, (None, None))[1], e.vr, None if isinstance(e.value, list) else shown(e), None) for path, e in walk(found)]


def headers(found: DataFrame) -> DataFrame:
    """Long-form headers of ``files``; an unreadable file is one row with an error."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in HEADER.split(", ")]
        for batch in batches:
            for uri, data in zip(batch.uri, batch.content):
                yield pd.DataFrame(header_rows(uri, data), columns=names)

    return found.select("uri", "content").mapInPandas(rows, HEADER)


def _numbers(value: str | None) -> list[float] | None:
    try:
        return [float(v) for v in value.split("\\")] if value else None
    except ValueError:
        return None


def slices(found: DataFrame, modalities: tuple[str, ...] = rules.MODALITIES) -> DataFrame:
    """The slice table of readable files of accepted modalities; numbers that cannot be read are null."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in SLICE.split(", ")]
        for batch in batches:
            out = []
            for uri, data in zip(batch.uri, batch.content):
                try:
                    e = parse(data, pixels=False)
                except DicomError:
                    continue
                v = lambda k: value_of(e, k)  # noqa: B023, E731
                one = lambda k: (_numbers(v(k)) or [None])[0]  # noqa: B023, E731
                whole = lambda k: None if one(k) is None else int(one(k))  # noqa: B023, E731
                out.append((
                    uri, v("SOPInstanceUID") or "", v("StudyInstanceUID") or "", v("SeriesInstanceUID") or "", whole("InstanceNumber"), _numbers(v("ImagePositionPatient")), v("Modality") or "",
                    whole("Rows") or 0, whole("Columns") or 0, _numbers(v("PixelSpacing")), one("SliceThickness"), _numbers(v("ImageOrientationPatient")), whole("NumberOfFrames"),
                ))
            yield pd.DataFrame(out, columns=names)

    return found.select("uri", "content").mapInPandas(rows, SLICE).where(F.upper("modality").isin(*modalities))


#: Frames are handed on when they hold so many bytes together.
FRAME_BYTES = 16 << 20
REGIONS = "array<struct<x0:int,y0:int,x1:int,y1:int>>"


def us_regions(elements: list[Element]) -> list[dict[str, int]] | None:
    """Valid rectangles of an ultrasound file; equal ones once, clamped to the frame, none of no area."""
    if value_of(elements, "Modality") != "US":
        return None
    h, w = int(value_of(elements, "Rows") or 0), int(value_of(elements, "Columns") or 0)
    boxes = set()
    for item in next((x.value for x in elements if x.tag == NUMBERS["SequenceOfUltrasoundRegions"]), []):
        v = [value_of(item, k) for k in ("RegionLocationMinX0", "RegionLocationMinY0", "RegionLocationMaxX1", "RegionLocationMaxY1")]
        if None not in v:
            x0, y0, x1, y1 = max(0, int(v[0])), max(0, int(v[1])), min(w, int(v[2])), min(h, int(v[3]))
            if x1 > x0 and y1 > y0:
                boxes.add((x0, y0, x1, y1))
    return [dict(zip(("x0", "y0", "x1", "y1"), b)) for b in sorted(boxes)] or None


def facts(content: Column) -> Column:
    """struct(n_frames, us_regions) of a file's header, beside its bytes, which stay where they are; nulls for an unreadable file."""

    @F.pandas_udf(f"n_frames int, us_regions {REGIONS}")
    def read(files: pd.Series) -> pd.DataFrame:
        out = []
        for data in files:
            try:
                e = parse(data, pixels=False)
                out.append((frame_count(e), us_regions(e)))
            except (DicomError, ValueError):
                out.append((None, None))
        return pd.DataFrame(out, columns=["n_frames", "us_regions"]).astype({"n_frames": "Int32"})

    return read(content)


def frame_rows(found: DataFrame) -> DataFrame:
    """One row per frame, so that no volume is held in a cell; a file without readable pixels is one row with an error.

    ``wanted`` (indices), if there, chooses frames; ``us_regions``, if there, goes along.
    """
    chosen, along = "wanted" in found.columns, ["us_regions"] * ("us_regions" in found.columns)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in FRAMES.split(", ")] + along
        out, held = [], 0
        for batch in batches:
            for r in batch.itertuples(index=False):
                more = (r.us_regions,) if along else ()
                try:
                    all_frames = frames(parse(r.content))
                except DicomError as e:
                    out.append((r.uri, None, None, None, None, None, None, None, str(e), *more))
                    continue
                for k in r.wanted if chosen else range(len(all_frames)):
                    f = all_frames[k]
                    out.append((r.uri, k, len(all_frames), f.shape[0], f.shape[1], 1 if f.ndim == 2 else f.shape[2], f.dtype.str, f.tobytes(), None, *more))
                    held += f.nbytes
                    if held >= FRAME_BYTES:
                        yield pd.DataFrame(out, columns=names)
                        out, held = [], 0
        if out:
            yield pd.DataFrame(out, columns=names)

    return found.select("uri", "content", *["wanted"] * chosen, *along).mapInPandas(rows, FRAMES + f", us_regions {REGIONS}" * len(along))
