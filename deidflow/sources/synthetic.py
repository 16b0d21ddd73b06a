"""Deterministic files for tests: text drawn with a small bitmap font, DICOM files and PNGs, and a reader of that font."""

from __future__ import annotations

import numpy as np

from deidflow.sources.dicom import Element, build, element
from deidflow.sources.images import png

# 5 rows of 3 pixels per character, a bit each, from the top left.
FONT = {
    "0": "111101101101111", "1": "010110010010111", "2": "111001111100111", "3": "111001111001111", "4": "101101111001001", "5": "111100111001111",
    "6": "111100111101111", "7": "111001001001001", "8": "111101111101111", "9": "111101111001111", "A": "010101111101101", "B": "110101110101110",
    "C": "111100100100111", "D": "110101101101110", "E": "111100110100111", "F": "111100110100100", "G": "111100101101111", "H": "101101111101101",
    "I": "111010010010111", "J": "001001001101111", "K": "101101110101101", "L": "100100100100111", "M": "101111111101101", "N": "110101101101101",
    "O": "010101101101010", "P": "110101110100100", "Q": "010101101110011", "R": "110101110110101", "S": "011100010001110", "T": "111010010010010",
    "U": "101101101101110", "V": "101101101101010", "W": "101101111111101", "X": "101101010101101", "Y": "101101010010010", "Z": "111001010100111",
    "-": "000000111000000", ".": "000000000000010", ":": "000010000010000", "/": "001001010100100",
}
SCALE = 2


def draw(lines: list[tuple[int, int, str]], rows: int = 64, cols: int = 200, ground: int = 0, ink: int = 255) -> np.ndarray:
    """A grey frame with each (x, y, text)."""
    out = np.full((rows, cols), ground, np.uint8)
    for x, y, text in lines:
        for k, c in enumerate(text.upper()):
            if c in FONT:
                glyph = np.array([int(b) for b in FONT[c]], np.uint8).reshape(5, 3).repeat(SCALE, 0).repeat(SCALE, 1)
                left = x + k * 4 * SCALE
                area = out[y : y + 5 * SCALE, left : left + 3 * SCALE]
                area[glyph[: area.shape[0], : area.shape[1]] == 1] = ink
    return out


def font_reader():
    """A reader of what ``draw`` writes in bright ink: exact glyph matches, left to right."""
    glyphs = {np.array([int(b) for b in v], np.uint8).tobytes(): k for k, v in FONT.items()}

    def read(frame: np.ndarray) -> list[tuple]:
        grey = frame if frame.ndim == 2 else frame.max(axis=2)
        bright = (grey > 200).astype(np.uint8)
        found = []
        rows = np.flatnonzero(bright.any(axis=1))
        for run in np.split(rows, np.flatnonzero(np.diff(rows) > 1) + 1) if len(rows) else []:
            top = int(run[0])
            band = bright[top : top + 5 * SCALE]
            if band.shape[0] < 5 * SCALE:
                continue
            cols = np.flatnonzero(band.any(axis=0))
            x, text, left = int(cols[0]), "", int(cols[0])
            while x + 3 * SCALE <= band.shape[1]:
                cell = band[::SCALE, x : x + 3 * SCALE : SCALE]
                c = glyphs.get(cell.tobytes())
                if c is None:
                    if cell.any() or not band[:, x:].any() or not band[:, x : x + 12 * SCALE].any():
                        break
                    text += " "
                else:
                    text += c
                x += 4 * SCALE
            text = text.rstrip()
            if text:
                right, bottom = left + len(text) * 4 * SCALE, top + 5 * SCALE
                found.append(([[left, top], [right, top], [right, bottom], [left, bottom]], text, 0.9))
        return found

    return read


def dicom_file(number: int = 1, lines: list[tuple[int, int, str]] | None = None, n_frames: int = 1, modality: str = "OT", regions: list[tuple[int, int, int, int]] = ()) -> bytes:
    """A small file with personal data in header and pixels."""
    lines = [(4, 4, "20240101-091825-6AAA"), (4, 24, "HOSPITAL CENTER")] if lines is None else lines
    frame = draw(lines)
    body: list[Element] = [
        element("SOPClassUID", "1.2.840.10008.5.1.4.1.1.7"), element("SOPInstanceUID", f"1.2.3.4.{number}"), element("StudyInstanceUID", "1.2.3.9"), element("SeriesInstanceUID", "1.2.3.9.1"),
        element("StudyDate", "20240101"), element("AccessionNumber", f"ACC{number}"), element("Modality", modality), element("InstitutionName", "GENERAL HOSPITAL"), element("PatientName", "SYNTHETIC^PATIENT"),
        element("PatientID", f"SYN-{number:04d}"), element("PatientBirthDate", "19000101"), element("StudyID", "STUDY-1"), element("InstanceNumber", str(number)), element("ImagePositionPatient", f"0\\0\\{number}"),
        element("RequestAttributesSequence", [[element("PatientName", "SYNTHETIC^PATIENT")]]), Element(0x00091001, "LO", "private note"),
        element("ReferencedSOPSequence", [[element("ReferencedSOPInstanceUID", "1.2.3.9")]]), element("SamplesPerPixel", "1"), element("PhotometricInterpretation", "MONOCHROME2"),
        element("Rows", str(frame.shape[0])), element("Columns", str(frame.shape[1])), element("BitsAllocated", "8"), element("BitsStored", "8"), element("HighBit", "7"), element("PixelRepresentation", "0"),
        element("PixelData", np.stack([frame] * n_frames).tobytes()),
    ]
    if n_frames > 1:
        body.append(element("NumberOfFrames", str(n_frames)))
    if regions:
        corner = ("RegionLocationMinX0", "RegionLocationMinY0", "RegionLocationMaxX1", "RegionLocationMaxY1")
        body.append(element("SequenceOfUltrasoundRegions", [[element(k, str(v)) for k, v in zip(corner, r)] for r in regions]))
    return build(body)


def image_file(lines: list[tuple[int, int, str]] | None = None) -> bytes:
    return png(draw([(4, 4, "MRN: 12345")] if lines is None else lines))
