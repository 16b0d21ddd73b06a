"""Media columns: GIF.

``gif_frames`` decodes any GIF: LZW code streams, global and local palettes, interlacing, transparency, and the disposal
rules (keep, background, previous), into timed RGBA frames. ``store`` writes bytes as a GIF of 64-pixel rows whose
samples are palette indices of a grey ramp, LZW-compressed; ``media_columns`` decodes stored GIFs into frame structs
with colour histograms and hands back the samples.

Defined results: a null text is an empty one and stores one row of zeros; a long text is spread over frames of at most
``FRAME_ROWS`` rows; equal texts have equal media; repeated rows are kept; an empty table gives an empty result; a media
value that is null or no GIF gives null columns and an ``error``.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

ROW = 64
FRAME_ROWS = 1024
DELAY = 10
BINS = 4  # histogram bins of each colour channel
GREYS = bytes(v for g in range(256) for v in (g, g, g))


# --- LZW ---------------------------------------------------------------------------------------------------------


def lzw_codes(data: bytes, bits: int = 8) -> list[int]:
    """The code stream of ``data``: a clear code, greedy longest matches, a clear code when the table is full, end."""
    return _parsed(data, bits).tolist()


def _parsed(data: bytes, bits: int) -> np.ndarray:
    """``lzw_codes`` as an array. Inside, codes stand 8 bits higher, so that a code plus a byte is the key of the longer match."""
    clear, end = 1 << bits, (1 << bits) + 1
    it = iter(data)
    prefix = next(it, None)
    if prefix is None:
        return np.array([clear, end], "<u2")
    prefix, first, full = prefix << 8, (end + 1) << 8, 4096 << 8
    codes, table, size = [clear << 8], {}, first
    put, claim = codes.append, table.setdefault
    for byte in it:
        code = claim(prefix + byte, size)
        if code is not size:  # the key was there: sizes are new objects
            prefix = code
            continue
        put(prefix)
        if size < full:
            size += 256
        else:
            put(clear << 8)
            table.clear()
            size = first
        prefix = byte << 8
    put(prefix)
    put(end << 8)
    return (np.frombuffer(array("i", codes), np.int32) >> 8).astype("<u2")


@functools.cache
def _first_widths(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits of the 4,096 codes from a clear code on, and their ends in bits: the k-th (from 0) is read when the table holds ``clear + 1 + k`` entries."""
    size = (1 << bits) + 1 + np.arange(4096)
    width = np.minimum(np.maximum(bits + 1, np.floor(np.log2(size)).astype(np.int64) + 1), 12)
    return width, np.cumsum(width)


def _widths(bits: int, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits and ends of the codes number ``start`` to ``stop`` (without it) from a clear code on; beyond the table all have 12 bits."""
    width, ends = _first_widths(bits)
    if stop <= 4096:
        return width[start:stop], ends[start:stop]
    later = np.arange(max(start, 4096), stop)
    return np.concatenate((width[start:], np.full(len(later), 12))), np.concatenate((ends[start:], ends[-1] + 12 * (later - 4095)))


def pack_codes(codes: list[int] | np.ndarray, bits: int = 8) -> bytes:
    """Codes packed from the least significant bit on, each in the width that the table's size gives it."""
    values = np.asarray(codes, "<u2")
    cuts = [0, *(np.flatnonzero(values == 1 << bits) + 1).tolist(), len(values)]
    width = np.concatenate([_widths(bits, 0, b - a)[0] for a, b in itertools.pairwise(cuts)])
    flat = np.unpackbits(values.view(np.uint8), bitorder="little").reshape(-1, 16)
    # Codes of one width follow each other: their bits are columns of a rectangle.
    turns = [0, *(np.flatnonzero(np.diff(width)) + 1).tolist(), len(width)]
    return np.packbits(np.concatenate([flat[a:b, : width[a]].ravel() for a, b in itertools.pairwise(turns)]), bitorder="little").tobytes()


def lzw_decode(data: bytes, bits: int, limit: int) -> bytes:
    """The samples of an LZW stream, at most ``limit``; damaged streams give what comes before the damage."""
    if bits > 8:
        raise ValueError("damaged GIF")
    clear, out, size = 1 << bits, [], 0
    for fresh, codes in _runs(data, bits):
        if fresh:
            found, starts, stops, whole = _unfolded(codes, clear, limit - size)
            table = None
        else:  # the table is full and stays as it is
            if table is None:
                table = [bytes((i,)) for i in range(clear)] + [b"", b""] + [found[a : b + 1] for a, b in zip(starts.tolist(), stops.tolist())]
            found = b"".join([table[c] for c in codes.tolist()])[: limit - size]
        out.append(found)
        size += len(found)
        if not whole or size >= limit:
            break
    return b"".join(out)


def _runs(data: bytes, bits: int) -> Iterator[tuple[bool, np.ndarray]]:
    """Codes up to the end code or as far as the data go: those that follow a clear code (True) until the table is full, and runs of the others."""
    clear, end = 1 << bits, (1 << bits) + 1
    words = np.ndarray((len(data) + 1,), "<u4", data + b"\0\0\0\0", strides=(1,))  # the four bytes from each byte on
    at, done, total = 0, 0, len(data) * 8  # ``at``: the end of the last clear code
    while True:
        # Widths depend on a code's number since the last clear code alone. First as many codes as fill the table, and a clear code.
        n = 8192 if done else min(4096 - clear, (total - at) // (bits + 1))
        width, ends = _widths(bits, done, done + n)
        n = int(np.searchsorted(ends, total - at, "right"))
        if not n:
            return
        width = width[:n]
        starts = at + ends[:n] - width
        codes = (words[starts >> 3] >> (starts & 7)) & ((1 << width) - 1)
        stop = np.flatnonzero((codes == clear) | (codes == end))
        yield not done, codes[: stop[0]] if len(stop) else codes
        if not len(stop):
            done += n
        elif codes[stop[0]] == end:
            return
        else:
            at, done = at + int(ends[stop[0]]), 0


def _unfolded(codes: np.ndarray, clear: int, limit: int, piece: int = 1 << 20) -> tuple[bytes, np.ndarray, np.ndarray, bool]:
    """The samples of the codes after a clear code, at most ``limit``, where each code's string starts and stops, and whether all codes were sound.

    Entry j of the table is the string of code j and the first sample of code j + 1. So a code's string is that of an earlier
    code, its parent, and one more sample: lengths and samples are found by following parents, in steps that double. ``piece``
    bounds the samples that are followed at once.
    """
    number = np.arange(len(codes))
    parent = codes - clear - 2  # negative: the code is a sample itself
    bad = np.flatnonzero(parent >= number)
    whole = not len(bad)
    if not whole:
        codes, number, parent = codes[: bad[0]], number[: bad[0]], parent[: bad[0]]
    if not len(codes):
        return b"", number, number, whole
    single = parent < 0
    parent, last = np.where(single, number, parent), np.where(single, number, parent + 1)
    root, size = parent, np.where(single, 1, 2)  # size: of the string, up to its part in the root's
    while (more := size[root] - 1).any():
        size += more
        root = root[root]
    stops = np.cumsum(size)
    starts = stops - size
    n = int(np.searchsorted(starts, limit))  # codes that start before the limit
    if not n:
        return b"", starts, stops, whole
    out = np.empty(int(stops[n - 1]), np.uint8)
    first = codes[root]  # of each string; its last sample is the first one of code ``last``
    out[stops[:n] - 1] = first[last[:n]]
    back = starts - starts[parent]
    a = 0
    while a < n:
        b = min(n, max(a + 1, int(np.searchsorted(stops, starts[a] + piece, "right"))))
        top, end = int(starts[a]), int(stops[b - 1])
        here = np.arange(end - top)
        source = here - np.repeat(back[a:b], size[a:b])
        lasts = stops[a:b] - 1 - top
        source[lasts] = lasts
        if a:  # what earlier pieces hold is known
            early = np.flatnonzero(source < 0)
            out[top + early] = out[top + source[early]]
            source[early] = early
        for _ in range(max(0, int(size[a:b].max()) - 2).bit_length()):  # the longest string has so many steps but one
            source = source[source]
        out[top:end] = out[top:end][source]
        a = b
    return out[:limit].tobytes(), starts, stops, whole


# --- container ---------------------------------------------------------------------------------------------------


def _sub_blocks(data: bytes) -> bytes:
    full, rest = divmod(len(data), 255)
    out = b"".join(b"\xff" + data[255 * i : 255 * i + 255] for i in range(full))
    return out + (bytes((rest,)) + data[255 * full :] if rest else b"") + b"\0"


def store(payload: bytes) -> bytes:
    """A GIF that holds ``payload`` (a positive multiple of 64 bytes) as samples, row by row and frame by frame."""
    rows = len(payload) // ROW
    out = [b"GIF89a", struct.pack("<HHBBB", ROW, min(rows, FRAME_ROWS), 0xF7, 0, 0), GREYS]
    for top in range(0, rows, FRAME_ROWS):
        part = payload[top * ROW : (top + FRAME_ROWS) * ROW]
        out.append(b"\x21\xf9\x04" + struct.pack("<BHB", 1 << 2, DELAY, 0) + b"\0")
        out.append(b"\x2c" + struct.pack("<HHHHB", 0, 0, ROW, len(part) // ROW, 0) + b"\x08")
        out.append(_sub_blocks(pack_codes(_parsed(part, 8))))
    return b"".join(out) + b"\x3b"


@dataclass
class Frame:
    """One image of a GIF: its rectangle, samples (palette indices, row by row), timing, and the canvas after drawing."""

    left: int
    top: int
    width: int
    height: int
    delay_ms: int
    disposal: int
    transparent: int | None
    samples: np.ndarray
    palette: np.ndarray
    canvas: np.ndarray | None


def _blocks_at(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while data[at]:
        parts.append(data[at + 1 : at + 1 + data[at]])
        at += 1 + data[at]
    return b"".join(parts), at + 1


def _palette(data: bytes, at: int, size: int) -> np.ndarray:
    return np.frombuffer(data[at : at + 3 * size], np.uint8).reshape(-1, 3)


def gif_frames(data: bytes, canvas: bool = True) -> Iterator[Frame]:
    """The frames of a GIF in order; ``canvas``: also draw them (RGBA, height x width) by palette, transparency, disposal."""
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    width, height, flags, background, _ = struct.unpack_from("<HHBBB", data, 6)
    at, common = 13, None
    if flags & 0x80:
        common = _palette(data, at, 2 << (flags & 7))
        at += 3 * len(common)
    board = np.zeros((height, width, 4), np.uint8) if canvas else None
    delay, disposal, clear = 0, 0, None
    while data[at] != 0x3B:
        kind = data[at]
        at += 1
        if kind == 0x21:
            label = data[at]
            body, at = _blocks_at(data, at + 1)
            if label == 0xF9:
                bits, delay, index = struct.unpack_from("<BHB", body)
                disposal, clear = bits >> 2 & 7, index if bits & 1 else None
            continue
        if kind != 0x2C:
            raise ValueError("damaged GIF")
        left, top, w, h, bits = struct.unpack_from("<HHHHB", data, at)
        at += 9
        palette = common
        if bits & 0x80:
            palette = _palette(data, at, 2 << (bits & 7))
            at += 3 * len(palette)
        if palette is None:
            raise ValueError("a GIF without palette")
        depth = data[at]
        stream, at = _blocks_at(data, at + 1)
        samples = np.zeros(w * h, np.uint8)
        found = np.frombuffer(lzw_decode(stream, depth, w * h), np.uint8)
        samples[: len(found)] = found
        if bits & 0x40:  # interlaced: rows come in four passes
            order = np.concatenate([np.arange(a, h, s) for a, s in ((0, 8), (4, 8), (2, 4), (1, 2))])
            laid = np.empty((h, w), np.uint8)
            laid[order] = samples.reshape(h, w)
            samples = laid.ravel()
        shown = None
        if board is not None:
            kept = board.copy() if disposal == 3 else None
            area = board[top : top + h, left : left + w]
            tile = samples.reshape(h, w)[: area.shape[0], : area.shape[1]]
            paint = np.ones(tile.shape, bool) if clear is None else tile != clear
            area[paint, :3] = palette[np.minimum(tile[paint], len(palette) - 1)]
            area[paint, 3] = 255
            shown = board.copy()
            if disposal == 2:
                area[:] = 0
            elif disposal == 3:
                board = kept
        yield Frame(left, top, w, h, delay * 10, disposal, clear, samples, palette, shown)
        delay, disposal, clear = 0, 0, None


def histogram(frame: Frame) -> np.ndarray:
    """Opaque pixels of a frame by red, green and blue bin: 3 x BINS counts."""
    counts = np.bincount(frame.samples, minlength=256)
    if frame.transparent is not None:
        counts[frame.transparent] = 0
    used = np.flatnonzero(counts)
    colours = frame.palette[np.minimum(used, len(frame.palette) - 1)] // (256 // BINS)
    return np.stack([np.bincount(colours[:, c], counts[used], BINS) for c in range(3)]).astype(np.int64)


def shown_histogram(canvas: np.ndarray) -> np.ndarray:
    """Opaque pixels of a canvas by red, green and blue bin: 3 x BINS counts."""
    colours = canvas[canvas[:, :, 3] > 0, :3] // (256 // BINS)
    return np.stack([np.bincount(colours[:, c], minlength=BINS) for c in range(3)]).astype(np.int64)


def covers_itself(data: bytes) -> bool:
    """Whether every frame is opaque and as large as the canvas, so that its samples are what is shown. Reads headers only."""
    width, height, flags = struct.unpack_from("<HHB", data, 6)
    at, clear = 13 + (3 * (2 << (flags & 7)) if flags & 0x80 else 0), False
    while data[at] != 0x3B:
        if data[at] == 0x21:
            clear = bool(data[at + 3] & 1) if data[at + 1] == 0xF9 else clear
            at += 2
        elif data[at] == 0x2C:
            left, top, w, h, bits = struct.unpack_from("<HHHHB", data, at + 1)
            if clear or left or top or w < width or h < height:
                return False
            at += 11 + (3 * (2 << (bits & 7)) if bits & 0x80 else 0)
            clear = False
        else:
            raise ValueError("damaged GIF")
        while data[at]:
            at += 1 + data[at]
        at += 1
    return True


# --- columns -----------------------------------------------------------------------------------------------------

FRAME_TYPE = "struct<index:int,start_ms:long,delay_ms:int,left:int,top:int,width:int,height:int,disposal:int,histogram:array<long>,shown_histogram:array<long>>"
_FRAME = pa.struct([
    ("index", pa.int32()), ("start_ms", pa.int64()), ("delay_ms", pa.int32()), ("left", pa.int32()), ("top", pa.int32()),
    ("width", pa.int32()), ("height", pa.int32()), ("disposal", pa.int32()), ("histogram", pa.list_(pa.int64())),
    ("shown_histogram", pa.list_(pa.int64())),
])
CHUNK = 64
#: Pixels of a canvas that is drawn; a header may claim any size up to 65,535 squared.
MAX_CANVAS = 1 << 25


def store_texts(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the media column of every whole text."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for at in range(0, batch.num_rows, CHUNK):
                texts = [(x or "").encode() for x in batch.column("text").slice(at, CHUNK).to_pylist()]
                media = [store(t + b"\0" * (-len(t) % ROW if t else ROW)) for t in texts]
                sizes = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, CHUNK), sizes, pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select("doc_id", "text").mapInArrow(batches, "doc_id long, n_bytes long, media binary")


def media_columns(media: DataFrame, samples: bool = False) -> DataFrame:
    """doc_id, n_bytes, payload digests read back from the stored samples, frames with times and histograms.

    ``samples``: also the samples themselves. Frames are decoded one by one. A frame's ``histogram`` is that of its own samples, its
    ``shown_histogram`` that of the canvas after it, by transparency and disposal; canvases are drawn only for GIFs with a
    frame that is smaller than the canvas or has transparency, as samples of full, opaque frames are what the canvas shows.
    A canvas of more than ``MAX_CANVAS`` pixels is not drawn, and its ``shown_histogram`` is null.
    """

    def one(data: bytes | None) -> tuple:
        if data is None:
            return (None,) * 7 + ("null",)
        crc, digest, size, tail, frames, start, parts = 0, hashlib.sha256(), 0, b"", [], 0, []
        try:
            plain = data[:6] not in (b"GIF87a", b"GIF89a") or covers_itself(data)
            draw = not plain and struct.unpack_from("<H", data, 6)[0] * struct.unpack_from("<H", data, 8)[0] <= MAX_CANVAS
            for k, f in enumerate(gif_frames(data, canvas=draw)):
                own = histogram(f).ravel().tolist()
                body = f.samples.tobytes()
                digest.update(body)
                size += len(body)
                tail = (tail + body)[-ROW:]
                frames.append({
                    "index": k, "start_ms": start, "delay_ms": f.delay_ms, "left": f.left, "top": f.top, "width": f.width,
                    "height": f.height, "disposal": f.disposal, "histogram": own,
                    "shown_histogram": own if plain else shown_histogram(f.canvas).ravel().tolist() if draw else None,
                })
                start += f.delay_ms
                if samples:
                    parts.append(body)
        except (ValueError, IndexError, struct.error) as e:
            return (None,) * 7 + (type(e).__name__,)
        crc = zlib.crc32(tail)
        return size, digest.hexdigest(), crc, len(data), hashlib.sha256(data).hexdigest(), frames, b"".join(parts) if samples else None, None

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                size, digest, crc, n, sha, frames, body, error = zip(*(one(x.as_py()) for x in part.column("media")))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("n_bytes"), pa.array(size, pa.int64()), pa.array(digest, pa.string()), pa.array(crc, pa.int64()),
                    pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(frames, pa.list_(_FRAME)), pa.array(body, pa.binary()), pa.array(error, pa.string()),
                ], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "frames", "samples", "error"])

    schema = f"doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, frames array<{FRAME_TYPE}>, samples binary, error string"
    return media.select("doc_id", "n_bytes", "media").mapInArrow(batches, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``feature``: frames, total milliseconds, and the summed red, green and blue histograms."""
    found = media_columns(store_texts(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    total = "aggregate(frames, array_repeat(0L, 12), (a, f) -> zip_with(a, f.histogram, (x, y) -> x + y))"
    feature = f"concat('frames=', size(frames), ';ms=', aggregate(frames, 0L, (a, f) -> a + f.delay_ms), ';rgb=', array_join({total}, ','))"
    return found.selectExpr("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", f"{feature} AS feature")
