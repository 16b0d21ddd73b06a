"""WARC archives: written by Spark's text writer, read back by boundary-chain verification.

Writing: one record per page, ended by CRLF CRLF (the writer's line separator), so the files are plain WARC/1.1 and
come with Spark's commit protocol. Equal payloads are stored once: that of the smallest page_id is a response, others
are revisits that refer to it. Rows are told apart by page_id and payload, so a page_id may repeat with other payloads.

Reading: the text reader cuts the files at every ``WARC/1.1`` line, in splits of any size. Each piece of a split is a
candidate record with the offset at which its successor would start. A task follows these offsets through its split, so
that every candidate knows where its chain leaves the split. Split sizes, summed in order, give true offsets. Only
candidates at which a chain of another split may arrive can be entries; pointer jumping over them, from each file's start,
finds the true entry of every split. A second pass follows the chain from there; the other pieces are magic inside
payloads and belong to the record that holds them, which may reach over many splits.

Defined results: null html is an empty payload; empty payloads count as equal ones (the bound is a parameter); a null
page_id is written and read as null and refers to nothing else; of rows with the smallest page_id and equal html one is
the response (that of the smallest url, null first), the others are its revisits; any payload, with magic or CR LF inside,
is read back byte for byte, whatever the length of its header; a cut last record is kept with what is there; a file whose
chain ends before its last byte raises ``BrokenChain`` (or is logged, with ``strict=False``, and gives the records before
the break); an empty table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import drop_table, materialise, scratch_path

MAGIC = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
ID = "urn:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_REVISIT_BYTES = 0
#: Bytes of a piece that are looked at first for the end of its header.
HEAD_BYTES = 1 << 16
#: Rows of revisits or of splits that may be broadcast; more are joined by a shuffle.
MAX_BROADCAST_ROWS = 500_000
#: Records of an Arrow batch that is handed on, and the bytes from which it is handed on before.
RECORDS, RECORD_BYTES = 128, 4 << 20
log = logging.getLogger(__name__)
DATE = "1970-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _safe(uri: str | None) -> str:
    """A header value: controls, spaces and a slash that would spell the magic are percent-encoded."""
    out = "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in uri or "")
    return out.replace("WARC/1.1", "WARC%2F1.1")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A record without its closing CRLF CRLF; ``refers_to`` makes it a revisit."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{ID}{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_safe(url)}", f"WARC-Payload-Digest: sha1:{digest(payload)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{ID}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return MAGIC + "\r\n".join(head).encode() + END + block


class BrokenChain(ValueError):
    """A file's records end before its last byte."""


def _keyed(pages: DataFrame) -> DataFrame:
    """page_id, url, html (null as empty), and the identity of the payload."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    return rows.withColumns({"sha": F.sha1(F.col("html").cast("binary")), "size": F.octet_length("html").cast("long")})


def revisits(pages: DataFrame, least: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, sha, size, refers_to and the number of such rows, of payloads that stand in two rows or more."""
    heads = _keyed(pages).where(f"size >= {least} AND page_id IS NOT NULL").groupBy("sha", "size", "page_id").agg(F.count("*").alias("rows"))
    heads = materialise(heads, "warc-heads")
    first = heads.groupBy("sha", "size").agg(F.min("page_id").alias("refers_to"), F.sum("rows").alias("n")).where("n > 1")
    return heads.join(first, ["sha", "size"]).where("page_id <> refers_to OR rows > 1").select("page_id", "sha", "size", "refers_to", "rows")


def _ties(rows: DataFrame) -> DataFrame:
    """The rows of a smallest page_id that repeats with its payload: the smallest url is the response, all others refer to it.

    Rows that are equal in all cannot be told apart, so they are counted and made again.
    """
    equal = rows.groupBy("page_id", "sha", "size", "url").agg(F.count("*").alias("rows"), F.min("html").alias("html"))
    first = equal.groupBy("page_id", "sha", "size").agg(F.min(F.struct(F.col("url").isNotNull().alias("a"), "url")).alias("first"))
    marked = equal.join(first, ["page_id", "sha", "size"]).withColumn("is_first", F.col("url").eqNullSafe(F.col("first.url")))
    made = marked.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return made.select("page_id", "url", "html", F.when(~(F.col("is_first") & (F.col("copy") == 1)), F.col("page_id")).alias("refers_to"))


def write(pages: DataFrame, path: str, least: int = MIN_REVISIT_BYTES) -> None:
    """Write the pages (page_id, url, html) as WARC files under ``path``."""
    again = materialise(revisits(pages, least), "warc-revisits")
    small = again.count() <= MAX_BROADCAST_ROWS
    ties = not again.where("page_id = refers_to").isEmpty()

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for at in range(0, batch.num_rows, RECORDS):
                part = batch.slice(at, RECORDS)
                out = [
                    record(i.as_py(), u.as_py(), (h.as_py() or "").encode(), r.as_py())
                    for i, u, h, r in zip(*(part.column(c) for c in ("page_id", "url", "html", "refers_to")))
                ]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    rows = _keyed(pages).join(F.broadcast(again.drop("rows")) if small else again.drop("rows"), ["page_id", "sha", "size"], "left")
    if ties:
        rows = rows.where("NOT page_id <=> refers_to OR page_id IS NULL").select("page_id", "url", "html", "refers_to").union(_ties(rows.where("page_id = refers_to").drop("refers_to")))
    rows = rows.select("page_id", "url", "html", "refers_to")
    rows.mapInArrow(batches, "record binary").select(F.col("record").cast("string")).write.option("lineSep", END.decode()).text(path)


def parse_head(piece: bytes | pa.Buffer) -> tuple:
    """(kind, page_id, refers_to, digest, header bytes, content length) of what follows a magic; nulls if it is no header."""
    whole, end, size = memoryview(piece), -1, HEAD_BYTES
    while end < 0:  # most headers are short, so long pieces are copied only as far as the header goes
        start = bytes(whole[:size])
        end = start.find(END)
        if end < 0 and size >= len(whole):
            return (None,) * 6
        size *= 8
    fields = {}
    for line in start[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return (None,) * 6
        fields[name.strip().lower()] = value.strip()
    length = fields.get(b"content-length", b"")
    if not length.isdigit() or len(length) > 15 or b"warc-type" not in fields:
        return (None,) * 6

    def number(name: bytes) -> int | None:
        value = fields.get(name, b"").strip(b"<>").removeprefix(ID.encode())
        return int(value) if value.lstrip(b"-").isdigit() and len(value) < 20 else None

    kind = fields[b"warc-type"].decode("utf-8", "replace").lower()
    sha = fields.get(b"warc-payload-digest", b"").removeprefix(b"sha1:").decode("utf-8", "replace")
    return kind, number(b"warc-record-id"), number(b"warc-refers-to"), sha, end + len(END), int(length)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The pieces of the archives between magics, as bytes, with file and split."""
    rows = spark.read.option("lineSep", MAGIC.decode()).text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("piece"))


def follow(at: np.ndarray, successor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(exit, tail) of each record of a split: where its chain leaves the split, and the last record on the way.

    ``at``: places of the records, ascending; a successor lies behind its record, so one pass from the end is enough.
    """
    n = len(at)
    target = np.minimum(np.searchsorted(at, successor), max(n - 1, 0))
    inside = at[target] == successor if n else np.zeros(0, bool)
    leaves, tail = successor.copy(), at.copy()
    for i in np.flatnonzero(inside)[::-1]:
        leaves[i], tail[i] = leaves[target[i]], tail[target[i]]
    return leaves, tail


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each split (``at`` null) with its bytes, and a row for each candidate with the places ``exit`` and ``tail``."""
    now, at, bytes_, places, successors = None, 0, 0, [], []

    def close() -> Iterator[pa.RecordBatch]:
        if now is None:
            return
        here, there = np.array(places, np.int64), np.array(successors, np.int64)
        leaves, tail = follow(here, there)
        n = len(here)
        yield pa.RecordBatch.from_arrays([
            pa.array([now[0]] * (n + 1), pa.string()), pa.array([now[1]] * (n + 1), pa.int64()), pa.array([None, *places], pa.int64()),
            pa.array([None, *leaves.tolist()], pa.int64()), pa.array([None, *tail.tolist()], pa.int64()), pa.array([bytes_] + [None] * n, pa.int64()),
        ], ["file", "split", "at", "exit", "tail", "bytes"])

    for batch in batches:
        for file, split, piece in zip(*(batch.column(c) for c in ("file", "split", "piece"))):
            if now != (here := (file.as_py(), split.as_py())):
                yield from close()
                now, at, bytes_, places, successors = here, -len(MAGIC), 0, [], []
            raw = piece.as_buffer()
            *_, head, content = parse_head(raw)
            if head is not None:
                places.append(at)
                successors.append(at + len(MAGIC) + head + content + len(END))
            at += len(raw) + len(MAGIC)
            bytes_ += len(raw) + len(MAGIC)
    yield from close()


def chains(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(splits, jumps) of the archives.

    splits: file, split, base (the offset of its place 0), bytes. jumps: file, split, offset, successor and tail of the
    candidates at a file's start or where a chain leaves a split: a few for each split, however many records it has.
    """
    found = materialise(_pieces(spark, path).mapInArrow(_candidates, "file string, split long, at long, exit long, tail long, bytes long"), "warc-candidates")
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # splits, not records
    sizes = found.where("at IS NULL").select("file", "split", "bytes")
    splits = materialise(sizes.withColumn("base", F.coalesce(F.sum("bytes").over(before), F.lit(0))), "warc-splits", narrow=True)
    small = splits.count() <= MAX_BROADCAST_ROWS
    placed = found.where("at IS NOT NULL").drop("bytes").join(F.broadcast(splits) if small else splits, ["file", "split"])
    placed = placed.select("file", "split", F.expr("base + at").alias("offset"), F.expr("base + exit").alias("successor"), F.expr("base + tail").alias("tail")).where("offset >= 0")
    entries = placed.select("file", F.col("successor").alias("offset")).distinct().union(placed.where("offset = 0").select("file", "offset")).distinct()
    return splits, materialise(placed.join(entries, ["file", "offset"], "left_semi"), "warc-jumps", narrow=True)


def reachable(chain: DataFrame) -> DataFrame:
    """(file, offset) of the rows of ``chain`` (file, offset, successor) on the path from offset 0, by pointer jumping.

    Round r knows the first 2^r entries of every file, and jumps of 2^r entries from every candidate.
    """
    spark = chain.sparkSession
    jumps = materialise(chain.where("successor IS NOT NULL").select("file", "offset", "successor"), "warc-jumps", narrow=True)
    starts = chain.where("offset = 0 AND successor IS NOT NULL").select("file", "offset")
    known, count = materialise(starts, "warc-known", narrow=True), -1
    while True:
        n = known.count()
        if n == count:
            drop_table(spark, jumps)
            return known
        count = n
        landed = known.join(jumps, ["file", "offset"]).select("file", F.col("successor").alias("offset"))
        # Jumps grow by doubling, so what they land on is new; only what is a candidate counts.
        real = landed.join(chain.where("successor IS NOT NULL").select("file", "offset"), ["file", "offset"], "left_semi")
        more = materialise(known.union(real).distinct(), "warc-known", narrow=True)
        onward = jumps.select("file", F.col("offset").alias("successor"), F.col("successor").alias("then"))
        longer = materialise(jumps.join(onward, ["file", "successor"]).select("file", "offset", F.col("then").alias("successor")), "warc-jumps", narrow=True)
        drop_table(spark, known)
        drop_table(spark, jumps)
        known, jumps = more, longer


def _payload(piece: bytes, head: int, content: int) -> tuple[bytes, int | None]:
    """(payload in the block, HTTP Content-Length) of a record's bytes after its magic."""
    http, _, body = piece[head : head + content].partition(END)
    length = None
    for line in http.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            length = int(value)
    return body, length


def _described(piece: bytes) -> tuple:
    kind, page, refers, sha, head, content = parse_head(piece)
    body, length = _payload(piece, head, content)
    if kind == "revisit":  # the full payload's length and digest, as its headers say
        return page, length, sha, kind, refers, None
    return page, len(body), digest(body), kind, refers, body


_RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
_RESULT_NAMES = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]


def _result(pieces: list[bytes], payloads: bool) -> pa.RecordBatch:
    columns = list(zip(*map(_described, pieces))) or [()] * 6
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    if not payloads:
        columns[5] = [None] * len(pieces)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], _RESULT_NAMES)


def _streamed(batches: Iterator[pa.RecordBatch], payloads: bool, loose: bool) -> Iterator[pa.RecordBatch]:
    """The records of splits whose entry is known: whole ones described, or (``loose``) the pieces of those that are not whole in a split."""
    names = [*_RESULT_NAMES, "file", "owner", "offset", "piece"]
    now, owner, expected, need, held = None, None, None, 0, []  # held: (offset, piece) of the record at hand
    whole, parts, weight = [], [], 0

    def close() -> None:
        nonlocal weight
        if not held:
            return
        if sum(len(p) for _, p in held) + len(MAGIC) * (len(held) - 1) >= need:
            if not loose:
                whole.append(MAGIC.join(p for _, p in held))
                weight += len(whole[-1])
        elif loose:
            parts.extend((now[0], held[0][0], o, p) for o, p in held)
            weight += sum(len(p) for _, p in held)
        held.clear()

    def out() -> pa.RecordBatch:
        nonlocal weight
        described = _result(whole, payloads)
        empty = lambda kind, n: pa.nulls(n, kind)
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary()]
        cells = list(zip(*parts)) or [()] * 4
        made = pa.RecordBatch.from_arrays([
            *(pa.concat_arrays([c, empty(c.type, len(parts))]) for c in described.columns),
            *(pa.concat_arrays([empty(k, len(whole)), pa.array(c, k)]) for c, k in zip(cells, kinds)),
        ], names)
        whole.clear()
        parts.clear()
        weight = 0
        return made

    for batch in batches:
        for file, split, at, base, entry, before, piece in zip(*(batch.column(c) for c in ("file", "split", "at", "base", "entry", "owner", "piece"))):
            if now != (here := (file.as_py(), split.as_py())):
                close()
                now, expected, owner = here, entry.as_py(), before.as_py()
            offset = base.as_py() + at.as_py()
            if offset < 0:  # before the file's first magic
                continue
            if offset == expected:
                close()
                raw = piece.as_py()
                *_, head, content = parse_head(raw)
                need = head + content + len(END)
                expected = offset + len(MAGIC) + need
                held.append((offset, raw))
            elif held:
                held.append((offset, piece.as_py()))
            elif owner is not None and loose:
                parts.append((now[0], owner, offset, piece.as_py()))
                weight += len(parts[-1][3])
            if len(whole) + len(parts) >= RECORDS or weight >= RECORD_BYTES:
                yield out()
    close()
    yield out()


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces with their place in their split; a split's rows come in order."""
    now, at = None, 0
    for batch in batches:
        places = []
        for file, split, piece in zip(*(batch.column(c) for c in ("file", "split", "piece"))):
            if now != (here := (file.as_py(), split.as_py())):
                now, at = here, -len(MAGIC)
            places.append(at)
            at += len(piece.as_buffer()) + len(MAGIC)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("file", "split", "piece")), pa.array(places, pa.int64())], ["file", "split", "piece", "at"])


def read(spark: SparkSession, path: str, payloads: bool = True, strict: bool = True) -> DataFrame:
    """The records of the archives under ``path``: ids, payload length, digest, type, what they revisit, the payload."""
    splits, jumps = chains(spark, path)
    real = reachable(jumps.select("file", "offset", "successor"))
    true = jumps.join(real, ["file", "offset"], "left_semi").select("file", "split", F.col("offset").alias("entry"), "successor", "tail")
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    info = splits.join(true, ["file", "split"], "left").withColumn("owner", F.last("tail", ignorenulls=True).over(earlier))
    info = materialise(info.withColumn("end", F.expr(f"base + bytes - {len(MAGIC)}")), "warc-entries", narrow=True)
    ends = info.groupBy("file").agg(F.max("end").alias("end"), F.coalesce(F.max("successor"), F.lit(0)).alias("last")).where("last < end")
    if broken := ends.count():
        said = f"{broken} archives end before their last byte, such as " + "; ".join(f"{r.file}: record chain up to {r['last']} of {r.end}" for r in ends.limit(3).collect())
        if strict:
            raise BrokenChain(said)
        log.warning(said)
    cut = not info.where("successor > end").isEmpty()  # records that go on in another split, or are cut
    small = info.count() <= MAX_BROADCAST_ROWS
    keys = info.select("file", "split", "base", "entry", "owner")
    rows = _pieces(spark, path).mapInArrow(_placed, "file string, split long, piece binary, at long").join(F.broadcast(keys) if small else keys, ["file", "split"])
    if not small:
        rows = rows.repartition("file", "split").sortWithinPartitions("file", "split", "at")
    schema = f"{_RESULT}, file string, owner long, offset long, piece binary"
    found = rows.mapInArrow(lambda b: _streamed(b, payloads, False), schema).select(*_RESULT_NAMES)
    if not cut:
        return found

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield _result([MAGIC.join(batch.column("parts")[k].as_py())], payloads)

    parts = rows.mapInArrow(lambda b: _streamed(b, payloads, True), schema).where("owner IS NOT NULL")
    parts = parts.groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("offset", "piece"))).alias("all"))
    return found.union(parts.select(F.col("all.piece").alias("parts")).mapInArrow(joined, _RESULT))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    write(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return read(spark, path, payloads=False).drop("payload")


_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(hex, {10 * g + 1}, 10))::BIGINT >> {35 - 5 * k}) & 31) + 1)::INT, 1)" for g in range(4) for k in range(8)
)
ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""
