import base64
import hashlib

import pytest

from deidflow.llm import warc

FALSE = "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\nWARC/1.1\r\n"
ROWS = [
    (0, "http://a/WARC/1.1", "WARC/1.1\r\n"), (1, "u v\n", FALSE), (2, "u", FALSE * 30), (3, "u", FALSE), (4, "u", "x" * 200_000 + FALSE + "y"), (5, "u", ""), (6, None, None), (7, "u", "\r\n\r\n\r\n"),
    (None, "u", "zz"), (8, "u", "zz"), (9, "u", "é" * 1000), *((20 + k, f"http://p/{k}", f"<p>{k % 7}</p>") for k in range(60)),
]


@pytest.mark.parametrize("split", ["64m", "20k"])
def test_roundtrip(spark, tmp_path, split):
    first: dict = {}
    for i, _, h in sorted((r for r in ROWS if r[0] is not None), key=lambda r: r[0]):
        first.setdefault((h or ""), i)
    df = spark.createDataFrame([(*r, "q") for r in ROWS], "page_id long, url string, html string, record_type string").repartition(2)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    warc.write(df, f"file://{tmp_path}/w")
    got = {r.page_id: r for r in warc.read(spark, f"file://{tmp_path}/w").collect()}
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == len(ROWS)
    for i, _, h in ROWS:
        raw, r = (h or "").encode(), got[i]
        original = i is None or first[h or ""] == i
        assert (r.payload_bytes, r.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        assert (r.record_type, r.refers_to) == (("response", None) if original else ("revisit", first[h or ""]))
        assert not original or bytes(r.payload) == raw


def test_pointer_jumping(spark):
    chain = [("f", k, k + 1) for k in range(37)] + [("f", 100, 5), ("f", 37, None), ("g", 3, 4), ("g", 0, 3)]
    got = {tuple(r) for r in warc.reachable(spark.createDataFrame(chain, "file string, offset long, successor long")).collect()}
    assert got == {("f", k) for k in range(37)} | {("g", 0), ("g", 3)}


def test_empty_table(spark, tmp_path):
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), f"file://{tmp_path}/w")
    assert warc.read(spark, f"file://{tmp_path}/w").count() == 0


def test_a_header_longer_than_64_kb(spark, tmp_path):
    rows = [(1, "http://a/" + "x" * 700_000, "first"), (2, "u", "second"), (3, "http://b/" + "y" * 70_000, "third" * 30_000), (4, "u", "fourth")]
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), f"file://{tmp_path}/w")
    got = {r.page_id: bytes(r.payload).decode() for r in warc.read(spark, f"file://{tmp_path}/w").collect()}
    assert got == {i: h for i, _, h in rows}


def by_rule(rows):
    """(page_id, payload, type, refers_to) of each row as the contract says."""
    out, firsts = [], {}
    for i, u, h in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or "")):
        firsts.setdefault(h or "", i)
    used = set()
    for i, u, h in sorted(rows, key=lambda r: (r[1] is not None, r[1] or "")):
        h = h or ""
        original = i is None or (firsts[h] == i and h not in used)
        if i is not None and original:
            used.add(h)
        out.append((i, len(h.encode()), "response" if original else "revisit", None if original else firsts[h]))
    return sorted(out, key=str)


def test_repeated_ids_and_rows(spark, tmp_path):
    rows = [(3, "a", "A"), (7, "b", "A"), (7, "c", "BBBBBB"), (5, "d", "same"), (5, "d", "same"), (5, None, "same"), (5, "e", "same"), (9, "f", "same"), (7, "c", "BBBBBB"), (None, "g", "same"), (2, "h", None), (2, "h", None)]
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), f"file://{tmp_path}/w")
    found = warc.read(spark, f"file://{tmp_path}/w").collect()
    assert sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in found), key=str) == by_rule(rows)
    assert {bytes(r.payload).decode() for r in found if r.record_type == "response"} == {"A", "BBBBBB", "same", ""}


def test_a_chain_that_ends_early_is_an_error(spark, tmp_path):
    rows = [(k, "u", f"page {k}") for k in range(6)]
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), f"file://{tmp_path}/w")
    part = next((tmp_path / "w").glob("part-*"))
    data = part.read_bytes()
    for crc in (tmp_path / "w").glob(".*.crc"):
        crc.unlink()
    broken = data.split(b"WARC/1.1\r\n")
    broken[3] = broken[3].replace(b"msgtype=response\r\nContent-Length: ", b"msgtype=response\r\nContent-Length: 9", 1)
    part.write_bytes(b"WARC/1.1\r\n".join(broken))
    with pytest.raises(warc.BrokenChain):
        warc.read(spark, f"file://{tmp_path}/w").count()
    assert warc.read(spark, f"file://{tmp_path}/w", strict=False).where("page_id < 2").count() == 2


def test_chains_inside_a_split():
    import numpy as np

    at, successor = np.array([0, 10, 15, 30, 50]), np.array([10, 30, 17, 50, 99])
    leaves, tail = warc.follow(at, successor)
    assert leaves.tolist() == [99, 99, 17, 99, 99] and tail.tolist() == [50, 50, 15, 50, 50]
    assert [x.tolist() for x in warc.follow(at[:0], successor[:0])] == [[], []]


@pytest.mark.parametrize("split", ["3k", "64m"])
def test_records_over_many_splits(spark, tmp_path, split):
    rows = [(k, "u", f"{k} " + FALSE * (200 if k % 3 == 0 else 1) + "z" * (9000 if k % 4 == 1 else 3)) for k in range(12)]
    warc.write(spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, offset string, owner int").coalesce(1), f"file://{tmp_path}/w")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    got = {r.page_id: bytes(r.payload).decode() for r in warc.read(spark, f"file://{tmp_path}/w").collect()}
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {i: h for i, _, h in rows}
