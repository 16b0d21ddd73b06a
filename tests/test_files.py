import os

import numpy as np
import pytest

from deidflow import rules
from deidflow.operators import verify
from deidflow.plans import pipelines
from deidflow.sources import dicom, images, synthetic, writers


def test_codec_roundtrip():
    data = synthetic.dicom_file(7, n_frames=3)
    elements = dicom.parse(data)
    assert dicom.build(elements) == data and len(dicom.frames(elements)) == 3
    assert dicom.value_of(elements, "PatientID") == "SYN-0007" and dicom.value_of(elements, "NumberOfFrames") == "3"
    assert [p for p, e in dicom.walk(elements) if e.tag == dicom.NUMBERS["PatientName"]] == ["", "(0040,0275)[0]"]


@pytest.mark.parametrize("data", [b"", b"\0" * 128 + b"DICM" + b"\x02\0\x10\0UI\xff\xff", synthetic.dicom_file()[:-40]])
def test_damaged_files_raise_one_error(data):
    with pytest.raises(dicom.DicomError):
        dicom.frames(dicom.parse(data))


def test_font_reader_reads_its_font():
    read = synthetic.font_reader()
    assert [t for _, t, _ in read(synthetic.draw([(4, 4, "MRN: 12345"), (4, 30, "A-Z")]))] == ["MRN: 12345", "A-Z"]


def _folder(tmp_path):
    (tmp_path / "in/P1/s").mkdir(parents=True)
    (tmp_path / "in/P1/s/a.dcm").write_bytes(synthetic.dicom_file(1))
    (tmp_path / "in/P1/s/vol").write_bytes(synthetic.dicom_file(2, n_frames=8))
    (tmp_path / "in/P1/bad.dcm").write_bytes(b"\0" * 128 + b"DICMxxxx")
    (tmp_path / "in/P1/us.dcm").write_bytes(synthetic.dicom_file(3, modality="US", regions=[(0, 0, 200, 20)]))
    (tmp_path / "in/P1/notes.txt").write_bytes(synthetic.dicom_file(4))
    return str(tmp_path / "in"), str(tmp_path / "out")


def test_trust_loop(spark, tmp_path):
    source, out = _folder(tmp_path)
    run = pipelines.run_dicom(spark, source, out, synthetic.font_reader, model=lambda texts: [True] * len(texts), salt="s")
    assert {r.route for r in run.outputs.collect()} == {"ok", "error"}
    saved = pipelines.write(run).collect()
    assert len(saved) == 3 and all(r.saved for r in saved)
    checks = rules.checklist(rules.CHECKLIST)["dicom_checks"]
    elements = lambda folder: dicom.headers(dicom.files(spark, folder)).where("error IS NULL").drop("error")
    assert verify.file_findings(elements(out), checks).count() == 0 and verify.file_findings(elements(source), checks).count() > 10
    for name, _, files in ((d, s, f) for d, s, f in os.walk(out)):
        for f in files:
            data = open(os.path.join(name, f), "rb").read()
            assert b"SYNTHETIC" not in data and b"SYN-0" not in data and b"GENERAL HOSPITAL" not in data
            for frame in dicom.frames(dicom.parse(data)):
                assert not frame[24:34].any() and (frame[4:14].any() == ("us" in f))  # a diagnostic area keeps its pixels
    assert "ocr_text" not in run.detections.columns and run.tag_actions.count() > 20


def test_same_salt_same_bytes(spark, tmp_path):
    source, out = _folder(tmp_path)
    contents = []
    for n in ("1", "5"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        run = pipelines.run_dicom(spark, source, out, synthetic.font_reader, model=lambda texts: [True] * len(texts), salt="s")
        contents.append({r.uri: r.content for r in run.outputs.collect()})
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert contents[0] == contents[1]


def test_images_and_writers(spark, tmp_path):
    (tmp_path / "in/Q").mkdir(parents=True)
    (tmp_path / "in/Q/x.png").write_bytes(synthetic.image_file())
    (tmp_path / "in/Q/broken.png").write_bytes(b"no")
    run = pipelines.run_images(spark, str(tmp_path / "in"), str(tmp_path / "out"), synthetic.font_reader, model=lambda t: [True] * len(t), salt="s")
    assert {r.route for r in run.outputs.collect()} == {"ok", "error"}
    assert [r.saved for r in pipelines.write(run).collect()] == [True]
    left = images.read_images(spark, str(tmp_path / "out")).first()
    assert not np.frombuffer(left.bgr, np.uint8).any()
    refused = writers.write_files(spark.createDataFrame([(str(tmp_path / "z"), None)], "path string, content binary")).first()
    assert not refused.saved and not os.path.exists(tmp_path / "z")
    with pytest.raises(ValueError):
        writers.write_phi_report(run.detections, str(tmp_path), str(tmp_path))
    writers.write_report(run.detections.limit(0), str(tmp_path / "rep"))
    assert any(open(tmp_path / "rep" / f).read().startswith("source_path,") for f in os.listdir(tmp_path / "rep") if f.endswith(".csv"))


def test_slices_table(spark, tmp_path):
    source, _ = _folder(tmp_path)
    rows = {r.sop_instance_uid: r for r in dicom.slices(dicom.files(spark, source)).collect()}
    assert set(rows) == {"1.2.3.4.1", "1.2.3.4.2", "1.2.3.4.3"} and rows["1.2.3.4.2"].number_of_frames == 8 and rows["1.2.3.4.1"].image_position_patient == [0.0, 0.0, 1.0]


def test_series_share_what_is_found_on_keyframes(spark, tmp_path):
    (tmp_path / "in/P").mkdir(parents=True)
    for k in range(12):
        lines = [(4, 4, "SECRET NAME")] if k == 0 else [(4, 40, "X")] if k == 1 else []
        (tmp_path / f"in/P/{k:02d}.dcm").write_bytes(synthetic.dicom_file(k + 1, lines=lines))
    run = pipelines.run_dicom(spark, str(tmp_path / "in"), str(tmp_path / "out"), synthetic.font_reader, model=lambda t: [True] * len(t), salt="s", series=True)
    assert {r.volume_frames for r in run.detections.groupBy("decision").count().withColumnRenamed("count", "volume_frames").collect()} == {1}
    left = {r.uri[-6:-4]: dicom.frames(dicom.parse(bytes(r.content)))[0] for r in run.outputs.collect()}
    assert len(left) == 12 and not left["00"].any() and left["01"].any()  # frame 1 is no keyframe; its text stands outside the union


def test_image_series(spark, tmp_path):
    (tmp_path / "in/Q").mkdir(parents=True)
    for k in range(5):
        (tmp_path / f"in/Q/{k}.png").write_bytes(synthetic.image_file([(4, 4, "MRN: 12345")] if k == 0 else [(4, 4, "MRN: 1")]))
    run = pipelines.run_images(spark, str(tmp_path / "in"), str(tmp_path / "out"), synthetic.font_reader, model=lambda t: [True] * len(t), salt="s", series=True)
    assert all(r.saved for r in pipelines.write(run).collect()) and run.detections.count() == 3
    rows = images.read_images(spark, str(tmp_path / "out")).collect()
    assert len(rows) == 5 and not any(np.frombuffer(r.bgr, np.uint8).any() for r in rows)


def test_commands(tmp_path, capsys):
    import json

    from deidflow import cli

    assert cli.main(["fixture", str(tmp_path / "in/P/a.dcm")]) == 0
    assert cli.main(["deidentify", str(tmp_path / "in"), str(tmp_path / "out"), "--mode", "dicom"]) == 0
    assert cli.main(["verify", str(tmp_path / "out")]) == 0
    assert cli.main(["deidentify", str(tmp_path / "none"), str(tmp_path / "out")]) == 2
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert lines[1]["runs"][0]["saved"] == 1 and lines[2]["status"] == "pass"


def _colour_file(planar):
    rgb = np.arange(3 * 4 * 5, dtype=np.uint8).reshape(4, 5, 3)
    raw = (rgb.transpose(2, 0, 1) if planar else rgb).tobytes()
    e = dicom.element
    return rgb, dicom.build([
        e("SOPClassUID", "1.2.3"), e("SOPInstanceUID", "1.2.4"), e("Rows", 4), e("Columns", 5), e("SamplesPerPixel", 3), e("PhotometricInterpretation", "RGB"),
        e("PlanarConfiguration", planar), e("BitsAllocated", 8), e("BitsStored", 8), e("HighBit", 7), e("PixelRepresentation", 0), e("PixelData", raw),
    ])


@pytest.mark.parametrize("planar", [0, 1])
def test_colours_by_plane_or_by_pixel(planar):
    rgb, data = _colour_file(planar)
    (frame,) = dicom.frames(dicom.parse(data))
    assert (frame == rgb).all()
    frame = frame.copy()
    frame[1:3, 2:4] = 0
    new, _ = pipelines.scrubbed_file(data, frame.ravel(), "u", "salt", {}, False)
    elements = dicom.parse(new)
    assert dicom.value_of(elements, "PlanarConfiguration") == "0" and (dicom.frames(elements)[0] == frame).all()


def _implicit(tag, value):
    import struct

    return struct.pack("<HHI", tag >> 16, tag & 0xFFFF, len(value)) + value


def test_unlisted_sequences_and_uids_of_implicit_files_are_scrubbed():
    name, uid = dicom.NUMBERS["PatientName"], b"1.2.840.99999.7\0"
    item = _implicit(name, b"Doe^Jane") + _implicit(0x00080018, uid)
    body = _implicit(0x00080018, b"1.2.3.4\0") + _implicit(0x00321064, _implicit(dicom.ITEM, item)) + _implicit(0x00400555, uid) + _implicit(0x00400556, b"\xfe\xff\x00\xe0junk")
    meta = dicom._written([dicom.Element(dicom.NUMBERS["TransferSyntaxUID"], "UI", dicom.IMPLICIT)])
    data = b"\0" * 128 + b"DICM" + meta + body
    elements = dicom.parse(data)
    assert [p for p, e in dicom.walk(elements) if e.tag == name] == ["(0032,1064)[0]"]
    assert next(e for e in elements if e.tag == 0x00400556).vr == "UN"
    new, audit = pipelines.scrubbed_file(data, None, "u", "salt", {dicom.name(name): "REMOVE"}, False)
    assert b"Doe" not in new and uid[:-1] not in new and ("(0010,0010)", "PatientName", "REMOVE", True) in audit
    assert sum(a[2] == "REMAP" for a in audit) == 3


def test_inputs_by_mode(spark, tmp_path):
    from deidflow.sources import inputs

    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "x.dcm").write_bytes(synthetic.dicom_file(1))
    (tmp_path / "a").write_bytes(synthetic.dicom_file(2))
    (tmp_path / "c.png").write_bytes(images.png(np.zeros((2, 2), np.uint8)))
    (tmp_path / "b" / "a.JPG").write_bytes(b"x")
    (tmp_path / "no.dcm").write_bytes(b"nothing")
    names = lambda mode: [(r.uri.rsplit("/", 1)[1], r.kind) for r in inputs.discover_inputs(spark, f"file://{tmp_path}", mode).collect()]
    both = [("a", "dicom"), ("x.dcm", "dicom"), ("a.JPG", "image"), ("c.png", "image")]
    assert names("auto") == both and names("dicom") == both[:2] and names("image") == both[2:]
    for folder, mode in ((f"file://{tmp_path}", "pdf"), (f"file://{tmp_path}/none", "auto")):
        with pytest.raises(inputs.InputError):
            inputs.discover_inputs(spark, folder, mode)


def _packed(raw):
    """Run-length segments, as plainly as the format allows: repeats of two or more, all else copied byte by byte."""
    out, at = bytearray(), 0
    while at < len(raw):
        n = 1
        while n < 128 and at + n < len(raw) and raw[at + n] == raw[at]:
            n += 1
        out += bytes([257 - n, raw[at]]) if n > 1 else bytes([0, raw[at]])
        at += n
    return bytes(out) + b"\x80" * (len(out) % 2)


def _run_length_file(frames, samples=1):
    import struct

    e, bits = dicom.element, 8 * frames[0].dtype.itemsize
    items = [b""]
    for f in frames:
        planes = f.reshape(-1, samples).T
        segments = [_packed(bytes(p.astype(f.dtype.newbyteorder("<")).tobytes()[k :: bits // 8])) for p in planes for k in reversed(range(bits // 8))]
        starts, at = [], 64
        for seg in segments:
            starts.append(at)
            at += len(seg)
        items.append(struct.pack("<16I", len(segments), *starts, *[0] * (15 - len(starts))) + b"".join(segments))
    body = dicom._written([
        e("SOPClassUID", "1.2.3"), e("SOPInstanceUID", "1.2.4"), e("Rows", frames[0].shape[0]), e("Columns", frames[0].shape[1]), e("SamplesPerPixel", samples), e("PlanarConfiguration", 1),
        e("PhotometricInterpretation", "RGB" if samples == 3 else "MONOCHROME2"), e("BitsAllocated", bits), e("BitsStored", bits), e("HighBit", bits - 1), e("PixelRepresentation", 0), e("NumberOfFrames", len(frames)),
    ])
    pixels = struct.pack("<HH2sHI", 0x7FE0, 0x10, b"OB", 0, 0xFFFFFFFF) + b"".join(struct.pack("<HHI", 0xFFFE, 0xE000, len(i)) + i for i in items) + struct.pack("<HHI", 0xFFFE, 0xE0DD, 0)
    return b"\0" * 128 + b"DICM" + dicom._written([dicom.Element(dicom.NUMBERS["TransferSyntaxUID"], "UI", dicom.RUN_LENGTH)]) + body + pixels


@pytest.mark.parametrize("kind,samples", [(np.uint8, 1), (np.uint16, 1), (np.uint8, 3)])
def test_run_length_pixels(kind, samples):
    rng = np.random.default_rng(3)
    frames = [(rng.integers(0, 4, (9, 7, samples)[: 2 + (samples > 1)]) * 90).astype(kind) for _ in range(2)]
    frames[1][2:5] = 77
    data = _run_length_file(frames, samples)
    got = dicom.frames(dicom.parse(data))
    assert len(got) == 2 and all((a == b).all() and a.dtype == kind for a, b in zip(got, frames))
    new, _ = pipelines.scrubbed_file(data, np.concatenate([f.reshape(-1) for f in got]), "u", "salt", {}, False)
    again = dicom.parse(new)
    assert all((a == b).all() for a, b in zip(dicom.frames(again), frames)) and dicom.value_of(again, "TransferSyntaxUID") == dicom.EXPLICIT
    for cut in (len(data) - 9, len(data) - 40):
        with pytest.raises(dicom.DicomError):
            dicom.frames(dicom.parse(data[:cut]))


def test_diff_masks_spare_what_is_dark_on_the_keyframe(spark, tmp_path):
    (tmp_path / "in/P").mkdir(parents=True)
    (tmp_path / "in/P/a.dcm").write_bytes(synthetic.dicom_file(1, n_frames=4))
    model = lambda texts: [True] * len(texts)
    before = dicom.frames(dicom.parse(synthetic.dicom_file(1, n_frames=4)))
    run = pipelines.run_dicom(spark, str(tmp_path / "in"), str(tmp_path / "out"), synthetic.font_reader, model, salt="s", mask_mode="diff")
    assert run.detections.count() > 0
    (row,) = run.outputs.collect()
    assert row.error is None and row.error_stage is None
    assert all(not f[b > 200].any() for f, b in zip(dicom.frames(dicom.parse(bytes(row.content))), before))
    with pytest.raises(rules.RuleError):
        pipelines.run_dicom(spark, str(tmp_path / "in"), str(tmp_path / "out"), synthetic.font_reader, model, salt="s", mask_mode="diff", series=True)


def test_series_share_ultrasound_regions_unless_switched_off(spark, tmp_path):
    (tmp_path / "in/P").mkdir(parents=True)
    for k in range(2):
        (tmp_path / f"in/P/{k}.dcm").write_bytes(synthetic.dicom_file(k + 1, modality="US", regions=[(0, 0, 200, 20)] if k else ()))
    left = {}
    for us in (True, False):
        run = pipelines.run_dicom(spark, str(tmp_path / "in"), str(tmp_path / "out"), synthetic.font_reader, lambda t: [True] * len(t), salt="s", series=True, us=us)
        left[us] = [dicom.frames(dicom.parse(bytes(r.content)))[0] for r in run.outputs.orderBy("uri").collect()]
    assert all(f[4:14].any() and not f[24:34].any() for f in left[True]) and not any(f[:34].any() for f in left[False])


def test_errors_name_their_stage(spark, tmp_path):
    source, out = _folder(tmp_path)

    def broken():
        def read(frame):
            raise OSError("the reader")

        return read

    run = pipelines.run_dicom(spark, source, out, broken, salt="s")
    assert {(r.uri.rsplit("/", 1)[1], r.error, r.error_stage, r.route) for r in run.outputs.collect()} == {
        ("a.dcm", "OSError", "detect", "error"), ("vol", "OSError", "detect", "error"), ("us.dcm", "OSError", "detect", "error"), ("bad.dcm", "no native pixels", "read", "error")
    }


def test_frames_of_good_and_bad_files_share_a_batch(spark):
    rows = [("a", bytearray(synthetic.dicom_file(1, n_frames=3))), ("b", bytearray(b"\0" * 128 + b"DICMxxxx")), ("c", bytearray(synthetic.dicom_file(2)))]
    got = sorted((r.uri, r.frame_index, r.n_frames, r.error) for r in dicom.frame_rows(spark.createDataFrame(rows, "uri string, content binary").coalesce(1)).collect())
    assert got == [("a", 0, 3, None), ("a", 1, 3, None), ("a", 2, 3, None), ("b", None, None, "no native pixels"), ("c", 0, 1, None)]
