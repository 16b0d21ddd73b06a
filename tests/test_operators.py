import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from deidflow import rules
from deidflow.operators import headers, measures, pixels, redact, reports, series, verify
from deidflow.plans import queries


def test_series_order_falls_back(spark):
    rows = [("a", "u2", 5.0, 1), ("a", "u1", 1.0, 2), ("b", "u1", None, 2), ("b", "u2", 3.0, 1), ("c", "u2", None, None), ("c", "u1", 1.0, 1)]
    df = spark.createDataFrame(rows, "s string, uri string, z double, instance_number int")
    got = {(r.s, r.uri): r.frame_index for r in series.order(df, ("s",)).collect()}
    assert got == {("a", "u1"): 0, ("a", "u2"): 1, ("b", "u2"): 0, ("b", "u1"): 1, ("c", "u1"): 0, ("c", "u2"): 1}


def test_series_split_and_folders(spark):
    df = spark.createDataFrame([("s", 1.0), ("s", None), ("s", None)], "k string, g double")
    assert sorted(r.n_slices for r in series.group(df, ("k",), ("g",)).collect()) == [1, 2]
    paths = spark.createDataFrame([("/r/a.png",), ("/r/x/b.png",), ("/r/x/c.png",)], "path string")
    assert {r.series_key for r in series.folders(paths, "/r").collect()} == {"/r/a.png", "/r/x"}


def test_union_area_equals_numpy(spark):
    rng = np.random.default_rng(3)
    boxes = [(int(k), *map(int, rng.integers(-5, 60, 2)), *map(int, rng.integers(0, 30, 2))) for k in rng.integers(0, 4, 40)]
    df = spark.createDataFrame(boxes, "k int, x int, y int, w int, h int")
    got = {r.k: r.pixels for r in pixels.union_area(pixels.clamped(df, 64, 48), "k", 64).collect()}
    for k in {b[0] for b in boxes}:
        mask = np.zeros((48, 64), bool)
        for _, x, y, w, h in (b for b in boxes if b[0] == k):
            mask[max(0, y) : max(0, y + h), max(0, x) : max(0, x + w)] = True
        assert got.get(k, 0) == mask.sum()


def _elements(spark):
    rows = [
        ("f", "", "(0010,0010)", "PatientName", "PN", "A^B"), ("f", "(0040,0275)[0]", "(0010,0010)", "PatientName", "PN", "A^B"), ("f", "", "(0010,0030)", "PatientBirthDate", "DA", "19000101"),
        ("f", "", "(0009,1001)", None, "LO", "x"), ("f", "(0009,1002)[0]", "(0010,0020)", "PatientID", "LO", "1"), ("f", "", "(0008,0018)", "SOPInstanceUID", "UI", "1.2.3"),
        ("f", "", "(0002,0003)", "MediaStorageSOPInstanceUID", "UI", "1.2.3"), ("f", "", "(0008,0016)", "SOPClassUID", "UI", "1.2.840.10008.1"), ("f", "", "(0008,0020)", "StudyDate", "DA", "20200101"),
    ]
    return spark.createDataFrame(rows, "uri string, path string, tag string, keyword string, vr string, value string")


def test_scrub_attest_verify(spark):
    raw = _elements(spark)
    checks = rules.checklist(rules.CHECKLIST)["dicom_checks"]
    scrubbed = headers.scrub(raw, rules.PII_ACTIONS, "s")
    out = {(r.path, r.tag): r.value for r in headers.output(scrubbed).collect()}
    assert out[("", "(0010,0010)")] == out[("(0040,0275)[0]", "(0010,0010)")] and out[("", "(0010,0010)")].startswith("TOKEN_")
    assert ("", "(0010,0030)") not in out and not any("(0009" in p + t for p, t in out) and out[("", "(0008,0018)")] == out[("", "(0002,0003)")] != "1.2.3"
    assert out[("", "(0008,0020)")] == "" and out[("", "(0008,0016)")] == "1.2.840.10008.1"
    assert {r.action for r in headers.audit(scrubbed).collect()} == {"DUMMY", "REMOVE", "ZERO", "REMAP"}
    done = headers.attest(headers.output(scrubbed), raw.select("uri").distinct())
    assert verify.file_findings(done, checks).count() == 0 and verify.file_findings(raw, checks).count() > 5
    assert verify.verdict(verify.file_findings(done, checks)).first().status == "pass"
    counts = headers.diff(raw.where("path = ''"), headers.output(scrubbed).where("path = ''")).first()
    assert (counts.removed, counts.private_removed, counts.dummied, counts.zeroed) == (1, 1, 1, 1)


def test_run_checks(spark):
    checks = rules.checklist(rules.CHECKLIST)["run_checks"]
    report = spark.createDataFrame([("u1",)], "deid_sop_uid string")
    outputs = spark.createDataFrame([("u1",), ("u2",)], "deid_sop_uid string")
    bad = {r.check for r in verify.run_findings(spark, checks, {"tag_actions.csv": report}, outputs).collect()}
    assert bad == {"pixel-report-present", "outputs-accounted-in-tag-report"}


def test_merge_is_idempotent_and_drops_sources_without_rows(spark):
    old, new = (spark.createDataFrame(r, "source_path string, k int") for r in ([("a", 1), ("b", 1), ("c", 1)], [("a", 2)]))
    ran = spark.createDataFrame([("a",), ("c",)], "source_path string")
    once = reports.merge(old, new, ran)
    want = {("a", 2), ("b", 1)}
    assert {tuple(r) for r in once.collect()} == want == {tuple(r) for r in reports.merge(once, new, ran).collect()}


def test_attribution_falls_back_to_the_first_slice(spark):
    slices = spark.createDataFrame([("s", 0, "p0", "o0", "d0"), ("s", 1, "p1", "o1", "d1")], "series_key string, frame_index int, source_path string, original_sop_uid string, deid_sop_uid string")
    det = spark.createDataFrame([("s", 1), ("s", 9), ("s", None)], "series_key string, frame_index int")
    assert sorted(r.source_path for r in reports.attribute(det, slices).collect()) == ["p0", "p0", "p1"]


def test_envelope_status(spark):
    schema = "status string, pixel_regions_detected long, redacted long, safelisted long, low_confidence long, header_tags_scrubbed long, needs_manual_review boolean"
    rows = lambda *s: spark.createDataFrame([(x, 2, 1, 0, 1, 3, True) for x in s], schema)
    assert [reports.envelope(rows(*s)).first().status for s in (("processed",), ("processed", "failed"), ("failed",), ())] == ["success", "partial", "error", "success"]
    assert reports.envelope(rows("processed", "failed")).first().redacted == 1


@pytest.mark.parametrize("toxic, lang", [([1, 1, 1], "en"), ([1, 0, 0], "en"), ([1, 0, 0], None), ([1, 1, 0], None)])
def test_envelope_totals_as_in_sql(spark, tmp_path, toxic, lang):
    """Also when every file failed, and with documents that have no path."""
    langs = ["de", "fr", lang]
    spark.createDataFrame([(k, f"t{k}", "web", x) for k, x in enumerate(langs)], "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, x) for k, x in enumerate(toxic)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    assert [tuple(r) for r in queries.Q["envelope_totals"](spark, str(tmp_path)).collect()] == con.execute(queries.O["envelope_totals"]).fetchall()


def test_envelope_without_processed_files_has_zeros(spark):
    schema = "status string, pixel_regions_detected long, redacted long, safelisted long, low_confidence long, header_tags_scrubbed long, needs_manual_review boolean"
    for rows, status in ([("failed", 2, 1, 0, 1, 3, True)], "error"), ([], "success"):
        assert tuple(reports.envelope(spark.createDataFrame(rows, schema)).first()) == (len(rows), 0, len(rows), 0, 0, 0, 0, 0, False, status)


def test_reports_refuse_text(spark):
    with pytest.raises(rules.RuleError):
        reports.pixel_report(spark.createDataFrame([("x",)], "ocr_text string"))


def test_quality_and_bench(spark):
    q = measures.phi_quality(F.lit(0), F.lit(0))
    assert [spark.range(1).select(q[k]).first()[0] for k in ("precision", "recall", "f1")] == [0, 0, 0]
    r = measures.bench_summary(spark.createDataFrame([(1.0, True), (3.0, True), (9.0, False)], "seconds double, ok boolean")).first()
    assert (r.n_runs, r.n_ok, r.mean, r.std) == (3, 2, 2.0, 1.0)


def test_blank_clamps_and_model_errors_count_as_phi(spark):
    frame = np.full((8, 8), 9, np.uint8)
    assert (redact.blank(frame, [(-2, -2, 4, 4), (6, 6, 9, 9)]) == 0).sum() == 8
    raw = spark.createDataFrame([("u", 0, [[0.0, 0.0], [4.0, 4.0]], "John Doe", 0.9, None)], redact.DETECTION)

    def broken(texts):
        raise RuntimeError

    assert redact.decide(raw, broken).first().decision == "redacted"


def test_tables(spark, tmp_path):
    from deidflow.sources import tables

    (tmp_path / "t.csv").write_text("file_path,text,x_min,y_min,x_max,y_max,is_phi,phi_type\na/.//b.png,Doe,1,2,5,9,TRUE,NAME\nc.png,x,0,0,1,1,yes,\n")
    rows = {r.file_path: r for r in tables.ground_truth(spark, str(tmp_path / "t.csv")).collect()}
    assert (rows["a/b.png"].w, rows["a/b.png"].h, rows["a/b.png"].is_phi, rows["c.png"].is_phi) == (4, 7, True, False)
    assert tables.ground_truth(spark, str(tmp_path / "none.csv")).count() == 0 and tables.tag_report(spark, str(tmp_path / "none")).columns == list(rules.TAG_COLUMNS)
    (tmp_path / "job-1.json").write_text('{"a": 1}')
    assert tables.latest_summary(spark, str(tmp_path)).first().summary == '{"a": 1}'
