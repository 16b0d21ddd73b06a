import time

from deidflow.sources import dicom, synthetic
from deidflow.streaming import ingest, jobs


def test_new_files_come_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    seen = []
    for n in (1, 2):
        (tmp_path / f"in/{n}.dcm").write_bytes(synthetic.dicom_file(n))
        (tmp_path / f"in/{n}.txt").write_bytes(b"no")
        ingest.run_available(ingest.new_files(spark, str(tmp_path / "in")), str(tmp_path / "state"), lambda df, _: seen.extend(r.uri for r in df.select("uri").collect()))
    assert [u.rsplit("/", 1)[1] for u in seen] == ["1.dcm", "2.dcm"]


def test_report_table_is_idempotent(spark, tmp_path):
    table = ingest.ReportTable(spark, str(tmp_path / "t"))
    rows = lambda *r: spark.createDataFrame(list(r), "source_path string, k int")
    table.merge(rows(("a", 1), ("b", 1)), 0)
    for _ in range(2):
        table.merge(rows(("a", 2)), 1)
    assert sorted(map(tuple, table.read(1).collect())) == [("a", 2), ("b", 1)]


def test_jobs(spark, tmp_path):
    (tmp_path / "in/P").mkdir(parents=True)
    (tmp_path / "out").mkdir()
    (tmp_path / "in/P/a.dcm").write_bytes(synthetic.dicom_file(1))
    (tmp_path / "in/P/bad").write_bytes(b"\0" * 128 + b"DICM...")
    server = jobs.Jobs()
    job = server.start(spark, str(tmp_path / "in"), str(tmp_path / "out"), synthetic.font_reader, lambda t: [True] * len(t), "s")
    for _ in range(600):
        if (state := server.status(job))["state"] in ("completed", "failed"):
            break
        time.sleep(0.1)
    assert state["state"] == "completed" and state["totals"]["files_processed"] == 1 and state["totals"]["files_failed"] == 1 and state["totals"]["status"] == "partial"
    assert jobs.exit_code(state["totals"]) == 3 and len(list((tmp_path / "out").glob("job-*.json"))) == 1 and server.status("x")["status"] == "error"
    assert dicom.files(spark, str(tmp_path / "out")).count() == 1


def test_tools(spark, tmp_path):
    from deidflow.sources import images
    from deidflow.streaming import tools

    (tmp_path / "in/P").mkdir(parents=True)
    (tmp_path / "review/a").mkdir(parents=True)
    for name in ("b.dcm", "a/a.dcm", ".hidden"):
        (tmp_path / "review" / name).write_bytes(b"x")
    (tmp_path / "in/P/a.dcm").write_bytes(synthetic.dicom_file(1))
    (tmp_path / "in/P/b.png").write_bytes(synthetic.image_file())
    t = tools.Tools(spark, synthetic.font_reader, lambda texts: [True] * len(texts), "s", str(tmp_path / "review"))
    assert t.warm_up()["status"] == "success"
    assert t.list_review_queue() == {"status": "success", "count": 2, "files": ["a.dcm", "b.dcm"], "truncated": False}
    one = t.deidentify_file(str(tmp_path / "in/P/a.dcm"), str(tmp_path / "one"))
    assert one["status"] == "success" and one["saved"] == 1 and one["redacted"] == 2
    started = t.start_batch_job(str(tmp_path / "in"), str(tmp_path / "out"))
    for _ in range(600):
        if (state := t.get_job_status(started["job_id"]))["state"] in ("completed", "failed"):
            break
        time.sleep(0.1)
    assert state["state"] == "completed" and state["totals"]["files_processed"] == 2 and state["totals"]["saved"] == 2
    assert images.read_images(spark, str(tmp_path / "out")).count() == 1
    whole, part = t.summarize_run(str(tmp_path / "out")), t.summarize_run(str(tmp_path / "out"), "a.dcm")
    assert whole["files_with_detections"] == 2 and whole["regions_by_decision"] == {"redacted": 3} and part["pixel_regions_total"] == 2
    assert part["header_audit"] and "text" not in str(part) and sum(part["tags_by_action"].values()) == sum(whole["tags_by_action"].values())
    import shutil

    shutil.rmtree(tmp_path / "out/reports")
    again = t.summarize_run(str(tmp_path / "out"))
    assert again["source"] == f"job-{started['job_id']}.json" and again["pixel_regions_total"] == 3 and again["files_with_detections"] == 2
    for bad in (t.summarize_run(str(tmp_path / "none")), t.summarize_run(str(tmp_path / "out"), "z.dcm"), t.deidentify_file("/none", "/none"), t.start_batch_job(str(tmp_path), "x", "pdf"), t.get_job_status("x")):
        assert bad["status"] == "error"
