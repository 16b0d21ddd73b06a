"""Batch jobs with a state that can be asked for, and their summaries."""

from __future__ import annotations

import functools
import json
import threading
import uuid
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deidflow import rules
from deidflow.operators import reports
from deidflow.plans import pipelines
from deidflow.plans.tables import keep
from deidflow.sources import writers
from deidflow.sources.inputs import MODES, InputError

ERRORS_SHOWN = 10
#: Exit codes of a run's status.
EXIT = {"success": 0, "error": 1, "input": 2, "partial": 3, "review": 4}


@dataclass
class Job:
    job_id: str
    input_dir: str
    output_dir: str
    mode: str = "auto"
    state: str = "queued"
    totals: dict[str, Any] = field(default_factory=dict)
    errors: list[str] = field(default_factory=list)


class Jobs:
    """Runs one job at a time in the background, as one set of models serves all."""

    def __init__(self) -> None:
        self._jobs: dict[str, Job] = {}
        self._lock, self._one = threading.Lock(), threading.Lock()

    def start(self, spark, input_dir: str, output_dir: str, reader, model=None, salt: str | None = None, mode: str = "auto") -> str:
        if mode not in MODES:
            raise InputError(f"mode {mode!r} is none of {', '.join(MODES)}")
        if not Path(input_dir).is_dir():
            raise FileNotFoundError("no such input folder")
        job = Job(uuid.uuid4().hex[:12], input_dir, output_dir, mode)
        with self._lock:
            self._jobs[job.job_id] = job
        threading.Thread(target=self._work, args=(job, spark, reader, model, salt), daemon=True).start()
        return job.job_id

    def _work(self, job: Job, spark, reader, model, salt) -> None:
        with self._one:
            job.state = "running"
            try:
                job.totals, files, errors = run_mode(spark, job.input_dir, job.output_dir, job.mode, reader, model, salt)
                job.errors = [f"{Path(r.source_path).name}: {r.error}" for r in errors.orderBy("source_path").limit(ERRORS_SHOWN).collect()]
                target = Path(job.output_dir, f"job-{job.job_id}")
                files.write.json(f"{target}-files")
                Path(f"{target}.json").write_text(json.dumps({"job_id": job.job_id, "mode": job.mode, **job.totals}, sort_keys=True))
                job.state = "completed"
            except Exception as e:  # noqa: BLE001  a job's failure is its state; the message might hold content
                job.state, job.errors = "failed", [type(e).__name__]

    def status(self, job_id: str) -> dict[str, Any]:
        with self._lock:
            job = self._jobs.get(job_id)
            if job is None:
                return {"status": "error", "error": "KeyError", "known_jobs": sorted(self._jobs)}
            return {"status": "success", "job_id": job.job_id, "state": job.state, "totals": dict(job.totals), "errors": list(job.errors)}


#: A file of a job: its path, status and counts.
FILE_ENTRY = f"source_path string, status string, pixel_regions_detected long, {', '.join(f'{d} long' for d in rules.DECISIONS)}, header_tags_scrubbed long, needs_manual_review boolean"


def run_mode(spark, input_dir: str, output_dir: str, mode: str, reader, model=None, salt: str | None = None) -> tuple[dict[str, Any], DataFrame, DataFrame]:
    """Run, write files and reports; the totals over both kinds of input, the entry of each file, and the errors."""
    runs = []
    if mode != "image":
        runs.append(pipelines.run_dicom(spark, input_dir, output_dir, reader, model, salt))
    if mode != "dicom":
        runs.append(pipelines.run_images(spark, input_dir, output_dir, reader, model, salt))
    saved = sum(pipelines.write(run).where("saved").count() for run in runs)
    union = lambda parts: functools.reduce(DataFrame.unionByName, parts)
    writers.write_report(union([r.detections for r in runs]), f"{output_dir}/reports/pixel_detections.csv")
    if mode != "image":
        writers.write_report(runs[0].tag_actions, f"{output_dir}/reports/tag_actions.csv")
    files = keep(union([file_rows(r) for r in runs]), "job-files")
    errors = union([r.outputs.where("error IS NOT NULL").select(F.col("uri").alias("source_path"), "error") for r in runs])
    return reports.envelope(files).first().asDict() | {"saved": saved}, files, errors


def file_rows(run: pipelines.Run) -> DataFrame:
    """The entry of each file of a run, without personal data."""
    tags = run.tag_actions if run.tag_actions is not None else run.detections.limit(0).select("source_path", F.lit(False).alias("redacted"))
    status = F.when(F.col("error").isNull(), "processed").otherwise("failed")
    return run.outputs.select(F.col("uri").alias("source_path"), status.alias("status")).join(reports.file_entries(run.detections, tags), "source_path", "left").fillna(0).fillna(False)


def envelope(run: pipelines.Run) -> dict[str, Any]:
    """The totals of a run, without personal data."""
    return reports.envelope(file_rows(run)).first().asDict()


def exit_code(totals: dict[str, Any]) -> int:
    if totals["status"] == "success" and totals["needs_manual_review"]:
        return EXIT["review"]
    return EXIT[totals["status"]]
