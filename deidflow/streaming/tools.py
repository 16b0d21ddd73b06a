"""The tools that a server offers on runs: each takes plain values and gives a JSON-able document without personal data."""

from __future__ import annotations

import functools
import time
from collections.abc import Callable
from pathlib import Path
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from deidflow import rules
from deidflow.operators import redact, reports
from deidflow.sources import tables
from deidflow.sources.inputs import InputError
from deidflow.streaming import jobs

AUDIT_SHOWN, QUEUE_SHOWN = 30, 50


def _document(tool: Callable[..., dict[str, Any]]) -> Callable[..., dict[str, Any]]:
    """A failure is a document too; it names the error's class only, as messages might hold content."""

    @functools.wraps(tool)
    def run(*args: Any, **named: Any) -> dict[str, Any]:
        try:
            return {"status": "success"} | tool(*args, **named)
        except Exception as e:  # noqa: BLE001
            return {"status": "error", "error": type(e).__name__}

    return run


class Tools:
    """Six tools over one session, reader and model; ``review_dir`` holds the files that wait for people."""

    def __init__(self, spark: SparkSession, reader: Callable[[], redact.Reader], model=None, salt: str | None = None, review_dir: str = "") -> None:
        self.spark, self.reader, self.model, self.salt, self.review_dir = spark, reader, model, salt or rules.salt(), review_dir
        self.jobs = jobs.Jobs()

    @_document
    def warm_up(self) -> dict[str, Any]:
        """Make the reader and ask the model once, so that a missing model shows before any file is read."""
        started = time.monotonic()
        self.reader()
        if self.model is not None:
            self.model(["warm up"])
        return {"elapsed_seconds": round(time.monotonic() - started, 1)}

    @_document
    def deidentify_file(self, path: str, output_dir: str) -> dict[str, Any]:
        """One file, by its own kind."""
        if not Path(path).is_file():
            raise FileNotFoundError(path)
        mode = "image" if Path(path).suffix.lower() in (".png", ".jpg", ".jpeg") else "dicom"
        totals = jobs.run_mode(self.spark, path, output_dir, mode, self.reader, self.model, self.salt)[0]
        return totals | {"output_dir": output_dir}

    @_document
    def start_batch_job(self, input_dir: str, output_dir: str, mode: str = "auto") -> dict[str, Any]:
        return {"job_id": self.jobs.start(self.spark, input_dir, output_dir, self.reader, self.model, self.salt, mode), "mode": mode}

    def get_job_status(self, job_id: str) -> dict[str, Any]:
        return self.jobs.status(job_id)

    @_document
    def summarize_run(self, run_dir: str, source: str = "") -> dict[str, Any]:
        """Totals of a finished run from its reports, else from its newest job; ``source``: only files whose path ends so, with header actions."""
        if not Path(run_dir).is_dir():
            raise InputError("no such run folder")
        names = [f"{run_dir}/reports/{n}" for n in ("pixel_detections.csv", "tag_actions.csv")]
        if not any(Path(n).exists() for n in names):
            return self._from_job(run_dir, source)
        found, tags = tables.pixel_report(self.spark, names[0]), tables.tag_report(self.spark, names[1])
        if source:
            found, tags = (reports.by_source_name(t, source) for t in (found, tags))
        row = reports.run_summary(found).first().asDict()
        out = {
            "source": "reports", "files_with_detections": row["files_with_detections"], "pixel_regions_total": row["regions"],
            "regions_by_decision": {d: row[d] for d in rules.DECISIONS if row[d]}, "tags_by_action": {r.action: r.n_tags for r in reports.tags_by_action(tags).collect()},
        }
        if source:
            n = sum(out["tags_by_action"].values())
            if not n and not row["regions"]:
                raise FileNotFoundError("no records of such a file")
            out |= {"header_audit": [{"keyword": r.keyword, "action": r.action} for r in reports.header_audit(tags, AUDIT_SHOWN).collect()], "header_audit_truncated": n > AUDIT_SHOWN}
        return out

    def _from_job(self, run_dir: str, source: str) -> dict[str, Any]:
        newest = tables.latest_summary(self.spark, run_dir).first()
        if newest is None:
            raise FileNotFoundError("neither reports nor a job summary")
        files = self.spark.read.schema(jobs.FILE_ENTRY).json(newest.path.removesuffix(".json") + "-files")
        if source:
            files = reports.by_source_name(files, source)
        sums = files.agg(
            F.count("*").alias("n"), F.count_if(F.col("pixel_regions_detected") > 0).alias("hit"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("pixel_regions_detected", *rules.DECISIONS, "header_tags_scrubbed"))
        ).first()
        if source and not sums.n:
            raise FileNotFoundError("no records of such a file")
        return {
            "source": newest.path.rsplit("/", 1)[1], "files_with_detections": sums.hit, "pixel_regions_total": sums.pixel_regions_detected,
            "regions_by_decision": {d: sums[d] for d in rules.DECISIONS if sums[d]}, "header_tags_scrubbed": sums.header_tags_scrubbed,
        }

    @_document
    def list_review_queue(self) -> dict[str, Any]:
        """Names only, never contents; a folder that is not there is an empty queue."""
        if not self.review_dir or not Path(self.review_dir).is_dir():
            return {"count": 0, "files": [], "truncated": False}
        seen = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(self.review_dir)
        first, total = reports.review_queue(seen.select(F.regexp_extract("path", r"[^/]*$", 0).alias("name")), QUEUE_SHOWN)
        row = total.first()
        return {"count": row.total, "files": [r.name for r in first.collect()], "truncated": row.truncated}
