"""Commands: deidentify, verify, fixture. One JSON document goes to standard output; the exit code tells the status."""

from __future__ import annotations

import argparse
import importlib
import json
import os
import sys
from pathlib import Path

import yaml

from deidflow import rules


def _session():
    from pyspark.sql import SparkSession

    from deidflow.plans.code import ship

    spark = SparkSession.builder.appName("deidflow").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    ship(spark)
    return spark


def _named(name: str):
    """The object of 'module:attribute'."""
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def deidentify(a) -> tuple[dict, int]:
    from deidflow.plans import pipelines
    from deidflow.sources import writers
    from deidflow.streaming import jobs

    if not Path(a.input).is_dir():
        return {"status": "error", "error": "InputError"}, jobs.EXIT["input"]
    override = os.environ.get(rules.OVERRIDE_VARIABLE)
    named = [yaml.safe_load(Path(p).read_text()) or {} for p in [*a.config, *([override] if override else [])]]
    config = rules.load(*(named if override or len(named) > 1 else [*(named or [{}]), rules.COMMAND_OVERLAY]))
    sampling, audited = rules.sampling(config), rules.writes_reports(config)
    actions = rules.actions(config.get("pii_mapping") or rules.PII_ACTIONS)
    reader, model = _named(a.reader), _named(a.model) if a.model else None
    spark, totals = _session(), []
    if a.mode in ("auto", "dicom"):
        run = pipelines.run_dicom(spark, a.input, a.output, reader, model, rules.salt(config), actions, series=a.series, sampling=sampling)
        totals.append(jobs.envelope(run) | {"saved": pipelines.write(run).where("saved").count(), "kind": "dicom"})
        if audited:
            writers.write_report(run.detections, f"{a.output}/reports/pixel_detections.csv")
            writers.write_report(run.tag_actions, f"{a.output}/reports/tag_actions.csv")
    if a.mode in ("auto", "image"):
        run = pipelines.run_images(spark, a.input, a.output, reader, model, rules.salt(config), series=a.series)
        totals.append(jobs.envelope(run) | {"saved": pipelines.write(run).where("saved").count(), "kind": "image"})
    for t in totals:
        rules.conform(t, rules.ENVELOPE)
    found = [t for t in totals if t["files_discovered"]]
    code = max((jobs.exit_code(t) for t in found), default=0)
    return {"runs": totals}, code


#: Findings of the document; all of them go to the folder that ``--out`` names.
FINDINGS_SHOWN = 1000


def verify(a) -> tuple[dict, int]:
    from deidflow.operators import verify as v
    from deidflow.plans.tables import keep
    from deidflow.sources import dicom

    spec = yaml.safe_load(Path(a.checklist).read_text()) if a.checklist else rules.CHECKLIST
    checks = rules.checklist(spec)
    spark = _session()
    elements = dicom.headers(dicom.files(spark, a.run_dir)).where("error IS NULL").drop("error")
    folder = Path(a.run_dir) / "reports"
    reports = {n: spark.read.option("header", "true").csv(str(folder / n)) for n in ("pixel_detections.csv", "tag_actions.csv") if (folder / n).exists()}
    outputs = elements.where("path = '' AND tag = '(0008,0018)'").selectExpr("value AS deid_sop_uid")
    findings = v.file_findings(elements, checks["dicom_checks"]).unionByName(v.run_findings(spark, checks["run_checks"], reports, outputs))
    findings = keep(findings, "findings")  # read three times from here on
    if a.out:
        findings.write.mode("overwrite").option("header", "true").csv(a.out)
    shown = [r.asDict() for r in findings.orderBy("file", "check").limit(FINDINGS_SHOWN).collect()]
    total = v.totals(elements.select("uri").distinct(), checks["dicom_checks"], findings, len(checks["run_checks"])).first().asDict()
    return {"checklist": checks["name"], **total, "findings": shown, "findings_total": findings.count()}, 1 if total["status"] == "fail" else 0


def fixture(a) -> tuple[dict, int]:
    from deidflow.sources import synthetic

    out = Path(a.output)
    out.parent.mkdir(parents=True, exist_ok=True)
    out.write_bytes(synthetic.image_file() if a.output.endswith(".png") else synthetic.dicom_file(a.number, n_frames=a.frames))
    return {"status": "success", "file": str(out)}, 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="deidflow", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    d = commands.add_parser("deidentify")
    d.add_argument("input")
    d.add_argument("output")
    d.add_argument("--mode", choices=("auto", "dicom", "image"), default="auto")
    d.add_argument("--series", action="store_true")
    d.add_argument("--config", action="append", default=[], help="YAML files, later ones laid on earlier ones")
    d.add_argument("--reader", default="deidflow.sources.synthetic:font_reader", help="module:factory of the text reader")
    d.add_argument("--model", default="", help="module:function of the text classifier")
    v = commands.add_parser("verify")
    v.add_argument("run_dir")
    v.add_argument("--checklist", default="")
    v.add_argument("--out", default="", help="folder for all findings as CSV; the document shows the first of them")
    f = commands.add_parser("fixture")
    f.add_argument("output")
    f.add_argument("--number", type=int, default=1)
    f.add_argument("--frames", type=int, default=1)
    a = parser.parse_args(argv)
    try:
        document, code = {"deidentify": deidentify, "verify": verify, "fixture": fixture}[a.command](a)
    except (rules.RuleError, OSError) as e:
        document, code = {"status": "error", "error": type(e).__name__}, 2
    print(json.dumps(document, sort_keys=True, default=str))
    return code


if __name__ == "__main__":
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    sys.exit(main())
