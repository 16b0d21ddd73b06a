"""Checks of outputs against a checklist."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deidflow import rules
from deidflow.operators.headers import is_private


def facts(elements: DataFrame, key: str = "uri") -> DataFrame:
    """Per file: its top-level tags as a map, private elements, foreign UIDs by root are left to the check, and UID pair."""
    top = F.col("path") == ""
    value = lambda t: F.max(F.when(top & (F.col("tag") == t), F.coalesce("value", F.lit(""))))
    return elements.groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.when(top & ~is_private(F.col("tag")), F.struct("tag", F.coalesce("value", F.lit("")).alias("value"))))).alias("tags"),
        F.count_if(is_private(F.col("tag"))).alias("private"), value("(0002,0003)").alias("media_sop"), value("(0008,0018)").alias("sop"),
        F.collect_set(F.when((F.col("vr") == "UI") & ~F.coalesce("keyword", F.lit("")).isin(*rules.CLASS_UID_KEYWORDS) & (F.trim("value") != "") & ~F.col("value").startswith(rules.STANDARD_UID_ROOT), F.col("value"))).alias("uids"),
    )


def passes(check: dict) -> Column:
    """Whether a file's facts pass one check; details never show values."""
    kind, at = check["type"], F.try_element_at("tags", F.lit(check.get("tag", "")))
    if kind == "tag_present":
        return at.isNotNull()
    if kind == "tag_absent":
        return at.isNull()
    if kind == "tag_equals":
        return F.coalesce(at == check["value"], F.lit(check.get("allow_absent", False)))
    if kind == "tag_matches":
        return F.coalesce(at.rlike(rf"\A(?:{check['pattern']})\z"), F.lit(check.get("allow_absent", False)))
    if kind == "no_private_tags":
        return F.col("private") == 0
    if kind == "file_meta_consistent":
        return F.coalesce(F.col("media_sop") == F.col("sop"), F.lit(False))
    if kind == "instance_uids_remapped":
        return F.forall("uids", lambda u: u.startswith(check["root"]))
    raise rules.RuleError(f"unknown check type {kind!r}")


def file_findings(elements: DataFrame, checks: list[dict], key: str = "uri") -> DataFrame:
    """check, severity, file of every failed file check."""
    failed = F.array(*(F.when(~passes(c), F.struct(F.lit(c["id"]).alias("check"), F.lit(c["severity"]).alias("severity"))) for c in checks))
    return facts(elements, key).select(F.col(key).alias("file"), F.explode(F.filter(failed, lambda x: x.isNotNull())).alias("f")).select("f.check", "f.severity", "file")


def run_findings(spark: SparkSession, checks: list[dict], reports: dict[str, DataFrame], outputs: DataFrame | None = None) -> DataFrame:
    """check, severity, file of every failed run check; ``reports`` by file name, ``outputs`` with deid_sop_uid."""
    bad = []
    for c in checks:
        report, ok = reports.get(c["file"]), True
        if c["type"] == "report_present":
            ok = report is not None
        elif c["type"] == "report_columns_forbidden":
            ok = report is None or not set(c["columns"]) & set(report.columns)
        elif c["type"] == "report_columns_required":
            ok = report is None or set(c["columns"]) <= set(report.columns)
        elif outputs is not None and not outputs.isEmpty():
            ok = report is not None and unaccounted(outputs, report, c["column"]).isEmpty()
        if not ok:
            bad.append((c["id"], c["severity"], c["file"]))
    return spark.createDataFrame(bad, "check string, severity string, file string")


def unaccounted(outputs: DataFrame, report: DataFrame, column: str = "deid_sop_uid") -> DataFrame:
    """Outputs that the report does not name."""
    return outputs.join(report.select(F.col(column).alias("deid_sop_uid")), "deid_sop_uid", "left_anti")


def verdict(findings: DataFrame) -> DataFrame:
    """One row: failures, warnings, status."""
    bad = F.count_if(F.col("severity") == "error")
    return findings.agg(bad.alias("failures"), F.count_if(F.col("severity") == "warning").alias("warnings"), F.when(bad > 0, "fail").otherwise("pass").alias("status"))


def totals(files: DataFrame, checks: list[dict], findings: DataFrame, run_checks: int = 0) -> DataFrame:
    """One row: files, checks evaluated (each file check on each file, and the run's), failures, warnings, passed, status."""
    n = files.agg(F.count("*").alias("files"))
    out = n.crossJoin(verdict(findings)).withColumn("checks_evaluated", F.col("files") * len(checks) + run_checks)  # one row and one row
    return out.withColumn("passed", F.col("checks_evaluated") - F.col("failures") - F.col("warnings"))
