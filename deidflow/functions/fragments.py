"""Decisions on burnt-in text fragments as columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from deidflow import rules
from deidflow.functions.identity import trim


def any_match(text: Column, patterns: Iterable[str]) -> Column:
    """Whether one of the patterns is found, as one alternation; digits and spaces are Unicode's."""
    each = [f"(?i:{p[4:]})" if p.startswith("(?i)") else f"(?:{p})" for p in patterns]
    return text.rlike("(?U)" + "|".join(each)) if each else F.lit(False)


def is_clinical(text: Column) -> Column:
    return F.lower(trim(text)).isin(*rules.CLINICAL_ALLOWLIST) | any_match(text, rules.CLINICAL_PATTERNS)


def is_phi_shape(text: Column) -> Column:
    return any_match(text, rules.PHI_PATTERNS)


def cascade(text: Column, strict: bool = False) -> Column:
    """keep, redact, or ner for what a model decides. ``strict`` asks for the shape of personal data first."""
    text = F.coalesce(text, F.lit(""))
    out = F.when(trim(text) == "", "keep")
    tests = [(is_clinical(text), "keep"), (is_phi_shape(text), "redact")]
    for test, decision in reversed(tests) if strict else tests:
        out = out.when(test, decision)
    return out.otherwise("ner")


def decision(text: Column, confidence: Column, ner_is_phi: Column | None = None, threshold: float = rules.CONFIDENCE, strict: bool = False) -> Column:
    """low_confidence, safelisted or redacted; without a model's word the residue is ``ner`` (a model's failure is redacted)."""
    kind = cascade(text, strict)
    rest = F.lit("ner") if ner_is_phi is None else F.when(F.coalesce(ner_is_phi, F.lit(True)), "redacted").otherwise("safelisted")
    return F.when(confidence < threshold, "low_confidence").when(kind == "keep", "safelisted").when(kind == "redact", "redacted").otherwise(rest)


def safelist_decision(text: Column, confidence: Column, patterns: Iterable[str] = rules.SAFELIST, threshold: float = rules.CONFIDENCE) -> Column:
    """The decision without a model: what the safelist finds is kept."""
    return F.when(confidence < threshold, "low_confidence").when(any_match(text, patterns), "safelisted").otherwise("redacted")


def is_phi_label(labels: Column) -> Column:
    """Whether one of a model's entity labels names personal data."""
    return F.exists(labels, lambda x: F.regexp_replace(x, "^[BI]-", "").isin(*rules.PHI_LABELS))


def carrier(text: Column) -> Column:
    """Short fragments inside a sentence, as models read sentences."""
    return F.when(F.size(F.split(trim(text), r"\s+")) <= 3, F.concat(F.lit("The patient record shows "), text, F.lit("."))).otherwise(text)
