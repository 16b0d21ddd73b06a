"""Rules as data: configuration, action tables, text patterns and checklists, validated on the driver before any file."""

from __future__ import annotations

import copy
import os
import re
from typing import Any

# Text rules of burnt-in fragments.
CLINICAL_PATTERNS = (
    r"^[A-Z]{1,3}\d[\w.-]*$",
    r"(?i)^Consona\s+\w+$",
    r"^(F\s*H?\d|D\s+\d|G\s+\d|FR\s+\d|DR\s+\d)",
    r"^(AP|MI|TIS|SSI)\s+\d",
    r"(?i)^(iClear|iBeam|iTouch)\s+\d",
    r"^Z\s+\d+\.\d+$",
    r"^\d+\.\d+$",
    r"^\d+\.?\d*\s*(cm|mm|MHz)$",
    r"(?i)^(Adult|Pediatric)\s+(ABD|OB|GYN|CARD)",
)
PHI_PATTERNS = (
    r"^\d{8}[-/]\d{6}[-/]?\w*$",
    r"^\d{1,2}[-/]\d{1,2}[-/]\d{2,4}(\s+\d{1,2}[:.]\d{2}.*)?$",
    r"^\d{4}[-/]\d{1,2}[-/]\d{1,2}(\s+\d{1,2}[:.]\d{2}.*)?$",
    r"(?i)(hospital|clinic|centre|center|diagnostic|medical|health|labs?|imaging|radiology|pathology|institute|university|foundation)",
    r"(?i)^Dr\.?\s+",
    r"(?i)^(MRN?|ID|PT)\s*[:#]?\s*\d+",
)
CLINICAL_ALLOWLIST = (
    "mindray", "ge", "philips", "siemens", "toshiba", "canon", "samsung", "hitachi", "esaote", "fujifilm", "hologic", "zonare",
    "adult abd", "adult abd n", "ob", "gyn", "cardiac", "vascular", "msk", "small parts", "b", "m",
)
SAFELIST = (
    r"^m$", r"^R$", r"^L$", r"^B$", r"^F\s*H?\d+\.?\d*$", r"^D\s*\d+\.?\d*$", r"^G\s*\d+$", r"^6\s*\d+$", r"^FR\s*\d+$", r"^DR\s*\d+$",
    r"^Z\s*\d+\.\d+$", r"^\d+\.\d+$", r"^AP\s+\d+\.\d+%", r"^MI\s+\d+\.\d+", r"^TIS\s+\d+\.\d+", r"^SSI\s+\d+$", r"^iClear\s+\d+$", r"^iBeam\s+\d+$",
    r"\d+\.?\d*\s*(cm|mm|MHz)$", r"(?i)patient", r"(?i)hospital",
)
PHI_LABELS = (
    "PATIENT", "DOCTOR", "USERNAME", "IDNUM", "MEDICALRECORD", "HOSPITAL", "DATE", "AGE", "PHONE", "FAX", "EMAIL", "URL", "SSN", "ACCOUNT",
    "LICENSE", "STREET", "CITY", "STATE", "ZIP", "COUNTRY", "ORGANIZATION", "PROFESSION",
)

# Header actions, modalities, file extensions, UID rules.
PII_ACTIONS = {
    "(0010,0010)": "DUMMY", "(0010,0020)": "DUMMY", "(0010,0030)": "REMOVE", "(0008,0020)": "ZERO", "(0008,0050)": "REMOVE", "(0008,0090)": "DUMMY",
    "(0008,0080)": "REMOVE", "(0010,0040)": "REMOVE", "(0010,1010)": "REMOVE", "(0010,1020)": "REMOVE", "(0010,1030)": "REMOVE", "(0008,0081)": "REMOVE",
    "(0008,1040)": "REMOVE", "(0008,1048)": "REMOVE", "(0008,1050)": "REMOVE", "(0008,1030)": "REMOVE", "(0008,103E)": "REMOVE", "(0008,0021)": "ZERO",
    "(0008,0023)": "ZERO", "(0008,0030)": "ZERO", "(0008,0031)": "ZERO", "(0020,0010)": "DUMMY", "(0010,21B0)": "REMOVE", "(0040,A124)": "REMOVE",
    "(0010,2297)": "REMOVE",
}
MODALITIES = ("CT", "MR", "US", "CR", "DX", "MG", "PT", "XA", "RF", "OT")
SKIP_EXTENSIONS = (
    ".jpg", ".jpeg", ".png", ".gif", ".bmp", ".tiff", ".tif", ".txt", ".xml", ".json", ".csv", ".html", ".htm", ".pdf", ".zip", ".gz", ".tar", ".log",
    ".md", ".py", ".yaml", ".yml", ".toml", ".cfg", ".ini", ".ds_store",
)
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png")
UID_ROOT = "1.2.826.0.1.3680043.8.498."
STANDARD_UID_ROOT = "1.2.840.10008"
CLASS_UID_KEYWORDS = ("SOPClassUID", "MediaStorageSOPClassUID", "TransferSyntaxUID", "ImplementationClassUID", "ReferencedSOPClassUID")
SHORT_VRS = ("SH", "AE", "CS")
GEOMETRY_KEYWORDS = ("ImagePositionPatient", "ImageOrientationPatient", "PixelSpacing", "SliceThickness", "InstanceNumber")
DECISIONS = ("redacted", "safelisted", "low_confidence")
PIXEL_COLUMNS = ("source_path", "original_sop_uid", "deid_sop_uid", "frame_index", "bbox_x", "bbox_y", "bbox_w", "bbox_h", "text_token", "text_len", "confidence", "decision")
TAG_COLUMNS = ("source_path", "original_sop_uid", "deid_sop_uid", "tag", "keyword", "action", "redacted")

DEFAULT_SALT = "deidflow-default-salt"
SALT_VARIABLE = "DEIDFLOW_SALT"
CONFIDENCE = 0.4
KEYFRAMES = {"sample_pct": 0.10, "floor": 3, "ceiling": 25}
ACTIONS = ("REMOVE", "ZERO", "DUMMY", "KEEP")


class RuleError(ValueError):
    """A rule that cannot be used; raised before any file is read."""


def as_bool(value: Any) -> bool:
    """Booleans, numbers 0 and 1, and the usual words; anything else is an error."""
    if isinstance(value, bool):
        return value
    word = str(value).strip().lower()
    if word in ("true", "yes", "on", "1"):
        return True
    if word in ("false", "no", "off", "0", "", "none"):
        return False
    raise RuleError(f"not a boolean: {value!r}")


_VARIABLE = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_]*)(?::([^}]*))?\}")


def resolve_env(value: Any, env: dict[str, str] | None = None) -> Any:
    """``${NAME:default}`` in every string of a nested value; a name without value and default is an error."""
    env = os.environ if env is None else env
    if isinstance(value, dict):
        return {k: resolve_env(v, env) for k, v in value.items()}
    if isinstance(value, list):
        return [resolve_env(v, env) for v in value]
    if not isinstance(value, str):
        return value

    def put(m: re.Match) -> str:
        if (found := env.get(m[1])) is not None:
            return found
        if m[2] is None:
            raise RuleError(f"variable {m[1]} is not set and has no default")
        return m[2]

    return _VARIABLE.sub(put, value)


def overlay(base: dict, over: dict) -> dict:
    """``over`` laid on ``base``: mappings merge, all else is replaced; neither argument changes."""
    out = copy.deepcopy(base)
    for k, v in over.items():
        out[k] = overlay(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else copy.deepcopy(v)
    return out


def load(base: dict, *overlays: dict, env: dict[str, str] | None = None) -> dict:
    """Overlays first, variables last."""
    for over in overlays:
        base = overlay(base, over)
    return resolve_env(base, env)


def salt(config: dict | None = None, env: dict[str, str] | None = None) -> str:
    """The configured salt, else the environment's, else the default."""
    env = os.environ if env is None else env
    configured = str(((config or {}).get("tokenization") or {}).get("salt") or "")
    return configured or env.get(SALT_VARIABLE, "") or DEFAULT_SALT


def sampling(config: dict) -> dict:
    """How volumes are sampled; the older ``keyframe_count`` is the floor where no newer one stands."""
    series = config.get("series") or {}
    found = KEYFRAMES | ({"floor": series["keyframe_count"]} if series.get("keyframe_count") is not None else {}) | (series.get("keyframe_sampling") or {})
    try:
        out = {"sample_pct": float(found["sample_pct"]), "floor": int(found["floor"]), "ceiling": int(found["ceiling"])}
    except (TypeError, ValueError) as e:
        raise RuleError("keyframe sampling wants numbers") from e
    if not (0 <= out["sample_pct"] <= 1 and 2 <= out["floor"] <= out["ceiling"]):
        raise RuleError("keyframe sampling is out of range")
    return out


def writes_reports(config: dict) -> bool:
    """Whether a run's audit tables are written, ``reporting.save_ground_truth``; they are unless it says no."""
    value = (config.get("reporting") or {}).get("save_ground_truth")
    return True if value is None else as_bool(value)


#: What runs by command lay over a base configuration, unless they name an overlay or ``OVERRIDE_VARIABLE`` does.
COMMAND_OVERLAY = {"reporting": {"save_ground_truth": True}}
OVERRIDE_VARIABLE = "DEIDFLOW_CONFIG_OVERRIDE"

_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "integer": int, "number": (int, float), "null": type(None)}


def conform(value: Any, schema: dict, at: str = "$") -> None:
    """Raise RuleError at the first place where a JSON document departs from ``schema`` (the parts of JSON Schema in use here)."""
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(isinstance(value, _TYPES[k]) and (k == "boolean" or not isinstance(value, bool)) for k in kinds):
        raise RuleError(f"{at}: not {' or '.join(kinds)}")
    if "enum" in schema and value not in schema["enum"]:
        raise RuleError(f"{at}: none of the allowed values")
    if "minimum" in schema and value < schema["minimum"]:
        raise RuleError(f"{at}: too small")
    if "oneOf" in schema:
        fits = 0
        for branch in schema["oneOf"]:
            try:
                conform(value, branch, at)
                fits += 1
            except RuleError:
                pass
        if fits != 1:
            raise RuleError(f"{at}: {fits} branches fit, not one")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        for k in schema.get("required", ()):
            if k not in value:
                raise RuleError(f"{at}.{k}: missing")
        for k, v in value.items():
            if k in known:
                conform(v, known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                raise RuleError(f"{at}.{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        for k, v in enumerate(value):
            conform(v, schema["items"], f"{at}[{k}]")


_COUNT = {"type": "integer", "minimum": 0}
_TOTALS = {k: _COUNT for k in ("files_discovered", "files_processed", "files_failed", "pixel_regions_detected", *DECISIONS, "header_tags_scrubbed")}
#: The document of a run: totals, or an error.
ENVELOPE = {"oneOf": [
    {"type": "object", "properties": _TOTALS | {"needs_manual_review": {"type": "boolean"}, "status": {"enum": ["success", "partial", "error"]}, "saved": _COUNT, "kind": {"enum": ["dicom", "image"]}},
     "required": [*_TOTALS, "needs_manual_review", "status"], "additionalProperties": False},
    {"type": "object", "properties": {"status": {"enum": ["error"]}, "error": {"type": "string"}}, "required": ["status", "error"], "additionalProperties": False},
]}


def required(config: dict, path: str) -> Any:
    """The value at a dotted path; a missing, null or blank one is an error that names the path."""
    value: Any = config
    for name in path.split("."):
        value = value.get(name) if isinstance(value, dict) else None
    if value is None or isinstance(value, str) and not value.strip():
        raise RuleError(f"configuration needs {path}")
    return value


def workers(value: Any, most: int) -> int:
    """A number of workers from 1 to ``most``; null or 0 asks for all."""
    if value in (None, "", 0, "0"):
        return most
    try:
        n = int(str(value))
    except ValueError as e:
        raise RuleError(f"not a number of workers: {value!r}") from e
    if n < 0:
        raise RuleError(f"not a number of workers: {value!r}")
    return min(n, most)


_TAG = re.compile(r"^\(?\s*(?:0x)?([0-9A-Fa-f]{4})\s*,?\s*(?:0x)?([0-9A-Fa-f]{4})\s*\)?$")


def tag(name: Any) -> str:
    """'(GGGG,EEEE)' of the notations '(GGGG,EEEE)', 'GGGG,EEEE', 'GGGGEEEE' and '0xGGGGEEEE'."""
    m = _TAG.match(str(name).strip())
    if not m:
        raise RuleError(f"not a tag: {name!r}")
    return f"({m[1].upper()},{m[2].upper()})"


def actions(mapping: dict[str, str]) -> dict[str, str]:
    """A checked action table."""
    out = {}
    for key, action in mapping.items():
        if (name := str(action).strip().upper()) not in ACTIONS:
            raise RuleError(f"unknown action {action!r} for {key!r}")
        out[tag(key)] = name
    return out


FILE_CHECKS = {
    "tag_present": ("tag",), "tag_absent": ("tag",), "tag_equals": ("tag", "value"), "tag_matches": ("tag", "pattern"), "no_private_tags": (),
    "file_meta_consistent": (), "instance_uids_remapped": ("root",),
}
RUN_CHECKS = {"report_present": ("file",), "outputs_accounted_in_report": ("file", "column"), "report_columns_forbidden": ("file", "columns"), "report_columns_required": ("file", "columns")}

# The default checklist.
CHECKLIST = {
    "name": "ps315-deidentification",
    "dicom_checks": [
        {"id": "attestation-patient-identity-removed", "type": "tag_equals", "tag": "(0012,0062)", "value": "YES"},
        {"id": "attestation-method-code-present", "type": "tag_present", "tag": "(0012,0064)"},
        {"id": "burned-in-annotation-cleared", "type": "tag_equals", "tag": "(0028,0301)", "value": "NO"},
        {"id": "patient-name-tokenized", "type": "tag_matches", "tag": "(0010,0010)", "pattern": "TOKEN_[0-9a-fA-F]+", "allow_absent": True},
        {"id": "patient-id-tokenized", "type": "tag_matches", "tag": "(0010,0020)", "pattern": "TOKEN_[0-9a-fA-F]+", "allow_absent": True},
        {"id": "patient-birth-date-removed", "type": "tag_absent", "tag": "(0010,0030)"},
        {"id": "accession-number-removed", "type": "tag_absent", "tag": "(0008,0050)"},
        {"id": "study-date-zeroed", "type": "tag_matches", "tag": "(0008,0020)", "pattern": "0*", "allow_absent": True},
        {"id": "no-private-tags", "type": "no_private_tags"},
        {"id": "file-meta-consistent", "type": "file_meta_consistent"},
        {"id": "instance-uids-remapped", "type": "instance_uids_remapped", "root": UID_ROOT},
    ],
    "run_checks": [
        {"id": "pixel-report-present", "type": "report_present", "file": "pixel_detections.csv"},
        {"id": "pixel-report-phi-free", "type": "report_columns_forbidden", "file": "pixel_detections.csv", "columns": ["ocr_text"]},
        {"id": "pixel-report-complete", "type": "report_columns_required", "file": "pixel_detections.csv", "columns": ["source_path", "original_sop_uid", "deid_sop_uid", "text_token", "text_len", "decision"]},
        {"id": "tag-report-present", "type": "report_present", "file": "tag_actions.csv", "severity": "warning"},
        {"id": "outputs-accounted-in-tag-report", "type": "outputs_accounted_in_report", "file": "tag_actions.csv", "column": "deid_sop_uid"},
    ],
}


def checklist(spec: dict) -> dict:
    """A checked checklist: every check has a known type, its parameters, a severity and an id."""
    if not spec.get("name"):
        raise RuleError("a checklist needs a name")
    out = {"name": spec["name"], "dicom_checks": [], "run_checks": []}
    for part, kinds in (("dicom_checks", FILE_CHECKS), ("run_checks", RUN_CHECKS)):
        for k, check in enumerate(spec.get(part) or []):
            kind = check.get("type")
            if kind not in kinds:
                raise RuleError(f"unknown check type {kind!r}")
            if missing := [p for p in kinds[kind] if check.get(p) in (None, [])]:
                raise RuleError(f"check {kind} lacks {missing}")
            severity = check.get("severity", "error")
            if severity not in ("error", "warning"):
                raise RuleError(f"unknown severity {severity!r}")
            if "pattern" in check:
                try:
                    re.compile(check["pattern"])
                except re.error as e:
                    raise RuleError(f"bad pattern in {kind}") from e
            made = {**check, "severity": severity, "id": check.get("id") or f"{kind}-{k}", "allow_absent": as_bool(check.get("allow_absent", False))}
            if "tag" in check:
                made["tag"] = tag(check["tag"])
            out[part].append(made)
    if not out["dicom_checks"] and not out["run_checks"]:
        raise RuleError("a checklist needs a check")
    return out
