import pytest

from deidflow import rules


def test_booleans_are_not_truthy_strings():
    assert rules.as_bool("false") is False and rules.as_bool("Yes") is True and rules.as_bool(0) is False
    with pytest.raises(rules.RuleError):
        rules.as_bool("maybe")


def test_overlays_come_before_variables():
    base = {"a": {"b": "${X:1}", "c": 2}, "l": [1]}
    out = rules.load(base, {"a": {"b": "${Y:3}"}, "l": [2]}, env={"Y": "7"})
    assert out == {"a": {"b": "7", "c": 2}, "l": [2]} and base["a"]["b"] == "${X:1}"
    with pytest.raises(rules.RuleError):
        rules.resolve_env("${NOPE}", {})


def test_salt_precedence():
    assert rules.salt({"tokenization": {"salt": "c"}}, {rules.SALT_VARIABLE: "e"}) == "c"
    assert rules.salt({}, {rules.SALT_VARIABLE: "e"}) == "e" and rules.salt({}, {}) == rules.DEFAULT_SALT


@pytest.mark.parametrize("name", ["(0010,0010)", "0010,0010", "00100010", "0x00100010"])
def test_tag_notations(name):
    assert rules.tag(name) == "(0010,0010)"


def test_bad_rules_fail_early():
    for bad in ({"zz": "REMOVE"}, {"(0010,0010)": "HASH"}):
        with pytest.raises(rules.RuleError):
            rules.actions(bad)
    assert rules.actions({"00100010": "keep"}) == {"(0010,0010)": "KEEP"}
    for bad in ({"name": "x"}, {"dicom_checks": [{"type": "tag_present", "tag": "00100010"}]}, {"name": "x", "dicom_checks": [{"type": "what"}]}, {"name": "x", "dicom_checks": [{"type": "tag_equals", "tag": "00100010"}]}, {"name": "x", "dicom_checks": [{"type": "tag_matches", "tag": "00100010", "pattern": "("}]}):
        with pytest.raises(rules.RuleError):
            rules.checklist(bad)
    assert len(rules.checklist(rules.CHECKLIST)["dicom_checks"]) == 11


def test_required_values_and_workers():
    config = {"a": {"b": 3, "c": " ", "d": None}}
    assert rules.required(config, "a.b") == 3 and [rules.workers(v, 8) for v in (None, 0, "4", 20)] == [8, 8, 4, 8]
    for path in ("a.c", "a.d", "a.x", "a.b.z"):
        with pytest.raises(rules.RuleError, match=path):
            rules.required(config, path)
    for value in ("many", -1):
        with pytest.raises(rules.RuleError):
            rules.workers(value, 8)


def test_run_folder():
    import datetime

    from deidflow.functions import paths

    assert paths.run_folder("/out/", datetime.datetime(2024, 2, 3, 4, 5, 6)) == "/out/run_20240203_040506"


def test_sampling_takes_the_older_count_as_floor():
    assert rules.sampling({}) == rules.KEYFRAMES
    assert rules.sampling({"series": {"keyframe_count": 5}})["floor"] == 5
    assert rules.sampling({"series": {"keyframe_count": 5, "keyframe_sampling": {"floor": 4, "ceiling": 9}}}) == {"sample_pct": 0.1, "floor": 4, "ceiling": 9}
    for bad in ({"keyframe_count": "x"}, {"keyframe_sampling": {"floor": 9, "ceiling": 3}}, {"keyframe_count": 1}):
        with pytest.raises(rules.RuleError):
            rules.sampling({"series": bad})
    assert rules.writes_reports({}) and not rules.writes_reports({"reporting": {"save_ground_truth": "no"}})
    with pytest.raises(rules.RuleError):
        rules.writes_reports({"reporting": {"save_ground_truth": "perhaps"}})


def test_documents_conform():
    good = {k: 0 for k in ("files_discovered", "files_processed", "files_failed", "pixel_regions_detected", *rules.DECISIONS, "header_tags_scrubbed")} | {"needs_manual_review": False, "status": "success"}
    rules.conform(good, rules.ENVELOPE)
    rules.conform({"status": "error", "error": "InputError"}, rules.ENVELOPE)
    for bad in (good | {"files_failed": -1}, good | {"files_failed": True}, good | {"text": "x"}, {k: v for k, v in good.items() if k != "status"}, good | {"status": "maybe"}, {"status": "error"}, []):
        with pytest.raises(rules.RuleError):
            rules.conform(bad, rules.ENVELOPE)
    rules.conform([{"a": None}], {"type": "array", "items": {"type": "object", "properties": {"a": {"type": ["string", "null"]}}}})
