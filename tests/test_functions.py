import hashlib
import re

import pytest
from pyspark.sql import functions as F

from deidflow import rules
from deidflow.functions import fragments, geometry, identity, paths


def one(spark, *columns):
    return list(spark.range(1).select(*columns).first())


def test_token_is_sha256_of_value_and_salt(spark):
    want = "TOKEN_" + hashlib.sha256("Änne^XY".encode() + b"salt").hexdigest()[:16]
    assert one(spark, identity.token(F.lit("Änne^XY"), "salt"), identity.token(F.lit(""), "salt"), identity.token(F.lit(None).cast("string"), "salt")) == [want, "", ""]
    assert one(spark, identity.token_bytes(F.lit(b"abc"), "s"))[0] == "TOKEN_" + hashlib.sha256(b"abcs").hexdigest()[:16]


def test_actions(spark):
    act = lambda a, vr: identity.apply_action(F.lit(a), F.lit("v"), F.lit(vr), "s")
    removed, zeroed, dummy, short, kept = one(spark, act("REMOVE", "LO"), act("ZERO", "DA"), act("DUMMY", "PN"), act("DUMMY", "SH"), act("KEEP", "LO"))
    assert removed is None and zeroed == "" and len(dummy) == 22 and short == dummy[:16] and kept == "v"


def test_uid_remap(spark):
    a, b, c, d = one(spark, identity.remap_uid(F.lit(" 1.2.3 "), "s"), identity.remap_uid(F.lit("1.2.3"), "s"), identity.remap_uid(F.lit("1.2.3"), "t"), identity.remap_uid(F.lit(""), "s", F.lit("path")))
    assert a == b != c and len(a) == 64 and a.startswith(rules.UID_ROOT) and d.startswith(rules.UID_ROOT) and re.fullmatch(r"[0-9.]+", a)
    assert one(spark, identity.is_preserved_uid(F.lit("SOPClassUID"), F.lit("9.9")), identity.is_preserved_uid(F.lit("X"), F.lit("1.2.840.10008.1")), identity.is_preserved_uid(F.lit("X"), F.lit("9.9"))) == [True, True, False]


@pytest.mark.parametrize(
    ("text", "want"),
    [("mindray", "keep"), ("D 13.0", "keep"), ("SC5-1N", "keep"), ("12 cm", "keep"), ("20260117-091825-6AAA", "redact"), ("17-01-2026 10:20", "redact"), ("Dr. X", "redact"),
     ("MRN: 123", "redact"), ("John Doe", "ner"), ("  ", "keep"), ("MRN12345", "keep")],
)
def test_cascade(spark, text, want):
    assert one(spark, fragments.cascade(F.lit(text)))[0] == want


def test_cascade_strict_asks_for_shapes_first(spark):
    assert one(spark, fragments.cascade(F.lit("MRN12345"), strict=True))[0] == "redact"


def test_decisions(spark):
    t = F.lit("John Doe")
    low, phi, clean, failed, open_ = one(
        spark, fragments.decision(t, F.lit(0.1)), fragments.decision(t, F.lit(0.9), F.lit(True)), fragments.decision(t, F.lit(0.9), F.lit(False)),
        fragments.decision(t, F.lit(0.9), F.lit(None).cast("boolean")), fragments.decision(t, F.lit(0.9)),
    )
    assert (low, phi, clean, failed, open_) == ("low_confidence", "redacted", "safelisted", "redacted", "ner")
    assert one(spark, fragments.safelist_decision(F.lit("The Patient"), F.lit(0.9)))[0] == "safelisted"


def test_patterns_agree_with_python(spark):
    texts = ["FR 25", "Z 1.10", "AP 81.28%", "iClear 5", "Adult ABD N", "G25", "3.5 MHz", "x", "2026/01/17", "City Hospital", "ID#55", "F H5.0", "Consona N9"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", fragments.is_clinical(F.col("t")).alias("c"), fragments.is_phi_shape(F.col("t")).alias("p"))
    for r in df.collect():
        assert r.c == (r.t.strip().lower() in rules.CLINICAL_ALLOWLIST or any(re.search(p, r.t) for p in rules.CLINICAL_PATTERNS))
        assert r.p == any(re.search(p, r.t) for p in rules.PHI_PATTERNS)


def test_keyframes(spark):
    want = {0: [], 3: [0, 1, 2], 5: [0, 2, 4], 30: [0, 14, 29]}
    df = spark.createDataFrame([(n,) for n in (*want, 100, 300)], "n int").select("n", geometry.keyframes(F.col("n")).alias("k"))
    got = {r.n: r.k for r in df.collect()}
    assert all(got[n] == k for n, k in want.items()) and got[100] == list(range(0, 100, 11)) and len(got[300]) == 25


def test_paths(spark):
    token = one(spark, identity.token(F.lit("P1"), "s"))[0]
    got = one(
        spark, paths.kind(F.lit("a/b.PNG")), paths.kind(F.lit("a/b")), paths.may_be_dicom(F.lit("x/.DS_Store")), paths.may_be_dicom(F.lit("x/y.csv")), paths.may_be_dicom(F.lit("x/y")),
        paths.target_token(F.lit("top.dcm"), "s"), paths.output_path(F.lit("P1/a/b.dcm"), "s", "o", F.lit(".dcm")), paths.output_path(F.lit("b.x"), "s", "o", F.lit(".png")),
    )
    assert got == ["image", "dicom", False, False, True, None, f"o/{token}/a/b.dcm", "o/b.png"]


def test_iou(spark):
    box = lambda *v: tuple(F.lit(x) for x in v)
    assert one(spark, geometry.iou(box(0, 0, 10, 10), box(5, 0, 10, 10)), geometry.iou(box(0, 0, 0, 0), box(0, 0, 0, 0)))[0] == pytest.approx(1 / 3)
