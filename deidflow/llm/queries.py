"""The registered queries of this subpackage and their oracles."""

from __future__ import annotations

from . import bpe, langid, license, media, mixing, neardup, pii, quality, warc, webtext

QUERIES = {
    "op1_neardup": neardup.query,
    "op2_langid": langid.query,
    "op3_pii": pii.query,
    "op4_quality": quality.query,
    "op5_mixing": mixing.query,
    "op6_license": license.query,
    "op7_webtext": webtext.query,
    "op8_warc": warc.query,
    "op9_bpe": bpe.query,
    "op10_gif": media.query,
}
ORACLES = {
    "op1_neardup": neardup.ORACLE,
    "op4_quality": quality.ORACLE,
    "op7_webtext": webtext.ORACLE,
    "op8_warc": warc.ORACLE,
}
