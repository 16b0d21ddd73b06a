"""Tokens, UIDs and header actions as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from deidflow import rules


def trim(c: Column | str) -> Column:
    """Without white space at both ends, of any kind."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def tag_name(text: Column) -> Column:
    """'(GGGG,EEEE)' of a tag's notations, as ``rules.tag`` has them; null for what is no tag."""
    form = r"^\(?\s*(?:0x)?([0-9A-Fa-f]{4})\s*,?\s*(?:0x)?([0-9A-Fa-f]{4})\s*\)?$"
    group = lambda k: F.upper(F.regexp_extract(trim(text), form, k))
    return F.when(trim(text).rlike(form), F.concat(F.lit("("), group(1), F.lit(","), group(2), F.lit(")")))


def token(value: Column | str, salt: str) -> Column:
    """TOKEN_ and 16 hex digits of sha-256 over value and salt; empty stays empty, null becomes empty."""
    value = F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(""))
    return F.when(value == "", "").otherwise(F.concat(F.lit("TOKEN_"), F.substring(F.sha2(F.concat(value, F.lit(salt)), 256), 1, 16)))


def token_bytes(content: Column, salt: str) -> Column:
    """The token of raw bytes."""
    return F.when(F.octet_length(content) == 0, "").otherwise(F.concat(F.lit("TOKEN_"), F.substring(F.sha2(F.concat(content, F.encode(F.lit(salt), "UTF-8")), 256), 1, 16)))


def fit_vr(text: Column, vr: Column) -> Column:
    """At most 16 characters where the value representation allows no more."""
    return F.when(vr.isin(*rules.SHORT_VRS), F.substring(text, 1, 16)).otherwise(text)


def is_preserved_uid(keyword: Column, value: Column) -> Column:
    """Class UIDs, empty values and those of the standard's root name no instance."""
    value = F.coalesce(value, F.lit(""))
    return F.coalesce(keyword, F.lit("")).isin(*rules.CLASS_UID_KEYWORDS) | (trim(value) == "") | value.startswith(rules.STANDARD_UID_ROOT)


def remap_uid(uid: Column, salt: str, fallback: Column | None = None) -> Column:
    """A UID of 64 characters under the remap root, in built-in functions: digits of sha-256, 15 hex digits at a time.

    The same source and salt give the same UID in every file and run. Without a UID the fallback (a path) is the source.
    """
    source = trim(F.coalesce(uid, F.lit("")))
    if fallback is not None:
        source = F.when(source == "", trim(F.coalesce(fallback, F.lit("")))).otherwise(source)

    def spelled(digest: Column) -> Column:
        digits = F.concat(*(F.lpad(F.conv(F.substring(digest, k, 15), 16, 10), 19, "0") for k in (1, 16, 31)))
        # A component has no leading zero: the first digit is 1 to 9.
        head = (F.conv(F.substring(digest, 46, 4), 16, 10).cast("long") % 9 + 1).cast("string")
        return F.concat(F.lit(rules.UID_ROOT), head, F.substring(digits, 1, 63 - len(rules.UID_ROOT)))

    # The digest is worked out once, not once for each of its parts.
    return F.get(F.transform(F.array(F.sha2(F.concat(F.lit(salt), source), 256)), spelled), F.lit(0))


def remap_uids(value: Column, salt: str, keyword: Column | None = None) -> Column:
    """Each of several UIDs parted by backslashes; those that name no instance stay as they are."""
    keyword = F.lit("") if keyword is None else keyword
    each = F.transform(F.split(value, r"\\"), lambda u: F.when(is_preserved_uid(keyword, u), u).otherwise(remap_uid(u, salt)))
    return F.array_join(each, "\\")


def apply_action(action: Column, value: Column, vr: Column, salt: str) -> Column:
    """The value after REMOVE (null), ZERO (empty), DUMMY (fitted token) or KEEP."""
    return (
        F.when(action == "REMOVE", F.lit(None).cast("string"))
        .when(action == "ZERO", "")
        .when(action == "DUMMY", fit_vr(token(value, salt), vr))
        .otherwise(value)
    )
