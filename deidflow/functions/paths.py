"""File paths as columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from deidflow import rules
from deidflow.functions.identity import token


def below(uri: Column, folder: str) -> Column:
    """The path of a file below ``folder``, however many slashes follow the scheme; the bare name of a file that is not below it."""
    plain, root = F.regexp_replace(uri, "^file:/+", "/"), re.sub("^file:/+", "/", folder).rstrip("/") + "/"
    return F.when(plain.startswith(root), F.substring(plain, len(root) + 1, 2**31 - 1)).otherwise(F.element_at(F.split(plain, "/"), -1))


def normalised(path: Column) -> Column:
    """Without empty and ``.`` steps."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(path, r"^(\./+)+", ""), r"/(\./)+", "/"), "/{2,}", "/")


def extension(path: Column) -> Column:
    """The last suffix with its dot, in lower case; empty without one, or for names that start with the only dot."""
    return F.lower(F.regexp_extract(F.element_at(F.split(path, "/"), -1), r"[^.](\.[^.]*)$", 1))


def kind(path: Column) -> Column:
    return F.when(extension(path).isin(*rules.IMAGE_EXTENSIONS), "image").otherwise("dicom")


def may_be_dicom(path: Column) -> Column:
    """Whether a file is worth a look at its content: known other suffixes and hidden files are not."""
    name = F.element_at(F.split(path, "/"), -1)
    return ~extension(path).isin(*rules.SKIP_EXTENSIONS) & ~name.startswith(".")


def target_token(relative: Column, salt: str) -> Column:
    """The token of the top folder; null for files at the top."""
    parts = F.split(relative, "/")
    return F.when(F.size(parts) > 1, token(F.element_at(parts, 1), salt))


def output_path(relative: Column, salt: str, out: str, suffix: Column) -> Column:
    """``out``, the token instead of the top folder, the rest as it was, and another suffix."""
    parts = F.split(relative, "/")
    name = F.concat(F.regexp_replace(F.element_at(parts, -1), r"([^.])\.[^.]*$", "$1"), suffix)
    middle = F.when(F.size(parts) > 2, F.array_join(F.slice(parts, F.lit(2), F.size(parts) - 2), "/"))
    return F.concat_ws("/", F.lit(out), target_token(relative, salt), middle, name)


def run_folder(out: str, day) -> str:
    """The folder of a run that begins at ``day`` (a date or time)."""
    return f"{out.rstrip('/')}/run_{day.strftime('%Y%m%d_%H%M%S')}"
