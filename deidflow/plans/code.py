"""Hands this package's code to Spark's Python workers, as they need not share a folder with the driver."""

from __future__ import annotations

import io
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def archive() -> bytes:
    """The package's modules as a zip file."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(PACKAGE.rglob("*.py")):
            z.write(path, path.relative_to(PACKAGE.parent).as_posix())
    return out.getvalue()


def ship(spark: SparkSession) -> None:
    """Once per application: add the package to the workers' path."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    folder = Path(tempfile.mkdtemp(prefix="deidflow-code-"))  # the driver's file server reads it until the application ends
    (folder / "deidflow_code.zip").write_bytes(archive())
    context.addPyFile(str(folder / "deidflow_code.zip"))
    _shipped.add(context.applicationId)
