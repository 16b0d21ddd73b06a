"""Files out, in a way that survives retries: each task writes to a name of its own and renames it.

The target may be any file system that the workers mount; the same rows give the same bytes, so a file that two attempts
write is the same file.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def put(path: str, data: bytes) -> None:
    """A local or mounted path is written beside its place and renamed; a path of another file system by that system."""
    if "://" in path and not path.startswith("file:"):
        from pyarrow import fs

        system, where = fs.FileSystem.from_uri(path)
        system.create_dir(os.path.dirname(where), recursive=True)
        own = f"{where}.{uuid.uuid4().hex}.part"
        with system.open_output_stream(own) as out:
            out.write(data)
        system.move(own, where)
        return
    path = path.removeprefix("file://").removeprefix("file:")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    own = f"{path}.{uuid.uuid4().hex}.part"
    with open(own, "wb") as f:
        f.write(data)
    os.replace(own, path)


def write_files(rows: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """path, saved and error (a class name) of every row; a row without content is refused, as it was not scrubbed."""

    def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for where, data in zip(batch[path], batch[content]):
                try:
                    if data is None:
                        raise ValueError("not scrubbed")
                    put(where, bytes(data))
                    out.append((where, True, None))
                except (OSError, ValueError) as e:
                    out.append((where, False, type(e).__name__))
            yield pd.DataFrame(out, columns=["path", "saved", "error"])

    return rows.select(path, content).mapInPandas(save, "path string, saved boolean, error string")


def write_report(report: DataFrame, folder: str) -> None:
    """A folder of CSV files with a header each, one file for no rows."""
    if "ocr_text" in report.columns:
        raise ValueError("a report may not hold text")
    _write_csv(report, folder)


def _write_csv(report: DataFrame, folder: str) -> None:
    # Rows grow with the detections, so they are not brought into one task; a report without rows still has its header.
    (report.limit(0).coalesce(1) if report.isEmpty() else report).write.mode("overwrite").option("header", "true").csv(folder)


def write_phi_report(report: DataFrame, folder: str, outputs: str) -> None:
    """The report with text, only to a folder that is set and is not the outputs' folder."""
    if not folder or os.path.realpath(folder) == os.path.realpath(outputs):
        raise ValueError("the report with text needs a folder of its own")
    _write_csv(report, folder)


def copy_for_review(rows: DataFrame, review: str, root: str) -> DataFrame:
    """Rows (uri, content) of files that people must see, copied below ``review`` with their relative path."""
    where = F.concat(F.lit(review.rstrip("/") + "/"), F.expr(f"substring(uri, {len(root.rstrip('/')) + 2})"))
    return write_files(rows.withColumn("path", where))
