"""Incremental runs: new files and new audit rows, each once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deidflow.functions.paths import may_be_dicom
from deidflow.operators import reports

FILE = "path string, modificationTime timestamp, length long, content binary"


def new_files(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """A stream of uri and content of what may be DICOM below ``folder``; a batch is bounded by its number of files."""
    found = spark.readStream.format("binaryFile").schema(FILE).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch).load(folder)
    named = found.where(may_be_dicom(F.col("path")))
    return named.where(F.substring("content", 129, 4) == F.lit(b"DICM")).select(F.col("path").alias("uri"), "content")


def run_available(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> None:
    """Hand all that is there to ``handle`` in batches and stop; the checkpoint remembers what was done."""
    stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


class ReportTable:
    """A Parquet table of audit rows by generation: merging twice with the same batch gives the same rows."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, generation: int) -> str:
        return f"{self.folder}/generation={generation}"

    def read(self, generation: int) -> DataFrame:
        return self.spark.read.parquet(self._path(generation))

    def merge(self, rows: DataFrame, generation: int) -> None:
        """Write generation ``generation`` (from 0): the one before, with the sources of ``rows`` replaced."""
        out = rows if generation == 0 else reports.merge(self.read(generation - 1), rows)
        out.write.mode("overwrite").parquet(self._path(generation))
