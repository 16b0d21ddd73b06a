"""Tables in the folder that driver and executors share: they cut lineage and outlive executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; a temporary folder only where that is unset on one machine."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        place = f"file://{tempfile.mkdtemp(prefix='deidflow-')}"
        spark.conf.set("spark.checkpoint.dir", place)
    return f"{place.rstrip('/')}/deidflow/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
