"""Scratch tables in the folder that driver and executors share."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where it is unset on one machine (tests) a temporary folder."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        place = f"file://{tempfile.mkdtemp(prefix='deidflow-')}"
        spark.conf.set("spark.checkpoint.dir", place)
    return place.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/deidflow/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int | None):
    """While it lasts, Arrow batches have at most ``rows`` rows: rows of many bytes shall not fill a worker's memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if rows:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def release() -> None:
    """Give a Python worker's free memory back to its machine."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def tidy(batches: Callable) -> Callable:
    """``batches`` for ``mapInArrow``; after a partition its worker, which later stages use again, keeps no free memory."""

    @functools.wraps(batches)
    def run(found: Iterator) -> Iterator:
        try:
            yield from batches(found)
        finally:
            release()

    return run


def small_batches(spark: SparkSession, rows: int = 1024) -> None:
    """Arrow batches of at most ``rows`` rows in this session from here on, as rows hold whole texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(rows))


def materialise(df: DataFrame, name: str, narrow: bool = False, batch: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    ``narrow``: a table of few bytes a row, such as keys or links, comes in at most two files for each core of the cluster
    instead of one for each shuffle partition. ``batch``: rows of an Arrow batch, where rows hold many bytes.

    The table cuts the lineage: what follows reads files that outlive any executor. It stays until the
    cluster clears its scratch folder, as later plans may read it lazily.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with arrow_rows(spark, batch):
        (df.coalesce(2 * spark.sparkContext.defaultParallelism) if narrow else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Keys that may be broadcast; more are joined by a shuffle.
MAX_BROADCAST_KEYS = 2_000_000


def without(rows: DataFrame, lost: DataFrame, on: tuple[str, ...]) -> DataFrame:
    """``rows`` whose columns ``on`` equal (null equals null) no row of ``lost``, whose columns stand in the same order.

    Lost keys are written first and counted: up to ``MAX_BROADCAST_KEYS`` they are broadcast, so that texts are not shuffled.
    """
    lost = materialise(lost.toDF(*(f"_lost_{k}" for k in range(len(on)))), "lost", narrow=True)
    small = lost.count() <= MAX_BROADCAST_KEYS
    same = None
    for k, name in enumerate(on):
        one = rows[name].eqNullSafe(lost[f"_lost_{k}"])
        same = one if same is None else same & one
    return rows.join(F.broadcast(lost) if small else lost, same, "left_anti")


def drop_table(spark: SparkSession, df_or_path: DataFrame | str) -> None:
    """Delete a scratch table that nothing reads any more."""
    paths = [df_or_path] if isinstance(df_or_path, str) else {f.rsplit("/", 1)[0] for f in df_or_path.inputFiles()}
    for path in paths:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> str:
    """Write a small file where ``path`` says, by Spark's own file systems; the path as given."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    return path
