"""Shared scratch folders and small session helpers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``, which driver and executors share.

    Where the setting is absent, a local session gets a temporary folder of this
    machine; any other raises, as its executors could not see such a folder.
    What is written there goes when the application ends, unless ``remove``
    takes it away before.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='corpuslens-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    files, at = _files(spark, path)
    files.deleteOnExit(at)
    return path


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    files, at = _files(spark, path)
    files.delete(at, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends there."""
    return stored_at(df, name)[0]


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Like ``stored``, with the folder for ``remove``."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def by_bytes(batch: pa.RecordBatch, text: int, *, rows: int = 250, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` of at most ``rows`` rows whose texts (column ``text``) hold about ``size`` bytes; a longer text comes alone."""
    start, held = 0, 0
    for i, value in enumerate(batch.column(text)):
        n = value.as_buffer().size if value.is_valid and hasattr(value, "as_buffer") else 0
        if i > start and (held + n > size or i - start >= rows):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if batch.num_rows > start:
        yield batch.slice(start)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, after which its worker gives free memory back.

    Workers serve many tasks and stages; Arrow's pool and the allocator would
    keep the most that any task has used.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return whole


def release() -> None:
    """Free memory of Arrow's pool and, where it is glibc's, of the allocator goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
