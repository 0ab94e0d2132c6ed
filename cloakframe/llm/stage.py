"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cloakframe.llm.words import texts_of

#: Rows of at most three numbers that are sent to every task at once.
BROADCAST_ROWS = 1 << 20
#: Rows and bytes that reach a Python worker at once.
BATCH_ROWS, BATCH_BYTES = 4000, "16m"
#: Whether the shuffle files of a query go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def bounded_batches(spark: SparkSession) -> None:
    """Sets the session's Arrow batches to a size of which an executor can hold several.

    Spark's own bounds suit numbers; of texts, a batch of 10,000 rows or 64 MB is held by the JVM, by
    the worker and once more as Python objects.  Applications call this once; no result depends on it.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a local session that has none gets a temporary folder of its own."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("Set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def saved(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and no lost executor undoes it.

    Its shuffle files go at once, and not when the driver happens to collect its garbage.
    """
    path, conf = f"{shared_folder(df.sparkSession)}/llm-{uuid.uuid4().hex}", df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Removes the saved tables that ``df`` reads, which nothing needs any more."""
    context = df.sparkSession.sparkContext
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        if path.getName().startswith("llm-"):
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def pressed(numbers: np.ndarray) -> bytes:
    """Compressed bytes of an array of integers, all lowest bytes first."""
    return zstandard.compress(np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), -1).T).tobytes(), 1)


def unpressed(data: bytes, kind: type) -> np.ndarray:
    """The array of integers of that kind."""
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for a broadcast if it has few rows; beyond that Spark shuffles both sides."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def compressed(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the column ``text`` as compressed bytes (null is empty), which halves what a shuffle moves."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            at = names.index(text)
            columns = batch.columns
            columns[at] = pa.array([press.compress(x) for x in texts_of(columns[at])], pa.binary())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(run, T.StructType([T.StructField(f.name, T.BinaryType() if f.name == text else f.dataType) for f in df.schema.fields]))


def plain(column: pa.Array) -> list[bytes]:
    """The texts of a compressed column."""
    unpress = zstandard.ZstdDecompressor()
    return [unpress.decompress(x) if x else b"" for x in column.to_pylist()]
