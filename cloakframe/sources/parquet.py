"""Parquet: gate on the file's magic bytes, read, write."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the first and last bytes of a file.
MAGIC = b"PAR1"


PARQUET_FILES = "path string, error string, layout string"


def _opened(path: str):
    """A file as a Python object, or None where Python has no way to it."""
    from pyarrow import fs

    try:
        if path.startswith("file:"):
            return fs.LocalFileSystem().open_input_file("/" + path[5:].lstrip("/"))
        where, name = fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))
        return where.open_input_file(name)
    except Exception:  # no library or no rights for this store, which Spark may well have
        return None


def _footer(path: str, length: int) -> tuple[str, str | None, str | None]:
    """The reason to refuse a file, or its layout; neither if it cannot be opened here."""
    file = _opened(path)
    if file is None:
        return path, None, None
    with file:
        if length < 4:
            return path, "File is empty" if not length else "File too small to be valid Parquet", None
        if file.read(4) != MAGIC:
            return path, "Invalid Parquet magic bytes (missing PAR1 header)", None
        file.seek(length - 4)
        if file.read(4) != MAGIC:
            return path, "Invalid Parquet magic bytes (missing PAR1 footer)", None
        try:
            read = pq.ParquetFile(file)
        except Exception:
            return path, "Failed to read Parquet", None
        own = (read.metadata.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"").decode()
        names = "\n".join(f"{c.path} {c.physical_type} {c.logical_type} {c.max_definition_level} {c.max_repetition_level}" for c in (read.schema.column(k) for k in range(len(read.schema))))
        return path, None, f"{names}\n{own}"


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame([_footer(p, n) for p, n in zip(batch["path"], batch["length"])], columns=["path", "error", "layout"])


def parquet_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(path, error, layout)`` per file; files of one layout have the same columns.

    One job, a task per range of files: each opens its files and reads magic bytes and footers, no rows.
    Where Python cannot open a store, all that Spark can tell of a file without asking for its rows
    is whether it reads; such files have no layout, and the caller asks for their schemas.
    """
    files = spark.read.format("binaryFile").load(paths).select(F.regexp_replace("path", "^file:/+", "file:/").alias("path"), "length")
    return files.mapInPandas(_footers, PARQUET_FILES)


def schemas_of(spark: SparkSession, paths: Sequence[str], at_once: int = 16) -> list[tuple[str, str | None]]:
    """The schema of each file as Spark tells it, null if it cannot: for stores that tasks cannot open themselves."""

    def one(path: str) -> tuple[str, str | None]:
        try:
            return path, spark.read.parquet(path).schema.json()
        except (PySparkException, Py4JJavaError):
            return path, None

    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(one, paths))


def read_parquet(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.parquet(*([paths] if isinstance(paths, str) else paths))


def write_parquet(
    df: DataFrame, path: str, compression: str = "snappy", mode: str = "error", partition_by: Sequence[str] = ()
) -> None:
    writer = df.write.mode(mode).option("compression", compression)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
