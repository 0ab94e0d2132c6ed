"""Files in a lake folder: listing, format dispatch, gates, profile."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cloakframe.plans.scratch import qualified

# Recognised extensions and the format each one means.
FORMATS = {".csv": "csv", ".json": "json", ".ndjson": "json", ".parquet": "parquet"}

QUARANTINE_SCHEMA = "path string, stage string, error string"


def extension(path: Column) -> Column:
    """Lower-cased last extension of the file name, '' without one."""
    return F.lower(F.regexp_extract(path, r"(\.[^./]*)$", 1))


def file_format(path: Column) -> Column:
    """Reader for a path; null where the extension is not supported."""
    ext = extension(path)
    case = None
    for suffix, name in FORMATS.items():
        case = F.when(ext == suffix, name) if case is None else case.when(ext == suffix, name)
    return case


def display_name(path: Column) -> Column:
    """Upper-case extension of a supported file, else ``UNKNOWN``."""
    return F.when(file_format(path).isNotNull(), F.upper(F.substring(extension(path), F.lit(2), F.length(path)))).otherwise("UNKNOWN")


def plain(uri: Column) -> Column:
    """A file URI as the plain path readers take: decoded, one slash after ``file:``."""
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def source_path() -> Column:
    """Path of the file a row was read from."""
    return plain(F.col("_metadata.file_path"))


UTF8 = "UTF-8"


def is_wide(encoding: str) -> bool:
    """A line feed is more than one byte, so lines are told apart only after decoding."""
    return len("\n".encode(encoding)) > 1


def _decoder(encoding: str):
    """Bytes as text, or null where they are none in this charset."""

    @F.pandas_udf("string")
    def decoded(values: pd.Series) -> pd.Series:
        def one(raw: bytes) -> str | None:
            try:
                return bytes(raw).decode(encoding).removeprefix("\ufeff")
            except UnicodeDecodeError:
                return None

        return values.map(one, na_action="ignore")

    return decoded


def read_texts(spark: SparkSession, paths: str | Sequence[str], encoding: str = UTF8, wholetext: bool = False) -> DataFrame:
    """Lines, or whole files, as ``(path, block, value, valid)``; ``value`` is empty where bytes are not valid.

    Spark's text reader cuts lines by bytes and keeps those as they are, so they are decoded afterwards, in
    tasks.  Files of a wide charset are read whole and cut after decoding.
    """
    wide = is_wide(encoding) and not wholetext
    raw = spark.read.text(paths, wholetext=wholetext or wide)
    raw = raw.select(source_path().alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")
    if encoding.upper().replace("_", "-") == UTF8:
        return raw.withColumn("valid", F.is_valid_utf8("value"))
    text = raw.withColumn("value", _decoder(encoding)(F.col("value").cast("binary")))
    text = text.withColumn("valid", F.col("value").isNotNull()).withColumn("value", F.coalesce("value", F.lit("")))
    if not wide:
        return text
    lines = F.split(F.regexp_replace("value", "\r?\n$", ""), "\r?\n")
    return text.select("path", "block", F.explode(lines).alias("value"), "valid")


def list_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(path, file_name, length, modified)``; file contents are not read.

    A scan skips empty files, so they are added from the driver's file index.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    known = spark.createDataFrame([(f,) for f in files.inputFiles()], "uri string").select(plain(F.col("uri")).alias("path"))
    sized = files.select(
        F.regexp_replace("path", "^file:/+", "file:/").alias("path"), "length", F.col("modificationTime").alias("modified")
    )
    return known.join(sized, "path", "left").select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.coalesce("length", F.lit(0)).alias("length"),
        "modified",
    )


def named_folder(spark: SparkSession, path: Column, roots: str | Sequence[str]) -> Column:
    """The outermost folder below a root that has a supported extension (a table of part files), else the path."""
    suffixes = "|".join(re.escape(s) for s in FORMATS)
    found = path
    for root in [roots] if isinstance(roots, str) else roots:
        fixed = re.split(r"[*?\[{]", root, maxsplit=1)
        top = root.rstrip("/") if len(fixed) == 1 else fixed[0].rpartition("/")[0]
        top = re.sub("^file:/+", "file:/", qualified(spark, top or "/")).rstrip("/")
        # Quoted for Java: the root's own characters stand for themselves.
        below = F.regexp_extract(path, rf"^(\Q{top}\E/(?:[^/]+/)*?[^/]+(?i:{suffixes}))/", 1)
        found = F.when(below != "", below).otherwise(found)
    return found


def classify_files(spark: SparkSession, path: str | Sequence[str], folders: bool = False) -> DataFrame:
    """The listing with the format of each file and the reason to refuse it.

    ``folders``: a folder named like a file of a supported format is one entry, with the bytes of all files below it.
    """
    files = list_files(spark, path)
    if folders:
        whole = files.groupBy(named_folder(spark, F.col("path"), path).alias("path")).agg(F.sum("length").alias("length"), F.max("modified").alias("modified"))
        files = whole.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "length", "modified")
    return receive_gate(files)


def receive_gate(files: DataFrame) -> DataFrame:
    """Adds ``format``, ``display`` and ``error`` (null where the file may enter)."""
    fmt = file_format(F.col("path"))
    return files.withColumns(
        {
            "format": fmt,
            "display": display_name(F.col("path")),
            "error": F.when(F.col("length") == 0, "Empty content received").when(
                fmt.isNull(), F.concat(F.lit("Unsupported file format: "), F.element_at(F.split("path", "/"), -1))
            ),
        }
    )


def quarantined(gated: DataFrame, stage: str) -> DataFrame:
    return gated.filter("error IS NOT NULL").select("path", F.lit(stage).alias("stage"), "error")


def flatten_structs(df: DataFrame) -> DataFrame:
    """Nested objects as dotted columns ``a.b.c``; arrays stay as they are."""

    def walk(prefix: str, path: Column, dtype: T.DataType) -> list[Column]:
        if isinstance(dtype, T.StructType):
            return [
                c
                for f in dtype.fields
                for c in walk(f"{prefix}.{f.name}", path.getField(f.name), f.dataType)
            ]
        return [path.alias(prefix)]

    out: list[Column] = []
    for f in df.schema.fields:
        out.extend(walk(f.name, F.col("`" + f.name.replace("`", "``") + "`"), f.dataType))
    return df.select(*out)


def stringify(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every column as text with '' for null; arrays, maps and structs as JSON."""

    def text(f: T.StructField) -> Column:
        c = F.col("`" + f.name.replace("`", "``") + "`")
        if f.name in keep:
            return c
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        return F.coalesce(c.cast("string"), F.lit("")).alias(f.name)

    return df.select(*map(text, df.schema.fields))


def file_profile(df: DataFrame) -> DataFrame:
    """Per source file: name, format, bytes, rows, columns and schema.

    ``df`` comes straight from a file reader, whose hidden metadata column
    tells which file a row is from.
    """
    schema = F.map_from_arrays(
        F.array(*[F.lit(f.name) for f in df.schema.fields]),
        F.array(*[F.lit(f.dataType.simpleString()) for f in df.schema.fields]),
    )
    return (
        df.select(source_path().alias("path"), F.col("_metadata.file_size").alias("size_bytes"))
        .groupBy("path", "size_bytes")
        .agg(F.count("*").alias("row_count"))
        .select(
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
            display_name(F.col("path")).alias("file_format"),
            "size_bytes",
            "row_count",
            F.lit(len(df.columns)).alias("column_count"),
            F.array(*map(F.lit, df.columns)).alias("columns"),
            schema.alias("schema"),
        )
    )


def work_list(notifications: DataFrame, column: str = "value") -> DataFrame:
    """Arrival messages as ``(bucket, key)`` rows.

    Two shapes are known: ``Records[]`` with a URL-encoded key, and a bus event
    with the key as it is.  Anything else gives no row.
    """
    shape = (
        "Records array<struct<s3:struct<bucket:struct<name:string>,object:struct<key:string>>>>, "
        "source string, detail struct<bucket:struct<name:string>,object:struct<key:string>>"
    )
    event = F.from_json(F.col(column), shape)
    from_records = F.transform(
        F.coalesce(event.Records, F.array().cast("array<struct<s3:struct<bucket:struct<name:string>,object:struct<key:string>>>>")),
        lambda r: F.struct(
            r.s3.bucket.getField("name").alias("bucket"), F.url_decode(r.s3.object.key).alias("key")
        ),
    )
    bus = F.struct(
        event.detail.bucket.getField("name").alias("bucket"), event.detail.object.key.alias("key")
    )
    is_bus = (
        event.Records.isNull()
        & (event.source == "aws.s3")
        & (F.coalesce(event.detail.bucket.getField("name"), F.lit("")) != "")
        & (F.coalesce(event.detail.object.key, F.lit("")) != "")
    )
    rows = F.when(is_bus, F.array(bus)).otherwise(from_records)
    return notifications.select(F.explode(rows).alias("r")).select("r.bucket", "r.key")
