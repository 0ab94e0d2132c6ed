"""JSON in its three shapes: one array, one wrapped array, one object per line."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakframe.sources.lake import UTF8, flatten_structs, read_texts

# Keys that hold the records of a wrapped file, in order.
RECORD_KEYS = ("records", "data", "items", "results", "rows")

#: Reader options: a text in a record may be as long as a row can hold, where the parser would stop at 20 MB.
ANY_LENGTH = {"maxStringLen": str(2**31 - 1)}


def _is_object(v: Column) -> Column:
    return F.startswith(F.schema_of_variant(v), F.lit("OBJECT"))


def _unsure(text: Column, v: Column) -> Column:
    """Starts like an object, but is no variant: too large for one, of repeated keys, or no JSON."""
    return v.isNull() & F.json_object_keys(text).isNotNull()


def _field_paths(value, at: str, out: set[str]) -> set[str]:
    """Every path in a value with the type it has there."""
    if isinstance(value, dict):
        for k, v in value.items():
            _field_paths(v, f"{at}.{k}", out)
    elif isinstance(value, list):
        for v in value:
            _field_paths(v, f"{at}[]", out)
    if not value or not isinstance(value, (dict, list)):
        out.add(f"{at}:{type(value).__name__}")
    return out


def _parsed_paths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Field paths of each object; none for what is no JSON object after all."""

    def paths(text: str) -> list[str] | None:
        try:
            value = json.loads(text)
        except ValueError:
            return None
        return sorted(_field_paths(value, "", set())) if isinstance(value, dict) else None

    for batch in batches:
        yield pd.DataFrame({"path": batch["path"], "fields": [paths(t) for t in batch["value"]]})


def _settled(values: DataFrame) -> dict[str, tuple[int, list[str]]]:
    """Per file of unsure values (path, value): how many are objects, and the field paths of all of them."""
    parsed = values.select("path", "value").mapInPandas(_parsed_paths, "path string, fields array<string>")
    # A field path per file and task is what the aggregation holds, not one per value.
    counted = parsed.where("fields is not null").select("path", F.posexplode("fields").alias("k", "field")).groupBy("path", "field").agg(F.count_if(F.col("k") == 0).alias("n"))
    files = counted.groupBy("path").agg(F.sum("n").alias("n"), F.array_sort(F.collect_list("field")).alias("fields"))
    return {r.path: (r.n, r.fields) for r in files.collect()}


def _layout(schema: str | None, fields: list[str]) -> str | None:
    """What files must share to be read together: the schema of all variants, and the fields of the other objects."""
    return "\n".join([schema or "", *fields]) if schema or fields else None


def _lines(spark: SparkSession, paths: str | Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    lines = read_texts(spark, paths, encoding).withColumn("v", F.try_parse_json("value"))
    return lines.withColumn("unsure", _unsure(F.col("value"), F.col("v")))


def line_shapes(spark: SparkSession, paths: str | Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """Per file: filled lines, how many are objects or unsure, encoding and layout; splittable."""
    is_object = F.coalesce(_is_object(F.col("v")), F.lit(False))
    return (
        _lines(spark, paths, encoding)
        .withColumns({"utf8": F.col("valid"), "filled": F.col("value").rlike(r"\S"), "object": is_object})
        .groupBy("path")
        .agg(
            F.count_if("filled").alias("lines"),
            F.count_if(F.col("filled") & F.col("object")).alias("objects"),
            F.bool_and("utf8").alias("utf8"),
            F.count_if("unsure").alias("unsure"),
            F.schema_of_variant_agg(F.when(F.col("object"), F.col("v"))).alias("layout"),
        )
    )


def _documents(spark: SparkSession, paths: str | Sequence[str], records_path: str | None = None, encoding: str = "UTF-8") -> DataFrame:
    """One row per file and record, or one for a file without: ``(path, shape, records_path, error, value, v)``.

    A document is one value and cannot be split, so each is parsed in one task,
    as Spark's own multi-line reader does.
    """
    docs = read_texts(spark, paths, encoding, wholetext=True).select("path", F.col("value").alias("document"))
    # Functions that read the text as a stream: a parsed variant has a size limit.  What several
    # columns need is a column itself, so a document is not parsed again for each of them.
    docs = docs.withColumns({"size": F.json_array_length("document"), "own_keys": F.json_object_keys("document")})
    is_array, is_object = F.col("size").isNotNull(), F.col("own_keys").isNotNull()

    def members(text: Column) -> Column:
        return F.from_json(text, "array<string>", ANY_LENGTH)

    def all_objects(values: Column) -> Column:
        return F.coalesce(F.forall(values, lambda x: x.isNotNull() & F.json_object_keys(x).isNotNull()), F.lit(False))

    if records_path:
        inner = F.get_json_object("document", f"$.{records_path}")
        docs = docs.withColumn("inner", F.when(is_object, inner)).withColumn("records", members(F.when(is_array, F.col("document")).otherwise(F.col("inner"))))
        listed = F.json_array_length("inner").isNotNull()
        found = F.when(listed, F.lit(records_path))
        nested_error = F.when(F.col("inner").isNull(), f"Path '{records_path}' not found in JSON").when(
            ~listed, f"Path '{records_path}' is not an array"
        )
    else:
        # Preferred keys first, then the file's own order.
        docs = docs.withColumn("entries", F.when(is_object, F.from_json("document", "map<string,string>", ANY_LENGTH)))
        keys = F.array_union(F.array(*map(F.lit, RECORD_KEYS)), F.col("own_keys"))

        def holds_records(k: Column) -> Column:
            inner = F.try_element_at(F.col("entries"), k)
            return F.coalesce((F.json_array_length(inner) > 0) & all_objects(members(inner)), F.lit(False))

        docs = docs.withColumn("found", F.when(is_object, F.get(F.filter(keys, holds_records), F.lit(0))))
        docs = docs.withColumn("records", members(F.when(is_array, F.col("document")).otherwise(F.try_element_at("entries", F.col("found")))))
        found = F.col("found")
        nested_error = F.when(
            found.isNull(), "No records array found. Specify records_path or use array format"
        )
    error = (
        F.when(~F.col("document").rlike(r"\S"), "File is empty")
        .when(is_array & (F.col("size") == 0), "Empty JSON array")
        .when(is_array & ~all_objects(F.col("records")), "Array must contain only objects")
        .when(is_object, nested_error)
        .when(~is_array & F.col("document").rlike(r"^\s*(?:\"(?:[^\"\\\\]|\\\\.)*\"|-?[0-9][0-9.eE+-]*|true|false|null)\s*$"), "JSON must be an array or object")
        .when(~is_array, "Invalid JSON")
    )
    shape = F.when(is_array, "array").when(is_object, "nested")
    told = docs.select("path", shape.alias("shape"), F.when(is_object, found).alias("records_path"), error.alias("error"), "records")
    each = told.select("path", "shape", "records_path", "error", F.explode_outer("records").alias("value"))
    return each.withColumn("v", F.try_parse_json("value"))


def document_shapes(
    spark: SparkSession, paths: str | Sequence[str], records_path: str | None = None, encoding: str = "UTF-8"
) -> DataFrame:
    """Shape of files that are one JSON document: ``(path, shape, records_path, error, layout, unsure)``."""
    return (
        _documents(spark, paths, records_path, encoding)
        .groupBy("path", "shape", "records_path", "error")
        .agg(F.schema_of_variant_agg("v").alias("layout"), F.count_if(_unsure(F.col("value"), F.col("v"))).alias("unsure"))
    )


JSON_FILES = "path string, shape string, records_path string, error string, layout string"


def json_files(
    spark: SparkSession, paths: str | Sequence[str], records_path: str | None = None, encoding: str = "UTF-8"
) -> DataFrame:
    """One row per file: ``(path, shape, records_path, error, layout)``.

    ``layout`` tells files of different fields apart.  It is gathered record by
    record, so no size of a file or a record changes it: variants are merged by
    their schema, and the few objects that are none add their field paths.

    Files whose filled lines are all objects are NDJSON, without parsing any
    of them whole; a single object only counts as such in an ``.ndjson`` file.
    A file in which most lines are objects is NDJSON with bad lines, and refused.
    """
    lines = line_shapes(spark, paths, encoding).collect()

    def by_line(r, objects: int) -> bool:
        return r.path.lower().endswith(".ndjson") or (objects > 1 and 2 * objects > r.lines)

    doubtful = [r.path for r in lines if r.unsure and by_line(r, r.objects + r.unsure)]
    sure = _settled(_lines(spark, doubtful, encoding).where("unsure")) if doubtful else {}
    out, rest = [], []
    for r in lines:
        more, fields = sure.get(r.path, (0, []))
        objects = r.objects + more
        if r.utf8 and r.lines and not by_line(r, objects):
            rest.append(r.path)
            continue
        error = None
        if not r.utf8:
            error = "Invalid encoding"
        elif not r.lines:
            error = "File is empty"
        elif objects < r.lines:
            error = f"{r.lines - objects} lines are not JSON objects"
        out.append((r.path, "ndjson", None, error, _layout(r.layout, fields)))
    if rest:
        found = document_shapes(spark, rest, records_path, encoding).collect()
        doubtful = [r.path for r in found if r.unsure and not r.error]
        sure = {}
        if doubtful:
            records = _documents(spark, doubtful, records_path, encoding)
            sure = _settled(records.where(_unsure(F.col("value"), F.col("v"))))
        out += [(r.path, r.shape, r.records_path, r.error, _layout(r.layout, sure.get(r.path, (0, []))[1])) for r in found]
    return spark.createDataFrame(out, JSON_FILES)


def reader_options(encoding: str = UTF8, multi_line: bool = False) -> dict[str, str]:
    """How Spark's reader is told the charset; it asks for a line separator with any but its own."""
    own = encoding.upper().replace("_", "-") == UTF8
    lines = {"multiLine": "true"} if multi_line else {} if own else {"lineSep": "\n"}
    return ANY_LENGTH | lines | ({} if own else {"encoding": encoding})


def read_ndjson(spark: SparkSession, paths: str | Sequence[str], flatten: bool = True) -> DataFrame:
    df = spark.read.options(**ANY_LENGTH).json(paths)
    return flatten_structs(df) if flatten else df


def read_json(
    spark: SparkSession,
    paths: str | Sequence[str],
    records_path: str | None = None,
    flatten: bool = True,
) -> DataFrame:
    """A file that is an array of objects, or an object holding one at ``records_path``."""
    df = spark.read.options(**ANY_LENGTH, multiLine=True).json(paths)
    if records_path:
        df = df.select(F.explode(F.col(records_path)).alias("rec")).select("rec.*")
    return flatten_structs(df) if flatten else df


def write_ndjson(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_json(df: DataFrame, path: str, records_path: str | None = None, mode: str = "error") -> None:
    """Each part file is one complete document: an array, or ``{path: array}``.

    Rows are turned into JSON in the JVM; the Python side only puts brackets and
    commas around a stream of lines, never holding more than a batch.
    """
    head, tail = ("[", "]")
    if records_path:
        head, tail = '{"' + records_path + '": [', "]}"

    def bracket(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = True
        for batch in batches:
            lines = batch["value"].tolist()
            if not lines:
                continue
            body = ([head + lines[0]] if first else ["," + lines[0]]) + ["," + x for x in lines[1:]]
            first = False
            yield pd.DataFrame({"value": body})
        yield pd.DataFrame({"value": [head + tail if first else tail]})

    rows = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    rows.mapInPandas(bracket, "value string").write.mode(mode).text(path)
