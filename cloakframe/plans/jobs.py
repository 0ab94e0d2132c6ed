"""File jobs: a lake folder in, a protected folder, quarantine and audit out."""

from __future__ import annotations

import datetime as dt
import re
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cloakframe.operators.detect import Detector
from cloakframe.operators.protect import FINDINGS, token_pairs_of
from cloakframe.operators.schema_check import ERROR, ISSUE_SCHEMA, content_issues, fingerprint, null_conditions, schema_issues
from cloakframe.operators.vault import append_pairs
from cloakframe.plans import audit as audit_log
from cloakframe.plans.layout import partition_folder, partition_value
from cloakframe.plans.policy import Policy
from cloakframe.plans.scratch import children, exists, qualified, remove, scratch_path
from cloakframe.plans.secrets import Secrets
from cloakframe.sources import csv as csv_source
from cloakframe.sources import json as json_source
from cloakframe.sources import lake
from cloakframe.sources import parquet as parquet_source

SOURCE = "_source"
ROW_RESULTS = "_pairs"
NULLS = "_nulls"


@dataclass(frozen=True)
class Group:
    """Files read together: same format, same layout."""

    format: str
    paths: tuple[str, ...]
    delimiter: str = ","
    header: str = ""
    multi_line: bool = False
    shape: str = ""
    records_path: str | None = None
    layout: str = ""
    encoding: str = lake.UTF8


def gate_files(
    spark: SparkSession, path: str | Sequence[str], delimiter: str = ",", records_path: str | None = None, encoding: str = lake.UTF8
) -> tuple[list[Group], DataFrame]:
    """Groups of files that may be read, and the quarantine of those that may not.

    Contents are looked at in tasks, a job or two per format whatever the number of files; the driver
    sees one small row per file, as Spark's own file index does.
    """
    groups, refused, _ = _gated(spark, path, delimiter, records_path, encoding)
    return groups, spark.createDataFrame(refused, lake.QUARANTINE_SCHEMA)


def _gated(
    spark: SparkSession, path: str | Sequence[str], delimiter: str = ",", records_path: str | None = None, encoding: str = lake.UTF8
) -> tuple[list[Group], list[tuple[str, str, str]], dict[str, int]]:
    """Groups, refused files (path, stage, error), and the milliseconds of both gates."""
    started = time.monotonic()
    rows = lake.classify_files(spark, path).select("path", "format", "error").collect()
    received = time.monotonic()
    refused = [(r.path, "receive", r.error) for r in rows if r.error]
    by_format: dict[str, list[str]] = {}
    for r in rows:
        if not r.error:
            by_format.setdefault(r.format, []).append(r.path)
    groups: dict[Group, list[str]] = {}

    def sort_in(found: list[Row], group_of: Callable[[Row], Group]) -> None:
        for r in found:
            if r.error:
                refused.append((r.path, "validate", r.error))
            else:
                groups.setdefault(group_of(r), []).append(r.path)

    if paths := by_format.get("csv"):
        sort_in(csv_source.csv_files(spark, paths, delimiter, encoding).collect(), lambda r: Group("csv", (), encoding=encoding, delimiter=r.delimiter, header=r.header, multi_line=r.multi_line))
    if paths := by_format.get("json"):
        sort_in(json_source.json_files(spark, paths, records_path, encoding).collect(), lambda r: Group("json", (), encoding=encoding, shape=r.shape, records_path=r.records_path, layout=r.layout or ""))
    if paths := by_format.get("parquet"):
        found = parquet_source.parquet_files(spark, paths).collect()
        unopened = [r.path for r in found if not r.error and r.layout is None]
        told = [Row(path=p, error=None if layout else "Failed to read Parquet", layout=layout) for p, layout in parquet_source.schemas_of(spark, unopened)]
        sort_in([*(r for r in found if r.error or r.layout is not None), *told], lambda r: Group("parquet", (), layout=r.layout))
    took = {"receive": _ms(started, received), "validate": _ms(received)}
    return [replace(g, paths=tuple(paths)) for g, paths in groups.items()], refused, took


def _ms(start: float, end: float | None = None) -> int:
    return int(((time.monotonic() if end is None else end) - start) * 1000)


def read_group(spark: SparkSession, group: Group) -> DataFrame:
    """Rows of a group of files, with the file of each row in ``_source``.

    Where records span lines only the reader sees their width: rows of another
    width than the header's have their text in ``csv.BAD_ROW``.
    """
    paths = list(group.paths)
    path_of = lake.source_path().alias(SOURCE)
    if group.format == "csv":
        return csv_source.read_csv(spark, paths, group.delimiter, group.encoding, multi_line=group.multi_line, mark_bad_rows=group.multi_line, with_path=SOURCE)
    if group.format == "json":
        if group.shape == "ndjson":
            raw = spark.read.options(**json_source.reader_options(group.encoding)).json(paths)
            return lake.flatten_structs(raw.select("*", path_of))
        raw = spark.read.options(**json_source.reader_options(group.encoding, multi_line=True)).json(paths)
        if group.records_path:
            raw = raw.select(F.explode(F.col(group.records_path)).alias("rec"), path_of).select("rec.*", SOURCE)
            return lake.flatten_structs(raw)
        return lake.flatten_structs(raw.select("*", path_of))
    return spark.read.parquet(*paths).select("*", path_of)


def read_lake(spark: SparkSession, path: str, **options) -> dict[str, DataFrame]:
    """All readable files of a folder: one DataFrame per format.

    Files of one format with different columns are unioned by name.
    """
    groups, _ = gate_files(spark, path, **options)
    out: dict[str, DataFrame] = {}
    for g in groups:
        df = read_group(spark, g).drop(csv_source.BAD_ROW)
        out[g.format] = out[g.format].unionByName(df, allowMissingColumns=True) if g.format in out else df
    return out


def _write(df: DataFrame, group: Group, path: str, keep_delimiter: bool, compression: str = "snappy") -> None:
    """Output by source key; a key that is processed again replaces what it wrote before."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_key")
    if group.format == "csv":
        (
            writer.option("header", bool(group.header))
            .option("sep", _output_delimiter(group, keep_delimiter))
            .option("escape", '"')
            .option("emptyValue", "")
            .option("encoding", group.encoding)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(path)
        )
    elif group.format == "json":
        writer.option("ignoreNullFields", False).option("encoding", group.encoding).json(path)
    else:
        writer.option("compression", compression).parquet(path)


def _write_empty(spark: SparkSession, group: Group, schema: T.StructType, keys: list[str], path: str, keep_delimiter: bool) -> None:
    """Output of files without rows: a header, or an empty table.  JSON without records does not pass the gate."""
    folders = {k: f"{path}/{partition_folder('source_key', k)}" for k in keys}
    if group.format == "csv" and keys:
        names = [f"c{i}" for i in range(len(schema.names))]
        heads = spark.createDataFrame([(*schema.names, k) for k in keys], ", ".join(f"{n} string" for n in [*names, "source_key"]))
        _write(heads, replace(group, header=""), path, keep_delimiter)
    elif group.format == "parquet":
        for folder in folders.values():
            spark.createDataFrame([], schema).write.mode("overwrite").parquet(folder)


def _output_delimiter(group: Group, keep_delimiter: bool) -> str:
    return group.delimiter if keep_delimiter else ","


def _read_written(spark: SparkSession, group: Group, folders: list[str], keep_delimiter: bool) -> DataFrame:
    """The output of some keys as its reader sees it, with ``source_key`` from the folder's name."""
    if group.format == "csv":
        df = csv_source.read_csv(spark, folders, _output_delimiter(group, keep_delimiter), group.encoding, multi_line=group.multi_line, with_path=SOURCE)
    elif group.format == "json":
        df = spark.read.options(**json_source.reader_options(group.encoding)).json(folders).select("*", lake.source_path().alias(SOURCE))
    else:
        df = spark.read.parquet(*folders).select("*", lake.source_path().alias(SOURCE))
    return df.withColumn("source_key", partition_value(F.col(SOURCE), "source_key")).drop(SOURCE)


_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):/+"


def root_of(spark: SparkSession, path: str) -> str:
    """The input root as files are named below it, with its scheme and one slash behind that."""
    full = path if re.match(_SCHEME, path) else qualified(spark, path)
    return re.sub(_SCHEME, r"\1:/", full).rstrip("/")


def key_of(path: Column, root: str) -> Column:
    """Key of a file below the root, which is cut off once, at the start."""
    plain = F.regexp_replace(path, _SCHEME, "$1:/")
    below = F.substring(plain, F.lit(len(root) + 2), F.length(plain))
    return F.when(F.startswith(plain, F.lit(root + "/")), below).otherwise(F.element_at(F.split(plain, "/"), -1))


RESULT_SCHEMA = "source_key string, rows bigint, error string"


def protect_files(
    spark: SparkSession,
    source: str,
    target: str,
    policy: Policy,
    secrets: Secrets = Secrets(),
    detector: Detector | None = None,
    audit_path: str | None = None,
    vault_path: str | None = None,
    keep_delimiter: bool = False,
    stringify_all: bool = False,
    bucket: str = "lake",
    finish: Callable[[DataFrame], DataFrame] | None = None,
    strict_types: bool = False,
    validate_row_count: bool = True,
    compression: str = "snappy",
    files: Sequence[str] | None = None,
    request: str | None = None,
    processed_at: dt.datetime | None = None,
    **gate_options,
) -> DataFrame:
    """Protect every supported file below ``source`` (or just ``files`` of them) into ``target/protected``.

    Bad files go to ``target/quarantine`` and the others go on: a group that
    fails is halved until the files that make it fail stand alone.  Returns one
    row per file, ``source_key, rows, error``, also kept in ``target/runs``;
    ``audit.run_summary`` counts them.  Every file has an audit row.

    ``finish`` is a last step on the protected rows of each group (drop or blank a column, say); it must
    keep ``source_key``.  What was written is then read back and compared with the input, file by file:
    columns, order, types, rows and nulls.  Issues go to ``target/schema_issues``; a file with an
    issue of severity ``error`` loses its output and goes to quarantine.  ``strict_types`` makes every
    change of a type an error.

    Detection runs once per row: its result is staged as a table, from which
    the output, the vault pairs and the audit counts are read.  The stage is
    removed at the end, also after a failure; it holds vault pairs only if a
    vault is asked for.

    ``encoding`` is the charset of CSV and JSON files, in and out; bytes that are none in it send a file to
    quarantine.  ``compression`` is that of Parquet output.

    A job that is done again under the same ``request`` and ``processed_at`` replaces all it wrote before: output by
    key, and results, quarantine, issues and audit rows by request.
    """
    request = request or uuid.uuid4().hex
    root = root_of(spark, source)
    run_path, work = f"{target}/runs/run={request}", scratch_path(spark, "protected")
    aside, issues = f"{target}/quarantine/run={request}", f"{target}/schema_issues/run={request}"
    for place in (run_path, aside, issues):
        remove(spark, place)
    groups, refused, gate_ms = _gated(spark, source if files is None else list(files), **gate_options)
    quarantine = spark.createDataFrame(refused, lake.QUARANTINE_SCHEMA)

    def done(per_file: DataFrame) -> None:
        per_file = per_file.withColumn("processed_at", F.lit(processed_at) if processed_at else F.col("processed_at"))
        if audit_path:
            audit_log.audit_rows(per_file).write.mode("append").parquet(f"{work}/audit")
        per_file.select("source_key", "rows", "error").write.mode("append").parquet(run_path)

    def refuse(files: DataFrame) -> None:
        """Files (path, stage, error) that are not protected."""
        files.write.mode("append").parquet(aside)
        keys = files.select(key_of(F.col("path"), root).alias("source_key"), F.upper(F.coalesce(lake.file_format(F.col("path")), F.lit("unknown"))).alias("file_format"), "error")
        done(_audit_rows(keys, None, request, bucket, gate_ms))

    def run(group: Group) -> None:
        started = time.monotonic()
        path = f"{work}/{uuid.uuid4().hex}"
        try:
            staged, original = _stage(spark, group, root, policy, secrets, detector, stringify_all, bool(vault_path), path)
        except (PySparkException, Py4JJavaError) as error:
            if len(group.paths) > 1:
                half = len(group.paths) // 2
                for paths in (group.paths[:half], group.paths[half:]):
                    run(replace(group, paths=paths))
            else:
                refuse(spark.createDataFrame([(group.paths[0], "process", type(error).__name__)], lake.QUARANTINE_SCHEMA))
            return
        took = gate_ms | {"protect": _ms(started)}
        paths = list(group.paths)

        def turn_away(reasons: dict[str, str], stage: str) -> None:
            """Files of this group that go to quarantine after all."""
            nonlocal paths, staged
            refuse(spark.createDataFrame([(p, stage, reasons[p]) for p in sorted(reasons)], lake.QUARANTINE_SCHEMA))
            paths = [p for p in paths if p not in reasons]
            staged = staged.where(~F.col(SOURCE).isin(*reasons))

        if csv_source.BAD_ROW in staged.columns:
            bad = {r[SOURCE] for r in staged.where(F.col(csv_source.BAD_ROW).isNotNull()).select(SOURCE).distinct().collect()}
            if bad:
                turn_away(dict.fromkeys(bad, "A row has another number of columns than the header"), "validate")
        started = time.monotonic()
        final = staged.drop(FINDINGS, ROW_RESULTS, SOURCE, csv_source.BAD_ROW, NULLS)
        folder = f"{target}/protected/{group.format}"
        _write(finish(final) if finish else final, group, folder, keep_delimiter, compression)
        took["output"] = _ms(started)
        started = time.monotonic()
        before = fingerprint(staged, {n: F.get(NULLS, F.lit(i)) for i, n in enumerate(original.names)}, ["source_key", SOURCE]).persist()
        keys = {r.source_key: r[SOURCE] for r in before.select("source_key", SOURCE).distinct().collect()}
        if len(keys) < len(paths):
            seen = set(keys.values())
            bare = spark.createDataFrame([(p,) for p in paths if p not in seen], "path string").select(key_of(F.col("path"), root).alias("k"))
            _write_empty(spark, group, T.StructType([f for f in final.schema.fields if f.name != "source_key"]), [r.k for r in bare.collect()], folder, keep_delimiter)
        there = set(children(spark, folder))
        folders = [f"{folder}/{f}" for f in (partition_folder("source_key", k) for k in sorted(keys)) if f in there]
        found = _schema_check(spark, group, folders, original, before.drop(SOURCE), sorted(keys), keep_delimiter, strict_types, validate_row_count)
        found = found.persist()
        found.write.mode("append").parquet(issues)
        failed = found.where(F.col("severity") == ERROR).groupBy("source_key").agg(F.array_join(F.array_sort(F.collect_list("message")), "; ").alias("error")).collect()
        found.unpersist()
        before.unpersist()
        for r in failed:
            remove(spark, f"{folder}/{partition_folder('source_key', r.source_key)}")
        if failed:
            turn_away({keys[r.source_key]: r.error for r in failed}, "schema_check")
        took["schema_check"] = _ms(started)
        if vault_path:
            append_pairs(vault_path, staged.select(F.explode(ROW_RESULTS).alias("p")).select("p.*"))
        if paths:
            keyed = spark.createDataFrame([(p,) for p in paths], "path string").select(key_of(F.col("path"), root).alias("source_key"), F.lit(group.format.upper()).alias("file_format"), F.lit(None).cast("string").alias("error"))
            done(_audit_rows(keyed, staged, request, bucket, took))

    try:
        refuse(quarantine)
        for group in groups:
            run(group)
    finally:
        if audit_path and exists(spark, f"{work}/audit"):  # at once, as one partition of the day; also what a broken-off run has done
            audit_log.write_audit(spark.read.parquet(f"{work}/audit"), audit_path, request)
        remove(spark, work)
    return spark.read.schema(RESULT_SCHEMA).parquet(run_path)


def _stage(
    spark: SparkSession,
    group: Group,
    root: str,
    policy: Policy,
    secrets: Secrets,
    detector: Detector | None,
    stringify_all: bool,
    pairs: bool,
    path: str,
) -> tuple[DataFrame, T.StructType]:
    """Protected rows as a table, with what is null in the input, and the schema of that."""
    own = (SOURCE, "source_key", csv_source.BAD_ROW)
    raw = read_group(spark, group).withColumn("source_key", key_of(F.col(SOURCE), root))
    text = [c for c in raw.columns if c not in own]
    original = T.StructType([f for f in raw.schema.fields if f.name in text])
    raw = raw.withColumn(NULLS, F.array(*null_conditions(text).values()) if text else F.array().cast("array<boolean>"))
    if stringify_all:
        raw = lake.stringify(raw, keep=(*own, NULLS))
    done = token_pairs_of(raw, policy, secrets, detector, columns=text, pairs_column=ROW_RESULTS)
    if not pairs:
        done = done.drop(ROW_RESULTS)
    done.write.parquet(path)
    return spark.read.schema(done.schema).parquet(path), original


FILE_ISSUES = f"source_key string, {ISSUE_SCHEMA}"


def _schema_check(
    spark: SparkSession,
    group: Group,
    folders: list[str],
    original: T.StructType,
    before: DataFrame,
    keys: list[str],
    keep_delimiter: bool,
    strict_types: bool,
    validate_row_count: bool,
) -> DataFrame:
    """Issues of every file of a group: its schema, and one aggregation over what was written."""
    if not folders:
        written, after = original, before.limit(0)
    else:
        df = _read_written(spark, group, folders, keep_delimiter)
        written = T.StructType([f for f in df.schema.fields if f.name != "source_key"])
        if group.format == "json":  # an object has no order, and the reader sorts by name
            at = {n: i for i, n in enumerate(original.names)}
            written = T.StructType(sorted(written.fields, key=lambda f: at.get(f.name, len(at))))
        shared = null_conditions([n for n in original.names if n in set(written.names)])
        after = fingerprint(df, shared, ["source_key"])
    fixed = [(k, *issue) for k in keys for issue in schema_issues(original, written, strict_types)]
    shown = spark.createDataFrame(fixed, FILE_ISSUES)
    return shown.unionByName(content_issues(before.where(F.col("column").isin("", *written.names)), after, ["source_key"], validate_row_count))


def _counts(staged: DataFrame) -> DataFrame:
    """Per source_key the row count and summaries, from the findings column alone."""
    facts = F.flatten(
        F.transform(
            FINDINGS,
            lambda f: F.concat(
                F.array(F.struct(F.lit("cell").alias("kind"), f.column_name.alias("name"), F.when(F.size(f.entity_types) > 0, 1).otherwise(0).alias("n"))),
                F.transform(f.entity_types, lambda t: F.struct(F.lit("entity").alias("kind"), t.alias("name"), F.lit(1).alias("n"))),
                F.transform(
                    f.applied,
                    lambda a: F.struct(F.when(a.failed, "failure").otherwise("method").alias("kind"), a.method.alias("name"), F.lit(1).alias("n")),
                ),
            ),
        )
    )
    # Partial aggregation leaves a few dozen rows per file and task.
    counted = (
        staged.select("source_key", F.explode_outer(facts).alias("f"))
        .groupBy("source_key", "f.kind", "f.name")
        .agg(F.sum("f.n").alias("n"), F.count("f.n").alias("cells"))
    )

    def as_map(kind: str):
        entry = F.when((F.col("kind") == kind) & (F.col("n") > 0), F.struct("name", "n"))
        return F.map_from_entries(F.array_sort(F.collect_list(entry)))

    cell = F.col("kind") == "cell"
    summary = counted.groupBy("source_key").agg(
        as_map("entity").alias("entity_counts"),
        F.array_sort(F.collect_set(F.when(cell & (F.col("n") > 0), F.col("name")))).alias("columns_with_pii"),
        F.coalesce(F.sum(F.when(cell, F.col("cells"))), F.lit(0)).alias("cells_scanned"),
        F.coalesce(F.sum(F.when(cell, F.col("n"))), F.lit(0)).alias("cells_with_pii"),
        as_map("method").alias("methods_used"),
        F.coalesce(F.sum(F.when(F.col("kind") == "method", F.col("n"))), F.lit(0)).alias("applied"),
        F.coalesce(F.sum(F.when(F.col("kind") == "failure", F.col("n"))), F.lit(0)).alias("failures"),
    )
    rows = staged.groupBy("source_key").agg(F.count("*").alias("rows"))
    return rows.join(summary, "source_key")


def _audit_rows(keys: DataFrame, staged: DataFrame | None, request: str, bucket: str, stages: dict[str, int]) -> DataFrame:
    """One row per file of ``keys`` (source_key, file_format, error), also for files without rows."""
    if staged is not None:
        keys = keys.join(_counts(staged), "source_key", "left")
    else:
        keys = keys.withColumns(
            {c: F.lit(None).cast(kind) for c, kind in (
                ("rows", "bigint"), ("entity_counts", "map<string,bigint>"), ("columns_with_pii", "array<string>"), ("cells_scanned", "bigint"),
                ("cells_with_pii", "bigint"), ("methods_used", "map<string,bigint>"), ("applied", "bigint"), ("failures", "bigint"))}
        )
    no_map, nought = F.create_map().cast("map<string,bigint>"), F.lit(0).cast("bigint")
    stage_map = F.create_map(*(x for k, v in stages.items() for x in (F.lit(k), F.lit(v).cast("bigint")))) if stages else no_map
    return keys.select(
        "source_key",
        F.coalesce("rows", nought).alias("rows"),
        F.lit(request).alias("request_id"),
        F.lit(bucket).alias("source_bucket"),
        F.when(F.col("error").isNull(), F.concat(F.lit("protected/"), "source_key")).alias("secure_key"),
        "file_format",
        F.col("error").isNull().alias("success"),
        F.lit(sum(stages.values())).cast("bigint").alias("duration_ms"),
        F.current_timestamp().alias("processed_at"),
        F.struct(
            F.coalesce("entity_counts", no_map).alias("entity_counts"),
            F.coalesce("columns_with_pii", F.array().cast("array<string>")).alias("columns_with_pii"),
            F.coalesce("cells_scanned", nought).alias("cells_scanned"),
            F.coalesce("cells_with_pii", nought).alias("cells_with_pii"),
        ).alias("detection_summary"),
        F.struct(
            F.coalesce("applied", nought).alias("protections_applied"),
            F.coalesce("methods_used", no_map).alias("methods_used"),
            F.coalesce("failures", nought).alias("failures"),
        ).alias("protection_summary"),
        stage_map.alias("stage_durations"),
        "error",
    )
