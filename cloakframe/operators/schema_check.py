"""Did protection keep the shape of a table?  Issues as rows."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISSUE_SCHEMA = "severity string, message string, column string, details map<string,string>"
ERROR, WARNING, INFO = "error", "warning", "info"


def widening_allowed(before: T.DataType, after: T.DataType) -> bool:
    """Anything but a boolean may become text; numbers may become other numbers."""
    if isinstance(after, T.StringType):
        return not isinstance(before, T.BooleanType)
    return isinstance(before, T.NumericType) and isinstance(after, T.NumericType)


def schema_issues(original: T.StructType, protected: T.StructType, strict: bool) -> list[tuple]:
    """Issues that follow from the two schemas alone."""
    before = {f.name: f.dataType for f in original.fields}
    after = {f.name: f.dataType for f in protected.fields}
    issues = []
    for name in before:
        if name not in after:
            issues.append((ERROR, f"Column '{name}' missing in protected data", name, {"type": "missing_column"}))
    for name in after:
        if name not in before:
            issues.append((WARNING, f"Extra column '{name}' in protected data", name, {"type": "extra_column"}))
    kept = [n for n in before if n in after]
    if kept != [n for n in after if n in before]:
        orders = {"original_order": json.dumps(list(before)), "protected_order": json.dumps(list(after))}
        issues.append((WARNING, "Column order differs from original", None, orders))
    for name in kept:
        if before[name] == after[name]:
            continue
        a, b = before[name].simpleString(), after[name].simpleString()
        details = {"original_type": a, "protected_type": b}
        if strict:
            issues.append((ERROR, f"Type mismatch for '{name}': {a} -> {b}", name, details))
        elif widening_allowed(before[name], after[name]):
            issues.append((INFO, f"Type widened for '{name}': {a} -> {b}", name, details))
        else:
            issues.append((WARNING, f"Unexpected type change for '{name}': {a} -> {b}", name, details))
    return issues


def fingerprint(df: DataFrame, nulls: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Rows and nulls per column in one aggregation: ``(*by, column, rows, nulls)``.

    ``nulls`` has a condition per column that tells its nulls; the entry with the empty name counts rows alone.
    """
    counts = [F.count_if(c).alias(f"c{i}") for i, c in enumerate(nulls.values())]
    one = df.groupBy(*by).agg(F.count("*").alias("rows"), *counts)
    entries = [F.struct(F.lit("").alias("column"), F.lit(0).cast("bigint").alias("nulls"))]
    entries += [F.struct(F.lit(n).alias("column"), F.col(f"c{i}").alias("nulls")) for i, n in enumerate(nulls)]
    return one.select(*by, "rows", F.inline(F.array(*entries))).select(*by, "column", "rows", "nulls")


def null_conditions(names: Sequence[str]) -> dict[str, Column]:
    return {n: F.col("`" + n.replace("`", "``") + "`").isNull() for n in names}


def content_issues(before: DataFrame, after: DataFrame, by: Sequence[str] = (), validate_row_count: bool = True) -> DataFrame:
    """Issues ``(*by, severity, message, column, details)`` from two fingerprints.

    A group that only one of them has counts as one without rows in the other.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*by, "column", F.col("rows").alias(f"{name}_rows"), F.col("nulls").alias(f"{name}_nulls"))

    both = side(before, "original").join(side(after, "protected"), [*by, "column"], "full").na.fill(
        0, ["original_rows", "protected_rows", "original_nulls", "protected_nulls"]
    )

    def details(kind: str) -> Column:
        return F.create_map(
            F.lit(f"original_{kind}"), F.col(f"original_{kind}").cast("string"),
            F.lit(f"protected_{kind}"), F.col(f"protected_{kind}").cast("string"),
        ).alias("details")

    gained = both.filter("column <> '' AND original_nulls = 0 AND protected_nulls > 0").select(
        *by,
        F.lit(WARNING).alias("severity"),
        F.format_string("Column '%s' gained null values after protection", "column").alias("message"),
        "column",
        details("nulls"),
    )
    if not validate_row_count:
        return gained
    rows = both.filter("column = '' AND original_rows <> protected_rows").select(
        *by,
        F.lit(ERROR).alias("severity"),
        F.format_string("Row count mismatch: %d -> %d", "original_rows", "protected_rows").alias("message"),
        F.lit(None).cast("string").alias("column"),
        details("rows"),
    )
    return gained.unionByName(rows)


def schema_check(
    original: DataFrame,
    protected: DataFrame,
    strict_types: bool = False,
    allow_type_widening: bool = True,
    validate_row_count: bool = True,
) -> DataFrame:
    """All differences as ``(severity, message, column, details)``.

    Schemas are compared on the driver, contents by one aggregation per table.
    """
    if strict_types == allow_type_widening:
        raise ValueError("exactly one of strict_types and allow_type_widening must be set")
    spark = original.sparkSession
    fixed = spark.createDataFrame(
        schema_issues(original.schema, protected.schema, strict_types), ISSUE_SCHEMA
    )
    shared = null_conditions([c for c in original.columns if c in set(protected.columns)])
    return fixed.unionByName(content_issues(fingerprint(original, shared), fingerprint(protected, shared), (), validate_row_count))


def is_valid(issues: DataFrame) -> DataFrame:
    """One row: valid unless there is an error, and the number of each severity."""
    return issues.agg(
        (F.count_if(F.col("severity") == ERROR) == 0).alias("is_valid"),
        F.count_if(F.col("severity") == ERROR).alias("errors"),
        F.count_if(F.col("severity") == WARNING).alias("warnings"),
        F.count_if(F.col("severity") == INFO).alias("infos"),
    )


def column_differences(tables: DataFrame) -> DataFrame:
    """Set differences of two column-name lists per row: ``original``, ``protected``."""
    common = F.array_intersect("original", "protected")
    return tables.withColumns(
        {
            "missing": F.array_except("original", "protected"),
            "extra": F.array_except("protected", "original"),
            "same_order": common == F.array_intersect("protected", "original"),
        }
    )
