"""CSV: per-file line statistics, delimiter choice, gates and reading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cloakframe.sources.lake import is_wide, read_texts, source_path

# Delimiters a file may use, in order of preference, and the
# share of lines that must agree with the header for one to be chosen.
DELIMITERS = (",", ";", "\t", "|")
AGREEMENT = 0.9

BAD_ROW = "_bad_row"


COUNTS = [f"n{i}" for i in range(len(DELIMITERS))]


def line_profile(spark: SparkSession, paths: str | Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """Lines grouped by file, block and number of each delimiter outside quotes.

    A regular file has a handful of groups per block, however long it is, so
    the shuffle is small.  ``first_line`` is the first of the group's lines.
    """
    line = F.col("value")
    unquoted = F.regexp_replace(line, '"[^"]*"', "")

    def occurrences(text: Column, what: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))

    lines = (
        read_texts(spark, paths, encoding)
        .select(
            "path",
            "block",
            F.monotonically_increasing_id().alias("line"),
            "value",
            F.col("valid").alias("utf8"),
            (occurrences(line, '"') % 2 == 1).alias("odd_quotes"),
            unquoted.alias("unquoted"),
            line.rlike(r"\S").alias("filled"),
        )
        .withColumns({n: occurrences(F.col("unquoted"), d) for n, d in zip(COUNTS, DELIMITERS)})
    )
    first_of_file = F.when(F.col("block") == 0, F.col("value"))
    return lines.groupBy("path", "block", *COUNTS, "filled").agg(
        F.count("*").alias("lines"),
        F.min("line").alias("first_line"),
        F.min_by(first_of_file, "line").alias("header"),
        F.bool_and("utf8").alias("utf8"),
        F.bool_or("odd_quotes").alias("odd_quotes"),
    )


def csv_files(
    spark: SparkSession, paths: str | Sequence[str], delimiter: str = ",", encoding: str = "UTF-8"
) -> DataFrame:
    """One row per file: delimiter, header, whether records span lines, and the
    reason to refuse it.

    ``(path, delimiter, header, multi_line, lines, error)``.  A delimiter is
    chosen when at least 90 % of the file's lines have as many as the header;
    otherwise the configured one is used.  After the line profile everything
    works on groups of equal lines.
    """
    groups = line_profile(spark, paths, encoding)
    top = F.struct(*COUNTS, "filled", "header")
    heads = groups.groupBy("path").agg(F.min_by(top, F.struct("block", "first_line")).alias("top"))
    with_head = groups.join(heads, "path")

    def same_as_head(n: str) -> Column:
        return (F.col(f"top.{n}") > 0) & (F.col(n) == F.col(f"top.{n}"))

    files = with_head.groupBy("path", "top").agg(
        F.sum("lines").alias("all_lines"),
        F.bool_and("utf8").alias("utf8"),
        F.bool_or("odd_quotes").alias("odd_quotes"),
        F.bool_or("filled").alias("any_filled"),
        *[F.sum(F.when(same_as_head(n), F.col("lines")).otherwise(0)).alias(f"agree_{n}") for n in COUNTS],
    )
    agree = [F.col(f"agree_{n}") / F.col("all_lines") for n in COUNTS]
    best = F.greatest(*agree)
    pick = F.when(best < AGREEMENT, F.lit(DELIMITERS.index(delimiter) if delimiter in DELIMITERS else 0))
    for i, share in enumerate(agree):
        pick = pick.when(share == best, F.lit(i))
    files = files.withColumn("pick", pick)

    def width(prefix: str) -> Column:
        return F.element_at(F.array(*[F.col(prefix + n) for n in COUNTS]), F.col("pick") + 1) + 1

    # A line's row in the file: lines of earlier blocks + its place in the block.
    blocks = groups.groupBy("path", "block").agg(
        F.sum("lines").alias("block_lines"), F.min("first_line").alias("block_first")
    )
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("block_lines").over(earlier), F.lit(0)))
    ragged = (
        groups.join(files.select("path", "pick", "top"), "path")
        .filter(~F.col("filled") | (width("") != width("top.")))
        .join(blocks, ["path", "block"])
        .select(
            "path",
            (F.col("before") + F.col("first_line") - F.col("block_first") + 1).alias("row"),
            F.when(F.col("filled"), width("")).otherwise(0).alias("columns"),
        )
        .groupBy("path")
        .agg(F.min(F.struct("row", "columns")).alias("bad"))
    )
    error = (
        F.when(~F.col("utf8"), "Invalid encoding")
        .when(~F.col("any_filled"), "File is empty")
        .when(~F.col("top.filled"), "No columns found in header")
        .when(
            ~F.col("odd_quotes") & F.col("bad").isNotNull(),
            F.format_string(
                "Row %d has %d columns, expected %d", F.col("bad.row"), F.col("bad.columns"), width("top.")
            ),
        )
    )
    return files.join(ragged, "path", "left").select(
        "path",
        F.element_at(F.array(*map(F.lit, DELIMITERS)), F.col("pick") + 1).alias("delimiter"),
        F.col("top.header").alias("header"),
        F.col("odd_quotes").alias("multi_line"),
        F.col("all_lines").alias("lines"),
        error.alias("error"),
    )


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    delimiter: str = ",",
    encoding: str = "UTF-8",
    multi_line: bool = True,
    columns: Sequence[str] | None = None,
    mark_bad_rows: bool = False,
    with_path: str | None = None,
) -> DataFrame:
    """CSV with a header, all columns text, '' for empty, names trimmed.

    Pass ``multi_line=False`` for files without line breaks inside quotes: only
    then can Spark split a file over tasks.  ``mark_bad_rows`` adds the raw
    text of rows whose width differs from the header, ``with_path`` a column
    with the file of each row.
    """
    reader = (
        spark.read.option("header", True)
        .option("sep", delimiter)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line or is_wide(encoding))
        .option("mode", "PERMISSIVE")
    )
    if columns is None:
        columns = reader.option("inferSchema", False).csv(paths).columns
    names = [c.strip() for c in columns]
    fields = [T.StructField(c, T.StringType()) for c in names]
    if mark_bad_rows:
        fields.append(T.StructField(BAD_ROW, T.StringType()))
        reader = reader.option("columnNameOfCorruptRecord", BAD_ROW)
    raw = reader.option("enforceSchema", True).schema(T.StructType(fields)).csv(paths)
    out = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in names]
    path = [source_path().alias(with_path)] if with_path else []
    return raw.select(*out, *([BAD_ROW] if mark_bad_rows else []), *path)


def write_csv(df: DataFrame, path: str, delimiter: str = ",", mode: str = "error") -> None:
    """Header, quotes only where needed, comma unless told otherwise."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("sep", delimiter)
        .option("quote", '"')
        .option("escape", '"')
        .option("quoteAll", False)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", "")
        .option("nullValue", "")
        .csv(path)
    )
