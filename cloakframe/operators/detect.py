"""Scanning tables: findings per cell, the entity table and its summaries."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cloakframe.functions.recognizers import Recognizer, default_recognizers
from cloakframe.functions.spans import MODEL_SPAN_TYPE, find_spans

CELLS = "__cf_cells"  # array<struct<text, model>> with one element per scanned column

# model(batch of texts) -> one list per text of (entity_type, start, end, score)
Model = Callable[[pd.Series], pd.Series]


@dataclass(frozen=True)
class Detector:
    """What to look for and how sure to be.

    ``entities`` limits the types; ``recognizers`` replaces or extends the
    defaults; ``model`` adds findings of a language model, run in Arrow batches
    (load the model lazily inside it, so each Python worker does it once).
    """

    threshold: float = 0.7
    entities: tuple[str, ...] | None = None
    recognizers: tuple[Recognizer, ...] = tuple(default_recognizers())
    model: Model | None = None

    def active(self) -> tuple[Recognizer, ...]:
        if self.entities is None:
            return self.recognizers
        return tuple(r for r in self.recognizers if r.entity_type in self.entities)

    def spans(self, text: Column) -> Column:
        """Findings of one text column (without the model)."""
        return find_spans(text, self.active(), self.threshold)

    def model_column(self, text: Column) -> Column:
        if self.model is None:
            return F.lit(None).cast(MODEL_SPAN_TYPE)
        wanted = F.lit(None).cast("array<string>") if self.entities is None else F.array(*map(F.lit, self.entities))
        model = self.model

        def run(texts: pd.Series) -> pd.Series:
            return model(texts)

        found = F.pandas_udf(run, MODEL_SPAN_TYPE)(text)
        return F.filter(found, lambda s: wanted.isNull() | F.array_contains(wanted, s.entity_type))


def with_recognizers(extra: Sequence[Recognizer], **kwargs) -> Detector:
    """The default recognizers plus ``extra``; entity types must stay unique."""
    everything = (*default_recognizers(), *extra)
    names = [r.entity_type for r in everything]
    twice = {n for n in names if names.count(n) > 1}
    if twice:
        raise ValueError(f"more than one recognizer for {sorted(twice)}")
    return Detector(recognizers=everything, **kwargs)


def text_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Columns to scan: all string columns, or the given ones that exist."""
    if columns is None:
        return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    present = set(df.columns)
    return [c for c in columns if c in present]


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def with_cells(df: DataFrame, names: Sequence[str], detector: Detector) -> DataFrame:
    """Gather the scanned columns into one array.

    The detection expression is then compiled once, however wide the table.
    Cells that are not text count as scanned but hold nothing to scan.
    """
    types = {f.name: f.dataType for f in df.schema}
    if not names:
        return df.withColumn(CELLS, F.array().cast(f"array<struct<text:string,model:{MODEL_SPAN_TYPE}>>"))

    def cell(name: str) -> Column:
        text = quoted(name) if isinstance(types[name], T.StringType) else F.lit(None).cast("string")
        return F.struct(text.alias("text"), detector.model_column(text).alias("model"))

    return df.withColumn(CELLS, F.array(*map(cell, names)))


@lru_cache(maxsize=64)
def _cached_spans(recognizers: tuple[Recognizer, ...], threshold: float, with_model: bool) -> Column:
    # Building thousands of expression nodes takes longer than many queries;
    # the result only names the fixed cells column, so it can be used again.
    return F.transform(
        F.col(CELLS),
        lambda c: find_spans(c.text, recognizers, threshold, c.model if with_model else None),
    )


def spans_of_cells(detector: Detector) -> Column:
    """``array<array<span>>`` aligned with the cells."""
    return _cached_spans(detector.active(), detector.threshold, detector.model is not None)


def detect(
    df: DataFrame,
    key: str | Sequence[str],
    detector: Detector = Detector(),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The entity table: one row per finding, with the key of its row.

    Narrow: no shuffle, and only the key and the scanned columns are read.
    """
    keys = [key] if isinstance(key, str) else list(key)
    names = text_columns(df, columns)
    slim = df.select(*[quoted(c) for c in dict.fromkeys([*keys, *names])])
    cells = with_cells(slim, names, detector)
    labels = F.array(*map(F.lit, names)) if names else F.array().cast("array<string>")
    found = F.flatten(
        F.zip_with(
            labels,
            spans_of_cells(detector),
            lambda name, spans: F.transform(
                spans,
                lambda s: F.struct(
                    name.alias("column_name"),
                    s.entity_type.alias("entity_type"),
                    s.text.alias("text"),
                    s.start.alias("start"),
                    s.end.alias("end"),
                    s.score.alias("score"),
                    s.ord.alias("ord"),
                ),
            ),
        )
    )
    return cells.select(*[quoted(k) for k in keys], F.explode(found).alias("_f")).select(
        *[quoted(k) for k in keys], "_f.*"
    )


def detection_counts(
    df: DataFrame, detector: Detector = Detector(), columns: Sequence[str] | None = None
) -> DataFrame:
    """``(column_name, entity_type, entities, cells, cells_with_pii)``, one scan.

    Rows with a null type carry the cell counters of a column; the others count
    findings.  Partial aggregation leaves at most columns x (types + 1) rows
    per task for the shuffle.
    """
    names = text_columns(df, columns)
    cells = with_cells(df.select(*map(quoted, names)), names, detector)
    per_cell = F.zip_with(
        F.array(*map(F.lit, names)) if names else F.array().cast("array<string>"),
        spans_of_cells(detector),
        lambda name, spans: F.concat(
            F.array(
                F.struct(
                    name.alias("column_name"),
                    F.lit(None).cast("string").alias("entity_type"),
                    F.lit(0).alias("entities"),
                    F.lit(1).alias("cells"),
                    F.when(F.size(spans) > 0, 1).otherwise(0).alias("hits"),
                )
            ),
            F.transform(
                spans,
                lambda s: F.struct(
                    name.alias("column_name"),
                    s.entity_type.alias("entity_type"),
                    F.lit(1).alias("entities"),
                    F.lit(0).alias("cells"),
                    F.lit(0).alias("hits"),
                ),
            ),
        ),
    )
    return (
        cells.select(F.explode(F.flatten(per_cell)).alias("c"))
        .groupBy("c.column_name", "c.entity_type")
        .agg(
            F.sum("c.entities").alias("entities"),
            F.sum("c.cells").alias("cells"),
            F.sum("c.hits").alias("cells_with_pii"),
        )
    )


def detection_summary(
    df: DataFrame, detector: Detector = Detector(), columns: Sequence[str] | None = None
) -> DataFrame:
    """One row: counts per type, columns with findings, cells scanned and hit."""
    hit = F.when(F.col("cells_with_pii") > 0, F.col("column_name"))
    by_type = (
        detection_counts(df, detector, columns)
        .groupBy("entity_type")
        .agg(
            F.sum("entities").alias("n"),
            F.collect_set(hit).alias("hit_columns"),
            F.sum("cells").alias("cells"),
            F.sum("cells_with_pii").alias("hits"),
        )
    )
    entry = F.when(F.col("entity_type").isNotNull(), F.struct("entity_type", "n"))
    # At most one row per entity type gets here.
    return by_type.agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("entity_counts"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_entities"),
        F.array_sort(F.flatten(F.collect_list("hit_columns"))).alias("columns_with_pii"),
        F.coalesce(F.sum("cells"), F.lit(0)).alias("cells_scanned"),
        F.coalesce(F.sum("hits"), F.lit(0)).alias("cells_with_pii"),
    )
