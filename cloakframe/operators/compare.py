"""Tables side by side, accuracy against labels, repeatability."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def changed_cells(original: DataFrame, protected: DataFrame, key: str) -> DataFrame:
    """``(column_name, rows, changed)`` over the columns both tables have."""
    names = [c for c in original.columns if c in set(protected.columns) and c != key]
    o = original.select(key, *[F.col(f"`{n}`").alias(f"o{i}") for i, n in enumerate(names)])
    p = protected.select(key, *[F.col(f"`{n}`").alias(f"p{i}") for i, n in enumerate(names)])
    counted = o.join(p.hint("merge"), key).agg(  # rows of both sides, never to be broadcast
        F.count("*").alias("rows"),
        *[F.count_if(~F.col(f"o{i}").eqNullSafe(F.col(f"p{i}"))).alias(f"c{i}") for i in range(len(names))],
    )
    rows = F.array(
        *[F.struct(F.lit(n).alias("column_name"), "rows", F.col(f"c{i}").alias("changed")) for i, n in enumerate(names)]
    )
    return counted.select(F.inline(rows))


def preview(original: DataFrame, protected: DataFrame, key: str, columns: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows by key, original next to protected.

    Top-n runs on the original before the join, so the join sees n rows.
    """
    first = original.orderBy(key).limit(n).select(key, *[F.col(c).alias(f"{c}_original") for c in columns])
    return F.broadcast(first).join(protected.select(key, *[F.col(c).alias(f"{c}_protected") for c in columns]), key)


def confusion(labels: DataFrame, entities: DataFrame, keys: Sequence[str]) -> DataFrame:
    """True positives, false positives and false negatives per entity type.

    ``labels`` has ``keys``, ``entity_type`` and ``is_pii``; ``entities`` is an
    entity table with the same keys.  Spark takes findings, which are exploded cells, for far smaller
    than they are, so the join is asked to sort and not to broadcast.
    """
    on = [*keys, "entity_type"]
    found = entities.select(*on).distinct().withColumn("detected", F.lit(True))
    hit = F.coalesce("detected", F.lit(False))
    return (
        labels.join(found.hint("merge"), on, "left")
        .groupBy("entity_type")
        .agg(
            F.count_if(F.col("is_pii") & hit).alias("tp"),
            F.count_if(~F.col("is_pii") & hit).alias("fp"),
            F.count_if(F.col("is_pii") & ~hit).alias("fn"),
        )
    )


def accuracy(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1; 0 where a denominator is 0."""

    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns({"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn)}).withColumn(
        "f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    )


def consistency(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Over repeated runs (``run`` column) of one detection, per row.

    ``type_sets`` is 1 when all runs found the same types, ``score_spread`` the
    largest difference between runs of the best score of a type.
    """
    per_type = runs.groupBy(*keys, "run", "entity_type").agg(
        F.max("score").alias("best"), F.count("*").alias("n")
    )
    spread = per_type.groupBy(*keys, "entity_type").agg((F.max("best") - F.min("best")).alias("spread"))
    types = per_type.groupBy(*keys, "run").agg(
        F.array_sort(F.collect_list(F.struct("entity_type", "n"))).alias("types")
    )
    return (
        types.groupBy(*keys)
        .agg(F.count_distinct("types").alias("type_sets"), F.count("*").alias("runs"))
        .join(spread.groupBy(*keys).agg(F.max("spread").alias("score_spread")), list(keys))
    )


def bench_stats(runs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean, min and max milliseconds and MB/s of timed runs (``ms``, ``bytes``)."""
    return runs.groupBy(*by).agg(
        F.count("*").alias("runs"),
        F.avg("ms").alias("mean_ms"),
        F.min("ms").alias("min_ms"),
        F.max("ms").alias("max_ms"),
        F.coalesce(
            F.try_divide(F.sum("bytes") / F.lit(1_000_000.0), F.sum("ms") / F.lit(1000.0)), F.lit(0.0)
        ).alias("mb_per_s"),
    )


def scaling_factor(small_rows: int, small_ms: float, large_rows: int, large_ms: float) -> float:
    """Time ratio over row ratio: 1.0 is linear."""
    return (large_ms / small_ms) / (large_rows / small_rows)
