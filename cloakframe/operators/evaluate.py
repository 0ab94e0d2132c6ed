"""From the entity table to planned actions and their statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloakframe.plans.policy import FALLBACK_PRIORITY, Policy, effective_rules, rules_frame


def evaluate(entities: DataFrame, policy: Policy) -> DataFrame:
    """Entities at or above the threshold, joined to their rule or the default.

    The rules have one row per entity type; Spark broadcasts them as long as
    their size stays under its own broadcast limit.
    """
    rules = effective_rules(rules_frame(entities.sparkSession, policy)).select(
        "entity_type", "protection_method", "options", "priority"
    )
    sure = entities.filter(F.col("score") >= F.lit(policy.confidence_threshold))
    return sure.join(rules, "entity_type", "left").withColumns(
        {
            "protection_method": F.coalesce("protection_method", F.lit(policy.default_protection)),
            "options": F.coalesce("options", policy.default_options.column()),
            "priority": F.coalesce("priority", F.lit(FALLBACK_PRIORITY)),
        }
    )


def actions_by_column(actions: DataFrame) -> DataFrame:
    """Planned actions per column, method and type.

    Grouped as counts: a list of all actions of a column would be one unbounded
    group.  The actions of a column themselves are a filter on ``column_name``.
    """
    return actions.groupBy("column_name", "protection_method", "entity_type").agg(
        F.count("*").alias("actions")
    )


def evaluation_statistics(entities: DataFrame, policy: Policy) -> DataFrame:
    """``(kind, name, n)``: total, matched, per method and per entity type.

    One pass: counted per (type, method, matched) first, then regrouped on a
    few rows.
    """
    rules = effective_rules(rules_frame(entities.sparkSession, policy)).select("entity_type", "protection_method")
    counted = (
        entities.withColumn("matched", F.col("score") >= F.lit(policy.confidence_threshold))
        .groupBy("entity_type", "matched")
        .agg(F.count("*").alias("n"))
        .join(rules, "entity_type", "left")
        .withColumn("method", F.coalesce("protection_method", F.lit(policy.default_protection)))
    )

    def fact(kind: str, name, n=F.col("n")):
        return F.struct(F.lit(kind).alias("kind"), name.alias("name"), n.alias("n"))

    none = F.lit("")
    facts = F.array_compact(
        F.array(
            fact("total", none),
            F.when(F.col("matched"), fact("matched", none)),
            F.when(F.col("matched"), fact("method", F.col("method"))),
            F.when(F.col("matched"), fact("entity_type", F.col("entity_type"))),
        )
    )
    return (
        counted.select(F.explode(facts).alias("f"))
        .groupBy("f.kind", "f.name")
        .agg(F.sum("f.n").alias("n"))
    )


def threshold_sweep(entities: DataFrame, thresholds: Sequence[float] = (0.3, 0.5, 0.7, 0.9)) -> DataFrame:
    """Entities left at each threshold, from one pass over the entity table."""
    counts = entities.agg(
        *[F.count_if(F.col("score") >= F.lit(t)).alias(f"n{i}") for i, t in enumerate(thresholds)]
    )
    rows = F.array(
        *[
            F.struct(F.lit(t).alias("threshold"), F.col(f"n{i}").alias("entities"))
            for i, t in enumerate(thresholds)
        ]
    )
    return counts.select(F.inline(rows))
