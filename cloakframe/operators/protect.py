"""Protecting whole tables: a lazy, narrow DataFrame transform."""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cloakframe.functions.hof import let
from cloakframe.functions.recognizers import Recognizer
from cloakframe.functions.rewrite import (
    ON_FAILURE,
    applied_actions,
    replace_by_offset,
    replace_everywhere,
)
from cloakframe.functions.spans import find_spans, may_hold, safe_text
from cloakframe.operators.detect import CELLS, Detector, quoted, text_columns, with_cells
from cloakframe.plans.policy import Policy
from cloakframe.plans.secrets import (
    KEY_COLUMN,
    SALT_COLUMN,
    TOKEN_KEY_COLUMN,
    Secrets,
    secret_columns,
)

RESULTS = "__cf_results"
FINDINGS = "_findings"


@lru_cache(maxsize=64)
def _cached_results(
    recognizers: tuple[Recognizer, ...],
    threshold: float,
    with_model: bool,
    policy: Policy,
    on_failure: str,
    by_offset: bool,
    detail: bool,
) -> Column:
    """``array<struct<value, entities, applied>>`` aligned with the cells; without ``detail`` the value alone."""
    rewrite = replace_by_offset if by_offset else replace_everywhere

    def result(c: Column) -> Column:
        spans = find_spans(c.text, recognizers, threshold, c.model if with_model else None)

        def with_spans(found: Column) -> Column:
            if not detail:
                return F.struct(rewrite(c.text, applied_actions(found, policy, secret_columns(), on_failure)).alias("value"))
            return let(
                applied_actions(found, policy, secret_columns(), on_failure),
                lambda applied: F.struct(
                    rewrite(c.text, applied).alias("value"),
                    found.alias("entities"),
                    applied.alias("applied"),
                ),
            )

        return let(spans, with_spans)

    return F.transform(F.col(CELLS), result)


def _cells_of_method(method: str, recognizers: tuple[Recognizer, ...], threshold: float, policy: Policy) -> Column:
    """The cells, null where no type that the policy gives to ``method`` can be found."""
    methods = {r.entity_type: r.protection_method for r in reversed(policy.effective())}
    own = [r for r in recognizers if methods.get(r.entity_type, policy.default_protection) == method]

    def cell(c: Column) -> Column:
        text = F.when(let(safe_text(c.text), lambda t: may_hold(t, own, threshold)), c.text)
        return F.struct(text.alias("text"), c.model.alias("model"))

    return F.transform(F.col(CELLS), cell)


def protected_cells(
    df: DataFrame,
    policy: Policy,
    secrets: Secrets,
    detector: Detector | None = None,
    columns: Sequence[str] | None = None,
    on_failure: str = "redact",
    by_offset: bool = False,
    detail: bool = True,
    method: str | None = None,
) -> tuple[DataFrame, list[str]]:
    """``df`` with one result per scanned column, and the names of those columns.

    With ``method``, cells in which no type of that method can be found are passed over, as null ones are:
    of the results only the actions of that method count.
    """
    if on_failure not in ON_FAILURE:
        raise ValueError(f"on_failure must be one of {ON_FAILURE}")
    secrets.check(policy.methods())
    detector = detector or Detector(threshold=policy.confidence_threshold)
    names = [
        n for n in text_columns(df, columns) if isinstance(df.schema[n].dataType, T.StringType)
    ]
    cells = with_cells(secrets.attach(df), names, detector)
    if method and names and detector.model is None:
        cells = cells.withColumn(CELLS, _cells_of_method(method, detector.active(), detector.threshold, policy))
    results = _cached_results(
        detector.active(), detector.threshold, detector.model is not None, policy, on_failure, by_offset, detail
    )
    return cells.withColumn(RESULTS, results).drop(CELLS, KEY_COLUMN, SALT_COLUMN, TOKEN_KEY_COLUMN), names


def protect(
    df: DataFrame,
    policy: Policy,
    secrets: Secrets = Secrets(),
    detector: Detector | None = None,
    columns: Sequence[str] | None = None,
    stringify_all: bool = False,
    findings: bool = False,
    on_failure: str = "redact",
    by_offset: bool = False,
) -> DataFrame:
    """``df`` with personal data rewritten; same columns, order and row count.

    ``stringify_all`` scans every column as text.  ``findings`` adds a column
    of what was done (never the text it was done to), for audit and summaries.
    """
    if stringify_all:
        from cloakframe.sources.lake import stringify

        df = stringify(df)
    done, names = protected_cells(df, policy, secrets, detector, columns, on_failure, by_offset, findings)
    at = {name: i for i, name in enumerate(names)}
    out = [
        F.get(F.col(RESULTS), F.lit(at[c])).getField("value").alias(c) if c in at else quoted(c)
        for c in df.columns
    ]
    if findings:
        out.append(_findings(names).alias(FINDINGS))
    return done.select(*out)


def token_pairs_of(
    df: DataFrame,
    policy: Policy,
    secrets: Secrets = Secrets(),
    detector: Detector | None = None,
    columns: Sequence[str] | None = None,
    pairs_column: str = "_pairs",
) -> DataFrame:
    """``protect(findings=True)`` plus the vault pairs of each row (sensitive)."""
    done, names = protected_cells(df, policy, secrets, detector, columns)
    at = {name: i for i, name in enumerate(names)}
    out = [
        F.get(F.col(RESULTS), F.lit(at[c])).getField("value").alias(c) if c in at else quoted(c)
        for c in df.columns
    ]
    made = F.filter(
        F.flatten(F.transform(RESULTS, lambda r: r.applied)),
        lambda a: (a.method == "tokenization") & ~a.failed,
    )
    pairs = F.transform(
        made,
        lambda a: F.struct(a.text.alias("value"), a.token_prefix.alias("prefix"), a.protected.alias("token")),
    )
    return done.select(*out, _findings(names).alias(FINDINGS), pairs.alias(pairs_column))


def _findings(names: list[str]) -> Column:
    labels = F.array(*map(F.lit, names)) if names else F.array().cast("array<string>")
    return F.zip_with(
        labels,
        F.col(RESULTS),
        lambda name, r: F.struct(
            name.alias("column_name"),
            F.transform(r.entities, lambda e: e.entity_type).alias("entity_types"),
            F.transform(
                r.applied,
                lambda a: F.struct(a.entity_type.alias("entity_type"), a.method.alias("method"), a.failed.alias("failed")),
            ).alias("applied"),
        ),
    )


def applied_table(
    df: DataFrame,
    key: str | Sequence[str],
    policy: Policy,
    secrets: Secrets = Secrets(),
    detector: Detector | None = None,
    columns: Sequence[str] | None = None,
    method: str | None = None,
) -> DataFrame:
    """One row per applied action, of one method if it is named, with original and protected text (sensitive)."""
    keys = [key] if isinstance(key, str) else list(key)
    done, names = protected_cells(df, policy, secrets, detector, columns, method=method)
    labels = F.array(*map(F.lit, names)) if names else F.array().cast("array<string>")
    rows = F.flatten(
        F.zip_with(
            labels,
            F.col(RESULTS),
            lambda name, r: F.transform(r.applied, lambda a, i: F.struct(name.alias("column_name"), i.alias("turn"), a.alias("a"))),
        )
    )
    if method:
        rows = F.filter(rows, lambda r: r.a.method == F.lit(method))
    return done.select(*map(quoted, keys), F.explode(rows).alias("r")).select(
        *map(quoted, keys), "r.column_name", "r.turn", "r.a.*"
    )


def protection_counts(protected: DataFrame) -> DataFrame:
    """``(method, applied, failures)`` from a table protected with ``findings=True``."""
    each = protected.select(F.explode(F.flatten(F.transform(FINDINGS, lambda f: f.applied))).alias("a"))
    return each.groupBy("a.method").agg(
        F.count_if(~F.col("a.failed")).alias("applied"), F.count_if("a.failed").alias("failures")
    )


def protection_summary(protected: DataFrame) -> DataFrame:
    """One row: ``protections_applied, methods_used, failures``."""
    used = F.when(F.col("applied") > 0, F.struct("method", "applied"))
    return protection_counts(protected).agg(
        F.coalesce(F.sum("applied"), F.lit(0)).alias("protections_applied"),
        F.map_from_entries(F.array_sort(F.collect_list(used))).alias("methods_used"),
        F.coalesce(F.sum("failures"), F.lit(0)).alias("failures"),
    )


def leaks(protected: DataFrame, key: str, entities: DataFrame) -> DataFrame:
    """Findings whose text still occurs, in any case, in the protected cell.

    Must be empty for a policy that rewrites everything it finds.  Both sides grow with the table, which
    Spark's estimate of exploded rows does not tell, so the join is asked to sort and not to broadcast.
    """
    names = [c for c in text_columns(protected) if c != key]
    cells = protected.select(
        quoted(key),
        F.explode(F.array(*[F.struct(F.lit(n).alias("column_name"), quoted(n).alias("cell")) for n in names])).alias("c"),
    ).select(quoted(key), "c.column_name", "c.cell")
    return entities.join(cells.hint("merge"), [key, "column_name"]).filter(
        F.contains(F.lower("cell"), F.lower("text"))
    ).select(quoted(key), "column_name", "entity_type", "start", "end")

