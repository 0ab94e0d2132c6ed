"""Protection policies: YAML in, checked rules out.

A policy is small, so its rules travel inside the protection expression.  The
checks are a DataFrame job over policy documents, which serves one file and a
table of tenants' policies alike.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from pathlib import Path

import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakframe.functions.protection import Options

DEFAULT_POLICY = Path(__file__).parent.parent / "resources" / "default_policy.yaml"

# Allowed method names and directions, fallback priority.
METHOD_NAMES = ("aes256_encrypt", "sha256_hash", "masking", "tokenization", "redact")
DIRECTIONS = ("left", "right", "center")
FALLBACK_PRIORITY = 999

RULE_SCHEMA = (
    "pos int, entity_type string, protection_method string, priority int, description string, "
    "options struct<mask_char:string,visible_chars:int,direction:string,token_prefix:string>"
)


class PolicyError(ValueError):
    def __init__(self, message: str, errors: Sequence[str] = ()) -> None:
        super().__init__(message + (": " + "; ".join(errors) if errors else ""))
        self.errors = list(errors)


@dataclass(frozen=True)
class Rule:
    entity_type: str
    protection_method: str
    priority: int = 1
    description: str = ""
    options: Options = Options()


@dataclass(frozen=True)
class Policy:
    rules: tuple[Rule, ...] = ()
    version: str = "1.0"
    description: str = ""
    default_protection: str = "masking"
    confidence_threshold: float = 0.7
    default_options: Options = field(default_factory=Options)

    def effective(self) -> list[Rule]:
        """The winning rule of each type: lowest priority number, first on ties."""
        best: dict[str, Rule] = {}
        for rule in sorted(self.rules, key=lambda r: r.priority):
            best.setdefault(rule.entity_type, rule)
        return list(best.values())

    def methods(self) -> list[str]:
        used = {r.protection_method for r in self.effective()} | {self.default_protection}
        return sorted(used)


def rules_frame(spark: SparkSession, policy: Policy) -> DataFrame:
    """The rules as a DataFrame, in policy order."""
    rows = [
        (
            i,
            r.entity_type,
            r.protection_method,
            r.priority,
            r.description,
            (r.options.mask_char, r.options.visible_chars, r.options.direction, r.options.token_prefix),
        )
        for i, r in enumerate(policy.rules)
    ]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def effective_rules(rules: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One rule per entity type (and per ``by``): lowest priority, then first."""
    rest = [c for c in rules.columns if c not in (*by, "entity_type")]
    best = F.min_by(F.struct(*rest), F.struct("priority", "pos")).alias("r")
    return rules.groupBy(*by, "entity_type").agg(best).select(*by, "entity_type", "r.*")


def _text(value: Column, path: str) -> Column:
    return F.variant_get(value, path, "string")


def _kind(value: Column, path: str) -> Column:
    """Variant type name at a path, null where the path is absent."""
    return F.schema_of_variant(F.try_variant_get(value, path, "variant"))


def policy_issues(policies: DataFrame) -> DataFrame:
    """All problems of ``(policy_id, policy_json)`` rows: ``(policy_id, pos, issue)``.

    ``pos`` is the 0-based rule position, null for problems of the whole policy.
    """
    doc = policies.select("policy_id", F.try_parse_json("policy_json").alias("p"))
    kind_of_doc = F.coalesce(F.schema_of_variant("p"), F.lit("NONE"))
    is_mapping = F.startswith(kind_of_doc, F.lit("OBJECT"))
    rules_kind = _kind(F.col("p"), "$.rules")
    threshold = _kind(F.col("p"), "$.settings.confidence_threshold")
    threshold_ok = (threshold.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")) & F.coalesce(
        F.try_variant_get("p", "$.settings.confidence_threshold", "double").between(0.0, 1.0), F.lit(False)
    )
    default_method = _text(F.col("p"), "$.settings.default_protection")

    def when_mapping(test: Column, message: str) -> Column:
        return F.when(is_mapping & test, F.lit(message))

    whole = doc.select(
        "policy_id",
        F.lit(None).cast("int").alias("pos"),
        F.explode(
            F.array_compact(
                F.array(
                    F.when(~is_mapping, F.lit("Policy must be a mapping")),
                    when_mapping(_kind(F.col("p"), "$.version").isNull(), "Missing required field: version"),
                    when_mapping(rules_kind.isNull(), "Missing required field: rules"),
                    when_mapping(
                        rules_kind.isNotNull() & ~F.startswith(rules_kind, F.lit("ARRAY")),
                        "Field 'rules' must be a list",
                    ),
                    when_mapping(
                        threshold.isNotNull() & ~threshold_ok,
                        "confidence_threshold must be between 0 and 1",
                    ),
                    when_mapping(
                        default_method.isNotNull() & ~default_method.isin(*METHOD_NAMES),
                        "Invalid default_protection",
                    ),
                )
            )
        ).alias("issue"),
    )

    rules = doc.select(
        "policy_id",
        F.posexplode(F.try_variant_get("p", "$.rules", "array<variant>")).alias("pos", "r"),
    ).select(
        "policy_id",
        "pos",
        "r",
        F.startswith(F.schema_of_variant("r"), F.lit("OBJECT")).alias("is_rule"),
        F.concat(F.lit("Rule "), (F.col("pos") + 1).cast("string"), F.lit(": ")).alias("prefix"),
    )
    r = F.col("r")
    entity, method = _text(r, "$.entity_type"), _text(r, "$.protection_method")
    priority, visible = _kind(r, "$.priority"), _kind(r, "$.options.visible_chars")
    mask_kind, mask_char = _kind(r, "$.options.mask_char"), _text(r, "$.options.mask_char")
    direction = _text(r, "$.options.direction")

    def not_int_from(kind: Column, path: str, least: int) -> Column:
        ok = (kind == "BIGINT") & F.coalesce(F.try_variant_get(r, path, "bigint") >= least, F.lit(False))
        return kind.isNotNull() & ~ok

    def rule_issue(test: Column, message: str) -> Column:
        return F.when(F.col("is_rule") & test, F.concat("prefix", F.lit(message)))

    per_rule = rules.select(
        "policy_id",
        "pos",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(~F.col("is_rule"), F.concat("prefix", F.lit("Must be a mapping"))),
                    rule_issue(entity.isNull(), "Missing entity_type"),
                    rule_issue(method.isNull(), "Missing protection_method"),
                    rule_issue(method.isNotNull() & ~method.isin(*METHOD_NAMES), "Invalid protection_method"),
                    rule_issue(not_int_from(priority, "$.priority", 1), "priority must be positive integer"),
                    rule_issue(
                        not_int_from(visible, "$.options.visible_chars", 0),
                        "visible_chars must be non-negative integer",
                    ),
                    rule_issue(
                        mask_kind.isNotNull() & ~((mask_kind == "STRING") & (F.length(mask_char) == 1)),
                        "mask_char must be single character",
                    ),
                    rule_issue(
                        direction.isNotNull() & ~direction.isin(*DIRECTIONS),
                        "direction must be one of left, right, center",
                    ),
                )
            )
        ).alias("issue"),
    )
    duplicates = (
        rules.filter("is_rule")
        .select("policy_id", _text(r, "$.entity_type").alias("entity_type"))
        .groupBy("policy_id", "entity_type")
        .count()
        .filter("count > 1 AND entity_type IS NOT NULL")
        .select(
            "policy_id",
            F.lit(None).cast("int").alias("pos"),
            F.concat(F.lit("Duplicate rule for entity type: "), "entity_type").alias("issue"),
        )
    )
    return whole.unionByName(per_rule).unionByName(duplicates)


def parse_policy(spark: SparkSession, text: str, source: str = "<text>") -> Policy:
    """Check and build a policy from YAML text; raises ``PolicyError`` with all problems."""
    try:
        data = yaml.safe_load(text)
    except yaml.YAMLError as e:
        raise PolicyError(f"Invalid YAML in {source}: {e}") from e
    if not isinstance(data, dict):
        raise PolicyError(f"Policy must be a YAML mapping in {source}")
    one = spark.createDataFrame([(source, json.dumps(data, default=str))], "policy_id string, policy_json string")
    # One policy file: the number of issues is bounded by its rules.
    found = [row.issue for row in policy_issues(one).orderBy("pos", "issue").collect()]
    if found:
        raise PolicyError(f"Policy validation failed in {source}", found)
    return build_policy(data)


def build_policy(data: dict) -> Policy:
    settings = data.get("settings") or {}
    known = set(Options.__dataclass_fields__)
    rules = [
        Rule(
            r["entity_type"],
            r["protection_method"],
            r.get("priority", 1),
            r.get("description", ""),
            Options(**{k: v for k, v in (r.get("options") or {}).items() if k in known}),
        )
        for r in data["rules"]
    ]
    return Policy(
        tuple(sorted(rules, key=lambda r: r.priority)),
        str(data["version"]),
        data.get("description", ""),
        settings.get("default_protection", "masking"),
        settings.get("confidence_threshold", 0.7),
    )


def load_policy(spark: SparkSession, path: str | Path | None = None) -> Policy:
    """The policy in a YAML file, or the bundled default policy."""
    source = Path(path) if path else DEFAULT_POLICY
    return parse_policy(spark, source.read_text(encoding="utf-8"), str(source))


def default_policy() -> Policy:
    """The bundled policy, without a check job."""
    return build_policy(yaml.safe_load(DEFAULT_POLICY.read_text(encoding="utf-8")))
