import json

import pytest

from cloakframe import Options, Policy, Rule, default_policy, evaluate, load_policy
from cloakframe.functions.recognizers import ENTITY_TYPES
from cloakframe.operators.evaluate import evaluation_statistics
from cloakframe.plans.policy import PolicyError, effective_rules, parse_policy, rules_frame

GOOD = """
version: "1.0"
settings: {default_protection: redact, confidence_threshold: 0.8}
rules:
  - {entity_type: B, protection_method: masking, priority: 2, options: {mask_char: "#", visible_chars: 2, unknown: 1}}
  - {entity_type: A, protection_method: sha256_hash}
"""


def test_default_policy_covers_all_types(spark):
    policy = load_policy(spark)
    assert policy == default_policy()
    assert {r.entity_type for r in policy.rules} == set(ENTITY_TYPES)
    assert (policy.default_protection, policy.confidence_threshold) == ("masking", 0.7)


def test_rules_are_sorted_and_options_filled(spark):
    policy = parse_policy(spark, GOOD)
    assert [r.entity_type for r in policy.rules] == ["A", "B"]
    assert policy.rules[1].options == Options("#", 2, "right", "TOK_")
    assert (policy.default_protection, policy.confidence_threshold) == ("redact", 0.8)


def rule(**kw):
    return {"entity_type": "A", "protection_method": "masking", **kw}


@pytest.mark.parametrize(
    "data,message",
    [
        ({"rules": []}, "version"),
        ({"version": "1"}, "rules"),
        ({"version": "1", "rules": {}}, "must be a list"),
        ({"version": "1", "rules": ["x"]}, "Must be a mapping"),
        ({"version": "1", "rules": [{"protection_method": "masking"}]}, "Missing entity_type"),
        ({"version": "1", "rules": [{"entity_type": "A"}]}, "Missing protection_method"),
        ({"version": "1", "rules": [rule(protection_method="rot13")]}, "Invalid protection_method"),
        ({"version": "1", "rules": [rule(), rule()]}, "Duplicate rule for entity type: A"),
        ({"version": "1", "rules": [rule(priority=0)]}, "priority"),
        ({"version": "1", "rules": [rule(priority=True)]}, "priority"),
        ({"version": "1", "rules": [rule(priority="2")]}, "priority"),
        ({"version": "1", "rules": [rule(options={"visible_chars": -1})]}, "visible_chars"),
        ({"version": "1", "rules": [rule(options={"mask_char": "ab"})]}, "mask_char"),
        ({"version": "1", "rules": [rule(options={"direction": "up"})]}, "direction"),
        ({"version": "1", "rules": [], "settings": {"confidence_threshold": 1.5}}, "confidence_threshold"),
        ({"version": "1", "rules": [], "settings": {"confidence_threshold": True}}, "confidence_threshold"),
        ({"version": "1", "rules": [], "settings": {"default_protection": "x"}}, "default_protection"),
    ],
)
def test_bad_policies_are_refused(spark, data, message):
    with pytest.raises(PolicyError, match=message):
        parse_policy(spark, json.dumps(data))


def test_all_errors_are_collected(spark):
    bad = {"rules": [rule(priority=0, options={"direction": "up"}), {"entity_type": "B"}]}
    with pytest.raises(PolicyError) as e:
        parse_policy(spark, json.dumps(bad))
    assert len(e.value.errors) == 4


@pytest.mark.parametrize("text", ["- a\n- b", "just text", "a: [1"])
def test_not_a_mapping_or_not_yaml(spark, text):
    with pytest.raises(PolicyError):
        parse_policy(spark, text)


def test_missing_file(spark):
    with pytest.raises(FileNotFoundError):
        load_policy(spark, "/nowhere.yaml")


def test_lowest_priority_number_wins(spark):
    policy = Policy((Rule("A", "masking", 3), Rule("A", "redact", 1), Rule("A", "sha256_hash", 1)))
    assert [r.protection_method for r in policy.effective()] == ["redact"]
    assert effective_rules(rules_frame(spark, policy)).first().protection_method == "redact"


def test_evaluate_threshold_is_inclusive_and_default_applies(spark):
    rows = [(1, "A", 0.7), (2, "A", 0.69), (3, "Z", 0.9)]
    entities = spark.createDataFrame(rows, "id bigint, entity_type string, score double")
    policy = Policy((Rule("A", "redact", 4),))
    got = {r.id: (r.protection_method, r.priority) for r in evaluate(entities, policy).collect()}
    assert got == {1: ("redact", 4), 3: ("masking", 999)}
    stats = {(r.kind, r.name): r.n for r in evaluation_statistics(entities, policy).collect()}
    assert stats[("total", "")] == 3 and stats[("matched", "")] == 2
    assert stats[("method", "redact")] == 1 and stats[("entity_type", "Z")] == 1
