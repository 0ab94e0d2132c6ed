"""Detection, policy evaluation and accuracy queries."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakframe.functions.recognizers import ENTITY_TYPES, Pattern, Recognizer
from cloakframe.operators import compare
from cloakframe.operators.detect import Detector, detect, detection_counts, detection_summary, with_recognizers
from cloakframe.operators.evaluate import (
    actions_by_column,
    evaluate,
    evaluation_statistics,
    threshold_sweep,
)
from cloakframe.operators.phrases import find_phrases
from cloakframe.plans.layout import spread
from cloakframe.plans.policy import default_policy, effective_rules, policy_issues
from suite.oracle_text import entities_sql
from suite.people import PEOPLE_SQL, TEXT_COLUMNS, people

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The columns of a text table, on all cores."""
    return spread(table(spark, sf_dir, name).select(*columns), 3 * spark.sparkContext.defaultParallelism)


def as_rows(entities: DataFrame, key: str) -> DataFrame:
    return entities.select(
        key,
        "column_name",
        "entity_type",
        "text",
        F.col("start").cast("bigint").alias("start_at"),
        F.col("end").cast("bigint").alias("end_at"),
        "score",
        F.col("ord").cast("bigint").alias("ord"),
    )


def rows_sql(key: str) -> str:
    return (
        f' SELECT {key}, column_name, entity_type, "text", CAST(start_at AS BIGINT) AS start_at, '
        "CAST(end_at AS BIGINT) AS end_at, score, CAST(ord AS BIGINT) AS ord FROM entities"
    )


def _spans(name: str, source: str, key: str, column: str, types: tuple[str, ...] | None, threshold: float) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return as_rows(detect(texts(spark, sf_dir, source, key, column), key, Detector(threshold, types), [column]), key)

    QUERIES[name] = run
    ORACLES[name] = entities_sql(source, key, (column,), types, threshold) + rows_sql(key)


_spans("detect_email_documents", "documents", "doc_id", "text", ("EMAIL_ADDRESS",), 0.5)
_spans("detect_credit_card_documents", "documents", "doc_id", "text", ("CREDIT_CARD",), 0.5)
_spans("detect_ip_address_documents", "documents", "doc_id", "text", ("IP_ADDRESS",), 0.5)
_spans("detect_phone_number_documents", "documents", "doc_id", "text", ("PHONE_NUMBER",), 0.3)
_spans("detect_all_types_documents", "documents", "doc_id", "text", None, 0.3)
_spans("detect_all_types_pages", "pages", "page_id", "html", None, 0.3)


def _people_spans(name: str, types: tuple[str, ...] | None, threshold: float, columns=TEXT_COLUMNS) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return as_rows(detect(people(spark, sf_dir), "row_key", Detector(threshold, types), columns), "row_key")

    QUERIES[name] = run
    ORACLES[name] = entities_sql("people", "row_key", tuple(columns), types, threshold, PEOPLE_SQL) + rows_sql("row_key")


for _type in ENTITY_TYPES:
    if _type not in ("LOCATION", "DATE_TIME", "IBAN_CODE", "UK_DRIVERS_LICENSE"):
        _people_spans(f"detect_{_type.lower()}_people", (_type,), 0.3)
_people_spans("detect_all_types_people", None, 0.3)
_people_spans("detect_default_threshold_people", None, 0.7)
_people_spans("detect_single_column_people", None, 0.3, ("notes",))
_people_spans("detect_context_boost_people", ("UK_PASSPORT",), 0.5, ("passport_note",))


# Types the people view does not hold: built from its keys around fixed shapes.
def _more(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("row_key")
    return people(spark, sf_dir).select(
        "row_key",
        F.concat(F.lit("GB"), F.lpad(((k * 31) % 100).cast("string"), 2, "0"), F.lit(" NWBK "),
                 F.lpad(((k * 7919) % 10000).cast("string"), 4, "0"), F.lit(" "),
                 F.lpad(((k * 104729) % 10000).cast("string"), 4, "0"), F.lit(" "),
                 F.lpad(((k * 1299709) % 10000).cast("string"), 4, "0"), F.lit(" 32")).alias("iban"),
        F.concat(F.upper(F.rpad(F.element_at(F.split("name", " "), 2), 5, "9")), F.lpad(((k * 7919) % 1000000).cast("string"), 6, "0"), F.lit("JA9XY")).alias("licence"),
        F.concat(F.lit("Born "), (F.lit(1950) + k % 50).cast("string"), F.lit("-"), F.lpad((k % 12 + 1).cast("string"), 2, "0"), F.lit("-"), F.lpad((k % 28 + 1).cast("string"), 2, "0")).alias("born"),
        F.concat((k % 200 + 1).cast("string"), F.lit(" Church Lane, "), F.when(k % 2 == 0, "Scotland").otherwise("Nowhere")).alias("place"),
    )


MORE_SQL = PEOPLE_SQL + """,
more AS (SELECT row_key,
  'GB' || lpad(CAST((row_key*31) % 100 AS VARCHAR), 2, '0') || ' NWBK ' || lpad(CAST((row_key*7919) % 10000 AS VARCHAR), 4, '0')
    || ' ' || lpad(CAST((row_key*104729) % 10000 AS VARCHAR), 4, '0') || ' ' || lpad(CAST((row_key*1299709) % 10000 AS VARCHAR), 4, '0') || ' 32' AS iban,
  upper(rpad(string_split(name, ' ')[2], 5, '9')) || lpad(CAST((row_key*7919) % 1000000 AS VARCHAR), 6, '0') || 'JA9XY' AS licence,
  'Born ' || CAST(1950 + row_key % 50 AS VARCHAR) || '-' || lpad(CAST(row_key % 12 + 1 AS VARCHAR), 2, '0') || '-' || lpad(CAST(row_key % 28 + 1 AS VARCHAR), 2, '0') AS born,
  CAST(row_key % 200 + 1 AS VARCHAR) || ' Church Lane, ' || CASE WHEN row_key % 2 = 0 THEN 'Scotland' ELSE 'Nowhere' END AS place
  FROM people)"""

for _type, _column in {"IBAN_CODE": "iban", "UK_DRIVERS_LICENSE": "licence", "DATE_TIME": "born", "LOCATION": "place"}.items():
    def _run(spark: SparkSession, sf_dir: str, t=_type, c=_column) -> DataFrame:
        return as_rows(detect(_more(spark, sf_dir), "row_key", Detector(0.3, (t,)), [c]), "row_key")

    QUERIES[f"detect_{_type.lower()}_people"] = _run
    ORACLES[f"detect_{_type.lower()}_people"] = entities_sql("more", "row_key", (_column,), (_type,), 0.3, MORE_SQL) + rows_sql("row_key")


_PEOPLE_ENTITIES = entities_sql("people", "row_key", TEXT_COLUMNS, None, 0.3, PEOPLE_SQL)
_LABELS = ", ".join(f"'{c}'" for c in TEXT_COLUMNS)


def _people_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(people(spark, sf_dir), "row_key", Detector(0.3))


def detection_counts_people(spark, sf_dir):
    return detection_counts(people(spark, sf_dir), Detector(0.3))


QUERIES["detection_counts_people"] = detection_counts_people
ORACLES["detection_counts_people"] = _PEOPLE_ENTITIES + f"""
SELECT column_name, entity_type, count(*) AS entities, 0 AS cells, 0 AS cells_with_pii FROM entities GROUP BY ALL
UNION ALL
SELECT c.column_name, NULL, 0, (SELECT count(*) FROM people),
  (SELECT count(DISTINCT row_key) FROM entities e WHERE e.column_name = c.column_name)
FROM (SELECT unnest([{_LABELS}]) AS column_name) c"""


def detection_summary_people(spark, sf_dir):
    return detection_summary(people(spark, sf_dir), Detector(0.3)).select(
        "total_entities",
        "cells_scanned",
        "cells_with_pii",
        F.array_join("columns_with_pii", ",").alias("columns_with_pii"),
        F.array_join(F.transform(F.map_entries("entity_counts"), lambda e: F.concat_ws("=", e.key, e.value.cast("string"))), ",").alias("entity_counts"),
    )


QUERIES["detection_summary_people"] = detection_summary_people
ORACLES["detection_summary_people"] = _PEOPLE_ENTITIES + f"""
SELECT count(*) AS total_entities, (SELECT count(*) FROM people) * {len(TEXT_COLUMNS)} AS cells_scanned,
  (SELECT count(*) FROM (SELECT DISTINCT row_key, column_name FROM entities)) AS cells_with_pii,
  (SELECT string_agg(column_name, ',' ORDER BY column_name) FROM (SELECT DISTINCT column_name FROM entities)) AS columns_with_pii,
  (SELECT string_agg(entity_type || '=' || n, ',' ORDER BY entity_type) FROM (SELECT entity_type, count(*) AS n FROM entities GROUP BY 1)) AS entity_counts
FROM entities"""


def entity_counts_documents(spark, sf_dir):
    found = detect(texts(spark, sf_dir, "documents", "doc_id", "lang", "text"), ["doc_id", "lang"], Detector(0.3), ["text"])
    return found.groupBy("lang", "entity_type").agg(
        F.count("*").alias("entities"), F.count_distinct("doc_id").alias("documents")
    )


QUERIES["entity_counts_documents"] = entity_counts_documents
ORACLES["entity_counts_documents"] = entities_sql("documents", "doc_id", ("text",), None, 0.3) + """
SELECT lang, entity_type, count(*) AS entities, count(DISTINCT doc_id) AS documents
FROM entities JOIN documents USING (doc_id) GROUP BY lang, entity_type"""


_POLICY = default_policy()
_RULES_SQL = "rules AS (" + " UNION ALL ".join(
    f"SELECT '{r.entity_type}' AS entity_type, '{r.protection_method}' AS method, {r.priority} AS priority"
    for r in _POLICY.effective()
    if r.entity_type != "UK_VRN"
) + ")"


def _evaluated_policy():
    from dataclasses import replace

    # One type without a rule, so the default applies to it.
    return replace(_POLICY, rules=tuple(r for r in _POLICY.rules if r.entity_type != "UK_VRN"))


def evaluate_actions_people(spark, sf_dir):
    return evaluate(_people_entities(spark, sf_dir), _evaluated_policy()).select(
        "row_key", "column_name", "entity_type", F.col("ord").cast("bigint").alias("ord"), "protection_method", "priority",
        F.col("options.visible_chars").alias("visible_chars"),
    )


_VISIBLE = " ".join(
    f"WHEN '{r.entity_type}' THEN {r.options.visible_chars}" for r in _POLICY.effective() if r.entity_type != "UK_VRN"
)
_ACTIONS = _PEOPLE_ENTITIES.replace("WITH ", f"WITH {_RULES_SQL},", 1) + f""",
actions AS (SELECT e.*, coalesce(r.method, 'masking') AS protection_method, coalesce(r.priority, 999) AS priority,
    CASE e.entity_type {_VISIBLE} ELSE 4 END AS visible_chars
  FROM entities e LEFT JOIN rules r USING (entity_type) WHERE e.score >= 0.7)"""
QUERIES["evaluate_actions_people"] = evaluate_actions_people
ORACLES["evaluate_actions_people"] = _ACTIONS + """
SELECT row_key, column_name, entity_type, CAST(ord AS BIGINT) AS ord, protection_method, priority, visible_chars FROM actions"""


QUERIES["evaluation_statistics_people"] = lambda spark, sf_dir: evaluation_statistics(
    _people_entities(spark, sf_dir), _evaluated_policy()
)
ORACLES["evaluation_statistics_people"] = _ACTIONS + """
SELECT 'total' AS kind, '' AS name, count(*) AS n FROM entities
UNION ALL SELECT 'matched', '', count(*) FROM actions
UNION ALL SELECT 'method', protection_method, count(*) FROM actions GROUP BY 2
UNION ALL SELECT 'entity_type', entity_type, count(*) FROM actions GROUP BY 2"""

QUERIES["actions_by_column_people"] = lambda spark, sf_dir: actions_by_column(
    evaluate(_people_entities(spark, sf_dir), _evaluated_policy())
)
ORACLES["actions_by_column_people"] = _ACTIONS + """
SELECT column_name, protection_method, entity_type, count(*) AS actions FROM actions GROUP BY ALL"""

QUERIES["threshold_sweep_people"] = lambda spark, sf_dir: threshold_sweep(_people_entities(spark, sf_dir))
ORACLES["threshold_sweep_people"] = _PEOPLE_ENTITIES + """
SELECT CAST(t AS DOUBLE) AS threshold, (SELECT count(*) FROM entities WHERE score >= t) AS entities
FROM (SELECT unnest([0.3, 0.5, 0.7, 0.9]) AS t)"""


def effective_rules_by_tenant(spark, sf_dir):
    k = F.col("c_custkey")
    types = F.array(*map(F.lit, ENTITY_TYPES))
    rules = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("tenant"),
        k.alias("pos"),
        F.element_at(types, (k % len(ENTITY_TYPES) + 1).cast("int")).alias("entity_type"),
        ((k * 7) % 5 + 1).alias("priority"),
    )
    return effective_rules(rules, ["tenant"])


QUERIES["effective_rules_by_tenant"] = effective_rules_by_tenant
ORACLES["effective_rules_by_tenant"] = f"""
SELECT tenant, pos, entity_type, priority FROM (
  SELECT *, row_number() OVER (PARTITION BY tenant, entity_type ORDER BY priority, pos) AS turn FROM (
    SELECT c_nationkey AS tenant, c_custkey AS pos,
      [{", ".join(f"'{t}'" for t in ENTITY_TYPES)}][c_custkey % {len(ENTITY_TYPES)} + 1] AS entity_type,
      (c_custkey * 7) % 5 + 1 AS priority FROM customer)) WHERE turn = 1"""


def policy_issues_by_tenant(spark, sf_dir):
    k = F.col("c_custkey")
    rule = F.concat(
        F.lit('{"entity_type":"EMAIL_ADDRESS"'),
        F.when(k % 11 == 0, "").otherwise(F.concat(F.lit(',"protection_method":"'), F.when(k % 5 == 0, "rot13").otherwise("masking"), F.lit('"'))),
        F.element_at(F.array(F.lit(',"priority":0'), F.lit(',"priority":"2"'), F.lit(',"priority":true'), F.lit(',"priority":3'), F.lit("")), (k % 5 + 1).cast("int")),
        F.lit(',"options":{"mask_char":"'), F.when(k % 3 == 0, "xx").otherwise("#"),
        F.lit('","visible_chars":'), F.when(k % 6 == 0, "-1").otherwise("2"),
        F.lit(',"direction":"'), F.when(k % 8 == 0, "up").otherwise("left"), F.lit('"}}'),
    )
    doc = F.concat(
        F.lit("{"),
        F.when(k % 7 == 0, "").otherwise('"version":"1.0",'),
        F.lit('"settings":{"confidence_threshold":'), F.when(k % 9 == 0, "1.5").otherwise("0.5"), F.lit("},"),
        F.lit('"rules":['), rule, F.when(k % 10 == 0, F.concat(F.lit(","), rule)).otherwise(""), F.lit("]}"),
    )
    found = policy_issues(table(spark, sf_dir, "customer").select(k.alias("policy_id"), doc.alias("policy_json")))
    return found.withColumn("pos", F.coalesce("pos", F.lit(-1)))


_RULE_TESTS = {
    "k % 11 = 0": "Missing protection_method",
    "k % 11 <> 0 AND k % 5 = 0": "Invalid protection_method",
    "k % 5 IN (0, 1, 2)": "priority must be positive integer",
    "k % 3 = 0": "mask_char must be single character",
    "k % 6 = 0": "visible_chars must be non-negative integer",
    "k % 8 = 0": "direction must be one of left, right, center",
}
QUERIES["policy_issues_by_tenant"] = policy_issues_by_tenant
ORACLES["policy_issues_by_tenant"] = "WITH t AS (SELECT c_custkey AS k FROM customer) " + " UNION ALL ".join(
    [
        "SELECT k AS policy_id, -1 AS pos, 'Missing required field: version' AS issue FROM t WHERE k % 7 = 0",
        "SELECT k, -1, 'confidence_threshold must be between 0 and 1' FROM t WHERE k % 9 = 0",
        "SELECT k, -1, 'Duplicate rule for entity type: EMAIL_ADDRESS' FROM t WHERE k % 10 = 0",
    ]
    + [f"SELECT k, 0, 'Rule 1: {m}' FROM t WHERE {test}" for test, m in _RULE_TESTS.items()]
    + [f"SELECT k, 1, 'Rule 2: {m}' FROM t WHERE {test} AND k % 10 = 0" for test, m in _RULE_TESTS.items()]
)


# Extension points ----------------------------------------------------------

_TICKET = Recognizer("TICKET_REF", (Pattern(r"\bref\s\d{9}\b", 0.6),), ("ref",))


def custom_recognizer_people(spark, sf_dir):
    found = detect(people(spark, sf_dir), "row_key", with_recognizers([_TICKET], threshold=0.5), ["passport_note"])
    return found.filter("entity_type = 'TICKET_REF'").select("row_key", "entity_type", "text", "score")


QUERIES["custom_recognizer_people"] = custom_recognizer_people
ORACLES["custom_recognizer_people"] = f"""WITH {PEOPLE_SQL}
SELECT row_key, 'TICKET_REF' AS entity_type, regexp_extract(passport_note, '\\bref\\s\\d{{9}}\\b') AS "text", CAST(0.6 AS DOUBLE) AS score
FROM people WHERE regexp_matches(passport_note, '\\bref\\s\\d{{9}}\\b')"""


def greeting_model(texts: pd.Series) -> pd.Series:
    """Stands in for a language model: the first three words of a turn."""

    def spans(text):
        words = (text or "").split(" ")[:3]
        end = len(" ".join(words))
        return [("PERSON", 0, end, 0.95)] if len(words) == 3 else []

    return texts.map(spans)


def model_hook_conversations(spark, sf_dir):
    found = detect(
        texts(spark, sf_dir, "conversations", "conv_id", "turn", "text"), ["conv_id", "turn"], Detector(0.9, ("PERSON",), model=greeting_model), ["text"]
    )
    return found.select("conv_id", "turn", "entity_type", "text", F.col("end").cast("bigint").alias("end_at"), "score")


QUERIES["model_hook_conversations"] = model_hook_conversations
ORACLES["model_hook_conversations"] = """
SELECT conv_id, turn, 'PERSON' AS entity_type, array_to_string(string_split("text", ' ')[1:3], ' ') AS "text",
  CAST(length(array_to_string(string_split("text", ' ')[1:3], ' ')) AS BIGINT) AS end_at, CAST(0.95 AS DOUBLE) AS score
FROM conversations WHERE len(string_split("text", ' ')) >= 3 AND regexp_matches("text", '\\S')"""


def detect_phrases_documents(spark, sf_dir):
    """Two lists from the benchmark texts, all runs of two and of three words, found in the documents."""
    words = table(spark, sf_dir, "benchmark").select(F.expr(r"regexp_extract_all(text, '[A-Za-z]+', 0)").alias("w"))

    def listed(n: int, kind: str) -> DataFrame:
        starts = F.filter(F.sequence(F.lit(1), F.size("w")), lambda i: i <= F.size("w") - (n - 1))
        runs = F.transform(starts, lambda i: F.array_join(F.slice("w", i, n), " "))
        return words.where(F.size("w") > 0).select(F.explode(runs).alias("phrase"), F.lit(kind).alias("entity_type"))

    found = find_phrases(texts(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", listed(2, "PAIR").union(listed(3, "TRIPLE")), ["text"])
    return as_rows(found, "doc_id")


_PIECES = r"[\s\x0B\p{Z}]*(?:[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s\x0B\p{Z}])"
_SPACES = r"[\s\x0B\p{Z}]+"
QUERIES["detect_phrases_documents"] = detect_phrases_documents
ORACLES["detect_phrases_documents"] = f"""WITH RECURSIVE
words AS (SELECT regexp_extract_all("text", '[A-Za-z]+') AS w FROM benchmark),
phrases AS (
  SELECT DISTINCT lower(array_to_string(w[i:i + n - 1], ' ')) AS form, n FROM (SELECT w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, (VALUES (2), (3)) AS sizes(n))),
cut AS (SELECT doc_id, regexp_extract_all("text", '{_PIECES}') AS p FROM documents),
placed AS (SELECT doc_id, p, unnest(p) AS piece, generate_subscripts(p, 1) AS i FROM cut),
ended AS (SELECT *, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i) AS till FROM placed),
starts AS (SELECT doc_id, i, p, till, till - length(regexp_replace(piece, '^{_SPACES}', '')) AS start_at FROM ended),
grams AS (
  SELECT a.doc_id, a.i, n, a.start_at, regexp_replace(array_to_string(a.p[a.i:a.i + n - 1], ''), '^{_SPACES}', '') AS run
  FROM starts a, (VALUES (2), (3)) AS sizes(n) WHERE a.i + n - 1 <= len(a.p)),
m AS MATERIALIZED (
  SELECT g.doc_id, g.n, g.run, g.start_at, g.start_at + length(g.run) AS end_at
  FROM grams g JOIN phrases f ON f.n = g.n AND f.form = lower(regexp_replace(g.run, '{_SPACES}', ' ', 'g'))),
after AS MATERIALIZED (SELECT a.doc_id, a.n, a.start_at, b.start_at AS next_at FROM m a ASOF JOIN m b ON a.doc_id = b.doc_id AND a.n = b.n AND a.end_at <= b.start_at),
chain AS (
  SELECT doc_id, n, min(start_at) AS start_at FROM m GROUP BY doc_id, n
  UNION ALL SELECT c.doc_id, c.n, a.next_at FROM chain c JOIN after a USING (doc_id, n, start_at))
SELECT doc_id, 'text' AS column_name, CASE n WHEN 2 THEN 'PAIR' ELSE 'TRIPLE' END AS entity_type, run AS "text",
  CAST(start_at AS BIGINT) AS start_at, CAST(end_at AS BIGINT) AS end_at, CAST(0.85 AS DOUBLE) AS score,
  CAST(row_number() OVER (PARTITION BY doc_id ORDER BY start_at, n) - 1 AS BIGINT) AS ord
FROM chain JOIN m USING (doc_id, n, start_at)"""


# Accuracy ------------------------------------------------------------------

def _labels(spark, sf_dir):
    """What each people cell must be detected as, from its recipe."""
    k, nhs_digit = F.col("row_key"), F.substring("nhs", 10, 1)
    weighted = sum((F.substring("nhs", i, 1).cast("int") * (11 - i) for i in range(1, 10)), F.lit(0))
    good_nhs = F.pmod(F.lit(11) - weighted % 11, F.lit(11)) == nhs_digit.cast("int")
    truth = [
        ("email", "EMAIL_ADDRESS", F.lit(True)),
        ("phone", "UK_PHONE", F.lit(True)),
        ("nino", "UK_NINO", k % 17 != 0),
        ("nhs", "UK_NHS", good_nhs),
        ("card", "CREDIT_CARD", k % 13 != 0),
        ("passport_note", "UK_PASSPORT", k % 2 == 0),
    ]
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("entity_type"), v.alias("is_pii")) for c, t, v in truth])
    return people(spark, sf_dir).select("row_key", F.inline(rows))


def accuracy_people(spark, sf_dir):
    found = detect(people(spark, sf_dir), "row_key", Detector(0.7))
    scored = compare.accuracy(compare.confusion(_labels(spark, sf_dir), found, ["row_key", "column_name"]))
    return scored.select(
        "entity_type", "tp", "fp", "fn",
        *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")],
    )


QUERIES["accuracy_people"] = accuracy_people
ORACLES["accuracy_people"] = f"""WITH {PEOPLE_SQL}, truth AS (
  SELECT 'EMAIL_ADDRESS' AS entity_type, count(*) AS tp, 0 AS fp, 0 AS fn FROM people
  UNION ALL SELECT 'UK_PHONE', count(*), 0, 0 FROM people
  UNION ALL SELECT 'UK_NINO', count(*) FILTER (row_key % 17 <> 0), 0, 0 FROM people
  UNION ALL SELECT 'UK_NHS', count(*) FILTER (nhs_digit <> 10), 0, 0 FROM people_parts
  UNION ALL SELECT 'CREDIT_CARD', count(*) FILTER (row_key % 13 <> 0), 0, 0 FROM people
  UNION ALL SELECT 'UK_PASSPORT', count(*) FILTER (row_key % 2 = 0), 0, 0 FROM people)
SELECT entity_type, tp, fp, fn, CAST(1 AS DOUBLE) AS precision, CAST(1 AS DOUBLE) AS recall, CAST(1 AS DOUBLE) AS f1 FROM truth"""


def consistency_documents(spark, sf_dir):
    found = detect(texts(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", Detector(0.5), ["text"])
    runs = None
    for i in range(3):
        run = found.withColumn("run", F.lit(i))
        runs = run if runs is None else runs.unionByName(run)
    return compare.consistency(runs, ["doc_id"])


QUERIES["consistency_documents"] = consistency_documents
ORACLES["consistency_documents"] = entities_sql("documents", "doc_id", ("text",), None, 0.5) + """
SELECT doc_id, 1 AS type_sets, 3 AS runs, CAST(0 AS DOUBLE) AS score_spread FROM entities GROUP BY doc_id"""
