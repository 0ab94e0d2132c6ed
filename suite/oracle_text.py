"""Detection and protection stated again in DuckDB SQL, on exploded rows.

Where the library works inside a cell with higher-order functions, this works
on one row per match with joins and NOT EXISTS, so the two share the pattern
texts and nothing of the logic.
"""

from __future__ import annotations

from cloakframe.functions.checks import NINO_BANNED_PREFIXES
from cloakframe.functions.recognizers import Recognizer, default_recognizers
from cloakframe.plans.policy import Policy

DIGITS = "regexp_replace(txt, '[^0-9]', '', 'g')"

NHS = f"""(length({DIGITS}) = 10 AND
  CAST(substr({DIGITS}, 10, 1) AS INT) =
  (11 - list_sum(list_transform(range(1, 10), lambda i: CAST(substr({DIGITS}, i, 1) AS INT) * (11 - i))) % 11) % 11)"""

LUHN = f"""(list_sum(list_transform(range(0, length({DIGITS})), lambda i:
    CASE WHEN i % 2 = 0 THEN CAST(substr({DIGITS}, length({DIGITS}) - i, 1) AS INT)
         WHEN CAST(substr({DIGITS}, length({DIGITS}) - i, 1) AS INT) > 4
           THEN CAST(substr({DIGITS}, length({DIGITS}) - i, 1) AS INT) * 2 - 9
         ELSE CAST(substr({DIGITS}, length({DIGITS}) - i, 1) AS INT) * 2 END)) % 10 = 0
  AND NOT (length(txt) = 13 AND txt LIKE '1%'))"""

NINO = (
    "(length(replace(txt, ' ', '')) = 9 AND upper(substr(replace(txt, ' ', ''), 1, 2)) NOT IN ("
    + ", ".join(f"'{p}'" for p in NINO_BANNED_PREFIXES)
    + "))"
)

IBAN_BARE = "regexp_replace(upper(txt), '[^A-Z0-9]', '', 'g')"
IBAN_DIGITS = f"""array_to_string(list_transform(string_split(substr({IBAN_BARE}, 5) || substr({IBAN_BARE}, 1, 4), ''),
    lambda c: CASE WHEN c BETWEEN 'A' AND 'Z' THEN CAST(ascii(c) - 55 AS VARCHAR) ELSE c END), '')"""
IBAN = f"(length({IBAN_BARE}) BETWEEN 15 AND 34 AND CAST({IBAN_DIGITS} AS HUGEINT) % 97 = 1)"

# The UK patterns and their scores, stated again so that a wrong
# one in the library shows.  Names and cities come from its word lists.
UK_PATTERNS = {
    "UK_NHS": ((r"\b\d{3}\s\d{3}\s\d{4}\b", 0.85), (r"\b\d{10}\b", 0.6)),
    "UK_NINO": ((r"\b[A-CEGHJ-NPR-TW-Z]{2}\s?\d{2}\s?\d{2}\s?\d{2}\s?[A-D]\b", 0.85),),
    "UK_POSTCODE": ((r"\b[A-Z]{1,2}\d[A-Z\d]?\s?\d[A-Z]{2}\b", 0.95),),
    "UK_PHONE": (
        (r"\+44\s?\d{4}\s?\d{6}", 0.9),
        (r"\+44\s\d{2,3}\s\d{3,4}\s\d{3,4}", 0.9),
        (r"\b07\d{3}\s?\d{6}\b", 0.85),
        (r"\b0[1-9]\d{2,4}\s?\d{5,6}\b", 0.75),
        (r"\b0\d{2,3}\s\d{3,4}\s\d{3,4}\b", 0.85),
    ),
    "UK_DRIVERS_LICENSE": ((r"\b[A-Z]{5}\d{6}[A-Z\d]{5}\b", 0.8), (r"\b[A-Z]{5}\s?\d{6}\s?[A-Z\d]{5}\b", 0.75)),
    "UK_PASSPORT": ((r"\b\d{9}\b", 0.5),),
    "UK_BANK_ACCOUNT": ((r"\b\d{2}-\d{2}-\d{2}\b", 0.8), (r"\b\d{8}\b", 0.4), (r"\b\d{6}\b", 0.3)),
    "UK_VRN": ((r"\b[A-Z]{2}\d{2}\s?[A-Z]{3}\b", 0.8), (r"\b[A-Z]\d{1,3}\s?[A-Z]{3}\b", 0.7)),
}

VALIDATED = {"UK_NHS": NHS, "UK_NINO": NINO, "CREDIT_CARD": LUHN, "IBAN_CODE": IBAN}


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def cells_sql(source: str, key: str, columns: tuple[str, ...]) -> str:
    parts = [
        f"SELECT {key}, '{c}' AS column_name, {c} AS cell FROM {source} WHERE regexp_matches({c}, '\\S')"
        for c in columns
    ]
    return "cells AS (" + " UNION ALL ".join(parts) + ")"


def entity_ctes(
    key: str, recognizers: tuple[Recognizer, ...], threshold: float
) -> str:
    """CTEs from ``cells`` to ``entities``: findings with 0-based offsets and ord."""
    hits = []
    for r in recognizers:
        stated = [(x, score, True) for x, score in UK_PATTERNS.get(r.entity_type, ())]
        for regex, score, any_case in stated or [(p.regex, p.score, p.any_case) for p in r.patterns]:
            rx = quote(("(?i)" if any_case else "") + regex)
            hits.append(
                f"SELECT {key}, column_name, '{r.entity_type}' AS entity_type, CAST({score} AS DOUBLE) AS score, "
                f"string_split(regexp_replace(cell, {rx}, chr(1) || '\\0' || chr(1), 'g'), chr(1)) AS parts "
                f"FROM cells WHERE regexp_matches(cell, {rx})"
            )
    checks = " ".join(
        f"WHEN '{t}' THEN CASE WHEN {sql} THEN 1.0 ELSE 0.0 END"
        for t, sql in VALIDATED.items()
        if any(r.entity_type == t for r in recognizers)
    )
    checked = f"CASE entity_type {checks} ELSE score END" if checks else "score"
    near = " ".join(
        f"WHEN '{r.entity_type}' THEN regexp_matches(before_words, {quote('|'.join(r.context))})"
        for r in recognizers
        if r.context
    )
    near_case = f"CASE entity_type {near} ELSE false END" if near else "false"
    same = f"y.{key} = x.{key} AND y.column_name = x.column_name AND y.entity_type = x.entity_type"
    inside = f"""EXISTS (SELECT 1 FROM {{t}} y WHERE {same}
        AND y.start_at <= x.start_at AND y.end_at >= x.end_at
        AND (y.start_at < x.start_at OR y.end_at > x.end_at) AND y.score >= x.score)"""
    return f"""
hits AS ({" UNION ALL ".join(hits)}),
located AS (
  SELECT {key}, column_name, entity_type, score, parts[2*i] AS txt,
         array_to_string(parts[1:2*i-1], '') AS lead
  FROM (SELECT *, unnest(range(1, len(parts)//2 + 1)) AS i FROM hits)),
scored AS (
  SELECT {key}, column_name, entity_type, txt, length(lead) AS start_at, length(lead) + length(txt) AS end_at,
         lower(array_to_string(string_split(regexp_replace(lead, '\\s+', ' ', 'g'), ' ')[-6:], ' ')) AS before_words,
         {checked} AS score
  FROM located),
valid AS (
  SELECT {key}, column_name, entity_type, txt, start_at, end_at, before_words, max(score) AS score
  FROM scored WHERE score > 0 GROUP BY ALL),
once AS (SELECT * FROM valid x WHERE NOT {inside.format(t="valid")}),
raised AS (
  SELECT {key}, column_name, entity_type, txt, start_at, end_at,
         CASE WHEN {near_case} THEN least(1.0, greatest(0.4, score + CAST(0.35 AS DOUBLE))) ELSE score END AS score
  FROM once),
entities AS (
  SELECT {key}, column_name, entity_type, txt AS "text", start_at, end_at, score,
         row_number() OVER (PARTITION BY {key}, column_name
                            ORDER BY score DESC, start_at, end_at DESC, entity_type) - 1 AS ord
  FROM raised x WHERE NOT {inside.format(t="raised")} AND score >= {threshold})"""


def entities_sql(
    source: str,
    key: str,
    columns: tuple[str, ...],
    types: tuple[str, ...] | None = None,
    threshold: float = 0.3,
    ctes: str = "",
) -> str:
    """A WITH clause ending in ``entities``."""
    recognizers = tuple(
        r for r in default_recognizers() if types is None or r.entity_type in types
    )
    head = ctes.strip().rstrip(",") + ",\n" if ctes else ""
    return f"WITH {head}{cells_sql(source, key, columns)},{entity_ctes(key, recognizers, threshold)}"


def mask_sql(text: str, ch: str, n: int, direction: str) -> str:
    full = f"repeat('{ch}', length({text}))"
    if n <= 0:
        return full
    if direction == "left":
        part = f"left({text}, {n}) || repeat('{ch}', length({text}) - {n})"
    elif direction == "center":
        part = (
            f"repeat('{ch}', (length({text}) - {n}) // 2) || substr({text}, (length({text}) - {n}) // 2 + 1, {n}) "
            f"|| repeat('{ch}', length({text}) - {n} - (length({text}) - {n}) // 2)"
        )
    else:
        part = f"repeat('{ch}', length({text}) - {n}) || right({text}, {n})"
    return f"CASE WHEN length({text}) <= {n} THEN {full} ELSE {part} END"


def token_sql(text: str, prefix: str, token_key: str) -> str:
    digest = f"sha256('{token_key}' || chr(0) || '{prefix}' || chr(0) || {text})"

    def block(first: int) -> str:
        return f"to_base(CAST('0x' || substr({digest}, {first}, 10) AS BIGINT), 36, 8)"

    return f"'{prefix}' || {block(1)} || {block(11)}"


def protected_ctes(policy: Policy, key: str, salt: str, token_key: str, encrypted: str = "'ENC'") -> str:
    """CTEs from ``entities`` to ``applied`` and ``rewritten`` (cells that changed)."""
    priority, text = [], []
    for r in policy.effective():
        o = r.options
        value = {
            "sha256_hash": f"'HASH:' || sha256('{salt}' || \"text\")",
            "masking": mask_sql('"text"', o.mask_char, o.visible_chars, o.direction),
            "tokenization": token_sql('"text"', o.token_prefix, token_key),
            "aes256_encrypt": encrypted,
            "redact": "'[REDACTED]'",
        }[r.protection_method]
        priority.append(f"WHEN '{r.entity_type}' THEN {r.priority}")
        text.append(f"WHEN '{r.entity_type}' THEN {value}")
    fallback = {
        "masking": mask_sql('"text"', "*", 4, "right"),
        "redact": "'[REDACTED]'",
    }[policy.default_protection]
    method = " ".join(f"WHEN '{r.entity_type}' THEN '{r.protection_method}'" for r in policy.effective())
    return f""",
planned AS (
  SELECT *, CASE entity_type {' '.join(priority)} ELSE 999 END AS priority,
         CASE entity_type {method} ELSE '{policy.default_protection}' END AS method,
         CASE entity_type {' '.join(text)} ELSE {fallback} END AS protected
  FROM entities WHERE score >= {policy.confidence_threshold}),
applied AS (
  SELECT *, row_number() OVER (PARTITION BY {key}, column_name ORDER BY priority, ord) AS turn
  FROM planned x WHERE NOT EXISTS (
    SELECT 1 FROM planned y WHERE y.{key} = x.{key} AND y.column_name = x.column_name
      AND y.start_at <= x.start_at AND y.end_at >= x.end_at
      AND (y.priority < x.priority OR (y.priority = x.priority AND y.ord < x.ord)))),
rewritten AS (
  SELECT {key}, column_name, list_reduce(
      list_prepend({{'t': '', 'p': any_value(cell)}}, list({{'t': "text", 'p': protected}} ORDER BY turn)),
      lambda a, x: {{'t': '', 'p': replace(a.p, x.t, x.p)}}).p AS cell
  FROM applied JOIN cells USING ({key}, column_name) GROUP BY {key}, column_name)"""
