"""Protection, vault and schema-check queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakframe.functions.protection import (
    Options,
    mask,
    protect_col,
    register_protection,
    sha256_hash,
    sha256_verify,
    unprotect_col,
)
from cloakframe.operators import compare, vault
from cloakframe.operators.detect import Detector, detect
from cloakframe.operators.protect import leaks, protect, protection_counts
from cloakframe.operators.schema_check import column_differences, is_valid, schema_check
from cloakframe.plans.policy import Policy, Rule, default_policy
from cloakframe.plans.scratch import scratch_path
from cloakframe.plans.secrets import KEY_COLUMN, SALT_COLUMN, Secrets, secret_columns
from suite.detection import table, texts
from suite.oracle_text import entities_sql, mask_sql, protected_ctes, token_sql
from suite.people import PEOPLE_SQL, TEXT_COLUMNS, people

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

# Values for these queries only; a job takes its own from Secrets.from_env().
SALT, TOKEN_KEY = "pepper", "token-key"
SECRETS = Secrets(bytes(range(32)), SALT, TOKEN_KEY)
POLICY = default_policy()


def query(name: str, oracle: str | None):
    def add(run):
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return run

    return add


def with_people(select: str) -> str:
    return f"WITH {PEOPLE_SQL} {select}"


def without_ciphertext(df: DataFrame, columns) -> DataFrame:
    """Encrypted text differs in every run, so it is compared as ``ENC``."""
    return df.withColumns({c: F.regexp_replace(c, "ENC:[A-Za-z0-9+/=]+", "ENC") for c in columns})


# Single methods ------------------------------------------------------------

MASKS = {
    "keep_right": Options(),
    "keep_left": Options(direction="left"),
    "keep_center": Options(direction="center", visible_chars=5),
    "other_char": Options(mask_char="X"),
    "keep_none": Options(visible_chars=0),
    "too_short": Options(visible_chars=30),
}


@query(
    "mask_people",
    with_people(
        "SELECT row_key, " + ", ".join(
            f"CASE WHEN notes = '' THEN '' ELSE {mask_sql('notes', o.mask_char, o.visible_chars, o.direction)} END AS {n}"
            for n, o in MASKS.items()
        ) + " FROM people"
    ),
)
def mask_people(spark, sf_dir):
    return people(spark, sf_dir).select(
        "row_key", *[protect_col(F.col("notes"), "masking", o).alias(n) for n, o in MASKS.items()]
    )


@query("hash_people", with_people(f"SELECT row_key, 'HASH:' || sha256('{SALT}' || email) AS email, CASE WHEN notes = '' THEN '' ELSE 'HASH:' || sha256('{SALT}' || notes) END AS notes FROM people"))
def hash_people(spark, sf_dir):
    df = SECRETS.attach(people(spark, sf_dir))
    return df.select("row_key", *[protect_col(F.col(c), "sha256_hash", secrets=secret_columns()).alias(c) for c in ("email", "notes")])


@query("verify_hash_people", with_people("SELECT count(*) AS checked, count(*) AS own_value, 0 AS other_value, 0 AS not_a_hash FROM people"))
def verify_hash_people(spark, sf_dir):
    df = SECRETS.attach(people(spark, sf_dir))
    salt = F.col(SALT_COLUMN)
    hashed = sha256_hash(F.col("email"), salt)
    return df.agg(
        F.count("*").alias("checked"),
        F.count_if(sha256_verify(F.col("email"), hashed, salt)).alias("own_value"),
        F.count_if(sha256_verify(F.col("phone"), hashed, salt)).alias("other_value"),
        F.count_if(sha256_verify(F.col("email"), F.col("email"), salt)).alias("not_a_hash"),
    )


@query("redact_people", with_people("SELECT row_key, CASE WHEN notes = '' THEN '' ELSE '[REDACTED]' END AS notes FROM people"))
def redact_people(spark, sf_dir):
    return people(spark, sf_dir).select("row_key", protect_col(F.col("notes"), "redact").alias("notes"))


@query(
    "encrypt_roundtrip_people",
    with_people("SELECT row_key, card AS decrypted, true AS marked, CASE WHEN notes = '' THEN '' ELSE notes END AS notes FROM people"),
)
def encrypt_roundtrip_people(spark, sf_dir):
    df = SECRETS.attach(people(spark, sf_dir))
    s = secret_columns()
    sealed = df.select("row_key", KEY_COLUMN, protect_col(F.col("card"), "aes256_encrypt", secrets=s).alias("card"), protect_col(F.col("notes"), "aes256_encrypt", secrets=s).alias("notes"))
    return sealed.select(
        "row_key",
        unprotect_col(F.col("card"), "aes256_encrypt", s).value.alias("decrypted"),
        F.startswith("card", F.lit("ENC:")).alias("marked"),
        unprotect_col(F.col("notes"), "aes256_encrypt", s).value.alias("notes"),
    )


@query(
    "decrypt_errors_people",
    with_people(
        """SELECT row_key, CASE row_key % 4 WHEN 0 THEN 'value is not encrypted' WHEN 1 THEN 'payload is too short'
        WHEN 2 THEN 'payload is not base64' ELSE '' END AS error FROM people"""
    ),
)
def decrypt_errors_people(spark, sf_dir):
    df = SECRETS.attach(people(spark, sf_dir))
    kind = F.col("row_key") % 4
    text = F.when(kind == 0, F.col("card")).when(kind == 1, "ENC:AAAA").when(kind == 2, "ENC:*").otherwise("")
    return df.select("row_key", F.coalesce(unprotect_col(text, "aes256_encrypt", secret_columns()).error, F.lit("")).alias("error"))


# Whole policies ------------------------------------------------------------

def _protect_text(name: str, source: str, key: str, column: str, policy: Policy) -> None:
    @query(
        name,
        entities_sql(source, key, (column,), None, policy.confidence_threshold)
        + protected_ctes(policy, key, SALT, TOKEN_KEY)
        + f' SELECT d.{key}, coalesce(r.cell, d.{column}) AS {column} FROM {source} d LEFT JOIN rewritten r ON r.{key} = d.{key}',
    )
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = texts(spark, sf_dir, source, key, column)
        return without_ciphertext(protect(df, policy, SECRETS, columns=[column]), [column])


_protect_text("protect_documents", "documents", "doc_id", "text", POLICY)
_protect_text("protect_pages", "pages", "page_id", "html", POLICY)
_protect_text("protect_documents_low_threshold", "documents", "doc_id", "text", replace(POLICY, confidence_threshold=0.3))
_protect_text(
    "protect_documents_email_hash",
    "documents",
    "doc_id",
    "text",
    Policy((Rule("EMAIL_ADDRESS", "sha256_hash"),), default_protection="redact"),
)

_PEOPLE_POLICY = entities_sql("people", "row_key", TEXT_COLUMNS, None, 0.7, PEOPLE_SQL) + protected_ctes(POLICY, "row_key", SALT, TOKEN_KEY)
_WIDE = ", ".join(
    f"coalesce((SELECT cell FROM rewritten r WHERE r.row_key = p.row_key AND column_name = '{c}'), p.{c}) AS {c}"
    for c in TEXT_COLUMNS
)


@query("protect_people", _PEOPLE_POLICY + f" SELECT p.row_key, {_WIDE} FROM people p")
def protect_people(spark, sf_dir):
    return without_ciphertext(protect(people(spark, sf_dir), POLICY, SECRETS), TEXT_COLUMNS)


@query(
    "protect_people_by_offset",
    _PEOPLE_POLICY + """
    SELECT p.row_key, coalesce(r.notes, p.notes) AS notes FROM people p LEFT JOIN (
      SELECT row_key, list_reduce(list_prepend({'s': 0, 'e': 0, 'p': any_value(cell)},
          list({'s': start_at, 'e': end_at, 'p': protected} ORDER BY start_at DESC)),
          lambda a, x: {'s': 0, 'e': 0, 'p': left(a.p, x.s) || x.p || substr(a.p, x.e + 1)}).p AS notes
      FROM applied JOIN cells USING (row_key, column_name) WHERE column_name = 'notes' GROUP BY row_key) r USING (row_key)""",
)
def protect_people_by_offset(spark, sf_dir):
    df = people(spark, sf_dir).select("row_key", "notes")
    return without_ciphertext(protect(df, POLICY, SECRETS, by_offset=True), ["notes"])


@query("protection_counts_people", _PEOPLE_POLICY + " SELECT method, count(*) AS applied, 0 AS failures FROM applied GROUP BY method")
def protection_counts_people(spark, sf_dir):
    return protection_counts(protect(people(spark, sf_dir), POLICY, SECRETS, findings=True))


@query("leaks_people", with_people("SELECT 0 AS leaks, count(*) AS rows FROM people"))
def leaks_people(spark, sf_dir):
    df = people(spark, sf_dir)
    safe = protect(df, POLICY, SECRETS)
    found = detect(df, "row_key", Detector(0.7))
    return leaks(safe, "row_key", found).agg(F.count("*").alias("leaks")).select(
        "leaks", safe.agg(F.count("*").alias("n")).select("n").scalar().alias("rows")
    )


@query(
    "decrypt_protected_cards_people",
    with_people("SELECT row_key, card FROM people WHERE row_key % 13 <> 0"),
)
def decrypt_protected_cards_people(spark, sf_dir):
    df = people(spark, sf_dir).select("row_key", "card")
    policy = replace(POLICY, confidence_threshold=1.0)
    sealed = SECRETS.attach(protect(df, policy, SECRETS).filter(F.startswith("card", F.lit("ENC:"))))
    return sealed.select("row_key", unprotect_col(F.col("card"), "aes256_encrypt", secret_columns()).value.alias("card"))


register_protection("reverse_text", lambda text, options, secrets: F.reverse(text))
register_protection("refuse", lambda text, options, secrets: F.lit(None).cast("string"))


@query("custom_method_people", with_people("SELECT row_key, reverse(email) AS email FROM people"))
def custom_method_people(spark, sf_dir):
    policy = Policy((Rule("EMAIL_ADDRESS", "reverse_text"),))
    detector = Detector(0.7, ("EMAIL_ADDRESS",))
    return protect(people(spark, sf_dir).select("row_key", "email"), policy, SECRETS, detector)


@query(
    "failed_actions_people",
    with_people("SELECT row_key, '[REDACTED]' AS redacted, email AS kept, 1 AS failures FROM people"),
)
def failed_actions_people(spark, sf_dir):
    policy = Policy((Rule("EMAIL_ADDRESS", "refuse"),))
    detector = Detector(0.7, ("EMAIL_ADDRESS",))
    df = people(spark, sf_dir).select("row_key", F.col("email").alias("redacted"), F.col("email").alias("kept"))
    one = protect(df, policy, SECRETS, detector, columns=["redacted"], findings=True)
    two = protect(one.drop("_findings"), policy, SECRETS, detector, columns=["kept"], on_failure="keep", findings=True)
    failures = F.size(F.filter(F.flatten(F.transform("_findings", lambda f: f.applied)), lambda a: a.failed))
    return two.select("row_key", "redacted", "kept", failures.alias("failures"))


# Vault ---------------------------------------------------------------------

@query("tokenize_people", with_people(f"SELECT row_key, CASE WHEN notes = '' THEN '' ELSE {token_sql('notes', 'TOK_', TOKEN_KEY)} END AS notes FROM people"))
def tokenize_people(spark, sf_dir):
    df, _ = vault.tokenize(people(spark, sf_dir).select("row_key", "notes"), "notes", SECRETS)
    return df


def _vault(spark, sf_dir, policy=POLICY):
    pairs = vault.token_pairs(people(spark, sf_dir), "row_key", policy, SECRETS)
    return vault.new_pairs(pairs, vault.empty_vault(spark))


_VAULT_SQL = _PEOPLE_POLICY + """, vault AS (
  SELECT DISTINCT "text" AS value, 'TOK_' AS prefix, protected AS token FROM applied WHERE method = 'tokenization')"""


@query("vault_pairs_people", _VAULT_SQL + " SELECT * FROM vault")
def vault_pairs_people(spark, sf_dir):
    return _vault(spark, sf_dir).select("value", "prefix", "token")


@query("vault_size_people", _VAULT_SQL + " SELECT count(*) AS size, count(DISTINCT token) AS tokens, 0 AS collisions FROM vault")
def vault_size_people(spark, sf_dir):
    v = _vault(spark, sf_dir)
    return vault.vault_size(v).select(
        "size",
        v.agg(F.count_distinct("token").alias("n")).select("n").scalar().alias("tokens"),
        vault.collisions(v).agg(F.count("*").alias("n")).select("n").scalar().alias("collisions"),
    )


@query("tokens_of_people", _VAULT_SQL + " SELECT row_key, p.nhs AS value, v.token IS NOT NULL AS known FROM people p LEFT JOIN vault v ON v.value = p.nhs")
def tokens_of_people(spark, sf_dir):
    asked = people(spark, sf_dir).select("row_key", F.col("nhs").alias("value"))
    return vault.tokens_of(_vault(spark, sf_dir), asked).select("row_key", "value", F.col("token").isNotNull().alias("known"))


@query("new_vault_rows_people", _VAULT_SQL + " SELECT count(*) AS added FROM vault WHERE CAST(right(value, 1) AS INT) >= 5")
def new_vault_rows_people(spark, sf_dir):
    # The vault is a table, as append_pairs leaves it: detection runs once, not once per side of the comparison.
    path = scratch_path(spark, "vault")
    _vault(spark, sf_dir).write.parquet(path)
    v = spark.read.schema(vault.VAULT_SCHEMA).parquet(path)
    known = v.filter(F.right("value", F.lit(1)).cast("int") < 5)
    return vault.new_pairs(v, known).agg(F.count("*").alias("added"))


@query(
    "detokenize_orders",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 1 THEN '' WHEN o_orderkey % 10 = 2 THEN '' ELSE o_orderstatus || '-' || o_custkey END AS code,
       CASE WHEN o_orderkey % 10 = 1 THEN 'invalid token format' WHEN o_orderkey % 10 = 2 THEN 'token not found' ELSE '' END AS code_error
       FROM orders""",
)
def detokenize_orders(spark, sf_dir):
    k = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat_ws("-", "o_orderstatus", F.col("o_custkey").cast("string")).alias("code")
    )
    tokens, pairs = vault.tokenize(orders, "code", SECRETS)
    spoiled = tokens.withColumn("code", F.when(k % 10 == 1, "XXX_1").when(k % 10 == 2, "TOK_UNKNOWN").otherwise(F.col("code")))
    out = vault.detokenize(spoiled, "code", pairs)
    return out.select("o_orderkey", F.coalesce("code", F.lit("")).alias("code"), F.coalesce("code_error", F.lit("")).alias("code_error"))


@query(
    "tokenize_hot_values_lineitem",
    f"""SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN 'OLD_N' ELSE {token_sql('l_returnflag', 'TOK_', TOKEN_KEY)} END AS l_returnflag
    FROM lineitem""",
)
def tokenize_hot_values_lineitem(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    # The vault knows one value already, under a token made elsewhere.
    known = lines.filter("l_returnflag = 'N'").select(
        F.col("l_returnflag").alias("value"), F.lit("TOK_").alias("prefix"), F.lit("OLD_N").alias("token"), F.lit(None).cast("timestamp").alias("created_at")
    ).distinct()
    return vault.tokenize(lines, "l_returnflag", SECRETS, known)[0]


# Shape ---------------------------------------------------------------------

def _changed_orders(spark, sf_dir):
    before = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    after = before.filter("o_orderkey % 7 <> 0").select(
        F.col("o_custkey").cast("string").alias("o_custkey"),
        F.col("o_orderkey").cast("double").alias("o_orderkey"),
        F.when(F.col("o_custkey") % 5 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        F.lit("x").alias("added"),
    )
    return before, after


_ISSUES = """WITH after AS (SELECT * FROM orders WHERE o_orderkey % 7 <> 0),
issues AS (
  SELECT 'error' AS severity, 'Column ''o_totalprice'' missing in protected data' AS message, 'o_totalprice' AS "column"
  UNION ALL SELECT 'warning', 'Extra column ''added'' in protected data', 'added'
  UNION ALL SELECT 'warning', 'Column order differs from original', ''
  UNION ALL SELECT 'info', 'Type widened for ''o_custkey'': bigint -> string', 'o_custkey'
  UNION ALL SELECT 'info', 'Type widened for ''o_orderkey'': bigint -> double', 'o_orderkey'
  UNION ALL SELECT 'warning', 'Column ''o_orderstatus'' gained null values after protection', 'o_orderstatus'
  UNION ALL SELECT 'error', 'Row count mismatch: ' || (SELECT count(*) FROM orders) || ' -> ' || (SELECT count(*) FROM after), '')"""


@query("schema_issues_orders", _ISSUES + ' SELECT severity, message, "column" FROM issues')
def schema_issues_orders(spark, sf_dir):
    return schema_check(*_changed_orders(spark, sf_dir)).select("severity", "message", F.coalesce("column", F.lit("")).alias("column"))


@query("schema_valid_orders", _ISSUES + """ SELECT false AS is_valid, count(*) FILTER (severity = 'error') AS errors,
  count(*) FILTER (severity = 'warning') AS warnings, count(*) FILTER (severity = 'info') AS infos FROM issues""")
def schema_valid_orders(spark, sf_dir):
    return is_valid(schema_check(*_changed_orders(spark, sf_dir)))


@query("schema_valid_people", with_people("SELECT true AS is_valid, 0 AS errors, 0 AS warnings, 0 AS infos"))
def schema_valid_people(spark, sf_dir):
    df = people(spark, sf_dir)
    return is_valid(schema_check(df, protect(df, POLICY, SECRETS), strict_types=True, allow_type_widening=False))


@query(
    "schema_null_details_orders",
    """SELECT 'o_orderstatus' AS "column", '0' AS original_nulls,
    CAST(count(*) FILTER (o_custkey % 5 = 0) AS VARCHAR) AS protected_nulls FROM orders WHERE o_orderkey % 7 <> 0""",
)
def schema_null_details_orders(spark, sf_dir):
    issues = schema_check(*_changed_orders(spark, sf_dir)).filter("details['protected_nulls'] IS NOT NULL")
    return issues.select("column", F.col("details")["original_nulls"].alias("original_nulls"), F.col("details")["protected_nulls"].alias("protected_nulls"))


@query(
    "column_differences_customers",
    """SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'b' ELSE '' END AS missing,
    CASE WHEN c_custkey % 3 = 0 THEN 'd' ELSE '' END AS extra, c_custkey % 5 <> 0 AS same_order FROM customer""",
)
def column_differences_customers(spark, sf_dir):
    k = F.col("c_custkey")
    kept = F.when(k % 5 == 0, F.array(F.lit("c"), F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("c")))
    middle = F.when(k % 2 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("b")))
    # b sits between a and c in the original; in the protected list it comes last or first.
    original = F.array(F.lit("a"), F.lit("c"), F.lit("b"))
    protected = F.concat(kept, middle, F.when(k % 3 == 0, F.array(F.lit("d"))).otherwise(F.array().cast("array<string>")))
    lists = table(spark, sf_dir, "customer").select("c_custkey", original.alias("original"), protected.alias("protected"))
    return column_differences(lists).select(
        "c_custkey", F.array_join("missing", ",").alias("missing"), F.array_join("extra", ",").alias("extra"), "same_order"
    )


_CHANGED = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, (SELECT count(*) FROM people) AS rows, (SELECT count(*) FROM rewritten JOIN people USING (row_key) WHERE column_name = '{c}' AND cell <> people.{c}) AS changed"
    for c in TEXT_COLUMNS
)


@query("changed_cells_people", _PEOPLE_POLICY + f" SELECT * FROM ({_CHANGED})")
def changed_cells_people(spark, sf_dir):
    df = people(spark, sf_dir)
    return compare.changed_cells(df, protect(df, POLICY, SECRETS), "row_key")


@query(
    "preview_people",
    _PEOPLE_POLICY + """ SELECT p.row_key, p.name AS name_original, p.city AS city_original,
      n.cell AS name_protected, c.cell AS city_protected
    FROM (SELECT * FROM people ORDER BY row_key LIMIT 10) p
    JOIN rewritten n ON n.row_key = p.row_key AND n.column_name = 'name'
    JOIN rewritten c ON c.row_key = p.row_key AND c.column_name = 'city'""",
)
def preview_people(spark, sf_dir):
    df = people(spark, sf_dir)
    # Protection is row by row, so only the rows shown are protected; all keys are read to find them.
    shown = df.select("row_key").orderBy("row_key").limit(10).distinct()
    asked = df.join(F.broadcast(shown), "row_key", "left_semi")
    return compare.preview(df, protect(asked, POLICY, SECRETS), "row_key", ["name", "city"])


@query("mask_column_options_people", with_people("""SELECT row_key, CASE WHEN row_key % 2 = 0
  THEN repeat('#', length(phone) - 3) || right(phone, 3) ELSE left(phone, 2) || repeat('*', length(phone) - 2) END AS phone FROM people"""))
def mask_column_options_people(spark, sf_dir):
    even = F.col("row_key") % 2 == 0
    options = F.when(even, Options("#", 3, "right").column()).otherwise(Options("*", 2, "left").column())
    df = people(spark, sf_dir).withColumn("o", options)
    return df.select("row_key", mask(F.col("phone"), F.col("o")).alias("phone"))
