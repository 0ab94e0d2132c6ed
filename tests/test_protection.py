from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cloakframe import Detector, Options, Policy, Rule, Secrets, default_policy, detect, protect, protect_col, register_protection, tokenize, unprotect_col
from cloakframe.functions.protection import method_named, sha256_verify
from cloakframe.functions.spans import may_hold
from cloakframe.operators import vault
from cloakframe.operators.protect import applied_table, leaks, protection_summary
from cloakframe.plans.scratch import scratch_path
from cloakframe.plans.secrets import SALT_COLUMN, secret_columns

SECRETS = Secrets(bytes(range(32)), "salt", "tok")


def one(spark, value, build, secrets=SECRETS):
    df = secrets.attach(spark.createDataFrame([(value,)], "v string"))
    return df.select(build(F.col("v")).alias("x")).first().x


@pytest.mark.parametrize(
    "options,value,want",
    [
        (Options(), "1234567890", "******7890"),
        (Options(direction="left"), "1234567890", "1234******"),
        (Options(direction="center"), "1234567890", "***4567***"),
        (Options(mask_char="X"), "1234567890", "XXXXXX7890"),
        (Options(visible_chars=10), "short", "*****"),
        (Options(visible_chars=0), "abc", "***"),
        (Options(direction="center", visible_chars=2), "abcde", "*bc**"),
        (Options(), "", ""),
        (Options(), None, None),
    ],
)
def test_masking(spark, options, value, want):
    assert one(spark, value, lambda c: protect_col(c, "masking", options)) == want


def test_redact(spark):
    assert one(spark, "x", lambda c: protect_col(c, "redact")) == "[REDACTED]"
    assert one(spark, "", lambda c: protect_col(c, "redact")) == ""


def test_hash(spark):
    import hashlib

    want = "HASH:" + hashlib.sha256("saltvälue".encode()).hexdigest()
    assert one(spark, "välue", lambda c: protect_col(c, "sha256_hash", secrets=secret_columns())) == want
    assert one(spark, "välue", lambda c: sha256_verify(c, F.lit(want), F.col(SALT_COLUMN)))
    assert not one(spark, "other", lambda c: sha256_verify(c, F.lit(want), F.col(SALT_COLUMN)))
    assert not one(spark, "x", lambda c: sha256_verify(c, F.lit("nohash"), F.col(SALT_COLUMN)))


def test_encryption_round_trip_and_fresh_iv(spark):
    text = "sensitive " * 30
    df = SECRETS.attach(spark.createDataFrame([(text,), (text,), ("",)], "v string"))
    sealed = [r.v for r in df.select(protect_col(F.col("v"), "aes256_encrypt", secrets=secret_columns()).alias("v")).collect()]
    assert sealed[0] != sealed[1] and sealed[2] == "" and "\n" not in sealed[0]
    back = SECRETS.attach(spark.createDataFrame([(v,) for v in sealed], "v string"))
    got = [r.x.value for r in back.select(unprotect_col(F.col("v"), "aes256_encrypt", secret_columns()).alias("x")).collect()]
    assert got == [text, text, ""]


def test_ciphertext_layout_is_iv_then_padded_blocks(spark):
    import base64

    sealed = one(spark, "0123456789abcdef", lambda c: protect_col(c, "aes256_encrypt", secrets=secret_columns()))
    assert len(base64.b64decode(sealed.removeprefix("ENC:"))) == 16 + 32


@pytest.mark.parametrize(
    "value,error",
    [("plain", "value is not encrypted"), ("ENC:AAAA", "payload is too short"), ("ENC:*", "payload is not base64"), ("ENC:" + "A" * 64, "wrong key or damaged payload")],
)
def test_decrypt_errors(spark, value, error):
    assert one(spark, value, lambda c: unprotect_col(c, "aes256_encrypt", secret_columns())).error == error


def test_keys_are_checked_and_never_random(spark, texts):
    with pytest.raises(ValueError):
        Secrets(b"short")
    with pytest.raises(ValueError, match="AES key"):
        protect(texts("x"), default_policy(), Secrets(token_key="t"))
    with pytest.raises(ValueError, match="token key"):
        protect(texts("x"), default_policy(), Secrets(bytes(32)))


def test_keys_from_environment(monkeypatch):
    import base64

    monkeypatch.setenv("ENCRYPTION_KEY", base64.b64encode(bytes(32)).decode())
    monkeypatch.setenv("HASH_SALT", "s")
    assert Secrets.from_env().key == bytes(32) and Secrets.from_env().salt == "s"


def test_key_is_not_in_the_plan(texts):
    secret = Secrets(b"K" * 32, "very-secret-salt", "very-secret-token-key")
    plan = protect(texts("a@b.com"), default_policy(), secret)._jdf.queryExecution().toString()
    assert "KKKK" not in plan and "4B4B4B" not in plan.upper() and "very-secret" not in plan


def test_methods_by_name(spark):
    with pytest.raises(KeyError, match="Unknown protection method"):
        method_named("nope")
    for name in ("masking", "redact", "sha256_hash"):
        with pytest.raises(NotImplementedError, match="not reversible"):
            unprotect_col(F.lit("x"), name, secret_columns())


def test_every_occurrence_is_replaced_unless_by_offset(texts):
    policy = Policy((Rule("UK_CITY", "redact"),))
    df = texts("York and Yorkshire")
    detector = Detector(0.7, ("UK_CITY",))
    assert protect(df, policy, detector=detector).first().text == "[REDACTED] and [REDACTED]shire"
    assert protect(df, policy, detector=detector, by_offset=True).first().text == "[REDACTED] and Yorkshire"


def test_priority_and_containment(texts):
    # The card is found first by priority; the account number inside it is not touched.
    policy = Policy((Rule("A", "redact", 1), Rule("B", "sha256_hash", 2)))
    from cloakframe import Pattern, Recognizer

    recs = (Recognizer("A", (Pattern(r"foo bar", 0.8),)), Recognizer("B", (Pattern("bar", 0.9),)))
    assert protect(texts("foo bar"), policy, SECRETS, Detector(0.5, recognizers=recs)).first().text == "[REDACTED]"
    flipped = Policy((Rule("A", "redact", 2), Rule("B", "masking", 1, options=Options(visible_chars=0))))
    # A larger later span is not suppressed, but its text is gone by then.
    out = protect(texts("foo bar"), flipped, SECRETS, Detector(0.5, recognizers=recs), findings=True)
    assert out.first().text == "foo ***"
    assert protection_summary(out).first().protections_applied == 2


def test_unprotected_types_columns_and_order_stay(spark):
    df = spark.createDataFrame([(1, 2.5, "a@b.com", None)], "id bigint, amount double, email string, name string")
    out = protect(df, Policy((Rule("EMAIL_ADDRESS", "sha256_hash"),)), SECRETS)
    assert out.dtypes == df.dtypes
    row = out.first()
    assert row.amount == 2.5 and row.name is None and row.email.startswith("HASH:")


def test_stringify_all_scans_numbers(spark):
    df = spark.createDataFrame([(4111111111111111, None)], "card bigint, x int")
    out = protect(df, Policy((Rule("CREDIT_CARD", "redact"),)), SECRETS, Detector(0.7, ("CREDIT_CARD",)), stringify_all=True)
    assert out.first().asDict() == {"card": "[REDACTED]", "x": ""}


def test_failed_method_redacts_keeps_or_fails(texts):
    register_protection("never", lambda t, o, s: F.lit(None).cast("string"))
    policy = Policy((Rule("EMAIL_ADDRESS", "never"),))
    d = Detector(0.7, ("EMAIL_ADDRESS",))
    df = texts("a@b.com")
    assert protect(df, policy, SECRETS, d).first().text == "[REDACTED]"
    assert protect(df, policy, SECRETS, d, on_failure="keep").first().text == "a@b.com"
    assert protection_summary(protect(df, policy, SECRETS, d, findings=True)).first().failures == 1
    with pytest.raises(Exception, match="protection failed"):
        protect(df, policy, SECRETS, d, on_failure="fail").collect()


def test_no_leak_under_the_default_policy(spark):
    df = spark.createDataFrame(
        [(1, "John Smith", "john@example.com", "+44 7911 123456", "4111111111111111", "NHS 943 476 5919")],
        "id bigint, name string, email string, phone string, card string, notes string",
    )
    safe = protect(df, default_policy(), SECRETS)
    assert leaks(safe, "id", detect(df, "id")).count() == 0


def test_default_policy_is_reversible_where_it_says(spark):
    df = spark.createDataFrame([("4111111111111111",)], "card string")
    policy = replace(default_policy(), confidence_threshold=1.0)
    sealed = SECRETS.attach(protect(df, policy, SECRETS))
    assert sealed.select(unprotect_col(F.col("card"), "aes256_encrypt", secret_columns()).alias("x")).first().x.value == "4111111111111111"


# Vault -----------------------------------------------------------------------

def test_tokens_are_stable_prefixed_and_reversible(spark, texts):
    df = texts("v", "v", "w", "", None)
    out, pairs = tokenize(df, "text", SECRETS, options=Options(token_prefix="CUSTOM_"))
    tokens = {r.id: r.text for r in out.collect()}
    assert tokens[0] == tokens[1] != tokens[2] and tokens[3] == "" and tokens[4] is None
    assert tokens[0].startswith("CUSTOM_") and len(tokens[0]) == len("CUSTOM_") + 16
    assert pairs.count() == 2
    back = vault.detokenize(out, "text", pairs, Options(token_prefix="CUSTOM_"))
    assert {r.id: r.text for r in back.collect()} == {0: "v", 1: "v", 2: "w", 3: "", 4: None}


def test_detokenize_errors(spark, texts):
    table = spark.createDataFrame([("v", "TOK_", "TOK_1", None)], vault.VAULT_SCHEMA)
    rows = vault.detokenize(texts("XXX_1", "TOK_UNKNOWN", "TOK_1"), "text", table).collect()
    assert {r.id: r.text_error for r in rows} == {0: "invalid token format", 1: "token not found", 2: None}


def test_vault_on_disk_appends_only_new_pairs_and_clears(spark, texts):
    path = scratch_path(spark, "vault-test")
    _, pairs = tokenize(texts("a", "b"), "text", SECRETS)
    assert vault.append_pairs(path, pairs) == 2
    _, more = tokenize(texts("b", "c"), "text", SECRETS)
    assert vault.append_pairs(path, more) == 1
    stored = spark.read.parquet(path)
    assert vault.vault_size(stored).first().size == 3 and vault.collisions(stored).isEmpty()
    vault.clear_vault(spark, path)
    assert vault.vault_size(spark.read.schema(vault.VAULT_SCHEMA).parquet(path)).first().size == 0


def test_a_token_collision_is_refused(spark):
    path = scratch_path(spark, "vault-test")
    pairs = spark.createDataFrame([("a", "T", "T1"), ("b", "T", "T1")], "value string, prefix string, token string")
    with pytest.raises(ValueError, match="collision"):
        vault.append_pairs(path, pairs)


def test_existing_tokens_are_kept(spark, texts):
    known = spark.createDataFrame([("v", "TOK_", "TOK_OLD", None)], vault.VAULT_SCHEMA)
    out, fresh = tokenize(texts("v", "w"), "text", SECRETS, known)
    assert {r.id: r.text for r in out.collect()}[0] == "TOK_OLD"
    assert [r.value for r in fresh.collect()] == ["w"]


def test_lookup_with_hot_key_equals_a_plain_join(spark):
    left = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).cast("string").alias("k"))
    right = spark.range(0, 5000, 2).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("v")).unionByName(
        spark.createDataFrame([("-1", 7)], "k string, v bigint")
    )
    got = sorted(map(tuple, vault.lookup(left, "k", right).select("id", "k", "v").collect()))
    want = sorted(map(tuple, left.join(right, "k", "left").select("id", "k", "v").collect()))
    assert got == want


def test_pairs_come_from_cells_that_can_hold_a_token(spark):
    """Only cells in which a tokenized type can be found are searched; the pairs are those of a search of all."""
    cells = ["nhs 9434765919", "943 476 5919", "\u00019434765919\u0001", "9434765918", "passport 123456789", "ref 123456789", "my\nTRAVEL  123456789",
             "ann@example.com, 07123 456789, passport 123456789", "ABCDE123456ABCDE or London", "Mr Brown at ann@example.com", "", " ", None]
    df = spark.createDataFrame(list(enumerate(cells)), "id long, text string")
    policy = default_policy()
    policies = [policy, Policy((Rule("UK_NHS", "masking"),), default_protection="tokenization"), replace(policy, confidence_threshold=0.3)]
    for p in policies:
        every = applied_table(df, "id", p, SECRETS).where("method = 'tokenization'")
        some = applied_table(df, "id", p, SECRETS, method="tokenization")
        assert some.columns == every.columns and some.count() > 3
        assert sorted(map(str, some.collect())) == sorted(map(str, every.collect()))
    own = [r for r in Detector().active() if r.entity_type in ("UK_NHS", "UK_PASSPORT", "UK_DRIVERS_LICENSE")]
    held = df.select("id", may_hold(F.col("text"), own, 0.7).alias("may")).where("may").collect()
    assert [r.id for r in held] == [0, 1, 2, 3, 4, 6, 7, 8]
