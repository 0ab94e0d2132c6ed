"""Token vault: a table of ``(value, prefix, token, created_at)``.

Tokens are keyed, so tokenizing needs no lookup; the vault is what makes them
reversible.  One writer per run appends only new pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakframe.functions.protection import Options, keyed_token
from cloakframe.operators.protect import applied_table
from cloakframe.plans.scratch import exists, remove, scratch_path
from cloakframe.plans.secrets import TOKEN_KEY_COLUMN, Secrets

VAULT_SCHEMA = "value string, prefix string, token string, created_at timestamp"

# A key is hot when it holds more than 1 row in HOT_SHARE; at most HOT_SHARE
# keys can be hot, so the broadcast table of hot keys is bounded.
HOT_SHARE = 1000


def empty_vault(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], VAULT_SCHEMA)


def lookup(left: DataFrame, key: str, table: DataFrame) -> DataFrame:
    """Left join on ``key`` to a table with one row per key, safe for hot keys.

    The rows of hot keys meet a broadcast table of at most HOT_SHARE rows; all
    others go through an ordinary join, where no key is frequent any more.  Null
    keys match nothing, so they are dealt out instead of meeting in one task.
    """
    counts = left.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("t")).select("t").scalar()
    hot_keys = counts.filter(F.col("_n") * F.lit(HOT_SHARE) > total).select(key, F.lit(True).alias("_hot"))
    hot_rows = F.broadcast(table.join(F.broadcast(hot_keys), key, "left_semi"))
    marked = left.join(F.broadcast(hot_keys), key, "left")
    hot = marked.filter(F.col("_hot").isNotNull()).drop("_hot").join(hot_rows, key, "left")
    deal = F.when(F.col(key).isNull(), F.monotonically_increasing_id() % HOT_SHARE).otherwise(0)
    rest = marked.filter(F.col("_hot").isNull()).drop("_hot").withColumn("_deal", deal)
    cold = rest.join(table.filter(F.col(key).isNotNull()).withColumn("_deal", F.lit(0).cast("bigint")), [key, "_deal"], "left").drop("_deal")
    return hot.unionByName(cold)


def new_pairs(pairs: DataFrame, vault: DataFrame) -> DataFrame:
    """Distinct ``(value, prefix, token)`` not yet in the vault, as vault rows."""
    return (
        pairs.select("value", "prefix", "token")
        .distinct()
        .join(vault.hint("merge"), ["value", "prefix"], "left_anti")  # a vault grows with the data: never broadcast
        .select("value", "prefix", "token", F.current_timestamp().alias("created_at"))
    )


def collisions(vault: DataFrame) -> DataFrame:
    """Tokens standing for more than one value; must be empty before an append."""
    return (
        vault.groupBy("token")
        .agg(F.count("*").alias("values"))
        .filter(F.col("values") > 1)
    )


def append_pairs(vault_path: str, pairs: DataFrame) -> int:
    """Register new pairs in the vault table; returns how many were new.

    The new rows are written once to a staging folder next to the vault, so the
    collision check and the append see the same rows even if executors fail.
    """
    spark = pairs.sparkSession
    vault = spark.read.schema(VAULT_SCHEMA).parquet(vault_path) if exists(spark, vault_path) else empty_vault(spark)
    staging = scratch_path(spark, "vault")
    try:
        new_pairs(pairs, vault).write.parquet(staging)
        fresh = spark.read.schema(VAULT_SCHEMA).parquet(staging)
        # Tokens of the vault are distinct already: only new ones can collide.
        taken = vault.select("token").join(fresh.select("token"), "token", "left_semi")
        if not collisions(fresh).isEmpty() or not taken.isEmpty():
            raise ValueError("token collision: change the token key")
        fresh.write.mode("append").parquet(vault_path)
        return fresh.count()
    finally:
        remove(spark, staging)


def _known(vault: DataFrame, options: Options) -> DataFrame:
    """``(value, token)`` of one prefix, one row per value: the oldest of pairs that repeat."""
    own = vault.filter(F.col("prefix") == options.token_prefix)
    return own.groupBy("value").agg(F.min(F.struct("created_at", "token")).alias("first")).select("value", "first.token")


def tokenize(
    df: DataFrame,
    column: str,
    secrets: Secrets,
    vault: DataFrame | None = None,
    options: Options = Options(),
) -> tuple[DataFrame, DataFrame]:
    """``(df with tokens in column, new vault rows)``.

    With a vault, a pair it already holds keeps its token (vaults filled by
    another system have tokens of their own); all other values get keyed ones.
    """
    secrets.check(["tokenization"])
    prefix = F.lit(options.token_prefix)
    blank = F.col(column).isNull() | (F.col(column) == "")

    def keyed(frame: DataFrame, value: Column) -> Column:
        return keyed_token(value, prefix, F.col(TOKEN_KEY_COLUMN))

    spark = df.sparkSession
    values = secrets.attach(df.select(F.col(column).alias("value")).filter("value <> ''").distinct())
    pairs = values.select("value", prefix.alias("prefix"), keyed(values, F.col("value")).alias("token"))
    keyed_df = secrets.attach(df)
    token = keyed(keyed_df, F.col(column))
    if vault is None:
        out = keyed_df.withColumn(column, F.when(blank, F.col(column)).otherwise(token))
        return out.select(*df.columns), new_pairs(pairs, empty_vault(spark))
    known = _known(vault, options).select(F.col("value").alias(column), F.col("token").alias("_known"))
    merged = secrets.attach(lookup(df, column, known))
    out = merged.withColumn(
        column, F.when(blank, F.col(column)).otherwise(F.coalesce("_known", keyed(merged, F.col(column))))
    )
    return out.select(*df.columns), new_pairs(pairs, vault)


def detokenize(df: DataFrame, column: str, vault: DataFrame, options: Options = Options()) -> DataFrame:
    """``df`` with ``column`` resolved and ``<column>_error`` for what could not be."""
    value, error = "_value", f"{column}_error"
    table = vault.select(F.col("token").alias(column), F.col("value").alias(value))
    joined = lookup(df, column, table)
    blank = F.col(column).isNull() | (F.col(column) == "")
    reason = (
        F.when(blank, F.lit(None).cast("string"))
        .when(~F.startswith(F.col(column), F.lit(options.token_prefix)), "invalid token format")
        .when(F.col(value).isNull(), "token not found")
    )
    resolved = F.when(blank, F.col(column)).when(F.col(error).isNull(), F.col(value))
    return joined.withColumn(error, reason).withColumn(column, resolved).select(*df.columns, error)


def token_pairs(df: DataFrame, key: str, policy, secrets: Secrets, detector=None, columns=None) -> DataFrame:
    """``(value, prefix, token)`` of all tokens a policy puts into a table."""
    return (
        applied_table(df, key, policy, secrets, detector, columns, method="tokenization")
        .filter("NOT failed")
        .select(F.col("text").alias("value"), F.col("token_prefix").alias("prefix"), F.col("protected").alias("token"))
    )


def tokens_of(vault: DataFrame, values: DataFrame, options: Options = Options()) -> DataFrame:
    """Token of each row's ``value`` (null if none) under the options' prefix: one row in, one row out."""
    return lookup(values, "value", _known(vault, options).select("value", "token"))


def vault_size(vault: DataFrame) -> DataFrame:
    return vault.agg(F.count("*").alias("size"))


def clear_vault(spark: SparkSession, vault_path: str) -> None:
    empty_vault(spark).write.mode("overwrite").parquet(vault_path)
