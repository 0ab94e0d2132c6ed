"""Quality by perplexity: an interpolated modified Kneser-Ney model of trusted texts, thresholds by language.

The words of trusted texts are modelled by ``word_model``, whose tables grow with the corpus and stay
sharded.  One in ``FOLD`` distinct trusted texts, chosen by a hash of the text so that copies stay
together, is held out of the model: the limit of a language is the ``UPPER`` quantile of its held-out
texts.  They are as new to the model as any other text, so that share of good texts is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloakframe.llm import word_model
from cloakframe.llm.stage import forget, saved, small

#: The quantile of held-out trusted texts that is a language's limit.
UPPER = 0.998
#: Fewer texts than this do not reach the quantile: such a language has the limit of all.
LEAST = round(1 / (1 - UPPER))
#: One distinct trusted text in FOLD is held out of the model.
FOLD = 3
#: The least discount, so that what was not seen has a probability in small corpora too.
FLOOR = 0.1


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """What modified Kneser-Ney takes from counts of one, two, and three or more."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    raw = [k - (k + 1) * y * above / here if here else 0.0 for k, here, above in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return tuple(min(max(d, FLOOR), float(k)) for k, d in enumerate(raw, 1))


def thresholds(scores: DataFrame, upper: float = UPPER) -> DataFrame:
    """lang, limit: from trusted texts' (lang, nats); the row of null lang holds for all other languages."""

    def limit(*by: str) -> DataFrame:
        q = F.percentile_approx("nats", F.lit(upper), 10_000)
        return scores.where("nats is not null").groupBy(*by).agg(F.count(F.lit(1)).alias("n"), q.alias("limit"))

    whole = limit().where("n > 0").select(F.lit(None).cast("string").alias("lang"), "limit")
    return limit("lang").where((F.col("n") >= LEAST) & F.col("lang").isNotNull()).select("lang", "limit").union(whole)


def held_out(text: Column, fold: int = FOLD) -> Column:
    """Whether a trusted text is left out of the model."""
    return F.pmod(F.xxhash64(text, F.lit("fold")), F.lit(fold)) == 0


def word_nats(texts: DataFrame, trained: tuple[DataFrame, float]) -> DataFrame:
    """id (hash of the text), nats: the mean of -log p per word of each text with a word, ends included."""
    model, base = trained
    above = word_model.scores(texts.select(F.xxhash64("text").alias("id"), "text"), model)
    return above.select("id", (-F.lit(base) - F.col("above") / (F.col("n") + 1)).alias("nats"))


def rate(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", good: str = "quality") -> DataFrame:
    """``docs`` with ``perplexity`` (per word), its ``limit`` and ``kept`` added.

    Trusted are the rows of ``docs`` whose key has ``good`` = 1 in ``labels``; a key that repeats there
    counts once.  A text is rejected if its perplexity is above its language's limit; languages
    with few held-out trusted texts, and null, have the limit of all.  Null, empty and blank texts have no
    perplexity and are kept.  All are kept where nothing is trusted or nothing held out; without any
    model there is no perplexity.  Rows are independent, so repeated ones get equal results.
    Columns that have the names of the added ones are replaced.
    """
    docs = docs.drop("perplexity", "limit", "kept")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    good_keys = saved(labels.where(F.col(f"`{good}`") == 1).select(F.col(f"`{key}`").cast("long").alias("_llm_key")).where("_llm_key is not null").distinct())
    own = docs.select(F.col(f"`{key}`").cast("long").alias("_llm_key"), F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    trusted = own.join(small(good_keys, good_keys.count()), "_llm_key", "left_semi")
    trained = word_model.train(trusted.where(~held_out(F.col("text"))).select("text"))
    if trained is None:
        return docs.select(*columns, F.lit(None).cast("double").alias("perplexity"), F.lit(None).cast("double").alias("limit"), F.lit(True).alias("kept"))
    nats = saved(word_nats(own, trained))
    forget(trained[0])
    kept_out = trusted.where(held_out(F.col("text"))).select("lang", F.xxhash64("text").alias("id"))
    limits = saved(thresholds(kept_out.join(nats, "id")))
    whole = limits.where("lang is null").first()
    named = limits.where("lang is not null").select(F.col("lang").alias("_llm_lang"), F.col("limit").alias("_llm_own"))
    scored = nats.select(F.col("id").alias("_llm_id"), F.col("nats").alias("_llm_nats"))
    rated = docs.withColumn("_llm_hash", F.xxhash64(F.col(f"`{text}`").cast("string"))).join(small(scored, nats.count()), F.col("_llm_hash") == F.col("_llm_id"), "left")
    rated = rated.join(small(named, named.count()), F.col(f"`{lang}`").cast("string") == F.col("_llm_lang"), "left")
    limit = F.coalesce("_llm_own", F.lit(whole.limit if whole else None).cast("double"))
    return rated.select(*columns, F.exp("_llm_nats").alias("perplexity"), F.exp(limit).alias("limit"), F.coalesce(F.col("_llm_nats") <= limit, F.lit(True)).alias("kept"))
