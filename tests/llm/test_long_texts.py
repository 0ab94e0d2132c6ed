"""Very many findings in one text, and sets of many components in one list."""

import random
import re
import time

from pyspark.sql import functions as F

from cloakframe.llm import near_dups, private


def test_many_numbers_in_a_text_end_soon(spark):
    text = " ".join(str(k * 7919 % 100003) for k in range(40_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert df.select(F.size(private._matches(F.col("text"), private.CANDIDATE))).first()[0] == 40_000  # also warms up
    began = time.time()
    df.select(F.size(private._matches(F.col("text"), private.CANDIDATE))).collect()
    assert time.time() - began < 20


def test_tokens_apart_from_base_spans(spark):
    rng = random.Random(1)
    words = ["a1", "x@y.org,", "4111 1111 1111 1111", "+44 20 7946 0958", "10.0.0.1", "plain", "7", "no.2;"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(60))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    base = F.concat(*private._base(F.col("text")).values())
    got = df.withColumn("base", base).withColumn("tokens", private._matches(F.col("text"), private.CANDIDATE)).select("text", "base", "tokens", private._apart(F.col("tokens"), F.col("base")).alias("apart"))
    for r in got.collect():
        tokens = [m.span() for m in re.finditer(r"(?<!\S)(?=\S*[0-9@])\S+", r.text)]
        assert [(t.start, t.end) for t in r.tokens] == tokens and all(r.text[t.start : t.end] == t.value for t in r.tokens)
        assert [(t.start, t.end) for t in r.apart] == [(s, e) for s, e in tokens if all(b.end <= s or e <= b.start for b in r.base)]


def test_many_components_in_a_block_give_few_links(spark):
    """Every text links with every other, but has a component of its own: a call keeps a spanning forest."""
    import pyarrow as pa

    from cloakframe.llm.stage import zstandard

    text = zstandard.ZstdCompressor().compress(b"one two three four five six")
    n = 60
    table = pa.table({"rep": pa.array(range(n), pa.int64()), "main": pa.array([0] * n, pa.int64()), "block": pa.array([k % 2 for k in range(n)], pa.int64()), "component": pa.array(range(n), pa.int64()), "asks": pa.array([k >= 20 for k in range(n)]), "text": pa.array([text] * n, pa.binary())})
    links = near_dups._block_stage(2, 80)(table)
    assert links.num_rows == n - 2  # two blocks, nothing between them
