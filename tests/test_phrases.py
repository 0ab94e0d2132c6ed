"""Phrases of a large list, found by a join."""

import random
import re
import time

from pyspark.sql import functions as F

from cloakframe import detect, find_phrases
from cloakframe.functions.hof import sums_before
from cloakframe.operators import phrases as module

LIST = ["Ann Lee", "Ann Lee Park", "lee park", "St. Ives", "O'Neil", "York", "New York", "Zoë Groß", "a b"]


def brute(text, phrases):
    """The leftmost, longest phrases of one text; each as a pattern of its own, without the operator's pieces."""
    out, at = [], 0
    patterns = [re.compile(r"(?<!\w)" + r"\s+".join(re.escape(w) for w in p.split()) + r"(?!\w)", re.I) for p in phrases]
    while at < len(text):
        ends = [m.end() for p in patterns if (m := p.match(text, at))]
        if ends:
            out.append((at, max(ends), text[at : max(ends)]))
        at = max(ends) if ends else at + 1
    return out


def listed(spark, phrases, kind="NAME"):
    return spark.createDataFrame([(p, kind) for p in phrases], "phrase string, entity_type string")


def test_same_spans_as_patterns(spark):
    rng = random.Random(2)
    words = ["Ann", "lee", "LEE", "Park", "St", ".", "Ives", "O'Neil", "oneil", "New", "York", "Yorker", "Zoë", "GROß", "a", "b", ",", "-"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", " ", "\n", "  ", "", "\t"]) for _ in range(40)) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for least in (module.BROADCAST_PHRASES, 0):  # the list broadcast, and shuffled
        kept, module.BROADCAST_PHRASES = module.BROADCAST_PHRASES, least
        try:
            got = {}
            for r in find_phrases(df, "id", listed(spark, LIST)).orderBy("id", "ord").collect():
                got.setdefault(r.id, []).append((r.start, r.end, r.text))
        finally:
            module.BROADCAST_PHRASES = kept
        assert got == {k: v for k, t in enumerate(texts) if (v := brute(t, LIST))}


def test_types_scores_and_schema(spark):
    df = spark.createDataFrame([("x", "Ann Lee of New York", "York")], "id string, text string, city string")
    both = spark.createDataFrame([("ann lee", "NAME", 0.9), ("Ann  Lee", "NAME", 0.7), ("Lee of", "ODD", None), ("york", None, None)], "phrase string, entity_type string, score double")
    found = find_phrases(df, "id", both)
    assert found.schema.simpleString() == detect(df, "id").schema.simpleString()
    assert [(r.column_name, r.entity_type, r.text, r.score, r.ord) for r in found.orderBy("column_name", "ord").collect()] == [
        ("city", "PHRASE", "York", 0.85, 0),
        ("text", "NAME", "Ann Lee", 0.9, 0),
        ("text", "ODD", "Lee of", 0.85, 1),
        ("text", "PHRASE", "York", 0.85, 2),
    ]
    assert find_phrases(df, "id", both, ["city"]).count() == 1


def test_odd_cells_and_lists(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "  \n"), (4, "York"), (4, "York"), (None, "\x01 York \x0bYork"), (6, "Yorks xYork")], "id long, text string")
    names = listed(spark, ["York", None, "", "  ", "York"])
    got = sorted((r.id or 0, r.start, r.end) for r in find_phrases(df, "id", names).collect())
    assert got == [(0, 2, 6), (0, 8, 12), (4, 0, 4), (4, 0, 4)]
    assert find_phrases(df, "id", names.limit(0)).count() == 0 and find_phrases(df.limit(0), "id", names).count() == 0
    assert find_phrases(df.select("id"), "id", names).count() == 0
    clash = df.select(F.col("id").alias("form"), "text", F.lit(1).alias("_cell"), F.lit("z").alias("n"))
    assert find_phrases(clash, ["form", "_cell"], names, ["text"]).columns[:2] == ["form", "_cell"]


def test_long_lists_and_long_texts(spark):
    texts = spark.range(3000).select("id", F.concat_ws(" ", *[F.concat(F.lit("w"), F.xxhash64("id", F.lit(k)) % 1000) for k in range(40)]).alias("text")).union(
        spark.createDataFrame([(-1, "York, " * 60_000)], "id long, text string")
    )
    texts = texts.repartition(8).cache()
    texts.count()

    def timed(names):
        start = time.time()
        n = find_phrases(texts, "id", names).count()
        return n, time.time() - start

    few = listed(spark, ["York", *(f"first{k} last{k}" for k in range(99))])
    many = spark.range(500_000).select(F.concat(F.lit("first"), "id", F.lit(" last"), "id").alias("phrase"), F.lit("NAME").alias("entity_type")).union(listed(spark, ["York"]))
    timed(few)
    (a, quick), (b, slow) = timed(few), timed(many)
    assert a == b == 60_000 and slow < 2 * quick + 5


def test_work_per_piece_does_not_follow_the_text(spark):
    """Long and short texts cost the same by piece, and the sums of what stands before are exact."""
    sizes = [0, 1, 7, 8, 9, 63, 64, 65, 511, 513, 5000]
    df = spark.createDataFrame([(n, [k % 7 for k in range(n)]) for n in sizes], "n int, v array<int>")
    for levels in (0, 1, 3):
        for r in df.select("n", "v", sums_before(F.col("v"), levels).alias("s")).collect():
            assert r.s == [sum(r.v[:k]) for k in range(r.n)]
    rows = 150_000
    short = spark.range(rows // 50).select("id", F.repeat(F.lit("York, "), 50).alias("text"))
    long = spark.range(3).select("id", F.repeat(F.lit("York, "), rows // 3).alias("text"))
    names = listed(spark, ["York ,", "Ann Lee"])
    took = []
    for df in (short, long, short, long):
        start = time.time()
        assert find_phrases(df.repartition(3), "id", names).count() == 0
        took.append(time.time() - start)
    assert took[3] < 3 * took[2] + 3
    plan = module.runs(short, ["id"], ["text"], [1, 2]).columns
    assert plan == ["_k0", "_cell", "column_name", "before", "form", "raw"]  # offsets of runs are left to what matched


def test_only_places_where_a_phrase_can_start_make_runs(spark):
    df = spark.createDataFrame([(1, "New  York and new Yorkshire, ΑΣ.Α, a")], "id long, text string")
    names = module.phrase_list(listed(spark, ["New York", "new york and", "ΑΣ.Α", "ασ.α"]))
    starts = module.heads(names, 2)
    got = module.runs(df, ["id"], ["text"], [2, 3], starts).collect()
    assert sorted((r.before, r.form) for r in got if "y" in r.form) == [(0, "new york"), (0, "new york and")]
    assert len(got) < module.runs(df, ["id"], ["text"], [2, 3]).count()
    assert {r.text for r in find_phrases(df, "id", listed(spark, ["York", "New York", "a"])).collect()} == {"New  York", "a"}
