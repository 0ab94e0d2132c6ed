"""Packing, token counts, personal data, neighbours, quality, toxicity and the pipeline."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

import corpus_pipeline
from cloakframe.llm import neighbours, packing, pieces, private, quality, queries, toxicity
from cloakframe.llm.tokens import WordTokens
from cloakframe.llm.words import hashes

SF = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "İstanbul Straße ΣΑΣ σας ŒUVRE Ça été don't DON'T 's 12.5 a<|endoftext|>b <|STARTOFTEXT|> <|startoftext|> x", "", "…!?. ..,, a.. .b 日本語 ﬁ ½ K Å  nb sp \x1c\x1d á. ª º µ ŉ ǅ ſ",
    "ñÑ Ĳ ĳ ŀ ß ẞ '' 't've'll it's. x', 'll. _.a_,", "́a á é́x", "naïve.naïve, 123.456,7",
]


def documents(spark, sf=SF):
    return [(r.doc_id, r.text) for r in queries.table(spark, sf, "documents").collect()]


# --- packing


def test_word_tokens_are_those_of_whole_texts(spark):
    whole, words = Tokenizer.from_file(WORDS), WordTokens(WORDS)
    for text in [*ODD, *(t for _, t in documents(spark))]:
        assert words.encode([text.encode()])[0] == np.array(whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def placed(rows, size):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for held in by.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_packing_query_is_exact_and_tight(spark):
    tokenizer, want = Tokenizer.from_file(WORDS), []
    for doc, text in documents(spark):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want += [(doc, k, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes())) for k, at in enumerate(range(0, len(ids), 2048))]
    got = queries.op2_best_fit_packing(spark, SF).collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)
    assert placed(got, 2048) <= -(-sum(r.length for r in got) // 2048) + 1


def test_packing_of_odd_tables(spark, edge, nothing):
    got = packing.pack(edge, WORDS, size=64, group=50).collect()
    placed(got, 64)
    assert collections.Counter(r.doc_id for r in got if r.piece == 0) == {None: 2, 5: 2, **{k: 1 for k in (1, 2, 3, 4, 6, 7, 8, 9, 10, 11)}}
    assert {r.length for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert packing.pack(nothing, WORDS).count() == 0


def test_local_search_empties_a_sequence():
    bins = packing.Bins([8, 6, 3, 2, 1], 10)
    bins.held, bins.space = [[0], [1, 3], [2, 4]], [2, 2, 6]  # 8, 6+2, 3+1
    bins.improve()
    held = [x for x in bins.held if x]
    assert len(held) == 2 and sorted(k for x in held for k in x) == list(range(5))


@pytest.mark.parametrize("seed", range(4))
def test_local_search_keeps_all_and_raises_squares(seed):
    rng = random.Random(seed)
    lengths = [rng.randrange(20, 70) for _ in range(300)]
    bins = packing.Bins(lengths, 100)
    bins.best_fit()
    before = (sum(map(bool, bins.held)), sum((100 - s) ** 2 for s in bins.space))
    bins.improve()
    after = (sum(map(bool, bins.held)), sum((100 - s) ** 2 for s in bins.space))
    assert after[0] <= before[0] and after[1] >= before[1]
    assert sorted(k for x in bins.held for k in x) == list(range(300))
    assert all(sum(lengths[k] for k in x) == 100 - s for x, s in zip(bins.held, bins.space))


# --- token counts


def test_counts_are_those_of_the_unigram_tokenizer(spark):
    vocabulary = pieces.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    own = [("▁", -3.0), ("a", -2.0), ("b", -2.0), ("ab", -4.0), ("▁a", -5.0), ("ba", -4.0), ("▁ab", -7.0), ("aa", -3.5)]  # many ties
    rng = random.Random(1)
    made = [" ".join("".join(rng.choice("aab☃b") for _ in range(rng.randrange(1, 9))) for _ in range(6)) for _ in range(200)]
    for vocab, texts in ((vocabulary, [t for _, t in documents(spark)[:60]] + ODD), (own, made)):
        tokenizer = Tokenizer(models.Unigram([("<unk>", 0.0), *vocab], unk_id=0))
        tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
        counter = pieces.PieceCounter(vocab)
        for text in texts:
            for word in text.encode().split():
                assert counter[word] == len(tokenizer.encode(word.decode(), add_special_tokens=False).ids), word


def test_count_query_and_odd_tables(spark, edge, nothing):
    assert queries.op3_token_counts(spark, SF).count() == len(documents(spark))
    path = public_tokenizers.path("piece_bpe_32k.model")
    found = pieces.count_pieces(edge, path)
    assert {r.n_tokens for r in found.where("doc_id in (1, 2, 3)").collect()} == {0} and len(found.columns) == len(edge.columns)
    assert pieces.count_pieces(nothing, path).count() == 0


# --- personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    twice = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in twice) % 10 == 0


def base_spans(text):
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind == "ip" and all(int(x) < 256 for x in m[0].split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if good:
                yield f"{kind}:{m.start()}:{m.end()}"


def base_of(docs):
    out = []
    for d, t in docs:
        held = list(base_spans(t))
        out.append((d, *(sum(x.startswith(k) for x in held) for k in PATTERNS), hashlib.sha256(",".join(held).encode()).hexdigest()))
    return sorted(out)


def test_base_spans_of_the_query(spark):
    got = queries.op4_private_data(spark, SF)
    assert sorted(tuple(r)[:6] for r in got.collect()) == base_of(documents(spark))


def test_base_spans_of_odd_texts(spark):
    rng = random.Random(2)
    texts = ["a@b.c@d.e", "a@b.co_x@y.z", "1.2.3.4.5.6.7.8 9.1.2.3.4", "4111 1111-1111 1111, 5  4111111111111111", "+1 (612) 555-4887. +12 +1()", "é😀 x@y.zz 256.1.1.1 007.1.2.3", "x..y@-a-.b..c", "12-4111111111111111", "@@a@b.c", None, "", "7" * 5000]
    texts += ["".join(rng.choice("0123456789.@+- ()ab😀") for _ in range(200)) for _ in range(100)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(tuple(r)[:6] for r in private.span_digest(private.find_private(df)).collect()) == base_of(list(enumerate(texts)))


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    seeds = [f"Please call me {k} at phone number +4420{7_000_000 + k} today" for k in range(40)]
    texts = [*seeds, "Please call her at phone number 020-7946-0018 today", "order 020-7946-0018 now", "some other words 12345"]
    found = {r.doc_id: r for r in private.find_private(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    at = texts[40].index("020")
    assert [tuple(x) for x in found[40].added] == [(4, at, at + 13)]
    assert not any(found[k].added for k in (*range(40), 41, 42))
    digest = private.span_digest(private.find_private(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).where("doc_id = 40").first()
    assert digest.spans == f"phone:{at}:{at + 13}" and digest.n_phone == 0 and digest.n_added == 1


def test_private_data_of_odd_tables(spark, edge, nothing):
    assert private.find_private(edge).count() == edge.count()
    assert private.find_private(nothing).count() == 0


# --- neighbours


def test_neighbours_are_found(spark):
    rows = queries.table(spark, SF, "embeddings").collect()
    got = collections.defaultdict(list)
    for r in sorted(queries.op7_nearest_neighbours(spark, SF).collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.vec_id, r.score))
    ids, points = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=np.float64)
    for q in np.flatnonzero(ids % 20 == 0):
        score = points @ points[q]
        score[q] = -np.inf
        best = np.lexsort((ids, -score))[:20]
        assert [x for x, _ in got[ids[q]]] == ids[best].tolist() and np.allclose([s for _, s in got[ids[q]]], score[best])


def test_recall_with_many_leaves(spark):
    rng = np.random.default_rng(4)
    points = rng.normal(size=(3000, 16))
    points[500:900] = points[7]  # a group of equal vectors
    df = spark.createDataFrame([(k, p.tolist()) for k, p in enumerate(points)], "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in sorted(neighbours.nearest(df, lambda i: i % 20 == 0, k=20, leaf=64).collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append(r.vec_id)
    recall = []
    for q in range(0, 3000, 20):
        score = points @ points[q]
        score[q] = -np.inf
        score[[k for k in [7, *range(500, 900)] if k != q]] = (points @ points[q])[7]
        best = np.lexsort((np.arange(3000), -score))[:20]
        recall.append(len(set(best) & set(got[q])) / 20)
    assert np.mean(recall) >= 0.9 and len(neighbours.Forest(points, 64).first) > 2
    assert got[520] == [7, *(k for k in range(500, 520) if k != 520)][:20]


def test_neighbours_of_odd_tables(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0]), (8, []), (None, [1.0, 1.0]), (20, [-1.0, 0.5])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, vector string, rank int")
    got = sorted(tuple(r) for r in neighbours.nearest(df, lambda i: i % 20 == 0).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 20, -1.0), (20, 1, 0, -1.0), (20, 2, 1, -1.0)]
    assert neighbours.nearest(df.limit(0), lambda i: i % 20 == 0).count() == 0


# --- quality


def test_decision_is_the_quantile_of_texts_the_model_has_not_seen(spark):
    docs, good = queries.table(spark, SF, "documents"), queries.table(spark, SF, "labels").where("quality = 1").select("doc_id")
    rows = docs.join(good.withColumn("good", F.lit(True)), "doc_id", "left").select("doc_id", "text", F.coalesce("good", F.lit(False)).alias("good"), quality.held_out(F.col("text")).alias("out")).collect()
    seen, out = [r.text for r in rows if r.good and not r.out], [r for r in rows if r.good and r.out]
    assert seen and len(out) < quality.LEAST
    nats = brute_word_nats(seen, [r.text for r in rows])
    limit = max(n for n, r in zip(nats, rows) if r.good and r.out)
    got = {r.doc_id: r for r in queries.op1_quality(spark, SF).collect()}
    assert len(got) == len(rows) and 0 < sum(not r.kept for r in got.values())
    for n, r in zip(nats, rows):
        assert np.isclose(np.log(got[r.doc_id].perplexity), n) and np.isclose(np.log(got[r.doc_id].limit), limit)
        assert got[r.doc_id].kept == (got[r.doc_id].perplexity <= got[r.doc_id].limit)


def test_limits_by_language(spark):
    scores = spark.createDataFrame([(lang, float(k)) for lang, n in (("en", 1000), ("de", 600), ("fr", 499), (None, 3)) for k in range(n)] + [("en", None)], "lang string, nats double")
    got = {r.lang: r.limit for r in quality.thresholds(scores).collect()}
    assert set(got) == {"en", "de", None} and abs(got["en"] - 997) <= 1 and abs(got["de"] - 598) <= 1 and abs(got[None] - 995) <= 2


def test_quality_tells_held_out_texts_apart(spark):
    sf = "/root/testdata/sf0.1"
    labels = queries.table(spark, sf, "labels")
    rated = quality.rate(queries.table(spark, sf, "documents"), labels.where("doc_id % 2 = 0"))
    held = rated.join(labels.where("doc_id % 2 = 1"), "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r.quality: r.kept for r in held}
    assert kept[1] >= 0.995 and kept[0] <= 0.3


def test_quality_of_odd_tables(spark, edge, nothing):
    labels = spark.createDataFrame([(5, 1), (5, 1), (10, 1), (None, 1), (6, 0), (7, None)], "doc_id long, quality int")
    rated = quality.rate(edge, labels)
    assert rated.count() == edge.count() and set(rated.columns) == set(edge.columns)
    assert [(r.perplexity, r.kept) for r in rated.where("doc_id = 1").collect()] == [(None, True)]
    assert quality.rate(nothing, labels).count() == 0
    assert quality.rate(edge, labels.limit(0)).where("kept").count() == edge.count()


def brute_word_nats(trusted, texts):
    """Interpolated Kneser-Ney of order 3."""
    pad = lambda t: ["<s>", "<s>", *t.encode().lower().split(), "</s>"]
    held = [pad(t) for t in trusted]
    counts = {3: collections.Counter(tuple(v[k : k + 3]) for v in held for k in range(len(v) - 2))}
    for n in (2, 1):
        counts[n] = collections.Counter(g[1:] for g in counts[n + 1])
    taken = {n: quality.discounts(*(sum(v == k for v in c.values()) for k in (1, 2, 3, 4))) for n, c in counts.items()}
    totals = {n: collections.defaultdict(lambda: [0, 0.0]) for n in counts}
    for n, c in counts.items():
        for g, v in c.items():
            totals[n][g[:-1]][0] += v
            totals[n][g[:-1]][1] += taken[n][min(v, 3) - 1]

    def p(g):
        if not g:
            return 1 / (len(counts[1]) + 1)
        if g[:-1] not in totals[len(g)]:
            return p(g[1:])
        total, mass = totals[len(g)][g[:-1]]
        v = counts[len(g)].get(g, 0)
        return (v - taken[len(g)][min(v, 3) - 1] if v else 0) / total + mass / total * p(g[1:])

    return [-np.mean([np.log(p(tuple(v[k : k + 3]))) for k in range(len(v) - 2)]) for v in map(pad, texts)]


def test_word_perplexity_is_kneser_neys(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefghijkl") + rng.choice("xyz") for _ in range(rng.randrange(1, 12))) for _ in range(80)]
    texts += [texts[3], "never seen words", "ax"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.id: r.nats for r in quality.word_nats(docs, quality.word_model.train(docs.where("doc_id < 40"))).collect()}
    for r, n in zip(docs.select("doc_id", "text", F.xxhash64("text").alias("id")).orderBy("doc_id").collect(), brute_word_nats(texts[:40], texts)):
        assert np.isclose(got[r.id], n), r


def test_ordinary_words_in_bad_order_are_rejected(spark):
    rng = random.Random(4)
    after = {k: [(k + rng.randrange(1, 60)) % 60 for _ in range(3)] for k in range(60)}
    words = ["".join(rng.choice("etaoinsh") for _ in range(5)) for _ in range(60)]

    def good():
        at, out = rng.randrange(60), []
        for _ in range(60):
            out.append(words[at])
            at = rng.choice(after[at])
        return " ".join(out)

    texts = [good() for _ in range(500)]
    shuffled = [" ".join(rng.sample(t.split(), 60)) for t in texts[300:340]]
    repeated = [" ".join([w] * 60) for w in words[:20]]
    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate([*texts, *shuffled, *repeated])], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, 1) for k in range(300)], "doc_id long, quality int")
    kept = {r.doc_id for r in quality.rate(docs, labels).where("kept").collect()}
    assert len(kept & set(range(300, 500))) >= 190 and not kept & set(range(500, 560))


# --- toxicity


def test_toxicity_of_held_out_texts(spark):
    sf, names = "/root/testdata/sf0.1", ["junk", "toxic"]
    docs, labels = queries.table(spark, sf, "documents").select("doc_id", "text"), queries.table(spark, sf, "labels").select("doc_id", (1 - F.col("quality")).alias("junk"), "toxic")
    chain = toxicity.train(docs, labels.where("doc_id % 2 = 0"), names)
    held = toxicity.rate(docs, chain, names).drop("junk").withColumnRenamed("toxic", "said").join(labels.where("doc_id % 2 = 1"), "doc_id")
    counts = {(r.toxic, r.said): r["count"] for r in held.groupBy("toxic", "said").count().collect()}
    assert counts.get((0, True), 0) <= 0.01 * counts[0, False] and counts[1, True] >= 0.9 * (counts[1, True] + counts.get((1, False), 0))


def test_later_categories_use_earlier_ones():
    rng = np.random.default_rng(0)
    first = rng.random(600) < 0.5
    second = first & (rng.random(600) < 0.9)
    words = [np.unique(np.array([10 + int(rng.random() < 0.5), 1 if f else 2], dtype=np.uint64)) for f in first]
    chain = toxicity.fit_chain(np.arange(600), words, np.stack([first, second], axis=1).astype(int))
    assert len(chain) == 2 and len(chain[1][1]) == len(chain[1][0]) + 2 and chain[1][1][-2] > 0
    flat, owner = np.concatenate(words), np.repeat(np.arange(600), [len(w) for w in words])
    assert ((toxicity.predict_chain(chain, flat, owner, 600)[:, 0] > 0.5) == first).all()


def test_words_and_limits_come_from_all_labelled_texts(spark):
    texts = [(k, f"plain words here {'vile' + str(k // 2 % 20) if k % 2 else 'mild' + str(k // 2 % 20)}") for k in range(800)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(800)], "doc_id long, toxic int")
    ((chosen, _, limit),) = toxicity.train(docs, labels, ["toxic"], sample=30)
    told = [f"{kind}{k}".encode() for kind in ("vile", "mild") for k in range(20)]
    assert {int(hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0]) for w in told} <= set(chosen.tolist())
    assert 0 < limit < 1
    assert np.isclose(toxicity.limit_of(np.array([400, 0, -400]), np.array([5, 4, 90]), np.array([5, 1, 0])), (toxicity._sigmoid(2.0) + toxicity._sigmoid(0.005)) / 2)


def test_toxicity_of_odd_tables(spark, edge, nothing):
    labels = spark.createDataFrame([(5, 1), (5, 1), (10, 0), (None, 1), (6, 0), (7, None), (99, 1)], "doc_id long, toxic int")
    chain = toxicity.train(edge, labels, ["toxic"])
    rated = toxicity.rate(edge, chain, ["toxic"])
    assert rated.count() == edge.count() and set(rated.columns) == set(edge.columns) and rated.where("p_toxic is null").count() == 0
    assert toxicity.rate(nothing, chain, ["toxic"]).count() == 0
    assert toxicity.train(edge, labels.limit(0), ["toxic"]) == []
    assert toxicity.rate(edge, [], ["toxic"]).where("toxic or p_toxic is not null").count() == 0


# --- pipeline


def test_pipeline_stages_take_effect(spark):
    docs = queries.table(spark, SF, "documents")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.saved(stage(spark, before, SF))
        assert after.columns == columns and after.select("doc_id").exceptAll(before.select("doc_id")).count() == 0, name
        if name != "line_dedup":
            assert after.exceptAll(before).count() == 0
        before = after
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in before.select("doc_id").collect()}
    placed(packed, 2048)
    rated = {r.doc_id: r.kept for r in queries.op1_quality(spark, SF).collect()}
    assert all(rated[r.doc_id] for r in packed)
    assert queries.decontaminate.find_contamination(before, queries.table(spark, SF, "benchmark")).where("contaminated").count() == 0


def test_pipeline_stages_of_no_rows(spark):
    docs = queries.table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
