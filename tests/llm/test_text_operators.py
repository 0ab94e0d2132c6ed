"""Words, decontamination, substring and line dedup, near-duplicates: against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from llm_cases import sentences
from pyspark.sql import functions as F

from cloakframe.llm import decontaminate, lines, near_dups, queries, substrings
from cloakframe.llm.components import components
from cloakframe.llm.words import ALPHANUMERIC, SPACED, blocks, grams, hashes

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def ascii_lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def spaced(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.mark.parametrize("word, pattern", [(SPACED, r"[^\x20\x09-\x0D]+"), (ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
def test_words_are_those_of_the_pattern(word, pattern):
    rng = random.Random(3)
    texts = ["".join(chr(rng.choice([9, 10, 13, 32, 45, 65, 97, 48, 95, 127, 160, 233, 0x4E00, 0x1F600])) for _ in range(rng.randrange(30))) for _ in range(200)]
    found = []
    for b in blocks([t.encode() for t in texts], word, lower=True, most=100):
        for lo, hi in zip(b.first, b.first[1:]):
            found.append([b.data[s:e].tobytes().decode() for s, e in zip(b.starts[lo:hi], b.ends[lo:hi])])
    assert found == [re.findall(pattern, ascii_lower(t)) for t in texts]


def test_a_hash_depends_on_the_word_alone():
    data = np.frombuffer(b"abc  xyz " + b"q" * (1 << 21) + b" abc", dtype=np.uint8)
    starts, ends = np.array([0, 5, 9, 10 + (1 << 21)]), np.array([3, 8, 9 + (1 << 21), 13 + (1 << 21)])
    h = hashes(data, starts, ends)
    assert h[0] == h[3] and len(set(h.tolist())) == 3
    assert grams(h, 2)[0] != grams(h, 2)[1] and len(grams(h[:1], 2)) == 0


# --- benchmark decontamination


def brute_hits(docs, bench, window):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t))
    patterns = {}
    for item, text in bench:
        w = split(text)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n and item is not None else 0):
            patterns.setdefault(tuple(w[k : k + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w = split(text)
        hit, items = set(), set()
        for n in {len(p) for p in patterns}:
            for k in range(len(w) - n + 1):
                if found := patterns.get(tuple(w[k : k + n])):
                    items |= found
                    hit.update(range(k, k + n))
        out.append((doc, len(w), len(hit), tuple(sorted(items)), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_decontamination_finds_every_occurrence(spark, block_bytes):
    rng = random.Random(block_bytes)
    word = lambda: rng.choice(["a", "b", "É", "cc", "D4"])
    docs = [(k, rng.choice([" ", "-", "\n"]).join(word() for _ in range(rng.randrange(60)))) for k in range(80)] + [(80, None), (81, "a " * 3000)]
    bench = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([0, 1, 2, 4, 5, 6, 9, 9])] + [(7, "a b cc"), (None, "a"), (9, None)]
    bench = bench[:1] + bench[2:]  # without the item of one word, which would be everywhere
    found = decontaminate.find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"), window=4, block_bytes=block_bytes)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in found.collect()), key=str)
    assert got == brute_hits(docs, bench, 4)


def test_decontamination_query(spark):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, SF, "documents").collect()]
    bench = [(r.item_id, r.text) for r in queries.table(spark, SF, "benchmark").collect()]
    digest = lambda items: hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
    want = sorted((d, n, h, len(i), digest(i), c) for d, n, h, i, c in brute_hits(docs, bench, 10))
    assert rows_of(queries.op8_decontamination(spark, SF)) == want


def test_decontamination_of_odd_tables(spark, edge, nothing):
    bench = spark.createDataFrame([(1, "same row twice word by word")], "item_id long, text string")
    found = decontaminate.find_contamination(edge, bench)
    assert found.count() == edge.count() and [r.n_hit for r in found.where("doc_id = 5").collect()] == [6, 6]
    assert set(edge.columns) == set(found.columns)
    assert decontaminate.find_contamination(edge, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.find_contamination(nothing, bench).count() == 0
    kept = decontaminate.drop_contaminated(edge, bench)
    assert kept.columns == edge.columns and kept.count() == edge.count() - 2 and kept.first().items == edge.first().items


# --- substring dedup


def brute_repeats(docs, window):
    first, out = {}, []
    split = {d: spaced(t) for d, t in docs}
    for d, w in sorted(split.items()):
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), (d, k))
    for d, w in sorted(split.items()):
        gone = {j for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < (d, k) for j in range(k, k + window)}
        out.append((d, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


@pytest.mark.parametrize("window, frequent, bucket_bytes", [(5, 20_000, 1 << 20), (5, 3, 500), (2, 1, 100), (1, 2, 100)])
def test_substrings_are_removed_exactly(spark, window, frequent, bucket_bytes):
    docs = list(enumerate([*sentences(window, 150), "a " * 50, "b a " * 30, "", "a b"]))
    found = substrings.remove_repeats(frame(spark, [t for _, t in docs]), window=window, frequent=frequent, bucket_bytes=bucket_bytes)
    assert rows_of(found.select("doc_id", "n_words", "n_removed", "kept_text")) == brute_repeats(docs, window)


def test_substring_query(spark):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, SF, "documents").collect()]
    want = [(d, n, r, hashlib.sha256(t.encode()).hexdigest()) for d, n, r, t in brute_repeats(docs, 20)]
    assert rows_of(queries.op10_substring_dedup(spark, SF)) == want


def test_substrings_of_odd_tables(spark, edge, nothing):
    found = substrings.remove_repeats(edge)
    assert found.count() == edge.count() and set(edge.columns) - {"text"} <= set(found.columns)
    by = {r.doc_id: r for r in found.where("doc_id is not null").collect()}
    assert by[6].n_removed == 40_000 - 997 - 0 and by[7].n_removed == 40_000 and by[5].n_removed == 0 and by[1].kept_text == ""
    assert all(r.n_removed == 0 for r in found.where("doc_id is null").collect())
    assert substrings.remove_repeats(nothing).count() == 0


# --- line dedup


def brute_chunks(docs):
    one = lambda x: hashes(np.frombuffer(x, np.uint8), np.array([0]), np.array([len(x)]))[0]
    first, out = {}, []
    for d, t in sorted(docs):
        raw, at, chunks, now, before, n = (t or "").encode(), 0, [], [], None, 0
        held = [x for x in raw.split(b"\n")]
        spots = []
        for x in held:
            if x:
                spots.append((at, at + len(x), one(x)))
            at += len(x) + 1
        for k, (lo, hi, h) in enumerate(spots):
            now.append((lo, hi))
            end = before is not None and int(grams(np.array([before, h], np.uint64), 2)[0]) % lines.ENDS == 0
            if (end and len(now) >= lines.LINES) or k + 1 == len(spots):
                if len(now) >= lines.LINES:
                    chunks.append((now[0][0], now[-1][1], len(now)))
                now = []
            before = h
        kept, at = b"", 0
        for lo, hi, size in chunks:
            if first.setdefault(raw[lo:hi], (d, lo)) != (d, lo):
                kept, at, n = kept + raw[at:lo], hi + 1, n + size
        out.append((d, len(spots), n, (kept + raw[at:]).decode()))
    return out


def test_lines_are_removed_exactly(spark):
    rng = random.Random(5)
    pool = [f"line {k}" for k in range(15)] + ["", "é"]
    docs = list(enumerate("\n".join(rng.choice(pool) if rng.random() < 0.3 else f"own {rng.random()}" if rng.random() < 0.2 else pool[k % 15] for k in range(rng.randrange(14))) for _ in range(120)))
    found = lines.remove_repeated_lines(frame(spark, [t for _, t in docs]))
    got = rows_of(found.select("doc_id", "n_lines", "n_removed", "kept_text"))
    assert got == brute_chunks(docs) and sum(r[2] for r in got) > 50


def test_line_query(spark):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, SF, "documents").collect()]
    assert rows_of(queries.op6_line_dedup(spark, SF)) == [(d, n, r, hashlib.sha256(t.encode()).hexdigest()) for d, n, r, t in brute_chunks(docs)]


def test_boundaries_come_back_after_an_insertion(spark):
    body = [f"line number {k}" for k in range(60)]
    found = lines.remove_repeated_lines(frame(spark, ["\n".join(body), "\n".join([*body[:10], "inserted", *body[10:]])]))
    gone = {r.doc_id: r.n_removed for r in found.collect()}
    assert gone[0] == 0 and gone[1] >= 45


def test_other_blank_lines_in_the_first_copy_do_not_keep_the_rest(spark):
    texts = ["first line\n\nsecond line", *["first line\nsecond line"] * 3, "first line\n\nsecond line"]
    got = {r.doc_id: r.n_removed for r in lines.remove_repeated_lines(frame(spark, texts)).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 2, 4: 2}


def test_lines_of_odd_tables(spark, edge, nothing):
    found = lines.remove_repeated_lines(edge)
    assert found.count() == edge.count() and {r.doc_id: r.n_removed for r in found.collect()}[5] == 0
    assert {r.doc_id: r.kept_text for r in found.collect()}[10] == "line one\nline two\n\nline three\n"
    assert lines.remove_repeated_lines(nothing).count() == 0


# --- near-duplicates


def brute_components(docs, shingle):
    sets = {}
    for d, t in docs:
        w = spaced(ascii_lower(t))
        sets[d] = {tuple(w[k : k + shingle]) for k in range(len(w) - shingle + 1)} if len(w) >= shingle else {tuple(w)} if w else set()
    up = {d: d for d in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return [(d, len(sets[d]), top(d), top(d) == d) for d in ids]


@pytest.mark.parametrize("shingle, seed", [(2, 1), (5, 2)])
def test_near_duplicates_are_those_of_all_pairs(spark, shingle, seed):
    texts = [*sentences(seed, 160, words=200), *sentences(seed + 5, 60, words=12), "", "One", "one", "one two", "ONE  two"]
    got = rows_of(near_dups.near_duplicates(frame(spark, texts), shingle=shingle))
    want = brute_components(list(enumerate(texts)), shingle)
    assert got == want and sum(not r[3] for r in got) > 30


def test_one_large_group_of_near_copies(spark):
    rng = random.Random(9)
    base = [f"w{k}" for k in range(120)]
    texts = []
    for _ in range(300):
        t = list(base)
        for _ in range(rng.randrange(1, 9)):
            t[rng.randrange(120)] = f"x{rng.random()}"
        texts.append(" ".join(t))
    assert rows_of(near_dups.near_duplicates(frame(spark, texts))) == brute_components(list(enumerate(texts)), 2)


def test_near_duplicates_of_odd_tables(spark, edge, nothing):
    found = {}
    for r in near_dups.near_duplicates(edge).collect():
        found.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert sorted(found[None]) == [(0, None, True), (9, None, True)]
    assert found[1] == [(0, 1, True)] and found[9] == [(1, 4, False)] and found[7] == [(997, 6, False)]
    assert len(found[5]) == 2 and all(x[1] == 5 and x[2] for x in found[5])
    assert near_dups.near_duplicates(nothing).count() == 0
    kept = near_dups.drop_near_duplicates(edge)
    assert kept.columns == edge.columns and kept.count() == edge.count() - 2


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(1, 60)] + [(100, 200), (300, 300)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**{k: 1 for k in range(1, 61)}, 100: 100, 200: 100}
    assert components(links.where(F.lit(False))).count() == 0
