"""Suffix dedup over bytes: against brute force."""

import hashlib
import random

import numpy as np
import pytest

from cloakframe.llm import queries, suffixes

SF = "/root/testdata/sf0.001"


def brute(docs, window):
    """(key, n_bytes, n_removed, n_spans, kept) of texts by key."""
    first, out = {}, []
    whole = {d: (t or "").encode() for d, t in docs}
    for d, t in sorted(whole.items()):
        for k in range(len(t) - window + 1):
            first.setdefault(t[k : k + window], (d, k))
    for d, t in sorted(whole.items()):
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - window + 1):
            if first[t[k : k + window]] < (d, k):
                gone[k : k + window] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((d, len(t), int(gone.sum()), spans, bytes(np.frombuffer(t, np.uint8)[~gone])))
    return out


def found(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect())


def made(seed, n=120):
    """Texts of few letters, passages copied whole and in part, runs of one byte, periods."""
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(10, 90))) for _ in range(6)]
    texts = []
    for k in range(n):
        parts = []
        for _ in range(rng.randrange(5)):
            p = rng.choice(passages)
            parts.append(rng.choice([p, p[rng.randrange(len(p)) :], "".join(rng.choice("abcdefgh") for _ in range(30)), "x" * rng.randrange(60), "ab" * rng.randrange(30)]))
        texts.append((3 * k, "".join(parts)))
    return [*texts, (1, None), (2, ""), (4, texts[50][1]), (5, "line one, the same everywhere")] + [(1000 + k, f"{k}-{k * 7919}: the very same line in other places :{k * 31}") for k in range(60)]


@pytest.mark.parametrize("window, block, shard, bucket, frequent", [(12, 1 << 20, 1 << 20, 1 << 20, 1000), (12, 300, 500, 400, 1000), (25, 700, 900, 300, 5), (8, 150, 5000, 2000, 0), (40, 2000, 300, 100, 10)])
def test_exactly_the_repeated_windows_go(spark, window, block, shard, bucket, frequent):
    docs = made(window)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = found(suffixes.remove_repeated_bytes(df, window=window, block_bytes=block, shard_bytes=shard, bucket_bytes=bucket, frequent=frequent))
    assert got == brute(docs, window)


def test_a_chunk_edge_changes_nothing(monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choice("ab") for _ in range(4000)).encode()
    t = suffixes.Texts(np.array([1, 2]), np.array([2500, 1500]), text)
    whole = t.stretches(20)
    monkeypatch.setattr(suffixes, "_CHUNK", 64)
    assert all((a == b).all() for a, b in zip(whole, t.stretches(20)))
    assert whole[1].sum() == 2500 - 19 + 1500 - 19


def test_the_radix_sort_groups_equal_windows():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 2, 3000).astype(np.uint8)
    starts = np.arange(len(data) - 13 + 1)
    seen, want = set(), []
    for k in starts.tolist():
        w = data[k : k + 13].tobytes()
        want += [k] if w in seen else []
        seen.add(w)
    assert sorted(suffixes.repeated(data, starts, 13).tolist()) == want


def test_the_query_on_whole_texts(spark):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, SF, "documents").collect()]
    want = [(d, n, g, s, hashlib.sha256(k).hexdigest()) for d, n, g, s, k in brute(docs, 100)]
    assert sorted(map(tuple, queries.op11_suffix_dedup(spark, SF).collect())) == want


def test_a_passage_in_a_third_of_all_texts(spark):
    passage = " ".join(f"word{k}" for k in range(40))
    docs = [(k, f"{k * 7919} before. {passage} after {k * 104729}" if k % 3 == 0 else f"alone {k * 15485863} " * 9) for k in range(900)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = found(suffixes.remove_repeated_bytes(df, block_bytes=5000, frequent=50))
    assert got == brute(docs, 100)


def test_odd_tables(spark, edge, nothing):
    out = suffixes.remove_repeated_bytes(edge)
    assert out.columns == [c for c in edge.columns if c not in ("text", "n_removed", "kept")] + ["n_bytes", "n_removed", "n_spans", "kept"]
    rows = {(r.doc_id, r.n_bytes): r for r in out.collect()}
    assert out.count() == edge.count()
    assert rows[(7, rows[(6, max(n for d, n in rows if d == 6))].n_bytes)].n_removed == rows[(6, max(n for d, n in rows if d == 6))].n_bytes
    assert rows[(11, 100_000)].n_removed == 99_999 and rows[(11, 100_000)].n_spans == 1
    assert rows[(None, 0)].n_removed == 0 and rows[(5, 32)].n_removed == 0
    assert suffixes.remove_repeated_bytes(nothing).count() == 0
    with pytest.raises(ValueError):
        suffixes.remove_repeated_bytes(edge, window=7)
