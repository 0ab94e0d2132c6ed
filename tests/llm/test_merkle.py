"""The Merkle manifest: against a tree built level by level."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cloakframe.llm import merkle, queries

SF = "/root/testdata/sf0.001"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def tree(nodes, arity):
    """The root, and for each node its siblings level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, place in enumerate(at):
            lo = place // arity * arity
            paths[k].append((nodes[lo:place], nodes[place + 1 : lo + arity]))
            at[k] = place // arity
        nodes = [h(*nodes[lo : lo + arity]) for lo in range(0, len(nodes), arity)]
    return nodes[0], paths


def brute(rows, arity, tampered):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])], arity) for s in order}
    root, upper = tree([trees[s][0] for s in order], arity)
    out = []
    for s, above in zip(order, upper):
        subroot, paths = trees[s]
        for (_, _, own, row), path in zip(sorted(groups[s], key=lambda x: x[:3]), paths):
            at = leaf((*row[:4], "".join(c.lower() if c.isascii() else c for c in row[4]))) if row[4] is not None and tampered(row[0]) else own
            for before, after in [*path, *above]:
                at = h(*before, at, *after)
            proof = h(*(x for step in [*path, *above] for side in step for x in side))
            out.append((row[0], own, subroot, root, proof, at, at == root))
    return sorted(out, key=str)


def in_query(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def shown():
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return {"text": F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, lower).otherwise(F.col("text"))}


def made(seed, n, groups):
    rng = random.Random(seed)
    rows = [(k, rng.choice(["hot", None, *(f"s{j}é" for j in range(groups))]), rng.choice(["en", None]), rng.choice([7, None]), rng.choice([None, "", "Text É A", f"some TEXT {k}"])) for k in range(n)]
    return [*rows, *rows[:5], (None, "hot", None, None, None), (None, "hot", "en", 3, "Null KEY"), (n, "", "en", 1, "Empty Group")]


@pytest.mark.parametrize("n, groups, arity, depth", [(300, 3, 2, 1), (300, 40, 3, 2), (1, 1, 16, 3), (700, 2, 4, 1), (400, 5, 16, 3)])
def test_every_row_has_the_witness_of_the_whole_tree(spark, n, groups, arity, depth):
    rows = made(n + arity, n, groups)
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    got = merkle.manifest(df, presented=shown(), arity=arity, depth=depth)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, arity, in_query)


def test_witnesses_lead_from_the_leaf_to_the_root(spark):
    df = spark.createDataFrame(made(3, 90, 2), "doc_id long, source string, lang string, n_chars long, text string")
    for r in merkle.manifest(df, with_witness=True, arity=3, depth=1).collect():
        steps = list(zip(r.witness[::2], r.witness[1::2]))
        assert merkle.fold(r.leaf, steps) == r.root == r.folded_root and r.verified
        assert merkle.digest("".join(r.witness)) == r.proof_sha256


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 300])
def test_append_closes_what_is_open(n):
    leaves = [h(str(k)) for k in range(n)]
    appender = merkle.Appender(merkle.levels_of(n, 16, 9))
    for x in leaves:
        appender.append(x)
    root, paths = tree(leaves, 16)
    assert appender.finish() == root
    assert appender.witnesses == [[("".join(b), "".join(a)) for b, a in p] for p in paths]


def test_the_query_on_all_rows(spark):
    rows = [tuple(r) for r in queries.table(spark, SF, "documents").select(*FIELDS).collect()]
    assert sorted(map(tuple, queries.op12_merkle_manifest(spark, SF).collect()), key=str) == brute(rows, 16, in_query)


def test_odd_tables(spark, edge, nothing):
    rows = [(r.doc_id, r.lang, r.text) for r in edge.collect()]
    got = merkle.manifest(edge, fields=("doc_id", "lang", "text"), group="lang")
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = brute([(d, g, None, None, t) for d, g, t in rows], 16, lambda _: False)
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted(str(w[0]) for w in want)
    assert got.where("not verified").count() == 0 and got.select("root").distinct().count() == 1
    assert {r.leaf for r in got.collect()} == {leaf(r) for r in rows}
    assert merkle.manifest(nothing, fields=("doc_id", "text"), group="lang").count() == 0
