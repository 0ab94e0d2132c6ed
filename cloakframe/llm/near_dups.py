"""Near-duplicate documents by bottom-k sketches of one hash function.

Texts with equal sets of shingles form a class and go on as one.  The sketch of a set is the ``SKETCH``
least hashes of its shingles.

Candidates come from inverted lists of the retained values.  Two sets with Jaccard similarity of
0.8 or more share at least ``SHARED`` of 64 values (51 are expected; fewer than 34 have a chance
below 1e-6), and smaller sets share a number that is certain.  So it is enough to list a set
under its rarest values, all but ``SHARED - 1`` of them: two sets with that overlap meet in some list.

A list may hold a third of all rows, so its pairs are never all made:
1. Each list has one pivot, its member of least order, and every other member is paired with it.
   Each set is compared exactly with one such pivot: of those that the union sketch estimates to be
   similar, the one of least order, which many sets then have in common.
2. The links so far make components.  In a list that holds several, the sets outside the largest
   component are compared exactly with all sets of other components that may be similar.  Neither
   the pairs nor their estimates become rows: sets that have a partner at all are found by semi-joins,
   dealt into blocks of ``BLOCK`` sets under their list's largest component, and each block gets the sets
   to compare with it.  One link to each component is enough.
A link that is not compared lies inside a component, so components are those of all links.

Pairs are made only if sizes and ``SIGNATURE`` bits of the sketches allow the overlap: 34 common values
light 32 of 256 bits on average, and fewer than ``LIT`` have a chance below 1e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloakframe.llm.components import components
from cloakframe.llm.stage import compressed, plain, saved, small
from cloakframe.llm.words import SPACED, Block, blocks, grams, list_column, mix, texts_of

#: Values in a sketch, and how many of them similar sets share at least (for a similarity of 0.8).
SKETCH, SHARED = 64, 34
#: Share of the union sketch that both sets must hold; 0.8 is expected at least, 0.5 is six deviations less.
ESTIMATE = 0.5
#: An estimate from which two sets are taken as similar until the comparison.
LIKELY = 0.86
#: Bits of a sketch's signature, and how many of them similar sets have in common at least.
SIGNATURE, LIT = 256, 24
#: Sets in a block, and rows of blocks that one task call holds (a whole number of blocks).
BLOCK, CALL = 256, 2048

_U = np.uint64
_BITS = [f"bits{k}" for k in range(SIGNATURE // 64)]


def shingle_sets(b: Block, shingle: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a shorter text is one shingle."""
    words = b.hashed()
    runs = grams(words, shingle).view(np.int64)
    for lo, hi in zip(b.first[:-1].tolist(), b.first[1:].tolist()):
        if hi - lo >= shingle:
            yield np.unique(runs[lo : hi - shingle + 1])
        elif hi > lo:
            yield grams(words[lo:hi], hi - lo).view(np.int64)
        else:
            yield np.empty(0, np.int64)


def _profile_stage(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(texts_of(batch.column(1)), SPACED, lower=True):
                sets = list(shingle_sets(b, shingle))
                sums = np.array([[mix(s.view(_U) + _U(k)).sum(dtype=_U) for s in sets] for k in (1, 2)], dtype=_U).view(np.int64)
                sketches = [s[:SKETCH] for s in sets]
                lit = np.zeros((len(sets), SIGNATURE), dtype=bool)
                lit[np.repeat(np.arange(len(sets)), [len(s) for s in sketches]), np.concatenate(sketches) & (SIGNATURE - 1)] = True
                bits = np.packbits(lit, axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(int(b.rows[0]), len(b.rows)), pa.array([len(s) for s in sets], pa.int64()), pa.array(sums[0]), pa.array(sums[1]),
                     list_column(np.concatenate(sketches), np.array([len(s) for s in sketches]), pa.int64()), *(pa.array(bits[:, k]) for k in range(len(_BITS)))],
                    names=["doc_id", "n", "h1", "h2", "sketch", *_BITS],
                )

    return run


def _compare_stage(shingle: int, percent: int):
    """The pairs whose full sets are similar enough; ``b`` repeats over neighbouring rows."""

    def sets_of(texts: list[bytes]) -> list[np.ndarray]:
        return [s for b in blocks(texts, SPACED, lower=True) for s in shingle_sets(b, shingle)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            other = batch.column("text_b").dictionary_encode()
            known = sets_of(plain(other.dictionary))
            links = []
            for k, (x, y) in enumerate(zip(sets_of(plain(batch.column("text_a"))), other.indices.to_pylist())):
                if y is not None:
                    both = len(np.intersect1d(x, known[y], assume_unique=True))
                    if both and 100 * both >= percent * (len(x) + len(known[y]) - both):
                        links.append(k)
            yield batch.select(["a", "b"]).take(pa.array(links, pa.int64()))

    return run


def _compared(docs: DataFrame, pairs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Those of the saved pairs (a, b) that are links."""
    n = pairs.count()
    targets = pairs.select(F.col("b").alias("doc_id")).distinct()
    left = compressed(docs.join(small(pairs.withColumnRenamed("a", "doc_id"), n), "doc_id").select(F.col("doc_id").alias("a"), "b", F.col("text").alias("text_a")), "text_a")
    right = compressed(docs.join(small(targets, n), "doc_id").select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "text_b")
    return left.join(right.hint("shuffle_merge"), "b").select("a", "b", "text_a", "text_b").mapInArrow(_compare_stage(shingle, percent), "a long, b long")


def _block_stage(shingle: int, percent: int):
    """Links of asking sets to sets of other components in their blocks, as few as connect what the call's links connect."""

    def run(table: pa.Table) -> pa.Table:
        reps, components_, asks = (table.column(c).to_numpy() for c in ("rep", "component", "asks"))
        sets = [x for b in blocks(plain(table.column("text").combine_chunks()), SPACED, lower=True) for x in shingle_sets(b, shingle)]
        size = np.array([len(x) for x in sets])
        _, block = np.unique(np.stack([table.column("main").to_numpy(), table.column("block").to_numpy()]), axis=1, return_inverse=True)
        links = []
        above: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := above.get(x, x)) != x:
                above[x] = above.get(up, up)
                x = up
            return x

        for k in range(block.max() + 1 if len(block) else 0):
            inside = np.flatnonzero((block == k) & ~asks)
            if not len(inside):
                continue
            value = np.concatenate([sets[j] for j in inside])
            owner = np.repeat(np.arange(len(inside)), size[inside])
            order = np.argsort(value, kind="stable")
            value, owner = value[order], owner[order]
            for q in np.flatnonzero((block == k) & asks).tolist():
                lo, hi = np.searchsorted(value, sets[q], side="left"), np.searchsorted(value, sets[q], side="right")
                n = hi - lo
                both = np.bincount(owner[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())], minlength=len(inside))
                near = (both > 0) & (100 * both >= percent * (size[q] + size[inside] - both)) & (components_[inside] != components_[q])
                found = inside[near]
                for j in found[np.unique(components_[found], return_index=True)[1]].tolist():
                    mine, other = root(int(components_[q])), root(int(components_[j]))
                    if mine != other:
                        above[mine] = other
                        links.append((reps[q], reps[j]))
        return pa.table({"a": pa.array([x[0] for x in links], pa.int64()), "b": pa.array([x[1] for x in links], pa.int64())})

    return run


def _across(docs: DataFrame, asking: DataFrame, held: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links between the asking sets and those held under the same list's largest component (main)."""
    count = held.groupBy("main").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    inside = held.join(count, "main").select("rep", "main", F.pmod(F.xxhash64("rep"), "blocks").alias("block"), "component", F.lit(False).alias("asks"))
    outside = asking.join(count, "main").select("rep", "main", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "component", F.lit(True).alias("asks"))
    rows = saved(inside.union(outside))
    n = rows.count()
    texts = compressed(docs.join(small(rows.withColumnRenamed("rep", "doc_id"), n), "doc_id").select(F.col("doc_id").alias("rep"), "main", "block", "component", "asks", "text"), "text")
    calls = max(1, -(-n // CALL))
    dealt = texts.withColumn("call", F.pmod(F.xxhash64("main", "block"), F.lit(calls)))
    return dealt.groupBy("call").applyInArrow(_block_stage(shingle, percent), "a long, b long")


def _may_link(a: str, b: str):
    """Sizes and signatures of rows ``a`` and ``b`` allow a link; small sets may have few values in common."""
    n_a, n_b = F.col(f"{a}.n"), F.col(f"{b}.n")
    common = sum((F.bit_count(F.col(f"{a}.{x}").bitwiseAND(F.col(f"{b}.{x}"))) for x in _BITS[1:]), F.bit_count(F.col(f"{a}.{_BITS[0]}").bitwiseAND(F.col(f"{b}.{_BITS[0]}"))))
    return (10 * F.least(n_a, n_b) >= 8 * F.greatest(n_a, n_b)) & ((F.least(n_a, n_b) < SKETCH) | (common >= LIT))


def _likely(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs (a, b) that pass the union sketch's test, with the estimate."""
    a = sketches.select(F.col("rep").alias("a"), F.col("sketch").alias("s_a"))
    b = sketches.select(F.col("rep").alias("b"), F.col("sketch").alias("s_b"))
    union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, SKETCH)
    both = F.size(F.array_intersect(F.array_intersect("s_a", "s_b"), "union")) / F.size("union")
    return pairs.join(a, "a").join(b, "b").withColumn("union", union).select("a", "b", both.alias("estimate")).where(F.col("estimate") >= ESTIMATE)


def _one_each(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """For each ``a`` the ``b`` of least order among the likely ones, else the most similar."""
    likely = F.col("estimate") >= LIKELY
    return _likely(pairs, sketches).groupBy("a").agg(F.max_by("b", F.struct(likely, F.when(likely, -F.xxhash64("b") / 2).otherwise(F.lit(0.0)), "estimate", "b")).alias("b"))


def _lists(sketches: DataFrame) -> DataFrame:
    """value, rep: each set under the rarest of its retained values, where those occur twice."""
    entries = sketches.select("rep", F.explode("sketch").alias("value"))
    twice = entries.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    held = entries.join(twice, "value").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("values")).join(sketches.select("rep", "n"), "rep")
    kept = F.least(F.col("n"), F.lit(SKETCH))
    sure = F.when(F.col("n") <= SKETCH * 8 // 10, F.ceil(F.col("n") * 8 / 10)).otherwise(F.lit(SHARED))
    rare = (kept - sure + 1) - (kept - F.size("values"))  # values of one set only come first
    rarest = F.slice("values", F.lit(1), F.greatest(rare, F.lit(0)).cast("int"))
    return held.select("rep", F.explode(rarest).alias("v")).select(F.col("v.value").alias("value"), "rep")


def _mixed(lists: DataFrame, joined: DataFrame) -> DataFrame:
    """Entries of the lists that hold several components, with their own and the list's largest."""
    labelled = lists.join(joined.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    labelled = saved(labelled)
    largest = labelled.groupBy("value", "component").count().groupBy("value").agg(F.max_by("component", F.struct("count", "component")).alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    return saved(labelled.join(largest.select("value", "main"), "value"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 2, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Words stand between ASCII white space, A to Z lower-cased; a set holds the runs of ``shingle``
    words, or the whole of a shorter text.  Sets are linked if their intersection has at least
    ``percent`` (80 or more) in a hundred of their union.  ``component_id`` is the least id
    reachable.  Null and empty texts have no shingles, are linked with nothing and kept; so are rows
    of null id, whose component is null.  Ids name texts: rows that repeat an id are one document.
    """
    if percent < 80:
        raise ValueError("the lists are made for a similarity of 0.8 or more")
    own = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    profile = saved(own.mapInArrow(_profile_stage(shingle), "doc_id long, n long, h1 long, h2 long, sketch array<long>, " + ", ".join(f"{x} long" for x in _BITS)))
    classes = saved(profile.where("n > 0 and doc_id is not null").groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("rep")))
    sets = profile.withColumnRenamed("doc_id", "rep").join(classes, ["rep", "n", "h1", "h2"], "left_semi").select("rep", "n", "sketch", *_BITS)
    lists = saved(_lists(sets))
    listed = lists.select("rep").distinct()
    sketches = saved(sets.join(small(listed, listed.count()), "rep", "left_semi"))
    order = F.xxhash64("rep").alias("order")
    lists = saved(lists.join(sketches.select("rep", "n", *_BITS), "rep").select("value", "rep", order, "n", *_BITS))
    member = F.struct("order", "rep", "n", *_BITS)

    pivots = lists.groupBy("value").agg(F.min(member).alias("p"), F.count(F.lit(1)).alias("size")).where("size > 1")
    star = lists.alias("x").join(pivots.select("value", "p.*").alias("y"), "value").where((F.col("x.rep") != F.col("y.rep")) & _may_link("x", "y"))
    links = saved(_compared(own, saved(_one_each(star.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct(), sketches)), shingle, percent))
    mixed = _mixed(lists, components(links))
    outside = mixed.where("component <> main")
    met = (F.col("x.value") == F.col("y.value")) & (F.col("x.component") != F.col("y.component")) & _may_link("x", "y")
    asking = outside.alias("x").join(mixed.alias("y"), met, "left_semi").select("main", "rep", "component").distinct()
    held = mixed.alias("x").join(outside.alias("y"), met, "left_semi").select("main", "rep", "component").distinct()
    final = components(saved(links.union(_across(own, saved(asking), saved(held), shingle, percent))))

    ids = classes.join(final.withColumnRenamed("node", "rep"), "rep", "left").select("n", "h1", "h2", F.coalesce("component", "rep").alias("component"))
    out = profile.select("doc_id", "n", "h1", "h2").join(ids, ["n", "h1", "h2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that are kept: one document of each component, with all columns."""
    gone = near_duplicates(docs, key, text, shingle, percent).where("not kept").select(F.col("doc_id").alias("_llm_gone")).distinct()
    return docs.join(gone, docs[f"`{key}`"].cast("long") == gone["_llm_gone"], "left_anti")
