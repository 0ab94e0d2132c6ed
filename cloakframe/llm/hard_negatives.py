"""Hard negatives by segment summaries: bounds of a score before the score.

A vector is cut into segments; each has a mean and a deviation (both times the root of its length here).  Over
one segment, the inner product of two vectors is the product of the means plus at most, or minus at most,
the product of the deviations.  Summed over segments that bounds the score from both sides.  Rows whose
bounds cannot reach a result go; for the others each segment is halved and the bounds are taken anew, and
what is left after the finest segments is scored exactly.  The same search runs twice: for positives
an upper bound must reach the fifth best lower bound; for negatives the bounds must meet the band of scores
that an anchor's positives allow, and the best of what is surely inside it.

Rows travel packed in blocks, each with the finest summaries; coarser ones are sums of these.  Anchors
are dealt to slots and rows to shards, and every slot meets every shard by a join on both numbers, so a
task holds one block of either at a time.  A task returns the best few of its block per anchor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cloakframe.llm.stage import saved

#: Rows in a block, blocks in a shard, anchors in a slot.
ROWS, BLOCKS, ANCHORS = 4096, 4, 1024
#: Segments on each level, from coarse to fine.
SEGMENTS = (1, 2, 4, 8, 16)
POSITIVES = NEGATIVES = 5
#: Whole numbers below this are exact in double precision.
EXACT = 2.0**53
LONG = 2**63 - 1

_PACKED = "ids binary, labels binary, vectors binary, means binary, deviations binary"


def edges_of(width: int, segments: int) -> np.ndarray:
    """Where segments begin, and the width; there are no more segments than components.

    Every edge of a level is one of each finer level too, as both are cut from the same halves.
    """
    finest = SEGMENTS[-1]
    edge = np.arange(finest + 1) * width // finest
    return np.unique(edge[:: finest // segments])


def summaries(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of each finest segment, and sums of squares."""
    width = vectors.shape[1]
    if not width:
        return np.zeros((len(vectors), 0)), np.zeros((len(vectors), 0))
    start = edges_of(width, SEGMENTS[-1])[:-1]
    with np.errstate(over="ignore"):
        return np.add.reduceat(vectors, start, axis=1), np.add.reduceat(vectors**2, start, axis=1)


class Block:
    """Rows with their summaries on every level: mean and deviation, times the root of the length."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, sums: np.ndarray, squares: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        width = vectors.shape[1]
        fine = edges_of(width, SEGMENTS[-1]) if width else np.zeros(1, np.int64)
        with np.errstate(over="ignore", invalid="ignore"):
            for segments in SEGMENTS if width else ():
                edge = edges_of(width, segments)
                if self.levels and len(edge) - 1 == self.levels[-1][0].shape[1]:
                    continue
                start = np.searchsorted(fine, edge[:-1])
                total, square = np.add.reduceat(sums, start, axis=1), np.add.reduceat(squares, start, axis=1)
                mean = total / np.sqrt(np.diff(edge))
                self.levels.append((mean, np.sqrt(np.maximum(square - mean**2, 0))))

    @property
    def widest(self) -> float:
        return float(np.abs(self.vectors).max(initial=0))


def bounds(a: Block, k: int, b: Block, rows: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that row k of ``a`` can have with ``rows`` of ``b``, for one level of segments."""
    with np.errstate(over="ignore", invalid="ignore"):
        middle = b.levels[level][0][rows] @ a.levels[level][0][k]
        about = b.levels[level][1][rows] @ a.levels[level][1][k]
        slack = 0.5 + 1e-9 * (np.abs(middle) + about)  # rounding; scores are whole numbers
        return np.clip(middle - about - slack, -LONG, LONG), np.clip(middle + about + slack, -LONG, LONG)


def scores(a: Block, k: int, b: Block, rows: np.ndarray) -> np.ndarray:
    """Exact inner products; whole numbers beyond double precision are computed as Python's."""
    if len(a.vectors[k]) * a.widest * b.widest < EXACT:
        return (b.vectors[rows] @ a.vectors[k]).astype(np.int64)
    one = [int(x) for x in a.vectors[k]]
    exact = [sum(int(x) * y for x, y in zip(r, one)) for r in b.vectors[rows].tolist()]
    return np.array([max(-LONG, min(LONG, x)) for x in exact], np.int64)


def _best(score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """The n best: higher scores first, then smaller ids."""
    if len(score) > 4 * n:
        least = np.partition(score, len(score) - n)[len(score) - n]
        near = np.flatnonzero(score >= least)
        return near[np.lexsort((ids[near], -score[near]))[:n]]
    return np.lexsort((ids, -score))[:n]


def _nth(values: np.ndarray, n: int) -> float:
    """The nth greatest, or less than anything."""
    if len(values) < n:
        return -np.inf
    return float(np.partition(values, len(values) - n)[len(values) - n])


def positives_of(a: Block, k: int, b: Block, same: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``same`` (of ``b``) that are the n best for row k of ``a``, and their scores."""
    rows = same[b.ids[same] != a.ids[k]]
    for level in range(len(a.levels)):
        if len(rows) <= n:
            break
        low, high = bounds(a, k, b, rows, level)
        least = _nth(np.where(np.isnan(low), -np.inf, low), n)
        rows = rows[~(high < least)]
    score = scores(a, k, b, rows)
    best = _best(score, b.ids[rows], n)
    return rows[best], score[best]


def negatives_of(a: Block, k: int, b: Block, other: np.ndarray, positive: np.ndarray, n: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each positive score: its number, the n best rows of ``other`` in its band, and their scores.

    The band of p is 80 p <= 100 score <= 100 p, which nothing meets if p is below nought.
    """
    wanted = [(j, -(-4 * p // 5), p) for j, p in enumerate(positive.tolist()) if p >= 0]
    if not wanted:
        return []
    least, most = np.array([w[1] for w in wanted], float), np.array([w[2] for w in wanted], float)
    rows = other
    for level in range(len(a.levels)):
        if not len(rows):
            return []
        low, high = bounds(a, k, b, rows, level)
        keep = np.zeros(len(rows), bool)
        for lo, hi in {*zip(least.tolist(), most.tolist())}:
            sure = (low >= lo) & (high <= hi)
            keep |= ~(high < max(lo - 1, _nth(low[sure], n))) & ~(low > hi + 1)
        rows = rows[keep]
    score, out = scores(a, k, b, rows), []
    for j, lo, hi in wanted:
        inside = np.flatnonzero((score >= lo) & (score <= hi))
        best = inside[_best(score[inside], b.ids[rows[inside]], n)]
        if len(best):
            out.append((j, rows[best], score[best]))
    return out


def _pack(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> list[bytes]:
    small = np.abs(vectors).max(initial=0) < 2**31
    return [x.tobytes() for x in (ids, labels, vectors.astype(np.int32) if small else vectors, *summaries(vectors))]


def _unpack(batch: pa.RecordBatch, k: int, prefix: str, width: int) -> Block:
    ids, labels, vectors, sums, squares = (batch.column(prefix + c)[k].as_py() for c in ("ids", "labels", "vectors", "means", "deviations"))
    ids, labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
    kind = np.int32 if len(vectors) == 4 * len(ids) * width else np.float64
    n = len(ids)
    table = np.frombuffer(vectors, kind).astype(np.float64).reshape(n, width)
    segments = len(edges_of(width, SEGMENTS[-1])) - 1 if width else 0
    return Block(ids, labels, table, np.frombuffer(sums).reshape(n, segments), np.frombuffer(squares).reshape(n, segments))


def _whole(vector: list[float], scale: float) -> np.ndarray:
    return np.floor(np.array(vector, np.float64) * scale)


def _row_stage(scale: float, most: int):
    """Blocks of equally long vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, {}

        def block(width: int) -> pa.RecordBatch:
            rows = held.pop(width)
            packed = _pack(np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.float64).reshape(len(rows), width))
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([width], pa.int32()), *(pa.array([x], pa.binary()) for x in packed)], names=["block", "width", "ids", "labels", "vectors", "means", "deviations"])

        for batch in batches:
            for id_, label, vector in zip(*(batch.column(c).to_pylist() for c in ("id", "label", "vector"))):
                rows = held.setdefault(len(vector), [])
                rows.append((id_, label, _whole(vector, scale)))
                if len(rows) == most:
                    yield block(len(vector))
                    number += 1
        for width in sorted(held):
            yield block(width)
            number += 1

    return run


def _anchor_stage(scale: float):
    """All anchors of a slot and length as one block, with the positives they have so far."""

    def run(table: pa.Table) -> pa.Table:
        vectors = [_whole(v, scale) for v in table.column("vector").to_pylist()]
        width = table.column("width")[0].as_py()
        packed = _pack(table.column("id").to_numpy(), table.column("label").to_numpy(), np.array(vectors, np.float64).reshape(len(vectors), width))
        found = table.column("found").to_pylist() if "found" in table.column_names else [[]] * len(vectors)
        flat = [(k, x["id"], x["score"], x["rank"]) for k, f in enumerate(found) for x in f]
        columns = {"slot": table.column("slot")[:1], "width": table.column("width")[:1]}
        columns |= {f"a_{c}": pa.array([x], pa.binary()) for c, x in zip(("ids", "labels", "vectors", "means", "deviations"), packed)}
        return pa.table(columns | {"a_found": pa.array([np.array(flat, np.int64).tobytes()], pa.binary())})

    return run


def _positive_stage(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                width = batch.column("width")[at].as_py()
                a, b = _unpack(batch, at, "a_", width), _unpack(batch, at, "", width)
                out = []
                for label in np.unique(a.labels):
                    same = np.flatnonzero(b.labels == label)
                    for k in np.flatnonzero(a.labels == label).tolist():
                        rows, score = positives_of(a, k, b, same, n)
                        out.append((np.full(len(rows), a.ids[k]), b.ids[rows], score))
                yield _flat(out, ["anchor_id", "id", "score"])

    return run


def _negative_stage(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                width = batch.column("width")[at].as_py()
                a, b = _unpack(batch, at, "a_", width), _unpack(batch, at, "", width)
                found = np.frombuffer(batch.column("a_found")[at].as_py(), np.int64).reshape(-1, 4)
                out = []
                for label in np.unique(a.labels):
                    other = np.flatnonzero(b.labels != label)
                    for k in np.flatnonzero(a.labels == label).tolist():
                        own = found[found[:, 0] == k]
                        for j, rows, score in negatives_of(a, k, b, other, own[:, 2], n):
                            m = len(rows)
                            out.append((np.full(m, a.ids[k]), np.full(m, own[j, 1]), b.ids[rows], np.full(m, own[j, 2]), score, np.full(m, own[j, 3])))
                yield _flat(out, ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score", "positive_rank"])

    return run


def _flat(parts: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0, np.int64)] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def mine(
    rows: DataFrame,
    is_anchor: Callable[[Column], Column],
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: float = 256.0,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    block_rows: int = ROWS,
    anchors_per_slot: int = ANCHORS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank``.

    A component x counts as floor(scale * x); a score is the inner product of these.  Anchors are the rows whose
    key ``is_anchor`` accepts.  An anchor's positives are its best other rows of the same label, its
    negatives for a positive of score p the best rows of other labels with 80 p <= 100 score <= 100 p.  Higher
    scores come first, then smaller keys.

    Rows of null key, label or vector, or with a null or non-finite component, take no part.  Vectors of
    different lengths are not compared; those without components have the score nought.  Rows that
    repeat a key are candidates each (and positives each, of different ``positive_rank``); as an anchor the one of least label and vector counts, and
    *other* rows are those of another key.  Scores beyond a long are given as the nearest long.
    Other columns of ``rows`` are not read.
    """
    given = rows.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    given = given.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & sound)
    blocks = saved(given.mapInArrow(_row_stage(scale, block_rows), f"block long, width int, {_PACKED}"))
    least = F.min(F.struct("label", "vector")).alias("least")
    anchors = saved(given.where(is_anchor(F.col("id"))).groupBy("id").agg(least).select("id", "least.*", F.size("least.vector").alias("width")))
    slots = max(1, -(-anchors.count() // anchors_per_slot))
    shards = max(1, -(-blocks.count() // BLOCKS))
    anchors = anchors.withColumn("slot", F.pmod(F.xxhash64("id"), F.lit(slots)).cast("int"))
    dealt = blocks.withColumn("shard", F.pmod(F.xxhash64("block"), F.lit(shards)).cast("int")).withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))

    def met(own: DataFrame) -> DataFrame:
        kind = "slot int, width int, " + ", ".join(f"a_{c}" for c in _PACKED.split(", ")) + ", a_found binary"
        packed = saved(own.groupBy("slot", "width").applyInArrow(_anchor_stage(scale), kind))
        return packed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).join(dealt, ["slot", "shard", "width"])

    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    near = met(anchors).mapInArrow(_positive_stage(positives), "anchor_id long, id long, score long")
    near = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= positives)
    found = near.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("found"))
    ready = anchors.join(saved(found.withColumnRenamed("anchor_id", "id")), "id")
    hard = met(ready).mapInArrow(_negative_stage(negatives), "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long, positive_rank long")
    order = Window.partitionBy("anchor_id", "positive_rank").orderBy(F.desc("negative_score"), "negative_id")
    ranked = hard.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive_rank")
