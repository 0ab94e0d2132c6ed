"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

Equal vectors become one class, which keeps as many of its least ids as a result can name, so a
vector that a third of all rows share is indexed and compared once.  Every vector gets one more
component that makes all lengths equal; the order of inner products is then that of angles.

Trees are fitted on ``SAMPLE`` classes at most (those of least hash), each node splitting its part of
the sample at the median of a random projection; every class is then sent down every tree.  A query
walks all trees through one shared priority queue: the part whose splits it passed with the
widest least margin comes first, until it has reached its share of all leaves.  Queries and classes
meet in their leaves by a shuffle, and all classes of a leaf are compared exactly.

``SHARE`` is set for vectors without any structure, where neighbours are hardly nearer than the rest: there
0.9 of the true neighbours needs most of the index.  Clustered vectors do with a small part of it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cloakframe.llm.stage import saved
from cloakframe.llm.words import list_column

#: Classes that the trees are fitted on, at most.
SAMPLE = 20_000
TREES = 8
#: Classes that a leaf should hold, if the sample has at least LEAST of them.
LEAF, LEAST = 512, 8
#: Share of all trees' leaves that a query visits.
SHARE = 0.18
#: Queries that are compared with a leaf at once, and found rows that one merging group holds.
QUERIES, MERGED = 256, 1 << 20


class Tree:
    """Splits in order of making; children of split k are nodes, leaves are numbers below nought."""

    def __init__(self, points: np.ndarray, leaf: int, seed: int):
        rng = np.random.default_rng(seed)
        self.normals: list[np.ndarray] = []
        self.offsets: list[float] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        self.root = self._part(points, leaf, rng)
        self.normal = np.array(self.normals).reshape(-1, points.shape[1])

    def _part(self, points: np.ndarray, leaf: int, rng) -> int:
        if len(points) > leaf:
            normal = rng.normal(size=points.shape[1])
            normal /= np.linalg.norm(normal)
            at = points @ normal
            offset = float(np.median(at))
            right = at > offset
            if 0 < right.sum() < len(points):
                me = len(self.normals)
                self.normals.append(normal)
                self.offsets.append(offset)
                self.children.append([])
                self.children[me] = [self._part(points[~right], leaf, rng), self._part(points[right], leaf, rng)]
                return me
        self.leaves += 1
        return -self.leaves

    def place(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point."""
        node = np.full(len(points), self.root)
        margins = points @ self.normal.T - np.array(self.offsets) if len(self.normals) else None
        children = np.array(self.children).reshape(-1, 2)
        while (inner := np.flatnonzero(node >= 0)).size:
            at = node[inner]
            node[inner] = children[at, (margins[inner, at] > 0).astype(int)]
        return -node - 1


class Forest:
    def __init__(self, points: np.ndarray, leaf: int, trees: int = TREES):
        self.trees = [Tree(points, leaf, seed) for seed in range(trees)]
        self.first = np.cumsum([0, *(t.leaves for t in self.trees)])

    def place(self, points: np.ndarray) -> np.ndarray:
        """Leaf numbers, a column for each tree."""
        return np.stack([t.place(points) + f for t, f in zip(self.trees, self.first)], axis=1)

    def visit(self, point: np.ndarray, leaves: int) -> list[int]:
        """The leaves that a query reaches first."""
        margins = [(t.normal @ point - np.array(t.offsets)).tolist() for t in self.trees]
        queue = [(-np.inf, k, t.root) for k, t in enumerate(self.trees)]
        heapq.heapify(queue)
        found: list[int] = []
        while queue and len(found) < leaves:
            least, k, node = heapq.heappop(queue)
            if node < 0:
                found.append(int(self.first[k]) - node - 1)
            else:
                m = margins[k][node]
                for child, sign in zip(self.trees[k].children[node], (1.0, -1.0)):
                    heapq.heappush(queue, (max(least, sign * m), k, child))
        return found


def visits(forest: Forest, share: float) -> int:
    """Leaves that each query visits."""
    return max(1, int(np.ceil(share * forest.first[-1])))


def _matrix(column: pa.Array) -> np.ndarray:
    """Equally long lists as rows, in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def _longer(points: np.ndarray, longest: float) -> np.ndarray:
    """Points with the component that brings them to the length of the longest; ``longest`` nought: queries."""
    more = np.sqrt(np.maximum(longest**2 - (points**2).sum(axis=1), 0)) if longest else np.zeros(len(points))
    return np.column_stack([points, more])


def _place_stage(forest, longest: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = forest.value.place(_longer(_matrix(batch.column("vector")), longest))
                again = pa.array(np.repeat(np.arange(batch.num_rows), leaf.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(leaf.reshape(-1), pa.int64()), batch.column("ids").take(again), batch.column("vector").take(again)], names=["leaf", "ids", "vector"])

    return run


def _visit_stage(forest, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaves = visits(forest.value, share)
        for whole in batches:
            for at in range(0, whole.num_rows, QUERIES):
                batch = whole.slice(at, QUERIES)
                found = [forest.value.visit(point, leaves) for point in _longer(_matrix(batch.column("vector")), 0.0)]
                same = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found), pa.int64()), batch.column("id").take(same), batch.column("vector").take(same)], names=["leaf", "id", "vector"])

    return run


def _best(queries: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best rows of each query, in order of query and rank, and their ranks from nought."""
    order = np.lexsort((ids, -scores, queries))
    queries = queries[order]
    rank = np.arange(len(queries)) - np.searchsorted(queries, queries)
    kept = rank < k
    return queries[kept], ids[order][kept], scores[order][kept], rank[kept]


def _leaf_stage(k: int):
    """Each query's nearest in one leaf."""

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        if queries.num_rows and rows.num_rows:
            held = rows.column("ids").combine_chunks()
            counts = np.asarray(held.value_lengths())
            ids = np.asarray(held.flatten())
            points = _matrix(rows.column("vector"))
            wanted = queries.column("id").to_numpy()
            vectors = _matrix(queries.column("vector"))
            for at in range(0, len(wanted), QUERIES):
                scores = vectors[at : at + QUERIES] @ points.T
                if scores.shape[1] > k + 1:  # the query's own class and k others, with all ties of the last
                    query, near = np.nonzero(scores >= np.partition(scores, -k - 1, axis=1)[:, -k - 1, None])
                else:
                    query, near = (x.ravel() for x in np.indices(scores.shape))
                own, n = wanted[at + query], counts[near]
                others, values, asked = ids_of(near, counts, ids), np.repeat(scores[query, near], n), np.repeat(own, n)
                other = others != asked
                found.append(_best(asked[other], others[other], values[other], k)[:3])
        asked, others, values = (np.concatenate(x) for x in zip(*found))
        start = np.flatnonzero(np.append(True, asked[1:] != asked[:-1])) if len(asked) else asked
        size = np.diff(np.append(start, len(asked)))
        return pa.table([pa.array(asked[start]), list_column(others, size, pa.int64()), list_column(values, size, pa.float64())], names=["id", "ids", "scores"])

    return run


def ids_of(which: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The ids of some classes, from all ids in order."""
    first = np.cumsum(counts) - counts
    n = counts[which]
    return ids[np.repeat(first[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def _merge_stage(k: int):
    """The nearest of some queries over all their leaves; a vector that several trees found counts once."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        lists = table.column("ids").combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.int64()))
        query = np.repeat(table.column("id").to_numpy(), np.asarray(lists.value_lengths()))
        ids, scores = np.asarray(lists.flatten()), np.asarray(table.column("scores").combine_chunks().flatten())
        order = np.lexsort((-scores, ids, query))
        query, ids, scores = query[order], ids[order], scores[order]
        new = np.ones(len(query), dtype=bool)
        new[1:] = (query[1:] != query[:-1]) | (ids[1:] != ids[:-1])
        query, ids, scores, rank = _best(query[new], ids[new], scores[new], k)
        return pa.table({"query_id": pa.array(query, pa.int64()), "rank": pa.array(rank + 1, pa.int32()), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(scores, pa.float64())})

    return run


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """id, vector: rows that take part, each once; vectors of floats stay so, all others are of doubles.

    Left out are null ids, null, empty and zero vectors, those with null or non-finite components,
    and those not of the most frequent length (the longer one, if two are).
    """
    kind = vectors.select(F.col(f"`{vector}`").alias("v")).schema["v"].dataType
    kind = "array<float>" if kind.typeName() == "array" and kind.elementType.typeName() == "float" else "array<double>"
    v = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast(kind).alias("vector")).where("id is not null and vector is not null")
    finite = v.where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0))
    size = finite.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return finite.where(F.size("vector") == (size[0].size if size else 0)).distinct()


def nearest(vectors: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = 20, trees: int = TREES, leaf: int = LEAF, share: float = SHARE, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest found for each row where ``is_query`` of its ``id``.

    Nearness is the largest inner product in double precision; ties go to the smaller id.  A row is no
    neighbour of itself, equal vectors of other rows are.  Which rows take part: see ``usable``.  Rows
    that repeat id and vector count once.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = saved(usable(vectors, key, vector))
    order = Window.partitionBy("vector").orderBy("id")
    least = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    classes = saved(least.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    count, longest = classes.agg(F.count(F.lit(1)), F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)))).first()
    chosen = classes.select("vector").orderBy(F.xxhash64("vector")).limit(sample).collect()
    points = np.array([r.vector for r in chosen], dtype=np.float64).reshape(len(chosen), len(chosen[0].vector) if chosen else 1)
    held = max(LEAST, leaf * len(points) // max(count, 1))
    made = Forest(_longer(points, longest or 0.0), held, trees)
    forest = spark.sparkContext.broadcast(made)
    kind = rows.schema["vector"].dataType.simpleString()
    index = classes.mapInArrow(_place_stage(forest, longest or 0.0), f"leaf long, ids array<long>, vector {kind}")
    asking = saved(rows.where(is_query(F.col("id"))))
    queries = asking.mapInArrow(_visit_stage(forest, share), f"leaf long, id long, vector {kind}")
    found = queries.groupBy("leaf").cogroup(index.groupBy("leaf")).applyInArrow(_leaf_stage(k), "id long, ids array<long>, scores array<double>")
    groups = max(1, -(-asking.count() * visits(made, share) * k // MERGED))
    dealt = found.withColumn("group", F.pmod(F.xxhash64("id"), F.lit(groups)))
    return dealt.groupBy("group").applyInArrow(_merge_stage(k), "query_id long, rank int, vec_id long, score double")
