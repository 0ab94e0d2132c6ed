"""A Merkle manifest of a table, with a witness for every row, built by streaming aligned append.

Rows are the leaves of one tree per group, in order of their key; the groups' roots are the leaves of one
more tree.  Nodes are appended one by one: an ``Appender`` keeps one open subtree per level, and each
member of an open subtree has a partial witness attached to it.  When a subtree's last sibling arrives, the
witnesses in it grow by that level's siblings and move up, with the new node, into the next open subtree.

* Leaves get their ranks from one sort by range: a row's number in its partition plus what the partitions
  before it hold of its group, a table of one row per partition and group.
* ``ARITY ** DEPTH`` consecutive ranks of a group form a block, which one task appends.  Its root is a
  further append: block roots are ranked by block number and appended in blocks again, until a group has
  one node.  A group of a third of all rows is so many blocks, and no task sees more than one at a time.
* On the way back each block receives the witness of its root, once per block, and completes those of its
  members.  Only there witnesses exist row by row; they never travel.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cloakframe.llm.stage import saved

#: Children of a node, and the levels that one task builds.
ARITY, DEPTH = 16, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_NODES = "_llm_group string, _llm_rank long, _llm_total long, _llm_digest string"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


class Appender:
    """Aligned append of nodes, level by level, with the witnesses of all that was appended.

    ``levels`` is how often runs of ``arity`` nodes become their digest; a last run may be shorter.
    """

    def __init__(self, levels: int, arity: int = ARITY):
        self.arity, self.open, self.root = arity, [([], []) for _ in range(levels)], ""
        self.witnesses: list[list[tuple[str, str]]] = []

    def append(self, node: str) -> None:
        self.witnesses.append([])
        self._enter(0, node, [len(self.witnesses) - 1])

    def _enter(self, level: int, node: str, members: list[int]) -> None:
        if level == len(self.open):
            self.root = node
            return
        nodes, inside = self.open[level]
        nodes.append(node)
        inside.append(members)
        if len(nodes) == self.arity:
            self._close(level)

    def _close(self, level: int) -> None:
        nodes, inside = self.open[level]
        self.open[level] = ([], [])
        whole, width = "".join(nodes), len(nodes[0])
        for k, members in enumerate(inside):
            step = (whole[: k * width], whole[(k + 1) * width :])
            for m in members:
                self.witnesses[m].append(step)
        self._enter(level + 1, digest(whole), [m for members in inside for m in members])

    def finish(self) -> str:
        """The root, once all open subtrees are closed with what they have."""
        for level in range(len(self.open)):
            if self.open[level][0]:
                self._close(level)
        return self.root


def fold(leaf: str, witness: list[tuple[str, str]]) -> str:
    """The root that a leaf and its witness lead to."""
    for before, after in witness:
        leaf = digest(before + leaf + after)
    return leaf


def levels_of(total: int, arity: int, depth: int) -> int:
    """Levels that a block rises: all of ``depth`` if there are other blocks, else until one node is left."""
    if total > arity**depth:
        return depth
    levels = 0
    while total > 1:
        total, levels = -(-total // arity), levels + 1
    return levels


def _appended(table: pa.Table, arity: int, depth: int) -> tuple[np.ndarray, Appender]:
    """The rows of a block by rank, and the appender they went through."""
    order = np.argsort(table.column("_llm_rank").to_numpy())
    nodes = table.column("_llm_digest").to_pylist()
    appender = Appender(levels_of(table.column("_llm_total")[0].as_py(), arity, depth), arity)
    for k in order.tolist():
        appender.append(nodes[k])
    appender.finish()
    return order, appender


def _number_stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows numbered per group, from nought in each partition."""
    part, last, at = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        groups = batch.column("_llm_group").to_pylist()
        number = []
        for g in groups:
            at = at + 1 if g == last else 0
            last = g
            number.append(at)
        columns = [*batch.columns, pa.array([part] * len(groups), pa.int32()), pa.array(number, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_llm_part", "_llm_at"])


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_llm_rank`` by (``_llm_key``, ``_llm_digest``) in ``_llm_group``, and the group's ``_llm_total``."""
    order = ["_llm_group", "_llm_key", "_llm_digest", "_llm_tie"]
    dealt = rows.withColumn("_llm_tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("_llm_tie")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema.fields)
    numbered = saved(dealt.mapInArrow(_number_stage, f"{kinds}, _llm_part int, _llm_at long"))
    runs = numbered.groupBy("_llm_group", "_llm_part").agg(F.count("*").alias("_llm_n"))
    group = Window.partitionBy("_llm_group")
    before = F.coalesce(F.sum("_llm_n").over(group.orderBy("_llm_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("_llm_group", "_llm_part", before.alias("_llm_before"), F.sum("_llm_n").over(group).alias("_llm_total"))
    found = numbered.join(runs, ["_llm_group", "_llm_part"]).withColumn("_llm_rank", F.col("_llm_before") + F.col("_llm_at"))
    return found.drop("_llm_part", "_llm_at", "_llm_before", "_llm_key")


def _in_blocks(nodes: DataFrame, size: int) -> DataFrame:
    return nodes.withColumn("_llm_block", F.floor(F.col("_llm_rank") / size))


class Tree:
    """Trees over ranked rows (``_llm_group, _llm_rank, _llm_total, _llm_digest``), one per group."""

    def __init__(self, rows: DataFrame, arity: int = ARITY, depth: int = DEPTH):
        self.arity, self.depth, self.size = arity, depth, arity**depth
        self.rows = _in_blocks(rows, self.size)
        self.rounds, self.tops = [self.rows], []
        most = rows.agg(F.max("_llm_total")).first()[0] or 0
        while True:
            up = saved(self._roots(self.rounds[-1]))
            self.tops.append(up.where("_llm_total = 1"))
            most = -(-most // self.size)
            if most <= 1:
                break
            self.rounds.append(_in_blocks(up.where("_llm_total > 1"), self.size))

    def _roots(self, nodes: DataFrame) -> DataFrame:
        arity, depth, size = self.arity, self.depth, self.size

        def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            _, appender = _appended(table, arity, depth)
            total = -(-table.column("_llm_total")[0].as_py() // size)
            values = [key[0].as_py(), key[1].as_py(), total, appender.root]
            return pa.table({n: pa.array([v], k) for n, v, k in zip(("_llm_group", "_llm_rank", "_llm_total", "_llm_digest"), values, (pa.string(), pa.int64(), pa.int64(), pa.string()))})

        return nodes.select("_llm_group", "_llm_block", "_llm_rank", "_llm_total", "_llm_digest").groupBy("_llm_group", "_llm_block").applyInArrow(run, _NODES)

    def roots(self) -> DataFrame:
        """``_llm_group, _llm_digest`` of each group's last node."""
        out = self.tops[0]
        for more in self.tops[1:]:
            out = out.unionByName(more)
        return out.select("_llm_group", "_llm_digest")

    def witnessed(self, above: DataFrame | None, columns: str, finish) -> DataFrame:
        """The rows with what ``finish(table, order, witnesses)`` makes of their whole witnesses.

        ``above`` has the witness of each group's root (``_llm_group, _llm_witness``); None: nothing is above.
        A witness is a list of texts in pairs, what stands before and behind on each level.
        """
        carry = self.rows.sparkSession.createDataFrame([], "_llm_group string, _llm_block long, _llm_witness array<string>")
        for k in range(len(self.rounds) - 1, -1, -1):
            if above is not None:
                tops = self.tops[k].join(above, "_llm_group").select("_llm_group", F.lit(0).cast("long").alias("_llm_block"), "_llm_witness")
                carry = carry.unionByName(tops)
            kind, made = (columns, finish) if k == 0 else ("_llm_group string, _llm_block long, _llm_witness array<string>", _upper)
            carry = self._down(self.rounds[k], carry, kind, made)
            if k:
                carry = saved(carry)
        return carry

    def _down(self, nodes: DataFrame, above: DataFrame, kind: str, finish) -> DataFrame:
        arity, depth = self.arity, self.depth

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            rest = right.column("_llm_witness")[0].as_py() if right.num_rows else []
            order, appender = _appended(left, arity, depth)
            rest = list(zip(rest[::2], rest[1::2]))
            return finish(left.take(pa.array(order)), appender.witnesses, rest)

        keys = ["_llm_group", "_llm_block"]
        return nodes.groupBy(*keys).cogroup(above.groupBy(*keys)).applyInArrow(run, kind)


def _upper(table: pa.Table, own: list[list[tuple[str, str]]], rest: list[tuple[str, str]]) -> pa.Table:
    """Members of an upper block with their witnesses: each is the block of that number one round below."""
    flat = [[x for step in [*w, *rest] for x in step] for w in own]
    return pa.table({"_llm_group": table.column("_llm_group"), "_llm_block": table.column("_llm_rank"), "_llm_witness": pa.array(flat, pa.list_(pa.string()))})


def _finished(with_witness: bool):
    def run(table: pa.Table, own: list[list[tuple[str, str]]], rest: list[tuple[str, str]]) -> pa.Table:
        rest_text, after = "".join(b + a for b, a in rest), {}
        proofs, folded = [], []
        for leaf, witness in zip(table.column("_llm_presented").to_pylist(), own):
            proofs.append(digest("".join(b + a for b, a in witness) + rest_text))
            top = fold(leaf, witness)
            if top not in after:  # the same for all members of a block that are as they were
                after[top] = fold(top, rest)
            folded.append(after[top])
        out = {"_llm_id": table.column("_llm_id"), "_llm_group": table.column("_llm_group"), "_llm_digest": table.column("_llm_digest")}
        out |= {"_llm_proof": pa.array(proofs, pa.string()), "_llm_folded": pa.array(folded, pa.string())}
        if with_witness:
            out["_llm_witness"] = pa.array([[x for step in [*w, *rest] for x in step] for w in own], pa.list_(pa.string()))
        return pa.table(out)

    return run


def leaf_of(fields: list[Column]) -> Column:
    """The digest of a row's fields: ``-`` for null, else bytes of its text, a colon, and the text."""

    def framed(c: Column) -> Column:
        text = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*map(framed, fields)), 256)


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    key: str = "doc_id",
    group: str = "source",
    presented: dict[str, Column] | None = None,
    with_witness: bool = False,
    arity: int = ARITY,
    depth: int = DEPTH,
) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``presented`` has fields as someone presents them for a check; ``folded_root`` is what the leaf of these and
    the original siblings lead to, and ``verified`` says whether that is the root.  ``proof_sha256`` is the
    digest of all siblings from the leaf up; ``with_witness`` adds them, as texts in pairs per level.

    Any field, key or group may be null; null keys and the null group come first.  Rows of equal key are
    ordered by their leaf, so equal rows are leaves of their own side by side.  An empty text has
    nought bytes and differs from null.  An empty table has no rows and no root.  No other columns of
    ``docs`` are read, so their names may be anything.
    """

    def column(name: str) -> Column:
        return F.col(f"`{name}`")

    shown = {**{f: column(f) for f in fields}, **(presented or {})}
    marked = F.when(column(group).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), column(group).cast("string")))
    leaves = docs.select(
        marked.alias("_llm_group"),
        column(key).alias("_llm_key"),
        column(key).alias("_llm_id"),
        leaf_of([column(f) for f in fields]).alias("_llm_digest"),
        leaf_of([shown[f] for f in fields]).alias("_llm_presented"),
    )
    per_group = Tree(saved(ranked(leaves)), arity, depth)
    tops = saved(per_group.roots().withColumnRenamed("_llm_digest", "_llm_subroot"))
    whole = Tree(saved(ranked(tops.select(F.lit("").alias("_llm_group"), F.col("_llm_group").alias("_llm_key"), F.col("_llm_group").alias("_llm_id"), F.col("_llm_subroot").alias("_llm_digest")))), arity, depth)

    def for_groups(table: pa.Table, own: list[list[tuple[str, str]]], rest: list[tuple[str, str]]) -> pa.Table:
        flat = [[x for step in [*w, *rest] for x in step] for w in own]
        return pa.table({"_llm_group": table.column("_llm_id"), "_llm_witness": pa.array(flat, pa.list_(pa.string()))})

    above = saved(whole.witnessed(None, "_llm_group string, _llm_witness array<string>", for_groups))
    kind = docs.select(column(key)).schema[0].dataType.simpleString()
    columns = f"_llm_id {kind}, _llm_group string, _llm_digest string, _llm_proof string, _llm_folded string" + ", _llm_witness array<string>" * with_witness
    done = per_group.witnessed(above, columns, _finished(with_witness))
    root = whole.roots().first()  # one digest
    found = done.join(tops, "_llm_group").withColumn("_llm_root", F.lit(root._llm_digest if root else None).cast("string"))
    out = [F.col("_llm_id").alias(key), F.col("_llm_digest").alias("leaf"), F.col("_llm_subroot").alias("subroot"), F.col("_llm_root").alias("root"), F.col("_llm_proof").alias("proof_sha256"), F.col("_llm_folded").alias("folded_root"), (F.col("_llm_folded") == F.col("_llm_root")).alias("verified")]
    return found.select(*out, *([F.col("_llm_witness").alias("witness")] if with_witness else []))
