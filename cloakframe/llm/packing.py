"""Packing documents into sequences of a fixed number of tokens.

Documents become pieces: ids by a public tokenizer and an end id; only longer ones are cut.  Pieces
are dealt by a hash into groups of about ``GROUP`` (one group costs at most a sequence that is not
full), and each group packs its own in one task:

1. Best fit decreasing: each piece, longest first, goes where it leaves the least space.
2. Swap-based local search.  The emptiest sequence gives documents away: a *move*, a *one-for-one*
   or a *two-for-one* exchange with another underfull sequence is made if the squares of both
   fills grow in sum, which makes full sequences fuller and empty ones emptier until they vanish.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloakframe.llm.stage import saved
from cloakframe.llm.tokens import WordTokens
from cloakframe.llm.words import BLOCK_BYTES, texts_of

#: Pieces that one task packs together.
GROUP = 20_000
#: The local search ends after so many sequences in a row that it could not empty.
GIVE_UP = 30


def _piece_stage(path: str, end_id: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = WordTokens.at(path), int(end_id).to_bytes(4, "little")
        for batch in batches:
            texts, ids = texts_of(batch.column(1)), batch.column(0).to_pylist()
            at = 0
            while at < len(texts):
                stop, held = at, 0
                while stop < len(texts) and (stop == at or held + len(texts[stop]) <= BLOCK_BYTES):
                    held += len(texts[stop])
                    stop += 1
                rows = [
                    (doc, k, k * size, len(part) // 4, zlib.crc32(part))
                    for doc, raw in zip(ids[at:stop], tokens.encode(texts[at:stop]))
                    for k, part in enumerate(raw[x : x + 4 * size] for raw in [raw + end] for x in range(0, len(raw), 4 * size))
                ]
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=["doc_id", "piece", "start", "length", "ids_crc32"])
                at = stop

    return run


class Bins:
    """Sequences as lists of piece numbers, with the space that each has left."""

    def __init__(self, lengths: list[int], size: int):
        self.length, self.size = lengths, size
        self.held: list[list[int]] = []
        self.space: list[int] = []

    def best_fit(self) -> None:
        by_space: list[list[int]] = [[] for _ in range(self.size + 1)]
        some = 0  # bit s: a sequence with s left exists
        for k in sorted(range(len(self.length)), key=lambda k: -self.length[k]):
            need = self.length[k]
            fits = some >> need
            if fits:
                left = need + (fits & -fits).bit_length() - 1
                bin_ = by_space[left].pop()
                if not by_space[left]:
                    some ^= 1 << left
                self.held[bin_].append(k)
            else:
                left, bin_ = self.size, len(self.held)
                self.held.append([k])
                self.space.append(0)
            self.space[bin_] = left - need
            if left > need:
                by_space[left - need].append(bin_)
                some |= 1 << (left - need)

    def improve(self, give_up: int = GIVE_UP) -> None:
        """Empties sequences, emptiest first; what it cannot empty it leaves emptier."""
        under = sorted((b for b in range(len(self.held)) if self.space[b]), key=lambda b: -self.space[b])
        failed = 0
        while under and failed < give_up:
            source = under.pop(0)
            if self.size - self.space[source] > sum(self.space[b] for b in under):
                break  # the others have not so much space in all
            while self.held[source] and self._exchange(source, under):
                pass
            failed = failed + 1 if self.held[source] else 0

    def _exchange(self, source: int, under: list[int]) -> bool:
        """The first exchange found that gives tokens of ``source`` to a sequence and raises the squares."""
        mine = self.held[source]
        fill = self.size - self.space[source]
        ones = sorted({self.length[a]: (a,) for a in mine}.items())
        twos = sorted({self.length[a] + self.length[b]: (a, b) for i, a in enumerate(mine) for b in mine[:i]}.items())
        for target in under:
            room = self.space[target]
            if not room:
                continue
            theirs = self.held[target]
            best, what = 0, None
            for given, take in [(0, None)] + [(self.length[b], b) for b in theirs]:
                for size, give in ones if take is None else ones + twos:
                    gain = size - given
                    if best < gain <= room and self.size - room + gain > fill:
                        best, what = gain, (give, take)
            if what:
                give, take = what
                for a in give:
                    mine.remove(a)
                    theirs.append(a)
                if take is not None:
                    theirs.remove(take)
                    mine.append(take)
                self.space[source] += best
                self.space[target] -= best
                return True
        return False


def pack_lengths(lengths: list[int], size: int) -> list[list[int]]:
    """Sequences of piece numbers; every piece is at most ``size`` long."""
    bins = Bins(lengths, size)
    bins.best_fit()
    bins.improve()
    return [x for x in bins.held if x]


def _pack_stage(size: int):
    def run(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_pylist()
        group = table.column("_llm_group")[0].as_py()
        sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        for k, held in enumerate(pack_lengths(lengths, size)):
            at = 0
            for piece in held:
                sequence[piece], offset[piece] = (group << 32) + k, at
                at += lengths[piece]
        return table.drop_columns(["_llm_group"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return run


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", size: int = 2048, end_id: int = 0, group: int = GROUP) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``tokenizer`` is the path of its file on every machine.  ``ids_crc32`` is that of the piece's ids
    as little-endian unsigned 32-bit numbers.  A null or empty text is its end id alone.  Each
    row is packed, repeated ones and those of null key too.  No rows give no rows.
    """
    own = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    pieces = saved(own.mapInArrow(_piece_stage(tokenizer, end_id, size), "doc_id long, piece int, start long, length long, ids_crc32 long"))
    groups = max(1, -(-pieces.count() // group))
    dealt = pieces.withColumn("_llm_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    return dealt.groupBy("_llm_group").applyInArrow(_pack_stage(size), pieces.schema.add("sequence_id", "long").add("offset", "long"))
