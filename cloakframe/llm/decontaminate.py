"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

The symbols are words.  A *window* is ``window`` consecutive words of a benchmark item; a shorter
item is one window.  Windows of one length form one pattern set, as the method wants: its shift table
holds, for each block of ``BLOCK`` words that occurs in some pattern, how far the search may move
when that block ends at the current position, and every other block moves it by the whole pattern
less the block.  Where the shift is nought, the bucket of the block's hash lists the patterns that
end so; their hash and then their bytes are compared with the text.

All texts of a block move through the tables together, one position each (long texts in
overlapping stretches), so the search is numpy inside Spark tasks.  Documents are scanned in one
narrow stage without a shuffle.  Pattern sets travel as broadcasts of at most ``block_bytes`` of
benchmark text each: a larger benchmark is dealt into several by a hash of its rows, and every block
is one more step of the same narrow stage, so no result depends on the number of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cloakframe.llm.words import ALPHANUMERIC, Block, block_of, blocks, grams, list_column, mix, texts_of

#: Words that one block of the shift table spans.
BLOCK = 2
#: Positions that one text advances through before the rest becomes a text of its own.
STRETCH = 512
#: Benchmark text in one broadcast, in bytes.
BLOCK_BYTES = 16 << 20

_U = np.uint64


class PatternSet:
    """Patterns of one length in words, with their shift table and suffix buckets."""

    def __init__(self, length: int, patterns: dict[bytes, tuple[np.ndarray, list[int]]]):
        self.length, self.block = length, min(BLOCK, length)
        self.texts, self.items = list(patterns), [sorted(set(x[1])) for x in patterns.values()]
        words = np.array([x[0] for x in patterns.values()], dtype=_U).reshape(-1, length)
        self.widest = length - self.block + 1
        shift: dict[int, int] = {}
        ends = None
        for k in range(self.widest):  # a block that ends k words before the pattern's end allows a move by k
            ends = _blocks(words[:, k : k + self.block])
            for x in ends.tolist():
                shift[x] = min(shift.get(x, self.widest), self.widest - 1 - k)
        self.keys = np.array(sorted(shift), dtype=_U)
        self.shifts = np.array([shift[x] for x in self.keys.tolist()], dtype=np.int64)
        self.suffix, bucket = np.unique(ends, return_inverse=True)
        keys = _keys(bucket, _blocks(words))
        self.order = np.argsort(keys, kind="stable")
        self.tests = keys[self.order]  # each bucket's patterns by their hash

    def search(self, b: Block, words: np.ndarray) -> Iterator[tuple[int, int]]:
        """(first word, pattern) of every occurrence in the block."""
        n = self.length
        if len(words) < n:
            return
        block = grams(words, self.block)
        counts = np.diff(b.first)
        stretches = np.maximum(0, -(-(counts - n + 1) // STRETCH))
        text = np.repeat(np.arange(len(counts)), stretches)
        part = np.arange(len(text)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
        at = b.first[text] + part * STRETCH + n - 1  # the last word of the pattern's first place
        last = np.minimum(b.first[text] + (part + 1) * STRETCH + n - 2, b.first[text + 1] - 1)
        stops = [np.empty(0, np.int64)]
        while len(at):
            here = block[at - self.block + 1]
            k = np.minimum(np.searchsorted(self.keys, here), len(self.keys) - 1)
            move = np.where(self.keys[k] == here, self.shifts[k], self.widest)
            stops.append(at[move == 0])
            at = at + np.maximum(move, 1)
            alive = at <= last
            at, last = at[alive], last[alive]
        yield from self._compared(b, words, block, np.concatenate(stops))

    def _compared(self, b: Block, words: np.ndarray, block: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
        """The patterns that end at ``ends``: by the bucket of the suffix, by hash, then by bytes."""
        bucket = np.searchsorted(self.suffix, block[ends - self.block + 1])
        firsts = ends - self.length + 1
        tests = _keys(bucket, _blocks(words[firsts[:, None] + np.arange(self.length)]))
        lo, hi = np.searchsorted(self.tests, tests, side="left"), np.searchsorted(self.tests, tests, side="right")
        some = np.flatnonzero(lo < hi)
        for first, x, y in zip(firsts[some].tolist(), lo[some].tolist(), hi[some].tolist()):
            text = b" ".join(b.data[s:e].tobytes() for s, e in zip(b.starts[first : first + self.length], b.ends[first : first + self.length]))
            for k in self.order[x:y].tolist():
                if self.texts[k] == text:
                    yield first, k


def _blocks(words: np.ndarray) -> np.ndarray:
    """One hash per row, equal to that of ``grams`` over the same words."""
    out = np.zeros(len(words), dtype=_U)
    for k in range(words.shape[1]):
        out = mix(out * _U(0xD6E8FEB86659FD93) + words[:, k] + _U(k + 1))
    return out


def _keys(bucket: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Bucket number and hash in one number; the bytes are compared later."""
    return (bucket.astype(_U) << _U(32)) | (whole >> _U(32))


def pattern_sets(items: list[tuple[int, bytes]], window: int) -> list[PatternSet]:
    """The windows of all items, one set for each length."""
    found: dict[int, dict[bytes, tuple[np.ndarray, list[int]]]] = {}
    b = block_of([x[1] for x in items], np.arange(len(items)), ALPHANUMERIC, lower=True)
    hashed = b.hashed()
    for k, (item, _) in enumerate(items):
        lo, hi = int(b.first[k]), int(b.first[k + 1])
        length = min(window, hi - lo)
        words = [b.data[s:e].tobytes() for s, e in zip(b.starts[lo:hi], b.ends[lo:hi])]
        for at in range(hi - lo - length + 1 if length else 0):
            text = b" ".join(words[at : at + length])
            found.setdefault(length, {}).setdefault(text, (hashed[lo + at : lo + at + length], []))[1].append(item)
    return [PatternSet(n, x) for n, x in sorted(found.items())]


def _search_stage(sets, columns: list[str], first: bool):
    """Adds the words hit and the items found by one block of the benchmark to each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("_llm_text"))
            n_words = np.zeros(len(texts), dtype=np.int64)
            spans: list[list[tuple[int, int]]] = [[] for _ in texts]
            items: list[set[int]] = [set() for _ in texts]
            for b in blocks(texts, ALPHANUMERIC, lower=True):
                hashed = b.hashed()
                n_words[b.rows] = np.diff(b.first)
                for s in sets.value:
                    for at, pattern in s.search(b, hashed):
                        k = int(np.searchsorted(b.first, at, side="right")) - 1
                        spans[b.rows[k]].append((at - int(b.first[k]), at - int(b.first[k]) + s.length))
                        items[b.rows[k]].update(s.items[pattern])
            if not first:
                for k, (old, known) in enumerate(zip(batch.column("_llm_spans").to_pylist(), batch.column("_llm_items").to_pylist())):
                    spans[k] += zip(old[::2], old[1::2])
                    items[k].update(known)
            flat = [np.array(_joined(x), dtype=np.int32).reshape(-1) for x in spans]
            n_hit = np.array([(x[1::2] - x[::2]).sum() for x in flat], dtype=np.int64)
            held = [sorted(x) for x in items]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(n_words), pa.array(n_hit),
                 list_column(np.concatenate([*flat, np.empty(0, np.int32)]), np.array([len(x) for x in flat], dtype=np.int64), pa.int32()),
                 pa.array(held, pa.list_(pa.int64()))],
                names=[*columns, "_llm_words", "_llm_hit", "_llm_spans", "_llm_items"],
            )

    return run


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one, in order."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _dealt(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[list[tuple[int, bytes]]]:
    """The benchmark's rows in blocks of about ``block_bytes``, each fetched when it is wanted."""
    b = benchmark.where(F.col(text).isNotNull() & F.col(item).isNotNull()).select(F.col(item).cast("long").alias("i"), F.col(text).alias("t")).distinct()
    n = -(-(b.agg(F.sum(F.octet_length("t"))).first()[0] or 0) // block_bytes)
    for k in range(max(n, 1)):
        part = b.where(F.pmod(F.xxhash64("i", "t"), F.lit(max(n, 1))) == k) if n > 1 else b
        yield [(r.i, r.t.encode()) for r in part.collect()]


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = 10, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``items`` (array) and ``contaminated`` added.

    Words are runs of ASCII digits, letters (A to Z lower-cased) and characters beyond ASCII.  A word
    is hit if it stands in any occurrence of a window.  Null and empty texts have no words and no
    hits.  Rows are independent: repeated rows each get their result.  Items that are null, without
    text, words or id are no patterns; an item that repeats counts once.  An empty benchmark hits
    nothing.  Columns of ``docs`` that have the names of the added ones are replaced.
    """
    spark, columns = docs.sparkSession, [c for c in docs.columns if c not in ("n_words", "n_hit", "items", "contaminated")]
    out = docs.select(*(F.col(f"`{c}`") for c in columns), F.col(f"`{text}`").cast("string").alias("_llm_text"))
    carried = [*columns, "_llm_text"]
    types = [*out.schema.fields, T.StructField("_llm_words", T.LongType()), T.StructField("_llm_hit", T.LongType()), T.StructField("_llm_spans", T.ArrayType(T.IntegerType())), T.StructField("_llm_items", T.ArrayType(T.LongType()))]
    for k, items in enumerate(_dealt(benchmark, item, item_text, block_bytes)):
        sets = spark.sparkContext.broadcast(pattern_sets(items, window))
        out = out.mapInArrow(_search_stage(sets, carried, first=k == 0), T.StructType(types))
    return out.select(*(F.col(f"`{c}`") for c in columns), F.col("_llm_words").alias("n_words"), F.col("_llm_hit").alias("n_hit"), F.col("_llm_items").alias("items"), (F.col("_llm_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, with their columns."""
    columns = docs.columns
    clash = [c for c in columns if c in ("n_words", "n_hit", "items", "contaminated")]
    kept = find_contamination(docs.withColumnsRenamed({c: f"_own_{c}" for c in clash}), benchmark, **options).where(~F.col("contaminated"))
    return kept.drop("n_words", "n_hit", "items", "contaminated").withColumnsRenamed({f"_own_{c}": c for c in clash}).select(*(F.col(f"`{c}`") for c in columns))


def items_digest(items):
    """SHA-256 of the item ids, sorted as strings and joined by commas."""
    return F.sha2(F.array_join(F.array_sort(F.transform(items, lambda x: x.cast("string"))), ",").cast("binary"), 256)
