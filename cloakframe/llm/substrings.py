"""Substring deduplication over windows of words, by super-k-mer partitioning.

A window is ``window`` consecutive words of one document.  Its *minimiser* is the least hash among
its runs of ``MINIMISER`` words; consecutive windows with one minimiser form a super-k-mer, which
travels once, as a packed string, to the bucket of its minimiser.  Equal windows have equal
minimisers, so each bucket alone can sort its windows and find the repeated ones; they are compared
as bytes.  A word that a repeated window covers is removed, unless the window is the earliest.

* A task packs the super-k-mers of a block of text per bucket and holds equal strings once.
* The number of buckets follows the bytes of the input, so a bucket has a few megabytes at any size.
* A minimiser that many super-k-mers share (a passage copied into a third of all documents, say)
  would fill one bucket.  Minimisers are counted first, over all documents; the windows of a frequent
  one travel singly, each to the bucket of the whole window's hash.  The list of frequent
  minimisers is sent to all tasks and holds ``FREQUENT_MOST`` at most: the most frequent ones, so that
  what any other minimiser brings to one bucket is less than that fraction of the input.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cloakframe.llm.stage import compressed, plain
from cloakframe.llm.words import SPACED, Block, block_of, blocks, grams, list_column, mix, powers, texts_of

#: Words of the runs that minimisers are chosen from.
MINIMISER = 3
#: Super-k-mers of one minimiser beyond which its windows travel singly.
FREQUENT = 20_000
FREQUENT_MOST = 1 << 20
#: Bytes of text whose super-k-mers share one bucket, about a third of what the bucket receives.
BUCKET_BYTES = 4 << 20
#: Bytes of text that a task packs together.
PACK_BYTES = 6 << 20

_U = np.uint64
_ROLL = 0xB5297A4D3F84D5B5
_ROLL_INVERSE = pow(_ROLL, -1, 1 << 64)


def _regular(b: Block) -> Block:
    """The block with one byte between words, so that equal words are equal bytes."""
    inside = SPACED[b.data]
    keep = inside.copy()
    keep[b.ends] = True
    data = np.where(inside, b.data, np.uint8(32))[keep]
    size = b.ends - b.starts
    starts = np.cumsum(size + 1) - size - 1
    return Block(b.rows, data, starts, starts + size, b.first)


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """The least of each n neighbours."""
    width = 1
    while 2 * width <= n:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return np.minimum(x[: len(x) - (n - width)], x[n - width :]) if n > width else x


def super_kmers(b: Block, words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of windows and minimiser of each super-k-mer of the block."""
    if len(words) < window:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, _U)
    run = min(MINIMISER, window)
    least = _least(grams(words, run), window - run + 1)
    owner = b.owners()
    valid = owner[: len(least)] == owner[window - 1 :]
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    return np.flatnonzero(new), np.bincount(np.cumsum(new[valid]) - 1, minlength=int(new.sum())), least[new]


def _window_hashes(words: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """A hash of each window that begins at ``at``."""
    total = np.zeros(len(words) + 1, dtype=_U)
    np.cumsum(words * powers(_ROLL, len(words)), out=total[1:])
    return mix((total[at + window] - total[at]) * powers(_ROLL_INVERSE, len(words))[at])


def _count_stage(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(texts_of(batch.column(0)), SPACED, lower=False, most=PACK_BYTES):
                least, n = np.unique(super_kmers(b, b.hashed(), window)[2], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(least.view(np.int64)), pa.array(n)], names=["minimiser", "n"])

    return run


def _pack_stage(window: int, buckets: int, frequent):
    def packed(b: Block, ids: np.ndarray) -> Iterator[tuple[int, bytes]]:
        words = b.hashed()
        first, n, least = super_kmers(b, words, window)
        hot = frequent.value
        if len(hot) and len(first):
            single = hot[np.minimum(np.searchsorted(hot, least), len(hot) - 1)] == least
            spread = np.repeat(first[single], n[single]) + np.arange(n[single].sum()) - np.repeat(np.cumsum(n[single]) - n[single], n[single])
            key = np.concatenate([least[~single], _window_hashes(words, spread, window)])
            first, n = np.concatenate([first[~single], spread]), np.concatenate([n[~single], np.ones(len(spread), np.int64)])
        else:
            key = least
        bucket = (mix(key) % _U(buckets)).astype(np.int64)
        order = np.lexsort((first, bucket))
        bucket, first, n = bucket[order], first[order], n[order]
        text = np.searchsorted(b.first, first, side="right") - 1
        doc, place = ids[text], (first - b.first[text]).astype(np.int32)
        lo, hi = b.starts[first].tolist(), b.ends[first + n + window - 2].tolist()
        data = b.data.tobytes()
        edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-2)).tolist()
        pack = zstandard.ZstdCompressor(level=3)
        for at, stop in zip(edges, edges[1:]):
            strings: dict[bytes, int] = {}
            which = [strings.setdefault(data[x:y], len(strings)) for x, y in zip(lo[at:stop], hi[at:stop])]
            body = doc[at:stop].tobytes() + place[at:stop].tobytes() + np.array(which, np.int32).tobytes() + b"\n".join(strings)
            yield int(bucket[at]), pack.compress(struct.pack("<I", stop - at) + body)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = texts_of(batch.column(1)), batch.column(0).to_numpy()
            order = np.argsort(ids, kind="stable")
            for b in blocks([texts[k] for k in order.tolist()], SPACED, lower=False, most=PACK_BYTES):
                rows = list(packed(_regular(b), ids[order][b.rows]))
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.binary())], names=["bucket", "packed"])

    return run


def _bucket_stage(window: int):
    """Ranges of words that repeated windows cover, from all super-k-mers of one bucket."""

    def run(table: pa.Table) -> pa.Table:
        strings: dict[bytes, int] = {}
        docs, places, which = [], [], []
        for blob in table.column("packed").to_pylist():
            raw = zstandard.ZstdDecompressor().decompress(blob)
            (n,) = struct.unpack_from("<I", raw)
            docs.append(np.frombuffer(raw, np.int64, n, 4))
            places.append(np.frombuffer(raw, np.int32, n, 4 + 8 * n).astype(np.int64))
            local = np.array([strings.setdefault(x, len(strings)) for x in raw[4 + 16 * n :].split(b"\n")], np.int64)
            which.append(local[np.frombuffer(raw, np.int32, n, 4 + 12 * n)])
        doc, place, string = np.concatenate(docs), np.concatenate(places), np.concatenate(which)
        order = np.lexsort((place, doc, string))
        doc, place, string = doc[order], place[order], string[order]
        head = np.flatnonzero(np.diff(string, prepend=-1))  # the earliest place of each string
        texts = list(strings)
        del strings
        order = np.lexsort((place[head], doc[head]))  # strings by that place, so windows are in order as well
        b = block_of([texts[k] for k in order.tolist()], order, SPACED, lower=False)
        count = np.diff(b.first)
        size = np.empty(len(texts), np.int64)
        size[order] = count
        again = (doc > doc[head][string]) | (place > place[head][string])
        found = [(doc[again], place[again], place[again] + size[string[again]])]

        words = b.hashed()
        text = b.owners()
        at = np.flatnonzero(text[: max(0, len(words) - window + 1)] == text[window - 1 :])
        text = text[at]
        own = doc[head][order][text]
        pos = place[head][order][text] + at - b.first[text]
        hashed = _window_hashes(words, at, window)
        by = np.argsort(hashed, kind="stable")
        same = hashed[by][1:] == hashed[by][:-1]
        by = by[np.concatenate([same, [False]]) | np.concatenate([[False], same])] if len(by) else by
        lo, hi = b.starts[at[by]].tolist(), b.ends[at[by] + window - 1].tolist()
        data, seen, later = b.data.tobytes(), {}, []
        for k, x, y in zip(by.tolist(), lo, hi):
            f = seen.setdefault(data[x:y], k)
            if f != k and (own[f], pos[f]) < (own[k], pos[k]):
                later.append(k)
        later = np.array(later, np.int64)
        found.append((own[later], pos[later], pos[later] + window))
        ids, ranges, n = merged(*(np.concatenate(x) for x in zip(*found)))
        return pa.table([pa.array(ids), list_column(ranges, 2 * n, pa.int32())], names=["_llm_key", "_llm_ranges"])

    return run


def merged(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each document, its ranges joined where they meet (lo, hi, lo, hi, ...), and their number."""
    if not len(doc):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.lexsort((lo, doc))
    doc, lo, hi = doc[order], lo[order], hi[order]
    rank = np.cumsum(np.diff(doc, prepend=doc[0]) != 0) << 40
    reach = np.maximum.accumulate(rank + hi)
    new = np.concatenate([[True], rank[1:] + lo[1:] > reach[:-1]])
    end = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(doc) - 1]])
    ids, n = np.unique(doc[new], return_counts=True)
    return ids, np.stack([lo[new], (reach - rank)[end]], axis=1).reshape(-1), n


def _cut_stage(columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, kept = [], [], []
            for text, ranges in zip(plain(batch.column("_llm_text")), batch.column("_llm_ranges").to_pylist()):
                words = text.split()
                drop = np.zeros(len(words), dtype=bool)
                for lo, hi in zip((ranges or [])[::2], (ranges or [])[1::2]):
                    drop[lo:hi] = True
                total.append(len(words))
                gone.append(int(drop.sum()))
                kept.append(b" ".join(w for w, d in zip(words, drop.tolist()) if not d) if gone[-1] else b" ".join(words))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=[*columns, "n_words", "n_removed", "kept_text"])

    return run


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 20, bucket_bytes: int = BUCKET_BYTES, frequent: int = FREQUENT) -> DataFrame:
    """``docs`` without ``text``, with ``n_words``, ``n_removed`` and ``kept_text`` (kept words, one space between).

    A word is removed if it stands in a window of ``window`` words that also starts earlier: in a row
    of smaller ``key``, or further ahead in the same text.  Windows are judged on the input.  Null
    and empty texts have no words.  Rows of null key keep all words and are no one's earlier copy.
    ``key`` names a text: rows that repeat a key count as one text, so equal rows keep their words.
    Columns of ``docs`` that have the names of the added ones are replaced.
    """
    spark, columns = docs.sparkSession, [c for c in docs.columns if c not in ("n_words", "n_removed", "kept_text")]
    own = docs.select(F.col(f"`{key}`").cast("long").alias("_llm_key"), F.col(f"`{text}`").cast("string").alias("_llm_text")).where("_llm_key is not null")
    counts = own.select("_llm_text").mapInArrow(_count_stage(window), "minimiser long, n long").groupBy("minimiser").agg(F.sum("n").alias("n"))
    often = [r.minimiser for r in counts.where(F.col("n") > frequent).orderBy(F.desc("n")).limit(FREQUENT_MOST).collect()]
    hot = spark.sparkContext.broadcast(np.sort(np.array(often, np.int64).view(_U)))
    buckets = max(1, -(-(own.agg(F.sum(F.octet_length("_llm_text"))).first()[0] or 0) // bucket_bytes))
    packed = own.mapInArrow(_pack_stage(window, buckets, hot), "bucket long, packed binary")
    ranges = packed.groupBy("bucket").applyInArrow(_bucket_stage(window), "_llm_key long, _llm_ranges array<int>")
    ranges = ranges.groupBy("_llm_key").agg(F.flatten(F.collect_list("_llm_ranges")).alias("_llm_ranges"))
    # the text itself goes on only in its compressed form
    kept = [c for c in columns if c != text]
    given = docs.select(*(F.col(f"`{c}`") for c in kept))
    whole = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{key}`").cast("long").alias("_llm_key"), F.col(f"`{text}`").cast("string").alias("_llm_text"))
    pressed = compressed(whole, "_llm_text")
    joined = pressed.join(ranges.hint("shuffle_hash"), "_llm_key", "left").select(*(F.col(f"`{c}`") for c in kept), "_llm_text", "_llm_ranges")
    added = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]
    return joined.mapInArrow(_cut_stage(kept), T.StructType([*given.schema.fields, *added]))
