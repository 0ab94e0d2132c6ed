"""Byte-exact removal of repeated passages: suffixes sorted by radix, as deep as the threshold and no deeper.

A window is ``window`` consecutive bytes of one text, that is a suffix of it cut at the threshold.  Suffixes
of a bucket are sorted by most-significant-digit passes over digits of eight bytes: each pass splits the
groups of the last by the next digit and lets go what stands alone, and after the last digit the
groups left are exactly the repeated windows.  A byte that one of them covers is removed, unless the
window is the earliest of its group.  Only bytes decide; hashes just deal work out and rule it out.

* Texts are first packed into blocks, a saved table.  Neighbouring suffixes stay together: those whose
  least run of bytes (by hash, the leftmost of equals) is the same one travel as one *stretch*.
* **Asking.**  Each block asks, per hash of such a run, whether any other stretch has it; a packed list per
  block and shard goes out, two bits per hash come back.  Text without repeats ends here.
* **Sorting.**  The other stretches go to the bucket of that hash, one of several equal ones of a block;
  the rest of those are later copies and settled at once.  A bucket holds equal stretches once and
  sorts the suffixes of all.  Equal windows have equal least runs, so each bucket stands alone.
* **Hot runs** (a line in a third of all texts, in ever other surroundings) have more than ``FREQUENT``
  stretches; their windows travel singly, each to the bucket of its own bytes' hash.  What one hot window or
  one hot hash brings to a task is one entry per block that holds it, not one per occurrence.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cloakframe.llm.stage import compressed, plain, saved
from cloakframe.llm.substrings import merged
from cloakframe.llm.words import hashes, list_column, mix, texts_of

#: Bytes of text in a block, whose stretches are packed together.
BLOCK_BYTES = 8 << 20
#: Bytes of text whose hashes share a shard, and whose stretches share a bucket.
SHARD_BYTES, BUCKET_BYTES = 32 << 20, 8 << 20
#: Compressed bytes of texts that a task cuts at once.
CUT_BYTES = 1 << 20
#: Stretches of one hash beyond which their windows travel singly.
FREQUENT = 20_000
#: Bits of the hash that blocks ask by.
ASKED_BITS = 48
#: Windows that are packed at once where they travel singly.
SINGLE_WINDOWS = 100_000
ALONE, SHARED, HOT = 0, 1, 2
STRETCHES, RANGES = 0, 1

_U = np.uint64
#: Positions whose hashes are computed at once, and the bits that number them.
_CHUNK, _PLACE_BITS = 1 << 19, 20
_PLACE = _U((1 << _PLACE_BITS) - 1)
_BYTE = np.random.default_rng(0x50F1).integers(1, 1 << 63, 256, dtype=_U) * _U(2) + _U(1)
_STEP = _U(0x9E6C63D0876A9F4B)


def run_length(window: int) -> int:
    """Bytes of the runs whose least decides: the power of two up to a third of the window, 4 at least."""
    return 1 << max(2, (window // 3).bit_length() - 1)


def _run_hashes(data: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n bytes, n a power of two."""
    h, width = _BYTE[data], 1
    while width < n:
        h = mix(h[:-width] * _STEP + h[width:]) if 2 * width == n else h[:-width] * _STEP + h[width:]
        width *= 2
    return h


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """The least of each n neighbours."""
    width = 1
    while 2 * width <= n:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return np.minimum(x[: len(x) - (n - width)], x[n - width :]) if n > width else x


class Texts:
    """Texts of a block, one after another."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, data: bytes):
        self.ids, self.bytes, self.data = ids, data, np.frombuffer(data, np.uint8)
        self.first = np.concatenate([[0], np.cumsum(sizes)])

    def at(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Document and place in it."""
        text = np.searchsorted(self.first, place, side="right") - 1
        return self.ids[text], place - self.first[text]

    def stretches(self, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First byte, number of windows and hash of the least run of each stretch."""
        n, run = len(self.data), run_length(window)
        span = window - run + 1
        none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, _U)
        if n < window:
            return none
        inside = np.zeros(n - window + 1, bool)
        for a, b in zip(self.first.tolist(), self.first[1:].tolist()):
            inside[a : max(a, b - window + 1)] = True
        firsts, least, last = [], [], -1
        for at in range(0, len(inside), _CHUNK):
            stop = min(at + _CHUNK, len(inside))
            runs = _run_hashes(self.data[at : stop + window - 1], run)
            low = _least(runs & ~_PLACE | np.arange(len(runs), dtype=_U), span) & _PLACE
            place = low.astype(np.int64) + at
            new = inside[at:stop] & np.concatenate([[place[0] != last or at == 0 or not inside[at - 1]], (place[1:] != place[:-1]) | ~inside[at : stop - 1]])
            firsts.append(np.flatnonzero(new) + at)
            least.append(runs[low[new]])
            last = int(place[-1])
        first = np.concatenate(firsts)
        if not len(first):
            return none
        end = self.first[np.searchsorted(self.first, first, side="right")] - window + 1
        return first, np.minimum(np.append(first[1:], n), end) - first, np.concatenate(least)


def _pack(*parts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"".join(p.tobytes() for p in parts))


def _unpack(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def _block_stage(block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0

        def block() -> pa.RecordBatch:
            order = np.argsort(np.array(ids, np.int64), kind="stable").tolist()
            sizes = np.array([len(texts[k]) for k in order], np.int64)
            packed = zstandard.ZstdCompressor(level=3).compress(b"".join(texts[k] for k in order))
            columns = [number, np.array(ids, np.int64)[order].tobytes(), sizes.tobytes(), packed]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(columns, (pa.int64(), pa.binary(), pa.binary(), pa.binary()))], names=["block", "ids", "sizes", "data"])

        for batch in batches:
            for id_, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                if ids and size + len(text) > block_bytes:
                    yield block()
                    number, ids, texts, size = number + 1, [], [], 0
                ids.append(id_)
                texts.append(text)
                size += len(text)
        if ids:
            yield block()

    return run


def _texts(batch: pa.RecordBatch, k: int) -> Texts:
    ids, sizes, data = (batch.column(c)[k].as_py() for c in ("ids", "sizes", "data"))
    return Texts(np.frombuffer(ids, np.int64), np.frombuffer(sizes, np.int64), _unpack(data))


def _asked(least: np.ndarray) -> np.ndarray:
    """Mixed anew, as least hashes crowd at the lower end."""
    return mix(least) >> _U(64 - ASKED_BITS)


def _shards(asked: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each hash; shards are ranges, so sorted hashes are sorted by shard."""
    return (asked.astype(np.float64) * (shards / 2.0**ASKED_BITS)).astype(np.int64)


def _ask_stage(window: int, shards: int):
    """Per block and shard: the hashes, how many stretches each has, and whether one occurs twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                t = _texts(batch, k)
                first, count, least = t.stretches(window)
                bytes_hash = hashes(t.data, first, first + count + window - 1) if len(first) else least
                asked = _asked(least)
                order = np.lexsort((bytes_hash, asked))
                asked, bytes_hash = asked[order], bytes_hash[order]
                head = np.flatnonzero(np.concatenate([[True], asked[1:] != asked[:-1]])) if len(asked) else np.empty(0, np.int64)
                other = np.concatenate([[True], (asked[1:] != asked[:-1]) | (bytes_hash[1:] != bytes_hash[:-1])]) if len(asked) else np.empty(0, bool)
                kinds = np.add.reduceat(other.astype(np.int64), head) if len(head) else head
                twice = np.diff(np.append(head, len(asked))) > 1
                asked, shard = asked[head], _shards(asked[head], shards)
                edges = np.flatnonzero(np.diff(shard, prepend=-1, append=-2)).tolist()
                block, rows = batch.column("block")[k].as_py(), []
                for lo, hi in zip(edges, edges[1:]):
                    steps = np.diff(asked[lo:hi], prepend=_U(0)).view(np.uint8).reshape(-1, 8).T  # like bytes together
                    number = np.minimum(kinds[lo:hi], 32_767).astype(np.int16) * np.where(twice[lo:hi], -1, 1).astype(np.int16)
                    rows.append((int(shard[lo]), block, _pack(np.frombuffer(struct.pack("<q", hi - lo), np.uint8), np.ascontiguousarray(steps), number)))
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))], names=["shard", "block", "asked"])

    return run


def _answer_stage(frequent: int):
    """What is known of each asked hash over all blocks."""

    def run(table: pa.Table) -> pa.Table:
        asked, number, size = [], [], []
        for blob in table.column("asked").to_pylist():
            raw = _unpack(blob)
            (n,) = struct.unpack_from("<q", raw)
            steps = np.frombuffer(raw, np.uint8, 8 * n, 8).reshape(8, n).T
            asked.append(np.cumsum(np.ascontiguousarray(steps).view(_U).reshape(-1)))
            number.append(np.frombuffer(raw, np.int16, n, 8 + 8 * n).astype(np.int64))
            size.append(n)
        number = np.concatenate(number)
        _, which = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(which, np.abs(number))
        twice = np.bincount(which, number < 0)
        state = np.where(total > frequent, HOT, np.where((total > 1) | (twice > 0), SHARED, ALONE)).astype(np.uint8)[which]
        answers = [_pack(x) for x in np.split(state, np.cumsum(size)[:-1])]
        return pa.table([table.column("block"), table.column("shard"), pa.array(answers, pa.binary())], names=["block", "shard", "state"])

    return run


def _states(batch: pa.RecordBatch, k: int, least: np.ndarray) -> np.ndarray:
    """The answers to this block, a state for each stretch."""
    answers = sorted(batch.column("answers")[k].as_py() or [], key=lambda a: a["shard"])
    state = np.frombuffer(b"".join(_unpack(a["state"]) for a in answers), np.uint8)
    return state[np.unique(_asked(least), return_inverse=True)[1]] if len(least) else np.empty(0, np.uint8)


def _deal_stage(window: int, buckets: int):
    """Stretches and single windows of a block, packed per bucket, and what is settled in the block itself."""

    def packed(t: Texts, key: np.ndarray, lo: np.ndarray, hi: np.ndarray, back: int) -> Iterator[tuple[int, int, bytes]]:
        """``lo`` ascends, so the first of equal strings is the earliest."""
        doc, place = t.at(lo)
        strings: dict[bytes, int] = {}
        first = np.array([strings.setdefault(t.bytes[x:y], k) for k, (x, y) in enumerate(zip(lo.tolist(), hi.tolist()))], np.int64)
        later = (doc != doc[first]) | (place != place[first])
        if later.any():
            ids, ranges, n = merged(doc[later], place[later], (place + hi - lo)[later])
            yield back, RANGES, _pack(np.array([len(ids)], np.int64), ids, n.astype(np.int64), ranges.astype(np.int32))
        head = np.flatnonzero(first == np.arange(len(first)))
        bucket = (mix(key[head]) % _U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        head, bucket = head[order], bucket[order]
        edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-2)).tolist()
        for a, b in zip(edges, edges[1:]):
            own = head[a:b]
            text = b"".join(t.bytes[x:y] for x, y in zip(lo[own].tolist(), hi[own].tolist()))
            yield int(bucket[a]), STRETCHES, _pack(np.array([b - a], np.int64), doc[own], place[own].astype(np.int32), (hi - lo)[own].astype(np.int32), np.frombuffer(text, np.uint8))

    def rows(t: Texts, state: np.ndarray, found: tuple, back: int) -> Iterator[tuple[int, int, bytes]]:
        first, count, least = found
        few = state == SHARED
        if few.any():
            yield from packed(t, least[few], first[few], first[few] + count[few] + window - 1, back)
        many = state == HOT
        if many.any():
            n = count[many]
            each = np.repeat(first[many] - np.cumsum(n) + n, n) + np.arange(n.sum())
            for at in range(0, len(each), SINGLE_WINDOWS):
                lo = each[at : at + SINGLE_WINDOWS]
                yield from packed(t, hashes(t.data, lo, lo + window), lo, lo + window, back)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                t = _texts(batch, k)
                found = t.stretches(window)
                back = batch.column("block")[k].as_py() % buckets
                out = list(rows(t, _states(batch, k, found[2]), found, back))
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], kind) for c, kind in enumerate((pa.int64(), pa.int8(), pa.binary()))], names=["bucket", "kind", "packed"])

    return run


def repeated(data: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """Which of the windows that begin at ``starts`` equal one that stands before it there.

    Most-significant digit first: a pass splits each group of equal beginnings by its next eight
    bytes, and a suffix that is left alone takes part in no later pass.
    """
    digits = np.ndarray((len(data) - 7,), dtype=">u8", buffer=data, strides=(1,))
    live, group = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    for at in [*range(0, window - 8, 8), window - 8]:
        digit = digits[starts[live] + at].astype(_U)
        order = np.lexsort((digit, group)) if at else np.argsort(digit)
        live, group, digit = live[order], group[order], digit[order]
        head = np.ones(len(live) + 1, bool)
        head[1:-1] = (digit[1:] != digit[:-1]) | (group[1:] != group[:-1])
        group = np.cumsum(head[:-1])
        more = ~(head[:-1] & head[1:])
        live, group = live[more], group[more]
        if not len(live):
            return live
    order = np.lexsort((live, group))
    live, group = live[order], group[order]
    return live[1:][group[1:] == group[:-1]]


def _sort_stage(window: int):
    """Ranges of bytes that repeated windows cover, from everything that reached one bucket."""

    def run(table: pa.Table) -> pa.Table:
        strings: dict[bytes, int] = {}
        docs, places, which, found = [], [], [], []
        for kind, blob in zip(table.column("kind").to_pylist(), table.column("packed").to_pylist()):
            raw = _unpack(blob)
            (n,) = struct.unpack_from("<q", raw)
            doc = np.frombuffer(raw, np.int64, n, 8)
            if kind == RANGES:
                ranges = np.frombuffer(raw, np.int32, -1, 8 + 16 * n).reshape(-1, 2).astype(np.int64)
                found.append((np.repeat(doc, np.frombuffer(raw, np.int64, n, 8 + 8 * n)), ranges[:, 0], ranges[:, 1]))
                continue
            edge = np.cumsum(np.concatenate([[8 + 16 * n], np.frombuffer(raw, np.int32, n, 8 + 12 * n)])).tolist()
            docs.append(doc)
            places.append(np.frombuffer(raw, np.int32, n, 8 + 8 * n).astype(np.int64))
            which.append(np.array([strings.setdefault(raw[x:y], len(strings)) for x, y in zip(edge, edge[1:])], np.int64))
        if strings:
            doc, place, string = np.concatenate(docs), np.concatenate(places), np.concatenate(which)
            order = np.lexsort((place, doc, string))
            doc, place, string = doc[order], place[order], string[order]
            head = np.flatnonzero(np.diff(string, prepend=-1))  # the earliest place of each string
            texts = list(strings)
            del strings
            size = np.array([len(x) for x in texts], np.int64)
            later = (doc != doc[head][string]) | (place != place[head][string])
            found.append((doc[later], place[later], (place + size[string])[later]))
            by = np.lexsort((place[head], doc[head]))  # by that place, so windows ascend as well
            data = np.frombuffer(b"".join(texts[k] for k in by.tolist()), np.uint8)
            del texts
            windows = size[by] - window + 1
            own = np.repeat(np.arange(len(by)), windows)
            inner = np.arange(len(own)) - np.repeat(np.cumsum(windows) - windows, windows)
            again = repeated(data, (np.cumsum(size[by]) - size[by])[own] + inner, window)
            start = place[head][by][own[again]] + inner[again]
            found.append((doc[head][by][own[again]], start, start + window))
        ids, ranges, n = merged(*(np.concatenate(x) for x in zip(*found)))
        return pa.table([pa.array(ids, pa.int64()), list_column(ranges, 2 * n, pa.int32())], names=["_llm_key", "_llm_ranges"])

    return run


def _slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Batches whose ``column`` has at most ``most`` bytes, or one row."""
    for batch in batches:
        size = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        at = 0
        while at < batch.num_rows:
            stop, held = at, 0
            while stop < batch.num_rows and (stop == at or held + size[stop] <= most):
                held += size[stop]
                stop += 1
            yield batch.slice(at, stop - at)
            at = stop


def _cut_stage(columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, "_llm_text", CUT_BYTES):
            total, gone, spans, kept = [], [], [], []
            for text, ranges in zip(plain(batch.column("_llm_text")), batch.column("_llm_ranges").to_pylist()):
                total.append(len(text))
                edge = np.zeros(len(text) + 1, np.int32)
                if ranges:
                    np.add.at(edge, ranges[::2], 1)
                    np.add.at(edge, ranges[1::2], -1)
                covered = np.cumsum(edge)[:-1] > 0
                gone.append(int(covered.sum()))
                spans.append(int((covered & ~np.concatenate([[False], covered[:-1]])).sum()) if gone[-1] else 0)
                kept.append(np.frombuffer(text, np.uint8)[~covered].tobytes() if gone[-1] else text)
            added = [pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *added], names=[*columns, "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def remove_repeated_bytes(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = 100,
    block_bytes: int = BLOCK_BYTES,
    shard_bytes: int = SHARD_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    frequent: int = FREQUENT,
) -> DataFrame:
    """``docs`` without ``text``, with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``.

    A byte of a text's UTF-8 is removed if it stands in a window of ``window`` bytes (8 at least) that also
    starts earlier: in a row of smaller ``key``, or further ahead in the same text.  Matches never
    cross texts, overlaps count, and windows are judged on the input.  ``n_spans`` is the number of maximal
    removed runs.  ``kept`` is binary, since a cut may fall inside a character.  Null and empty texts have
    no bytes; texts shorter than the window keep all.  Rows of null key keep all and are no one's
    earlier copy.  ``key`` names a text: rows that repeat a key count as one text, so equal rows keep
    their bytes.  Columns of ``docs`` that have the names of the added ones are replaced.
    """
    if window < 8:
        raise ValueError("window must be 8 bytes or more")
    added = [("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()), ("kept", T.BinaryType())]
    columns = [c for c in docs.columns if c not in {name for name, _ in added} - {key, text}]
    own = docs.select(F.col(f"`{key}`").cast("long").alias("_llm_key"), F.col(f"`{text}`").cast("string").alias("_llm_text"))
    blocks = saved(own.where(F.col("_llm_key").isNotNull() & (F.octet_length("_llm_text") >= window)).mapInArrow(_block_stage(block_bytes), "block long, ids binary, sizes binary, data binary"))
    size = own.agg(F.sum(F.octet_length("_llm_text"))).first()[0] or 0
    shards, buckets = max(1, -(-size // shard_bytes)), max(1, -(-size // bucket_bytes))
    asked = blocks.mapInArrow(_ask_stage(window, shards), "shard long, block long, asked binary")
    state = asked.groupBy("shard").applyInArrow(_answer_stage(frequent), "block long, shard long, state binary")
    answers = state.groupBy("block").agg(F.collect_list(F.struct("shard", "state")).alias("answers"))
    dealt = blocks.join(answers, "block").mapInArrow(_deal_stage(window, buckets), "bucket long, kind byte, packed binary")
    ranges = dealt.groupBy("bucket").applyInArrow(_sort_stage(window), "_llm_key long, _llm_ranges array<int>")
    ranges = ranges.groupBy("_llm_key").agg(F.flatten(F.collect_list("_llm_ranges")).alias("_llm_ranges"))
    kept = [c for c in columns if c != text]
    given = docs.select(*(F.col(f"`{c}`") for c in kept))
    whole = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{key}`").cast("long").alias("_llm_key"), F.col(f"`{text}`").cast("string").alias("_llm_text"))
    joined = compressed(whole, "_llm_text").join(ranges, "_llm_key", "left").select(*(F.col(f"`{c}`") for c in kept), "_llm_text", "_llm_ranges")
    return joined.mapInArrow(_cut_stage(kept), T.StructType([*given.schema.fields, *(T.StructField(n, k) for n, k in added)]))
