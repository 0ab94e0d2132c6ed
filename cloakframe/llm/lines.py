"""Line deduplication over content-defined chunks of lines.

A rolling hash over the hashes of ``ROLL`` lines decides where a chunk ends, so boundaries depend on
nearby lines only and come back after an insertion.  A chunk has two lines at least, but for the
rest at a text's end.  A chunk whose bytes occur earlier (in a smaller key, or further ahead in the
same text) is removed.

Chunks are counted by hash, combined before the shuffle.  The hash covers all bytes, empty lines too, so the
first of a hash is the first with these bytes.  Only for hashes that repeat do the bytes
travel: each later chunk is joined with the first of its hash and compared byte by byte.
Both joins are ordinary ones, whose frequent keys Spark splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cloakframe.llm.stage import compressed, plain, saved
from cloakframe.llm.words import Block, blocks, grams, mix, texts_of

#: Lines that the rolling hash covers; one in ``ENDS`` hashes ends a chunk; lines of a chunk at least.
ROLL, ENDS, LINES = 2, 2, 2

_U = np.uint64
_LINE = np.ones(256, dtype=bool)
_LINE[0x0A] = False


def chunks(b: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each chunk of ``LINES`` lines or more: text, start and end byte in the block, hash."""
    lines = b.hashed()
    empty = np.empty(0, np.int64)
    if not len(lines):
        return empty, empty, empty, empty.view(_U)
    owner = b.owners()
    ends = np.zeros(len(lines), dtype=bool)
    ends[ROLL - 1 :] = grams(lines, ROLL) % _U(ENDS) == 0
    ends[ROLL - 1 :] &= owner[ROLL - 1 :] == owner[: len(lines) - ROLL + 1]
    last = np.append(owner[1:] != owner[:-1], True)
    stops, since = [], 0
    for k in np.flatnonzero(ends | last).tolist():  # an end too near the one before does not count
        if last[k] or k - since + 1 >= LINES:
            stops.append(k)
            since = k + 1
    stop = np.array(stops, dtype=np.int64)
    start = np.concatenate([[0], stop[:-1] + 1])
    long = stop - start + 1 >= LINES
    blank = np.zeros(len(lines), dtype=_U)  # empty lines before each line of a chunk but its first
    blank[1:] = (b.starts[1:] - b.ends[:-1] - 1).astype(_U)
    blank[start] = 0
    spaced = np.where(blank > 0, mix(lines ^ mix(blank)), lines)
    total = np.concatenate([np.zeros(1, _U), np.cumsum(mix(spaced + (np.arange(len(lines)) - np.repeat(start, stop - start + 1)).astype(_U)))])
    hashed = mix(total[stop + 1] - total[start] + (stop - start).astype(_U))
    start, stop = start[long], stop[long]
    return owner[start], b.starts[start], b.ends[stop], hashed[long]


def _find_stage():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys = texts_of(batch.column(1)), batch.column(0)
            for b in blocks(texts, _LINE, lower=False):
                text, lo, hi, hashed = chunks(b)
                begin = np.cumsum([0, *(len(texts[k]) + 1 for k in b.rows[:-1].tolist())])
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(b.rows[text])), pa.array((lo - begin[text]).astype(np.int32)), pa.array((hi - lo).astype(np.int32)), pa.array(hashed.view(np.int64))],
                    names=["key", "place", "size", "hash"],
                )

    return run


def _fetch_stage():
    """The bytes of the chunks that each text lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text, listed in zip(batch.column("key").to_pylist(), plain(batch.column("text")), batch.column("listed").to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x["hash"] for x in listed], pa.int64()), pa.array([key] * len(listed), pa.int64()), pa.array([x["place"] for x in listed], pa.int32()),
                     pa.array([x["is_first"] for x in listed], pa.bool_()), pa.array([text[x["place"] : x["place"] + x["size"]] for x in listed], pa.binary())],
                    names=["hash", "key", "place", "is_first", "bytes"],
                )

    return run


def _cut_stage(columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines, removed, kept = [], [], []
            for text, cuts in zip(plain(batch.column("_llm_text")), batch.column("_llm_cuts").to_pylist()):
                parts, at, gone = [], 0, 0
                for place, size in sorted((x["place"], x["size"]) for x in cuts or []):
                    gone += sum(map(bool, text[place : place + size].split(b"\n")))
                    parts.append(text[at:place])
                    at = place + size + 1  # with its line feed
                n_lines.append(sum(map(bool, text.split(b"\n"))))
                removed.append(gone)
                kept.append(b"".join([*parts, text[at:]]) if parts else text)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(n_lines, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=[*columns, "n_lines", "n_removed", "kept_text"],
            )

    return run


def remove_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with ``n_lines``, ``n_removed`` (lines that are not empty) and ``kept_text``.

    Null and empty texts have no lines.  Rows of null key keep all lines and are no one's earlier
    copy.  ``key`` names a text: rows that repeat a key count as one text and keep their lines.
    Columns of ``docs`` that have the names of the added ones are replaced.
    """
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed", "kept_text", text)]
    own = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    found = saved(own.where("key is not null").mapInArrow(_find_stage(), "key long, place int, size int, hash long").distinct())
    repeated = found.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "place")).alias("first")).where("n > 1")
    copies = found.join(repeated.select("hash", "first"), "hash").withColumn("is_first", (F.col("key") == F.col("first.key")) & (F.col("place") == F.col("first.place")))
    listed = copies.groupBy("key").agg(F.collect_list(F.struct("hash", "place", "size", "is_first")).alias("listed"))
    texts = compressed(own, "text")
    held = saved(texts.join(listed.hint("shuffle_hash"), "key").mapInArrow(_fetch_stage(), "hash long, key long, place int, is_first boolean, bytes binary"))
    firsts = held.where("is_first").select("hash", F.col("bytes").alias("first_bytes"))
    cuts = held.where("not is_first").join(firsts, "hash").where("bytes = first_bytes").groupBy("key").agg(F.collect_set(F.struct("place", F.octet_length("bytes").alias("size"))).alias("_llm_cuts"))
    given = docs.select(*(F.col(f"`{c}`") for c in columns))
    whole = docs.select(*(F.col(f"`{c}`") for c in columns), F.col(f"`{key}`").cast("long").alias("_llm_key"), F.col(f"`{text}`").cast("string").alias("_llm_text"))
    joined = compressed(whole, "_llm_text").join(cuts.withColumnRenamed("key", "_llm_key").hint("shuffle_hash"), "_llm_key", "left").select(*(F.col(f"`{c}`") for c in columns), "_llm_text", "_llm_cuts")
    added = [T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]
    return joined.mapInArrow(_cut_stage(columns), T.StructType([*given.schema.fields, *added]))
