"""Perplexity over words: an interpolated modified Kneser-Ney model of order three, held sharded.

Log p of a word w after u, v is a sum of one value for each n-gram that ends or stands before it:

    base + a(w) + b(v) + a(v w) + b(u v) + a(u v w)

where b is a context's log back-off weight and a is what an n-gram that was seen adds to its
backed-off probability; both are zero for what was not seen.  So one table (n-gram hash, value)
holds the model, and the log p of a text is the sum of its n-grams' values.
The table grows with the corpus, and neither it nor any part of it comes to the driver.

Whoever needs an honest limit scores trusted texts that ``train`` has not seen.

What is counted are trigrams, as their words' hashes; all else follows from them.  They travel as packed
rows, one for each block of texts and range of middle words: the words of the row, and places among
them.  All values of a range follow from its trigrams, but for the words' own counts, which come by
a join.  A middle word's different trigrams meet in one task.
The table (n-gram hash, value) is larger than its trigrams, so it is made and asked in rounds by the
hash.  Texts ask in packed rows, one for each block and range of hashes, in rounds by their ids, and
tasks merge them with the values of that range.  Each such row is answered by one row, the sums of its
texts, and the answers to a block meet by its texts' ids.  Each round frees the disk of the one before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloakframe.llm.stage import forget, pressed, saved, unpressed
from cloakframe.llm.words import SPACED, Block, blocks, joined, longer, texts_of

ORDER = 3
#: What stands before and behind each text.
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)
#: Ranges of middle words, as bits of the hash.
MIDDLE_BITS = 7
#: Rounds of asking as bits of the n-gram's hash; the next bits are the range within a round.  Each goes in rounds of texts.
ASK_BITS, RANGE_BITS, TEXT_ROUNDS = 2, 5, 3

_STEP = 6 << 20
#: Rows that a task hands on at once.
_HELD = 1 << 20
_U = np.uint64

_Batches = Iterator[pa.RecordBatch]
_PACKED = "turn int, range int, asks boolean, grams binary, values binary, counts binary, owners binary, ids binary"
_TRIGRAMS = "range int, words binary, v binary, u binary, w binary, counts binary"
_MERGED = f"{_TRIGRAMS}, threes array<long>, twos array<long>, before binary"
#: own: how often each of the words is counted in all ranges; facts: discounts by order, the counts' sum, the probability
#: of an unseen word, and the count of END.
_MODEL = f"{_TRIGRAMS}, own binary, facts array<double>"


def padded(b: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes with two starts before and one end behind each text; each one's text, and its place there."""
    n = np.diff(b.first) + ORDER
    last = np.cumsum(n)
    owner = np.repeat(np.arange(len(n), dtype=np.int32), n)
    place = np.arange(len(owner), dtype=np.int32) - np.repeat((last - n).astype(np.int32), n)
    words = np.full(len(owner), START)
    inside = place >= ORDER - 1
    inside[last - 1] = False
    words[inside] = b.hashed()
    words[last - 1] = END
    return words, owner, place


def _runs(sorted_: np.ndarray) -> np.ndarray:
    """Where runs of equal values start."""
    new = np.ones(len(sorted_), dtype=bool)
    new[1:] = sorted_[1:] != sorted_[:-1]
    return np.flatnonzero(new)


def _places(gram: np.ndarray) -> np.ndarray:
    """The stable order of hashes: a sort of their high bits, with their places as low ones, unless those bits are too few."""
    bits = _U(len(gram).bit_length())
    key = np.sort(gram >> bits << bits | np.arange(len(gram), dtype=_U))
    order = (key & ((_U(1) << bits) - _U(1))).astype(np.int64)
    got = gram[order]
    return order if (got[1:] >= got[:-1]).all() else np.argsort(gram, kind="stable")


def _order(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows of small numbers, and where runs of equal rows start in it."""
    bits = [int(x.max(initial=0)).bit_length() for x in columns]
    if sum(bits) > 64:
        order = np.lexsort(columns[::-1])
        new = np.ones(len(order), dtype=bool)
        new[1:] = np.any([np.diff(x[order]) != 0 for x in columns], axis=0)
        return order, np.flatnonzero(new)
    key = np.zeros(len(columns[0]), dtype=_U)
    for x, n in zip(columns, bits):
        key = (key << _U(n)) | x.astype(_U)
    order = np.argsort(key)
    return order, _runs(key[order])


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64())}
    names, types = zip(*(x.split() for x in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(x, kinds[kind]) for x, kind in zip(zip(*rows), types, strict=True)], names=list(names))


def _steps(places: np.ndarray) -> bytes:
    return pressed(np.diff(places.astype(np.uint32), prepend=np.uint32(0)))


def _steps_back(data: bytes) -> np.ndarray:
    return np.cumsum(unpressed(data, np.uint32), dtype=np.uint32)


def _trigram_row(part: int, words: np.ndarray, v: np.ndarray, u: np.ndarray, w: np.ndarray, counts: np.ndarray) -> tuple:
    """Different trigrams by (v, u, w), which are places in ``words``; the row holds the words that stand in them."""
    used = np.zeros(len(words), dtype=bool)
    for x in (v, u, w):
        used[x] = True
    at = (np.cumsum(used) - 1).astype(np.uint32)
    return part, _differences(words[used]), _steps(at[v]), _steps(at[u]), pressed(at[w]), pressed(counts.astype(np.uint32))


def _trigrams_of(row: dict) -> tuple[np.ndarray, ...]:
    """Words, v, u, w and counts."""
    return np.cumsum(unpressed(row["words"], _U)), _steps_back(row["v"]), _steps_back(row["u"]), unpressed(row["w"], np.uint32), unpressed(row["counts"], np.uint32)


def _count_stage(batches: _Batches) -> _Batches:
    """Each block's trigrams, and how often they stand there, by range of the middle word."""
    for batch in batches:
        for b in blocks(texts_of(batch.column(0)), SPACED, lower=True, most=_STEP):
            words, _, place = padded(b)
            at = np.flatnonzero(place >= ORDER - 1)
            words, code = np.unique(words, return_inverse=True)
            v, u, w = code[at - 1], code[at - 2], code[at]
            order, start = _order([v, u, w])
            counts, first = np.diff(np.append(start, len(order))), order[start]
            v, u, w = v[first], u[first], w[first]
            part = (words >> _U(64 - MIDDLE_BITS)).astype(np.int64)[v]
            edge = _runs(part)
            yield _batch([_trigram_row(int(part[i]), words, *(x[i:j] for x in (v, u, w, counts))) for i, j in zip(edge, np.append(edge[1:], len(part)))], _TRIGRAMS)


def _tally(counts: np.ndarray) -> list[int]:
    """How many are one, two, three and four."""
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()


def _merge_stage(batches: _Batches) -> _Batches:
    """Rows of each range as one, with what else is counted there: trigrams and bigrams by their counts, and
    before how many different words of the range each word's bigrams start."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for part, own in groupby(rows, key=lambda row: row["range"]):
        pieces = [_trigrams_of(row) for row in own]
        words = np.unique(np.concatenate([x[0] for x in pieces]))
        at = [np.searchsorted(words, x[0]).astype(np.uint32) for x in pieces]
        v, u, w = (np.concatenate([a[x[k]] for a, x in zip(at, pieces)]) for k in (1, 2, 3))
        counts = np.concatenate([x[4] for x in pieces])
        del pieces, at
        order, start = _order([v, u, w])
        counts, first = np.add.reduceat(counts[order].astype(np.int64), start), order[start]
        v, u, w = v[first], u[first], w[first]
        order, start = _order([v, w])
        before = np.bincount(w[order[start]], minlength=len(words))
        twos = _tally(np.diff(np.append(start, len(order))))
        yield _batch([(*_trigram_row(part, words, v, u, w, counts), _tally(counts), twos, pressed(before.astype(np.uint32)))], _MERGED)


def _end_stage(batches: _Batches) -> _Batches:
    """The words whose counts a range needs, as they end bigrams there or stand in it, their places, and how many bigrams they end there."""
    for batch in batches:
        for row in batch.to_pylist():
            words, before = np.cumsum(unpressed(row["words"], _U)).view(np.int64), unpressed(row["before"], np.uint32)
            ends = np.flatnonzero((before > 0) | (words.view(_U) >> _U(64 - MIDDLE_BITS) == row["range"]))
            for i in range(0, len(ends), _HELD):
                at = ends[i : i + _HELD]
                columns = np.full(len(at), row["range"], np.int32), at.astype(np.int32), words[at], before[at].astype(np.int64)
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["range", "at", "w", "c"])


def _own_stage(facts: list[float]) -> Callable[[_Batches], _Batches]:
    """Rows of the model; the last two columns have places among a row's words, and the counts of the words there."""

    def run(batches: _Batches) -> _Batches:
        for batch in batches:
            for k in range(batch.num_rows):
                *row, at, c = (x[k] for x in batch.columns)
                row = [x.as_py() for x in row]
                own = np.zeros(len(unpressed(row[1], _U)), np.uint32)
                own[at.values.to_numpy()] = c.values.to_numpy()
                yield _batch([(*row, pressed(own), facts)], _MODEL)

    return run


def _value_stage(asked_now: int) -> Callable[[_Batches], _Batches]:
    """Values of the words, bigrams, trigrams and contexts of one round, from the model's rows."""

    def run(batches: _Batches) -> _Batches:
        for row in (row for batch in batches for row in batch.to_pylist()):
            found = [*_values_of(row)]
            gram, value = (np.concatenate(x) for x in zip(*found))
            now = gram >> _U(64 - ASK_BITS) == asked_now
            if now.any():
                yield _packed_values(gram[now], value[now].astype(np.float32))

    return run


def _values_of(row: dict) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """N-grams of a row of the model and their values."""
    words, v, u, w, c = _trigrams_of(row)
    one, two, three = np.array(row["facts"][:9]).reshape(3, 3)
    total, unseen, ends = row["facts"][9:]
    own = unpressed(row["own"], np.uint32).astype(np.float64)

    def taken(discounts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return discounts[np.clip(counts, 1, 3).astype(np.int64) - 1]

    def seen(counts: np.ndarray) -> np.ndarray:
        return (counts - taken(one, counts)) / total + unseen

    def context(counts: np.ndarray, discounts: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weight of each context, which starts there; for each row what its own count gives, and its context's weight."""
        d, size = taken(discounts, counts), np.diff(np.append(start, len(counts)))
        whole = np.add.reduceat(counts.astype(np.float64), start)
        weight = np.add.reduceat(d, start) / whole
        return weight, (counts - d) / np.repeat(whole, size), np.repeat(weight, size)

    below = seen(own)  # of words that end bigrams; others' are not read
    # Each word is told where its range is, END beside START.
    here = np.flatnonzero((words >> _U(64 - MIDDLE_BITS) == row["range"]) & (own > 0) & (words != END))
    yield words[here], np.log(below[here]) - np.log(unseen)
    if row["range"] == int(START >> _U(64 - MIDDLE_BITS)):
        yield np.array([END]), np.log(seen(np.array([ends]))) - np.log(unseen)
    by, start = _order([v, w])
    n, v2, w2 = np.diff(np.append(start, len(by))), v[by[start]], w[by[start]]
    edge = _runs(v2)
    weight, p, backed = context(n, two, edge)
    backed *= below[w2]
    p += backed
    yield words[v2[edge]], np.log(weight)
    yield joined(words[v2], words[w2]), np.log(p) - np.log(backed)
    lower = np.empty(len(by))
    lower[by] = np.repeat(p, n)
    new = np.ones(len(v), dtype=bool)
    new[1:] = (v[1:] != v[:-1]) | (u[1:] != u[:-1])
    edge = np.flatnonzero(new)
    weight, p, backed = context(c, three, edge)
    backed *= lower
    p += backed
    yield joined(words[u[edge]], words[v[edge]]), np.log(weight)
    yield joined(words[u], words[v], words[w]), np.log(p) - np.log(backed)


def _ranges(gram: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Round, range and places (from, to) of ascending hashes."""
    part = (gram >> _U(64 - ASK_BITS - RANGE_BITS)).astype(np.int64)
    start = _runs(part)
    return [(int(part[i]) >> RANGE_BITS, int(part[i]) & ((1 << RANGE_BITS) - 1), int(i), int(j)) for i, j in zip(start, np.append(start[1:], len(part)))]


def _differences(gram: np.ndarray) -> bytes:
    return pressed(np.diff(gram, prepend=_U(0)))


def _packed_values(gram: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
    order = _places(gram)
    gram, value = gram[order], value[order]
    return _batch([(turn, part, False, _differences(gram[i:j]), pressed(value[i:j]), None, None, None) for turn, part, i, j in _ranges(gram)], _PACKED)


def _sorted_stage(batches: _Batches) -> _Batches:
    """Values of each range as one row, in which each n-gram stands once; their sums, of 32-bit floats, are exact."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for _, own in groupby(rows, key=lambda row: row["range"]):
        pieces = [(np.cumsum(unpressed(row["grams"], _U)), unpressed(row["values"], np.float32)) for row in own]
        gram, value = (np.concatenate(x) for x in zip(*pieces))
        order = _places(gram)
        gram = gram[order]
        start = _runs(gram)
        yield _packed_values(gram[start], np.add.reduceat(value[order].astype(np.float64), start))


def _ask_stage(asked_now: int) -> Callable[[_Batches], _Batches]:
    """Each block's n-grams of one round, packed by range, with the texts that hold them, as often as they do."""

    def run(batches: _Batches) -> _Batches:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for b in blocks(texts_of(batch.column(1)), SPACED, lower=True, most=_STEP):
                words, owner, place = padded(b)
                asked, asking, gram = [], [], words
                owner = owner.astype(np.uint32)
                for n in range(1, ORDER + 1):
                    if n > 1:  # as joined() of the n words
                        gram = longer(joined(words[:-1]) if n == 2 else gram[:-1], words[n - 1 :], n)
                    own = np.flatnonzero((place[n - 1 :] >= max(1, n - 1)) & (gram >> _U(64 - ASK_BITS) == asked_now))
                    asked.append(gram[own])
                    asking.append(owner[own + n - 1])
                gram, held = np.concatenate(asked), np.concatenate(asking)
                if not len(gram):
                    continue
                order = _places(gram)
                gram, held = gram[order], held[order]
                start = _runs(gram)
                counts, first = np.diff(np.append(start, len(gram))).astype(np.uint32), np.append(start, len(gram))
                gram, name = gram[start], ids[b.rows].tobytes()
                yield _batch([(turn, part, True, _differences(gram[i:j]), None, pressed(counts[i:j]), pressed(held[first[i] : first[j]]), name) for turn, part, i, j in _ranges(gram)], _PACKED)

    return run


def _answer_stage(batches: _Batches) -> _Batches:
    """The sums of values of each asking row's texts; of each range the model's rows come first."""
    at, model = None, None
    for batch in batches:
        answers = []
        for k in range(batch.num_rows):
            _, part, asks, gram, value, counts, owners, name = (c[k].as_py() for c in batch.columns)
            gram = np.cumsum(unpressed(gram, _U))
            if not asks:
                at, model = part, (gram, unpressed(value, np.float64))
            elif part == at:
                place = np.minimum(np.searchsorted(model[0], gram), len(model[0]) - 1)
                got = np.where(model[0][place] == gram, model[1][place], 0.0)
                sums = np.bincount(unpressed(owners, np.uint32), np.repeat(got, unpressed(counts, np.uint32)), len(name) // 8)
                answers.append((name, sums.tobytes()))
        if answers:
            yield _batch(answers, "ids binary, sums binary")


def _sum_stage(batches: _Batches) -> _Batches:
    """Sums of each text of a block; rows stand by their block's hash."""
    rows = (row for batch in batches for row in zip(*(x.to_pylist() for x in batch.columns)))
    for _, own in groupby(rows, key=lambda row: row[0]):
        totals: dict[bytes, np.ndarray] = {}
        for _, ids, sums in own:
            totals[ids] = totals.get(ids, 0.0) + np.frombuffer(sums)
        for ids, total in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(ids, np.int64)), pa.array(total)], names=["id", "above"])


def _size_stage(batches: _Batches) -> _Batches:
    """How many words each text has."""
    for batch in batches:
        n = [np.diff(b.first) for b in blocks(texts_of(batch.column(1)), SPACED, lower=False)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([[0], *n])[1:].astype(np.int64))], names=["id", "n"])


def _together(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, tables)


def train(texts: DataFrame, text: str = "text") -> tuple[DataFrame, float] | None:
    """The model of all rows of ``texts``, as packed trigrams and what their values follow from, and its base; none if they hold no word."""
    from cloakframe.llm.quality import discounts

    own = texts.select(F.col(f"`{text}`").cast("string").alias("text")).where(F.col("text").rlike(r"[^ \t-\r]"))
    merged = saved(own.mapInArrow(_count_stage, _TRIGRAMS).repartition("range").sortWithinPartitions("range").mapInArrow(_merge_stage, _MERGED))
    # Lower orders count the words seen before them.
    ends = merged.select("range", "words", "before").mapInArrow(_end_stage, "range int, at int, w long, c long")
    one = saved(ends.groupBy("w").agg(F.sum("c").alias("c")).where("c > 0"))
    kinds, total, end, *tally = one.agg(F.count(F.lit(1)), F.sum("c"), F.max(F.when(F.col("w") == int(END), F.col("c"))), *(F.count_if(F.col("c") == k) for k in (1, 2, 3, 4))).first()
    if not kinds:
        forget(merged)
        forget(one)
        return None
    by_order = [discounts(*tally), *(discounts(*merged.agg(*(F.sum(F.col(name)[k]) for k in range(4))).first()) for name in ("twos", "threes"))]
    d1, d2, d3 = by_order[0]
    mass = d1 * tally[0] + d2 * tally[1] + d3 * (kinds - tally[0] - tally[1])
    unseen = mass / total / (kinds + 1)
    facts = [float(x) for x in (*(d for order in by_order for d in order), total, unseen, end)]
    counts = saved(ends.select("range", "at", "w").join(one, "w").groupBy("range").agg(F.collect_list(F.struct("at", "c")).alias("x")).select("range", "x.at", "x.c"))
    model = saved(merged.select(*(x.split()[0] for x in _TRIGRAMS.split(", "))).join(counts, "range").mapInArrow(_own_stage(facts), _MODEL))
    for table in (merged, one, counts):
        forget(table)
    return model, float(np.log(unseen))


def scores(asking: DataFrame, model: DataFrame) -> DataFrame:
    """id, n, above: words of each text with a word of ``asking`` (id, text), and the sum of its values.  Equal texts have one id."""
    asking = asking.where(F.col("text").rlike(r"[^ \t-\r]"))

    def valued(turn: int) -> DataFrame:
        return saved(model.mapInArrow(_value_stage(turn), _PACKED).repartition("range").sortWithinPartitions("range").mapInArrow(_sorted_stage, _PACKED))

    def answered(values: DataFrame, turn: int, texts: int) -> DataFrame:
        asked = asking.where(F.pmod("id", F.lit(TEXT_ROUNDS)) == texts).mapInArrow(_ask_stage(turn), _PACKED)
        both = values.union(asked).repartition("range").sortWithinPartitions("range", "asks")
        sums = both.mapInArrow(_answer_stage, "ids binary, sums binary").select(F.xxhash64("ids").alias("block"), "ids", "sums")
        return sums.repartition("block").sortWithinPartitions("block").mapInArrow(_sum_stage, "id long, above double").groupBy("id").agg(F.sum("above").alias("above"))

    parts = []
    for turn in range(1 << ASK_BITS):
        values = valued(turn)
        parts += [saved(answered(values, turn, texts)) for texts in range(TEXT_ROUNDS)]
        forget(values)
    sums = _together(parts).groupBy("id").agg(F.sum("above").alias("above"))
    sizes = asking.mapInArrow(_size_stage, "id long, n long").groupBy("id").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("copies"))
    return sizes.join(sums, "id", "left").select("id", "n", (F.coalesce("above", F.lit(0.0)) / F.col("copies")).alias("above"))
