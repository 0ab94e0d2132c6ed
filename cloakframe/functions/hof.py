"""Two small building blocks on top of Spark's higher-order functions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements built per inner fold of `running`.  Appending to an array copies it,
# so one flat fold over n elements copies n*n/2 references; in chunks it is
# about n*CHUNK/2, which stays linear for cells with very many matches.
CHUNK = 128
# Elements that `sums_before` sums in one expression.
BLOCK = 4


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``.

    A plain Python variable would paste the whole expression at every use, and
    inside a lambda Spark evaluates each paste again.  It is the start of a fold
    over nothing: unlike the result of a ``transform``, nothing is copied.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda bound, _: bound, body)


def running(n: Column, seed: Column, step: Callable[[Column, Column], Column]) -> Column:
    """``[step(seed, 0), step(previous, 1), ...]`` with ``n`` elements.

    ``seed`` is a struct and ``step(previous, i)`` returns the same struct, so
    an element can carry whatever the next one needs (an offset, a frontier).
    """

    def chunk(acc: Column, c: Column) -> Column:
        first = c * F.lit(CHUNK)
        last = F.least(n - F.lit(1), first + F.lit(CHUNK - 1))
        grown = F.aggregate(
            F.sequence(first, last),
            F.slice(acc, -1, 1),
            lambda arr, i: F.concat(arr, F.array(step(F.element_at(arr, -1), i))),
        )
        return F.concat(acc, F.slice(grown, 2, CHUNK))

    chunks = F.sequence(F.lit(0), F.floor((n - F.lit(1)) / F.lit(CHUNK)).cast("int"))
    return F.slice(F.aggregate(chunks, F.array(seed), chunk), F.lit(2), n)


def sums_before(values: Column, levels: int = 3) -> Column:
    """For each of an array of ints, the sum of those before it.

    Sums of blocks are summed in the same way, so that no element is copied with all before it.
    """
    blocks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / F.lit(BLOCK)).cast("int"))

    def chain(j: Column, start: Column) -> list[Column]:  # null from the end of the array on
        sums = [start]
        for k in range(BLOCK - 1):
            sums.append(sums[-1] + F.get(values, j * BLOCK + k))
        return sums

    def total(j: Column) -> Column:
        return reduce(lambda a, b: a + b, [F.coalesce(F.get(values, j * BLOCK + k), F.lit(0)) for k in range(BLOCK)])

    def placed(totals: Column) -> Column:
        if levels:
            before = sums_before(totals, levels - 1)
        else:
            seed = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("own"))
            before = F.transform(
                running(F.size(totals), seed, lambda prev, i: F.struct((prev.sum + prev.own).alias("sum"), F.get(totals, i).alias("own"))),
                lambda s: s.sum,
            )
        each = F.zip_with(blocks, before, lambda j, start: F.array(*chain(j, start)))
        return F.slice(F.flatten(each), F.lit(1), F.size(values))

    made = let(F.transform(blocks, total), placed)
    return F.when(F.size(values) > 0, made).otherwise(F.array().cast("array<int>"))
