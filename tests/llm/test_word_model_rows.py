"""How many rows the word model's tasks hand on."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cloakframe.llm import quality, word_model
from cloakframe.llm.stage import pressed, unpressed

TEXTS = ["a b a b a b", "b a c", "c", "d e f g a b"]


def asked(turn: int, texts: list[str]) -> pa.RecordBatch:
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["id", "text"])
    return pa.Table.from_batches([x for _ in range(3) for x in word_model._ask_stage(turn)(iter([batch]))]).sort_by("range").combine_chunks().to_batches()[0]


def test_a_row_that_asks_is_answered_by_one_row_of_all_its_texts():
    """Three equal blocks, each in every range; a row for each text and task would grow with texts x tasks."""
    rows = asked(1, TEXTS)
    kinds = rows.schema
    values = []
    for row in rows.to_pylist():
        if not values or values[-1]["range"] != row["range"]:
            n = len(unpressed(row["counts"], np.uint32))
            values.append(row | {"asks": False, "values": pressed(np.ones(n)), "counts": None, "owners": None, "ids": None})
    both = pa.Table.from_pylist([*values, *rows.to_pylist()], kinds).sort_by([("range", "ascending"), ("asks", "ascending")])
    answers = [r for b in word_model._answer_stage(iter(both.combine_chunks().to_batches())) for r in b.to_pylist()]
    assert len(answers) == rows.num_rows
    want = np.zeros(len(TEXTS))
    for row in rows.to_pylist():
        np.add.at(want, unpressed(row["owners"], np.uint32), 1)
    assert np.array_equal(sum(np.frombuffer(r["sums"]) for r in answers), want)
    batch = pa.RecordBatch.from_arrays([pa.array([1] * len(answers), pa.int64()), pa.array([r["ids"] for r in answers]), pa.array([r["sums"] for r in answers])], names=["block", "ids", "sums"])
    (summed,) = word_model._sum_stage(iter([batch]))
    assert summed.column("id").to_pylist() == list(range(len(TEXTS))) and summed.column("above").to_pylist() == want.tolist()


def test_texts_by_round_and_copies_have_one_row_each(spark):
    texts = [f"{t} x{k % 7}" for k, t in enumerate(TEXTS * 10)] + ["", " \t", None]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    got = quality.word_nats(docs, word_model.train(docs)).collect()
    ids = {r.id for r in docs.where(F.col("text").rlike(r"\S")).select(F.xxhash64("text").alias("id")).collect()}
    assert len(got) == len(ids) and {r.id for r in got} == ids and all(r.nats > 0 for r in got)
