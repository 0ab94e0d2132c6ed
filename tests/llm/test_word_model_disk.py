"""What the word model holds on disk while it is made."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cloakframe.llm import quality, word_model
from cloakframe.llm.stage import saved, shared_folder, unpressed

TEXTS = ["a b a b a b", "b a c", "", "c", "d e f g a b"] * 3


def test_a_saved_table_leaves_no_shuffle_files(spark):
    def shuffled():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}

    before = shuffled()
    got = saved(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("n")))
    assert got.count() == 7 and sum(r.n for r in got.collect()) == 499_500
    assert not [x for x in shuffled() - before if x.endswith(".data")]


def test_training_leaves_the_model_alone_in_the_shared_folder(spark):
    docs = spark.createDataFrame([(k, f"{t} x{k}") for k, t in enumerate(TEXTS)], "doc_id long, text string")
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.glob("llm-*"))
    model, _ = word_model.train(docs)
    assert {str(x) for x in set(folder.glob("llm-*")) - before} == {f.removeprefix("file:").replace("///", "/").rpartition("/")[0] for f in model.inputFiles()}
    assert quality.word_nats(docs, (model, 0.0)).count() == len(TEXTS)


def test_the_rounds_together_ask_for_every_ngram_once():
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(TEXTS)), pa.int64()), pa.array(TEXTS)], names=["id", "text"])
    grams, counts, owners = [], 0, np.zeros(len(TEXTS), int)
    for turn in range(1 << word_model.ASK_BITS):
        for rows in word_model._ask_stage(turn)(iter([batch])):
            for r in rows.to_pylist():
                got = np.cumsum(unpressed(r["grams"], np.uint64))
                assert r["asks"] and r["turn"] == turn and (np.diff(got.astype(object)) > 0).all()
                grams.extend(got.tolist())
                each = unpressed(r["counts"], np.uint32)
                assert len(each) == len(got) and len(unpressed(r["owners"], np.uint32)) == each.sum()
                np.add.at(owners, np.frombuffer(r["ids"], np.int64)[unpressed(r["owners"], np.uint32)], 1)
    pads = [["<s>", "<s>", *t.split(), "</s>"] for t in TEXTS]
    brute = [{tuple(p[k : k + n]) for p in pads for k in range(max(0, 2 - n), len(p) - n + 1)} for n in (1, 2, 3)]
    assert len(grams) == len(set(grams)) == sum(map(len, brute))
    assert owners.tolist() == [sum(len(p) - n + 1 - max(0, 2 - n) for n in (1, 2, 3)) for p in pads]
