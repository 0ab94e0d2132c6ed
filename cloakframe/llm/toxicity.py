"""Toxicity by a classifier chain of linear models.

Categories are predicted one after another; each model also sees the probabilities of the categories
before it.  In training these are out-of-fold predictions, so a later model learns from
probabilities as good as those it will get.  Features are the presence of words: those that tell
a category's labels apart best, by chi-square over all labelled texts.

Only the weights come from a sample: ``SAMPLE`` labelled texts at most, those of least hash of their key;
that bound is why one task can fit the chain.  Words are counted by label over all labelled texts, and
a category's limit is that of the best F1 over all of them, each predicted by the models of its own
fold, which saw neither its label nor its words.  Every text is scored, in one narrow stage.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cloakframe.llm.stage import saved, small
from cloakframe.llm.words import ALPHANUMERIC, blocks, list_column, mix, texts_of

#: Labelled texts that the chain is fitted on, and words that each category's model sees, at most.
SAMPLE, WORDS = 20_000, 192
#: Folds of the out-of-fold predictions; ridge penalty; Newton steps.
FOLDS, RIDGE, STEPS = 5, 0.3, 15

#: Bins of the log odds from which limits are drawn, for each unit.
BINS = 200

_U = np.uint64
#: The row of the word counts that counts texts.
_TEXTS = 0


def _fold(keys: np.ndarray) -> np.ndarray:
    """The fold of each key, independent of the order of rows."""
    return (mix(keys.view(_U)) % _U(FOLDS)).astype(np.int64)


def _presence(words: np.ndarray, owner: np.ndarray, n: int, chosen: np.ndarray) -> np.ndarray:
    """Rows of 0 and 1: which of the chosen words (sorted hashes) each text holds."""
    out = np.zeros((n, len(chosen)), dtype=np.float32)
    if len(chosen) and len(words):
        k = np.minimum(np.searchsorted(chosen, words), len(chosen) - 1)
        hit = chosen[k] == words
        out[owner[hit], k[hit]] = 1
    return out


def _tell_apart(words: np.ndarray, owner: np.ndarray, label: np.ndarray, most: int) -> np.ndarray:
    """The words of largest chi-square between texts with and without the label, as sorted hashes."""
    order = np.lexsort((owner, words))
    words, owner = words[order], owner[order]
    new = np.ones(len(words), dtype=bool)
    new[1:] = (words[1:] != words[:-1]) | (owner[1:] != owner[:-1])
    kinds, which = np.unique(words[new], return_inverse=True)
    with_ = np.bincount(which, weights=label[owner[new]], minlength=len(kinds))
    all_ = np.bincount(which, minlength=len(kinds)).astype(float)
    n, n1 = float(len(label)), float(label.sum())
    expected = all_ * n1 / n
    chi = (with_ - expected) ** 2 * n / np.maximum(expected * (n - n1) * (1 - all_ / n), 1e-9)
    kept = np.flatnonzero(all_ >= 3)
    best = kept[np.lexsort((kinds[kept], -chi[kept]))[:most]]
    return np.sort(kinds[best])


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression with a ridge, by Newton's method; the last weight is the constant."""
    x = np.column_stack([x, np.ones(len(x))]).astype(np.float64)
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(STEPS):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _limit(p: np.ndarray, y: np.ndarray) -> float:
    """The probability from which a text is of the category: that of the best F1 over out-of-fold predictions."""
    order = np.argsort(-p, kind="stable")
    p, y = p[order], y[order]
    f1 = 2 * np.cumsum(y) / (y.sum() + np.arange(1, len(y) + 1))
    f1[:-1][p[:-1] == p[1:]] = 0  # texts of one probability go together
    if not len(y) or not y.any():
        return 0.5
    k = int(np.argmax(f1))
    return float((p[k] + (p[k + 1] if k + 1 < len(p) else 0)) / 2)


def _fit_folds(keys: np.ndarray, words: list[np.ndarray], labels: np.ndarray, best: dict[tuple[int, int], np.ndarray] | None) -> tuple[list, list[list]]:
    """The chain, and for each fold the chain of models that did not see it.

    ``best`` has the words of a category (first key) without a fold (second key; ``FOLDS`` is none
    left out); else they are drawn from these texts.
    """
    flat, owner = np.concatenate([*words, np.empty(0, _U)]), np.repeat(np.arange(len(words)), [len(w) for w in words])
    fold, n = _fold(keys), len(words)
    earlier = np.empty((n, 0))
    chain, folds = [], [[] for _ in range(FOLDS)]
    for c, label in enumerate(labels.T.astype(float)):
        chosen = _tell_apart(flat, owner, label, WORDS) if best is None else best[c, FOLDS]
        x = np.column_stack([_presence(flat, owner, n, chosen), earlier])
        mean = label.mean() if n else 0.5
        out = np.full(n, mean)
        for f in range(FOLDS):
            held = fold == f
            if held.any() and not held.all():
                own = _tell_apart(flat[~held[owner]], owner[~held[owner]], np.where(held, 0.0, label), WORDS) if best is None else best[c, f]
                inside = np.column_stack([_presence(flat, owner, n, own), earlier])
                w = _fit(inside[~held], label[~held])
                out[held] = _sigmoid(inside[held] @ w[:-1] + w[-1])
                folds[f].append((own, w, 0.5))
            else:
                folds[f].append((np.empty(0, _U), np.append(np.zeros(earlier.shape[1]), _log_odds(mean)), 0.5))
        chain.append((chosen, _fit(x, label), _limit(out, label)))
        earlier = np.column_stack([earlier, _log_odds(out)])
    return chain, folds


def fit_chain(keys: np.ndarray, words: list[np.ndarray], labels: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """(words chosen, weights, limit) of each category in turn, from these texts alone; labels have a column for each.

    Weights are those of the words, of the earlier categories' log odds, and a constant.
    """
    return _fit_folds(keys, words, labels, None)[0]


def predict_chain(chain: list[tuple[np.ndarray, np.ndarray, float]], words: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """The probability of each category, a column each."""
    earlier, out = np.empty((n, 0)), []
    for chosen, weights, _ in chain:
        out.append(_sigmoid(np.column_stack([_presence(words, owner, n, chosen), earlier]) @ weights[:-1] + weights[-1]))
        earlier = np.column_stack([earlier, _log_odds(out[-1])])
    return np.stack(out, axis=1) if out else np.empty((n, 0))


def _labelled(batches: Iterator[pa.RecordBatch]):
    """Blocks of labelled texts: each one's key and labels, and (word, text) without repeats."""
    for batch in batches:
        for b in blocks(texts_of(batch.column("text")), ALPHANUMERIC, lower=True):
            hashed = b.hashed()
            kinds = [np.unique(hashed[lo:hi]) for lo, hi in zip(b.first[:-1], b.first[1:])]
            rest = batch.slice(int(b.rows[0]), len(b.rows))
            yield rest.column("key"), rest.column("labels"), kinds


def _count_stage(categories: int):
    """Texts of each word, fold and label, summed over a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, labels, kinds in _labelled(batches):
            sizes = [len(x) for x in kinds]
            words = np.concatenate([np.full(len(kinds), _TEXTS, _U), *kinds])
            owner = np.concatenate([np.arange(len(kinds)), np.repeat(np.arange(len(kinds)), sizes)])
            fold, y = _fold(keys.to_numpy()), np.array(labels.to_pylist(), dtype=np.int64).reshape(len(kinds), categories)
            order = np.lexsort((fold[owner], words))
            words, owner = words[order], owner[order]
            own = fold[owner]
            start = np.flatnonzero(np.append(True, (words[1:] != words[:-1]) | (own[1:] != own[:-1])))
            sums = [np.diff(np.append(start, len(words))), *(np.add.reduceat(y[owner, c], start) for c in range(categories))]
            yield pa.RecordBatch.from_arrays([pa.array(words[start].view(np.int64)), pa.array(own[start]), *map(pa.array, sums)], names=["word", "fold", "n", *(f"y{c}" for c in range(categories))])

    return run


def _best_stage(totals: list[list[int]]):
    """The words of largest chi-square in a part of the counts, for each category and fold left out.

    ``totals`` has the texts of each fold, then for each category those with its label.
    """
    texts = np.array(totals, dtype=float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            word = batch.column(0).to_numpy()
            counts = np.stack([x.to_numpy() for x in batch.columns[1:]]).reshape(len(texts), FOLDS, len(word)).astype(float)
            for c in range(len(texts) - 1):
                for out in range(FOLDS + 1):
                    rest = np.arange(FOLDS) != out
                    n, n1 = texts[0, rest].sum(), texts[c + 1, rest].sum()
                    all_, with_ = counts[0, rest].sum(0), counts[c + 1, rest].sum(0)
                    enough = all_ >= 3
                    expected = all_[enough] * n1 / max(n, 1)
                    chi = (with_[enough] - expected) ** 2 * n / np.maximum(expected * (n - n1) * (1 - all_[enough] / max(n, 1)), 1e-9)
                    before = held.get((c, out), (np.empty(0), np.empty(0, np.int64)))
                    chi, kinds = np.append(before[0], chi), np.append(before[1], word[enough])
                    top = np.lexsort((kinds, -chi))[:WORDS]
                    held[c, out] = chi[top], kinds[top]
        for (c, out), (chi, kinds) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(kinds), c)), pa.array(np.full(len(kinds), out)), pa.array(kinds), pa.array(chi)], names=["category", "fold", "word", "chi"])

    return run


def _words_stage(chosen: np.ndarray):
    """Those of the chosen words that each text of the sample holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, labels, kinds in _labelled(batches):
            kinds = [x[np.isin(x, chosen)] for x in kinds]
            words = list_column(np.concatenate(kinds).view(np.int64), np.array([len(x) for x in kinds]), pa.int64())
            yield pa.RecordBatch.from_arrays([keys, labels, words], names=["key", "labels", "words"])

    return run


def _fit_stage(best: dict[tuple[int, int], np.ndarray]):
    def run(table: pa.Table) -> pa.Table:
        keys = table.column("key").to_numpy()
        order = np.argsort(keys, kind="stable")
        words = [np.array(x, dtype=np.int64).view(_U) for x in table.column("words").to_pylist()]
        labels = np.array(table.column("labels").to_pylist(), dtype=np.int64)
        return pa.table({"chain": pa.array([pickle.dumps(_fit_folds(keys[order], [words[k] for k in order], labels[order], best))], pa.binary())})

    return run


def _score_stage(folds: list[list]):
    """Texts with and without the label in each bin of the log odds, by the models that did not see a text's fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, labels, kinds in _labelled(batches):
            fold, y = _fold(keys.to_numpy()), np.array(labels.to_pylist(), dtype=np.int64).reshape(len(kinds), -1)
            for f in np.unique(fold):
                mine = np.flatnonzero(fold == f)
                flat, owner = np.concatenate([kinds[k] for k in mine]), np.repeat(np.arange(len(mine)), [len(kinds[k]) for k in mine])
                place = np.floor(_log_odds(predict_chain(folds[f], flat, owner, len(mine))) * BINS).astype(np.int64)
                for c in range(y.shape[1]):
                    bins, which = np.unique(place[:, c], return_inverse=True)
                    with_ = np.bincount(which, weights=y[mine, c], minlength=len(bins)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(bins), c)), pa.array(bins), pa.array(np.bincount(which, minlength=len(bins))), pa.array(with_)], names=["category", "bin", "n", "y"])

    return run


def limit_of(bins: np.ndarray, n: np.ndarray, y: np.ndarray) -> float:
    """The probability of the best F1, from texts and labelled ones in each bin of the log odds."""
    order = np.argsort(-bins)
    bins, n, y = bins[order], n[order], y[order]
    if not y.sum():
        return 0.5
    k = int(np.argmax(2 * np.cumsum(y) / (y.sum() + np.cumsum(n))))
    return float((_sigmoid(bins[k] / BINS) + (_sigmoid((bins[k + 1] + 1) / BINS) if k + 1 < len(bins) else 0)) / 2)


def train(docs: DataFrame, labels: DataFrame, categories: list[str], key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> list:
    """The chain for the categories in their order; empty where nothing is labelled.

    Labels are 0 or 1.  Rows of null key or label are no examples, and a key that repeats is one.
    """
    known = labels.select(F.col(f"`{key}`").cast("long").alias("key"), F.array(*(F.col(f"`{c}`").cast("int") for c in categories)).alias("labels"))
    known = saved(known.where(F.col("key").isNotNull() & F.forall("labels", lambda x: x.isNotNull())).groupBy("key").agg(F.min("labels").alias("labels")))
    own = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    texts = own.join(small(known, known.count()), "key").select("key", "labels", "text")
    ys = [f"y{c}" for c in range(len(categories))]
    counts = texts.mapInArrow(_count_stage(len(categories)), ", ".join(f"{x} long" for x in ("word", "fold", "n", *ys)))
    sums = [F.sum(F.when(F.col("fold") == f, F.col(x)).otherwise(0)).alias(f"{x}_{f}") for x in ("n", *ys) for f in range(FOLDS)]
    counts = saved(counts.groupBy("word").agg(*sums))
    whole = counts.where(F.col("word") == _TEXTS).first()
    if whole is None:
        return []
    totals = [[whole[f"{x}_{f}"] for f in range(FOLDS)] for x in ("n", *ys)]
    told = counts.where(F.col("word") != _TEXTS).mapInArrow(_best_stage(totals), "category long, fold long, word long, chi double")
    ranked = told.withColumn("rank", F.row_number().over(Window.partitionBy("category", "fold").orderBy(F.desc("chi"), "word"))).where(F.col("rank") <= WORDS)
    best = {(c, f): [] for c in range(len(categories)) for f in range(FOLDS + 1)}
    for r in ranked.collect():
        best[r.category, r.fold].append(r.word)
    best = {k: np.sort(np.array(x, dtype=np.int64).view(_U)) for k, x in best.items()}
    chosen = saved(known.orderBy(F.xxhash64("key"), "key").limit(sample))
    examples = own.join(small(chosen, chosen.count()), "key").select("key", "labels", "text")
    examples = examples.mapInArrow(_words_stage(np.unique(np.concatenate(list(best.values())))), "key long, labels array<int>, words array<long>")
    fitted = examples.withColumn("part", F.lit(0)).groupBy("part").applyInArrow(_fit_stage(best), "chain binary").collect()
    if not fitted:
        return []
    chain, folds = pickle.loads(fitted[0].chain)
    bins = texts.mapInArrow(_score_stage(folds), "category long, bin long, n long, y long").groupBy("category", "bin").agg(F.sum("n").alias("n"), F.sum("y").alias("y")).collect()
    limits = [limit_of(*np.array([(r.bin, r.n, r.y) for r in bins if r.category == c]).T) for c in range(len(categories))]
    return [(words, weights, limit) for (words, weights, _), limit in zip(chain, limits)]


def rate(docs: DataFrame, chain: list, categories: list[str], text: str = "text") -> DataFrame:
    """``docs`` with ``p_<category>`` and boolean ``<category>`` added for each category.

    Words are runs of ASCII digits, letters (A to Z lower-cased) and characters beyond ASCII.  Null and
    empty texts have the probability of a text without any of the words.  Without a chain all
    probabilities are null and nothing is of any category.  Rows are independent.  Columns that have
    the names of the added ones are replaced.
    """
    names = [f"p_{c}" for c in categories]
    docs = docs.drop(*names, *categories)
    columns = docs.columns
    sent = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.empty((0, len(categories)))]
            for b in blocks(texts_of(batch.column(columns.index(text)).cast(pa.string())), ALPHANUMERIC, lower=True):
                parts.append(predict_chain(sent.value, b.hashed(), b.owners(), len(b.rows)) if sent.value else np.full((len(b.rows), len(categories)), np.nan))
            p = np.concatenate(parts)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(p[:, k], pa.float64(), from_pandas=True) for k in range(p.shape[1]))], names=[*columns, *names])

    rated = docs.mapInArrow(run, T.StructType([*docs.schema.fields, *(T.StructField(n, T.DoubleType()) for n in names)]))
    limits = [x[2] for x in chain] or [1.0] * len(categories)
    return rated.withColumns({c: F.coalesce(F.col(n) >= limit, F.lit(False)) for c, n, limit in zip(categories, names, limits)})
