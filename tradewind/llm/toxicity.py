"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tradewind.llm.chars import ngram_ids
from tradewind.llm.folds import labelled_sample
from tradewind.session import stored

ORDERS = (4, 5, 6)
BITS = 18
ROWS_PER_CLASS = 2500  # bound of the labelled sample that the classifier is fitted on
LEAST_ERRORS = 4.0  # standard errors by which an n-gram's shares in both classes differ at least, to be a feature
TOXIC_WEIGHT = 2.0  # what a row of label 1 counts beside one of label 0


@dataclass(frozen=True)
class ToxicityModel:
    weight: np.ndarray  # (2**BITS,) weight of each n-gram: its ratio times its coefficient
    bias: float


def present(text: str | None, first: np.ndarray) -> np.ndarray:
    """Distinct n-gram ids of a text. ``first`` is scratch space of ``2**BITS`` numbers."""
    found = []
    for ids in ngram_ids(text, ORDERS, BITS):
        order = np.arange(len(ids), dtype=np.int32)
        first[ids] = order
        found.append(ids[first[ids] == order])  # the last place of each id
    if not found:
        return np.zeros(0, np.uint32)
    ids = np.concatenate(found)
    order = np.arange(len(ids), dtype=np.int32)
    first[ids] = order
    return ids[first[ids] == order]


def log_count_ratios(
    counts: np.ndarray, documents: np.ndarray, least_errors: float = LEAST_ERRORS, smoothing: float = 1.0
) -> np.ndarray:
    """``log(p / q)`` of each n-gram from ``counts[class, id]`` of documents that have it.

    Where the two shares differ by under ``least_errors`` standard errors of a difference by chance, the ratio
    is 0: the n-gram is no feature. That bounds what the driver holds; a lower limit finds no more toxic documents.
    """
    share = (counts + smoothing) / (documents[:, None] + 2 * smoothing)
    pooled = (counts.sum(axis=0) + smoothing) / (documents.sum() + 2 * smoothing)
    error = np.sqrt(pooled * (1 - pooled) * (1 / documents).sum())
    return np.where(np.abs(share[1] - share[0]) >= least_errors * error, np.log(share[1] / share[0]), 0.0)


def fit_linear(
    rows: list[np.ndarray], labels: np.ndarray, row_weights: np.ndarray, scale: np.ndarray, l2: float, steps: int
) -> tuple[np.ndarray, float]:
    """Logistic regression on ``scale`` where the id is present, by Adam over all rows at once."""
    used = np.flatnonzero(scale)
    place = np.full(len(scale), -1, np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    kept = [place[r[scale[r] != 0]] for r in rows]
    ids = np.concatenate(kept)
    owner = np.repeat(np.arange(len(kept), dtype=np.int32), [len(k) for k in kept])
    value = scale[used].astype(np.float32)[ids]
    coefficient, bias = np.zeros(len(used)), 0.0
    share = row_weights / row_weights.sum()
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, steps + 1):
        margin = np.bincount(owner, value * coefficient[ids], len(kept)) + bias
        error = (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - labels) * share
        gradient = np.append(np.bincount(ids, value * error[owner], len(used)) + l2 * coefficient, error.sum())
        m = 0.9 * m + 0.1 * gradient
        v = 0.999 * v + 0.001 * gradient**2
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        coefficient, bias = coefficient - move[:-1], bias - move[-1]
    weight = np.zeros(len(scale))
    weight[used] = coefficient * scale[used]
    return weight, float(bias)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    folds: int = 5,
    fold: int = 0,
    rows_per_class: int = ROWS_PER_CLASS,
    l2: float = 1e-3,
    steps: int = 300,
    least_errors: float = LEAST_ERRORS,
    toxic_weight: float = TOXIC_WEIGHT,
) -> ToxicityModel:
    """Fit on at most ``rows_per_class`` labelled documents of either class, whole texts, outside the fold.

    The sample is stored once. Its n-gram counts come back as one array per class and file, and each
    row as its ids with a ratio, so the driver holds what the sample's bound allows and no text. Penalty, steps and
    the weight of label 1 were chosen by five folds of the learnable rows. If a
    class has no row, no n-gram counts and every text gets the smoothed share of label 1.
    """
    session = docs.sparkSession
    sample = stored(labelled_sample(docs, labels, label, folds, fold, rows_per_class))

    def count(batches):
        counts, rows, first = np.zeros((2, 1 << BITS), np.int64), [0, 0], np.zeros(1 << BITS, np.int32)
        for batch in batches:
            for text, toxic, copies in zip(*(batch.column(i).to_pylist() for i in range(3))):
                counts[toxic, present(text, first)] += copies
                rows[toxic] += copies
        yield pa.RecordBatch.from_arrays(
            [pa.array([0, 1]), pa.array(rows), pa.array([c.tobytes() for c in counts], pa.binary())],
            names=["label", "docs", "counts"],
        )

    counts, documents = np.zeros((2, 1 << BITS)), np.zeros(2)
    for r in sample.select("text", "label", "copies").mapInArrow(count, "label long, docs long, counts binary").toLocalIterator():
        counts[r["label"]] += np.frombuffer(r["counts"], np.int64)
        documents[r["label"]] += r["docs"]
    ratios = log_count_ratios(counts, documents, least_errors) if documents.min() > 0 else np.zeros(1 << BITS)
    if documents.min() == 0:
        return ToxicityModel(ratios, float(np.log((documents[1] + 0.5) / (documents[0] + 1.5))))
    used = session.sparkContext.broadcast(ratios != 0)

    def featurize(batches):
        first = np.zeros(1 << BITS, np.int32)
        for batch in batches:
            ids = [present(t, first) for t in batch.column(0).to_pylist()]
            ids = [np.sort(i[used.value[i]]).tobytes() for i in ids]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(ids, pa.binary())], names=["label", "weight", "ids"])

    rows = sample.select("text", "label", "weight", "doc_id").orderBy("doc_id", "text").drop("doc_id")
    rows = rows.mapInArrow(featurize, "label int, weight double, ids binary").collect()
    weight, bias = fit_linear(
        [np.frombuffer(r["ids"], np.uint32) for r in rows],
        np.array([r["label"] for r in rows], float),
        np.array([r["weight"] * (toxic_weight if r["label"] else 1.0) for r in rows]),
        ratios,
        l2,
        steps,
    )
    return ToxicityModel(weight.astype(np.float32), bias)


def score_text(text: str | None, model: ToxicityModel) -> float:
    """Probability of label 1. Empty and NULL texts have no n-gram: the bias alone speaks."""
    found = [ids[model.weight[ids] != 0] for ids in ngram_ids(text, ORDERS, BITS)]
    ids = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint32)
    margin = float(model.weight[ids].sum(dtype=np.float64)) + model.bias
    return float(1 / (1 + np.exp(-np.clip(margin, -500, 500))))


def predict(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with ``score`` added (a column of this name is replaced). Every row is scored by its text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != "score"]
    at = kept.index("text")

    def score(batches):
        for batch in batches:
            found = [score_text(t, shared.value) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*kept, "score"])

    plain = docs.select(*kept)
    return plain.mapInArrow(score, StructType(plain.schema.fields + StructType().add("score", "double").fields))
