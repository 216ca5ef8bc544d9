"""Quality: attention-based multiple-instance learning over the passages of a document."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tradewind.llm.chars import code_points
from tradewind.llm.folds import labelled_sample
from tradewind.session import stored

PASSAGE = 600  # characters
HIDDEN, ATTENTION = 24, 12
ROWS_PER_CLASS = 1500  # bound of the labelled sample that the model is fitted on

#: Character classes: the first is everything that no other one holds.
CLASSES = 1 + 12
_TABLE = 0x250  # Latin letters with their accents end here; later letters count as lower case


def _class_table() -> np.ndarray:
    table = np.zeros(_TABLE + 1, np.int64)
    for point in range(_TABLE):
        c = chr(point)
        table[point] = (
            1 if c.islower() else 2 if c.isupper() else 3 if c.isdigit() else 4 if c == "\n" else 5 if c.isspace()
            else 6 if c == "." else 7 if c in ",;:" else 8 if c in "!?" else 9 if c == "|" else 10 if c in "#$%&*@~^=+_<>{}[]\\"
            else 11 if c in "'\"()-/" else 0
        )
    table[_TABLE] = 12
    return table


CLASS_OF = _class_table()
BIGRAMS = 32
FEATURES = CLASSES + 6 + BIGRAMS


def passages(text: str | None) -> np.ndarray:
    """One row of features per passage of 600 characters, over the whole text; one zero row if it is empty.

    Shares of character classes; word length, shares of distinct and of repeated neighbouring words,
    of capital-only words; hashed character pairs; how full the passage is.
    """
    if not text:
        return np.zeros((1, FEATURES))
    points = code_points(text)
    n = len(points)
    owner = np.arange(n) // PASSAGE
    count = int(owner[-1]) + 1
    length = np.bincount(owner, minlength=count).astype(float)
    kinds = CLASS_OF[np.minimum(points, _TABLE)]
    shares = np.bincount(owner * CLASSES + kinds, minlength=count * CLASSES).reshape(count, CLASSES) / length[:, None]

    space = (kinds == 4) | (kinds == 5)
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    words = np.zeros((count, 5))
    if len(starts):
        ends = np.append(np.flatnonzero(space[starts[0] :] & ~np.concatenate(([True], space[starts[0] : -1]))) + starts[0], n)
        ends = ends[: len(starts)]
        low = np.where((points >= 65) & (points <= 90), points + 32, points).astype(np.uint64)
        sums = np.concatenate(([np.uint64(0)], np.cumsum((low + 7) * (low ^ np.uint64(0x9E3779B97F4A7C15)))))
        name = (sums[ends] - sums[starts]) * np.uint64(0xC2B2AE3D27D4EB4F)  # the same letters give the same name
        at = owner[starts]
        per = np.maximum(np.bincount(at, minlength=count), 1)
        capitals = np.concatenate(([0], np.cumsum(kinds == 2)))
        shouted = (capitals[ends] - capitals[starts]) * 2 > ends - starts
        same = np.concatenate(([False], (name[1:] == name[:-1]) & (at[1:] == at[:-1])))
        order = np.lexsort((name, at))
        fresh = np.concatenate(([True], (name[order][1:] != name[order][:-1]) | (at[order][1:] != at[order][:-1])))
        words = np.stack(
            [
                np.minimum(np.bincount(at, ends - starts, count) / per / 10, 3),
                np.bincount(at[order], fresh, count) / per,
                np.bincount(at, same, count) / per,
                np.bincount(at, shouted, count) / per,
                per / length,
            ],
            axis=1,
        )
    pairs = np.zeros((count, BIGRAMS))
    if n > 1:
        code = ((points[:-1] * np.uint32(0x85EBCA6B)) ^ points[1:]) * np.uint32(0x9E3779B1)
        code = (code >> np.uint32(27)).astype(np.int64)
        pairs = np.bincount(owner[:-1] * BIGRAMS + code, minlength=count * BIGRAMS).reshape(count, BIGRAMS) / length[:, None]
    return np.concatenate([shares, words, (length / PASSAGE)[:, None], pairs], axis=1)


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    spread: np.ndarray
    weights: dict[str, np.ndarray]


def _softmax_parts(logit: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    top = np.maximum.reduceat(logit, first)
    power = np.exp(logit - np.repeat(top, sizes))
    return power / np.repeat(np.add.reduceat(power, first), sizes)


def forward(rows: np.ndarray, sizes: np.ndarray, w: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Gated attention: each passage is encoded, weighed against the others of its document, and summed."""
    first = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
    code = np.tanh(rows @ w["W"] + w["b"])
    look, gate = np.tanh(code @ w["V"]), 1 / (1 + np.exp(-(code @ w["U"])))
    share = _softmax_parts((look * gate) @ w["a"], first, sizes)
    whole = np.add.reduceat(share[:, None] * code, first, axis=0)
    margin = whole @ w["c"] + w["d"]
    score = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
    return {"first": first, "code": code, "look": look, "gate": gate, "share": share, "whole": whole, "score": score}


def train(
    bags: list[np.ndarray], labels: np.ndarray, row_weights: np.ndarray, steps: int = 120, rate: float = 0.03, l2: float = 1e-4
) -> QualityModel:
    """Adam over all bags at once. Without bags of both classes every text gets the smoothed share of label 1."""
    positives = float(labels.sum())
    rng = np.random.default_rng(5)
    w = {
        "W": rng.normal(0, FEATURES**-0.5, (FEATURES, HIDDEN)),
        "b": np.zeros(HIDDEN),
        "V": rng.normal(0, HIDDEN**-0.5, (HIDDEN, ATTENTION)),
        "U": rng.normal(0, HIDDEN**-0.5, (HIDDEN, ATTENTION)),
        "a": rng.normal(0, ATTENTION**-0.5, ATTENTION),
        "c": np.zeros(HIDDEN),
        "d": np.array(np.log((positives + 0.5) / (len(labels) - positives + 0.5))),
    }
    if positives in (0.0, float(len(labels))):
        return QualityModel(np.zeros(FEATURES), np.ones(FEATURES), w)
    rows, sizes = np.concatenate(bags), np.array([len(b) for b in bags])
    mean, spread = rows.mean(axis=0), rows.std(axis=0) + 1e-6
    rows = np.clip((rows - mean) / spread, -6, 6)
    weight = row_weights / row_weights.sum()
    m, v = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))
    for step in range(1, steps + 1):
        f = forward(rows, sizes, w)
        error = (f["score"] - labels) * weight
        d_whole = np.repeat(error, sizes)[:, None] * w["c"]
        gain = (d_whole * f["code"]).sum(axis=1)
        mixed = np.repeat(np.add.reduceat(f["share"] * gain, f["first"]), sizes)
        d_logit = f["share"] * (gain - mixed)
        d_both = d_logit[:, None] * w["a"]
        d_look = d_both * f["gate"] * (1 - f["look"] ** 2)
        d_gate = d_both * f["look"] * f["gate"] * (1 - f["gate"])
        d_code = f["share"][:, None] * d_whole + d_look @ w["V"].T + d_gate @ w["U"].T
        d_in = d_code * (1 - f["code"] ** 2)
        gradient = {
            "W": rows.T @ d_in, "b": d_in.sum(axis=0), "V": f["code"].T @ d_look, "U": f["code"].T @ d_gate,
            "a": (f["look"] * f["gate"]).T @ d_logit, "c": f["whole"].T @ error, "d": error.sum(),
        }
        for k, g in gradient.items():
            g = g + l2 * w[k] * (k != "d")
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            w[k] = w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return QualityModel(mean, spread, w)


def score_texts(texts: list[str | None], model: QualityModel) -> np.ndarray:
    bags = [passages(t) for t in texts]
    if not bags:
        return np.zeros(0)
    rows = np.clip((np.concatenate(bags) - model.mean) / model.spread, -6, 6)
    return forward(rows, np.array([len(b) for b in bags]), model.weights)["score"]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    folds: int = 4,
    fold: int = 2,
    rows_per_class: int = ROWS_PER_CLASS,
) -> QualityModel:
    """Fit on at most ``rows_per_class`` labelled documents of either class outside the fold, whole texts.

    Only the passages' features come to the driver. NULL and empty texts are one empty passage.
    """
    sample = stored(labelled_sample(docs, labels, label, folds, fold, rows_per_class))

    def featurize(batches):
        for batch in batches:
            rows = [passages(t).astype(np.float32).tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(rows, pa.binary())], names=["label", "weight", "rows"])

    rows = sample.orderBy("doc_id", "text").select("text", "label", "weight")
    rows = rows.mapInArrow(featurize, "label int, weight double, rows binary").collect()
    return train(
        [np.frombuffer(r["rows"], np.float32).reshape(-1, FEATURES).astype(float) for r in rows],
        np.array([r["label"] for r in rows], float),
        np.array([r["weight"] for r in rows]),
    )


def predict(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``docs`` with ``score`` added (a column of this name is replaced). Every row is scored by its text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != "score"]
    at = kept.index("text")

    def score(batches):
        for batch in batches:
            texts, found = batch.column(at).to_pylist(), []
            for start in range(0, len(texts), 64):
                found.append(score_texts(texts[start : start + 64], shared.value))
            column = pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*kept, "score"])

    plain = docs.select(*kept)
    return plain.mapInArrow(score, StructType(plain.schema.fields + StructType().add("score", "double").fields))
