"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tradewind.llm.chars import has_letter, ngram_ids

ORDERS = (1, 2, 3)
BITS = 15
SLOT = 4096  # counts per row while the counts of all partitions are added up
MERGES = 1024  # groups that partitions are added up in before these are added up: a few dozen MB each for a million partitions
BATCH_IDS = 1 << 17  # n-grams of the texts that are scored at once
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    log_prior: np.ndarray  # (languages,)
    log_prob: np.ndarray  # (languages, 2**BITS)


def fit(docs: DataFrame, learnable: str = "true", smoothing: float = 0.1) -> LanguageModel:
    """Count n-grams per ``lang`` over all rows of ``docs(text, lang)`` where ``learnable`` holds.

    Every partition adds up its own counts; they travel as a few blocks per language, so what is
    shuffled depends on languages and partitions, not on texts. They are added up in two steps, so that no group
    has a row for each partition. The model is ``2**BITS`` numbers per
    language. Rows without text or language teach nothing; without any row there are no languages.
    """

    def count(batches):
        counts, rows = defaultdict(lambda: np.zeros(1 << BITS, np.int64)), defaultdict(int)
        waiting, held = defaultdict(list), 0

        def settle():
            for lang, ids in waiting.items():
                counts[lang] += np.bincount(np.concatenate(ids), minlength=1 << BITS)
            waiting.clear()

        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows[lang] += 1
                for ids in ngram_ids(text, ORDERS, BITS):
                    waiting[lang].append(ids)
                    held += len(ids)
                if held > 4_000_000:
                    settle()
                    held = 0
        settle()
        group = TaskContext.get().partitionId() % MERGES
        out = [
            (lang, k, group, rows[lang] if k == 0 else 0, counts[lang][k * SLOT : (k + 1) * SLOT].tobytes())
            for lang in rows
            for k in range((1 << BITS) // SLOT)
        ]
        for row in out:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["lang", "slot", "part", "docs", "counts"])

    def add_up(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.int64) for x in frame["counts"])
        return frame.iloc[:1].assign(docs=frame["docs"].sum(), counts=[total.tobytes()])

    kind = "lang string, slot long, part long, docs long, counts binary"
    usable = docs.where(F.expr(learnable)).where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    parts = usable.mapInArrow(count, kind).groupBy("lang", "slot", "part").applyInPandas(add_up, kind)
    parts = parts.groupBy("lang", "slot").applyInPandas(add_up, kind).collect()
    languages = sorted({r["lang"] for r in parts})
    counts, rows = np.full((len(languages), 1 << BITS), smoothing), np.zeros(len(languages))
    for r in parts:
        k = languages.index(r["lang"])
        counts[k, r["slot"] * SLOT : (r["slot"] + 1) * SLOT] += np.frombuffer(r["counts"], np.int64)
        rows[k] += r["docs"]
    log_prob = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)
    return LanguageModel(languages, np.log(rows / max(1.0, rows.sum())), log_prob)


def classify(texts: list[str | None], model: LanguageModel) -> tuple[list[str], np.ndarray]:
    """The likeliest language of each text (ties: the first by name) and its posterior probability.

    The n-grams of all texts are the rows of one sparse matrix of counts, which is multiplied with the
    log-probabilities: for each language, those of all n-grams are looked up and added up text by text.
    """
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    asked = [k for k, text in enumerate(texts) if model.languages and has_letter(text)]
    if not asked:
        return names, scores
    found = [np.concatenate(list(ngram_ids(texts[k], ORDERS, BITS))) for k in asked]
    ids, starts = np.concatenate(found), np.cumsum([0, *(len(f) for f in found[:-1])])
    total = np.stack([np.add.reduceat(row.take(ids), starts, dtype=np.float64) for row in model.log_prob], axis=1)
    total += model.log_prior
    best = total.argmax(axis=1)
    scores[asked] = 1 / np.exp(total - total[np.arange(len(asked)), best][:, None]).sum(axis=1)
    for k, language in zip(asked, best.tolist()):
        names[k] = model.languages[language]
    return names, scores


def _batches(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Neighbouring texts with a bounded number of n-grams; a longer text is a batch of its own."""
    batch, size = [], 0
    for text in texts:
        own = len(ORDERS) * len(text or "")
        if batch and size + own > BATCH_IDS:
            yield batch
            batch, size = [], 0
        batch.append(text)
        size += own
    if batch:
        yield batch


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` added (columns of these names are replaced).

    A text that is NULL or has no letter gets ``und`` and score 0, and so does every text if the
    model knows no language. Repeated rows are scored alike; no row is lost.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    at = kept.index("text")

    def score(batches):
        for batch in batches:
            names, scores = [], [np.zeros(0)]
            for texts in _batches(batch.column(at).to_pylist()):
                found, own = classify(texts, shared.value)
                names += found
                scores.append(own)
            added = [pa.array(names, pa.string()), pa.array(np.concatenate(scores), pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*kept, "lang_pred", "score"])

    plain = docs.select(*kept)
    added = StructType().add("lang_pred", "string").add("score", "double")
    return plain.mapInArrow(score, StructType(plain.schema.fields + added.fields))
