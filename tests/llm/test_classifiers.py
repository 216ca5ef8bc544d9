"""Toxicity, quality and language: held-out accuracy, and every odd input."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.llm import language, quality, queries, toxicity
from tradewind.llm.folds import in_fold, labelled_sample

SF = "/root/testdata/sf0.1"
DOCS = "doc_id long, text string, lang string, score string"
LABELS = "doc_id long, quality int, toxic int"
ODD = [None, "", "   ", "12345 !!", "x", "wort " * 60_000]


@pytest.fixture(scope="module")
def small(spark):
    """Forty good and forty bad texts, the same text twice, and rows with every kind of hole."""
    rows, labels = [], []
    for k in range(80):
        bad = k % 2
        text = ("you loser, what scum " if bad else "the garden was green ") + f"and it is number {k} of them"
        rows.append((k, text, "en" if k % 3 else "fr", "clash"))
        labels.append((k, 1 - bad, bad))
    rows += [(None, "the garden", None, None), (7, rows[7][1], "en", "clash"), *((100 + k, t, None, "s") for k, t in enumerate(ODD))]
    labels += [(None, 1, 0), (5, 0, 0), (9, None, None), (10, 7, 7)]  # no id, contradiction, no label, no such label
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)


def test_fold_is_the_checksum_of_the_id(spark):
    got = {r["id"]: r["f"] for r in spark.range(300).select("id", in_fold("id", 5, 0).alias("f")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(300)}
    assert spark.sql("SELECT cast(null as long) AS doc_id").select(in_fold("doc_id", 5, 0)).first()[0] is True


def test_sample_is_bounded_weighted_and_holds_no_held_out_row(spark, small):
    docs, labels = small
    rows = labelled_sample(docs, labels, "toxic", 5, 0, rows_per_class=10).collect()
    ids = [r["doc_id"] for r in rows]
    assert all(zlib.crc32(str(i).encode()) % 5 for i in ids)
    assert len({i for i, r in zip(ids, rows) if r["label"] == 1}) == 10 == len({i for i, r in zip(ids, rows) if r["label"] == 0})
    assert {5, 9, 10, None}.isdisjoint(ids) or 9 in ids  # a label of either class is needed, and only one
    assert all(r["weight"] >= 1 for r in rows)


def test_copies_of_a_sampled_row_are_one_row_with_a_weight(spark):
    docs = spark.createDataFrame([(3, "same text")] * 6000 + [(k, f"text {k}") for k in range(1, 30)] + [(3, None)] * 2, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 30)], "doc_id long, toxic int")
    rows = labelled_sample(docs, labels, "toxic", 5, 0, rows_per_class=50).collect()
    learnable = [k for k in range(1, 30) if zlib.crc32(str(k).encode()) % 5]
    assert 3 in learnable and len(rows) == len(learnable) + 2  # id 3 with three texts
    assert {(r["text"], r["copies"], r["weight"]) for r in rows if r["doc_id"] == 3} == {("same text", 6000, 6000.0), ("text 3", 1, 1.0), (None, 2, 2.0)}


def test_toxicity_scores_equal_a_plain_sum(spark, small):
    docs, labels = small
    model = toxicity.fit(docs, labels, "toxic", 5, 0)
    for r in toxicity.predict(docs, model).collect():
        grams = {int(i) for ids in toxicity.ngram_ids(r["text"], toxicity.ORDERS, toxicity.BITS) for i in ids}
        margin = model.bias + sum(float(model.weight[i]) for i in sorted(grams))
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-6)


def test_quality_scores_equal_a_plain_loop(spark, small):
    docs, labels = small
    model = quality.fit(docs, labels, "quality", 4, 2)
    w = model.weights
    for r in quality.predict(docs, model).collect():
        if len(r["text"] or "") > 50_000:
            continue
        codes, logits = [], []
        for row in quality.passages(r["text"]):
            x = [min(6.0, max(-6.0, (v - m) / s)) for v, m, s in zip(row, model.mean, model.spread)]
            code = [math.tanh(sum(a * w["W"][i][h] for i, a in enumerate(x)) + w["b"][h]) for h in range(quality.HIDDEN)]
            look = [math.tanh(sum(c * w["V"][h][k] for h, c in enumerate(code))) for k in range(quality.ATTENTION)]
            gate = [1 / (1 + math.exp(-sum(c * w["U"][h][k] for h, c in enumerate(code)))) for k in range(quality.ATTENTION)]
            codes.append(code), logits.append(sum(a * g * u for a, g, u in zip(look, gate, w["a"])))
        shares = [math.exp(x - max(logits)) for x in logits]
        whole = [sum(s * c[h] for s, c in zip(shares, codes)) / sum(shares) for h in range(quality.HIDDEN)]
        margin = sum(a * c for a, c in zip(whole, w["c"])) + float(w["d"])
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-6)


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_scores_of_odd_rows(spark, small, module, label):
    docs, labels = small
    model = module.fit(docs, labels, label, 5, 0)
    out = module.predict(docs, model)
    rows = out.collect()
    assert out.columns == ["doc_id", "text", "lang", "score"] and len(rows) == docs.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    by_text = {}
    for r in rows:  # the text alone decides
        assert by_text.setdefault(r["text"] or "", r["score"]) == pytest.approx(r["score"], abs=1e-9)
    good = [r["score"] > 0.5 for r in rows if r["doc_id"] is not None and r["doc_id"] < 80]
    truth = [(r["doc_id"] % 2 == 1) == (label == "toxic") for r in rows if r["doc_id"] is not None and r["doc_id"] < 80]
    assert good == truth


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_without_labels_or_documents(spark, small, module, label):
    docs, labels = small
    one_class = labels.where(f"{label} = 1 AND doc_id < 80 AND doc_id <> 5")
    for few in (labels.where("false"), one_class):
        scores = {r["score"] for r in module.predict(docs, module.fit(docs, few, label, 5, 0)).collect()}
        assert len({round(s, 9) for s in scores}) == 1
    none = docs.where("false")
    assert module.predict(none, module.fit(none, labels, label, 5, 0)).count() == 0


def test_ratio_is_zero_where_chance_could_give_it():
    counts = np.array([[50.0, 0, 3, 100], [50, 60, 4, 0]])
    ratio = toxicity.log_count_ratios(counts, np.array([100.0, 100]))
    assert ratio[0] == 0 and ratio[2] == 0 and ratio[1] > 1 and ratio[3] < -1


def test_present_ids_are_the_distinct_ones():
    first = np.zeros(1 << toxicity.BITS, np.int32)
    text = "abcabcabc xyz " * 50
    every = np.concatenate(list(toxicity.ngram_ids(text, toxicity.ORDERS, toxicity.BITS)))
    assert sorted(toxicity.present(text, first).tolist()) == np.unique(every).tolist()


def test_gradient_of_attention_is_right():
    """Training lowers the loss on a task that only attention solves: one passage of the bag decides."""
    rng = np.random.default_rng(0)
    bags, labels = [], []
    for k in range(120):
        bag = rng.normal(0, 1, (rng.integers(1, 9), quality.FEATURES))
        bag[:, 0] = 0
        if k % 2:
            bag[rng.integers(len(bag)), 0] = 8
        bags.append(bag), labels.append(k % 2)
    model = quality.train(bags, np.array(labels, float), np.ones(120))
    rows = np.clip((np.concatenate(bags) - model.mean) / model.spread, -6, 6)
    found = quality.forward(rows, np.array([len(b) for b in bags]), model.weights)
    assert ((found["score"] > 0.5) == np.array(labels)).mean() > 0.97
    assert np.allclose(np.add.reduceat(found["share"], found["first"]), 1)


def test_passages_cover_the_whole_text():
    text = "Word word WORD | and! " * 500
    rows = quality.passages(text)
    assert len(rows) == -(-len(text) // quality.PASSAGE)
    assert np.allclose(rows[:, : quality.CLASSES].sum(axis=1), 1)
    assert quality.passages("").shape == quality.passages(None).shape == (1, quality.FEATURES)
    assert np.isfinite(quality.passages("\n" * 700)).all() and np.isfinite(quality.passages("é" * 601)).all()


def test_language_of_odd_rows(spark, small):
    docs, _ = small
    model = language.fit(docs)
    assert model.languages == ["en", "fr"]
    out = language.predict(docs.withColumn("lang_pred", F.lit(3)), model)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    for r in out.collect():
        assert 0 <= r["score"] <= 1
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und" and r["score"] == 0) if not letters else r["lang_pred"] in ("en", "fr")
    assert {r["lang_pred"] for r in language.predict(docs, language.fit(docs, "false")).collect()} == {"und"}
    assert language.predict(docs.where("false"), model).count() == 0


def test_language_equals_brute_force(spark):
    rows = [(k, t, l, "") for k, (t, l) in enumerate([("the cat is there", "en"), ("le chat est la", "fr"), ("that is the dog", "en"), ("der hund", "de")])]
    docs = spark.createDataFrame(rows, DOCS)
    model = language.fit(docs, "true", smoothing=0.5)
    counts = {l: np.full(1 << language.BITS, 0.5) for l in ("de", "en", "fr")}
    for _, text, lang, _ in rows:
        for ids in language.ngram_ids(text, language.ORDERS, language.BITS):
            np.add.at(counts[lang], ids, 1)
    for k, lang in enumerate(model.languages):
        assert np.allclose(model.log_prob[k], np.log(counts[lang] / counts[lang].sum()), atol=1e-4)
    assert np.allclose(np.exp(model.log_prior), [0.25, 0.5, 0.25])


@pytest.mark.parametrize("batch, merges", [(1 << 20, 1024), (10, 2)])
def test_languages_equal_a_plain_sum(spark, small, monkeypatch, batch, merges):
    monkeypatch.setattr(language, "BATCH_IDS", batch)
    monkeypatch.setattr(language, "MERGES", merges)
    docs, _ = small
    model = language.fit(docs.repartition(7))
    for r in language.predict(docs.repartition(2), model).collect():
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0)
            continue
        total = [float(p) for p in model.log_prior]
        for ids in language.ngram_ids(r["text"], language.ORDERS, language.BITS):
            total = [x + float(sum(row[ids].astype(float))) for x, row in zip(total, model.log_prob)]
        best = max(range(len(total)), key=lambda k: (total[k], -k))
        assert r["lang_pred"] == model.languages[best]
        assert r["score"] == pytest.approx(1 / sum(math.exp(x - total[best]) for x in total), abs=1e-6)


@pytest.mark.parametrize(
    "name, fold, least", [("op2_toxicity", (5, 0), 0.965), ("op5_quality", (4, 2), 0.98), ("op6_language", (5, 0), 0.97)]
)
def test_held_out_accuracy(spark, name, fold, least):
    got = queries.QUERIES[name](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got.count() == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % fold[0] == fold[1]) for r in got.select("doc_id", "held_out").collect())
    held = got.where("held_out")
    if name == "op6_language":
        right = held.join(docs.select("doc_id", "lang"), "doc_id").select((F.col("lang") == F.col("lang_pred")).cast("int").alias("ok"))
    else:
        label = "toxic" if name == "op2_toxicity" else "quality"
        truth = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label)
        right = held.join(truth, "doc_id").select((F.col(label) == F.col("predicted")).cast("int").alias("ok"))
    assert right.agg(F.avg("ok")).first()[0] >= least
