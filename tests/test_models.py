import dataclasses
import random
from collections import Counter

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tests.domain import ts
from tradewind.plans import features as ft
from tradewind.plans import metrics as mt
from tradewind.plans import training as tr
from tradewind.sources.layers import publish, published

EXTRACT = (
    "customer_state string, seller_state string, price double, freight_value double, product_weight_g double, "
    "product_category_name_english string, order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp"
)
SMALL = tr.ModelSettings(logreg_iterations=20, forest_trees=5, forest_depth=3, boosting_rounds=3)


@pytest.fixture(scope="module")
def extract(spark):
    rng = random.Random(11)
    data = []
    for _ in range(400):
        late = rng.random() < 0.3
        day = rng.randrange(12, 28) if late else rng.randrange(1, 11)
        data.append((rng.choice(["SP", "RJ", "AC"]), rng.choice(["SP", "MG"]), rng.uniform(1, 90) + (60 if late else 0),
                     rng.uniform(0, 9), rng.choice([None, 10.0, 20.0, 30.0, 40.0]), rng.choice(["bed", "toys"]),
                     ts(f"2018-01-{day:02d} 12:00"), ts("2018-01-11 00:00")))
    data.append(("SP", "SP", 1.0, 1.0, 1.0, "bed", ts("2018-01-11 00:00"), None))
    return spark.createDataFrame(data, EXTRACT)


def scored(spark, n=300, ties=7):
    rng = random.Random(13)
    data = []
    for _ in range(n):
        label = int(rng.random() < 0.4)
        score = round(rng.random() * 0.7 + 0.2 * label, 1 if ties else 6)
        data.append((label, score, int(score > 0.5)))
    return spark.createDataFrame(data, "label int, score double, pred int")


def test_features(extract):
    base, plain, leaky = ft.features_base(extract), ft.features_enhanced(extract), ft.features_enhanced(extract, leak=True)
    full = extract.where("product_weight_g is not null").count()
    assert base.count() == plain.count() == leaky.count() == full
    assert "delay_days" not in base.columns + plain.columns and "delay_days" in leaky.columns
    assert leaky.where("delay_days = 0 and is_late = 0 and price = 1.0").count() == 1
    assert leaky.where("is_late <> cast(delay_days > 0 as int)").count() == 0


def test_encoding_and_scaling(extract):
    base = ft.features_base(extract)
    coded = ft.label_encode(base)
    assert sorted({(a.customer_state, b.customer_state) for a, b in zip(base.collect(), coded.collect())}) == [
        ("AC", 0), ("RJ", 1), ("SP", 2)]
    scaled = ft.standardize(base)
    for c in ft.feature_names(base):
        mean, deviation = scaled.agg(F.avg(c), F.stddev_pop(c)).first()
        assert abs(mean) < 1e-9 and abs(deviation - 1) < 1e-9
    constant = ft.standardize(base.withColumn("price", F.lit(3.0)))
    assert constant.agg(F.max(F.abs("price"))).first()[0] == 0.0


@pytest.mark.parametrize("buckets", [1, 4, 65_536])
def test_split_is_exact_and_repeatable(spark, buckets):
    data = [(float(i % 37), i % 3, int(i % 5 == 0)) for i in range(500)] + [(0.5, 9, 0)] * 300 + [(0.5, 9, 1)]
    df = spark.createDataFrame(data, "x double, k int, is_late int")
    split = ft.stratified_split(df, buckets=buckets)
    counts = {(r.is_late, r.split): r["count"] for r in split.groupBy("is_late", "split").count().collect()}
    for label in (0, 1):
        n = sum(1 for r in data if r[2] == label)
        assert counts[label, "train"] == round(0.8 * n) and counts[label, "test"] == n - round(0.8 * n)
    assert Counter(map(tuple, split.drop("split").collect())) == Counter(map(tuple, df.collect()))
    again = ft.stratified_split(df.repartition(3, "x"), buckets=buckets)
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, split.collect()))
    assert Counter(map(tuple, ft.stratified_split(df, seed=7, buckets=buckets).collect())) != Counter(map(tuple, split.collect()))


@pytest.mark.parametrize("one_task_rows", [3, 10_000])
def test_auc_equals_the_evaluator(spark, one_task_rows):
    for ties in (0, 7):
        df = scored(spark, ties=ties)
        expect = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(df)
        assert mt.roc_auc(df, "label", "score", one_task_rows).first().auc == pytest.approx(expect, abs=1e-12)
    assert mt.roc_auc(df.where("label = 1"), "label", "score").first().auc is None


@pytest.mark.parametrize("one_task_rows", [3, 10_000])
def test_roc_curve(spark, one_task_rows):
    df = scored(spark)
    points = sorted(mt.roc_curve(df, "label", "score", one_task_rows).collect(), key=lambda r: -r.threshold)
    assert tuple(points[0]) == (float("inf"), 0.0, 0.0) and tuple(points[-1])[1:] == (1.0, 1.0)
    data = df.collect()
    for p in points:
        assert p.tpr == sum(r.label == 1 and r.score >= p.threshold for r in data) / sum(r.label == 1 for r in data)
        assert p.fpr == sum(r.label == 0 and r.score >= p.threshold for r in data) / sum(r.label == 0 for r in data)
    area = sum((b.fpr - a.fpr) * (a.tpr + b.tpr) / 2 for a, b in zip(points, points[1:]))
    assert mt.roc_auc(df, "label", "score").first().auc == pytest.approx(area, abs=1e-12)


def test_threshold_metrics(spark):
    df = spark.createDataFrame([(1, 1)] * 3 + [(0, 1)] * 1 + [(1, 0)] * 2 + [(0, 0)] * 4, "label int, pred int")
    assert tuple(mt.binary_metrics(df, "label", "pred").first()) == (0.7, 0.75, 0.6, pytest.approx(2 / 3))
    assert sorted(map(tuple, mt.confusion_matrix(df, "label", "pred").collect())) == [(0, 0, 4), (0, 1, 1), (1, 0, 2), (1, 1, 3)]
    never = df.where("pred = 0 and label = 0")
    assert tuple(mt.binary_metrics(never, "label", "pred").first()) == (1.0, 0.0, 0.0, 0.0)
    assert sorted(map(tuple, mt.class_balance(never, "label").collect())) == [(0, "On Time (0)", 4), (1, "Late (1)", 0)]


def test_correlations_and_kpis(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0), (2.0, 4.0, 0), (3.0, 6.0, 1)], "a double, delay_days double, is_late int")
    got = {(r.feature_a, r.feature_b): r.correlation for r in mt.correlation_pairs(df, ["a", "delay_days"]).collect()}
    assert set(got) == {("a", "a"), ("a", "delay_days"), ("delay_days", "delay_days")} and got["a", "delay_days"] == pytest.approx(1)
    flat = mt.correlation_pairs(df.withColumn("c", F.lit(5.0)), ["a", "c"]).collect()
    assert [(r.feature_b, r.correlation is None) for r in flat] == [("a", False), ("c", True), ("c", True)]
    assert tuple(mt.data_kpis(df).first()) == (3, pytest.approx(100 / 3), 4.0)
    assert [r.correlation for r in mt.correlation_pairs(df.where("a = 1"), ["a"]).collect()] == [None]


def test_correlations_of_many_columns(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    data = rng.normal(size=(300, 200)) + 1000
    data[:, 1] = data[:, 0] * 2 + rng.normal(size=300)
    data[:, 7] = 5.0
    names = [f"c{k}" for k in range(200)]
    df = spark.createDataFrame([tuple(map(float, row)) for row in data] + [(None,) * 200], ", ".join(f"{n} double" for n in names))
    got = {(r.feature_a, r.feature_b): r.correlation for r in mt.correlation_pairs(df, names).collect()}
    with np.errstate(all="ignore"):
        expect = np.corrcoef(data.T)
    assert len(got) == 200 * 201 // 2
    for i in range(200):
        for j in range(i, 200):
            value = got[names[i], names[j]]
            assert value is None if 7 in (i, j) else abs(value - expect[i, j]) < 1e-9


def test_training(spark, extract, tmp_path):
    trained = tr.train_models(ft.features_enhanced(extract), settings=SMALL)
    comparison = tr.model_comparison(trained)
    got = comparison.collect()
    assert [r.model for r in got] == list(tr.ALL_MODELS)
    assert all(0.6 < r.auc <= 1 and 0 <= r.f1 <= 1 and r.train_time > 0 for r in got)
    best = mt.best_model(comparison).first()
    assert best.auc == max(r.auc for r in got)
    importances = tr.model_importances(spark, trained).collect()
    assert {r.model for r in importances} == {tr.FOREST, tr.BOOSTING} and len(importances) == 12
    assert sum(r.importance for r in importances if r.model == tr.FOREST) == pytest.approx(1)
    assert tr.model_confusion(trained).count() == 12 and tr.model_roc(trained).count() > 6

    tr.save_models(trained, str(tmp_path))
    features = ft.features_enhanced(extract)
    saved = tr.load_models(spark.newSession(), str(tmp_path))
    assert set(saved.models) == set(tr.ALL_MODELS)
    facts = tr.saved_score_facts(trained, saved, features).collect()
    assert len(facts) == 6 and all(r.different == 0 and r.rows > 0 for r in facts)
    scored = tr.score_table(saved, tr.BOOSTING, features.drop("is_late"))
    assert scored.columns == [*features.drop("is_late").columns, "prediction", "score"] and scored.count() == features.count()
    unseen = tr.score_table(saved, tr.FOREST, features.withColumn("customer_state", F.lit("never seen")))
    assert unseen.where("score BETWEEN 0 AND 1").count() == features.count()
    other = dict(saved.models) | {tr.FOREST: trained.models[tr.BOOSTING]}
    wrong = tr.saved_score_facts(trained, tr.SavedModels(saved.preparation, other), features).collect()
    assert sum(r.different for r in wrong if r.model == tr.FOREST) > 0
    with pytest.raises(ValueError):
        tr.load_models(spark, str(tmp_path / "none"))

    # Facts that hold for fitted models, and fail for shuffled labels, random scores and wrong rows.
    best = mt.best_model(comparison)
    assert all(abs(r.gradient) < 5e-4 for r in tr.logreg_gradient(trained).collect())
    deep = tr.train_models(ft.features_enhanced(extract), [tr.FOREST], tr.ModelSettings(forest_trees=30, forest_depth=8))
    assert [(r.model, r.beats_features) for r in tr.tree_facts(deep).collect()] == [(tr.FOREST, True)]
    assert {r.model: r.beats_features for r in tr.tree_facts(trained).collect()}[tr.BOOSTING]
    assert tuple(tr.boosting_loss(trained).first()) == (3, 0, True)
    gaps = tr.comparison_facts(trained, comparison).collect()
    assert len(gaps) == 3 and all(abs(r[c]) < 1e-12 for r in gaps for c in r.asDict() if c.endswith("_gap"))
    assert tuple(tr.best_facts(trained, best).first()) == (3, 0)
    shuffled = trained.train.withColumn("label", (F.rand(5) < 0.3).cast("double"))
    elsewhere = dataclasses.replace(trained, train=shuffled.persist())
    assert any(abs(r.gradient) > 5e-3 for r in tr.logreg_gradient(elsewhere).collect())
    assert not tr.boosting_loss(elsewhere).first().below_constant
    random_scores = {n: p.withColumn("score", F.rand(7)).withColumn("prediction", (F.rand(9) < 0.5).cast("int")).persist() for n, p in trained.predictions.items()}
    guessed = dataclasses.replace(trained, predictions=random_scores)
    assert any(abs(r.auc_gap) > 1e-6 and abs(r.acc_gap) > 1e-6 for r in tr.comparison_facts(guessed, comparison).collect())
    worst = comparison.orderBy("auc").limit(1)
    assert tr.best_facts(trained, worst).first().beaten_by > 0
    assert not tr.tree_facts(dataclasses.replace(deep, train=shuffled)).first().beats_features


def test_a_leaked_delay_gives_the_label_away(extract):
    trained = tr.train_models(ft.features_enhanced(extract, leak=True), [tr.FOREST], SMALL)
    assert tr.model_metrics(trained, tr.FOREST).first().auc > 0.99


def test_best_model_takes_the_first_on_ties(spark):
    df = spark.createDataFrame([(1, "b", 0.7), (0, "a", 0.7), (2, "c", 0.1)], "position int, model string, auc double")
    assert mt.best_model(df).first().model == "a"


def test_stored_extract_follows_the_commerce_table(spark, extract, tmp_path):
    wrangled, models = str(tmp_path / "wrangled"), str(tmp_path / "models")
    with pytest.raises(ValueError):
        ft.stored_extract(spark, models, wrangled)
    publish(extract.withColumn("other", F.lit(1)), wrangled, "commerce")
    assert ft.stored_extract(spark, models, wrangled).count() == 401
    first = published(spark, models, "ml_extract")
    assert ft.stored_extract(spark, models, wrangled).count() == 401
    assert published(spark, models, "ml_extract") == first, "unchanged files do not build it again"
    publish(extract.orderBy("price").limit(5), wrangled, "commerce")
    assert ft.stored_extract(spark, models, wrangled).count() == 5
    assert published(spark, models, "ml_extract") != first
    assert ft.stored_extract(spark, models, str(tmp_path / "gone")).count() == 5


@pytest.mark.parametrize("buckets, one_task_rows", [(3, 1), (3, 10), (2, 40)])
def test_the_bucket_with_the_cut_is_hashed_again(spark, buckets, one_task_rows, monkeypatch):
    data = [(float(i % 97), i, int(i % 4 == 0)) for i in range(900)] + [(0.5, -1, 0)] * 400 + [(0.5, -1, 1)] * 3
    df = spark.createDataFrame(data, "x double, k int, is_late int")
    ranked = []
    packed = ft.stored
    monkeypatch.setattr(ft, "stored", lambda rows: ranked.append(packed(rows)) or ranked[-1])
    split = ft.stratified_split(df, buckets=buckets, one_task_rows=one_task_rows)
    counts = {(r.is_late, r.split): r["count"] for r in split.groupBy("is_late", "split").count().collect()}
    for label in (0, 1):
        n = sum(1 for r in data if r[2] == label)
        assert counts[label, "train"] == round(0.8 * n) and counts[label, "test"] == n - round(0.8 * n)
    assert Counter(map(tuple, split.drop("split").collect())) == Counter(map(tuple, df.collect()))
    assert len(ranked) > 2, "several turns"
    assert all(r["count"] <= one_task_rows for r in ranked[-1].groupBy("is_late").count().collect())
    again = ft.stratified_split(df.repartition(5, "x"), buckets=buckets, one_task_rows=one_task_rows)
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, split.collect()))


def test_split_keeps_rows_without_a_label(spark):
    rows = [(k % 50, None if k % 3 == 0 else k % 2) for k in range(300)]
    split = ft.stratified_split(spark.createDataFrame(rows, "x int, is_late int"), buckets=4)
    counts = {(r["is_late"], r["split"]): r["n"] for r in split.groupBy("is_late", "split").agg(F.count("*").alias("n")).collect()}
    assert sum(counts.values()) == 300
    assert counts[None, "train"] == 80 and counts[None, "test"] == 20


def test_train_rows_lie_in_even_parts_and_keep_their_values(spark, extract, monkeypatch):
    monkeypatch.setattr(tr, "TASK_ROWS", 20)
    trained = tr.train_models(ft.features_base(extract), (tr.FOREST,), SMALL)
    sizes = [r["count"] for r in trained.train.groupBy(F.input_file_name()).count().collect()]
    n = sum(sizes)
    assert len(sizes) >= n // 20 and max(sizes) <= 25  # as many parts as the rows ask for, not what files happen to be there
    assert n == trained.train.count() and n + trained.predictions[tr.FOREST].count() == ft.features_base(extract).count()
    forest = trained.models[tr.FOREST]
    assert forest.getNumTrees == SMALL.forest_trees and forest.getOrDefault("maxDepth") == SMALL.forest_depth
    assert forest.getOrDefault("subsamplingRate") == 1.0 and forest.getOrDefault("maxBins") == 32


def test_large_forests_are_fitted_a_few_trees_at_a_time(spark, extract, tmp_path, monkeypatch):
    fits, real = [], tr.RandomForestClassifier.fit
    monkeypatch.setattr(tr.RandomForestClassifier, "fit", lambda own, *a: fits.append((own.getNumTrees(), own.getSeed())) or real(own, *a))
    features = ft.features_enhanced(extract)
    whole = tr.train_models(features, [tr.FOREST], SMALL).models[tr.FOREST]
    assert fits == [(5, tr.SEED)] and whole.getNumTrees == 5  # few rows: all at once
    monkeypatch.setattr(tr, "FOREST_BYTES", 1)
    monkeypatch.setattr(tr, "FEWEST_TREES", 2)
    trained = tr.train_models(features, [tr.FOREST], SMALL)
    forest = trained.models[tr.FOREST]
    assert [n for n, _ in fits[1:]] == [2, 2, 1] and len({seed for _, seed in fits[1:]}) == 3
    assert forest.getNumTrees == 5 and len(forest.trees) == 5 and len(forest.treeWeights) == 5
    assert len({t.toDebugString.split("\n", 1)[1] for t in forest.trees}) == 5
    assert forest.numFeatures == whole.numFeatures == 6 and forest.numClasses == 2
    assert forest.getOrDefault("maxDepth") == SMALL.forest_depth and forest.getFeaturesCol() == "features"
    assert sum(forest.featureImportances) == pytest.approx(1)
    rows = forest.transform(trained.train).select("features", "probability").take(20)
    for r in rows:  # every tree has one vote, of its own shares of the classes
        votes = [t.predictProbability(r.features)[1] for t in forest.trees]
        assert r.probability[1] == pytest.approx(sum(votes) / 5)
    tr.save_models(trained, str(tmp_path))
    facts = tr.saved_score_facts(trained, tr.load_models(spark, str(tmp_path)), features).collect()
    assert {(r.model, r.different) for r in facts} == {(tr.FOREST, 0)}
    assert sum(r["rows"] for r in facts) == features.count()
    (fact,) = tr.tree_facts(trained).collect()
    assert fact.train_rows == trained.train.agg(F.sum(tr.COPIES)).first()[0]


def test_copies_are_weights(spark, extract):
    many = extract.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(5)))).drop("again")
    trained = tr.train_models(ft.features_enhanced(many), settings=SMALL)
    rows, seen = ft.features_enhanced(many).count(), trained.train.agg(F.count("*"), F.sum(tr.COPIES)).first()
    assert seen[0] <= rows // 5 + 2 and seen[1] + trained.predictions[tr.FOREST].count() == rows  # the cut may lie inside a group
    assert all(abs(r.gradient) < 5e-4 and r.train_rows == seen[1] for r in tr.logreg_gradient(trained).collect())
    one_by_one = tr.unpack_copies(trained.train, most=5).withColumn(tr.COPIES, F.lit(1).cast("bigint"))
    expanded = dataclasses.replace(trained, train=one_by_one.persist())
    for facts in (tr.tree_facts, tr.boosting_loss, lambda t: tr.mean_train_score(t, tr.LOGREG)):
        for a, b in zip(facts(trained).collect(), facts(expanded).collect()):
            assert tuple(a)[:-1] == tuple(b)[:-1] and tuple(a)[-1] == pytest.approx(tuple(b)[-1], abs=1e-12)
    plain = tr.GBTClassifier(maxIter=3, maxDepth=3, stepSize=0.1, seed=tr.SEED).fit(one_by_one)
    weighed = trained.models[tr.BOOSTING]
    assert plain.evaluateEachIteration(one_by_one) == pytest.approx(weighed.evaluateEachIteration(trained.train), abs=1e-3)


def test_a_query_fits_only_the_models_it_needs(spark, extract, monkeypatch):
    from tradewind_queries import queries as q

    made = []
    monkeypatch.setattr(tr, "_estimator", lambda name, settings, rows, real=tr._estimator: made.append(name) or real(name, SMALL, rows))
    monkeypatch.setattr(q, "extract", lambda spark, sf_dir: extract)
    folder = "test_a_query_fits_only_the_models_it_needs"
    q.ml_logreg_gradient(spark, folder)
    assert made == [tr.LOGREG]
    q.ml_importance_facts(spark, folder), q.ml_tree_facts(spark, folder)
    assert sorted(made) == sorted(tr.ALL_MODELS)
    assert q.ml_model_comparison(spark, folder).count() == 3 and len(made) == 3
