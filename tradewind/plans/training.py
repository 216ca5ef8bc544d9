"""Late-delivery models: fit, score, compare, save."""

from __future__ import annotations

import math
import time
from collections.abc import Sequence
from functools import partial
from dataclasses import dataclass, field, replace

from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.base import Model
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tradewind.operators.copies import COPIES, pack_copies, unpack_copies
from tradewind.plans.features import LABEL, feature_names, preparation, stratified_split
from tradewind.plans.metrics import binary_metrics, confusion_matrix, feature_importance, roc_auc, roc_curve
from tradewind.session import run_together, stored
from tradewind.sources import files

# Names and settings of the models.
LOGREG, FOREST, BOOSTING = "Logistic Regression", "Random Forest", "Gradient Boosting"
BASE_MODELS = (LOGREG, FOREST)
ALL_MODELS = (LOGREG, FOREST, BOOSTING)
SEED = 42
TASK_ROWS = 1_000_000  # train rows that a task should hold at most
FOREST_MB = 16  # counts of the nodes that a task splits together
FOREST_BYTES = 256 << 20  # draws and nodes of the train rows in the trees that are fitted together ...
FEWEST_TREES = 20  # ... but so many trees at least: a row then takes less than what was read for it
TREE_ROW_BYTES = 8  # a row's draw and its node in one tree
SEED_STEP = 1_000_003  # Spark adds the number of a part of the rows to a seed


@dataclass(frozen=True)
class ModelSettings:
    """Defaults are the full-size models; smaller ones are for trial runs."""

    logreg_iterations: int = 1000
    forest_trees: int = 200
    forest_depth: int = 10
    boosting_rounds: int = 100
    boosting_depth: int = 3
    boosting_step: float = 0.1


@dataclass(frozen=True)
class ModelRows:
    """What all fits share: the preparation, and the encoded rows of both parts, equal ones as one row with a count."""

    preparation: PipelineModel
    train: DataFrame
    test: DataFrame
    train_rows: int
    distinct_rows: int
    most_copies: int
    names: list[str]


@dataclass
class TrainedModels:
    """``train`` has (features, label) once, with the number of its copies; ``predictions`` have every test row."""

    preparation: PipelineModel
    models: dict[str, Model]
    predictions: dict[str, DataFrame]
    train: DataFrame
    seconds: dict[str, float]
    names: list[str] = field(default_factory=list)


def _estimator(name: str, settings: ModelSettings, train_rows: int):
    columns = {"featuresCol": "features", "labelCol": "label", "weightCol": COPIES}
    if name == LOGREG:
        # An L2 penalty of weight 1 on the summed loss is 1/n on Spark's mean loss.
        return LogisticRegression(
            maxIter=settings.logreg_iterations,
            regParam=1.0 / train_rows,
            elasticNetParam=0.0,
            standardization=False,
            **columns,
        )
    if name == FOREST:
        return RandomForestClassifier(
            numTrees=settings.forest_trees,
            maxDepth=settings.forest_depth,
            seed=SEED,
            # How it is fitted, not what: the node of a row is remembered for each tree instead of looked up from
            # the root, and the counts of the nodes that are split together stay near the processor.
            cacheNodeIds=True,
            maxMemoryInMB=FOREST_MB,
            **columns,
        )
    return GBTClassifier(
        maxIter=settings.boosting_rounds,
        maxDepth=settings.boosting_depth,
        stepSize=settings.boosting_step,
        seed=SEED,
        **columns,
    )


def model_rows(features: DataFrame) -> ModelRows:
    """Prepare on all rows and split 80/20 per class.

    Equal rows (orders come once for each payment and review) are one row with a count from here on. The fits take the
    count as a weight: the loss of a regression or of boosting is the same as that of the rows one by one; a
    tree of the forest draws a row with all its copies.
    """
    names = feature_names(features)
    # The fits below read these rows many times: cut the lineage of joins once, in shared storage.
    packed = stored(pack_copies(features))
    most = packed.agg(F.max(COPIES)).first()[0] or 1
    every = unpack_copies(packed, most=most)
    prepared = preparation(every).fit(every)
    split = stored(stratified_split(packed))
    ready = prepared.transform(split).select("features", F.col(LABEL).cast("double").alias("label"), COPIES, "split")
    train, test = ready.where("split = 'train'").drop("split"), ready.where("split = 'test'").drop("split")
    distinct, train_rows = train.agg(F.count(F.lit(1)), F.sum(COPIES)).first()
    # Every fit reads these rows many times: encoded once, in parts of the same size for all cores.
    cores = features.sparkSession.sparkContext.defaultParallelism
    train = stored(train.repartition(max(cores, math.ceil(distinct / TASK_ROWS))))
    return ModelRows(prepared, train, test, train_rows or 0, distinct, most, names)


def _fitted(estimator, rows: ModelRows) -> Model:
    """``estimator`` fitted on the train rows; a forest in groups of trees, if these rows are many.

    Spark stores a draw and a node of each row for all trees that it fits together, and writes the nodes anew in each pass.
    Trees do not know of each other, so a forest is as good when some are fitted after the others.
    """
    if not isinstance(estimator, RandomForestClassifier):
        return estimator.fit(rows.train)
    trees = estimator.getNumTrees()
    together = max(FEWEST_TREES, FOREST_BYTES // (TREE_ROW_BYTES * max(1, rows.distinct_rows)))
    groups = math.ceil(trees / together)
    if groups <= 1:
        return estimator.fit(rows.train)
    sizes = [trees // groups + (i < trees % groups) for i in range(groups)]
    settings = [{estimator.numTrees: size, estimator.seed: SEED + i * SEED_STEP} for i, size in enumerate(sizes)]
    return _one_forest(estimator, [estimator.copy(own).fit(rows.train) for own in settings])


def _one_forest(estimator: RandomForestClassifier, parts: Sequence[RandomForestClassificationModel]) -> RandomForestClassificationModel:
    """The trees of all ``parts`` as the model that ``estimator`` would have made."""
    first, context = parts[0]._java_obj, SparkContext._active_spark_context
    ml = context._jvm.org.apache.spark.ml
    found = [tree for part in parts for tree in part._java_obj.trees()]
    trees = context._gateway.new_array(ml.classification.DecisionTreeClassificationModel, len(found))
    for i, tree in enumerate(found):
        trees[i] = tree
    whole = ml.classification.RandomForestClassificationModel(first.uid(), trees, first.numFeatures(), first.numClasses())
    first.copyValues(whole, ml.param.ParamMap.empty())
    whole.set("numTrees", len(found))  # saved models are checked against it
    return estimator._copyValues(RandomForestClassificationModel(whole))


def fit_models(
    rows: ModelRows, which: Sequence[str] = ALL_MODELS, settings: ModelSettings = ModelSettings()
) -> TrainedModels:
    """Fit each model on the train part, score the test part. The fits run side by side, for most of their jobs are short."""

    def fit(name: str):
        started = time.monotonic()
        model = _fitted(_estimator(name, settings, rows.train_rows), rows)
        seconds = time.monotonic() - started
        # Every metric reads the scores; stored, the test rows go through the trees once.
        return model, stored(unpack_copies(_scored(model, rows.test), most=rows.most_copies)), seconds

    found = dict(zip(which, run_together(rows.train.sparkSession, [partial(fit, name) for name in which])))
    models, predictions, seconds = ({name: one[i] for name, one in found.items()} for i in range(3))
    return TrainedModels(rows.preparation, models, predictions, rows.train, seconds, rows.names)


def train_models(
    features: DataFrame, which: Sequence[str] = ALL_MODELS, settings: ModelSettings = ModelSettings()
) -> TrainedModels:
    """Prepare on all rows, split 80/20 per class, fit each model on the train part, score the test part."""
    return fit_models(model_rows(features), which, settings)


def together(fits: Sequence[TrainedModels]) -> TrainedModels:
    """Models that were fitted on the same rows, as one."""
    merged = {part: {k: v for fit in fits for k, v in getattr(fit, part).items()} for part in ("models", "predictions", "seconds")}
    return replace(fits[0], **merged)


def _scored(model: Model, rows: DataFrame) -> DataFrame:
    """(label, prediction, score) and the copies of ``rows(features, label)``."""
    return model.transform(rows).select(
        F.col("label").cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("score"),
        COPIES,
    )


def model_metrics(trained: TrainedModels, name: str, position: int = 0) -> DataFrame:
    """(position, model, auc, acc, precision, recall, f1, train_time) of one model on the test part."""
    scored = trained.predictions[name]
    auc = roc_auc(scored, "label", "score").first()["auc"]
    return binary_metrics(scored, "label", "prediction").select(
        F.lit(position).alias("position"),
        F.lit(name).alias("model"),
        F.lit(auc).cast("double").alias("auc"),
        "acc",
        "precision",
        "recall",
        "f1",
        F.lit(float(trained.seconds[name])).alias("train_time"),
    )


def model_comparison(trained: TrainedModels) -> DataFrame:
    frames = [model_metrics(trained, name, i) for i, name in enumerate(trained.models)]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result.orderBy("position")


def model_importances(spark: SparkSession, trained: TrainedModels) -> DataFrame:
    """Importances of the tree models."""
    frames = [
        feature_importance(spark, name, model.featureImportances, trained.names)
        for name, model in trained.models.items()
        if name in (FOREST, BOOSTING)
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result.orderBy("model", F.desc("importance"), "feature")


def _per_model(trained: TrainedModels, one) -> DataFrame:
    result = None
    for name, scored in trained.predictions.items():
        frame = one(scored).select(F.lit(name).alias("model"), "*")
        result = frame if result is None else result.unionByName(frame)
    return result


def model_confusion(trained: TrainedModels) -> DataFrame:
    return _per_model(trained, lambda p: confusion_matrix(p, "label", "prediction"))


def model_roc(trained: TrainedModels) -> DataFrame:
    """ROC points against the true labels."""
    return _per_model(trained, lambda p: roc_curve(p, "label", "score"))


def model_facts(trained: TrainedModels) -> DataFrame:
    """(model, actual, rows, auc_gap): scored test rows per class, and the area under the stored ROC points
    by the trapezoid rule less the AUC, which both count a tie as half."""
    rows = _per_model(trained, lambda p: p.groupBy(F.col("label").alias("actual")).agg(F.count(F.lit(1)).alias("rows")))
    area = areas(trained)
    auc = _per_model(trained, lambda p: roc_auc(p, "label", "score"))
    gap = area.join(auc, "model").select("model", (F.col("area") - F.col("auc")).alias("auc_gap"))
    return rows.join(gap, "model")


def mean_train_score(trained: TrainedModels, name: str) -> DataFrame:
    """(train_rows, mean_score) of one model on the rows it was fitted on."""
    scored = _scored(trained.models[name], trained.train)
    return scored.agg(F.coalesce(F.sum(COPIES), F.lit(0)).alias("train_rows"), _mean(F.col("score")).alias("mean_score"))


def _mean(value):
    """The mean over all rows, of rows with a count of copies."""
    return F.sum(value * F.col(COPIES)) / F.nullif(F.sum(COPIES), F.lit(0))


def logreg_gradient(trained: TrainedModels) -> DataFrame:
    """(feature, train_rows, gradient): the slope of the penalised loss at the fitted coefficients, which is 0 at its minimum.

    The mean of (score - label) × feature over the train rows, plus the penalty's share; for the intercept without one.
    """
    model, rows = trained.models[LOGREG], trained.train
    off = vector_to_array("probability")[1] - F.col("label")
    x = vector_to_array("features")
    slopes = [_mean(off * x[i]).alias(f"s{i}") for i in range(len(trained.names))] + [_mean(off).alias("intercept")]
    found = model.transform(rows).agg(F.sum(COPIES).alias("rows"), *slopes).first()
    penalty = [w / found["rows"] for w in model.coefficients.toArray().tolist()]
    cells = [(name, found["rows"], found[f"s{i}"] + penalty[i]) for i, name in enumerate(trained.names)]
    cells.append(("intercept", found["rows"], found["intercept"]))
    return rows.sparkSession.createDataFrame(cells, "feature string, train_rows bigint, gradient double")


def tree_facts(trained: TrainedModels) -> DataFrame:
    """(model, train_rows, beats_features): whether a tree model orders its train rows better than every single feature does."""
    rows = trained.train
    x = vector_to_array("features")
    order = lambda scored, score: roc_auc(scored, "label", score, copies=COPIES).first()["auc"]
    singles = [rows.select("label", x[i].alias("x"), COPIES) for i in range(len(trained.names))]
    alone = run_together(rows.sparkSession, [partial(order, one, "x") for one in singles])
    best = max((max(a, 1 - a) for a in alone if a is not None), default=0.5)
    cells, train_rows = [], rows.agg(F.coalesce(F.sum(COPIES), F.lit(0))).first()[0]
    for name in (n for n in trained.models if n in (FOREST, BOOSTING)):
        auc = order(_scored(trained.models[name], rows), "score")
        cells.append((name, train_rows, auc is not None and auc > best))
    return rows.sparkSession.createDataFrame(cells, "model string, train_rows bigint, beats_features boolean")


def boosting_loss(trained: TrainedModels) -> DataFrame:
    """(rounds, rising, below_constant): in how many rounds of boosting the train loss rises, and whether the last is below the
    loss of the best constant score."""
    rows = trained.train
    losses = trained.models[BOOSTING].evaluateEachIteration(rows)
    share = rows.agg(_mean(F.col("label"))).first()[0] or 0.0
    # The loss is 2 log(1 + exp(-2 y f)), whose least constant value is twice the entropy of the labels.
    constant = -2 * sum(p * math.log(p) for p in (share, 1 - share) if p > 0)
    rising = sum(b > a + 1e-9 for a, b in zip(losses, losses[1:]))
    cells = [(len(losses), rising, bool(losses and losses[-1] < constant))]
    return rows.sparkSession.createDataFrame(cells, "rounds bigint, rising bigint, below_constant boolean")


def areas(trained: TrainedModels) -> DataFrame:
    """(model, area) under the stored ROC points, by the trapezoid rule."""
    by_rate = Window.partitionBy("model").orderBy("fpr", "tpr")
    step = (F.col("fpr") - F.lag("fpr").over(by_rate)) * (F.col("tpr") + F.lag("tpr").over(by_rate)) / 2
    return model_roc(trained).withColumn("step", step).groupBy("model").agg(F.sum("step").alias("area"))


def comparison_facts(trained: TrainedModels, comparison: DataFrame) -> DataFrame:
    """(model, test_rows, acc_gap, precision_gap, recall_gap, f1_gap, auc_gap): the comparison's figures less those that follow
    from the model's own confusion cells and ROC points."""
    cell = lambda a, p: F.sum(F.when((F.col("actual") == a) & (F.col("predicted") == p), F.col("n")))
    cells = model_confusion(trained).groupBy("model").agg(
        cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), F.sum("n").alias("test_rows"), cell(0, 0).alias("tn")
    )
    ratio = lambda a, b: F.coalesce(F.expr(f"({a}) / nullif({b}, 0)"), F.lit(0.0))
    expected = {
        "acc": ratio("tp + tn", "test_rows"), "precision": ratio("tp", "tp + fp"),
        "recall": ratio("tp", "tp + fn"), "f1": ratio("2 * tp", "2 * tp + fp + fn"), "auc": F.col("area"),
    }
    both = comparison.join(cells, "model").join(areas(trained), "model")
    return both.select("model", "test_rows", *[(F.col(c) - e).alias(f"{c}_gap") for c, e in expected.items()])


def best_facts(trained: TrainedModels, best: DataFrame) -> DataFrame:
    """(models, beaten_by): by how many models the best one is beaten, judged by the areas under their ROC points."""
    found = {r["model"]: r["area"] for r in areas(trained).collect()}  # one row per model
    own = found.get((best.first() or {"model": None})["model"], -1.0)
    cells = [(len(found), sum(area > own + 1e-9 for area in found.values()))]
    return best.sparkSession.createDataFrame(cells, "models bigint, beaten_by bigint")


@dataclass(frozen=True)
class SavedModels:
    """The preparation and the models of an earlier run, as they were saved."""

    preparation: PipelineModel
    models: dict[str, Model]


_SAVED = {LOGREG: LogisticRegressionModel, FOREST: RandomForestClassificationModel, BOOSTING: GBTClassificationModel}


def load_models(spark: SparkSession, base: str) -> SavedModels:
    """What ``save_models`` has put under ``base``, in this or in a later session.

    A category that the preparation has not seen gets a code of its own, after all others, when a table is scored.
    """
    base = base.rstrip("/")
    there = files.names(spark, base)
    if "preparation" not in there:
        raise ValueError(f"no saved models under {base}")
    preparation = PipelineModel.load(f"{base}/preparation")
    for stage in preparation.stages:
        if isinstance(stage, StringIndexerModel):
            stage.setHandleInvalid("keep")
    folders = {name: name.replace(" ", "_") for name in _SAVED}
    return SavedModels(preparation, {n: _SAVED[n].load(f"{base}/{f}") for n, f in folders.items() if f in there})


def score_table(saved: SavedModels, name: str, features: DataFrame) -> DataFrame:
    """``features`` (see ``plans.features``) with ``prediction`` and ``score`` of one model. Partitions are scored where they
    lie, nothing is shuffled; the label is not needed."""
    scored = saved.models[name].transform(saved.preparation.transform(features))
    return scored.select(
        *features.columns, F.col("prediction").cast("int").alias("prediction"), vector_to_array("probability")[1].alias("score")
    )


def saved_score_facts(trained: TrainedModels, saved: SavedModels, features: DataFrame, label: str = LABEL) -> DataFrame:
    """(model, actual, rows, different): rows of a table, and those that a saved model scores differently from the fitted one."""
    result, columns = None, [*features.columns, COPIES]
    features = stored(pack_copies(features))
    for name, model in trained.models.items():
        own = model.transform(trained.preparation.transform(features))
        own = own.select(*columns, vector_to_array("probability")[1].alias("own_score"), F.col("prediction").alias("own_prediction"))
        both = saved.models[name].transform(saved.preparation.transform(own))
        differs = (F.abs(vector_to_array("probability")[1] - F.col("own_score")) > 1e-12) | (F.col("prediction") != F.col("own_prediction"))
        copies = F.when(differs, F.col(COPIES)).otherwise(0)
        part = both.groupBy(F.col(label).alias("actual")).agg(F.sum(COPIES).alias("rows"), F.sum(copies).alias("different"))
        part = part.select(F.lit(name).alias("model"), "*")
        result = part if result is None else result.unionByName(part)
    return result


def save_models(trained: TrainedModels, base: str) -> list[str]:
    """The preparation (encoder and scaler) and each model, loadable by Spark ML."""
    base = base.rstrip("/")
    saved = [f"{base}/preparation"]
    trained.preparation.write().overwrite().save(saved[0])
    for name, model in trained.models.items():
        saved.append(f"{base}/{name.replace(' ', '_')}")
        model.write().overwrite().save(saved[-1])
    return saved
