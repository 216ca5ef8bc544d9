"""All stages in order."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tradewind.plans import reports as rep
from tradewind.plans.clean import CLEANERS
from tradewind.plans.features import features_base, features_enhanced, ml_extract, stored_extract
from tradewind.plans.metrics import best_model, class_balance, correlation_pairs, data_kpis, ml_kpi_row
from tradewind.plans.normalize import normalize
from tradewind.plans.profile import count_rows, counted, profile_layer, profile_samples
from tradewind.plans.training import (
    ALL_MODELS,
    BASE_MODELS,
    BOOSTING,
    ModelSettings,
    load_models,
    model_comparison,
    model_confusion,
    model_importances,
    model_roc,
    save_models,
    score_table,
    train_models,
)
from tradewind.plans.features import label_encode
from tradewind.plans.wrangle import build_commerce
from tradewind.session import observing_session, prepare, run_together, scratch, sized_shuffles, with_settings_of
from tradewind.sources.layers import LayerPaths, publish, read_layer, read_table, register_layer
from tradewind.sources.rawcsv import stage_wide_csv
from tradewind.sources.reportfiles import read_report, write_report
from tradewind.sources.schema import TABLES

log = logging.getLogger(__name__)


@dataclass
class RunResult:
    profile: DataFrame
    samples: DataFrame
    clean_rows: DataFrame
    registered: list[str]
    reports: dict[str, str]
    models: dict[str, str] = field(default_factory=dict)
    model_errors: dict[str, str] = field(default_factory=dict)


def write_all(spark: SparkSession, tables: dict[str, DataFrame], base: str) -> None:
    run_together(spark, [partial(publish, df, base, name) for name, df in tables.items()])


def normalize_stage(spark: SparkSession, paths: LayerPaths, multi_line: bool = True) -> list[str]:
    """Returns the tables that the export holds: a later stage reads these, not what an earlier run has left."""
    wide = stage_wide_csv(spark, paths.raw_csv, paths.staged, multi_line=multi_line)
    tables = normalize(wide)
    with sized_shuffles(spark, paths.staged):
        write_all(spark, tables, paths.normalized)
    return list(tables)


def clean_stage(spark: SparkSession, paths: LayerPaths, names: Sequence[str] = tuple(TABLES)) -> DataFrame:
    """Clean the tables that are there; (table_name, rows_in, rows_removed, rows_out), counted while they were written."""

    def one(name: str, df: DataFrame) -> tuple[str, int, int]:
        with_counts, counts = counted(name, df, CLEANERS[name])
        publish(with_counts, paths.cleaned, name)
        return counts()

    own = with_settings_of(spark, observing_session(spark))
    tables = read_layer(own, paths.normalized, names)
    with sized_shuffles(own, paths.normalized):
        found = run_together(own, [partial(one, name, df) for name, df in tables.items()])
    return count_rows(spark, found)


def wrangle_stage(spark: SparkSession, paths: LayerPaths, names: Sequence[str] = tuple(TABLES)) -> None:
    with sized_shuffles(spark, paths.cleaned):
        commerce = build_commerce(read_layer(spark, paths.cleaned, names))
        if commerce is None:
            raise ValueError("customers, orders and order_items are needed to build the commerce table")
        publish(commerce, paths.wrangled, "commerce")


def report_stage(spark: SparkSession, paths: LayerPaths) -> dict[str, str]:
    """Each report scans only its own columns of the stored table; charts are built from stored reports."""
    commerce = read_table(spark, paths.wrangled, "commerce")
    jobs = [partial(rep.run_report, name, commerce, paths.reports) for name in rep.REPORTS]
    written = dict(zip(rep.REPORTS, run_together(spark, jobs)))
    written["eda_kpis"] = write_report(rep.eda_kpis(commerce), paths.reports, "eda_kpis")
    stored = {name: read_report(spark, paths.reports, name) for name in rep.REPORTS}
    written["eda_chart_series"] = write_report(rep.eda_chart_series(stored), paths.reports, "eda_chart_series")
    return written


def base_model_stage(spark: SparkSession, paths: LayerPaths, settings: ModelSettings) -> dict[str, str]:
    extract = stored_extract(spark, paths.models, paths.wrangled)
    trained = train_models(features_base(extract), BASE_MODELS, settings)
    found = {
        "base_comparison": model_comparison(trained),
        "base_importance": model_importances(spark, trained),
        "base_confusion": model_confusion(trained),
        "base_roc": model_roc(trained),
    }
    return {name: write_report(df, paths.reports, name) for name, df in found.items()}


def enhanced_model_stage(
    spark: SparkSession, paths: LayerPaths, settings: ModelSettings, leak: bool = False
) -> dict[str, str]:
    extract = stored_extract(spark, paths.models, paths.wrangled)
    trained = train_models(features_enhanced(extract, leak=leak), ALL_MODELS, settings)
    save_models(trained, f"{paths.models}/saved")
    with_delay = features_enhanced(extract, leak=True)
    numeric = label_encode(with_delay)
    write = lambda name, df: write_report(df, paths.reports, name)
    comparison = model_comparison(trained)
    return {
        "model_comparison": write("model_comparison", comparison),
        "best_model": write("best_model", best_model(comparison)),
        "feature_importance": write("feature_importance", model_importances(spark, trained)),
        "model_confusion": write("model_confusion", model_confusion(trained)),
        "model_roc": write("model_roc", model_roc(trained)),
        "class_balance": write("class_balance", class_balance(with_delay, "is_late")),
        "correlation_pairs": write("correlation_pairs", correlation_pairs(numeric, numeric.columns)),
        "data_kpis": write("data_kpis", data_kpis(with_delay)),
        "ml_kpis": write("ml_kpis", ml_kpi_row(with_delay, comparison)),
    }


def score_stage(spark: SparkSession, paths: LayerPaths, model: str = BOOSTING, table: str = "commerce") -> str:
    """Score the delivered rows of a wrangled table with the models an earlier run has saved; returns the folder of the scores."""
    features = features_enhanced(ml_extract(read_table(spark, paths.wrangled, table)))
    scored = score_table(load_models(spark, f"{paths.models}/saved"), model, features)
    return publish(scored, paths.models, "scores")


def run_all(
    spark: SparkSession,
    paths: LayerPaths,
    settings: ModelSettings = ModelSettings(),
    with_models: bool = True,
    multi_line: bool = True,
) -> RunResult:
    """Normalize, profile, clean, wrangle, register, report, train. A failed data stage stops the
    run; a failed model stage is logged and the run goes on. Intermediate tables are removed at the end."""
    with scratch(prepare(spark), paths.scratch):
        names = normalize_stage(spark, paths, multi_line)
        profile = profile_layer(spark, paths.normalized, names)
        samples = profile_samples(read_layer(spark, paths.normalized, names))
        clean_rows = clean_stage(spark, paths, names)
        wrangle_stage(spark, paths, names)
        registered = register_layer(spark, paths.wrangled, ["commerce"], paths.database)
        result = RunResult(profile, samples, clean_rows, registered, report_stage(spark, paths))
        if with_models:
            for name, stage in (("base", base_model_stage), ("enhanced", enhanced_model_stage)):
                try:
                    result.models.update(stage(spark, paths, settings))
                except Exception as error:  # noqa: BLE001 - the reports stand without the models
                    log.exception("model stage %s failed", name)
                    result.model_errors[name] = str(error)
    return result
