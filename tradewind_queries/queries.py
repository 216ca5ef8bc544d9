"""One query per operator, over whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import lru_cache, partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewind.functions.numbers import safe_double, safe_long
from tradewind.functions.text import strip_accents
from tradewind.functions.timestamps import floor_days, late_flag, to_ts
from tradewind.operators.dedupe import except_rows, one_per_key, removed_by_key
from tradewind.operators.impute import median_impute
from tradewind.operators.running import value_counts_upto
from tradewind.operators.sketches import rank_error, rank_gaps, sketched_medians
from tradewind.operators.skew import left_join_all
from tradewind.plans import clean as cl
from tradewind.plans import features as ft
from tradewind.plans import metrics as mt
from tradewind.plans import profile as pf
from tradewind.plans import reports as rp
from tradewind.plans import training as tr
from tradewind.plans import wrangle as wr
from tradewind.plans.normalize import normalize_joined, normalize_table
from tradewind.session import bytes_under, observing_session, run_together, shared_folder, stored, with_settings_of
from tradewind.sources.layers import publish, register_layer
from tradewind.sources.rawcsv import read_split_csv
from tradewind.sources.schema import TABLES, TEXT_TIMESTAMP, conform
from tradewind_queries import bindings as b

Query = Callable[[SparkSession, str], DataFrame]

NORMALIZE = {
    "normalize_orders": "orders",
    "normalize_items": "order_items",
    "normalize_payments": "order_payments",
    "normalize_reviews": "order_reviews",
    "normalize_customers": "customers",
    "normalize_sellers": "sellers",
    "normalize_products": "products",
    "normalize_geolocation": "geolocation",
    "normalize_translation": "product_category_name_translation",
}
CLEAN = {
    "clean_orders": "orders",
    "clean_items": "order_items",
    "clean_payments": "order_payments",
    "clean_reviews": "order_reviews",
    "clean_products": "products",
    "translation_backfill": "product_category_name_translation",
    "clean_sellers": "sellers",
    "clean_customers": "customers",
    "clean_geolocation": "geolocation",
}
PROFILED_FILES = tuple(
    f"{name}.parquet"
    for name in (
        "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
        "conversations absent"
    ).split()
)


def cleaned(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: cl.CLEANERS[n](b.RAW[n](spark, sf_dir)) for n in (names or b.RAW)}


def commerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wr.build_commerce(cleaned(spark, sf_dir))


@lru_cache(maxsize=8)
def stored_commerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commerce table, written once per session: reports and features scan their columns of it."""
    return stored(commerce(spark, sf_dir))


def extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ft.ml_extract(stored_commerce(spark, sf_dir))


def _normalize(table: str) -> Query:
    def run(spark, sf_dir):
        if table == "geolocation":
            return normalize_joined(*b.wide_geo(spark, sf_dir), TABLES[table])
        return normalize_table(b.wide(spark, sf_dir), TABLES[table])

    return run


def _clean(table: str) -> Query:
    return lambda spark, sf_dir: cleaned(spark, sf_dir, table)[table]


def _report(name: str) -> Query:
    return lambda spark, sf_dir: rp.REPORTS[name](stored_commerce(spark, sf_dir))


def normalize_parse_timestamps(spark, sf_dir):
    orders = b.orders(spark, sf_dir)
    text = orders.withColumns({c: F.date_format(c, TEXT_TIMESTAMP) for c in cl.ORDER_TIMES})
    return normalize_table(text, TABLES["orders"])


def profile_sample(spark, sf_dir):
    return pf.sample_rows(b.orders(spark, sf_dir), ["order_id"], 10)


def dedupe_removed_count(spark, sf_dir):
    reviews = b.order_reviews(spark, sf_dir).where(F.col("review_id").isNotNull())
    return removed_by_key(reviews, ["review_id"])


def customers_geo_raw(spark, sf_dir):
    t = cleaned(spark, sf_dir, "customers", "geolocation")
    return wr.customers_geo_raw(t["customers"], t["geolocation"])


def customers_geo(spark, sf_dir):
    t = cleaned(spark, sf_dir, "customers", "geolocation")
    return wr.customers_geo(t["customers"], t["geolocation"])


def forward_fill_geo(spark, sf_dir):
    t = cleaned(spark, sf_dir, "customers", "geolocation")
    return wr.customers_geo_filled(t["customers"], t["geolocation"])


# The paths for tables larger than one task, over the same whole tables, with limits that these reach.
SMALL_LIMIT = 20
FILL_LIMIT = 4  # geo rows of a ZIP are fewer than the joined rows


def forward_fill_carried(spark, sf_dir):
    t = cleaned(spark, sf_dir, "customers", "geolocation")
    return wr.customers_geo_filled(t["customers"], t["geolocation"], fill_rows=FILL_LIMIT)


def median_impute_ranged(spark, sf_dir):
    columns = list(cl.PRODUCT_MEASURES)
    filled = median_impute(b.products(spark, sf_dir), columns, one_task_rows=SMALL_LIMIT)
    return filled.select("product_id", *columns)


def price_quartiles_ranged(spark, sf_dir):
    return rp.product_price_distribution(stored_commerce(spark, sf_dir), one_task_rows=SMALL_LIMIT)


def roc_auc_ranged(spark, sf_dir):
    auc = mt.roc_auc(scored_labels(spark, sf_dir), "label", "score", one_task_rows=SMALL_LIMIT)
    return auc.withColumn("auc", F.round("auc", 9))


def roc_curve_ranged(spark, sf_dir):
    return mt.roc_curve(scored_labels(spark, sf_dir), "label", "score", one_task_rows=SMALL_LIMIT).withColumns(
        {c: F.round(c, 9) for c in ("fpr", "tpr")}
    )


def stratified_split_few_buckets(spark, sf_dir):
    split = ft.stratified_split(ml_features(spark, sf_dir), buckets=3)
    return split.groupBy(ft.LABEL, "split").agg(F.count(F.lit(1)).alias("n"))


def orders_items(spark, sf_dir):
    t = cleaned(spark, sf_dir, "orders", "order_items")
    return left_join_all(t["orders"], {"order_items": t["order_items"]}, "order_id")


def orders_payments_reviews(spark, sf_dir):
    t = cleaned(spark, sf_dir, "orders", "order_payments", "order_reviews")
    return left_join_all(t.pop("orders"), t, "order_id")


def median_impute_products(spark, sf_dir):
    columns = list(cl.PRODUCT_MEASURES)
    return median_impute(b.products(spark, sf_dir), columns).select("product_id", *columns)


def eda_kpis(spark, sf_dir):
    kpis = rp.eda_kpis(stored_commerce(spark, sf_dir))
    return kpis.withColumns({c: F.round(c, 6) for c in ("avg_review_score", "avg_delivery_delay_days")})


def eda_chart_series(spark, sf_dir):
    table = stored_commerce(spark, sf_dir)
    return rp.eda_chart_series({name: report(table) for name, report in rp.REPORTS.items()})


def catalog_sql_smoke(spark, sf_dir):
    base = f"{shared_folder(spark)}/catalog-{uuid.uuid4()}"
    publish(stored_commerce(spark, sf_dir), base, "commerce")
    (name,) = register_layer(spark, base, ["commerce"])
    return rp.sql_report(spark, name)


def catalog_table(spark, sf_dir):
    """A report from a table of a database, which is published twice: the catalog is switched to the whole table."""
    base, database = f"{shared_folder(spark)}/catalog-{uuid.uuid4()}", f"tradewind_{uuid.uuid4().hex}"
    table = stored_commerce(spark, sf_dir)
    publish(table.where("order_status = 'F'"), base, "commerce")
    register_layer(spark, base, ["commerce"], database)
    publish(table, base, "commerce")
    (name,) = register_layer(spark, base, ["commerce"], database)
    return rp.sql_report(spark, name)


MOST_BLOCKS = 2_000  # every block is a task of each pass


def wide_csv_split(spark, sf_dir):
    """All documents by way of CSV files, whose texts hold quotes and line feeds, read in small blocks: so many that
    records are cut by them, but no more tasks for more text."""
    folder = f"{shared_folder(spark)}/csv-{uuid.uuid4()}"
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"', "header": True}
    b.source(spark, sf_dir, "documents").write.options(**kept).csv(folder)
    text = read_split_csv(spark, folder, split_bytes=max(100_000, bytes_under(spark, folder) // MOST_BLOCKS))
    return conform(text, {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"})


def wide_columns(spark, sf_dir):
    profiled = {"commerce": stored_commerce(spark, sf_dir)}
    return pf.schema_rows(profiled).groupBy("table_name").agg(F.count(F.lit(1)).cast("int").alias("column_count"))


def clean_row_counts(spark, sf_dir):
    """Rows in, removed and out of each cleaner, counted by the job that stores its table."""
    own = with_settings_of(spark, observing_session(spark))

    def one(name):
        changed, counts = pf.counted(name, b.RAW[name](own, sf_dir), cl.CLEANERS[name])
        stored(changed)
        return counts()

    return pf.count_rows(spark, [one(name) for name in b.RAW])


def text_and_fallback_times(spark, sf_dir):
    """Times as text, as a date, as seconds with a fraction, and text that is no time."""
    ts = F.col("ts")
    events = b.source(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", TEXT_TIMESTAMP).alias("as_text"), F.to_date(ts).alias("as_date"),
        (F.unix_seconds(ts) + 0.5).alias("as_seconds"), F.col("event_type").alias("no_time"),
    )
    return events.select("event_id", *[to_ts(events, c).alias(c) for c in ("as_text", "as_date", "as_seconds", "no_time")])


def ml_extract_stored(spark, sf_dir):
    """The extract as it is stored, after the commerce table under it has been replaced by the whole one."""
    base = f"{shared_folder(spark)}/extract-{uuid.uuid4()}"
    table = stored_commerce(spark, sf_dir)
    publish(table.where("order_status = 'F'"), base, "commerce")
    ft.stored_extract(spark, f"{base}/models", base)
    publish(table, base, "commerce")
    return ft.stored_extract(spark, f"{base}/models", base)


def _within(gaps):
    return gaps.withColumn("within", F.col("gap") <= rank_error()).drop("gap")


def price_quantiles_sketched(spark, sf_dir):
    """Quartiles from merged monthly sketches: rows behind them, and whether their ranks are within the stated error."""
    table = stored_commerce(spark, sf_dir)
    sketches = stored(rp.price_sketches(table))
    points = rp.sketched_price_distribution(sketches).collect()
    counts, _ = value_counts_upto(table.select("price"), "price")
    gaps = _within(rank_gaps(counts, "price", [(r["share"], r["price"]) for r in points]))
    seen = sketches.agg(F.sum("n")).first()[0]
    return gaps.withColumn("within", F.col("within") & (F.col("n") == F.lit(points[0]["prices"])) & (F.col("n") == F.lit(seen)))


def medians_sketched(spark, sf_dir):
    """Medians of the product measures from one pass, against the exact ranks."""
    products, out = b.products(spark, sf_dir), None
    for name, median in sketched_medians(products, cl.PRODUCT_MEASURES).items():
        counts, _ = value_counts_upto(products.select(name), name)
        part = _within(rank_gaps(counts, name, [(0.5, median)])).select(F.lit(name).alias("measure"), "n", "within")
        out = part if out is None else out.unionByName(part)
    return out


def label_encode_joined(spark, sf_dir):
    return ft.label_encode(ml_features(spark, sf_dir), most_values=0)


def stratified_split_radix(spark, sf_dir):
    split = ft.stratified_split(ml_features(spark, sf_dir), buckets=3, one_task_rows=SMALL_LIMIT)
    return split.groupBy(ft.LABEL, "split").agg(F.count(F.lit(1)).alias("n"))


def missing_columns(spark, sf_dir):
    """An export without the weight, and without a column that no export has."""
    wanted = {"product_id": "bigint", "product_weight_g": "double", "product_length_cm": "double", "shelf": "int"}
    return conform(b.products(spark, sf_dir).drop("product_weight_g"), wanted)


def epoch_ms_to_ts(spark, sf_dir):
    events = b.source(spark, sf_dir, "events").select("event_id", F.unix_millis("ts").alias("ts"))
    return events.withColumn("ts", to_ts(events, "ts"))


def delay_days_floor(spark, sf_dir):
    days = floor_days(F.col("order_estimated_delivery_date"), F.col("order_delivered_customer_date"))
    return b.orders(spark, sf_dir).select("order_id", days.alias("delay_days"))


def is_late_flag(spark, sf_dir):
    return delay_days_floor(spark, sf_dir).select("order_id", late_flag(F.col("delay_days")).alias("is_late"))


def safe_numeric(spark, sf_dir):
    event = F.col("event_id")
    text = (
        F.when(event % 4 == 0, F.col("event_type"))
        .when(event % 4 == 1, event.cast("string"))
        .when(event % 4 == 2, F.concat(event.cast("string"), F.lit(".75")))
        .otherwise(F.lit(""))
    )
    rows = b.source(spark, sf_dir, "events").select("event_id", text.alias("raw"))
    return rows.withColumns({"as_float": safe_double(F.col("raw")), "as_int": safe_long(F.col("raw"))})


def strip_accents_documents(spark, sf_dir):
    return b.source(spark, sf_dir, "documents").select(
        "doc_id", strip_accents(F.lower("text")).alias("plain_text")
    )


def ml_features(spark, sf_dir):
    return ft.features_base(extract(spark, sf_dir))


def ml_features_enhanced(spark, sf_dir):
    return ft.features_enhanced(extract(spark, sf_dir), leak=True)


def standardize(spark, sf_dir):
    scaled = ft.standardize(ml_features(spark, sf_dir))
    return scaled.withColumns({c: F.round(c, 4) + 0.0 for c in scaled.columns if c != ft.LABEL})


def stratified_split_counts(spark, sf_dir):
    split = ft.stratified_split(ml_features(spark, sf_dir))
    return split.groupBy(ft.LABEL, "split").agg(F.count(F.lit(1)).alias("n"))


def class_balance(spark, sf_dir):
    return mt.class_balance(ml_features_enhanced(spark, sf_dir), ft.LABEL)


def correlation_pairs(spark, sf_dir):
    coded = ft.label_encode(ml_features_enhanced(spark, sf_dir))
    pairs = mt.correlation_pairs(coded, sorted(coded.columns))
    return pairs.withColumn("correlation", F.round("correlation", 6) + 0.0)


def ml_kpis(spark, sf_dir):
    kpis = mt.data_kpis(ml_features_enhanced(spark, sf_dir))
    return kpis.withColumns({c: F.round(c, 6) for c in ("late_pct", "avg_delay_days")})


def scored_labels(spark, sf_dir):
    labels, documents = b.source(spark, sf_dir, "labels"), b.source(spark, sf_dir, "documents")
    return labels.join(documents, "doc_id").select(
        F.col("quality").alias("label"), F.col("n_chars").alias("score"), (F.col("n_chars") > 1000).cast("int").alias("pred")
    )


def binary_metrics(spark, sf_dir):
    result = mt.binary_metrics(scored_labels(spark, sf_dir), "label", "pred")
    return result.withColumns({c: F.round(c, 9) for c in result.columns})


def roc_auc(spark, sf_dir):
    auc = mt.roc_auc(scored_labels(spark, sf_dir), "label", "score")
    return auc.withColumn("auc", F.round("auc", 9))


def roc_curve(spark, sf_dir):
    return mt.roc_curve(scored_labels(spark, sf_dir), "label", "score").withColumns(
        {c: F.round(c, 9) for c in ("fpr", "tpr")}
    )


def confusion_matrix(spark, sf_dir):
    return mt.confusion_matrix(scored_labels(spark, sf_dir), "label", "pred")


@lru_cache(maxsize=4)
def model_rows(spark: SparkSession, sf_dir: str, enhanced: bool) -> tr.ModelRows:
    """The encoded and split rows of the base or the enhanced features, made once per session."""
    return tr.model_rows(ft.features_enhanced(extract(spark, sf_dir)) if enhanced else ml_features(spark, sf_dir))


@lru_cache(maxsize=12)
def fitted(spark: SparkSession, sf_dir: str, enhanced: bool, name: str) -> tr.TrainedModels:
    """One model at full size, fitted once per session and shared by the queries."""
    return tr.fit_models(model_rows(spark, sf_dir, enhanced), [name])


def trained(spark: SparkSession, sf_dir: str, *names: str, enhanced: bool = True) -> tr.TrainedModels:
    """The models that a query needs, and no others."""
    model_rows(spark, sf_dir, enhanced)
    return tr.together(run_together(spark, [partial(fitted, spark, sf_dir, enhanced, name) for name in names]))


def trained_all(spark: SparkSession, sf_dir: str) -> tr.TrainedModels:
    return trained(spark, sf_dir, *tr.ALL_MODELS)


def ml_model_facts(spark, sf_dir):
    facts = tr.model_facts(trained_all(spark, sf_dir))
    return facts.withColumn("auc_gap", F.round("auc_gap", 9) + 0.0)


def ml_importance_facts(spark, sf_dir):
    rows = tr.model_importances(spark, trained(spark, sf_dir, tr.FOREST, tr.BOOSTING))
    return rows.groupBy("model").agg(
        F.count(F.lit(1)).alias("features"),
        F.round(F.sum("importance"), 9).alias("total"),
        F.count_if(F.col("importance") < 0).alias("negative"),
    )


def ml_logreg_gradient(spark, sf_dir):
    found = tr.logreg_gradient(trained(spark, sf_dir, tr.LOGREG))
    return found.withColumn("gradient", F.round("gradient", 3) + 0.0)


def ml_tree_facts(spark, sf_dir):
    return tr.tree_facts(trained(spark, sf_dir, tr.FOREST, tr.BOOSTING))


def ml_boosting_loss(spark, sf_dir):
    return tr.boosting_loss(trained(spark, sf_dir, tr.BOOSTING))


def _rounded_gaps(df):
    return df.withColumns({c: F.round(c, 9) + 0.0 for c in df.columns if c.endswith("_gap")})


def ml_comparison_facts(spark, sf_dir):
    return _rounded_gaps(tr.comparison_facts(trained_all(spark, sf_dir), ml_model_comparison(spark, sf_dir)))


def ml_kpi_row(spark, sf_dir):
    """The KPI row, with its AUC and accuracy less the largest area under ROC points and that model's share of right cells."""
    models = trained_all(spark, sf_dir)
    row = mt.ml_kpi_row(ml_features_enhanced(spark, sf_dir), ml_model_comparison(spark, sf_dir))
    best = tr.areas(models).orderBy(F.desc("area")).first()
    right = F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")))
    name = row.first()["best_model"]
    share = tr.model_confusion(models).where(F.col("model") == name).agg(right / F.sum("n")).first()[0]
    gaps = row.select(
        "samples", "late_pct", "avg_delay_days", (F.col("best_auc") - best["area"]).alias("auc_gap"), (F.col("best_accuracy") - share).alias("accuracy_gap")
    )
    return _rounded_gaps(gaps).withColumns({c: F.round(c, 6) for c in ("late_pct", "avg_delay_days")})


def ml_saved_scores(spark, sf_dir):
    """All feature rows, scored by the models as they come back from storage."""
    models = trained_all(spark, sf_dir)
    base = f"{shared_folder(spark)}/models-{uuid.uuid4()}"
    tr.save_models(models, base)
    features = ft.features_enhanced(extract(spark, sf_dir))
    return tr.saved_score_facts(models, tr.load_models(spark, base), features)


def ml_logreg_calibration(spark, sf_dir):
    """The intercept has no penalty, so the mean score on the train rows is their share of late ones."""
    found = tr.mean_train_score(trained(spark, sf_dir, tr.LOGREG), tr.LOGREG)
    return found.withColumn("mean_score", F.round("mean_score", 4))


def ml_best_model_facts(spark, sf_dir):
    """Models compared, and by how many the best one is beaten by the area under its ROC points."""
    return tr.best_facts(trained_all(spark, sf_dir), ml_best_model(spark, sf_dir))


def ml_feature_importance(spark, sf_dir):
    return tr.model_importances(spark, trained(spark, sf_dir, tr.FOREST, tr.BOOSTING))


def ml_model_comparison(spark, sf_dir):
    return tr.model_comparison(trained_all(spark, sf_dir))


def ml_best_model(spark, sf_dir):
    return mt.best_model(ml_model_comparison(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "profile_row_counts": lambda s, d: pf.row_counts(b.raw_tables(s, d)),
    "profile_schema": lambda s, d: pf.schema_rows(b.raw_tables(s, d)),
    "profile_sample": profile_sample,
    "profile_tables": lambda s, d: pf.profile_layer(s, d, PROFILED_FILES),
    "dedupe_removed_count": dedupe_removed_count,
    **{query: _normalize(table) for query, table in NORMALIZE.items()},
    "normalize_parse_timestamps": normalize_parse_timestamps,
    **{query: _clean(table) for query, table in CLEAN.items()},
    "invalid_timeline_rows": lambda s, d: b.orders(s, d).where(cl.impossible_timeline()),
    "distinct_rows": lambda s, d: b.order_items(s, d).distinct(),
    "dedupe_by_key": lambda s, d: one_per_key(b.order_items(s, d), ["order_id", "order_item_id"]),
    "except_invalid": lambda s, d: except_rows(b.orders(s, d), cl.impossible_timeline()),
    "customers_geo_raw": customers_geo_raw,
    "customers_geo": customers_geo,
    "forward_fill_geo": forward_fill_geo,
    "orders_items": orders_items,
    "orders_payments_reviews": orders_payments_reviews,
    "orders_all": lambda s, d: wr.build_orders_all(cleaned(s, d)),
    "commerce": commerce,
    **{name: _report(name) for name in rp.REPORTS},
    "median_impute": median_impute_products,
    "eda_kpis": eda_kpis,
    "eda_chart_series": eda_chart_series,
    "catalog_sql_smoke": catalog_sql_smoke,
    "epoch_ms_to_ts": epoch_ms_to_ts,
    "delay_days_floor": delay_days_floor,
    "is_late_flag": is_late_flag,
    "missing_columns": missing_columns,
    "safe_numeric": safe_numeric,
    "strip_accents": strip_accents_documents,
    "ml_extract": extract,
    "ml_features": ml_features,
    "ml_features_enhanced": ml_features_enhanced,
    "label_encode": lambda s, d: ft.label_encode(ml_features(s, d)),
    "standardize": standardize,
    "stratified_split_counts": stratified_split_counts,
    "class_balance": class_balance,
    "correlation_pairs": correlation_pairs,
    "ml_kpis": ml_kpis,
    "binary_metrics": binary_metrics,
    "roc_auc": roc_auc,
    "roc_curve": roc_curve,
    "confusion_matrix": confusion_matrix,
    "ml_logreg_metrics": lambda s, d: tr.model_metrics(trained(s, d, tr.LOGREG, enhanced=False), tr.LOGREG),
    "ml_rf_metrics": lambda s, d: tr.model_metrics(trained(s, d, tr.FOREST, enhanced=False), tr.FOREST),
    "ml_gbt_metrics": lambda s, d: tr.model_metrics(trained(s, d, tr.BOOSTING), tr.BOOSTING),
    "ml_feature_importance": ml_feature_importance,
    "ml_model_comparison": ml_model_comparison,
    "ml_best_model": ml_best_model,
    "ml_model_facts": ml_model_facts,
    "ml_importance_facts": ml_importance_facts,
    "ml_logreg_calibration": ml_logreg_calibration,
    "ml_best_model_facts": ml_best_model_facts,
    "ml_logreg_gradient": ml_logreg_gradient,
    "ml_tree_facts": ml_tree_facts,
    "ml_boosting_loss": ml_boosting_loss,
    "ml_comparison_facts": ml_comparison_facts,
    "ml_kpi_row": ml_kpi_row,
    "ml_saved_scores": ml_saved_scores,
    "catalog_table": catalog_table,
    "wide_csv_split": wide_csv_split,
    "wide_columns": wide_columns,
    "clean_row_counts": clean_row_counts,
    "text_and_fallback_times": text_and_fallback_times,
    "ml_extract_stored": ml_extract_stored,
    "price_quantiles_sketched": price_quantiles_sketched,
    "medians_sketched": medians_sketched,
    "label_encode_joined": label_encode_joined,
    "stratified_split_radix": stratified_split_radix,
    "orders_all_hot": lambda s, d: wr.build_orders_all(cleaned(s, d), hot_rows=SMALL_LIMIT),
    "commerce_hot": lambda s, d: wr.build_commerce(cleaned(s, d), hot_rows=SMALL_LIMIT),
    "forward_fill_carried": forward_fill_carried,
    "median_impute_ranged": median_impute_ranged,
    "price_quartiles_ranged": price_quartiles_ranged,
    "roc_auc_ranged": roc_auc_ranged,
    "roc_curve_ranged": roc_curve_ranged,
    "stratified_split_few_buckets": stratified_split_few_buckets,
}
