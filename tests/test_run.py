from datetime import datetime, timedelta

import pytest

from tradewind.plans.run import run_all
from tradewind.plans.training import ModelSettings
from tradewind.sources.layers import LayerPaths, read_table
from tradewind.sources.reportfiles import read_report

SMALL = ModelSettings(logreg_iterations=10, forest_trees=3, forest_depth=2, boosting_rounds=2)
HEADER = (
    "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,"
    "order_delivered_customer_date,order_estimated_delivery_date,order_item_id,product_id,seller_id,shipping_limit_date,"
    "price,freight_value,payment_sequential,payment_type,payment_installments,payment_value,review_id,review_score,"
    "review_comment_message,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state,"
    "seller_zip_code_prefix,seller_city,seller_state,product_category_name,product_name_lenght,product_weight_g,"
    "product_length_cm,product_height_cm,product_width_cm,geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,"
    "geolocation_city,geolocation_state,product_category_name_english"
)


def text(day):
    return f"{day.month}/{day.day}/{day.year} {day.hour}:{day.minute:02d}"


@pytest.fixture(scope="module")
def export(tmp_path_factory):
    lines = [HEADER]
    for i in range(60):
        bought = datetime(2018, 1 + i % 6, 3, 10, 5)
        times = [bought, bought + timedelta(hours=1), bought + timedelta(days=1), bought + timedelta(days=4 + i % 9), bought + timedelta(days=8)]
        state = ("SP", "RJ", "MG")[i % 3]
        lines.append(",".join([
            f"o{i}", f"c{i % 20}", "delivered", *map(text, times), "1", f"p{i % 7}", f"s{i % 4}", text(bought),
            f"{10 + i}.50", "2.5", "1", "boleto", "1", f"{12 + i}.00", f"r{i}", str(1 + i % 5),
            '"line one\nline ""two"""', f"u{i % 20}", f"{i % 5}00", "city", ("SP", "RJ", "MG")[i % 20 % 3],
            f"{i % 4}", "São Paulo", "SP" if i % 4 else "RJ", "cama" if i % 7 else "mesa", "5", "" if i % 7 == 3 else str(100 + i % 7), "1", "2", "3",
            f"{i % 5}00", f"-2{i % 5}.5", "-46.1", "city", state, "bed" if i % 7 else "table",
        ]))
    path = tmp_path_factory.mktemp("raw") / "export.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_run_all(spark, export, tmp_path):
    paths = LayerPaths.under(str(tmp_path), export)
    result = run_all(spark, paths, SMALL)
    assert {r.status for r in result.profile.collect()} == {"ok"} and result.profile.count() == 9
    counts = {r.table_name: tuple(r)[1:] for r in result.clean_rows.collect()}
    assert counts["orders"] == (60, 0, 60) and counts["products"][2] == read_table(spark, paths.cleaned, "products").count()
    assert not list(tmp_path.glob("scratch/run-*"))
    assert result.registered == ["commerce"] and result.model_errors == {}
    orders = read_table(spark, paths.cleaned, "orders")
    assert orders.count() == 60 and dict(orders.dtypes)["order_approved_at"] == "timestamp"
    assert spark.table("commerce").count() == read_table(spark, paths.wrangled, "commerce").count() > 0
    assert len(result.reports) == 15
    stored = read_report(spark, paths.reports, "monthly_orders_revenue")
    assert stored.columns == ["month", "total_orders", "total_revenue"] and stored.count() == 6
    assert read_report(spark, paths.reports, "model_comparison").count() == 3
    assert set(result.models) >= {"base_comparison", "base_roc", "base_confusion", "base_importance", "best_model", "correlation_pairs"}
    kpis = read_report(spark, paths.reports, "ml_kpis").first()
    assert int(kpis["samples"]) > 0 and kpis["best_model"] == read_report(spark, paths.reports, "best_model").first()["model"]
    samples = result.samples.groupBy("table_name").count().collect()
    assert len(samples) == 9 and all(1 <= r["count"] <= 10 for r in samples)


def test_a_second_run_uses_only_what_the_new_export_holds(spark, export, tmp_path):
    paths = LayerPaths.under(str(tmp_path), export)
    run_all(spark, paths, SMALL)
    first = read_table(spark, paths.models, "ml_extract").count()
    lines = open(export).read().split("\n")
    header = lines[0].split(",")
    fewer = tmp_path / "fewer.csv"
    # A comment spans two lines; fewer orders, and no geolocation at all.
    body = "\n".join(lines[1 : 1 + 2 * 30])
    fewer.write_text(",".join(h if not h.startswith("geolocation") else f"x_{h}" for h in header) + "\n" + body + "\n")
    paths = LayerPaths.under(str(tmp_path), str(fewer))
    result = run_all(spark, paths, SMALL)
    assert "geolocation" not in {r.table_name for r in result.clean_rows.collect()}
    assert "geolocation_lat" not in read_table(spark, paths.wrangled, "commerce").columns
    assert 0 < read_table(spark, paths.models, "ml_extract").count() < first


def test_a_failed_model_stage_does_not_stop_the_run(spark, export, tmp_path, monkeypatch):
    from tradewind.plans import run

    monkeypatch.setattr(run, "train_models", lambda *a, **k: 1 / 0)
    result = run_all(spark, LayerPaths.under(str(tmp_path), export), SMALL)
    assert set(result.model_errors) == {"base", "enhanced"} and len(result.reports) == 15


def test_a_failed_data_stage_stops_the_run(spark, tmp_path):
    (tmp_path / "export.csv").write_text("order_id,price,freight_value\no1,1.0,1.0\n")
    with pytest.raises(Exception):
        run_all(spark, LayerPaths.under(str(tmp_path / "out"), str(tmp_path / "export.csv")), SMALL)
