from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.domain import small_shop
from tradewind.operators import skew
from tradewind.operators.fill import forward_fill
from tradewind.plans import reports as rp
from tradewind.plans import wrangle as wr
from tradewind.plans.clean import clean
from tradewind.sources.layers import publish, read_layer, read_table


@pytest.fixture(scope="module")
def cleaned(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("cleaned"))
    for name, df in clean(small_shop(spark)).items():
        publish(df, base, name)
    from tradewind.sources.schema import TABLES

    return read_layer(spark, base, TABLES)


def counted(df):
    return Counter(map(tuple, df.collect()))


def test_fan_out(cleaned):
    per_order = {r.order_id: r["count"] for r in wr.build_orders_all(cleaned).groupBy("order_id").count().collect()}
    assert per_order == {"o1": 8, "o2": 1, "o3": 1, "o4": 1}


def test_dimensions(cleaned):
    got = {(r.order_id, r.product_id): r for r in wr.build_orders_all(cleaned).collect()}
    assert got["o1", "p1"].product_category_name_english == "bed"
    assert got["o1", "p2"].product_category_name_english == "pc_gamer"
    assert got["o1", "p1"].seller_city == "sao paulo"
    assert got["o3", "p404"].product_weight_g is None and got["o2", None].price is None


def test_commerce(cleaned):
    commerce = wr.build_commerce(cleaned)
    assert len(commerce.columns) == 38
    assert not set(wr.DROPPED_IDS) & set(commerce.columns)
    # o4 belongs to an unknown customer; o2 has neither items nor a known ZIP.
    assert commerce.count() == 10
    assert {(r.geolocation_lat, r.customer_state) for r in commerce.collect()} == {(-23.5, "SP"), (None, "RJ")}


@pytest.mark.parametrize("missing", ["order_payments", "order_reviews", "products", "sellers", "geolocation", "product_category_name_translation"])
def test_optional_tables(cleaned, missing):
    tables = {k: v for k, v in cleaned.items() if k != missing}
    assert wr.build_commerce(tables).count() >= 4


def test_needed_tables(cleaned):
    for name in ("orders", "order_items", "customers"):
        assert wr.build_commerce({k: v for k, v in cleaned.items() if k != name}) is None


def with_copies(cleaned):
    tables = dict(cleaned)
    for name in ("order_items", "order_payments", "products"):
        tables[name] = tables[name].unionByName(tables[name])
    return tables


def test_commerce_is_distinct_before_the_ids_go(cleaned):
    people = wr.customers_geo(cleaned["customers"], cleaned["geolocation"])
    tables = with_copies(cleaned)
    wide = people.join(wr.build_orders_all(tables), "customer_id").distinct().drop(*wr.DROPPED_IDS)
    built = wr.build_commerce(tables)
    assert counted(built.select(*sorted(built.columns))) == counted(wide.select(*sorted(wide.columns)))


@pytest.mark.parametrize("hot_rows", [1, 2])
def test_hot_orders_change_nothing(cleaned, hot_rows):
    tables = with_copies(cleaned)
    for build in (wr.build_orders_all, wr.build_commerce):
        plain, hot = build(tables), build(tables, hot_rows=hot_rows)
        assert counted(hot.select(*sorted(hot.columns))) == counted(plain.select(*sorted(plain.columns)))


def test_customers_geo_takes_the_first_known_value(spark):
    customers = spark.createDataFrame([("c1", "1"), ("c2", "1"), ("c3", "2")], "customer_id string, customer_zip_code_prefix string")
    geo = spark.createDataFrame(
        [("1", 2.0, 1.0, "b", "SP"), ("1", 1.0, 5.0, None, "SP"), ("1", 1.0, 6.0, "z", None)],
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, geolocation_city string, geolocation_state string",
    )
    got = {r.customer_id: tuple(r)[2:] for r in wr.customers_geo(customers, geo).collect()}
    assert got == {"c1": ("1", 1.0, 5.0, "z", "SP"), "c2": ("1", 1.0, 5.0, "z", "SP"), "c3": (None,) * 5}
    assert wr.customers_geo_raw(customers, geo).count() == 7
    assert wr.customers_geo(customers, None) is customers


def test_wide_rows_are_not_shuffled(spark, cleaned):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = wr.build_commerce(cleaned)._jdf.queryExecution().optimizedPlan().toString()
        physical = wr.build_commerce(cleaned)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Cross" not in plan and "CartesianProduct" not in physical and "NestedLoop" not in physical
    # Above the first join of the order-partitioned inputs there is no further exchange on the left side.
    by_order = [line for line in physical.splitlines() if "Exchange hashpartitioning(order_id" in line]
    assert len(by_order) == 4
    top = physical.splitlines()[: next(i for i, l in enumerate(physical.splitlines()) if "Exchange" in l)]
    assert sum("SortMergeJoin" in l for l in top) == 3


def test_reports(cleaned, spark, tmp_path):
    commerce = wr.build_commerce(cleaned)
    report = {name: f(commerce).collect() for name, f in rp.REPORTS.items()}
    assert [tuple(r) for r in report["order_status_distribution"]] == [("delivered", 9), ("created", 1)]
    assert [(r.total_orders, r.total_revenue) for r in report["monthly_orders_revenue"]] == [(1, 50.65)]
    assert [tuple(r) for r in report["top_states_by_order_count"]] == [("RJ", 1), ("SP", 1)]
    assert {r.payment_type: (r.transactions, r.total_value) for r in report["payment_type_distribution"]} == {
        "bank_slip": (4, 24.0), "voucher": (4, 21.4), "credit_card": (1, 7.25), None: (1, None)}
    # Numbers sort as numbers.
    assert [r.payment_installments for r in report["installments_distribution"]] == [None, 1, 2, 10]
    assert [tuple(r) for r in report["top_categories_by_sales"]] == [("bed", 42.0, 1), ("pc_gamer", 3.4, 1)]
    price = report["product_price_distribution"][0]
    assert (price.p25, price.median, price.p75) == (0.85, 5.25, 10.5) and round(price.avg_price, 6) == 5.627778
    assert [tuple(r) for r in report["review_score_distribution"]] == [(1, 4), (5, 4)]
    assert [tuple(r) for r in report["delivery_delay_distribution"]] == [(-16, 1), (4, 8)]
    kpis = rp.eda_kpis(commerce).first()
    assert (kpis.total_orders, kpis.total_revenue, kpis.avg_review_score) == (10, 50.65, 3.0)
    assert round(kpis.avg_delivery_delay_days, 6) == round((4 * 8 - 16) / 9, 6)
    series = rp.eda_chart_series({n: f(commerce) for n, f in rp.REPORTS.items()})
    assert series.columns == ["chart", "x", "series", "y"]
    assert {r.chart for r in series.collect()} >= {"customers_by_state", "shipping_time_distribution"}
    assert {r.series for r in series.where("chart = 'monthly_orders_revenue'").collect()} == {"orders", "revenue"}
    empty = commerce.where(F.lit(False))
    assert rp.product_price_distribution(empty).first().p25 is None
    assert tuple(rp.eda_kpis(empty).first()) == (0, 0.0, 0.0, 0.0)


def test_reports_scan_only_their_columns(spark, cleaned, tmp_path):
    publish(wr.build_commerce(cleaned), str(tmp_path), "commerce")
    commerce = read_table(spark, str(tmp_path), "commerce")

    def scanned(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema" in line], plan

    schema, _ = scanned(rp.order_status_distribution(commerce))
    assert schema == ["struct<order_status:string>"]
    schema, plan = scanned(rp.monthly_orders_revenue(commerce))
    assert schema == ["struct<order_status:string,order_purchase_timestamp:timestamp,price:double>"]
    assert "IsNotNull(price)" in plan
    schema, plan = scanned(rp.top_states_by_order_count(commerce))
    assert "TakeOrderedAndProject" in plan and "IsNotNull(customer_state)" in plan


def _places(spark):
    customers = spark.createDataFrame(
        [(i, "1" if i < 6 else "2" if i < 8 else None if i < 10 else "3") for i in range(12)],
        "customer_id int, customer_zip_code_prefix string",
    )
    geo = spark.createDataFrame(
        [("1", 1.0, 1.0, None, None), ("1", 1.0, 2.0, "a", None), ("1", 2.0, 1.0, None, "SP"), ("1", 3.0, 1.0, None, None),
         ("2", 5.0, 5.0, None, "RJ"), (None, 7.0, 7.0, "x", "x")],
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, geolocation_city string, geolocation_state string",
    )
    return customers, geo


@pytest.mark.parametrize("hot_rows, fill_rows", [(1_000_000, 1_000_000), (5, 1_000_000), (1_000_000, 2), (5, 2)])
def test_geo_rows_filled_before_the_join_are_those_filled_after_it(spark, hot_rows, fill_rows):
    customers, geo = _places(spark)
    raw = wr.customers_geo_raw(customers, geo)
    order = ["customer_id", "geolocation_lat", "geolocation_lng"]
    after = forward_fill(raw, [wr.GEO_ZIP, *wr.GEO_POINT], "customer_zip_code_prefix", order)
    before = wr.customers_geo_filled(customers, geo, hot_rows=hot_rows, fill_rows=fill_rows)
    assert before.columns == after.columns and before.dtypes == after.dtypes
    assert counted(before) == counted(after) and before.count() == 6 * 4 + 2 + 2 + 2
    assert before.where("customer_id = 0 AND geolocation_city IS NULL").count() == 1


def test_geo_filled_rows_are_not_sorted_or_shuffled(spark):
    customers, geo = _places(spark)
    plan = wr.customers_geo_filled(customers, geo)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Window")  # the window lies below the join: it fills geo rows alone
    hot = wr.customers_geo_raw(customers, geo, hot_rows=5)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in hot  # rows of hot keys are repeated where they are made


def test_only_items_of_kept_orders_are_widened_in_parts_of_bounded_rows(spark, monkeypatch):
    tables = clean(small_shop(spark))
    seen, join = [], wr.left_join_all
    monkeypatch.setattr(wr, "left_join_all", lambda base, branches, key, **more: seen.append((base, branches, key)) or join(base, branches, key, **more))
    monkeypatch.setattr(skew, "PART_ROWS", 1)
    kept = tables | {"orders": tables["orders"].where("order_id = 'o3'")}
    assert wr.build_commerce(kept).rdd.getNumPartitions() >= 9  # rows of the four tables, more than the session's 4 partitions
    base, branches = next((base, branches) for base, branches, key in seen if key == "order_id")
    assert base.inputFiles(), "what the base is made of is worked out once"
    assert [r["order_id"] for r in branches["order_items"].select("order_id").collect()] == ["o3"]
    assert wr.build_orders_all(kept).count() == 1
