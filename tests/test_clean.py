from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.domain import TIMES, table, ts
from tradewind.plans import clean as cl


def test_orders_timeline(spark):
    def order(key, *days):
        return (key, "c", "s", *[None if d is None else datetime(2018, 1, d) for d in days])

    data = [
        order("approved early", 5, 4, 6, 7, 9),
        order("carrier early", 5, 6, 5, 7, 9),
        order("delivered early", 5, 6, 7, 6, 9),
        order("estimated early", 5, 6, 7, 8, 4),
        order("unknown approval", 5, None, 6, 7, 9),
        order("undelivered", 5, 5, None, None, 9),
        order("all equal", 5, 5, 5, 5, 5),
        order("all equal", 5, 5, 5, 5, 6),
        order("one bad, one unknown", 5, 4, None, None, None),
    ]
    kept = {r.order_id: r for r in cl.clean_orders(table(spark, "orders", data, **TIMES)).collect()}
    assert set(kept) == {"unknown approval", "undelivered", "all equal"}
    assert kept["all equal"].order_estimated_delivery_date == datetime(2018, 1, 5)


def test_orders_from_text(spark):
    data = [("o", "c", "s", "10/2/2017 10:56", "10/2/2017 11:07", None, "bad", "10/18/2017 0:00")]
    row = cl.clean_orders(table(spark, "orders", data)).first()
    assert row.order_approved_at == datetime(2017, 10, 2, 11, 7) and row.order_delivered_customer_date is None


def test_items(spark):
    data = [("a", "1", "p", "s", "2018-01-02 03:04:05", price, freight) for price, freight in
            [("0.85", "0"), ("0", "1"), (None, "1"), ("5", "-0.5"), ("5", None), ("12.5", "3"), ("x", "1"), ("NaN", "1")]]
    got = cl.clean_items(table(spark, "order_items", data))
    assert sorted(r.price for r in got.collect()) == [0.85, 12.5]
    assert "shipping_deadline" in got.columns and "shipping_limit_date" not in got.columns
    assert got.first().shipping_deadline == datetime(2018, 1, 2, 3, 4, 5)


def test_payments(spark):
    data = [("o", "1", kind, "10", "9.5") for kind in ("boleto", "not_defined", None, "voucher")]
    got = cl.clean_payments(table(spark, "order_payments", data))
    assert sorted(r.payment_type for r in got.collect()) == ["bank_slip", "voucher"]
    assert dict(got.dtypes)["payment_installments"] == "int"


def test_reviews(spark):
    data = [("r1", "o2", "5"), ("r1", "o1", "4"), (None, "o3", "1"), ("r2", "o1", "3")]
    got = cl.clean_reviews(table(spark, "order_reviews", data, **TIMES))
    assert sorted((r.review_id, r.order_id, r.review_score) for r in got.collect()) == [("r1", "o1", 4), ("r2", "o1", 3)]


def test_products(spark):
    data = [
        ("no category", None, "1", "1", "1", "10", "1", "1", "1"),
        ("filled", "x", "1", "1", "1", None, "1", "1", "1"),
        ("zero", "x", "1", "1", "1", "0", "1", "1", "1"),
        ("a", "x", "1", "1", "1", "20", "1", "1", "1"),
        ("b", "x", "1", "1", "1", "30", "1", "1", "1"),
    ]
    df = table(spark, "products", data)
    got = {r.product_id: r for r in cl.clean_products(df).collect()}
    assert set(got) == {"filled", "a", "b"} and got["filled"].product_weight_g == 20.0
    assert got["a"].product_name_length == 1.0
    lacking = cl.clean_products(df.drop("product_name_lenght", "product_width_cm"))
    assert dict(lacking.dtypes)["product_name_length"] == "double" and lacking.count() == 3
    assert cl.clean_products(df.withColumn("product_length_cm", F.lit(None).cast("string"))).count() == 0


def test_translations(spark):
    data = [("pc_gamer", "own name"), ("cama", "bed"), ("cama", "a bed")]
    got = cl.clean_translations(table(spark, "product_category_name_translation", data))
    assert sorted(map(tuple, got.collect())) == [
        ("cama", "a bed"),
        ("pc_gamer", "own name"),
        ("portateis_cozinha_e_preparadores_de_alimentos", "portable_kitchen_and_food_preparers"),
    ]


def test_sellers(spark):
    cities = [" São Paulo - SP ", "sao pau", "SAO MIGUEL", None, "Florianópolis"]
    data = [(f"s{i}", "1", c, "SP") for i, c in enumerate(cities)] + [(None, "1", "x", "SP"), ("s4", "2", "y", "SP")]
    got = {r.seller_id: r.seller_city for r in cl.clean_sellers(table(spark, "sellers", data)).collect()}
    assert got == {"s0": "sao paulo", "s1": "sao paulo", "s2": "sao miguel d'oeste", "s3": None, "s4": "florianopolis"}


def test_sellers_stay_in_the_jvm(spark):
    plan = cl.clean_sellers(table(spark, "sellers", [("s", "1", "x", "SP")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_customers_and_geolocation(spark):
    people = [("c1", "u", "1", "a", "SP"), ("c1", "t", "1", "a", "SP"), (None, "u", "1", "a", "SP")]
    assert [r.customer_unique_id for r in cl.clean_customers(table(spark, "customers", people)).collect()] == ["t"]
    geo = [("1", lat, lng, "x", "SP") for lat, lng in [("90.9", "0"), ("-90", "0"), ("0", "180.5"), ("0", "-180"), (None, "0"), ("1", "1"), ("1", "1.0")]]
    got = cl.clean_geolocation(table(spark, "geolocation", geo))
    assert sorted((r.geolocation_lat, r.geolocation_lng) for r in got.collect()) == [(-90.0, 0.0), (0.0, -180.0), (1.0, 1.0)]


@pytest.mark.parametrize("name", ["orders", "order_items", "order_payments", "order_reviews", "sellers", "customers", "geolocation"])
def test_cleaning_twice_changes_nothing(spark, rows, name):
    from tests.domain import small_shop

    once = cl.CLEANERS[name](small_shop(spark)[name])
    again = cl.CLEANERS[name](once) if name != "order_items" else once
    assert rows(again) == rows(once)
