"""Small hand-made tables in the domain schema."""

from __future__ import annotations

from datetime import datetime

from tradewind.sources.schema import TABLES


def ts(text):
    return datetime.strptime(text, "%Y-%m-%d %H:%M") if text else None


def table(spark, name, data, **kinds):
    """Rows for ``name``: all columns text unless ``kinds`` says otherwise; short rows end in NULLs."""
    columns = list(TABLES[name])
    schema = ", ".join(f"`{c}` {kinds.get(c, 'string')}" for c in columns)
    return spark.createDataFrame([tuple(r) + (None,) * (len(columns) - len(r)) for r in data], schema)


TIMES = {
    c: "timestamp"
    for c in (
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        "shipping_limit_date",
        "review_creation_date",
        "review_answer_timestamp",
    )
}


def small_shop(spark):
    """Order o1: 2 items × 2 payments × 2 reviews; o2: nothing; o3: one item of an unknown product."""
    day = lambda d: ts(f"2018-01-{d:02d} 00:00")
    orders = [
        ("o1", "c1", "delivered", day(1), day(1), day(2), day(9), day(5)),
        ("o2", "c2", "created", day(3), None, None, None, day(20)),
        ("o3", "c1", "delivered", day(2), day(2), day(3), day(4), day(20)),
        ("o4", "c9", "delivered", day(2), day(2), day(3), day(4), day(20)),
    ]
    items = [
        ("o1", "1", "p1", "s1", day(3), "10.50", "1.0"),
        ("o1", "2", "p2", "s1", day(3), "0.85", "0"),
        ("o3", "1", "p404", "s404", day(3), "5.25", "2.0"),
    ]
    payments = [
        ("o1", "1", "boleto", "1", "6.00"),
        ("o1", "2", "voucher", "10", "5.35"),
        ("o3", "1", "credit_card", "2", "7.25"),
    ]
    reviews = [("r1", "o1", "5"), ("r2", "o1", "1")]
    customers = [("c1", "u1", "100", "city", "SP"), ("c2", "u2", "200", "city", "RJ")]
    sellers = [("s1", "100", " São Paulo - SP ", "SP")]
    products = [
        ("p1", "cama", "5", "5", "1", "10", "1", "1", "1"),
        ("p2", "pc_gamer", "5", "5", "1", "30", "1", "1", "1"),
    ]
    geo = [("100", "-23.5", "-46.6", "sao paulo", "SP"), ("100", "-23.4", "-46.5", "sao paulo", "SP")]
    names = [("cama", "bed")]
    return {
        "orders": table(spark, "orders", orders, **TIMES),
        "order_items": table(spark, "order_items", items, **TIMES),
        "order_payments": table(spark, "order_payments", payments),
        "order_reviews": table(spark, "order_reviews", reviews, **TIMES),
        "customers": table(spark, "customers", customers),
        "sellers": table(spark, "sellers", sellers),
        "products": table(spark, "products", products),
        "geolocation": table(spark, "geolocation", geo),
        "product_category_name_translation": table(spark, "product_category_name_translation", names),
    }
