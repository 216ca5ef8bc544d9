"""Clean tables → one wide commerce table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tradewind.operators.fill import forward_fill
from tradewind.operators.skew import HOT_ROWS, left_join_all
from tradewind.session import stored

# The geo columns, and the ids that the commerce table leaves out.
GEO_ZIP = "geolocation_zip_code_prefix"
GEO_POINT = ("geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state")
DROPPED_IDS = (
    "customer_id",
    "customer_unique_id",
    "order_id",
    "order_item_id",
    "product_id",
    "review_id",
    "product_category_name",
)


def customers_geo_raw(customers: DataFrame, geolocation: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Each customer with each geo row of its ZIP."""
    keyed = geolocation.withColumn("customer_zip_code_prefix", F.col(GEO_ZIP))
    return left_join_all(customers, {"geolocation": keyed}, "customer_zip_code_prefix", hot_rows=hot_rows)


def customers_geo_filled(
    customers: DataFrame, geolocation: DataFrame, hot_rows: int = HOT_ROWS, fill_rows: int = HOT_ROWS
) -> DataFrame:
    """``customers_geo_raw`` with the geo columns filled forward in each ZIP, by customer, latitude and longitude.

    All customers of a ZIP meet the same geo rows in the same order. So what is carried into a customer's rows is the
    same for all but the first one: the geo rows are filled twice in a row, and the first customer of a ZIP joins
    the first round, all others the second. The joined rows, customers × geo rows, are neither sorted nor
    shuffled. Customer ids, and the points of a ZIP, come once, as the cleaners leave them.
    """
    zip_code, place = "customer_zip_code_prefix", "__place"
    columns = [c for c in (GEO_ZIP, *GEO_POINT) if c in geolocation.columns]
    rounds = geolocation.where(F.col(GEO_ZIP).isNotNull()).withColumns(
        {zip_code: F.col(GEO_ZIP), "__later": F.explode(F.array(F.lit(False), F.lit(True)))}
    )
    filled = forward_fill(rounds, columns, zip_code, ["__later", *GEO_POINT[:2]], hot_rows=fill_rows)
    first = customers.groupBy(zip_code).agg(F.min("customer_id").alias("customer_id")).select("customer_id", F.lit(False).alias("__later"))
    people = customers.join(first, "customer_id", "left").withColumn("__later", F.coalesce("__later", F.lit(True)))

    def placed(df):
        return df.withColumn(place, F.when(F.col(zip_code).isNotNull(), F.struct(zip_code, "__later"))).drop("__later")

    joined = left_join_all(placed(people), {"geolocation": placed(filled).drop(zip_code)}, place, hot_rows=hot_rows)
    return joined.select(zip_code, *[c for c in customers.columns if c != zip_code], *geolocation.columns)


def geo_per_zip(geolocation: DataFrame) -> DataFrame:
    """Per ZIP, the first known value of each column, rows taken by position, city and state.

    Aggregates instead of a window: each task reduces a ZIP to one row before the shuffle.
    """
    columns = [c for c in GEO_POINT if c in geolocation.columns]
    order = F.struct(*columns)
    return geolocation.groupBy(GEO_ZIP).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns]
    )


def customers_geo(customers: DataFrame, geolocation: DataFrame | None) -> DataFrame:
    """Each customer once, with one geo row of its ZIP; without geo data, the customers as they are."""
    if geolocation is None:
        return customers
    per_zip = geo_per_zip(geolocation)
    return customers.join(
        per_zip, customers["customer_zip_code_prefix"] == per_zip[GEO_ZIP], "left"
    )


def enrich_items(
    tables: Mapping[str, DataFrame], hot_rows: int = HOT_ROWS, orders: DataFrame | None = None
) -> DataFrame:
    """Items with product, English category and seller; with ``orders``, only the items of these.

    The category name joins at product grain, the rest at item grain, before payments and reviews
    multiply the rows. The dimensions carry no broadcast hint: Spark broadcasts them when they are
    under its size limit and shuffles otherwise.
    """
    items = tables["order_items"]
    if orders is not None:  # narrow rows go to their orders first: those without one are not widened
        ids = orders.select(F.col("order_id").alias("__order"))
        items = items.join(ids, items["order_id"].eqNullSafe(ids["__order"]), "left_semi")
    if "products" in tables:
        products = tables["products"]
        names = tables.get("product_category_name_translation")
        if names is not None and "product_category_name" in products.columns:
            names = names.select("product_category_name", "product_category_name_english")
            products = products.join(names, "product_category_name", "left")
        # Nothing makes product ids unique, so this side may hold a hot key.
        items = left_join_all(
            items,
            {"products": products},
            "product_id",
            hot_rows=hot_rows,
            probe={"base": tables["order_items"], "products": tables["products"]},
        )
    if "sellers" in tables:
        items = items.join(tables["sellers"], "seller_id", "left")
    return items


def _branches(tables: Mapping[str, DataFrame], hot_rows: int, orders: DataFrame):
    branches = {"order_items": enrich_items(tables, hot_rows, orders)}
    probe = {"order_items": tables["order_items"]}
    for name in ("order_payments", "order_reviews"):
        if name in tables:
            branches[name] = probe[name] = tables[name]
    return branches, probe


def build_orders_all(tables: Mapping[str, DataFrame], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Orders with items, payments, reviews, products, categories and sellers.

    One row per order × item × payment × review; an order without any of them keeps one row.
    """
    if "orders" not in tables or "order_items" not in tables:
        return None
    orders = stored(tables["orders"])  # read for its keys, their counts and the join
    branches, probe = _branches(tables, hot_rows, orders)
    return left_join_all(orders, branches, "order_id", hot_rows=hot_rows, probe=probe)


def build_commerce(tables: Mapping[str, DataFrame], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The wide table: customers with geo data, and all their orders; distinct rows, ids left out.

    Customers join at order grain and dimensions at item grain. Then every input is partitioned by
    order once and the rows are multiplied in place: the multiplied rows are never shuffled. Rows
    are made distinct before that too (see ``left_join_all``).
    """
    if any(name not in tables for name in ("customers", "orders", "order_items")):
        return None
    people = customers_geo(tables["customers"], tables.get("geolocation"))
    base = stored(people.join(tables["orders"], "customer_id"))  # read for its keys, their counts and the join
    branches, probe = _branches(tables, hot_rows, base)
    rows = left_join_all(
        base, branches, "order_id", unique_rows=True, hot_rows=hot_rows, probe=probe
    )
    return rows.drop(*DROPPED_IDS)
