"""Declared schemas of the reference's five data sets and their CSV loaders.

Only the columns the queries use are declared; names are snake_case in Spark.
Each ``load_*`` returns ``{table: DataFrame}`` ready for the plans in
``quarry.plans`` or for ``quarry.sources.etl.load_tables``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from quarry.sources.csv import LEGACY_ENCODING, PANDAS_NA_WORDS, Col, read_csv

RESTAURANTS = [
    Col("Restaurant Name", "restaurant_name"), Col("Country Code", "country_code", "int"),
    Col("City", "city"), Col("Cuisines", "cuisines"),
    Col("Average Cost for two", "average_cost_for_two", "double"),
    Col("Price range", "price_range", "int"), Col("Aggregate rating", "aggregate_rating", "double"),
    Col("Rating text", "rating_text"), Col("Has Online delivery", "has_online_delivery"),
    Col("Has Table booking", "has_table_booking"), Col("Votes", "votes", "int"),
]
COUNTRY_CODES = [Col("Country Code", "country_code", "int"), Col("Country", "country")]

PRODUCTS = [
    Col("product_name", "product_name"), Col("brand", "brand"),
    Col("product_category_tree", "product_category_tree"),
    Col("retail_price", "retail_price", "double"), Col("discounted_price", "discounted_price", "double"),
    Col("product_rating", "product_rating"),
]

# Personal columns of the supply-chain file, never loaded.
SUPPLY_PRIVATE_COLUMNS = ["Customer Email", "Customer Fname", "Customer Lname", "Customer Password",
                          "Customer Street", "Customer Zipcode", "Order Zipcode", "Product Image",
                          "Product Description"]
SUPPLY_ORDERS = [
    Col("Order Id", "order_id", "long"), Col("Order Customer Id", "order_customer_id", "long"),
    Col("order date (DateOrders)", "order_date_text"), Col("Shipping Mode", "shipping_mode"),
    Col("Order Region", "order_region"), Col("Market", "market"), Col("Category Name", "category_name"),
    Col("Product Name", "product_name"), Col("Days for shipping (real)", "days_for_shipping_real", "int"),
    Col("Days for shipment (scheduled)", "days_for_shipment_scheduled", "int"),
    Col("Late_delivery_risk", "late_delivery_risk", "int"),
    Col("Order Item Quantity", "order_item_quantity", "int"), Col("Order Item Total", "order_item_total", "double"),
    Col("Order Item Profit Ratio", "order_item_profit_ratio", "double"), Col("Sales", "sales", "double"),
]

PLAYER_ATTRIBUTES = ["pace", "shooting", "passing", "dribbling", "defending", "physic"]
PLAYERS = ([Col(c, c) for c in ("short_name", "club_name", "league_name", "team_position", "player_positions")]
           + [Col(c, c, "int") for c in ("age", "overall", "potential")]
           + [Col(c, c, "double") for c in ("value_eur", "wage_eur", *PLAYER_ATTRIBUTES)])

ECOMMERCE = {
    "orders": [Col("order_id", "order_id"), Col("customer_id", "customer_id"), Col("order_status", "order_status"),
               Col("order_purchase_timestamp", "order_purchase_timestamp", "timestamp_ntz"),
               Col("order_delivered_customer_date", "order_delivered_customer_date", "timestamp_ntz"),
               Col("order_estimated_delivery_date", "order_estimated_delivery_date", "timestamp_ntz")],
    "customers": [Col("customer_id", "customer_id"), Col("customer_unique_id", "customer_unique_id"),
                  Col("customer_state", "customer_state")],
    "order_items": [Col("order_id", "order_id"), Col("order_item_id", "order_item_id", "int"),
                    Col("product_id", "product_id"), Col("price", "price", "double")],
    "order_payments": [Col("order_id", "order_id"), Col("payment_type", "payment_type"),
                       Col("payment_installments", "payment_installments", "int"),
                       Col("payment_value", "payment_value", "double")],
    "order_reviews": [Col("order_id", "order_id"), Col("review_score", "review_score", "int")],
    "products": [Col("product_id", "product_id"), Col("product_category_name", "product_category_name")],
    "category_translation": [Col("product_category_name", "product_category_name"),
                             Col("product_category_name_english", "product_category_name_english")],
    "sellers": [Col("seller_id", "seller_id"), Col("seller_zip_code_prefix", "seller_zip_code_prefix", "long"),
                Col("seller_city", "seller_city"), Col("seller_state", "seller_state")],
    "geolocation": [Col("geolocation_zip_code_prefix", "geolocation_zip_code_prefix", "long"),
                    Col("geolocation_lat", "geolocation_lat", "double"), Col("geolocation_lng", "geolocation_lng", "double"),
                    Col("geolocation_city", "geolocation_city"), Col("geolocation_state", "geolocation_state")],
}
# tables whose free-text fields (review comments) hold quoted newlines
ECOMMERCE_MULTILINE = {"order_reviews"}


def load_restaurants(spark: SparkSession, restaurants_csv: str, country_codes_path: str) -> dict[str, DataFrame]:
    """Latin-1 restaurant CSV (pandas missing words) and the country lookup
    (CSV, or Parquet when the path ends in .parquet; Excel is not read)."""
    r = read_csv(spark, restaurants_csv, RESTAURANTS, encoding=LEGACY_ENCODING, null_words=PANDAS_NA_WORDS,
                 multiline=True)  # free-text names may hold quoted newlines
    if country_codes_path.endswith(".parquet"):
        cc = spark.read.parquet(country_codes_path)
    else:
        cc = read_csv(spark, country_codes_path, COUNTRY_CODES, null_words=PANDAS_NA_WORDS)
    return {"restaurants": r, "country_codes": cc}


def load_products(spark: SparkSession, path: str, infer: bool = True) -> dict[str, DataFrame]:
    """The product list; columns that are not declared are typed from all rows unless ``infer`` is off."""
    # product descriptions (not loaded, but parsed) span lines inside quotes
    return {"products": read_csv(spark, path, PRODUCTS, multiline=True, infer=infer)}


def load_supply_chain(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {"orders": read_csv(spark, path, SUPPLY_ORDERS, encoding=LEGACY_ENCODING,
                               null_words=PANDAS_NA_WORDS, drop=SUPPLY_PRIVATE_COLUMNS)}


def load_players(spark: SparkSession, path: str, infer: bool = True) -> dict[str, DataFrame]:
    """The player list; columns that are not declared are typed from all rows unless ``infer`` is off."""
    return {"players": read_csv(spark, path, PLAYERS, infer=infer)}


def load_ecommerce(spark: SparkSession, folder: str,
                   files: dict[str, str] | None = None, infer: bool = True) -> dict[str, DataFrame]:
    """The nine star-schema tables from ``folder``; ``files`` maps a table name to
    its file name when it is not ``<table>.csv``. Columns that are not declared are
    typed from all rows unless ``infer`` is off."""
    files = files or {}
    out = {}
    for name, cols in ECOMMERCE.items():
        out[name] = read_csv(spark, os.path.join(folder, files.get(name, f"{name}.csv")), cols,
                             multiline=name in ECOMMERCE_MULTILINE, partial=name in ("sellers", "geolocation"),
                             infer=infer)
    return out
