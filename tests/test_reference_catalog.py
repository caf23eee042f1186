"""The reference-schema catalogue on small CSV fixtures written by the test.

Covers the sources (typed CSV, latin-1, missing words, privacy drop, ETL with
audit, store opening) and runs every named query of the five projects,
checking the semantics that matter against plain-Python expectations.
"""

import csv
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from quarry import catalog
from quarry.sources import etl, schemas
from quarry.sources.tables import open_store

N_REST = 150


def _write(path, header, rows, encoding="utf-8"):
    with open(path, "w", newline="", encoding=encoding) as f:
        w = csv.writer(f, quoting=csv.QUOTE_MINIMAL)
        w.writerow(header)
        w.writerows(rows)


def _restaurant_rows():
    cuisines = ["North Indian, Chinese", "Cafe", "Italian, Pizza, Cafe", "NA", ""]
    rows = []
    for i in range(N_REST):
        rating = 0.0 if i % 5 == 0 else round(2.5 + (i % 25) / 10, 1)
        rows.append([f"Resto {i}", [1, 14, 216][i % 3], ["Delhi", "Pune", "Doha", "Agra"][i % 4],
                     cuisines[i % 5], float((i % 7) * 250), 1 + i % 4, rating,
                     "Excellent" if rating >= 4 else "Average", "Yes" if i % 2 else "No",
                     "No" if i % 3 else "Yes", i * 3])
    rows.append(["Café Zoé", 1, "Delhi", "French", 900.0, 3, 4.5, "Excellent", "No", "Yes", 40])
    rows.append(["Big, Bold\nBistro", 14, "Pune", "Cafe", 400.0, 2, 3.9, "Good", "Yes", "No", 12])
    return rows


@pytest.fixture(scope="module")
def fixture_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("refdata")
    # restaurants (latin-1) and the country lookup
    _write(d / "restaurants.csv", ["Restaurant Name", "Country Code", "City", "Cuisines", "Average Cost for two",
                              "Price range", "Aggregate rating", "Rating text", "Has Online delivery",
                              "Has Table booking", "Votes"], _restaurant_rows(), encoding="latin-1")
    _write(d / "country_codes.csv", ["Country Code", "Country"], [[1, "India"], [14, "Australia"],
                                                                  [216, "United States"]])
    # products
    prod = []
    for i in range(180):
        cat = ["Clothing", "Footwear", "Jewellery"][i % 3]
        retail = float(100 + (i * 37) % 3000) if i % 17 else 0.0
        prod.append([f"Product {i}", f"Brand{i % 4}" if i % 11 else "", f'["{cat} >> Sub {i % 5} >> Leaf"]',
                     retail, round(retail * (0.5 + (i % 5) / 10), 2),
                     ["No rating available", "4.2", "3", "4d"][i % 4]])
    prod.append(["Outlier", "BrandX", '["Clothing >> Sub"]', 99000.0, 50000.0, "5"])
    _write(d / "products.csv", ["product_name", "brand", "product_category_tree", "retail_price",
                                "discounted_price", "product_rating"], prod)
    # supply chain orders, with personal columns that must never load
    sc = []
    for i in range(260):
        day = dt.datetime(2017, 1, 1) + dt.timedelta(days=(i * 13) % 700, hours=i % 24, minutes=i % 60)
        text = f"{day.month}/{day.day}/{day.year} {day.hour}:{day.minute:02d}"
        real, sched = i % 6, [4, 2, 1, 0][i % 4]
        sc.append([i, 1000 + i % 40, text, ["Standard Class", "First Class", "Second Class", "Same Day"][i % 4],
                   ["West", "East", "South"][i % 3], ["LATAM", "Europe"][i % 2], ["Cleats", "Fishing"][i % 2],
                   f"Item {i % 3}", real, sched, int(real > sched), 1 + i % 5, 50.0 + i, 0.1 * (i % 4),
                   60.0 + i, f"user{i}@mail", "First", "Last", "secret", "Main St", "12345", "54321", "img",
                   "desc"])
    _write(d / "supply.csv", ["Order Id", "Order Customer Id", "order date (DateOrders)", "Shipping Mode",
                              "Order Region", "Market", "Category Name", "Product Name", "Days for shipping (real)",
                              "Days for shipment (scheduled)", "Late_delivery_risk", "Order Item Quantity",
                              "Order Item Total", "Order Item Profit Ratio", "Sales"]
           + schemas.SUPPLY_PRIVATE_COLUMNS, sc, encoding="latin-1")
    # players (goalkeepers have no pace)
    pl = []
    for i in range(140):
        gk = i % 10 == 0
        attrs = [""] * 6 if gk else [50 + (i * k) % 40 for k in range(1, 7)]
        pl.append([f"P{i}", f"Club {i % 7}", ["Liga A", "Liga B"][i % 2] if i % 13 else "", "GK" if gk else
                   ["ST", "CB", "", "CM"][i % 4], "GK" if gk else ["ST, CF", "CB", "CM, CDM, CAM", "RW, ST"][i % 4],
                   17 + i % 20, 55 + i % 35, 60 + i % 35, float(10000 * (1 + i % 50)) if i % 19 else 0.0,
                   float(500 * (1 + i % 30))] + attrs)
    _write(d / "players.csv", ["short_name", "club_name", "league_name", "team_position", "player_positions",
                               "age", "overall", "potential", "value_eur", "wage_eur"] + schemas.PLAYER_ATTRIBUTES, pl)
    # e-commerce star
    ec = d / "shop"
    ec.mkdir()
    orders, customers, items, pays, revs = [], [], [], [], []
    for i in range(120):
        cid, person = f"c{i}", f"u{i % 45}"
        buy = dt.datetime(2017, 1 + i % 12, 1 + i % 27, 10, 0)
        deliv = buy + dt.timedelta(days=5 + i % 20)
        est = buy + dt.timedelta(days=15)
        status = "delivered" if i % 9 else "canceled"
        orders.append([f"o{i}", cid, status, buy.isoformat(sep=" "),
                       deliv.isoformat(sep=" ") if i % 23 else "", est.isoformat(sep=" ")])
        customers.append([cid, person, ["SP", "RJ", "MG"][i % 3]])
        for j in range(1 + i % 3):
            items.append([f"o{i}", j + 1, f"p{(i + j) % 15}", 10.0 + i + j])
        pays.append([f"o{i}", ["credit_card", "boleto"][i % 2], 1 + i % 4, 20.0 + i])
        for _ in range(i % 3):
            revs.append([f"o{i}", 1 + i % 5])
    _write(ec / "orders.csv", ["order_id", "customer_id", "order_status", "order_purchase_timestamp",
                                              "order_delivered_customer_date", "order_estimated_delivery_date"], orders)
    _write(ec / "customers.csv", ["customer_id", "customer_unique_id", "customer_state"], customers)
    _write(ec / "order_items.csv", ["order_id", "order_item_id", "product_id", "price"], items)
    _write(ec / "order_payments.csv", ["order_id", "payment_type", "payment_installments",
                                                      "payment_value"], pays)
    _write(ec / "order_reviews.csv", ["order_id", "review_score"], revs)
    _write(ec / "products.csv", ["product_id", "product_category_name"],
           [[f"p{k}", ["beleza", "esporte", "", "livros"][k % 4]] for k in range(15)])
    _write(ec / "category_translation.csv", ["product_category_name", "product_category_name_english"],
           [["beleza", "health_beauty"], ["esporte", "sports"]])
    _write(ec / "sellers.csv", ["seller_id", "seller_state"], [["s1", "SP"]])
    _write(ec / "geolocation.csv", ["zip", "lat", "lng"], [["01000", "-23.5", "-46.6"]])
    return d


@pytest.fixture(scope="module")
def data(spark, fixture_dir):
    d = str(fixture_dir)
    out = {}
    out["restaurants"] = schemas.load_restaurants(spark, f"{d}/restaurants.csv", f"{d}/country_codes.csv")
    out["pricing"] = schemas.load_products(spark, f"{d}/products.csv")
    out["supply_chain"] = schemas.load_supply_chain(spark, f"{d}/supply.csv")
    out["players"] = schemas.load_players(spark, f"{d}/players.csv")
    out["ecommerce"] = schemas.load_ecommerce(spark, f"{d}/shop")
    return out


def test_every_reference_query_runs(data):
    for name in catalog.list_query_names():
        project = name.split(".")[0]
        params = {"position": "ST"} if name.endswith("top_valuable_by_position") else {}
        if name.endswith(("player_archetypes", "archetype_elbow")):
            params["n_init"] = 2
        df = catalog.run_query(data[project], name, **params)
        df.collect()


def test_csv_decoding_and_missing_words(data):
    r = data["restaurants"]["restaurants"]
    names = {x.restaurant_name for x in r.select("restaurant_name").collect()}
    assert "Café Zoé" in names and "Big, Bold\nBistro" in names
    assert r.count() == N_REST + 2
    assert r.filter(F.col("cuisines").isNull()).count() == 2 * N_REST // 5  # 'NA' and '' are missing


def test_privacy_columns_never_loaded(data):
    o = data["supply_chain"]["orders"]
    assert not any("customer_email" in c or "password" in c for c in o.columns)
    assert "Customer Email" not in o.columns


def test_sentinel_rating_and_lookup_join(data):
    res = {r.country: r for r in catalog.run_query(data["restaurants"], "restaurants.restaurants_per_country").collect()}
    rows = _restaurant_rows()
    india = [x for x in rows if x[1] == 1]
    rated = [x[6] for x in india if x[6] > 0]
    assert res["India"].restaurant_count == len(india)
    assert res["India"].avg_rating == round(sum(rated) / len(rated), 2)


def test_explode_and_optional_parameters(data):
    tc = {r.cuisine: r.restaurant_count for r in
          catalog.run_query(data["restaurants"], "restaurants.top_cuisines_by_count").collect()}
    assert tc["Cafe"] == 2 * (N_REST // 5) + 1 and "" not in tc
    all_rows = catalog.run_query(data["restaurants"], "restaurants.filtered_restaurants").count()
    some = catalog.run_query(data["restaurants"], "restaurants.filtered_restaurants", city="Delhi", min_rating=4.0)
    assert all_rows == min(200, N_REST + 2)
    assert all(r.city == "Delhi" and r.rating >= 4.0 for r in some.collect())


def test_dirty_rating_and_outliers(data):
    c = catalog.run_query(data["pricing"], "pricing.discount_vs_rating_correlation").first()
    assert c.rated_product_count == 2 * 180 // 4 - sum(1 for i in range(180) if i % 17 == 0 and i % 4 in (1, 2)) + 1
    exact = {r.category: r for r in catalog.run_query(data["pricing"], "pricing.category_price_percentiles").collect()}
    approx = {r.category: r for r in catalog.run_query(data["pricing"], "pricing.category_price_percentiles",
                                                       exact=False).collect()}
    assert exact.keys() == approx.keys() and all(exact[k].product_count == approx[k].product_count for k in exact)
    out = catalog.run_query(data["pricing"], "pricing.price_outliers").collect()
    assert [r.product_name for r in out] == ["Outlier"]


def test_rfm_segments_cover_customers(data):
    r = catalog.run_query(data["supply_chain"], "supply_chain.rfm_analysis")
    assert r.count() == 40
    assert set(r.select("recency_score").distinct().toPandas().recency_score) == {1, 2, 3, 4}
    s = catalog.run_query(data["supply_chain"], "supply_chain.rfm_segment_summary")
    assert s.agg(F.sum("customer_count")).first()[0] == 40


def test_player_queries(data):
    corr = catalog.run_query(data["players"], "players.attribute_value_correlations").first()
    assert len(corr) == 9
    top = catalog.run_query(data["players"], "players.top_valuable_by_position", position="CB").collect()
    assert top and all(r.value_eur is not None for r in top)
    with pytest.raises(ValueError):
        catalog.run_query(data["players"], "players.top_valuable_by_position", position=None)
    summary = catalog.run_query(data["players"], "players.value_model_summary").first()
    assert 0.0 <= summary.r2 <= 1.0
    ext = catalog.run_query(data["players"], "players.value_model_residuals").collect()
    under = [r.residual for r in ext if r.side == "under"]
    over = [r.residual for r in ext if r.side == "over"]
    assert len(under) == len(over) == 10 and max(under) <= min(over)
    longform = catalog.run_query(data["players"], "players.attribute_correlations_long").collect()
    assert {r.attribute for r in longform} == {"pace", "shooting", "passing", "dribbling", "defending",
                                               "physic", "overall", "potential", "age"}


def test_ecommerce_identity_and_fanout(data):
    k = catalog.run_query(data["ecommerce"], "ecommerce.kpi_summary").first()
    delivered = [i for i in range(120) if i % 9]
    assert k.total_orders == len(delivered)
    assert k.total_customers == len({i % 45 for i in delivered})
    rr = catalog.run_query(data["ecommerce"], "ecommerce.repeat_purchase_rate").first()
    assert rr.total_customers == k.total_customers
    cat = catalog.run_query(data["ecommerce"], "ecommerce.top_categories").collect()
    assert {r.category for r in cat} <= {"health_beauty", "sports", "unknown", "livros"}


def test_etl_roundtrip_and_store(spark, data, tmp_path):
    dst = str(tmp_path / "store")
    audit = {r.table: r.row_count for r in etl.load_tables(spark, data["ecommerce"], dst).collect()}
    assert audit["orders"] == 120 and audit["sellers"] == 1
    store = open_store(spark, dst, list(data["ecommerce"]))
    assert store["orders"].count() == 120
    # the same named query over the persisted store and over the CSV sources
    from_store = catalog.run_query(store, "ecommerce.kpi_summary").first()
    from_csv = catalog.run_query(data["ecommerce"], "ecommerce.kpi_summary").first()
    assert from_store == from_csv
    with pytest.raises(FileNotFoundError):
        open_store(spark, str(tmp_path / "missing"), ["orders"])
    with pytest.raises(FileNotFoundError, match="refunds"):
        open_store(spark, f"file://{dst}", ["orders", "refunds"])
    assert open_store(spark, f"file://{dst}", ["orders"])["orders"].count() == 120
    catalog.register_views({"shop_orders": store["orders"]})
    assert spark.sql("SELECT COUNT(*) AS n FROM shop_orders").first().n == 120
    open_store(spark, dst, ["sellers"]).register()
    assert spark.sql("SELECT COUNT(*) AS n FROM sellers").first().n == 1
    assert os.path.exists(f"{dst}/orders.parquet")
