"""Product pricing queries (Q13-Q21) on the reference schema: ``products``.

The category is the first segment of the bracketed path
``["A >> B >> C"]``; discount % is NULL where the list price is not positive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import exprs as X
from quarry.operators import distribution, explorer, groups, ranking

# Price tier cut points and labels.
PRICE_TIERS = [(500, "1. Budget (<500)"), (2000, "2. Mid (500-2000)"), (10000, "3. Premium (2000-10000)")]
PRICE_TIER_TOP = "4. Luxury (10000+)"


def _categorized(products: DataFrame, discount_digits: int | None = 1) -> DataFrame:
    return (products.withColumn("category", X.path_segment("product_category_tree", ">>", 1))
            .withColumn("discount_pct", X.discount_pct("retail_price", "discounted_price", discount_digits)))


def category_overview(tables) -> DataFrame:
    p = _categorized(tables["products"]).filter(
        F.col("retail_price").isNotNull() & F.col("discounted_price").isNotNull())
    return groups.group_profile(p, ["category"], [
        X.sql_round(F.avg("retail_price"), 2).alias("avg_retail_price"),
        X.sql_round(F.avg("discounted_price"), 2).alias("avg_discounted_price"),
        X.sql_round(F.avg("discount_pct"), 2).alias("avg_discount_pct")], count_name="product_count",
        order=[F.col("product_count").desc(), F.col("category")], limit=20)


def category_price_percentiles(tables, exact: bool = True) -> DataFrame:
    """Exact quartiles by default (found by sketches and counts); ``exact=False`` uses
    ``percentile_approx`` sketches, one bounded buffer per group."""
    p = _categorized(tables["products"]).filter(F.col("retail_price") > 0)
    d = distribution.distribution_by_group(p, ["category"], "retail_price", min_count=50,
                                           count_name="product_count", exact=exact,
                                           decimal_scale=9 if exact else None)
    out = d.select("category", "product_count", F.col("avg_value").alias("avg_price"),
                   F.col("median_value").alias("median_price"), "q1", "q3",
                   F.col("value_range").alias("price_range"))
    return ranking.top_k(out, [F.col("product_count").desc(), F.col("category")], 15)


def price_tier_binning(tables) -> DataFrame:
    p = tables["products"].filter(F.col("retail_price").isNotNull() & F.col("discounted_price").isNotNull())
    p = (p.withColumn("price_tier", X.tier_bin("retail_price", PRICE_TIERS, PRICE_TIER_TOP))
         .withColumn("discount_pct", X.discount_pct("retail_price", "discounted_price")))
    return groups.group_profile(p, ["price_tier"], [
        X.sql_round(F.avg("retail_price"), 2).alias("avg_retail_price"),
        X.sql_round(F.avg("discount_pct"), 2).alias("avg_discount_pct")], count_name="product_count",
        order=[F.col("price_tier")])


def top_discounted_products(tables) -> DataFrame:
    p = _categorized(tables["products"]).filter(
        (F.col("retail_price") > 0) & F.col("discounted_price").isNotNull())
    top = ranking.topk_by_cut(p, ["category"], ["discount_pct"], [F.col("discount_pct").desc_nulls_last()], 3)
    return top.select("category", "product_name", "brand", "retail_price", "discounted_price",
                      "discount_pct").orderBy(F.col("category").asc_nulls_last(),
                                              F.col("discount_pct").desc_nulls_last())


def brand_pricing(tables) -> DataFrame:
    p = tables["products"].filter(F.col("brand").isNotNull() & F.col("retail_price").isNotNull())
    return groups.group_profile(p, ["brand"], [
        X.sql_round(F.avg("retail_price"), 2).alias("avg_retail_price"),
        X.sql_round(F.avg("discounted_price"), 2).alias("avg_discounted_price")], count_name="product_count",
        min_count=30, order=[F.col("product_count").desc(), F.col("brand")], limit=20)


def discount_vs_rating_correlation(tables) -> DataFrame:
    p = tables["products"].withColumn("rating", X.safe_double("product_rating"))
    p = p.filter(F.col("rating").isNotNull() & (F.col("retail_price") > 0))
    p = p.withColumn("discount_pct", X.discount_pct("retail_price", "discounted_price"))
    return p.agg(X.sql_round(X.safe_corr("discount_pct", "rating"), 3).alias("discount_vs_rating_corr"),
                 F.count(F.lit(1)).alias("rated_product_count"))


def price_outliers(tables) -> DataFrame:
    p = _categorized(tables["products"]).filter(F.col("retail_price") > 0).select(
        "category", "product_name", "brand", "retail_price")
    out = distribution.group_outliers(p, ["category"], "retail_price", factor=10.0, min_count=20)
    out = out.select("category", "product_name", "brand", "retail_price",
                     F.col("median_value").alias("median_price"), "x_median")
    return ranking.top_k(out, [F.col("x_median").desc_nulls_last(), F.col("product_name")], 20)


def category_options(tables) -> DataFrame:
    p = _categorized(tables["products"])
    return groups.counted_options(p, "category", "category", min_count=20, count_name="product_count")


def filtered_products(tables, category: str | None = None, max_price: float | None = None) -> DataFrame:
    p = _categorized(tables["products"]).filter(F.col("retail_price").isNotNull())
    cols = ["product_name", "brand", "category", "retail_price", "discounted_price", "discount_pct"]
    return explorer.filtered_explorer(
        p, [("category", "=", category), ("retail_price", "<=", max_price)],
        [F.col("discount_pct").desc_nulls_last(), F.col("product_name")], 200, cols)


QUERIES = {f.__name__: f for f in (
    category_overview, category_price_percentiles, price_tier_binning, top_discounted_products, brand_pricing,
    discount_vs_rating_correlation, price_outliers, category_options, filtered_products)}
