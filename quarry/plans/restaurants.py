"""Restaurant queries (Q1-Q12) on the reference schema: ``restaurants``, ``country_codes``.

Every function takes ``tables`` (name -> DataFrame) plus its parameters. A
rating of 0 means "not rated": excluded from rating averages, kept in counts.
Ties that a LIMIT would cut are broken by the entity name.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import exprs as X
from quarry.operators import correlation, explode, explorer, groups, ranking

RATING, COST = "aggregate_rating", "average_cost_for_two"


def _rated_avg(digits: int = 2):
    return X.sql_round(X.avg_where(RATING, F.col(RATING) > 0), digits).alias("avg_rating")


def _avg_cost():
    return X.sql_round(F.avg(COST), 2).alias("avg_cost_for_two")


def restaurants_per_country(tables: Mapping[str, DataFrame]) -> DataFrame:
    r, cc = tables["restaurants"], tables["country_codes"]
    # no size is proven for a user-supplied lookup: AQE broadcasts it from its measured size
    j = r.join(cc.select("country_code", "country"), "country_code")
    return groups.group_profile(j, ["country"], [_rated_avg(), _avg_cost()], count_name="restaurant_count",
                                order=[F.col("restaurant_count").desc(), F.col("country")])


def top_cities_by_count(tables) -> DataFrame:
    return groups.group_profile(tables["restaurants"], [F.col("city")], [_rated_avg(), _avg_cost()],
                                count_name="restaurant_count",
                                order=[F.col("restaurant_count").desc(), F.col("city")], limit=20)


def top_cuisines_by_count(tables) -> DataFrame:
    ex = explode.explode_tokens(tables["restaurants"], "cuisines", ",", "cuisine")
    return groups.group_profile(ex, ["cuisine"], [], count_name="restaurant_count",
                                order=[F.col("restaurant_count").desc(), F.col("cuisine")], limit=20)


def top_cuisines_by_rating(tables) -> DataFrame:
    r = tables["restaurants"].filter(F.col(RATING) > 0)
    ex = explode.explode_tokens(r, "cuisines", ",", "cuisine", keep=[RATING])
    return groups.group_profile(ex, ["cuisine"], [X.sql_round(F.avg(RATING), 2).alias("avg_rating")],
                                count_name="restaurant_count", min_count=20,
                                order=[F.col("avg_rating").desc_nulls_last(), F.col("cuisine")], limit=20)


def cost_rating_correlation(tables) -> DataFrame:
    r = tables["restaurants"].filter(F.col(RATING) > 0)
    return correlation.correlations(r, {"cost_vs_rating": (COST, RATING),
                                        "price_range_vs_rating": ("price_range", RATING)})


def rating_by_price_range(tables) -> DataFrame:
    return groups.group_profile(tables["restaurants"], ["price_range"], [_rated_avg(), _avg_cost()],
                                count_name="restaurant_count", order=[F.col("price_range").asc_nulls_last()])


def rating_distribution(tables) -> DataFrame:
    r = tables["restaurants"].filter(F.col(RATING) > 0)
    return groups.group_profile(r, ["rating_text"], [X.sql_round(F.avg(RATING), 2).alias("avg_rating")],
                                count_name="restaurant_count",
                                order=[F.col("avg_rating").desc_nulls_last(), F.col("rating_text")])


def best_value_restaurants(tables) -> DataFrame:
    r = tables["restaurants"].filter((F.col(RATING) >= 4.0) & (F.col(COST) > 0))
    r = r.select("restaurant_name", "city", "cuisines", F.col(COST).alias("cost_for_two"),
                 F.col(RATING).alias("rating"),
                 X.sql_round(X.safe_divide(RATING, COST) * F.lit(1000.0), 3).alias("value_score"))
    return ranking.top_k(r, [F.col("value_score").desc_nulls_last(), F.col("restaurant_name")], 20)


def online_delivery_impact(tables) -> DataFrame:
    return groups.group_profile(tables["restaurants"], ["has_online_delivery"],
                                [_rated_avg(), X.sql_round(F.avg("votes"), 1).alias("avg_votes")],
                                count_name="restaurant_count")


def table_booking_impact(tables) -> DataFrame:
    return groups.group_profile(tables["restaurants"], ["has_table_booking"], [_rated_avg(), _avg_cost()],
                                count_name="restaurant_count")


def city_options(tables) -> DataFrame:
    return groups.distinct_options(tables["restaurants"], "city", "city")


def filtered_restaurants(tables, city: str | None = None, min_rating: float | None = None) -> DataFrame:
    r = tables["restaurants"]
    cols = ["restaurant_name", "city", "cuisines", F.col(COST).alias("cost_for_two"), "price_range",
            F.col(RATING).alias("rating"), "votes"]
    return explorer.filtered_explorer(
        r, [("city", "=", city), (RATING, ">=", min_rating)],
        [F.col(RATING).desc_nulls_last(), F.col("votes").desc_nulls_last(), F.col("restaurant_name")],
        200, cols)


QUERIES = {f.__name__: f for f in (
    restaurants_per_country, top_cities_by_count, top_cuisines_by_count, top_cuisines_by_rating,
    cost_rating_correlation, rating_by_price_range, rating_distribution, best_value_restaurants,
    online_delivery_impact, table_booking_impact, city_options, filtered_restaurants)}
