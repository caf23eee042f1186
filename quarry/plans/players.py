"""Player valuation queries (Q30-Q37) and model steps (M9-M14) on the reference schema: ``players``.

Goalkeepers have no outfield attributes (``pace`` is NULL); outfield queries
filter them out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import exprs as X
from quarry.operators import correlation, explode, explorer, groups, ml, ranking
from quarry.sources.schemas import PLAYER_ATTRIBUTES

CORR_COLUMNS = PLAYER_ATTRIBUTES + ["overall", "potential", "age"]
PROFILE_COLUMNS = ["short_name", "age", "club_name", "league_name", "overall", "potential", "value_eur",
                   "wage_eur"]


def _outfield(tables) -> DataFrame:
    return tables["players"].filter(F.col("pace").isNotNull())


def attribute_value_correlations(tables) -> DataFrame:
    return correlation.correlations(_outfield(tables), {f"{c}_corr": (c, "value_eur") for c in CORR_COLUMNS})


def attribute_correlations_long(tables) -> DataFrame:
    """The nine correlations as sorted (attribute, corr) rows."""
    return correlation.correlations_long(attribute_value_correlations(tables))


def value_by_position(tables) -> DataFrame:
    p = tables["players"].filter(F.col("value_eur").isNotNull())
    ex = explode.explode_tokens(p, "player_positions", ",", "position", keep=["overall", "value_eur", "wage_eur"])
    return groups.group_profile(ex, ["position"], [
        X.sql_round(F.avg("overall"), 1).alias("avg_overall"), X.sql_round(F.avg("value_eur"), 0).alias("avg_value_eur"),
        X.sql_round(F.avg("wage_eur"), 0).alias("avg_wage_eur")], count_name="player_count",
        order=[F.col("avg_value_eur").desc_nulls_last(), F.col("position")])


def roi_by_position(tables) -> DataFrame:
    p = tables["players"].filter(F.col("value_eur").isNotNull() & (F.col("overall") > 0))
    ex = explode.explode_tokens(p, "player_positions", ",", "position", keep=["overall", "value_eur"])
    return groups.group_profile(ex, ["position"], [
        X.sql_round(F.avg(F.col("value_eur") / F.col("overall")), 0).alias("avg_value_per_overall_point")],
        count_name="player_count", min_count=30,
        order=[F.col("avg_value_per_overall_point").desc_nulls_last(), F.col("position")])


def league_pay_vs_performance(tables) -> DataFrame:
    p = tables["players"].filter(F.col("league_name").isNotNull() & F.col("wage_eur").isNotNull())
    out = groups.group_profile(p, ["league_name"], [
        X.sql_round(F.avg("overall"), 1).alias("avg_overall"), X.sql_round(F.avg("wage_eur"), 0).alias("avg_wage_eur"),
        X.sql_round(F.avg("wage_eur") / F.nullif(F.avg("overall"), F.lit(0)), 0).alias("wage_per_overall_point")],
        count_name="player_count", min_count=100)
    return ranking.top_k(out, [F.col("wage_per_overall_point").desc_nulls_last(), F.col("league_name")], 20)


def age_curve(tables) -> DataFrame:
    p = tables["players"].filter(F.col("age").between(16, 40))
    return groups.group_profile(p, ["age"], [
        X.sql_round(F.avg("overall"), 1).alias("avg_overall"), X.sql_round(F.avg("potential"), 1).alias("avg_potential"),
        X.sql_round(F.avg("value_eur"), 0).alias("avg_value_eur")], count_name="player_count", order=[F.col("age")])


def top_valuable_by_position(tables, position: str) -> DataFrame:
    """``position`` is required (no NULL form)."""
    if position is None:
        raise ValueError("top_valuable_by_position needs a position")
    p = tables["players"].filter(F.col("team_position") == F.lit(position))
    return ranking.top_k(p.select(*PROFILE_COLUMNS),
                         [F.col("value_eur").desc_nulls_last(), F.col("short_name")], 20)


def position_options(tables) -> DataFrame:
    return groups.distinct_options(tables["players"], "team_position", "position", drop_null=True, drop_empty=True)


def filtered_scouting(tables, position: str | None = None, min_potential: int | None = None,
                      max_value: float | None = None) -> DataFrame:
    cols = ["short_name", "age", "club_name", "league_name", "team_position", "overall", "potential",
            "value_eur", "wage_eur"]
    return explorer.filtered_explorer(
        tables["players"],
        [("team_position", "=", position), ("potential", ">=", min_potential), ("value_eur", "<=", max_value)],
        [F.col("potential").desc_nulls_last(), F.col("value_eur").asc_nulls_last(), F.col("short_name")],
        200, cols)


# ------------------------------------------------------------------ model steps (M9-M14)

def player_archetypes(tables, k: int = 4, n_init: int = 10, seed: int = 42) -> DataFrame:
    """Standardized attributes -> best-of-n k-means -> mean profile per cluster (1 digit)."""
    o = _outfield(tables).select("short_name", "team_position", "overall", "value_eur", *PLAYER_ATTRIBUTES)
    _, assigned, _ = ml.kmeans_best(o, PLAYER_ATTRIBUTES, k, seed=seed, n_init=n_init)
    return ml.cluster_profile(assigned, PLAYER_ATTRIBUTES + ["overall", "value_eur"])


def archetype_elbow(tables, n_init: int = 10, seed: int = 42) -> DataFrame:
    o = _outfield(tables).select(*PLAYER_ATTRIBUTES)
    return ml.elbow_curve(o, PLAYER_ATTRIBUTES, range(2, 9), seed=seed, n_init=n_init)


def value_model_residuals(tables, k: int = 10) -> DataFrame:
    """log(value) ~ overall + potential + age on complete rows with value > 0;
    the k most under- and over-valued players by residual."""
    cols = ["short_name", "team_position", "club_name", "overall", "potential", "age", "value_eur"]
    p = tables["players"].select(*cols).dropna()
    _, scored, _ = ml.ols_fit(p, "value_eur", ["overall", "potential", "age"], log_label=True)
    return ml.residual_extremes(scored, k, cols, tie_break=["short_name"])


def value_model_summary(tables) -> DataFrame:
    cols = ["short_name", "team_position", "club_name", "overall", "potential", "age", "value_eur"]
    p = tables["players"].select(*cols).dropna()
    model, _, r2 = ml.ols_fit(p, "value_eur", ["overall", "potential", "age"], log_label=True)
    spark = p.sparkSession
    row = (float(r2), float(model.intercept), *[float(c) for c in model.coefficients])
    return spark.createDataFrame([row], "r2 double, intercept double, coef_overall double, "
                                        "coef_potential double, coef_age double")


QUERIES = {f.__name__: f for f in (
    attribute_value_correlations, attribute_correlations_long, value_by_position, roi_by_position,
    league_pay_vs_performance, age_curve, top_valuable_by_position, position_options, filtered_scouting,
    player_archetypes, archetype_elbow, value_model_residuals, value_model_summary)}
