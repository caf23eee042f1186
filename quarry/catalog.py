"""Named queries with optional parameters: ``run_query`` / ``list_query_names``.

Two catalogues share the same operators:

* the reference-schema catalogue, ``<project>.<query>`` over the five data
  sets as loaded by ``quarry.sources.schemas`` (restaurants, pricing,
  supply_chain, players, ecommerce);
* the test-table catalogue (``quarry.plans.testdata``), the same computations
  on the TPC-H-like tables, used by the driver contract and the bench.

A parameter left as ``None`` means "no filter", as a NULL bind does in SQL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from quarry.plans import ecommerce, players, pricing, restaurants, supply_chain

PROJECTS = {
    "restaurants": restaurants.QUERIES,
    "pricing": pricing.QUERIES,
    "supply_chain": supply_chain.QUERIES,
    "players": players.QUERIES,
    "ecommerce": ecommerce.QUERIES,
}


def list_query_names(project: str | None = None) -> list[str]:
    """Qualified names ``project.query`` (all projects, or one)."""
    projects = [project] if project else list(PROJECTS)
    return [f"{p}.{q}" for p in projects for q in PROJECTS[p]]


def run_query(tables: Mapping[str, DataFrame], name: str, **params) -> DataFrame:
    """Run ``project.query`` over ``tables`` (table name -> DataFrame) with parameters.

    The caller collects, shows or writes the resulting DataFrame. Queries with percentiles, NTILE or a
    model fit run jobs here, as their plans depend on what those find; all others are lazy.
    """
    project, _, query = name.partition(".")
    try:
        fn = PROJECTS[project][query]
    except KeyError:
        raise KeyError(f"unknown query {name!r}; known: {', '.join(list_query_names())}") from None
    return fn(tables, **params)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Register each table as a temp view of the same name (ad-hoc ``spark.sql``)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
