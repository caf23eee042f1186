"""The named-query catalogue re-aimed at the supplied test tables.

Every reference query (Q1-Q48) and dataframe step (M1-M14) is expressed on the
TPC-H-like tables with the same shape of computation; the mapping is in
``README.md``. Each function takes ``(spark, folder, **params)`` and returns a
DataFrame (NTILE, percentiles and model fits run jobs when they are built, the
others are lazy); optional parameters default to None = no filter.

Scale notes that apply throughout:
* facts (lineitem, orders) are pre-aggregated to the join key of the next
  step before they are joined or exploded, so shuffles carry partial sums;
* distinct counts are two-level aggregates, never Spark's Expand rewrite;
* explicit broadcasts only for sides with a proven bound (fixed lookups,
  one-row aggregates, brackets of hot groups); everything else is left to AQE,
  which broadcasts from the measured size;
* NTILE and percentiles select by sketches and counts (``operators.selection``),
  neither sorting the rows nor holding a group in one task.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import exprs as X
from quarry.operators import correlation, distribution, explode, explorer, fanout, groups, growth, ml
from quarry.operators import ranking, reshape, rfm, selection
from quarry.session import written
from quarry.sources import etl
from quarry.sources.tables import TableSet

QUERIES: dict[str, Callable[..., DataFrame]] = {}


def query(name: str, **preset):
    """Register ``fn`` under ``name``; ``preset`` binds parameters (set variants)."""
    def deco(fn):
        QUERIES[name] = partial(fn, **preset) if preset else fn
        return fn
    return deco


def _t(spark: SparkSession, d: str) -> TableSet:
    return TableSet(spark, d)


def asc(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def desc(*names: str) -> list[Column]:
    return [F.col(n).desc_nulls_last() for n in names]


# --------------------------------------------------------------------------- shared frames

# The four product types that have a translated name (two of the
# six types have none, so the COALESCE falls through to the raw type).
TYPE_TRANSLATION = [
    ("ECONOMY", "Economy line"),
    ("SMALL", "Small goods"),
    ("MEDIUM", "Medium goods"),
    ("PROMO", "Promotional"),
]

SCHEDULED_DAYS_PER_PRIORITY = 30  # days allowed per priority level (1-URGENT = 30 ... 5-LOW = 150)


def type_translation(spark: SparkSession) -> DataFrame:
    """The fixed lookup as a local VALUES relation (planned as LocalTableScan)."""
    rows = ", ".join(f"('{a}', '{b}')" for a, b in TYPE_TRANSLATION)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(t_type, t_name)")


def scheduled_days(priority: Column) -> Column:
    return F.substring(priority, 1, 1).cast("int") * F.lit(SCHEDULED_DAYS_PER_PRIORITY)


def shipments(t: TableSet, with_geography: bool = False) -> DataFrame:
    """lineitem ⋈ orders with shipping mode (= priority), real and scheduled days, late flag.

    ``with_geography`` attaches the customer's nation and region to each *order*
    before the line join (orders are a fraction of lines), so lines are
    shuffled once, by order key, and never re-shuffled by customer key.
    """
    l = t.lineitem
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    if with_geography:
        g = _customer_geography(t)
        o = o.join(g, o.o_custkey == g.c_custkey).drop("c_custkey")
    s = l.join(o, l.l_orderkey == o.o_orderkey)
    real = X.day_diff("o_orderdate", "l_shipdate")
    sched = scheduled_days(F.col("o_orderpriority")).cast("long")
    return (s.withColumn("shipping_mode", F.col("o_orderpriority"))
            .withColumn("days_real", real).withColumn("days_scheduled", sched)
            .withColumn("late", X.flag(real > sched)))


def _customer_geography(t: TableSet) -> DataFrame:
    """customer -> nation and region names (nation: 25 rows, region: 5, by schema)."""
    c = t.customer.select("c_custkey", "c_nationkey")
    n, r = t.nation, t.region
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
            .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey)
            .select("c_custkey", "n_name", "r_name"))


def delivered_orders(t: TableSet) -> DataFrame:
    """One row per finished order: purchase date, last ship date (= delivered),
    estimated date (purchase + allowance by priority). Lines are reduced to
    one row per order before anything else touches them."""
    last = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("_last"))
    o = t.orders.filter(F.col("o_orderstatus") == "F")
    j = o.join(last, o.o_orderkey == last.l_orderkey)
    purchased = F.to_date("o_orderdate")
    return j.select("o_orderkey", "o_custkey", purchased.alias("purchased"),
                    F.to_date("_last").alias("delivered"),
                    F.date_add(purchased, scheduled_days(F.col("o_orderpriority"))).alias("estimated"))


def lines_by_part(t: TableSet, *aggs: Column, where: Column | None = None) -> DataFrame:
    """lineitem reduced to one row per part (map-side combined) joined to part."""
    l = t.lineitem if where is None else t.lineitem.filter(where)
    per_part = l.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("_c"), *aggs)
    p = t.part
    return per_part.join(p, per_part.l_partkey == p.p_partkey)


def reviews(t: TableSet) -> DataFrame:
    """Purchase events act as reviews of the order with the same id (user_id);
    one order can have many."""
    return t.events.filter(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("r_order"), F.col("value").alias("review_score"))


def categorized_items(spark: SparkSession, t: TableSet, dedupe_reviews: bool = False, parts: int | None = None) -> DataFrame:
    """Items ⋈ part ⟕ translation ⟕ reviews with the review fan-out kept
    (an item with n reviews counts n times, as the SQL join does), computed by
    ``fanout.review_weights`` so a heavily reviewed order never multiplies rows."""
    l = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    p = t.part.select("p_partkey", "p_type")
    tr = type_translation(spark)  # fixed four-row lookup
    j = (l.join(p, l.l_partkey == p.p_partkey)
         .join(F.broadcast(tr), F.col("p_type") == tr.t_type, "left")
         .select("l_orderkey", "p_partkey", "l_linenumber", "l_extendedprice",
                 F.coalesce("t_name", "p_type").alias("category_or_null"),
                 F.coalesce("t_name", "p_type", F.lit("unknown")).alias("category")))
    return fanout.review_weights(j, reviews(t), "l_orderkey", "r_order", "review_score",
                                 dedupe=dedupe_reviews, parts=parts)


def _items_summary(items: DataFrame, by: list[str], with_orders: bool) -> DataFrame:
    """Per group: distinct orders, items, revenue, avg item price, avg rating."""
    return fanout.fanout_summary(items, by, "l_orderkey", "l_linenumber", "l_extendedprice",
                                 with_orders=with_orders, with_avg_price=with_orders)


# --------------------------------------------------------------------------- restaurants (Q1-Q12)

@query("lookup_profile")
def lookup_profile(spark, d):
    """Q1: fact ⋈ fixed-size lookup, count + sentinel-aware average + plain average."""
    t = _t(spark, d)
    c, n = t.customer, t.nation  # nation: 25 rows by definition of the schema
    j = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
    return groups.group_profile(
        j, [F.col("n_name").alias("country")],
        [X.sql_round(X.avg_where("c_acctbal", F.col("c_acctbal") > 0), 2).alias("avg_positive_balance"),
         X.sql_round(F.avg("c_acctbal"), 2).alias("avg_balance")],
        count_name="customer_count", order=desc("customer_count") + asc("country"))


@query("top_groups")
def top_groups(spark, d):
    """Q2: densest groups; discount 0 is the 'unrated' sentinel."""
    l = _t(spark, d).lineitem
    return groups.group_profile(
        l, ["l_partkey"],
        [X.sql_round(X.avg_where("l_discount", F.col("l_discount") > 0), 4).alias("avg_discount"),
         X.sql_round(F.avg("l_extendedprice"), 2).alias("avg_price")],
        count_name="line_count", order=desc("line_count") + asc("l_partkey"), limit=20)


@query("explode_count")
def explode_count(spark, d):
    """Q3: list-in-a-string column exploded and counted."""
    p = _t(spark, d).part
    ex = explode.explode_tokens(p, "p_name", " ", "token")
    return groups.group_profile(ex, ["token"], [], count_name="part_count",
                                order=desc("part_count") + asc("token"), limit=20)


@query("explode_avg")
def explode_avg(spark, d):
    """Q4: exploded tokens ranked by a filtered average, groups with >= 20 rows."""
    t = _t(spark, d)
    j = lines_by_part(t, F.sum("l_discount").alias("_s"), where=F.col("l_discount") > 0)
    ex = explode.explode_tokens(j, "p_name", " ", "token", keep=["_c", "_s"])
    out = ex.groupBy("token").agg(F.sum("_c").cast("long").alias("line_count"),
                                  X.sql_round(F.sum("_s") / F.sum("_c"), 4).alias("avg_discount"))
    return out.filter(F.col("line_count") >= 20).orderBy(*desc("avg_discount"), *asc("token")).limit(20)


@query("corr_pair")
def corr_pair(spark, d):
    """Q5: two correlations in one pass over the non-sentinel rows."""
    l = _t(spark, d).lineitem.filter(F.col("l_discount") > 0)
    return correlation.correlations(l, {"price_vs_discount": ("l_extendedprice", "l_discount"),
                                        "quantity_vs_discount": ("l_quantity", "l_discount")})


@query("tier_profile")
def tier_profile(spark, d):
    """Q6: profile by an already-bucketed column."""
    l = _t(spark, d).lineitem
    return groups.group_profile(
        l, ["l_linenumber"],
        [X.sql_round(X.avg_where("l_discount", F.col("l_discount") > 0), 4).alias("avg_discount"),
         X.sql_round(F.avg("l_extendedprice"), 2).alias("avg_price")],
        count_name="line_count", order=asc("l_linenumber"))


@query("label_profile")
def label_profile(spark, d):
    """Q7: filtered rows grouped by a label, by average."""
    e = _t(spark, d).events.filter(F.col("value") > 0)
    return groups.group_profile(e, ["event_type"], [X.sql_round(F.avg("value"), 2).alias("avg_value")],
                                count_name="event_count", order=desc("avg_value") + asc("event_type"))


@query("best_value")
def best_value(spark, d):
    """Q8: value score = score / cost x 1000 (NULLIF-guarded), top 20."""
    p = _t(spark, d).part.filter((F.col("p_size") >= 40) & (F.col("p_retailprice") > 0))
    p = p.withColumn("value_score", X.sql_round(X.safe_divide("p_size", "p_retailprice") * F.lit(1000.0), 3))
    return ranking.top_k(p.select("p_partkey", "p_name", "p_brand", "p_retailprice", "p_size", "value_score"),
                         desc("value_score") + asc("p_partkey"), 20)


@query("flag_profile_a")
def flag_profile_a(spark, d):
    """Q9: profile by a yes/no-like flag."""
    l = _t(spark, d).lineitem
    return groups.group_profile(
        l, ["l_returnflag"],
        [X.sql_round(X.avg_where("l_discount", F.col("l_discount") > 0), 4).alias("avg_discount"),
         X.sql_round(F.avg("l_quantity"), 1).alias("avg_quantity")], count_name="line_count")


@query("flag_profile_b")
def flag_profile_b(spark, d):
    """Q10: profile by a second flag."""
    l = _t(spark, d).lineitem
    return groups.group_profile(
        l, ["l_linestatus"],
        [X.sql_round(X.avg_where("l_discount", F.col("l_discount") > 0), 4).alias("avg_discount"),
         X.sql_round(F.avg("l_extendedprice"), 2).alias("avg_price")], count_name="line_count")


@query("options_distinct")
def options_distinct(spark, d):
    """Q11 / Q28: sorted distinct values."""
    return groups.distinct_options(_t(spark, d).part, "p_brand", "brand")


def _explorer_orders(spark, d, priority=None, min_price=None):
    """Q12: optional filters, two-key sort, 200 rows."""
    o = _t(spark, d).orders
    return explorer.filtered_explorer(
        o, [("o_orderpriority", "=", priority), ("o_totalprice", ">=", min_price)],
        desc("o_totalprice") + asc("o_orderkey"), 200,
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice"])


query("explorer_orders")(_explorer_orders)
query("explorer_orders_set", priority="1-URGENT", min_price=400000.0)(_explorer_orders)
query("explorer_orders_priority_only", priority="3-MEDIUM")(_explorer_orders)


# --------------------------------------------------------------------------- pricing (Q13-Q21)

def _priced_lines(t: TableSet) -> DataFrame:
    """Lines with list price, discounted price and the rounded discount percent."""
    l = t.lineitem.withColumn("discounted", F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")))
    return l.withColumn("discount_pct", X.discount_pct("l_extendedprice", "discounted", 1))


@query("path_overview")
def path_overview(spark, d):
    """Q13: top path segment -> counts and average prices / discount."""
    t = _t(spark, d)
    l = _priced_lines(t).filter(F.col("l_extendedprice").isNotNull() & F.col("discounted").isNotNull())
    per_part = l.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("_c"), F.sum("l_extendedprice").alias("_r"),
        F.sum("discounted").alias("_d"), F.sum("discount_pct").alias("_p"),
        F.count("discount_pct").alias("_pc"))
    p = t.part.select("p_partkey", X.path_segment("p_name", " ", 1).alias("category"))
    j = per_part.join(p, per_part.l_partkey == p.p_partkey)
    out = j.groupBy("category").agg(
        F.sum("_c").cast("long").alias("product_count"),
        X.sql_round(F.sum("_r") / F.sum("_c"), 2).alias("avg_retail_price"),
        X.sql_round(F.sum("_d") / F.sum("_c"), 2).alias("avg_discounted_price"),
        X.sql_round(F.sum("_p") / F.sum("_pc"), 2).alias("avg_discount_pct"))
    return ranking.top_k(out, desc("product_count") + asc("category"), 20)


@query("price_percentiles")
def price_percentiles(spark, d):
    """Q14: exact median / quartiles per group (>= 50 rows), top 15 by size."""
    t = _t(spark, d)
    l = t.lineitem.filter(F.col("l_extendedprice") > 0).select("l_partkey", "l_extendedprice")
    p = t.part.select("p_partkey", F.col("p_type").alias("category"))
    j = l.join(p, l.l_partkey == p.p_partkey).select("category", "l_extendedprice")
    dist = distribution.distribution_by_group(j, ["category"], "l_extendedprice", min_count=50,
                                              count_name="line_count", decimal_scale=9)
    out = dist.select("category", "line_count", F.col("avg_value").alias("avg_price"),
                      F.col("median_value").alias("median_price"), "q1", "q3",
                      F.col("value_range").alias("price_range"))
    return ranking.top_k(out, desc("line_count") + asc("category"), 15)


@query("percentiles_long")
def percentiles_long(spark, d):
    """M5: quartile columns melted to (category, stat, price)."""
    wide = price_percentiles(spark, d).select("category", "q1", "median_price", "q3")
    return reshape.melt(wide, ["category"], ["q1", "median_price", "q3"], "stat", "price")


# Price tier cut points and labels for the extended line price.
PRICE_TIERS = [(10000, "1. Budget (<10000)"), (40000, "2. Mid (10000-40000)"),
               (80000, "3. Premium (40000-80000)")]
PRICE_TIER_TOP = "4. Luxury (80000+)"


@query("price_tiers")
def price_tiers(spark, d):
    """Q15: CASE-ladder binning then a profile per bin."""
    l = _t(spark, d).lineitem.withColumn(
        "discounted", F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")))
    l = l.filter(F.col("l_extendedprice").isNotNull() & F.col("discounted").isNotNull())
    l = l.withColumn("price_tier", X.tier_bin("l_extendedprice", PRICE_TIERS, PRICE_TIER_TOP))
    l = l.withColumn("discount_pct", X.discount_pct("l_extendedprice", "discounted"))
    return groups.group_profile(l, ["price_tier"], [
        X.sql_round(F.avg("l_extendedprice"), 2).alias("avg_retail_price"),
        X.sql_round(F.avg("discount_pct"), 2).alias("avg_discount_pct")],
        count_name="line_count", order=asc("price_tier"))


@query("topk_per_group")
def topk_per_group(spark, d):
    """Q16: RANK() <= 3 per group by discount, ties kept.

    Lines are counted by part and discount, then by brand and discount, and the counts give
    the discounts in a brand's top 3. One join back by part and discount finds their lines,
    so no line is sorted and no line below the cut meets the part table.
    """
    t = _t(spark, d)
    l = _priced_lines(t).filter((F.col("l_extendedprice") > 0) & F.col("discounted").isNotNull())
    p = t.part.select("p_partkey", "p_name", F.col("p_brand").alias("category"))
    cells = l.groupBy("l_partkey", "discount_pct").agg(F.count(F.lit(1)).alias("lines"))
    cells = cells.join(p, F.col("l_partkey") == F.col("p_partkey"))
    kept = ranking.kept_values(cells, ["category"], ["discount_pct"], desc("discount_pct"), 3, weight="lines")
    kept = kept.select(F.col("category").alias("kept_category"), F.col("discount_pct").alias("kept_pct"))
    cells = p.join(kept, F.col("category").eqNullSafe(F.col("kept_category")))   # three discounts a part at most
    top = l.join(cells, (F.col("l_partkey") == F.col("p_partkey")) & F.col("discount_pct").eqNullSafe(F.col("kept_pct")))
    return top.select("category", "p_name", "l_orderkey", "l_linenumber",
                      F.col("l_extendedprice").alias("retail_price"),
                      F.col("discounted").alias("discounted_price"), "discount_pct")


@query("brand_pricing")
def brand_pricing(spark, d):
    """Q17: per brand (>= 30 rows) average list and discounted price, top 20."""
    t = _t(spark, d)
    l = t.lineitem.filter(F.col("l_extendedprice").isNotNull())
    per_part = l.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("_c"), F.sum("l_extendedprice").alias("_r"),
        F.sum(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("_d"),
        F.count(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("_dc"))
    p = t.part.filter(F.col("p_brand").isNotNull()).select("p_partkey", "p_brand")
    j = per_part.join(p, per_part.l_partkey == p.p_partkey)
    out = j.groupBy(F.col("p_brand").alias("brand")).agg(
        F.sum("_c").cast("long").alias("line_count"),
        X.sql_round(F.sum("_r") / F.sum("_c"), 2).alias("avg_retail_price"),
        X.sql_round(F.sum("_d") / F.sum("_dc"), 2).alias("avg_discounted_price"))
    out = out.filter(F.col("line_count") >= 30)
    return ranking.top_k(out, desc("line_count") + asc("brand"), 20)


def _url_number(url: Column) -> Column:
    """Last path segment of a URL read as a number; NULL unless it is plain digits etc."""
    return X.safe_double(F.regexp_extract(url, r"[^/]*$", 0))


@query("dirty_text_corr")
def dirty_text_corr(spark, d):
    """Q18: numbers hidden in dirty text (TRY_CAST), correlated with a size."""
    pg = _t(spark, d).pages
    rated = (pg.select(_url_number(F.col("url")).alias("rating"),
                       F.length("html").cast("double").alias("size"))
             .filter(F.col("rating").isNotNull() & (F.col("size") > 0)))
    return rated.agg(X.sql_round(X.safe_corr("size", "rating"), 3).alias("size_vs_number_corr"),
                     F.count(F.lit(1)).alias("rated_count"))


@query("group_outliers")
def group_outliers(spark, d):
    """Q19: rows priced above 10x their group median (groups >= 20 rows), top 20."""
    e = _t(spark, d).events.filter(F.col("value") > 0).select(
        F.col("event_type").alias("category"), "event_id", "user_id", "value")
    out = distribution.group_outliers(e, ["category"], "value", factor=10.0, min_count=20)
    out = out.select("category", "event_id", "user_id", "value",
                     X.sql_round("median_value", 4).alias("median_value"), "x_median")
    return ranking.top_k(out, desc("x_median") + asc("event_id"), 20)


@query("options_counted")
def options_counted(spark, d):
    """Q20: non-empty values with >= 20 rows, by frequency."""
    return groups.counted_options(_t(spark, d).part, "p_brand", "brand", min_count=20,
                                  count_name="part_count")


def _explorer_lines(spark, d, category=None, max_price=None):
    """Q21: optional filters, discount desc NULLS LAST, 200 rows."""
    t = _t(spark, d)
    l = t.lineitem.withColumn("discounted", F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")))
    l = l.withColumn("discount_pct", F.when(F.col("l_discount") > 0, X.sql_round(F.col("l_discount") * 100.0, 1)))
    p = t.part.select("p_partkey", "p_name", "p_brand", F.col("p_type").alias("category"))
    j = l.filter(F.col("l_extendedprice").isNotNull()).join(p, l.l_partkey == p.p_partkey)
    cols = ["p_name", "p_brand", "category", "l_orderkey", "l_linenumber", "l_extendedprice",
            "discounted", "discount_pct"]
    order = desc("discount_pct") + asc(*[c for c in cols if c != "discount_pct"])
    return explorer.filtered_explorer(
        j, [("category", "=", category), ("l_extendedprice", "<=", max_price)], order, 200, cols)


query("explorer_lines")(_explorer_lines)
query("explorer_lines_set", category="PROMO", max_price=50000.0)(_explorer_lines)


# --------------------------------------------------------------------------- supply chain (Q22-Q29)

@query("late_by_mode")
def late_by_mode(spark, d):
    """Q22: late count, late %, average delay per shipping mode."""
    s = shipments(_t(spark, d))
    return groups.group_profile(s, ["shipping_mode"], [
        F.sum("late").cast("long").alias("late_lines"),
        X.rate_pct(F.col("late") == 1, 1).alias("late_pct"),
        X.sql_round(F.avg(F.col("days_real") - F.col("days_scheduled")), 2).alias("avg_delay_days")],
        count_name="total_lines", order=desc("late_pct") + asc("shipping_mode"))


@query("late_by_region")
def late_by_region(spark, d):
    """Q23: two-key group (region x mode) with HAVING >= 50."""
    s = shipments(_t(spark, d), with_geography=True)
    return groups.group_profile(
        s, [F.col("r_name").alias("region"), "shipping_mode"],
        [X.rate_pct(F.col("late") == 1, 1).alias("late_pct")], count_name="total_lines",
        min_count=50, order=desc("late_pct") + asc("region", "shipping_mode"))


# The five order priorities (pivot columns, listed up front).
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("late_matrix")
def late_matrix(spark, d):
    """M7: region x mode late % pivoted wide (one column per mode)."""
    long = late_by_region(spark, d).select("region", "shipping_mode", "late_pct")
    return reshape.pivot_wide(long, "region", "shipping_mode", "late_pct", PRIORITIES)


@query("late_overall")
def late_overall(spark, d):
    """M4: overall late rate and a ratio of two sums."""
    s = shipments(_t(spark, d))
    return s.agg(X.sql_round(F.avg("late"), 4).alias("late_rate"),
                 X.sql_round(F.sum(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")))
                         / F.sum("l_extendedprice"), 4).alias("net_to_gross"))


@query("risk_quartiles")
def risk_quartiles(spark, d):
    """Q24: burden = avg qty x avg lead days per product (>= 30 rows), NTILE(4) over
    all products (exact, by the rows at which the order is cut), top 25 by burden."""
    t = _t(spark, d)
    # per-part partial sums first; only they meet the part table
    per_part = shipments(t).groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("l_quantity").alias("_sq"), F.count("l_quantity").alias("_cq"),
        F.sum("days_real").alias("_sd"), F.count("days_real").alias("_cd"))
    p = t.part.select("p_partkey", "p_name", "p_type")
    j = per_part.join(p, per_part.l_partkey == p.p_partkey)
    prod = j.groupBy(F.col("p_name").alias("product_name"), F.col("p_type").alias("category_name")).agg(
        F.sum("_n").cast("long").alias("order_count"),
        (F.sum("_sq") / F.sum("_cq")).alias("_q"), (F.sum("_sd") / F.sum("_cd")).alias("_d"))
    prod = prod.filter(F.col("order_count") >= 30).select(
        "product_name", "category_name", "order_count",
        X.sql_round("_q", 2).alias("avg_order_quantity"), X.sql_round("_d", 2).alias("avg_lead_time_days"),
        X.sql_round(F.col("_q") * F.col("_d"), 2).alias("replenishment_burden"))
    order = [("replenishment_burden", "desc"), ("product_name", "asc"), ("category_name", "asc")]
    q = selection.ntiles(written(prod, "risk-products"), 4, {"risk_quartile": order})
    return ranking.top_k(q, desc("replenishment_burden") + asc("product_name", "category_name"), 25)


@query("market_reliability")
def market_reliability(spark, d):
    """Q25: on-time %, average ratio and distinct regions per market."""
    s = shipments(_t(spark, d), with_geography=True)
    per_region = s.groupBy(F.col("r_name").alias("market"), F.col("n_name").alias("region")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("late").alias("_late"), F.sum("l_tax").alias("_tax"),
        F.count("l_tax").alias("_taxn"))
    out = per_region.groupBy("market").agg(
        F.sum("_n").cast("long").alias("total_lines"),
        X.sql_round(F.lit(100.0) - F.sum("_late") * F.lit(100.0) / F.sum("_n"), 1).alias("on_time_pct"),
        X.sql_round(F.sum("_tax") / F.sum("_taxn"), 3).alias("avg_profit_ratio"),
        F.count("region").alias("regions_served"))
    return out.orderBy(*desc("on_time_pct"), *asc("market"))


def _rfm(spark, d) -> DataFrame:
    o = _t(spark, d).orders
    # the order date travels as text 'M/d/yyyy H:mm' (unpadded) and is parsed back
    as_text = F.date_format("o_orderdate", "M/d/yyyy H:mm")
    parsed = F.to_date(F.to_timestamp(as_text, "M/d/yyyy H:mm"))
    return rfm.customer_rfm(o, "o_custkey", parsed, "o_totalprice")


@query("rfm")
def rfm_analysis(spark, d):
    """Q26: per customer recency / frequency / monetary, quartile scores, segment."""
    return _rfm(spark, d).orderBy(F.col("rfm_score").desc(), F.col("customer_id"))


@query("rfm_summary")
def rfm_segment_summary(spark, d):
    """Q27: segments -> customers, revenue, revenue per customer."""
    return rfm.rfm_summary(_rfm(spark, d))


def _explorer_late(spark, d, category=None):
    """Q29: late lines only, optional category, sorted by a hidden expression."""
    s = shipments(_t(spark, d)).filter(F.col("late") == 1)
    s = s.withColumn("category", F.col("l_returnflag"))
    cols = ["l_orderkey", "l_linenumber", "category", "shipping_mode", "days_real",
            "days_scheduled", "late", "l_extendedprice"]
    order = [(F.col("days_real") - F.col("days_scheduled")).desc()] + asc(*cols)
    return explorer.filtered_explorer(s, [("category", "=", category)], order, 200, cols)


query("explorer_late")(_explorer_late)
query("explorer_late_set", category="R")(_explorer_late)


# --------------------------------------------------------------------------- player valuation (Q30-Q37)

CORR_ATTRIBUTES = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_partkey", "l_suppkey"]


@query("corr_many")
def corr_many(spark, d):
    """Q30: several attributes against one value, one aggregate."""
    l = _t(spark, d).lineitem
    return correlation.correlations(
        l, {f"{c[2:]}_corr": (c, "l_extendedprice") for c in CORR_ATTRIBUTES})


@query("corr_long")
def corr_long(spark, d):
    """M6: the wide correlation row as sorted (attribute, corr) rows."""
    return correlation.correlations_long(corr_many(spark, d))


@query("explode_value")
def explode_value(spark, d):
    """Q31: exploded tokens -> count and averages (pre-aggregated per part)."""
    t = _t(spark, d)
    j = lines_by_part(t, F.sum("l_quantity").alias("_q"), F.sum("l_extendedprice").alias("_v"))
    j = j.withColumn("_w", F.col("_c") * F.col("p_retailprice"))
    ex = explode.explode_tokens(j, "p_name", " ", "token", keep=["_c", "_q", "_v", "_w"])
    out = ex.groupBy("token").agg(
        F.sum("_c").cast("long").alias("line_count"),
        X.sql_round(F.sum("_q") / F.sum("_c"), 1).alias("avg_quantity"),
        X.sql_round(F.sum("_v") / F.sum("_c"), 0).alias("avg_price"),
        X.sql_round(F.sum("_w") / F.sum("_c"), 0).alias("avg_retail"))
    return out.orderBy(*desc("avg_price"), *asc("token"))


@query("explode_ratio")
def explode_ratio(spark, d):
    """Q32: mean of a ratio per exploded token, >= 30 rows."""
    t = _t(spark, d)
    j = lines_by_part(t, F.sum(F.col("l_extendedprice") / F.col("l_quantity")).alias("_r"),
                      where=F.col("l_quantity") > 0)
    ex = explode.explode_tokens(j, "p_name", " ", "token", keep=["_c", "_r"])
    out = ex.groupBy("token").agg(F.sum("_c").cast("long").alias("line_count"),
                                  X.sql_round(F.sum("_r") / F.sum("_c"), 0).alias("avg_price_per_unit"))
    return out.filter(F.col("line_count") >= 30).orderBy(*desc("avg_price_per_unit"), *asc("token"))


@query("pay_vs_performance")
def pay_vs_performance(spark, d):
    """Q33: ratio of means with a NULLIF guard, groups >= 100, top 20."""
    t = _t(spark, d)
    l = t.lineitem.filter(F.col("l_extendedprice").isNotNull())
    per_sup = l.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("_c"), F.sum("l_quantity").alias("_q"),
                                         F.count("l_quantity").alias("_qn"),
                                         F.sum("l_extendedprice").alias("_v"))
    s = t.supplier.select("s_suppkey", "s_nationkey")
    n = t.nation  # 25 rows
    j = per_sup.join(s, per_sup.l_suppkey == s.s_suppkey).join(F.broadcast(n), F.col("s_nationkey") == n.n_nationkey)
    out = j.groupBy(F.col("n_name").alias("league_name")).agg(
        F.sum("_c").cast("long").alias("line_count"),
        (F.sum("_q") / F.sum("_qn")).alias("_aq"), (F.sum("_v") / F.sum("_c")).alias("_av"))
    out = out.filter(F.col("line_count") >= 100).select(
        "league_name", "line_count", X.sql_round("_aq", 1).alias("avg_quantity"),
        X.sql_round("_av", 0).alias("avg_price"),
        X.sql_round(X.safe_divide("_av", "_aq"), 0).alias("price_per_unit"))
    return ranking.top_k(out, desc("price_per_unit") + asc("league_name"), 20)


@query("age_curve")
def age_curve(spark, d):
    """Q34: BETWEEN filter, profile per value."""
    t = _t(spark, d)
    j = lines_by_part(t, F.sum("l_quantity").alias("_q"), F.sum(F.col("l_discount") * 100.0).alias("_dp"),
                      F.sum("l_extendedprice").alias("_v"))
    j = j.filter(F.col("p_size").between(16, 40))
    out = j.groupBy("p_size").agg(
        F.sum("_c").cast("long").alias("line_count"),
        X.sql_round(F.sum("_q") / F.sum("_c"), 1).alias("avg_quantity"),
        X.sql_round(F.sum("_dp") / F.sum("_c"), 1).alias("avg_discount_pct"),
        X.sql_round(F.sum("_v") / F.sum("_c"), 0).alias("avg_price"))
    return out.orderBy("p_size")


def _top_by_type(spark, d, p_type):
    """Q35: required parameter, top 20 by value."""
    p = _t(spark, d).part.filter(F.col("p_type") == F.lit(p_type))
    return ranking.top_k(p.select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"),
                         desc("p_retailprice") + asc("p_partkey"), 20)


query("top_by_type", p_type="PROMO")(_top_by_type)


@query("options_nonempty")
def options_nonempty(spark, d):
    """Q36: distinct non-null, non-empty values."""
    return groups.distinct_options(_t(spark, d).orders, "o_orderpriority", "priority",
                                   drop_null=True, drop_empty=True)


def _explorer_parts(spark, d, p_type=None, min_size=None, max_price=None):
    """Q37: three optional filters, size desc then price asc, 200 rows."""
    p = _t(spark, d).part
    return explorer.filtered_explorer(
        p, [("p_type", "=", p_type), ("p_size", ">=", min_size), ("p_retailprice", "<=", max_price)],
        desc("p_size") + asc("p_retailprice", "p_partkey"), 200,
        ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"])


query("explorer_parts")(_explorer_parts)
query("explorer_parts_set", p_type="STANDARD", min_size=30, max_price=950.0)(_explorer_parts)
query("explorer_parts_size_only", min_size=45)(_explorer_parts)


# --------------------------------------------------------------------------- e-commerce (Q38-Q48)

def _finished_lines(t: TableSet) -> DataFrame:
    o = t.orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_orderdate")
    l = t.lineitem.select("l_orderkey", "l_extendedprice")
    return o.join(l, o.o_orderkey == l.l_orderkey)


@query("kpi_summary")
def kpi_summary(spark, d):
    """Q38: delivered orders, customers, revenue, average order value."""
    t = _t(spark, d)
    # one row per order first (reuses the order-key partitioning of the line join),
    # then the customer join runs on per-order rows and feeds the per-person step
    per_order = _finished_lines(t).groupBy("o_orderkey", "o_custkey").agg(
        F.sum("l_extendedprice").alias("l_extendedprice"))
    c = t.customer.select("c_custkey")
    facts = per_order.join(c, per_order.o_custkey == c.c_custkey)
    return groups.kpi_summary(facts, "o_orderkey", "c_custkey", "l_extendedprice")


def _period_growth(spark, d, from_month=None):
    """Q39 (+B9): monthly revenue, orders, customers, LAG and growth %."""
    facts = _finished_lines(_t(spark, d))
    return growth.period_growth(facts, "o_orderdate", "l_extendedprice", "o_orderkey", "o_custkey",
                                from_period=from_month)


query("period_growth")(_period_growth)
query("period_growth_since", from_month="1997-01-01")(_period_growth)


@query("top_categories")
def top_categories(spark, d, dedupe_reviews: bool = False):
    """Q40: inner + two left joins, COALESCE category, distinct orders, top 20."""
    t = _t(spark, d)
    items = categorized_items(spark, t, dedupe_reviews, fanout.task_parts(t.lineitem))
    out = _items_summary(items, ["category"], with_orders=True)
    return ranking.top_k(out.select("category", "orders", "items_sold", "revenue", "avg_item_price",
                                    "avg_rating"), desc("revenue") + asc("category"), 20)


@query("fulfillment_summary")
def fulfillment_summary(spark, d):
    """Q41: average delivery days, days before estimate, late % over all delivered orders."""
    o = delivered_orders(_t(spark, d))
    return o.agg(
        X.sql_round(F.avg(X.day_diff("purchased", "delivered")), 2).alias("avg_delivery_days"),
        X.sql_round(F.avg(X.day_diff("delivered", "estimated")), 2).alias("avg_days_before_estimate"),
        X.rate_pct(F.col("delivered") > F.col("estimated"), 2).alias("late_pct"))


@query("regional_fulfillment")
def regional_fulfillment(spark, d):
    """Q42: the same per customer state (nation), groups >= 30."""
    t = _t(spark, d)
    o = delivered_orders(t)
    c = t.customer.select("c_custkey", "c_nationkey")
    n = t.nation  # 25 rows
    j = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey)
    return groups.group_profile(
        j, [F.col("n_name").alias("state")],
        [X.sql_round(F.avg(X.day_diff("purchased", "delivered")), 2).alias("avg_delivery_days"),
         X.rate_pct(F.col("delivered") > F.col("estimated"), 2).alias("late_pct")],
        count_name="order_count", min_count=30, order=desc("late_pct") + asc("state"))


@query("repeat_rate")
def repeat_rate(spark, d):
    """Q43: share of customers with more than one finished order."""
    t = _t(spark, d)
    o = t.orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return growth.repeat_rate(j, "c_custkey", "o_orderkey")


def _cohorts(spark, d) -> DataFrame:
    t = _t(spark, d)
    o = t.orders.filter(F.col("o_orderstatus") == "F").select("o_custkey", "o_orderdate")
    c = t.customer.select("c_custkey")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return growth.cohort_activity(j, "c_custkey", "o_orderdate")


@query("cohort_retention")
def cohort_retention(spark, d):
    """Q44: first-month cohorts x months since -> active customers."""
    return _cohorts(spark, d)


@query("retention_pct")
def retention_pct(spark, d):
    """M8: cohort triangle as % of month 0 (long form)."""
    return growth.retention_pct(_cohorts(spark, d))


ORDER_MONTHS = 80  # 1995-01 to 2001-08; later orders add columns


@query("retention_triangle")
def retention_triangle(spark, d):
    """M8: the retention table pivoted to the cohort triangle (one column per month index, for every
    month that the order dates span and ``ORDER_MONTHS`` at least)."""
    span = _t(spark, d).orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")).first()
    months = 0 if span["lo"] is None else 12 * (span["hi"].year - span["lo"].year) + span["hi"].month - span["lo"].month + 1
    return growth.retention_triangle(growth.retention_pct(_cohorts(spark, d)), max(ORDER_MONTHS, months))


@query("top_ltv")
def top_ltv(spark, d):
    """Q45: person x state -> orders and lifetime value, top 20."""
    t = _t(spark, d)
    facts = _finished_lines(t)
    per_order = facts.groupBy("o_orderkey", "o_custkey").agg(F.sum("l_extendedprice").alias("_v"))
    c = t.customer.select("c_custkey", "c_nationkey")
    n = t.nation  # 25 rows
    j = per_order.join(c, per_order.o_custkey == c.c_custkey).join(
        F.broadcast(n), F.col("c_nationkey") == n.n_nationkey)
    out = j.groupBy(F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("customer_state")).agg(
        F.count("o_orderkey").alias("order_count"), X.sql_round(F.sum("_v"), 2).alias("lifetime_value"))
    return ranking.top_k(out, desc("lifetime_value") + asc("customer_id", "customer_state"), 20)


@query("type_breakdown")
def type_breakdown(spark, d):
    """Q46: per type: distinct orders, revenue, average of a count column."""
    l = _t(spark, d).lineitem
    per_order = l.groupBy("l_returnflag", "l_orderkey").agg(
        F.sum("l_extendedprice").alias("_v"), F.sum("l_linenumber").alias("_ln"),
        F.count("l_linenumber").alias("_lnc"))
    out = per_order.groupBy("l_returnflag").agg(
        F.count("l_orderkey").alias("order_count"), X.sql_round(F.sum("_v"), 2).alias("total_revenue"),
        X.sql_round(F.sum("_ln") / F.sum("_lnc"), 2).alias("avg_linenumber"))
    return out.orderBy(*desc("total_revenue"), *asc("l_returnflag"))


@query("optional_lookup_options")
def optional_lookup_options(spark, d):
    """Q47: distinct translated-or-raw values through a left join."""
    p = _t(spark, d).part.filter(F.col("p_type").isNotNull())
    tr = type_translation(spark)
    j = p.join(F.broadcast(tr), p.p_type == tr.t_type, "left")
    return groups.distinct_options(j, F.coalesce("t_name", "p_type"), "category")


def _filtered_products(spark, d, category=None):
    """Q48: optional filter before the group, per product totals, top 200."""
    items = categorized_items(spark, _t(spark, d))
    items = explorer.optional_filter(items, "category_or_null", "=", category)
    out = _items_summary(items.withColumn("category", F.col("category_or_null")),
                         ["p_partkey", "category"], with_orders=False)
    return ranking.top_k(out.select("p_partkey", "category", "items_sold", "revenue", "avg_rating"),
                         desc("revenue") + asc("p_partkey"), 200)


query("filtered_products")(_filtered_products)
query("filtered_products_set", category="Promotional")(_filtered_products)


# --------------------------------------------------------------------------- profiles (M1-M3, G20)

def _labelled_documents(t: TableSet) -> DataFrame:
    dcs = t.documents
    lb = t.labels
    return dcs.join(lb, "doc_id", "left")


@query("table_profile")
def table_profile(spark, d):
    """M1: rows and non-null count per column."""
    return reshape.table_profile(_labelled_documents(_t(spark, d)))


@query("missing_counts")
def missing_counts(spark, d):
    """M2: null count and share per column with nulls."""
    return reshape.missing_counts(_labelled_documents(_t(spark, d)))


@query("sentinel_share")
def sentinel_share(spark, d):
    """M2: count and share of the sentinel value (quality 0)."""
    return reshape.sentinel_share(_labelled_documents(_t(spark, d)), "quality", 0)


@query("value_counts")
def value_counts(spark, d):
    """M3: frequency of a column."""
    return reshape.value_counts(_t(spark, d).documents, "lang")


@query("parse_share")
def parse_share(spark, d):
    """G20: share of text values that parse as numbers."""
    pg = _t(spark, d).pages
    return pg.agg(X.sql_round(F.avg(_url_number(F.col("url")).isNotNull().cast("double")), 4)
                  .alias("numeric_share"), F.count(F.lit(1)).alias("row_count"))


# --------------------------------------------------------------------------- ML (M9-M14)

KMEANS_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("kmeans_profile")
def kmeans_profile(spark, d, k: int = 4, n_init: int = 10):
    """M9, M10, M12: standardized features, best-of-n k-means, profile per cluster."""
    l = _t(spark, d).lineitem.select(*KMEANS_FEATURES).dropna()
    _, assigned, _ = ml.kmeans_best(l, KMEANS_FEATURES, k, seed=42, n_init=n_init)
    return ml.cluster_profile(assigned, KMEANS_FEATURES)


@query("kmeans_elbow")
def kmeans_elbow(spark, d, n_init: int = 10):
    """M11: inertia for k = 2..8."""
    l = _t(spark, d).lineitem.select(*KMEANS_FEATURES).dropna()
    return ml.elbow_curve(l, KMEANS_FEATURES, range(2, 9), seed=42, n_init=n_init)


OLS_FEATURES = ["l_quantity", "l_discount", "l_tax"]
FIT_DIGITS = 8

# Centres in standardised units.
GIVEN_CENTRES = [(1.0, 1.0, 0.5, -0.5), (-1.0, -1.0, -0.5, 0.5), (0.25, 0.5, -1.0, -1.0), (-0.5, 0.125, 1.0, 0.75)]


@query("ols_residual_topk")
def ols_residual_topk(spark, d):
    """M13, M14: log price ~ quantity + discount + tax; 10 lowest and 10 highest residuals."""
    l = _t(spark, d).lineitem
    _, scored, _ = ml.ols_fit(l, "l_extendedprice", OLS_FEATURES, log_label=True)
    ends = ml.residual_extremes(scored, 10, ["l_orderkey", "l_linenumber", "l_partkey", *OLS_FEATURES,
                                             "l_extendedprice"], tie_break=["l_orderkey", "l_linenumber"])
    return ends.withColumns({c: X.sql_round(c, FIT_DIGITS) for c in ("predicted", "residual")})


@query("ols_summary")
def ols_summary(spark, d):
    """M13: R^2, intercept and coefficients of the log-price model (one row)."""
    l = _t(spark, d).lineitem
    model, _, r2 = ml.ols_fit(l, "l_extendedprice", OLS_FEATURES, log_label=True)
    row = [float(r2), float(model.intercept)] + [float(c) for c in model.coefficients]
    names = ["r2", "intercept"] + [f"coef_{c[2:]}" for c in OLS_FEATURES]
    fit = spark.createDataFrame([tuple(row)], ", ".join(f"{n} double" for n in names))
    return fit.select(*[X.sql_round(n, FIT_DIGITS).alias(n) for n in names])


@query("standardized_stats")
def standardized_stats(spark, d):
    """M9: per return flag the mean standardised value of every feature."""
    l = _t(spark, d).lineitem.select("l_returnflag", *KMEANS_FEATURES).dropna()
    z = ml.standardize(l, KMEANS_FEATURES)
    return (z.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("line_count"), *[
        X.sql_round(F.avg(c + "_z"), 6).alias(c[2:] + "_z") for c in KMEANS_FEATURES]).orderBy("l_returnflag"))


@query("kmeans_given")
def kmeans_given(spark, d):
    """M10-M12 for fixed centres: rows, cost and mean features per nearest centre."""
    l = _t(spark, d).lineitem.select(*KMEANS_FEATURES).dropna()
    z = ml.standardize(l, KMEANS_FEATURES)
    a = ml.assign(z, [c + "_z" for c in KMEANS_FEATURES], GIVEN_CENTRES, distance="squared")
    return a.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("size"), X.sql_round(F.sum("squared"), 3).alias("inertia"),
        *[X.sql_round(F.avg(c), 6).alias(c[2:] + "_mean") for c in KMEANS_FEATURES]).orderBy("cluster")


@query("row_count_audit")
def row_count_audit(spark, d):
    """A7: rows of every table."""
    return etl.audit(_t(spark, d))


@query("labelled_documents")
def labelled_documents(spark, d):
    """A12: a projection of documents with their labels, rows without a quality dropped."""
    t = _t(spark, d)
    return (t.documents.select("doc_id", "lang", "n_chars").join(t.labels, "doc_id", "left")
            .filter(F.col("quality").isNotNull()).select("doc_id", "lang", "n_chars", "quality"))
