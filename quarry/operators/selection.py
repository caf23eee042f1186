"""Exact order statistics guided by sketches: quantiles per group, and NTILE for several orders.

A row of a given rank is found without sorting the rows. A KLL sketch of the values says between
which two values the rank must lie; one aggregate counts the rows below and inside that bracket,
which proves it or widens it; a bracket that still holds many rows gets a sketch of its own. At
the end only the few values inside are counted one by one. Every step is an aggregate that
combines within tasks, so neither a group nor a value that holds most rows meets in one task, and no
input row is ever sorted or written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import written

SKETCH_K = 4096      # a sketch misses a rank by 0.13 % of the rows with 99 % confidence
CELLS = 256          # values that are read off a sketch: its quantiles in steps of 1 / CELLS
MARGIN = 1           # steps by which a bracket is wider than the sketch says; grows where that was not enough
INSIDE = 1_000_000   # rows that a bracket may hold when its values are counted one by one
SMALL_GROUP = 20_000   # rows up to which a group needs no bracket
HOT_GROUPS = 100_000   # larger groups, whose brackets are broadcast: at most so many

LOWEST, HIGHEST = float("-inf"), float("nan")   # Spark orders NaN above all numbers


def _sketch(value: Column) -> Column:
    """Quantiles of ``value`` in steps of 1 / CELLS; null without a value. NaN is not seen by a sketch."""
    steps = F.expr("array(" + ", ".join(f"{i / CELLS!r}D" for i in range(CELLS + 1)) + ")")
    seen = F.when(~F.isnan(value), value)
    return F.when(F.count(seen) > 0, F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(seen, SKETCH_K), steps))


# --- quantiles per group --------------------------------------------------------------------

def _bracket(grid: Column, inside: Column, first: Column, last: Column, lo: Column, hi: Column, margin: int) -> tuple[Column, Column]:
    """Values between which the ranks from ``first`` to ``last`` of ``inside`` rows should lie."""
    a = F.floor(F.lit(CELLS) * (first - 1) / inside).cast("int") - margin
    b = F.ceil(F.lit(CELLS) * last / inside).cast("int") + margin
    return (F.when((a > 0) & grid.isNotNull(), F.get(grid, a)).otherwise(lo), F.when((b < CELLS) & grid.isNotNull(), F.get(grid, b)).otherwise(hi))


def group_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Mapping[str, float], *, decimal_scale: int | None = None,
                    aggs: Sequence[Column] = (), inside: int = INSIDE, small_group: int = SMALL_GROUP) -> DataFrame:
    """Exact ``PERCENTILE_CONT(p) WITHIN GROUP (ORDER BY value)`` per group: ``by``, one column per entry of
    ``probs`` (null for a group without a value), ``aggs`` computed in the same scan, and nothing else.
    NULL values are ignored; a NULL group is one of its own; NaN is the greatest value.

    ``decimal_scale`` interpolates in exact decimal arithmetic with so many digits behind the point,
    which must hold those of the values: a value with more raises an error instead of being rounded.

    The input is scanned for the sketches and once more for the values inside the brackets, and in
    between only where a bracket holds over ``inside`` rows or missed its rank. Brackets are kept for
    groups of over ``small_group`` rows (or one in ``HOT_GROUPS`` of all rows, if that is more), so
    what is broadcast has at most ``HOT_GROUPS`` rows.
    """
    by, names = list(by), list(probs)
    q = lambda c: F.col("`" + c.replace("`", "``") + "`")
    v = q(value)
    if decimal_scale is not None:
        exact = v.cast(f"decimal(38,{decimal_scale})")
        v = F.when(exact.cast("double") == v.cast("double"), exact).when(v.isNotNull(), F.raise_error(F.lit(
            f"a value of {value} has more than {decimal_scale} digits behind the point")).cast(f"decimal(38,{decimal_scale})"))
    keys = [f"__g{i}" for i in range(len(by))]
    x = F.col("__v").cast("double")
    rows = df.select("*", *[q(c).alias(k) for c, k in zip(by, keys)], v.alias("__v"))
    groups = written(rows.groupBy(*keys).agg(F.count("__v").alias("__n"), _sketch(x).alias("__grid"), *aggs), "quantile-groups")
    total = groups.agg(F.sum("__n")).first()[0] or 0
    limit = max(small_group, total // HOT_GROUPS)
    rows = rows.filter("__v is not null").select(*keys, "__v")

    ranks = {}
    for i, p in enumerate(probs.values()):
        at = (F.col("__n") - 1) * F.lit(float(p))
        ranks[i] = (F.floor(at).cast("long") + 1, F.ceil(at).cast("long") + 1)
    brackets = groups.filter(F.col("__n") > limit).select(*keys, "__n", *[c for i, (a, b) in ranks.items() for c in (
        a.alias(f"__a{i}"), b.alias(f"__b{i}"), F.col("__grid").alias(f"__grid{i}"), F.lit(LOWEST).alias(f"__lo{i}"), F.lit(HIGHEST).alias(f"__hi{i}"),
        F.lit(0).cast("long").alias(f"__below{i}"), F.col("__n").alias(f"__in{i}"))])

    def on(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        """Joined by group, null groups too; ``right`` has at most ``HOT_GROUPS`` rows."""
        there = right.select(*[F.col(k).alias("r" + k) for k in keys], *[c for c in right.columns if c not in keys])
        cond = F.lit(True)
        for k in keys:
            cond = cond & left[k].eqNullSafe(there["r" + k])
        return left.join(F.broadcast(there), cond, how).drop(*["r" + k for k in keys])

    margin, held, settled = MARGIN, float("inf"), brackets.limit(1).count() == 0
    while True:
        proposed = brackets
        for i in ranks:
            lo, hi = _bracket(F.col(f"__grid{i}"), F.col(f"__in{i}"), F.col(f"__a{i}") - F.col(f"__below{i}"), F.col(f"__b{i}") - F.col(f"__below{i}"),
                              F.col(f"__lo{i}"), F.col(f"__hi{i}"), margin)
            proposed = proposed.withColumns({f"__nlo{i}": lo, f"__nhi{i}": hi})
        widest = F.greatest(F.lit(0.0), *[F.when(~F.col(f"__nlo{i}").eqNullSafe(F.col(f"__nhi{i}")), (2.0 * margin + 4) / CELLS * F.col(f"__in{i}")).otherwise(0.0) for i in ranks])
        if settled or (proposed.agg(F.max(widest)).first()[0] or 0) <= inside:
            found = _counted(on(rows, proposed, "left"), keys, list(ranks))
            found = written(found, "quantile-values")
            proof = found.groupBy(*keys, "__t").agg(F.sum(F.when(F.col("__v").isNull(), F.col("__c")).otherwise(0)).alias("__under"), F.sum("__c").alias("__upto"))
            proof = on(proof, proposed.select(*keys, *[f"__{c}{i}" for i in ranks for c in "ab"]), "inner")
            first, last = (F.coalesce(*[F.when(F.col("__t") == i, F.col(f"__{c}{i}")) for i in ranks]) for c in "ab")
            if not proof.filter((F.col("__under") >= first) | (F.col("__upto") < last)).limit(1).count():
                break
            margin, settled = margin * 4, True
            continue
        # brackets that hold too many rows: count below and inside, and sketch what is inside
        hot = on(rows, proposed, "inner")
        counts = hot.groupBy(*keys).agg(*[c for i in ranks for c in (
            F.count_if(x < F.col(f"__nlo{i}")).alias(f"__cbelow{i}"), F.count_if(_within(x, i)).alias(f"__cin{i}"), _sketch(F.when(_within(x, i), x)).alias(f"__cgrid{i}"))])
        both = on(counts, proposed, "inner")
        missed = F.lit(False)
        columns = [*keys, "__n"]
        for i in ranks:
            proven = (F.col(f"__cbelow{i}") < F.col(f"__a{i}")) & (F.col(f"__cbelow{i}") + F.col(f"__cin{i}") >= F.col(f"__b{i}"))
            missed = missed | ~proven
            columns += [f"__a{i}", f"__b{i}", *[F.when(proven, F.col(new)).otherwise(F.col(f"__{old}{i}")).alias(f"__{old}{i}") for old, new in (
                ("grid", f"__cgrid{i}"), ("lo", f"__nlo{i}"), ("hi", f"__nhi{i}"), ("below", f"__cbelow{i}"), ("in", f"__cin{i}"))]]
        both = written(both.withColumn("__missed", missed), "quantile-brackets")
        brackets = both.select(*columns)
        left = F.greatest(F.lit(0), *[F.when(F.col(f"__lo{i}").eqNullSafe(F.col(f"__hi{i}")), 0).otherwise(F.col(f"__in{i}")) for i in ranks])
        missed, most = both.agg(F.max("__missed")).first()[0], brackets.agg(F.max(left)).first()[0]
        # few values may hold many rows: a bracket that no longer shrinks is counted value by value, which sums up equal ones
        settled = margin >= CELLS if missed else 2 * most > held
        margin, held = (margin * 4, held) if missed else (MARGIN, most)

    # the rank among the counted values; the count of all rows below a bracket stands first, under null
    upto = F.sum("__c").over(Window.partitionBy(*keys, "__t").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0))
    at = on_groups = found.withColumn("__upto", upto).filter("__v is not null")
    sized = groups.select(*[F.col(k).alias("s" + k) for k in keys], F.col("__n").alias("__size"))
    cond = F.lit(True)
    for k in keys:
        cond = cond & at[k].eqNullSafe(sized["s" + k])
    on_groups = at.join(sized, cond)
    picks = []
    for i, (p, name) in enumerate(zip(probs.values(), names)):
        h = (F.col("__size") - 1) * F.lit(float(p))
        mine = F.col("__t").isin(i, -1)
        picks += [F.min(F.when(mine & (F.col("__upto") >= F.floor(h) + 1), F.col("__v"))).alias(f"__lo_{i}"),
                  F.min(F.when(mine & (F.col("__upto") >= F.ceil(h) + 1), F.col("__v"))).alias(f"__hi_{i}")]
    picked = on_groups.groupBy(*keys).agg(F.max("__size").alias("__size"), *picks)
    out = []
    for i, (p, name) in enumerate(zip(probs.values(), names)):
        h = (F.col("__size") - 1) * F.lit(float(p))
        frac = h - F.floor(h)
        if decimal_scale is not None:
            frac = frac.cast("decimal(20,12)")
            low, high = (F.col(f"__{e}_{i}").cast(f"decimal({18 + decimal_scale},{decimal_scale})") for e in ("lo", "hi"))
        else:
            low, high = F.col(f"__lo_{i}"), F.col(f"__hi_{i}")
        out.append((low + frac * (high - low)).alias(name))
    quantiles = picked.select(*[F.col(k).alias("q" + k) for k in keys], *out)
    cond = F.lit(True)
    for k in keys:
        cond = cond & groups[k].eqNullSafe(quantiles["q" + k])
    extra = [c for c in groups.columns if c not in (*keys, "__n", "__grid")]
    return groups.join(quantiles, cond, "left").select(*[F.col(k).alias(c) for k, c in zip(keys, by)], *names, *extra)


def _within(x: Column, i: int) -> Column:
    return (x >= F.col(f"__nlo{i}")) & (x <= F.col(f"__nhi{i}"))


def _counted(rows: DataFrame, keys: list[str], targets: list[int]) -> DataFrame:
    """(keys, target, value, count): for groups with brackets, per target the values inside it and under null
    the rows below it; for other groups all values, under target -1."""
    x, none = F.col("__v").cast("double"), F.lit(None)
    per_target = F.array(*[F.when(_within(x, i), F.struct(F.lit(i).alias("t"), F.col("__v").alias("v")))
                           .when(x < F.col(f"__nlo{i}"), F.struct(F.lit(i).alias("t"), F.when(F.lit(False), F.col("__v")).otherwise(none).alias("v"))) for i in targets])
    whole = F.array(F.struct(F.lit(-1).alias("t"), F.col("__v").alias("v")))
    each = F.explode(F.when(F.col("__n").isNull(), whole).otherwise(F.filter(per_target, lambda s: s.isNotNull()))).alias("__x")
    return rows.select(*keys, each).groupBy(*keys, F.col("__x.t").alias("__t"), F.col("__x.v").alias("__v")).agg(F.count(F.lit(1)).alias("__c"))


# --- NTILE ----------------------------------------------------------------------------------

@dataclass
class _Cut:
    """The search for the row of a rank in one order: the parts of the sort key fixed so far, and the
    bracket around the next part."""
    order: int
    rank: int                      # among the rows that share the fixed parts
    inside: int
    fixed: list[float] = field(default_factory=list)
    lo: float = LOWEST
    hi: float = HIGHEST
    below: int = 0
    margin: int = MARGIN
    done: bool = False


def _parts(df: DataFrame, name: str, direction: str, longest: dict[str, int]) -> list[Column]:
    """Doubles that compare, one after the other, as the column does, NULL last."""
    kind, c = dict(df.dtypes)[name], F.col("`" + name.replace("`", "``") + "`")
    sign = {"asc": 1, "desc": -1}[direction]
    if kind == "string":
        raw = c.cast("binary")
        piece = lambda i: F.conv(F.rpad(F.hex(F.substring(raw, 6 * i + 1, 6)), 12, "0"), 16, 10).cast("double")
        numbers = [piece(i) for i in range(max(1, -(-longest[name] // 6)))] + [F.octet_length(c).cast("double")]
    elif kind in ("bigint", "timestamp", "timestamp_ntz"):
        whole = c if kind == "bigint" else F.unix_micros(c.cast("timestamp"))
        numbers = [F.shiftright(whole, 32).cast("double"), whole.bitwiseAND(F.lit(0xFFFFFFFF)).cast("double")]
    elif kind == "date":
        numbers = [F.unix_date(c).cast("double")]
    elif kind.startswith("decimal"):
        numbers = [c.cast("double"), (c - c.cast("double").cast(kind)).cast("double")]
    else:
        numbers = [c.cast("double")]
    if kind in ("double", "float"):   # NaN is the greatest number; it stands with an infinity and is told from it by one more part
        numbers = [F.when(F.isnan(c), F.lit(float("inf"))).otherwise(numbers[0]), F.isnan(c).cast("double")]
    return [F.coalesce(p * sign, F.lit(HIGHEST)) for p in numbers]


def ntiles(df: DataFrame, k: int, orders: Mapping[str, Sequence[tuple[str, str]]], *, inside: int = INSIDE) -> DataFrame:
    """``df`` with a column per entry of ``orders``: SQL ``NTILE(k)`` over all rows under that order.

    An order is a list of (column, "asc" or "desc"), NULL last; it should end in a unique column, rows
    that it does not tell apart share a tile. ``df`` is read once for the sort keys, which are written
    as numbers and worked on for all orders together: each round is one aggregate, and what
    reaches the driver are the k - 1 rows at which an order is cut. The result is ``df`` with
    comparisons to those, so it has no shuffle of its own.
    """
    texts = [c for c, kind in df.dtypes if kind == "string" and any(c == x for o in orders.values() for x, _ in o)]
    top = df.agg(F.count(F.lit(1)).alias("n"), *[F.max(F.octet_length(F.col("`" + c.replace("`", "``") + "`"))).alias(f"m{i}") for i, c in enumerate(texts)]).first()
    n, longest = top["n"], {c: top[f"m{i}"] or 0 for i, c in enumerate(texts)}
    parts = [[p for c, d in order for p in _parts(df, c, d, longest)] for order in orders.values()]
    q, m = divmod(n, k)   # the first m tiles have a row more; a cut is the last row of a tile
    cuts = [_Cut(o, r, n) for o in range(len(parts)) for r in sorted({j * q + min(j, m) for j in range(1, k)}) if 0 < r < n]
    if cuts:
        names = [[f"p{o}_{i}" for i in range(len(p))] for o, p in enumerate(parts)]
        keys = written(df.select(*[c.alias(x) for p, ns in zip(parts, names) for c, x in zip(p, ns)]), "sort-keys")
        columns = [[F.col(x) for x in ns] for ns in names]
    while any(not c.done for c in cuts):
        _narrow(keys, columns, [c for c in cuts if not c.done], inside)
    out = df
    for o, name in enumerate(orders):
        tile = F.lit(1).cast("long")
        for c in cuts:
            if c.order == o:
                tile = tile + F.when(_after(parts[o], c.fixed), 1).otherwise(0)
        # with fewer rows than tiles every row is a tile of its own, which the cuts give as well
        out = out.withColumn(name, tile)
    return out


def _after(parts: list[Column], fixed: list[float]) -> Column:
    """Whether a row's key is greater than the fixed parts."""
    out = F.lit(False)
    for p, f in reversed(list(zip(parts, fixed))):
        out = (p > F.lit(f)) | ((p == F.lit(f)) & out)
    return out


def _scope(cut: _Cut, parts: list[Column]) -> Column:
    out = F.lit(True)
    for p, f in zip(parts, cut.fixed):
        out = out & (p == F.lit(f))
    return out


def _narrow(df: DataFrame, parts: list[list[Column]], cuts: list[_Cut], inside: int) -> None:
    """One round for all cuts: smaller brackets where they hold many rows, else the value at the rank."""
    large = [c for c in cuts if c.inside > inside and c.lo != c.hi]
    if large:
        def here(c: _Cut, lo: float, hi: float) -> Column:
            p = parts[c.order][len(c.fixed)]
            return _scope(c, parts[c.order]) & (p >= F.lit(lo)) & (p <= F.lit(hi))
        alike: dict[str, int] = {}   # cuts that share an order and a bracket share its sketch
        at = [alike.setdefault(repr((c.order, c.fixed, c.lo, c.hi)), len(alike)) for c in large]
        grids = df.agg(*[_sketch(F.when(here(c, c.lo, c.hi), parts[c.order][len(c.fixed)])).alias(f"g{g}") for i, (g, c) in enumerate(zip(at, large)) if g not in at[:i]]).first()
        proposed = []
        for g, c in zip(at, large):
            a, b = CELLS * (c.rank - c.below - 1) // c.inside - c.margin, -(-CELLS * (c.rank - c.below) // c.inside) + c.margin
            grid = grids[f"g{g}"]
            proposed.append((grid[a] if grid and a > 0 else c.lo, grid[b] if grid and b < CELLS else c.hi))
        counts = df.agg(*[x for i, (c, (lo, hi)) in enumerate(zip(large, proposed)) for x in (
            F.count_if(_scope(c, parts[c.order]) & (parts[c.order][len(c.fixed)] < F.lit(lo))).alias(f"b{i}"), F.count_if(here(c, lo, hi)).alias(f"i{i}"))]).first()
        for i, (c, (lo, hi)) in enumerate(zip(large, proposed)):
            settled = c.margin >= CELLS
            if counts[f"b{i}"] < c.rank <= counts[f"b{i}"] + counts[f"i{i}"]:
                settled = 2 * counts[f"i{i}"] > c.inside
                c.lo, c.hi, c.below, c.inside, c.margin = lo, hi, counts[f"b{i}"], counts[f"i{i}"], MARGIN
            else:
                c.margin *= 4
            if settled:   # few values hold many rows: they are counted value by value, which sums up equal ones
                c.inside = min(c.inside, inside)
        return
    found = []
    for i, c in enumerate(cuts):
        p = parts[c.order][len(c.fixed)]
        found.append(F.when(_scope(c, parts[c.order]) & (p >= F.lit(c.lo)) & (p <= F.lit(c.hi)), F.struct(F.lit(i).alias("t"), p.alias("v"))))
    values = (df.select(F.explode(F.filter(F.array(*found), lambda s: s.isNotNull())).alias("x")).groupBy("x.t", "x.v").agg(F.count(F.lit(1)).alias("c")))
    upto = F.sum("c").over(Window.partitionBy("t").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    rank = F.element_at(F.array(*[F.lit(c.rank - c.below) for c in cuts]), F.col("t") + 1)
    hits = values.withColumn("upto", upto).filter((F.col("upto") >= rank) & (F.col("upto") - F.col("c") < rank)).collect()   # a row per cut
    for r in hits:
        c = cuts[r["t"]]
        c.rank -= c.below + r["upto"] - r["c"]
        c.fixed.append(r["v"])
        c.lo, c.hi, c.below, c.inside, c.margin = LOWEST, HIGHEST, 0, r["c"], MARGIN
        c.done = c.rank == r["c"] or len(c.fixed) == len(parts[c.order])
