"""Comparison of outcomes between groups, raw and controlled for strata, and profiles of fields.

All aggregations combine before they shuffle; strata and groups are keys, never collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.fields import EMPTY, comparable, is_blank, maybe_number
from larder.functions.ranks import average_ranks, numbered


def grouped_raw(df: DataFrame, outcome: str, group: str, secondary: tuple[str, ...] = ()) -> DataFrame:
    """grp, n, mean outcome and mean of up to four further metrics, without empty groups and outcomes."""
    key = comparable(F.col(group))
    kept = df.withColumn("_k", key).filter((F.col("_k") != EMPTY) & F.col(outcome).isNotNull())
    means = [F.avg(m).alias(f"mean_{m}") for m in secondary[:4]]
    return kept.groupBy(F.col("_k").alias("grp")).agg(F.count("*").alias("n"), F.avg(outcome).alias("mean"), *means)


def grouped_controlled(df: DataFrame, outcome: str, group: str, hold: list[str]) -> DataFrame:
    """grp, n, strata, mean: group means within strata, weighted by the strata's totals.

    Strata that hold fewer than two groups don't compare anything and are left out.
    """
    if not hold:
        return grouped_raw(df, outcome, group).select("grp", "n", F.lit(0).cast("long").alias("strata"), "mean")
    keys = [f"_s{i}" for i in range(len(hold))]
    kept = df.select(comparable(F.col(group)).alias("grp"), F.col(outcome).alias("_o"), *(comparable(F.col(h)).alias(k) for h, k in zip(hold, keys))).filter((F.col("grp") != EMPTY) & F.col("_o").isNotNull())
    cells = kept.groupBy("grp", *keys).agg(F.count("*").alias("n"), F.avg("_o").alias("m"))
    strata = cells.groupBy(*keys).agg(F.sum("n").alias("weight"), F.count("*").alias("groups")).filter("groups >= 2")
    return cells.join(strata, keys).groupBy("grp").agg(F.sum("n").alias("n"), F.count("*").alias("strata"), (F.sum(F.col("m") * F.col("weight")) / F.sum("weight")).alias("mean"))


def coverage(df: DataFrame, outcome: str, group: str, hold: list[str]) -> DataFrame:
    """One row: used and total rows and strata of grouped_controlled."""
    keys = [f"_s{i}" for i in range(len(hold))]
    kept = df.select(comparable(F.col(group)).alias("grp"), F.col(outcome).alias("_o"), *(comparable(F.col(h)).alias(k) for h, k in zip(hold, keys))).filter((F.col("grp") != EMPTY) & F.col("_o").isNotNull())
    strata = kept.groupBy("grp", *keys).agg(F.count("*").alias("n")).groupBy(*keys).agg(F.sum("n").alias("n"), (F.count("*") >= 2).alias("used"))
    return strata.agg(F.sum("n").alias("total_rows"), F.sum(F.when(F.col("used"), F.col("n")).otherwise(0)).alias("used_rows"), F.count("*").alias("total_strata"), F.count_if("used").alias("used_strata"))


def _moments(x: Column, y: Column) -> list[Column]:
    return [F.count("*").alias("n"), F.avg(x).alias("mx"), F.avg(y).alias("my"), F.covar_pop(x, y).alias("cxy"), F.var_pop(x).alias("vx"), F.var_pop(y).alias("vy")]


def pearson(c: str = "cxy", vx: str = "vx", vy: str = "vy", n: str = "n") -> Column:
    """Null under two rows or without variance."""
    return F.when((F.col(n) >= 2) & (F.col(vx) > 0) & (F.col(vy) > 0), F.col(c) / F.sqrt(F.col(vx) * F.col(vy)))


def regression(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: n, slope, intercept, r2; with constant x slope 0, the mean of y and r2 0; null under two rows."""
    m = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).agg(*_moments(F.col(x), F.col(y)))
    flat = F.col("vx") == 0
    slope = F.when(flat, 0.0).otherwise(F.try_divide("cxy", "vx"))
    some = F.col("n") >= 2
    r = F.coalesce(pearson(), F.lit(0.0))
    return m.select("n", F.when(some, slope).alias("slope"), F.when(some, F.col("my") - slope * F.col("mx")).alias("intercept"), F.when(some, F.when(flat, 0.0).otherwise(r * r)).alias("r2"))


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: n, rho, the correlation of average ranks."""
    pairs = df.select(F.col(x).alias("_x"), F.col(y).alias("_y")).filter("_x IS NOT NULL AND _y IS NOT NULL")
    ranked = average_ranks(average_ranks(pairs, "_x", "_rx"), "_y", "_ry")
    return ranked.agg(*_moments(F.col("_rx"), F.col("_ry"))).select("n", pearson().alias("rho"))


def equal_count_bins(df: DataFrame, x: str, y: str, bins: int = 5, then: tuple[str, ...] = ()) -> DataFrame:
    """bin, n, low, high, mean: chunks of ceil(n / bins) in the order of x, so there may be fewer bins."""
    pairs = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    size = max(1, -(-pairs.count() // bins))
    placed = numbered(pairs, x, [y, *then])
    return placed.groupBy(F.floor(F.col("position") / size).cast("int").alias("bin")).agg(F.count("*").alias("n"), F.min(x).alias("low"), F.max(x).alias("high"), F.avg(y).alias("mean"))


def within_strata(df: DataFrame, outcome: str, x: str, hold: list[str]) -> DataFrame:
    """x and outcome less their strata's means, of strata with two rows and two values of x at least."""
    kept = df.filter(F.col(x).isNotNull() & F.col(outcome).isNotNull())
    means = kept.groupBy(*hold).agg(F.avg(x).alias("_mx"), F.avg(outcome).alias("_mo"), F.min(x).alias("_lx"), F.max(x).alias("_hx"), F.count("*").alias("_n")).filter("_n >= 2 AND _lx <> _hx")
    return kept.join(means, hold).select(*hold, (F.col(x) - F.col("_mx")).alias("x"), (F.col(outcome) - F.col("_mo")).alias("y"))


def field_catalog(df: DataFrame, fields: list[str], categories: int = 120) -> DataFrame:
    """field, filled, n_distinct, numeric, low, high and the most frequent values of every field with two values at least."""
    long = df.select(F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields))).alias("e")).select("e.field", "e.value").filter(~is_blank(F.col("value")))
    counted = long.groupBy("field", "value").agg(F.count("*").alias("n")).withColumn("number", maybe_number(F.col("value")))
    stats = counted.groupBy("field").agg(F.sum("n").alias("filled"), F.count("*").alias("n_distinct"), F.every(F.col("number").isNotNull()).alias("numeric"), F.min("number").alias("low"), F.max("number").alias("high"))
    stats = stats.filter("n_distinct >= 2").select("field", "filled", "n_distinct", "numeric", F.when(F.col("numeric"), F.col("low")).alias("low"), F.when(F.col("numeric"), F.col("high")).alias("high"))
    none = F.array().cast("array<string>")
    if not categories:
        return stats.withColumn("values", none)
    # The filter on the rank lets each partition keep only so many of a field before it shuffles.
    top = Window.partitionBy("field").orderBy(F.desc("n"), "value")
    ranked = counted.select("field", "value", "n").withColumn("_r", F.row_number().over(top)).filter(F.col("_r") <= categories)
    tops = ranked.groupBy("field").agg(F.array_sort(F.collect_list(F.struct("_r", "value"))).alias("_t")).select("field", F.transform("_t", lambda t: t["value"]).alias("values"))
    return stats.join(tops, "field", "left").withColumn("values", F.coalesce("values", none))


def explained(df: DataFrame, outcome: str, field: str) -> DataFrame:
    """One row: n, groups, eta2 of a categorical field: the share of the outcome's variance between its groups."""
    kept = df.select(comparable(F.col(field)).alias("g"), F.col(outcome).alias("o")).filter((F.col("g") != EMPTY) & F.col("o").isNotNull())
    g = kept.groupBy("g").agg(F.count("*").alias("n"), F.avg("o").alias("m"), F.sum(F.col("o") * F.col("o")).alias("q"))
    total = g.agg(F.sum("n").alias("n"), F.count("*").alias("groups"), (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mean"), F.sum(F.col("n") * F.col("m") * F.col("m")).alias("b"), F.sum("q").alias("q"))
    between = F.col("b") - F.col("n") * F.col("mean") * F.col("mean")
    whole = F.col("q") - F.col("n") * F.col("mean") * F.col("mean")
    return total.select("n", "groups", F.when(whole > 0, between / whole).alias("eta2"))


def best_and_worst(groups: DataFrame) -> DataFrame:
    """One row: the groups of highest and lowest mean, and the gap."""
    return groups.agg(F.max(F.struct("mean", "grp")).alias("b"), F.min(F.struct("mean", "grp")).alias("w")).select(F.col("b.grp").alias("best"), F.col("w.grp").alias("worst"), (F.col("b.mean") - F.col("w.mean")).alias("delta"))


def split_segments(df: DataFrame, field: str, bins: int = 4, most: int = 8) -> DataFrame:
    """segment, low, high, n by inclusive ranges of a numeric field's equal-count bins; rows on a shared edge count in both; and the missing."""
    edges = sorted(tuple(r) for r in equal_count_bins(df, field, field, bins).select("bin", "low", "high").collect())[:most]  # a few rows
    if not edges:
        hits = df.sparkSession.createDataFrame([], "bin int, low double, high double, n long")
    else:
        at = F.array(*(F.when((F.col(field) >= low) & (F.col(field) <= high), F.struct(F.lit(b).alias("bin"), F.lit(float(low)).alias("low"), F.lit(float(high)).alias("high"))) for b, low, high in edges))
        hits = df.select(F.explode(at).alias("e")).filter("e IS NOT NULL").groupBy("e.bin", "e.low", "e.high").agg(F.count("*").alias("n"))
    missing = df.filter(F.col(field).isNull()).agg(F.count("*").alias("n")).filter("n > 0").select(F.lit(-1).alias("bin"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"), "n")
    return hits.unionByName(missing)
