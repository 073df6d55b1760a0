"""Sorting, ranking, sampling, skylines and splits into jobs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_categories(df: DataFrame, field: str, most: int = 5) -> DataFrame:
    """field, n: the most frequent values; ties alphabetically."""
    return df.filter(F.col(field).isNotNull()).groupBy(field).agg(F.count("*").alias("n")).orderBy(F.desc("n"), field).limit(most)


def first_per_bucket(df: DataFrame, bucket: Sequence[str], order: Sequence[Column | str], most: int) -> DataFrame:
    """The first rows of each bucket."""
    w = Window.partitionBy(*bucket).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= most).drop("_r")


def sampled(df: DataFrame, keys: Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """n rows by a hash of their keys: the same at every run and in any order of rows; all, if fewer."""
    return df.withColumn("_h", F.xxhash64(F.lit(seed), *keys)).orderBy("_h", *keys).limit(n).drop("_h")


def latest_preferred(df: DataFrame, time: str, flags: Sequence[Column], excluded: Column, order: Sequence[str]) -> DataFrame:
    """The latest row that isn't excluded (any, if all are); ties by flags, then by order."""
    marked = df.withColumns({"_x": excluded.cast("int"), **{f"_f{i}": f.cast("int") for i, f in enumerate(flags)}})
    ranked = marked.orderBy("_x", F.col(time).desc_nulls_last(), *(F.desc(f"_f{i}") for i in range(len(flags))), *order)
    return ranked.limit(1).drop("_x", *(f"_f{i}" for i in range(len(flags))))


def pareto(df: DataFrame, keys: Sequence[str], cost: str, quality: str) -> DataFrame:
    """Rows that no other row of their key beats in cost without losing quality."""
    best = df.groupBy(*keys, cost).agg(F.max(quality).alias("_q"))
    w = Window.partitionBy(*keys).orderBy(cost).rowsBetween(Window.unboundedPreceding, -1)
    front = best.withColumn("_p", F.max("_q").over(w)).filter(F.col("_p").isNull() | (F.col("_q") > F.col("_p"))).drop("_p")
    return df.join(front, [*keys, cost]).filter(F.col(quality) == F.col("_q")).drop("_q")


def outliers(df: DataFrame, keys: Sequence[str], metric: str, factor: float = 3.0) -> DataFrame:
    """Rows whose metric is over `factor` times the median of their key."""
    middle = df.groupBy(*keys).agg(F.percentile(metric, 0.5).alias("_m"))
    return df.join(middle, list(keys)).filter(F.col(metric) > factor * F.col("_m")).drop("_m")


def median_of_samples(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.percentile(value, 0.5).alias("median"))


def compare_medians(before: DataFrame, now: DataFrame, keys: Sequence[str], floor: float, share: float) -> DataFrame:
    """keys, before, now, delta, status: regression, improved or flat by both thresholds; incomplete where a side lacks the key."""
    joined = before.select(*keys, F.col("median").alias("before")).join(now.select(*keys, F.col("median").alias("now")), list(keys), "full")
    delta = F.col("now") - F.col("before")
    over = lambda d: (d >= floor) & ((F.col("before") <= 0) | (F.try_divide(d, F.col("before")) >= share))
    status = F.when(delta.isNull(), "incomplete").when(over(delta), "regression").when(over(-delta), "improved").otherwise("flat")
    return joined.select(*keys, "before", "now", delta.alias("delta"), status.alias("status"))


def ranked_groups(df: DataFrame, group: str, source: str, quality: str, cost: str) -> DataFrame:
    """group, sources, quality (mean of the sources' means), cost (median of the sources' medians), place."""
    per = df.groupBy(group, source).agg(F.avg(quality).alias("q"), F.percentile(cost, 0.5).alias("c"))
    out = per.groupBy(group).agg(F.count("*").alias("sources"), F.avg("q").alias("quality"), F.percentile("c", 0.5).alias("cost"))
    return out.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("quality"), "cost", group)))


def width_stats(df: DataFrame, keys: Sequence[str], width: Column) -> DataFrame:
    """keys, low, p50, p90, high, mean of widths, interpolated."""
    return df.groupBy(*keys).agg(F.min(width).alias("low"), F.percentile(width, 0.5).alias("p50"), F.percentile(width, 0.9).alias("p90"), F.max(width).alias("high"), F.avg(width).alias("mean"))


def int_distribution(df: DataFrame, value: str) -> DataFrame:
    """One row: count, low, high, mean (3 digits) of non-negative integers; zeros for none."""
    out = df.filter(F.col(value) >= 0).agg(F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"), F.round(F.avg(value), 3).alias("mean"))
    return out.na.fill(0)


def contiguous_parts(df: DataFrame, keys: Sequence[str], order: Sequence[str], parts: int) -> DataFrame:
    """df with its part of near-equal contiguous ones, the first of which take the remainder."""
    return df.withColumn("part", F.ntile(parts).over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def job_ranges(df: DataFrame, total: str, workers: int, least: int) -> DataFrame:
    """df with job, start and end: `total` units over at most `workers` jobs of at least `least` units."""
    jobs = F.least(F.lit(workers), F.ceil(F.col(total) / least)).cast("int")
    size = F.ceil(F.col(total) / jobs).cast("long")
    out = df.filter(F.col(total) > 0).withColumns({"_j": jobs, "_n": size}).withColumn("job", F.explode(F.sequence(F.lit(0), F.col("_j") - 1)))
    out = out.withColumns({"start": F.col("job") * F.col("_n"), "end": F.least(F.col(total), (F.col("job") + 1) * F.col("_n"))})
    return out.filter("start < end").drop("_j", "_n")


def round_robin(df: DataFrame, keys: Sequence[str], order: Sequence[str], workers: int) -> DataFrame:
    return df.withColumn("worker", F.pmod(F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1, F.lit(workers)))


def tail_paired(df: DataFrame, keys: Sequence[str], cost: str, then: Sequence[str]) -> DataFrame:
    """df with turn: longest, shortest, second longest, and so on."""
    n = F.count("*").over(Window.partitionBy(*keys))
    down = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(cost), *then))
    return df.withColumns({"_n": n, "_d": down}).withColumn("turn", F.when(F.col("_d") * 2 <= F.col("_n") + 1, 2 * F.col("_d") - 2).otherwise(2 * (F.col("_n") - F.col("_d")) + 1)).drop("_n", "_d")


def budgeted_batches(df: DataFrame, keys: list[str], order: str, size: str, budget: float, most: int) -> DataFrame:
    """keys, order, batch: greedy batches in order, each within the size budget (or one row) and a number of rows.

    A fold within each key's rows, which therefore should fit a task.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order)
        batch, used, count, out = 0, 0.0, 0, []
        for s in rows[size]:
            if count and (used + s > budget or count >= most):
                batch, used, count = batch + 1, 0.0, 0
            used, count = used + s, count + 1
            out.append(batch)
        return rows[[*keys, order]].assign(batch=out)

    schema = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in [*keys, order]) + ", batch long"
    return df.select(*keys, order, size).groupBy(*keys).applyInPandas(run, schema)


def kept_in_cache(df: DataFrame, keys: list[str], age: str, size: str, then: str, max_age: float, max_bytes: float) -> DataFrame:
    """Entries to keep: within the age, or, newest first, while the byte budget holds; too large ones are passed over."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([age, then])
        used, keep = 0.0, []
        for a, s in zip(rows[age], rows[size]):
            ok = a <= max_age or used + s <= max_bytes
            used += s if ok else 0
            keep.append(ok)
        return rows[[*keys, then]][keep]

    schema = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in [*keys, then])
    return df.select(*keys, age, size, then).groupBy(*keys).applyInPandas(run, schema)


def sweeps(base: dict[str, str], options: dict[str, list[str]]) -> Iterator[dict[str, str]]:
    """The base settings, then one payload for each option's value that isn't the base's."""
    yield dict(base)
    for key, values in options.items():
        for v in values:
            if base.get(key) != v:
                yield {**base, key: v}


def shard_count(total: Column, wanted: Column, each: Column, default_each: int) -> Column:
    """How many shards: the wanted number, else by items a shard; between 1 and the number of items."""
    by_items = F.ceil(total / F.coalesce(F.when(each > 0, each), F.lit(default_each)))
    return F.when(total > 0, F.greatest(F.lit(1), F.least(total, F.coalesce(F.when(wanted > 0, wanted), by_items)))).otherwise(0).cast("long")


def cost_shards(cost: Column, items: Column, threshold: float, most: int) -> Column:
    """One shard under the threshold; else as many as the threshold goes into the cost, up to the items and a maximum."""
    return F.when(cost < threshold, 1).otherwise(F.least(F.lit(most), items, F.ceil(cost / threshold))).cast("long")


def correct_sample(correct: DataFrame, wrong: DataFrame, key: str, label: str, other: str, most: int) -> DataFrame:
    """The first rows that aren't wrong: those with a proper label before the others."""
    kept = correct.join(wrong.select(key).distinct(), key, "left_anti")
    return kept.orderBy(F.col(label) == other, key).limit(most)


def distinct_settings(base: DataFrame, options: dict[str, list[str]]) -> DataFrame:
    """base with every combination of the options' values, each settings once by the hash of its sorted JSON.

    The options are a short list that the caller gives.
    """
    out = base
    for name, values in options.items():
        out = out.withColumn(name, F.explode(F.array(*map(F.lit, values))))
    columns = sorted(out.columns)
    return out.withColumn("hash", F.sha2(F.to_json(F.struct(*columns)).cast("binary"), 256)).dropDuplicates(["hash"])
