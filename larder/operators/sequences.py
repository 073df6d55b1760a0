"""Operators over ordered sequences: islands, intervals, neighbours, boundaries.

Sequences are told apart by key columns, and every window is over one sequence.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, keys: Sequence[str], pos: str, label: str) -> DataFrame:
    """keys, label, start, end (inclusive), n: runs of one label over contiguous positions."""
    w = Window.partitionBy(*keys, label).orderBy(pos)
    grouped = df.withColumn("_i", F.col(pos) - F.row_number().over(w)).groupBy(*keys, label, "_i")
    return grouped.agg(F.min(pos).alias("start"), F.max(pos).alias("end"), F.count("*").alias("n")).drop("_i")


def named_spans(df: DataFrame, keys: Sequence[str], pos: str, label: str) -> DataFrame:
    """Islands with an exclusive end and an id made of label and bounds."""
    found = islands(df, keys, pos, label).withColumn("end", F.col("end") + 1)
    return found.withColumn("span_id", F.concat_ws(".", F.lit("nr"), F.col(label), F.col("start").cast("string"), F.col("end").cast("string")))


def later_starts(df: DataFrame, keys: Sequence[str], pos: str, label: str, target: str) -> DataFrame:
    """Starts of the target label's runs, but the first of each sequence."""
    w = Window.partitionBy(*keys).orderBy("start")
    runs = islands(df.filter(F.col(label) == target), keys, pos, label)
    return runs.withColumn("_r", F.row_number().over(w)).filter("_r > 1").select(*keys, "start")


def neighbours(df: DataFrame, keys: Sequence[str], pos: str, value: str) -> DataFrame:
    """df with the previous and next value by order."""
    w = Window.partitionBy(*keys).orderBy(pos)
    return df.withColumns({"prev": F.lag(value).over(w), "next": F.lead(value).over(w)})


def adjacent(df: DataFrame, keys: Sequence[str], pos: str, value: str) -> DataFrame:
    """df with the values at the positions just before and after; null where these aren't there."""
    w = Window.partitionBy(*keys).orderBy(pos)
    before = F.when(F.lag(pos).over(w) == F.col(pos) - 1, F.lag(value).over(w))
    after = F.when(F.lead(pos).over(w) == F.col(pos) + 1, F.lead(value).over(w))
    return df.withColumns({"prev": before, "next": after})


def prefix_counts(df: DataFrame, keys: Sequence[str], pos: str, flag: Column) -> DataFrame:
    """df with the number of set flags up to each position."""
    w = Window.partitionBy(*keys).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("count", F.sum(flag.cast("long")).over(w))


def counted_ahead(df: DataFrame, keys: Sequence[str], pos: str, flag: Column, window: int) -> DataFrame:
    """df with the number of set flags in the row and the next `window` - 1."""
    w = Window.partitionBy(*keys).orderBy(pos).rowsBetween(0, window - 1)
    return df.withColumn("ahead", F.sum(flag.cast("long")).over(w))


def merged(df: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """keys, start, end: unions of overlapping or adjacent half-open intervals."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    seen = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    grouped = df.filter(F.col(start) < F.col(end)).withColumn("_n", (seen.isNull() | (F.col(start) > seen)).cast("long"))
    grouped = grouped.withColumn("_g", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy(*keys, "_g").agg(F.min(start).alias("start"), F.max(end).alias("end")).drop("_g")


def complement(df: DataFrame, keys: Sequence[str], totals: DataFrame, total: str = "total") -> DataFrame:
    """keys, start, end: the gaps of [0, total) that no interval covers; totals has a row for each sequence."""
    covered = merged(df, keys)
    ends = totals.select(*keys, F.col(total).alias("start"), F.col(total).alias("end"), F.lit(0).cast("long").alias("_z"))
    marks = covered.withColumn("_z", F.lit(1).cast("long")).unionByName(ends)
    w = Window.partitionBy(*keys).orderBy("start", "end")
    gap = marks.withColumn("_s", F.coalesce(F.lag("end").over(w), F.lit(0)))
    return gap.filter(F.col("_s") < F.col("start")).select(*keys, F.col("_s").alias("start"), F.col("start").alias("end"))


def sliding(df: DataFrame, total: str, size: int, overlap: int) -> DataFrame:
    """df with start and end of each window of `size` rows; the last is cut, and none starts once the end is reached."""
    step = max(1, size - overlap)
    last = F.greatest(F.lit(0), F.ceil((F.col(total) - size) / F.lit(step)).cast("long")) * step
    starts = F.when(F.col(total) > 0, F.sequence(F.lit(0).cast("long"), last, F.lit(step).cast("long")))
    return df.withColumn("start", F.explode(starts)).withColumn("end", F.least(F.col("start") + size, F.col(total)))


def ranges_text(df: DataFrame, keys: Sequence[str], index: str) -> DataFrame:
    """keys, ranges: distinct non-negative indices as text, such as '1-3, 7'."""
    runs = islands(df.filter(F.col(index) >= 0).select(*keys, index).distinct().withColumn("_l", F.lit(1)), keys, index, "_l")
    text = F.when(F.col("start") == F.col("end"), F.col("start").cast("string")).otherwise(F.concat_ws("-", F.col("start").cast("string"), F.col("end").cast("string")))
    ordered = runs.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("start", text.alias("t")))).alias("_a"))
    return ordered.select(*keys, F.array_join(F.transform("_a", lambda r: r["t"]), ", ").alias("ranges"))


def nearest_labels(df: DataFrame, keys: Sequence[str], pos: str, label: str, targets: Sequence[str]) -> DataFrame:
    """df with the nearest target label strictly before and at or after each position; equal distances go to the smaller label."""
    back = Window.partitionBy(*keys).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(*keys).orderBy(pos).rowsBetween(0, Window.unboundedFollowing)

    def best(found: dict[str, Column], distance) -> Column:
        options = F.array(*(F.when(c.isNotNull(), F.struct(distance(c).alias("d"), F.lit(t).alias("l"))) for t, c in found.items()))
        return F.array_min(F.filter(options, lambda o: o.isNotNull()))["l"]

    at = {t: F.when(F.col(label) == t, F.col(pos)) for t in targets}
    left = {t: F.last(c, ignorenulls=True).over(back) for t, c in at.items()}
    right = {t: F.first(c, ignorenulls=True).over(ahead) for t, c in at.items()}
    names = {f"_l{i}": left[t] for i, t in enumerate(targets)} | {f"_r{i}": right[t] for i, t in enumerate(targets)}
    out = df.withColumns(names)
    out = out.withColumn("left", best({t: F.col(f"_l{i}") for i, t in enumerate(targets)}, lambda c: F.col(pos) - c))
    out = out.withColumn("right", best({t: F.col(f"_r{i}") for i, t in enumerate(targets)}, lambda c: c - F.col(pos)))
    return out.drop(*names)


def rebased(df: DataFrame, keys: Sequence[str], job: str, size: str, index: str) -> DataFrame:
    """df (a row for each item of a job) with its index over all jobs: the sizes of earlier jobs are added."""
    w = Window.partitionBy(*keys).orderBy(job).rowsBetween(Window.unboundedPreceding, -1)
    sizes = df.groupBy(*keys, job).agg(F.max(size).alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    return df.join(sizes.drop("_n"), [*keys, job]).withColumn("rebased", F.col(index) + F.col("_before")).drop("_before")


def renumbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], prefix: str) -> DataFrame:
    """df with an id of prefix and place within its sequence."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("new_id", F.concat(F.lit(prefix), (F.row_number().over(w) - 1).cast("string")))


def cut_buckets(df: DataFrame, keys: Sequence[str], value: str, names: Sequence[str] = ("small", "medium", "large")) -> DataFrame:
    """df with the bucket between cut values at thirds (or so many parts as names); ties share a bucket."""
    k = len(names)
    w = Window.partitionBy(*keys).orderBy(value)
    ranked = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_c"))
    ranked = ranked.withColumn("_upto", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    totals = ranked.groupBy(*keys).agg(F.sum("_c").alias("_t"))
    with_total = ranked.join(totals, list(keys)) if keys else ranked.crossJoin(F.broadcast(totals))  # one row
    cuts = with_total.groupBy(*keys).agg(*(F.min(F.when(F.col("_upto") >= F.ceil(F.col("_t") * i / k), F.col(value))).alias(f"_c{i}") for i in range(1, k)))
    joined = df.join(cuts, list(keys)) if keys else df.crossJoin(F.broadcast(cuts))
    bucket = F.lit(names[-1])
    for i in range(k - 1, 0, -1):
        bucket = F.when(F.col(value) <= F.col(f"_c{i}"), names[i - 1]).otherwise(bucket)
    return joined.withColumn("bucket", F.when(F.col(value).isNotNull(), bucket)).drop(*(f"_c{i}" for i in range(1, k)))


def rolling_trend(df: DataFrame, keys: Sequence[str], group: str, value: str) -> DataFrame:
    """keys, group, median, trend: medians of run groups, then a centred mean over 1 to 7 of them, by how many there are."""
    medians = df.groupBy(*keys, group).agg(F.percentile(value, 0.5).alias("median"))
    n = F.count("*").over(Window.partitionBy(*keys))
    w = Window.partitionBy(*keys).orderBy(group)
    mean = lambda k: F.avg("median").over(w.rowsBetween(-k, k))
    trend = F.when(n <= 1, mean(0)).when(n <= 5, mean(1)).when(n <= 9, mean(2)).otherwise(mean(3))
    return medians.withColumn("trend", trend)


def match_boundaries(gold: DataFrame, found: DataFrame, keys: list[str], pos: str, tolerance: int) -> DataFrame:
    """keys, tp, fp, fn: boundaries matched greedily in order of what was found, each gold one once, nearest first.

    One sequence is one task's pandas frame: its boundaries only, not its rows.
    """

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        free, low, hits = sorted(left[pos]), 0, 0
        for p in sorted(right[pos]):  # what lies before the window of one lies before those of all later ones
            while low < len(free) and free[low] < p - tolerance:
                low += 1
            high = bisect_right(free, p + tolerance, low)
            if low < high:
                at = min(range(low, high), key=lambda i: (abs(free[i] - p), free[i]))
                del free[at]
                hits += 1
        first = (left if len(left) else right).iloc[0]
        return pd.DataFrame([{**{k: first[k] for k in keys}, "tp": hits, "fp": len(right) - hits, "fn": len(left) - hits}])

    schema = ", ".join(f"{k} {gold.schema[k].dataType.simpleString()}" for k in keys) + ", tp long, fp long, fn long"
    return gold.select(*keys, pos).groupBy(*keys).cogroup(found.select(*keys, pos).groupBy(*keys)).applyInPandas(run, schema)


def precision_recall(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    """precision, recall and f1; 0 where nothing is counted."""
    p, r = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)), F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    return {"precision": p, "recall": r, "f1": F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))}


def clusters(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """df with cluster: intervals that overlap, directly or through others, share one (inclusive ends)."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    seen = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = (seen.isNull() | (F.col(start) > seen)).cast("long")
    return df.withColumn("_n", fresh).withColumn("cluster", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1).drop("_n")


def best_of_clusters(df: DataFrame, keys: Sequence[str], start: str, end: str, score: str, order: Sequence[str]) -> DataFrame:
    """Of each cluster the row with the best score, then the earliest, the shortest, and by order."""
    w = Window.partitionBy(*keys, "cluster").orderBy(F.desc(score), start, F.col(end) - F.col(start), *order)
    return clusters(df, keys, start, end).withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r", "cluster")


def runs_with(df: DataFrame, keys: Sequence[str], pos: str, flag: Column, score: str, least: int, mean: float) -> DataFrame:
    """keys, start, end, n, mean: runs of flagged positions that are long enough and score enough on average."""
    w = Window.partitionBy(*keys).orderBy(pos)
    marked = df.filter(flag).withColumn("_i", F.col(pos) - F.row_number().over(w))
    runs = marked.groupBy(*keys, "_i").agg(F.min(pos).alias("start"), F.max(pos).alias("end"), F.count("*").alias("n"), F.avg(score).alias("mean")).drop("_i")
    return runs.filter((F.col("n") >= least) & (F.col("mean") >= mean))


def repeats(df: DataFrame, keys: Sequence[str], pos: str, value: str, nearest: int, farthest: int) -> DataFrame:
    """keys, value, first, second: a value and its next use within a distance."""
    w = Window.partitionBy(*keys, value).orderBy(pos)
    pairs = df.withColumn("second", F.lead(pos).over(w))
    return pairs.filter((F.col("second") - F.col(pos)).between(nearest, farthest)).select(*keys, value, F.col(pos).alias("first"), "second")


def focus_slice(length: Column, segment: int, focus: int) -> tuple[Column, Column]:
    """Start and end of the focus within a segment: centred, and the whole of shorter ones."""
    size = F.least(length, F.lit(min(segment, focus)))
    start = F.floor((length - size) / 2).cast("long")
    return start, start + size


def overlap_for(df: DataFrame, total: str, segment: int, wanted: str) -> DataFrame:
    """df with overlap and tasks: of all overlaps, that whose number of segments is nearest to the wanted; ties to the smaller."""
    options = df.withColumn("_o", F.explode(F.sequence(F.lit(0), F.lit(segment - 1))))
    tasks = F.greatest(F.lit(1), F.ceil((F.col(total) - F.col("_o")) / (segment - F.col("_o")))).cast("long")
    tried = options.withColumn("_t", F.when(F.col(total) <= segment, F.lit(1).cast("long")).otherwise(tasks))
    best = tried.groupBy(*df.columns).agg(F.min(F.struct(F.abs(F.col("_t") - F.col(wanted)).alias("d"), F.col("_o").alias("o"), F.col("_t").alias("t"))).alias("_b"))
    return best.select(*df.columns, F.col("_b.o").alias("overlap"), F.col("_b.t").alias("tasks"))
