"""Joins of intervals by overlap, through bins, so that they are equi-joins with a bound on what meets.

Both sides are dealt to the bins they touch; a pair is kept in the first bin that both touch, so it comes
once. Bins should be about as wide as a typical interval. Longer intervals stand at levels of wider bins, so each
touches a few bins at its level and fewer at those above; a pair meets at the higher of its two levels.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Each level's bins are so many times as wide as those of the level below.
WIDER = 8


def _level(start: str, end: str, width: int) -> Column:
    """The first level whose bins are as wide as the interval."""
    length = F.greatest(F.col(end) - F.col(start), F.lit(0)) + 1
    return F.greatest(F.ceil(F.log(length / F.lit(float(width))) / F.lit(math.log(WIDER))), F.lit(0)).cast("int")


def _binned(df: DataFrame, start: str, end: str, width: int, levels: list[int], side: str) -> DataFrame:
    """df once for each bin it touches, at its own level and each higher one that occurs; _low: the first such bin."""
    own = _level(start, end, width)

    def bins(level: int) -> Column:
        size = F.lit(float(width) * WIDER**level)
        low, high = (F.floor(F.col(c) / size).cast("long") for c in (start, end))
        each = F.transform(F.sequence(low, F.greatest(low, high)), lambda b: F.struct(F.lit(level).alias("level"), b.alias("bin"), low.alias("low")))
        return F.when(own <= level, each).otherwise(F.array().cast("array<struct<level:int,bin:long,low:long>>"))

    binned = df.withColumn(f"_own{side}", own).withColumn(f"_at{side}", F.explode(F.flatten(F.array(*map(bins, levels)))))
    return binned.select("*", *(F.col(f"_at{side}.{c}").alias(f"_{c}{side}") for c in ("level", "bin", "low"))).drop(f"_at{side}")


def overlap_join(left: DataFrame, right: DataFrame, keys: Sequence[str], bounds: tuple[str, str, str, str], width: int = 64, half_open: bool = False, how: str = "inner") -> DataFrame:
    """Pairs of equal keys whose intervals overlap. bounds: start and end of the left, then of the right side (inclusive, or half-open).

    how may be inner, left_semi or left_anti; the latter two keep each left row as often as it occurs. Null keys and
    bounds overlap nothing. One small job finds the levels that occur.
    """
    s1, e1, s2, e2 = bounds
    found = left.select(_level(s1, e1, width).alias("l")).unionByName(right.select(_level(s2, e2, width).alias("l"))).agg(F.collect_set("l")).first()[0]  # some twenty at most
    levels = sorted(found)
    touch = (F.col(s1) < F.col(e2)) & (F.col(s2) < F.col(e1)) if half_open else (F.col(s1) <= F.col(e2)) & (F.col(s2) <= F.col(e1))
    rows = left if how == "inner" else left.select(*keys, s1, e1).distinct()
    a, b = _binned(rows, s1, e1, width, levels or [0], "1"), _binned(right, s2, e2, width, levels or [0], "2")
    names = [f"_k{i}" for i in range(len(keys))]
    b = b.withColumnsRenamed(dict(zip(keys, names)))
    same = (F.col("_level1") == F.col("_level2")) & (F.col("_bin1") == F.col("_bin2")) & (F.col("_level1") == F.greatest("_own1", "_own2"))
    for k, n in zip(keys, names):
        same = same & (F.col(k) == F.col(n))
    helpers = [f"_{c}{side}" for c in ("own", "level", "bin", "low") for side in "12"]
    if how == "inner":
        return a.join(b, same & touch & (F.col("_bin1") == F.greatest("_low1", "_low2"))).drop(*helpers, *names)
    # Whether a row overlaps anything depends on its keys and bounds only.
    hit = a.join(b, same & touch, "left_semi").select(*keys, s1, e1).distinct()
    at = [*keys, s1, e1]
    hit = hit.select(*(F.col(c).alias(f"_h{i}") for i, c in enumerate(at)))
    alike = reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(f"_h{i}")) for i, c in enumerate(at)))
    return left.join(hit, alike, how)


def overlap(s1: Column, e1: Column, s2: Column, e2: Column, half_open: bool = False) -> Column:
    return F.greatest(F.lit(0), F.least(e1, e2) - F.greatest(s1, s2) + (0 if half_open else 1))


def iou(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Overlap over union of inclusive ranges."""
    both = overlap(s1, e1, s2, e2)
    return both / ((e1 - s1 + 1) + (e2 - s2 + 1) - both)


def best_matches(gold: DataFrame, found: DataFrame, keys: Sequence[str], least: float = 0.5, width: int = 64) -> DataFrame:
    """id (of gold), found_id, iou, matched, boundary: each gold range's best overlapping range; ties to the smaller id.

    Columns of both sides: id, s, e and the keys. Ranges may be found for several gold ones.
    """
    right = found.select(*keys, F.col("id").alias("found_id"), F.col("s").alias("fs"), F.col("e").alias("fe"))
    pairs = overlap_join(gold, right, keys, ("s", "e", "fs", "fe"), width)
    pairs = pairs.withColumn("iou", iou(F.col("s"), F.col("e"), F.col("fs"), F.col("fe")))
    w = Window.partitionBy("id").orderBy(F.desc("iou"), "found_id")
    best = pairs.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
    same = (F.col("s") == F.col("fs")) & (F.col("e") == F.col("fe"))
    inside = (F.col("fs") >= F.col("s")) & (F.col("fe") <= F.col("e"))
    around = (F.col("fs") <= F.col("s")) & (F.col("fe") >= F.col("e"))
    boundary = F.when(same, "exact").when(inside, "under").when(around, "over").otherwise("partial")
    return best.select("id", "found_id", "iou", (F.col("iou") >= least).alias("matched"), boundary.alias("boundary"))


def labels_of(rows: DataFrame, spans: DataFrame, keys: Sequence[str], pos: str, other: str | None = "OTHER", width: int = 64) -> DataFrame:
    """keys, pos, labels: the sorted set of labels of the spans (s, e, label) over each row; `other` where there are none."""
    points = rows.select(*keys, pos).withColumn("_p", F.col(pos))
    hit = overlap_join(points, spans.select(*keys, "s", "e", "label"), keys, (pos, "_p", "s", "e"), width)
    found = hit.groupBy(*keys, pos).agg(F.array_sort(F.collect_set("label")).alias("labels"))
    none = F.array(F.lit(other)) if other else F.array().cast("array<string>")
    return rows.select(*keys, pos).join(found, [*keys, pos], "left").withColumn("labels", F.coalesce("labels", none))
