"""Scores of labelled ranges and rows against gold ones.

Ranges are inclusive and have id, s, e, label and the columns of a key (their source). Every score is a join on the key
through bins (operators/intervals.py) and an aggregation; a report is a long table with a row for each section and label.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.operators import labels as L
from larder.operators.intervals import best_matches, iou, overlap_join
from larder.operators.sequences import precision_recall

#: The label of gold ranges that nothing overlaps.
NOTHING = "_no_overlap_"


def compatible_source(hash1: Column, file1: Column, hash2: Column, file2: Column, forced: bool = False) -> Column:
    """Whether two ranges are of one source: equal hashes, or one the beginning of the other; by file where a hash is missing."""
    if forced:
        return F.lit(True)
    known = (F.coalesce(hash1, F.lit("")) != "") & (F.coalesce(hash2, F.lit("")) != "")
    return F.when(known, F.startswith(hash1, hash2) | F.startswith(hash2, hash1)).otherwise(F.coalesce(file1 == file2, F.lit(False)))


def source_pairs(left: DataFrame, right: DataFrame, source_hash: str, file: str) -> DataFrame:
    """hash1, file1, hash2, file2: the different sources of both sides that are compatible, by equi-joins on beginnings of hashes and on files."""

    def sources(df: DataFrame, side: str) -> DataFrame:
        return df.select(F.coalesce(F.col(source_hash), F.lit("")).alias(f"hash{side}"), F.col(file).alias(f"file{side}")).distinct()

    def beginnings(df: DataFrame, side: str) -> DataFrame:
        h = F.col(f"hash{side}")
        return df.filter(h != "").withColumn("_b", F.explode(F.transform(F.sequence(F.lit(1), F.length(h)), lambda n: F.substring(h, F.lit(1), n))))

    a, b = sources(left, "1"), sources(right, "2")
    longer = beginnings(a, "1").join(b.filter("hash2 <> ''"), F.col("_b") == F.col("hash2"))
    shorter = beginnings(b, "2").join(a.filter("hash1 <> ''"), F.col("_b") == F.col("hash1"))
    by_file = a.join(b, (F.col("file1") == F.col("file2")) & ((F.col("hash1") == "") | (F.col("hash2") == "")))
    columns = ["hash1", "file1", "hash2", "file2"]
    return reduce(DataFrame.unionByName, (df.select(*columns) for df in (longer, shorter, by_file))).distinct()


def strict_scores(gold: DataFrame, found: DataFrame, keys: Sequence[str], least: float = 0.5, width: int = 64) -> DataFrame:
    """label (null: all), gold, found, gold_matched, found_matched, recall, precision: gold ranges whose best found one of the same label and key overlaps enough (over union)."""
    best = best_matches(gold, found, [*keys, "label"], least, width).filter("matched")
    hits = best.join(gold.select("id", "label"), "id")
    return _per_label(gold, found, hits.groupBy("label").agg(F.count("*").alias("gold_matched"), F.count_distinct("found_id").alias("found_matched")), hits.agg(F.count("*").alias("gold_matched"), F.count_distinct("found_id").alias("found_matched")))


def practical_scores(gold: DataFrame, found: DataFrame, keys: Sequence[str], width: int = 64) -> DataFrame:
    """The same columns, where any overlap with a range of the same label and key counts, on both sides."""
    right = found.select(*keys, "label", F.col("s").alias("_s2"), F.col("e").alias("_e2"))
    left = gold.select(*keys, "label", F.col("s").alias("_s2"), F.col("e").alias("_e2"))
    at, bounds = [*keys, "label"], ("s", "e", "_s2", "_e2")
    g, f = overlap_join(gold, right, at, bounds, width, how="left_semi"), overlap_join(found, left, at, bounds, width, how="left_semi")
    both = g.groupBy("label").agg(F.count("*").alias("gold_matched")).join(f.groupBy("label").agg(F.count("*").alias("found_matched")), "label", "full")
    return _per_label(gold, found, both, both.agg(F.sum("gold_matched").alias("gold_matched"), F.sum("found_matched").alias("found_matched")))


def _per_label(gold: DataFrame, found: DataFrame, hits: DataFrame, all_hits: DataFrame) -> DataFrame:
    totals = gold.groupBy("label").agg(F.count("*").alias("gold")).join(found.groupBy("label").agg(F.count("*").alias("found")), "label", "full")
    each = totals.join(hits, "label", "left")
    names = ["gold", "found", "gold_matched", "found_matched"]
    whole = totals.agg(F.sum("gold").alias("gold"), F.sum("found").alias("found")).crossJoin(all_hits)  # one row and one row
    rows = each.select("label", *names).unionByName(whole.select(F.lit(None).cast("string").alias("label"), *names)).fillna(0, names)
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    return rows.select("label", *(F.col(n).cast("long").alias(n) for n in names), share("gold_matched", "gold").alias("recall"), share("found_matched", "found").alias("precision"))


def f1(precision: Column, recall: Column) -> Column:
    return F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))


def best_of_any_label(gold: DataFrame, found: DataFrame, keys: Sequence[str], width: int = 64) -> DataFrame:
    """id, label, best (label of the found range that overlaps most, null for none), same (whether any of the same label overlaps); repeated found ranges count once, ties go to the smaller id."""
    once = L.first_of(found, [*keys, "label", "s", "e"], ["id"])
    right = once.select(*keys, F.col("id").alias("found_id"), F.col("label").alias("found_label"), F.col("s").alias("fs"), F.col("e").alias("fe"))
    pairs = overlap_join(gold, right, keys, ("s", "e", "fs", "fe"), width)
    score = F.struct((-iou(F.col("s"), F.col("e"), F.col("fs"), F.col("fe"))).alias("o"), F.col("found_id").alias("i"), F.col("found_label").alias("l"))
    met = pairs.groupBy("id").agg(F.min(score).alias("_b"), F.max(F.col("found_label") == F.col("label")).alias("same"))
    return gold.join(met, "id", "left").select("id", "label", F.col("_b.l").alias("best"), F.coalesce("same", F.lit(False)).alias("same"))


def classification(gold: DataFrame, found: DataFrame, keys: Sequence[str], width: int = 64) -> DataFrame:
    """label (null: all), gold, any, same, best, and their rates: how gold ranges fare whatever their bounds."""
    rows = best_of_any_label(gold, found, keys, width)
    counts = [F.count("*").alias("gold"), F.count("best").alias("any"), F.count_if("same").alias("same"), F.count_if(F.col("best") == F.col("label")).alias("best")]
    out = rows.groupBy("label").agg(*counts).unionByName(rows.agg(*counts).withColumn("label", F.lit(None).cast("string")).select("label", "gold", "any", "same", "best"))
    return out.withColumns({f"{c}_rate": F.coalesce(F.try_divide(F.col(c), F.col("gold")), F.lit(0.0)) for c in ("any", "same", "best")})


def range_confusion(gold: DataFrame, found: DataFrame, keys: Sequence[str], width: int = 64) -> DataFrame:
    """label, found, n: gold labels against those of the best overlapping range, or NOTHING."""
    return best_of_any_label(gold, found, keys, width).groupBy("label", F.coalesce("best", F.lit(NOTHING)).alias("found")).agg(F.count("*").alias("n"))


def aligned_report(gold: DataFrame, found: DataFrame, keys: Sequence[str], supported: Sequence[str], least: float = 0.5, relaxed: float = 0.1, width: int = 64) -> DataFrame:
    """section and strict_scores() of: repeated ranges once; supported labels only; these at a relaxed threshold; and any overlap of them (practical)."""
    once = L.first_of(found, [*keys, "label", "s", "e"], ["id"])
    g, f = (df.filter(F.col("label").isin(*supported)) for df in (gold, once))
    parts = {"once": strict_scores(gold, once, keys, least, width), "supported": strict_scores(g, f, keys, least, width), "relaxed": strict_scores(g, f, keys, relaxed, width), "any": practical_scores(g, f, keys, width)}
    return reduce(DataFrame.unionByName, (df.withColumn("section", F.lit(name)) for name, df in parts.items()))


#: A mismatch of granularity is likely from this practical recall on, up to this strict F1, and from this ratio of widths on.
LIKELY_RECALL, LIKELY_F1, LIKELY_RATIO = 0.6, 0.1, 3.0


def granularity(strict_f1: Column, practical_recall: Column, gold_width: Column, found_width: Column, limits: tuple[float, float, float] = (LIKELY_RECALL, LIKELY_F1, LIKELY_RATIO)) -> Column:
    """A struct of ratio (of median widths, 0 without gold) and likely: ranges overlap well but are far wider than gold."""
    ratio = F.when(gold_width > 0, found_width / gold_width).otherwise(0.0)
    return F.struct(ratio.alias("ratio"), ((practical_recall >= limits[0]) & (strict_f1 <= limits[1]) & (ratio >= limits[2])).alias("likely"))


def ranges_report(gold: DataFrame, found: DataFrame, keys: Sequence[str], supported: Sequence[str], least: float = 0.5, width: int = 64) -> DataFrame:
    """section, label, gold, found, gold_matched, found_matched, recall, precision, f1: all scores of ranges in one table.

    Gold ranges of equal bounds count once, with the most frequent label; ties of labels are dropped.
    """
    voted = L.majority(gold, [*keys, "s", "e"], "label").filter("label IS NOT NULL").select(*keys, "s", "e", "label")
    settled = L.first_of(gold.join(voted, [*keys, "s", "e", "label"], "left_semi"), [*keys, "s", "e"], ["id"])
    parts = {"strict": strict_scores(settled, found, keys, least, width), "practical": practical_scores(settled, found, keys, width)}
    rows = [df.withColumn("section", F.lit(name)) for name, df in parts.items()] + [aligned_report(settled, found, keys, supported, least, width=width)]
    return reduce(DataFrame.unionByName, rows).withColumn("f1", f1(F.col("precision"), F.col("recall")))


def count_diagnostics(gold_given: Column, gold_known: Column, gold_counted: Column, found_given: Column, found_known: Column) -> Column:
    """A struct of gold, found, difference and ratio: the first known count of each side; ratio only over a positive gold count."""
    gold, found = F.coalesce(gold_given, gold_known, gold_counted), F.coalesce(found_given, found_known)
    return F.struct(gold.alias("gold"), found.alias("found"), (found - gold).alias("difference"), F.when(gold > 0, found / gold).alias("ratio"))


def slice_metrics(rows: DataFrame, slices: Mapping[str, Column], gold: str, found: str, other: str = "OTHER") -> DataFrame:
    """slice, n, accuracy, macro_f1 (without the other label), worst_label, worst_recall of rows in each named slice; a slice without rows has zeros."""
    at = F.explode(F.array(*(F.when(c, F.lit(n)) for n, c in slices.items())))
    dealt = rows.withColumns({gold: F.coalesce(gold, F.lit(other)), found: F.coalesce(found, F.lit(other))}).withColumn("slice", at).filter("slice IS NOT NULL")
    sides = dealt.select("slice", F.explode(F.array(F.struct(F.col(gold).alias("label"), F.lit(1).alias("g"), F.lit(0).alias("f")), F.struct(F.col(found).alias("label"), F.lit(0).alias("g"), F.lit(1).alias("f")))).alias("x"), (F.col(gold) == F.col(found)).alias("ok"))
    counts = sides.groupBy("slice", "x.label").agg(F.sum("x.g").alias("gold"), F.sum("x.f").alias("found"), F.sum(F.when(F.col("ok"), F.col("x.g")).otherwise(0)).alias("tp"))
    scores = precision_recall(F.col("tp"), F.col("found") - F.col("tp"), F.col("gold") - F.col("tp"))
    each = counts.withColumns(scores)
    worst = F.min(F.when((F.col("label") != other) & (F.col("gold") > 0), F.struct("recall", "label")))
    summary = each.groupBy("slice").agg(F.sum("gold").alias("n"), (F.sum("tp") / F.sum("gold")).alias("accuracy"), F.coalesce(F.avg(F.when(F.col("label") != other, F.col("f1"))), F.lit(0.0)).alias("macro_f1"), worst.alias("_w"))
    names = rows.sparkSession.createDataFrame([(n,) for n in slices], "slice string")
    out = names.join(summary, "slice", "left").select("slice", F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.coalesce("accuracy", F.lit(0.0)).alias("accuracy"), F.coalesce("macro_f1", F.lit(0.0)).alias("macro_f1"), F.col("_w.label").alias("worst_label"), F.col("_w.recall").alias("worst_recall"))
    return out


def routing_summary(rows: DataFrame, inside: str, label: str, structured: Sequence[str], excluded: str, candidate: str) -> DataFrame:
    """One row of counts by whether rows are inside a recipe (true, false or unknown) and by their label."""
    i, s = F.col(inside), F.col(label).isin(*structured)
    counts = {
        "n": F.lit(True), "inside": i, "outside": ~i, "unknown": i.isNull(), "inside_structured": i & s, "outside_structured": ~i & s,
        "outside_candidates": ~i & (F.col(label) == candidate), "outside_excluded": ~i & (F.col(label) == excluded),
    }
    return rows.agg(*(F.count_if(c).alias(n) for n, c in counts.items()))


def text_coverage(rows: DataFrame, covered: DataFrame, keys: Sequence[str], row: str, text: str, least: float = 0.9) -> DataFrame:
    """keys, chars, covered_chars, warning: characters of rows that any task covers (covered: keys and row, repeats count once)."""
    once = covered.select(*keys, row).distinct().withColumn("_c", F.lit(True))
    joined = rows.join(once, [*keys, row], "left")
    n = F.coalesce(F.char_length(text), F.lit(0)).cast("long")
    sums = joined.groupBy(*keys).agg(F.sum(n).alias("chars"), F.sum(F.when(F.col("_c"), n).otherwise(0)).alias("covered_chars"))
    return sums.withColumn("warning", F.when(F.col("chars") == 0, "no text").when(F.col("covered_chars") < least * F.col("chars"), "low coverage"))


def cross_bucket_confusions(confusions: DataFrame, gold: str, found: str, delta: str, bucket, most: int = 10) -> DataFrame:
    """gold, gold_bucket, found, found_bucket, delta: confusions between buckets, the largest differences first. bucket: a function from label to bucket."""
    rows = confusions.select(F.col(gold).alias("gold"), bucket(F.col(gold)).alias("gold_bucket"), F.col(found).alias("found"), bucket(F.col(found)).alias("found_bucket"), F.col(delta).alias("delta"))
    return rows.filter("gold_bucket <> found_bucket").orderBy(F.desc(F.abs("delta")), "gold", "found").limit(most)


def boundary_pairs(now: DataFrame, before: DataFrame, source: str, kinds: Sequence[str] = ("over", "under", "partial"), correct: str = "correct") -> DataFrame:
    """source, and correct, errors, exact_ratio of both sides with their differences; only sources of both."""
    def side(df: DataFrame, name: str) -> DataFrame:
        errors = reduce(lambda a, b: a + b, (F.coalesce(F.col(k), F.lit(0)) for k in kinds))
        good = F.coalesce(F.col(correct), F.lit(0))
        return df.select(source, good.cast("long").alias(f"{name}_correct"), errors.cast("long").alias(f"{name}_errors"), F.try_divide(good, good + errors).alias(f"{name}_exact"))

    both = side(now, "now").join(side(before, "before"), source)
    return both.withColumns({f"delta_{c}": F.col(f"now_{c}") - F.col(f"before_{c}") for c in ("correct", "errors", "exact")})


def boundary_means(pairs: DataFrame) -> DataFrame:
    """One row: the number of pairs and means of their columns; what is unknown doesn't count."""
    names = [f"{s}_{c}" for c in ("exact", "errors") for s in ("now", "before", "delta")]
    return pairs.agg(F.count("*").alias("pairs"), *(F.avg(c).alias(c) for c in names))


def segmentation_distances(rows: DataFrame, keys: Sequence[str], pos: str, gold: str, found: str) -> DataFrame:
    """keys, n, pk, window_diff of two labellings of each sequence, as segments of equal labels.

    Both look at pairs of places half a mean gold segment apart (2 at least, where the sequence allows): pk counts those
    that only one side puts into one segment, window_diff those with different numbers of borders between. One sequence is one task's frame.
    """

    def run(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values(pos)
        segment = [np.cumsum(np.r_[0, (s.to_numpy()[1:] != s.to_numpy()[:-1]).astype(int)]) for s in (df[gold], df[found])]
        n = len(df)
        k = max(2, round(n / (segment[0][-1] + 1) / 2))
        pk = wd = 0.0
        if n > k:
            a, b = (s[k:] - s[:-k] for s in segment)
            pk, wd = float(((a == 0) != (b == 0)).mean()), float((a != b).mean())
        return pd.DataFrame([{**{c: df[c].iloc[0] for c in keys}, "n": n, "pk": pk, "window_diff": wd}])

    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keys) + ", n long, pk double, window_diff double"
    return rows.select(*keys, pos, gold, found).groupBy(*keys).applyInPandas(run, schema)


def nearest_point(points: DataFrame, targets: DataFrame, keys: Sequence[str], x: str, target: str) -> DataFrame:
    """keys, target and the point's columns: of each key's points the nearest in x to each of its targets; ties go to the smaller x."""
    other = [c for c in points.columns if c not in keys]
    pairs = targets.select(*keys, target).join(points, list(keys))
    order = F.struct(F.abs(F.col(x) - F.col(target)).alias("d"), *other)
    return pairs.groupBy(*keys, target).agg(F.min(order).alias("_p")).select(*keys, target, *(F.col(f"_p.{c}").alias(c) for c in other))


def ranked_windows(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """rows with their 0-based place in their sequence as line."""
    return rows.withColumn("line", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
