"""Scores of labels against gold labels, votes and bundles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.operators.sequences import precision_recall


def label_counts(df: DataFrame, gold: str, found: str) -> DataFrame:
    """label, tp, fp, fn, precision, recall, f1 of a set of gold labels and one found label in each row."""
    hit = F.array_contains(gold, F.col(found))
    ones = F.array_union(F.when(hit, F.array()).otherwise(F.array(found)).cast("array<string>"), F.col(gold))
    long = df.select(F.explode(F.array_distinct(F.concat(ones, F.array(found)))).alias("label"), F.col(gold).alias("_g"), F.col(found).alias("_f"))
    in_gold, is_found = F.array_contains("_g", F.col("label")), F.col("label") == F.col("_f")
    counts = long.groupBy("label").agg(F.count_if(in_gold & is_found).alias("tp"), F.count_if(~in_gold & is_found).alias("fp"), F.count_if(in_gold & ~is_found).alias("fn"))
    return counts.withColumns(precision_recall(F.col("tp"), F.col("fp"), F.col("fn")))


def accuracy(df: DataFrame, gold: str, found: str) -> DataFrame:
    """One row: n, correct, accuracy."""
    return df.agg(F.count("*").alias("n"), F.count_if(F.array_contains(gold, F.col(found))).alias("correct")).withColumn("accuracy", F.try_divide("correct", "n"))


def macro_f1(counts: DataFrame, without: str = "OTHER") -> DataFrame:
    """One row: the mean f1 of the labels present but one, and the worst recall with its (last such) label."""
    kept = counts.filter((F.col("label") != without) & (F.col("tp") + F.col("fp") + F.col("fn") > 0))
    recalled = F.when(F.col("tp") + F.col("fn") > 0, F.struct((-F.col("recall")).alias("r"), "label"))
    return kept.agg(F.avg("f1").alias("macro_f1"), F.max(recalled).alias("_w")).select("macro_f1", (-F.col("_w.r")).alias("worst_recall"), F.col("_w.label").alias("worst_label"))


def primary(gold: Column, found: Column, order: Sequence[str]) -> Column:
    """The gold label to count: the found one if it is in the set, else the first by order, else alphabetically."""
    ranked = F.get(F.filter(F.array(*map(F.lit, order)), lambda x: F.array_contains(gold, x)), 0)
    return F.when(F.array_contains(gold, found), found).otherwise(F.coalesce(ranked, F.array_min(gold)))


def confusion(df: DataFrame, gold: str, found: str, order: Sequence[str]) -> DataFrame:
    """gold, found, n under the primary gold label."""
    return df.groupBy(primary(F.col(gold), F.col(found), order).alias("gold"), F.col(found).alias("found")).agg(F.count("*").alias("n"))


def first_of(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def majority(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """keys, label, votes, tied: the most frequent label; null where several share the top."""
    counts = df.groupBy(*keys, label).agg(F.count("*").alias("votes"))
    top = counts.groupBy(*keys).agg(F.max("votes").alias("votes"), F.max_by(F.col(label), F.struct("votes", label)).alias("_l"), F.collect_list("votes").alias("_v"))
    tied = F.size(F.filter("_v", lambda v: v == F.col("votes"))) > 1
    return top.select(*keys, F.when(~tied, F.col("_l")).alias(label), "votes", tied.alias("tied"))


def bundled(spans: DataFrame, keys: Sequence[str], rows: str, label: str) -> DataFrame:
    """keys, row, labels, conflict: labels of all spans that touch a row (spans hold arrays of rows)."""
    touched = spans.select(*keys, F.explode(rows).alias("row"), label)
    found = touched.groupBy(*keys, "row").agg(F.array_sort(F.collect_set(label)).alias("labels"))
    return found.withColumn("conflict", F.size("labels") > 1)


def flips(now: DataFrame, before: DataFrame, key: str, fallback: str, label: str) -> DataFrame:
    """Rows whose label differs from the baseline's, found by key, else by the fallback key."""
    by_key = before.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(label).alias("_b1"))
    by_place = before.groupBy(fallback).agg(F.min(label).alias("_b2"))
    joined = now.join(by_key, key, "left").join(by_place, fallback, "left")
    return joined.withColumn("baseline", F.coalesce("_b1", "_b2")).filter(F.col("baseline") != F.col(label)).drop("_b1", "_b2")


def aligned_by_text(left: DataFrame, right: DataFrame, keys: Sequence[str], text: str, order: str) -> DataFrame:
    """Pairs of rows with equal text: the k-th use of a text takes the k-th row that has it."""
    place = lambda df: df.withColumn("_k", F.row_number().over(Window.partitionBy(*keys, text).orderBy(order)))
    other = place(right).select(*keys, text, "_k", F.col(order).alias("other"))
    return place(left).join(other, [*keys, text, "_k"]).select(*keys, text, order, "other")
