"""Roll-ups of evaluation runs: weighted means, per-label sums, gates, budgets, attention."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def per_label(df: DataFrame, keys: Sequence[str], label: str, gold: str, found: str, recall: str, precision: str) -> DataFrame:
    """keys, label, gold, found, precision, recall: sums, with hits as the mean of recall * gold and precision * found."""
    by_gold, by_found = F.sum(F.col(recall) * F.col(gold)), F.sum(F.col(precision) * F.col(found))
    sums = df.groupBy(*keys, label).agg(F.sum(gold).alias("gold"), F.sum(found).alias("found"), by_gold.alias("_g"), by_found.alias("_f"))
    hits = F.when(F.col("_g").isNotNull() & F.col("_f").isNotNull(), (F.col("_g") + F.col("_f")) / 2).otherwise(F.coalesce("_g", "_f"))
    rate = lambda n: F.when(F.col(n) > 0, hits / F.col(n)).otherwise(F.lit(0.0))
    return sums.select(*keys, label, "gold", "found", rate("found").alias("precision"), rate("gold").alias("recall"))


def rolling_per_label(df: DataFrame, variant: str, time: str, label: str, values: Sequence[str], latest: int) -> DataFrame:
    """variant, label and mean values over the variant's latest run times; every run counts alike."""
    runs = df.groupBy(variant, time, label).agg(*(F.avg(v).alias(v) for v in values))
    ranked = runs.withColumn("_r", F.dense_rank().over(Window.partitionBy(variant).orderBy(F.desc(time)))).filter(F.col("_r") <= latest)
    return ranked.groupBy(variant, label).agg(*(F.avg(v).alias(v) for v in values))


def weighted_quality(df: DataFrame, keys: Sequence[str], value: str, weight: str) -> DataFrame:
    """keys, quality: the mean by positive weights; a plain mean where there are none."""
    w = F.when((F.col(weight) > 0) & F.col(value).isNotNull(), F.col(weight))
    return df.groupBy(*keys).agg(F.coalesce(F.try_divide(F.sum(F.col(value) * w), F.sum(w)), F.avg(value)).alias("quality"))


def first_metric(*metrics: Column) -> Column:
    return F.coalesce(*metrics)


def per_million(quality: Column, tokens: Column, scale: float = 1e6) -> Column:
    return F.when(tokens > 0, quality * scale / tokens)


def best_by(df: DataFrame, keys: Sequence[str], metrics: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of each key the row with the greatest metrics, one after another (none counts as 0); the first of equals."""
    w = Window.partitionBy(*keys).orderBy(*(F.desc(F.coalesce(F.col(m), F.lit(0))) for m in metrics), *order)
    return df.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def most_common(df: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """keys, value: the most frequent; of equals the one seen first."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"), F.min(order).alias("_first"))
    w = Window.partitionBy(*keys).orderBy(F.desc("_n"), "_first")
    return counts.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select(*keys, value)


def latest_group(df: DataFrame, group: str, time: str, has_data: Column) -> DataFrame:
    """The rows with data of the run group that has the latest of them."""
    known = df.filter(has_data)
    last = known.orderBy(F.desc_nulls_last(time), group).limit(1).select(F.col(group).alias("_g"))
    return known.join(F.broadcast(last), F.col(group).eqNullSafe(F.col("_g"))).drop("_g")  # one row is broadcast


def clamped_series(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """df with clamped (at the key's 95th percentile) and logged values."""
    top = df.groupBy(*keys).agg(F.percentile(value, 0.95).alias("_p"))
    return df.join(top, list(keys)).withColumns({"clamped": F.least(F.col(value), F.col("_p")), "logged": F.log10(F.greatest(F.col(value), F.lit(0.0)) + 1)}).drop("_p")


def kpis(df: DataFrame, seconds: str, accuracy: str, time: str) -> DataFrame:
    return df.agg(F.count("*").alias("n"), F.percentile(seconds, 0.5).alias("median_seconds"), F.avg(accuracy).alias("accuracy"), F.max(time).alias("latest"))


def gates(baseline: DataFrame, candidate: DataFrame, limits: Mapping[str, float]) -> DataFrame:
    """metric, baseline, candidate, drop, failed: metrics (as rows of metric, value) that fall by more than their limit."""
    limit = F.create_map(*(F.lit(x) for kv in limits.items() for x in kv))
    joined = baseline.select("metric", F.col("value").alias("baseline")).join(candidate.select("metric", F.col("value").alias("candidate")), "metric", "full")
    drop = F.col("baseline") - F.col("candidate")
    return joined.filter(F.col("metric").isin(*limits)).withColumn("drop", drop).withColumn("failed", F.coalesce(F.col("drop") > F.element_at(limit, F.col("metric")), F.lit(True)))


def micro_average(df: DataFrame, keys: Sequence[str], tp: str, fp: str, fn: str) -> DataFrame:
    """keys, tp, fp, fn summed, then precision, recall and f1."""
    from larder.operators.sequences import precision_recall

    sums = df.groupBy(*keys).agg(*(F.sum(c).alias(n) for c, n in ((tp, "tp"), (fp, "fp"), (fn, "fn"))))
    return sums.withColumns(precision_recall(F.col("tp"), F.col("fp"), F.col("fn")))


def inside_outside(df: DataFrame, keys: Sequence[str], inside: Column, correct: str, total: str) -> DataFrame:
    """keys, inside, outside, gap: accuracies over summed counts; the gap is null where one is."""
    part = lambda ok, c: F.sum(F.when(ok, F.col(c)))
    rates = df.groupBy(*keys).agg(F.try_divide(part(inside, correct), part(inside, total)).alias("inside"), F.try_divide(part(~inside, correct), part(~inside, total)).alias("outside"))
    return rates.withColumn("gap", F.col("inside") - F.col("outside"))


def confusion_deltas(df: DataFrame, gold: str, found: str, delta: str, most: int) -> DataFrame:
    """gold, found, delta: summed differences that aren't 0, the largest first."""
    sums = df.groupBy(gold, found).agg(F.sum(delta).alias("delta")).filter("delta <> 0")
    return sums.orderBy(F.desc(F.abs("delta")), gold, found).limit(most)


def token_cost(df: DataFrame, keys: Sequence[str], rows: str, price: float, row_chars: int = 120, overhead: int = 800) -> DataFrame:
    """keys, tokens, usd: a quarter token a character of the rows and a fixed overhead, at a price for a million."""
    chars = F.sum(F.col(rows) * row_chars + overhead)
    tokens = F.ceil(chars / 4).cast("long")
    return df.groupBy(*keys).agg(tokens.alias("tokens"), F.round(tokens * price / 1e6, 4).alias("usd"))


def shard_budget(df: DataFrame, keys: Sequence[str], tokens: str, most_total: int, most_each: int) -> DataFrame:
    """keys, total, largest, shards (needed for the total), binding: which budget is exceeded."""
    out = df.groupBy(*keys).agg(F.sum(tokens).alias("total"), F.max(tokens).alias("largest"))
    binding = F.when(F.col("largest") > most_each, "item").when(F.col("total") > most_total, "total").otherwise("none")
    return out.withColumns({"shards": F.greatest(F.lit(1), F.ceil(F.col("total") / most_total)).cast("long"), "binding": binding})


def status_counts(df: DataFrame, status: str) -> DataFrame:
    known = df.filter(F.trim(F.coalesce(F.col(status), F.lit(""))) != "")
    return known.groupBy(F.trim(status).alias("status")).agg(F.count("*").alias("n"))


def attention(df: DataFrame, status: str, quiet_seconds: Column, warnings: Column, stall_after: float) -> DataFrame:
    """df with severity, label, stalled by an ordered cascade: failed, stalled, warned, waiting, running, done."""
    stalled = (quiet_seconds >= max(1.0, stall_after)) & F.col(status).isin("running", "waiting")
    cascade = [("failed", F.col(status) == "failed"), ("stalled", stalled), ("warned", warnings > 0), ("waiting", F.col(status) == "waiting"), ("running", F.col(status) == "running"), ("done", F.col(status) == "done")]
    severity, label = F.lit(99), F.lit("unknown")
    for i, (name, when) in reversed(list(enumerate(cascade))):
        severity, label = F.when(when, i).otherwise(severity), F.when(when, name).otherwise(label)
    return df.withColumns({"severity": severity, "label": label, "stalled": F.coalesce(stalled, F.lit(False))})


def recent_rate(df: DataFrame, keys: Sequence[str], time: str, done: str, latest: int) -> DataFrame:
    """keys, rate: the median of the latest positive rates (units a second) between successive rows."""
    w = Window.partitionBy(*keys).orderBy(time)
    step = (F.col(done) - F.lag(done).over(w)) / F.nullif(F.col(time) - F.lag(time).over(w), F.lit(0))
    rates = df.withColumn("_v", step).filter("_v > 0")
    ranked = rates.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(time)))).filter(F.col("_r") <= latest)
    return ranked.groupBy(*keys).agg(F.percentile("_v", 0.5).alias("rate"))


def suggestion_order(df: DataFrame, strength: str, coverage: str, most: int) -> DataFrame:
    """Rows by strength times coverage (0.2 at least)."""
    return df.withColumn("score", F.col(strength) * F.greatest(F.lit(0.2), F.col(coverage))).orderBy(F.desc("score")).limit(most)
