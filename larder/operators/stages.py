"""Stages over a book's blocks and rows, with places where a model may be asked, and the runs that measure them.

A hook is a function from a DataFrame to a DataFrame of the same columns; without one a stage keeps what rules say.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.functions.ingredients import ingredient, yield_fields
from larder.operators import rows as W
from larder.operators.labels import aligned_by_text
from larder.operators.merging import matched_files
from larder.operators.reports import representatives
from larder.operators.sequences import cut_buckets, named_spans, sliding
from larder.operators.steps import segmented

Hook = Callable[[DataFrame], DataFrame]


def as_it_is(df: DataFrame) -> DataFrame:
    """The hook that stands in for a model: it changes nothing."""
    return df


def header_kind(x: Column) -> Column:
    """A struct of kind (ingredients, instructions, notes or other), key and name of a header line; null for lines that are none."""
    t = F.trim(F.regexp_replace(x, r"\s+", " "))
    name = F.trim(F.regexp_replace(t, r"\s*:+$", ""))
    low = F.lower(name)
    kind = F.when(low.isin(*W.INGREDIENT_HEADERS), "ingredients").when(low.isin(*W.INSTRUCTION_HEADERS), "instructions").when(low.isin("note", "notes", "tips", "variations"), "notes")
    short = (F.size(F.split(name, " ")) <= 6) & (F.char_length(name) <= 60) & ~name.rlike(r"[.!?]$|^\d")
    component = short & (F.endswith(t, F.lit(":")) | low.rlike(r"^(?:for|to make) (?:the )?\w"))
    key = F.regexp_replace(F.regexp_replace(F.regexp_replace(low, r"^(?:for|to make) (?:the )?", ""), r"[^a-z0-9]+", "_"), "^_+|_+$", "")
    kind = F.coalesce(kind, F.when(component & (key != ""), "other"))
    main = kind.isin("ingredients", "instructions")
    return F.when(kind.isNotNull(), F.struct(kind.alias("kind"), F.when(main, "main").when(kind == "notes", "notes").otherwise(key).alias("key"), F.when(main, "Main").otherwise(name).alias("name")))


def text_sections(texts: DataFrame, key: str, text: str) -> DataFrame:
    """key, kind, lines: what stands under each kind of header in a text; texts without headers have none, and lines before the first are left out."""
    lines = texts.select(key, F.posexplode(F.split(F.coalesce(text, F.lit("")), r"\r?\n")).alias("_i", "_t")).withColumn("_t", F.trim(F.regexp_replace("_t", r"\s+", " "))).filter("_t <> ''")
    kind = header_kind(F.col("_t"))["kind"]
    top = F.when(kind.isin("ingredients", "instructions", "notes"), kind)
    w = Window.partitionBy(key).orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    placed = lines.withColumn("_h", top).withColumn("kind", F.last("_h", ignorenulls=True).over(w)).filter("kind IS NOT NULL AND _h IS NULL")
    return placed.groupBy(key, "kind").agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_t"))), lambda r: r["_t"]).alias("lines"))


def bundled(blocks: DataFrame, key: str, order: str, id_: str, text: str) -> DataFrame:
    """key, source_hash (of the book's texts in order), place, id and text of its blocks."""
    placed = W.ordered_blocks(blocks, [key], order, id_, text)
    whole = placed.groupBy(key).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", F.col(text).alias("t")))), lambda r: r["t"]), "\n").cast("binary"), 256).alias("source_hash"))
    return placed.join(whole, key).select(key, "source_hash", "place", F.col(id_).alias("id"), F.col(text).alias("text"))


def refined(drafts: DataFrame, keys: Sequence[str], hook: Hook = as_it_is, columns: Sequence[str] = ("title", "ingredients", "steps")) -> DataFrame:
    """drafts with what a hook makes of them, and corrected: whether any of the columns changed. What the hook drops stays as it was."""
    made = hook(drafts).select(*keys, *(F.col(c).alias(f"_n_{c}") for c in columns), F.lit(True).alias("_made"))
    joined = drafts.join(made, list(keys), "left")
    new = {c: F.when(F.col("_made"), F.col(f"_n_{c}")).otherwise(F.col(c)) for c in columns}
    changed = F.lit(False)
    for c in columns:
        changed = changed | (F.coalesce(F.col("_made"), F.lit(False)) & ~F.col(c).eqNullSafe(F.col(f"_n_{c}")))
    kept = [F.col(c) for c in drafts.columns if c not in columns]
    return joined.select(*kept, *(new[c].alias(c) for c in columns), changed.alias("corrected"))


def finalized(rows: DataFrame, keys: Sequence[str], pos: str, category: str, candidate: str, decisions: DataFrame | None = None, other: str = "other") -> tuple[DataFrame, DataFrame]:
    """Rows with their final category (a decision for a candidate, else other for it, else their own) and whether it was decided; and the spans of categories."""
    said = (decisions if decisions is not None else rows.limit(0)).select(*keys, pos, F.col(category).alias("_d"))
    joined = rows.join(said.dropDuplicates([*keys, pos]), [*keys, pos], "left")
    open_ = F.col(category) == candidate
    final = joined.withColumn("decided", open_ & F.col("_d").isNotNull()).withColumn(category, F.when(open_, F.coalesce("_d", F.lit(other))).otherwise(F.col(category))).drop("_d")
    return final, named_spans(final.select(*keys, pos, category), list(keys), pos, category)


def row_evidence(texts: DataFrame, rows: DataFrame, keys: Sequence[str], text: str, label: str, row: str, order: str) -> DataFrame:
    """keys, row, labels, conflict: the rows that a recipe's texts (in order, each with a label) come from; the k-th use of a text takes the k-th row that has it."""
    tidy = lambda df, o: df.withColumn("_t", F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))).withColumnRenamed(o, "_o")
    found = aligned_by_text(tidy(texts, order).select(*keys, "_t", "_o"), tidy(rows, row).select(*keys, "_t", "_o"), list(keys), "_t", "_o")
    named = found.join(texts.select(*keys, F.col(order).alias("_o"), label), [*keys, "_o"])
    out = named.groupBy(*keys, F.col("other").alias(row)).agg(F.array_sort(F.collect_set(label)).alias("labels"))
    return out.withColumn("conflict", F.size("labels") > 1)


def semantics(title: Column, ingredients: Column, steps: Column, stated_yield: Column, description: Column) -> Column:
    """A recipe as one record: title, parsed ingredients, steps and variants, and its yield."""
    none = F.array().cast("array<string>")
    parted = W.split_variants(segmented(steps))
    return F.struct(F.trim(title).alias("title"), F.transform(F.coalesce(ingredients, none), lambda x: ingredient(x)).alias("ingredients"), parted["remaining"].alias("steps"), parted["variants"].alias("variants"), yield_fields(stated_yield, description, steps, none).alias("yield"))


@dataclass
class PredictionRun:
    rows: DataFrame  # key, row, text, label, reason
    spans: DataFrame  # key, span, start, end, accepted, reason
    tasks: DataFrame  # key, start, end of windows of rows


def prediction_run(blocks: DataFrame, key: str, block: str, text: str, segment: int = 40, overlap: int = 5, hook: Hook = as_it_is) -> PredictionRun:
    """From blocks to predicted labels, spans that titles begin, and windows for labelling. The hook may change labels."""
    found = W.source_rows(blocks, key, block, text)
    labelled = W.line_roles(found, [key], "row", "text", "tags")
    open_ = labelled.withColumn("label", F.coalesce("label", F.lit(W.OTHER)))
    predicted = hook(open_.select(key, "row", "block", "text", "label", "reason"))
    w = Window.partitionBy(key).orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    spanned = predicted.withColumn("span", F.sum((F.col("label") == W.TITLE).cast("int")).over(w)).filter("span > 0")
    spans = W.span_decisions(spanned, [key, "span"], "row", "label")
    totals = predicted.groupBy(key).agg(F.count("*").alias("total"))
    return PredictionRun(predicted, spans.drop("missing"), sliding(totals, "total", segment, overlap))


def labelling_tasks(rows: DataFrame, keys: Sequence[str], row: str, text: str, segment: int, overlap: int, focus: int) -> DataFrame:
    """keys, start, end, task: windows of rows as JSON with their texts, of which the middle `focus` are to be labelled and the others are context."""
    placed = W.spans_of_labels(rows.withColumn("_l", F.lit("")), keys, row, "_l", [])
    windows = sliding(placed.groupBy(*keys).agg(F.count("*").alias("total")), "total", segment, overlap)
    first = F.floor((F.col("end") - F.col("start") - F.least(F.col("end") - F.col("start"), F.lit(focus))) / 2) + F.col("start")
    framed = windows.withColumns({"_f": first, "_g": first + F.least(F.col("end") - F.col("start"), F.lit(focus))})
    inside = framed.join(placed.select(*keys, "line", F.col(row).alias("_row"), F.col(text).alias("_text")), list(keys)).filter((F.col("line") >= F.col("start")) & (F.col("line") < F.col("end")))
    part = F.when(F.col("line") < F.col("_f"), "before").when(F.col("line") >= F.col("_g"), "after").otherwise("rows")
    each = F.array_sort(F.collect_list(F.struct("line", part.alias("part"), F.col("_row").alias("row"), F.col("_text").alias("text"))))
    out = inside.groupBy(*keys, "start", "end").agg(each.alias("_r"))
    of = lambda name: F.transform(F.filter("_r", lambda r: r["part"] == name), lambda r: F.struct(r["row"].alias("row"), r["text"].alias("text"))).alias(name)
    return out.select(*keys, "start", "end", F.to_json(F.struct(F.struct(of("rows"), of("before"), of("after")).alias("data"))).alias("task"))


def discovered_suite(exports: DataFrame, files: DataFrame, path: str, id_: str, size: str, labels: str, kind: str, most: int, seed: int = 0) -> DataFrame:
    """exports that have a file, with size and label buckets, and selected: representatives of kinds and strata."""
    known = matched_files(exports, files, path).filter("matched IS NOT NULL")
    one = known.withColumn("_one", F.lit(1))
    bucketed = cut_buckets(cut_buckets(one, ["_one"], size).withColumnRenamed("bucket", "size_bucket"), ["_one"], labels).withColumnRenamed("bucket", "label_bucket").drop("_one")
    chosen = representatives(bucketed, id_, kind, ["size_bucket", "label_bucket"], most, seed).select(id_, F.lit(True).alias("selected"))
    return bucketed.join(chosen, id_, "left").withColumn("selected", F.coalesce("selected", F.lit(False)))


def timed(spark: SparkSession, scenarios: Mapping[str, Callable[[], DataFrame]], warmups: int = 1, repeats: int = 3, clock: Callable[[], float] = time.perf_counter) -> DataFrame:
    """scenario, sample, seconds of running each scenario's DataFrame to its end."""
    out = []
    for name, make in scenarios.items():
        for i in range(warmups + repeats):
            began = clock()
            make().write.format("noop").mode("overwrite").save()
            if i >= warmups:
                out.append((name, i - warmups, clock() - began))
    return spark.createDataFrame(out, "scenario string, sample int, seconds double")


def raced(candidates: Sequence[str], targets: Sequence[str], score: Callable[[str, str], float], rounds: Sequence[int], keep: Sequence[int]) -> tuple[list[str], list[tuple[str, str, float]]]:
    """The candidates that are left, best first, and all scores: round i scores those still in on the first rounds[i] targets and keeps the best keep[i]; nothing is scored twice."""
    scores: dict[tuple[str, str], float] = {}
    left = list(dict.fromkeys(candidates))
    for n, most in zip(rounds, keep):
        for c in left:
            for t in targets[:n]:
                if (c, t) not in scores:
                    scores[c, t] = score(c, t)
        mean = {c: sum(scores[c, t] for t in targets[:n]) / max(1, len(targets[:n])) for c in left}
        left = sorted(left, key=lambda c: (-mean[c], c))[:most]
    return left, [(c, t, s) for (c, t), s in scores.items()]


@contextmanager
def pool(spark: SparkSession, name: str) -> Iterator[None]:
    """Jobs started inside run in a scheduler pool, which limits how much of the cluster a phase takes."""
    before = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
    try:
        yield
    finally:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", before)


def analysed(df: DataFrame, key: str, text: str, engine: Callable[[str], Mapping[str, float]] | None) -> DataFrame:
    """key, features (a map): what an engine says of each text; without one the map is empty."""
    kind = df.schema[key].dataType.simpleString()
    if engine is None:
        return df.select(key, F.create_map().cast("map<string,double>").alias("features"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({key: batch[key], "features": [{k: float(v) for k, v in engine(t or "").items()} for t in batch[text]]})

    return df.select(key, text).mapInPandas(run, f"{key} {kind}, features map<string,double>")


#: Columns of a benchmark's history, and where an evaluation's row has them.
HISTORY = ("run_timestamp", "run_dir", "source_file", "precision", "recall", "f1", "accuracy", "macro_f1", "gold_total", "gold_matched", "gold_missed", "tokens_total", "seconds", "seconds_per_recipe")


def history_row(evaluations: DataFrame, run: Column, folder: Column, tokens: Column, seconds: Column, recipes: Column) -> DataFrame:
    """Rows of HISTORY from evaluations (source, precision, recall, accuracy, macro_f1, gold, matched): f1, missed ranges and seconds a recipe are worked out."""
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    values = (run, folder, F.col("source"), F.col("precision"), F.col("recall"), f1, F.col("accuracy"), F.col("macro_f1"), F.col("gold"), F.col("matched"), F.col("gold") - F.col("matched"), tokens, seconds, F.when(recipes > 0, seconds / recipes))
    return evaluations.select(*(v.alias(n) for n, v in zip(HISTORY, values)))


def watchdog(events: DataFrame, keys: Sequence[str], when: str, message: str, now: Column, idle_after: float, repeats: int, done: Column) -> DataFrame:
    """keys, events, last, quiet (seconds until now), streak (of equal messages at the end), state: complete, looping, idle or working."""
    w = Window.partitionBy(*keys).orderBy(when)
    fresh = F.coalesce((F.lag(message).over(w) != F.col(message)), F.lit(True)).cast("int")
    runs = events.withColumns({"_f": fresh, "_done": done.cast("int")}).withColumn("_g", F.sum("_f").over(w))
    last = runs.groupBy(*keys).agg(F.count("*").alias("events"), F.max(when).alias("last"), F.max("_done").alias("_d"), F.max("_g").alias("_g"))
    streak = runs.groupBy(*keys, "_g").agg(F.count("*").alias("streak"))
    out = last.join(streak, [*keys, "_g"]).withColumn("quiet", (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("last").cast("timestamp"))) / 1e6)
    state = F.when(F.col("_d") == 1, "complete").when(F.col("streak") >= repeats, "looping").when(F.col("quiet") >= idle_after, "idle").otherwise("working")
    return out.withColumn("state", state).drop("_d", "_g")
