"""From lines to recipes: labels, spans, ownership, what lies outside, and drafts.

Each step is a DataFrame from the one before; `stage` runs them in order and returns all tables. A document's lines
are one sequence, so only the session fold needs them in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.recipes import UNITS, VERBS, line_kind, servings
from larder.functions.text import title_like
from larder.operators.folds import sessions
from larder.operators.sequences import named_spans
from larder.sources.recipes import json_ld_text

#: What belongs to a recipe besides its title.
LOCAL = ("ingredient", "instruction", "numbered", "yield", "time", "heading", "note")


@dataclass
class Staged:
    rows: DataFrame  # key, line, text, label, recipe (null outside of accepted spans)
    spans: DataFrame  # key, recipe, start, end, accepted, reason
    outside: DataFrame  # key, label (category), start, end, span_id of rows that no recipe owns
    drafts: DataFrame  # key, recipe, title, servings, ingredients, steps, json


def labelled(lines: DataFrame, key: str, line: str, text: str, units=UNITS, verbs=VERBS) -> DataFrame:
    """key, line, text, label: the line's kind; prose that looks like a title, and before ingredients or a yield, is the title."""
    return _labelled(lines, key, line, text, units, verbs).drop("place")


def _labelled(lines: DataFrame, key: str, line: str, text: str, units, verbs) -> DataFrame:
    # Places come first, so that kinds are worked out after the shuffle: a small file is read by few tasks.
    place = (F.row_number().over(Window.partitionBy(key).orderBy(line)) - 1).cast("long")
    rows = lines.filter(F.trim(text) != "").select(key, line, F.trim(text).alias("text"), place.alias("place")).withColumn("_k", line_kind(F.col("text"), units, verbs))
    ahead = Window.partitionBy(key).orderBy(line).rowsBetween(1, 2)
    soon = F.coalesce(F.max(F.col("_k").isin("ingredient", "yield")).over(ahead), F.lit(False))
    title = (F.col("_k") == "prose") & title_like(F.col("text")) & soon
    return rows.withColumn("label", F.when(title, "title").when(F.col("_k") == "numbered", "instruction").otherwise(F.col("_k"))).drop("_k")


def recipe_spans(rows: DataFrame, key: str, line: str) -> DataFrame:
    """key, recipe, start, end, accepted, reason by sessions of titles; positions are places among the rows that aren't blank."""
    placed = rows.withColumn("_p", F.row_number().over(Window.partitionBy(key).orderBy(line)) - 1)
    found = sessions(placed.withColumn("_p", F.col("_p").cast("long")), [key], "_p", "label", "title", LOCAL, ["ingredient", "instruction"])
    named = found.withColumn("recipe", F.row_number().over(Window.partitionBy(key).orderBy("start")) - 1)
    return named.withColumn("reason", F.when(~F.col("accepted"), "no ingredients or no instructions"))


def stage(lines: DataFrame, key: str, line: str, text: str, units=UNITS, verbs=VERBS) -> Staged:
    """All tables for lines of documents (key, line, text)."""
    rows = _labelled(lines, key, line, text, units, verbs)
    spans = recipe_spans(rows.select(key, line, "text", "label"), key, line)
    # Accepted spans don't overlap: a row belongs to the last that has begun, unless that has ended.
    begun = F.last("_s", ignorenulls=True).over(Window.partitionBy(key).orderBy("place", F.col("_s").isNull()).rowsBetween(Window.unboundedPreceding, 0))
    marks = spans.filter("accepted").select(key, F.col("start").alias("place"), F.struct("end", "recipe").alias("_s"))
    full = rows.unionByName(marks, allowMissingColumns=True).withColumn("_in", begun).filter("_s IS NULL")
    full = full.withColumn("recipe", F.when(F.col("place") <= F.col("_in.end"), F.col("_in.recipe"))).drop("_s", "_in")
    category = F.when(F.col("label").isin("note", "prose"), "candidate").otherwise("exclude")
    outside = named_spans(full.filter("recipe IS NULL").select(key, "place", category.alias("category")), [key], "place", "category")
    part = lambda label: F.transform(F.array_sort(F.collect_list(F.when(F.col("label") == label, F.struct("place", "text")))), lambda r: r["text"])
    drafts = full.filter("recipe IS NOT NULL").groupBy(key, "recipe").agg(F.min(F.when(F.col("label") == "title", F.col("text"))).alias("title"), F.max(F.when(F.col("label") == "yield", servings(F.col("text")))).alias("servings"), part("ingredient").alias("ingredients"), part("instruction").alias("steps"))
    drafts = drafts.withColumn("json", json_ld_text(F.col("title"), F.col("ingredients"), F.col("steps"), F.col("servings").cast("string")))
    return Staged(full.drop("place"), spans, outside, drafts)
