"""Recipes in pages and plain texts: JSON-LD objects, and texts that hold several recipes."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.recipes import line_kind
from larder.functions.text import title_like
from larder.sources.html import json_ld


def canonical_hash(value: object) -> str:
    """SHA-256 of a JSON value with sorted keys and no blanks."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def _recipes(value: object) -> Iterator[dict]:
    if isinstance(value, list):
        for v in value:
            yield from _recipes(v)
    elif isinstance(value, dict):
        kinds = value.get("@type")
        if "recipe" in [str(k).lower() for k in (kinds if isinstance(kinds, list) else [kinds])]:
            yield value
        else:
            for v in value.values():
                yield from _recipes(v)


def _steps(value: object) -> Iterator[str]:
    if isinstance(value, str):
        yield from (s for s in map(str.strip, value.split("\n")) if s)
    elif isinstance(value, list):
        for v in value:
            yield from _steps(v)
    elif isinstance(value, dict):
        inner = value.get("itemListElement")
        yield from _steps(inner if inner is not None else value.get("text") or value.get("name") or "")


def _texts(value: object) -> list[str]:
    found = value if isinstance(value, list) else [] if value is None else [value]
    return [t for t in (" ".join(str(x).split()) for x in found) if t]


def _first(value: object) -> str | None:
    """The first text of a value that may be a text, a number, or a list of these."""
    return next(iter(_texts(value)), None)


def schema_recipes(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, recipe, signature, name, ingredients, steps, yield, total_time: a row for each different recipe object of a page."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [key, "recipe", "signature", "name", "ingredients", "steps", "yield", "total_time"]
        for df in batches:
            rows = []
            for k, scripts in zip(df[key], df["_ld"]):
                seen: set[str] = set()
                for s in scripts if scripts is not None else []:
                    try:
                        found = list(_recipes(json.loads(s)))
                    except ValueError:
                        continue
                    for r in found:
                        sign = canonical_hash(r)
                        if sign not in seen:
                            seen.add(sign)
                            rows.append((k, len(seen) - 1, sign, _first(r.get("name")), _texts(r.get("recipeIngredient")), list(dict.fromkeys(_steps(r.get("recipeInstructions")))), _first(r.get("recipeYield")), _first(r.get("totalTime"))))
            yield pd.DataFrame(rows, columns=names)

    kind = pages.schema[key].dataType.simpleString()
    found = pages.select(key, json_ld(F.col(html)).alias("_ld")).filter(F.size("_ld") > 0)
    return found.mapInPandas(run, f"{key} {kind}, recipe int, signature string, name string, ingredients array<string>, steps array<string>, yield string, total_time string")


def schema_confidence(name: Column, ingredients: Column, steps: Column, least_ingredients: int = 2, least_steps: int = 1) -> Column:
    """0 to 1: a name, and enough ingredients and steps (a part for some of them)."""
    part = lambda x, least, w: F.when(F.size(x) >= least, w).when(F.size(x) > 0, w / 2).otherwise(0.0)
    return F.when(F.coalesce(F.trim(name), F.lit("")) != "", 0.3).otherwise(0.0) + part(ingredients, least_ingredients, 0.4) + part(steps, least_steps, 0.3)


def recipe_starts(lines: DataFrame, key: str, order: str, text: str) -> DataFrame:
    """key, start: by yield lines, the title-like line before each (and the text's beginning); only where there are several."""
    t = F.trim(F.col(text))
    w = Window.partitionBy(key).orderBy(order)
    rows = lines.filter(t != "").withColumns({"_at": F.lag(order).over(w), "_before": F.lag(text).over(w)})
    starts = rows.filter((line_kind(F.col(text)) == "yield") & title_like(F.col("_before"))).select(key, F.col("_at").alias("start"))
    begins = starts.select(key).distinct().withColumn("start", F.lit(0).cast(starts.schema["start"].dataType))
    all_starts = starts.unionByName(begins).distinct()
    return all_starts.join(all_starts.groupBy(key).count().filter("count > 1").select(key), key)


def split_texts(texts: DataFrame, key: str, text: str) -> DataFrame:
    """key, part, text: one recipe a part, by the first that gives several: yield lines, delimiter lines, first-level headings; else the whole."""
    lines = texts.select(key, F.posexplode(F.split(text, "\n")).alias("line", "_t"))
    by_yield = recipe_starts(lines, key, "line", "_t").withColumn("_way", F.lit(0))
    t = F.trim("_t")
    delimiters = lines.filter(t.rlike(r"^(?:={3,}|-{3,}|\*{3,})$")).select(key, (F.col("line") + 1).alias("start"), F.lit(1).alias("_way"))
    headings = lines.filter(t.rlike(r"^#\s")).select(key, F.col("line").alias("start"), F.lit(2).alias("_way"))
    several = headings.groupBy(key).count().filter("count > 1").select(key)
    begins = delimiters.select(key).distinct().withColumns({"start": F.lit(0), "_way": F.lit(1)})
    starts = by_yield.select(key, "start", "_way").unionByName(delimiters).unionByName(begins).unionByName(headings.join(several, key))
    best = starts.groupBy(key).agg(F.min("_way").alias("_way"))
    chosen = starts.join(best, [key, "_way"]).select(key, F.col("start").alias("line"), F.lit(1).alias("_s")).distinct()
    w = Window.partitionBy(key).orderBy("line")
    parts = lines.join(chosen, [key, "line"], "left").withColumn("_p", F.coalesce(F.sum("_s").over(w), F.lit(0)))
    kept = parts.filter(~t.rlike(r"^(?:={3,}|-{3,}|\*{3,})$"))
    joined = kept.groupBy(key, "_p").agg(F.array_sort(F.collect_list(F.struct("line", "_t"))).alias("_a"))
    out = joined.select(key, "_p", F.regexp_replace(F.array_join(F.transform("_a", lambda r: r["_t"]), "\n"), r"^\s+|\s+$", "").alias("text")).filter("text <> ''")
    return out.select(key, (F.row_number().over(Window.partitionBy(key).orderBy("_p")) - 1).alias("part"), "text")


def json_ld_text(name: Column, ingredients: Column, steps: Column, servings: Column) -> Column:
    """A recipe as schema.org JSON-LD."""
    step = F.transform(steps, lambda s: F.struct(F.lit("HowToStep").alias("@type"), s.alias("text")))
    return F.to_json(F.struct(F.lit("https://schema.org").alias("@context"), F.lit("Recipe").alias("@type"), name.alias("name"), ingredients.alias("recipeIngredient"), step.alias("recipeInstructions"), servings.alias("recipeYield")))
