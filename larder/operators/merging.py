"""Merging of tables that describe the same things: fills, appends, overrides, ownership."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType


def filled(a: Column, b: Column, kind) -> Column:
    """a, or b where a is null, an empty text, list or map."""
    if isinstance(kind, StringType):
        return F.coalesce(F.nullif(a, F.lit("")), b)
    if isinstance(kind, (ArrayType, MapType)):
        return F.coalesce(F.when(F.size(a) > 0, a), b)
    return F.coalesce(a, b)


def merged_records(left: DataFrame, right: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """All records of both: the left one's fields win, missing ones are filled from the right; null keys never match.

    Of several left (or right) records with one key the first is matched, the others of the left stay as they are.
    """
    # Records without a key would meet in one task, so they don't enter the window.
    w = Window.partitionBy(key).orderBy(*order)
    numbered = left.filter(F.col(key).isNotNull()).withColumn("_n", F.row_number().over(w))
    first = right.filter(F.col(key).isNotNull()).withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
    names = {c: f"_r_{c}" for c in right.columns}
    joined = numbered.join(first.withColumnsRenamed(names), (F.col(key) == F.col(names[key])) & (F.col("_n") == 1), "full")
    columns = [filled(F.col(c), F.col(names[c]), left.schema[c].dataType).alias(c) if c in names else F.col(c) for c in left.columns]
    unkeyed = right.filter(F.col(key).isNull()).select(*(F.col(c) if c in right.columns else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns))
    return joined.select(*columns).unionByName(left.filter(F.col(key).isNull())).unionByName(unkeyed)


def appended(seen: DataFrame, more: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The seen rows, and those of `more` whose keys aren't among them."""
    return seen.unionByName(more.join(seen.select(*keys).distinct(), list(keys), "left_anti"), allowMissingColumns=True)


def overridden(rows: DataFrame, by_row: DataFrame, by_block: DataFrame, row: str, block: str, value: str) -> DataFrame:
    """rows with the value by row, else by block, else their own."""
    a = by_row.select(row, F.col(value).alias("_a"))
    b = by_block.select(block, F.col(value).alias("_b"))
    return rows.join(a, row, "left").join(b, block, "left").withColumn(value, F.coalesce("_a", "_b", value)).drop("_a", "_b")


def ownership(claims: DataFrame, released: DataFrame, rows: DataFrame, row: str, owner: str) -> DataFrame:
    """row, owner (null for available rows), problem: 'two owners' or 'owned and released'."""
    owned = claims.groupBy(row).agg(F.count_distinct(owner).alias("_n"), F.min(owner).alias("_o"))
    gone = released.select(row).distinct().withColumn("_gone", F.lit(True))
    joined = rows.select(row).join(owned, row, "left").join(gone, row, "left")
    problem = F.when(F.col("_n") > 1, "two owners").when(F.col("_o").isNotNull() & F.col("_gone"), "owned and released")
    return joined.select(row, F.col("_o").alias(owner), problem.alias("problem"))


def released(claims: DataFrame, releases: DataFrame, row: str, owner: str) -> tuple[DataFrame, DataFrame]:
    """Claims without the released ones, and releases that name no claim."""
    keys = [row, owner]
    return claims.join(releases.select(*keys), keys, "left_anti"), releases.join(claims.select(*keys), keys, "left_anti")


def ranked_identity(gold: DataFrame, found: DataFrame, ways: Sequence[tuple[str, Sequence[str]]], gold_id: str, found_id: str) -> DataFrame:
    """gold_id, found_id, way: each gold row's match by the first way (name, columns) that gives one; ties to the smaller id."""
    tried = []
    for rank, (name, columns) in enumerate(ways):
        right = found.select(*columns, F.col(found_id).alias("_f"))
        tried.append(gold.join(right, list(columns)).select(F.col(gold_id), F.col("_f").alias(found_id), F.lit(name).alias("way"), F.lit(rank).alias("_rank")))
    every = tried[0]
    for t in tried[1:]:
        every = every.unionByName(t)
    w = Window.partitionBy(gold_id).orderBy("_rank", found_id)
    return every.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r", "_rank")


def matched_files(exports: DataFrame, files: DataFrame, path: str) -> DataFrame:
    """exports with the path of the file of the same name, or the reason why there is none."""
    from larder.functions.fields import basename

    named = files.select(F.lower(basename(F.col(path))).alias("_name"), F.col(path).alias("matched")).groupBy("_name").agg(F.min("matched").alias("matched"))
    joined = exports.withColumn("_name", F.lower(basename(F.col(path)))).join(named, "_name", "left").drop("_name")
    return joined.withColumn("reason", F.when(F.col("matched").isNull(), F.when(F.col(path).isNull(), "no file name").otherwise("no such file")))


def contained_phrases(texts: DataFrame, phrases: DataFrame, keys: Sequence[str], text: str, phrase: str, most_words: int = 4) -> DataFrame:
    """keys, text row and phrase row pairs where the phrase's words occur in a row in the text: an equi-join on runs of words.

    Both sides share the keys, such as a document; only phrases of up to `most_words` words can match.
    """
    words = F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    runs = [_runs(n) for n in range(1, most_words + 1)]
    grams = texts.withColumn("_w", words).withColumn("_g", F.explode(F.array_distinct(F.flatten(F.array(*runs))))).drop("_w")
    named = phrases.withColumn("_g", F.array_join(F.filter(F.split(F.lower(F.col(phrase)), r"[^\p{L}\p{N}]+"), lambda w: w != ""), " "))
    # Sizes are estimated before runs are exploded, so a side that looks small may be far too large to broadcast.
    return grams.join(named.hint("merge"), [*keys, "_g"]).drop("_g")


def _runs(n: int) -> Column:
    places = F.when(F.size("_w") >= n, F.sequence(F.lit(1), F.size("_w") - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.array_join(F.slice("_w", i, n), " "))
