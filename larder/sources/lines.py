"""Texts to lines and blocks: markdown, wrapped lines, character ranges, segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def line_at(text: Column, offset: Column) -> Column:
    """The 1-based line that holds a character offset."""
    head = F.substring(text, F.lit(1), offset)
    return (F.char_length(head) - F.char_length(F.replace(head, F.lit("\n"))) + 1).cast("int")


def markdown_blocks(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, block, kind, text, first, last: headings, list items, and paragraphs of consecutive other lines (1-based lines)."""
    rows = df.select(key, F.posexplode(F.split(text, "\n")).alias("_i", "_t")).withColumn("_t", F.trim("_t"))
    kind = F.when(F.col("_t") == "", "blank").when(F.col("_t").rlike(r"^#{1,6}\s"), "heading").when(F.col("_t").rlike(r"^([-*+]|\d+[.)])\s"), "item").otherwise("paragraph")
    w = Window.partitionBy(key).orderBy("_i")
    rows = rows.withColumn("kind", kind)
    starts = (F.col("kind") != "paragraph") | (F.coalesce(F.lag("kind").over(w), F.lit("blank")) != "paragraph")
    grouped = rows.withColumn("_s", starts.cast("int")).withColumn("_g", F.sum("_s").over(w)).filter("kind <> 'blank'")
    out = grouped.groupBy(key, "_g").agg(F.first("kind").alias("kind"), F.array_sort(F.collect_list(F.struct("_i", "_t"))).alias("_a"), F.min("_i").alias("_lo"), F.max("_i").alias("_hi"))
    block = F.row_number().over(Window.partitionBy(key).orderBy("_lo")) - 1
    body = F.array_join(F.transform("_a", lambda r: r["_t"]), " ")
    return out.select(key, block.alias("block"), "kind", F.regexp_replace(body, r"^(#{1,6}|[-*+]|\d+[.)])\s+", "").alias("text"), (F.col("_lo") + 1).alias("first"), (F.col("_hi") + 1).alias("last"))


def unwrapped(df: DataFrame, key: str, order: str, text: str) -> DataFrame:
    """key, block, text: lines joined to their predecessor unless it ends a sentence or the line starts a list item."""
    t = F.trim(text)
    w = Window.partitionBy(key).orderBy(order)
    rows = df.select(key, order, t.alias("_t")).filter("_t <> ''")
    before = F.lag("_t").over(w)
    starts = before.isNull() | before.rlike("[.!?]$") | F.col("_t").rlike(r"^(\d+[.)]|[-*•])")
    rows = rows.withColumn("_s", starts.cast("int")).withColumn("_g", F.sum("_s").over(w))
    out = rows.groupBy(key, "_g").agg(F.array_sort(F.collect_list(F.struct(order, "_t"))).alias("_a"))
    return out.select(key, (F.col("_g") - 1).cast("int").alias("block"), F.array_join(F.transform("_a", lambda r: r["_t"]), " ").alias("text"))


def segments(df: DataFrame, key: str, order: str, starts: Column) -> DataFrame:
    """df with segment: it grows by one where a row starts a segment; what comes before the first is segment 0."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_s", F.coalesce(starts, F.lit(False)).cast("int")).withColumn("segment", F.sum("_s").over(w)).drop("_s")


def under_headers(df: DataFrame, key: str, order: str, header: Column, name: str = "section", first: str = "main") -> DataFrame:
    """df with the last header at or before each row; `first` where there is none. header: null on other rows."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.coalesce(F.last(header, ignorenulls=True).over(w), F.lit(first)))
