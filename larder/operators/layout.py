"""Page layout: columns of blocks by their boxes, reading order, and tables by consistent cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def column_boundaries(blocks: DataFrame, keys: Sequence[str], x0: str, x1: str, width: str, gap: float = 0.12, wide: float = 0.7, least: int = 4) -> DataFrame:
    """keys, boundary: middles of wide gaps between the left edges of blocks that aren't wide; pages with few such blocks have none."""
    narrow = blocks.filter(F.col(x1) - F.col(x0) < wide * F.col(width))
    w = Window.partitionBy(*keys).orderBy(x0)
    steps = narrow.withColumns({"_next": F.lead(x0).over(w), "_n": F.count("*").over(Window.partitionBy(*keys))})
    found = steps.filter((F.col("_n") >= least) & (F.col("_next") - F.col(x0) >= gap * F.col(width)))
    return found.select(*keys, ((F.col(x0) + F.col("_next")) / 2).alias("boundary"))


def reading_order(blocks: DataFrame, keys: Sequence[str], box: tuple[str, str, str], width: str, then: Sequence[str], gap: float = 0.12, wide: float = 0.7) -> DataFrame:
    """blocks with column and place: by page, column, top and left edge; wide blocks belong to the first column. box: x0, x1, y0."""
    x0, x1, y0 = box
    bounds = column_boundaries(blocks, keys, x0, x1, width, gap, wide).groupBy(*keys).agg(F.collect_list("boundary").alias("_b"))
    joined = blocks.join(bounds, list(keys), "left")
    passed = F.size(F.filter(F.coalesce("_b", F.array().cast("array<double>")), lambda b: b <= F.col(x0)))
    column = F.when(F.col(x1) - F.col(x0) >= wide * F.col(width), 0).otherwise(passed)
    placed = joined.withColumn("column", column).drop("_b")
    return placed.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("column", y0, x0, *then)) - 1)


def dominant_count(df: DataFrame, keys: Sequence[str], count: str) -> DataFrame:
    """keys, dominant: the most frequent count; the larger of equals."""
    return df.groupBy(*keys, count).agg(F.count("*").alias("_n")).groupBy(*keys).agg(F.max_by(F.col(count), F.struct("_n", count)).alias("dominant"))


def table_runs(rows: DataFrame, keys: Sequence[str], pos: str, cells: str, least: int = 3) -> DataFrame:
    """keys, start, end, n, columns: runs of adjacent rows whose numbers of cells are alike, within one; rows without cells end a run."""
    w = Window.partitionBy(*keys).orderBy(pos)
    known = rows.filter(F.col(cells) >= 2)
    fresh = F.lag(pos).over(w).isNull() | (F.col(pos) - F.lag(pos).over(w) > 1) | (F.abs(F.col(cells) - F.lag(cells).over(w)) > 1)
    grouped = known.withColumn("_s", fresh.cast("int")).withColumn("_g", F.sum("_s").over(w))
    sizes = grouped.groupBy(*keys, "_g").agg(F.min(pos).alias("start"), F.max(pos).alias("end"), F.count("*").alias("n"))
    columns = dominant_count(grouped, [*keys, "_g"], cells).withColumnRenamed("dominant", "columns")
    return sizes.filter(F.col("n") >= least).join(columns, [*keys, "_g"]).drop("_g")


def best_line_label(lines: DataFrame, blocks: DataFrame, keys: Sequence[str], other: str = "OTHER", width: int = 256) -> DataFrame:
    """keys, line, label: of the blocks (s, e, label; half-open) over a line (line, s, e) that with most overlap; proper labels and earlier blocks win ties."""
    from larder.operators.intervals import overlap, overlap_join

    right = blocks.select(*keys, F.col("s").alias("bs"), F.col("e").alias("be"), "label")
    met = overlap_join(lines, right, keys, ("s", "e", "bs", "be"), width, half_open=True)
    score = overlap(F.col("s"), F.col("e"), F.col("bs"), F.col("be"), half_open=True)
    w = Window.partitionBy(*keys, "line").orderBy(F.desc(score), F.col("label") == other, "bs", "be")
    best = met.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select(*keys, "line", "label")
    return lines.select(*keys, "line").join(best, [*keys, "line"], "left").withColumn("label", F.coalesce("label", F.lit(other)))


def bucket_summary(df: DataFrame, bucket: Column, counts: Sequence[str], scores: Sequence[str], scored: Column) -> DataFrame:
    """bucket, summed counts, mean scores of scored rows, and their greatest."""
    sums = [F.sum(c).alias(c) for c in counts]
    means = [F.avg(F.when(scored, F.col(s))).alias(f"mean_{s}") for s in scores] + [F.max(s).alias(f"max_{s}") for s in scores]
    return df.groupBy(bucket.alias("bucket")).agg(*sums, *means)


def peer_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """group, value, place (from 1, best first), ratio to the median; no ratio where the median isn't positive."""
    middle = df.agg(F.percentile(value, 0.5).alias("m")).first()["m"]  # one value
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc(value), group))
    return df.select(group, value, place.alias("place"), (F.col(value) / F.lit(middle) if middle and middle > 0 else F.lit(None).cast("double")).alias("ratio"))


def with_headers(cells: Column, second: Column, divider: Column) -> Column:
    """A struct of headers (null for none) and why, from the first row's cells, the second's, and whether the second is a divider of dashes.

    Without a divider the first row is a header where none of its cells has a digit and some cell of the second has one.
    """
    digit = lambda c: F.exists(c, lambda v: v.rlike(r"\d"))
    looks = ~digit(cells) & digit(second) & ~F.exists(cells, lambda v: F.trim(v) == "")
    named = F.transform(cells, lambda v, i: F.when(F.trim(v) == "", F.concat(F.lit("column_"), (i + 1).cast("string"))).otherwise(F.trim(v)))
    why = F.when(F.coalesce(divider, F.lit(False)), "divider").when(F.coalesce(looks, F.lit(False)), "first row")
    return F.struct(F.when(why.isNotNull(), named).alias("headers"), why.alias("why"))


def flattened_table(text: Column, least: int = 3) -> Column:
    """A struct of headers and rows of a table of two columns that was run into one line, such as 'Fahrenheit Celsius 300 150 350 175 400 205'; null where it isn't one.

    Headers are the words before the first number, in halves; values are numbers with their units.
    """
    t = F.trim(F.regexp_replace(text, r"\s+", " "))
    value = r"\d+(?:[./]\d+)?(?:\s*(?:°[FC]?|%|[a-zA-Z]{1,12}\.?))?"
    head = F.filter(F.split(F.regexp_extract(t, r"^([^\d]+?)\s*(?=\d)", 1), " "), lambda w: w != "")
    values = F.regexp_extract_all(t, F.lit(value), F.lit(0))
    body = F.regexp_replace(t, r"^[^\d]+", "")
    left = F.regexp_replace(F.regexp_replace(body, value, ""), r"\s+", "")
    half = F.floor(F.size(head) / 2).cast("int")
    headers = F.array(F.array_join(F.slice(head, F.lit(1), half), " "), F.array_join(F.slice(head, half + 1, F.size(head)), " "))
    rows = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor(F.size(values) / 2).cast("int") - 1)), lambda i: F.array(F.trim(F.get(values, 2 * i)), F.trim(F.get(values, 2 * i + 1))))
    ok = (F.size(head) >= 2) & (F.size(head) % 2 == 0) & (F.size(values) % 2 == 0) & (F.size(values) >= 2 * least) & (left == "")
    return F.when(ok, F.struct(headers.alias("headers"), rows.alias("rows")))
