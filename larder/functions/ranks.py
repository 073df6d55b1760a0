"""Global order without a single task: positions and average ranks over whole tables.

A window without a partition would send every row to one task. Here rows are dealt to buckets between
quantiles of the ordering column, counted by bucket (one row a bucket), and numbered within their bucket. Buckets
grow in number with the rows. A value that fills several buckets by itself is heavy: its rows are dealt on by quantiles
of the next column for positions, and share one rank, which is broadcast, for ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

#: Buckets of the ordering column: so many at least and at most, and rows of each between.
BUCKETS, MOST_BUCKETS, BUCKET_ROWS = 64, 4096, 4_000_000
#: Up to so many distinct values (16 bytes each) their ranks are broadcast to the rows; beyond, ranks come from windows.
BROADCAST_VALUES = 200_000


def _bounds(df: DataFrame, column: str, buckets: int) -> list[float]:
    return df.agg(F.percentile_approx(F.col(column), [i / buckets for i in range(1, buckets)], 20 * buckets).alias("b")).first()["b"] or []


def _place(x: Column, edges: list[float]) -> Column:
    """How many edges are under a value, by halving: a dozen steps however many there are."""
    if not edges:
        return F.lit(0)
    table, step, steps = F.array(*map(F.lit, edges)), 1 << (len(edges).bit_length() - 1), []
    while step:
        steps.append(step)
        step //= 2
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, s: F.when(F.get(table, at + s - 1) < x, at + s).otherwise(at))


def _heavy(bounds: list[float]) -> list[float]:
    """Values that are several quantiles in a row: a 32nd of all rows at least where there are 64 buckets."""
    return sorted({a for a, b in zip(bounds, bounds[1:]) if a == b})


def _buckets(rows: int) -> int:
    return max(BUCKETS, min(MOST_BUCKETS, rows // BUCKET_ROWS))


def _starts(dealt: DataFrame, by: list[str]) -> Column:
    """Rows before each bucket: a map from the bucket, as text, from one collected row a bucket."""
    counts = sorted((tuple(r[c] for c in by), r["count"]) for r in dealt.groupBy(*by).count().collect())
    total, pairs = 0, []
    for key, n in counts:
        pairs += [F.lit(":".join(map(str, key))), F.lit(total).cast("long")]
        total += n
    return F.element_at(F.create_map(*pairs), F.concat_ws(":", *(F.col(c).cast("string") for c in by))) if pairs else F.lit(0).cast("long")


def numbered(df: DataFrame, column: str, then: list[str], name: str = "position") -> DataFrame:
    """df with its 0-based place in the order of a numeric column and further columns; nulls first."""
    buckets = _buckets(df.count())
    bounds = _bounds(df, column, buckets)
    x = F.col(column)
    dealt = df.withColumn("_bucket", F.when(x.isNull(), -1).otherwise(_place(x, sorted(set(bounds)))))
    heavy, part = _heavy(bounds), F.lit(0)
    if heavy and then and isinstance(df.schema[then[0]].dataType, NumericType):
        inner = [i / BUCKETS for i in range(1, BUCKETS)]
        for r in df.filter(x.isin(heavy)).groupBy(column).agg(F.percentile_approx(then[0], inner, 20 * BUCKETS).alias("b")).collect():  # heavy values are few
            part = F.when(x == r[column], F.when(F.col(then[0]).isNull(), -1).otherwise(_place(F.col(then[0]), sorted(set(r["b"] or []))))).otherwise(part)
    # A bucket holds the values up to its edge, of which only the last may be heavy; so the others come first.
    dealt = dealt.withColumns({"_last": F.when(x.isin(heavy), 1).otherwise(0) if heavy else F.lit(0), "_part": part})
    by = ["_bucket", "_last", "_part"]
    place = F.row_number().over(Window.partitionBy(*by).orderBy(column, *then)) - 1 + _starts(dealt, by)
    return dealt.withColumn(name, place).drop(*by)


def average_ranks(df: DataFrame, column: str, name: str) -> DataFrame:
    """df with the average rank of a non-null numeric column: ties share the mean of their places (from 1)."""
    size = df.agg(F.count("*").alias("n"), F.approx_count_distinct(column).alias("d")).first()
    if size["d"] <= BROADCAST_VALUES // 2:  # the estimate is within a few percent
        return df.join(F.broadcast(_ranks_of_values(df, column, name)), column)
    bounds = _bounds(df, column, _buckets(size["n"]))
    heavy, x = _heavy(bounds), F.col(column)
    dealt = df.withColumn("_bucket", _place(x, sorted(set(bounds)))).withColumn("_last", F.when(x.isin(heavy), 1).otherwise(0) if heavy else F.lit(0))
    by = ["_bucket", "_last"]
    placed = dealt.withColumn("_start", _starts(dealt, by))
    light = placed.filter("_last = 0")
    least, ties = F.rank().over(Window.partitionBy(*by).orderBy(column)), F.count("*").over(Window.partitionBy(*by, column))
    ranked = light.withColumn(name, least + (ties - 1) / F.lit(2.0) + F.col("_start")).drop(*by, "_start")
    if not heavy:
        return ranked
    rest = placed.filter("_last = 1")
    shared = rest.groupBy(column).agg((F.first("_start") + (F.count("*") + 1) / F.lit(2.0)).alias(name))
    return ranked.unionByName(rest.drop(*by, "_start").join(F.broadcast(shared), column))  # heavy values are fewer than buckets


def _ranks_of_values(df: DataFrame, column: str, name: str) -> DataFrame:
    """column, rank of its different values, which are few."""
    counts = df.groupBy(column).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy(column).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counts.select(column, (before + (F.col("_n") + 1) / F.lit(2.0)).alias(name))
