"""Layout and summary operators over boxes made from lineitem and spans of documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.operators import layout as Y
from larder.plans.registry import query
from larder.plans.tables import table

BOXES = "SELECT CAST(l_orderkey // 4 AS BIGINT) AS page, l_orderkey AS k, l_linenumber AS n, CAST(l_partkey % 1000 AS DOUBLE) AS x0, CAST(l_partkey % 1000 + l_quantity * 20 AS DOUBLE) AS x1, CAST(l_suppkey AS DOUBLE) AS y0, 1000.0::DOUBLE AS width FROM lineitem"


def boxes(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem")
    x0 = (F.col("l_partkey") % 1000).cast("double")
    return d.select(F.floor(F.col("l_orderkey") / 4).alias("page"), F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), x0.alias("x0"), (x0 + F.col("l_quantity") * 20).alias("x1"), F.col("l_suppkey").cast("double").alias("y0"), F.lit(1000.0).alias("width"))


BOUNDS = f"SELECT page, (x0 + nx) / 2 AS boundary FROM (SELECT *, lead(x0) OVER (PARTITION BY page ORDER BY x0) AS nx, count(*) OVER (PARTITION BY page) AS c FROM ({BOXES}) WHERE x1 - x0 < 700) WHERE c >= 4 AND nx - x0 >= 0.04 * width"


@query("lay_boundaries", BOUNDS)
def lay_boundaries(spark, sf_dir):
    return Y.column_boundaries(boxes(spark, sf_dir), ["page"], "x0", "x1", "width", 0.04)


@query(
    "lay_reading_order",
    f"""WITH b AS ({BOUNDS}), c AS (SELECT x.*, CASE WHEN x1 - x0 >= 700 THEN 0 ELSE (SELECT count(*) FROM b WHERE b.page = x.page AND b.boundary <= x.x0) END AS col FROM ({BOXES}) x)
    SELECT page, k, n, CAST(col AS INTEGER) AS "column", CAST(row_number() OVER (PARTITION BY page ORDER BY col, y0, x0, k, n) - 1 AS INTEGER) AS place FROM c""",
)
def lay_reading_order(spark, sf_dir):
    return Y.reading_order(boxes(spark, sf_dir), ["page"], ("x0", "x1", "y0"), "width", ["k", "n"], 0.04).select("page", "k", "n", "column", "place")


ROWS = "SELECT event_id // 500 AS src, event_id AS pos, user_id % 4 AS cells FROM events"


@query(
    "lay_table_runs",
    f"""WITH k AS (SELECT * FROM ({ROWS}) WHERE cells >= 2), f AS (SELECT *, CASE WHEN pos - lag(pos) OVER w = 1 AND abs(cells - lag(cells) OVER w) <= 1 THEN 0 ELSE 1 END AS s FROM k WINDOW w AS (PARTITION BY src ORDER BY pos)),
    g AS (SELECT *, sum(s) OVER (PARTITION BY src ORDER BY pos) AS g FROM f), c AS (SELECT src, g, cells, count(*) AS n FROM g GROUP BY ALL), d AS (SELECT src, g, cells AS columns FROM (SELECT *, row_number() OVER (PARTITION BY src, g ORDER BY n DESC, cells DESC) AS r FROM c) WHERE r = 1)
    SELECT CAST(src AS BIGINT) AS src, min(pos) AS start, max(pos) AS "end", count(*) AS n, any_value(columns) AS columns FROM g JOIN d USING (src, g) GROUP BY src, g HAVING count(*) >= 3""",
)
def lay_table_runs(spark, sf_dir):
    e = table(spark, sf_dir, "events").select((F.col("event_id") / 500).cast("long").alias("src"), F.col("event_id").alias("pos"), (F.col("user_id") % 4).alias("cells"))
    return Y.table_runs(e, ["src"], "pos", "cells")


LABELLED = """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents), o AS (SELECT doc_id, t, i, coalesce(sum(length(t) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM l),
lines AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS line, s, s + length(t) AS e FROM o WHERE trim(t) <> ''), k AS (SELECT doc_id, unnest(range(0, n_chars, 300)) AS s FROM documents), blocks AS (SELECT doc_id, s AS bs, s + 200 AS be, CASE s // 300 % 3 WHEN 0 THEN 'OTHER' WHEN 1 THEN 'A' ELSE 'B' END AS label FROM k),
m AS (SELECT l.doc_id, line, label, row_number() OVER (PARTITION BY l.doc_id, line ORDER BY least(e, be) - greatest(s, bs) DESC, label = 'OTHER', bs, be) AS r FROM lines l JOIN blocks b ON l.doc_id = b.doc_id AND s < be AND bs < e)
SELECT l.doc_id, CAST(l.line AS INTEGER) AS line, coalesce(label, 'OTHER') AS label FROM lines l LEFT JOIN m ON l.doc_id = m.doc_id AND l.line = m.line AND r = 1"""


@query("join_best_line_label", LABELLED)
def join_best_line_label(spark, sf_dir):
    from larder.functions.text import line_offsets

    d = table(spark, sf_dir, "documents")
    lines = line_offsets(d, "doc_id", "text").select("doc_id", "line", F.col("start").alias("s"), F.col("end").alias("e"))
    starts = F.when(F.col("n_chars") > 0, F.sequence(F.lit(0).cast("long"), F.col("n_chars") - 1, F.lit(300).cast("long")))
    blocks = d.select("doc_id", F.explode(starts).alias("s"))
    kind = F.floor(F.col("s") / 300) % 3
    blocks = blocks.select("doc_id", "s", (F.col("s") + 200).alias("e"), F.when(kind == 0, "OTHER").when(kind == 1, "A").otherwise("B").alias("label"))
    return Y.best_line_label(lines, blocks, ["doc_id"])


@query("agg_bucket_summary", "SELECT CASE WHEN l_quantity > 25 THEN 'core' ELSE 'rest' END AS bucket, CAST(sum(l_linenumber) AS BIGINT) AS l_linenumber, round(avg(CASE WHEN l_discount > 0 THEN l_tax END), 6) AS mean_l_tax, max(l_tax) AS max_l_tax FROM lineitem GROUP BY 1")
def agg_bucket_summary(spark, sf_dir):
    out = Y.bucket_summary(table(spark, sf_dir, "lineitem"), F.when(F.col("l_quantity") > 25, "core").otherwise("rest"), ["l_linenumber"], ["l_tax"], F.col("l_discount") > 0)
    return out.withColumn("mean_l_tax", F.round("mean_l_tax", 6))


@query("dsh_peer_stats", "WITH g AS (SELECT o_orderpriority, avg(o_totalprice) AS v FROM orders GROUP BY 1) SELECT o_orderpriority, round(v, 4) AS v, CAST(row_number() OVER (ORDER BY v DESC, o_orderpriority) AS INTEGER) AS place, round(v / (SELECT median(v) FROM g), 6) AS ratio FROM g")
def dsh_peer_stats(spark, sf_dir):
    g = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("v"))
    return Y.peer_stats(g, "o_orderpriority", "v").withColumns({"v": F.round("v", 4), "ratio": F.round("ratio", 6)})
