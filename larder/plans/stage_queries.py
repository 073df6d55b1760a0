"""Stages, suites and watchdogs over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.operators import folds
from larder.operators import stages as G
from larder.plans.registry import query
from larder.plans.tables import table
from larder.plans.views import lines


@query("stage_headers", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'ingredients' WHEN 1 THEN 'instructions' WHEN 2 THEN 'other' END AS kind, CASE p_partkey % 4 WHEN 0 THEN 'main' WHEN 1 THEN 'main' WHEN 2 THEN regexp_replace(lower(p_type), '[^a-z0-9]+', '_', 'g') END AS key FROM part")
def stage_headers(spark, sf_dir):
    k = F.col("p_partkey") % 4
    h = G.header_kind(F.when(k == 0, "Ingredients:").when(k == 1, " Method").when(k == 2, F.concat(F.lit("For the "), "p_type")).otherwise(F.concat(F.lit("Stir the "), "p_type", F.lit(" well."))))
    return table(spark, sf_dir, "part").select("p_partkey", h["kind"].alias("kind"), h["key"].alias("key"))


@query("stage_text_sections", "SELECT o_orderkey, k AS kind, CASE k WHEN 'ingredients' THEN o_orderkey || ' eggs' ELSE 'Mix.|' || o_orderstatus END AS lines FROM orders, (VALUES ('ingredients'), ('instructions')) t(k)")
def stage_text_sections(spark, sf_dir):
    text = F.concat(F.lit("Pie\nIngredients\n"), "o_orderkey", F.lit(" eggs\n\nDirections:\nMix.\n"), "o_orderstatus")
    return G.text_sections(table(spark, sf_dir, "orders").select("o_orderkey", text.alias("t")), "o_orderkey", "t").withColumn("lines", F.array_join("lines", "|"))


@query("stage_bundles", "SELECT conv_id, sha256(array_to_string(list(text ORDER BY turn), chr(10))) AS source_hash, count(*) AS n FROM conversations WHERE trim(regexp_replace(text, '\\s+', ' ', 'g')) <> '' GROUP BY conv_id")
def stage_bundles(spark, sf_dir):
    return G.bundled(table(spark, sf_dir, "conversations"), "conv_id", "turn", "turn", "text").groupBy("conv_id", "source_hash").agg(F.count("*").alias("n"))


@query("stage_refined", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN lower(o_orderpriority) ELSE o_orderpriority END AS title, o_orderkey % 3 = 0 AND lower(o_orderpriority) <> o_orderpriority AS corrected FROM orders")
def stage_refined(spark, sf_dir):
    d = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("title"), F.array("o_orderstatus").alias("ingredients"))
    hook = lambda df: df.filter("o_orderkey % 3 = 0").withColumn("title", F.lower("title"))
    return G.refined(d, ["o_orderkey"], hook, ["title", "ingredients"]).select("o_orderkey", "title", "corrected")


FINAL = "SELECT user_id, event_id, CASE WHEN event_type <> 'view' THEN event_type WHEN event_id % 3 = 0 THEN 'known' ELSE 'other' END AS c, event_type = 'view' AND event_id % 3 = 0 AS decided FROM events"


def finalized(spark, sf_dir):
    d = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("event_type").alias("c"))
    return G.finalized(d, ["user_id"], "event_id", "c", "view", d.filter("event_id % 3 = 0").withColumn("c", F.lit("known")))


@query("stage_finalized", FINAL)
def stage_finalized(spark, sf_dir):
    return finalized(spark, sf_dir)[0].select("user_id", "event_id", "c", "decided")


@query("stage_final_spans", f'SELECT user_id, c, min(event_id) AS start, max(event_id) + 1 AS "end" FROM (SELECT *, event_id - row_number() OVER (PARTITION BY user_id, c ORDER BY event_id) AS g FROM ({FINAL})) GROUP BY user_id, c, g')
def stage_final_spans(spark, sf_dir):
    return finalized(spark, sf_dir)[1].select("user_id", "c", "start", "end")


@query("stage_row_evidence", "WITH t AS (SELECT conv_id, turn, role, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS t, row_number() OVER (PARTITION BY conv_id, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) ORDER BY turn) AS k FROM conversations) SELECT conv_id, turn, role AS labels, false AS conflict FROM t")
def stage_row_evidence(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    out = G.row_evidence(c.withColumn("text", F.concat(F.lit("  "), "text")).withColumnRenamed("turn", "o"), c, ["conv_id"], "text", "role", "turn", "o")
    return out.withColumn("labels", F.array_join("labels", ","))


@query("stage_semantics", "SELECT p_partkey, p_name AS title, CAST(p_size AS DOUBLE) AS quantity, 'cup' AS unit, 'Mix it.' AS steps, 'Variation: none' AS variants, p_size % 9 + 1 AS units FROM part")
def stage_semantics(spark, sf_dir):
    s = G.semantics(F.concat("p_name", F.lit(" ")), F.array(F.concat("p_size", F.lit(" cups flour"))), F.array(F.lit("Mix it."), F.lit("Variation: none")), F.concat(F.lit("Serves "), (F.col("p_size") % 9 + 1).cast("string")), F.lit(None).cast("string"))
    return table(spark, sf_dir, "part").withColumn("s", s).select("p_partkey", "s.title", F.col("s.ingredients")[0]["quantity"].alias("quantity"), F.col("s.ingredients")[0]["unit"].alias("unit"), F.array_join("s.steps", "|").alias("steps"), F.array_join("s.variants", "|").alias("variants"), F.col("s.yield.units").alias("units"))


@query("stage_predictions")
def stage_predictions(spark, sf_dir):
    return G.prediction_run(lines(spark, sf_dir), "doc_id", "line", "text").rows.select("doc_id", "row", "label", F.md5("text").alias("t"))


@query("stage_tasks", """WITH n AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id), w AS (SELECT conv_id, n, unnest(range(0, n, 3)) AS s FROM n), k AS (SELECT conv_id, s AS start, least(s + 4, n) AS "end" FROM w WHERE s = 0 OR s + 1 < n) SELECT conv_id, start, "end", CAST(least("end" - start, 2) AS INTEGER) AS n_rows FROM k""")
def stage_tasks(spark, sf_dir):
    out = G.labelling_tasks(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), ["conv_id"], "turn", "text", 4, 1, 2)
    return out.select("conv_id", "start", "end", F.size(F.from_json(F.get_json_object("task", "$.data.rows"), "array<struct<row:long>>")).alias("n_rows"))


@query("stage_history_rows", "SELECT CAST(l_orderkey AS VARCHAR) || '.' || l_linenumber AS source_file, round(coalesce(2 * l_discount * l_tax / nullif(l_discount + l_tax, 0), 0), 6) AS f1, l_quantity - l_linenumber AS gold_missed, l_quantity / l_linenumber AS seconds_per_recipe FROM lineitem")
def stage_history_rows(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").select(F.concat_ws(".", "l_orderkey", "l_linenumber").alias("source"), F.col("l_discount").alias("precision"), F.col("l_tax").alias("recall"), F.lit(0.0).alias("accuracy"), F.lit(0.0).alias("macro_f1"), F.col("l_quantity").alias("gold"), F.col("l_linenumber").alias("matched"))
    out = G.history_row(d, F.lit("t"), F.lit("d"), F.lit(1), F.col("gold"), F.col("matched"))
    return out.select("source_file", F.round("f1", 6).alias("f1"), "gold_missed", "seconds_per_recipe")


@query("stage_suite", "WITH f AS (SELECT min(page_id) AS page_id FROM pages GROUP BY lower(list_last(string_split(rtrim(url, '/'), '/'))) HAVING count(*) = 1) SELECT count(*) AS n, least(12, count(*)) AS selected FROM f")
def stage_suite(spark, sf_dir):
    from pyspark.sql import Window

    from larder.functions.fields import basename

    name = F.lower(basename(F.col("url")))
    p = table(spark, sf_dir, "pages").withColumn("_n", F.count("*").over(Window.partitionBy(name))).filter("_n = 1")
    d = p.select("page_id", "url", F.char_length("html").cast("double").alias("size"), (F.col("page_id") % 5).cast("double").alias("labels"), (F.col("page_id") % 3).alias("kind"))
    return G.discovered_suite(d, d.select("url"), "url", "page_id", "size", "labels", "kind", 12).agg(F.count("*").alias("n"), F.count_if("selected").alias("selected"))


@query("str_watchdog", """WITH r AS (SELECT user_id, event_id, ts, event_type, CASE WHEN event_type <> lag(event_type) OVER w THEN 1 ELSE 0 END AS f FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), g AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts) AS g FROM r),
s AS (SELECT user_id, count(*) AS events, max(ts) AS last, max(g) AS mg, bool_or(event_id % 97 = 0) AS d FROM g GROUP BY user_id), k AS (SELECT g.user_id, count(*) AS streak FROM g JOIN s ON g.user_id = s.user_id AND g.g = s.mg GROUP BY g.user_id)
SELECT user_id, events, streak, CASE WHEN d THEN 'complete' WHEN streak >= 2 THEN 'looping' WHEN date_diff('second', last, (SELECT max(ts) FROM events)) >= 86400 THEN 'idle' ELSE 'working' END AS state FROM s JOIN k USING (user_id)""")
def str_watchdog(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    last = e.agg(F.max("ts").alias("m")).first()["m"]  # one value
    out = G.watchdog(e, ["user_id"], "ts", "event_type", F.lit(last), 86400.0, 2, F.col("event_id") % 97 == 0)
    return out.select("user_id", "events", "streak", "state")


@query("fold_same_place", "SELECT CAST(event_id // 500 AS BIGINT) AS src, event_id AS \"left\", event_id + 1000000 AS \"right\" FROM events WHERE event_id % 3 > 0")
def fold_same_place(spark, sf_dir):
    e = table(spark, sf_dir, "events").select((F.col("event_id") / 500).cast("long").alias("src"), F.col("event_id").alias("pos"), "event_type")
    other = e.select("src", (F.col("pos") + 1000000).alias("pos"), F.when(F.col("pos") % 3 > 0, F.col("event_type")).otherwise("none").alias("event_type"))
    return folds.sequence_alignment(e, other, ["src"], "pos", "event_type", "same_place")
