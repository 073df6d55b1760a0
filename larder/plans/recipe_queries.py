"""Recipe expressions over texts made from the driver's numbers, as its prose holds no recipes."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.functions import recipes as R
from larder.plans.registry import query
from larder.plans.tables import table


def _parts(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", F.col("p_size").alias("n"), F.col("p_name").alias("name"), F.col("p_size").cast("string").alias("s"))


@query("rec_durations", "SELECT p_partkey, CAST(p_size * 60 + floor((p_size + p_size + 3) / 2.0 * 3600) AS BIGINT) AS total, CAST(greatest(p_size * 60, floor((p_size + p_size + 3) / 2.0 * 3600)) AS BIGINT) AS longest FROM part")
def rec_durations(spark, sf_dir):
    p = _parts(spark, sf_dir)
    text = F.concat(F.lit("Simmer for "), F.col("s"), F.lit(" mins, then bake "), F.col("s"), F.lit(" to "), (F.col("n") + 3).cast("string"), F.lit(" hours in 2 pans."))
    return p.select("p_partkey", R.total_seconds(text).alias("total"), R.total_seconds(text, "max").alias("longest"))


@query("rec_temperatures", "SELECT p_partkey, round_even((300 + p_size - 32) * 5 / 9, 0) AS hot, CAST(100 + p_size AS DOUBLE) AS warm FROM part")
def rec_temperatures(spark, sf_dir):
    p = _parts(spark, sf_dir)
    text = F.concat(F.lit("Heat to "), (F.col("n") + 300).cast("string"), F.lit("°F, keep at "), (F.col("n") + 100).cast("string"), F.lit(" degrees C."))
    found = R.temperatures_celsius(text)
    return p.select("p_partkey", F.get(found, 0).alias("hot"), F.get(found, 1).alias("warm"))


@query("rec_servings", "SELECT p_partkey, CAST(CASE WHEN p_size % 3 = 0 THEN p_size * 12 WHEN p_size % 3 = 1 THEN ceil((p_size + p_size + 3) / 2.0) ELSE p_size END AS INTEGER) AS n FROM part")
def rec_servings(spark, sf_dir):
    p = _parts(spark, sf_dir)
    text = F.when(F.col("n") % 3 == 0, F.concat(F.col("s"), F.lit(" dozen rolls"))).when(F.col("n") % 3 == 1, F.concat(F.lit("Serves "), F.col("s"), F.lit(" to "), (F.col("n") + 3).cast("string"))).otherwise(F.concat(F.lit("Makes "), F.col("s"), F.lit(" pies")))
    return p.select("p_partkey", R.servings(text).alias("n"))


@query("rec_row_cells", "SELECT p_partkey, CAST(3 AS INTEGER) AS cells, p_name AS second FROM part")
def rec_row_cells(spark, sf_dir):
    p = _parts(spark, sf_dir)
    cells = R.row_cells(F.when(F.col("n") % 2 == 0, F.concat_ws(" | ", "s", "name", F.lit("x"))).otherwise(F.concat_ws("\t", "s", "name", F.lit("x"))))
    return p.select("p_partkey", F.size(cells).alias("cells"), F.get(cells, 1).alias("second"))


@query("rec_line_kind", "SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'ingredient' WHEN 1 THEN 'instruction' WHEN 2 THEN 'yield' WHEN 3 THEN 'heading' WHEN 4 THEN 'numbered' ELSE 'prose' END AS kind FROM part")
def rec_line_kind(spark, sf_dir):
    p = _parts(spark, sf_dir)
    n = F.col("n") % 6
    text = F.when(n == 0, F.concat("s", F.lit(" cups flour"))).when(n == 1, F.concat(F.lit("Stir in the "), "name")).when(n == 2, F.concat(F.lit("Serves "), "s")).when(n == 3, "Ingredients:").when(n == 4, F.concat("s", F.lit(". Something long that is done here.")))
    return p.select("p_partkey", R.line_kind(F.coalesce(text, F.concat(F.lit("The history of "), "name"))).alias("kind"))


@query("rec_text_quality", r"""WITH l AS (SELECT doc_id, length(text) AS n, len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')) AS l FROM documents), s AS (SELECT doc_id, n, least(1, n / 6000.0) * 0.45 + least(1, l / 120.0) * 0.3 AS s FROM l)
SELECT doc_id, CAST(round(CASE WHEN n < 120 THEN s * 0.35 ELSE s END, 8) AS DOUBLE) AS s FROM s""")
def rec_text_quality(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.round(R.text_quality(F.col("text"), ("zzz",), ("zzz",)), 8).alias("s"))


@query("rec_title_quality", "SELECT p_partkey, CAST(CASE WHEN length(trim(p_name)) = 0 THEN 0 WHEN length(trim(p_name)) < 4 THEN 0.35 WHEN length(trim(p_name)) > 90 THEN 0.55 ELSE 1 END AS DOUBLE) AS q FROM part")
def rec_title_quality(spark, sf_dir):
    return _parts(spark, sf_dir).select("p_partkey", R.title_quality(F.col("name")).alias("q"))


@query("rec_label_name", "SELECT DISTINCT o_orderpriority, upper(regexp_replace(trim(o_orderpriority), '[ -]+', '_', 'g')) AS label FROM orders")
def rec_label_name(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderpriority", R.label_name(F.col("o_orderpriority")).alias("label")).distinct()


@query("rec_tiers", "SELECT event_id, CASE WHEN value / 100 >= 0.75 THEN 'gold' WHEN value / 100 >= 0.55 THEN 'silver' WHEN value / 100 >= 0.35 THEN 'bronze' ELSE 'reject' END AS tier FROM events")
def rec_tiers(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", R.tier(F.col("value") / 100).alias("tier"))
