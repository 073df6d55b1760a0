"""Records, roll-ups and orders over run-like rows of the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.functions import records as X
from larder.operators import filters as P
from larder.operators import reports as R
from larder.plans.registry import query
from larder.plans.tables import table


def nested(spark, sf_dir):
    """Orders as records with a nested setting."""
    o = table(spark, sf_dir, "orders")
    deep = F.struct(F.col("o_totalprice").alias("price"), F.struct(F.col("o_orderstatus").alias("z"), F.col("o_custkey").alias("a")).alias("who"))
    return o.select("o_orderkey", deep.alias("run"), F.create_map(F.lit("model"), F.col("o_orderpriority")).alias("config"), F.array("o_orderstatus").alias("tags"))


@query("prj_value_at", """SELECT o_orderkey, o_custkey AS a, '{"a":' || o_custkey || ',"z":"' || o_orderstatus || '"}' AS who, o_orderpriority AS model, '["' || o_orderstatus || '"]' AS tags, CAST(NULL AS VARCHAR) AS missing, o_orderkey * 2 AS doubled FROM orders""")
def prj_value_at(spark, sf_dir):
    d = nested(spark, sf_dir)
    at = lambda p: X.value_at(d.schema, p, {"doubled": F.col("o_orderkey") * 2})
    return d.select("o_orderkey", at("run.who.a").alias("a"), at("run.who").alias("who"), at("config.model").alias("model"), at("tags").alias("tags"), at("run.no.such").alias("missing"), at("doubled").alias("doubled"))


@query("prj_paths", "SELECT * FROM (VALUES (0, 'run.price'), (1, 'doubled'), (2, 'config'), (3, 'o_orderkey'), (4, 'run.who.a'), (5, 'run.who.z'), (6, 'tags')) t(place, path)")
def prj_paths(spark, sf_dir):
    found = X.paths_of(nested(spark, sf_dir).schema, ["doubled"], ["run.price", "no.such", "doubled"])
    return spark.createDataFrame(list(enumerate(found)), "place int, path string")


PROFILES = {frozenset(): "plain", frozenset({"first"}): "first_only", frozenset({"second"}): "second_only", frozenset({"first", "second", "third"}): "everything"}
KNOWN = ("plain", "first_only", "second_only", "everything")
SETTINGS = """SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'First Only' WHEN o_orderkey % 13 = 0 THEN 'none' END AS given, CASE o_orderkey % 3 WHEN 0 THEN 'off' WHEN 1 THEN 'on' END AS a, CASE o_orderkey % 4 WHEN 0 THEN 'off' WHEN 1 THEN 'on' END AS b, CASE WHEN o_orderkey % 5 < 2 THEN 'on' END AS c, CASE WHEN o_orderkey % 7 < 3 THEN 'm' END AS model FROM orders"""
PROFILED = f"""SELECT *, coalesce(CASE WHEN given = 'First Only' THEN 'first_only' END,
CASE WHEN coalesce(a, b, c) IS NULL THEN NULL WHEN coalesce(a = 'on', false) AND coalesce(b = 'on', false) AND coalesce(c = 'on', false) THEN 'everything' WHEN coalesce(a = 'on', false) AND NOT coalesce(b = 'on', false) AND c IS NULL THEN 'first_only' WHEN NOT coalesce(a = 'on', false) AND coalesce(b = 'on', false) AND c IS NULL THEN 'second_only' WHEN NOT coalesce(a = 'on', false) AND NOT coalesce(b = 'on', false) AND c IS NULL THEN 'plain' END,
CASE WHEN model IS NOT NULL THEN 'everything' END, 'other') AS profile FROM ({SETTINGS})"""


def profiled(spark, sf_dir):
    k = F.col("o_orderkey")
    d = table(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 11 == 0, "First Only").when(k % 13 == 0, "none").alias("given"), F.when(k % 3 == 0, "off").when(k % 3 == 1, "on").alias("a"), F.when(k % 4 == 0, "off").when(k % 4 == 1, "on").alias("b"), F.when(k % 5 < 2, "on").alias("c"), F.when(k % 7 < 3, "m").alias("model"))
    surfaces = {"first": F.col("a"), "second": F.col("b"), "third": F.col("c")}
    return d.withColumn("profile", X.assistance(F.col("given"), surfaces, PROFILES, F.col("model"), KNOWN, "everything"))


@query("prj_assistance", f"SELECT o_orderkey, profile FROM ({PROFILED})")
def prj_assistance(spark, sf_dir):
    return profiled(spark, sf_dir).select("o_orderkey", "profile")


@query("prj_variant", f"SELECT o_orderkey, CASE WHEN given = 'First Only' THEN 'first' ELSE profile END AS variant FROM ({PROFILED})")
def prj_variant(spark, sf_dir):
    return profiled(spark, sf_dir).select("o_orderkey", X.variant(F.col("given"), {"first_only": "first"}, F.col("profile")).alias("variant"))


@query("flt_official", f"SELECT o_orderkey FROM ({PROFILED}) WHERE o_orderkey % 6 < 4 AND CASE WHEN given = 'First Only' THEN 'first' ELSE profile END = 'plain' AND profile = 'plain'")
def flt_official(spark, sf_dir):
    d = profiled(spark, sf_dir)
    path = F.when(F.col("o_orderkey") % 6 < 4, "/runs/Golden\\single/x").otherwise("/runs/golden/x")
    v = X.variant(F.col("given"), {"first_only": "first"}, F.col("profile"))
    return d.filter(X.is_official(path, ["golden", "single"], v, F.col("profile"), [("plain", "plain"), ("all", "everything")])).select("o_orderkey")


@query("prj_setting", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS value FROM orders")
def prj_setting(spark, sf_dir):
    k = F.col("o_orderkey")
    config = F.create_map(F.lit("x"), F.when(k % 2 == 0, F.col("o_orderpriority")).otherwise("None"))
    summary = F.concat(F.lit("y = "), F.when(k % 3 == 0, F.col("o_orderstatus")).otherwise("n/a"), F.lit(" | z=1"))
    return table(spark, sf_dir, "orders").select("o_orderkey", X.setting(config, summary, "x", "y").alias("value"))


@query("cmp_secondary_metrics", "SELECT field, n, low + 0.0 AS low, high + 0.0 AS high, place FROM (SELECT 'l_tax' AS field, count(l_tax) AS n, min(l_tax) AS low, max(l_tax) AS high, 0 AS place FROM lineitem UNION ALL SELECT 'l_discount', count(l_discount), min(l_discount), max(l_discount), 2 FROM lineitem UNION ALL SELECT 'l_quantity', count(l_quantity), min(l_quantity), max(l_quantity), 3 FROM lineitem) WHERE n >= 2 AND high > low")
def cmp_secondary_metrics(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").withColumn("l_same", F.lit(1.0))
    return X.secondary_metrics(d, ["l_same", "l_discount", "l_quantity", "l_shipdate", "l_extendedprice", "l_tax"], ["l_tax"], "same|discount|quantity|price", ["l_extendedprice"])


@query("flt_subset", "SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def flt_subset(spark, sf_dir):
    patch = X.subset_filter("c_mktsegment", ["BUILDING", "__EMPTY__", "MACHINERY ", "BUILDING"])
    return table(spark, sf_dir, "customer").filter(P.grouped(patch)).select("c_custkey")


@query("flt_without_noise", "SELECT event_id FROM events WHERE event_type NOT IN ('click', 'view')")
def flt_without_noise(spark, sf_dir):
    return R.without_labels(table(spark, sf_dir, "events"), "event_type", ["click", "view"]).select("event_id")


@query("flt_queue", "SELECT event_id, event_type FROM events WHERE event_type IN ('error', 'purchase')")
def flt_queue(spark, sf_dir):
    return R.queued(table(spark, sf_dir, "events"), "event_type", ["error", "purchase"]).select("event_id", "event_type")


@query("flt_limited", "SELECT * FROM (SELECT o_orderkey, 'limited to 100 of ' || (SELECT count(*) FROM orders) AS warning FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100)")
def flt_limited(spark, sf_dir):
    kept, warning = R.limited(table(spark, sf_dir, "orders").withColumn("minus", -F.col("o_totalprice")), ["minus", "o_orderkey"], 100)
    return kept.select("o_orderkey", F.lit(warning).alias("warning"))


TIMED = "SELECT l_suppkey, count(s) AS variants, coalesce(sum(s), 0) AS total, avg(s) AS mean, median(s) AS median, arg_max(c, (s, c)) FILTER (s IS NOT NULL) AS slowest, max(s) AS slowest_seconds FROM (SELECT l_suppkey, CASE WHEN l_returnflag <> 'R' AND l_linenumber < 7 THEN l_extendedprice END AS s, l_orderkey || '-' || l_linenumber AS c FROM lineitem) GROUP BY l_suppkey"


def timed(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").withColumns({"c": F.concat_ws("-", "l_orderkey", "l_linenumber"), "s": F.when(F.col("l_linenumber") < 7, F.col("l_extendedprice"))})
    return R.timing_by_source(d, "l_suppkey", "c", "s", F.col("l_returnflag") != "R")


@query("agg_timing_by_source", f"SELECT l_suppkey, variants, round(total, 2) AS total, round(mean, 4) AS mean, round(median, 4) AS median, slowest, slowest_seconds FROM ({TIMED})")
def agg_timing_by_source(spark, sf_dir):
    return timed(spark, sf_dir).withColumns({"total": F.round("total", 2), "mean": F.round("mean", 4), "median": F.round("median", 4)})


@query("agg_timing_summary", f"SELECT count(*) AS sources, CAST(sum(variants) AS BIGINT) AS variants, round(sum(total), 2) AS total, round(avg(total) FILTER (variants > 0), 4) AS mean, round(median(total) FILTER (variants > 0), 4) AS median, arg_max(l_suppkey, (round(total, 6), l_suppkey)) AS slowest_source, arg_max(l_suppkey || '/' || slowest, (slowest_seconds, l_suppkey || '/' || slowest)) FILTER (slowest IS NOT NULL) AS slowest_config, max(slowest_seconds) AS slowest_config_seconds FROM ({TIMED})")
def agg_timing_summary(spark, sf_dir):
    out = R.timing_summary(timed(spark, sf_dir).withColumn("total", F.round("total", 6)), "l_suppkey")
    return out.withColumns({"total": F.round("total", 2), "mean": F.round("mean", 4), "median": F.round("median", 4)})


@query("ord_outlier_sets", """WITH m AS (SELECT l_returnflag, l_orderkey * 10 + l_linenumber AS id, unnest(['l_extendedprice', 'l_quantity', 'l_tax']) AS metric, unnest([l_extendedprice, CASE WHEN l_linenumber < 4 THEN l_quantity END, l_tax]) AS value FROM lineitem), k AS (SELECT l_returnflag, metric, median(value) AS m FROM m GROUP BY ALL)
SELECT l_returnflag, id, metric, value FROM m JOIN k USING (l_returnflag, metric) WHERE value > 1.5 * m""")
def ord_outlier_sets(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").withColumn("id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return R.outlier_sets(d, ["l_returnflag"], {"l_extendedprice": None, "l_quantity": F.col("l_linenumber") < 4, "l_tax": None}, "id", 1.5)


@query("agg_strata", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def agg_strata(spark, sf_dir):
    return R.strata_counts(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"])


@query("ord_representatives")
def ord_representatives(spark, sf_dir):
    return R.representatives(table(spark, sf_dir, "part"), "p_partkey", "p_brand", ["p_size", "p_type"], 60).select("p_partkey", "p_brand")


@query("ord_triage", """SELECT l_orderkey, l_linenumber, signal, empty_only, CAST(row_number() OVER (ORDER BY signal DESC, empty_only, c DESC, w DESC, d DESC, n DESC, t DESC, l_orderkey, l_linenumber) AS INTEGER) AS place FROM
(SELECT *, c > 0 OR w > 0 OR d > 0 OR n > 0 AS signal, e AND c <= 0 AND w <= 0 AS empty_only FROM (SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN l_orderkey % 3 = 0 THEN l_linenumber % 4 END, 0) AS c, l_linenumber % 2 AS w, abs(l_discount - 0.05) AS d, CASE WHEN l_tax > 0.05 THEN 1 ELSE 0 END AS n, l_quantity AS t, l_orderkey % 5 = 0 AS e FROM lineitem)) ORDER BY place LIMIT 500""")
def ord_triage(spark, sf_dir):
    from pyspark.sql import Window

    d = table(spark, sf_dir, "lineitem").withColumns({"c": F.when(F.col("l_orderkey") % 3 == 0, F.col("l_linenumber") % 4), "w": F.col("l_linenumber") % 2, "d": F.col("l_discount") - 0.05})
    out = R.triage_order(d, "c", "w", "d", F.when(F.col("l_tax") > 0.05, 1).otherwise(0), "l_quantity", F.col("l_orderkey") % 5 == 0, ["l_orderkey", "l_linenumber"]).limit(500)
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("signal"), "empty_only", F.desc(F.coalesce("c", F.lit(0))), F.desc("w"), F.desc(F.abs("d")), F.desc(F.col("l_tax") > 0.05), F.desc("l_quantity"), "l_orderkey", "l_linenumber")
    return out.select("l_orderkey", "l_linenumber", "signal", "empty_only", F.row_number().over(order).alias("place"))


@query("ord_source_cost", "SELECT doc_id, round(greatest(1, CASE WHEN doc_id % 3 = 0 THEN (doc_id % 50) * CASE WHEN doc_id % 4 > 0 AND doc_id % 5 > 0 THEN greatest(0.25, (doc_id % 5) / (doc_id % 4)) ELSE 1 END ELSE greatest(1, doc_id % 5) * 25 + n_chars / 1200.0 END), 6) AS seconds, CASE WHEN doc_id % 3 = 0 THEN 'prior' ELSE 'estimate' END AS basis FROM documents")
def ord_source_cost(spark, sf_dir):
    i = F.col("doc_id")
    c = R.source_cost(i % 5, F.col("n_chars"), F.when(i % 3 == 0, (i % 50).cast("double")), i % 4)
    return table(spark, sf_dir, "documents").select("doc_id", F.round(c["seconds"], 6).alias("seconds"), c["basis"].alias("basis"))


STATUS = "CASE event_type WHEN 'click' THEN 'done' WHEN 'view' THEN 'done' WHEN 'error' THEN 'failed' ELSE 'running' END"


def statuses(spark, sf_dir):
    t = F.col("event_type")
    return table(spark, sf_dir, "events").withColumn("status", F.when(t.isin("click", "view"), "done").when(t == "error", "failed").otherwise("running"))


@query("agg_stage_rollup", f"SELECT user_id, count(*) AS items, count(*) FILTER (s = 'done') AS done, count(*) FILTER (s = 'running') AS running, count(*) FILTER (s = 'failed') AS failed, CASE WHEN count(*) FILTER (s = 'failed') > 0 THEN 'failed' WHEN count(*) FILTER (s = 'running') > 0 THEN 'running' ELSE 'done' END AS state FROM (SELECT user_id, {STATUS} AS s FROM events) GROUP BY user_id")
def agg_stage_rollup(spark, sf_dir):
    return R.stage_rollup(statuses(spark, sf_dir), "user_id", "status", ["done", "running", "failed"])


@query("agg_prompt_budget", "SELECT lang, count(*) AS prompts, CAST(sum(ceil(n_chars / 4.0)) AS BIGINT) AS input_tokens, CAST(sum(doc_id % 100) AS BIGINT) AS output_tokens, CAST(max(ceil(n_chars / 4.0)) AS BIGINT) AS largest, CAST(sum(ceil(n_chars / 4.0)) + sum(doc_id % 100) AS BIGINT) AS total, CASE WHEN max(ceil(n_chars / 4.0)) > 20000 THEN 'prompt' WHEN sum(ceil(n_chars / 4.0)) + sum(doc_id % 100) > 50000 THEN 'stage' END AS warning FROM documents GROUP BY lang")
def agg_prompt_budget(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("out", F.col("doc_id") % 100)
    return R.prompt_budget(d, "lang", "n_chars", "out", 20000, 50000)


@query("str_worker_health", f"""WITH a AS (SELECT user_id % 10 AS pool, CASE WHEN s = 'failed' THEN 0 WHEN s = 'running' AND event_id % 100 >= 60 THEN 1 WHEN event_id % 7 = 0 THEN 2 WHEN s = 'running' THEN 4 ELSE 5 END AS v, s = 'running' AND event_id % 100 >= 60 AS st FROM (SELECT *, {STATUS} AS s FROM events))
SELECT pool, count(*) AS workers, count(*) FILTER (v <= 2) AS attention, count(*) FILTER (st) AS stalled, count(*) FILTER (v = 5) AS done, CASE min(v) WHEN 0 THEN 'failed' WHEN 1 THEN 'stalled' WHEN 2 THEN 'warned' WHEN 4 THEN 'running' ELSE 'done' END AS worst FROM a GROUP BY pool""")
def str_worker_health(spark, sf_dir):
    d = statuses(spark, sf_dir).withColumn("pool", F.col("user_id") % 10)
    return R.worker_health(d, ["pool"], "status", F.col("event_id") % 100, F.when(F.col("event_id") % 7 == 0, 1).otherwise(0), 60.0)


RUNS = "SELECT l_linestatus, 'completed' AS status, 's' AS settings, avg(l_quantity) AS q, avg(l_discount) AS d, avg(l_tax) AS t FROM lineitem GROUP BY l_linestatus"


@query("agg_compared_runs", f"SELECT true AS settings_match, list_filter(['q', 'd', 't'], lambda x: (x = 'q' AND b.q - c.q > -100) OR (x = 'd' AND b.d - c.d > 10) OR (x = 't' AND b.t - c.t > 10)) AS failed, ['candidate is not completed', 'q falls'] AS reasons, 'FAIL' AS verdict FROM ({RUNS}) b, ({RUNS}) c WHERE b.l_linestatus = 'F' AND c.l_linestatus = 'O'")
def agg_compared_runs(spark, sf_dir):
    g = table(spark, sf_dir, "lineitem").groupBy("l_linestatus").agg(F.avg("l_quantity").alias("q"), F.avg("l_discount").alias("d"), F.avg("l_tax").alias("t")).withColumn("settings", F.lit("s"))
    a, b = (g.filter(F.col("l_linestatus") == s).withColumn("status", F.lit("completed" if s == "F" else "failed")) for s in "FO")
    return R.compared_runs(a, b, {"q": -100.0, "d": 10.0, "t": 10.0})


BOARD = """WITH p AS (SELECT 'l_returnflag=' || l_returnflag || ' | l_linenumber=' || l_linenumber AS config, l_suppkey, avg(l_discount) AS q, median(l_extendedprice) AS c FROM lineitem GROUP BY ALL),
r AS (SELECT config, count(*) AS sources, avg(q) AS quality, median(c) AS cost FROM p GROUP BY config), k AS (SELECT * FROM r WHERE {0}),
f AS (SELECT config FROM k x WHERE NOT EXISTS (SELECT 1 FROM k y WHERE y.cost < x.cost AND y.quality >= x.quality) AND NOT EXISTS (SELECT 1 FROM k y WHERE y.cost = x.cost AND y.quality > x.quality))
SELECT config, sources, round(quality, 8) AS quality, round(cost, 4) AS cost, config IN (SELECT config FROM f) AS on_frontier, CAST(row_number() OVER (ORDER BY quality DESC, cost, config) AS INTEGER) AS place FROM k"""


@query("ord_leaderboard", BOARD.format("true"))
def ord_leaderboard(spark, sf_dir):
    out = R.leaderboard(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linenumber"], "l_suppkey", "l_discount", "l_extendedprice", partial=True)
    return out.withColumns({"quality": F.round("quality", 8), "cost": F.round("cost", 4)})


@query("ord_leaderboard_whole", BOARD.format("sources = (SELECT count(DISTINCT l_suppkey) FROM lineitem)"))
def ord_leaderboard_whole(spark, sf_dir):
    out = R.leaderboard(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linenumber"], "l_suppkey", "l_discount", "l_extendedprice")
    return out.withColumns({"quality": F.round("quality", 8), "cost": F.round("cost", 4)})


@query("dsh_config_rollup", """WITH w AS (SELECT l_linestatus, l_returnflag, count(*) AS wins FROM (SELECT *, row_number() OVER (PARTITION BY l_linestatus, l_suppkey ORDER BY l_discount DESC, l_tax DESC, l_orderkey, l_linenumber) AS r FROM lineitem) WHERE r = 1 GROUP BY ALL),
s AS (SELECT l_linestatus, l_returnflag, count(DISTINCT l_suppkey) AS groups, avg(l_discount) AS mean_l_discount, avg(l_tax) AS mean_l_tax, sum(l_quantity) AS sum_l_quantity FROM lineitem GROUP BY ALL)
SELECT l_linestatus, l_returnflag, groups, round(mean_l_discount, 8) AS mean_l_discount, round(mean_l_tax, 8) AS mean_l_tax, sum_l_quantity, coalesce(wins, 0) AS wins, CAST(row_number() OVER (PARTITION BY l_linestatus ORDER BY groups DESC, mean_l_discount DESC, mean_l_tax DESC, coalesce(wins, 0) DESC, l_returnflag) AS INTEGER) AS place FROM s LEFT JOIN w USING (l_linestatus, l_returnflag)""")
def dsh_config_rollup(spark, sf_dir):
    out = R.config_rollup(table(spark, sf_dir, "lineitem"), "l_linestatus", "l_suppkey", "l_returnflag", ["l_discount", "l_tax"], ["l_quantity"], ["l_orderkey", "l_linenumber"])
    return out.withColumns({c: F.round(c, 8) for c in ("mean_l_discount", "mean_l_tax")})


@query("dsh_top_and_more", "SELECT c_nationkey, CASE WHEN count(*) > 1 THEN (min(l) FILTER (r = 1)) || ' + ' || (count(*) - 1) || ' more' ELSE min(l) END AS shown FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, l) AS r FROM (SELECT c_nationkey, c_mktsegment AS l, count(*) AS n FROM customer GROUP BY c_nationkey, c_mktsegment)) GROUP BY c_nationkey")
def dsh_top_and_more(spark, sf_dir):
    return R.top_and_more(table(spark, sf_dir, "customer"), ["c_nationkey"], "c_mktsegment")


@query("dsh_run_groups", "SELECT user_id, max(event_id) AS latest, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY user_id")
def dsh_run_groups(spark, sf_dir):
    return R.run_groups(table(spark, sf_dir, "events"), "user_id", "event_id", F.col("event_type") != "error")


MIXED = "CASE WHEN p_partkey % 7 = 0 THEN '' WHEN p_partkey % 3 = 0 THEN CAST(p_size AS VARCHAR) WHEN p_partkey % 3 = 1 THEN 'Item ' || p_size ELSE lower(p_brand) END"


@query("dsh_sorted", f"SELECT p_partkey, CAST(row_number() OVER (ORDER BY v = '', TRY_CAST(v AS DOUBLE) IS NULL, TRY_CAST(v AS DOUBLE), CASE WHEN starts_with(v, 'Item ') THEN 'item ' || lpad(substr(v, 6), 20, '0') ELSE regexp_replace(v, '[0-9]+', '') || lpad(regexp_extract(v, '[0-9]+'), 20, '0') END, p_retailprice DESC, p_partkey) AS INTEGER) AS place FROM (SELECT *, {MIXED} AS v FROM part)")
def dsh_sorted(spark, sf_dir):
    from pyspark.sql import Window

    k = F.col("p_partkey")
    v = F.when(k % 7 == 0, "").when(k % 3 == 0, F.col("p_size").cast("string")).when(k % 3 == 1, F.concat(F.lit("Item "), F.col("p_size").cast("string"))).otherwise(F.lower("p_brand"))
    d = table(spark, sf_dir, "part").withColumn("v", v)
    order = Window.partitionBy(F.lit(0)).orderBy(*R.sort_keys(F.col("v")), F.desc("p_retailprice"), "p_partkey")
    return R.sorted_rows(d, "v", "p_retailprice", "p_partkey").select("p_partkey", F.row_number().over(order).alias("place"))


@query("dsh_group_order", "SELECT label, CAST(row_number() OVER (ORDER BY label IN ('-', 'unknown'), CASE label WHEN 'low' THEN 1 WHEN 'High' THEN 3 WHEN 'x-high' THEN 4 ELSE 999 END, lpad(lower(label), 30, ' ')) AS INTEGER) AS place FROM (VALUES ('High'), ('-'), ('run 10'), ('low'), ('x-high'), ('run 9'), ('unknown')) t(label)")
def dsh_group_order(spark, sf_dir):
    from pyspark.sql import Window

    d = spark.createDataFrame([(x,) for x in ("High", "-", "run 10", "low", "x-high", "run 9", "unknown")], "label string")
    return d.select("label", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*R.group_order(F.col("label"), True))).alias("place"))


@query("dsh_latest_sums", "SELECT count(*) AS n, CAST(sum(CASE WHEN event_id % 2 = 0 THEN event_id % 5 END) AS BIGINT) AS a, CAST(sum(CASE WHEN event_id % 3 = 0 THEN 1 END) AS BIGINT) AS b FROM events WHERE (event_id % 2 = 0 OR event_id % 3 = 0) AND user_id = (SELECT user_id FROM events WHERE event_id % 2 = 0 OR event_id % 3 = 0 ORDER BY ts DESC, user_id LIMIT 1)")
def dsh_latest_sums(spark, sf_dir):
    i = F.col("event_id")
    d = table(spark, sf_dir, "events").withColumns({"a": F.when(i % 2 == 0, i % 5), "b": F.when(i % 3 == 0, F.lit(1))})
    return R.latest_sums(d, "user_id", "ts", ["a", "b"])


@query("dsh_stage_rows", "SELECT event_id FROM events WHERE event_type IN ('click', 'view') AND ts >= (SELECT max(ts) FROM events) - INTERVAL 9 DAY AND (user_id % 4 = 0 OR user_id % 4 = 1)")
def dsh_stage_rows(spark, sf_dir):
    d = table(spark, sf_dir, "events")
    last = d.agg(F.max("ts").alias("m")).first()["m"]  # one value
    d = d.withColumn("x", F.when(F.col("user_id") % 4 == 1, "one").when(F.col("user_id") % 4 > 1, "other"))
    return R.stage_rows(d, "event_type", ["click", "view"], "ts", F.lit(last) - F.expr("INTERVAL 9 DAYS"), "x", ["one"]).select("event_id")


@query("cmp_insights_gap", "WITH m AS (SELECT l_returnflag AS g, avg(l_extendedprice) AS m FROM lineitem GROUP BY 1) SELECT arg_max(g, m) AS best, arg_min(g, m) AS worst, round(max(m) - min(m), 4) AS delta FROM m")
def cmp_insights_gap(spark, sf_dir):
    fields = ["l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice"]
    found = R.insights(table(spark, sf_dir, "lineitem").select(*fields), "l_extendedprice", "l_returnflag", ["l_linestatus"], fields, "^noise", ["l_linestatus"])
    return found["gap"].withColumn("delta", F.round("delta", 4))


@query("cmp_insights_process", "WITH m AS (SELECT l_linestatus AS g, avg(l_extendedprice) AS m FROM lineitem GROUP BY 1) SELECT arg_max(g, m) AS best, arg_min(g, m) AS worst, round(max(m) - min(m), 4) AS delta, 'l_linestatus' AS field FROM m")
def cmp_insights_process(spark, sf_dir):
    fields = ["l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice"]
    found = R.insights(table(spark, sf_dir, "lineitem").select(*fields), "l_extendedprice", "l_returnflag", ["l_linestatus"], fields, "^noise", ["l_linestatus"])
    return found["process"].withColumn("delta", F.round("delta", 4))
