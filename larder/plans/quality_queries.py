"""Filters, merges and roll-ups over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.operators import filters as P
from larder.operators import merging as M
from larder.operators import quality as Q
from larder.plans.registry import query
from larder.plans.tables import table

_CLAUSES = {
    "contains": ("c_mktsegment", "mach", "contains(lower(trim(c_mktsegment)), 'mach')"),
    "not_contains": ("c_mktsegment", "mach", "NOT contains(lower(trim(c_mktsegment)), 'mach')"),
    "eq": ("c_nationkey", "7.0", "c_nationkey = 7"),
    "neq": ("c_nationkey", "7", "c_nationkey <> 7"),
    "starts_with": ("c_mktsegment", "Auto", "starts_with(lower(c_mktsegment), 'auto')"),
    "ends_with": ("c_mktsegment", "ING", "ends_with(lower(c_mktsegment), 'ing')"),
    "gt": ("c_acctbal", "5000", "c_acctbal > 5000"),
    "gte": ("c_acctbal", "5000", "c_acctbal >= 5000"),
    "lt": ("c_acctbal", "0", "c_acctbal < 0"),
    "lte": ("c_acctbal", "0", "c_acctbal <= 0"),
    "regex": ("c_name", "0[1-3]$", "regexp_matches(c_name, '(?i)0[1-3]$')"),
    "is_empty": ("c_mktsegment", "", "c_mktsegment IS NULL OR trim(c_mktsegment) = ''"),
    "not_empty": ("c_mktsegment", "", "NOT (c_mktsegment IS NULL OR trim(c_mktsegment) = '')"),
}


def _register(operator: str, field: str, value: str, sql: str) -> None:
    @query(f"flt_{operator}", f"SELECT c_custkey FROM customer WHERE {sql}")
    def run(spark, sf_dir):
        return table(spark, sf_dir, "customer").filter(P.condition(F.col(field), operator, value)).select("c_custkey")


for _operator, (_field, _value, _sql) in _CLAUSES.items():
    _register(_operator, _field, _value, _sql)

GROUPS = {
    "c_mktsegment": {"mode": "or", "clauses": [{"operator": "eq", "value": "BUILDING"}, {"operator": "contains", "value": "mach"}, {"operator": "eq", "value": " building"}, {"operator": "eq", "value": ""}]},
    "c_acctbal": {"mode": "and", "clauses": [{"operator": "gt", "value": "0"}, {"operator": "lt", "value": "4000"}]},
}
GROUPED = "(lower(c_mktsegment) = 'building' OR contains(lower(c_mktsegment), 'mach')) AND c_acctbal > 0 AND c_acctbal < 4000"


@query("flt_grouped", f"SELECT c_custkey FROM customer WHERE {GROUPED}")
def flt_grouped(spark, sf_dir):
    return table(spark, sf_dir, "customer").filter(P.grouped(GROUPS)).select("c_custkey")


@query("flt_quick_counts", "SELECT count(*) AS total, count(*) FILTER (NOT c_acctbal > 0) AS positive, count(*) FILTER (c_acctbal > 0 AND NOT c_nationkey < 10) AS low_nation FROM customer")
def flt_quick_counts(spark, sf_dir):
    return P.quick_filtered(table(spark, sf_dir, "customer"), {"positive": F.col("c_acctbal") > 0, "low_nation": F.col("c_nationkey") < 10})[1]


@query("flt_facet", "SELECT c_mktsegment, count(*) AS n, CASE WHEN starts_with(lower(c_mktsegment), 'b') THEN 1500 - least(300, length(c_mktsegment) - 1) ELSE 1100 - (strpos(lower(c_mktsegment), 'b') - 1) END AS score FROM customer WHERE c_acctbal > 0 AND c_acctbal < 4000 AND contains(lower(c_mktsegment), 'b') GROUP BY c_mktsegment")
def flt_facet(spark, sf_dir):
    return P.facet(table(spark, sf_dir, "customer"), "c_mktsegment", GROUPS, "b").withColumn("score", F.col("score").cast("int"))


@query("flt_recent", "SELECT event_id FROM events WHERE ts IS NULL OR ts >= (SELECT max(ts) FROM events) - INTERVAL 3 DAY")
def flt_recent(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    last = e.agg(F.max("ts").alias("m")).first()["m"]  # one value
    return e.filter(F.col("ts").isNull() | (F.col("ts") >= F.lit(last) - F.expr("INTERVAL 3 DAYS"))).select("event_id")


BOTH = "SELECT coalesce(c.c_custkey, s.s_suppkey) AS k, CASE WHEN c.c_custkey IS NULL THEN s.s_name ELSE c.c_name END AS name, coalesce(nullif(CASE WHEN c.c_custkey % 3 = 0 THEN '' ELSE c.c_mktsegment END, ''), s.s_name) AS info, coalesce(c.c_acctbal, s.s_acctbal) AS bal FROM (SELECT * FROM customer) c FULL JOIN (SELECT s_suppkey * 40 AS s_suppkey, s_name, s_acctbal FROM supplier) s ON c.c_custkey = s.s_suppkey"


def _both(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_mktsegment")).alias("info"), F.col("c_acctbal").alias("bal"))
    s = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 40).alias("k"), F.col("s_name").alias("name"), F.col("s_name").alias("info"), F.col("s_acctbal").alias("bal"))
    return c, s


@query("join_merged_records", BOTH)
def join_merged_records(spark, sf_dir):
    return M.merged_records(*_both(spark, sf_dir), "k", ["name"])


@query("join_appended", "SELECT c_custkey AS k, c_name AS name FROM customer UNION ALL SELECT s_suppkey * 40, s_name FROM supplier WHERE s_suppkey * 40 NOT IN (SELECT c_custkey FROM customer)")
def join_appended(spark, sf_dir):
    c, s = _both(spark, sf_dir)
    return M.appended(c.select("k", "name"), s.select("k", "name"), ["k"])


@query("join_overridden", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_orderkey % 10 = 0 THEN 'row' WHEN l_partkey % 10 = 0 THEN 'block' ELSE l_returnflag END AS label FROM lineitem")
def join_overridden(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_returnflag").alias("label"))
    by_row = table(spark, sf_dir, "orders").filter("o_orderkey % 10 = 0").select(F.col("o_orderkey").alias("l_orderkey"), F.lit("row").alias("label"))
    by_block = table(spark, sf_dir, "part").filter("p_partkey % 10 = 0").select(F.col("p_partkey").alias("l_partkey"), F.lit("block").alias("label"))
    return M.overridden(rows, by_row, by_block, "l_orderkey", "l_partkey", "label")


@query(
    "join_ownership",
    """WITH o AS (SELECT l_orderkey, count(DISTINCT l_returnflag) AS n, min(l_returnflag) AS owner FROM lineitem WHERE l_quantity > 40 GROUP BY l_orderkey)
    SELECT o_orderkey AS l_orderkey, owner, CASE WHEN n > 1 THEN 'two owners' WHEN owner IS NOT NULL AND o_orderkey % 7 = 0 THEN 'owned and released' END AS problem FROM orders LEFT JOIN o ON o_orderkey = l_orderkey""",
)
def join_ownership(spark, sf_dir):
    claims = table(spark, sf_dir, "lineitem").filter("l_quantity > 40").select("l_orderkey", F.col("l_returnflag").alias("owner"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return M.ownership(claims, rows.filter("l_orderkey % 7 = 0"), rows, "l_orderkey", "owner")


@query(
    "join_ranked_identity",
    """WITH g AS (SELECT event_id AS i, user_id, event_type, event_id // 4 AS b FROM events WHERE event_id % 2 = 0), f AS (SELECT event_id AS j, user_id, event_type, event_id // 4 AS b FROM events WHERE event_id % 2 = 1),
    m AS (SELECT i, j, 'block' AS way, 0 AS r FROM g JOIN f USING (b, event_type) UNION ALL SELECT i, j, 'user', 1 FROM g JOIN f USING (user_id, event_type))
    SELECT i, j, way FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY r, j) AS k FROM m) WHERE k = 1""",
)
def join_ranked_identity(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("b", (F.col("event_id") / 4).cast("long"))
    g, f = e.filter("event_id % 2 = 0").withColumnRenamed("event_id", "i"), e.filter("event_id % 2 = 1").withColumnRenamed("event_id", "j")
    return M.ranked_identity(g, f, [("block", ["b", "event_type"]), ("user", ["user_id", "event_type"])], "i", "j")


@query(
    "dsh_per_label",
    """SELECT l_returnflag, CAST(sum(l_quantity) AS DOUBLE) AS gold, CAST(sum(l_linenumber) AS BIGINT) AS found, round((sum(l_discount * l_quantity) + sum(l_tax * l_linenumber)) / 2 / sum(l_linenumber), 6) AS precision,
    round((sum(l_discount * l_quantity) + sum(l_tax * l_linenumber)) / 2 / sum(l_quantity), 6) AS recall FROM lineitem GROUP BY l_returnflag""",
)
def dsh_per_label(spark, sf_dir):
    out = Q.per_label(table(spark, sf_dir, "lineitem"), [], "l_returnflag", "l_quantity", "l_linenumber", "l_discount", "l_tax")
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall")})


@query(
    "dsh_rolling_per_label",
    """WITH r AS (SELECT o_orderstatus, o_orderdate, o_orderpriority, avg(o_totalprice) AS v FROM orders GROUP BY ALL), k AS (SELECT *, dense_rank() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate DESC) AS d FROM r)
    SELECT o_orderstatus, o_orderpriority, round(avg(v), 4) AS o_totalprice FROM k WHERE d <= 10 GROUP BY ALL""",
)
def dsh_rolling_per_label(spark, sf_dir):
    return Q.rolling_per_label(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderdate", "o_orderpriority", ["o_totalprice"], 10).withColumn("o_totalprice", F.round("o_totalprice", 4))


@query("dsh_weighted_quality", "SELECT l_orderkey, round(coalesce(sum(l_extendedprice * l_discount) / nullif(sum(CASE WHEN l_discount > 0 THEN l_discount END), 0), avg(l_extendedprice)), 6) AS quality FROM lineitem GROUP BY l_orderkey")
def dsh_weighted_quality(spark, sf_dir):
    return Q.weighted_quality(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_extendedprice", "l_discount").withColumn("quality", F.round("quality", 6))


@query("dsh_best_by", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus = 'F' DESC, o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r = 1")
def dsh_best_by(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("done", (F.col("o_orderstatus") == "F").cast("int"))
    return Q.best_by(o, ["o_custkey"], ["done", "o_totalprice"], ["o_orderkey"]).select("o_custkey", "o_orderkey")


@query("dsh_most_common", "WITH c AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f FROM events GROUP BY ALL) SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, f) AS r FROM c) WHERE r = 1")
def dsh_most_common(spark, sf_dir):
    return Q.most_common(table(spark, sf_dir, "events"), ["user_id"], "event_type", "event_id")


@query("dsh_latest_group", "SELECT event_id FROM events WHERE value > 50 AND user_id = (SELECT user_id FROM events WHERE value > 50 ORDER BY ts DESC, user_id LIMIT 1)")
def dsh_latest_group(spark, sf_dir):
    return Q.latest_group(table(spark, sf_dir, "events"), "user_id", "ts", F.col("value") > 50).select("event_id")


@query("dsh_clamped_series", "SELECT event_id, round(least(value, p), 6) AS clamped, round(log10(greatest(value, 0) + 1), 6) AS logged FROM events JOIN (SELECT event_type, quantile_cont(value, 0.95) AS p FROM events GROUP BY event_type) USING (event_type)")
def dsh_clamped_series(spark, sf_dir):
    out = Q.clamped_series(table(spark, sf_dir, "events"), ["event_type"], "value")
    return out.select("event_id", F.round("clamped", 6).alias("clamped"), F.round("logged", 6).alias("logged"))


@query("dsh_kpis", "SELECT count(*) AS n, round(median(o_totalprice), 4) AS median_seconds, round(avg(o_custkey), 6) AS accuracy, max(o_orderdate) AS latest FROM orders")
def dsh_kpis(spark, sf_dir):
    return Q.kpis(table(spark, sf_dir, "orders"), "o_totalprice", "o_custkey", "o_orderdate").withColumns({"median_seconds": F.round("median_seconds", 4), "accuracy": F.round("accuracy", 6)})


@query("dsh_per_million", "SELECT l_orderkey, l_linenumber, CASE WHEN l_tax > 0 THEN round(l_discount * 1e6 / l_tax, 4) END AS v FROM lineitem")
def dsh_per_million(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(Q.per_million(F.col("l_discount"), F.col("l_tax")), 4).alias("v"))


@query(
    "agg_gates",
    """WITH m AS (SELECT l_linestatus AS s, l_returnflag AS metric, avg(l_quantity) AS v FROM lineitem GROUP BY ALL), j AS (SELECT coalesce(a.metric, b.metric) AS metric, a.v AS baseline, b.v AS candidate FROM (SELECT * FROM m WHERE s = 'F') a FULL JOIN (SELECT * FROM m WHERE s = 'O') b ON a.metric = b.metric)
    SELECT metric, round(baseline, 6) AS baseline, round(candidate, 6) AS candidate, round(baseline - candidate, 6) AS "drop", coalesce(baseline - candidate > 0.05, true) AS failed FROM j WHERE metric IN ('A', 'N', 'R')""",
)
def agg_gates(spark, sf_dir):
    m = table(spark, sf_dir, "lineitem").groupBy("l_linestatus", F.col("l_returnflag").alias("metric")).agg(F.avg("l_quantity").alias("value"))
    out = Q.gates(m.filter("l_linestatus = 'F'"), m.filter("l_linestatus = 'O'"), {"A": 0.05, "N": 0.05, "R": 0.05})
    return out.withColumns({c: F.round(c, 6) for c in ("baseline", "candidate", "drop")})


@query("agg_micro_average", "WITH s AS (SELECT l_returnflag, sum(l_linenumber) AS tp, sum(l_quantity) AS fp, sum(l_discount) AS fn FROM lineitem GROUP BY l_returnflag) SELECT l_returnflag, CAST(tp AS BIGINT) AS tp, fp, round(fn, 4) AS fn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)), 6) AS f1 FROM s")
def agg_micro_average(spark, sf_dir):
    out = Q.micro_average(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_linenumber", "l_quantity", "l_discount")
    return out.withColumns({"fn": F.round("fn", 4), **{c: F.round(c, 6) for c in ("precision", "recall", "f1")}})


@query("agg_inside_outside", "WITH r AS (SELECT l_returnflag, sum(l_linenumber) FILTER (l_tax > 0.04) / sum(l_quantity) FILTER (l_tax > 0.04) AS i, sum(l_linenumber) FILTER (NOT l_tax > 0.04) / sum(l_quantity) FILTER (NOT l_tax > 0.04) AS o FROM lineitem GROUP BY l_returnflag) SELECT l_returnflag, round(i, 6) AS inside, round(o, 6) AS outside, round(i - o, 6) AS gap FROM r")
def agg_inside_outside(spark, sf_dir):
    out = Q.inside_outside(table(spark, sf_dir, "lineitem"), ["l_returnflag"], F.col("l_tax") > 0.04, "l_linenumber", "l_quantity")
    return out.withColumns({c: F.round(c, 6) for c in ("inside", "outside", "gap")})


@query("agg_confusion_deltas", "SELECT l_returnflag, l_linestatus, CAST(sum(l_linenumber - 3) AS BIGINT) AS delta FROM lineitem GROUP BY ALL HAVING sum(l_linenumber - 3) <> 0 ORDER BY abs(sum(l_linenumber - 3)) DESC, l_returnflag, l_linestatus LIMIT 3")
def agg_confusion_deltas(spark, sf_dir):
    return Q.confusion_deltas(table(spark, sf_dir, "lineitem").withColumn("d", F.col("l_linenumber") - 3), "l_returnflag", "l_linestatus", "d", 3)


@query("agg_token_cost", "SELECT o_orderstatus, CAST(ceil(sum(o_custkey * 120 + 800) / 4) AS BIGINT) AS tokens, round(ceil(sum(o_custkey * 120 + 800) / 4) * 2.5 / 1e6, 4) AS usd FROM orders GROUP BY o_orderstatus")
def agg_token_cost(spark, sf_dir):
    return Q.token_cost(table(spark, sf_dir, "orders"), ["o_orderstatus"], "o_custkey", 2.5)


@query("agg_shard_budget", "SELECT lang, CAST(sum(n_chars) AS BIGINT) AS total, max(n_chars) AS largest, CAST(greatest(1, ceil(sum(n_chars) / 100000.0)) AS BIGINT) AS shards, CASE WHEN max(n_chars) > 30000 THEN 'item' WHEN sum(n_chars) > 100000 THEN 'total' ELSE 'none' END AS binding FROM documents GROUP BY lang")
def agg_shard_budget(spark, sf_dir):
    return Q.shard_budget(table(spark, sf_dir, "documents"), ["lang"], "n_chars", 100_000, 30_000)


@query("agg_status_counts", "SELECT trim(o_orderstatus) AS status, count(*) AS n FROM orders GROUP BY 1")
def agg_status_counts(spark, sf_dir):
    return Q.status_counts(table(spark, sf_dir, "orders"), "o_orderstatus")


@query(
    "str_attention",
    """WITH w AS (SELECT user_id, count(*) AS n, arg_max(event_type, event_id) AS t, max(ts) AS m, count(*) FILTER (value > 90) AS warned FROM events GROUP BY user_id),
    s AS (SELECT user_id, warned, CASE t WHEN 'click' THEN 'running' WHEN 'view' THEN 'waiting' WHEN 'purchase' THEN 'done' ELSE 'failed' END AS status, epoch((SELECT max(ts) FROM events)) - epoch(m) AS q FROM w)
    SELECT user_id, status, CAST(CASE WHEN status = 'failed' THEN 0 WHEN q >= 3600 AND status IN ('running', 'waiting') THEN 1 WHEN warned > 8 THEN 2 WHEN status = 'waiting' THEN 3 WHEN status = 'running' THEN 4 WHEN status = 'done' THEN 5 ELSE 99 END AS INTEGER) AS severity, q >= 3600 AND status IN ('running', 'waiting') AS stalled FROM s""",
)
def str_attention(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    now = e.agg(F.max("ts").alias("m")).first()["m"]  # one value
    w = e.groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("t"), F.max("ts").alias("m"), F.count_if(F.col("value") > 90).alias("warned"))
    status = F.when(F.col("t") == "click", "running").when(F.col("t") == "view", "waiting").when(F.col("t") == "purchase", "done").otherwise("failed")
    quiet = (F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros(F.col("m").cast("timestamp"))) / 1e6
    return Q.attention(w.withColumn("status", status), "status", quiet, F.greatest(F.col("warned") - 8, F.lit(0)), 3600).select("user_id", "status", "severity", "stalled")


@query(
    "win_recent_rate",
    """WITH s AS (SELECT user_id, event_id AS t, value, (value - lag(value) OVER w) / nullif(event_id - lag(event_id) OVER w, 0) AS v FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t DESC) AS k FROM s WHERE v > 0) SELECT user_id, round(median(v), 6) AS rate FROM r WHERE k <= 5 GROUP BY user_id""",
)
def win_recent_rate(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("t", F.col("event_id").cast("double"))
    return Q.recent_rate(e, ["user_id"], "t", "value", 5).withColumn("rate", F.round("rate", 6))
