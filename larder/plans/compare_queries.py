"""Comparisons over run records (lineitem)."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.functions import fields as X
from larder.functions.ranks import average_ranks
from larder.operators import compare as C
from larder.operators import facade
from larder.plans.registry import query
from larder.plans.tables import table
from larder.plans.views import runs

RUNS = "SELECT l_orderkey, l_linenumber, l_extendedprice AS outcome, l_returnflag AS grp, l_linestatus AS stratum, l_quantity AS x, l_discount, l_tax FROM lineitem"


def rounded(df, *names, digits=4):
    return df.withColumns({n: F.round(n, digits) for n in names})


@query("cmp_raw", f"SELECT grp, count(*) AS n, round(avg(outcome), 4) AS mean, round(avg(x), 4) AS mean_x, round(avg(l_discount), 4) AS mean_l_discount FROM ({RUNS}) GROUP BY grp")
def cmp_raw(spark, sf_dir):
    return rounded(C.grouped_raw(runs(spark, sf_dir), "outcome", "grp", ("x", "l_discount")), "mean", "mean_x", "mean_l_discount")


CONTROLLED = f"""
WITH c AS (SELECT grp, stratum, x, count(*) AS n, avg(outcome) AS m FROM ({RUNS}) GROUP BY ALL),
s AS (SELECT stratum, x, sum(n) AS w FROM c GROUP BY ALL HAVING count(*) >= 2)
SELECT grp, CAST(sum(n) AS BIGINT) AS n, count(*) AS strata, round(sum(m * w) / sum(w), 4) AS mean FROM c JOIN s USING (stratum, x) GROUP BY grp
"""


@query("cmp_controlled", CONTROLLED)
def cmp_controlled(spark, sf_dir):
    return rounded(C.grouped_controlled(runs(spark, sf_dir), "outcome", "grp", ["stratum", "x"]), "mean")


@query(
    "cmp_coverage",
    f"""WITH c AS (SELECT grp, stratum, count(*) AS n FROM ({RUNS}) GROUP BY ALL), s AS (SELECT stratum, sum(n) AS n, count(*) >= 2 AS used FROM c GROUP BY ALL)
    SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(CASE WHEN used THEN n ELSE 0 END) AS BIGINT) AS used_rows, count(*) AS total_strata, count(*) FILTER (used) AS used_strata FROM s""",
)
def cmp_coverage(spark, sf_dir):
    return C.coverage(runs(spark, sf_dir), "outcome", "grp", ["stratum"])


@query("cmp_regression", f"SELECT count(*) AS n, round(regr_slope(outcome, x), 4) AS slope, round(regr_intercept(outcome, x), 4) AS intercept, round(regr_r2(outcome, x), 6) AS r2 FROM ({RUNS})")
def cmp_regression(spark, sf_dir):
    return rounded(rounded(C.regression(runs(spark, sf_dir), "x", "outcome"), "slope", "intercept"), "r2", digits=6)


RANKS = f"SELECT *, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx, rank() OVER (ORDER BY outcome) + (count(*) OVER (PARTITION BY outcome) - 1) / 2.0 AS ry FROM ({RUNS})"


@query("win_average_rank", f"SELECT l_orderkey, l_linenumber, CAST(rx AS DOUBLE) AS rx FROM ({RANKS})")
def win_average_rank(spark, sf_dir):
    return average_ranks(runs(spark, sf_dir), "x", "rx").select("l_orderkey", "l_linenumber", "rx")


@query("cmp_spearman", f"SELECT count(*) AS n, round(corr(rx, ry), 6) AS rho FROM ({RANKS})")
def cmp_spearman(spark, sf_dir):
    return rounded(C.spearman(runs(spark, sf_dir), "x", "outcome"), "rho", digits=6)


@query(
    "cmp_bins",
    f"""WITH p AS (SELECT *, row_number() OVER (ORDER BY x, outcome, l_orderkey, l_linenumber) - 1 AS pos, count(*) OVER () AS total FROM ({RUNS}))
    SELECT CAST(floor(pos / ceil(total / 5.0)) AS INTEGER) AS bin, count(*) AS n, min(x) AS low, max(x) AS high, round(avg(outcome), 4) AS mean FROM p GROUP BY 1""",
)
def cmp_bins(spark, sf_dir):
    return rounded(C.equal_count_bins(runs(spark, sf_dir), "x", "outcome", 5, ("l_orderkey", "l_linenumber")), "mean")


@query(
    "cmp_numeric_controlled",
    f"""WITH s AS (SELECT stratum, grp, avg(x) AS mx, avg(outcome) AS mo FROM ({RUNS}) GROUP BY ALL HAVING count(*) >= 2 AND min(x) <> max(x)),
    d AS (SELECT x - mx AS x, outcome - mo AS y FROM ({RUNS}) JOIN s USING (stratum, grp))
    SELECT count(*) AS n, round(regr_slope(y, x), 4) AS slope, round(regr_r2(y, x), 6) AS r2 FROM d""",
)
def cmp_numeric_controlled(spark, sf_dir):
    inner = C.within_strata(runs(spark, sf_dir), "outcome", "x", ["stratum", "grp"])
    return rounded(rounded(C.regression(inner, "x", "y").drop("intercept"), "slope"), "r2", digits=6)


CATALOG = ("l_returnflag", "l_linestatus", "l_quantity", "l_linenumber", "l_tax")


@query(
    "cmp_field_catalog",
    "WITH u AS ("
    + " UNION ALL ".join(f"SELECT '{f}' AS field, CAST({f} AS VARCHAR) AS value FROM lineitem" for f in CATALOG)
    + """), k AS (SELECT field, value, TRY_CAST(value AS DOUBLE) AS v FROM u WHERE trim(value) <> '')
    SELECT field, count(*) AS filled, count(DISTINCT value) AS n_distinct, bool_and(v IS NOT NULL) AS numeric,
           CASE WHEN bool_and(v IS NOT NULL) THEN min(v) END AS low, CASE WHEN bool_and(v IS NOT NULL) THEN max(v) END AS high FROM k GROUP BY field HAVING count(DISTINCT value) >= 2""",
)
def cmp_field_catalog(spark, sf_dir):
    return C.field_catalog(table(spark, sf_dir, "lineitem"), list(CATALOG)).drop("values")


@query(
    "cmp_explained",
    f"""WITH g AS (SELECT grp, count(*) AS n, avg(outcome) AS m FROM ({RUNS}) GROUP BY grp), t AS (SELECT avg(outcome) AS mean, count(*) * var_pop(outcome) AS whole, count(*) AS n FROM ({RUNS}))
    SELECT any_value(t.n) AS n, count(*) AS groups, round(sum(g.n * (m - mean) * (m - mean)) / any_value(whole), 6) AS eta2 FROM g, t""",
)
def cmp_explained(spark, sf_dir):
    return rounded(C.explained(runs(spark, sf_dir), "outcome", "grp"), "eta2", digits=6)


@query("cmp_delta", f"WITH g AS (SELECT grp, avg(outcome) AS mean FROM ({RUNS}) GROUP BY grp) SELECT arg_max(grp, mean) AS best, arg_min(grp, mean) AS worst, round(max(mean) - min(mean), 4) AS delta FROM g")
def cmp_delta(spark, sf_dir):
    return rounded(C.best_and_worst(C.grouped_raw(runs(spark, sf_dir), "outcome", "grp")), "delta")


@query(
    "cmp_split_segments",
    f"""WITH p AS (SELECT x, row_number() OVER (ORDER BY x) - 1 AS pos, count(*) OVER () AS total FROM ({RUNS})), b AS (SELECT CAST(floor(pos / ceil(total / 4.0)) AS INTEGER) AS bin, min(x) AS low, max(x) AS high FROM p GROUP BY 1)
    SELECT bin, low, high, count(*) AS n FROM b JOIN ({RUNS}) r ON r.x BETWEEN low AND high GROUP BY ALL""",
)
def cmp_split_segments(spark, sf_dir):
    return C.split_segments(runs(spark, sf_dir), "x")


@query("prj_basename", r"SELECT page_id, nullif(list_last(string_split(rtrim(replace(trim(url), '\', '/'), '/'), '/')), '') AS name FROM pages")
def prj_basename(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.basename(F.col("url")).alias("name"))


@query("prj_effective_tokens", "SELECT l_orderkey, l_linenumber, round(greatest(0, l_extendedprice - l_quantity) + 0.1 * l_quantity + l_tax, 4) AS effective FROM lineitem")
def prj_effective_tokens(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem")
    return d.select("l_orderkey", "l_linenumber", F.round(X.effective_tokens(F.col("l_extendedprice"), F.col("l_quantity"), F.col("l_tax"), F.lit(None).cast("double")), 4).alias("effective"))


@query("prj_per_item", "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0 THEN round(l_extendedprice / l_discount, 2) END AS per_item FROM lineitem")
def prj_per_item(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(X.per_item(F.col("l_extendedprice"), F.col("l_discount")), 2).alias("per_item"))


@query("prj_epoch_seconds", "SELECT event_id, CAST(epoch_us(date_trunc('second', ts)) AS DOUBLE) / 1e6 AS seconds FROM events")
def prj_epoch_seconds(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", X.epoch_seconds(F.date_format(F.date_trunc("second", "ts"), "yyyy-MM-dd_HH.mm.ss")).alias("seconds"))


@query("prj_maybe_number", "SELECT event_id, TRY_CAST(trim(json_extract_string(props, '$.' || json_keys(props)[1])) AS DOUBLE) AS number FROM events")
def prj_maybe_number(spark, sf_dir):
    first = F.element_at(F.json_object_keys("props"), 1)
    return table(spark, sf_dir, "events").select("event_id", X.maybe_number(F.element_at(F.from_json("props", "map<string,string>"), first)).alias("number"))


@query("prj_rule_value", "SELECT c_custkey, lower(trim(coalesce(c_mktsegment, ''))) AS rule, coalesce(nullif(trim(c_mktsegment), ''), '__EMPTY__') AS key, c_mktsegment IS NULL OR trim(c_mktsegment) = '' AS blank FROM customer")
def prj_rule_value(spark, sf_dir):
    s = F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select("c_custkey", X.rule_value(s).alias("rule"), X.comparable(s).alias("key"), X.is_blank(s).alias("blank"))


@query("prj_displayed", "SELECT l_orderkey, l_linenumber, CASE WHEN l_extendedprice = floor(l_extendedprice) THEN CAST(CAST(l_extendedprice AS BIGINT) AS VARCHAR) ELSE printf('%.4f', l_extendedprice) END AS shown FROM lineitem")
def prj_displayed(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", X.displayed(F.col("l_extendedprice")).alias("shown"))


@query(
    "prj_dominant",
    """SELECT l_orderkey, l_linenumber, CASE WHEN greatest(l_discount, l_tax, 0.04) / (l_discount + l_tax + 0.04) >= 0.5 THEN
    CASE WHEN l_discount >= l_tax AND l_discount >= 0.04 THEN 'discount' WHEN l_tax >= 0.04 THEN 'tax' ELSE 'other' END END AS part FROM lineitem""",
)
def prj_dominant(spark, sf_dir):
    d, t, o = F.col("l_discount"), F.col("l_tax"), F.lit(0.04)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", X.dominant({"discount": d, "tax": t, "other": o}, d + t + o).alias("part"))


@query("prj_settings_map", "SELECT o_orderkey, lower(trim(o_orderpriority)) AS priority, CAST(o_orderstatus AS VARCHAR) AS status FROM orders")
def prj_settings_map(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    summary = X.settings_map(F.concat(F.lit(" priority = "), F.col("o_orderpriority"), F.lit(" | status="), F.col("o_orderstatus"), F.lit(" | bare")))
    return o.select("o_orderkey", F.lower(summary["priority"]).alias("priority"), X.first_set(summary["none"], summary["status"]).alias("status"))


@query("prj_sum_or_null", "SELECT l_orderkey, CASE WHEN count(nullif(l_discount, 0)) > 0 THEN round(sum(nullif(l_discount, 0)), 4) END AS total FROM lineitem GROUP BY l_orderkey")
def prj_sum_or_null(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum(F.nullif("l_discount", F.lit(0.0))).alias("t"))
    return d.select("l_orderkey", F.round(X.sum_or_null(F.col("t")), 4).alias("total"))


FIELDS = ["outcome", "grp", "stratum", "x", "l_tax"]
_TOTAL = f"(SELECT count(*) FROM ({RUNS}))"
_RANKED = "rank() OVER (ORDER BY {0}) + (count(*) OVER (PARTITION BY {0}) - 1) / 2.0"


def _numeric_strength(field: str) -> str:
    ranked = f"SELECT {field} AS f, outcome AS o, {_RANKED.format(field)} AS rf, {_RANKED.format('outcome')} AS ro FROM ({RUNS})"
    return f"SELECT '{field}' AS field, true AS numeric, 1.0 AS coverage, abs(corr(rf, ro)) + least(1, abs(regr_slope(o, f))) AS score FROM ({ranked})"


def _group_strength(field: str) -> str:
    return f"SELECT '{field}', false, 1.0, (max(m) - min(m)) * 100 FROM (SELECT {field}, avg(outcome) AS m FROM ({RUNS}) GROUP BY {field})"


@query(
    "cmp_discovery",
    f"SELECT field, numeric, CAST(coverage AS DOUBLE) AS coverage, round(score * CASE WHEN field = 'x' THEN 1.25 WHEN contains(field, 'tax') THEN 0.2 ELSE 1 END, 3) AS score FROM ({_numeric_strength('x')} UNION ALL {_numeric_strength('l_tax')} UNION ALL {_group_strength('grp')} UNION ALL {_group_strength('stratum')})",
)
def cmp_discovery(spark, sf_dir):
    asked = {"view": "discover", "outcome": "outcome", "preferences": {"prefer": ["x"], "demote": ["tax"]}}
    return rounded(facade.analyze(runs(spark, sf_dir), asked, FIELDS), "score", digits=3)


@query("cmp_analyze_filtered", CONTROLLED.replace(RUNS, f"SELECT * FROM ({RUNS}) WHERE x > 10 AND lower(grp) <> 'n'"))
def cmp_analyze_filtered(spark, sf_dir):
    filters = {"x": {"clauses": [{"operator": "gt", "value": "10"}]}, "grp": {"clauses": [{"operator": "neq", "value": "N"}]}}
    asked = {"view": "controlled", "outcome": "outcome", "compare": "grp", "hold": ["stratum", "x"], "filters": filters}
    return rounded(facade.analyze(runs(spark, sf_dir), asked, FIELDS), "mean")


@query("cmp_analyze_numeric", f"SELECT count(*) AS n, round(regr_slope(outcome, x), 4) AS slope, round(regr_intercept(outcome, x), 4) AS intercept, round(regr_r2(outcome, x), 6) AS r2, round(corr(rx, ry), 6) AS rho, 5 AS bins FROM ({RANKS})")
def cmp_analyze_numeric(spark, sf_dir):
    out = facade.analyze(runs(spark, sf_dir), {"outcome": "outcome", "compare": "x"}, FIELDS).withColumn("bins", F.size("bins"))
    return rounded(rounded(out, "slope", "intercept"), "r2", "rho", digits=6)


@query("cmp_analyze_strata", f"SELECT count(*) AS n, count(*) AS rows, count(DISTINCT grp || stratum) AS strata, count(DISTINCT grp || stratum) AS strata_used FROM ({RUNS})")
def cmp_analyze_strata(spark, sf_dir):
    asked = {"view": "controlled", "outcome": "outcome", "compare": "x", "hold": ["grp", "stratum"]}
    return facade.analyze(runs(spark, sf_dir), asked, FIELDS).select("n", "rows", "strata", "strata_used")


@query("cmp_hold_suggestions")
def cmp_hold_suggestions(spark, sf_dir):
    r = runs(spark, sf_dir)
    return facade.hold_suggestions(r, "outcome", "grp", facade.profile(r, FIELDS))
