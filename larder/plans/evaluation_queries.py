"""Scores of ranges and rows over spans made from events."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.operators import evaluation as E
from larder.operators import labels as L
from larder.plans.registry import query
from larder.plans.tables import table
from larder.plans.views import SPANS_SQL, spans

SUPPORTED = ("click", "view")
KEYED = f"SELECT id, src, label, s, e, gold FROM ({SPANS_SQL})"
#: Overlap over union of every pair of a source; g and f are gold and found spans.
PAIRS = "(least(g.e, f.e) - greatest(g.s, f.s) + 1) / ((g.e - g.s + 1) + (f.e - f.s + 1) - (least(g.e, f.e) - greatest(g.s, f.s) + 1))"


def both(spark, sf_dir):
    s = spans(spark, sf_dir).select("id", "src", "label", "s", "e", "gold")
    return s.filter("gold").drop("gold"), s.filter("NOT gold").drop("gold")


def _sides(gold: str = "gold", found: str = "NOT gold") -> str:
    return f"g AS (SELECT * FROM ({KEYED}) WHERE {gold}), f AS (SELECT * FROM ({KEYED}) WHERE {found})"


def _counted(hits: str) -> str:
    """Label rows and a whole row, from CTEs g, f and m (gold id, label, found_id: the matches)."""
    share = "coalesce(gold_matched / nullif(gold, 0), 0.0) AS recall, coalesce(found_matched / nullif(found, 0), 0.0) AS precision"
    return f"""{hits}, t AS (SELECT label, count(*) FILTER (gold) AS gold, count(*) FILTER (NOT gold) AS found FROM (SELECT label, gold FROM g UNION ALL SELECT label, gold FROM f) GROUP BY GROUPING SETS ((label), ())),
    h AS (SELECT label, count(DISTINCT id) AS gold_matched, count(DISTINCT found_id) AS found_matched FROM m GROUP BY GROUPING SETS ((label), ())),
    s AS (SELECT t.label, t.gold, t.found, coalesce(gold_matched, 0) AS gold_matched, coalesce(found_matched, 0) AS found_matched FROM t LEFT JOIN h ON t.label IS NOT DISTINCT FROM h.label),
    scores AS (SELECT *, {share} FROM s)"""


def _strict(least: float) -> str:
    return f"m AS (SELECT id, label, found_id FROM (SELECT g.id, g.label, f.id AS found_id, {PAIRS} AS o, row_number() OVER (PARTITION BY g.id ORDER BY {PAIRS} DESC, f.id) AS r FROM g JOIN f ON g.src = f.src AND g.label = f.label AND g.s <= f.e AND f.s <= g.e) WHERE r = 1 AND o >= {least})"


ANY = "m AS (SELECT g.id, g.label, f.id AS found_id FROM g JOIN f ON g.src = f.src AND g.label = f.label AND g.s <= f.e AND f.s <= g.e)"
COLUMNS = "label, gold, found, gold_matched, found_matched, round(recall, 6) AS recall, round(precision, 6) AS precision"


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in ("recall", "precision")})


@query("eval_strict", f"WITH {_sides()}, {_counted(_strict(0.5))} SELECT {COLUMNS} FROM scores")
def eval_strict(spark, sf_dir):
    return _rounded(E.strict_scores(*both(spark, sf_dir), ["src"], 0.5, 8))


@query("eval_practical", f"WITH {_sides()}, {_counted(ANY)} SELECT {COLUMNS} FROM scores")
def eval_practical(spark, sf_dir):
    return _rounded(E.practical_scores(*both(spark, sf_dir), ["src"], 8))


ONCE = "f AS (SELECT * EXCLUDE r FROM (SELECT *, row_number() OVER (PARTITION BY src, label, s, e ORDER BY id) AS r FROM ({0}) WHERE NOT gold) WHERE r = 1)".format(KEYED)
CLASSED = f"""WITH g AS (SELECT * FROM ({KEYED}) WHERE gold), {ONCE},
p AS (SELECT g.id, g.label, f.label AS fl, row_number() OVER (PARTITION BY g.id ORDER BY {PAIRS} DESC, f.id) AS r FROM g JOIN f ON g.src = f.src AND g.s <= f.e AND f.s <= g.e),
b AS (SELECT g.id, g.label, any_value(fl) FILTER (r = 1) AS best, coalesce(bool_or(fl = g.label), false) AS same FROM g LEFT JOIN p ON g.id = p.id GROUP BY ALL)"""


@query("eval_classification", CLASSED + " SELECT label, count(*) AS gold, count(best) AS \"any\", count(*) FILTER (same) AS same, count(*) FILTER (best = label) AS best, round(count(best) / count(*), 6) AS any_rate, round(count(*) FILTER (same) / count(*), 6) AS same_rate, round(count(*) FILTER (best = label) / count(*), 6) AS best_rate FROM b GROUP BY GROUPING SETS ((label), ())")
def eval_classification(spark, sf_dir):
    out = E.classification(*both(spark, sf_dir), ["src"], 8)
    return out.withColumns({c: F.round(c, 6) for c in ("any_rate", "same_rate", "best_rate")})


@query("eval_range_confusion", CLASSED + f" SELECT label, coalesce(best, '{E.NOTHING}') AS found, count(*) AS n FROM b GROUP BY ALL")
def eval_range_confusion(spark, sf_dir):
    return E.range_confusion(*both(spark, sf_dir), ["src"], 8)


def _section(name: str, sides: str, hits: str) -> str:
    return f"SELECT * FROM (WITH {sides}, {_counted(hits)} SELECT '{name}' AS section, {COLUMNS} FROM scores)"


_WANTED = "label IN ('click', 'view')"
ALIGNED = " UNION ALL ".join(
    [
        _section("once", f"g AS (SELECT * FROM ({KEYED}) WHERE gold), {ONCE}", _strict(0.5)),
        *(_section(n, f"g AS (SELECT * FROM ({KEYED}) WHERE gold AND {_WANTED}), {ONCE.replace('WHERE NOT gold', 'WHERE NOT gold AND ' + _WANTED)}", h) for n, h in (("supported", _strict(0.5)), ("relaxed", _strict(0.1)), ("any", ANY))),
    ]
)


@query("eval_aligned", ALIGNED)
def eval_aligned(spark, sf_dir):
    return _rounded(E.aligned_report(*both(spark, sf_dir), ["src"], SUPPORTED, 0.5, 0.1, 8))


#: Gold ranges of equal bounds, once, with the label that has most votes and no tie.
VOTED = f"""v AS (SELECT src, s, e, label, count(*) AS n, min(id) AS id FROM ({KEYED}) WHERE gold GROUP BY ALL), w AS (SELECT *, row_number() OVER (PARTITION BY src, s, e ORDER BY n DESC) AS r, count(*) FILTER (n = top) OVER (PARTITION BY src, s, e) AS ties FROM (SELECT *, max(n) OVER (PARTITION BY src, s, e) AS top FROM v)),
g AS (SELECT id, src, label, s, e, true AS gold FROM w WHERE n = top AND ties = 1)"""
PLAIN = f"f AS (SELECT * FROM ({KEYED}) WHERE NOT gold)"
G2, F2 = "g AS (SELECT * FROM gg WHERE label IN ('click', 'view'))", ONCE.replace("WHERE NOT gold", "WHERE NOT gold AND " + _WANTED)
REPORT = " UNION ALL ".join(
    [
        _section("strict", f"{VOTED}, {PLAIN}", _strict(0.5)), _section("practical", f"{VOTED}, {PLAIN}", ANY), _section("once", f"{VOTED}, {ONCE}", _strict(0.5)),
        *(_section(n, f"{VOTED.replace('g AS (SELECT id', 'gg AS (SELECT id')}, {G2}, {F2}", h) for n, h in (("supported", _strict(0.5)), ("relaxed", _strict(0.1)), ("any", ANY))),
    ]
)


@query("eval_report", f"SELECT *, round(coalesce(2 * (found_matched / nullif(found, 0)) * (gold_matched / nullif(gold, 0)) / nullif(found_matched / nullif(found, 0) + gold_matched / nullif(gold, 0), 0), 0), 6) AS f1 FROM ({REPORT})")
def eval_report(spark, sf_dir):
    return _rounded(E.ranges_report(*both(spark, sf_dir), ["src"], SUPPORTED, 0.5, 8)).withColumn("f1", F.round("f1", 6))


HASHED = "SELECT DISTINCT CASE WHEN user_id % 5 = 0 THEN '' ELSE left(md5(CAST(user_id % 40 AS VARCHAR)), 8 + CAST(user_id % 3 AS INTEGER) * 8) END AS h, 'f' || (user_id % 30) AS f, event_id % 2 AS side FROM events"


@query("join_source_pairs", f"WITH d AS ({HASHED}) SELECT a.h AS hash1, a.f AS file1, b.h AS hash2, b.f AS file2 FROM d a JOIN d b ON a.side = 0 AND b.side = 1 AND CASE WHEN a.h <> '' AND b.h <> '' THEN starts_with(a.h, b.h) OR starts_with(b.h, a.h) ELSE a.f = b.f END")
def join_source_pairs(spark, sf_dir):
    size = (F.lit(8) + (F.col("user_id") % 3) * 8).cast("int")
    h = F.when(F.col("user_id") % 5 == 0, "").otherwise(F.substring(F.md5((F.col("user_id") % 40).cast("string").cast("binary")), F.lit(1), size))
    d = table(spark, sf_dir, "events").select(h.alias("h"), F.concat(F.lit("f"), F.col("user_id") % 30).alias("f"), (F.col("event_id") % 2).alias("side"))
    return E.source_pairs(d.filter("side = 0"), d.filter("side = 1"), "h", "f")


@query("eval_compatible", f"WITH d AS ({HASHED}) SELECT a.h AS h1, b.h AS h2, CASE WHEN a.h <> '' AND b.h <> '' THEN starts_with(a.h, b.h) OR starts_with(b.h, a.h) ELSE a.f = b.f END AS same, count(*) AS n FROM d a JOIN d b ON a.f = b.f GROUP BY ALL")
def eval_compatible(spark, sf_dir):
    size = (F.lit(8) + (F.col("user_id") % 3) * 8).cast("int")
    h = F.when(F.col("user_id") % 5 == 0, "").otherwise(F.substring(F.md5((F.col("user_id") % 40).cast("string").cast("binary")), F.lit(1), size))
    d = table(spark, sf_dir, "events").select(h.alias("h"), F.concat(F.lit("f"), F.col("user_id") % 30).alias("f"), (F.col("event_id") % 2).alias("side")).distinct()
    a, b = d.select(F.col("h").alias("h1"), "f"), d.select(F.col("h").alias("h2"), F.col("f").alias("f2"))
    same = E.compatible_source(F.col("h1"), F.col("f"), F.col("h2"), F.col("f2"))
    return a.join(b, F.col("f") == F.col("f2")).groupBy("h1", "h2", same.alias("same")).agg(F.count("*").alias("n"))


@query("eval_granularity", "SELECT user_id, round(CASE WHEN g > 0 THEN f / g ELSE 0 END, 6) AS ratio, r >= 0.6 AND s <= 0.1 AND CASE WHEN g > 0 THEN f / g ELSE 0 END >= 3 AS likely FROM (SELECT user_id, (user_id % 7) / 40.0 AS s, (user_id % 11) / 10.0 AS r, CAST(user_id % 4 AS DOUBLE) AS g, CAST(user_id % 13 AS DOUBLE) AS f FROM events GROUP BY user_id)")
def eval_granularity(spark, sf_dir):
    u = F.col("user_id")
    x = E.granularity((u % 7) / 40.0, (u % 11) / 10.0, (u % 4).cast("double"), (u % 13).cast("double"))
    return table(spark, sf_dir, "events").select("user_id").distinct().select("user_id", F.round(x["ratio"], 6).alias("ratio"), x["likely"].alias("likely"))


@query("eval_count_diagnostics", "SELECT user_id, coalesce(a, b, c) AS gold, coalesce(d, e) AS found, coalesce(d, e) - coalesce(a, b, c) AS difference, round(CASE WHEN coalesce(a, b, c) > 0 THEN coalesce(d, e) / coalesce(a, b, c) END, 6) AS ratio FROM (SELECT DISTINCT user_id, CASE WHEN user_id % 2 = 0 THEN user_id % 9 END AS a, CASE WHEN user_id % 3 = 0 THEN user_id % 5 END AS b, user_id % 4 AS c, CASE WHEN user_id % 5 = 0 THEN user_id % 8 END AS d, CASE WHEN user_id % 7 > 0 THEN user_id % 6 END AS e FROM events)")
def eval_count_diagnostics(spark, sf_dir):
    u = F.col("user_id")
    x = E.count_diagnostics(F.when(u % 2 == 0, u % 9), F.when(u % 3 == 0, u % 5), u % 4, F.when(u % 5 == 0, u % 8), F.when(u % 7 > 0, u % 6))
    return table(spark, sf_dir, "events").select("user_id").distinct().select("user_id", x["gold"].alias("gold"), x["found"].alias("found"), x["difference"].alias("difference"), F.round(x["ratio"], 6).alias("ratio"))


LABELLED = "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_type ELSE 'view' END AS g, event_type AS f, CASE WHEN user_id % 5 < 2 THEN true WHEN user_id % 5 < 4 THEN false END AS inside FROM events"


def labelled(spark, sf_dir):
    five = F.col("user_id") % 5
    return table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise("view").alias("g"), F.col("event_type").alias("f"), F.when(five < 2, True).when(five < 4, False).alias("inside"))


SLICED = f"""WITH d AS (SELECT 'outside' AS slice, * FROM ({LABELLED}) WHERE NOT coalesce(inside, false) UNION ALL SELECT 'clicks', * FROM ({LABELLED}) WHERE inside AND g = 'click' UNION ALL SELECT 'none', * FROM ({LABELLED}) WHERE g = 'no such'),
l AS (SELECT slice, label, sum(a) AS gold, sum(b) AS found, sum(t) AS tp FROM (SELECT slice, g AS label, 1 AS a, 0 AS b, CASE WHEN g = f THEN 1 ELSE 0 END AS t FROM d UNION ALL SELECT slice, f, 0, 1, 0 FROM d) GROUP BY ALL),
p AS (SELECT *, coalesce(tp / nullif(gold, 0), 0) AS recall, coalesce(tp / nullif(found, 0), 0) AS precision FROM l), q AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM p),
s AS (SELECT slice, CAST(sum(gold) AS BIGINT) AS n, sum(tp) / sum(gold) AS accuracy, coalesce(avg(f1) FILTER (label <> 'purchase'), 0) AS macro_f1, arg_min(label, (recall, label)) FILTER (label <> 'purchase' AND gold > 0) AS worst_label, min(recall) FILTER (label <> 'purchase' AND gold > 0) AS worst_recall FROM q GROUP BY slice)
SELECT n.slice, coalesce(n, 0) AS n, round(coalesce(accuracy, 0), 6) AS accuracy, round(coalesce(macro_f1, 0), 6) AS macro_f1, worst_label, round(worst_recall, 6) AS worst_recall FROM (VALUES ('outside'), ('clicks'), ('none')) n(slice) LEFT JOIN s USING (slice)"""


@query("eval_slices", SLICED)
def eval_slices(spark, sf_dir):
    slices = {"outside": ~F.coalesce("inside", F.lit(False)), "clicks": F.col("inside") & (F.col("g") == "click"), "none": F.col("g") == "no such"}
    out = E.slice_metrics(labelled(spark, sf_dir), slices, "g", "f", "purchase")
    return out.withColumns({c: F.round(c, 6) for c in ("accuracy", "macro_f1", "worst_recall")})


@query("eval_routing", f"SELECT count(*) AS n, count(*) FILTER (inside) AS inside, count(*) FILTER (NOT inside) AS outside, count(*) FILTER (inside IS NULL) AS unknown, count(*) FILTER (inside AND f IN ('click', 'view')) AS inside_structured, count(*) FILTER (NOT inside AND f IN ('click', 'view')) AS outside_structured, count(*) FILTER (NOT inside AND f = 'purchase') AS outside_candidates, count(*) FILTER (NOT inside AND f = 'error') AS outside_excluded FROM ({LABELLED})")
def eval_routing(spark, sf_dir):
    return E.routing_summary(labelled(spark, sf_dir), "inside", "f", ["click", "view"], "error", "purchase")


@query("eval_text_coverage", "SELECT conv_id, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(sum(CASE WHEN turn % 4 < 3 THEN length(text) ELSE 0 END) AS BIGINT) AS covered_chars, CASE WHEN sum(length(text)) = 0 THEN 'no text' WHEN sum(CASE WHEN turn % 4 < 3 THEN length(text) ELSE 0 END) < 0.9 * sum(length(text)) THEN 'low coverage' END AS warning FROM conversations GROUP BY conv_id")
def eval_text_coverage(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    covered = c.filter("turn % 4 < 3").select("conv_id", "turn")
    return E.text_coverage(c, covered.unionByName(covered), ["conv_id"], "turn", "text")


BUCKET = "CASE WHEN {0} IN ('click', 'view') THEN 'browse' ELSE 'other' END"


@query("eval_cross_buckets", f"SELECT * FROM (SELECT g AS gold, {BUCKET.format('g')} AS gold_bucket, f AS found, {BUCKET.format('f')} AS found_bucket, count(*) FILTER (event_id % 2 = 0) - count(*) FILTER (event_id % 2 = 1) AS delta FROM ({LABELLED}) GROUP BY ALL) WHERE gold_bucket <> found_bucket ORDER BY abs(delta) DESC, gold, found LIMIT 10")
def eval_cross_buckets(spark, sf_dir):
    even = F.col("event_id") % 2 == 0
    counts = labelled(spark, sf_dir).groupBy("g", "f").agg((F.count_if(even) - F.count_if(~even)).alias("d"))
    return E.cross_bucket_confusions(counts, "g", "f", "d", lambda x: F.when(x.isin("click", "view"), "browse").otherwise("other"))


BOUNDARY = "SELECT l_suppkey, count(*) FILTER (l_returnflag = '{0}' AND l_quantity > 30) AS c, count(*) FILTER (l_returnflag = '{0}' AND l_quantity <= 10) AS o, count(*) FILTER (l_returnflag = '{0}' AND l_quantity BETWEEN 11 AND 20) AS u, count(*) FILTER (l_returnflag = '{0}' AND l_quantity BETWEEN 21 AND 30) AS p FROM lineitem GROUP BY l_suppkey"
BOUNDED = f"SELECT n.l_suppkey, n.c AS now_correct, n.o + n.u + n.p AS now_errors, n.c / nullif(n.c + n.o + n.u + n.p, 0) AS now_exact, b.c AS before_correct, b.o + b.u + b.p AS before_errors, b.c / nullif(b.c + b.o + b.u + b.p, 0) AS before_exact FROM ({BOUNDARY.format('N')}) n JOIN ({BOUNDARY.format('A')}) b USING (l_suppkey)"


def boundary_sides(spark, sf_dir):
    q, flag = F.col("l_quantity"), F.col("l_returnflag")
    kinds = {"correct": q > 30, "over": q <= 10, "under": q.between(11, 20), "partial": q.between(21, 30)}
    by = table(spark, sf_dir, "lineitem").groupBy("l_suppkey")
    return [by.agg(*(F.count_if((flag == side) & c).alias(n) for n, c in kinds.items())) for side in ("N", "A")]


@query("eval_boundary_pairs", f"SELECT l_suppkey, now_correct, now_errors, round(now_exact, 6) AS now_exact, before_correct, before_errors, round(before_exact, 6) AS before_exact, now_correct - before_correct AS delta_correct, now_errors - before_errors AS delta_errors, round(now_exact - before_exact, 6) AS delta_exact FROM ({BOUNDED})")
def eval_boundary_pairs(spark, sf_dir):
    out = E.boundary_pairs(*boundary_sides(spark, sf_dir), "l_suppkey")
    return out.withColumns({c: F.round(c, 6) for c in ("now_exact", "before_exact", "delta_exact")})


@query("eval_boundary_means", f"SELECT count(*) AS pairs, round(avg(now_exact), 6) AS now_exact, round(avg(before_exact), 6) AS before_exact, round(avg(now_exact - before_exact), 6) AS delta_exact, round(avg(now_errors), 6) AS now_errors, round(avg(before_errors), 6) AS before_errors, round(avg(now_errors - before_errors), 6) AS delta_errors FROM ({BOUNDED})")
def eval_boundary_means(spark, sf_dir):
    out = E.boundary_means(E.boundary_pairs(*boundary_sides(spark, sf_dir), "l_suppkey"))
    return out.select("pairs", *(F.round(c, 6).alias(c) for c in out.columns if c != "pairs"))


#: Places k apart, where k is half a mean gold segment (2 at least).
SEGMENTS = """WITH e AS (SELECT event_id // 500 AS src, event_id AS pos, CASE WHEN event_id % 10 < 8 THEN 'a' || (event_id // 40 % 2) ELSE event_type END AS g, 'a' || (event_id // 35 % 2) AS f FROM events),
b AS (SELECT *, CASE WHEN g <> lag(g) OVER w THEN 1 ELSE 0 END AS bg, CASE WHEN f <> lag(f) OVER w THEN 1 ELSE 0 END AS bf FROM e WINDOW w AS (PARTITION BY src ORDER BY pos)),
s AS (SELECT src, pos, sum(bg) OVER w AS sg, sum(bf) OVER w AS sf, row_number() OVER w AS i FROM b WINDOW w AS (PARTITION BY src ORDER BY pos)),
k AS (SELECT src, count(*) AS n, greatest(2, CAST(round_even(count(*) / (max(sg) + 1) / 2, 0) AS BIGINT)) AS k FROM s GROUP BY src),
p AS (SELECT src, n, y.sg - x.sg AS dg, y.sf - x.sf AS df FROM s x JOIN k USING (src) JOIN s y USING (src) WHERE y.i = x.i + k.k)
SELECT CAST(k.src AS BIGINT) AS src, k.n, round(coalesce(avg(CASE WHEN (dg = 0) <> (df = 0) THEN 1.0 ELSE 0.0 END), 0), 6) AS pk, round(coalesce(avg(CASE WHEN dg <> df THEN 1.0 ELSE 0.0 END), 0), 6) AS window_diff FROM k LEFT JOIN p ON k.src = p.src GROUP BY ALL"""


@query("eval_segmentation", SEGMENTS)
def eval_segmentation(spark, sf_dir):
    i = F.col("event_id")
    block = lambda n: F.concat(F.lit("a"), (F.floor(i / n) % 2).cast("string"))
    d = table(spark, sf_dir, "events").select((i / 500).cast("long").alias("src"), i.alias("pos"), F.when(i % 10 < 8, block(40)).otherwise(F.col("event_type")).alias("g"), block(35).alias("f"))
    return E.segmentation_distances(d, ["src"], "pos", "g", "f").withColumns({c: F.round(c, 6) for c in ("pk", "window_diff")})


@query("eval_nearest_point", "WITH p AS (SELECT user_id, event_id AS x FROM events), t AS (SELECT DISTINCT user_id, 1000 * (user_id % 9) AS target FROM events) SELECT user_id, target, x FROM (SELECT *, row_number() OVER (PARTITION BY user_id, target ORDER BY abs(x - target), x) AS r FROM t JOIN p USING (user_id)) WHERE r = 1")
def eval_nearest_point(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return E.nearest_point(e.select("user_id", F.col("event_id").alias("x")), e.select("user_id", (1000 * (F.col("user_id") % 9)).alias("target")).distinct(), ["user_id"], "x", "target")


@query("lab_first_ranges", f"SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY src, label, s, e ORDER BY id) AS r FROM ({KEYED}) WHERE NOT gold) WHERE r = 1")
def lab_first_ranges(spark, sf_dir):
    return L.first_of(both(spark, sf_dir)[1], ["src", "label", "s", "e"], ["id"]).select("id")
