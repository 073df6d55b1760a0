"""Sequences and intervals over events: 500 events are a sequence."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.operators import intervals as I
from larder.operators import labels as L
from larder.operators import ordering as O
from larder.operators import sequences as S
from larder.plans.registry import query
from larder.plans.tables import table
from larder.plans.views import SPANS_SQL, lines, spans

SEQ = "SELECT CAST(event_id // 500 AS BIGINT) AS src, event_id AS pos, event_type AS label, value FROM events"
ISLANDS = f"SELECT src, label, min(pos) AS start, max(pos) AS \"end\", count(*) AS n FROM (SELECT *, pos - row_number() OVER (PARTITION BY src, label ORDER BY pos) AS i FROM ({SEQ})) GROUP BY src, label, i"
HALF_OPEN = "SELECT user_id AS src, event_id AS start, event_id + 1 + event_id % 700 AS \"end\" FROM events"


def seq(spark, sf_dir):
    return table(spark, sf_dir, "events").select((F.col("event_id") / 500).cast("long").alias("src"), F.col("event_id").alias("pos"), F.col("event_type").alias("label"), "value")


def half_open(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("src"), F.col("event_id").alias("start"), (F.col("event_id") + 1 + F.col("event_id") % 700).alias("end"))


@query("seq_islands", ISLANDS)
def seq_islands(spark, sf_dir):
    return S.islands(seq(spark, sf_dir), ["src"], "pos", "label")


@query("seq_named_spans", f"SELECT src, label, start, \"end\" + 1 AS \"end\", n, concat_ws('.', 'nr', label, start, \"end\" + 1) AS span_id FROM ({ISLANDS})")
def seq_named_spans(spark, sf_dir):
    return S.named_spans(seq(spark, sf_dir), ["src"], "pos", "label")


@query("seq_later_starts", f"SELECT src, start FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY start) AS r FROM ({ISLANDS}) WHERE label = 'click') WHERE r > 1")
def seq_later_starts(spark, sf_dir):
    return S.later_starts(seq(spark, sf_dir), ["src"], "pos", "label", "click")


@query("seq_neighbours", f"SELECT src, pos, lag(label) OVER w AS prev, lead(label) OVER w AS next FROM ({SEQ}) WINDOW w AS (PARTITION BY src ORDER BY pos)")
def seq_neighbours(spark, sf_dir):
    return S.neighbours(seq(spark, sf_dir), ["src"], "pos", "label").select("src", "pos", "prev", "next")


THINNED = f"SELECT * FROM ({SEQ}) WHERE label <> 'view'"


@query("seq_adjacent", f"SELECT a.src, a.pos, b.label AS prev, c.label AS next FROM ({THINNED}) a LEFT JOIN ({THINNED}) b ON a.src = b.src AND b.pos = a.pos - 1 LEFT JOIN ({THINNED}) c ON a.src = c.src AND c.pos = a.pos + 1")
def seq_adjacent(spark, sf_dir):
    return S.adjacent(seq(spark, sf_dir).filter("label <> 'view'"), ["src"], "pos", "label").select("src", "pos", "prev", "next")


@query("seq_prefix_counts", f"SELECT src, pos, CAST(sum(CASE WHEN label = 'click' THEN 1 ELSE 0 END) OVER (PARTITION BY src ORDER BY pos) AS BIGINT) AS count FROM ({SEQ})")
def seq_prefix_counts(spark, sf_dir):
    return S.prefix_counts(seq(spark, sf_dir), ["src"], "pos", F.col("label") == "click").select("src", "pos", "count")


@query("seq_counted_ahead", f"SELECT src, pos, CAST(sum(CASE WHEN label = 'click' THEN 1 ELSE 0 END) OVER (PARTITION BY src ORDER BY pos ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS BIGINT) AS ahead FROM ({SEQ})")
def seq_counted_ahead(spark, sf_dir):
    return S.counted_ahead(seq(spark, sf_dir), ["src"], "pos", F.col("label") == "click", 5).select("src", "pos", "ahead")


MERGED = f"""SELECT src, min(start) AS start, max("end") AS "end" FROM (SELECT *, sum(n) OVER (PARTITION BY src ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS g FROM
(SELECT *, CASE WHEN start <= max("end") OVER (PARTITION BY src ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS n FROM ({HALF_OPEN}))) GROUP BY src, g"""


@query("seq_merged", MERGED)
def seq_merged(spark, sf_dir):
    return S.merged(half_open(spark, sf_dir), ["src"])


@query(
    "seq_complement",
    f"""WITH m AS ({MERGED}), t AS (SELECT src, max("end") + 5 AS total FROM m GROUP BY src), u AS (SELECT src, start, "end" FROM m UNION ALL SELECT src, total, total FROM t),
    g AS (SELECT src, coalesce(lag("end") OVER (PARTITION BY src ORDER BY start, "end"), 0) AS start, start AS "end" FROM u) SELECT * FROM g WHERE start < "end" """,
)
def seq_complement(spark, sf_dir):
    h = half_open(spark, sf_dir)
    totals = h.groupBy("src").agg((F.max("end") + 5).alias("total"))
    return S.complement(h, ["src"], totals)


@query("seq_sliding", "WITH t AS (SELECT conv_id, count(*) AS total FROM conversations GROUP BY conv_id), w AS (SELECT *, unnest(range(0, total, 2)) AS start FROM t) SELECT conv_id, total, start, least(start + 4, total) AS \"end\" FROM w WHERE start = 0 OR start + 2 < total")
def seq_sliding(spark, sf_dir):
    t = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("total"))
    return S.sliding(t, "total", 4, 2)


@query("seq_ranges_text", f"SELECT src, string_agg(CASE WHEN start = \"end\" THEN CAST(start AS VARCHAR) ELSE start || '-' || \"end\" END, ', ' ORDER BY start) AS ranges FROM ({ISLANDS}) WHERE label = 'click' GROUP BY src")
def seq_ranges_text(spark, sf_dir):
    return S.ranges_text(seq(spark, sf_dir).filter("label = 'click'"), ["src"], "pos")


@query(
    "seq_nearest_labels",
    f"""WITH t AS ({SEQ}), l AS (SELECT a.src, a.pos, b.label, row_number() OVER (PARTITION BY a.src, a.pos ORDER BY a.pos - b.pos, b.label) AS r FROM t a JOIN t b ON a.src = b.src AND b.pos < a.pos AND b.pos >= a.pos - 200 AND b.label IN ('click', 'view')),
    k AS (SELECT a.src, a.pos, b.label, row_number() OVER (PARTITION BY a.src, a.pos ORDER BY b.pos - a.pos, b.label) AS r FROM t a JOIN t b ON a.src = b.src AND b.pos >= a.pos AND b.pos <= a.pos + 200 AND b.label IN ('click', 'view'))
    SELECT t.src, t.pos, l.label AS "left", k.label AS "right" FROM t LEFT JOIN l ON t.src = l.src AND t.pos = l.pos AND l.r = 1 LEFT JOIN k ON t.src = k.src AND t.pos = k.pos AND k.r = 1""",
)
def seq_nearest_labels(spark, sf_dir):
    return S.nearest_labels(seq(spark, sf_dir), ["src"], "pos", "label", ["click", "view"]).select("src", "pos", "left", "right")


@query("seq_rebased", "WITH j AS (SELECT conv_id % 10 AS k, conv_id, count(*) AS n FROM conversations GROUP BY ALL), o AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY k ORDER BY conv_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM j) SELECT conv_id, turn, CAST(turn + b AS BIGINT) AS rebased FROM conversations JOIN o USING (conv_id)")
def seq_rebased(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    n = c.groupBy("conv_id").agg(F.count("*").alias("n"))
    return S.rebased(c.join(n, "conv_id").withColumn("k", F.col("conv_id") % 10), ["k"], "conv_id", "n", "turn").select("conv_id", "turn", "rebased")


@query("seq_renumbered", "SELECT o_orderkey, 'r' || (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1) AS new_id FROM orders")
def seq_renumbered(spark, sf_dir):
    return S.renumbered(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], "r").select("o_orderkey", "new_id")


@query(
    "seq_cut_buckets",
    """WITH r AS (SELECT p_brand, p_retailprice, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice) AS k, count(*) OVER (PARTITION BY p_brand) AS n FROM part),
    c AS (SELECT p_brand, max(CASE WHEN k = ceil(n / 3.0) THEN p_retailprice END) AS c1, max(CASE WHEN k = ceil(2 * n / 3.0) THEN p_retailprice END) AS c2 FROM r GROUP BY p_brand)
    SELECT p_partkey, CASE WHEN p_retailprice <= c1 THEN 'small' WHEN p_retailprice <= c2 THEN 'medium' ELSE 'large' END AS bucket FROM part JOIN c USING (p_brand)""",
)
def seq_cut_buckets(spark, sf_dir):
    return S.cut_buckets(table(spark, sf_dir, "part"), ["p_brand"], "p_retailprice").select("p_partkey", "bucket")


@query(
    "seq_rolling_trend",
    """WITH m AS (SELECT o_orderpriority AS k, CAST(year(o_orderdate) AS INTEGER) AS y, median(o_totalprice) AS median FROM orders GROUP BY ALL), n AS (SELECT *, count(*) OVER (PARTITION BY k) AS c FROM m)
    SELECT k, y, round(median, 4) AS median, round(CASE WHEN c <= 1 THEN median WHEN c <= 5 THEN avg(median) OVER (PARTITION BY k ORDER BY y ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)
    WHEN c <= 9 THEN avg(median) OVER (PARTITION BY k ORDER BY y ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) ELSE avg(median) OVER (PARTITION BY k ORDER BY y ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) END, 4) AS trend FROM n""",
)
def seq_rolling_trend(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("k"), F.year("o_orderdate").alias("y"), "o_totalprice")
    return S.rolling_trend(o, ["k"], "y", "o_totalprice").withColumns({c: F.round(c, 4) for c in ("median", "trend")})


@query("seq_match_boundaries")
def seq_match_boundaries(spark, sf_dir):
    s = seq(spark, sf_dir)
    return S.match_boundaries(s.filter("label = 'click'").select("src", "pos"), s.filter("label = 'view'").select("src", "pos"), ["src"], "pos", 2)


@query("seq_boundary_scores", f"""WITH g AS (SELECT src, count(*) AS n FROM ({ISLANDS}) WHERE label = 'click' GROUP BY src), p AS (SELECT src, count(*) AS n FROM ({ISLANDS}) WHERE label IN ('click', 'view') GROUP BY src)
SELECT src, g.n AS tp, p.n - g.n AS fp, CAST(0 AS BIGINT) AS fn, round(g.n / p.n, 6) AS precision, 1.0 AS recall, round(2 * (g.n / p.n) / (1 + g.n / p.n), 6) AS f1 FROM g JOIN p USING (src)""")
def seq_boundary_scores(spark, sf_dir):
    runs = S.islands(seq(spark, sf_dir).filter("label IN ('click', 'view')"), ["src"], "pos", "label")
    matched = S.match_boundaries(runs.filter("label = 'click'").select("src", F.col("start").alias("pos")), runs.select("src", F.col("start").alias("pos")), ["src"], "pos", 0)
    scores = matched.withColumns(S.precision_recall(F.col("tp"), F.col("fp"), F.col("fn")))
    return scores.withColumns({c: F.round(c, 6) for c in ("precision", "f1")})


G, P = f"SELECT * FROM ({SPANS_SQL}) WHERE gold", f"SELECT * FROM ({SPANS_SQL}) WHERE NOT gold"
PAIRS = f"""SELECT g.id, p.id AS found_id, g.s, g.e, p.s AS fs, p.e AS fe, (least(g.e, p.e) - greatest(g.s, p.s) + 1) AS o FROM ({G}) g JOIN ({P}) p ON g.src = p.src AND g.label = p.label AND g.s <= p.e AND p.s <= g.e"""
BEST = f"SELECT *, o / ((e - s + 1) + (fe - fs + 1) - o) AS iou FROM ({PAIRS})"


def gold_and_found(spark, sf_dir):
    s = spans(spark, sf_dir)
    return s.filter("gold"), s.filter("NOT gold")


@query("join_overlap", f"SELECT id, found_id, CAST(o AS BIGINT) AS o FROM ({PAIRS})")
def join_overlap(spark, sf_dir):
    g, p = gold_and_found(spark, sf_dir)
    right = p.select("src", "label", F.col("id").alias("found_id"), F.col("s").alias("fs"), F.col("e").alias("fe"))
    j = I.overlap_join(g, right, ["src", "label"], ("s", "e", "fs", "fe"), 8)
    return j.select("id", "found_id", I.overlap(F.col("s"), F.col("e"), F.col("fs"), F.col("fe")).cast("long").alias("o"))


@query(
    "join_best_iou",
    f"""SELECT id, found_id, round(iou, 6) AS iou, iou >= 0.5 AS matched, CASE WHEN s = fs AND e = fe THEN 'exact' WHEN fs >= s AND fe <= e THEN 'under' WHEN fs <= s AND fe >= e THEN 'over' ELSE 'partial' END AS boundary
    FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY iou DESC, found_id) AS r FROM ({BEST})) WHERE r = 1""",
)
def join_best_iou(spark, sf_dir):
    g, p = gold_and_found(spark, sf_dir)
    return I.best_matches(g, p, ["src", "label"], 0.5, 8).withColumn("iou", F.round("iou", 6))


@query("join_overlap_semi", f"SELECT DISTINCT id FROM ({PAIRS})")
def join_overlap_semi(spark, sf_dir):
    g, p = gold_and_found(spark, sf_dir)
    return I.overlap_join(g, p.select("src", "label", F.col("s").alias("fs"), F.col("e").alias("fe")), ["src", "label"], ("s", "e", "fs", "fe"), 8, how="left_semi").select("id")


@query("join_overlap_anti", f"SELECT id FROM ({G}) WHERE id NOT IN (SELECT id FROM ({PAIRS}))")
def join_overlap_anti(spark, sf_dir):
    g, p = gold_and_found(spark, sf_dir)
    return I.overlap_join(g, p.select("src", "label", F.col("s").alias("fs"), F.col("e").alias("fe")), ["src", "label"], ("s", "e", "fs", "fe"), 8, how="left_anti").select("id")


@query(
    "join_span_labels",
    f"""WITH r AS (SELECT DISTINCT src, s AS pos FROM ({SPANS_SQL})), h AS (SELECT r.src, r.pos, list_sort(list_distinct(list(p.label))) AS l FROM r JOIN ({G}) p ON r.src = p.src AND r.pos BETWEEN p.s AND p.e GROUP BY ALL)
    SELECT src, pos, array_to_string(coalesce(l, ['OTHER']), ',') AS labels FROM r LEFT JOIN h USING (src, pos)""",
)
def join_span_labels(spark, sf_dir):
    g, _ = gold_and_found(spark, sf_dir)
    rows = spans(spark, sf_dir).select("src", F.col("s").alias("pos")).distinct()
    return I.labels_of(rows, g, ["src"], "pos", width=8).withColumn("labels", F.array_join("labels", ","))


MULTI = "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN ['click', 'view'] ELSE ['click'] END AS g, event_type AS f FROM events"


def multi(spark, sf_dir):
    g = F.when(F.col("event_id") % 4 == 0, F.array(F.lit("click"), F.lit("view"))).otherwise(F.array(F.lit("click")))
    return table(spark, sf_dir, "events").select("event_id", g.alias("g"), F.col("event_type").alias("f"))


COUNTS = f"""WITH m AS ({MULTI}), l AS (SELECT DISTINCT unnest(list_append(g, f)) AS label FROM m)
SELECT label, count(*) FILTER (list_contains(g, label) AND f = label) AS tp, count(*) FILTER (NOT list_contains(g, label) AND f = label) AS fp, count(*) FILTER (list_contains(g, label) AND f <> label) AS fn FROM m, l GROUP BY label"""
SCORED = f"SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS p, coalesce(tp / nullif(tp + fn, 0), 0) AS r FROM ({COUNTS})"


@query("lab_counts", f"SELECT label, tp, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall, round(coalesce(2 * p * r / nullif(p + r, 0), 0), 6) AS f1 FROM ({SCORED})")
def lab_counts(spark, sf_dir):
    return L.label_counts(multi(spark, sf_dir), "g", "f").withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query("lab_macro_f1", f"SELECT round(avg(coalesce(2 * p * r / nullif(p + r, 0), 0)), 6) AS macro_f1, round(min(CASE WHEN tp + fn > 0 THEN r END), 6) AS worst_recall, max(CASE WHEN tp + fn > 0 AND r = (SELECT min(r) FROM ({SCORED}) WHERE tp + fn > 0) THEN label END) AS worst_label FROM ({SCORED})")
def lab_macro_f1(spark, sf_dir):
    return L.macro_f1(L.label_counts(multi(spark, sf_dir), "g", "f")).withColumns({c: F.round(c, 6) for c in ("macro_f1", "worst_recall")})


@query("lab_accuracy", f"SELECT count(*) AS n, count(*) FILTER (list_contains(g, f)) AS correct, count(*) FILTER (list_contains(g, f)) / count(*) AS accuracy FROM ({MULTI})")
def lab_accuracy(spark, sf_dir):
    return L.accuracy(multi(spark, sf_dir), "g", "f")


@query("lab_confusion", f"SELECT CASE WHEN list_contains(g, f) THEN f WHEN list_contains(g, 'view') THEN 'view' ELSE g[1] END AS gold, f AS found, count(*) AS n FROM ({MULTI}) GROUP BY ALL")
def lab_confusion(spark, sf_dir):
    return L.confusion(multi(spark, sf_dir), "g", "f", ["view", "click"])


@query("lab_first_of", "SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS r FROM lineitem) WHERE r = 1")
def lab_first_of(spark, sf_dir):
    return L.first_of(table(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "lab_majority",
    """WITH c AS (SELECT user_id, event_type AS label, count(*) AS votes FROM events GROUP BY ALL), t AS (SELECT user_id, max(votes) AS votes FROM c GROUP BY user_id)
    SELECT user_id, CASE WHEN count(*) = 1 THEN max(label) END AS label, votes, count(*) > 1 AS tied FROM c JOIN t USING (user_id, votes) GROUP BY user_id, votes""",
)
def lab_majority(spark, sf_dir):
    return L.majority(table(spark, sf_dir, "events").withColumnRenamed("event_type", "label"), ["user_id"], "label")


@query(
    "lab_bundled",
    f"SELECT src, row, array_to_string(list_sort(list_distinct(list(label))), ',') AS labels, count(DISTINCT label) > 1 AS conflict FROM (SELECT src, label, unnest(range(s, e + 1)) AS row FROM ({G})) GROUP BY src, row",
)
def lab_bundled(spark, sf_dir):
    g, _ = gold_and_found(spark, sf_dir)
    return L.bundled(g.withColumn("rows", F.sequence("s", "e")), ["src"], "rows", "label").withColumn("labels", F.array_join("labels", ","))


@query("lab_aligned_by_text", "WITH t AS (SELECT event_type AS t, user_id % 20 AS k, event_id AS i, event_id % 2 AS h, row_number() OVER (PARTITION BY user_id % 20, event_id % 2, event_type ORDER BY event_id) AS r FROM events) SELECT a.k, a.t, a.i, b.i AS other FROM t a JOIN t b ON a.k = b.k AND a.t = b.t AND a.r = b.r AND a.h = 0 AND b.h = 1")
def lab_aligned_by_text(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("t"), (F.col("user_id") % 20).alias("k"), F.col("event_id").alias("i"))
    return L.aligned_by_text(e.filter("i % 2 = 0"), e.filter("i % 2 = 1"), ["k"], "t", "i")


@query("ord_top_categories", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, event_type LIMIT 3")
def ord_top_categories(spark, sf_dir):
    return O.top_categories(table(spark, sf_dir, "events"), "event_type", 3)


@query("ord_first_per_bucket", "SELECT o_orderpriority, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r <= 40")
def ord_first_per_bucket(spark, sf_dir):
    return O.first_per_bucket(table(spark, sf_dir, "orders"), ["o_orderpriority"], [F.desc("o_totalprice"), "o_orderkey"], 40).select("o_orderpriority", "o_orderkey")


@query("ord_sampled")
def ord_sampled(spark, sf_dir):
    return O.sampled(table(spark, sf_dir, "orders"), ["o_orderkey"], 50)


@query("ord_latest_preferred", "SELECT o_orderkey FROM orders ORDER BY o_orderstatus = 'F', o_orderdate DESC, o_orderpriority = '1-URGENT' DESC, o_orderkey LIMIT 1")
def ord_latest_preferred(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return O.latest_preferred(o, "o_orderdate", [F.col("o_orderpriority") == "1-URGENT"], F.col("o_orderstatus") == "F", ["o_orderkey"]).select("o_orderkey")


@query("ord_pareto", "SELECT p_partkey FROM part p WHERE NOT EXISTS (SELECT 1 FROM part q WHERE q.p_brand = p.p_brand AND q.p_size <= p.p_size AND q.p_retailprice >= p.p_retailprice AND (q.p_size < p.p_size OR q.p_retailprice > p.p_retailprice))")
def ord_pareto(spark, sf_dir):
    return O.pareto(table(spark, sf_dir, "part"), ["p_brand"], "p_size", "p_retailprice").select("p_partkey")


@query("ord_outliers", "SELECT event_id FROM events JOIN (SELECT event_type, median(value) AS m FROM events GROUP BY event_type) USING (event_type) WHERE value > 3 * m")
def ord_outliers(spark, sf_dir):
    return O.outliers(table(spark, sf_dir, "events"), ["event_type"], "value").select("event_id")


@query("ord_median_of_samples", "SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(median(o_totalprice), 4) AS median FROM orders GROUP BY ALL")
def ord_median_of_samples(spark, sf_dir):
    return O.median_of_samples(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"], "o_totalprice").withColumn("median", F.round("median", 4))


@query(
    "ord_compare_medians",
    """WITH m AS (SELECT o_orderkey % 2 AS h, o_orderpriority AS k, o_orderstatus AS t, median(o_totalprice) AS m FROM orders WHERE o_orderkey % 2 = 1 OR o_orderstatus <> 'P' GROUP BY ALL),
    j AS (SELECT coalesce(a.k, b.k) AS k, coalesce(a.t, b.t) AS t, a.m AS before, b.m AS now FROM (SELECT * FROM m WHERE h = 0) a FULL JOIN (SELECT * FROM m WHERE h = 1) b ON a.k = b.k AND a.t = b.t)
    SELECT k, t, round(before, 4) AS before, round(now, 4) AS now, round(now - before, 4) AS delta, CASE WHEN now - before IS NULL THEN 'incomplete' WHEN now - before >= 100 AND (now - before) / before >= 0.01 THEN 'regression'
    WHEN before - now >= 100 AND (before - now) / before >= 0.01 THEN 'improved' ELSE 'flat' END AS status FROM j""",
)
def ord_compare_medians(spark, sf_dir):
    o = table(spark, sf_dir, "orders").filter("o_orderkey % 2 = 1 OR o_orderstatus <> 'P'").select((F.col("o_orderkey") % 2).alias("h"), F.col("o_orderpriority").alias("k"), F.col("o_orderstatus").alias("t"), "o_totalprice")
    side = lambda h: O.median_of_samples(o.filter(F.col("h") == h), ["k", "t"], "o_totalprice")
    return O.compare_medians(side(0), side(1), ["k", "t"], 100, 0.01).withColumns({c: F.round(c, 4) for c in ("before", "now", "delta")})


@query(
    "ord_ranked_groups",
    """WITH p AS (SELECT o_orderpriority AS k, o_orderstatus AS t, avg(o_totalprice) AS q, median(o_custkey) AS c FROM orders GROUP BY ALL), g AS (SELECT k, count(*) AS sources, avg(q) AS quality, median(c) AS cost FROM p GROUP BY k)
    SELECT k, sources, round(quality, 4) AS quality, cost, CAST(row_number() OVER (ORDER BY quality DESC, cost, k) AS INTEGER) AS place FROM g""",
)
def ord_ranked_groups(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumns({"k": F.col("o_orderpriority"), "t": F.col("o_orderstatus")})
    return O.ranked_groups(o, "k", "t", "o_totalprice", "o_custkey").withColumn("quality", F.round("quality", 4))


@query("ord_width_stats", f"SELECT label, min(e - s + 1) AS low, quantile_cont(e - s + 1, 0.5) AS p50, quantile_cont(e - s + 1, 0.9) AS p90, max(e - s + 1) AS high, round(avg(e - s + 1), 6) AS mean FROM ({SPANS_SQL}) GROUP BY label")
def ord_width_stats(spark, sf_dir):
    return O.width_stats(spans(spark, sf_dir), ["label"], F.col("e") - F.col("s") + 1).withColumn("mean", F.round("mean", 6))


@query("ord_int_distribution", "SELECT count(*) AS n, min(n_chars) AS low, max(n_chars) AS high, round(avg(n_chars), 3) AS mean FROM documents")
def ord_int_distribution(spark, sf_dir):
    return O.int_distribution(table(spark, sf_dir, "documents"), "n_chars")


@query("ord_contiguous_parts", "SELECT o_orderkey, CAST(ntile(7) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS INTEGER) AS part FROM orders")
def ord_contiguous_parts(spark, sf_dir):
    return O.contiguous_parts(table(spark, sf_dir, "orders"), ["o_orderstatus"], ["o_orderkey"], 7).select("o_orderkey", "part")


@query(
    "ord_job_ranges",
    """WITH j AS (SELECT doc_id, n_chars, least(8, ceil(n_chars / 500.0)) AS j FROM documents WHERE n_chars > 0), k AS (SELECT *, ceil(n_chars / j) AS n, unnest(range(0, CAST(j AS BIGINT))) AS job FROM j)
    SELECT doc_id, CAST(job AS INTEGER) AS job, CAST(job * n AS BIGINT) AS start, CAST(least(n_chars, (job + 1) * n) AS BIGINT) AS "end" FROM k WHERE job * n < least(n_chars, (job + 1) * n)""",
)
def ord_job_ranges(spark, sf_dir):
    return O.job_ranges(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "n_chars", 8, 500).select("doc_id", "job", "start", "end")


@query("ord_round_robin", "SELECT o_orderkey, CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) % 5 AS INTEGER) AS worker FROM orders")
def ord_round_robin(spark, sf_dir):
    return O.round_robin(table(spark, sf_dir, "orders"), ["o_orderstatus"], ["o_orderkey"], 5).select("o_orderkey", "worker")


@query("ord_tail_paired", "WITH r AS (SELECT o_orderkey, count(*) OVER w0 AS n, row_number() OVER w AS d FROM orders WINDOW w0 AS (PARTITION BY o_custkey), w AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)) SELECT o_orderkey, CASE WHEN d * 2 <= n + 1 THEN 2 * d - 2 ELSE 2 * (n - d) + 1 END AS turn FROM r")
def ord_tail_paired(spark, sf_dir):
    return O.tail_paired(table(spark, sf_dir, "orders"), ["o_custkey"], "o_totalprice", ["o_orderkey"]).select("o_orderkey", "turn")


@query("ord_budgeted_batches")
def ord_budgeted_batches(spark, sf_dir):
    return O.budgeted_batches(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderkey", "o_totalprice", 300000.0, 4)


@query("ord_kept_in_cache")
def ord_kept_in_cache(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("age", (F.lit(20000) - F.col("o_orderkey") / 4).cast("double"))
    return O.kept_in_cache(o, ["o_custkey"], "age", "o_totalprice", "o_orderkey", 100.0, 500000.0)


@query(
    "ded_line_offsets",
    r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents), o AS (SELECT *, coalesce(sum(length(t) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM l)
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS line, CAST(s AS BIGINT) AS start, CAST(s + length(t) AS BIGINT) AS "end" FROM o WHERE trim(t) <> ''""",
)
def ded_line_offsets(spark, sf_dir):
    from larder.functions.text import line_offsets

    return line_offsets(table(spark, sf_dir, "documents"), "doc_id", "text").select("doc_id", "line", "start", "end")


CLUSTERS = """SELECT *, sum(n) OVER (PARTITION BY src ORDER BY s, e, id ROWS UNBOUNDED PRECEDING) - 1 AS cluster FROM (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY src ORDER BY s, e, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS n FROM
(SELECT event_id AS id, user_id AS src, event_id AS s, event_id + event_id % 700 AS e FROM events))"""


def spread(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("id"), F.col("user_id").alias("src"), F.col("event_id").alias("s"), (F.col("event_id") + F.col("event_id") % 700).alias("e"))


@query("seq_clusters", f"SELECT src, CAST(cluster AS BIGINT) AS cluster, count(*) AS n FROM ({CLUSTERS}) GROUP BY ALL")
def seq_clusters(spark, sf_dir):
    return S.clusters(spread(spark, sf_dir), ["src"], "s", "e").groupBy("src", "cluster").agg(F.count("*").alias("n"))


@query("seq_best_of_clusters", f"SELECT id FROM (SELECT *, row_number() OVER (PARTITION BY src, cluster ORDER BY id % 5 DESC, s, e - s, id) AS r FROM ({CLUSTERS})) WHERE r = 1")
def seq_best_of_clusters(spark, sf_dir):
    d = spread(spark, sf_dir).withColumn("score", F.col("id") % 5)
    return S.best_of_clusters(d, ["src"], "s", "e", "score", ["id"]).select("id")


@query("seq_runs_with", f"WITH i AS (SELECT src, pos, value, pos - row_number() OVER (PARTITION BY src ORDER BY pos) AS i FROM ({SEQ}) WHERE label IN ('click', 'view')) SELECT src, min(pos) AS start, max(pos) AS \"end\", count(*) AS n, round(avg(value), 6) AS mean FROM i GROUP BY src, i HAVING count(*) >= 3 AND avg(value) >= 40")
def seq_runs_with(spark, sf_dir):
    out = S.runs_with(seq(spark, sf_dir), ["src"], "pos", F.col("label").isin("click", "view"), "value", 3, 40.0)
    return out.withColumn("mean", F.round("mean", 6))


@query("seq_repeats", f"SELECT src, label, pos AS first, second FROM (SELECT *, lead(pos) OVER (PARTITION BY src, label ORDER BY pos) AS second FROM ({SEQ})) WHERE second - pos BETWEEN 4 AND 9")
def seq_repeats(spark, sf_dir):
    return S.repeats(seq(spark, sf_dir), ["src"], "pos", "label", 4, 9)


@query("seq_focus_slice", "SELECT conv_id, CAST(floor((n - least(n, 4)) / 2) AS BIGINT) AS start, CAST(floor((n - least(n, 4)) / 2) + least(n, 4) AS BIGINT) AS \"end\" FROM (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id)")
def seq_focus_slice(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"))
    start, end = S.focus_slice(F.col("n"), 10, 4)
    return c.select("conv_id", start.alias("start"), end.alias("end"))


@query(
    "seq_overlap_for",
    """WITH t AS (SELECT doc_id, n_chars AS n, 5 + doc_id % 7 AS w FROM documents), o AS (SELECT *, unnest(range(0, 100)) AS o FROM t), k AS (SELECT *, CASE WHEN n <= 100 THEN 1 ELSE greatest(1, ceil((n - o) / (100 - o))) END AS c FROM o),
    r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY abs(c - w), o) AS r FROM k) SELECT doc_id, CAST(o AS INTEGER) AS overlap, CAST(c AS BIGINT) AS tasks FROM r WHERE r = 1""",
)
def seq_overlap_for(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").alias("n"), (F.col("doc_id") % 7 + 5).alias("w"))
    return S.overlap_for(d, "n", 100, "w").select("doc_id", "overlap", "tasks")


@query("ord_shard_count", "SELECT doc_id, CAST(CASE WHEN n_chars > 0 THEN greatest(1, least(n_chars, CASE WHEN doc_id % 3 > 0 THEN doc_id % 3 ELSE ceil(n_chars / 700.0) END)) ELSE 0 END AS BIGINT) AS n, CAST(CASE WHEN n_chars < 2000 THEN 1 ELSE least(6, doc_id + 1, ceil(n_chars / 2000.0)) END AS BIGINT) AS parts FROM documents")
def ord_shard_count(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    n = F.col("n_chars")
    return d.select("doc_id", O.shard_count(n, F.col("doc_id") % 3, F.lit(None).cast("long"), 700).alias("n"), O.cost_shards(n, F.col("doc_id") + 1, 2000, 6).alias("parts"))


@query("ord_correct_sample", "SELECT event_id FROM events WHERE event_id % 3 <> 0 ORDER BY event_type = 'view', event_id LIMIT 30")
def ord_correct_sample(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type")
    return O.correct_sample(e, e.filter("event_id % 3 = 0"), "event_id", "event_type", "view", 30).select("event_id")


@query("ord_distinct_settings", "SELECT r_name, a, b FROM (SELECT DISTINCT r_name FROM region), (SELECT unnest(['x', 'y']) AS a), (SELECT unnest(['1', '2', '3']) AS b)")
def ord_distinct_settings(spark, sf_dir):
    r = table(spark, sf_dir, "region").select("r_name")
    return O.distinct_settings(r.unionByName(r), {"a": ["x", "y"], "b": ["1", "2", "3", "1"]}).drop("hash")


@query("join_contained_phrases", "SELECT DISTINCT p_partkey, p_type AS phrase FROM part WHERE contains(' ' || lower(p_name || ' made of ' || p_type) || ' ', ' ' || lower(p_type) || ' ')")
def join_contained_phrases(spark, sf_dir):
    from larder.operators.merging import contained_phrases

    p = table(spark, sf_dir, "part")
    texts = p.select("p_partkey", F.concat_ws(" made of ", "p_name", "p_type").alias("t"))
    return contained_phrases(texts, p.select("p_partkey", F.col("p_type").alias("phrase")), ["p_partkey"], "t", "phrase").select("p_partkey", "phrase").distinct()


@query("join_matched_files", "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN url END AS matched, CASE WHEN page_id % 2 = 1 THEN 'no such file' END AS reason FROM pages WHERE page_id IN (SELECT min(page_id) FROM pages GROUP BY lower(list_last(string_split(rtrim(url, '/'), '/'))) HAVING count(*) = 1)")
def join_matched_files(spark, sf_dir):
    from larder.functions.fields import basename
    from larder.operators.merging import matched_files

    p = table(spark, sf_dir, "pages").withColumn("_b", F.lower(basename(F.col("url"))))
    single = p.join(p.groupBy("_b").count().filter("count = 1").select("_b"), "_b").select("page_id", "url")
    return matched_files(single, single.filter("page_id % 2 = 0"), "url").select("page_id", "matched", "reason")
