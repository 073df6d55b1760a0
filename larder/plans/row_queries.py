"""Rows, labels and categories over lines of documents and over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.functions import repair
from larder.operators import rows as R
from larder.plans.registry import query
from larder.plans.tables import table
from larder.plans.views import lines

_BROKEN = "text || ' itâ€™s cafÃ© Ãla â€œxâ€¦ Â'"


def _replaced(x: str) -> str:
    for bad, good in repair.MOJIBAKE:
        quoted = good.replace("'", "''")
        x = f"replace({x}, '{bad}', '{quoted}')"
    return x


@query("txt_mojibake", f"SELECT doc_id, md5({_replaced(_BROKEN)}) AS t FROM documents")
def txt_mojibake(spark, sf_dir):
    broken = F.concat("text", F.lit(" itâ€™s cafÃ© Ãla â€œxâ€¦ Â"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(repair.fix_mojibake(broken)).alias("t"))


@query("txt_normalised")
def txt_normalised(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(repair.normalised(F.col("text"))).alias("t"), F.md5(repair.book_text(F.col("text"))).alias("b"))


LINES = "SELECT doc_id, line, text FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents)"
FEATURES = rf"""SELECT doc_id, CAST(line AS INTEGER) AS line, regexp_matches(t, '^(\d+([./]\d+)?|[¼½¾⅓⅔⅛⅜⅝⅞])') AS quantity, regexp_matches(t, '^(?:step\s*)?\d{{1,2}}[.)]\s') AS number, length(text) < 50 AS short,
regexp_matches(t, '\p{{L}}') AND NOT regexp_matches(t, '(^|\P{{L}})\p{{Ll}}|\p{{L}}\p{{Lu}}') AS title_case, length(text) < 50 AND (regexp_matches(t, '\p{{L}}') AND NOT regexp_matches(t, '(^|\P{{L}})\p{{Ll}}|\p{{L}}\p{{Lu}}') OR regexp_replace(lower(t), ':+$', '') IN ('ingredients', 'ingredient list', 'you will need', 'for the ingredients', 'instructions', 'directions', 'method', 'preparation', 'steps') OR ends_with(t, ':')) AS header
FROM (SELECT *, trim(text) AS t FROM ({LINES}))"""


@query("row_features", FEATURES)
def row_features(spark, sf_dir):
    return lines(spark, sf_dir).withColumn("f", R.features(F.col("text"))).select("doc_id", "line", "f.quantity", "f.number", "f.short", "f.title_case", "f.header")


@query("row_roles", rf"""SELECT doc_id, CAST(line AS INTEGER) AS line, CASE WHEN t = '' THEN 'other' WHEN line % 5 = 0 THEN 'section_heading' WHEN line % 5 = 1 AND length(t) <= 80 THEN 'recipe_title' WHEN line % 5 = 1 THEN 'section_heading'
WHEN regexp_matches(lower(t), '^(note|tip|hint|variation)\s*[:—–-]') THEN 'tip_like' WHEN len(list_filter(regexp_split_to_array(t, '\s+'), lambda w: w <> '')) >= 4 THEN 'narrative' ELSE 'other' END AS role
FROM (SELECT *, 'x' || trim(text) AS t FROM ({LINES}) WHERE line % 5 > 0 OR length(text) < 50)""")
def row_roles(spark, sf_dir):
    d = lines(spark, sf_dir).filter("line % 5 > 0 OR char_length(text) < 50").withColumn("t", F.concat(F.lit("x"), F.trim("text")))
    none = R.features(F.lit("x"))
    level = F.when(F.col("line") % 5 == 0, 2).when(F.col("line") % 5 == 1, 3)
    return d.select("doc_id", "line", R.block_role(F.col("t"), none, level).alias("role"))


@query("row_sources")
def row_sources(spark, sf_dir):
    return R.source_rows(lines(spark, sf_dir), "doc_id", "line", "text").select("doc_id", "row", "block", "ordinal", "start", "end", F.md5("text").alias("t"), F.array_join("tags", ",").alias("tags"))


@query("row_line_roles")
def row_line_roles(spark, sf_dir):
    rows = lines(spark, sf_dir).filter(F.trim("text") != "").withColumn("tags", R.rule_tags(F.col("text")))
    return R.line_roles(rows, ["doc_id"], "line", "text", "tags").select("doc_id", "line", "label", "reason")


@query("row_atoms")
def row_atoms(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("block", F.lit(0))
    return R.atoms(d, "doc_id", "block", "text").select("doc_id", "atom", "kind", F.md5("text").alias("t"))


@query("row_ordered", "SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn % 3, turn) - 1 AS INTEGER) AS place FROM conversations WHERE trim(regexp_replace(text, '\\s+', ' ', 'g')) <> ''")
def row_ordered(spark, sf_dir):
    d = table(spark, sf_dir, "conversations").withColumn("o", F.col("turn") % 3)
    return R.ordered_blocks(d, ["conv_id"], "o", "turn", "text").select("conv_id", "turn", "place")


@query("row_fallback", "SELECT event_id, CASE WHEN event_type <> 'view' THEN event_type WHEN user_id % 3 = 0 THEN 'RECIPE_NOTES' ELSE 'NONRECIPE_CANDIDATE' END AS label, CASE WHEN event_type <> 'view' THEN 'recovered' ELSE 'unavailable' END AS why FROM events")
def row_fallback(spark, sf_dir):
    d = table(spark, sf_dir, "events")
    x = R.fallback_label(F.when(F.col("event_type") != "view", F.col("event_type")), F.when(F.col("user_id") % 3 < 2, F.col("user_id") % 3 == 0), "open")
    return d.select("event_id", x["label"].alias("label"), x["reasons"][1].alias("why"))


@query("row_projected", "SELECT user_id, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS INTEGER) AS line, CASE WHEN event_type IN ('click', 'view') THEN upper(event_type) ELSE 'OTHER' END AS event_type FROM events")
def row_projected(spark, sf_dir):
    return R.spans_of_labels(table(spark, sf_dir, "events"), ["user_id"], "event_id", "event_type", ["CLICK", "VIEW"]).select("user_id", "event_id", "line", "event_type")


@query("row_span_decisions", """WITH s AS (SELECT event_id // 7 AS span, min(event_id) AS start, max(event_id) AS "end", count(*) AS n, min(event_id) FILTER (event_type = 'view') AS title_row, bool_or(event_type = 'click') AS a, bool_or(event_type = 'purchase') AS b FROM events GROUP BY 1)
SELECT CAST(span AS BIGINT) AS span, start, "end", n, title_row, CASE WHEN title_row IS NULL THEN 'no title' WHEN NOT a AND NOT b THEN 'no recipe lines' WHEN NOT a THEN 'no click' WHEN NOT b THEN 'no purchase' END AS reason, title_row IS NOT NULL AND a AND b AS accepted FROM s""")
def row_span_decisions(spark, sf_dir):
    d = table(spark, sf_dir, "events").withColumn("span", F.floor(F.col("event_id") / 7))
    return R.span_decisions(d, ["span"], "event_id", "event_type", "view", ["click", "purchase"]).drop("missing")


TITLE_PAIRS = "SELECT user_id, event_id AS first, lead(event_id) OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS second FROM events"


@query("row_trimmed_starts", f"""WITH s AS (SELECT user_id, event_id AS start, event_id + 400 AS "end" FROM events WHERE event_type = 'view'), p AS (SELECT * FROM ({TITLE_PAIRS}) WHERE second IS NOT NULL),
h AS (SELECT s.user_id, s.start, second, row_number() OVER (PARTITION BY s.user_id, s.start ORDER BY first, second) AS r FROM s JOIN p ON s.user_id = p.user_id AND first BETWEEN start AND start + 90 AND second > start AND second < "end" AND second - start <= 300)
SELECT s.*, coalesce(h.second, s.start) AS trimmed FROM s LEFT JOIN h ON s.user_id = h.user_id AND s.start = h.start AND r = 1""")
def row_trimmed_starts(spark, sf_dir):
    from pyspark.sql import Window

    e = table(spark, sf_dir, "events")
    pairs = e.select("user_id", F.col("event_id").alias("first"), F.lead("event_id").over(Window.partitionBy("user_id", "event_type").orderBy("event_id")).alias("second")).filter("second IS NOT NULL")
    spans = e.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("start"), (F.col("event_id") + 400).alias("end"))
    return R.trimmed_starts(spans, pairs, ["user_id"], 90, 300)


SETTLED = "SELECT event_id, CASE WHEN user_id % 9 = 0 THEN 'other' ELSE event_type END AS category FROM events WHERE event_type IN ('view', 'click') OR user_id % 9 = 0"


def settled(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    said = e.filter(F.col("event_type").isin("view", "click")).select("event_id", F.col("event_type").alias("category"))
    more = said.unionByName(spark.createDataFrame([(-1, "view")], "event_id long, category string"))
    return R.settled_categories(e, "event_id", more, e.filter("user_id % 9 = 0"), "category")


@query("row_settled", SETTLED)
def row_settled(spark, sf_dir):
    return settled(spark, sf_dir)


@query("row_refined", f"""WITH s AS ({SETTLED}), u AS (SELECT event_id, 'click' AS n FROM events WHERE user_id % 4 = 1 AND user_id % 5 = 2) SELECT event_id, coalesce(n, category) AS category, category AS before, n IS NOT NULL AND coalesce(n <> category, false) AS changed, n IS NOT NULL AS reviewed FROM s FULL JOIN u USING (event_id)""")
def row_refined(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    updates = e.filter("user_id % 4 = 1").select("event_id", F.lit("click").alias("category"))
    return R.refined_categories(settled(spark, sf_dir), e.filter("user_id % 5 = 2"), updates, "event_id", "category")


@query("row_evidence", f"WITH s AS ({SETTLED}) SELECT event_id, 'view' AS state FROM s WHERE category = 'view' UNION ALL SELECT event_id, 'unresolved' FROM events WHERE user_id % 3 = 0 AND event_id NOT IN (SELECT event_id FROM s)")
def row_evidence(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return R.evidence(settled(spark, sf_dir), e.filter("user_id % 3 = 0"), "event_id", "category", "view")


IN_RANGE = """WITH r AS (SELECT user_id AS src, event_id AS id, event_id % 40 AS line FROM events), q AS (SELECT user_id AS src, event_id AS qid, event_id % 60 AS s, event_id % 60 + event_id % 2 AS e FROM events WHERE event_type = 'error'),
h AS (SELECT q.src, qid, r.id, d.w FROM q JOIN r ON q.src = r.src JOIN (VALUES (0, 0, 0), (1, 0, -1), (2, 0, 1), (3, 1, 0), (4, 1, -1), (5, 1, 1)) d(w, c, o) ON CASE WHEN d.c = 0 THEN r.line ELSE r.id END BETWEEN s + d.o AND e + d.o),
m AS (SELECT src, qid, min(w) AS w FROM h GROUP BY ALL) SELECT h.src, h.qid AS id, h.id AS event_id FROM h JOIN m USING (src, qid, w)"""


@query("row_in_range", IN_RANGE)
def row_in_range(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    rows = e.select(F.col("user_id").alias("src"), "event_id", (F.col("event_id") % 40).alias("line"))
    s = F.col("event_id") % 60
    wanted = e.filter("event_type = 'error'").select(F.col("user_id").alias("src"), F.col("event_id").alias("id"), s.alias("s"), (s + F.col("event_id") % 2).alias("e"))
    return R.rows_in_range(rows, wanted, ["src"], "line", "event_id")


@query("row_variants", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN ['a', 'b', 'Variation: c'] ELSE ['Variation - c'] END AS variants, CASE WHEN o_orderkey % 3 = 0 THEN ['x', 'Notes', 'y'] ELSE ['x', 'a', 'b', 'Notes', 'y'] END AS remaining FROM orders")
def row_variants(spark, sf_dir):
    head = F.when(F.col("o_orderkey") % 3 == 0, F.array(F.lit("x"), F.lit("Variations:"), F.lit("a "), F.lit("b"), F.lit("Notes"), F.lit("Variation: c"), F.lit("y"))).otherwise(F.array(F.lit("x"), F.lit("a"), F.lit("b"), F.lit("Notes"), F.lit("Variation - c"), F.lit("y")))
    v = R.split_variants(head)
    return table(spark, sf_dir, "orders").select("o_orderkey", v["variants"].alias("variants"), v["remaining"].alias("remaining"))
