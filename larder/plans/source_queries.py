"""Sources and recipe functions over pages, tasks and lines made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.functions import recipes as R
from larder.functions import text as T
from larder.operators import facade
from larder.operators import labels as L
from larder.operators import merging as M
from larder.operators import ordering as O
from larder.operators import quality as Q
from larder.operators import rows as W
from larder.operators import staging
from larder.plans.registry import query
from larder.plans.tables import table
from larder.sources import books, html, pages, recipes, records, reports
from larder.sources import lines as N


def part(spark, sf_dir):
    return table(spark, sf_dir, "part")


def orders(spark, sf_dir):
    return table(spark, sf_dir, "orders")


@query("src_best_reader", "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'text' WHEN 1 THEN 'table' WHEN 2 THEN 'book' WHEN 3 THEN 'pages' END AS reader FROM part")
def src_best_reader(spark, sf_dir):
    k = F.col("p_partkey") % 5
    path = F.concat(F.lit("in/"), "p_partkey", F.when(k == 0, ".TXT").when(k == 1, ".xlsx").when(k == 2, ".epub").when(k == 3, ".pdf").otherwise(".zip"))
    return part(spark, sf_dir).select("p_partkey", records.default_registry().best(path).alias("reader"))


PAGE = """'<html><head><link rel="canonical" href="http://x/' || p_partkey || '"/></head><body><nav>menu</nav><table><tr><th>Id</th><th>Size</th></tr><tr><td>' || p_partkey || '</td><td>' || p_size || ' cm</td></tr></table><p>This part is one of many parts that are kept here.</p><ul><li>one</li></ul></body></html>'"""


def part_pages(spark, sf_dir):
    head = F.concat(F.lit('<html><head><link rel="canonical" href="http://x/'), "p_partkey", F.lit('"/></head><body><nav>menu</nav><table><tr><th>Id</th><th>Size</th></tr><tr><td>'), "p_partkey", F.lit("</td><td>"), "p_size")
    return part(spark, sf_dir).select("p_partkey", "p_size", F.concat(head, F.lit(" cm</td></tr></table><p>This part is one of many parts that are kept here.</p><ul><li>one</li></ul></body></html>")).alias("html"))


@query("src_table_rows", "SELECT p_partkey, 0 AS row, 'Id|Size' AS cells, true AS is_header FROM part UNION ALL SELECT p_partkey, 1, p_partkey || '|' || p_size || ' cm', false FROM part")
def src_table_rows(spark, sf_dir):
    return pages.table_rows(part_pages(spark, sf_dir), "p_partkey", "html").withColumn("cells", F.array_join("cells", "|"))


@query("src_canonical", "SELECT p_partkey, 'http://x/' || p_partkey AS url FROM part")
def src_canonical(spark, sf_dir):
    return part_pages(spark, sf_dir).select("p_partkey", html.canonical(F.col("html")).alias("url"))


ELEMENTS = "(VALUES (0, 'th', 'Table', 'Id'), (1, 'th', 'Table', 'Size'), (2, 'td', 'Table', NULL), (3, 'td', 'Table', NULL), (4, 'p', 'NarrativeText', 'This part is one of many parts that are kept here.'), (5, 'li', 'ListItem', 'one')) e(block, tag, kind, t)"


@query("src_elements", f"SELECT p_partkey, block, tag, kind, coalesce(t, CASE block WHEN 2 THEN CAST(p_partkey AS VARCHAR) ELSE p_size || ' cm' END) AS text FROM part, {ELEMENTS}")
def src_elements(spark, sf_dir):
    return pages.elements(part_pages(spark, sf_dir), "p_partkey", "html").select("p_partkey", "block", "tag", "kind", "text")


@query("src_main_text", "SELECT p_partkey, 'This part is one of many parts that are kept here.' AS text, 'prose' AS way FROM part")
def src_main_text(spark, sf_dir):
    return pages.main_text(part_pages(spark, sf_dir), "p_partkey", "html", "prose").select("p_partkey", "text", "way")


@query("src_best_text", "SELECT p_partkey, 'Id' || chr(10) || 'Size' || chr(10) || p_partkey || chr(10) || p_size || ' cm' || chr(10) || 'This part is one of many parts that are kept here.' || chr(10) || 'one' AS text FROM part")
def src_best_text(spark, sf_dir):
    return pages.main_text(part_pages(spark, sf_dir), "p_partkey", "html").select("p_partkey", "text")


@query("src_split_breaks", "SELECT p_partkey, '<p>' || p_partkey || '</p><p>' || p_size || '</p>' AS html FROM part")
def src_split_breaks(spark, sf_dir):
    broken = F.concat(F.lit("<style>x</style><p>"), "p_partkey", F.lit("<br/>"), "p_size", F.lit("</p>"))
    return pages.prepared(part(spark, sf_dir).select("p_partkey", broken.alias("html")), "p_partkey", "html")


@query("src_page_elements")
def src_page_elements(spark, sf_dir):
    return pages.elements(table(spark, sf_dir, "pages"), "page_id", "html").select("page_id", "block", "tag", "kind", F.md5("text").alias("t"))


@query("src_page_text")
def src_page_text(spark, sf_dir):
    return pages.main_text(table(spark, sf_dir, "pages"), "page_id", "html").select("page_id", F.md5("text").alias("t"), "way")


@query("src_as_markdown", "SELECT p_partkey, 'Id' || chr(10) || chr(10) || 'Size' || chr(10) || chr(10) || p_partkey || chr(10) || chr(10) || p_size || ' cm' || chr(10) || chr(10) || 'This part is one of many parts that are kept here.' || chr(10) || chr(10) || '- one' AS text FROM part")
def src_as_markdown(spark, sf_dir):
    return pages.as_markdown(html.blocks(part_pages(spark, sf_dir), "p_partkey", "html"), "p_partkey")


@query("src_cleaned_blocks", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_partkey || ' words that go on and on' ELSE 'one' END AS text, 0 AS part FROM part UNION ALL SELECT p_partkey, 'two', 1 FROM part WHERE p_partkey % 2 = 1")
def src_cleaned_blocks(spark, sf_dir):
    even = F.col("p_partkey") % 2 == 0
    text = F.when(even, F.concat("p_partkey", F.lit(" words that go\non and on"))).otherwise("• one\n- two")
    d = part(spark, sf_dir).select("p_partkey", F.lit(0).alias("o"), text.alias("t"), F.when(even, "p").otherwise("li").alias("tag"))
    d = d.unionByName(d.withColumns({"o": F.lit(1), "t": F.lit("Page 7")}))
    # A quantity at its beginning would make one line of two an ingredient list; letters keep it prose.
    d = d.withColumn("t", F.when(even & (F.col("o") == 0), F.concat(F.lit("#"), F.col("t"))).otherwise(F.col("t")))
    out = pages.cleaned_blocks(d, ["p_partkey"], "o", "t", "tag")
    return out.select("p_partkey", F.regexp_replace("text", "^#", "").alias("text"), "part")


LD = """'{"@type": ["Recipe"], "name": "' || p_name || '", "recipeIngredient": ["a", " ", "' || p_size || ' b"], "recipeInstructions": [{"@type": "HowToSection", "itemListElement": [{"text": "Mix."}, {"text": "Bake."}]}], "recipeYield": ' || p_size || '}'"""


def ld_pages(spark, sf_dir):
    ld = F.concat(F.lit('{"@type": ["Recipe"], "name": "'), "p_name", F.lit('", "recipeIngredient": ["a", " ", "'), "p_size", F.lit(' b"], "recipeInstructions": [{"@type": "HowToSection", "itemListElement": [{"text": "Mix."}, {"text": "Bake."}]}], "recipeYield": '), "p_size", F.lit("}"))
    twice = F.concat(F.lit('<script type="application/ld+json">{"@graph": ['), ld, F.lit(", "), ld, F.lit("]}</script>"))
    return part(spark, sf_dir).select("p_partkey", twice.alias("html"))


@query("src_schema_recipes", "SELECT p_partkey, 0 AS recipe, p_name AS name, 'a|' || p_size || ' b' AS ingredients, 'Mix.|Bake.' AS steps, CAST(p_size AS VARCHAR) AS yield FROM part")
def src_schema_recipes(spark, sf_dir):
    out = recipes.schema_recipes(ld_pages(spark, sf_dir), "p_partkey", "html")
    return out.select("p_partkey", "recipe", "name", F.array_join("ingredients", "|").alias("ingredients"), F.array_join("steps", "|").alias("steps"), "yield")


@query("src_schema_confidence", "SELECT p_partkey, round(0.0::DOUBLE + CASE WHEN p_partkey % 2 = 0 THEN 0.3 ELSE 0 END + CASE p_partkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 0.2 ELSE 0.4 END + CASE WHEN p_partkey % 5 > 0 THEN 0.3 ELSE 0 END, 6) AS c FROM part")
def src_schema_confidence(spark, sf_dir):
    k = F.col("p_partkey")
    items = F.when(k % 3 == 0, F.array().cast("array<string>")).when(k % 3 == 1, F.array(F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("b")))
    c = recipes.schema_confidence(F.when(k % 2 == 0, F.col("p_name")).otherwise(" "), items, F.when(k % 5 > 0, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>")))
    return part(spark, sf_dir).select("p_partkey", F.round(c, 6).alias("c"))


@query("src_json_ld", """SELECT p_partkey, '{"@context":"https://schema.org","@type":"Recipe","name":"' || p_name || '","recipeIngredient":["a"],"recipeInstructions":[{"@type":"HowToStep","text":"x"}],"recipeYield":"' || p_size || '"}' AS json FROM part""")
def src_json_ld(spark, sf_dir):
    return part(spark, sf_dir).select("p_partkey", recipes.json_ld_text(F.col("p_name"), F.array(F.lit("a")), F.array(F.lit("x")), F.col("p_size").cast("string")).alias("json"))


@query("src_split_texts", "SELECT o_orderkey, p AS part, CASE WHEN o_orderkey % 2 = 0 THEN CASE p WHEN 0 THEN 'Bean Pie' || chr(10) || 'Serves 4' || chr(10) || 'text' ELSE 'Pear Pie' || chr(10) || 'Serves ' || (o_custkey % 9 + 1) END ELSE CASE p WHEN 0 THEN 'one' ELSE 'two' END END AS text FROM orders, (VALUES (0), (1)) t(p)")
def src_split_texts(spark, sf_dir):
    by_yield = F.concat(F.lit("Bean Pie\nServes 4\ntext\nPear Pie\nServes "), (F.col("o_custkey") % 9 + 1).cast("string"))
    return recipes.split_texts(orders(spark, sf_dir).select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, by_yield).otherwise("one\n=====\ntwo").alias("t")), "o_orderkey", "t")


@query("src_recipe_starts", "SELECT o_orderkey, s AS start FROM orders, (VALUES (0), (3)) t(s)")
def src_recipe_starts(spark, sf_dir):
    texts = F.array(F.lit("Bean Pie"), F.lit("Serves 4"), F.lit("text"), F.lit("Pear Pie"), F.concat(F.lit("Serves "), (F.col("o_custkey") % 9 + 1).cast("string")))
    return recipes.recipe_starts(orders(spark, sf_dir).select("o_orderkey", F.posexplode(texts).alias("line", "t")), "o_orderkey", "line", "t").select("o_orderkey", "start")


@query("src_sections", "SELECT o_orderkey, line, CASE WHEN line < 1 THEN 'main' WHEN line < 3 THEN 'ingredients' ELSE 'sauce' END AS section FROM orders, (VALUES (0), (1), (2), (3), (4)) t(line)")
def src_sections(spark, sf_dir):
    texts = F.array(*map(F.lit, ("a", "Ingredients", "b", "For the sauce", "c")))
    d = orders(spark, sf_dir).select("o_orderkey", F.posexplode(texts).alias("line", "t"))
    header = F.when(R.line_kind(F.col("t")) == "heading", F.regexp_replace(F.lower("t"), "^for the ", ""))
    return N.under_headers(d, "o_orderkey", "line", header).select("o_orderkey", "line", "section")


BOOK = ("Words of the author that open this book.", "Apple Pie", "Serves 6", "2 cups flour", "1 tsp salt", "Mix and bake.", "Chapter Two", "Pear Tart", "Serves 4", "3 pears", "Cook it.")


@query("src_book_recipes", 'SELECT o_orderkey, CAST(s AS BIGINT) AS start, CAST(e AS BIGINT) AS "end" FROM orders, (VALUES (1, 6), (7, 11)) t(s, e)')
def src_book_recipes(spark, sf_dir):
    d = orders(spark, sf_dir).select("o_orderkey", F.posexplode(F.array(*map(F.lit, BOOK))).alias("o", "t"))
    return books.candidates(books.flagged(d, "o_orderkey", "o", "t"), "o_orderkey").select("o_orderkey", "start", "end")


@query("src_book_parts", "SELECT o_orderkey, CAST(p AS BIGINT) AS place, CASE WHEN p >= 7 THEN 1 ELSE 0 END AS part FROM orders, range(0, 11) t(p)")
def src_book_parts(spark, sf_dir):
    d = orders(spark, sf_dir).select("o_orderkey", F.posexplode(F.array(*map(F.lit, BOOK))).alias("o", "t"))
    return books.split_sections(books.flagged(d, "o_orderkey", "o", "t"), "o_orderkey")


@query("src_staged_drafts", "SELECT o_orderkey, 0 AS recipe, 'Apple Pie' AS title, 6 AS servings, '2 cups flour|1 tsp salt' AS ingredients, 'Mix and bake.' AS steps FROM orders")
def src_staged_drafts(spark, sf_dir):
    d = orders(spark, sf_dir).select("o_orderkey", F.posexplode(F.array(*map(F.lit, BOOK[:7]))).alias("o", "t"))
    out = staging.stage(d, "o_orderkey", "o", "t").drafts
    return out.select("o_orderkey", "recipe", "title", "servings", F.array_join("ingredients", "|").alias("ingredients"), F.array_join("steps", "|").alias("steps"))


@query("src_staged_spans", 'SELECT o_orderkey, CAST(1 AS BIGINT) AS start, CAST(5 AS BIGINT) AS "end", true AS accepted FROM orders')
def src_staged_spans(spark, sf_dir):
    d = orders(spark, sf_dir).select("o_orderkey", F.posexplode(F.array(*map(F.lit, BOOK[:7]))).alias("o", "t"))
    return staging.stage(d, "o_orderkey", "o", "t").spans.select("o_orderkey", "start", "end", "accepted")


@query("src_staged_outside", "SELECT o_orderkey, c AS category, s AS start FROM orders, (VALUES ('candidate', 0), ('candidate', 6)) t(c, s)")
def src_staged_outside(spark, sf_dir):
    d = orders(spark, sf_dir).select("o_orderkey", F.posexplode(F.array(*map(F.lit, BOOK[:7]))).alias("o", "t"))
    return staging.stage(d, "o_orderkey", "o", "t").outside.select("o_orderkey", "category", F.col("start").cast("int").alias("start"))


@query("src_predicted_ranges", """SELECT 'urn:x:chunk:y:' || user_id || ':' || event_id AS id, CAST(user_id AS VARCHAR) AS source, 'unknown' AS file, CASE event_type WHEN 'click' THEN 'INGREDIENT_LINE' WHEN 'view' THEN 'KNOWLEDGE' ELSE 'OTHER' END AS label, event_id AS start, event_id + event_id % 3 AS "end" FROM events""")
def src_predicted_ranges(spark, sf_dir):
    kind = F.when(F.col("event_type") == "click", "ingredient_line").when(F.col("event_type") == "view", "tip").otherwise("x")
    data = F.struct(F.concat_ws(":", F.lit("urn:x:chunk:y"), "user_id", "event_id").alias("chunk_id"), F.lit("atomic").alias("chunk_level"), kind.alias("chunk_type"), F.struct((F.col("event_id") + F.col("event_id") % 3).alias("start_row"), F.col("event_id").alias("end_row")).alias("location"))
    return reports.predicted_ranges(table(spark, sf_dir, "events").select(F.to_json(F.struct(data.alias("data"))).alias("value")))


@query("src_annotations", """SELECT CAST(user_id AS VARCHAR) AS task, CAST(event_id AS VARCHAR) AS span, event_type AS label, CAST(event_id % 50 AS INTEGER) AS start, CAST(event_id % 50 + 3 AS INTEGER) AS "end" FROM events""")
def src_annotations(spark, sf_dir):
    s = (F.col("event_id") % 50).cast("int")
    result = F.struct(F.col("event_id").cast("string").alias("id"), F.struct(s.alias("start"), (s + 3).alias("end"), F.lit("abc").alias("text"), F.array("event_type").alias("labels")).alias("value"))
    done = F.struct(F.col("user_id").cast("string").alias("id"), F.array(F.struct(F.lit(False).alias("was_cancelled"), F.array(result).alias("result")), F.struct(F.lit(True).alias("was_cancelled"), F.array(result).alias("result"))).alias("annotations"))
    return reports.annotations(table(spark, sf_dir, "events").select(F.to_json(done).alias("value"))).drop("text")


@query("str_progress", "SELECT event_id, CASE WHEN event_id % 3 < 2 THEN event_type END AS stage, CASE WHEN event_id % 3 < 2 THEN CAST(least(event_id, 100) AS INTEGER) END AS current FROM events")
def str_progress(spark, sf_dir):
    body = F.to_json(F.struct(F.lit("stage_progress").alias("type"), F.col("event_type").alias("stage_label"), F.col("event_id").cast("int").alias("task_current"), F.lit(100).alias("task_total")))
    p = reports.progress(F.concat(F.when(F.col("event_id") % 3 < 2, "__stage_progress__ ").otherwise("other "), body))
    return table(spark, sf_dir, "events").select("event_id", p["stage"].alias("stage"), p["current"].alias("current"))


@query("src_sections_markdown", "SELECT o_orderkey, '# ' || o_orderpriority || chr(10) || chr(10) || '## a' || chr(10) || chr(10) || '- ' || o_orderkey || chr(10) || chr(10) || '## b' || chr(10) || chr(10) || '- x' || chr(10) AS md FROM orders")
def src_sections_markdown(spark, sf_dir):
    section = lambda n, x: F.struct(F.lit(n).alias("name"), F.array(x).alias("lines"))
    return orders(spark, sf_dir).select("o_orderkey", reports.sections_markdown(F.col("o_orderpriority"), F.array(section("a", F.col("o_orderkey").cast("string")), section("b", F.lit("x")))).alias("md"))


@query("src_table_markdown", "SELECT o_orderkey, '| k | s |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || o_orderkey || ' | ' || o_orderstatus || ' |' || chr(10) AS md FROM orders")
def src_table_markdown(spark, sf_dir):
    return orders(spark, sf_dir).select("o_orderkey", reports.table_markdown(F.array(F.lit("k"), F.lit("s")), F.array(F.array(F.col("o_orderkey").cast("string"), F.col("o_orderstatus")))).alias("md"))


@query("src_section_rows", "SELECT conv_id, array_to_string(list(role || ':' || t ORDER BY o), ',') AS sections FROM (SELECT conv_id, role, min(turn) AS o, array_to_string(list(turn ORDER BY turn), '.') AS t FROM conversations GROUP BY conv_id, role) GROUP BY conv_id")
def src_section_rows(spark, sf_dir):
    d = table(spark, sf_dir, "conversations").withColumn("t", F.col("turn").cast("string"))
    out = reports.section_rows(d, ["conv_id"], "role", "turn", "t")
    return out.select("conv_id", F.array_join(F.transform("sections", lambda s: F.concat(s["name"], F.lit(":"), F.array_join(s["lines"], "."))), ",").alias("sections"))


@query("src_history_columns", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, '' AS note, coalesce(o_orderstatus, '') AS o_orderstatus FROM orders")
def src_history_columns(spark, sf_dir):
    return records.with_columns(orders(spark, sf_dir), ["o_orderkey", "note", "o_orderstatus"])


@query("src_backfilled", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS s FROM orders")
def src_backfilled(spark, sf_dir):
    o = orders(spark, sf_dir)
    history = o.select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).otherwise(" ").alias("s"))
    return records.backfilled(history, o.filter("o_orderkey % 3 = 0").select("o_orderkey", F.col("o_orderpriority").alias("s")), "o_orderkey")


@query("src_ranges", 'SELECT o_orderkey, o_custkey AS start, o_custkey + 5 AS "end" FROM orders WHERE o_orderkey % 3 > 0')
def src_ranges(spark, sf_dir):
    rows = F.array(F.col("o_custkey") + 5, F.col("o_custkey"))
    d = orders(spark, sf_dir).select("o_orderkey", rows.alias("rows"), F.when(F.col("o_orderkey") % 3 > 0, "L").alias("label"), F.lit("s").alias("src"))
    return records.ranges(d, "rows", "label", "src").select("o_orderkey", "start", "end")


@query("src_mapped_json", "SELECT o_orderkey, o_orderstatus AS status, CAST(NULL AS VARCHAR) AS missing FROM orders")
def src_mapped_json(spark, sf_dir):
    d = orders(spark, sf_dir).select("o_orderkey", F.to_json(F.struct(F.struct(F.col("o_orderstatus").alias("s")).alias("a"))).alias("j"))
    return records.mapped_json(d, "j", {"status": "$.a.s", "missing": "$.b"}).drop("j")


@query("lab_flips", "SELECT event_id, event_type, CASE WHEN event_id % 2 = 0 THEN 'view' ELSE 'click' END AS baseline FROM events WHERE event_type <> CASE WHEN event_id % 2 = 0 THEN 'view' ELSE 'click' END")
def lab_flips(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, F.col("event_id")).alias("k"), "event_type")
    before = e.select("event_id", "k", F.when(F.col("event_id") % 2 == 0, "view").otherwise("click").alias("event_type"))
    return L.flips(e, before, "k", "event_id", "event_type").select("event_id", "event_type", "baseline")


@query("join_released", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 40 AND NOT (l_linenumber % 2 = 0) UNION ALL SELECT -l_orderkey, l_linenumber FROM lineitem x WHERE l_linenumber % 2 = 0 AND NOT EXISTS (SELECT 1 FROM lineitem y WHERE y.l_orderkey = x.l_orderkey AND y.l_linenumber = x.l_linenumber AND y.l_quantity > 40)")
def join_released(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    claims, unknown = M.released(d.filter("l_quantity > 40").drop("l_quantity"), d.filter("l_linenumber % 2 = 0").drop("l_quantity"), "l_orderkey", "l_linenumber")
    return claims.unionByName(unknown.select((-F.col("l_orderkey")).alias("l_orderkey"), "l_linenumber"))


@query("ord_suggestions", "SELECT c_custkey, round(c_acctbal * greatest(0.2, (c_custkey % 10) / 10), 6) AS score FROM customer ORDER BY c_acctbal * greatest(0.2, (c_custkey % 10) / 10) DESC LIMIT 25")
def ord_suggestions(spark, sf_dir):
    d = table(spark, sf_dir, "customer").withColumn("c", F.col("c_custkey") % 10 / 10)
    return Q.suggestion_order(d, "c_acctbal", "c", 25).select("c_custkey", F.round("score", 6).alias("score"))


@query("ord_cost_shards", "SELECT p_partkey, CAST(CASE WHEN p_retailprice < 500 THEN 1 ELSE least(4, p_size, ceil(p_retailprice / 500)) END AS BIGINT) AS n FROM part")
def ord_cost_shards(spark, sf_dir):
    return part(spark, sf_dir).select("p_partkey", O.cost_shards(F.col("p_retailprice"), F.col("p_size"), 500.0, 4).alias("n"))


@query("ord_sweeps", "SELECT * FROM (VALUES ('1', 'x'), ('2', 'x'), ('3', 'x'), ('1', 'y')) t(a, b)")
def ord_sweeps(spark, sf_dir):
    found = list(O.sweeps({"a": "1", "b": "x"}, {"a": ["1", "2", "3"], "b": ["x", "y"]}))
    return spark.createDataFrame([(f["a"], f["b"]) for f in found], "a string, b string")


@query("cmp_weak_coverage", "SELECT * FROM (VALUES ('under 60 % of the rows are compared'), ('under 3 strata are compared')) t(warning)")
def cmp_weak_coverage(spark, sf_dir):
    return spark.createDataFrame([(w,) for w in facade.weak_coverage(100, 50, 3, 2)], "warning string")


@query("dsh_first_metric", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN l_tax WHEN l_linenumber % 3 = 1 THEN l_discount ELSE l_quantity END AS v FROM lineitem")
def dsh_first_metric(spark, sf_dir):
    k = F.col("l_linenumber") % 3
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", Q.first_metric(F.when(k == 0, F.col("l_tax")), F.when(k == 1, F.col("l_discount")), F.col("l_quantity")).alias("v"))


@query("txt_fractions", "SELECT p_partkey, p_size || '/' || (p_size + 1) || ' cup ' || p_type AS t FROM part")
def txt_fractions(spark, sf_dir):
    return part(spark, sf_dir).select("p_partkey", T.spaced_fractions(F.concat("p_size", F.lit(" /  "), (F.col("p_size") + 1).cast("string"), F.lit("  cup\n"), "p_type")).alias("t"))


@query("txt_lemmas", "SELECT * FROM (VALUES ('berries', 'berry'), ('tomatoes', 'tomato'), ('chopping', 'chop'), ('baked', 'bak'), ('dishes', 'dish'), ('carrots', 'carrot'), ('glass', 'glass'), ('egg', 'egg')) t(word, lemma)")
def txt_lemmas(spark, sf_dir):
    d = spark.createDataFrame([(w,) for w in ("berries", "tomatoes", "chopping", "baked", "dishes", "carrots", "glass", "egg")], "word string")
    return d.withColumn("lemma", T.lemma(F.col("word")))


@query("txt_tag_key", "SELECT DISTINCT p_type, trim(regexp_replace(lower(trim(p_type)), '[^a-z0-9]+', '-', 'g'), '-') AS k FROM part")
def txt_tag_key(spark, sf_dir):
    return part(spark, sf_dir).select("p_type").distinct().withColumn("k", T.tag_key(F.concat(F.lit(" "), F.col("p_type"), F.lit("!"))))


@query("txt_line_scores", "SELECT p_partkey, CASE WHEN p_size % 4 + p_size % 3 + p_size % 5 = 0 THEN 'other' WHEN p_partkey % 2 = 0 AND p_size % 4 >= p_size % 3 AND p_size % 4 >= p_size % 5 THEN 'ingredient' WHEN p_size % 3 >= p_size % 5 THEN 'instruction' ELSE 'other' END AS label FROM part")
def txt_line_scores(spark, sf_dir):
    n = F.col("p_size")
    return part(spark, sf_dir).select("p_partkey", T.line_scores(n % 4, n % 3, n % 5, F.col("p_partkey") % 2 == 0)["label"].alias("label"))


@query("txt_tiny_merged", "SELECT p_partkey, 'A long enough first piece tiny|' || p_size || ' is a piece that is long enough too' AS t FROM part")
def txt_tiny_merged(spark, sf_dir):
    pieces = F.array(F.lit("A long enough first piece"), F.lit("tiny"), F.concat("p_size", F.lit(" is a piece that is long enough too")))
    return part(spark, sf_dir).select("p_partkey", F.array_join(T.tiny_merged(pieces), "|").alias("t"))


@query("rec_range_up", "SELECT p_partkey, CAST(ceil((p_size + p_size + p_partkey % 4) / 2.0) AS INTEGER) AS n FROM part")
def rec_range_up(spark, sf_dir):
    return part(spark, sf_dir).select("p_partkey", R.range_up(F.col("p_size"), F.col("p_size") + F.col("p_partkey") % 4).alias("n"))


@query("rec_distinct_tags", "SELECT p_partkey, p_type || '|b c' AS tags FROM part")
def rec_distinct_tags(spark, sf_dir):
    tags = F.array(F.col("p_type"), F.concat(F.lit(" "), F.upper("p_type")), F.lit("b  c"), F.lit("B-C"), F.lit("--"))
    return part(spark, sf_dir).select("p_partkey", F.array_join(R.distinct_tags(tags), "|").alias("tags"))


@query("rec_ingredient_quality", "SELECT p_partkey, round(CASE p_partkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 0.65 + 0.35 / 6 ELSE (1.85 / 2) * 0.65 + 0.35 * 2 / 6 END, 6) AS q FROM part")
def rec_ingredient_quality(spark, sf_dir):
    k = F.col("p_partkey") % 3
    lines = F.when(k == 0, F.array().cast("array<string>")).when(k == 1, F.array(F.lit("2 cups flour"))).otherwise(F.array(F.lit("2 cups flour"), F.lit("3 eggs")))
    return part(spark, sf_dir).select("p_partkey", F.round(R.ingredient_quality(lines), 6).alias("q"))


@query("rec_instruction_quality", "SELECT p_partkey, round(CASE p_partkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 0.7 + 0.3 / 5 ELSE (1.8 / 2) * 0.7 + 0.3 * 2 / 5 END, 6) AS q FROM part")
def rec_instruction_quality(spark, sf_dir):
    k = F.col("p_partkey") % 3
    lines = F.when(k == 0, F.array().cast("array<string>")).when(k == 1, F.array(F.lit("Mix it."))).otherwise(F.array(F.lit("Mix it."), F.lit("Bake it")))
    return part(spark, sf_dir).select("p_partkey", F.round(R.instruction_quality(lines), 6).alias("q"))


@query("rec_gate", "SELECT p_partkey, CASE WHEN p_size < 18 THEN 'reject' WHEN p_size < 28 OR p_partkey % 2 = 0 THEN 'keep_partial' ELSE 'keep_full' END AS gate FROM part")
def rec_gate(spark, sf_dir):
    some, none = F.array(F.lit("x")), F.array().cast("array<string>")
    g = R.gate(R.tier(F.col("p_size") / 50), F.when(F.col("p_partkey") % 2 == 0, none).otherwise(some), some)
    return part(spark, sf_dir).select("p_partkey", g.alias("gate"))


@query("rec_likeness", "SELECT count(*) AS n, true AS within, true AS recipes_score_more FROM part")
def rec_likeness(spark, sf_dir):
    none = F.array().cast("array<string>")
    good = R.likeness(F.col("p_name"), F.array(F.lit("2 cups flour"), F.lit("1 tsp salt"), F.lit("3 eggs")), F.array(F.lit("Mix it."), F.lit("Bake it well.")), F.lit(True), F.lit("A pie."), F.lit(True), F.lit(True))
    bad = R.likeness(F.lit("untitled"), none, none, F.lit(False), F.lit(None).cast("string"), F.lit(False), F.lit(False))
    d = part(spark, sf_dir).select(good.alias("g"), bad.alias("b"))
    return d.agg(F.count("*").alias("n"), F.min((F.col("g") <= 1) & (F.col("b") >= 0)).alias("within"), F.min(F.col("g") > F.col("b") + 0.5).alias("recipes_score_more"))


@query("rec_instructions", "SELECT p_partkey, CAST(p_size * 60 + 7200 AS BIGINT) AS seconds, CAST(greatest(p_size * 60, 7200) AS BIGINT) AS longest FROM part")
def rec_instructions(spark, sf_dir):
    text = F.concat(F.lit("Bake for "), "p_size", F.lit(" minutes, then rest for 2 hours."))
    return part(spark, sf_dir).select("p_partkey", R.total_seconds(text).alias("seconds"), R.total_seconds(text, "max").alias("longest"))


@query("row_tags", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'yield_prefix' WHEN 1 THEN 'ingredient_like' WHEN 2 THEN 'instruction_like,instruction_with_time' ELSE 'note_prefix' END AS tags FROM part")
def row_tags(spark, sf_dir):
    k, n = F.col("p_partkey") % 4, F.col("p_size").cast("string")
    text = F.when(k == 0, F.concat(F.lit("Serves "), n)).when(k == 1, F.concat(n, F.lit(" cups flour"))).when(k == 2, F.concat(F.lit("Bake for "), n, F.lit(" minutes."))).otherwise(F.concat(F.lit("Note: rest it "), n))
    return part(spark, sf_dir).select("p_partkey", F.array_join(W.rule_tags(text), ",").alias("tags"))
