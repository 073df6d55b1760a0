"""Ingredient lines, steps, lanes, tips and tags over lines made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.functions import ingredients as I
from larder.operators import knowledge as K
from larder.operators import layout as Y
from larder.operators import steps as S
from larder.plans.registry import query
from larder.plans.tables import table

LINE = "CASE p_partkey % 5 WHEN 0 THEN p_size || ' cups ' || p_type || ', chopped' WHEN 1 THEN p_size || ' 1/2 tbsp ' || p_type WHEN 2 THEN p_size || '-' || (p_size + 4) || ' lbs. ' || p_type || ' (ripe)' WHEN 3 THEN p_type || ', to taste' ELSE 'For the ' || p_type || ':' END"


def ingredient_lines(spark, sf_dir):
    k, n, t = F.col("p_partkey") % 5, F.col("p_size").cast("string"), F.col("p_type")
    line = F.when(k == 0, F.concat(n, F.lit(" cups "), t, F.lit(", chopped"))).when(k == 1, F.concat(n, F.lit(" 1/2 tbsp "), t)).when(k == 2, F.concat(n, F.lit("-"), (F.col("p_size") + 4).cast("string"), F.lit(" lbs. "), t, F.lit(" (ripe)"))).when(k == 3, F.concat(t, F.lit(", to taste"))).otherwise(F.concat(F.lit("For the "), t, F.lit(":")))
    return table(spark, sf_dir, "part").select("p_partkey", line.alias("line"))


@query(
    "ing_parsed",
    """SELECT p_partkey, CASE p_partkey % 5 WHEN 3 THEN 'approximate' WHEN 4 THEN 'header' ELSE 'exact' END AS kind, CAST(CASE p_partkey % 5 WHEN 0 THEN p_size WHEN 1 THEN p_size + 0.5 WHEN 2 THEN p_size + 2 END AS DOUBLE) AS quantity, CASE p_partkey % 5 WHEN 0 THEN 'cup' WHEN 1 THEN 'tablespoon' WHEN 2 THEN 'pound' END AS unit,
    CASE p_partkey % 5 WHEN 4 THEN 'For the ' || p_type ELSE p_type END AS name, CASE p_partkey % 5 WHEN 0 THEN 'chopped' END AS preparation, CASE p_partkey % 5 WHEN 2 THEN 'ripe' WHEN 3 THEN 'to taste' END AS note FROM part""",
)
def ing_parsed(spark, sf_dir):
    return ingredient_lines(spark, sf_dir).withColumn("i", I.ingredient(F.col("line"))).select("p_partkey", *(F.col(f"i.{c}").alias(c) for c in ("kind", "quantity", "unit", "name", "preparation", "note")))


@query("ing_packaging", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_size || ' can ' || p_type ELSE p_size || ' tin ' || p_type END AS text, CASE WHEN p_partkey % 2 = 0 THEN 'pkg: ' || p_partkey || ' oz' ELSE 'pkg: ' || p_partkey || 'g' END AS note FROM part")
def ing_packaging(spark, sf_dir):
    n, k = F.col("p_size").cast("string"), F.col("p_partkey").cast("string")
    line = F.when(F.col("p_partkey") % 2 == 0, F.concat(n, F.lit(" ("), k, F.lit(" oz) cans "), F.col("p_type"))).otherwise(F.concat(n, F.lit(" x "), k, F.lit("g tins "), F.col("p_type")))
    return table(spark, sf_dir, "part").withColumn("p", I.packaging(line)).select("p_partkey", "p.text", "p.note")


_FORMS = ", ".join(f"('{form}', '{full}')" for full, forms in I.UNIT_NAMES.items() for form in forms)


@query("ing_units", f"SELECT u AS unit, coalesce(n, u) AS name FROM (VALUES {', '.join(f'({chr(39)}{f}{chr(39)})' for fs in I.UNIT_NAMES.values() for f in fs)}, ('furlong'), ('cans')) t(u) LEFT JOIN (VALUES {_FORMS}) f(u2, n) ON u = u2")
def ing_units(spark, sf_dir):
    d = spark.createDataFrame([(f,) for fs in I.UNIT_NAMES.values() for f in fs] + [("furlong",), ("cans",)], "unit string")
    return d.withColumn("name", I.unit_name(F.col("unit")))


@query("ing_yields", """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'Serves ' || (o_custkey % 9 + 1) WHEN 1 THEN 'makes ' || (o_custkey % 7 + 1) || ' dozen' WHEN 2 THEN 'about ' || (o_custkey % 5 + 2) END AS phrase, CASE o_orderkey % 4 WHEN 0 THEN 'description' WHEN 1 THEN 'instruction' WHEN 2 THEN 'yield' END AS place,
CAST(CASE o_orderkey % 4 WHEN 0 THEN o_custkey % 9 + 1 WHEN 1 THEN (o_custkey % 7 + 1) * 12 WHEN 2 THEN o_custkey % 5 + 2 ELSE 1 END AS INTEGER) AS units FROM orders""")
def ing_yields(spark, sf_dir):
    k, c = F.col("o_orderkey") % 4, F.col("o_custkey")
    text = lambda a, n, b="": F.concat(F.lit(a), n.cast("string"), F.lit(b))
    y = I.yield_fields(F.when(k == 2, text("about ", c % 5 + 2)), F.when(k == 0, text("A pie.\nServes ", c % 9 + 1)), F.array(F.lit("Mix."), F.when(k == 1, text("makes ", c % 7 + 1, " dozen")).otherwise("Bake.")), F.array().cast("array<string>"))
    return table(spark, sf_dir, "orders").select("o_orderkey", y["phrase"].alias("phrase"), y["place"].alias("place"), y["units"].alias("units"))


NAMED = "SELECT conv_id, turn AS item, list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda t: t <> '')[1] AS name FROM conversations"


@query("step_mentions", f"""WITH n AS (SELECT * FROM ({NAMED}) WHERE name IS NOT NULL AND name NOT IN ({', '.join(repr(w) for w in S.GENERIC)})), w AS (SELECT conv_id, turn, list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda t: t <> '') AS w FROM conversations)
SELECT w.conv_id, turn, item, name AS alias, CAST(list_position(w, name) AS INTEGER) AS at FROM w JOIN n USING (conv_id) WHERE list_contains(w, name)""")
def step_mentions(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    items = c.select("conv_id", F.col("turn").alias("item"), F.get(S.tokens(F.col("text")), 0).alias("name"))
    found = S.mentions(c, S.aliases(items, ["conv_id"], "item", "name"), ["conv_id"], "turn", "text", "item", most_words=1)
    return found.select("conv_id", "turn", "item", F.array_join("alias", " ").alias("alias"), "at")


@query("step_scores", "SELECT p_partkey, round(CASE WHEN p_size % 2 = 0 THEN 200 + length(p_brand) + length(p_type) ELSE 100 + length(p_brand) END + (p_size % 3) * 10 + (p_size % 5) * 5 - 5 + 50.0 * (p_partkey % 4) / 4 + CASE WHEN p_size % 2 = 0 THEN 5 ELSE 0 END - p_size * 0.1, 6) AS score FROM part")
def step_scores(spark, sf_dir):
    n = F.col("p_size")
    alias = F.when(n % 2 == 0, F.array("p_brand", "p_type")).otherwise(F.array("p_brand"))
    score = S.mention_score(alias, n % 3, (n % 5) * 5.0 - 5, (F.col("p_partkey") % 4) / 4, n)
    return table(spark, sf_dir, "part").select("p_partkey", F.round(score, 6).alias("score"))


@query("step_shares", """WITH u AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 AND l_linenumber % 2 = 0 THEN 0.1 WHEN l_orderkey % 3 = 0 THEN -1 WHEN l_orderkey % 3 = 1 AND l_linenumber = 1 THEN 0.25 END AS s FROM lineitem),
g AS (SELECT l_orderkey, count(*) AS n, count(s) AS k, count(*) FILTER (s < 0) AS r, 1 - coalesce(sum(s) FILTER (s >= 0), 0) AS rest FROM u GROUP BY l_orderkey)
SELECT l_orderkey, l_linenumber, round(CASE WHEN n < 2 OR k = 0 THEN NULL WHEN k < n THEN 1.0 / n WHEN s < 0 THEN rest / r ELSE s END, 6) AS part FROM u JOIN g USING (l_orderkey)""")
def step_shares(spark, sf_dir):
    k, i = F.col("l_orderkey") % 3, F.col("l_linenumber")
    d = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when((k == 0) & (i % 2 == 0), 0.1).when(k == 0, -1.0).when((k == 1) & (i == 1), 0.25).alias("s"))
    return S.shares(d, ["l_orderkey"], "s").select("l_orderkey", "l_linenumber", F.round("part", 6).alias("part"))


@query("step_segmented")
def step_segmented(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("s", F.split("text", "\n"))
    return d.select("doc_id", S.needs_splitting(F.col("s")).alias("needs"), F.size(S.segmented(F.col("s"))).alias("n"))


def _scored(table_: dict[str, tuple[float, float]], scale: str) -> str:
    return " + ".join(f"least({cap}, len(regexp_extract_all(text, '(?i){p}')) * {w} * {scale})" for p, (w, cap) in table_.items())


_C = K.Lanes()
_SCALE = "500.0 / greatest(length(text), 1)"
_ANY = "len(regexp_extract_all(text, '(?i){0}')) > 0"


@query(
    "know_scores",
    f"""SELECT doc_id, round(greatest(0, least(1, {_scored(_C.knowledge, _SCALE)} - CASE WHEN {_ANY.format(chr(92) + 'bi' + chr(92) + 'b')} THEN 0.1 ELSE 0 END - CASE WHEN {_ANY.format(_C.anecdote)} THEN 0.15 ELSE 0 END)), 6) AS k,
    round(greatest(0, least(1, {_scored(_C.narrative, _SCALE)} + CASE WHEN {_ANY.format(_C.anecdote)} THEN 0.3 ELSE 0 END - CASE WHEN {_ANY.format(_C.mechanism)} THEN 0.15 ELSE 0 END)), 6) AS n FROM (SELECT doc_id, regexp_replace(text, '[^\\x00-\\x7F]', 'x', 'g') AS text FROM documents)""",
)
def know_scores(spark, sf_dir):
    x = F.regexp_replace("text", r"[^\x00-\x7F]", "x")  # the engines differ in where words of other letters end
    return table(spark, sf_dir, "documents").select("doc_id", F.round(K.knowledge_score(x), 6).alias("k"), F.round(K.narrative_score(x), 6).alias("n"))


_FIRST = "regexp_replace(lower(trim(string_split(text, chr(10))[1])), '\\s*:+$', '')"
_TITLES = "CASE WHEN {0} IN ({1}) THEN {2} ELSE 0 END"


@query(
    "know_noise",
    f"""SELECT doc_id, round(greatest(0, least(1, 0.0::DOUBLE + {_scored(_C.noise, '1.0')} + {_TITLES.format(_FIRST, ', '.join(repr(t) for t in _C.front_titles), 0.3)} + {_TITLES.format(_FIRST, ', '.join(repr(t) for t in _C.navigation_titles), 0.85)} + CASE WHEN {_ANY.format(_C.marketing)} THEN 0.45 ELSE 0 END
    + CASE WHEN q > 0.5 THEN 0.3 ELSE 0 END + CASE WHEN length(text) < 300 AND {_ANY.format(next(iter(_C.noise)))} AND NOT ({_ANY.format(next(iter(_C.knowledge)))}) THEN 0.2 ELSE 0 END)), 6) AS s
    FROM (SELECT *, len(list_filter(l, lambda v: regexp_matches(v, '^["“].*["”]$'))) / greatest(len(l), 1) AS q FROM (SELECT *, list_filter(list_transform(string_split(text, chr(10)), lambda v: trim(v)), lambda v: v <> '') AS l FROM documents))""",
)
def know_noise(spark, sf_dir):
    x = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.round(K.noise_score(x, F.get(F.split(x, "\n"), 0)), 6).alias("s"))


@query("know_tags", "WITH t(category, term) AS (VALUES ('a', 'the'), ('a', 'of the'), ('b', 'License'), ('b', 'no such term')), w AS (SELECT doc_id, ' ' || array_to_string(list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> ''), ' ') || ' ' AS w FROM documents) SELECT doc_id, category, array_to_string(list_sort(list_distinct(list(term))), ',') AS tags FROM w JOIN t ON contains(w, ' ' || lower(term) || ' ') GROUP BY ALL")
def know_tags(spark, sf_dir):
    taxonomy = spark.createDataFrame([("a", "the"), ("a", "of the"), ("b", "License"), ("b", "no such term")], "category string, term string")
    return K.tagged(table(spark, sf_dir, "documents"), ["doc_id"], F.col("text"), taxonomy).withColumn("tags", F.array_join("tags", ","))


@query("know_topic_key", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN lower(lang) || ' > ' || lower(source) WHEN doc_id % 3 = 1 THEN CASE WHEN lang < source THEN lang || ',' || source ELSE source || ',' || lang END END AS topic FROM documents")
def know_topic_key(spark, sf_dir):
    k = F.col("doc_id") % 3
    heads = F.when(k == 0, F.array(F.upper("lang"), F.lit(" "), F.upper("source")))
    tags = F.when(k == 1, F.array("lang", "source", "lang"))
    return table(spark, sf_dir, "documents").select("doc_id", K.topic_key(heads, tags).alias("topic"))


@query("know_lanes")
def know_lanes(spark, sf_dir):
    x = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", K.lane(x, F.get(F.split(x, "\n"), 0), F.lit(False)).alias("lane"))


@query("know_tips")
def know_tips(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return K.tips(d, ["doc_id"], "text", F.col("source"), F.array("lang")).select("doc_id", "tip", "scope", "standalone", F.round("tipness", 6).alias("tipness"), F.round("generality", 6).alias("generality"))


@query("know_containers")
def know_containers(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").withColumns({"w": F.size(F.split("text", " ")), "a": F.slice(S.tokens(F.col("text")), 1, 3), "h": F.col("turn") % 5 == 0})
    return K.topic_containers(c, ["conv_id"], "turn", "w", "a", "h")


@query("know_chunks")
def know_chunks(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "t"))
    return K.knowledge_chunks(d.filter(F.trim("t") != ""), ["doc_id"], "line", "t").select("doc_id", "chunk", "start", "end", "lane", "n")


@query("lay_headers", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'divider' WHEN p_partkey % 3 = 1 THEN 'first row' END AS why, CASE WHEN p_partkey % 3 < 2 THEN p_type || ',Name' END AS headers FROM part")
def lay_headers(spark, sf_dir):
    k = F.col("p_partkey") % 3
    h = Y.with_headers(F.array("p_type", F.lit("Name")), F.array(F.when(k == 1, F.col("p_size").cast("string")).otherwise("none"), F.lit("x")), k == 0)
    return table(spark, sf_dir, "part").select("p_partkey", h["why"].alias("why"), F.array_join(h["headers"], ",").alias("headers"))


@query("lay_flattened", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_size || '=' || (p_size + 1) END AS first, CASE WHEN p_partkey % 2 = 0 THEN 3 END AS n FROM part")
def lay_flattened(spark, sf_dir):
    n = F.col("p_size")
    values = F.concat_ws(" ", n, n + 1, F.lit("350 175 400 205"))
    t = Y.flattened_table(F.concat(F.lit("Oven Gas "), values, F.when(F.col("p_partkey") % 2 == 1, " 7").otherwise("")))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(t["rows"][0], "=").alias("first"), F.nullif(F.size(t["rows"]), F.lit(-1)).alias("n"))
