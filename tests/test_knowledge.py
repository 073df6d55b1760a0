"""Lanes, tips, tags, topics and tables on hand-made rows."""

from pyspark.sql import functions as F

from larder.functions.cues import wider
from larder.operators import knowledge as K
from larder.operators import layout as Y


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["v"] for r in df.select("i", expression(F.col("x")).alias("v")).orderBy("i").collect()]


def test_lanes(spark):
    texts = [
        ("Use cold butter because it keeps the dough firm. If it is too warm, add ice. You should let it rest 20 minutes.", None, "knowledge"), ("When I was young my grandmother cooked. I remember my favorite days. We loved my home.", None, "noise"),
        ("Praise for this book: a brilliant, stunning cookbook by an award-winning author.", None, "noise"), ("Soups 12 Sauces 40", "Contents:", "noise"), ("plain", None, "knowledge"),
    ]
    df = spark.createDataFrame([(a, b) for a, b, _ in texts], "t string, h string")
    assert [r[0] for r in df.select(K.lane(F.col("t"), F.col("h"), F.lit(False))).collect()] == [w for *_, w in texts]
    assert df.select(K.lane(F.col("t"), F.col("h"), F.lit(True))).first()[0] == "knowledge"
    roles = {"ingredient_line": F.lit(4), "other": F.lit(0)}
    assert df.filter("t = 'plain'").select(K.lane(F.col("t"), F.col("h"), F.lit(False), roles)).first()[0] == "knowledge"


def test_tips(spark):
    text = "Tip: always rest the dough because it prevents shrinking. My aunt lived by the sea and we walked. Use this recipe's butter cold so that the pie keeps its shape. See page 12 for more of it. 2 cups flour."
    df = spark.createDataFrame([(1, text, "Butter Pie", ["butter"])], "d int, t string, n string, i array<string>")
    rows = K.tips(df, ["d"], "t", F.col("n"), F.col("i")).orderBy("tip").collect()
    assert [r["scope"] for r in rows] == ["general", "not_tip", "recipe_specific", "not_tip", "not_tip"] and rows[0]["standalone"] and rows[0]["tipness"] > 0.9
    general, specific, rest = K.partitioned_tips(K.tips(df, ["d"], "t", F.col("n"), F.col("i")))
    assert (general.count(), specific.count(), rest.count()) == (1, 1, 3)
    assert column(spark, ["", None], K.tipness) == [0.0, 0.0]
    found = K.highlights(df.withColumn("lane", F.lit("knowledge")), ["d"], "t", "lane").first()
    assert found["n"] == 2 and found["highlights"][0]["self_contained"] and abs(found["density"] - 2 / (len(text) / 1000)) < 1e-9


def test_tags_and_topics(spark):
    taxonomy = spark.createDataFrame([("meat", "Beef"), ("dairy", "sour cream"), ("dairy", "cream"), ("meat", "ham")], "category string, term string")
    df = spark.createDataFrame([(1, "BEEF with sour cream, no hamster"), (2, "nothing")], "d int, t string")
    assert sorted((r["d"], r["category"], r["tags"]) for r in K.tagged(df, ["d"], F.col("t"), taxonomy).collect()) == [(1, "dairy", ["cream", "sour cream"]), (1, "meat", ["Beef"])]
    rows = spark.createDataFrame([(["Soups", " "], ["b"]), (None, ["b", "a", "b"]), ([], None)], "h array<string>, g array<string>")
    assert [r[0] for r in rows.select(K.topic_key(F.col("h"), F.col("g"))).collect()] == ["soups", "a,b", None]


def test_containers_and_bridges(spark):
    blocks = [(0, 3, ["a"], True), (1, 10, ["a", "b"], False), (2, 10, [], False), (3, 10, ["c"], False), (4, 30, [], False), (5, 5, ["d"], False), (6, 2, None, True)]
    df = spark.createDataFrame([("x", *b) for b in blocks], "k string, o int, w int, a array<string>, h boolean")
    assert [r["container"] for r in K.topic_containers(df, ["k"], "o", "w", "a", "h").orderBy("o").collect()] == [0, 0, 0, 1, 2, 2, 3]
    chunks = [(0, 0, 0, "A Heading", False), (1, 1, 1, "Another:", False), (2, 2, 4, "A long sentence that says something of use.", False), (3, 6, 6, "Far Heading", False), (4, 9, 9, "text.", False), (5, 10, 10, "Table Head", False), (6, 11, 12, "x", True)]
    df = spark.createDataFrame([("x", *c) for c in chunks], "k string, o int, s int, e int, t string, tab boolean")
    assert [r["merged"] for r in K.bridged(df, ["k"], "o", "s", "e", "t", "tab").orderBy("o").collect()] == [0, 0, 0, 1, 2, 3, 4]


def test_chunks_of_knowledge(spark):
    texts = ["Resting Dough", "Always rest the dough because it prevents shrinking and keeps it soft.", "More text follows here.", "Other Matter", "When I was young my grandmother cooked and I remember my days."]
    df = spark.createDataFrame([("b", i, t) for i, t in enumerate(texts)], "k string, o int, t string")
    got = K.knowledge_chunks(df, ["k"], "o", "t").orderBy("start").collect()
    assert [(r["start"], r["end"], r["lane"]) for r in got] == [(0, 2, "knowledge"), (3, 4, "noise")] and got[0]["n"] == 1


def test_chunks_move_once_and_judge_once(spark):
    """Blocks are shuffled once, without joins, and no pattern of lanes is worked out again for a filter or a later column."""
    df = spark.createDataFrame([("b", 0, "x")], "k string, o int, t string")
    plan = K.knowledge_chunks(df, ["k"], "o", "t").select("k", "chunk", "lane", "n")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
    assert plan.count("bestselling") == 1 and plan.count("favou?rite") == 1 and plan.count("prevents?|allows?") <= 3


def test_cues_of_chunks_beside_other_letters(spark):
    """What RE2 may overlook or find too often doesn't change lanes and tips."""
    texts = ["Élan: my\u00a0mother ¡i remember! «my» “love” we love our days, I\u2028love", "Tip —\trest\x0bit so\n that it works\x0b well, because\r\nit must.", "émy élove müse", "\u212aeep it cool. You should\n \n always keep it cold instead.", None]
    df = spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "k int, o int, t string")
    got = {r["k"]: r for r in K.knowledge_chunks(df, ["k"], "o", "t").collect()}
    assert len(got) == 5
    judged = df.select("k", F.coalesce("t", F.lit("")).alias("t")).withColumn("lane", K.lane(F.col("t"), F.lit(None).cast("string"), F.lit(False)))
    tips = {r["k"]: r["n"] for r in K.tips(judged.filter("lane = 'knowledge'"), ["k"], "t", F.lit(""), F.array().cast("array<string>")).filter("scope <> 'not_tip'").groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert {k: (r["lane"], r["n"]) for k, r in got.items()} == {r["k"]: (r["lane"], tips.get(r["k"], 0)) for r in judged.collect()}
    assert got[0]["lane"] == "noise" and got[1]["n"] == 1 and got[3]["n"] == 1
    c = K.Lanes(marketing=r"(?<=for )sale(?=!)", noise={r"\bnew\b": (0.3, 0.3)})
    rows = spark.createDataFrame([(0, 0, "new: for sale!"), (1, 0, "new: for sale")], "k int, o int, t string")
    assert [r["lane"] for r in K.knowledge_chunks(rows, ["k"], "o", "t", c=c).orderBy("k").collect()] == ["noise", "knowledge"]


def test_wider_patterns():
    """Boundaries stay only beside letters of the pattern; what isn't sure to be wider has no form."""
    assert wider(r"^(?:use|so that)\b") == r"(?:use|so[\s\x0B]+that)\b" and wider(r"\b(?:if (?:it|the).{1,40}not|a?b)\b") == r"(?:if[\s\x0B]+(?:it|the)(?s:.*)not|a?b)\b"
    assert wider(r"\b°|x\b°") == r"°|x\b°" and wider(r"(?:a|-)\b") == "(?:a|-)" and wider(r"\b\d+\s*(?:°|hours?)\b") == r"\b\d+[\s\x0B]*(?:°|hours?)"
    assert [wider(p) for p in (r"(?<=a)b", "a$", r"[^a]b", r"a\wb", "a+", r"[ a]b", "a{2}", r"(a)\1")] == [None] * 8


def test_headers_and_flattened_tables(spark):
    df = spark.createDataFrame([(["Cut", ""], ["2", "3"], False), (["a", "b"], ["c", "d"], True), (["a", "b"], ["c", "d"], False)], "a array<string>, b array<string>, d boolean")
    got = [r[0] for r in df.select(Y.with_headers(F.col("a"), F.col("b"), F.col("d"))).collect()]
    assert [(r["headers"], r["why"]) for r in got] == [(None, None), (["a", "b"], "divider"), (None, None)]
    texts = ["Fahrenheit Celsius 300 150 350 175 400 205", "Cup size Grams used 1 cup 200 g 2 cups 400 g 3 cups 600 g", "no table 1 2", "A B 1 2 3 4 5"]
    got = column(spark, texts, Y.flattened_table)
    assert got[0]["headers"] == ["Fahrenheit", "Celsius"] and got[0]["rows"][1] == ["350", "175"] and got[1]["headers"] == ["Cup size", "Grams used"] and got[1]["rows"][2] == ["3 cups", "600 g"] and got[2] is None and got[3] is None


def test_ingredients_work_out_each_part_once(spark):
    """What several fields are made of isn't copied to each of them: the plan of a line stays small."""
    from larder.functions.ingredients import ingredient

    df = spark.createDataFrame([("2-4 large eggs (beaten), sifted",), (None,), ("1 1/2 tbsp. of oil, to taste",)], "t string").select(ingredient(F.col("t"), with_packaging=True).alias("i"))
    assert df._jdf.queryExecution().analyzed().toString().lower().count("regexp_replace") < 60
    got = [(r["i"]["kind"], r["i"]["quantity"], r["i"]["unit"], r["i"]["name"], r["i"]["preparation"], r["i"]["note"]) for r in df.collect()]
    assert got == [("exact", 3.0, None, "eggs", "sifted", "beaten; large"), ("empty", None, None, None, None, None), ("exact", 1.5, "tablespoon", "oil", None, "to taste")]
