"""Recipe expressions on hand-made lines."""

import pytest
from pyspark.sql import functions as F

from larder.functions import recipes as R


def values(spark, texts, expression, kind="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, t {kind}")
    return [r["v"] for r in df.select("i", expression(F.col("t")).alias("v")).orderBy("i").collect()]


def test_times_and_heat(spark):
    texts = ["Bake 30 to 40 minutes, rest 1 hr and 5-6 secs", "no time 5", "2 days", None]
    assert values(spark, texts, R.durations) == [[2100, 3600, 5], [], [172800], None]
    assert values(spark, texts, lambda t: R.total_seconds(t, "max")) == [3600, None, 172800, None]
    assert values(spark, ["at 350°F or 180 C", "375 degrees fahrenheit", "100 pans"], R.temperatures_celsius) == [[177.0, 180.0], [191.0], []]


def test_servings(spark):
    assert values(spark, ["Serves 4-6", "2 dozen cookies", "a dozen", "makes six", "serves 2.5", "none", "0", None], R.servings) == [5, 24, 12, 6, 3, None, None, None]


def test_line_kinds(spark):
    lines = ["", "Serves four", "Prep time: 10 min", "For the sauce", "Note: keep cold", "2 cups flour", "½ tsp salt", "3 eggs", "1. Mix all.", "Stir well.", "Once upon a time there was a cook."]
    assert values(spark, lines, R.line_kind) == ["blank", "yield", "time", "heading", "note", "ingredient", "ingredient", "ingredient", "numbered", "instruction", "prose"]


def test_cells_and_tags(spark):
    assert values(spark, ["| a | b |", "a\tb\tc", "a  b", "---|---", "plain words"], R.row_cells) == [["a", "b"], ["a", "b", "c"], ["a", "b"], None, None]
    assert values(spark, [["Main dish", "main-dish", " Soup ", "!"], []], R.distinct_tags, "array<string>") == [["Main dish", "Soup"], []]


def test_likeness_and_gate(spark):
    rows = [
        (1, "Apple pie", ["2 cups flour", "3 apples", "1 tsp salt", "1 cup sugar", "2 eggs", "1 stick butter"], ["Mix the flour and salt well.", "Add the apples.", "Bake for 40 minutes.", "Cool for an hour.", "Serve with cream."], True, "Good", True, True),
        (2, "", [], [], False, None, False, False),
        (3, "Notes on salt", [], ["A long text about salt and how people came to use it everywhere."], False, None, False, False),
    ]
    df = spark.createDataFrame(rows, "i int, t string, a array<string>, b array<string>, y boolean, d string, s boolean, h boolean")
    score = R.likeness(*(F.col(c) for c in "tabydsh"))
    got = df.select("i", score.alias("score")).withColumn("tier", R.tier(F.col("score"))).join(df, "i").withColumn("gate", R.gate(F.col("tier"), F.col("a"), F.col("b"))).orderBy("i").collect()
    assert got[0]["tier"] == "gold" and got[0]["gate"] == "keep_full" and got[0]["score"] == pytest.approx(0.2 + 0.31 * (0.95 * 0.65 + 0.35) + 0.31 + 0.08 * (6 / 11 / 0.6 * 0.5 + 5 / 11 / 0.6 * 0.5) + 0.06 + 0.04)
    assert got[1]["gate"] == "reject" and got[2]["gate"] in ("reject", "keep_partial")


def test_words_and_fragments(spark):
    from larder.functions import text as T

    words = ["Berries", "potatoes", "chopping", "mixed", "dishes", "eggs", "glass", "pie", "baked"]
    assert values(spark, words, T.lemma) == ["berry", "potato", "chop", "mix", "dish", "egg", "glass", "pie", "bak"]
    parts = [["Mix.", "Then bake the whole thing slowly.", "Cool.", "Serve it with plenty of cream."], ["A long first fragment here.", "ok"], []]
    assert values(spark, parts, T.tiny_merged, "array<string>") == [["Mix. Then bake the whole thing slowly. Cool.", "Serve it with plenty of cream."], ["A long first fragment here. ok"], []]
    df = spark.createDataFrame([(1.0, 1.0, 0.0, True), (1.0, 1.0, 2.0, False), (0.0, 0.0, 0.0, True)], "a double, b double, c double, f boolean")
    got = [tuple(r["v"]) for r in df.select(T.line_scores(*map(F.col, "abcf")).alias("v")).collect()]
    assert got == [("ingredient", 0.5), ("other", 0.5), ("other", 1.0)]
