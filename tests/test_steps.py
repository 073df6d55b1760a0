"""Ingredient lines, yields, steps and their links on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from larder.functions import ingredients as I
from larder.operators import steps as S


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["v"] for r in df.select("i", expression(F.col("x")).alias("v")).orderBy("i").collect()]


def test_ingredient_lines(spark):
    got = column(spark, ["1 1/2 cups all-purpose flour, sifted", "2-3 tbsp olive oil", "½ tsp salt (optional)", "salt, to taste", "For the crust:", "3 large eggs", "2 cloves of garlic, minced", "1½ lb. beef", "butter", "", None, "4 (14 oz) cans beans", "2 to 4 cups milk or cream"], I.ingredient)
    pick = lambda r: (r["kind"], r["quantity"], r["unit"], r["name"], r["preparation"], r["note"], r["optional"])
    assert [pick(r) for r in got] == [
        ("exact", 1.5, "cup", "all-purpose flour", "sifted", None, False),
        ("exact", 3.0, "tablespoon", "olive oil", None, None, False),
        ("exact", 0.5, "teaspoon", "salt", None, None, True),
        ("approximate", None, None, "salt", None, "to taste", False),
        ("header", None, None, "For the crust", None, None, None),
        ("exact", 3.0, None, "eggs", None, "large", False),
        ("exact", 2.0, "cloves", "garlic", "minced", None, False),
        ("exact", 1.5, "pound", "beef", None, None, False),
        ("unquantified", None, None, "butter", None, None, False),
        ("empty", None, None, None, None, None, None),
        ("empty", None, None, None, None, None, None),
        ("exact", 4.0, "cans", "beans", None, "14 oz", False),
        ("exact", 3.0, "cup", "milk or cream", None, None, False),
    ]


def test_packaging_and_units(spark):
    assert column(spark, ["2 (14 oz) cans beans", "2 x 400g tins tomatoes", "1 cup milk"], I.packaging) == [("2 can beans", "pkg: 14 oz"), ("2 tin tomatoes", "pkg: 400g"), ("1 cup milk", None)]
    assert column(spark, ["Tbsp.", "cans", "lbs", "furlong"], I.unit_name) == ["tablespoon", "cans", "pound", "furlong"]
    assert column(spark, ["1 1/2", "3/4", "2.5", "x", "1/0"], I.number) == [1.5, 0.75, 2.5, None, None]


def test_yields(spark):
    df = spark.createDataFrame([("6 servings", "Serves 8 people", ["Makes 4"], ["x"]), (None, "A pie.\nServes 8", ["Mix"], None), (None, None, None, ["yields 2 dozen"]), ("200 calories", None, [], []), (None, None, None, None)], "y string, d string, s array<string>, c array<string>")
    got = [r[0] for r in df.select(I.yield_fields(*map(F.col, "ydsc"))).collect()]
    assert [(r["phrase"], r["place"], r["units"]) for r in got] == [("6 servings", "yield", 6), ("Serves 8", "description", 8), ("yields 2 dozen", "comment", 24), ("200 calories", "yield", 200), (None, None, 1)]


def test_steps_are_split_where_they_run_on(spark):
    steps = [["1. Heat the oil in a pan. 2. Add the onions and cook. 3. Serve it at once."], ["Mix.", "Bake it."], ["Heat the oil well first. Then add the onions to it slowly. Finally season everything and serve it hot."], [], None]
    assert column(spark, steps, S.needs_splitting, "array<string>") == [True, False, True, False, False]
    got = column(spark, steps, S.segmented, "array<string>")
    assert got[0] == ["Heat the oil in a pan.", "Add the onions and cook.", "Serve it at once."] and got[1] == ["Mix.", "Bake it."] and len(got[2]) == 3 and got[3] == [] and got[4] == []
    assert column(spark, steps[:1], lambda s: S.segmented(s, "off"), "array<string>")[0] == steps[0]
    with pytest.raises(ValueError):
        S.segmented(F.col("x"), "sometimes")


def test_ingredients_find_their_steps(spark):
    steps = spark.createDataFrame([("r", i, t) for i, t in enumerate(["Cream half the butter with the brown sugar.", "Add the remaining butter and the eggs.", "Chop the tomatoe well.", "Mix all ingredients."])], "k string, step int, t string")
    items = spark.createDataFrame([("r", i, n) for i, n in enumerate(["butter", "brown sugar", "egg", "tomatoes", "salt"])], "k string, item int, n string")
    got = {(r["item"], r["step"]): (r["way"], None if r["part"] is None else round(r["part"], 3)) for r in S.linked(steps, items, ["k"], "step", "t", "item", "n").collect()}
    assert got == {(0, 0): ("exact", 0.5), (0, 1): ("exact", 0.5), (1, 0): ("exact", None), (2, 1): ("stem", None), (3, 2): ("fuzzy", None), (4, 3): ("all", None)}


def test_shares(spark):
    df = spark.createDataFrame([("a", 0.25), ("a", -1.0), ("a", -1.0), ("b", 0.5), ("b", None), ("c", None), ("c", None), ("d", 0.5)], "k string, s double")
    got = sorted((r["k"], r["part"]) for r in S.shares(df, ["k"], "s").collect() if r["part"] is not None)
    assert got == [("a", 0.25), ("a", 0.375), ("a", 0.375), ("b", 0.5), ("b", 0.5)]
