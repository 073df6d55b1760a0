"""From lines to recipes on a hand-made book."""

import json

from larder.operators import staging
from pyspark.sql import functions as F

BOOK = """On Cooking
People have cooked for a very long time, and they will.

Apple Pie
Serves 4 to 6
2 cups flour
3 apples
Mix the flour and bake.
1. Cool for 1 hour.

Note: keep it cold.
A long story about apples that has no end, or at least none that is known.
Another long paragraph which tells more of the same kind of thing, at length.
One more of these, as books go, before the next one comes.
Bean Soup
1 can beans
It is good.
"""


def test_stage(spark):
    lines = spark.createDataFrame([(7, i, t) for i, t in enumerate(BOOK.split("\n"))], "doc int, line int, text string")
    s = staging.stage(lines, "doc", "line", "text")
    labels = [r["label"] for r in s.rows.orderBy("line").collect()]
    assert labels[:8] == ["prose", "prose", "title", "yield", "ingredient", "ingredient", "instruction", "instruction"]
    spans = [(r["recipe"], r["start"], r["end"], r["accepted"]) for r in s.spans.orderBy("start").collect()]
    assert spans == [(0, 2, 8, True), (1, 12, 13, False)]
    draft = s.drafts.collect()
    assert [(d["title"], d["servings"], d["ingredients"], d["steps"]) for d in draft] == [("Apple Pie", 5, ["2 cups flour", "3 apples"], ["Mix the flour and bake.", "1. Cool for 1 hour."])]
    assert json.loads(draft[0]["json"])["recipeYield"] == "5"
    owned = s.rows.filter("recipe IS NOT NULL").count()
    covered = s.outside.agg(F.sum(F.col("end") - F.col("start"))).first()[0]
    assert owned + covered == s.rows.count()
