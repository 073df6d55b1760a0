"""Repair of texts, rows of blocks and their labels on hand-made rows."""

import random
import re
import unicodedata

from pyspark.sql import functions as F

from larder.functions import repair
from larder.operators import rows as R


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["v"] for r in df.select("i", expression(F.col("x")).alias("v")).orderBy("i").collect()]


def plain_whitespace(t):
    t = re.sub(r"[^\S\n]+", " ", t.replace(" ", " ").replace("\r\n", "\n").replace("\r", "\n"))
    return "\n".join(x.strip() for x in t.split("\n")).strip()


def test_normalised_texts(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice(["ﬁ", "½", "a", " ", "\n", " ", "é", "é", "Ａ", "â€™", "Ã©", "x", "\r\n", "²"]) for _ in range(30)) for _ in range(200)] + [None, "", "plain"]

    def plain(t):
        for bad, good in repair.MOJIBAKE:
            t = t.replace(bad, good)
        return plain_whitespace(unicodedata.normalize("NFKC", t))

    assert column(spark, texts, repair.normalised) == [plain(t or "") for t in texts]
    assert column(spark, ["“x­”​ 1½–2", "1⁄2 cup", None], repair.book_text) == ['"x" 11/2-2', "1/2 cup", ""]


def test_blocks_split_into_rows():
    split = R.split_text
    assert split("2 cups flour 1 tsp salt 3 tbsp sugar") == ["2 cups flour", "1 tsp salt", "3 tbsp sugar"]
    assert split("Mix well. Note: do not overmix") == ["Mix well.", "Note: do not overmix"]
    assert split("A fine cake Serves 4 to 6") == ["A fine cake", "Serves 4 to 6"]
    assert split("1. Heat the oil. 2. Add onions.") == ["1. Heat the oil.", "2. Add onions."]
    assert split("salt; pepper ;oil") == ["salt", "pepper", "oil"]
    assert split("Bake for 20 minutes at 350 degrees until 2 inches high") == ["Bake for 20 minutes at 350 degrees until 2 inches high"]
    assert split("1 / 2 cup milk") == ["1/2 cup milk"] and split(" \n ") == []
    prose = " ".join(f"Sentence number {w} goes on for quite a while so that it is long enough to stand." for w in ("one", "two", "three", "four", "five"))
    assert split(prose) == [f"Sentence number {w} goes on for quite a while so that it is long enough to stand." for w in ("one", "two", "three", "four", "five")]
    assert all(len(x) <= 460 for x in split("word " * 400)) and " ".join(split("word " * 400)) == ("word " * 400).strip()


def test_sentences_keep_decimals_and_closing_quotes():
    t = 'It weighs 2.5 kg. "Really?" she said. Yes'
    assert [t[a:b] for a, b in R.sentence_spans(t)] == ["It weighs 2.5 kg.", '"Really?" she said.', "Yes"]


def test_rows_keep_their_places(spark):
    text = "2 cups\nflour 1 tsp salt; Note:  rest it"
    df = spark.createDataFrame([("d", 5, text), ("d", 2, None), ("d", 3, "Serves 4"), ("e", 0, "x")], "doc string, b int, t string")
    got = R.source_rows(df, "doc", "b", "t").orderBy("doc", "row").collect()
    assert [(r["doc"], r["row"], r["block"], r["ordinal"], r["text"]) for r in got] == [("d", 0, 3, 0, "Serves 4"), ("d", 1, 5, 0, "2 cups flour"), ("d", 2, 5, 1, "1 tsp salt"), ("d", 3, 5, 2, "Note: rest it"), ("e", 0, 0, 0, "x")]
    assert [text[r["start"] : r["end"]] for r in got[1:4]] == ["2 cups\nflour", "1 tsp salt", "Note:  rest it"]
    assert got[1]["row_id"] == "urn:row:d:5:0" and got[0]["tags"] == ["yield_prefix"] and "ingredient_like" in got[1]["tags"] and got[3]["tags"][0] == "note_prefix"


def test_atoms(spark):
    df = spark.createDataFrame([(1, 0, "one\ntwo\n\nthree\n- item a\n2) item b\n\n \nlast"), (1, 1, None)], "d int, b int, t string")
    assert [(r["kind"], r["text"]) for r in R.atoms(df, "d", "b", "t").orderBy("atom").collect()] == [("paragraph", "one two"), ("paragraph", "three"), ("item", "item a"), ("item", "item b"), ("paragraph", "last")]


def test_features_and_roles(spark):
    f = lambda x: R.features(x)
    got = column(spark, ["2 cups flour", "Ingredients:", "First, mix the eggs", "My Good Cake", "McDonald soup", "1. Stir", "Serves 4", None], f)
    assert got[0]["ingredient"] and not got[0]["instruction"] and got[1]["ingredient_header"] and got[1]["header"] and got[2]["verb"] and got[2]["instruction"]
    assert got[3]["title_case"] and got[3]["header"] and not got[4]["title_case"] and got[5]["number"] and got[6]["is_yield"] and not got[7]["header"]
    df = spark.createDataFrame([("Serves 4", None), ("2 cups flour", None), ("Stir it well", None), ("Chapter One", 1), ("Good Pie", 3), ("Tip: rest it", None), ("some words about the old town", None), ("ok", None), ("", None)], "t string, h int")
    assert [r[0] for r in df.select(R.block_role(F.col("t"), R.features(F.col("t")), F.col("h"))).collect()] == ["metadata", "ingredient_line", "instruction_line", "section_heading", "recipe_title", "tip_like", "narrative", "other", "other"]


def test_line_roles_look_around(spark):
    texts = [
        ("Preface of the Author", False), ("The town was old and its people had always cooked with what they found there.", False), ("Apple Pie", None), ("Serves 6", True), ("For the crust:", True), ("2 cups flour", True), ("1 tsp salt", True),
        ("Mix the flour and bake for 20 minutes.", True), ("Prep time: 20 minutes", True), ("Note: rest it", True), ("Keeps for three days in a tin", True), ("Variations", True), ("Pear instead of apple", True), ("Another Heading Alone", None), ("odd words", None),
    ]
    df = spark.createDataFrame([("b", i, t, w) for i, (t, w) in enumerate(texts)], "k string, i int, t string, w boolean")
    got = [r["label"] for r in R.line_roles(df.withColumn("tags", R.rule_tags(F.col("t"))), ["k"], "i", "t", "tags", "w").orderBy("i").collect()]
    assert got[:11] == ["OTHER", "OTHER", "RECIPE_TITLE", "YIELD_LINE", "HOWTO_SECTION", "INGREDIENT_LINE", "INGREDIENT_LINE", "INSTRUCTION_LINE", "TIME_LINE", "RECIPE_NOTES", "RECIPE_NOTES"]
    assert got[11:13] == ["RECIPE_VARIANT", "RECIPE_VARIANT"]


def test_variants(spark):
    got = column(spark, [["Mix.", "Variation", "- use pears", "For the sauce", "Stir.", "Variant: no salt"], [], None], lambda x: R.split_variants(x), "array<string>")
    assert got[0] == (["- use pears", "Variant: no salt"], ["Mix.", "For the sauce", "Stir."]) and got[1] == ([], []) and got[2] == ([], [])


def test_offsets_compile_no_pattern(monkeypatch):
    """Rows are found by a search for their characters, white space aside, whatever their length."""
    from larder.operators import rows as W

    monkeypatch.setattr(W.re, "compile", None)
    assert W.offsets("2 / 3 cup\tflour, 1 egg; a b ab", ["2/3 cup flour", "1 egg", "", "ab", "ab", "none"]) == [(0, 15), (17, 22), (22, 22), (24, 27), (28, 30), (30, 30)]
    assert W.offsets("x " * 50_000, ["x " * 50_000, "x"]) == [(0, 99_999), (99_999, 99_999)]
