"""Recipes of books, reports, tasks, mappings, sinks and the request loop on hand-made files."""

import json

import pytest
from pyspark.sql import functions as F

from larder.sources import books, records, reports


def book(spark, texts):
    return books.flagged(spark.createDataFrame([("b", i, t) for i, t in enumerate(texts)], "k string, o int, t string"), "k", "o", "t")


def found(spark, texts):
    return [(r["start"], r["end"]) for r in books.candidates(book(spark, texts), "k").orderBy("start").collect()]


def test_recipes_by_yields(spark):
    texts = ["Some words of the author that open this book at length.", "Apple Pie", "With Cream", "Serves 6", "2 cups flour", "1 tsp salt", "Mix and bake.", "Variations", "Use pears.", "Pear Tart", "Prep time: 20 minutes", "Serves 4", "3 pears", "1 cup sugar", "Chapter Two", "More words."]
    assert found(spark, texts) == [(1, 9), (9, 14)]
    scores = [r["score"] for r in books.candidates(book(spark, texts), "k").orderBy("start").collect()]
    assert scores[0] == 1.0 and scores[1] == round(2 / 3, 6)


def test_recipes_by_ingredients(spark):
    texts = ["Bean Soup", "Ingredients", "2 cups beans", "1 onion", "Directions", "Boil it.", "Onion Soup", "Ingredients:", "3 onions", "1 cup stock", "Fry it."]
    assert found(spark, texts) == [(0, 6), (6, 11)]
    assert found(spark, ["just prose here.", "and more of it."]) == [] and found(spark, ["Ingredients", "2 eggs"]) == [(0, 2)]
    rows = book(spark, texts)
    assert rows.filter("ingredients").count() == 2
    inside = books.owned(rows, books.candidates(rows, "k"), "k").orderBy("place").collect()
    assert [r["recipe"] for r in inside] == [0] * 6 + [6] * 5


def test_blocks_of_several_recipes(spark):
    texts = ["Bean Soup", "2 cups beans", "1 onion", "Boil it.", "A Good Side Note", "It says something here.", "Onion Soup", "Serves 4", "3 onions", "1 cup stock"]
    assert [r["part"] for r in books.split_sections(book(spark, texts), "k").orderBy("place").collect()] == [0] * 6 + [1] * 4


def test_reports(spark, tmp_path):
    run = tmp_path / "2024-01-02_03.04.05_x"
    (run / "eval").mkdir(parents=True)
    (tmp_path / ".history").mkdir()
    (run / "a.report.json").write_text(json.dumps({"sourceFile": "/in/book.epub", "totalRecipes": 4, "timing": {"totalSeconds": 8.0, "parsing_seconds": 1}}, indent=1))
    (run / "b.report.json").write_text("{broken")
    (tmp_path / ".history" / "c.report.json").write_text("{}")
    (tmp_path / "loose.report.json").write_text("{}")
    rows, bad = reports.stage_reports(spark, str(tmp_path))
    r = rows.collect()
    assert len(r) == 1 and (r[0]["file"], r[0]["recipes"], r[0]["total_seconds"], r[0]["seconds_per_recipe"], r[0]["time"]) == ("book.epub", 4.0, 8.0, 2.0, 1704164645.0)
    assert [x["path"].rsplit("/", 1)[1] for x in bad.collect()] == ["b.report.json"] and reports.stage_reports(spark, str(tmp_path), since=1.8e9)[0].count() == 0
    for name, data in {"eval_report.json": {"precision": 0.5, "counts": {"gold_total": 3}}, "coverage.json": {"extracted_chars": 10}, "manifest.json": {"source": {"path": "p"}, "run_config": {"m": 1}}}.items():
        (run / "eval" / name).write_text(json.dumps(data))
    e = reports.evaluation_reports(spark, str(tmp_path)).first()
    assert (e["precision"], e["gold"], e["total_chars"], e["covered_chars"], e["source"], e["settings"]) == (0.5, 3.0, 10.0, None, "p", '{"m":1}')


def test_histories_fill_each_other(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("one", "two")]
    records.append_history(spark.createDataFrame([("a", "1", ""), ("b", "", "x")], "run string, score string, note string"), paths[0], ["run", "score", "note"])
    records.append_history(spark.createDataFrame([("a", "9", "late"), ("c", "3", ""), ("", "4", "")], "run string, score string, note string"), paths[1], ["run", "score", "note"])
    got = reports.histories(spark, paths, ["run", "score", "note"], "run", records.read_history)
    assert sorted((r["run"], r["score"], r["note"]) for r in got.collect()) == [("a", "1", "late"), ("b", None, "x"), ("c", "3", None)]


def task(i, level, kind, hint="", **more):
    return json.dumps({"data": {"chunk_id": f"urn:x:chunk:y:h{i}:{i}", "chunk_level": level, "chunk_type": kind, "chunk_type_hint": hint, **more}})


def test_predicted_ranges(spark):
    tasks = [task(1, "structural", "recipe_block", location={"start_row": 5, "end_row": 2}), task(2, "atomic", "ingredient_line", location={"row_index": 7}), task(3, "atomic", "atom_paragraph", location={"start_line": 1, "end_line": 1}, source_hash="s", source_file="f"), task(4, "atomic", "step_line"), task(5, "other", "x", location={"row_index": 1}), task(6, "atomic", "", "tip", location={"block_index": 0})]
    df = spark.createDataFrame([(t,) for t in tasks], "value string")
    got = sorted((r["source"], r["file"], r["label"], r["start"], r["end"]) for r in reports.predicted_ranges(df).collect())
    assert got == [("h1", "unknown", "RECIPE_TITLE", 2, 5), ("h2", "unknown", "INGREDIENT_LINE", 7, 7), ("h6", "unknown", "KNOWLEDGE", 0, 0), ("s", "f", "OTHER", 1, 1)]
    titled = df.unionByName(spark.createDataFrame([(task(7, "structural", "recipe_title", location={"row_index": 9}),)], "value string"))
    assert [(r["start"], r["label"]) for r in reports.predicted_ranges(titled).filter("label = 'RECIPE_TITLE'").collect()] == [(9, "RECIPE_TITLE")]


def test_annotations(spark):
    done = {"id": "t", "annotations": [{"was_cancelled": False, "result": [{"id": "r", "value": {"start": 1, "end": 4, "text": "abc", "labels": ["A", "B"]}}]}, {"was_cancelled": True, "result": [{"id": "q", "value": {"start": 0, "end": 1, "text": "x", "labels": ["C"]}}]}, {"result": None}]}
    df = spark.createDataFrame([(json.dumps(done),), ("no json",)], "value string")
    assert sorted(tuple(r) for r in reports.annotations(df).collect()) == [("t", "r", "A", 1, 4, "abc"), ("t", "r", "B", 1, 4, "abc")]


def test_mappings(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text(json.dumps({"sheets": ["A"], "skip_rows": 1, "aliases": {"Zutaten": "Ingredients"}}))
    mapping = reports.load_mapping(path)
    cells = spark.createDataFrame([("p", "A", 1, 1, "junk"), ("p", "A", 2, 1, "zutaten:"), ("p", "A", 3, 1, "Zutaten"), ("p", "B", 2, 1, "x")], "path string, sheet string, row int, col int, text string")
    assert sorted((r["row"], r["text"]) for r in reports.mapped_cells(cells, mapping).collect()) == [(2, "Ingredients"), (3, "Zutaten")]
    for bad in ("[]", "{", '{"other": 1}'):
        path.write_text(bad)
        with pytest.raises(reports.MappingError):
            reports.load_mapping(path)


def test_sinks(spark, tmp_path):
    lines = spark.createDataFrame([("r", "main", 0, "a"), ("r", "sauce", 2, "c"), ("r", "main", 1, "b")], "k string, s string, o int, t string")
    found_ = reports.section_rows(lines, ["k"], "s", "o", "t")
    reports.write_records(found_, str(tmp_path / "s"), reports.sections_markdown(F.col("k"), F.col("sections")))
    assert spark.read.json(str(tmp_path / "s" / "records")).first()["sections"][1]["name"] == "sauce"
    assert "".join(p.read_text() for p in (tmp_path / "s" / "markdown").glob("part-*")).strip() == "# r\n\n## main\n\n- a\n- b\n\n## sauce\n\n- c"
    t = spark.createDataFrame([(["a", "b|"], [["1", "2"]]), (None, [["x", "y"], ["1", None]])], "h array<string>, r array<array<string>>")
    assert [r[0] for r in t.select(reports.table_markdown(F.col("h"), F.col("r"))).collect()] == ["| a | b\\| |\n| --- | --- |\n| 1 | 2 |\n", "| x | y |\n| --- | --- |\n| 1 |  |\n"]
    reports.write_raw(spark.createDataFrame([("n", "text", "é")], "name string, kind string, content string"), str(tmp_path / "raw"))
    assert bytes(spark.read.parquet(str(tmp_path / "raw")).first()["content"]) == "é".encode()


def test_session(spark):
    loads = []

    def load(s):
        loads.append(1)
        return s.createDataFrame([(1, "a"), (2, "b")], "n int, t string")

    session = reports.Session(spark, load, {"over": lambda df, q: df.filter(F.col("n") > q["n"]), "fail": lambda df, q: 1 / 0})
    got = [json.loads(x) for x in session.serve(['{"id": 1, "action": "ping"}', "", '{"id": 2, "action": "load"}', '{"id": 3, "action": "over", "n": 1}', '{"id": 4, "action": "fail"}', "no json", '{"id": 5, "action": "?"}', '{"id": 6, "action": "reload"}'])]
    assert [g["ok"] for g in got] == [True, True, True, False, False, False, True] and got[2]["result"] == [{"n": 2, "t": "b"}] and got[3]["error"].startswith("ZeroDivisionError") and len(loads) == 2


def test_progress_messages(spark):
    texts = ['__stage_progress__ {"type": "stage_progress", "message": " m ", "stage_label": "s", "task_current": 9, "task_total": 4, "running_workers": -1}', '__stage_progress__ {"type": "other"}', "plain", "__stage_progress__ {", None, '__stage_progress__ {"type": "Stage_Progress", "message": "x"}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["p"] for r in df.select("i", reports.progress(F.col("t")).alias("p")).orderBy("i").collect()]
    assert tuple(got[0]) == ("m", "s", 4, 4, 0) and got[1:5] == [None] * 4 and got[5]["message"] == "x" and got[5]["total"] is None
