"""Stages, suites and watchdogs on hand-made rows."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from larder.operators import folds
from larder.operators import stages as G
from larder.streaming import telemetry


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["v"] for r in df.select("i", expression(F.col("x")).alias("v")).orderBy("i").collect()]


def test_headers_and_sections(spark):
    got = column(spark, ["Ingredients:", "  METHOD ", "Notes", "For the Red Sauce", "Crust:", "2 cups flour:", "Stir it well.", ""], G.header_kind)
    assert [r and tuple(r) for r in got] == [("ingredients", "main", "Main"), ("instructions", "main", "Main"), ("notes", "notes", "Notes"), ("other", "red_sauce", "For the Red Sauce"), ("other", "crust", "Crust"), None, None, None]
    df = spark.createDataFrame([(1, "Pie\nIngredients\n a  b \n\nDirections\r\nMix.\nBake."), (2, "no headers"), (3, None)], "k int, t string")
    assert sorted((r["k"], r["kind"], r["lines"]) for r in G.text_sections(df, "k", "t").collect()) == [(1, "ingredients", ["a b"]), (1, "instructions", ["Mix.", "Bake."])]


def test_bundles(spark):
    df = spark.createDataFrame([("b", 2, "y", "two"), ("b", 1, "x", "one"), ("b", 3, "z", " ")], "k string, o int, i string, t string")
    got = G.bundled(df, "k", "o", "i", "t").orderBy("place").collect()
    assert [(r["place"], r["id"]) for r in got] == [(0, "x"), (1, "y")] and len({r["source_hash"] for r in got}) == 1 and len(got[0]["source_hash"]) == 64


def test_refined_and_finalized(spark):
    drafts = spark.createDataFrame([(1, "a", ["x"], ["s"]), (2, "b", ["y"], ["s"])], "k int, title string, ingredients array<string>, steps array<string>")
    assert not any(r["corrected"] for r in G.refined(drafts, ["k"]).collect())
    hook = lambda df: df.filter("k = 1").withColumn("title", F.upper("title"))
    assert [(r["k"], r["title"], r["corrected"]) for r in G.refined(drafts, ["k"], hook).orderBy("k").collect()] == [(1, "A", True), (2, "b", False)]
    rows = spark.createDataFrame([("d", i, c) for i, c in enumerate(["open", "open", "kept", "open"])], "k string, i int, c string")
    decided = spark.createDataFrame([("d", 0, "knowledge"), ("d", 1, "knowledge"), ("d", 2, "knowledge")], "k string, i int, c string")
    final, spans = G.finalized(rows, ["k"], "i", "c", "open", decided)
    assert [(r["c"], r["decided"]) for r in final.orderBy("i").collect()] == [("knowledge", True), ("knowledge", True), ("kept", False), ("other", False)]
    assert sorted((r["c"], r["start"], r["end"]) for r in spans.collect()) == [("kept", 2, 3), ("knowledge", 0, 2), ("other", 3, 4)]
    assert {r["c"] for r in G.finalized(rows, ["k"], "i", "c", "open")[0].collect()} == {"other", "kept"}


def test_row_evidence(spark):
    texts = spark.createDataFrame([("r", 0, "2  Cups flour", "I"), ("r", 1, "Mix.", "S"), ("r", 2, "mix.", "S"), ("r", 3, "lost", "S")], "k string, o int, t string, l string")
    rows = spark.createDataFrame([("r", 10, "2 cups flour"), ("r", 11, "Mix."), ("r", 12, "Mix.")], "k string, n int, t string")
    assert sorted((r["n"], r["labels"]) for r in G.row_evidence(texts, rows, ["k"], "t", "l", "n", "o").collect()) == [(10, ["I"]), (11, ["S"]), (12, ["S"])]


def test_semantics(spark):
    df = spark.createDataFrame([(" Pie ", ["1 cup milk"], ["Mix.", "Variation: use cream"], None, "Nice.\nServes 4"), (None, None, None, None, None)], "t string, i array<string>, s array<string>, y string, d string")
    a, b = (r[0] for r in df.select(G.semantics(*map(F.col, "tisyd"))).collect())
    assert a["title"] == "Pie" and a["ingredients"][0]["unit"] == "cup" and a["steps"] == ["Mix."] and a["variants"] == ["Variation: use cream"] and a["yield"]["units"] == 4
    assert b["ingredients"] == [] and b["steps"] == [] and b["yield"]["units"] == 1


def test_prediction_runs_and_tasks(spark):
    texts = ["Apple Pie", "Serves 6", "2 cups flour 1 tsp salt", "Mix the flour and bake for 20 minutes.", "Plain Heading Somewhere"]
    blocks = spark.createDataFrame([("b", i, t) for i, t in enumerate(texts)], "k string, b int, t string")
    run = G.prediction_run(blocks, "k", "b", "t", 4, 1)
    assert [r["label"] for r in run.rows.orderBy("row").collect()] == ["RECIPE_TITLE", "YIELD_LINE", "INGREDIENT_LINE", "INGREDIENT_LINE", "INSTRUCTION_LINE", "OTHER"]
    assert [(r["start"], r["end"], r["accepted"]) for r in run.spans.collect()] == [(0, 5, True)] and sorted((r["start"], r["end"]) for r in run.tasks.collect()) == [(0, 4), (3, 6)]
    tasks = [json.loads(r["task"])["data"] for r in G.labelling_tasks(run.rows, ["k"], "row", "text", 4, 1, 2).orderBy("start").collect()]
    assert [r["row"] for r in tasks[0]["rows"]] == [1, 2] and [r["row"] for r in tasks[0]["before"]] == [0] and [r["row"] for r in tasks[0]["after"]] == [3] and tasks[0]["rows"][0]["text"] == "Serves 6"


def test_suites(spark):
    exports = spark.createDataFrame([(i, f"gold/f{i}.txt", 10.0 * i, float(i % 3), ["a", "b"][i % 2]) for i in range(1, 8)], "id int, path string, size double, labels double, ext string")
    files = spark.createDataFrame([(f"in/F{i}.TXT",) for i in range(1, 7)], "path string")
    got = G.discovered_suite(exports, files, "path", "id", "size", "labels", "ext", 3).collect()
    assert len(got) == 6 and sum(r["selected"] for r in got) == 3 and {r["ext"] for r in got if r["selected"]} == {"a", "b"}
    ticks = iter(range(100))
    times = G.timed(spark, {"x": lambda: spark.range(3)}, 1, 2, lambda: float(next(ticks))).collect()
    assert [(r["scenario"], r["sample"], r["seconds"]) for r in times] == [("x", 0, 1.0), ("x", 1, 1.0)]
    asked = []
    score = lambda c, t: asked.append((c, t)) or {"a": 1, "b": 3, "c": 2}[c]
    left, scores = G.raced(["a", "b", "c"], ["t1", "t2"], score, (1, 2), (2, 1))
    assert left == ["b"] and len(asked) == len(scores) == 5
    with G.pool(spark, "x"):
        assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") == "x"
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_engines_and_matchers(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "k int, t string")
    assert [r["features"] for r in G.analysed(df, "k", "t", lambda t: {"n": len(t)}).orderBy("k").collect()] == [{"n": 3.0}, {"n": 0.0}] and G.analysed(df, "k", "t", None).first()["features"] == {}
    a = spark.createDataFrame([(1, i, t) for i, t in enumerate("abcd")], "s int, o int, t string")
    b = spark.createDataFrame([(1, i, t) for i, t in enumerate("xbcd")], "s int, o int, t string")
    assert sorted(map(tuple, folds.sequence_alignment(a, b, ["s"], "o", "t", "same_place").collect())) == [(1, 1, 1), (1, 2, 2), (1, 3, 3)]
    with pytest.raises(ValueError):
        folds.matcher("magic")


def test_history_rows(spark):
    e = spark.createDataFrame([("s", 0.5, 1.0, 0.9, 0.8, 10.0, 7.0)], "source string, precision double, recall double, accuracy double, macro_f1 double, gold double, matched double")
    r = G.history_row(e, F.lit("t"), F.lit("d"), F.lit(5), F.lit(8.0), F.lit(4)).first()
    assert r.asDict() == {"run_timestamp": "t", "run_dir": "d", "source_file": "s", "precision": 0.5, "recall": 1.0, "f1": pytest.approx(2 / 3), "accuracy": 0.9, "macro_f1": 0.8, "gold_total": 10.0, "gold_matched": 7.0, "gold_missed": 3.0, "tokens_total": 5, "seconds": 8.0, "seconds_per_recipe": 2.0}


def test_watchdogs(spark, tmp_path):
    at = lambda m: datetime(2024, 1, 1, 0, m)
    events = [("a", 0, "x"), ("a", 1, "done"), ("b", 0, "x"), ("b", 1, "y"), ("b", 2, "y"), ("b", 3, "y"), ("c", 0, "x"), ("d", 29, "x"), ("d", 30, "y")]
    df = spark.createDataFrame([(w, at(m), s) for w, m, s in events], "w string, ts timestamp, s string")
    got = {r["w"]: (r["state"], r["streak"], r["events"]) for r in G.watchdog(df, ["w"], "ts", "s", F.lit(at(31)), 600, 3, F.col("s") == "done").collect()}
    assert got == {"a": ("complete", 1, 2), "b": ("looping", 3, 4), "c": ("idle", 1, 1), "d": ("working", 1, 2)}
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    line = lambda w, m, s: json.dumps({"ts": str(at(m)), "worker": w, "status": s, "done": 0, "active": 0})
    (tmp_path / "in" / "1.json").write_text("\n".join(line(w, m, s) for w, m, s in events if w in "ab"))
    telemetry.run_once(telemetry.watched(telemetry.read(spark, source)), out, state)
    assert {(r["worker"], r["state"], r["streak"]) for r in spark.read.parquet(out).collect()} == {("a", "complete", 1), ("b", "looping", 3)}
    (tmp_path / "in" / "2.json").write_text(line("b", 40, "z"))
    telemetry.run_once(telemetry.watched(telemetry.read(spark, source)), out, state)
    (tmp_path / "in" / "3.json").write_text(line("b", 41, "z"))
    telemetry.run_once(telemetry.watched(telemetry.read(spark, source)), out, state)
    rows = {(r["worker"], r["state"], r["events"]) for r in spark.read.parquet(out).collect()}
    assert {("b", "working", 5), ("b", "working", 6), ("a", "idle", 2)} <= rows
