"""Sources, sinks, folds and streams on hand-made rows."""

import json

import pytest
from pyspark.sql import functions as F

from larder.operators import folds
from larder.sources import books, records
from larder.streaming import telemetry


def test_registry(spark):
    r = records.default_registry()
    with pytest.raises(ValueError):
        r.register("text", records.by_suffix("txt"))
    df = spark.createDataFrame([("a/B.TXT",), ("x.epub",), ("y.unknown",)], "p string")
    assert [x[0] for x in df.select(r.best(F.col("p"))).collect()] == ["text", "book", None]


def test_lines_round_trip(spark, tmp_path):
    path = str(tmp_path / "lines")
    df = spark.createDataFrame([(2, "b", None), (1, "a", [1, 2])], "row_index int, text string, rows array<int>")
    records.write_lines(df, path)
    back = records.read_lines(spark, path, "row_index int, text string, rows array<int>")
    assert sorted(map(tuple, back.collect())) == [(1, "a", [1, 2]), (2, "b", None)]
    bad = tmp_path / "bad.json"
    bad.write_text('{"row_index": 1, "text": "x"}\nnot json\n')
    assert records.read_lines(spark, str(bad), "row_index int, text string", strict=False).collect()[0]["text"] == "x"
    with pytest.raises(Exception, match="(?i)malformed"):
        records.read_lines(spark, str(bad), "row_index int, text string").collect()


def test_history(spark, tmp_path):
    path, columns = str(tmp_path / "history"), ["run", "score", "note"]
    records.append_history(spark.createDataFrame([("r1", 0.5, "x")], "run string, score double, other string"), path, columns)
    records.append_history(spark.createDataFrame([("r2", "n")], "run string, note string"), path, columns)
    history = records.read_history(spark, path, columns)
    filled = records.backfilled(history, spark.createDataFrame([("r1", "from"), ("r2", "from")], "run string, note string"), "run")
    assert sorted((r["run"], r["note"]) for r in filled.collect()) == [("r1", "from"), ("r2", "n")]


def test_history_cells_with_breaks_and_quotes(spark, tmp_path):
    path, columns = str(tmp_path / "history"), ["run", "note"]
    notes = ["one\ntwo", 'say "x", then\r\ny', "  blanks  ", "", None, "a,b"]
    records.append_history(spark.createDataFrame(list(zip(map(str, range(6)), notes)), "run string, note string"), path, columns)
    got = {r["run"]: r["note"] or "" for r in records.read_history(spark, path, columns).collect()}
    assert got == {str(i): n or "" for i, n in enumerate(notes)}


def test_files_and_ranges(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.txt").write_text("abc")
    assert [(r["path"].rsplit("/", 1)[1], r["size"]) for r in records.files(spark, str(tmp_path)).collect()] == [("a.txt", 3)]
    df = spark.createDataFrame([([3, 1], "L", "s"), ([], "L", "s"), ([2], None, "s")], "rows array<int>, label string, src string")
    assert [(r["start"], r["end"]) for r in records.ranges(df, "rows", "label", "src").collect()] == [(1, 3)]


def test_sessions(spark):
    labels = "x T i n n g X X g T i n n n g T".split()
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate(labels)], "s int, pos long, label string")
    got = sorted(map(tuple, folds.sessions(df, ["s"], "pos", "label", "T", ["i", "g"], ["i", "g"]).collect()))
    assert got == [(1, 1, 8, True), (1, 9, 10, False), (1, 15, 15, False)]


def test_greedy_folds(spark):
    spans = spark.createDataFrame([(1, 0, 10, 0), (1, 2, 4, 1), (1, 5, 9, 2), (1, 20, 21, 3)], "s int, a long, b long, o int")
    assert sorted(map(tuple, folds.consolidated(spans, ["s"], "a", "b", "o").collect())) == [(1, 2, 4), (1, 5, 9), (1, 20, 21)]
    chunks = spark.createDataFrame([(1, i, n, s) for i, (n, s) in enumerate([(5, False), (5, False), (5, False), (1, True), (20, False)])], "s int, o int, n int, st boolean")
    assert [r["chunk"] for r in folds.size_chunks(chunks, ["s"], "o", "n", "st", 10).orderBy("o").collect()] == [0, 0, 1, 2, 3]
    small = spark.createDataFrame([(1, i, n, x) for i, (n, x) in enumerate([(3, "a"), (20, "b"), (8, "b"), (20, "b"), (8, "c"), (20, "d")])], "s int, o int, n int, sec string")
    assert [r["merged"] for r in folds.small_merged(small, ["s"], "o", "n", "sec", 10).orderBy("o").collect()] == [0, 0, 1, 1, 2, 3]
    tagged = spark.createDataFrame([(1, 0, ["a", "b", "c"], 10), (1, 1, ["a", "b", "c"], 10), (1, 2, ["x"], 10), (1, 3, [], 1)], "s int, o int, t array<string>, n int")
    assert [r["merged"] for r in folds.alike_merged(tagged, ["s"], "o", "t", "n").orderBy("o").collect()] == [0, 0, 1, 2]


def test_alignment_and_quotes(spark):
    a = spark.createDataFrame([(1, i, t) for i, t in enumerate("abcd")], "s int, o int, t string")
    b = spark.createDataFrame([(1, i, t) for i, t in enumerate("xbcy")], "s int, o int, t string")
    assert sorted(map(tuple, folds.sequence_alignment(a, b, ["s"], "o", "t").collect())) == [(1, 1, 1), (1, 2, 2)]
    q = spark.createDataFrame([("aXaXa", "X", None), ("aXaXa", "X", 2), ("abc", " b ", None), ("abc", "z", None), (None, "z", 1)], "t string, q string, k int")
    assert [(r["start"], r["end"]) for r in folds.quote_offsets(q, "t", "q", "k").collect()] == [(None, None), (3, 4), (1, 2), (None, None), (None, None)]


def test_telemetry_stream(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    rows = [{"ts": f"2024-01-01T00:{m:02d}:00", "worker": w, "status": "failed" if m == 3 else "running", "done": m, "active": -1} for m in range(0, 40) for w in ("a", "b")]
    (tmp_path / "in" / "1.json").write_text("\n".join(map(json.dumps, rows)) + "\nnot json\n[1]\n")
    telemetry.run_once(telemetry.windowed(telemetry.read(spark, source)), out, state)
    (tmp_path / "in" / "2.json").write_text(json.dumps({"ts": "2024-01-01T02:00:00", "worker": "a", "status": "done", "done": 99, "active": 0}) + "\n" + json.dumps({"ts": "2024-01-01T00:01:00", "worker": "a", "status": "late", "done": 1, "active": 0}))
    telemetry.run_once(telemetry.windowed(telemetry.read(spark, source)), out, state)
    got = {(r["worker"], r["start"].minute, r["rows"], r["failed"]) for r in spark.read.parquet(out).collect()}
    assert ("a", 0, 5, 1) in got and ("b", 35, 5, 0) in got and not any(n == 6 for _, _, n, _ in got)
    batch = telemetry.read(spark, source, streaming=False)
    assert batch.count() == 82 and batch.agg(F.min("active")).first()[0] == 0


def test_short_sequences_share_batches(spark, request):
    """Sequences may be nearly as many as rows: none gets a frame of its own, and one may go on over several batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch"))
    keys = [float("nan"), None, *map(float, range(9))]
    rows = [(k, 9 - i, "T" if i == 9 else "i") for k in keys for i in range(10)]
    found = folds.sessions(spark.createDataFrame(rows, "k double, pos long, label string").repartition(4), ["k"], "pos", "label", "T", ["i"], ["i"])
    assert sorted(map(str, found.collect())) == sorted(f"Row(k={k}, start=0, end=9, accepted=True)" for k in keys)
    assert "FlatMapGroupsInPandas" not in found._jdf.queryExecution().executedPlan().toString()
    lines = spark.createDataFrame([(k, i, t) for k in range(40) for i, t in enumerate(["Apple Pie", "Serves 6", "2 cups flour", "1 tsp salt", "Mix it."])], "k int, o int, t string")
    assert {tuple(r)[1:] for r in books.candidates(books.flagged(lines, "k", "o", "t"), "k").collect()} == {(0, 5, 1, 1.0)}
