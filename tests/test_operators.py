"""Hand-made cases of operators whose positive cases the driver's tables don't hold."""

import pytest
from pyspark.sql import functions as F

from larder.functions import fields as X
from larder.functions import text as T
from larder.operators import compare as C
from larder.operators import ordering as O
from larder.operators import sequences as S
from larder.sources import html, lines


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["v"] for r in df.select("i", expression(F.col("t")).alias("v")).orderBy("i").collect()]


def test_confounded_groups(spark):
    cells = {("A", "S1"): (1, 0.2), ("B", "S1"): (9, 0.3), ("A", "S2"): (9, 0.9), ("B", "S2"): (1, 1.0)}
    df = spark.createDataFrame([(g, s, o) for (g, s), (n, o) in cells.items() for _ in range(n)] + [("", "S1", 9.0), ("A", "S3", 5.0), ("A", "S1", None)], "grp string, stratum string, outcome double")
    raw = {r["grp"]: r["mean"] for r in C.grouped_raw(df.filter("stratum <> 'S3'"), "outcome", "grp").collect()}
    assert raw == pytest.approx({"A": 0.83, "B": 0.37})
    controlled = {r["grp"]: (r["mean"], r["strata"]) for r in C.grouped_controlled(df, "outcome", "grp", ["stratum"]).collect()}
    assert controlled["A"] == (pytest.approx(0.55), 2) and controlled["B"] == (pytest.approx(0.65), 2)
    assert tuple(C.coverage(df, "outcome", "grp", ["stratum"]).first()) == (21, 20, 3, 2)


def test_regression_without_variance(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], "x double, y double")
    assert tuple(C.regression(df, "x", "y").first()) == (2, 0.0, 3.0, 0.0)
    assert tuple(C.regression(df.limit(1), "x", "y").first()) == (1, None, None, None)
    assert C.spearman(df, "x", "y").first()["rho"] is None


def test_lenient_casts(spark):
    assert values(spark, [" 1.5 ", "1e3", "-2", "x", "", None, "inf", "1d", "nan"], X.maybe_number) == [1.5, 1000.0, -2.0, None, None, None, None, None, None]
    assert values(spark, ["2024-01-02_03.04.05", "2024-01-02T03:04:05", "no", None], X.epoch_seconds) == [1704164645.0, 1704164645.0, None, None]
    assert values(spark, ["a\\b\\c.txt", "x/y/", "", None], X.basename) == ["c.txt", "y", None, None]
    assert values(spark, ["a=1 | b = two=2 |x| =3"], lambda t: X.settings_map(t)) == [{"a": "1", "b": "two=2"}]


def test_durations(spark):
    texts = ["1 hr 20 min", "90", "pt15m", "0 min", "soon", "1.5 hours", "45 minutes", None]
    assert values(spark, texts, T.duration_iso) == ["PT1H20M", "PT1H30M", "PT15M", None, None, "PT1H30M", "PT45M", None]


def test_text_repairs(spark):
    assert values(spark, ["bro-\nken Up-\nPer", "1 / 2 cup 3/ 4"], T.joined_hyphens)[0] == "broken Up-\nPer"
    assert values(spark, ["1 / 2 cup 3/ 4"], T.spaced_fractions) == ["1/2 cup 3/4"]
    assert values(spark, ["A Title", "1. Numbered Title", "ends here.", "lower"], T.title_like) == [True, True, False, False]


def test_intervals(spark):
    df = spark.createDataFrame([("a", 0, 3), ("a", 3, 5), ("a", 7, 9), ("a", 8, 8), ("b", 2, 4)], "k string, start long, end long")
    assert sorted(map(tuple, S.merged(df, ["k"]).collect())) == [("a", 0, 5), ("a", 7, 9), ("b", 2, 4)]
    totals = spark.createDataFrame([("a", 10), ("b", 4), ("c", 2)], "k string, total long")
    assert sorted(map(tuple, S.complement(df, ["k"], totals).collect())) == [("a", 5, 7), ("a", 9, 10), ("b", 0, 2), ("c", 0, 2)]
    one = spark.createDataFrame([(7,), (0,)], "n long")
    assert sorted(map(tuple, S.sliding(one, "n", 4, 1).collect())) == [(7, 0, 4), (7, 3, 7)]


def test_boundaries_are_matched_once(spark):
    gold = spark.createDataFrame([(1, 10), (1, 20)], "s int, pos long")
    found = spark.createDataFrame([(1, 9), (1, 11), (1, 40), (2, 5)], "s int, pos long")
    assert sorted(map(tuple, S.match_boundaries(gold, found, ["s"], "pos", 2).collect())) == [(1, 1, 2, 1), (2, 0, 1, 0)]


def test_batches_and_cache(spark):
    df = spark.createDataFrame([(1, i, float(s)) for i, s in enumerate([5, 5, 20, 3, 3, 3, 3])], "k int, i int, s double")
    got = [r["batch"] for r in O.budgeted_batches(df, ["k"], "i", "s", 10.0, 3).orderBy("i").collect()]
    assert got == [0, 0, 1, 2, 2, 2, 3]
    cache = spark.createDataFrame([(1, 1.0, 5.0, "a"), (1, 30.0, 50.0, "b"), (1, 40.0, 4.0, "c")], "k int, age double, size double, name string")
    assert sorted(r["name"] for r in O.kept_in_cache(cache, ["k"], "age", "size", "name", 10.0, 10.0).collect()) == ["a", "c"]
    assert list(O.sweeps({"a": "1", "b": "x"}, {"a": ["1", "2"], "b": ["y"]})) == [{"a": "1", "b": "x"}, {"a": "2", "b": "x"}, {"a": "1", "b": "y"}]


def test_html_blocks(spark):
    page = "<html><head><title>T</title><script>x()</script></head><body><h1> </h1><p>One<br>two &amp; <b>three</b></p><ul><li>a<ul><li>b</li></ul></li></ul></body></html>"
    df = spark.createDataFrame([(1, page), (2, None)], "id int, html string")
    got = [(r["tag"], r["depth"], r["text"]) for r in html.blocks(df, "id", "html").orderBy("block").collect()]
    assert got == [("p", 0, "One"), ("p", 0, "two & three"), ("li", 1, "a"), ("li", 2, "b")]
    assert df.select(html.title(F.col("html"))).first()[0] == "T"


def test_markdown(spark):
    df = spark.createDataFrame([(1, "# Head\n- item one\n- item two\npara a\npara b\n\n2) next\nlast")], "id int, t string")
    got = [(r["kind"], r["text"], r["first"], r["last"]) for r in lines.markdown_blocks(df, "id", "t").orderBy("block").collect()]
    assert got == [("heading", "Head", 1, 1), ("item", "item one", 2, 2), ("item", "item two", 3, 3), ("paragraph", "para a para b", 4, 5), ("item", "next", 7, 7), ("paragraph", "last", 8, 8)]


def test_queries_that_cannot_be_answered(spark):
    from larder.operators import facade

    df = spark.createDataFrame([("a", "x", 1.0), ("b", "x", 2.0)], "g string, c string, o double")
    with pytest.raises(facade.QueryError):
        facade.analyze(df, {"outcome": "g"}, ["g", "c", "o"])
    assert [r["field"] for r in facade.analyze(df, {"compare": "c"}, ["g", "c", "o"]).collect()] == ["g"]
    assert facade.weak_coverage(100, 10, 10, 2) == ["under 60 % of the rows are compared", "under 60 % of the strata hold several groups", "under 20 rows are compared", "under 3 strata are compared"]
    assert facade.weak_coverage(100, 90, 10, 9) == []


def test_semi_and_anti_keep_rows_as_they_are(spark):
    from larder.operators import intervals as I

    left = spark.createDataFrame([("a", 0, 3, None), ("a", 0, 3, None), ("a", 50, 60, None), ("a", 50, 60, "x"), (None, 0, 3, "n"), ("a", None, 3, "n")], "k string, s long, e long, note string")
    right = spark.createDataFrame([("a", 2, 10**9), ("a", 100, 200), ("b", 0, 5)], "k string, s2 long, e2 long").filter("s2 <> 2 OR k = 'b'").unionByName(spark.createDataFrame([("a", 3, 20)], "k string, s2 long, e2 long"))
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    semi = rows(I.overlap_join(left, right, ["k"], ("s", "e", "s2", "e2"), 4, how="left_semi"))
    anti = rows(I.overlap_join(left, right, ["k"], ("s", "e", "s2", "e2"), 4, how="left_anti"))
    assert semi == [("a", 0, 3, None)] * 2 and sorted(semi + anti, key=str) == rows(left)


def test_intervals_of_all_lengths_meet_once(spark):
    import random

    from larder.operators import intervals as I

    rng = random.Random(1)
    make = lambda n: [(i, rng.choice("ab"), s, s + rng.choice([0, 3, 50, 4000, 10**6])) for i in range(n) for s in [rng.randint(-2000, 10**6)]]
    a, b = make(150) + [(999, "a", 0, 10**9)], make(150)
    got = sorted((r["i"], r["j"]) for r in I.overlap_join(spark.createDataFrame(a, "i long, k string, s long, e long"), spark.createDataFrame(b, "j long, k string, s2 long, e2 long"), ["k"], ("s", "e", "s2", "e2"), 8).collect())
    assert got == sorted((i, j) for i, k, s, e in a for j, k2, s2, e2 in b if k == k2 and s <= e2 and s2 <= e)


def test_broken_patterns_are_errors(spark):
    from larder.operators import filters as P

    with pytest.raises(P.PatternError):
        P.condition(F.lit("x"), "regex", "(")
    groups = {"a": {"clauses": [{"operator": "regex", "value": "["}]}, "b": {"clauses": [{"operator": "regex", "value": "ok+"}]}}
    assert list(P.broken_patterns(groups)) == ["a"]


def test_numbers_of_booleans_and_groups_of_no_number(spark):
    df = spark.createDataFrame([(True, 1.0), (False, float("nan")), (None, float("inf"))], "b boolean, x double")
    assert [r[0] for r in df.select(X.maybe_number(F.col("b"))).collect()] == [1.0, 0.0, None]
    assert len({r[0] for r in df.select(X.comparable(F.col("x"))).collect()}) == 2


def test_ranks_and_positions_with_heavy_values(spark, monkeypatch):
    import random

    from larder.functions import ranks

    rng = random.Random(3)
    values = [rng.choice([0.0, 0.0, 5.0, rng.uniform(-10, 10)]) for _ in range(3000)] + [-10.5, 10.5]
    rows = [(i, v, rng.randint(0, 50)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v double, t int")
    ordered = sorted(values)
    first, n = {}, {}
    for k, v in enumerate(ordered):
        first.setdefault(v, k)
        n[v] = n.get(v, 0) + 1
    want = {i: first[v] + (n[v] + 1) / 2 for i, v, _ in rows}
    for few in (200_000, 0):
        monkeypatch.setattr(ranks, "BROADCAST_VALUES", few)
        assert {r["i"]: r["r"] for r in ranks.average_ranks(df, "v", "r").collect()} == want
    got = {r["i"]: r["position"] for r in ranks.numbered(df.unionByName(spark.createDataFrame([(-1, None, 3)], df.schema)), "v", ["t", "i"]).collect()}
    assert got == {i: k for k, (i, _, _) in enumerate([(-1, None, 3), *sorted(rows, key=lambda r: (r[1], r[2], r[0]))])}


def test_records_without_keys_stay_apart(spark):
    from larder.operators import merging as M

    left = spark.createDataFrame([("a", 1, ""), (None, 2, "x"), (None, 3, None), ("a", 4, "y")], "k string, i int, s string")
    right = spark.createDataFrame([("a", 9, "r"), ("b", 8, "q"), (None, 7, "p")], "k string, i int, s string")
    assert sorted(map(tuple, M.merged_records(left, right, "k", ["i"]).collect()), key=str) == sorted([("a", 1, "r"), ("a", 4, "y"), (None, 2, "x"), (None, 3, None), ("b", 8, "q"), (None, 7, "p")], key=str)


def test_leaderboard_works_its_means_out_once(spark, request):
    """Of means that come out anew at each evaluation the frontier still holds the best."""
    import random

    from larder.operators.reports import leaderboard

    noisy = F.udf(lambda x: x + random.random() * 1e-9, "double").asNondeterministic()
    rows = [(c, s, q, float(p)) for c, q, p in (("a", 0.9, 5), ("b", 0.8, 3), ("c", 0.7, 4), ("d", 0.6, 3)) for s in ("x", "y")]
    df = spark.createDataFrame([*rows, ("e", "x", 0.5, 1.0)], "c string, s string, q double, p double").withColumn("q", noisy("q"))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.exchange.reuse"))
    for partial, front in ((False, {"c=a", "c=b"}), (True, {"c=a", "c=b", "c=e"})):
        got = leaderboard(df, ["c"], "s", "q", "p", partial).collect()
        assert {r["config"] for r in got if r["on_frontier"]} == front
        assert [r["config"] for r in sorted(got, key=lambda r: r["place"])] == ["c=a", "c=b", "c=c", "c=d", "c=e"][: len(got)]


def test_contained_phrases_without_broadcast(spark):
    """Runs of words are many more than the rows that sizes are estimated from, so neither side may be broadcast."""
    from larder.operators.merging import contained_phrases

    texts = spark.createDataFrame([(1, "A cup of Red-Hot soup"), (2, "red"), (3, None)], "k int, t string")
    phrases = spark.createDataFrame([(1, "red hot"), (1, "hot soup"), (1, "of hot"), (2, "red hot"), (3, "red")], "k int, p string")
    found = contained_phrases(texts, phrases, ["k"], "t", "p")
    assert sorted((r["k"], r["p"]) for r in found.collect()) == [(1, "hot soup"), (1, "red hot")]
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
