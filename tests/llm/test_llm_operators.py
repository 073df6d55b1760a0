"""Each operator against a plain version, and the cases that its docstring defines."""

import hashlib
import io
import pickle
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F

from larder.llm import common, components, fingerprints, lines, mixing, neardup, packing, pii, queries, substrings, topk, toxicity, warc
from larder.llm.words import Words, slices

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD_TEXTS = [None, "", " \n\t ", "word", "a b c d e f g h i j k l m n o p", "é" * 50, "x" * 200_000, "tab\tand\x0bmore\r\nlines " * 30]


def docs_of(spark, texts, **more):
    """A documents table with the given texts, clashing extra columns and a repeated row."""
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    for c in ("rank", "chunk", "line", "key", "score", "block", "n", "bucket", "place", "a", "row"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randint(0, vocabulary)}" + ("." if rng.random() < 0.1 else "") for _ in range(n))


# --- words


def test_words_are_those_of_the_pattern():
    texts = ["a b  c", "", None, " x\ny\x0bz ", "é à b ", "q" * 70000]
    found = []
    for _, w in slices(pa.array(texts), 8):
        for i, j in zip(w.first, w.first[1:]):
            found.append([bytes(w.data[a:b]).decode() for a, b in zip(w.starts[i:j], w.ends[i:j])])
    assert found == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]


def test_word_hashes_tell_words_apart():
    words = sorted({f"{a}{b}" for a in range(300) for b in "xyz"} | {"a", "aa", "aaa", "é", "e"})
    data = " ".join(words).encode()
    hashes = Words(np.frombuffer(data, np.uint8), np.array([0, len(data)])).hashes()
    assert len(set(hashes.tolist())) == len(words)


# --- op1


def brute_topk(rows, k=20, every=20):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            ok[i] = np.floor(np.array(v, np.float64) * 64).astype(np.int64)
    out = set()
    for q, x in ok.items():
        if q % every == 0:
            best = sorted((-int(x @ y), i) for i, y in ok.items() if i != q and len(y) == len(x))[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    return out


def test_topk_is_exact_with_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    rows += [(i, [0.5] * 8) for i in range(300, 360)]  # many equal vectors
    rows += [(400, None), (420, [None] * 8), (440, [float("nan")] * 8), (460, [float("inf")] * 8), (480, []), (None, [1.0] * 8), (500, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, block string")
    got = {tuple(r) for r in topk.search(df, F.col("vec_id") % 20 == 0, sample=64, pivots=4).collect()}
    assert got == brute_topk(rows)


def test_topk_of_large_components_and_repeated_ids(spark):
    rows = [(0, [3e6, 0.0]), (1, [2e6, 1.0]), (2, [-1e12, 5.0]), (3, [1e12, -5.0]), (4, [1e15, 1.0]), (5, [1.0, 0.0]), (6, [1e300, 0.0])]
    scaled = {i: [max(-(1 << 62), min(1 << 62, int(np.floor(x * 64)))) for x in v] for i, v in rows}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.search(df, F.col("vec_id") <= 5).collect()]
    score = lambda q, c: max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(scaled[q], scaled[c]))))
    want = [(q, r + 1, c, s) for q in range(6) for r, (s, c) in enumerate(sorted(((score(q, c), c) for c in scaled if c != q), key=lambda x: (-x[0], x[1])))]
    assert sorted(got) == sorted(want)
    assert next(s for q, _, c, s in got if (q, c) == (0, 5)) == 12288000000
    # Two vectors of one id are two queries, a repeated one is one.
    twice = spark.createDataFrame([(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [1.0, 0.0]), (1, [2.0, 1.0]), (2, [1.0, 3.0])], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.search(twice, F.col("vec_id") == 0).collect())
    assert got == sorted([(0, 1, 1, 8192), (0, 2, 2, 4096), (0, 1, 2, 12288), (0, 2, 1, 4096)])


def test_topk_leaves_cells_out(spark):
    rng = np.random.default_rng(24)
    centres = rng.normal(size=(6, 8)) * 50
    rows = [(i, (centres[i % 6] + rng.normal(size=8)).tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in topk.search(df, F.col("vec_id") % 20 == 0, k=5, sample=300, pivots=6, candidates=50).collect()}
    assert got == brute_topk(rows, 5)
    vectors = topk.quantised(pa.array([v for _, v in rows]), 64)[1]
    table = topk.Pivots(np.arange(300), vectors[:300], 6)
    x = np.stack(vectors)
    near = table.near(x)
    cell = table.cell(near)
    cells = topk.Cells([(8, int(c), int((cell == c).sum()), near[cell == c].min(0).tolist(), near[cell == c].max(0).tolist()) for c in np.unique(cell)], 50)
    blocks = cells.block(8, cell, np.arange(900))
    start = table.start(np.arange(900), x, 5)
    met = np.zeros((900, int(blocks.max()) + 1), bool)
    for b, q in cells.met(8, near, start):
        met[q, b] = True
    scores = x @ x.T
    assert met.mean() < 0.8  # some blocks are left out, none that holds a score over the start
    assert all(met[q, blocks[c]] for q in range(0, 900, 20) for c in np.flatnonzero(scores[q] >= start[q]) if c != q)


def test_topk_with_few_rows_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.search(df, F.col("vec_id") % 20 == 0).collect()] == [(0, 1, 1, 2048)]
    assert topk.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


# --- op2


def test_fingerprints_ignore_order_and_follow_edits(spark):
    rng = random.Random(2)
    texts = [prose(rng, rng.randint(30, 300)) + "\n" + prose(rng, 40) for _ in range(60)] + ODD_TEXTS
    rows = {r["doc_id"]: r for r in fingerprints.compare_edits(docs_of(spark, texts)).collect()}
    whole = [t or "" for t in texts]
    for i, t in enumerate(whole):
        following = whole[i - 1] if i else whole[-1]
        third = len(t) // 3
        edited = t[: len(t) - third] + following[:third]
        assert rows[i]["n_chars"] == len(t)
        assert rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= rows[i]["near_edited"] <= 1 and 0 <= rows[i]["near_next"] <= 1
    assert np.mean([rows[i]["near_edited"] for i in range(1, 60)]) > 0.55
    assert np.mean([rows[i]["near_next"] for i in range(1, 60)]) < 0.2
    same = fingerprints.compare_edits(docs_of(spark, ["a b\nc d", "c d\na b", "a b\nc e"])).orderBy("doc_id").collect()
    assert same[0]["fingerprint"] == same[1]["fingerprint"] != same[2]["fingerprint"]
    assert same[1]["near_next"] == 1.0


def test_fingerprint_vectors_add_up(spark):
    df = spark.createDataFrame([(0, "one two three four.\nfive six"), (1, "one two three four."), (2, "five six")], "k long, t string")
    v = fingerprints.vectors(df, ["k"], "t").groupBy().pivot("k", [0, 1, 2]).agg(F.first("vector"))
    r = v.select("0", fingerprints.inserted(F.col("1"), F.col("2")).alias("sum"), fingerprints.deleted(F.col("0"), F.col("2")).alias("left"), "1").first()
    assert r["0"] == r["sum"] and r["left"] == r["1"]


def test_edited_fingerprints_are_those_of_the_edited_texts(spark):
    rng = random.Random(21)
    texts = ["\n".join(prose(rng, rng.randint(0, 60), 60) for _ in range(rng.randint(1, 6))) for _ in range(40)] + ODD_TEXTS
    rows = {r["doc_id"]: r for r in fingerprints.compare_edits(docs_of(spark, texts)).collect()}
    whole = [t or "" for t in texts]
    edited = [t[: len(t) - len(t) // 3] + (whole[i - 1] if i else whole[-1])[: len(t) // 3] for i, t in enumerate(whole)]
    plain = fingerprints.vectors(spark.createDataFrame(list(enumerate(edited)), "k long, t string"), ["k"], "t").select("k", fingerprints.written(F.col("vector")).alias("f")).collect()
    assert {r["k"]: r["f"] for r in plain} == {i: rows[i]["edited_fingerprint"] for i in rows}

    def phrases(t):
        return Counter(p for line in t.split("\n") for p in re.findall(fingerprints.PHRASE, line))

    def cosine(a, b):
        dot = sum(n * b[p] for p, n in a.items())
        return dot / max(1e-9, np.sqrt(sum(n * n for n in a.values()) * sum(n * n for n in b.values())))

    off = [rows[i]["near_edited"] - cosine(phrases(t), phrases(e)) for i, (t, e) in enumerate(zip(whole[:40], edited)) if t != e and phrases(t) and phrases(e)]
    assert abs(np.mean(off)) < 0.06 and np.sqrt(np.mean(np.square(off))) < 0.15


def test_fingerprints_of_repeated_and_nameless_rows(spark):
    df = spark.createDataFrame([(1, "a b\nc"), (1, "a b\nc"), (None, "x y"), (None, "a b\nc")], "doc_id long, text string")
    got = fingerprints.compare_edits(df).collect()
    assert len(got) == 4 and len({r["fingerprint"] for r in got}) == 2 and sum(r["doc_id"] is None for r in got) == 2


def test_fingerprints_of_one_document_and_of_none(spark):
    one = fingerprints.compare_edits(docs_of(spark, ["abcdef"])).collect()
    assert one[0]["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and one[0]["near_next"] == 1.0
    assert fingerprints.compare_edits(docs_of(spark, ["x"]).limit(0)).count() == 0


# --- op3


def plain_mix(rows, sweeps, temper, keep):
    cells = Counter()
    for s, lang, t, n in rows:
        cells[s, lang, t] += n
    weight = {c: float(n) for c, n in cells.items()}
    for _ in range(sweeps):
        for axis, power in enumerate(temper):
            now, target = Counter(), Counter()
            for c, n in cells.items():
                now[c[axis]] += weight[c]
                target[c[axis]] += n
            target = {k: n**power for k, n in target.items()}
            whole = sum(target.values())
            weight = {c: w * (target[c[axis]] / whole / now[c[axis]] if now[c[axis]] else 0) for c, w in weight.items()}
    scale = sum(cells.values()) / sum(weight.values())
    return {c: weight[c] * scale / cells[c] if cells[c] else 1.0 for c in cells}


def test_mixing_meets_its_targets(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randint(5, 400)), rng.choice(["en", "en", "de", None]), rng.choice(["a"] * 6 + ["b", "c"]), 0) for i in range(900)]
    df = spark.createDataFrame(rows, DOCS)
    got = mixing.mix(df).collect()
    want = plain_mix([(r["mix_source"], r["mix_lang"], r["mix_topic"], r["mix_tokens"]) for r in got], mixing.SWEEPS, list(mixing.TEMPER.values()), mixing.KEEP)
    for r in got:
        assert r["mix_factor"] == pytest.approx(want[r["mix_source"], r["mix_lang"], r["mix_topic"]], rel=1e-6)
        assert r["mix_tokens"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    total = sum(r["mix_tokens"] for r in got)
    assert sum(r["mix_tokens"] * r["mix_probability"] for r in got) / total == pytest.approx(mixing.KEEP, abs=0.01)
    sources = Counter()
    for r in got:
        sources[r["mix_source"]] += r["mix_tokens"]
    tempered = {s: n ** mixing.TEMPER["mix_source"] for s, n in sources.items()}
    for s in sources:  # weighted tokens have the target shares
        weighted = sum(r["mix_tokens"] * r["mix_weight"] * r["mix_probability"] for r in got if r["mix_source"] == s) / total
        assert weighted == pytest.approx(tempered[s] / sum(tempered.values()), abs=0.01)
    assert {r["doc_id"]: r["mix_kept"] for r in got} == {r["doc_id"]: r["mix_kept"] for r in mixing.mix(df.repartition(3)).collect()}


def test_mixing_of_odd_rows(spark):
    got = mixing.mix(docs_of(spark, ODD_TEXTS)).collect()
    assert len(got) == len(ODD_TEXTS) and all(0 <= r["mix_probability"] <= 1 for r in got)
    assert mixing.mix(docs_of(spark, ["x"]).limit(0)).count() == 0


def test_mixing_beside_clashing_columns(spark):
    df = docs_of(spark, [prose(random.Random(1), 30)]).withColumn("MIX_Source", F.lit("clash")).withColumn("a.b", F.lit("kept"))
    got = mixing.mix(df)
    assert [c for c in got.columns if c.lower() == "mix_source"] == ["mix_source"] and got.first()["a.b"] == "kept"


def test_topics_are_those_of_whole_texts(spark):
    rows = [(0, "QUITE LOUD " * 100), (1, "QUITE LOUD " * 10 + "and quiet later on " * 100), (2, "quiet first " * 5 + "VERY LOUD LATER " * 100), (3, ""), (4, "x\n" * 400), (5, "x" * 10000)]
    df = spark.createDataFrame(rows, "i long, t string")
    got = {r["i"]: r["x"] for r in df.select("i", mixing.topic(F.col("t")).alias("x")).collect()}
    assert got == {0: "loud", 1: "prose", 2: "loud", 3: "note", 4: "list", 5: "book"}


def test_mixing_beyond_the_small_number_of_cells(spark, monkeypatch):
    df = docs_of(spark, [prose(random.Random(i), 20 + i) for i in range(60)])
    small = {r["doc_id"]: r["mix_factor"] for r in mixing.mix(df, sweeps=2).collect()}
    monkeypatch.setattr(mixing, "SMALL_CELLS", 0)
    assert {r["doc_id"]: r["mix_factor"] for r in mixing.mix(df, sweeps=2).collect()} == pytest.approx(small)


# --- op4


def test_sums_of_squares_fill_sequences():
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 1025, 3000)
    at, offset, fill = packing.sums_of_squares(lengths, 1024)
    gaps = []  # best fit by decreasing length
    for n in sorted(lengths.tolist(), reverse=True):
        fits = [g for g in gaps if g >= n]
        g = min(fits, default=None)
        if g is not None:
            gaps.remove(g)
        gaps.append((1024 if g is None else g) - n)
    assert fill.max() <= 1024 and fill.sum() == lengths.sum() and len(fill) <= len(gaps) + 3
    for s in range(0, len(fill), 97):
        parts = sorted(zip(offset[at == s], lengths[at == s]))
        assert [o for o, _ in parts] == np.cumsum([0, *[n for _, n in parts]])[:-1].tolist()


def test_encoding_is_that_of_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(5)
    texts = ["", " ", "it's  a\n\n test\t!", "<|endoftext|> x", "日本語 émigré ½ ²", "a" * 3000, " ​ mixed\r\n", "  \n 12345 ...?!"]
    texts += ["".join(chr(rng.choice([32, 10, 39, rng.randint(33, 126), rng.randint(160, 0x2FFF), rng.randint(0x1F300, 0x1F6FF)])) for _ in range(80)) for _ in range(200)]
    for t in texts:
        assert packing.encode(t) == whole.encode(t, add_special_tokens=False).ids


def test_other_ids_are_an_error(monkeypatch):
    whole, special, plain = packing._encoders(packing.TOKENS)

    class Odd:
        def encode_ordinary(self, text):
            return [1]

    monkeypatch.setattr(packing, "_encoders", lambda name: (whole, special, Odd()))
    monkeypatch.setattr(packing, "CHECKED", 1)
    with pytest.raises(ValueError, match="different ids"):
        packing.encode("some text")


def test_packing_places_every_piece_once(spark):
    rng = random.Random(6)
    texts = [prose(rng, rng.choice([3, 50, 400, 1500])) for _ in range(120)] + ODD_TEXTS
    got = [r.asDict() for r in packing.pack(packing.pieces(docs_of(spark, texts))).collect()]
    for i, t in enumerate(texts):
        ids = np.array([*packing.encode(t or ""), 2], "<u4")
        mine = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(len(mine))) and sum(r["length"] for r in mine) == len(ids)
        assert len(mine) == -(-len(ids) // 1024) and all(r["length"] == 1024 for r in mine[1:])
        for r in mine:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        assert [o for o, _ in sorted(parts)] == np.cumsum([0, *[n for _, n in sorted(parts)]])[:-1].tolist() and sum(n for _, n in parts) <= 1024
    assert packing.pack(packing.pieces(docs_of(spark, ["x"]).limit(0))).count() == 0


# --- op5


def edit_distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a):
        q = [i + 1]
        for j, y in enumerate(b):
            q.append(min(p[j] + (x != y), p[j + 1] + 1, q[j] + 1))
        p = q
    return p[-1]


def mutated(rng, t, most):
    for _ in range(rng.randint(0, most)):
        k = rng.randint(0, len(t))
        t = t[:k] + rng.choice(["", "x", "é"]) + t[k + rng.randint(0, 1) :]
    return t


def test_banded_edit_distance():
    rng = random.Random(7)
    for _ in range(4000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 12)))
        b = mutated(rng, a, 4) if rng.random() < 0.7 else "".join(rng.choice("abc") for _ in range(rng.randint(0, 12)))
        for most in (1, 2, 3):
            assert lines.distance(a, b, most) == min(most + 1, edit_distance(a, b))


def plain_line_classes(rows, edits, shortest):
    found = [(d, i, t) for d, text in rows for i, t in enumerate((text or "").split("\n")) if len(t) >= shortest]
    found.sort(key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    parent = list(range(len(found)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(found)):
        for j in range(i):
            if lines.distance(found[i][2], found[j][2], edits) <= edits:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {(d, i): (*found[root(k)][:2], root(k) == k) for k, (d, i, _) in enumerate(found)}


def test_line_classes_are_complete(spark):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(20, 60))) for _ in range(40)]
    texts = ["\n".join(mutated(rng, rng.choice(base), 4) for _ in range(rng.randint(0, 8))) for _ in range(110)] + [None, "", "\n\n", base[0]]
    # One line in many variants: more than SMALL share a hash.
    texts += [base[1][:12] + chr(97 + i % 26) + base[1][13:] + "z" * (i // 26) for i in range(60)]
    df = docs_of(spark, texts)
    got = {(r["doc_id"], r["line"]): (r["class_doc_id"], r["class_line"], r["kept"]) for r in lines.marked(df).collect()}
    assert got == plain_line_classes(list(enumerate(texts)), 2, lines.SHORTEST)
    left = {r["doc_id"]: r["text"] for r in lines.without_repeats(df).collect()}
    for i, t in enumerate(texts):
        kept = [x for k, x in enumerate((t or "").split("\n")) if got.get((i, k), (0, 0, True))[2]]
        changed = len(kept) < len((t or "").split("\n"))
        assert left.get(i) == (("\n".join(kept) if "".join(kept).strip() else None) if changed else t)


def test_lines_of_odd_rows(spark):
    df = spark.createDataFrame([(None, "a line that is long enough to count"), (None, "other\na line that is long enough to count"), (3, "a line that is long enough to count!"), (3, "a line that is long enough to count!")], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["text"]) for r in lines.without_repeats(df).collect()), key=str)
    assert got == [(3, "a line that is long enough to count!"), (3, "a line that is long enough to count!"), (None, "other")]
    assert lines.marked(docs_of(spark, ODD_TEXTS)).count() >= 2 and lines.marked(df.limit(0)).count() == 0


def test_lines_beside_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a line that is long enough to count\nx", "k"), (2, "a line that is long enough to count\ny", "k")], "doc_id long, text string, gone string")
    for c in ("of", "hash", "_gone", "_of", "GONE_"):
        df = df.withColumn(c, F.lit("k"))
    got = sorted(tuple(r) for r in lines.without_repeats(df).collect())
    assert got == [(1, "a line that is long enough to count\nx", *"kkkkkk"), (2, "y", *"kkkkkk")]


def test_lines_that_fill_much_of_the_table(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_MEMBERS", 10)
    texts = [f"the same line in many documents, {'!' * (i % 2)}\nline {i} of its own that nothing else is like {i * 7919}" for i in range(60)]
    got = {(r["doc_id"], r["line"]): (r["class_doc_id"], r["class_line"], r["kept"]) for r in lines.marked(docs_of(spark, texts)).collect()}
    assert got == plain_line_classes(list(enumerate(texts)), 2, lines.SHORTEST)


def test_every_line_has_a_row(spark):
    long = "a line that is long enough to count"
    texts = [f"All rights reserved.\n{long}\n\nx", f"x\nAll rights reserved.\n \t\n{long}!", "All rights reserved!\n", None, "", "y" * 24 + "\n" + " " * 24, "é\ud83d\ude00\né".encode("utf-16", "surrogatepass").decode("utf-16")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], r["line"]): (r["class_doc_id"], r["class_line"], r["kept"]) for r in lines.marked(docs, every=True).collect()}
    first = {}
    want = {(d, i): first.setdefault(x, (d, i)) if x.strip() else (d, i) for d, t in enumerate(texts) if t is not None for i, x in enumerate(t.split("\n"))}
    want[1, 3] = want[0, 1]  # one edit
    assert got == {k: (*c, c == k) for k, c in want.items()}


def test_line_dedup_covers_the_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    assert queries.op5_line_dedup(spark, sf).count() == sum(len(t.split("\n")) for t in texts if t is not None)


# --- op6


def test_nearest_is_exact(monkeypatch):
    monkeypatch.setattr(toxicity, "HEAD", 100)
    monkeypatch.setattr(toxicity, "BLOCK", 8)
    rng = np.random.default_rng(9)
    size, n, k = 620, 500, 10
    docs = []
    for i in range(n):  # in groups of like ones, so that bounds leave blocks out
        t = np.unique(np.concatenate([rng.integers(0, 60, 20) + 60 * (i % 10), rng.integers(600, 620, 5)])) if i % 50 else np.zeros(0, np.int64)
        w = (rng.random(len(t)) + 0.1) * np.where(t < 600, 1, 0.1)
        docs.append((t, (w / np.sqrt((w * w).sum())).astype(np.float32).astype(float) if len(w) else w))
    docs[5] = docs[15] = docs[25]  # ties
    index = toxicity.Index(docs, rng.integers(0, 2, n), np.arange(n), size)
    dense = np.zeros((n, size))
    for i, (t, w) in enumerate(docs):
        dense[i, t] = w
    scored = []
    add = toxicity.Index._search
    monkeypatch.setattr(toxicity.Index, "_search", lambda self, *a: scored.append(add(self, *a)) or scored[-1])
    queries = [*docs[:130], (np.zeros(0, np.int64), np.zeros(0))]
    doc, term, weight = (np.concatenate(x) for x in zip(*((np.full(len(t), i), t, w) for i, (t, w) in enumerate(queries))))
    for without in (None, np.arange(len(queries))):
        for i, (places, scores) in enumerate(index.nearest(doc, term, weight, len(queries), k, without)):
            cosine = (dense[:, queries[i][0]] @ queries[i][1]).round(9)
            if without is not None:
                cosine[i] = 0
            order = [j for j in np.lexsort((np.arange(n), -cosine)) if cosine[j] > 0][:k]
            assert places.tolist() == order and np.allclose(scores, cosine[order])
    whole = sum(((dense[:, t] @ w).round(9) > 0).sum() for t, w in queries)
    assert sum((x > 0).sum() for x in scored[: len(scored) // 2]) < whole  # blocks were left out
    index = pickle.loads(pickle.dumps(index))
    assert np.allclose(index.cosines(doc, term, weight, len(queries)), np.stack([dense[:, t] @ w for t, w in queries]))


def test_toxicity_learns_from_labels_only_where_it_may(spark):
    rng = random.Random(10)
    rows, labels = [], []
    for i in range(1200):
        toxic = rng.random() < 0.2
        text = " ".join("".join(rng.choices("abdeno", k=rng.randint(2, 7))) for _ in range(80)) + (" vile" + rng.choice(["ness", "ly", "r", "st"]) if toxic else "")
        rows.append((i, text, "en", "s", 0))
        if i % 2:
            labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows + [(5000, None, None, None, None), (5001, "", None, None, 0)], DOCS)
    table = spark.createDataFrame([*labels, (7, 1, None), (99999, 1, 1)], "doc_id long, quality int, toxic int")
    learn = F.expr(f"NOT ({queries.HELD_OUT})")
    got = {r["doc_id"]: r for r in toxicity.score(docs, toxicity.fit(docs, table, learn)).collect()}
    truth = {i: "vile" in t for i, t, *_ in rows}
    assert sum(truth[i] == bool(got[i]["predicted"]) for i in truth) / len(truth) > 0.98
    assert len(got) == 1202 and 0 <= got[5000]["score"] < 0.3 and got[5000]["score"] == got[5001]["score"]
    # Other labels of held-out rows change nothing.
    held = F.expr(queries.HELD_OUT)
    changed = table.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.fit(docs, changed, learn)).collect()}
    assert again == {i: r["score"] for i, r in got.items()}
    assert {r["doc_id"] for r in toxicity.keep_clean(docs, toxicity.fit(docs, table, learn)).collect()} == {i for i, r in got.items() if r["score"] < 0.3}


def test_toxicity_compares_whole_texts(spark):
    rng = random.Random(20)
    word = lambda: "".join(rng.choices("abdeno", k=rng.randint(3, 7)))
    rows = [(i, " ".join(word() for _ in range(30)) + (" vileness" if i % 4 == 0 and i != 8 else "")) for i in range(200)]
    rows += [(1000, rows[8][1]), (1001, "xyzzy " + rows[8][1]), (1002, "")]  # 8 is toxic and holds no marking term
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(200)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert all(got[i]["evidence"][0] == 8 for i in (8, 1000, 1001)) and got[1002]["evidence"] == []
    # The cosines are those of all terms, with document frequencies over all documents.
    found = {i: Counter(x for w in t.lower().split() for x in (w, *(f"{w[:p]}|" for p in toxicity.PREFIXES if len(w) > p))) for i, t in rows}
    df = Counter(x for c in found.values() for x in c)
    marks = int((model.idf > np.log(1 + len(rows)) + 1).sum())
    assert marks and model.vocabulary.size >= len({x for i in range(200) for x in found[i]})
    plain = {i: {x: (1 + np.log(n)) * np.log(1 + len(rows) / df[x]) for x, n in c.items()} for i, c in found.items()}
    norm = {i: np.sqrt(sum(w * w for w in v.values())) for i, v in plain.items()}
    for i in (1, 1000):  # neither holds a marking term, nor do the clean examples
        _, _, doc, term, count = next(model.vocabulary.documents(pa.array([dict(rows)[i]])))
        near = model.index.cosines(doc, term, model.weights(doc, term, count), 1)[0]
        clean = [k for k in range(200) if k % 4]
        want = [sum(w * plain[k].get(x, 0) for x, w in plain[i].items()) / norm[i] / norm[k] for k in clean]
        assert np.allclose(near[np.searchsorted(model.index.ids, clean)], want)


def test_toxicity_without_labels(spark):
    docs = docs_of(spark, ODD_TEXTS)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.score(docs, toxicity.fit(docs, none, F.lit(True))).collect()} == {0.0}
    one = spark.createDataFrame([(1, 1, 1), (2, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, one, F.lit(True))
    assert {r["score"] for r in toxicity.score(docs, model).collect()} == {0.0} and toxicity.keep_clean(docs, model).count() == docs.count()


# --- op7


def test_warc_round_trip(spark, tmp_path, monkeypatch):
    long = "<p>" + "é" * 200 + "</p>"
    rows = [(5, "http://a", long), (3, "http://b", long), (9, "http://c\r\nX: y", long), (1, None, "short"), (2, "u", "short"), (4, "u", None), (6, "u", ""), (7, "u", "z" * 500_000), (None, "u", long), (3, "http://b", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    path = str(tmp_path / "warc")
    warc.write_archives(pages, path, archive_bytes=300)
    got = sorted((tuple(r) for r in warc.read_archives(spark, path).collect()), key=str)
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        revisit = h == long and i != 3
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None))
    assert got == sorted(want, key=str)
    assert warc.round_trip(pages.limit(0)).count() == 0
    assert warc.broken_revisits(warc.read_archives(spark, path)).count() == 0
    odd = warc.read_archives(spark, path).withColumn("payload_digest", F.when(F.col("record_type") == "response", "x").otherwise(F.col("payload_digest")))
    assert [r["refers_to"] for r in warc.broken_revisits(odd).collect()] == [3]
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", 0)
    assert sorted((tuple(r) for r in warc.round_trip(pages).collect()), key=str) == got


def test_warc_reader_refuses_broken_archives():
    payload = b"x" * 300
    digest = hashlib.sha256(payload).hexdigest()
    good = warc.write_record(1, "u", payload, "response", None, digest, 300)
    assert [r.block for r in warc.read_records(io.BytesIO(good + good))] == [payload] * 2
    for bad in (good[:-9], warc.write_record(1, "u", payload, "response", None, "0" * 64, 300), zlib.compress(b"no gzip")):
        with pytest.raises((warc.WarcError, zlib.error)):
            list(warc.read_records(io.BytesIO(bad)))


def test_warc_reader_holds_little(monkeypatch):
    payload = b"spam and eggs " * 2_000_000  # 28 MB that inflate from a small file
    digest = hashlib.sha256(payload).hexdigest()
    archive = warc.write_info() + warc.write_record(1, "u", payload, "response", None, digest, len(payload)) + warc.write_record(2, "u", b"", "response", None, hashlib.sha256(b"").hexdigest(), 0) + warc._EMPTY
    sizes = []
    more = warc._Member._more
    monkeypatch.setattr(warc._Member, "_more", lambda self, most: sizes.append(out := more(self, most)) or out)
    found = list(warc.read_records(io.BytesIO(archive), keep=False))
    assert [(r.headers["warc-type"], r.length, r.block) for r in found] == [("warcinfo", len(warc.zlib.decompress(warc.write_info(), 31).split(b"\r\n\r\n", 1)[1]) - 4, b""), ("response", len(payload), b""), ("response", 0, b"")]
    assert found[1].digest == digest and max(map(len, sizes)) <= warc.CHUNK
    assert [r.offset for r in found] == [0, len(warc.write_info()), len(archive) - len(warc._EMPTY) - len(warc.write_record(2, "u", b"", "response", None, hashlib.sha256(b"").hexdigest(), 0))]


# --- op8


def plain_classes(seq, least):
    ids = sorted(seq)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if neardup.similarity(seq[a], seq[b], least) > 0:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def sequences(texts):
    out = {}
    for row, w in slices(pa.array(texts, pa.string())):
        values, first = neardup.sequence(w, neardup.SHINGLE)
        out |= {row + k: values[i:j] for k, (i, j) in enumerate(zip(first, first[1:]))}
    return out


def test_alignment_similarity():
    def common(a, b):
        p = [0] * (len(b) + 1)
        for x in a:
            q = [0]
            for j, y in enumerate(b):
                q.append(p[j] + 1 if x == y else max(p[j + 1], q[j]))
            p = q
        return p[-1]

    rng = np.random.default_rng(11)
    for _ in range(2000):
        x = rng.integers(0, 6, rng.integers(1, 14))
        y = np.delete(x, rng.integers(0, len(x))) if rng.random() < 0.5 and len(x) > 1 else rng.integers(0, 6, rng.integers(1, 14))
        n = common(x.tolist(), y.tolist())
        value = n / (len(x) + len(y) - n)
        for least in (0.0, 0.5, 0.8):
            assert neardup.similarity(x, y, least) == pytest.approx(value if value >= least else 0)


def test_near_duplicates_are_complete(spark):
    rng = random.Random(12)
    texts = []
    for _ in range(25):
        words = prose(rng, rng.randint(60, 200)).split()
        texts.append(" ".join(words))
        for _ in range(rng.randint(0, 8)):
            other = list(words)
            for _ in range(rng.randint(0, 5)):
                k = rng.randrange(len(other))
                other[k : k + rng.randint(0, 1)] = [f"n{rng.randint(0, 99)}"]
            texts.append(" ".join(other))
    passage = prose(rng, 50)
    texts += [passage + " " + prose(rng, 60) for _ in range(40)] + ODD_TEXTS + ["a b c", "a b c", "a b d"]
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs_of(spark, texts)).collect()}
    seq = sequences(texts)
    want = plain_classes({i: s for i, s in seq.items() if len(s)}, neardup.LEAST)
    want |= {i: i for i, s in seq.items() if not len(s)}
    assert got == want
    kept = neardup.representatives(docs_of(spark, texts))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, c in want.items() if i == c)


def test_near_duplicates_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL", 2)
    rng = random.Random(13)
    base = prose(rng, 100, 10**6).split()
    texts = []
    for _ in range(80):  # all pairs of these are near the threshold
        other = list(base)
        for _ in range(4):
            other[rng.randrange(100)] = f"n{rng.randint(0, 10**6)}"
        texts.append(" ".join(other))
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs_of(spark, texts)).collect()}
    assert got == plain_classes(sequences(texts), neardup.LEAST)


def test_near_duplicates_of_odd_rows(spark):
    t = "one two three four five six seven"
    df = spark.createDataFrame([(None, t), (4, t), (2, t), (None, "other text of some five words"), (2, t)], "doc_id long, text string")
    got = sorted((tuple(r)[:2] for r in neardup.classes(df).collect()), key=str)
    assert got == sorted([(None, 2), (4, 2), (2, 2), (None, None), (2, 2)], key=str)
    assert neardup.classes(df.limit(0)).count() == 0
    assert sorted((tuple(r) for r in neardup.representatives(df).collect()), key=str) == sorted([(2, t), (None, "other text of some five words")], key=str)


def test_near_duplicates_with_repeated_ids(spark):
    rng = random.Random(22)
    a, b = (" ".join(f"{c}{rng.randint(0, 10**6)}" for _ in range(80)) for c in "ab")
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (None, a + " other"), (None, "q " + b)]
    df = spark.createDataFrame([(i, t, "clash", "clash", "clash") for i, t in rows], "doc_id long, text string, _id string, gone string, node string")
    got = sorted((r["class_id"] for r in neardup.classes(df).collect()), key=str)
    assert got == [1] * 6
    kept = neardup.representatives(df).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted([(1, a), (1, b)]) and {r["_id"] for r in kept} == {r["gone"] for r in kept} == {"clash"}


def test_components(spark):
    rng = random.Random(14)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, 2000 + i) for i in range(1, 50)]
    parent = {x: x for e in edges if e[0] != e[1] for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- op9

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def test_base_patterns_match_the_plain_ones():
    rng = random.Random(15)
    for _ in range(20000):
        t = "".join(rng.choice("a@.-1 2") for _ in range(rng.randint(0, 25)))
        found = pii.base_spans(t)
        assert [x[1:] for x in found if x[0] == "email"] == [m.span() for m in EMAIL.finditer(t)]
        assert [x[1:] for x in found if x[0] == "ip"] == [m.span() for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]


@pytest.mark.parametrize(
    ("text", "kind", "shown"),
    [
        ("mail bob [at] mail8 (dot) example dot com now", "email", "bob [at] mail8 (dot) example dot com"),
        ("to bob at mail dot example dot com.", "email", "bob at mail dot example dot com"),
        ("john＠ex.com", "email", "john＠ex.com"),
        ("ask jo.d @ mail . example . com today", "email", "jo.d @ mail . example . com"),
        ("jo(at)mail[dot]com", "email", "jo(at)mail[dot]com"),
        ("call plus one two seven four five five five nine six two nine please", "phone", "plus one two seven four five five five nine six two nine"),
        ("card ４０４１８９４９７４６０８７９５", "card", "４０４１８９４９７４６０８７９５"),
        ("é 10．0．0．1", "ip", "10．0．0．1"),
    ],
)
def test_disguises_map_back_to_the_source(text, kind, shown):
    spans = pii.all_spans(text, pii.base_spans(text))
    assert [(k, text[s:e]) for k, s, e in spans] == [(kind, shown)]


def test_disguises_are_found_whatever_else_the_text_holds(spark):
    cases = [*test_disguises_map_back_to_the_source.pytestmark[0].args[1], ("jane@example dot com", "email", "jane@example dot com"), ("jane@example&#46;com", "email", "jane@example&#46;com"), ("jane@mail DOT example\tdot\tcom", "email", "jane@mail DOT example\tdot\tcom"), ("jo%40mail.com", "email", "jo%40mail.com")]
    for end in ("", " \u2013", " " + "word " * 20_000 + "x (a) b" * 2_000):  # an en dash calls for the transducers by itself
        got = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame([(i, t + end) for i, (t, _, _) in enumerate(cases)], "doc_id long, text string")).collect()}
        assert got == {i: f"{kind}:{t.index(shown)}:{t.index(shown) + len(shown)}" for i, (t, kind, shown) in enumerate(cases)}


def test_numbers_of_figures_and_words(spark):
    bengali, thai = "".join(chr(0x9E6 + int(c)) for c in "4041894974608795"), "".join(chr(0xE50 + int(c)) for c in "10")
    cases = [
        ("call +1 274 five five five 9629 now", "phone", "+1 274 five five five 9629"),
        ("call plus 1 (two seven four) 555 9629 now", "phone", "plus 1 (two seven four) 555 9629"),
        ("call +one 274 555 96 two nine.", "phone", "+one 274 555 96 two nine"),
        ("card " + bengali, "card", bengali),
        (thai + ".0.0.1", "ip", thai + ".0.0.1"),
        ("call +1 274 555 9629 one time", "phone", "+1 274 555 9629"),
    ]
    got = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(cases)] + [(99, "one of 5 two 2 plus 3 under one")], "doc_id long, text string")).collect()}
    assert got == {i: f"{kind}:{t.index(shown)}:{t.index(shown) + len(shown)}" for i, (t, kind, shown) in enumerate(cases)} | {99: ""}


def test_disguises_without_lists(spark):
    cases = [
        ("jane at example dot shop", "email", "jane at example dot shop"),
        ("write jo.d at mail dot example dot museum today", "email", "jo.d at mail dot example dot museum"),
        ("host 192 dot 168 dot 1 dot 10 is up", "ip", "192 dot 168 dot 1 dot 10"),
        ("host one nine two dot one six eight dot one dot one is up", "ip", "one nine two dot one six eight dot one dot one"),
        ("zehn: eins null punkt null punkt null punkt sieben", "ip", "eins null punkt null punkt null punkt sieben"),
        ("s\u0131x.s\u0130x.\u017fix.1", "ip", "s\u0131x.s\u0130x.\u017fix.1"),
    ]
    clean = ["we looked at the dot of noon", "at home dot and then", "he stood at one dot and another", "at this point in time", "one dot two dot three", "version 1.2 point one", "plus one two three"]
    got = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(cases)] + [(100 + i, t) for i, t in enumerate(clean)], "doc_id long, text string")).collect()}
    assert got == {i: f"{kind}:{t.index(shown)}:{t.index(shown) + len(shown)}" for i, (t, kind, shown) in enumerate(cases)} | {100 + i: "" for i in range(len(clean))}


def test_the_trigger_hides_nothing():
    rng = random.Random(25)
    bits = ["at", "dot", "[at]", "(dot)", "@", " @ ", ".", "one", "Two", "six", "null", "oh", "plus", "+", "+1", "12", "7", "192", "point", "punkt", "jane", "mail", "com", "shop", "&#64;", "%40", "&#46;", "é", "４", "\u200b", "-", ",", "(", ")", "ſix", "s\u0130x", "\u212a"]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " ", " ", "  ", "\t"]) for _ in range(rng.randint(1, 14))) for _ in range(30000)]
    odd = pa.compute.match_substring_regex(pa.array(texts), pii.TRIGGER).to_pylist()
    assert 0.2 < sum(odd) / len(odd) < 1
    for t, o in zip(texts, odd):
        base = pii.base_spans(t)
        assert o or pii.all_spans(t, base) == base
        assert set(base) <= set(pii.all_spans(t, base))


def test_base_cards_and_phones_match_the_plain_ones():
    rng = random.Random(26)
    card, phone = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    digits = lambda t: re.sub("[^0-9]", "", t)
    hits = 0
    for _ in range(20000):
        t = "".join(rng.choice(["+", " ", "-", "(", ")", ".", "x", "4041894974608795", "4539 1488 0343 6467", *"0123456789" * 2]) for _ in range(rng.randint(1, 24)))
        found = pii.base_spans(t)
        cards = [m.span() for m in card.finditer(t) if 14 <= len(d := digits(m[0])) <= 19 and sum(int(c) if k % 2 == 0 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) for k, c in enumerate(reversed(d))) % 10 == 0]
        phones = [m.span() for m in phone.finditer(t) if 10 <= len(digits(m[0])) <= 15]
        assert [x[1:] for x in found if x[0] == "card"] == cards and [x[1:] for x in found if x[0] == "phone"] == phones
        hits += len(cards) + len(phones)
    assert hits > 1000


def test_pii_rows(spark):
    texts = ["x a@b.co y 4041894974608795 z +1 (274) 555-9629, 1.2.3.4", "plain words at the dot of noon", *ODD_TEXTS]
    got = {r["doc_id"]: r for r in pii.find(docs_of(spark, texts)).collect()}
    first = got[0]
    assert (first["n_email"], first["n_ip"], first["n_card"], first["n_phone"]) == (1, 1, 1, 1)
    assert first["base_sha256"] == hashlib.sha256(first["spans"].encode()).hexdigest()
    assert all(got[i]["spans"] == "" for i in range(1, len(texts)))
    assert pii.find(docs_of(spark, ["x"]).limit(0)).count() == 0


# --- op10


def plain_substrings(rows, window):
    docs = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first = {}
    for d, w in docs:
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, d), d)
    out = {}
    for d, w in docs:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        out[d] = (len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest())
    return out


def test_substrings_are_removed_exactly(spark):
    rng = random.Random(16)
    passages = [prose(rng, 60) for _ in range(6)]
    texts = [" ".join(rng.choice([passages[rng.randint(0, 5)], prose(rng, 40), "same " * 30]) for _ in range(rng.randint(1, 4))) for _ in range(150)]
    texts += ODD_TEXTS + ["very long " + "text " * 20_000, texts[0], texts[0]]
    got = {r[0]: tuple(r)[1:] for r in substrings.digests(substrings.marked(docs_of(spark, texts), chunk_bytes=20_000)).collect()}
    assert got == plain_substrings(list(enumerate(texts)), 13)


def test_substrings_of_odd_rows(spark):
    t = " ".join(f"w{i}" for i in range(20))
    df = spark.createDataFrame([(None, t), (1, t), (1, t), (2, t)], "doc_id long, text string")
    got = sorted(((r[0], r[2]) for r in substrings.digests(substrings.marked(df)).collect()), key=str)
    assert got == sorted([(None, 20), (1, 0), (1, 0), (2, 20)], key=str)
    assert substrings.digests(substrings.marked(df.limit(0))).count() == 0


def test_sketches_of_very_large_corpora_lose_nothing():
    rng = random.Random(23)
    docs = pa.table({"doc_id": pa.array(range(30)), "text": pa.array([prose(rng, 200, 10**6) for _ in range(30)])})
    chunk = substrings.Chunk(docs, 13)
    for bits in (20, 38, 42, 48, 60):
        plan = substrings.Plan(bits, 64, 13)
        for row in range(substrings.ROWS):
            known, several = chunk.sketch(plan, row)
            cells = plan.cells(chunk.keys, row)
            assert np.array_equal(known, np.unique(cells))
            documents = {}
            for c, r in zip(cells.tolist(), chunk.rows.tolist()):
                documents.setdefault(c, set()).add(r)
            assert several.tolist() == [len(documents[c]) > 1 for c in known.tolist()]
            assert plan.bounds(known)[-1] == len(known) and plan.low(0) == 0 and plan.low(64) == 1 << bits


# --- shared folder


def test_scratch_is_below_the_shared_folder_and_goes(spark):
    df = common.settled(spark.range(3), "x")
    assert df.count() == 3 and df.inputFiles()[0].removeprefix("file:").lstrip("/").startswith(common.shared_dir(spark).removeprefix("file:").lstrip("/"))
    common.clear(spark)
    assert not spark.sparkContext._jvm.java.io.File(common.own_dir(spark).removeprefix("file:")).exists()


def test_hot_keys_join_like_others(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_MEMBERS", 5)
    rows = spark.createDataFrame([(i, i % 7 if i % 3 else 100) for i in range(60)] + [(99, None)], "i long, k long")
    facts = rows.filter("k IS NOT NULL AND k <> 2").groupBy("k").agg(F.min("i").alias("least"), F.count("*").alias("members"))
    got = sorted(map(tuple, common.joined_by_key(rows, facts, ["k"], "members", 61).collect()), key=str)
    want = sorted(map(tuple, rows.join(facts.drop("members"), "k", "left").select("i", "k", "least").collect()), key=str)
    assert got == want and len(got) == 61


def test_messages_grow_with_the_input():
    for plan, since in ((lambda n: [substrings.planned(n)[1], substrings.planned(n)[0].shards], substrings.SINCE), (lambda n: [n // lines.planned(n).chunk, lines.planned(n).shards], lines.SINCE)):
        a, b = (np.prod([float(x) for x in plan(n)]) for n in (since * 2, since * 32))
        assert b / a < 16 * 1.5
