"""Registered queries without oracle SQL, on the smallest tables, against plain versions or the rules that they must keep."""

import re
import unicodedata

import numpy as np
import pytest

import __spark_entry__  # noqa: F401  (registers the queries)
from larder.functions import repair
from larder.operators import rows as W
from larder.plans import registry

SF = "/root/testdata/sf0.001"


def frame(spark, name):
    return registry.QUERIES[name](spark, SF).toPandas()


def given(spark, table):
    return spark.read.parquet(f"{SF}/{table}.parquet").toPandas()


def md5(text):
    import hashlib

    return hashlib.md5(text.encode()).hexdigest()


def ranks(values):
    order = np.argsort(values, kind="stable")
    sorted_ = np.asarray(values)[order]
    _, first, counts = np.unique(sorted_, return_index=True, return_counts=True)
    out = np.empty(len(values))
    out[order] = np.repeat(first + (counts + 1) / 2, counts)
    return out


def test_hold_suggestions(spark):
    """Strengths by hand: rank correlation and slope of numeric fields, gaps of means of the others."""
    d = given(spark, "lineitem")
    y, code = d["l_extendedprice"], d["l_returnflag"].map(d.groupby("l_returnflag")["l_extendedprice"].mean())
    fields = {r["field"]: r["score"] for _, r in frame(spark, "cmp_hold_suggestions").iterrows()}

    def strength(field, target):
        if d[field].dtype.kind == "f":
            rho = np.corrcoef(ranks(d[field].to_numpy()), ranks(target.to_numpy()))[0, 1]
            return abs(rho) + min(1, abs(np.polyfit(d[field], target, 1)[0]))
        means = target.groupby(d[field]).mean()
        return (means.max() - means.min()) * 100

    known = {"stratum": "l_linestatus", "x": "l_quantity", "l_discount": "l_discount", "l_tax": "l_tax"}
    for name, score in fields.items():
        column = known[name]
        assert score == pytest.approx(strength(column, y) + strength(column, code), rel=1e-6), name


def test_sampled(spark):
    got = frame(spark, "ord_sampled")
    again = frame(spark, "ord_sampled")
    assert len(got) == 50 and sorted(map(tuple, got.to_numpy().tolist())) == sorted(map(tuple, again.to_numpy().tolist())) and not got.duplicated().any()


def test_representatives(spark):
    part, got = given(spark, "part"), frame(spark, "ord_representatives")
    kinds = part["p_brand"].nunique()
    assert len(got) == min(60, len(part)) and not got["p_partkey"].duplicated().any()
    assert got["p_brand"].nunique() == min(60, kinds)


def test_normalised(spark):
    got = frame(spark, "txt_normalised").set_index("doc_id")
    for _, r in given(spark, "documents").iterrows():
        t = r["text"] or ""
        for bad, good in repair.MOJIBAKE:
            t = t.replace(bad, good)
        t = re.sub(r"[^\S\n]+", " ", unicodedata.normalize("NFKC", t).replace("\r\n", "\n").replace("\r", "\n"))
        assert got.loc[r["doc_id"], "t"] == md5("\n".join(x.strip() for x in t.split("\n")).strip())


def test_source_rows_keep_all_text(spark):
    """Rows stand in order in their lines, and together hold every character but blanks and separators."""
    got = frame(spark, "row_sources")
    for _, r in given(spark, "documents").iterrows():
        lines = r["text"].split("\n")
        mine = got[got["doc_id"] == r["doc_id"]].sort_values("row")
        assert mine["row"].tolist() == list(range(len(mine)))
        for block, part in mine.groupby("block"):
            text = lines[int(block)]
            pieces = W.split_text(text)
            assert part["t"].tolist() == [md5(p) for p in pieces]
            assert (part["start"].to_numpy()[1:] >= part["end"].to_numpy()[:-1]).all()
            bare = lambda s: re.sub(r"[\s,;]", "", s)
            assert bare("".join(pieces)) == bare(text)


def test_line_roles_of_all_lines(spark):
    got = frame(spark, "row_line_roles")
    want = {(r["doc_id"], i) for _, r in given(spark, "documents").iterrows() for i, t in enumerate(r["text"].split("\n")) if t.strip(" ")}
    assert set(zip(got["doc_id"], got["line"])) == want and (got["label"].isna() == got["reason"].isna()).all()


def test_atoms_hold_all_words(spark):
    got = frame(spark, "row_atoms")
    docs = given(spark, "documents")
    assert set(got["doc_id"]) == set(docs[docs["text"].str.strip() != ""]["doc_id"]) and set(got["kind"]) <= {"item", "paragraph"}
    one = docs[~docs["text"].str.contains("\n")].iloc[0]
    assert got[got["doc_id"] == one["doc_id"]]["t"].tolist() == [md5(re.sub(r"^(?:[-*•]|\d+[.)])\s+", "", " ".join(one["text"].split())))]


def test_segmented(spark):
    got = frame(spark, "step_segmented").set_index("doc_id")
    for _, r in given(spark, "documents").iterrows():
        lines = [" ".join(x.split()) for x in r["text"].split("\n") if x.strip()]
        if not got.loc[r["doc_id"], "needs"]:
            assert got.loc[r["doc_id"], "n"] == len(lines)


def test_containers(spark):
    got = frame(spark, "know_containers")
    for conv, part in given(spark, "conversations").groupby("conv_id"):
        n, known, want = -1, set(), []
        for _, r in part.sort_values("turn").iterrows():
            words, anchors = len(r["text"].split(" ")), set([w for w in re.split(r"[^a-z0-9]+", r["text"].lower()) if w][:3])
            if r["turn"] % 5 == 0 or n < 0 or (anchors and known and not anchors & known) or (not anchors and known and words > 25):
                n, known = n + 1, set()
            known |= anchors
            want.append(n)
        assert got[got["conv_id"] == conv].sort_values("turn")["container"].tolist() == want


def test_chunks_cover_their_blocks(spark):
    got = frame(spark, "know_chunks")
    for _, r in given(spark, "documents").iterrows():
        lines = [i for i, t in enumerate(r["text"].split("\n")) if t.strip(" ")]
        mine = got[got["doc_id"] == r["doc_id"]].sort_values("start")
        assert (mine["start"].tolist()[:1], mine["end"].tolist()[-1:]) == (lines[:1], lines[-1:]) and (mine["start"].to_numpy()[1:] > mine["end"].to_numpy()[:-1]).all()
    assert set(got["lane"]) <= {"knowledge", "noise"} and (got[got["lane"] == "noise"]["n"] == 0).all()


def test_tips_of_all_sentences(spark):
    got = frame(spark, "know_tips")
    assert set(got["scope"]) <= {"general", "recipe_specific", "not_tip"} and got["tipness"].between(0, 1).all() and got["generality"].between(0, 1).all()
    assert (got[got["tipness"] < 0.45]["scope"] == "not_tip").all()
    for _, r in given(spark, "documents").iterrows():
        parts = [x for x in re.split(r"(?<=[.!?])\s+(?=[A-Z0-9\"'])", re.sub(r"\s+", " ", r["text"])) if x.strip(" ")]
        assert (got["doc_id"] == r["doc_id"]).sum() == len(parts)


def test_predictions_label_every_row(spark):
    got, rows = frame(spark, "stage_predictions"), frame(spark, "row_sources")
    assert len(got) == len(rows) and got["label"].notna().all()
    assert set(zip(got["doc_id"], got["row"], got["t"])) == set(zip(rows["doc_id"], rows["row"], rows["t"]))


def test_page_elements_hold_the_blocks(spark):
    blocks, got = frame(spark, "src_html_blocks"), frame(spark, "src_page_elements")
    assert set(got["page_id"]) == set(blocks["page_id"]) and set(got["kind"]) <= {"Title", "ListItem", "Table", "NarrativeText", "Text"} and (got.groupby("page_id")["block"].max() + 1 == got.groupby("page_id").size()).all()
