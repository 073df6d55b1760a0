"""The pipeline, stage by stage on the smallest tables, each against a plain version on the same input."""

import re

import numpy as np

import corpus_pipeline
from larder.llm import lines, mixing, neardup, packing
from test_llm_operators import plain_classes, plain_line_classes, plain_mix, sequences

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    given = {r["doc_id"]: r.asDict() for r in docs.collect()}
    outputs = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        outputs[name] = [r.asDict() for r in docs.collect()]
        if name != "packing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
            assert all(r["n_chars"] == len(r["text"]) for r in outputs[name])
    # Clean documents stay.
    kept = {r["doc_id"]: r for r in outputs["toxicity"]}
    clean = [i for i, t in labels.items() if not t]
    assert sum(i in kept for i in clean) >= 0.95 * len(clean) and all(kept[i] == given[i] for i in kept)
    # Lines.
    found = plain_line_classes([(i, r["text"]) for i, r in kept.items()], lines.EDITS, lines.SHORTEST)
    want = {}
    for i, r in kept.items():
        left = [t for k, t in enumerate(r["text"].split("\n")) if found.get((i, k), (0, 0, True))[2]]
        if len(left) == len(r["text"].split("\n")):
            want[i] = r["text"]
        elif "".join(left).strip():
            want[i] = "\n".join(left)
    assert {r["doc_id"]: r["text"] for r in outputs["line_dedup"]} == want
    # Near duplicates.
    ids = sorted(want)
    seq = {ids[k]: s for k, s in sequences([want[i] for i in ids]).items()}
    classes = plain_classes({i: s for i, s in seq.items() if len(s)}, neardup.LEAST)
    assert sorted(r["doc_id"] for r in outputs["near_dedup"]) == [i for i in ids if classes.get(i, i) == i]
    # Mixing: the factors of a plain fit, and the draws that they allow.
    before = spark.read.parquet(str(tmp_path / "near_dedup"))
    mixed = mixing.mix(before).collect()
    factors = plain_mix([(r["mix_source"], r["mix_lang"], r["mix_topic"], r["mix_tokens"]) for r in mixed], mixing.SWEEPS, list(mixing.TEMPER.values()), mixing.KEEP)
    for r in mixed:
        assert abs(r["mix_factor"] - factors[r["mix_source"], r["mix_lang"], r["mix_topic"]]) < 1e-6
        assert r["mix_tokens"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    assert {r["doc_id"] for r in outputs["mixing"]} == {r["doc_id"] for r in mixed if r["mix_kept"]}
    # Packing.
    tokens = sum(len(packing.encode(r["text"])) + 1 for r in outputs["mixing"])
    fill = {}
    for p in outputs["packing"]:
        fill[p["sequence_id"]] = fill.get(p["sequence_id"], 0) + p["length"]
    assert sum(fill.values()) == tokens and max(fill.values()) <= 1024
    assert len(fill) <= np.ceil(tokens / 1024) * 1.05 + 2


def test_run_gives_the_stages_result(spark):
    got = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(got.columns) and got.count() > 0


def test_stages_on_odd_documents(spark):
    rows = [(None, "x " * 40, None, None, None), (1, None, "en", "a", 0), (2, "", "en", "a", 0), (2, "", "en", "a", 0), (3, "word " * 3000, "de", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for empty in (False, True):
        now = docs.limit(0) if empty else docs
        for _, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, SF)
        assert (now.count() > 0) != empty
