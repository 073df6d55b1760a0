"""The operators over their whole tables, with production parameters: op1 to op10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import fingerprints, lines, mixing, neardup, packing, pii, substrings, topk, toxicity, warc

ORACLE_SQL: dict[str, str] = {}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best candidates of every vector whose id is divisible by 20."""
    return topk.search(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


ORACLE_SQL["op1_topk"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text; see fingerprints.compare_edits."""
    return fingerprints.compare_edits(_read(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's factor, probability and draw at the default targets."""
    mixed = mixing.mix(_read(spark, sf_dir, "documents"))
    named = {"mix_source": "source", "mix_lang": "lang", "mix_topic": "topic", "mix_tokens": "n_tokens", "mix_kept": "kept"}
    rounded = [F.round(f"mix_{c}", 6).alias(c) for c in ("factor", "probability", "weight")]
    return mixed.select("doc_id", *(F.col(a).alias(b) for a, b in named.items()), *rounded)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 1024 ids."""
    return packing.pack(packing.pieces(_read(spark, sf_dir, "documents")))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every line of the documents, by its earliest line."""
    return lines.marked(_read(spark, sf_dir, "documents"), every=True).drop("doc_hash")


#: Whether a document's label is kept back.
HELD_OUT = "crc32(cast(doc_id AS string)) % 4 = 2"


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score, learnt from the labels that aren't held out."""
    docs = _read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _read(spark, sf_dir, "labels"), F.expr(f"NOT ({HELD_OUT})"))
    return toxicity.score(docs, model).select("doc_id", F.expr(HELD_OUT).alias("held_out"), "score", "predicted", "evidence")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through an archive and back; see warc.RECORD."""
    return warc.round_trip(_read(spark, sf_dir, "pages"))


ORACLE_SQL["op7_warc"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN f.first_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id <> p.page_id THEN f.first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near duplicates of every document."""
    return neardup.classes(_read(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document; see pii.RESULT."""
    return pii.find(_read(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without windows of earlier ones; see substrings.RESULT."""
    return substrings.digests(substrings.marked(_read(spark, sf_dir, "documents")))


ORACLE_SQL["op10_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
f AS (SELECT k, min(doc_id) AS first_id FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM (SELECT win.doc_id, win.i FROM win JOIN f USING (k) WHERE first_id < win.doc_id), range(0, 13) t(j)),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""


def _mixing_sql() -> str:
    """The default mix: the sweeps one after another, then three passes that narrow c down."""
    margins = ["source", "lang", "topic"]
    ctes = [
        r"""d AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, t, CAST(len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens,
        CASE WHEN t <> '' AND length(regexp_replace(t, '[^A-Z]', '', 'g')) * 10 >= length(t) * 3 THEN 'loud' WHEN length(t) < 500 THEN 'note' WHEN length(t) >= 10000 THEN 'book'
        WHEN (length(t) - length(replace(t, chr(10), ''))) * 200 >= length(t) THEN 'list' ELSE 'prose' END AS topic FROM (SELECT *, coalesce(text, '') AS t FROM documents))""",
        "w0 AS (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens, CAST(sum(n_tokens) AS DOUBLE) AS w FROM d GROUP BY ALL)",
    ]
    for m in margins:
        power = mixing.TEMPER[f"mix_{m}"]
        ctes.append(f"t_{m} AS (SELECT {m}, pow(sum(tokens), {power}) / sum(pow(sum(tokens), {power})) OVER () AS target FROM w0 GROUP BY {m})")
    for k, m in enumerate(margins * mixing.SWEEPS):
        ctes.append(f"w{k + 1} AS (SELECT w.source, w.lang, w.topic, tokens, coalesce(w * target / nullif(sum(w) OVER (PARTITION BY w.{m}), 0), 0) AS w FROM w{k} w JOIN t_{m} USING ({m}))")
    last = len(margins) * mixing.SWEEPS
    ctes.append(f"f AS (SELECT source, lang, topic, tokens, coalesce(w * (SELECT sum(tokens) / sum(w) FROM w{last}) / nullif(tokens, 0), 1.0) AS factor FROM w{last})")
    ctes.append("b0 AS (SELECT -20.0::DOUBLE AS low, 20.0::DOUBLE AS high)")
    for k in range(3):
        ctes.append(
            f"""s{k} AS (SELECT i, low + (high - low) * i / {mixing.STEPS} AS s, low, high FROM b{k}, range(0, {mixing.STEPS + 1}) r(i)), k{k} AS (SELECT i, s, sum(tokens * least(1, factor * pow(2, s))) AS kept, sum(tokens) AS tokens FROM s{k}, f GROUP BY i, s),
            n{k} AS (SELECT coalesce(min(i) FILTER (kept >= {mixing.KEEP} * tokens), {mixing.STEPS}) AS i FROM k{k}), b{k + 1} AS (SELECT (SELECT s FROM s{k} WHERE s{k}.i = greatest(n{k}.i - 1, 0)) AS low, (SELECT s FROM s{k} WHERE s{k}.i = n{k}.i) AS high FROM n{k})"""
        )
    ctes.append("p AS (SELECT source, lang, topic, factor, least(1.0, factor * pow(2, (SELECT high FROM b3))) AS probability FROM f)")
    draw = "CAST('0x' || left(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || sha256(t)), 13) AS BIGINT) / 4503599627370496.0"
    return f"WITH {', '.join(ctes)} SELECT doc_id, source, lang, topic, n_tokens, {draw} < probability AS kept, round(factor, 6) AS factor, round(probability, 6) AS probability, round(factor / probability, 6) AS weight FROM d JOIN p USING (source, lang, topic)"


ORACLE_SQL["op3_mixing"] = _mixing_sql()


QUERIES = {f.__name__: f for f in (op1_topk, op2_fingerprints, op3_mixing, op4_packing, op5_line_dedup, op6_toxicity, op7_warc, op8_near_dedup, op9_pii, op10_substring_dedup)}
