"""Order-independent document fingerprints: homomorphic multiset hashes of paragraphs.

Every paragraph (a line of the text) hashes to a wide vector of integers, and a text's fingerprint is the
sum of its paragraphs' vectors, each lane modulo a power of two. Equal multisets of paragraphs have equal
fingerprints in any order; a paragraph is inserted or deleted by adding or subtracting its vector.

The vector has two parts. Eight lanes modulo 2^32 hold a hash of the whole paragraph: they tell equality.
Further words modulo 2^48, three lanes of 16 bits each, count for 72 random bits how many of the paragraph's
phrases (up to three words, within a sentence) have the bit set; the count of phrases is a lane as well.
Two texts' likeness is the cosine of these centred counts, the share of phrases that they have in common. Lanes of
16 bits tell a centred count (twice the lane less the phrases, about the root of their number) up to 65535.

Everything is DataFrame expressions: phrases are exploded and summed by a hash aggregation that combines
before it shuffles, so one row of 30 numbers a text moves.

Defined results. A null text is empty. Equal fingerprints have likeness 1; otherwise a text without phrases
has likeness 0 to any other. Rows are ordered by doc_id, then text; null ids come last. With one row the
next document is the row itself. Other columns are ignored; no documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import partitions, whole_text

#: Phrases of up to three words; the last word of a sentence ends one.
PHRASE = r"(?:[^\s]*[^\s.!?][ \t]+){0,2}[^\s]+"
EQUAL_SEEDS = (11, 12, 13, 14)
#: Shifts of two hashes; each gives three lanes.
SHIFTS = [(21, i) for i in range(16)] + [(22, i) for i in range(8)]
_LANES = (1 << 32) | (1 << 16) | 1
_LOW, _WORD = 1 << 32, 1 << 48
#: Buckets of neighbouring documents for each shuffle partition.
BUCKETS = 4


def equality(text: Column) -> Column:
    """The eight lanes of whole paragraphs."""
    paragraphs = F.split(text, "\n")

    def lane(seed: int, high: bool) -> Column:
        part = lambda h: F.shiftrightunsigned(h, 32) if high else h.bitwiseAND(F.lit(_LOW - 1))
        total = F.aggregate(paragraphs, F.lit(0).cast("long"), lambda acc, p: acc + part(F.xxhash64(p, F.lit(seed))))
        return F.pmod(total, F.lit(_LOW))

    return F.array(*(lane(s, high) for s in EQUAL_SEEDS for high in (False, True)))


def phrases(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PHRASE), F.lit(0))


def _counted(phrase: Column) -> list[Column]:
    """Sums over phrases: how many there are, then the words of three lanes."""
    hashes = {seed: F.xxhash64(phrase, F.lit(seed)) for seed in {s for s, _ in SHIFTS}}
    lanes = [F.shiftright(hashes[s], i).bitwiseAND(F.lit(_LANES)) for s, i in SHIFTS]
    return [F.sum(F.when(phrase.isNotNull(), x).otherwise(F.lit(0).cast("long"))) for x in [F.lit(1).cast("long"), *lanes]]


def vectors(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys and the vector of the text (array of long), as `vector`; keys tell rows apart."""
    # In a step of its own: beside the generator it would be worked out for every phrase.
    known = rows.select(*keys, equality(F.col(text)).alias("_equal"), phrases(F.col(text)).alias("_all"))
    exploded = known.select(*keys, "_equal", F.explode_outer("_all").alias("_p"))
    sums = [s.alias(f"_{i}") for i, s in enumerate(_counted(F.col("_p")))]
    summed = exploded.groupBy(*keys, "_equal").agg(*sums)
    return summed.select(*keys, F.concat("_equal", F.array(*(F.pmod(F.col(f"_{i}"), F.lit(_WORD)) for i in range(len(sums))))).alias("vector"))


_MODULI = [_LOW] * 8 + [_WORD] * (1 + len(SHIFTS))


def inserted(a: Column, b: Column) -> Column:
    """The vector of the paragraphs of both."""
    return F.zip_with(F.zip_with(a, b, lambda x, y: x + y), F.array(*map(F.lit, _MODULI)), lambda s, m: F.pmod(s, m))


def deleted(a: Column, b: Column) -> Column:
    """The vector of a without the paragraphs of b."""
    return F.zip_with(F.zip_with(a, b, lambda x, y: x - y), F.array(*map(F.lit, _MODULI)), lambda s, m: F.pmod(s, m))


def written(vector: Column) -> Column:
    """The vector as a string."""
    digits = lambda part, n: F.array_join(F.transform(part, lambda x: F.lpad(F.lower(F.hex(x)), n, "0")), "")
    return F.concat(digits(F.slice(vector, 1, 8), 8), F.lit("-"), digits(F.slice(vector, 9, len(SHIFTS) + 1), 12))


def _centred(vector: Column) -> Column:
    """For each lane twice its count less the number of phrases, from what is known modulo 2^17."""
    n = F.element_at(vector, 9)
    lanes = F.flatten(F.transform(F.slice(vector, 10, len(SHIFTS)), lambda x: F.array(*(F.shiftright(x, 16 * i).bitwiseAND(F.lit(65535)) for i in range(3)))))
    return F.transform(lanes, lambda c: (F.pmod(2 * c - n + 65536, F.lit(131072)) - 65536).cast("double"))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the cosine of the centred counts."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda acc, v: acc + v)
    x, y = _centred(a), _centred(b)
    cosine = F.try_divide(dot(x, y), F.sqrt(dot(x, x) * dot(y, y)))
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(cosine, F.lit(0.0)))))


def with_next(docs: DataFrame) -> DataFrame:
    """bucket, place, doc_id, text, ahead, next_text: the next document by descending doc_id, the first after the last.

    Ids are dealt to buckets of neighbours between their quantiles; each bucket also gets the first document
    of the next one, in a last row that is `ahead`, so texts are shuffled once.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    spark = docs.sparkSession
    n = BUCKETS * partitions(spark)
    bounds = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n).alias("b")).first()["b"] or []
    edges = F.array(*(F.lit(b).cast("long") for b in sorted(set(bounds)))) if bounds else F.array().cast("array<long>")
    bucket = F.when(F.col("doc_id").isNull(), -1).otherwise(F.size(F.filter(edges, lambda b: b < F.col("doc_id"))))
    dealt = docs.withColumn("bucket", bucket)
    tops = sorted((tuple(r) for r in dealt.groupBy("bucket").agg(F.max("doc_id")).collect()), reverse=True)  # one row a bucket
    following = [(b, *tops[(i + 1) % len(tops)]) for i, (b, _) in enumerate(tops)]
    wanted = spark.createDataFrame(following, "owner int, bucket int, top long")
    heads = dealt.join(F.broadcast(wanted), (dealt["bucket"] == wanted["bucket"]) & dealt["doc_id"].eqNullSafe(wanted["top"])).groupBy(F.col("owner").alias("bucket"), "doc_id").agg(F.min("text").alias("text"))
    rows = dealt.withColumn("ahead", F.lit(False)).unionByName(heads.withColumn("ahead", F.lit(True)))
    order = Window.partitionBy("bucket").orderBy("ahead", F.desc_nulls_last("doc_id"), "text")
    return rows.select("bucket", F.row_number().over(order).alias("place"), "doc_id", "text", "ahead", F.lead("text").over(order).alias("next_text"))


def compare_edits(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint and that of its edited text, whose last third is the next document's beginning.

    The edited text's vector is the text's without the paragraphs from the cut on and with those that stand there instead.
    """
    rows = with_next(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    left, new = F.substring("text", F.lit(1), F.col("n_chars").cast("int") - third), F.substring("next_text", F.lit(1), third)
    rows = rows.withColumn("left", left).withColumn("new", new)
    begun = F.substring_index("left", "\n", -1)
    gone = F.concat(begun, F.substring("text", F.col("n_chars").cast("int") - third + 1, third))
    parts = F.array(F.struct(F.lit(0).alias("k"), F.col("text").alias("t")), F.struct(F.lit(1).alias("k"), gone.alias("t")), F.struct(F.lit(2).alias("k"), F.concat(begun, "new").alias("t")))
    rows = rows.withColumn("edited_sha256", F.sha2(F.concat("left", "new").cast("binary"), 256)).withColumn("parts", F.when(F.col("ahead"), F.slice(parts, 1, 1)).otherwise(parts))
    keys = ["bucket", "place", "ahead", "doc_id", "n_chars", "edited_sha256"]
    found = vectors(rows.select(*keys, F.explode("parts").alias("part")).select(*keys, "part.k", "part.t"), [*keys, "k"], "t")
    found = found.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("k", "vector"))).alias("v"))
    vector = lambda k: F.get("v", F.lit(k))["vector"]
    following = F.lead(vector(0)).over(Window.partitionBy("bucket").orderBy("place"))
    found = found.select(*keys, vector(0).alias("text"), vector(1).alias("gone"), vector(2).alias("come"), following.alias("following")).filter("NOT ahead")
    found = found.withColumn("edited", inserted(deleted(F.col("text"), F.col("gone")), F.col("come")))
    return found.select("doc_id", "n_chars", "edited_sha256", written(F.col("text")).alias("fingerprint"), written(F.col("edited")).alias("edited_fingerprint"), likeness(F.col("text"), F.col("edited")).alias("near_edited"), likeness(F.col("text"), F.col("following")).alias("near_next"))
