"""Near-duplicate documents by order MinHash over word shingles, verified by banded alignment.

A document is the sequence of its runs of `shingle` words (all words, where it has fewer). Two documents are
near duplicates where the longest common subsequence of these sequences, L, gives L / (n + m - L) >= `least`.
Classes are the connected components, and copies with the same words are one node.

Order MinHash: shingles are labelled by their occurrence; each of `SKETCHES` random orders picks the `PICKED`
least, kept in text order. Documents whose picks agree in any sketch meet in a bucket. At the threshold a pair
meets in no bucket with a probability of about (1 - least^2)^SKETCHES, 5 in a million.

1. Every member of a bucket is compared to the bucket's first, shortest and longest document.
2. Where a bucket still holds several components, all its pairs across them are compared: by a join where it is
   small, else in blocks of bounded size, by length class. So no pair that meets is left out, and a large
   group of copies costs a few pairs a member.
3. A pair is excluded by lengths and by the distance of two histograms of hashed shingles, which the alignment
   distance cannot be under; the rest is aligned within the band that the threshold leaves.

Texts are shuffled only for documents in pairs that remain.

Nodes are the different texts (128-bit keys of their words), each by the place of one of its rows in the table
of sketches; doc_id only names results.

Defined results. Documents without words (null or empty too) have a class of their own. class_id is the least
doc_id of the class, null where none of its rows has one. Rows that share a doc_id are told apart by their texts.
Other columns are ignored; no documents give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import every, joined_by_key, settled, unused
from larder.llm.components import components
from larder.llm.memory import lean, lean_group
from larder.llm.words import Words, mixed, slices

SHINGLE, LEAST = 5, 0.8
SKETCHES, PICKED = 12, 2
LANES = 256
#: Buckets up to so many members are joined with themselves; larger ones are compared in blocks of so many.
SMALL, BLOCK = 8, 1024
#: Up to so many names of documents are broadcast (24 bytes each); beyond, the texts are shuffled.
BROADCAST_IDS = 500_000
_MOST = np.uint64(2**64 - 1)
_SKETCH = "doc_id long, doc_hash long, key1 long, key2 long, n int, lanes array<smallint>, sketches array<long>"


def sequence(words: Words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Of all texts: shingle hashes in text order, and where each text's begin (and the end)."""
    hashes = words.hashes(0)
    at, runs = words.runs(hashes, shingle, 3)
    counts = words.counts
    short = np.flatnonzero((counts > 0) & (counts < shingle))
    whole = [mixed(np.bitwise_xor.reduce(mixed(hashes[a:b] + np.arange(b - a, dtype=np.uint64)), keepdims=True)) for a, b in zip(words.first[short], words.first[short + 1])]
    of = np.concatenate([np.repeat(np.arange(len(counts)), counts)[at], short])
    values = np.concatenate([runs, *whole]) if len(short) else runs
    order = np.argsort(of, kind="stable")
    return values[order], np.searchsorted(of[order], np.arange(len(counts) + 1))


def _labelled(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Shingles with their occurrence in the text mixed in, so that repeats differ."""
    order = np.lexsort((np.arange(len(values)), values, of))
    v, o = values[order], of[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    rank = np.arange(len(v)) - np.maximum.accumulate(np.where(new, np.arange(len(v)), 0))
    out = values.copy()
    out[order] += rank.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(out)


def _picks(labelled: np.ndarray, first: np.ndarray, seed: int) -> np.ndarray:
    """Of each (non-empty) text: a hash of its PICKED least shingles in text order."""
    value = mixed(labelled ^ np.uint64((seed + 1) * 0xD1B54A32D192ED03 % 2**64))
    starts, lengths = first[:-1], np.diff(first)
    text = np.repeat(np.arange(len(starts)), lengths)
    places, left = [], value.copy()
    for _ in range(PICKED):
        low = np.minimum.reduceat(left, starts)
        hit = np.flatnonzero(left == low[text])
        hit = hit[np.unique(text[hit], return_index=True)[1]]  # the first of equals
        places.append(hit)
        left[hit] = _MOST
    out = np.zeros(len(starts), np.uint64)
    for place in np.sort(np.stack(places), axis=0):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + labelled[place])
    return mixed(out + np.uint64(seed))


def _sketched(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, words in slices(batch.column(2)):
                n = words.counts
                values, first = sequence(words, shingle)
                sizes = np.diff(first)
                full = np.flatnonzero(sizes)
                keys = np.zeros((2, len(n)), np.uint64)
                lanes, sketches = np.zeros((len(n), LANES), np.int16), np.zeros((len(n), SKETCHES), np.uint64)
                if len(full):
                    of = np.repeat(np.arange(len(n)), sizes)
                    starts = np.append(first[full], len(values))
                    place = (np.arange(len(values)) - np.repeat(first[:-1], sizes)).astype(np.uint64)
                    for k in range(2):
                        keys[k, full] = mixed(np.add.reduceat(mixed(values ^ mixed(place * np.uint64(2 * k + 3) + np.uint64(k))), first[full]) + n[full].astype(np.uint64))
                    lane = np.bincount(of * LANES + (values % np.uint64(LANES)).astype(np.int64), minlength=len(n) * LANES)
                    lanes = np.minimum(lane, 32767).astype(np.int16).reshape(len(n), LANES)
                    labelled = _labelled(values, of)
                    sketches[full] = np.stack([_picks(labelled, starts, s) for s in range(SKETCHES)], axis=1)
                ids, hashes = (batch.column(c).slice(row, len(n)) for c in (0, 1))
                lists = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
                yield pa.record_batch([ids, hashes, pa.array(keys[0].astype(np.int64)), pa.array(keys[1].astype(np.int64)), pa.array(sizes, pa.int32()), lists(lanes), lists(sketches.astype(np.int64))], ["doc_id", "doc_hash", "key1", "key2", "n", "lanes", "sketches"])

    return run


def room(n: int, least: float) -> int:
    """The alignment distance that documents of n shingles together may have."""
    return int(n * (1 - least) / (1 + least) + 1e-9)


def similarity(x: np.ndarray, y: np.ndarray, least: float = 0.0) -> float:
    """L / (n + m - L) for the longest common subsequence of two sequences; 0 where it's under `least`."""
    n, m = len(x), len(y)
    if not n or not m or min(n, m) < least * max(n, m):
        return 0.0
    k = min(n, m)
    same = x[:k] == y[:k]
    head = k if same.all() else int(same.argmin())
    same = x[n - (k - head) :][::-1] == y[m - (k - head) :][::-1]
    tail = len(same) if same.all() else int(same.argmin())
    a, b = x[head : n - tail], y[head : m - tail]
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    most = head + tail + int(np.minimum(ca[i], cb[j]).sum())
    if most < least * (n + m - most):
        return 0.0
    common = head + tail + (_aligned(a.tolist(), b.tolist(), room(n + m, least)) if len(i) else 0)
    value = common / (n + m - common)
    return value if value >= least else 0.0


def _aligned(a: list[int], b: list[int], band: int) -> int:
    """The longest common subsequence with places at most `band` apart, a bit for each place of a."""
    where: dict[int, int] = {}
    for i, v in enumerate(a):
        where[v] = where.get(v, 0) | 1 << i
    full = (1 << len(a)) - 1
    state, width = full, (1 << 2 * band + 1) - 1
    for j, v in enumerate(b):
        match = where.get(v)
        if match:
            match &= width << j - band if j >= band else width >> band - j
            kept = state & match
            state = ((state + kept) | (state - kept)) & full
    return len(a) - state.bit_count()


def _may_link(least: float):
    """Pairs that neither lengths nor histograms exclude."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(c).to_numpy().astype(np.int64) for c in ("n_a", "n_b"))
            x, y = (batch.column(c).flatten().to_numpy().reshape(-1, LANES).astype(np.int32) for c in ("lanes_a", "lanes_b"))
            ok = (np.minimum(n, m) >= least * np.maximum(n, m)) & (np.abs(x - y).sum(1) <= (n + m) * (1 - least) / (1 + least) + 1e-9)
            yield pa.record_batch([batch.column("a").filter(pa.array(ok)), batch.column("b").filter(pa.array(ok))], ["a", "b"])

    return run


def _verified(shingle: int, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for c in ("text_a", "text_b"):
                parts: list[np.ndarray] = []
                for _, words in slices(batch.column(c)):
                    values, first = sequence(words, shingle)
                    parts += [values[i:j] for i, j in zip(first, first[1:])]
                sides.append(parts)
            ok = pa.array([similarity(x, y, least) > 0 for x, y in zip(*sides)], pa.bool_())
            yield pa.record_batch([batch.column("a").filter(ok), batch.column("b").filter(ok)], ["a", "b"])

    return run


_PAIR = "a long, b long"


def links(pairs: DataFrame, sketches: DataFrame, docs: DataFrame, shingle: int, least: float) -> DataFrame:
    """The pairs of nodes (a, b) that are near duplicates."""
    side = lambda s: sketches.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("lanes").alias(f"lanes_{s}"))
    left = settled(pairs.distinct().join(side("a"), "a").join(side("b"), "b").mapInArrow(lean(_may_link(least)), _PAIR), "pairs")
    wanted = left.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    named = settled(sketches.select("node", F.col("doc_id").alias("at_id"), F.col("doc_hash").alias("at_hash")).join(wanted, "node", "left_semi"), "named")
    at = F.broadcast(named) if named.count() <= BROADCAST_IDS else named
    texts = docs.join(at, docs["doc_id"].eqNullSafe(at["at_id"]) & (docs["doc_hash"] == at["at_hash"])).select("node", "text").dropDuplicates(["node"])
    text = lambda s: texts.select(F.col("node").alias(s), F.col("text").alias(f"text_{s}"))
    return settled(left.join(text("a"), "a").join(text("b"), "b").mapInArrow(lean(_verified(shingle, least)), _PAIR), "links")


def _met(least: float):
    """Within a block, or between two blocks, of one bucket: pairs across components that may link."""

    def run(rows: pa.Table) -> pa.Table:
        doc, root, n, block, own = (rows[c].to_numpy() for c in ("node", "root", "n", "block", "own"))
        lanes = rows["lanes"].combine_chunks().flatten().to_numpy().reshape(-1, LANES)
        low, level = rows["low"][0].as_py(), rows["level"][0].as_py()
        left = np.flatnonzero(block == low)
        right = left if rows["high"][0].as_py() == low else np.flatnonzero(block != low)
        out: tuple[list, list] = ([], [])
        for i in left:
            j = right[right > i] if right is left else right
            j = j[(root[j] != root[i]) & ((own[j] == level) | (own[i] == level))]
            total = n[j].astype(np.int64) + n[i]
            j, total = (x[np.minimum(n[j], n[i]) >= least * np.maximum(n[j], n[i])] for x in (j, total))
            far = np.abs(lanes[j].astype(np.int32) - lanes[i]).sum(1)
            j = j[far <= total * (1 - least) / (1 + least) + 1e-9]
            out[0].append(np.minimum(doc[j], doc[i]))
            out[1].append(np.maximum(doc[j], doc[i]))
        return pa.table({"a": np.concatenate([np.zeros(0, np.int64), *out[0]]), "b": np.concatenate([np.zeros(0, np.int64), *out[1]])})

    return run


def _left_pairs(buckets: DataFrame, sketches: DataFrame, roots: DataFrame, least: float) -> DataFrame:
    """Pairs across components that meet in a bucket."""
    rooted = buckets.join(roots.select("node", "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    # A level is a bucket's share of documents of a length class and the next smaller one; pairs of like length meet in one.
    own = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(1 / least)) + 1e-9)).cast("int")
    rooted = settled(rooted.withColumn("own", own).withColumn("level", F.explode(F.array(own, own + 1))), "rooted")
    sizes = rooted.groupBy("bucket", "level").agg(F.count("*").alias("members"), F.min("root").alias("r1"), F.max("root").alias("r2")).filter("r1 <> r2").select("bucket", "level", "members")
    open_ = rooted.join(sizes, ["bucket", "level"]).join(sketches.select("node", "lanes"), "node")
    small = open_.filter(F.col("members") <= SMALL).select("bucket", "level", "node", "root", "n", "own", "lanes")
    other = small.select("bucket", "level", *(F.col(c).alias(f"{c}2") for c in ("node", "root", "n", "own", "lanes")))
    near = (F.least("n", "n2") >= F.lit(least) * F.greatest("n", "n2")) & ((F.col("own") == F.col("level")) | (F.col("own2") == F.col("level")))
    far = F.aggregate(F.zip_with("lanes", "lanes2", lambda x, y: F.abs(x.cast("int") - y.cast("int"))), F.lit(0), lambda acc, v: acc + v)
    near = near & (far <= (F.col("n") + F.col("n2")) * F.lit((1 - least) / (1 + least)) + F.lit(1e-9))
    other = other.withColumnsRenamed({"bucket": "bucket2", "level": "level2"})
    same = (F.col("bucket") == F.col("bucket2")) & (F.col("level") == F.col("level2"))
    few = small.join(other, same & (F.col("node") < F.col("node2")) & (F.col("root") != F.col("root2")) & near).select(F.col("node").alias("a"), F.col("node2").alias("b"))
    blocks = F.ceil(F.col("members") / F.lit(BLOCK)).cast("int")
    large = open_.filter(F.col("members") > SMALL).withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    large = large.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    many = large.groupBy("bucket", "level", "low", "high").applyInArrow(lean_group(_met(least)), _PAIR)
    return few.unionByName(many)


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("doc_hash"), F.col("text").cast("string").alias("text"))


def _classed(docs: DataFrame, shingle: int, least: float) -> DataFrame:
    """doc_id, doc_hash, n, class_id, and first_id, first_hash: the row of the class that comes first, null for rows without company."""
    docs = _named(docs)
    found = settled(docs.mapInArrow(lean(_sketched(shingle)), _SKETCH).withColumn("row", F.monotonically_increasing_id()), "sketches")
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("doc_hash"))
    copies = settled(found.filter("n > 0").groupBy("key1", "key2").agg(F.min("row").alias("node"), F.min(order).alias("first"), F.count("*").alias("members")), "copies")
    sketches = settled(found.join(copies.select(F.col("node").alias("row")), "row", "left_semi").withColumnRenamed("row", "node"), "nodes")
    rows = sketches.select("node", "n", F.explode("sketches").alias("bucket"))
    # Copies are nearest to their original, which often is the first, the shortest or the longest.
    heads = rows.groupBy("bucket").agg(F.min("node").alias("h1"), F.max("node").alias("last"), F.min_by("node", "n").alias("h2"), F.max_by("node", "n").alias("h3")).filter("h1 <> last")
    buckets = settled(rows.join(heads.select("bucket", F.array_distinct(F.array("h1", "h2", "h3")).alias("heads")), "bucket"), "buckets")
    starred = buckets.select("node", F.explode("heads").alias("head")).filter("head <> node")
    first = links(starred.select(F.least("head", "node").alias("a"), F.greatest("head", "node").alias("b")), sketches, docs, shingle, least)
    second = links(_left_pairs(buckets.drop("heads"), sketches, components(first), least), sketches, docs, shingle, least)
    roots = components(first.unionByName(second))
    rooted = copies.join(roots, "node", "left").withColumn("class", F.coalesce("root", "node"))
    classes_ = rooted.groupBy("class").agg(F.min("first").alias("first"), F.sum("members").alias("documents")).filter("documents > 1")
    known = settled(rooted.drop("first").join(classes_, "class").select("key1", "key2", "members", F.col("first.doc_id").alias("first_id"), F.col("first.doc_hash").alias("first_hash")), "classes")
    joined = joined_by_key(found.select("doc_id", "doc_hash", "key1", "key2", "n"), known, ["key1", "key2"], "members", found.count())
    # Rows without words have the keys 0 and 0, which no text with words has but by chance.
    own = (F.col("n") == 0) | F.col("first_hash").isNull()
    first_of = lambda c: F.when(~own, F.col(c)).alias(c)
    return joined.select("doc_id", "doc_hash", "n", F.when(own, F.col("doc_id")).otherwise(F.col("first_id")).alias("class_id"), first_of("first_id"), first_of("first_hash"))


def classes(docs: DataFrame, shingle: int = SHINGLE, least: float = LEAST) -> DataFrame:
    """doc_id, class_id and n_shingles of every document."""
    return _classed(docs, shingle, least).select("doc_id", "class_id", F.col("n").alias("n_shingles"))


def representatives(docs: DataFrame, shingle: int = SHINGLE, least: float = LEAST) -> DataFrame:
    """docs without near duplicates: of each class the row of the least doc_id (of equal or no ids, one), whatever else docs holds.

    Documents without words stay.
    """
    found = settled(_classed(docs, shingle, least).filter("first_hash IS NOT NULL"), "classes")
    of, doc_hash, gone = unused(docs.columns, "of", "hash", "gone")
    first = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("doc_hash") == F.col("first_hash"))
    # Of the rows that come first, those that occur twice are cut down to one; all others of a class go.
    named = found.groupBy(F.col("doc_id").alias(of), F.col("doc_hash").alias(doc_hash)).agg(F.first(~first).alias(gone), F.count("*").alias("times")).filter(F.col(gone) | (F.col("times") > 1)).drop("times")
    named = settled(named, "gone")
    sized = F.broadcast(named) if named.count() <= BROADCAST_IDS else named
    same = docs["doc_id"].cast("long").eqNullSafe(sized[of]) & (F.xxhash64(docs["text"].cast("string")) == sized[doc_hash])
    marked = docs.join(sized, same, "left")
    once = marked.filter(F.col(gone).isNull()).select(*every(docs))
    return once.unionByName(marked.filter(~F.col(gone)).dropDuplicates([of, doc_hash]).select(*every(docs)))
