"""Lines that repeat up to a few edits: a segment-partition edit join, and removal of what repeats.

Lines of at least `shortest` code points take part in the edit join. Of two lines within `edits` (insertions, deletions and
substitutions of code points) at least one of edits + 1 even segments of the shorter line occurs unchanged
in the longer one, near its place. Every line indexes its segments under (number, length of line, hash) and
probes, for each length that is shorter by up to `edits`, the substrings that the multi-match-aware rule
leaves: 12 hashes a line for 2 edits. Classes are the connected components of the links; the earliest line of
a class, by doc_id and number, stays.

1. Tasks hash all substrings of their lines at once (prefix sums of code points), drop repeated lines, and
   send (hash, line) pairs to shards as packed arrays.
2. A shard sorts its pairs. Hashes that several lines share give candidate pairs; where more than `SMALL` lines
   share one, its lines go on to be compared in blocks of bounded size, behind a filter that no link fails: the
   distance of two histograms of code points is at most twice their edit distance. A block gives a spanning
   forest of its links, so no group is expanded into all pairs and none is left out.
3. Candidates are verified with a bit-parallel edit distance within the band of the threshold.

Line texts are fetched only for candidates. Lines are told apart by 64-bit hashes (some 2 * 10^-8 collisions
among a million lines, 2 among ten billion).

With `every`, `marked` gives a row for every line: shorter ones have classes of equal lines, by their hashes alone,
and a blank line is a class of its own.

Defined results. A null text has no lines; only "\\n" ends a line. Lines of code points 0x20 and 0x09-0x0D only are
blank if they are shorter than `shortest`. `without_repeats` leaves shorter lines, empty ones too, as they are. Rows with a null doc_id order last. Rows with equal doc_id and text are one document. Other columns are
ignored by `marked` and kept by `without_repeats`, whatever their names, which drops documents that lose all their text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import every as every_column, grown, joined_by_key, settled, unused
from larder.llm.components import components
from larder.llm.memory import lean, lean_group
from larder.llm.words import mixed

EDITS, SHORTEST = 2, 24
#: Lines that share a hash are paired directly up to so many; more are compared in blocks of so many.
SMALL, BLOCK = 16, 1024
#: Code points that a task hashes at once, and (hash, line) pairs of a shard. Every chunk sends each shard a message, so
#: beyond SINCE code points both grow with the root of the input, and the messages in proportion to it.
CHUNK, MOST_CHUNK = 2 << 20, 40 << 20
SHARD_ROWS, MOST_SHARD_ROWS, LEAST_SHARDS = 1 << 21, 40 << 20, 48
SINCE = 256 << 30
LANES = 64
#: Up to so many lines are fetched through a broadcast of their places (24 bytes each); beyond, by a shuffle.
BROADCAST_ROWS = 500_000
_ODD = 0x9E3779B97F4A7C15F39CC0605CEDC835 % 2**64 | 1
_INVERSE = pow(_ODD, -1, 2**64)


class Lines:
    """The lines of some texts that take part: place of each, and hashes of any of their substrings."""

    def __init__(self, texts: list[str | None], shortest: int):
        whole = "\n".join(t or "" for t in texts)
        self.points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.array([len(t or "") for t in texts], np.int64)
        first = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
        breaks = np.flatnonzero(self.points == 10)
        starts, ends = np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [len(self.points)]])
        doc = np.searchsorted(first, starts, "right") - 1
        number = np.arange(len(starts)) - np.searchsorted(starts, first)[doc]
        ok = ends - starts >= shortest
        self.starts, self.length, self.doc, self.number = starts[ok], (ends - starts)[ok], doc[ok], number[ok]
        value = mixed(self.points.astype(np.uint64) + np.uint64(0x51ED270B0A1F39C1))
        powers = np.full(len(value) + 1, _ODD, np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * powers[:-1], dtype=np.uint64)])
        back = np.full(len(value) + 1, _INVERSE, np.uint64)
        back[0] = 1
        self.back = np.multiply.accumulate(back)

    def hashes(self, start: np.ndarray, length: np.ndarray, salt: np.ndarray) -> np.ndarray:
        return mixed((self.sums[start + length] - self.sums[start]) * self.back[start] + salt.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))

    def shown(self) -> np.ndarray:
        """How many code points of each line aren't blank."""
        total = np.concatenate([[0], np.cumsum((self.points != 32) & ((self.points < 9) | (self.points > 13)))])
        return total[self.starts + self.length] - total[self.starts]

    def keys(self) -> np.ndarray:
        return self.hashes(self.starts, self.length, self.length + (1 << 32))


def segment(length: np.ndarray, i: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of the i-th of `parts` even segments; the last ones are longer by one where needed."""
    base, rest = length // parts, length % parts
    return i * base + np.maximum(0, i - (parts - rest)), base + (i >= parts - rest)


def signatures(lines: Lines, at: np.ndarray, edits: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(lines, hashes, whether they are the lines' own segments) of the lines at these indices."""
    length, starts, parts = lines.length[at], lines.starts[at], edits + 1
    for shorter in range(edits + 1):
        of = length - shorter
        for i in range(parts):
            place, size = segment(of, i, parts)
            low, high = max(-i, shorter - (edits - i)), min(i, shorter + (edits - i))
            for shift in range(low, high + 1):
                ok = np.flatnonzero((of >= parts) & (place + shift >= 0) & (place + shift + size <= length))
                yield at[ok], lines.hashes(starts[ok] + place[ok] + shift, size[ok], of[ok] * (parts + 1) + i), shorter == 0 and shift == 0


@dataclass(frozen=True)
class Plan:
    edits: int
    shortest: int
    shards: int
    every: bool = False
    chunk: int = CHUNK


def planned(size: int, edits: int = EDITS, shortest: int = SHORTEST, every: bool = False) -> Plan:
    """The plan for so many code points."""
    # 100 code points a line is few, so that shards are rather small.
    shards = max(LEAST_SHARDS, int(size / 100 * 4 * (edits + 1)) // grown(size, SINCE, SHARD_ROWS, MOST_SHARD_ROWS))
    return Plan(edits, shortest, shards, every, grown(size, SINCE, CHUNK, MOST_CHUNK))


def _chunks(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[tuple[list, list, list]]:
    """(ids, hashes, texts) of about `chunk` code points."""
    ids, hashes, texts, size = [], [], [], 0
    for batch in batches:
        for i, h, t in zip(batch.column("doc_id").to_pylist(), batch.column("doc_hash").to_pylist(), batch.column("text")):
            ids.append(i)
            hashes.append(h)
            texts.append(t.as_py())
            size += len(texts[-1] or "")
            if size >= chunk:
                yield ids, hashes, texts
                ids, hashes, texts, size = [], [], [], 0
    if ids:
        yield ids, hashes, texts


def _listed(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, hashes, texts in _chunks(batches, plan.chunk):
            x = Lines(texts, 0 if plan.every else plan.shortest)
            of = [pa.array(c, pa.int64()).take(pa.array(x.doc)) for c in (ids, hashes)]
            given = np.array([t is not None for t in texts])[x.doc]
            blank = (x.length < plan.shortest) & (x.shown() == 0)
            rows = pa.record_batch([*of, pa.array(x.number, pa.int32()), pa.array(x.keys().astype(np.int64), mask=blank)], ["doc_id", "doc_hash", "line", "key"])
            yield rows.filter(pa.array(given))

    return run


def _signed(plan: Plan):
    """Sorted (hash, key) pairs for each shard; the hash's lowest bit says that it's a segment of the line itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, texts in _chunks(batches, plan.chunk):
            x = Lines(texts, plan.shortest)
            keys = x.keys()
            at = np.unique(keys, return_index=True)[1]
            found = [((h & ~np.uint64(1)) | np.uint64(own), keys[i]) for i, h, own in signatures(x, at, plan.edits)]
            hashes, lines = (np.concatenate([np.zeros(0, np.uint64), *(f[k] for f in found)]) for k in range(2))
            order = np.argsort(hashes)
            hashes, lines = hashes[order], lines[order]
            edges = np.searchsorted((hashes >> np.uint64(32)) * np.uint64(plan.shards) >> np.uint64(32), np.arange(plan.shards + 1))
            out = [(s, zstandard.compress(np.concatenate([hashes[a:b], lines[a:b]]).tobytes(), 1)) for s, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
            yield pa.record_batch([pa.array([s for s, _ in out], pa.int32()), pa.array([b for _, b in out], pa.binary())], ["shard", "body"])

    return run


def _shared(rows: pa.Table) -> pa.Table:
    """Of a shard: pairs (a, b) of lines that share a hash, and for hashes of many lines (hash, line, how many)."""
    bodies = [np.frombuffer(zstandard.decompress(x.as_py()), np.uint64).reshape(2, -1) for x in rows["body"]]
    tagged, key = np.concatenate(bodies, axis=1)
    order = np.lexsort((~tagged & np.uint64(1), key, tagged >> np.uint64(1)))  # of equal pairs the own segment comes first
    tagged, key = tagged[order], key[order]
    code, own = tagged >> np.uint64(1), (tagged & np.uint64(1)).astype(bool)
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (key[1:] != key[:-1])
    code, key, own = code[new], key[new], own[new]
    start = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(code)))
    useful = (size > 1) & (np.add.reduceat(own, start) > 0) if len(start) else np.zeros(0, bool)
    few, many = useful & (size <= SMALL), np.repeat(useful & (size > SMALL), size)
    a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for d in range(1, SMALL):
        at = np.concatenate([start[few & (size > d)] + i for i in range(SMALL - d)]) if (few & (size > d)).any() else np.zeros(0, np.int64)
        at = at[at + d < len(code)]
        at = at[(code[at] == code[at + d]) & (own[at] | own[at + d])]
        a.append(key[at])
        b.append(key[at + d])
    a, b = np.concatenate(a).astype(np.int64), np.concatenate(b).astype(np.int64)
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
    n, m = pairs.shape[1], int(many.sum())
    none = lambda k: pa.nulls(k, pa.int64())
    return pa.table(
        {
            "a": pa.concat_arrays([pa.array(pairs[0]), none(m)]),
            "b": pa.concat_arrays([pa.array(pairs[1]), none(m)]),
            "code": pa.concat_arrays([none(n), pa.array(code[many].astype(np.int64))]),
            "key": pa.concat_arrays([none(n), pa.array(key[many].astype(np.int64))]),
            "members": pa.concat_arrays([none(n), pa.array(np.repeat(size, size)[many].astype(np.int64))]),
        }
    )


def distance(x: str, y: str, most: int) -> int:
    """The edit distance of two texts, or most + 1 where it's larger: bit-parallel, with matches in the band only."""
    if abs(len(x) - len(y)) > most:
        return most + 1
    k, low = min(len(x), len(y)), 0
    while low < k and x[low] == y[low]:
        low += 1
    k, tail = k - low, 0
    while tail < k and x[-1 - tail] == y[-1 - tail]:
        tail += 1
    x, y = x[low : len(x) - tail], y[low : len(y) - tail]
    if not x or not y:
        return min(most + 1, max(len(x), len(y)))
    where: dict[str, int] = {}
    for i, c in enumerate(x):
        where[c] = where.get(c, 0) | 1 << i
    full, last, band = (1 << len(x)) - 1, 1 << len(x) - 1, (1 << 2 * most + 1) - 1
    up, down, score = full, 0, len(x)
    for j, c in enumerate(y):
        match = where.get(c, 0) & (band << j - most if j >= most else band >> most - j)
        diagonal = ((((match & up) + up) ^ up) | match | down) & full
        right, left = (down | ~(diagonal | up)) & full, diagonal & up
        score += bool(right & last) - bool(left & last)
        if score - (len(y) - 1 - j) > most:
            return most + 1
        right, left = (right << 1 | 1) & full, left << 1 & full
        up, down = (left | ~(diagonal | right)) & full, diagonal & right
    return min(score, most + 1)


def _linked(edits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = pa.array([distance(x, y, edits) <= edits for x, y in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist())], pa.bool_())
            yield pa.record_batch([batch.column(c).filter(ok) for c in ("a", "b")], ["a", "b"])

    return run


def _met(edits: int):
    """A spanning forest of the links within a block of lines, or between two."""

    def run(rows: pa.Table) -> pa.Table:
        keys, texts = rows["key"].to_numpy(), rows["text"].to_pylist()
        low = rows["block"].to_numpy() == rows["low"][0].as_py()
        size = np.array([len(t) for t in texts])
        counts = np.zeros((len(texts), LANES), np.int32)
        for i, t in enumerate(texts):
            counts[i] = np.bincount(np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) % LANES, minlength=LANES)
        left = np.flatnonzero(low)
        right = left if rows["high"][0].as_py() == rows["low"][0].as_py() else np.flatnonzero(~low)
        root = np.arange(len(keys))
        out: list[tuple[int, int]] = []
        for i in left:
            j = right[right > i] if right is left else right
            j = j[(root[j] != root[i]) & (np.abs(size[j] - size[i]) <= edits)]
            j = j[np.abs(counts[j] - counts[i]).sum(1) <= 2 * edits]
            for k in j:
                if root[k] != root[i] and distance(texts[i], texts[k], edits) <= edits:
                    out.append((int(keys[i]), int(keys[k])))
                    root[root == root[k]] = root[i]
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return run


_PAIR = "a long, b long"


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("doc_hash"), F.col("text").cast("string").alias("text"))


def marked(docs: DataFrame, edits: int = EDITS, shortest: int = SHORTEST, every: bool = False) -> DataFrame:
    """doc_id, doc_hash (of the text), line, class_doc_id, class_line, kept: the class of every line that takes part, or of every line, by its earliest line."""
    docs = _named(docs)
    plan = planned(docs.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0], edits, shortest, every)
    lines = settled(docs.mapInArrow(lean(_listed(plan)), "doc_id long, doc_hash long, line int, key long"), "lines")
    shared = docs.mapInArrow(lean(_signed(plan)), "shard int, body binary").groupBy("shard").applyInArrow(lean_group(_shared), "a long, b long, code long, key long, members long")
    shared = settled(shared, "shared")
    pairs = shared.filter("a IS NOT NULL").select("a", "b").distinct()
    crowds = shared.filter("code IS NOT NULL").select("code", "key", "members")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("key")).unionByName(crowds.select("key")).distinct()
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("doc_hash"), F.col("line"))
    # One row for each different line: its earliest place and how often it occurs.
    firsts = settled(lines.filter("key IS NOT NULL").groupBy("key").agg(F.min(order).alias("at"), F.count("*").alias("members")), "firsts")
    places = settled(firsts.join(wanted, "key", "left_semi").select("key", "at.doc_id", "at.doc_hash", "at.line"), "places")
    few = places.count() <= BROADCAST_ROWS
    texts = settled(_fetched(docs, F.broadcast(places) if few else places), "texts")
    text = lambda s: texts.select(F.col("key").alias(s), F.col("text").alias(f"text_{s}"))
    first = pairs.join(text("a"), "a").join(text("b"), "b").mapInArrow(lean(_linked(edits)), _PAIR)
    blocks = F.ceil(F.col("members") / F.lit(BLOCK)).cast("int")
    dealt = crowds.withColumn("block", F.pmod(F.xxhash64("key"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    second = dealt.join(texts, "key").groupBy("code", "low", "high").applyInArrow(lean_group(_met(edits)), _PAIR)
    roots = components(first.unionByName(second))
    # Only lines with company need their class's earliest line; the others are their own.
    classed = firsts.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("class", F.coalesce("root", "key"))
    earliest = classed.groupBy("class").agg(F.min("at").alias("first"), F.sum("members").alias("lines")).filter("lines > 1")
    known = settled(classed.join(earliest, "class").select("key", "members", F.col("first.doc_id").alias("class_doc_id"), F.col("first.doc_hash").alias("class_hash"), F.col("first.line").alias("class_line")), "classes")
    found = joined_by_key(lines, known, ["key"], "members", lines.count())
    alone = F.col("class_line").isNull()
    same = F.col("doc_id").eqNullSafe(F.col("class_doc_id")) & (F.col("doc_hash") == F.col("class_hash")) & (F.col("line") == F.col("class_line"))
    return found.select("doc_id", "doc_hash", "line", F.when(alone, F.col("doc_id")).otherwise(F.col("class_doc_id")).alias("class_doc_id"), F.coalesce("class_line", "line").alias("class_line"), (alone | same).alias("kept"))


def _fetched(docs: DataFrame, places: DataFrame) -> DataFrame:
    """key, text of the lines at these places."""
    at = places.select("key", F.col("doc_id").alias("at_id"), F.col("doc_hash").alias("at_hash"), "line")
    found = docs.join(at, docs["doc_id"].eqNullSafe(at["at_id"]) & (docs["doc_hash"] == at["at_hash"]))
    return found.select("key", F.get(F.split("text", "\n"), F.col("line")).alias("text")).dropDuplicates(["key"])


def without_repeats(docs: DataFrame, edits: int = EDITS, shortest: int = SHORTEST) -> DataFrame:
    """docs with the lines that repeat an earlier one removed; documents that lose all their text are dropped."""
    of, doc_hash, lines = unused(docs.columns, "of", "hash", "gone")
    gone = marked(docs, edits, shortest).filter("NOT kept").groupBy(F.col("doc_id").alias(of), F.col("doc_hash").alias(doc_hash)).agg(F.collect_set("line").alias(lines))
    joined = docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone[of]) & (F.xxhash64(docs["text"].cast("string")) == gone[doc_hash]), "left")
    left = F.array_join(F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains(F.col(lines), i.cast("int"))), "\n")
    text = F.when(F.col(lines).isNull(), F.col("text")).otherwise(left)
    return joined.withColumn("text", text).filter(F.col(lines).isNull() | F.col("text").rlike(r"\S")).select(*every_column(docs))
