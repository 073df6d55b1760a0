"""Removal of word windows that an earlier document holds, with a count-min prefilter.

1. Documents are dealt by id into chunks of about `chunk_bytes`. Each chunk sketches its distinct
   windows: `ROWS` cells per window, sorted and delta-coded, split by range of cells into shards.
2. A shard adds up the chunks' cells and gives back to every chunk one bit per cell: estimated in more
   than one document or not. Estimates are never low, so no repeated window is lost here.
3. The chunks' windows whose every cell is set go to the shard of their 128-bit key with the smallest
   doc_id that the chunk has for them; the shard groups them exactly and answers with one bit each:
   an earlier chunk has it or not.
4. The chunk removes the words of the windows that some smaller doc_id starts.

What moves is the text once (all passes share one exchange), about 1.5 bytes per window and sketch row,
and 24 bytes for each distinct repeated window of a chunk. Nothing is broadcast or collected but two
counts; a window in a third of all documents is one entry per chunk. A chunk sends each shard one message,
so beyond `SINCE` bytes chunks and shards grow with the root of the input, and messages in proportion to it:
at 100 TB, chunks are of 192 MB and shards of 2^28 cells, whose tasks want some 3 GB of Python memory.

Defined results. A null text has no words; texts of under `window` words keep all. Rows with equal
doc_id aren't smaller than each other, so neither removes the other's words. A null doc_id is larger
than any other. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import grown, partitions
from larder.llm.memory import lean, lean_group, lean_pair
from larder.llm.words import mixed, slices

WINDOW = 13
#: Rows of the sketch, and cells of each row for every word of the corpus.
ROWS, CELLS_PER_WORD = 2, 8
CHUNK_BYTES, MOST_CHUNK_BYTES, LEAST_CHUNKS = 6 << 20, 192 << 20, 60
SHARD_CELLS, MOST_SHARD_CELLS, LEAST_SHARDS = 1 << 23, 1 << 28, 32
#: Bytes of text from which on chunks and shards grow.
SINCE = 32 << 30
#: Chunks of each partition of the exchange that all passes share.
TOGETHER = 8
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
_NO_ID = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Plan:
    """Sizes that all passes agree on: cells of a sketch row as a power of two, shards, words of a window."""

    cell_bits: int
    shards: int
    window: int

    def cells(self, keys: np.ndarray, row: int) -> np.ndarray:
        return mixed(keys + np.uint64(0x9E3779B97F4A7C15 * (row + 1) % 2**64)) >> np.uint64(64 - self.cell_bits)

    def low(self, shard: int) -> int:
        """The first cell of a shard."""
        return shard * (1 << self.cell_bits) // self.shards

    def bounds(self, row_cells: np.ndarray) -> np.ndarray:
        """Where each shard's part of some sorted cells begins, and the end."""
        edges = np.array([self.low(s) for s in range(1, self.shards)], np.uint64)
        return np.concatenate([[0], np.searchsorted(row_cells, edges), [len(row_cells)]])

    def shard_of(self, keys: np.ndarray) -> np.ndarray:
        """By the keys' high bits, so that sorted keys are sorted by shard."""
        return ((keys >> np.uint64(32)) * np.uint64(self.shards) >> np.uint64(32)).astype(np.int64)


def _pack(x: np.ndarray) -> bytes:
    """Sorted integers as deltas of the narrowest type."""
    deltas = np.diff(x, prepend=x[:1])
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if not len(deltas) or deltas.max() <= np.iinfo(k).max)
    head = np.array([np.dtype(kind).itemsize, x[0] if len(x) else 0], np.uint64).tobytes()
    return zstandard.compress(head + deltas.astype(kind).tobytes(), 1)


def _unpack(b: bytes) -> np.ndarray:
    raw = zstandard.decompress(b)
    size, first = np.frombuffer(raw, np.uint64, 2)
    return np.cumsum(np.frombuffer(raw, f"u{size}", offset=16).astype(np.uint64)) + first


class _Set:
    """Membership in some sorted cells: first a small bitmap of their high bits, then a binary search."""

    def __init__(self, members: np.ndarray, bits: int):
        self.members, self.shift = members, np.uint64(max(0, bits - 23))
        self.map = np.zeros(1 << min(bits, 23), bool)
        self.map[(members >> self.shift).astype(np.int64)] = True

    def holding(self, cells: np.ndarray) -> np.ndarray:
        """Indices of the cells that are members."""
        at = np.flatnonzero(self.map[(cells >> self.shift).astype(np.int64)])
        if not len(at):
            return at
        found = np.searchsorted(self.members, cells[at])
        return at[self.members[np.minimum(found, len(self.members) - 1)] == cells[at]]


class Chunk:
    """The windows of the documents of one chunk: their keys, documents and first words."""

    def __init__(self, docs: pa.Table, window: int):
        self.window = window
        self.ids = docs["doc_id"].fill_null(_NO_ID).to_numpy()
        self.counts = np.zeros(len(self.ids), np.int64)
        keys, rows, starts, words_seen, all_words = [], [], [], 0, []
        for row, words in slices(docs["text"]):
            n = words.counts
            self.counts[row : row + len(n)] = n
            hashes = words.hashes(0)
            at, key = words.runs(hashes, window, 0)
            keys.append(key)
            rows.append((np.repeat(np.arange(row, row + len(n)), n)[at]).astype(np.int32))
            starts.append(at + words_seen)
            all_words.append(hashes)
            words_seen += len(hashes)
        join = lambda x, kind: np.concatenate([np.zeros(0, kind), *x])
        self.keys, self.rows, self.starts, self.words = join(keys, np.uint64), join(rows, np.int32), join(starts, np.int64), join(all_words, np.uint64)

    def sketch(self, plan: Plan, row: int) -> tuple[np.ndarray, np.ndarray]:
        """The sorted cells of one sketch row, and which of them several documents of the chunk hit."""
        cells, places = plan.cells(self.keys, row), np.uint64(max(1, len(self.ids)).bit_length())
        if plan.cell_bits + int(places) <= 64:  # cell and document fit one sort key
            x = np.sort((cells << places) | self.rows.astype(np.uint64))
            x = x[np.flatnonzero(np.diff(x, prepend=x[:1] + np.uint64(1)))] >> places  # once for each document
        else:
            order = np.lexsort((self.rows, cells))
            cells, rows = cells[order], self.rows[order]
            once = np.ones(len(cells), bool)
            once[1:] = (cells[1:] != cells[:-1]) | (rows[1:] != rows[:-1])
            x = cells[once]
        new = np.flatnonzero(np.diff(x, prepend=x[:1] + np.uint64(1)))
        return x[new], np.diff(new, append=len(x)) > 1

    def repeated(self, plan: Plan, flagged: dict[int, np.ndarray]) -> np.ndarray:
        """Indices of the windows whose cell is flagged in every sketch row."""
        at = np.arange(len(self.keys))
        for row in range(ROWS):
            at = at[_Set(flagged[row], plan.cell_bits).holding(plan.cells(self.keys[at], row))] if len(flagged[row]) else at[:0]
        return at

    def second(self, at: np.ndarray) -> np.ndarray:
        """Another 64 bits of the windows' keys."""
        out, odd = np.zeros(len(at), np.uint64), np.uint64(0xD6E8FEB86659FD93)
        for k in range(self.window):
            out = out * odd + (self.words[self.starts[at] + k] ^ np.uint64(0xA5A5A5A5A5A5A5A5))
        return mixed(out)

    def entries(self, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of the windows at these indices: their order by key, where each distinct one starts, its two keys and smallest doc_id."""
        key, more = self.keys[at], self.second(at)
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        if (more[order][1:][same] != more[order][:-1][same]).any():
            order = np.lexsort((more, key))
        key, more = key[order], more[order]
        new = np.ones(len(order), bool)
        new[1:] = (key[1:] != key[:-1]) | (more[1:] != more[:-1])
        first = np.flatnonzero(new)
        doc = np.minimum.reduceat(self.ids[self.rows[at[order]]], first) if len(first) else np.zeros(0, np.int64)
        return order, first, key[first], more[first], doc


def _bits(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zstandard.decompress(packed), np.uint8), count=n).astype(bool)


def _packed_bits(x: np.ndarray) -> bytes:
    return zstandard.compress(np.packbits(x).tobytes(), 1)


_SKETCH = "chunk int, part int, shard int, body binary"
_FLAGS = "chunk int, kind int, shard int, body binary"


def _rows(chunk: list, part: list, shard: list, body: list, name: str = "part") -> pa.Table:
    return pa.table({"chunk": pa.array(chunk, pa.int32()), name: pa.array(part, pa.int32()), "shard": pa.array(shard, pa.int32()), "body": pa.array(body, pa.binary())})


def _sketched(plan: Plan):
    def run(docs: pa.Table) -> pa.Table:
        c, out = Chunk(docs, plan.window), ([], [], [], [])
        for row in range(ROWS):
            known, several = c.sketch(plan, row)
            edges = plan.bounds(known)
            for shard in range(plan.shards):
                a, b = edges[shard], edges[shard + 1]
                if b > a:
                    twice = _packed_bits(several[a:b])
                    for x, v in zip(out, (int(docs["chunk"][0].as_py()), row, shard, len(twice).to_bytes(4, "little") + twice + _pack(known[a:b]))):
                        x.append(v)
        return _rows(*out)

    return run


def _merged(plan: Plan):
    def run(parts: pa.Table) -> pa.Table:
        """All chunks' cells of one sketch row and shard: their sum, then each chunk's cells that reach two documents."""
        shard, row = parts["shard"][0].as_py(), parts["part"][0].as_py()
        low = plan.low(shard)
        counts = np.zeros(plan.low(shard + 1) - low + 2, np.uint8)
        bodies = [x.as_py() for x in parts["body"]]

        def cells(body: bytes) -> tuple[np.ndarray, np.ndarray]:
            n = int.from_bytes(body[:4], "little")
            known = _unpack(body[4 + n :])
            return known, _bits(body[4 : 4 + n], len(known))

        for body in bodies:
            known, twice = cells(body)
            at = (known - np.uint64(low)).astype(np.int64)
            counts[at] = np.minimum(counts[at] + 1 + twice, 2)
        out = []
        for body in bodies:
            known, _ = cells(body)
            out.append(_pack(known[counts[(known - np.uint64(low)).astype(np.int64)] > 1]))
        return _rows(parts["chunk"].to_pylist(), [row] * len(bodies), [shard] * len(bodies), out, "kind")

    return run


def _flagged(flags: pa.Table) -> dict[int, np.ndarray]:
    """Sorted flagged cells by sketch row."""
    found = sorted((k, s, b) for k, s, b in zip(flags["kind"].to_pylist(), flags["shard"].to_pylist(), flags["body"].to_pylist()) if k != EXACT)
    return {row: np.concatenate([np.zeros(0, np.uint64), *(_unpack(b) for k, _, b in found if k == row)]) for row in range(ROWS)}


def _gathered(plan: Plan):
    def run(docs: pa.Table, flags: pa.Table) -> pa.Table:
        out: tuple[list, list, list, list] = ([], [], [], [])
        if docs.num_rows:
            c = Chunk(docs, plan.window)
            _, _, key, more, doc = c.entries(c.repeated(plan, _flagged(flags)))
            edges = np.searchsorted(plan.shard_of(key), np.arange(plan.shards + 1))
            for s in range(plan.shards):
                a, b = edges[s], edges[s + 1]
                if b > a:
                    body = zstandard.compress(np.concatenate([key[a:b], more[a:b], doc[a:b].astype(np.uint64)]).tobytes(), 1)
                    for x, v in zip(out, (int(docs["chunk"][0].as_py()), 0, s, body)):
                        x.append(v)
        return _rows(*out)

    return run


#: Kind of the rows that hold the exact answers; smaller kinds are sketch rows.
EXACT = 100


def _grouped(parts: pa.Table) -> pa.Table:
    """Of one shard, for each chunk's entries: does another chunk have the window with a smaller doc_id?"""
    bodies = [np.frombuffer(zstandard.decompress(x.as_py()), np.uint64).reshape(3, -1) for x in parts["body"]]
    key, more, doc = np.concatenate(bodies, axis=1)
    doc = doc.astype(np.int64)
    order = np.lexsort((doc, more, key))
    new = np.ones(len(order), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (more[order][1:] != more[order][:-1])
    least = doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    earlier = np.zeros(len(order), bool)
    earlier[order] = least < doc[order]
    ends = np.cumsum([b.shape[1] for b in bodies])
    return _rows(parts["chunk"].to_pylist(), [EXACT] * len(bodies), parts["shard"].to_pylist(), [_packed_bits(earlier[e - b.shape[1] : e]) for e, b in zip(ends, bodies)], "kind")


def _removed(plan: Plan):
    def run(docs: pa.Table, flags: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "removed": pa.array([], pa.binary()), "n_words": pa.array([], pa.int64()), "text": pa.array([], pa.string())})
        c = Chunk(docs, plan.window)
        at = c.repeated(plan, _flagged(flags))
        order, first, key, _, doc = c.entries(at)
        answers = {s: b for k, s, b in zip(flags["kind"].to_pylist(), flags["shard"].to_pylist(), flags["body"].to_pylist()) if k == EXACT}
        earlier = np.zeros(len(first), bool)
        edges = np.searchsorted(plan.shard_of(key), np.arange(plan.shards + 1))
        for s in range(plan.shards):
            if n := edges[s + 1] - edges[s]:
                earlier[edges[s] : edges[s + 1]] = _bits(answers[s], n)
        entry = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
        at = at[order]
        gone = earlier[entry] | (c.ids[c.rows[at]] > doc[entry])
        at = at[gone]
        begin = np.concatenate([[0], np.cumsum(c.counts)])
        cover = np.bincount(c.starts[at], minlength=begin[-1] + 1) - np.bincount(c.starts[at] + plan.window, minlength=begin[-1] + 1)
        gone_words = np.cumsum(cover)[: begin[-1]] > 0
        masks = [np.packbits(gone_words[a:b]).tobytes() if gone_words[a:b].any() else b"" for a, b in zip(begin, begin[1:])]
        return pa.table({"doc_id": docs["doc_id"].cast(pa.int64()), "removed": pa.array(masks, pa.binary()), "n_words": pa.array(c.counts), "text": docs["text"].cast(pa.string())})

    return run


def planned(size: int, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES) -> tuple[Plan, int]:
    """The plan for texts of so many bytes, and how many chunks they make."""
    chunks = max(LEAST_CHUNKS, -(-size // grown(size, SINCE, chunk_bytes, max(chunk_bytes, MOST_CHUNK_BYTES))))
    cell_bits = max(20, int(size / 5 * CELLS_PER_WORD).bit_length())
    return Plan(cell_bits, max(LEAST_SHARDS, (1 << cell_bits) // grown(size, SINCE, SHARD_CELLS, MOST_SHARD_CELLS)), window), chunks


def marked(docs: DataFrame, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, text, n_words, removed: a bit for each word that an earlier document's window covers; empty for none."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    plan, chunks = planned(size, window, chunk_bytes)
    n = max(partitions(spark), -(-chunks // TOGETHER))
    base = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(chunks)).cast("int")).repartition(n, "chunk")
    sketches = base.groupBy("chunk").applyInArrow(lean_group(_sketched(plan)), _SKETCH)
    flags = sketches.groupBy("part", "shard").applyInArrow(lean_group(_merged(plan)), _FLAGS)
    entries = base.groupBy("chunk").cogroup(flags.groupBy("chunk")).applyInArrow(lean_pair(_gathered(plan)), _SKETCH)
    answers = entries.groupBy("shard").applyInArrow(lean_group(_grouped), _FLAGS)
    return base.groupBy("chunk").cogroup(flags.unionByName(answers).groupBy("chunk")).applyInArrow(lean_pair(_removed(plan)), "doc_id long, removed binary, n_words long, text string")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out, removed = [], np.zeros(len(batch), np.int64)
        for i, (text, mask) in enumerate(zip(batch.column("text"), batch.column("removed"))):
            words, mask = (text.as_py() or "").encode().split(), mask.as_py()
            if mask:
                gone = np.unpackbits(np.frombuffer(mask, np.uint8), count=len(words))
                removed[i] = gone.sum()
                words = compress(words, (gone == 0).tolist())
            out.append(hashlib.sha256(b" ".join(words)).hexdigest())
        yield pa.record_batch([batch.column("doc_id"), batch.column("n_words"), pa.array(removed), pa.array(out, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])


def digests(marks: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of the words that stay."""
    return marks.mapInArrow(lean(_digested), RESULT)
