"""Exact inner-product search by pivot tables.

A bounded sample gives pivots, by farthest-first choice. Every vector's distances to all pivots (and to
the origin) are computed once. For a query q and a candidate x, |d(q, p) - d(x, p)| over the pivots p
bounds their distance from below, and so q.x = (|q|^2 + |x|^2 - d(q, x)^2) / 2 from above.

1. The k-th best score within the sample is where each query starts: sampled rows are candidates, so it is
   never too high. The sample decides speed only.
2. Candidates are dealt to cells by their nearest pivot, large cells to several blocks by a hash of the id. A first
   pass finds each cell's least and greatest distance to every pivot; a query isn't sent to a cell whose bound is
   under its start.
3. Queries meet a block's candidates in one task. These are evaluated in tiles, highest bound first, until the next
   tile's bound is under every query's k-th best score. Scores are exact integers.

Every pair of query and candidate is either evaluated or excluded by a bound. Candidates are shuffled once for each
`QUERIES` queries, queries once for each block that may hold one of their best, and each block gives at most k rows a
query. Pairs, and so the work where bounds exclude nothing, grow with the square of the table, as in any exact search;
blocks grow with it up to `MOST_CANDIDATES`.

Defined results. Rows with a null id, a null vector, or a null or non-finite component take no part.
Vectors of different lengths don't meet. A candidate with the query's id is its own row. Queries of one id and
different vectors are ranked each by itself; repeated ones give repeated ranks only once. Scaled components saturate
at 2^62 and scores at the ends of 64 bits. Empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.memory import lean, lean_pair

K = 20
SCALE = 64
#: Rows that are looked at to choose pivots and starting scores (an eighth of the table within these bounds), and how many pivots are chosen.
SAMPLE, MOST_SAMPLE, PIVOTS = 2048, 16384, 16
#: Candidates of a block (a 24th of the table within these bounds) and queries that meet in one task.
CANDIDATES, MOST_CANDIDATES, QUERIES = 4096, 32768, 16384
_QUERY_TILE, _CANDIDATE_TILE = 256, 512
_LIMIT = 1 << 62
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1
_COARSE = "vec_id long, same long, dim int, vec binary, near binary, start long, block int"


def quantised(embedding: pa.Array, scale: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows that take part, and their vectors floor(scale * x) as integers."""
    if not len(embedding):
        return np.zeros(0, np.int64), []
    ends = embedding.offsets.to_numpy()
    values = np.asarray(embedding.values.to_numpy(zero_copy_only=False), np.float64)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    ok = embedding.is_valid().to_numpy(zero_copy_only=False) & (bad[ends[1:]] == bad[ends[:-1]])
    with np.errstate(over="ignore", invalid="ignore"):
        whole = np.clip(np.nan_to_num(np.floor(values * scale)), -_LIMIT, _LIMIT).astype(np.int64)
    rows = np.flatnonzero(ok)
    return rows, [whole[ends[i] : ends[i + 1]] for i in rows]


def _packed(v: np.ndarray) -> bytes:
    return (v.astype(np.int32) if len(v) and np.abs(v).max() < 1 << 31 else v).tobytes()


def _stacked(dim: int, vectors: list[bytes]) -> np.ndarray:
    """Integers of 4 or 8 bytes, whatever a row has."""
    if all(len(v) == 4 * dim for v in vectors):
        return np.frombuffer(b"".join(vectors), np.int32).reshape(len(vectors), dim)
    return np.stack([np.frombuffer(v, np.int32 if len(v) == 4 * dim else np.int64).astype(np.int64) for v in vectors])


def _exact(x: np.ndarray, y: np.ndarray) -> type:
    """The fastest type whose inner products are exact for these integers."""
    tops = [int(np.abs(m).max(initial=0)) for m in (x, y)]
    most = max(tops[0] * tops[1] * x.shape[1], *tops)
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64 if most < 2**63 else object


def _products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of matrices of a type that _exact() gives, held to 64 bits."""
    s = x @ y.T
    return np.clip(s, _LOW, _HIGH).astype(np.int64) if s.dtype == object else s.astype(np.int64)


class Pivots:
    """Pivots for each vector length, and the sample they come from."""

    def __init__(self, ids: np.ndarray, vectors: list[np.ndarray], pivots: int):
        self.sample: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.pivots: dict[int, np.ndarray] = {}
        for dim in {len(v) for v in vectors}:
            at = [i for i, v in enumerate(vectors) if len(v) == dim]
            x = np.stack([vectors[i] for i in at])
            self.sample[dim] = ids[at], x.astype(np.int32) if np.abs(x).max(initial=0) < 1 << 31 else x
            chosen, far = [np.zeros(dim)], (x.astype(np.float64) ** 2).sum(1)
            while len(chosen) <= pivots and far.max(initial=0) > 0:
                chosen.append(x[int(far.argmax())].astype(np.float64))
                far = np.minimum(far, ((x - chosen[-1]) ** 2).sum(1))
            self.pivots[dim] = np.stack(chosen)

    def near(self, x: np.ndarray) -> np.ndarray:
        """Distances to the pivots; the first is the norm."""
        p = self.pivots.get(x.shape[1], np.zeros((1, x.shape[1])))
        x = x.astype(np.float64)
        return np.sqrt(np.maximum((x * x).sum(1)[:, None] - 2 * x @ p.T + (p * p).sum(1), 0))

    def start(self, ids: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
        """A score that each query's k-th best is no lower than."""
        their, y = self.sample.get(x.shape[1], (np.zeros(0, np.int64), np.zeros((0, x.shape[1]), np.int32)))
        if len(their) <= k:
            return np.full(len(ids), _LOW)
        kind = _exact(x, y)
        s = _products(x.astype(kind), y.astype(kind))
        s[ids[:, None] == their[None, :]] = _LOW
        return np.partition(s, len(their) - k, axis=1)[:, len(their) - k]

    @staticmethod
    def cell(near: np.ndarray) -> np.ndarray:
        """The nearest pivot's number, 0 where there is the origin only."""
        return near[:, 1:].argmin(1) if near.shape[1] > 1 else np.zeros(len(near), np.int64)


def _by_dim(batch: pa.RecordBatch, scale: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of the rows of each vector length: the length, the rows and the vectors."""
    rows, vectors = quantised(batch.column(batch.schema.get_field_index("embedding")), scale)
    dims = np.array([len(v) for v in vectors], np.int64)
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        yield int(dim), rows[at], np.stack([vectors[i] for i in at])


def _measured(pivots: Pivots, scale: int):
    """Of each batch, its cells: how many vectors, and their least and greatest distances to the pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for dim, _, x in _by_dim(batch, scale):
                near = pivots.near(x)
                cell = pivots.cell(near)
                for c in np.unique(cell):
                    mine = near[cell == c]
                    out.append((dim, int(c), len(mine), mine.min(0).tolist(), mine.max(0).tolist()))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, kinds)], ["dim", "cell", "n", "low", "high"])

    return run


class Cells:
    """By vector length and cell: the first block and how many, and the bounds of the distances."""

    def __init__(self, rows: list, size: int):
        self.of: dict[int, dict[int, tuple[int, int, np.ndarray, np.ndarray]]] = {}
        block = 0
        for dim, cell, n, low, high in sorted(rows):
            many = -(-n // size)
            self.of.setdefault(dim, {})[cell] = block, many, np.array(low), np.array(high)
            block += many

    def block(self, dim: int, cell: np.ndarray, ids: np.ndarray) -> np.ndarray:
        first, many = (np.array([self.of[dim][int(c)][k] for c in cell], np.int64) for k in (0, 1))
        spread = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        return first + (spread % many.astype(np.uint64)).astype(np.int64)

    def met(self, dim: int, near: np.ndarray, start: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Every block with the queries whose start its cell's bound reaches."""
        for first, many, low, high in self.of.get(dim, {}).values():
            gap = np.maximum(np.maximum(low - near, near - high), 0).max(1)
            norms = near[:, 0] ** 2 + high[0] ** 2
            at = np.flatnonzero(np.maximum((norms - gap * gap) / 2 + 1e-9 * norms + 1e-6, _LOW) >= start)
            if len(at):
                for b in range(first, first + many):
                    yield b, at


def _coarse(pivots: Pivots, cells: Cells, scale: int, k: int | None):
    """Candidates with their block, or (with k) queries once for each block that they must meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["vec_id", "same", "dim", "vec", "near", "start", "block"]
        for batch in batches:
            ids, same = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("vec_id", "same"))
            for dim, rows, x in _by_dim(batch, scale):
                near = pivots.near(x)
                bodies, distances = np.array([_packed(v) for v in x], object), np.array([v.tobytes() for v in near], object)
                start = np.full(len(rows), _LOW) if k is None else pivots.start(ids[rows], x, k)
                parts = [(cells.block(dim, pivots.cell(near), ids[rows]), np.arange(len(rows)))] if k is None else cells.met(dim, near, start)
                for block, at in parts:
                    yield pa.record_batch([pa.array(ids[rows[at]]), pa.array(same[rows[at]]), pa.array(np.full(len(at), dim, np.int32)), pa.array(bodies[at].tolist(), pa.binary()), pa.array(distances[at].tolist(), pa.binary()), pa.array(start[at]), pa.array(np.broadcast_to(block, len(at)).astype(np.int32))], names)

    return run


class _Best:
    """The k best candidates so far of each of some queries."""

    def __init__(self, start: np.ndarray, k: int):
        self.k, self.least = k, start.copy()
        self.q, self.ids, self.scores = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        q, ids, scores = np.concatenate([self.q, q]), np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        order = np.lexsort((ids, -scores, q))
        q, ids, scores = q[order], ids[order], scores[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        keep = rank < self.k
        self.q, self.ids, self.scores = q[keep], ids[keep], scores[keep]
        full = rank == self.k - 1
        self.least[q[full]] = np.maximum(self.least[q[full]], scores[full])


def _searched(k: int):
    def run(cands: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if cands.num_rows and queries.num_rows:
            dim = cands["dim"][0].as_py()
            ids, x = cands["vec_id"].to_numpy(), _stacked(dim, cands["vec"].to_pylist())
            m = len(cands["near"][0].as_py()) // 8
            near = np.frombuffer(b"".join(cands["near"].to_pylist()), np.float64).reshape(-1, m)
            queries = queries.sort_by([("vec_id", "ascending"), ("same", "ascending")])
            asks = [queries[c].to_numpy() for c in ("vec_id", "same", "start")]
            all_q = _stacked(dim, queries["vec"].to_pylist())
            all_near = np.frombuffer(b"".join(queries["near"].to_pylist()), np.float64).reshape(-1, m)
            kind = _exact(x, all_q)
            typed = x.astype(kind)
            for a in range(0, len(all_q), _QUERY_TILE):
                qid, same, start = (c[a : a + _QUERY_TILE] for c in asks)
                at, found, scores = _tile(qid, all_q[a : a + _QUERY_TILE].astype(kind), all_near[a : a + _QUERY_TILE], ids, typed, near, start, k)
                out.append((qid[at], same[at], found, scores))
        q, same, c, s = (np.concatenate([np.zeros(0, np.int64), *(o[i] for o in out)]) for i in range(4))
        return pa.table({"query_id": q, "same": same, "vec_id": c, "score": s})

    return run


def _tile(qid, q, qn, ids, x, near, start, k):
    """Some queries against a block of candidates: places of queries, ids and scores."""
    low = np.abs(qn[:, None, 0] - near[None, :, 0])
    for p in range(1, near.shape[1]):
        np.maximum(low, np.abs(qn[:, None, p] - near[None, :, p]), out=low)
    norms = qn[:, None, 0] ** 2 + near[None, :, 0] ** 2
    bound = np.maximum((norms - low * low) / 2 + 1e-9 * norms + 1e-6, _LOW)  # above rounding
    best = _Best(start, k)
    order = np.argsort(-bound.max(0, initial=-np.inf), kind="stable")
    for a in range(0, len(order), _CANDIDATE_TILE):
        if (bound[:, order[a:]].max(1) < best.least).all():
            break
        at = order[a : a + _CANDIDATE_TILE]
        alive = np.flatnonzero((bound[:, at] >= best.least[:, None]).any(1))
        scores = _products(q[alive], x[at])
        i, j = np.nonzero((scores >= best.least[alive][:, None]) & (qid[alive][:, None] != ids[at][None, :]))
        best.add(alive[i], ids[at][j], scores[i, j])
    return best.q, best.ids, best.scores


def search(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, sample: int | None = None, pivots: int = PIVOTS, candidates: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: for each row that is a query, its k candidates of highest integer inner product."""
    rows = vectors.withColumn("_asks", F.coalesce(is_query, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), "_asks").filter("vec_id IS NOT NULL AND embedding IS NOT NULL")
    rows = rows.withColumn("same", F.xxhash64("embedding"))
    n, n_queries = rows.agg(F.count("*"), F.count_if("_asks")).first()
    sample = sample or min(MOST_SAMPLE, max(SAMPLE, n // 8))
    seen = rows.select("vec_id", "embedding").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toArrow()  # a bounded sample
    at, found = quantised(seen["embedding"].combine_chunks(), scale)
    table = Pivots(seen["vec_id"].to_numpy()[at], found, pivots)
    measured = rows.select("embedding").mapInArrow(lean(_measured(table, scale)), "dim int, cell int, n long, low array<double>, high array<double>")
    extreme = lambda f, c: F.array(*(f(F.get(c, F.lit(i))) for i in range(pivots + 1)))
    merged = measured.groupBy("dim", "cell").agg(F.sum("n").alias("n"), extreme(F.min, "low").alias("low"), extreme(F.max, "high").alias("high"))
    held = [(r["dim"], r["cell"], r["n"], [x for x in r["low"] if x is not None], [x for x in r["high"] if x is not None]) for r in merged.collect()]  # a row for each pivot
    cells = Cells(held, candidates or min(MOST_CANDIDATES, max(CANDIDATES, n // 24)))
    halls = max(1, -(-n_queries // QUERIES))
    cands = rows.select("vec_id", "same", "embedding").mapInArrow(lean(_coarse(table, cells, scale, None)), _COARSE).withColumn("hall", F.explode(F.sequence(F.lit(0), F.lit(halls - 1))))
    queries = rows.filter("_asks").dropDuplicates(["vec_id", "same"]).select("vec_id", "same", "embedding").mapInArrow(lean(_coarse(table, cells, scale, k)), _COARSE)
    queries = queries.withColumn("hall", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(halls)).cast("int"))
    keys = ("dim", "block", "hall")
    met = cands.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(lean_pair(_searched(k)), "query_id long, same long, vec_id long, score long")
    order = Window.partitionBy("query_id", "same").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
