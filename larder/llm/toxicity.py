"""Toxicity by the nearest labelled examples, with exact TF-IDF cosine over the terms of the examples.

Fitting takes at most `per_class` labelled documents of each label, by a hash of the id. Terms are words
(lower case, letters only) and the beginnings of longer words. All terms of the examples are indexed, and
document frequencies count all documents. Terms that mark toxic examples, chosen one after another by a
chi-square over `CHI` and once or twice in a document, weigh `MARKED` times as much; no term is left out.
A text's terms that no example holds would only scale its cosines, which changes neither order nor votes.

The examples stand in blocks of like ones, and the inverted index keeps, for each term and block, the greatest weight.
A text's products with these bound its cosines in a block from above. The blocks of the highest bounds are scored
first; then all whose bound reaches the k-th best cosine so far. What isn't scored can't be among the k nearest.
Terms of many examples go through dense matrices, the others through their postings.

An example's vote weighs as its squared cosine. Votes of the examples themselves, each without itself,
give the calibration: isotonic, with the labels' shares in the whole labelled set as weights. The nearest
toxic examples come along as evidence.

The corpus is read for the document frequencies and again for the scores; only the counts of the examples'
terms move. The index is bounded by the sample and travels with the tasks.

Defined results. A null or empty text, or one without a term of any example, gets the share of toxic
examples among such examples, or that among all labels if there are none. Without labels of both kinds nothing can
be learnt, and every score is 0. Repeated labels count as toxic if any of them is; null labels and ids don't count;
rows without an id are scored like others; equal cosines go to the smaller id; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import settled
from larder.llm.memory import lean, settle_in, trim
from larder.llm.words import NOT_LETTERS, slices

#: Labelled documents of each label that the index holds at most.
PER_CLASS = 1500
VOCABULARY = 4096
#: How much more the chosen terms weigh.
MARKED = 16.0
#: A term is chosen over this chi-square: by chance under one in ten million is.
CHI = 30.0
#: And if at least this share of the toxic examples, and three, are left to it.
SUPPORT = 0.002
#: A term may ask for one occurrence in a document, or for up to so many.
TIMES = 2
NEIGHBOURS, EVIDENCE = 40, 3
#: Documents that the filter gives at once.
ROWS = 1000
#: Terms of the most examples that go through dense matrices, examples of a block, and texts that are searched at once.
HEAD, BLOCK, TEXTS = 1024, 64, 48
#: Bytes of a longer word's beginning that are a term.
PREFIXES = (4, 6)
THRESHOLD = 0.3
SCORED = "doc_id long, score double, predicted int, evidence array<long>"


def terms(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of texts: (index of the first, how many, text of each term, hash of each term)."""
    step = 200
    parts = ((i, pc.utf8_lower(texts.slice(i, step).cast(pa.large_string()))) for i in range(0, len(texts), step))
    for row, words in ((i + row, words) for i, part in parts for row, words in slices(part, between=NOT_LETTERS)):
        n = words.counts
        of = np.repeat(np.arange(len(n)), n)
        length = words.ends - words.starts
        found = words.with_prefixes(5, PREFIXES)
        rows, hashes = [of], [found[None]]
        for p in PREFIXES:
            long = length > p
            rows.append(of[long])
            hashes.append(found[p][long])
        yield row, len(n), np.concatenate(rows), np.concatenate(hashes)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """label and, as bytes, the distinct terms and their counts of each document."""
    for batch in batches:
        ids, labels, found, counts = [], [], [], []
        for row, n, of, hashes in terms(batch.column("text")):
            for i in range(n):
                h, c = np.unique(hashes[of == i], return_counts=True)
                ids.append(batch.column("doc_id")[row + i].as_py())
                labels.append(batch.column("toxic")[row + i].as_py())
                found.append(h.tobytes())
                counts.append(c.astype(np.uint32).tobytes())
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(labels, pa.int32()), pa.array(found, pa.binary()), pa.array(counts, pa.binary())], ["doc_id", "toxic", "terms", "counts"])


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each distinct term of each document."""
    for batch in batches:
        for toxic, found in zip(batch.column("toxic"), batch.column("terms")):
            terms_ = np.frombuffer(found.as_py(), np.int64)
            yield pa.record_batch([pa.array(terms_), pa.array(np.full(len(terms_), toxic.as_py(), np.int32))], ["term", "toxic"])


def _among(known: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Whether each of `found` is in `known`, which is sorted."""
    return known[np.minimum(np.searchsorted(known, found), len(known) - 1)] == found if len(known) else np.zeros(len(found), bool)


class Vocabulary:
    """Terms: hashes, and how often a document must hold each. `first` tells where the hashes of equal high bits begin."""

    def __init__(self, hashes: np.ndarray, least: np.ndarray):
        self.size = len(hashes)
        self.known, at = np.unique(hashes, return_inverse=True)
        self.term = np.full((max(1, len(self.known)), TIMES), -1, np.int32)
        self.term[at, least - 1] = np.arange(len(hashes))
        bits = min(24, len(self.known).bit_length() + 2)
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.known >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are known, and their places among these."""
        high = (hashes >> self.shift).astype(np.int64)
        place, end = self.first[high], self.first[high + 1]
        at, out_at, out = np.flatnonzero(place < end), [], []
        place, end, sought = place[at], end[at], hashes[at]
        while len(at):
            same = self.known[place] == sought
            out_at.append(at[same])
            out.append(place[same])
            on = np.flatnonzero(~same & (place + 1 < end))
            at, place, end, sought = at[on], place[on] + 1, end[on], sought[on]
        join = lambda x: np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64)
        return join(out_at), join(out)

    def find(self, doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, term and count of each pair that occurs; from a row for each occurrence."""
        none = np.zeros(0, np.int64)
        if not len(self.known):
            return none, none, none
        at, place = self.places(hashes)
        key, count = np.unique(doc[at] * len(self.known) + place, return_counts=True)
        doc, place = key // len(self.known), key % len(self.known)
        pairs = [(doc[x], self.term[place[x], m], count[x]) for m in range(TIMES) for x in [np.flatnonzero((count > m) & (self.term[place, m] >= 0))]]
        return tuple(np.concatenate(x) for x in zip(*pairs))

    def documents(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """Slices of texts: (index of the first, how many), then what find() gives."""
        for row, n, of, hashes in terms(texts):
            yield row, n, *self.find(of, hashes)


def _chosen(found: list[np.ndarray], counts: list[np.ndarray], toxic: np.ndarray, weights: np.ndarray, wholes: list[int], chi_least: float = CHI) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms that mark toxic examples, and how often a document must hold each, by sequential covering.

    The best term by chi-square is taken and the examples that hold it leave; so words that only go along
    with it, as those of documents copied many times, don't count. Examples with equal terms (`wholes`: hashes
    of all their terms) count once. A term must be toxic in at least half of its examples, counted with the labels' weights.
    """
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    distinct = {(w, int(t)): i for i, (w, t) in reversed(list(enumerate(zip(wholes, toxic))))}
    kept = sorted(distinct.values())
    found, counts, toxic = [found[i] for i in kept], [counts[i] for i in kept], toxic[kept]
    if not len(toxic) or toxic.min() == toxic.max():
        return none
    least = max(3, SUPPORT * toxic.sum())
    seen = np.sort(np.concatenate([f for f, t in zip(found, toxic) if t]))
    hashes, often = np.unique(seen, return_counts=True)
    hashes = hashes[often >= least]  # others reach no support
    del seen, often
    if not len(hashes):
        return none
    size = len(hashes)
    hits = [np.flatnonzero(hashes[np.minimum(np.searchsorted(hashes, f), size - 1)] == f) for f in found]
    at = np.searchsorted(hashes, np.concatenate([f[k] for f, k in zip(found, hits)]))
    doc = np.repeat(np.arange(len(found)), [len(k) for k in hits])
    times = np.concatenate([c[k] for c, k in zip(counts, hits)])
    at = np.concatenate([at[times > m] + m * size for m in range(TIMES)])  # a term for each of the first occurrences
    doc = np.concatenate([doc[times > m] for m in range(TIMES)])
    common = np.bincount(at, toxic[doc], TIMES * size)[at] >= least
    at, doc = at[common], doc[common]
    out: list[int] = []
    while len(out) < VOCABULARY and len(at):
        ids, at_left = np.unique(at, return_inverse=True)
        left = np.unique(doc)
        n, n1 = len(left), int(toxic[left].sum())
        has = np.bincount(at_left).astype(float)
        a = np.bincount(at_left, toxic[doc])
        b, c, d = has - a, n1 - a, n - n1 - has + a
        with np.errstate(divide="ignore", invalid="ignore"):
            chi = np.nan_to_num(n * (a * d - b * c) ** 2 / (has * (n - has) * n1 * (n - n1)))
        chi[(a * d <= b * c) | (a < least) | (a * weights[1] < b * weights[0])] = 0
        best = int(np.lexsort((hashes[ids % size], ids // size, -chi))[0])
        if chi[best] <= chi_least:
            break
        out.append(int(ids[best]))
        stays = ~np.isin(doc, doc[at == ids[best]])
        at, doc = at[stays], doc[stays]
    return (hashes[[k % size for k in out]], np.array([k // size + 1 for k in out], np.int64)) if out else none


def _expanded(start: np.ndarray, many: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (many[0] of them), then those from start[1], and so on."""
    return np.arange(many.sum()) + np.repeat(start - np.cumsum(many) + many, many)


class Index:
    """Unit vectors of the examples, by term: dense rows for the `HEAD` terms of the most examples, postings for the others, in blocks of `BLOCK` examples.

    Examples are named by their number in `docs`; inside, place p is that of example order[p].
    """

    def __init__(self, docs: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, ids: np.ndarray, size: int):
        self.toxic, self.ids, n = toxic, ids, len(docs)
        # Weights are single: products and sums of them are double, and exactly those of the same numbers as doubles.
        terms_ = np.concatenate([np.zeros(0, np.int32), *(t.astype(np.int32) for t, _ in docs)])
        weights = np.concatenate([np.zeros(0, np.float32), *(w.astype(np.float32) for _, w in docs)])
        of = np.repeat(np.arange(n, dtype=np.int32), [len(t) for t, _ in docs])
        top = np.argsort(-np.bincount(terms_, minlength=size), kind="stable")[:HEAD]
        self.row = np.full(max(1, size), -1, np.int32)
        self.row[top] = np.arange(len(top))
        head, dense = np.zeros((len(top), n), np.float32), self.row[terms_] >= 0
        head[self.row[terms_[dense]], of[dense]] = weights[dense]
        self.order = self._alike(head)
        self.blocks = -(-n // BLOCK)
        self.head = np.zeros((self.blocks, len(top), BLOCK), np.float32)
        for b in range(self.blocks):
            mine = self.order[b * BLOCK : (b + 1) * BLOCK]
            self.head[b, :, : len(mine)] = head[:, mine]
        del head
        terms_, place, weights = terms_[~dense], np.argsort(self.order).astype(np.int32)[of[~dense]], weights[~dense]
        by_term = np.lexsort((place, terms_))
        terms_, self.place, self.weight = terms_[by_term], place[by_term], weights[by_term]
        del by_term, place, weights
        # An entry is what a term has in a block.
        block, new = self.place // BLOCK, np.ones(len(terms_), bool)
        new[1:] = (terms_[1:] != terms_[:-1]) | (block[1:] != block[:-1])
        self.start = np.flatnonzero(new).astype(np.int32)
        self.first = np.searchsorted(terms_[self.start], np.arange(size + 1, dtype=np.int32)).astype(np.int32)
        self._derive()

    def _derive(self) -> None:
        """What follows from the rest, and so doesn't travel."""
        self.head_most = self.head.max(2).T.astype(np.float64) if self.blocks else np.zeros((self.head.shape[1], 0))
        self.most = np.maximum.reduceat(self.weight, self.start) if len(self.start) else np.zeros(0, np.float32)
        self.ends = np.append(self.start, np.int32(len(self.place)))

    def __getstate__(self) -> dict:
        return {c: v for c, v in self.__dict__.items() if c not in ("head_most", "most", "ends")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ = state
        self._derive()

    @staticmethod
    def _alike(head: np.ndarray, groups: int = 64) -> np.ndarray:
        """The examples by the nearest of some that are far from each other."""
        n = head.shape[1]
        nearest, best = np.zeros(n, np.int64), np.full(n, -1.0)
        for g in range(min(groups, n)):
            now = head[:, int(best.argmin())] @ head
            nearest[now > best] = g
            best = np.maximum(best, now)
        return np.argsort(nearest, kind="stable")

    def _search(self, doc: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, k: int | None, without: np.ndarray | None = None) -> np.ndarray:
        """n by places: the cosines of the texts' vectors with the examples, 0 where a bound shows that they aren't among the k greatest."""
        dense = self.row[term] >= 0
        query = np.zeros((n, self.head.shape[1]))
        query[doc[dense], self.row[term[dense]]] = weight[dense]
        doc, term, weight = doc[~dense], term[~dense], weight[~dense]
        many = self.first[term + 1] - self.first[term]
        entry, doc, weight = _expanded(self.first[term], many), np.repeat(doc, many), np.repeat(weight, many)
        block, blocks, width = self.place[self.start[entry]] // BLOCK, self.blocks, self.blocks * BLOCK
        out = np.zeros((n, width))

        def add(wanted: np.ndarray) -> None:
            """Cosines of the (text, block) pairs."""
            for b in np.flatnonzero(wanted.any(0)):
                q = np.flatnonzero(wanted[:, b])
                out[q, b * BLOCK : (b + 1) * BLOCK] += query[q] @ self.head[b].astype(np.float64)
            at = np.flatnonzero(wanted[doc, block])
            start = self.start[entry[at]]
            size = self.ends[entry[at] + 1] - start
            post = _expanded(start, size)
            cell = np.repeat(doc[at] * width, size) + self.place[post]
            out.reshape(-1)[:] += np.bincount(cell, np.repeat(weight[at], size) * self.weight[post], minlength=n * width)

        first = np.ones((n, blocks), bool)
        if k is not None and blocks > -(-k // BLOCK) + 1:
            bound = query @ self.head_most + np.bincount(doc * blocks + block, weight * self.most[entry], minlength=n * blocks).reshape(n, blocks)
            high = np.argpartition(-bound, -(-k // BLOCK), axis=1)[:, : -(-k // BLOCK) + 1]
            first[:] = False
            first[np.arange(n)[:, None], high] = True
            add(first)
            if without is not None:
                out[np.arange(n), without] = 0.0
            least = np.partition(out, width - k, axis=1)[:, width - k]
            add(~first & (bound + 1e-8 >= least[:, None]))  # above rounding
        else:
            add(first)
        if without is not None:
            out[np.arange(n), without] = 0.0
        return out.round(9)  # so that equal cosines are equal however texts are dealt

    def cosines(self, doc: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
        """n by examples: all cosines of the vectors of n texts; a row (doc, term, weight) for each term."""
        return self._search(doc, term, weight, n, None)[:, np.argsort(self.order)]

    def nearest(self, doc: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, k: int, without: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each of n texts the k nearest examples with any common term, and their cosines; equal ones by number. `without` names an example for each text that doesn't count."""
        by = np.argsort(doc, kind="stable")
        doc, term, weight = doc[by], term[by], weight[by]
        place = np.argsort(self.order)
        edges = np.searchsorted(doc, np.arange(0, n + TEXTS, TEXTS))
        for a, (low, high) in zip(range(0, n, TEXTS), zip(edges, edges[1:])):
            m = min(TEXTS, n - a)
            rows = self._search(doc[low:high] - a, term[low:high], weight[low:high], m, k, None if without is None else place[without[a : a + m]])
            for cosine in rows:
                least = np.partition(cosine, -k)[-k] if len(cosine) > k else 0.0
                at = np.flatnonzero((cosine >= least) & (cosine > 0))
                at = at[np.lexsort((self.order[at], -cosine[at]))][:k]
                yield self.order[at], cosine[at]

    def vote(self, places: np.ndarray, scores: np.ndarray) -> float:
        """The toxic share of the examples, each weighing as its squared cosine."""
        w = scores * scores
        return float((w * self.toxic[places]).sum() / w.sum()) if len(places) else 0.0


@dataclass
class Model:
    vocabulary: Vocabulary
    #: By term, with MARKED in it.
    idf: np.ndarray
    index: Index | None
    votes: np.ndarray
    chances: np.ndarray
    without_terms: float

    def weights(self, doc: np.ndarray, term: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Of unit vectors, from a row for each term of each text."""
        w = (1 + np.log(count)) * self.idf[term]
        return w / np.sqrt(np.bincount(doc, w * w))[doc] if len(w) else w

    def chance(self, vote: float) -> float:
        """The calibrated share; a little of the vote itself keeps equal shares in order."""
        return float(0.999 * np.interp(vote, self.votes, self.chances) + 0.001 * vote)


def _isotonic(vote: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Votes and non-decreasing shares through which the calibration runs, by pooling adjacent violators."""
    pools: list[list[float]] = []  # vote, weight, toxic weight
    for i in np.argsort(vote, kind="stable"):
        pools.append([vote[i] * weight[i], weight[i], toxic[i] * weight[i]])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.array([p[0] / p[1] for p in pools]), np.array([p[2] / p[1] for p in pools])


def fit(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = PER_CLASS) -> Model:
    """Learns from the labels of documents for which `learn` (over doc_id) holds."""
    settle_in()  # the driver too gives memory back
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(learn)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).join(texts.select("doc_id"), "doc_id", "left_semi")
    totals = {int(t > 0): n for t, n in known.groupBy((F.col("toxic") > 0).cast("int")).count().collect()}
    picked = [known.filter((F.col("toxic") > 0) == bool(t)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for t in (0, 1)]
    chosen = picked[0].unionByName(picked[1]).withColumn("toxic", (F.col("toxic") > 0).cast("int"))
    whole = settled(texts.join(F.broadcast(chosen), "doc_id").mapInArrow(lean(_counted), "doc_id long, toxic int, terms binary, counts binary"), "sample")  # at most 2 * per_class ids are broadcast
    sizes = {t: n for t, n in whole.groupBy("toxic").count().collect()}
    weight_of = np.array([totals.get(t, 0) / max(1, sizes.get(t, 0)) for t in (0, 1)])
    # Only terms with some support, a third of it toxic by weight, can be chosen.
    pairs = whole.mapInArrow(lean(_paired), "term long, toxic int").groupBy("term").agg(F.sum("toxic").alias("a"), F.count("*").alias("n"))
    enough = (F.col("a") >= max(3, SUPPORT * sizes.get(1, 0))) & (2 * F.col("a") * F.lit(float(weight_of[1])) >= (F.col("n") - F.col("a")) * F.lit(float(weight_of[0])))
    candidates = np.sort(pairs.filter(enough).select("term").toArrow()["term"].to_numpy().astype(np.uint64))
    sample = whole.withColumn("whole", F.xxhash64("terms")).toArrow().sort_by("doc_id")
    toxic, ids = sample["toxic"].to_numpy().astype(np.int64), sample["doc_id"].to_numpy()
    found = [np.frombuffer(x.as_py(), np.uint64) for x in sample["terms"]]
    counts = [np.frombuffer(x.as_py(), np.uint32) for x in sample["counts"]]
    few = [_among(candidates, h) for h in found]
    marks, least = _chosen([h[ok] for h, ok in zip(found, few)], [c[ok] for c, ok in zip(counts, few)], toxic, weight_of, sample["whole"].to_pylist())
    both = len(toxic) and toxic.min() < toxic.max()
    every = np.unique(np.concatenate(found)) if both else np.zeros(0, np.uint64)
    again = least > 1
    vocabulary = Vocabulary(np.concatenate([every, marks[again]]), np.concatenate([np.ones(len(every), np.int64), least[again]]))
    marked = np.concatenate([np.isin(every, marks[~again]), np.ones(int(again.sum()), bool)])
    size = vocabulary.size
    del pairs, few, marks, every
    trim()
    weight = weight_of[toxic]
    if not size:
        return Model(vocabulary, np.zeros(0), None, np.zeros(1), np.zeros(1), 0.0)

    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)  # bounded by the sample, as is the model below

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(size + 1, np.int64), 0
        for batch in batches:
            for _, m, _, term, _ in shared.value.documents(batch.column(0)):
                total[:size] += np.bincount(term, minlength=size)
                n += m
        total[size] = n
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at, pa.int32()), pa.array(total[at])], ["term", "n"])

    df = np.zeros(size + 1)
    counted = texts.select("text").mapInArrow(lean(frequencies), "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # one row a term
    df[counted["term"].to_numpy()] = counted["n"].to_numpy()
    model = Model(vocabulary, np.log(1 + df[size] / np.maximum(df[:size], 1)) * np.where(marked, MARKED, 1.0), None, np.zeros(1), np.zeros(1), 0.0)
    vectors = []
    for h, c in zip(found, counts):
        doc, term, count = vocabulary.find(np.zeros(int(c.sum()), np.int64), np.repeat(h, c))
        vectors.append((term, model.weights(doc, term, count)))
    del sample, found, counts
    trim()
    model.index = index = Index(vectors, toxic, ids, size)
    trim()
    has = np.array([len(t) > 0 for t, _ in vectors])
    of = np.repeat(np.arange(len(vectors)), [len(t) for t, _ in vectors])
    votes = np.array([index.vote(*x) for x in index.nearest(of, *(np.concatenate([v[c] for v in vectors]) for c in (0, 1)), len(vectors), NEIGHBOURS, np.arange(len(vectors)))])
    model.without_terms = float((weight * toxic)[~has].sum() / max(weight[~has].sum(), 1e-9)) if (~has).any() else totals[1] / sum(totals.values())
    if has.any():
        model.votes, model.chances = _isotonic(votes[has], toxic[has], weight[has])
    return model


def scored(texts: pa.Array, model: Model) -> tuple[np.ndarray, list[list[int]]]:
    """Scores of texts, and ids of their nearest toxic examples."""
    scores, evidence = np.full(len(texts), model.without_terms), [[] for _ in range(len(texts))]
    index = model.index
    if index is None:
        return scores, evidence
    for row, n, doc, term, count in model.vocabulary.documents(texts):
        known = np.bincount(doc, minlength=n) > 0
        for i, (examples, near) in enumerate(index.nearest(doc, term, model.weights(doc, term, count), n, NEIGHBOURS)):
            if known[i]:
                scores[row + i] = model.chance(index.vote(examples, near))
                evidence[row + i] = index.ids[examples[index.toxic[examples] > 0][:EVIDENCE]].tolist()
    return scores, evidence


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted and, as evidence, the ids of the nearest toxic examples; see SCORED."""

    shared = docs.sparkSession.sparkContext.broadcast(model)  # a worker loads it once, whatever the number of its tasks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, evidence = scored(batch.column(1), shared.value)
            yield pa.record_batch([batch.column(0), pa.array(scores), pa.array((scores >= threshold).astype(np.int32)), pa.array(evidence, pa.list_(pa.int64()))], ["doc_id", "score", "predicted", "evidence"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(lean(run), SCORED)


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """docs whose score is under the threshold: a filter of the rows themselves, which moves nothing."""
    schema, names, at = docs.schema, docs.columns, docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, ROWS) for i in range(0, len(batch), ROWS)):  # so that less is held at once
                yield part.select(names).filter(pa.array(scored(part.column(at).cast(pa.string()), shared.value)[0] < threshold))

    return docs.mapInArrow(lean(run), schema)
