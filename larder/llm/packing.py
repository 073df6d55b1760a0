"""Packing of tokenised documents into sequences of bounded length, by sums of squares.

A document is its token ids and an end mark. Longer ones are cut: the first piece takes the remainder,
the others fill a sequence each. The remaining pieces are packed by decreasing length: of the open
sequences with room, a piece goes where the squared counts of open sequences per residual gap become
smallest; a new sequence is opened only where none has room. Pieces are packed in groups of bounded
size, dealt by a hash of the row; each group's sequences that stay well under full are opened again
and their pieces packed together across groups.

What is shuffled is one short row a piece, never ids or texts. Nothing is collected.

Ids are those of tokenizers for the vocabulary's file. They come from its tiktoken form, which has the same vocabulary
and several times the speed; a text that names the special token goes through tokenizers itself, and so does one in
`CHECKED` (by a checksum of the text), whose ids must be equal, or the task fails.

Defined results. A null or empty text is its end mark alone. Rows with a null or repeated doc_id are
packed like others. Other columns are ignored; no documents make no sequences.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import settled
from larder.llm.memory import lean

SIZE = 1024
END_ID = 2
#: Pieces packed in one task: at most so many, and, in up to LEAST_GROUPS groups, no fewer than SMALLEST.
GROUP, LEAST_GROUPS, SMALLEST = 16384, 16, 512
#: Groups whose under-full sequences are packed together, and up to which fill a sequence counts as such.
MERGED_GROUPS, FULL = 256, 0.95
TOKENS = "byte_bpe_50k"
#: One text in so many is encoded both ways.
CHECKED = 256
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@lru_cache(4)
def _encoders(name: str):
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
    special = [t.content for t in whole.get_added_tokens_decoder().values()]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path(f"{name}.tiktoken"), "rb"))}
    plain = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return whole, special, plain


def encode(text: str, name: str = TOKENS) -> list[int]:
    """The ids of a text, without special tokens added."""
    whole, special, plain = _encoders(name)
    if any(t in text for t in special):
        return whole.encode(text, add_special_tokens=False).ids
    ids = plain.encode_ordinary(text)
    if zlib.crc32(text.encode("utf-8", "surrogatepass")) % CHECKED == 0 and ids != whole.encode(text, add_special_tokens=False).ids:
        raise ValueError(f"the two forms of {name} give different ids for a text of {len(text)} code points")
    return ids


def _cut(size: int, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encode(text.as_py() or "", name), END_ID], "<u4")
                cuts = [0, *range(len(ids) % size or size, len(ids) + 1, size)] if len(ids) > size else [0, len(ids)]
                out += [(doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 5, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def pieces(docs: DataFrame, size: int = SIZE, tokens: str = TOKENS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of at most `size` ids."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(lean(_cut(size, tokens)), _PIECES)


def sums_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each length its sequence (from 0) and offset, and the fill of each sequence."""
    n = np.zeros(size + 1, np.int64)  # open sequences of each gap; full ones don't count
    open_at: list[list[int]] = [[] for _ in range(size + 1)]
    sequence, offset, fill = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    for i in np.argsort(-lengths, kind="stable"):
        s = int(lengths[i])
        # Moving a sequence from gap g to g - s changes the sum of squares by 2 (n[g - s] - n[g] + 1), or 1 - 2 n[g] where it becomes full.
        change = np.where(n[s:size] > 0, 2 * (n[: size - s] - n[s:size] + 1), 1 << 60)
        if s < size and n[s]:
            change[0] = 1 - 2 * n[s]
        gap = int(change.argmin()) + s if len(change) else size
        if gap >= size or not n[gap]:
            gap, at = size, len(fill)
            fill.append(0)
        else:
            n[gap] -= 1
            at = open_at[gap].pop()
        sequence[i], offset[i] = at, fill[at]
        fill[at] += s
        if gap > s:
            n[gap - s] += 1
            open_at[gap - s].append(at)
    return sequence, offset, np.array(fill, np.int64)


def _packed(size: int, full: float, shift: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row").reset_index(drop=True)
        at, offset, fill = sums_of_squares(rows["length"].to_numpy(), size)
        return pd.DataFrame({"row": rows["row"], "length": rows["length"], "sequence_id": ((shift << 50) + (int(key[0]) << 24)) + at, "offset": offset, "again": fill[at] < full * size})

    return run


def pack(cut: DataFrame, size: int = SIZE, group: int = GROUP, full: float = FULL) -> DataFrame:
    """The pieces with sequence_id and offset."""
    cut = settled(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    whole = cut.filter(F.col("length") == size).select("row", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    part = cut.filter(F.col("length") < size).select("row", "length")
    n = part.count()
    groups = max(1, min(LEAST_GROUPS, n // SMALLEST), -(-n // group))
    schema = "row long, length long, sequence_id long, offset long, again boolean"
    deal = lambda df, n: df.withColumn("deal", F.pmod(F.xxhash64("row"), F.lit(n)))
    first = settled(deal(part, groups).groupBy("deal").applyInPandas(_packed(size, full, 1), schema), "packed")
    again = deal(first.filter("again").select("row", "length"), -(-groups // MERGED_GROUPS)).groupBy("deal").applyInPandas(_packed(size, 0.0, 2), schema)
    placed = first.filter("NOT again").unionByName(again).select("row", "sequence_id", "offset").unionByName(whole)
    return cut.join(placed, "row").drop("row")
