"""Documents to training sequences: the stages of the corpus pipeline and the run over all of them.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and its result is written as
Parquet and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import lines, mixing, neardup, packing, toxicity
from larder.llm.common import scratch
from larder.llm.queries import HELD_OUT

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _measured(docs: DataFrame) -> DataFrame:
    """The columns of documents, with n_chars as the text now has it."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that nearest labelled examples mark as toxic."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), F.expr(f"NOT ({HELD_OUT})"))
    return toxicity.keep_clean(docs, model).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines that repeat an earlier one up to two edits, and without documents that were all repeats."""
    return _measured(lines.without_repeats(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that with the least doc_id."""
    return neardup.representatives(docs).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn with calibrated probabilities."""
    return mixing.mix(docs).filter("mix_kept").select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 1024 ids; see packing."""
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Toxicity, line dedup and near-duplicate classes aren't SQL; tests/llm hold the pipeline to a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result but the last is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
