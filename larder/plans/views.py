"""Views of the driver's tables in the shapes that the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.plans.tables import table


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records: an outcome, a compared group, a stratum and a numeric setting."""
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("outcome"), F.col("l_returnflag").alias("grp"), F.col("l_linestatus").alias("stratum"), F.col("l_quantity").alias("x"), "l_discount", "l_tax", "l_shipdate")


def sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelled sequence: pos, label, user."""
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("pos"), F.col("event_type").alias("label"), F.col("user_id").alias("user"), "value", "ts")


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled inclusive ranges; gold ones have even ids."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("id"), (F.col("user_id") % 50).alias("src"), F.col("event_type").alias("label"), (F.col("event_id") / 50).cast("long").alias("s"), ((F.col("event_id") / 50).cast("long") + F.col("event_id") % 7).alias("e"), (F.col("event_id") % 2 == 0).alias("gold"))


SPANS_SQL = "SELECT event_id AS id, user_id % 50 AS src, event_type AS label, CAST(floor(event_id / 50.0) AS BIGINT) AS s, CAST(floor(event_id / 50.0) AS BIGINT) + event_id % 7 AS e, event_id % 2 = 0 AS gold FROM events"


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents with index and character offsets."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text"))
