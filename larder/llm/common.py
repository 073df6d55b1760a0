"""What the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where it is unset and Spark is local."""
    sc = spark.sparkContext
    there = spark.conf.get("spark.checkpoint.dir", None) or sc._jsc.sc().getCheckpointDir().getOrElse(None)
    if not there:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        there = tempfile.mkdtemp(prefix="larder-")
        sc.setCheckpointDir(there)
    elif sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(there)
    return there


def own_dir(spark: SparkSession) -> str:
    """The part of the shared folder that only this application uses."""
    return f"{shared_dir(spark).rstrip('/')}/larder-{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, what: str) -> str:
    """A new path below the shared folder."""
    return f"{own_dir(spark)}/{what}-{uuid.uuid4().hex}"


def settled(df: DataFrame, what: str) -> DataFrame:
    """df written to the shared folder and read again: its lineage ends there, and it outlives executors."""
    spark = df.sparkSession
    path = scratch(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Deletes what this application's scratch() paths hold, once no result that reads them is needed any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(own_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def whole_text(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def every(df: DataFrame) -> list[Column]:
    """The columns of df, whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, lengthened until no column has them (whatever the case of its letters)."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def grown(size: int, since: int, least: int, most: int) -> int:
    """A block's size: `least` up to an input of `since`, then with the input's root, up to `most`.

    Two kinds of blocks that both grow like this exchange a number of messages in proportion to the input.
    """
    return min(most, int(least * max(1.0, (size / since) ** 0.5)))


#: A key with more members than this, and than one in so many rows of all, is hot; so there are few hot keys at any size.
HOT_MEMBERS, HOT_SHARE = 1000, 100_000


def joined_by_key(rows: DataFrame, facts: DataFrame, keys: list[str], members: str, total: int) -> DataFrame:
    """rows left-joined to facts, one row a key, whose column `members` says how many rows have it.

    Rows of hot keys meet their fact through a broadcast (no more than HOT_SHARE keys are hot, as each holds over
    total / HOT_SHARE rows), so no key fills a task; the others are shuffled. Null keys meet nothing.
    """
    hot = max(HOT_MEMBERS, total // HOT_SHARE)
    some = facts.filter(F.col(members) > hot).drop(members)
    rest = facts.filter(F.col(members) <= hot).drop(members)
    added = [c for c in some.columns if c not in keys]
    other = unused(rows.columns + some.columns, *(f"{c}_hot" for c in added), "is_hot")
    there = some.select(*keys, *(F.col(c).alias(o) for c, o in zip(added, other)), F.lit(True).alias(other[-1]))
    first = rows.join(F.broadcast(there), keys, "left")
    is_hot = F.col(other[-1]).isNotNull()
    done = first.filter(is_hot).select(*rows.columns, *(F.col(o).alias(c) for c, o in zip(added, other)))
    return done.unionByName(first.filter(~is_hot).select(*rows.columns).join(rest, keys, "left").select(*rows.columns, *added))
