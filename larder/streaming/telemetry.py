"""Telemetry as a stream: JSON lines that arrive as files, windowed counts, and the latest state of each worker."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SCHEMA = "ts timestamp, worker string, status string, done long, active long"


def read(spark: SparkSession, path: str, streaming: bool = True, per_trigger: int = 64) -> DataFrame:
    """Rows of telemetry; lines that aren't such objects are dropped, and counts are at least 0."""
    reader = spark.readStream.option("maxFilesPerTrigger", per_trigger) if streaming else spark.read
    rows = reader.schema(SCHEMA).option("mode", "PERMISSIVE").json(path)
    rows = rows.filter(F.col("ts").isNotNull() & F.col("worker").isNotNull())
    return rows.withColumns({c: F.greatest(F.coalesce(c, F.lit(0).cast("long")), F.lit(0).cast("long")) for c in ("done", "active")})


def windowed(rows: DataFrame, late: str = "10 minutes", size: str = "5 minutes") -> DataFrame:
    """start, worker, rows, done, failed by window of event time; rows later than `late` no longer count."""
    grouped = rows.withWatermark("ts", late).groupBy(F.window("ts", size), "worker")
    out = grouped.agg(F.count("*").alias("rows"), F.max("done").alias("done"), F.count_if(F.col("status") == "failed").alias("failed"))
    return out.select(F.col("window.start").alias("start"), "worker", "rows", "done", "failed")


def run_once(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Everything that is there now, written as Parquet; a later call with the same checkpoint goes on from there."""
    df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()


def watched(rows: DataFrame, repeats: int = 3, idle: str = "10 minutes") -> DataFrame:
    """worker, events, streak (of equal states in a row), state: each worker's state after every batch that brings events of it, and once it has been quiet too long.

    State is held by worker and time goes by the events' watermark, so a lost executor's workers go on from the checkpoint.
    """
    quiet = int(pd.Timedelta(idle).total_seconds() * 1000)

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        events, last, streak = state.get if state.exists else (0, "", 0)
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame([(key[0], events, streak, "idle")], columns=["worker", "events", "streak", "state"])
            return
        latest = 0
        for batch in batches:
            for ts, status in batch.sort_values("ts")[["ts", "status"]].itertuples(index=False):
                status = status if isinstance(status, str) else ""
                events, streak, last = events + 1, streak + 1 if status == last else 1, status
                latest = max(latest, int(ts.timestamp() * 1000))
        state.update((events, last, streak))
        state.setTimeoutTimestamp(max(latest, state.getCurrentWatermarkMs()) + quiet)
        name = "complete" if last == "done" else "looping" if streak >= repeats else "working"
        yield pd.DataFrame([(key[0], events, streak, name)], columns=["worker", "events", "streak", "state"])

    return rows.withWatermark("ts", "1 minute").groupBy("worker").applyInPandasWithState(run, "worker string, events long, streak long, state string", "events long, last string, streak long", "append", GroupStateTimeout.EventTimeTimeout)
