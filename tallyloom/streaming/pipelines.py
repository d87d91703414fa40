"""The streaming shapes: windows, duplicates, sessions, provisional and final days, alerts on change of state.

All take a streaming DataFrame with an event time ``ts``; times without a zone are read as UTC. Windows and sessions come
out in append mode once the watermark has passed them; ``run_available`` drives a query over what is there and ends.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..session import shared_dir


def event_time(df: DataFrame, late: str = "1 hour") -> DataFrame:
    """``df`` with ts as a timestamp under a watermark."""
    return df.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)


def tumbling_counts(df: DataFrame, length: str = "30 minutes", key: str = "event_type") -> DataFrame:
    """(start, key, n) for each window."""
    w = df.groupBy(F.window("ts", length).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.col("w.start").alias("start"), key, "n")


def first_deliveries(df: DataFrame, key: str) -> DataFrame:
    """Each key once within the watermark."""
    return df.dropDuplicatesWithinWatermark([key])


def sessions(df: DataFrame, gap: str = "6 hours", key: str = "user_id") -> DataFrame:
    """(key, start, end, n): sessions that a silence longer than ``gap`` ends."""
    s = df.groupBy(key, F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return s.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def day_slots(df: DataFrame, length: str = "30 minutes") -> DataFrame:
    """(day, start, n): windows with their day, from which ``promote_days`` takes the complete days."""
    w = df.groupBy(F.window("ts", length).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.to_date("w.start").alias("day"), F.col("w.start").alias("start"), "n")


def promote_days(slots_path: str, final_path: str, slots: int = 48) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink: keeps the windows in ``slots_path`` and writes a day to ``final_path`` when all its windows are there.

    A batch delivered again overwrites its own folder, and a day its own, so nothing is counted twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{slots_path}/batch={number}")
        days = spark.read.parquet(slots_path).groupBy("day").agg(F.count_distinct("start").alias("slots"), F.sum("n").alias("n"))
        complete = days.where(F.col("slots") >= slots)
        complete.withColumn("d", F.col("day").cast("string")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("d").parquet(final_path)

    return write


def level_alerts(df: DataFrame, key: str = "user_id", level: str = "high") -> DataFrame:
    """(key, ts, state): one row whenever a key's ``high`` changes from its last known state."""

    def step(k: tuple, batches: Iterable[pd.DataFrame], state: GroupState):
        last = state.get[0] if state.exists else None
        rows = []
        for r in pd.concat(list(batches)).sort_values("ts", kind="stable").itertuples():
            now = bool(getattr(r, level))
            if now != last:
                rows.append((k[0], r.ts, now))
                last = now
        state.update((last,))
        yield pd.DataFrame(rows, columns=[key, "ts", "state"])

    return df.groupBy(key).applyInPandasWithState(step, f"{key} bigint, ts timestamp, state boolean", "last boolean", "append", GroupStateTimeout.NoTimeout)


def run_available(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Runs the query over what its source holds and returns the rows, from a memory table of that name.

    The table is held by the driver, so this is for results of bounded size; state and offsets go to the shared folder.
    """
    at = checkpoint_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", at).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def read_events(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """Parquet files of a folder (or one file's folder by pattern) as a stream."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def checkpoint_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/streams/{name}"
