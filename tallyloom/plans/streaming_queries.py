"""Streams over the event table, run over all that is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming import pipelines as P
from .base import load


def _events(spark: SparkSession, d: str, columns: list[str]) -> DataFrame:
    schema = load(spark, d, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{d}/events.parquet*")  # the pattern holds for a file and for a folder
    return P.event_time(stream.select(*columns), "2 days")


def _name(query: str, d: str) -> str:
    return f"{query}_{abs(hash(d)) % 10**8}"


def x01_tumbling_stream(spark: SparkSession, d: str) -> DataFrame:
    out = P.run_available(P.tumbling_counts(_events(spark, d, ["ts", "event_type"])), _name("x01", d), "complete")
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n")


def x06_dedup_stream(spark: SparkSession, d: str) -> DataFrame:
    """Each user and type once a watermark: over the stretch of the table, the pairs that occur."""
    e = _events(spark, d, ["ts", "user_id", "event_type"]).withColumn("key", F.concat_ws("|", "user_id", "event_type"))
    return P.run_available(P.first_deliveries(e, "key"), _name("x06", d)).select("user_id", "event_type").distinct()


QUERIES = {f.__name__: f for f in (x01_tumbling_stream, x06_dedup_stream)}

SQL = {
    "x01_tumbling_stream": "select strftime(time_bucket(interval 30 minutes, ts, timestamp '1970-01-01'), '%Y-%m-%d %H:%M:%S') as start, event_type, count(*)::bigint as n from events group by all",
    "x06_dedup_stream": "select distinct user_id, event_type from events",
}
