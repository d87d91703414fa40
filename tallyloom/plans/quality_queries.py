"""Queries p1, p2, p3 and p6 over the whole test tables, with SQL where it says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.instants import compact_utc
from ..operators import drift, grid, rolling, spikes
from ..tables import load


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return spikes.flag_readings(load(spark, d, "timeline_chunks")).where("flag is not null").select("row_id")


def p1_flags(spark: SparkSession, d: str) -> DataFrame:
    """Every row with its flag (impossible, spike, stuck or null) and its residual."""
    return spikes.flag_readings(load(spark, d, "timeline_chunks"))


def p2_grid(spark: SparkSession, d: str) -> DataFrame:
    g = grid.regular_grid(load(spark, d, "timeline_chunks"))
    return g.select(F.col("source").alias("series_id"), compact_utc(F.col("k") * F.col("step")).alias("period_start"), "value", "n_readings", "status")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_grid(spark, d).where("n_readings = 0").select("series_id", "period_start")


def p3_changes(spark: SparkSession, d: str) -> DataFrame:
    return drift.schema_changes(load(spark, d, "publication_receipts"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_changes(spark, d).select(F.col("file").alias("receipt_file"), "change", "field", "old_field")


def p3_table(spark: SparkSession, d: str) -> DataFrame:
    return drift.consistent_table(load(spark, d, "publication_receipts"), p3_changes(spark, d))


def p3_cast_failures(spark: SparkSession, d: str) -> DataFrame:
    t = p3_table(spark, d)
    return t.select("lane", F.explode("failed").alias("column")).groupBy("lane", "column").agg(F.count(F.lit(1)).alias("n_failed"))


def _average(w: int) -> F.Column:
    """Rounded to the sixth digit by the same arithmetic as in the SQL, so that ties fall alike."""
    return F.when(F.col(f"n_{w}") > 0, F.floor(F.round(f"total_{w}", 6) / F.col(f"n_{w}") * 1e6 + 0.5) / 1e6)


def p6_totals(spark: SparkSession, d: str) -> DataFrame:
    r = rolling.rolling_totals(load(spark, d, "timeline_chunks"))
    return r.select(F.col("source").alias("series_id"), F.col("day").cast("string").alias("activity_day"), "n", F.round("total", 6).alias("total"), *[c for w in (7, 30) for c in (F.round(f"total_{w}", 6).alias(f"total_{w}"), f"n_{w}", _average(w).alias(f"avg_{w}"))])


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    r = rolling.rolling_totals(load(spark, d, "timeline_chunks"))
    return r.where("n_7 = 0 and n_30 > 0").select(F.col("source").alias("series_id"), F.col("day").cast("string").alias("activity_day"))


#: Usable readings in DuckDB: us is the instant in microseconds.
_USABLE = r"""
usable as (
  select series_id, row_id, step_seconds, value, us from (
    select *, case
      when regexp_full_match(s, '\d{9,10}') then s::bigint * 1000000
      when regexp_full_match(s, '\d{12,13}') then s::bigint * 1000
      when regexp_full_match(s, '\d{14}') then epoch_us(try_strptime(s, '%Y%m%d%H%M%S'))
      when regexp_full_match(s, '\d{8}T\d{6}Z') then epoch_us(try_strptime(s, '%Y%m%dT%H%M%SZ'))
      else epoch_us(try_cast(case when regexp_full_match(s, '\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?') then s || '+00' else replace(s, 'Z', '+00') end as timestamptz)) end as us
    from (select *, upper(trim(date)) as s from timeline_chunks)
    where value is not null and isfinite(value)) where us is not null and series_id is not null)"""

_DAYS = """
daily as (
  select series_id, k, sum(value) as total, count(*) as n
  from (select series_id, us, max_by(value, row_id) as value, floor(us / 86400000000)::bigint as k from usable group by series_id, us) group by series_id, k),
cal as (select series_id, unnest(generate_series(min(k), max(k))) as k from daily group by series_id),
dense as (select series_id, k, coalesce(total, 0) as total, coalesce(n, 0) as n from cal left join daily using (series_id, k)),
rolled as (select series_id, k, total, n,
  sum(total) over a as total_7, sum(n) over a as n_7, sum(total) over b as total_30, sum(n) over b as n_30 from dense
  window a as (partition by series_id order by k range between 6 preceding and current row), b as (partition by series_id order by k range between 29 preceding and current row))"""

QUERIES = {f.__name__: f for f in (p1_found, p1_flags, p2_found, p2_grid, p3_found, p3_changes, p3_table, p3_cast_failures, p6_found, p6_totals)}

SQL = {
    "p2_found": f"""with {_USABLE}, cells as (select distinct series_id, step_seconds::bigint as st, floor(us / (step_seconds::bigint * 1000000))::bigint as k from usable),
      grid as (select series_id, st, unnest(generate_series(min(k), max(k))) as k from cells group by series_id, st)
      select series_id, strftime(make_timestamp(k * st * 1000000), '%Y%m%dT%H%M%SZ') as period_start from grid anti join cells using (series_id, st, k)""",
    "p6_found": f"with {_USABLE}, {_DAYS} select series_id, strftime(make_timestamp(k * 86400000000), '%Y-%m-%d') as activity_day from rolled where n_7 = 0 and n_30 > 0",
    "p6_totals": f"""with {_USABLE}, {_DAYS} select series_id, strftime(make_timestamp(k * 86400000000), '%Y-%m-%d') as activity_day, n::bigint as n, round(total, 6) as total,
      round(total_7, 6) as total_7, n_7::bigint as n_7, case when n_7 > 0 then floor(round(total_7, 6) / n_7 * 1e6 + 0.5) / 1e6 end as avg_7, round(total_30, 6) as total_30, n_30::bigint as n_30, case when n_30 > 0 then floor(round(total_30, 6) / n_30 * 1e6 + 0.5) / 1e6 end as avg_30 from rolled""",
}
