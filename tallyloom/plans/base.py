"""Views of the test tables that several queries start from, in DataFrames and in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import r6
from ..operators import series as S
from ..tables import load

__all__ = ["day", "load", "orders_daily", "r6", "returns", "shares"]


def shares(spark: SparkSession, d: str) -> DataFrame:
    """Daily shares of the line items by return flag."""
    return S.daily_shares(load(spark, d, "lineitem"), channel="l_returnflag", day="l_shipdate")


def orders_daily(spark: SparkSession, d: str) -> DataFrame:
    """Orders per day in one channel."""
    return S.daily_values(load(spark, d, "orders"), day="o_orderdate", aggregate=F.count(F.lit(1)))


def returns(spark: SparkSession, d: str) -> DataFrame:
    """Log returns of the daily order totals in whole cents, so that sums are exact."""
    totals = S.daily_values(load(spark, d, "orders"), day="o_orderdate", aggregate=F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")))
    return S.log_returns(totals)


def day(k: Column | str) -> Column:
    """A day number as text."""
    return F.date_add(F.lit("1970-01-01").cast("date"), (F.col(k) if isinstance(k, str) else k).cast("int")).cast("string")


SHARES = "shares as (select channel, d, (d - date '1970-01-01')::bigint as k, 100.0 * n / sum(n) over (partition by d) as value from (select l_returnflag as channel, cast(l_shipdate as date) as d, count(*)::double as n from lineitem where l_returnflag is not null and l_shipdate is not null group by all))"
ORDERS = "od as (select 'all' as channel, cast(o_orderdate as date) as d, (cast(o_orderdate as date) - date '1970-01-01')::bigint as k, count(*)::double as value from orders group by all)"
RETURNS = "tot as (select 'all' as channel, cast(o_orderdate as date) as d, (cast(o_orderdate as date) - date '1970-01-01')::bigint as k, sum(round(o_totalprice * 100)::bigint)::double as value from orders group by all), rets as (select *, 100.0 * (ln(value) - ln(lag(value) over (order by k))) as ret from tot)"


def day_sql(k: str) -> str:
    return f"strftime(make_timestamp(({k}) * 86400000000), '%Y-%m-%d')"


def r6_sql(x: str) -> str:
    return f"floor(({x}) * 1e6 + 0.5) / 1e6"
