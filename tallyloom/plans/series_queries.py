"""Daily series: percentiles, composites, resampling, volatility, merges of stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import series as S
from .base import ORDERS, RETURNS, SHARES, day, day_sql, load, orders_daily, r6, r6_sql, returns, shares

N_CHANNELS = 3


def w01_trailing_percentile(spark: SparkSession, d: str) -> DataFrame:
    return S.trailing_percentile(shares(spark, d)).select("channel", day("k").alias("d"), r6("score").alias("score"))


def a01_composite(spark: SparkSession, d: str) -> DataFrame:
    return S.composite(S.trailing_percentile(shares(spark, d)), N_CHANNELS).select(day("k").alias("d"), r6("composite").alias("composite"))


def a02_weighted_composite(spark: SparkSession, d: str) -> DataFrame:
    weights = load(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("channel")).agg(F.count(F.lit(1)).alias("weight"))
    return S.weighted_composite(S.trailing_percentile(shares(spark, d)), weights).select(day("k").alias("d"), r6("composite").alias("composite"))


def w02_alternative_windows(spark: SparkSession, d: str) -> DataFrame:
    s = shares(spark, d)
    out = S.trailing_percentile(S.trailing_percentile(s, days=365, out="p365"), days=1095, out="p1095")
    return out.select("channel", day("k").alias("d"), r6("p365").alias("p365"), r6("p1095").alias("p1095"))


def w03_percentile_conventions(spark: SparkSession, d: str) -> DataFrame:
    out = shares(spark, d)
    for ties in ("weak", "strict", "midrank"):
        out = S.trailing_percentile(out, ties=ties, out=f"calendar_{ties}")
    for ties in ("weak", "strict", "midrank"):
        out = S.row_percentile(out, ties=ties, out=f"rows_{ties}")
    return out.select("channel", day("k").alias("d"), *[r6(f"{w}_{t}").alias(f"{w}_{t}") for w in ("calendar", "rows") for t in ("weak", "strict", "midrank")])


def w04_smoothed_percentile(spark: SparkSession, d: str) -> DataFrame:
    smooth = S.trailing_mean(shares(spark, d), days=7, least=4, out="mean7").withColumn("mean7", r6("mean7"))
    return S.trailing_percentile(smooth, value="mean7").select("channel", day("k").alias("d"), "mean7", r6("score").alias("score"))


def w23_band_rank(spark: SparkSession, d: str) -> DataFrame:
    """Percentile over 731 days, both ends in, of a bound a tenth above the value."""
    s = shares(spark, d)
    w = S.over_days(s, 730, lambda w: {"_v": F.collect_list("value").over(w(-730, 0))})
    score = F.when(F.size("_v") >= 180, S.percentile_of(F.col("value") * 1.1, F.col("_v"), F.size("_v")))
    return w.select("channel", day("k").alias("d"), r6(score).alias("upper_score"))


def w22_partial_day_rank(spark: SparkSession, d: str) -> DataFrame:
    """A provisional value for the day after each channel's last one, ranked in the window that ends with it."""
    s = shares(spark, d)
    last = s.groupBy("channel").agg((F.max("k") + 1).alias("k"), F.avg("value").alias("value")).select("channel", day("k").cast("date").alias("d"), "k", "value")
    both = s.withColumn("provisional", F.lit(False)).unionByName(last.withColumn("provisional", F.lit(True)))
    return S.trailing_percentile(both).where("provisional").select("channel", day("k").alias("d"), r6("score").alias("score"))


def a03_gauge(spark: SparkSession, d: str) -> DataFrame:
    li, o = load(spark, d, "lineitem"), load(spark, d, "orders")
    parts = (
        S.daily_values(li, day="l_shipdate", aggregate=F.count(F.lit(1)), channel=F.lit("shipped"))
        .unionByName(S.daily_values(o, day="o_orderdate", aggregate=F.count(F.lit(1)), channel=F.lit("ordered")))
        .unionByName(S.daily_values(o.where("o_orderpriority = '1-URGENT'"), day="o_orderdate", aggregate=F.count(F.lit(1)), channel=F.lit("urgent")))
        .unionByName(S.daily_values(li.where("l_returnflag = 'R'"), day="l_shipdate", aggregate=F.count(F.lit(1)), channel=F.lit("returned")))
    )
    g = S.gauge(parts, {"shipped": 0.4, "ordered": 0.25, "urgent": 0.2, "returned": 0.15}, "shipped")
    return g.select(day("k").alias("d"), r6("gauge").alias("gauge"))


def a09_weekly(spark: SparkSession, d: str) -> DataFrame:
    return S.weekly(shares(spark, d)).select("channel", F.col("week").cast("string").alias("week"), r6("mean").alias("mean"), "n")


def a10_monthly(spark: SparkSession, d: str) -> DataFrame:
    return S.monthly(shares(spark, d)).select("channel", F.col("month").cast("string").alias("month"), r6("mean").alias("mean"), "n")


def a11_monthly_gate(spark: SparkSession, d: str) -> DataFrame:
    m = S.monthly(orders_daily(spark, d), floor=0.8)
    return m.select(F.col("month").cast("string").alias("month"), r6("mean").alias("mean"), "n", F.col("expected").cast("bigint").alias("expected"), "reason")


def w08_trailing_share(spark: SparkSession, d: str) -> DataFrame:
    return S.trailing_share(orders_daily(spark, d)).select(day("k").alias("d"), r6("share").alias("share"))


def w09_realised_vol(spark: SparkSession, d: str) -> DataFrame:
    v = S.realised_volatility(returns(spark, d), rows=10)
    return v.select(day("k").alias("d"), r6("ret").alias("ret"), r6("vol").alias("vol"))


def w11_consecutive_changes(spark: SparkSession, d: str) -> DataFrame:
    m = S.daily_values(load(spark, d, "orders"), day="o_orderdate", aggregate=F.count(F.lit(1))).groupBy("channel", (F.year("d") * 12 + F.month("d") - 1).alias("i")).agg(F.sum("value").alias("value"))
    return S.consecutive_changes(m).select(F.col("i").cast("bigint").alias("i"), "change")


def w12_lag_matrix(spark: SparkSession, d: str) -> DataFrame:
    return S.lags(orders_daily(spark, d), 5).select(day("k").alias("d"), "value", *[f"lag_{i}" for i in range(1, 6)])


def w13_forward_sum(spark: SparkSession, d: str) -> DataFrame:
    r = returns(spark, d).where("ret is not null")
    for n in (1, 5, 20):
        r = S.forward_sum(r, n, out=f"fwd_{n}")
    return r.select(day("k").alias("d"), *[r6(f"fwd_{n}").alias(f"fwd_{n}") for n in (1, 5, 20)])


def w14_pct_excl_self(spark: SparkSession, d: str) -> DataFrame:
    return S.percentile_without_self(orders_daily(spark, d)).select(day("k").alias("d"), r6("pct").alias("pct"))


def w15_circular_smooth(spark: SparkSession, d: str) -> DataFrame:
    e = orders_daily(spark, d).groupBy(F.dayofyear("d").alias("slot")).agg(F.avg("value").alias("effect"))
    return S.circular_smooth(e).select(F.col("slot").cast("bigint").alias("slot"), r6("smooth").alias("smooth"))


def w16_avg_rank(spark: SparkSession, d: str) -> DataFrame:
    return S.average_rank(shares(spark, d), "value", ["channel"]).select("channel", day("k").alias("d"), r6("pct").alias("pct"))


def w17_threshold_crossing(spark: SparkSession, d: str) -> DataFrame:
    return S.threshold_crossings(shares(spark, d)).select("channel", day("k").alias("d"), r6("bar").alias("bar"), "crossed")


def w18_separated_bands(spark: SparkSession, d: str) -> DataFrame:
    from ..functions.numbers import wilson

    li = load(spark, d, "lineitem").groupBy(F.to_date("l_shipdate").alias("d")).agg(F.count_if(F.col("l_returnflag") == "R").alias("x"), F.count(F.lit(1)).alias("n"))
    low, high = wilson(F.col("x").cast("double"), F.col("n").cast("double"))
    bands = li.select(F.lit("R").alias("channel"), S.epoch_day("d").alias("k"), low.alias("low"), high.alias("high"))
    return S.separated_bands(bands).select(day("k").alias("d"), r6("low").alias("low"), r6("high").alias("high"), "separated")


def w20_features(spark: SparkSession, d: str) -> DataFrame:
    m = load(spark, d, "orders").groupBy(F.lit("all").alias("channel"), F.trunc("o_orderdate", "MM").alias("d")).agg(F.count(F.lit(1)).cast("double").alias("value")).withColumn("k", S.epoch_day("d"))
    return S.features(m).select(day("k").alias("month"), "change_12", r6("vol_12").alias("vol_12"))


def _vintages(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    o = load(spark, d, "orders")
    old = o.where("o_orderkey % 3 <> 0").select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")).alias("price"), "o_orderstatus")
    new = o.where("o_orderkey % 3 <> 1").select("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice") + 1).alias("price"), "o_orderstatus")
    return old, new


def k01_cell_merge(spark: SparkSession, d: str) -> DataFrame:
    return S.cell_merge(*_vintages(spark, d), ["o_orderkey"], ["price", "o_orderstatus"])


def k02_upsert(spark: SparkSession, d: str) -> DataFrame:
    return S.upsert(*_vintages(spark, d), ["o_orderkey"])


def u05_release_diff(spark: SparkSession, d: str) -> DataFrame:
    return S.diff(*_vintages(spark, d), ["o_orderkey"], ["price", "o_orderstatus"])


def j22_vintage_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Share of cells that agree in two vintages, a missing one counting against it."""
    old, new = _vintages(spark, d)
    j = old.join(new.withColumnsRenamed({"price": "price_b", "o_orderstatus": "status_b"}), "o_orderkey", "full_outer")
    return j.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("price") == F.col("price_b")).alias("same_price"), F.count_if(F.col("o_orderstatus") == F.col("status_b")).alias("same_status"))


def j02_outer_union_sum(spark: SparkSession, d: str) -> DataFrame:
    a = S.daily_values(load(spark, d, "orders"), day="o_orderdate", aggregate=F.count(F.lit(1)))
    b = S.daily_values(load(spark, d, "lineitem"), day="l_shipdate", aggregate=F.count(F.lit(1)))
    return a.unionByName(b).groupBy("k").agg(F.sum("value").alias("value")).select(day("k").alias("d"), "value")


def u03_missing_days(spark: SparkSession, d: str) -> DataFrame:
    """Days of the calendar without an order, between the first and the last."""
    s = orders_daily(spark, d)
    calendar = s.agg(F.min("k").alias("lo"), F.max("k").alias("hi")).select(F.explode(F.sequence("lo", "hi")).alias("k"))
    return calendar.join(s.select("k"), "k", "left_anti").select(day("k").alias("d"))


QUERIES = {
    f.__name__: f
    for f in (
        w01_trailing_percentile, a01_composite, a02_weighted_composite, w02_alternative_windows, w03_percentile_conventions, w04_smoothed_percentile, w22_partial_day_rank, w23_band_rank,
        a03_gauge, a09_weekly, a10_monthly, a11_monthly_gate, w08_trailing_share, w09_realised_vol, w11_consecutive_changes, w12_lag_matrix, w13_forward_sum, w14_pct_excl_self, w15_circular_smooth,
        w16_avg_rank, w17_threshold_crossing, w18_separated_bands, w20_features, k01_cell_merge, k02_upsert, u05_release_diff, j22_vintage_agreement, j02_outer_union_sum, u03_missing_days,
    )
}


def _pct(days: int, extra: str = "", least: int = 180) -> str:
    """Self join: percentile of a.value among the ``days`` days up to a.k."""
    return f"select a.channel, a.k, case when count(b.value) >= {least} then 100.0 * count(*) filter (where b.value <= a.value) / count(b.value) end as score{extra} from shares a join shares b on a.channel = b.channel and b.k between a.k - {days - 1} and a.k group by a.channel, a.k, a.value"


_W01 = f"scored as ({_pct(730)})"
_OLDNEW = "old as (select o_orderkey, case when o_orderkey % 5 <> 0 then o_totalprice end as price, o_orderstatus from orders where o_orderkey % 3 <> 0), new as (select o_orderkey, case when o_orderkey % 7 <> 0 then o_totalprice + 1 end as price, o_orderstatus from orders where o_orderkey % 3 <> 1)"
_TIES = "100.0 * {} / count(b.value)"
_THREE = ", ".join(
    f"case when count(b.value) >= 180 then 100.0 * {x} / count(b.value) end as {t}"
    for t, x in (("weak", "count(*) filter (where b.value <= a.value)"), ("strict", "count(*) filter (where b.value < a.value)"), ("midrank", "(count(*) filter (where b.value <= a.value) + count(*) filter (where b.value < a.value)) / 2.0"))
)

SQL = {
    "w01_trailing_percentile": f"with {SHARES}, {_W01} select channel, {day_sql('k')} as d, {r6_sql('score')} as score from scored",
    "a01_composite": f"with {SHARES}, {_W01} select {day_sql('k')} as d, {r6_sql('case when count(score) = 3 then avg(score) end')} as composite from scored group by k",
    "a02_weighted_composite": f"with {SHARES}, {_W01}, w as (select l_returnflag as channel, count(*) / sum(count(*)) over () as w from lineitem group by 1) select {day_sql('k')} as d, {r6_sql('case when count(score) = 3 then sum(score * w) end')} as composite from scored join w using (channel) group by k",
    "w02_alternative_windows": f"with {SHARES}, a as ({_pct(365)}), b as ({_pct(1095)}) select a.channel, {day_sql('a.k')} as d, {r6_sql('a.score')} as p365, {r6_sql('b.score')} as p1095 from a join b on a.channel = b.channel and a.k = b.k",
    "w03_percentile_conventions": f"""with {SHARES}, n as (select *, row_number() over (partition by channel order by k) as i from shares),
      c as (select a.channel, a.k, {_THREE} from shares a join shares b on a.channel = b.channel and b.k between a.k - 729 and a.k group by a.channel, a.k, a.value),
      r as (select a.channel, a.k, {_THREE} from n a join n b on a.channel = b.channel and b.i between a.i - 729 and a.i group by a.channel, a.k, a.value)
      select c.channel, {day_sql('c.k')} as d, {', '.join(f"{r6_sql(f'{p}.{t}')} as {w}_{t}" for p, w in (('c', 'calendar'), ('r', 'rows')) for t in ('weak', 'strict', 'midrank'))} from c join r on c.channel = r.channel and c.k = r.k""",
    "w04_smoothed_percentile": f"""with {SHARES}, m as (select channel, k, {r6_sql('case when count(value) over w >= 4 then avg(value) over w end')} as value from shares window w as (partition by channel order by k range between 6 preceding and current row))
      select a.channel, {day_sql('a.k')} as d, a.value as mean7, {r6_sql('case when a.value is not null and count(b.value) >= 180 then 100.0 * count(*) filter (where b.value <= a.value) / count(b.value) end')} as score
      from m a join m b on a.channel = b.channel and b.k between a.k - 729 and a.k group by a.channel, a.k, a.value""",
    "w22_partial_day_rank": f"""with {SHARES}, p as (select channel, max(k) + 1 as k, avg(value) as value from shares group by channel)
      select p.channel, {day_sql('p.k')} as d, {r6_sql('case when count(*) + 1 >= 180 then 100.0 * (1 + count(*) filter (where b.value <= p.value)) / (count(*) + 1) end')} as score from p join shares b on p.channel = b.channel and b.k between p.k - 729 and p.k group by p.channel, p.k, p.value""",
    "w23_band_rank": f"with {SHARES} select a.channel, {day_sql('a.k')} as d, {r6_sql('case when count(*) >= 180 then 100.0 * count(*) filter (where b.value <= a.value * 1.1) / count(*) end')} as upper_score from shares a join shares b on a.channel = b.channel and b.k between a.k - 730 and a.k group by a.channel, a.k, a.value",
    "a03_gauge": f"""with parts as (
        select 'shipped' as c, cast(l_shipdate as date) as d, count(*) as v, 0.4 as w from lineitem group by all union all
        select 'ordered', cast(o_orderdate as date), count(*), 0.25 from orders group by all union all
        select 'urgent', cast(o_orderdate as date), count(*), 0.2 from orders where o_orderpriority = '1-URGENT' group by all union all
        select 'returned', cast(l_shipdate as date), count(*), 0.15 from lineitem where l_returnflag = 'R' group by all)
      select strftime(d, '%Y-%m-%d') as d, {r6_sql("case when count(*) filter (where c = 'shipped') > 0 and count(*) filter (where c <> 'shipped') >= 2 then sum(v * w)::double / sum(w)::double end")} as gauge from parts group by d""",
    "a09_weekly": f"with {SHARES}, w as (select *, d + ((8 - isodow(d)) % 7)::int as week, max(d) over (partition by channel) as last from shares) select channel, strftime(week, '%Y-%m-%d') as week, {r6_sql('avg(value)')} as mean, count(value)::bigint as n from w where week <= last group by channel, week",
    "a10_monthly": f"with {SHARES} select channel, strftime(date_trunc('month', d), '%Y-%m-%d') as month, {r6_sql('avg(value)')} as mean, count(value)::bigint as n from shares group by channel, date_trunc('month', d)",
    "a11_monthly_gate": f"with {ORDERS}, m as (select date_trunc('month', d) as m, avg(value) as mean, count(*) as n, day(last_day(any_value(d))) as e from od group by 1) select strftime(m, '%Y-%m-%d') as month, {r6_sql('case when n >= 0.8 * e then mean end')} as mean, n::bigint as n, e::bigint as expected, case when n < 0.8 * e then 'below the 80% floor' end as reason from m",
    "w08_trailing_share": f"with {ORDERS} select {day_sql('k')} as d, {r6_sql('case when count(*) over w >= 90 then value / sum(value) over w end')} as share from od window w as (order by k range between 364 preceding and current row)",
    "w09_realised_vol": f"with {RETURNS} select {day_sql('k')} as d, {r6_sql('ret')} as ret, {r6_sql('case when count(ret) over w = 10 then stddev_samp(ret) over w end')} as vol from rets window w as (order by k rows between 9 preceding and current row)",
    "w11_consecutive_changes": "with m as (select (year(o_orderdate) * 12 + month(o_orderdate) - 1)::bigint as i, count(*)::double as v from orders group by 1), l as (select i, v - lag(v) over (order by i) as change, i - lag(i) over (order by i) as gap from m) select i, change from l where gap = 1",
    "w12_lag_matrix": f"with {ORDERS} select {day_sql('k')} as d, value, {', '.join(f'lag(value, {i}) over (order by k) as lag_{i}' for i in range(1, 6))} from od",
    "w13_forward_sum": f"with {RETURNS}, r as (select * from rets where ret is not null) select {day_sql('k')} as d, {', '.join(f'''{r6_sql(f'case when count(ret) over w{n} = {n} then sum(ret) over w{n} end')} as fwd_{n}''' for n in (1, 5, 20))} from r window {', '.join(f'w{n} as (order by k rows between current row and {n - 1} following)' for n in (1, 5, 20))}",
    "w14_pct_excl_self": f"with {ORDERS}, n as (select *, row_number() over (order by k) as i from od) select {day_sql('a.k')} as d, {r6_sql('case when count(b.value) > 0 then 100.0 * count(*) filter (where b.value <= a.value) / count(b.value) end')} as pct from n a left join n b on b.i between a.i - 119 and a.i - 1 group by a.k",
    "w15_circular_smooth": f"with {ORDERS}, e as (select dayofyear(d) as slot, avg(value) as v from od group by 1), w as (select slot + o as s, v from e, (values (-366), (0), (366)) t(o)), m as (select s, avg(v) over (order by s range between 3 preceding and 3 following) as x from w) select s::bigint as slot, {r6_sql('x')} as smooth from m where s between 1 and 366",
    "w16_avg_rank": f"with {SHARES} select channel, {day_sql('k')} as d, {r6_sql('(rank() over (partition by channel order by value) + (count(*) over (partition by channel, value) - 1) / 2.0) / count(*) over (partition by channel)')} as pct from shares",
    "w17_threshold_crossing": f"""with {SHARES}, w as (select a.channel, a.k, a.value, list_sort(list(b.value)) as v, count(b.value) as n from shares a left join shares b on a.channel = b.channel and b.k between a.k - 730 and a.k - 1 group by a.channel, a.k, a.value),
      b as (select channel, k, value, case when n >= 180 then v[floor(0.9 * (n - 1))::int + 1] end as bar from w),
      c as (select *, value > bar as above from b) select channel, {day_sql('k')} as d, {r6_sql('bar')} as bar, coalesce(above and not lag(above) over (partition by channel order by k), false) as crossed from c""",
    "w18_separated_bands": f"""with c as (select cast(l_shipdate as date) as d, count(*) filter (where l_returnflag = 'R')::double as x, count(*)::double as n, 1.959963984540054 as z from lineitem group by 1),
      b as (select d, case when x = 0 then 0.0 else (x / n + z * z / (2 * n)) / (1 + z * z / n) - z * sqrt(x / n * (1 - x / n) / n + z * z / (4 * n * n)) / (1 + z * z / n) end as low, case when x = n then 1.0 else (x / n + z * z / (2 * n)) / (1 + z * z / n) + z * sqrt(x / n * (1 - x / n) / n + z * z / (4 * n * n)) / (1 + z * z / n) end as high from c)
      select strftime(d, '%Y-%m-%d') as d, {r6_sql('low')} as low, {r6_sql('high')} as high, case when low > lag(high) over (order by d) then 'above' when high < lag(low) over (order by d) then 'below' when lag(low) over (order by d) is not null then 'overlap' end as separated from b""",
    "w20_features": f"with m as (select date_trunc('month', o_orderdate)::date as m, count(*)::double as v from orders group by 1) select strftime(m, '%Y-%m-%d') as month, v - lag(v, 12) over (order by m) as change_12, {r6_sql('case when count(v) over w = 12 then stddev_samp(v) over w end')} as vol_12 from m window w as (order by m rows between 11 preceding and current row)",
    "k01_cell_merge": f"with {_OLDNEW} select o_orderkey, coalesce(n.price, o.price) as price, coalesce(n.o_orderstatus, o.o_orderstatus) as o_orderstatus from new n full join old o using (o_orderkey)",
    "k02_upsert": f"with {_OLDNEW} select * from new union all select * from old where o_orderkey not in (select o_orderkey from new)",
    "u05_release_diff": f"with {_OLDNEW} select o_orderkey, case when o.o_orderstatus is null then 'added' when n.o_orderstatus is null then 'removed' else 'changed' end as state from old o full join new n using (o_orderkey) where o.o_orderstatus is null or n.o_orderstatus is null or o.price is distinct from n.price",
    "j22_vintage_agreement": f"with {_OLDNEW} select count(*)::bigint as n, (count(*) filter (where o.price = n.price))::bigint as same_price, (count(*) filter (where o.o_orderstatus = n.o_orderstatus))::bigint as same_status from old o full join new n using (o_orderkey)",
    "j02_outer_union_sum": "with a as (select cast(o_orderdate as date) as d, count(*) as n from orders group by 1), b as (select cast(l_shipdate as date) as d, count(*) as n from lineitem group by 1) select strftime(d, '%Y-%m-%d') as d, (coalesce(a.n, 0) + coalesce(b.n, 0))::double as value from a full join b using (d)",
    "u03_missing_days": f"with {ORDERS}, c as (select unnest(generate_series(min(k), max(k))) as k from od) select {day_sql('k')} as d from c where k not in (select k from od)",
}
