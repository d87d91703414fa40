"""Spikes, episodes and what happens around them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import islands as I
from ..operators import series as S
from .base import RETURNS, SHARES, day, day_sql, load, r6, r6_sql, returns, shares


def w05_spike_threshold(spark: SparkSession, d: str) -> DataFrame:
    return I.spike_days(shares(spark, d)).select("channel", day("k").alias("d"), r6("bar").alias("bar"), "spike")


def w06_episodes(spark: SparkSession, d: str) -> DataFrame:
    e = I.episodes(shares(spark, d))
    return e.select("channel", day("start_k").alias("start"), day("end_k").alias("end"), day("peak_k").alias("peak"), r6("peak_value").alias("peak_value"), "n_spike_days")


def w19_climatology(spark: SparkSession, d: str) -> DataFrame:
    """By channel and Monday: of the 104 Mondays before, the share whose following 14 days hold a spike."""
    s = I.spike_days(shares(spark, d))
    monday = F.col("k") - F.pmod(F.col("k") + 3, F.lit(7))
    weeks = s.groupBy("channel", monday.alias("k")).agg(F.max(F.col("spike").cast("int")).alias("value"))
    two = S.over_days(weeks, 0, lambda w: {"hit": F.max("value").over(w(0, 7))}, ahead=7)
    return S.over_days(two, 728, lambda w: {"n": F.count("hit").over(w(-728, -7)), "p": F.avg("hit").over(w(-728, -7))}).where("n = 104").select("channel", day("k").alias("week"), r6("p").alias("p"))


def _events(spark: SparkSession, d: str) -> DataFrame:
    """The orders of the highest price as registered events, dealt to the channels in turn; a day has one event at most."""
    o = load(spark, d, "orders").select("o_orderkey", "o_totalprice", S.epoch_day(F.to_date("o_orderdate")).alias("k"))
    top = o.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(29)  # the registered events are the top 29
    return top.select(F.col("o_orderkey").alias("event"), F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), (F.col("o_orderkey") % 3 + 1).cast("int")).alias("channel"), "k")


def j03_hit_rate(spark: SparkSession, d: str) -> DataFrame:
    return I.near_events(_events(spark, d), I.episodes(shares(spark, d))).select("event", "channel", day("k").alias("d"))


def j04_strict_hits(spark: SparkSession, d: str) -> DataFrame:
    return I.near_starts(_events(spark, d), I.episodes(shares(spark, d))).select("event", "channel", day("k").alias("d"))


def j05_any_channel(spark: SparkSession, d: str) -> DataFrame:
    return I.near_events(_events(spark, d), I.episodes(shares(spark, d)), same_channel=False).select("event", "channel", day("k").alias("d"))


def j06_episode_days(spark: SparkSession, d: str) -> DataFrame:
    e = I.each_day(I.episodes(shares(spark, d)))
    return e.groupBy(day("k").alias("d")).agg(F.count_distinct("channel").alias("n_channels"))


def i14_chance_rate(spark: SparkSession, d: str) -> DataFrame:
    s = shares(spark, d)
    return I.chance_rate(s, I.episodes(s)).select("channel", "n_days", "n_covered", r6("rate").alias("rate"))


def i15_placement_overlap(spark: SparkSession, d: str) -> DataFrame:
    s = shares(spark, d)
    return I.placement_overlap(s, I.episodes(s)).select("channel", day("start_k").alias("start"), F.col("n_starts").cast("bigint").alias("n_starts"), "n_hits")


def w21_blind_spot(spark: SparkSession, d: str) -> DataFrame:
    s = shares(spark, d)
    b = I.suppressed_days(s, I.episodes(s))
    return b.select("channel", day("start_k").alias("start"), r6("pre_bar").alias("pre_bar"), "n_suppressed", day("recovered_k").alias("recovered"))


def alt_sigma_jaccard(spark: SparkSession, d: str) -> DataFrame:
    """Jaccard index of the episode days at 1.5 and 2.5 sigma with those at 2."""
    s = shares(spark, d)
    days = lambda x: I.each_day(I.episodes(s, sigma=x)).select("channel", "k").distinct()
    base = days(2.0).withColumn("_base", F.lit(1))
    out = None
    for x in (1.5, 2.5):
        j = days(x).withColumn("_alt", F.lit(1)).join(base, ["channel", "k"], "full_outer").agg(F.lit(x).alias("sigma"), F.count(F.col("_base") * F.col("_alt")).alias("common"), F.count(F.lit(1)).alias("either"))
        out = j if out is None else out.unionByName(j)
    return out.select("sigma", "common", "either", r6(F.col("common") / F.col("either")).alias("jaccard"))


def j07_event_window_sum(spark: SparkSession, d: str) -> DataFrame:
    w = I.event_windows(I.episodes(shares(spark, d)).select("channel", "start_k"), returns(spark, d), [1, 5, 20])
    return w.select("channel", day("start_k").alias("start"), day("first_k").alias("first"), *[r6(f"sum_{n}").alias(f"sum_{n}") for n in (1, 5, 20)])


def i07_event_study(spark: SparkSession, d: str) -> DataFrame:
    w = I.event_windows(I.episodes(shares(spark, d)).select("channel", "start_k"), returns(spark, d), [1, 5, 20])
    return w.groupBy("channel").agg(*[c for n in (1, 5, 20) for c in (r6(F.avg(f"sum_{n}")).alias(f"mean_{n}"), F.count(f"sum_{n}").alias(f"n_{n}"))])


def x07_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of each user by the events' times: a gap of over six hours ends one."""
    e = load(spark, d, "events").where("user_id is not null and ts is not null").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    s = e.groupBy("user_id", F.session_window("ts", "6 hours").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return s.select("user_id", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


QUERIES = {f.__name__: f for f in (w05_spike_threshold, w06_episodes, w19_climatology, j03_hit_rate, j04_strict_hits, j05_any_channel, j06_episode_days, i14_chance_rate, i15_placement_overlap, w21_blind_spot, alt_sigma_jaccard, j07_event_window_sum, i07_event_study, x07_sessions)}


def _ep(sigma: float = 2.0, n: str = "") -> str:
    return f"""raw{n} as (select channel, k, value, case when count(value) over w >= 60 then avg(value) over w + {sigma} * stddev_samp(value) over w end as r from shares window w as (partition by channel order by k range between 89 preceding and current row)),
  sp{n} as (select channel, k, value, lag(r) over (partition by channel order by k) as bar, coalesce(value > lag(r) over (partition by channel order by k), false) as spike from raw{n}),
  il{n} as (select channel, k, sum(case when gap <= 3 then 0 else 1 end) over (partition by channel order by k) as i from (select channel, k, k - lag(k) over (partition by channel order by k) as gap from sp{n} where spike)),
  isl{n} as (select channel, i, min(k) as start_k, max(k) as end_k, count(*) as n_spike_days from il{n} group by channel, i),
  ep{n} as (select e.channel, start_k, end_k, n_spike_days, arg_max(s.k, row(s.value, -s.k)) as peak_k, max(s.value) as peak_value from isl{n} e join shares s on s.channel = e.channel and s.k between start_k and end_k group by all)"""


_BASE = f"with {SHARES}, {_ep()}"
_EV = "ev as (select o_orderkey as event, ['A', 'N', 'R'][o_orderkey % 3 + 1] as channel, (cast(o_orderdate as date) - date '1970-01-01')::bigint as k from orders order by o_totalprice desc, o_orderkey limit 29)"
_EVW = f"""{RETURNS}, rr as (select k, {', '.join(f'case when count(ret) over w{n} = {n} then sum(ret) over w{n} end as sum_{n}' for n in (1, 5, 20))} from rets where ret is not null window {', '.join(f'w{n} as (order by k rows between current row and {n - 1} following)' for n in (1, 5, 20))}),
  evw as (select e.channel, e.start_k, r.k as first_k, r.sum_1, r.sum_5, r.sum_20 from (select e.channel, e.start_k, (select min(k) from rr where k >= e.start_k) as f from ep e) e left join rr r on r.k = e.f)"""

SQL = {
    "w05_spike_threshold": f"{_BASE} select channel, {day_sql('k')} as d, {r6_sql('bar')} as bar, spike from sp",
    "w06_episodes": f"{_BASE} select channel, {day_sql('start_k')} as start, {day_sql('end_k')} as \"end\", {day_sql('peak_k')} as peak, {r6_sql('peak_value')} as peak_value, n_spike_days::bigint as n_spike_days from ep",
    "w19_climatology": f"""{_BASE}, wk as (select channel, k - ((k + 3) % 7) as k, max(spike::int) as v from sp group by 1, 2),
      two as (select channel, k, max(v) over (partition by channel order by k range between current row and 7 following) as hit from wk),
      c as (select channel, k, count(hit) over w as n, avg(hit) over w as p from two window w as (partition by channel order by k range between 728 preceding and 7 preceding)) select channel, {day_sql('k')} as week, {r6_sql('p')} as p from c where n = 104""",
    "j03_hit_rate": f"{_BASE}, {_EV} select event, channel, {day_sql('k')} as d from ev where exists (select 1 from ep where ep.channel = ev.channel and ep.start_k <= ev.k + 3 and ep.end_k >= ev.k - 3)",
    "j04_strict_hits": f"{_BASE}, {_EV} select event, channel, {day_sql('k')} as d from ev where exists (select 1 from ep where ep.channel = ev.channel and abs(ep.start_k - ev.k) <= 3)",
    "j05_any_channel": f"{_BASE}, {_EV} select event, channel, {day_sql('k')} as d from ev where exists (select 1 from ep where ep.start_k <= ev.k + 3 and ep.end_k >= ev.k - 3)",
    "j06_episode_days": f"{_BASE}, x as (select channel, unnest(generate_series(start_k, end_k)) as k from ep) select {day_sql('k')} as d, count(distinct channel)::bigint as n_channels from x group by k",
    "i14_chance_rate": f"{_BASE}, c as (select channel, unnest(generate_series(min(k), max(k))) as k from shares group by channel), v as (select c.channel, c.k, exists (select 1 from ep where ep.channel = c.channel and c.k between start_k - 3 and end_k + 3) as h from c) select channel, count(*)::bigint as n_days, (count(*) filter (where h))::bigint as n_covered, {r6_sql('count(*) filter (where h) / count(*)')} as rate from v group by channel",
    "i15_placement_overlap": f"""{_BASE}, sp2 as (select channel, min(k) as lo, max(k) as hi from shares group by channel), m as (select channel, unnest(generate_series(start_k, end_k)) as k from ep),
      p as (select e.channel, e.start_k, e.end_k - e.start_k as len, unnest(generate_series(lo, hi - (end_k - start_k))) as s from ep e join sp2 using (channel)),
      h as (select distinct p.channel, p.start_k, p.s from p join m on m.channel <> p.channel and m.k between p.s and p.s + p.len)
      select p.channel, {day_sql('p.start_k')} as start, count(*)::bigint as n_starts, count(h.s)::bigint as n_hits from p left join h on h.channel = p.channel and h.start_k = p.start_k and h.s = p.s group by p.channel, p.start_k""",
    "w21_blind_spot": f"""{_BASE} select e.channel, {day_sql('e.start_k')} as start, {r6_sql('p.bar')} as pre_bar, (count(*) filter (where s.value > p.bar and s.value <= s.bar))::bigint as n_suppressed, {day_sql('min(s.k) filter (where s.bar <= 2 * p.bar)')} as recovered
      from ep e join sp p on p.channel = e.channel and p.k = e.start_k left join sp s on s.channel = e.channel and s.k between e.end_k + 1 and e.end_k + 120 group by e.channel, e.start_k, p.bar""",
    "alt_sigma_jaccard": f"""{_BASE}, {_ep(1.5, '_a')}, {_ep(2.5, '_b')}, x as (select distinct channel, unnest(generate_series(start_k, end_k)) as k from ep), y as (select 1.5 as sigma, channel, unnest(generate_series(start_k, end_k)) as k from ep_a union select 2.5, channel, unnest(generate_series(start_k, end_k)) from ep_b),
      z as (select s.sigma, x.channel, x.k from x, (values (1.5), (2.5)) s(sigma)), j as (select coalesce(y.sigma, z.sigma) as sigma, y.k as a, z.k as b from y full join z on y.sigma = z.sigma and y.channel = z.channel and y.k = z.k)
      select sigma::double as sigma, count(a + b)::bigint as common, count(*)::bigint as either, {r6_sql('count(a + b) / count(*)')} as jaccard from j group by sigma""",
    "j07_event_window_sum": f"{_BASE}, {_EVW} select channel, {day_sql('start_k')} as start, {day_sql('first_k')} as first, {', '.join(f'{r6_sql(f'sum_{n}')} as sum_{n}' for n in (1, 5, 20))} from evw",
    "i07_event_study": f"{_BASE}, {_EVW} select channel, {', '.join(f'{r6_sql(f'avg(sum_{n})')} as mean_{n}, count(sum_{n})::bigint as n_{n}' for n in (1, 5, 20))} from evw group by channel",
    "x07_sessions": "with l as (select user_id, ts, case when ts <= lag(ts) over w + interval 6 hour then 0 else 1 end as s from events where user_id is not null and ts is not null window w as (partition by user_id order by ts)), g as (select *, sum(s) over (partition by user_id order by ts range unbounded preceding) as i from l) select user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as start, count(*)::bigint as n from g group by user_id, i",
}
