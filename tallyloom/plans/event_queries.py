"""Event stream and star-schema aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import eventagg as E
from ..operators import series as S
from .base import day, day_sql, load, r6, r6_sql

#: Polygons of the example: name, vertices in order (closed by the first).
POLYGONS = {"north": [(0, 5), (10, 5), (10, 10), (5, 12), (0, 10)], "south": [(0, 0), (10, 0), (10, 5), (0, 5)], "island": [(12, 2), (15, 3), (14, 6), (12, 5)], "notch": [(2, 2), (8, 2), (5, 4.5)]}
EDGES = [(n, float(a), float(b), float(c), float(e)) for n, ring in POLYGONS.items() for (a, b), (c, e) in zip(ring, ring[1:] + ring[:1], strict=True)]


def _k(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "events")
    return e.withColumns({"k": S.epoch_day(F.to_date("ts")), "level": F.get_json_object("props", "$.k").try_cast("bigint"), "cents": F.round(F.col("value") * 100).cast("bigint")})


def a04_national_rollup(spark: SparkSession, d: str) -> DataFrame:
    """By day: all rows, conditional counts and sums, and a mean over the rows that have the field."""
    t = F.col("event_type")
    return _k(spark, d).groupBy(day("k").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(t == "click").alias("clicks"), F.count_if(t == "purchase").alias("purchases"), F.count_if((t == "error") & (F.col("level") >= 50)).alias("hard_errors"),
        F.sum(F.when(t == "purchase", F.col("cents"))).alias("purchase_cents"), F.count("level").alias("n_level"), r6(F.sum("level") / F.count("level")).alias("level_mean"), F.count_distinct("user_id").alias("users"),
    )


def a05_three_layer(spark: SparkSession, d: str) -> DataFrame:
    agg = {"n": F.count(F.lit(1)), "cents": F.sum("cents"), "level_max": F.max("level")}
    out = E.layers(_k(spark, d), ["user_id", "event_type"], agg, [[], ["user_id"], ["event_type"]])
    return out.select("layer", "user_id", "event_type", "n", "cents", "level_max")


def a16_dyad_excess(spark: SparkSession, d: str) -> DataFrame:
    windows = spark.createDataFrame([("w1", 19737, 19739), ("w2", 19745, 19750)], "window string, start_k int, end_k int")
    x = E.excess_over_baseline(_k(spark, d), member="user_id", k="k", windows=windows, baseline_days=7)
    return x.select("window", "user_id", "n", "baseline", r6("excess").alias("excess"))


def _suppliers(spark: SparkSession, d: str) -> DataFrame:
    s = load(spark, d, "supplier").where("s_nationkey % 4 <> 0").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    return s


def a17_weighted_mean(spark: SparkSession, d: str) -> DataFrame:
    """By nation: mean discount weighted by quantity, over all and over the last 365 days; whole per mille."""
    li = load(spark, d, "lineitem").select("l_suppkey", F.round(F.col("l_discount") * 1000).cast("bigint").alias("x"), F.col("l_quantity").cast("bigint").alias("w"), S.epoch_day(F.to_date("l_shipdate")).alias("k"))
    last = li.agg(F.max("k").alias("last"))
    j = E.lookup(li, _suppliers(spark, d), "l_suppkey")[0].join(last, F.lit(True))
    recent = F.col("k") > F.col("last") - 365
    return j.groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("n"), r6(F.sum(F.col("x") * F.col("w")) / F.sum("w")).alias("mean"), F.count_if(recent).alias("n_recent"), r6(F.sum(F.when(recent, F.col("x") * F.col("w"))) / F.sum(F.when(recent, F.col("w")))).alias("mean_recent")
    )


def j12_excluded(spark: SparkSession, d: str) -> DataFrame:
    return E.lookup(load(spark, d, "lineitem").select("l_suppkey"), _suppliers(spark, d), "l_suppkey")[1]


def j13_point_in_polygon(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "customer").select("c_custkey", ((F.col("c_custkey") * 37 % 1601) / 100.0).alias("lon"), ((F.col("c_custkey") * 53 % 1301) / 100.0).alias("lat"))
    return E.points_in_polygons(c, spark.createDataFrame(EDGES, "name string, x1 double, y1 double, x2 double, y2 double"), key="c_custkey")


def f08_involvement(spark: SparkSession, d: str) -> DataFrame:
    """Events that involve a member in any of three roles, with the partner of the other side."""
    e = _k(spark, d)
    a, b = F.concat(F.lit("N"), (F.col("user_id") % 5).cast("string")), F.concat(F.lit("N"), (F.col("level") % 5).cast("string"))
    hit = e.select("event_id", a.alias("a"), b.alias("b"), "event_type").where("a = 'N1' or b = 'N1' or event_type = 'signup'")
    partner = F.when((F.col("a") == "N1") & (F.col("b") != "N1"), F.col("b")).when((F.col("b") == "N1") & (F.col("a") != "N1"), F.col("a"))
    return hit.groupBy(partner.alias("partner")).agg(F.count(F.lit(1)).alias("n"))


def a18_day_effects(spark: SparkSession, d: str) -> DataFrame:
    o = load(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    slot = F.when(F.date_format("d", "MM-dd") == "02-29", "02-28").otherwise(F.date_format("d", "MM-dd"))
    return o.groupBy(slot.alias("slot")).agg(r6(F.sum("n") / F.count("n")).alias("effect"))


def a19_by_month(spark: SparkSession, d: str) -> DataFrame:
    o = load(spark, d, "orders")
    return o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.floor("o_totalprice")).alias("total"), F.bool_or(F.col("o_orderstatus") == "P").alias("pending"))


def a24_measure_summary(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("level")
    return _k(spark, d).groupBy("event_type").agg(F.count(v).alias("n"), F.count_if(v.isNull()).alias("missing"), r6(F.sum(v) / F.count(v)).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"))


def a26_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    """Differences between the items' rows per order and the order's own day, as a histogram of days."""
    li = load(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("items"), F.max("l_linenumber").alias("last"))
    j = load(spark, d, "orders").select("o_orderkey").join(li, "o_orderkey", "left")
    return j.groupBy((F.col("items") - F.col("last")).alias("drift")).agg(F.count(F.lit(1)).alias("orders"))


def a28_profile_exposure(spark: SparkSession, d: str) -> DataFrame:
    """Each segment's weight dealt to the nations of its customers, by share of the segment's total."""
    c = load(spark, d, "customer").groupBy("c_mktsegment", "c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    t = c.groupBy("c_mktsegment").agg(F.sum("n").alias("t"))
    return c.join(t, "c_mktsegment").groupBy("c_nationkey").agg(r6(F.sum(F.col("n") / F.col("t")) / 5).alias("weight"))


def a29_basis_points(spark: SparkSession, d: str) -> DataFrame:
    n = load(spark, d, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    t = n.agg(F.sum("n").alias("t"))
    return n.join(t, F.lit(True)).select("o_orderpriority", F.floor((F.col("n") * 20000 + F.col("t")) / (2 * F.col("t"))).alias("basis_points"))


def a30_totals_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Days whose parts don't fit their total: none."""
    r = a04_national_rollup(spark, d)
    return r.where("clicks + purchases + hard_errors > n or n_level > n or users > n").select("d")


def a23_regime_baselines(spark: SparkSession, d: str) -> DataFrame:
    """Mean, median, 90th percentile and coverage of daily orders by year, refused under 200 days."""
    s = S.daily_values(load(spark, d, "orders"), day="o_orderdate", aggregate=F.count(F.lit(1)))
    g = s.groupBy(F.year("d").alias("year")).agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.percentile("value", 0.5).alias("median"), F.percentile("value", 0.9).alias("p90"), F.max("value").alias("max"), F.min("value").alias("min"))
    ok = F.col("n") >= 200
    return g.select(F.col("year").cast("bigint").alias("year"), "n", *[F.when(ok, r6(c)).alias(c) for c in ("mean", "median", "p90", "max", "min")])


def a20_status_partition(spark: SparkSession, d: str) -> DataFrame:
    """Cells (nation, segment) of the full frame by the state of their measure: positive, zero or missing."""
    c = load(spark, d, "customer")
    frame = load(spark, d, "nation").select("n_nationkey").join(c.select("c_mktsegment").distinct(), F.lit(True))  # 25 x 5 cells
    m = c.where("c_nationkey % 7 <> 3").groupBy(F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment").agg(F.count_if(F.col("c_acctbal") > 9500).alias("x"))
    state = F.when(F.col("x").isNull(), "missing").when(F.col("x") == 0, "zero").otherwise("positive")
    return frame.join(m, ["n_nationkey", "c_mktsegment"], "left").groupBy("c_mktsegment").agg(*[F.count_if(state == s).alias(s) for s in ("positive", "zero", "missing")], F.sum("x").alias("mass"))


def x01_tumbling(spark: SparkSession, d: str) -> DataFrame:
    """Half-hour windows as a batch; the streaming twin is in ``streaming``."""
    e = load(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    w = e.groupBy(F.window("ts", "30 minutes").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n")


def x02_complete_days(spark: SparkSession, d: str) -> DataFrame:
    """Days all of whose 48 half hours have an event."""
    e = load(spark, d, "events").select(S.epoch_day(F.to_date("ts")).alias("k"), (F.hour("ts") * 2 + F.floor(F.minute("ts") / 30)).alias("slot"))
    return e.groupBy("k").agg(F.count_distinct("slot").alias("slots")).select(day("k").alias("d"), "slots", (F.col("slots") == 48).alias("complete"))


QUERIES = {
    f.__name__: f
    for f in (
        a04_national_rollup, a05_three_layer, a16_dyad_excess, a17_weighted_mean, j12_excluded, j13_point_in_polygon, f08_involvement, a18_day_effects, a19_by_month, a20_status_partition, a23_regime_baselines, a24_measure_summary,
        a26_reconciliation, a28_profile_exposure, a29_basis_points, a30_totals_ledger, x01_tumbling, x02_complete_days,
    )
}

_E = "e as (select *, cast(ts as date) as d, (cast(ts as date) - date '1970-01-01')::bigint as k, try_cast(props ->> '$.k' as bigint) as level, round(value * 100)::bigint as cents from events)"
_SUP = "sup as (select s_suppkey as l_suppkey, s_nationkey from supplier where s_nationkey % 4 <> 0)"

SQL = {
    "a04_national_rollup": f"with {_E} select strftime(d, '%Y-%m-%d') as d, count(*)::bigint as n, (count(*) filter (where event_type = 'click'))::bigint as clicks, (count(*) filter (where event_type = 'purchase'))::bigint as purchases, (count(*) filter (where event_type = 'error' and level >= 50))::bigint as hard_errors, (sum(cents) filter (where event_type = 'purchase'))::bigint as purchase_cents, count(level)::bigint as n_level, {r6_sql('sum(level) / count(level)')} as level_mean, count(distinct user_id)::bigint as users from e group by d",
    "a05_three_layer": f"with {_E} select case when grouping(user_id) = 0 then 'user_id' when grouping(event_type) = 0 then 'event_type' else 'all' end as layer, user_id, event_type, count(*)::bigint as n, sum(cents)::bigint as cents, max(level) as level_max from e group by grouping sets ((), (user_id), (event_type))",
    "a16_dyad_excess": f"with {_E}, w as (select * from (values ('w1', 19737, 19739), ('w2', 19745, 19750)) t(w, a, b)), x as (select w as win, user_id, b - a + 1 as days, count(*) filter (where k between a and b) as n, count(*) filter (where k between a - 7 and a - 1) as base from w, e group by w, user_id, a, b) select win as \"window\", user_id, n::bigint as n, base::bigint as baseline, {r6_sql('n - base / 7 * days')} as excess from x where n > 0",
    "a17_weighted_mean": f"with {_SUP}, l as (select s_nationkey, round(l_discount * 1000)::bigint as x, l_quantity::bigint as w, cast(l_shipdate as date) > (select max(cast(l_shipdate as date)) from lineitem) - 365 as recent from lineitem join sup using (l_suppkey)) select s_nationkey, count(*)::bigint as n, {r6_sql('sum(x * w) / sum(w)')} as mean, (count(*) filter (where recent))::bigint as n_recent, {r6_sql('(sum(x * w) filter (where recent)) / (sum(w) filter (where recent))')} as mean_recent from l group by s_nationkey",
    "j12_excluded": f"with {_SUP} select l_suppkey, count(*)::bigint as n from lineitem where l_suppkey not in (select l_suppkey from sup) group by 1",
    "j13_point_in_polygon": f"with p as (select c_custkey, (c_custkey * 37 % 1601) / 100.0::double as lon, (c_custkey * 53 % 1301) / 100.0::double as lat from customer), ed as (select * from (values {', '.join(f'''('{n}', {a}::double, {b}::double, {c}::double, {e}::double)''' for n, a, b, c, e in EDGES)}) t(name, x1, y1, x2, y2)), i as (select c_custkey, name, count(*) filter (where (y1 > lat) <> (y2 > lat) and lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1) as n from p, ed group by all) select c_custkey, min(name) as name from i where n % 2 = 1 group by c_custkey",
    "f08_involvement": f"with {_E}, p as (select 'N' || user_id % 5 as a, 'N' || level % 5 as b, event_type from e) select case when a = 'N1' and b <> 'N1' then b when b = 'N1' and a <> 'N1' then a end as partner, count(*)::bigint as n from p where a = 'N1' or b = 'N1' or event_type = 'signup' group by 1",
    "a18_day_effects": f"with o as (select cast(o_orderdate as date) as d, count(*) as n from orders group by 1) select case when strftime(d, '%m-%d') = '02-29' then '02-28' else strftime(d, '%m-%d') end as slot, {r6_sql('sum(n) / count(n)')} as effect from o group by 1",
    "a19_by_month": "select strftime(o_orderdate, '%Y-%m') as month, count(*)::bigint as n, sum(floor(o_totalprice))::bigint as total, bool_or(o_orderstatus = 'P') as pending from orders group by 1",
    "a20_status_partition": "with f as (select n_nationkey, s.c_mktsegment from nation, (select distinct c_mktsegment from customer) s), m as (select c_nationkey as n_nationkey, c_mktsegment, count(*) filter (where c_acctbal > 9500) as x from customer where c_nationkey % 7 <> 3 group by all) select c_mktsegment, (count(*) filter (where x > 0))::bigint as positive, (count(*) filter (where x = 0))::bigint as zero, (count(*) filter (where x is null))::bigint as missing, sum(x)::bigint as mass from f left join m using (n_nationkey, c_mktsegment) group by c_mktsegment",
    "a23_regime_baselines": f"with o as (select cast(o_orderdate as date) as d, count(*)::double as v from orders group by 1), g as (select year(d) as year, count(*) as n, avg(v) as mean, quantile_cont(v, 0.5) as median, quantile_cont(v, 0.9) as p90, max(v) as max, min(v) as min from o group by 1) select year::bigint as year, n::bigint as n, {', '.join(f'''{r6_sql(f'case when n >= 200 then "{c}" end')} as "{c}"''' for c in ('mean', 'median', 'p90', 'max', 'min'))} from g",
    "a24_measure_summary": f"with {_E} select event_type, count(level)::bigint as n, (count(*) filter (where level is null))::bigint as missing, {r6_sql('sum(level) / count(level)')} as mean, min(level) as \"min\", max(level) as \"max\" from e group by event_type",
    "a26_reconciliation": "with l as (select l_orderkey as o_orderkey, count(*) as items, max(l_linenumber) as last from lineitem group by 1) select (items - last)::bigint as drift, count(*)::bigint as orders from orders left join l using (o_orderkey) group by 1",
    "a28_profile_exposure": f"with c as (select c_mktsegment, c_nationkey, count(*) as n from customer group by all), t as (select *, sum(n) over (partition by c_mktsegment) as t from c) select c_nationkey, {r6_sql('sum(n / t) / 5')} as weight from t group by 1",
    "a29_basis_points": "with n as (select o_orderpriority, count(*) as n, sum(count(*)) over () as t from orders group by 1) select o_orderpriority, ((n * 20000 + t) // (2 * t))::bigint as basis_points from n",
    "a30_totals_ledger": "select '' as d from orders where o_orderkey < o_orderkey",
    "x01_tumbling": "select strftime(time_bucket(interval 30 minutes, ts, timestamp '1970-01-01'), '%Y-%m-%d %H:%M:%S') as start, event_type, count(*)::bigint as n from events group by all",
    "x02_complete_days": "select strftime(ts, '%Y-%m-%d') as d, count(distinct hour(ts) * 2 + minute(ts) // 30)::bigint as slots, count(distinct hour(ts) * 2 + minute(ts) // 30) = 48 as complete from events group by 1",
}
