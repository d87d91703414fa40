"""Correlations, tests, intervals and resampling on the series of the test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import wilson
from ..operators import inference as N
from ..operators import islands as I
from ..operators import neighbours
from ..operators import series as S
from .base import RETURNS, SHARES, day, day_sql, load, orders_daily, r6, r6_sql, returns, shares


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    """(k, d, x, y): orders and shipped items of the days that have both."""
    ship = S.daily_values(load(spark, d, "lineitem"), day="l_shipdate", aggregate=F.count(F.lit(1)))
    return orders_daily(spark, d).select("k", "d", F.col("value").alias("x")).join(ship.select("k", F.col("value").alias("y")), "k")


def _numbered(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).withColumn("channel", F.lit("all")).withColumn("i", F.row_number().over(S.by_order()))


def i01_correlation(spark: SparkSession, d: str) -> DataFrame:
    """Pearson correlation of levels, of day-to-day changes, and by year (24 pairs at least)."""
    p = _pairs(spark, d).withColumn("channel", F.lit("all"))
    dx, dy = F.col("x") - F.lag("x").over(S.by_order()), F.col("y") - F.lag("y").over(S.by_order())
    p = p.withColumns({"dx": dx, "dy": dy})
    one = lambda name, x, y, least: p.agg(F.lit(name).alias("kind"), F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)).alias("n"), r6(N.correlation(F.col(x), F.col(y), least)).alias("r"))
    years = p.groupBy(F.year("d").cast("string").alias("kind")).agg(F.count(F.lit(1)).alias("n"), r6(N.correlation(F.col("x"), F.col("y"), 24)).alias("r"))
    return one("levels", "x", "y", 60).unionByName(one("changes", "dx", "dy", 60)).unionByName(years)


def i02_spearman(spark: SparkSession, d: str) -> DataFrame:
    p = _pairs(spark, d).withColumn("year", F.year("d").cast("bigint"))
    return N.spearman(p, "x", "y", ["year"]).select("year", "n", r6("rho").alias("rho"))


def i03_ccf(spark: SparkSession, d: str) -> DataFrame:
    return N.cross_correlation(_numbered(spark, d).select("i", "x", "y")).select(F.col("lag").cast("bigint").alias("lag"), "n", r6("r").alias("r"))


def i04_incremental_r2(spark: SparkSession, d: str) -> DataFrame:
    """What five lags of the shipments explain of the orders on top of five lags of their own."""
    p = _numbered(spark, d)
    w = S.by_order()
    lagged = p.withColumns({f"x{i}": F.lag("x", i).over(w) for i in range(1, 6)} | {f"y{i}": F.lag("y", i).over(w) for i in range(1, 6)})
    r = N.incremental_r2(lagged, "x", [f"x{i}" for i in range(1, 6)], [f"y{i}" for i in range(1, 6)])
    return spark.createDataFrame([r or (0, None, None)], "n bigint, own_r2 double, added_r2 double")


def i05_bootstrap_ci(spark: SparkSession, d: str) -> DataFrame:
    w = I.event_windows(I.episodes(shares(spark, d)).select("channel", "start_k"), returns(spark, d), [5])
    return N.bootstrap_cells(w, "channel", "sum_5")


def i06_bh(spark: SparkSession, d: str) -> DataFrame:
    """Step-up rule over one cell per nation, whose p is made of its number of customers."""
    c = load(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    cells = c.select("c_nationkey", F.when(F.col("n") % 11 != 0, (F.col("n") * 37 % 1000) / 4000.0).alias("p"))
    return N.step_up(cells, keys=["c_nationkey"]).select("c_nationkey", "p", F.col("rank").cast("bigint").alias("rank"), "significant")


def i08_wilson(spark: SparkSession, d: str) -> DataFrame:
    g = load(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count_if(F.col("l_returnflag") == "R").cast("double").alias("x"), F.count(F.lit(1)).cast("double").alias("n"))
    low, high = wilson(F.col("x"), F.col("n"))
    return g.select("l_suppkey", "x", "n", r6(low).alias("low"), r6(high).alias("high"))


def i09_fpc_interval(spark: SparkSession, d: str) -> DataFrame:
    """Exact interval of the pending orders of each priority, from a sample of 50 drawn by hash."""
    from ..operators.corpus import hash_rank_sample

    o = load(spark, d, "orders").select("o_orderkey", "o_orderpriority", (F.col("o_orderstatus") == "P").alias("hit"))
    s = hash_rank_sample(o, ["o_orderpriority"], "o_orderkey", 50, "fpc").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("sample"), F.count_if("hit").alias("x"))
    rows = s.join(o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("population")), "o_orderpriority").collect()  # one row per priority
    out = [(r.o_orderpriority, r.population, r.sample, r.x, *N.finite_population_interval(r.population, r.sample, r.x)) for r in rows]
    return spark.createDataFrame(out, "o_orderpriority string, population bigint, sample bigint, x bigint, low bigint, high bigint")


def i10_agreement(spark: SparkSession, d: str) -> DataFrame:
    li = load(spark, d, "lineitem").withColumn("year", F.year("l_shipdate").cast("bigint"))
    a = N.agreement(li, ["year"], F.col("l_returnflag") == "R", F.col("l_linestatus") == "O")
    return a.select("year", "n", *[r6(c).alias(c) for c in ("raw", "kappa", "ac1")])


def _label(c: F.Column) -> F.Column:
    return F.upper(F.trim(c))


def i11_repeat_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Addresses that bear more than one label."""
    s = load(spark, d, "pilot_sheet").where("url is not null and coder_label is not null and trim(coder_label) <> ''")
    g = s.groupBy("url").agg(F.count_distinct(_label(F.col("coder_label"))).alias("labels"), F.count(F.lit(1)).alias("rows"))
    return g.where("labels > 1")


def j16_label_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Raw agreement of the first and the last row of each address with several, by the first row's label."""
    s = load(spark, d, "pilot_sheet").where("url is not null and coder_label is not null").select("url", "sheet_row", _label(F.col("coder_label")).alias("label"))
    g = s.groupBy("url").agg(F.min_by("label", "sheet_row").alias("first"), F.max_by("label", "sheet_row").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return g.groupBy("first").agg(F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("first") == F.col("last")).alias("same"))


def i12_seasonality(spark: SparkSession, d: str) -> DataFrame:
    s = N.seasonality(orders_daily(spark, d))
    return s.select(F.col("slot").cast("bigint").alias("slot"), r6("effect").alias("effect"), r6("r2").alias("r2"))


def i13_logit(spark: SparkSession, d: str) -> DataFrame:
    """Coefficients of the chance that an item is returned, on quantity and discount."""
    li = load(spark, d, "lineitem").select((F.col("l_returnflag") == "R").cast("double").alias("y"), (F.col("l_quantity") / 50).alias("q"), (F.col("l_discount") * 10).alias("s"))
    b = N.fit_logit(li, "y", ["q", "s"])
    return spark.createDataFrame([("intercept", float(b[0])), ("quantity", float(b[1])), ("discount", float(b[2]))], "term string, coefficient double")


def i16_welch_scan(spark: SparkSession, d: str) -> DataFrame:
    m = load(spark, d, "orders").groupBy(F.lit("all").alias("channel"), F.trunc("o_orderdate", "MM").alias("d")).agg(F.count(F.lit(1)).cast("double").alias("value")).withColumn("k", S.epoch_day("d"))
    return N.welch_scan(m).select(day("k").alias("month"), r6("t").alias("t"))


def i17_block_bootstrap(spark: SparkSession, d: str) -> DataFrame:
    """Moving-block interval of the correlation of monthly orders and shipments: one row per month is collected."""
    import numpy as np

    m = _pairs(spark, d).groupBy((F.year("d") * 12 + F.month("d")).alias("i")).agg(F.sum("x").alias("x"), F.sum("y").alias("y")).orderBy("i").collect()
    x, y, i = (np.array([r[c] for r in m], float) for c in ("x", "y", "i"))
    low, high = N.moving_block_interval(x, y, i, 6, 500, 11)
    return spark.createDataFrame([(len(m), low, high)], "n bigint, low double, high double")


def i18_autocorrelation(spark: SparkSession, d: str) -> DataFrame:
    s = shares(spark, d)
    l = s.withColumn("p", F.lag("value").over(S.by_order()))
    return l.groupBy("channel").agg(F.count("p").alias("n"), r6(F.corr("value", "p")).alias("r"))


def i20_splice(spark: SparkSession, d: str) -> DataFrame:
    """Orders linked to the level of the shipments by the geometric mean of their ratio in each year."""
    p = _pairs(spark, d).withColumn("year", F.year("d").cast("bigint"))
    return N.geometric_ratio(p, ["year"], "y", "x").select("year", "n", r6("ratio").alias("ratio"), r6("log_sd").alias("log_sd"))


def i21_divergence(spark: SparkSession, d: str) -> DataFrame:
    """Days whose gap between two percentile series is in the top tenth, by sign, clustered."""
    sc = S.trailing_percentile(shares(spark, d)).where("score is not null")
    gap = sc.where("channel = 'A'").select("k", F.col("score").alias("a")).join(sc.where("channel = 'R'").select("k", F.col("score").alias("r")), "k").select("k", r6(F.col("a") - F.col("r")).alias("g"))
    bar = gap.agg(r6(F.percentile(F.abs("g"), 0.9)).alias("bar"))
    far = gap.join(bar, F.abs("g") >= F.col("bar")).select(F.when(F.col("g") > 0, "above").otherwise("below").alias("channel"), "k")
    return I.islands(far).select(F.col("channel").alias("side"), day("start_k").alias("start"), day("end_k").alias("end"), "n_days")


def i22_battery(spark: SparkSession, d: str) -> DataFrame:
    from .interval_queries import _events

    e, ep = _events(spark, d), I.episodes(shares(spark, d))
    parts = {"hits": I.near_events(e, ep), "strict": I.near_starts(e, ep), "naive": I.near_events(e, ep, same_channel=False), "all": e}
    return reduce(DataFrame.unionByName, [x.agg(F.lit(n).alias("criterion"), F.count(F.lit(1)).alias("n")) for n, x in parts.items()])


def a08_geometric_mean(spark: SparkSession, d: str) -> DataFrame:
    li = load(spark, d, "lineitem").select("l_returnflag", (F.col("l_extendedprice") / F.col("l_quantity")).alias("a"), F.lit(1000.0).alias("b"))
    return N.geometric_ratio(li, ["l_returnflag"], "a", "b").select("l_returnflag", "n", r6("ratio").alias("ratio"), r6("log_sd").alias("log_sd"))


def a27_brier(spark: SparkSession, d: str) -> DataFrame:
    """Brier score of two forecasts of a returned item: its supplier's rate in whole percent, and a constant 33."""
    li = load(spark, d, "lineitem").select("l_suppkey", (F.col("l_returnflag") == "R").cast("bigint").alias("y"))
    rate = li.groupBy("l_suppkey").agg(F.floor(F.sum("y") * 100 / F.count(F.lit(1))).alias("p"))
    j = li.join(rate, "l_suppkey")
    score = lambda p: r6(F.sum((p - 100 * F.col("y")) * (p - 100 * F.col("y"))) / F.count(F.lit(1)) / 10000)
    return j.agg(F.count(F.lit(1)).alias("n"), score(F.col("p")).alias("supplier"), score(F.lit(33)).alias("constant"))


def t04_greedy_apart(spark: SparkSession, d: str) -> DataFrame:
    """The five months with the most orders of which no two are neighbours: one row per month is collected."""
    m = load(spark, d, "orders").groupBy((F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1).cast("bigint").alias("i")).agg(F.count(F.lit(1)).alias("n")).collect()
    return spark.createDataFrame(N.greedy_apart([(r.i, r.n) for r in m]), "i bigint, n bigint")


def t09_analogs(spark: SparkSession, d: str) -> DataFrame:
    """The five nearest rows of every embedding whose id is divisible by 20."""
    e = load(spark, d, "embeddings")
    n = neighbours.nearest(e, e.where("vec_id % 20 = 0"), key="vec_id", vector="embedding")
    return n.select("query", "neighbour", F.col("rank").cast("bigint").alias("rank"))


QUERIES = {
    f.__name__: f
    for f in (
        i01_correlation, i02_spearman, i03_ccf, i04_incremental_r2, i05_bootstrap_ci, i06_bh, i08_wilson, i09_fpc_interval, i10_agreement, i11_repeat_conflicts, j16_label_agreement, i12_seasonality, i13_logit, i16_welch_scan,
        i17_block_bootstrap, i18_autocorrelation, i20_splice, i21_divergence, i22_battery, a08_geometric_mean, a27_brier, t04_greedy_apart, t09_analogs,
    )
}

_P = "pr as (select o.k, o.d, o.x, s.y from (select cast(o_orderdate as date) as d, (cast(o_orderdate as date) - date '1970-01-01')::bigint as k, count(*)::double as x from orders group by all) o join (select (cast(l_shipdate as date) - date '1970-01-01')::bigint as k, count(*)::double as y from lineitem group by 1) s using (k))"
_RANK = "(rank() over (partition by year order by {0}) + (count(*) over (partition by year, {0}) - 1) / 2.0)"


def _interval_base() -> str:
    from .interval_queries import _BASE, _EV

    return f"{_BASE}, {_EV}"


SQL = {
    "i01_correlation": f"with {_P}, c as (select *, x - lag(x) over (order by k) as dx, y - lag(y) over (order by k) as dy from pr) select 'levels' as kind, count(*)::bigint as n, {r6_sql('case when count(*) >= 60 then corr(x, y) end')} as r from c union all select 'changes', count(dx)::bigint, {r6_sql('case when count(dx) >= 60 then corr(dx, dy) end')} from c union all select year(d)::varchar, count(*)::bigint, {r6_sql('case when count(*) >= 24 then corr(x, y) end')} from c group by year(d)",
    "i02_spearman": f"with {_P}, q as (select year(d)::bigint as year, x, y from pr), r as (select year, {_RANK.format('x')} as rx, {_RANK.format('y')} as ry from q) select year, count(*)::bigint as n, {r6_sql('case when count(*) >= 3 then corr(rx, ry) end')} as rho from r group by year",
    "i03_ccf": f"with {_P}, n as (select row_number() over (order by k) as i, x, y from pr), l as (select unnest(generate_series(-10, 10)) as lag) select lag::bigint as lag, count(*)::bigint as n, {r6_sql('corr(a.x, b.y)')} as r from l, n a join n b on b.i = a.i + lag group by lag",
    "i06_bh": "with c as (select c_nationkey, count(*) as n from customer group by 1), p as (select c_nationkey, (n * 37 % 1000) / 4000.0::double as p from c where n % 11 <> 0), r as (select *, row_number() over (order by p, c_nationkey) as rank, count(*) over () as m from p) select c_nationkey, p, rank::bigint as rank, coalesce(rank <= max(case when p <= 0.05::double * rank / m then rank end) over (), false) as significant from r",
    "i08_wilson": f"with g as (select l_suppkey, (count(*) filter (where l_returnflag = 'R'))::double as x, count(*)::double as n, 1.959963984540054::double as z from lineitem group by 1) select l_suppkey, x, n, {r6_sql('case when x = 0 then 0.0 else (x / n + z * z / (2 * n)) / (1 + z * z / n) - z * sqrt(x / n * (1 - x / n) / n + z * z / (4 * n * n)) / (1 + z * z / n) end')} as low, {r6_sql('case when x = n then 1.0 else (x / n + z * z / (2 * n)) / (1 + z * z / n) + z * sqrt(x / n * (1 - x / n) / n + z * z / (4 * n * n)) / (1 + z * z / n) end')} as high from g",
    "i10_agreement": f"with g as (select year(l_shipdate)::bigint as year, count(*) as n, avg(((l_returnflag = 'R') = (l_linestatus = 'O'))::int) as raw, avg((l_returnflag = 'R')::int) as pa, avg((l_linestatus = 'O')::int) as pb from lineitem group by 1), c as (select *, pa * pb + (1 - pa) * (1 - pb) as ch, 2 * ((pa + pb) / 2) * (1 - (pa + pb) / 2) as gw from g) select year, n::bigint as n, {r6_sql('raw')} as raw, {r6_sql('case when ch < 1 then (raw - ch) / (1 - ch) end')} as kappa, {r6_sql('case when gw < 1 then (raw - gw) / (1 - gw) end')} as ac1 from c",
    "i11_repeat_conflicts": "select url, count(distinct upper(trim(coder_label)))::bigint as labels, count(*)::bigint as rows from pilot_sheet where url is not null and coder_label is not null and trim(coder_label) <> '' group by url having count(distinct upper(trim(coder_label))) > 1",
    "j16_label_agreement": "with s as (select url, sheet_row, upper(trim(coder_label)) as label from pilot_sheet where url is not null and coder_label is not null), g as (select arg_min(label, sheet_row) as first, arg_max(label, sheet_row) as last from s group by url having count(*) > 1) select first, count(*)::bigint as pairs, (count(*) filter (where first = last))::bigint as same from g group by first",
    "i12_seasonality": f"with o as (select cast(o_orderdate as date) as d, count(*)::double as v from orders group by 1), t as (select d, ln(greatest(v, 1e-6)) as y, row_number() over (order by d) - 1 as t from o), l as (select regr_slope(y, t) as b, regr_intercept(y, t) as a from t), r as (select dayofyear(d) as slot, y - a - b * t as r from t, l), s as (select slot, avg(r) as e, count(*) as n, sum(r * r) as ss from r group by slot) select slot::bigint as slot, {r6_sql('e')} as effect, {r6_sql('sum(n * e * e) over () / sum(ss) over ()')} as r2 from s",
    "i16_welch_scan": f"with m as (select date_trunc('month', o_orderdate)::date as m, count(*)::double as v from orders group by 1), w as (select m, count(v) over a as n1, sum(v) over a as s1, sum(v * v) over a as q1, count(v) over () as n, sum(v) over () as s, sum(v * v) over () as q from m window a as (order by m rows between unbounded preceding and 1 preceding)), x as (select m, n1, n - n1 as n2, s1 / n1 as m1, (s - s1) / (n - n1) as m2, q1, q - q1 as q2 from w where n1 >= 12 and n - n1 >= 12) select strftime(m, '%Y-%m-%d') as month, {r6_sql('abs((m2 - m1) / sqrt((q1 - n1 * m1 * m1) / (n1 - 1) / n1 + (q2 - n2 * m2 * m2) / (n2 - 1) / n2))')} as t from x",
    "i18_autocorrelation": f"with {SHARES}, l as (select channel, value, lag(value) over (partition by channel order by k) as p from shares) select channel, count(p)::bigint as n, {r6_sql('corr(value, p)')} as r from l group by channel",
    "i20_splice": f"with {_P} select year(d)::bigint as year, count(*)::bigint as n, {r6_sql('exp(avg(ln(y / x)))')} as ratio, {r6_sql('coalesce(stddev_samp(ln(y / x)), 0)')} as log_sd from pr group by 1",
    "i21_divergence": f"""with {SHARES}, sc as (select a.channel, a.k, 100.0 * count(*) filter (where b.value <= a.value) / count(*) as score from shares a join shares b on a.channel = b.channel and b.k between a.k - 729 and a.k group by a.channel, a.k, a.value having count(*) >= 180),
      g as (select a.k, {r6_sql('a.score - r.score')} as g from sc a join sc r on a.k = r.k and a.channel = 'A' and r.channel = 'R'), f as (select case when g > 0 then 'above' else 'below' end as side, k from g where abs(g) >= (select {r6_sql('quantile_cont(abs(g), 0.9)')} from g)),
      i as (select *, sum(case when gap <= 3 then 0 else 1 end) over (partition by side order by k) as i from (select *, k - lag(k) over (partition by side order by k) as gap from f)) select side, {day_sql('min(k)')} as start, {day_sql('max(k)')} as "end", count(*)::bigint as n_days from i group by side, i""",
    "i22_battery": f"""{_interval_base()} select 'hits' as criterion, count(*)::bigint as n from ev where exists (select 1 from ep where ep.channel = ev.channel and ep.start_k <= ev.k + 3 and ep.end_k >= ev.k - 3)
      union all select 'strict', count(*)::bigint from ev where exists (select 1 from ep where ep.channel = ev.channel and abs(ep.start_k - ev.k) <= 3) union all select 'naive', count(*)::bigint from ev where exists (select 1 from ep where ep.start_k <= ev.k + 3 and ep.end_k >= ev.k - 3) union all select 'all', count(*)::bigint from ev""",
    "a08_geometric_mean": f"with l as (select l_returnflag, ln(l_extendedprice / l_quantity / 1000.0::double) as r from lineitem where l_extendedprice / l_quantity > 0) select l_returnflag, count(*)::bigint as n, {r6_sql('exp(avg(r))')} as ratio, {r6_sql('coalesce(stddev_samp(r), 0)')} as log_sd from l group by 1",
    "a27_brier": f"with l as (select l_suppkey, (l_returnflag = 'R')::int as y from lineitem), r as (select l_suppkey, floor(sum(y) * 100 / count(*))::bigint as p from l group by 1), j as (select y, p from l join r using (l_suppkey)) select count(*)::bigint as n, {r6_sql('sum((p - 100 * y) * (p - 100 * y)) / count(*) / 10000')} as supplier, {r6_sql('sum((33 - 100 * y) * (33 - 100 * y)) / count(*) / 10000')} as constant from j",
    "t09_analogs": "with q as (select vec_id as query, embedding::double[] as v from embeddings where vec_id % 20 = 0), r as (select query, vec_id as neighbour, row_number() over (partition by query order by list_cosine_similarity(v, embedding::double[]) desc, vec_id) as rank from q, embeddings where vec_id <> query) select query, neighbour, rank::bigint as rank from r where rank <= 5",
}
