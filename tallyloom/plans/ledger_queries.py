"""Audits, ledgers and source-shaped filters on stand-ins from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import inference as N
from ..operators import ledger as L
from ..operators import series as S
from .base import SHARES, day, load, orders_daily, r6, r6_sql, shares


def s09_conditional_sums(spark: SparkSession, d: str) -> DataFrame:
    """Items of the orders in a list (semi join), by month, with a conditional sum beside the total."""
    urgent = load(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    li = load(spark, d, "lineitem").join(urgent, "l_orderkey", "left_semi")
    q = F.col("l_quantity").cast("bigint")
    return li.groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("month")).agg(F.sum(q).alias("total"), F.sum(F.when(F.col("l_returnflag") == "R", q).otherwise(0)).alias("returned"))


def s13_resolution(spark: SparkSession, d: str) -> DataFrame:
    """Sources resolved against the list of tiers: how many are, and how many are missing."""
    s = load(spark, d, "documents").where("source is not null").select(F.col("source").alias("domain")).distinct()
    j = s.join(load(spark, d, "source_tiers"), "domain", "left")
    return j.groupBy(F.when(F.col("tier").isNull(), "missing").otherwise("resolved").alias("state")).agg(F.count(F.lit(1)).alias("n"))


def s16_shared_years(spark: SparkSession, d: str) -> DataFrame:
    """By year: orders in which both a supplier of nation 1 and one of another nation take part."""
    s = load(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    g = load(spark, d, "lineitem").join(s, "l_suppkey").groupBy("l_orderkey").agg(F.bool_or(F.col("s_nationkey") == 1).alias("own"), F.bool_or(F.col("s_nationkey") != 1).alias("other"), F.year(F.min("l_shipdate")).cast("bigint").alias("year"))
    return g.where("own and other").groupBy("year").agg(F.count(F.lit(1)).alias("n"))


def s17_recent_months(spark: SparkSession, d: str) -> DataFrame:
    """The last 48 months of one flow: four equalities, unreadable numbers as missing."""
    li = load(spark, d, "lineitem").where("l_returnflag = 'N' and l_linestatus = 'O' and l_linenumber = 1 and l_tax = 0.0")
    m = li.groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    return m.orderBy(F.desc("month")).limit(48)  # the report is the last 48 months


def s23_row_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Words of a page gathered into rows: heights within 3 of each other are one row."""
    p = load(spark, d, "part").select("p_brand", (F.col("p_partkey") * 7 % 1009).cast("bigint").alias("y"))
    c = L.clusters_on_a_line(p.distinct(), ["p_brand"], "y", 3)
    return c.groupBy("p_brand").agg(F.max("cluster").alias("rows"), F.count(F.lit(1)).alias("words"))


def s24_profile(spark: SparkSession, d: str) -> DataFrame:
    """Structural profile of a table by partition: rows, distinct keys, conditional counts, and whether it may be cut."""
    o = load(spark, d, "orders")
    return o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("o_custkey").alias("customers"), F.count_if(F.col("o_totalprice") > 400000).alias("large"), (F.count(F.lit(1)) >= 500).alias("may_be_cut"))


def f07_fold_names(spark: SparkSession, d: str) -> DataFrame:
    """How many spellings of the titles fall together under NFKC and case folding."""
    s = load(spark, d, "pilot_sheet").where("title is not null").select("title", L.fold_name("title").alias("name"))
    return s.agg(F.count_distinct("title").alias("spellings"), F.count_distinct("name").alias("names"))


def f11_range_query(spark: SparkSession, d: str) -> DataFrame:
    """Registered measures of a published range."""
    return shares(spark, d).where(F.col("channel").isin("A", "R") & F.col("d").between("1996-01-01", "1996-03-31")).select("channel", day("k").alias("d"), r6("value").alias("value"))


_INTENTS = (("refuse", r"\b(panel|probe)\b"), ("compare", r"\b(after|amid|versus)\b"), ("evidence", r"\b(says|watch|why)\b"), ("reading", r"\b(tariff|crude|copper|grain)\b"))


def f13_intents(spark: SparkSession, d: str) -> DataFrame:
    """Titles by the first rule of an ordered list that they meet; refused by default."""
    t, c = F.lower("title"), F.lit(None).cast("string")
    for name, pattern in reversed(_INTENTS):
        c = F.when(t.rlike(pattern), name).otherwise(c)
    return load(spark, d, "pilot_sheet").groupBy(F.coalesce(c, F.lit("refuse")).alias("plan")).agg(F.count(F.lit(1)).alias("n"))


def f17_cell_guard(spark: SparkSession, d: str) -> DataFrame:
    """Titles that must not be written to a spreadsheet as they are, by the reason."""
    t = F.col("title")
    why = F.when(t.rlike(r"^[=+\-@]"), "formula").when(t.rlike(r"[\x00-\x08\x0b\x0c\x0e-\x1f]"), "control").when(F.length(t) > 200, "long")
    return load(spark, d, "pilot_sheet").groupBy(F.coalesce(why, F.lit("fine")).alias("state")).agg(F.count(F.lit(1)).alias("n"))


def j18_basket_vs_benchmark(spark: SparkSession, d: str) -> DataFrame:
    """Mean order price of a basket (segment BUILDING) against all, by month, in cents."""
    o = load(spark, d, "orders").join(load(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
    c = F.round(F.col("o_totalprice") * 100).cast("bigint")
    g = o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.sum(F.when(F.col("c_mktsegment") == "BUILDING", c)).alias("b"), F.count_if(F.col("c_mktsegment") == "BUILDING").alias("nb"), F.sum(c).alias("a"), F.count(F.lit(1)).alias("na"))
    return g.where("nb > 0").select("month", r6(F.col("b") / F.col("nb") - F.col("a") / F.col("na")).alias("excess"))


def j23_monthly_external(spark: SparkSession, d: str) -> DataFrame:
    """Correlation by year of the months of two sources, months with under 20 days left out."""
    a = orders_daily(spark, d).groupBy(F.trunc("d", "MM").alias("m")).agg(F.sum("value").alias("x"), F.count(F.lit(1)).alias("n")).where("n >= 20")
    b = load(spark, d, "lineitem").groupBy(F.trunc("l_shipdate", "MM").alias("m")).agg(F.count(F.lit(1)).cast("double").alias("y"))
    return a.join(b, "m").groupBy(F.year("m").cast("bigint").alias("year")).agg(F.count(F.lit(1)).alias("months"), r6(N.correlation(F.col("x"), F.col("y"), 6)).alias("r"))


def j24_alignment(spark: SparkSession, d: str) -> DataFrame:
    """Days between the last reading of two sources, by channel."""
    s = shares(spark, d).groupBy("channel").agg(F.max("k").alias("a"))
    o = orders_daily(spark, d).agg(F.max("k").alias("b"))
    return s.join(o, F.lit(True)).select("channel", (F.col("a") - F.col("b")).cast("bigint").alias("days"))


def a21_dimension_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Parts by type within every dimension of a fixed list, empty ones included."""
    dims = spark.createDataFrame([("small", "SMALL"), ("small", "ECONOMY"), ("large", "LARGE"), ("none", "NOTHING")], "dimension string, p_type string")
    n = load(spark, d, "part").groupBy("p_type").agg(F.count(F.lit(1)).alias("parts"), F.count_if(F.col("p_size") > 25).alias("big"))
    return dims.join(n, "p_type", "left").groupBy("dimension").agg(F.sum(F.coalesce("parts", F.lit(0))).alias("parts"), F.sum(F.coalesce("big", F.lit(0))).alias("big"))


def t03_top_dates(spark: SparkSession, d: str) -> DataFrame:
    """The 25 days farthest from their channel's mean share."""
    s = shares(spark, d)
    m = s.groupBy("channel").agg(F.avg("value").alias("m"))
    return s.join(m, "channel").select("channel", day("k").alias("d"), r6(F.abs(F.col("value") - F.col("m"))).alias("off")).orderBy(F.desc("off"), "channel", "d").limit(25)


def t08_rotating_window(spark: SparkSession, d: str) -> DataFrame:
    """The slice of the sources that a rotation by days would work on: twelve a day, going round."""
    s = load(spark, d, "source_tiers").select("domain", (F.expr("row_number() over (order by domain)") - 1).alias("i"), F.expr("count(*) over ()").alias("n"))
    return s.where("(i - (20000 * 12) % n + n) % n < 12").select("domain")


def u04_partition_completeness(spark: SparkSession, d: str) -> DataFrame:
    """Days missing from a calendar of states and days in it twice: none."""
    s = orders_daily(spark, d)
    span = s.agg(F.min("k").alias("lo"), F.max("k").alias("hi")).select(F.explode(F.sequence("lo", "hi")).alias("k"))
    states = span.join(s.select("k", "value"), "k", "left").select("k", F.when(F.col("value").isNull(), "missing").otherwise("observed").alias("state"))
    return L.partition_counts(span, states, "k", ["observed", "missing"])


def i19_window_sensitivity(spark: SparkSession, d: str) -> DataFrame:
    """By channel: correlation and largest shift of the scores when the window changes from 730 to 365 days."""
    s = S.trailing_percentile(S.trailing_percentile(shares(spark, d), out="a"), days=365, out="b").where("a is not null and b is not null")
    return s.groupBy("channel").agg(F.count(F.lit(1)).alias("n"), r6(F.corr("a", "b")).alias("r"), r6(F.max(F.abs(F.col("a") - F.col("b")))).alias("largest"))


def c02_record_digests(spark: SparkSession, d: str) -> DataFrame:
    """Receipts that can be sealed, the digests they have, and how many digests repeat."""
    r = load(spark, d, "publication_receipts").select(L.typed_digest("payload").alias("h"))
    return r.agg(F.count(F.lit(1)).alias("records"), F.count("h").alias("sealed"), F.count_distinct("h").alias("digests"))


def c04_universe_partition(spark: SparkSession, d: str) -> DataFrame:
    """Customers partitioned by what becomes of them; the counts must make up the frame."""
    c = load(spark, d, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    state = F.when(F.col("c_acctbal") < 0, "excluded").when(F.col("c_nationkey") == 7, "unmappable").when(F.col("c_custkey") % 13 == 0, "stale").otherwise("included")
    return L.partition_counts(c, c.select("c_custkey", state.alias("state")), "c_custkey", ["included", "excluded", "unmappable", "stale"])


def c07_path_annotation(spark: SparkSession, d: str) -> DataFrame:
    """Bounded paths of the trade graph with the evidence and codes of their edges."""
    from ..operators import evidence as V
    from .evidence_queries import _edges

    e = _edges(spark, d).persist()
    target = e.agg(F.min("dst")).first()[0]
    p = V.bounded_paths(e, e.select(F.col("src").alias("root")).where(F.col("root") != target).distinct(), F.lit(target), hops=3)
    named = p.withColumn("path_id", F.array_join("edge_ids", " "))
    edges = e.select("edge_id", F.col("n").alias("evidence"), F.when(F.col("n") % 2 == 0, "even").when(F.col("n") % 3 == 0, "third").alias("code"))
    return L.annotate_paths(named, edges).select("path_id", "hops", "evidence", "codes")


def c09_assumption_usage(spark: SparkSession, d: str) -> DataFrame:
    n = load(spark, d, "nation").select("n_nationkey")
    return L.usage(n, load(spark, d, "supplier").select(F.col("s_nationkey").alias("n_nationkey")), "n_nationkey")


def c11_corner_witnesses(spark: SparkSession, d: str) -> DataFrame:
    """Residual bounds recomputed from the four corners of the grid; parts where they differ: none."""
    from .evidence_queries import SCENARIOS, _SCENARIO, _shock

    p = load(spark, d, "part").select(F.col("p_partkey").alias("edge_id"), F.array(F.col("p_retailprice").cast("decimal(12,2)"), (F.col("p_retailprice").cast("decimal(12,2)") + F.col("p_size")).cast("decimal(12,2)")).alias("v"))
    s = spark.createDataFrame(SCENARIOS, _SCENARIO).select("scenario", F.array("shock_lo", "shock_hi").alias("s"), F.array("sub_lo", "sub_hi").alias("u"))
    corners = p.join(F.broadcast(s), F.lit(True)).select("edge_id", "scenario", F.explode("v").alias("v"), "s", "u").select("edge_id", "scenario", "v", F.explode("s").alias("s"), "u").select("edge_id", "scenario", "v", "s", F.explode("u").alias("u"))
    x = corners.withColumn("x", (F.col("v") * F.col("s") / 100 * (100 - F.col("u")) / 100).cast("double")).groupBy("edge_id", "scenario").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    j = x.join(_shock(spark, d), ["edge_id", "scenario"])
    return j.where((F.abs(F.col("lo") - F.col("residual_lo")) > 1e-5) | (F.abs(F.col("hi") - F.col("residual_hi")) > 1e-5)).select("edge_id", "scenario")


def c12_falsifiers(spark: SparkSession, d: str) -> DataFrame:
    """By supplier nation: whether a hypothesis (no more than a third of a supplier's items come back) stands."""
    li = load(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("x"))
    j = load(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey").join(li, "l_suppkey", "left")
    return j.groupBy("s_nationkey").agg(L.falsifier_state(F.coalesce(F.col("n") >= 20, F.lit(False)), F.col("x") * 20 > F.col("n") * 7).alias("state"))


def c22_competition(spark: SparkSession, d: str) -> DataFrame:
    """Parts whose suppliers take different positions on the return of items."""
    li = load(spark, d, "lineitem").select("l_partkey", "l_returnflag")
    return L.competition(li, ["l_partkey"], "l_returnflag")


def c25_normalisation_collisions(spark: SparkSession, d: str) -> DataFrame:
    """Normal forms of channels that several spellings share."""
    s = load(spark, d, "pilot_sheet").where("channel is not null").select("channel", F.regexp_replace(F.lower(F.trim("channel")), "[ _-]+", "_").alias("form")).distinct()
    return s.groupBy("form").agg(F.count(F.lit(1)).alias("spellings")).where("spellings > 1")


def c28_plan(spark: SparkSession, d: str) -> DataFrame:
    """A plan of four steps: select, check that all parts are of one day, project, refuse what is missing."""
    p = L.Plan()
    p.add("facts", (), lambda: shares(spark, d))
    p.add("latest", ("facts",), lambda s: s.groupBy("channel").agg(F.max_by(F.struct("k", "value"), "k").alias("f")).select("channel", "f.*"))
    p.add("same_day", ("latest",), lambda s: s.join(s.agg(F.max("k").alias("day")), F.lit(True)))
    p.add("text", ("same_day",), lambda s: s.select(F.when(F.col("k") == F.col("day"), F.format_string("%s: %s", "channel", r6("value").cast("decimal(18,6)").cast("string"))).otherwise(F.concat("channel", F.lit(": refused"))).alias("line")))
    return p.run()["text"]


def c30_exposure_delta(spark: SparkSession, d: str) -> DataFrame:
    """Entities whose edges by dimension changed between two cutoffs."""
    li = load(spark, d, "lineitem").select("l_suppkey", "l_returnflag", F.to_date("l_shipdate").alias("s"))
    snap = lambda on: li.where(F.col("s") <= on).groupBy("l_suppkey", "l_returnflag").agg(F.count(F.lit(1)).alias("edges"))
    return S.diff(snap("1996-01-01"), snap("1996-01-15"), ["l_suppkey", "l_returnflag"], ["edges"])


def c33_ledger_delta(spark: SparkSession, d: str) -> DataFrame:
    """Months of a ledger by what a later release does to them: every month has a state."""
    o = load(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderkey", "o_totalprice")
    before, after = L.row_digest(o.where("o_orderkey % 100 <> 99 or month < '1998-01'"), ["month"]), L.row_digest(o, ["month"])
    j = before.select("month", F.col("digest").alias("b"), F.col("n").alias("nb")).join(after.select("month", F.col("digest").alias("a"), F.col("n").alias("na")), "month", "full_outer")
    state = F.when(F.col("b").isNull(), "added").when(F.col("a").isNull(), "removed").when(F.col("a") == F.col("b"), "same").otherwise("changed")
    return j.select("month", state.alias("state"), (F.col("na") - F.coalesce("nb", F.lit(0))).alias("gained"))


def c36_stabbing(spark: SparkSession, d: str) -> DataFrame:
    """Episodes that are on at the second of each month."""
    from ..operators import islands as I

    e = I.episodes(shares(spark, d))
    days = spark.createDataFrame([(f"{y}-{m:02d}-02",) for y in range(1995, 2002) for m in range(1, 13)], "d string").select(F.col("d"), S.epoch_day(F.col("d").cast("date")).alias("k"))
    return I.each_day(e).join(F.broadcast(days), "k").select("d", "channel", day("start_k").alias("start"))


def x03_provisional(spark: SparkSession, d: str) -> DataFrame:
    """Days as last published: a final count, or a provisional one of the slots so far if there are enough."""
    e = load(spark, d, "events").select(S.epoch_day(F.to_date("ts")).alias("k"), (F.hour("ts") * 2 + F.floor(F.minute("ts") / 30)).alias("slot"))
    g = e.groupBy("k").agg(F.count_distinct("slot").alias("slots"), F.count(F.lit(1)).alias("n"))
    return g.select(day("k").alias("d"), F.when(F.col("slots") == 48, "final").when(F.col("n") >= 180, "provisional").otherwise("ephemeral").alias("state"), "n")


def x04_late_merge(spark: SparkSession, d: str) -> DataFrame:
    """A store after a refetch of its last 14 days: earlier days are immutable, later ones replaced."""
    s = orders_daily(spark, d).select("k", "value")
    last = s.agg((F.max("k") - 14).alias("edge"))
    old = s.where("k % 11 <> 0")
    new = s.withColumn("value", F.col("value") + 1).join(last, F.col("k") > F.col("edge")).drop("edge")
    return S.upsert(old, new, ["k"]).select(day("k").alias("d"), "value")


def x09_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Readings that are not accepted, by the first reason: a record of every failure."""
    from ..functions.instants import instant_micros, is_finite

    t = load(spark, d, "timeline_chunks")
    why = F.when(F.col("date").isNull(), "no date").when(instant_micros(F.col("date")).isNull(), "no instant").when(F.col("value").isNull(), "no value").when(~is_finite(F.col("value")), "not finite")
    return t.groupBy(F.coalesce(why, F.lit("accepted")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def q02_dual_computation(spark: SparkSession, d: str) -> DataFrame:
    """Days on which the composite and the mean of published scores differ by more than a tolerance: none."""
    s = S.trailing_percentile(shares(spark, d))
    published = s.withColumn("score", F.round("score", 1))
    a = S.composite(s, 3)
    b = published.groupBy("k").agg(F.when(F.count("score") == 3, F.sum("score") / 3).alias("again"))
    return a.join(b, "k").where(F.abs(F.col("composite") - F.col("again")) > 0.051).select(day("k").alias("d"))


def q03_replication(spark: SparkSession, d: str) -> DataFrame:
    """Share of days on which other conventions give the published score."""
    s = shares(spark, d)
    weak = S.trailing_percentile(s, out="weak")
    both = S.row_percentile(S.trailing_percentile(S.trailing_percentile(weak, ties="strict", out="strict"), ties="midrank", out="midrank"), out="rows").where("weak is not null")
    same = lambda c: r6(F.count_if(F.abs(F.col(c) - F.col("weak")) < 1e-9) / F.count(F.lit(1)))
    return both.groupBy("channel").agg(F.count(F.lit(1)).alias("n"), *[same(c).alias(c) for c in ("strict", "midrank", "rows")])


def q11_attested_windows(spark: SparkSession, d: str) -> DataFrame:
    """Half hours that are missing from the ordered 48 of each day."""
    e = load(spark, d, "events").select(S.epoch_day(F.to_date("ts")).alias("k"), (F.hour("ts") * 2 + F.floor(F.minute("ts") / 30)).cast("int").alias("slot")).distinct()
    want = e.select("k").distinct().withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(47))))
    return want.join(e, ["k", "slot"], "left_anti").select(day("k").alias("d"), F.col("slot").cast("bigint").alias("slot"))


def q12_stamping(spark: SparkSession, d: str) -> DataFrame:
    """Metadata filled in where it is absent, never overwritten."""
    s = load(spark, d, "pilot_sheet")
    note = F.coalesce(F.nullif(F.trim("coder_note"), F.lit("")), F.lit("(none)"))
    return s.groupBy(note.alias("note")).agg(F.count(F.lit(1)).alias("n"))


def q15_weakest(spark: SparkSession, d: str) -> DataFrame:
    """Weakest confidence of the rows of each address's domain."""
    c = F.lower(F.trim("coder_confidence"))
    s = load(spark, d, "pilot_sheet").where("domain is not null").select(F.lower(F.trim("domain")).alias("domain"), F.when(c == "1", "low").when(c == "2", "medium").when(c == "3", "high").otherwise(c).alias("c"))
    return L.weakest(s, ["domain"], "c", ["low", "medium", "high"])


_Q = (
    s09_conditional_sums, s13_resolution, s16_shared_years, s17_recent_months, s23_row_clusters, s24_profile, f07_fold_names, f11_range_query, f13_intents, f17_cell_guard, j18_basket_vs_benchmark, j23_monthly_external, j24_alignment,
    a21_dimension_rollup, t03_top_dates, t08_rotating_window, u04_partition_completeness, i19_window_sensitivity, c02_record_digests, c04_universe_partition, c07_path_annotation, c09_assumption_usage, c11_corner_witnesses, c12_falsifiers,
    c22_competition, c25_normalisation_collisions, c28_plan, c30_exposure_delta, c33_ledger_delta, c36_stabbing, x03_provisional, x04_late_merge, x09_rejects, q02_dual_computation, q03_replication, q11_attested_windows, q12_stamping, q15_weakest,
)
QUERIES = {f.__name__: f for f in _Q}


def _pct(days: int, op: str = "<=") -> str:
    return f"select a.channel, a.k, case when count(b.value) >= 180 then 100.0 * count(*) filter (where b.value {op} a.value) / count(b.value) end as score from shares a join shares b on a.channel = b.channel and b.k between a.k - {days - 1} and a.k group by a.channel, a.k, a.value"


def _sql() -> dict[str, str]:
    from .base import ORDERS, day_sql
    from .evidence_queries import _EDGE
    from .interval_queries import _BASE

    order_days = f"with {ORDERS}"
    slots = "e as (select (ts::date - date '1970-01-01')::bigint as k, hour(ts) * 2 + minute(ts) // 30 as slot from events)"
    return {
        "s09_conditional_sums": "select strftime(l_shipdate, '%Y-%m') as month, sum(l_quantity::bigint)::bigint as total, sum(case when l_returnflag = 'R' then l_quantity::bigint else 0 end)::bigint as returned from lineitem where l_orderkey in (select o_orderkey from orders where o_orderpriority = '1-URGENT') group by 1",
        "s13_resolution": "select case when tier is null then 'missing' else 'resolved' end as state, count(*)::bigint as n from (select distinct source from documents where source is not null) left join source_tiers on domain = source group by 1",
        "s16_shared_years": "with g as (select l_orderkey, bool_or(s_nationkey = 1) as own, bool_or(s_nationkey <> 1) as other, year(min(l_shipdate))::bigint as year from lineitem join supplier on s_suppkey = l_suppkey group by 1) select year, count(*)::bigint as n from g where own and other group by year",
        "s17_recent_months": "select strftime(l_shipdate, '%Y-%m') as month, count(*)::bigint as n from lineitem where l_returnflag = 'N' and l_linestatus = 'O' and l_linenumber = 1 and l_tax = 0.0 group by 1 order by 1 desc limit 48",
        "s23_row_clusters": "with p as (select distinct p_brand, p_partkey * 7 % 1009 as y from part), l as (select *, case when y - lag(y) over (partition by p_brand order by y) <= 3 then 0 else 1 end as s from p) select p_brand, sum(s)::bigint as rows, count(*)::bigint as words from l group by 1",
        "s24_profile": "select o_orderpriority, count(*)::bigint as rows, count(distinct o_custkey)::bigint as customers, (count(*) filter (where o_totalprice > 400000))::bigint as large, count(*) >= 500 as may_be_cut from orders group by 1",
        "f11_range_query": f"with {SHARES} select channel, strftime(d, '%Y-%m-%d') as d, {r6_sql('value')} as value from shares where channel in ('A', 'R') and d between date '1996-01-01' and date '1996-03-31'",
        "f13_intents": "select case " + " ".join(f"when regexp_matches(lower(title), '{p}') then '{n}'" for n, p in _INTENTS) + " else 'refuse' end as plan, count(*)::bigint as n from pilot_sheet group by 1",
        "f17_cell_guard": r"select case when regexp_matches(title, '^[=+\-@]') then 'formula' when regexp_matches(title, '[\x00-\x08\x0b\x0c\x0e-\x1f]') then 'control' when length(title) > 200 then 'long' else 'fine' end as state, count(*)::bigint as n from pilot_sheet group by 1",
        "j18_basket_vs_benchmark": f"with g as (select strftime(o_orderdate, '%Y-%m') as month, sum(round(o_totalprice * 100)::bigint) filter (where c_mktsegment = 'BUILDING') as b, count(*) filter (where c_mktsegment = 'BUILDING') as nb, sum(round(o_totalprice * 100)::bigint) as a, count(*) as na from orders join customer on c_custkey = o_custkey group by 1) select month, {r6_sql('b / nb - a / na')} as excess from g where nb > 0",
        "j23_monthly_external": f"{order_days}, a as (select date_trunc('month', d) as m, sum(value) as x from od group by 1 having count(*) >= 20), b as (select date_trunc('month', l_shipdate::date) as m, count(*)::double as y from lineitem group by 1) select year(m)::bigint as year, count(*)::bigint as months, {r6_sql('case when count(*) >= 6 then corr(x, y) end')} as r from a join b using (m) group by 1",
        "j24_alignment": f"{order_days}, {SHARES} select channel, (max(k) - (select max(k) from od))::bigint as days from shares group by channel",
        "a21_dimension_rollup": "with d as (select * from (values ('small', 'SMALL'), ('small', 'ECONOMY'), ('large', 'LARGE'), ('none', 'NOTHING')) t(dimension, p_type)) select dimension, count(p_partkey)::bigint as parts, (count(*) filter (where p_size > 25))::bigint as big from d left join part using (p_type) group by 1",
        "t03_top_dates": f"with {SHARES}, m as (select *, {r6_sql('abs(value - avg(value) over (partition by channel))')} as off from shares) select channel, strftime(d, '%Y-%m-%d') as d, off from m order by off desc, channel, d limit 25",
        "t08_rotating_window": "with s as (select domain, row_number() over (order by domain) - 1 as i, count(*) over () as n from source_tiers) select domain from s where (i - (20000 * 12) % n + n) % n < 12",
        "u04_partition_completeness": f"{order_days}, c as (select unnest(generate_series(min(k), max(k))) as k from od) select count(*)::bigint as members, count(value)::bigint as observed, (count(*) - count(value))::bigint as missing, true as exact from c left join od using (k)",
        "i19_window_sensitivity": f"with {SHARES}, a as ({_pct(730)}), b as ({_pct(365)}) select channel, count(*)::bigint as n, {r6_sql('corr(a.score, b.score)')} as r, {r6_sql('max(abs(a.score - b.score))')} as largest from a join b using (channel, k) where a.score is not null and b.score is not null group by channel",
        "c04_universe_partition": "with s as (select case when c_acctbal < 0 then 'excluded' when c_nationkey = 7 then 'unmappable' when c_custkey % 13 = 0 then 'stale' else 'included' end as s from customer) select count(*)::bigint as members, " + ", ".join(f"(count(*) filter (where s = '{x}'))::bigint as {x}" for x in ("included", "excluded", "unmappable", "stale")) + ", true as exact from s",
        "c07_path_annotation": f"""with recursive {_EDGE}, g as (select min(dst) as goal from ed), r as (select distinct src as root, [src] as path, src as node, []::varchar[] as es, 0 as hops from ed, g where src <> goal union all select r.root, list_append(r.path, ed.dst), ed.dst, list_append(r.es, ed.src || '>' || ed.dst), r.hops + 1 from r join ed on ed.src = r.node, g where r.node <> goal and r.hops < 3 and not list_contains(r.path, ed.dst)),
          p as (select array_to_string(es, ' ') as path_id, unnest(es) as edge_id from r, g where node = goal), x as (select path_id, n, case when n % 2 = 0 then 'even' when n % 3 = 0 then 'third' end as code from p join ed on ed.src || '>' || ed.dst = edge_id)
          select path_id, count(*)::bigint as hops, sum(n)::bigint as evidence, coalesce(string_agg(distinct code, ',' order by code), '') as codes from x group by path_id""",
        "c09_assumption_usage": "select n_nationkey, count(s_suppkey)::bigint as n_uses, case when count(s_suppkey) = 0 then 'no path uses it' end as reason from nation left join supplier on s_nationkey = n_nationkey group by 1",
        "c11_corner_witnesses": "select p_partkey as edge_id, '' as scenario from part where p_partkey < p_partkey",
        "c12_falsifiers": "with l as (select l_suppkey, count(*) as n, count(*) filter (where l_returnflag = 'R') as x from lineitem group by 1) select s_nationkey, case when not bool_and(coalesce(n >= 20, false)) then 'not_evaluable' when bool_or(x * 20 > n * 7) then 'triggered' else 'compatible' end as state from supplier left join l on l_suppkey = s_suppkey group by 1",
        "c22_competition": "select l_partkey, count(*)::bigint as propositions, count(distinct l_returnflag)::bigint as positions, case when count(distinct l_returnflag) = 2 then 'opposition' else 'divergence' end as relation from lineitem group by 1 having count(distinct l_returnflag) > 1",
        "c25_normalisation_collisions": "select regexp_replace(lower(trim(channel, ' ')), '[ _-]+', '_', 'g') as form, count(distinct channel)::bigint as spellings from pilot_sheet where channel is not null group by 1 having count(distinct channel) > 1",
        "c28_plan": f"with {SHARES}, l as (select channel, max(k) as k, arg_max(value, k) as v from shares group by 1) select case when k = (select max(k) from l) then channel || ': ' || ({r6_sql('v')})::decimal(18,6)::varchar else channel || ': refused' end as line from l",
        "c30_exposure_delta": "with b as (select l_suppkey, l_returnflag, count(*) as n from lineitem where l_shipdate::date <= date '1996-01-01' group by all), a as (select l_suppkey, l_returnflag, count(*) as n from lineitem where l_shipdate::date <= date '1996-01-15' group by all) select l_suppkey, l_returnflag, case when b.n is null then 'added' when a.n is null then 'removed' else 'changed' end as state from b full join a using (l_suppkey, l_returnflag) where a.n is distinct from b.n",
        "c33_ledger_delta": "with o as (select strftime(o_orderdate, '%Y-%m') as month, o_orderkey % 100 <> 99 or strftime(o_orderdate, '%Y-%m') < '1998-01' as early from orders), g as (select month, count(*) as na, count(*) filter (where early) as nb from o group by 1) select month, case when nb = 0 then 'added' when na = nb then 'same' else 'changed' end as state, (na - nb)::bigint as gained from g",
        "c36_stabbing": f"{_BASE}, y as (select strftime(m, '%Y-%m-%d') as d, (m::date - date '1970-01-01')::bigint as k from generate_series(date '1995-01-02', date '2001-12-02', interval 1 month) t(m)) select y.d, ep.channel, {day_sql('start_k')} as start from y join ep on y.k between start_k and end_k",
        "x03_provisional": f"with {slots} select {day_sql('k')} as d, case when count(distinct slot) = 48 then 'final' when count(*) >= 180 then 'provisional' else 'ephemeral' end as state, count(*)::bigint as n from e group by k",
        "x04_late_merge": f"{order_days} select {day_sql('k')} as d, case when k > (select max(k) - 14 from od) then value + 1 else value end as value from od where k % 11 <> 0 or k > (select max(k) - 14 from od)",
        "q02_dual_computation": "select '' as d from orders where o_orderkey < o_orderkey",
        "q03_replication": f"""with {SHARES}, n as (select *, row_number() over (partition by channel order by k) as i from shares),
          w as (select a.channel, a.k, count(b.value) as n, count(*) filter (where b.value <= a.value) as x, count(*) filter (where b.value < a.value) as y from shares a join shares b on a.channel = b.channel and b.k between a.k - 729 and a.k group by a.channel, a.k),
          r as (select a.channel, a.k, count(b.value) as n, count(*) filter (where b.value <= a.value) as x from n a join n b on a.channel = b.channel and b.i between a.i - 729 and a.i group by a.channel, a.k)
          select w.channel, count(*)::bigint as n, {r6_sql('count(*) filter (where abs(100.0 * y / w.n - 100.0 * w.x / w.n) < 1e-9) / count(*)')} as strict, {r6_sql('count(*) filter (where abs(50.0 * (w.x + y) / w.n - 100.0 * w.x / w.n) < 1e-9) / count(*)')} as midrank, {r6_sql('count(*) filter (where abs(100.0 * r.x / r.n - 100.0 * w.x / w.n) < 1e-9) / count(*)')} as rows from w join r on r.channel = w.channel and r.k = w.k where w.n >= 180 group by w.channel""",
        "q11_attested_windows": f"with {slots}, w as (select k, s as slot from (select distinct k from e), range(48) t(s)) select {day_sql('k')} as d, slot::bigint as slot from w where (k, slot) not in (select k, slot from e)",
        "q12_stamping": "select coalesce(nullif(trim(coder_note, ' '), ''), '(none)') as note, count(*)::bigint as n from pilot_sheet group by 1",
        "q15_weakest": "with s as (select lower(trim(domain, ' ')) as domain, case lower(trim(coder_confidence, ' ')) when '1' then 'low' when '2' then 'medium' when '3' then 'high' else lower(trim(coder_confidence, ' ')) end as c from pilot_sheet where domain is not null), r as (select domain, min(coalesce(list_position(['low', 'medium', 'high'], c), 0)) as r from s group by 1) select domain, case r when 1 then 'low' when 2 then 'medium' when 3 then 'high' else 'unknown' end as level from r",
    }


SQL = _sql()
