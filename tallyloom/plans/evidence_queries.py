"""Releases, validity, paths, intervals and lattices on stand-ins from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import drift
from ..operators import evidence as V
from ..operators import series as S
from .base import day, load, r6, r6_sql

CUTOFFS = ("1996-06-30", "1998-12-31", "2001-12-31")


def f10_effective(spark: SparkSession, d: str) -> DataFrame:
    """Items by whether they are in force on a day: from shipping on, for 400 days, those of line 7 without end."""
    li = load(spark, d, "lineitem")
    end = F.when(F.col("l_linenumber") != 7, F.date_add(F.to_date("l_shipdate"), 400))
    reason = V.effective(F.lit("1998-06-01").cast("date"), F.to_date("l_shipdate"), end)
    return li.groupBy(F.coalesce(reason, F.lit("in force")).alias("state")).agg(F.count(F.lit(1)).alias("n"))


def j08_asof_release(spark: SparkSession, d: str) -> DataFrame:
    """The last order of each customer known at each cutoff."""
    o = load(spark, d, "orders").select("o_custkey", F.to_date("o_orderdate").alias("available_at"), F.col("o_orderkey").alias("sequence"), "o_orderstatus")
    c = spark.createDataFrame([(x,) for x in CUTOFFS], "cutoff string").select(F.col("cutoff").cast("date").alias("cutoff"))
    return V.as_of(o, c, ["o_custkey"]).select(F.col("cutoff").cast("string").alias("cutoff"), "o_custkey", "sequence", "o_orderstatus")


def j09_asof_week_before(spark: SparkSession, d: str) -> DataFrame:
    """For each customer the last order at least seven days before its last one."""
    o = load(spark, d, "orders").select("o_custkey", F.to_date("o_orderdate").alias("d"), "o_orderkey")
    last = o.groupBy("o_custkey").agg(F.max("d").alias("last"))
    before = o.join(last, "o_custkey").where("d <= date_sub(last, 7)").groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("d", "o_orderkey")).alias("o_orderkey"))
    return last.select("o_custkey").join(before, "o_custkey", "left")


def c18_bitemporal(spark: SparkSession, d: str) -> DataFrame:
    """At each cutoff of knowledge: items of known orders by their state on the day of validity half a year before it."""
    li = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.to_date("l_shipdate").alias("s"))
    o = load(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("known"))
    c = spark.createDataFrame([(x,) for x in CUTOFFS], "cutoff string").select(F.col("cutoff").cast("date").alias("cutoff"))
    j = li.join(o, "o_orderkey").join(F.broadcast(c), F.col("known") <= F.col("cutoff"))
    state = F.coalesce(V.effective(F.date_sub("cutoff", 182), F.col("s"), F.date_add("s", 365)), F.lit("included"))
    return j.groupBy(F.col("cutoff").cast("string").alias("cutoff"), state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


def _edges(spark: SparkSession, d: str) -> DataFrame:
    """Trade between nations: each supplying nation's three largest customer nations."""
    from ..operators.corpus import top_per_key

    li = load(spark, d, "lineitem").select("l_suppkey", F.col("l_orderkey").alias("o_orderkey"))
    s = load(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("src"))
    o = load(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    c = load(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("dst"))
    n = li.join(s, "l_suppkey").join(o, "o_orderkey").join(c, "c_custkey").where("src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    return top_per_key(n, ["src"], [F.desc("n"), F.col("dst")], 3, F.col("dst")).select("src", "dst", F.concat_ws(">", "src", "dst").alias("edge_id"), "n")


def c05_graph_projection(spark: SparkSession, d: str) -> DataFrame:
    return _edges(spark, d).select("src", "dst", "n")


def c06_bounded_paths(spark: SparkSession, d: str) -> DataFrame:
    e = _edges(spark, d).persist()
    target = e.agg(F.min("dst")).first()[0]
    p = V.bounded_paths(e, e.select(F.col("src").alias("root")).where(F.col("root") != target).distinct(), F.lit(target), hops=4)
    return p.select("root", F.array_join(F.transform("path", lambda x: x.cast("string")), ">").alias("path"), F.col("hops").cast("bigint").alias("hops"))


def c20_blast_radius(spark: SparkSession, d: str) -> DataFrame:
    e = _edges(spark, d).persist()
    r = V.reachable(e, e.agg(F.min("src").alias("node")))
    return r.select("node", F.col("depth").cast("bigint").alias("depth"))


def c21_components(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the coder sheet linked by an equal title or an equal address: members and size of each component."""
    s = load(spark, d, "pilot_sheet")
    key = lambda c: F.concat(F.lit(c[0] + ":"), F.col(c))
    row = F.concat(F.lit("~"), F.lpad(F.col("sheet_row").cast("string"), 20, "0"))
    links = s.where("title is not null").select(row.alias("a"), key("title").alias("b")).union(s.where("url is not null").select(row.alias("a"), key("url").alias("b")))
    c = V.components(links).where("node like '~%'")
    least = c.groupBy("component").agg(F.min("node").alias("m"), F.count(F.lit(1)).alias("n"))
    return least.select(F.substring("m", 2, 20).cast("bigint").alias("first_row"), "n")


SCENARIOS = [("mild", 10, 15, 20, 30, 10, 14, 3, 5), ("hard", 30, 40, 0, 10, 30, 60, 5, 9)]
_SCENARIO = "scenario string, shock_lo int, shock_hi int, sub_lo int, sub_hi int, days_lo int, days_hi int, buffer_lo int, buffer_hi int"


def _shock(spark: SparkSession, d: str) -> DataFrame:
    p = load(spark, d, "part").select(F.col("p_partkey").alias("edge_id"), F.col("p_retailprice").cast("decimal(12,2)").alias("lo"), (F.col("p_retailprice").cast("decimal(12,2)") + F.col("p_size")).alias("hi"))
    return V.shock_grid(p, spark.createDataFrame(SCENARIOS, _SCENARIO))


def c08_shock_grid(spark: SparkSession, d: str) -> DataFrame:
    g = _shock(spark, d)
    return g.select("edge_id", "scenario", *[F.col(c).cast("double").alias(c) for c in ("gross_lo", "gross_hi", "residual_lo", "residual_hi")], F.col("duration_lo").cast("bigint").alias("duration_lo"), F.col("duration_hi").cast("bigint").alias("duration_hi"))


def c10_constraints(spark: SparkSession, d: str) -> DataFrame:
    s = V.constraint_state(F.col("residual_lo"), F.col("residual_hi"), F.lit(150))
    return _shock(spark, d).groupBy("scenario", s.alias("state")).agg(F.count(F.lit(1)).alias("n"))


def _lattice(spark: SparkSession) -> DataFrame:
    """All 32 masks of five atoms, with the option that a rule gives them."""
    v = spark.range(32).select(F.col("id").cast("int").alias("mask"))
    bit = lambda i: F.col("mask").bitwiseAND(1 << i) != 0
    option = F.when(bit(0) & bit(1), "b").when(bit(2), "c").when(bit(3) & bit(4) & ~bit(1), "d").otherwise("a")
    return v.withColumn("option", option).withColumn("changed", option != "a")


def c13_lattice(spark: SparkSession, d: str) -> DataFrame:
    return _lattice(spark).groupBy("option").agg(F.count(F.lit(1)).alias("n"), F.sum("mask").alias("masks"))


def c14_minimal(spark: SparkSession, d: str) -> DataFrame:
    return V.minimal_switches(_lattice(spark), 5).select(F.col("mask").cast("bigint").alias("mask"))


def c15_partition(spark: SparkSession, d: str) -> DataFrame:
    return V.partition_vector(_lattice(spark), 5, "option").select(F.col("atom").cast("bigint").alias("atom"), "cells", "decisive")


def c16_pareto(spark: SparkSession, d: str) -> DataFrame:
    """Nations by customers, rich customers and suppliers: the front of those that none beats in everything, and so on."""
    c = load(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n")).agg(F.count(F.lit(1)).alias("customers"), F.count_if(F.col("c_acctbal") > 5000).alias("rich"))
    s = load(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("n")).agg(F.count(F.lit(1)).alias("suppliers"))
    p = c.join(s, "n", "left").fillna(0)
    return V.pareto_layers(p, ["customers", "rich", "suppliers"]).select("n", "customers", "rich", "suppliers", F.col("layer").cast("bigint").alias("layer"))


def c19_active_set(spark: SparkSession, d: str) -> DataFrame:
    """Orders in force on a day, less those that a later one of the same customer in force supersedes."""
    o = load(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("s"), F.date_add(F.to_date("o_orderdate"), 300).alias("e"), F.when(F.col("o_orderkey") % 4 == 1, F.col("o_orderkey") - 1).alias("parent"))
    return V.active_on(o, F.lit("1998-06-01").cast("date"), key="o_orderkey", parent="parent", start="s", end="e").select("o_orderkey")


def c26_universe(spark: SparkSession, d: str) -> DataFrame:
    """All combinations of three domains with their number, and a state that is overridden for some."""
    seg = load(spark, d, "customer").select("c_mktsegment").distinct()
    pri = load(spark, d, "orders").select("o_orderpriority").distinct()
    flag = load(spark, d, "lineitem").select("l_returnflag").distinct()
    over = spark.createDataFrame([("MACHINERY", "1-URGENT", "R", "denied"), ("BUILDING", "5-LOW", "A", "limited")], "c_mktsegment string, o_orderpriority string, l_returnflag string, state string")
    u = V.universe([seg, pri, flag]).join(F.broadcast(over), ["c_mktsegment", "o_orderpriority", "l_returnflag"], "left")
    ranked = V.rank_within(u, [], [F.col("c_mktsegment"), F.col("o_orderpriority"), F.col("l_returnflag")])
    return ranked.select("c_mktsegment", "o_orderpriority", "l_returnflag", F.coalesce("state", F.lit("open")).alias("state"), F.col("ordinal").cast("bigint").alias("ordinal"))


def c24_nary_denominators(spark: SparkSession, d: str) -> DataFrame:
    """Joint cells (nation, type, priority) by role and state, no row lost."""
    li = load(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey")
    j = li.join(load(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey", "left").join(load(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey", "left").join(load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority"), "l_orderkey", "left")
    cells = j.groupBy("s_nationkey", "p_type", "o_orderpriority").agg(F.count(F.lit(1)).alias("mass"))
    roles = cells.select("mass", F.explode(F.map_from_arrays(F.array(F.lit("nation"), F.lit("type"), F.lit("priority")), F.array(F.col("s_nationkey").cast("string"), F.col("p_type"), F.col("o_orderpriority")))).alias("role", "entity"))
    return roles.groupBy("role", F.when(F.col("entity").isNull(), "missing").otherwise("resolved").alias("state")).agg(F.count(F.lit(1)).alias("cells"), F.sum("mass").alias("mass"), F.count_distinct("entity").alias("entities"))


def j14_digest_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Lines of a receipt file that were delivered with differing contents."""
    r = load(spark, d, "publication_receipts").select("receipt_file", "line_no", F.sha2("payload", 256).alias("digest"))
    return V.conflicting(r, ["receipt_file", "line_no"], "digest").select("receipt_file", "line_no", "n")


def j15_lane_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Events of a week routed to lanes by type; every lane is there, outsiders are counted with their reason."""
    lanes = spark.createDataFrame([("click", "traffic"), ("view", "traffic"), ("purchase", "sales"), ("refund", "returns")], "event_type string, lane string")
    e = load(spark, d, "events").select("event_type", S.epoch_day(F.to_date("ts")).alias("k"))
    j = e.join(F.broadcast(lanes), "event_type", "left")
    state = F.when(F.col("lane").isNull(), "no lane").when(~F.col("k").between(19730, 19736), "outside window").otherwise("present")
    n = j.groupBy("lane", state.alias("state")).agg(F.count(F.lit(1)).alias("n"))
    return lanes.select("lane").distinct().join(n, "lane", "full_outer").select("lane", F.coalesce("state", F.lit("absent")).alias("state"), F.coalesce("n", F.lit(0)).alias("n"))


def j19_crosswalk(spark: SparkSession, d: str) -> DataFrame:
    """Values that a crosswalk from domains to tiers doesn't map, and mapped ones that don't occur."""
    used = load(spark, d, "documents").where("source is not null").groupBy(F.col("source").alias("domain")).agg(F.count(F.lit(1)).alias("n"))
    j = used.join(load(spark, d, "source_tiers"), "domain", "full_outer")
    return j.groupBy(F.when(F.col("tier").isNull(), "unmapped").when(F.col("n").isNull(), "unused").otherwise("mapped").alias("state")).agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("rows"))


def c32_world_frame(spark: SparkSession, d: str) -> DataFrame:
    """Coverage of each layer over all nations: the denominator is the whole frame."""
    frame = load(spark, d, "nation").select("n_nationkey")
    layers = {"customers": load(spark, d, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("n_nationkey")), "suppliers": load(spark, d, "supplier").select(F.col("s_nationkey").alias("n_nationkey"))}
    rows = None
    for name, x in layers.items():
        cell = frame.join(x.groupBy("n_nationkey").agg(F.count(F.lit(1)).alias("x")), "n_nationkey", "left").agg(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("members"), F.count("x").alias("observed"))
        rows = cell if rows is None else rows.unionByName(cell)
    return rows.withColumn("coverage", r6(F.col("observed") / F.col("members")))


def c34_rights(spark: SparkSession, d: str) -> DataFrame:
    """Customers by whether their segment's permitted uses, approval and dates admit a use."""
    uses = F.when(F.col("c_nationkey") % 3 == 0, F.array(F.lit("read"), F.lit("derive"), F.lit("publish"))).otherwise(F.array(F.lit("read"), F.lit("derive")))
    ok = V.permitted(uses, ["read", "publish"], F.col("c_acctbal") > 0, F.lit(19000), F.lit(18000) + F.col("c_custkey") % 1500, F.lit(20000))
    return load(spark, d, "customer").groupBy("c_mktsegment", ok.alias("admitted")).agg(F.count(F.lit(1)).alias("n"))


def f12_pointer(spark: SparkSession, d: str) -> DataFrame:
    """A member of the receipts by JSON pointer."""
    r = load(spark, d, "publication_receipts")
    return r.groupBy(F.get_json_object("payload", V.pointer_path("/frame/validator")).alias("validator")).agg(F.count(F.lit(1)).alias("n"))


def f16_strict_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Confidence cells of the coder sheet by what a strict reading makes of them."""
    c = F.col("coder_confidence")
    state = F.when(c.isNull(), "missing").when(c.rlike("^[0-9]+$"), "integer").when(c.rlike(r"^[=+\-@]"), "formula").otherwise("text")
    return load(spark, d, "pilot_sheet").groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


def f19_walk(spark: SparkSession, d: str) -> DataFrame:
    """How many receipts have each path."""
    lines = drift.load_lines(load(spark, d, "publication_receipts").select("payload"))
    return lines.select(F.explode("fields").alias("f")).groupBy("f.path", "f.type").agg(F.count(F.lit(1)).alias("n"))


def q01_completeness(spark: SparkSession, d: str) -> DataFrame:
    """Days of the calendar that lack a channel."""
    from .base import shares

    s = shares(spark, d)
    span = s.agg(F.min("k").alias("lo"), F.max("k").alias("hi")).select(F.explode(F.sequence("lo", "hi")).alias("k"))
    n = s.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return span.join(n, "k", "left").where("coalesce(n, 0) < 3").select(day("k").alias("d"), F.coalesce("n", F.lit(0)).alias("n"))


def q04_staleness(spark: SparkSession, d: str) -> DataFrame:
    """Sources by the age of their last document against their tier's policy; unknown tiers have none."""
    docs = load(spark, d, "documents").where("source is not null and seen_at is not null").groupBy(F.col("source").alias("domain")).agg(F.max(S.epoch_day(F.to_date("seen_at"))).alias("k"))
    now = docs.agg(F.max("k").alias("now"))
    j = docs.join(load(spark, d, "source_tiers"), "domain", "left").join(now, F.lit(True))
    age, allowed = F.col("now") - F.col("k"), F.col("tier") * 3
    return j.select("domain", age.cast("bigint").alias("age"), F.when(F.col("tier").isNull(), "unknown_policy").when(age > allowed, "stale").otherwise("fresh").alias("state"))


def q05_provenance(spark: SparkSession, d: str) -> DataFrame:
    """By order: recorded if the first delivery has it, else reconstructed; a recorded one wins."""
    o = load(spark, d, "orders")
    basis = o.where("o_orderkey % 2 = 0").select("o_orderkey", F.lit(0).alias("b")).unionByName(o.where("o_orderkey % 3 = 0").select("o_orderkey", F.lit(1).alias("b")))
    b = basis.groupBy("o_orderkey").agg(F.min("b").alias("b"))
    return o.select("o_orderkey", "o_orderpriority").join(b, "o_orderkey", "left").groupBy("o_orderpriority", F.when(F.col("b") == 0, "recorded").when(F.col("b") == 1, "reconstructed").otherwise("none").alias("basis")).agg(F.count(F.lit(1)).alias("n"))


def q07_append_only(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the earlier archive that the later one lacks or has changed: none."""
    o = load(spark, d, "orders").select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("d"))
    before, after = o.where("d < '2000-01-01'"), o
    return before.join(after, ["o_orderkey", "o_totalprice", "d"], "left_anti").select("o_orderkey")


def q08_integrity_rules(spark: SparkSession, d: str) -> DataFrame:
    """Violating rows of a catalogue of rules over the star schema, by rule."""
    li, o, c = load(spark, d, "lineitem"), load(spark, d, "orders"), load(spark, d, "customer")
    rules = {
        "item without order": li.join(o.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_anti"),
        "order without customer": o.join(c.select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_anti"),
        "line number repeated": li.groupBy("l_orderkey", "l_linenumber").count().where("count > 1"),
        "discount out of range": li.where("l_discount < 0 or l_discount > 0.1"),
        "shipped before ordered": li.join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey").where("l_shipdate < o_orderdate"),
        "customer key repeated": c.groupBy("c_custkey").count().where("count > 1"),
    }
    out = None
    for name, x in rules.items():
        n = x.agg(F.lit(name).alias("rule"), F.count(F.lit(1)).alias("violations"))
        out = n if out is None else out.unionByName(n)
    return out


QUERIES = {
    f.__name__: f
    for f in (
        f10_effective, f12_pointer, f16_strict_numbers, f19_walk, j08_asof_release, j09_asof_week_before, j14_digest_conflicts, j15_lane_matrix, j19_crosswalk, c05_graph_projection, c06_bounded_paths, c08_shock_grid, c10_constraints,
        c13_lattice, c14_minimal, c15_partition, c16_pareto, c18_bitemporal, c19_active_set, c20_blast_radius, c21_components, c24_nary_denominators, c26_universe, c32_world_frame, c34_rights, q01_completeness, q04_staleness, q05_provenance,
        q07_append_only, q08_integrity_rules,
    )
}

_CUT = f"cut as (select unnest([{', '.join(f'''date '{c}' ''' for c in CUTOFFS)}]) as cutoff)"
_EDGE = "ed as (select src, dst, n from (select s_nationkey as src, c_nationkey as dst, count(*) as n from lineitem join supplier on s_suppkey = l_suppkey join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey where s_nationkey <> c_nationkey group by all) qualify row_number() over (partition by src order by n desc, dst) <= 3)"
_LAT = "v as (select m::int as mask, case when m & 1 <> 0 and m & 2 <> 0 then 'b' when m & 4 <> 0 then 'c' when m & 8 <> 0 and m & 16 <> 0 and m & 2 = 0 then 'd' else 'a' end as option from range(32) t(m))"
_GRID = f"""sc as (select * from (values {', '.join(str(x) for x in SCENARIOS)}) t(scenario, sl, sh, ul, uh, dl, dh, bl, bh)), p as (select p_partkey as edge_id, p_retailprice::decimal(12,2) as lo, p_retailprice::decimal(12,2) + p_size as hi from part),
  g as (select edge_id, scenario, round(lo * sl / 100.0, 6) as gross_lo, round(hi * sh / 100.0, 6) as gross_hi, round(lo * sl / 100.0 * (100 - uh) / 100.0, 6) as residual_lo, round(hi * sh / 100.0 * (100 - ul) / 100.0, 6) as residual_hi, greatest(0, dl - bh)::bigint as duration_lo, greatest(0, dh - bl)::bigint as duration_hi from p, sc)"""

SQL = {
    "f10_effective": "select case when l_shipdate::date > date '1998-06-01' then 'not_yet' when l_linenumber <> 7 and l_shipdate::date + 400 < date '1998-06-01' then 'expired' else 'in force' end as state, count(*)::bigint as n from lineitem group by 1",
    "f12_pointer": "select case when json_valid(payload) then json_extract_string(payload, '/frame/validator') end as validator, count(*)::bigint as n from publication_receipts group by 1",
    "f16_strict_numbers": r"select case when coder_confidence is null then 'missing' when regexp_full_match(coder_confidence, '[0-9]+') then 'integer' when regexp_matches(coder_confidence, '^[=+\-@]') then 'formula' else 'text' end as state, count(*)::bigint as n from pilot_sheet group by 1",
    "j08_asof_release": f"with {_CUT} select strftime(cutoff, '%Y-%m-%d') as cutoff, o_custkey, arg_max(o_orderkey, row(o_orderdate, o_orderkey)) as sequence, arg_max(o_orderstatus, row(o_orderdate, o_orderkey)) as o_orderstatus from cut join orders on o_orderdate::date <= cutoff group by cutoff, o_custkey",
    "j09_asof_week_before": "with l as (select o_custkey, max(o_orderdate::date) as last from orders group by 1) select l.o_custkey, arg_max(o.o_orderkey, row(o.o_orderdate::date, o.o_orderkey)) as o_orderkey from l left join orders o on o.o_custkey = l.o_custkey and o.o_orderdate::date <= last - 7 group by l.o_custkey",
    "j14_digest_conflicts": "select receipt_file, line_no, count(distinct payload)::bigint as n from publication_receipts group by all having count(distinct payload) > 1",
    "j15_lane_matrix": "with l as (select * from (values ('click', 'traffic'), ('view', 'traffic'), ('purchase', 'sales'), ('refund', 'returns')) t(event_type, lane)), n as (select lane, case when lane is null then 'no lane' when not ((ts::date - date '1970-01-01') between 19730 and 19736) then 'outside window' else 'present' end as state, count(*) as n from events left join l using (event_type) group by all) select coalesce(n.lane, d.lane) as lane, coalesce(state, 'absent') as state, coalesce(n, 0)::bigint as n from (select distinct lane from l) d full join n on n.lane = d.lane",
    "j19_crosswalk": "with u as (select source as domain, count(*) as n from documents where source is not null group by 1) select case when tier is null then 'unmapped' when n is null then 'unused' else 'mapped' end as state, count(*)::bigint as values, sum(n)::bigint as rows from u full join source_tiers t on t.domain = u.domain group by 1",
    "c05_graph_projection": f"with {_EDGE} select src, dst, n::bigint as n from ed",
    "c06_bounded_paths": f"with recursive {_EDGE}, g as (select min(dst) as goal from ed), r as (select distinct src as root, [src] as path, src as node, 0 as hops from ed, g where src <> goal union all select r.root, list_append(r.path, ed.dst), ed.dst, r.hops + 1 from r join ed on ed.src = r.node, g where r.node <> goal and r.hops < 4 and not list_contains(r.path, ed.dst)) select root, array_to_string(path, '>') as path, hops::bigint as hops from r, g where node = goal",
    "c08_shock_grid": f"with {_GRID} select edge_id, scenario, gross_lo::double as gross_lo, gross_hi::double as gross_hi, residual_lo::double as residual_lo, residual_hi::double as residual_hi, duration_lo, duration_hi from g",
    "c10_constraints": f"with {_GRID} select scenario, case when residual_hi <= 150 then 'all' when residual_lo > 150 then 'none' else 'mixed' end as state, count(*)::bigint as n from g group by all",
    "c13_lattice": f"with {_LAT} select option, count(*)::bigint as n, sum(mask)::bigint as masks from v group by option",
    "c14_minimal": f"with {_LAT} select mask::bigint as mask from v a where option <> 'a' and not exists (select 1 from v b where b.option <> 'a' and b.mask & a.mask = b.mask and b.mask <> a.mask)",
    "c15_partition": f"with {_LAT}, x as (select i as atom, mask & ~(1 << i) as bg, count(distinct option) as k from v, range(5) t(i) group by all) select atom::bigint as atom, count(*)::bigint as cells, (count(*) filter (where k > 1))::bigint as decisive from x group by atom",
    "c16_pareto": """with recursive p as (select c_nationkey as n, count(*) as customers, count(*) filter (where c_acctbal > 5000) as rich, coalesce(any_value(s), 0) as suppliers from customer left join (select s_nationkey, count(*) as s from supplier group by 1) on s_nationkey = c_nationkey group by 1),
      dom as (select b.n as hi, a.n as lo from p a join p b on b.customers >= a.customers and b.rich >= a.rich and b.suppliers >= a.suppliers and (b.customers > a.customers or b.rich > a.rich or b.suppliers > a.suppliers)),
      r as (select n, 1 as depth from p union select lo, depth + 1 from r join dom on hi = n)
      select p.n, customers::bigint as customers, rich::bigint as rich, suppliers::bigint as suppliers, max(depth)::bigint as layer from p join r using (n) group by all""",
    "c18_bitemporal": f"with {_CUT} select strftime(cutoff, '%Y-%m-%d') as cutoff, case when l_shipdate::date > cutoff - 182 then 'not_yet' when l_shipdate::date + 365 < cutoff - 182 then 'expired' else 'included' end as state, count(*)::bigint as n from lineitem join orders on o_orderkey = l_orderkey join cut on o_orderdate::date <= cutoff group by all",
    "c19_active_set": "with o as (select o_orderkey, case when o_orderkey % 4 = 1 then o_orderkey - 1 end as parent from orders where date '1998-06-01' between o_orderdate::date and o_orderdate::date + 300) select o_orderkey from o where o_orderkey not in (select parent from o where parent is not null)",
    "c20_blast_radius": f"with recursive {_EDGE}, r as (select min(src) as node, 0 as depth from ed union select ed.dst, r.depth + 1 from r join ed on ed.src = r.node where r.depth < 25) select node, min(depth)::bigint as depth from r group by node",
    "c24_nary_denominators": "with c as (select s_nationkey, p_type, o_orderpriority, count(*) as mass from lineitem left join part on p_partkey = l_partkey left join supplier on s_suppkey = l_suppkey left join orders on o_orderkey = l_orderkey group by all), r as (select 'nation' as role, s_nationkey::varchar as e, mass from c union all select 'type', p_type, mass from c union all select 'priority', o_orderpriority, mass from c) select role, case when e is null then 'missing' else 'resolved' end as state, count(*)::bigint as cells, sum(mass)::bigint as mass, count(distinct e)::bigint as entities from r group by all",
    "c26_universe": "with u as (select * from (select distinct c_mktsegment from customer), (select distinct o_orderpriority from orders), (select distinct l_returnflag from lineitem)) select c_mktsegment, o_orderpriority, l_returnflag, case when (c_mktsegment, o_orderpriority, l_returnflag) = ('MACHINERY', '1-URGENT', 'R') then 'denied' when (c_mktsegment, o_orderpriority, l_returnflag) = ('BUILDING', '5-LOW', 'A') then 'limited' else 'open' end as state, (row_number() over (order by c_mktsegment, o_orderpriority, l_returnflag) - 1)::bigint as ordinal from u",
    "c32_world_frame": f"with a as (select 'customers' as layer, count(*) as members, count(x) as observed from nation left join (select c_nationkey, count(*) as x from customer where c_acctbal > 9000 group by 1) on c_nationkey = n_nationkey union all select 'suppliers', count(*), count(x) from nation left join (select s_nationkey, count(*) as x from supplier group by 1) on s_nationkey = n_nationkey) select layer, members::bigint as members, observed::bigint as observed, {r6_sql('observed / members')} as coverage from a",
    "c34_rights": "select c_mktsegment, c_nationkey % 3 = 0 and c_acctbal > 0 and 19000 >= 18000 + c_custkey % 1500 as admitted, count(*)::bigint as n from customer group by all",
    "q01_completeness": "with s as (select distinct l_returnflag as c, (l_shipdate::date - date '1970-01-01')::bigint as k from lineitem), n as (select k, count(*) as n from s group by k), c as (select unnest(generate_series(min(k), max(k))) as k from s) select strftime(make_timestamp(k * 86400000000), '%Y-%m-%d') as d, coalesce(n, 0)::bigint as n from c left join n using (k) where coalesce(n, 0) < 3",
    "q04_staleness": "with d as (select source as domain, max(seen_at::date) as k from documents where source is not null and seen_at is not null group by 1), a as (select d.domain, (max(k) over () - k)::bigint as age, tier from d left join source_tiers t on t.domain = d.domain) select domain, age, case when tier is null then 'unknown_policy' when age > tier * 3 then 'stale' else 'fresh' end as state from a",
    "q05_provenance": "select o_orderpriority, case when o_orderkey % 2 = 0 then 'recorded' when o_orderkey % 3 = 0 then 'reconstructed' else 'none' end as basis, count(*)::bigint as n from orders group by all",
    "q07_append_only": "select o_orderkey from orders where o_orderkey < o_orderkey",
    "q08_integrity_rules": """select 'item without order' as rule, count(*)::bigint as violations from lineitem where l_orderkey not in (select o_orderkey from orders)
      union all select 'order without customer', count(*)::bigint from orders where o_custkey not in (select c_custkey from customer)
      union all select 'line number repeated', count(*)::bigint from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
      union all select 'discount out of range', count(*)::bigint from lineitem where l_discount < 0 or l_discount > 0.1
      union all select 'shipped before ordered', count(*)::bigint from lineitem join orders on o_orderkey = l_orderkey where l_shipdate < o_orderdate
      union all select 'customer key repeated', count(*)::bigint from (select 1 from customer group by c_custkey having count(*) > 1)""",
}
