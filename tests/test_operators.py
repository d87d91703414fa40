"""Golden and adversarial cases of the series, interval, corpus, inference and evidence operators."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.functions.numbers import wilson
from tallyloom.operators import corpus, eventagg, evidence, inference, islands, neighbours, series


def long(spark, values, channel="a", start=19_000):
    return spark.createDataFrame([(channel, start + i, None if v is None else float(v)) for i, v in enumerate(values)], "channel string, k bigint, value double").withColumn("d", F.expr("date_add(date'1970-01-01', cast(k as int))")).select("channel", "d", "k", "value")


def synthetic():
    """400 days of lognormal values, four of them times six."""
    v = np.random.default_rng(7).lognormal(-3, 0.3, 400)
    v[300:304] *= 6
    return v


def test_percentile_of_own_value_and_gate(spark):
    s = long(spark, [1, 2, 3, 4, 5])
    assert [r.score for r in series.trailing_percentile(s, least=1).orderBy("k").collect()] == [100.0] * 5
    assert series.trailing_percentile(s, least=6).where("score is not null").count() == 0
    got = [r.score for r in series.trailing_percentile(long(spark, synthetic())).orderBy("k").collect()]
    assert got[:179] == [None] * 179 and got[179] is not None


def test_no_look_ahead(spark):
    v = synthetic()
    whole = {r.k: r.score for r in series.trailing_percentile(long(spark, v)).collect()}
    part = {r.k: r.score for r in series.trailing_percentile(long(spark, v[:350])).collect()}
    assert all(whole[k] == x for k, x in part.items())


def test_null_stays_null(spark):
    out = {r.k: r.score for r in series.trailing_percentile(long(spark, [1, None, 3]), least=1).collect()}
    assert out[19_001] is None and out[19_002] == 100.0


def test_blocks_of_days_agree(spark, monkeypatch):
    s = long(spark, synthetic())
    a = series.trailing_percentile(s, days=90, least=10).orderBy("k").collect()
    monkeypatch.setattr(series, "BLOCK_DAYS", 90)
    assert a == series.trailing_percentile(s, days=90, least=10).orderBy("k").collect()


def test_planted_spike(spark):
    e = islands.episodes(long(spark, synthetic())).collect()
    assert any(r.start_k <= 19_300 <= r.end_k for r in e)


def test_composite_is_strict(spark):
    s = long(spark, [1, 2], "a").unionByName(long(spark, [3, None], "b")).withColumnRenamed("value", "score")
    assert [r.composite for r in series.composite(s, 2).orderBy("k").collect()] == [2.0, None]


def test_climatology_of_a_weekly_spike(spark):
    days = spark.createDataFrame([("a", 7 * i) for i in range(10)], "channel string, k int")
    assert islands.islands(days, gap=3).count() == 10 and islands.islands(days, gap=7).count() == 1


def test_wilson(spark):
    rows = spark.createDataFrame([(0.0, 30_000.0), (30.0, 30_000.0), (5.0, 5.0), (0.0, 0.0)], "k double, n double")
    low, high = wilson(F.col("k"), F.col("n"))
    r = rows.select("k", "n", low.alias("lo"), high.alias("hi")).collect()
    assert r[0].lo == 0 and 0 < r[1].lo < 0.001 < r[1].hi and r[2].hi == 1 and r[3].lo is None


def test_three_layers(spark):
    df = spark.createDataFrame([("x", "p", 1), ("x", "q", 2), ("y", "p", 3), (None, "p", 4)], "a string, b string, v int")
    out = eventagg.layers(df, ["a", "b"], {"n": F.count(F.lit(1)), "s": F.sum("v")}, [[], ["a"], ["b"]]).collect()
    assert {(r.layer, r.a, r.b, r.n, r.s) for r in out} == {("all", None, None, 4, 10), ("a", "x", None, 2, 3), ("a", "y", None, 1, 3), ("a", None, None, 1, 4), ("b", None, "p", 3, 8), ("b", None, "q", 1, 2)}


def test_ring_arithmetic(spark):
    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    edges = spark.createDataFrame([("square", *a, *b) for a, b in zip(ring, ring[1:] + ring[:1])], "name string, x1 double, y1 double, x2 double, y2 double")
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.5, 0.5), (3, 0.5, 1.5), (4, None, 0.5)], "id int, lon double, lat double")
    assert [(r.id, r.name) for r in eventagg.points_in_polygons(points, edges, key="id").collect()] == [(1, "square")]


@pytest.mark.parametrize("listed", [256, 0])
def test_phrases_and_anchor(spark, listed):
    docs = spark.createDataFrame([(1, "The war-risk premium; underwriter"), (2, "war risk, premium"), (3, "wars risk premium"), (4, None), (5, "")], "doc_id int, text string")
    phrases = spark.createDataFrame([("g", "War risk premium"), ("h", "risk"), ("g", "")], "grp string, phrase string")
    got = {(r.doc_id, r.grp) for r in corpus.phrase_matches(docs, phrases, listed=listed).collect()}
    assert got == {(1, "g"), (2, "g"), (1, "h"), (2, "h"), (3, "h")}
    anchors = spark.createDataFrame([("g", "underwriter")], "grp string, anchor string")
    m = corpus.phrase_matches(docs, phrases).select("doc_id", "grp").distinct()
    assert {(r.doc_id, r.grp) for r in corpus.anchored(m, docs, anchors).collect()} == {(1, "g"), (1, "h"), (2, "h"), (3, "h")}


def test_normalisers_differ(spark):
    r = spark.createDataFrame([("a - b",)], "x string").select(corpus.norm(F.col("x")).alias("n"), corpus.headline_norm(F.col("x")).alias("h")).first()
    assert r.n == "a b" and " a b " not in r.h


def test_domain(spark):
    want = {"https://WWW.A.test:80/x?y": "a.test:80", "http://www.www.b.test": "www.b.test", "javascript:alert(1)": None, "": None, None: None}
    df = spark.createDataFrame([(k,) for k in want], "u string").select("u", corpus.domain(F.col("u")).alias("d"))
    assert {r.u: r.d for r in df.collect()} == want


def test_compose_queries():
    assert corpus.compose_queries(['"a b"', '"c"']) == ['("a b" OR "c")']
    assert corpus.compose_queries(['"a b"'], "India") == ['India ("a b")']
    terms = [f'"term {i}"' for i in range(60)]
    parts = corpus.compose_queries(terms, "India", 100)
    assert all(len(p) <= 100 for p in parts) and " OR ".join(p[len("India (") : -1] for p in parts) == " OR ".join(terms)
    with pytest.raises(ValueError):
        corpus.compose_queries(["x" * 300])


def test_step_up(spark):
    p = [0.001, 0.008, 0.039, 0.041, 0.6, None]
    got = inference.step_up(spark.createDataFrame(list(enumerate(p)), "i int, p double"), keys=["i"]).orderBy("i").collect()
    assert [r.significant for r in got] == [True, True, False, False, False]


def test_agreement(spark):
    df = spark.createDataFrame([("x", True, True)] * 4 + [("x", True, False), ("x", False, False)] + [("y", True, True)], "g string, a boolean, b boolean")
    got = {r.g: r for r in inference.agreement(df, ["g"], F.col("a"), F.col("b")).collect()}
    assert got["x"].kappa == pytest.approx((5 / 6 - (5 / 6 * 4 / 6 + 1 / 6 * 2 / 6)) / (1 - (5 / 6 * 4 / 6 + 1 / 6 * 2 / 6)))
    assert got["y"].kappa is None and got["y"].ac1 == 1.0


def test_finite_population_interval():
    assert inference.finite_population_interval(100, 100, 37) == (37, 37)
    low, high = inference.finite_population_interval(1000, 50, 5)
    assert 5 <= low < 100 < high <= 955
    assert inference.finite_population_interval(10, 5, 0)[0] == 0


def test_logit_and_r2(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal(3000)
    y = (rng.random(3000) < 1 / (1 + np.exp(-(0.5 + 1.5 * x)))).astype(float)
    b = inference.fit_logit(spark.createDataFrame([(float(a), float(c)) for a, c in zip(x, y)], "x double, y double"), "y", ["x"])
    assert b == pytest.approx([0.5, 1.5], abs=0.2)
    z = 2 * x + rng.standard_normal(3000)
    n, own, more = inference.incremental_r2(spark.createDataFrame([(float(a), float(c), 1.0 * i) for i, (a, c) in enumerate(zip(x, z))], "x double, z double, t double"), "z", ["t"], ["x"])
    assert n == 3000 and own < 0.01 and more == pytest.approx(0.8, abs=0.03)


def test_greedy_apart():
    assert inference.greedy_apart([(1, 9), (2, 10), (3, 8), (5, 8), (9, 1)], 3) == [(2, 10), (5, 8), (9, 1)]


def test_moving_blocks_respect_gaps():
    i = np.array([1, 2, 3, 10, 11, 12], float)
    low, high = inference.moving_block_interval(np.arange(6.0), np.arange(6.0), i, 3, 50, 1)
    assert low == pytest.approx(1) and high == pytest.approx(1)
    assert math.isnan(inference.moving_block_interval(np.arange(3.0), np.arange(3.0), np.array([1.0, 5, 9]), 2, 5, 1)[0])


def test_nearest_across_blocks(spark):
    rng = np.random.default_rng(1)
    m = rng.standard_normal((200, 8))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)] + [(900, None), (901, []), (902, [0.0] * 8)], "id int, v array<double>")
    got = {}
    for r in neighbours.nearest(df, df.where("id % 20 = 0"), key="id", vector="v", k=3, block=32).collect():
        got.setdefault(r.query, []).append((r.rank, r.neighbour))
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    for q in range(0, 200, 20):
        s = u @ u[q]
        s[q] = -9
        assert [n for _, n in sorted(got[q])] == list(np.argsort(-s)[:3])


def test_shock_interval(spark):
    edges = spark.createDataFrame([("e", 10, 15)], "edge_id string, lo int, hi int")
    s = spark.createDataFrame([("s", 30, 40, 20, 30, 10, 14, 3, 5)], "scenario string, shock_lo int, shock_hi int, sub_lo int, sub_hi int, days_lo int, days_hi int, buffer_lo int, buffer_hi int")
    r = evidence.shock_grid(edges, s).first()
    assert [float(x) for x in (r.gross_lo, r.gross_hi, r.residual_lo, r.residual_hi)] == [3.0, 6.0, 2.1, 4.8] and (r.duration_lo, r.duration_hi) == (5, 11)


def test_paths_are_simple_and_stop_at_the_target(spark):
    e = spark.createDataFrame([("a", "b", "1"), ("b", "a", "2"), ("b", "c", "3"), ("c", "t", "4"), ("a", "t", "5"), ("t", "a", "6")], "src string, dst string, edge_id string")
    got = {(tuple(r.path), r.hops) for r in evidence.bounded_paths(e, spark.createDataFrame([("a",)], "root string"), F.lit("t"), hops=3).collect()}
    assert got == {(("a", "t"), 1), (("a", "b", "c", "t"), 3)}


def test_reachable_and_components(spark):
    rng = random.Random(3)
    links = [(f"n{rng.randrange(80):02d}", f"n{rng.randrange(80):02d}") for _ in range(60)] + [(None, "n01"), ("n05", "n05")]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a and b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    find("n01")
    want = {}
    for n in parent:
        want.setdefault(find(n), set()).add(n)
    got = {}
    for r in evidence.components(spark.createDataFrame(links, "a string, b string")).collect():
        got.setdefault(r.component, set()).add(r.node)
    assert {frozenset(x) for x in got.values()} == {frozenset(x) for x in want.values()} and all(min(v) == k for k, v in got.items())
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y")], "src string, dst string")
    assert {(r.node, r.depth) for r in evidence.reachable(e, spark.createDataFrame([("a",)], "node string")).collect()} == {("a", 0), ("b", 1), ("c", 2)}


def test_universe_is_bounded(spark):
    with pytest.raises(ValueError, match="universe of 100"):
        evidence.universe([spark.range(10), spark.range(10).withColumnRenamed("id", "j")], most=99)


def test_pointer_paths():
    assert evidence.pointer_path("/a~1b/0/c~0d") == "$['a/b'][0]['c~d']"
    assert evidence.pointer_path("") == "$"
    with pytest.raises(ValueError):
        evidence.pointer_path("a")


def test_topological_order():
    assert evidence.topological_order([("a", "b"), ("a", "c")], {"c": (1,), "b": (2,), "a": (9,)}) == ["a", "c", "b"]
    with pytest.raises(ValueError, match="cycle"):
        evidence.topological_order([("a", "b"), ("b", "a")], {})


def test_supersession(spark):
    rows = spark.createDataFrame([(1, None, "2020-01-01", None), (2, 1, "2020-06-01", None), (3, 2, "2030-01-01", None), (4, None, "2019-01-01", "2019-12-31")], "id int, parent int, s string, e string")
    live = evidence.active_on(rows.withColumns({"s": F.to_date("s"), "e": F.to_date("e")}), F.lit("2021-01-01").cast("date"), key="id", parent="parent", start="s", end="e")
    assert {r.id for r in live.collect()} == {2}


def test_store_merges(spark):
    old = spark.createDataFrame([(1, 1.0, None), (2, 2.0, "b")], "k int, x double, y string")
    new = spark.createDataFrame([(2, None, "c"), (3, 3.0, "d")], "k int, x double, y string")
    assert {tuple(r) for r in series.cell_merge(old, new, ["k"], ["x", "y"]).collect()} == {(1, 1.0, None), (2, 2.0, "c"), (3, 3.0, "d")}
    assert {tuple(r) for r in series.upsert(old, new, ["k"]).collect()} == {(1, 1.0, None), (2, None, "c"), (3, 3.0, "d")}
    assert {tuple(r) for r in series.diff(old, new, ["k"], ["x", "y"]).collect()} == {(1, "removed"), (2, "changed"), (3, "added")}


def test_coverage_refusal(spark):
    m = series.monthly(long(spark, [1.0] * 14, start=19_723), floor=0.8).collect()
    assert m[0]["mean"] is None and m[0].reason == "below the 80% floor" and m[0].n == 14


def test_long_lists_of_cutoffs_and_scenarios_are_errors(spark):
    releases = spark.createDataFrame([("k", 1, 1, 7)], "id string, available_at int, sequence int, value int")
    cutoffs = spark.range(1, 1002).select(F.col("id").cast("int").alias("cutoff"))
    assert evidence.as_of(releases, cutoffs.limit(1000), ["id"]).count() == 1000
    with pytest.raises(ValueError, match="cutoffs"):
        evidence.as_of(releases, cutoffs, ["id"])
    with pytest.raises(ValueError, match="scenarios"):
        evidence.shock_grid(spark.range(1), cutoffs)
