"""Nothing is cut: long lists raise, deep chains, many fronts and long values come out whole."""

from fractions import Fraction
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import corpus, evidence, inference, islands


def exact_interval(population, sample, successes, alpha=Fraction(1, 20)):
    def tail(good, span):
        return sum(Fraction(comb(good, k) * comb(population - good, sample - k), comb(population, sample)) for k in span)

    span = range(successes, population - (sample - successes) + 1)
    low = [k for k in span if tail(k, range(successes, sample + 1)) > alpha / 2]
    high = [k for k in span if tail(k, range(successes + 1)) > alpha / 2]
    return min(low), max(high)


def test_interval_against_fractions():
    rng = np.random.default_rng(3)
    cases = [(16, 3, 1), (16, 13, 0), (16, 3, 2), (1, 1, 0), (1, 1, 1), (30, 30, 4)]
    for _ in range(150):
        n = int(rng.integers(1, 60))
        m = int(rng.integers(1, n + 1))
        cases.append((n, m, int(rng.integers(0, m + 1))))
    for case in cases:
        assert inference.finite_population_interval(*case) == exact_interval(*case), case
    low, high = inference.finite_population_interval(1_000_000, 500, 50)
    assert 70_000 < low < 80_000 and 120_000 < high < 135_000


def test_composed_queries(spark):
    assert corpus.compose_queries(["ab", "cd", "ef"], None, 10) == ["(ab OR cd)", "(ef)"]
    assert corpus.compose_queries(["ab", "cd"], "X", 11) == ["X (ab)", "X (cd)"]
    assert corpus.compose_queries([], None, 10) == []
    with pytest.raises(ValueError, match="too long"):
        corpus.compose_queries(["ok", "x" * 40], None, 20)
    rng = np.random.default_rng(0)
    for _ in range(200):
        terms = ["t" * int(k) for k in rng.integers(1, 15, rng.integers(1, 12))]
        got = corpus.compose_queries(terms, "IN", 40)
        parts = [g[4:-1].split(" OR ") for g in got]
        assert sum(parts, []) == terms and all(len(g) <= 40 for g in got)
        assert all(len(g) + 4 + len(p[0]) > 40 for g, p in zip(got, parts[1:]))
    df = spark.createDataFrame([("a", ["x1", "x2"], None), ("b", [], "IN"), ("c", None, "IN"), ("d", ["y"], "IN")], "g string, terms array<string>, anchor string")
    assert sorted((r.g, r.part, r.query) for r in corpus.composed(df, budget=6).collect()) == [("a", 0, "(x1)"), ("a", 1, "(x2)"), ("d", 0, "IN (y)")]


def test_many_cutoffs_and_scenarios_are_an_error(spark):
    releases = spark.createDataFrame([(1, 5, 1)], "k bigint, available_at bigint, sequence bigint")
    with pytest.raises(ValueError, match="more than 1000 cutoffs"):
        evidence.as_of(releases, spark.range(1500).select(F.col("id").alias("cutoff")), ["k"])
    scenarios = spark.range(1500).select(F.col("id").cast("string").alias("scenario"), *[F.lit(1).alias(c) for c in ("shock_lo", "shock_hi", "sub_lo", "sub_hi", "days_lo", "days_hi", "buffer_lo", "buffer_hi")])
    with pytest.raises(ValueError, match="more than 1000 scenarios"):
        evidence.shock_grid(spark.createDataFrame([("e", 1, 2)], "edge_id string, lo int, hi int"), scenarios)


def test_as_of_against_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(int(rng.integers(0, 9)), int(rng.integers(0, 50)), i, f"v{i}") for i in range(400)] + [(1, None, 999, "none")]
    cuts = sorted({int(c) for c in rng.integers(0, 60, 20)})
    got = {(r.cutoff, r.k): r.v for r in evidence.as_of(spark.createDataFrame(rows, "k bigint, available_at bigint, sequence bigint, v string"), spark.createDataFrame([(c,) for c in cuts] + [(cuts[0],), (None,)], "cutoff bigint"), ["k"]).collect()}
    want = {}
    for c in cuts:
        for k, t, s, v in rows:
            if t is not None and t <= c:
                want.setdefault((c, k), []).append((t, s, v))
    assert got == {key: max(x)[2] for key, x in want.items()}
    assert evidence.as_of(spark.createDataFrame(rows, "k bigint, available_at bigint, sequence bigint, v string"), spark.createDataFrame([], "cutoff bigint"), ["k"]).count() == 0


@pytest.fixture
def one_partition(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_deep_chain(spark, one_partition):
    edges = spark.range(24).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    got = {r.node: r.depth for r in evidence.reachable(edges, spark.range(1).select(F.col("id").alias("node"))).collect()}
    assert got == {i: i for i in range(25)}


def test_long_component(spark):
    links = spark.range(300).select((F.col("id") * 7919 % 100_003).alias("a"), ((F.col("id") + 1) * 7919 % 100_003).alias("b"))
    assert {r.component for r in evidence.components(links).collect()} == {0}


def test_many_layers(spark, one_partition):
    points = spark.createDataFrame([(i, float(i), None if i == 0 else float(i)) for i in range(12)] + [(100, 11.0, 11.0), (101, float("nan"), 70.0)], "n bigint, x double, y double")
    got = {r.n: r.layer for r in evidence.pareto_layers(points, ["x", "y"]).collect()}
    assert got == {i: 12 - i for i in range(12)} | {100: 1, 101: 1}


def test_layers_against_brute_force(spark):
    rng = np.random.default_rng(1)
    v = rng.integers(0, 8, (120, 3))
    got = {r.n: r.layer for r in evidence.pareto_layers(spark.createDataFrame([(i, *map(int, p)) for i, p in enumerate(v)], "n bigint, a bigint, b bigint, c bigint"), ["a", "b", "c"]).collect()}
    left, layer, want = list(range(len(v))), 0, {}
    while left:
        layer += 1
        front = [i for i in left if not any((v[j] >= v[i]).all() and (v[j] > v[i]).any() for j in left)]
        want |= dict.fromkeys(front, layer)
        left = [i for i in left if i not in front]
    assert got == want


def test_minimal_switches_against_brute_force(spark):
    rng = np.random.default_rng(2)
    changed = {int(m) for m in rng.integers(0, 128, 25)}
    df = spark.createDataFrame([(m, m in changed) for m in range(0, 128, 1) if m % 5 or m in changed], "mask int, changed boolean")
    want = {m for m in changed if not any(o & m == o and o != m for o in changed)}
    assert {r.mask for r in evidence.minimal_switches(df, 7).collect()} == want


def test_truncated_paths(spark):
    e = spark.createDataFrame([(s, t, f"{s}>{t}") for s in range(6) for t in range(6) if s != t], "src bigint, dst bigint, edge_id string")
    p = evidence.bounded_paths(e, spark.createDataFrame([(1,)], "root bigint"), F.lit(5), hops=3, most=4).collect()
    assert len(p) == 4 and all(r.truncated and r.n_paths == 1 + 4 + 12 for r in p) and min(r.hops for r in p) == 1
    assert sorted(r.edge_ids for r in p)[0][0] == "1>0"


def test_placements_against_brute_force(spark):
    rng = np.random.default_rng(8)
    span = {c: (int(a), int(a) + 80) for c, a in zip("abcd", rng.integers(0, 30, 4))}
    iv = [(c, s, min(span[c][1], s + int(rng.integers(0, 9)))) for c in "abcd" for s in range(span[c][0] + int(rng.integers(0, 10)), span[c][1], 23)]
    series = spark.createDataFrame([(c, k) for c, (lo, hi) in span.items() for k in (lo, hi)], "channel string, k bigint")
    got = {(r.channel, r.start_k): (r.n_starts, r.n_hits) for r in islands.placement_overlap(series, spark.createDataFrame(iv, "channel string, start_k bigint, end_k bigint")).collect()}
    want = {}
    for c, s, e in iv:
        others = {k for o, a, b in iv if o != c for k in range(a, b + 1)}
        places = range(span[c][0], span[c][1] - (e - s) + 1)
        want[c, s] = (len(places), sum(any(k in others for k in range(p, p + e - s + 1)) for p in places))
    assert got == want


def test_similarity_of_sets(spark):
    m = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), ("b", 3), ("c", 9), ("c", 2), (None, 2), ("a", None)], "o string, i bigint")
    got = {(r.a, r.b): (r.common, r.either) for r in corpus.set_similarity(m.where("o is not null"), "o", "i").collect()}
    assert got[("b", "c")] == (1, 3) and got.keys() == {("a", "b"), ("a", "c"), ("b", "c")}
