import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.instants import compact_utc, instant_micros
from tallyloom.operators import grid, rolling

SCHEMA = "row_id bigint, series_id string, date string, value double, step_seconds int, source string, k string, _b int"


def readings(spark, rows):
    """Rows (row_id, series_id, date, value, step) with columns whose names clash with those used inside."""
    return spark.createDataFrame([(*r, "x", "y", 3) for r in rows], SCHEMA)


INSTANTS = {
    "20240101T000000Z": "2024-01-01T00:00:00", " 20240101t000001z\t": "2024-01-01T00:00:01", "2024-01-01T05:30:00+05:30": "2024-01-01T00:00:00", "2024-01-01 00:00:00": "2024-01-01T00:00:00",
    "2024-01-01T00:00:00.250Z": "2024-01-01T00:00:00.250000", "20240101000000": "2024-01-01T00:00:00", "1704067200": "2024-01-01T00:00:00", "1704067200000": "2024-01-01T00:00:00",
    "20240101T053000+0530": "2024-01-01T00:00:00", "2024-01-01T00:00Z": "2024-01-01T00:00:00", "2024-01-01T00:00:00-03:00": "2024-01-01T03:00:00",
    "20241301T000000Z": None, "20230229T000000Z": None, "2024-01-01": None, "20240101": None, "n/a": None, "": None, None: None, "2024-01-01T24:00:00Z": None, "+1704067200": None,
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_instants(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(k,) for k in INSTANTS], "s string").select("s", instant_micros(F.col("s")).alias("m"), compact_utc(F.floor(instant_micros(F.col("s")) / 1_000_000)).alias("c"))
        for r in df.collect():
            want = INSTANTS[r.s]
            at = None if want is None else dt.datetime.fromisoformat(want + "+00:00")
            assert r.m == (None if at is None else round(at.timestamp() * 1e6)), r
            assert r.c == (None if at is None else at.strftime("%Y%m%dT%H%M%SZ"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_grid_marks_and_fills(spark):
    rows = [
        (1, "a", "1970-01-01T00:00:10Z", 1.0, 60), (2, "a", "1970-01-01T00:00:50Z", 2.0, 60), (3, "a", "1970-01-01T00:02:00Z", 4.0, 60), (4, "a", "1970-01-01T00:10:00Z", 5.0, 60),
        (5, "a", "1970-01-01T00:05:00Z", float("nan"), 60), (6, "a", "nowhere", 3.0, 60), (7, "a", "1970-01-01T00:04:00Z", None, 60), (8, None, "1970-01-01T00:04:00Z", 1.0, 60), (9, "b", "1970-01-01T00:00:00Z", 1.0, None),
    ]
    out = {r.k: (r.value, r.n_readings, r.status) for r in grid.regular_grid(readings(spark, rows), max_fill=3).collect()}
    assert out[0] == (2.0, 2, "observed")
    assert out[1] == (3.0, 0, "interpolated")
    assert out[2] == (4.0, 1, "observed")
    assert all(out[k] == (None, 0, "missing") for k in range(3, 10))
    assert set(out) == set(range(11))


def test_grid_bounds_and_empty(spark):
    rows = [(1, "a", "1970-01-01T00:02:00Z", 1.0, 60)]
    out = {r.k: r.status for r in grid.regular_grid(readings(spark, rows), bounds=(0, 300)).collect()}
    assert out == {0: "edge", 1: "edge", 2: "observed", 3: "edge", 4: "edge", 5: "edge"}
    assert grid.regular_grid(readings(spark, [])).count() == 0


def test_grid_blocks_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("aab"), str(100_000_000 + rng.randrange(4000)), 1.0, 10) for i in range(120)]
    got = {(r.source, r.k) for r in grid.regular_grid(readings(spark, rows), block=16).where("n_readings = 0").collect()}
    want = set()
    for s in "ab":
        ks = {int(t) // 10 for _, x, t, _, _ in rows if x == s}
        want |= {(s, k) for k in range(min(ks), max(ks)) if k not in ks}
    assert got == want


def test_long_gap_is_chunked(spark):
    pairs = spark.createDataFrame([(0, 99_999)], "lo bigint, hi bigint")
    assert grid.explode_between(pairs, "lo", "hi", "k", chunk=1000).agg(F.count_distinct("k")).first()[0] == 100_000


def test_rolling_against_brute_force(spark):
    rng = random.Random(1)
    day0 = 19_000
    rows, ref = [], {}
    for i in range(400):
        s, day, sec, v = rng.choice("aaab"), day0 + rng.randrange(400), rng.randrange(86_400), float(rng.randrange(100))
        rows.append((i, s, str((day * 86_400 + sec)), v, 3600))
        ref[s, day * 86_400 + sec] = v
    rows += [(1000 + i, "a", str(int(list(ref)[0][1])), 5.0, 3600) for i in range(2)]
    ref["a", int(list(ref)[0][1])] = 5.0
    got = {(r.source, (r.day - dt.date(1970, 1, 1)).days): r for r in rolling.rolling_totals(readings(spark, rows), windows=(1, 7, 13, 30)).collect()}
    for s in "ab":
        days = sorted({t // 86_400 for x, t in ref if x == s})
        assert {k for x, k in got if x == s} == set(range(days[0], days[-1] + 1))
        for k in range(days[0], days[-1] + 1):
            for w in (1, 7, 13, 30):
                vals = [v for (x, t), v in ref.items() if x == s and k - w < t // 86_400 <= k]
                r = got[s, k]
                assert r[f"n_{w}"] == len(vals) and r[f"total_{w}"] == sum(vals)
                assert r[f"avg_{w}"] == (pytest.approx(sum(vals) / len(vals)) if vals else None)


def test_rolling_small_blocks_and_empty(spark):
    dense = spark.createDataFrame([("a", k, float(k % 5), k % 2) for k in range(200)], "source string, k bigint, total double, n bigint")
    a = rolling.doubling_windows(dense, (7, 30), block_days=31).orderBy("k").collect()
    b = rolling.doubling_windows(dense, (7, 30), block_days=4096).orderBy("k").collect()
    assert a == b and len(a) == 200
    assert rolling.rolling_totals(readings(spark, [])).count() == 0
