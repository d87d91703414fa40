import numpy as np
from pyspark.sql import functions as F

from tallyloom.operators import spikes

SCHEMA = "row_id bigint, series_id string, date string, value double, step_seconds int, source string, micros bigint, own boolean"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, False) for r in rows], SCHEMA)


def series(n=400, seed=0, level=1.0, noise=0.05):
    rng = np.random.default_rng(seed)
    return level * (1 + 0.3 * np.sin(np.arange(n) * 2 * np.pi / 24)) * np.exp(noise * rng.standard_normal(n))


def flags(spark, rows, **kw):
    return {r.row_id: r.flag for r in spikes.flag_readings(table(spark, rows), **kw).collect()}


def rows_of(values, start=1_700_000_000, step=3600, first=0, source="s"):
    return [(first + i, source, str(start + i * step), None if v is None else float(v), step) for i, v in enumerate(values)]


def test_spikes_of_one_to_three(spark):
    v = series()
    v[50] = 8.0
    v[120:122] = [7.0, 9.0]
    v[200:203] = [6.0, 6.5, 7.0]
    v[300] = 0.02
    f = flags(spark, rows_of(v))
    assert {i for i, x in f.items() if x} == {50, 120, 121, 200, 201, 202, 300}
    assert set(filter(None, f.values())) == {"spike"}


def test_surges_and_level_shifts_are_none(spark):
    v = series()
    up = np.concatenate([np.linspace(1, 5, 10), np.linspace(5, 1, 12)])
    v[100:122] *= up
    v[250:] *= 4
    assert not any(flags(spark, rows_of(v)).values())


def test_impossible_with_and_without_instant(spark):
    v = series(60)
    rows = rows_of(v)
    rows += [(900, "s", "n/a", -1.0, 3600), (901, "s", None, float("nan"), 3600), (902, None, "1700000000", 101.0, 3600), (903, "s", "1700000000", float("inf"), 3600), (904, "s", "1700000000", None, 3600), (905, None, None, None, None)]
    f = flags(spark, rows)
    assert {i for i, x in f.items() if x == "impossible"} == {900, 901, 902, 903}
    assert f[904] is None and f[905] is None and len(f) == len(rows)


def test_stuck_runs_through_nulls(spark):
    v = list(series())
    for i in range(150, 180):
        v[i] = 1.2345
    v[160] = None
    v[10:12] = [v[9]] * 2
    f = flags(spark, rows_of(v))
    assert {i for i, x in f.items() if x == "stuck"} == set(range(150, 180)) - {160}


def test_copies_and_corrections(spark):
    v = series()
    rows = rows_of(v)
    t = rows[77][2]
    rows[77] = (77, "s", t, 9.0, 3600)
    rows += [(1000, "s", t, 9.0, 3600), (1001, "s", t, float(v[77]), 3600)]
    f = flags(spark, rows)
    assert f[77] == f[1000] == "spike" and f[1001] is None


def test_readings_delivered_often(spark):
    v = series()
    rows = rows_of(v)
    t = rows[77][2]
    rows[77] = (77, "s", t, 9.0, 3600)
    for copies in (2, 3, 5):
        more = rows + [(1000 + i, "s", t, 9.0, 3600) for i in range(copies - 1)] + [(None, "s", rows[5][2], rows[5][3], 3600)]
        out = spikes.flag_readings(table(spark, more)).collect()
        assert len(out) == len(more)
        assert {r.row_id for r in out if r.flag == "spike"} == {77, *range(1000, 999 + copies)}
        assert sorted(str(r.row_id) for r in out) == sorted(str(m[0]) for m in more)
    named = table(spark, rows).withColumn("row_id", F.concat(F.lit("r"), "row_id"))
    assert [r.row_id for r in spikes.flag_readings(named).where("flag is not null").collect()] == ["r77"]


def test_limits_and_shifts(spark):
    v = series()
    v[250:] *= 4
    out = spikes.flag_readings(table(spark, rows_of(v)), limits=(0.0, 5.0)).collect()
    assert {r.row_id for r in out if r.flag == "impossible"} == {i for i in range(400) if v[i] > 5}
    out = spikes.flag_readings(table(spark, rows_of(v))).collect()
    moved = [r.row_id for r in out if r.shift]
    assert len(moved) == 1 and abs(moved[0] - 250) <= 1 and all(r.flag is None for r in out)


def test_few_counts(spark):
    rng = np.random.default_rng(2)
    v = rng.poisson(1.5, 400) * 0.0071
    v[200] = 0.3
    v[300:360] = 0.0
    f = flags(spark, rows_of(v))
    assert f[200] == "spike" and all(f[i] == "stuck" for i in range(300, 360))
    assert sum(x is not None for x in f.values()) <= 66


def test_blocks_agree_with_the_whole(spark):
    v = series(3000, seed=4)
    v[[500, 1499, 1500, 1501, 2500]] = 9.0
    whole = flags(spark, rows_of(v))
    parts = flags(spark, rows_of(v), block=600, halo=100)
    assert whole == parts and {i for i, x in whole.items() if x} == {500, 1499, 1500, 1501, 2500}


def test_empty_and_short(spark):
    assert flags(spark, []) == {}
    assert flags(spark, rows_of([1.0, 50.0, 1.0])) == {0: None, 1: None, 2: None}
