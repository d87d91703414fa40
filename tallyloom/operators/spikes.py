"""Implausible readings: impossible values, spikes and stuck runs, each relative to its source.

Distinct readings (source, instant, value) are judged, so that a reading delivered a million times costs one row. For
each source a robust first-order autoregression around its running level is fitted to the logarithm of its readings without
their daily or weekly cycle; its residuals, of the forecasts as of the backcasts, give its scale. For every stretch of up to
three readings two statistics are compared: that of an additive outlier, the part of its residual that forecast and backcast
agree on, and that of a level shift, the change of level across it. An outlier is at least LEAST_SIGMAS of the residuals'
scale and explains no less than a shift does. Outliers are taken out and the fit repeated until nothing changes; shifts stay
and are reported. Long sources are judged in blocks of readings that overlap, so no task holds more than BLOCK + 2 * HALO
readings and a few bins of one source; each block is fitted by itself, to what the source shows around that time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.instants import instant_micros, is_finite

#: A spike is at least so many robust standard deviations of the residuals and so far from forecast and backcast, on the log scale or, for sources
#: whose median is under FEW_COUNTS of their grain, on that of the square root of the count.
LEAST_SIGMAS = 4.0
LEAST_EFFECT = 0.6
LEAST_ROOT = 2.5
FEW_COUNTS = 6
LONGEST = 3
SIDE = 5
ROUNDS = 6
#: A run is stuck from so many readings on, and only if chance gives such a run less often than once in so many sources.
LEAST_RUN = 7
RUN_ODDS = 100.0
BLOCK, HALO, BIN_STEPS = 20_000, 2_000, 256


def run_starts(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the run of equal values of each reading, length of each run)."""
    if not len(v):
        return np.zeros(0, int), np.zeros(0, int)
    run = np.concatenate([[0], np.cumsum(v[1:] != v[:-1])])
    return run, np.bincount(run)


def stuck_readings(v: np.ndarray, total: int | None = None) -> np.ndarray:
    """Readings of runs of one value that are far longer than the source's own repeats explain, of ``total`` readings in all."""
    run, size = run_starts(v)
    if not len(v):
        return np.zeros(0, bool)
    free = size[run] < LEAST_RUN
    n = int(free.sum())
    # the chance that the next reading repeats the last one, from the readings outside long runs
    if n:
        _, counts = np.unique(v[free], return_counts=True)
        chance = counts.max() / n if n >= 30 else min(0.5, counts.max() / n)
    else:
        chance = 0.0
    pairs = free[1:] & free[:-1]
    same = float((v[1:] == v[:-1])[pairs].mean()) if pairs.any() else 0.0
    chance = min(max(chance, same, 1e-3), 0.9)
    least = max(LEAST_RUN, 2 + np.log(RUN_ODDS * max(total or len(v), 1)) / -np.log(chance))
    return (size >= least)[run]


def side_medians(y: np.ndarray, k: int) -> np.ndarray:
    """Median of the up to k readings before each reading, nan before the first; index n is what stands before the end."""
    padded = np.concatenate([np.full(k, np.nan), y])
    windows = np.lib.stride_tricks.sliding_window_view(padded, k)
    out = np.full(len(windows), np.nan)
    some = ~np.isnan(windows).all(axis=1)
    full = ~np.isnan(windows).any(axis=1)
    out[full] = np.median(windows[full], axis=1)
    out[some & ~full] = np.nanmedian(windows[some & ~full], axis=1)
    return out


def mad(x: np.ndarray) -> float:
    x = x[np.isfinite(x)]
    return 1.4826 * float(np.median(np.abs(x - np.median(x)))) if len(x) else 0.0


def cycle(y: np.ndarray, seconds: np.ndarray, step: int) -> np.ndarray:
    """The part of each reading that its place in the day (steps under a day) or in the week explains, 0 where nothing does."""
    length = 86_400 if step < 86_400 else 7 * 86_400
    bins = int(min(24, length // max(step, 1))) if step < 86_400 else 7
    if bins < 2 or len(y) < 4 * bins:
        return np.zeros(len(y))
    place = (seconds % length * bins // length).astype(int)
    around = max(5, int(length // max(step, 1)) | 1)
    around = min(around, 97)
    padded = np.concatenate([np.full(around // 2, np.nan), y, np.full(around // 2, np.nan)])
    level = np.nanmedian(np.lib.stride_tricks.sliding_window_view(padded, around)[: len(y)], axis=1)
    off = y - level
    effect = np.zeros(bins)
    for b in range(bins):
        own = off[place == b]
        if len(own) >= 4:
            effect[b] = np.median(own)
    part = effect[place]
    spread = lambda x: float(np.mean(np.minimum(np.abs(x), np.quantile(np.abs(x), 0.9))))
    return part if spread(off - part) < 0.85 * spread(off) else np.zeros(len(y))


def spike_readings(v: np.ndarray, seconds: np.ndarray, step: int, usable: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(is spike, effect, sigmas, shift) of readings in order of their instants; only ``usable`` ones serve as context.

    shift is the change of level in sigmas at readings from which on it is at least LEAST_SIGMAS and ``least``, the largest
    around; 0 elsewhere.
    Readings of one instant follow one another; of those only the one nearest to its neighbours is context.
    """
    n = len(v)
    found, effect, sigmas, shift = np.zeros(n, bool), np.zeros(n), np.zeros(n), np.zeros(n)
    if usable.sum() < 8:
        return found, effect, sigmas, shift
    base = v[usable]
    levels = np.unique(base)
    grain = float(np.median(np.diff(levels))) if 1 < len(levels) <= 64 else 0.0
    # sources of few counts scatter like their square root, the others in proportion to their level
    few = grain > 0 and float(np.median(base)) < FEW_COUNTS * grain
    y = np.sqrt(v / grain + 0.375) if few else np.log(v + max(0.1 * float(np.median(base)), grain, 1e-4))
    least = LEAST_ROOT if few else LEAST_EFFECT
    y = y - cycle(y, seconds, step)
    new_instant = np.concatenate([[True], seconds[1:] != seconds[:-1]])
    context = usable & new_instant
    starts = np.flatnonzero(new_instant)
    ends = np.append(starts[1:], n)
    for a, b in zip(starts[ends - starts > 1], ends[ends - starts > 1], strict=True):
        # the value nearest to the readings around stands for an instant with several
        context[a:b] = False
        own = a + np.flatnonzero(usable[a:b])
        if len(own):
            lo, hi = max(0, own[0] - 8), own[-1] + 9
            near = np.median(y[lo:hi][usable[lo:hi]])
            context[own[np.argmin(np.abs(y[own] - near))]] = True
    at = np.flatnonzero(context)
    refs = None
    for _ in range(ROUNDS):
        x = y[at]
        if len(x) < 8:
            break
        refs = References(x)
        hit = np.zeros(len(x), bool)
        for length in range(1, LONGEST + 1):
            m = len(x) - length + 1
            stretch = np.lib.stride_tricks.sliding_window_view(x, length)
            i = np.arange(m)
            off, z, ok = refs.judge(stretch.min(axis=1), stretch.max(axis=1), i, i + length, least)
            for k in range(length):
                hit[k : k + m] |= ok
                own = at[k : k + m]
                more = np.abs(off) > np.abs(effect[own])
                effect[own[more]], sigmas[own[more]] = off[more], z[more]
        found[at[hit]] = True
        if not hit.any():
            break
        at = at[~hit]
    if len(at) >= 8:
        refs = refs if refs is not None and refs.n == len(at) else References(y[at])  # those of the last round, if it took nothing out
        i = np.arange(len(at))
        change = np.where((i >= SIDE) & (i <= len(at) - SIDE), refs.shift(i, i), 0.0)
        peak = np.lib.stride_tricks.sliding_window_view(np.pad(np.abs(change), SIDE), 2 * SIDE + 1).max(axis=1)
        moved = (np.abs(change) >= peak) & (np.abs(change) >= max(least, LEAST_SIGMAS * refs.sigma))
        shift[at[moved]] = change[moved] / refs.sigma
    other = np.flatnonzero(usable & ~context)  # further values of an instant: judged alone, without the one that stands for it
    if len(other) and len(at) >= 8:
        left = np.searchsorted(seconds[at], seconds[other], side="left")
        right = np.searchsorted(seconds[at], seconds[other], side="right")
        off, z, ok = refs.judge(y[other], y[other], left, right, least)
        effect[other], sigmas[other], found[other] = off, z, ok
    return found, effect, sigmas, shift


class References:
    """Levels, forecasts and scatter around the readings ``x`` of a source."""

    def __init__(self, x: np.ndarray) -> None:
        self.x, self.n = x, len(x)
        self.before = side_medians(x, SIDE)  # at i: of the readings before i
        self.after = side_medians(x[::-1], SIDE)[::-1]  # at i: of the readings from i on
        prev, off = x[:-1] - self.before[:-2], x[1:] - self.before[1:-1]
        good = np.isfinite(prev) & np.isfinite(off)
        good &= (np.abs(prev) < 4 * mad(prev)) & (prev != 0)
        weight = np.abs(prev[good])
        self.phi = 0.0
        if good.sum() > 10:  # the weighted median of the ratios: a least-absolute-deviations fit
            ratio = off[good] / prev[good]
            order = np.argsort(ratio)
            total = np.cumsum(weight[order])
            self.phi = float(np.clip(ratio[order][np.searchsorted(total, total[-1] / 2)], 0.0, 0.8))
        self.ahead = np.concatenate([[np.nan], self.before[1:] + self.phi * (x - self.before[1:])])
        self.back = np.concatenate([self.after[:-1] + self.phi * (x - self.after[:-1]), [np.nan]])
        residuals = np.concatenate([x - self.ahead[:-1], x - self.back[1:]])
        self.sigma = max(mad(residuals), 1e-3)

    def shift(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The change of level from the readings before i to those from j on, 0 at the ends."""
        return np.nan_to_num(self.after[j] - self.before[i])

    def judge(self, low: np.ndarray, high: np.ndarray, i: np.ndarray, j: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(signed effect, in sigmas, is an outlier) of stretches with extremes low, high between the readings before i and from j on.

        The effect is the residual that the forecast from before and the backcast from after the stretch have in common;
        it must be no less than the shift of level across the stretch. A reading next to the stretch that lies near it
        means that the stretch goes on, so it is none either.
        """
        hi, lo = np.fmax(self.ahead[i], self.back[j]), np.fmin(self.ahead[i], self.back[j])
        up, down = low - hi, lo - high
        size = np.fmax(np.fmax(up, down), 0.0) * np.where((i >= 2) & (j <= self.n - 2), 1.0, 0.5)  # one-sided at the ends
        rising = up >= down
        wide = np.concatenate([[np.nan], self.x, [np.nan]])
        prev, next_ = wide[i], wide[np.minimum(j + 1, self.n + 1)]
        apart = np.where(rising, np.fmin(low - prev, low - next_), np.fmin(prev - high, next_ - high))
        ok = (size >= least) & (size >= LEAST_SIGMAS * self.sigma) & (apart >= 0.5 * size) & (size >= np.abs(self.shift(i, j)))
        off = np.where(rising, size, -size)
        return off, off / self.sigma, ok


_JUDGED = "source string, micros bigint, value double, flag string, effect double, sigmas double, shift double, n bigint, known bigint, low bigint, high bigint, mixed bigint"


_CARRIED = ["source", "micros", "value"]
_IDS = ["n", "known", "low", "high", "mixed"]


def judge_source(t: pa.Table) -> pa.Table:
    """Flags for the distinct possible readings (source, micros, value, step, total, own, ...) of one source or block, with its surroundings."""
    column = lambda name: t.column(name).to_numpy()
    own = column("own")
    order = np.lexsort((column("value"), column("micros")))
    v, micros = column("value")[order], column("micros")[order]
    flag, found = np.zeros(len(v), np.int8), [np.zeros(len(v))] * 3
    if own.any():
        # of several values at one instant the one that continues a run stands in the sequence of runs
        lead = np.ones(len(v), bool)
        stuck = np.zeros(len(v), bool)
        if (micros[1:] == micros[:-1]).any():
            lead[:] = False
            lead[_run_sequence(v, micros)] = True
        stuck[lead] = stuck_readings(v[lead], int(t.column("total")[0].as_py()))
        spike, *found = spike_readings(v, micros / 1e6, int(t.column("step")[0].as_py()), ~stuck)
        flag = np.where(stuck, 2, np.where(spike, 1, 0))
    keep = own[order].astype(bool)
    rows = t.take(pa.array(order[keep]))
    names = pa.array([None, "spike", "stuck"], pa.string()).take(pa.array(flag[keep].astype(np.int8)))
    numbers = [pa.array(x[keep], pa.float64()) for x in found]
    return pa.table([*[rows.column(c) for c in _CARRIED], names, *numbers, *[rows.column(c) for c in _IDS]], names=[c.split()[0] for c in _JUDGED.split(", ")])


def _run_sequence(v: np.ndarray, micros: np.ndarray) -> np.ndarray:
    """One reading per instant: the one equal to the reading before or after it, if any."""
    starts = np.flatnonzero(np.concatenate([[True], micros[1:] != micros[:-1]]))
    ends = np.append(starts[1:], len(v))
    pick, last = [], None
    for i, (a, b) in enumerate(zip(starts, ends, strict=True)):
        k = a
        if b - a > 1:
            following = set(v[starts[i + 1] : ends[i + 1]]) if i + 1 < len(starts) else set()
            same = [j for j in range(a, b) if v[j] == last] or [j for j in range(a, b) if v[j] in following]
            k = same[0] if same else a
        pick.append(k)
        last = v[k]
    return np.array(pick)


def flag_readings(
    df: DataFrame,
    *,
    source: str = "series_id",
    date: str = "date",
    value: str = "value",
    step: str = "step_seconds",
    row: str = "row_id",
    limits: tuple[float, float] = (0.0, 100.0),
    block: int = BLOCK,
    halo: int = HALO,
) -> DataFrame:
    """(row, source, flag, effect, sigmas, shift) of every row.

    flag is ``impossible`` (outside ``limits`` or not finite, with or without an instant), ``spike``, ``stuck`` or null.
    effect is the distance from the forecasts on the log scale, sigmas the same in the scale of their residuals, shift
    the change of level in that scale where one begins, else 0. Rows with a null value or, if their value is possible,
    without an instant or a source are never flagged. Equal readings of an instant get the same flag, differing ones are
    judged each by its own value. Steps that are null or not positive count as a day. An empty table gives no rows; extra
    columns are ignored.

    Rows that deliver one reading up to three times find their flag without a join: the reading carries the least and the
    largest of their ids, and what is left of all ids together is the third. Readings delivered more often, or under ids
    that are null or no whole numbers, meet their rows by a join, which is planned only if there are any; a job at the
    time of the call, over the distinct readings, which are persisted, finds out.
    """
    rows = df.select(F.col(row).alias("row"), F.col(source).alias("source"), instant_micros(F.col(date)).alias("micros"), F.col(value).cast("double").alias("value"), F.col(step).cast("bigint").alias("step"))
    v = F.col("value")
    possible = F.coalesce(is_finite(v) & v.between(*limits), F.lit(False))
    placed = F.col("source").isNotNull() & F.col("micros").isNotNull()
    id_ = F.col("row") if isinstance(df.schema[row].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)) else F.lit(None)
    # rows without an instant are left out after the aggregate: a filter on it would have every date parsed twice
    readings = distinct_readings(rows.where(possible & F.col("source").isNotNull()), id_.cast("bigint")).persist()
    judged = judged_readings(readings, block, halo)
    result = ["flag", "effect", "sigmas", "shift"]
    third = F.col("mixed").bitwiseXOR(F.col("low")).bitwiseXOR(F.col("high"))
    ids = F.when(F.col("n") == 1, F.array("low")).when(F.col("n") == 2, F.array("low", "high")).otherwise(F.array("low", third, "high"))
    out = judged.where(_FEW).select(F.explode(ids.cast(T.ArrayType(df.schema[row].dataType))).alias("row"), "source", *result)
    if not readings.where(f"not ({_FEW})").isEmpty():
        many = judged.where(f"not ({_FEW})").select("source", "micros", "value", *result)
        keyed = rows.where(possible & placed).withColumn("value", _plain(v))
        out = out.unionByName(keyed.join(many, ["source", "micros", "value"]).select("row", "source", *result))
    none = {"effect": F.lit(None).cast("double"), "sigmas": F.lit(None).cast("double"), "shift": F.lit(None).cast("double")}
    impossible = rows.where(v.isNotNull() & ~possible).select("row", "source", F.lit("impossible").alias("flag"), *[c.alias(n) for n, c in none.items()])
    unjudged = rows.where(v.isNull() | (possible & ~placed)).select("row", "source", F.lit(None).cast("string").alias("flag"), *[c.alias(n) for n, c in none.items()])
    return out.unionByName(impossible).unionByName(unjudged).select(F.col("row").alias(row), F.col("source").alias(source), *result)


_FEW = "n <= 3 and known = n"


def _plain(value: Column) -> Column:
    """-0.0 as 0.0."""
    return F.when(value == 0, F.lit(0.0)).otherwise(value)


def distinct_readings(rows: DataFrame, id_: Column) -> DataFrame:
    """(source, micros, value, step, n, known, low, high, mixed): each distinct reading once, with its rows' number, the number
    of their ids, the least, the largest and the exclusive or of these (0 without any: nulls would turn whole numbers into floats in pandas)."""
    return (
        rows.groupBy("source", "micros", _plain(F.col("value")).alias("value"))
        .agg(F.max("step").alias("step"), F.count("micros").alias("n"), F.count(id_).alias("known"), *[F.coalesce(f(id_), F.lit(0)).alias(c) for c, f in (("low", F.min), ("high", F.max), ("mixed", F.bit_xor))])
        .where("n > 0")
        .withColumn("step", F.when(F.col("step") > 0, F.col("step")).otherwise(86_400))
    )


def judged_readings(readings: DataFrame, block: int = BLOCK, halo: int = HALO) -> DataFrame:
    """``readings`` with flag, effect, sigmas and shift."""
    bin_ = F.floor(F.col("micros") / (F.col("step") * (1_000_000 * BIN_STEPS)))
    binned = readings.withColumn("_bin", bin_)
    # bins of the time axis are dealt to blocks by the number of readings before them; one row per bin in this window
    sizes = binned.groupBy("source", "_bin").agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.expr("coalesce(sum(_n) over (partition by source order by _bin rows between unbounded preceding and 1 preceding), 0)")).withColumn("total", F.expr("sum(_n) over (partition by source)"))
    own = F.floor(F.col("_before") / block)
    sizes = sizes.withColumn("_own", F.when(F.col("total") <= 2 * block, F.lit(0).cast("bigint")).otherwise(own))
    into = F.when(F.col("total") <= 2 * block, F.array(F.col("_own"))).otherwise(
        F.array_compact(F.array(F.col("_own"), F.when((F.col("_before") - F.col("_own") * block < halo) & (F.col("_own") > 0), F.col("_own") - 1), F.when((F.col("_own") + 1) * block - F.col("_before") - F.col("_n") < halo, F.col("_own") + 1)))
    )
    placed = binned.join(sizes.select("source", "_bin", "_own", "total", into.alias("_into")), ["source", "_bin"]).withColumn("_block", F.explode("_into")).select("source", "micros", "value", "step", "total", "n", "known", "low", "high", "mixed", "_block", (F.col("_block") == F.col("_own")).alias("own"))
    return placed.groupBy("source", "_block").applyInArrow(judge_source, _JUDGED)
