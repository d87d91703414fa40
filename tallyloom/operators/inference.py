"""Statistical inference. Statistics are aggregates; only resampling of one bounded series runs in pandas."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .series import average_rank


def correlation(x: Column, y: Column, least: int) -> Column:
    """Pearson correlation of the pairs without nulls, null under ``least`` pairs."""
    return F.when(F.count(F.when(x.isNotNull() & y.isNotNull(), 1)) >= least, F.corr(x, y))


def spearman(df: DataFrame, x: str, y: str, keys: list[str], least: int = 3) -> DataFrame:
    """(keys, n, rho): Pearson correlation of average ranks."""
    pairs = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    ranked = average_rank(average_rank(pairs, x, keys, "_rx"), y, keys, "_ry")
    return ranked.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), correlation(F.col("_rx"), F.col("_ry"), least).alias("rho"))


def cross_correlation(pairs: DataFrame, lags: int = 10, least: int = 24) -> DataFrame:
    """(lag, n, r) for pairs (i, x, y) numbered without gaps; at a positive lag x leads y by so many rows."""
    lead = pairs.select("x", F.explode(F.sequence(F.lit(-lags), F.lit(lags))).alias("lag"), "i").withColumn("i", F.col("i") + F.col("lag"))
    return lead.join(pairs.select("i", "y"), "i").groupBy("lag").agg(F.count(F.lit(1)).alias("n"), correlation(F.col("x"), F.col("y"), least).alias("r"))


def step_up(cells: DataFrame, *, p: str = "p", keys: list[str], alpha: float = 0.05) -> DataFrame:
    """``cells`` plus ``rank`` and ``significant`` by the Benjamini-Hochberg step-up rule; cells without p take no part."""
    some = cells.where(F.col(p).isNotNull())
    all_ = Window.partitionBy()  # one row per tested cell: channels x outcomes x windows
    ranked = some.withColumn("rank", F.row_number().over(Window.orderBy(p, *keys))).withColumn("_m", F.count(F.lit(1)).over(all_))
    last = F.max(F.when(F.col(p) <= alpha * F.col("rank") / F.col("_m"), F.col("rank"))).over(all_)
    return ranked.withColumn("significant", F.coalesce(F.col("rank") <= last, F.lit(False))).drop("_m")


def agreement(df: DataFrame, keys: list[str], a: Column, b: Column) -> DataFrame:
    """(keys, n, raw, kappa, ac1) of two yes/no judgements; kappa and ac1 are null where chance alone agrees fully."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg((a == b).cast("double")).alias("raw"), F.avg(a.cast("double")).alias("_pa"), F.avg(b.cast("double")).alias("_pb"))
    chance = F.col("_pa") * F.col("_pb") + (1 - F.col("_pa")) * (1 - F.col("_pb"))
    q = (F.col("_pa") + F.col("_pb")) / 2
    gwet = 2 * q * (1 - q)
    return g.select(*keys, "n", "raw", F.when(chance < 1, (F.col("raw") - chance) / (1 - chance)).alias("kappa"), F.when(gwet < 1, (F.col("raw") - gwet) / (1 - gwet)).alias("ac1"))


def seasonality(series: DataFrame) -> DataFrame:
    """(channel, slot, effect, r2): mean residual of the log values around their straight line by day of year, and the share
    of the residual variance that the slots explain."""
    s = series.withColumn("_y", F.ln(F.greatest("value", F.lit(1e-6)))).withColumn("_t", F.row_number().over(Window.partitionBy("channel").orderBy("k")) - 1)
    line = s.groupBy("channel").agg(F.regr_slope("_y", "_t").alias("_b"), F.regr_intercept("_y", "_t").alias("_a"))
    r = s.join(line, "channel").select("channel", F.dayofyear("d").alias("slot"), (F.col("_y") - F.col("_a") - F.col("_b") * F.col("_t")).alias("_r"))
    slots = r.groupBy("channel", "slot").agg(F.avg("_r").alias("effect"), F.count(F.lit(1)).alias("_n"), F.sum(F.col("_r") * F.col("_r")).alias("_ss"))
    total = slots.groupBy("channel").agg((F.sum(F.col("_n") * F.col("effect") * F.col("effect")) / F.sum("_ss")).alias("r2"))
    return slots.join(total, "channel").select("channel", "slot", "effect", "r2")


def welch_scan(series: DataFrame, least: int = 12) -> DataFrame:
    """(channel, k, t): |Welch t| of the values before k against those from k on, for splits with ``least`` on either side."""
    w, all_ = Window.partitionBy("channel").orderBy("k").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("channel")
    s = series.select("channel", "k", "value").withColumns({
        "n1": F.count("value").over(w), "s1": F.sum("value").over(w), "q1": F.sum(F.col("value") * F.col("value")).over(w),
        "n": F.count("value").over(all_), "s": F.sum("value").over(all_), "q": F.sum(F.col("value") * F.col("value")).over(all_),
    })
    n1, n2 = F.col("n1"), F.col("n") - F.col("n1")
    m1, m2 = F.col("s1") / n1, (F.col("s") - F.col("s1")) / n2
    v1, v2 = (F.col("q1") - n1 * m1 * m1) / (n1 - 1), (F.col("q") - F.col("q1") - n2 * m2 * m2) / (n2 - 1)
    return s.where((n1 >= least) & (n2 >= least)).select("channel", "k", F.abs((m2 - m1) / F.sqrt(v1 / n1 + v2 / n2)).alias("t"))


def geometric_ratio(pairs: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """(keys, n, ratio, log_sd): geometric mean of a/b over rows with both positive, and the deviation of its logarithm (0 for one row)."""
    r = F.ln(F.col(a) / F.col(b))
    return pairs.where((F.col(a) > 0) & (F.col(b) > 0)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.exp(F.avg(r)).alias("ratio"), F.coalesce(F.stddev_samp(r), F.lit(0.0)).alias("log_sd"))


def incremental_r2(design: DataFrame, y: str, own: list[str], added: list[str], least: int = 200) -> tuple[int, float, float] | None:
    """(n, R2 of the own regressors, what the added ones explain on top); None under ``least`` complete rows.

    The cross products come from one aggregate; the driver solves a system as large as the number of regressors.
    """
    x = [*own, *added]
    terms = ["1.0", *[f"`{c}`" for c in x], f"`{y}`"]
    full = design.dropna(subset=[*x, y])
    m = len(terms)
    sums = full.agg(*[F.sum(F.expr(f"cast({terms[i]} as double) * {terms[j]}")).alias(f"s{i}_{j}") for i in range(m) for j in range(i, m)]).first()
    n = int(sums["s0_0"] or 0)
    if n < least:
        return None
    g = np.array([[sums[f"s{min(i, j)}_{max(i, j)}"] for j in range(m)] for i in range(m)], float)
    total = g[-1, -1] - g[0, -1] ** 2 / n

    def r2(k: int) -> float:
        beta = np.linalg.lstsq(g[:k, :k], g[:k, -1], rcond=None)[0]
        return 1 - (g[-1, -1] - beta @ g[:k, -1]) / total

    base = r2(1 + len(own))
    return n, float(base), float(r2(m - 1) - base)


def bootstrap_mean(values: np.ndarray, draws: int = 1000, seed: int = 7) -> tuple[float, float, float, float]:
    """(mean, low, high, p): percentile interval of the mean and its two-sided p, at least 1/draws."""
    rng = np.random.default_rng(seed)
    means = rng.choice(values, (draws, len(values))).mean(axis=1)
    below = float((means <= 0).mean())
    return float(values.mean()), float(np.quantile(means, 0.025)), float(np.quantile(means, 0.975)), float(min(1.0, max(2 * min(below, 1 - below), 1 / draws)))


def bootstrap_cells(df: DataFrame, key: str, value: str, draws: int = 1000, seed: int = 7) -> DataFrame:
    """(key, n, mean, low, high, p) for each cell; a cell has as many values as episodes, so it fits one task."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.sort(pdf[value].dropna().to_numpy(float))
        row = bootstrap_mean(v, draws, seed) if len(v) else (None,) * 4
        return pd.DataFrame([(pdf[key].iloc[0], len(v), *row)], columns=[key, "n", "mean", "low", "high", "p"])

    return df.groupBy(key).applyInPandas(run, f"{key} string, n bigint, mean double, low double, high double, p double")


def moving_block_interval(x: np.ndarray, y: np.ndarray, index: np.ndarray, length: int, draws: int, seed: int) -> tuple[float, float]:
    """Percentile interval of the correlation of resampled blocks of ``length`` rows with consecutive indexes."""
    starts = [i for i in range(len(index) - length + 1) if index[i + length - 1] - index[i] == length - 1]
    if not starts:
        return math.nan, math.nan
    rng, out = np.random.default_rng(seed), []
    need = -(-len(index) // length)
    for _ in range(draws * 3):
        at = np.concatenate([np.arange(s, s + length) for s in rng.choice(starts, need)])[: len(index)]
        if x[at].std() > 0 and y[at].std() > 0:
            out.append(np.corrcoef(x[at], y[at])[0, 1])
        if len(out) == draws:
            break
    return (float(np.quantile(out, 0.025)), float(np.quantile(out, 0.975))) if out else (math.nan, math.nan)


def finite_population_interval(population: int, sample: int, successes: int, alpha: float = 0.05) -> tuple[int, int]:
    """Exact equal-tailed interval of the successes in a population, from those in a sample drawn without replacement.

    Put the population in a row with its successes first. Adding one more success changes what the sample shows only if
    the turned item is in the sample, so the tails over all possible populations are running sums of one distribution:
    that of the place at which the sample's next success stands.
    """
    failures, bar = sample - successes, alpha / 2 * (1 + 1e-9)  # a tail of exactly alpha / 2 is out

    def place(rank: int) -> np.ndarray:
        """Chance that the ``rank``-th sampled item stands at place 1, 2, ... population."""
        at = np.arange(1, population + 1, dtype=float)
        ok = (at >= rank) & (at <= population - sample + rank)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.log(at / (at - rank + 1)) + np.log((population - at - sample + rank) / (population - at))
        ratio = np.where(ok, ratio, 0.0)
        log = np.concatenate([[0.0], np.cumsum(ratio[rank - 1 : population - sample + rank - 1])])
        p = np.zeros(population)
        p[rank - 1 : population - sample + rank] = np.exp(log - log.max())
        return p / p.sum()

    low = successes
    if successes:  # at least as many successes with k in the population: the successes-th sampled item is among the first k
        enough = np.cumsum(place(successes))
        low = int(np.searchsorted(enough, bar, side="right")) + 1
    high = population - failures
    if failures:  # at most as many: the next sampled item is behind the first k
        behind = np.cumsum(place(successes + 1)[::-1])[::-1]
        high = population - int(np.searchsorted(behind[::-1], bar, side="right")) - 1
    return max(low, successes), max(min(high, population - failures), low)


def fit_logit(df: DataFrame, y: str, x: list[str], rounds: int = 25, tol: float = 1e-8) -> np.ndarray:
    """Coefficients (intercept first) of a logistic regression by Newton steps; each step is one aggregate over the rows."""
    beta = np.zeros(1 + len(x))
    cols = [F.lit(1.0), *[F.col(c).cast("double") for c in x]]
    for _ in range(rounds):
        eta = sum((float(b) * c for b, c in zip(beta[1:], cols[1:], strict=True)), F.lit(float(beta[0])))
        p = 1 / (1 + F.exp(-F.greatest(F.least(eta, F.lit(35.0)), F.lit(-35.0))))
        grad = [F.sum(c * (F.col(y).cast("double") - p)).alias(f"g{i}") for i, c in enumerate(cols)]
        hess = [F.sum(cols[i] * cols[j] * p * (1 - p)).alias(f"h{i}_{j}") for i in range(len(cols)) for j in range(i, len(cols))]
        s = df.agg(*grad, *hess).first()
        g = np.array([s[f"g{i}"] or 0.0 for i in range(len(cols))])
        h = np.array([[s[f"h{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(len(cols))] for i in range(len(cols))])
        step = np.linalg.lstsq(h, g, rcond=None)[0]
        beta = beta + step
        if np.abs(step).max() < tol:
            break
    return beta


def greedy_apart(levels: list[tuple[int, float]], n: int = 5, apart: int = 1) -> list[tuple[int, float]]:
    """The n largest (index, value) of which no two are within ``apart`` of each other; ties to the earlier."""
    out: list[tuple[int, float]] = []
    for i, v in sorted(levels, key=lambda x: (-x[1], x[0])):
        if all(abs(i - j) > apart for j, _ in out):
            out.append((i, v))
        if len(out) == n:
            break
    return out
