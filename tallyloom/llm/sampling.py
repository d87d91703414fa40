"""A sample whose shares match given targets over several category margins.

Stratum sizes (one row per target at most, so a bounded table) start from the joint targets and are raked by iterative
proportional fitting to the domain and the channel margin, each stratum between its minimum and what it has: where strata
are short, others of their channel and domain make up for it. Each row draws an exponential key with its stratum's weight;
the rows with the least keys are drawn, by counts of buckets of the keys instead of a sort. Strata under their fitted number are then topped up with their next keys, those
over it give up their largest ones, and what can't be met is reported by stratum, channel and domain.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OTHER = "(other)"
MAX_TARGETS = 10_000
#: Buckets of the keys; only the rows of a stratum's last bucket are ranked.
BUCKETS = 4096


def channel_name(c: Column) -> Column:
    """A channel without regard to case, outer blanks and the kind of separator."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"^[\s\u00a0]+|[\s\u00a0]+$", ""), r"[\s\u00a0_\-\u2010-\u2015]+", "_")


def domain_name(c: Column) -> Column:
    """A domain without regard to case, outer blanks and a leading www."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"^[\s\u00a0]+|[\s\u00a0]+$", ""), r"^www\.", "")


def scaled(x: np.ndarray, group: np.ndarray, wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """``x`` times one factor per group, each cell kept within low and high, so that the groups sum to ``wanted``.

    A group that can't reach its number stays at its bounds.
    """
    have = np.bincount(group, weights=x, minlength=len(wanted))
    plain = x * np.divide(wanted, have, out=np.zeros_like(have), where=have > 0)[group]
    if ((plain >= low) & (plain <= high)).all():
        return plain
    lo, hi = np.full(len(wanted), -80.0), np.full(len(wanted), 80.0)  # logarithms of the factors
    for _ in range(60):
        mid = (lo + hi) / 2
        over = np.bincount(group, weights=np.clip(x * np.exp(mid)[group], low, high), minlength=len(wanted)) > wanted
        lo, hi = np.where(over, lo, mid), np.where(over, mid, hi)
    return np.clip(x * np.exp((lo + hi) / 2)[group], low, high)


def rake(sizes: np.ndarray, margins: list[tuple[np.ndarray, np.ndarray]], rounds: int = 200, tol: float = 1e-10, *, start: np.ndarray | None = None, low: np.ndarray | None = None, high: np.ndarray | None = None) -> np.ndarray:
    """Weights per cell by iterative proportional fitting: ``sizes`` times weights meets every margin as far as cells allow.

    margins: (group of each cell, wanted total of each group). Empty groups stay empty. start, low, high: first numbers
    of the cells and their bounds; where the margins can't be met together within these, the last one is.
    """
    low, high = np.zeros(len(sizes)) if low is None else low, np.full(len(sizes), np.inf) if high is None else high
    x = np.clip(sizes if start is None else start, low, high)
    for _ in range(rounds):
        before = x
        for group, wanted in margins:
            x = scaled(x, group, wanted, low, high)
        if np.abs(x - before).max(initial=0) <= tol * max(1.0, x.max(initial=0)):
            break
    return np.divide(x, sizes, out=np.zeros(len(x)), where=sizes > 0)


def half_up(x: float) -> int:
    """A number rounded to the nearest whole one, halves up; noise of the 9th digit doesn't count."""
    return math.floor(round(x, 9) + 0.5)


def attainable(joint: np.ndarray, group: np.ndarray, low: np.ndarray, high: np.ndarray, total: float) -> np.ndarray:
    """The margin of ``joint`` within what the groups can give; what a group can't hold goes to the others in proportion."""
    wanted, least, most = (np.bincount(group, weights=v) for v in (joint, low, high))
    return scaled(wanted, np.zeros(len(wanted), int), np.array([total]), least, most)


def rounded(x: np.ndarray, group: np.ndarray, total: int) -> list[int]:
    """Whole numbers next to ``x`` that sum to ``total`` if ``x`` does, and by group to a whole number next to its sum: largest remainders first."""

    def up(parts: np.ndarray, most: int) -> np.ndarray:
        whole = np.floor(parts + 1e-6)
        rest = parts - whole
        at = sorted(np.flatnonzero(rest > 1e-6), key=lambda i: (-round(rest[i], 9), i))[: max(0, most - int(whole.sum()))]
        whole[at] += 1
        return whole

    out = np.zeros(len(x))
    for g, n in enumerate(up(np.bincount(group, weights=x), total)):
        out[group == g] = up(x[group == g], int(n))
    return [int(v) for v in out]


def least_rows(keyed: DataFrame, quota: DataFrame, group: str, place: Column, buckets: int = BUCKETS) -> DataFrame:
    """The rows of each group with the least (sample_key, row), as many as ``quota`` (group, quota; at most MAX_TARGETS rows) says.

    ``place``, between 0 and 1, grows with the key within a group. Rows are counted by buckets of it; those below the
    bucket in which the quota is reached are in without a sort, and only the rows of that bucket are ranked.
    """
    placed = keyed.withColumn("_b", F.floor(place * buckets))
    counts = placed.groupBy(group, "_b").agg(F.count(F.lit(1)).alias("_n")).join(F.broadcast(quota), group)
    sums = counts.withColumn("_to", F.expr(f"sum(_n) over (partition by {group} order by _b)"))  # at most one row a bucket
    over = F.col("_to") > F.col("quota")
    cuts = sums.groupBy(group).agg(F.min(F.when(over, F.col("_b"))).alias("_cut"), F.coalesce(F.max(F.when(~over, F.col("_to"))), F.lit(0)).alias("_full"), F.max("quota").alias("_quota"))
    near = placed.join(F.broadcast(cuts), group)
    inside = near.where("_cut is null or _b < _cut")
    edge = near.where("_b = _cut").withColumn("_r", F.expr(f"row_number() over (partition by {group} order by sample_key, row)")).where("_r <= _quota - _full")
    return inside.unionByName(edge.drop("_r")).select(*keyed.columns)


def stratified_sample(
    df: DataFrame,
    targets: DataFrame,
    *,
    row: str = "sheet_row",
    channel: str = "channel",
    domain: str = "domain",
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """(sample, report).

    sample: (row, target_id, weight, sample_key). report: one row per target with available, wanted (the larger of
    min_rows and target_share x sample_rows rounded half up), drawn (before repair), sampled, short (wanted - available,
    if positive), target_share, sample_share, residual, and the residuals of its whole channel and domain.

    A stratum gives at least wanted or all it has. The rest of sample_rows goes where channels and domains are short; the
    channel margin goes first where both can't be met.

    A row belongs to the target of its channel and domain, ``(other)`` standing for every domain that no target names;
    with either null, or without such a target, to none. Copies count as rows. Targets must be at most MAX_TARGETS and
    are collected; with an empty table the sample is empty and every target is short. Ties of keys go to the least row.
    """
    spark = df.sparkSession
    t = targets.select("target_id", channel_name(F.col("channel")).alias("channel"), domain_name(F.col("domain")).alias("domain"), F.col("target_share").cast("double"), F.col("min_rows").cast("bigint"), F.col("sample_rows").cast("bigint")).orderBy("target_id").limit(MAX_TARGETS + 1).collect()
    if len(t) > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} targets")
    named = sorted({x.domain for x in t if x.domain is not None and x.domain != OTHER})
    strata = spark.createDataFrame([(x.target_id, x.channel, x.domain) for x in t], "target_id bigint, _channel string, _domain string")
    names = spark.createDataFrame([(n,) for n in named], "_domain string").withColumn("_named", F.lit(True))
    own = domain_name(F.col(domain))
    rows = (
        df.select(F.col(row).alias("row"), channel_name(F.col(channel)).alias("_channel"), own.alias("_domain"))
        .where("_channel is not null and _domain is not null")
        .join(F.broadcast(names), "_domain", "left")
        .withColumn("_domain", F.when(F.col("_named"), F.col("_domain")).otherwise(OTHER))
        .join(F.broadcast(strata), ["_channel", "_domain"])
        .select("row", "target_id")
    )  # both broadcast tables have at most MAX_TARGETS rows, checked above
    sizes = {x.target_id: x["count"] for x in rows.groupBy("target_id").count().collect()}  # at most one row a target
    available = [sizes.get(x.target_id, 0) for x in t]
    total = max([x.sample_rows or 0 for x in t], default=0)
    share = np.array([x.target_share or 0.0 for x in t])
    wanted = [max(int(x.min_rows or 0), half_up(s * total)) for x, s in zip(t, share, strict=True)]

    def grouped(labels: list) -> np.ndarray:
        at = {v: i for i, v in enumerate(dict.fromkeys(labels))}
        return np.array([at[v] for v in labels], dtype=int)

    by_channel, by_domain = grouped([x.channel for x in t]), grouped([x.domain for x in t])
    high = np.array(available, float)
    low = np.minimum(np.array(wanted, float), high)
    goal = int(max(low.sum(), min(total, high.sum())))
    weight, kept = np.zeros(0), []
    if t:
        # a stratum without a share gives its minimum, and more only if all others are used up
        joint = np.where(share > 0, share * total, 1e-12)
        aims = [(g, attainable(joint, g, low, high, goal)) for g in (by_domain, by_channel)]
        weight = rake(high, aims, start=joint, low=low, high=high)
        kept = rounded(weight * high, by_channel, goal)
    weights = spark.createDataFrame([(x.target_id, float(w)) for x, w in zip(t, weight, strict=True)], "target_id bigint, weight double")
    u = (F.pmod(F.xxhash64(F.lit(seed), F.col("row")), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    keyed = rows.join(F.broadcast(weights), "target_id").where("weight > 0").withColumns({"sample_key": -F.log(u) / F.col("weight"), "_place": 1 - u}).persist()
    overall = spark.createDataFrame([(0, total)], "_all int, quota bigint")
    drawn_by = {x.target_id: x["count"] for x in least_rows(keyed.withColumn("_all", F.lit(0)), overall, "_all", F.col("sample_key") / (1 + F.col("sample_key"))).groupBy("target_id").count().collect()}
    drawn = [drawn_by.get(x.target_id, 0) for x in t]
    quota = spark.createDataFrame([(x.target_id, k) for x, k in zip(t, kept, strict=True)], "target_id bigint, quota bigint")
    sample = least_rows(keyed, quota, "target_id", F.col("_place")).select("row", "target_id", "weight", "sample_key")
    n = sum(kept)
    residual = share - np.array(kept, float) / max(n, 1)
    margins = [np.bincount(g, weights=residual)[g].tolist() if t else [] for g in (by_channel, by_domain)]
    schema = T.StructType.fromDDL("target_id bigint, channel string, domain string, target_share double, min_rows bigint, available bigint, wanted bigint, drawn bigint, sampled bigint, short bigint, sample_share double, residual double, channel_residual double, domain_residual double")
    report = spark.createDataFrame(
        [(x.target_id, x.channel, x.domain, float(s), x.min_rows, a, w, d, k, max(0, w - a), (k / n if n else 0.0), float(r), c, o) for x, s, a, w, d, k, r, c, o in zip(t, share, available, wanted, drawn, kept, residual, *margins, strict=True)],
        schema,
    )
    return sample, report
