"""Operators on daily series in long form: (channel, d, k, value), k counting days from the epoch.

Windows over calendar days are computed in blocks of the day axis that carry along the days their frames reach back to, so
that a channel with a third of all rows is spread over tasks; each block holds at most BLOCK_DAYS + frame days.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.numbers import epoch_day

BLOCK_DAYS = 4096


def daily_shares(df: DataFrame, *, channel: str, day: str) -> DataFrame:
    """(channel, d, k, value): rows of each channel in percent of all rows of the day. Days without rows stay missing."""
    counts = df.where(F.col(channel).isNotNull() & F.col(day).isNotNull()).groupBy(F.col(channel).alias("channel"), F.to_date(F.col(day)).alias("d")).count()
    total = Window.partitionBy("d")  # one row per channel and day
    return counts.select("channel", "d", epoch_day("d").alias("k"), (100.0 * F.col("count") / F.sum("count").over(total)).alias("value"))


def daily_values(df: DataFrame, *, day: str, aggregate: Column, channel: Column | None = None) -> DataFrame:
    """(channel, d, k, value): one aggregate per day (and channel)."""
    keys = [(channel if channel is not None else F.lit("all")).alias("channel"), F.to_date(F.col(day)).alias("d")]
    return df.groupBy(*keys).agg(aggregate.cast("double").alias("value")).select("channel", "d", epoch_day("d").alias("k"), "value")


def over_days(series: DataFrame, back: int, add: Callable[[Callable[[int, int], WindowSpec]], dict[str, Column]], ahead: int = 0) -> DataFrame:
    """``series`` plus the columns that ``add`` makes of calendar frames reaching ``back`` days back and ``ahead`` days on.

    ``add`` gets a function (from, to) -> window over the days k+from .. k+to of the channel.
    """
    size = max(BLOCK_DAYS, back + ahead)
    mine, place = F.floor(F.col("k") / size), F.pmod(F.col("k"), F.lit(size))
    into = F.array_compact(F.array(mine, F.when(place >= size - back, mine + 1), F.when(place < ahead, mine - 1)))
    spread = series.withColumn("_own", mine).withColumn("_block", F.explode(into))
    w = lambda lo, hi: Window.partitionBy("channel", "_block").orderBy("k").rangeBetween(lo, hi)
    return spread.withColumns(add(w)).where(F.col("_block") == F.col("_own")).drop("_own", "_block")


def trailing_percentile(series: DataFrame, *, days: int = 730, least: int = 180, ties: str = "weak", value: str = "value", out: str = "score", self_rank: bool = True, both_ends: bool = False) -> DataFrame:
    """Percentile of each value in the ``days`` calendar days ending with it, null under ``least`` observations.

    ties: ``weak`` counts values at or below, ``strict`` below, ``midrank`` half of the equal ones. A null value has a
    null score and counts for nobody. ``both_ends`` takes one day more at the start of the window.
    """
    back = days if both_ends else days - 1

    def add(w: Callable[[int, int], WindowSpec]) -> dict[str, Column]:
        return {"_values": F.collect_list(value).over(w(-back, 0)), "_n": F.count(value).over(w(-back, 0))}

    return over_days(series, back, add).withColumn(out, F.when(F.col("_n") >= least, percentile_of(F.col(value), F.col("_values"), F.col("_n"), ties))).drop("_values", "_n")


def percentile_of(x: Column, values: Column, n: Column, ties: str = "weak") -> Column:
    """100 times the share of ``values`` at or below x (weak), below (strict) or in between (midrank)."""
    weak, strict = F.size(F.filter(values, lambda y: y <= x)), F.size(F.filter(values, lambda y: y < x))
    return F.when(x.isNotNull(), 100.0 * {"weak": weak, "strict": strict, "midrank": (weak + strict) / 2.0}[ties] / n)


def row_percentile(series: DataFrame, *, rows: int = 730, least: int = 180, ties: str = "weak", out: str = "score") -> DataFrame:
    """The same over the last ``rows`` observations instead of calendar days; needs the channel's order as a whole."""
    w = Window.partitionBy("channel").orderBy("k").rowsBetween(-(rows - 1), 0)
    own = series.where("value is not null").withColumns({"_values": F.collect_list("value").over(w), "_n": F.count("value").over(w)})
    return own.withColumn(out, F.when(F.col("_n") >= least, percentile_of(F.col("value"), F.col("_values"), F.col("_n"), ties))).drop("_values", "_n")


def trailing_mean(series: DataFrame, *, days: int, least: int, out: str = "mean") -> DataFrame:
    """Mean of the ``days`` calendar days ending with the row's, null under ``least`` observations."""
    return over_days(series, days - 1, lambda w: {out: F.when(F.count("value").over(w(1 - days, 0)) >= least, F.avg("value").over(w(1 - days, 0)))})


def trailing_share(series: DataFrame, *, days: int = 365, least: int = 90, out: str = "share") -> DataFrame:
    """Each value in relation to the sum of its own trailing window."""
    return over_days(series, days - 1, lambda w: {out: F.when(F.count("value").over(w(1 - days, 0)) >= least, F.col("value") / F.sum("value").over(w(1 - days, 0)))})


def composite(scores: DataFrame, channels: int, *, score: str = "score") -> DataFrame:
    """(d, k, composite): the mean over all channels, null where one of them has no score."""
    return scores.groupBy("d", "k").agg(F.when(F.count(score) == channels, F.avg(score)).alias("composite"))


def weighted_composite(scores: DataFrame, weights: DataFrame, *, score: str = "score") -> DataFrame:
    """(d, k, composite) with weights (channel, weight) scaled to a sum of one; strict like ``composite``. Weights has one row a channel."""
    share = weights.select("channel", (F.col("weight") / F.sum("weight").over(Window.partitionBy())).alias("_w"), F.count(F.lit(1)).over(Window.partitionBy()).alias("_channels"))
    return scores.join(share, "channel").groupBy("d", "k").agg(F.when(F.count(score) == F.max("_channels"), F.sum(F.col(score) * F.col("_w"))).alias("composite"))


def gauge(parts: DataFrame, weights: dict[str, float], required: str, others: int = 2) -> DataFrame:
    """(k, gauge): the weighted mean over the parts (channel, k, value) present, weights scaled to those; null without
    the ``required`` part or with fewer than ``others`` of the rest."""
    weight = F.create_map(*[x for n, w in weights.items() for x in (F.lit(n), F.lit(w))])[F.col("channel")]
    there = F.col("value").isNotNull()
    g = parts.groupBy("k").agg(
        F.sum(F.when(there, weight * F.col("value"))).alias("_x"), F.sum(F.when(there, weight)).alias("_w"),
        F.count_if(there & (F.col("channel") == required)).alias("_r"), F.count_if(there & (F.col("channel") != required)).alias("_o"),
    )
    return g.select("k", F.when((F.col("_r") > 0) & (F.col("_o") >= others), F.col("_x") / F.col("_w")).alias("gauge"))


def weekly(series: DataFrame) -> DataFrame:
    """(channel, week, mean, n): weeks end on Monday and bear its date; a last week that isn't over is left out."""
    week = F.date_add("d", F.pmod(2 - F.dayofweek("d"), F.lit(7)))
    last = series.groupBy("channel").agg(F.max("d").alias("_last"))
    return series.groupBy("channel", week.alias("week")).agg(F.avg("value").alias("mean"), F.count("value").alias("n")).join(last, "channel").where("week <= _last").drop("_last")


def monthly(series: DataFrame, *, floor: float = 0.0) -> DataFrame:
    """(channel, month, mean, n, expected, reason): monthly means, refused with a reason below ``floor`` of the month's days."""
    m = series.groupBy("channel", F.trunc("d", "MM").alias("month")).agg(F.avg("value").alias("_mean"), F.count("value").alias("n"))
    m = m.withColumn("expected", F.dayofmonth(F.last_day("month")))
    enough = F.col("n") >= floor * F.col("expected")
    return m.select("channel", "month", F.when(enough, F.col("_mean")).alias("mean"), "n", "expected", F.when(~enough, F.lit(f"below the {floor:.0%} floor")).alias("reason"))


def by_order() -> WindowSpec:
    return Window.partitionBy("channel").orderBy("k")


def log_returns(series: DataFrame, out: str = "ret") -> DataFrame:
    """100 times the difference of logarithms from one observation to the next."""
    return series.withColumn(out, 100.0 * (F.ln("value") - F.ln(F.lag("value").over(by_order()))))


def realised_volatility(series: DataFrame, *, rows: int = 10, value: str = "ret", out: str = "vol") -> DataFrame:
    """Sample deviation of the last ``rows`` rows, null until there are as many."""
    w = by_order().rowsBetween(1 - rows, 0)
    return series.withColumn(out, F.when(F.count(value).over(w) == rows, F.stddev_samp(value).over(w)))


def lags(series: DataFrame, n: int) -> DataFrame:
    """Columns lag_1 .. lag_n."""
    return series.withColumns({f"lag_{i}": F.lag("value", i).over(by_order()) for i in range(1, n + 1)})


def consecutive_changes(levels: DataFrame, *, index: str = "i", value: str = "value") -> DataFrame:
    """(channel, index, change): differences between observations whose indexes are one apart."""
    w = Window.partitionBy("channel").orderBy(index)
    return levels.withColumns({"_p": F.lag(index).over(w), "change": F.col(value) - F.lag(value).over(w)}).where(F.col(index) - F.col("_p") == 1).select("channel", index, "change")


def average_rank(df: DataFrame, value: str, partition: list[str], out: str = "pct") -> DataFrame:
    """Rank over count with tied values sharing their mean rank; nulls have none."""
    w, ties = Window.partitionBy(*partition).orderBy(value), Window.partitionBy(*partition, value)
    rank = F.rank().over(w) + (F.count(F.lit(1)).over(ties) - 1) / 2.0
    return df.where(F.col(value).isNotNull()).withColumn(out, rank / F.count(F.lit(1)).over(Window.partitionBy(*partition)))


def percentile_without_self(series: DataFrame, *, rows: int = 120, out: str = "pct") -> DataFrame:
    """Percent of the up to ``rows`` - 1 rows before that are at or below the value, the value itself left out."""
    w = by_order().rowsBetween(1 - rows, -1)
    s = series.withColumns({"_values": F.collect_list("value").over(w), "_n": F.count("value").over(w)})
    return s.withColumn(out, F.when(F.col("_n") > 0, percentile_of(F.col("value"), F.col("_values"), F.col("_n")))).drop("_values", "_n")


def lower_quantile(values: Column, q: float) -> Column:
    """The element at floor(q (n-1)) of the sorted array: the lower nearest rank."""
    return F.get(F.array_sort(values), F.floor(F.lit(q) * (F.size(values) - 1)).cast("int"))


def threshold_crossings(series: DataFrame, *, days: int = 730, q: float = 0.9, least: int = 180) -> DataFrame:
    """(channel, d, k, value, bar, crossed): the lower q-quantile of the ``days`` days before, without the day itself, and
    whether the value is above it while the row before was not above its own."""
    s = over_days(series, days, lambda w: {"_values": F.collect_list("value").over(w(-days, -1))})
    s = s.withColumn("bar", F.when(F.size("_values") >= least, lower_quantile(F.col("_values"), q))).drop("_values").withColumn("_above", F.col("value") > F.col("bar"))
    return s.withColumn("crossed", F.coalesce(F.col("_above") & ~F.lag("_above").over(by_order()), F.lit(False))).drop("_above")


def separated_bands(bands: DataFrame) -> DataFrame:
    """``bands`` (channel, k, low, high) plus ``separated``: above or below the band of the row before, or overlap."""
    low, high = F.lag("low").over(by_order()), F.lag("high").over(by_order())
    return bands.withColumn("separated", F.when(F.col("low") > high, "above").when(F.col("high") < low, "below").when(low.isNotNull(), "overlap"))


def features(series: DataFrame) -> DataFrame:
    """change_12 (against 12 rows before) and vol_12 (sample deviation of the last 12, all there)."""
    w = by_order().rowsBetween(-11, 0)
    return series.withColumns({"change_12": F.col("value") - F.lag("value", 12).over(by_order()), "vol_12": F.when(F.count("value").over(w) == 12, F.stddev_samp("value").over(w))})


def forward_sum(series: DataFrame, rows: int, *, value: str = "ret", out: str = "fwd") -> DataFrame:
    """Sum from the row on over ``rows`` rows, null where there are fewer."""
    w = by_order().rowsBetween(0, rows - 1)
    return series.withColumn(out, F.when(F.count(value).over(w) == rows, F.sum(value).over(w)))


def circular_smooth(effects: DataFrame, *, slot: str = "slot", value: str = "effect", width: int = 7, slots: int = 366) -> DataFrame:
    """Centred mean of ``width`` slots on a circle of ``slots``: (slot, smooth)."""
    half = width // 2
    wrapped = effects.select(F.explode(F.array(F.col(slot) - slots, F.col(slot), F.col(slot) + slots)).alias(slot), value)
    w = Window.orderBy(slot).rangeBetween(-half, half)  # at most 3 * slots rows
    return wrapped.withColumn("smooth", F.avg(value).over(w)).where(F.col(slot).between(1, slots)).select(slot, "smooth")


def cell_merge(old: DataFrame, new: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Cell by cell the new value, or the old one where that is null."""
    return new.select(*keys, *[F.col(v).alias(f"_n_{v}") for v in values]).join(old, keys, "full_outer").select(*keys, *[F.coalesce(F.col(f"_n_{v}"), F.col(v)).alias(v) for v in values])


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``new`` and those of ``old`` whose key isn't in it."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def diff(before: DataFrame, after: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """(keys, state): added, removed or changed; equal rows are left out, nulls equal nulls."""
    b = before.select(*keys, F.struct(*values).alias("_b"))
    a = after.select(*keys, F.struct(*values).alias("_a"))
    state = F.when(F.col("_b").isNull(), "added").when(F.col("_a").isNull(), "removed").when(~F.col("_a").eqNullSafe(F.col("_b")), "changed")
    return b.join(a, keys, "full_outer").select(*keys, state.alias("state")).where("state is not null")
