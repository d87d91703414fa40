"""Spike days, episodes (gaps and islands) and joins of intervals.

Interval joins are planned as equi joins: the smaller side is spelled out day by day (an episode has as many rows as it
has days), so nothing is broadcast and no pair is looked at that doesn't share a day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .series import by_order, over_days


def spike_days(series: DataFrame, *, sigma: float = 2.0, days: int = 90, least: int = 60) -> DataFrame:
    """``series`` plus ``bar`` and ``spike``: the value is above mean + sigma sample deviations of the trailing window of
    the observation before (the baseline lags by one observation, not by one day)."""
    w_ = lambda w: w(1 - days, 0)
    s = over_days(
        series.where("value is not null"), days - 1,
        lambda w: {"_raw": F.when(F.count("value").over(w_(w)) >= least, F.avg("value").over(w_(w)) + sigma * F.stddev_samp("value").over(w_(w)))},
    )
    return s.withColumn("bar", F.lag("_raw").over(by_order())).drop("_raw").withColumn("spike", F.coalesce(F.col("value") > F.col("bar"), F.lit(False)))


def islands(days: DataFrame, *, gap: int = 3) -> DataFrame:
    """(channel, island, start_k, end_k, n_days): runs of days no more than ``gap`` apart."""
    starts = F.when(F.col("k") - F.lag("k").over(by_order()) <= gap, 0).otherwise(1)
    return days.withColumn("_s", starts).withColumn("island", F.sum("_s").over(by_order())).groupBy("channel", "island").agg(F.min("k").alias("start_k"), F.max("k").alias("end_k"), F.count(F.lit(1)).alias("n_days"))


def each_day(intervals: DataFrame, start: str = "start_k", end: str = "end_k", *, before: int = 0, after: int = 0) -> DataFrame:
    """One row per day k of each interval, widened on both sides."""
    return intervals.withColumn("k", F.explode(F.sequence(F.col(start) - before, F.col(end) + after)))


def episodes(series: DataFrame, *, sigma: float = 2.0, gap: int = 3) -> DataFrame:
    """(channel, start_k, end_k, n_spike_days, peak_k, peak_value): islands of spike days with the largest value of any
    day from the first to the last of them, the earliest on ties."""
    spiky = spike_days(series, sigma=sigma)
    isl = islands(spiky.where("spike"), gap=gap)
    peaks = each_day(isl).join(series.where("value is not null").select("channel", "k", "value"), ["channel", "k"])
    return peaks.groupBy("channel", "island", "start_k", "end_k", F.col("n_days").alias("n_spike_days")).agg(F.max_by("k", F.struct("value", -F.col("k"))).alias("peak_k"), F.max("value").alias("peak_value")).drop("island")


def near_events(events: DataFrame, intervals: DataFrame, *, days: int = 3, same_channel: bool = True) -> DataFrame:
    """Events (.., channel, k) with an interval within ``days`` of them (semi join)."""
    keys = ["channel", "k"] if same_channel else ["k"]
    return events.join(each_day(intervals, before=days, after=days).select(*keys).distinct(), keys, "left_semi")


def near_starts(events: DataFrame, intervals: DataFrame, *, days: int = 3) -> DataFrame:
    """Events with an interval of their channel that starts within ``days``."""
    starts = intervals.withColumn("k", F.explode(F.sequence(F.col("start_k") - days, F.col("start_k") + days))).select("channel", "k").distinct()
    return events.join(starts, ["channel", "k"], "left_semi")


def chance_rate(series: DataFrame, intervals: DataFrame, *, days: int = 3) -> DataFrame:
    """(channel, n_days, n_covered, rate): share of each channel's calendar within ``days`` of an interval."""
    span = series.groupBy("channel").agg(F.min("k").alias("_lo"), F.max("k").alias("_hi"))
    calendar = span.withColumn("k", F.explode(F.sequence("_lo", "_hi"))).select("channel", "k")
    covered = each_day(intervals, before=days, after=days).select("channel", "k").distinct().withColumn("_c", F.lit(1))
    return calendar.join(covered, ["channel", "k"], "left").groupBy("channel").agg(F.count(F.lit(1)).alias("n_days"), F.count("_c").alias("n_covered"), (F.count("_c") / F.count(F.lit(1))).alias("rate"))


def placement_overlap(series: DataFrame, intervals: DataFrame) -> DataFrame:
    """(channel, start_k, end_k, n_starts, n_hits): of all placements of an interval's length within the channel's span,
    how many share a day with another channel's interval.

    Placements are not spelled out: one without a hit lies in a stretch of days free of other channels' intervals, and a
    stretch of g days holds max(0, g - length) of them. Stretches are counted by their length, in each channel.
    """
    span = series.groupBy("channel").agg(F.min("k").alias("_lo"), F.max("k").alias("_hi"))
    # who is marked on a day: one channel or several; one row a day
    marked = each_day(intervals).groupBy("k").agg(F.min("channel").alias("_only"), (F.min("channel") < F.max("channel")).alias("_several"))
    taken = each_day(span, "_lo", "_hi").select("channel", "_lo", "_hi", "k").join(marked, "k").where(F.col("_several") | (F.col("_only") != F.col("channel"))).select("channel", "k")
    ends = span.select("channel", F.explode(F.array(F.col("_lo") - 1, F.col("_hi") + 1)).alias("k"))
    free = taken.unionByName(ends).withColumn("g", F.col("k") - F.lag("k").over(by_order()) - 1).where("g > 0").groupBy("channel", F.col("g").alias("at")).agg(F.count(F.lit(1)).alias("n"))
    length = intervals.join(span, "channel").withColumn("_len", F.col("end_k") - F.col("start_k"))
    asked = length.select("channel", F.col("_len").alias("at")).distinct().withColumn("n", F.lit(0).cast("bigint"))
    longer = Window.partitionBy("channel").orderBy(F.desc("at")).rangeBetween(Window.unboundedPreceding, 0)  # one row a length
    sums = free.unionByName(asked).withColumns({"_n": F.sum("n").over(longer), "_days": F.sum(F.col("n") * F.col("at")).over(longer)})
    clear = sums.groupBy("channel", F.col("at").alias("_len")).agg(F.max(F.col("_days") - F.col("_n") * F.col("at")).alias("_clear"))
    starts = F.col("_hi") - F.col("_lo") - F.col("_len") + 1
    return length.join(clear, ["channel", "_len"], "left").select("channel", "start_k", "end_k", starts.alias("n_starts"), (starts - F.coalesce("_clear", F.lit(0))).alias("n_hits"))


def suppressed_days(series: DataFrame, intervals: DataFrame, *, sigma: float = 2.0, follow: int = 120) -> DataFrame:
    """(channel, start_k, end_k, pre_bar, n_suppressed, recovered_k): days after an episode whose value is above the bar
    that held when it began but not above the bar of the day, which the episode itself has lifted; and the first day
    after it whose bar is at most twice the one before."""
    spiky = spike_days(series, sigma=sigma).select("channel", "k", "value", "bar")
    pre = intervals.join(spiky.select("channel", F.col("k").alias("start_k"), F.col("bar").alias("pre_bar")), ["channel", "start_k"], "left")
    after = each_day(pre.select("channel", "start_k", "end_k", "pre_bar", (F.col("end_k") + 1).alias("_a"), (F.col("end_k") + follow).alias("_b")), "_a", "_b").join(spiky, ["channel", "k"], "left")
    return after.groupBy("channel", "start_k", "end_k", "pre_bar").agg(
        F.count_if((F.col("value") > F.col("pre_bar")) & (F.col("value") <= F.col("bar"))).alias("n_suppressed"),
        F.min(F.when(F.col("bar") <= 2 * F.col("pre_bar"), F.col("k"))).alias("recovered_k"),
    )


def event_windows(intervals: DataFrame, returns: DataFrame, rows: list[int]) -> DataFrame:
    """For each interval the first row of ``returns`` (k, ret) on or after its start, and the sums of ret over the next
    ``rows`` rows from there (null where there are fewer).

    The first row on or after a day comes from the calendar of ``returns``, which has one row per day of its span.
    """
    w = Window.orderBy("k")  # one row per trading day
    sums = {f"sum_{n}": F.when(F.count("ret").over(w.rowsBetween(0, n - 1)) == n, F.sum("ret").over(w.rowsBetween(0, n - 1))) for n in rows}
    known = returns.where("ret is not null").withColumns(sums)
    prev = known.withColumn("_prev", F.coalesce(F.lag("k").over(w), F.col("k") - 1))
    landing = prev.withColumn("start_k", F.explode(F.expr("sequence(_prev + 1, k)"))).select("start_k", F.col("k").alias("first_k"), *sums)
    return intervals.join(landing, "start_k", "left")
