"""Rolling totals over trailing calendar periods by binary doubling.

Daily sums are combined into sums of 2, 4, 8, 16 ... days by adding a block to the one shifted by its own length; any
window is the sum of shifted blocks, one for each binary digit of its length. Each level is one ``lag`` over the same
partitioning and order, so the whole chain needs a single sort. The time axis is cut into blocks that carry the days
before them along, so that no task holds the whole history of a source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .grid import explode_between, pair_neighbours, usable_readings, with_instant

DAY = 86_400_000_000
BLOCK_DAYS = 512


def latest_readings(usable: DataFrame) -> DataFrame:
    """One reading for each source and instant: the last delivered, which is the correction where there is one."""
    return with_instant(usable, ["source", "micros"], value=F.max_by("value", "ord"))


def daily_totals(usable: DataFrame) -> DataFrame:
    """(source, k, value = struct(total, n)) for the days with readings; k counts days from the epoch.

    They are persisted, as several branches start from them.
    """
    return latest_readings(usable).groupBy("source", F.floor(F.col("micros") / DAY).alias("k")).agg(F.struct(F.sum("value").alias("total"), F.count("value").alias("n")).alias("value")).persist()


def dense_days(days: DataFrame) -> DataFrame:
    """(source, k, total, n) for every day between the first and the last of each source, days without readings with zeros."""
    pairs = pair_neighbours(days, BLOCK_DAYS)
    own = pairs.select("source", "k", F.col("value.total").alias("total"), F.col("value.n").alias("n"))
    gaps = pairs.where(F.col("next_k") > F.col("k") + 1).select("source", (F.col("k") + 1).alias("_lo"), (F.col("next_k") - 1).alias("_hi"))
    empty = explode_between(gaps, "_lo", "_hi", "k").select("source", "k", F.lit(0.0).alias("total"), F.lit(0).cast("bigint").alias("n"))
    return own.unionByName(empty)


def doubling_windows(dense: DataFrame, windows: tuple[int, ...], block_days: int = BLOCK_DAYS) -> DataFrame:
    """Adds total_w, n_w and avg_w for each window of w days ending with the row's day.

    ``dense`` has a row (source, k, total, n) for every day of a source. avg_w is the mean of the readings, null without any.
    """
    longest = max(windows)
    size = max(block_days, longest)
    mine, place = F.floor(F.col("k") / size), F.pmod(F.col("k"), F.lit(size))
    blocks = F.when(place > size - longest, F.array(mine, mine + 1)).otherwise(F.array(mine))
    df = dense.withColumn("_own", mine).withColumn("_b", F.explode(blocks))
    w = Window.partitionBy("source", "_b").orderBy("k")
    zero = lambda c, by: F.coalesce(F.lag(c, by).over(w), F.lit(0).cast("double" if c.startswith("_t") else "bigint")) if by else F.col(c)
    df = df.withColumn("_t1", F.col("total")).withColumn("_n1", F.col("n"))
    span = 1
    while span * 2 <= longest:
        df = df.withColumns({f"_{x}{span * 2}": F.col(f"_{x}{span}") + zero(f"_{x}{span}", span) for x in "tn"})
        span *= 2
    for days in windows:
        shift, sums = 0, {"t": [], "n": []}
        for bit in reversed(range(days.bit_length())):
            if days >> bit & 1:
                for x in "tn":
                    sums[x].append(zero(f"_{x}{1 << bit}", shift))
                shift += 1 << bit
        add = lambda parts: sum(parts[1:], parts[0])
        df = df.withColumns({f"total_{days}": add(sums["t"]), f"n_{days}": add(sums["n"])})
    df = df.where(F.col("_b") == F.col("_own"))
    return df.select("source", "k", "total", "n", *[c for d in windows for c in (f"total_{d}", f"n_{d}", F.when(F.col(f"n_{d}") > 0, F.col(f"total_{d}") / F.col(f"n_{d}")).alias(f"avg_{d}"))])


def rolling_totals(df: DataFrame, *, source: str = "series_id", date: str = "date", value: str = "value", order: str = "row_id", windows: tuple[int, ...] = (7, 30)) -> DataFrame:
    """(source, day, total, n, total_w, n_w, avg_w ...) for every calendar day (UTC) of each source, quiet days included.

    Unusable readings (no instant, null, NaN or infinite value, null source) are left out; of readings of one instant the
    last delivered counts. Days before the first reading count as empty. An empty table gives no rows; extra columns are
    ignored.
    """
    dense = dense_days(daily_totals(usable_readings(df, source=source, date=date, value=value, order=order)))
    out = doubling_windows(dense, windows)
    return out.withColumn("day", F.date_add(F.lit("1970-01-01").cast("date"), F.col("k").cast("int"))).drop("k")
