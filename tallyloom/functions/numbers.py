"""Small numeric expressions shared by operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def r6(c: Column | str) -> Column:
    """Rounded to six decimals, halves up, by plain double arithmetic, so that other engines can do exactly the same."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * 1e6 + 0.5) / 1e6


def epoch_day(d: Column | str) -> Column:
    """Days from the epoch: the integer axis of calendar-day frames."""
    return F.datediff(d, F.lit("1970-01-01").cast("date"))


def wilson(successes: Column, n: Column, z: float = 1.959963984540054) -> tuple[Column, Column]:
    """(low, high) of the Wilson interval; exactly 0 without and 1 with only successes, null for n = 0."""
    p, zz = successes / n, z * z
    mid = (p + zz / (2 * n)) / (1 + zz / n)
    half = z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n)) / (1 + zz / n)
    some = n > 0
    return F.when(some, F.when(successes == 0, F.lit(0.0)).otherwise(mid - half)), F.when(some, F.when(successes == n, F.lit(1.0)).otherwise(mid + half))
