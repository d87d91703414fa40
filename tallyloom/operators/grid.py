"""Irregular readings onto a regular grid.

Consecutive non-empty periods of a source are paired by ``lead``; only the grid periods between the two of a pair are
generated. Pairs are formed inside blocks of the time axis, so that a source with a third of all rows is sorted in many
tasks; the pairs that span blocks come from a table with one row per block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.instants import instant_micros, is_finite

BLOCK = 4096
CHUNK = 4096


def usable_readings(df: DataFrame, *, source: str = "series_id", date: str = "date", value: str = "value", order: str = "row_id", extra: tuple[str, ...] = ()) -> DataFrame:
    """(source, micros, value, ord, *extra) of the readings with a finite value; micros is null where the date denotes no instant.

    Rows with a null source belong to no source and are left out. A filter on micros would have every date parsed twice,
    for the filter and for the row, so ``with_instant`` drops the groups without one after the first aggregate.
    """
    known = df.where(F.col(source).isNotNull() & is_finite(F.col(value).cast("double")))
    return known.select(F.col(source).alias("source"), instant_micros(F.col(date)).alias("micros"), F.col(value).cast("double").alias("value"), F.col(order).alias("ord"), *[F.col(c) for c in extra])


def with_instant(readings: DataFrame, keys: list[str], **aggregates: Column) -> DataFrame:
    """``readings`` grouped by ``keys``, which are null where micros is, without the group of those."""
    counted = readings.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()], F.count("micros").alias("_instants"))
    return counted.where("_instants > 0").drop("_instants")


def pair_neighbours(cells: DataFrame, block: int = BLOCK) -> DataFrame:
    """(source, k, value, next_k, next_value) for cells (source, k, value) unique in (source, k); next_k is null at the end.

    No task gets more than ``block`` steps of a source; the window over the blocks of a source has one row per block.
    """
    cells = cells.withColumn("_b", F.floor(F.col("k") / block))
    inside = Window.partitionBy("source", "_b").orderBy("k")
    edges = cells.groupBy("source", "_b").agg(F.min("k").alias("first_k"), F.min_by("value", "k").alias("first_value"), F.max("k").alias("k"), F.max_by("value", "k").alias("value"))
    across = Window.partitionBy("source").orderBy("_b")
    paired = cells.select("source", "k", "value", F.lead("k").over(inside).alias("next_k"), F.lead("value").over(inside).alias("next_value")).where("next_k is not null")
    joints = edges.select("source", "k", "value", F.lead("first_k").over(across).alias("next_k"), F.lead("first_value").over(across).alias("next_value"))
    return paired.unionByName(joints)


def explode_between(pairs: DataFrame, first: str, last: str, out: str, chunk: int = CHUNK) -> DataFrame:
    """One row per whole number first..last of each pair, in chunks: no array has more than ``chunk`` elements."""
    n = F.expr(f"cast(floor(({last} - {first}) / {chunk}) as bigint)")
    return (
        pairs.where(F.col(last) >= F.col(first))
        .withColumn("_c", F.explode(F.sequence(F.lit(0).cast("bigint"), n)))
        .withColumn(out, F.explode(F.expr(f"sequence({first} + _c * {chunk}, least({last}, {first} + _c * {chunk} + {chunk - 1}))")))
        .drop("_c")
    )


def regular_grid(
    df: DataFrame,
    *,
    source: str = "series_id",
    date: str = "date",
    value: str = "value",
    step: str = "step_seconds",
    order: str = "row_id",
    max_fill: int = 3,
    bounds: tuple[int, int] | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """(source, step, k, value, n_readings, status): a row for every period [k*step, (k+1)*step) of each source's grid.

    The grid runs from the period of the first to that of the last usable reading, or, with ``bounds`` (two instants in
    seconds), from and to the periods that hold them. The last delivered reading at the latest instant of a period gives
    its value (status ``observed``). A gap of at most ``max_fill`` periods is filled by linear interpolation between its
    neighbours (``interpolated``), a longer one is marked with null (``missing``); periods outside the readings are
    ``edge``. Sources whose step is null or not positive have no grid. Extra columns are ignored; an empty table gives
    an empty grid; a source with differing steps is laid out once per step. The cells, one row per period with
    readings, are persisted, as several branches start from them.
    """
    usable = usable_readings(df, source=source, date=date, value=value, order=order, extra=(step,)).where(F.col(step) > 0)
    usable = usable.select(F.struct("source", F.col(step).cast("bigint").alias("step")).alias("source"), F.floor(F.col("micros") / (F.col(step).cast("bigint") * 1_000_000)).alias("k"), "micros", "ord", "value")
    cells = with_instant(usable, ["source", "k"], value=F.struct(F.max_by("value", F.struct("micros", "ord")).alias("v"), F.count(F.lit(1)).alias("n"))).persist()
    pairs = pair_neighbours(cells, block)
    own = pairs.select("source", "k", F.col("value.v").alias("value"), F.col("value.n").alias("n_readings"), F.lit("observed").alias("status"))
    gaps = pairs.where(F.col("next_k") > F.col("k") + 1).select("source", "k", "next_k", F.col("value.v").alias("v0"), F.col("next_value.v").alias("v1"), (F.col("k") + 1).alias("_lo"), (F.col("next_k") - 1).alias("_hi"))
    short = F.col("next_k") - F.col("k") - 1 <= max_fill
    inner = explode_between(gaps, "_lo", "_hi", "_k").select(
        "source", F.col("_k").alias("k"),
        F.when(short, F.col("v0") + (F.col("v1") - F.col("v0")) * (F.col("_k") - F.col("k")) / (F.col("next_k") - F.col("k"))).alias("value"),
        F.lit(0).cast("bigint").alias("n_readings"), F.when(short, "interpolated").otherwise("missing").alias("status"),
    )
    grid = own.unionByName(inner)
    if bounds is not None:
        ends = cells.groupBy("source").agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
        at = lambda t: F.floor(F.lit(t) / F.col("source.step")).cast("bigint")
        before = explode_between(ends.select("source", at(bounds[0]).alias("_lo"), (F.col("lo") - 1).alias("_hi")), "_lo", "_hi", "k")
        after = explode_between(ends.select("source", (F.col("hi") + 1).alias("_lo"), at(bounds[1]).alias("_hi")), "_lo", "_hi", "k")
        edge = before.unionByName(after).select("source", "k", F.lit(None).cast("double").alias("value"), F.lit(0).cast("bigint").alias("n_readings"), F.lit("edge").alias("status"))
        grid = grid.unionByName(edge)
    return grid.select(F.col("source.source").alias("source"), F.col("source.step").alias("step"), "k", "value", "n_readings", "status")
