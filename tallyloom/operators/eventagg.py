"""Coded events: layered aggregates of one scan, baselines, lookups with an account of what fell out, points in polygons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def layers(df: DataFrame, keys: list[str], aggregates: dict[str, Column], sets: list[list[str]]) -> DataFrame:
    """One aggregate per grouping set in a single scan; ``layer`` names the set's keys joined by +, or all."""
    spark_sets = [[F.col(k) for k in s] for s in sets]
    bits = len(keys)
    names = {sum(1 << (bits - 1 - i) for i, k in enumerate(keys) if k not in s): "+".join(s) or "all" for s in sets}
    g = df.groupingSets(spark_sets, *keys).agg(F.grouping_id().alias("_g"), *[c.alias(n) for n, c in aggregates.items()])
    name = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
    return g.withColumn("layer", name[F.col("_g").cast("int")]).drop("_g")


def excess_over_baseline(df: DataFrame, *, member: str, k: str, windows: DataFrame, baseline_days: int) -> DataFrame:
    """(window, member, n, baseline, excess) for windows (window, start_k, end_k): rows of each member within the window
    against its daily rate over the days before; members without a baseline have 0."""
    daily = df.groupBy(member, F.col(k).alias("k")).agg(F.count(F.lit(1)).alias("_n"))
    inside = windows.select("window", (F.col("end_k") - F.col("start_k") + 1).alias("_days"), F.explode(F.sequence("start_k", "end_k")).alias("k"), F.lit(1).alias("_in"))
    before = windows.select("window", (F.col("end_k") - F.col("start_k") + 1).alias("_days"), F.explode(F.sequence(F.col("start_k") - baseline_days, F.col("start_k") - 1)).alias("k"), F.lit(0).alias("_in"))
    j = daily.join(inside.unionByName(before), "k").groupBy("window", member, "_days").agg(F.sum(F.col("_n") * F.col("_in")).alias("n"), F.sum(F.col("_n") * (1 - F.col("_in"))).alias("baseline"))
    return j.where("n > 0").select("window", member, "n", "baseline", (F.col("n") - F.col("baseline") / baseline_days * F.col("_days")).alias("excess"))


def lookup(df: DataFrame, dimension: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows that have the key in the dimension, with its columns; (key, n) of those that haven't)."""
    return df.join(dimension, key), df.join(dimension.select(key).distinct(), key, "left_anti").groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def points_in_polygons(points: DataFrame, edges: DataFrame, *, key: str, cell: float = 1.0) -> DataFrame:
    """(key, name): the first polygon by name that holds each point (lon, lat), by ray casting.

    edges: (name, x1, y1, x2, y2) of closed rings. Points meet the polygons whose bounding box covers their grid cell of
    ``cell`` degrees, by an equi join; a point is inside if a ray to the right crosses an odd number of edges.
    """
    box = edges.groupBy("name").agg(F.least(F.min("x1"), F.min("x2")).alias("_x0"), F.greatest(F.max("x1"), F.max("x2")).alias("_x1"), F.least(F.min("y1"), F.min("y2")).alias("_y0"), F.greatest(F.max("y1"), F.max("y2")).alias("_y1"))
    at = lambda c: F.floor(F.col(c) / cell)
    cells = box.withColumn("_cx", F.explode(F.sequence(at("_x0"), at("_x1")))).withColumn("_cy", F.explode(F.sequence(at("_y0"), at("_y1"))))
    near = points.withColumns({"_cx": at("lon"), "_cy": at("lat")}).join(cells, ["_cx", "_cy"]).where("lon between _x0 and _x1 and lat between _y0 and _y1")
    crosses = (F.col("y1") > F.col("lat")) != (F.col("y2") > F.col("lat"))
    right = F.col("lon") < (F.col("x2") - F.col("x1")) * (F.col("lat") - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")
    hit = F.when(crosses, F.when(right, 1).otherwise(0)).otherwise(0)
    inside = near.join(edges, "name").groupBy(key, "name").agg(F.sum(hit).alias("_n")).where("_n % 2 = 1")
    return inside.groupBy(key).agg(F.min("name").alias("name"))
