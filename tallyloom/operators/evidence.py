"""Queries over sealed records: validity, releases, paths, intervals, lattices."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..session import cut_lineage
from .corpus import top_per_key


#: Rows of a list that every row of another table meets; a longer one is an error, never cut.
MAX_LISTED = 1_000


def _listed(rows: DataFrame, what: str) -> list:
    out = rows.limit(MAX_LISTED + 1).collect()
    if len(out) > MAX_LISTED:
        raise ValueError(f"more than {MAX_LISTED} {what}")
    return out


def effective(on: Column, start: Column, end: Column) -> Column:
    """Why a record isn't in force on a day (not_yet, expired), or null if it is; open ends are null."""
    return F.when(start > on, "not_yet").when(end < on, "expired")


def as_of(releases: DataFrame, cutoffs: DataFrame, keys: list[str], *, time: str = "available_at", order: str = "sequence") -> DataFrame:
    """For each cutoff (cutoff) and key the last release available by then. Cutoffs are at most MAX_LISTED.

    A release counts first at the first cutoff from its time on; of those with the same first cutoff one row a key is
    left, which then holds until the key's next one. No release is repeated by cutoff before that.
    """
    listed = sorted({r.cutoff for r in _listed(cutoffs.select("cutoff"), "cutoffs") if r.cutoff is not None})
    kind = cutoffs.schema["cutoff"].dataType
    all_ = F.array(*[F.lit(c).cast(kind) for c in listed]) if listed else F.array().cast(ArrayType(kind))
    first = F.get(F.filter(all_, lambda c: c >= F.col(time)), F.lit(0))
    row = F.struct(*[c for c in releases.columns if c not in keys])
    best = releases.withColumn("_first", first).where("_first is not null").groupBy(*keys, "_first").agg(F.max_by(row, F.struct(time, order)).alias("_r"))
    until = best.withColumn("_next", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_first")))  # at most one row a cutoff
    held = F.filter(all_, lambda c: (c >= F.col("_first")) & (F.col("_next").isNull() | (c < F.col("_next"))))
    return until.select(*keys, F.explode(F.transform(held, lambda c: F.struct(c.alias("cutoff"), F.col("_r").alias("r")))).alias("_x")).select("_x.cutoff", *keys, "_x.r.*")


def bounded_paths(edges: DataFrame, roots: DataFrame, target: Column, *, hops: int, most: int | None = None) -> DataFrame:
    """(root, path, edge_ids, hops): simple paths of stored edges (src, dst, edge_id) from the roots (root) to the target.

    A path ends at the target and visits no node twice; the root itself is no path. One join per hop. With ``most``, a
    root keeps its first ``most`` paths by hops and edge ids, and ``n_paths`` and ``truncated`` tell how many there are.
    """
    e = edges.select(F.col("src").alias("_src"), F.col("dst").alias("_dst"), F.col("edge_id").alias("_e"))
    front = roots.select("root", F.array("root").alias("path"), F.array().cast("array<string>").alias("edge_ids"), F.col("root").alias("_at"))
    out = None
    for h in range(1, hops + 1):
        step = front.join(e, F.col("_at") == F.col("_src")).where(~F.array_contains("path", F.col("_dst")))
        step = step.select("root", F.concat("path", F.array("_dst")).alias("path"), F.concat("edge_ids", F.array("_e")).alias("edge_ids"), F.col("_dst").alias("_at"))
        hit = step.where(F.col("_at") == target).select("root", "path", "edge_ids", F.lit(h).alias("hops"))
        out = hit if out is None else out.unionByName(hit)
        front = step.where(F.col("_at") != target)
    if most is None:
        return out
    n = out.groupBy("root").agg(F.count(F.lit(1)).alias("n_paths"))
    first = top_per_key(out, ["root"], [F.col("hops"), F.col("edge_ids")], most, F.col("edge_ids")).drop("rank")
    return first.join(n, "root").withColumn("truncated", F.col("n_paths") > most)


def reachable(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """(node, depth): all nodes that can be reached from the seeds (node), with the least number of steps.

    Runs until no further node turns up, however deep; what is known after each step is written to the shared folder.
    """
    known, depth, more = cut_lineage(seeds.select("node", F.lit(0).alias("depth")).distinct()), 0, True
    while more:
        step = known.where(F.col("depth") == depth).join(edges, F.col("node") == F.col("src")).select(F.col("dst").alias("node"), F.lit(depth + 1).alias("depth"))
        known = cut_lineage(known.unionByName(step).groupBy("node").agg(F.min("depth").alias("depth")))
        depth += 1
        more = not known.where(F.col("depth") == depth).isEmpty()
    return known


def components(links: DataFrame) -> DataFrame:
    """(node, component): connected components of links (a, b), named by their least node.

    Alternates linking larger neighbours and smaller neighbours to the least one seen (large star, small star) until
    nothing changes, after a number of rounds that grows with the logarithm of the size; each round is written to the
    shared folder.
    """
    e = cut_lineage(links.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).where("node is not null").distinct()
    last, state = None, ()
    while state != last:
        last = state
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        e = cut_lineage(small)
        state = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    return nodes.join(e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def active_on(rows: DataFrame, on: Column, *, key: str, parent: str, start: str, end: str) -> DataFrame:
    """Rows in force on a day that no other row in force supersedes."""
    live = rows.where(effective(on, F.col(start), F.col(end)).isNull())
    return live.join(live.select(F.col(parent).alias(key)).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def shock_grid(edges: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Interval arithmetic of a shock passed on by an edge, in decimals; the least residual takes the most substitution.

    edges: (edge_id, lo, hi); scenarios: (scenario, shock_lo, shock_hi, sub_lo, sub_hi, days_lo, days_hi, buffer_lo,
    buffer_hi), at most MAX_LISTED rows, which every edge meets.
    """
    d = lambda c: F.col(c).cast("decimal(18,6)")
    rows = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(scenarios.schema, r, strict=True)]) for r in _listed(scenarios, "scenarios")]
    j = edges.select("*", F.explode(F.array(*rows)).alias("_s")).select(*edges.columns, "_s.*") if rows else edges.join(scenarios, F.lit(False))
    gross_lo, gross_hi = d("lo") * d("shock_lo") / 100, d("hi") * d("shock_hi") / 100
    out = lambda c: F.round(c, 6).cast("decimal(18,6)")
    return j.select(
        "edge_id", "scenario", out(gross_lo).alias("gross_lo"), out(gross_hi).alias("gross_hi"), out(gross_lo * (100 - d("sub_hi")) / 100).alias("residual_lo"), out(gross_hi * (100 - d("sub_lo")) / 100).alias("residual_hi"),
        F.greatest(F.lit(0), F.col("days_lo") - F.col("buffer_hi")).alias("duration_lo"), F.greatest(F.lit(0), F.col("days_hi") - F.col("buffer_lo")).alias("duration_hi"),
    )


def constraint_state(lower: Column, upper: Column, limit: Column) -> Column:
    """all, none or mixed: whether an interval keeps to a limit."""
    return F.when(upper <= limit, "all").when(lower > limit, "none").otherwise("mixed")


def minimal_switches(variants: DataFrame, atoms: int) -> DataFrame:
    """Masks of changed variants (mask, changed) of ``atoms`` bits that have no smaller changed mask within them.

    Whether a mask holds a changed one is passed on bit by bit, one aggregate each, so no two variants are compared.
    """
    changed = variants.where("changed").select("mask").distinct()
    holds = changed
    for i in range(atoms):
        holds = holds.select(F.explode(F.array("mask", F.col("mask").bitwiseOR(1 << i))).alias("mask")).distinct()
    # those that hold a changed mask in any mask with one bit less
    beyond = holds.select("mask", F.explode(F.sequence(F.lit(0), F.lit(atoms - 1))).alias("_i")).where(F.expr("mask & shiftleft(1, _i) = 0")).select(F.expr("mask | shiftleft(1, _i)").alias("mask")).distinct()
    return changed.join(beyond, "mask", "left_anti")


#: Points of one front, which is settled in one task.
MAX_FRONT = 1_000_000


def _front(points: np.ndarray) -> np.ndarray:
    """The rows of distinct points that no other one beats: in falling order of their columns, each against the front so far."""
    best, n = np.empty((16, points.shape[1])), 0
    for p in points[np.lexsort(points.T[::-1])[::-1]]:
        if not (best[:n] >= p).all(axis=1).any():
            if n == len(best):
                best = np.concatenate([best, np.empty_like(best)])
            best[n] = p
            n += 1
    return best[:n]


def _rankable(c: str) -> Column:
    return F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(-math.inf)), F.lit(-math.inf))


def skyline(points: DataFrame, dims: list[str]) -> DataFrame:
    """The distinct ``dims`` that none beats in all of them (larger is better), nulls and NaN being beaten by everything.

    Each task keeps the front of its own rows; the fronts are then merged. A merged front of more than MAX_FRONT points is
    an error.
    """
    schema = ", ".join(f"`{c}` double" for c in dims)

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = None
        for pdf in batches:
            v = pdf[dims].to_numpy(float)
            v = np.unique(v if best is None else np.concatenate([best, v]), axis=0)
            best = _front(v)
        if best is not None:
            yield pd.DataFrame(best, columns=dims)

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in own(batches):
            if len(pdf) > MAX_FRONT:
                raise ValueError(f"more than {MAX_FRONT} points in one front")
            yield pdf

    return points.select(*[_rankable(c).alias(c) for c in dims]).mapInPandas(own, schema).repartition(1).mapInPandas(merged, schema)


def pareto_layers(points: DataFrame, dims: list[str]) -> DataFrame:
    """``points`` with their ``layer``: 1 for those that none beats in all of ``dims`` (larger is better), then the same for
    the rest, until none is left. One pass for each layer; see ``skyline``."""
    left, out, layer = cut_lineage(points.withColumn("_p", F.struct(*[_rankable(c).alias(c) for c in dims]))), None, 0
    while out is None or not left.isEmpty():
        layer += 1
        front = skyline(left.select("_p.*"), dims).select(F.struct(*dims).alias("_p"), F.lit(layer).alias("layer"))
        placed = cut_lineage(left.join(front, "_p", "left"))
        mine, left = placed.where("layer is not null"), placed.where("layer is null").drop("layer")
        out = mine if out is None else out.unionByName(mine)
    return out.drop("_p")


def partition_vector(variants: DataFrame, atoms: int, result: str) -> DataFrame:
    """(atom, cells, decisive): for each bit of the mask, the background cells (masks without it) and how many of them
    change their result when it flips."""
    v = variants.withColumn("atom", F.explode(F.sequence(F.lit(0), F.lit(atoms - 1)))).withColumn("background", F.expr("mask & ~shiftleft(1, atom)"))
    cells = v.groupBy("atom", "background").agg(F.count_distinct(result).alias("_d"))
    return cells.groupBy("atom").agg(F.count(F.lit(1)).alias("cells"), F.count_if(F.col("_d") > 1).alias("decisive"))


def conflicting(bindings: DataFrame, keys: list[str], digest: str) -> DataFrame:
    """(keys, n, digests): keys bound to more than one digest."""
    g = bindings.groupBy(*keys).agg(F.count_distinct(digest).alias("n"), F.array_sort(F.collect_set(digest)).alias("digests"))
    return g.where("n > 1")


def universe(domains: list[DataFrame], most: int = 1_000_000) -> DataFrame:
    """Every combination of finite domains, refused if there are more than ``most``."""
    size = 1
    for x in domains:
        size *= x.count()
    if size > most:
        raise ValueError(f"universe of {size} combinations, at most {most} are admitted")
    out = domains[0]
    for x in domains[1:]:
        out = out.join(x, F.lit(True))
    return out


def permitted(uses: Column, required: list[str], approved: Column, on: Column, start: Column, due: Column) -> Column:
    """Whether all required uses are permitted, the record approved, and the day within [start, due]."""
    lacking = F.size(F.array_except(F.array(*[F.lit(r) for r in required]), uses))
    return F.coalesce((lacking == 0) & approved & (on >= start) & (on <= due), F.lit(False))


def pointer_path(pointer: str) -> str:
    """A JSON pointer (RFC 6901) as a JSON path."""
    if pointer == "":
        return "$"
    if not pointer.startswith("/"):
        raise ValueError("a pointer starts with /")
    parts = [p.replace("~1", "/").replace("~0", "~") for p in pointer[1:].split("/")]
    return "$" + "".join(f"[{p}]" if p.isdigit() else f"['{p}']" for p in parts)


def topological_order(edges: list[tuple[str, str]], rank: dict[str, tuple]) -> list[str]:
    """Nodes after those they depend on (before, after); of several that are free, the least rank first. Cycles raise ValueError."""
    nodes = set(rank) | {x for e in edges for x in e}
    waits = {n: {a for a, b in edges if b == n} for n in nodes}
    out: list[str] = []
    while waits:
        free = [n for n, w in waits.items() if not w - set(out)]
        if not free:
            raise ValueError("cycle: " + ", ".join(sorted(waits)))
        n = min(free, key=lambda x: (rank.get(x, ()), x))
        out.append(n)
        del waits[n]
    return out


def contiguous(revisions: list[int]) -> bool:
    """Whether revisions run 1, 2, 3 ... without gap or repetition."""
    return bool(revisions) and sorted(revisions)[0] == 1 and all(b - a == 1 for a, b in pairwise(sorted(revisions)))


def latest_per_key(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key."""
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in keys]), order).alias("_r")).select(*keys, "_r.*")


def rank_within(df: DataFrame, keys: list[str], order: list[Column], out: str = "ordinal") -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
