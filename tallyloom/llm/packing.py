"""Items of varying length into containers of fixed capacity.

Everything but the last step works on the histogram of lengths, which has at most ``capacity`` rows however many items
there are. Shallow combinations of lengths that fill a window at the top of the capacity are enumerated: up to three
items, or many of one length and one other. Non-negative least squares over the whole histogram finds how often to repeat
each; the counts are rounded down, and what is left is offered to the combinations again, one at a time in the order of
their solved counts. The residual items are packed greedily by best fit. As a long tail of combinations may use up the
small items that the residual needs, the last ones are given back in steps and the best of these plans is taken; the last
step gives all back, so the result is never worse than best fit alone. The result is a list of patterns with repeat
counts. Items then find their place by their rank within their length, which is counted in blocks, so that a length with a
third of all items is numbered by many tasks.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
RANK_BLOCKS = 256
SOLVER_ROUNDS = 100
#: Shares of the combinations that are kept when the residual is packed; the best plan counts.
KEEP = (1.0, 0.9, 0.75, 0.5, 0.25, 0.0)


def shallow_patterns(sizes: list[int], capacity: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, numbers) with three columns: combinations that leave at most ``window`` of ``capacity`` free.

    Of each pair of sizes (or n times one size) the combination with the largest third (second) that still fits is
    listed; a number 0 means that there is none. There are at most capacity**2 / 4 of them.
    """
    have = np.array(sorted({0, *sizes}))
    own = have[1:]

    def fitting(room: np.ndarray) -> np.ndarray:
        return have[np.searchsorted(have, room, side="right") - 1]

    listed, times = [], []
    for a in own[::-1]:
        b = have[(have <= a) & (have <= capacity - a)]
        c = np.minimum(fitting(capacity - a - b), b)
        c = np.where(np.isin(c, have), c, 0)
        ok = (a + b + c >= capacity - window) & ((b > 0) | (c == 0))
        listed.append(np.stack([np.full(ok.sum(), a), b[ok], c[ok]], 1))
        times.append((listed[-1] > 0).astype(int))
    for n in range(2, capacity // own[0] + 1 if len(own) else 0):
        a = own[own * n <= capacity]
        b = fitting(capacity - a * n)
        ok = (a * n + b >= capacity - window) & ~((n == 2) & (b > 0) & (b <= a))  # those are among the triples
        listed.append(np.stack([a[ok], b[ok], np.zeros(ok.sum(), int)], 1))
        times.append(np.stack([np.full(ok.sum(), n), (b[ok] > 0).astype(int), np.zeros(ok.sum(), int)], 1))
    if not listed:
        return np.zeros((0, 3), int), np.zeros((0, 3), int)
    return np.concatenate(listed), np.concatenate(times)


def nnls(sizes: np.ndarray, times: np.ndarray, wanted: np.ndarray, weight: np.ndarray, rounds: int = SOLVER_ROUNDS) -> np.ndarray:
    """x >= 0 with a small sum of (weight * (uses - wanted))**2, where uses counts each size over x repeats of the patterns.

    Accelerated projected gradient steps with restarts; the matrix stays in the three columns of the patterns.
    """
    value, m = times * weight[sizes], len(wanted)
    forward = lambda x: np.bincount(sizes.ravel(), (value * x[:, None]).ravel(), m)
    back = lambda r: (value * r[sizes]).sum(axis=1)
    v, step = np.ones(len(sizes)), 1.0
    for _ in range(20):  # the largest eigenvalue, by power iteration
        v = back(forward(v))
        step = np.linalg.norm(v)
        v = v / max(step, 1e-300)
    x = y = np.zeros(len(sizes))
    t, b = 1.0, wanted * weight
    for _ in range(rounds):
        g = back(forward(y) - b)
        new = np.maximum(0.0, y - g / max(1.02 * step, 1e-300))
        if (g * (new - x)).sum() > 0:
            t, y = 1.0, new
        else:
            t, last = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
            y = new + (last - 1) / t * (new - x)
        x = new
    return x


def plan_patterns(counts: dict[int, int], capacity: int = CAPACITY, window: int | None = None) -> list[tuple[dict[int, int], int]]:
    """[(items of each size, times)]: containers that hold exactly the items of ``counts`` (size -> number, sizes <= capacity)."""
    left = {s: n for s, n in counts.items() if n > 0}
    sizes, times = shallow_patterns(sorted(left), capacity, capacity // 64 if window is None else window)
    wanted = np.zeros(capacity + 1)
    wanted[list(left)] = list(left.values())
    x = nnls(sizes, times, wanted, np.sqrt(np.arange(capacity + 1.0)))  # weighed by volume
    order = np.argsort(-x, kind="stable")[: int((x > 0).sum())]
    listed = list(zip(x[order].astype(int).tolist(), sizes[order].tolist(), times[order].tolist(), strict=True))
    room = wanted.astype(int).tolist()
    plan: list[tuple[dict[int, int], int]] = []
    for solved in (True, False):  # whole numbers of the solution first, then one of each as far as there are items
        for n, parts, numbers in listed:
            n = n if solved else 1
            if not n:
                break
            if all(room[s] >= k for s, k in zip(parts, numbers, strict=True)):
                pattern: dict[int, int] = {}
                for s, k in zip(parts, numbers, strict=True):
                    if k:
                        pattern[s] = pattern.get(s, 0) + k
                n = min([n, *(room[s] // k for s, k in pattern.items())])
                if n:
                    plan.append((pattern, n))
                    for s, k in pattern.items():
                        room[s] -= n * k
    left = {s: n for s, n in enumerate(room) if n}
    best = None
    for share in KEEP:
        kept, back = plan[: int(len(plan) * share)], dict(left)
        for pattern, n in plan[len(kept) :]:
            for s, k in pattern.items():
                back[s] = back.get(s, 0) + n * k
        whole = kept + greedy_patterns(back, capacity)
        if best is None or sum(n for _, n in whole) < sum(n for _, n in best):
            best = whole
    return best or []


def greedy_patterns(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """The same by best fit: the largest size left, then again and again the largest that still fits; repeated while the counts allow."""
    left = {s: n for s, n in counts.items() if n > 0}
    sizes, plan = sorted(left), []
    while sizes:
        pattern, free, at = {}, capacity, len(sizes)
        while at := bisect_right(sizes, free, 0, at):
            s = sizes[at - 1]
            pattern[s] = min(left[s], free // s)
            free -= s * pattern[s]
            at -= 1
        times = min(left[s] // n for s, n in pattern.items())
        plan.append((pattern, times))
        for s, n in pattern.items():
            left[s] -= n * times
            if not left[s]:
                del sizes[bisect_left(sizes, s)]
    return plan


def pack(lengths: DataFrame, *, key: str = "doc_id", size: str = "n_tokens", capacity: int = CAPACITY) -> DataFrame:
    """(key, part, start, n, container, kind) for items (key, size).

    An item of at most ``capacity`` is in one container (kind ``whole``). A longer one is divided: each full stretch of
    ``capacity`` fills a container of its own (``full``), the remainder is packed like an item (``rest``). Items of size
    0 or null take no space and are in container -1 (``empty``). ``container`` numbers start at 0 and have no gaps.
    Items are numbered in the order of their keys within a size; items with equal keys and sizes share neither rows nor
    space. The histogram, at most ``capacity`` rows, is collected.
    """
    items = lengths.select(F.col(key).alias("key"), F.coalesce(F.col(size), F.lit(0)).cast("bigint").alias("n"))
    rest = F.when(F.col("n") > capacity, F.col("n") % capacity).otherwise(F.col("n"))
    small = items.select("key", "n", rest.alias("rest"))
    histogram = {r.rest: r["count"] for r in small.where("rest > 0").groupBy("rest").count().collect()}
    plan = plan_patterns(histogram, capacity)
    # slots of each length in order: from rank r on, pattern p starts with container c and holds k items of the length each
    slots: dict[int, list[tuple[int, int, int]]] = {}
    container, used = 0, dict.fromkeys(histogram, 0)
    for pattern, times in plan:
        for s, k in pattern.items():
            slots.setdefault(s, []).append((used[s], container, k))
            used[s] += k * times
        container += times
    tables = {s: tuple(np.array(c) for c in zip(*rows, strict=True)) for s, rows in slots.items()}

    def place(batches):
        for pdf in batches:
            out = np.full(len(pdf), -1, dtype=np.int64)
            size_of = pdf["rest"].to_numpy()
            rank = pdf["rank"].to_numpy()
            for s in np.unique(size_of):
                here = size_of == s
                start, first, k = tables[int(s)]
                i = np.searchsorted(start, rank[here], side="right") - 1
                out[here] = first[i] + (rank[here] - start[i]) // k[i]
            yield pd.DataFrame({"key": pdf["key"], "n": pdf["n"], "rest": pdf["rest"], "container": out})

    kind = items.schema["key"].dataType.simpleString()
    # ranks within a length: numbered in blocks of rows, with the sizes of the blocks before (capacity x RANK_BLOCKS rows) added
    spread = small.where("rest > 0").withColumn("block", F.pmod(F.xxhash64("key"), F.lit(RANK_BLOCKS)))
    before = spread.groupBy("rest", "block").count().withColumn("_before", F.expr("sum(count) over (partition by rest order by block rows between unbounded preceding and 1 preceding)"))
    ranked = spread.withColumn("_r", F.expr("row_number() over (partition by rest, block order by key, n)")).join(before.drop("count"), ["rest", "block"]).withColumn("rank", F.coalesce("_before", F.lit(0)) + F.col("_r") - 1)
    # the key travels as text: pandas would make floats of whole numbers beside nulls
    placed = ranked.select(F.col("key").cast("string").alias("key"), "n", "rest", "rank").mapInPandas(place, "key string, n bigint, rest bigint, container bigint").withColumn("key", F.col("key").cast(kind))
    packed = placed.select("key", F.floor((F.col("n") - F.col("rest")) / capacity).cast("int").alias("part"), (F.col("n") - F.col("rest")).alias("start"), F.col("rest").alias("n"), "container", F.when(F.col("n") > capacity, "rest").otherwise("whole").alias("kind"))
    # full stretches follow the packed containers: numbered by blocks of keys
    long_ = items.where(F.col("n") > capacity).withColumn("block", F.pmod(F.xxhash64("key"), F.lit(RANK_BLOCKS))).withColumn("full", F.floor(F.col("n") / capacity))
    ahead = long_.groupBy("block").agg(F.sum("full").alias("_sum")).withColumn("_ahead", F.expr("sum(_sum) over (order by block rows between unbounded preceding and 1 preceding)")).drop("_sum")
    numbered = long_.withColumn("_own", F.expr("sum(full) over (partition by block order by key, n rows between unbounded preceding and current row) - full")).join(ahead, "block")
    full = numbered.withColumn("part", F.explode(F.sequence(F.lit(0), (F.col("full") - 1).cast("int")))).select(
        "key", "part", (F.col("part").cast("bigint") * capacity).alias("start"), F.lit(capacity).cast("bigint").alias("n"),
        (F.lit(container) + F.coalesce("_ahead", F.lit(0)) + F.col("_own") + F.col("part")).cast("bigint").alias("container"), F.lit("full").alias("kind"),
    )
    empty = items.where("n = 0").select("key", F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("start"), "n", F.lit(-1).cast("bigint").alias("container"), F.lit("empty").alias("kind"))
    return packed.unionByName(full).unionByName(empty).withColumnRenamed("key", key)
