"""Sealed records and their audits: canonical forms, partitions, lineage, plans of steps."""

from __future__ import annotations

import hashlib
import json
import math
import struct
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_SAFE = 2**53 - 1


class CanonicalError(ValueError):
    """A value has no typed canonical form."""


def typed_canonical(value: object) -> bytes:
    """Bytes of a JSON value that don't depend on the runtime.

    Fixed format: ``n;`` for null, ``b0;``/``b1;``, ``d`` + hex of the big-endian double + ``;``, ``s`` + byte length + ``:`` + hex +
    ``;``, ``a``/``o`` + number of items + ``:`` + items + ``;``, object keys by their UTF-8 bytes. Numbers that aren't finite,
    whole ones beyond 2^53 - 1, lone surrogates, keys that aren't text and other types are refused.
    """
    match value:
        case None:
            return b"n;"
        case bool():
            return b"b%d;" % value
        case int() | float():
            try:
                x = float(value)
            except OverflowError:
                x = math.inf
            if not math.isfinite(x) or (x == math.floor(x) and abs(x) > MAX_SAFE):
                raise CanonicalError("number")
            return b"d" + struct.pack(">d", x).hex().encode() + b";"
        case str():
            try:
                data = value.encode()
            except UnicodeEncodeError as e:
                raise CanonicalError("text") from e
            return b"s%d:%s;" % (len(data), data.hex().encode())
        case list():
            return b"a%d:%s;" % (len(value), b"".join(map(typed_canonical, value)))
        case dict():
            if not all(isinstance(k, str) for k in value):
                raise CanonicalError("key")
            parts = sorted((k.encode("utf-8", "surrogatepass"), typed_canonical(k), v) for k, v in ((k, typed_canonical(v)) for k, v in value.items()))
            return b"o%d:%s;" % (len(value), b"".join(k + v for _, k, v in parts))
    raise CanonicalError("type")


@F.pandas_udf(T.StringType())
def typed_digest(payloads: pd.Series) -> pd.Series:
    """sha256 of the typed canonical form of JSON texts, null where there is none."""

    def one(x: str | None) -> str | None:
        try:
            return None if x is None else hashlib.sha256(typed_canonical(json.loads(x))).hexdigest()
        except (ValueError, RecursionError):
            return None

    return payloads.map(one)


@F.pandas_udf(T.StringType())
def fold_name(texts: pd.Series) -> pd.Series:
    """NFKC, case folded, white space collapsed."""
    return texts.map(lambda x: None if x is None else " ".join(unicodedata.normalize("NFKC", x).casefold().split()))


def partition_counts(frame: DataFrame, states: DataFrame, key: str, names: list[str]) -> DataFrame:
    """One row: members of the frame, the members of each state, and whether the states partition the frame exactly."""
    j = frame.select(key).join(states.groupBy(key).agg(F.max("state").alias("state"), F.count(F.lit(1)).alias("_n")), key, "full_outer")
    in_frame = frame.select(key, F.lit(1).alias("_f"))
    j = j.join(in_frame, key, "left")
    counts = j.agg(F.count("_f").alias("members"), *[F.count_if((F.col("state") == s) & F.col("_f").isNotNull()).alias(s) for s in names], F.count_if(F.col("_f").isNull() | F.col("state").isNull() | (F.col("_n") > 1)).alias("_bad"))
    return counts.select("members", *names, (F.col("_bad") == 0).alias("exact"))


def annotate_paths(paths: DataFrame, edges: DataFrame, *, path_id: str = "path_id", edge_ids: str = "edge_ids") -> DataFrame:
    """(path_id, hops, evidence, codes): for each path the number of its edges known, their evidence and all their codes."""
    hop = paths.select(path_id, F.posexplode(edge_ids).alias("hop", "edge_id"))
    j = hop.join(edges, "edge_id", "left")
    return j.groupBy(path_id).agg(F.count(F.lit(1)).alias("hops"), F.sum(F.coalesce("evidence", F.lit(0))).alias("evidence"), F.array_join(F.array_sort(F.collect_set("code")), ",").alias("codes"))


def usage(assumptions: DataFrame, uses: DataFrame, key: str) -> DataFrame:
    """(key, n_uses, reason): every assumption with how many paths use it, and why it has none."""
    n = uses.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    j = assumptions.select(key).join(n, key, "left").select(key, F.coalesce("_n", F.lit(0)).alias("n_uses"))
    return j.withColumn("reason", F.when(F.col("n_uses") == 0, F.lit("no path uses it")))


def falsifier_state(evaluable: Column, triggered: Column) -> Column:
    """Of many falsifiers of a group: not_evaluable before triggered before compatible; an aggregate."""
    return F.when(~F.bool_and(evaluable), "not_evaluable").when(F.bool_or(triggered), "triggered").otherwise("compatible")


def competition(props: DataFrame, keys: list[str], position: str) -> DataFrame:
    """(keys, propositions, positions, relation): opposition of two positions, divergence of more; sets with one are left out."""
    g = props.groupBy(*keys).agg(F.count(F.lit(1)).alias("propositions"), F.count_distinct(position).alias("positions"))
    return g.where("positions > 1").withColumn("relation", F.when(F.col("positions") == 2, "opposition").otherwise("divergence"))


def weakest(df: DataFrame, keys: list[str], level: str, order: list[str]) -> DataFrame:
    """(keys, level): the weakest of an ordered enumeration, weakest first in ``order``; unknown levels are weakest of all."""
    rank = F.coalesce(F.array_position(F.array(*[F.lit(x) for x in order]), F.col(level)), F.lit(0))
    return df.groupBy(*keys).agg(F.min(rank).cast("int").alias("_r")).select(*keys, F.when(F.col("_r") > 0, F.element_at(F.array(*[F.lit(x) for x in order]), F.greatest("_r", F.lit(1)))).otherwise("unknown").alias("level"))


class Plan:
    """A fixed chain of named steps on DataFrames; each runs once, after the steps it names."""

    def __init__(self) -> None:
        self.steps: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {}

    def add(self, name: str, after: tuple[str, ...], step: Callable[..., DataFrame]) -> Plan:
        if name in self.steps or any(a not in self.steps for a in after):
            raise ValueError(f"step {name}: its name is taken or it comes before what it needs")
        self.steps[name] = (after, step)
        return self

    def run(self) -> dict[str, DataFrame]:
        done: dict[str, DataFrame] = {}
        for name, (after, step) in self.steps.items():
            done[name] = step(*[done[a] for a in after])
        return done


def row_digest(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, digest): an order-free digest of the rows of each group."""
    h = F.xxhash64(*[F.col(c) for c in df.columns if c not in keys]).cast("decimal(38,0)")
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(h).cast("string").alias("digest"))


def clusters_on_a_line(df: DataFrame, keys: list[str], x: str, tolerance: float) -> DataFrame:
    """``df`` plus ``cluster``: values of a group that follow each other within ``tolerance`` are one cluster."""
    w = Window.partitionBy(*keys).orderBy(x)
    return df.withColumn("_s", F.when(F.col(x) - F.lag(x).over(w) <= tolerance, 0).otherwise(1)).withColumn("cluster", F.sum("_s").over(w)).drop("_s")
