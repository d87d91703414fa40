"""Nearest neighbours of a stated set of queries among all rows, block against block."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .corpus import top_per_key

BLOCK = 4096


def nearest(rows: DataFrame, queries: DataFrame, *, key: str, vector: str, k: int = 5, block: int = BLOCK) -> DataFrame:
    """(query, neighbour, similarity, rank): the k rows with the largest cosine to each query, itself left out.

    Rows and queries are gathered in blocks by hash; each pair of blocks is one matrix product whose task keeps the k
    best of its rows for every query, so a query leaves k rows per block. Null, empty and zero vectors are left out.
    """
    def blocks(df: DataFrame, name: str) -> DataFrame:
        some = df.where(F.size(vector) > 0).select(F.col(key).cast("bigint").alias("i"), F.col(vector).cast("array<double>").alias("v"))
        n = max(1, -(-some.count() // block))
        return some.groupBy(F.pmod(F.xxhash64("i"), F.lit(n)).alias(f"{name}_block")).agg(F.collect_list("i").alias(f"{name}_i"), F.collect_list("v").alias(f"{name}_v"))

    def unit(v: np.ndarray) -> np.ndarray:
        m = np.array([np.asarray(x, float) for x in v])
        size = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, size, out=np.zeros_like(m), where=size > 0)

    def best(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                ids, own = np.asarray(r.r_i), np.asarray(r.q_i)
                s = unit(r.q_v) @ unit(r.r_v).T
                s[own[:, None] == ids[None, :]] = -np.inf
                for j, q in enumerate(own):
                    order = np.lexsort((ids, -s[j]))[:k]
                    order = order[np.isfinite(s[j][order])]
                    yield pd.DataFrame({"query": np.full(len(order), q), "neighbour": ids[order], "similarity": s[j][order]})

    pairs = blocks(queries, "q").join(blocks(rows, "r"), F.lit(True))
    found = pairs.select("q_i", "q_v", "r_i", "r_v").mapInPandas(best, "query bigint, neighbour bigint, similarity double")
    return top_per_key(found, ["query"], [F.desc("similarity"), F.col("neighbour")], k, F.col("neighbour"))
