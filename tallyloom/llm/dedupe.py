"""Records that are equal but for white space, letter case, punctuation or the order of their parameters.

Three steps, each bounded whatever the skew:

1. Every task counts its own rows in tries (``combine``): out comes one row per distinct key and task, with the ids of
   its rows in lists of at most ``IDS_PER_ROW``. A record with a third of all rows shrinks here to a few rows a task.
2. Keys are partitioned by a prefix of their canonical bytes. Prefixes that hold more rows than ``capacity`` are split by
   further bytes (the prefix doubles), again and again, until each bucket fits or its keys end (``radix_buckets``).
3. One trie per bucket, with terminal counters, adds up the copies (``count_buckets``). Buckets come sorted, so a task
   holds one trie at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CAPACITY = 20_000
FIRST_BYTES = 8
STRIDE = 16
IDS_PER_ROW = 4096
COMBINE_ROWS = 200_000


def fold(text: Column) -> Column:
    """Letters, combining marks and digits of a text in order, without regard to case."""
    return F.translate(F.regexp_replace(F.lower(F.upper(text)), r"[^\p{L}\p{M}\p{Nd}]+", ""), "ς", "σ")


def record_key(title: Column, url: Column) -> Column:
    """Canonical bytes of a record, null where title or url is null or empty.

    The title is folded; of the url, what stands before the first ``?`` is folded, and the ``&``-separated parameters
    after it are folded one by one, empty ones dropped, and sorted.
    """
    base = F.substring_index(url, "?", 1)
    query = F.when(F.contains(url, F.lit("?")), F.substring(url, F.length(base) + 2, F.length(url))).otherwise("")
    params = F.array_sort(F.filter(F.transform(F.split(query, "&"), fold), lambda x: x != ""))
    key = F.concat(fold(title), F.lit("\x1f"), fold(base), F.lit("?"), F.array_join(params, "&"))
    return F.when((F.length(title) > 0) & (F.length(url) > 0), F.encode(key, "utf-8"))


class CountingTrie:
    """A trie over byte strings whose edges carry up to STRIDE bytes; each terminal counts the copies and keeps the least row."""

    def __init__(self, skip: int = 0) -> None:
        self.root: dict = {}
        self.skip = skip
        self.size = 0

    def add(self, key: bytes, row: int, n: int = 1) -> list:
        """Counts n copies whose least row is ``row``; returns the terminal [copies, least row, ids]."""
        node = self.root
        for at in range(self.skip, len(key), STRIDE):
            node = node.setdefault(key[at : at + STRIDE], {})
        end = node.get(None)
        if end is None:
            end = node[None] = [0, row, []]
            self.size += 1
        end[0] += n
        if row < end[1]:
            end[1] = row
        return end

    def items(self, prefix: bytes = b"") -> Iterator[tuple[bytes, list]]:
        """All (key, terminal); ``prefix`` are the skipped bytes."""
        stack = [(prefix[: self.skip], self.root)]
        while stack:
            path, node = stack.pop()
            for edge, below in node.items():
                if edge is None:
                    yield path, below
                else:
                    stack.append((path + edge, below))


def _combine(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def rows(trie: CountingTrie) -> pd.DataFrame:
        out = []
        for key, (_, _, ids) in trie.items():
            for at in range(0, len(ids), IDS_PER_ROW):
                part = ids[at : at + IDS_PER_ROW]
                out.append((key, min(part), len(part), part))
        return pd.DataFrame(out, columns=["key", "least", "n", "ids"])

    trie, seen = CountingTrie(), 0
    for batch in batches:
        for key, row in zip(batch["key"], batch["row"], strict=True):
            trie.add(bytes(key), row)[2].append(row)
        seen += len(batch)
        if seen >= COMBINE_ROWS:
            yield rows(trie)
            trie, seen = CountingTrie(), 0
    if seen:
        yield rows(trie)


def combine(keyed: DataFrame) -> DataFrame:
    """(key, least, n, ids) of the distinct keys of each task, for rows (key, row) with a key."""
    return keyed.mapInPandas(_combine, "key binary, least bigint, n bigint, ids array<bigint>")


def radix_buckets(entries: DataFrame, capacity: int = CAPACITY, first: int = FIRST_BYTES) -> DataFrame:
    """``entries`` (with a binary ``key``) plus ``bucket``, the prefix of its key that no more than ``capacity`` rows share.

    Equal keys are always in one bucket. A bucket that can't be split, because all its keys end, stays as it is: then all
    its rows have one key. There are at most rows/capacity oversized prefixes a level; they are joined, not collected.
    """
    done, open_, width = [], entries.withColumn("bucket", F.substring("key", 1, 0)), 0
    longest = entries.agg(F.max(F.length("key"))).first()[0] or 0
    if entries.count() <= capacity:
        return open_
    while True:
        width = width * 2 or first
        here = open_.withColumn("bucket", F.substring("key", 1, width))
        if width >= longest:
            done.append(here)
            break
        big = here.groupBy("bucket").count().where(F.col("count") > capacity).select("bucket").persist()
        done.append(here.join(big, "bucket", "left_anti"))
        if big.isEmpty():
            break
        open_ = here.join(big, "bucket", "left_semi")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["key", "keep_row", "copies"]
    bucket, trie = None, None
    for batch in batches:
        for b, key, least, n in zip(batch["bucket"], batch["key"], batch["least"], batch["n"], strict=True):
            if trie is None or b != bucket:
                if trie is not None:
                    yield pd.DataFrame([(k, e[1], e[0]) for k, e in trie.items(bytes(bucket))], columns=names)
                bucket, trie = b, CountingTrie(skip=len(b))
            trie.add(bytes(key), least, n)
    if trie is not None:
        yield pd.DataFrame([(k, e[1], e[0]) for k, e in trie.items(bytes(bucket))], columns=names)


def count_buckets(bucketed: DataFrame) -> DataFrame:
    """(key, keep_row, copies): each key once, with the least row and the number of rows that have it."""
    placed = bucketed.select("bucket", "key", "least", "n").repartition("bucket").sortWithinPartitions("bucket")
    return placed.mapInPandas(_count, "key binary, keep_row bigint, copies bigint")


def find_copies(df: DataFrame, *, row: str = "sheet_row", title: str = "title", url: str = "url", capacity: int = CAPACITY) -> tuple[DataFrame, DataFrame]:
    """(records, copies) of a table of records.

    records: (keep_row, copies), each record once, a row whose title or url is null or empty being one of its own.
    copies: (keep_row, copy_row), one row for each further row of a record. The least row of a record is kept. Rows with
    a null id are left out; of several rows with one id, all count. An empty table gives none; extra columns are ignored.
    """
    keyed = df.select(record_key(F.col(title), F.col(url)).alias("key"), F.col(row).cast("bigint").alias("row")).where("row is not null")
    entries = combine(keyed.where("key is not null")).persist()
    counted = count_buckets(radix_buckets(entries, capacity))
    single = keyed.where("key is null").select(F.col("row").alias("keep_row"), F.lit(1).cast("bigint").alias("copies"))
    several = counted.where("copies > 1").select("key", "keep_row")
    copies = entries.join(several, "key").select("keep_row", F.explode("ids").alias("copy_row")).where("copy_row > keep_row")
    return counted.select("keep_row", "copies").unionByName(single), copies
