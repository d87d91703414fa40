"""Readers of the file formats, offline: what the network would deliver lies in files."""

from __future__ import annotations

import hashlib
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Positions of the coded-event fields that are used, in a row of EVENT_WIDTH tab-separated cells.
EVENT_FIELDS = {"actor1": 7, "actor2": 17, "root_code": 28, "quad_class": 29, "goldstein": 30, "mentions": 31, "sources": 32, "articles": 33, "geo_country": 51, "adm1": 52, "lat": 53, "lon": 54}
EVENT_WIDTH = 58
_NUMBERS = {"quad_class": "int", "goldstein": "double", "mentions": "bigint", "sources": "bigint", "articles": "bigint", "lat": "double", "lon": "double"}


def coded_events(lines: DataFrame) -> DataFrame:
    """Coded events of tab-separated lines (value): narrower rows are dropped, numbers that aren't any are null."""
    cells = lines.select(F.split("value", "\t", -1).alias("c")).where(F.size("c") >= EVENT_WIDTH)
    return cells.select(*[(F.col("c")[i].try_cast(_NUMBERS[n]) if n in _NUMBERS else F.when(F.col("c")[i] != "", F.col("c")[i])).alias(n) for n, i in EVENT_FIELDS.items()])


def zipped_lines(spark: SparkSession, path: str, encoding: str = "latin-1") -> DataFrame:
    """(file, value): the lines of all members of zip archives; an archive is read by one task, line by line."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for file, content in zip(pdf["path"], pdf["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in z.namelist():
                        with z.open(name) as f:
                            lines: list[str] = []
                            for line in io.TextIOWrapper(f, encoding=encoding, newline="\n"):
                                lines.append(line.rstrip("\r\n"))
                                if len(lines) == 10_000:
                                    yield pd.DataFrame({"file": file, "value": lines})
                                    lines = []
                            if lines:
                                yield pd.DataFrame({"file": file, "value": lines})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "file string, value string")


def document_list(spark: SparkSession, path: str) -> DataFrame:
    """The table of contents: JSON lines with ID, date, img, lang, title and url."""
    return spark.read.schema("ID string, date string, img string, lang string, title string, url string").json(path)


def ngram_counts(spark: SparkSession, path: str) -> DataFrame:
    """(doc, ngram, n) of tab-separated n-gram files, plain or compressed."""
    return spark.read.option("sep", "\t").option("quote", "").schema("doc string, ngram string, n bigint").csv(path)


def keyed_store(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key by ``order``."""
    others = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_r")).select(*keys, "_r.*")


def wide_cells(df: DataFrame, ids: list[str], members: list[str]) -> DataFrame:
    """(ids, member, quantity, status): one row per cell of a wide table.

    NA is missing, - and 0 are zero, thousands separators are taken off; what is no number then is ``unreadable``.
    """
    long = df.select(*ids, *[F.col(m).cast("string").alias(m) for m in members]).unpivot(ids, members, "member", "_v")
    v = F.regexp_replace(F.trim("_v"), ",", "")
    number = F.when(v == "-", F.lit(0.0)).otherwise(v.try_cast("double"))
    status = F.when(v.isNull() | v.isin("", "NA"), "missing").when(number.isNull() | F.isnan(number), "unreadable").when(number == 0, "zero").otherwise("positive")
    return long.select(*ids, "member", F.when(status.isin("zero", "positive"), number).alias("quantity"), status.alias("status"))


def html_cells(html: F.Column) -> F.Column:
    """The texts of the cells of all tables of a page, in order, tags and entities for blanks taken out."""
    cells = F.regexp_extract_all(html, F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1))
    return F.transform(cells, lambda c: F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "(?s)<[^>]*>", " "), "&nbsp;|&#160;", " "), r"\s+", " ")))


def feed_items(spark: SparkSession, path: str, tag: str = "item") -> DataFrame:
    """(title, link, published) of RSS files; dates in several notations, null where none fits."""
    items = spark.read.format("xml").option("rowTag", tag).schema("title string, link string, pubDate string").load(path)
    forms = ("EEE, dd MMM yyyy HH:mm:ss Z", "EEE, d MMM yyyy HH:mm:ss Z", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd")
    d = F.regexp_replace("pubDate", "GMT$", "+0000")
    no_day = F.regexp_replace(d, r"^\w{3}, ", "")
    parsed = F.coalesce(*[F.try_to_timestamp(no_day, F.lit(f.replace("EEE, ", ""))) for f in forms])
    return items.select("title", "link", parsed.alias("published"))


def vintages(spark: SparkSession, path: str) -> DataFrame:
    """All versions of a table kept as folders vintage=yyyy-MM-dd, with their ``vintage``; filters on it prune folders."""
    return spark.read.parquet(path)


class ChunkSource(DataSource):
    """Timeline chunks of a query, one partition per range of days, read from files named by the hash of query and range.

    Options: folder, query, start, end (yyyy-MM-dd), days (length of a range). A range without a file gives no rows.
    """

    @classmethod
    def name(cls) -> str:
        return "timeline_chunks"

    def schema(self) -> str:
        return "date string, value double"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ChunkReader(self.options)


def chunk_name(query: str, start: str, end: str) -> str:
    """File name of a chunk."""
    return hashlib.sha1(f"{query}|{start}|{end}".encode()).hexdigest()[:16]


class ChunkReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        days = pd.date_range(self.options["start"], self.options["end"], freq=f"{int(self.options.get('days', 365))}D")
        end = pd.Timestamp(self.options["end"])
        ends = [*(d - pd.Timedelta(days=1) for d in days[1:]), end]
        return [InputPartition((str(a.date()), str(b.date()))) for a, b in zip(days, ends, strict=True)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        import json
        import os

        start, end = partition.value
        file = os.path.join(self.options["folder"], chunk_name(self.options["query"], start, end) + ".json")
        if os.path.exists(file):
            with open(file, encoding="utf-8") as f:
                for r in json.load(f):
                    yield r["date"], r["value"]


def first_of_day(chunks: DataFrame) -> DataFrame:
    """(d, value): the first reading of each day, so that hourly chunks fall back to one value a day."""
    day = F.to_date(F.substring("date", 1, 8), "yyyyMMdd")
    return chunks.groupBy(day.alias("d")).agg(F.min_by("value", "date").alias("value"))
