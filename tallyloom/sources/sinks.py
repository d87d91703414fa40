"""Writers: merged stores, append-only archives, feeds per entity, deterministic bundles."""

from __future__ import annotations

import hashlib
import io
import json
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class ArchiveError(ValueError):
    """An append would change what an archive already holds."""


def append_day(spark: SparkSession, archive: str, day: DataFrame, *, key: str = "d") -> None:
    """Appends exactly one new day (a column of dates as text) to an archive partitioned by it.

    Raises ArchiveError if the rows span several days or the archive has the day; what is there is never rewritten.
    """
    days = [r[0] for r in day.select(key).distinct().limit(2).collect()]
    if len(days) != 1:
        raise ArchiveError("an append holds exactly one day")
    try:
        known = spark.read.parquet(archive).where(F.col(key) == days[0]).limit(1).count()
    except Exception as e:  # no archive yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        known = 0
    if known:
        raise ArchiveError(f"{days[0]} is in the archive")
    day.write.mode("append").partitionBy(key).parquet(archive)


def rolling_archive(df: DataFrame, days: int, *, key: str = "d") -> DataFrame:
    """The rows of the last ``days`` days of the table."""
    last = df.agg(F.max(F.to_date(key)).alias("_last"))
    return df.join(last, F.to_date(key) > F.date_sub("_last", days)).drop("_last")


def write_feeds(df: DataFrame, path: str, entity: str) -> None:
    """One folder per entity."""
    df.write.mode("overwrite").partitionBy(entity).json(path)


def parallel_arrays(df: DataFrame, index: str, values: list[str]) -> DataFrame:
    """One row (payload): a JSON object of arrays that share the order of ``index``; for tables of published size."""
    rows = F.array_sort(F.collect_list(F.struct(index, *values)))
    return df.agg(rows.alias("_r")).select(F.to_json(F.struct(*[F.col("_r")[c].alias(c) for c in (index, *values)])).alias("payload"))


def canonical_json(value: object) -> bytes:
    """Sorted keys, no blanks, UTF-8; NaN and infinities are refused."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False).encode()


def seal(record: dict, field: str = "record_sha256") -> dict:
    """The record with the hash of its canonical form without that field."""
    return record | {field: hashlib.sha256(canonical_json({k: v for k, v in record.items() if k != field})).hexdigest()}


def sealed(record: dict, field: str = "record_sha256") -> bool:
    return record.get(field) == seal(record, field)[field]


def bundle(files: dict[str, bytes]) -> bytes:
    """A ZIP whose bytes depend on names and contents only."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name in sorted(files):
            info = zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0))
            info.compress_type, info.external_attr, info.create_system = zipfile.ZIP_DEFLATED, 0o644 << 16, 3
            z.writestr(info, files[name])
    return out.getvalue()


def byte_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of all files of a folder."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return f.select("path", "length", F.sha2("content", 256).alias("sha256"))
