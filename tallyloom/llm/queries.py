"""Queries p4, p5, p7, p8 and p9 over the whole test tables, with SQL where it says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import load
from . import bpe, dedupe, language, packing, sampling


def _sampled(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return sampling.stratified_sample(load(spark, d, "pilot_sheet"), load(spark, d, "sample_targets"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Strata of which the sample holds fewer rows than wanted."""
    sample, report = _sampled(spark, d)
    n = sample.groupBy("target_id").agg(F.count(F.lit(1)).alias("n"))
    return report.select("target_id", "wanted").join(n, "target_id", "left").where(F.coalesce("n", F.lit(0)) < F.col("wanted")).select("target_id")


def p4_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each stratum and of those wanted, from the report; the stratum's rows in the sample are at least the lesser of both."""
    sample, report = _sampled(spark, d)
    n = sample.groupBy("target_id").agg(F.count(F.lit(1)).alias("n"))
    kept = F.coalesce("n", F.lit(0)) >= F.least("wanted", "available")
    return report.join(n, "target_id", "left").select("target_id", "available", "wanted", "short", kept.alias("minimum_kept"))


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return _sampled(spark, d)[1]


def p4_sample(spark: SparkSession, d: str) -> DataFrame:
    return _sampled(spark, d)[0].withColumnRenamed("row", "sheet_row")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.find_copies(load(spark, d, "pilot_sheet"))[1]


def p5_records(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.find_copies(load(spark, d, "pilot_sheet"))[0]


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_texts(load(spark, d, "documents"))


def p7_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose decoded ids are not their text: none."""
    docs = load(spark, d, "documents")
    back = bpe.decode_ids(bpe.encode_texts(docs)).withColumnRenamed("text", "decoded")
    return docs.select("doc_id", "text").join(back, "doc_id").where(F.coalesce("text", F.lit("")) != F.col("decoded")).select("doc_id")


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(bpe.count_tokens(load(spark, d, "documents")).persist())


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that the assignment puts into more than one container."""
    return p8_containers(spark, d).groupBy("doc_id").agg(F.min("container").alias("first"), F.max("container").alias("last")).where("first < last").select("doc_id")


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """How full the containers are."""
    c = p8_containers(spark, d).where("container >= 0").groupBy("container").agg(F.sum("n").alias("used"))
    return c.agg(F.count(F.lit(1)).alias("containers"), F.sum("used").alias("tokens"), (F.sum("used") / F.count(F.lit(1)) / packing.CAPACITY).alias("fill"), F.max("used").alias("fullest"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return language.label_cases(spark, load(spark, d, "documents")).select("doc_id", "lang")


def p9_documents(spark: SparkSession, d: str) -> DataFrame:
    return language.identify(spark, load(spark, d, "documents"))[0]


def p9_segments(spark: SparkSession, d: str) -> DataFrame:
    return language.identify(spark, load(spark, d, "documents"))[1]


QUERIES = {f.__name__: f for f in (p4_found, p4_report, p4_sizes, p4_sample, p5_found, p5_records, p7_ids, p7_roundtrip, p8_found, p8_containers, p8_fill, p9_found, p9_documents, p9_segments)}

_FOLD = r"replace(regexp_replace(lower(upper({})), '[^\p{{L}}\p{{M}}\p{{Nd}}]+', '', 'g'), 'ς', 'σ')"
_BASE = "(case when strpos(url, '?') > 0 then substr(url, 1, strpos(url, '?') - 1) else url end)"
_PARAMS = "(case when strpos(url, '?') > 0 then substr(url, strpos(url, '?') + 1) else '' end)"
_KEYS = f"""keyed as (select sheet_row, case when length(title) > 0 and length(url) > 0 then {_FOLD.format('title')} || '|' || {_FOLD.format(_BASE)} || '?' ||
  coalesce(array_to_string(list_sort(list_filter(list_transform(string_split({_PARAMS}, '&'), lambda x: {_FOLD.format('x')}), lambda x: x <> '')), '&'), '') end as k from pilot_sheet)"""
_NAME = r"regexp_replace(lower({}), '^\s+|\s+$', '', 'g')"

SQL = {
    "p4_found": rf"""with t as (select target_id, regexp_replace({_NAME.format('channel')}, '[\s_-]+', '_', 'g') as c, {_NAME.format('domain')} as d, greatest(min_rows, floor(target_share * sample_rows + 0.5 + 1e-9)) as wanted from sample_targets),
      s as (select regexp_replace({_NAME.format('channel')}, '[\s_-]+', '_', 'g') as c, regexp_replace({_NAME.format('domain')}, '^www\.', '') as d from pilot_sheet where channel is not null and domain is not null),
      n as (select c, case when d in (select d from t) then d else '(other)' end as d, count(*) as n from s group by all)
      select target_id from t left join n using (c, d) where coalesce(n, 0) < wanted""",
    "p4_sizes": rf"""with t as (select target_id, regexp_replace({_NAME.format('channel')}, '[\s_-]+', '_', 'g') as c, {_NAME.format('domain')} as d, greatest(min_rows, floor(target_share * sample_rows + 0.5 + 1e-9))::bigint as wanted from sample_targets),
      s as (select regexp_replace({_NAME.format('channel')}, '[\s_-]+', '_', 'g') as c, regexp_replace({_NAME.format('domain')}, '^www\.', '') as d from pilot_sheet where channel is not null and domain is not null),
      n as (select c, case when d in (select d from t) then d else '(other)' end as d, count(*) as n from s group by all)
      select target_id, coalesce(n, 0)::bigint as available, wanted, greatest(0, wanted - coalesce(n, 0))::bigint as short, true as minimum_kept from t left join n using (c, d)""",
    "p5_found": f"with {_KEYS}, m as (select k, min(sheet_row) as keep_row from keyed where k is not null group by k) select keep_row, sheet_row as copy_row from keyed join m using (k) where sheet_row > keep_row",
    "p5_records": f"with {_KEYS} select min(sheet_row) as keep_row, count(*)::bigint as copies from keyed group by coalesce(k, 'row ' || sheet_row)",
    "p7_roundtrip": "select doc_id from documents where doc_id < doc_id",
}
