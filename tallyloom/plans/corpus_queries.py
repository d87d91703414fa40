"""Documents, titles and addresses; nothing here is sampled or cut but the top-k lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.instants import BLANKS, strip
from ..operators import corpus as C
from .base import load, r6, r6_sql

#: The dictionary of the examples: group, channel, phrase; and the anchor word of some groups.
PHRASES = [
    ("port/q1", "port", "coast guard"), ("port/q1", "port", "port authority"), ("port/q2", "port", "war risk premium"), ("energy/q1", "energy", "crude shipments"),
    ("energy/q1", "energy", "refinery operator"), ("energy/q2", "energy", "solar glass"), ("trade/q1", "trade", "tariff review board"), ("trade/q1", "trade", "trade delegation"), ("trade/q2", "trade", "freight broker"),
]
ANCHORS = [("port/q2", "underwriter"), ("energy/q1", "embargo"), ("trade/q2", "canal")]


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").select("doc_id", "text", "title", "url", "source", "channel", (F.col("doc_id") % 48).alias("bucket"))


def _phrases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(g, p) for g, _, p in PHRASES], "grp string, phrase string")


def _channels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted({(g, c) for g, c, _ in PHRASES}), "grp string, topic string")


def f01_norm_tokens(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "pilot_sheet").select("sheet_row", C.norm(F.col("title")).alias("norm"), C.headline_norm(F.col("title")).alias("headline"))


def f02_phrase_match(spark: SparkSession, d: str) -> DataFrame:
    return C.phrase_matches(_docs(spark, d), _phrases(spark))


def f04_anchor(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d)
    anchors = spark.createDataFrame(ANCHORS, "grp string, anchor string")
    return C.anchored(C.phrase_matches(docs, _phrases(spark)).select("doc_id", "grp").distinct(), docs, anchors).select("doc_id", "grp")


def f06_domain(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "pilot_sheet").groupBy(C.domain(F.trim("url")).alias("host")).agg(F.count(F.lit(1)).alias("n"))


def a06_doc_shares(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d)
    return C.window_shares(docs, C.phrase_matches(docs, _phrases(spark))).select("grp", "numerator", "denominator", r6("share").alias("share"))


def a06_channel_shares(spark: SparkSession, d: str) -> DataFrame:
    """A channel's share is the sum of its groups' shares, in which a document may count twice."""
    docs = _docs(spark, d)
    g = C.window_shares(docs, C.phrase_matches(docs, _phrases(spark))).join(_channels(spark), "grp")
    return g.groupBy("topic").agg(r6(100.0 * F.sum("numerator") / F.max("denominator")).alias("share"))


def a07_exact_distinct(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).groupBy("channel").agg(F.count_distinct("url").alias("urls"), F.count_distinct("source").alias("sources"))


def f14_title_hits(spark: SparkSession, d: str) -> DataFrame:
    m = C.phrase_matches(load(spark, d, "pilot_sheet"), spark.createDataFrame([("t", p) for p in ("tariff board", "coast guard", "copper quota", "crude swap", "visa waiver")], "grp string, phrase string"), key="sheet_row", text="title")
    return m.groupBy("phrase").agg(F.count(F.lit(1)).alias("n"))


def f15_first_match(spark: SparkSession, d: str) -> DataFrame:
    """The first topic in the order of the dictionary that matches a document, else general."""
    order = spark.createDataFrame([("port/q1", "port", 1), ("port/q2", "port", 1), ("energy/q1", "energy", 2), ("energy/q2", "energy", 2), ("trade/q1", "trade", 3), ("trade/q2", "trade", 3)], "grp string, topic string, ord int")
    docs = _docs(spark, d)
    first = C.phrase_matches(docs, _phrases(spark)).join(order, "grp").groupBy("doc_id").agg(F.min_by("topic", "ord").alias("topic"))
    return docs.select("doc_id").join(first, "doc_id", "left").select("doc_id", F.coalesce("topic", F.lit("general")).alias("topic"))


def _articles(spark: SparkSession, d: str) -> DataFrame:
    tiers = load(spark, d, "source_tiers")
    s = load(spark, d, "pilot_sheet").select("sheet_row", "title", F.lower(F.trim("domain")).alias("domain"), "url", F.lower(F.trim("channel")).alias("channel"))
    return s.join(tiers, "domain", "left")


def t02_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """One article per title (or address), the lower tier first, then the lower row."""
    key = F.substring(F.lower(strip(F.coalesce(F.col("title"), F.col("url")))), 1, 120)
    a = _articles(spark, d).withColumn("dedupe_key", key).where("dedupe_key is not null")
    return C.best_per_key(a.select("dedupe_key", "sheet_row", "tier"), ["dedupe_key"], [F.coalesce("tier", F.lit(5)), F.col("sheet_row")]).select("dedupe_key", "sheet_row", "tier")


def t01_tier_cut(spark: SparkSession, d: str) -> DataFrame:
    a = _articles(spark, d).where("channel is not null")
    hit = F.contains(C.headline_norm(F.col("title")), F.lit(" tariff "))
    order = [F.coalesce("tier", F.lit(5)), F.desc(F.coalesce(hit, F.lit(False))), F.col("sheet_row")]
    return C.top_per_key(a, ["channel"], order, 75, F.col("sheet_row")).select("channel", "sheet_row", F.col("rank").cast("bigint").alias("rank"))


def a15_tier_share(spark: SparkSession, d: str) -> DataFrame:
    a = _articles(spark, d).where("channel is not null")
    cut = C.top_per_key(a, ["channel"], [F.coalesce("tier", F.lit(5)), F.col("sheet_row")], 150, F.col("sheet_row"))
    return cut.groupBy("channel").agg(F.count(F.lit(1)).alias("n"), r6(F.count_if(F.col("tier") <= 2) / F.count(F.lit(1))).alias("share"))


def a12_hhi(spark: SparkSession, d: str) -> DataFrame:
    li = load(spark, d, "lineitem").select(F.year("l_shipdate").alias("year"), "l_suppkey")
    return C.concentration(li, ["year"], "l_suppkey").select(F.col("year").cast("bigint").alias("year"), "members", r6("hhi").alias("hhi"))


def a13_breadth(spark: SparkSession, d: str) -> DataFrame:
    """By channel: documents, distinct sources, and the source with the most documents (the first by name on ties)."""
    n = _docs(spark, d).where("source is not null").groupBy("channel", "source").agg(F.count(F.lit(1)).alias("n"))
    top = F.min_by("source", F.struct(-F.col("n"), F.col("source")))
    return n.groupBy("channel").agg(F.sum("n").alias("docs"), F.count(F.lit(1)).alias("sources"), top.alias("top_source"), r6(F.max("n") / F.sum("n")).alias("top_share"))


def a14_syndication(spark: SparkSession, d: str) -> DataFrame:
    t = C.norm(F.col("title"))
    a = _docs(spark, d).where("title is not null and url is not null")
    return a.groupBy("channel").agg(F.count_distinct("url").alias("articles"), F.count_distinct(t).alias("stories"), r6(F.count_distinct("url") / F.count_distinct(t)).alias("multiplier"))


def a22_theme_topk(spark: SparkSession, d: str) -> DataFrame:
    """The ten words of at least seven letters in the most English documents, with their share."""
    label = F.regexp_extract(F.lower(strip(F.col("lang"))), r"^([a-z]+)(?:[\s_\-.@(].*)?$", 1)  # any usual spelling of the label
    docs = load(spark, d, "documents").where(label.isin("en", "eng", "english") & F.col("text").isNotNull())
    words = docs.select("doc_id", F.explode(F.array_distinct(F.split(C.norm(F.col("text")), " "))).alias("word")).where("length(word) >= 7")
    top = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(10)
    return top.join(docs.agg(F.count(F.lit(1)).alias("_all")), F.lit(True)).select("word", "n", r6(F.col("n") / F.col("_all")).alias("share"))


def a25_jaccard_channels(spark: SparkSession, d: str) -> DataFrame:
    members = _docs(spark, d).where("channel is not null and source is not null").select("channel", "source").distinct()
    return C.set_similarity(members, "channel", "source").select("a", "b", "common", "either", r6("jaccard").alias("jaccard"))


def t05_hash_rank_sample(spark: SparkSession, d: str) -> DataFrame:
    s = C.hash_rank_sample(_docs(spark, d).where("channel is not null").select("doc_id", "channel"), ["channel"], "doc_id", 20, "audit-1")
    return s.select("doc_id", "channel", F.col("rank").cast("bigint").alias("rank"), r6("inclusion").alias("inclusion"))


def t07_first_per_window(spark: SparkSession, d: str) -> DataFrame:
    """The first event of each half hour."""
    e = load(spark, d, "events").withColumn("window_no", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_800_000_000))
    return C.best_per_key(e.select("window_no", "event_id", "ts"), ["window_no"], [F.col("ts"), F.col("event_id")]).select("window_no", "event_id")


def j11_annotate(spark: SparkSession, d: str) -> DataFrame:
    """Match rate of articles against the tiers of their sources, by channel."""
    return _articles(spark, d).groupBy("channel").agg(F.count(F.lit(1)).alias("articles"), F.count("tier").alias("annotated"), r6(F.count("tier") / F.count(F.lit(1))).alias("rate"))


def j17_lane_merge(spark: SparkSession, d: str) -> DataFrame:
    """Articles of three lanes, each address once by lane order, then each title once by tier and row."""
    a = _articles(spark, d).where("url is not null and title is not null").withColumn("lane", (F.col("sheet_row") % 3).cast("bigint"))
    by_url = C.best_per_key(a.select("url", "title", "lane", "sheet_row", "tier"), ["url"], [F.col("lane"), F.col("sheet_row")])
    by_title = C.best_per_key(by_url.withColumn("title", C.norm(F.col("title"))), ["title"], [F.coalesce("tier", F.lit(5)), F.col("sheet_row")])
    return by_title.groupBy("lane").agg(F.count(F.lit(1)).alias("n"), F.sum("sheet_row").alias("row_sum"))


def u01_union_days(spark: SparkSession, d: str) -> DataFrame:
    li, o = load(spark, d, "lineitem"), load(spark, d, "orders")
    return li.select(F.to_date("l_shipdate").cast("string").alias("d")).union(o.select(F.to_date("o_orderdate").cast("string"))).distinct()


def u02_intersect_days(spark: SparkSession, d: str) -> DataFrame:
    li, o = load(spark, d, "lineitem"), load(spark, d, "orders")
    return li.where("l_returnflag = 'R'").select(F.to_date("l_shipdate").cast("string").alias("d")).intersect(o.where("o_orderpriority = '1-URGENT'").select(F.to_date("o_orderdate").cast("string")))


def u06_set_equality(spark: SparkSession, d: str) -> DataFrame:
    """Members of either of two sets that aren't in the other: sources of documents and of the tier list."""
    a = _docs(spark, d).where("source is not null").select(F.col("source").alias("domain")).distinct().withColumn("a", F.lit(1))
    b = load(spark, d, "source_tiers").select("domain").distinct().withColumn("b", F.lit(1))
    return a.join(b, "domain", "full_outer").where("a is null or b is null").select("domain", F.when(F.col("a").isNull(), "tiers only").otherwise("documents only").alias("side"))


def s02_compose_queries(spark: SparkSession, d: str) -> DataFrame:
    """Phrases packed into queries of at most 60 characters by topic."""
    phrases = spark.createDataFrame([(g, p) for g, _, p in PHRASES], "grp string, phrase string")
    topics = phrases.groupBy(F.substring_index("grp", "/", 1).alias("topic")).agg(F.array_sort(F.collect_list(F.concat(F.lit('"'), F.col("phrase"), F.lit('"')))).alias("terms"), F.lit("India").alias("anchor"))
    return C.composed(topics, budget=60)


QUERIES = {
    f.__name__: f
    for f in (
        f01_norm_tokens, f02_phrase_match, f04_anchor, f06_domain, f14_title_hits, f15_first_match, a06_doc_shares, a06_channel_shares, a07_exact_distinct, a12_hhi, a13_breadth, a14_syndication, a15_tier_share,
        a22_theme_topk, a25_jaccard_channels, t01_tier_cut, t02_dedupe, t05_hash_rank_sample, t07_first_per_window, j11_annotate, j17_lane_merge, u01_union_days, u02_intersect_days, u06_set_equality, s02_compose_queries,
    )
}


def _n(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g'))"


def _h(x: str) -> str:
    return f"(' ' || regexp_replace(lower({x}), '[^a-z0-9 ]', ' ', 'g') || ' ')"


_PH = "ph as (select * from (values " + ", ".join(f"('{g}', '{c}', '{p}')" for g, c, p in PHRASES) + ") t(grp, topic, phrase))"
_M = f"{_PH}, dn as (select doc_id, doc_id % 48 as bucket, ' ' || {_n('text')} || ' ' as n from documents where text is not null), m as (select distinct doc_id, bucket, grp, topic, phrase from dn join ph on contains(n, ' ' || phrase || ' '))"
_SH = f"{_M}, den as (select sum(c) as den from (select count(distinct doc_id) as c from documents group by doc_id % 48)), num as (select grp, any_value(topic) as topic, sum(c) as num from (select bucket, grp, any_value(topic) as topic, count(distinct doc_id) as c from m group by bucket, grp) group by grp)"
_A = "art as (select s.sheet_row, s.title, lower(trim(s.domain)) as domain, s.url, lower(trim(s.channel)) as channel, t.tier from pilot_sheet s left join source_tiers t on t.domain = lower(trim(s.domain)))"

SQL = {
    "f01_norm_tokens": f"select sheet_row, {_n('title')} as norm, {_h('title')} as headline from pilot_sheet",
    "f02_phrase_match": f"with {_M} select doc_id, grp, phrase from m",
    "f04_anchor": f"with {_M}, an as (select * from (values {', '.join(f'''('{g}', '{a}')''' for g, a in ANCHORS)}) t(grp, anchor)) select distinct m.doc_id, m.grp from m left join an using (grp) join dn using (doc_id) where anchor is null or contains(dn.n, ' ' || anchor || ' ')",
    "f06_domain": r"select case when regexp_matches(trim(url), '^https?://[^/?#]+', 'i') then regexp_replace(lower(regexp_extract(trim(url), '^[hH][tT][tT][pP][sS]?://([^/?#]+)', 1)), '^www\.', '') end as host, count(*)::bigint as n from pilot_sheet group by 1",
    "f14_title_hits": f"with p as (select unnest(['tariff board', 'coast guard', 'copper quota', 'crude swap', 'visa waiver']) as phrase) select phrase, count(*)::bigint as n from p join pilot_sheet on contains(' ' || {_n('title')} || ' ', ' ' || phrase || ' ') group by phrase",
    "f15_first_match": f"with {_M}, f as (select doc_id, arg_min(topic, case topic when 'port' then 1 when 'energy' then 2 else 3 end) as topic from m group by doc_id) select doc_id, coalesce(topic, 'general') as topic from documents left join f using (doc_id)",
    "a06_doc_shares": f"with {_SH} select grp, num::bigint as numerator, den::bigint as denominator, {r6_sql('100.0::double * num / den')} as share from num, den",
    "a06_channel_shares": f"with {_SH} select topic, {r6_sql('100.0::double * sum(num) / max(den)')} as share from num, den group by topic",
    "a07_exact_distinct": "select channel, count(distinct url)::bigint as urls, count(distinct source)::bigint as sources from documents group by channel",
    "a12_hhi": f"with c as (select year(l_shipdate) as year, l_suppkey, count(*) as n from lineitem group by all), r as (select *, sum(n) over (partition by year) as t, count(*) over (partition by year) as members, row_number() over (partition by year order by n desc, l_suppkey) as i from c) select year::bigint as year, members::bigint as members, {r6_sql('sum(pow(n / t, 2)) filter (where i <= 10)')} as hhi from r group by year, members",
    "a13_breadth": f"with n as (select channel, source, count(*) as n from documents where source is not null group by all) select channel, sum(n)::bigint as docs, count(*)::bigint as sources, arg_min(source, row(-n, source)) as top_source, {r6_sql('max(n) / sum(n)')} as top_share from n group by channel",
    "a14_syndication": f"select channel, count(distinct url)::bigint as articles, count(distinct {_n('title')})::bigint as stories, {r6_sql(f'count(distinct url) / count(distinct {_n("title")})')} as multiplier from documents where title is not null and url is not null group by channel",
    "a15_tier_share": f"with {_A}, r as (select *, row_number() over (partition by channel order by coalesce(tier, 5), sheet_row) as i from art where channel is not null) select channel, count(*)::bigint as n, {r6_sql('count(*) filter (where tier <= 2) / count(*)')} as share from r where i <= 150 group by channel",
    "a22_theme_topk": f"with en as (select doc_id, {_n('text')} as n from documents where regexp_extract(lower(trim(lang, '{BLANKS}')), '^([a-z]+)([\\s_\\-.@(].*)?$', 1) in ('en', 'eng', 'english') and text is not null), w as (select unnest(list_distinct(string_split(n, ' '))) as word from en) select word, count(*)::bigint as n, {r6_sql('count(*) / (select count(*) from en)')} as share from w where length(word) >= 7 group by word order by count(*) desc, word limit 10",
    "a25_jaccard_channels": f"with m as (select distinct channel, source from documents where channel is not null and source is not null), s as (select channel, count(*) as n from m group by 1), p as (select x.channel as a, y.channel as b, count(*) as common from m x join m y on x.source = y.source and x.channel < y.channel group by all) select a, b, common::bigint as common, (u.n + v.n - common)::bigint as either, {r6_sql('common / (u.n + v.n - common)')} as jaccard from p join s u on u.channel = a join s v on v.channel = b",
    "t01_tier_cut": f"with {_A}, r as (select channel, sheet_row, row_number() over (partition by channel order by coalesce(tier, 5), coalesce(contains({_h('title')}, ' tariff '), false) desc, sheet_row) as rank from art where channel is not null) select channel, sheet_row, rank::bigint as rank from r where rank <= 75",
    "t02_dedupe": f"with {_A}, k as (select *, substr(lower(trim(coalesce(title, url), '{BLANKS}')), 1, 120) as dedupe_key from art) select dedupe_key, sheet_row, tier from k where dedupe_key is not null qualify row_number() over (partition by dedupe_key order by coalesce(tier, 5), sheet_row) = 1",
    "t05_hash_rank_sample": f"with r as (select doc_id, channel, row_number() over (partition by channel order by sha256('audit-1|' || doc_id), doc_id) as rank, count(*) over (partition by channel) as n from documents where channel is not null) select doc_id, channel, rank::bigint as rank, {r6_sql('least(1.0, 20 / n)')} as inclusion from r where rank <= 20",
    "t07_first_per_window": "select floor(epoch_us(ts) / 1800000000)::bigint as window_no, arg_min(event_id, row(ts, event_id)) as event_id from events group by 1",
    "j11_annotate": f"with {_A} select channel, count(*)::bigint as articles, count(tier)::bigint as annotated, {r6_sql('count(tier) / count(*)')} as rate from art group by channel",
    "j17_lane_merge": f"with {_A}, u as (select *, sheet_row % 3 as lane from art where url is not null and title is not null qualify row_number() over (partition by url order by sheet_row % 3, sheet_row) = 1), t as (select * from u qualify row_number() over (partition by {_n('title')} order by coalesce(tier, 5), sheet_row) = 1) select lane::bigint as lane, count(*)::bigint as n, sum(sheet_row)::bigint as row_sum from t group by lane",
    "u01_union_days": "select strftime(l_shipdate, '%Y-%m-%d') as d from lineitem union select strftime(o_orderdate, '%Y-%m-%d') from orders",
    "u02_intersect_days": "select strftime(l_shipdate, '%Y-%m-%d') as d from lineitem where l_returnflag = 'R' intersect select strftime(o_orderdate, '%Y-%m-%d') from orders where o_orderpriority = '1-URGENT'",
    "u06_set_equality": "with a as (select distinct source as domain from documents where source is not null) select coalesce(a.domain, b.domain) as domain, case when a.domain is null then 'tiers only' else 'documents only' end as side from a full join (select distinct domain from source_tiers) b on a.domain = b.domain where a.domain is null or b.domain is null",
}
