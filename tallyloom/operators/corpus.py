"""Documents against dictionaries of phrases, and what follows from the matches."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def norm(text: Column) -> Column:
    """Lower-case runs of a-z and 0-9 with one blank between them."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def headline_norm(text: Column) -> Column:
    """As ``norm``, but padded and with every other character as a blank of its own, so that "a - b" isn't "a b"."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(text), "[^a-z0-9 ]", " "), F.lit(" "))


def domain(url: Column) -> Column:
    """Lower-case network location of an http(s) address without one leading www., null for other ones."""
    authority = F.regexp_extract(url, r"^(?i:https?)://([^/?#]+)", 1)
    return F.when(authority != "", F.regexp_replace(F.lower(authority), r"^www\.", ""))


#: Dictionaries of up to so many phrases are tested as a list on each text; larger ones meet the texts by a join.
LISTED_PHRASES = 256


def phrase_matches(docs: DataFrame, phrases: DataFrame, *, key: str = "doc_id", text: str = "text", listed: int = LISTED_PHRASES) -> DataFrame:
    """(key, grp, phrase): the phrases (grp, phrase) whose words stand next to each other in a text.

    Beyond ``listed`` phrases, texts meet them by an equi join on the phrase's first word, which only moves keys and
    words; the whole phrase is then tested on the texts that have its first word.
    """
    wanted = phrases.select("grp", norm(F.col("phrase")).alias("phrase")).where("phrase <> ''").distinct()
    pad = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    normed = docs.select(key, norm(F.col(text)).alias("_n"))
    few = wanted.orderBy("grp", "phrase").limit(listed + 1).collect()
    if not few:
        return normed.join(wanted, F.lit(True)).select(key, "grp", "phrase").limit(0)
    if len(few) <= listed:
        known = F.array(*[F.struct(F.lit(r.grp).alias("grp"), F.lit(r.phrase).alias("phrase")) for r in few])
        padded = normed.select(key, pad(F.col("_n")).alias("_n"))
        return padded.select(key, F.explode(F.filter(known, lambda p: F.contains(F.col("_n"), pad(p["phrase"])))).alias("_p")).select(key, "_p.grp", "_p.phrase").distinct()
    first = wanted.withColumn("_w", F.split("phrase", " ")[0])
    words = normed.select(key, F.explode(F.array_distinct(F.split("_n", " "))).alias("_w"))
    asked = words.join(first, "_w").groupBy(key).agg(F.collect_set(F.struct("grp", "phrase")).alias("_ps"))
    tested = normed.select(key, pad(F.col("_n")).alias("_n")).join(asked, key)
    return tested.select(key, F.explode(F.filter("_ps", lambda p: F.contains(F.col("_n"), pad(p["phrase"])))).alias("_p")).select(key, "_p.grp", "_p.phrase").distinct()


def anchored(matches: DataFrame, docs: DataFrame, anchors: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Matches of groups without an anchor, and those of groups with one whose document has the anchor's words too."""
    hits = phrase_matches(docs, anchors.select("grp", F.col("anchor").alias("phrase")), key=key, text=text).select(key, "grp").distinct()
    free = matches.join(anchors.select("grp").distinct(), "grp", "left_anti")
    return free.unionByName(matches.join(hits, [key, "grp"], "left_semi"), allowMissingColumns=True)


def window_shares(docs: DataFrame, matches: DataFrame, *, key: str = "doc_id", bucket: str = "bucket") -> DataFrame:
    """(grp, numerator, denominator, share): distinct matched documents summed over the buckets, in percent of all documents."""
    den = docs.groupBy(bucket).agg(F.count_distinct(key).alias("_den")).agg(F.sum("_den").alias("denominator"))
    num = matches.join(docs.select(key, bucket), key).groupBy(bucket, "grp").agg(F.count_distinct(key).alias("_num")).groupBy("grp").agg(F.sum("_num").alias("numerator"))
    return num.join(den, F.lit(True)).withColumn("share", 100.0 * F.col("numerator") / F.col("denominator"))  # den has one row


def best_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order, as one aggregate: no sort and no group in one task."""
    others = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*others), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]))
    return df.groupBy(*keys).agg(first.alias("_f")).select(*keys, *[F.col("_f")[c].alias(c) for c in others])


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, salt: Column, salts: int = 32) -> DataFrame:
    """The first n rows of each key with their ``rank``: cut per salt first, so that a hot key is ranked by many tasks."""
    part = Window.partitionBy(*keys, "_salt").orderBy(*order)
    cut = df.withColumn("_salt", F.pmod(F.xxhash64(salt), F.lit(salts))).withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= n)
    return cut.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= n).drop("_salt")


def concentration(df: DataFrame, period: list[str], member: str, top: int = 10) -> DataFrame:
    """(period, members, hhi): number of members and sum of squared shares of the ``top`` largest."""
    counts = df.groupBy(*period, member).agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.groupBy(*period).agg(F.sum("_n").alias("_t"), F.count(F.lit(1)).alias("members"))
    ranked = top_per_key(counts, period, [F.desc("_n"), F.col(member)], top, F.col(member))
    return ranked.join(totals, period).groupBy(*period, "members").agg(F.sum(F.pow(F.col("_n") / F.col("_t"), F.lit(2.0))).alias("hhi"))


#: Owners that sets are compared of; the sets themselves may be of any size.
MAX_OWNERS = 10_000


def set_similarity(members: DataFrame, owner: str, item: str) -> DataFrame:
    """(a, b, common, either, jaccard) for the pairs a < b of owners that share an item; ``members`` is distinct.

    Items are first counted by the set of their owners, so that pairs are formed once for each such set and not for each
    item. More than MAX_OWNERS owners are an error.
    """
    sizes = members.where(F.col(owner).isNotNull()).groupBy(owner).agg(F.count(F.lit(1)).alias("_n")).persist()
    if sizes.limit(MAX_OWNERS + 1).count() > MAX_OWNERS:
        raise ValueError(f"more than {MAX_OWNERS} owners")
    sets = members.where(F.col(item).isNotNull()).groupBy(item).agg(F.sort_array(F.collect_set(owner)).alias("_set")).groupBy("_set").agg(F.count(F.lit(1)).alias("_items"))
    firsts = sets.select("_set", "_items", F.posexplode("_set").alias("_i", "a"))
    pairs = firsts.select("a", F.explode(F.slice("_set", F.col("_i") + 2, F.size("_set"))).alias("b"), "_items").groupBy("a", "b").agg(F.sum("_items").alias("common"))
    j = pairs.join(sizes.select(F.col(owner).alias("a"), F.col("_n").alias("_na")), "a").join(sizes.select(F.col(owner).alias("b"), F.col("_n").alias("_nb")), "b")
    return j.select("a", "b", "common", (F.col("_na") + F.col("_nb") - F.col("common")).alias("either")).withColumn("jaccard", F.col("common") / F.col("either"))


def hash_rank_sample(df: DataFrame, strata: list[str], key: str, n: int, seed: str) -> DataFrame:
    """The n rows of each stratum with the least sha256 of seed|key, with ``rank`` and the stratum's inclusion probability."""
    ranked = df.withColumn("_h", F.sha2(F.concat(F.lit(seed + "|"), F.col(key).cast("string")), 256))
    size = df.groupBy(*strata).agg(F.count(F.lit(1)).alias("_size"))
    best = top_per_key(ranked, strata, [F.col("_h"), F.col(key)], n, F.col("_h"))
    return best.join(size, strata).withColumn("inclusion", F.least(F.lit(1.0), n / F.col("_size"))).drop("_h", "_size")


def compose_queries(terms: list[str], anchor: str | None = None, budget: int = 230) -> list[str]:
    """Terms joined by OR into as few queries as their order allows, each at most ``budget`` characters, the anchor before it.

    Raises ValueError if a term alone is too long. Each query's end is looked up in the running lengths of the terms.
    """
    head = f"{anchor} (" if anchor else "("
    room = budget - len(head) - len(")")
    reach = np.cumsum([0, *(len(t) + len(" OR ") for t in terms)])
    ends = np.searchsorted(reach, reach[:-1] + room + len(" OR "), side="right") - 1  # of a query from each term on
    if (stuck := np.flatnonzero(ends <= np.arange(len(terms)))).size:
        raise ValueError(f"term too long: {terms[stuck[0]][:40]}")
    cuts = [0]
    while cuts[-1] < len(terms):
        cuts.append(int(ends[cuts[-1]]))
    return [f"{head}{' OR '.join(terms[i:j])})" for i, j in pairwise(cuts)]


@F.udtf(returnType="part int, query string")
class ComposeQueries:
    """Table function (terms, anchor, budget) -> (part, query): one row for each query of a list of terms."""

    def eval(self, terms: list[str], anchor: str | None, budget: int) -> Iterator[tuple[int, str]]:
        yield from enumerate(compose_queries(list(terms or ()), anchor, budget))


def composed(groups: DataFrame, *, terms: str = "terms", anchor: str = "anchor", budget: int = 230) -> DataFrame:
    """``groups`` without its terms plus (part, query); a group without terms has no rows."""
    calls = ComposeQueries(F.col(terms).outer(), F.col(anchor).outer(), F.lit(budget))
    return groups.lateralJoin(calls).drop(terms, anchor)
