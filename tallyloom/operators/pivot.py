"""Weighted engagement pivots, cohorts and channel summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The weight of one engagement by kind.
WEIGHTS = {"reply": 3, "recast": 2, "mention": 2, "like": 1}


def weighted_pivot(rows: DataFrame, keys: Sequence[str], kind: str, weight: str, kinds: Mapping[str, int] = WEIGHTS) -> DataFrame:
    """Counts per kind as columns, 0 where a kind is absent, and their weighted score rounded half to even."""
    counts = rows.where(F.col(kind).isin(*kinds)).groupBy(*keys, weight).pivot(kind, list(kinds)).count().na.fill(0, list(kinds))
    score = reduce(lambda a, b: a + b, [F.col(k) * w for k, w in kinds.items()])
    return counts.withColumn("weighted_score", F.bround(F.coalesce(F.col(weight), F.lit(1.0)) * score, 4)).drop(weight)


def mentions(posts: DataFrame, brands: DataFrame, text: str, names: str, ids: str, author: str) -> DataFrame:
    """One row per post and mentioned brand other than its author: resolved ids count, and only where a post has none
    its text is searched for the brand's handle."""
    resolved = posts.withColumn("brand", F.explode(F.array_distinct(ids))).join(brands.select(F.col("fid").alias("brand")), "brand", "left_semi")
    handles = brands.where("name is not null").select(F.col("fid").alias("brand"), F.concat(F.lit("@"), F.lower("name")).alias("handle"))
    words = posts.where(F.size(ids) == 0).withColumn("handle", F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"(@[\w.-]*\w)")))))
    by_text = words.join(handles, "handle").drop("handle")
    return resolved.unionByName(by_text).where(F.col("brand") != F.col(author))


def cohort(sources: DataFrame) -> DataFrame:
    """One row per wallet: the least priority, sources in order of priority once each, and the first known account.

    sources: address, fid, source, priority. Rows without an address are left out.
    """
    order = F.struct("priority", "source")
    names = F.array_distinct(F.transform(F.array_sort(F.collect_set(order)), lambda x: x["source"]))
    known = F.when(F.col("fid").isNotNull(), F.struct("priority", "source", "fid"))
    return sources.dropna(subset=["address"]).groupBy("address").agg(F.min("priority").alias("priority"), F.array_join(names, "|").alias("sources"), F.min(known)["fid"].alias("fid"))


def gate(cohorts: DataFrame, max_priority: int | None = None, min_score: float | None = None, limit: int | None = None) -> DataFrame:
    """Priority and score gates (a missing priority is 99, a missing score fails), ordered by priority, score, address."""
    out = cohorts
    if max_priority is not None:
        out = out.where(F.coalesce("priority", F.lit(99)) <= max_priority)
    if min_score is not None:
        out = out.where(F.col("score") >= min_score)
    if limit is None:
        return out
    return out.orderBy(F.asc("priority"), F.desc_nulls_last("score"), F.asc("address")).limit(limit)


def channel_summary(posts: DataFrame, reactions: DataFrame, channel: str, author: str) -> DataFrame:
    """Posts written and reactions given per channel and author, for those who did either."""
    written = posts.groupBy(channel, author).agg(
        F.count("*").alias("casts_posted"), F.sum(F.coalesce("likes_count", F.lit(0)) + F.coalesce("recasts_count", F.lit(0))).alias("reactions_received"),
        F.min("timestamp").alias("first_cast_at"), F.max("timestamp").alias("last_cast_at"),
    )
    given = reactions.groupBy(channel, author).agg(F.count("*").alias("reactions_given"))
    return written.join(given, [channel, author], "full").fillna(0, ["casts_posted", "reactions_received", "reactions_given"])
