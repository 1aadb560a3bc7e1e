"""Matching inside a transaction and attribution inside a time window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallyloom.operators.skew import neighbour

#: Indices of one slice of a transaction or group; a longer one is scanned slice by slice.
SLICE = 65_536


def nearest_forward(first: DataFrame, ops: DataFrame, tx: str, first_index: str, op_index: str, take: Sequence[str], width: int | None = None) -> DataFrame:
    """For each row of ``first`` the operation of the same transaction with the smallest greater index, or nulls.

    One descending scan over the union of both sides, so pairs are never formed and a row is never looked at twice. Of
    operations with one index the least in ``take`` counts; a null transaction matches nothing.
    """
    op = F.struct(F.col(op_index).alias("op_index"), *[F.col(c) for c in take])
    marks = first.select(tx, F.col(first_index).alias("idx"), F.struct(*first.columns).alias("own"), F.lit(None).alias("op"), F.lit(1).alias("kind"))
    others = ops.select(tx, F.col(op_index).alias("idx"), F.lit(None).alias("own"), op.alias("op"), F.lit(0).alias("kind"))
    both = marks.unionByName(others)
    joined = neighbour(both, [tx], [F.col("idx"), F.col("kind"), F.col("op")], "op", F.floor(F.col("idx") / (width or SLICE)), True, "next_op")
    return joined.where("kind = 1").select("own.*", "next_op.*")


def windows(starts: DataFrame, group: str, index: str) -> DataFrame:
    """Open intervals from each start to the next of its group; the last is open-ended (``next_index`` null)."""
    return starts.withColumn("next_index", F.lead(index).over(W.partitionBy(group).orderBy(index)))


def inside_windows(events: DataFrame, starts: DataFrame, group: str, index: str, take: Sequence[str], width: int | None = None) -> DataFrame:
    """The start whose open interval holds each event, by one ordered scan of both; events before any start are left
    out, as is an event at the very index of a start. Of starts with one index the greatest in ``take`` counts; a null
    group holds nothing."""
    held = F.struct(F.col(index).alias("start_index"), *[F.col(c) for c in take])
    marks = starts.select(group, F.col(index).alias("idx"), held.alias("held"), F.lit(None).alias("event"), F.lit(0).alias("kind"))
    rows = events.select(group, F.col(index).alias("idx"), F.lit(None).alias("held"), F.struct(*events.columns).alias("event"), F.lit(1).alias("kind"))
    both = marks.unionByName(rows)
    joined = neighbour(both, [group], [F.col("idx"), F.col("kind"), F.col("held")], "held", F.floor(F.col("idx") / (width or SLICE)), False, "in_start")
    return joined.where("kind = 1 and in_start is not null and in_start.start_index < idx").select("event.*", "in_start.*")


def attribute(buys: DataFrame, engagements: DataFrame, keys: Sequence[str], days: int) -> DataFrame:
    """Split every purchase equally among the authors its buyer engaged with in the window before it.

    buys: the keys, purchase, bought_at, usd. engagements: the keys, author, engaged_at. An engagement counts if
    engaged_at < bought_at <= engaged_at + days. Times are cut into buckets of the window, so a purchase meets only
    engagements of its own and the previous bucket and a busy buyer is spread over the buckets.
    """
    span = days * 86_400_000_000
    keys = list(keys)
    b = buys.withColumn("b_us", F.unix_micros(F.col("bought_at").cast("timestamp"))).withColumn("bucket", F.floor(F.col("b_us") / span))
    e = engagements.withColumn("e_us", F.unix_micros(F.col("engaged_at").cast("timestamp")))
    e = e.select(*keys, "author", "e_us", F.explode(F.array(F.floor(F.col("e_us") / span), F.floor(F.col("e_us") / span) + 1)).alias("bucket"))
    pairs = b.join(e, [*keys, "bucket"]).where((F.col("e_us") < F.col("b_us")) & (F.col("b_us") <= F.col("e_us") + span))
    pairs = pairs.select(*keys, "purchase", "bought_at", "usd", "author").dropDuplicates([*keys, "purchase", "author"])
    n = F.count("*").over(W.partitionBy(*keys, "purchase"))
    return pairs.withColumn("n_influencers", n).withColumn("attributed_usd", F.col("usd") / F.col("n_influencers"))


def author_summary(attributed: DataFrame, casts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Posts and attributed purchases per author, on either side alone or both; absent numbers are 0."""
    posts = casts.groupBy(*keys, "author").agg(F.countDistinct("cast").alias("cast_count"))
    sold = attributed.groupBy(*keys, "author").agg(
        F.countDistinct("buyer").alias("unique_buyers"), F.countDistinct("purchase").alias("total_purchases"),
        F.sum(F.col("usd").cast("decimal(28,6)")).cast("double").alias("total_usd"), F.sum(F.col("attributed_usd").cast("decimal(28,6)")).cast("double").alias("attributed_usd"),
    )
    numbers = ["cast_count", "unique_buyers", "total_purchases", "total_usd", "attributed_usd"]
    return posts.join(sold, [*keys, "author"], "full").fillna(0, numbers)
