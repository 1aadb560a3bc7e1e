"""Token registries: merging two sources, deployments, launch registries, pools."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_prefer_left(left: DataFrame, right: DataFrame, keys: Sequence[str], fill: Sequence[str]) -> DataFrame:
    """Left rows win and take the ``fill`` columns from the right where their own are null; right-only rows follow."""
    r = right.select(*keys, *[F.col(c).alias(f"r_{c}") for c in right.columns if c not in keys], F.lit(True).alias("in_right"))
    l_ = left.withColumn("in_left", F.lit(True))
    both = l_.join(r, list(keys), "full")
    out = []
    for c in left.columns:
        if c in keys:
            out.append(F.col(c))
        elif c not in right.columns:
            out.append(F.col(c))
        elif c in fill:
            out.append(F.coalesce(c, f"r_{c}").alias(c))
        else:
            out.append(F.when(F.col("in_left"), F.col(c)).otherwise(F.col(f"r_{c}")).alias(c))
    return both.select(*out)


def deployments(creations: DataFrame, senders: DataFrame, cohort: DataFrame) -> DataFrame:
    """Creations by a known account: the creator if known, else the sender of the transaction if known.

    creations: tx, contract, creator, at. senders: tx, sender. cohort: address. The method is direct where creator and
    sender agree or the sender is unknown, else via_factory.
    """
    known = cohort.select(F.col("address")).distinct()
    s = senders.join(known.withColumnRenamed("address", "sender"), "sender", "left_semi").groupBy("tx").agg(F.min("sender").alias("sender"))
    c = creations.join(s, "tx", "left").join(known.select(F.col("address").alias("creator_known")), F.col("creator") == F.col("creator_known"), "left")
    kept = c.where("creator_known is not null or sender is not null")
    return kept.select(
        F.coalesce("creator_known", "sender").alias("deployer"), "contract", "tx", "at",
        F.when(F.col("sender").isNull() | (F.col("sender") == F.col("creator")), "direct").otherwise("via_factory").alias("deploy_method"),
    )


def roll_up(df: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """Count, first and last time per key."""
    return df.groupBy(*keys).agg(F.count("*").alias("tx_count"), F.min(at).alias("first_tx_at"), F.max(at).alias("last_tx_at"))


def registry(tokens: DataFrame, matched: DataFrame, fees: DataFrame, transactions: DataFrame, key: str, tx: str) -> DataFrame:
    """A launch registry: each token with its matched launcher, its fee recipient and the sender of its transaction."""
    launcher = F.coalesce("launcher", "sender")
    source = F.when(F.col("launcher").isNotNull(), "user_op").when(F.col("sender").isNotNull(), "tx_sender").otherwise("none")
    return tokens.join(matched, key, "left").join(fees, key, "left").join(transactions, tx, "left").withColumns({"deployer": launcher, "source": source})


def pools_by_side(pools: DataFrame, tokens: DataFrame) -> DataFrame:
    """token, pool, other: each listed token with the pools it is in, on either side, by one scan of the pools."""
    sides = F.array(F.struct(F.col("token0").alias("token"), F.col("token1").alias("other")), F.struct(F.col("token1").alias("token"), F.col("token0").alias("other")))
    return pools.select("pool", F.inline(sides)).join(tokens.select("token").distinct(), "token", "left_semi")


def with_decimals(pools: DataFrame, decimals: DataFrame, default: int = 18) -> DataFrame:
    """Decimals of both tokens of a pool; several entries per token count as their greatest, none as the default."""
    d = decimals.groupBy("token").agg(F.max("decimals").alias("d"))
    out = pools
    for i in (0, 1):
        out = out.join(d.select(F.col("token").alias(f"token{i}"), F.col("d").alias(f"decimals{i}")), f"token{i}", "left").fillna(default, [f"decimals{i}"])
    return out


def fan_out_index(events: DataFrame, index: DataFrame) -> DataFrame:
    """One row per index token of a liquidity event; an event between two index tokens gives two."""
    return events.withColumn("token", F.explode(F.array_distinct(F.array("token0", "token1")))).join(index.select("token").distinct(), "token", "left_semi")


def freshness(targets: DataFrame, done: DataFrame, prior: DataFrame, key: str, since: Column) -> DataFrame:
    """What a crawl does with each target: done already, carried forward from a fresh prior row, or fetched.

    Adds ``plan``. A target that is done is left out; a prior row is fresh if checked_at is not before ``since``.
    """
    todo = targets.join(done.select(key).distinct(), key, "left_anti")
    seen = prior.groupBy(key).agg(F.max("checked_at").alias("checked_at"))
    return todo.join(seen, key, "left").withColumn("plan", F.when(F.col("checked_at") >= since, "carry").otherwise("fetch"))
