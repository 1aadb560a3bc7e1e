"""Keyed upserts without MERGE: a full outer join of the old snapshot with the new rows under one policy per column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from enum import Enum

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Policy(Enum):
    """What happens to a column of a row that exists already."""

    OVERWRITE = "overwrite"
    CREATE_ONLY = "create_only"
    COALESCE = "coalesce"


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], policies: Mapping[str, Policy], default: Policy = Policy.OVERWRITE) -> DataFrame:
    """The next snapshot. ``new`` has one row per key; columns absent on one side are null there.

    Applying the same rows twice gives the same snapshot, whatever the policies.
    """
    values = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c not in keys]
    o = old.select(*keys, *[F.col(c).alias(f"old_{c}") for c in old.columns if c not in keys], F.lit(True).alias("in_old"))
    n = new.select(*keys, *[F.col(c).alias(f"new_{c}") for c in new.columns if c not in keys], F.lit(True).alias("in_new"))
    both = o.join(n, list(keys), "full")
    out = []
    for c in values:
        before = F.col(f"old_{c}") if c in old.columns else F.lit(None)
        after = F.col(f"new_{c}") if c in new.columns else F.lit(None)
        policy = policies.get(c, default)
        if c not in new.columns:
            kept = before
        elif policy is Policy.OVERWRITE:
            kept = F.when(F.col("in_new"), after).otherwise(before)
        elif policy is Policy.CREATE_ONLY:
            kept = F.when(F.col("in_old"), before).otherwise(after)
        else:
            kept = F.coalesce(after, before)
        out.append(kept.alias(c))
    return both.select(*keys, *out)


def changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows an upsert creates and updates: one row with n_created, n_updated."""
    seen = new.select(*keys).join(old.select(*keys, F.lit(1).alias("hit")), list(keys), "left")
    return seen.agg(F.count_if(F.col("hit").isNull()).alias("n_created"), F.count_if(F.col("hit").isNotNull()).alias("n_updated"))


def broken_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are not unique; a table that keeps its constraint has none."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def last_write(rows: DataFrame, keys: Sequence[str], row_no: str) -> DataFrame:
    """The last row of each key in the order of a materialised row number; a null key is a key of its own."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), row_no).alias("kept")).select(*keys, "kept.*")


def role_edges(tokens: DataFrame) -> DataFrame:
    """Deployed and fee edges of tokens: the fee edge exists only where its wallet is known and is not the deployer
    (compared without case; a null deployer differs from any wallet)."""
    deployer = tokens.where("deployer_address is not null").select(F.col("deployer_address").alias("wallet"), "token_address", "chain_id", F.lit("deployer").alias("role"))
    other = F.col("deployer_address").isNull() | (F.lower("deployer_address") != F.lower("fee_recipient_address"))
    fee = tokens.where(F.col("fee_recipient_address").isNotNull() & other).select(F.col("fee_recipient_address").alias("wallet"), "token_address", "chain_id", F.lit("fee_recipient").alias("role"))
    return deployer.unionByName(fee)
