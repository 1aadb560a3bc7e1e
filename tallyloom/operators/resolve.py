"""Which account owns a wallet: conflict rules, candidate resolution and gap filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.rank import keep_first


def rule_order(rule: str) -> list[Column]:
    return {
        "verified": [F.when(F.col("source") == "verified", 0).otherwise(1), F.when(F.col("is_primary"), 0).otherwise(1), F.col("fid")],
        "score": [F.when(F.col("is_primary"), 0).otherwise(1), F.col("score").desc_nulls_last(), F.col("fid")],
        "lowest": [F.col("fid")],
        "last": [F.col("row_no").desc()],
    }[rule]


def one_account(wallets: DataFrame, rule: str = "verified") -> DataFrame:
    """address, fid: one account per address. Null addresses or accounts own nothing; by the rule ``reduced`` the lowest
    account counts of what the rule ``verified`` leaves."""
    if rule == "reduced":
        return lowest_account(one_account(wallets, "verified"))
    return keep_first(wallets.dropna(subset=["address", "fid"]), ["address"], rule_order(rule)).select("address", "fid")


def lowest_account(wallets: DataFrame) -> DataFrame:
    return wallets.dropna(subset=["address"]).groupBy("address").agg(F.min("fid").alias("fid"))


def attach_account(df: DataFrame, accounts: DataFrame, candidates: Sequence[str], keep_unresolved: bool = False) -> DataFrame:
    """Resolve the first candidate column that is a known wallet: adds ``address`` and ``fid``.

    accounts has one row per address. Unresolved rows are dropped, or kept with their first candidate and no fid.
    """
    out = df
    for i, c in enumerate(candidates):
        out = out.join(accounts.select(F.col("address").alias(f"cand_{i}"), F.col("fid").alias(f"cand_fid_{i}")), F.col(c) == F.col(f"cand_{i}"), "left")
    found = [F.when(F.col(f"cand_fid_{i}").isNotNull(), F.col(f"cand_{i}")) for i in range(len(candidates))]
    first = F.coalesce(*[F.col(c) for c in candidates]) if keep_unresolved else F.lit(None)
    out = out.withColumns({"address": F.coalesce(*found, first), "fid": F.coalesce(*[F.col(f"cand_fid_{i}") for i in range(len(candidates))])})
    out = out.drop(*[f"cand_{i}" for i in range(len(candidates))], *[f"cand_fid_{i}" for i in range(len(candidates))])
    return out if keep_unresolved else out.where(F.col("fid").isNotNull())


def address_union(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sorted distinct addresses of several columns."""
    rows = df.select(F.explode(F.array(*[F.lower(F.col(c)) for c in columns])).alias("address"))
    return rows.where("address is not null").distinct().orderBy("address")


def fill_gaps(known: DataFrame, wanted: DataFrame, remote: DataFrame, key: str, cap: int | None = None) -> DataFrame:
    """Local first: known rows, then remote rows for the wanted keys that are not known, at most ``cap`` of them."""
    rest = wanted.select(key).distinct().join(known, key, "left_anti")
    if cap is not None:
        rest = rest.orderBy(key).limit(cap)
    return known.unionByName(remote.join(rest, key, "left_semi"))


def exact_or_any(listed: DataFrame, registry: DataFrame, key: str, within: str, values: Sequence[str]) -> DataFrame:
    """Enrich listed keys from the registry: the exact (key, within) row, else the first row of the key anywhere."""
    exact = registry.select(key, within, *[F.col(v).alias(f"exact_{v}") for v in values])
    anywhere = keep_first(registry, [key], [F.col(within), *[F.col(v) for v in values]]).select(key, *[F.col(v).alias(f"any_{v}") for v in values])
    out = listed.join(exact, [key, within], "left").join(anywhere, key, "left")
    return out.select(*listed.columns, *[F.coalesce(f"exact_{v}", f"any_{v}").alias(v) for v in values])
