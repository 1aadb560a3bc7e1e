"""Top-1, top-k and ordered de-duplication under a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key in the order; null keys form a group of their own.

    Catalyst limits each group before the shuffle, so a hot key sends at most ``n`` rows per task.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank_no", F.row_number().over(w)).where(F.col("rank_no") <= n).drop("rank_no")


def keep_best(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """The row with the greatest order value of each key, by an aggregate that combines map-side."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("best"))
    return best.select(*keys, "best.*").select(*df.columns)


def with_precedence(parts: Sequence[DataFrame]) -> DataFrame:
    """Union of tables in order of precedence, numbered by ``precedence``; absent columns become null."""
    out = parts[0].withColumn("precedence", F.lit(0))
    for i, p in enumerate(parts[1:], 1):
        out = out.unionByName(p.withColumn("precedence", F.lit(i)), allowMissingColumns=True)
    return out


def budgeted(df: DataFrame, keys: Sequence[str], order: Sequence[Column], budget: int) -> DataFrame:
    """At most ``budget`` rows per key with the number the budget left out."""
    kept = keep_first(df, keys, order, budget)
    totals = df.groupBy(*keys).agg(F.count("*").alias("n_total"))
    return kept.join(totals, list(keys)).withColumn("n_skipped", F.greatest(F.lit(0), F.col("n_total") - budget)).drop("n_total")


def top(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
