"""Legs into purchases, two-sided trades, volumes and net balances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import uint256
from tallyloom.functions.stages import settled

MONEY = "decimal(38,4)"


def money(c: Column | str) -> Column:
    """Exact sum of money, as a double at the end."""
    return F.sum((F.col(c) if isinstance(c, str) else c).cast("decimal(28,4)")).cast("double")


def fold_legs(df: DataFrame, keys: Sequence[str], sums: Sequence[str], at: str = "block_time") -> DataFrame:
    """One purchase per key: sums of its legs, the earliest time and the number of legs. Null keys are kept."""
    return df.groupBy(*keys).agg(*[money(c).alias(c) for c in sums], F.min(at).alias(at), F.count("*").alias("n_legs"))


def collapse(df: DataFrame, keys: Sequence[str], sums: Sequence[str] = (), exact: Sequence[str] = (), first: Sequence[str] = (), order: Column | None = None) -> DataFrame:
    """Fold rows with complete keys: sums, exact sums of integers of any length as text, and the first of others."""
    if exact:
        df = settled(df, {f"wide_{c}": uint256.padded(c) for c in exact})
    aggs = [money(c).alias(c) for c in sums] + [uint256.sum_padded(F.col(f"wide_{c}")).alias(c) for c in exact]
    aggs += [F.min_by(c, order if order is not None else F.col(c)).alias(c) for c in first]
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(*aggs)


def two_sides(df: DataFrame, bought: Sequence[str], sold: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One scan, two rows per trade: ``side`` buy and sell with the columns of that side under common names."""
    sides = [F.struct(F.lit(s).alias("side"), *[F.col(c).alias(n) for c, n in zip(cols, names, strict=True)]) for s, cols in (("buy", bought), ("sell", sold))]
    rest = [c for c in df.columns if c not in {*bought, *sold}]
    return df.select(*rest, F.inline(F.array(*sides)))


def member_of_any(df: DataFrame, columns: Sequence[str], keys: DataFrame, key: str, row: Sequence[str]) -> DataFrame:
    """Rows of which any column is among the keys, once each, by one semi-join over the candidates."""
    marks = df.select(*row, F.explode(F.array_distinct(F.array(*columns))).alias(key)).join(keys.select(key).distinct(), key, "left_semi")
    return df.join(marks.select(*row).distinct(), list(row), "left_semi")


def volume_one_scan(df: DataFrame, tokens: DataFrame) -> DataFrame:
    """Volume per token in one scan: a trade between two listed tokens counts for the bought side only."""
    marks = tokens.select(F.col("token").alias("mark"))
    b = df.join(marks.withColumnRenamed("mark", "bought_mark"), F.col("bought") == F.col("bought_mark"), "left")
    b = b.join(marks.withColumnRenamed("mark", "sold_mark"), F.col("sold") == F.col("sold_mark"), "left")
    b = b.withColumn("token", F.coalesce("bought_mark", "sold_mark")).where("token is not null")
    is_buy = F.col("bought_mark").isNotNull()
    return b.groupBy("token").agg(
        F.coalesce(money(F.when(is_buy, F.col("usd"))), F.lit(0.0)).alias("buy_usd"),
        F.coalesce(money(F.when(~is_buy, F.col("usd"))), F.lit(0.0)).alias("sell_usd"),
        money("usd").alias("volume_usd"), F.countDistinct("taker").alias("n_takers"), F.count("*").alias("n_trades"),
    )


def volume_two_sided(df: DataFrame, tokens: DataFrame) -> DataFrame:
    """Volume per token where a trade counts for both of its tokens."""
    rows = two_sides(df, ["bought"], ["sold"], ["token"]).join(tokens.select("token"), "token", "left_semi")
    return rows.groupBy("token").agg(money("usd").alias("volume_usd"), F.countDistinct("taker").alias("n_takers"), F.count("*").alias("n_trades"))


def net_balances(transfers: DataFrame, minimum: int, since: Column | None = None) -> DataFrame:
    """Balance per (token, holder): credits less debits over all history, kept above a minimum.

    ``since`` keeps holders whose last movement is not older; it filters after the sum, since earlier movements are
    part of the balance. transfers: token, sender, receiver, value, at.
    """
    moves = two_sides(transfers.withColumn("minus", -F.col("value")), ["receiver", "value"], ["sender", "minus"], ["holder", "delta"])
    out = moves.dropna(subset=["holder"]).groupBy("token", "holder").agg(F.sum("delta").alias("balance"), F.max("at").alias("last_at"))
    out = out.where(F.col("balance") > minimum)
    return out if since is None else out.where(F.col("last_at") >= since)


def net_balances_exact(transfers: DataFrame) -> DataFrame:
    """The same with 256-bit values as text: token, holder, balance_raw (signed text). Values that are no unsigned
    integers move nothing; null holders are left out."""
    moves = settled(transfers.select("token", "sender", "receiver", "value"), {"wide": uint256.padded("value")})
    sides = two_sides(moves.withColumns({"up": F.lit(1), "down": F.lit(-1)}), ["receiver", "up"], ["sender", "down"], ["holder", "sign"])
    total = uint256.sum_padded(F.col("wide"), F.col("sign"))
    return sides.dropna(subset=["holder"]).groupBy("token", "holder").agg(F.coalesce(total, F.lit("0")).alias("balance_raw"))


def daily_volume(swaps: DataFrame, prices: DataFrame) -> DataFrame:
    """Swaps per token and day priced in two levels: per (token, day, numeraire), then per (token, day).

    Legs without a price count as swaps and add nothing to the priced volume, which is null if none is priced.
    """
    legs = swaps.groupBy("token", "day", "numeraire").agg(F.count("*").alias("n"), F.sum(F.abs("amount").cast("decimal(28,4)")).alias("native"))
    priced = legs.join(prices, ["numeraire", "day"], "left")
    usd = F.sum(F.col("native").cast("decimal(18,4)") * F.col("price").cast("decimal(14,4)")).cast("double")
    return priced.groupBy("token", "day").agg(F.sum("n").alias("swap_count"), F.sum("native").cast("double").alias("volume_native"), usd.alias("volume_usd"))


def day_totals(daily: DataFrame) -> DataFrame:
    return daily.groupBy("token").agg(F.sum("swap_count").alias("swap_count"), money(F.coalesce("volume_usd", F.lit(0.0))).alias("volume_usd"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))
