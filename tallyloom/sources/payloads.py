"""Nested payloads of social and launchpad interfaces into flat tables by explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import address, blank_to_null, number, whole
from tallyloom.operators.rank import keep_first

USER = """fid bigint, username string, display_name string, follower_count bigint, following_count bigint, score double, custody_address string,
verified_addresses struct<eth_addresses: array<string>, sol_addresses: array<string>, primary: struct<eth_address: string, sol_address: string>>"""
LAUNCH = """tokenAddress string, tokenName string, tokenSymbol string, chain string, timestamp bigint, txHash string, poolId string, launchType string, status string,
deployer struct<walletAddress: string, xUsername: string>, feeRecipient struct<walletAddress: string>"""
CAST = "hash string, parent_hash string, parent_url string, root_parent_url string, text string, timestamp string, author struct<fid: bigint, username: string>, reactions struct<likes_count: bigint, recasts_count: bigint>"


def user_wallets(users: DataFrame) -> DataFrame:
    """fid, address, protocol, is_primary, source: verified addresses of both protocols, then the custody address.

    Addresses are compared without case for hex and with case for base58; a verified address beats the custody one.
    """

    def verified(list_: str, protocol: str, primary: str) -> Column:
        same = lambda a: a if protocol == "sol" else F.lower(a)
        own = F.col(f"verified_addresses.primary.{primary}")
        return F.transform(
            F.coalesce(F.col(f"verified_addresses.{list_}"), F.array().cast("array<string>")),
            lambda a: F.struct(same(a).alias("address"), F.lit(protocol).alias("protocol"), F.coalesce(same(a) == same(own), F.lit(False)).alias("is_primary"), F.lit("verified").alias("source")),
        )

    custody = F.array(F.struct(address("custody_address").alias("address"), F.lit("eth").alias("protocol"), F.lit(False).alias("is_primary"), F.lit("custody").alias("source")))
    rows = users.select("fid", F.inline(F.concat(verified("eth_addresses", "eth", "eth_address"), verified("sol_addresses", "sol", "sol_address"), custody)))
    return keep_first(rows.where("address is not null and address <> ''"), ["fid", "address", "protocol"], [F.desc("source"), F.desc("is_primary")])


def user_profiles(users: DataFrame) -> DataFrame:
    return users.select("fid", "username", "display_name", F.col("score").alias("neynar_score"), "follower_count", "following_count", address("custody_address").alias("custody_address"))


def hex_wallets(users: DataFrame) -> DataFrame:
    """Every hex address of a user, whatever its spelling: fid, address."""
    lists = F.concat(F.coalesce("verified_addresses.eth_addresses", F.array().cast("array<string>")), F.array("custody_address", "verified_addresses.primary.eth_address"))
    return users.select("fid", F.explode(F.array_distinct(F.transform(lists, lambda a: F.lower(a)))).alias("address")).where(F.startswith("address", F.lit("0x")))


def direct_replies(conversations: DataFrame, payload: str) -> DataFrame:
    """parent_hash and the replies of the first level under each post, as posts; deeper ones and broken payloads give
    no row."""
    shape = f"struct<conversation: struct<cast: struct<hash: string, direct_replies: array<struct<{_fields(CAST)}>>>>>"
    post = F.from_json(payload, shape)["conversation"]["cast"]
    rows = conversations.select(post["hash"].alias("under"), F.inline(post["direct_replies"]))
    return rows.where("hash is not null").withColumn("parent_hash", F.coalesce("parent_hash", "under")).drop("under")


def channel_casts(posts: DataFrame, channel: str) -> DataFrame:
    """Posts of a channel as rows of the contract; the length of a text is its number of characters."""
    return posts.select(
        F.lower("hash").alias("cast_hash"), F.col("author.fid").alias("author_fid"), F.lit(channel).alias("channel_id"), F.col("timestamp").try_cast("timestamp").alias("timestamp"),
        F.lower(blank_to_null("parent_hash")).alias("parent_hash"), F.coalesce("reactions.likes_count", F.lit(0)).alias("likes_count"), F.coalesce("reactions.recasts_count", F.lit(0)).alias("recasts_count"), F.length("text").cast("bigint").alias("text_length"),
    ).where("cast_hash is not null").dropDuplicates(["cast_hash"])


def launch_rows(pages: DataFrame, payload: str, chain_ids: dict[str, int]) -> DataFrame:
    """Launches of well-formed pages as token rows; unknown chains are left out, empty texts become null."""
    items = pages.select(F.inline(F.from_json(payload, f"struct<launches: array<struct<{_fields(LAUNCH)}>>>")["launches"]))
    chain = F.lit(None).cast("bigint")
    for name, i in chain_ids.items():
        chain = F.when(F.lower("chain") == name, F.lit(i)).otherwise(chain)
    rows = items.select(
        address("tokenAddress").alias("token_address"), chain.cast("bigint").alias("chain_id"), F.lit("bankr").alias("platform"), blank_to_null(address("deployer.walletAddress")).alias("deployer_address"),
        blank_to_null(address("feeRecipient.walletAddress")).alias("fee_recipient_address"), blank_to_null("tokenName").alias("name"), blank_to_null("tokenSymbol").alias("symbol"),
        F.timestamp_millis("timestamp").alias("deployed_at"), blank_to_null("txHash").alias("tx_hash"), blank_to_null("poolId").alias("pool_address"), "launchType", "status",
    )
    return rows.where("chain_id is not null and token_address is not null")


def launchpad_rows(items: DataFrame) -> DataFrame:
    """Launchpad items with JSON in ``related`` and ``pool_config`` as token rows; the time falls back to created_at."""
    related = F.from_json("related", "user struct<fid: string, username: string>, market struct<marketCap: double, volume24h: double>")
    pool = F.from_json("pool_config", "pairedToken string")
    return items.select(
        address("contract_address").alias("token_address"), "chain_id", F.lit("clanker").alias("platform"), blank_to_null("name").alias("name"), blank_to_null("symbol").alias("symbol"),
        whole(related["user"]["fid"]).alias("fid"), related["user"]["username"].alias("username"), related["market"]["marketCap"].alias("market_cap_usd"),
        related["market"]["volume24h"].alias("volume_24h_usd"), blank_to_null(address(pool["pairedToken"])).alias("paired_token"), F.col("created_at").try_cast("timestamp").alias("deployed_at"),
    )


def exchange_activity(payloads: DataFrame) -> DataFrame:
    """address, volume (junk is 0), first activity and number of ledger events from two recorded answers per wallet."""
    ledger = F.from_json("ledger", "array<struct<time: bigint, hash: string, delta: struct<type: string, usdc: string>>>")
    first = F.array_min(F.transform(ledger, lambda x: x["time"]))
    volume = F.coalesce(number(F.get_json_object("rate", "$.cumVlm")), F.lit(0.0))
    return payloads.select("address", volume.alias("cum_volume_usd"), F.timestamp_millis(first).alias("first_activity_at"), F.coalesce(F.size(ledger), F.lit(0)).alias("ledger_event_count"))


def _fields(ddl: str) -> str:
    """A DDL column list as the fields of a struct type."""
    out, depth, token = [], 0, ""
    for ch in ddl.replace("\n", " ") + ",":
        depth += ch == "<"
        depth -= ch == ">"
        if ch == "," and not depth:
            name, _, kind = token.strip().partition(" ")
            out.append(f"{name.rstrip(':')}: {kind.strip()}")
            token = ""
        else:
            token += ch
    return ", ".join(out)
