"""The data products: pure, lazy functions of tables. Each result is ready for its contract and one write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import uint256
from tallyloom.functions.text import address, valid_address
from tallyloom.operators import decode, features, fold, match, pivot, rank, registry, resolve
from tallyloom.session import sized
from tallyloom.sources import payloads

FLOOR_USD = 50.0
ATTRIBUTION_DAYS = 5


def wallet_map(accounts: DataFrame) -> DataFrame:
    """One account per custody address: the best score, then the lowest account."""
    rows = accounts.select(valid_address("custody_address").alias("address"), "fid", F.col("neynar_score").alias("score"), F.lit(True).alias("is_primary"), F.lit("custody").alias("source"))
    return resolve.one_account(rows, "score")


def linked_wallets(users: DataFrame) -> dict[str, DataFrame]:
    return {"wallets": payloads.user_wallets(users), "accounts": payloads.user_profiles(users)}


def contract_deployers(deployments: DataFrame, activity: DataFrame, wallets: DataFrame) -> dict[str, DataFrame]:
    """Deployments by known wallets, once per (contract, transaction), and the activity of the deployers.

    deployments: deployer_address, contract_address, chain_id, tx_hash, at, row_no. activity: address, chain_id, at.
    """
    rows = deployments.withColumns({"deployer": address("deployer_address"), "contract": address("contract_address"), "tx": F.lower("tx_hash")})
    known = resolve.attach_account(rows.drop("fid"), wallets, ["deployer"]).select("fid", "deployer", "contract", "chain_id", "tx", "at", "row_no")
    deployed = rank.keep_first(known, ["contract", "tx"], [F.asc("row_no")]).drop("row_no")
    mine = activity.join(deployed.select(F.col("deployer").alias("address")).distinct(), "address", "left_semi")
    rolled = registry.roll_up(mine, ["address", "chain_id"], "at").join(wallets, "address")
    return {"deployments": deployed, "deployer_activity": rolled}


def builder_activity(seeds: DataFrame, wallets: DataFrame, activity: DataFrame) -> dict[str, DataFrame]:
    """Wallets of seeded accounts and their activity; a wallet of two accounts counts for both."""
    own = wallets.join(seeds.select("fid").distinct(), "fid", "left_semi").select("fid", "address").distinct()
    rolled = registry.roll_up(activity.join(own.select("address").distinct(), "address", "left_semi"), ["address", "chain_id"], "at")
    return {"builder_wallets": own, "builder_activity": rolled.join(own, "address")}


def brand_engagement(engagements: DataFrame, brands: DataFrame, posts: DataFrame, reactions: DataFrame) -> dict[str, DataFrame]:
    events = features.distinct_events(engagements.where("engager_fid <> brand_fid"), "engager_fid", "engagement", ("brand_fid", "cast_hash", "target_cast_hash"), "engaged_at", "weight")
    named = events.select(F.col("entity").alias("engager_fid"), F.col("same_0").cast("bigint").alias("brand_fid"), F.col("kind").alias("engagement_type"), F.col("same_1").alias("cast_hash"), F.col("same_2").alias("target_cast_hash"), F.col("at").alias("timestamp"))
    weights = brands.select(F.col("fid").alias("brand_fid"), "weight")
    summary = pivot.weighted_pivot(named.join(sized(weights), "brand_fid"), ["engager_fid", "brand_fid"], "engagement_type", "weight")
    return {"brand_engagements": named, "brand_engagement_summary": summary, "channel_engagement_summary": pivot.channel_summary(posts, reactions, "channel_id", "author_fid")}


def launch_tokens(api: DataFrame, chain: DataFrame | None, wallets: DataFrame, row_no: str) -> DataFrame:
    """Newest row per token of a launchpad, merged with the chain's registry, with the accounts of both roles."""
    newest = rank.keep_first(api, ["token_address", "chain_id"], [F.desc_nulls_last("deployed_at"), F.asc(row_no)]).drop(row_no)
    merged = newest if chain is None else registry.merge_prefer_left(chain, newest, ["token_address", "chain_id"], ["name", "symbol", "fee_recipient_address"])
    by = lambda c: wallets.select(F.col("address").alias(c), F.col("fid").alias(f"{c}_fid"))
    both = merged.drop("fid", "fee_recipient_fid").join(by("deployer_address"), "deployer_address", "left").join(by("fee_recipient_address"), "fee_recipient_address", "left")
    return both.withColumnsRenamed({"deployer_address_fid": "fid", "fee_recipient_address_fid": "fee_recipient_fid"})


def token_buyers(trades: DataFrame, registries: list[DataFrame], wallets: DataFrame, since: Column | None = None, floor: float = FLOOR_USD) -> DataFrame:
    """Purchases of registered tokens by known wallets: legs over the floor, folded per transaction.

    The floor applies to each leg before folding, so unpriced legs and legs below it are no part of a purchase.
    trades: taker, tx_from, token_address, chain_id, amount_usd, token_amount, block_time, tx_hash.
    """
    tokens = rank.keep_first(rank.with_precedence(registries), ["token_address", "chain_id"], [F.asc("precedence"), F.asc("platform")]).select("token_address", "chain_id", "platform")
    legs = trades.where(F.col("amount_usd") >= floor)
    if since is not None:
        legs = legs.where(F.col("block_time") >= since)
    mine = resolve.attach_account(legs.join(tokens, ["token_address", "chain_id"]), wallets, ["taker", "tx_from"])
    keys = ["fid", "address", "token_address", "chain_id", "platform", "tx_hash"]
    return fold.fold_legs(mine, keys, ["amount_usd", "token_amount"]).withColumnRenamed("address", "buyer_address").drop("n_legs")


def popular_trades(trades: DataFrame, index: DataFrame, wallets: DataFrame, floor: float = FLOOR_USD) -> DataFrame:
    """Trades of index tokens by known wallets, folded per address, token, transaction and side."""
    legs = trades.where(F.col("amount_usd") >= floor).join(sized(index.select("token_address", "chain_id").distinct()), ["token_address", "chain_id"], "left_semi")
    mine = resolve.attach_account(legs.drop("address", "fid"), wallets, ["taker", "tx_from"])
    return fold.fold_legs(mine, ["fid", "address", "token_address", "chain_id", "side", "tx_hash"], ["amount_usd", "token_amount"]).drop("n_legs")


def holdings(transfers: DataFrame, index: DataFrame, wallets: DataFrame, decimals: DataFrame) -> DataFrame:
    """Balances of index tokens held by known wallets: exact sums over all history, credits less debits, above zero.

    transfers: token, sender, receiver, value (decimal text), at. decimals: token, decimals. The scaled balance is a
    rounded view; the raw one is exact.
    """
    moves = transfers.join(sized(index.select(F.col("token_address").alias("token")).distinct()), "token", "left_semi")
    exact = fold.net_balances_exact(moves).where(~F.startswith("balance_raw", F.lit("-")) & (F.col("balance_raw") != "0"))
    seen = moves.select("token", F.explode(F.array("sender", "receiver")).alias("holder"), "at").groupBy("token", "holder").agg(F.max("at").alias("last_activity_at"))
    held = exact.join(seen, ["token", "holder"]).join(decimals.select("token", "decimals"), "token", "left")
    known = resolve.attach_account(held, wallets, ["holder"])
    return known.select("fid", "address", F.col("token").alias("token_address"), uint256.as_double(F.col("balance_raw"), F.coalesce("decimals", F.lit(18))).alias("balance"), "balance_raw", "last_activity_at")


def vault_deposits(logs: DataFrame, vaults: DataFrame, wallets: DataFrame) -> DataFrame:
    """Deposits into listed vaults by known wallets (owner, else sender), folded per wallet, vault and transaction.

    logs: contract_address, topic1, topic2, data, tx_hash, block_time. vaults: vault_address, decimals.
    """
    listed = sized(vaults.select(F.col("vault_address").alias("contract_address"), "decimals"))
    decoded = decode.deposits(logs.join(listed, "contract_address"))
    mine = resolve.attach_account(decoded, wallets, ["owner", "sender"]).withColumns({"vault_address": F.col("contract_address"), "wide_assets": uint256.padded("assets_raw"), "wide_shares": uint256.padded("shares_raw")})
    folded = mine.groupBy("fid", "address", "vault_address", "tx_hash").agg(
        uint256.sum_padded(F.col("wide_assets")).alias("assets_raw"), uint256.sum_padded(F.col("wide_shares")).alias("shares_raw"), F.max("decimals").alias("decimals"), F.min("block_time").alias("block_time")
    )
    return folded.withColumn("assets", uint256.as_double(F.col("assets_raw"), F.coalesce("decimals", F.lit(18)))).drop("decimals")


def lp_events(events: DataFrame, pools: DataFrame, index: DataFrame, decimals: DataFrame, wallets: DataFrame) -> DataFrame:
    """Liquidity events of pools that hold an index token, one row per index token, by known wallets.

    events: pool, event, actor, amount0, amount1, tx_hash, block_time. pools: pool, token0, token1. Amounts are scaled
    by the decimals of their token; events of one transaction, pool and kind are summed.
    """
    listed = registry.with_decimals(pools, decimals)
    rows = events.join(listed, "pool").withColumns({f"amount{i}": F.col(f"amount{i}") / F.pow(F.lit(10.0), F.col(f"decimals{i}")) for i in (0, 1)})
    fanned = registry.fan_out_index(rows, index.select(F.col("token_address").alias("token")))
    mine = resolve.attach_account(fanned, wallets, ["actor"])
    return mine.groupBy("fid", "address", "pool", "token", "event", "tx_hash").agg(*[F.round(fold.money(f"amount{i}"), 4).alias(f"amount{i}") for i in (0, 1)], F.min("block_time").alias("block_time"))


def launches(logs: DataFrame, creations: DataFrame, ops: DataFrame, fees: DataFrame, transactions: DataFrame) -> DataFrame:
    """The launch registry of a chain out of its logs.

    creations: token, tx. logs: tx, contract, idx; the first log of a created token in its own transaction dates the
    launch. ops: tx, op_index, launcher; the launcher is that of the next operation. fees: topic (the token, padded),
    data (pairs of beneficiary and share); the greatest share takes the fee. transactions: tx, sender.
    """
    own = logs.withColumnRenamed("contract", "token").join(creations, ["tx", "token"]).groupBy("tx", "token").agg(F.min("idx").alias("first_index"))
    matched = match.nearest_forward(own, ops, "tx", "first_index", "op_index", ["launcher"]).select("token", "launcher")
    shares = decode.address_shares(fees.withColumn("token", decode.word_address(F.col("topic"), 1)), "data")
    best = rank.keep_first(shares, ["token"], [F.desc("share_hex"), F.asc("pair_no")]).select("token", F.col("beneficiary").alias("fee_recipient"))
    return registry.registry(creations, matched, best, transactions, "token", "tx")


def token_evangelists(casts: DataFrame, buys: DataFrame, engagements: DataFrame) -> dict[str, DataFrame]:
    """Casts per token, purchases split among the authors engaged with, and the summary per author.

    casts: token_address, chain_id, author, cast. buys: token_address, chain_id, buyer, purchase, bought_at, usd.
    engagements: token_address, chain_id, buyer, author, engaged_at. A cast's own author counts as engaged.
    """
    keys = ["token_address", "chain_id"]
    split = match.attribute(buys, engagements, [*keys, "buyer"], ATTRIBUTION_DAYS)
    return {"token_casts": casts.dropDuplicates([*keys, "author", "cast"]), "attributions": split, "evangelist_summary": match.author_summary(split, casts, keys)}


def arb_cohort(sources: list[DataFrame], profiles: DataFrame, wallets: DataFrame, max_priority: int | None = None, min_score: float | None = None, limit: int | None = None) -> DataFrame:
    """The cohort of all sources with accounts from the wallet map where none is known, and scores."""
    rows = sources[0]
    for s in sources[1:]:
        rows = rows.unionByName(s)
    base = pivot.cohort(rows).join(wallets.select("address", F.col("fid").alias("map_fid")), "address", "left").withColumn("fid", F.coalesce("fid", "map_fid")).drop("map_fid")
    scores = profiles.where("fid is not null").groupBy("fid").agg(F.max("neynar_score").alias("score"))
    return pivot.gate(base.join(scores, "fid", "left"), max_priority, min_score, limit)


def exchange_activity(targets: DataFrame, answers: DataFrame, done: DataFrame, prior: DataFrame, since: Column) -> DataFrame:
    """Activity per cohort wallet: fresh answers for what is fetched, prior rows carried forward where still fresh."""
    plan = registry.freshness(targets, done, prior, "address", since)
    fetched = plan.where("plan = 'fetch'").select("address", "fid").join(payloads.exchange_activity(answers), "address").withColumn("checked_at", F.current_timestamp())
    carried = plan.where("plan = 'carry'").select("address", "fid").join(prior.drop("fid"), "address")
    columns = ["address", "fid", "cum_volume_usd", "first_activity_at", "ledger_event_count", "checked_at"]
    out = fetched.select(*columns).unionByName(carried.select(*columns))
    return out.withColumn("has_hl_activity", (F.col("cum_volume_usd") > 0) | (F.col("ledger_event_count") > 0))
