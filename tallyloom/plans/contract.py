"""The output contract: 23 tables with their columns in order, and the types their names stand for."""

from __future__ import annotations

# ---- fixed values: tables of the contract by data type, each "column type" in the order of the contract ----
_ACTIVITY = "fid bigint, address address, chain_id bigint, tx_count bigint, first_tx_at timestamp, last_tx_at timestamp"
TABLES = {
    "linked_wallets": {
        "wallets": "fid bigint, address address, protocol string, is_primary boolean, source string",
        "accounts": "fid bigint, username string, display_name string, neynar_score double, follower_count bigint, following_count bigint, custody_address address, registered_at timestamp",
    },
    "contract_deployers": {
        "deployments": "fid bigint, deployer_address address, contract_address address, chain_id bigint, deployed_at timestamp, tx_hash hash, deploy_method string",
        "deployer_activity": _ACTIVITY,
    },
    "miniapp_builders_activity": {"builder_wallets": "fid bigint, address address", "builder_activity": _ACTIVITY},
    "brand_engagement": {
        "brand_engagements": "engager_fid bigint, brand_fid bigint, engagement_type string, cast_hash hash, target_cast_hash hash, timestamp timestamp",
        "brand_engagement_summary": "engager_fid bigint, brand_fid bigint, replies bigint, likes bigint, recasts bigint, mentions bigint, weighted_score double, window_start timestamp, window_end timestamp",
        "channel_casts": "cast_hash hash, author_fid bigint, channel_id string, timestamp timestamp, parent_hash hash, likes_count bigint, recasts_count bigint, replies_count bigint, text_length bigint",
        "channel_engagement_summary": "fid bigint, channel_id string, casts_posted bigint, reactions_received bigint, replies_received bigint, reactions_given bigint, first_cast_at timestamp, last_cast_at timestamp",
    },
    "clanker_tokens": {
        "tokens": "token_address address, chain_id bigint, platform string, deployer_address address, admin_address address, fid bigint, fee_recipient_fid bigint, username string, name string, symbol string, deployed_at timestamp, tx_hash hash, pool_address address, paired_token address, token_type string, starting_market_cap_usd double, price_usd double, market_cap_usd double, volume_24h_usd double",
    },
    "bankr_tokens": {
        "tokens": "token_address address, chain_id bigint, platform string, deployer_address address, fee_recipient_address address, fid bigint, fee_recipient_fid bigint, name string, symbol string, deployed_at timestamp, tx_hash hash, pool_address address, launch_type string, source string",
        "token_volume": "token_address address, chain_id bigint, day timestamp, swap_count bigint, volume_native double, volume_usd double",
    },
    "token_buyers": {"buys": "fid bigint, buyer_address address, token_address address, chain_id bigint, platform string, amount_usd double, token_amount double, block_time timestamp, tx_hash hash"},
    "token_evangelists": {
        "token_casts": "token_address address, chain_id bigint, cast_hash hash, author_fid bigint, timestamp timestamp, matched_on string, likes_count bigint, recasts_count bigint",
        "attributions": "token_address address, chain_id bigint, author_fid bigint, buyer_fid bigint, buyer_address address, tx_hash hash, amount_usd double, block_time timestamp, attributed_usd double, n_influencers bigint",
        "evangelist_summary": "token_address address, chain_id bigint, author_fid bigint, cast_count bigint, unique_buyers_influenced bigint, total_purchases bigint, total_purchase_volume_usd double, attributed_usd double",
    },
    "popular_tokens": {
        "trades": "fid bigint, address address, token_address address, chain_id bigint, side string, amount_usd double, token_amount double, block_time timestamp, tx_hash hash",
        "holdings": "fid bigint, address address, token_address address, chain_id bigint, balance double, balance_raw string, last_activity_at timestamp",
        "vault_deposits": "fid bigint, address address, vault_address address, chain_id bigint, assets double, assets_raw string, shares_raw string, block_time timestamp, tx_hash hash",
        "lp_events": "fid bigint, address address, pool_address address, token_address address, chain_id bigint, event string, amount0 double, amount1 double, block_time timestamp, tx_hash hash",
    },
    "arb_cohort": {"cohort": "address address, fid bigint, sources string, priority bigint, neynar_score double"},
    "hyperliquid_activity": {"hl_activity": "address address, fid bigint, has_hl_activity boolean, cum_volume_usd double, first_activity_at timestamp, ledger_event_count bigint, checked_at timestamp"},
}
#: Names that inputs use beside those of the contract.
_OTHERS = "replies bigint, likes bigint, recasts bigint, mentions bigint, reactions_given bigint, weight double, assets double, cum_volume_usd double"
# ---- end of fixed values ----


def fields(columns: str) -> dict[str, str]:
    return dict(c.split(" ") for c in columns.split(", "))


#: Each column of any table by the kind its name stands for; what is in none is text.
KINDS = {name: kind for tables in TABLES.values() for columns in tables.values() for name, kind in fields(columns).items()} | fields(_OTHERS)


def schema(data_type: str, table: str) -> dict[str, str]:
    """Spark types of a table's columns in order; addresses and hashes are text."""
    return {c: "string" if k in ("address", "hash") else k for c, k in fields(TABLES[data_type][table]).items()}


def kinds(data_type: str, table: str) -> dict[str, str]:
    return fields(TABLES[data_type][table])
