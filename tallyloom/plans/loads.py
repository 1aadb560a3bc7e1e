"""The graph load: every table of the contract into node and edge tables, each write under its policies and guards."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.fold import money
from tallyloom.operators.upsert import Policy
from tallyloom.plans.graph import NODES, GraphStep, load
from tallyloom.sources import files
from tallyloom.sources.runs import run_ids

#: The label that each end of an edge has, and what keys an edge beside its ends.
EDGES = {
    "ACCOUNT": ("account", "wallet", ()), "DEPLOYED_CONTRACT": ("wallet", "contract", ("tx_hash",)), "DEPLOYED_TOKEN": ("wallet", "token", ()), "CREATED": ("account", "token", ()),
    "ACTIVE_ON": ("wallet", "chain", ()), "BOUGHT": ("wallet", "token", ("tx_hash",)), "TRADED": ("wallet", "token", ("tx_hash", "side")), "HOLDS": ("wallet", "token", ()),
    "DEPOSITED_IN": ("wallet", "token", ("tx_hash",)), "PROVIDED_LIQUIDITY": ("wallet", "token", ("tx_hash", "event", "pool_address")), "POSTED_ABOUT": ("account", "token", ("cast_hash",)),
    "EVANGELIZED": ("account", "token", ()), "ENGAGED_WITH": ("account", "account", ()), "POSTED_IN": ("account", "channel", ()), "REACTED_IN": ("account", "channel", ()), "USED": ("wallet", "platform", ()),
}


def edge_keys(kind: str) -> list[str]:
    """The key columns of an edge table: those of its ends (``src_`` and ``dst_``) and its own."""
    src, dst, own = EDGES[kind]
    return [*[f"src_{k}" for k in NODES[src]], *[f"dst_{k}" for k in NODES[dst]], *own]


def _value(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hex_low(c: str) -> Column:
    """A wallet's key: hex in lower case, any other spelling as it is."""
    return F.when(F.lower(c).startswith("0x"), F.lower(c)).otherwise(F.col(c))


def select(df: DataFrame, columns: Mapping[str, str | Column], where: Column | None = None) -> DataFrame:
    rows = df if where is None else df.where(where)
    return rows.select(*[_value(c).alias(n) for n, c in columns.items()], *[c for c in ("row_no",) if c in df.columns])


def node(source: str, label: str, keys: Mapping[str, str | Column], values: Mapping[str, str | Column] | None = None, where: Column | None = None, policies: Mapping[str, Policy] | None = None, default: Policy = Policy.OVERWRITE) -> GraphStep:
    """A node write; without values a stub, which exists for an edge and leaves what is there."""
    columns = {**dict(zip(NODES[label], keys.values(), strict=True)), **(values or {})}
    return GraphStep(source, f"nodes_{label}", NODES[label], lambda df: select(df, columns, where), policies or {}, default, stub=values is None)


def edge(source: str, kind: str, src: tuple[str | Column, ...], dst: tuple[str | Column, ...], values: Mapping[str, str | Column], own: tuple[str, ...] = (), where: Column | None = None, policies: Mapping[str, Policy] | None = None, default: Policy = Policy.OVERWRITE) -> list[GraphStep]:
    """The stubs of both ends and the edge between them."""
    a, b, _ = EDGES[kind]
    keys = edge_keys(kind)
    columns = {**dict(zip(keys, (*src, *dst, *own), strict=True)), **values}
    ends = [node(source, label, dict(zip(NODES[label], cols, strict=True)), where=where) for label, cols in ((a, src), (b, dst))]
    return [*ends, GraphStep(source, f"edges_{kind}", keys, lambda df: select(df, columns, where), policies or {}, default)]


def plain(*names: str) -> dict[str, str | Column]:
    return {n: n for n in names}


def account_link(source: str, fid: str = "fid", address: str = "address") -> list[GraphStep]:
    """The account of a wallet where it is known: facts of the link are set on creation only, its owner keeps them."""
    first = {"protocol": F.lit("eth"), "is_primary": F.lit(False), "source": F.lit(source)}
    return edge(source, "ACCOUNT", (fid,), (hex_low(address),), first, where=F.col(fid).isNotNull(), policies=dict.fromkeys(first, Policy.CREATE_ONLY))


def token_keys() -> tuple[Column, str]:
    return F.lower("token_address"), "chain_id"


def linked_wallets() -> list[GraphStep]:
    profile = ("username", "display_name", "neynar_score", "follower_count", "following_count", "registered_at")
    owned = {"is_primary": F.coalesce("is_primary", F.lit(False)), "protocol": F.coalesce("protocol", F.lit("eth")), "source": F.coalesce("source", F.lit("verified"))}
    wallet = node("wallets", "wallet", {"address": hex_low("address")}, {"protocol": F.coalesce("protocol", F.lit("eth"))}, policies={"protocol": Policy.COALESCE})
    return [
        node("accounts", "account", {"fid": "fid"}, {**plain(*profile), "custody_address": F.lower("custody_address")}, policies=dict.fromkeys((*profile, "custody_address"), Policy.COALESCE)),
        wallet, *edge("wallets", "ACCOUNT", ("fid",), (hex_low("address"),), owned),
    ]


def contract_deployers() -> list[GraphStep]:
    made = {"deployed_at": "deployed_at", "method": "deploy_method"}
    contract = node("deployments", "contract", {"address": F.lower("contract_address"), "chain_id": "chain_id"}, {})
    return [contract, *edge("deployments", "DEPLOYED_CONTRACT", (F.lower("deployer_address"),), (F.lower("contract_address"), "chain_id"), made, ("tx_hash",)), *account_link("deployments", address="deployer_address"), *activity("deployer_activity")]


def activity(source: str) -> list[GraphStep]:
    """Activity per wallet and chain: one edge shared by all data types, the last load wins and names itself."""
    seen = {**plain("tx_count", "first_tx_at", "last_tx_at"), "source": F.lit(source)}
    return [*edge(source, "ACTIVE_ON", (F.lower("address"),), ("chain_id",), seen), *account_link(source)]


def miniapp_builders() -> list[GraphStep]:
    flag = node("builder_wallets", "account", {"fid": "fid"}, {"miniapp_builder": F.lit(True)})
    return [flag, *account_link("builder_wallets"), *activity("builder_activity")]


def tokens(api: str, fee_address: str, fee_role: str, facts: tuple[str, ...]) -> list[GraphStep]:
    """Tokens and the wallets and accounts behind them.

    A role's edge exists only where its wallet (or account) is known; the second role's only where it differs from the
    deployer (wallets compared without case, null-safe), so each pair has one edge, the deployer's first.
    """
    kept = dict.fromkeys(facts, Policy.COALESCE)
    made = lambda role: {"role": F.lit(role), **plain("tx_hash", "deployed_at", "platform")}
    wallets = F.col(fee_address).isNotNull() & (F.lower(fee_address) != F.lower(F.coalesce("deployer_address", F.lit(""))))
    accounts = F.col("fee_recipient_fid").isNotNull() & ~F.col("fee_recipient_fid").eqNullSafe(F.col("fid"))
    created = lambda role: {"role": F.lit(role), **plain("platform", "deployed_at")}
    return [
        node(api, "token", dict(zip(NODES["token"], token_keys(), strict=True)), plain(*facts), policies=kept),
        *edge(api, "DEPLOYED_TOKEN", (F.lower("deployer_address"),), token_keys(), made("deployer"), where=F.col("deployer_address").isNotNull()),
        *edge(api, "DEPLOYED_TOKEN", (F.lower(fee_address),), token_keys(), made(fee_role), where=wallets),
        *edge(api, "CREATED", ("fid",), token_keys(), created("deployer"), where=F.col("fid").isNotNull()),
        *edge(api, "CREATED", ("fee_recipient_fid",), token_keys(), created(fee_role), where=accounts),
    ]


def token_volume() -> GraphStep:
    """Daily volumes as totals of the token."""

    def totals(df: DataFrame) -> DataFrame:
        usd = money(F.coalesce("volume_usd", F.lit(0.0))).alias("volume_usd")
        return df.groupBy(F.lower("token_address").alias("address"), "chain_id").agg(F.sum("swap_count").alias("swap_count"), usd, F.min("day").alias("first_day"), F.max("day").alias("last_day"))

    return GraphStep("token_volume", "nodes_token", NODES["token"], totals, required=False)


def token_buyers() -> list[GraphStep]:
    bought = {**plain("token_amount", "platform"), "usd": "amount_usd", "timestamp": "block_time"}
    token = node("buys", "token", dict(zip(NODES["token"], token_keys(), strict=True)), {"platform": "platform"}, policies={"platform": Policy.CREATE_ONLY})
    return [token, *edge("buys", "BOUGHT", (F.lower("buyer_address"),), token_keys(), bought, ("tx_hash",)), *account_link("buys", address="buyer_address")]


def token_evangelists() -> list[GraphStep]:
    copy = {"usd": "amount_usd", "timestamp": "block_time"}
    summary = ("cast_count", "unique_buyers_influenced", "total_purchases", "total_purchase_volume_usd", "attributed_usd")
    return [
        *edge("token_casts", "POSTED_ABOUT", ("author_fid",), token_keys(), plain("timestamp", "matched_on", "likes_count", "recasts_count"), ("cast_hash",)),
        # the purchase belongs to token_buyers: its copy here only fills what is not there
        *edge("attributions", "BOUGHT", (F.lower("buyer_address"),), token_keys(), copy, ("tx_hash",), policies=dict.fromkeys(copy, Policy.CREATE_ONLY)),
        node("attributions", "account", {"fid": "author_fid"}), *account_link("attributions", "buyer_fid", "buyer_address"),
        *edge("evangelist_summary", "EVANGELIZED", ("author_fid",), token_keys(), plain(*summary)),
    ]


def popular_tokens() -> list[GraphStep]:
    vault = (F.lower("vault_address"), "chain_id")
    return [
        *edge("trades", "TRADED", (F.lower("address"),), token_keys(), {"usd": "amount_usd", "token_amount": "token_amount", "timestamp": "block_time"}, ("tx_hash", "side")), *account_link("trades"),
        *edge("holdings", "HOLDS", (F.lower("address"),), token_keys(), plain("balance", "balance_raw", "last_activity_at")), *account_link("holdings"),
        node("vault_deposits", "token", {"address": vault[0], "chain_id": vault[1]}, {"kind": F.lit("vault")}),
        *edge("vault_deposits", "DEPOSITED_IN", (F.lower("address"),), vault, {**plain("assets", "assets_raw", "shares_raw"), "timestamp": "block_time"}, ("tx_hash",)), *account_link("vault_deposits"),
        *edge("lp_events", "PROVIDED_LIQUIDITY", (F.lower("address"),), token_keys(), {**plain("amount0", "amount1"), "timestamp": "block_time"}, ("tx_hash", "event", "pool_address")), *account_link("lp_events"),
    ]


def brand_engagement() -> list[GraphStep]:
    counts = plain("replies", "likes", "recasts", "mentions", "weighted_score", "window_start", "window_end")
    brand = GraphStep("brand_engagement_summary", "nodes_account", NODES["account"], lambda df: df.select(F.col("brand_fid").alias("fid"), F.lit(True).alias("is_brand")), {"is_brand": Policy.CREATE_ONLY}, stub=True)
    return [
        node("brand_engagements", "account", {"fid": "engager_fid"}), node("brand_engagements", "account", {"fid": "brand_fid"}), brand,
        *edge("brand_engagement_summary", "ENGAGED_WITH", ("engager_fid",), ("brand_fid",), counts),
        node("channel_casts", "channel", {"channel_id": "channel_id"}, {}), node("channel_casts", "account", {"fid": "author_fid"}),
        *edge("channel_engagement_summary", "POSTED_IN", ("fid",), ("channel_id",), plain("casts_posted", "first_cast_at", "last_cast_at")),
        *edge("channel_engagement_summary", "REACTED_IN", ("fid",), ("channel_id",), plain("reactions_given", "reactions_received", "replies_received")),
    ]


def exchange_activity(platform: str = "hyperliquid") -> list[GraphStep]:
    """Active wallets use the platform; checked ones without activity are only stamped as such (a null flag is none)."""
    active = F.coalesce("has_hl_activity", F.lit(False))
    stamped = node("hl_activity", "wallet", {"address": F.lower("address")}, {"checked_at": "checked_at", "is_active": active})
    used = {"volume_usd": "cum_volume_usd", **plain("first_activity_at", "ledger_event_count", "checked_at")}
    link = [GraphStep(s.source, s.target, s.keys, lambda df, s=s: s.build(df.where(active)), s.policies, s.default, s.required, s.stub) for s in account_link("hl_activity")]
    return [stamped, *edge("hl_activity", "USED", (F.lower("address"),), (F.lit(platform),), used, where=active), *link]


#: The steps of each data type; a data type is loaded as a whole.
LOADS: dict[str, Callable[[], list[GraphStep]]] = {
    "linked_wallets": linked_wallets,
    "contract_deployers": contract_deployers,
    "miniapp_builders": miniapp_builders,
    "clanker_tokens": lambda: tokens("tokens", "admin_address", "admin", ("platform", "name", "symbol", "deployed_at", "pool_address", "token_type")),
    "bankr_tokens": lambda: [*tokens("tokens", "fee_recipient_address", "fee_recipient", ("platform", "name", "symbol", "deployed_at", "pool_address", "launch_type")), token_volume()],
    "token_buyers": token_buyers,
    "token_evangelists": token_evangelists,
    "popular_tokens": popular_tokens,
    "brand_engagement": brand_engagement,
    "hyperliquid_activity": exchange_activity,
}


def current(graph_root: str) -> dict[str, str]:
    """Where the newest state of each node and edge table lies; nothing before the first load."""
    path = f"{graph_root}/current.json"
    return json.loads(files.read_text(path)) if files.exists(path) else {}


def load_run(spark: SparkSession, root: str, data_type: str, graph_root: str, run: str | None = None, ingested_by: str = "tallyloom", dry: bool = False) -> list[dict]:
    """Load a sealed run (the latest by default) of a data type into the graph: target, created and updated rows per write.

    The next state of every table is written whole beside the old one; one small file then points to all new states at
    once, so readers see the graph before the load or after it, and a load that breaks off or is repeated changes nothing.
    """
    sealed = run_ids(root, data_type)
    name = run or (sealed[-1] if sealed else None)
    if name not in sealed:
        raise FileNotFoundError(f"{data_type}: no sealed run {name or ''}".rstrip())
    base = f"{root}/{data_type}/{name}"
    manifest = json.loads(files.read_text(f"{base}/manifest.json"))
    sources = {t: spark.read.parquet(f"{base}/{t}") for t in manifest["files"] if files.exists(f"{base}/{t}")}
    places = current(graph_root)
    graph = {target: spark.read.parquet(path) for target, path in places.items()}
    stamp = {"as_of": manifest["run_ts"], "ingested_by": ingested_by}
    report = []
    for target, (rows, counters) in load(LOADS[data_type.removesuffix("_activity") if data_type not in LOADS else data_type](), sources, graph, stamp, list(manifest["files"])).items():
        n_created, n_updated = counters.first()
        report.append({"target": target, "created": n_created, "updated": n_updated})
        if not dry:
            places[target] = f"{graph_root}/{data_type}-{name}-{uuid.uuid4().hex[:8]}/{target}"
            rows.write.parquet(places[target])
    if not dry:
        files.write_text(f"{graph_root}/current.json", json.dumps(places, indent=1))
    return report
