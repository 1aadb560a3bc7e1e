"""The graph load over the driver's tables: a query per node label and relationship, each with its DuckDB statement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import address, valid_address
from tallyloom.operators.fold import money
from tallyloom.plans.graph import NODES, load
from tallyloom.plans.loads import LOADS, edge_keys
from tallyloom.queries import reference
from tallyloom.queries.views import A, plain, plain_sql
from tallyloom.session import table

QUERIES = {}
SQL = {}
STAMP = {"as_of": "2026-01-01", "ingested_by": "load"}


def query(sql: str, times: tuple[str, ...] = ()):
    def add(f):
        QUERIES[f.__name__] = lambda spark, d: plain(f(spark, d).drop(*STAMP))
        SQL[f.__name__] = plain_sql(sql, times)
        return f

    return add


# ---------------------------------------------------------------- contract tables out of the driver's tables


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    names = ("chain_id", "platform", "fid", "fee_recipient_fid", "name", "symbol", "deployed_at", "launch_type", "pool_address")
    return table(spark, d, "tokens").select(*names, address("token_address").alias("token_address"), address("deployer_address").alias("deployer_address"), valid_address("fee_recipient_address").alias("fee_recipient_address"), F.lower("tx_hash").alias("tx_hash"), F.col("token_row_id").alias("row_no"))


_TOKENS = f"tk AS (SELECT * REPLACE ({A('token_address')} AS token_address, {A('deployer_address')} AS deployer_address, CASE WHEN regexp_full_match({A('fee_recipient_address')}, '0x[0-9a-f]{{40}}') THEN {A('fee_recipient_address')} END AS fee_recipient_address, lower(tx_hash) AS tx_hash) FROM tokens)"


def _buys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "buys").withColumns({"buyer_address": address("buyer_address"), "token_address": address("token_address"), "tx_hash": F.lower("tx_hash"), "row_no": F.col("buy_id")})


def _attributions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "attributions").withColumns({"buyer_address": address("buyer_address"), "token_address": address("token_address"), "tx_hash": F.lower("tx_hash"), "row_no": F.col("attribution_id")})


def _trades(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "trades").withColumns({"address": address("address"), "token_address": address("token_address"), "tx_hash": F.lower("tx_hash"), "row_no": F.col("trade_id")})


def _casts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "token_casts").withColumn("token_address", address("token_address"))


def _activity(spark: SparkSession, d: str) -> DataFrame:
    rows = _trades(spark, d).groupBy("address", "chain_id").agg(F.count("*").alias("tx_count"), F.min("block_time").alias("first_tx_at"), F.max("block_time").alias("last_tx_at"), F.min("fid").alias("fid"))
    return rows


def _deployments(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "deployments").select("fid", address("deployer_address").alias("deployer_address"), address("contract_address").alias("contract_address"), "chain_id", F.col("ingested_at").alias("deployed_at"), F.lower("tx_hash").alias("tx_hash"), "deploy_method", F.col("deployment_id").alias("row_no"))


def _holdings(spark: SparkSession, d: str) -> DataFrame:
    amount = F.when(F.col("side") == "buy", F.col("token_amount")).otherwise(-F.col("token_amount"))
    rows = _trades(spark, d).groupBy("address", "token_address", "chain_id").agg(money(amount).alias("balance"), F.max("block_time").alias("last_activity_at"), F.min("fid").alias("fid"))
    return rows.where("balance > 0").withColumn("balance_raw", F.col("balance").cast("string"))


def _exchange(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "hyperliquid_info").groupBy(address("address").alias("address")).agg(F.count("*").alias("ledger_event_count"), F.coalesce(money(F.trim("usdc").try_cast("double")), F.lit(0.0)).alias("cum_volume_usd"))
    columns = {"has_hl_activity": F.when(F.col("ledger_event_count") > 1, F.col("cum_volume_usd") > 300), "fid": F.lit(None).cast("bigint"), "first_activity_at": F.lit(None).cast("timestamp"), "checked_at": F.lit("2026-01-01 00:00:00").cast("timestamp")}
    return rows.withColumns(columns)


_EXCHANGE = f"x AS (SELECT {A('address')} AS address, count(*) AS n, coalesce(CAST(sum(CAST(try_cast(trim(usdc) AS DOUBLE) AS DECIMAL(28,4))) AS DOUBLE), 0) AS usd FROM hyperliquid_info GROUP BY 1)"


def _channels(spark: SparkSession, d: str) -> DataFrame:
    return reference.channel_full_outer(spark, d).select(F.col("author_fid").alias("fid"), F.col("chain_id").cast("string").alias("channel_id"), "casts_posted", "reactions_received", F.lit(0).alias("replies_received"), "reactions_given", "first_cast_at", "last_cast_at")


def _brands(spark: SparkSession, d: str) -> DataFrame:
    rows = reference.engagement_pivot_weighted(spark, d).withColumnsRenamed({"reply": "replies", "recast": "recasts", "mention": "mentions", "like": "likes"})
    return rows.withColumns({"window_start": F.lit(None).cast("timestamp"), "window_end": F.lit(None).cast("timestamp")})


def _legs(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem")
    text = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    return lines.select(text("w", "l_suppkey").alias("address"), F.concat(F.lit("v"), (F.col("l_partkey") % 50).cast("string")).alias("place"), F.lit(1).cast("bigint").alias("chain_id"), text("t", "l_orderkey").alias("tx_hash"), F.col("l_quantity").alias("a"), F.col("l_tax").alias("b"), F.col("l_shipdate").cast("timestamp").alias("block_time"), F.col("l_returnflag").alias("flag"), F.lit(None).cast("bigint").alias("fid"))


def state(data_type: str, sources: dict[str, DataFrame], graph: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The graph after one data type more."""
    graph = graph or {}
    return graph | {target: rows for target, (rows, _) in load(LOADS[data_type](), sources, graph, STAMP, list(sources)).items()}


def _last(rows: str, keys: tuple[str, ...], values: str, order: str) -> str:
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    names = ", ".join(keys)
    return f"SELECT {names}, {values} FROM ({rows}) WHERE {known} QUALIFY row_number() OVER (PARTITION BY {names} ORDER BY {order}) = 1"


def _keys(kind: str) -> tuple[str, ...]:
    return tuple(edge_keys(kind))


# ---------------------------------------------------------------- relationships


@query(f"""WITH c AS (SELECT fid AS src_fid, {A('custody_address')} AS dst_address, ingested_at FROM accounts WHERE custody_address IS NOT NULL), b AS (SELECT DISTINCT fid AS src_fid, {A('buyer_address')} AS dst_address FROM buys WHERE fid IS NOT NULL)
    SELECT src_fid, dst_address, false AS is_primary, 'eth' AS protocol, 'custody' AS source FROM (SELECT DISTINCT src_fid, dst_address FROM c)
    UNION ALL SELECT src_fid, dst_address, false, 'eth', 'buys' FROM b WHERE (src_fid, dst_address) NOT IN (SELECT (src_fid, dst_address) FROM c)""")
def graph_account_links(spark, d):
    """The owner's links, then those that purchases add: they never change what the owner wrote."""
    own = table(spark, d, "accounts").where("custody_address is not null").select("fid", address("custody_address").alias("address"), F.lit("eth").alias("protocol"), F.lit(None).cast("boolean").alias("is_primary"), F.lit("custody").alias("source"))
    accounts = table(spark, d, "accounts").withColumn("row_no", F.col("ingested_at"))
    first = state("linked_wallets", {"wallets": own, "accounts": accounts})
    return state("token_buyers", {"buys": _buys(spark, d)}, first)["edges_ACCOUNT"].select(*_keys("ACCOUNT"), "is_primary", "protocol", "source")


@query(_last(f"SELECT {A('deployer_address')} AS src_address, {A('contract_address')} AS dst_address, chain_id AS dst_chain_id, lower(tx_hash) AS tx_hash, ingested_at AS deployed_at, deploy_method AS method, deployment_id FROM deployments", _keys("DEPLOYED_CONTRACT"), "deployed_at, method", "deployment_id DESC"), ("deployed_at",))
def graph_deployed_contracts(spark, d):
    return state("contract_deployers", {"deployments": _deployments(spark, d), "deployer_activity": _activity(spark, d)})["edges_DEPLOYED_CONTRACT"]


_ROLES = f"""WITH {_TOKENS}, e AS (SELECT deployer_address AS src_address, token_address AS dst_address, chain_id AS dst_chain_id, 'deployer' AS role, tx_hash, deployed_at, platform, token_row_id, 1 AS step FROM tk WHERE deployer_address IS NOT NULL
    UNION ALL SELECT fee_recipient_address, token_address, chain_id, 'fee_recipient', tx_hash, deployed_at, platform, token_row_id, 2 FROM tk WHERE fee_recipient_address IS NOT NULL AND fee_recipient_address <> coalesce(deployer_address, ''))"""


@query(f"{_ROLES} {_last('SELECT * FROM e', _keys('DEPLOYED_TOKEN'), 'role, tx_hash, deployed_at, platform', 'step DESC, token_row_id DESC')}", ("deployed_at",))
def graph_deployed_tokens(spark, d):
    return state("bankr_tokens", {"tokens": _tokens(spark, d)})["edges_DEPLOYED_TOKEN"]


@query(f"""WITH {_TOKENS}, e AS (SELECT fid AS src_fid, token_address AS dst_address, chain_id AS dst_chain_id, 'deployer' AS role, platform, deployed_at, token_row_id, 1 AS step FROM tk WHERE fid IS NOT NULL
    UNION ALL SELECT fee_recipient_fid, token_address, chain_id, 'fee_recipient', platform, deployed_at, token_row_id, 2 FROM tk WHERE fee_recipient_fid IS NOT NULL AND fee_recipient_fid IS DISTINCT FROM fid)
    {_last('SELECT * FROM e', _keys('CREATED'), 'role, platform, deployed_at', 'step DESC, token_row_id DESC')}""", ("deployed_at",))
def graph_created(spark, d):
    """The account's guard: a fee recipient that is the deployer's own account adds no edge."""
    return state("bankr_tokens", {"tokens": _tokens(spark, d)})["edges_CREATED"]


@query(f"SELECT {A('address')} AS src_address, chain_id AS dst_chain_id, count(*) AS tx_count, min(block_time) AS first_tx_at, max(block_time) AS last_tx_at, 'builder_activity' AS source FROM trades GROUP BY 1, 2", ("first_tx_at", "last_tx_at"))
def graph_active_on(spark, d):
    """Two data types share the edge: the one loaded last names itself."""
    none = _activity(spark, d).select("fid", "address").limit(0)
    first = state("contract_deployers", {"deployments": _deployments(spark, d), "deployer_activity": _activity(spark, d)})
    return state("miniapp_builders", {"builder_wallets": none, "builder_activity": _activity(spark, d)}, first)["edges_ACTIVE_ON"]


@query(f"""WITH b AS (SELECT {A('buyer_address')} AS src_address, {A('token_address')} AS dst_address, chain_id AS dst_chain_id, lower(tx_hash) AS tx_hash, amount_usd AS usd, block_time AS timestamp, platform, token_amount, buy_id AS r FROM buys),
    a AS (SELECT {A('buyer_address')} AS src_address, {A('token_address')} AS dst_address, chain_id AS dst_chain_id, lower(tx_hash) AS tx_hash, amount_usd AS usd, block_time AS timestamp, NULL AS platform, NULL AS token_amount, attribution_id AS r FROM attributions),
    u AS (SELECT *, 1 AS own FROM b UNION ALL SELECT *, 0 FROM a) {_last('SELECT * FROM u', _keys('BOUGHT'), 'usd, timestamp, platform, token_amount', 'own DESC, r DESC')}""", ("timestamp",))
def graph_bought(spark, d):
    """Purchases by their owner first, then the attribution's copies, which only fill what is not there."""
    first = state("token_buyers", {"buys": _buys(spark, d)})
    summary = _attributions(spark, d).groupBy("token_address", "chain_id", "author_fid").agg(*[F.lit(0).alias(c) for c in ("cast_count", "unique_buyers_influenced", "total_purchases", "total_purchase_volume_usd", "attributed_usd")])
    return state("token_evangelists", {"token_casts": _casts(spark, d), "attributions": _attributions(spark, d), "evangelist_summary": summary}, first)["edges_BOUGHT"]


def _popular(spark, d):
    legs = _legs(spark, d)
    deposits = legs.select("address", F.col("place").alias("vault_address"), "chain_id", "tx_hash", F.col("a").alias("assets"), F.col("a").cast("bigint").cast("string").alias("assets_raw"), F.col("b").cast("string").alias("shares_raw"), "block_time", "fid")
    events = legs.select("address", F.col("place").alias("token_address"), F.concat(F.lit("p"), "place").alias("pool_address"), "chain_id", "tx_hash", F.when(F.col("flag") == "R", "burn").otherwise("mint").alias("event"), F.col("a").alias("amount0"), F.col("b").alias("amount1"), "block_time", "fid")
    return state("popular_tokens", {"trades": _trades(spark, d), "holdings": _holdings(spark, d), "vault_deposits": deposits, "lp_events": events})


@query(_last(f"SELECT {A('address')} AS src_address, {A('token_address')} AS dst_address, chain_id AS dst_chain_id, lower(tx_hash) AS tx_hash, side, amount_usd AS usd, token_amount, block_time AS timestamp, trade_id FROM trades", _keys("TRADED"), "usd, token_amount, timestamp", "trade_id DESC"), ("timestamp",))
def graph_traded(spark, d):
    return _popular(spark, d)["edges_TRADED"]


@query(f"SELECT * FROM (SELECT {A('address')} AS src_address, {A('token_address')} AS dst_address, chain_id AS dst_chain_id, CAST(sum(CAST(CASE WHEN side = 'buy' THEN token_amount ELSE -token_amount END AS DECIMAL(28,4))) AS DOUBLE) AS balance, max(block_time) AS last_activity_at FROM trades GROUP BY 1, 2, 3) WHERE balance > 0", ("last_activity_at",))
def graph_holds(spark, d):
    return _popular(spark, d)["edges_HOLDS"].drop("balance_raw")


_LEGS = "l AS (SELECT 'w' || l_suppkey AS address, 'v' || (l_partkey % 50) AS place, 't' || l_orderkey AS tx_hash, l_quantity AS a, l_tax AS b, l_returnflag AS flag FROM lineitem)"


@query(f"WITH {_LEGS} {_last('SELECT address AS src_address, place AS dst_address, 1::BIGINT AS dst_chain_id, tx_hash, a AS assets FROM l', _keys('DEPOSITED_IN'), 'assets', 'assets DESC')}")
def graph_deposited_in(spark, d):
    return _popular(spark, d)["edges_DEPOSITED_IN"].select(*_keys("DEPOSITED_IN"), "assets")


@query(f"""WITH {_LEGS}, e AS (SELECT address AS src_address, place AS dst_address, 1::BIGINT AS dst_chain_id, tx_hash, CASE WHEN flag = 'R' THEN 'burn' ELSE 'mint' END AS event, 'p' || place AS pool_address, a AS amount0, b AS amount1 FROM l)
    {_last('SELECT * FROM e', _keys('PROVIDED_LIQUIDITY'), 'amount0, amount1', 'amount0 DESC, amount1 DESC')}""")
def graph_provided_liquidity(spark, d):
    return _popular(spark, d)["edges_PROVIDED_LIQUIDITY"].drop("timestamp")


def _evangelists(spark, d):
    bought = _attributions(spark, d)
    purchases = bought.groupBy("token_address", "chain_id", "author_fid").agg(F.countDistinct("buyer_fid").alias("unique_buyers_influenced"), F.countDistinct("tx_hash").alias("total_purchases"), money("amount_usd").alias("total_purchase_volume_usd"), money("attributed_usd").alias("attributed_usd"), F.lit(0).cast("bigint").alias("cast_count"))
    return state("token_evangelists", {"token_casts": _casts(spark, d), "attributions": bought, "evangelist_summary": purchases})


@query(_last(f"SELECT author_fid AS src_fid, {A('token_address')} AS dst_address, chain_id AS dst_chain_id, cast_hash, timestamp, matched_on, likes_count, recasts_count FROM token_casts", _keys("POSTED_ABOUT"), "timestamp, matched_on, likes_count, recasts_count", "timestamp DESC NULLS LAST, matched_on DESC NULLS LAST, likes_count DESC NULLS LAST, recasts_count DESC NULLS LAST"), ("timestamp",))
def graph_posted_about(spark, d):
    return _evangelists(spark, d)["edges_POSTED_ABOUT"]


@query(f"SELECT author_fid AS src_fid, {A('token_address')} AS dst_address, chain_id AS dst_chain_id, 0 AS cast_count, count(DISTINCT buyer_fid) AS unique_buyers_influenced, count(DISTINCT lower(tx_hash)) AS total_purchases, CAST(sum(CAST(amount_usd AS DECIMAL(28,4))) AS DOUBLE) AS total_purchase_volume_usd, CAST(sum(CAST(attributed_usd AS DECIMAL(28,4))) AS DOUBLE) AS attributed_usd FROM attributions WHERE author_fid IS NOT NULL GROUP BY 1, 2, 3")
def graph_evangelized(spark, d):
    return _evangelists(spark, d)["edges_EVANGELIZED"]


def _engagement(spark, d):
    casts = _channels(spark, d).select("channel_id", F.col("fid").alias("author_fid"))
    events = table(spark, d, "brand_engagements")
    return state("brand_engagement", {"brand_engagements": events, "brand_engagement_summary": _brands(spark, d), "channel_casts": casts, "channel_engagement_summary": _channels(spark, d)})


@query('SELECT engager_fid AS src_fid, brand_fid AS dst_fid, reply AS replies, "like" AS likes, recast AS recasts, mention AS mentions, weighted_score FROM (' + reference.SQL["engagement_pivot_weighted"] + ")")
def graph_engaged_with(spark, d):
    rows = _engagement(spark, d)["edges_ENGAGED_WITH"]
    return rows.drop("window_start", "window_end")


@query("SELECT author_fid AS src_fid, chain_id::VARCHAR AS dst_channel_id, casts_posted, first_cast_at, last_cast_at FROM (" + reference.SQL["channel_full_outer"] + ") WHERE author_fid IS NOT NULL")
def graph_posted_in(spark, d):
    return _engagement(spark, d)["edges_POSTED_IN"]


@query("SELECT author_fid AS src_fid, chain_id::VARCHAR AS dst_channel_id, reactions_given, reactions_received, 0 AS replies_received FROM (" + reference.SQL["channel_full_outer"] + ") WHERE author_fid IS NOT NULL")
def graph_reacted_in(spark, d):
    return _engagement(spark, d)["edges_REACTED_IN"]


@query(f"WITH {_EXCHANGE} SELECT address AS src_address, 'hyperliquid' AS dst_name, usd AS volume_usd, n AS ledger_event_count FROM x WHERE n > 1 AND usd > 300")
def graph_used(spark, d):
    return state("hyperliquid_activity", {"hl_activity": _exchange(spark, d)})["edges_USED"].drop("first_activity_at", "checked_at")


# ---------------------------------------------------------------- nodes


@query(f"WITH {_EXCHANGE} SELECT address, coalesce(n > 1 AND usd > 300, false) AS is_active, TIMESTAMPTZ '2026-01-01 00:00:00+00' AS checked_at FROM x WHERE address IS NOT NULL", ("checked_at",))
def graph_wallets_checked(spark, d):
    """Every checked wallet carries its stamp; those without activity have no edge, only the negative stamp."""
    return state("hyperliquid_activity", {"hl_activity": _exchange(spark, d)})["nodes_wallet"]


_PROFILE = ("username", "follower_count", "registered_at")


@query(f"""WITH r AS (SELECT *, ingested_at < TIMESTAMPTZ '2025-06-01 00:00:00+00' AS early FROM accounts WHERE fid IS NOT NULL),
    k AS (SELECT *, row_number() OVER (PARTITION BY fid, early ORDER BY ingested_at DESC, username DESC NULLS LAST, display_name DESC NULLS LAST, neynar_score DESC NULLS LAST, follower_count DESC NULLS LAST, following_count DESC NULLS LAST, registered_at DESC NULLS LAST) AS i FROM r),
    o AS (SELECT * FROM k WHERE early AND i = 1), n AS (SELECT * FROM k WHERE NOT early AND i = 1)
    SELECT coalesce(n.fid, o.fid) AS fid, {', '.join(f'coalesce(n.{c}, o.{c}) AS {c}' for c in _PROFILE)} FROM o FULL JOIN n ON o.fid = n.fid""", ("registered_at",))
def graph_accounts(spark, d):
    """Profiles of two runs: a later run never replaces a value by null."""
    rows = table(spark, d, "accounts").withColumn("row_no", F.col("ingested_at"))
    cut_at = F.unix_micros("ingested_at") < F.lit(1748736000000000)  # 2025-06-01 UTC
    wallets = rows.select("fid", F.lit(None).cast("string").alias("address"), F.lit("eth").alias("protocol"), F.lit(True).alias("is_primary"), F.lit("custody").alias("source"))
    graph: dict[str, DataFrame] = {}
    for part in (rows.where(cut_at), rows.where(~cut_at)):
        graph = state("linked_wallets", {"accounts": part, "wallets": wallets}, graph)
    return graph["nodes_account"].select("fid", *_PROFILE)


@query(f"SELECT {A('token_address')} AS address, chain_id, arg_max(platform, token_row_id) AS platform FROM tokens WHERE token_address IS NOT NULL AND chain_id IS NOT NULL GROUP BY 1, 2 UNION ALL SELECT t, c, arg_max(p, i) FROM (SELECT {A('token_address')} AS t, chain_id AS c, platform AS p, buy_id AS i FROM buys) WHERE (t, c) NOT IN (SELECT ({A('token_address')}, chain_id) FROM tokens) GROUP BY 1, 2")
def graph_tokens(spark, d):
    """The registry's tokens, then those that only purchases name: their platform is set on creation only."""
    first = state("bankr_tokens", {"tokens": _tokens(spark, d)})
    return state("token_buyers", {"buys": _buys(spark, d)}, first)["nodes_token"].select(*NODES["token"], "platform")


@query(f"SELECT DISTINCT {A('contract_address')} AS address, chain_id FROM deployments WHERE contract_address IS NOT NULL AND chain_id IS NOT NULL")
def graph_contracts(spark, d):
    return state("contract_deployers", {"deployments": _deployments(spark, d), "deployer_activity": _activity(spark, d)})["nodes_contract"]


@query("SELECT DISTINCT chain_id FROM trades")
def graph_chains(spark, d):
    return state("contract_deployers", {"deployments": _deployments(spark, d), "deployer_activity": _activity(spark, d)})["nodes_chain"]


@query("SELECT DISTINCT chain_id::VARCHAR AS channel_id FROM (SELECT chain_id FROM token_casts UNION ALL SELECT chain_id FROM attributions WHERE author_fid IS NOT NULL)")
def graph_channels(spark, d):
    return _engagement(spark, d)["nodes_channel"]


@query(f"WITH {_EXCHANGE} SELECT DISTINCT 'hyperliquid' AS name FROM x WHERE n > 1 AND usd > 300")
def graph_platforms(spark, d):
    return state("hyperliquid_activity", {"hl_activity": _exchange(spark, d)})["nodes_platform"]


@query(f"SELECT 'wallets' AS label, count(DISTINCT w) AS n FROM (SELECT {A('buyer_address')} AS w FROM buys UNION ALL SELECT {A('buyer_address')} FROM attributions) UNION ALL SELECT 'accounts', count(DISTINCT f) FROM (SELECT fid AS f FROM buys UNION ALL SELECT author_fid FROM token_casts UNION ALL SELECT author_fid FROM attributions UNION ALL SELECT buyer_fid FROM attributions)")
def graph_stub_counts(spark, d):
    """Stubs of both ends exist for every edge, once per key."""
    first = state("token_buyers", {"buys": _buys(spark, d)})
    summary = _attributions(spark, d).select("token_address", "chain_id", "author_fid", *[F.lit(0).alias(c) for c in ("cast_count", "unique_buyers_influenced", "total_purchases", "total_purchase_volume_usd", "attributed_usd")])
    graph = state("token_evangelists", {"token_casts": _casts(spark, d), "attributions": _attributions(spark, d), "evangelist_summary": summary}, first)
    count = lambda name, target: graph[target].agg(F.count("*").alias("n")).select(F.lit(name).alias("label"), "n")
    return count("wallets", "nodes_wallet").unionByName(count("accounts", "nodes_account"))
