"""Queries of the engine's own operators over whole tables, each with the DuckDB statement that checks it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import clean
from tallyloom.functions.text import address, strip
from tallyloom.operators import decode, features, fold, match, pivot, rank, registry, resolve, upsert
from tallyloom.operators.upsert import Policy
from tallyloom.queries.views import EVENTS, LEGS, OWNERS, WALLETS, A, custody, event_rows, leg_trades, plain, plain_sql, wallets
from tallyloom.session import table

QUERIES = {}
SQL = {}


def query(sql: str, times: tuple[str, ...] = (), days: tuple[str, ...] = ()):
    def add(f):
        QUERIES[f.__name__] = lambda spark, d: plain(f(spark, d))
        SQL[f.__name__] = plain_sql(sql, times, days)
        return f

    return add


M = lambda c: f"CAST(sum(CAST({c} AS DECIMAL(28,4))) AS DOUBLE)"

# ---------------------------------------------------------------- attribution: D18, G4, F18, F19, D20

_ATTR = f"""{EVENTS},
b AS (SELECT k % 10 AS token, user_id AS buyer, event_id AS purchase, ts AS bought_at, CAST(value AS DECIMAL(18,4)) AS usd FROM ev WHERE event_type = 'purchase'),
e AS (SELECT k % 10 AS token, user_id AS buyer, event_id % 20 AS author, ts AS engaged_at FROM ev WHERE event_type IN ('click', 'view')),
p AS (SELECT DISTINCT token, buyer, purchase, usd, author FROM b JOIN e USING (token, buyer) WHERE engaged_at < bought_at AND bought_at <= engaged_at + INTERVAL 5 DAY),
a AS (SELECT *, count(*) OVER (PARTITION BY purchase, token, buyer) AS n FROM p)"""


def _attributed(spark: SparkSession, d: str) -> DataFrame:
    ev = event_rows(spark, d).withColumn("token", F.col("k") % 10)
    buys = ev.where("event_type = 'purchase'").select("token", F.col("user_id").alias("buyer"), F.col("event_id").alias("purchase"), F.col("ts").alias("bought_at"), F.col("value").cast("decimal(18,4)").cast("double").alias("usd"))
    eng = ev.where("event_type in ('click', 'view')").select("token", F.col("user_id").alias("buyer"), (F.col("event_id") % 20).alias("author"), F.col("ts").alias("engaged_at"))
    return match.attribute(buys, eng, ["token", "buyer"], 5)


@query(f"WITH {_ATTR} SELECT token, buyer, purchase, author, n AS n_influencers, round(CAST(usd AS DOUBLE) / n, 6) AS attributed_usd FROM a")
def attribution_split(spark, d):
    return _attributed(spark, d).select("token", "buyer", "purchase", "author", "n_influencers", F.round("attributed_usd", 6).alias("attributed_usd"))


@query(f"""WITH {_ATTR},
    c AS (SELECT k % 10 AS token, event_id % 20 AS author, count(DISTINCT event_id) AS cast_count FROM ev WHERE event_type = 'signup' GROUP BY 1, 2),
    s AS (SELECT token, author, count(DISTINCT buyer) AS unique_buyers, count(DISTINCT purchase) AS total_purchases, CAST(sum(CAST(usd AS DECIMAL(28,6))) AS DOUBLE) AS total_usd, CAST(sum(CAST(CAST(usd AS DOUBLE) / n AS DECIMAL(28,6))) AS DOUBLE) AS attributed_usd FROM a GROUP BY 1, 2)
    SELECT token, author, coalesce(cast_count, 0) AS cast_count, coalesce(unique_buyers, 0) AS unique_buyers, coalesce(total_purchases, 0) AS total_purchases,
      coalesce(total_usd, 0) AS total_usd, coalesce(attributed_usd, 0) AS attributed_usd FROM c FULL JOIN s USING (token, author)""")
def attribution_summary(spark, d):
    posts = event_rows(spark, d).where("event_type = 'signup'").select((F.col("k") % 10).alias("token"), (F.col("event_id") % 20).alias("author"), F.col("event_id").alias("cast"))
    return match.author_summary(_attributed(spark, d), posts, ["token"])


# ---------------------------------------------------------------- folding and volumes: F4-F7, F12, F13, E1, C3, C19, H2


@query(f"SELECT fid, {A('buyer_address')} AS buyer, {A('token_address')} AS token, chain_id, platform, tx_hash, {M('amount_usd')} AS amount_usd, {M('token_amount')} AS token_amount, min(block_time) AS block_time, count(*) AS n_legs FROM buys GROUP BY 1, 2, 3, 4, 5, 6", times=("block_time",))
def leg_fold_buys(spark, d):
    buys = table(spark, d, "buys").withColumns({"buyer": address("buyer_address"), "token": address("token_address")})
    return fold.fold_legs(buys, ["fid", "buyer", "token", "chain_id", "platform", "tx_hash"], ["amount_usd", "token_amount"])


@query(f"WITH {LEGS} SELECT bought, taker, tx_from, tx, {M('usd')} AS usd, min(block_time) AS block_time, count(*) AS n_legs FROM legs GROUP BY 1, 2, 3, 4")
def leg_fold_multi(spark, d):
    return fold.fold_legs(leg_trades(spark, d), ["bought", "taker", "tx_from", "tx"], ["usd"])


@query(f"""WITH {LEGS} SELECT tx, leg, side, token, CAST(usd AS DOUBLE) AS usd FROM (
    SELECT tx, leg, taker, 'buy' AS side, bought AS token, usd FROM legs UNION ALL SELECT tx, leg, taker, 'sell', sold, usd FROM legs)""")
def sided_trades(spark, d):
    rows = fold.two_sides(leg_trades(spark, d), ["bought"], ["sold"], ["token"])
    return rows.select("tx", "leg", "side", "token", F.col("usd").cast("double").alias("usd"))


_LISTED = "(SELECT n_nationkey FROM nation)"


def _listed(spark, d):
    """The listed tokens: as many as there are nations."""
    return table(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("token"))


@query(f"""WITH {LEGS}, m AS (SELECT *, bought IN {_LISTED} AS is_buy, CASE WHEN bought IN {_LISTED} THEN bought WHEN sold IN {_LISTED} THEN sold END AS token FROM legs)
    SELECT token, coalesce({M('CASE WHEN is_buy THEN usd END')}, 0) AS buy_usd, coalesce({M('CASE WHEN NOT is_buy THEN usd END')}, 0) AS sell_usd, {M('usd')} AS volume_usd,
      count(DISTINCT taker) AS n_takers, count(*) AS n_trades FROM m WHERE token IS NOT NULL GROUP BY 1""")
def volume_one_scan(spark, d):
    return fold.volume_one_scan(leg_trades(spark, d), _listed(spark, d))


_TWO = "t AS (SELECT bought AS token, taker, usd FROM legs UNION ALL SELECT sold, taker, usd FROM legs)"


@query(f"WITH {LEGS}, {_TWO} SELECT token, {M('usd')} AS volume_usd, count(DISTINCT taker) AS n_takers, count(*) AS n_trades FROM t WHERE token IN {_LISTED} GROUP BY 1")
def volume_two_sided(spark, d):
    return fold.volume_two_sided(leg_trades(spark, d), _listed(spark, d))


@query(f"WITH {LEGS}, {_TWO} SELECT token, {M('usd')} AS volume_usd FROM t GROUP BY 1 HAVING {M('usd')} >= 50000 ORDER BY 2 DESC, 1 LIMIT 25")
def volume_gate_topk(spark, d):
    legs = leg_trades(spark, d)
    tokens = legs.select("bought").union(legs.select("sold")).distinct().toDF("token")
    v = fold.volume_two_sided(legs, tokens).where("volume_usd >= 50000")
    return rank.top(v.select("token", "volume_usd"), [F.desc("volume_usd"), F.asc("token")], 25)


_NET = f"""{LEGS}, n AS (SELECT bought AS token, tx_from AS holder, amount AS delta, block_time FROM legs UNION ALL SELECT bought, taker, -amount, block_time FROM legs),
    g AS (SELECT token, holder, CAST(sum(delta) AS BIGINT) AS balance, max(block_time) AS last_at FROM n GROUP BY 1, 2)"""


def _transfers(spark, d):
    return leg_trades(spark, d).select(F.col("bought").alias("token"), F.col("taker").alias("sender"), F.col("tx_from").alias("receiver"), F.col("amount").alias("value"), F.col("block_time").alias("at"))


@query(f"WITH {_NET} SELECT * FROM g WHERE balance > 100")
def net_balance(spark, d):
    return fold.net_balances(_transfers(spark, d), 100)


@query(f"WITH {_NET} SELECT * FROM g WHERE balance > 100 AND last_at >= TIMESTAMP '2000-01-01'")
def net_balance_active_since(spark, d):
    return fold.net_balances(_transfers(spark, d), 100, F.lit("2000-01-01").cast("timestamp_ntz"))


@query(f"WITH {LEGS}, x AS (SELECT bought, CAST(amount AS HUGEINT) * 1000000000000000000000000 + tx AS raw FROM legs) SELECT bought, CAST(sum(raw) AS VARCHAR) AS total_raw FROM x GROUP BY 1")
def exact_sum_chunks(spark, d):
    raw = F.concat(F.col("amount").cast("string"), F.lpad(F.col("tx").cast("string"), 24, "0"))
    return fold.collapse(leg_trades(spark, d).withColumn("total_raw", raw), ["bought"], exact=["total_raw"])


@query(f"""WITH {LEGS}, w AS (SELECT bought AS token, tx_from AS holder, CAST(amount AS HUGEINT) * 1000000000000000000 AS v FROM legs UNION ALL SELECT bought, taker, -CAST(amount AS HUGEINT) * 1000000000000000000 FROM legs)
    SELECT token, holder, CAST(sum(v) AS VARCHAR) AS balance_raw FROM w GROUP BY 1, 2""")
def net_balance_exact(spark, d):
    return fold.net_balances_exact(_transfers(spark, d).withColumn("value", F.concat(F.col("value").cast("string"), F.lit("0" * 18))))


@query(f"SELECT {A('token_address')} AS token, side, {M('amount_usd')} AS usd, count(*) AS n, count(DISTINCT {A('address')}) AS n_traders FROM trades WHERE amount_usd >= 50 GROUP BY 1, 2")
def trades_over_floor(spark, d):
    t = table(spark, d, "trades").where("amount_usd >= 50").select(address("token_address").alias("token"), "side", "amount_usd", address("address").alias("trader"))
    return t.groupBy("token", "side").agg(fold.money("amount_usd").alias("usd"), F.count("*").alias("n"), F.countDistinct("trader").alias("n_traders"))


# ---------------------------------------------------------------- deployments and activity: D1, D14, C7, F1-F3, F14


@query(f"SELECT {A('deployer_address')} AS deployer, chain_id, count(*) AS tx_count, min(ingested_at) AS first_tx_at, max(ingested_at) AS last_tx_at FROM deployments WHERE {A('deployer_address')} IN (SELECT {A('custody_address')} FROM accounts WHERE custody_address IS NOT NULL) GROUP BY 1, 2", times=("first_tx_at", "last_tx_at"))
def deployer_rollup(spark, d):
    rows = table(spark, d, "deployments").withColumn("deployer", address("deployer_address"))
    known = custody(spark, d).select(F.col("address").alias("deployer")).distinct()
    return registry.roll_up(rows.join(known, "deployer", "left_semi"), ["deployer", "chain_id"], "ingested_at")


@query("""WITH cohort AS (SELECT s_suppkey AS address FROM supplier WHERE s_acctbal > 0),
    s AS (SELECT l_orderkey AS tx, min(l_suppkey) AS sender FROM lineitem WHERE l_suppkey IN (SELECT address FROM cohort) GROUP BY 1)
    SELECT CASE WHEN o_custkey IN (SELECT address FROM cohort) THEN o_custkey ELSE sender END AS deployer, o_orderkey AS contract, o_orderkey AS tx, o_orderdate AS "at",
      CASE WHEN sender IS NULL OR sender = o_custkey THEN 'direct' ELSE 'via_factory' END AS deploy_method
    FROM orders LEFT JOIN s ON o_orderkey = tx WHERE sender IS NOT NULL OR o_custkey IN (SELECT address FROM cohort)""")
def deploy_method(spark, d):
    creations = table(spark, d, "orders").select(F.col("o_orderkey").alias("tx"), F.col("o_orderkey").alias("contract"), F.col("o_custkey").alias("creator"), F.col("o_orderdate").alias("at"))
    senders = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("tx"), F.col("l_suppkey").alias("sender"))
    return registry.deployments(creations, senders, table(spark, d, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("address")))


@query(f"WITH {OWNERS} SELECT t.a AS address, chain_id, count(*) AS tx_count, min(block_time) AS first_tx_at, max(block_time) AS last_tx_at FROM (SELECT {A('address')} AS a, chain_id, block_time FROM trades) t WHERE t.a IN (SELECT address FROM owners) GROUP BY 1, 2", times=("first_tx_at", "last_tx_at"))
def wallet_activity(spark, d):
    rows = table(spark, d, "trades").select(address("address").alias("address"), "chain_id", "block_time")
    return registry.roll_up(rows.join(custody(spark, d).select("address").distinct(), "address", "left_semi"), ["address", "chain_id"], "block_time")


@query(f"""SELECT {A('deployer_address')} AS factory, count(*) AS n_rows, count(DISTINCT {A('token_address')}) AS n_tokens, min(deployed_at) AS first_at, max(deployed_at) AS last_at,
    min(length(name)) AS shortest, max(length(name)) AS longest FROM tokens WHERE deployer_address IS NOT NULL GROUP BY 1 HAVING count(DISTINCT {A('token_address')}) > 1""", times=("first_at", "last_at"))
def factory_discovery(spark, d):
    t = table(spark, d, "tokens").where("deployer_address is not null").withColumn("factory", address("deployer_address"))
    out = t.groupBy("factory").agg(
        F.count("*").alias("n_rows"), F.countDistinct(address("token_address")).alias("n_tokens"), F.min("deployed_at").alias("first_at"), F.max("deployed_at").alias("last_at"),
        F.min(F.length("name")).cast("bigint").alias("shortest"), F.max(F.length("name")).cast("bigint").alias("longest"),
    )
    return out.where("n_tokens > 1")


# ---------------------------------------------------------------- matching in a transaction: D2-D4, G1-G3, E2, F9


@query("""WITH f AS (SELECT user_id, event_id AS first_index FROM events WHERE event_type = 'signup'), o AS (SELECT user_id, event_id AS op_index, value AS sender FROM events WHERE event_type = 'purchase')
    SELECT user_id, first_index, op_index, sender FROM (SELECT f.*, op_index, sender, row_number() OVER (PARTITION BY f.user_id, first_index ORDER BY op_index) AS i FROM f LEFT JOIN o ON f.user_id = o.user_id AND op_index > first_index) WHERE i = 1""")
def nearest_forward_op(spark, d):
    ev = table(spark, d, "events")
    first = ev.where("event_type = 'signup'").select("user_id", F.col("event_id").alias("first_index"))
    ops = ev.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("op_index"), F.col("value").alias("sender"))
    return match.nearest_forward(first, ops, "user_id", "first_index", "op_index", ["sender"])


_WIN = "s AS (SELECT user_id, event_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS next_index FROM events WHERE event_type = 'signup')"


@query(f"WITH {_WIN} SELECT e.user_id, e.event_id, e.event_type, s.event_id AS start_index FROM events e JOIN s ON e.user_id = s.user_id AND e.event_id > s.event_id AND (next_index IS NULL OR e.event_id < next_index) WHERE e.event_type <> 'signup'")
def launch_windows(spark, d):
    ev = table(spark, d, "events").select("user_id", "event_id", "event_type")
    return match.inside_windows(ev.where("event_type <> 'signup'"), ev.where("event_type = 'signup'"), "user_id", "event_id", [])


@query(f"WITH {_WIN} SELECT user_id, event_id, next_index FROM s")
def next_launch(spark, d):
    return match.windows(table(spark, d, "events").where("event_type = 'signup'").select("user_id", "event_id"), "user_id", "event_id")


@query("SELECT vec_id, pair_no, CAST(share AS DOUBLE) AS share FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY share DESC, pair_no) AS i FROM (SELECT vec_id, unnest(embedding) AS share, CAST(generate_subscripts(embedding, 1) AS BIGINT) AS pair_no FROM embeddings)) WHERE i = 1")
def largest_share(spark, d):
    pairs = table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("p", "share"))
    best = rank.keep_first(pairs, ["vec_id"], [F.desc("share"), F.asc("p")])
    return best.select("vec_id", (F.col("p") + 1).cast("bigint").alias("pair_no"), F.col("share").cast("double").alias("share"))


@query("SELECT user_id, CAST(k AS BIGINT) AS k, min(event_id) AS first_index FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events) GROUP BY 1, 2")
def first_log_index(spark, d):
    return event_rows(spark, d).groupBy("user_id", "k").agg(F.min("event_id").alias("first_index"))


# ---------------------------------------------------------------- registries and pools: D6-D12, D19, D23, D24, E3, F8, F10, F11, C9, C10


@query("""WITH m AS (SELECT user_id AS token, min(event_id) AS launcher FROM events WHERE event_type = 'purchase' GROUP BY 1), f AS (SELECT user_id AS token, max(event_id) AS fee FROM events WHERE event_type = 'click' GROUP BY 1)
    SELECT o_orderkey AS tx, o_custkey AS token, launcher, fee, sender, coalesce(launcher, sender) AS deployer, CASE WHEN launcher IS NOT NULL THEN 'user_op' WHEN sender IS NOT NULL THEN 'tx_sender' ELSE 'none' END AS source
    FROM orders LEFT JOIN m ON o_custkey = m.token LEFT JOIN f ON o_custkey = f.token LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS sender FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""")
def registry_left_joins(spark, d):
    ev = table(spark, d, "events").withColumnRenamed("user_id", "token")
    matched = ev.where("event_type = 'purchase'").groupBy("token").agg(F.min("event_id").alias("launcher"))
    fees = ev.where("event_type = 'click'").groupBy("token").agg(F.max("event_id").alias("fee"))
    senders = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("tx")).agg(F.min("l_suppkey").alias("sender"))
    tokens = table(spark, d, "orders").select(F.col("o_orderkey").alias("tx"), F.col("o_custkey").alias("token"))
    return registry.registry(tokens, matched, fees, senders, "token", "tx")


_POOLS = "pools AS (SELECT p_partkey AS pool, p_partkey % 40 AS token0, p_size % 40 AS token1 FROM part)"


def _pools(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("pool"), (F.col("p_partkey") % 40).alias("token0"), (F.col("p_size") % 40).cast("bigint").alias("token1"))


@query(f"WITH {_POOLS} SELECT pool, token0 AS token, token1 AS other FROM pools WHERE token0 IN {_LISTED} UNION ALL SELECT pool, token1, token0 FROM pools WHERE token1 IN {_LISTED}")
def pool_sides_union(spark, d):
    return registry.pools_by_side(_pools(spark, d), _listed(spark, d))


@query(f"""WITH {_POOLS}, x AS (SELECT CAST(s_nationkey AS BIGINT) AS token, max(s_suppkey % 20) AS d FROM supplier GROUP BY 1), e AS (SELECT *, coalesce(a.d, 18) AS decimals0, coalesce(b.d, 18) AS decimals1 FROM pools LEFT JOIN x a ON token0 = a.token LEFT JOIN x b ON token1 = b.token)
    SELECT DISTINCT pool, token, decimals0, decimals1 FROM (SELECT pool, token0 AS token, decimals0, decimals1 FROM e UNION ALL SELECT pool, token1, decimals0, decimals1 FROM e) WHERE token IN {_LISTED}""")
def lp_fanout(spark, d):
    decimals = table(spark, d, "supplier").select(F.col("s_nationkey").cast("bigint").alias("token"), (F.col("s_suppkey") % 20).alias("decimals"))
    events = registry.with_decimals(_pools(spark, d), decimals)
    return registry.fan_out_index(events, _listed(spark, d)).select("pool", "token", "decimals0", "decimals1")


_DAILY = f"""{LEGS}, pr AS (SELECT CAST(o_orderdate AS DATE) AS day, o_custkey % 7 AS numeraire, CAST(sum(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT)) AS BIGINT) // count(*) AS price FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2),
    g AS (SELECT bought AS token, CAST(block_time AS DATE) AS day, sold % 7 AS numeraire, count(*) AS n, sum(CAST(amount AS DECIMAL(28,4))) AS native FROM legs GROUP BY 1, 2, 3),
    dv AS (SELECT token, g.day AS day, CAST(sum(n) AS BIGINT) AS swap_count, CAST(sum(native) AS DOUBLE) AS volume_native, CAST(sum(CAST(native AS DECIMAL(24,4)) * CAST(price AS DECIMAL(14,4))) AS DOUBLE) AS volume_usd FROM g LEFT JOIN pr ON g.day = pr.day AND g.numeraire = pr.numeraire GROUP BY 1, 2)"""


def _daily(spark, d):
    swaps = leg_trades(spark, d).select(F.col("bought").alias("token"), F.to_date("block_time").alias("day"), (F.col("sold") % 7).alias("numeraire"), "amount")
    orders = table(spark, d, "orders").where("o_orderstatus = 'F'").withColumn("numeraire", F.col("o_custkey") % 7)
    cents = F.sum((F.col("o_totalprice").cast("decimal(18,2)") * 100).cast("bigint"))
    prices = orders.groupBy(F.to_date("o_orderdate").alias("day"), "numeraire").agg(F.call_function("div", cents, F.count("*")).alias("price"))
    return fold.daily_volume(swaps, prices)


@query(f"WITH {_DAILY} SELECT * FROM dv", days=("day",))
def swap_daily_volume(spark, d):
    return _daily(spark, d)


@query(f"WITH {_DAILY} SELECT token, CAST(sum(swap_count) AS BIGINT) AS swap_count, CAST(sum(CAST(coalesce(volume_usd, 0) AS DECIMAL(28,4))) AS DOUBLE) AS volume_usd, min(day) AS first_day, max(day) AS last_day FROM dv GROUP BY 1", days=("first_day", "last_day"))
def daily_to_totals(spark, d):
    return fold.day_totals(_daily(spark, d))


@query(f"SELECT token_row_id, CASE WHEN {A('fee_recipient_address')} = '0x' || repeat('0', 40) THEN '0xwrapped' ELSE {A('fee_recipient_address')} END AS numeraire FROM tokens")
def zero_numeraire_remap(spark, d):
    return table(spark, d, "tokens").select("token_row_id", decode.zero_as(address("fee_recipient_address"), "0xwrapped").alias("numeraire"))


_REG = lambda p: f"(SELECT {A('token_address')} AS t, chain_id, name, symbol, deployed_at, fid FROM tokens WHERE {p} QUALIFY row_number() OVER (PARTITION BY {A('token_address')}, chain_id ORDER BY token_row_id) = 1)"
_IS_DUNE = f"{A('source')} = 'dune_robinhood'"


@query(f"""SELECT coalesce(l.t, r.t) AS token, coalesce(l.chain_id, r.chain_id) AS chain_id, coalesce(l.name, r.name) AS name, coalesce(l.symbol, r.symbol) AS symbol, CASE WHEN l.t IS NOT NULL THEN l.deployed_at ELSE r.deployed_at END AS deployed_at, coalesce(l.fid, r.fid) AS fid
    FROM {_REG(_IS_DUNE)} l FULL JOIN {_REG(f"NOT coalesce({_IS_DUNE}, false)")} r ON l.t = r.t AND l.chain_id = r.chain_id""", times=("deployed_at",))
def registry_merge_prefer_left(spark, d):
    t = table(spark, d, "tokens").withColumn("token", address("token_address"))
    chain = F.coalesce(F.lower(strip("source")) == "dune_robinhood", F.lit(False))
    pick = lambda df: rank.keep_first(df, ["token", "chain_id"], [F.asc("token_row_id")]).select("token", "chain_id", "name", "symbol", "deployed_at", "fid")
    return registry.merge_prefer_left(pick(t.where(chain)), pick(t.where(~chain)), ["token", "chain_id"], ["name", "symbol", "fid"])


@query(f"SELECT {A('token_address')} AS token, token_row_id, deployed_at FROM tokens QUALIFY row_number() OVER (PARTITION BY {A('token_address')} ORDER BY deployed_at DESC NULLS LAST, token_row_id) = 1", times=("deployed_at",))
def latest_per_token(spark, d):
    t = table(spark, d, "tokens").select(address("token_address").alias("token"), "token_row_id", "deployed_at")
    return rank.keep_first(t, ["token"], [F.desc_nulls_last("deployed_at"), F.asc("token_row_id")])


@query(f"""WITH u AS (SELECT {A('token_address')} AS token, chain_id, 'popular' AS platform, 0 AS p, 0 AS r FROM popular_tokens UNION ALL SELECT {A('token_address')}, chain_id, platform, 1, token_row_id FROM tokens)
    SELECT token, chain_id, platform, p AS precedence FROM u QUALIFY row_number() OVER (PARTITION BY token, chain_id ORDER BY p, r) = 1""")
def registry_precedence(spark, d):
    popular = table(spark, d, "popular_tokens").select(address("token_address").alias("token"), "chain_id", F.lit("popular").alias("platform"), F.lit(0).cast("bigint").alias("row_no"))
    tokens = table(spark, d, "tokens").select(address("token_address").alias("token"), "chain_id", "platform", F.col("token_row_id").alias("row_no"))
    return rank.keep_first(rank.with_precedence([popular, tokens]), ["token", "chain_id"], [F.asc("precedence"), F.asc("row_no")]).select("token", "chain_id", "platform", "precedence")


@query(f"""WITH r AS (SELECT {A('token_address')} AS token, chain_id, min(platform) AS platform FROM tokens GROUP BY 1, 2)
    SELECT buy_id, coalesce(r.platform, 'unknown') AS platform FROM buys b LEFT JOIN r ON {A('b.token_address')} = r.token AND b.chain_id = r.chain_id""")
def platform_lookup(spark, d):
    reg = table(spark, d, "tokens").groupBy(address("token_address").alias("token"), "chain_id").agg(F.min("platform").alias("platform"))
    buys = table(spark, d, "buys").select("buy_id", address("token_address").alias("token"), "chain_id")
    return buys.join(reg, ["token", "chain_id"], "left").select("buy_id", F.coalesce("platform", F.lit("unknown")).alias("platform"))


@query(f"""WITH p AS (SELECT {A('token_address')} AS token, chain_id FROM popular_tokens), x AS (SELECT {A('token_address')} AS token, chain_id, max(name) AS name FROM tokens GROUP BY 1, 2), y AS (SELECT token, arg_min(name, chain_id) FILTER (name IS NOT NULL) AS nm FROM (SELECT token, chain_id, name FROM x QUALIFY row_number() OVER (PARTITION BY token ORDER BY chain_id, name) = 1) GROUP BY 1)
    SELECT p.token, p.chain_id, coalesce(x.name, y.nm) AS name FROM p LEFT JOIN x ON p.token = x.token AND p.chain_id = x.chain_id LEFT JOIN y ON p.token = y.token""")
def token_list_fallback(spark, d):
    listed = table(spark, d, "popular_tokens").select(address("token_address").alias("token"), "chain_id")
    reg = table(spark, d, "tokens").groupBy(address("token_address").alias("token"), "chain_id").agg(F.max("name").alias("name"))
    return resolve.exact_or_any(listed, reg, "token", "chain_id", ["name"])


# ---------------------------------------------------------------- identity: D14-D17, D22, D25-D29, H12-H15


@query(f"""WITH {LEGS}, {WALLETS}, o AS (SELECT address, min(fid) AS fid FROM wallets GROUP BY 1)
    SELECT tx, leg, CASE WHEN a.fid IS NOT NULL THEN taker ELSE tx_from END AS address, coalesce(a.fid, b.fid) AS fid FROM legs LEFT JOIN o a ON taker = a.address LEFT JOIN o b ON tx_from = b.address WHERE a.fid IS NOT NULL OR b.fid IS NOT NULL""")
def resolve_first_match(spark, d):
    return resolve.attach_account(leg_trades(spark, d).select("tx", "leg", "taker", "tx_from"), resolve.lowest_account(wallets(spark, d)), ["taker", "tx_from"]).select("tx", "leg", "address", "fid")


@query(f"WITH {OWNERS} SELECT trade_id, {A('t.address')} AS address, o.fid FROM trades t LEFT JOIN owners o ON {A('t.address')} = o.address")
def resolve_keep_unresolved(spark, d):
    trades = table(spark, d, "trades").select("trade_id", address("address").alias("taker"))
    return resolve.attach_account(trades, resolve.lowest_account(custody(spark, d)), ["taker"], keep_unresolved=True).select("trade_id", "address", "fid")


def _conflict(order: str) -> str:
    return f"WITH {WALLETS} SELECT address, fid FROM wallets WHERE fid IS NOT NULL QUALIFY row_number() OVER (PARTITION BY address ORDER BY {order}) = 1"


@query(_conflict("source <> 'verified', NOT is_primary, fid"))
def wallet_conflict_verified_first(spark, d):
    return resolve.one_account(wallets(spark, d), "verified")


@query(_conflict("NOT is_primary, score DESC NULLS LAST, fid"))
def wallet_conflict_score_first(spark, d):
    return resolve.one_account(wallets(spark, d), "score")


@query(f"WITH {WALLETS} SELECT address, max(fid) AS fid FROM wallets GROUP BY 1")
def wallet_conflict_last_row(spark, d):
    """The last row wins, in the order of the account."""
    return resolve.one_account(wallets(spark, d).withColumn("row_no", F.col("fid")), "last")


@query(_conflict("source <> 'verified', NOT is_primary, fid"))
def wallet_conflict_reduced(spark, d):
    """The lowest account over a map that the first rule has reduced."""
    return resolve.one_account(wallets(spark, d), "reduced")


@query(f"WITH {OWNERS} SELECT address, fid FROM owners")
def wallet_min_fid(spark, d):
    return resolve.lowest_account(custody(spark, d))


@query(f"WITH {WALLETS}, {LEGS}, a AS (SELECT taker AS address, count(*) AS tx_count, min(block_time) AS first_tx_at, max(block_time) AS last_tx_at FROM legs GROUP BY 1) SELECT w.fid, a.* FROM a JOIN (SELECT DISTINCT address, fid FROM wallets) w USING (address)")
def shared_wallet_fanout(spark, d):
    activity = registry.roll_up(leg_trades(spark, d).withColumnRenamed("taker", "address"), ["address"], "block_time")
    return activity.join(wallets(spark, d).select("address", "fid").distinct(), "address")


@query(f"WITH {WALLETS} SELECT fid, count(DISTINCT address) AS n_wallets FROM wallets GROUP BY 1")
def count_distinct_via_wallets(spark, d):
    return wallets(spark, d).groupBy("fid").agg(F.countDistinct("address").alias("n_wallets"))


@query("SELECT fid, username, neynar_score FROM accounts QUALIFY row_number() OVER (PARTITION BY fid ORDER BY neynar_score DESC NULLS LAST, ingested_at DESC, username NULLS LAST) = 1")
def best_profile(spark, d):
    rows = table(spark, d, "accounts").select("fid", "username", "neynar_score", "ingested_at")
    return rank.keep_first(rows, ["fid"], [F.desc_nulls_last("neynar_score"), F.desc("ingested_at"), F.asc_nulls_last("username")]).drop("ingested_at")


@query(f"SELECT DISTINCT address FROM (SELECT {A('deployer_address')} AS address FROM tokens UNION ALL SELECT {A('fee_recipient_address')} FROM tokens) WHERE address IS NOT NULL")
def address_union(spark, d):
    t = table(spark, d, "tokens").select(address("deployer_address").alias("a"), address("fee_recipient_address").alias("b"))
    return resolve.address_union(t, ["a", "b"])


@query("SELECT DISTINCT fid FROM deployments WHERE fid IS NOT NULL AND fid NOT IN (SELECT fid FROM accounts)")
def unresolved_accounts(spark, d):
    return table(spark, d, "deployments").select("fid").dropna().distinct().join(table(spark, d, "accounts").select("fid"), "fid", "left_anti")


@query("SELECT DISTINCT token_address FROM (SELECT lower(trim(token_address)) AS token_address FROM buys INTERSECT SELECT lower(trim(token_address)) FROM token_casts)")
def overlap_tokens(spark, d):
    pick = lambda n: table(spark, d, n).select(F.lower(F.trim("token_address")).alias("token_address"))
    return pick("buys").intersect(pick("token_casts"))


# ---------------------------------------------------------------- engagement: F15-F17, D21, D31, E5, C23, H3, H11

_KIND = f"trim(regexp_replace({A('engagement')}, '[^\\p{{L}}\\p{{N}}]+', '.', 'g'), '.')"


@query(f"""WITH e AS (SELECT engager_fid, brand_fid, {_KIND} AS kind, weight FROM brand_engagements WHERE engager_fid IS NOT NULL AND engager_fid <> brand_fid), c AS (
    SELECT engager_fid, brand_fid, count(*) FILTER (kind = 'reply') AS reply, count(*) FILTER (kind = 'recast') AS recast, count(*) FILTER (kind = 'mention') AS mention, count(*) FILTER (kind = 'like') AS "like" FROM e WHERE kind IN ('reply', 'recast', 'mention', 'like') GROUP BY 1, 2)
    SELECT engager_fid, brand_fid, reply, recast, mention, "like", round_even(coalesce(b.weight, 1) * (3 * reply + 2 * recast + 2 * mention + "like"), 4) AS weighted_score FROM c JOIN brand_accounts b ON brand_fid = b.fid""")
def engagement_pivot_weighted(spark, d):
    rows = table(spark, d, "brand_engagements").where("engager_fid is not null and engager_fid <> brand_fid").select("engager_fid", "brand_fid", features.kind_name("engagement").alias("kind"))
    brands = table(spark, d, "brand_accounts").select(F.col("fid").alias("brand_fid"), "weight")
    return pivot.weighted_pivot(rows.join(brands, "brand_fid"), ["engager_fid", "brand_fid"], "kind", "weight")


@query(f"""WITH p AS (SELECT chain_id, author_fid, count(*) AS casts_posted, CAST(sum(coalesce(likes_count, 0) + coalesce(recasts_count, 0)) AS BIGINT) AS reactions_received, min(timestamp) AS first_cast_at, max(timestamp) AS last_cast_at FROM token_casts GROUP BY 1, 2),
    g AS (SELECT chain_id, author_fid, count(*) AS reactions_given FROM attributions WHERE author_fid IS NOT NULL GROUP BY 1, 2)
    SELECT chain_id, author_fid, coalesce(casts_posted, 0) AS casts_posted, coalesce(reactions_received, 0) AS reactions_received, first_cast_at, last_cast_at, coalesce(reactions_given, 0) AS reactions_given FROM p FULL JOIN g USING (chain_id, author_fid)""", times=("first_cast_at", "last_cast_at"))
def channel_full_outer(spark, d):
    return pivot.channel_summary(table(spark, d, "token_casts"), table(spark, d, "attributions").where("author_fid is not null"), "chain_id", "author_fid")


@query(f"WITH {EVENTS}, m AS (SELECT DISTINCT event_id, user_id, brand FROM (SELECT event_id, user_id, unnest([k % 30, user_id % 30, k % 30]) AS brand FROM ev)) SELECT event_id, user_id, brand FROM m WHERE brand IN {_LISTED} AND brand <> user_id")
def mention_explode(spark, d):
    posts = event_rows(spark, d).select("event_id", "user_id", F.array(F.col("k") % 30, F.col("user_id") % 30, F.col("k") % 30).alias("ids"), F.lit("").alias("body"))
    brands = _listed(spark, d).select(F.col("token").alias("fid"), F.lit(None).cast("string").alias("name"))
    return pivot.mentions(posts, brands, "body", "name", "ids", "user_id").select("event_id", "user_id", "brand")


@query(f"SELECT {A('token_address')} AS token, chain_id, author_fid, cast_hash, count(*) AS n FROM token_casts GROUP BY 1, 2, 3, 4")
def exact_dedupe_casts(spark, d):
    t = table(spark, d, "token_casts").withColumn("token", address("token_address"))
    return t.groupBy("token", "chain_id", "author_fid", "cast_hash").agg(F.count("*").alias("n"))


@query(f"""WITH c AS (SELECT {A('token_address')} AS token, cast_hash, max(coalesce(likes_count, 0) + coalesce(recasts_count, 0)) AS busy FROM token_casts GROUP BY 1, 2)
    SELECT token, cast_hash, CAST(busy AS BIGINT) AS busy, greatest(0, n - 3) AS n_skipped FROM (SELECT *, row_number() OVER (PARTITION BY token ORDER BY busy DESC, cast_hash) AS i, count(*) OVER (PARTITION BY token) AS n FROM c) WHERE i <= 3""")
def budgeted_topk_per_token(spark, d):
    busy = F.max(F.coalesce("likes_count", F.lit(0)) + F.coalesce("recasts_count", F.lit(0))).alias("busy")
    casts = table(spark, d, "token_casts").groupBy(address("token_address").alias("token"), "cast_hash").agg(busy)
    return rank.budgeted(casts, ["token"], [F.desc("busy"), F.asc("cast_hash")], 3)


# ---------------------------------------------------------------- cohorts and crawls: F20, I3, C17, C18, C20, H4, K1, K5, F24

_COHORT = f"""{OWNERS}, s AS (SELECT {A('deployer_address')} AS address, NULL::BIGINT AS fid, 'deployers' AS source, 1 AS priority FROM deployments
    UNION ALL SELECT {A('address')}, fid, 'traders', 2 FROM trades UNION ALL SELECT {A('buyer_address')}, fid, 'buyers', 3 FROM buys),
    c AS (SELECT address, min(priority) AS priority, string_agg(DISTINCT source, '|' ORDER BY source) AS sources_any, (min((priority, fid)) FILTER (fid IS NOT NULL))[2] AS fid, list_sort(list_distinct(list((priority, source)))) AS o FROM s WHERE address IS NOT NULL GROUP BY 1)"""


def _sources(spark, d):
    part = lambda n, c, fid, name, p: table(spark, d, n).select(address(c).alias("address"), fid.alias("fid"), F.lit(name).alias("source"), F.lit(p).alias("priority"))
    none = F.lit(None).cast("bigint")
    return part("deployments", "deployer_address", none, "deployers", 1).unionByName(part("trades", "address", F.col("fid"), "traders", 2)).unionByName(part("buys", "buyer_address", F.col("fid"), "buyers", 3))


@query(f"WITH {_COHORT} SELECT address, priority, array_to_string([x[2] for x in o], '|') AS sources, fid FROM c")
def cohort_sources(spark, d):
    return pivot.cohort(_sources(spark, d))


_SCORES = "(SELECT fid, max(neynar_score) AS score FROM accounts GROUP BY 1)"


@query(f"WITH {_COHORT} SELECT address, priority, c.fid, score FROM c LEFT JOIN {_SCORES} p ON c.fid = p.fid WHERE priority <= 2 AND score >= 0.5 ORDER BY priority, score DESC NULLS LAST, address LIMIT 500")
def cohort_filter_sort(spark, d):
    scores = table(spark, d, "accounts").groupBy("fid").agg(F.max("neynar_score").alias("score"))
    joined = pivot.cohort(_sources(spark, d)).join(scores, "fid", "left").select("address", "priority", "fid", "score")
    return pivot.gate(joined, 2, 0.5, 500)


@query(f"WITH {_COHORT} SELECT priority, count(*) AS n FROM c GROUP BY 1")
def value_counts(spark, d):
    return pivot.cohort(_sources(spark, d)).groupBy("priority").agg(F.count("*").alias("n"))


@query(f"""WITH {OWNERS}, p AS (SELECT {A('address')} AS address, max(block_time) AS checked_at FROM trades GROUP BY 1) SELECT o.address, checked_at, CASE WHEN checked_at >= TIMESTAMPTZ '2025-06-01 00:00:00+00' THEN 'carry' ELSE 'fetch' END AS plan
    FROM owners o LEFT JOIN p USING (address) WHERE o.address NOT IN (SELECT {A('buyer_address')} FROM buys)""", times=("checked_at",))
def freshness_split(spark, d):
    targets = custody(spark, d).select("address").distinct()
    done = table(spark, d, "buys").select(address("buyer_address").alias("address"))
    prior = table(spark, d, "trades").select(address("address").alias("address"), F.col("block_time").alias("checked_at"))
    return registry.freshness(targets, done, prior, "address", F.lit("2025-06-01 00:00:00").cast("timestamp"))


@query(f"SELECT {A('tx_hash')} AS tx, {A('address')} AS address, {A('token_address')} AS token, chain_id, side, count(*) AS n FROM trades WHERE block_time >= TIMESTAMPTZ '2025-05-31 00:00:00+00' GROUP BY 1, 2, 3, 4, 5")
def incremental_overlap(spark, d):
    rows = table(spark, d, "trades").where(F.col("block_time") >= F.lit("2025-06-01 00:00:00").cast("timestamp") - F.expr("interval 1 day"))
    return rows.groupBy(address("tx_hash").alias("tx"), address("address").alias("address"), address("token_address").alias("token"), "chain_id", "side").agg(F.count("*").alias("n"))


@query(f"SELECT {A('address')} AS address, count(*) AS ledger_event_count, {M('try_cast(trim(usdc) AS DOUBLE)')} AS usdc FROM hyperliquid_info GROUP BY 1")
def ledger_activity(spark, d):
    rows = table(spark, d, "hyperliquid_info").select(address("address").alias("address"), F.trim("usdc").try_cast("double").alias("usdc"))
    return rows.groupBy("address").agg(F.count("*").alias("ledger_event_count"), fold.money("usdc").alias("usdc"))


# ---------------------------------------------------------------- upserts: L1-L9, H9, H10, F25

_OLDNEW = """o AS (SELECT fid, arg_min(username, ingested_at) AS username, min(follower_count) AS follower_count, arg_min(custody_address, ingested_at) AS custody_address FROM accounts WHERE ingested_at < TIMESTAMPTZ '2025-06-01 00:00:00+00' GROUP BY 1),
    n AS (SELECT fid, arg_max(username, ingested_at) AS username, max(follower_count) AS follower_count, arg_max(custody_address, ingested_at) AS custody_address FROM accounts WHERE ingested_at >= TIMESTAMPTZ '2025-06-01 00:00:00+00' GROUP BY 1)"""


def _snapshots(spark, d):
    a = table(spark, d, "accounts")
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("ingested_at"))).alias(c)
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("ingested_at"))).alias(c)
    cut = F.lit(1748736000000000)  # 2025-06-01 UTC
    old = a.where(F.unix_micros("ingested_at") < cut).groupBy("fid").agg(first("username"), F.min("follower_count").alias("follower_count"), first("custody_address"))
    new = a.where(F.unix_micros("ingested_at") >= cut).groupBy("fid").agg(last("username"), F.max("follower_count").alias("follower_count"), last("custody_address"))
    return old, new


def _upsert_sql(one: str) -> str:
    cols = ", ".join(one.format(c=c) + f" AS {c}" for c in ("username", "follower_count", "custody_address"))
    return f"WITH {_OLDNEW} SELECT coalesce(n.fid, o.fid) AS fid, {cols} FROM o FULL JOIN n ON o.fid = n.fid"


@query(_upsert_sql("CASE WHEN n.fid IS NOT NULL THEN n.{c} ELSE o.{c} END"))
def upsert_overwrite(spark, d):
    return upsert.upsert(*_snapshots(spark, d), ["fid"], {})


@query(_upsert_sql("CASE WHEN o.fid IS NOT NULL THEN o.{c} ELSE n.{c} END"))
def upsert_create_only(spark, d):
    return upsert.upsert(*_snapshots(spark, d), ["fid"], {}, Policy.CREATE_ONLY)


@query(_upsert_sql("coalesce(n.{c}, o.{c})"))
def upsert_coalesce(spark, d):
    return upsert.upsert(*_snapshots(spark, d), ["fid"], {}, Policy.COALESCE)


@query(f"WITH {_OLDNEW} SELECT coalesce(n.fid, o.fid) AS fid, CASE WHEN n.fid IS NOT NULL THEN n.username ELSE o.username END AS username, CASE WHEN o.fid IS NOT NULL THEN o.follower_count ELSE n.follower_count END AS follower_count, coalesce(n.custody_address, o.custody_address) AS custody_address FROM o FULL JOIN n ON o.fid = n.fid")
def upsert_mixed(spark, d):
    return upsert.upsert(*_snapshots(spark, d), ["fid"], {"username": Policy.OVERWRITE, "follower_count": Policy.CREATE_ONLY, "custody_address": Policy.COALESCE})


@query(f"WITH {_OLDNEW} SELECT count(*) FILTER (o.fid IS NULL) AS n_created, count(*) FILTER (o.fid IS NOT NULL) AS n_updated FROM n LEFT JOIN o USING (fid)")
def upsert_counters(spark, d):
    return upsert.changes(*_snapshots(spark, d), ["fid"])


@query("SELECT fid, count(*) AS n FROM accounts GROUP BY 1 HAVING count(*) > 1")
def broken_keys(spark, d):
    return upsert.broken_keys(table(spark, d, "accounts"), ["fid"])


@query(f"SELECT {A('token_address')} AS token, chain_id, arg_max(coalesce(name, '-'), token_row_id) AS name, max(token_row_id) AS token_row_id FROM tokens GROUP BY 1, 2")
def last_write_wins(spark, d):
    rows = table(spark, d, "tokens").select(address("token_address").alias("token"), "chain_id", "token_row_id", F.coalesce("name", F.lit("-")).alias("name"))
    return upsert.last_write(rows, ["token", "chain_id"], "token_row_id")


@query(f"""SELECT deployer_address AS wallet, token_address, chain_id, 'deployer' AS role FROM tokens WHERE deployer_address IS NOT NULL
    UNION ALL SELECT fee_recipient_address, token_address, chain_id, 'fee_recipient' FROM tokens WHERE fee_recipient_address IS NOT NULL AND (deployer_address IS NULL OR lower(deployer_address) <> lower(fee_recipient_address))""")
def guarded_roles(spark, d):
    return upsert.role_edges(table(spark, d, "tokens"))


@query("SELECT 'accounts' AS label, count(DISTINCT fid) AS n FROM accounts UNION ALL SELECT 'tokens', count(*) FROM (SELECT DISTINCT lower(trim(token_address)), chain_id FROM tokens)")
def graph_counts(spark, d):
    a = table(spark, d, "accounts").agg(F.countDistinct("fid").alias("n")).select(F.lit("accounts").alias("label"), "n")
    t = table(spark, d, "tokens").select(F.lower(F.trim("token_address")), "chain_id").distinct().agg(F.count("*").alias("n")).select(F.lit("tokens").alias("label"), "n")
    return a.unionByName(t)


# ---------------------------------------------------------------- scalars: J1-J29, C14, C24


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, nullif(event_type, 'error') AS kind FROM events")
def json_props_flatten(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"), F.nullif("event_type", F.lit("error")).alias("kind"))


@query(f"SELECT token_row_id, repeat('00', 12) || substr({A('token_address')}, 3, 40) AS topic FROM tokens")
def hex_topic_pad(spark, d):
    return table(spark, d, "tokens").select("token_row_id", F.lower(F.hex(clean.topic("token_address"))).alias("topic"))


@query("SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS block_month, CAST(o_orderdate AS DATE) AS block_date FROM orders", days=("block_month", "block_date"))
def month_day_floor(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.trunc("o_orderdate", "month").alias("block_month"), F.to_date("o_orderdate").alias("block_date"))


@query(f"""WITH a AS (SELECT token_row_id, CASE WHEN starts_with({A('fee_recipient_address')}, '0x') THEN {A('fee_recipient_address')} ELSE '0x' || {A('fee_recipient_address')} END AS x FROM tokens)
    SELECT token_row_id, CASE WHEN regexp_full_match(x, '0x[0-9a-f]{{40}}') THEN x END AS address FROM a""")
def address_normaliser(spark, d):
    return table(spark, d, "tokens").select("token_row_id", clean.prefixed_address("fee_recipient_address").alias("address"))


@query(f"SELECT DISTINCT 'eip155:' || chain_id || '/erc20:' || {A('token_address')} AS url FROM tokens")
def token_urls(spark, d):
    return table(spark, d, "tokens").select(clean.token_url("chain_id", "token_address").alias("url")).distinct()
