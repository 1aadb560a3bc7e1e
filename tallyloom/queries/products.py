"""The data products over the driver's tables, each with the DuckDB statement that checks it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import address, valid_address
from tallyloom.operators import resolve
from tallyloom.plans import graph, products
from tallyloom.queries.views import A, plain, plain_sql
from tallyloom.session import table

QUERIES = {}
SQL = {}


def query(sql: str, times: tuple[str, ...] = ()):
    def add(f):
        QUERIES[f.__name__] = lambda spark, d: plain(f(spark, d))
        SQL[f.__name__] = plain_sql(sql, times)
        return f

    return add


_PAIRS = f"""p AS (SELECT {A('custody_address')} AS address, fid FROM accounts UNION ALL SELECT {A('buyer_address')}, fid FROM buys UNION ALL SELECT {A('deployer_address')}, fid FROM deployments UNION ALL SELECT {A('address')}, fid FROM trades)"""
_MAP = f"{_PAIRS}, m AS (SELECT address, min(fid) AS fid FROM p WHERE regexp_full_match(address, '0x[0-9a-f]{{40}}') AND fid IS NOT NULL GROUP BY 1)"
_SUM = lambda c: f"CAST(sum(CAST({c} AS DECIMAL(28,4))) AS DOUBLE) AS {c}"


def _wallets(spark: SparkSession, d: str) -> DataFrame:
    """The least account of each wallet that is a custody address or has traded, bought or deployed for an account."""
    part = lambda n, c: table(spark, d, n).select(valid_address(c).alias("address"), "fid")
    pairs = [("accounts", "custody_address"), ("buys", "buyer_address"), ("deployments", "deployer_address"), ("trades", "address")]
    return resolve.lowest_account(reduce(DataFrame.unionByName, [part(*p) for p in pairs]).dropna())


def _trades(spark: SparkSession, d: str) -> DataFrame:
    a = address("address")
    return table(spark, d, "trades").select(a.alias("taker"), a.alias("tx_from"), address("token_address").alias("token_address"), "chain_id", "side", "amount_usd", "token_amount", "block_time", F.lower("tx_hash").alias("tx_hash"))


@query(f"SELECT {A('custody_address')} AS address, fid FROM accounts WHERE regexp_full_match({A('custody_address')}, '0x[0-9a-f]{{40}}') QUALIFY row_number() OVER (PARTITION BY {A('custody_address')} ORDER BY neynar_score DESC NULLS LAST, fid) = 1")
def product_wallet_map(spark, d):
    return products.wallet_map(table(spark, d, "accounts"))


@query(f"""WITH {_MAP}, r AS (SELECT {A('token_address')} AS token_address, chain_id, platform FROM tokens QUALIFY row_number() OVER (PARTITION BY {A('token_address')}, chain_id ORDER BY platform) = 1)
    SELECT m.fid, m.address AS buyer_address, r.token_address, r.chain_id, r.platform, lower(tx_hash) AS tx_hash, {_SUM('amount_usd')}, {_SUM('token_amount')}, min(block_time) AS block_time
    FROM trades t JOIN m ON {A('t.address')} = m.address JOIN r ON {A('t.token_address')} = r.token_address AND t.chain_id = r.chain_id WHERE side = 'buy' AND amount_usd >= 50 GROUP BY 1, 2, 3, 4, 5, 6""", ("block_time",))
def product_token_buyers(spark, d):
    tokens = table(spark, d, "tokens").select(address("token_address").alias("token_address"), "chain_id", "platform")
    return products.token_buyers(_trades(spark, d).where("side = 'buy'"), [tokens], _wallets(spark, d))


@query(f"""WITH {_MAP}, i AS (SELECT DISTINCT {A('token_address')} AS token_address, chain_id FROM popular_tokens)
    SELECT m.fid, m.address, i.token_address, i.chain_id, side, lower(tx_hash) AS tx_hash, {_SUM('amount_usd')}, {_SUM('token_amount')}, min(block_time) AS block_time
    FROM trades t JOIN m ON {A('t.address')} = m.address JOIN i ON {A('t.token_address')} = i.token_address AND t.chain_id = i.chain_id WHERE amount_usd >= 50 GROUP BY 1, 2, 3, 4, 5, 6""", ("block_time",))
def product_popular_trades(spark, d):
    index = table(spark, d, "popular_tokens").select(address("token_address").alias("token_address"), "chain_id")
    return products.popular_trades(_trades(spark, d), index, _wallets(spark, d))


@query(f"""WITH {_MAP}, x AS (SELECT m.fid, {A('deployer_address')} AS deployer, {A('contract_address')} AS contract, chain_id, lower(tx_hash) AS tx, ingested_at AS "at", deployment_id FROM deployments d JOIN m ON {A('deployer_address')} = m.address)
    SELECT fid, deployer, contract, chain_id, tx, "at" FROM x QUALIFY row_number() OVER (PARTITION BY contract, tx ORDER BY deployment_id) = 1""", ('"at"',))
def product_contract_deployers(spark, d):
    rows = table(spark, d, "deployments").withColumns({"at": F.col("ingested_at"), "row_no": F.col("deployment_id")})
    activity = table(spark, d, "trades").select(address("address").alias("address"), "chain_id", F.col("block_time").alias("at"))
    return products.contract_deployers(rows, activity, _wallets(spark, d))["deployments"]


_KEYS = "token_address, chain_id"


def _evangelists(spark, d):
    token = address("token_address").alias("token_address")
    casts = table(spark, d, "token_casts").where("author_fid is not null").select(token, "chain_id", F.col("author_fid").alias("author"), F.col("cast_hash").alias("cast"), "timestamp")
    buys = table(spark, d, "buys").where("fid is not null").select(token, "chain_id", F.col("fid").alias("buyer"), F.col("buy_id").alias("purchase"), F.col("block_time").alias("bought_at"), F.coalesce("amount_usd", F.lit(0.0)).alias("usd"))
    own = casts.where("timestamp is not null").select(*[c for c in ("token_address", "chain_id")], F.col("author").alias("buyer"), "author", F.col("timestamp").alias("engaged_at"))
    return products.token_evangelists(casts.drop("timestamp"), buys, own)


@query(f"""WITH c AS (SELECT {A('token_address')} AS token_address, chain_id, author_fid AS author, timestamp AS seen FROM token_casts WHERE timestamp IS NOT NULL AND author_fid IS NOT NULL),
    p AS (SELECT DISTINCT b.buy_id AS purchase, coalesce(b.amount_usd, 0) AS usd, c.author FROM buys b JOIN c ON {A('b.token_address')} = c.token_address AND b.chain_id = c.chain_id AND b.fid = c.author AND seen < block_time AND block_time <= seen + INTERVAL 120 HOUR)
    SELECT purchase, author, usd, count(*) OVER (PARTITION BY purchase) AS n_influencers FROM p""")
def product_evangelists(spark, d):
    return _evangelists(spark, d)["attributions"].select("purchase", "author", "usd", "n_influencers")


@query("SELECT DISTINCT fid FROM (SELECT author_fid AS fid FROM token_casts UNION ALL SELECT fid FROM buys UNION ALL SELECT fid FROM trades) WHERE fid IS NOT NULL")
def product_graph_accounts(spark, d):
    ends = [table(spark, d, "token_casts").select(F.col("author_fid").alias("fid")), table(spark, d, "buys"), table(spark, d, "trades")]
    return graph.stubs("account", *ends)


@query(f"""WITH {_MAP}, s AS (SELECT {A('address')} AS address, fid, 1 AS p FROM trades UNION ALL SELECT {A('buyer_address')}, fid, 2 FROM buys),
    c AS (SELECT address, min(p) AS priority, (min((p, fid)) FILTER (fid IS NOT NULL))[2] AS known FROM s GROUP BY 1), f AS (SELECT fid, max(neynar_score) AS score FROM accounts GROUP BY 1)
    SELECT c.address, priority, coalesce(known, m.fid) AS fid, score FROM c LEFT JOIN m USING (address) LEFT JOIN f ON coalesce(known, m.fid) = f.fid WHERE priority <= 1 AND score >= 0.25""")
def product_cohort(spark, d):
    part = lambda n, c, name, p: table(spark, d, n).select(address(c).alias("address"), "fid", F.lit(name).alias("source"), F.lit(p).alias("priority"))
    out = products.arb_cohort([part("trades", "address", "traders", 1), part("buys", "buyer_address", "buyers", 2)], table(spark, d, "accounts"), _wallets(spark, d), 1, 0.25)
    return out.select("address", "priority", "fid", "score")


@query(f"""WITH {_MAP}, x AS (SELECT DISTINCT {A('deployer_address')} AS address FROM deployments WHERE {A('deployer_address')} IN (SELECT address FROM m))
    SELECT m.fid, {A('t.address')} AS address, chain_id, count(*) AS tx_count, min(block_time) AS first_tx_at, max(block_time) AS last_tx_at FROM trades t JOIN x ON {A('t.address')} = x.address JOIN m ON x.address = m.address GROUP BY 1, 2, 3""", ("first_tx_at", "last_tx_at"))
def product_deployer_activity(spark, d):
    rows = table(spark, d, "deployments").withColumns({"at": F.col("ingested_at"), "row_no": F.col("deployment_id")})
    activity = table(spark, d, "trades").select(address("address").alias("address"), "chain_id", F.col("block_time").alias("at"))
    return products.contract_deployers(rows, activity, _wallets(spark, d))["deployer_activity"]


@query(f"SELECT DISTINCT {A('token_address')} AS token_address, chain_id, author_fid AS author, cast_hash AS \"cast\" FROM token_casts WHERE author_fid IS NOT NULL")
def product_token_casts(spark, d):
    return _evangelists(spark, d)["token_casts"]


@query(f"""WITH c AS (SELECT {A('token_address')} AS token_address, chain_id, author_fid AS author, cast_hash, timestamp AS seen FROM token_casts WHERE author_fid IS NOT NULL),
    p AS (SELECT DISTINCT c.token_address, c.chain_id, b.buy_id AS purchase, b.fid AS buyer, coalesce(b.amount_usd, 0) AS usd, c.author FROM buys b JOIN c ON {A('b.token_address')} = c.token_address AND b.chain_id = c.chain_id AND b.fid = c.author AND seen < block_time AND block_time <= seen + INTERVAL 120 HOUR),
    s AS (SELECT *, count(*) OVER (PARTITION BY token_address, chain_id, buyer, purchase) AS n FROM p),
    x AS (SELECT token_address, chain_id, author, count(DISTINCT buyer) AS unique_buyers, count(DISTINCT purchase) AS total_purchases, CAST(sum(CAST(usd AS DECIMAL(28,6))) AS DOUBLE) AS total_usd, CAST(sum(CAST(usd / n AS DECIMAL(28,6))) AS DOUBLE) AS attributed_usd FROM s GROUP BY 1, 2, 3),
    y AS (SELECT token_address, chain_id, author, count(DISTINCT cast_hash) AS cast_count FROM c GROUP BY 1, 2, 3)
    SELECT token_address, chain_id, author, coalesce(cast_count, 0) AS cast_count, coalesce(unique_buyers, 0) AS unique_buyers, coalesce(total_purchases, 0) AS total_purchases, coalesce(total_usd, 0) AS total_usd, coalesce(attributed_usd, 0) AS attributed_usd FROM y FULL JOIN x USING (token_address, chain_id, author)""")
def product_evangelist_summary(spark, d):
    return _evangelists(spark, d)["evangelist_summary"]


@query(f"WITH {_MAP} SELECT m.address, m.fid FROM m WHERE m.fid IN (SELECT author_fid FROM token_casts)")
def product_author_wallets(spark, d):
    """All wallets of the accounts that wrote about a token."""
    authors = table(spark, d, "token_casts").select(F.col("author_fid").alias("fid"))
    return _wallets(spark, d).join(authors, "fid", "left_semi").select("address", "fid")
