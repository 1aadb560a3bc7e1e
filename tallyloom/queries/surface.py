"""Scans, decoding, guards and products over the driver's tables, each with its DuckDB statement."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import clean, uint256
from tallyloom.functions.text import address, sql_strip, valid_address
from tallyloom.operators import decode, fold, instants, pivot, rank, registry, resolve
from tallyloom.plans import products
from tallyloom.queries.pipeline import P7
from tallyloom.queries.products import _MAP, _wallets
from tallyloom.queries.views import LEGS, A, leg_trades, plain, plain_sql
from tallyloom.session import table
from tallyloom.sources import payloads, runs, warehouse

QUERIES = {}
SQL = {}
_NAMES = ("accounts", "tokens", "trades", "buys", "token_casts", "attributions", "deployments", "brand_engagements", "popular_tokens", "brand_accounts")
SINCE = datetime(2025, 6, 1, tzinfo=UTC)


def query(sql: str, times: tuple[str, ...] = (), days: tuple[str, ...] = ()):
    def add(f):
        QUERIES[f.__name__] = lambda spark, d: plain(f(spark, d))
        SQL[f.__name__] = plain_sql(sql, times, days)
        return f

    return add


# ---------------------------------------------------------------- scans: A1, A2, A5-A8, A13, A20, C8, C16, J16, J24


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1999-03-15' AND o_orderdate < TIMESTAMP '1999-07-02'", ("o_orderdate",))
def bounded_scan(spark, d):
    rows = table(spark, d, "orders").withColumns({"o_orderdate": F.col("o_orderdate").cast("timestamp"), "block_month": F.trunc("o_orderdate", "month")})
    return warehouse.bounded(rows, "o_orderdate", datetime(1999, 3, 15, tzinfo=UTC), datetime(1999, 7, 2, tzinfo=UTC), month="block_month").select("o_orderkey", "o_orderdate")


_TEXT = "SELECT chain_id, platform, count(*) AS n FROM tokens WHERE chain_id IN (SELECT chain_id FROM popular_tokens) AND token_row_id > {} GROUP BY chain_id, platform"


@query(_TEXT.format(100))
def sql_text(spark, d):
    warehouse.register(spark, d, ("tokens", "popular_tokens"))
    return warehouse.run_sql(spark, _TEXT.format(":least"), args={"least": 100})


@query("SELECT table_name, column_name, CAST(row_number() OVER (PARTITION BY table_name ORDER BY ordinal_position) - 1 AS INT) AS position FROM information_schema.columns WHERE table_name IN ('" + "', '".join(_NAMES) + "')")
def schema_probe(spark, d):
    return warehouse.columns_of(spark, d, _NAMES)


@query("SELECT DISTINCT chain_id, chain_id IN (SELECT chain_id FROM trades) AS covered FROM tokens")
def source_coverage(spark, d):
    return warehouse.coverage(table(spark, d, "tokens"), table(spark, d, "trades"))


@query("SELECT v.name, count(t.token_row_id) AS n FROM (VALUES (1, 'first'), (8453, 'second'), (42161, 'third')) v(chain_id, name) LEFT JOIN tokens t ON t.chain_id = v.chain_id GROUP BY 1")
def literal_relation(spark, d):
    listed = spark.sql("SELECT * FROM VALUES (1L, 'first'), (8453L, 'second'), (42161L, 'third') AS v(chain_id, name)")
    return listed.join(table(spark, d, "tokens"), "chain_id", "left").groupBy(listed["name"]).agg(F.count("token_row_id").alias("n"))


@query("SELECT count(*) AS n_total, count(*) FILTER (fid IS NULL) AS n_unowned FROM tokens")
def total_count(spark, d):
    return table(spark, d, "tokens").agg(F.count("*").alias("n_total"), F.count_if(F.col("fid").isNull()).alias("n_unowned"))


@query(f"SELECT trade_id, token_amount / pow(10, coalesce(decimals, 18)) AS amount FROM trades t LEFT JOIN (SELECT {A('token_address')} AS a, chain_id AS c, max(decimals) AS decimals FROM popular_tokens GROUP BY 1, 2) p ON {A('t.token_address')} = a AND t.chain_id = c")
def scaled_amounts(spark, d):
    """Every amount divided by its token's decimals, 18 where the dimension has none."""
    dims = table(spark, d, "popular_tokens").groupBy(address("token_address").alias("token"), "chain_id").agg(F.max("decimals").alias("decimals"))
    trades = table(spark, d, "trades").select("trade_id", address("token_address").alias("token"), "chain_id", "token_amount")
    return trades.join(dims, ["token", "chain_id"], "left").select("trade_id", (F.col("token_amount") / F.pow(F.lit(10.0), F.coalesce("decimals", F.lit(18)))).alias("amount"))


@query("SELECT chain_id, CASE chain_id WHEN 1 THEN 'ethereum' WHEN 8453 THEN 'base' WHEN 42161 THEN 'arbitrum' END AS chain, count(*) AS n FROM trades WHERE chain_id IN (1, 8453, 42161) GROUP BY 1")
def chain_restriction(spark, d):
    """The home chain and those that were asked for by name or id, with their names."""
    wanted = warehouse.chain_ids(["Base", "1"], 42161)
    names = spark.createDataFrame([(c, warehouse.chain_name(c)) for c in wanted], "chain_id bigint, chain string")
    return table(spark, d, "trades").join(names, "chain_id").groupBy("chain_id", "chain").agg(F.count("*").alias("n"))


@query("SELECT doc_id, length(text) AS text_length FROM documents")
def text_length(spark, d):
    return table(spark, d, "documents").select("doc_id", F.length("text").cast("bigint").alias("text_length"))


@query(f"SELECT token_row_id, {A('token_address')} AS token, {A('token_address')}[-1:] = '0' AS is_vanity FROM tokens WHERE {A('token_address')}[-1:] IN ('0', '7')")
def vanity_suffix(spark, d):
    """Tokens whose address ends in one of the wanted suffixes."""
    t = table(spark, d, "tokens").select("token_row_id", address("token_address").alias("token"))
    return t.where(F.endswith("token", F.lit("0")) | F.endswith("token", F.lit("7"))).withColumn("is_vanity", F.endswith("token", F.lit("0")))


@query(f"SELECT update_id, {A('address')} AS address, CASE WHEN lower({sql_strip('hash')}) <> '' THEN lower({sql_strip('hash')}) END AS tx_hash, try_cast(CASE WHEN lower({sql_strip('usdc')}) NOT IN ('', 'nan', 'none', 'null', 'nat', '<na>', '<nil>') THEN {sql_strip('usdc')} END AS DOUBLE) AS amount_usd, nullif({sql_strip('delta_type')}, '') AS name FROM hyperliquid_info")
def typed_clean(spark, d):
    """Text cells coerced by the kind their column names stand for."""
    raw = table(spark, d, "hyperliquid_info").select("update_id", "address", F.col("hash").alias("tx_hash"), F.col("usdc").alias("amount_usd"), F.col("delta_type").alias("name"))
    return clean.typed(raw, ("address",), {"update_id": "bigint"})


@query(f"SELECT 'amount_usd' AS column_name, count(*) FILTER (v <> '' AND lower(v) NOT IN ('nan', 'none', 'null', 'nat', '<na>', '<nil>') AND try_cast(v AS DOUBLE) IS NULL) AS n_bad FROM (SELECT {sql_strip('usdc')} AS v FROM hyperliquid_info) UNION ALL SELECT 'fid', count(*) FILTER (v <> '' AND lower(v) NOT IN ('nan', 'none', 'null', 'nat', '<na>', '<nil>') AND try_cast(v AS DECIMAL(38,6)) IS NULL) FROM (SELECT {sql_strip('delta_type')} AS v FROM hyperliquid_info)")
def bad_cells(spark, d):
    """How many cells are no value of their column's kind: a column of numbers and one of words read as numbers."""
    raw = table(spark, d, "hyperliquid_info").select(F.col("usdc").alias("amount_usd"), F.col("delta_type").alias("fid"))
    return clean.bad_cells(raw, raw, ["amount_usd", "fid"])


@query("SELECT max(greatest(coalesce(block_time, ingested_at), ingested_at)) AS newest FROM buys", ("newest",))
def newest_event_time(spark, d):
    return runs.newest(table(spark, d, "buys"), "block_time", "ingested_at")


# ---------------------------------------------------------------- decoding: C12, D2, D5, D9, E2, J2-J5, J13


def _word(value: Column) -> Column:
    """A signed integer as the hex of a 32-byte word."""
    h = F.hex(value.cast("bigint"))
    return F.when(value < 0, F.lpad(h, 64, "F")).otherwise(F.lpad(h, 64, "0"))


def _pair_logs(spark: SparkSession, d: str) -> DataFrame:
    """One log per order: offset, count, then (supplier, quantity) pairs; every fifth order's has one byte too many."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey", F.col("l_quantity").cast("bigint").alias("q")))).alias("ls"))
    pairs = F.array_join(F.transform("ls", lambda x: F.concat(_word(x["l_suppkey"]), _word(x["q"]))), "")
    data = F.concat(F.lit(f"{32:064X}"), _word(F.size("ls")), pairs, F.when(F.col("l_orderkey") % 5 == 0, F.lit("00")).otherwise(F.lit("")))
    return lines.select(F.col("l_orderkey").alias("tx"), F.unhex(data).alias("data"))


_LINES = "p AS (SELECT l_orderkey AS tx, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, CAST(l_quantity AS BIGINT)) AS pair_no, '0x' || lpad(lower(printf('%x', l_suppkey)), 40, '0') AS beneficiary, CAST(l_quantity AS BIGINT) AS share FROM lineitem)"


@query(f"WITH {_LINES} SELECT tx, CAST(pair_no AS INT) AS pair_no, beneficiary, upper(lpad(printf('%x', share), 64, '0')) AS share_hex FROM p WHERE tx % 5 <> 0")
def abi_pairs(spark, d):
    """Arrays of (address, share) pairs out of byte logs; malformed logs give no row."""
    return decode.address_shares(_pair_logs(spark, d), "data").drop("data")


@query(f"WITH {_LINES} SELECT tx, beneficiary, CAST(share AS VARCHAR) AS share FROM (SELECT *, row_number() OVER (PARTITION BY tx ORDER BY share DESC, pair_no) AS i FROM p WHERE tx % 5 <> 0) WHERE i = 1")
def largest_fee_share(spark, d):
    """The beneficiary of the greatest 256-bit share of each log, the share as exact text."""
    shares = decode.address_shares(_pair_logs(spark, d), "data")
    best = rank.keep_first(shares, ["tx"], [F.desc("share_hex"), F.asc("pair_no")])
    return best.select("tx", "beneficiary", uint256.from_bytes(F.unhex("share_hex"), 1).alias("share"))


@query("SELECT l_orderkey AS tx, l_linenumber AS leg, CAST(CASE WHEN l_linenumber % 2 = 1 THEN -1 ELSE 1 END * CAST(l_quantity AS BIGINT) AS VARCHAR) AS amount0, CAST(CASE WHEN l_linenumber % 2 = 1 THEN 1 ELSE -1 END * CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) AS amount1, '0x' || lpad(lower(printf('%x', l_partkey)), 40, '0') AS pool FROM lineitem")
def swap_words(spark, d):
    """Two signed 256-bit amounts and a pool address out of each swap's bytes."""
    sign = F.when(F.col("l_linenumber") % 2 == 1, -1).otherwise(1)
    data = F.unhex(F.concat(_word(sign * F.col("l_quantity").cast("bigint")), _word(-sign * F.floor("l_extendedprice").cast("bigint"))))
    logs = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", data.alias("data"), F.unhex(_word(F.col("l_partkey"))).alias("topic"))
    amounts = [uint256.from_bytes(F.col("data"), 1 + 32 * i, 32, True).alias(f"amount{i}") for i in (0, 1)]
    return logs.select(F.col("l_orderkey").alias("tx"), F.col("l_linenumber").alias("leg"), *amounts, decode.word_address(F.col("topic"), 1).alias("pool"))


@query(f"SELECT b.buy_id, t.platform FROM buys b JOIN (SELECT {A('token_address')} AS a, chain_id, min(platform) AS platform FROM tokens GROUP BY 1, 2) t ON {A('b.token_address')} = t.a AND b.chain_id = t.chain_id")
def decoded_topic_join(spark, d):
    """Events joined to what they name by an address decoded from a topic."""
    events = table(spark, d, "buys").select("buy_id", "chain_id", clean.topic("token_address").alias("topic"))
    made = table(spark, d, "tokens").groupBy(address("token_address").alias("token"), "chain_id").agg(F.min("platform").alias("platform"))
    return events.withColumn("token", decode.word_address(F.col("topic"), 1)).join(made, ["token", "chain_id"]).select("buy_id", "platform")


@query("SELECT o_orderkey AS tx, l_partkey AS token, min(l_linenumber) AS first_index, count(*) AS n_logs FROM lineitem JOIN (SELECT DISTINCT o_orderkey, p_partkey AS created FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey WHERE p_size <= 10) c ON l_orderkey = o_orderkey AND l_partkey = created GROUP BY 1, 2")
def created_token_logs(spark, d):
    """Logs of tokens created in the very transaction: an equi-join on transaction and contract."""
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("tx"), F.col("l_partkey").alias("token"), "l_linenumber")
    small = table(spark, d, "part").where("p_size <= 10").select(F.col("p_partkey").alias("token"))
    created = lines.join(small, "token").join(table(spark, d, "orders").select(F.col("o_orderkey").alias("tx")), "tx").select("tx", "token").distinct()
    return lines.join(created, ["tx", "token"]).groupBy("tx", "token").agg(F.min("l_linenumber").alias("first_index"), F.count("*").alias("n_logs"))


@query("WITH pools AS (SELECT p_partkey AS pool, p_partkey % 40 AS token0, p_size % 40 AS token1 FROM part), tp AS (SELECT pool, token0 AS token FROM pools WHERE token0 IN (SELECT n_nationkey FROM nation) UNION ALL SELECT pool, token1 FROM pools WHERE token1 IN (SELECT n_nationkey FROM nation)) SELECT token, count(*) AS n_swaps, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS amount FROM lineitem JOIN tp ON l_partkey = pool GROUP BY 1")
def swaps_of_tokens(spark, d):
    """Swaps joined to the pools of listed tokens on either side."""
    pools = table(spark, d, "part").select(F.col("p_partkey").alias("pool"), (F.col("p_partkey") % 40).alias("token0"), (F.col("p_size") % 40).cast("bigint").alias("token1"))
    listed = table(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("token"))
    swaps = table(spark, d, "lineitem").select(F.col("l_partkey").alias("pool"), F.col("l_quantity").cast("bigint").alias("amount"))
    return swaps.join(registry.pools_by_side(pools, listed), "pool").groupBy("token").agg(F.count("*").alias("n_swaps"), F.sum("amount").alias("amount"))


@query("SELECT vec_id, CAST(CAST(vec_id AS HUGEINT) * 18446744073709551616 + vec_id AS VARCHAR) AS low, '115792089237316195423570985008687907853269984665640564039457584007913129639935' AS high, CAST(-1 - vec_id AS VARCHAR) AS below FROM embeddings")
def uint256_words(spark, d):
    """Words of all 256 bits: a number of 128 bits, the greatest of all, and a negative one in two's complement."""
    low = F.concat(F.lpad(F.hex("vec_id"), 48, "0"), F.lpad(F.hex("vec_id"), 16, "0"))
    word = lambda h, signed=False: uint256.from_bytes(F.unhex(h), 1, 32, signed)
    return table(spark, d, "embeddings").select("vec_id", word(low).alias("low"), word(F.lit("F" * 64)).alias("high"), word(_word(-1 - F.col("vec_id")), True).alias("below"))


# ---------------------------------------------------------------- joins and increments: C3, D17, D19, D31, E5, F24, I6, J18, K6, K7, K11


@query(f"WITH {LEGS} SELECT tx, leg FROM legs WHERE taker IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000) OR tx_from IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)")
def membership_rows(spark, d):
    """Rows with either of two columns in a set, once each however many of them match."""
    keys = table(spark, d, "supplier").where("s_acctbal > 5000").select(F.col("s_suppkey").alias("key"))
    legs = leg_trades(spark, d)
    return fold.member_of_any(legs, ["taker", "tx_from"], keys, "key", ["tx", "leg", "taker", "tx_from"]).select("tx", "leg")


@query(f"WITH {LEGS}, o AS (SELECT s_suppkey AS a, min(s_nationkey) AS fid FROM supplier WHERE s_acctbal > 0 GROUP BY 1) SELECT tx, leg, CASE WHEN x.fid IS NULL AND y.fid IS NOT NULL THEN tx_from ELSE taker END AS address, CAST(coalesce(x.fid, y.fid) AS BIGINT) AS fid FROM legs LEFT JOIN o x ON taker = x.a LEFT JOIN o y ON tx_from = y.a")
def resolve_keep_either(spark, d):
    """Two candidate wallets; unresolved rows stay with their first one."""
    owners = table(spark, d, "supplier").where("s_acctbal > 0").groupBy(F.col("s_suppkey").alias("address")).agg(F.min(F.col("s_nationkey").cast("bigint")).alias("fid"))
    return resolve.attach_account(leg_trades(spark, d).select("tx", "leg", "taker", "tx_from"), owners, ["taker", "tx_from"], keep_unresolved=True).select("tx", "leg", "address", "fid")


@query(f"""WITH v AS (SELECT {A('token_address')} AS token, chain_id, CAST(sum(CAST(amount_usd AS DECIMAL(28,4))) AS DOUBLE) AS volume_usd FROM trades GROUP BY 1, 2), r AS (SELECT {A('token_address')} AS token, chain_id, min(platform) AS platform FROM tokens GROUP BY 1, 2)
    SELECT token, chain_id, platform, volume_usd FROM r JOIN v USING (token, chain_id) WHERE volume_usd >= 2000""")
def registry_volumes(spark, d):
    """Registered tokens with their volumes, above the gate."""
    volumes = table(spark, d, "trades").groupBy(address("token_address").alias("token"), "chain_id").agg(fold.money("amount_usd").alias("volume_usd"))
    reg = table(spark, d, "tokens").groupBy(address("token_address").alias("token"), "chain_id").agg(F.min("platform").alias("platform"))
    return reg.join(volumes.where("volume_usd >= 2000"), ["token", "chain_id"])


@query("""WITH h AS (SELECT page_id AS fid, '@' || lower(regexp_extract(title, '[A-Za-z]+')) AS handle FROM documents WHERE regexp_extract(title, '[A-Za-z]+') <> '' GROUP BY ALL),
    w AS (SELECT DISTINCT doc_id, page_id, unnest(regexp_extract_all(lower('@' || editor || ' and @' || regexp_extract(title, '[A-Za-z]+')), '(@[\\w.-]*\\w)')) AS handle FROM documents WHERE editor IS NOT NULL)
    SELECT doc_id, h.fid AS brand FROM w JOIN h USING (handle) WHERE h.fid <> w.page_id""")
def mention_handles(spark, d):
    """Posts whose mentions are not resolved: the text is searched for handles."""
    word = F.regexp_extract("title", "[A-Za-z]+", 0)
    docs = table(spark, d, "documents")
    brands = docs.select(F.col("page_id").alias("fid"), word.alias("name")).where("name <> ''").distinct()
    posts = docs.where("editor is not null").select("doc_id", F.col("page_id").alias("author"), F.concat(F.lit("@"), F.col("editor"), F.lit(" and @"), word).alias("body"), F.array().cast("array<bigint>").alias("ids"))
    return pivot.mentions(posts, brands, "body", "name", "ids", "author").select("doc_id", "brand")


@query("""SELECT doc_id, CASE WHEN contains(lower(text), lower(title)) THEN 'address' WHEN 'u' || (doc_id % 3) = 'u1' OR lower(source) = 'u1' THEN 'parent_url'
    WHEN length(trim(editor)) >= 3 AND contains(lower(text), '$' || lower(trim(editor))) THEN 'ticker' END AS matched_on FROM documents WHERE title IS NOT NULL""")
def cast_classify(spark, d):
    """How a post names a token: by address, by the url it answers, by ticker; the first that holds."""
    docs = table(spark, d, "documents").where("title is not null").withColumn("url", F.concat(F.lit("U"), (F.col("doc_id") % 3).cast("string")))
    return docs.select("doc_id", clean.cast_match("text", "url", "source", F.lower("title"), F.col("editor"), F.lit("u1")).alias("matched_on"))


@query(f"WITH {P7}, f AS (SELECT record_id, utc_us FROM zoned WHERE source_table = 'hyperliquid_info') SELECT {A('address')} AS address, min(utc_us) AS first_us, count(*) AS ledger_event_count FROM hyperliquid_info LEFT JOIN f ON update_id = record_id GROUP BY 1")
def ledger_first_seen(spark, d):
    """First activity and number of ledger events per wallet, whatever the notation of their times."""
    rows = instants.utc_instants(table(spark, d, "hyperliquid_info").select("update_id", "address", "time"), "time")
    return rows.groupBy(address("address").alias("address")).agg(F.min("utc_us").alias("first_us"), F.count("*").alias("ledger_event_count"))


@query(f"""SELECT {A('token_address')} AS token, chain_id, author_fid AS fid, timestamp AS engaged_at, 'authored' AS engagement FROM token_casts WHERE author_fid IS NOT NULL AND timestamp IS NOT NULL
    UNION ALL SELECT c.token, c.chain_id, e.engager_fid, e.engaged_at, 'reaction' FROM (SELECT DISTINCT {A('token_address')} AS token, chain_id, author_fid FROM token_casts WHERE author_fid IS NOT NULL) c
      JOIN brand_engagements e ON e.brand_fid = c.author_fid WHERE e.engaged_at IS NOT NULL AND e.engager_fid IS NOT NULL AND e.engager_fid <> c.author_fid""", ("engaged_at",))
def authored_and_reactions(spark, d):
    """Everybody who wrote about a token or reacted to its authors, as one list of engagements."""
    casts = table(spark, d, "token_casts").where("author_fid is not null").select(address("token_address").alias("token"), "chain_id", "author_fid", "timestamp")
    own = casts.where("timestamp is not null").select("token", "chain_id", F.col("author_fid").alias("fid"), F.col("timestamp").alias("engaged_at"), F.lit("authored").alias("engagement"))
    reactions = table(spark, d, "brand_engagements").where("engaged_at is not null and engager_fid is not null").select(F.col("brand_fid").alias("author_fid"), "engager_fid", "engaged_at")
    reacted = casts.select("token", "chain_id", "author_fid").distinct().join(reactions, "author_fid").where("engager_fid <> author_fid")
    return own.unionByName(reacted.select("token", "chain_id", F.col("engager_fid").alias("fid"), "engaged_at", F.lit("reaction").alias("engagement")))


@query(f"SELECT {A('token_address')} AS token, count(*) AS n_casts, min(timestamp) AS first_at FROM token_casts WHERE timestamp >= TIMESTAMPTZ '2025-05-27 00:00:00+00' GROUP BY 1", ("first_at",))
def attribution_lookback(spark, d):
    """Casts of a window that starts one attribution window before the purchases."""
    rows = warehouse.bounded(table(spark, d, "token_casts"), "timestamp", SINCE.replace(month=5, day=27))
    return rows.groupBy(address("token_address").alias("token")).agg(F.count("*").alias("n_casts"), F.min("timestamp").alias("first_at"))


@query(f"SELECT t.chain_id, count(*) AS n FROM trades t SEMI JOIN (SELECT DISTINCT {A('token_address')} AS a, chain_id AS c FROM tokens) r ON {A('t.token_address')} = r.a AND t.chain_id = r.c WHERE block_time >= TIMESTAMPTZ '2025-06-01 00:00:00+00' GROUP BY 1")
def windowed_against_registry(spark, d):
    """A window of trades against the whole registry: only the event side is bounded in time."""
    recent = warehouse.bounded(table(spark, d, "trades"), "block_time", SINCE).select(address("token_address").alias("token"), "chain_id")
    return recent.join(table(spark, d, "tokens").select(address("token_address").alias("token"), "chain_id"), ["token", "chain_id"], "left_semi").groupBy("chain_id").agg(F.count("*").alias("n"))


@query(f"SELECT {A('address')} AS address, chain_id, count(*) AS tx_count, count(*) FILTER (block_time >= TIMESTAMPTZ '2025-06-01 00:00:00+00') AS new_count, min(block_time) AS first_tx_at FROM trades GROUP BY 1, 2", ("first_tx_at",))
def lifetime_and_window(spark, d):
    """Lifetime figures recomputed from the start beside the events of the window, in one scan."""
    new = F.unix_micros("block_time") >= F.lit(1748736000000000)  # 2025-06-01 UTC
    return table(spark, d, "trades").groupBy(address("address").alias("address"), "chain_id").agg(F.count("*").alias("tx_count"), F.count_if(new).alias("new_count"), F.min("block_time").alias("first_tx_at"))


# ---------------------------------------------------------------- payloads: E4, E6, J28


def _users(spark: SparkSession, d: str) -> DataFrame:
    """One user per account version in the shape of a social interface: one verified address, spelled loudly."""
    owned = address("custody_address")
    loud = F.when(owned.isNotNull(), F.array(F.upper(owned)))
    return table(spark, d, "accounts").select(
        "fid", "username", "display_name", "follower_count", "following_count", F.col("neynar_score").alias("score"), F.when(F.col("fid") % 2 == 0, owned).alias("custody_address"),
        F.struct(loud.alias("eth_addresses"), F.when(F.col("fid") % 3 == 0, F.array(F.concat(F.lit("So"), F.col("fid").cast("string")))).alias("sol_addresses"), F.struct(owned.alias("eth_address"), F.lit(None).cast("string").alias("sol_address")).alias("primary")).alias("verified_addresses"),
    ).distinct()


@query(f"""SELECT DISTINCT fid, {A('custody_address')} AS address, 'eth' AS protocol, true AS is_primary, 'verified' AS source FROM accounts WHERE custody_address IS NOT NULL
    UNION ALL SELECT DISTINCT fid, 'So' || fid, 'sol', false, 'verified' FROM accounts WHERE fid % 3 = 0""")
def user_wallet_rows(spark, d):
    """Wallets of social users: verified beats custody, hex without case, base58 with it."""
    return payloads.user_wallets(_users(spark, d))


@query(f"SELECT DISTINCT fid, {A('custody_address')} AS address FROM accounts WHERE custody_address IS NOT NULL")
def user_hex_wallets(spark, d):
    return payloads.hex_wallets(_users(spark, d)).distinct()


@query("""SELECT rec_id, name, symbol, TRY_CAST(CASE WHEN json_valid(related) THEN related::JSON->>'$.user.username' END AS VARCHAR) AS username FROM clanker_tokens_page1
    WHERE json_valid(related) AND json_type(related::JSON) = 'OBJECT' AND json_type(related::JSON, '$.user') = 'OBJECT'""")
def launchpad_items(spark, d):
    """Launchpad items with an object in an object, as delivered, by an explicit schema."""
    rows = table(spark, d, "clanker_tokens_page1").withColumn("v", F.try_parse_json("related"))
    kind = F.schema_of_variant(F.try_variant_get("v", "$.user", "variant"))
    return rows.where(F.startswith(kind, F.lit("OBJECT"))).select("rec_id", "name", "symbol", F.try_variant_get("v", "$.user.username", "string").alias("username"))


# ---------------------------------------------------------------- products: P1, P3-P6, P8, P11


@query(f"WITH {_MAP}, w AS (SELECT m.address, m.fid FROM m WHERE m.fid IN (SELECT fid FROM brand_accounts) OR m.fid % 7 = 0) SELECT w.fid, {A('t.address')} AS address, chain_id, count(*) AS tx_count, min(block_time) AS first_tx_at, max(block_time) AS last_tx_at FROM trades t JOIN w ON {A('t.address')} = w.address GROUP BY 1, 2, 3", ("first_tx_at", "last_tx_at"))
def product_builders(spark, d):
    wallets = _wallets(spark, d)
    seeds = table(spark, d, "brand_accounts").select("fid").unionByName(wallets.where("fid % 7 = 0").select("fid"))
    activity = table(spark, d, "trades").select(address("address").alias("address"), "chain_id", F.col("block_time").alias("at"))
    return products.builder_activity(seeds, wallets, activity)["builder_activity"]


_BRAND_ROWS = f"""SELECT engager_fid, brand_fid, trim(regexp_replace(lower({sql_strip('engagement')}), '[^\\p{{L}}\\p{{N}}]+', '.', 'g'), '.') AS engagement_type, coalesce({sql_strip('cast_hash')}, '') AS cast_hash, coalesce({sql_strip('target_cast_hash')}, '') AS target_cast_hash, engaged_at FROM brand_engagements WHERE engager_fid <> brand_fid"""


@query(f"SELECT engager_fid, brand_fid, engagement_type, cast_hash, target_cast_hash, max(engaged_at) AS timestamp FROM ({_BRAND_ROWS}) WHERE engagement_type <> '' GROUP BY 1, 2, 3, 4, 5", ("timestamp",))
def product_brand_events(spark, d):
    t = table(spark, d, "brand_engagements")
    posts, given = table(spark, d, "token_casts").withColumn("channel_id", F.col("chain_id")), table(spark, d, "attributions").withColumn("channel_id", F.col("chain_id"))
    return products.brand_engagement(t, table(spark, d, "brand_accounts"), posts, given)["brand_engagements"]


@query(f"""WITH {_MAP}, n AS (SELECT {A('token_address')} AS token_address, chain_id, {A('deployer_address')} AS deployer_address, CASE WHEN regexp_full_match({A('fee_recipient_address')}, '0x[0-9a-f]{{40}}') THEN {A('fee_recipient_address')} END AS fee_recipient_address, name, deployed_at
      FROM tokens QUALIFY row_number() OVER (PARTITION BY {A('token_address')}, chain_id ORDER BY deployed_at DESC NULLS LAST, token_row_id) = 1)
    SELECT n.*, a.fid, b.fid AS fee_recipient_fid FROM n LEFT JOIN m a ON deployer_address = a.address LEFT JOIN m b ON fee_recipient_address = b.address""", ("deployed_at",))
def product_launch_tokens(spark, d):
    api = table(spark, d, "tokens").select(address("token_address").alias("token_address"), "chain_id", address("deployer_address").alias("deployer_address"), valid_address("fee_recipient_address").alias("fee_recipient_address"), "name", "deployed_at", "token_row_id", "fid", "fee_recipient_fid")
    return products.launch_tokens(api, None, _wallets(spark, d), "token_row_id")


_HEX = lambda p, c: F.concat(F.lit(f"0x{p}"), F.lpad(F.lower(F.hex(c)), 39, "0"))
_HEX_SQL = lambda p, c: f"'0x{p}' || lpad(lower(printf('%x', {c})), 39, '0')"
_OWNERS = f"ow AS (SELECT {_HEX_SQL('a', 's_suppkey')} AS address, min(s_nationkey)::BIGINT AS fid FROM supplier GROUP BY 1)"


def _owners(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").groupBy(_HEX("a", F.col("s_suppkey")).alias("address")).agg(F.min(F.col("s_nationkey").cast("bigint")).alias("fid"))


_HELD = f"""{LEGS}, {_OWNERS}, mv AS (SELECT bought AS token, {_HEX_SQL('a', 'tx_from')} AS holder, CAST(amount AS HUGEINT) * 1000000000000000000 AS v, block_time FROM legs UNION ALL SELECT bought, {_HEX_SQL('a', 'taker')}, -CAST(amount AS HUGEINT) * 1000000000000000000, block_time FROM legs),
    g AS (SELECT token, holder, sum(v) AS raw, max(block_time) AS last_activity_at FROM mv WHERE token IN (SELECT n_nationkey FROM nation) GROUP BY 1, 2)"""


@query(f"WITH {_HELD} SELECT fid, address, token AS token_address, CAST(CAST(raw AS VARCHAR) AS DOUBLE) / 1e18 AS balance, CAST(raw AS VARCHAR) AS balance_raw, last_activity_at FROM g JOIN ow ON holder = address WHERE raw > 0", ("last_activity_at",))
def product_holdings(spark, d):
    legs = leg_trades(spark, d)
    transfers = legs.select(F.col("bought").alias("token"), _HEX("a", F.col("taker")).alias("sender"), _HEX("a", F.col("tx_from")).alias("receiver"), F.concat(F.col("amount").cast("string"), F.lit("0" * 18)).alias("value"), F.col("block_time").alias("at"))
    index = table(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("token_address"))
    out = products.holdings(transfers, index, _owners(spark, d), index.select(F.col("token_address").alias("token"), F.lit(18).alias("decimals")))
    return out.withColumn("last_activity_at", F.col("last_activity_at").cast("timestamp"))


@query(f"""WITH {_OWNERS}, l AS (SELECT {_HEX_SQL('b', 'l_partkey % 50')} AS vault, {_HEX_SQL('a', 'l_suppkey')} AS owner, l_orderkey AS tx, CAST(l_quantity AS BIGINT) AS a, CAST(floor(l_extendedprice) AS BIGINT) AS s, l_shipdate AS ts FROM lineitem WHERE l_partkey % 50 < 20)
    SELECT fid, address, vault AS vault_address, tx AS tx_hash, CAST(sum(a) AS VARCHAR) AS assets_raw, CAST(sum(s) AS VARCHAR) AS shares_raw, CAST(CAST(sum(a) AS VARCHAR) AS DOUBLE) / 1e6 AS assets, min(ts) AS block_time FROM l JOIN ow ON owner = address GROUP BY 1, 2, 3, 4""", ("block_time",))
def product_vault_deposits(spark, d):
    topic = lambda c: F.unhex(F.concat(F.lit("00" * 12), F.substring(c, 3, 40)))
    lines = table(spark, d, "lineitem")
    logs = lines.select(
        _HEX("b", F.col("l_partkey") % 50).alias("contract_address"), topic(_HEX("c", F.col("l_suppkey"))).alias("topic1"), topic(_HEX("a", F.col("l_suppkey"))).alias("topic2"),
        F.unhex(F.concat(_word(F.col("l_quantity").cast("bigint")), _word(F.floor("l_extendedprice").cast("bigint")))).alias("data"), F.col("l_orderkey").alias("tx_hash"), F.col("l_shipdate").cast("timestamp").alias("block_time"),
    )
    vaults = spark.range(20).select(_HEX("b", F.col("id")).alias("vault_address"), F.lit(6).alias("decimals"))
    return products.vault_deposits(logs, vaults, _owners(spark, d))


@query(f"""WITH {_OWNERS}, pools AS (SELECT p_partkey AS pool, p_partkey % 40 AS token0, p_size % 40 AS token1 FROM part),
    e AS (SELECT l_partkey AS pool, CASE WHEN l_returnflag = 'R' THEN 'burn' ELSE 'mint' END AS event, {_HEX_SQL('a', 'l_suppkey')} AS actor, CAST(l_quantity AS BIGINT) / 10.0::DOUBLE AS amount0, CAST(l_quantity AS BIGINT) / 10.0::DOUBLE AS amount1, l_orderkey AS tx, l_shipdate AS ts FROM lineitem),
    f AS (SELECT DISTINCT pool, t FROM (SELECT pool, token0 AS t FROM pools UNION ALL SELECT pool, token1 FROM pools) WHERE t IN (SELECT n_nationkey FROM nation))
    SELECT fid, address, e.pool, t AS token, event, tx AS tx_hash, round(CAST(sum(CAST(amount0 AS DECIMAL(28,4))) AS DOUBLE), 4) AS amount0, round(CAST(sum(CAST(amount1 AS DECIMAL(28,4))) AS DOUBLE), 4) AS amount1, min(ts) AS block_time
    FROM e JOIN f ON e.pool = f.pool JOIN ow ON actor = address GROUP BY 1, 2, 3, 4, 5, 6""", ("block_time",))
def product_lp_events(spark, d):
    pools = table(spark, d, "part").select(F.col("p_partkey").alias("pool"), (F.col("p_partkey") % 40).alias("token0"), (F.col("p_size") % 40).cast("bigint").alias("token1"))
    lines = table(spark, d, "lineitem")
    events = lines.select(F.col("l_partkey").alias("pool"), F.when(F.col("l_returnflag") == "R", "burn").otherwise("mint").alias("event"), _HEX("a", F.col("l_suppkey")).alias("actor"), F.col("l_quantity").cast("bigint").alias("amount0"), F.col("l_quantity").cast("bigint").alias("amount1"), F.col("l_orderkey").alias("tx_hash"), F.col("l_shipdate").cast("timestamp").alias("block_time"))
    index = table(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("token_address"))
    decimals = pools.select(F.explode(F.array("token0", "token1")).alias("token")).distinct().withColumn("decimals", F.lit(1))
    return products.lp_events(events, pools, index, decimals, _owners(spark, d))


@query(f"""WITH {_LINES}, c AS (SELECT o_orderkey AS tx, o_custkey AS sender FROM orders), o AS (SELECT o_orderkey AS tx, l_linenumber AS op_index, l_partkey AS launcher FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_linenumber % 2 = 0 GROUP BY ALL),
    nx AS (SELECT tx, arg_min(launcher, (op_index, launcher)) AS launcher FROM o WHERE op_index > 1 AND tx IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 1) GROUP BY 1),
    fee AS (SELECT tx, beneficiary FROM (SELECT *, row_number() OVER (PARTITION BY tx ORDER BY share DESC, pair_no) AS i FROM p WHERE tx % 5 <> 0) WHERE i = 1)
    SELECT tx, {_HEX_SQL('d', 'tx')} AS token, launcher, beneficiary AS fee_recipient, sender, coalesce(launcher, sender) AS deployer, CASE WHEN launcher IS NOT NULL THEN 'user_op' WHEN sender IS NOT NULL THEN 'tx_sender' ELSE 'none' END AS source
    FROM c LEFT JOIN nx USING (tx) LEFT JOIN fee USING (tx)""")
def product_launches(spark, d):
    """The whole launch chain: created tokens' first logs, the next operation, the greatest fee share, the sender."""
    orders, lines = table(spark, d, "orders"), table(spark, d, "lineitem")
    token = _HEX("d", F.col("tx"))
    creations = orders.select(F.col("o_orderkey").alias("tx")).withColumn("token", token)
    logs = lines.where("l_linenumber = 1").select(F.col("l_orderkey").alias("tx"), F.col("l_linenumber").alias("idx")).withColumn("contract", token)
    ops = lines.where("l_linenumber % 2 = 0").select(F.col("l_orderkey").alias("tx"), F.col("l_linenumber").alias("op_index"), F.col("l_partkey").alias("launcher"))
    fees = _pair_logs(spark, d).withColumn("topic", F.unhex(F.concat(F.lit("00" * 12), F.substring(token, 3, 40)))).select("topic", "data")
    return products.launches(logs, creations, ops, fees, orders.select(F.col("o_orderkey").alias("tx"), F.col("o_custkey").alias("sender")))


@query(f"""WITH x AS (SELECT {A('address')} AS address, count(*) AS n, max(CAST(trim(usdc) AS VARCHAR)) AS v FROM hyperliquid_info GROUP BY 1) SELECT address, coalesce(try_cast(v AS DOUBLE), 0) AS cum_volume_usd, n AS ledger_event_count, coalesce(try_cast(v AS DOUBLE), 0) > 0 OR n > 0 AS has_hl_activity FROM x WHERE address IS NOT NULL""")
def product_exchange_activity(spark, d):
    """Two recorded answers per wallet, junk volumes as 0, and the flag of any activity."""
    wallets = table(spark, d, "hyperliquid_info").groupBy(address("address").alias("address")).agg(F.count("*").alias("n"), F.max(F.trim("usdc")).alias("v"))
    ledger = F.to_json(F.transform(F.sequence(F.lit(1), F.col("n").cast("int")), lambda i: F.struct(i.cast("bigint").alias("time"), F.lit("h").alias("hash"))))
    answers = wallets.select("address", F.to_json(F.struct(F.col("v").alias("cumVlm"))).alias("rate"), ledger.alias("ledger"))
    targets = wallets.select("address", F.lit(None).cast("bigint").alias("fid"))
    none = spark.createDataFrame([], "address string, fid bigint, cum_volume_usd double, first_activity_at timestamp, ledger_event_count int, checked_at timestamp")
    out = products.exchange_activity(targets, answers, none.select("address"), none, F.lit("2025-01-01").cast("timestamp"))
    return out.select("address", "cum_volume_usd", F.col("ledger_event_count").cast("bigint").alias("ledger_event_count"), "has_hl_activity")
