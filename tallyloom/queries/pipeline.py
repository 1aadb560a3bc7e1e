"""Queries p1, p3, p5, p6 and p7 over whole tables, with the DuckDB statements that check them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import address, blank_to_null, sql_strip, utc_month
from tallyloom.operators import features, heavykeys, instants, nested, references
from tallyloom.queries.views import plain, plain_sql
from tallyloom.session import cut, table

#: Candidate offset histories of feeds that do not name their zone.
ZONES = ("UTC", "America/New_York", "America/Los_Angeles", "Europe/Berlin", "Asia/Kolkata", "Australia/Sydney")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    tokens = table(spark, d, "tokens").select(address("token_address").alias("token"), "chain_id", F.col("ingested_at").alias("seen_at"), F.lit(None).cast("timestamp").alias("deleted_at"))
    accounts = table(spark, d, "accounts").select("fid", F.col("ingested_at").alias("seen_at"), "deleted_at")
    seen = F.col("ingested_at").alias("seen_at")
    buys = table(spark, d, "buys").select(F.col("buy_id").alias("row_id"), address("token_address").alias("token"), "chain_id", seen)
    attributions = table(spark, d, "attributions").select(F.col("attribution_id").alias("row_id"), F.col("author_fid").alias("fid"), seen)
    deployments = table(spark, d, "deployments").select(F.col("deployment_id").alias("row_id"), "fid", seen)
    by_token, by_fid = references.known_parents(tokens, ["token", "chain_id"]), references.known_parents(accounts, ["fid"])
    children = (("buys", buys, by_token, ["token", "chain_id"]), ("attributions", attributions, by_fid, ["fid"]), ("deployments", deployments, by_fid, ["fid"]))
    found = [references.orphan_rows(refs, known, keys).withColumn("ref_table", F.lit(name)) for name, refs, known, keys in children]
    rows = reduce(DataFrame.unionByName, found)
    return rows.select("ref_table", "row_id", utc_month("seen_at").alias("period"), "reason")


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return references.orphan_report(p1_found(spark, d))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Keys with at least 4 % of all rows, counted among those on which the selection operator's ranks fall."""
    trades = table(spark, d, "trades").select(address("token_address").alias("k"))
    tokens = table(spark, d, "tokens").select(F.col("chain_id").cast("string").alias("k"))
    parts = [heavykeys.heavy_keys(df, "k").select(F.lit(name).alias("source_table"), "key_value") for name, df in (("trades", trades), ("tokens", tokens))]
    return parts[0].unionByName(parts[1])


def p3_quantiles(spark: SparkSession, d: str) -> DataFrame:
    trades = table(spark, d, "trades").select(address("token_address").alias("token"), "amount_usd")
    return heavykeys.quantiles(trades, "token", "amount_usd", (0.5, 0.9)).withColumnRenamed("key_value", "token_address")


def p3_chains(spark: SparkSession, d: str) -> DataFrame:
    """Quantiles of the time of loading (microseconds since 1970) for every chain; doubles hold them exactly."""
    tokens = table(spark, d, "tokens").select(F.col("chain_id"), F.unix_micros("ingested_at").alias("us"))
    out = heavykeys.quantiles(tokens, "chain_id", "us", (0.5, 0.9))
    return out.select(F.col("key_value").alias("chain_id"), "prob", "n_rows", F.col("quantile").cast("bigint").alias("ingested_us"))


#: The objects that the queries take out of the payloads: table, id, and the targets by name.
_CLANKER = {
    "related.user.fid": nested.Target("related", ["user"], {"fid": ("fid", nested.fid_text)}),
    "pool_config.pairedToken": nested.Target("pool_config", [], {"paired_token": ("pairedToken", nested.address_text)}),
}
_BANKR = {"deployer.walletAddress": nested.Target("payload", ["launches", "deployer"], {"wallet": ("walletAddress", nested.address_text)})}


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    clanker = nested.values_at(table(spark, d, "clanker_tokens_page1"), "clanker_tokens_page1", "rec_id", _CLANKER)
    return clanker.unionByName(nested.values_at(table(spark, d, "bankr_token_launches"), "bankr_token_launches", "page_id", _BANKR))


def p5_users(spark: SparkSession, d: str) -> DataFrame:
    """Users of launchpad items as a child table: the item's id, the user's position and the user's scalars."""
    user = nested.Target("related", ["user"], {"fid": ("fid", nested.fid_text), "username": ("username", blank_to_null)})
    return nested.flat_tables(table(spark, d, "clanker_tokens_page1"), "rec_id", {"users": user})["users"]


def p5_launches(spark: SparkSession, d: str) -> DataFrame:
    """Launches with the wallets of their deployers, joined on the keys that the two child tables share."""
    launches = nested.Target("payload", ["launches"], {"token_address": ("tokenAddress", nested.address_text), "token_name": ("tokenName", blank_to_null)})
    deployers = nested.Target("payload", ["launches", "deployer"], {"wallet": ("walletAddress", nested.address_text)})
    t = nested.flat_tables(table(spark, d, "bankr_token_launches"), "page_id", {"launches": launches, "deployers": deployers})
    by = t["deployers"].select("record_id", F.col("parent_no").alias("item_no"), F.col("item_no").alias("deployer_no"), "wallet")
    return t["launches"].join(by, ["record_id", "item_no"], "left").withColumnRenamed("item_no", "launch_no").drop("parent_no")


def _events(spark: SparkSession, d: str) -> DataFrame:
    """Distinct events in two parts by brand: all deliveries of an event name the same brand, so none is in both."""
    rows = table(spark, d, "brand_engagements")
    events = features.distinct_events(rows, "engager_fid", "engagement", ("brand_fid", "cast_hash", "target_cast_hash"), "engaged_at", "weight")
    return events.withColumn("part", F.pmod(F.xxhash64("same_0"), F.lit(2)))


def _vectors(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The merged vectors of every engager and the index of kinds. The table is read once."""
    counts = cut(features.kind_counts(_events(spark, d)))
    index = cut(features.kind_index(counts))
    return features.merge_vectors(features.entity_vectors(counts, index)), index


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return features.long_features(*_vectors(spark, d)).select(F.col("entity").alias("engager_fid"), F.col("kind").alias("engagement"), F.col("n").alias("n_events"))


def p6_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Count, total and latest time of every kind an engager has."""
    long = features.long_features(*_vectors(spark, d)).withColumnsRenamed({"entity": "engager_fid", "kind": "engagement", "n": "n_events"})
    return plain(long)


def p6_features(spark: SparkSession, d: str) -> DataFrame:
    """One row per engager with the columns of every kind in the table; only the names of the kinds are collected."""
    vectors, index = _vectors(spark, d)
    kinds = [r["kind"] for r in index.orderBy("kind_no").collect()]
    return plain(features.wide_features(vectors, kinds).withColumnRenamed("entity", "engager_fid"))


def _texts(spark: SparkSession, d: str) -> DataFrame:
    """The delivered times of all three tables in one frame: read and parsed once."""
    part = lambda name, key, text, zone, seen: table(spark, d, name).select(F.lit(name).alias("source_table"), F.col(key).alias("record_id"), F.col(text).alias("text"), zone.cast("string").alias("feed_tz"), seen.cast("timestamp").alias("seen_at"))
    none = F.lit(None)
    parts = [
        part("deployments", "deployment_id", "deployed_at", F.col("feed_tz"), F.col("ingested_at")),
        part("hyperliquid_info", "update_id", "time", none, none),
        part("clanker_tokens_page1", "rec_id", "created_at", none, F.col("fetched_at")),
    ]
    return reduce(DataFrame.unionByName, parts)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Each table is a feed: what its rows leave open is read under the offset history estimated for the feed."""
    rows = instants.utc_instants(_texts(spark, d), "text", "feed_tz", "source_table", "seen_at", ZONES)
    return rows.where("utc_us is not null").select("source_table", "record_id", "utc_us")


def p7_feeds(spark: SparkSession, d: str) -> DataFrame:
    """Violations of each candidate offset per declared feed of deployments, over all periods."""
    rows = instants.read_instants(table(spark, d, "deployments").select("deployed_at", "feed_tz", "ingested_at"), "deployed_at").where("offset_min is null and wall_us is not null")
    errors = instants.feed_errors(rows, "feed_tz", "ingested_at", ZONES)
    return errors.groupBy("feed", "zone").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_wrong").alias("n_wrong"))


QUERIES = {f.__name__: f for f in (p1_found, p1_report, p3_found, p3_quantiles, p3_chains, p5_found, p5_users, p5_launches, p6_found, p6_features, p6_kinds, p7_found, p7_feeds)}

_A = lambda c: f"lower({sql_strip(c)})"
_P1 = f"""
WITH tk AS (SELECT {_A('token_address')} AS token, chain_id, min(ingested_at) AS first_seen FROM tokens GROUP BY ALL),
ac AS (SELECT fid, min(ingested_at) AS first_seen, min(deleted_at) AS gone_at FROM accounts GROUP BY ALL),
r AS (
  SELECT 'buys' AS ref_table, buy_id AS row_id, b.ingested_at AS seen, t.first_seen, NULL::TIMESTAMPTZ AS gone_at
  FROM buys b LEFT JOIN tk t ON {_A('b.token_address')} = t.token AND b.chain_id = t.chain_id WHERE b.token_address IS NOT NULL AND b.chain_id IS NOT NULL
  UNION ALL
  SELECT 'attributions', attribution_id, x.ingested_at, a.first_seen, a.gone_at FROM attributions x LEFT JOIN ac a ON x.author_fid = a.fid WHERE x.author_fid IS NOT NULL
  UNION ALL
  SELECT 'deployments', deployment_id, x.ingested_at, a.first_seen, a.gone_at FROM deployments x LEFT JOIN ac a ON x.fid = a.fid WHERE x.fid IS NOT NULL),
f AS (SELECT ref_table, row_id, strftime(seen::TIMESTAMP, '%Y-%m') AS period,
  CASE WHEN first_seen IS NULL THEN 'missing' WHEN first_seen > seen THEN 'late' WHEN gone_at <= seen THEN 'deleted' END AS reason FROM r)
"""
_P6 = f"""
WITH k AS (SELECT engager_fid, brand_fid, trim(regexp_replace(lower({sql_strip('engagement')}), '[^\\p{{L}}\\p{{N}}]+', '.', 'g'), '.') AS engagement,
  coalesce({sql_strip('cast_hash')}, '') AS h1, coalesce({sql_strip('target_cast_hash')}, '') AS h2, engaged_at, weight FROM brand_engagements),
e AS (SELECT engager_fid, engagement, max(engaged_at) AS last_at, max(weight) AS w FROM k
  WHERE engager_fid IS NOT NULL AND engagement <> '' GROUP BY engager_fid, brand_fid, engagement, h1, h2)
"""
#: Payloads opened by recursion: a text that is JSON, the elements of an array, the member one level down.
_P5 = """WITH RECURSIVE src AS (
  SELECT 'clanker_tokens_page1' AS raw_table, rec_id AS record_id, 'related.user.fid' AS path, ['user'] AS names, 'fid' AS member, related AS txt FROM clanker_tokens_page1
  UNION ALL SELECT 'clanker_tokens_page1', rec_id, 'pool_config.pairedToken', []::VARCHAR[], 'pairedToken', pool_config FROM clanker_tokens_page1
  UNION ALL SELECT 'bankr_token_launches', page_id, 'deployer.walletAddress', ['launches', 'deployer'], 'walletAddress', payload FROM bankr_token_launches),
o AS (SELECT raw_table, record_id, path, names, member, 0 AS lvl, 0::BIGINT AS up, 0::BIGINT AS pos, true AS single, txt::JSON AS v FROM src WHERE json_valid(txt)
  UNION ALL SELECT raw_table, record_id, path, names, member, c.lvl, c.up, c.pos, c.single, c.v FROM (SELECT *, unnest(CASE
    WHEN json_type(v) = 'VARCHAR' AND json_valid(v->>'$') THEN [{lvl: lvl, up: up, pos: pos, single: single, v: CAST(v->>'$' AS JSON)}]
    WHEN json_type(v) = 'ARRAY' THEN list_transform(range(json_array_length(v)::BIGINT), lambda i: {lvl: lvl, up: up, pos: CASE WHEN single THEN i ELSE pos END, single: false, v: json_extract(v, '$[' || i || ']')})
    WHEN json_type(v) = 'OBJECT' AND lvl < len(names) THEN [{lvl: lvl + 1, up: pos, pos: 0::BIGINT, single: true, v: json_extract(v, '$.' || names[lvl + 1])}] END) AS c FROM o)),
leaves AS (SELECT *, CASE WHEN json_type(v, '$.' || member) NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN v->>('$.' || member) END AS leaf FROM o WHERE lvl = len(names) AND json_type(v) = 'OBJECT')"""


def _p7_sql() -> str:
    """The same reading in DuckDB: the notations are shared, dates, clocks, numbers and zones are DuckDB's own."""
    names = ("y", "mo", "dd", "hh", "mi", "ss", "fr", "ap", "zn")
    esc = lambda p: p.replace("'", "''")
    part = lambda p, g: f"regexp_extract(t, '{esc(p)}', {g})" if g else "''"
    cases = " ".join(f"WHEN regexp_matches(t, '{esc(p)}') THEN {{" + ", ".join(f"'{n}': {part(p, g)}" for n, g in zip(names, groups, strict=True)) + "}" for p, groups in instants.NOTATIONS)
    month = "CASE WHEN regexp_matches(p.mo, '^[0-9]') THEN try_cast(p.mo AS INT) ELSE (position(p.mo[1:3] IN 'janfebmaraprmayjunjulaugsepoctnovdec') + 2) // 3 END"
    words = " ".join(f"WHEN '{n}' THEN {v}" for n, v in instants.ABBREVIATIONS.items())
    number = " ".join(f"WHEN x >= {lo} * {s}::DECIMAL(38,9) AND x < {hi} * {s}::DECIMAL(38,9) THEN CAST(floor({e}) AS BIGINT)" for s, lo, hi, e in ((1_000_000_000, 1_672_531_200, 1_830_297_600, "CAST(trunc(x) AS HUGEINT) // 1000"), (1_000_000, 1_672_531_200, 1_830_297_600, "x"), (1_000, 1_672_531_200, 1_830_297_600, "x * 1000"), (1, 1_672_531_200, 1_830_297_600, "x * 1000000")))
    wall = "make_timestamp(w) AT TIME ZONE z"
    twice = " OR ".join(f"(({wall}) {sign} INTERVAL {m} MINUTE) AT TIME ZONE z = make_timestamp(w)" for m in (30, 60, 120) for sign in "+-")
    return f"""r AS (SELECT 'deployments' AS source_table, deployment_id AS record_id, deployed_at AS txt, nullif({sql_strip('feed_tz')}, '') AS tz, ingested_at AS seen FROM deployments
  UNION ALL SELECT 'hyperliquid_info', update_id, time, NULL, NULL FROM hyperliquid_info UNION ALL SELECT 'clanker_tokens_page1', rec_id, created_at, NULL, fetched_at FROM clanker_tokens_page1),
t0 AS (SELECT *, lower(regexp_replace({sql_strip('txt')}, '\\s+', ' ', 'g')) AS t FROM r),
t1 AS (SELECT *, CASE {cases} END AS p, CASE WHEN regexp_matches(t, '^[0-9]+([.][0-9]*)?(e[+]?[0-9]+)?$') THEN try_cast(t AS DECIMAL(38,9)) END AS x FROM t0),
t2 AS (SELECT *, {month} AS m, try_cast(p.hh AS INT) AS h0, coalesce(try_cast(p.mi AS INT), 0) AS mi, coalesce(try_cast(p.ss AS INT), 0) AS s, regexp_replace(p.zn, '^(utc|gmt)|:', '', 'g') AS g FROM t1),
t3 AS (SELECT *, CASE WHEN p.hh = '' THEN 0 WHEN p.ap = '' THEN h0 WHEN h0 BETWEEN 1 AND 12 THEN h0 % 12 + CASE WHEN p.ap = 'pm' THEN 12 ELSE 0 END END AS h, try_cast(p.y || '-' || lpad(m::VARCHAR, 2, '0') || '-' || lpad(p.dd, 2, '0') AS DATE) AS day,
  CASE WHEN regexp_matches(p.zn, '[+-]') THEN CASE WHEN try_cast(g[2:3] AS INT) * 60 + coalesce(try_cast(nullif(g[4:5], '') AS INT), 0) <= 840 AND coalesce(try_cast(nullif(g[4:5], '') AS INT), 0) < 60
    THEN (CASE WHEN g[1] = '-' THEN -1 ELSE 1 END) * (try_cast(g[2:3] AS INT) * 60 + coalesce(try_cast(nullif(g[4:5], '') AS INT), 0)) END ELSE CASE p.zn {words} END END AS off FROM t2),
t4 AS (SELECT source_table, record_id, tz, seen, CASE WHEN p IS NULL THEN CASE WHEN x IS NOT NULL THEN 0 END ELSE off END AS off, CASE WHEN p IS NULL THEN CASE {number} END
  WHEN (p.zn = '' OR off IS NOT NULL) AND h < 24 AND mi < 60 AND s < 60 THEN epoch_us(day::TIMESTAMP) + (h * 3600 + mi * 60 + s)::BIGINT * 1000000 + coalesce(try_cast(rpad(p.fr[1:6], 6, '0') AS BIGINT), 0) END AS w FROM t3),
t5 AS (SELECT *, coalesce(tz, 'UTC') AS z FROM t4 WHERE w IS NOT NULL),
zoned AS (SELECT *, CASE WHEN off IS NOT NULL THEN w - off::BIGINT * 60000000 WHEN z = 'UTC' THEN w
  WHEN ({wall}) AT TIME ZONE z = make_timestamp(w) AND NOT ({twice}) THEN epoch_us({wall}) END AS utc_us FROM t5),
tried AS (SELECT tz AS feed, seen, w, unnest([{', '.join(f"'{z}'" for z in ZONES)}]) AS z FROM t4 WHERE source_table = 'deployments' AND off IS NULL AND w IS NOT NULL AND seen IS NOT NULL),
lags AS (SELECT feed, z AS zone, CASE WHEN ({wall}) AT TIME ZONE z = make_timestamp(w) AND NOT ({twice}) THEN epoch_us(seen) - epoch_us({wall}) END AS lag FROM tried)"""


P7 = _p7_sql()
SQL = {
    "p1_found": _P1 + "SELECT ref_table, row_id, period, reason FROM f WHERE reason IS NOT NULL",
    "p1_report": _P1 + "SELECT ref_table, period, reason, count(*) AS n_rows FROM f WHERE reason IS NOT NULL GROUP BY ALL",
    "p3_found": f"""
        SELECT 'trades' AS source_table, {_A('token_address')} AS key_value FROM trades WHERE token_address IS NOT NULL GROUP BY 2 HAVING count(*) * 25 >= (SELECT count(*) FROM trades)
        UNION ALL SELECT 'tokens', CAST(chain_id AS VARCHAR) FROM tokens WHERE chain_id IS NOT NULL GROUP BY 2 HAVING count(*) * 25 >= (SELECT count(*) FROM tokens)""",
    "p3_quantiles": f"""
        WITH r AS (SELECT {_A('token_address')} AS token_address, amount_usd AS v FROM trades WHERE amount_usd IS NOT NULL AND NOT isnan(amount_usd)),
        n AS (SELECT token_address, v, row_number() OVER (PARTITION BY token_address ORDER BY v) AS i, count(*) OVER (PARTITION BY token_address) AS n_rows FROM r),
        p AS (SELECT unnest([0.5::DOUBLE, 0.9::DOUBLE]) AS prob)
        SELECT token_address, prob, n_rows, v AS quantile FROM n, p WHERE i = greatest(1, ceil(prob * n_rows))""",
    "p3_chains": """
        WITH r AS (SELECT chain_id, epoch_us(ingested_at) AS v FROM tokens WHERE chain_id IS NOT NULL AND ingested_at IS NOT NULL),
        n AS (SELECT chain_id, v, row_number() OVER (PARTITION BY chain_id ORDER BY v) AS i, count(*) OVER (PARTITION BY chain_id) AS n_rows FROM r),
        p AS (SELECT unnest([0.5::DOUBLE, 0.9::DOUBLE]) AS prob)
        SELECT chain_id, prob, n_rows, v AS ingested_us FROM n, p WHERE i = greatest(1, ceil(prob * n_rows))""",
    "p5_found": f"""{_P5} SELECT DISTINCT raw_table, record_id, item_no, path, value FROM (
        SELECT raw_table, record_id, CAST(CASE len(names) WHEN 0 THEN pos WHEN 1 THEN CASE WHEN single THEN up ELSE pos END ELSE up END AS BIGINT) AS item_no, path,
          CASE WHEN member = 'fid' THEN CASE WHEN whole = floor(whole) THEN CAST(try_cast(whole AS BIGINT) AS VARCHAR) END ELSE nullif(lower({sql_strip('leaf')}), '') END AS value
        FROM (SELECT *, try_cast({sql_strip('leaf')} AS DECIMAL(38,6)) AS whole FROM leaves)) WHERE value IS NOT NULL""",
    "p5_users": f"""{_P5} SELECT record_id, up AS parent_no, pos AS item_no, CASE WHEN whole = floor(whole) THEN CAST(try_cast(whole AS BIGINT) AS VARCHAR) END AS fid, username
        FROM (SELECT *, try_cast({sql_strip('leaf')} AS DECIMAL(38,6)) AS whole, nullif({sql_strip("CASE WHEN json_type(v, '$.username') NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN v->>'$.username' END")}, '') AS username FROM leaves WHERE member = 'fid')""",
    "p5_launches": f"""{_P5},
        l AS (SELECT record_id, pos AS launch_no, nullif(lower({sql_strip("CASE WHEN json_type(v, '$.tokenAddress') NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN v->>'$.tokenAddress' END")}), '') AS token_address,
            nullif({sql_strip("CASE WHEN json_type(v, '$.tokenName') NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN v->>'$.tokenName' END")}, '') AS token_name
          FROM o WHERE member = 'walletAddress' AND lvl = 1 AND json_type(v) = 'OBJECT'),
        d AS (SELECT record_id, up AS launch_no, pos AS deployer_no, nullif(lower({sql_strip('leaf')}), '') AS wallet FROM leaves WHERE member = 'walletAddress')
        SELECT record_id, launch_no, token_address, token_name, deployer_no, wallet FROM l LEFT JOIN d USING (record_id, launch_no)""",
    "p7_found": f"WITH {P7} SELECT source_table, record_id, utc_us FROM zoned WHERE utc_us IS NOT NULL",
    "p7_feeds": f"WITH {P7} SELECT feed, zone, count(*) AS n_rows, count(*) FILTER (coalesce(lag NOT BETWEEN 0 AND 45 * 60000000::BIGINT, true)) AS n_wrong FROM lags GROUP BY ALL",
    "p6_found": _P6 + "SELECT engager_fid, engagement, count(*) AS n_events FROM e GROUP BY ALL",
    "p6_kinds": plain_sql(
        _P6
        + "SELECT engager_fid, engagement, count(*) AS n_events, round(CAST(sum(CAST(coalesce(w, 0) AS DECIMAL(30,6))) AS DOUBLE), 6) AS total, max(last_at) AS latest FROM e GROUP BY ALL",
        ("latest",),
    ),
}
