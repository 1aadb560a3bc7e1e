"""Queries p2, p4, p8, p9 and p10 over whole tables, with the DuckDB statements that check them where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import ZERO_ADDRESS, sql_strip
from tallyloom.llm import leakage, nearest, packing, pii, survivors
from tallyloom.session import cut, table

_KEYS = ("token_address", "chain_id")
_FIELDS = ("name", "fee_recipient_address", "source")
TOLERANCE_US = 20 * 60 * 1_000_000


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """The rows that supply the values with the largest sums of votes, under weights that dominate each other."""
    won = survivors.winners(survivors.token_votes(table(spark, d, "tokens")), _KEYS)
    return won.where("n_rows >= 2 and value is not null").select(*_KEYS, "field", F.col("row_id").alias("token_row_id"))


def p2_survivors(spark: SparkSession, d: str) -> DataFrame:
    """One record per contract by summed votes: trust, halved for every 90 days of age."""
    won = survivors.winners(survivors.token_votes(table(spark, d, "tokens"), with_source=True), _KEYS, half_life_days=90.0)
    return survivors.survivors(won, _KEYS, _FIELDS)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    buys = table(spark, d, "buys").select(F.col("buy_id").alias("row_id"), F.col("fid").alias("entity"), F.col("block_time").alias("at"))
    casts = table(spark, d, "token_casts").select(F.col("cast_hash").alias("ref"), F.col("author_fid").alias("entity"), F.col("timestamp").alias("at"))
    return nearest.nearest_matches(buys, casts, TOLERANCE_US).select(F.col("row_id").alias("buy_id"), F.col("ref").alias("cast_hash"))


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return packing.containers(packing.sizes(docs), docs.count())


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """Whether the packing is complete, whole and tight: at most 1 % and one container a shard above the fewest possible."""
    docs = table(spark, d, "documents")
    n = docs.count()
    measured = cut(packing.sizes(docs))
    report = packing.fill_report(packing.containers(measured, n), measured)
    spare = F.col("n_least") * 1.01 + max(1, round(n / packing.SHARD_DOCS))
    return report.select("n_docs", "n_missing", "n_overfull", "n_split", "n_torn", (F.col("n_containers") <= spare).alias("is_tight"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Verbatim stretches of twelve words: of what the edit matching finds, the pairs at distance 0."""
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_passages")).where("distance = 0").select("doc_id", "item_id")


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leak_report(leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_passages")))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.find(table(spark, d, "documents"))


def p10_redacted(spark: SparkSession, d: str) -> DataFrame:
    return pii.redact(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p2_found, p2_survivors, p4_found, p8_containers, p8_fill, p9_found, p9_report, p10_found, p10_redacted)}

_S = sql_strip
_FILL = ", ".join(f"'{w}'" for w in survivors.FILLERS)
_TRUST = "CASE lower(" + _S("source") + ") " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in survivors.TRUST.items()) + " ELSE 1 END"
_VOTES = f"""
WITH b AS (SELECT lower({_S('token_address')}) AS token_address, chain_id, token_row_id, coalesce({_TRUST}, 1) AS trust, ingested_at,
    CASE WHEN lower({_S('name')}) NOT IN ({_FILL}) AND NOT regexp_full_match({_S('name')}, '[[:punct:][:space:]]*') THEN {_S('name')} END AS name,
    CASE WHEN lower({_S('source')}) NOT IN ({_FILL}) AND NOT regexp_full_match({_S('source')}, '[[:punct:][:space:]]*') THEN {_S('source')} END AS source,
    CASE WHEN regexp_full_match(lower({_S('fee_recipient_address')}), '0x[0-9a-f]{{40}}') AND lower({_S('fee_recipient_address')}) <> '{ZERO_ADDRESS}'
      THEN lower({_S('fee_recipient_address')}) END AS fee_recipient_address
  FROM tokens WHERE token_address IS NOT NULL AND chain_id IS NOT NULL),
v AS (SELECT token_address, chain_id, 'name' AS field, name AS value, token_row_id, trust, ingested_at FROM b
  UNION ALL SELECT token_address, chain_id, 'fee_recipient_address', fee_recipient_address, token_row_id, trust, ingested_at FROM b),
vs AS (SELECT * FROM v UNION ALL SELECT token_address, chain_id, 'source', source, token_row_id, trust, ingested_at FROM b)
"""
_DECAYED = """, g AS (SELECT token_address, chain_id, field, count(*) AS n, max(ingested_at) FILTER (value IS NOT NULL) AS newest FROM vs GROUP BY ALL),
s AS (SELECT token_address, chain_id, field, lower(value) AS shape, printf('%.11e', sum(trust * pow(0.5, (epoch_us(newest) - epoch_us(ingested_at)) / (86400000000.0 * 90))))::DOUBLE AS size,
    max({t: trust, a: ingested_at, r: token_row_id}) AS best, arg_max(value, {t: trust, a: ingested_at, r: token_row_id}) AS value
  FROM vs JOIN g USING (token_address, chain_id, field) WHERE value IS NOT NULL GROUP BY ALL),
w AS (SELECT *, row_number() OVER (PARTITION BY token_address, chain_id, field ORDER BY size DESC, best.a DESC, best.r DESC) AS i FROM s)
SELECT token_address, chain_id, max(n) AS n_rows, max(value) FILTER (field = 'name') AS name, max(best.r) FILTER (field = 'name') AS name_row_id,
  max(value) FILTER (field = 'fee_recipient_address') AS fee_recipient_address, max(best.r) FILTER (field = 'fee_recipient_address') AS fee_recipient_address_row_id,
  max(value) FILTER (field = 'source') AS source, max(best.r) FILTER (field = 'source') AS source_row_id
FROM g LEFT JOIN (SELECT * FROM w WHERE i = 1) USING (token_address, chain_id, field) GROUP BY token_address, chain_id"""
SQL = {
    "p2_found": _VOTES
    + """SELECT token_address, chain_id, field, token_row_id FROM (
        SELECT *, count(*) OVER (PARTITION BY token_address, chain_id, field) AS n,
          row_number() OVER (PARTITION BY token_address, chain_id, field ORDER BY value IS NULL, trust DESC, ingested_at DESC, token_row_id DESC) AS i FROM v)
        WHERE i = 1 AND n >= 2 AND value IS NOT NULL""",
    "p2_survivors": _VOTES + _DECAYED,
    "p8_fill": "SELECT count(*) AS n_docs, 0 AS n_missing, 0 AS n_overfull, 0 AS n_split, 0 AS n_torn, true AS is_tight FROM documents",
    "p4_found": """
        WITH j AS (SELECT b.buy_id, c.cast_hash, abs(epoch_us(c.timestamp) - epoch_us(b.block_time)) AS gap, c.timestamp AS at_time
          FROM buys b JOIN token_casts c ON b.fid = c.author_fid AND c.timestamp BETWEEN b.block_time - INTERVAL 20 MINUTE AND b.block_time + INTERVAL 20 MINUTE)
        SELECT buy_id, cast_hash FROM (SELECT *, row_number() OVER (PARTITION BY buy_id ORDER BY gap, at_time, cast_hash) AS i FROM j) WHERE i = 1""",
}
