"""Logical tables over the driver's tables, as DataFrames and as DuckDB text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import address, sql_strip
from tallyloom.session import table

TOKENS = 50


def A(c: str) -> str:  # noqa: N802
    return f"lower({sql_strip(c)})"


def plain(df: DataFrame) -> DataFrame:
    """Instants as microseconds since 1970 and days as text, which compare alike in every engine."""
    kinds = dict(df.dtypes)
    as_us = {c: F.unix_micros(c) for c, t in kinds.items() if t == "timestamp"}
    return df.withColumns(as_us | {c: F.col(c).cast("string") for c, t in kinds.items() if t == "date"})


def plain_sql(sql: str, times: tuple[str, ...] = (), days: tuple[str, ...] = ()) -> str:
    parts = [f"epoch_us({c}) AS {c}" for c in times] + [f"CAST({c} AS VARCHAR) AS {c}" for c in days]
    return f"SELECT * REPLACE ({', '.join(parts)}) FROM ({sql})" if parts else sql


def leg_trades(spark: SparkSession, d: str) -> DataFrame:
    """Trade legs: order lines with taker, sender and a bought and a sold token."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    usd = F.col("l_extendedprice").cast("decimal(18,2)") * (1 - F.col("l_discount").cast("decimal(6,2)"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("tx"), F.col("l_linenumber").alias("leg"), F.col("l_suppkey").alias("taker"), F.col("o_custkey").alias("tx_from"),
        (F.col("l_partkey") % TOKENS).alias("bought"), (F.col("l_partkey") * 7 % 11 + F.col("l_suppkey") % TOKENS).alias("sold"), usd.alias("usd"),
        F.col("l_quantity").cast("bigint").alias("amount"), F.col("o_orderdate").alias("block_time"),
    )


LEGS = f"""legs AS (SELECT l_orderkey AS tx, l_linenumber AS leg, l_suppkey AS taker, o_custkey AS tx_from, l_partkey % {TOKENS} AS bought,
  l_partkey * 7 % 11 + l_suppkey % {TOKENS} AS sold, CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(6,2))) AS usd,
  CAST(l_quantity AS BIGINT) AS amount, o_orderdate AS block_time FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def wallets(spark: SparkSession, d: str) -> DataFrame:
    """Wallets of customers and suppliers; an address may have both owners."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("address"), F.col("c_nationkey").cast("bigint").alias("fid"), (F.col("c_acctbal") > 0).alias("is_primary"), F.lit("verified").alias("source"), F.col("c_acctbal").alias("score"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("address"), F.col("s_nationkey").cast("bigint").alias("fid"), (F.col("s_acctbal") > 500).alias("is_primary"), F.lit("custody").alias("source"), F.col("s_acctbal").alias("score"))
    return c.unionByName(s)


WALLETS = """wallets AS (SELECT c_custkey AS address, CAST(c_nationkey AS BIGINT) AS fid, c_acctbal > 0 AS is_primary, 'verified' AS source, c_acctbal AS score FROM customer
  UNION ALL SELECT s_suppkey, CAST(s_nationkey AS BIGINT), s_acctbal > 500, 'custody', s_acctbal FROM supplier)"""


def event_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))


EVENTS = "ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"


def custody(spark: SparkSession, d: str) -> DataFrame:
    """address, fid, score of every loaded account version that has a custody address."""
    return table(spark, d, "accounts").where("custody_address is not null").select(address("custody_address").alias("address"), "fid", F.col("neynar_score").alias("score"), "ingested_at")


CUSTODY = f"custody AS (SELECT {A('custody_address')} AS address, fid, neynar_score AS score, ingested_at FROM accounts WHERE custody_address IS NOT NULL)"
OWNERS = CUSTODY + ", owners AS (SELECT address, min(fid) AS fid FROM custody GROUP BY 1)"
