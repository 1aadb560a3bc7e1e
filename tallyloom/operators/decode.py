"""Byte logs: guards, fields and arrays of pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import uint256
from tallyloom.functions.text import ZERO_ADDRESS

WORD = 32


def word_address(data: Column, start: int) -> Column:
    """The address in the low 20 bytes of the word at a 1-based place."""
    return F.concat(F.lit("0x"), F.lower(F.hex(F.substring(data, start + 12, 20))))


def pairs_guard(data: Column, base: int = 0) -> Column:
    """Whether data is (offset 32, length n, then n pairs of words) with more than ``base`` pairs."""
    offset_ok = F.hex(F.substring(data, 1, WORD)) == F.lit(f"{WORD:064X}")
    size = F.length(data)
    return offset_ok & (F.pmod(size - 2 * WORD, F.lit(2 * WORD)) == 0) & (size >= 2 * WORD + (base + 1) * 2 * WORD)


def address_shares(logs: DataFrame, data: str, base: int = 0) -> DataFrame:
    """One row per (address, share) pair of a well-formed array: pair_no, beneficiary, share_hex, share.

    ``share_hex`` has 64 digits, so its text order is the numeric order. Malformed data gives no row.
    """
    d = F.col(data)
    n = F.floor((F.length(d) - 2 * WORD) / (2 * WORD)).cast("int")
    rows = logs.where(pairs_guard(d, base)).withColumn("pair_no", F.explode(F.sequence(F.lit(base + 1), n)))
    at = 2 * WORD + (F.col("pair_no") - 1) * 2 * WORD + 1
    beneficiary = F.concat(F.lit("0x"), F.lower(F.hex(F.substring(d, at + 12, F.lit(20)))))
    return rows.withColumns({"beneficiary": beneficiary, "share_hex": F.hex(F.substring(d, at + WORD, F.lit(WORD)))})


def deposits(logs: DataFrame) -> DataFrame:
    """Vault deposits: sender and owner from topics 1 and 2, assets and shares from two words of data."""
    ok = logs.where((F.length("data") >= 2 * WORD) & F.col("topic1").isNotNull() & F.col("topic2").isNotNull())
    return ok.withColumns(
        {
            "sender": word_address(F.col("topic1"), 1),
            "owner": word_address(F.col("topic2"), 1),
            "assets_raw": uint256.from_bytes(F.col("data"), 1),
            "shares_raw": uint256.from_bytes(F.col("data"), WORD + 1),
        }
    )


def zero_as(address: Column, wrapped: str) -> Column:
    """The zero address stands for the wrapped native token."""
    return F.when(address == ZERO_ADDRESS, F.lit(wrapped)).otherwise(address)
