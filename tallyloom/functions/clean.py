"""Typed values from text cells: bad cells become null and are counted, never raised."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyloom.functions.text import address, blank_to_null, col, number, strip, whole
from tallyloom.plans.contract import KINDS

#: Words for "no value" in cells that are not text, and the spellings of truth.
NO_VALUE = ("nan", "none", "null", "nat", "<na>", "<nil>")
TRUE, FALSE = ("true", "t", "1", "yes", "y"), ("false", "f", "0", "no", "n")


def present(c: Column | str) -> Column:
    """The trimmed cell, or null where it is blank or a word for "no value"."""
    s = blank_to_null(c)
    return F.when(~F.lower(s).isin(*NO_VALUE), s)


def boolean(c: Column | str) -> Column:
    s = F.lower(present(c))
    return F.when(s.isin(*TRUE), True).when(s.isin(*FALSE), False)


def moment(c: Column | str) -> Column:
    """ISO-8601 in all its spellings, with Z, an offset or UTC; without a zone it is UTC. Null where it is none."""
    return F.regexp_replace(present(c), r"\s+UTC$", "Z").try_cast("timestamp")


def mixed_address(c: Column | str) -> Column:
    """Hex addresses in lower case; base58 addresses keep their case, and so does any word: only numbers know sentinels."""
    s = blank_to_null(c)
    return F.when(F.lower(s).startswith("0x"), F.lower(s)).otherwise(s)


def prefixed_address(c: Column | str) -> Column:
    """An address that may lack its 0x; null where it is none."""
    a = address(c)
    full = F.when(a.startswith("0x"), a).otherwise(F.concat(F.lit("0x"), a))
    return F.when(full.rlike("^0x[0-9a-f]{40}$"), full)


CLEANERS = {
    "bigint": lambda c: whole(present(c)),
    "double": lambda c: number(present(c)),
    "boolean": boolean,
    "timestamp": moment,
    "address": mixed_address,
    "hash": lambda c: F.lower(blank_to_null(c)),
    "string": blank_to_null,
}


def typed(df: DataFrame, required: tuple[str, ...] = (), overrides: dict[str, str] | None = None) -> DataFrame:
    """Every text column coerced by the type its name stands for. Missing required columns raise and are named."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    kinds = KINDS | (overrides or {})
    return df.select(*[CLEANERS[kinds.get(c, "string")](F.col(f"`{c}`")).alias(c) for c in df.columns])


def bad_cells(raw: DataFrame, clean: DataFrame, columns: list[str]) -> DataFrame:
    """How many cells held something that is no value of their type, per column, counted on typed copies."""
    pairs = [(F.col(f"`{c}`"), CLEANERS[KINDS.get(c, "string")](F.col(f"`{c}`"))) for c in columns]
    counted = raw.agg(*[F.count_if(present(a).isNotNull() & b.isNull()).alias(c) for c, (a, b) in zip(columns, pairs, strict=True)])
    return counted.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_bad")) for c in columns])))


def complete(df: DataFrame, columns: list[str], seen: Observation) -> DataFrame:
    """Rows with a value in every column; ``seen`` counts the others per column (n_<column>) while the rows are read."""
    counts = [F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in columns]
    return df.observe(seen, *counts).dropna(subset=columns)


def head(df: DataFrame, order: list[Column], limit: int) -> tuple[DataFrame, str | None]:
    """The first rows in an order, and a note of how many were left out, if any."""
    n = df.count()
    note = f"{n - limit} of {n} rows left out by the limit of {limit}" if n > limit else None
    return df.orderBy(*order).limit(limit), note


def contract(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """The columns of a contract in its order; absent ones are typed nulls."""
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in schema.items()])


def topic(c: Column | str) -> Column:
    """An address padded on the left to the 32 bytes of an event topic."""
    return F.unhex(F.concat(F.lit("00" * 12), F.substring(address(c), 3, 40)))


def hex_text(c: Column | str) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(col(c))))


def token_url(chain: Column | str, token: Column | str) -> Column:
    return F.concat(F.lit("eip155:"), col(chain).cast("string"), F.lit("/erc20:"), address(token))


def ticker(symbol: Column | str) -> Column:
    """The ticker as it is written in posts; symbols shorter than three characters have none."""
    s = strip(symbol)
    return F.when(F.length(s) >= 3, F.concat(F.lit("$"), F.lower(s)))


def cast_match(text: Column | str, parent_url: Column | str, root_url: Column | str, token: Column, symbol: Column, url: Column) -> Column:
    """How a post names a token: by address, by parent url, by ticker, else null; the first that holds."""
    low = F.lower(col(text))
    by_url = (F.lower(col(parent_url)) == F.lower(url)) | (F.lower(col(root_url)) == F.lower(url))
    return F.when(F.contains(low, token), "address").when(by_url, "parent_url").when(F.contains(low, ticker(symbol)), "ticker")
