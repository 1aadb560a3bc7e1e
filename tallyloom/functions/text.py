"""Scalar normalisers for text, addresses and numbers that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that count as surrounding blanks.
BLANKS = " \t\n\r\x0b\x0c "
#: Shapes of addresses and hashes.
ADDRESS = "^0x[0-9a-f]{40}$"
ZERO_ADDRESS = "0x" + "0" * 40


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """The text without surrounding blanks, tabs or line breaks; null stays null."""
    return F.btrim(col(c), F.lit(BLANKS))


def address(c: Column | str) -> Column:
    """One spelling for every spelling of an address: trimmed and in lower case."""
    return F.lower(strip(c))


def valid_address(c: Column | str) -> Column:
    """The normalised address, or null where the text is none."""
    a = address(c)
    return F.when(a.rlike(ADDRESS), a)


def blank_to_null(c: Column | str) -> Column:
    s = strip(c)
    return F.when(s != "", s)


def number(c: Column | str) -> Column:
    return strip(c).try_cast("double")


def whole(c: Column | str) -> Column:
    """A whole number from text such as ``42`` or ``42.0``; null where it is none."""
    d = strip(c).try_cast("decimal(38,6)")
    return F.when(d == F.floor(d), d).try_cast("bigint")


def utc_month(c: Column | str) -> Column:
    """``yyyy-MM`` of an instant in UTC, whatever the session's zone."""
    day = F.date_from_unix_date(F.floor(F.unix_micros(col(c)) / 86_400_000_000).cast("int"))
    return F.date_format(day, "yyyy-MM")


def sql_strip(c: str) -> str:
    """The same trimming for a DuckDB statement."""
    return f"trim({c}, ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12) || chr(160))"
