"""SQL text over a folder of tables, look-ups in the catalogue, and scans bounded on the partition column."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Chains by id.
CHAINS = {1: "ethereum", 10: "optimism", 56: "bnb", 137: "polygon", 8453: "base", 42161: "arbitrum", 4663: "robinhood"}


def register(spark: SparkSession, root: str, names: Sequence[str]) -> None:
    """Temporary views of tables in a folder, one Parquet file or folder each."""
    for n in names:
        spark.read.parquet(f"{root}/{n}.parquet").createOrReplaceTempView(n)


def run_sql(spark: SparkSession, text: str, limit: int | None = None, args: Mapping[str, object] | None = None) -> DataFrame:
    """The rows of a statement, at most ``limit`` of them; values go in as named parameters, never as text."""
    rows = spark.sql(text, args=dict(args or {}))
    return rows if limit is None else rows.limit(limit)


def peek(spark: SparkSession, root: str, name: str, n: int = 5) -> DataFrame:
    """Some rows of a table."""
    return spark.read.parquet(f"{root}/{name}.parquet").limit(n)


def columns_of(spark: SparkSession, root: str, names: Sequence[str]) -> DataFrame:
    """table_name, column_name, position of every column of the tables, from their footers alone."""
    rows = [(n, f.name, i) for n in names for i, f in enumerate(spark.read.parquet(f"{root}/{n}.parquet").schema.fields)]
    return spark.createDataFrame(rows, "table_name string, column_name string, position int")


def bounded(df: DataFrame, at: str, since: datetime, until: datetime | None = None, month: str | None = None, day: str | None = None) -> DataFrame:
    """Rows of a time window, with the same bounds on the partition column (first of the month, or day), so that only
    the partitions of the window are read."""
    start = since.astimezone(UTC)
    out = df.where(F.col(at) >= F.lit(start))
    if month:
        out = out.where(F.col(month) >= F.lit(date(start.year, start.month, 1)))
    if day:
        out = out.where(F.col(day) >= F.lit(start.date()))
    if until is not None:
        end = until.astimezone(UTC)
        out = out.where(F.col(at) < F.lit(end))
        if month:
            out = out.where(F.col(month) <= F.lit(end.date()))
        if day:
            out = out.where(F.col(day) <= F.lit(end.date()))
    return out


def coverage(chains: DataFrame, trades: DataFrame, chain: str = "chain_id") -> DataFrame:
    """chain, covered: whether a chain has any trade at all, by one distinct of the chains that trade."""
    traded = trades.select(F.col(chain)).distinct().withColumn("covered", F.lit(True))
    return chains.select(chain).distinct().join(traded, chain, "left").fillna(False, ["covered"])


def chain_ids(wanted: Sequence[str], home: int, known: Mapping[int, str] = CHAINS) -> list[int]:
    """The chains of a run: the home chain always, others by id, by name, or ``all``; an unknown one raises."""
    by_name = {v: k for k, v in known.items()}
    out = {home}
    for w in wanted:
        key = w.strip().lower()
        if key == "all":
            out |= set(known)
        elif key in by_name or (key.isdigit() and int(key) in known):
            out.add(by_name.get(key) or int(key))
        else:
            raise ValueError(f"unknown chain {w}")
    return sorted(out)


def chain_name(chain: int, known: Mapping[int, str] = CHAINS) -> str:
    return known.get(chain, f"chain {chain}")


# Validators of values that end up in a statement or a path.


def hex_literal(text: str, digits: int = 40) -> str:
    """An address or hash in lower case; anything else raises."""
    low = text.strip().lower()
    if not re.fullmatch(rf"0x[0-9a-f]{{{digits}}}", low):
        raise ValueError(f"no hex value of {digits} digits: {text!r}")
    return low


def time_literal(at: datetime | str) -> str:
    """An instant in UTC with its zone; a naive time counts as UTC, a text that is none raises."""
    at = datetime.fromisoformat(at) if isinstance(at, str) else at
    at = at.replace(tzinfo=UTC) if at.tzinfo is None else at.astimezone(UTC)
    return at.isoformat(sep=" ", timespec="seconds")


def name_literal(text: str) -> str:
    """An identifier of letters, digits and underscores; anything else raises."""
    if not re.fullmatch(r"[A-Za-z_]\w*", text):
        raise ValueError(f"no plain name: {text!r}")
    return text


def chunked(values: Sequence[object], size: int) -> list[list[object]]:
    """Lists of at most ``size`` values; an engine that needs literals takes them so, joins need none."""
    return [list(values[i : i + size]) for i in range(0, len(values), size)]


def call_plan(legs: Mapping[str, tuple[int, int]], per_second: float) -> list[tuple[str, int, float]]:
    """name, calls and seconds of each leg of a crawl (items, items a call), and of all together, before it is run."""
    rows = [(name, -(-items // each)) for name, (items, each) in legs.items()]
    return [(n, c, round(c / per_second, 1)) for n, c in [*rows, ("all", sum(c for _, c in rows))]]


def duration(seconds: float) -> str:
    """Hours, minutes and seconds as people write them: ``1h 02m 03s``, ``2m 03s``, ``3s``."""
    whole = max(0, round(seconds))
    h, m, s = whole // 3600, whole % 3600 // 60, whole % 60
    return f"{h}h {m:02d}m {s:02d}s" if h else f"{m}m {s:02d}s" if m else f"{s}s"
