"""Paged interfaces as a Spark data source, and batched look-ups per key.

One partition per chain of cursors (a start value), so chains are read in parallel and each row is one item as JSON text;
items are then shaped by :mod:`tallyloom.sources.payloads`. The transport is a parameter: ``file`` reads recorded pages,
``http`` asks a server. A limiter and a retry policy guard every call.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path
from urllib.error import HTTPError, URLError
from urllib.parse import urlencode
from urllib.request import Request, urlopen

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tallyloom.session import cut, ship
from tallyloom.sources import files
from tallyloom.sources.runs import Run

#: Answers after which a call is worth repeating.
RETRYABLE = (408, 425, 429, 500, 502, 503, 504)


class Failed(Exception):
    """An answer that is no success; ``wait`` is how long the server asks to wait, if it does."""

    def __init__(self, status: int, wait: float | None = None) -> None:
        super().__init__(f"status {status}")
        self.status, self.wait = status, wait


@dataclass
class Policy:
    """Calls are at least ``spacing`` seconds apart; retryable failures back off exponentially."""

    spacing: float = 0.0
    attempts: int = 5
    base: float = 0.5
    most: float = 60.0
    sleep: Callable[[float], None] = time.sleep
    last: float = 0.0

    def call(self, fetch: Callable[[], dict]) -> dict:
        for attempt in range(self.attempts):
            gap = self.last + self.spacing - time.monotonic()
            if gap > 0:
                self.sleep(gap)
            self.last = time.monotonic()
            try:
                return fetch()
            except Failed as e:
                if e.status not in RETRYABLE or attempt == self.attempts - 1:
                    raise
                self.sleep(min(self.most, e.wait if e.wait is not None else self.base * 2**attempt))
        raise AssertionError("unreachable")


def dig(value: object, path: str) -> object:
    """The member at a dotted path, or None."""
    for name in filter(None, path.split(".")):
        value = value.get(name) if isinstance(value, dict) else None
    return value


def pages(fetch: Callable[[str | None], dict], cursor_path: str, policy: Policy, max_pages: int | None = None) -> Iterator[dict]:
    """Pages until there is no next cursor, a cursor comes again, or ``max_pages`` are read."""
    cursor, seen, n = None, set(), 0
    while max_pages is None or n < max_pages:
        page = policy.call(lambda c=cursor: fetch(c))
        yield page
        n += 1
        cursor = dig(page, cursor_path)
        if cursor in (None, "") or cursor in seen:
            return
        seen.add(cursor)
        cursor = str(cursor)


def file_transport(root: str, path: str, start: str) -> Callable[[str | None], dict]:
    """Recorded pages: ``root/path/[start.]first.json``, then ``root/path/[start.]<cursor>.json``."""

    def fetch(cursor: str | None) -> dict:
        p = Path(root) / path / f"{start + '.' if start else ''}{cursor or 'first'}.json"
        if not p.exists():
            raise Failed(404)
        return json.loads(p.read_text())

    return fetch


def http_transport(root: str, path: str, start: str, params: dict[str, str], headers: dict[str, str], start_name: str, cursor_name: str) -> Callable[[str | None], dict]:
    def fetch(cursor: str | None) -> dict:
        query = params | ({start_name: start} if start else {}) | ({cursor_name: cursor} if cursor else {})
        try:
            with urlopen(Request(f"{root.rstrip('/')}/{path}?{urlencode(query)}", headers=headers), timeout=60) as r:  # noqa: S310
                return json.load(r)
        except HTTPError as e:
            wait = e.headers.get("Retry-After", "")
            raise Failed(e.code, float(wait) if wait.isdigit() else None) from e
        except URLError as e:
            raise Failed(503) from e

    return fetch


class _Chain(InputPartition):
    pass


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.o = options

    def partitions(self) -> Sequence[InputPartition]:
        return [_Chain(s) for s in self.o.get("starts", "").split(",")]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        o, start = self.o, partition.value
        sub = lambda p: {k[len(p):]: v for k, v in o.items() if k.startswith(p)}
        if o.get("transport", "file") == "file":
            fetch = file_transport(o["root"], o["resource"], start)
        else:
            fetch = http_transport(o["root"], o["resource"], start, sub("param."), sub("header."), o.get("startname", "start"), o.get("cursorname", "cursor"))
        limit = int(o["maxpages"]) if "maxpages" in o else None
        for n, page in enumerate(pages(fetch, o.get("cursorpath", "next.cursor"), Policy(float(o.get("spacing", 0))), limit)):
            for i, item in enumerate(dig(page, o.get("itemspath", "items")) or []):
                yield start, n, i, json.dumps(item)


class PagedSource(DataSource):
    """``spark.read.format("paged").option(...)``: chain, page_no, item_no, item.

    Options: transport, root, resource, starts (comma-separated chains), itemsPath, cursorPath, maxPages, spacing,
    startName, cursorName, param.*, header.*.
    """

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "chain string, page_no int, item_no int, item string"

    def reader(self, schema: object) -> DataSourceReader:
        return _Reader({k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(PagedSource)


def read_items(spark: SparkSession, shape: str, since: tuple[str, str] | None = None, **options: object) -> DataFrame:
    """Items under a schema, each once however many pages repeat it; with ``since`` (column, time) older ones are left
    out and items without a time are kept."""
    register(spark)
    reader = spark.read.format("paged")
    for k, v in options.items():
        reader = reader.option(k, str(v))
    items = reader.load().select(F.from_json("item", shape).alias("i")).select("i.*").distinct()
    if since is None:
        return items
    at = F.col(since[0]).try_cast("timestamp")
    return items.where(at.isNull() | (at >= F.lit(since[1]).cast("timestamp")))


def look_up(keys: DataFrame, key: str, fetch: Callable[[list], list[dict]], schema: str, batch: int = 100, policy: Policy | None = None) -> tuple[DataFrame, DataFrame]:
    """Answers for distinct keys, asked in batches where the keys lie, and the keys that got none because a call failed.

    ``fetch`` gets a list of keys and returns rows; every call keeps the policy's spacing and is repeated as it says,
    and status 404 is an answer without rows. Each partition spaces its own calls: for a rate over all of them,
    coalesce the keys. The answers are checkpointed, so nothing is asked twice; the second frame (key, reason) is empty
    where the result is whole.
    """
    ship(keys.sparkSession)
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    policy = policy or Policy()

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            values = b[key].tolist()
            for i in range(0, len(values), batch):
                part = values[i : i + batch]
                try:
                    rows, reason = policy.call(lambda part=part: fetch(part)), None
                except Failed as e:
                    rows, reason = [], None if e.status == 404 else str(e)
                answers = [(json.dumps({n: r.get(n) for n in names}, default=str), None, None) for r in rows]
                yield pd.DataFrame(answers + ([(None, str(k), reason) for k in part] if reason else []), columns=["answer", "failed_key", "reason"])

    asked = cut(keys.select(key).dropna().distinct().mapInPandas(ask, "answer string, failed_key string, reason string"))
    found = asked.where("answer is not null").select(F.from_json("answer", schema).alias("a")).select("a.*")
    return found, asked.where("reason is not null").select(F.col("failed_key").alias(key), "reason")


def account_ranges(spark: SparkSession, start: int, end: int, fetch: Callable[[list], list[dict]], schema: str, batch: int = 100, empty: int = 25, policy: Policy | None = None) -> DataFrame:
    """Accounts of a range of ids, in batches; a partition's chain of batches ends after ``empty`` batches without one."""
    ship(spark)
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    policy = policy or Policy()

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        idle = 0
        for b in batches:
            ids = b["id"].tolist()
            for i in range(0, len(ids), batch):
                if idle >= empty:
                    return
                rows = policy.call(lambda part=ids[i : i + batch]: fetch(part))
                idle = 0 if rows else idle + 1
                yield pd.DataFrame([[r.get(n) for n in names] for r in rows], columns=names)

    return spark.range(start, end + 1).mapInPandas(walk, schema)


def truncated(items: DataFrame, since: str, at: str, max_pages: int) -> DataFrame:
    """chain, is_truncated: chains of a newest-first feed that ended at the page cap before the window was covered.

    items: chain, page_no and the time of each item. A chain is whole if it has fewer pages than the cap, or an item
    older than ``since`` (text that cannot be read as a time is no proof of it).
    """
    when = F.col(at).try_cast("timestamp")
    covered = F.max((when < F.lit(since).cast("timestamp")).cast("int"))
    return items.groupBy("chain").agg(((F.max("page_no") + 1 >= max_pages) & (F.coalesce(covered, F.lit(0)) == 0)).alias("is_truncated"))


def crawl(run: Run, table: str, targets: DataFrame, key: str, step: Callable[[DataFrame], DataFrame], batches: int = 16) -> DataFrame:
    """Apply ``step`` to the targets that the open run has no row for, appending batch by batch.

    An interrupted crawl is resumed by calling it again on the unsealed run: keys already written are skipped. The
    table is read back, one row per key.
    """
    spark, path = targets.sparkSession, f"{run.path}/{table}"
    for b in range(batches):
        todo = targets.where(F.pmod(F.xxhash64(key), F.lit(batches)) == b)
        if files.exists(path):
            todo = todo.join(spark.read.parquet(path).select(key), key, "left_anti")
        run.write(step(todo), table, mode="append")
    return spark.read.parquet(path).dropDuplicates([key])
