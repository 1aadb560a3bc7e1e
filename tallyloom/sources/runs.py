"""Runs on a file system: tables written into an open run, sealed by a manifest, read back by name.

A run exists for readers only once its manifest does. Watermarks are the newest event time written and never go back.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.clean import bad_cells, contract, typed
from tallyloom.operators.rank import keep_first
from tallyloom.plans.contract import schema
from tallyloom.sources import files

#: How far a window reads back behind the watermark, so that late rows are met again.
OVERLAP = timedelta(days=1)
_STAMP = "%Y%m%dT%H%M%SZ"


@dataclass(frozen=True)
class Window:
    since: datetime
    query_since: datetime
    is_backfill: bool
    source: str


def resolve_window(since: datetime | None, backfill: bool, watermark: datetime | None, start: datetime) -> Window:
    """An explicit start beats a backfill beats the watermark; without any there is no window."""
    if since is not None:
        return Window(since, since - OVERLAP, False, "since")
    if backfill:
        return Window(start, start, True, "backfill")
    if watermark is None:
        raise ValueError("no watermark yet: give a start or ask for a backfill")
    return Window(watermark, watermark - OVERLAP, False, "watermark")


def run_id(taken: Iterable[str], now: datetime | None = None) -> str:
    """A UTC second that no other run has."""
    at, names = (now or datetime.now(UTC)).replace(microsecond=0), set(taken)
    while at.strftime(_STAMP) in names:
        at += timedelta(seconds=1)
    return at.strftime(_STAMP)


def run_ids(root: str, data_type: str, sealed: bool = True) -> list[str]:
    base = f"{root}/{data_type}"
    names = [n for n in files.folders(base) if re.fullmatch(r"\d{8}T\d{6}Z", n)]
    return [n for n in names if files.exists(f"{base}/{n}/manifest.json") == sealed]


@dataclass
class Run:
    """An open run. Row counts are observed while a table is written, so no table is scanned twice."""

    root: str
    data_type: str
    name: str
    files: dict[str, int] = field(default_factory=dict)

    @property
    def path(self) -> str:
        return f"{self.root}/{self.data_type}/{self.name}"

    def write(self, df: DataFrame, table: str, schema: dict[str, str] | None = None, mode: str = "overwrite", fmt: str = "parquet") -> None:
        seen = Observation(table)
        (contract(df, schema) if schema else df).observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).format(fmt).save(f"{self.path}/{table}")
        self.files[table] = seen.get["n"] + (self.files.get(table, 0) if mode == "append" else 0)

    def seal(self, params: dict | None = None, since: datetime | None = None, new_watermark: datetime | None = None, notes: Sequence[str] = ()) -> dict:
        manifest = {
            "data_type": self.data_type, "run_ts": self.name, "generated_at": datetime.now(UTC).isoformat(), "generated_by": "tallyloom", "files": self.files, "row_total": sum(self.files.values()),
            "params": params or {}, "since": since and since.isoformat(), "new_watermark": new_watermark and new_watermark.isoformat(), "notes": list(notes),
        }
        files.write_text(f"{self.path}/manifest.json", json.dumps(manifest, indent=1))
        return manifest


def open_run(root: str, data_type: str, resume: bool = False) -> Run:
    """A new run, or the newest unsealed one."""
    pending = run_ids(root, data_type, sealed=False)
    if resume and pending:
        return Run(root, data_type, pending[-1])
    return Run(root, data_type, run_id([*pending, *run_ids(root, data_type)]))


def read_table(spark: SparkSession, root: str, data_type: str, table: str, columns: dict[str, str], run: str | None = None, required: bool = True) -> DataFrame:
    """A table of a sealed run (the latest by default) under its contract; absent and not required gives no rows."""
    runs = run_ids(root, data_type)
    name = run or (runs[-1] if runs else None)
    if name in runs:
        manifest = json.loads(files.read_text(f"{root}/{data_type}/{name}/manifest.json"))
        if table in manifest["files"]:
            return contract(spark.read.parquet(f"{root}/{data_type}/{name}/{table}"), columns)
    if required:
        raise FileNotFoundError(f"{data_type}/{table}: no sealed run has it")
    return spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in columns.items()))


def read_rows(spark: SparkSession, root: str, data_type: str, table: str, run: str | None = None, required: Sequence[str] = (), overrides: dict[str, str] | None = None, notes: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """A table of text cells of a sealed run, typed by its column names, and the number of bad cells per column.

    A missing required column raises and is named. Where no sealed run has the table, and ``notes`` is given, there are
    no rows under the contract's schema and a note says so; without ``notes`` that raises.
    """
    names = run_ids(root, data_type)
    name = run or (names[-1] if names else None)
    path = f"{root}/{data_type}/{name}/{table}"
    if name not in names or not files.exists(path):
        if notes is None:
            raise FileNotFoundError(f"{data_type}/{table}: no sealed run has it")
        notes.append(f"{data_type}/{table} is missing and counts as empty")
        none = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in schema(data_type, table)))
        return typed(none), bad_cells(none, none, none.columns)
    raw = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    return typed(raw, tuple(required), overrides), bad_cells(raw, raw, raw.columns)


def newest(df: DataFrame, *columns: str) -> DataFrame:
    """The newest time over columns, as one row; what cannot be parsed does not count."""
    return df.agg(F.max(F.greatest(*[F.col(c).try_cast("timestamp") for c in (columns * 2)[: max(2, len(columns))]])).alias("newest"))


class Watermarks:
    """One JSON document of newest event times; a time that is not newer, or none, changes nothing."""

    def __init__(self, path: str) -> None:
        self.path = str(path)

    def state(self) -> dict:
        return json.loads(files.read_text(self.path)) if files.exists(self.path) else {}

    def get(self, name: str) -> datetime | None:
        text = self.state().get(name)
        return datetime.fromisoformat(text) if text else None

    def advance(self, name: str, at: datetime | None) -> bool:
        now = self.get(name)
        if at is None or (now is not None and at <= now):
            return False
        files.write_text(self.path, json.dumps(self.state() | {name: at.isoformat()}))
        return True


def advance_all(marks: Watermarks, name: str, legs: dict[str, datetime | None], wanted: Sequence[str], degraded: Sequence[str] = ()) -> bool:
    """Advance only where every wanted leg was written and none was degraded."""
    if degraded or any(leg not in legs for leg in wanted):
        return False
    known = [t for t in legs.values() if t is not None]
    return marks.advance(name, max(known)) if known else False


def read_seeds(spark: SparkSession, paths: Sequence[str], required: str, defaults: dict[str, object]) -> DataFrame:
    """Operator seeds from the first path that exists: lower-case headers, whole-number keys, and of several rows with
    one key the first in the file. Seeds are files that people keep by hand, so they are numbered on the way in."""
    for p in paths:
        if files.exists(p):
            raw = spark.read.option("header", True).csv(p)
            df = raw.toDF(*[c.strip().lower() for c in raw.columns])
            if required not in df.columns:
                raise ValueError(f"{p}: missing column {required}")
            df = df.withColumn("row_no", F.monotonically_increasing_id()).withColumn(required, F.btrim(required).try_cast("bigint")).where(F.col(required).isNotNull())
            for c, v in defaults.items():
                df = df.withColumn(c, F.coalesce(F.col(c).try_cast("double"), F.lit(v)) if c in df.columns else F.lit(v))
            return keep_first(df, [required], [F.asc("row_no")]).drop("row_no")
    raise FileNotFoundError(", ".join(paths))


def rewrite_clean(spark: SparkSession, run: Run, table: str, keys: Sequence[str], schema: dict[str, str]) -> int:
    """Rewrite a table that was appended to over several sittings: its contract, one row per key; the number of rows.

    The new files are whole before they take the place of the old ones.
    """
    path, part = f"{run.path}/{table}", f"{run.path}/{table}.part"
    rows = contract(spark.read.parquet(path), schema)
    rest = [c for c in rows.columns if c not in keys]
    one = rows.dropna(subset=list(keys)).groupBy(*keys).agg(F.max(F.struct(*rest)).alias("kept")).select(*keys, "kept.*").select(*rows.columns)
    seen = Observation(f"clean_{table}")
    one.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(part)
    files.remove(path)
    files.move(part, path)
    run.files[table] = seen.get["n"]
    return run.files[table]


def read_torn_csv(spark: SparkSession, path: str, schema: str, key: str, pattern: str, needed: str) -> DataFrame:
    """A CSV that may end in torn rows: rows without a proper key or the needed column are dropped."""
    df = spark.read.option("header", True).option("mode", "PERMISSIVE").schema(schema).csv(path)
    return df.where(F.col(key).rlike(pattern) & F.col(needed).isNotNull())
