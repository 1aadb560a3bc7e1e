"""Products in order of their data dependencies, each into a sealed run with its watermark."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from tallyloom.sources.runs import Watermarks, newest, open_run


@dataclass(frozen=True)
class Product:
    name: str
    build: Callable[[], Mapping[str, DataFrame]]
    needs: Sequence[str] = ()
    event_time: tuple[str, str] | None = None  # (table, column) that moves the watermark


def order(products: Sequence[Product], only: Sequence[str] = (), skip: Sequence[str] = ()) -> list[Product]:
    """The chosen products, each after those it needs; a cycle or an unknown need raises."""
    by, done, out = {p.name: p for p in products}, set(), []

    def visit(name: str, path: tuple[str, ...]) -> None:
        if name in path:
            raise ValueError(" -> ".join((*path, name)))
        if name not in by:
            raise ValueError(f"unknown product {name}")
        if name in done:
            return
        for n in by[name].needs:
            visit(n, (*path, name))
        done.add(name)
        out.append(by[name])

    for p in products:
        visit(p.name, ())
    return [p for p in out if (not only or p.name in only) and p.name not in skip]


def run_all(products: Sequence[Product], root: str, marks: Watermarks, dry: bool = False, keep_going: bool = True) -> list[dict]:
    """Build, write and seal every product in order; a failed one is reported and its dependents are not run."""
    report: list[dict] = []
    failed: set[str] = set()
    for p in order(products):
        if failed & set(p.needs):
            failed.add(p.name)
            report.append({"product": p.name, "state": "skipped"})
            continue
        try:
            tables = p.build()
            if dry:
                report.append({"product": p.name, "state": "planned", "tables": {t: df.schema.simpleString() for t, df in tables.items()}})
                continue
            run = open_run(root, p.name)
            for t, df in tables.items():
                run.write(df, t)
            at: datetime | None = None
            if p.event_time and p.event_time[0] in tables:
                table, column = p.event_time
                at = newest(tables[table].sparkSession.read.parquet(f"{run.path}/{table}"), column).first()[0]
            run.seal(new_watermark=at)
            marks.advance(p.name, at)
            report.append({"product": p.name, "state": "sealed", "run": run.name, "rows": run.files})
        except Exception as e:  # noqa: BLE001
            if not keep_going:
                raise
            failed.add(p.name)
            report.append({"product": p.name, "state": "failed", "error": str(e)[:500]})
    return report
