"""Command line: list the queries, explain or run one into a folder, load a sealed run into the graph, list runs, check
that a session and its tables are ready."""

from __future__ import annotations

import argparse
import sys
from importlib import import_module

from pyspark.sql import SparkSession

from tallyloom.plans import loads
from tallyloom.queries import MODULES
from tallyloom.session import local_session
from tallyloom.sources import files
from tallyloom.sources.runs import run_ids


def known() -> dict:
    """The queries of the entry module where it can be imported, else those of the core."""
    try:
        return import_module("__spark_entry__").queries()
    except ImportError:
        return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def preflight(spark: SparkSession, root: str) -> list[tuple[str, bool, str]]:
    """(check, ok, remark) for the session and every table in the folder."""
    sc, conf = spark.sparkContext, spark.conf
    shared = bool(sc.getConf().get("spark.checkpoint.dir")) or sc.master.startswith("local")
    out = [
        ("session zone is UTC", conf.get("spark.sql.session.timeZone") == "UTC", conf.get("spark.sql.session.timeZone")),
        ("adaptive execution", conf.get("spark.sql.adaptive.enabled") == "true", ""),
        ("shared checkpoint folder", shared, sc.getConf().get("spark.checkpoint.dir") or "local"),
    ]
    tables = [n.removesuffix(".parquet") for n in files.names(root) if n.endswith(".parquet")]
    out.append(("tables", bool(tables), f"{len(tables)} in {root}"))
    for t in tables:
        try:
            out.append((t, True, f"{spark.read.parquet(f'{root}/{t}.parquet').count()} rows"))
        except Exception as e:  # noqa: BLE001
            out.append((t, False, str(e).splitlines()[0][:120]))
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="tallyloom", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("list")
    for name in ("run", "explain"):
        c = sub.add_parser(name)
        c.add_argument("query")
        c.add_argument("--data", required=True)
        if name == "run":
            c.add_argument("--out", required=True)
            c.add_argument("--format", default="parquet")
            c.add_argument("--limit", type=int)
    sub.add_parser("preflight").add_argument("--data", required=True)
    g = sub.add_parser("load", help="load a sealed run into the graph")
    g.add_argument("data_type")
    for name in ("--runs", "--graph"):
        g.add_argument(name, required=True)
    g.add_argument("--run")
    g.add_argument("--dry-run", action="store_true")
    sub.add_parser("runs", help="sealed and open runs of a data type").add_argument("data_type")
    sub.choices["runs"].add_argument("--runs", required=True)
    a = p.parse_args(argv)
    queries = known()
    if a.command == "list":
        print("\n".join(sorted(queries)))
        return 0
    spark = spark or SparkSession.getActiveSession() or local_session("*")
    if a.command == "preflight":
        checks = preflight(spark, a.data)
        for name, ok, remark in checks:
            print("ok  " if ok else "FAIL", name, remark)
        return int(not all(ok for _, ok, _ in checks))
    if a.command == "runs":
        for state, sealed in (("sealed", True), ("open", False)):
            print("\n".join(f"{state} {n}" for n in run_ids(a.runs, a.data_type, sealed)))
        return 0
    if a.command == "load":
        for r in loads.load_run(spark, a.runs, a.data_type, a.graph, a.run, dry=a.dry_run):
            print(r["target"], "created", r["created"], "updated", r["updated"])
        return 0
    if a.query not in queries:
        print(f"no query {a.query}", file=sys.stderr)
        return 2
    df = queries[a.query](spark, a.data)
    if a.command == "explain":
        df.explain("formatted")
        return 0
    (df.limit(a.limit) if a.limit is not None else df).write.mode("overwrite").format(a.format).save(a.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
