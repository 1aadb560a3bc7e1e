"""A property graph as node and edge tables kept by keyed upserts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.upsert import Policy, broken_keys, changes, upsert

#: The key of every node label.
NODES = {"account": ("fid",), "wallet": ("address",), "token": ("address", "chain_id"), "contract": ("address", "chain_id"), "channel": ("channel_id",), "chain": ("chain_id",), "platform": ("name",)}


@dataclass(frozen=True)
class GraphStep:
    """One table of a run into one node or edge table."""

    source: str
    target: str
    keys: Sequence[str]
    build: Callable[[DataFrame], DataFrame]
    policies: Mapping[str, Policy] = field(default_factory=dict)
    default: Policy = Policy.OVERWRITE
    required: bool = True
    #: A stub only gives an edge somewhere to land: what the node carries already, its provenance too, stays.
    stub: bool = False


def stubs(label: str, *frames: DataFrame) -> DataFrame:
    """Distinct keys of a label from both ends of edges; null keys make no node."""
    keys = list(NODES[label])
    return reduce(DataFrame.unionByName, [f.select(*keys) for f in frames]).dropna().distinct()


def last_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the last by ``row_no`` where the table has one, else the greatest; rows with a null key go."""
    rows = rows.dropna(subset=list(keys))
    rest = [c for c in rows.columns if c not in keys and c != "row_no"]
    if not rest:
        return rows.select(*keys).distinct()
    order = F.struct(*[c for c in ("row_no",) if c in rows.columns], *rest)
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("kept")).select(*keys, "kept.*")


def load(steps: Sequence[GraphStep], sources: Mapping[str, DataFrame], graph: Mapping[str, DataFrame], stamp: Mapping[str, object], declared: Sequence[str] | None = None) -> dict[str, tuple[DataFrame, DataFrame]]:
    """The next state of every table the steps write, and its counters. Nothing runs until it is written.

    All steps are checked before any is built. ``declared`` are the tables that the run's manifest names (all sources,
    where there is none): a table that is declared but missing raises, and so does a required one that is not declared;
    an optional one that is not declared is skipped. ``stamp`` is provenance that every row of the load carries. Of
    several rows with one key the last counts; rows without a whole key write nothing.
    """
    declared = set(sources) if declared is None else set(declared)
    missing = sorted({s.source for s in steps if s.source not in sources and (s.required or s.source in declared)})
    if missing:
        raise FileNotFoundError(", ".join(missing))
    out: dict[str, tuple[DataFrame, DataFrame]] = {}
    for s in steps:
        if s.source not in sources or s.source not in declared:
            continue
        rows = last_rows(s.build(sources[s.source]), s.keys).withColumns({k: F.lit(v) for k, v in stamp.items()})
        before = out[s.target][0] if s.target in out else graph.get(s.target)
        old = rows.limit(0) if before is None else before
        policies = {k: Policy.CREATE_ONLY if s.stub else Policy.OVERWRITE for k in stamp} | dict(s.policies)
        out[s.target] = (upsert(old, rows, s.keys, policies, s.default), changes(old, rows, s.keys))
    return out


def violations(graph: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Nodes whose key is not unique, per label; all are empty in a sound graph."""
    return {label: broken_keys(graph[label], keys) for label, keys in NODES.items() if label in graph}
