"""References to records that do not exist: missing, deleted or arriving later.

Distinct non-null foreign keys are reduced first (a map-side combine, so a hot key costs one row per task), compared
with the reduced parent keys by a left anti-join, and only the faulty keys are joined back to the rows. Reduced tables
are checkpointed: children are read twice (for their keys and for their rows), parents once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.skew import hot_keys, salted_join
from tallyloom.session import cut


def known_parents(parents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per parent key: when it was first seen and when it was first gone. Computed once for all its children."""
    return cut(parents.dropna(subset=list(keys)).groupBy(*keys).agg(F.min("seen_at").alias("first_seen"), F.min("deleted_at").alias("gone_at")))


def orphan_rows(refs: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``refs`` whose parent is missing, late or deleted.

    refs: the keys, ``row_id`` and ``seen_at``. known: the parents' keys by :func:`known_parents`, any number of
    versions per key. Returns ``row_id``, ``seen_at`` and ``reason``, once per row of refs. A null in any key is no
    reference and gives no row; a null ``seen_at`` can only be ``missing``. Repeated rows keep their own row_id. An
    empty parent table makes every reference missing; empty refs give no rows.
    """
    keys = list(keys)
    refs = refs.select(*keys, "row_id", "seen_at").dropna(subset=keys)
    held = cut(refs.groupBy(*keys).agg(F.count("*").alias("n"), F.min("seen_at").alias("lo"), F.max("seen_at").alias("hi")))
    never = F.lit(None).cast("timestamp")
    missing = held.join(known.select(*keys), keys, "left_anti").select(*keys, "n", never.alias("first_seen"), never.alias("gone_at"), F.lit(True).alias("none"))
    faulty = (F.col("lo") < F.col("first_seen")) | (F.col("hi") >= F.col("gone_at"))
    doubtful = held.join(known, keys).where(faulty).select(*keys, "n", "first_seen", "gone_at", F.lit(False).alias("none"))
    faults = cut(missing.unionByName(doubtful))
    back = salted_join(refs, faults.drop("n"), keys, hot_keys(held, keys, "n"), "row_id")
    return back.select("row_id", "seen_at", fault().alias("reason")).where("reason is not null")


def fault() -> Column:
    """missing before late before deleted; null where the reference is sound."""
    return (
        F.when(F.col("none"), "missing")
        .when(F.col("first_seen") > F.col("seen_at"), "late")
        .when(F.col("gone_at") <= F.col("seen_at"), "deleted")
    )


def orphan_report(rows: DataFrame) -> DataFrame:
    """Counts of faulty references per table, month and kind of fault."""
    return rows.groupBy("ref_table", "period", "reason").agg(F.count("*").alias("n_rows"))
