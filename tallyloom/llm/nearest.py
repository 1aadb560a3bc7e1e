"""Matching records by nearest time.

Both sides are range-partitioned together by entity and time, so an entity may span any number of tasks. Each task
scans its sorted range once and finds, for every left record, the nearest right record before and after it inside the
range. What lies beyond a range is found from the first and last right record of every range, passed on by a parallel
prefix scan over the ranges in both directions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallyloom.session import cut, ship

#: Records of one range, and ranges of one block of the prefix scan at least.
RANGE_ROWS, BLOCK = 400_000, 64

_SCANNED = "part int, row_id bigint, entity bigint, at_us bigint, prev_us bigint, prev_ref string, next_us bigint, next_ref string"


class Scan:
    """One sorted range, batch by batch: the left records with the nearest right record of their entity on either side.

    Left records wait for their next right record only as long as one within the tolerance can still come, so what is
    held is what one entity does in that time, not the range.
    """

    def __init__(self, tolerance_us: int) -> None:
        self.tolerance = tolerance_us
        self.waiting: pd.DataFrame | None = None
        self.last: tuple[int, int, str] | None = None  # entity, time and ref of the newest right record so far

    def take(self, batch: pd.DataFrame) -> pd.DataFrame:
        """The left records that are settled by now."""
        entity, at, refs = batch["entity"].to_numpy(), batch["at_us"].to_numpy(), batch["ref"].to_numpy(dtype="object")
        right = batch["ref"].notna().to_numpy()
        place = np.arange(len(batch))
        left, rights = place[~right], place[right]
        j = np.maximum.accumulate(np.where(right, place, -1))[left]
        inside = j >= 0
        near = inside & (entity[j] == entity[left])
        us, ref = at[j], refs[j]
        if self.last is not None:
            carried = ~inside & (entity[left] == self.last[0])
            us, ref, near = np.where(carried, self.last[1], us), np.where(carried, self.last[2], ref), near | carried
        fresh = batch[["part", "row_id", "entity", "at_us"]].iloc[left].assign(prev_us=pd.arrays.IntegerArray(us, ~near), prev_ref=np.where(near, ref, None))
        open_ = fresh if self.waiting is None else pd.concat([self.waiting, fresh], ignore_index=True)
        where = np.concatenate([np.full(len(open_) - len(left), -1), left])
        if len(rights):
            self.last = (int(entity[rights[-1]]), int(at[rights[-1]]), refs[rights[-1]])
        k = np.searchsorted(rights, where)
        found = k < len(rights)
        j = np.append(rights, 0)[k]
        whose, when = open_["entity"].to_numpy(), open_["at_us"].to_numpy()
        near = found & (entity[j] == whose)
        settled = found | (whose != entity[-1]) | (when + self.tolerance < at[-1])
        out = open_.assign(next_us=pd.arrays.IntegerArray(at[j], ~near), next_ref=np.where(near, refs[j], None))[settled]
        self.waiting = open_[~settled] if not settled.all() else None
        return out[_NAMES]

    def rest(self) -> pd.DataFrame:
        if self.waiting is None:
            return pd.DataFrame(columns=_NAMES)
        return self.waiting.assign(next_us=pd.array([None] * len(self.waiting), "Int64"), next_ref=None)[_NAMES]


_NAMES = [x.split()[0] for x in _SCANNED.split(", ")]


def prefix_scan(edges: DataFrame, n: int, block: int = BLOCK) -> DataFrame:
    """part, carry_prev, carry_next: the last right record of all ranges before each range and the first of all behind it.

    edges: part, first, last (null where a range has no right record). Ranges are ordered, so what is carried is a
    running greatest and least value. Two levels: inside blocks of about the square root of all ranges, in parallel,
    then over the blocks; so no window sees more rows than that root, and every frame runs once over its rows.
    """
    per = max(block, math.isqrt(n))
    rows = edges.withColumn("block", F.floor(F.col("part") / per))
    up = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    own, all_ = W.partitionBy("block"), W.partitionBy(F.lit(0))
    inside = rows.select("part", "block", F.max("last").over(up(own.orderBy("part"))).alias("prev_in"), F.min("first").over(up(own.orderBy(F.desc("part")))).alias("next_in"))
    blocks = rows.groupBy("block").agg(F.max("last").alias("last"), F.min("first").alias("first"))
    over = blocks.select("block", F.max("last").over(up(all_.orderBy("block"))).alias("prev_out"), F.min("first").over(up(all_.orderBy(F.desc("block")))).alias("next_out"))
    return inside.join(over, "block").select("part", F.coalesce("prev_in", "prev_out").alias("carry_prev"), F.coalesce("next_in", "next_out").alias("carry_next"))


def nearest_matches(left: DataFrame, right: DataFrame, tolerance_us: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """row_id, ref: the nearest right record of the same entity within the tolerance (inclusive), on either side.

    left: row_id bigint, entity bigint, at timestamp. right: ref string, entity bigint, at timestamp. Rows with a null
    entity, time or ref cannot match and are left out; repeated right records count once. Of equally near records the
    earlier wins, then the smaller ref. A left record without a match gives no row; either side may be empty.
    """
    ship(left.sparkSession)
    us = F.unix_micros("at").alias("at_us")
    rights = right.dropna(subset=["ref", "entity", "at"]).select("entity", us, "ref").groupBy("entity", "at_us").agg(F.min("ref").alias("ref"))
    lefts = left.dropna(subset=["row_id", "entity", "at"]).select("entity", us, "row_id")
    both = rights.select("entity", "at_us", "ref", F.lit(0).cast("bigint").alias("row_id")).unionByName(lefts.select("entity", "at_us", F.lit(None).cast("string").alias("ref"), "row_id"))
    n = max(1, -(-(left.count() + right.count()) // range_rows), left.sparkSession.sparkContext.defaultParallelism)
    order = ["entity", "at_us", F.col("ref").isNull()]
    ranged = cut(both.repartitionByRange(n, "entity", "at_us").sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = Scan(tolerance_us)
        for batch in batches:
            if len(batch):
                yield state.take(batch)
        yield state.rest()

    edge = F.struct("entity", "at_us", "ref")
    is_right = F.col("ref").isNotNull()
    edges = ranged.groupBy("part").agg(F.max(F.when(is_right, edge)).alias("last"), F.min(F.when(is_right, edge)).alias("first"))
    rows = ranged.mapInPandas(scan, _SCANNED).join(prefix_scan(edges, n), "part", "left")
    prev = F.when(F.col("prev_ref").isNotNull(), F.struct(F.col("prev_us").alias("us"), F.col("prev_ref").alias("ref"))).when(
        F.col("carry_prev.entity") == F.col("entity"), F.struct(F.col("carry_prev.at_us").alias("us"), F.col("carry_prev.ref").alias("ref"))
    )
    later = F.when(F.col("next_ref").isNotNull(), F.struct(F.col("next_us").alias("us"), F.col("next_ref").alias("ref"))).when(
        F.col("carry_next.entity") == F.col("entity"), F.struct(F.col("carry_next.at_us").alias("us"), F.col("carry_next.ref").alias("ref"))
    )
    ranked = [F.when(c.isNotNull(), F.struct(F.abs(c["us"] - F.col("at_us")).alias("gap"), c["us"].alias("us"), c["ref"].alias("ref"))) for c in (prev, later)]
    best = F.least(*ranked)
    return rows.select("row_id", best.alias("best")).where(F.col("best.gap") <= tolerance_us).select("row_id", F.col("best.ref").alias("ref"))
