"""Joins and ordered scans that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: At most this many keys are ever treated as hot, so their broadcast has a proven bound. A key that is not among them
#: has fewer than 1/TOP of all rows.
TOP = 16_384
#: Rows of one key that one task takes. A key gets as many partitions as it has such portions.
PORTION = 250_000


def hot_keys(counts: DataFrame, keys: Sequence[str], n: str, portion: int | None = None) -> DataFrame:
    """The keys with more than one portion of rows and the number of portions each has (``salt_n``).

    A bounded top-k of a table of counts: at most ``TOP`` rows whatever the input holds.
    """
    portion = portion or PORTION
    top = counts.where(F.col(n) > portion).orderBy(F.col(n).desc(), *keys).limit(TOP)
    return top.select(*keys, F.ceil(F.col(n) / portion).cast("int").alias("salt_n"))


def salted_join(rows: DataFrame, keyed: DataFrame, keys: Sequence[str], hot: DataFrame, spread: Sequence[str] | str, how: str = "inner") -> DataFrame:
    """Join a large table with one that has few rows per key, spreading each hot key over as many partitions as it has
    portions of rows.

    Only rows of hot keys are salted, by a hash of ``spread``, and only their partners are repeated; every other row is
    shuffled once on the keys alone. ``hot`` comes from :func:`hot_keys`, so its broadcast is bounded.
    """
    marks = F.broadcast(hot)
    spread = [spread] if isinstance(spread, str) else list(spread)
    salt = F.when(F.col("salt_n").isNull(), 0).otherwise(F.pmod(F.xxhash64(*spread), F.col("salt_n"))).cast("int")
    left = rows.join(marks, list(keys), "left").withColumn("salt_no", salt)
    right = keyed.join(marks, list(keys), "left").withColumn("salt_no", F.explode(F.sequence(F.lit(0), F.coalesce("salt_n", F.lit(1)) - 1)))
    return left.drop("salt_n").join(right.drop("salt_n"), [*keys, "salt_no"], how).drop("salt_no")


def neighbour(rows: DataFrame, group: Sequence[str], order: Sequence[Column], value: str, slice_of: Column, later: bool, out: str) -> DataFrame:
    """Add the nearest non-null ``value`` before each row of its group (behind it, where ``later``), else null.

    ``order`` is the whole order of a group from its first row to its last and ``slice_of`` a whole number that never
    falls along it. A slice of a group is one window of its own and hands one value on to the slices that follow, so a
    group of any size is spread over its slices; every window runs once over its rows. Rows with a null in the group
    get null.
    """
    turned = [F.desc(c) if later else F.asc(c) for c in order]
    cells = rows.withColumn("slice_no", slice_of)
    inside = W.partitionBy(*group, "slice_no").orderBy(*turned).rowsBetween(W.unboundedPreceding, -1)
    ends = F.struct(*order, F.col(value).alias("handed"))
    kept = F.when(F.col(value).isNotNull(), ends)
    heads = cells.groupBy(*group, "slice_no").agg((F.min(kept) if later else F.max(kept)).alias("head"))
    slices = W.partitionBy(*group).orderBy(F.desc("slice_no") if later else F.asc("slice_no")).rowsBetween(W.unboundedPreceding, -1)
    handed = heads.withColumn("passed", F.last("head", ignorenulls=True).over(slices)["handed"]).drop("head")
    near = F.last(value, ignorenulls=True).over(inside)
    known = F.lit(True)
    for g in group:
        known = known & F.col(g).isNotNull()
    joined = cells.withColumn("near", near).join(handed, [*group, "slice_no"], "left")
    return joined.withColumn(out, F.when(known, F.coalesce("near", "passed"))).drop("slice_no", "near", "passed")
