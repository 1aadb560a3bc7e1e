"""Per-key results when a few keys hold most rows: shares and exact quantiles by mergeable counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallyloom.operators.skew import hot_keys, salted_join
from tallyloom.session import cut

#: Bins of one refinement, and the distinct values up to which an interval is ranked value by value. A window over one
#: interval therefore never sees more rows than the greater of the two.
BINS, FEW = 256, 4096


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """The coarsest histogram: one bin per key. Counts merge map-side, so a hot key costs one row per task.

    Null keys are left out of the result but count as rows of the table in :func:`heavy_keys`.
    """
    return df.select(F.col(key).alias("key_value")).groupBy("key_value").agg(F.count("*").alias("n_rows")).dropna(subset=["key_value"])


def heavy_keys(df: DataFrame, key: str, share: int = 25) -> DataFrame:
    """Keys that hold at least one row in ``share`` of all rows (repeated rows counted); at most ``share`` keys.

    Such a key fills so many places in the order of the keys' hashes that one of ``2 * share`` evenly spaced ranks falls
    on it (twice as many as needed, so that no rounding of a rank passes one by). :func:`quantiles` selects these ranks,
    and only keys found there are counted row by row; the counts decide, so keys that share a hash are told apart. Null
    keys count as rows. An empty table has none. The number of rows comes from the file footers, not from a scan.
    """
    code = F.shiftrightunsigned(F.xxhash64(key), 12).cast("double").alias("code")  # 52 bits, exact as a double
    coded = df.select(F.col(key).alias("key_value"), code, F.lit(0).alias("all")).dropna(subset=["key_value"])
    marks = quantiles(coded, "all", "code", [i / (2 * share) for i in range(1, 2 * share + 1)]).select(F.col("quantile").alias("code")).distinct()
    rows = coded.join(F.broadcast(marks), "code", "left_semi")
    return key_counts(rows, "key_value").where(F.col("n_rows") * share >= F.lit(df.count()))


def quantiles(df: DataFrame, key: str, value: str, probs: Sequence[float]) -> DataFrame:
    """Exact quantiles of ``value`` per ``key``: columns key_value, prob, n_rows, quantile.

    The quantile is the smallest value whose cumulative count reaches ``prob`` of the key's non-null values (rank at
    least 1) and n_rows their number. Rows are first reduced to counts of distinct (key, value), hash-partitioned on
    both, so no task holds a key. Then histograms are refined until every rank is one value: each round counts the
    values inside the open intervals in ``BINS`` equal-width bins (an interval of at most ``FEW`` distinct values has
    one bin per value), the bin that holds a rank becomes its next interval, with its edges shrunk to the least and
    greatest value seen, and only what lies inside is kept for the next round. Ties never stop it, and the values of a
    key are never gathered. Null keys and null or NaN values are left out; an empty table gives no rows; a key without
    values gives no row.
    """
    v = F.col(value).cast("double")
    rows = df.select(F.col(key).alias("key_value"), v.alias("v")).where(F.col("key_value").isNotNull() & F.col("v").isNotNull() & ~F.isnan("v"))
    counts = cut(rows.groupBy("key_value", "v").agg(F.count("*").alias("n")))
    keys = cut(counts.groupBy("key_value").agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_values"), F.min("v").alias("lo"), F.max("v").alias("hi")))
    hot = hot_keys(keys, ["key_value"], "n_values")
    rank = F.greatest(F.lit(1), F.ceil(F.col("prob") * F.col("n_rows"))).cast("bigint").alias("rank")
    todo = keys.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs]))).select("key_value", "prob", "n_rows", rank, "n_values", "lo", "hi")
    live, results = counts, []
    while True:
        spans = todo.select("key_value", "lo", "hi", "n_values").distinct()
        inside = salted_join(live.select("key_value", "v", "n"), spans, ["key_value"], hot, "v").where("v between lo and hi")
        live = cut(inside) if results else inside
        step = cut(refine(live, todo))
        results.append(step.where("lo = hi").select("key_value", "prob", "n_rows", F.col("lo").alias("quantile")))
        todo = step.where("lo < hi")
        if todo.isEmpty():
            return reduce(DataFrame.unionByName, results)
        live = live if len(results) > 1 else counts


def refine(live: DataFrame, todo: DataFrame) -> DataFrame:
    """``todo`` one histogram further: the interval, its distinct values and the rank inside it are those of one bin.

    live: key_value, v, n and the interval (lo, hi, n_values) each value lies in; the intervals of a key are disjoint.
    """
    few = F.col("n_values") <= FEW
    width = F.col("hi") / 2 - F.col("lo") / 2
    part = F.floor((F.col("v") / 2 - F.col("lo") / 2) / width * BINS)
    at = F.when(few, 0).when(F.col("v") == F.col("lo"), 0).when(F.col("v") == F.col("hi"), BINS - 1).when((width > 0) & (width < float("inf")), F.least(F.lit(BINS - 1), part)).otherwise(1)
    span = ["key_value", "lo", "hi"]
    binned = live.select(*span, "v", "n", at.cast("int").alias("bin"), F.when(few, F.col("v")).alias("own"))
    bins = binned.groupBy(*span, "bin", "own").agg(F.sum("n").alias("n"), F.count("*").alias("bin_values"), F.min("v").alias("bin_lo"), F.max("v").alias("bin_hi"))
    upto = F.sum("n").over(W.partitionBy(*span).orderBy("bin", "own").rowsBetween(W.unboundedPreceding, 0))
    ranked = bins.withColumn("upto", upto).withColumn("below", F.col("upto") - F.col("n"))
    hit = todo.join(ranked, span).where((F.col("rank") > F.col("below")) & (F.col("rank") <= F.col("upto")))
    return hit.select(
        "key_value", "prob", "n_rows", (F.col("rank") - F.col("below")).alias("rank"), F.col("bin_values").alias("n_values"), F.col("bin_lo").alias("lo"), F.col("bin_hi").alias("hi")
    )
