from datetime import datetime

from pyspark.sql import functions as F

from tallyloom.operators import skew
from tallyloom.operators.references import known_parents, orphan_report, orphan_rows

T = lambda n: datetime(2025, 1, n)
REFS, PARENTS = "k bigint, c bigint, row_id bigint, seen_at timestamp, none string", "k bigint, c bigint, seen_at timestamp, deleted_at timestamp"


def found(spark, refs, parents):
    out = orphan_rows(spark.createDataFrame(refs, REFS), known_parents(spark.createDataFrame(parents, PARENTS), ["k", "c"]), ["k", "c"])
    return sorted((r.row_id, r.reason) for r in out.collect())


def test_kinds_of_fault_and_their_boundaries(spark):
    parents = [(1, 1, T(5), None), (1, 1, T(9), None), (2, 1, T(1), T(8)), (2, 1, T(2), T(6)), (3, 1, T(7), T(3))]
    refs = [
        (1, 1, 10, T(5), "x"),  # at the very time of the parent: sound
        (1, 1, 11, T(4), "x"),
        (1, 2, 12, T(9), "x"),  # another chain
        (2, 1, 13, T(5), "x"),
        (2, 1, 14, T(6), "x"),  # at the very time of the deletion
        (3, 1, 15, T(4), "x"),  # late and deleted: late
        (9, 9, 16, T(1), "x"),
        (9, 9, 16, T(1), "x"),  # a repeated row
        (None, 1, 17, T(1), "x"),
        (1, None, 18, T(1), "x"),
        (9, 1, 19, None, "x"),
        (1, 1, 20, None, "x"),
    ]
    assert found(spark, refs, parents) == [(11, "late"), (12, "missing"), (14, "deleted"), (15, "late"), (16, "missing"), (16, "missing"), (19, "missing")]


def test_empty_tables(spark):
    assert found(spark, [], []) == []
    assert found(spark, [(1, 1, 1, T(1), "x")], []) == [(1, "missing")]
    assert found(spark, [], [(1, 1, T(1), None)]) == []


def test_a_hot_key_is_whole_and_spread_by_its_size(spark, monkeypatch):
    monkeypatch.setattr(skew, "PORTION", 5_000)
    refs = spark.range(60_000).select(F.when(F.col("id") % 12 < 11, 7).otherwise(F.col("id")).cast("bigint").alias("k"), F.lit(1).cast("bigint").alias("c"), F.col("id").alias("row_id"), F.lit(T(1)).alias("seen_at"))
    hot = skew.hot_keys(refs.groupBy("k").agg(F.count("*").alias("n")), ["k"], "n").collect()
    assert [(r.k, r.salt_n) for r in hot] == [(7, 11)]
    known = known_parents(spark.createDataFrame([(8, 1, T(1), None)], PARENTS), ["k", "c"])
    out = orphan_rows(refs, known, ["k", "c"])
    assert out.count() == 60_000 and out.select("row_id").distinct().count() == 60_000


def test_report(spark):
    df = spark.createDataFrame([("buys", "2025-01", "late"), ("buys", "2025-01", "late"), ("buys", "2025-02", "missing")], "ref_table string, period string, reason string")
    assert sorted(map(tuple, orphan_report(df).collect())) == [("buys", "2025-01", "late", 2), ("buys", "2025-02", "missing", 1)]
