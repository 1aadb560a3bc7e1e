import random
from datetime import UTC, datetime, timedelta

import pytest

from tallyloom.llm import nearest
from tallyloom.llm.nearest import nearest_matches

T0 = datetime(2025, 1, 1, tzinfo=UTC)
LEFT, RIGHT = "row_id bigint, entity bigint, at timestamp, ref string", "ref string, entity bigint, at timestamp, row_id bigint"


def run(spark, left, right, tolerance=20, rows=50):
    a = spark.createDataFrame([(i, e, None if t is None else T0 + timedelta(minutes=t), "clash") for i, e, t in left], LEFT)
    b = spark.createDataFrame([(r, e, None if t is None else T0 + timedelta(minutes=t), 9) for r, e, t in right], RIGHT)
    return sorted(map(tuple, nearest_matches(a, b, tolerance * 60_000_000, rows).collect()))


def brute(left, right, tolerance):
    out = []
    for i, e, t in left:
        near = [(abs(u - t), u, r) for r, f, u in right if None not in (e, t, f, u, r) and e == f and abs(u - t) <= tolerance] if t is not None else []
        if near:
            out.append((i, min(near)[2]))
    return sorted(out)


def test_ties_bounds_and_nulls(spark):
    left = [(1, 1, 100), (2, 1, 130), (3, 2, 100), (4, None, 100), (5, 3, None), (6, 4, 100), (1, 1, 100)]
    right = [("b", 1, 90), ("a", 1, 90), ("c", 1, 110), ("a", 1, 90), ("z", 1, 150), ("q", 2, 121), (None, 2, 100), ("n", None, 100), ("m", 3, None), ("e", 4, 100), ("d", 4, 100)]
    assert run(spark, left, right) == [(1, "a"), (1, "a"), (2, "c"), (6, "d")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force_with_an_entity_larger_than_a_range(spark, seed):
    rng = random.Random(seed)
    who = lambda: 1 if rng.random() < 0.6 else rng.randint(2, 6)
    left = [(i, who(), rng.randint(0, 900)) for i in range(300)]
    right = [(f"r{rng.randint(0, 99)}", who(), rng.randint(0, 900) if rng.random() < 0.7 else 450) for _ in range(80)]
    assert run(spark, left, right, 15, 20) == brute(left, right, 15)


def test_empty_sides(spark):
    assert run(spark, [], [("a", 1, 1)]) == [] and run(spark, [(1, 1, 1)], []) == [] and run(spark, [], []) == []


def test_many_ranges_and_small_batches(spark, monkeypatch):
    """Carried edges over several blocks of ranges, records that wait over several batches, and ids beyond 2**53."""
    monkeypatch.setattr(nearest, "BLOCK", 2)
    monkeypatch.setattr(nearest.prefix_scan, "__defaults__", (2,))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rng = random.Random(8)
        big = 2**60
        left = [(big + i, rng.choice([1, 1, 1, 2, 3]), rng.randint(0, 3000)) for i in range(400)]
        right = [(f"r{i}", rng.choice([1, 1, 2, 4]), rng.randint(0, 3000)) for i in range(60)]
        assert run(spark, left, right, 40, 12) == brute(left, right, 40)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
