import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from oracle import TABLES, same
from tallyloom.operators import heavykeys
from tallyloom.queries import pipeline


def brute(data, probs):
    by = {}
    for k, v in data:
        if k is not None and v is not None and not math.isnan(v):
            by.setdefault(k, []).append(v)
    return {(k, p): (len(v), sorted(v)[max(1, math.ceil(p * len(v))) - 1]) for k, v in by.items() for p in probs}


def test_quantiles_against_sorting(spark, monkeypatch):
    monkeypatch.setattr(heavykeys, "FEW", 20)
    monkeypatch.setattr(heavykeys, "BINS", 4)
    rng = random.Random(5)
    data = [("hot", rng.choice([rng.gauss(0, 1), rng.expovariate(1e-6), 3.0, -1e300, 5e-324])) for _ in range(600)]
    data += [("few", float(i % 7)) for i in range(50)] + [("one", 2.5), (None, 1.0), ("none", None), ("nan", float("nan")), ("inf", float("inf")), ("inf", 1.0)]
    data += [("mixed", v) for v in [float("-inf"), float("inf"), 1.0] * 3 + [float(i) for i in range(40)]]
    df = spark.createDataFrame(data, "k string, v double").withColumn("n", F.lit(1))
    probs = (0.0, 0.1, 0.5, 0.9, 1.0)
    got = {(r.key_value, r.prob): (r.n_rows, r.quantile) for r in heavykeys.quantiles(df, "k", "v", probs).collect()}
    assert got == brute(data, probs)


def test_empty(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert heavykeys.quantiles(df, "k", "v", (0.5,)).count() == 0 and heavykeys.heavy_keys(df, "k").count() == 0


def test_shares_count_nulls_as_rows(spark):
    df = spark.createDataFrame([("a",)] * 4 + [("b",)] * 3 + [(None,)] * 93, "k string")
    assert [(r.key_value, r.n_rows) for r in heavykeys.heavy_keys(df, "k").collect()] == [("a", 4)]


def test_heavy_keys_against_counting(spark, monkeypatch):
    monkeypatch.setattr(heavykeys, "FEW", 6)
    monkeypatch.setattr(heavykeys, "BINS", 4)
    rng = random.Random(7)
    even = [f"k{i % 25}" for i in range(100)]  # every key holds one row in 25 exactly
    mixed = [f"h{i % 5}" for i in range(150)] + [f"l{rng.randrange(400)}" for _ in range(500)] + [None] * 40 + ["edge"] * 29  # 719 rows, a key needs 29
    for data in (even, mixed, ["one"], [None, None]):
        want = {(k, n) for k, n in Counter(data).items() if k is not None and n * 25 >= len(data)}
        df = spark.createDataFrame([(k,) for k in data], "k string")
        assert {(r.key_value, r.n_rows) for r in heavykeys.heavy_keys(df, "k").collect()} == want


@pytest.mark.skipif(not TABLES.exists(), reason="no tables")
def test_heavy_keys_follow_from_the_selected_ranks(spark, monkeypatch):
    """What the refinement selects decides which keys come out: with ranks that fall on no key there are none."""
    select = heavykeys.quantiles
    assert pipeline.p3_found(spark, str(TABLES)).count() > 0
    monkeypatch.setattr(heavykeys, "quantiles", lambda *a, **k: select(*a, **k).withColumn("quantile", F.lit(-1.0)))
    assert pipeline.p3_found(spark, str(TABLES)).count() == 0


@pytest.mark.skipif(not TABLES.exists(), reason="no tables")
def test_every_chain_passes_the_refinement(spark, monkeypatch):
    monkeypatch.setattr(heavykeys, "FEW", 3)
    monkeypatch.setattr(heavykeys, "BINS", 4)
    same(spark, "p3_chains", pipeline.p3_chains, pipeline.SQL["p3_chains"])
    got = {r.chain_id: r.n_rows for r in pipeline.p3_chains(spark, str(TABLES)).collect()}
    tokens = spark.read.parquet(f"{TABLES}/tokens.parquet")
    assert got == {r.key_value: r.n_rows for r in heavykeys.key_counts(tokens, "chain_id").collect()}
    shares = heavykeys.heavy_keys(tokens, "chain_id")
    assert len(got) >= shares.count() and {r.key_value for r in shares.collect()} <= set(got)
