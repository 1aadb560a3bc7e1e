import json

import pytest
from pyspark.sql import functions as F

from tallyloom.sources import cache, paged, runs

SHAPE = "hash string, timestamp string, n bigint"


def record(root, name, items, cursor=None):
    p = root / "feed"
    p.mkdir(exist_ok=True)
    (p / f"{name}.json").write_text(json.dumps({"result": {"casts": items}, "next": {"cursor": cursor}}))


def test_pages_are_followed_and_repeats_dropped(spark, tmp_path):
    record(tmp_path, "first", [{"hash": "a", "timestamp": "2025-01-03"}, {"hash": "b"}], "p2")
    record(tmp_path, "p2", [{"hash": "b"}, {"hash": "c", "timestamp": "2025-01-01", "n": 5}], "p2")
    record(tmp_path, "x.first", [{"hash": "d", "timestamp": "soon"}])
    how = {"root": tmp_path, "resource": "feed", "itemsPath": "result.casts", "starts": ",x"}
    assert sorted(r.hash for r in paged.read_items(spark, SHAPE, **how).collect()) == ["a", "b", "c", "d"]
    assert sorted(r.hash for r in paged.read_items(spark, SHAPE, ("timestamp", "2025-01-02"), **how).collect()) == ["a", "b", "d"]
    assert sorted(r.hash for r in paged.read_items(spark, SHAPE, **how, maxPages=1).collect()) == ["a", "b", "d"]


def test_retries_back_off_and_give_up():
    waits, answers = [], [paged.Failed(503), paged.Failed(429, 7.0), {"ok": 1}]

    def fetch():
        a = answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    assert paged.Policy(sleep=waits.append).call(fetch) == {"ok": 1} and waits == [0.5, 7.0]
    answers[:] = [paged.Failed(404)]
    with pytest.raises(paged.Failed):
        paged.Policy(sleep=waits.append).call(fetch)
    answers[:] = [paged.Failed(500)] * 2
    with pytest.raises(paged.Failed):
        paged.Policy(attempts=2, sleep=waits.append).call(fetch)


def test_look_up_and_resumed_crawl(spark, tmp_path):
    def fetch(keys):
        if 4 in keys:
            raise paged.Failed(500)
        return [{"k": k, "v": str(k * 2)} for k in keys if k != 3]

    keys = spark.createDataFrame([(1,), (1,), (2,), (3,), (4,), (None,)], "k bigint")
    found, failed = paged.look_up(keys, "k", fetch, "k bigint, v string", 1, paged.Policy(attempts=2, base=0.0))
    assert sorted(map(tuple, found.collect())) == [(1, "2"), (2, "4")]
    assert [(r.k, r.reason) for r in failed.collect()] == [("4", "status 500")]
    run = runs.open_run(str(tmp_path), "crawl")
    targets = spark.range(10).withColumnRenamed("id", "k")
    asked = []

    def step(df):
        asked.append(df.count())
        return df.withColumn("v", F.col("k") * 2)

    paged.crawl(run, "t", targets.where("k < 6"), "k", step, 3)
    out = paged.crawl(run, "t", targets, "k", step, 3)
    assert sum(asked) == 10 and out.count() == 10 and run.files["t"] == 10


def test_cache(spark, tmp_path):
    df = spark.range(3).withColumn("v", F.col("id") * 2)
    assert cache.cached(df, str(tmp_path)).count() == 3
    before = sorted(p.name for p in tmp_path.glob("plan-*/part-*"))
    assert cache.cached(spark.range(3).withColumn("v", F.col("id") * 2), str(tmp_path)).count() == 3
    assert sorted(p.name for p in tmp_path.glob("plan-*/part-*")) == before
    cache.cached(df, str(tmp_path), 0.0)
    assert sorted(p.name for p in tmp_path.glob("plan-*/part-*")) != before


def test_account_ranges_and_truncation(spark):
    def fetch(ids):
        return [{"fid": i} for i in ids if i <= 30]

    got = paged.account_ranges(spark, 1, 10_000, fetch, "fid bigint", 10, 3)
    assert sorted(r.fid for r in got.collect()) == list(range(1, 31))
    items = spark.createDataFrame([("a", 0, "2025-01-09"), ("a", 1, "2025-01-08"), ("b", 0, "2025-01-09"), ("b", 1, "2024-12-01"), ("c", 0, "2025-01-09"), ("d", 1, "soon")], "chain string, page_no int, at string")
    assert {r.chain: r.is_truncated for r in paged.truncated(items, "2025-01-01", "at", 2).collect()} == {"a": True, "b": False, "c": False, "d": True}
