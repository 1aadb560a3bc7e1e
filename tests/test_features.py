from datetime import datetime

import pytest
from pyspark.sql import functions as F

from oracle import TABLES
from tallyloom.operators import features as f
from tallyloom.queries import pipeline

T = lambda n: datetime(2025, 1, n)
SCHEMA = "who bigint, kind string, brand bigint, a string, b string, at timestamp, w double, entity string"


def vectors(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    events = f.distinct_events(df, "who", "kind", ("brand", "a", "b"), "at", "w").withColumn("part", F.coalesce(F.col("same_0"), F.lit("")))
    counts = f.kind_counts(events)
    index = f.kind_index(counts)
    return f.entity_vectors(counts, index), index


DATA = [
    (1, "tap.feed", 5, None, "h", T(1), 1.0, "x"),
    (1, " TAP feed\t", 5, "", "h", T(3), 1.0, "x"),  # the same event, spelled and timed otherwise
    (1, "tap_feed", 5, "z", "h", T(2), 0.5, "x"),
    (1, "tap.feed.bot", 5, None, "h", T(2), None, "x"),
    (2, "like", None, None, None, None, 2.0, "x"),
    (2, "LIKE", None, "", " ", None, 2.0, "x"),
    (None, "like", 1, None, None, T(1), 1.0, "x"),
    (3, None, 1, None, None, T(1), 1.0, "x"),
    (3, " \n", 1, None, None, T(1), 1.0, "x"),
]


def test_vectors(spark):
    parts, index = vectors(spark, DATA)
    got = sorted((r.entity, r.kind, r.n, r.total, r.latest) for r in f.long_features(f.merge_vectors(parts), index).collect())
    assert got == [(1, "tap.feed", 2, 1.5, T(3)), (1, "tap.feed.bot", 1, 0.0, T(2)), (2, "like", 1, 2.0, None)]


def test_wide_and_merge(spark):
    parts, index = vectors(spark, DATA)
    v = f.merge_vectors(parts)
    kinds = [r.kind for r in index.orderBy("kind_no").collect()]
    wide = {r.entity: (r.n_like, r.total_like, r.n_tap_feed, r.latest_tap_feed) for r in f.wide_features(v, kinds).collect()}
    assert wide == {1: (0, 0.0, 2, T(3)), 2: (1, 2.0, 0, None)}
    doubled = {(r.entity, r.kind): r.n for r in f.long_features(f.merge_vectors(v.unionByName(v)), index).collect()}
    assert doubled == {(1, "tap.feed"): 4, (1, "tap.feed.bot"): 2, (2, "like"): 2}


def test_empty(spark):
    assert f.merge_vectors(vectors(spark, [])[0]).count() == 0


def test_parts_merge_into_the_vectors_of_the_whole(spark):
    data = [*DATA, (1, "like", 6, None, None, T(4), 0.25, "x"), (1, "like", 7, None, None, T(5), 0.5, "x"), (2, "zap", 6, None, None, T(5), 0.1, "x")]
    events = f.distinct_events(spark.createDataFrame(data, SCHEMA), "who", "kind", ("brand", "a", "b"), "at", "w")
    index = f.kind_index(f.kind_counts(events))
    parts, whole = [f.entity_vectors(f.kind_counts(e), index) for e in (events.withColumn("part", F.col("same_0")), events)]
    assert parts.count() > whole.count()
    both = lambda v: sorted(map(tuple, f.long_features(v, index).collect()), key=str)
    assert both(f.merge_vectors(parts)) == both(whole)


@pytest.mark.skipif(not TABLES.exists(), reason="no tables")
def test_every_kind_comes_out_with_all_its_figures(spark):
    """The queries over the tables leave out no kind; the wide one holds what the long one holds."""
    found = {(r.engager_fid, r.engagement): r.n_events for r in pipeline.p6_found(spark, str(TABLES)).collect()}
    long = {(r.engager_fid, r.engagement): (r.n_events, r.total, r.latest) for r in pipeline.p6_kinds(spark, str(TABLES)).collect()}
    assert {k: v[0] for k, v in long.items()} == found and len({k for _, k in found}) > 4
    table = pipeline.p6_features(spark, str(TABLES))
    kinds = sorted({k for _, k in found})
    groups = [[f"{g}_{k.replace('.', '_')}" for g in ("n", "total", "latest")] for k in kinds]
    assert sorted(table.columns) == sorted(["engager_fid", *[c for g in groups for c in g]])
    wide = {(r["engager_fid"], k): tuple(r[c] for c in g) for r in table.collect() for k, g in zip(kinds, groups, strict=True)}
    assert {e for e, _ in wide} == {e for e, _ in found}
    assert wide == dict.fromkeys(wide, (0, 0.0, None)) | long
