from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import decode, fold, match, pivot, rank, registry, resolve, upsert
from tallyloom.operators.upsert import Policy

T0 = datetime(2025, 1, 10)
DAY, SEC = timedelta(days=1), timedelta(seconds=1)


def attributed(spark, buys, engagements):
    b = spark.createDataFrame(buys, "token int, buyer int, purchase int, bought_at timestamp, usd double")
    e = spark.createDataFrame(engagements, "token int, buyer int, author int, engaged_at timestamp")
    return sorted((r.purchase, r.author, r.n_influencers, r.attributed_usd) for r in match.attribute(b, e, ["token", "buyer"], 5).collect())


@pytest.mark.parametrize(("offset", "counts"), [(timedelta(0), False), (SEC, True), (5 * DAY - SEC, True), (5 * DAY, True), (5 * DAY + SEC, False), (-SEC, False), (-5 * DAY, False)])
def test_attribution_window(spark, offset, counts):
    assert bool(attributed(spark, [(1, 1, 1, T0 + offset, 9.0)], [(1, 1, 7, T0)])) is counts


def test_attribution_split(spark):
    buys = [(1, 1, 1, T0, 300.0), (1, 2, 2, T0, 10.0), (2, 1, 3, T0, 5.0), (None, 1, 4, T0, 1.0)]
    eng = [(1, 1, a, T0 - DAY) for a in (7, 8, 9)] + [(1, 1, 7, T0 - 2 * DAY)] + [(1, 3, 7, T0 - DAY), (None, 1, 7, T0 - DAY)]
    assert attributed(spark, buys, eng) == [(1, 7, 3, 100.0), (1, 8, 3, 100.0), (1, 9, 3, 100.0)]
    assert attributed(spark, [], eng) == [] and attributed(spark, buys, []) == []


def test_author_without_effect_keeps_zeros(spark):
    a = spark.createDataFrame([], "token int, author int, buyer int, purchase int, usd double, attributed_usd double")
    casts = spark.createDataFrame([(1, 7, "c1"), (1, 7, "c1"), (1, 7, "c2")], "token int, author int, cast string")
    assert [tuple(r) for r in match.author_summary(a, casts, ["token"]).collect()] == [(1, 7, 2, 0, 0, 0.0, 0.0)]


def test_forward_nearest_and_windows(spark):
    first = spark.createDataFrame([("t", 3), ("t", 8), ("u", 1)], "tx string, i int")
    ops = spark.createDataFrame([("t", 3, "a"), ("t", 5, "b"), ("t", 6, "c"), ("v", 9, "d")], "tx string, j int, s string")
    got = sorted((r.tx, r.i, r.op_index, r.s) for r in match.nearest_forward(first, ops, "tx", "i", "j", ["s"]).collect())
    assert got == [("t", 3, 5, "b"), ("t", 8, None, None), ("u", 1, None, None)]
    events = spark.createDataFrame([("t", 2, "before"), ("t", 3, "at"), ("t", 4, "in"), ("t", 99, "open"), ("w", 1, "none")], "tx string, i int, e string")
    inside = sorted((r.e, r.start_index) for r in match.inside_windows(events, first, "tx", "i", []).collect())
    assert inside == [("in", 3), ("open", 8)]
    assert sorted((r.i, r.next_index) for r in match.windows(first.where("tx = 't'"), "tx", "i").collect()) == [(3, 8), (8, None)]


def test_identity_rules(spark):
    w = spark.createDataFrame(
        [("a", 9, True, "verified", 0.1, 1), ("a", 1, True, "custody", 0.9, 2), ("a", 5, False, "verified", 0.5, 3), ("b", None, True, "verified", 1.0, 1), (None, 3, True, "verified", 1.0, 1)],
        "address string, fid bigint, is_primary boolean, source string, score double, row_no int",
    )
    pick = lambda rule: [tuple(r) for r in resolve.one_account(w, rule).collect()]
    assert [pick(r) for r in ("verified", "score", "lowest", "last")] == [[("a", 9)], [("a", 1)], [("a", 1)], [("a", 5)]]
    trades = spark.createDataFrame([("a", "b"), ("x", "a"), ("x", "y"), (None, "a")], "taker string, sender string")
    owners = spark.createDataFrame([("a", 1), ("b", 2)], "address string, fid bigint")
    assert sorted((r.address, r.fid) for r in resolve.attach_account(trades, owners, ["taker", "sender"]).collect()) == [("a", 1)] * 3
    kept = resolve.attach_account(trades, owners, ["taker", "sender"], keep_unresolved=True)
    assert ("x", None) in {(r.address, r.fid) for r in kept.collect()} and kept.count() == 4
    remote = spark.createDataFrame([("y", 8), ("z", 9)], "address string, fid bigint")
    want = spark.createDataFrame([("a",), ("z",), ("y",), ("q",)], "address string")
    assert sorted(map(tuple, resolve.fill_gaps(owners, want, remote, "address").collect())) == [("a", 1), ("b", 2), ("y", 8), ("z", 9)]


def test_folding(spark):
    legs = spark.createDataFrame([(None, 1, 30.0, T0 + DAY), (None, 1, 30.0, T0), (2, 1, None, T0)], "fid bigint, tx int, usd double, block_time timestamp")
    assert sorted(((r.fid or 0), r.usd, r.block_time, r.n_legs) for r in fold.fold_legs(legs, ["fid", "tx"], ["usd"]).collect()) == [(0, 60.0, T0, 2), (2, None, T0, 1)][:1] + [(2, None, T0, 1)]
    assert [tuple(r) for r in fold.collapse(legs, ["fid", "tx"], ["usd"]).collect()] == [(2, 1, None)]


def test_volumes_differ_on_trades_between_listed_tokens(spark):
    t = spark.createDataFrame([(1, 2, 10.0, 5), (3, 1, 7.0, 6), (8, 9, 1.0, 7)], "bought int, sold int, usd double, taker int")
    listed = spark.createDataFrame([(1,), (2,)], "token int")
    one = sorted((r.token, r.buy_usd, r.sell_usd) for r in fold.volume_one_scan(t, listed).collect())
    two = sorted((r.token, r.volume_usd) for r in fold.volume_two_sided(t, listed).collect())
    assert one == [(1, 10.0, 7.0)] and two == [(1, 17.0), (2, 10.0)]


def test_balances(spark):
    top = str(2**256 - 1)
    raw = spark.createDataFrame([("t", "a", "b", top), ("t", "b", "c", "1")], "token string, sender string, receiver string, value string")
    assert sorted(map(tuple, fold.net_balances_exact(raw).collect())) == [("t", "a", "-" + top), ("t", "b", str(2**256 - 2)), ("t", "c", "1")]
    small = spark.createDataFrame([("t", "a", "b", 5, T0), ("t", "b", "c", 2, T0 + DAY)], "token string, sender string, receiver string, value bigint, at timestamp")
    assert sorted(map(tuple, fold.net_balances(small, 0).select("holder", "balance").collect())) == [("b", 3), ("c", 2)]
    assert fold.net_balances(small, 0, F.lit(T0 + 2 * DAY)).count() == 0


def test_ranking(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 9, "c"), (None, 1, "d"), (None, 2, "e")], "k int, v int, s string")
    assert sorted((r.k or 0, r.s) for r in rank.keep_first(df, ["k"], [F.desc("v"), F.asc("s")]).collect()) == [(0, "e"), (1, "c")]
    assert sorted((r.k or 0, r.s) for r in rank.keep_best(df, ["k"], F.struct("v", "s")).collect()) == [(0, "e"), (1, "c")]
    got = rank.budgeted(df.where("k = 1"), ["k"], [F.desc("v"), F.asc("s")], 2).collect()
    assert sorted((r.s, r.n_skipped) for r in got) == [("a", 1), ("c", 1)]


def test_pivot_cohort_and_gate(spark):
    rows = spark.createDataFrame([(1, 9, "reply", None), (1, 9, "like", None), (2, 9, "wave", 1.0), (3, 9, "like", 0.00005)], "who int, brand int, kind string, w double")
    assert sorted(map(tuple, pivot.weighted_pivot(rows, ["who", "brand"], "kind", "w").collect())) == [(1, 9, 1, 0, 0, 1, 4.0), (3, 9, 0, 0, 0, 1, 0.0)]
    src = spark.createDataFrame([("a", None, "x", 2), ("a", 7, "x", 2), ("a", 8, "y", 3), ("a", None, "z", 1), (None, 1, "x", 1)], "address string, fid bigint, source string, priority int")
    assert [tuple(r) for r in pivot.cohort(src).collect()] == [("a", 1, "z|x|y", 7)]
    c = spark.createDataFrame([("a", 1, 0.5), ("b", None, 0.9), ("c", 1, None), ("d", 1, 0.7)], "address string, priority int, score double")
    assert [r.address for r in pivot.gate(c, 5, None, 2).collect()] == ["d", "a"]
    assert {r.address for r in pivot.gate(c, None, 0.6).collect()} == {"b", "d"}


def test_mentions(spark):
    posts = spark.createDataFrame([(1, 5, [7, 7, 8], "@zed"), (2, 7, [7], ""), (3, 5, [], "hi @Zed!"), (4, 5, [], "zed")], "id int, author bigint, ids array<bigint>, body string")
    brands = spark.createDataFrame([(7, "zed"), (9, None)], "fid bigint, name string")
    assert sorted((r.id, r.brand) for r in pivot.mentions(posts, brands, "body", "name", "ids", "author").collect()) == [(1, 7), (3, 7)]


def test_registry_merge_and_deployments(spark):
    left = spark.createDataFrame([("a", 1, None, 5)], "t string, c int, name string, at int")
    right = spark.createDataFrame([("a", 1, "n", 9), ("b", 1, "m", 8)], "t string, c int, name string, at int")
    assert sorted(map(tuple, registry.merge_prefer_left(left, right, ["t", "c"], ["name"]).collect())) == [("a", 1, "n", 5), ("b", 1, "m", 8)]
    creations = spark.createDataFrame([(1, "k", "a", 0), (2, "l", "f", 0), (3, "m", "f", 0), (4, "n", "a", 0)], "tx int, contract string, creator string, at int")
    senders = spark.createDataFrame([(1, "a"), (2, "b"), (3, "z"), (4, "b")], "tx int, sender string")
    cohort = spark.createDataFrame([("a",), ("b",)], "address string")
    got = sorted((r.contract, r.deployer, r.deploy_method) for r in registry.deployments(creations, senders, cohort).collect())
    assert got == [("k", "a", "direct"), ("l", "b", "via_factory"), ("n", "a", "via_factory")]


def test_byte_logs(spark):
    word = lambda v: v.to_bytes(32, "big")
    who, other = int("11" * 20, 16), int("22" * 20, 16)
    good = word(32) + word(2) + word(who) + word(7) + word(other) + word(2**255)
    df = spark.createDataFrame([(1, bytearray(good)), (2, bytearray(good[:-1])), (3, bytearray(word(31) + good[32:])), (4, None)], "id int, data binary")
    got = sorted((r.id, r.pair_no, r.beneficiary, int(r.share_hex, 16)) for r in decode.address_shares(df, "data").collect())
    assert got == [(1, 1, "0x" + "11" * 20, 7), (1, 2, "0x" + "22" * 20, 2**255)]
    logs = spark.createDataFrame([(bytearray(word(who)), bytearray(word(other)), bytearray(word(2**200) + word(3))), (None, None, None)], "topic1 binary, topic2 binary, data binary")
    assert [(r.sender, r.owner, r.assets_raw, r.shares_raw) for r in decode.deposits(logs).collect()] == [("0x" + "11" * 20, "0x" + "22" * 20, str(2**200), "3")]


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "k int, v string, w string")
    new = spark.createDataFrame([(2, None, "y"), (3, "c", None)], "k int, v string, w string")
    run = lambda p: sorted(map(tuple, upsert.upsert(old, new, ["k"], {}, p).collect()))
    assert run(Policy.OVERWRITE) == [(1, "a", None), (2, None, "y"), (3, "c", None)]
    assert run(Policy.CREATE_ONLY) == [(1, "a", None), (2, "b", "x"), (3, "c", None)]
    assert run(Policy.COALESCE) == [(1, "a", None), (2, "b", "y"), (3, "c", None)]
    once = upsert.upsert(old, new, ["k"], {"v": Policy.COALESCE})
    twice = upsert.upsert(once, new, ["k"], {"v": Policy.COALESCE})
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert tuple(upsert.changes(old, new, ["k"]).first()) == (1, 1)
    edges = spark.createDataFrame([("0xA", "0xa", "t", 1), (None, "0xb", "t", 1), ("0xc", None, "t", 1)], "deployer_address string, fee_recipient_address string, token_address string, chain_id int")
    assert sorted((r.wallet, r.role) for r in upsert.role_edges(edges).collect()) == [("0xA", "deployer"), ("0xb", "fee_recipient"), ("0xc", "deployer")]


def test_forward_match_of_one_hot_transaction(spark):
    """All rows in one transaction: matched against brute force over several slices, and in about linear time."""
    import time

    def run(n, width):
        first = spark.range(n).where("id % 3 = 0").select(F.lit("t").alias("tx"), F.col("id").alias("i"))
        ops = spark.range(n).where("id % 7 = 5").select(F.lit("t").alias("tx"), F.col("id").alias("j"), F.col("id").cast("string").alias("s"))
        began = time.perf_counter()
        rows = match.nearest_forward(first, ops, "tx", "i", "j", ["s"], width).collect()
        return rows, time.perf_counter() - began

    rows, _ = run(300, 16)
    ops = [j for j in range(300) if j % 7 == 5]
    assert {r.i: r.op_index for r in rows} == {i: min((j for j in ops if j > i), default=None) for i in range(0, 300, 3)}
    _, small = run(40_000, None)
    rows, large = run(160_000, None)
    assert len(rows) == 53_334 and large < 3 * max(small, 2)


def test_starts_and_operations_without_a_transaction(spark):
    first = spark.createDataFrame([(None, 1), ("t", 1), ("t", None)], "tx string, i int")
    ops = spark.createDataFrame([(None, 2, "n"), ("t", 2, "b"), ("t", 2, "a")], "tx string, j int, s string")
    got = sorted(((r.tx, r.i, r.op_index, r.s) for r in match.nearest_forward(first, ops, "tx", "i", "j", ["s"]).collect()), key=str)
    assert (None, 1, None, None) in got and ("t", 1, 2, "a") in got and len(got) == 3
    events = ops.withColumnRenamed("j", "i")
    inside = match.inside_windows(events, first, "tx", "i", []).select("i", "s", "start_index").collect()
    assert [tuple(r) for r in inside if r.s == "n"] == []
