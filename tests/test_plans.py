from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.upsert import Policy
from tallyloom.plans import graph, loads, products
from tallyloom.plans.orchestrate import Product, order, run_all
from tallyloom.sources.runs import Watermarks, open_run, run_ids

T0 = datetime(2025, 1, 10, tzinfo=UTC)


def test_order_and_runs(spark, tmp_path):
    df = spark.createDataFrame([(1, T0)], "k int, at timestamp")
    broken = lambda: 1 / 0
    ps = [Product("c", lambda: {"t": df}, ("a",)), Product("a", lambda: {"t": df}, event_time=("t", "at")), Product("d", lambda: {"t": df}, ("b",)), Product("b", broken)]
    assert [p.name for p in order(ps)] == ["a", "c", "b", "d"] and [p.name for p in order(ps, only=["c"])] == ["c"]
    with pytest.raises(ValueError, match="x -> y -> x"):
        order([Product("x", dict, ("y",)), Product("y", dict, ("x",))])
    marks = Watermarks(str(tmp_path / "state.json"))
    report = {r["product"]: r["state"] for r in run_all(ps, str(tmp_path), marks)}
    assert report == {"a": "sealed", "c": "sealed", "b": "failed", "d": "skipped"}
    assert marks.get("a") is not None and len(run_ids(str(tmp_path), "a")) == 1
    assert {r["state"] for r in run_all(ps[:2], str(tmp_path), marks, dry=True)} == {"planned"}


def test_loading_a_run_twice_changes_nothing(spark):
    wallets = spark.createDataFrame([(1, "a"), (2, "b")], "fid int, address string")
    steps = [graph.GraphStep("wallets", "owns", ("fid", "address"), lambda df: df, {"as_of": Policy.COALESCE}), graph.GraphStep("absent", "x", ("k",), lambda df: df, required=False)]
    first, counts = graph.load(steps, {"wallets": wallets}, {}, {"as_of": "r1"})["owns"]
    assert tuple(counts.first()) == (2, 0)
    again, counts = graph.load(steps, {"wallets": wallets}, {"owns": first}, {"as_of": "r1"})["owns"]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, first.collect())) and tuple(counts.first()) == (0, 2)
    with pytest.raises(FileNotFoundError):
        graph.load([graph.GraphStep("gone", "x", ("k",), lambda df: df)], {}, {}, {})
    assert graph.violations({"account": wallets})["account"].count() == 0
    assert sorted(r.fid for r in graph.stubs("account", wallets, wallets).collect()) == [1, 2]


def test_buyers_keep_the_floor_per_leg(spark):
    trades = spark.createDataFrame(
        [("a", "z", "t", 1, 30.0, 1.0, T0, "x"), ("a", "z", "t", 1, 30.0, 1.0, T0, "x"), ("q", "a", "t", 1, 60.0, 1.0, T0, "y"), ("q", "a", "t", 1, None, 1.0, T0, "y"), ("q", "q", "t", 1, 99.0, 1.0, T0, "w"), ("a", "a", "u", 1, 99.0, 1.0, T0, "v")],
        "taker string, tx_from string, token_address string, chain_id int, amount_usd double, token_amount double, block_time timestamp, tx_hash string",
    )
    registry = spark.createDataFrame([("t", 1, "p")], "token_address string, chain_id int, platform string")
    owners = spark.createDataFrame([("a", 7)], "address string, fid bigint")
    got = products.token_buyers(trades, [registry], owners).collect()
    assert [(r.fid, r.buyer_address, r.amount_usd, r.tx_hash, r.platform) for r in got] == [(7, "a", 60.0, "y", "p")]
    assert products.token_buyers(trades, [registry], owners, F.lit("2025-01-11").cast("timestamp")).count() == 0


def test_engagement_products(spark):
    e = spark.createDataFrame([(1, 9, "Reply", "h", None, T0, 1.0), (1, 9, " reply ", "h", "", T0, 1.0), (1, 9, "like", None, "g", T0, 1.0), (9, 9, "like", None, "g", T0, 1.0)], "engager_fid bigint, brand_fid bigint, engagement string, cast_hash string, target_cast_hash string, engaged_at timestamp, weight double")
    brands = spark.createDataFrame([(9, "b", 2.0)], "fid bigint, name string, weight double")
    posts = spark.createDataFrame([("c", 1, 2, 3, T0)], "channel_id string, author_fid bigint, likes_count bigint, recasts_count bigint, timestamp timestamp")
    reactions = spark.createDataFrame([("c", 5)], "channel_id string, author_fid bigint")
    out = products.brand_engagement(e, brands, posts, reactions)
    assert [(r.engager_fid, r.reply, r.like, r.weighted_score) for r in out["brand_engagement_summary"].collect()] == [(1, 1, 1, 8.0)]
    assert out["brand_engagements"].count() == 2
    assert sorted((r.author_fid, r.casts_posted, r.reactions_received, r.reactions_given) for r in out["channel_engagement_summary"].collect()) == [(1, 1, 5, 0), (5, 0, 0, 1)]


def test_exchange_activity_carries_fresh_rows(spark):
    targets = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "address string, fid bigint")
    answers = spark.createDataFrame([("a", '{"cumVlm": "5"}', "[]"), ("b", '{"cumVlm": "9"}', "[]")], "address string, rate string, ledger string")
    done = spark.createDataFrame([("c",)], "address string")
    prior = spark.createDataFrame([("b", 99, 7.0, None, 0, T0)], "address string, fid bigint, cum_volume_usd double, first_activity_at timestamp, ledger_event_count int, checked_at timestamp")
    out = products.exchange_activity(targets, answers, done, prior, F.lit("2025-01-01").cast("timestamp")).collect()
    assert sorted((r.address, r.fid, r.cum_volume_usd, r.has_hl_activity) for r in out) == [("a", 1, 5.0, True), ("b", 2, 7.0, True)]


def graph_of(data_type, sources, before=None, declared=None):
    return {t: rows for t, (rows, _) in graph.load(loads.LOADS[data_type](), sources, before or {}, {"as_of": "r"}, declared).items()}


TOKENS = "token_address string, chain_id bigint, deployer_address string, fee_recipient_address string, fid bigint, fee_recipient_fid bigint, platform string, name string, symbol string, deployed_at timestamp, pool_address string, launch_type string, tx_hash string"


def test_roles_are_guarded(spark):
    """One edge per pair: a fee recipient that is the deployer, spelled otherwise, adds none; nor does its own account."""
    rows = [
        ("0xT1", 1, "0xAA", "0xaa", 5, 5), ("0xT2", 1, "0xaa", "0xBB", 5, 6), ("0xT3", 1, None, "0xcc", None, 7), ("0xT4", 1, "0xdd", None, 8, None), ("0xT5", 1, None, None, None, None),
    ]
    tokens = spark.createDataFrame([(*r, "p", "n", "s", T0, None, "l", "x") for r in rows], TOKENS)
    g = graph_of("bankr_tokens", {"tokens": tokens})
    assert sorted((r.src_address, r.dst_address, r.role) for r in g["edges_DEPLOYED_TOKEN"].collect()) == [("0xaa", "0xt1", "deployer"), ("0xaa", "0xt2", "deployer"), ("0xbb", "0xt2", "fee_recipient"), ("0xcc", "0xt3", "fee_recipient"), ("0xdd", "0xt4", "deployer")]
    assert sorted((r.src_fid, r.dst_address, r.role) for r in g["edges_CREATED"].collect()) == [(5, "0xt1", "deployer"), (5, "0xt2", "deployer"), (6, "0xt2", "fee_recipient"), (7, "0xt3", "fee_recipient"), (8, "0xt4", "deployer")]
    assert g["nodes_token"].count() == 5 and g["nodes_wallet"].count() == 4


def test_checked_wallets_get_a_negative_stamp_and_no_edge(spark):
    rows = [("0xA", 1, True, 5.0, None, 2, T0), ("0xB", 2, False, 0.0, None, 0, T0), ("0xC", None, None, 0.0, None, 0, T0)]
    hl = spark.createDataFrame(rows, "address string, fid bigint, has_hl_activity boolean, cum_volume_usd double, first_activity_at timestamp, ledger_event_count bigint, checked_at timestamp")
    g = graph_of("hyperliquid_activity", {"hl_activity": hl})
    assert {r.address: r.is_active for r in g["nodes_wallet"].collect()} == {"0xa": True, "0xb": False, "0xc": False}
    assert [r.src_address for r in g["edges_USED"].collect()] == ["0xa"] and [r.src_fid for r in g["edges_ACCOUNT"].collect()] == [1]
    again = graph_of("hyperliquid_activity", {"hl_activity": hl}, g)
    assert all(sorted(map(str, again[t].collect())) == sorted(map(str, g[t].collect())) for t in g)


def test_owners_keep_their_facts(spark):
    own = spark.createDataFrame([(1, "0xA", "eth", True, "verified")], "fid bigint, address string, protocol string, is_primary boolean, source string")
    accounts = spark.createDataFrame([(1, "u", None, 0.5, 1, 1, None, None)], "fid bigint, username string, display_name string, neynar_score double, follower_count bigint, following_count bigint, custody_address string, registered_at timestamp")
    g = graph_of("linked_wallets", {"wallets": own, "accounts": accounts})
    builders = spark.createDataFrame([(1, "0xa"), (2, "0xA")], "fid bigint, address string")
    activity = spark.createDataFrame([(1, "0xA", 8453, 3, T0, T0)], "fid bigint, address string, chain_id bigint, tx_count bigint, first_tx_at timestamp, last_tx_at timestamp")
    g = g | graph_of("miniapp_builders", {"builder_wallets": builders, "builder_activity": activity}, g)
    assert sorted((r.src_fid, r.is_primary, r.source) for r in g["edges_ACCOUNT"].collect()) == [(1, True, "verified"), (2, False, "builder_wallets")]
    assert {r.fid: (r.miniapp_builder, r.username) for r in g["nodes_account"].collect()} == {1: (True, "u"), 2: (True, None)}


def test_manifest_rules(spark):
    with pytest.raises(FileNotFoundError, match="deployer_activity"):
        graph_of("contract_deployers", {"deployments": spark.createDataFrame([], "fid bigint")})
    with pytest.raises(FileNotFoundError, match="token_volume"):  # optional, but the manifest names it
        graph_of("bankr_tokens", {"tokens": spark.createDataFrame([], TOKENS)}, None, ["tokens", "token_volume"])
    assert "nodes_token" in graph_of("bankr_tokens", {"tokens": spark.createDataFrame([], TOKENS)}, None, ["tokens"])


def test_last_row_of_a_key_counts(spark):
    rows = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "c", 3)], "fid bigint, v string, row_no bigint")
    assert [tuple(r) for r in graph.last_rows(rows, ["fid"]).collect()] == [(1, "b")]


def test_every_label_and_relationship_has_a_step():
    from tallyloom.plans.graph import NODES

    targets = {s.target for make in loads.LOADS.values() for s in make()}
    assert targets == {f"nodes_{n}" for n in NODES} | {f"edges_{e}" for e in loads.EDGES}


def test_a_sealed_run_is_loaded_whole_and_again(spark, tmp_path):
    run = open_run(f"{tmp_path}/runs", "token_buyers")
    buys = [(5, "0xA", "0xT", 1, "p", 2.0, 1.0, T0, "h1"), (None, "0xB", "0xT", 1, "p", 3.0, 1.0, T0, "h2")]
    run.write(spark.createDataFrame(buys, "fid bigint, buyer_address string, token_address string, chain_id bigint, platform string, amount_usd double, token_amount double, block_time timestamp, tx_hash string"), "buys")
    root, graph_root = f"{tmp_path}/runs", f"{tmp_path}/graph"
    with pytest.raises(FileNotFoundError, match="no sealed run"):
        loads.load_run(spark, root, "token_buyers", graph_root)
    run.seal()
    assert {r["target"]: r["created"] for r in loads.load_run(spark, root, "token_buyers", graph_root, dry=True)}["edges_BOUGHT"] == 2 and loads.current(graph_root) == {}
    for created in (2, 0):
        report = {r["target"]: (r["created"], r["updated"]) for r in loads.load_run(spark, root, "token_buyers", graph_root)}
        assert report["edges_BOUGHT"] == (created, 2 - created)
    edges = spark.read.parquet(loads.current(graph_root)["edges_BOUGHT"]).collect()
    assert sorted((r.src_address, r.dst_address, r.tx_hash, r.usd, r.as_of) for r in edges) == [("0xa", "0xt", "h1", 2.0, run.name), ("0xb", "0xt", "h2", 3.0, run.name)]
    assert spark.read.parquet(loads.current(graph_root)["edges_ACCOUNT"]).count() == 1
