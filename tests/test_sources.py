import json
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyloom.sources import files, payloads, runs, warehouse
from tallyloom.streaming import incremental

T0 = datetime(2025, 1, 10, tzinfo=UTC)


def test_a_run_exists_once_it_is_sealed(spark, tmp_path):
    root, schema = str(tmp_path), {"fid": "bigint", "name": "string"}
    run = runs.open_run(root, "demo")
    run.write(spark.createDataFrame([("x", 1), ("y", 2)], "name string, fid int"), "people", schema)
    with pytest.raises(FileNotFoundError):
        runs.read_table(spark, root, "demo", "people", schema)
    assert runs.open_run(root, "demo", resume=True).name == run.name
    manifest = run.seal(notes=["ok"])
    assert manifest["files"] == {"people": 2} and manifest["row_total"] == 2
    assert runs.read_table(spark, root, "demo", "people", schema).columns == ["fid", "name"]
    assert runs.read_table(spark, root, "demo", "absent", schema, required=False).count() == 0
    assert runs.open_run(root, "demo").name != run.name


def test_windows_and_watermarks(spark, tmp_path):
    w = runs.resolve_window(None, False, T0, T0 - timedelta(days=400))
    assert (w.since, w.query_since, w.source) == (T0, T0 - timedelta(days=1), "watermark")
    assert runs.resolve_window(None, True, T0, T0 - timedelta(days=9)).query_since == T0 - timedelta(days=9)
    assert runs.resolve_window(T0, True, None, T0).source == "since"
    with pytest.raises(ValueError, match="watermark"):
        runs.resolve_window(None, False, None, T0)
    marks = runs.Watermarks(str(tmp_path / "state.json"))
    assert marks.advance("a", T0) and not marks.advance("a", T0) and not marks.advance("a", T0 - timedelta(1)) and not marks.advance("a", None)
    assert runs.advance_all(marks, "b", {"x": T0, "y": None}, ["x", "y"]) and marks.get("a") == marks.get("b") == T0
    assert not runs.advance_all(marks, "c", {"x": T0}, ["x", "y"]) and not runs.advance_all(marks, "c", {"x": T0}, ["x"], ["x"])
    assert runs.run_id(["20250110T000000Z"], T0) == "20250110T000001Z"


def test_seeds_and_torn_rows(spark, tmp_path):
    (tmp_path / "s.csv").write_text("FID,Name,Weight\n5,a,\n5,b,2\nx,c,3\n")
    got = runs.read_seeds(spark, [str(tmp_path / "none.csv"), str(tmp_path / "s.csv")], "fid", {"weight": 1.0}).collect()
    assert [(r.fid, r.name, r.weight) for r in got] == [(5, "a", 1.0)]  # the first row of the key
    (tmp_path / "t.csv").write_text("address,n,checked_at\n0xa,1,now\n0xb\ngarbage,2,now\n")
    assert [r.address for r in runs.read_torn_csv(spark, str(tmp_path / "t.csv"), "address string, n int, checked_at string", "address", "^0x", "checked_at").collect()] == ["0xa"]


def test_user_wallets(spark):
    user = {"fid": 1, "username": "u", "custody_address": "0xBB", "verified_addresses": {"eth_addresses": ["0xAA", "0xbb"], "sol_addresses": ["So1"], "primary": {"eth_address": "0xaa", "sol_address": None}}}
    users = spark.createDataFrame([(json.dumps(user),), ('{"fid": 2}',)], "j string").select(F.from_json("j", payloads.USER).alias("u")).select("u.*")
    got = sorted((r.fid, r.address, r.protocol, r.is_primary, r.source) for r in payloads.user_wallets(users).collect())
    assert got == [(1, "0xaa", "eth", True, "verified"), (1, "0xbb", "eth", False, "verified"), (1, "So1", "sol", False, "verified")]
    assert sorted(r.address for r in payloads.hex_wallets(users).collect()) == ["0xaa", "0xbb"]
    assert payloads.user_profiles(users).count() == 2


def test_launches_and_activity(spark):
    page = {"launches": [{"tokenAddress": "0xT", "tokenName": " ", "chain": "Base", "timestamp": 1000, "deployer": {"walletAddress": "0xD"}}, {"tokenAddress": "0xU", "chain": "mars"}]}
    rows = payloads.launch_rows(spark.createDataFrame([(json.dumps(page),), ("{broken",), (None,)], "p string"), "p", {"base": 8453}).collect()
    assert [(r.token_address, r.chain_id, r.deployer_address, r.name) for r in rows] == [("0xt", 8453, "0xd", None)]
    wallet = spark.createDataFrame([("0xa", '{"cumVlm": "12.5"}', '[{"time": 3000}, {"time": 1000}]'), ("0xb", '{"cumVlm": "?"}', "[]")], "address string, rate string, ledger string")
    got = {r.address: (r.cum_volume_usd, r.first_activity_at, r.ledger_event_count) for r in payloads.exchange_activity(wallet).collect()}
    assert got == {"0xa": (12.5, datetime(1970, 1, 1, 0, 0, 1), 2), "0xb": (0.0, None, 0)}
    item = spark.createDataFrame([("0xC", 1, "n", None, '{"user": {"fid": "5"}}', '{"pairedToken": ""}', "2025-01-01")], "contract_address string, chain_id bigint, name string, symbol string, related string, pool_config string, created_at string")
    assert [(r.fid, r.paired_token, r.deployed_at) for r in payloads.launchpad_rows(item).collect()] == [(5, None, datetime(2025, 1, 1))]


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    data = [(1, "k", datetime(2025, 1, 1, 10), 5.0), (1, "k", datetime(2025, 1, 1, 10), 5.0), (2, "k", datetime(2025, 1, 1, 11), 7.0)]
    spark.createDataFrame(data, "id int, k string, at timestamp, usd double").write.parquet(str(src))
    stream = spark.readStream.schema("id int, k string, at timestamp, usd double").parquet(str(src))
    out = []
    q = incremental.upsert_each(incremental.deduplicated(stream, ["id"], "at"), lambda df, _: out.extend(r.id for r in df.collect()), str(tmp_path / "c1"))
    q.awaitTermination(60)
    assert sorted(out) == [1, 2]
    eng = spark.readStream.schema("id int, k string, at timestamp, usd double").parquet(str(src)).selectExpr("k", "id as author", "at as engaged_at")
    buys = stream.selectExpr("k", "id as purchase", "at as bought_at", "usd")
    pairs = []
    q = incremental.upsert_each(incremental.attributed(buys, eng, ["k"]), lambda df, _: pairs.extend((r.purchase, r.author) for r in df.collect()), str(tmp_path / "c2"))
    q.awaitTermination(60)
    assert sorted(set(pairs)) == [(2, 1)]


def test_files(spark, tmp_path):
    path = f"{tmp_path}/a/b.json"
    assert not files.exists(path) and files.modified(path) is None and files.folders(f"{tmp_path}/none") == []
    files.write_text(path, "é1")
    files.write_text(path, "é2")
    assert files.read_text(path) == "é2" and files.folders(str(tmp_path)) == ["a"] and files.modified(path) > 0


def test_a_resumed_table_is_rewritten_clean(spark, tmp_path):
    run = runs.open_run(str(tmp_path), "demo")
    for rows in ([("a", 1), ("b", None)], [("a", 1), (None, 2), ("b", 3)]):
        run.write(spark.createDataFrame(rows, "k string, v int"), "t", mode="append")
    assert runs.rewrite_clean(spark, run, "t", ["k"], {"k": "string", "v": "bigint", "w": "string"}) == 2 == run.files["t"]
    assert sorted(map(tuple, spark.read.parquet(f"{run.path}/t").collect())) == [("a", 1, None), ("b", 3, None)]


def test_scans_prune_partitions(spark, tmp_path):
    """The bounds reach the partition column and the file scan."""
    rows = spark.range(400).select((F.lit(T0) + F.make_dt_interval(F.col("id").cast("int"))).alias("at"), F.col("id").alias("v"), F.lit("wide").alias("other")).withColumn("block_month", F.trunc("at", "month"))
    rows.write.partitionBy("block_month").parquet(f"{tmp_path}/t")
    df = warehouse.bounded(spark.read.parquet(f"{tmp_path}/t"), "at", T0 + timedelta(days=90), T0 + timedelta(days=100), month="block_month").select("v")
    assert sorted(r.v for r in df.collect()) == list(range(90, 100))
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "FileScan" in x)
    assert "PartitionFilters: [isnotnull(block_month" in scan and "PushedFilters: [IsNotNull(at)" in scan and "ReadSchema: struct<at:timestamp,v:bigint>" in scan


def test_statements_and_literals(spark):
    spark.range(9).createOrReplaceTempView("nine")
    assert warehouse.run_sql(spark, "SELECT id FROM nine WHERE id > :x ORDER BY id", 2, {"x": 4}).collect() == [(5,), (6,)]
    assert warehouse.chain_ids([], 42161) == [42161] and warehouse.chain_ids(["BASE", " 1 "], 42161) == [1, 8453, 42161] and len(warehouse.chain_ids(["all"], 1)) == len(warehouse.CHAINS)
    assert warehouse.chain_name(8453) == "base" and warehouse.hex_literal(" 0x" + "AB" * 20) == "0x" + "ab" * 20
    assert warehouse.time_literal("2025-01-02T03:04:05+02:00") == "2025-01-02 01:04:05+00:00" and warehouse.name_literal("a_1") == "a_1"
    for bad, check in (("0x12'; drop", warehouse.hex_literal), ("soon", warehouse.time_literal), ("a b", warehouse.name_literal), ("mars", lambda x: warehouse.chain_ids([x], 1))):
        with pytest.raises(ValueError):
            check(bad)
    assert warehouse.chunked([1, 2, 3], 2) == [[1, 2], [3]] and warehouse.chunked([], 2) == []
    assert warehouse.call_plan({"a": (250, 100), "b": (5, 1)}, 4.0) == [("a", 3, 0.8), ("b", 5, 1.2), ("all", 8, 2.0)]
    assert [warehouse.duration(x) for x in (3.2, 123, 3723)] == ["3s", "2m 03s", "1h 02m 03s"]


def test_replies_and_channel_posts(spark):
    reply = {"hash": "0xR", "text": "né", "author": {"fid": 4, "username": "u"}, "timestamp": "2025-01-01T00:00:00Z", "direct_replies": [{"hash": "0xDEEP"}]}
    talk = {"conversation": {"cast": {"hash": "0xP", "direct_replies": [reply, {"text": "no hash"}]}}}
    df = spark.createDataFrame([(json.dumps(talk),), ("{",), (None,), ('{"conversation": {}}',)], "j string")
    rows = payloads.direct_replies(df, "j")
    assert [(r.hash, r.parent_hash, r.author.fid) for r in rows.collect()] == [("0xR", "0xP", 4)]
    assert [(r.cast_hash, r.channel_id, r.text_length, r.likes_count) for r in payloads.channel_casts(rows.unionByName(rows), "c").collect()] == [("0xr", "c", 2, 0)]


def test_text_tables_of_a_run_are_typed_and_counted(spark, tmp_path):
    run = runs.open_run(str(tmp_path), "token_buyers")
    cells = spark.createDataFrame([("7.0", "0xAB", "12.5", "soon"), ("x", "null", "", "2025-01-02T00:00:00Z")], "fid string, buyer_address string, amount_usd string, block_time string")
    run.write(cells, "buys", fmt="csv")
    cells.write.mode("overwrite").option("header", True).csv(f"{run.path}/buys")
    run.seal()
    rows, bad = runs.read_rows(spark, str(tmp_path), "token_buyers", "buys", required=("fid",))
    assert sorted(((r.fid, r.buyer_address, r.amount_usd) for r in rows.collect()), key=str) == [(7, "0xab", 12.5), (None, "null", None)]
    assert {r.column_name: r.n_bad for r in bad.collect()} == {"fid": 1, "buyer_address": 0, "amount_usd": 0, "block_time": 1}
    with pytest.raises(ValueError, match="tx_hash"):
        runs.read_rows(spark, str(tmp_path), "token_buyers", "buys", required=("tx_hash",))
    notes = []
    none, _ = runs.read_rows(spark, str(tmp_path), "arb_cohort", "cohort", notes=notes)
    assert none.count() == 0 and dict(none.dtypes)["priority"] == "bigint" and notes == ["arb_cohort/cohort is missing and counts as empty"]
    with pytest.raises(FileNotFoundError):
        runs.read_rows(spark, str(tmp_path), "arb_cohort", "cohort")
