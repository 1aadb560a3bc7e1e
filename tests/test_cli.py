import pytest

from oracle import TABLES
from tallyloom.__main__ import known, main


def test_list(capsys):
    assert main(["list"]) == 0 and "attribution_split" in capsys.readouterr().out.split()


@pytest.mark.skipif(not TABLES.exists(), reason="no tables")
def test_run_explain_preflight(spark, tmp_path, capfd):
    assert main(["run", "graph_counts", "--data", str(TABLES), "--out", str(tmp_path / "o")], spark) == 0
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2
    assert main(["explain", "graph_counts", "--data", str(TABLES)], spark) == 0 and "Physical Plan" in capfd.readouterr().out
    assert main(["run", "nope", "--data", "x", "--out", "y"], spark) == 2
    assert main(["preflight", "--data", str(TABLES)], spark) == 0 and main(["preflight", "--data", str(tmp_path / "none")], spark) == 1
    assert len(known()) > 80


def test_load_and_runs(spark, tmp_path, capsys):
    from tallyloom.sources.runs import open_run

    run = open_run(str(tmp_path / "runs"), "token_buyers")
    columns = "fid bigint, buyer_address string, token_address string, chain_id bigint, platform string, amount_usd double, token_amount double, block_time timestamp, tx_hash string"
    run.write(spark.createDataFrame([(5, "0xA", "0xT", 1, "p", 2.0, 1.0, None, "h1")], columns), "buys")
    run.seal()
    args = ["token_buyers", "--runs", str(tmp_path / "runs")]
    assert main(["runs", *args], spark) == 0 and capsys.readouterr().out.split("\n")[0] == f"sealed {run.name}"
    assert main(["load", *args, "--graph", str(tmp_path / "g"), "--dry-run"], spark) == 0 and "edges_BOUGHT created 1 updated 0" in capsys.readouterr().out
    assert not (tmp_path / "g").exists()
    assert main(["load", *args, "--graph", str(tmp_path / "g")], spark) == 0 and (tmp_path / "g" / "current.json").exists()
