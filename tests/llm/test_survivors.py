import random
from datetime import datetime

from tallyloom.llm import queries
from tallyloom.llm import survivors as s

T = lambda n: datetime(2025, 1, n)
SCHEMA = "token_row_id bigint, token_address string, chain_id bigint, name string, fee_recipient_address string, source string, ingested_at timestamp, field string, value int"
A = "0x" + "ab" * 20
KEYS = ("token_address", "chain_id")


def won(spark, data, half=None):
    votes = s.token_votes(spark.createDataFrame([(*r, "x", 1) for r in data], SCHEMA))
    return {(r.token_address, r.chain_id, r.field): (r.value, r.row_id, r.n_rows) for r in s.winners(votes, KEYS, half).collect()}


def test_trust_then_time_then_row(spark):
    data = [
        (1, "0xT", 1, "Low", A, "other", T(9)),
        (2, " 0xt\n", 1, "Mid", "\t" + A.upper().replace("0X", "0x") + " ", " BANKR_api ", T(1)),
        (3, "0xT", 1, "n/a", "0x" + "0" * 40, "dune_robinhood", T(8)),
        (4, "0xT", 1, "Old", "0x12", "Dune_Robinhood", T(2)),
        (5, "0xT", 1, "New", None, "dune_robinhood", T(3)),
        (6, "0xT", 1, "Tie", "nil", "dune_robinhood", T(3)),
        (7, "0xT", 2, "??", " ", None, T(3)),
        (8, None, 2, "x", A, None, T(3)),
        (9, "0xT", None, "x", A, None, T(3)),
    ]
    assert won(spark, data) == {
        ("0xt", 1, "name"): ("Tie", 6, 6),
        ("0xt", 1, "fee_recipient_address"): (A, 2, 6),
        ("0xt", 2, "name"): (None, None, 1),
        ("0xt", 2, "fee_recipient_address"): (None, None, 1),
    }
    assert won(spark, []) == {}


def test_votes_are_summed_and_decay(spark):
    data = [(1, "t", 1, "A", None, "x", T(10)), (2, "t", 1, "a", None, "x", T(10)), (3, "t", 1, "a", None, "x", T(10)), (4, "t", 1, "a", None, "x", T(10)), (5, "t", 1, "B", None, "dune_robinhood", T(10))]
    assert won(spark, data, 90.0)["t", 1, "name"] == ("a", 4, 5)
    assert won(spark, data)["t", 1, "name"] == ("B", 5, 5)
    old = [(1, "t", 1, "B", None, "dune_robinhood", datetime(2020, 1, 1)), (2, "t", 1, "a", None, "x", T(10))]
    assert won(spark, old, 90.0)["t", 1, "name"][0] == "a"


def test_pivot_back(spark):
    votes = s.token_votes(spark.createDataFrame([(1, "t", 1, "A", A, "x", T(1), "f", 0), (2, "t", 1, "none", None, "x", T(2), "f", 0)], SCHEMA))
    rows = s.survivors(s.winners(votes, KEYS), KEYS, ("name", "fee_recipient_address")).collect()
    assert [(r.name, r.name_row_id, r.fee_recipient_address_row_id, r.n_rows) for r in rows] == [("A", 1, 1, 2)]


def test_old_votes_still_count(spark):
    at = datetime(2001, 1, 1)
    data = [(n, "t", 1, "a", None, "x", at) for n in range(1, 5)] + [(9, "t", 1, "B", None, "dune_robinhood", at)]
    assert won(spark, data, 90.0)["t", 1, "name"] == ("a", 4, 5)
    ages = [(1, "t", 1, "B", None, "dune_robinhood", datetime(1925, 1, 1)), *[(n, "t", 1, "a", None, "x", datetime(1925, 1, 1)) for n in range(2, 6)], (9, "t", 1, None, None, "x", T(1))]
    assert won(spark, ages, 90.0)["t", 1, "name"] == ("a", 5, 6)
    tied = [(n, "t", 1, "a", None, "x", at) for n in range(1, 4)] + [(9, "t", 1, "B", None, "dune_robinhood", at)]
    assert won(spark, tied, 90.0)["t", 1, "name"] == ("B", 9, 4)


def test_source_is_voted_on_and_kept(spark, tmp_path):
    data = [(1, "t", 1, "A", None, " Bankr_API\n", T(1)), (2, "t", 1, "A", None, "n/a", T(2)), (3, "t", 1, "A", None, "bankr_api", T(3)), (4, "t", 1, "A", None, "dune_robinhood", T(3)), (5, "u", 1, "A", None, None, T(3))]
    spark.createDataFrame([(*r, "x", 1) for r in data], SCHEMA).write.parquet(str(tmp_path / "tokens.parquet"))
    got = {r.token_address: (r.source, r.source_row_id, r["name"]) for r in queries.p2_survivors(spark, str(tmp_path)).collect()}
    assert got == {"t": ("bankr_api", 3, "A"), "u": (None, None, "A")}
    assert {r.field for r in queries.p2_found(spark, str(tmp_path)).collect()} == {"name"}


def test_summed_votes_give_what_ranking_gives(spark):
    """The dominating weights against sorting, with ties in trust and time and many untrusted rows for one value."""
    rng = random.Random(4)
    data = [(i, f"t{rng.randint(0, 12)}", 1, rng.choice(["A", "a", "B", "c", "n/a", None]), None, rng.choice(["dune_robinhood", "bankr_api", "x", None]), T(rng.randint(1, 3)) if rng.random() < 0.9 else None) for i in range(400)]
    got = {k[0]: v for k, v in won(spark, data).items() if k[2] == "name"}
    level = {"dune_robinhood": 3, "bankr_api": 2}
    for token in {r[1] for r in data}:
        rows = [r for r in data if r[1] == token]
        top = max((r for r in rows if r[3] not in (None, "n/a")), key=lambda r: (level.get(r[5], 1), r[6] or datetime.min, r[0]))
        assert got[token] == (top[3], top[0], len(rows)), token
