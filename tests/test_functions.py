from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import clean, uint256
from tallyloom.functions.text import address, valid_address, whole

TOP = 2**256 - 1


def test_exact_sums_beyond_38_digits(spark):
    data = [("a", str(TOP)), ("a", str(TOP)), ("a", str(TOP)), ("a", " 5 "), ("b", "0"), ("b", None), ("b", "x1"), ("c", None)]
    df = spark.createDataFrame(data, "k string, v string")
    got = dict(map(tuple, df.groupBy("k").agg(uint256.sum_text("v")).collect()))
    assert got == {"a": str(3 * TOP + 5), "b": "0", "c": None}


def test_differences(spark):
    pairs = [(TOP, 1), (1, TOP), (5, 5), (10**18, 1), (10**36, 10**18 + 7), (0, 0)]
    df = spark.createDataFrame([(str(a), str(b)) for a, b in pairs], "a string, b string")
    got = [r[0] for r in df.select(uint256.minus_text(F.col("a"), F.col("b"))).collect()]
    assert got == [str(a - b) for a, b in pairs]


def test_words_of_bytes(spark):
    values = [0, 1, 255, 2**64, 10**30, TOP, TOP - 1]
    df = spark.createDataFrame([(bytearray(v.to_bytes(32, "big")),) for v in values] + [(bytearray(b"\1\2"),), (None,)], "b binary")
    assert [r[0] for r in df.select(uint256.from_bytes(F.col("b"), 1)).collect()] == [*map(str, values), None, None]


@pytest.mark.parametrize("signed", [False, True])
def test_words_on_both_sides_of_64_bits_are_read_once(spark, signed):
    """Right where the reading as one machine word ends, and each 32-bit word is converted once a number, not once a limb."""
    near = {s * (2**k + d) for k in (31, 32, 63, 64, 127, 128, 255) for d in (-1, 0, 1) for s in (1, -1)}
    for length in (1, 7, 8, 9, 20, 32):
        least, most = (-(2 ** (8 * length - 1)), 2 ** (8 * length - 1) - 1) if signed else (0, 2 ** (8 * length) - 1)
        values = sorted({v for v in near | {0, least, most} if least <= v <= most})
        df = spark.createDataFrame([(bytearray(b"\7" + v.to_bytes(length, "big", signed=signed) + b"\x99"),) for v in values], "b binary")
        assert [r[0] for r in df.select(uint256.from_bytes(F.col("b"), 2, length, signed)).collect()] == [*map(str, values)], length
    plan = df.select(uint256.from_bytes(F.col("b"), 2, 32, signed).alias("n"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("conv(") <= 9


@pytest.mark.parametrize(
    ("kind", "cases"),
    [
        ("bigint", [("42", 42), ("42.0", 42), (" 7 ", 7), ("4.5", None), ("nan", None), ("", None), (None, None), ("x", None)]),
        ("double", [("1e3", 1000.0), ("<nil>", None), ("-", None)]),
        ("boolean", [("Yes", True), ("0", False), ("maybe", None), ("none", None)]),
        ("timestamp", [("2025-01-02T03:04:05Z", datetime(2025, 1, 2, 3, 4, 5)), ("2025-01-02 03:04:05 UTC", datetime(2025, 1, 2, 3, 4, 5)), ("2025-01-02", datetime(2025, 1, 2)), ("NaT", None), ("soon", None)]),
        ("address", [("0xAB", "0xab"), ("So1Ana", "So1Ana"), ("null", "null"), (" ", None)]),
        ("string", [(" NULL ", "NULL"), ("  ", None)]),
    ],
)
def test_cleaners(spark, kind, cases):
    df = spark.createDataFrame([(i, raw) for i, (raw, _) in enumerate(cases)], "i int, x string")
    got = [r[1] for r in df.select("i", clean.CLEANERS[kind](F.col("x"))).orderBy("i").collect()]
    assert got == [want for _, want in cases]


def test_typed_rows_and_bad_cells(spark):
    raw = spark.createDataFrame([("1", "2.5", "NULL"), ("x", "", "a"), (None, "y", " ")], "fid string, amount_usd string, symbol string")
    assert [tuple(r) for r in clean.typed(raw, ("fid",)).collect()] == [(1, 2.5, "NULL"), (None, None, "a"), (None, None, None)]
    assert {r.column_name: r.n_bad for r in clean.bad_cells(raw, raw, ["fid", "amount_usd"]).collect()} == {"fid": 1, "amount_usd": 1}
    with pytest.raises(ValueError, match="nope"):
        clean.typed(raw, ("nope",))
    assert clean.contract(raw, {"symbol": "string", "other": "bigint"}).columns == ["symbol", "other"]


def test_addresses(spark):
    a = "0x" + "Ab" * 20
    df = spark.createDataFrame([(f"\t{a}\n",), (a[2:],), ("0x12",), (None,)], "x string")
    got = [tuple(r) for r in df.select(address("x"), valid_address("x"), clean.prefixed_address("x")).collect()]
    low = a.lower()
    assert got == [(low, low, low), (low[2:], None, low), ("0x12", None, None), (None, None, None)]
    assert spark.createDataFrame([("9" * 50,)], "x string").select(whole("x")).first()[0] is None


def test_cast_match(spark):
    df = spark.createDataFrame(
        [("buy 0xAA now $ABC", None, None), ("hm", "EIP155:1/erc20:0xaa", None), ("hm", None, "eip155:1/erc20:0xaa"), ("get $abc", None, None), ("abc", None, None), (None, None, None)],
        "t string, p string, r string",
    )
    got = [r[0] for r in df.select(clean.cast_match("t", "p", "r", F.lit("0xaa"), F.lit("ABC"), clean.token_url(F.lit(1), F.lit("0xAA")))).collect()]
    assert got == ["address", "parent_url", "parent_url", "ticker", None, None]
    assert spark.range(1).select(clean.ticker(F.lit("AB"))).first()[0] is None


def test_signed_words_and_long_sums(spark):
    values = [0, 1, -1, -(2**255), 2**255 - 1, -(10**40)]
    df = spark.createDataFrame([(bytearray(v.to_bytes(32, "big", signed=True)),) for v in values], "b binary")
    assert [r[0] for r in df.select(uint256.from_bytes(F.col("b"), 1, 32, True)).collect()] == [*map(str, values)]
    small = spark.createDataFrame([(bytearray(b"\xff\xfe"),), (bytearray(b"\x7f\xff"),)], "b binary")
    assert [r[0] for r in small.select(uint256.from_bytes(F.col("b"), 1, 2, True)).collect()] == ["-2", "32767"]
    many = spark.range(100_000).select(F.lit(str(TOP)).alias("v"))
    assert many.agg(uint256.sum_text("v")).first()[0] == str(100_000 * TOP)


def test_every_column_of_the_contract_has_its_type(spark):
    """All 23 tables read from text alone: numbers, times and truth are typed, text and addresses keep their words."""
    from tallyloom.plans.contract import TABLES, kinds, schema

    sample = {"bigint": ("7.0", 7), "double": ("1.5", 1.5), "boolean": ("yes", True), "timestamp": ("2025-01-02T03:04:05Z", datetime(2025, 1, 2, 3, 4, 5)), "address": ("0xAB", "0xab"), "hash": ("AB", "ab"), "string": (" nan ", "nan")}
    tables = [(d, t) for d, ts in TABLES.items() for t in ts]
    assert len(tables) == 23
    for d, t in tables:
        of = kinds(d, t)
        raw = spark.createDataFrame([tuple(sample[k][0] for k in of.values())], ", ".join(f"`{c}` string" for c in of))
        typed = clean.typed(raw, tuple(of))
        assert tuple(typed.first()) == tuple(sample[k][1] for k in of.values()), (d, t)
        assert dict(typed.dtypes) == schema(d, t), (d, t)


def test_rows_left_out_are_counted(spark):
    from pyspark.sql import Observation

    df = spark.createDataFrame([(1, "a"), (None, "b"), (None, None)], "k int, s string")
    seen = Observation("left out")
    assert clean.complete(df, ["k", "s"], seen).collect() == [(1, "a")] and seen.get == {"n_k": 2, "n_s": 1}
    rows, note = clean.head(df, [F.asc_nulls_last("k")], 2)
    assert rows.count() == 2 and note == "1 of 3 rows left out by the limit of 2" and clean.head(df, [F.asc("k")], 3)[1] is None
