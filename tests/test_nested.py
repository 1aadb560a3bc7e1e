import json

from tallyloom.operators import nested


def got(spark, data, items=None, outer=None, name="fid", clean=nested.fid_text):
    df = spark.createDataFrame(data, "id bigint, p string, record_id string")
    path = [x for x in (items, outer) if x]
    out = nested.values_at(df, "t", "id", {"x": nested.Target("p", path, {"v": (name, nested.address_text if items else clean)})})
    return sorted((r.record_id, r.item_no, r.value) for r in out.collect())


def test_objects_arrays_and_text_in_text(spark):
    one = {"user": {"fid": 7, "referrer": {"user": {"fid": 8}}}}
    data = [
        (1, json.dumps(one), "x"),
        (2, json.dumps({"user": [{"fid": "9"}, None, {"fid": 10.0}, {"name": "n"}, {"fid": "n/a"}]}), "x"),
        (3, json.dumps(json.dumps({"user": json.dumps({"fid": " 11 "})})), "x"),
        (4, json.dumps([{"user": {"fid": 1}}, {"user": {"fid": 2}}]), "x"),
        (5, '{"user": {"fid": 3', "x"),
        (6, '{"user": {"fid": 3}} tail', "x"),
        (7, None, None),
        (8, "", "x"),
        (9, "null", "x"),
        (10, json.dumps({"user": {"fid": None}}), "x"),
        (11, json.dumps({"user": {"fid": {"fid": 5}}}), "x"),
        (12, json.dumps({"user": [{"fid": 6}, {"fid": 6}]}), "x"),
        (13, json.dumps({"user": {"fid": "x" * 200_000}}), "x"),
        (14, json.dumps({"user": 5}), "x"),
        (15, json.dumps({"user": {"fid": 1.5}}), "x"),
    ]
    want = [(1, 0, "7"), (2, 0, "9"), (2, 2, "10"), (3, 0, "11"), (4, 0, "1"), (4, 1, "2"), (12, 0, "6"), (12, 1, "6")]
    assert got(spark, data, outer="user", name="fid") == want


def test_payload_itself(spark):
    data = [(1, '{"t": " 0XAB\\n"}', "x"), (2, '[{"t": "b"}, null, {"t": " "}, {"t": "b"}]', "x"), (3, '"{\\"t\\": \\"c\\"}"', "x")]
    assert got(spark, data, name="t", clean=nested.address_text) == [(1, 0, "0xab"), (2, 0, "b"), (2, 3, "b"), (3, 0, "c")]


def test_list_positions(spark):
    page = {"launches": [{"d": {"w": "A"}}, {"d": [{"w": "b"}, {"w": "c"}]}, {}, {"d": json.dumps({"w": "e"})}, {"m": {"d": {"w": "no"}}}, {"d": [{"w": "f"}, {"w": "F"}]}]}
    assert got(spark, [(1, json.dumps(page), "x"), (2, '{"launches": {}}', "x")], items="launches", outer="d", name="w") == [(1, 0, "a"), (1, 1, "b"), (1, 1, "c"), (1, 3, "e"), (1, 5, "f")]


def test_empty_table(spark):
    assert got(spark, [], outer="user", name="fid") == []


def layers(v, n):
    for _ in range(n):
        v = json.dumps(v)
    return v


def test_arrays_in_arrays_and_deep_text(spark):
    one = {"fid": 5}
    data = [
        (1, json.dumps({"user": [[one, {"fid": 6}], [[{"fid": 7}]], {"fid": 8}]}), "x"),
        (2, json.dumps({"user": layers(one, 6)}), "x"),
        (3, json.dumps({"user": [None, layers(one, 6)]}), "x"),
        (4, layers([[{"user": one}], {"user": layers([layers([one], 2)], 2)}], 3), "x"),
        (5, json.dumps({"user": [[], [None, "no json", 3], layers([one, one], 1)]}), "x"),
    ]
    want = [(1, 0, "5"), (1, 0, "6"), (1, 1, "7"), (1, 2, "8"), (2, 0, "5"), (3, 1, "5"), (4, 0, "5"), (5, 2, "5")]
    assert [x for x in got(spark, data, outer="user", name="fid")] == want
    page = {"launches": [[{"d": {"w": "a"}}], {"d": [[{"w": "b"}], layers([{"w": "c"}], 3)]}, layers([[{"d": {"w": "e"}}]], 4)]}
    assert got(spark, [(1, json.dumps(page), "x")], items="launches", outer="d", name="w") == [(1, 0, "a"), (1, 1, "b"), (1, 1, "c"), (1, 2, "e")]


def test_any_number_of_layers(spark):
    """However often a payload or a member is wrapped, its value comes out; an array costs a layer too."""
    deep = lambda v, n: v if not n else [json.dumps(deep(v, n - 1))] if n % 3 == 0 else json.dumps(deep(v, n - 1))
    data = [(n, layers({"user": {"fid": n}}, n + 1), "x") for n in range(12)]
    data += [(20 + n, json.dumps({"user": deep({"fid": n}, n)}), "x") for n in range(12)]
    arrays = {"fid": 9}
    for _ in range(30):
        arrays = [arrays]
    data += [(40, json.dumps({"user": arrays}), "x"), (41, '"' + json.dumps({"user": {"fid": 3}}).replace('"', "\\u0022") + '"', "x"), (42, '"\\u005b{\\u0022user\\u0022:{\\u0022fid\\u0022:4}}\\u005d"', "x")]
    assert got(spark, data, outer="user", name="fid") == [*[(n, 0, str(n)) for n in range(12)], *[(20 + n, 0, str(n)) for n in range(12)], (40, 0, "9"), (41, 0, "3"), (42, 0, "4")]


def test_child_tables_keep_their_parents(spark):
    page = {"launches": [{"t": "A", "d": [{"w": "x"}, {"w": None}, "no json"]}, None, json.dumps({"t": "B", "d": {"w": "y"}}), {"t": "C"}, 5]}
    df = spark.createDataFrame([(1, json.dumps(page)), (2, "{"), (3, None)], "id bigint, p string")
    t = nested.flat_tables(df, "id", {"launches": nested.Target("p", ["launches"], {"t": ("t", nested.address_text)}), "d": nested.Target("p", ["launches", "d"], {"w": ("w", nested.address_text)})})
    assert sorted((r.record_id, r.parent_no, r.item_no, r.t) for r in t["launches"].collect()) == [(1, 0, 0, "a"), (1, 0, 2, "b"), (1, 0, 3, "c")]
    assert sorted(((r.parent_no, r.item_no, r.w) for r in t["d"].collect()), key=str) == [(0, 0, "x"), (0, 1, None), (2, 0, "y")]
