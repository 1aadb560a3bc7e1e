from datetime import UTC, datetime, timedelta

from tallyloom.operators import instants

US = lambda *a: round(datetime(*a, tzinfo=UTC).timestamp() * 1_000_000)
CASES = [
    ("2025-02-01 14:05:18", None, US(2025, 2, 1, 14, 5, 18)),
    ("2025-02-01 14:05:18", "Australia/Sydney", US(2025, 2, 1, 3, 5, 18)),
    (" 2025-02-02 06:09:31.328 UTC\t", "Europe/Berlin", US(2025, 2, 2, 6, 9, 31, 328000)),
    ("2025-02-05T20:38:30,1234567z", None, US(2025, 2, 5, 20, 38, 30, 123456)),
    ("2025-02-03", "Asia/Kolkata", US(2025, 2, 2, 18, 30)),
    ("20250203T090337Z", None, US(2025, 2, 3, 9, 3, 37)),
    ("02.03.2025 11:52:50", None, US(2025, 3, 2, 11, 52, 50)),
    ("02/03/2025 12:00:01 am", None, US(2025, 2, 3, 0, 0, 1)),
    ("11 February 2025 11:30:12", None, US(2025, 2, 11, 11, 30, 12)),
    ("Mon, 10 Feb 2025 07:16:58 +0530", "Europe/Berlin", US(2025, 2, 10, 1, 46, 58)),
    ("Mar 18, 2025 1:42:07 PM EDT", "Asia/Kolkata", US(2025, 3, 18, 17, 42, 7)),
    ("2025-03-31 17:50:13 CEST", None, US(2025, 3, 31, 15, 50, 13)),
    ("2025-02-01T14:03:09-03:30", None, US(2025, 2, 1, 17, 33, 9)),
    ("1739060186924", "Asia/Kolkata", 1739060186924000),
    ("1738527065", None, 1738527065000000),
    ("1.777862886838e12", None, 1777862886838000),
    ("1752205997805272198", None, 1752205997805272),
    ("1778954428.656", None, 1778954428656000),
    ("2025-03-30 02:30:00", "Europe/Berlin", None),  # never
    ("2025-10-26 02:30:00", "Europe/Berlin", None),  # twice
    ("2025-10-26 02:30:00", "Asia/Kolkata", US(2025, 10, 25, 21)),
    ("2025-04-06 01:45:00", "Australia/Lord_Howe", None),  # half an hour twice
    ("2025-02-30 10:00:00", None, None),
    ("2026-13-45", None, None),
    ("25:61", None, None),
    ("2025-01-01 24:00:00", None, None),
    ("02/03/2025 13:00:01 pm", None, None),
    ("2025-01-01 10:00:00 XYZ", None, None),
    ("2025-01-01 10:00:00+99:00", None, None),
    ("2025-01-01 10:00:00", "Nowhere/Atlantis", None),
    ("20250203", None, None),
    ("block 19482211", None, None),
    ("yesterday", None, None),
    ("", None, None),
    (None, None, None),
    ("9" * 100_000, None, None),
]


def test_notations(spark):
    df = spark.createDataFrame([(i, t, z, "mine", 5) for i, (t, z, _) in enumerate(CASES)], "id bigint, t string, z string, t_text string, wall_us int")
    out = {r.id: (r.utc_us, r.t_text, r.wall_us) for r in instants.utc_instants(df, "t", "z").collect()}
    assert out == {i: (want, "mine", 5) for i, (_, _, want) in enumerate(CASES)}


def test_feeds_without_a_zone_are_estimated(spark):
    at = [datetime(2025, 1, 5, tzinfo=UTC) + timedelta(days=7 * i, hours=i) for i in range(40)]
    local = lambda t, h: (t + timedelta(hours=h)).strftime("%Y-%m-%d %H:%M:%S")
    data = [("kolkata", local(t, 5.5), t + timedelta(minutes=9)) for t in at] + [("utc", local(t, 0), t + timedelta(minutes=9)) for t in at]
    df = spark.createDataFrame(data, "feed string, t string, seen timestamp")
    zones = ("UTC", "Europe/Berlin", "Asia/Kolkata", "America/New_York")
    rows = instants.utc_instants(df, "t", None, "feed", "seen", zones).collect()
    assert all(r.utc_us == round(r.seen.replace(tzinfo=UTC).timestamp() * 1e6) - 9 * 60_000_000 for r in rows)
    assert instants.utc_instants(df.limit(0), "t", None, "feed", "seen", zones).count() == 0


def test_a_feed_that_changes_its_clock(spark):
    """A feed that wrote Indian time and then New York time: every row is read under the offset of its period."""
    at = [datetime(2025, 1, 5, tzinfo=UTC) + timedelta(hours=5 * i) for i in range(1200)]
    offset = lambda t: timedelta(hours=5.5) if t < datetime(2025, 5, 4, tzinfo=UTC) else timedelta(hours=-4)
    data = [("f", (t + offset(t)).strftime("%Y-%m-%d %H:%M:%S"), t + timedelta(minutes=9 if i % 10 else 9000)) for i, t in enumerate(at)]
    data += [("f", "2025-02-03 04:05:06", None), (None, "2025-02-03 04:05:06", at[0])]
    df = spark.createDataFrame(data, "feed string, t string, seen timestamp")
    rows = instants.utc_instants(df, "t", None, "feed", "seen", ("UTC", "America/New_York", "Asia/Kolkata")).collect()
    right = [r for r in rows if r.feed and r.seen and r.utc_us == round(r.seen.replace(tzinfo=UTC).timestamp() * 1e6) - 540_000_000]
    assert len(right) >= 1050  # one row in ten is delivered days later, under the offset of that period
    assert [r.utc_us for r in rows if r.feed is None or r.seen is None] == [US(2025, 2, 3, 4, 5, 6)] * 2


def test_histories():
    wrong = lambda a, b: {"UTC": a, "Asia/Kolkata": b}
    assert instants.history([], "UTC") == []
    assert instants.history([(1, wrong(5, 5)), (2, wrong(9, 5))], "UTC") == ["UTC", "UTC"]
    assert instants.history([(1, wrong(90, 1)), (2, wrong(3, 9)), (3, wrong(90, 1))], "UTC") == ["Asia/Kolkata"] * 3  # too few rows for a change
    assert instants.history([(1, wrong(90, 1)), (2, wrong(0, 80))], "UTC") == ["Asia/Kolkata", "UTC"]
