"""Timestamps of many notations, precisions and zones into one UTC instant.

A text is brought to nine fields by one regular expression per notation; everything after that is integer arithmetic
on days and microseconds inside code generation. Zones come from the text, else from the row's feed, else from the
estimate of the feed's offset history (an offset per period, with change points), else UTC.
"""

from __future__ import annotations

from collections.abc import Sequence
from zoneinfo import available_timezones

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.stages import settled
from tallyloom.functions.text import strip
from tallyloom.session import cut, ship, sized

DAY_US = 86_400_000_000
#: Days of one period of an offset history, and the rows that a change of offset must explain.
PERIOD_DAYS, CHANGE_ROWS = 7, 10
#: Month names and the offsets in minutes of zone abbreviations.
MONTHS = "(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
MONTH_STARTS = "janfebmaraprmayjunjulaugsepoctnovdec"
ABBREVIATIONS = {
    "z": 0, "utc": 0, "gmt": 0, "ut": 0,
    "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420,
    "akst": -540, "akdt": -480, "hst": -600,
    "cet": 60, "cest": 120, "mez": 60, "mesz": 120,
}
_WEEKDAY = "(?:(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?,?\\s+)?"
_CLOCK = "(\\d{1,2}):(\\d{2})(?::(\\d{2})(?:[.,](\\d+))?)?\\s*(am|pm)?"
_ZONE = "\\s*(z|[a-z]{2,4}|(?:utc|gmt)?[+-]\\d{2}:?\\d{2}|(?:utc|gmt)?[+-]\\d{2})?"
_TIME = f"(?:[t\\s]\\s*{_CLOCK}{_ZONE})?"
#: Notations and, for each, the groups that hold year, month, day, hour, minute, second, fraction, am/pm, zone.
NOTATIONS = (
    (f"^(\\d{{4}})-(\\d{{1,2}})-(\\d{{1,2}}){_TIME}$", (1, 2, 3, 4, 5, 6, 7, 8, 9)),
    (f"^(\\d{{4}})(\\d{{2}})(\\d{{2}})t(\\d{{2}})(\\d{{2}})(\\d{{2}})(?:[.,](\\d+))?{_ZONE}$", (1, 2, 3, 4, 5, 6, 7, 0, 8)),
    (f"^(\\d{{1,2}})/(\\d{{1,2}})/(\\d{{4}}){_TIME}$", (3, 1, 2, 4, 5, 6, 7, 8, 9)),
    (f"^(\\d{{1,2}})\\.(\\d{{1,2}})\\.(\\d{{4}}){_TIME}$", (3, 2, 1, 4, 5, 6, 7, 8, 9)),
    (f"^{_WEEKDAY}(\\d{{1,2}})\\.?[\\s-]({MONTHS})\\.?,?[\\s-](\\d{{4}}),?{_TIME}$", (3, 2, 1, 4, 5, 6, 7, 8, 9)),
    (f"^{_WEEKDAY}({MONTHS})\\.?\\s(\\d{{1,2}}),?\\s(\\d{{4}}),?{_TIME}$", (3, 1, 2, 4, 5, 6, 7, 8, 9)),
)
_NUMBER = "^\\d+(?:\\.\\d*)?(?:e\\+?\\d+)?$"
_FROM, _TO = 1_672_531_200, 1_830_297_600  # 2023-01-01 and 2028-01-01
NAMED = frozenset(z for z in available_timezones() if "/" in z or z in ("UTC", "GMT", "EST", "MST", "HST"))


def read_instants(df: DataFrame, text: str) -> DataFrame:
    """Add ``wall_us`` (microseconds as written) and ``offset_min`` (null where the text has no zone).

    Bare numbers are instants already and have offset 0. wall_us is null where the text names no possible moment
    or is null. Finer digits than microseconds are cut off and missing parts are zero.
    """
    df = settled(df, {"t_text": F.lower(F.regexp_replace(strip(text), "\\s+", " "))})
    t = F.col("t_text")
    fields = F.lit(None).cast("string")
    for pattern, groups in reversed(NOTATIONS):
        joined = "|".join(f"${g}" if g else "" for g in groups)
        fields = F.when(t.rlike(pattern), F.regexp_replace(t, pattern, joined)).otherwise(fields)
    df = settled(df, {"t_parts": F.split(fields, "\\|")})
    part = lambda i: F.nullif(F.col("t_parts")[i], F.lit(""))
    whole = lambda i: part(i).try_cast("int")
    named = F.floor((F.instr(F.lit(MONTH_STARTS), F.substring(part(1), 1, 3)) + 2) / 3).cast("int")
    hour12 = F.when((whole(3) >= 1) & (whole(3) <= 12), whole(3) % 12 + F.when(part(7) == "pm", 12).otherwise(0))
    df = settled(
        df,
        {
            "t_month": F.when(part(1).rlike("^\\d"), whole(1)).otherwise(named),
            "t_hour": F.when(part(3).isNull(), 0).when(part(7).isNull(), whole(3)).otherwise(hour12),
            "t_minute": F.coalesce(whole(4), F.lit(0)),
            "t_second": F.coalesce(whole(5), F.lit(0)),
            "t_micros": F.rpad(F.substring(F.coalesce(part(6), F.lit("")), 1, 6), 6, "0").try_cast("bigint"),
            "t_zone": part(8),
            "t_digits": F.regexp_replace(part(8), "^(utc|gmt)|:", ""),
            "t_number": F.when(t.rlike(_NUMBER), t.try_cast("decimal(38,9)")),
        },
    )
    day = F.concat_ws("-", part(0), F.lpad(F.col("t_month").cast("string"), 2, "0"), F.lpad(part(2), 2, "0")).try_cast("date")
    clock = (F.col("t_hour") * 3600 + F.col("t_minute") * 60 + F.col("t_second")).cast("bigint") * 1_000_000 + F.col("t_micros")
    wall = F.when((F.col("t_hour") < 24) & (F.col("t_minute") < 60) & (F.col("t_second") < 60), F.unix_date(day).cast("bigint") * DAY_US + clock)

    zone, digits = F.col("t_zone"), F.col("t_digits")
    beyond = F.coalesce(F.nullif(F.substring(digits, 4, 2), F.lit("")).try_cast("int"), F.lit(0))
    minutes = F.substring(digits, 2, 2).try_cast("int") * 60 + beyond
    numeric = F.when((minutes <= 14 * 60) & (beyond < 60), F.when(F.startswith(digits, F.lit("-")), -minutes).otherwise(minutes))
    words = F.lit(None).cast("int")
    for name, value in ABBREVIATIONS.items():
        words = F.when(zone == name, value).otherwise(words)
    offset = F.when(zone.rlike("[+-]"), numeric).otherwise(words)

    n = F.col("t_number")
    instant = F.lit(None).cast("bigint")
    for per_second in (1_000_000_000, 1_000_000, 1_000, 1):
        inside = (n >= F.lit(_FROM * per_second)) & (n < F.lit(_TO * per_second))
        us = F.floor(n * F.lit(1_000_000 // per_second)) if per_second <= 1_000_000 else F.floor(n / F.lit(1000))
        instant = F.when(inside, us.cast("bigint")).otherwise(instant)
    bare = F.col("t_parts").isNull()
    df = settled(df, {"wall_us": F.when(bare, instant).when(zone.isNull() | offset.isNotNull(), wall), "offset_min": F.when(bare, F.when(n.isNotNull(), 0)).otherwise(offset)})
    return df.drop("t_text", "t_parts", "t_month", "t_hour", "t_minute", "t_second", "t_micros", "t_zone", "t_digits", "t_number")


def zoned_us(wall_us: Column, zone: Column | str) -> Column:
    """The instant of a wall time in a named zone; null where the zone has that time twice or never, or is unknown."""
    wall = F.timestamp_micros(wall_us)
    known = F.lit(zone) if isinstance(zone, str) else F.when(zone.isin(*sorted(NAMED)), zone)
    utc = F.to_utc_timestamp(wall, known)
    here = F.from_utc_timestamp(utc, known) == wall
    twice = F.lit(False)
    for minutes in (30, 60, 120):
        shift = F.expr(f"interval {minutes} minutes")
        twice = twice | (F.from_utc_timestamp(utc + shift, known) == wall) | (F.from_utc_timestamp(utc - shift, known) == wall)
    return F.when(here & ~twice, F.unix_micros(utc))


def feed_errors(rows: DataFrame, feed: str, seen_at: str, zones: Sequence[str], slack_min: int = 45, days: int = PERIOD_DAYS) -> DataFrame:
    """How badly each candidate offset explains the unzoned local times of each feed, period by period.

    rows: ``feed``, ``wall_us`` and the time of ingestion, which dates a row's period of ``days`` days. For every
    candidate zone a row is a violation if its instant lies after its ingestion or more than ``slack_min`` before it, or
    if the zone does not have that wall time. One pass, one mergeable count per feed, period and zone. Columns: feed,
    period, zone, n_rows, n_wrong.
    """
    seen = F.unix_micros(F.col(seen_at))
    counts = []
    for z in zones:
        lag = seen - zoned_us(F.col("wall_us"), z)
        counts.append(F.sum(F.when((lag >= 0) & (lag <= slack_min * 60_000_000), 0).otherwise(1)).alias(z))
    dated = rows.where(F.col("wall_us").isNotNull() & F.col(seen_at).isNotNull()).withColumn("period", period_of(F.col(seen_at), days))
    wide = dated.groupBy(F.col(feed).alias("feed"), "period").agg(F.count("*").alias("n_rows"), *counts)
    return wide.select("feed", "period", "n_rows", F.inline(F.array(*[F.struct(F.lit(z).alias("zone"), F.col(f"`{z}`").alias("n_wrong")) for z in zones])))


def period_of(seen_at: Column, days: int = PERIOD_DAYS) -> Column:
    return F.floor(F.unix_micros(seen_at) / (days * DAY_US))


def history(periods: list[tuple[int, dict[str, int]]], default: str, change: int = CHANGE_ROWS) -> list[str]:
    """The zone of each period that together leave the fewest violations, where a change of zone costs ``change`` rows.

    periods: in order of time, the violations of each zone. The violations of zones other than the default count
    twice, so the default stands unless another halves its violations; ties fall to the default, then by name.
    """
    zones = sorted({z for _, wrong in periods for z in wrong}, key=lambda z: (z != default, z))
    best = {z: (0, []) for z in zones}
    for _, wrong in periods:
        nearest = min(zones, key=lambda z: (best[z][0], zones.index(z)))
        after = {}
        for z in zones:
            before = z if best[z][0] <= best[nearest][0] + change else nearest
            paid = best[before][0] + (0 if before == z else change)
            after[z] = (paid + wrong[z] * (1 if z == default else 2), [*best[before][1], z])
        best = after
    return best[min(zones, key=lambda z: (best[z][0], zones.index(z)))][1] if periods else []


def estimate_feeds(rows: DataFrame, feed: str, seen_at: str, zones: Sequence[str], default: str = "UTC") -> DataFrame:
    """feed, period, zone: the offset history of each feed with the fewest violations (:func:`history`).

    Rows are only counted, per feed, period and zone; the choice among histories sees these counts, of which a feed has
    as many as it has periods and zones however many rows it delivers.
    """

    def choose(key: tuple, counts: pd.DataFrame) -> pd.DataFrame:
        by = counts.pivot_table(index="period", columns="zone", values="n_wrong", aggfunc="sum").sort_index()
        found = history([(int(p), {z: int(n) for z, n in row.items()}) for p, row in by.iterrows()], default)
        return pd.DataFrame({"feed": key[0], "period": by.index.astype("int64"), "zone": found})

    ship(rows.sparkSession)
    return feed_errors(rows, feed, seen_at, zones).groupBy("feed").applyInPandas(choose, "feed string, period bigint, zone string")


def utc_instants(df: DataFrame, text: str, feed_zone: str | None = None, feed: str | None = None, seen_at: str | None = None, zones: Sequence[str] = (), default: str = "UTC") -> DataFrame:
    """Add ``utc_us`` to the rows of ``df``: microseconds since 1970 in UTC, null where the text fixes no moment.

    The zone in the text counts first, then the row's ``feed_zone``. For the other rows of a ``feed`` the offset
    history is estimated from ``seen_at`` among ``zones`` (:func:`estimate_feeds`); without a feed, or a ``seen_at``,
    ``default`` holds. Null, empty and impossible texts, and wall times their zone has twice or never, give null. All
    columns of ``df`` are kept whatever their names; one named utc_us is replaced. The history has one row per feed and
    period and is broadcast after its rows were counted.
    """
    held = {"own_text": F.col(text), "own_zone": F.lit(None).cast("string") if feed_zone is None else F.nullif(strip(feed_zone), F.lit(""))}
    if feed is not None and seen_at is not None:
        held |= {"own_feed": F.col(feed).cast("string"), "own_seen": F.col(seen_at)}
    rows = read_instants(df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != "utc_us"]).alias("own_row"), *[c.alias(n) for n, c in held.items()]), "own_text")
    guess = F.lit(default)
    if "own_feed" in held:
        rows = cut(rows)
        local = rows.where(F.col("offset_min").isNull() & F.col("own_zone").isNull() & F.col("own_feed").isNotNull())
        found = cut(estimate_feeds(local, "own_feed", "own_seen", zones, default)).toDF("guess_feed", "guess_period", "zone_guess")
        mine = (F.col("own_feed") == F.col("guess_feed")) & (period_of(F.col("own_seen")) == F.col("guess_period"))
        rows = rows.join(sized(found), mine, "left")
        guess = F.coalesce("zone_guess", F.lit(default))
    fixed = F.col("wall_us") - F.col("offset_min").cast("bigint") * 60_000_000
    rows = settled(rows, {"own_zone": F.coalesce("own_zone", guess)})
    zone = F.col("own_zone")
    plain = F.when(zone == "UTC", F.col("wall_us"))
    if feed_zone is not None or feed is not None or default != "UTC":
        plain = plain.otherwise(zoned_us(F.col("wall_us"), zone))
    return settled(rows, {"utc_us": F.when(F.col("offset_min").isNotNull(), fixed).otherwise(plain)}).select("own_row.*", "utc_us")
