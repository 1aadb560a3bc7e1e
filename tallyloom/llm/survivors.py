"""Best representative of each duplicate group, field by field.

Fields are unpivoted to long rows, every row votes for its normalised value, winners are taken by max_by and pivoted
back. Aggregations combine map-side, so a group of any size costs one row per distinct value and task; votes meet the
figures of their group in a join that spreads hot groups by their size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import ZERO_ADDRESS, address, strip, valid_address
from tallyloom.operators.skew import hot_keys, salted_join
from tallyloom.session import cut

#: Texts that stand for "no value", in lower case.
FILLERS = (
    "n/a", "na", "n.a.", "n.a", "null", "(null)", "<null>", "nil", "<nil>", "none", "<none>", "(none)", "nan", "<na>", "undefined", "unknown",
    "unnamed", "untitled", "tbd", "tba", "todo", "empty", "missing", "no name", "not available", "not set", "no value",
)
#: How far a source is trusted.
TRUST = {"dune_robinhood": 3, "bankr_api": 2}


def usable_text(c: Column | str) -> Column:
    """The trimmed text, or null where it is blank, a filler word or only ASCII punctuation."""
    s = strip(c)
    return F.when(~F.lower(s).isin(*FILLERS) & ~s.rlike(r"^[\p{Punct}\s]*$"), s)


def usable_address(c: Column | str) -> Column:
    a = valid_address(c)
    return F.when(a != ZERO_ADDRESS, a)


def trust_of(c: Column | str) -> Column:
    s = F.lower(strip(c))
    out = F.lit(1)
    for name, level in TRUST.items():
        out = F.when(s == name, level).otherwise(out)
    return out


def long_votes(df: DataFrame, keys: Mapping[str, Column], row_id: str, trust: Column, seen_at: str, fields: Mapping[str, Column]) -> DataFrame:
    """One row per record and field: keys, field, value (null where unusable), row_id, trust, seen_at.

    Rows with a null key belong to no group and are left out.
    """
    values = F.array(*[F.struct(F.lit(f).alias("field"), v.alias("value")) for f, v in fields.items()])
    wide = df.select(*[c.alias(k) for k, c in keys.items()], F.col(row_id).alias("row_id"), trust.alias("trust"), F.col(seen_at).alias("seen_at"), values.alias("vs"))
    return wide.dropna(subset=list(keys)).select(*keys, "row_id", "trust", "seen_at", F.inline("vs"))


def winners(votes: DataFrame, keys: Sequence[str], half_life_days: float | None = None) -> DataFrame:
    """The winning value and the row that supplies it, per group and field: keys, field, value, row_id, n_rows.

    Every row votes for its value (compared in lower case), the votes of a value are summed and the largest sum wins;
    the row with the most trust, then the latest time, then the largest id among the voters of that value supplies it.
    A vote is trust times recency, both measured against the group:

    * with ``half_life_days`` the trust, halved for every half-life that the row is older than the newest row of its
      group, so votes of any age keep all their digits; sums that agree in 12 significant digits are equal and fall to
      the later time, then the larger row id;
    * without it trust and recency dominate: with B one more than the group's rows, the vote is an exact integer, B for
      the group's best trust, times B for the newest row of that trust, times B for the largest id at that time. The
      row that has all three outvotes all others together, so one trusted row beats any number of untrusted ones.
      Integers are exact up to 10**12 rows of one group.

    A null time is older than any other. A group whose values are all unusable has a row with nulls.
    """
    keys = list(keys)
    group = [*keys, "field"]
    rank = F.struct("trust", "seen_at", "row_id")
    usable = F.col("value").isNotNull()
    groups = cut(votes.groupBy(*group).agg(F.count("*").alias("n_rows"), F.max(F.when(usable, rank)).alias("top"), F.max(F.when(usable, F.col("seen_at"))).alias("newest")))
    cast = votes.where(usable).withColumn("shape", F.lower("value"))
    cast = salted_join(cast, groups, group, hot_keys(groups, group, "n_rows"), ["shape", "row_id"])
    if half_life_days is None:
        base = (F.col("n_rows") + 1).cast("decimal(13,0)")
        best = F.col("trust") == F.col("top.trust")
        newest = best & F.col("seen_at").eqNullSafe(F.col("top.seen_at"))
        steps = [F.when(c, base).otherwise(1).cast("decimal(13,0)") for c in (best, newest, newest & (F.col("row_id") == F.col("top.row_id")))]
        vote = (steps[0] * steps[1]).cast("decimal(26,0)") * steps[2]
        size = F.sum(vote.cast("decimal(38,0)"))
    else:
        age = (F.unix_micros("newest") - F.unix_micros("seen_at")) / F.lit(86_400_000_000.0 * half_life_days)
        size = F.format_string("%.11e", F.sum(F.coalesce(F.col("trust") * F.pow(F.lit(0.5), age), F.lit(0.0)))).cast("double")
    summed = cast.groupBy(*group, "shape").agg(size.alias("size"), F.max(rank).alias("best"), F.max_by("value", rank).alias("value"))
    # within equal sums the later time counts before the trust where votes decay
    tie = F.struct("best") if half_life_days is None else F.struct("best.seen_at", "best.row_id")
    order = F.struct("size", tie.alias("tie"))
    won = summed.groupBy(*group).agg(F.max_by(F.struct("value", F.col("best.row_id").alias("row_id")), order).alias("won"))
    none = groups.where("top is null").select(*group, F.lit(None).cast("string").alias("value"), F.lit(None).cast("bigint").alias("row_id"), "n_rows")
    return won.join(groups.select(*group, "n_rows"), group).select(*group, "won.value", "won.row_id", "n_rows").unionByName(none)


def survivors(won: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Pivot winners back to one record per group: keys, n_rows and, per field, the value and the row it stems from."""
    pick = []
    for f in fields:
        pick += [F.max(F.when(F.col("field") == f, F.col("value"))).alias(f), F.max(F.when(F.col("field") == f, F.col("row_id"))).alias(f"{f}_row_id")]
    return won.groupBy(*keys).agg(F.max("n_rows").alias("n_rows"), *pick)


def token_votes(tokens: DataFrame, with_source: bool = False) -> DataFrame:
    """Votes of the rows of tokens on name and fee recipient and, if asked for, on the source."""
    keys = {"token_address": address("token_address"), "chain_id": F.col("chain_id")}
    fields = {"name": usable_text("name"), "fee_recipient_address": usable_address("fee_recipient_address")}
    if with_source:
        fields["source"] = usable_text("source")
    return long_votes(tokens, keys, "token_row_id", trust_of("source"), "ingested_at", fields)
