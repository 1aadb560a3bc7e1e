"""One row per entity with counts, totals and latest times for every kind of event.

Kinds get an index; every entity keeps a sparse vector of (index, count, total, latest), which merges by adding counts
and totals and taking the later time. Vectors are expanded into columns only at the end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallyloom.functions.text import strip


def kind_name(c: Column | str) -> Column:
    """One spelling per kind: lower case, trimmed, dots for any signs between words; blank becomes null."""
    k = F.regexp_replace(F.lower(strip(c)), r"[^\p{L}\p{N}]+", ".")
    k = F.btrim(k, F.lit("."))
    return F.when(k != "", k)


def distinct_events(df: DataFrame, entity: str, kind: str, same: Sequence[str], at: str, weight: str) -> DataFrame:
    """One row per event: deliveries that agree in entity, kind and ``same`` (null equals blank) are merged.

    The event keeps its latest time and its greatest weight. Rows without entity or kind are left out.
    """
    blanks = [F.coalesce(strip(F.col(c).cast("string")), F.lit("")).alias(f"same_{i}") for i, c in enumerate(same)]
    rows = df.select(F.col(entity).alias("entity"), kind_name(kind).alias("kind"), *blanks, F.col(at).alias("at"), F.col(weight).cast("double").alias("weight"))
    rows = rows.where(F.col("entity").isNotNull() & F.col("kind").isNotNull())
    return rows.groupBy("entity", "kind", *[f"same_{i}" for i in range(len(same))]).agg(F.max("at").alias("at"), F.max("weight").alias("weight"))


def kind_counts(events: DataFrame) -> DataFrame:
    """entity, part, kind, n, total, latest: the events of one kind of an entity in one part, as mergeable figures.

    Counts are merged map-side per (entity, kind), so an entity with any number of events is one row per kind. The
    total is an exact decimal of 6 digits, null weights count 0. ``part`` cuts the events into parts that never share
    an event, such as brands; without such a column all are part 0.
    """
    part = F.col("part") if "part" in events.columns else F.lit(0)
    total = F.sum(F.coalesce("weight", F.lit(0.0)).cast("decimal(30,6)")).cast("decimal(38,6)")
    return events.groupBy("entity", part.alias("part"), "kind").agg(F.count("*").alias("n"), total.alias("total"), F.max("at").alias("latest"))


def kind_index(counts: DataFrame) -> DataFrame:
    """Kinds numbered from 0 in alphabetical order. The vocabulary is as large as the number of kinds, not of rows."""
    return counts.select("kind").distinct().withColumn("kind_no", (F.row_number().over(W.orderBy("kind")) - 1).cast("int"))


def entity_vectors(counts: DataFrame, index: DataFrame) -> DataFrame:
    """entity, part, features: array of struct(kind_no, n, total, latest) in order of kind_no, one element per kind that
    occurs in that part.

    Kinds are encoded by ``index`` (:func:`kind_index` over all parts that are to be merged), so only their numbers
    are shuffled. A vector is never wider than the vocabulary however many events its entity has.
    """
    coded = counts.join(index.select("kind", "kind_no"), "kind").drop("kind")
    return coded.groupBy("entity", "part").agg(vector())


def vector() -> Column:
    return F.array_sort(F.collect_list(F.struct("kind_no", "n", "total", "latest"))).alias("features")


def merge_vectors(vectors: DataFrame) -> DataFrame:
    """entity, features: the vectors of all parts of an entity as one, counts and totals added, times the later.

    Parts may be periods, brands or earlier states; tables of vectors over one index are merged by their union.
    Deliveries of one event must not be spread over parts: they would count twice.
    """
    rows = vectors.select("entity", F.inline("features"))
    merged = rows.groupBy("entity", "kind_no").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,6)").alias("total"), F.max("latest").alias("latest"))
    return merged.groupBy("entity").agg(vector())


def long_features(vectors: DataFrame, index: DataFrame) -> DataFrame:
    """entity, kind, n, total (rounded to a double), latest: the vectors decoded, one row per entity and kind."""
    rows = vectors.select("entity", F.inline("features")).join(index.select("kind", "kind_no"), "kind_no")
    return rows.select("entity", "kind", "n", F.col("total").cast("double").alias("total"), "latest")


def wide_features(vectors: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """The vectors expanded into columns: n_<kind>, total_<kind>, latest_<kind>; 0, 0 and null where the kind is absent.

    ``kinds`` are the names in order of their numbers. One row per entity, nothing is shuffled.
    """
    by_no = F.map_from_entries(F.transform("features", lambda x: F.struct(x["kind_no"], x)))
    base = vectors.select("entity", by_no.alias("m"))
    out = [F.col("entity")]
    for no, kind in enumerate(kinds):
        f = F.try_element_at("m", F.lit(no))
        name = kind.replace(".", "_")
        out += [F.coalesce(f["n"], F.lit(0)).alias(f"n_{name}"), F.coalesce(f["total"].cast("double"), F.lit(0.0)).alias(f"total_{name}"), f["latest"].alias(f"latest_{name}")]
    return base.select(*out)
