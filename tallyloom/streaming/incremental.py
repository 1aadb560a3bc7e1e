"""The incremental forms as Structured Streaming: de-duplication, folding and attribution with late data."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def deduplicated(events: DataFrame, keys: Sequence[str], at: str, lateness: str = "1 day") -> DataFrame:
    """Each event once, however often it is delivered within the lateness; state is dropped behind the watermark."""
    return events.withWatermark(at, lateness).dropDuplicatesWithinWatermark(list(keys))


def folded(legs: DataFrame, keys: Sequence[str], usd: str, at: str, window: str = "1 day", lateness: str = "1 day") -> DataFrame:
    """Purchases per key and window of event time, emitted once the watermark has passed the window."""
    grouped = legs.withWatermark(at, lateness).groupBy(F.window(at, window), *keys)
    return grouped.agg(F.sum(F.col(usd).cast("decimal(28,4)")).cast("double").alias("usd"), F.count("*").alias("n_legs"))


def attributed(buys: DataFrame, engagements: DataFrame, keys: Sequence[str], days: int = 5, lateness: str = "1 day") -> DataFrame:
    """Stream-stream interval join of purchases with the engagements of the window before them.

    buys: the keys, purchase, bought_at, usd. engagements: the keys, author, engaged_at. Watermarks on both sides bound
    the state by the window and the lateness. The equal split over authors needs the finished set of a purchase and is
    done by the batch that reads the pairs.
    """
    b = buys.withWatermark("bought_at", lateness).alias("b")
    e = engagements.withWatermark("engaged_at", lateness).alias("e")
    same = [F.col(f"b.{k}") == F.col(f"e.{k}") for k in keys]
    inside = (F.col("engaged_at") < F.col("bought_at")) & (F.col("bought_at") <= F.col("engaged_at") + F.expr(f"interval {days} days"))
    on = inside
    for s in same:
        on = on & s
    return b.join(e, on, "inner").select(*[F.col(f"b.{k}").alias(k) for k in keys], "purchase", "bought_at", "usd", "author", "engaged_at")


def upsert_each(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run every available batch through an idempotent upsert; a batch that is replayed changes nothing."""
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
