"""Steps of a long expression that are computed once and that filters stay above."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settled(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add the columns behind a one-row generator.

    Filters on a projection are rewritten in terms of its inputs, which copies a long expression once per use. They
    are not pushed below a generator, so the columns are computed once; the generator costs no shuffle.
    """
    keep = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
